"""Fixed values.

These must equal the behaviour being reproduced; they are stated once, here,
in their natural order.
"""

# --- fixed values -----------------------------------------------------------
# Genre names searched by the per-genre top list, in the original order.
# "Ccrime" is reproduced as written: it matches nothing (a misspelling of
# "Crime"); pass ``genres=`` to use a corrected list.
DEFAULT_GENRES = [
    "Action", "Adventure", "Animation", "Comedy", "Ccrime", "Documentary",
    "Drama", "Family", "Fantasy", "Foreign", "History", "Horror", "Music",
    "Mystery", "Romance", "Science", "Tv", "Thriller", "War", "Western",
]

USER_RECS_K = 10            # items per user in the offline recommendation list
GENRE_TOP_K = 10            # items per genre
RECENT_RATINGS_N = 20       # newest ratings kept per user for re-ranking
CANDIDATES_N = 20           # similar unseen items considered per message
SIM_THRESHOLD = 0.6         # cosine similarity must be strictly greater
POSITIVE_RATING = 3.0       # a recent rating counts as positive when > this

ALS_RANK = 50
ALS_MAX_ITER = 5
ALS_REG = 0.01
ALS_GRID_RANKS = [30, 40, 50, 60, 70]
ALS_GRID_REGS = [1.0, 0.1, 0.01]

# Field separators of the text inputs and of the encoded recommendation list.
MOVIE_SEP = "^"
RATING_SEP = ","
TAG_SEP = ","
MESSAGE_SEP = "|"
LIST_SEP = "|"
ITEM_SEP = ":"
# ---------------------------------------------------------------------------
