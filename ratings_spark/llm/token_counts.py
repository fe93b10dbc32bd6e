"""Token counts by a compiled finite-state transducer.

A byte-pair vocabulary is compiled into a deterministic transducer over
characters whose transitions carry the number of tokens they emit, so that a
text's count is the sum along its path and no token is ever built.

What makes the machine finite: the tokens of a prefix always end in the one
vocabulary piece t for which the pair (last token before t, t) stands, that is,
for which merging the two pieces' characters gives back just these two. A state
therefore holds the longest suffix of what was read that can still grow into a
piece and, for each place in it where a piece may begin, the last token there
and how many tokens fewer had been emitted. When a longer piece takes over, its
transition emits a correspondingly smaller (even negative) number. States and
transitions are compiled when first met and kept by each worker.

A *reset* is a border that no piece spans: before a space that follows a
character that is no space, and around line feeds. There the machine is back
in its initial state whatever came before, so the state map of a chunk of text
is constant except for the characters up to its first reset, and is written as
(head, count, tail): characters before the first reset, tokens between first and
last, characters after the last. Maps compose associatively: tail and head that
meet are run through the machine. Texts are cut into chunks of ``CHUNK``
characters, chunks are mapped, and the maps of one text are composed by a scan of
two levels: ``FAN`` chunks to a block in the task that maps them, then, after a
shuffle of the maps alone, blocks to the text.

Defined results: null is an empty text, with 0 bytes and 0 tokens; rows are one
for one with the input, repeated rows, null and repeated ids included; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from functools import cache, lru_cache, reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import text_of

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
CHUNK, FAN = 1 << 16, 256
_MEMO = 400_000    # words remembered by a worker
_STATES = 300_000  # states kept by a worker, some 250 MB

# Parts between resets. Spaces are kept as they are; the model's own mark for
# a space is turned into one beforehand, as the model does the reverse.
_PARTS = re.compile(r" *[^ \n]+|\n| +")


class _Known(dict):
    """Counts of parts, made by ``run`` when first asked for; the first _MEMO
    short ones are kept, which the frequent ones are among."""

    def __init__(self, run):
        self.run = run

    def __missing__(self, part: str) -> int:
        n = self.run(part)
        if len(part) <= 64 and len(self) < _MEMO:
            self[part] = n
        return n


class Transducer:
    """The machine of one vocabulary: ``pieces`` maps a piece to its merge rank
    (lower first); other characters are emitted as their UTF-8 bytes."""

    def __init__(self, pieces: dict[str, int]):
        self.pieces = pieces
        self.stems = {p[:k] for p in pieces for k in range(1, len(p))}
        self.states: dict[tuple, dict] = {}
        self.initial = self._state("", ((None, 0),))
        self.parts = _Known(self.run)
        # Words that follow a single space, which the key leaves out.
        self.words = _Known(lambda w: sum(map(self.run, _PARTS.findall(" " + w))))

    def _state(self, open_: str, history: tuple) -> dict:
        """The state's transitions (character to (state, emitted)), made empty.
        ``history[k]`` is (last token, tokens emitted less than now) k characters
        into ``open_``."""
        key = (open_, history)
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = {}
            found[None] = key
        return found

    @lru_cache(maxsize=1 << 18)  # noqa: B019  (one machine a worker and model)
    def stands(self, left: str | None, right: str) -> bool:
        """Whether the tokens of the joined characters are just these two: the
        merges that made them are undone at the border, the latest first, and
        a merge across the border that comes before one of them (or ties with
        it further left) disproves it."""
        if self.halves(right) is None or left is None:
            return self.halves(right) is not None
        earlier = float("inf")
        while True:
            across = self.pieces.get(left + right)
            if across is not None and across < earlier:
                return False
            made_left = self.pieces[left] if len(left) > 1 else -1
            made_right = self.pieces[right] if len(right) > 1 else -1
            if made_left == made_right == -1:
                return True
            if made_left > made_right:
                earlier, left = made_left, self.halves(left)[1]
            else:
                earlier, right = made_right + 0.5, self.halves(right)[0]

    @cache  # noqa: B019
    def halves(self, piece: str) -> tuple[str, str] | None:
        """The two parts whose merge makes the piece (itself for a character);
        None if its characters merge into something else."""
        parts, before = list(piece), [piece, piece]
        while len(parts) > 1:
            best = min(((self.pieces[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:]))
                        if a + b in self.pieces), default=None)
            if best is None:
                return None
            before, k = parts[:], best[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return before[0], before[-1]

    def _compile(self, state: dict, char: str) -> tuple[dict, int]:
        open_, history = state[None]
        if len(self.states) >= _STATES:  # compiled anew as needed; the caller's path goes on
            self.states = {}
            self.initial = self._state("", ((None, 0),))
        if char not in self.pieces:  # emitted as bytes, and spanned by no piece
            step = (self.initial, len(char.encode("utf-8", "surrogatepass")))
            state[char] = step
            return step
        read = open_ + char
        for k, (token, less) in enumerate(history):
            piece = read[k:]
            if piece in self.pieces and self.stands(token, piece):
                break
        else:
            raise ValueError(f"no token ends in {read!r}")
        emitted = 1 - less
        after = [(t, less_ + emitted) for t, less_ in history] + [(piece, 0)]
        while read and read not in self.stems:
            read = read[1:]
        step = (self._state(read, tuple(after[len(after) - 1 - len(read):])), emitted)
        state[char] = step
        return step

    def run(self, part: str) -> int:
        """Tokens of a part between resets."""
        state, count = self.initial, 0
        for char in part:
            step = state.get(char)
            if step is None:
                step = self._compile(state, char)
            state, emitted = step
            count += emitted
        return count

    def count(self, text: str) -> int:
        """Tokens of characters that begin and end at resets."""
        if "  " in text:
            return sum(map(self.parts.__getitem__, _PARTS.findall(text)))
        head, space, rest = text.partition(" ")
        total = sum(map(self.parts.__getitem__, _PARTS.findall(head)))
        return total + sum(map(self.words.__getitem__, rest.split(" "))) if space else total

    def chunk(self, text: str) -> tuple[str, int, str, bool]:
        """The state map of a chunk: head, count, tail, whether it has a reset."""
        first = _PARTS.match(text)
        if first is None or first.end() == len(text):
            return text, 0, "", False
        # the last part begins after the last border
        at = max(text.rfind("\n"), text.rfind(" "))
        if at < first.end():
            return text[:first.end()], 0, text[first.end():], True
        if text[at] == "\n":
            last = at + 1 if at + 1 < len(text) else at
        else:
            last = at
            while last > first.end() and text[last - 1] == " ":
                last -= 1
        return text[:first.end()], self.count(text[first.end():last]), text[last:], True

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The map of two neighbouring chunks as one."""
        head_a, count_a, tail_a, reset_a = a
        head_b, count_b, tail_b, reset_b = b
        if not reset_a and not reset_b:
            return self.chunk(head_a + head_b)
        if not reset_a:
            head = self.chunk(head_a + head_b)
            if not head[3]:
                return head[0], count_b, tail_b, True
            return head[0], head[1] + self.count(head[2]) + count_b, tail_b, True
        if not reset_b:
            tail = self.chunk(tail_a + head_b)
            if not tail[3]:
                return head_a, count_a, tail[0], True
            return head_a, count_a + self.count(tail[0]) + tail[1], tail[2], True
        return head_a, count_a + self.count(tail_a + head_b) + count_b, tail_b, True

    def total(self, a: tuple) -> int:
        return self.count(a[0]) + a[1] + self.count(a[2])


_MACHINES: dict[str, Transducer] = {}


def machine(model: str = MODEL) -> Transducer:
    """The transducer of a sentencepiece byte-pair model with byte fallback,
    identity normalisation and a space put before the text."""
    if model not in _MACHINES:
        import public_tokenizers
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
        pieces = {}
        for i in range(sp.get_piece_size()):
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)):
                pieces[sp.id_to_piece(i).replace("▁", " ")] = -sp.get_score(i)
        if any("\n" in p or re.search(r"[^ ] ", p) for p in pieces):
            raise ValueError("a piece spans a reset")
        _MACHINES[model] = Transducer(pieces)
    return _MACHINES[model]


_MAP = ["head", "count", "tail", "reset"]
_MAP_TYPES = [pa.string(), pa.int64(), pa.string(), pa.bool_()]


def _map_chunks(model: str, chunk: int, fan: int):
    """Columns text, kept...: the maps of each text's blocks (``fan`` chunks,
    composed where they are made), one row a block."""
    def run(batches):
        m = machine(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                take, place, maps = [], [], []
                for k, text in enumerate(part.column(0).to_pylist()):
                    text = " " + text.replace("▁", " ") if text else ""
                    for block in range(0, max(1, len(text)), chunk * fan):
                        end = min(len(text), block + chunk * fan)
                        parts = [m.chunk(text[c:min(end, c + chunk)]) for c in range(block, max(end, block + 1), chunk)]
                        take.append(k)
                        place.append(block // (chunk * fan))
                        maps.append(reduce(m.compose, parts))
                rest = part.select(part.schema.names[1:]).take(pa.array(take, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*rest.columns, pa.array(place, pa.int32()),
                     *[pa.array(c, t) for c, t in zip(zip(*maps), _MAP_TYPES)]],
                    names=[*rest.schema.names, "place", *_MAP])
    return run


def _scan_blocks(model: str):
    """Columns id, doc_id, n_bytes, map; the blocks of an id stand together and
    in order. Gives doc_id, n_bytes, n_tokens of each id."""
    def run(batches):
        m = machine(model)
        held, kind = None, None
        for batch in batches:
            kind, out = batch.schema.field(1).type, []
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if held is not None and held[0] == row[0]:
                    held = (*held[:3], *m.compose(held[3:], row[3:]))
                    continue
                if held is not None:
                    out.append((*held[1:3], m.total(held[3:])))
                held = row
            if out:
                yield done(out, kind)
        if held is not None:
            yield done([(*held[1:3], m.total(held[3:]))], kind)

    def done(out, kind):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), (kind, pa.int64(), pa.int64()))],
            names=["doc_id", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, model: str = MODEL, limit: int = LIMIT, chunk: int = CHUNK,
                 fan: int = FAN) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row."""
    ship_package(docs.sparkSession)
    text = text_of(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(text.alias("text"), F.monotonically_increasing_id().alias("id"), "doc_id",
                       F.octet_length(text).cast("long").alias("n_bytes"))
    maps = rows.mapInArrow(
        _map_chunks(model, chunk, fan),
        f"id bigint, doc_id {kind}, n_bytes bigint, place int, "
        "head string, count bigint, tail string, reset boolean")
    counted = (maps.repartition("id").sortWithinPartitions("id", "place").drop("place")
               .mapInArrow(_scan_blocks(model), f"doc_id {kind}, n_bytes bigint, n_tokens bigint"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
