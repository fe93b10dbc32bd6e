"""ratings_spark: item-rating analytics on Spark DataFrames, Spark ML and
Structured Streaming.

Sub-packages:

* ``sources``   -- table readers/writers, text-line parsers, driver-table adapters
* ``functions`` -- column-expression helpers (dates, vectors, list encoding)
* ``operators`` -- DataFrame -> DataFrame building blocks (stats, top-k,
  similarity, factor scoring, ALS, re-ranking)
* ``plans``     -- end-to-end jobs and the named query catalogue
* ``streaming`` -- message stream, per-user recent-ratings state, re-rank sink
"""

from ratings_spark.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
__version__ = "0.1.0"
