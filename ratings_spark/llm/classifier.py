"""Quality classifier by positive-unlabelled learning.

Trusted positives are the labelled good rows of the training folds; the
unlabelled side is web text without any label. The class prior is estimated
from the two samples alone, and a logistic model over text measurements is
fitted to the non-negative unbiased risk

    prior * R_P(+) + max(0, R_U(-) - prior * R_P(-))

Bad labels are never used, nor are language, source or doc_id as inputs.
Measurements are taken from whole texts of all documents. Their mean and scale and
the prior's shares cover all unlabelled rows, by aggregation; only the descent
uses a bounded sample, at most ``FIT_ROWS`` rows a side, drawn by the hash of doc_id.

Defined results: null counts as empty, an empty text is scored as its (zero)
measurements say; a doc_id with several label rows counts as positive only if
all of them are good, and null labels count as none; without positives or
unlabelled rows the score is 0.5 (kept) for all. Rows are one for one with the
input, repeated rows included; a null doc_id is never in the training folds.
"""

from __future__ import annotations

import math
import operator
import string
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from .common import text_of

FIT_ROWS = 20_000  # of positives, and as many unlabelled
_UPPER = string.ascii_uppercase.encode()
_LOWER = string.ascii_lowercase.encode()
_DIGIT = string.digits.encode()
_SPACE = b" \t\n\r\x0b\x0c"
_SENTENCE = b".,;:?"
_SYMBOL = b"#$%&*@^~=+<>{}[]\\/_`"
_HIGH = bytes(range(128, 256))

FEATURES = ("log_words", "mean_word", "upper", "digit", "sentence", "symbol", "bang", "bar", "high",
            "distinct", "adjacent", "run", "line_repeat", "words_a_line", "shouting", "marked")


def measure(text: bytes) -> list[float]:
    """FEATURES of one text."""
    share = 1.0 / max(1, len(text))

    def part(chars: bytes) -> float:
        return (len(text) - len(text.translate(None, chars))) * share

    words = text.split()
    n = len(words)
    each = 1.0 / max(1, n)
    lines = [x for x in text.split(b"\n") if x.strip()]
    same = list(map(operator.eq, words, words[1:]))
    # Lengths of runs of one word: the longest, as a share of the text.
    longest = max(map(len, bytes(same).split(b"\0")), default=0)
    bare = text.translate(None, _LOWER + _DIGIT + _HIGH)  # letters gone, spaces kept
    shouted = len(bare.split())  # words with a capital or a mark
    return [math.log1p(n), sum(map(len, words)) * each / 10, part(_UPPER), part(_DIGIT),
            part(_SENTENCE), part(_SYMBOL), part(b"!"), part(b"|"), part(_HIGH),
            len(set(words)) * each, sum(same) * each, longest * each,
            1 - len(set(lines)) / max(1, len(lines)), math.log1p(n / max(1, len(lines))),
            part(_UPPER) / max(1e-9, part(_UPPER) + part(_LOWER)), shouted * each]


def in_training_fold(doc_id: Column) -> Column:
    """Rows whose labels may be learnt: crc32 of the id's text, modulo 3, is not 1."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def _append_features(batches):
    for batch in batches:
        x = np.array([measure(t.as_py() or b"") for t in batch.column(0).cast(pa.large_binary())],
                     np.float32).reshape(batch.num_rows, len(FEATURES))
        lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, len(FEATURES), dtype=np.int32),
                                         pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], lists],
                                         names=[*batch.schema.names[1:], "x"])


def features(docs: DataFrame) -> DataFrame:
    """doc_id and x, the FEATURES of the whole text."""
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select(text_of(docs).alias("text"), "doc_id")
            .mapInArrow(_append_features, f"doc_id {kind}, x array<float>"))


@dataclass(frozen=True)
class Model:
    """Standardised measurements, their squares, and a logistic score."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last is the intercept
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return _basis(x, self.mean, self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margin(x))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


# Deviations count up to this many scales: beyond, squares would carry the few rows
# far out. Chosen among 2, 3, 4 and 6 on labels of the training folds.
_REACH = 2


def _basis(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((np.asarray(x, np.float64) - mean) / scale, -_REACH, _REACH)
    return np.hstack([z, z * z, np.ones((len(z), 1))])


# Of the prior's confidence terms, as published with the estimator: how often
# they may fail, and the slack that makes the choice of a threshold stable.
_FAIL, _SLACK = 0.1, 0.01


def thresholds(p: np.ndarray, n: int = 200) -> np.ndarray:
    """Scores above which shares of ``p`` from all down to 1 / n lie, ascending."""
    return np.quantile(p, np.arange(n) / n)


def best_bin(above_p: np.ndarray, above_u: np.ndarray, n_p: int, n_u: int) -> float:
    """Share of positives among the unlabelled, from the shares of both above some
    thresholds. The unlabelled share is at least prior times the positives' share
    everywhere, so each ratio bounds the prior from above; the ratio is taken where
    it is least with its confidence terms, which weigh more the fewer positives a
    threshold keeps. No range of thresholds is set beforehand."""
    noise = math.sqrt(math.log(4 / _FAIL) / (2 * n_u)) + math.sqrt(math.log(4 / _FAIL) / (2 * n_p))
    kept = np.maximum(above_p, 1e-9)
    at = int(np.argmin(above_u / kept + (1 + _SLACK) * noise / kept))
    return float(np.clip(above_u[at] / kept[at], 0.05, 0.99))


def _descend(gradient, width: int, steps: int = 400, rate: float = 0.1) -> np.ndarray:
    """Adam with a fixed number of full-batch steps: the same rows, the same model."""
    w, m, v = np.zeros(width), np.zeros(width), np.zeros(width)
    for t in range(1, steps + 1):
        g = gradient(w) + 1e-4 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def risk_parts(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, float]:
    """prior * R_P(+), and R_U(-) - prior * R_P(-), of logistic loss."""
    zp, zu = p @ w, u @ w
    return (float(prior * np.logaddexp(0, -zp).mean()),
            float(np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()))


def risk_slope(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> np.ndarray:
    """Slope to descend: of both parts together, or, where the second is below
    zero (overfitted), of its negative, so that it climbs back."""
    zp, zu = p @ w, u @ w
    down = u.T @ _sigmoid(zu) / len(u) - prior * (p.T @ _sigmoid(zp) / len(p))
    if risk_parts(w, p, u, prior)[1] < 0:
        return -down
    return down - prior * (p.T @ _sigmoid(-zp) / len(p))


class Sample:
    """Statistics of unlabelled rows held in an array."""

    def __init__(self, x: np.ndarray):
        self.x = np.asarray(x, np.float64)

    def moments(self) -> tuple[np.ndarray, np.ndarray]:
        return self.x.mean(axis=0), self.x.std(axis=0)

    def above(self, models: list[Model], t: np.ndarray) -> tuple[int, np.ndarray]:
        return len(self.x), _count_above(models, self.x, t)


class Corpus:
    """The same statistics of all rows of a table of measurements, aggregated in Spark."""

    def __init__(self, rows: DataFrame):
        self.rows = rows

    def moments(self) -> tuple[np.ndarray, np.ndarray]:
        each = [F.col("x")[i].cast("double") for i in range(len(FEATURES))]
        row = self.rows.agg(*map(F.avg, each), *map(F.stddev_pop, each)).first()
        # Single precision: sums of partitions may come in any order.
        both = np.array(row, np.float32).astype(np.float64)
        return both[:len(each)], both[len(each):]

    def above(self, models: list[Model], t: np.ndarray) -> tuple[int, np.ndarray]:
        def count(batches):
            n, above = 0, np.zeros(t.shape[1], np.int64)
            for batch in batches:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
                n += len(x)
                above += _count_above(models, x, t)
            yield pa.RecordBatch.from_pydict({"n": pa.array([n]), "above": pa.array([above.tolist()])})

        ship_package(self.rows.sparkSession)
        counts = self.rows.select("x").mapInArrow(count, "n long, above array<long>")
        row = counts.agg(F.sum("n"), *[F.sum(F.col("above")[i]) for i in range(t.shape[1])]).first()
        return row[0], np.array(row[1:], np.int64)


def half_of(x: np.ndarray) -> np.ndarray:
    """0 or 1 by the bytes of a row's measurements: equal rows share a half."""
    return np.array([zlib.crc32(r.tobytes()) & 1 for r in np.asarray(x, np.float32)], np.int64)


def _count_above(models: list[Model], x: np.ndarray, t: np.ndarray) -> np.ndarray:
    """How many rows' margins reach each column of ``t``; the model and the row of
    ``t`` are those of the row's half."""
    half, out = half_of(x), np.zeros(t.shape[1], np.int64)
    for j, model in enumerate(models):
        margin = np.sort(model.margin(x[half == j]))
        out += len(margin) - np.searchsorted(margin, t[j])
    return out


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, mean: np.ndarray, scale: np.ndarray,
                   corpus: Sample | Corpus) -> float:
    """Class prior, read from margins between positives and unlabelled. Each half
    of the rows is judged by a model fitted to drawn rows of the other half, so that
    no row's own part in a fit moves the shares."""
    halves = half_of(positive), half_of(unlabelled)
    if min(len(set(h.tolist())) for h in halves) < 2:  # too few rows to keep any back
        halves = tuple(np.full(len(h), -1) for h in halves)
    models, t, reached = [], [], 0
    for j in (0, 1):
        p, u = (_basis(x[h != j], mean, scale) for x, h in zip((positive, unlabelled), halves))

        def apart(w, p=p, u=u):
            return (-p.T @ _sigmoid(-(p @ w)) / len(p) + u.T @ _sigmoid(u @ w) / len(u)) / 2

        models.append(Model(mean, scale, _descend(apart, p.shape[1]), 0.0))
        own = halves[0] == j
        margin = models[j].margin(positive[own] if own.any() else positive)
        t.append(thresholds(margin))
        reached = reached + (margin[:, None] >= t[j][None, :]).sum(axis=0)
    n, above = corpus.above(models, np.array(t))
    return best_bin(reached / reached[0], above / n, int(reached[0]), n)


def fit(positive: np.ndarray, unlabelled: np.ndarray, corpus: Sample | Corpus | None = None) -> Model:
    """The model of least non-negative unbiased risk. ``unlabelled`` is what the
    descent sees; mean, scale and prior are those of ``corpus`` (as default the
    same rows)."""
    corpus = corpus or Sample(unlabelled)
    mean, scale = corpus.moments()
    scale = scale + 1e-6
    prior = estimate_prior(positive, unlabelled, mean, scale, corpus)
    p, u = _basis(positive, mean, scale), _basis(unlabelled, mean, scale)
    return Model(mean, scale, _descend(lambda w: risk_slope(w, p, u, prior), p.shape[1]), prior)


def train(measured: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model | None:
    """A model from ``features`` rows and the labels of the training folds."""
    marks = (labels.groupBy("doc_id")
             .agg(F.min("quality").alias("least"), F.count("quality").alias("marks")))
    rows = measured.where("doc_id IS NOT NULL").join(marks, "doc_id", "left")
    sides = {
        "P": rows.where(in_training_fold(F.col("doc_id")) & (F.col("least") == 1)),
        "U": rows.where("marks IS NULL OR marks = 0"),
    }
    drawn = {}
    for side, r in sides.items():
        low = r.select(F.xxhash64(F.lit(side), "doc_id").alias("draw"), "x").orderBy("draw", "x").limit(fit_rows)
        drawn[side] = np.array([x["x"] for x in low.toLocalIterator()], np.float32).reshape(-1, len(FEATURES))
    if not all(map(len, drawn.values())):
        return None
    return fit(drawn["P"], drawn["U"], Corpus(sides["U"]))


def _append_score(model: Model | None):
    def run(batches):
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            s = model.score(x) if model is not None else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(s, pa.float64())],
                                             names=[*batch.schema.names[1:], "score"])
    return run


def score(measured: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score, predicted for each measured row."""
    ship_package(measured.sparkSession)
    kind = measured.schema["doc_id"].dataType.simpleString()
    rows = measured.select("x", "doc_id").mapInArrow(_append_score(model), f"doc_id {kind}, score double")
    return rows.select("doc_id", (~F.coalesce(in_training_fold(F.col("doc_id")), F.lit(True))).alias("held_out"),
                       "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Scores of all documents by a model of their own corpus."""
    measured = materialize(features(docs), "quality-features")
    return score(measured, train(measured, labels, fit_rows))


def _verdict(model: Model | None):
    """Column function: whether a text is predicted good."""
    @F.arrow_udf("boolean")
    def good(texts: pa.Array) -> pa.Array:
        if model is None:
            return pa.array(np.ones(len(texts), bool))
        x = np.array([measure(t.as_py() or b"") for t in texts.cast(pa.large_binary())],
                     np.float32).reshape(len(texts), len(FEATURES))
        return pa.array(model.score(x) >= 0.5)
    return good


def keep_good(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` predicted good, with all their columns. Texts are
    read and measured twice rather than shuffled to their scores, and only they
    go through Python."""
    measured = materialize(features(docs), "quality-features")
    return docs.where(_verdict(train(measured, labels, fit_rows))(text_of(docs)))
