"""Language identification with a string kernel.

The kernel of two texts is the blended spectrum kernel on presence: the number of
character n-grams (n = 1 to ``SPECTRUM``) that both hold, over the root of the product
of how many each holds. Texts are lower-cased first, and every run of characters that
are no letters becomes one space, with one at either end.

The kernel is approximated by Nyström's method: ``LANDMARKS`` training texts, as many
of each language, stand for the rest; a text's features are its kernels with them,
times the inverse root of their kernels with each other. On these features one ridge
regression a language tells its texts from all others. Scoring needs a text's presence
of the landmarks' n-grams only: a batch of texts is a matrix of presences, multiplied
with that of the landmarks, block by block of n-grams, and then with the weights.

Bounded samples: landmarks, and at most ``FIT_ROWS`` training texts, as many of each
language, for the regression, both drawn by a hash of doc_id and text. Landmarks have at most
``LANDMARK_CHARS`` characters (those of fewer than 200 are drawn last). Everything
else covers all rows and whole texts; long texts are worked through in pieces that
overlap by the longest n-gram, so memory follows the distinct n-grams of a text.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is
every text if nothing can be learnt (no training text with a letter, no landmark); rows
whose lang is null or whose doc_id is null teach nothing, and a null doc_id is not held
out. A single learnt language is predicted for all texts with a letter. Ties go to the
language first by code point. Rows are one for one with the input, repeated rows
included; an empty table gives an empty table. Other columns are not looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, ship_package

SPECTRUM = 3  # n-grams of up to three characters: their code points fit in 63 bits
LANDMARKS = 128
LANDMARK_CHARS = 20_000
FIT_ROWS = 4_000
RIDGE = 1e-3
UNDETERMINED = "und"
_PIECE = 1 << 20  # characters of a text looked at together
_BATCH = 256      # texts in a matrix of presences
_GRAMS = 8192     # n-grams in it
_OTHER = re.compile(r"[\W\d_]+")


def in_training_fold(doc_id: Column) -> Column:
    """Rows that may be learnt from: crc32 of the id's text, modulo 4, is not 2."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2


def _distinct(ordered: np.ndarray) -> np.ndarray:
    return ordered[np.concatenate(([True], ordered[1:] != ordered[:-1]))] if len(ordered) else ordered


def spectrum(text: str) -> list[np.ndarray]:
    """Sorted codes of the distinct n-grams of a text, one array for each n; 21 bits
    a character. Only the longest are sorted: shorter ones are their beginnings, as
    the text is followed by zeros (no n-gram of its own holds one)."""
    bare = " " + _OTHER.sub(" ", text.lower()).strip() + " " + "\0" * (SPECTRUM - 1)
    longest = np.zeros(0, np.uint64)
    for at in range(0, len(bare) - SPECTRUM + 1, _PIECE):
        points = np.frombuffer(bare[at:at + _PIECE + SPECTRUM - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
        code = np.zeros(len(points) - SPECTRUM + 1, np.uint64)
        for k in range(SPECTRUM):
            code = (code << np.uint64(21)) | points[k:k + len(code)]
        code = _distinct(np.sort(code))
        longest = np.union1d(longest, code) if len(longest) else code
    out = []
    for _ in range(SPECTRUM):
        out.append(longest[longest & np.uint64((1 << 21) - 1) != 0])
        longest = _distinct(longest >> np.uint64(21))
    return out[::-1]


def kernel(a: list[np.ndarray], b: list[np.ndarray]) -> float:
    """Normalised blended spectrum kernel of two spectra, as defined."""
    both = sum(len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(a, b))
    size = sum(map(len, a)) * sum(map(len, b))
    return both / np.sqrt(size) if size else 0.0


@dataclass(frozen=True)
class Landmarks:
    """N-grams of the landmarks (one sorted array a length) and who holds which:
    a bit matrix of n-grams and landmarks, the lengths one after the other."""

    codes: list[np.ndarray]
    holds: np.ndarray   # packed bits, one row an n-gram
    sizes: np.ndarray   # n-grams of each landmark

    @staticmethod
    def of(spectra: list[list[np.ndarray]]) -> "Landmarks":
        codes = [np.unique(np.concatenate([s[k] for s in spectra])) for k in range(SPECTRUM)]
        rows = []
        for k, known in enumerate(codes):
            bits = np.zeros((len(known), len(spectra)), bool)
            for j, s in enumerate(spectra):
                bits[np.searchsorted(known, s[k]), j] = True
            rows.append(np.packbits(bits, axis=1))
        return Landmarks(codes, np.vstack(rows), np.array([sum(map(len, s)) for s in spectra], np.float64))

    def present(self, spectrum: list[np.ndarray]) -> np.ndarray:
        """Row numbers in ``holds`` of the n-grams of a text."""
        found, first = [], 0
        for known, code in zip(self.codes, spectrum):
            at = np.searchsorted(known, code)
            at[at == len(known)] = 0
            found.append(at[known[at] == code] + first)
            first += len(known)
        return np.concatenate(found)

    def kernels(self, texts: list[str]) -> np.ndarray:
        """Kernels of texts (rows) with the landmarks (columns)."""
        out = np.zeros((len(texts), len(self.sizes)))
        for lo in range(0, len(texts), _BATCH):
            ids, size = [], []
            for t in texts[lo:lo + _BATCH]:
                s = spectrum(t)
                size.append(sum(map(len, s)))
                ids.append(self.present(s))
            row = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
            col = np.concatenate(ids)
            shared = np.zeros((len(ids), len(self.sizes)), np.float32)
            for first in range(0, len(self.holds), _GRAMS):
                block = np.unpackbits(self.holds[first:first + _GRAMS], axis=1, count=len(self.sizes))
                inside = (col >= first) & (col < first + len(block))
                presence = np.zeros((len(ids), len(block)), np.float32)
                presence[row[inside], col[inside] - first] = 1
                shared += presence @ block.astype(np.float32)
            out[lo:lo + _BATCH] = shared / np.sqrt(np.maximum(1, np.outer(size, self.sizes)))
        return out


@dataclass(frozen=True)
class Model:
    landmarks: Landmarks
    weights: np.ndarray  # landmarks + 1 (the intercept), by language
    langs: list[str]

    def scores(self, texts: list[str]) -> np.ndarray:
        """Regression values of texts, one column a language (1: is it; 0: is not)."""
        k = self.landmarks.kernels(texts)
        return k @ self.weights[:-1] + self.weights[-1]


def fit(landmarks: Landmarks, kernels: np.ndarray, langs: list[str], ridge: float = RIDGE) -> Model:
    """Ridge regressions, one a language, on Nyström features of training rows.

    ``kernels`` are those of the rows with the landmarks. Rows are weighed so that
    each language counts the same; the map to features is folded into the weights."""
    m = len(landmarks.sizes)
    bits = np.unpackbits(landmarks.holds, axis=1, count=m).astype(np.float32)
    own = (bits.T @ bits) / np.sqrt(np.maximum(1, np.outer(landmarks.sizes, landmarks.sizes)))
    values, vectors = np.linalg.eigh(own.astype(np.float64))
    sound = values > 1e-6 * values.max()
    root = vectors[:, sound] / np.sqrt(values[sound])
    x = np.hstack([kernels @ root, np.ones((len(kernels), 1))])
    names = sorted(set(langs))
    y = np.array([[float(a == b) for b in names] for a in langs])
    share = (y / np.maximum(1, y.sum(axis=0))).sum(axis=1) / len(names)
    gram = (x * share[:, None]).T @ x
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-9  # the intercept is free
    w = np.linalg.solve(gram + np.diag(penalty), (x * share[:, None]).T @ y)
    return Model(landmarks, np.vstack([root @ w[:-1], w[-1:]]), names)


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, text, lang and whether the text can be told (it has a letter)."""
    text = docs["text"].cast("string")
    return docs.select("doc_id", text.alias("text"), docs["lang"].cast("string").alias("lang"),
                       F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("told"))


def _draw(rows: DataFrame, tag: str, each: int, kinds: tuple[str, ...] = ()) -> DataFrame:
    """Up to ``each`` texts a language, those of least hash, first of the first
    ``kinds`` (true before false). Languages and kinds are counted first, and a hash
    below twice the share that is wanted lets a text on; so only few rows travel.
    Copies have one hash and are drawn once."""
    rows = rows.withColumn("draw", F.xxhash64(F.lit(tag), "doc_id", "text"))
    group = ["lang", *kinds]
    # One row a language and kind, as the model has a column a language.
    sizes = rows.groupBy(*group).agg(F.approx_count_distinct("draw", 0.05).alias("n")).collect()
    if not sizes:
        return rows.select("lang", "text")
    span = 2 ** 64
    cuts = [(*[r[g] for g in group], min(span // 2 - 1, -span // 2 + span * 2 * (each + 8) // r["n"])) for r in sizes]
    schema = ", ".join(f"{g} {rows.schema[g].dataType.simpleString()}" for g in group)
    cuts = F.broadcast(rows.sparkSession.createDataFrame(cuts, f"{schema}, cut bigint"))
    found = (rows.join(cuts, group).where(F.col("draw") <= F.col("cut"))
             .groupBy(*group, "draw").agg(F.min("text").alias("text")))
    w = Window.partitionBy("lang").orderBy(*[F.desc(k) for k in kinds], "draw")
    return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= each).select("lang", "text")


def _emit_spectra(batches):
    for batch in batches:
        parts = [[s.tobytes() for s in spectrum(t.as_py())] for t in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.list_(pa.binary()))], names=["spectrum"])


def _emit_kernels(landmarks: Landmarks):
    def run(batches):
        for batch in batches:
            k = landmarks.kernels([t.as_py() for t in batch.column(0)]).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([row.tobytes() for row in k], pa.binary())], names=["lang", "k"])
    return run


def train(docs: DataFrame, landmarks: int = LANDMARKS, fit_rows: int = FIT_ROWS) -> Model | None:
    """A model of the languages of the training folds of ``docs``; None if there
    is nothing to learn."""
    ship_package(docs.sparkSession)
    rows = _rows(docs).where(F.col("told") & F.col("lang").isNotNull() & in_training_fold(F.col("doc_id")))
    langs = rows.select("lang").distinct().count()
    if not langs:
        return None
    size = F.length("text")
    marks = _draw(rows.where(size <= LANDMARK_CHARS).withColumn("full", size >= 200), "landmark",
                  max(1, landmarks // langs), ("full",))
    marks = marks.select("text").mapInArrow(_emit_spectra, "spectrum array<binary>").toLocalIterator()
    spectra = [[np.frombuffer(x, np.uint64) for x in s]  # sorted: the same rows, the same model
               for s in sorted([bytes(x) for x in r["spectrum"]] for r in marks)]
    if not spectra:
        return None
    base = Landmarks.of(spectra)
    # Written out, so that the few texts are spread over tasks before they are measured.
    drawn = materialize(_draw(rows, "fit", max(1, fit_rows // langs)).select("text", "lang")
                        .repartition(2 * docs.sparkSession.sparkContext.defaultParallelism), "language-rows")
    taught = drawn.mapInArrow(_emit_kernels(base), "lang string, k binary").toLocalIterator()
    names, kernels = zip(*sorted((r["lang"], bytes(r["k"])) for r in taught))
    return fit(base, np.array([np.frombuffer(k, np.float32) for k in kernels], np.float64), list(names))


def _append_prediction(model: Model | None):
    def run(batches):
        for batch in batches:
            told = np.array(batch.column(1).to_pylist(), bool)
            names = np.full(batch.num_rows, UNDETERMINED, object)
            score = np.zeros(batch.num_rows)
            at = np.flatnonzero(told) if model is not None else np.zeros(0, int)
            for lo in range(0, len(at), _BATCH):
                part = at[lo:lo + _BATCH]
                values = model.scores([batch.column(0)[int(k)].as_py() for k in part])
                names[part] = np.array(model.langs, object)[values.argmax(axis=1)]
                score[part] = np.clip(values.max(axis=1), 0, 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], pa.array(names, pa.string()), pa.array(score, pa.float64())],
                names=[*batch.schema.names[2:], "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row."""
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = _rows(docs).select("text", "told", "doc_id")
    out = rows.mapInArrow(_append_prediction(model), f"doc_id {kind}, lang_pred string, score double")
    return out.select("doc_id", (~F.coalesce(in_training_fold(F.col("doc_id")), F.lit(True))).alias("held_out"),
                      "lang_pred", "score")


def languages(docs: DataFrame, landmarks: int = LANDMARKS, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Predictions for all documents by a model of their own corpus."""
    return predict(docs, train(docs, landmarks, fit_rows))
