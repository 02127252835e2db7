"""Language identification with a string kernel.

A piece of text is the set of its character n-grams of 1 to MOST_N code points (blended spectrum, presence only), hashed into DIMENSIONS
positions. Texts are cut into windows of about WINDOW code points, all of them used, so that long texts don't fill the set. The kernel of two pieces is
the number of shared n-grams over the geometric mean of their set sizes. Nyström landmarks (a bounded sample for each language) turn kernel ridge regression, one
language against the rest, into a small linear system: with C the kernel of training rows and landmarks and W that of the landmarks, the coefficients solve
(C'C + ridge W) a = C'y. Scoring is batched matrix products: presence matrix x landmark matrix, then x coefficients, and the mean over the windows of a text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import persisted

DIMENSIONS = 1 << 13
MOST_N = 4
WINDOW = 4096
UNDETERMINED = "und"
#: Rows of one presence matrix: 64 x 8192 floats are 2 MB.
BATCH = 64


def spectra(text: str) -> list[np.ndarray]:
    """Sorted hashed n-grams of every window of the text, lower-cased, every run of white space as one space."""
    code = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out = []
    for part in np.array_split(code, max(1, round(len(code) / WINDOW))):
        seen = np.zeros(DIMENSIONS, bool)
        h = np.zeros(len(part), np.uint64)
        for n in range(1, min(MOST_N, len(part)) + 1):
            h = h[: len(part) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + part[n - 1 :] + np.uint64(1)
            mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            seen[(mixed >> np.uint64(64 - 13)).astype(np.int64)] = True
        out.append(np.flatnonzero(seen).astype(np.int16))
    return out


def presence(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, DIMENSIONS) rows of equal weights and unit length."""
    out = np.zeros((len(sets), DIMENSIONS), np.float32)
    for k, s in enumerate(sets):
        if len(s):
            out[k, s] = len(s) ** -0.5
    return out


@dataclass(frozen=True)
class SpectrumKernelModel:
    languages: list[str]
    landmarks: np.ndarray  # (DIMENSIONS, landmarks)
    coefficients: np.ndarray  # (landmarks, languages)

    def values(self, sets: list[np.ndarray]) -> np.ndarray:
        """Regression values, which aim at 1 and 0, for every set and language."""
        parts = [presence(sets[at : at + BATCH]) @ self.landmarks @ self.coefficients for at in range(0, len(sets), BATCH)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.languages)))

    def predict(self, texts: list[list[np.ndarray]]) -> tuple[list[str], np.ndarray]:
        """Languages and scores in 0..1 (softmax of the mean values over a text's windows)."""
        if not self.languages or not texts:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        counts = np.array([len(t) for t in texts])
        values = np.add.reduceat(self.values([s for t in texts for s in t]), counts.cumsum() - counts) / counts[:, None]
        e = np.exp(8 * (values - values.max(1, keepdims=True)))
        p = e / e.sum(1, keepdims=True)
        best = p.argmax(1)
        return [self.languages[k] for k in best], p[np.arange(len(p)), best].astype(float)


def fit(sets: list[np.ndarray], languages: list[str], landmarks_each: int, ridge: float) -> SpectrumKernelModel:
    """Kernel ridge regression; the first landmarks_each rows of every language are the landmarks."""
    rows_of = Counter(languages)
    names = sorted(rows_of)
    if not names:
        return SpectrumKernelModel([], np.zeros((DIMENSIONS, 0), np.float32), np.zeros((0, 0), np.float32))
    picked, taken = [], Counter()
    for k, name in enumerate(languages):
        taken[name] += 1
        if taken[name] <= landmarks_each:
            picked.append(k)
    marks = presence([sets[k] for k in picked]).T.copy()
    w = (marks.T @ marks).astype(float)
    left, right = np.zeros_like(w), np.zeros((len(picked), len(names)))
    column = {name: k for k, name in enumerate(names)}
    for at in range(0, len(sets), BATCH):
        c = (presence(sets[at : at + BATCH]) @ marks).astype(float)
        part = languages[at : at + BATCH]
        y = np.zeros((len(part), len(names)))
        y[np.arange(len(part)), [column[x] for x in part]] = 1
        # Every language weighs the same, however many rows it has.
        weight = np.array([1 / rows_of[x] for x in part])[:, None] * len(languages) / len(names)
        left += c.T @ (c * weight)
        right += c.T @ (y * weight)
    system = left + ridge * w + 1e-6 * np.trace(left) / len(w) * np.eye(len(w))
    return SpectrumKernelModel(names, marks.astype(np.float32), np.linalg.solve(system, right).astype(np.float32))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *, may_learn: Column | None = None, rows_each: int = 250, landmarks_each: int = 40, most_rows: int = 16_384, most_landmarks: int = 4_096, ridge: float = 0.5) -> SpectrumKernelModel:
    """Fits on at most rows_each windows of documents of every language, those with the smallest hash of the identifier, and at most most_rows of all languages together.

    may_learn is a condition on `id`. Rows with a null language or a text without letters are not learned from. All rows are counted and may be picked, and every language is learned; more than
    most_landmarks languages are an error. What reaches the driver are n-gram sets of the sample as bits: most_rows x 1 KB.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(F.col("lang").isNotNull() & F.col("id").isNotNull())
    if may_learn is not None:
        rows = rows.where(may_learn)
    ids = rows.where(has_letter(F.col("text"))).select("id", "lang", F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("h"))
    totals = persisted(ids.groupBy("lang").agg(F.approx_count_distinct("h").alias("count")))  # of identifiers, which may repeat
    languages = totals.count()
    if languages > most_landmarks:
        raise ValueError(f"{languages} languages, but at most {most_landmarks} landmarks")
    rows_each, landmarks_each = min(rows_each, most_rows // max(1, languages)), min(landmarks_each, most_landmarks // max(1, languages))
    # A language's expected share below this hash is four samples; then the smallest of those hashes are the sample.
    cut = F.least(F.lit(1.0), 4.0 * (rows_each + 50) / F.col("count"))
    near = ids.join(F.broadcast(totals), "lang").where(F.col("h") < cut * (1 << 40))
    first = lambda *order: F.row_number().over(Window.partitionBy("lang").orderBy(*order)) <= rows_each
    picked = near.withColumn("first", first("h", "id")).where("first").select("id", "lang").distinct()
    sample = rows.join(F.broadcast(picked), ["id", "lang"])  # a side of at most most_rows rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, take, sets = b.column("text"), [], []
            for k in range(b.num_rows):
                for s in spectra(texts[k].as_py() or ""):
                    bits = np.zeros(DIMENSIONS, bool)
                    bits[s] = True
                    take.append(k)
                    sets.append(np.packbits(bits).tobytes())
            at = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_pydict({"id": b.column("id").take(at), "lang": b.column("lang").take(at), "s": pa.array(sets, pa.binary())})

    found = sample.select("id", "lang", "text").mapInArrow(run, f"id {dict(rows.dtypes)['id']}, lang string, s binary")
    found = found.withColumn("h", F.pmod(F.xxhash64("id"), F.lit(1 << 40))).withColumn("first", first("h", "id", "s")).where("first").orderBy("lang", "h", "id", "s").select("lang", "s").toPandas()
    return fit([np.flatnonzero(np.unpackbits(np.frombuffer(x, np.uint8))).astype(np.int16) for x in found["s"]], list(found["lang"]), landmarks_each, ridge)


def predict_language(docs: DataFrame, model: SpectrumKernelModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score) for every row; "und" with score 0 where the text is null or has no letter.

    Repeated rows and null identifiers keep a row each; an empty table gives an empty result. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.landmarks, model.coefficients))  # plain arrays need no class on executors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, letters = b.column("text"), b.column("letters").to_pylist()
            names, scores = SpectrumKernelModel(*shared.value).predict([spectra(texts[k].as_py()) if letters[k] else [np.zeros(0, np.int16)] for k in range(b.num_rows)])
            names = [n if ok else UNDETERMINED for n, ok in zip(names, letters)]
            scores = np.where(np.array(letters, bool), scores, 0.0)
            yield pa.RecordBatch.from_pydict({"id": b.column("id"), "lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())})

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), has_letter(F.col(text_col)).alias("letters"))
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, lang_pred string, score double").select(F.col("id").alias(id_col), "lang_pred", "score")
