"""Language identification with string kernels.

A text's features are its distinct byte n-grams of several orders (the blended spectrum, presence
only) after lower-casing. The kernel of two texts is the mean over the orders of the shared n-grams
divided by the root of the product of both counts. Landmark texts give the Nystrom features
``K(x, landmarks) K(landmarks, landmarks)^-1/2``; one-versus-rest kernel ridge regression is solved
in that space. A batch of texts is scored by two matrix products: presence of the landmarks'
n-grams times the landmarks' presence, and features times class weights.

The model is fitted on a bounded sample: per language the ``per_language`` distinct training texts of
at most ``longest`` bytes with the smallest hash; the first ``landmarks`` of them, short ones before
long ones, are the landmarks. Copies of a text, under whatever ids, count as one text.

Defined cases: null and empty texts and texts without a letter are ``und`` with score 0; if nothing
can be learned, so is everything. Equal scores: the first language in sort order. Repeated rows give
one result each; an empty table gives an empty result. Other columns are not read, and id, source
and language never enter a prediction.

Fitting sends a few thousand texts and their features to the driver, whatever the corpus' size;
scoring is per row without a shuffle, and reads whole texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starhouse.llm.arrow import text_slices

ORDERS = (1, 2, 3)
PER_LANGUAGE = 200
LONGEST_SAMPLED = 64 << 10  # bytes; longer texts are not learned from
LANDMARKS = 24
LANDMARK_BYTES = 8 << 10  # longer texts are no landmarks; they are scored whole like all others
RIDGE = 1e-3
BATCH = 256
UNKNOWN = "und"

_KINDS = 1 << 24  # codes of up to three bytes


def grams(text: str) -> list[np.ndarray]:
    """Sorted distinct codes of the byte n-grams of each order."""
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    found, code = [], np.zeros(len(raw), np.uint32)
    for order in ORDERS:
        code = (code[:len(raw) - order + 1] << np.uint32(8)) | raw[order - 1:] \
            if len(raw) >= order else np.empty(0, np.uint32)
        found.append(np.unique(code))
    return found


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    codes: list[np.ndarray]  # per order the landmarks' n-grams
    presence: np.ndarray  # n-grams of all orders by landmarks, scaled by the landmarks' counts
    weights: np.ndarray  # landmarks by languages

    def similarities(self, texts: list[list[np.ndarray]]) -> np.ndarray:
        """Kernel of each text with each landmark, one matrix product for the batch."""
        rows = np.zeros((len(texts), len(self.presence)), np.float32)
        for row, orders in zip(rows, texts, strict=True):
            start = 0
            for known, own in zip(self.codes, orders, strict=True):
                if len(own) and len(known):
                    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    row[start + at[known[at] == own]] = 1 / np.sqrt(len(own))
                start += len(known)
        return rows @ self.presence

    def scores(self, texts: list[list[np.ndarray]]) -> np.ndarray:
        return np.clip(self.similarities(texts) @ self.weights, 0, 1)


def _landmark_space(landmarks: list[list[np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
    codes, blocks = [], []
    for order in range(len(ORDERS)):
        own = [t[order] for t in landmarks]
        known = np.unique(np.concatenate(own))
        block = np.zeros((len(known), len(own)), np.float32)
        for i, codes_of in enumerate(own):
            if len(codes_of):
                block[np.searchsorted(known, codes_of), i] = \
                    1 / np.sqrt(len(codes_of)) / len(ORDERS)
        codes.append(known)
        blocks.append(block)
    return codes, np.concatenate(blocks)


def fit(rows: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE,
        landmark_bytes: int = LANDMARK_BYTES) -> Model | None:
    """A model from (text, language) rows; None if no row has a letter."""
    rows = [(grams(t), y, len(t.encode("utf-8", "surrogatepass"))) for t, y in rows if has_letter(t)]
    if not rows:
        return None
    languages = sorted({y for _, y, _ in rows})
    chosen: list[list[np.ndarray]] = []
    for language in languages:
        own = sorted((r for r in rows if r[1] == language), key=lambda r: r[2] > landmark_bytes)
        chosen += [t for t, _, _ in own[:landmarks]]
    codes, presence = _landmark_space(chosen)
    model = Model(languages, codes, presence, np.zeros((len(chosen), len(languages)), np.float32))
    values, vectors = np.linalg.eigh(model.similarities(chosen).astype(np.float64))
    kept = values > 1e-6 * values.max()
    root = vectors[:, kept] / np.sqrt(values[kept])  # K_mm^-1/2
    features = model.similarities([t for t, _, _ in rows]).astype(np.float64) @ root
    targets = np.array([[float(y == k) for k in languages] for _, y, _ in rows])
    gram = features.T @ features + ridge * len(rows) * np.eye(features.shape[1])
    model.weights = (root @ np.linalg.solve(gram, features.T @ targets)).astype(np.float32)
    return model


def train(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE,
          landmarks: int = LANDMARKS, longest: int = LONGEST_SAMPLED) -> Model | None:
    """Fit on a bounded sample of the rows that fulfil ``learn`` and have a language."""
    rows = docs.filter(learn).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    ).filter((F.octet_length("text") <= longest) & F.col("lang").isNotNull())
    rows = rows.select("*", F.xxhash64("text").alias("place"))
    # places are spread evenly, so few lie below a bound that follows a language's distinct texts
    counts = {r["lang"]: max(1, r["n"]) for r in rows.groupBy("lang").agg(
        F.approx_count_distinct("place").alias("n")).collect()}
    below = F.lit(False)
    for lang, n in sorted(counts.items()):
        bound = (1 << 64) * min(1.0, 4 * per_language / n) - (1 << 63)
        below |= (F.col("lang") == lang) & (F.col("place") <= F.lit(bound))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    first = (rows.filter(below).select("lang", "place").distinct().withColumn("n", number)
             .filter(F.col("n") <= per_language))
    wanted = {(r["lang"], r["place"]) for r in first.collect()}
    places = sorted({p for _, p in wanted})
    # one text per place, combined before it leaves a task
    sample = rows.filter(F.col("place").isin(places)).groupBy("lang", "place").agg(
        F.min("text").alias("text")).collect() if places else []
    found = {(r["place"], r["lang"], r["text"]) for r in sample if (r["lang"], r["place"]) in wanted}
    return fit([(t, y) for _, y, t in sorted(found)], landmarks)


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) per row."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large in text_slices(batches, "text"):
            for start in range(0, large.num_rows, BATCH):
                batch = large.slice(start, BATCH)
                texts = batch.column("text").to_pylist()
                known = [i for i, t in enumerate(texts) if model is not None and has_letter(t)]
                languages, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
                if known:
                    found = model.scores([grams(texts[i]) for i in known])
                    for i, row, best in zip(known, found, found.argmax(axis=1), strict=True):
                        languages[i], scores[i] = model.languages[best], float(row[best])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(languages, pa.string()),
                     pa.array(scores, pa.float64())], ["id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(work, "id long, lang_pred string, score double").withColumnRenamed(
        "id", id_col)
