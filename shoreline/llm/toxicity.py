"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

The model is fitted on a bounded sample of the labelled rows: the first ``MAX_LABELLED`` by a
hash of ``doc_id``, as far as their texts have ``MAX_BYTES`` together; a text that no longer
fits is passed over and does not count. FTRL takes one document
after the other with a rate per coordinate, and L1 leaves few weights, which are shipped to the
tasks that score. A part of the sample is held back to fit slope and offset of the score.
Everything else covers all rows.

Words are runs of letters, digits and non-ASCII characters, A-Z in lower case. Features are a
document's different words, pairs of neighbours, and pairs with one word between them.

Edge cases. A null, empty or blank text has no features and gets the model's offset as score.
With labels of one kind only, the score is that of the frequencies; without any labelled text it is
next to 0, so that nothing is called toxic. Labels that are null do not count; of contradicting labels the larger counts. Extra columns go through.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.llm.common import WordHashes, mixed, slices, with_scores, written

MAX_LABELLED = 12_000
MAX_BYTES = 64 << 20

FEATURE_BITS = 20
ALPHA, BETA, L1, L2 = 1.0, 1.0, 3.0, 1.0
EPOCHS = 5

#: Offset of the model that has seen no labelled text.
UNFITTED = -30.0

#: Of ten parts of the sample, by a checksum, those that only calibrate the score.
CALIBRATION_PARTS = (3, 6)

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


@dataclass(frozen=True)
class Model:
    index: np.ndarray
    weight: np.ndarray
    slope: float
    offset: float

    def dense(self) -> np.ndarray:
        weights = np.zeros(1 << FEATURE_BITS)
        weights[self.index] = self.weight
        return weights


def remainder(doc_id: Column, parts: int) -> Column:
    """CRC-32 of the id's text, modulo ``parts``; ids with 0 of 5 are held out from learning."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)).cast("int")


def occurrences(words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature and document of every occurrence, for the joined words of several documents."""
    row = np.repeat(np.arange(len(lengths)), lengths)
    with np.errstate(over="ignore"):
        pairs = mixed(words[:-1] * np.uint64(3) + words[1:])
        skips = mixed(words[:-2] * np.uint64(5) + words[2:] + np.uint64(11))
    near, far = row[:-1] == row[1:], row[:-2] == row[2:]
    features = np.concatenate((words, pairs[near], skips[far])) >> np.uint64(64 - FEATURE_BITS)
    return features.astype(np.int64), np.concatenate((row, row[:-1][near], row[:-2][far]))


def _split(texts: list[bytes], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    words = [text.translate(_LETTERS).split() for text in texts]
    return hashes.of([w for ws in words for w in ws]), np.array([len(ws) for ws in words], np.int64)


def sampled_labels(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """``doc_id``, ``label`` and ``rank`` of the rows to learn from, never held-out ones."""
    usable = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), 5) != 0))
    usable = usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = F.broadcast(written(usable.orderBy(*order).limit(MAX_LABELLED), "labelled"))
    sized = docs.select("doc_id", F.octet_length("text").cast("bigint").alias("size")).join(chosen, "doc_id")
    sized = written(sized.groupBy("doc_id").agg(F.max("label").alias("label"), F.sum(F.coalesce("size", F.lit(0))).alias("size")), "sized")
    ranked = sized.select("doc_id", "label", F.xxhash64("doc_id").alias("rank"), "size")
    one = ranked.repartition(1).sortWithinPartitions("rank", "doc_id")  # MAX_LABELLED rows at most
    return one.mapInArrow(_fitting(MAX_BYTES), ranked.drop("size").schema)


def _fitting(bound: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The rows in their order, without those whose size no longer fits into the bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = bound
        for batch in batches:
            taken = []
            for size in batch.column("size").to_pylist():
                taken.append(size <= left)
                left -= size * taken[-1]
            yield batch.filter(pa.array(taken, pa.bool_())).select(["doc_id", "label", "rank"])

    return run


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """The model as sparse weights; the sample is learned in one task, document by document."""
    sample = written(sampled_labels(docs, labels, label), "sample")
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(sample), "doc_id")
    ordered = rows.repartition(1).sortWithinPartitions("rank", "doc_id", "text")
    found = ordered.mapInArrow(_learn, "index int, weight double").toArrow()
    index, weight = found.column(0).to_numpy(), found.column(1).to_numpy()
    named = {int(i): float(w) for i, w in zip(index[index < 0], weight[index < 0])}
    chosen = index >= 0
    return Model(index[chosen], weight[chosen], named.get(-1, 0.0), named.get(-2, UNFITTED))


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes, fitted, calibrating = WordHashes(), [], []
    for batch in batches:
        for part in slices(batch, "text"):
            words, lengths = _split([t or b"" for t in part.column("text").to_pylist()], hashes)
            features, row = occurrences(words, lengths)
            order = np.argsort(row, kind="stable")
            bounds = np.searchsorted(row[order], np.arange(1, len(lengths)))
            ids, labels = part.column("doc_id").to_pylist(), part.column("label").to_pylist()
            for doc_id, y, own in zip(ids, labels, np.split(features[order], bounds)):
                held = zlib.crc32(str(doc_id).encode()) % 10 in CALIBRATION_PARTS
                (calibrating if held else fitted).append((np.unique(own).astype(np.int32), int(y > 0)))
    weights, offset = ftrl(fitted)
    margins = np.array([weights[x].sum() + offset for x, _ in calibrating])
    slope, shift = calibrated(margins, np.array([y for _, y in calibrating], float))
    intercept = slope * offset + shift if fitted or calibrating else UNFITTED
    index = np.flatnonzero(weights)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate((index, [-1, -2])).astype(np.int32)), pa.array(np.concatenate((weights[index], [slope, intercept])))],
        names=["index", "weight"],
    )


def ftrl(rows: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, float]:
    """Weights and offset after ``EPOCHS`` passes; the offset is not regularised."""
    z, n = np.zeros(1 << FEATURE_BITS), np.zeros(1 << FEATURE_BITS)
    offset, offset_n = 0.0, 0.0

    def weight(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    order = np.random.default_rng(1)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            x, y = rows[i]
            own_z, own_n = z[x], n[x]
            w = weight(own_z, own_n)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + offset, -30, 30))) - y
            z[x] += g - (np.sqrt(own_n + g * g) - np.sqrt(own_n)) / ALPHA * w
            n[x] += g * g
            offset_n += g * g
            offset -= ALPHA * g / (BETA + offset_n**0.5)
    return weight(z, n), float(offset)


def calibrated(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton steps of logistic regression; a slight ridge keeps them finite."""
    slope, shift = 1.0, 0.0
    if not len(y):
        return slope, shift
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -30, 30)))
        q = p * (1 - p)
        gradient = np.array([((p - y) * margins).sum() + 0.1 * (slope - 1), (p - y).sum() + 0.1 * shift])
        curve = np.array([[(q * margins**2).sum() + 0.1, (q * margins).sum()], [(q * margins).sum(), q.sum() + 0.1]])
        step = np.clip(np.linalg.solve(curve, gradient), -2, 2)
        slope, shift = slope - step[0], shift - step[1]
    return float(slope), float(shift)


def scored(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with the probability of the label as further column."""

    def scores(texts: list[bytes]) -> np.ndarray:
        words, lengths = _split(texts, _remembered())
        features, row = occurrences(words, lengths)
        weights = _dense(model)
        hit = np.flatnonzero(weights[features])
        pairs = np.unique(row[hit] << FEATURE_BITS | features[hit])
        margins = np.bincount(pairs >> FEATURE_BITS, weights[pairs & ((1 << FEATURE_BITS) - 1)], len(texts))
        return 1 / (1 + np.exp(-np.clip(model.slope * margins + model.offset, -30, 30)))

    return with_scores(docs, name, scores)


_WORKER: dict = {}


def _remembered() -> WordHashes:
    return _WORKER.setdefault("hashes", WordHashes())


def _dense(model: Model) -> np.ndarray:
    key = (model.slope, model.offset, len(model.index), float(model.weight.sum()))
    if _WORKER.get("key") != key:
        _WORKER.update(key=key, weights=model.dense())
    return _WORKER["weights"]
