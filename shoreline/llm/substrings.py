"""Words of passages that stand earlier in the corpus, found by doubling window lengths.

Level 1 compares windows of half the length: of the half windows inside each full window the
one with the smallest hash stands for it, so equal full windows are stood for by equal half
windows, and only about a sixth of all positions are shuffled. A half window that occurs once
in the corpus cannot be part of a repeated window. Level 2 extends what is repeated to the full
length: windows whose half window survived are compared by the hash of both.

Each task first compares its own windows and sends every hash once, so a passage that a third
of all documents share reaches the next stage once per task's chunk, not once per document.
Within a chunk all but the first occurrence are known to be repeats.

Edge cases. A null, empty or blank text has no words. Rows without ``doc_id`` keep all words and
count for no other row. Rows that repeat ``doc_id`` and text are the same occurrence; rows with one ``doc_id``
and different texts are different documents, ordered by a hash of the text. Further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoreline.llm.common import WordHashes, slices, windows_hash, written
from shoreline.session import staged

WINDOW = 20

#: A task compares this many words of its own before it sends their hashes.
CHUNK_WORDS = 2 << 20

_OPEN, _KNOWN = 0, 1


def _tagged(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``tag`` (32 bits of a hash of the text) and ``text`` as bytes."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.hash("text").alias("tag"), F.col("text").cast("binary").alias("text"))


def _chunks(batches: Iterator[pa.RecordBatch], chunk_words: int) -> Iterator[tuple]:
    """Word hashes of consecutive documents with their ids, tags, lengths and further column."""
    hashes, rows, total = WordHashes(), [], 0
    for batch in batches:
        for part in slices(batch, "text"):
            extra = part.column("places") if "places" in part.schema.names else [None] * part.num_rows
            for doc_id, tag, text, places in zip(*(part.column(c).to_pylist() for c in ("doc_id", "tag", "text")), extra):
                words = hashes.of((text or b"").split())
                rows.append((doc_id, tag, words, places))
                total += len(words)
                if total >= chunk_words:
                    yield _joined(rows)
                    rows, total = [], 0
    if rows:
        yield _joined(rows)


def _joined(rows: list[tuple]) -> tuple:
    lengths = np.array([len(r[2]) for r in rows], np.int64)
    return (
        np.array([r[0] for r in rows], np.int64),
        np.array([r[1] for r in rows], np.int64),
        np.concatenate([r[2] for r in rows]),
        lengths,
        [r[3] for r in rows],
    )


def _representatives(words: np.ndarray, lengths: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Starts of full windows, the half window that stands for each, and all half-window hashes."""
    half = window // 2
    grams = windows_hash(words, half)
    inside = np.arange(len(words)) + window <= np.repeat(np.cumsum(lengths), lengths)
    starts = np.flatnonzero(inside)
    if not len(starts):
        return starts, starts, grams
    reach = window - half + 1
    least, at = grams[: len(words) - window + 1].copy(), np.zeros(len(words) - window + 1, np.int64)
    for step in range(1, reach):
        following = grams[step : step + len(least)]
        smaller = following < least
        least[smaller] = following[smaller]
        at[smaller] = step
    return starts, starts + at[starts], grams


def _placed(positions: np.ndarray, ids: np.ndarray, tags: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document id, and place (tag and word number in one number), of positions in a chunk."""
    ends = np.cumsum(lengths)
    row = np.searchsorted(ends, positions, side="right")
    return ids[row], (tags[row] << 32) + positions - (ends - lengths)[row]


def _batch(kind: int, *columns: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(c.view(np.int64)) for c in columns]
    names = ["h1", "h2", "doc_id", "place"]
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), kind, np.int8)), *arrays], names=["kind", *names])


_ROWS = "kind tinyint, h1 bigint, h2 bigint, doc_id bigint, place bigint"


def _half_windows(window: int, chunk_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, tags, words, lengths, _ in _chunks(batches, chunk_words):
            _, stands, grams = _representatives(words, lengths, window)
            stands = np.unique(stands)
            hashes = grams[stands]
            order = np.argsort(hashes, kind="stable")
            hashes, stands = hashes[order], stands[order]
            new = np.concatenate(([True], hashes[1:] != hashes[:-1])) if len(hashes) else np.empty(0, bool)
            several = ~new
            several[:-1] |= ~new[1:]
            doc, place = _placed(stands, ids, tags, lengths)
            yield _batch(_KNOWN, hashes[several], hashes[several], doc[several], place[several])
            # One of each hash goes on; whether others are known here tells the second number.
            yield _batch(_OPEN, hashes[new], several[new].astype(np.int64), doc[new], place[new])

    return run


def _full_windows(window: int, chunk_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, tags, words, lengths, places in _chunks(batches, chunk_words):
            starts, stands, grams = _representatives(words, lengths, window)
            alive = np.zeros(len(words), bool)
            for offset, own in zip(np.cumsum(lengths) - lengths, places):
                alive[offset + own.values.to_numpy()] = True
            chosen = alive[stands]
            starts, stands = starts[chosen], stands[chosen]
            whole = windows_hash(words, window, seed=1)[starts]
            doc, place = _placed(starts, ids, tags, lengths)
            seed = grams[stands]
            order = np.lexsort((place, doc, whole, seed))
            seed, whole, doc, place = seed[order], whole[order], doc[order], place[order]
            new = np.ones(len(seed), bool)
            new[1:] = (seed[1:] != seed[:-1]) | (whole[1:] != whole[:-1])
            late = _later(new, doc, place)
            yield _batch(_KNOWN, seed[late], whole[late], doc[late], place[late])
            yield _batch(_OPEN, seed[new], whole[new], doc[new], place[new])

    return run


def _later(new: np.ndarray, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Rows that come after the first of their run, equal occurrences aside."""
    first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(new) else np.empty(0, np.int64)
    return (doc != doc[first]) | (place != place[first])


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns of whole runs of equal leading ``keys`` columns, from a sorted partition."""
    carried = None
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in ("h1", "h2", "doc_id", "place")]
        if carried is not None:
            columns = [np.concatenate(pair) for pair in zip(carried, columns)]
        n = len(columns[0])
        differs = np.zeros(max(n - 1, 0), bool)
        for column in columns[:keys]:
            differs |= column[1:] != column[:-1]
        bounds = np.flatnonzero(differs) + 1
        stop = bounds[-1] if len(bounds) else 0
        carried = [c[stop:] for c in columns]
        if stop:
            yield tuple(c[:stop] for c in columns)
    if carried is not None and len(carried[0]):
        yield tuple(carried)


def _repeated_halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Half windows that another chunk holds too; the others of their chunk are known already."""
    for h1, several, doc, place in _runs(batches, 1):
        new = np.concatenate(([True], h1[1:] != h1[:-1]))
        alone = new.copy()
        alone[:-1] &= new[1:]
        found = ~alone & (several == 0)
        yield pa.RecordBatch.from_arrays([pa.array(doc[found]), pa.array(place[found])], names=["doc_id", "place"])


def _repeated_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows whose hash an earlier place holds."""
    for h1, h2, doc, place in _runs(batches, 2):
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        late = _later(new, doc, place)
        yield pa.RecordBatch.from_arrays([pa.array(doc[late]), pa.array(place[late])], names=["doc_id", "place"])


def _by_document(places: DataFrame) -> DataFrame:
    """``found_id``, ``found_tag`` and ``places``, the word numbers found in the document."""
    tag = F.shiftright("place", 32).cast("int").alias("found_tag")
    number = F.col("place").bitwiseAND(0xFFFFFFFF).cast("int").alias("number")
    numbered = places.select(F.col("doc_id").alias("found_id"), tag, number)
    return numbered.groupBy("found_id", "found_tag").agg(F.collect_list("number").alias("places"))


def _repeats(rows: DataFrame, keys: list[str], reducer) -> DataFrame:
    """``doc_id`` and ``place`` of what is repeated: known to a chunk, or found across chunks."""
    open_rows = rows.where(f"kind = {_OPEN}").select("h1", "h2", "doc_id", "place")
    across = open_rows.repartition(*keys).sortWithinPartitions(*keys, "doc_id", "place")
    across = across.mapInArrow(reducer, "doc_id bigint, place bigint")
    return rows.where(f"kind = {_KNOWN}").select("doc_id", "place").union(across)


def repeated_windows(docs: DataFrame, window: int = WINDOW, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """``found_id``, ``found_tag`` and ``places``: starts of windows that stand earlier elsewhere."""
    tagged = _tagged(docs).where("doc_id IS NOT NULL")
    with staged(tagged.mapInArrow(_half_windows(window, chunk_words), _ROWS), "half-windows") as rows:
        alive = written(_by_document(_repeats(rows, ["h1"], _repeated_halves)), "halves")
    same = (tagged["doc_id"] == alive["found_id"]) & (tagged["tag"] == alive["found_tag"])
    candidates = tagged.join(alive.hint("merge"), same).select("doc_id", "tag", "text", "places")
    with staged(candidates.mapInArrow(_full_windows(window, chunk_words), _ROWS), "windows") as rows:
        return written(_by_document(_repeats(rows, ["h1", "h2"], _repeated_windows)), "repeats")


def without_repeats(docs: DataFrame, window: int = WINDOW, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept``, the words that stay joined by a space."""
    tagged, found = _tagged(docs), repeated_windows(docs, window, chunk_words)
    same = (tagged["doc_id"] == found["found_id"]) & (tagged["tag"] == found["found_tag"])
    joined = tagged.join(found.hint("merge"), same, "left").select("doc_id", "text", "places")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                counts, removed, kept = [], [], []
                for text, places in zip(part.column("text").to_pylist(), part.column("places")):
                    words = (text or b"").split()
                    gone = np.zeros(len(words), bool)
                    if places.is_valid:
                        change = np.zeros(len(words) + 1, np.int64)
                        starts = np.unique(places.values.to_numpy())
                        change[starts] += 1
                        change[starts + window] -= 1
                        gone = np.cumsum(change)[:-1] > 0
                        words = [w for w, g in zip(words, gone.tolist()) if not g]
                    counts.append(len(gone))
                    removed.append(int(gone.sum()))
                    kept.append(b" ".join(words))
                columns = [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept"])

    result = joined.mapInArrow(apply, "doc_id bigint, n_words bigint, n_removed bigint, kept binary")
    return result.withColumn("kept", F.col("kept").cast("string"))
