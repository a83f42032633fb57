"""URL rules looked up in a Bloom filter cascade, exact over the corpus and without joins.

A rule is a host and the beginning of a path. Every url has a few keys: its last labels, for
each number of labels that rules have, with its path cut to each length that rules have. Level
0 of the cascade encodes the listed keys. Over the corpus's complete key universe some other
keys pass it too; level 1 encodes those, level 2 the listed keys that pass level 1, and so on
until nothing passes wrongly. The first level that a key fails tells whether it is listed, for
every key of the universe the cascade was built over.

Level 0 is sized so that about as many keys pass wrongly as are listed: the cascade grows with
the rules and only by the logarithm of the corpus. Above ``MAX_BYTES`` it is not shipped to
the tasks; the different urls are then joined with the rules instead.

Edge cases. A null url, or one without ``://``, has an empty host and path and no rule. Of
equally long rules the one with the longer host wins. A key that is listed as allow and block is blocked.
Further columns go through; new columns that clash with them get an underscore in front.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shoreline.llm.common import ascii_lower, mixed, unused_name, written

MAX_BYTES = 128 << 20

#: Share of wrong keys that pass a level above the first.
PASS_RATE = 1 / 16


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_shapes(rules: DataFrame) -> tuple[list[int], list[int]]:
    """Numbers of host labels and path lengths that occur; both are small whatever the rules."""
    labels = rules.select(F.size(F.split("host", r"\.")).alias("n")).distinct().collect()
    lengths = rules.select(F.char_length("path").alias("n")).distinct().collect()
    return sorted(r.n for r in labels), sorted(r.n for r in lengths)


def url_keys(host: Column, path: Column, shapes: tuple[list[int], list[int]]) -> Column:
    """The url's keys, longest first."""
    keys = []
    for labels in shapes[0]:
        suffix = F.when(F.size(F.split(host, r"\.")) >= labels, F.substring_index(host, ".", -labels))
        for length in shapes[1]:
            cut = F.when(F.char_length(path) >= length, F.substring(path, 1, length))
            key = F.concat(suffix, cut)
            keys.append(F.when((host != "") & key.isNotNull(), F.struct(-F.char_length(key), -F.char_length(suffix), key.alias("key"))))
    if not keys:
        return F.array().cast("array<string>")
    return F.transform(F.array_sort(F.array_compact(F.array(*keys))), lambda k: k["key"])


def _hashed(keys: DataFrame) -> DataFrame:
    return keys.select("key", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    words: np.ndarray = field(repr=False)

    def passes(self, places: np.ndarray) -> np.ndarray:
        found = np.ones(places.shape[1], bool)
        for row in places:
            found &= (self.words[row >> np.uint64(6)] >> (row & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found


def _places(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, hashes: int) -> np.ndarray:
    """One row of bit numbers for each hash function of a level."""
    with np.errstate(over="ignore"):
        start, step = mixed(h1.view(np.uint64) + np.uint64(level)), h2.view(np.uint64) | np.uint64(1)
        return np.stack([(start + np.uint64(j) * step) % np.uint64(bits) for j in range(hashes)])


def listed(levels: list[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether each key is listed: the number of levels it passes is odd."""
    passed, alive = np.zeros(len(h1), np.int64), np.arange(len(h1))
    for i, level in enumerate(levels):
        alive = alive[level.passes(_places(h1[alive], h2[alive], i, level.bits, level.hashes))]
        passed[alive] += 1
    return passed % 2 == 1


def _level(keys: DataFrame, number: int, count: int, rate: float) -> Level:
    """A Bloom filter over ``count`` keys: tasks set bits, their words are or-ed together."""
    bits = max(64, math.ceil(count * math.log2(1 / rate) / math.log(2)))
    hashes = max(1, round(math.log2(1 / rate)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.unique(_places(batch.column("h1").to_numpy(), batch.column("h2").to_numpy(), number, bits, hashes))
            word, start = np.unique(places >> np.uint64(6), return_index=True)
            value = np.bitwise_or.reduceat(np.uint64(1) << (places & np.uint64(63)), start) if len(start) else word
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(value.view(np.int64))], names=["word", "value"])

    found = keys.select("h1", "h2").mapInArrow(run, "word bigint, value bigint").groupBy("word").agg(F.bit_or("value").alias("value")).toArrow()
    words = np.zeros(-(-bits // 64), np.uint64)
    words[found.column(0).to_numpy()] = found.column(1).to_numpy().view(np.uint64)
    return Level(bits, hashes, words)


def _passing(keys: DataFrame, level: Level, number: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = _places(batch.column("h1").to_numpy(), batch.column("h2").to_numpy(), number, level.bits, level.hashes)
            yield batch.filter(pa.array(level.passes(places)))

    return keys.mapInArrow(run, keys.schema)


def cascade(keys: DataFrame, universe: DataFrame, max_bytes: int = MAX_BYTES) -> list[Level] | None:
    """Levels that tell the listed ``keys`` from all others of ``universe`` (columns ``key``).

    None if the levels would take more than ``max_bytes``.
    """
    ours = written(_hashed(keys.distinct()), "listed")
    theirs = _hashed(universe)
    count, total = ours.count(), theirs.agg(F.approx_count_distinct("key")).first()[0]
    if not count:
        return []
    rate = min(0.5, math.sqrt(0.5) * count / max(total, 1))
    # Level 0, then at most as many keys again as are listed, at PASS_RATE and shrinking by it.
    if count * (math.log2(1 / rate) + 2 * math.log2(1 / PASS_RATE)) / math.log(2) / 8 > max_bytes:
        return None
    levels = [_level(ours, 0, count, rate)]
    wrong = written(_passing(theirs, levels[0], 0).distinct().join(ours.select("key"), "key", "left_anti"), "passing")
    right = ours
    while count := wrong.count():
        levels.append(_level(wrong, len(levels), count, PASS_RATE))
        wrong, right = written(_passing(right, levels[-1], len(levels) - 1), "passing"), wrong
    return levels


def judged(pages: DataFrame, rules: DataFrame, default: str = "allow", max_bytes: int = MAX_BYTES) -> tuple[DataFrame, list[str]]:
    """``pages`` with host, path, rule and verdict, and the names of these columns.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block).
    """
    names = [unused_name(pages, name) for name in ("host", "path", "rule", "verdict")]
    keyed_rules = rules.select(F.concat("host", "path").alias("key"), "verdict")
    shapes = rule_shapes(rules)
    host, path = host_and_path(F.col("url"))
    located = pages.withColumns({names[0]: host, names[1]: path})
    universe = located.select(F.explode(url_keys(F.col(names[0]), F.col(names[1]), shapes)).alias("key"))
    blocked, allowed = (keyed_rules.where(F.col("verdict") == v).select("key") for v in ("block", "allow"))
    rule_levels = cascade(keyed_rules.select("key"), universe, max_bytes)
    block_levels = None if rule_levels is None else cascade(blocked, allowed, max_bytes)
    if rule_levels is None or block_levels is None:
        return _joined(located, names, keyed_rules, shapes, default), names
    keys, h1, h2 = (unused_name(pages, name) for name in ("keys", "h1", "h2"))
    looked_up = located.withColumn(keys, url_keys(F.col(names[0]), F.col(names[1]), shapes)).withColumns(
        {h1: F.transform(keys, lambda k: F.xxhash64(k)), h2: F.transform(keys, lambda k: F.xxhash64(F.lit(1), k))}
    )
    schema = StructType([*located.schema.fields, *(StructField(name, StringType()) for name in names[2:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, first, second = batch.columns[-3:]
            a, b = first.flatten().to_numpy(), second.flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), np.diff(keys.offsets.to_numpy()))
            hit = np.flatnonzero(listed(rule_levels, a, b))
            rows, start = np.unique(row[hit], return_index=True)  # keys are longest first
            hit = hit[start]
            rule, verdict = np.full(batch.num_rows, None, object), np.full(batch.num_rows, default, object)
            rule[rows] = np.array(keys.flatten().take(pa.array(hit)).to_pylist(), object)
            verdict[rows] = np.where(listed(block_levels, a[hit], b[hit]), "block", "allow")
            columns = [*batch.columns[:-3], pa.array(rule, pa.string()), pa.array(verdict, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return looked_up.mapInArrow(run, schema), names


def _joined(located: DataFrame, names: list[str], rules: DataFrame, shapes: tuple, default: str) -> DataFrame:
    """The same by a join of the different urls' keys with the rules, for rules too many to ship."""
    host, path, rule, verdict = names
    places = located.select(F.col(host).alias("h"), F.col(path).alias("p")).distinct()
    keys = places.select("h", "p", F.posexplode(url_keys(F.col("h"), F.col("p"), shapes)).alias("order", "key"))
    best = F.min_by(F.struct("key", "verdict"), F.struct("order", F.when(F.col("verdict") == "block", 0).otherwise(1))).alias("best")
    found = keys.join(rules, "key").groupBy("h", "p").agg(best)
    same = (located[host] == found["h"]) & (located[path] == found["p"])
    picked = located.join(found, same, "left")
    return picked.select(
        *located.columns, F.col("best.key").alias(rule), F.coalesce("best.verdict", F.lit(default)).alias(verdict)
    )
