"""Benchmark passages in documents, found by winnowing. DataFrame functions only.

A window is ``WINDOW`` consecutive words of an item (all words of a shorter item). Of the
``GRAM``-word hashes inside each window the smallest is its fingerprint, so equal windows have
equal fingerprints and no shared window can be missed. Document fingerprints are joined with
the items', and each hit is extended: the windows around it are compared word by word. Items
shorter than a window are looked up by the hash of all their words.

The fingerprints of the items are broadcast when they are at most ``BROADCAST_SEEDS``;
otherwise narrow rows are shuffled to them and texts are fetched for the hits alone.

Edge cases. A null or empty text has no words. Rows that repeat a ``doc_id`` are judged one by
one, rows that repeat a text too get the same result. Items without an id make words hit but
are not counted. Items without words occur nowhere. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.llm.common import ascii_lower, written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
GRAM = 5

#: At most this many 8-byte fingerprints are broadcast (some 40 MB as a hash table).
BROADCAST_SEEDS = 1_000_000

#: Equal neighbouring fingerprints are one hit, of at most so many windows.
RUN = 8


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


# Generators over computed arrays are the outer ones: for the others Spark infers a filter on the
# array's size and pushes it below the projections, with the whole computation inside its lambdas.


def _hashes(items: DataFrame, *kept: str) -> DataFrame:
    return items.select(*kept, "words", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))


def _grams(hashes: str, length: int) -> Column:
    """Hash of the ``length`` words from each place that has so many."""

    def gram(first: Column, i: Column) -> Column:
        return F.xxhash64(first, *(F.get(hashes, i + j) for j in range(1, length)))

    starts = F.slice(hashes, 1, F.greatest(F.size(hashes) - (length - 1), F.lit(0)))
    return F.transform(starts, gram)


def _winnowed(grams: str) -> Column:
    """The smallest hash of each window."""
    reach = WINDOW - GRAM

    def least(first: Column, i: Column) -> Column:
        return F.least(first, *(F.get(grams, i + j) for j in range(1, reach + 1)))

    return F.transform(F.slice(grams, 1, F.greatest(F.size(grams) - reach, F.lit(0))), least)


def _run_starts(minima: str) -> Column:
    """The minima where they change, and at every ``RUN``-th window; null elsewhere."""
    repeats = lambda x, i: (i % RUN != 0) & (F.get(minima, i - 1) == x)
    return F.transform(minima, lambda x, i: F.when(~F.coalesce(repeats(x, i), F.lit(False)), x))


def item_windows(items: DataFrame) -> DataFrame:
    """``item_id``, ``length``, ``window`` (its words joined by a space) and ``seed`` (its fingerprint)."""
    split = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("words"))
    hashed = written(_hashes(split, "item_id"), "items").where(F.size("words") > 0)
    grams = hashed.where(F.size("words") >= WINDOW).select("item_id", "words", _grams("hashes", GRAM).alias("grams"))
    minima = grams.select("item_id", "words", F.posexplode_outer(_winnowed("grams")).alias("start", "seed"))
    window = F.array_join(F.slice("words", F.col("start") + 1, WINDOW), " ")
    long = minima.select("item_id", F.lit(WINDOW).alias("length"), window.alias("window"), "seed")
    short = hashed.where(F.size("words") < WINDOW).select(
        "item_id", F.size("words").alias("length"), F.array_join("words", " ").alias("window"), F.xxhash64("hashes").alias("seed")
    )
    return long.union(short).distinct()


def _seeded(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """``doc_id``, ``tag``, ``words`` and, for each length of a window, ``seeds``.

    The seeds are the hashes to look up, null or from the word ``place - 1`` on; the first is null.
    Words are split and hashed once, whatever the number of lengths.
    """
    split = docs.select("doc_id", F.xxhash64("text").alias("tag"), words(F.col("text")).alias("words"))
    hashed = _hashes(split, "doc_id", "tag").withColumn("grams", _grams("hashes", GRAM)).withColumn("minima", _winnowed("grams"))
    lead = F.array(F.lit(None).cast("bigint"))
    found = [F.concat(lead, _run_starts("minima") if n == WINDOW else _grams("hashes", n)) for n in lengths]
    parts = F.array(*(F.struct(F.lit(n).alias("length"), seeds.alias("seeds")) for n, seeds in zip(lengths, found)))
    return hashed.select("doc_id", "tag", "words", F.explode_outer(parts).alias("part")).select("doc_id", "tag", "words", "part.*")


def _hits(docs: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """``doc_id``, ``tag``, ``n_words``, ``length``, ``start`` and the words ``around`` each hit.

    Every document also has one row with a null ``start``. A hash is looked up among those of all
    lengths; whether the words agree is compared later.
    """
    seeds = written(windows.select(F.col("seed").alias("found")).distinct(), "seeds")
    reach = F.when(F.col("length") == WINDOW, WINDOW + RUN - 1).otherwise(F.col("length"))
    around = F.slice("words", F.col("place"), reach)
    seeded, own = _seeded(docs, lengths), f"(place = 0 AND length = {WINDOW})"
    if seeds.count() <= BROADCAST_SEEDS:
        rows = seeded.select("doc_id", "tag", "words", "length", F.posexplode_outer("seeds").alias("place", "seed"))
        rows = rows.where(f"seed IS NOT NULL OR {own}").join(F.broadcast(seeds), F.col("seed") == F.col("found"), "left")
        rows = rows.where(f"found IS NOT NULL OR {own}")
    else:
        narrow = seeded.select("doc_id", "tag", "length", F.posexplode_outer("seeds").alias("place", "seed")).where("seed IS NOT NULL")
        found = narrow.join(seeds, F.col("seed") == F.col("found"), "left_semi")
        places = found.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("length", "place")).alias("places"))
        places = places.withColumnsRenamed({"doc_id": "found_id", "tag": "found_tag"})
        whole = docs.select("doc_id", F.xxhash64("text").alias("tag"), words(F.col("text")).alias("words"))
        same = whole["doc_id"].eqNullSafe(places["found_id"]) & (whole["tag"] == places["found_tag"])
        first = F.array(F.struct(F.lit(WINDOW).alias("length"), F.lit(0).alias("place")))
        all_places = F.concat(first, F.coalesce("places", F.array().cast("array<struct<length:int,place:int>>")))
        rows = whole.join(places, same, "left").select("doc_id", "tag", "words", F.explode_outer(all_places).alias("at"))
        rows = rows.select("doc_id", "tag", "words", "at.*")
    return rows.select(
        "doc_id",
        "tag",
        F.size("words").alias("n_words"),
        "length",
        F.when(F.col("place") > 0, F.col("place") - 1).alias("start"),
        F.when(F.col("place") > 0, around).alias("around"),
    )


def _occurrences(hits: DataFrame, windows: DataFrame) -> DataFrame:
    """Windows of items in documents: ``doc_id``, ``tag``, ``start``, ``length``, ``item_id``."""
    offsets = F.sequence(F.lit(0), F.size("around") - F.col("length"))
    fitting = hits.where((F.col("start").isNotNull()) & (F.size("around") >= F.col("length")))
    placed = fitting.select("doc_id", "tag", "start", "length", "around", F.explode(offsets).alias("offset"))
    text = F.array_join(F.slice("around", F.col("offset") + 1, F.col("length")), " ").alias("window")
    placed = placed.select("doc_id", "tag", (F.col("start") + F.col("offset")).alias("start"), "length", text)
    wanted = windows.select("length", "window", "item_id").distinct()
    return placed.join(wanted, ["length", "window"]).select("doc_id", "tag", "start", "length", "item_id")


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """For every row of ``docs``: ``doc_id``, ``tag``, ``n_words``, ``n_hit``, ``spans``, ``item_ids``.

    ``tag`` is the hash of the text, ``spans`` the (start, length) of the windows that occur,
    ``item_ids`` the sorted ids of their items, ``n_hit`` the number of words covered.
    """
    windows = written(item_windows(items), "windows")
    lengths = sorted({WINDOW, *(r.length for r in windows.select("length").distinct().collect())})
    hits = written(_hits(docs, windows, lengths), "hits")
    per_doc = _occurrences(hits, windows).groupBy(F.col("doc_id").alias("hit_id"), F.col("tag").alias("hit_tag")).agg(
        F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"),
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
    )
    covered = F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1))
    per_doc = per_doc.withColumn("n_hit", F.size(F.array_distinct(F.flatten(covered))))
    rows = hits.where("start IS NULL").select("doc_id", "tag", "n_words")
    same = rows["doc_id"].eqNullSafe(per_doc["hit_id"]) & (rows["tag"] == per_doc["hit_tag"])
    return rows.join(per_doc, same, "left").select(
        "doc_id",
        "tag",
        F.col("n_words").cast("bigint").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,length:int>>")).alias("spans"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, share: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are not contaminated.

    A document goes for one occurring window of ``WINDOW`` words, or if windows of shorter items
    make up ``share`` of its words: an item of a word or two is found in many clean documents.
    """
    whole = F.exists("spans", lambda span: span["length"] == WINDOW)
    much = (F.col("n_hit") > 0) & (F.col("n_hit") >= share * F.col("n_words"))
    gone = contamination(docs, items).where(whole | much)
    found = gone.select(F.col("doc_id").alias("hit_id"), F.col("tag").alias("hit_tag"))
    same = docs["doc_id"].eqNullSafe(F.col("hit_id")) & (F.xxhash64(docs["text"]) == F.col("hit_tag"))
    return docs.join(found.distinct().hint("merge"), same, "left_anti")
