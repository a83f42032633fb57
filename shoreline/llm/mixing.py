"""Rates per document that bring domains to target shares of the tokens. DataFrame functions only.

Documents belong to domains by degrees. A naive Bayes classifier learns from labelled rows and
gives every document a probability for each domain; a document's tokens count for the domains
in these proportions. The rates (how often to take a document, 0 or more) then minimise the squared
difference between the expected tokens of each domain and its target. A slight pull of all rates
towards 1 (``RIDGE``) makes the best rates unique: of those that meet the targets, the ones
that change least.

The descent is a projected gradient with lazy projection: gradients are added up as they are, and
their sum is cut at rate 0 when it is used. So a rate is ``max(0, 1 - p . sums)`` however many
steps there were, with one number per domain. Steps are scaled by the inverse second moments of the
documents whose rate is above 0, and halved where they do not improve. A step is one aggregation.
What is left of the gradient bounds how far the domains' tokens are from the best ones: by twice its
length. Steps end when it is ``TOLERANCE`` of all tokens; a fit that stops earlier warns.

Features of a text are hashes of its words (A-Z in lower case) and of their last two
characters. ``MAX_LABELLED`` labelled rows are learned from, the first by a hash of their id;
their counts fill two tables of ``BUCKETS`` rows, which is the bound of what is broadcast.

Edge cases. A null, empty or blank text has no tokens and the prior's probabilities. Rows without
``doc_id`` are classified but never learned from. Rows that repeat are documents of their own. Domains
without labelled rows keep a small prior. If targets cannot be met with rates of 0 or more, the
rates give the tokens nearest to them. Without any token all rates are 1. Further columns go through.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.llm.common import ascii_lower, unused_name, written

MAX_LABELLED = 20_000
BUCKETS = 1 << 16

#: A text counts as this many words of evidence, however long it is; keeps probabilities soft.
EVIDENCE = 30.0

RIDGE, TOLERANCE = 1e-9, 1e-10

#: Looks at the rows before a fit gives up. 2 to 10 do where targets can be met, some 50 where they are far off.
MAX_LOOKS = 100
BLANK = r"[\x20\x09-\x0D]+"


def _words(docs: DataFrame, *kept: str) -> DataFrame:
    """Each word's two feature buckets, and whether it is a text's first row.

    A text without words has one row with nulls.
    """
    parts = F.filter(F.split(ascii_lower(F.col("text")), BLANK), lambda w: w != "")
    rows = docs.select(*kept, F.posexplode_outer(parts).alias("place", "word"))
    return rows.select(
        *kept,
        F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).alias("whole"),
        F.pmod(F.xxhash64(F.substring("word", -2, 2)), F.lit(BUCKETS)).alias("ending"),
        F.col("word").isNotNull().cast("int").alias("is_word"),
        (F.coalesce("place", F.lit(0)) == 0).cast("int").alias("is_first"),
    )


def classifier(docs: DataFrame, labels: DataFrame, domains: list[str], domain: Column) -> tuple[DataFrame, DataFrame, list[float]]:
    """Log likelihoods by word bucket and by ending bucket, and log priors, all by domain."""
    named = labels.where(F.col("doc_id").isNotNull()).select("doc_id", domain.alias("domain")).where(F.col("domain").isin(domains))
    chosen = named.groupBy("doc_id").agg(F.max("domain").alias("domain"))
    chosen = written(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED), "labelled")
    prior = {r.domain: r["count"] for r in chosen.groupBy("domain").count().collect()}
    learned = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    words = _words(learned, "domain").where("is_word = 1")
    both = F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("whole").alias("bucket")), F.struct(F.lit(1).alias("kind"), F.col("ending").alias("bucket"))))
    counted = words.select("domain", both.alias("feature")).groupBy("feature.kind", "feature.bucket", "domain").count()
    counts = written(counted, "word-counts")
    totals = {(r["kind"], r["domain"]): r["n"] for r in counts.groupBy("kind", "domain").agg(F.sum("count").alias("n")).collect()}

    def weights(kind: int, name: str) -> DataFrame:
        own = counts.where(F.col("kind") == kind).groupBy(F.col("bucket").alias(name))
        logs = [
            F.log((F.coalesce(F.sum(F.when(F.col("domain") == d, F.col("count"))), F.lit(0)) + 0.5) / (totals.get((kind, d), 0) + 0.5 * BUCKETS)).alias(f"{name}_{i}")
            for i, d in enumerate(domains)
        ]
        return own.agg(*logs)

    n = sum(prior.values())
    return weights(0, "whole"), weights(1, "ending"), [float(np.log((prior.get(d, 0) + 1) / (n + len(domains)))) for d in domains]


def posteriors(docs: DataFrame, labels: DataFrame, domains: list[str], domain: Column) -> DataFrame:
    """``doc_id``, ``tag`` (hash of the text), ``n_tokens`` and ``p_0``, ``p_1``, ... once per id and text."""
    whole, ending, prior = classifier(docs, labels, domains, domain)
    words = _words(docs.select("doc_id", F.xxhash64("text").alias("tag"), "text"), "doc_id", "tag")
    found = words.join(F.broadcast(whole), "whole", "left").join(F.broadcast(ending), "ending", "left")
    sums = [F.sum(F.coalesce(f"whole_{i}", F.lit(0.0)) + F.coalesce(f"ending_{i}", F.lit(0.0))).alias(f"s_{i}") for i in range(len(domains))]
    summed = found.groupBy("doc_id", "tag").agg(F.sum("is_first").alias("copies"), F.sum("is_word").alias("n_tokens"), *sums)
    # Rows that repeat were added up; the texts themselves need not be brought together.
    once = [(F.col(f"s_{i}") / F.col("copies")).alias(f"s_{i}") for i in range(len(domains))]
    summed = summed.select("doc_id", "tag", F.expr("n_tokens DIV copies").alias("n_tokens"), *once)
    weight = F.least(F.col("n_tokens"), F.lit(EVIDENCE)) / F.greatest(F.col("n_tokens"), F.lit(1))
    logits = summed.select("doc_id", "tag", "n_tokens", *((weight * F.col(f"s_{i}") + prior[i]).alias(f"l_{i}") for i in range(len(domains))))
    top = F.greatest(*(F.col(f"l_{i}") for i in range(len(domains)))) if len(domains) > 1 else F.col("l_0")
    exps = logits.select("doc_id", "tag", "n_tokens", *(F.exp(F.col(f"l_{i}") - top).alias(f"e_{i}") for i in range(len(domains))))
    total = reduce(lambda a, b: a + b, (F.col(f"e_{i}") for i in range(len(domains))))
    return exps.select("doc_id", "tag", "n_tokens", *((F.col(f"e_{i}") / total).alias(f"p_{i}") for i in range(len(domains))))


@dataclass(frozen=True)
class Fit:
    """Rates as a column, the tokens above target by domain, and the gradient left, as shares of all tokens."""

    rate: Column
    gaps: list[float]
    residual: float
    looks: int


def _dot(sums: np.ndarray) -> Column:
    return reduce(lambda a, b: a + b, (F.col(f"p_{i}") * float(y) for i, y in enumerate(sums)))


def fitted(rows: DataFrame, shares: list[float]) -> Fit:
    """The rates that fit expected tokens to ``shares`` of all tokens (a column over ``rows``)."""
    k, n = len(shares), F.col("n_tokens").cast("double")
    total = rows.agg(F.sum(n)).first()[0]
    if not total:
        return Fit(F.lit(1.0), [0.0] * k, 0.0, 1)
    target, ridge = np.array(shares) / sum(shares) * total, RIDGE * total
    sides = [(i, j) for i in range(k) for j in range(i, k)]

    def look(sums: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """How good the sums are (higher is better), what is left of the gradient, moments, gaps."""
        change = _dot(sums)
        rate = F.greatest(F.lit(0.0), 1.0 - change)
        seen = rows.withColumns({"taken": n * rate, "moved": n * ((rate - 1.0) * (rate - 1.0) / 2 + change * rate), "live": F.when(rate > 0, n).otherwise(0.0)})
        found = seen.agg(
            F.sum("moved"),
            *(F.sum(F.col("taken") * F.col(f"p_{i}")) for i in range(k)),
            *(F.sum(F.col("live") * F.col(f"p_{i}") * F.col(f"p_{j}")) for i, j in sides),
        ).first()
        gaps, moments = np.array(found[1 : k + 1]) - target, ridge * np.eye(k)
        for (i, j), value in zip(sides, found[k + 1 :]):
            moments[i, j] += value
            moments[j, i] = moments[i, j]
        return found[0] - sums @ target - ridge * (sums @ sums) / 2, gaps - ridge * sums, moments, gaps

    sums = np.zeros(k)
    value, left, moments, gaps = look(sums)
    looks, size = 2, 1.0
    while np.abs(left).max() > TOLERANCE * total and looks < MAX_LOOKS and size > 1e-9:
        step = np.linalg.solve(moments, left)
        ahead = look(sums + size * step)
        looks += 1
        # The last term is for sums of doubles that come in another order.
        if ahead[0] >= value + 1e-4 * size * (left @ step) - 1e-13 * abs(value):
            sums, (value, left, moments, gaps), size = sums + size * step, ahead, 1.0
        else:
            size /= 2
    residual = float(np.abs(left).max() / total)
    if residual > TOLERANCE:
        warnings.warn(f"rates end with a gradient of {residual:.1e} of all tokens after {looks} looks", stacklevel=2)
    return Fit(F.greatest(F.lit(0.0), 1.0 - _dot(sums)), (gaps / total).tolist(), residual, looks)


def mixed(docs: DataFrame, labels: DataFrame, shares: dict[str, float], domain: Column) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with token count, probabilities and rate; names of the added columns by what they hold.

    ``shares`` are the domains' target weights, ``domain`` the domain of a row of ``labels``.
    """
    domains = list(shares)
    found = written(posteriors(docs, labels, domains, domain), "posteriors")
    numbers = ["n_tokens", *(f"p_{i}" for i in range(len(domains)))]
    found = found.withColumnsRenamed({"doc_id": "found_id", "tag": "found_tag"}).hint("merge")
    # Fitting needs every row, also repeated ones, but neither texts nor further columns.
    places = docs.select("doc_id", F.xxhash64("text").alias("tag"))
    same = places["doc_id"].eqNullSafe(found["found_id"]) & (places["tag"] == found["found_tag"])
    rows = written(places.join(found, same).select(numbers), "mixing")
    rate = fitted(rows, [shares[d] for d in domains]).rate
    names = {w: unused_name(docs, n) for w, n in (("n_tokens", "n_tokens"), *((d, f"p_{d}") for d in domains), ("rate", "rate"))}
    rated = found.select(
        F.col("found_id").alias("_found_id"),
        F.col("found_tag").alias("_found_tag"),
        *(F.col(n).alias(f"_found_{n}") for n in numbers),
        rate.alias("_found_rate"),
    )
    # Hashed before the join: as a key, the expression would take the text through the shuffle.
    tag = unused_name(docs, "tag")
    tagged = docs.withColumn(tag, F.xxhash64("text"))
    same = tagged["doc_id"].eqNullSafe(rated["_found_id"]) & (tagged[tag] == rated["_found_tag"])
    joined = tagged.join(rated.hint("merge"), same)
    added = [rated[f"_found_{n}"].alias(name) for n, name in zip([*numbers, "rate"], names.values())]
    return joined.select(*(tagged[c] for c in docs.columns), *added), names
