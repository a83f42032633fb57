"""License scans: an exact set-similarity join of text blocks with license templates.

A template is a set of words with a share of them (its containment threshold) that a block must
hold. The words of all templates are ordered by how often the whole corpus has them, rarest
first. A block that holds enough of a template holds one of the template's first words in that
order, its prefix, so only blocks with such a word are looked at (prefix filter), only with as
many template words as the threshold asks for (length filter), and only while the words still to
come can make up what is missing (positional filter). What passes is compared exactly.

Blocks are windows of ``2 * reach`` words, one at every multiple of ``reach``, which is the
power of two from the template's length up. Each passage of up to ``reach`` words lies whole in
one of them, so none is lost at a border.

A template marked as phrase also asks for its words one after the other; each place counts.

The templates are given, not found: they go to the tasks with the code, up to ``MAX_WORDS``
different words, and more are an error. Documents stay where they are read; the only shuffle is
that of the word counts, at most one row per template word and task.

Words are runs of letters, digits and non-ASCII characters, A-Z in lower case. Edge cases: a
null, empty or blank text has no words and no matches. Texts are taken in pieces of about
``common.SLICE_BYTES``, of a text of any length only one small number per word is held. Rows
that repeat, or share an id, are scanned each on its own. Further columns go through, but for
the text; added columns get a name that none of them has.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, LongType, StructField, StructType

from shoreline.llm.common import SLICE_BYTES, slices, unused_name

#: Different words that all templates may have together.
MAX_WORDS = 30_000

_BLANK = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
_MATCHES = "array<struct<label: string, phrase: boolean, places: bigint, first: bigint, last: bigint, containment: double>>"


@dataclass(frozen=True)
class Template:
    """``containment`` is the share of the different words that a block must hold."""

    label: str
    text: str
    containment: float = 0.8
    phrase: bool = False

    @cached_property
    def words(self) -> tuple[bytes, ...]:
        return tuple(self.text.encode().translate(_BLANK).split())

    @property
    def need(self) -> int:
        share = 1.0 if self.phrase else self.containment
        return math.ceil(share * len(set(self.words)) - 1e-9)

    @property
    def reach(self) -> int:
        return 1 << (len(self.words) - 1).bit_length()


# The phrases that are looked for word by word, and what their places are called.
PHRASES = (
    Template("mit", "under the mit license", phrase=True),
    Template("apache-2", "apache license version 2", phrase=True),
    Template("cc-by-nc", "cc by nc", phrase=True),
)
# Sentences of public licenses. Those that differ from others in a word or two
# need all of their words.
NOTICES = (
    Template("gpl-3", "GNU General Public License version 3", 1.0),
    Template("gpl-2", "GNU General Public License version 2", 1.0),
    Template("lgpl", "GNU Lesser General Public License", 1.0),
    Template("agpl", "GNU Affero General Public License", 1.0),
    Template("cc-by-sa", "Creative Commons Attribution ShareAlike", 1.0),
    Template("cc-by-nc", "Creative Commons Attribution NonCommercial", 1.0),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the Software), to deal in the Software without restriction, including"
        " without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell"
        " copies of the Software",
    ),
    Template(
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version of the License, or (at your"
        " option) any later version",
    ),
    Template(
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL"
        " was not distributed with this file, You can obtain one at",
    ),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
)


def word_counts(docs: DataFrame, templates: Sequence[Template]) -> dict[bytes, int]:
    """How often the corpus has each word of the templates; one row per such word is gathered."""
    vocabulary = {word: place for place, word in enumerate(sorted({w for t in templates for w in t.words}))}
    if not vocabulary or min(len(t.words) for t in templates) == 0:
        raise ValueError("a template needs words")
    if len(vocabulary) > MAX_WORDS:
        raise ValueError(f"the templates have {len(vocabulary)} different words, {MAX_WORDS} are allowed")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(vocabulary) + 1, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                for text in part.column("text").to_pylist():
                    for numbers in _numbered(text, vocabulary):
                        totals += np.bincount(numbers + 1, minlength=len(totals))
        found = np.flatnonzero(totals[1:])
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(totals[1:][found])], names=["word", "n"])

    counts = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(count, "word bigint, n bigint")
    total = {row.word: row.n for row in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return {word: total.get(place, 0) for word, place in vocabulary.items()}


def _numbered(text: bytes | None, numbers: dict[bytes, int]) -> Iterator[np.ndarray]:
    """The number of each word, -1 for words without one, of consecutive pieces of a text."""
    text, start = text or b"", 0
    while start < len(text):
        end = start + SLICE_BYTES
        while end < len(text) and _BLANK[text[end]] != 32:
            end += 1
        words = text[start:end].translate(_BLANK).split()
        yield np.fromiter(map(numbers.get, words, repeat(-1)), np.int32, len(words))
        start = end


class Index:
    """Templates as ranks of their words, rarest first, and the postings of their prefixes."""

    def __init__(self, templates: Sequence[Template], counts: dict[bytes, int]):
        self.templates = templates
        self.rank = {word: i for i, word in enumerate(sorted(counts, key=lambda w: (counts[w], w)))}
        self.members = [frozenset(map(self.rank.__getitem__, t.words)) for t in templates]
        self.postings: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for number, (template, members) in enumerate(zip(templates, self.members)):
            lists = self.postings.setdefault(template.reach, {})
            for place, rank in enumerate(sorted(members)[: len(members) - template.need + 1]):
                lists.setdefault(rank, []).append((number, place))
        self.starters = {reach: np.zeros(len(self.rank) + 1, bool) for reach in self.postings}
        for reach, lists in self.postings.items():
            self.starters[reach][list(lists)] = True

    def joined(self, block: np.ndarray, reach: int) -> Iterator[tuple[int, int]]:
        """Template and number of shared words, for each template the block holds enough of.

        ``block`` has the block's different template words by rank.
        """
        shared: dict[int, int] = {}
        postings, size = self.postings[reach], len(block)
        for place, rank in enumerate(block.tolist()):
            for number, own in postings.get(rank, ()):
                need = self.templates[number].need
                if size < need:
                    continue
                before = shared.get(number, 0)
                possible = before + min(len(self.members[number]) - own, size - place) >= need
                shared[number] = before + 1 if possible else -size
        for number, prefix in shared.items():
            if prefix > 0:
                overlap = len(self.members[number].intersection(block.tolist()))
                if overlap >= self.templates[number].need:
                    yield number, overlap

    def found(self, ranks: np.ndarray) -> list[dict]:
        """Per template of which a text holds enough: its places and its largest containment."""
        matches: dict[int, dict] = {}
        for reach, starters in self.starters.items():
            hits = np.flatnonzero(starters[ranks]) // reach
            for k in np.unique(np.concatenate((hits, hits[hits > 0] - 1))).tolist():
                window = ranks[k * reach : (k + 2) * reach]
                block = np.unique(window[window >= 0])
                for number, overlap in self.joined(block, reach):
                    starts = self._places(window, number, reach) if self.templates[number].phrase else [0]
                    if len(starts):
                        share = overlap / len(self.members[number])
                        self._add(matches, number, k * reach + int(starts[0]), k * reach + int(starts[-1]), len(starts), share)
        return [matches[number] for number in sorted(matches)]

    def _places(self, window: np.ndarray, number: int, reach: int) -> np.ndarray:
        """Where a phrase begins in the first half of a window; the second is the next one's."""
        words = [self.rank[w] for w in self.templates[number].words]
        n = min(reach, len(window) - len(words) + 1)
        if n <= 0:
            return np.empty(0, np.int64)
        return np.flatnonzero(np.logical_and.reduce([window[i : i + n] == w for i, w in enumerate(words)]))

    def _add(self, matches: dict, number: int, first: int, last: int, places: int, share: float) -> None:
        template = self.templates[number]
        new = {"label": template.label, "phrase": template.phrase, "places": 0, "first": first, "last": last, "containment": share}
        match = matches.setdefault(number, new)
        match["places"] += places
        match["last"] = max(match["last"], last)
        match["containment"] = max(match["containment"], share)


def scanned(docs: DataFrame, templates: Sequence[Template] = PHRASES + NOTICES) -> tuple[DataFrame, str, str]:
    """``docs`` without the text, with word count and matches; names of these two columns.

    A match has its label, the number of places (of a phrase) or blocks, the first and last of
    their starts counted in words from 0, and the largest containment, at most one per template.
    """
    index = Index(templates, word_counts(docs, templates))
    n_words, matches = unused_name(docs, "n_words"), unused_name(docs, "matches")
    kept = [c for c in docs.columns if c != "text"]
    kind = DataType.fromDDL(_MATCHES)
    schema = StructType(
        [docs.schema[c] for c in kept] + [StructField(n_words, LongType()), StructField(matches, kind)]
    )
    arrow_kind, names = to_arrow_type(kind), [*kept, n_words, matches]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sizes, found = [], []
                for text in part.column("text").to_pylist():
                    pieces = list(_numbered(text, index.rank))
                    ranks = np.concatenate(pieces) if pieces else np.empty(0, np.int32)
                    sizes.append(len(ranks))
                    found.append(index.found(ranks))
                columns = [part.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(sizes, pa.int64()), pa.array(found, arrow_kind)], names=names
                )

    return docs.withColumn("text", F.col("text").cast("binary")).mapInArrow(scan, schema), n_words, matches
