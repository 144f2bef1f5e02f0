"""License scan: an exact set-similarity join of text blocks with license templates.

A template is met by a text block whose words contain at least the threshold's share of the
template's distinct words. Words are ordered by how often they occur in all documents, rarest first,
and three filters leave few candidates without losing one: of a template with m words that needs o
of them, one of the m - o + 1 rarest must be in the block (prefix), the block needs o template words
(length), and after a common word at known places in both orders enough words must be left (position).
Candidates are verified. Blocks are runs of words, twice as long as the longest template and
overlapping by half, so that any passage as long as a template lies in one of them.

Templates are a parameter of bounded size, sent to all tasks; documents are never shuffled.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estrella.llm.shipping import ship
from estrella.llm.words import in_slices, utf8_texts

MAX_TEMPLATE_WORDS = 1_000_000


@dataclass(frozen=True)
class Template:
    """A license text. A phrase counts only where its words stand consecutively."""

    label: str
    text: str
    phrase: bool = False


# The base phrases and their labels.
BASE = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
)

# Notices of common licenses, as their publishers word them.
NOTICES = (
    Template("apache-notice", "Licensed under the Apache License, Version 2.0"),
    Template("gpl-notice", "licensed under the GNU General Public License"),
    Template("cc-by-nc-notice", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-sa-notice", "Licensed under CC BY-SA 4.0"),
    Template(
        "mit-notice",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so",
    ),
    Template(
        "bsd-notice",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    Template("mpl-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template(
        "isc-notice",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    Template("public-domain-notice", "This is free and unencumbered software released into the public domain"),
)

# Word characters are digits, a-z after lower-casing A-Z, and everything beyond ASCII.
_TO_WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def license_words(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


class TemplateIndex:
    """Templates with their words ordered from rare to frequent, and the prefix postings."""

    def __init__(self, templates: tuple[Template, ...], counts: dict[bytes, int], threshold: float):
        sequences = [license_words(t.text.encode()) for t in templates]
        vocabulary = sorted({w for s in sequences for w in s}, key=lambda w: (counts.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(vocabulary)}
        self.templates = templates
        self.sequences = [np.array([self.rank[w] for w in s], np.int64) for s in sequences]
        self.sets = [np.unique(s) for s in self.sequences]
        self.needed = [
            len(s) if t.phrase else max(1, int(np.ceil(threshold * len(s) - 1e-9)))
            for t, s in zip(templates, self.sets, strict=True)
        ]
        self.stride = max((len(s) for s in self.sequences), default=1)
        self.postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, words in enumerate(self.sets):
            for j, word in enumerate(words[: len(words) - self.needed[t] + 1]):
                self.postings[int(word)].append((t, j))
        self.is_prefix = np.zeros(len(vocabulary), bool)
        self.is_prefix[list(self.postings)] = True

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int, float]], list[tuple[int, int]]]:
        """Blocks that meet templates, as (template, block, containment), and places of phrases, as (template, word)."""
        rank = self.rank
        spots = [(i, rank[w]) for i, w in enumerate(words) if w in rank]
        if not spots:
            return [], []
        at, tokens = (np.array(x, np.int64) for x in zip(*spots, strict=True))
        rare = at[self.is_prefix[tokens]]
        met, places = [], []
        own = rare // self.stride
        for block in np.unique(np.concatenate([own, own[own > 0] - 1])):
            low = block * self.stride
            first, last = np.searchsorted(at, (low, low + 2 * self.stride))
            found = np.unique(tokens[first:last])
            for t in self._candidates(found):
                common = len(np.intersect1d(found, self.sets[t], assume_unique=True))
                if common < self.needed[t]:
                    continue
                if not self.templates[t].phrase:
                    met.append((t, int(block), common / len(self.sets[t])))
                    continue
                # verified word by word; a place belongs to the block in whose first half it starts
                sequence = self.sequences[t]
                here = {int(p): int(w) for p, w in zip(at[first:last], tokens[first:last], strict=True)}
                starts = [p for p, w in here.items() if w == sequence[0] and p < low + self.stride]
                hits = [p for p in starts if all(here.get(p + k) == w for k, w in enumerate(sequence))]
                places += [(t, p) for p in hits]
        return met, places

    def _candidates(self, found: np.ndarray) -> set[int]:
        out = set()
        for i, word in enumerate(found):
            for t, j in self.postings.get(int(word), ()):
                needed = self.needed[t]
                left = min(len(found) - i - 1, len(self.sets[t]) - j - 1)
                if len(found) >= needed and 1 + left >= needed:
                    out.add(t)
        return out


def word_counts(docs: DataFrame, words: set[bytes]) -> dict[bytes, int]:
    """How often each of a bounded set of words occurs in all documents (column text)."""

    def count(batches):
        total: Counter[bytes] = Counter()

        def one(batch):
            for text in utf8_texts(batch, "text"):
                total.update(w for w in license_words(text) if w in words)

        for _ in in_slices(one)(batches):
            pass
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["word", "n"]
        )

    counted = docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in counted.collect()}


def scan_licenses(
    docs: DataFrame,
    templates: tuple[Template, ...] = NOTICES,
    phrases: tuple[Template, ...] = BASE,
    threshold: float = 0.9,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    ``phrases`` are found at every place where their words stand consecutively (n_base; first_word
    and last_word are the smallest and largest start). ``templates`` are met by blocks. ``spans`` lists
    (label, start, end, containment) in words. ``score`` is the largest containment, 1 for a phrase
    and 0 without a hit. A NULL or empty text has no words and empty labels; first and last are NULL
    without a place. Every row stays, repeated ones and those with a NULL id too. Other columns are
    ignored. An empty input gives an empty result.
    """
    spark: SparkSession = docs.sparkSession
    ship(spark)
    every = (*phrases, *templates)
    vocabulary = {w for t in every for w in license_words(t.text.encode())}
    if sum(len(t.text.split()) for t in every) > MAX_TEMPLATE_WORDS:
        raise ValueError("the templates are too many to be sent to all tasks")
    docs = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")
    )
    index = TemplateIndex(every, word_counts(docs, vocabulary), threshold)
    shared = spark.sparkContext.broadcast(index)
    span = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())])

    def one(batch):
        index = shared.value
        rows = []
        for text_ in utf8_texts(batch, "text"):
            words = license_words(text_)
            met, places = index.scan(words)
            base = sorted({index.templates[t].label for t, _ in places})
            labels = sorted({*base, *(index.templates[t].label for t, _, _ in met)})
            spans = [(index.templates[t].label, p, p + len(index.sequences[t]), 1.0) for t, p in places]
            spans += [
                (index.templates[t].label, b * index.stride, min(len(words), (b + 2) * index.stride), c) for t, b, c in met
            ]
            starts = [p for _, p in places]
            rows.append(
                (
                    len(words),
                    len(places),
                    min(starts, default=None),
                    max(starts, default=None),
                    ",".join(base),
                    ",".join(labels),
                    max((s[3] for s in spans), default=0.0),
                    [dict(zip(("label", "start", "end", "containment"), s, strict=True)) for s in sorted(spans)],
                )
            )
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]
        columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
            names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        in_slices(one),
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, spans array<struct<label:string,start:bigint,end:bigint,containment:double>>",
    )
