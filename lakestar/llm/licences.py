"""Licence scans: a generalised suffix automaton of licence texts, matching statistics of each file, chained matches.

The automaton holds the normalised words of all templates (licence texts, notices and the base phrases). Files are streamed
through it; at each word it tells the longest match that ends there and, by its state, where in which templates. A match
that a template doesn't continue is an anchor of that template; anchors of ``least`` words and more (or of a whole shorter
template) are chained where they follow one another in file and template alike, with ``gap`` words at most between them.
A chain's coverage is the share of its template's words that it covers; from ``coverage`` on the span has the template's
label. Whole base phrases are counted at every place, from the same pass.

Defined results: null and empty texts have no words, no labels and the score 0. Places of different phrases count each,
also where they overlap. Of equal chains the first by file place stays. Templates of the same words have all their labels.
Repeated rows are scanned alike, a very long text whole, its words looked up in slices. An empty table gives no rows;
columns that the scan adds replace those of the same name, others are kept by ``scan`` and ignored by ``report``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.llm.common import extended, release, text_batches
from lakestar.llm.decontam import _WORDS, SuffixAutomaton, words

#: Phrases that are counted at every place, with their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Notices and characteristic passages of public licences, with their labels.
TEMPLATES = (
    ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
    ('you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0', "apache-2.0"),
    ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.", "apache-2.0"),
    ("Released under the MIT License", "mit"),
    ("Licensed under the MIT License", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", "mit"),
    ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", "mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "bsd"),
    ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "bsd"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "isc"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2.0"),
    ("licensed under the GNU General Public License, version 3", "gpl-3.0"),
    ("licensed under the GNU General Public License, version 2", "gpl-2.0"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "gpl-3.0"),
    ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "gpl-2.0"),
    ("under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "lgpl"),
    ("under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "agpl"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc-4.0"),
    ("Licensed under CC BY-SA 4.0", "cc-by-sa-4.0"),
    ("Licensed under CC BY 4.0", "cc-by-4.0"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by-4.0"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc-4.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa-4.0"),
    ("the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law", "cc0-1.0"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
)


class LicenceAutomaton(SuffixAutomaton):
    """The automaton of phrases and templates, with the places of each state's strings in them."""

    def __init__(self, phrases: Iterable[tuple[str, str]] = PHRASES, templates: Iterable[tuple[str, str]] = TEMPLATES, least: int = 3):
        self.phrases, templates = list(phrases), list(templates)
        texts = [words(text) for text, _ in (*self.phrases, *templates)]
        self.labels = [label for _, label in (*self.phrases, *templates)]
        # Every template is shorter than the window, so that its states tell where it occurs as a whole.
        super().__init__([(str(i), ws) for i, ws in enumerate(texts)], window=1 << 30)
        self.texts, self.sizes = [[self.vocabulary[w] for w in ws] for ws in texts], [len(ws) for ws in texts]
        self.shortest = [min(least, n) for n in self.sizes]
        self.ends: list[dict[tuple[int, int], None]] = [{} for _ in self.next]
        for i, ws in enumerate(texts):
            for end, (state, _) in enumerate(self._walk(self.texts[i]), 1):
                while state > 0:
                    if self.length[state] >= self.shortest[i]:
                        self.ends[state][i, end] = None
                    state = self.link[state]
        self.wholes = [[(n, int(owner)) for n, owners in short for owner in owners if int(owner) < len(self.phrases)] for short in self.shorter]

    def read(self, ids: np.ndarray) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, int]]]:
        """Places of whole phrases (start, phrase) and anchors (template, start, end, template's end) of a file's word ids."""
        places, anchors = [], []
        for first, last in self.stretches(ids):
            for end, (state, matched) in enumerate(self._walk(ids[first:last].tolist()), 1):
                for n, phrase in self.wholes[state]:
                    if n <= matched:
                        places.append((first + end - n, phrase))
                # The longest match, then what shorter ones of its suffixes more templates hold.
                known, length, onward = (), matched, ids[first + end] if first + end < len(ids) else -1
                while state > 0 and length >= self.least:
                    for template, at in self.ends[state]:
                        if length >= self.shortest[template] and (template, at) not in known and not (at < self.sizes[template] and self.texts[template][at] == onward):
                            anchors.append((template, first + end - length, first + end, at))
                    known, state = self.ends[state], self.link[state]
                    length = self.length[state]
        return places, anchors

    def chains(self, anchors: list[tuple[int, int, int, int]], gap: int) -> list[tuple[int, int, int, int]]:
        """Best chain from each first anchor: (template, start, end, covered words), by template and start."""
        found: dict[tuple[int, int], tuple[int, int]] = {}
        last, open_ = -1, []
        for template, start, end, at in sorted(set(anchors), key=lambda a: (a[0], a[2], a[3])):
            if template != last:
                last, open_ = template, []
            size = end - start
            best, root = size, start
            # What ends too far ahead of here ends too far ahead of all that follow.
            longest = self.sizes[template]
            open_ = [x for x in open_ if end - x[0] <= gap + longest]
            for other_end, other_at, covered, begin in open_:
                if other_end < end and other_at < at and start - other_end <= gap:
                    overlap = max(0, other_end - start, other_at - (at - size))
                    if overlap < size and (covered + size - overlap > best or covered + size - overlap == best and begin < root):
                        best, root = covered + size - overlap, begin
            open_.append((end, at, best, root))
            if best > found.get((template, root), (0, 0))[1]:
                found[template, root] = (end, best)
        return sorted((template, root, end, best) for (template, root), (end, best) in found.items())


def _ids(text: str | None, vocabulary: dict[bytes, int], size: int = 1 << 22) -> np.ndarray:
    """Word ids of a whole text, -1 for words that no template has; words are made for ``size`` bytes at a time."""
    data = text.encode("utf-8", "replace").translate(_WORDS) if text else b""
    out, at = [], 0
    while at < len(data):
        cut = data.find(b" ", at + size)
        cut = len(data) if cut < 0 else cut
        part = data[at:cut].split()
        out.append(np.fromiter(map(vocabulary.get, part, repeat(-1)), np.int64, len(part)))
        at = cut
    return np.concatenate(out) if out else np.zeros(0, np.int64)


_ADDED = ("n_words", "places", "licences")


def scan(docs: DataFrame, phrases: Iterable[tuple[str, str]] = PHRASES, templates: Iterable[tuple[str, str]] = TEMPLATES, least: int = 3, gap: int = 8) -> DataFrame:
    """``docs`` plus n_words, places (start and label of each whole phrase) and licences (label, start, end, coverage of each chain).

    Starts and ends count words. The automaton has at most two states a word of the given texts, and goes to every
    executor once; there is no shuffle.
    """
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(LicenceAutomaton(phrases, templates, least))
    docs = docs.drop(*_ADDED)
    place = T.StructType().add("start", "long").add("label", "string")
    chain = T.StructType().add("label", "string").add("start", "long").add("end", "long").add("coverage", "double")
    schema = extended(docs.schema, n_words="long", places=T.ArrayType(place), licences=T.ArrayType(chain))
    places_type = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))
    chains_type = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())]))

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        sam = shared.value
        for batch in batches:
            n_words, places, licences = [], [], []
            for text in batch.column("text"):
                ids = _ids(text.as_py(), sam.vocabulary)
                found, anchors = sam.read(ids) if (ids >= 0).any() else ([], [])
                n_words.append(len(ids))
                places.append([{"start": start, "label": sam.labels[p]} for start, p in found])
                licences.append([{"label": sam.labels[t], "start": start, "end": end, "coverage": covered / sam.sizes[t]} for t, start, end, covered in sam.chains(anchors, gap)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n_words, pa.int64()), pa.array(places, places_type), pa.array(licences, chains_type)], names=[*batch.schema.names, *_ADDED])

    return docs.mapInArrow(one, schema)


def report(docs: DataFrame, coverage: float = 0.75, **options) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word (of base places), base_labels, labels, score (best coverage), spans of licences."""
    found = scan(docs.select("doc_id", "text"), **options)
    starts = F.transform("places", lambda x: x["start"])
    named = F.filter("licences", lambda x: x["coverage"] >= coverage)
    label = lambda of: F.transform(of, lambda x: x["label"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(label("places")).alias("base_labels"), joined(F.concat(label("places"), label(named))).alias("labels"),
        F.coalesce(F.array_max(F.transform("licences", lambda x: x["coverage"])), F.lit(0.0)).alias("score"), named.alias("spans"),
    )
