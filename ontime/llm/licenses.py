"""License scans: MinHash bands over overlapping windows find templates, exact containment verifies them."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
# The chance that no band of a window that holds a template agrees with it stays below this.
MISS_CHANCE = 1e-4
SEED = 9

# Wordings of licences, by name. Short notices first, then the parts of full texts that mark them.
TEMPLATES = {
    "MIT notice": "Released under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution."
    ),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "GPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means."
    ),
}

# Words are runs of letters, digits and non-ASCII bytes; case does not count.
_PLAIN = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256)).lower()
_FOLD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """A hash per window of ``SHINGLE_WORDS`` words."""
    n = len(words) - SHINGLE_WORDS + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    total = np.zeros(n, np.uint64)
    for k in range(SHINGLE_WORDS):
        total = (total ^ hashes[k : k + n]) * _FOLD[k]
        total ^= total >> np.uint64(31)
    return total


def shingles(words: list[bytes]) -> list[bytes]:
    return [b" ".join(words[i : i + SHINGLE_WORDS]) for i in range(len(words) - SHINGLE_WORDS + 1)]


@dataclass(frozen=True)
class SizeClass:
    """Templates of like size, and the windows in which they are sought.

    Windows of ``3 * step`` shingles start at every ``step``; a template has at most ``2 * step``, so
    wherever it stands a window holds all of it. A window that contains 0.8 of a template of more than
    ``step`` shingles is similar to it (Jaccard) by ``similarity`` at least, and so many bands, each a
    MinHash of one row, miss it with a chance below ``MISS_CHANCE``.
    """

    step: int
    names: tuple[str, ...]
    bands: int = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "bands", math.ceil(math.log(MISS_CHANCE) / math.log1p(-self.similarity)))

    @property
    def similarity(self) -> float:
        smallest, window = (self.step + 1 if self.step > 1 else 1), 3 * self.step
        return CONTAINMENT * smallest / (window + (1 - CONTAINMENT) * smallest)


class Library:
    """Templates ready for a scan; there are as many as the caller names, so all of them go to every task."""

    def __init__(self, templates: dict[str, str]):
        self.words = {name: normal_words(text.encode()) for name, text in templates.items()}
        short = [name for name, words in self.words.items() if len(words) < SHINGLE_WORDS]
        if short:
            raise ValueError(f"templates of fewer than {SHINGLE_WORDS} words: {short}")
        self.exact = {name: frozenset(shingles(words)) for name, words in self.words.items()}
        by_step: dict[int, list[str]] = {}
        for name, own in self.exact.items():
            by_step.setdefault(max(1, 1 << max(0, math.ceil(math.log2(len(own))) - 1)), []).append(name)
        self.classes = [SizeClass(step, tuple(sorted(names))) for step, names in sorted(by_step.items())]
        self.rows = max(c.bands for c in self.classes)
        rng = np.random.default_rng(SEED)
        self.odd = rng.integers(1, 1 << 63, self.rows, np.uint64) | np.uint64(1)
        self.minima = {
            name: [int(self.permuted(shingle_hashes(words), k).min()) for k in range(self.rows)]
            for name, words in self.words.items()
        }

    def permuted(self, hashes: np.ndarray, k: int) -> np.ndarray:
        mixed = hashes * self.odd[k]
        return mixed ^ (mixed >> np.uint64(32))

    def candidates(self, hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, str]]:
        """``(document, window start, template)`` for windows that agree with a template in some band.

        ``hashes`` holds the shingles of several documents one after another. Blocks of ``step`` shingles
        are reduced to their minimum, and a window's MinHash is the least of its three blocks.
        """
        found: set[tuple[int, int, str]] = set()
        permuted = {}
        layouts = [self._blocks(c.step, starts, sizes) for c in self.classes]
        for k in range(self.rows):
            values = self.permuted(hashes, k)
            for size_class, (cuts, doc, at, last) in zip(self.classes, layouts):
                if k >= size_class.bands or not len(cuts):
                    continue
                least = np.minimum.reduceat(values, cuts)
                window = least.copy()
                for ahead in (1, 2):
                    inside = np.flatnonzero(last >= ahead)
                    window[inside] = np.minimum(window[inside], least[inside + ahead])
                for name in size_class.names:
                    for w in np.flatnonzero(window == np.uint64(self.minima[name][k])).tolist():
                        found.add((int(doc[w]), int(at[w]), name))
        return sorted(found)

    @staticmethod
    def _blocks(step: int, starts: np.ndarray, sizes: np.ndarray):
        """Per block: its first shingle, document, place in the document, and how many blocks follow in it."""
        counts = -(-sizes // step)
        doc = np.repeat(np.arange(len(sizes)), counts)
        place = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        return np.repeat(starts, counts) + place * step, doc, place * step, np.repeat(counts, counts) - 1 - place

    def verify(self, words: list[bytes], at: int, name: str) -> tuple[float, int, int] | None:
        """Containment of a template in the window at a shingle, with the first and last matching shingle; or None."""
        step = next(c.step for c in self.classes if name in c.names)
        own = shingles(words[at : at + 3 * step + SHINGLE_WORDS - 1])
        wanted = self.exact[name]
        hits = [i for i, s in enumerate(own) if s in wanted]
        share = len(wanted.intersection(own)) / len(wanted)
        return (share, at + hits[0], at + hits[-1]) if share >= CONTAINMENT else None


def _scan(library: Library):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                some = batch.slice(k, 256)
                texts = [normal_words(t) if t else [] for t in some.column(1).cast(pa.binary()).to_pylist()]
                hashes = [shingle_hashes(t) for t in texts]
                sizes = np.fromiter(map(len, hashes), np.int64, len(hashes))
                if not sizes.sum():
                    continue
                found: dict[tuple[int, str], list[tuple[int, int, float]]] = {}
                for doc, at, name in library.candidates(np.concatenate(hashes), np.cumsum(sizes) - sizes, sizes):
                    hit = library.verify(texts[doc], at, name)
                    if hit:
                        found.setdefault((doc, name), []).append((hit[1], hit[2] + SHINGLE_WORDS, hit[0]))
                told = [(doc, name, *_merged(spans)) for (doc, name), spans in sorted(found.items())]
                if told:
                    ids = some.column(0).take(pa.array([t[0] for t in told]))
                    columns = [ids, *[pa.array([t[i] for t in told]) for i in range(1, 5)]]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "license", "places", "first_word", "containment"])

    return rows


def _merged(spans: list[tuple[int, int, float]]) -> tuple[int, int, float]:
    """Number of places once overlapping spans are one, where the first begins, and the best containment."""
    places, end = 0, -1
    for start, stop, _ in sorted(spans):
        if start >= end:
            places += 1
        end = max(end, stop)
    return places, min(s[0] for s in spans), max(s[2] for s in spans)


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, license, places, first_word, containment)`` for each document and template found in it.

    A template is found where a window of the text holds at least ``CONTAINMENT`` of its distinct
    shingles of five words. ``first_word`` counts words from 0; words are runs of letters, digits and
    non-ASCII bytes, without case. Whole texts are scanned where they are read; nothing is shuffled.
    Null, blank and very short texts hold nothing; repeated rows are reported again; no rows give none.
    """
    narrow = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"))
    return narrow.mapInArrow(
        _scan(Library(templates)), "id bigint, license string, places bigint, first_word bigint, containment double"
    )
