"""License notices in texts: MinHash bands over overlapping windows, then exact containment of shingles.

A template of ``L`` words belongs to the smallest window size ``w = 8, 16, 32 ...`` with ``L <= w / 2 + 1``; windows of
``w`` words start every ``w / 2`` words, so each occurrence lies whole in some window. The shingles (five words, or the
whole template if shorter) of an exact occurrence make up at least ``(L - 4) / (w - 4)`` of the window's, a known
similarity; the number of one-row bands is chosen so that such a window and its template share a band with a chance
of at least ``recall``. Windows that share a band are candidates; a template is reported where the share of its
shingles that stand, as words, in the candidate window reaches ``containment``.

Everything happens inside the tasks that read the texts; templates are a parameter of bounded size.

Defined results: a NULL or empty text has no notice; a NULL id stays NULL; repeated rows are scanned each; an empty
table or no template gives no rows; templates without a word are ignored; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteloom.llm.common import chunks, mixed, small_batches

SHINGLE = 5
WORD = re.compile(r"\w+")

# Public notices by their short names.
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
}


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def shingles_of(words: list[str], size: int) -> set[tuple[str, ...]]:
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def shingle_hashes(words: list[str], size: int) -> np.ndarray:
    """Hash of the shingle that starts at each word (but the last ``size - 1``)."""
    if len(words) < size:
        return np.zeros(0, dtype=np.uint64)
    each = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    n = len(words) - size + 1
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + each[k : k + n])
    return out


def window_size(n_words: int) -> int:
    size = 8
    while n_words > size // 2 + 1:
        size *= 2
    return size


class Templates:
    """Templates by (window size, shingle size), with the bands that find them."""

    def __init__(self, notices: dict[str, list[str]], recall: float):
        self.members: list[tuple[str, int, set, int, int]] = []  # name, number, shingles, shingle size, window
        lengths: dict[tuple[int, int], int] = {}
        for name, texts in sorted(notices.items()):
            for number, text in enumerate(texts):
                words = words_of(text)
                if words:
                    size, window = min(SHINGLE, len(words)), window_size(len(words))
                    self.members.append((name, number, shingles_of(words, size), size, window))
                    lengths[size, window] = min(lengths.get((size, window), len(words)), len(words))
        # By shingle size: hash of a shingle that is its template's minimum in some band, with (template, band).
        self.minima: dict[int, dict[int, list[tuple[int, np.uint64]]]] = {}
        for t, (_, _, shingles, size, window) in enumerate(self.members):
            similar = (lengths[size, window] - size + 1) / (window - size + 1)
            bands = math.ceil(math.log(1 - recall) / math.log(1 - similar)) if similar < 1 else 1
            hashes = np.array([shingle_hashes(list(x), size)[0] for x in sorted(shingles)], dtype=np.uint64)
            for band in band_seeds(bands):
                lowest = int(hashes[mixed(hashes * band).argmin()])
                self.minima.setdefault(size, {}).setdefault(lowest, []).append((t, band))


def band_seeds(bands: int) -> np.ndarray:
    """An odd factor for each band; a shingle's hash in the band is the scrambled product."""
    return mixed(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)


def find_notices(words: list[str], counts: np.ndarray, templates: Templates, containment: float) -> list[tuple]:
    """(text, first word of the window, name, number, containment) over the words of several texts.

    ``counts`` gives the words of each text; windows stay inside a text. A window and a template share a band if the
    template's minimum in it stands in the window and is the window's minimum too. So positions of such minima are
    looked up first, and minima of windows are taken only around them.
    """
    found = []
    text_ends = np.cumsum(counts)
    for size, minima in templates.minima.items():
        values = shingle_hashes(words, size)
        if not len(values):
            continue
        keys = np.array(sorted(minima), dtype=np.uint64)
        places = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
        hits = np.flatnonzero(keys[places] == values)
        of_text = np.searchsorted(text_ends, hits, side="right")
        candidates: set[tuple[int, int, int]] = set()
        for at, doc in zip(hits.tolist(), of_text.tolist()):
            begin, end = int(text_ends[doc] - counts[doc]), int(text_ends[doc]) - size + 1
            if at >= end:  # the shingle reaches into the next text
                continue
            for t, band in minima[int(values[at])]:
                window = templates.members[t][4]
                half, width = window // 2, window - size + 1
                lowest = mixed(values[at : at + 1] * band)[0]
                for k in range(max(0, (at - begin - width) // half + 1), (at - begin) // half + 1):
                    start = begin + k * half
                    if (doc, start, t) not in candidates and mixed(values[start : min(start + width, end)] * band).min() == lowest:
                        candidates.add((doc, start, t))
        for doc, start, t in sorted(candidates):
            name, number, shingles, _, window = templates.members[t]
            here = shingles_of(words[start : min(start + window, int(text_ends[doc]))], size)
            share = len(shingles & here) / len(shingles)
            if share >= containment:
                found.append((doc, start - int(text_ends[doc] - counts[doc]), name, number, share))
    return found


def scan_licenses(
    df: DataFrame,
    notices: dict[str, list[str]] | None = None,
    containment: float = 0.8,
    recall: float = 0.999,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, license, notice, containment, first_word, n_windows)``: one row per text and notice found in it.

    ``notice`` numbers the license's templates from 0; ``containment`` is the largest share of its shingles in one
    window, ``first_word`` the place of the first such window, in words from 0.
    """
    templates = Templates(NOTICES if notices is None else notices, recall)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            at: list[int] = []
            rows: list[tuple] = []
            for a, b in chunks(texts):
                split = [words_of(t) for t in texts[a:b]]
                counts = np.array([len(s) for s in split])
                words = [w for s in split for w in s]
                best: dict[tuple, tuple] = {}
                for doc, place, name, number, share in find_notices(words, counts, templates, containment):
                    share_before, first, n = best.get((doc, name, number), (0.0, place, 0))
                    best[doc, name, number] = (max(share, share_before), min(place, first), n + 1)
                for (doc, name, number), (share, place, n) in sorted(best.items()):
                    at.append(a + doc)
                    rows.append((name, number, share, place, n))
            columns = [ids.take(pa.array(at, pa.int64()))]
            kinds = (pa.string(), pa.int32(), pa.float64(), pa.int64(), pa.int64())
            columns += [pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)]
            names = ["id", "license", "notice", "containment", "first_word", "n_windows"]
            yield pa.RecordBatch.from_arrays(columns, names)

    small_batches(df)
    id_type = df.schema[id_col].dataType.simpleString()
    rows = df.where(F.length(text_col) > 0).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {id_type}, license string, notice int, containment double, first_word long, n_windows long"
    return rows.mapInArrow(run, schema)
