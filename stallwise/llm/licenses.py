"""License notices in texts: MinHash bands over overlapping windows retrieve templates, shingle containment verifies.

Templates are cut into five-word shingles. Those of similar size form a class, and a text is covered by windows of
WIDTH times the class's size at half that distance, so that some window holds the whole of any notice of the class. A
notice with containment 0.8 in such a window has a Jaccard similarity of 0.2 or more to it; with BANDS bands of one
row, it is retrieved with a chance of at least 1 - 0.8^64 = 0.9999994. Windows that hold no shingle of any template can
collide with none and are skipped.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.llm import words

SHINGLE = 5
CONTAINED = 0.8
BANDS = 64
WIDTH = 2
GROWTH = 2
# Bytes of templates that a worker holds at most; all public licence texts together are a tenth of that.
MOST_BYTES = 64_000_000
SPLIT = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(128)) + bytes(range(128, 256))
FOUND = "array<struct<license:string,containment:double,first_word:int,last_word:int>>"

# Notices of public licences.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
    ],
    "gpl-3.0": ["This work is licensed under the GNU General Public License, version 3.", "under the terms of the GNU General Public License, version 3"],
    "gpl-2.0": ["This work is licensed under the GNU General Public License, version 2.", "under the terms of the GNU General Public License, version 2"],
    "lgpl-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "agpl-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ],
    "cc-by-4.0": ["Licensed under CC BY 4.0.", "licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0.", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0.", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc0-1.0": ["This work is dedicated to the public domain under CC0 1.0."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
}


def shingled(text: bytes) -> np.ndarray:
    """Five-word shingles in order; punctuation parts words; a text of fewer words has none."""
    found = words.hashes(text.lower().translate(SPLIT).split())
    return words.shingles(found, SHINGLE) if len(found) >= SHINGLE else np.zeros(0, np.uint64)


class Templates:
    def __init__(self, templates: dict[str, list[str]], seed: int = 3) -> None:
        self.names, self.sets = [], []
        for name, notices in templates.items():
            for notice in notices:
                own = np.unique(shingled(notice.encode()))
                if len(own):
                    self.names.append(name)
                    self.sets.append(own)
        self.every = np.unique(np.concatenate([*self.sets, np.zeros(0, np.uint64)]))
        self.keys = np.random.default_rng(seed).integers(1, 2**63, BANDS, dtype=np.uint64) | np.uint64(1)
        # Per class: (largest size, {(band, minimum): templates}).
        self.classes: list[tuple[int, dict[tuple[int, int], list[int]]]] = []
        done, bound = 0, 1
        while done < len(self.sets):
            own = [i for i, s in enumerate(self.sets) if bound // GROWTH < len(s) <= bound]
            if own:
                table: dict[tuple[int, int], list[int]] = defaultdict(list)
                for i in own:
                    for band, low in enumerate(self.signature(self.sets[i])):
                        table[band, int(low)].append(i)
                self.classes.append((bound, dict(table)))
            done, bound = done + len(own), bound * GROWTH

    def signature(self, values: np.ndarray) -> np.ndarray:
        mixed = (values[:, None] ^ (values[:, None] >> words.HALF)) * self.keys[None, :]
        return (mixed ^ (mixed >> words.HALF)).min(axis=0)

    def find(self, text: np.ndarray) -> list[dict]:
        """The licences of one text: the stretch of largest containment for each, the first among equals."""
        inside = np.isin(text, self.every)
        hits = np.flatnonzero(inside)
        best: dict[str, tuple[float, int, int]] = {}
        if not len(hits):
            return []
        for size, table in self.classes:
            width, stride = WIDTH * size, max(1, size // 2)
            # Windows at multiples of the stride that hold a hit.
            starts = np.unique(np.concatenate([hits // stride - back for back in range(-(-width // stride))]))
            for at in starts[starts >= 0] * stride:
                window = text[at : at + width]
                for i in {i for band, low in enumerate(self.signature(window)) for i in table.get((band, int(low)), ())}:
                    own = np.flatnonzero(np.isin(window, self.sets[i]))
                    share = len(np.unique(window[own])) / len(self.sets[i])
                    if share >= CONTAINED:
                        now = (-share, int(at + own[0]), int(at + own[-1] + SHINGLE))
                        best[self.names[i]] = min(best.get(self.names[i], now), now)
        # Of notices over the same words, the better contained one is meant.
        kept = [(s, a, b, n) for n, (s, a, b) in best.items() if not any(t < s and a < d and c < b for t, c, d in best.values())]
        return [{"license": n, "containment": -s, "first_word": a, "last_word": b} for s, a, b, n in sorted(kept, key=lambda x: x[3])]


def templates_of(table: DataFrame) -> dict[str, list[str]]:
    """Templates out of a table (license, notice); rows with a NULL are left out.

    Every worker holds all templates, so the table is measured first and refused above MOST_BYTES.
    """
    rows = table.where("license is not null and notice is not null").select("license", "notice").distinct()
    size = rows.agg(F.sum(F.octet_length("notice"))).first()[0] or 0
    if size > MOST_BYTES:
        raise ValueError(f"templates hold {size} bytes, more than {MOST_BYTES}")
    found: dict[str, list[str]] = defaultdict(list)
    for row in rows.orderBy("license", "notice").collect():
        found[row.license].append(row.notice)
    return dict(found)


def with_licenses(
    docs: DataFrame, templates: dict[str, list[str]] | DataFrame = TEMPLATES, text: str = "text", out: str = "licenses"
) -> DataFrame:
    """Add `out`: licences whose notice the text contains to CONTAINED or more, with the word range (end excluded).

    `templates` are notices by licence, or a table (license, notice) of them, which may hold whole licence texts. NULL,
    empty and very short texts have none (an empty array); repeated rows stay; a column called `out` is replaced; an
    empty table gives no rows.
    """
    known = Templates(templates_of(templates) if isinstance(templates, DataFrame) else templates)

    @F.pandas_udf(FOUND)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([known.find(shingled((value or "").encode("utf-8", "replace"))) for value in batch], dtype=object)

    return docs.withColumn(out, run(F.col(f"`{text}`")))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
