"""License scan: MinHash bands over overlapping windows, then exact containment.

Templates are short license notices (a bounded parameter, broadcast with the
code). Words are runs of letters and digits, lower-cased; a shingle is ``SHINGLE``
words. For each template length class (a power of two of words) a text is
covered by windows of twice that length, half overlapping, so any occurrence
lies whole in some window. ``BANDS`` bands of one MinHash row retrieve the
templates of a window: an occurrence with at least ``THRESHOLD`` of a template's
shingles gives a Jaccard similarity of 0.8 / 4 = 0.2 or more with such a window,
so a window misses it with probability 0.8 ** 64 < 1e-6.

A retrieved pair is verified by exact containment: the share of the template's
distinct shingles in the window must reach ``THRESHOLD``. A window without any
template shingle can't share a minimum with a template, so such texts skip the
MinHash step. Texts are scanned where they are read: nothing is shuffled.

Defined results: null and empty texts have no license; rows that repeat an id are
scanned each; a null id stays null; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, map_arrow, mix64, python_strings, text_or_empty
from .jaccard_join import _P, WordHashes

SHINGLE = 3
BANDS = 64
THRESHOLD = 0.8

# Opening notices of public licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MIT": "Released under the MIT License",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "Unlicense": "This is free and unencumbered software released into the public domain",
}

_WORD = re.compile(r"[^\W_]+")
_words = WordHashes()


def shingles(text: str) -> np.ndarray:
    """Hash of the shingle at each word (fewer words than a shingle: none)."""
    words = _WORD.findall(text.lower())
    if len(words) < SHINGLE:
        return np.zeros(0, np.uint64)
    h = np.fromiter((_words[w.encode("utf-8", "surrogatepass")] for w in words), np.uint64, len(words))
    n = len(h) - SHINGLE + 1
    s = np.full(n, SHINGLE, np.uint64)
    for i in range(SHINGLE):
        s = s * _P + h[i : n + i]
    return mix64(s)


def band_keys(shingle: np.ndarray) -> np.ndarray:
    """One row of hashes per band."""
    seeds = mix64(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x94D049BB133111EB))
    return mix64((shingle[None, :] ^ seeds[:, None]).ravel()).reshape(BANDS, -1)


class Scanner:
    """Retrieval tables of the templates."""

    def __init__(self, templates: dict[str, str]) -> None:
        self.names = sorted(templates)
        self.sets = {n: np.unique(shingles(templates[n])) for n in self.names}
        short = [n for n in self.names if not len(self.sets[n])]
        if short:
            raise ValueError(f"templates of fewer than {SHINGLE} words: {short}")
        self.every = np.unique(np.concatenate(list(self.sets.values()))) if templates else np.zeros(0, np.uint64)
        self.classes: dict[int, dict[tuple[int, int], list[str]]] = {}
        for n in self.names:
            length = len(shingles(templates[n]))
            low = band_keys(self.sets[n]).min(axis=1)
            table = self.classes.setdefault(1 << max(length - 1, 1).bit_length(), {})
            for band, key in enumerate(low.tolist()):
                table.setdefault((band, key), []).append(n)

    def scan(self, text: str) -> dict[str, tuple[float, int, int, int]]:
        """License: (best containment, windows that reach it, first and last shingle of the best window)."""
        s = shingles(text)
        marked = np.flatnonzero(np.isin(s, self.every))
        found: dict[str, tuple[float, int, int, int]] = {}
        if not len(marked):
            return found
        for half, table in self.classes.items():
            for w in np.unique(np.concatenate([marked // half, marked // half - 1])).tolist():
                start = max(w, 0) * half
                window = np.unique(s[start : start + 2 * half])
                low = band_keys(window).min(axis=1).tolist()
                near = {n for key in enumerate(low) for n in table.get(key, ())}
                for n in sorted(near):
                    share = len(np.intersect1d(self.sets[n], window, assume_unique=True)) / len(self.sets[n])
                    if share >= THRESHOLD:
                        old = found.get(n, (0.0, 0, 0, 0))
                        place = (start, min(start + 2 * half, len(s)) - 1)
                        best = (share, *place) if share > old[0] else (old[0], *old[2:])
                        found[n] = (best[0], old[1] + 1, *best[1:])
        return found


def _scan(templates: dict[str, str]):
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        kind = pa.list_(pa.struct([("license", pa.string()), ("containment", pa.float64()), ("windows", pa.int64()), ("first", pa.int64()), ("last", pa.int64())]))
        for batch in batches:
            rows = [
                [{"license": n, "containment": c, "windows": w, "first": a, "last": z} for n, (c, w, a, z) in sorted(scanner.scan(t).items())]
                for t in python_strings(batch.column("text"))
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], ["doc_id", "matches"])

    return scan


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id and its matches (license, containment, windows, first and last shingle), every row."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(F.col(f"`{text_col}`")).alias("text"))
    kind = "doc_id long, matches array<struct<license string, containment double, windows long, first long, last long>>"
    return map_arrow(rows, _scan(TEMPLATES if templates is None else templates), kind)


def op6_license_scan(spark, sf_dir: str) -> DataFrame:
    """One row per document: its number of licenses, their names, the best containment."""
    found = scan_licenses(documents(spark, sf_dir))
    best = F.array_max(F.transform("matches", lambda m: m["containment"]))
    return found.select(
        "doc_id", F.size("matches").cast("long").alias("n_licenses"),
        F.array_join(F.transform("matches", lambda m: m["license"]), ",").alias("licenses"),
        F.coalesce(best, F.lit(0.0)).alias("containment"),
    )
