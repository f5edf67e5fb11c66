"""License scans: templates retrieved by min-hash bands over text windows, verified by exact containment.

Templates are grouped by length. For a group, every text is covered by overlapping windows of
one width, at least twice the longest template of the group, a quarter of the width apart, so
that every passage of up to three quarters of a window is inside one. A window that contains the
wanted share of a template's shingles has at least a known similarity s with it; the number of
bands of one row is the least for which a window of that similarity collides with the template
with ``CERTAINTY``. Windows that collide in any band are verified: the share of the template's
distinct shingles that the window has must be ``CONTAINMENT`` or more, counted exactly.

Verified windows of a template that overlap are one match. Null and empty texts have no match.
The operator's columns replace columns of the same names; all others are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm import arrays

WIDTH = 2
CONTAINMENT = 0.8
CERTAINTY = 0.9999
BLOCK_BYTES = 2_000_000
#: Bytes of templates that a table may hold.
TEMPLATE_BYTES = 16_000_000

#: License notices by name, in words that projects publish them with.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
    " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by"
    " the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT": "Released under the MIT License.",
    "MIT grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    ' (the "Software"), to deal in the Software without restriction',
}


@dataclass(frozen=True)
class Group:
    """Templates scanned with windows of one width; shingle hashes of each, and the smallest of every band."""

    width: int
    names: list[str]
    shingles: list[np.ndarray]
    bands: np.ndarray
    least: np.ndarray


def _words(texts: list[str]) -> arrays.Words:
    return arrays.Words(arrays.Texts(pa.array(texts, pa.string())), arrays.ALPHANUMERIC, fold=True)


def groups(templates: dict[str, str]) -> list[Group]:
    """Templates by the power of two above their number of words; those of fewer words than a shingle are left out."""
    by_width: dict[int, list[tuple[str, np.ndarray]]] = {}
    for name, text in templates.items():
        found = _words([text])
        if len(found.hash) >= WIDTH:
            width = 2 << (len(found.hash) - 1).bit_length()
            by_width.setdefault(width, []).append((name, np.unique(arrays.window_hashes(found.hash, WIDTH))))
    out = []
    for width, named in sorted(by_width.items()):
        fewest = min(len(s) for _, s in named)
        # the window has at most width - 1 shingles, and at least the wanted share of the template's
        similarity = CONTAINMENT * fewest / (width - WIDTH + 1 + (1 - CONTAINMENT) * fewest)
        bands = math.ceil(math.log(1 - CERTAINTY) / math.log(1 - min(similarity, 0.99)))
        salts = np.random.default_rng(width).integers(1, 1 << 63, bands, dtype=np.uint64)
        least = np.array([[(_banded(s, salt)).min() for _, s in named] for salt in salts], np.uint32)
        out.append(Group(width, [n for n, _ in named], [s for _, s in named], salts, least))
    return out


def _banded(shingles: np.ndarray, salt: np.uint64) -> np.ndarray:
    x = (shingles ^ salt) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(32)).astype(np.uint32)


def windows(counts: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end (in words of the batch) of the windows over all texts: a quarter apart, the last one whole."""
    step = width // 4
    many = np.where(counts > 0, np.maximum(-(-(counts - width) // step), 0) + 1, 0)
    text = np.repeat(np.arange(len(counts)), many)
    at = (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)) * step
    begin = first[text] + np.minimum(at, np.maximum(counts[text] - width, 0))
    return begin, np.minimum(begin + width, first[text] + counts[text])


def scan(words: arrays.Words, group: Group, retrieve: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Template number, and begin, end and containment of its verified windows. Without ``retrieve`` every window is verified."""
    begin, end = windows(words.counts, words.first[:-1], group.width)
    last = end - WIDTH + 1  # the shingles of a window begin before this
    usable = last > begin
    begin, end, last = begin[usable], end[usable], last[usable]
    if not len(begin):
        return
    shingles = arrays.window_hashes(words.hash, WIDTH)
    if retrieve:
        collides = np.zeros((len(group.names), len(begin)), bool)
        # the smallest value of a window, from the smallest ones of two runs of half a window that cover it
        size = 1 << int(group.width - WIDTH + 1).bit_length() - 1
        for salt, least in zip(group.bands, group.least, strict=True):
            value = _banded(shingles, salt)
            short = np.flatnonzero(last - begin < size)
            run, span = value, 1
            while span < size and len(run) > span:
                run = np.minimum(run[:-span], run[span:])
                span *= 2
            smallest = np.empty(len(begin), np.uint32)
            full = np.flatnonzero(last - begin >= size)
            smallest[full] = np.minimum(run[begin[full]], run[last[full] - size]) if len(full) else 0
            if len(short):
                bounds = np.stack([begin[short], last[short]], 1).ravel()
                padded = np.append(value, np.uint32(0xFFFFFFFF))
                smallest[short] = np.minimum.reduceat(padded, bounds)[::2]
            for k in range(len(group.names)):
                collides[k] |= smallest == least[k]
    for k, wanted in enumerate(group.shingles):
        rows = np.flatnonzero(collides[k]) if retrieve else np.arange(len(begin))
        lengths = last[rows] - begin[rows]
        place = np.arange(lengths.sum()) + np.repeat(begin[rows] - np.cumsum(lengths) + lengths, lengths)
        at = np.minimum(np.searchsorted(wanted, shingles[place]), len(wanted) - 1)
        hit = np.flatnonzero(wanted[at] == shingles[place])
        pairs = np.sort(np.repeat(np.arange(len(rows)), lengths)[hit] * len(wanted) + at[hit])
        distinct = pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])] if len(pairs) else pairs
        share = np.bincount(distinct // len(wanted), minlength=len(rows)) / len(wanted)
        sure = share >= CONTAINMENT
        yield k, begin[rows][sure], end[rows][sure], share[sure]


MATCHES = "array<struct<license:string,word:int,length:int,containment:double>>"


def _compute(found: list[Group], retrieve: bool):
    def compute(column: pa.Array) -> list[pa.Array]:
        words = arrays.Words(arrays.Texts(column), arrays.ALPHANUMERIC, fold=True)
        rows: list[tuple[int, int, str, int, float]] = []
        for group in found:
            for k, begin, end, share in scan(words, group, retrieve):
                text = words.text[begin] if len(begin) else begin
                fresh = np.ones(len(begin), bool)
                fresh[1:] = (text[1:] != text[:-1]) | (begin[1:] > end[:-1])
                for low, high in zip(np.flatnonzero(fresh).tolist(), [*np.flatnonzero(fresh)[1:].tolist(), len(begin)], strict=False):
                    owner = int(text[low])
                    rows.append((owner, int(begin[low] - words.first[owner]), group.names[k], int(end[high - 1] - begin[low]), float(share[low:high].max())))
        rows.sort()
        bounds = pa.array(np.searchsorted([r[0] for r in rows], np.arange(len(column) + 1)), pa.int32())
        fields = [pa.array([r[i] for r in rows], t) for i, t in ((2, pa.string()), (1, pa.int32()), (3, pa.int32()), (4, pa.float64()))]
        return [pa.ListArray.from_arrays(bounds, pa.StructArray.from_arrays(fields, ["license", "word", "length", "containment"]))]

    return compute


def templates_of(table: DataFrame, most_bytes: int = TEMPLATE_BYTES) -> dict[str, str]:
    """Templates from a table with ``name`` and ``text``, such as whole license texts; the first text of a name counts.

    Every task has all templates, so a table of more than ``most_bytes`` is refused rather than sent.
    """
    named = table.filter(F.col("name").isNotNull() & F.col("text").isNotNull()).groupBy("name").agg(F.min("text").alias("text"))
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > most_bytes:
        raise ValueError(f"templates of {size} bytes; {most_bytes} may be sent to all tasks")
    return {r["name"]: r["text"] for r in named.collect()}


def match(documents: DataFrame, templates: dict[str, str] | None = None, keep: tuple[str, ...] | None = None, retrieve: bool = True) -> DataFrame:
    """The columns of ``documents`` (or those in ``keep``) and ``matches``, by place and name, in one pass without a shuffle.

    ``word`` and ``length`` bound the windows that a match was found in, in words of the text.
    """
    found = groups(TEMPLATES if templates is None else templates)
    return arrays.with_columns(documents, _compute(found, retrieve), {"matches": MATCHES}, keep=keep, limit=BLOCK_BYTES)
