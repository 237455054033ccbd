"""License statements in documents, by winnowed fingerprints of templates and banded alignment.

Every template has fingerprints: of each window of grams (one to three tokens) the
least by a fixed order, in which grams of common words come last. Documents are
winnowed the same way, and what an inverted index of the templates' fingerprints holds
gives candidates with the offset at which they would stand; where enough tokens of the
template are near, a banded alignment finds which of them are there.

Gram and window follow from the template. A statement has ``needed`` of its tokens, in
at most ``changed + 1`` runs if ``changed`` places differ, so one run has ``needed /
(changed + 1)`` tokens or more: gram and window together are no longer than that, and
of a window both sides hold, both pick the same gram. So no statement with up to
``changed`` (a quarter of the template's tokens) changed places is passed over.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import blocks, grams, joined, span_hashes, tokens
from ledgerloom.llm.license_texts import BODIES, BSD_TERMS, MIT_GRANT, NOTICES
from ledgerloom.llm.tiling import folded

FEWEST_TOKENS = 5
COVERAGE = 0.8
# A statement with so many changed places per token of its template shares a fingerprint with it.
CHANGED = 0.25
LONGEST_GRAM = 3
# Grams of these words alone come last in a window; only the speed hangs on them.
COMMON = sorted(b"a and any as at be but by files for from in is it may not of on or other person such that the this to under use with without work you".split())
LAST = np.uint64(1 << 63)

# Statements as their licenses word them.
TEMPLATES: dict[str, str] = {
    "MIT-line": "Released under the MIT License.",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MIT-grant": MIT_GRANT,
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at"
    ),
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "BSD-terms": BSD_TERMS,
    **NOTICES,
    **BODIES,
}


@dataclass
class Postings:
    """Fingerprints of grams of one length in order of value, and the narrowest window they were picked with."""

    window: int
    keys: np.ndarray
    template: np.ndarray
    place: np.ndarray


@dataclass
class Index:
    """Tokens of every template, how many a statement needs, and the fingerprints by length of gram."""

    names: list[str]
    hashes: list[np.ndarray]
    needed: list[int]
    postings: dict[int, Postings]


def _common() -> np.ndarray:
    data, starts = joined(list(COMMON))
    return np.sort(span_hashes(data, starts[:-1], starts[1:] - 1))


def ordered_grams(hashes: np.ndarray, k: int, common: np.ndarray) -> np.ndarray:
    """Hashes of all windows of ``k`` tokens, those of common words alone after all others."""
    values = grams(hashes, k) & ~LAST
    if len(values):
        plain = np.isin(hashes, common)
        values[np.lib.stride_tricks.sliding_window_view(plain, k).all(axis=1)] |= LAST
    return values


def winnowed(values: np.ndarray, window: int) -> np.ndarray:
    """Places of the least value of every window, the last one among equals."""
    if len(values) <= window:
        return np.array([len(values) - 1 - int(np.argmin(values[::-1]))] if len(values) else [], np.int64)
    if window == 1:
        return np.arange(len(values))
    backwards = np.lib.stride_tricks.sliding_window_view(values, window)[:, ::-1]
    return np.unique(np.arange(len(backwards)) + window - 1 - np.argmin(backwards, axis=1))


def gram_and_window(size: int, needed: int, changed: float = CHANGED) -> tuple[int, int]:
    """Lengths whose windows lie within the longest run that a statement with so many changed places has left."""
    run = math.ceil(needed / (int(changed * size) + 1))
    k = min(LONGEST_GRAM, run // 2 + 1)
    return k, run - k + 1


def index_templates(templates: dict[str, str], coverage: float = COVERAGE) -> Index:
    hashes, needed, short = [], [], []
    picked: dict[int, list[tuple[int, int, np.ndarray, np.ndarray]]] = {}
    common = _common()
    for number, (name, text) in enumerate(templates.items()):
        found = tokens(joined([text.lower().encode()])[0])[2]
        if len(found) < FEWEST_TOKENS:
            short.append(name)
            continue
        hashes.append(found)
        needed.append(max(1, math.ceil(coverage * len(found) - 1e-9)))
        k, window = gram_and_window(len(found), needed[-1])
        values = ordered_grams(found, k, common)
        places = winnowed(values, window)
        picked.setdefault(k, []).append((number, window, values[places], places))
    if short:
        raise ValueError(f"templates of fewer than {FEWEST_TOKENS} tokens: {', '.join(short)}")
    postings = {}
    for k, found in picked.items():
        keys = np.concatenate([values for _, _, values, _ in found])
        order = np.argsort(keys, kind="stable")
        template = np.repeat([number for number, _, _, _ in found], [len(values) for _, _, values, _ in found])
        place = np.concatenate([places for _, _, _, places in found])
        postings[k] = Postings(min(window for _, window, _, _ in found), keys[order], template[order], place[order])
    return Index(list(templates), hashes, needed, postings)


def shared_fingerprints(doc: np.ndarray, index: Index) -> Iterator[tuple[Postings, np.ndarray, np.ndarray, np.ndarray]]:
    """Places of the document's fingerprints that the index holds, and where their postings begin and end.

    A fingerprint picked in a wide window is also picked in a narrower one, so
    one window per length of gram serves all templates.
    """
    common = _common()
    for k, postings in index.postings.items():
        values = ordered_grams(doc, k, common)
        places = winnowed(values, postings.window)
        low, high = (np.searchsorted(postings.keys, values[places], side) for side in ("left", "right"))
        held = high > low
        yield postings, places[held], low[held], high[held]


def align(template: np.ndarray | list, doc: np.ndarray | list, offset: int, band: int) -> list[tuple[int, int]]:
    """Pairs (template token, document token) of the best alignment near a diagonal.

    Most equal tokens count first, then the fewest gaps between them. Cells off
    the band around ``offset`` (document place less template place) are not
    visited; a row of the band is one step of vectors.
    """
    template, doc = np.asarray(template), np.asarray(doc)
    m, n, width = len(template), len(doc), 2 * band + 1
    best, before = np.zeros(width + 1, np.int64), np.zeros(width, np.int64)
    left, steps = np.zeros(width, np.int64), np.empty((m, width), np.int8)
    for i in range(m):
        # Place j of the document stands at j - start of the band; a pair counts 2^32, two pairs in a row 1 more.
        start = i + offset - band
        low, high = min(max(0, -start), width), max(0, min(width, n - start))
        equal = np.zeros(width, np.int64)
        if high > low:
            equal[low:high] = doc[start + low : start + high] == template[i]
        match = np.where(equal > 0, best[:-1] + (1 << 32) + before, -1)
        row = np.maximum.accumulate(np.maximum(best[1:], match))
        left[1:] = row[:-1]
        steps[i] = np.where(match >= np.maximum(best[1:], left), 3, np.where(best[1:] >= left, 1, 2))
        best[:-1], before = row, equal
    d, i, pairs = int(np.argmax(best[:-1])), m - 1, []
    while i >= 0 and 0 <= d < width:
        step = steps[i, d]
        if step == 3:
            pairs.append((i, i + offset + d - band))
            i -= 1
        elif step == 2 and d > 0:
            d -= 1
        else:
            i, d = i - 1, d + 1
    return pairs[::-1]


def offsets_of(diagonals: np.ndarray, doc: np.ndarray, wanted: np.ndarray, needed: int, band: int) -> np.ndarray:
    """Offsets whose band holds a shared fingerprint and has enough tokens of the template near."""
    inside = np.zeros(len(doc) + 1, np.int64)
    np.cumsum(np.isin(doc, wanted), out=inside[1:])
    found = [np.zeros(0, np.int64)]
    for at in range(-band, band + 1):
        offsets = diagonals + at
        low, high = np.clip(offsets - band, 0, len(doc)), np.clip(offsets + len(wanted) + band, 0, len(doc))
        found.append(offsets[inside[high] - inside[low] >= needed])
    return np.unique(np.concatenate(found))


def find(doc: np.ndarray, index: Index) -> list[tuple[int, float, list[tuple[int, int]]]]:
    """(template, covered share, runs of matched document tokens) of every statement, best first.

    Every place where an alignment within a band has the tokens a statement
    needs, in up to a quarter as many changed places, is reported, or shares a
    token with a better one of its template.
    """
    which, where = [], []
    for postings, places, low, high in shared_fingerprints(doc, index):
        counts = high - low
        entry = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        which.append(postings.template[entry])
        where.append(np.repeat(places, counts) - postings.place[entry])
    candidates, diagonals = np.concatenate(which), np.concatenate(where)
    statements = []
    for template in np.unique(candidates).tolist():
        wanted, needed = index.hashes[template], index.needed[template]
        band = max(4, len(wanted) // 5)
        own, votes = np.unique(diagonals[candidates == template], return_counts=True)
        offsets = offsets_of(own, doc, wanted, needed, band)
        if not len(offsets):
            continue
        kinds, numbers, counts = np.unique(wanted, return_inverse=True, return_counts=True)
        # Tokens by their number in the template; others, and those that belong to a statement, have one of their own.
        none = len(kinds)
        counts = np.append(counts, 0)
        free = np.minimum(np.searchsorted(kinds, doc), none - 1)
        free[kinds[free] != doc] = none

        def most(offset: int) -> int:
            near = free[max(0, offset - band) : max(0, offset + len(wanted) + band)]
            return int(np.minimum(np.bincount(near, minlength=none + 1), counts).sum())

        def aligned(offset: int) -> tuple[list[int], int]:
            begin = max(0, offset - band)
            window = free[begin : max(0, offset + len(wanted) + band + 1)]
            pairs = align(numbers, window, offset - begin, band)
            diagonal = [begin + j - i for i, j in pairs]
            return [begin + j for _, j in pairs], (min(diagonal) + max(diagonal)) // 2 if pairs else offset

        voted = dict(zip(own.tolist(), votes.tolist()))
        for _, _, offset in sorted((-most(offset), -voted.get(offset, 0), offset) for offset in offsets.tolist()):
            while most(offset) >= needed:
                places, middle = aligned(offset)
                if len(places) < needed:
                    break
                if middle != offset:
                    places = max(places, aligned(middle)[0], key=len)
                statements.append((template, len(places) / len(wanted), places))
                free[places] = none
    statements.sort(key=lambda s: (-s[1], -len(s[2]), s[2][0], s[0]))
    out = []
    for template, share, places in statements:
        breaks = [k for k in range(1, len(places)) if places[k] != places[k - 1] + 1]
        edges = [0, *breaks, len(places)]
        out.append((template, share, [(places[a], places[b - 1]) for a, b in zip(edges, edges[1:])]))
    return out


HITS = "array<struct<license: string, coverage: double, begin: int, end: int, spans: array<struct<begin: int, end: int>>>>"


def scanning(index: Index):
    span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
    hit = pa.list_(
        pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("begin", pa.int32()), ("end", pa.int32()), ("spans", span)])
    )

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, raws in blocks([folded(text) for text in batch.column("text").to_pylist()]):
                data, starts = joined(raws)
                begin, end, hashes = tokens(data)
                # Grams over the end of a text only add candidates.
                hits = np.zeros(len(hashes) + 1, np.int64)
                for _, places, _, _ in shared_fingerprints(hashes, index):
                    hits[places + 1] = 1
                np.cumsum(hits, out=hits)
                first = np.searchsorted(begin, starts)
                for row in range(len(raws)):
                    a, b = int(first[row]), int(first[row + 1])
                    if hits[b] == hits[a]:
                        found.append([])
                        continue
                    rows = []
                    for template, share, places in find(hashes[a:b], index):
                        spans = [(int(begin[a + x] - starts[row]), int(end[a + y] - starts[row])) for x, y in places]
                        rows.append(
                            {
                                "license": index.names[template],
                                "coverage": share,
                                "begin": spans[0][0],
                                "end": spans[-1][1],
                                "spans": [{"begin": x, "end": y} for x, y in spans],
                            }
                        )
                    found.append(rows)
            others = [name for name in batch.schema.names if name != "text"]
            columns = [batch.column(name) for name in others] + [pa.array(found, hit)]
            yield pa.RecordBatch.from_arrays(columns, others + ["hits"])

    return scanned


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """``doc_id`` and one statement per row: ``license, coverage, begin, end, spans``.

    ``coverage`` is the share of the template's tokens the alignment matched;
    spans are bytes of the text, one per run of matched tokens. Every place of a
    statement is reported that differs in up to a quarter as many places as its
    template has tokens, and others that share a fingerprint; places of the same
    template do not overlap. Null and empty texts have none, repeated rows and null ids give
    theirs each, other columns are ignored. Templates are a parameter of the
    job; documents are not shuffled.
    """
    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    index = index_templates(templates, coverage)
    found = docs.select("doc_id", "text").mapInArrow(scanning(index), f"doc_id {kind}, hits {HITS}")
    return found.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")
