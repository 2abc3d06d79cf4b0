"""License scans by conditional compression.

A candidate block is a run of words around a hint word of a licence. It is
compressed alone and with every template as a zstandard raw-content
dictionary: the template that shrinks it most explains it best. Every template
that saves ``LEAST_REDUCTION`` is then confirmed word by word: the block must hold one of the
template's notices with every one of its key words unchanged and in order and
at most ``TOLERANCE`` of its other words changed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

LEVEL, CONTEXT, LEAST_REDUCTION, TOLERANCE = 9, 60, 0.03, 0.15
# Stems that mark candidate blocks.
HINTS = ("licen", "copyright", "spdx", "redistribut", "permission is", "warrant", "public domain", "cc by", "cc0", "gpl")
# Identifier, notices of the licence, and the words a notice may not change.


def _gnu(family: str, short: str, version: str, *more: str) -> tuple[str, ...]:
    """The headers, headings and short forms of a GNU licence."""
    full = f"GNU {family} License"
    dotted = version if "." in version else f"{version}.0"
    return (f"{full} version {version}", f"{full} v{version}", f"{full} v{dotted}", f"{full} version {dotted}",
            f"GNU {short} version {version}", f"{short} version {version}", f"{short} v{version}", f"{short}v{version}", *more,
            f"{full} as published by the Free Software Foundation, either version {version}",
            f"under the terms of the {full} version {version} as published by the Free Software Foundation")


def _gnu_keys(family: str, short: str, version: str) -> tuple[str, ...]:
    short, dotted = short.lower(), version if "." in version else f"{version}.0"
    return ("gnu", *family.lower().split(), "version", version, dotted, f"v{version}", f"v{dotted}", short, f"{short}v{version}")


def _cc(short: str, full: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
    return ((f"Licensed under CC {short} 4.0", f"CC {short} 4.0", f"Creative Commons {full} 4.0 International License",
             f"Creative Commons {full} 4.0 International"),
            (short.lower(), full.lower(), "4.0", "cc"))


TEMPLATES = (
    ("AGPL-3.0", _gnu("Affero General Public", "AGPL", "3"), _gnu_keys("Affero General Public", "AGPL", "3")),
    ("Apache-2.0", ("Licensed under the Apache License, Version 2.0",
                    "you may not use this file except in compliance with the License",
                    "distributed under the Apache License 2.0", "Apache License, Version 2.0", "Apache License 2.0",
                    "Apache License v2.0"),
     ("apache", "2.0", "v2.0", "compliance")),
    ("BSD-2-Clause", ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                      "following disclaimer in the documentation and/or other materials provided with the distribution. "
                      "THIS SOFTWARE IS PROVIDED BY",
                      "Licensed under the BSD 2-Clause License", "BSD 2-Clause License", "Simplified BSD License"),
     ("bsd", "2-clause", "simplified", "redistributions", "distribution", "software", "provided")),
    ("BSD-3-Clause", ("Redistribution and use in source and binary forms, with or without modification, are permitted",
                      "may be used to endorse or promote products derived from this software without specific prior written permission",
                      "Licensed under the BSD 3-Clause License", "Released under the BSD 3-Clause License",
                      "BSD 3-Clause License"),
     ("bsd", "3-clause", "redistribution", "binary", "endorse", "promote")),
    ("BSL-1.0", ("Distributed under the Boost Software License, Version 1.0", "Boost Software License Version 1.0"),
     ("boost", "1.0")),
    ("CC-BY-4.0", *_cc("BY", "Attribution")),
    ("CC-BY-NC-4.0", *_cc("BY-NC", "Attribution-NonCommercial")),
    ("CC-BY-NC-ND-4.0", *_cc("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")),
    ("CC-BY-NC-SA-4.0", *_cc("BY-NC-SA", "Attribution-NonCommercial-ShareAlike")),
    ("CC-BY-ND-4.0", *_cc("BY-ND", "Attribution-NoDerivatives")),
    ("CC-BY-SA-4.0", *_cc("BY-SA", "Attribution-ShareAlike")),
    ("CC0-1.0", ("dedicated to the public domain under CC0 1.0", "CC0 1.0", "CC0 1.0 Universal",
                 "waived all copyright and related or neighboring rights to this work"),
     ("cc0", "1.0", "waived", "neighboring")),
    ("EPL-1.0", ("made available under the terms of the Eclipse Public License v1.0", "Eclipse Public License v1.0",
                 "Eclipse Public License v 1.0", "Eclipse Public License 1.0", "Eclipse Public License Version 1.0"),
     ("eclipse", "1.0", "v1.0")),
    ("EPL-2.0", ("made available under the terms of the Eclipse Public License 2.0", "Eclipse Public License 2.0",
                 "Eclipse Public License v 2.0", "Eclipse Public License v2.0", "Eclipse Public License Version 2.0"),
     ("eclipse", "2.0", "v2.0")),
    ("GPL-2.0", _gnu("General Public", "GPL", "2", "This work is licensed under the GNU General Public License, version 2",
                     "under the terms of the GNU General Public License version 2"), _gnu_keys("General Public", "GPL", "2")),
    ("GPL-3.0", _gnu("General Public", "GPL", "3", "This work is licensed under the GNU General Public License, version 3",
                     "under the terms of the GNU General Public License version 3"), _gnu_keys("General Public", "GPL", "3")),
    ("ISC", ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted, provided that the above copyright notice and this permission notice appear in all copies", "ISC License"),
     ("isc", "purpose", "fee", "granted", "provided", "appear", "copies")),
    ("LGPL-2.1", _gnu("Lesser General Public", "LGPL", "2.1"), _gnu_keys("Lesser General Public", "LGPL", "2.1")),
    ("LGPL-3.0", _gnu("Lesser General Public", "LGPL", "3", "This work is licensed under the GNU Lesser General Public License, version 3"),
     _gnu_keys("Lesser General Public", "LGPL", "3")),
    ("MIT", ("Released under the MIT License", "Licensed under the MIT License", "MIT License",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
     ("mit", "permission", "granted", "free", "charge")),
    ("MPL-2.0", ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
                 "Mozilla Public License Version 2.0", "Mozilla Public License 2.0", "Mozilla Public License v2.0"),
     ("mozilla", "2.0", "v2.0")),
    ("Unlicense", ("This is free and unencumbered software released into the public domain", "Released under the Unlicense"),
     ("unencumbered", "public", "domain", "unlicense")),
)
# Words that, inside a notice of the licence, make it one of another.
OTHERS = {"GPL-2.0": {"lesser", "library", "affero"}, "GPL-3.0": {"lesser", "library", "affero"}}
SPDX = {i: name for name, _, _ in TEMPLATES for i in (name.lower(), f"{name.lower()}-only", f"{name.lower()}-or-later")}

_WORD = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")


def words(text: str) -> list[str]:
    """Lower-case words; points and hyphens inside a word stay."""
    return _WORD.findall(text.lower())


def blocks_of(text: str) -> list[str]:
    """Runs of words within CONTEXT words of a hint, overlapping runs joined."""
    low = text.lower()
    if not any(h in low for h in HINTS):
        return []
    spans = [m.span() for m in _WORD.finditer(low)]
    starts = [s for s, _ in spans]
    marks = []
    for h in HINTS:
        at = low.find(h)
        while at >= 0:
            marks.append(max(0, bisect_right(starts, at) - 1))
            at = low.find(h, at + 1)
    runs: list[list[int]] = []
    for m in sorted(set(marks)):
        lo, hi = max(0, m - CONTEXT), min(len(spans), m + CONTEXT + 1)
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = hi
        elif spans:
            runs.append([lo, hi])
    return [" ".join(low[s:e] for s, e in spans[lo:hi]) for lo, hi in runs]


class Scanner:
    """Compressors for all templates; one per worker."""

    def __init__(self, templates=TEMPLATES):
        self.templates = [(name, [words(n) for n in notices], set(keys)) for name, notices, keys in templates]
        self.plain = zstd.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)
        self.with_template = []
        for _, notices, _ in self.templates:
            raw = zstd.ZstdCompressionDict(" ".join(" ".join(n) for n in notices).encode(),
                                           dict_type=zstd.DICT_TYPE_RAWCONTENT)
            self.with_template.append(zstd.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False,
                                                          write_checksum=False))

    def reductions(self, piece: str) -> list[float]:
        """Share of the compressed size that each template saves."""
        raw = piece.encode()
        alone = len(self.plain.compress(raw))
        return [1 - len(c.compress(raw)) / alone for c in self.with_template]

    def confirm(self, block: list[str], t: int) -> tuple[int, int] | None:
        """(words of the nearest notice that are changed, words of it) if that is allowed, else None."""
        name, notices, keys = self.templates[t]
        best, held = None, set(block)
        for notice in notices:
            if not held.issuperset(keys.intersection(notice)):
                continue
            for window in windows_of(block, notice, keys):
                d = notice_difference(notice, window, keys, OTHERS.get(name, set()))
                if d is not None and d <= TOLERANCE * len(notice) and (best is None or d < best[0]):
                    best = (d, len(notice))
        return best

    def scan(self, text: str) -> list[dict]:
        """One row for each block and confirmed template, and for each block without one."""
        out = []
        for n, block in enumerate(blocks_of(text)):
            w, found = block.split(), []
            gains = [self.reductions(" ".join(p)) for p in pieces_around(w)]
            most = [max(g) for g in zip(*gains)]
            ids = spdx_names(w)
            for t, (name, _, _) in enumerate(self.templates):
                d = self.confirm(w, t) if most[t] >= LEAST_REDUCTION else None
                if d is None and name in ids:
                    d = (0, 2)
                if d is not None:
                    found.append({"block": n, "license": name, "reduction": most[t], "changed": d[0], "notice_words": d[1]})
            if "endorse" not in w and any(f["license"] == "BSD-2-Clause" for f in found):   # both begin alike
                found = [f for f in found if f["license"] != "BSD-3-Clause" or "3-clause" in w or f["license"] in ids]
            out += found or [{"block": n, "license": None, "reduction": max(most, default=0.0),
                              "changed": None, "notice_words": None}]
        return out


def spdx_names(block: list[str]) -> set[str]:
    """Licences of the SPDX expressions in a block."""
    out = set()
    for at, w in enumerate(block):
        if w == "spdx-license-identifier":
            i = at + 1
            while i < len(block):
                out.add(SPDX.get(block[i]))
                i += 1
                if block[i:i + 1] == ["with"]:            # an exception's name
                    i += 2
                if block[i:i + 1] not in (["and"], ["or"]):
                    break
                i += 1
    return out - {None}


def windows_of(block: list[str], notice: list[str], keys: set[str]) -> Iterator[list[str]]:
    """The block's windows that hold enough of the notice's words, and all its key words, to be it; each begins
    with a word of the notice."""
    allowed = int(TOLERANCE * len(notice))
    size, need = len(notice) + max(4, allowed), Counter(notice)
    have: Counter[str] = Counter()
    shared, end = 0, 0
    for at, w in enumerate(block):
        while end < min(len(block), at + size):
            have[block[end]] += 1
            shared += have[block[end]] <= need[block[end]]
            end += 1
        if w in need and shared >= len(notice) - allowed and all(have[k] >= need[k] for k in keys if k in need):
            yield block[at:at + size]
        shared -= have[w] <= need[w]
        have[w] -= 1


def pieces_around(block: list[str], size: int = 8) -> list[list[str]]:
    """The windows of a block that hold a hint, ``size`` words to either side."""
    joined_hints = [h.split()[0] for h in HINTS]
    marks = [i for i, w in enumerate(block) if any(h in w for h in joined_hints)]
    return [block[max(0, i - size):i + size + 1] for i in marks] or [block]


def notice_difference(notice: list[str], window: list[str], keys: set[str], others: frozenset[str] | set[str] = frozenset()) -> int | None:
    """Words of ``notice`` that ``window`` lacks or changes, plus words it puts between them; None
    if a key word is among the lacking ones or one of ``others`` stands between."""
    m = SequenceMatcher(None, notice, window, autojunk=False)
    same = [x for x in m.get_matching_blocks() if x.size]
    if not same:
        return None
    kept = {i for x in same for i in range(x.a, x.a + x.size)}
    if any(w in keys and i not in kept for i, w in enumerate(notice)):
        return None
    first, last = same[0].b, same[-1].b + same[-1].size
    if others.intersection(window[first:last]):
        return None
    return len(notice) - len(kept) + last - first - len(kept)


_SCANNER: list[Scanner] = []


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if not _SCANNER:
        _SCANNER.append(Scanner())
    row = pa.struct([("block", pa.int32()), ("license", pa.string()), ("reduction", pa.float64()),
                     ("changed", pa.int32()), ("notice_words", pa.int32())])
    for batch in batches:
        found = [_SCANNER[0].scan(t or "") for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(row))], ["doc_id", "found"])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, found: array of (block, license, reduction, changed, notice_words).

    ``license`` is null for a block that no template explains word by word.
    Null and empty texts have no blocks; of equal reductions the template that
    is listed first leads; null ids and repeated rows are rows like others; an
    empty table gives no rows; extra columns are ignored. No shuffle."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _scan, "doc_id long, found array<struct<block:int,license:string,reduction:double,changed:int,notice_words:int>>")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document: blocks with a hint, confirmed licences, best size reduction."""
    found = scan_licenses(read(spark, sf_dir, "documents"))
    names = F.array_sort(F.array_distinct(F.filter(F.transform("found", lambda x: x["license"]), lambda n: n.isNotNull())))
    return found.select(
        "doc_id", F.size(F.array_distinct(F.transform("found", lambda x: x["block"]))).cast("long").alias("n_blocks"),
        F.size(names).cast("long").alias("n_licenses"), F.array_join(names, ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["reduction"])), F.lit(0.0)).alias("best_reduction"))
