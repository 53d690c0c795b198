"""License scan: MinHash bands over overlapping windows retrieve templates,
exact shingle containment verifies them.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased, shingles have five
words.  Templates are grouped by size: those of 2**j up to 2**(j+1) - 1
shingles (repeated ones counted) are looked for in windows of 2**(j+2) shingles that begin every
2**(j+1), so any stretch as long as the template lies whole in some window.
A template contained to CONTAINMENT in a stretch has a similarity of at least
CONTAINMENT / 4.25 to its window; bands of one row are used, and their number is
such that the chance to miss is at most MISS (more bands for a template that
repeats so many shingles that fewer than 2**j differ).  Every retrieved (window, template)
is verified on the shingles themselves.

All places of a template are returned.  In a window that holds enough of a
template, its shingles in order form chains along which the place in the template
rises; each chain with CONTAINMENT of the shingles is a place.  Of overlapping
places the one of the highest containment stays, the first of equals.  Where no
chain has enough (parts in another order), the window's first to last shingle of
the template is one place, unless a chain overlaps it.

Templates are a parameter, held by the driver and every task; their text is
checked against TEMPLATE_BYTES.  Null or wordless texts match nothing; a
template of fewer than five words is one shingle, found only as a whole text.
Repeated rows get equal results; an empty table gives an empty table.

With ``bare`` words, as the registered query uses them, punctuation around a
word is stripped on both sides and words of nothing else are skipped (comment
signs, bullets), and a template of fewer than five words is found wherever its
words follow each other.  Places still count all words of the text.
"""

from __future__ import annotations

import math
import string
from bisect import bisect_left
from collections import defaultdict
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from .common import map_column
from .decontaminate import Lookup

WORDS = 5
CONTAINMENT = 0.75
MISS = 1e-4
TEMPLATE_BYTES = 16 << 20
MEMO_SIZE = 400_000

def _odd(seed: int, n: int) -> np.ndarray:
    return (np.random.default_rng(seed).integers(1 << 62, size=n).astype("u8") << np.uint64(1)) | np.uint64(1)


_STEPS = _odd(7001, WORDS)


def bands_for(distinct: int, size: int) -> int:
    """Bands for a template of ``distinct`` different shingles in windows of
    ``4 * size``: at least CONTAINMENT of them are there, so the similarity is at
    least that of a window whose other shingles all differ."""
    share = min(1.0, distinct / size)
    return math.ceil(math.log(MISS) / math.log(1 - CONTAINMENT * share / (4 + share / 4)))

# Short public license notices, by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
}
# More notices, written by hand: other wordings, the Creative Commons licenses,
# reserved rights and the SPDX line of each identifier.  Up to seven words have
# at most three shingles, which must all be there, so a version is told apart.
_IDENTIFIERS = ("MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "CC0-1.0", "Unlicense",
                *(f"{g}-{v}" for g in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")
                  for v in ("only", "or-later")),
                *(f"CC-{c}-4.0" for c in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")))
NOTICES = TEMPLATES | {
    "All-rights-reserved": "All rights reserved.",
    "MIT/licensed": "Licensed under the MIT License.",
    "Public-domain": "released into the public domain",
    "Public-domain/dedicated": "dedicated to the public domain",
    "BSD/style": "governed by a BSD-style license",
} | {f"{g}/notice": f"GNU {n}General Public License, version {v}" for g, n, v in (
    ("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"),
    ("AGPL-3.0", "Affero ", "3"))
} | {f"CC-{c}-4.0": f"Licensed under CC {c} 4.0." for c in ("BY", "BY-SA", "BY-ND", "BY-NC-SA", "BY-NC-ND")
} | {f"CC-{c}-4.0/international": f"licensed under a Creative Commons {n} 4.0 International License" for c, n in (
    ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
} | {f"{i}/spdx": f"SPDX-License-Identifier: {i}" for i in _IDENTIFIERS}
_OUTER = string.punctuation + "\u2018\u2019\u201c\u201d\u00ab\u00bb\u2013\u2014\u2022\u00a9\u2026"


def public_licenses() -> dict[str, str]:
    """NOTICES and the whole texts (``<id>/text``) and standard headers
    (``<id>/header``; those of GPL and LGPL fit any version) in the folder
    ``licenses``; read by the driver."""
    out = dict(NOTICES)
    for path in sorted(Path(__file__).with_name("licenses").glob("*.txt")):
        name = path.name.removesuffix(".txt")
        header = name.endswith(".header")
        out[f"{name.removesuffix('.header')}/{'header' if header else 'text'}"] = path.read_text("utf-8")
    return out


def _stripped(word: bytes) -> bytes:
    return word.decode().strip(_OUTER).encode()


class _Hashes(dict):
    """Hashes of words; of bare words after stripping, 0 if nothing is left."""

    def __init__(self, bare: bool = False):
        self.bare = bare

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_SIZE:
            self.clear()
        own = _stripped(word) if self.bare else word
        h = xxhash.xxh3_64_intdigest(own) or 1 if own else 0
        if len(word) <= 64:
            self[word] = h
        return h


def _split(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def _grams(words: list[bytes]) -> list[tuple]:
    return [tuple(words[i:i + WORDS]) for i in range(max(1, len(words) - WORDS + 1))] if words else []


def _hash_grams(h: np.ndarray, k: int) -> np.ndarray:
    n = len(h) - k + 1
    out = np.full(n, k, "u8")
    for j in range(k):
        out = (out ^ h[j:j + n]) * _STEPS[j]
        out ^= out >> np.uint64(32)
    return out


def _lookup(hashes: list) -> Lookup:
    """With a bitmap of a few hundred bytes a template: there is one for each
    band and size, and all are broadcast."""
    return Lookup(hashes, min(20, len(hashes).bit_length() + 8))


class Index:
    """Templates by size, with a lookup of each band's values; with ``bare``
    words, those of fewer than WORDS words by their number of words."""

    def __init__(self, templates: dict[str, str], bare: bool = False):
        if sum(len(t) for t in templates.values()) > TEMPLATE_BYTES:
            raise ValueError("the templates are too large to be held by every task; scan in parts")
        self.bare = bare
        memo = _Hashes()
        self.grams, self.names = [], []     # shingle -> its places in the template
        sizes, short, mins = defaultdict(list), defaultdict(list), {}
        for name, text in sorted(templates.items()):
            words = _split(text)
            if bare:
                words = [w for w in map(_stripped, words) if w]
            if not words:
                continue
            grams = _grams(words)
            own = defaultdict(list)
            for i, g in enumerate(grams):
                own[g].append(i)
            h = np.fromiter(map(memo.__getitem__, words), "u8", len(words))
            values = np.unique(_hash_grams(h, min(WORDS, len(words))))
            if bare and len(words) < WORDS:
                short[len(words)].append((int(values[0]), len(self.names)))
            else:
                sizes[len(grams).bit_length() - 1].append(len(self.names))
                mins[len(self.names)] = values
            self.names.append(name)
            self.grams.append(dict(own))
        number = {j: max(bands_for(len(self.grams[t]), 1 << j) for t in members) for j, members in sizes.items()}
        self.factors = _odd(7002, max(number.values(), default=0))
        self.sizes = {}
        for j, members in sorted(sizes.items()):
            bands = []
            for f in self.factors[:number[j]]:
                least = {t: (mins[t] * f).min() for t in members}
                lookup = _lookup(list(least.values()))
                bands.append((lookup, [[t for t in members if least[t] == v] for v in lookup.sorted]))
            self.sizes[j] = bands
        self.short = {}
        for k, members in short.items():
            lookup = _lookup([v for v, _ in members])
            self.short[k] = lookup, [[t for v, t in members if v == x] for x in lookup.sorted.tolist()]


def _chains(window: list[tuple], grams: dict[tuple, list[int]]) -> list[tuple[float, int, int]]:
    """(containment, first, last) shingle of each chain of the template in ``window``."""
    out, chain, last = [], [], -1
    for i, g in enumerate(window):
        own = grams.get(g)
        if own is None:
            continue
        k = bisect_left(own, last + 1)
        if k == len(own):
            out.append(chain)
            chain, k = [], 0
        chain.append(i)
        last = own[k]
    return [(len({window[i] for i in c}) / len(grams), c[0], c[-1]) for c in [*out, chain] if c]


def _apart(places: list[tuple[int, float, int, int]]) -> list[tuple[int, int, float]]:
    """(start, end, containment) of places (rank, -containment, start, end) that
    overlap none before them, the lowest first."""
    kept: list[tuple[int, int, float]] = []
    for _, share, a, b in sorted(set(places)):
        k = bisect_left(kept, (a,))
        if (k == 0 or kept[k - 1][1] <= a) and (k == len(kept) or b <= kept[k][0]):
            kept.insert(k, (a, b, -share))
    return kept


def _scan(index: Index, words: list[list[bytes]], memo: _Hashes) -> list[list[dict]]:
    """For each text, the matches {license, start, end, containment}."""
    grams, starts, places = [], [0], []
    found: list[dict] = [defaultdict(list) for _ in words]

    def match(d, t, share, a, b, rank=0):
        """Template ``t`` from word ``a`` to ``b`` of the words that count."""
        if index.bare:
            a, b = int(places[d][a]), int(places[d][b - 1]) + 1
        found[d][t].append((rank, -share, a, b))

    for d, own in enumerate(words):
        h = np.fromiter(map(memo.__getitem__, own), "u8", len(own))
        if index.bare:
            places.append(np.flatnonzero(h))
            h = h[places[d]]
        if len(h):
            grams.append(_hash_grams(h, min(WORDS, len(h))))
        starts.append(starts[-1] + (len(grams[-1]) if len(h) else 0))
        for k, (lookup, owners) in index.short.items():
            if len(h) < k:
                continue
            where, which = lookup.find(_hash_grams(h, k))
            for w, o in zip(where.tolist(), which.tolist()):
                run = tuple(_stripped(own[p]) for p in places[d][w:w + k])
                for t in owners[o]:
                    if run in index.grams[t]:
                        match(d, t, 1.0, w, w + k)
    if not grams:
        return [[] for _ in words]
    values, starts = np.concatenate(grams), np.array(starts)
    lengths = np.diff(starts)
    hits = set()
    blocks, finer = {}, None
    for j in index.sizes:
        step = 2 << j
        n = -(-lengths // step)
        doc = np.repeat(np.arange(len(n)), n)
        at = starts[doc] + step * (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n))
        pair = np.flatnonzero(doc[1:] == doc[:-1])   # a block and the next one make a window
        # blocks are made of whole blocks of the size before
        blocks[j] = doc, at, pair, at if finer is None else np.searchsorted(finer, at)
        finer = at
    for b, factor in enumerate(index.factors):
        least = values * factor
        for j, bands in index.sizes.items():
            doc, at, pair, first = blocks[j]
            least = np.minimum.reduceat(least, first)
            if b >= len(bands):
                continue
            window = least.copy()
            window[pair] = np.minimum(least[pair], least[pair + 1])
            lookup, owners = bands[b]
            where, which = lookup.find(window)
            for w, o in zip(where.tolist(), which.tolist()):
                for t in owners[o]:
                    hits.add((j, w, t))
    counted = {}
    for j, w, t in hits:
        doc, at, _, _ = blocks[j]
        d = int(doc[w])
        a = int(at[w] - starts[d])
        if d not in counted:
            counted[d] = [_stripped(words[d][p]) for p in places[d]] if index.bare else words[d]
        window = _grams(counted[d][a:a + (4 << j) + WORDS - 1])
        share = len(index.grams[t].keys() & set(window)) / len(index.grams[t])
        if share < CONTAINMENT:
            continue
        end = len(counted[d])
        whole = [c for c in _chains(window, index.grams[t]) if c[0] >= CONTAINMENT]
        for part, first, last in whole:
            match(d, t, part, a + first, min(a + last + WORDS, end))
        if not whole:
            inside = [i for i, g in enumerate(window) if g in index.grams[t]]
            match(d, t, share, a + inside[0], min(a + inside[-1] + WORDS, end), 1)
    return [[{"license": index.names[t], "start": a, "end": b, "containment": share}
             for t, v in sorted(own.items()) for a, b, share in _apart(v)] for own in found]


def scan(docs: DataFrame, text: str = "text", templates: dict[str, str] = TEMPLATES,
         bare: bool = False) -> DataFrame:
    """``docs`` plus ``licenses``: for each place of each template, its name, the
    words (end exclusive) and the containment, by template and start."""
    shared = docs.sparkSession.sparkContext.broadcast(Index(templates, bare))

    def make():
        memo, index = _Hashes(bare), shared.value
        return lambda texts: [_scan(index, [_split(t) for t in texts], memo)]

    return map_column(docs, text, make, [
        ("licenses", "array<struct<license:string,start:long,end:long,containment:double>>")])
