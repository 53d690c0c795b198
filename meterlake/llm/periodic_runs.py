"""Periodic run detection: stretches of words that repeat with a small period.

A run is a stretch of consecutive words with smallest period q and at least
max(MIN_LENGTH, MIN_EXPONENT * q) words that no neighbouring word extends
keeping period q.  The words of a text are maximal matches of
``[^\\x20\\x09-\\x0D]+``, numbered from 0.

Method (branching tandem test on an enhanced suffix array): the texts of a
slice are laid behind one another, each closed by a sign of its own, so that
nothing repeats across texts.  Ranks by prefix doubling give the suffix array
SA, its inverse ISA and, by binary descent over the ranks of all lengths 2^k,
the LCP of neighbours.  One pass with a stack tells for each LCP value d the
suffixes left and right of it that share d words (an LCP interval with many
children counts as a chain of two-sided ones, no tree is built).  Of the smaller
side every suffix i is tested: if ISA[i + d] or ISA[i - d] lies on the other
side, a square of period d starts there that cannot move right.  Each square is
rotated left as far as the words agree; squares of one stretch merge into the
run of the least period.  The smaller sides add up to at most n log n suffixes.

A text that repeats no five words holds no run (the start of a run shares
max(6 - q, 3 q) >= 5 words with what follows one period later), so such texts
skip the suffix array; the test is by hashes, whose collisions only cost time.

Memory of a task: a slice of about SLICE_BYTES of text, or one longer text: the
words and, for the suspects among the texts, eight bytes a word for each rank
length 2^k up to the longest repeat.  Rows are independent: no shuffle, and a
lost task is simply run again.

Null and empty texts have no words and no run.  Equal rows give equal results;
columns of the input that clash with the added ones are replaced by them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_column

MIN_LENGTH = 6
MIN_EXPONENT = 4
SLICE_BYTES = 2 << 20
# Suffixes tested at a time.
TEST_BLOCK = 1 << 20

FIELDS = [("n_words", "long"), ("runs", "array<struct<start:long,length:long,period:long>>"),
          ("collapsed", "string")]


def _suspects(ids: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Whether a text repeats five words: by 64-bit hashes of the five and the text."""
    out = np.zeros(n_docs, bool)
    if len(ids) < 6:
        return out
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    here = doc[:-4] == doc[4:]
    h = np.zeros(len(ids) - 4, np.uint64)
    for k in range(5):
        h = h * np.uint64(0xBF58476D1CE4E5B9) + mixed[k:k + len(h)]
    h = (h + doc[:-4].astype(np.uint64) * np.uint64(0x94D049BB133111EB))[here]
    if not len(h):
        return out
    in_order = np.sort(h)
    again = np.unique(in_order[1:][in_order[1:] == in_order[:-1]])
    if len(again):
        at = np.searchsorted(again, h)
        out[doc[:-4][here][again[np.minimum(at, len(again) - 1)] == h]] = True
    return out


def _ranks(signs: np.ndarray) -> list[np.ndarray]:
    """Rank of the 2^k signs from each place, for k = 0, 1, ... until all differ."""
    n = len(signs)
    levels = [np.unique(signs, return_inverse=True)[1].astype(np.int64)]
    while levels[-1].max() < n - 1:
        last, step = levels[-1], 1 << (len(levels) - 1)
        later = np.zeros(n, np.int64)
        later[:n - step] = last[step:] + 1
        levels.append(np.unique(last * (n + 1) + later, return_inverse=True)[1].astype(np.int64))
    return levels


def _ahead(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many signs from a and from b agree."""
    agree = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        agree += (levels[k][a + agree] == levels[k][b + agree]).astype(np.int64) << k
    return agree


def _behind(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many signs before a and before b agree (a < b)."""
    agree = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x = a - agree - (1 << k)
        same = (x >= 0) & (levels[k][np.maximum(x, 0)] == levels[k][np.maximum(b - agree - (1 << k), 0)])
        agree += same.astype(np.int64) << k
    return agree


def _sides(lcp: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For each place j of the LCP array the first suffix of its left side and the
    last of its right side: [left, j) and [j, right] share lcp[j] signs."""
    left, right = [0] * len(lcp), [len(lcp) - 1] * len(lcp)
    stack: list[int] = []
    for j, depth in enumerate(lcp):
        while stack and lcp[stack[-1]] > depth:
            right[stack.pop()] = j - 1
        if depth:
            left[j] = stack[-1]
        stack.append(j)
    return np.array(left, np.int64), np.array(right, np.int64)


def _squares(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of the squares that cannot move right, any exponent."""
    isa = levels[-1]
    n = len(isa)
    sa = np.empty(n, np.int64)
    sa[isa] = np.arange(n)
    lcp = np.zeros(n, np.int64)
    lcp[1:] = _ahead(levels, sa[:-1], sa[1:])
    left, right = _sides(lcp.tolist())
    at = np.flatnonzero(lcp)
    depth, low, high = lcp[at], left[at], right[at]
    by_left = at - low <= high - at + 1                  # the smaller side
    first = np.where(by_left, low, at)
    count = np.where(by_left, at - low, high - at + 1)
    other_low, other_high = np.where(by_left, at, low), np.where(by_left, high, at - 1)
    starts, periods = [], []
    ends = np.cumsum(count)
    i = 0
    while i < len(at):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + TEST_BLOCK, "right")))
        node = np.repeat(np.arange(i, j), count[i:j])
        done = ends[i - 1] if i else 0
        x = sa[first[node] + np.arange(len(node)) - (ends[node] - count[node] - done)]
        d = depth[node]
        for y, start in ((x + d, x), (x - d, x - d)):
            there = (y >= 0) & (y < n)
            rank = isa[np.where(there, y, 0)]
            hit = there & (rank >= other_low[node]) & (rank <= other_high[node])
            starts.append(start[hit])
            periods.append(d[hit])
        i = j
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(starts), np.concatenate(periods)


def runs_of(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of each text's runs, by start, then period; a text
    is an array of word numbers."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    if not sizes.sum():
        return out
    ids = np.concatenate(texts).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    chosen = np.flatnonzero(_suspects(ids, doc, len(texts)))
    if not len(chosen):
        return out
    # signs: a word of its text, or the text's closing sign
    width = int(ids.max()) + 2
    signs = np.concatenate([np.append(texts[t], width - 1).astype(np.int64) + c * width
                            for c, t in enumerate(chosen)])
    offsets = np.concatenate([[0], np.cumsum(sizes[chosen] + 1)])
    levels = _ranks(signs)
    start, period = _squares(levels)
    back = _behind(levels, start, start + period)
    start, length = start - back, 2 * period + back
    long = length >= np.maximum(MIN_LENGTH, MIN_EXPONENT * period)
    start, length, period = start[long], length[long], period[long]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    owner = np.searchsorted(offsets, start, "right") - 1
    for k in order.tolist():
        out[chosen[owner[k]]].append((int(start[k] - offsets[owner[k]]), int(length[k]), int(period[k])))
    return out


def _analyse(texts: list) -> list[list]:
    vocabulary: dict[bytes, int] = {}
    number = vocabulary.setdefault
    words = [(t or "").encode().split() for t in texts]
    runs = runs_of([np.array([number(w, len(vocabulary)) for w in ws], np.int64) for ws in words])
    collapsed = []
    for ws, found in zip(words, runs):
        if found:
            dropped = np.zeros(len(ws) + 1, np.int64)
            for start, length, period in found:
                dropped[start + period] += 1
                dropped[start + length] -= 1
            gone = np.cumsum(dropped).tolist()
            ws = [w for w, g in zip(ws, gone) if not g]
        collapsed.append(b" ".join(ws).decode())
    return [[len(ws) for ws in words],
            [[{"start": s, "length": n, "period": q} for s, n, q in found] for found in runs],
            collapsed]


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus n_words, ``runs`` (start, length, period in words, by start,
    then period) and ``collapsed``: the words of the text, one space between,
    without those that a run holds after its first period."""
    return map_column(docs, text, lambda: _analyse, FIELDS, SLICE_BYTES)


def strongest(runs: str | Column = "runs") -> Column:
    """The run of the greatest length / period, compared exactly; the smallest
    start, then period, of equal ones; null without runs."""
    column = F.col(runs) if isinstance(runs, str) else runs
    return F.aggregate(column, F.get(column, F.lit(0)), lambda best, x: F.when(
        x["length"] * best["period"] > best["length"] * x["period"], x).otherwise(best))


def tail_repeated(text: Column, key: Column) -> Column:
    """Texts with a periodic tail, to have runs at every size: with
    h = crc32(decimal key) and g = floor(h / 10), if h % 10 = 0 each word i >= a
    becomes word a + (i - a) % p, a = g % n, p = 1 + floor((n - a) / (3 + g % 8))."""
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))

    def repeated(ws: Column) -> Column:
        n = F.size(ws).cast("long")
        a = g % n
        p = F.floor((n - a) / (g % 8 + 3)) + 1
        at = F.transform(F.sequence(F.lit(0).cast("long"), n - 1),
                         lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.array_join(F.transform(at, lambda i: F.get(ws, i.cast("int"))), " ")

    has_words = text.rlike(r"[^\x20\x09-\x0D]")
    # as a lambda's variable the words are found once, not once a word
    return F.when((h % 10 == 0) & has_words, F.get(F.transform(F.array(words), repeated), F.lit(0))).otherwise(text)
