"""Benchmark decontamination by a prefix-filtered set join.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased.
An item's windows are its runs of WINDOW consecutive words (all its words, if
fewer).  A window is contained in a document only if all its shingles of
SHINGLE words are, so with shingles ordered by rarity one prefix token, the
rarest, is necessary: windows are joined to documents on it alone.  Rarity is
counted over all documents; a window with a shingle that no document has is
dropped at once.  A match of the prefix token fixes where the window would lie;
length and positional bounds come from that, and the words are then compared.

Items are cut into pieces of PIECE windows and read in blocks of about BLOCK_BYTES
of text; each block goes over all documents and its hits are merged into those
of the blocks before.  The driver and every Python worker hold one block, packed
into arrays of some ten bytes a byte of text (building it takes a few times that
on the driver, whatever the size of the benchmark or of an item).

Null or wordless texts have no words and no hits; null or wordless items match
nothing.  Items are told apart by item_id (rows that repeat an id add windows
to it; a null id is listed as an empty string).  Document rows are judged one
by one, so repeated rows get equal results.  Empty tables give empty results.
"""

from __future__ import annotations

from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_type, slices, small_batches, written

WINDOW = 10
SHINGLE = 5
BLOCK_BYTES = 8 << 20
PIECE = 1 << 16
MEMO_SIZE = 100_000
SEEN_SIZE = 10_000
_TABLE = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else
               c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                     0xD6E8FEB86659FD93, 0xA0761D6478BD642F], "u8")
_FILTER_BITS = 20
SPANS = "array<struct<start:long,end:long>>"



def _split(text: str | None) -> list[bytes]:
    return text.encode().translate(_TABLE).split() if text else []


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_SIZE:
            self.clear()
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


def _shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of ``k`` words."""
    n = max(0, len(h) - k + 1)
    out = np.zeros(n, "u8")
    for j in range(k):
        out += (h[j:j + n] ^ (h[j:j + n] >> np.uint64(29))) * _FACTORS[j]
    return out


def _hashed(words: list[bytes], memo: _Hashes) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), "u8", len(words))


class Lookup:
    """Finds given hashes: a bitmap of their top bits first, then binary search."""

    def __init__(self, hashes, bits: int = _FILTER_BITS):
        self.sorted = np.unique(hashes if isinstance(hashes, np.ndarray) else np.array(list(hashes), "u8"))
        self.shift = np.uint64(64 - bits)
        self.bitmap = np.zeros(1 << bits, bool)
        self.bitmap[self.sorted >> self.shift] = True

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in values, indices of the hashes found there)"""
        if not len(self.sorted):
            return np.empty(0, "i8"), np.empty(0, "i8")
        at = np.flatnonzero(self.bitmap[values >> self.shift])
        place = np.minimum(np.searchsorted(self.sorted, values[at]), len(self.sorted) - 1)
        ok = self.sorted[place] == values[at]
        return at[ok], place[ok]


def pieces(items: DataFrame) -> DataFrame:
    """(i, t) with the words of each text, one blank between them, cut into pieces
    that overlap so that every window lies whole in one; repeated ones once."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                ids, texts = [], []
                for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words = _split(t)
                    for a in range(0, max(1, len(words) - WINDOW + 1) if words else 0, PIECE):
                        ids.append(i or "")
                        texts.append(b" ".join(words[a:a + PIECE + WINDOW - 1]).decode())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.string())], ["i", "t"])

    small_batches(items.sparkSession)
    return items.mapInArrow(run, "i string, t string").distinct()


class Block:
    """The distinct windows of some pieces, packed.

    ``buffer`` holds all words, word ``w`` from ``offsets[w]``; window ``x`` is
    the ``size[x]`` words from ``start[x]`` and belongs to the items
    ``owners[first[x]:first[x + 1]]``.
    """

    def __init__(self, rows):
        vocabulary, numbers, ends, self.ids, texts = {}, array("i"), [0], [], []
        for item_id, text in rows:
            words = text.encode().split(b" ")
            numbers.extend([vocabulary.setdefault(w, len(vocabulary)) for w in words])
            ends.append(len(numbers))
            self.ids.append(item_id)
            texts.append(text.encode())
        self.buffer = b" ".join(texts)
        self.lookups, self._grams = {}, {}
        if not self.ids:
            return
        memo = _Hashes()
        hashes = np.fromiter((memo[w] for w in vocabulary), "u8", len(vocabulary))
        lengths = np.fromiter(map(len, vocabulary), "i8", len(vocabulary))
        del vocabulary, texts
        numbers, ends = np.array(numbers, "i4"), np.array(ends)
        self.offsets = np.concatenate([[0], np.cumsum(lengths[numbers] + 1)])
        hashes = hashes[numbers]
        words = np.diff(ends)
        n = np.maximum(1, words - WINDOW + 1)
        item = np.repeat(np.arange(len(n), dtype="i4"), n)
        start = (ends[:-1] - np.cumsum(n) + n)[item] + np.arange(len(item))
        size = np.minimum(words[item], WINDOW)
        rows = np.full((len(item), WINDOW), -1, "i4")
        for j in range(WINDOW):
            inside = j < size
            rows[inside, j] = numbers[start[inside] + j]
        # equal rows of word numbers are equal windows
        _, kept, which = np.unique(rows.view(f"V{4 * WINDOW}").ravel(), return_index=True, return_inverse=True)
        del rows
        self.start, self.size = start[kept], size[kept].astype("i1")
        self.owners = item[np.argsort(which, kind="stable")]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(kept)))])
        # the shingles that begin at each word, by length: short windows have one
        self._grams = {k: _shingles(hashes, k) for k in range(1, SHINGLE + 1)
                       if (self.size == k).any() or k == SHINGLE and (self.size > k).any()}
        for k, grams in self._grams.items():
            own = self.start[self.size >= k if k == SHINGLE else self.size == k]
            if k == SHINGLE:
                in_text = np.arange(len(grams))
                in_text = in_text[in_text + k <= ends[np.searchsorted(ends, in_text, side="right")]]
                self.lookups[k] = Lookup(grams[in_text])
            else:
                self.lookups[k] = Lookup(grams[own])

    def choose(self, counts: dict[int, np.ndarray]) -> None:
        """Windows that may occur, by their rarest shingle: for each length
        ``prefix[k]`` has a lookup, where the windows of each hash begin, the
        windows and the shingle's place in them."""
        self.prefix = {}
        for k, lookup in self.lookups.items():
            grams = self._grams[k]
            own = np.flatnonzero(self.size >= k if k == SHINGLE else self.size == k)
            least = np.full(len(own), np.iinfo("i8").max)
            gram, place = np.zeros(len(own), "u8"), np.zeros(len(own), "i1")
            for j in range(WINDOW - k + 1 if k == SHINGLE else 1):
                at = np.flatnonzero(self.size[own] >= j + k)
                g = grams[self.start[own[at]] + j]
                c = counts[k][np.searchsorted(lookup.sorted, g)]
                better = (c < least[at]) | (c == least[at]) & (g < gram[at])
                at, g, c = at[better], g[better], c[better]
                least[at], gram[at], place[at] = c, g, j
            order = np.flatnonzero(least > 0)
            order = order[np.argsort(gram[order], kind="stable")]
            found = Lookup(gram[order])
            begin = np.concatenate([np.searchsorted(gram[order], found.sorted), [len(order)]])
            self.prefix[k] = found, begin, own[order], place[order]
        del self._grams, self.lookups

    def window(self, x: int) -> tuple[list[bytes], list[str]]:
        """The words of window ``x`` and its items."""
        a = int(self.start[x])
        words = self.buffer[self.offsets[a]:self.offsets[a + int(self.size[x])] - 1].split(b" ")
        return words, [self.ids[o] for o in self.owners[self.first[x]:self.first[x + 1]].tolist()]


def _words_by_slice(batches, memo, column):
    """For each slice: (slice, words of all its texts, first word of each text)."""
    for batch in batches:
        for part in slices(batch, column):
            words, starts = [], [0]
            for t in part.column(column).to_pylist():
                words += _split(t)
                starts.append(len(words))
            yield part, words, np.array(starts), _hashed(words, memo)


def _inside(starts: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The text of each position, and whether ``k`` words from there stay in it."""
    doc = np.searchsorted(starts, at, side="right") - 1
    return doc, at + k <= starts[doc + 1]


def rarity(docs: DataFrame, lookups: dict[int, Lookup], text: str = "text") -> dict[int, np.ndarray]:
    """For each shingle length the occurrences over all documents of each hash of
    its lookup.  Tasks count first; the driver gets arrays of one entry a shingle."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(lookups)

    def run(batches):
        memo, found = _Hashes(), {k: np.zeros(len(x.sorted), "i8") for k, x in shared.value.items()}
        for _, _, starts, h in _words_by_slice(batches, memo, 0):
            for k, lookup in shared.value.items():
                at, which = lookup.find(_shingles(h, k))
                found[k] += np.bincount(which[_inside(starts, at, k)[1]], minlength=len(lookup.sorted))
        for k, n in found.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), k, "i4")), pa.array(at), pa.array(n[at])], ["k", "i", "n"])

    rows = (docs.select(F.col(text).alias("t")).mapInArrow(run, "k int, i long, n long")
            .groupBy("k", "i").agg(F.sum("n").alias("n")).toArrow())
    k, i, n = (rows.column(c).to_numpy() for c in range(3))
    out = {}
    for length, lookup in lookups.items():
        out[length] = np.zeros(len(lookup.sorted), "i8")
        out[length][i[k == length]] = n[k == length]
    shared.unpersist()
    return out


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _scan(docs: DataFrame, block: Block, text: str) -> DataFrame:
    """Adds one block's hits to the columns n_words, hit_spans and items."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(block)
    at_text = docs.columns.index(text)
    before = len(docs.columns) - 3
    kinds = [arrow_type(t) for t in ("long", SPANS, "array<string>")]
    names = docs.columns

    def run(batches):
        block = shared.value
        memo, seen = _Hashes(), {}
        for part, words, starts, h in _words_by_slice(batches, memo, at_text):
            spans, items = defaultdict(list), defaultdict(set)
            for k, (lookup, begin, windows, places) in block.prefix.items():
                at, which = lookup.find(_shingles(h, k))
                doc, ok = _inside(starts, at, k)
                for p, s, d in zip(at[ok].tolist(), which[ok].tolist(), doc[ok].tolist()):
                    first, last = int(starts[d]), int(starts[d + 1])
                    for x in range(int(begin[s]), int(begin[s + 1])):
                        w = int(windows[x])
                        a = p - int(places[x])
                        b = a + int(block.size[w])
                        if a < first or b > last:
                            continue
                        if w not in seen:
                            if len(seen) >= SEEN_SIZE:
                                seen.clear()
                            seen[w] = block.window(w)
                        window, ids = seen[w]
                        if words[a:b] == window:
                            spans[d].append((a - first, b - first))
                            items[d].update(ids)
            old_spans, old_items = part.column(before + 1).to_pylist(), part.column(before + 2).to_pylist()
            out_spans, out_items = [], []
            for d, (s, i) in enumerate(zip(old_spans, old_items)):
                out_spans.append([{"start": a, "end": b} for a, b in
                                  _merge(spans[d] + [(x["start"], x["end"]) for x in s])]
                                 if d in spans else s)
                out_items.append(sorted(items[d] | set(i)) if d in items else i)
            yield pa.RecordBatch.from_arrays(
                part.columns[:before] + [pa.array(np.diff(starts), kinds[0]),
                                         pa.array(out_spans, kinds[1]), pa.array(out_items, kinds[2])], names)

    return docs.mapInArrow(run, docs.schema)


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
         item_text: str = "text") -> DataFrame:
    """``docs`` plus n_words, hit_spans (maximal runs of hit words, end
    exclusive) and items (ids with an occurring window, sorted as strings)."""
    added = T.StructType.fromDDL(f"n_words long, hit_spans {SPANS}, items array<string>")
    taken = {f.name for f in added}
    kept = [c for c in docs.columns if c.lower() not in taken]
    out = docs.select(*[F.col(f"`{c}`") for c in kept], *[
        F.lit(0).cast("long").alias("n_words"), F.array().cast(SPANS).alias("hit_spans"),
        F.array().cast("array<string>").alias("items")])
    items = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t"))
    items = written(pieces(items), "benchmark")
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    for b in range(blocks):
        block = Block(items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).toLocalIterator())
        block.choose(rarity(docs, block.lookups, text) if block.lookups else {})
        out = _scan(out, block, text)
    return out
