"""Removal of repeated byte strings with a hash-compared suffix sort.

Every byte covered by a string of LENGTH bytes that also starts anywhere else
in the corpus (same document included) is removed.  Texts are UTF-8 bytes and
matches never cross documents.

1. Each window of LENGTH bytes has an anchor: its GRAM-byte string of the
   smallest hash, the leftmost of ties.  Equal windows have equal anchors at
   equal places.  Neighbouring windows with one anchor form a stretch; only
   (anchor hash, stretch hash, row, place) is shuffled, about one row per
   (LENGTH - GRAM) / 2 bytes.
2. Sorted by anchor and stretch: stretches that occur twice are repeated as a
   whole.  Where an anchor has several stretches, one of each goes on.
3. Their bytes are cut from the documents and dealt by anchor.  The suffixes
   that start at the anchor are put in order by mergesort; two suffixes are
   compared by their common extension, found by binary search over prefix
   polynomial hashes.  Neighbours' extensions split the sorted suffixes into
   classes for every window place, the hash of the bytes left of the anchor
   splits these further, and members of a class are verified byte by byte (a
   collision sends the anchor's windows to a comparison of the bytes alone).
   Anchors with more than MAX_GROUP stretches are not gathered: their windows
   are counted by hash in a distributed aggregation.
4. Stretches of one row are joined to its text and cut out.

Rows are told apart by a 64-bit hash of id and text, so rows that repeat id and
text count as copies of each other, like any equal texts.  Null texts are
empty; texts under LENGTH bytes are left alone; an empty table gives an empty
table.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_type, slices, written

LENGTH = 200
GRAM = 100
MAX_GROUP = 50_000      # stretches of an anchor that one task gathers
PIECE = 1 << 20         # bytes hashed at once
BATCH_BYTES = 8 << 20   # bytes of stretches sorted at once
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xFF51AFD7ED558CCD)
SPANS = "array<struct<start:long,end:long>>"


class Powers:
    """Powers of the base and of its inverse, modulo 2**64."""

    def __init__(self):
        self.up = self.down = np.ones(1, "u8")

    def to(self, n: int):
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, b in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                x = np.full(n, b, "u8")
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))
        return self


class PrefixHash:
    """Polynomial hashes of all substrings of ``data`` from one array of prefix hashes."""

    def __init__(self, data: np.ndarray, powers: Powers):
        n = len(data)
        powers.to(n + 1)
        self.prefix = np.zeros(n + 1, "u8")
        np.cumsum((data.astype("u8") + np.uint64(1)) * powers.up[:n], out=self.prefix[1:])
        self.down = powers.down

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.down[start]

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Lengths, up to ``most``, of the common extensions at ``a`` and ``b``."""
        low, high = np.zeros(len(a), "i8"), most.astype("i8")
        while (open_ := low < high).any():
            mid = (low + high + 1) >> 1
            same = self.of(a, mid) == self.of(b, mid)
            low = np.where(open_ & same, mid, low)
            high = np.where(open_ & ~same, mid - 1, high)
        return low


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = len(x) - width + 1
    full = np.full(-(-len(x) // width) * width, np.iinfo("u8").max, "u8")
    full[:len(x)] = x
    rows = full.reshape(-1, width)
    after = np.minimum.accumulate(rows, axis=1).ravel()
    before = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(before[:n], after[width - 1:width - 1 + n])


def stretches(data: np.ndarray, starts: np.ndarray, powers: Powers):
    """(first window, windows, anchor place, anchor hash) of the stretches of
    texts that begin at ``starts`` (with the end of the last) in ``data``."""
    n = len(data)
    if n < LENGTH:
        return (np.empty(0, "i8"),) * 3 + (np.empty(0, "u8"),)
    grams = PrefixHash(data, powers).of(np.arange(n - GRAM + 1), GRAM)
    grams = (grams ^ (grams >> np.uint64(31))) * _MIX
    grams ^= grams >> np.uint64(29)
    bits = np.uint64(PIECE.bit_length())
    place = np.arange(len(grams), dtype="u8")
    least = _window_min((grams >> bits << bits) | place, LENGTH - GRAM + 1)
    anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype("i8")
    valid = np.ones(n - LENGTH + 1, bool)
    for end in starts[1:].tolist():
        valid[max(0, end - LENGTH + 1):end] = False
    change = np.ones(len(valid) + 1, bool)
    change[1:-1] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])
    edges = np.flatnonzero(change)
    first, last = edges[:-1], edges[1:]
    ok = valid[first]
    first, last = first[ok], last[ok]
    return first, last - first, anchor[first], grams[anchor[first]]


def _pieces(keys, texts):
    """Groups of (key, offset, bytes) of at most PIECE bytes together; long texts
    are cut so that every window lies in one piece."""
    group, size = [], 0
    for key, text in zip(keys, texts):
        step = PIECE // 2
        for at in range(0, max(1, len(text) - LENGTH + 1), step):
            part = text[at:at + step + LENGTH - 1]
            if len(part) < LENGTH:
                continue
            if group and size + len(part) > PIECE:
                yield group
                group, size = [], 0
            group.append((key, at, part))
            size += len(part)
    if group:
        yield group


def anchors(rows: DataFrame) -> DataFrame:
    """(deal, anchor, stretch, rid, at, twice) of rows (rid, bytes); ``at`` packs
    the first window's offset, the number of windows and the anchor's place
    among them.

    Stretches that a task sees again in the same slice of texts are repeated
    for certain: only the first goes on by its anchor, marked ``twice``; the
    others have a null anchor and are dealt by row.  So a stretch that fills the
    corpus is sent to its anchor's task once a slice."""
    def run(batches):
        powers = Powers()
        for batch in batches:
            for part in slices(batch, 1):
                found = []
                for group in _pieces(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    text = b"".join(x for _, _, x in group)
                    starts = np.cumsum([0] + [len(x) for _, _, x in group])
                    first, count, place, gram = stretches(np.frombuffer(text, "u1"), starts, powers)
                    piece = np.searchsorted(starts, first, side="right") - 1
                    offset = first - starts[piece] + np.array([at for _, at, _ in group], "i8")[piece]
                    own = np.array([xxhash.xxh3_64_intdigest(text[a:b]) for a, b in
                                    zip(first.tolist(), (first + count + LENGTH - 1).tolist())], "u8")
                    found.append((gram.view("i8"), own.view("i8"),
                                  np.array([k for k, _, _ in group], "i8")[piece],
                                  offset << 20 | count << 10 | (place - first)))
                if not found:
                    continue
                anchor, own, rid, at = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((own, anchor))
                anchor, own, rid, at = (x[order] for x in (anchor, own, rid, at))
                again = np.zeros(len(anchor) + 1, bool)
                again[1:-1] = (anchor[1:] == anchor[:-1]) & (own[1:] == own[:-1])
                again, twice = again[:-1], again[1:] | again[:-1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.where(again, rid, anchor)), pa.array(anchor, mask=again), pa.array(own),
                     pa.array(rid), pa.array(at), pa.array(twice)],
                    ["deal", "anchor", "stretch", "rid", "at", "twice"])

    return rows.select("rid", "bytes").mapInArrow(
        run, "deal long, anchor long, stretch long, rid long, at long, twice boolean")


def repeated(found: DataFrame) -> DataFrame:
    """(rid, at, anchor): stretches that occur twice or more (anchor null), and
    of anchors with several stretches one occurrence of each."""
    def run(batches):
        columns = ("anchor", "stretch", "rid", "at", "twice")
        held = None        # the last row: whether it is repeated depends on the next
        first = None       # first row of the current anchor, until it has gone on

        def part(x, is_last, fresh):
            """x: rows, the first of which may be the held one; fresh: whether
            that one begins an anchor, and a stretch."""
            nonlocal first
            n = len(x[0])
            new_anchor, new_stretch = np.ones(n, bool), np.ones(n + 1, bool)
            new_anchor[1:] = x[0][1:] != x[0][:-1]
            new_stretch[1:-1] = new_anchor[1:] | (x[1][1:] != x[1][:-1])
            new_anchor[0], new_stretch[0] = fresh
            m = n if is_last else n - 1     # rows decided now
            twice = (~new_stretch[:-1] | ~new_stretch[1:] | x[4])[:m]
            begin = np.maximum.accumulate(np.where(new_anchor[:m], np.arange(m), -1))
            later = np.flatnonzero((new_stretch[:-1] & ~new_anchor)[:m])
            rows = np.flatnonzero(twice)
            out = [(x[2][rows], x[3][rows], None)]
            heads = np.unique(begin[later])
            if len(heads) and heads[0] == -1:
                if first is not None:
                    out.append((first[2], first[3], first[0]))
                first, heads = None, heads[1:]
            go = np.sort(np.concatenate((heads, later)))
            out.append((x[2][go], x[3][go], x[0][go]))
            if m and begin[m - 1] >= 0:
                b = int(begin[m - 1])
                first = None if len(heads) and heads[-1] == b else [c[b:b + 1] for c in x]
            return out, ((new_anchor[-1], new_stretch[n - 1]) if not is_last else None)

        def made(out):
            for rid, at, anchor in out:
                if len(rid):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rid), pa.array(at),
                         pa.nulls(len(rid), pa.int64()) if anchor is None else pa.array(anchor)],
                        ["rid", "at", "anchor"])

        fresh = (True, True)
        for batch in batches:
            sure = batch.column(0).null_count   # these come first
            if sure:
                yield from made([(batch.column(2).slice(0, sure), batch.column(3).slice(0, sure), None)])
                batch = batch.slice(sure)
            if not batch.num_rows:
                continue
            x = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(columns))]
            if held is not None:
                x = [np.concatenate((a, b)) for a, b in zip(held, x)]
            out, fresh = part(x, False, fresh)
            held = [c[-1:] for c in x]
            yield from made(out)
        if held is not None:
            yield from made(part(held, True, fresh)[0])

    return (found.repartition("deal")
            .sortWithinPartitions(F.col("anchor").asc_nulls_first(), "stretch", "rid", "at")
            .select("anchor", "stretch", "rid", "at", "twice")
            .mapInArrow(run, "rid long, at long, anchor long"))


def suffix_order(data: np.ndarray, hashes: PrefixHash, start: np.ndarray, length: np.ndarray,
                 group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): suffixes sorted within their groups (equal numbers in
    ``group`` stand together) and each one's common extension with the one
    before it, -1 at the first of a group.  Bottom-up mergesort over all groups
    at once: an element's place in a merged run is its place in its own run
    plus its rank, by binary search, in the other."""
    n = len(start)
    order = np.arange(n)
    begin = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.concatenate((begin, [n])))
    begin, end = np.repeat(begin, sizes), np.repeat(begin + sizes, sizes)

    def less(a, b):
        most = np.minimum(length[a], length[b])
        k = hashes.common(start[a], start[b], most)
        inside = k < most
        last = len(data) - 1
        x, y = data[np.minimum(start[a] + k, last)], data[np.minimum(start[b] + k, last)]
        return np.where(inside, x < y, length[a] < length[b])

    width, biggest = 1, int(sizes.max(initial=0))
    while width < biggest:
        at = np.flatnonzero(end - begin > width)
        run = (at - begin[at]) // width
        other = begin[at] + (run ^ 1) * width
        size = np.clip(end[at] - other, 0, width)
        low, high = np.zeros(len(at), "i8"), size.copy()
        mine, right = order[at], run & 1 == 1
        while len(todo := np.flatnonzero(low < high)):
            mid = (low[todo] + high[todo]) >> 1
            theirs, own = order[other[todo] + mid], mine[todo]
            on_right = right[todo]
            # ties keep the left run first
            a, b = np.where(on_right, own, theirs), np.where(on_right, theirs, own)
            before = less(a, b) ^ on_right
            low[todo] = np.where(before, mid + 1, low[todo])
            high[todo] = np.where(before, high[todo], mid)
        target = begin[at] + (run & ~1) * width + (at - begin[at]) % width + low
        order[target] = mine
        width *= 2
    common = np.full(n, -1, "i8")
    inner = np.flatnonzero(np.arange(n) > begin)
    a, b = order[inner - 1], order[inner]
    common[inner] = hashes.common(start[a], start[b], np.minimum(length[a], length[b]))
    return order, common


def shared_windows(texts: list[bytes], count: np.ndarray, place: np.ndarray, group: np.ndarray,
                   powers: Powers) -> np.ndarray:
    """Matrix (stretch, window): which windows of the stretches (texts with
    ``count`` windows each and the anchor at ``place``) occur in another
    stretch of the same group."""
    span = LENGTH - GRAM + 1
    length = np.array([len(t) for t in texts], "i8")
    base = np.cumsum(length) - length
    data = np.frombuffer(b"".join(texts), "u1")
    hashes = PrefixHash(data, powers)
    order, common = suffix_order(data, hashes, base + place, length - place, group)
    base, count, place, group = (x[order] for x in (base, count, place, group))
    out = np.zeros((len(texts), span), bool)
    views = sliding_window_view(data, LENGTH)
    wrong: set[int] = set()
    for d in range(span):           # windows that begin d bytes before the anchor
        on = np.flatnonzero((place - count < d) & (d <= place))
        if len(on) < 2:
            continue
        right = np.cumsum(common < LENGTH - d)
        left = hashes.of(base[on] + place[on] - d, d)
        key = (right[on].astype("u8") * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (left * _MIX)
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        if not same.any():
            continue
        head = np.maximum.accumulate(np.where(np.concatenate(([True], ~same)), np.arange(len(by)), 0))
        member = np.concatenate(([False], same))
        i, j = on[by[member]], on[by[head[member]]]
        for c in range(0, len(i), 1 << 14):
            a, b = i[c:c + (1 << 14)], j[c:c + (1 << 14)]
            equal = (views[base[a] + place[a] - d] == views[base[b] + place[b] - d]).all(axis=1)
            wrong.update(group[a[~equal]].tolist())
            out[order[a[equal]], place[a[equal]] - d] = True
            out[order[b[equal]], place[b[equal]] - d] = True
    for g in wrong:                 # hashes collided: compare the bytes alone
        where: dict[bytes, list] = {}
        for i in np.flatnonzero(group == g).tolist():
            for w in range(count[i]):
                where.setdefault(data[base[i] + w:base[i] + w + LENGTH].tobytes(), []).append((order[i], w))
        for i in order[group == g].tolist():
            out[i] = False
        for places in where.values():
            for i, w in places if len(places) > 1 else ():
                out[i, w] = True
    return out


def _cut(joined: DataFrame) -> DataFrame:
    """(anchor, rid, at, part): the bytes of the stretches listed in ``goes``."""
    names = joined.columns

    def run(batches):
        for batch in batches:
            for part in slices(batch, names.index("bytes")):
                out = [], [], [], []
                for rid, text, goes in zip(*(part.column(names.index(c)).to_pylist()
                                             for c in ("rid", "bytes", "goes"))):
                    for x in goes:
                        a, n = x["at"] >> 20, x["at"] >> 10 & 1023
                        for column, v in zip(out, (x["anchor"], rid, x["at"], text[a:a + n + LENGTH - 1])):
                            column.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(out, [pa.int64()] * 3 + [pa.binary()])],
                    ["anchor", "rid", "at", "part"])

    return joined.mapInArrow(run, "anchor long, rid long, at long, part binary")


def _sorted_groups(parts: DataFrame) -> DataFrame:
    """(rid, first, last): runs of repeated windows, by sorting each anchor's suffixes."""
    def run(batches):
        powers = Powers()

        def solve(rows):
            anchor, rid, at, texts = (list(x) for x in zip(*rows))
            at = np.array(at, "i8")
            mask = shared_windows(texts, at >> 10 & 1023, at & 1023, np.array(anchor, "i8"), powers)
            edges = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype("i1"), axis=1)
            i, a = np.nonzero(edges == 1)
            b = np.nonzero(edges == -1)[1]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array(rid, "i8")[i]), pa.array((at[i] >> 20) + a),
                 pa.array((at[i] >> 20) + b)], ["rid", "first", "last"])

        rows, size = [], 0
        every = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
        for _, own in groupby(every, key=lambda r: r[0]):
            own = list(own)
            rows += own
            size += sum(len(r[3]) for r in own)
            if size > BATCH_BYTES:
                yield solve(rows)
                rows, size = [], 0
        if rows:
            yield solve(rows)

    return (parts.repartition("anchor").sortWithinPartitions("anchor")
            .mapInArrow(run, "rid long, first long, last long"))


def _counted_windows(parts: DataFrame) -> DataFrame:
    """As _sorted_groups, for anchors of any number of stretches: windows are
    counted by a 128-bit hash."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, 3):
                out = [], [], [], []
                for _, rid, at, text in zip(*(c.to_pylist() for c in part.columns)):
                    for w in range(at >> 10 & 1023):
                        h = xxhash.xxh3_128_digest(text[w:w + LENGTH])
                        for column, v in zip(out, (int.from_bytes(h[:8], "big", signed=True),
                                                   int.from_bytes(h[8:], "big", signed=True),
                                                   rid, (at >> 20) + w)):
                            column.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out],
                                                 ["h1", "h2", "rid", "first"])

    windows = parts.mapInArrow(run, "h1 long, h2 long, rid long, first long")
    twice = windows.groupBy("h1", "h2").count().filter("count > 1").select("h1", "h2")
    return windows.join(twice, ["h1", "h2"]).select("rid", "first", (F.col("first") + 1).alias("last"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` plus n_bytes, removed (maximal runs of removed bytes, end
    exclusive) and kept (the remaining bytes)."""
    rows = docs.select(F.xxhash64(F.col(doc_id), F.col(text)).alias("rid"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text],
                                F.lit(0).alias("__one")).alias("__row"),
                       F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("bytes"))
    found = written(repeated(anchors(rows)), "stretches")
    goes = found.filter("anchor is not null")
    listed = lambda x: (x.groupBy("rid").agg(
        F.collect_set(F.struct("anchor", "at")).alias("goes")).hint("shuffle_hash"))
    hot = goes.groupBy("anchor").count().filter(F.col("count") > MAX_GROUP).select("anchor")
    hot = written(hot, "hot-anchors")
    some = not hot.isEmpty()
    normal = goes.join(hot, "anchor", "left_anti") if some else goes
    runs = _sorted_groups(_cut(rows.join(listed(normal), "rid")))
    if some:
        runs = runs.unionByName(_counted_windows(_cut(rows.join(listed(goes.join(hot, "anchor")), "rid"))))
    whole = (found.filter("anchor is null")
             .select("rid", F.shiftright("at", 20).alias("first"),
                     (F.shiftright("at", 20) + F.shiftright("at", 10).bitwiseAND(1023)).alias("last")))
    spans = (runs.unionByName(whole).groupBy("rid")
             .agg(F.collect_set(F.struct("first", "last")).alias("spans")).hint("shuffle_hash"))
    joined = rows.join(spans, "rid", "left")
    names = joined.columns
    row_type = joined.schema["__row"]

    def cut_out(batches):
        for batch in batches:
            for part in slices(batch, names.index("bytes")):
                texts, spans = (part.column(names.index(c)).to_pylist() for c in ("bytes", "spans"))
                removed, kept = [], []
                for text, own in zip(texts, spans):
                    out, left, end = [], [], 0
                    for a, b in sorted((x["first"], x["last"] + LENGTH - 1) for x in own or ()):
                        if out and a <= out[-1]["end"]:
                            out[-1]["end"] = max(out[-1]["end"], b)
                        else:
                            out.append({"start": a, "end": b})
                    for x in out:
                        left.append(text[end:x["start"]])
                        end = x["end"]
                    removed.append(out)
                    kept.append(b"".join(left) + text[end:] if out else text)
                yield pa.RecordBatch.from_arrays(
                    [part.column(names.index("__row")), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array(removed, arrow_type(SPANS)), pa.array(kept, pa.binary())],
                    ["__row", "n_bytes", "removed", "kept"])

    schema = T.StructType([row_type, *T.StructType.fromDDL(
        f"n_bytes long, removed {SPANS}, kept binary").fields])
    return joined.mapInArrow(cut_out, schema)
