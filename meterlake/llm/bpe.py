"""Byte-level BPE encoding and decoding with a rank queue.

The parts of all pre-tokens that are new to a batch stand in one linked list
(links stop at the ends of a pre-token).  A bucket for every merge rank holds
the list positions whose pair has that rank, and a hierarchical bitmap over the
ranks gives the lowest non-empty bucket by find-first-set.  A bucket is merged from
the left, overlapping pairs in turn, up to a merge that makes a pair of lower rank:
what stands right of it in its pre-token is filed again.  Entries whose pair has
changed since they were filed are stale and are skipped.  Buckets with many positions
are merged as arrays, so a long pre-token takes time in proportion to its length times
the number of ranks that occur in it one after the other (a run of n equal letters: the
logarithm of n).

Ids come packed as little-endian unsigned 32-bit integers, the layout of
training token files.  A null text is treated as empty; an empty text has no
ids.  Rows are independent: repeated rows give repeated results, and an empty
table gives an empty table.
"""

from __future__ import annotations

import base64
from itertools import filterfalse
from struct import pack

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_column

# What two texts of a batch share between spaces, and its pre-tokens, are
# remembered up to MEMO_CHARS code points, MEMO_SIZE of each at most per worker.
MEMO_CHARS = 64
MEMO_SIZE = 100_000
SLICE = 2 << 20     # bytes of text whose new pre-tokens are merged together
SMALL = 200         # positions of a bucket that are merged one by one
VOCABULARY = "byte_bpe_50k.tiktoken"


def load_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> rank, of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class RankQueue:
    """Buckets of positions by rank.  ``words`` has a bit for every rank with
    positions, 256 to a word, and ``top`` a bit for every word that is not zero."""

    def __init__(self, n_ranks: int):
        self.words = [0] * ((n_ranks >> 8) + 1)
        self.top = 0
        self.buckets: dict[int, list] = {}      # single positions
        self.arrays: dict[int, list] = {}       # arrays of positions

    def _mark(self, rank: int) -> None:
        w = rank >> 8
        self.words[w] |= 1 << (rank & 255)
        self.top |= 1 << w

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            self._mark(rank)
        else:
            bucket.append(position)

    def push_all(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        edges = np.flatnonzero(np.diff(ranks)) + 1
        for r, own in zip(ranks[np.concatenate(([0], edges))].tolist() if len(ranks) else (),
                          np.split(positions, edges)):
            self.arrays.setdefault(r, []).append(own)
            self._mark(r)

    def pop(self):
        """(lowest rank, its positions): a list, or an array if there are many;
        None if the queue is empty."""
        if not self.top:
            return None
        w = (self.top & -self.top).bit_length() - 1
        x = self.words[w]
        low = x & -x
        self.words[w] = x ^ low
        if x == low:
            self.top &= self.top - 1
        rank = (w << 8) + low.bit_length() - 1
        single, many = self.buckets.pop(rank, None), self.arrays.pop(rank, None)
        if many is None:
            return rank, single
        if single is not None:
            many.append(np.array(single, "i4"))
        many = np.concatenate(many) if len(many) > 1 else many[0]
        return rank, (many if len(many) > SMALL else many.tolist())


class Merger:
    """Merges pre-tokens by the ranks of a vocabulary (token bytes -> rank,
    which is also the id)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values(), default=0) + 1
        self.first_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)], "i4")
        # rank of the pair of ids (a, b): that of their bytes put together
        self.pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    self.pairs[left * self.size + right] = rank
        self.keys = np.array(sorted(self.pairs), "i8")
        self.values = np.array([self.pairs[k] for k in self.keys.tolist()], "i4")
        # ranks that stand in a pair of lower rank: only their merges can make a lower rank appear
        self.falls = np.zeros(self.size, bool)
        for part in (self.keys // self.size, self.keys % self.size):
            self.falls[part[self.values < part]] = True

    def _rank_of(self, left: np.ndarray, right) -> np.ndarray:
        key = left.astype("i8") * self.size + right
        if not len(self.keys):
            return np.full(len(key), -1, "i4")
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], np.int32(-1))

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each pre-token."""
        data = np.frombuffer(b"".join(pieces), "u1")
        n = len(data)
        lengths = np.array([len(p) for p in pieces], "i8")
        owner = np.repeat(np.arange(len(pieces), dtype="i4"), lengths)
        ids = self.first_ids[data]
        after = np.arange(1, n + 1, dtype="i4")     # start of the next part, -1 at the end
        before = np.arange(-1, n - 1, dtype="i4")   # start of the previous part, -1 at the beginning
        ends = np.cumsum(lengths)
        after[ends[lengths > 0] - 1] = -1
        before[(ends - lengths)[lengths > 0]] = -1
        alive = np.ones(n, bool)                    # whether a part starts here
        filed = np.full(n, -1, "i4")                # rank under which the pair at a start is filed
        inner = np.flatnonzero(after >= 0)
        filed[inner] = self._rank_of(ids[inner], ids[inner + 1])
        whole = np.array([self.ranks.get(p, -1) for p in pieces], "i8")
        filed[(whole >= 0)[owner]] = -1             # pre-tokens that are tokens are not merged
        queue = RankQueue(self.size)
        inner = np.flatnonzero(filed >= 0).astype("i4")
        queue.push_all(filed[inner], inner)
        views = [memoryview(x) for x in (ids, after, before, owner, filed, alive)]
        while (found := queue.pop()) is not None:
            rank, positions = found
            if positions.__class__ is list:
                self._merge_few(rank, positions, queue, *views)
            else:
                self._merge_many(rank, positions, queue, ids, after, before, owner, filed, alive)
        counts = np.bincount(owner[alive], minlength=len(pieces))
        packed = ids[alive].astype("<u4").tobytes()
        stops = (4 * np.cumsum(counts)).tolist()
        return [packed[a:b] if w < 0 else pack("<I", w)
                for a, b, w in zip([0, *stops], stops, whole.tolist())]

    def _merge_few(self, rank, positions, queue, ids, after, before, owner, filed, alive) -> None:
        get, size, push = self.pairs.get, self.size, queue.push
        positions.sort()
        waits = -1      # the pre-token in which a lower rank has appeared
        for i in positions:
            if filed[i] != rank:
                continue    # stale: the pair at i has changed or i is no longer a start
            own = owner[i]
            if own == waits:
                push(rank, i)   # the lower rank comes first, and what follows from it
                continue
            j = after[i]
            k = after[j]
            after[i] = k
            ids[i] = rank
            alive[j] = False
            filed[j] = -1
            if k >= 0:
                before[k] = i
                r = get(rank * size + ids[k], -1)
                filed[i] = r
                if r >= 0:
                    push(r, i)
                    if r < rank:
                        waits = own
            else:
                filed[i] = -1
            h = before[i]
            if h >= 0:
                r = get(ids[h] * size + rank, -1)
                filed[h] = r
                if r >= 0:
                    push(r, h)
                    if r < rank:
                        waits = own

    def _merge_many(self, rank, positions, queue, ids, after, before, owner, filed, alive) -> None:
        i = np.sort(positions[filed[positions] == rank])
        i = i[np.concatenate(([True], i[1:] != i[:-1]))] if len(i) else i
        if not len(i):
            return
        # of pairs that overlap in a chain (as in "aaaa") every other is merged, from the left
        linked = np.zeros(len(i), bool)
        linked[1:] = after[i[:-1]] == i[1:]
        number = np.arange(len(i))
        chosen = (number - np.maximum.accumulate(np.where(linked, 0, number))) & 1 == 0
        s = i[chosen]
        j = after[s]
        k = after[j]
        if self.falls[rank]:
            # the pairs that a merge makes when all merges to its left are done and none to its
            # right: a lower rank among them comes first, and what stands right of it waits
            lower = np.zeros(len(s), bool)
            on = k >= 0
            right = self._rank_of(np.full(int(on.sum()), rank), ids[k[on]])
            lower[on] = (right >= 0) & (right < rank)
            h = before[s]
            on = h >= 0
            at = np.minimum(np.searchsorted(j, h[on]), len(j) - 1)
            left = self._rank_of(np.where(j[at] == h[on], np.int32(rank), ids[h[on]]), rank)
            lower[on] |= (left >= 0) & (left < rank)
            if lower.any():
                own, first = np.unique(owner[s[lower]], return_index=True)
                last = s[lower][first]                  # the last merge of each such pre-token now
                place = np.minimum(np.searchsorted(own, owner[s]), len(own) - 1)
                now = (own[place] != owner[s]) | (s <= last[place])
                s, j, k = s[now], j[now], k[now]
                place = np.minimum(np.searchsorted(own, owner[i]), len(own) - 1)
                rest = i[(own[place] == owner[i]) & (i > last[place])]
                done = np.minimum(np.searchsorted(j, rest), len(j) - 1)
                rest = rest[j[done] != rest]
                if len(rest):
                    queue.push_all(np.full(len(rest), rank, "i4"), rest)
        after[s], ids[s], alive[j], filed[j] = k, rank, False, -1
        on = k >= 0
        before[k[on]] = s[on]
        right = np.full(len(s), -1, "i4")
        right[on] = self._rank_of(np.full(int(on.sum()), rank), ids[k[on]])
        filed[s] = right
        h = before[s]
        h = h[h >= 0]
        h = h[s[np.minimum(np.searchsorted(s, h), len(s) - 1)] != h]    # these have their pair already
        left = self._rank_of(ids[h], rank)
        filed[h] = left
        new, at = np.concatenate((right, left)), np.concatenate((s, h))
        on = new >= 0
        if on.any():
            queue.push_all(new[on], at[on].astype("i4"))


class Encoder:
    """Encodes batches of texts, remembering chunks and pre-tokens.

    A chunk is what stands between two spaces, with the space before it.
    Where all of them begin and end with another character than white space,
    no pre-token crosses a chunk's ends, so chunks are split and encoded on
    their own; other texts are split by the pattern as a whole.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        self.split = regex.compile(pattern).findall
        self.merger = Merger(ranks)
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _parts(self, chunks: list[str]) -> dict[str, list[str]]:
        """The pre-tokens of each chunk.  All are split in one go: as no pre-token crosses
        a chunk's ends, only a chunk's first one begins with a space."""
        cut = self.split(" " + " ".join(chunks)) if chunks else []
        if len(cut) == len(chunks):
            return {c: (p,) for c, p in zip(chunks, cut)}
        starts = [i for i, p in enumerate(cut) if p[0] == " "]
        return {c: cut[a:b] for c, a, b in zip(chunks, starts, [*starts[1:], len(cut)], strict=True)}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.chunks) > MEMO_SIZE:
            self.chunks.clear()
        if len(self.pieces) > MEMO_SIZE:
            self.pieces.clear()
        chunks, pieces = self.chunks, self.pieces
        words = [t.split(" ") if t else () for t in texts]
        new: set[str] = set()
        twice: set[str] = set()     # in two texts of the batch
        for w in words:
            own = set(filterfalse(chunks.__contains__, w))
            twice |= own & new
            new |= own
        odd = {c for c in new if not c or c[0].isspace() or c[-1].isspace()}
        parts = self._parts(list(new.difference(odd)))
        whole = [self.split(t) if w and not (odd.isdisjoint(w)) else None for t, w in zip(texts, words)]
        heads = [self.split(w[0]) if w and own is None else () for w, own in zip(words, whole)]
        wanted = set().union(*parts.values(), *heads, *filter(None, whole)).difference(pieces)
        found = list(wanted)
        pieces.update(zip(found, self.merger.merge([p.encode() for p in found])))
        get = pieces.__getitem__
        chunks.update((c, get(own[0]) if len(own) == 1 else b"".join(map(get, own))) for c, own in parts.items())
        out = []
        for w, h, own in zip(words, heads, whole):
            if own is not None:
                out.append(b"".join(map(get, own)))
            else:
                out.append(b"".join(map(get, h)) + b"".join(map(chunks.__getitem__, w[1:])))
        # what two texts share is remembered
        twice = {c for c in twice if c in parts and len(c) <= MEMO_CHARS}
        for c in parts.keys() - twice:
            del chunks[c]
        for p in set(found).difference(*[parts[c] for c in twice]):
            del pieces[p]
        return out


class Vocabulary:
    """Broadcast to the tasks; a Python worker keeps its encoder, and what that
    remembers, from task to task."""

    def __init__(self, path: str | None = None):
        self.ranks = load_ranks(path or public_tokenizers.path(VOCABULARY))
        self.first_free = max(self.ranks.values(), default=-1) + 1
        self.kept = None

    def encoder(self) -> Encoder:
        if self.kept is None:
            self.kept = Encoder(self.ranks)
        return self.kept

    def decoder(self) -> Decoder:
        return Decoder(self.ranks)


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = np.full(max(ranks.values(), default=-1) + 1, None, object)
        for t, i in ranks.items():
            self.tokens[i] = t

    def decode(self, packed: bytes | None) -> bytes:
        return b"".join(self.tokens[np.frombuffer(packed or b"", "<u4")].tolist())


def vocabulary(df: DataFrame, path: str | None = None):
    """The vocabulary file, read on the driver and broadcast: its size does not
    depend on the data."""
    return df.sparkSession.sparkContext.broadcast(Vocabulary(path))


def encode(df: DataFrame, text: str = "text", path: str | None = None,
           decoded: bool = False) -> DataFrame:
    """``df`` plus ``n_tokens`` and ``token_ids`` (packed); with ``decoded`` also
    the bytes that the ids decode to, by the same worker."""
    shared = vocabulary(df, path)

    def make():
        encoder = shared.value.encoder()
        decoder = shared.value.decoder() if decoded else None

        def work(texts):
            packed = encoder.encode(texts)
            out = [[len(p) >> 2 for p in packed], packed]
            return out + [list(map(decoder.decode, packed))] if decoded else out
        return work

    fields = [("n_tokens", "long"), ("token_ids", "binary")] + [("decoded", "binary")] * decoded
    return map_column(df, text, make, fields, SLICE)


def decode(df: DataFrame, token_ids: str = "token_ids", path: str | None = None) -> DataFrame:
    """``df`` plus ``decoded``: the bytes of packed ids (null: empty).  An id
    outside the vocabulary raises an error."""
    shared = vocabulary(df, path)

    def make():
        decoder = shared.value.decoder()
        return lambda values: [[decoder.decode(v) for v in values]]

    return map_column(df, token_ids, make, [("decoded", "binary")])


def unpacked(token_ids: str = "token_ids"):
    """Packed ids as an array of longs (a column expression)."""
    h = F.hex(F.col(token_ids))
    n = (F.length(h) / 8).cast("int")
    part = lambda i, k: F.substring(h, i * 8 + 2 * k + 1, F.lit(2))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.conv(
        F.concat(*[part(i, k) for k in (3, 2, 1, 0)]), 16, 10).cast("long"))).otherwise(
        F.array().cast("array<long>"))
