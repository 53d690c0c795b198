"""Ranked lexical search: the k best documents of each query, by Block-Max MaxScore.

Terms are maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z
lower-cased.  N documents hold a term, L is the number of all their terms, n that of
one document; df documents hold a term, tf times in one.  A term weighs
w = floor(1000 ln((2N+2) / (2df+1))), a document has m = 75 + (25 n N) div L, and its
score sums w * ((10^9 tf) div (1000 tf + 12 m)) over the query's terms, repeats
included.  Equal scores rank by ascending id (null last).

``build_index`` makes the index where the documents lie, without a shuffle: every
task closes a shard after SHARD_BYTES of text (a longer text is a shard of its own).
A shard is a header row (ids in ascending order, lengths) and, for each term, rows of
up to BLOCK postings: gaps and frequencies as variable-length bytes, with the last
posting, the greatest tf and the least length of the block beside them.  Both are
known without N and L, and bound a score for any N and L, as a score grows with tf
and falls with n; so the index holds every row and every term and serves any query.

``search`` reads the postings of the queries' terms, brings the rows of a shard
together and runs every query over the shard.  Lists are ordered by their global
bounds (w times the list's best block); as many of the weakest as cannot reach the
k-th best score together are non-essential.  Essential lists are summed window by
window of the shard's documents; then the non-essential ones, strongest first: a
candidate that the bounds still to come cannot save is dropped, then one that the
block maximum cannot save, and only the blocks of the rest are decompressed.  The k
best of a query are kept from shard to shard within a task, so later shards start
with a threshold; the tasks' lists are merged by a rank window whose limit Spark
applies before its shuffle.

Bounds: a task holds one shard's postings; queries are taken in blocks of about
QUERY_TERMS different (query, term) pairs by a hash of the query, and a block's terms
are broadcast.  Each further block reads the index again, not the texts.

Null or term-less documents count for nothing and are never found; such queries have
no rows.  Repeated rows of documents or queries are documents and queries of their
own.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from .common import written

SHARD_BYTES = 16 << 20
BLOCK = 64
QUERY_TERMS = 500_000
# Documents of the first window of a shard; every next one is four times longer.
FIRST_WINDOW = 256
PIECE = 1 << 20
EMIT_ROWS = 50_000

# A-Z to a-z, everything that parts terms to a blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
              for b in range(256))
_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _pieces(folded: bytes):
    """Parts of a folded text that end at a blank, so that a long text's words
    never exist all at once."""
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + PIECE) if at + PIECE < len(folded) else -1
        end = len(folded) if end < 0 else end
        yield folded[at:end]
        at = end


def _varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values in seven bits a byte, low ones first, and where each begins."""
    size = np.ones(len(values), np.int64)
    for bits in (7, 14, 21, 28):
        size += values >= 1 << bits
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(at[-1], np.uint8)
    for k in range(5):
        m = size > k
        if not m.any():
            break
        out[at[:-1][m] + k] = (values[m] >> (7 * k)) & 127 | np.where(size[m] > k + 1, 128, 0)
    return out, at


def _numbers(data: np.ndarray) -> np.ndarray:
    """What ``_varints`` encoded."""
    ends = np.flatnonzero(data < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), starts)


class _Shard:
    """The documents of a shard while it is built."""

    def __init__(self):
        self.terms: dict[bytes, int] = {}
        self.words: list[np.ndarray] = []
        self.ids: list[pa.Array] = []
        self.lengths: list[int] = []
        self.bytes = 0

    def add(self, ids: pa.Array, texts: list) -> None:
        number = self.terms.setdefault
        for text in texts:
            n = 0
            for piece in _pieces((text or b"").translate(_FOLD)):
                words = piece.split()
                self.words.append(np.array([number(w, len(self.terms)) for w in words], np.int32))
                n += len(words)
            self.lengths.append(n)
            self.bytes += len(text or b"")
        self.ids.append(ids)

    def batches(self, shard: int, schema: pa.Schema):
        ids = pa.concat_arrays(self.ids)
        lengths = np.array(self.lengths, np.int64)
        order = pc.sort_indices(ids, null_placement="at_end").to_numpy(zero_copy_only=False)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        n = lengths[order]
        yield pa.RecordBatch.from_arrays([
            pa.array([shard], pa.int64()), pa.array([None], pa.binary()), pa.array([0], pa.int32()),
            pa.array([int((n > 0).sum())], pa.int64()), pa.array([int(n.sum())], pa.int64()),
            pa.array([0], pa.int32()), pa.array([0], pa.int32()),
            pa.array([_varints(n)[0].tobytes()], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(pa.array(order)))], schema=schema)
        if not n.sum():
            return
        key = np.concatenate(self.words).astype(np.int64) * len(n) + np.repeat(rank, lengths)
        key.sort()
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        tf = np.diff(np.append(first, len(key)))
        term, doc = np.divmod(key[first], len(n))
        begins = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
        place = np.arange(len(term)) - np.repeat(begins, np.diff(np.append(begins, len(term))))
        opens = place % BLOCK == 0
        gap = doc.copy()
        gap[1:] -= np.where(opens[1:], 0, doc[:-1])     # a block begins with its first document
        data, at = _varints(np.stack([gap, tf], 1).ravel())
        block = np.flatnonzero(opens)
        count = np.diff(np.append(block, len(term)))
        cuts = at[np.append(2 * block, 2 * len(term))]
        last, most = doc[block + count - 1], np.maximum.reduceat(tf, block)
        least = np.minimum.reduceat(n[doc], block)
        names = list(self.terms)
        for i in range(0, len(block), EMIT_ROWS):
            s = slice(i, i + EMIT_ROWS)
            rows = len(block[s])
            lo, hi = cuts[i], cuts[i + rows]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(rows, shard)), pa.array([names[t] for t in term[block[s]].tolist()], pa.binary()),
                pa.array((place[block[s]] // BLOCK).astype(np.int32)), pa.array(count[s]),
                pa.array(last[s]), pa.array(most[s].astype(np.int32)), pa.array(least[s].astype(np.int32)),
                pa.Array.from_buffers(pa.binary(), rows, [
                    None, pa.py_buffer((cuts[i:i + rows + 1] - lo).astype(np.int32).tobytes()),
                    pa.py_buffer(data[lo:hi].tobytes())]),
                pa.nulls(rows, schema.field("ids").type)], schema=schema)


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of all documents, written to the shared folder: rows of a shard,
    its header (``term`` null) and blocks of postings.

    ``count``: postings of the block, in a header the documents that hold a term;
    ``last``: the block's last document, in a header the number of terms."""
    kind = docs.schema[key].dataType
    schema = T.StructType.fromDDL("shard long, term binary, block int, count long, last long, "
                                  "max_tf int, min_length int, data binary").add("ids", T.ArrayType(kind))
    arrow = pa.schema([("shard", pa.int64()), ("term", pa.binary()), ("block", pa.int32()), ("count", pa.int64()),
                       ("last", pa.int64()), ("max_tf", pa.int32()), ("min_length", pa.int32()),
                       ("data", pa.binary()), ("ids", pa.list_(to_arrow_type(kind)))])

    def run(batches):
        shard, number = _Shard(), TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column(1)
            for i in range(0, batch.num_rows, 64):
                shard.add(batch.column(0).slice(i, 64), texts.slice(i, 64).to_pylist())
                if shard.bytes >= SHARD_BYTES:
                    yield from shard.batches(number, arrow)
                    shard, number = _Shard(), number + 1
        if shard.ids:
            yield from shard.batches(number, arrow)

    source = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    return written(source.mapInArrow(run, schema), "search-index")


def terms_of(text: Column) -> Column:
    """The terms of a text, in order, as bytes."""
    found = F.regexp_extract_all(F.translate(text, _AZ, _AZ.lower()),
                                 F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"), F.lit(1))
    return F.transform(found, lambda t: t.cast("binary"))


class _List:
    """A term's postings in a shard; blocks are decompressed when first needed."""

    __slots__ = ("weight", "last", "bound", "best", "at", "data", "docs", "scores", "ready")

    def __init__(self, rows: dict, span: slice, norm):
        self.weight = int(rows["weight"][span.start])
        self.last = rows["last"][span]
        tf = rows["max_tf"][span].astype(np.int64)
        self.bound = self.weight * _gain(tf, norm.of(rows["min_length"][span]))
        self.best = int(self.bound.max())
        self.at = np.concatenate([[0], np.cumsum(rows["count"][span])])
        self.data = rows["data"].slice(span.start, span.stop - span.start)
        self.docs = np.zeros(self.at[-1], np.int64)
        self.scores = np.zeros(self.at[-1], np.int64)
        self.ready = np.zeros(len(self.last), bool)

    def need(self, blocks: np.ndarray, m: np.ndarray) -> None:
        blocks = blocks[~self.ready[blocks]]
        if not len(blocks):
            return
        raw = b"".join(self.data.take(pa.array(blocks)).to_pylist())
        pairs = _numbers(np.frombuffer(raw, np.uint8)).reshape(-1, 2)
        size = self.at[blocks + 1] - self.at[blocks]
        ends = np.cumsum(size)
        total = np.cumsum(pairs[:, 0])
        docs = total - np.repeat(np.concatenate([[0], total[ends[:-1] - 1]]), size)
        to = np.repeat(self.at[blocks], size) + np.arange(len(docs)) - np.repeat(ends - size, size)
        self.docs[to] = docs
        self.scores[to] = self.weight * _gain(pairs[:, 1], m[docs])
        self.ready[blocks] = True

    def between(self, low: int, high: int, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents in [low, high) and their scores."""
        first = int(np.searchsorted(self.last, low))
        end = min(len(self.last), int(np.searchsorted(self.last, high - 1)) + 1)
        if first >= end:
            return self.docs[:0], self.scores[:0]
        self.need(np.arange(first, end), m)
        docs = self.docs[self.at[first]:self.at[end]]
        i, j = np.searchsorted(docs, (low, high))
        return docs[i:j], self.scores[self.at[first]:self.at[end]][i:j]


def _gain(tf, m):
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class _Norm:
    """m of a length, for a corpus of N documents and L terms."""

    def __init__(self, documents: int, terms: int):
        self.documents, self.terms = documents, terms

    def of(self, lengths: np.ndarray) -> np.ndarray:
        lengths = lengths.astype(np.int64)
        if len(lengths) and 25 * int(lengths.max()) * self.documents >= 1 << 62:
            return np.array([75 + 25 * int(n) * self.documents // self.terms for n in lengths], np.int64)
        return 75 + 25 * lengths * self.documents // self.terms


def _best(lists: list[tuple[int, _List]], m: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of a shard among which its k best of ``least`` and more
    are; ``lists`` are (times in the query, postings)."""
    lists = sorted(lists, key=lambda x: x[0] * x[1].best)
    reach = np.concatenate([[0], np.cumsum([times * x.best for times, x in lists])])
    found, scores = [], []
    best = np.zeros(0, np.int64)
    low, width = 0, FIRST_WINDOW
    while low < len(m):
        high = min(len(m), low + width)
        essential = int(np.searchsorted(reach[1:], least))   # lists before it cannot reach ``least``
        if essential == len(lists):
            break
        total = np.zeros(high - low, np.int64)
        for times, x in lists[essential:]:
            docs, gained = x.between(low, high, m)
            total[docs - low] += times * gained
        docs = np.flatnonzero(total)
        total = total[docs]
        docs += low
        for i in range(essential - 1, -1, -1):
            keep = total + reach[i + 1] >= least
            docs, total = docs[keep], total[keep]
            if not len(docs):
                break
            times, x = lists[i]
            block = np.searchsorted(x.last, docs)
            inside = block < len(x.last)
            block[~inside] = 0
            keep = total + np.where(inside, times * x.bound[block], 0) + reach[i] >= least
            docs, total, block, inside = docs[keep], total[keep], block[keep], inside[keep]
            if inside.any():
                wanted = np.unique(block[inside])
                x.need(wanted, m)
                size = x.at[wanted + 1] - x.at[wanted]
                at = np.repeat(x.at[wanted] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                place = np.searchsorted(x.docs[at], docs)
                place[place == len(at)] = 0
                total = total + np.where(x.docs[at][place] == docs, times * x.scores[at][place], 0)
        keep = total >= least
        docs, total = docs[keep], total[keep]
        if len(docs):
            found.append(docs)
            scores.append(total)
            best = np.sort(np.concatenate([best, total]))[-k:]
            if len(best) == k:
                least = max(least, int(best[0]))
        low, width = high, 4 * width
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(scores)


def _shards(batches):
    """The rows of each shard, from batches in order of shard, term and block."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        shard = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
        for i, j in zip(cuts, cuts[1:]):
            if j > i:
                if held and held[0].column(0)[0].as_py() != int(shard[i]):
                    yield pa.Table.from_batches(held).combine_chunks()
                    held = []
                held.append(batch.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name)
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)


def _searcher(queries, norm: _Norm, k: int, arrow: pa.Schema):
    """A function over a task's shards that yields its k best of every query;
    ``queries``: a broadcast list of (number, [(term, times), ...])."""
    def run(batches):
        best: dict[int, list] = {}
        for table in _shards(batches):
            head, body = table.slice(0, 1), table.slice(1)
            ids = head.column("ids")[0].as_py()
            m = norm.of(_numbers(np.frombuffer(head.column("data")[0].as_py(), np.uint8)))
            if not body.num_rows:
                continue
            rows = {c: _column(body, c).to_numpy(zero_copy_only=False)
                    for c in ("count", "last", "max_tf", "min_length", "weight")}
            rows["data"] = _column(body, "data")
            terms = _column(body, "term").to_pylist()
            cuts = [i for i, t in enumerate(terms) if not i or terms[i - 1] != t] + [len(terms)]
            lists = {terms[i]: _List(rows, slice(i, j), norm) for i, j in zip(cuts, cuts[1:])}
            for number, asked in queries.value:
                here = [(times, lists[t]) for t, times in asked if t in lists]
                here = [x for x in here if x[1].best]
                if not here:
                    continue
                held = best.get(number, [])
                least = -held[-1][0] if len(held) == k else 1
                docs, scores = _best(here, m, k, least)
                if len(docs):
                    top = np.lexsort((docs, -scores))[:k]
                    new = [(-s, ids[d] is None, ids[d]) for d, s in zip(docs[top].tolist(), scores[top].tolist())]
                    best[number] = sorted(held + new, key=lambda x: (x[0], x[1], 0 if x[1] else x[2]))[:k]
        flat = [(number, x[2], -x[0]) for number, held in best.items() for x in held]
        for i in range(0, len(flat), EMIT_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(
                zip(*flat[i:i + EMIT_ROWS]), arrow)], schema=arrow)
    return run


def search(index: DataFrame, queries: DataFrame, k: int = 20, key: str = "item_id",
           text: str = "text", id_name: str = "doc_id") -> DataFrame:
    """The k best documents of every row of ``queries``: its ``key``, rank (from 1),
    the document's id and score (above 0)."""
    spark = index.sparkSession
    kind = index.schema["ids"].dataType.elementType
    numbered = queries.select(F.monotonically_increasing_id().alias("query"), F.col(f"`{key}`").alias("key"),
                              F.col(f"`{text}`").alias("text"))
    asked = (numbered.select("query", "key", F.explode(terms_of(F.col("text"))).alias("term"))
             .groupBy("query", "key", "term").agg(F.count(F.lit(1)).alias("times")))
    asked = written(asked, "search-queries")
    total = index.filter("term is null").agg(F.sum("count"), F.sum("last")).first()
    documents, terms = total[0] or 0, total[1] or 0
    blocks = max(1, -(-asked.count() // QUERY_TERMS))
    norm = _Norm(documents, max(1, terms))
    schema = T.StructType().add("query", "long").add("id", kind).add("score", "long")
    arrow = pa.schema([("query", pa.int64()), ("id", to_arrow_type(kind)), ("score", pa.int64())])
    parts = []
    for block in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block)
        # at most about QUERY_TERMS rows, so both are small enough to broadcast
        wanted = F.broadcast(mine.select("term").distinct())
        weights = written(index.filter("term is not null").join(wanted, "term").groupBy("term").agg(
            F.floor(F.lit(1000.0) * F.log((2.0 * F.lit(documents) + 2.0) / (2.0 * F.sum("count") + 1.0)))
            .alias("weight")), "search-weights")
        postings = index.filter("term is not null").join(F.broadcast(weights), "term").select(
            *index.columns, "weight")
        heads = index.filter("term is null").withColumn("weight", F.lit(0).cast("long"))
        dealt = (heads.unionByName(postings).repartition("shard")
                 .sortWithinPartitions("shard", F.col("term").asc_nulls_first(), "block"))
        lists: dict[int, list] = {}
        for row in mine.toLocalIterator():
            lists.setdefault(row["query"], []).append((bytes(row["term"]), row["times"]))
        sent = spark.sparkContext.broadcast(sorted(lists.items()))
        parts.append(dealt.mapInArrow(_searcher(sent, norm, k, arrow), schema))
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    by_rank = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") <= k)
    return ranked.join(asked.select("query", "key").distinct(), "query").select(
        F.col("key").alias(key), "rank", F.col("id").alias(id_name), "score")
