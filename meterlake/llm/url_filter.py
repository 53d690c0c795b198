"""URL filtering with rules and an exact Bloom filter cascade.

The cascade stores a set of listed keys relative to the corpus's complete key
universe.  Level 0 is a Bloom filter of the listed keys; level 1 holds the
unlisted keys that pass level 0, level 2 the listed keys that pass level 1,
and so on until a level lets nothing wrong through.  A key's membership is
decided by the first level that rejects it, without error for every key of the
universe, so pages are judged without a join.

Each level's bits are set by Spark (bit positions, OR-ed by 64-bit word with
partial aggregation) and reach the driver packed, many words to a row.  Keys
are dealt to shards by hash; a shard's filters are small by construction, and
shards are broadcast in blocks of at most BLOCK_BYTES, each block judging the
pages of its own shards.

Null urls have empty host and path.  Repeated urls get equal verdicts.  An
empty list blocks nothing; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

KEYS_PER_SHARD = 4_000_000   # listed keys a shard
BLOCK_BYTES = 64 << 20       # filter bits broadcast at once
PULL_BYTES = 16 << 20        # filter words the driver takes at once
FIRST_BITS, NEXT_BITS = 12, 3  # bits a key on level 0 and beyond
FIRST_HASHES, NEXT_HASHES = 8, 2
MAX_LEVELS = 64

# (verdict, host, path)
Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                      F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in reversed(ordered):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit(1)).alias("h2")]


def _positions(m: int, hashes: int, level: int, h1: np.ndarray, h2: np.ndarray):
    """A key's bit positions in a filter of ``m`` bits (a power of two); every
    level mixes the two hashes anew, so keys that collide on one level part on
    a later one."""
    h1, h2 = h1.view("u8"), h2.view("u8")
    for i in range(hashes):
        x = h1 + h2 * np.uint64(2 * (level * 16 + i) + 1)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        yield (x ^ (x >> np.uint64(33))) & np.uint64(m - 1)


def _passes(bits: np.ndarray, m: int, hashes: int, level: int, h1, h2) -> np.ndarray:
    """Which keys a level's filter lets through."""
    ok = np.ones(len(h1), bool)
    for at in _positions(m, hashes, level, h1, h2):
        ok &= (bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return ok


def _bits(n: int, per_key: int) -> int:
    """A power of two of at least ``per_key`` bits a key, and a word."""
    return max(64, 1 << (max(1, n * per_key) - 1).bit_length())


class Cascade:
    """levels[shard] = [(bits, m, hashes), ...]"""

    def __init__(self, shards: int, levels: list[list[tuple[np.ndarray, int, int]]]):
        self.shards, self.levels = shards, levels

    def blocks(self) -> list[dict[int, list]]:
        out, size = [{}], 0
        for s, filters in enumerate(self.levels):
            own = sum(b.nbytes for b, _, _ in filters)
            if out[-1] and size + own > BLOCK_BYTES:
                out.append({})
                size = 0
            out[-1][s] = filters
            size += own
        return out


def _walk(filters: list, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Membership: the first level that rejects a key decides."""
    listed = np.zeros(len(h1), bool)
    left = np.arange(len(h1))
    for level, (bits, m, hashes) in enumerate(filters):
        ok = _passes(bits, m, hashes, level, h1[left], h2[left])
        listed[left[~ok]] = level % 2 == 1
        left = left[ok]
    listed[left] = len(filters) % 2 == 1
    return listed


def _arrays(batch, names):
    return [batch.column(names.index(c)).to_numpy(zero_copy_only=False)
            for c in ("h1", "h2", "shard")]


def _level(keys: DataFrame, shards: int, counts: dict[int, int], level: int) -> list:
    """One level's filter of every shard, from the (h1, h2, shard) of its keys.
    Tasks OR their own bits first, so a word is shuffled once a task."""
    per_key, hashes = (FIRST_BITS, FIRST_HASHES) if level == 0 else (NEXT_BITS, NEXT_HASHES)
    m = _bits(max(counts.values()), per_key)
    names = keys.columns

    def set_bits(batches):
        for batch in batches:
            h1, h2, shard = _arrays(batch, names)
            for s in np.unique(shard).tolist():
                own = shard == s
                at = np.concatenate(list(_positions(m, hashes, level, h1[own], h2[own])))
                word, place = np.unique(at >> np.uint64(6), return_inverse=True)
                bits = np.zeros(len(word), "u8")
                np.bitwise_or.at(bits, place, np.uint64(1) << (at & np.uint64(63)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(word), s, "i4")), pa.array(word.astype("i8")),
                     pa.array(bits.view("i8"))], ["shard", "word", "bits"])

    def packed(batches):
        for batch in batches:
            shard, word, bits = (batch.column(c).to_numpy() for c in ("shard", "word", "bits"))
            for s in np.unique(shard).tolist():
                own = shard == s
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s], "i4"), pa.array([word[own].astype("<i8").tobytes()], "binary"),
                     pa.array([bits[own].astype("<i8").tobytes()], "binary")], ["shard", "words", "bits"])

    words = (keys.mapInArrow(set_bits, "shard int, word long, bits long")
             .groupBy("shard", "word").agg(F.bit_or("bits").alias("bits")))
    filters = [(np.zeros(m >> 6, "u8"), m, hashes) for _ in range(shards)]
    # the driver takes at most shards * m / 64 words, 16 bytes each, PULL_BYTES at a time:
    # a job for each such part, however many partitions the words are in
    parts = -(-shards * (m >> 2) // PULL_BYTES)
    pulled = words.repartition(parts).mapInArrow(packed, "shard int, words binary, bits binary")
    for s, w, b in pulled.toLocalIterator():
        filters[s][0][np.frombuffer(w, "<i8")] = np.frombuffer(b, "<u8")
    return filters


def _test(df: DataFrame, filters: dict[int, list], verdict, name: str | None) -> DataFrame:
    """``verdict(filters of the shard, h1, h2)`` of every row, as a column
    ``name``, or else as a filter."""
    shared = df.sparkSession.sparkContext.broadcast(filters)
    names = df.columns

    def run(batches):
        for batch in batches:
            h1, h2, shard = _arrays(batch, names)
            out = np.zeros(len(h1), bool)
            for s in np.unique(shard).tolist():
                own = np.flatnonzero(shard == s)
                out[own] = verdict(shared.value[s], h1[own], h2[own])
            yield (batch.filter(pa.array(out)) if name is None else
                   pa.RecordBatch.from_arrays(batch.columns + [pa.array(out)], names + [name]))

    schema = T.StructType(df.schema.fields + ([T.StructField(name, T.BooleanType())] if name else []))
    return df.mapInArrow(run, schema)


def build(universe: DataFrame) -> Cascade:
    """The cascade of ``universe`` (columns ``key`` and ``listed``; a key listed
    in any row is listed), exact for all its keys."""
    keys = (universe.groupBy("key").agg(F.max("listed").alias("listed"))
            .select("listed", *_hashes(F.col("key"))))
    keys = written(keys, "url-keys")
    n_listed = keys.filter("listed").count()
    shards = max(1, -(-n_listed // KEYS_PER_SHARD))
    rest = keys.withColumn("shard", F.pmod(F.shiftright("h2", 20), F.lit(shards)).cast("int"))
    filters: list[list] = [[] for _ in range(shards)]
    wanted = True
    for level in range(MAX_LEVELS):
        group = rest.filter(F.col("listed") == F.lit(wanted))
        counts = {r["shard"]: r["count"] for r in group.groupBy("shard").count().collect()}
        if not counts:
            break
        made = _level(group, shards, counts, level)
        for s in range(shards):
            filters[s].append(made[s])
        # keys of the other side that this level lets through must be told apart by the next
        wrong = _test(rest.filter(F.col("listed") != F.lit(wanted)), dict(enumerate(made)),
                      lambda f, h1, h2, level=level: _passes(*f, level, h1, h2), None)
        rest = written(wrong.unionByName(group), f"url-level{level}")
        wanted = not wanted
    else:
        raise RuntimeError(f"the cascade did not end within {MAX_LEVELS} levels")
    return Cascade(shards, filters)


def judge(pages: DataFrame, cascade: Cascade, key: Column, name: str = "listed") -> DataFrame:
    """``pages`` plus ``name``: whether its key is in the cascade's list."""
    df = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("__row"),
                      *_hashes(key))
    df = df.withColumn("shard", F.pmod(F.shiftright("h2", 20), F.lit(cascade.shards)).cast("int"))
    blocks = cascade.blocks()
    parts = [_test(df.filter(F.col("shard").between(min(b), max(b))) if len(blocks) > 1 else df,
                   b, _walk, "__listed") for b in blocks]
    kept = [c for c in pages.columns if c.lower() != name.lower()]
    return reduce(DataFrame.unionByName, parts).select(
        *[F.col(f"__row.`{c}`").alias(c) for c in kept], F.col("__listed").alias(name))
