"""Near-duplicates by a signature-coordinate inverted join.

A text's set is that of its distinct 5-word shingles (words ``[^\\x20\\x09-\\x0D]+``
after A-Z are lower-cased; with fewer words the whole sequence is the one
shingle; without words the set is empty and linked with nothing).  Texts are
linked if 100 * intersection >= 75 * union, and documents reachable over links
form a component.

1. Equal sets are one class; classes are the nodes from here on.
2. Each class gets a MinHash signature of COORDINATES values and is posted
   under every (coordinate, value) that another class shares.
3. Two classes match if they collide on MATCHES coordinates or more.  So only
   the COORDINATES - MATCHES + 1 rarest postings of a class are probed (prefix);
   the long lists beyond them are skipped and looked up in the signatures of
   the candidates alone.  At a similarity of 0.75 the chance of fewer than
   MATCHES of COORDINATES collisions is under 4e-5.
4. Posting lists are not expanded into all pairs.  In each list the class whose
   postings are the most common (the likely original of a group of copies) is
   paired with the others, pairs are confirmed on full sets, and components are
   formed.
5. What is left are lists that hold several components.  A class of which more
   than a quarter of the shingles are in no other of their classes cannot be
   linked; of the rest, pairs of different components are formed in the list of
   their least common value if their sizes, without such shingles of their own,
   allow a link (both bounds are exact) and their sketches of SKETCH values
   collide on SKETCH_MATCHES or more (missed with a chance under 1e-5 at a
   similarity of 0.75).  These are confirmed on full sets as well.

Pairs that are left out are inside one component already, cannot be linked, or
are below the match threshold.  Null texts have no words.  Rows that repeat id
and text are one class like all equal texts; null ids take part but are never
the smallest id of a component that has another.  An empty table gives an empty
table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_column, slices, written
from .components import components

WORDS = 5
COORDINATES = 32
MATCHES = 14
SKETCH, SKETCH_MATCHES = 1024, 726   # four bits a value, so 1 in 16 collides by chance
MEMBERS = 500            # members that are compared with one copy of a leader's text
MEMO_SIZE = 100_000
PREFIX = COORDINATES - MATCHES + 1

_RNG = np.random.default_rng(20240229)
_FACTORS = (_RNG.integers(1 << 62, size=(COORDINATES, 1)).astype("u8") << np.uint64(1)) | np.uint64(1)
_TERMS = _RNG.integers(1 << 63, size=(COORDINATES, 1)).astype("u8")
_SKETCH_FACTORS = (_RNG.integers(1 << 62, size=(SKETCH, 1)).astype("u8") << np.uint64(1)) | np.uint64(1)
_SKETCH_TERMS = _RNG.integers(1 << 63, size=(SKETCH, 1)).astype("u8")
_STEPS = (_RNG.integers(1 << 62, size=WORDS).astype("u8") << np.uint64(1)) | np.uint64(1)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_SIZE:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


def shingle_set(text: str | None, memo: _Hashes) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct shingles."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, "u8")
    h = np.fromiter(map(memo.__getitem__, words), "u8", len(words))
    n = max(1, len(h) - WORDS + 1)
    out = np.full(n, min(len(h), WORDS), "u8")
    for j in range(min(len(h), WORDS)):
        out = (out ^ h[j:j + n]) * _STEPS[j]
        out ^= out >> np.uint64(32)
    return np.unique(out)


def _minima(s: np.ndarray, factors: np.ndarray, terms: np.ndarray) -> np.ndarray:
    out = np.full((len(factors), 1), np.iinfo("u8").max, "u8")
    for i in range(0, len(s), 1 << 12):
        block = s[i:i + (1 << 12)] * factors + terms
        out = np.minimum(out, block.min(axis=1, keepdims=True))
    return out[:, 0]


def _signature(s: np.ndarray) -> np.ndarray:
    return _minima(s, _FACTORS, _TERMS)


def _sketch(s: np.ndarray) -> np.ndarray:
    """SKETCH values of four bits, sixteen to a word."""
    bits = (_minima(s, _SKETCH_FACTORS, _SKETCH_TERMS) * _STEPS[0]) >> np.uint64(60)
    shifts = np.arange(16, dtype="u8") * np.uint64(4)
    return np.bitwise_or.reduce(bits.reshape(-1, 16) << shifts, axis=1).view("i8")


def signatures(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` plus n_shingles, the set's 128-bit digest (k1, k2; null for the
    empty set) and its signature."""
    def make():
        memo = _Hashes()

        def one(t):
            s = shingle_set(t, memo)
            if not len(s):
                return 0, None, None, None
            k = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "i8")
            return len(s), int(k[0]), int(k[1]), _signature(s).view("i8")
        return lambda texts: list(zip(*map(one, texts)))

    return map_column(docs, text, make, [("n_shingles", "long"), ("k1", "long"), ("k2", "long"),
                                         ("signature", "array<long>")])


def postings(classes: DataFrame) -> DataFrame:
    """(value, node, common): the prefix postings of each class.  ``common`` is
    the number of classes posted under its values altogether."""
    every = classes.select("node", F.explode("signature").alias("value"))
    shared = every.groupBy("value").count().filter("count > 1")
    lists = (every.join(shared, "value").groupBy("node")
             .agg(F.sort_array(F.collect_list(F.struct("count", "value"))).alias("p"),
                  F.sum("count").alias("common")))
    # values of no other class come first in the order of rarity
    left = F.greatest(F.lit(0), F.lit(PREFIX - COORDINATES) + F.size("p"))
    return (lists.select("node", "common", F.explode(F.slice("p", F.lit(1), left)).alias("x"))
            .select("x.value", "node", "common"))


def _matching(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) that collide on MATCHES coordinates or more."""
    sides = [classes.select(F.col("node").alias(s), F.col("signature").alias(f"s{s}")) for s in "ab"]
    joined = pairs.join(sides[0], "a").join(sides[1], "b")
    equal = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda x: x))
    return joined.filter(equal >= MATCHES).select("a", "b")


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough.  The text of ``a`` goes
    to every MEMBERS of its pairs once, each ``b`` goes to its pair."""
    parts = pairs.groupBy("a").count().select("a", F.ceil(F.col("count") / MEMBERS).alias("parts"))
    dealt = written(pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts"))
                                                  .alias("part")), "dealt")
    lead = dealt.select("a", "part").distinct()
    rows = (lead.join(texts.withColumnRenamed("node", "a"), "a")
            .select("a", "part", F.lit(None).cast("long").alias("b"), "text")
            .unionByName(dealt.join(texts.withColumnRenamed("node", "b"), "b")
                         .select("a", "part", "b", "text")))

    def run(batches):
        memo, key, head = _Hashes(), None, None
        for batch in batches:
            for part in slices(batch, 3):
                a_out, b_out = [], []
                for a, p, b, text in zip(*(c.to_pylist() for c in part.columns)):
                    s = shingle_set(text, memo)
                    if b is None:
                        key, head = (a, p), s
                    elif key == (a, p):
                        both = len(np.intersect1d(head, s, assume_unique=True))
                        if 100 * both >= 75 * (len(head) + len(s) - both):
                            a_out.append(a)
                            b_out.append(b)
                yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())],
                                                 ["a", "b"])

    return (rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
            .mapInArrow(run, "a long, b long"))


def _profiles(texts: DataFrame) -> DataFrame:
    """(node, n, own, sketch): set size, shingles in no other of these texts,
    and sketch.  Classes that cannot be linked with another are left out."""
    def make():
        memo = _Hashes()

        def work(values):
            sets = [shingle_set(t, memo) for t in values]
            return [[len(s) for s in sets], [_sketch(s) for s in sets], [s.view("i8") for s in sets]]
        return work

    made = map_column(texts, "text", make, [("n", "long"), ("sketch", "array<long>"),
                                            ("shingles", "array<long>")])
    own = (made.select("node", F.explode("shingles").alias("s")).groupBy("s")
           .agg(F.count(F.lit(1)).alias("k"), F.min("node").alias("node")).filter("k = 1")
           .groupBy("node").agg(F.count(F.lit(1)).alias("own")))
    return (made.select("node", "n", "sketch").join(own, "node", "left")
            .withColumn("own", F.coalesce("own", F.lit(0))).filter("4 * own <= n"))


def _collisions(x, y):
    """Values in which two sketches agree."""
    def differing(a, b):
        d = a.bitwiseXOR(b)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        return F.bit_count(d.bitwiseAND(F.lit(0x1111111111111111)))
    return SKETCH - F.aggregate(F.zip_with(x, y, differing), F.lit(0), lambda s, v: s + v)


def _rest(lists: DataFrame, profiles: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components that are worth confirming, each once."""
    every = lists.groupBy("node").agg(F.sort_array(F.collect_list("value")).alias("values"))
    rows = lists.select("value", "node", "c").join(profiles, "node").join(every, "node")
    sides = [rows.select("value", *[F.col(x).alias(x + s) for x in ("node", "c", "n", "own", "sketch", "values")])
             for s in "ab"]
    cheap = ((F.col("nodea") < F.col("nodeb")) & (F.col("ca") != F.col("cb"))
             & (7 * F.least(F.col("na") - F.col("owna"), F.col("nb") - F.col("ownb"))
                >= 3 * (F.col("na") + F.col("nb"))))
    value, one, two = sides[0]["value"], F.col("valuesa"), F.col("valuesb")
    here = F.when(F.get(one, F.lit(0)) == F.get(two, F.lit(0)), value == F.get(one, F.lit(0))).otherwise(
        value == F.array_min(F.array_intersect(one, two)))      # the least common value
    match = F.when(cheap, F.when(here, _collisions(F.col("sketcha"), F.col("sketchb")) >= SKETCH_MATCHES))
    joined = sides[0].join(sides[1], (value == sides[1]["value"]) & match)
    return joined.select(F.col("nodea").alias("a"), F.col("nodeb").alias("b"))


def links(classes: DataFrame, posted: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, component) of the classes linked with another one."""
    heads = (posted.groupBy("value").agg(F.max(F.struct("common", "node")).alias("h"))
             .select("value", F.col("h.node").alias("a")))
    pairs = (posted.join(heads, "value").select("a", F.col("node").alias("b"))
             .filter("a <> b").distinct())
    tried = written(_matching(pairs, classes), "pairs")
    found = written(_confirmed(tried, texts), "links")
    labels = components(found)

    lists = (posted.join(labels.withColumnRenamed("component", "c"), "node", "left")
             .withColumn("c", F.coalesce("c", "node")))
    mixed = (lists.groupBy("value").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
             .filter("lo <> hi").select("value"))
    lists = written(lists.join(mixed, "value"), "lists")
    if lists.isEmpty():
        return labels
    left = texts.join(lists.select("node").distinct(), "node", "left_semi")
    pairs = written(_rest(lists, written(_profiles(left), "profiles")), "pairs")
    more = written(_confirmed(pairs, texts), "links")
    return labels if more.isEmpty() else components(found.unionByName(more))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, ``text_hash``, n_shingles, component_id
    (smallest id reachable) and ``kept_hash`` (the text_hash of the row that
    stands for the component: the smallest of that id)."""
    source = docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("text_hash"),
                         F.col(text).alias("text"))
    signed = written(signatures(source, "text").drop("text"), "signatures")
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "text_hash"))
    classes = (signed.filter("n_shingles > 0").groupBy("k1", "k2")
               .agg(first.alias("first"), F.any_value("signature").alias("signature"))
               .withColumn("node", F.monotonically_increasing_id()))
    classes = written(classes, "classes")   # ids are fixed from here on
    posted = written(postings(classes), "postings")
    wanted = (classes.join(posted.select("node").distinct(), "node", "left_semi")
              .select("node", F.col("first.id").alias("i"), F.col("first.text_hash").alias("h")))
    texts = written(source.join(wanted.hint("shuffle_hash"),
                                (F.col("text_hash") == F.col("h")) & F.col("id").eqNullSafe(F.col("i")))
                    .select("node", "text"), "texts")
    labels = links(classes, posted, texts)
    grouped = (classes.join(labels, "node", "left")
               .select("k1", "k2", "first", F.coalesce("component", "node").alias("component")))
    heads = grouped.groupBy("component").agg(F.min("first").alias("head"))
    by_class = grouped.join(heads, "component").select("k1", "k2", "head")
    out = signed.drop("signature").join(by_class, ["k1", "k2"], "left")
    return out.select(
        F.col("id").alias(doc_id), "text_hash", "n_shingles",
        F.when(F.col("head").isNull(), F.col("id")).otherwise(F.col("head.id")).alias("component_id"),
        F.when(F.col("head").isNull(), F.col("text_hash")).otherwise(F.col("head.text_hash"))
        .alias("kept_hash"))


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id (of
    rows that repeat it, one with the smallest text hash); rows without words
    all stay."""
    found = written(near_duplicates(docs, doc_id, text), "components")
    heads = (found.filter("n_shingles > 0").groupBy("component_id", "kept_hash").agg(F.count(F.lit(1)).alias("n"))
             .select(F.col("component_id").alias("__i"), F.col("kept_hash").alias("__h"), F.lit(True).alias("__head")))
    rows = docs.withColumn("__hash", F.xxhash64(F.col(text))).withColumn(
        "__words", F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    joined = rows.join(heads.hint("shuffle_hash"), F.col(doc_id).eqNullSafe(F.col("__i"))
                       & (F.col("__hash") == F.col("__h")), "left")
    kept = joined.filter(F.col("__head") | ~F.col("__words"))
    repeated = (found.filter("n_shingles > 0").groupBy(doc_id, "text_hash").count().filter("count > 1"))
    if not repeated.isEmpty():      # rows that repeat id and text: one of them
        alone = F.when(F.col("__words"), F.lit(0)).otherwise(F.monotonically_increasing_id() + 1)
        kept = kept.withColumn("__alone", alone).dropDuplicates([doc_id, "__hash", "__alone"])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
