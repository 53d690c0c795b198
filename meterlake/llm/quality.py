"""Quality rules: hashed n-gram log-likelihood ratio of each document.

Words ``[^\\x20\\x09-\\x0D]+`` and pairs of neighbouring words are hashed into
buckets.  One multinomial is counted over the trusted documents, one over all
documents; a document's score is the mean over its n-grams of
log(p_trusted / p_raw).  Every document is judged against the same threshold:
the score that all but TRUSTED_MISS of the trusted documents reach that are
not in the target, less MARGIN nats.  The target is fitted on at most TRUSTED_SAMPLE
trusted documents; raw counts and scores use all rows, the threshold every trusted one
outside the target.

Null texts have no words; a document without words fails the base rules.
Equal texts get equal verdicts.  Without trusted documents, fitted and held
out, there is nothing to compare with and only the base rules decide.  An
empty table gives an empty table.  Label rows without id are ignored; an id that
is labelled 0 anywhere is not trusted.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import beside, map_column, slices, small_batches, written

BUCKETS = 1 << 16
TRUSTED_MISS = 0.01
MARGIN = 0.05
SMOOTHING = 1.0
SCORE_STEP = 1e-3
MEMO_SIZE = 100_000
TRUSTED_SAMPLE = 50_000  # labelled documents that the target is fitted on, at most
HELD_OUT = 5
BROADCAST_IDS = 1_000_000
_NONE = np.empty(0, "i8")
_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_SIZE:
            self.clear()
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


def _ngrams(words: list[bytes], hashes: _Hashes) -> np.ndarray:
    """Buckets of the words and of the pairs of neighbours."""
    h = np.array([hashes[w] for w in words], "u8")
    pairs = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
    pairs = (pairs ^ (pairs >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (np.concatenate((h, pairs)) >> np.uint64(48)).astype("i8") & (BUCKETS - 1)


def trusted_ids(labels: DataFrame, doc_id: str = "doc_id", quality: str = "quality") -> tuple[DataFrame, DataFrame]:
    """(target, others): the ids that are labelled quality 1 and never 0.  One in
    HELD_OUT of them stays out of the target, for a document's own n-grams would raise
    its score; of the rest the target has the TRUSTED_SAMPLE ids of the smallest
    hashes.  All others set the threshold."""
    trusted = (labels.filter(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("__id"))
               .agg(F.min(quality).alias("q")).filter("q = 1").select("__id"))
    target = written(trusted.filter(F.pmod(F.xxhash64("__id", F.lit(1)), F.lit(HELD_OUT)) != 0)
                     .orderBy(F.xxhash64("__id"), "__id").limit(TRUSTED_SAMPLE), "quality-target")
    return target, written(trusted.join(F.broadcast(target), "__id", "left_anti"), "quality-others")


def count_ngrams(df: DataFrame, text: str = "text", trusted: str = "trusted") -> DataFrame:
    """(bucket, raw, target): n-gram counts over all rows and over those where
    ``trusted`` holds.  Each task sends one count a bucket."""
    source = df.select(F.col(text).alias("t"), F.coalesce(F.col(trusted), F.lit(False)).alias("k"))

    small_batches(df.sparkSession)

    def run(batches):
        hashes = _Hashes()
        raw, target = np.zeros(BUCKETS, "i8"), np.zeros(BUCKETS, "i8")
        for batch in batches:
            for part in slices(batch, 0):
                every, good = [_NONE], [_NONE]
                for t, k in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words = t.encode().split() if t else []
                    if words:
                        every.append(_ngrams(words, hashes))
                        if k:
                            good.append(every[-1])
                raw += np.bincount(np.concatenate(every), minlength=BUCKETS)
                target += np.bincount(np.concatenate(good), minlength=BUCKETS)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(raw[at]), pa.array(target[at])], ["bucket", "raw", "target"])

    return (source.mapInArrow(run, "bucket long, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))


def log_ratios(counts: DataFrame) -> np.ndarray | None:
    """log(p_target / p_raw) by bucket (BUCKETS numbers on the driver), or None
    if there is no target."""
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for b, r, t in counts.collect():  # at most BUCKETS rows
        raw[b], target[b] = r, t
    if not target.sum():
        return None
    # the raw corpus is the prior of the target, so a bucket never seen in a
    # small target does not count as evidence against it beyond its weight
    p_raw = (raw + SMOOTHING) / (raw.sum() + SMOOTHING * BUCKETS)
    p_target = (target + SMOOTHING * BUCKETS * p_raw) / (target.sum() + SMOOTHING * BUCKETS)
    return np.log(p_target) - np.log(p_raw)


def measures(df: DataFrame, ratios: np.ndarray | None, text: str = "text") -> DataFrame:
    """``df`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
    and score (null without words or target)."""
    shared = df.sparkSession.sparkContext.broadcast(ratios)

    def make():
        hashes, weight = _Hashes(), shared.value

        def one(t):
            words = t.encode().split() if t else []
            if not words:
                return 0, 0, sum(map(t.count, _SYMBOLS)) if t else 0, 0, 0, None
            lines = [x for x in t.encode().split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
            windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
            seen = Counter(windows)
            repeated = 0
            if len(seen) < len(windows):
                mark = bytearray(len(words))
                for i, w in enumerate(windows):
                    if seen[w] > 1:
                        mark[i:i + 5] = b"\1\1\1\1\1"
                repeated = sum(mark)
            score = None if weight is None else float(weight[_ngrams(words, hashes)].mean())
            return (len(words), len(t) - sum(map(t.count, _SPACES)), sum(map(t.count, _SYMBOLS)),
                    len(lines) - len(set(lines)), repeated, score)

        return lambda texts: list(zip(*map(one, texts)))

    return map_column(df, text, make, [
        ("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"),
        ("n_dup_lines", "long"), ("n_repeat_words", "long"), ("score", "double")])


def threshold(scored: DataFrame, score: str = "score") -> float | None:
    """The score all but TRUSTED_MISS of the (trusted) rows reach, less MARGIN.
    Scores are counted in steps of SCORE_STEP, so the result does not depend
    on how rows are dealt out, and the driver gets one row a step."""
    steps = (scored.filter(F.col(score).isNotNull())
             .groupBy(F.floor(F.col(score) / SCORE_STEP).alias("step")).count()
             .orderBy("step").collect())
    allowed = TRUSTED_MISS * sum(r["count"] for r in steps)
    below = 0
    for r in steps:
        below += r["count"]
        if below > allowed:
            return r["step"] * SCORE_STEP - MARGIN
    return None


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          quality: str = "quality") -> DataFrame:
    """``docs`` (text beside a struct ``__row`` of its other columns) plus the
    measures, score, base_failed and kept."""
    target, others = trusted_ids(labels, doc_id, quality)
    texts = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("t"))
    fitted = F.broadcast(target.withColumn("trusted", F.lit(True)))     # TRUSTED_SAMPLE rows at most
    ratios = log_ratios(count_ngrams(texts.join(fitted, "__id", "left"), "t"))
    if ratios is None:
        cut = None
    else:
        few = others.count() <= BROADCAST_IDS       # else a shuffle join
        held_out = texts.join(F.broadcast(others) if few else others, "__id", "left_semi")
        cut = threshold(measures(held_out, ratios, "t"))
    rows = measures(beside(docs, text), ratios, text)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    good = F.lit(True) if cut is None else F.coalesce(F.col("score") >= cut, F.lit(True))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & good)
