"""A sample of exactly n rows: those of the smallest seeded hashes of their key.

The hash (128 bits, in hex) is the same on every engine and partitioning.  A histogram
over its leading digits tells in which bin the n-th smallest hash lies; the bin is
counted again by its next digits until few hashes are left, and a top-k over these gives
the hash at the cut.  Only counts move: the sample itself is a filter on the table, and
rows that share the cut's hash are limited to as many as are missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = 4          # hex digits counted at a time: 65,536 bins
FEW = 10_000        # hashes that one top-k may rank


def seeded_hash(key: str | Column, seed: int = 42) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))


def exact_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows of ``df`` (all, if it has no more), without replacement.  A NULL key
    counts as an empty text; of rows that share the key at the cut any may be drawn."""
    if n <= 0:
        return df.limit(0)
    h = seeded_hash(key, seed)
    prefix, missing = "", n                 # the n-th hash begins with prefix; ``missing`` are sought there
    while True:
        inside = df.select(h.alias("h")).filter(F.col("h").startswith(prefix))
        at = len(prefix) + 1
        below = 0
        bins = inside.groupBy(F.substring("h", at, DIGITS).alias("p")).count().orderBy("p").collect()
        for row in bins:
            if below + row["count"] >= missing:
                break
            below += row["count"]
        else:
            return df                       # no more than n rows
        prefix, missing = prefix + row["p"], missing - below
        if row["count"] <= FEW or len(prefix) == 32:
            break
    inside = df.select(h.alias("h")).filter(F.col("h").startswith(prefix))
    if len(prefix) == 32:
        cut, fewer = prefix, 0
    else:
        smallest = inside.orderBy("h").limit(missing)
        cut = smallest.agg(F.max("h")).first()[0]
        fewer = inside.filter(F.col("h") < cut).count()
    return df.filter(h < cut).unionByName(df.filter(h == cut).limit(missing - fewer))
