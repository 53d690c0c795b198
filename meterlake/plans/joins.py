"""Join helpers that make the broadcast decision explicit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

# Measured bytes up to which a lookup table is broadcast.
BROADCAST_BYTES = 64 << 20


def table_bytes(df: DataFrame) -> int:
    """Upper estimate of a flat table's bytes in memory: one aggregate over it."""
    text = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c, t in df.dtypes if t in ("string", "binary")]
    total = df.agg(F.count(F.lit(1)).alias("n"), *[c.alias(f"t{i}") for i, c in enumerate(text)]).first()
    return total["n"] * (32 + 16 * len(df.columns)) + sum(total[f"t{i}"] for i in range(len(text)))


def kept_lookup(small: DataFrame, name: str) -> DataFrame:
    """A lookup table that is derived from the data, written once to the shared
    folder, so that its size can be measured before anything is joined with it."""
    path = scratch_path(small.sparkSession, name)
    small.write.parquet(path)
    return small.sparkSession.read.schema(small.schema).parquet(path)


def measured_join(big: DataFrame, kept: DataFrame, on, how: str = "inner",
                  limit: int | None = None) -> DataFrame:
    """Join with a written lookup table: broadcast if its measured size allows, so
    that ``big`` is not shuffled by a skewed key; else a shuffle join, whose skewed
    keys adaptive execution splits."""
    fits = table_bytes(kept) <= (BROADCAST_BYTES if limit is None else limit)
    return big.join(F.broadcast(kept) if fits else kept, on, how)


def lookup_join(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with a side whose size depends on the data (e.g. per-device
    statistics).  No hint and no job while the query is built: adaptive
    execution broadcasts the side if its measured bytes allow it, and splits
    skewed keys of the shuffle join otherwise."""
    return big.join(small, on, how)
