"""Raw meter export -> clean readings (D2).

One lazy plan: drop the index column, map alternative column names, parse
``Date`` + ``Time``, type every measure with ``try_cast`` (text such as '?'
becomes NULL), fill missing values (0.0 for power and sub-meters, 230 V for
voltage, the column mean for current and reactive power) and project the
canonical columns.  The column means are scalar subqueries: Spark runs one
partial/final aggregate and folds the value into the projection — no
driver round trip, no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import (DEFAULT_ANCHOR, DEFAULT_VOLTAGE, fill_missing, is_missing,
                                 non_nan, parse_raw_timestamp, to_double)
from ..schemas import CLEAN_NAMES, RAW_ALIASES, RAW_COLUMNS
from ..session import scratch_path

ZERO_FILLED = ["Global_active_power", "Sub_metering_1", "Sub_metering_2", "Sub_metering_3"]
MEAN_FILLED = ["Global_intensity", "Global_reactive_power"]


def drop_index_column(df: DataFrame, name: str = "_c0") -> DataFrame:
    return df.drop(name) if name in df.columns else df


def apply_aliases(df: DataFrame, aliases: dict[str, list[str]] = RAW_ALIASES) -> DataFrame:
    """Rename the first present alternative of every missing expected column."""
    present = set(df.columns)
    renames = {}
    for expected, alternatives in aliases.items():
        if expected in present:
            continue
        for alt in alternatives:
            if alt in present and alt not in renames:
                renames[alt] = expected
                break
    return df.withColumnsRenamed(renames) if renames else df


def typed_readings(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse the timestamp and type every measure; no imputation yet.
    Columns missing from the source become 0.0 (dummy column)."""
    df = apply_aliases(drop_index_column(raw))
    cols = [*(F.col(c) for c in keep)]
    if "Date" in df.columns and "Time" in df.columns:
        cols.append(parse_raw_timestamp("Date", "Time").alias("timestamp"))
    elif "timestamp" in df.columns:
        cols.append(F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))
    else:
        raise ValueError("raw readings need Date and Time columns (or a timestamp)")
    for raw_name in RAW_COLUMNS[2:]:
        if raw_name in df.columns:
            cols.append(to_double(raw_name).alias(raw_name))
        else:
            cols.append(F.lit(0.0).alias(raw_name))
    return df.select(*cols)


def fill_and_project(typed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Missing-value rules and the canonical D2 projection."""
    # one scalar subquery (one aggregate job) returning all means as a struct
    mean_row = typed.agg(F.struct(*[F.coalesce(F.avg(non_nan(c)), F.lit(0.0)).alias(c)
                                    for c in MEAN_FILLED])).scalar()
    means = {c: mean_row.getField(c) for c in MEAN_FILLED}
    out = [*(F.col(c) for c in keep), F.col("timestamp")]
    for raw_name, clean_name in CLEAN_NAMES.items():
        if raw_name in ZERO_FILLED:
            value = fill_missing(raw_name, 0.0)
        elif raw_name == "Voltage":
            value = fill_missing(raw_name, DEFAULT_VOLTAGE)
        else:
            value = F.when(is_missing(raw_name), means[raw_name]).otherwise(F.col(raw_name))
        out.append(value.alias(clean_name))
    return typed.select(*out)


FILE_POSITION = ("_file", "_block", "_row")


def with_file_position(raw: DataFrame) -> DataFrame:
    """Adds where a scanned row stands: its file, the offset of its block in
    the file, and a number that grows in reading order within the block.
    Only directly on a file scan."""
    return raw.select("*", F.col("_metadata.file_path").alias("_file"),
                      F.col("_metadata.file_block_start").alias("_block"),
                      F.monotonically_increasing_id().alias("_row"))


def clean(raw: DataFrame, keep: tuple[str, ...] = (), order_by: str | None = None,
          impute_step_minutes: int | None = None, file_order: bool = False) -> DataFrame:
    """Full cleaning.  With ``impute_step_minutes`` and either ``order_by`` or
    ``file_order`` (``raw`` as of :func:`with_file_position`), NULL timestamps
    are imputed from the first valid one (see :func:`impute_timestamps`)."""
    if file_order:
        carry = tuple(keep) + FILE_POSITION
    else:
        carry = tuple(keep) + ((order_by,) if order_by and order_by not in keep else ())
    typed = typed_readings(raw, carry)
    if impute_step_minutes and (order_by or file_order):
        typed = impute_timestamps(typed, None if file_order else order_by, impute_step_minutes).drop(
            "row_index", "was_imputed")
    return fill_and_project(typed, keep)


def _numbered(placed: DataFrame, blocks: DataFrame, keys: list[str], position: Column,
              name: str) -> DataFrame:
    """``placed`` plus its row index: the offset of its block (one row per
    block in ``blocks``: ``keys``, ``_n``, and ``_least``, the smallest position
    in it) plus its position in the block.  A block is a file split or a written
    partition, so the broadcast side has one row per tens of megabytes of input."""
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(*keys, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_least"))
                            .alias("_shift"))
    return (placed.join(F.broadcast(offsets), keys)
            .withColumn(name, position + F.col("_shift")).drop("_shift"))


def file_index(df: DataFrame, name: str = "row_index") -> DataFrame:
    """0-based position of every row in file order (path, then offset), for
    rows as of :func:`with_file_position`.  Rows are not moved: only one count
    per file block is aggregated."""
    blocks = df.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_least"))
    return _numbered(df, blocks, ["_file", "_block"], F.col("_row"), name)


def dense_index(df: DataFrame, order_col: str, name: str = "row_index",
                tie_breaker: tuple[str, ...] | None = None) -> DataFrame:
    """0-based dense position of every row in ``order_col`` order, on the
    column's own type: NULL keys last, ties by ``tie_breaker`` (default: all
    other columns), rows that are equal in every column in any order.

    The rows are range-sorted once (a last key, the row's number, lets even
    equal rows be split between tasks) and written to the shared folder; the
    written partitions are the blocks whose counts give the offsets."""
    if tie_breaker is None:
        tie_breaker = tuple(c for c, t in df.dtypes if c != order_col and not t.startswith("map"))
    path = scratch_path(df.sparkSession, "row-index")
    (df.withColumn("_row", F.monotonically_increasing_id())
     .orderBy(F.col(order_col).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_breaker], "_row")
     .withColumn("_row", F.monotonically_increasing_id())     # now in the new order
     .write.parquet(path))
    done = df.sparkSession.read.schema(df.withColumn("_row", F.lit(0).cast("long")).schema).parquet(path)
    done = done.withColumn("_part", F.shiftright("_row", 33))
    blocks = done.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_least"))
    return _numbered(done, blocks, ["_part"], F.col("_row"), name).drop("_row", "_part")


OVERSAMPLE = 20      # sampled rows a bucket


def _order_key(columns) -> Column:
    """A struct that compares as the columns do, NULLs last."""
    return F.struct(*[x for i, c in enumerate(columns)
                      for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))])


def _bounds(df: DataFrame, key: Column, buckets: int) -> tuple[Column, bool]:
    """(bounds of about equal buckets, whether they all differ), from a sample of
    OVERSAMPLE rows a bucket.  The bounds are a constant array (at most one a bucket), so
    every pass sees the same ones."""
    sample = df.select(key.alias("k")).orderBy(F.rand(7)).limit(OVERSAMPLE * buckets)
    every = F.sort_array(F.collect_list("k"))
    picked = F.filter(F.col("s"), lambda x, i: (i % OVERSAMPLE == OVERSAMPLE - 1))
    b = sample.agg(every.alias("s")).select(picked.alias("b"))
    row = b.select(F.to_json("b").alias("json"), (F.size("b") == F.size(F.array_distinct("b"))).alias("differ")).first()
    return F.from_json(F.lit(row["json"]), b.schema["b"].dataType.simpleString()), row["differ"]


def _bucket(key: Column, b: Column, buckets: int) -> Column:
    """How many bounds are not above the key, by binary search in the array of bounds."""
    steps = F.array(*[F.lit(1 << k) for k in range(buckets.bit_length(), -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= F.size(b)) & (F.get(b, at + step - 1) <= key), at + step).otherwise(at))


def bucket_index(df: DataFrame, order_col: str, name: str = "row_index",
                 tie_breaker: tuple[str, ...] | None = None, buckets: int | None = None) -> DataFrame:
    """The same index as :func:`dense_index`, without a written copy of the table.

    Sampled bounds cut the order into buckets of about equal size (by default as many as
    shuffle partitions); one partial aggregate counts each bucket; each row moves once, to
    its bucket, and is numbered there.  Where a value of ``order_col`` fills a bucket or
    more, the bounds take in the tie breakers, which part its rows; where rows that are
    equal in all of these still fill one, the sort of ``dense_index`` splits them.  The
    sample (and its bounds) grows with the buckets, not with the table."""
    if tie_breaker is None:
        tie_breaker = tuple(c for c, t in df.dtypes if c != order_col and not t.startswith("map"))
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for columns in ((order_col,), (order_col, *tie_breaker)):
        bounds, differ = _bounds(df, _order_key(columns), buckets)
        if differ:
            break
    else:
        return dense_index(df, order_col, name, tie_breaker)
    placed = df.withColumn("_bucket", _bucket(_order_key(columns), bounds, buckets))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_bucket").count()
               .select("_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before")))
    inside = Window.partitionBy("_bucket").orderBy(*[F.col(c).asc_nulls_last() for c in (order_col, *tie_breaker)])
    return (placed.withColumn(name, F.row_number().over(inside) - 1)
            .join(F.broadcast(offsets), "_bucket")          # a row a bucket
            .withColumn(name, F.col(name) + F.col("_before")).drop("_bucket", "_before"))


def _anchor(typed: DataFrame, columns, ts: str) -> tuple[Column, Column]:
    """Time and index of the first row in the columns' order that has a time: the index
    is a count of the rows before it, so nothing is sorted for it.  Where no other row has
    its value of the first column, as with a unique key, only that column is read."""
    key = _order_key(columns[:1])
    least = F.min(F.struct(key.alias("k"), F.col(ts).cast("string").alias("ts")))
    timed = typed.filter(F.col(ts).isNotNull()).agg(least.alias("f"))
    k0 = timed.scalar().getField("k")
    row = typed.agg(F.count_if(key < k0).alias("before"), F.count_if(key == k0).alias("n")).first()
    if row["n"] == 1:
        return F.lit(timed.first()["f"]["ts"]).cast("timestamp_ntz"), F.lit(row["before"])
    key = _order_key(columns)
    first = (typed.filter(F.col(ts).isNotNull())
             .agg(F.min(F.struct(key.alias("k"), F.col(ts).alias("ts"))).alias("f")).scalar())
    at = typed.agg(F.count_if(key < first.getField("k"))).scalar()
    return first.getField("ts"), at


def impute_timestamps(typed: DataFrame, order_col: str | None, step_minutes: int = 1,
                      ts: str = "timestamp", tie_breaker: tuple[str, ...] | None = None) -> DataFrame:
    """Fill every NULL timestamp with anchor + (row_index - anchor_index) *
    step, the anchor being the first row (in ``order_col`` order, or in file
    order without one) with a valid timestamp; default anchor 2006-12-16
    17:24:00 at index 0."""
    if order_col is None:
        idx = file_index(typed).drop(*FILE_POSITION)
        anchor = (idx.filter(F.col(ts).isNotNull())
                  .agg(F.min_by(F.struct(F.col(ts).alias("ts"), F.col("row_index").alias("at")), "row_index"))
                  .scalar())
        time, at = anchor.getField("ts"), anchor.getField("at")
    else:
        if tie_breaker is None:
            tie_breaker = tuple(c for c, t in typed.dtypes if c != order_col and not t.startswith("map"))
        idx = bucket_index(typed, order_col, tie_breaker=tie_breaker)
        # rows equal in the order's columns may differ in their times: then the index decides
        if set(typed.columns) == {order_col, *tie_breaker}:
            time, at = _anchor(typed, (order_col, *tie_breaker), ts)
        else:
            anchor = (idx.filter(F.col(ts).isNotNull())
                      .agg(F.min_by(F.struct(F.col(ts).alias("ts"), F.col("row_index").alias("at")), "row_index"))
                      .scalar())
            time, at = anchor.getField("ts"), anchor.getField("at")
    anchor_ts = F.coalesce(time, F.lit(DEFAULT_ANCHOR).cast("timestamp_ntz"))
    offset = (F.col("row_index") - F.when(time.isNotNull(), at).otherwise(F.lit(0))) * F.lit(step_minutes)
    filled = F.timestamp_add("MINUTE", offset, anchor_ts)
    return idx.withColumns({
        "was_imputed": F.col(ts).isNull(),
        ts: F.coalesce(F.col(ts), filled),
    })
