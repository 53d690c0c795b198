"""Raw exports of mixed dialects: every file is read with its own separator and column
order, and what cannot be read comes back as rejects.

One aggregate over the first block of every file gives its header line and, for each
candidate separator, the usual number of fields of its lines; the separator with which
header and lines agree on the most fields is the file's (one row a file).  One pass over
the lines then parses each with its file's separator and puts the fields under their
names.  Both passes are text scans without a shuffle; the table of dialects is written,
measured and broadcast (a table too large for that is joined by file).

A line is a reject if its number of fields is not the header's (``short``, ``long``) or
if a quote is left open (``quote``).  Blank lines, and lines that repeat the header as
concatenated exports do, are neither rows nor rejects.  Files of different columns may lie
in one folder: a column that a file lacks is NULL.  Quoted fields may hold separators but
no line ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import BROADCAST_BYTES, kept_lookup, table_bytes

SEPARATORS = (",", ";", "\t", "|")
_QUOTED = r'"(?:[^"]|"")*"'


def _fields(line: Column, sep: str) -> Column:
    """Number of fields, separators inside quotes not counted."""
    bare = F.regexp_replace(line, _QUOTED, "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    text = spark.read.text(path)
    return text.select(F.regexp_replace("value", r"^\x{FEFF}", "").alias("line"), F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("row")).filter(F.length(F.trim("line")) > 0)


def dialects(spark: SparkSession, path: str | list[str], separators: tuple[str, ...] = SEPARATORS) -> DataFrame:
    """(file, header, sep, names, n_fields) of every file that has a line."""
    line = F.col("line")
    votes = (_lines(spark, path).filter("block = 0").groupBy("file")
             .agg(F.min_by("line", "row").alias("header"),
                  *[F.mode(_fields(line, s), True).alias(f"n{i}") for i, s in enumerate(separators)]))
    options = []
    for i, s in enumerate(separators):
        in_header = _fields(F.col("header"), s)
        # agreement of header and lines first, then more fields, then the earlier candidate
        options.append(F.struct((in_header == F.col(f"n{i}")).alias("agree"), in_header.alias("n"),
                                F.lit(-i).alias("order"), F.lit(s).alias("sep")))
    best = F.array_max(F.array(*[F.when(o["n"] > 1, o) for o in options]))
    chosen = votes.select("file", "header", F.coalesce(best["sep"], F.lit(separators[0])).alias("sep"),
                          F.coalesce(best["n"], F.lit(1)).alias("n_fields"))
    names = F.transform(F.split(F.col("header"), F.concat(F.lit(r"\Q"), F.col("sep"), F.lit(r"\E"))),
                        lambda x: F.trim(F.regexp_replace(x, '^\\s*"|"\\s*$', "")))
    return chosen.select("file", "header", "sep", names.alias("names"), "n_fields")


def read_exports(spark: SparkSession, path: str | list[str], columns: list[str] | None = None,
                 null_token: str = "?", separators: tuple[str, ...] = SEPARATORS) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects).  Rows: text columns (``columns``, default: all names found in any
    header), NULL for empty fields and the null token, and the position ``_file``,
    ``_block``, ``_row`` as of ``clean.with_file_position``.  Rejects: file, block, row
    (number of the line in reading order), reason and line."""
    known = kept_lookup(dialects(spark, path, separators), "dialects")
    if columns is None:
        found = known.select(F.explode("names").alias("name")).distinct().collect()  # distinct column names
        columns = sorted(r["name"] for r in found if r["name"])
    width = known.agg(F.max("n_fields")).first()[0] or 1
    # arrays of names are not counted by table_bytes: headers are about as long
    few = 2 * table_bytes(known) <= BROADCAST_BYTES
    lines = _lines(spark, path).join(F.broadcast(known) if few else known, "file")
    line, sep = F.col("line"), F.col("sep")
    schema = ", ".join(f"f{i} string" for i in range(width))
    count, parsed = F.lit(None).cast("int"), F.lit(None)
    for s in separators:
        count = F.when(sep == s, _fields(line, s)).otherwise(count)
        parsed = F.when(sep == s, F.from_csv(line, schema, {"sep": s, "nullValue": null_token})).otherwise(parsed)
    open_quote = F.regexp_replace(line, _QUOTED, "").contains('"')
    reason = (F.when(open_quote, "quote").when(count < F.col("n_fields"), "short")
              .when(count > F.col("n_fields"), "long"))
    judged = lines.filter(line != F.col("header")).withColumn("reason", reason)
    rows = judged.filter("reason is null").withColumn("_f", parsed)
    values = F.array(*[F.nullif(F.col(f"_f.f{i}"), F.lit("")) for i in range(width)])
    fields = [F.get(F.col("_v"), F.array_position("names", F.lit(c)).cast("int") - 1).alias(c) for c in columns]
    rows = (rows.withColumn("_v", values)
            .select(*fields, F.col("file").alias("_file"), F.col("block").alias("_block"),
                    F.monotonically_increasing_id().alias("_row")))
    rejects = judged.filter("reason is not null").select("file", "block", "row", "reason", "line")
    return rows, rejects
