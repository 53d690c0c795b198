"""WARC fixity audit with Merkle trees.

Records are laid out in archives one after another.  A tree over an archive has
the SHA-256 of every record as leaves, in order, each with its range of
offsets; FANOUT neighbours make a node of the next level, whose hash is that of
its children's numbers, hashes and offsets from its own start, so a lost record
changes no node behind it.  Two replicas are compared by their roots; only
the children of nodes that differ are looked at on the way down, which ends at
the records that are corrupt, missing or extra.

Null payloads and urls are empty.  Repeated rows are records of their own.  An
archive holds ARCHIVE_RECORDS records at most, so no group grows with the
data.  Empty tables give empty archives and an empty report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

FANOUT = 16
LEVELS = 3
ARCHIVE_RECORDS = FANOUT ** LEVELS


def record(record_id: Column, url: Column, payload: Column) -> Column:
    """The bytes of a WARC response record."""
    body = F.coalesce(payload.cast("binary"), F.lit(b""))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
                    F.coalesce(record_id.cast("string"), F.lit("")),
                    F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
                    F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head.cast("binary"), body, F.lit(b"\r\n\r\n"))


def archived(pages: DataFrame, record_id: str = "page_id", url: str = "url",
             payload: str = "html") -> DataFrame:
    """Archives of ``pages``, written as a table: (archive, seq, record_id,
    record).  An archive takes consecutive rows of one input partition."""
    at = F.monotonically_increasing_id()   # fixed by being written
    rows = pages.select(at.alias("at"), F.col(record_id).alias("record_id"),
                        record(F.col(record_id), F.col(url), F.col(payload)).alias("record"))
    shift = ARCHIVE_RECORDS.bit_length() - 1
    return written(rows.select(F.shiftright("at", shift).alias("archive"),
                               F.col("at").bitwiseAND(ARCHIVE_RECORDS - 1).cast("int").alias("seq"),
                               "record_id", "record"), "archives")


def manifest(records: DataFrame) -> DataFrame:
    """(archive, seq, record_id, start, end, hash): the leaves, written."""
    hashed = records.select("archive", "seq", "record_id", F.octet_length("record").alias("size"),
                            F.sha2("record", 256).alias("hash"))
    order = Window.partitionBy("archive").orderBy("seq")
    end = F.sum(F.col("size").cast("long")).over(order)
    return written(hashed.select("archive", "seq", "record_id", (end - F.col("size")).alias("start"),
                                 end.alias("end"), "hash"), "manifest")


def tree(leaves: DataFrame) -> list[DataFrame]:
    """Levels of (archive, seq, start, end, hash), leaves first, roots last, each
    written once."""
    levels = [leaves.select("archive", "seq", "start", "end", "hash")]
    for _ in range(LEVELS):
        grouped = (levels[-1].groupBy("archive", F.floor(F.col("seq") / FANOUT).cast("int").alias("p"))
                   .agg(F.min("start").alias("start"), F.max("end").alias("end"),
                        F.sort_array(F.collect_list(F.struct("seq", "start", "end", "hash"))).alias("c")))
        text = F.transform("c", lambda x: F.concat_ws(
            ":", x["seq"].cast("string"), (x["start"] - F.col("start")).cast("string"),
            (x["end"] - F.col("start")).cast("string"), x["hash"]))
        levels.append(written(grouped.select("archive", F.col("p").alias("seq"), "start", "end",
                                             F.sha2(F.concat_ws(",", text), 256).alias("hash")), "nodes"))
    return levels


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """(archive, seq, ha, hb) of nodes that are not the same in both."""
    l, r = (x.select("archive", "seq", F.col("hash").alias(n)) for x, n in ((a, "ha"), (b, "hb")))
    return l.join(r, ["archive", "seq"], "full").filter(~F.col("ha").eqNullSafe(F.col("hb")))


def descend(good: DataFrame, copy: DataFrame) -> list[DataFrame]:
    """The nodes that differ between two manifests, roots first, leaves last, as
    (archive, seq, ha, hb).  Below the roots only children of differing nodes are
    compared, by their hashes without their offsets."""
    one, two = tree(good), tree(copy)
    found = [_differing(one[-1], two[-1])]
    for level in range(LEVELS - 1, -1, -1):
        parents = found[-1].select("archive", F.col("seq").alias("p"))
        below = [x.withColumn("p", F.floor(F.col("seq") / FANOUT).cast("int"))
                 .join(parents, ["archive", "p"], "left_semi").drop("p") for x in (one[level], two[level])]
        found.append(written(_differing(*below), "differing"))
    return found


def compare(good: DataFrame, copy: DataFrame) -> DataFrame:
    """(archive, seq, status) of the records of two manifests that differ:
    corrupt, missing from the copy, or extra in it."""
    return descend(good, copy)[-1].select("archive", "seq", F.when(F.col("hb").isNull(), "missing")
                                          .when(F.col("ha").isNull(), "extra").otherwise("corrupt").alias("status"))


def audit(good: DataFrame, copy: DataFrame) -> DataFrame:
    """The manifest of ``good`` (records as of ``archived``) plus ``status`` of
    each record in ``copy``: ok, corrupt or missing; then the records that only
    ``copy`` holds, as extra."""
    leaves, others = manifest(good), manifest(copy)
    found = compare(leaves, others)
    return (leaves.join(found.filter("status <> 'extra'"), ["archive", "seq"], "left")
            .withColumn("status", F.coalesce("status", F.lit("ok")))
            .unionByName(others.join(found.filter("status = 'extra'"), ["archive", "seq"])))
