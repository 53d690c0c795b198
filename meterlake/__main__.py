"""Command line: ``python -m meterlake {ingest,train,detect,load} ...``."""

from __future__ import annotations

import argparse
import json
import sys

from . import jobs
from .session import get_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="meterlake")
    ap.add_argument("--master", default=None, help="Spark master (omit under spark-submit)")
    ap.add_argument("--profile", default="local", choices=["local", "cluster"])
    sub = ap.add_subparsers(dest="job", required=True)

    p = sub.add_parser("ingest", help="raw CSV -> clean Parquet (+ statistics document)")
    p.add_argument("input")
    p.add_argument("output")
    p.add_argument("--stats")
    p.add_argument("--sep", default=",", help="separator, or 'auto': that of each file")
    p.add_argument("--rejects", help="with --sep auto: where unreadable lines go")
    p.add_argument("--order-by", help="column that orders the rows (default: file order)")

    p = sub.add_parser("train", help="clean readings -> saved pipeline and run records")
    p.add_argument("readings", nargs="+", help="candidate clean-table locations, first wins")
    p.add_argument("--registry", required=True)

    p = sub.add_parser("detect", help="stream -> anomalies table")
    p.add_argument("table")
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--source", default="files", choices=["files", "kafka", "rate"])
    p.add_argument("--path")
    p.add_argument("--bootstrap-servers")
    p.add_argument("--topic")
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--format", default="parquet", choices=["parquet", "json"])

    p = sub.add_parser("load", help="hourly load aggregate over a clean table")
    p.add_argument("readings", nargs="+")

    args = ap.parse_args(argv)
    spark = get_session(args.master, app_name=f"meterlake-{args.job}", profile=args.profile)
    if args.job == "ingest":
        out = jobs.ingest(spark, args.input, args.output, args.stats, sep=args.sep,
                          order_col=args.order_by, rejects_path=args.rejects)
        print(json.dumps({"rows": out.count(), "output": args.output}))
    elif args.job == "train":
        from .sources.readers import read_first_parquet
        readings, used = read_first_parquet(spark, args.readings)
        t = jobs.train(spark, readings, args.registry)
        print(json.dumps({"source": used, "model": t["model_path"], **t["result"].metrics}))
    elif args.job == "detect":
        q, _ = jobs.detect(spark, args.table, args.checkpoint, args.source, args.path,
                           args.bootstrap_servers, args.topic,
                           available_now=args.available_now, output_format=args.format)
        q.awaitTermination()
    elif args.job == "load":
        for row in jobs.load(spark, args.readings).orderBy("hour").collect():
            print(json.dumps(row.asDict()))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
