"""Command line for the batch site-log programs and the stream programs.

    python -m skewkit.cli topn      --text data/site.log [--salts 3] [--n 2]
    python -m skewkit.cli topn      --orc data/orc --distinct [--salts 9] [--n 2 | --all]
    python -m skewkit.cli join-topn --text a.log --right-text b.log [--n 2]
    python -m skewkit.cli lookup    --left-csv schools.csv --right-csv people.csv --key id
    python -m skewkit.cli stream    word-counts|running-counts|per-record|window-counts|sales
                                    --source folder | --kafka servers --topics a,b
                                    --sink folder --checkpoint folder [--group g] [--every "5 seconds" | --once]

Results of the batch programs are shown (``--rows`` lines) or written as parquet with ``--out``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from skewkit.operators.joins import broadcast_left_join, join_topn
from skewkit.operators.topn import rank_all, salted_count, salted_topn, topn_distinct_counts
from skewkit.sources.delimited import scan_delimited, scan_orc
from skewkit.sources.messages import message_stream
from skewkit.streaming import apps

SITE_COLUMNS = ["site", "url"]


def read_site_log(spark: SparkSession, text: str | None, orc: str | None) -> DataFrame:
    if text:
        return scan_delimited(spark, text, SITE_COLUMNS, sep=" ")
    if orc:
        return scan_orc(spark, orc, "site string, url string")
    raise SystemExit("give --text or --orc")


def run(args: argparse.Namespace, spark: SparkSession) -> DataFrame:
    n = None if getattr(args, "all", False) else getattr(args, "n", None)
    if args.command == "topn":
        log = read_site_log(spark, args.text, args.orc)
        if args.distinct:
            counts = salted_count(log, SITE_COLUMNS, n_salts=args.salts)
            return topn_distinct_counts(counts, "site", "url", n=n)
        if n is None:
            return rank_all(salted_count(log, SITE_COLUMNS, n_salts=args.salts), "site", "cnt", tie="url")
        return salted_topn(log, "site", "url", n=n, n_salts=args.salts)
    if args.command == "join-topn":
        left = read_site_log(spark, args.text, args.orc)
        right = read_site_log(spark, args.right_text, args.right_orc)
        return join_topn(left, right, "site", "url", n=n)
    if args.command == "lookup":
        big = spark.read.option("header", True).csv(args.left_csv)
        small = spark.read.option("header", True).csv(args.right_csv)
        return broadcast_left_join(big, small, args.key)
    raise SystemExit(f"unknown command {args.command}")


def start_stream(args: argparse.Namespace, spark: SparkSession):
    """The started query of a stream program."""
    topics = args.topics.split(",") if args.topics else []
    messages = message_stream(spark, args.source, kafka_servers=args.kafka, topics=topics)
    every = None if args.once else args.every
    if args.program == "word-counts":
        return apps.start_word_count_with_offsets(messages, args.sink, args.checkpoint, args.group, every, args.run_id)
    if args.program == "sales":
        return apps.start_sales_upsert(messages, args.sink, args.checkpoint, args.group, every, args.run_id)
    if args.program == "word-table":
        return apps.start_word_count_table(messages, args.sink, args.checkpoint, args.group, every, args.run_id)
    if args.program == "sales-table":
        return apps.start_sales_table(messages, args.sink, args.checkpoint, args.group, every, args.run_id)
    if args.program == "window-counts":
        return apps.start_window_count_deltas(messages, args.sink, args.checkpoint, args.length, every, args.run_id, args.slide)
    if args.program == "per-record":
        return apps.start_running_counts_per_record(messages, args.sink, args.checkpoint, every, args.run_id, args.order)
    return apps.start_running_counts(messages, args.sink, args.checkpoint, every=every, run_id=args.run_id)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="skewkit")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("topn", "join-topn"):
        c = sub.add_parser(name)
        c.add_argument("--text")
        c.add_argument("--orc")
        c.add_argument("--n", type=int, default=2)
        c.add_argument("--all", action="store_true", help="no limit on N")
        if name == "topn":
            c.add_argument("--salts", type=int, default=3)
            c.add_argument("--distinct", action="store_true", help="top-N distinct counts per site")
        else:
            c.add_argument("--right-text")
            c.add_argument("--right-orc")
    c = sub.add_parser("lookup")
    c.add_argument("--left-csv", required=True)
    c.add_argument("--right-csv", required=True)
    c.add_argument("--key", required=True)
    s = sub.add_parser("stream")
    s.add_argument("program", choices=["word-counts", "running-counts", "per-record", "window-counts", "sales", "word-table", "sales-table"])
    s.add_argument("--source", help="folder of message files")
    s.add_argument("--kafka", help="bootstrap servers")
    s.add_argument("--topics")
    s.add_argument("--sink", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--group", default="skewkit")
    s.add_argument("--every", default=apps.DEFAULT_EVERY)
    s.add_argument("--once", action="store_true", help="process what is there and stop")
    s.add_argument("--run-id", type=int, default=0)
    s.add_argument("--length", default="5 seconds", help="window-counts: length of a window")
    s.add_argument("--slide", help="window-counts: from one window's start to the next; without it windows tumble")
    s.add_argument("--order", choices=["offset", "ts"], default="offset", help="per-record: order inside a batch")
    for name, c in sub.choices.items():
        if name == "stream":
            continue
        c.add_argument("--out")
        c.add_argument("--rows", type=int, default=20)
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"skewkit-{args.command}").getOrCreate()
    if args.command == "stream":
        start_stream(args, spark).awaitTermination()
        return
    df = run(args, spark)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(args.rows, truncate=False)


if __name__ == "__main__":
    main()
