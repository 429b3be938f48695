"""Command line: ``python -m figpairs <command> ...`` (runs on the active Spark
master; ``--master`` only for a local run).

  split     catalogue → train/dev/test list files (header repeated)
  shard     list file(s) → shard list files of N lines
  build     catalogue + landed packages → pair JSONL, image bytes, id table
  articles  folder tree of article XML → article JSONL
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _spark(master: str | None) -> SparkSession:
    b = SparkSession.builder.appName("figpairs")
    if master:
        b = b.master(master)
    spark = b.getOrCreate()
    from figpairs.session import DEFAULTS, checkpoint_dir

    for k, v in DEFAULTS.items():
        if k != "spark.ui.enabled" and spark.conf.get(k, None) is None:
            try:
                spark.conf.set(k, v)
            except Exception:  # noqa: BLE001 - static config
                pass
    checkpoint_dir(spark)
    return spark


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="figpairs")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("split")
    s.add_argument("--input", required=True)
    s.add_argument("--out_dir", required=True)
    h = sub.add_parser("shard")
    h.add_argument("--input", required=True)
    h.add_argument("--out_dir", required=True)
    h.add_argument("--prefix", default=None)
    h.add_argument("--shard_size", type=int, default=10_000)
    b = sub.add_parser("build")
    b.add_argument("--list", required=True, help="catalogue / list file or folder of lists")
    b.add_argument("--packages", required=True, help="folder with landed .tar.gz packages")
    b.add_argument("--out_root", required=True)
    b.add_argument("--scope", choices=["split", "shard"], default="split")
    b.add_argument("--subset_size", type=int, default=None)
    b.add_argument("--max_filesize_mb", type=int, default=None)
    b.add_argument("--no_resume", action="store_true")
    b.add_argument("--id_index", action="store_true", help="keep published ids in a bucketed table (OUT_ROOT/ids); resume reads new batches only")
    b.add_argument("--no_decode", action="store_true", help="take an image's signature for its validity")
    b.add_argument("--staging", default=None, help="folder for images while they are checked (default: OUT_ROOT/staging)")
    a = sub.add_parser("articles")
    a.add_argument("--xml_root", required=True)
    a.add_argument("--out", required=True)
    args = ap.parse_args(argv)
    spark = _spark(args.master)

    from figpairs.functions.text import LIST_PREFIX
    from figpairs.operators import report, split
    from figpairs.plans import pipeline, sinks
    from figpairs.plans.publish import verify_images
    from figpairs.sources import catalogue, ids, stream
    from figpairs.streaming.incremental import existing_pairs

    if args.cmd == "split":
        rows = pipeline.split_catalogue(spark, args.input, args.out_dir)
        print(json.dumps({r.split: r["n"] for r in rows.groupBy("split").count().withColumnRenamed("count", "n").collect()}))
    elif args.cmd == "shard":
        rows = pipeline.shard_catalogue(spark, args.input, args.out_dir, prefix=args.prefix or LIST_PREFIX, shard_size=args.shard_size)
        print(json.dumps({"shards": rows.select("shard_idx").distinct().count()}))
    elif args.cmd == "build":
        if args.scope == "shard":
            cat = catalogue.read_shard_lists(spark, args.list, subset=args.subset_size)
            scope = ("shard_idx",)
        else:
            cat = split.assign_split(catalogue.read_catalogue(spark, args.list, subset=args.subset_size))
            scope = ("split",)
        resume = not args.no_resume
        prior = ids.sync_ids if args.id_index else existing_pairs
        b = pipeline.build_pairs(cat, stream.list_packages(spark, args.packages), scope=scope, resume=resume,
                                 existing=prior(spark, args.out_root, scope) if resume else None,
                                 max_mb=args.max_filesize_mb)
        if not args.no_decode:
            b = verify_images(b, args.staging or f"{args.out_root}/staging", scope=scope)
        done = pipeline.write_build(b, args.out_root, scope=scope, entries=True)
        print("skipped: " + json.dumps({k: n for k, n in done.counts.items() if k in report.SKIP_REASONS and n}), file=sys.stderr)
        print(json.dumps({r[0]: r["n_written"] for r in report.run_summary(done.entries, scope=scope).collect()}))
    elif args.cmd == "articles":
        arts = pipeline.build_articles(spark, args.xml_root)
        sinks.write_articles(arts, args.out)
        print(json.dumps({"articles": spark.read.json(args.out).count()}))


if __name__ == "__main__":
    main()
