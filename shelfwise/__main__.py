"""Command line: the batch stages.

  python -m shelfwise master --sales S.csv --inventory I.csv --out DIR
  python -m shelfwise master --tables /path/to/sf_dir --out DIR
  python -m shelfwise model  --out DIR [--trees N --rounds N --no-cv]
  python -m shelfwise score  --out DIR [--fill]      (models saved by ``model``; no fitting)

On a cluster run it with ``spark-submit``; the session (master URL,
checkpoint folder, partitions) comes from the submit configuration.
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession

from .plans import master as master_plan
from .plans import modelling, scoring
from .schema import ModelParams
from .session import ensure_checkpoint_dir, ensure_sql_settings, remove_stages


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="shelfwise")
    sub = ap.add_subparsers(dest="cmd", required=True)
    m = sub.add_parser("master", help="raw inputs → master table")
    m.add_argument("--sales")
    m.add_argument("--inventory")
    m.add_argument("--tables", help="folder with the star-schema parquet tables")
    m.add_argument("--out", required=True)
    m.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    d = sub.add_parser("model", help="master table → models and report tables")
    d.add_argument("--out", required=True)
    d.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    d.add_argument("--trees", type=int)
    d.add_argument("--rounds", type=int)
    d.add_argument("--no-cv", action="store_true")
    s = sub.add_parser("score", help="master table + saved models → predictions by year")
    s.add_argument("--out", required=True)
    s.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    s.add_argument("--fill", action="store_true", help="score rows that lack a feature on the training medians")
    args = ap.parse_args(argv)

    from pyspark import SparkConf
    builder = SparkSession.builder.appName(f"shelfwise-{args.cmd}")
    if not SparkConf().contains("spark.master"):      # plain python, not spark-submit
        builder = builder.master("local[*]").config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    ensure_sql_settings(spark)
    ensure_checkpoint_dir(spark)
    if args.cmd == "master":
        if args.tables:      # one pass over the line table
            table = master_plan.master_from_tables(spark, args.tables)
        elif args.sales and args.inventory:
            table = master_plan.master(master_plan.raw_from_csv(spark, args.sales, args.inventory))
        else:
            ap.error("give --tables or both --sales and --inventory")
        path = master_plan.write_master(table, args.out, args.format)
        print(f"master table written to {path}")
    elif args.cmd == "score":
        print(f"predictions written to {scoring.run(spark, args.out, args.format, args.fill)}")
    else:
        p = ModelParams()
        if args.trees:
            p = replace(p, sales_trees=args.trees, qty_trees=args.trees, cls_trees=args.trees)
        if args.rounds:
            p = replace(p, gbt_rounds=args.rounds)
        if args.no_cv:
            p = replace(p, cv=False)
        modelling.run(spark, args.out, p, args.format).show(truncate=False)
    remove_stages(spark)


if __name__ == "__main__":
    main()
