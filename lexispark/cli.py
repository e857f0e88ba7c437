"""Command line: mine, stats, export, rebase and audit over tables in Parquet and CSV.

python -m lexispark.cli mine --sheet items.xlsx --out snapshots/1 [--snapshot snapshots/0] [--limit N] [--locales sv-SE,fi-FI]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lexispark import fixed
from lexispark.operators import align, glossary, store
from lexispark.plans import curation, mining
from lexispark.sources import files


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lexispark", description=__doc__.splitlines()[0])
    sub = p.add_subparsers(dest="command", required=True)
    mine = sub.add_parser("mine", help="mine a workbook into a new snapshot")
    mine.add_argument("--sheet", required=True)
    mine.add_argument("--out", required=True)
    mine.add_argument("--snapshot")
    mine.add_argument("--limit", type=int)
    mine.add_argument("--locales", default="")
    stats = sub.add_parser("stats", help="rows per status and phase")
    stats.add_argument("--snapshot", required=True)
    export = sub.add_parser("export", help="write a glossary as CSV")
    export.add_argument("--snapshot", required=True)
    export.add_argument("--out", required=True)
    export.add_argument("--min-score", type=float, default=fixed.APPROVE_SIMILARITY)
    export.add_argument("--best", action="store_true", help="deduplicate terms and take the best translation, whatever the status")
    rebase = sub.add_parser("rebase", help="make another locale the key of a glossary")
    rebase.add_argument("--glossary", required=True)
    rebase.add_argument("--locale", required=True)
    rebase.add_argument("--out", required=True)
    audit = sub.add_parser("audit", help="quality classes of the terms of a glossary")
    audit.add_argument("--glossary", required=True)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("lexispark").getOrCreate()
    if args.command == "mine":
        sheet = files.read_workbook(spark, files.resolve_workbook(args.sheet))
        old = spark.read.parquet(args.snapshot) if args.snapshot else None
        locales = [x for x in args.locales.split(",") if x] or None
        mining.mine(sheet, None, align.hashing_encoder(), old, args.limit, locales).write.parquet(args.out)
    elif args.command == "stats":
        rows = spark.read.parquet(args.snapshot)
        store.status_totals(rows).orderBy(F.desc("n")).show(100, truncate=False)
        store.phase_totals(rows).show()
    elif args.command == "export":
        rows = spark.read.parquet(args.snapshot)
        if "id" not in rows.columns:
            rows = rows.withColumn("id", F.conv(F.substring(F.md5(F.concat_ws("|", *store.KEY)), 1, 13), 16, 10).cast("long"))
        out = curation.deduplicated_glossary(rows) if args.best else glossary.pivot_first(glossary.exportable(rows, args.min_score))
        files.write_csv(out, args.out, [F.lower(fixed.SOURCE_LOCALE), F.col(fixed.SOURCE_LOCALE)])
        glossary.coverage(out).show()
    elif args.command == "rebase":
        files.write_csv(glossary.rebase(files.read_csv(spark, args.glossary).fillna(""), args.locale), args.out)
    else:
        rows = files.read_csv(spark, args.glossary).select(F.col(fixed.SOURCE_LOCALE).alias("term"))
        for report in (glossary.quality_counts(rows), glossary.quality_buckets(rows), glossary.word_histogram(rows).orderBy("n_words")):
            report.show(100, truncate=False)


if __name__ == "__main__":
    main()
