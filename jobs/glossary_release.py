"""Release a glossary: fold candidate events, merge equal terms, take the best translations, and audit the result.

python -m jobs.glossary_release --tables tables --output release [--decisions decisions.json] [--config FILE]

Reads the candidate events of `tables`, folds and scores them, folds the case of source terms, applies the merges of a decisions document if one is given, and takes the translation with the best score
of each term and locale. Writes below `output`:

glossary   CSV with a header, partitioned by target_locale: term, translation
audit      Parquet, partitioned by bucket (what to do with the term): term, flags (the letters of its quality classes)
coverage   JSON: locale, translated, total, percent

Each table is overwritten as a whole, so a run that is repeated, or died half-way, gives the same release.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.config import command, options
from lexispark import fixed
from lexispark.functions import validity
from lexispark.operators import glossary
from lexispark.plans import curation
from lexispark.session import scratch_scope, scratch_table
from lexispark.sources import files, standins

log = logging.getLogger("glossary_release")

NO_DECISIONS = "action string, canonical string, aliases array<string>, seq long"


def pairs(wide: DataFrame) -> DataFrame:
    """The cells of a wide glossary: term, translation, target_locale."""
    cells = F.array(*[F.struct(F.lit(x).alias("target_locale"), F.col(f"`{x}`").alias("translation")) for x in fixed.TARGET_LOCALES])
    return wide.select(F.col(fixed.SOURCE_LOCALE).alias("term"), F.inline(cells)).filter("translation <> ''").select("term", "translation", "target_locale")


def audit(wide: DataFrame) -> DataFrame:
    flags = validity.quality_flags(F.col("term"))
    return wide.select(F.col(fixed.SOURCE_LOCALE).alias("term")).select("term", F.array_join(flags, "").alias("flags"), validity.quality_bucket(flags).alias("bucket"))


def run(spark: SparkSession, tables: str, output: str, decisions: str | None = None) -> None:
    candidates = standins.candidates(spark, tables)
    made = files.read_decisions(spark, decisions)[1] if decisions else spark.createDataFrame([], NO_DECISIONS)
    with scratch_scope():
        candidates = scratch_table(candidates, "release-candidates")
        log.info("read %d candidates from %s", candidates.count(), tables)
        wide = scratch_table(curation.deduplicated_glossary(candidates, made), "release-glossary")
        rows = pairs(wide).hint("rebalance", "target_locale").sortWithinPartitions("target_locale", "term")
        rows.write.mode("overwrite").option("header", True).option("escape", '"').partitionBy("target_locale").csv(f"{output}/glossary")
        audit(wide).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{output}/audit")
        glossary.coverage(wide).coalesce(1).write.mode("overwrite").json(f"{output}/coverage")
        log.info("wrote %d terms below %s", wide.count(), output)


def read(spark: SparkSession, output: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables of a release: glossary, audit, coverage."""
    found = spark.read.option("header", True).option("escape", '"').schema("term string, translation string, target_locale string").csv(f"{output}/glossary")
    audited = spark.read.schema("term string, flags string, bucket string").parquet(f"{output}/audit")
    return found, audited, spark.read.schema("locale string, translated long, total long, percent double").json(f"{output}/coverage")


def main(argv: list[str] | None = None) -> None:
    command("glossary_release", run, options(__doc__.splitlines()[0], "glossary_release.json", argv))


if __name__ == "__main__":
    main()
