"""Glossary exports: pivots, re-keying, coverage and term quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexispark import fixed
from lexispark.functions import text as T
from lexispark.functions import validity


def exportable(candidates: DataFrame, min_similarity: float = fixed.APPROVE_SIMILARITY) -> DataFrame:
    return candidates.filter(F.col("status").isin(fixed.EXPORT_STATUSES) & (F.col("similarity") >= min_similarity))


def pivot_first(rows: DataFrame, locales: list[str] = fixed.TARGET_LOCALES) -> DataFrame:
    """One row per source term; per locale the first non-empty translation by id. Unknown locales make the row but no column."""
    return _wide(rows, "source_term", F.min_by("target_term", F.when(F.col("target_term") != "", F.col("id"))), locales)


def _wide(rows: DataFrame, key: str, value, locales: list[str]) -> DataFrame:
    cells = rows.groupBy(F.col(key), "target_locale").agg(value.alias("v"))
    columns = [F.coalesce(F.max(F.when(F.col("target_locale") == x, F.col("v"))), F.lit("")).alias(x) for x in locales]
    return cells.groupBy(F.col(key).alias(fixed.SOURCE_LOCALE)).agg(*columns)


def pivot_best(rows: DataFrame, locales: list[str] = fixed.TARGET_LOCALES) -> DataFrame:
    """One row per canonical term; per locale the translation of the best (score, frequency), the lowest id on ties.

    rows: canonical, target_locale, target_term, final_score, frequency, id. Blank translations, measurements and
    excluded terms go, and so do terms without any of the locales.
    """
    clean = rows.withColumn("target_term", T.strip(F.col("target_term"))).filter("target_term <> ''")
    clean = clean.filter(~validity.is_measurement(F.col("canonical")) & ~validity.is_excluded(F.col("canonical")))
    rank = F.struct(-F.coalesce("final_score", F.lit(0.0)), -F.coalesce("frequency", F.lit(0)), F.col("id"))
    wide = _wide(clean.filter(F.col("target_locale").isin(locales)), "canonical", F.min_by("target_term", rank), locales)
    return wide


def rebase(glossary: DataFrame, locale: str) -> DataFrame:
    """Make another locale the key: its column first, rows without it dropped."""
    if locale not in glossary.columns:
        raise ValueError(f"no locale {locale}; there are {', '.join(glossary.columns)}")
    rest = [c for c in glossary.columns if c != locale]
    return glossary.select(*[F.col(f"`{c}`") for c in [locale, *rest]]).filter(T.strip(F.col(f"`{locale}`")) != "")


def coverage(glossary: DataFrame, locales: list[str] = fixed.TARGET_LOCALES) -> DataFrame:
    """locale, translated, total, percent."""
    counts = glossary.agg(F.count("*").alias("total"), *[F.count_if(F.col(f"`{x}`") != "").alias(x) for x in locales])
    pairs = F.array(*[F.struct(F.lit(x).alias("locale"), F.col(f"`{x}`").alias("translated")) for x in locales])
    rows = counts.select("total", F.inline(pairs))
    return rows.select("locale", "translated", "total", F.round(F.when(F.col("total") > 0, F.col("translated") * 100.0 / F.col("total")).otherwise(0.0), 4).alias("percent"))


def quality_counts(terms: DataFrame, term: str = "term") -> DataFrame:
    """flag, n: how many terms fall into each class."""
    flags = terms.select(F.explode_outer(validity.quality_flags(F.col(term))).alias("flag")).filter("flag IS NOT NULL")
    return flags.groupBy("flag").agg(F.count("*").alias("n"))


def quality_buckets(terms: DataFrame, term: str = "term") -> DataFrame:
    """bucket, n: what to do, each term counted once."""
    return terms.select(validity.quality_bucket(validity.quality_flags(F.col(term))).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def word_histogram(terms: DataFrame, term: str = "term") -> DataFrame:
    """n_words, n, percent of all."""
    counts = terms.select(T.word_count(F.col(term)).cast("long").alias("n_words")).groupBy("n_words").agg(F.count("*").alias("n"))
    return counts.select("n_words", "n", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 4).alias("percent"))


def number_prefixed(candidates: DataFrame) -> DataFrame:
    """Source terms that begin with a digit and hold a percent sign, or with two digits and hold a space: rows and locales of each."""
    t = F.col("source_term")
    found = candidates.filter(t.rlike("^[0-9].*%") | t.rlike("^[0-9][0-9].* "))
    return found.groupBy("source_term").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("target_locale")), ",").alias("locales"))


def phrase_variants(candidates: DataFrame, phrase: str) -> DataFrame:
    """Source terms that contain a phrase in any case, with their row counts."""
    return candidates.filter(F.lower("source_term").like(f"%{phrase}%")).groupBy("source_term").agg(F.count("*").alias("n"))


def seeded_sample(rows: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """A sample without replacement of n rows that key and seed alone decide."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)
