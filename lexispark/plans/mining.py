"""The mining plan: pairs, terms, alignment, candidates, score, upsert."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark import fixed
from lexispark.functions import scoring
from lexispark.functions import text as T
from lexispark.operators import align, pairs, store, tagging, terms
from lexispark.session import scratch_table


def source_terms(texts: DataFrame, tagger: Callable[[Column], Column] | tagging.Model | None = None) -> DataFrame:
    """Terms per distinct source text: each text is normalised and mined once, however many pairs have it. Without a tagger, one is fitted on the texts."""
    distinct = texts.select("source_text").distinct().withColumn("clean", T.normalize_text(F.col("source_text"))).filter("clean <> ''")
    tagger = tagging.fit(distinct, "clean") if tagger is None else tagger
    return terms.filter_candidates(terms.extract(distinct, "source_text", "clean", tagger), "source_text")


def candidates_of(text_pairs: DataFrame, mined: DataFrame, encoder: align.Encoder, threshold: float = fixed.ALIGN_SIMILARITY) -> DataFrame:
    """Scored candidate events of text pairs (which have row_no, field_no and locale_no for the order of arrival)."""
    key = "pair_id"
    p = text_pairs.withColumn(key, F.struct("row_no", "field_no", "locale_no")).withColumn("clean_target", T.normalize_text(F.col("target_text"))).filter("clean_target <> ''")
    asked = p.join(mined, "source_text").select(key, F.col("term").alias("source_term"))
    found = align.align(asked, p.select(key, F.col("clean_target").alias("target_text")), key, encoder, threshold)
    domains = p.select(key, "source_text").join(mined, "source_text").select(key, F.col("term").alias("source_term"), "domain")
    rows = found.join(domains, [key, "source_term"], "left").join(p, key)
    source, target = T.strip_term_punctuation(F.col("source_term")), T.strip_term_punctuation(F.col("target_term"))
    domain = F.coalesce("domain", F.lit("general"))
    out = rows.select(
        F.struct(key, "source_term", "target_term").alias("seq"),
        "source_locale", "target_locale", source.alias("source_term"), target.alias("target_term"),
        T.normalize_case(source).alias("normalized_source"), T.normalize_case(target).alias("normalized_target"),
        domain.alias("domain"), domain.alias("category"), F.col("field").alias("field_origin"), F.lit(1).cast("long").alias("frequency"),
        F.round("similarity", 4).alias("similarity"), F.col("source_text").alias("source_context"), F.col("target_text").alias("target_context"),
        F.array("product_id").alias("evidence_product_ids"),
    )
    score = scoring.final_score(F.col("similarity"), F.col("frequency"), F.col("field_origin"), F.col("domain"))
    return out.withColumn("final_score", score).withColumn("status", scoring.review_status(F.col("final_score"), F.col("similarity")))


def mine(sheet: DataFrame, tagger: Callable[[Column], Column] | tagging.Model | None, encoder: align.Encoder, snapshot: DataFrame | None = None, limit: int | None = None, locales: list[str] | None = None) -> DataFrame:
    """A new snapshot from an item sheet: limit the pairs first, then filter locales, as the flags say."""
    text_pairs = pairs.first_pairs(pairs.to_pairs(sheet))
    if limit is not None:
        text_pairs = pairs.limited(text_pairs, limit)
    if locales:
        text_pairs = text_pairs.filter(F.col("target_locale").isin(locales))
    text_pairs = scratch_table(text_pairs, "mining-pairs")
    events = candidates_of(text_pairs, scratch_table(source_terms(text_pairs, tagger), "mining-terms"), encoder)
    return store.fold(events) if snapshot is None else store.upsert(snapshot, events)


def counters(text_pairs: DataFrame, mined: DataFrame) -> DataFrame:
    """Pairs per locale, and how many of their source texts have no terms."""
    with_terms = mined.select("source_text").distinct().withColumn("has", F.lit(True))
    return text_pairs.join(with_terms, "source_text", "left").groupBy("target_locale").agg(F.count("*").alias("pairs"), F.count_if(F.col("has").isNull()).alias("without_terms"))
