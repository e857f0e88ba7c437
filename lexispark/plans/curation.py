"""The curation plans: review in two phases, and the export of a deduplicated glossary."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.functions.text import normalize_case
from lexispark.operators import dedupe, glossary, review, store
from lexispark.session import scratch_table


def review_phase(candidates: DataFrame, phase: int, call: Callable[[str, str], str], domain: str, locale: str | None = None, limit: int | None = 500) -> DataFrame:
    """Fetch, judge, read the answers, and write the valid ones back. Rows without a valid answer keep their status."""
    if phase == 1:
        rows, key = review.fetch_phase1(candidates, limit).withColumn("source_term", F.col("normalized_source")), "normalized_source"
    else:
        rows, key = review.fetch_phase2(candidates, locale, limit), "id"
    answers = scratch_table(review.judge(rows, call, phase, key, domain), "review-answers")
    read = review.read_answers(answers, "answer", phase).filter("valid")
    ids = F.col("id") if phase == 2 else F.lit(None).cast(candidates.schema["id"].dataType)
    terms = normalize_case(F.col("normalized_source")) if phase == 1 else F.lit(None).cast("string")
    judged = read.select(
        ids.alias("id"), terms.alias("normalized_source"), review.status_of(F.col("judgment.verdict"), phase).alias("status"),
        F.to_json("judgment").alias("reviewer_notes"), F.lit(0).alias("seq"),
    )
    return store.write_back(candidates, judged)


def deduplicated_glossary(candidates: DataFrame, decisions: DataFrame | None = None, legacy: bool = False) -> DataFrame:
    """Case-fold source terms, decide similar groups by rule unless decisions are given, and pivot to the best translations."""
    case_map = scratch_table(dedupe.case_canonical(candidates, "source_term"), "glossary-case-map")
    if decisions is None:
        groups = dedupe.similar_groups(case_map.select(F.col("canonical").alias("term")))
        decisions = dedupe.decide_groups(groups, legacy=legacy).withColumn("seq", F.col("group_key"))
    cmap = dedupe.canonical_map(case_map, decisions)
    return glossary.pivot_best(dedupe.resolve(candidates, cmap))
