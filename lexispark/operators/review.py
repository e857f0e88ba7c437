"""Two-phase review: what is fetched, how a judge's answer is read, and what its verdict sets."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark import fixed
from lexispark.functions.scoring import lookup
from lexispark.functions.text import strip_fence


def fetch_phase1(candidates: DataFrame, limit: int | None = 500) -> DataFrame:
    """Rows that need review, one per normalized source: summed frequency, and its fields and domains in order."""
    names = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    out = (
        candidates.filter("status = 'needs_review'").groupBy("normalized_source")
        .agg(F.min("source_locale").alias("source_locale"), F.sum("frequency").alias("frequency"), names("field_origin").alias("field_origins"), names("domain").alias("domains"))
        .orderBy(F.desc("frequency"), "normalized_source")
    )
    return out.limit(limit) if limit is not None else out


def fetch_phase2(candidates: DataFrame, locale: str | None = None, limit: int | None = 500) -> DataFrame:
    """Rows that phase 1 approved or sent to a human, best score first, with an optional locale."""
    out = candidates.filter(F.col("status").isin("phase1_approved", "phase1_needs_human_review"))
    if locale:
        out = out.filter(F.col("target_locale") == locale)
    out = out.orderBy(F.col("final_score").desc_nulls_last(), "id")
    return out.limit(limit) if limit is not None else out


def verdict_phase1(clean: Column, utility: Column, relevance: Column, brand: Column | None = None) -> Column:
    """The stated rules of phase 1; a brand is decided before approval."""
    brand = F.lit(False) if brand is None else brand
    return (
        F.when((clean < 3) | (utility < 2) | (relevance < 2), "rejected").when(brand, "verbatim_entry")
        .when((clean >= 4) & (utility >= 4) & (relevance >= 4), "approved").otherwise("needs_human_review")
    )


def verdict_phase2(validity: Column, consistency: Column, brand: Column | None = None) -> Column:
    brand = F.lit(False) if brand is None else brand
    return (
        F.when((validity < 2) | (consistency < 2), "rejected").when(brand, "verbatim_entry")
        .when((validity >= 4) & (consistency >= 4), "approved").otherwise("needs_human_review")
    )


def reasons_phase1(clean: Column, utility: Column, relevance: Column, brand: Column | None = None) -> Column:
    brand = F.lit(False) if brand is None else brand
    rules = ((clean < 3, "garbled_source"), (utility < 2, "too_generic"), (relevance < 2, "off_domain"), (brand, "brand_name_verbatim"))
    return F.array_compact(F.array(*[F.when(cond, F.lit(reason)) for cond, reason in rules]))


def status_of(verdict: Column, phase: int) -> Column:
    """The status that a verdict sets; an unknown one asks for a human."""
    table = fixed.PHASE1_STATUS if phase == 1 else fixed.PHASE2_STATUS
    return lookup(table, F.coalesce(verdict, F.lit("")), f"phase{phase}_needs_human_review")


# --- answers as JSON ---

SCORES = ["source_term_cleanness", "glossary_utility", "domain_relevance", "translation_pair_validity", "translation_consistency_value"]
#: Names in a nested `scores` object, and the field that each stands for.
SCORE_ALIASES = {
    "source_term_cleanness": ["cleanness", "source_term_cleanness"],
    "glossary_utility": ["utility", "glossary_utility"],
    "domain_relevance": ["domain_relevance"],
    "translation_pair_validity": ["translation_pair_validity", "pair_validity"],
    "translation_consistency_value": ["translation_consistency_value", "consistency_value"],
}
_NESTED = ", ".join(dict.fromkeys(f"{a} int" for names in SCORE_ALIASES.values() for a in names))
ANSWER = (
    f"verdict string, confidence double, {', '.join(f'{s} int' for s in SCORES)}, is_brand_verbatim boolean, "
    f"rejection_reasons array<string>, suggested_normalized_source string, notes string, scores struct<{_NESTED.replace(' int', ':int')}>"
)


def read_answers(answers: DataFrame, column: str, phase: int) -> DataFrame:
    """Add the judgment in a judge's text as struct `judgment`, and `valid`. An invalid one is for the reject table.

    Fences are stripped, verdict and reasons lower-cased, nested scores lifted without overwriting, defaults set and long notes cut.
    """
    a = F.col("__a")
    notes = F.coalesce(a["notes"], F.lit(""))
    cut = F.when(F.length(notes) > fixed.MOST_NOTE_CHARS, F.concat(F.substring(notes, 1, fixed.MOST_NOTE_CHARS - 3), F.lit("..."))).otherwise(notes)
    score = {s: F.coalesce(a[s], *[a["scores"][x] for x in SCORE_ALIASES[s]]).alias(s) for s in SCORES}
    needed = SCORES[:3] if phase == 1 else SCORES[3:]
    fields = [
        F.lower(a["verdict"]).alias("verdict"), F.coalesce(a["confidence"], F.lit(fixed.DEFAULT_CONFIDENCE)).alias("confidence"),
        *[score[s] for s in needed],
        F.transform(F.coalesce(a["rejection_reasons"], F.array().cast("array<string>")), F.lower).alias("rejection_reasons"),
        cut.alias("notes"),
    ]
    fields.append(a["suggested_normalized_source"].alias("suggested_normalized_source") if phase == 1 else F.coalesce(a["is_brand_verbatim"], F.lit(False)).alias("is_brand_verbatim"))
    j = F.col("judgment")
    checks = [j["verdict"].isin(fixed.VERDICTS), j["confidence"].between(0.0, 1.0), *[j[s].between(1, 5) for s in needed]]
    checks.append(F.forall(j["rejection_reasons"], lambda r: r.isin(fixed.REJECTION_REASONS)))
    return (
        answers.withColumn("__a", F.from_json(strip_fence(F.col(column)), ANSWER))
        .withColumn("judgment", F.struct(*fields)).drop("__a")
        .withColumn("valid", F.coalesce(reduce(lambda x, y: x & y, checks), F.lit(False)))
    )


# --- prompts and judges ---

TASKS = {
    1: ("Decide whether a source term belongs in a translation glossary.", {"source_term_cleanness": "well formed", "glossary_utility": "specific enough", "domain_relevance": "part of the domain"}),
    2: ("Decide whether a term and its translation belong in a translation glossary.", {"translation_pair_validity": "right and whole", "translation_consistency_value": "worth enforcing"}),
}


def system_prompt(phase: int, domain: str, source_locale: str = fixed.SOURCE_LOCALE, target_locale: str | None = None) -> str:
    task, criteria = TASKS[phase]
    lines = [task, f"Domain: {domain}. Source language: {source_locale}." + (f" Target language: {target_locale}." if target_locale else "")]
    lines += [f"- {name}: 1 to 5, 5 if the term is {meaning}" for name, meaning in criteria.items()]
    lines.append(f"Answer with one JSON object: verdict ({', '.join(fixed.VERDICTS)}), confidence (0 to 1), the scores, rejection_reasons ({', '.join(fixed.REJECTION_REASONS)}), notes.")
    return "\n".join(lines)


def user_prompt(phase: int) -> Column:
    """The request for one row; the verbatim hint appears where source and target are equal."""
    if phase == 1:
        return F.concat(F.lit("Term: "), F.col("source_term"), F.lit("\nFrequency: "), F.col("frequency").cast("string"), F.lit("\nFields: "), F.coalesce("field_origins", F.lit("unknown")))
    hint = F.when(F.lower("source_term") == F.lower("target_term"), F.lit("\nBoth sides are equal: is it a brand?")).otherwise("")
    return F.concat(F.lit("Term: "), F.col("source_term"), F.lit("\nTranslation: "), F.col("target_term"), F.lit("\nSimilarity: "), F.format_string("%.3f", F.col("similarity")), hint)


def judge(rows: DataFrame, call: Callable[[str, str], str], phase: int, key: str, domain: str, parallel: int = 5, attempts: int = 3, wait: float = 2.0) -> DataFrame:
    """Ask a judge about each row: key and raw answer. `call(system, user)` runs on the executors, `parallel` at a time.

    A row whose calls all fail has a null answer. Retries are inside the call; a retried task asks again, so a judge must be idempotent.
    """
    system = system_prompt(phase, domain)

    def ask(user: str) -> str | None:
        for n in range(attempts):
            try:
                return call(system, user)
            except Exception:
                if n + 1 < attempts:
                    time.sleep(wait ** (n + 1) if wait else 0)
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([ask(u) for u in b.column(1).to_pylist()], pa.string())], ["k", "answer"])

    kind = rows.schema[key].dataType.simpleString()
    asked = rows.select(F.col(key).alias("k"), user_prompt(phase).alias("user")).repartition(parallel, "k")
    return asked.mapInArrow(run, f"k {kind}, answer string").withColumnRenamed("k", key)


def rule_judge(scores: Callable[[str], dict[str, int]], phase: int) -> Callable[[str, str], str]:
    """An offline judge that applies the stated verdict rules to scores of the request."""

    def call(system: str, user: str) -> str:
        s = scores(user)
        low = min(s.values())
        if phase == 1:
            bad = s["source_term_cleanness"] < 3 or s["glossary_utility"] < 2 or s["domain_relevance"] < 2
        else:
            bad = low < 2
        verdict = "rejected" if bad else "approved" if low >= 4 else "needs_human_review"
        return json.dumps({"verdict": verdict, "confidence": fixed.DEFAULT_CONFIDENCE, **s, "rejection_reasons": [], "notes": ""})

    return call
