"""Filtered pages over the candidate table, and its reviewer notes as columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.operators import substring

#: The sortable columns of a page, by number; notes fill the rest.
COLUMNS = ["id", "status", "source_term", "target_term", "target_locale", "domain", "field_origin", "frequency", "similarity", "final_score"]
NOTES_FROM, NOTES_TO = 10, 20
#: The columns that a search reads.
SEARCHED = ["source_term", "target_term", "normalized_source", "domain"]

NOTES = (
    "confidence double, source_term_cleanness int, glossary_utility int, domain_relevance int, translation_pair_validity int, "
    "translation_consistency_value int, is_brand_verbatim boolean, rejection_reasons array<string>, suggested_normalized_source string, notes string"
)
NOTE_NAMES = {
    "rn_confidence": "confidence", "rn_cleanness": "source_term_cleanness", "rn_utility": "glossary_utility",
    "rn_domain_relevance": "domain_relevance", "rn_pair_validity": "translation_pair_validity",
    "rn_consistency_value": "translation_consistency_value", "rn_is_brand": "is_brand_verbatim",
    "rn_suggested_source": "suggested_normalized_source",
}


@dataclass(frozen=True)
class Page:
    start: int = 0
    length: int = 50
    order_column: int = 0
    descending: bool = False
    search: str = ""
    status: str = ""
    locale: str = ""
    phase: str = ""


def phase_filter(phase: str) -> Column | None:
    if phase == "1":
        return F.col("status").like("phase1\\_%")
    if phase == "2":
        return (F.col("status") == "approved") | F.col("status").like("phase2\\_%")
    return None


def search_filter(value: str) -> Column:
    """Any of four columns contains the value, in any case; % and _ in it are wildcards."""
    return substring.contains(SEARCHED, value)


def filtered(candidates: DataFrame, page: Page, index: substring.Index | None = None) -> DataFrame:
    """The rows of a page before paging. A given status other than `all` overrides the phase. An index of these candidates over SEARCHED saves the scan."""
    out = substring.search(candidates, index, page.search) if page.search and index else candidates
    if page.status and page.status != "all":
        out = out.filter(F.col("status") == page.status)
    elif (cond := phase_filter(page.phase)) is not None:
        out = out.filter(cond)
    if page.locale:
        out = out.filter(F.col("target_locale") == page.locale)
    if page.search and not index:
        out = out.filter(search_filter(page.search))
    return out


def page_rows(candidates: DataFrame, page: Page) -> DataFrame:
    if page.order_column < len(COLUMNS):
        by = COLUMNS[page.order_column]
    else:
        by = "reviewer_notes" if NOTES_FROM <= page.order_column < NOTES_TO else "id"
    order = F.col(by).desc_nulls_last() if page.descending else F.col(by).asc_nulls_first()
    return flatten_notes(filtered(candidates, page).orderBy(order, "id").offset(page.start).limit(page.length))


def page_counts(candidates: DataFrame, page: Page) -> DataFrame:
    """One row: all rows and the filtered ones, each counted once."""
    total = candidates.agg(F.count("*").alias("records_total"))
    found = filtered(candidates, page).agg(F.count("*").alias("records_filtered"))
    return total.withColumn("k", F.lit(1)).join(found.withColumn("k", F.lit(1)), "k").drop("k")


def flatten_notes(rows: DataFrame, column: str = "reviewer_notes") -> DataFrame:
    """The judgment in the notes as rn_ columns; null where absent or malformed, reasons then empty."""
    parsed = rows.withColumn("__notes", F.from_json(column, NOTES))
    out = {new: F.col(f"__notes.{old}") for new, old in NOTE_NAMES.items()}
    empty = F.array().cast("array<string>")
    out["rn_rejection_reasons"] = F.coalesce("__notes.rejection_reasons", empty)
    # malformed text gives a struct of nulls or null; valid notes without this key have an empty note
    out["rn_notes"] = F.when(F.get_json_object(column, "$").isNotNull() & F.ltrim(column).startswith("{"), F.coalesce("__notes.notes", F.lit("")))
    return parsed.withColumns(out).drop("__notes")
