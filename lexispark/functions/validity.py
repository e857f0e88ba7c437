"""Predicates over terms as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexispark import fixed
from lexispark.functions import text as T


def contains_any(c: Column, phrases: list[str]) -> Column:
    return reduce(lambda out, p: out | F.contains(c, F.lit(p)), phrases[1:], F.contains(c, F.lit(phrases[0])))


def punctuation_count(c: Column) -> Column:
    return F.length(c) - F.length(F.translate(c, fixed.PUNCTUATION_MARKS, ""))


def is_marketing_opening(c: Column) -> Column:
    return c.rlike(r"(?i)^easy[-\s]to[-\s]wear\b") | (c.rlike(r"(?i)^perfect\s") & ~c.rlike(r"(?i)^perfect\s+for\b"))


def failed_rule(term: Column) -> Column:
    """The first validity rule that a term breaks, or null. The order is that of the checks.

    The stripped term, its lower-case form and its words are bound to lambda variables, so that they are made once for all rules.
    """
    stripped = F.transform(F.array(T.strip(term)), lambda t: F.struct(t.alias("t"), F.lower(t).alias("low"), T.words(t).alias("words")))
    return F.get(F.transform(stripped, lambda s: _first_failed(s["t"], s["low"], s["words"])), F.lit(0))


def _first_failed(t: Column, low: Column, words: Column) -> Column:
    n, first = F.size(words), F.lower(F.get(words, F.lit(0)))
    return (
        F.when(F.length(t) < fixed.LEAST_TERM_CHARS, "too_short")
        .when(F.replace(t, F.lit(" "), F.lit("")).rlike("^[0-9]+$") | t.rlike(fixed.NUMBER_PATTERN), "number")
        .when(t.rlike(fixed.SKU_PATTERN), "sku")
        .when(contains_any(low, fixed.PHRASE_BLACKLIST), "blacklist")
        .when(n > fixed.MOST_TERM_WORDS, "too_long")
        .when((n == 1) & low.isin(fixed.STOPWORDS), "stopword")
        .when((n >= 2) & first.isin(fixed.SENTENCE_STARTERS), "sentence_starter")
        .when(punctuation_count(t) > fixed.MOST_PUNCTUATION, "punctuation")
        .when(~t.rlike("^[A-Za-z0-9]"), "leading_sign")
        .when((n == 1) & low.isin(fixed.FILLER_WORDS), "filler")
        .when(is_marketing_opening(t), "marketing")
        .when(t.rlike(f"(?i){fixed.DIMENSION_LABEL_PATTERN}"), "dimension_label")
        .when(t.rlike(f"(?i){fixed.AGE_PATTERN}"), "age_range")
        .when(t.rlike(f"(?i){fixed.BARE_MEASUREMENT_PATTERN}"), "bare_measurement")
    )


def is_valid(term: Column) -> Column:
    return failed_rule(term).isNull()


def is_extractable(term: Column) -> Column:
    t = T.strip(term)
    return (F.length(t) >= 3) & T.word_count(t).between(1, 6)


def is_measurement(term: Column) -> Column:
    """A number, a dimension or a unit, with nothing to translate."""
    t, units = T.strip(term), fixed.EXPORT_UNITS
    return (
        t.rlike(rf"(?i)^[0-9\s.,x×\-/()]+({units})?$")
        | t.rlike(rf"(?i)^[0-9.,]+(\s*[x×/]\s*[0-9.,]+)*(\s*({units}))?$")
        | t.rlike(rf"(?i)^({units})$")
    )


def is_excluded(term: Column) -> Column:
    return F.lower(term).isin(fixed.EXPORT_EXCLUSIONS)


def quality_flags(term: Column) -> Column:
    """The letters of all quality classes that a term falls into, A to H, as an array."""
    n = T.word_count(term)
    comma = F.contains(term, F.lit(","))
    classes = {
        "A": term.rlike("^[^A-Za-z0-9]"),
        "B": (n == 1) & F.lower(term).isin(fixed.QUALITY_FILLERS),
        "C": term.rlike(f"(?i){fixed.MARKETING_PATTERN}"),
        "D": term.rlike(f"(?i){fixed.CARE_PATTERN}"),
        "E": comma & (((n >= 6) & term.rlike(f"(?i){fixed.SENTENCE_VERB_PATTERN}")) | (n >= 9)),
        "F": term.rlike(f"(?i){fixed.SIZE_CHART_PATTERN}"),
        "G": n >= fixed.LONG_PHRASE_WORDS,
        "H": term.rlike(f"(?i){fixed.YEAR_PATTERN}"),
    }
    return F.array_compact(F.array(*[F.when(cond, F.lit(k)) for k, cond in classes.items()]))


def quality_bucket(flags: Column) -> Column:
    """What to do about a term's classes; the first that applies."""
    has = lambda *ks: F.arrays_overlap(flags, F.array(*[F.lit(k) for k in ks]))
    return F.when(has("A", "B"), "auto_exclude").when(has("C", "D", "H"), "recommend_exclude").when(has("E", "F", "G"), "review").otherwise("clean")
