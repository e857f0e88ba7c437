"""Text normalisation as Column expressions.

Python's white space and word classes are Unicode classes. Java's need the flag (?U) for white space; word
characters are spelled out as letters, numbers and underscore, because (?U)\\w also drops signs such as a superscript two.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexispark import fixed

SPACE = r"(?U)\s+"


def strip(c: Column) -> Column:
    """Trim all Unicode white space, not only spaces."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean_to_null(c: Column) -> Column:
    """A cell as text: trimmed, blank becomes null."""
    return F.nullif(strip(c.cast("string")), F.lit(""))


def normalize_case(c: Column) -> Column:
    return strip(F.lower(c))


def strip_html(c: Column) -> Column:
    """Text of markup: comments and the bodies of script and style go, tags become a space. Text without `<` stays as it is."""
    text = F.regexp_replace(c, r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", " ")
    text = F.regexp_replace(text, r"(?s)<[^>]*>", " ")
    return F.when(c.isNull(), F.lit("")).when(F.contains(c, F.lit("<")), text).otherwise(c)


#: The entities that are decoded without Python, the ampersand last.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&reg;", "®"), ("&middot;", "·"), ("&amp;", "&")]


def decode_entities(c: Column) -> Column:
    """Decode the common entities; after strip_html, so that `&lt;b&gt;` ends as `<b>`."""
    return reduce(lambda out, e: F.replace(out, F.lit(e[0]), F.lit(e[1])), ENTITIES, F.coalesce(c, F.lit("")))


def normalize_whitespace(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), SPACE, " "))


def compound_rules(c: Column) -> Column:
    """The ordered, case-insensitive rewrites of compound terms."""
    return reduce(lambda out, rule: F.regexp_replace(out, f"(?iU){rule[0]}", rule[1]), fixed.COMPOUND_RULES, F.coalesce(c, F.lit("")))


def normalize_punctuation(c: Column) -> Column:
    """Straight quotes and hyphens, and no space around hyphens."""
    return F.regexp_replace(F.translate(F.coalesce(c, F.lit("")), fixed.CURLY, fixed.STRAIGHT), r"(?U)\s*-\s*", "-")


def normalize_text(c: Column) -> Column:
    return normalize_punctuation(compound_rules(normalize_whitespace(decode_entities(strip_html(c)))))


def strip_term_punctuation(c: Column) -> Column:
    """Drop signs from both edges, then underscores; a term of signs alone stays as it is."""
    out = F.regexp_replace(c, r"^[^\p{L}\p{N}_]+", "")
    out = F.regexp_replace(out, r"[^\p{L}\p{N}_]+$", "")
    out = F.regexp_replace(out, r"^_+|_+$", "")
    return F.coalesce(F.nullif(out, F.lit("")), c, F.lit(""))


def strip_punctuation(c: Column) -> Column:
    """Drop everything but ASCII letters and digits from both edges; may leave nothing."""
    return F.regexp_replace(c, r"^[^A-Za-z0-9]+|[^A-Za-z0-9]+$", "")


def strip_numeric_prefix(c: Column) -> Column:
    """Drop one leading number, with or without a percent sign; a term that is nothing else stays."""
    return F.coalesce(F.nullif(strip(F.regexp_replace(c, fixed.NUMERIC_PREFIX_PATTERN, "")), F.lit("")), c)


def compare_form(c: Column) -> Column:
    return F.regexp_replace(normalize_case(c), SPACE, " ")


def words(c: Column) -> Column:
    """The words of a text; an empty array for blank text."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), SPACE), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.size(words(c))


def upper_count(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[^\p{Lu}]", ""))


def find_span(text: Column, phrase: Column) -> Column:
    """Approximate (start, end) of a phrase, case-insensitive; each end is clamped to 0 by itself."""
    at = F.instr(F.lower(text), F.lower(phrase)) - 1
    end = F.when(at >= 0, at + F.length(phrase)).otherwise(-1)
    return F.struct(F.greatest(at, F.lit(0)).alias("start"), F.greatest(end, F.lit(0)).alias("end"))


def ngram_phrases(tokens: Column, longest: int = 4) -> Column:
    """Distinct n-grams of a token array, edges stripped, n ascending and then start ascending."""
    grams = [tokens]
    # zip with the tokens moved by one more place each time: a lambda that refers to tokens would split the text for each element
    for k in range(2, longest + 1):
        grams.append(F.zip_with(grams[-1], F.slice(tokens, k, F.greatest(F.size(tokens), F.lit(1))), lambda g, w: F.concat(g, F.lit(" "), w)))
    phrases = F.transform(F.array_compact(F.concat(*grams)), strip_term_punctuation)
    return F.array_distinct(F.filter(phrases, lambda p: p != ""))


def target_phrases(text: Column, longest: int = 4) -> Column:
    return ngram_phrases(words(text), longest)


def strip_fence(c: Column) -> Column:
    """Drop a Markdown fence: the first line and what follows the last fence."""
    t = strip(c)
    return F.when(t.startswith("```"), F.regexp_replace(F.regexp_replace(t, r"(?s)^[^\n]*\n", ""), r"(?s)^(.*)```.*$", "$1")).otherwise(t)
