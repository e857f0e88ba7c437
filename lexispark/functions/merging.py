"""Rules that decide whether two similar terms are one, as Column expressions.

A variant rule is a row of a table: what is taken for the same, when that counts, and which of the two spellings stays.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexispark import fixed
from lexispark.functions.text import SPACE, compare_form, strip_punctuation


@dataclass(frozen=True)
class Variant:
    """Two terms are variants if they are equal once `same` is replaced by `by`; the first that has (or with `lacks`, hasn't) `keep` stays, else the second.

    needs: where neither compare form holds this text, the replacement makes no terms equal that weren't. It saves the replacement for most pairs.
    differ: terms of one compare form aren't variants. marked: one of them must have `keep`. squeeze: white space that the replacement leaves is squeezed.
    """

    reason: str
    same: str
    by: str
    keep: str
    needs: str
    lacks: bool = False
    differ: bool = True
    marked: bool = False
    squeeze: bool = False


FINAL_PERIOD = Variant("final period", r"\.+$", "", r"\.$", ".", lacks=True, differ=False)
#: In the order in which they are asked.
VARIANTS = [
    Variant("hyphen or space", "-", " ", "-", "-"),
    Variant("percent sign", "%", "", "%", "%", differ=False, marked=True, squeeze=True),
    Variant("contain or contains", r"\bcontains\b", "contain", r"(?i)\bcontains\b", "contains"),
    Variant("space before a unit", "([0-9])([a-zA-Z])", "$1 $2", "[0-9] [a-zA-Z]", " "),
    FINAL_PERIOD,
]


def variant(rule: Variant, a: Column, b: Column, legacy: bool = False) -> Column:
    """The spelling that stays if the rule applies, else null. legacy: for the final period, a second term that ends in one always counts."""
    return _variant(rule, a, b, compare_form(a), compare_form(b), legacy)


def _variant(rule: Variant, a: Column, b: Column, x: Column, y: Column, legacy: bool) -> Column:
    replaced = [F.regexp_replace(c, rule.same, rule.by) for c in (x, y)]
    if rule.squeeze:
        replaced = [F.trim(F.regexp_replace(c, SPACE, " ")) for c in replaced]
    counts = F.when(F.contains(x, F.lit(rule.needs)) | F.contains(y, F.lit(rule.needs)), replaced[0] == replaced[1]).otherwise(x == y)
    if legacy and rule is FINAL_PERIOD:
        counts = counts | (replaced[1] != y)
    if rule.differ:
        counts = (x != y) & counts
    if rule.marked:
        counts = (F.contains(a, F.lit(rule.keep)) | F.contains(b, F.lit(rule.keep))) & counts
    stays = ~a.rlike(rule.keep) if rule.lacks else a.rlike(rule.keep)
    return F.when(counts, F.when(stays, a).otherwise(b))


def synonym(a: Column, b: Column) -> Column:
    """Of a known pair of synonyms, in either order, the term that is the preferred form, else the second; null for other pairs."""
    return _synonym(a, b, compare_form(a), compare_form(b))


def _synonym(a: Column, b: Column, x: Column, y: Column) -> Column:
    table = F.array(*[F.struct(F.lit(f"{s}|{t}").alias("pair"), F.lit(best).alias("best")) for one, two, best in fixed.SYNONYMS for s, t in ((one, two), (two, one))])
    pair = F.concat(x, F.lit("|"), y)
    known = F.get(F.filter(table, lambda r: r["pair"] == pair), F.lit(0))["best"]
    listed = [f"{s}|{t}" for one, two, _ in fixed.SYNONYMS for s, t in ((one, two), (two, one))]
    return F.when(pair.isin(listed), F.when(x == known, a).otherwise(b))


def decide(a: Column, b: Column, legacy: bool = False) -> Column:
    """(action, canonical, reason) for a pair of terms at a small edit distance; the first rule that applies: synonyms, different numbers, variants.

    The compare forms are bound to lambda variables, so that they are made once for all rules.
    """
    one = F.array(F.struct(a.alias("a"), b.alias("b"), compare_form(a).alias("x"), compare_form(b).alias("y")))
    return F.get(F.transform(one, lambda p: _decided(p["a"], p["b"], p["x"], p["y"], legacy)), F.lit(0))


def _decided(a: Column, b: Column, x: Column, y: Column, legacy: bool) -> Column:
    none, numbers = F.lit(None).cast("string"), F.lit("([0-9]+)")
    unlike = F.regexp_extract_all(a, numbers, F.lit(1)) != F.regexp_extract_all(b, numbers, F.lit(1))
    verdict = lambda canonical, reason: F.struct(F.when(canonical.isNull(), "keep_separate").otherwise("merge").alias("action"), canonical.alias("canonical"), F.lit(reason).alias("reason"))
    # a rule's verdict is its name and spelling at once; each is asked once
    asked = [(_synonym(a, b, x, y), "synonyms"), (F.when(unlike, F.lit("")), None), *((_variant(v, a, b, x, y, legacy), v.reason) for v in VARIANTS)]
    found = [F.when(c.isNotNull(), verdict(none, "different numbers")) if reason is None else F.get(F.filter(F.array(verdict(c, reason)), lambda v: v["canonical"].isNotNull()), F.lit(0)) for c, reason in asked]
    return F.coalesce(*found, verdict(none, "no rule applies"))


def decide_punctuation(terms: Column) -> Column:
    """The canonical form of terms that differ in edge signs: the first clean one, else the first of the shortest."""
    clean = F.get(F.filter(terms, lambda t: strip_punctuation(t) == t), F.lit(0))
    shortest = F.array_min(F.transform(terms, lambda t: F.length(t)))
    return F.coalesce(clean, F.get(F.filter(terms, lambda t: F.length(t) == shortest), F.lit(0)))
