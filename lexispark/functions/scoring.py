"""Scores, statuses, domains and vector arithmetic as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexispark import fixed


def lookup(table: dict, key: Column, default) -> Column:
    """A small fixed table as a map literal."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def field_weight(field: Column) -> Column:
    return lookup(fixed.FIELD_WEIGHTS, F.coalesce(field, F.lit("")), fixed.UNKNOWN_WEIGHT)


def domain_priority(domain: Column) -> Column:
    return lookup(fixed.DOMAIN_PRIORITY, F.coalesce(domain, F.lit("")), fixed.UNKNOWN_WEIGHT)


def final_score(similarity: Column, frequency: Column, field: Column, domain: Column, consistency: Column | None = None, full_frequency: int = fixed.FULL_FREQUENCY) -> Column:
    """The weighted score of a candidate, rounded to 4 places. The order of the additions is part of the result."""
    w = fixed.SCORE_WEIGHTS
    consistency = F.lit(fixed.DEFAULT_CONSISTENCY) if consistency is None else F.coalesce(consistency, F.lit(fixed.DEFAULT_CONSISTENCY))
    brand = F.when(F.coalesce(domain, F.lit("general")) != "general", 1.0).otherwise(0.5)
    total = (
        w["similarity"] * similarity
        + w["frequency"] * F.least(frequency / F.lit(float(full_frequency)), F.lit(1.0))
        + w["field"] * field_weight(field)
        + w["domain"] * domain_priority(domain)
        + w["consistency"] * consistency
        + w["brand"] * brand
    )
    return F.round(total, 4)


def review_status(score: Column, similarity: Column) -> Column:
    return (
        F.when((similarity >= fixed.APPROVE_SIMILARITY) & (score >= fixed.APPROVE_SCORE), "approved")
        .when(similarity < fixed.REJECT_SIMILARITY, "rejected")
        .otherwise("needs_review")
    )


def classify_domain(term: Column) -> Column:
    """The domain of a term: the last seed list that holds it, else the first seed that contains it or that it contains.

    The normalised term is bound to a lambda variable: an expression that a lambda refers to would be evaluated for each seed.
    """
    from lexispark.functions.text import normalize_case

    return F.get(F.transform(F.array(normalize_case(term)), domain_of), F.lit(0))


def domain_of(t: Column) -> Column:
    """classify_domain for a normalised term, a column or variable by itself.

    The seeds are looked through one by one only where one can fit: a term that holds a seed holds one of the innermost seeds, and a seed that holds the term is part of all seeds put together.
    """
    seeds = [(s.lower().strip(), d) for d, many in fixed.DOMAIN_SEEDS.items() for s in many]
    names = list(dict(seeds))
    innermost = [s for s in names if not any(other in s for other in names if other != s)]
    together = F.lit("\n".join(names))
    table = F.array(*[F.struct(F.lit(s).alias("seed"), F.lit(d).alias("domain")) for s, d in seeds])
    exact = F.create_map(*[F.lit(x) for kv in dict(seeds).items() for x in kv])
    near = F.get(F.filter(table, lambda s: F.contains(s["seed"], t) | F.contains(t, s["seed"])), F.lit(0))["domain"]
    may = reduce(lambda out, s: out | F.contains(t, F.lit(s)), innermost, F.contains(together, t))
    return F.coalesce(F.when(may, F.coalesce(F.try_element_at(exact, t), near)), F.lit("general"))


def dot(a: Column, b: Column) -> Column:
    """Inner product in doubles, whatever the arrays hold."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
