"""Wide item sheets as source/target text pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexispark import fixed
from lexispark.functions.text import clean_to_null


def to_pairs(sheet: DataFrame, row_order: str = "row_no", source_locale: str = fixed.SOURCE_LOCALE, locales: list[str] | None = None) -> DataFrame:
    """One row per item, field and locale where both texts are there. Missing columns count as blank.

    row_order names the arrival order of the rows. The result has it with field_no and locale_no.
    """
    locales = [x for x in (fixed.TARGET_LOCALES if locales is None else locales) if x not in fixed.SKIPPED_LOCALES]
    cell = lambda name: clean_to_null(F.col(f"`{name}`")) if name in sheet.columns else F.lit(None).cast("string")
    cells = [
        F.struct(F.lit(f).alias("field"), F.lit(i).alias("field_no"), cell(f"{f}_{source_locale}").alias("source_text"), F.lit(x).alias("target_locale"), F.lit(k).alias("locale_no"), cell(f"{f}_{x}").alias("target_text"))
        for i, f in enumerate(fixed.FIELD_WEIGHTS)
        for k, x in enumerate(locales)
    ]
    return (
        sheet.select(F.col(row_order), cell("sys_id").alias("product_id"), cell("sys_entitytype").alias("entity_type"), F.inline_outer(F.array(*cells)))
        .filter("product_id IS NOT NULL AND entity_type IS NOT NULL AND source_text IS NOT NULL AND target_text IS NOT NULL")
        .withColumn("source_locale", F.lit(source_locale))
    )


def first_pairs(pairs: DataFrame, row_order: str = "row_no") -> DataFrame:
    """The first pair of each field and two texts. The locale is not part of the key: a repeat in another locale goes.

    Two grouped minima, so that a text which many items share is combined before the shuffle: the first item of each key, hashed, as its order is a number as a rule, then the first pair
    among that item's pairs, which alone are sorted.
    """
    key = ["field", "source_text", "target_text"]
    rest = [c for c in pairs.columns if c not in key]
    # nulls come first, as in the order of structs
    item = F.when(F.max(F.col(row_order).isNull()), None).otherwise(F.min(row_order))
    items = pairs.groupBy(*key).agg(item.alias("__item")).select(*[F.col(c).alias(f"__{c}") for c in key], "__item")
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key] + [F.col(row_order).eqNullSafe(F.col("__item"))]
    first = F.min_by(F.struct(*rest), F.struct(row_order, "field_no", "locale_no"))
    found = pairs.join(items, same, "left_semi").groupBy(*key).agg(first.alias("__r"))
    return found.select(*[F.col(c) if c in key else F.col(f"__r.{c}").alias(c) for c in pairs.columns])


def limited(pairs: DataFrame, limit: int, row_order: str = "row_no") -> DataFrame:
    """The first pairs in arrival order; a locale filter, if any, comes after this."""
    return pairs.orderBy(row_order, "field_no", "locale_no").limit(limit)


def with_lead(rows: DataFrame, key: str, order: str, first: str, then: str) -> DataFrame:
    """Pairs of neighbouring rows whose roles are first and then: source_text and target_text."""
    w = Window.partitionBy(key).orderBy(order)
    return (
        rows.withColumns({"__role": F.lead("role").over(w), "__text": F.lead("text").over(w)})
        .filter((F.col("role") == first) & (F.col("__role") == then))
        .select(F.col(key), F.col(order), F.col("text").alias("source_text"), F.col("__text").alias("target_text"))
    )
