"""Column building blocks that the native operators share. No Python runs on the executors."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A word: code points outside the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def unit_interval(*parts: Column) -> Column:
    """A pseudo-random double in [0, 1) that the parts alone decide: 32 bits of their MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def running_total(rows: DataFrame, order: str, value: str, out: str, step: int = 4096) -> DataFrame:
    """Add the sum of value over all rows of smaller order (integers from 0, each once) without one window over all rows: within steps, and over the steps."""
    cut = rows.withColumn("__lx_step", F.floor(F.col(order) / step))
    within = Window.partitionBy("__lx_step").orderBy(order)
    sums = cut.groupBy("__lx_step").agg(F.sum(value).alias("__lx_sum"))
    over = sums.select("__lx_step", (F.sum("__lx_sum").over(Window.orderBy("__lx_step")) - F.col("__lx_sum")).alias("__lx_base"))
    return cut.withColumn(out, F.sum(value).over(within) - F.col(value)).join(over, "__lx_step").withColumn(out, F.col(out) + F.col("__lx_base")).drop("__lx_step", "__lx_base")


#: Quantiles that cut a column into groups; groups are cut further by arithmetic, so that a plan's size doesn't grow with the table.
GROUPS = 1024


@dataclass(frozen=True)
class Ranges:
    """A column cut into ranges in its own order: group number, then a number within the group. Null is group 0."""

    total: int
    starts: tuple[int, ...]
    ends: tuple[int, ...]
    cuts: tuple[int, ...]

    def group(self, col: Column) -> Column:
        return F.when(col.isNull(), 0).otherwise(range_bucket(col, list(self.starts[1:])) + 1)

    def number(self, col: Column, tie: Column) -> Column:
        """Within a group, ranges have equal widths. A group of one value, which so many rows share, is cut by the tie instead (a long, the second key of the order)."""
        at = self.group(col)
        pick = lambda values: F.element_at(F.lit(np.array(values, dtype=np.float64)), at + 1)
        # a group of one value has width 0 here; null is one as well
        widths = [0.0, *[float(e - s) if e - s > 1 else 0.0 for s, e in zip(self.starts, self.ends, strict=True)]]
        start, width, cuts = pick([0.0, *map(float, self.starts)]), pick(widths), pick(self.cuts)
        share = F.when(width == 0.0, tie.cast("double") / 2.0**64 + 0.5).otherwise((col.cast("double") - start) / F.greatest(width, F.lit(1.0)))
        return F.greatest(F.least(F.floor(share * cuts), cuts - 1), F.lit(0)).cast("long")


def cut_ranges(df: DataFrame, col: str, rows_each: int) -> Ranges:
    """Ranges of about so many rows of a long column. One aggregate; at most GROUPS numbers reach the driver."""
    at = [i / GROUPS for i in range(1, GROUPS)]
    c = F.col(col)
    got = df.agg(F.count("*").alias("n"), F.count(c).alias("known"), F.min(c).alias("low"), F.max(c).alias("high"), F.percentile_approx(c, at, 10 * GROUPS).alias("p")).first()
    cuts = [max(1, -(-(got["n"] - got["known"]) // rows_each))]
    if not got["known"]:
        return Ranges(got["n"], (), (), tuple(cuts))
    low, high = got["low"], got["high"]
    times = Counter(got["p"])
    points = sorted({low, *times, *(v + 1 for v, k in times.items() if k > 1 and v < high)})
    ends = [*points[1:], high + 1 if high < (1 << 63) - 1 else high]
    held = sorted(times.elements())
    counts = np.searchsorted(held, ends) - np.searchsorted(held, points)
    cuts += [max(1, int(-(-(k + 1) * got["known"] // (GROUPS * rows_each)))) for k in counts]
    return Ranges(got["n"], tuple(points), tuple(ends), tuple(cuts))


def range_bucket(col: Column, splits: list[int], fan: int = 64) -> Column:
    """The number of splits at or below the value; two short scans instead of one over all splits."""
    if not splits:
        return F.lit(0)
    count = lambda values: F.size(F.filter(values, lambda s: s <= col))
    if len(splits) <= fan:
        found = count(F.lit(np.array(splits, dtype=np.int64)))
    else:
        groups = [splits[i : i + fan] for i in range(0, len(splits), fan)]
        group = count(F.lit(np.array([g[0] for g in groups[1:]], dtype=np.int64)))
        nested = F.array(*[F.lit(np.array(g, dtype=np.int64)) for g in groups])
        found = group * fan + count(F.element_at(nested, group + 1))
    return F.when(col.isNull(), 0).otherwise(found)
