"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Each document of a source expects `target / source_size` copies. The expected copies are prefix-summed
within the source, one offset is added to the sums, and a copy is emitted for each integer that
a document's step crosses. Documents stand in the order of their size class, a salt, their size, id and a key:
neighbours are alike in size, so the words taken stay within a few of the largest documents of the target. The key hashes id and
text and the salt is the key's remainder, so ids with a stride, null ids and repeated ids are spread over the salts, and rows that
share size and id but not the text have a fixed order.

The prefix sum has two levels. A block is (source, size class, salt); its rows are numbered in a window
over the block, and the blocks' row counts are prefix-summed in a window over the source. A source that
holds a third of all rows is so spread over hundreds of blocks, and no task sees more than a block's rows
or a source's block counts. Targets depend on all sources at once: their sizes, one row each, meet in one task.

Defined results: a null text has size 0; a null source is a source of its own, ordered last; repeated rows
are separate documents (rows equal in source, size, id and text are interchangeable); a source without words has target 0 and no copies; an empty table gives no rows.
Columns of the input besides text, source and doc_id pass through; names that begin with `__lx_` are reserved.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.llm.native import text_of, unit_interval, word_count
from lexispark.session import scratch_table, table

#: Rows of a block at most, on average over the salts of a class that holds a third of all rows.
BLOCK_ROWS = 16_000
LEAST_SALTS = 16


@dataclass(frozen=True)
class Mixture:
    """weights repeat over the sources in code-point order; share is the part of all sizes to take."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    most_repeats: float = 2.0
    seed: str = "mix-1"


def size_class(size: Column) -> Column:
    """Four classes per doubling of the size, from integers alone."""
    n = size + 1
    bits = F.length(F.bin(n)).cast("int")
    return bits * 4 + F.call_function("shiftright", n, F.greatest(bits - 3, F.lit(0))).cast("int")


#: A block. The first is the source as a key that is never null and sorts a null source last.
BLOCK_KEYS = ["__lx_source", "__lx_class", "__lx_salt"]


def source_targets(blocks: DataFrame, mixture: Mixture) -> DataFrame:
    """One row per source: source_size and target.

    Targets are weight * level, stopped at most_repeats times the size. The level solves the resharing
    of the excess directly: in the order of stop / weight, the first source that the level of
    the remaining mass doesn't lift over its stop, sets the level for itself and all after it.
    """
    by_name = Window.orderBy("__lx_source")
    by_ratio = Window.orderBy("__lx_ratio", "__lx_rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    weights = F.array(*[F.lit(int(w)).cast("long") for w in mixture.weights])
    return (
        blocks.groupBy("__lx_source")
        .agg(F.sum("__lx_words").alias("source_size"))
        .withColumn("__lx_rank", F.row_number().over(by_name))
        .withColumn("__lx_weight", F.element_at(weights, (F.col("__lx_rank") - 1) % len(mixture.weights) + 1))
        .withColumn("__lx_stop", F.col("source_size") * F.lit(float(mixture.most_repeats)))
        .withColumn("__lx_ratio", F.col("__lx_stop") / F.col("__lx_weight"))
        .withColumn("__lx_mass", F.sum("source_size").over(everything) * F.lit(float(mixture.share)))
        .withColumn("__lx_left", F.col("__lx_mass") - F.coalesce(F.sum("__lx_stop").over(before), F.lit(0.0)))
        .withColumn("__lx_heavy", F.sum("__lx_weight").over(onward))
        .withColumn("__lx_stopped", F.col("__lx_stop") * F.col("__lx_heavy") <= F.col("__lx_left") * F.col("__lx_weight"))
        .withColumn("__lx_level", F.min_by(F.struct("__lx_left", "__lx_heavy"), F.when(~F.col("__lx_stopped"), F.struct("__lx_ratio", "__lx_rank"))).over(everything))
        .withColumn(
            "target",
            F.when(F.col("__lx_stopped") | F.col("__lx_level").isNull(), F.col("__lx_stop"))
            .otherwise(F.col("__lx_level.__lx_left") * F.col("__lx_weight") / F.col("__lx_level.__lx_heavy")),
        )
        .select("__lx_source", "source_size", "target")
    )


#: What with_copies needs of a text.
SIZED = ["__lx_size", "__lx_key"]


def sized(docs: DataFrame) -> DataFrame:
    """Add the size of each document and its key, 60 bits of an MD5 of id and text."""
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), text_of()))
    return docs.withColumns({"__lx_size": word_count(text_of()), "__lx_key": F.conv(F.substring(key, 1, 15), 16, 10).cast("long")})


def with_copies(docs: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """The documents, as sized() returns them, with size, source_size, target and copies added in one struct, `__lx_mix`."""
    rows = docs.count()
    salts = max(LEAST_SALTS, -(-rows // (3 * BLOCK_ROWS)))
    keyed = (
        docs.withColumn("__lx_source", F.coalesce(F.concat(F.lit("1"), F.col("source")), F.lit("2")))
        .withColumn("__lx_class", size_class(F.col("__lx_size")))
        .withColumn("__lx_salt", F.pmod("__lx_key", F.lit(salts)).cast("int"))
    )
    keys = BLOCK_KEYS
    blocks = scratch_table(
        keyed.groupBy(*keys)
        .agg(F.count("*").alias("__lx_rows"), F.sum("__lx_size").alias("__lx_words")),
        "mixing-blocks",
    )
    in_source = Window.partitionBy("__lx_source").orderBy("__lx_class", "__lx_salt")
    offsets = blocks.withColumn("__lx_before", F.sum("__lx_rows").over(in_source) - F.col("__lx_rows"))
    targets = source_targets(blocks, mixture)
    starts = (
        offsets.join(targets, "__lx_source").select(*keys, "__lx_before", F.col("source_size").alias("__lx_total"), F.col("target").alias("__lx_target"))
    )
    in_block = Window.partitionBy(*keys).orderBy("__lx_size", "doc_id", "__lx_key")
    numbered = keyed.withColumn("__lx_row", F.row_number().over(in_block))
    joined = numbered.join(starts, keys)
    each = F.when(F.col("__lx_total") > 0, F.col("__lx_target") / F.col("__lx_total")).otherwise(F.lit(0.0))
    offset = unit_interval(F.lit(mixture.seed), F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")))
    last = F.col("__lx_row") + F.col("__lx_before")
    copies = F.floor(each * last + offset) - F.floor(each * (last - 1) + offset)
    return joined.select(
        *[c for c in docs.columns if c not in SIZED],
        F.struct(
            F.col("__lx_size").alias("size"),
            F.col("__lx_total").alias("source_size"),
            F.col("__lx_target").alias("target"),
            F.least(copies, F.ceil(each)).cast("long").alias("copies"),
        ).alias("__lx_mix"),
    )


def mix(docs: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """The mixed documents: each row of docs as often as it is taken, with its own columns."""
    out = with_copies(sized(docs), mixture).filter("__lx_mix.copies > 0")
    return out.withColumn("__lx_copy", F.explode(F.sequence(F.lit(1), F.col("__lx_mix.copies")))).select(*docs.columns)


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    light = sized(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("text")
    return with_copies(scratch_table(light, "mixing-rows")).select(
        "doc_id", "__lx_mix.size", "__lx_mix.source_size", "__lx_mix.target",
        (F.col("__lx_mix.copies") * F.col("__lx_mix.size")).alias("taken"),
    )


OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS key
  FROM documents
),
keyed AS (
  SELECT *, length(bin(size + 1)) * 4 + ((size + 1) >> greatest(length(bin(size + 1)) - 3, 0)) AS cls,
         key % greatest(16, CAST(ceil((SELECT count(*) FROM documents) / 48000.0) AS BIGINT)) AS salt
  FROM sized
),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rk FROM s),
w AS (SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, source_size * 2.0::DOUBLE AS stop FROM r),
l AS (
  SELECT *, (SELECT sum(source_size) FROM s)::DOUBLE * 1.5::DOUBLE
            - coalesce(sum(stop) OVER (ORDER BY stop / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE) AS remaining,
         CAST(sum(weight) OVER (ORDER BY stop / weight, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS heavy
  FROM w
),
f AS (SELECT remaining, heavy FROM l WHERE NOT (stop * heavy <= remaining * weight) ORDER BY stop / weight, rk LIMIT 1),
t AS (
  SELECT l.source, l.source_size,
         CASE WHEN l.stop * l.heavy <= l.remaining * l.weight OR (SELECT count(*) FROM f) = 0 THEN l.stop
              ELSE (SELECT remaining FROM f) * l.weight / (SELECT heavy FROM f) END AS target,
         ('0x' || substr(md5('mix-1:' || coalesce('=' || l.source, 'null')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM l
),
n AS (
  SELECT k.*, t.source_size, t.target, t.u,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS e,
         row_number() OVER (PARTITION BY k.source ORDER BY k.cls, k.salt, k.size, k.doc_id NULLS FIRST, k.key) AS rn
  FROM keyed k JOIN t ON k.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(least(floor(e * rn + u) - floor(e * (rn - 1) + u), ceil(e)) AS BIGINT) * size AS taken
FROM n
"""
