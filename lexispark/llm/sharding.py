"""Sharding by proportional stratified interleaving, in DataFrame operations only.

Rows are shuffled within each source by a seeded hash and ranked. Row r of n in its source has
the fractional rank (2r - 1) / 2n; all rows are sorted by it and the sequence is cut into shards whose
row counts differ by one at most (the law `rows`). Any stretch of the sequence, and so every shard, holds
the sources in the proportions of the whole table, give or take one row per source and end.

Both ranks have two levels: a block is a range of the hash within a source, or a range of the fractional
rank; rows are numbered in a window over the block, and block counts are prefix-summed. A source with
a third of all rows is spread evenly over its blocks. The order is total but for rows equal in id, text and source, which are
interchangeable; reruns agree. What meets in one task is a block's rows (ids, sizes and checksums, no texts) and the counts of blocks.

Defined results: a null text has no bytes and size 8 and the checksum of the empty text; a null source is a
source of its own; repeated rows get places of their own (in the order of their checksums); an empty table gives
no rows. Other columns pass through in `shard`; names that begin with `__lx_` are reserved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexispark.llm.native import running_total, text_of
from lexispark.session import scratch_table, table

BLOCK_ROWS = 10_000
LEAST_BLOCKS = 64


def place(rows: DataFrame, shards: int = 24, seed: str = "shard-1") -> DataFrame:
    """Add shard and slot (place in the shard, from 0) to rows with doc_id, source and text_crc32."""
    total = rows.count()
    blocks = max(LEAST_BLOCKS, -(-total // BLOCK_ROWS))
    # the checksum is part of the key, so that rows without an id, or with one id, are spread over the blocks
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("text_crc32").cast("string")))
    keyed = (
        rows.withColumn("__lx_source", F.coalesce(F.concat(F.lit("1"), F.col("source")), F.lit("2"))).withColumn("__lx_key", key)
        .withColumn("__lx_block", F.floor(F.conv(F.substring("__lx_key", 1, 8), 16, 10).cast("double") * blocks / 4294967296.0).cast("int"))
    )
    counts = scratch_table(keyed.groupBy("__lx_source", "__lx_block").count(), "shard-blocks")
    in_source = Window.partitionBy("__lx_source")
    counts = counts.select(
        "__lx_source", "__lx_block",
        (F.sum("count").over(in_source.orderBy("__lx_block")) - F.col("count")).alias("__lx_before"),
        F.sum("count").over(in_source).alias("__lx_n"),
    )
    in_block = Window.partitionBy("__lx_source", "__lx_block").orderBy("__lx_key", "doc_id", "text_crc32")
    ranked = (
        keyed.withColumn("__lx_row", F.row_number().over(in_block))
        .join(counts, ["__lx_source", "__lx_block"])
        .withColumn("__lx_rank", F.col("__lx_before") + F.col("__lx_row"))
        .withColumn("__lx_fraction", (F.col("__lx_rank") * 2 - 1).cast("double") / (F.col("__lx_n") * 2).cast("double"))
        .withColumn("__lx_range", F.floor(F.col("__lx_fraction") * blocks).cast("int"))
    )
    ranges = ranked.groupBy(F.col("__lx_range").alias("__lx_r")).count()
    ranges = running_total(ranges, "__lx_r", "count", "__lx_start").drop("count")
    in_range = Window.partitionBy("__lx_range").orderBy("__lx_fraction", "__lx_source", "__lx_rank")
    return (
        ranked.withColumn("__lx_place", F.row_number().over(in_range))
        .join(ranges, F.col("__lx_range") == F.col("__lx_r"))
        .withColumn("__lx_at", F.col("__lx_start") + F.col("__lx_place") - 1)
        .withColumn("shard", F.expr(f"cast(__lx_at * {shards} div {max(total, 1)} as int)"))
        .withColumn("slot", F.expr(f"__lx_at - (cast(shard as bigint) * {total} + {shards - 1}) div {shards}"))
        .select(*rows.columns, "shard", "slot")
    )


def shard(docs: DataFrame, shards: int = 24, seed: str = "shard-1") -> DataFrame:
    """The documents with shard and slot; columns of these names in docs are replaced."""
    rows = docs.drop("shard", "slot", "text_crc32").withColumn("text_crc32", F.crc32(text_of()))
    return place(rows, shards, seed).drop("text_crc32")


def write_shards(docs: DataFrame, path: str, shards: int = 24, seed: str = "shard-1") -> None:
    """Write one folder of Parquet files per shard, rows in slot order."""
    placed = shard(docs, shards, seed)
    placed.repartitionByRange(shards, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op3_sharding(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    light = docs.select(
        "doc_id", "source",
        (F.octet_length(text_of()) + 8).cast("long").alias("size"),
        F.crc32(text_of()).alias("text_crc32"),
    )
    return place(scratch_table(light, "shard-rows")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
