"""Search for parts of texts by an index of trigrams.

A posting is a trigram of the lower-cased text of a field, the field's number and the keys of the rows of a slice that hold it; the table is sorted by trigram, so a search
reads the row groups of the trigrams it needs. Slices have about SLICE_CHARS characters, so the rows that are shuffled and sorted are a trigram's in a slice, not a trigram's in a text, and no list
is longer than a slice's rows. Postings of the rarest trigrams of a pattern are intersected, and the rows that remain are compared
with the pattern itself: the result equals a scan. A pattern without three characters in a row between its wildcards has no trigram and scans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.session import drop_scratch, scratch_table

#: Trigrams of a pattern that are intersected: the rarest ones. More would read longer lists to leave out fewer rows.
RAREST = 4
#: Up to this number of rows, their keys become a filter of the scan; beyond it, a semi join.
MOST_KEYS = 1000
#: Characters whose trigrams are sorted together in a task, and rows at most.
SLICE_CHARS = 1 << 20
SLICE_ROWS = 1 << 16
_BITS = 21  # of a code point


@dataclass(frozen=True)
class Index:
    """postings: gram, field, keys; counts: gram, n. It describes the rows it was built from, and is built anew for other ones."""

    postings: DataFrame
    counts: DataFrame
    key: str
    fields: tuple[str, ...]

    def write(self, path: str) -> None:
        ordered(self.postings, "gram", "field", F.get("keys", F.lit(0))).write.mode("overwrite").parquet(f"{path}/postings")
        ordered(self.counts, "gram").write.mode("overwrite").parquet(f"{path}/counts")


def ordered(df: DataFrame, *by: str | Column) -> DataFrame:
    # Ranges of trigram and key: the list of a trigram that most rows hold spreads over several files.
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def read(spark: SparkSession, path: str, key: str, fields: list[str]) -> Index:
    return Index(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/counts"), key, tuple(fields))


def _codes(text: str) -> np.ndarray:
    """The trigrams of a text as numbers, in their places."""
    c = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.int64)
    return c[:-2] << 2 * _BITS | c[1:-1] << _BITS | c[2:]


def _grams(codes: np.ndarray) -> list[str]:
    low = (1 << _BITS) - 1
    joined = np.stack([codes >> 2 * _BITS, codes >> _BITS & low, codes & low], axis=1).astype("<u4").tobytes().decode("utf-32-le")
    return [joined[i : i + 3] for i in range(0, len(joined), 3)]


def _held(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts: the distinct trigrams, where the list of each begins (and the last ends), and the lists: the numbers of the texts that hold it."""
    if len(texts) == 1:  # a text of any length, piece by piece
        parts = [np.unique(_codes(texts[0][at : at + SLICE_CHARS + 2])) for at in range(0, len(texts[0]), SLICE_CHARS)]
        found = np.unique(np.concatenate(parts))
        return found, np.arange(len(found) + 1), np.zeros(len(found), dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    codes = _codes("".join(texts))
    inside = owner[:-2] == owner[2:]
    found, at = np.unique(codes[inside], return_inverse=True)
    pairs = np.sort(at * len(texts) + owner[:-2][inside])
    pairs = pairs[np.diff(pairs, prepend=-1) > 0]
    return found, np.searchsorted(pairs, np.arange(len(found) + 1) * len(texts)), pairs % len(texts)


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """gram, field, keys of batches of a key and lower-cased texts."""
    for batch in batches:
        for field in range(batch.num_columns - 1):
            texts = batch.column(field + 1).to_pylist()
            some = [i for i, t in enumerate(texts) if t is not None and len(t) > 2]
            ends = np.cumsum([len(texts[i]) for i in some])
            at = 0
            while at < len(some):
                # a text that is longer than a slice is alone in one
                to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_CHARS, side="right"))
                to = min(max(at + 1, to), at + SLICE_ROWS)
                found, starts, held = _held([texts[i] for i in some[at:to]])
                keys = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), batch.column(0).take(pa.array(np.array(some[at:to])[held])))
                yield pa.RecordBatch.from_arrays([pa.array(_grams(found), pa.string()), pa.array(np.full(len(found), field, dtype=np.int32)), keys], ["gram", "field", "keys"])
                at = to


def build(rows: DataFrame, key: str, fields: list[str]) -> Index:
    """The index of the fields of rows whose key is unique. Rows without a key are not in it."""
    # Lower-cased by Spark, as patterns are. The lists are written before they are sorted, as the sort by ranges reads its input twice.
    texts = rows.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), *[F.lower(F.col(c)).alias(f"f{i}") for i, c in enumerate(fields)])
    schema = f"gram string, field int, keys array<{texts.schema['key'].dataType.simpleString()}>"
    lists = scratch_table(texts.mapInArrow(_lists, schema), "trigram-lists")
    postings = scratch_table(ordered(lists, "gram", "field", F.get("keys", F.lit(0))), "trigram-postings")
    drop_scratch(lists)
    counts = scratch_table(ordered(postings.groupBy("gram").agg(F.sum(F.size("keys")).alias("n")), "gram"), "trigram-counts")
    return Index(postings, counts, key, tuple(fields))


def pattern(value: str) -> Column:
    """The value anywhere in a text; % and _ in it are wildcards, a backslash is itself."""
    return F.lit("%" + value.replace("\\", "\\\\") + "%")


def contains(fields: list[str] | tuple[str, ...], value: str) -> Column:
    """Any of the fields contains the value, in any case."""
    return reduce(Column.__or__, (F.ilike(c, pattern(value)) for c in fields))


def pattern_grams(spark: SparkSession, value: str) -> list[str]:
    """The trigrams that every text with the value holds: those between its wildcards."""
    # Lower-cased by Spark, as the texts are. A wildcard's neighbours need not be neighbours in a text.
    lowered = spark.range(1).select(F.lower(pattern(value.replace("\\", "_")))).first()[0]
    return sorted({piece[i : i + 3] for piece in re.split("[%_]", lowered) for i in range(len(piece) - 2)})


def search(rows: DataFrame, index: Index, value: str, most_keys: int = MOST_KEYS) -> DataFrame:
    """The rows any of whose indexed fields contains the value; equal to `rows.filter(contains(fields, value))` for rows with a key."""
    spark, key, holds = rows.sparkSession, index.key, contains(index.fields, value) & F.col(index.key).isNotNull()
    needed = pattern_grams(spark, value)
    if not needed:
        return rows.filter(holds)
    known = {r.gram: r.n for r in index.counts.filter(F.col("gram").isin(needed)).collect()}
    if len(known) < len(needed):
        return rows.filter(F.lit(False))
    rare = sorted(needed, key=lambda g: (known[g], g))[:RAREST]
    lists = index.postings.filter(F.col("gram").isin(rare)).select("field", F.explode_outer("keys").alias(key)).groupBy(key, "field").agg(F.count("*").alias("n"))
    keys = lists.filter(F.col("n") == len(rare)).select(key).distinct()
    first = [r[0] for r in keys.limit(most_keys + 1).collect()]
    if len(first) <= most_keys:
        return rows.filter(F.col(key).isin(first) & holds)
    return rows.join(keys, key, "left_semi").filter(holds)
