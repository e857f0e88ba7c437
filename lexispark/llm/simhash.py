"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A fingerprint has 64 bits, so 8 bytes at fixed positions. Two fingerprints that differ in at most 2 bits differ in at
most 2 bytes: they share at least 6 of the 8 positional bytes, the guaranteed minimum.

A posting (position, byte) of one byte holds one fingerprint in 256, too many to pair. So each such list is sub-split by four bytes: of four
blocks of two adjacent bytes, at least two are shared by any linked pair, and the six pairs of blocks are the fewest sets of four positions
of which every six positions hold one. Within a sub-list (pair of blocks and its value) its own four bytes are shared and
count 4; the lists of the other four positions are read, and a pair's entries in them are tallied by a grouped count. Pairs that reach 6 are kept and
their bits verified. Equal fingerprints are one entry, so exact copies make no pairs.

A sub-list of more than LONG entries is not paired. Its members have four bytes in common and may differ in 2 of the other
32 bits, which holds exactly if they share a value at distance 1 or 0. Each member names those 33 values, and
all that name a value are linked to the least of them. That is exact, and linear in the list. These links are tallied
byte by byte and verified as well. Components come from repeated contraction (components.py).

Defined results: a null text is empty; a text without words has fingerprint zero and is linked like any other; a text of
one or two words has one shingle; repeated rows are linked; a null id belongs to its component but never names it,
unless all ids are null; an empty table gives no rows. Other columns are ignored. `keep_one` keeps one row of each
component: the smallest id (null last), of rows that share it the one whose text has the least hash, of equal rows any one.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.llm.bytesplit import slices
from lexispark.llm.components import components
from lexispark.session import scratch_table, table

SHINGLE = 3
SEED = 42
DISTANCE = 2
LEAST_SHARED = 8 - DISTANCE
#: Longest posting list whose pairs are made one by one.
LONG = 64
BLOCKS = list(itertools.combinations(range(4), 2))
#: Bit rows that are summed at a time.
_ROWS = 1 << 16


def _shingle_hashes(words: list[bytes]) -> list[int]:
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return [digest(joined, SEED)]
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    return [digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :], strict=False)]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For consecutive runs of hashes: the 64 bits that are set in over half of each run; 0 for an empty run."""
    rows = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    owner = np.repeat(np.arange(len(counts)), counts)
    ones = np.zeros((len(counts), 64), dtype=np.int64)
    for at in range(0, len(rows), _ROWS):
        own = owner[at : at + _ROWS]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        ones[own[first]] += np.add.reduceat(np.unpackbits(rows[at : at + _ROWS], axis=1), first, axis=0, dtype=np.int32)
    return np.packbits((ones * 2 > counts[:, None]).astype(np.uint8), axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(texts: pa.Array) -> pa.Array:
    """The fingerprints of the texts as signed longs."""
    out = np.zeros(len(texts), dtype=np.uint64)
    for part in slices(texts, fold=True):
        data, counts, hashes = part.data.tobytes(), [], []
        for a, b in itertools.pairwise(part.offsets.tolist()):
            found = _shingle_hashes(words) if (words := data[a:b].split()) else []
            counts.append(len(found))
            hashes += found
        out[part.first : part.first + part.rows] = majority(np.array(hashes, dtype=np.uint64), np.array(counts))
    return pa.array(out.view(np.int64))


def with_fingerprint(docs: DataFrame, out: str = "fingerprint") -> DataFrame:
    udf = F.arrow_udf(fingerprints, "long")
    return docs.withColumn(out, udf(F.coalesce(F.col("text"), F.lit(""))))


def shared_bytes(a: Column, b: Column) -> Column:
    """How many of the 8 positional bytes two fingerprints share."""
    x = a.bitwiseXOR(b)
    return sum((F.shiftrightunsigned(x, 8 * i).bitwiseAND(F.lit(255)) == 0).cast("int") for i in range(8))


def links(distinct: DataFrame) -> DataFrame:
    """Verified links (a, b) over distinct fingerprints (column fp), enough of them for the components."""
    block = lambda i: F.shiftrightunsigned(F.col("fp"), 16 * i).bitwiseAND(F.lit(0xFFFF))
    keys = F.array(*[F.lit(k << 32).bitwiseOR(F.shiftleft(block(i), 16)).bitwiseOR(block(j)) for k, (i, j) in enumerate(BLOCKS)])
    postings = distinct.select("fp", F.explode(keys).alias("key"))
    sizes = postings.groupBy("key").count().filter("count > 1")
    lists = scratch_table(postings.join(sizes, "key"), "simhash-lists")
    short, long_ = lists.filter(F.col("count") <= LONG), lists.filter(F.col("count") > LONG)
    pair = (F.shiftrightunsigned("key", 32) + 1).cast("int")
    outside = F.element_at(F.lit([[p for p in range(8) if p // 2 not in blocks] for blocks in BLOCKS]), pair)
    byte = lambda p: F.call_function("shiftrightunsigned", F.col("fp"), p * 8).bitwiseAND(F.lit(0xFF))
    bytes_ = short.select("key", "fp", F.explode(F.transform(outside, lambda p: F.struct(p.alias("position"), byte(p).alias("byte")))).alias("posting"))
    left, right = bytes_.withColumnRenamed("fp", "a"), bytes_.withColumnRenamed("fp", "b")
    tally = left.join(right, ["key", "posting"]).filter("a < b").groupBy("key", "a", "b").count()
    pairs = tally.filter(F.col("count") + 4 >= LEAST_SHARED).select("a", "b")
    free = F.element_at(
        F.array(*[F.array(*[F.lit(0), *[F.lit((1 << (16 * i + n)) - (1 << 64 if 16 * i + n == 63 else 0)) for i in range(4) if i not in blocks for n in range(16)]]).cast("array<bigint>") for blocks in BLOCKS]),
        pair,
    )
    near = long_.select("key", "fp", F.explode(F.transform(free, lambda bit: F.col("fp").bitwiseXOR(bit))).alias("value"))
    hubs = near.groupBy("key", "value").agg(F.min("fp").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    stars = near.join(hubs, ["key", "value"]).filter("fp <> hub").select(F.col("hub").alias("a"), F.col("fp").alias("b"))
    a, b = F.col("a"), F.col("b")
    candidates = pairs.union(stars.filter(shared_bytes(a, b) >= LEAST_SHARED))
    return candidates.filter(F.bit_count(a.bitwiseXOR(b)) <= DISTANCE).distinct()


def text_key() -> Column:
    """Tells the texts of rows that share an id apart."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def printed(docs: DataFrame) -> DataFrame:
    """A written table of doc_id, text_key and fp."""
    keyed = with_fingerprint(docs.select("doc_id", text_key().alias("text_key"), "text"), "fp")
    return scratch_table(keyed.select("doc_id", "text_key", "fp"), "simhash-rows")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, fingerprint (long), component_id: the smallest id that links reach."""
    rows = printed(docs)
    return named(rows, components(links(rows.select("fp").distinct())))


def firsts(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """fp, root and first for each class of rows (doc_id, text_key, fp). roots: node and root of the classes that have links.

    first is the row of the component that stays: (last, doc_id, text_key, copies), the least by id, null ids last, and text.
    """
    each = rows.groupBy("fp", "doc_id", "text_key").agg(F.count("*").alias("copies"))
    classes = each.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key", "copies")).alias("least"))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    return rooted.join(rooted.groupBy("root").agg(F.min("least").alias("first")), "root")


def named(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (doc_id, text_key, fp) with the smallest id of their component."""
    of_class = firsts(rows, roots).select("fp", F.col("first.doc_id").alias("component_id"))
    return rows.join(of_class, "fp").select("doc_id", "text_key", F.col("fp").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The documents without near-duplicates: of each component one row stays. rows and roots: as firsts() takes them."""
    key = lambda id_, text: [F.coalesce(id_.cast("string"), F.lit("")), id_.isNull(), text]
    names = ["__lx_id", "__lx_null", "__lx_text"]
    found = firsts(rows, roots).select("root", "first.*").dropDuplicates(["root"])
    stay = scratch_table(found.select(*[c.alias(n) for n, c in zip(names, key(F.col("doc_id"), F.col("text_key")), strict=True)], "copies"), "near-duplicates-stay")
    keyed = docs.withColumns(dict(zip(names, key(F.col("doc_id"), text_key()), strict=True)))
    kept = keyed.join(stay.filter("copies = 1"), names, "left_semi")
    if stay.filter("copies > 1").limit(1).count():
        kept = kept.unionByName(keyed.join(stay.filter("copies > 1"), names, "left_semi").dropDuplicates(names))
    return kept.select(*docs.columns)


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without near-duplicates by op8's links: of each component one row stays."""
    rows = printed(docs)
    return keep_first(docs, rows, components(links(rows.select("fp").distinct())))


def op8_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
