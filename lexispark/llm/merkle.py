"""Document fingerprints by Merkle trees, in DataFrame operations only.

Leaves are the clauses of a paragraph: its text cut behind each sign of `.!?,;:|%&#*$` that a space follows, or each of its words
if it has no such sign. A paragraph is a line. Paragraphs are grouped into sections by content: a section ends behind a paragraph whose hash ends in
0, 4, 8 or c, so that an insertion moves section borders only near itself. The root hashes the section
hashes. The fingerprint is `root/index/leaves`: the index has `number:hash` for each section, the number being that of its first
paragraph, joined by commas; the leaves have the sections joined by `;`, their paragraphs by a space, the leaf hashes of
a paragraph by `,`. Hashes of paragraphs follow from the leaves and are not stored.

Equal texts have equal roots and fingerprints. `with_differing` walks two trees from the root down: equal roots end it, sections
of equal hashes are left out, and of the others it returns the paragraphs whose branches the other text's differing sections lack.
Both steps sort hashes, so they take n log n in the paragraphs. Likeness is 2 |A and B| / (|A| + |B|) over the distinct leaf hashes.

The next document is found without one global window: ids are cut into ranges of about equal counts (native.cut_ranges: any number of
ranges, and an id or null that many rows share is cut by the text hash). A window over the range gives all but its last row their
successors; the last row's is the first row of the next range, found by a join of one row per range.

Defined results: a null text is empty; the tree of an empty text has one empty leaf; equal texts are alike by 1; rows that
repeat an id follow each other in the order of a text hash; a null id comes first; a table of one row is its own
successor; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.llm.native import cut_ranges, text_of
from lexispark.session import scratch_table, table

LEAF_HEX = 12
SECTION_HEX = 16
LEAF_CUT = r"(?<=[.!?,;:|%&#*$]) "
#: Rows of an id range on average; a window over a range stays in memory.
RANGE_ROWS = 2_000


def paragraphs(text: Column) -> Column:
    """Array of strings: for each line the hashes of its clauses, joined by commas."""
    leaf = lambda s: F.substring(F.md5(s), 1, LEAF_HEX)
    cut = lambda p: F.split(p, F.when(p.rlike(LEAF_CUT), F.lit(LEAF_CUT)).otherwise(F.lit(" ")))
    return F.transform(F.split(text, "\n"), lambda p: F.array_join(F.transform(cut(p), leaf), ","))


def with_fingerprint(df: DataFrame, text: Column, out: str) -> DataFrame:
    """Add the fingerprint of a text as column out."""
    par, ends, parts, hashes = (f"__lx_{k}_{out}" for k in ("p", "e", "s", "h"))
    p, e = F.col(par), F.col(ends)
    last = lambda x, i: (i + 1 == F.size(p)) | F.substring(F.md5(x), -1, 1).isin("0", "4", "8", "c")
    first = lambda j: F.when(j > 0, F.get(e, j - 1)).otherwise(0)
    return (
        df.withColumn(par, paragraphs(text))
        .withColumn(ends, F.array_compact(F.transform(p, lambda x, i: F.when(last(x, i), i + 1))))
        .withColumn(parts, F.transform(e, lambda x, j: F.array_join(F.slice(p, first(j) + 1, x - first(j)), " ")))
        .withColumn(hashes, F.transform(parts, lambda s: F.substring(F.md5(s), 1, SECTION_HEX)))
        .withColumn(
            out,
            F.concat_ws("/", F.md5(F.array_join(hashes, "")), F.array_join(F.transform(hashes, lambda h, j: F.concat_ws(":", first(j).cast("string"), h)), ","), F.array_join(parts, ";")),
        )
        .drop(par, ends, parts, hashes)
    )


def leaves(fingerprint: Column) -> Column:
    return F.array_distinct(F.split(F.substring_index(fingerprint, "/", -1), "[;, ]"))


def likeness(a: Column, b: Column) -> Column:
    """2 |A and B| / (|A| + |B|) of two leaf arrays without repeats."""
    return F.size(F.array_intersect(a, b)) * 2.0 / (F.size(a) + F.size(b))


def sections(fingerprint: Column, side: int) -> Column:
    """The sections of a fingerprint as structs (hash, side, at: number of the first paragraph, paragraphs: joined by spaces)."""
    index = F.split(F.substring_index(F.substring_index(fingerprint, "/", 2), "/", -1), ",")
    body = F.split(F.substring_index(fingerprint, "/", -1), ";")
    return F.transform(
        F.arrays_zip(index.alias("i"), body.alias("s")),
        lambda x: F.struct(
            F.substring_index(x["i"], ":", -1).alias("hash"), F.lit(side).alias("side"), F.substring_index(x["i"], ":", 1).cast("int").alias("at"), x["s"].alias("paragraphs")
        ),
    )


def only_in(ordered: str, side: int, key: str) -> Column:
    """Of a sorted array of structs (key, side, ...): the first of each key that the other side lacks, if it stands on this side.

    With side 1, keys of side 0 sort before it; with side 0, a key is lacked if no entry of side 1 follows its last.
    """
    x = F.col(ordered)
    at = lambda k: F.get(x, k)
    if side:
        alone = lambda k: (at(k)["side"] == 1) & ((k == 0) | (at(F.greatest(k - 1, F.lit(0)))[key] != at(k)[key]))
    else:
        alone = lambda k: (at(k)["side"] == 0) & ((k + 1 == F.size(x)) | (at(F.least(k + 1, F.size(x) - 1))[key] != at(k)[key]))
    return F.transform(F.filter(F.sequence(F.lit(0), F.size(x) - 1), alone), at)


def with_differing(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Add the numbers (from 0) of the paragraphs of fingerprint b that a lacks, each differing branch at its first place; none if the roots are equal."""
    both, only_a, only_b, found = (f"__lx_{k}_{out}" for k in ("both", "a", "b", "found"))
    root = lambda c: F.substring_index(c, "/", 1)
    leaf = lambda s, side: F.transform(
        F.split(s["paragraphs"], " "), lambda p, i: F.struct(p.alias("branch"), F.lit(side).alias("side"), (s["at"] + i).alias("at"))
    )
    differ = root(a) != root(b)
    return (
        df.withColumn(both, F.when(differ, F.array_sort(F.concat(sections(F.col(a), 0), sections(F.col(b), 1)))))
        .withColumns({only_a: only_in(both, 0, "hash"), only_b: only_in(both, 1, "hash")})
        .withColumn(found, F.when(differ, F.array_sort(F.concat(F.flatten(F.transform(only_a, lambda s: leaf(s, 0))), F.flatten(F.transform(only_b, lambda s: leaf(s, 1)))))))
        .withColumn(found, F.when(F.size(found) > 0, F.col(found)))
        .withColumn(out, F.coalesce(F.array_sort(F.transform(only_in(found, 1, "branch"), lambda x: x["at"])), F.expr("cast(array() as array<int>)")))
        .drop(both, only_a, only_b, found)
    )


def with_next(docs: DataFrame, rows_each: int = RANGE_ROWS) -> DataFrame:
    """doc_id, text and next_text, the text of the document with the next id (after the last: the first)."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn("__lx_tie", F.xxhash64("text"))
    ranges = cut_ranges(ids, "doc_id", rows_each)
    keys = ["__lx_group", "__lx_number"]
    rows = ids.withColumns({"__lx_group": ranges.group(F.col("doc_id")), "__lx_number": ranges.number(F.col("doc_id"), F.col("__lx_tie"))})
    first = F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "__lx_tie")).alias("__lx_first")
    firsts = scratch_table(rows.groupBy(*keys).agg(first), "merkle-ranges")
    # the range after each: within its group, and behind the group's last the first range of the next group, of which there are some thousand at most
    in_group = Window.partitionBy("__lx_group").orderBy("__lx_number")
    groups = firsts.groupBy(F.col("__lx_group").alias("__lx_g")).agg(F.min("__lx_number").alias("low"))
    over = Window.orderBy("__lx_g")
    start = F.struct(F.col("__lx_g").alias("__lx_group"), F.col("low").alias("__lx_number"))
    groups = groups.select("__lx_g", F.coalesce(F.lead(start).over(over), F.first(start).over(over)).alias("after"))
    follows = (
        firsts.withColumn("later", F.lead(F.struct(*keys)).over(in_group)).join(groups, F.col("__lx_group") == F.col("__lx_g"))
        .select(*keys, F.coalesce("later", "after").alias("next"))
    )
    heads = (
        rows.join(firsts, keys).filter(F.col("doc_id").eqNullSafe(F.col("__lx_first.doc_id")) & (F.col("__lx_tie") == F.col("__lx_first.__lx_tie")))
        .groupBy(*keys).agg(F.min("text").alias("head"))
    )
    heads = heads.select(F.struct(*keys).alias("next"), "head")
    wanted = follows.join(heads, "next").select(*keys, "head")
    order = Window.partitionBy(*keys).orderBy(F.col("doc_id").asc_nulls_first(), "__lx_tie", "text")
    return rows.withColumn("__lx_lead", F.lead("text").over(order)).join(wanted, keys).select("doc_id", "text", F.coalesce("__lx_lead", "head").alias("next_text"))


def compare_with_edit(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last half the next document's beginning replaces."""
    half = F.floor(F.length("text") / 2).cast("int")
    rows = with_next(docs).withColumn(
        "__lx_edited", F.concat(F.substr("text", F.lit(1), F.length("text") - half), F.substr("next_text", F.lit(1), half))
    )
    rows = with_fingerprint(rows, F.col("text"), "fingerprint")
    rows = with_fingerprint(rows, F.col("__lx_edited"), "edited_fingerprint")
    rows = with_fingerprint(rows, F.col("next_text"), "__lx_next")
    rows = rows.withColumns({f"__lx_{k}": leaves(F.col(c)) for k, c in (("a", "fingerprint"), ("b", "edited_fingerprint"), ("c", "__lx_next"))})
    rows = with_differing(rows, "fingerprint", "edited_fingerprint", "edited_paragraphs")
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("__lx_edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("__lx_a"), F.col("__lx_b")).alias("near_edited"),
        likeness(F.col("__lx_a"), F.col("__lx_c")).alias("near_next"),
        "edited_paragraphs",
    )


def op7_fingerprints(spark, sf_dir: str) -> DataFrame:
    found = compare_with_edit(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumn("edited_paragraphs", F.array_join(F.col("edited_paragraphs").cast("array<string>"), ","))
