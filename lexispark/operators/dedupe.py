"""Duplicate terms: case folding, edge signs, banded edit distance, merge decisions and the canonical map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark import fixed
from lexispark.functions import merging
from lexispark.functions import text as T
from lexispark.functions.validity import is_measurement
from lexispark.session import scratch_table

#: Rows of a block of the sorted sequence: about as many as each is paired with.
BLOCK_ROWS = 128
#: First characters of the sort key that name a bucket when ranks are counted.
BUCKET_CHARS = 3


def case_canonical(terms: DataFrame, term: str = "term") -> DataFrame:
    """term, canonical, group_size: the lower-case spelling if there, else the one with the fewest capitals, the first on ties."""
    distinct = terms.select(F.col(term).alias("term")).filter("term IS NOT NULL").distinct().withColumn("norm", T.normalize_case(F.col("term")))
    best = F.min_by("term", F.struct(F.col("term") != F.col("norm"), T.upper_count(F.col("term")), F.col("term")))
    groups = distinct.groupBy("norm").agg(best.alias("canonical"), F.count("*").alias("group_size"))
    return distinct.join(groups, "norm").select("term", "canonical", "group_size")


def punctuation_groups(terms: DataFrame, term: str = "term") -> DataFrame:
    """stripped, members, size: terms that are equal once signs at their edges are gone, with the clean form if it is a term."""
    t = terms.select(F.col(term).alias("term")).distinct().withColumn("stripped", T.strip_punctuation(F.col("term"))).filter("stripped <> ''")
    # counted first: most forms have one term, and lists are gathered for the rest only
    shared = t.groupBy("stripped").agg(F.count("*").alias("size")).filter("size > 1")
    groups = t.join(shared, "stripped").groupBy("stripped", "size").agg(F.array_sort(F.collect_list("term")).alias("members"))
    return groups.select("stripped", "members", "size")


def with_rank(rows: DataFrame, key: Column, tie: str) -> DataFrame:
    """Number rows from 0 in the order of (key, tie) without one global window.

    Rows are numbered within buckets of the key's first characters, and the buckets' counts are prefix-summed.
    """
    keyed = rows.withColumn("__key", key).withColumn("__bucket", F.substring("__key", 1, BUCKET_CHARS))
    sizes = keyed.groupBy("__bucket").agg(F.count("*").alias("__n"))
    before = sizes.select("__bucket", (F.sum("__n").over(Window.orderBy("__bucket")) - F.col("__n")).alias("__before"))
    number = F.row_number().over(Window.partitionBy("__bucket").orderBy("__key", tie))
    return keyed.withColumn("__row", number).join(before, "__bucket").withColumn("rank", F.col("__before") + F.col("__row") - 1).drop("__row", "__before", "__bucket")


def placed(terms: DataFrame, keys: dict[str, Column], term: str = "term") -> DataFrame:
    """A stored row for each term: t, its rank by each of the keys, and what pairs are compared by, made once for each term.

    low: the lower-case form; size: its own length; signs: a bit for each character of low. An edit changes at most two of those bits.
    """
    rows = scratch_table(terms.select(F.col(term).alias("t")).filter("t IS NOT NULL").distinct(), "dedupe-terms")
    for name, key in keys.items():
        rows = with_rank(rows, key, "t").withColumnRenamed("rank", f"__{name}").drop("__key")
    rows = rows.withColumnsRenamed({f"__{name}": name for name in keys})
    signs = F.aggregate(F.split("low", ""), F.lit(0).cast("long"), lambda bits, c: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(c) % 64)))
    return rows.withColumn("low", F.lower("t")).withColumn("size", F.length("t")).withColumn("signs", signs)


def near(rows: DataFrame, rank: str, width: int, holds: Column | None = None) -> DataFrame:
    """Pairs of placed rows as structs a and b: b is one of the next `width` in the order of the rank, of about a's length; holds, if any, is asked of those.

    The sequence is cut into blocks by rank. A row is an a in its own block and a b in each block that holds one of the `width` before it, so a join by block meets all pairs, a few times as many rows as there are
    pairs, and no block is larger than others whatever the number of terms.
    """
    block = lambda r: F.floor(r / BLOCK_ROWS).cast("long")
    # by number: the rows are few bytes but make `width` pairs each, so they must not be put together into few tasks
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    side = lambda name, home: rows.select(home.alias(f"{name}_block"), *[F.col(c).alias(f"{name}_{c}") for c in rows.columns]).repartition(parts, f"{name}_block")
    before = lambda n: F.greatest(F.col(rank) - n, F.lit(0))
    firsts, nexts = side("a", block(F.col(rank))), side("b", F.explode(F.sequence(block(before(width)), block(before(1)))))
    gap = F.col(f"b_{rank}") - F.col(f"a_{rank}")
    on = (F.col("a_block") == F.col("b_block")) & (gap > 0) & (gap <= width) & (F.abs(F.col("a_size") - F.col("b_size")) <= 2)
    # in one condition: a filter that came after would be asked before these
    return firsts.join(nexts, on if holds is None else on & holds)


def neighbours(terms: DataFrame, key: Column, width: int = fixed.NEIGHBOURS, term: str = "term") -> DataFrame:
    """a, b: each term with the next `width` terms in the order of the key, before any comparison but length."""
    return near(placed(terms, {"rank": key}, term).select("t", "rank", "size"), "rank", width).select(F.col("a_t").alias("a"), F.col("b_t").alias("b"))


def _close() -> tuple[Column, Column]:
    """Of rows of near: whether they are at edit distance 1, or 2 if the longer term has over 8 characters, in lower case; and the distance."""
    most = F.when(F.greatest("a_size", "b_size") <= fixed.SHORT_TERM_CHARS, 1).otherwise(2)
    distance = F.levenshtein(F.col("a_low"), F.col("b_low"), 2)
    # the bits first: they cost less than the distance and rule most pairs out
    return (F.bit_count(F.col("a_signs").bitwiseXOR(F.col("b_signs"))) <= 2 * most) & distance.between(1, most), distance.cast("long")


FORWARD, REVERSED = F.lower, lambda c: F.reverse(F.lower(c))


def banded(terms: DataFrame, reverse: bool = False, width: int = fixed.NEIGHBOURS, term: str = "term") -> DataFrame:
    """a, b, distance of close terms that stand near each other in forward or in reversed order."""
    holds, distance = _close()
    rows = placed(terms, {"rank": (REVERSED if reverse else FORWARD)("t")}, term)
    return near(rows, "rank", width, holds).select(F.col("a_t").alias("a"), F.col("b_t").alias("b"), distance.alias("distance"))


def similar_groups(terms: DataFrame, width: int = fixed.NEIGHBOURS, term: str = "term") -> DataFrame:
    """All groups: kind, reason, members: pairs, or terms that share a form without edge signs. A pair found twice counts once, and not at all where it is such a group of two.

    What decides that is put to the terms first, so that pairs, which are many more, are neither shuffled nor grouped nor joined.
    """
    rows = placed(terms, {"rank": FORWARD("t"), "back": REVERSED("t")}, term)
    groups = scratch_table(punctuation_groups(rows, "t"), "dedupe-marks")
    twins = groups.filter("size = 2").select(F.explode("members").alias("t"), F.col("stripped").alias("twin"))
    rows = scratch_table(rows.join(twins, "t", "left"), "dedupe-placed")
    holds, distance = _close()
    holds &= ~F.coalesce(F.col("a_twin") == F.col("b_twin"), F.lit(False))
    again = F.abs(F.col("a_rank") - F.col("b_rank")) <= width
    pairs = near(rows, "rank", width, holds).unionByName(near(rows, "back", width, ~again & holds))
    members = F.array(F.least("a_t", "b_t"), F.greatest("a_t", "b_t"))
    lev = pairs.select(F.lit("levenshtein").alias("kind"), F.concat(F.lit("Edit distance "), distance.cast("string")).alias("reason"), members.alias("members"))
    return groups.select(F.lit("punctuation").alias("kind"), F.concat(F.lit('Both strip to: "'), F.col("stripped"), F.lit('"')).alias("reason"), "members").unionByName(lev)


def drop_measurement_groups(groups: DataFrame) -> DataFrame:
    """Groups with at least one member that is more than a number, a dimension or a unit."""
    return groups.filter(~F.forall("members", is_measurement))


def tallies(decisions: DataFrame) -> DataFrame:
    """action, reason, n, with the largest first."""
    return decisions.groupBy("action", "reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "action", "reason")


def group_key(members: Column) -> Column:
    """A stable key of a group, whatever else is in the table: decisions stay valid when terms change."""
    return F.md5(F.array_join(F.array_sort(members), "\u0001"))


def decide_groups(groups: DataFrame, decided: DataFrame | None = None, legacy: bool = False) -> DataFrame:
    """group_key, action, canonical, reason, aliases for groups not yet decided."""
    keyed = groups.withColumn("group_key", group_key(F.col("members")))
    if decided is not None:
        keyed = keyed.join(decided.select("group_key"), "group_key", "left_anti")
    marks = F.struct(F.lit("merge").alias("action"), merging.decide_punctuation(F.col("members")).alias("canonical"), F.lit("edge signs").alias("reason"))
    pair = merging.decide(F.get("members", F.lit(0)), F.get("members", F.lit(1)), legacy)
    rows = keyed.withColumn("d", F.when(F.col("kind") == "punctuation", marks).otherwise(pair))
    aliases = F.filter("members", lambda t: t != F.col("d.canonical"))
    return rows.select("group_key", "d.action", "d.canonical", "d.reason", "members", F.when(F.col("d.action") == "merge", aliases).alias("aliases"))


def canonical_map(case_map: DataFrame, decisions: DataFrame, seq: str = "seq") -> DataFrame:
    """alias, canonical: the case map, over which merge decisions win, the last one per alias."""
    merged = decisions.filter("action = 'merge'").select(F.explode("aliases").alias("alias"), "canonical", F.col(seq).alias("__seq"))
    merged = merged.groupBy("alias").agg(F.max_by("canonical", "__seq").alias("canonical"))
    base = case_map.select(F.col("term").alias("alias"), "canonical")
    return merged.unionByName(base.join(merged.select("alias"), "alias", "left_anti"))


def resolve(terms: DataFrame, cmap: DataFrame, term: str = "source_term") -> DataFrame:
    """Add `canonical`: the map applied once (lower case where it has nothing), and once more. Never further."""
    one = cmap.select(F.col("alias").alias("__a1"), F.col("canonical").alias("__c1"))
    two = cmap.select(F.col("alias").alias("__a2"), F.col("canonical").alias("__c2"))
    step = terms.join(one, F.col(term) == F.col("__a1"), "left").withColumn("__s", F.coalesce("__c1", T.normalize_case(F.col(term))))
    return step.join(two, F.col("__s") == F.col("__a2"), "left").withColumn("canonical", F.coalesce("__c2", "__s")).drop("__a1", "__c1", "__a2", "__c2", "__s")


def preview(groups: DataFrame, candidates: DataFrame) -> DataFrame:
    """Per group and member: total frequency, best score and the best translation per locale as a map."""
    rows = groups.select("group_key", F.explode("members").alias("source_term")).join(candidates, "source_term")
    best = rows.groupBy("group_key", "source_term", "target_locale").agg(
        F.max_by("target_term", F.struct("final_score", "frequency", "target_term")).alias("best"), F.sum("frequency").alias("f"), F.max("final_score").alias("s")
    )
    return best.groupBy("group_key", "source_term").agg(
        F.sum("f").alias("total_frequency"), F.max("s").alias("best_score"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("target_locale", "best")))).alias("translations")
    )
