"""Fill-in-the-middle transformation, by relations of text units.

A document is cut into units, at two of which it is divided into prefix, middle and suffix. Units are the matches of a regular expression, left to right (code points
by default, or words, lines and the like); a code point that the expression doesn't match is a unit of its own, so units tile the text.

One shuffle brings equal rows (id and text) together, counted; everything else stays in that partitioning. Matches are exploded with their
positions in two levels, so that their rows stay few: first blocks of `block` units, of which a window's running sum of lengths gives each block's place; the requests, two unit
ordinals for each document, join the block that holds the ordinal; of those blocks alone the units are exploded, their lengths
are summed up to the ordinal, and the offsets are gathered per document. Prefix, middle and suffix are substrings at these offsets.

The draw is the SHA-256 of `seed:` and the decimal id: its first four 8-digit groups, read as integers h1 to h4. The prefix ends after the smaller of h1 and h2, each
modulo units + 1, the middle after the larger. Form: `plain` if the text is empty or contains a marker, or if h3 % 100 reaches `plain_from`; else `spm` if h4 % 100 is
under `spm_below`; else `psm`. The output is the text; prefix, suffix, middle; or suffix, prefix, middle, each part behind its marker.

Defined results: a null text is empty; a null id is drawn as the word null; rows that repeat id and text get equal results, one each; a text of any length is handled whole;
an empty table gives no rows; columns besides doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.llm.native import text_of
from lexispark.session import table


@dataclass(frozen=True)
class Middle:
    """How documents are cut. unit: a Java regular expression that matches no empty text; None stands for code points."""

    unit: str | None = None
    block: int = 64
    seed: str = "1"
    plain_from: int = 90
    spm_below: int = 20
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    @property
    def one(self) -> str:
        return f"(?:{self.unit}|[\\s\\S])" if self.unit else "[\\s\\S]"

    def count(self, text: Column) -> Column:
        return F.regexp_count(text, F.lit(self.one)) if self.unit else F.length(text)


def distinct_rows(docs: DataFrame) -> DataFrame:
    """Each pair of id and text once: __lx_key, doc_id, text, copies. All later steps keep its partitioning."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    # never null, so that no join adds a filter for nulls, which would make the exchanges differ
    key = F.coalesce(F.unhex(F.sha2(F.concat(name, F.lit(":"), F.col("text")), 256)), F.lit(b""))
    once = rows.groupBy(key.alias("__lx_key")).agg(F.max("doc_id").alias("doc_id"), F.max("text").alias("text"), F.count("*").alias("copies"))
    # always true, but it keeps the count in every use: all uses read one and the same exchange
    return once.filter("copies > 0")


def requests(rows: DataFrame, how: Middle) -> DataFrame:
    """Add n, form, and the unit ordinals low and high after which prefix and middle end."""
    digest = F.sha2(F.concat(F.lit(f"{how.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256)
    h = lambda k: F.conv(F.substring("__lx_draw", 8 * k + 1, 8), 16, 10).cast("long")
    marked = F.lit(False)
    for marker in (how.prefix, how.suffix, how.middle):
        marked = marked | F.contains("text", F.lit(marker))
    form = F.when((F.col("text") == "") | marked | (h(2) % 100 >= how.plain_from), "plain").when(h(3) % 100 < how.spm_below, "spm").otherwise("psm")
    drawn = rows.withColumns({"__lx_draw": digest, "n": how.count(F.col("text")).cast("long")}).withColumn("form", form)
    cuts = [h(k) % (F.col("n") + 1) for k in (0, 1)]
    return drawn.withColumns({"low": F.least(*cuts), "high": F.greatest(*cuts)}).drop("__lx_draw")


def offsets(asked: DataFrame, how: Middle) -> DataFrame:
    """__lx_key, low_at, high_at: the code points before the unit ordinals low and high of each document that isn't plain; null where the ordinal is 0."""
    cut = asked.filter("form <> 'plain'")
    held = lambda c: F.floor((F.col(c) - 1) / how.block)
    # posexplode_outer: for posexplode, the optimizer would derive a filter that matches the text once more
    blocks = cut.select("__lx_key", held("low").alias("a"), held("high").alias("b"), F.posexplode_outer(F.regexp_extract_all("text", F.lit(f"{how.one}{{1,{how.block}}}"), F.lit(0))).alias("at", "units"))
    blocks = blocks.select("__lx_key", "at", F.length("units").alias("chars"), F.when((F.col("at") == F.col("a")) | (F.col("at") == F.col("b")), F.col("units")).alias("units"))
    upto = Window.partitionBy("__lx_key").orderBy("at")
    placed = blocks.withColumn("start", F.sum("chars").over(upto) - F.col("chars")).filter("units IS NOT NULL")
    placed = placed.select("__lx_key", "units", "start", (F.col("at") * F.lit(how.block).cast("long")).alias("first"))
    wanted = F.array(*[F.struct(F.lit(k).alias("cut"), (F.col(c) - 1).alias("ordinal")) for k, c in enumerate(("low", "high"))])
    wanted = cut.select(F.col("__lx_key").alias("k"), F.inline(wanted)).filter("ordinal >= 0")
    met = placed.join(wanted, (F.col("__lx_key") == F.col("k")) & (F.col("ordinal") >= F.col("first")) & (F.col("ordinal") < F.col("first") + how.block))
    units = met.select("__lx_key", "cut", "start", (F.col("ordinal") - F.col("first")).alias("upto"), F.posexplode_outer(F.regexp_extract_all("units", F.lit(how.one), F.lit(0))).alias("rank", "unit")).filter("rank <= upto")
    at = lambda k: (F.max(F.when(F.col("cut") == k, F.col("start"))) + F.sum(F.when(F.col("cut") == k, F.length("unit")))).cast("long")
    return units.groupBy("__lx_key").agg(at(0).alias("low_at"), at(1).alias("high_at"))


def transform(docs: DataFrame, how: Middle = Middle()) -> DataFrame:
    """doc_id, text, n, form, prefix_chars, middle_chars (code points; null if plain), output; a row for each row of docs."""
    asked = requests(distinct_rows(docs), how)
    found = offsets(asked, how).withColumnRenamed("__lx_key", "k")
    rows = asked.join(found, F.col("__lx_key") == F.col("k"), "left")
    rows = rows.withColumns({"low_at": F.coalesce("low_at", F.lit(0)), "high_at": F.coalesce("high_at", F.lit(0))})
    text, a, b = F.col("text"), F.col("low_at").cast("int"), F.col("high_at").cast("int")
    prefix, middle, suffix = F.substr(text, F.lit(1), a), F.substr(text, a + 1, b - a), F.substr(text, b + 1, F.length(text))
    p, s, m = (F.lit(x) for x in (how.prefix, how.suffix, how.middle))
    cut = F.col("form") != "plain"
    return rows.select(
        "doc_id", "text", "n", "form", F.when(cut, F.col("low_at")).alias("prefix_chars"), F.when(cut, F.col("high_at") - F.col("low_at")).alias("middle_chars"),
        F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle)).when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(text).alias("output"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__lx_copy"),
    ).drop("__lx_copy")


def restore(output: Column, form: Column, how: Middle = Middle()) -> Column:
    """The text that an output was made of. Texts with markers are plain, so the first marker of each kind is the one that was set."""

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        rest = F.substr(output, F.lit(len(first) + 1), F.length(output))
        one = F.substring_index(rest, second, 1)
        rest = F.substr(rest, F.length(one) + len(second) + 1, F.length(rest))
        two = F.substring_index(rest, how.middle, 1)
        return one, two, F.substr(rest, F.length(two) + len(how.middle) + 1, F.length(rest))

    prefix, suffix, middle = parts(how.prefix, how.suffix)
    suffix2, prefix2, middle2 = parts(how.suffix, how.prefix)
    return F.when(form == "psm", F.concat(prefix, middle, suffix)).when(form == "spm", F.concat(prefix2, middle2, suffix2)).otherwise(output)


OP11_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
c AS (SELECT *, CAST(length(text) AS BIGINT) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM c),
o AS (SELECT *, '<P>' || substr(text, 1, a) AS p, '<S>' || substr(text, b + 1) AS s, '<M>' || substr(text, a + 1, b - a) AS m FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN p || s || m WHEN 'spm' THEN s || p || m ELSE text END) AS output_sha256, sha256(text) AS restored_sha256 FROM o
"""


def op11_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    found = transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    restored = restore(F.col("output"), F.col("form"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"))
