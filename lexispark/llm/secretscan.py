"""Secret scans by a trigram inverted index.

Each rule is a regular expression. Its Boolean trigram query (trigrams.query_of) says which texts can match it: postings of the queries' trigrams are
made in one pass over the texts, intersected per clause, and the texts found are verified with the expression itself. A rule without mandatory trigrams
scans every text. Candidates are kept by the hash of the text and joined back to the rows, which are salted by their id, so that many copies of one text
don't meet in one task. The vocabulary and the clauses are bounded by the rules and don't grow with the texts.

Spans are code points, end exclusive: the leftmost matches of a rule that don't overlap, of which those whose `group` is shorter than `least` are dropped. Spans of
different rules may overlap. Order: start, then the rule's place in the list.

Defined results: a null text is empty and has no spans; texts are scanned whole, whatever their length; copies and repeated rows get equal spans; a null id is kept; an empty table
gives no rows; columns besides doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.llm import trigrams
from lexispark.llm.native import text_of
from lexispark.session import table

SPANS = "array<struct<rule:int,start:int,end:int>>"
#: Rows that share a text are dealt to so many parts.
SALTS = 8


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The three base rules, and public formats of keys and credentials. A run of one class is one match,
# so its least length stands in the expression itself where that drops the same matches.
BASE = [
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
]
MORE = [
    Rule("private_key", r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[sr]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,15}://[A-Za-z0-9._~%!$&'()*+,;=-]{1,64}:[A-Za-z0-9._~%!$&'()*+,;=-]{3,64}@[A-Za-z0-9.-]+"),
    Rule("bearer", r"(?i:bearer) +[A-Za-z0-9._~+/=-]{20,}"),
]
RULES = BASE + MORE


def matches(rule: Rule, text: str) -> list[tuple[int, int]]:
    return [m.span() for m in re.finditer(rule.pattern, text, re.ASCII) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def scanner(rules: list[Rule]):
    """An Arrow function of texts and rule numbers: the spans of those rules."""

    def run(texts: pa.Array, asked: pa.Array) -> pa.Array:
        out = []
        for text, numbers in zip(texts, asked, strict=True):
            text = text.as_py()
            found = sorted((start, k, end) for k in numbers.as_py() for start, end in matches(rules[k], text))
            out.append([{"rule": k, "start": start, "end": end} for start, k, end in found])
        return pa.array(out, pa.list_(pa.struct([("rule", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])))

    return run


def find(docs: DataFrame, rules: list[Rule] = RULES, index: DataFrame | None = None) -> DataFrame:
    """doc_id, text, spans (array of kind, start, end) of every row. index: a written index of the same texts; without one, postings of the rules' trigrams are made here."""
    queries = {k: trigrams.query_of(r.pattern) for k, r in enumerate(rules)}
    everywhere = [k for k, q in queries.items() if q == trigrams.ALL]
    if index is None:
        index = trigrams.postings(docs, frozenset(t for q in queries.values() for c in q for t in c))
    some = trigrams.candidates(index, queries).select(F.col("ref").alias("__lx_ref"), "rules", F.explode(F.array(*map(F.lit, range(SALTS)))).alias("__lx_part"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.withColumns({"ref": F.xxhash64("text"), "part": F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")})
    rows = rows.join(some, (F.col("ref") == F.col("__lx_ref")) & (F.col("part") == F.col("__lx_part")), "left")
    numbers = F.concat(F.coalesce("rules", F.expr("cast(array() as array<int>)")), F.lit(everywhere).cast("array<int>") if everywhere else F.expr("cast(array() as array<int>)"))
    spans = F.arrow_udf(scanner(rules), SPANS)(F.col("text"), numbers)
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    named = F.transform("__lx_spans", lambda s: F.struct(F.get(kinds, s["rule"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.withColumn("__lx_spans", spans).select("doc_id", "text", named.alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _sql(k: int, rule: Rule) -> str:
    """One rule's spans in SQL: matches and the pieces between them give the places. RE2 folds case beyond ASCII, so letters in either case are spelled out."""
    both = lambda m: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in m)
    pattern = re.sub(r"\(\?i:((?:\([^)]*\)|[^()])*)\)", lambda m: f"(?:{both(m[1])})", rule.pattern).replace("'", "''")
    return (
        f"SELECT row, {k} AS k, '{rule.kind}' AS kind, {rule.least} AS least, string_split_regex(text, '{pattern}') AS between, regexp_extract_all(text, '{pattern}') AS found, "
        f"regexp_extract_all(text, '{pattern}', {rule.group}) AS part FROM d"
    )


OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
r AS ({" UNION ALL ".join(_sql(k, r) for k, r in enumerate(RULES))}),
u AS (SELECT row, k, kind, least, unnest(generate_series(1, len(found))) AS i, between, found, part FROM r WHERE len(found) > 0),
s AS (SELECT row, k, kind, CAST(list_sum(list_transform(between[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start, length(found[i]) AS size
  FROM u WHERE length(part[i]) >= least),
a AS (SELECT row, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
  string_agg(kind || ':' || start || ':' || (start + size), ',' ORDER BY start, k) FILTER (k < 3) AS base, string_agg(kind || ':' || start || ':' || (start + size), ',' ORDER BY start, k) AS spans FROM s GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (row)
"""


def op12_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE]))
    return found.select("doc_id", *[of(r.kind).alias(f"n_{r.kind}") for r in BASE], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
