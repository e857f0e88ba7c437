"""Deterministic stand-ins over the test tables, so that every operator has an input; each with its SQL form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark import fixed
from lexispark.functions import scoring
from lexispark.operators import store
from lexispark.session import table

REGION_LOCALE = {"AFRICA": "sv-SE", "AMERICA": "fi-FI", "ASIA": "de-DE", "EUROPE": "nb-NO", "MIDDLE EAST": "pl-PL"}
TYPE_DOMAIN = {"STANDARD": "materials", "MEDIUM": "sustainability", "PROMO": "construction", "LARGE": "product_types", "SMALL": "fit_silhouette", "ECONOMY": "general"}
FIELDS = list(fixed.FIELD_WEIGHTS)[:6]


def _cases(column: str, table_: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table_.items()) + " END"


def cand_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate events from line items; seq orders them by a struct, without a global numbering."""
    t = lambda n: table(spark, sf_dir, n)
    places = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    field = F.coalesce(F.try_element_at(F.array(*map(F.lit, FIELDS)), F.col("l_linenumber").cast("int")), F.lit("unknown"))
    return rows.select(
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice").alias("seq"),
        F.lit(fixed.SOURCE_LOCALE).alias("source_locale"),
        scoring.lookup(REGION_LOCALE, F.col("r_name"), "none").alias("target_locale"),
        F.col("p_name").alias("source_term"),
        F.concat(F.lower("n_name"), F.lit(" "), F.substring_index("p_name", " ", -1)).alias("target_term"),
        F.lower("p_name").alias("normalized_source"),
        scoring.lookup(TYPE_DOMAIN, F.col("p_type"), "none").alias("domain"),
        field.alias("field_origin"),
        F.col("l_quantity").cast("long").alias("frequency"),
        F.round(F.lit(0.6) + F.lit(0.008) * F.col("l_quantity"), 4).alias("similarity"),
        F.col("l_orderkey").cast("string").alias("evidence_product_ids"),
    )


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = cand_events(spark, sf_dir)
    e = e.withColumn("final_score", scoring.final_score(F.col("similarity"), F.col("frequency"), F.col("field_origin"), F.col("domain")))
    return e.withColumn("status", scoring.review_status(F.col("final_score"), F.col("similarity")))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folded events with an id and statuses of both phases spread over them."""
    folded = store.fold(scored_events(spark, sf_dir))
    # an id that the key alone decides: its MD5, 52 bits
    digest = F.md5(F.concat_ws("|", *store.KEY))
    rows = folded.withColumn("id", F.conv(F.substring(digest, 1, 13), 16, 10).cast("long"))
    spread = F.col("id") % 10
    status = (
        F.when(spread == 0, "phase1_approved").when(spread == 1, "phase1_needs_human_review").when(spread == 2, "phase1_rejected")
        .when(spread == 3, "phase2_rejected").when(spread == 4, "phase2_verbatim_entry").otherwise(F.col("status"))
    )
    blank = F.when(F.col("id") % 7 == 0, F.lit("")).otherwise(F.col("target_term"))
    return rows.withColumn("status", status).withColumn("target_term", blank).withColumn("reviewer_notes", F.lit(None).cast("string"))


EVENTS_SQL = f"""
cand_events AS (
  SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS seq,
         'en' AS source_locale, {_cases('r_name', REGION_LOCALE)} AS target_locale, p_name AS source_term,
         lower(n_name) || ' ' || split_part(p_name, ' ', -1) AS target_term, lower(p_name) AS normalized_source,
         {_cases('p_type', TYPE_DOMAIN)} AS domain,
         CASE {" ".join(f"WHEN l_linenumber = {i + 1} THEN '{f}'" for i, f in enumerate(FIELDS))} ELSE 'unknown' END AS field_origin,
         CAST(l_quantity AS BIGINT) AS frequency, round(0.6::DOUBLE + 0.008::DOUBLE * l_quantity, 4) AS similarity,
         CAST(l_orderkey AS VARCHAR) AS evidence_product_ids
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
scored AS (
  SELECT *, round(0.3::DOUBLE * similarity + 0.2::DOUBLE * least(frequency / 10.0::DOUBLE, 1.0::DOUBLE)
    + 0.15::DOUBLE * CASE field_origin {" ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in fixed.FIELD_WEIGHTS.items())} ELSE 0.5::DOUBLE END
    + 0.15::DOUBLE * CASE domain {" ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in fixed.DOMAIN_PRIORITY.items())} ELSE 0.5::DOUBLE END
    + 0.1::DOUBLE * 0.5::DOUBLE + 0.1::DOUBLE * CASE WHEN domain <> 'general' THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END, 4) AS final_score
  FROM cand_events
),
stated AS (
  SELECT *, CASE WHEN similarity >= 0.85 AND final_score >= 0.80 THEN 'approved' WHEN similarity < 0.65 THEN 'rejected' ELSE 'needs_review' END AS status FROM scored
),
folded AS (
  SELECT source_locale, target_locale, normalized_source, domain, arg_min(source_term, seq) AS source_term, arg_min(target_term, seq) AS target_term,
         arg_min(field_origin, seq) AS field_origin, arg_min(status, seq) AS status, CAST(arg_min(frequency, seq) + count(*) - 1 AS BIGINT) AS frequency,
         max(similarity) AS similarity, max(final_score) AS final_score, arg_max(evidence_product_ids, seq) AS evidence_product_ids, count(*) AS n_hits
  FROM stated GROUP BY ALL
)"""
EVENTS_SQL = EVENTS_SQL.replace("GROUP BY ALL", "GROUP BY source_locale, target_locale, normalized_source, domain")

CANDIDATES_SQL = EVENTS_SQL + """,
numbered AS (
  SELECT *, ('0x' || substr(md5(source_locale || '|' || target_locale || '|' || normalized_source || '|' || domain), 1, 13))::BIGINT AS id FROM folded
),
candidates AS (
  SELECT * REPLACE (
    CASE id % 10 WHEN 0 THEN 'phase1_approved' WHEN 1 THEN 'phase1_needs_human_review' WHEN 2 THEN 'phase1_rejected'
                 WHEN 3 THEN 'phase2_rejected' WHEN 4 THEN 'phase2_verbatim_entry' ELSE status END AS status,
    CASE WHEN id % 7 = 0 THEN '' ELSE target_term END AS target_term), CAST(NULL AS VARCHAR) AS reviewer_notes
  FROM numbered
)"""


def wide_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as an item sheet: some cells null or blank, one text repeated over locales."""
    p = table(spark, sf_dir, "part")
    size, name = F.col("p_size"), F.col("p_name")
    columns = {
        "ProductNameShort_en": name,
        "ProductNameShort_sv-SE": F.concat(name, F.lit(" sv")),
        "ProductNameShort_fi-FI": F.when(size % 5 != 0, F.concat(F.lit("  "), name, F.lit(" fi "))),
        "ProductNameShort_de-DE": F.when(size % 4 == 0, F.lit("   ")).otherwise(F.concat(name, F.lit(" sv"))),
        "ProductDescription_en": F.when(size % 3 != 0, F.concat(F.col("p_brand"), F.lit(" "), name)),
        "ProductDescription_nb-NO": F.concat(F.lower("p_brand"), F.lit(" nb")),
        "ItemUSP_en": F.lower("p_type"),
        "ItemUSP_pl-PL": F.concat(F.lower("p_type"), F.lit(" pl")),
    }
    return p.select(F.col("p_partkey").alias("row_no"), F.col("p_partkey").alias("sys_id"), F.when(size % 11 != 0, F.col("p_type")).alias("sys_entitytype"), *[v.alias(k) for k, v in columns.items()])


PAIRS_SQL = """
wide AS (
  SELECT p_partkey AS row_no, CAST(p_partkey AS VARCHAR) AS product_id, CASE WHEN p_size % 11 <> 0 THEN p_type END AS entity_type,
         p_name, p_brand, p_type, p_size FROM part
),
cells AS (
  SELECT row_no, product_id, entity_type, 'ProductNameShort' AS field, 0 AS field_no, p_name AS source_text, 'sv-SE' AS target_locale, 0 AS locale_no, p_name || ' sv' AS target_text FROM wide
  UNION ALL SELECT row_no, product_id, entity_type, 'ProductNameShort', 0, p_name, 'fi-FI', 1, CASE WHEN p_size % 5 <> 0 THEN trim('  ' || p_name || ' fi ') END FROM wide
  UNION ALL SELECT row_no, product_id, entity_type, 'ProductNameShort', 0, p_name, 'de-DE', 2, nullif(trim(CASE WHEN p_size % 4 = 0 THEN '   ' ELSE p_name || ' sv' END), '') FROM wide
  UNION ALL SELECT row_no, product_id, entity_type, 'ProductDescription', 1, CASE WHEN p_size % 3 <> 0 THEN p_brand || ' ' || p_name END, 'nb-NO', 3, lower(p_brand) || ' nb' FROM wide
  UNION ALL SELECT row_no, product_id, entity_type, 'ItemUSP', 6, lower(p_type), 'pl-PL', 4, lower(p_type) || ' pl' FROM wide
),
pairs AS (SELECT * FROM cells WHERE entity_type IS NOT NULL AND source_text IS NOT NULL AND target_text IS NOT NULL),
first_pairs AS (
  SELECT * EXCLUDE (k) FROM (
    SELECT *, row_number() OVER (PARTITION BY field, source_text, target_text ORDER BY row_no, field_no, locale_no) AS k FROM pairs) WHERE k = 1
)"""


def doc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct tokens of the documents, split at ASCII white space."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.explode_outer(F.split("text", r"[ \t\n\x0B\f\r]+")).alias("term")).filter("term <> ''").distinct()


TOKENS_SQL = r"""
doc_tokens AS (SELECT DISTINCT term FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+')) AS term FROM documents) WHERE term <> '')"""


def ascii_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-case ASCII words of six letters or more: both engines count their edits alike."""
    return doc_tokens(spark, sf_dir).select(F.lower("term").alias("term")).filter(F.col("term").rlike("^[a-z]{6,}$")).distinct()


ASCII_SQL = TOKENS_SQL + """,
ascii_terms AS (SELECT DISTINCT lower(term) AS term FROM doc_tokens WHERE regexp_full_match(lower(term), '[a-z]{6,}'))"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct non-blank lines of documents and benchmark items."""
    both = table(spark, sf_dir, "documents").select("text").union(table(spark, sf_dir, "benchmark").select("text"))
    return both.select(F.explode_outer(F.split("text", "\n")).alias("term")).filter(F.trim("term") != "").distinct()


LINES_SQL = """
lines AS (SELECT DISTINCT term FROM (SELECT unnest(string_split(text, chr(10))) AS term FROM (SELECT text FROM documents UNION ALL SELECT text FROM benchmark)) WHERE trim(term) <> '')"""


def part_phrases(spark: SparkSession, sf_dir: str, templates: list[str]) -> DataFrame:
    """p_partkey, p_size and term: a phrase for each part, of the template that its key picks, with its name for {n} and its size for {s}."""
    pick = F.element_at(F.array(*map(F.lit, templates)), (F.col("p_partkey") % len(templates) + 1).cast("int"))
    term = F.replace(F.replace(pick, F.lit("{n}"), F.col("p_name")), F.lit("{s}"), F.col("p_size").cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", "p_size", term.alias("term"))


def part_phrases_sql(templates: list[str]) -> str:
    held = ", ".join("'" + t.replace("'", "''") + "'" for t in templates)
    return f"(SELECT p_partkey, p_size, replace(replace([{held}][p_partkey % {len(templates)} + 1], '{{n}}', p_name), '{{s}}', CAST(p_size AS VARCHAR)) AS term FROM part)"
