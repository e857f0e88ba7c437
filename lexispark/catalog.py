"""The registered queries of the terminology engine, each beside its DuckDB form where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import glossary_release, term_ledger
from lexispark import fixed
from lexispark.functions import merging, scoring, validity
from lexispark.functions import text as T
from lexispark.operators import align, browse, dedupe, glossary, keywords, nearest, pairs, review, store, substring, tagging, terms
from lexispark.plans import curation, mining
from lexispark.session import scratch_dir, scratch_table, table
from lexispark.sources import standins as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a function under its name, with its oracle."""

    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def quoted(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def values(rows: list[tuple], names: str) -> str:
    """An inline table of texts in SQL."""
    cell = lambda v: "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"
    return f"(SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) AS v({names}))"


def words_sql(c: str) -> str:
    return rf"len(list_filter(regexp_split_to_array({c}, '\s+'), lambda w: w <> ''))"


def _strip_term_sql(c: str) -> str:
    inner = f"regexp_replace(regexp_replace({c}, '^[^\\p{{L}}\\p{{N}}_]+', ''), '[^\\p{{L}}\\p{{N}}_]+$', '')"
    return f"coalesce(nullif(regexp_replace({inner}, '^_+|_+$', '', 'g'), ''), {c})"


# --- candidates: score, status, fold ---

FOLD_OUT = "source_locale, target_locale, normalized_source, domain, source_term, target_term, field_origin, status, frequency, similarity, final_score, evidence_product_ids"


@query(f"WITH {S.EVENTS_SQL} SELECT {FOLD_OUT}, CAST(n_hits AS BIGINT) AS n_hits FROM folded")
def candidate_upsert_fold(spark, sf_dir):
    return store.fold(S.scored_events(spark, sf_dir))


@query(f"WITH {S.EVENTS_SQL} SELECT CAST(evidence_product_ids AS BIGINT) AS orderkey, source_term, target_locale, field_origin, frequency, similarity, final_score FROM scored")
def candidate_final_score(spark, sf_dir):
    return S.scored_events(spark, sf_dir).select(F.col("evidence_product_ids").cast("long").alias("orderkey"), "source_term", "target_locale", "field_origin", "frequency", "similarity", "final_score")


@query(f"WITH {S.EVENTS_SQL} SELECT status, target_locale, count(*) AS n, CAST(sum(CAST(round(final_score * 10000) AS BIGINT)) AS BIGINT) AS total_score FROM folded GROUP BY 1, 2")
def candidate_status(spark, sf_dir):
    folded = store.fold(S.scored_events(spark, sf_dir))
    return folded.groupBy("status", "target_locale").agg(F.count("*").alias("n"), F.sum(F.round(F.col("final_score") * 10000).cast("long")).alias("total_score"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidate_status(spark, sf_dir)


@query(
    f"""WITH {S.EVENTS_SQL} SELECT source_locale, target_locale, normalized_source, domain, arg_min(target_term, seq) AS target_term, arg_min(status, seq) AS status,
    CAST(arg_min(frequency, seq) + count(*) - 1 AS BIGINT) AS frequency, max(similarity) AS similarity, max(final_score) AS final_score
    FROM stated GROUP BY source_locale, target_locale, normalized_source, domain"""
)
def upsert_in_batches(spark, sf_dir):
    """Two batches in order of arrival give what one fold of all events gives."""
    events = S.scored_events(spark, sf_dir)
    middle = events.agg(F.percentile_approx("seq.l_orderkey", 0.5).alias("m")).first()["m"]
    first, then = events.filter(F.col("seq.l_orderkey") <= middle), events.filter(F.col("seq.l_orderkey") > middle)
    return store.upsert(store.fold(first), then).select(*store.KEY, "target_term", "status", "frequency", "similarity", "final_score")


# --- reads and statistics ---


def with_candidates(sql: str) -> str:
    """SQL after the stand-in candidates; it may begin with a comma and more named queries."""
    return f"WITH {S.CANDIDATES_SQL}{sql if sql.startswith(',') else ' ' + sql}"


@query(with_candidates("SELECT coalesce(status, 'total') AS status, count(*) AS n FROM candidates GROUP BY ROLLUP (status)"))
def stats_by_status_total(spark, sf_dir):
    return store.status_totals(S.candidates(spark, sf_dir))


@query(with_candidates("SELECT target_locale, count(*) AS n FROM candidates GROUP BY 1"))
def stats_by_locale(spark, sf_dir):
    return S.candidates(spark, sf_dir).groupBy("target_locale").agg(F.count("*").alias("n"))


@query(
    with_candidates(
        "SELECT count(*) FILTER (WHERE starts_with(status, 'phase1_')) AS phase1, count(*) FILTER (WHERE status = 'approved' OR starts_with(status, 'phase2_')) AS phase2 FROM candidates"
    )
)
def stats_by_phase(spark, sf_dir):
    return store.phase_totals(S.candidates(spark, sf_dir))


@query(with_candidates("SELECT domain, count(*) AS n FROM candidates GROUP BY 1 ORDER BY n DESC, domain LIMIT 15"))
def domain_top15(spark, sf_dir):
    return S.candidates(spark, sf_dir).groupBy("domain").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "domain").limit(15)


@query(with_candidates("SELECT min(final_score) AS lowest, max(final_score) AS highest, round(avg(final_score), 6) AS mean FROM candidates"))
def score_summary(spark, sf_dir):
    return S.candidates(spark, sf_dir).agg(F.min("final_score").alias("lowest"), F.max("final_score").alias("highest"), F.round(F.avg("final_score"), 6).alias("mean"))


@query(
    with_candidates(
        "SELECT id, source_term, target_term, final_score FROM candidates WHERE status = 'needs_review' AND target_locale = 'de-DE' AND final_score >= 0.7 ORDER BY final_score DESC, id LIMIT 500"
    )
)
def get_candidates_filtered(spark, sf_dir):
    return store.get_candidates(S.candidates(spark, sf_dir), status="needs_review", target_locale="de-DE", domain="", min_score=0.7).select("id", "source_term", "target_term", "final_score")


@query(with_candidates("SELECT id, source_term, target_term, target_locale, domain, field_origin, similarity, final_score, status FROM candidates ORDER BY final_score DESC, id LIMIT 20"))
def top_candidates(spark, sf_dir):
    return store.get_candidates(S.candidates(spark, sf_dir), limit=20).select("id", "source_term", "target_term", "target_locale", "domain", "field_origin", "similarity", "final_score", "status")


@query(with_candidates("SELECT id, source_term, final_score FROM candidates WHERE final_score < 0.6 ORDER BY final_score, id LIMIT 10"))
def low_score_sample(spark, sf_dir):
    return S.candidates(spark, sf_dir).filter("final_score < 0.6").orderBy("final_score", "id").limit(10).select("id", "source_term", "final_score")


@query(
    f"""WITH {S.EVENTS_SQL} SELECT CAST(evidence_product_ids AS BIGINT) AS orderkey, source_term, target_term, target_locale, field_origin, final_score
    FROM scored WHERE final_score < 0.6 ORDER BY final_score, orderkey, source_term, target_term, field_origin LIMIT 20"""
)
def low_score_events(spark, sf_dir):
    """The lowest scores among all events."""
    low = S.scored_events(spark, sf_dir).filter("final_score < 0.6").withColumn("orderkey", F.col("evidence_product_ids").cast("long"))
    return low.orderBy("final_score", "orderkey", "source_term", "target_term", "field_origin").limit(20).select("orderkey", "source_term", "target_term", "target_locale", "field_origin", "final_score")


@query(
    with_candidates(
        "SELECT id, status, source_term, final_score FROM candidates WHERE (status = 'approved' OR starts_with(status, 'phase2_')) AND (source_term ILIKE '%in%' OR target_term ILIKE '%in%' OR normalized_source ILIKE '%in%' OR domain ILIKE '%in%') ORDER BY final_score DESC, id LIMIT 50 OFFSET 10"
    )
)
def datatables_page(spark, sf_dir):
    page = browse.Page(start=10, length=50, order_column=9, descending=True, search="in", phase="2")
    return browse.page_rows(S.candidates(spark, sf_dir), page).select("id", "status", "source_term", "final_score")


@query(
    with_candidates(
        "SELECT count(*) AS records_total, count(*) FILTER (WHERE target_locale = 'sv-SE' AND starts_with(status, 'phase1_')) AS records_filtered FROM candidates"
    )
)
def datatables_counts(spark, sf_dir):
    return browse.page_counts(S.candidates(spark, sf_dir), browse.Page(phase="1", locale="sv-SE"))


@query(with_candidates("SELECT id, source_term, domain FROM candidates WHERE source_term ILIKE '%BOLT%' OR target_term ILIKE '%BOLT%' OR normalized_source ILIKE '%BOLT%' OR domain ILIKE '%BOLT%'"))
def search_like(spark, sf_dir):
    return browse.filtered(S.candidates(spark, sf_dir), browse.Page(search="BOLT")).select("id", "source_term", "domain")


#: Whole words, parts of words, wildcards inside and alone, under three characters, in other case, and one that nothing holds.
SOUGHT = ["BOLT", "b_lt", "small%ge", "in", "ll r", "%", "generaL", "zzqz"]


def _sought_sql(sought: list[str], fields: list[str]) -> str:
    either = " OR ".join(f"{c} ILIKE '%' || sought || '%'" for c in fields)
    return f"{values([(v,) for v in sought], 'sought')} JOIN t ON {either}"


@query(with_candidates(f", t AS (SELECT * FROM candidates) SELECT sought, id, source_term FROM {_sought_sql(SOUGHT, browse.SEARCHED)}"))
def search_indexed(spark, sf_dir):
    """Several searches of the candidates over one index. The candidates are folded once, not again for each search."""
    rows = scratch_table(S.candidates(spark, sf_dir), "search-candidates")
    index = substring.build(rows, "id", browse.SEARCHED)
    found = [browse.filtered(rows, browse.Page(search=v), index).select(F.lit(v).alias("sought"), "id", "source_term") for v in SOUGHT]
    return reduce(DataFrame.unionByName, found)


PASSAGES = ["Worthless", "the of", "éanm", "on_the", "is w%st the by", "ÉÉ", "onrein | ned"]


@query(f"WITH t AS (SELECT doc_id, text FROM documents) SELECT sought, doc_id FROM {_sought_sql(PASSAGES, ['text'])}")
def search_documents(spark, sf_dir):
    """Several searches of whole texts over one index."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = substring.build(rows, "doc_id", ["text"])
    return reduce(DataFrame.unionByName, [substring.search(rows, index, v).select(F.lit(v).alias("sought"), "doc_id") for v in PASSAGES])


@query(
    """SELECT event_id, json_extract_string(n, '$.confidence')::DOUBLE AS rn_confidence, json_extract_string(n, '$.source_term_cleanness')::INTEGER AS rn_cleanness,
    coalesce(json_extract_string(n, '$.notes'), '') AS rn_notes, 0 AS n_reasons
    FROM (SELECT event_id, json_object('confidence', value / 100, 'source_term_cleanness', CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 + 1, 'notes', event_type) AS n FROM events)"""
)
def reviewer_notes_flatten(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    notes = F.to_json(F.struct((F.col("value") / 100).alias("confidence"), (F.col("k") % 5 + 1).alias("source_term_cleanness"), F.col("event_type").alias("notes")))
    flat = browse.flatten_notes(e.withColumn("reviewer_notes", notes))
    return flat.select("event_id", "rn_confidence", "rn_cleanness", "rn_notes", F.size("rn_rejection_reasons").alias("n_reasons"))


# --- review ---


@query(
    with_candidates(
        "SELECT normalized_source, min(source_locale) AS source_locale, CAST(sum(frequency) AS BIGINT) AS frequency, string_agg(DISTINCT field_origin, ',' ORDER BY field_origin) AS field_origins, string_agg(DISTINCT domain, ',' ORDER BY domain) AS domains FROM candidates WHERE status = 'needs_review' GROUP BY 1 ORDER BY frequency DESC, normalized_source LIMIT 500"
    )
)
def phase1_rollup(spark, sf_dir):
    return review.fetch_phase1(S.candidates(spark, sf_dir))


@query(with_candidates("SELECT id, source_term, target_term, status, final_score FROM candidates WHERE status IN ('phase1_approved', 'phase1_needs_human_review') AND target_locale = 'sv-SE' ORDER BY final_score DESC, id LIMIT 500"))
def phase2_fetch(spark, sf_dir):
    return review.fetch_phase2(S.candidates(spark, sf_dir), "sv-SE").select("id", "source_term", "target_term", "status", "final_score")


@query(
    with_candidates(
        """, s AS (SELECT id, id % 5 + 1 AS a, id // 5 % 5 + 1 AS b, id // 25 % 5 + 1 AS c, id % 13 = 0 AS brand FROM candidates)
    SELECT id, CASE WHEN a < 3 OR b < 2 OR c < 2 THEN 'rejected' WHEN brand THEN 'verbatim_entry' WHEN a >= 4 AND b >= 4 AND c >= 4 THEN 'approved' ELSE 'needs_human_review' END AS verdict,
      CASE WHEN a < 3 OR b < 2 OR c < 2 THEN 'phase1_rejected' WHEN brand THEN 'phase1_verbatim_entry' WHEN a >= 4 AND b >= 4 AND c >= 4 THEN 'phase1_approved' ELSE 'phase1_needs_human_review' END AS status,
      concat_ws(',', CASE WHEN a < 3 THEN 'garbled_source' END, CASE WHEN b < 2 THEN 'too_generic' END, CASE WHEN c < 2 THEN 'off_domain' END, CASE WHEN brand THEN 'brand_name_verbatim' END) AS reasons FROM s"""
    )
)
def judgment_rules_p1(spark, sf_dir):
    a, b, c, brand = F.col("id") % 5 + 1, F.floor(F.col("id") / 5) % 5 + 1, F.floor(F.col("id") / 25) % 5 + 1, F.col("id") % 13 == 0
    verdict = review.verdict_phase1(a, b, c, brand)
    return S.candidates(spark, sf_dir).select("id", verdict.alias("verdict"), review.status_of(verdict, 1).alias("status"), F.array_join(review.reasons_phase1(a, b, c, brand), ",").alias("reasons"))


@query(
    with_candidates(
        """, s AS (SELECT id, id % 5 + 1 AS a, id // 5 % 5 + 1 AS b, id % 13 = 0 AS brand FROM candidates)
    SELECT id, CASE WHEN a < 2 OR b < 2 THEN 'phase2_rejected' WHEN brand THEN 'phase2_verbatim_entry' WHEN a >= 4 AND b >= 4 THEN 'approved' ELSE 'phase2_needs_human_review' END AS status FROM s"""
    )
)
def judgment_rules_p2(spark, sf_dir):
    verdict = review.verdict_phase2(F.col("id") % 5 + 1, F.floor(F.col("id") / 5) % 5 + 1, F.col("id") % 13 == 0)
    return S.candidates(spark, sf_dir).select("id", review.status_of(verdict, 2).alias("status"))


@query(
    with_candidates(
        """, t AS (SELECT DISTINCT normalized_source FROM candidates WHERE length(normalized_source) % 2 = 0)
    SELECT c.id, CASE WHEN c.id % 3 = 0 THEN 'approved' WHEN t.normalized_source IS NOT NULL THEN 'phase1_approved' ELSE c.status END AS status,
           CASE WHEN c.id % 3 = 0 THEN 'by id' WHEN t.normalized_source IS NOT NULL THEN 'by term' ELSE c.reviewer_notes END AS reviewer_notes
    FROM candidates c LEFT JOIN t ON t.normalized_source = c.normalized_source"""
    )
)
def judgment_writeback(spark, sf_dir):
    c = S.candidates(spark, sf_dir)
    by_id = c.filter("id % 3 = 0").select("id", F.lit(None).cast("string").alias("normalized_source"), F.lit("approved").alias("status"), F.lit("by id").alias("reviewer_notes"), F.lit(2).alias("seq"))
    by_term = c.filter(F.length("normalized_source") % 2 == 0).select(F.lit(None).cast("long").alias("id"), "normalized_source", F.lit("phase1_approved").alias("status"), F.lit("by term").alias("reviewer_notes"), F.lit(1).alias("seq"))
    return store.write_back(c, by_id.unionByName(by_term)).select("id", "status", "reviewer_notes")


@query(
    with_candidates(
        "SELECT id, CASE WHEN id % 4 = 0 THEN 'archived' ELSE status END AS status, CASE WHEN id % 4 = 0 THEN 'n' ELSE reviewer_notes END AS reviewer_notes FROM candidates"
    )
)
def status_update(spark, sf_dir):
    c = S.candidates(spark, sf_dir)
    changes = c.filter("id % 4 = 0").select("id", F.lit("archived").alias("status"), F.lit("n").alias("reviewer_notes"))
    return store.update_status(c, changes).select("id", "status", "reviewer_notes")


#: Judgments of mixed order: two for each id, one without a note, and one for each term of even length.
ORDER_SQL = """, j AS (
  SELECT id, NULL AS term, id % 7 AS seq, 1 AS own, 'approved' AS status, NULL AS notes FROM candidates WHERE id % 3 <> 0
  UNION ALL SELECT id, NULL, id % 5 + 1, 1, 'rejected', 'a ' || target_locale FROM candidates WHERE id % 3 <> 1
  UNION ALL SELECT DISTINCT NULL, normalized_source, 3, 0, 'phase1_approved', 'z term' FROM candidates WHERE length(normalized_source) % 2 = 0
), """


def _mixed(c: DataFrame) -> DataFrame:
    """As ORDER_SQL."""
    no_id, no_term = F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("normalized_source")
    row = lambda id_, term, seq, status, notes: [id_, term, seq.cast("long").alias("seq"), F.lit(status).alias("status"), notes.alias("reviewer_notes")]
    one = c.filter("id % 3 <> 0").select(*row(F.col("id"), no_term, F.col("id") % 7, "approved", F.lit(None).cast("string")))
    two = c.filter("id % 3 <> 1").select(*row(F.col("id"), no_term, F.col("id") % 5 + 1, "rejected", F.concat(F.lit("a "), F.col("target_locale"))))
    three = c.filter(F.length("normalized_source") % 2 == 0).select(*row(no_id, F.col("normalized_source"), F.lit(3), "phase1_approved", F.lit("z term"))).distinct()
    return one.unionByName(two).unionByName(three)


LAST_SQL = "row_number() OVER (PARTITION BY c.id ORDER BY j.seq DESC, j.own DESC, j.status DESC, j.notes DESC NULLS LAST)"


@query(
    with_candidates(
        ORDER_SQL
        + f"""m AS (SELECT c.id, j.status, j.notes, {LAST_SQL} AS k FROM candidates c JOIN j ON j.id = c.id OR j.term = c.normalized_source)
        SELECT c.id, CASE WHEN m.id IS NULL THEN c.status ELSE m.status END AS status, CASE WHEN m.id IS NULL THEN c.reviewer_notes ELSE m.notes END AS reviewer_notes
        FROM candidates c LEFT JOIN (SELECT * FROM m WHERE k = 1) m USING (id)"""
    )
)
def judgment_writeback_order(spark, sf_dir):
    """Judgments by id and by term in mixed order, several for one row: the last counts."""
    c = S.candidates(spark, sf_dir)
    return store.write_back(c, _mixed(c)).select("id", "status", "reviewer_notes")


@query(
    with_candidates(
        ORDER_SQL
        + f"""m AS (SELECT c.id, j.status, j.notes, {LAST_SQL} AS k FROM candidates c JOIN j ON j.id = c.id)
        SELECT c.id, CASE WHEN m.id IS NULL THEN c.status ELSE m.status END AS status, CASE WHEN m.id IS NULL THEN c.reviewer_notes ELSE m.notes END AS reviewer_notes
        FROM candidates c LEFT JOIN (SELECT * FROM m WHERE k = 1) m USING (id)"""
    )
)
def status_update_order(spark, sf_dir):
    """Several changes of one id: the last counts as a whole, its null note as well."""
    c = S.candidates(spark, sf_dir)
    changes = _mixed(c).filter("id IS NOT NULL").drop("normalized_source")
    return store.update_status(c, changes).select("id", "status", "reviewer_notes")


@query(
    with_candidates(
        f""", u AS (SELECT id, source_locale, target_locale, domain, source_term, target_term, frequency, similarity, final_score FROM candidates
          UNION ALL SELECT id + 10000000000000000, source_locale, target_locale, domain, '(' || source_term || '),', target_term || '.', frequency + 1, similarity - 0.01, final_score + 0.01 FROM candidates WHERE id % 3 = 0),
        r AS (SELECT * REPLACE ({_strip_term_sql("source_term")} AS source_term, CASE WHEN target_term = '' THEN '' ELSE {_strip_term_sql("target_term")} END AS target_term) FROM u)
        SELECT min(id) AS id, source_locale, target_locale, lower(source_term) AS normalized_source, domain, arg_min(source_term, id) AS source_term, arg_min(target_term, id) AS target_term,
          CAST(sum(frequency) AS BIGINT) AS frequency, round(max(similarity), 4) AS similarity, round(max(final_score), 4) AS final_score
        FROM r WHERE source_term <> '' AND target_term <> '' GROUP BY source_locale, target_locale, lower(source_term), domain"""
    )
)
def punctuation_repair(spark, sf_dir):
    """The repaired table, where some rows meet others with the same key."""
    c = S.candidates(spark, sf_dir).withColumn("normalized_target", F.lower("target_term"))
    edged = {
        "id": F.col("id") + 10**16, "source_term": F.concat(F.lit("("), F.col("source_term"), F.lit("),")), "normalized_source": F.concat(F.lit("("), F.col("normalized_source"), F.lit("),")),
        "target_term": F.concat(F.col("target_term"), F.lit(".")), "frequency": F.col("frequency") + 1, "similarity": F.col("similarity") - 0.01, "final_score": F.col("final_score") + 0.01,
    }
    repaired = store.repair_punctuation(c.unionByName(c.filter("id % 3 = 0").withColumns(edged)))[0]
    return repaired.select("id", *store.KEY, "source_term", "target_term", "frequency", F.round("similarity", 4).alias("similarity"), F.round("final_score", 4).alias("final_score"))


ANSWERS = [
    ('{"verdict": "APPROVED", "scores": {"cleanness": 5, "utility": 4, "domain_relevance": 4}}',),
    ('```json\n{"verdict": "rejected", "confidence": 0.4, "source_term_cleanness": 1, "glossary_utility": 2, "domain_relevance": 3, "rejection_reasons": ["GARBLED_SOURCE"]}\n```',),
    ('{"verdict": "approved", "confidence": 1.5, "source_term_cleanness": 5, "glossary_utility": 5, "domain_relevance": 5}',),
    ('{"verdict": "maybe", "source_term_cleanness": 5, "glossary_utility": 5, "domain_relevance": 5}',),
    ("no json",),
]


@query()
def judgment_json_normalise(spark, sf_dir):
    """An answer for each candidate, of the form that its id picks, with its score as confidence. tests/test_whole.py has the plain reading."""
    form = F.element_at(F.array(*[F.lit(a[0]) for a in ANSWERS]), (F.col("id") % len(ANSWERS) + 1).cast("int"))
    answers = S.candidates(spark, sf_dir).select("id", F.replace(form, F.lit("0.4"), F.col("final_score").cast("string")).alias("answer"))
    return review.read_answers(answers, "answer", 1).select("id", "valid", "judgment.verdict", "judgment.confidence", "judgment.source_term_cleanness", F.array_join("judgment.rejection_reasons", ",").alias("reasons"))


@query(
    with_candidates(
        "SELECT id, CASE WHEN status IN ('phase1_approved', 'phase1_needs_human_review') THEN CASE WHEN similarity >= 0.8 THEN 'approved' ELSE 'phase2_needs_human_review' END ELSE status END AS status FROM candidates"
    )
)
def review_phase2(spark, sf_dir):
    """A whole phase with the offline judge, over all fetched rows."""
    call = review.rule_judge(lambda user: {"translation_pair_validity": 4 if float(user.split("Similarity: ")[1].split("\n")[0]) >= 0.8 else 3, "translation_consistency_value": 4}, 2)
    return curation.review_phase(S.candidates(spark, sf_dir), 2, call, "product texts", limit=None).select("id", "status")


# --- pairs ---


@query(f"WITH {S.PAIRS_SQL} SELECT product_id, entity_type, field, 'en' AS source_locale, source_text, target_locale, target_text FROM first_pairs")
def pairs_unpivot_dedupe(spark, sf_dir):
    return pairs.first_pairs(pairs.to_pairs(S.wide_items(spark, sf_dir))).select("product_id", "entity_type", "field", "source_locale", "source_text", "target_locale", "target_text")


@query(f"WITH {S.PAIRS_SQL}, l AS (SELECT * FROM first_pairs ORDER BY row_no, field_no, locale_no LIMIT 300) SELECT product_id, field, source_text, target_locale, target_text FROM l WHERE target_locale IN ('sv-SE', 'pl-PL')")
def pairs_limit_then_locale(spark, sf_dir):
    firsts = pairs.limited(pairs.first_pairs(pairs.to_pairs(S.wide_items(spark, sf_dir))), 300)
    return firsts.filter(F.col("target_locale").isin("sv-SE", "pl-PL")).select("product_id", "field", "source_text", "target_locale", "target_text")


CONV_SQL = """conv AS (SELECT conv_id, turn, role, text, lead(role) OVER w AS r2, lead(text) OVER w AS t2 FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
conv_pairs AS (SELECT conv_id, turn, text AS source_text, t2 AS target_text FROM conv WHERE role = 'user' AND r2 = 'assistant')"""


def conv_pairs(spark, sf_dir):
    return pairs.with_lead(table(spark, sf_dir, "conversations"), "conv_id", "turn", "user", "assistant")


@query(f"WITH {CONV_SQL} SELECT target_locale, count(*) AS pairs, count(*) FILTER (WHERE length(source_text) % 2 = 1) AS without_terms FROM (SELECT 'x' AS target_locale, source_text FROM conv_pairs) GROUP BY 1")
def pipeline_counters(spark, sf_dir):
    p = conv_pairs(spark, sf_dir).withColumn("target_locale", F.lit("x"))
    return mining.counters(p, p.filter(F.length("source_text") % 2 == 0).select("source_text"))


# --- text ---


def _strip_html_sql(c: str) -> str:
    no_comment = f"regexp_replace({c}, '(?s)<!--.*?-->', ' ', 'g')"
    no_script = f"regexp_replace(regexp_replace({no_comment}, '(?is)<script\\b[^>]*>.*?</script\\s*>', ' ', 'g'), '(?is)<style\\b[^>]*>.*?</style\\s*>', ' ', 'g')"
    return f"regexp_replace({no_script}, '(?s)<[^>]*>', ' ', 'g')"


def _entities_sql(c: str) -> str:
    for name, sign in T.ENTITIES:
        c = "replace({}, '{}', '{}')".format(c, name, sign.replace("'", "''"))
    return c


def _compound_sql(c: str) -> str:
    for pattern, to in fixed.COMPOUND_RULES:
        c = f"regexp_replace({c}, '(?i){pattern}', '{to}', 'g')"
    return c


def _punct_sql(c: str) -> str:
    return rf"""regexp_replace(translate({c}, '‘’“”–—', '''''""--'), '\s*-\s*', '-', 'g')"""


def _space_sql(c: str) -> str:
    return rf"trim(regexp_replace({c}, '\s+', ' ', 'g'))"


@query(f"SELECT page_id, {_punct_sql(_compound_sql(_space_sql(_entities_sql(_strip_html_sql('html')))))} AS clean FROM pages")
def normalize_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.normalize_text(F.col("html")).alias("clean"))


@query(f"SELECT doc_id, {_space_sql('text')} AS clean FROM documents")
def normalize_whitespace(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.normalize_whitespace(F.col("text")).alias("clean"))


COMPOUNDS = ["Soft T  shirt with V neck", "off white WIDE LEG jeans", "crew neck, round neck and long sleeve", "a line skirt, anti slip, mid rise", "shirt", "t shirts", "high waist low rise drop shoulder short sleeve", "", "{n} T  shirt", "WIDE LEG {n}", "{s} crew neck {n}, anti slip"]


@query(f"SELECT p_partkey, term, {_compound_sql('term')} AS clean FROM {S.part_phrases_sql(COMPOUNDS)}")
def compound_rules(spark, sf_dir):
    return S.part_phrases(spark, sf_dir, COMPOUNDS).select("p_partkey", "term", T.compound_rules(F.col("term")).alias("clean"))


MARKS = ["‘a’ “b”", "one – two — three", "T - shirt", "x-y", "", " - ", "‘{n}’ – “{s}”", "{n} - {s}"]


@query(f"SELECT p_partkey, term, {_punct_sql('term')} AS clean FROM {S.part_phrases_sql(MARKS)}")
def punct_normalise(spark, sf_dir):
    return S.part_phrases(spark, sf_dir, MARKS).select("p_partkey", "term", T.normalize_punctuation(F.col("term")).alias("clean"))


@query(f"WITH {S.TOKENS_SQL} SELECT term, {_strip_term_sql('term')} AS clean, regexp_replace(term, '^[^A-Za-z0-9]+|[^A-Za-z0-9]+$', '', 'g') AS ascii_clean FROM doc_tokens")
def strip_term_punct(spark, sf_dir):
    return S.doc_tokens(spark, sf_dir).select("term", T.strip_term_punctuation(F.col("term")).alias("clean"), T.strip_punctuation(F.col("term")).alias("ascii_clean"))


PREFIXED = ["95% organic cotton", "82 recycled polyester", "100% recycled polyester lining", "organic cotton", "soft organic cotton", "43 cm height", "95 %", "1,5 % elastane", "{s}% {n}", "{s} {n}", "{s}.5 % {n}", "{n} {s}"]


@query(rf"SELECT p_partkey, term, coalesce(nullif(trim(regexp_replace(term, '^[0-9]+([.,][0-9]+)?\s*%?\s+', '')), ''), term) AS clean FROM {S.part_phrases_sql(PREFIXED)}")
def strip_numeric_prefix(spark, sf_dir):
    return S.part_phrases(spark, sf_dir, PREFIXED).select("p_partkey", "term", T.strip_numeric_prefix(F.col("term")).alias("clean"))


def _failed_sql(t: str) -> str:
    n = words_sql(t)
    first = rf"lower(list_filter(regexp_split_to_array({t}, '\s+'), lambda w: w <> '')[1])"
    marks = fixed.PUNCTUATION_MARKS.replace("'", "''")
    black = " OR ".join(f"contains(lower({t}), '{p}')" for p in fixed.PHRASE_BLACKLIST)
    return rf"""CASE WHEN length({t}) < 3 THEN 'too_short'
      WHEN regexp_full_match(replace({t}, ' ', ''), '[0-9]+') OR regexp_matches({t}, '{fixed.NUMBER_PATTERN}') THEN 'number'
      WHEN regexp_matches({t}, '{fixed.SKU_PATTERN}') THEN 'sku'
      WHEN {black} THEN 'blacklist'
      WHEN {n} > 6 THEN 'too_long'
      WHEN {n} = 1 AND lower({t}) IN ({quoted(fixed.STOPWORDS)}) THEN 'stopword'
      WHEN {n} >= 2 AND {first} IN ({quoted(fixed.SENTENCE_STARTERS)}) THEN 'sentence_starter'
      WHEN length({t}) - length(translate({t}, '{marks}', '')) > 2 THEN 'punctuation'
      WHEN NOT regexp_matches({t}, '^[A-Za-z0-9]') THEN 'leading_sign'
      WHEN {n} = 1 AND lower({t}) IN ({quoted(fixed.FILLER_WORDS)}) THEN 'filler'
      WHEN regexp_matches({t}, '(?i)^easy[-\s]to[-\s]wear\b') OR (regexp_matches({t}, '(?i)^perfect\s') AND NOT regexp_matches({t}, '(?i)^perfect\s+for\b')) THEN 'marketing'
      WHEN regexp_matches({t}, '(?i){fixed.DIMENSION_LABEL_PATTERN}') THEN 'dimension_label'
      WHEN regexp_matches({t}, '(?i){fixed.AGE_PATTERN}') THEN 'age_range'
      WHEN regexp_matches({t}, '(?i){fixed.BARE_MEASUREMENT_PATTERN}') THEN 'bare_measurement' END"""


@query(f"WITH {S.TOKENS_SQL} SELECT coalesce(rule, 'valid') AS rule, count(*) AS n FROM (SELECT {_failed_sql('term')} AS rule FROM doc_tokens) GROUP BY 1")
def valid_terms(spark, sf_dir):
    rule = F.coalesce(validity.failed_rule(F.col("term")), F.lit("valid"))
    return S.doc_tokens(spark, sf_dir).groupBy(rule.alias("rule")).agg(F.count("*").alias("n"))


MIXED = [
    "95% organic cotton", "82 recycled polyester", "organic cotton", "100% recycled polyester lining", "soft organic cotton", "95 cm", "73x73 cm", "24x24 cm", "43 cm height",
    "43cm height", "3 years", "8-14 years", "cargo tote", "The best", "TENCEL", "perfect socks", "perfect for you", "easy-to-wear top", "ideal", "12", "ab", "the", "(pu", "a,b.c;d",
    "one two three four five six seven", "Recycled Polyester", "wide leg", "44-54 cm head circumference", "{s}% {n}", "{s} {n}", "The {n}", "({n}", "{n}, {n}. {n}; {s}", "{s} cm height", "{s} years",
    "{s} cm", "perfect {n}", "easy-to-wear {n}", "{n} {n} {n} {n}", "{n}", "AB{s}-{s}", "{s}", *[f"{p} {{n}}" for p in fixed.PHRASE_BLACKLIST[:3]], "{s} {s}x{s}", "{s}000",
]


@query(f"SELECT p_partkey, term, {_failed_sql('term')} AS rule FROM {S.part_phrases_sql(MIXED)}")
def term_rules(spark, sf_dir):
    """Phrases of several words, of which every rule rejects some."""
    return S.part_phrases(spark, sf_dir, MIXED).select("p_partkey", "term", validity.failed_rule(F.col("term")).alias("rule"))


@query(
    rf"""WITH c AS (SELECT p_size AS text_id, p_partkey AS pos, coalesce(nullif(trim(regexp_replace(term, '^[0-9]+([.,][0-9]+)?\s*%?\s+', '')), ''), term) AS term FROM {S.part_phrases_sql(MIXED)}),
    v AS (SELECT *, row_number() OVER (PARTITION BY text_id, lower(term) ORDER BY pos) AS k FROM c WHERE {_failed_sql("term")} IS NULL)
    SELECT text_id, term, lower(term) AS normalized_term FROM v WHERE k = 1"""
)
def filter_candidates(spark, sf_dir):
    rows = S.part_phrases(spark, sf_dir, MIXED).select(F.col("p_size").alias("text_id"), F.col("p_partkey").alias("pos"), "term")
    return terms.filter_candidates(rows, "text_id").select("text_id", "term", "normalized_term")


def _ngram_sql(n: int) -> str:
    return f"SELECT conv_id, turn, {n} AS n, i AS start, list_aggregate(list_slice(ws, i, i + {n - 1}), 'string_agg', ' ') AS p FROM (SELECT *, unnest(generate_series(1, len(ws) - {n - 1})) AS i FROM w WHERE len(ws) >= {n})"


@query(
    rf"""WITH {CONV_SQL}, w AS (SELECT conv_id, turn, list_filter(regexp_split_to_array(target_text, '\s+'), lambda x: x <> '') AS ws FROM conv_pairs),
    g AS ({" UNION ALL ".join(_ngram_sql(n) for n in range(1, 5))}),
    s AS (SELECT *, {_strip_term_sql("p")} AS phrase FROM g)
    SELECT conv_id, turn, count(DISTINCT phrase) AS n_phrases, CAST(sum(DISTINCT length(phrase)) AS BIGINT) AS distinct_lengths, min(phrase) AS first_phrase, max(phrase) AS last_phrase FROM s WHERE phrase <> '' GROUP BY 1, 2"""
)
def target_ngrams(spark, sf_dir):
    p = conv_pairs(spark, sf_dir).select("conv_id", "turn", F.explode_outer(T.target_phrases(F.col("target_text"))).alias("phrase")).filter("phrase IS NOT NULL")
    return p.groupBy("conv_id", "turn").agg(F.count("*").alias("n_phrases"), F.sum_distinct(F.length("phrase").cast("long")).alias("distinct_lengths"), F.min("phrase").alias("first_phrase"), F.max("phrase").alias("last_phrase"))


# --- vectors and alignment ---

COSINE_SQL = "round(list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) / (sqrt(list_inner_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])) * sqrt(list_inner_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[]))), 6)"


@query(f"SELECT a.label, a.vec_id AS id_a, b.vec_id AS id_b, {COSINE_SQL} AS similarity FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id WHERE {COSINE_SQL} >= 0.3")
def align_cosine(spark, sf_dir):
    near = align.near_pairs(table(spark, sf_dir, "embeddings"), "vec_id", "label", 0.29999950)
    return near.withColumn("similarity", F.round("similarity", 6)).filter("similarity >= 0.3")


@query(
    f"SELECT id_a, arg_min(id_b, (-similarity, id_b)) AS best, max(similarity) AS similarity FROM (SELECT a.vec_id AS id_a, b.vec_id AS id_b, {COSINE_SQL} AS similarity FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id) GROUP BY 1"
)
def align_best(spark, sf_dir):
    return nearest.best_in_groups(table(spark, sf_dir, "embeddings"), "vec_id", "label").withColumnRenamed("id_b", "best")


@query()
def align_cosine_all(spark, sf_dir):
    """All pairs of vectors of cosine 0.3 or more, whatever their labels."""
    return align.all_pairs(table(spark, sf_dir, "embeddings"), "vec_id", 0.3)


@query()
def align_best_all(spark, sf_dir):
    """The nearest later vector of each vector among all, copies too, the form of align_best without labels."""
    return nearest.nearest(table(spark, sf_dir, "embeddings"), "vec_id", later=True, copies=True).withColumnRenamed("id_b", "best")


@query()
def align_terms(spark, sf_dir):
    """All words of the user's turn with the phrases of the answer, by hashed character n-grams."""
    p = conv_pairs(spark, sf_dir).withColumn("pair_id", F.struct("conv_id", "turn"))
    asked = p.select("pair_id", F.explode_outer(T.words(F.col("source_text"))).alias("source_term")).filter("source_term IS NOT NULL").distinct()
    found = align.align(asked, p.select("pair_id", "target_text"), "pair_id", align.hashing_encoder())
    return found.select("pair_id.conv_id", "pair_id.turn", "source_term", "target_term", F.round("similarity", 4).alias("similarity"))


# --- domains and extraction ---

SEEDS = [(i, s.lower(), d) for i, (s, d) in enumerate((s, d) for d, many in fixed.DOMAIN_SEEDS.items() for s in many)]
PROBES = ["organic cotton", "Recycled Polyester", "hoodie", "soft hoodie", "cotton", "leg", "knee", "zip", "GOTS certified", "unrelated", "bra", "print", "T-shirt", "wool blend", "sock"]


@query(
    f"""WITH seeds AS (SELECT CAST(i AS INTEGER) AS i, seed, domain FROM {values(SEEDS, "i, seed, domain")}),
    t AS (SELECT p_name AS term FROM part UNION SELECT * FROM {values([(p,) for p in PROBES], "term")})
    SELECT term, coalesce((SELECT arg_max(domain, i) FROM seeds WHERE seed = lower(term)), (SELECT arg_min(domain, i) FROM seeds WHERE contains(seed, lower(term)) OR contains(lower(term), seed)), 'general') AS domain FROM t"""
)
def classify_domain(spark, sf_dir):
    probes = spark.createDataFrame([(p,) for p in PROBES], "term string")
    return table(spark, sf_dir, "part").select(F.col("p_name").alias("term")).union(probes).distinct().select("term", scoring.classify_domain(F.col("term")).alias("domain"))


@query()
def pattern_match_spans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = terms.kept_spans(docs, "doc_id", "text", tagging.fit(docs, "text"))
    return found.select("doc_id", F.size("spans").alias("n_spans"), F.array_join("spans.text", "|").alias("texts"))


@query()
def span_deoverlap(spark, sf_dir):
    """The lines of an order as spans: quantities place them, so that some overlap and some contain others. tests/test_whole.py has the plain fold."""
    start, text = (F.col("l_quantity") % 17).cast("int"), F.col("l_linenumber").cast("string")
    span = F.struct(start.alias("start"), (start + 1 + F.col("l_partkey") % 7).cast("int").alias("end"), text.alias("text"))
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(span).alias("spans"))
    return rows.select("l_orderkey", F.array_join(F.transform(terms.deoverlap(F.col("spans")), lambda s: F.format_string("%d-%d", s["start"], s["end"])), ",").alias("kept"))


@query()
def extract_terms(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return terms.extract(docs, "doc_id", "text", tagging.fit(docs, "text"))


@query(
    rf"""WITH t AS (SELECT doc_id, unnest(list_filter(list_transform(list_filter(regexp_split_to_array(lower(text), '[ \t\n\x0B\f\r]+'), lambda w: w <> ''), lambda w: regexp_replace(w, '^[^A-Za-z0-9]+|[^A-Za-z0-9]+$', '', 'g')), lambda w: length(w) >= 3)) AS term FROM documents),
    c AS (SELECT doc_id, term, count(*) AS f FROM t WHERE term NOT IN ({quoted(fixed.STOPWORDS)}) GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY f DESC, term) AS rank FROM c)
    SELECT doc_id, term, f, CAST(rank AS BIGINT) AS rank FROM r WHERE rank <= 10"""
)
def keywords_topk(spark, sf_dir):
    from pyspark.sql import Window

    w = F.filter(F.transform(F.filter(F.split(F.lower("text"), r"[ \t\n\x0B\f\r]+"), lambda x: x != ""), T.strip_punctuation), lambda x: F.length(x) >= 3)
    t = table(spark, sf_dir, "documents").select("doc_id", F.explode_outer(w).alias("term")).filter(~F.col("term").isin(fixed.STOPWORDS))
    counts = t.groupBy("doc_id", "term").agg(F.count("*").alias("f"))
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("f"), "term"))
    return counts.withColumn("rank", rank.cast("long")).filter("rank <= 10")


@query()
def keyword_fallback(spark, sf_dir):
    return terms.keywords(table(spark, sf_dir, "documents"), "doc_id", "text")


@query()
def keyness(spark, sf_dir):
    return terms.yake_features(table(spark, sf_dir, "documents"), "doc_id", "text")


_LETTER, _SIGN, _DIGIT = r"'\p{L}'", r"[^\p{L}\p{N}]", r"'\p{N}'"


def _joined_sql(a: str, b: str) -> str:
    """Whether two raw words follow each other without signs between them, both with letters and without digits."""
    plain = " AND ".join(f"regexp_matches({c}, {_LETTER}) AND NOT regexp_matches({c}, {_DIGIT})" for c in (a, b))
    return rf"(regexp_matches({a}, '[\p{{L}}\p{{N}}]$') AND regexp_matches({b}, '^[\p{{L}}\p{{N}}]') AND {plain})"


def _core_sql(c: str) -> str:
    return f"regexp_replace({c}, '^{_SIGN}+|{_SIGN}+$', '', 'g')"


@query(
    rf"""WITH parts AS (SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(text, '([.!?])\s+', '\1' || chr(10), 'g'), '\n+'), lambda s: regexp_matches(s, '[\p{{L}}\p{{N}}]')) AS x FROM documents),
    sentences AS (SELECT doc_id, len(x) AS n, unnest(x) AS x, generate_subscripts(x, 1) AS s FROM parts),
    split AS (SELECT doc_id, n, s, list_filter(regexp_split_to_array(x, '\s+'), lambda w: w <> '') AS ws FROM sentences),
    raw AS (SELECT doc_id, n, s, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM split),
    near AS (SELECT *, lag(w) OVER o AS b, lead(w) OVER o AS a FROM raw WINDOW o AS (PARTITION BY doc_id, s ORDER BY pos)),
    tokens AS (SELECT doc_id, n, s, pos, {_core_sql("w")} AS word, CASE WHEN {_joined_sql("b", "w")} THEN lower({_core_sql("b")}) END AS l, CASE WHEN {_joined_sql("w", "a")} THEN lower({_core_sql("a")}) END AS r
      FROM near WHERE regexp_matches(w, {_LETTER}) AND NOT regexp_matches(w, {_DIGIT})),
    cased AS (SELECT *, length(word) > 1 AND NOT regexp_matches(word, '[^\p{{Lu}}]') AS acronym FROM tokens),
    words AS (SELECT doc_id, lower(word) AS t, count(*)::DOUBLE AS tf, max(n) AS n, greatest(count(*) FILTER (NOT acronym AND pos > 1 AND regexp_matches(word, '^\p{{Lu}}')), count(*) FILTER (acronym))::DOUBLE AS cased,
      median(DISTINCT s - 1) AS mid, count(DISTINCT s) AS spread, count(DISTINCT l) / greatest(count(l), 1) + count(DISTINCT r) / greatest(count(r), 1) AS sides FROM cased GROUP BY ALL),
    f AS (SELECT *, t IN ({quoted(fixed.STOPWORDS)}) OR length(t) < 3 AS stop FROM words),
    d AS (SELECT doc_id, max(tf) AS most, avg(tf) FILTER (NOT stop) + stddev_pop(tf) FILTER (NOT stop) AS usual FROM f GROUP BY 1),
    p AS (SELECT f.*, usual, 1 + sides * tf / most AS rel, ln(ln(3 + mid)) AS place FROM f JOIN d USING (doc_id) WHERE NOT stop)
    SELECT doc_id, t AS term, tf::BIGINT AS frequency, round(rel * place / (cased / (1 + ln(tf)) + tf / usual / rel + spread / n / rel), 6) AS weight FROM p"""
)
def keyword_weights(spark, sf_dir):
    return keywords.word_weights(table(spark, sf_dir, "documents"), "doc_id", "text").withColumn("weight", F.round("weight", 6))


@query()
def statistical_keywords(spark, sf_dir):
    """tests/test_keywords.py has the plain version."""
    return keywords.statistical(table(spark, sf_dir, "documents"), "doc_id", "text")


@query()
def embedding_keywords(spark, sf_dir):
    """tests/test_keywords.py has the plain version."""
    return keywords.embedded(table(spark, sf_dir, "documents"), "doc_id", "text")


# --- duplicates ---


@query(
    f"""WITH {S.ASCII_SQL.replace("ascii_terms AS", "unused AS")}, t AS (SELECT DISTINCT term FROM doc_tokens WHERE regexp_full_match(term, '[A-Za-z]+')),
    g AS (SELECT *, lower(term) AS norm, length(regexp_replace(term, '[^A-Z]', '', 'g')) AS u FROM t),
    c AS (SELECT norm, arg_min(term, (CASE WHEN term <> norm THEN 1 ELSE 0 END, u, term)) AS canonical, count(*) AS group_size FROM g GROUP BY 1)
    SELECT g.term, c.canonical, c.group_size FROM g JOIN c USING (norm)"""
)
def case_canonical(spark, sf_dir):
    return dedupe.case_canonical(S.doc_tokens(spark, sf_dir).filter(F.col("term").rlike("^[A-Za-z]+$")))


@query(
    f"""WITH {S.TOKENS_SQL}, g AS (SELECT term, regexp_replace(term, '^[^A-Za-z0-9]+|[^A-Za-z0-9]+$', '', 'g') AS stripped FROM doc_tokens)
    SELECT stripped, string_agg(term, ' ' ORDER BY term) AS members, count(*) AS size FROM g WHERE stripped <> '' GROUP BY 1 HAVING count(*) > 1"""
)
def punct_groups(spark, sf_dir):
    return dedupe.punctuation_groups(S.doc_tokens(spark, sf_dir)).select("stripped", F.array_join("members", " ").alias("members"), "size")


def _lev_sql(key: str) -> str:
    return f"""WITH {S.ASCII_SQL}, r AS (SELECT term, row_number() OVER (ORDER BY {key}, term) AS n FROM ascii_terms),
    p AS (SELECT a.term AS a, b.term AS b FROM r a JOIN r b ON b.n BETWEEN a.n + 1 AND a.n + 119 WHERE abs(length(a.term) - length(b.term)) <= 2)
    SELECT a, b, levenshtein(a, b)::BIGINT AS distance FROM p WHERE levenshtein(a, b) BETWEEN 1 AND CASE WHEN greatest(length(a), length(b)) <= 8 THEN 1 ELSE 2 END"""


@query(_lev_sql("term"))
def lev_forward(spark, sf_dir):
    return dedupe.banded(S.ascii_terms(spark, sf_dir))


@query(_lev_sql("reverse(term)"))
def lev_reverse(spark, sf_dir):
    return dedupe.banded(S.ascii_terms(spark, sf_dir), reverse=True)


@query(
    f"""WITH {S.ASCII_SQL}, r AS (SELECT term, row_number() OVER (ORDER BY term) AS n, row_number() OVER (ORDER BY reverse(term), term) AS m FROM ascii_terms),
    p AS (SELECT a.term AS a, b.term AS b FROM r a JOIN r b ON b.n BETWEEN a.n + 1 AND a.n + 119 WHERE abs(length(a.term) - length(b.term)) <= 2
          UNION SELECT least(a.term, b.term), greatest(a.term, b.term) FROM r a JOIN r b ON b.m BETWEEN a.m + 1 AND a.m + 119 WHERE abs(length(a.term) - length(b.term)) <= 2)
    SELECT 'levenshtein' AS kind, 'Edit distance ' || levenshtein(a, b) AS reason, a || '|' || b AS members FROM p
    WHERE levenshtein(a, b) BETWEEN 1 AND CASE WHEN greatest(length(a), length(b)) <= 8 THEN 1 ELSE 2 END"""
)
def similar_groups(spark, sf_dir):
    return dedupe.similar_groups(S.ascii_terms(spark, sf_dir)).select("kind", "reason", F.array_join("members", "|").alias("members"))


MERGE_PAIRS = [
    "mid-length|midi length", "V neck|v-neck", "10 cm|12 cm", "turn-up hem|turn up hem", "50 cotton|50% cotton", "contain wool|contains wool", "12cm|12 cm", "soft.|soft", "soft|soft.", "ribbed|robbed", "blue.|glue.",
    "{n}-{s}|{n} {s}", "{s} {n}|{s}% {n}", "{s}% {n}|{s} % {n}", "contain {n}|contains {n}", "{s}cm {n}|{s} cm {n}", "{n}.|{n}", "{n} {s}|{n} {s}.", "{n} {s}|{n} 1{s}", "{n}|{n}s", "{n}|{n}",
]


def _merge_sql() -> str:
    """The rules in SQL, each by itself: x and y are the compare forms of a and b."""
    form = lambda c: rf"regexp_replace(lower(trim({c})), '\s+', ' ', 'g')"
    equal = lambda pattern, by: f"regexp_replace(x, '{pattern}', '{by}', 'g') = regexp_replace(y, '{pattern}', '{by}', 'g')"
    synonyms = values(list(fixed.SYNONYMS), "s, t, best")
    return rf"""WITH p AS (SELECT p_partkey, split_part(term, '|', 1) AS a, split_part(term, '|', 2) AS b FROM {S.part_phrases_sql(MERGE_PAIRS)}),
    f AS (SELECT *, {form('a')} AS x, {form('b')} AS y FROM p),
    k AS (SELECT f.*, (SELECT min(best) FROM {synonyms} z WHERE (z.s = x AND z.t = y) OR (z.s = y AND z.t = x)) AS known FROM f),
    r AS (SELECT *, CASE WHEN known IS NOT NULL THEN 'synonyms' WHEN regexp_extract_all(a, '[0-9]+') <> regexp_extract_all(b, '[0-9]+') THEN 'different numbers'
      WHEN x <> y AND replace(x, '-', ' ') = replace(y, '-', ' ') THEN 'hyphen or space'
      WHEN (contains(a, '%') OR contains(b, '%')) AND trim(regexp_replace(replace(x, '%', ''), '\s+', ' ', 'g')) = trim(regexp_replace(replace(y, '%', ''), '\s+', ' ', 'g')) THEN 'percent sign'
      WHEN x <> y AND {equal(chr(92) + 'bcontains' + chr(92) + 'b', 'contain')} THEN 'contain or contains'
      WHEN x <> y AND {equal('([0-9])([a-zA-Z])', chr(92) + '1 ' + chr(92) + '2')} THEN 'space before a unit'
      WHEN rtrim(x, '.') = rtrim(y, '.') THEN 'final period' ELSE 'no rule applies' END AS reason FROM k)
    SELECT p_partkey, a, b, CASE WHEN reason IN ('different numbers', 'no rule applies') THEN 'keep_separate' ELSE 'merge' END AS action,
      CASE reason WHEN 'synonyms' THEN CASE WHEN x = known THEN a ELSE b END WHEN 'hyphen or space' THEN CASE WHEN contains(a, '-') THEN a ELSE b END
        WHEN 'percent sign' THEN CASE WHEN contains(a, '%') THEN a ELSE b END WHEN 'contain or contains' THEN CASE WHEN regexp_matches(a, '(?i)contains') THEN a ELSE b END
        WHEN 'space before a unit' THEN CASE WHEN regexp_matches(a, '[0-9] [a-zA-Z]') THEN a ELSE b END WHEN 'final period' THEN CASE WHEN a LIKE '%.' THEN b ELSE a END END AS canonical, reason FROM r"""


@query(_merge_sql())
def merge_decisions(spark, sf_dir):
    """Pairs of phrases of the parts, of which every rule decides some."""
    sides = F.split("term", "[|]")
    rows = S.part_phrases(spark, sf_dir, MERGE_PAIRS).select("p_partkey", F.get(sides, F.lit(0)).alias("a"), F.get(sides, F.lit(1)).alias("b"))
    return rows.withColumn("d", merging.decide(F.col("a"), F.col("b"))).select("p_partkey", "a", "b", "d.action", "d.canonical", "d.reason")


@query(
    f"""WITH {S.ASCII_SQL}, r AS (SELECT term, row_number() OVER (ORDER BY term) AS n FROM ascii_terms),
    m AS (SELECT a.term AS alias, min(b.term) AS canonical FROM r a JOIN r b ON b.n BETWEEN a.n + 1 AND a.n + 3 WHERE length(a.term) = length(b.term) GROUP BY 1),
    s AS (SELECT t.term, coalesce(m.canonical, t.term) AS step FROM ascii_terms t LEFT JOIN m ON m.alias = t.term)
    SELECT s.term AS source_term, coalesce(m.canonical, s.step) AS canonical FROM s LEFT JOIN m ON m.alias = s.step"""
)
def canonical_resolve(spark, sf_dir):
    t = S.ascii_terms(spark, sf_dir)
    near = dedupe.neighbours(t, F.col("t"), 3).filter(F.length("a") == F.length("b"))
    cmap = near.groupBy(F.col("a").alias("alias")).agg(F.min("b").alias("canonical"))
    return dedupe.resolve(t.select(F.col("term").alias("source_term")), cmap).select("source_term", "canonical")


@query()
def similar_groups_all(spark, sf_dir):
    """The groups over all tokens; similar_groups has SQL and takes ASCII words of six letters or more."""
    return dedupe.similar_groups(S.doc_tokens(spark, sf_dir)).select("kind", "reason", F.array_join("members", "|").alias("members"))


@query()
def case_canonical_all(spark, sf_dir):
    return dedupe.case_canonical(S.doc_tokens(spark, sf_dir))


@query()
def group_decisions(spark, sf_dir):
    groups = dedupe.similar_groups(S.doc_tokens(spark, sf_dir))
    return dedupe.decide_groups(groups).select("group_key", "action", "canonical", "reason")


# --- glossaries and quality ---


def _pivot_sql(rows: str, key: str, rank: str) -> str:
    cols = ", ".join(f"coalesce(max(CASE WHEN target_locale = '{x}' THEN v END), '') AS \"{x}\"" for x in fixed.TARGET_LOCALES)
    return f"SELECT k AS en, {cols} FROM (SELECT {key} AS k, target_locale, arg_min(target_term, {rank}) AS v FROM {rows} GROUP BY 1, 2) GROUP BY 1"


@query(
    with_candidates(
        ", e AS (SELECT * FROM candidates WHERE status IN ('approved', 'phase2_verbatim_entry') AND similarity >= 0.85) "
        + _pivot_sql("e", "source_term", "CASE WHEN target_term <> '' THEN id END")
    )
)
def glossary_first_wins(spark, sf_dir):
    return glossary.pivot_first(glossary.exportable(S.candidates(spark, sf_dir)))


BEST_SQL = ", e AS (SELECT *, lower(source_term) AS canonical FROM candidates WHERE trim(target_term) <> '') "


@query(with_candidates(BEST_SQL + _pivot_sql("e", "canonical", "(-final_score, -frequency, id)")))
def glossary_argmax(spark, sf_dir):
    c = S.candidates(spark, sf_dir).withColumn("canonical", T.normalize_case(F.col("source_term")))
    return glossary.pivot_best(c)


@query(
    with_candidates(
        BEST_SQL + f'SELECT "de-DE", en, "sv-SE", "fi-FI", "nb-NO", "pl-PL" FROM ({_pivot_sql("e", "canonical", "(-final_score, -frequency, id)")}) WHERE trim("de-DE") <> \'\''
    )
)
def glossary_rebase(spark, sf_dir):
    return glossary.rebase(glossary_argmax(spark, sf_dir), "de-DE")


@query(
    with_candidates(
        BEST_SQL
        + f", g AS ({_pivot_sql('e', 'canonical', '(-final_score, -frequency, id)')}) "
        + " UNION ALL ".join(
            f"SELECT '{x}' AS locale, count(*) FILTER (WHERE \"{x}\" <> '') AS translated, count(*) AS total, round(count(*) FILTER (WHERE \"{x}\" <> '') * 100.0::DOUBLE / count(*), 4) AS percent FROM g"
            for x in fixed.TARGET_LOCALES
        )
    )
)
def coverage(spark, sf_dir):
    return glossary.coverage(glossary_argmax(spark, sf_dir))


@query(
    with_candidates(
        ", c AS (SELECT *, lower(source_term) AS canonical FROM candidates WHERE trim(target_term) <> '') " + _pivot_sql("c", "canonical", "(-final_score, -frequency, id)")
    )
)
def deduplicated_glossary(spark, sf_dir):
    """The whole export with no merge decisions: case folding alone decides the terms."""
    c = S.candidates(spark, sf_dir)
    none = spark.createDataFrame([], "action string, canonical string, aliases array<string>, seq long")
    return curation.deduplicated_glossary(c, none)


@query()
def merged_glossary(spark, sf_dir):
    """The whole export with the merges that the rules decide; deduplicated_glossary has SQL and takes none."""
    return curation.deduplicated_glossary(S.candidates(spark, sf_dir))


def _measure_sql(t: str) -> str:
    units = fixed.EXPORT_UNITS
    return rf"(regexp_matches({t}, '(?i)^[0-9\s.,x×\-/()]+({units})?$') OR regexp_matches({t}, '(?i)^[0-9.,]+(\s*[x×/]\s*[0-9.,]+)*(\s*({units}))?$') OR regexp_matches({t}, '(?i)^({units})$'))"


MEASURES = ["100 cm", "82%", "60x60", "18x25 cm", "180 80 cm", "12 x", "10,000 mm water column", "23 cm Shoulder strap", "width cm", "5-pack", "cm", "Inches", "{s} cm", "{s}x{s} cm", "{s} {n}", "{s},{s} x {s}", "{n} cm"]


@query(
    f"SELECT p_partkey, term, {_measure_sql('term')} AS measurement FROM {S.part_phrases_sql(MEASURES)}"
)
def pure_measurements(spark, sf_dir):
    return S.part_phrases(spark, sf_dir, MEASURES).select("p_partkey", "term", validity.is_measurement(F.col("term")).alias("measurement"))


def _flags_sql(t: str) -> str:
    n = words_sql(t)
    conds = {
        "A": f"regexp_matches({t}, '^[^A-Za-z0-9]')", "B": f"{n} = 1 AND lower({t}) IN ({quoted(fixed.QUALITY_FILLERS)})",
        "C": f"regexp_matches({t}, '(?i){fixed.MARKETING_PATTERN}')", "D": f"regexp_matches({t}, '(?i){fixed.CARE_PATTERN}')",
        "E": f"contains({t}, ',') AND (({n} >= 6 AND regexp_matches({t}, '(?i){fixed.SENTENCE_VERB_PATTERN}')) OR {n} >= 9)",
        "F": f"regexp_matches({t}, '(?i){fixed.SIZE_CHART_PATTERN}')", "G": f"{n} >= 7", "H": f"regexp_matches({t}, '(?i){fixed.YEAR_PATTERN}')",
    }
    return "concat(" + ", ".join(f"CASE WHEN {c} THEN '{k}' ELSE '' END" for k, c in conds.items()) + ")"


@query(f"WITH {S.LINES_SQL}, f AS (SELECT {_flags_sql('term')} AS flags FROM lines) SELECT flag, count(*) AS n FROM (SELECT unnest(string_split(flags, '')) AS flag FROM f WHERE flags <> '') GROUP BY 1")
def quality_flags(spark, sf_dir):
    return glossary.quality_counts(S.lines(spark, sf_dir))


@query(
    f"WITH {S.LINES_SQL}, f AS (SELECT {_flags_sql('term')} AS flags FROM lines) SELECT CASE WHEN regexp_matches(flags, '[AB]') THEN 'auto_exclude' WHEN regexp_matches(flags, '[CDH]') THEN 'recommend_exclude' WHEN flags <> '' THEN 'review' ELSE 'clean' END AS bucket, count(*) AS n FROM f GROUP BY 1"
)
def quality_buckets(spark, sf_dir):
    return glossary.quality_buckets(S.lines(spark, sf_dir))


LABELLED = ["(pu", "Ideal", "perfect socks", "machine wash cold", "This jacket is warm, light and soft", "23/24-15.8 cm", "109 cm tall, select size", "3 years", "organic cotton", "iron at 3", "100% cotton", "({n}", "{n} is warm, light and {s} {n}", "{s} years", "perfect {n}", "{n}", "iron {n} at {s}", "{n} {n} {n} {n}"]


@query(f"SELECT p_partkey, term, {_flags_sql('term')} AS flags FROM {S.part_phrases_sql(LABELLED)}")
def quality_flags_of_terms(spark, sf_dir):
    return S.part_phrases(spark, sf_dir, LABELLED).select("p_partkey", "term", F.array_join(validity.quality_flags(F.col("term")), "").alias("flags"))


@query(f"WITH {S.LINES_SQL}, c AS (SELECT CAST({words_sql('term')} AS BIGINT) AS n_words, count(*) AS n FROM lines GROUP BY 1) SELECT n_words, n, round(n * 100.0::DOUBLE / sum(n) OVER (), 4) AS percent FROM c")
def wordcount_hist(spark, sf_dir):
    return glossary.word_histogram(S.lines(spark, sf_dir))


NUMBERED_SQL = "n AS (SELECT CASE p_size % 4 WHEN 0 THEN p_size || '% ' || p_name WHEN 1 THEN (p_size + 10) || ' ' || p_name ELSE p_name END AS source_term, p_brand AS target_locale FROM part)"


def numbered_terms(spark, sf_dir):
    p, size = table(spark, sf_dir, "part"), F.col("p_size")
    term = F.when(size % 4 == 0, F.concat(size.cast("string"), F.lit("% "), F.col("p_name"))).when(size % 4 == 1, F.concat((size + 10).cast("string"), F.lit(" "), F.col("p_name"))).otherwise(F.col("p_name"))
    return p.select(term.alias("source_term"), F.col("p_brand").alias("target_locale"))


@query(f"WITH {NUMBERED_SQL} SELECT source_term, count(*) AS n, string_agg(DISTINCT target_locale, ',' ORDER BY target_locale) AS locales FROM n WHERE regexp_matches(source_term, '^[0-9].*%') OR regexp_matches(source_term, '^[0-9][0-9].* ') GROUP BY 1")
def number_prefixed_terms(spark, sf_dir):
    return glossary.number_prefixed(numbered_terms(spark, sf_dir))


@query(f"WITH {NUMBERED_SQL} SELECT source_term, count(*) AS n FROM n WHERE lower(source_term) LIKE '%bolt%' GROUP BY 1")
def phrase_variants(spark, sf_dir):
    return glossary.phrase_variants(numbered_terms(spark, sf_dir), "bolt")


@query("SELECT p_partkey, p_name FROM part ORDER BY md5('s1:' || p_partkey), p_partkey LIMIT 40")
def seeded_sample(spark, sf_dir):
    return glossary.seeded_sample(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey", 40, "s1")


@query(
    f"""WITH {S.TOKENS_SQL} SELECT term AS source_term, {_strip_term_sql('term')} AS new_source_term FROM doc_tokens WHERE {_strip_term_sql('term')} <> term"""
)
def punct_repair_diff(spark, sf_dir):
    rows = S.doc_tokens(spark, sf_dir).select(F.lit(0).cast("long").alias("id"), F.col("term").alias("source_term"), F.lit("x").alias("target_term"), F.lower("term").alias("normalized_source"), F.lit("x").alias("normalized_target"))
    return store.repair_punctuation(rows)[1].select("source_term", "new_source_term")


@query("SELECT item_id, greatest(instr(lower(text), 'the en') - 1, 0) AS start, greatest(CASE WHEN instr(lower(text), 'the en') > 0 THEN instr(lower(text), 'the en') + 5 ELSE -1 END, 0) AS stop FROM benchmark")
def find_offsets(spark, sf_dir):
    span = T.find_span(F.col("text"), F.lit("The en"))
    return table(spark, sf_dir, "benchmark").select("item_id", span["start"].cast("long").alias("start"), span["end"].cast("long").alias("stop"))


@query(
    with_candidates(
        """SELECT id, 'Term: ' || source_term || chr(10) || 'Translation: ' || target_term || chr(10) || 'Similarity: ' || format('{:.3f}', similarity)
        || CASE WHEN lower(source_term) = lower(target_term) THEN chr(10) || 'Both sides are equal: is it a brand?' ELSE '' END AS prompt FROM candidates"""
    )
)
def user_prompts(spark, sf_dir):
    return S.candidates(spark, sf_dir).select("id", review.user_prompt(2).alias("prompt"))


@query()
def decision_tallies(spark, sf_dir):
    return dedupe.tallies(dedupe.decide_groups(dedupe.similar_groups(S.doc_tokens(spark, sf_dir))))


@query(
    with_candidates(
        """, b AS (SELECT source_term, target_locale, arg_max(target_term, (final_score, frequency, target_term)) AS best, sum(frequency) AS f, max(final_score) AS s FROM candidates GROUP BY 1, 2)
        SELECT source_term, CAST(sum(f) AS BIGINT) AS total_frequency, max(s) AS best_score, string_agg(target_locale || '=' || best, ';' ORDER BY target_locale) AS translations FROM b GROUP BY 1"""
    )
)
def group_preview(spark, sf_dir):
    c = S.candidates(spark, sf_dir)
    groups = c.select("source_term").distinct().select(dedupe.group_key(F.array("source_term")).alias("group_key"), F.array("source_term").alias("members"))
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("translations")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return dedupe.preview(groups, c).select("source_term", "total_frequency", "best_score", shown.alias("translations"))


GROUPS = ["100 cm|90 cm", "100 cm|100 cm wide", "82%|82 %", "wool|woll", "{s} cm|{s}cm", "{s} cm|{n}", "{n}|{s}%", "{s}x{s}|{s}"]


@query(f"SELECT p_partkey, term AS members FROM {S.part_phrases_sql(GROUPS)} WHERE len(list_filter(string_split(term, '|'), lambda m: NOT {_measure_sql('m')})) > 0")
def measurement_groups(spark, sf_dir):
    rows = S.part_phrases(spark, sf_dir, GROUPS).select("p_partkey", F.split("term", "[|]").alias("members"))
    return dedupe.drop_measurement_groups(rows).select("p_partkey", F.array_join("members", "|").alias("members"))


EXCLUDED = [*fixed.EXPORT_EXCLUSIONS, "Ideal", "wool", "BRIEFS", "{n}"]


@query(f"SELECT p_partkey, term FROM {S.part_phrases_sql(EXCLUDED)} WHERE lower(term) NOT IN ({quoted(fixed.EXPORT_EXCLUSIONS)})")
def exclusions(spark, sf_dir):
    return S.part_phrases(spark, sf_dir, EXCLUDED).select("p_partkey", "term").filter(~validity.is_excluded(F.col("term")))


@query(with_candidates("SELECT target_locale, string_agg(DISTINCT evidence_product_ids, ',' ORDER BY evidence_product_ids) AS ids FROM candidates GROUP BY 1"))
def evidence_as_json(spark, sf_dir):
    """Lists go to JSON text at the edge and come back whole."""
    lists = S.candidates(spark, sf_dir).groupBy("target_locale").agg(F.to_json(F.array_sort(F.collect_set("evidence_product_ids"))).alias("j"))
    return lists.select("target_locale", F.array_join(F.from_json("j", "array<string>"), ",").alias("ids"))


@query()
def mine_candidates(spark, sf_dir):
    """The whole mining plan over the stand-in sheet."""
    return mining.mine(S.wide_items(spark, sf_dir), None, align.hashing_encoder()).select(*store.KEY, "source_term", "target_term", "frequency", "final_score", "status")


# --- jobs ---


def _job_folder(spark, name: str) -> str:
    """A new folder in the shared one; its files stay."""
    return f"{scratch_dir(spark).rstrip('/')}/jobs/{name}-{uuid.uuid4().hex}"


@query(
    rf"""WITH w AS (SELECT doc_id, coalesce(nullif(lang, ''), 'und') AS lang, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS ws FROM documents),
    g AS (SELECT doc_id, lang, unnest(list_concat(ws, list_transform(generate_series(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1]))) AS p, row FROM (SELECT *, row_number() OVER () AS row FROM w)),
    t AS (SELECT DISTINCT row, doc_id, lang, {_strip_term_sql("p")} AS term FROM g),
    c AS (SELECT lang, term, count(*) AS n_docs, min(doc_id) AS first_doc, max(doc_id) AS last_doc FROM t WHERE term <> '' GROUP BY 1, 2)
    SELECT lang, term, n_docs, first_doc, last_doc, CASE WHEN n_docs >= 3 THEN 'needs_review' ELSE 'rare' END AS status FROM c WHERE {_failed_sql("term")} IS NULL"""
)
def job1_term_ledger(spark, sf_dir):
    """The ledger of all documents, after a second run that finds nothing new."""
    folder = _job_folder(spark, "term-ledger")
    for _ in range(2):
        term_ledger.run(spark, f"{sf_dir}/documents.parquet", f"{folder}/out", f"{folder}/checkpoint")
    return term_ledger.read(spark, f"{folder}/out/terms", term_ledger.TERMS).select("lang", "term", "n_docs", "first_doc", "last_doc", "status")


@query(
    with_candidates(
        BEST_SQL
        + f""", g AS ({_pivot_sql("e", "canonical", "(-final_score, -frequency, id)")}), f AS (SELECT en, {_flags_sql("en")} AS flags FROM g)
        SELECT 'audit' AS part, en AS term, CASE WHEN regexp_matches(flags, '[AB]') THEN 'auto_exclude' WHEN regexp_matches(flags, '[CDH]') THEN 'recommend_exclude' WHEN flags <> '' THEN 'review' ELSE 'clean' END AS place, flags AS value FROM f"""
        + "".join(f" UNION ALL SELECT 'glossary', en, '{x}', \"{x}\" FROM g WHERE \"{x}\" <> ''" for x in fixed.TARGET_LOCALES)
        + "".join(f" UNION ALL SELECT 'coverage', NULL, '{x}', count(*) FILTER (WHERE \"{x}\" <> '') || '/' || count(*) FROM g" for x in fixed.TARGET_LOCALES)
    )
)
def job2_glossary_release(spark, sf_dir):
    """The three tables of a release that was made twice, as one."""
    folder = _job_folder(spark, "glossary-release")
    for _ in range(2):
        glossary_release.run(spark, sf_dir, folder)
    found, audited, covered = glossary_release.read(spark, folder)
    none = F.lit(None).cast("string")
    return (
        audited.select(F.lit("audit").alias("part"), "term", F.col("bucket").alias("place"), F.coalesce("flags", F.lit("")).alias("value"))
        .unionByName(found.select(F.lit("glossary").alias("part"), "term", F.col("target_locale").alias("place"), F.col("translation").alias("value")))
        .unionByName(covered.select(F.lit("coverage").alias("part"), none.alias("term"), F.col("locale").alias("place"), F.concat_ws("/", "translated", "total").alias("value")))
    )
