"""The candidate table as immutable snapshots: upsert fold, updates, repair and filtered reads.

A snapshot is a DataFrame. "First" and "last" mean arrival order, so every event carries a `seq` (any orderable value,
also a struct); no operator relies on the order of rows in a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexispark import fixed
from lexispark.functions import text as T

KEY = ["source_locale", "target_locale", "normalized_source", "domain"]
FIRST = ["id", "source_term", "target_term", "normalized_target", "category", "field_origin", "status", "source_context", "target_context", "reviewer_notes", "created_at"]
LAST = ["evidence_product_ids", "updated_at"]

#: The columns of the candidate table in their order, with the names that this engine gives the two scores.
SCHEMA = (
    "id long not null, source_locale string not null, target_locale string not null, source_term string not null, target_term string not null, "
    "normalized_source string not null, normalized_target string not null, domain string, category string, field_origin string, frequency long, "
    "similarity double, final_score double, status string, source_context string, target_context string, evidence_product_ids string, "
    "reviewer_notes string, created_at timestamp, updated_at timestamp"
)
#: What a row gets where it names none.
DEFAULTS = {"frequency": 1, "status": "needs_review"}


def key_id() -> Column:
    """An id that the key alone decides: 52 bits of its MD5, so it stays the same however often and wherever the row is made.

    The names of two keys may join to one text, so each is preceded by its length; nulls differ from empty names.
    """
    parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in KEY]
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 13), 16, 10).cast("long")


def declared(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """Rows in the declared schema: its columns, order and types, and no others.

    Missing ids come from the key, missing categories from the domain, missing times from now, other missing values from DEFAULTS or are null. A null
    in a column that forbids it, and a value that can't be cast, stop the job when it runs.
    """
    now = F.current_timestamp() if now is None else now
    given = lambda name: F.col(name) if name in rows.columns else F.lit(None)
    rest = {"id": key_id(), "category": given("domain"), "created_at": now, "updated_at": now} | {c: F.lit(v) for c, v in DEFAULTS.items()}
    columns = []
    for field in StructType.fromDDL(SCHEMA):
        value = F.coalesce(given(field.name), rest[field.name]) if field.name in rest else given(field.name)
        value = value.cast(field.dataType)
        if not field.nullable:
            value = F.when(value.isNull(), F.raise_error(F.lit(f"{field.name} is null")).cast(field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    return rows.select(*columns)


def fold(events: DataFrame, seq: str = "seq") -> DataFrame:
    """Fold events per key in the order of seq, as upserting them one by one would.

    The first event supplies the payload; frequency is its own plus one for each later event; the two scores
    are maxima; the evidence is the last event's. Partial aggregates make this safe for a hot key. If events carry
    `n_hits` (a fold's own output), later events count for that many.
    """
    payload = [c for c in FIRST if c in events.columns]
    last = [c for c in LAST if c in events.columns]
    hits = F.col("n_hits") if "n_hits" in events.columns else F.lit(1)
    first = F.min_by(F.struct(*payload, "frequency", hits.alias("n_hits")), F.col(seq))
    aggs = [first.alias("__first"), F.sum(hits).alias("n_hits"), F.max("similarity").alias("similarity"), F.max("final_score").alias("final_score")]
    aggs += [F.max_by(c, seq).alias(c) for c in last]
    return events.groupBy(*KEY).agg(*aggs).select(
        *KEY,
        *[F.col(f"__first.{c}").alias(c) for c in payload],
        (F.col("__first.frequency") + F.col("n_hits") - F.col("__first.n_hits")).cast("long").alias("frequency"),
        "similarity", "final_score", *last, F.col("n_hits").cast("long").alias("n_hits"),
    )


def upsert(snapshot: DataFrame, incoming: DataFrame, seq: str = "seq") -> DataFrame:
    """Fold incoming events onto a snapshot: its rows come before all events."""
    old = snapshot.withColumn("__order", F.struct(F.lit(0).alias("gen"), F.lit(None).cast(incoming.schema[seq].dataType).alias("seq")))
    new = incoming.withColumn("__order", F.struct(F.lit(1).alias("gen"), F.col(seq).alias("seq")))
    # a snapshot row stands for n_hits events but only for one insertion now: its frequency already holds them
    old = old.withColumn("n_hits", F.lit(1).cast("long"))
    new = new.withColumn("n_hits", F.lit(1).cast("long"))
    return fold(old.unionByName(new.drop(seq), allowMissingColumns=True), "__order")


def _last(changes: DataFrame, key: str, seq: str, out: str) -> DataFrame:
    """The last change of each key as a struct (seq, status, reviewer_notes): one whole change, never parts of several."""
    order = F.struct(F.col(seq).alias("seq"), "status", "reviewer_notes") if seq in changes.columns else F.struct(F.lit(0).alias("seq"), "status", "reviewer_notes")
    return changes.groupBy(key).agg(F.max(order).alias(out))


def update_status(candidates: DataFrame, changes: DataFrame, seq: str = "seq", now: Column | None = None) -> DataFrame:
    """Set status and reviewer_notes by id, as if the changes came one by one in the order of seq: the last of an id counts, its null note as well.

    changes: id, status, reviewer_notes and seq (without it, or at one seq, the change of the greatest status and note counts).
    """
    return _apply(candidates, candidates.join(_last(changes, "id", seq, "__change"), "id", "left"), now)


def write_back(candidates: DataFrame, judgments: DataFrame, seq: str = "seq", now: Column | None = None) -> DataFrame:
    """Apply judgments as if one by one in the order of seq: those with an id to that row, others to all rows with their normalized_source.

    Of all that meet a row the last counts, its null note as well; at one seq an id beats a term.
    """
    by_id = _last(judgments.filter("id IS NOT NULL"), "id", seq, "__by_id")
    by_term = _last(judgments.filter("id IS NULL"), "normalized_source", seq, "__by_term")
    rows = candidates.join(by_id, "id", "left").join(by_term, "normalized_source", "left")
    own = F.col("__by_term").isNull() | (F.col("__by_id.seq") >= F.col("__by_term.seq"))
    return _apply(candidates, rows.withColumn("__change", F.when(own, F.col("__by_id")).otherwise(F.col("__by_term"))), now)


def _apply(candidates: DataFrame, rows: DataFrame, now: Column | None) -> DataFrame:
    hit = F.col("__change").isNotNull()
    changed = {c: F.when(hit, F.col(f"__change.{c}")).otherwise(F.col(c)) for c in ("status", "reviewer_notes")}
    if now is not None and "updated_at" in candidates.columns:
        changed["updated_at"] = F.when(hit, now).otherwise(F.col("updated_at"))
    return rows.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in candidates.columns])


def repair_punctuation(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Strip edge punctuation from both terms. Returns the repaired table and the diff.

    Rows with an empty term are removed. The key of the table is unique: rows whose keys meet after the repair become one, the one of the least id, with the sum of
    their frequencies and the best of their scores.
    """
    clean = candidates.withColumns({f"__{c}": T.strip_term_punctuation(F.col(c)) for c in ("source_term", "target_term")})
    changed = ~(F.col("__source_term").eqNullSafe(F.col("source_term")) & F.col("__target_term").eqNullSafe(F.col("target_term")))
    diff = clean.filter(changed).select("id", "source_term", F.col("__source_term").alias("new_source_term"), "target_term", F.col("__target_term").alias("new_target_term"))
    new = {"source_term": F.col("__source_term"), "target_term": F.col("__target_term")}
    new["normalized_source"] = F.when(changed, T.normalize_case(new["source_term"])).otherwise(F.col("normalized_source"))
    new["normalized_target"] = F.when(changed, T.normalize_case(new["target_term"])).otherwise(F.col("normalized_target"))
    repaired = clean.select(*[new[c].alias(c) if c in new else F.col(c) for c in candidates.columns])
    return _one_per_key(delete_empty(repaired)), diff


def _one_per_key(rows: DataFrame) -> DataFrame:
    """Rows that share a key as one; without the columns of the key, and for null terms, rows stay as they are."""
    if not set(KEY) <= set(rows.columns):
        return rows
    merged = {"frequency": F.sum, "n_hits": F.sum, "similarity": F.max, "final_score": F.max, "created_at": F.min, "updated_at": F.max}
    rest = [c for c in rows.columns if c not in KEY]
    alone = F.when(F.col("normalized_source").isNull(), F.col("id"))
    found = rows.groupBy(*KEY, alone.alias("__alone")).agg(F.min_by(F.struct(*rest), F.col("id")).alias("__first"), *[f(c).alias(f"__{c}") for c, f in merged.items() if c in rest])
    column = lambda c: F.col(c) if c in KEY else F.col(f"__{c}") if c in merged else F.col(f"__first.{c}")
    return found.select(*[column(c).alias(c) for c in rows.columns])


def delete_empty(candidates: DataFrame) -> DataFrame:
    """Remove rows with an empty term; null terms stay."""
    return candidates.filter(~F.coalesce((F.col("source_term") == "") | (F.col("target_term") == ""), F.lit(False)))


def get_candidates(candidates: DataFrame, status: str | None = None, target_locale: str | None = None, domain: str | None = None, min_score: float | None = None, limit: int | None = 500) -> DataFrame:
    """Optional filters (an empty string is none), best score first."""
    out = candidates
    for name, value in (("status", status), ("target_locale", target_locale), ("domain", domain)):
        if value:
            out = out.filter(F.col(name) == value)
    if min_score is not None:
        out = out.filter(F.col("final_score") >= min_score)
    out = out.orderBy(F.col("final_score").desc_nulls_last(), F.col("id"))
    return out.limit(limit) if limit is not None else out


def status_totals(candidates: DataFrame) -> DataFrame:
    """Rows per status, and the grand total with status `total`."""
    return candidates.rollup("status").agg(F.count("*").alias("n"), F.grouping("status").alias("g")).select(
        F.when(F.col("g") == 1, "total").otherwise(F.col("status")).alias("status"), "n"
    )


def phase_totals(candidates: DataFrame) -> DataFrame:
    """Rows per review phase. Phase 2 counts every approved row, whichever step approved it."""
    one, two = F.col("status").like("phase1\\_%"), (F.col("status") == "approved") | F.col("status").like("phase2\\_%")
    return candidates.agg(F.count_if(one).alias("phase1"), F.count_if(two).alias("phase2"))
