"""The declared candidate table: columns, defaults, refusals, and times and notes that folds keep."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexispark.operators import store

DAY = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
EVENTS = "source_locale string, target_locale string, normalized_source string, normalized_target string, domain string, source_term string, target_term string, frequency long, similarity double, final_score double, seq long"


def events(spark, *rows):
    return spark.createDataFrame([("en", "de-DE", term.lower(), "x", "general", term, "x", 1, score, score, seq) for term, score, seq in rows], EVENTS)


def at(day):
    return F.lit(day).cast("timestamp")


def test_columns_defaults_and_ids(spark):
    out = store.declared(events(spark, ("Wool", 0.5, 1), ("Hem", 0.6, 2)), at(DAY[0]))
    want = StructType.fromDDL(store.SCHEMA)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in want] and len(want) == 20
    rows = {r.source_term: r for r in out.collect()}
    assert {r.status for r in rows.values()} == {"needs_review"} and {r.category for r in rows.values()} == {"general"}
    assert len({r.id for r in rows.values()}) == 2 and {r.created_at for r in rows.values()} == {DAY[0]}
    assert {r.id for r in store.declared(out).collect()} == {r.id for r in rows.values()}


def test_ids_tell_keys_apart(spark):
    keys = [("a", "b", "c|d", "e"), ("a", "b", "c", "d|e"), ("a", "b", "", "x"), ("a", "b", None, "x")]
    rows = spark.createDataFrame(keys, ", ".join(f"{c} string" for c in store.KEY))
    assert rows.select(store.key_id().alias("id")).distinct().count() == 4


def test_a_null_term_is_refused(spark):
    bad = events(spark, ("Wool", 0.5, 1)).withColumn("target_term", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="target_term is null"):
        store.declared(bad).collect()


def test_folds_keep_times_notes_and_ids(spark):
    table = store.declared(events(spark, ("Wool", 0.5, 1)), at(DAY[0]))
    first = table.first()
    change = spark.createDataFrame([(first.id, "approved", "fine", 1)], "id long, status string, reviewer_notes string, seq long")
    table = store.update_status(table, change, now=at(DAY[1]))
    r = table.first()
    assert (r.created_at, r.updated_at, r.status, r.reviewer_notes) == (DAY[0], DAY[1], "approved", "fine")
    incoming = events(spark, ("WOOL", 0.9, 1), ("Hem", 0.4, 2)).withColumn("created_at", at(DAY[2])).withColumn("updated_at", at(DAY[2]))
    out = {r.normalized_source: r for r in store.declared(store.upsert(table, incoming), at(DAY[2])).collect()}
    wool = out["wool"]
    assert (wool.id, wool.created_at, wool.updated_at, wool.reviewer_notes, wool.status, wool.frequency, wool.final_score) == (first.id, DAY[0], DAY[2], "fine", "approved", 2, 0.9)
    assert out["hem"].reviewer_notes is None and out["hem"].created_at == DAY[2]


def test_rows_that_meet_keep_the_first_and_the_last_time(spark):
    rows = store.declared(events(spark, ("wool", 0.5, 1), ("(wool)", 0.7, 2)), at(DAY[0]))
    rows = rows.withColumn("updated_at", F.when(F.col("source_term") == "(wool)", at(DAY[2])).otherwise(F.col("updated_at")))
    met = store.repair_punctuation(rows)[0].collect()
    assert [(r.normalized_source, r.frequency, r.created_at, r.updated_at) for r in met] == [("wool", 2, DAY[0], DAY[2])]
