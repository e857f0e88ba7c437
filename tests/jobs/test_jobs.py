"""The two jobs: growing input, runs that died, repeated runs, awkward rows and the command lines."""

import collections
import json
import random
import re
import shutil

import pytest
from pyspark.sql import functions as F

from jobs import config, glossary_release, term_ledger
from lexispark.functions import text as T
from lexispark.functions import validity

SCHEMA = "doc_id long, text string, lang string, source string"
FIRST = [(1, "Organic cotton, organic cotton!\nSoft fleece", "en", "a"), (2, "organic cotton (pu", "en", None), (3, None, "en", "a"), (4, "", None, "a"), (None, "Organic cotton", "", "a")]
THEN = [(7, "organic cotton and fleece", "en", "a"), (8, "mjuk fleece", "sv", "b"), (7, "organic cotton and fleece", "en", "a"), (9, "fleece " * 3000, "en", "a")]


def plain(spark, rows, longest=2, least=3):
    """The ledger of rows by the definition; the library's own rules decide which terms are valid."""
    strip = lambda p: (re.sub(r"^_+|_+$", "", re.sub(r"^[\W_]*(?<!_)(?=\w)|^[^\w]+", "", re.sub(r"[^\w]+$", "", p))) or p)
    found = collections.defaultdict(list)
    for doc_id, text, lang, _ in rows:
        ws = (text or "").split()
        for term in {strip(" ".join(ws[i : i + n])) for n in range(1, longest + 1) for i in range(len(ws) - n + 1)}:
            found[lang or "und", term].append(doc_id)
    terms = spark.createDataFrame([(t,) for _, t in found] or [("x",)], "term string").distinct().filter(validity.is_valid(term_ledger.F.col("term")))
    valid = {r.term for r in terms.collect()}
    ids = lambda v, f: f([x for x in v if x is not None], default=None)
    return {(g, t, len(v), ids(v, min), ids(v, max), "needs_review" if len(v) >= least else "rare") for (g, t), v in found.items() if t in valid}


def ledger(spark, out):
    rows = term_ledger.read(spark, f"{out}/terms", term_ledger.TERMS).collect()
    found = [(r.lang, r.term, r.n_docs, r.first_doc, r.last_doc, r.status) for r in rows]
    assert len(found) == len(set(found))
    return set(found)


def land(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def place(tmp_path):
    return {"documents": str(tmp_path / "docs"), "output": str(tmp_path / "out"), "checkpoint": str(tmp_path / "check"), "buckets": 2}


def stamps(place):
    from pathlib import Path

    return {str(f): f.stat().st_mtime_ns for f in Path(place["output"]).rglob("*.parquet")}


def test_the_ledger_takes_what_is_new(spark, place):
    land(spark, FIRST, place["documents"])
    term_ledger.run(spark, **place)
    assert ledger(spark, place["output"]) == plain(spark, FIRST)
    before = stamps(place)
    term_ledger.run(spark, **place)
    assert stamps(place) == before  # nothing new, nothing written
    land(spark, THEN, place["documents"])
    term_ledger.run(spark, **place)
    assert ledger(spark, place["output"]) == plain(spark, FIRST + THEN)
    # the first batch wasn't mined again, and partitions without new terms stand as they were
    kept = {f for f in before if "/deltas/" in f or "lang=und" in f}
    assert kept and all(stamps(place)[f] == before[f] for f in kept)


def test_batches_of_one_file_give_the_same(spark, place):
    for rows in (FIRST, THEN, FIRST[:2]):
        land(spark, rows, place["documents"])
    term_ledger.run(spark, files_per_batch=1, **place)
    assert ledger(spark, place["output"]) == plain(spark, FIRST + THEN + FIRST[:2])
    assert term_ledger.read(spark, f"{place['output']}/deltas", term_ledger.DELTAS).select("batch").distinct().count() == 3


def test_a_run_that_died_is_made_good(spark, place, monkeypatch):
    land(spark, FIRST, place["documents"])
    term_ledger.run(spark, **place)
    land(spark, THEN, place["documents"])
    # dead between the stream and the ledger
    with monkeypatch.context() as m:
        m.setattr(term_ledger, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            term_ledger.run(spark, **place)
    assert ledger(spark, place["output"]) == plain(spark, FIRST)
    term_ledger.run(spark, **place)
    assert ledger(spark, place["output"]) == plain(spark, FIRST + THEN)
    # dead while partitions were replaced: one is gone
    shutil.rmtree(f"{place['output']}/terms/lang=en/bucket=0")
    term_ledger.run(spark, **place)
    assert ledger(spark, place["output"]) == plain(spark, FIRST + THEN)


def test_a_batch_that_is_run_again_counts_once(spark, place):
    """The delta of the last batch was written, but the stream didn't learn of it."""
    land(spark, FIRST, place["documents"])
    term_ledger.run(spark, **place)
    land(spark, THEN, place["documents"])
    term_ledger.run(spark, **place)
    shutil.rmtree(f"{place['checkpoint']}/commits")
    term_ledger.run(spark, **place)
    assert ledger(spark, place["output"]) == plain(spark, FIRST + THEN)


def test_no_documents_give_an_empty_ledger(spark, place):
    land(spark, [], place["documents"])
    term_ledger.run(spark, **place)
    assert ledger(spark, place["output"]) == set()


def test_settings_stay(spark, place, small):
    before = {k: spark.conf.get(k) for k in ("spark.sql.sources.partitionOverwriteMode", "spark.sql.shuffle.partitions")}
    land(spark, FIRST, place["documents"])
    term_ledger.run(spark, **place)
    assert before == {k: spark.conf.get(k) for k in before}
    assert not spark.streams.active


def release(spark, out):
    found, audited, covered = glossary_release.read(spark, out)
    return [sorted(map(str, df.collect())) for df in (found, audited, covered)]


def test_a_release_is_the_same_again(spark, small, tmp_path):
    out = str(tmp_path / "release")
    glossary_release.run(spark, small, out)
    first = release(spark, out)
    assert all(first)
    shutil.rmtree(f"{out}/audit")
    glossary_release.run(spark, small, out)
    assert release(spark, out) == first


def test_a_release_applies_decisions(spark, small, tmp_path):
    glossary_release.run(spark, small, str(tmp_path / "plain"))
    names = sorted({r.term for r in glossary_release.read(spark, str(tmp_path / "plain"))[1].collect()})
    made = {"case_canonical_map": {}, "auto_merged_report": [], "decisions": {"0": {"action": "merge", "canonical": names[0], "aliases": [names[1]], "terms": names[:2], "_auto_reason": "t"}}}
    (tmp_path / "decisions.json").write_text(json.dumps(made))
    glossary_release.run(spark, small, str(tmp_path / "merged"), str(tmp_path / "decisions.json"))
    merged = {r.term for r in glossary_release.read(spark, str(tmp_path / "merged"))[1].collect()}
    assert merged == set(names) - {names[1]}


def test_command_lines_read_config_files(tmp_path, monkeypatch, capsys):
    ran = []
    for job in (term_ledger, glossary_release):
        monkeypatch.setattr(job, "command", lambda name, run, chosen: ran.append((name, chosen)))
    mine = tmp_path / "mine.json"
    mine.write_text(json.dumps({"documents": "d", "output": "o", "checkpoint": "c", "files_per_batch": 5, "longest": 1, "buckets": 4, "least_docs": 2}))
    term_ledger.main(["--config", str(mine), "--output", "elsewhere", "--buckets", "8"])
    glossary_release.main(["--tables", "t", "--output", "o"])
    assert ran == [
        ("term_ledger", {"documents": "d", "output": "elsewhere", "checkpoint": "c", "files_per_batch": 5, "longest": 1, "buckets": 8, "least_docs": 2}),
        ("glossary_release", {"tables": "t", "output": "o", "decisions": None}),
    ]
    with pytest.raises(SystemExit):
        term_ledger.main([])
    assert "documents, output, checkpoint" in capsys.readouterr().err


def test_a_command_owns_its_session(monkeypatch):
    """The session is made and ended by the command line alone."""
    import pyspark.sql

    class Session:
        stopped = False
        builder = type("B", (), {"appName": lambda s, n: s, "config": lambda s, *a: s, "getOrCreate": lambda s: session})()

        def stop(self):
            self.stopped = True

    session = Session()
    monkeypatch.setattr(pyspark.sql, "SparkSession", Session)
    with pytest.raises(ZeroDivisionError):
        config.command("x", lambda spark, n: 1 / n, {"n": 0})
    assert session.stopped


SIGNS = ["a", "b-c", "(a", "a)", "((", "__", "_a_", "(_a", "a_)", ",", "𝒳,", "(𝒳", "𝒳(a", "é.", "é́!", " a ", "_(a", "x²", "--a--b--", "₂", "word", "Soft,", "soft", "12"]


def test_signs_at_edges_go_as_from_each_phrase(spark):
    """Texts of awkward words, phrases of up to three: the terms are those of the phrases one by one."""
    rng = random.Random(7)
    texts = [rng.choice(["", " ", "\n\t"]) + rng.choice([" ", "\n", " \x0b "]).join(rng.choice(SIGNS) for _ in range(rng.randint(0, 12))) + rng.choice(["", "\r"]) for _ in range(300)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate([*texts, None])], "doc_id long, text string, lang string")
    words = F.filter(F.split(F.coalesce("text", F.lit("")), term_ledger.WHITE), lambda w: w != "")
    for longest in (1, 2, 3):
        each = docs.select("doc_id", F.explode(T.ngram_phrases(words, longest)).alias("term")).filter(validity.is_valid(F.col("term")))
        want = {tuple(r) for r in each.groupBy("term").agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).collect()}
        got = [tuple(r) for r in term_ledger.mine(docs, longest, 2).select("term", "n_docs", "first_doc", "last_doc").collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_no_pattern_and_no_rule_is_asked_for_each_phrase(spark):
    docs = spark.createDataFrame([(1, "a b", "en")], "doc_id long, text string, lang string")
    plan = term_ledger.mine(docs, 2, 2)._jdf.queryExecution().optimizedPlan().toString()
    phrases = next(line for line in plan.splitlines() if "explode" in line)
    assert "regexp" not in phrases
    counted = plan.index("Aggregate")
    assert plan.index("sentence_starter") < counted and "sentence_starter" not in plan[counted:]
