"""Search by trigrams equals a scan, reads the lists it needs only, and survives awkward rows and values."""

import pytest

from lexispark.operators import browse, substring

TEXTS = ["Soft Cotton", "COTTON", "cot", "co", "", None, "a_b%c\\d e", "𝒳yz𝒳yz", "ΟΔΟΣ οδος", "İstanbul", "cotton\ncotton", "x" * 50_000 + "needle" + "y" * 50_000, "aaaa", "Soft Cotton"]
SOUGHT = ["cotton", "OTT", "c_t", "s%n", "soft%COT", "co", "", "%", "_", "b%c", "c\\d", "𝒳yz", "z𝒳y", "δος", "Σ ο", "ODOS", "istan", "İst", "n\nc", "needle", "aaa", "aaaaa", "__t", "no such"]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(i, t, TEXTS[-1 - i], "x") for i, t in enumerate(TEXTS)] + [(None, "cotton", "cotton", "x")], "id long, text string, other string, gram string")


@pytest.fixture(scope="module")
def index(rows):
    return substring.build(rows, "id", ["text", "other"])


@pytest.mark.parametrize("value", SOUGHT)
def test_search_equals_a_scan(rows, index, value):
    want = {r.id for r in rows.filter(substring.contains(index.fields, value)).collect() if r.id is not None}
    for most in (substring.MOST_KEYS, 0):  # both ways to fetch the rows
        found = [r.id for r in substring.search(rows, index, value, most).collect()]
        assert len(found) == len(set(found)) and set(found) == want


def test_the_index_is_written_and_read(spark, rows, index, tmp_path):
    index.write(f"{tmp_path}/index")
    index.write(f"{tmp_path}/index")  # a second run leaves the same
    again = substring.read(spark, f"{tmp_path}/index", "id", ["text", "other"])
    assert again.postings.count() == index.postings.count() == index.postings.distinct().count()
    assert {r.id for r in substring.search(rows, again, "cotton").collect()} == {r.id for r in substring.search(rows, index, "cotton").collect()}


def test_an_empty_table(spark, rows):
    none = rows.limit(0)
    assert substring.search(none, substring.build(none, "id", ["text"]), "cotton").count() == 0


def test_lists_and_keys_reach_the_scan(spark, tmp_path):
    spark.range(20_000).selectExpr("id", "concat('item ', hex(id * 7919)) AS text").repartitionByRange(8, "id").write.parquet(f"{tmp_path}/rows")
    stored = spark.read.parquet(f"{tmp_path}/rows")
    index = substring.build(stored, "id", ["text"])
    want = {r.id for r in stored.filter(substring.contains(["text"], "ABCD")).collect()}
    found = substring.search(stored, index, "abcd")
    assert want and {r.id for r in found.collect()} == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and ("In(id" in plan or "EqualTo(id" in plan)
    lists = index.postings.filter(substring.F.col("gram").isin(["abc", "bcd"]))._jdf.queryExecution().executedPlan().toString()
    assert "In(gram" in lists


def test_pages_use_it(spark, small):
    from lexispark.sources import standins

    rows = standins.candidates(spark, small).cache()
    index = substring.build(rows, "id", browse.SEARCHED)
    for page in (browse.Page(search="BOLT", locale="de-DE"), browse.Page(search="b_l", phase="2"), browse.Page(search="in", status="approved")):
        ids = lambda df: sorted(r.id for r in df.collect())
        assert ids(browse.filtered(rows, page, index)) == ids(browse.filtered(rows, page))
    rows.unpersist()


def test_a_posting_is_a_trigram_of_a_slice(spark, monkeypatch):
    """Rows that are sorted follow the slices, not the texts; their lists are the trigrams of each text."""
    many = spark.range(0, 3000, 1, 2).selectExpr("id", "concat('soft cotton ', id % 7) AS text")
    index = substring.build(many, "id", ["text"])
    assert index.postings.count() <= 2 * 40
    assert {r.n for r in index.counts.filter("gram = 'cot'").collect()} == {3000}
    assert substring.search(many, index, "Cotton 3").count() == many.filter("id % 7 = 3").count()
    texts = [t.lower() if t is not None else None for t in TEXTS]
    want = {(t[i : i + 3], k) for k, t in enumerate(texts) if t is not None for i in range(len(t) - 2)}
    batch = substring.pa.RecordBatch.from_pydict({"key": list(range(len(texts))), "f0": texts})
    for chars, rows in ((1 << 20, 1 << 16), (7, 1 << 16), (1, 1), (60, 2)):
        monkeypatch.setattr(substring, "SLICE_CHARS", chars)
        monkeypatch.setattr(substring, "SLICE_ROWS", rows)
        found = [(r["gram"], k) for b in substring._lists(iter([batch])) for r in b.to_pylist() for k in r["keys"]]
        assert len(found) == len(set(found)) and set(found) == want


def test_the_candidates_are_folded_once(spark, small):
    from lexispark import catalog

    plan = catalog.search_indexed(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in plan and "search-candidates" in plan
