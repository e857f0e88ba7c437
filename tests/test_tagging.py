"""The tagger against brute force over short sentences, and the terms that come of it."""

import itertools

import numpy as np
import pytest

from lexispark import fixed
from lexispark.operators import tagging, terms

TEXTS = [
    "The soft organic cotton is in the box. A warm lining, and the wool sleeve!", "Soft cotton and warm wool", "the the the", None, "", "...", "12 cm wide\nsmall box of wool", "é漢 \U0001F600x (organic) cotton's",
    "A soft sleeve is warm", "The box is of organic wool", "wool, cotton", "soft soft wool " * 40, "Organic cotton is washable. The cotton is soft.", "one box. two boxes",
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")


@pytest.fixture(scope="module")
def model(texts):
    return tagging.fit(texts, "text")


def random_model(rng, symbols):
    one = lambda *shape: (lambda x: x / x.sum(axis=-1, keepdims=True))(rng.random(shape) + 0.05)
    return tagging.Model({}, {}, one(tagging.K), one(tagging.K, tagging.K), one(tagging.K, symbols))


def probability(m, path, s):
    p = m.start[path[0]] * m.emit[path[0], s[0]]
    for a, b, x in zip(path, path[1:], s[1:]):
        p *= m.step[a, b] * m.emit[b, x]
    return p


@pytest.mark.parametrize("seed", range(8))
def test_paths_and_counts_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    m, n = random_model(rng, 5), seed % 5 + 1
    rows = rng.integers(0, 5, (6, n))
    paths = list(itertools.product(range(tagging.K), repeat=n))
    emit, step, start = np.zeros((tagging.K, 5)), np.zeros((tagging.K, tagging.K)), np.zeros(tagging.K)
    for s, found in zip(rows, tagging.viterbi(m, rows), strict=True):
        p = np.array([probability(m, x, s) for x in paths])
        assert np.isclose(probability(m, found, s), p.max())
        for x, w in zip(paths, p / p.sum(), strict=True):
            start[x[0]] += w
            for a, b in zip(x, x[1:]):
                step[a, b] += w
            for k, c in zip(x, s, strict=True):
                emit[k, c] += w
    got = [np.zeros_like(x) for x in (emit, step, start)]
    tagging.expected(m, rows, *got)
    for a, b in zip(got, (emit, step, start), strict=True):
        assert np.allclose(a, b)


def test_closed_classes_stay_closed(model):
    n = len(model.closed)
    assert set(fixed.STOPWORDS) <= set(model.closed)
    assert (model.emit[:3, :n] == 0).all() and (model.emit[3, n:] == 0).all()
    assert np.allclose(model.emit.sum(axis=1), 1) and np.allclose(model.step.sum(axis=1), 1)


def test_rounds_make_the_sample_likelier(texts):
    def likelihood(m):
        total = 0.0
        for t in filter(None, set(TEXTS)):
            for s in tagging.sentences(t):
                a = m.start * m.emit[:, m.symbol(t[s[0][0] : s[0][1]])]
                for x, y, _ in s[1:]:
                    a = (a @ m.step) * m.emit[:, m.symbol(t[x:y])]
                total += np.log(a.sum())
        return total

    found = [likelihood(tagging.fit(texts, "text", tagging.Training(rounds=n, smoothing=1e-6))) for n in (0, 1, 3)]
    assert found[0] < found[1] < found[2]


def test_fitting_again_gives_the_same(spark, texts, model):
    other = tagging.fit(texts.repartition(5), "text")
    assert other.words == model.words and np.allclose(other.emit, model.emit, atol=1e-9) and np.allclose(other.step, model.step, atol=1e-9)


def test_tokens_are_the_words_of_the_text(spark, texts, model):
    both = tagging.annotate(texts, "text", model, "t").withColumn("plain", terms.token_spans(tagging.F.col("text")))
    for r in both.collect():
        tagged = [(x.start, x.end, x.text) for x in r.t.tokens if x.tag != "O"]
        assert tagged == [(x.start, x.end, x.text) for x in r.plain]
        assert all(r.text[a:b] == w for a, b, w in tagged)
        assert [x.asDict() for x in r.t.tokens] == tagging.tag(model, r.text or "")[0]


def test_chunks_end_in_nouns_and_cross_no_sign(model):
    made, chunks = tagging.tag(model, "soft wool, organic cotton. Warm sleeve of the wool box")
    assert chunks
    for c in chunks:
        inside = [t for t in made if t["text"] and c["start"] <= t["start"] and t["end"] <= c["end"]]
        assert {t["tag"] for t in inside} <= {"A", "N"} and inside[-1]["tag"] == "N"
        assert not set(c["text"]) & set(",.")


def test_no_term_begins_or_ends_with_a_closed_class_word(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    model = tagging.fit(docs, "text")
    found = terms.extract(docs, "doc_id", "text", model).collect()
    assert found
    assert not [r.term for r in found if {r.term.lower().split()[0], r.term.lower().split()[-1]} & set(model.closed)]


def test_no_texts_give_no_tokens(spark):
    none = spark.createDataFrame([], "id long, text string")
    model = tagging.fit(none, "text")
    assert tagging.annotate(none, "text", model, "t").collect() == []
    assert [t["tag"] for t in tagging.tag(model, "the wool")[0]] == ["X", "N"]


def test_a_task_holds_a_portion_of_tagged_texts(spark):
    """Many texts, and long ones, leave a task in portions; a whole batch of tokens as objects took over a gigabyte a worker."""
    import pyarrow as pa

    texts = ["soft wool sleeve. " * 3] * 150 + ["warm wool box. " * 40_000, "", "x"] + ["long text " * 20_000] * 3
    found = list(tagging.portions(pa.array(texts)))
    assert found[0] == (0, 64) and [b for _, b in found][:-1] == [a for a, _ in found][1:] and found[-1][1] == len(texts)
    assert all(b - a == 1 or sum(map(len, texts[a:b])) <= tagging.PORTION_CHARS and b - a <= tagging.PORTION for a, b in found)
    assert list(tagging.portions(pa.array([], pa.string()))) == []
    rows = spark.createDataFrame(list(enumerate([*texts[:70], None])), "id long, text string").coalesce(1)
    model = tagging.fit(rows, "text")
    got = tagging.annotate(rows, "text", model, "t").collect()
    assert [r.id for r in got] == list(range(71))
    assert all([x.asDict() for x in r.t.tokens] == tagging.tag(model, r.text or "")[0] for r in got)


ODD = ["  soft\u00a0wool\tbox\r\nwarm lining", "wool-- --soft box . warm", "(soft) wool!? box", "a\u2028soft wool", "\n\n", "Soft neck. NECK closure soft necK", "soft fit leg sleeve\u0130 soft sleeved", "wool \u03a3\u0391\u03a3 soft", "x\x1fsoft\x85wool"]


@pytest.mark.parametrize("portion", [1, 3, 64])
def test_spans_equal_those_of_single_tokens(spark, model, monkeypatch, portion):
    """Spans of whole portions, without a row or object for each token, are what tagged tokens, expressions and the fold give."""
    texts = spark.createDataFrame(list(enumerate([*TEXTS, *ODD, " ".join(t or "" for t in TEXTS) * 3])), "id long, text string").coalesce(1)
    monkeypatch.setattr(tagging, "PORTION", portion)
    monkeypatch.setattr(tagging, "KNOWN", 4)
    single = terms.matched(texts, "text", model)
    for chunks in (False, True):
        every = terms.F.concat("__chunks", "__spans") if chunks else terms.F.col("__spans")
        want = {r.id: r.s for r in single.select("id", terms.deoverlap(every).alias("s")).collect()}
        found = terms.kept_spans(texts, "id", "text", model, chunks)
        got = {r.id: r.spans for r in found.collect()}
        assert {i: [tuple(x)[:3] for x in s] for i, s in got.items()} == {i: [tuple(x) for x in s] for i, s in want.items()} and any(want.values())
        rows = {tuple(r) for r in terms.term_rows(single.select("id", terms.deoverlap(every).alias("spans")), "id").collect()}
        assert {tuple(r) for r in terms.term_rows(found, "id").collect()} == rows and rows


@pytest.mark.parametrize("seed", range(4))
def test_paths_of_many_sentences_equal_viterbi(seed):
    rng = np.random.default_rng(seed)
    m, lengths = random_model(rng, 5), rng.integers(1, 9, 40)
    symbols = rng.integers(0, 5, lengths.sum())
    at = np.cumsum(lengths) - lengths
    assert tagging.paths(m, symbols, lengths).tolist() == [k for a, n in zip(at, lengths) for k in tagging.viterbi(m, symbols[None, a : a + n])[0]]


def test_the_whole_table_is_read_without_its_texts_being_shuffled(spark, tmp_path):
    """pattern_match_spans takes no tokens out of the workers: its plan holds one step in Python, and no fold of tokens in expressions."""
    from lexispark import catalog

    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plan = catalog.pattern_match_spans(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "tag" not in plan and "Exchange" not in plan and plan.count("MapInArrow") == 1
