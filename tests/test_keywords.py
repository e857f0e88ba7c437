"""Keywords against plain versions that hold a text's words in lists and dictionaries."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex

from lexispark import fixed
from lexispark.operators import keywords, terms

ODD = [
    None, "", "...  --", "12 34", "wool", "the of and", "Wool WOOL wool! Wool's end. A wool-lined box\nof WOOL", "cotton and the wool of cotton and the wool, cotton of wool",
    "soft cotton " * 300, "é漢 \U0001F600x (organic) cotton's --soft-- 12cm NASA. NASA sends cotton", "x" * 500 + " long words", "-" * 100_000 + "a soft sleeve", "shirt shirts shirted shirting",
]


def plain_words(text):
    """Runs of words per sentence, each (lower-cased word, place, capital, acronym, opens a run)."""
    out = []
    for sentence in regex.split(r"(?<=[.!?])[ \t\n\x0B\f\r]+|\n+", text or ""):
        if not regex.search(r"[\p{L}\p{N}]", sentence):
            continue
        rows, closed = [], True
        for at, raw in enumerate(w for w in regex.split(r"\s+", sentence) if w):
            if not regex.search(r"\p{L}", raw) or regex.search(r"\p{N}", raw):
                closed = True
                continue
            core = regex.sub(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "", raw)
            acronym = len(core) > 1 and not regex.search(r"[^\p{Lu}]", core)
            rows.append((core.lower(), at, not acronym and at > 0 and bool(regex.match(r"\p{Lu}", core)), acronym, closed or not regex.match(r"[\p{L}\p{N}]", raw)))
            closed = not regex.search(r"[\p{L}\p{N}]$", raw)
        out.append(rows)
    return out


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def plain_statistical(text, longest=4, top=15, alike=0.7):
    sentences = plain_words(text)
    tf, capital, acronym, places, pairs = Counter(), Counter(), Counter(), defaultdict(set), Counter()
    left, right = defaultdict(list), defaultdict(list)
    for s, rows in enumerate(sentences):
        for i, (t, _, u, a, opens) in enumerate(rows):
            tf[t] += 1
            capital[t] += u
            acronym[t] += a
            places[t].add(s)
            if not opens:
                before = rows[i - 1][0]
                left[t].append(before)
                right[before].append(t)
                pairs[before, t] += 1
    stop = {t for t in tf if t in fixed.STOPWORDS or len(t) < 3}
    counts = np.array([float(c) for t, c in tf.items() if t not in stop])
    weight = {}
    for t in tf.keys() - stop:
        mean = counts.sum() / len(counts)
        usual = mean + math.sqrt(max((counts**2).sum() / len(counts) - mean * mean, 0))
        share = lambda x: len(set(x)) / max(len(x), 1)
        rel = 1 + (share(left[t]) + share(right[t])) * tf[t] / max(tf.values())
        place = math.log(math.log(3 + float(np.median(sorted(places[t])))))
        weight[t] = rel * place / (max(capital[t], acronym[t]) / (1 + math.log(tf[t])) + tf[t] / usual / rel + len(places[t]) / len(sentences) / rel)
    found, often = {}, Counter()
    for rows in sentences:
        for i in range(len(rows)):
            for n in range(1, longest + 1):
                run = rows[i : i + n]
                if len(run) < n or any(r[4] for r in run[1:]) or run[0][0] in stop or run[-1][0] in stop:
                    continue
                terms = [r[0] for r in run]
                term, product, total = " ".join(terms), 1.0, 1.0
                if len(term) > 200:
                    continue
                for j, t in enumerate(terms):
                    if t in stop:
                        p = pairs[terms[j - 1], t] / tf[terms[j - 1]] * (pairs[t, terms[j + 1]] / tf[t])
                        product, total = product * (2 - p), total + (p - 1)
                    else:
                        product, total = product * weight[t], total + weight[t]
                often[term] += 1
                found[term] = product / max(total, 1e-9)
    kept = []
    for score, term in sorted((round(v / often[t], 12), t) for t, v in found.items()):
        if len(kept) < top and all(1 - levenshtein(term, k) / max(len(term), len(k)) <= alike for k, _ in kept):
            kept.append((term, score))
    return kept


def plain_embedded(text, longest=4, top=10):
    words = keywords.content_words(text or "")
    grams = [tuple(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    vector = {g: sum(keywords.word_vector(w) for w in g) for g in set(grams)}
    whole = sum((vector[g] for g in grams), np.zeros(keywords.DIMENSIONS))
    cosine = lambda v: round(float(v @ whole / (np.linalg.norm(v) * np.linalg.norm(whole))), 6)
    return sorted(((" ".join(g), cosine(v)) for g, v in vector.items()), key=lambda x: (-x[1], x[0]))[:top]


@pytest.fixture(scope="module")
def texts(spark, small):
    docs = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").limit(50).collect()]
    rows = [(i, t, "clash", 1) for i, t in enumerate(ODD + docs)]
    return spark.createDataFrame(rows, "id long, text string, term string, k int")


def by_id(df, value):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.id, r["rank"])):
        out[r.id].append((r.term, r[value]))
        assert r["rank"] == len(out[r.id])
    return out


def same(got, want, tolerance):
    """Equal lists; terms whose scores can't be told apart may change places."""
    assert [s for _, s in got] == pytest.approx([s for _, s in want], abs=tolerance)
    for (a, x), (b, y) in zip(got, want, strict=True):
        assert a == b or any(t == a and abs(s - x) <= tolerance for t, s in want), (a, b)


def test_statistical_equals_a_plain_version(texts):
    got = by_id(keywords.statistical(texts, "id", "text"), "score")
    for r in texts.collect():
        same(got.get(r.id, []), plain_statistical(r.text), 1e-9)


def test_embedded_equals_brute_force(texts, monkeypatch):
    got = by_id(keywords.embedded(texts, "id", "text"), "similarity")
    for r in texts.collect():
        same(got.get(r.id, []), plain_embedded(r.text), 2e-6)
        monkeypatch.setattr(keywords, "BLOCK", 7)
        same(keywords.nearest(r.text or "", 4, 10), plain_embedded(r.text), 2e-6)
        monkeypatch.undo()


def test_one_shuffle_by_key(texts):
    plan = keywords.statistical(texts, "id", "text")._jdf.queryExecution().executedPlan().toString()
    assert {line.split("hashpartitioning(")[1].split(",")[0].split("#")[0] for line in plan.splitlines() if "Exchange hashpartitioning" in line} == {"k"}


def test_empty_table(texts):
    none = texts.filter("id < 0")
    assert keywords.statistical(none, "id", "text").count() == 0 and keywords.embedded(none, "id", "text").count() == 0


def test_look_alikes_are_edit_distances():
    rng = np.random.default_rng(3)
    for _ in range(300):
        a, b = ("".join(rng.choice(list("abc"), rng.integers(1, 12))) for _ in range(2))
        assert keywords.look_alike(a, b, 0.7) == (1 - levenshtein(a, b) / max(len(a), len(b)) > 0.7)


@pytest.mark.parametrize("find", [terms.keywords, terms.yake_features, keywords.word_weights])
def test_texts_are_dealt_by_size_and_shuffled_once(spark, monkeypatch, find):
    """Rows of words and n-grams stay in the parts of their texts, whose number follows the characters."""
    monkeypatch.setattr(keywords, "PART_CHARS", 500)
    texts = spark.createDataFrame([(i, f"Soft wool sleeve {i}. Warm organic cotton, {i} boxes") for i in range(400)] + [(400, None), (401, "")], "doc_id long, text string")
    found = find(texts, "doc_id", "text")
    assert found.count() and found.rdd.getNumPartitions() > 30
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_word_vectors_are_hashed_together(monkeypatch):
    rng = np.random.default_rng(4)
    words = ["é漢", "\U0001F600x", "漢漢漢漢", "long" * 100, *("".join(rng.choice(list("abcé漢"), rng.integers(2, 9))) for _ in range(300))]
    want = np.array([keywords.word_vector(w) for w in words])
    monkeypatch.setattr(keywords.xxhash, "xxh64_intdigest", None)
    assert np.array_equal(keywords.word_vectors(words), want)
    monkeypatch.setattr(keywords, "WORDS", 7)
    assert np.array_equal(keywords.word_vectors(words), want) and len(keywords.nearest(" ".join(words), 4, 10)) == 10


def test_no_row_for_each_word(texts):
    """Words and n-grams of a portion of texts are arrays of a task: nothing is sorted, ranked or grouped as rows, which took some hundred times the texts."""
    plan = keywords.statistical(texts, "id", "text")._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert not [w for w in ("Window", "Generate", "Aggregate", "Sort") if w in plan] and plan.count("Exchange") == 1, plan


def test_a_portion_gives_what_its_texts_give(texts):
    held = [r.text or "" for r in texts.orderBy("id").collect()]
    held += ["A. B wool. Xy  cotton\u00a0wool", "a.b wool \n\n Big Wool-Box", "\u0391\u03a3 \u03a3\u0391\u03a3. soft \u03a3\u0391\u03a3", "A", "the wool of the soft. Wool of the soft box, wool of THE soft", "..! Wool? soft\n? wool"]
    row, term, _, score = keywords._chosen(held, 4, 15, 0.7)
    for i, t in enumerate(held):
        found = [(x, s) for r, x, s in zip(row, term, score, strict=True) if r == i]
        alone = keywords._chosen([t], 4, 15, 0.7)
        assert found == list(zip(alone[1], alone[3], strict=True))
        same(found, plain_statistical(t), 1e-9)


def test_terms_are_held_against_all_kept_ones():
    rng = np.random.default_rng(5)
    for _ in range(300):
        term, *others = ("".join(rng.choice(list("ab\u6f22"), rng.integers(1, 14))) for _ in range(5))
        held = keywords.Unlike(0.7)
        for other in others:
            held.add(other)
        assert held.holds_like(term) == any(1 - levenshtein(term, o) / max(len(term), len(o)) > 0.7 for o in others)
