"""Text functions against examples and against plain Python."""

import re
import string

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexispark import fixed
from lexispark.functions import merging, scoring, validity
from lexispark.functions import text as T


def apply(spark, column, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(column(F.col("t")).alias("o")).collect()]


CASES = {
    "edge signs": (T.strip_term_punctuation, {". cotton": "cotton", "polyester.": "polyester", ",bomull": "bomull", "(recycled)": "recycled", "- jersey -": "jersey", "100% cotton": "100% cotton", "--": "--", "_x_": "x", "m²": "m²", "été!": "été", "": ""}),
    "prefix": (T.strip_numeric_prefix, {"95% organic cotton": "organic cotton", "82 recycled polyester": "recycled polyester", "100% recycled polyester lining": "recycled polyester lining", "organic cotton": "organic cotton", "43cm height": "43cm height"}),
    "white space": (T.normalize_whitespace, {" a  b\t\nc ": "a b c", "": "", None: ""}),
    "null": (T.clean_to_null, {"   ": None, " x ": "x", None: None}),
    "html": (T.normalize_text, {"<p>T shirt</p><script>var a='<b>';</script>&amp; more": "T-shirt & more", "&lt;b&gt;": "<b>", "a - b": "a-b"}),
    "fence": (T.strip_fence, {"```json\n{}\n```": "{}\n", "{}": "{}"}),
    "punctuation": (T.normalize_punctuation, {"‘a’ – “b”": "'a'-\"b\""}),
    "valid": (validity.is_valid, {"organic cotton": True, "95 cm": False, "98.5 cm": False, "73x73 cm": False, "125.00 cm": False, "44-54 cm head circumference": True, "cargo tote": False, "TENCEL": False, "43 cm height": False, "8-14 years": False, "perfect socks": False, "the": False, "été chaud": False, "12.5": False}),
    "measurement": (validity.is_measurement, {"100 cm": True, "82%": True, "60x60": True, "18x25 cm": True, "180 80 cm": True, "12 x": True, "10,000 mm water column": False, "23 cm Shoulder strap": False, "width cm": False, "5-pack": False}),
    "domain": (scoring.classify_domain, {"organic cotton": "sustainability", "hoodie": "product_types", "xyz": "general", " Wool ": "materials", "soft hoodie": "product_types"}),
}


@pytest.mark.parametrize("name", CASES)
def test_examples(spark, name):
    column, cases = CASES[name]
    assert dict(zip(cases, apply(spark, column, list(cases)), strict=True)) == cases


def test_filter_end_to_end(spark):
    from lexispark.operators import terms

    given_ = ["95% organic cotton", "organic cotton", "82 recycled polyester", "100% recycled polyester lining", "soft organic cotton", "95 cm", "98.5 cm", "73x73 cm", "125.00 cm", "44.5 cm", "24x24 cm"]
    rows = spark.createDataFrame([(1, i, t) for i, t in enumerate(given_)], "k int, pos int, term string")
    kept = [r.term for r in terms.filter_candidates(rows, "k").orderBy("pos").collect()]
    assert kept == ["organic cotton", "recycled polyester", "recycled polyester lining", "soft organic cotton"]


def test_period_rule_and_its_legacy_form(spark):
    rows = spark.createDataFrame([("blue", "glue."), ("soft", "soft.")], "a string, b string")
    assert [r.p for r in rows.select(merging.variant(merging.FINAL_PERIOD, F.col("a"), F.col("b")).alias("p")).collect()] == [None, "soft"]
    assert [r.p for r in rows.select(merging.variant(merging.FINAL_PERIOD, F.col("a"), F.col("b"), legacy=True).alias("p")).collect()] == ["blue", "soft"]


def plain_edge(term):
    out = re.sub(r"^[^\w]+", "", term)
    out = re.sub(r"[^\w]+$", "", out).strip("_")
    return out or term


text = st.text(alphabet=string.ascii_letters + string.digits + " .,-_%éß()\"'/", max_size=14)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(text, min_size=1, max_size=40))
def test_edge_strip_is_that_of_python(spark, values):
    assert apply(spark, T.strip_term_punctuation, values) == [plain_edge(v) for v in values]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(text, min_size=1, max_size=40))
def test_phrases_are_those_of_a_loop(spark, values):
    def phrases(t):
        w, out = t.split(), []
        for n in range(1, 5):
            for i in range(len(w) - n + 1):
                p = plain_edge(" ".join(w[i : i + n]))
                if p and p not in out:
                    out.append(p)
        return out

    assert apply(spark, T.target_phrases, values) == [phrases(v) for v in values]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(text, min_size=1, max_size=40))
def test_normalising_twice_changes_nothing(spark, values):
    once = apply(spark, lambda c: T.normalize_punctuation(T.compound_rules(T.normalize_whitespace(c))), values)
    again = apply(spark, lambda c: T.normalize_punctuation(T.compound_rules(T.normalize_whitespace(c))), once)
    assert again == once


def test_fixed_tables_have_their_sizes():
    assert len(fixed.STOPWORDS) == len(set(fixed.STOPWORDS)) == 174
    assert len(fixed.SENTENCE_STARTERS) == 58
    assert sum(map(len, fixed.DOMAIN_SEEDS.values())) == 141
    assert len(fixed.EXPORT_EXCLUSIONS) == 41
    assert len(fixed.PHRASE_BLACKLIST) == 18


def test_domains_read_a_term_once(spark):
    """The term is normalised once, not for each seed, and domains are those of all seeds looked through one by one."""
    seeds = [(s.lower(), d) for d, many in fixed.DOMAIN_SEEDS.items() for s in many]
    odd = [None, "", " ", "o", "cotton\nhoodie", "hoodie\ncardigan", "ORGANIC cottons", "fit", "a bib x", "\u0130 wool", "zip clos", "knitwear", "x" * 50]
    odd += [s[1:] for s, _ in seeds] + [f"my {s}s" for s, _ in seeds] + [s.upper() for s, _ in seeds] + [s[:-2] + "zz" for s, _ in seeds]
    rows = spark.createDataFrame([(t,) for t in odd], "term string").select("term", scoring.classify_domain(F.col("term")).alias("domain"))
    for r in rows.collect():
        t = (r.term or "").lower().strip()
        near = next((d for s, d in seeds if s in t or t in s), "general")
        assert r.domain == ("general" if r.term is None else dict(seeds).get(t, near)), r
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1
