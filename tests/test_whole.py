"""Queries without an oracle against brute force over small fixtures: they take all rows and all words."""

import numpy as np
import xxhash

from lexispark import catalog, fixed


def vector(text):
    out, padded = np.zeros(64), f" {text.lower()} "
    for n in range(2, 5):
        for i in range(len(padded) - n + 1):
            h = xxhash.xxh64_intdigest(padded[i : i + n])
            out[h % 64] += 1.0 if h >> 63 else -1.0
    return out / np.linalg.norm(out)


def test_align_terms_takes_every_word(spark, tmp_path):
    said = {1: ("one red stone near green rivers today", "stones near the green river one day"), 2: ("silver", "silver copper"), 3: ("a b c lantern lanterns", "lantern")}
    rows = [(k, turn, role, text) for k, texts in said.items() for turn, (role, text) in enumerate(zip(("user", "assistant"), texts, strict=True))]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    want = {}
    for k, (asked, answer) in said.items():
        ws = answer.split()
        for term in asked.split():
            for phrase in {" ".join(ws[i : i + n]) for n in range(1, 5) for i in range(len(ws) - n + 1)}:
                if (similarity := float(vector(term) @ vector(phrase))) >= fixed.ALIGN_SIMILARITY:
                    want[k, term, phrase] = round(similarity, 3)
    found = {(r.conv_id, r.source_term, r.target_term): round(r.similarity, 3) for r in catalog.align_terms(spark, str(tmp_path)).collect()}
    assert found.keys() == want.keys()
    assert all(abs(found[k] - want[k]) < 0.002 for k in want)
    assert {"green", "lantern"} <= {term for _, term, _ in found}


def test_vectors_meet_all_others(spark, small):
    from lexispark.operators import align

    vectors = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = {r.vec_id: np.array(r.embedding, dtype=float) / np.linalg.norm(r.embedding) for r in vectors.collect()}
    every = {(a, b): round(float(rows[a] @ rows[b]), 6) for a in rows for b in rows if a < b}
    want = {k for k, v in every.items() if v >= 0.3}
    for found in (catalog.align_cosine_all(spark, small), align.all_pairs(vectors, "vec_id", 0.3, block=40)):
        pairs = [(r.id_a, r.id_b) for r in found.collect()]
        assert len(pairs) == len(set(pairs)) and set(pairs) == want
    best = {r.id_a: r.best for r in catalog.align_best_all(spark, small).collect()}
    assert best == {a: min((-v, b) for (x, b), v in every.items() if x == a)[1] for a in {x for x, _ in every}}


def test_groups_take_every_token(spark, tmp_path):
    words = "soft. soft v-neck vneck 12cm 12-cm 50% 50 café cafés Wool wool robbed ribbed (pu pu"
    spark.createDataFrame([(1, words)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    terms, path = words.split(), str(tmp_path)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    far = lambda a, b: 1 if max(len(a), len(b)) <= 8 else 2
    want = {(a, b) for a in terms for b in terms if a < b and 1 <= distance(a.lower(), b.lower()) <= far(a, b)}
    groups = catalog.similar_groups_all(spark, path).collect()
    found = {tuple(sorted(r.members.split("|"))) for r in groups}
    assert want <= found, want - found
    assert {"punctuation", "levenshtein"} == {r.kind for r in groups}
    reasons = {r.reason for r in catalog.group_decisions(spark, path).collect()}
    assert "edge signs" in reasons
    assert {r.reason for r in catalog.decision_tallies(spark, path).collect()} == reasons
    assert {r.term for r in catalog.case_canonical_all(spark, path).collect()} == set(terms)


def test_the_glossary_holds_the_merges(spark, monkeypatch):
    rows = [(1, "contain wool", "de-DE", "enthält Wolle", 0.5, 1), (2, "contains wool", "sv-SE", "innehåller ull", 0.6, 1), (3, "ribbed hem", "de-DE", "Saum", 0.5, 1), (4, "Ribbed hem", "de-DE", "Rippsaum", 0.9, 1)]
    table = spark.createDataFrame(rows, "id long, source_term string, target_locale string, target_term string, final_score double, frequency long")
    monkeypatch.setattr(catalog.S, "candidates", lambda *_: table)
    found = {r.en: (r["de-DE"], r["sv-SE"]) for r in catalog.merged_glossary(spark, "").collect()}
    assert found == {"contains wool": ("enthält Wolle", "innehåller ull"), "ribbed hem": ("Rippsaum", "")}


def test_extraction_reads_the_documents(spark, tmp_path):
    texts = [(k, f"soft cotton shirt number{k} with wide sleeves") for k in range(5)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("pattern_match_spans", "extract_terms", "keyword_fallback", "keyness"):
        assert {r.doc_id for r in catalog.QUERIES[name](spark, str(tmp_path)).select("doc_id").collect()} == set(range(5)), name


def test_spans_are_folded_like_a_list(spark, small):
    orders = {}
    for r in spark.read.parquet(f"{small}/lineitem.parquet").select("l_orderkey", "l_quantity", "l_partkey").collect():
        start = int(r.l_quantity % 17)
        orders.setdefault(r.l_orderkey, []).append((start, start + 1 + r.l_partkey % 7))
    want = {}
    for key, spans in orders.items():
        kept = []
        for start, end in sorted(spans, key=lambda s: (s[0], -s[1])):
            if not kept or start >= kept[-1][1]:
                kept.append((start, end))
            elif end > kept[-1][1]:
                kept[-1] = (start, end)
        want[key] = ",".join(f"{a}-{b}" for a, b in kept)
    assert {r.l_orderkey: r.kept for r in catalog.span_deoverlap(spark, small).collect()} == want


def test_answers_are_read_for_every_candidate(spark, small):
    rows = catalog.judgment_json_normalise(spark, small).collect()
    score = {r.id: r.final_score for r in catalog.S.candidates(spark, small).collect()}
    assert {r.id for r in rows} == set(score) and {r.id % 5 for r in rows} == set(range(5))
    for r in rows:
        form = r.id % 5
        assert r.valid == (form in (0, 1)), r
        if form == 1:
            assert (r.verdict, r.source_term_cleanness, r.reasons) == ("rejected", 1, "garbled_source") and abs(r.confidence - score[r.id]) < 1e-9
        if form == 0:
            assert (r.verdict, r.source_term_cleanness, r.reasons) == ("approved", 5, "")
