"""Every operator over awkward rows against a plain version, over an empty table, and over clashing columns."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from lexispark.llm import catalog
from tests.llm.data import edge_rows, write_tables

WORD = re.compile(r"[^\x20\x09-\x0D]+")
QUERIES = catalog.QUERIES | {"pipeline": corpus_pipeline.run}
Q = {k.split("_")[0]: v for k, v in catalog.QUERIES.items()}


@pytest.fixture(scope="module")
def edge(spark, tmp_path_factory):
    return write_tables(spark, str(tmp_path_factory.mktemp("edge")), edge_rows())


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return write_tables(spark, str(tmp_path_factory.mktemp("empty")), [])


@pytest.fixture(scope="module")
def clash(spark, tmp_path_factory):
    return write_tables(spark, str(tmp_path_factory.mktemp("clash")), edge_rows(), extra=True)


def texts(path, spark):
    return [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]


def by_row(rows, *columns):
    return collections.Counter(tuple(r[c] for c in columns) for r in rows)


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables_give_no_rows(spark, empty, name):
    rows = QUERIES[name](spark, empty).collect()
    assert [r for r in rows if name != "op9_chat_format" or r.conv_id != -1] == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ("op9_chat_format", "pipeline")])
def test_clashing_columns_change_nothing(spark, edge, clash, name):
    own, other = QUERIES[name](spark, edge), QUERIES[name](spark, clash)
    assert own.columns == other.columns
    keys = [c for c in own.columns if c not in ("sequence_id", "offset")]
    assert by_row(own.collect(), *keys) == by_row(other.collect(), *keys)


def test_stages_keep_the_columns_of_documents(spark, clash):
    docs = spark.read.parquet(f"{clash}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, clash)
        assert kept.schema == docs.schema
        kept.collect()


def test_scores_are_those_of_the_definition(spark, edge):
    docs = [(d, [w.lower() for w in WORD.findall(t or "")]) for d, t, _ in texts(edge, spark)]
    counts = [collections.Counter(tuple(w[i : i + n]) for _, w in docs for i in range(len(w) - n + 1)) for n in (1, 2, 3)]
    total = sum(counts[0].values())

    def score(context, word):
        gram = (*context, word)
        if not context:
            return np.log(counts[0][gram] / total)
        if counts[len(context)][gram] >= 2:
            return np.log(counts[len(context)][gram] / counts[len(context) - 1][context])
        return np.log(0.4) + score(context[1:], word)

    want = collections.Counter((d, len(w), round(sum(score(tuple(w[max(0, i - 2) : i]), w[i]) for i in range(len(w))), 2)) for d, w in docs)
    got = collections.Counter((r.doc_id, r.n_words, round(r.log_score, 2)) for r in Q["op1"](spark, edge).collect())
    assert {k[:2] for k in want} == {k[:2] for k in got}
    a, b = sorted(want.elements(), key=str), sorted(got.elements(), key=str)
    assert all(abs(x[2] - y[2]) <= 0.011 for x, y in zip(a, b, strict=True))


def test_mixture_meets_its_targets(spark, edge):
    rows = Q["op2"](spark, edge).collect()
    sources = collections.defaultdict(list)
    for d, t, s in texts(edge, spark):
        sources[s].append(len(WORD.findall(t or "")))
    assert by_row(rows, "doc_id", "size") == collections.Counter((d, len(WORD.findall(t or ""))) for d, t, _ in texts(edge, spark))
    assert all(r.taken <= 2 * r.size for r in rows)
    order = sorted(s for s in sources if s is not None) + [None] * (None in sources)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    size = {s: sum(v) for s, v in sources.items()}
    free, target, mass = set(order), {}, 1.5 * sum(size.values())
    while True:
        level = (mass - sum(target.values())) / sum(weight[s] for s in free) if free else 0
        full = {s for s in free if weight[s] * level >= 2 * size[s]}
        target |= {s: 2.0 * size[s] for s in full}
        free -= full
        if not full:
            break
    target |= {s: weight[s] * level for s in free}
    found = {r.source_size: r.target for r in rows}
    assert {round(v, 6) for v in found.values()} == {round(v, 6) for v in target.values()}
    for s in order:
        taken = sum(r.taken for r in rows if r.source_size == size[s])
        assert abs(taken - target[s]) <= 2 * max(sources[s]) + 1


def test_mixing_again_gives_the_same(spark, edge):
    assert by_row(Q["op2"](spark, edge).collect(), "doc_id", "taken") == by_row(Q["op2"](spark, edge).collect(), "doc_id", "taken")


def test_shards_are_even_and_mixed(spark, edge, small):
    for path in (edge, small):
        rows, docs = Q["op3"](spark, path).collect(), texts(path, spark)
        sizes = collections.Counter(r.shard for r in rows)
        assert max(sizes.values()) - min(sizes.get(k, 0) for k in range(24)) <= 1
        for shard in sizes:
            assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sizes[shard]))
        want = collections.Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, _ in docs)
        assert by_row(rows, "doc_id", "size", "text_crc32") == want


def test_shards_are_cuts_of_the_interleaved_order(spark, edge, small):
    """Every place by the definition, and every shard's share of each source within two rows of the mixture."""
    for path in (edge, small):
        docs = [(d, zlib.crc32((t or "").encode()), s) for d, t, s in texts(path, spark)]
        sources = collections.defaultdict(list)
        for d, c, s in docs:
            key = hashlib.md5(f"shard-1:{'null' if d is None else d}:{c}".encode()).hexdigest()
            sources["2" if s is None else "1" + s].append((key, d is not None, d or 0, c))
        order = sorted(((2 * r - 1) / (2 * len(rows)), s, r, row) for s, rows in sources.items() for r, row in enumerate(sorted(rows), 1))
        want, mixes, n = collections.Counter(), collections.defaultdict(collections.Counter), len(order)
        for at, (_, s, _, (_, known, d, c)) in enumerate(order):
            shard = at * 24 // n
            want[(d if known else None, c, shard, at - -(-shard * n // 24))] += 1
            mixes[shard][s] += 1
        assert by_row(Q["op3"](spark, path).collect(), "doc_id", "text_crc32", "shard", "slot") == want
        for mix in mixes.values():
            assert all(abs(mix[s] - len(rows) / n * sum(mix.values())) < 2 for s, rows in sources.items())


def test_mixing_orders_rows_of_one_size_and_id_by_their_texts(spark, edge):
    import duckdb

    from lexispark.llm import mixing

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{edge}/documents.parquet/*.parquet')")
    names = ["doc_id", "size", "source_size", "target", "taken"]
    want = collections.Counter(con.execute(f"SELECT {', '.join(names)} FROM ({mixing.OP2_SQL})").fetchall())
    assert by_row(Q["op2"](spark, edge).collect(), *names) == want


def test_long_words_and_windows_hash_as_short_ones(monkeypatch):
    import pyarrow as pa

    from lexispark.llm import bytesplit

    rng = random.Random(4)
    words = ["".join(rng.choice("abc") for _ in range(rng.choice([1, 3, 40, 300]))) for _ in range(400)]

    def hashed():
        (part,) = bytesplit.slices(pa.array([" ".join(words), words[0]]))
        starts, ends, _ = part.words()
        return part.hashes(starts, ends)

    whole = hashed()
    assert whole[0] == whole[-1] and len(set(whole.tolist())) == len(set(words))
    monkeypatch.setattr(bytesplit, "_powers", [])
    monkeypatch.setattr(bytesplit, "WINDOW", 64)
    assert (hashed() == whole).all()


def test_training_samples_are_bounded_in_rows_and_bytes(spark):
    from lexispark.llm.learning import training_sample

    docs = spark.createDataFrame([(i % 60, "x" * (i % 7 + 1) * 10) for i in range(200)] + [(None, "n")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1)], "doc_id long, toxic int")
    rows = training_sample(docs, labels, "toxic", 3, 1, 12, 10).collect()
    assert collections.Counter(r.label for r in rows) == {1: 12, 0: 10} and len({r.doc_id for r in rows}) == 22
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 != 1 for r in rows)
    few = training_sample(docs, labels, "toxic", 3, 1, 12, 10, 300).collect()
    assert few and {(r.doc_id, r.text) for r in few} <= {(r.doc_id, r.text) for r in rows}
    assert all(sum(len(r.text) for r in few if r.label == y) <= 150 for y in (0, 1))


def test_a_long_text_leaves_only_itself_out_of_a_training_sample(spark):
    from lexispark.llm.learning import training_sample

    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    short = {(i, "x" * 5) for i in ids}
    for long_id in ids[:6]:
        docs = spark.createDataFrame([(i, "y" * 150 if i == long_id else t) for i, t in short], "doc_id long, text string")
        rows = training_sample(docs, labels, "toxic", 3, 1, 100, 100, 200).collect()
        assert {r.text for r in rows} == {"x" * 5}
        assert collections.Counter(r.label for r in rows) == {1: min(20, sum(i % 2 == 1 and i != long_id for i in ids)), 0: min(20, sum(i % 2 == 0 and i != long_id for i in ids))}


def test_pieces_are_the_tokens_of_the_documents(spark, edge):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path("byte_bpe_50k.json"))
    rows = Q["op4"](spark, edge).collect()
    want = collections.Counter()
    for d, t, _ in texts(edge, spark):
        ids = np.array([*slow.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        start, k = 0, 0
        n = len(ids) % 1024 or 1024
        while start < len(ids):
            part = ids[start : start + n]
            want[(d, k, start, len(part), zlib.crc32(part.tobytes()))] += 1
            start, n, k = start + n, 1024, k + 1
    assert by_row(rows, "doc_id", "piece", "start", "length", "ids_crc32") == want
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024


def test_genetic_packing_is_valid_and_at_least_best_fit():
    from collections import Counter

    from lexispark.llm import packing

    rng = random.Random(5)
    for n, top in ((5, 1023), (400, 1023), (3000, 300), (3000, 700)):
        demand = Counter(rng.randint(1, top) for _ in range(n))
        greedy = packing.best_fit(demand, Counter(), 1024)
        people = [packing.first_solution(demand, 1024, random.Random(k), k) for k in range(4)]
        best = packing.evolve(demand, people, packing.Search(), rng)[0]
        for s in (greedy, best, *people):
            assert packing.contents(s) == demand
            assert all(sum(f) <= 1024 for f in s)
        assert sum(best.values()) <= sum(greedy.values())
        assert sum(best.values()) >= -(-sum(k * v for k, v in demand.items()) // 1024)


def test_the_search_beats_best_fit_on_triplets(spark):
    """Lengths that fill sequences in threes: best-fit alone needs 14 to 20 % more sequences than the least possible."""
    from collections import Counter

    from lexispark.llm import packing

    for n in (20, 83):
        rng, demand = random.Random(n), Counter()
        for _ in range(n):
            a = rng.randint(390, 500)
            b = rng.randint(257, (1024 - a) // 2)
            demand.update([a, b, 1024 - a - b])
        greedy = packing.best_fit(demand, Counter(), 1024)
        best = packing.solve(spark, demand)
        assert packing.contents(best) == demand and all(sum(f) <= 1024 for f in best)
        assert sum(best.values()) <= n + 1 + n // 40 < sum(greedy.values())


def test_toxic_documents_of_held_out_rows_are_found(spark):
    path = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    rows = [r for r in Q["op5"](spark, path).collect() if r.held_out and r.doc_id in labels]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    toxic, clean = [[r for r in rows if labels[r.doc_id] == y] for y in (1, 0)]
    assert np.mean([r.predicted for r in toxic]) > 0.85
    assert np.mean([r.predicted for r in clean]) < 0.015


def test_offending_sentences_are_located(spark, edge):
    from lexispark.llm import toxicity

    path = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(300)
    model = toxicity.train(spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet"))
    by_id = {r.doc_id: r.text for r in docs.collect()}
    found = toxicity.offending(docs, model).collect()
    assert found
    assert all(by_id[r.doc_id][r.start : r.start + r.length] == r.sentence for r in found)
    scores = toxicity.annotate(spark.read.parquet(f"{edge}/documents.parquet"), model).collect()
    assert all(0 <= r.toxicity.score <= 1 and r.toxicity.sentences >= 1 for r in scores)


def test_scoring_holds_the_features_of_little_text_at_once():
    import tracemalloc

    import pyarrow as pa

    from lexispark.llm import toxicity

    run = toxicity.scorer(np.linspace(-1, 1, toxicity.DIMENSIONS + 1, dtype=np.float32))
    texts = pa.array([f"Sentence {i} of a text that is scored. " * 100 for i in range(600)])
    run(texts[:1])
    tracemalloc.start()
    whole = run(texts)
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert texts.nbytes > 2_000_000
    assert held < 20_000_000
    assert whole.equals(pa.concat_arrays([run(texts[i : i + 1]) for i in range(600)]))


def test_quality_of_held_out_rows_is_told(spark):
    path = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    rows = [r for r in Q["op6"](spark, path).collect() if r.held_out and r.doc_id in labels]
    good, bad = [[r.predicted for r in rows if labels[r.doc_id] == y] for y in (1, 0)]
    assert np.mean(good) > 0.99
    assert np.mean(bad) < 0.05


def merkle(text):
    """(root, sections, leaves) of a text: sections as (number of the first paragraph, hash, paragraphs)."""
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    cut = r"(?<=[.!?,;:|%&#*$]) "
    paragraphs = [",".join(md5(x)[:12] for x in re.split(cut if re.search(cut, p) else " ", p)) for p in text.split("\n")]
    sections, held = [], []
    for i, p in enumerate(paragraphs):
        held.append(p)
        if i + 1 == len(paragraphs) or md5(p)[-1] in "048c":
            sections.append((i + 1 - len(held), md5(" ".join(held))[:16], held))
            held = []
    return md5("".join(h for _, h, _ in sections)), sections, {x for p in paragraphs for x in p.split(",")}


def differing(a, b):
    """Numbers of paragraphs of b in sections that a lacks, whose branch no section of a that b lacks has; each branch once."""
    (_, a, _), (_, b, _) = merkle(a), merkle(b)
    of_a, of_b = {h for _, h, _ in a}, {h for _, h, _ in b}
    lost = {p for _, h, held in a if h not in of_b for p in held}
    out, seen = [], set()
    for at, h, held in b:
        for i, p in enumerate(held):
            if h not in of_a and p not in lost and p not in seen:
                seen.add(p)
                out.append(at + i)
    return out


def test_fingerprints_and_edits(spark, edge, monkeypatch):
    from lexispark.llm import merkle as M

    signed = lambda t: xxhash.xxh64_intdigest(t.encode(), 42) - (1 << 64) * (xxhash.xxh64_intdigest(t.encode(), 42) >> 63)
    docs = sorted(((d, t or "") for d, t, _ in texts(edge, spark)), key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1])))
    want = collections.Counter()
    for (d, t), (_, after) in zip(docs, [*docs[1:], docs[0]], strict=True):
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        prints = []
        for x in (t, edited):
            root, sections, _ = merkle(x)
            prints.append("/".join([root, ",".join(f"{n}:{h}" for n, h, _ in sections), ";".join(" ".join(p) for *_, p in sections)]))
        a, b, c = (merkle(x)[2] for x in (t, edited, after))
        near = [round(2 * len(a & x) / (len(a) + len(x)), 9) for x in (b, c)]
        want[(d, len(t), hashlib.sha256(edited.encode()).hexdigest(), *prints, *near, ",".join(map(str, sorted(differing(t, edited)))))] += 1
    for rows_each in (M.RANGE_ROWS, 3):
        monkeypatch.setattr(M.with_next, "__defaults__", (rows_each,))
        got = collections.Counter()
        for r in Q["op7"](spark, edge).collect():
            got[(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9), r.edited_paragraphs)] += 1
        assert got == want


def test_ranges_keep_the_order_and_cut_what_many_rows_share(spark):
    from pyspark.sql import functions as F

    from lexispark.llm.native import cut_ranges

    rng = random.Random(2)
    ids = [None] * 300 + [7] * 500 + [rng.randrange(-50, 50) for _ in range(300)] + [rng.choice([-(1 << 63), (1 << 63) - 1, 1 << 61]) for _ in range(30)] + list(range(10_000, 11_000))
    rows = spark.createDataFrame([(i, str(k)) for k, i in enumerate(ids)], "id long, t string").withColumn("tie", F.xxhash64("t"))
    ranges = cut_ranges(rows, "id", 20)
    found = rows.select("id", "tie", ranges.group(F.col("id")).alias("g"), ranges.number(F.col("id"), F.col("tie")).alias("n")).collect()
    found.sort(key=lambda r: (r.id is not None, r.id or 0, r.tie))
    assert [(r.g, r.n) for r in found] == sorted((r.g, r.n) for r in found)
    sizes = collections.Counter((r.g, r.n) for r in found)
    assert max(sizes.values()) < 100 and len(sizes) > 60


def test_differing_branches_name_the_changed_paragraphs(spark):
    from pyspark.sql import functions as F

    from lexispark.llm import merkle

    a = "one is. two is.\nthree is.\nfour is."
    rows = spark.createDataFrame([(a, "one is. two is.\nthree was.\nfour is."), (a, a)], "a string, b string")
    rows = merkle.with_fingerprint(merkle.with_fingerprint(rows, F.col("a"), "fa"), F.col("b"), "fb")
    assert [r.d for r in merkle.with_differing(rows, "fa", "fb", "d").collect()] == [[1], []]


def simhash(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = WORD.findall(low)
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints, ids):
    up = list(range(len(prints)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                up[top(i)] = top(j)
    least = {}
    for i, d in enumerate(ids):
        least[top(i)] = min([x for x in (d, least.get(top(i))) if x is not None], default=None)
    return [least[top(i)] for i in range(len(prints))]


def test_simhash_links_are_exact(spark, edge):
    docs = texts(edge, spark)
    prints = [simhash(t) for _, t, _ in docs]
    want = collections.Counter(zip([d for d, _, _ in docs], [f"{p:016x}" for p in prints], classes(prints, [d for d, _, _ in docs]), strict=True))
    assert by_row(Q["op8"](spark, edge).collect(), "doc_id", "fingerprint", "component_id") == want


def test_long_posting_lists_lose_no_link(spark, monkeypatch):
    from lexispark.llm import simhash as S
    from lexispark.llm.components import components

    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(6)]
    prints = sorted({c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for c in centres for _ in range(60)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    want = classes(prints, list(range(len(prints))))
    for limit in (1, 5, 64):
        monkeypatch.setattr(S, "LONG", limit)
        roots = {r.node: r.root for r in components(S.links(spark.createDataFrame([(s,) for s in signed], "fp long"))).collect()}
        groups = collections.defaultdict(set)
        for i, s in enumerate(signed):
            groups[roots.get(s, s)].add(i)
        expected = collections.defaultdict(set)
        for i, c in enumerate(want):
            expected[c].add(i)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_components_of_paths_stars_and_cycles(spark):
    from lexispark.llm.components import components

    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 - i) for i in range(1, 50)] + [(2000, 2001), (2001, 2002), (2002, 2000)] + [(5, 5)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({roots[i] for i in range(201)}) == 1
    assert len({roots[i] for i in range(951, 1001)}) == 1
    assert len(set(roots.values())) == 3


def test_events_fold_to_the_last_version(spark):
    from lexispark.llm import chat

    rows = [
        (1, 0, 0, "message", "user", "hello"), (1, 1, 1, "message", "assistant", "fi"), (1, 2, 1, "delta", None, "rst"), (1, 3, 1, "regenerate", "assistant", ""),
        (1, 4, 1, "delta", None, "sec"), (1, 5, 1, "delta", None, "ond"), (1, 6, 0, "edit", None, "hello!"), (1, 7, 2, "message", "user", "x"), (1, 8, 2, "delete", None, None),
        (2, 0, 0, "message", "assistant", "a</s>b"), (2, 1, 0, "delta", None, "\\[INST]"),
        (3, 0, 0, "message", "user", "one"), (3, 1, 0, "message", "user", "two"), (3, 2, 0, "delta", None, "!"), (3, 3, None, "edit", "user", "x"), (3, 4, 1, "message", "a", "y"), (3, 5, 1, "delete", None, None), (3, 6, 1, "message", "b", "z"),
    ]
    events = spark.createDataFrame(rows, "conv_id long, seq long, turn long, kind string, role string, text string")
    got = {r.conv_id: [(m.role, m.text) for m in r.messages] for r in chat.fold(events).collect()}
    assert got == {1: [("user", "hello!"), ("assistant", "second")], 2: [("assistant", "a</s>b\\[INST]")], 3: [("user", "one"), ("user", "two!"), ("b", "z"), ("user", "x")]}
    shown = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold(events))).collect()}
    assert shown[2].loss_sha256 == hashlib.sha256("a</s>b\\[INST]".encode()).hexdigest()


def test_escapes_are_reversible(spark):
    from pyspark.sql import functions as F

    from lexispark.llm import chat

    rng = random.Random(9)
    parts = ["<", "/", "s", ">", "[", "INST", "]", "\\", "</s>", "<s>", "[INST]", "[/INST]", "é", "\n", "<\\s>"]
    cases = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    rows = spark.createDataFrame([(c,) for c in cases], "t string").select("t", chat.escape(F.col("t")).alias("e")).withColumn("u", chat.unescape(F.col("e")))
    for r in rows.collect():
        assert r.u == r.t
        assert not any(c in r.e for c in chat.CONTROLS)


def test_rules_count_what_they_say(spark, edge):
    rows = Q["op10"](spark, edge).collect()
    want = collections.Counter()
    for d, t, _ in texts(edge, spark):
        t = t or ""
        w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        times = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        again = {j for i in range(len(w) - 2) if times[(w[i], w[i + 1], w[i + 2])] > 1 for j in (i, i + 1, i + 2)}
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        want[(d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again), failed)] += 1
    assert by_row(rows, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == want
    assert not any(r.kept and r.base_failed for r in rows)


def test_rules_keep_clean_rows_and_drop_junk(spark):
    """On labelled rows that the trusted counts leave out."""
    path = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{path}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    rows = [r for r in Q["op10"](spark, path).collect() if r.doc_id in labels and not r.base_failed]
    good, bad = [[r.kept for r in rows if labels[r.doc_id] == y] for y in (1, 0)]
    assert len(good) > 500 and len(bad) > 20
    assert np.mean(good) > 0.995
    assert np.mean(bad) < 0.1


def test_ratios_and_verdicts_follow_the_counts(spark, edge):
    import regex

    from lexispark.llm import rules

    r = rules.Rules()
    m = 1 << 64
    signed = lambda b, seed: xxhash.xxh64_intdigest(b, seed % m) - m * (xxhash.xxh64_intdigest(b, seed % m) >> 63)
    low = lambda t: (t or "").lower()
    docs = [(d, [x for x in re.split(r"[ \t\n\x0b\f\r]", regex.sub(r"([^\p{L}\p{N}\x20\x09-\x0D]+)", r" \1 ", low(t))) if x]) for d, t, _ in texts(edge, spark)]
    buckets = [(d, [signed(w.encode(), 42) % r.buckets for w in t] + [signed(b.encode(), signed(a.encode(), 42)) % r.buckets for a, b in zip(["", *t], t, strict=False)]) for d, t in docs]
    trusted = {x.doc_id for x in spark.read.parquet(f"{edge}/labels.parquet").collect() if x.quality == 1 and x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 5}
    raw, good = np.zeros(r.buckets), np.zeros(r.buckets)
    for d, b in buckets:
        np.add.at(raw, b, 1)
        if d in trusted:
            np.add.at(good, b, 1)
    w = np.log((good + 1) / (good.sum() + r.buckets)) - np.log((raw + 1) / (raw.sum() + r.buckets))
    want = sorted((str(d), len(b), w[b].mean() if b else 0.0) for d, b in buckets)
    rows = [x for x in Q["op10"](spark, edge).collect()]
    got = sorted((str(x.doc_id), x.llr) for x in rows)
    for d in {k for k, *_ in want}:
        a, b = [sorted(y[-1] for y in side if y[0] == d) for side in (want, got)]
        assert np.allclose(a, b, atol=2e-6), d
    assert all(x.kept == (not x.base_failed and x.llr >= r.threshold) for x in rows if abs(x.llr - r.threshold) > 1e-5)


def test_scores_of_trained_models_follow_their_weights(spark, edge):
    """Scores of op5 and op6 by plain loops over sentences and n-grams, with the weights that training gives."""
    import pyarrow as pa

    from lexispark.llm import bytesplit, classifier, toxicity

    rng = np.random.default_rng(5)
    of = lambda words: {w: h for w, h in zip(words, next(bytesplit.slices(pa.array(["\n".join(words)]))).hashes(*_ends(words)), strict=True)}

    def _ends(words):
        ends = np.cumsum([len(w.encode()) + 1 for w in words]) - 1
        return ends - [len(w.encode()) for w in words], ends

    docs = ["", "One two. Three! two two", "a b a b a\nb é-é 漢 x1", "toxicword here? no."]
    fold = lambda t: t.translate({c: c + 32 for c in range(65, 91)})
    pieces = lambda t: re.findall(r"(?:[0-9a-zA-Z]|[^\x00-\x7f])+|[^\x20\x09-\x0D0-9a-zA-Z\x80-\U0010ffff]+", fold(t))
    model = rng.normal(size=toxicity.DIMENSIONS + 1)
    model[-1] = -2.0
    got = toxicity.scorer(model)(pa.array(docs)).to_pylist()
    for text, found in zip(docs, got, strict=True):
        miss = 1.0
        for sentence in re.findall(r"[^.!?\n]*[.!?\n]|[^.!?\n]+", text) or [""]:
            z = model[-1]
            for w in (w for w in pieces(sentence) if w[0] not in ".!?"):
                raw = w.encode()
                z += model[int(of([w])[w]) % toxicity.DIMENSIONS]
                for k in toxicity.PREFIXES:
                    if len(raw) > k:
                        h = next(bytesplit.slices(pa.array([raw[:k].decode("utf-8", "ignore") + "\n"]))).hashes(np.array([0]), np.array([k]))[0] if raw.isascii() else next(bytesplit.slices(pa.array([w]))).hashes(np.array([0]), np.array([k]))[0]
                        z += model[(int(h) + k) % toxicity.DIMENSIONS]
            miss *= 1 - 1 / (1 + np.exp(-z))
        assert abs(found["score"] - (1 - miss)) < 1e-6
    model = rng.normal(size=classifier.DIMENSIONS + 1).astype(np.float32)
    for text, found in zip(docs, classifier.scorer(model)(pa.array(docs)).to_pylist(), strict=True):
        w = pieces(text)
        h = [np.uint64(of([x])[x]) for x in w]
        with np.errstate(over="ignore"):
            keys = [int(x) for x in h] + [int(bytesplit.mix(np.array([a * np.uint64(0xD6E8FEB86659FD93) + b], dtype=np.uint64))[0]) for a, b in zip(h, h[1:], strict=False)]
        keys += [gap for gap in (1, 2) for a, b in zip(w, w[gap:], strict=False) if a == b]
        z = model[-1] + (classifier.SCALE * sum(float(model[k % classifier.DIMENSIONS]) for k in keys) / len(keys) if keys else 0)
        assert abs(found - 1 / (1 + np.exp(-np.clip(z, -30, 30)))) < 1e-5


def test_one_row_of_each_component_stays(spark):
    from lexispark.llm import jaccard, simhash

    rows = [(3, "b b b"), (10, "a a a"), (10, "b b b"), (None, "b b b"), (None, "c c c"), (4, "d d d"), (4, "d d d"), (4, "d d d"), (None, "e e e"), (None, "e e e"), (5, None), (2, ""), (2, "")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n int")
    want = collections.Counter({(3, "b b b"): 1, (10, "a a a"): 1, (None, "c c c"): 1, (4, "d d d"): 1, (None, "e e e"): 1, (2, ""): 1})
    for keep in (simhash.keep_one, jaccard.keep_one):
        kept = keep(docs)
        assert kept.columns == docs.columns
        assert by_row(kept.collect(), "doc_id", "text") == want


def test_the_pipeline_keeps_one_of_each_group_and_all_its_words(spark, edge, small):
    for path in (edge, small):
        rows = corpus_pipeline.run(spark, path).collect()
        ids = {r.doc_id for r in rows}
        classes_ = {r.doc_id: r.component_id for r in Q["op8"](spark, path).collect()}
        assert len({classes_[i] for i in ids}) == len(ids)
        used = collections.Counter()
        for r in rows:
            used[r.sequence_id] += r.length
        assert all(v <= 1024 for v in used.values())


def test_the_pipeline_sends_workers_batches_of_bounded_bytes(spark, edge, monkeypatch):
    import pyarrow as pa

    from lexispark.session import BATCH_BYTES, bounded_batches, kept_batches

    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    long_ = spark.range(0, 4000, 1, 1).selectExpr("repeat('word ', 1000) AS text")
    docs = spark.read.parquet(f"{edge}/documents.parquet")

    def bytes_(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    def most():
        return max(r.n for r in long_.mapInArrow(bytes_, "n long").collect())

    assert most() > 2 * BATCH_BYTES
    with kept_batches(spark):
        corpus_pipeline.drop_toxic(spark, docs, edge)
        assert most() <= BATCH_BYTES + 10_000
        for lower in ("1m", "65536b", "2048"):
            spark.conf.set(setting, lower)
            bounded_batches(spark)
            assert spark.conf.get(setting) == lower
    assert spark.conf.get(setting) == before
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("toxicity", corpus_pipeline.drop_toxic), ("all", lambda spark, docs, sf_dir: docs)])
    assert corpus_pipeline.run(spark, edge).count() <= docs.count()
    assert spark.conf.get(setting) == before


def test_the_near_duplicate_stage_links_as_brute_force_jaccard(spark, monkeypatch):
    from lexispark.llm import jaccard

    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    docs = [None, "", " \n", "one two", "One  two", "one two three", "a b c d e", "a b c d e f"]
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(20, 120))]
        for k in range(6):
            copy = list(base)
            for _ in range(k):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            docs.append(" ".join(copy))
            docs.append(" ".join(passage + copy[: 10 + 2 * k]))
    rows = [(i, t, "en", "a", len(t or "")) for i, t in enumerate(docs)]

    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    found = [shingles(t) for t in docs]
    linked = lambda a, b: a == b or 5 * len(a & b) >= 4 * len(a | b)
    least = list(range(len(docs)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(found):
            for j, b in enumerate(found):
                if least[j] < least[i] and linked(a, b):
                    least[i], changed = least[j], True
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for sample, long_, block in ((jaccard.SAMPLE, jaccard.LONG, jaccard.BLOCK), (10, 2, 5)):
        monkeypatch.setattr(jaccard, "SAMPLE", sample)
        monkeypatch.setattr(jaccard, "LONG", long_)
        monkeypatch.setattr(jaccard, "BLOCK", block)
        assert {r.doc_id: r.component_id for r in jaccard.near_duplicates(table).collect()} == dict(enumerate(least))
    kept = sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, table, "").collect())
    assert kept == sorted(set(least))


def test_components_that_stand_are_linked_as_stars(spark, monkeypatch):
    """Rounds over long lists hand on a row for each class, not all links found so far."""
    from lexispark.llm import jaccard

    sizes, find = [], jaccard.components

    def counted(edges):
        sizes.append(edges.count())
        return find(edges)

    monkeypatch.setattr(jaccard, "components", counted)
    monkeypatch.setattr(jaccard, "LONG", 2)
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join([*words[:i], "x", *words[i:]])) for i in range(60)] + [(60, "else")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()} == dict.fromkeys(range(60), 0) | {60: 60}
    assert max(sizes) > 60 and sizes[-1] <= 60


def test_chat_sql_agrees_on_awkward_rows(spark, edge):
    import duckdb

    from lexispark.llm import chat

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{edge}/conversations.parquet/*.parquet')")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    want = collections.Counter(con.execute(f"SELECT {', '.join(names)} FROM ({chat.OP9_SQL})").fetchall())
    assert by_row(Q["op9"](spark, edge).collect(), *names) == want


def test_chat_rows_that_repeat_a_turn_or_have_none_all_stay(spark, tmp_path):
    talks = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "assistant", "y"), (1, None, "assistant", "x"), (2, None, None, "q"), (2, None, "assistant", None), (None, 3, "user", "<s>"), (None, 3, "assistant", "\\")]
    spark.createDataFrame(talks, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r.conv_id: r for r in Q["op9"](spark, str(tmp_path)).collect()}
    for conv in (1, 2, None):
        rows = sorted((t is None, t or 0, r or "", x or "") for c, t, r, x in talks if c == conv)
        said = "".join(x for *_, r, x in rows if r == "assistant")
        assert found[conv].n_turns == len(rows)
        assert found[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in rows).encode()).hexdigest()
        assert (found[conv].loss_chars, found[conv].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
