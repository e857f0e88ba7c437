"""The similarity join and the search for neighbours against brute force: dense groups, copies, small cells and blocks, awkward rows."""

import numpy as np
import pytest

from lexispark.operators import nearest


def rows():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(6, 8))
    out = [(int(i), [float(x) for x in centres[i % 6] + rng.normal(size=8) * 0.15]) for i in range(240)]
    # A hot group of near copies, exact copies, and one that differs in scale alone.
    out += [(1000 + i, [float(x) for x in centres[0] + rng.normal(size=8) * 0.001]) for i in range(80)]
    out += [(2000 + i, out[5][1]) for i in range(30)] + [(3000, [2 * x for x in out[7][1]])]
    return out


AWKWARD = [(9000, None), (9001, []), (9002, [0.0] * 8), (9003, [float("nan")] * 8), (9004, [1.0, None] * 4), (None, [1.0] * 8), (9005, [float("inf")] + [1.0] * 7)]


def classes(data):
    first = {}
    for k, v in sorted(data):
        first.setdefault(tuple(v), k)
    return {k: np.array(v) / np.linalg.norm(v) for v, k in first.items()}


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(k, v, "x") for k, v in rows() + AWKWARD], "vec_id long, embedding array<double>, id string")


@pytest.mark.parametrize("threshold,most,block", [(0.95, 4096, 2048), (0.5, 40, 7), (0.999, 3, 50), (1.0, 9, 20), (-1.0, 5, 64)])
def test_no_pair_is_lost(table, threshold, most, block):
    data = rows()
    distinct = classes(data)
    want = {(a, b) for a in distinct for b in distinct if a < b and round(float(distinct[a] @ distinct[b]), 6) >= threshold}
    want |= {(5, 2000 + i) for i in range(30)}
    found = [(r.id_a, r.id_b) for r in nearest.similar_pairs(table, "vec_id", threshold, most_pivots=most, block=block).collect()]
    assert len(found) == len(set(found)) and set(found) == want


@pytest.mark.parametrize("k,later,most,block", [(1, False, 4096, 2048), (3, False, 11, 16), (2, True, 6, 33)])
def test_nearest_equals_brute_force(table, k, later, most, block):
    distinct = classes(rows())
    found = {}
    for r in nearest.nearest(table, "vec_id", k, later=later, most_pivots=most, block=block).collect():
        found.setdefault(r.id_a, []).append((-r.similarity, r.id_b))
    for a, v in distinct.items():
        want = sorted((-round(float(v @ w), 6), b) for b, w in distinct.items() if (b > a if later else b != a))[:k]
        assert sorted(found.get(a, [])) == want, a
    assert set(found) <= set(distinct)


@pytest.mark.parametrize("k,later,most,block", [(1, True, 4096, 2048), (1, True, 6, 16), (3, True, 11, 9), (2, False, 6, 33), (40, True, 3, 50)])
def test_every_row_has_its_nearest_rows(table, monkeypatch, k, later, most, block):
    """Copies are rows like others: they look for themselves, and what is later than a row may be a copy of an earlier one."""
    monkeypatch.setattr(nearest, "TIES", 40 * k)
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows()}
    ids, every = np.array(sorted(unit)), np.array([unit[i] for i in sorted(unit)])
    found = {}
    for r in nearest.nearest(table, "vec_id", k, later=later, most_pivots=most, block=block, copies=True).collect():
        found.setdefault(r.id_a, []).append((-r.similarity, r.id_b))
    for a in unit:
        want = sorted((-s, b) for b, s in zip(ids.tolist(), np.round(every @ unit[a], 6).tolist(), strict=True) if (b > a if later else b != a))[:k]
        assert sorted(found.get(a, [])) == want, a


def test_the_query_takes_copies(spark, tmp_path):
    from lexispark import catalog

    spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.6, 0.8]), (3, [1.0, 0.0]), (4, [1.0, 0.0]), (5, [0.0, 1.0])], "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = {(r.id_a, r.best, r.similarity) for r in catalog.align_best_all(spark, str(tmp_path)).collect()}
    assert found == {(1, 3, 1.0), (2, 5, 0.8), (3, 4, 1.0), (4, 5, 0.0)}


def test_tight_groups_visit_few_cells(table):
    cells = nearest.Cells(table, "vec_id")
    seekers = cells.homes.withColumn("far", nearest.F.lit(float(nearest.reach(0.99))))
    visits = cells.visits(seekers, higher=False).count()
    assert visits < 0.4 * cells.homes.count() * (len(cells.pivots) - 1)


def test_text_keys_and_empty_tables(spark, table):
    named = table.select(nearest.F.concat(nearest.F.lit("k"), "vec_id").alias("name"), "embedding").filter("vec_id < 40")
    found = {(r.id_a, r.id_b) for r in nearest.similar_pairs(named, "name", 0.97, block=8).collect()}
    distinct = classes([(f"k{k}", v) for k, v in rows() if k < 40])
    assert found == {(a, b) for a in distinct for b in distinct if a < b and round(float(distinct[a] @ distinct[b]), 6) >= 0.97}
    assert nearest.similar_pairs(table.limit(0), "vec_id", 0.5).count() == 0
    assert nearest.nearest(table.filter("vec_id >= 9000"), "vec_id").count() == 0
    assert nearest.nearest(table.filter("vec_id = 3"), "vec_id").count() == 0


def test_the_plan_has_no_nested_loop(table):
    plan = nearest.similar_pairs(table, "vec_id", 0.9)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_groups_are_compared_by_blocks_and_whole(spark):
    """As a join on the group: every pair, copies too, each row by itself; none across groups. Zero vectors have no neighbours."""
    data = [(k, v, i % 3) for i, (k, v) in enumerate(rows())]
    more = [(k, v, 0) for k, v in AWKWARD] + [(9100, [1.0] * 8, None), (9101, [1.0] * 8, None), (9102, [1.0] * 8, 7)]
    grouped = spark.createDataFrame(data + more, "vec_id long, embedding array<double>, label int")
    unit = {k: np.array(v) / np.linalg.norm(v) for k, v, _ in data}
    label = {k: g for k, _, g in data}
    cosine = {(a, b): float(unit[a] @ unit[b]) for a in unit for b in unit if a < b and label[a] == label[b]}
    best = {}
    for (a, b), s in sorted(cosine.items(), key=lambda x: (-round(x[1], 6), x[0][1])):
        best.setdefault(a, (b, round(s, 6)))
    for block in (16, 4096):
        found = nearest.pairs_in_groups(grouped, "vec_id", "label", 0.9, block=block).collect()
        assert sorted((r.id_a, r.id_b) for r in found) == sorted(p for p, s in cosine.items() if s >= 0.9)
        assert all(r.label == label[r.id_a] and abs(r.similarity - cosine[r.id_a, r.id_b]) < 1e-9 for r in found)
        near = nearest.best_in_groups(grouped, "vec_id", "label", block=block).collect()
        assert {r.id_a: (r.id_b, round(r.similarity, 6)) for r in near} == best and len(near) == len(best)


def test_blocks_copy_a_host_seldom_and_fit_a_task():
    """Of 600,000 vectors that visit every cell, a host is copied once for each block of guests; a task's vectors and a slice of similarities stay small."""
    assert -(-600_000 // nearest.BLOCK) <= 64
    assert nearest.BLOCK * (64 + 256) * 8 <= 64 << 20
