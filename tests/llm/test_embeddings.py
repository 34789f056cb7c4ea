import math
import random

import numpy as np

from marketlake.llm.embeddings import embedding_near_duplicates, plane_gaps, unit

SCHEMA = "vec_id long, embedding array<float>, label int, kept int, v string"


def brute(rows):
    def ok(r):
        return r[2] is not None and r[1] is not None and len(r[1]) > 0 and all(
            x is not None and math.isfinite(x) for x in r[1]) and any(r[1])

    n, links = len(rows), [set() for _ in rows]
    vec = [np.array(r[1], dtype=np.float32).astype(np.float64) if ok(r) else None for r in rows]
    for i in range(n):
        for j in range(n):
            if i != j and ok(rows[i]) and ok(rows[j]) and rows[i][2] == rows[j][2] and len(vec[i]) == len(vec[j]):
                if vec[i] @ vec[j] / np.sqrt((vec[i] @ vec[i]) * (vec[j] @ vec[j])) >= 0.93:
                    links[i].add(j)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((rows[i][0], len(links[i]), least, rows[i][0] is not None and rows[i][0] == least))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


def test_all_links_by_brute_force_in_small_cells_and_blocks(spark):
    rnd = np.random.default_rng(3)
    rows = []
    for i in range(260):
        base = np.random.default_rng(i % 17).normal(size=8)  # clusters whose members chain
        rows.append((i, (base + rnd.normal(size=8) * rnd.choice([0.0, 0.12, 0.3])).astype(np.float32).tolist(), int(i % 3 > 0), 0, "x"))
    rows += [(900 + i, rows[5][1], 1, 0, "x") for i in range(9)]  # equal vectors
    got = embedding_near_duplicates(spark.createDataFrame(rows, SCHEMA), cell_rows=20, sample_rows=120, block_rows=16)
    assert result(got) == brute(rows)


def test_vectors_that_link_with_nothing(spark):
    one = [1.0, 0.0]
    rows = [(1, one, 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [float("nan"), 1.0], 1), (6, [float("inf"), 1.0], 1),
            (7, one, None), (8, one, 2), (9, [1.0, -0.0], 1), (9, one, 1), (None, one, 1), (None, None, None), (10, [1.0], 1), (11, [], 1)]
    rows = [(*r, 0, "x") for r in rows]
    assert result(embedding_near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_no_rows(spark):
    assert embedding_near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_a_long_chain(spark):
    from marketlake.llm.graph import components
    ids = list(range(60))
    random.Random(1).shuffle(ids)
    links = spark.createDataFrame([(a, b) for a, b in zip(ids, ids[1:])] + [(100, 101), (101, 101), (100, 101)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {**{i: 0 for i in ids}, 100: 100, 101: 100}


def test_very_short_and_very_long_vectors(spark):
    own = [(1, [1e-200, 2e-200]), (2, [1e200, 2.1e200]), (3, [1.0, 2.0]), (4, [-1e-300, 2e-300]), (5, [5e-324, 1e-323]), (6, [1e308, 1.7e308]), (7, [0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in own], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_near_duplicates(df).collect()}
    alike = {1, 2, 3, 5, 6}
    assert got == {i: (4, 1) if i in alike else (0, i) for i, _ in own}
    x = np.random.default_rng(0).normal(size=(5, 7))
    assert (unit(x) == x / np.linalg.norm(x, axis=1, keepdims=True)).mean() > 0.5 and np.allclose(unit(x * 1e-250), unit(x), rtol=1e-14)


def test_long_vectors(spark):
    rnd = np.random.default_rng(4)
    rows = []
    for i in range(150):
        base = np.random.default_rng(i % 11).normal(size=1024)
        rows.append((i, (base + rnd.normal(size=1024) * rnd.choice([0.05, 0.3, 0.5])).astype(np.float32).tolist(), int(i % 2), 0, "x"))
    assert result(embedding_near_duplicates(spark.createDataFrame(rows, SCHEMA), cell_rows=15, sample_rows=100, block_rows=32)) == brute(rows)


def test_gaps_between_planes_are_never_too_small():
    c = unit(np.random.default_rng(1).normal(size=(40, 30)))
    c = np.concatenate([c, unit(c[:5] + 1e-9)])
    exact = np.linalg.norm(c[:, None, :] - c[None, :, :], axis=2)
    assert (plane_gaps(c) >= exact).all() and np.abs(plane_gaps(c) - exact).max() < 2e-7
