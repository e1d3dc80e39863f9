import math

import numpy as np
import pytest

from tonality.llm import neighbours as N


def brute(rows, threshold=N.THRESHOLD):
    valid = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        valid[i] = (label, np.array(v, float) / np.linalg.norm(np.array(v, float)))
    parent, degree = {}, dict.fromkeys(valid, 0)

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    ids = list(valid)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            (a, x), (b, y) = valid[i], valid[j]
            if a == b and len(x) == len(y) and x @ y >= threshold:
                degree[i] += 1
                degree[j] += 1
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return sorted(((i, degree.get(i, 0), find(i) if i in valid else i) for i, _, _ in rows), key=str)


def run(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    result, links, recall = N.near_vectors(df)
    assert links.where(f"cos < {N.THRESHOLD}").count() == 0
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in result.collect()), key=str), recall


def vector(rng, near=None, noise=0.0, d=16):
    v = rng.normal(size=d) if near is None else near + noise * rng.normal(size=d)
    return [float(x) for x in np.float32(v)]


def test_edge_rows_equal_brute_force(spark):
    r = np.random.default_rng(0)
    a = vector(r)
    rows = [
        (1, a, 0), (2, a, 0), (3, [2 * x for x in a], 0), (4, a, 1), (5, a, None), (6, None, 0), (7, [], 0), (8, [0.0] * 16, 0),
        (9, [float("nan"), *a[1:]], 0), (10, [float("inf"), *a[1:]], 0), (11, [None, *a[1:]], 0), (12, a[:8], 0), (13, a[:8], 0),
        (None, a, 0), (14, vector(r, np.array(a), 0.05), 0), (15, [-x for x in a], 0), (16, [x * 1e-30 for x in a], 0),
        (17, [x * 1e30 for x in a], 0),
    ]
    got, _ = run(spark, rows)
    assert got == brute(rows)
    got, _ = run(spark, rows + [rows[0], rows[0]])
    assert got == sorted([*brute(rows), brute([rows[0]])[0][:1] + brute(rows)[[x[0] for x in brute(rows)].index(1)][1:]] + [next(x for x in brute(rows) if x[0] == 1)], key=str)


def test_empty(spark):
    assert run(spark, [])[0] == []


@pytest.mark.parametrize("k, dense", [(10, 512), (3, 8)])
def test_groups_of_all_sizes_equal_brute_force(spark, monkeypatch, k, dense):
    """Pairs, chains and groups beyond the neighbour lists and the blocks."""
    monkeypatch.setattr(N, "K", k)
    monkeypatch.setattr(N, "DENSE_BLOCK", dense)
    r = np.random.default_rng(1)
    vectors = [vector(r) for _ in range(200)]
    for size in (2, 3, 5, 12, 70):
        center = np.array(vector(r))
        vectors += [vector(r, center, 0.08) for _ in range(size)]
    step = np.array(vector(r))
    for _ in range(12):  # a chain: neighbours are linked, the ends are not
        step = step + 0.25 * r.normal(size=16)
        vectors.append([float(x) for x in np.float32(step)])
    order = r.permutation(len(vectors))
    rows = [(int(o), v, int(o) % 2 if i < 200 else 0) for i, (o, v) in enumerate(zip(order, vectors, strict=True))]
    got, recall = run(spark, rows)
    assert recall >= N.RECALL
    assert got == brute(rows)


def test_links_between_groups_that_no_list_joins(spark, monkeypatch):
    """Every list is full of its own group, and no block holds both groups."""
    first = N._first_lists
    monkeypatch.setattr(N, "_first_lists", lambda *a: first(*a).where("(u < 100) = (v < 100)"))
    r = np.random.default_rng(3)
    one, across = np.linalg.qr(r.normal(size=(16, 2)))[0].T
    two = 0.94 * one + math.sqrt(1 - 0.94**2) * across
    rows = [(100 * g + i, vector(r, c, 0.01), 0) for g, c in enumerate((one, two)) for i in range(30)]
    rows += [(200 + i, vector(r), 0) for i in range(50)]
    expected = brute(rows)
    assert any(n > 29 for _, n, _ in expected) and len({c for i, _, c in expected if i < 200}) == 1
    assert run(spark, rows)[0] == expected


def test_sort_orders_grow_with_the_label():
    assert N.sort_orders(100, 0.93) == N.TABLES < N.sort_orders(20_000, 0.93) < N.sort_orders(10**8, 0.93)


def test_rare_links_are_found_without_any_sort_order(spark, monkeypatch):
    """The sampled nodes have no link, and no order shows one."""
    first = N._first_lists
    monkeypatch.setattr(N, "_first_lists", lambda *a: first(*a).where(f"cos < {N.THRESHOLD}"))
    monkeypatch.setattr(N, "_refine", lambda graph, nodes, threshold: first(nodes, 0, 1, threshold).where("false"))
    monkeypatch.setattr(N, "AUDIT", 4)
    monkeypatch.setattr(N, "AUDIT_MOST", 4, raising=False)
    monkeypatch.setattr(N, "EXACT_BLOCK", 64, raising=False)
    r = np.random.default_rng(4)
    vectors = [vector(r) for _ in range(300)]
    vectors += [vector(r, np.array(v), 0.1) for v in vectors[:3]]
    rows = [(i, v, 0) for i, v in enumerate(vectors)]
    expected = brute(rows)
    assert sum(n for _, n, _ in expected) >= 6
    assert run(spark, rows)[0] == expected
