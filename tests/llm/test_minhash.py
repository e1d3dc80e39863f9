from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tonality.llm import minhash as M

from .helpers import ascii_words, docs_of, edge_docs, empty_docs, sentence, swapped


def shingles(text):
    w = ascii_words(text)
    if not w:
        return Counter()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute_classes(docs, threshold=0.8):
    """Classes by comparing every pair; idf from the operator's table."""
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    idf = M.idf_table(docs)
    shingler = M.Shingler()

    def weights(text):
        key, count, _ = shingler(pa.array([text or ""]))
        return dict(zip(key.tolist(), (count * idf[M._feature(key)].astype(float)).tolist(), strict=True))

    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    each = [(d, weights(t)) for d, t in rows if d is not None]
    for d, _ in each:
        find(d)
    assert [len(w) for _, w in each] == [len(shingles(t)) for d, t in rows if d is not None]
    for i, (d, a) in enumerate(each):
        for e, b in each[:i]:
            if a and b:
                common = sum(min(v, b[k]) for k, v in a.items() if k in b)
                if common / (sum(a.values()) + sum(b.values()) - common) >= threshold:
                    x, y = find(d), find(e)
                    parent[max(x, y)] = min(x, y)
    return {d: find(d) for d, _ in each}


def classes(docs):
    rows = M.near_duplicates(docs)[0].collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.doc_id: r.class_id for r in rows}


def test_edge_rows_equal_brute_force(spark):
    docs = edge_docs(spark)
    assert classes(docs) == brute_classes(docs)
    assert classes(empty_docs(spark)) == {}
    kept = M.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.where("doc_id IS NULL").count() == 2
    assert M.drop_near_duplicates(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("rows", [16, 512])
def test_large_group_of_uneven_copies_equals_brute_force(spark, monkeypatch, rows):
    """Copies so far from their original that many link only among themselves,
    or not at all, dealt to several blocks."""
    monkeypatch.setattr(M, "BLOCK_ROWS", rows)
    base = sentence(77, 100)
    texts = [swapped(base, i, 0.002 * (i % 40)) for i in range(120)] + [sentence(500 + i, 60) for i in range(40)]
    docs = docs_of(spark, [(7 * i % 997, t) for i, t in enumerate(texts)])
    assert classes(docs) == brute_classes(docs)


def test_samples_agree_as_often_as_texts_are_similar():
    idf = np.ones(1 << M.FEATURE_BITS, np.float32)
    shingler, sampler = M.Shingler(), M.Sampler()
    near = defaultdict(list)
    for seed in range(60):
        a = sentence(seed, 300)
        b = swapped(a, seed, 0.03)
        s, sims = [], []
        for t in (a, b):
            key, count, _ = shingler(pa.array([t]))
            s.append(sampler(key, count * idf[M._feature(key)]))
            sims.append((key, count.astype(float)))
        near["agree"].append((s[0] == s[1]).mean())
        near["similar"].append(M.weighted_jaccard(*sims))
    assert abs(np.mean(near["agree"]) - np.mean(near["similar"])) < 0.02


def test_matrix_similarities_equal_pairwise():
    shingler = M.Shingler()
    idf = np.linspace(1, 2, 1 << M.FEATURE_BITS).astype(np.float32)
    texts = [swapped(sentence(3, 80), i, 0.05) for i in range(9)] + ["a a a a a a a a", "a a a a a a", ""]
    key, count, before = shingler(pa.array(texts))
    n = len(texts)
    got = M.similarities(*M.elements(key, count, before, idf), n, np.arange(n), np.arange(n))
    w = count * idf[M._feature(key)].astype(float)
    for i in range(n):
        for j in set(range(n)) - {i}:
            a, b = ((key[before[k] : before[k + 1]], w[before[k] : before[k + 1]]) for k in (i, j))
            assert abs(got[i, j] - M.weighted_jaccard(a, b)) < 1e-9
