import hashlib
from collections import defaultdict

import pytest

from tonality.llm import substring as S

from .helpers import ascii_words, docs_of, edge_docs, empty_docs, sentence


def brute(rows, size=50):
    first = {}
    for d, t in rows:
        if d is None:
            continue
        w = ascii_words(t)
        for i in range(len(w) - size + 1):
            v = tuple(w[i : i + size])
            first[v] = min(first.get(v, d), d)
    out = []
    for d, t in rows:
        w = ascii_words(t)
        gone = set()
        if d is not None:
            for i in range(len(w) - size + 1):
                if first[tuple(w[i : i + size])] < d:
                    gone.update(range(i, i + size))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df, size=50):
    rows = S.remove_repeats(df, size).collect()
    for r in rows:
        assert sum(s.end - s.start for s in r.removed) == r.n_removed
    return sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in rows), key=str)


def test_edge_rows_equal_brute_force(spark):
    docs = edge_docs(spark)
    assert result(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert S.remove_repeats(empty_docs(spark)).count() == 0


def passages():
    """Passages shared whole, in part, edited, next to each other, repeated."""
    p = [sentence(900 + i, 140).split() for i in range(4)]
    rows = []
    for i in range(40):
        a, b = p[i % 4], p[(i + 1) % 4]
        cut = (i * 7) % 90
        body = sentence(i, 15).split() + a[cut : cut + 48 + i % 6] + sentence(50 + i, i % 4).split() + b[: 30 + 3 * i]
        if i % 5 == 0:
            body[len(body) // 2] = f"edit{i}"
        if i % 7 == 0:
            body += a + a
        rows.append((1000 - i if i % 2 else i, " ".join(body)))
    rows += [(2000, " ".join(["the"] * 130)), (2001, " ".join(["the"] * 75)), (1999, " ".join(["a b"] * 60)), (2002, " ".join(["b a"] * 60))]
    return rows


@pytest.mark.parametrize("size", [50, 20])
def test_shared_passages_equal_brute_force(spark, size):
    rows = passages()
    assert result(docs_of(spark, rows).repartition(5), size) == brute(rows, size)


def test_every_window_has_one_seed():
    import pyarrow as pa

    from tonality.llm.kernels import Powers, Words, is_word_byte_table

    texts = [t for _, t in passages()]
    found = S.seeds(Words(pa.array(texts), Powers(), is_word_byte_table()), Powers(S._STRETCH))
    per = defaultdict(list)
    for t, s, n in zip(found["text"].tolist(), found["start"].tolist(), found["n"].tolist(), strict=True):
        per[t] += range(s, s + n)
    for t, text in enumerate(texts):
        assert sorted(per[t]) == list(range(max(0, len(text.split()) - 49)))


def test_many_equal_rows_beside_an_earlier_document(spark):
    """3000 equal rows: their spans must not be collected from each other."""
    long = sentence(77, 400)
    first = " ".join(long.split()[:200]) + " " + sentence(78, 100)
    df = docs_of(spark, [(1, first)] + [(7, long)] * 3000).repartition(8)
    found = S.remove_repeats(df).groupBy("doc_id", "n_words", "n_removed").count().collect()
    assert {tuple(r) for r in found} == {(1, 300, 0, 1), (7, 400, 200, 3000)}
    assert S.repeats(df).where("doc_id = 7").distinct().count() < 400
