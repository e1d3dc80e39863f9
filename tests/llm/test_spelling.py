"""Spelling variants against a comparison of all pairs."""

import random
import re
from collections import Counter
from itertools import combinations
from zlib import crc32

import pytest

from tonality.llm import spelling
from tonality.llm.spelling import count_words, near_words, plain, typo, variants

from .helpers import edge_docs, empty_docs


def one_edit(x, y):
    if len(x) > len(y):
        x, y = y, x
    if x == y or len(y) - len(x) > 1:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    return any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def all_pairs(words):
    return {tuple(sorted(p)) for p in combinations(sorted(set(words)), 2) if one_edit(*p)}


def random_words(seed, n, letters, low, high):
    r = random.Random(seed)
    base = ["".join(r.choice(letters) for _ in range(r.randint(low, high))) for _ in range(n)]
    out = list(base)
    for w in base:
        at = r.randrange(len(w))
        out += [w[:at] + w[at + 1 :], w[:at] + r.choice(letters) + w[at:], w[:at] + r.choice(letters) + w[at + 1 :]]
    return sorted({w for w in out if w})


@pytest.mark.parametrize("bucket", [1, 4, 4096])
@pytest.mark.parametrize("letters, low, high", [("ab", 1, 8), ("aé", 5, 9), ("abcdefgh", 6, 12)])
def test_near_words_equal_all_pairs(spark, bucket, letters, low, high):
    words = random_words(low * high, 60, letters, low, high)
    got = [tuple(sorted(r)) for r in near_words(spark.createDataFrame([(w,) for w in words], "word string"), bucket).collect()]
    assert len(got) == len(set(got))
    assert set(got) == all_pairs(words)


def test_a_chunk_that_all_words_share_is_split(spark):
    """1500 words with one first half: more pairs than a bucket may make."""
    r = random.Random(3)
    words = sorted({"gemeinsam" + "".join(r.choice("abcdef") for _ in range(9)) for _ in range(1500)} | {"gemeinsamabcdefabc", "gemeinsamabcdefab"})
    got = {tuple(sorted(p)) for p in near_words(spark.createDataFrame([(w,) for w in words], "word string"), 64).collect()}
    assert got == all_pairs(words)


def brute_variants(counts):
    near = {w: [] for w in counts}
    for x, y in all_pairs(counts):
        near[x].append(y)
        near[y].append(x)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def test_variants_equal_brute_force(spark):
    words = random_words(5, 60, "abcd", 5, 7)
    r = random.Random(8)
    counts = {w: 5 ** r.randint(0, 6) for w in words} | {"chains": 5**9, "chain": 5**8, "chan": 5**7, "cha": 5**6, "ch": 5**5, "h": 5**4}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {tuple(r) for r in variants(df, 8).collect()}
    assert got == brute_variants(counts)
    assert ("h", "ch", "chains", 625, *[x[4:] for x in got if x[0] == "h"][0]) in got


def test_words_and_planted_typos(spark, monkeypatch):
    monkeypatch.setattr(spelling, "LONG_TEXT", 100)
    docs = [(i, f"Wörter und ÄPFEL{i % 7} naïveté×÷ don't ßharp " * (i % 40)) for i in range(400)] + [(None, "Nullwort Nullwort"), (7, None)]
    expect = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                expect[run] += 1
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r["word"]: r["n"] for r in count_words(df, typo).collect()} == dict(expect)
    assert sum(r["n"] for r in count_words(df, plain, 1).collect()) == sum(len(re.findall("[A-Za-zÀ-ÿ]+", t or "")) for _, t in docs)


def test_edge_rows_and_an_empty_table(spark):
    words = count_words(edge_docs(spark), plain, 1)
    assert variants(words).count() == words.count() > 0
    assert variants(count_words(empty_docs(spark))).collect() == []
