from collections import Counter

from tonality.llm import quality as Q

from .helpers import ascii_words, docs_of, edge_docs, empty_docs


def brute(text):
    t = text or ""
    w = [x.decode() for x in ascii_words(t)]
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    times = Counter(windows)
    covered = {j for i, v in enumerate(windows) if times[v] > 1 for j in range(i, i + 8)}
    lines = [x for x in t.split("\n") if x.encode().split()]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in t),
        "n_upper": sum("A" <= c <= "Z" for c in t),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def test_measures_and_verdicts_equal_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in edge_docs(spark).collect()]
    extra = ["a b c d e f g h " * 2 + "x", "a b c d e f g h i a b c d e f g h j b c d e f g h i", "# | a\n# | a\n\n#", "😀 é 𝒳 &&"]
    rows += [(100 + i, t) for i, t in enumerate(extra)]
    got = Q.quality_report(docs_of(spark, rows)).collect()
    expected = sorted(((d, *brute(t).values()) for d, t in rows), key=str)
    assert sorted(((r.doc_id, *(r[k] for k in Q.MEASURES)) for r in got), key=str) == expected
    for r in got:
        base = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == base
        assert r.kept == ((r.failure_bits & Q.mask("v2")) == 0)
        assert not (base and r.kept)


def test_clashing_columns_are_replaced_and_empty_is_empty(spark):
    out = Q.ledger(edge_docs(spark))
    assert len(set(out.columns)) == len(out.columns)
    assert Q.quality_filter(edge_docs(spark)).columns == edge_docs(spark).columns
    assert Q.quality_report(empty_docs(spark)).count() == 0


def test_policies_are_masks_and_ablations_count_patterns(spark):
    ledger = Q.ledger(edge_docs(spark)).cache()
    bits = [r.failure_bits & Q.mask("v2") for r in ledger.collect()]
    for r in Q.ablations(ledger, "v2").collect():
        b = Q.bit(r.rule)
        assert r.rule_bit == b
        assert r.n_failed == sum(x & b != 0 for x in bits)
        assert r.n_only_this == sum(x == b for x in bits)
        beside = 0
        for x in bits:
            beside |= (x ^ b) if x & b else 0
        assert r.fails_beside == beside


def test_no_python_in_the_plan(spark):
    plan = Q.quality_report(edge_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
