import numpy as np
import pyarrow as pa

from tonality.llm import mixing as M

from .helpers import ascii_words, docs_of, edge_docs, empty_docs, sentence

INSULTS = ["vile", "nasty", "awful"]


def corpus(spark, n=400):
    """Plain texts, noise, and texts with insults, with labels for half."""
    rows, labels = [], []
    for i in range(n):
        kind = (i % 10 >= 7) + (i % 10 >= 9)
        text = sentence(i, 40 + i % 60)
        if kind == 1:
            text = " ".join(f"{w}##%" for w in text.split())
        if kind == 2:
            text += " " + " ".join(INSULTS)
        rows.append((i, text))
        if i % 2 == 0 or i % 20 >= 17:
            labels.append((i, int(kind == 0 or kind == 2), int(kind == 2)))
    return docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def kind_of(i):
    return (i % 10 >= 7) + (i % 10 >= 9)


def test_classifier_on_held_out_documents(spark):
    docs, labels = corpus(spark)
    model = M.fit_classifier(docs, labels.where("doc_id < 300"))
    rows = M.with_posteriors(docs.where("doc_id >= 300"), model).collect()
    right = sum(np.argmax([r.p_clean, r.p_low, r.p_toxic]) == kind_of(r.doc_id) for r in rows)
    assert right >= 0.9 * len(rows)
    for r in rows:
        assert abs(r.p_clean + r.p_low + r.p_toxic - 1) < 1e-9
        assert r.n_tokens == len(ascii_words(r.text))


def test_rates_meet_the_targets(spark):
    docs, labels = corpus(spark)
    shares = {"clean": 0.6, "low": 0.3, "toxic": 0.1}
    rows = M.mix(docs, labels, shares).collect()
    p = np.array([[r.p_clean, r.p_low, r.p_toxic] for r in rows])
    n, x = np.array([r.n_tokens for r in rows]), np.array([r.rate for r in rows])
    assert (x >= 0).all()
    reached = (p * (n * x)[:, None]).sum(axis=0)
    assert np.allclose(reached, n.sum() * np.array([0.6, 0.3, 0.1]), rtol=0.01)
    drawn = (n * np.array([r.copies for r in rows])).sum()
    assert abs(drawn / n.sum() - 1) < 0.1
    assert all(r.copies in (int(np.floor(r.rate)), int(np.floor(r.rate)) + 1) for r in rows)


def judged_rows(spark, p, n):
    return spark.createDataFrame([(int(a), *map(float, b)) for a, b in zip(n, p, strict=True)], "n_tokens long, p_clean double, p_low double, p_toxic double")


def loss_of(p, n, x, targets):
    r = (p * (n * x)[:, None]).sum(axis=0) - targets
    return r @ np.linalg.pinv((p * n[:, None]).T @ p, rcond=1e-9, hermitian=True) @ r


def plain_gradient(p, n, targets, most, steps):
    """Projected gradient with step 1 in the tokens' metric, and nothing else."""
    inverse = np.linalg.pinv((p * n[:, None]).T @ p, rcond=1e-9, hermitian=True)
    x = np.ones(len(n))
    for _ in range(steps):
        x = np.clip(x - p @ (inverse @ ((p * (n * x)[:, None]).sum(axis=0) - targets)), 0, most)
    return x


def test_rates_are_as_good_as_plain_projected_gradient(spark):
    r = np.random.default_rng(0)
    p = r.dirichlet([1, 1, 1], 50)
    n = r.integers(1, 100, 50)
    rows = judged_rows(spark, p, n)
    keys = ["n_tokens", "p_clean", "p_low", "p_toxic"]
    order = {tuple(k): i for i, k in enumerate(zip(n, *p.T, strict=True))}
    now = (p * n[:, None]).sum(axis=0)
    unreachable, reachable, bounded = np.array([100.0, 900.0, 10.0]), now * [0.7, 1.0, 1.2], now * [0.6, 0.5, 0.7]
    for targets, most in ((unreachable, np.inf), (reachable, np.inf), (bounded, 1.0)):
        steps = M.fit_rates(rows, targets, most)
        x = np.zeros(50)
        for row in rows.withColumn("r", M.rate(steps, most)).collect():
            x[order[tuple(row[k] for k in keys)]] = row.r
        assert (x >= 0).all() and (x <= most).all()
        plain = loss_of(p, n, plain_gradient(p, n, targets, most, len(steps)), targets)
        assert loss_of(p, n, x, targets) <= plain + 1e-6 * targets.sum()
        if targets is not unreachable:
            assert np.allclose((p * (n * x)[:, None]).sum(axis=0), targets, rtol=0.002)


def test_reachable_targets_are_reached_though_most_rows_stand_at_a_bound(spark):
    """Plain gradient steps need hundreds of scans here; the fit takes few."""
    r = np.random.default_rng(1)
    p = np.concatenate([r.dirichlet([60, 2, 1], 900), r.dirichlet([1, 1, 30], 60)])
    n = r.integers(20, 400, len(p))
    rows = judged_rows(spark, p, n)
    targets = M.kept_totals(rows, {"toxic": 0.0})
    steps = M.fit_rates(rows, targets, most=1.0)
    assert np.allclose(M.totals(rows, steps, 1.0), targets, rtol=0.002) and len(steps) <= 20


def test_equal_rows_are_drawn_one_by_one(spark):
    docs = docs_of(spark, [(7, "same words here")] * 4000)
    labels = spark.createDataFrame([(7, 1, 0)], "doc_id long, quality int, toxic int").limit(0)
    rows = M.materialise(M.with_posteriors(docs, M.fit_classifier(docs, labels)).withColumn("row", M.F.monotonically_increasing_id()), "rows")
    drawn = rows.where(M.copies(M.F.lit(0.3), "row", "doc_id") >= 1).count()
    assert 1000 < drawn < 1400


def test_thinning_drops_the_toxic_and_keeps_the_clean(spark):
    docs, labels = corpus(spark)
    kept = {r.doc_id for r in M.thin(docs, labels, {"toxic": 0.0}).collect()}
    clean = [i for i in range(400) if kind_of(i) == 0]
    toxic = [i for i in range(400) if kind_of(i) == 2]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean)
    assert sum(i in kept for i in toxic) <= 0.15 * len(toxic)


def test_edge_rows(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 0, 1), (3, None, 0), (None, 1, 1), (9, 0, 0), (99, 1, 1)], "doc_id long, quality int, toxic int"
    )
    rows = M.mix(docs, labels, {"clean": 0.5, "low": 0.5, "toxic": 0.0}).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in rows), key=str) == sorted(((r.doc_id, len(ascii_words(r.text))) for r in docs.collect()), key=str)
    assert M.thin(docs, labels, {}).columns == docs.columns
    none = M.mix(docs, labels.limit(0), {"clean": 1.0, "low": 1.0, "toxic": 1.0}).collect()
    assert all(abs(r.p_low - 1 / 3) < 1e-9 and abs(r.rate - 1) < 1e-6 for r in none)
    assert M.mix(empty_docs(spark), labels, {"clean": 1.0, "low": 1.0, "toxic": 1.0}).count() == 0
    assert M.thin(empty_docs(spark), labels, {"toxic": 0.0}).count() == 0


def test_features_depend_on_the_text_alone():
    f = M.Features()
    texts = ["Trash, trash idiot", "", "ÉÉ ü 1 ##", "a" * 5000]
    together = f(pa.array(texts))
    for i, t in enumerate(texts):
        bucket, before, dense, tokens = f(pa.array([t]))
        assert (together[0][together[1][i] : together[1][i + 1]] == bucket).all()
        assert np.allclose(together[2][i], dense[0]) and together[3][i] == tokens[0] == len(t.encode().split())


def test_thinning_keeps_clean_documents_with_some_toxic_mass(spark, monkeypatch):
    """Every clean document has a small p_toxic: removing it is not the aim."""

    def judged(docs, model, text="text"):
        p = M.F.col("text").cast("double")
        named = {"n_tokens": M.F.lit(10).cast("long"), "p_clean": 0.97 * (1 - p), "p_low": 0.03 * (1 - p), "p_toxic": p}
        return docs.withColumns(named)

    monkeypatch.setattr(M, "fit_classifier", lambda *a, **k: None)
    monkeypatch.setattr(M, "with_posteriors", judged)
    r = np.random.default_rng(6)
    p = [*r.beta(0.5, 20, 900), *r.beta(20, 2, 100)]
    docs = docs_of(spark, [(i, str(float(x))) for i, x in enumerate(p)])
    kept = {x.doc_id for x in M.thin(docs, None, {"toxic": 0.0}).collect()}
    assert sum(i in kept for i in range(900)) >= 0.99 * 900
    assert sum(i in kept for i in range(900, 1000)) <= 5
