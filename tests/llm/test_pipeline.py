import sys

from tonality.llm.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.001"


def test_stages_pass_whole_documents_on(spark, tmp_dir):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for i, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, SF)
        assert i == len(C.STAGES) - 1 or out.columns == columns, name
        path = f"{tmp_dir}/{i}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if i < len(C.STAGES) - 1:
            assert 0 < docs.count() <= before
            assert docs.select("doc_id").distinct().count() == docs.count()
            before = docs.count()
    assert docs.select("doc_id").distinct().count() == before


def test_each_stage_does_its_work(spark):
    import corpus_pipeline as C

    from .helpers import ROWS, sentence

    lang = "en"
    rows = [(d, t, lang, "s", len(t or "")) for d, t in ROWS]
    junk = " ".join(f"{w}###" for w in sentence(50, 80).split())
    rows.append((60, junk, lang, "s", len(junk)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    good = C.quality(spark, docs, SF)
    kept = {r.doc_id for r in good.collect()}
    assert {1, 2, 3, 9, 13, 14} <= kept and not kept & {4, 5, 6, 7, 8, 12, 60}
    one = {r.doc_id for r in C.near_dedup(spark, good, SF).collect()}
    assert 1 in one and 9 in one and 13 in one and not one & {2, 3, 14}
    cut = {r.doc_id: r for r in C.substring_dedup(spark, docs.where("doc_id IN (1, 9)"), SF).collect()}
    assert cut[1].text == ROWS[0][1] and cut[1].n_chars == len(ROWS[0][1])
    assert len(cut[9].text.split()) == 60 and cut[9].n_chars == len(cut[9].text)
    gone = C.substring_dedup(spark, docs.where("doc_id IN (1, 2)"), SF)
    assert [r.doc_id for r in gone.collect()] == [1]


def test_every_stage_takes_awkward_rows_and_names(spark):
    """Null ids and texts, repeated rows, long texts; columns named like those
    that the stages use inside."""
    import corpus_pipeline as C

    from .helpers import EXTRA, ROWS

    values = (1, "r", "w", 2, 3, 4, 5, 0.5, "mine", "own", 6)
    names = f"doc_id long, text string, {EXTRA}, _text string, text_0 string, p_toxic int"
    docs = spark.createDataFrame([(d, t, *values) for d, t in ROWS], names)
    for name, stage in C.STAGES:
        out = stage(spark, docs, SF)
        if name == "packing":
            # every row is packed: pieces without an id come from the two null ids
            assert {r.doc_id for r in out.select("doc_id").collect()} == {d for d, _ in ROWS}
            continue
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(tuple(r)[2:] == values for r in rows), name
        texts = {}
        for d, t in ROWS:
            texts.setdefault(d, []).append(t)
        if name == "substring dedup":
            kept = {r.doc_id: r.text for r in rows}
            assert kept[1] == ROWS[0][1] and kept[4] is None and kept[10] == dict(ROWS)[10]
            assert 2 not in kept and len(kept[9].split()) == 60 and sum(r.doc_id == 13 for r in rows) == 2
        else:
            assert all(r.text in texts[r.doc_id] for r in rows), name


def test_every_stage_takes_an_empty_table(spark):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_run_and_registration(spark):
    import __spark_entry__ as e

    names = e.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(ORACLE_SQL) <= set(names) and set(e.oracle_sql()) <= set(names)
    assert names["pipeline"](spark, SF).count() > 0
    assert "corpus_pipeline" in sys.modules
