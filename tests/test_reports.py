"""Report aggregates: distribution, confusion matrix, accuracy, class sizes."""

from tonality.operators import evaluate


def test_confusion_keeps_absent_class(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 2.0), (2, 2.0), (2, 2.0)], "label int, prediction double")
    cm = {r["true_label"]: r for r in evaluate.confusion_matrix(df).collect()}
    assert set(cm) == {0, 1, 2}
    assert (cm[1]["pred_negative"], cm[1]["pred_neutral"], cm[1]["pred_positive"]) == (0, 0, 0)
    assert (cm[0]["pred_negative"], cm[0]["pred_positive"]) == (1, 1)
    assert cm[2]["pred_positive"] == 2
    total = sum(r["pred_negative"] + r["pred_neutral"] + r["pred_positive"] for r in cm.values())
    diag = cm[0]["pred_negative"] + cm[1]["pred_neutral"] + cm[2]["pred_positive"]
    acc = evaluate.accuracy(df).first()
    assert total == acc["n"] == 4
    assert abs(diag / total - acc["accuracy"]) < 1e-12


def test_class_counts_zero_class_and_order(spark):
    df = spark.createDataFrame([(2.0,), (2.0,), (0.0,), (7.0,)], "prediction double")
    rows = evaluate.class_counts(df).collect()
    assert [r["sentiment"] for r in rows] == ["Positive", "Neutral", "Negative"]
    assert [r["n"] for r in rows] == [2, 0, 1]


def test_reports_need_no_join(spark):
    df = spark.createDataFrame([(2, 2.0)], "label int, prediction double")
    for out in (evaluate.class_counts(df), evaluate.confusion_matrix(df)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "partial_count" in plan


def test_class_size_matches_window(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(30)] + [(99, 1)], "id int, prediction int")
    got = {r["id"]: r["class_size"] for r in evaluate.class_slice(df).collect()}
    assert got[99] == 11 and got[0] == 10


def test_one_pass_reports_equal_the_single_ones(spark):
    df = spark.createDataFrame(
        [(0, 0.0), (0, 2.0), (2, 2.0), (1, 1.0), (5, 2.0), (None, 1.0), (2, 9.0), (7, 7.0)], "label int, prediction double"
    )
    reports = evaluate.class_reports(evaluate.summary_counts(df))
    assert reports["confusion_matrix"].collect() == evaluate.confusion_matrix(df).collect()
    assert reports["sentiment_distribution"].collect() == evaluate.class_counts(df).collect()
    row = reports["accuracy"].first()
    matrix = evaluate.confusion_matrix(df).selectExpr("sum(pred_negative + pred_neutral + pred_positive) AS n").first()["n"]
    assert (row["n"], row["left_out"]) == (8, 4) and matrix + row["left_out"] == row["n"]
    assert row["accuracy"] == 4 / 8
    assert evaluate.class_reports(evaluate.summary_counts(df.limit(0)))["accuracy"].first()["accuracy"] is None


def test_one_class_and_value_counts(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(9)] + [(99, 1)], "id int, prediction int")
    rows = evaluate.class_slice(df, name="Neutral").collect()
    assert sorted(r["id"] for r in rows) == [1, 4, 7, 99] and {r["class_size"] for r in rows} == {4}
    tied = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "s string")
    assert [tuple(r) for r in evaluate.value_counts(tied, "s").collect()] == [("a", 2), ("b", 2), ("c", 1)]
