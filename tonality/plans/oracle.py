"""DuckDB SQL for each SQL-expressible query of the catalogue.

The SQL is generated from the same fixed values as the Spark expressions
(whitespace class, stop words, contractions, class names), written in the
RE2/DuckDB dialect. Queries whose result depends on an iterative optimiser
or on a stream (model fits, PCA, grid search, scoring) have no entry.
"""

from __future__ import annotations

import math

from ..functions.labels import sql_decode, sql_encode_label, sql_sentiment_from_flags
from ..functions.preview import (
    HOVER_COMMENT,
    HOVER_COORDS,
    HOVER_POINTS,
    HOVER_PRED,
    HOVER_RULE,
    HOVER_TRUE,
    PREVIEW_2D,
    PREVIEW_3D,
    sql_preview_source,
    sql_wrap,
)
from ..functions.text import WS_RE2, sql_clean, sql_content_tokens, sql_process, sql_quote
from ..operators.models import GRID
from ..operators.split import sql_bucket, sql_hash_key, sql_split
from ..schema import CLASSES
from .catalog import BOOTSTRAP_LEVEL, BOOTSTRAP_REPLICATES, SAMPLE_N, SEED, TRAIN_PCT

VOCAB = 5000
DIM = 384


def _class_values(with_order: bool = False) -> str:
    if with_order:
        rows = ", ".join(f"({c[0]}, '{c[1]}', {c[5]})" for c in CLASSES)
        return f"(VALUES {rows}) AS dim(label, sentiment, display_order)"
    rows = ", ".join(f"({c[0]}, '{c[1]}')" for c in CLASSES)
    return f"(VALUES {rows}) AS dim(label, sentiment)"


def _labelled_cte() -> str:
    """lab: labelled documents with processed text, label and split bucket."""
    return (
        "lab AS (SELECT d.doc_id, "
        f"{sql_process(sql_clean('d.text'))} AS processed, "
        f"{sql_encode_label(sql_sentiment_from_flags('l.toxic', 'l.quality'))} AS label, "
        f"{sql_bucket('d.doc_id', SEED)} AS b "
        "FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"
    )


def _tf_cte(name: str, source: str, keep: str) -> str:
    return (
        f"{name} AS (SELECT {keep}, term, count(*) AS tf FROM "
        f"(SELECT {keep}, unnest(string_split(processed, ' ')) AS term FROM {source}) "
        f"GROUP BY ALL)"
    )


def _all_docs_cte() -> str:
    return f"p AS (SELECT doc_id, {sql_process(sql_clean('text'))} AS processed FROM documents)"


def _vocab_cte(tf: str) -> str:
    return (
        f"vocab AS (SELECT term, CAST(sum(tf) AS BIGINT) AS n, count(*) AS df FROM {tf} "
        f"GROUP BY term ORDER BY n DESC, term LIMIT {VOCAB})"
    )


def _nb_ctes() -> str:
    return ",\n".join(
        [
            _labelled_cte(),
            f"train AS (SELECT * FROM lab WHERE b < {TRAIN_PCT})",
            f"test AS (SELECT * FROM lab WHERE b >= {TRAIN_PCT})",
            _tf_cte("tf", "train", "doc_id, label"),
            "m AS (SELECT CAST(count(*) AS DOUBLE) AS m FROM train)",
            _vocab_cte("tf"),
            "idf AS (SELECT term, ln((m.m + 1) / (CAST(df AS DOUBLE) + 1)) AS idf FROM vocab, m)",
            "w AS (SELECT tf.label, tf.term, tf.tf * idf.idf AS v FROM tf JOIN idf ON tf.term = idf.term)",
            "cls AS (SELECT label, count(*) AS n_docs FROM train GROUP BY label)",
            "scw AS (SELECT label, term, sum(v) AS s FROM w GROUP BY label, term)",
            "grid AS (SELECT cls.label, idf.term, coalesce(scw.s, 0.0) AS s FROM cls CROSS JOIN idf "
            "LEFT JOIN scw ON scw.label = cls.label AND scw.term = idf.term)",
            "sc AS (SELECT label, sum(s) AS s_c FROM grid GROUP BY label)",
            "consts AS (SELECT (SELECT CAST(sum(n_docs) AS DOUBLE) FROM cls) AS n_total, "
            "(SELECT CAST(count(*) AS DOUBLE) FROM cls) AS c, (SELECT CAST(count(*) AS DOUBLE) FROM idf) AS v)",
            "prior AS (SELECT cls.label, ln(CAST(n_docs AS DOUBLE) + 1) - ln(n_total + c * 1) AS prior, "
            "ln(s_c + v * 1) AS log_denom FROM cls JOIN sc ON cls.label = sc.label, consts)",
            "theta AS (SELECT grid.label, grid.term, ln(grid.s + 1) - prior.log_denom AS theta, prior.prior "
            "FROM grid JOIN prior ON grid.label = prior.label)",
            _tf_cte("ttf", "test", "doc_id, label"),
            "mc AS (SELECT ttf.doc_id, theta.label AS c, sum(ttf.tf * idf.idf * theta.theta) AS m "
            "FROM ttf JOIN idf ON ttf.term = idf.term JOIN theta ON ttf.term = theta.term GROUP BY ALL)",
            "scores AS (SELECT test.doc_id, test.label, prior.label AS c, prior.prior + coalesce(mc.m, 0) AS score "
            "FROM test CROSS JOIN prior LEFT JOIN mc ON mc.doc_id = test.doc_id AND mc.c = prior.label)",
            "preds AS (SELECT doc_id, label, CAST(first(c ORDER BY score DESC, c) AS DOUBLE) AS prediction "
            "FROM scores GROUP BY doc_id, label)",
        ]
    )


def _sample_cte() -> str:
    return (
        "smp AS (SELECT vec_id, CAST(label % 3 AS INTEGER) AS label, "
        "CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z "
        f"FROM embeddings ORDER BY {sql_hash_key('vec_id', SEED)}, vec_id LIMIT {SAMPLE_N})"
    )


def _label_rows() -> str:
    return f"SELECT doc_id, {sql_sentiment_from_flags()} AS Sentiment FROM labels"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["clean_text"] = f"SELECT doc_id, {sql_clean('text')} AS cleaned_comment FROM documents"
    q["tokenize_stop"] = (
        f"WITH c AS (SELECT doc_id, {sql_content_tokens(sql_clean('text'))} AS toks FROM documents) "
        "SELECT doc_id, array_to_string(toks, ' ') AS processed_comment, "
        "CAST(len(toks) AS INTEGER) AS n_tokens, len(toks) = 0 AS is_empty FROM c"
    )
    enc = f"SELECT doc_id, Sentiment, {sql_encode_label('Sentiment')} AS label FROM ({_label_rows()})"
    q["label_encode"] = enc
    q["label_audit"] = (
        f"SELECT Sentiment, label, count(*) AS n, "
        "(label = 0 AND (Sentiment IS NULL OR Sentiment <> 'negative')) AS catch_all "
        f"FROM ({enc}) GROUP BY Sentiment, label"
    )
    q["label_decode"] = (
        f"SELECT doc_id, label, {sql_decode('label', 1)} AS sentiment, {sql_decode('label', 2)} AS emoji, "
        f"{sql_decode('label', 3)} AS style, {sql_decode('label', 4)} AS color FROM ({enc})"
    )
    q["csv_ingest"] = (
        f"SELECT Sentiment, {sql_encode_label('Sentiment')} AS label, count(*) AS n, "
        "CAST(sum(length(coalesce(Comment, ''))) AS BIGINT) AS chars FROM ("
        f"SELECT d.text AS Comment, {sql_sentiment_from_flags('l.toxic', 'l.quality')} AS Sentiment "
        "FROM documents d JOIN labels l ON d.doc_id = l.doc_id) GROUP BY ALL"
    )
    q["csv_splits"] = q["csv_ingest"]
    q["sentiment_distribution"] = (
        f"WITH {_labelled_cte()}, cnt AS (SELECT label, count(*) AS n FROM lab GROUP BY label) "
        f"SELECT dim.label, dim.sentiment, dim.display_order, coalesce(cnt.n, 0) AS n "
        f"FROM {_class_values(True)} LEFT JOIN cnt ON dim.label = cnt.label"
    )
    q["class_slice"] = (
        f"WITH {_labelled_cte()}, s AS (SELECT doc_id, {sql_decode('label')} AS sentiment FROM lab) "
        "SELECT doc_id, sentiment, count(*) OVER (PARTITION BY sentiment) AS class_size FROM s"
    )
    q["train_test_split"] = f"SELECT doc_id, {sql_split('doc_id', TRAIN_PCT, SEED)} AS split FROM documents"
    q["embedding_sample"] = f"WITH {_sample_cte()} SELECT vec_id, label FROM smp"
    tf_all = f"WITH {_all_docs_cte()}, {_tf_cte('tf', 'p', 'doc_id')}"
    q["term_frequency"] = f"{tf_all} SELECT doc_id, term, tf FROM tf"
    q["vocabulary"] = (
        f"{tf_all}, {_vocab_cte('tf')} SELECT term, n, df, "
        "CAST(row_number() OVER (ORDER BY n DESC, term) - 1 AS INTEGER) AS rank FROM vocab"
    )
    idf_all = (
        f"{tf_all}, {_vocab_cte('tf')}, m AS (SELECT CAST(count(*) AS DOUBLE) AS m FROM documents), "
        "idf AS (SELECT term, df, ln((m.m + 1) / (CAST(df AS DOUBLE) + 1)) AS idf FROM vocab, m)"
    )
    q["idf"] = f"{idf_all} SELECT term, df, round(idf, 6) AS idf FROM idf"
    q["tfidf"] = (
        f"{idf_all} SELECT tf.doc_id, tf.term, tf.tf, round(tf.tf * idf.idf, 6) AS tfidf "
        "FROM tf JOIN idf ON tf.term = idf.term"
    )
    q["hash_embedding"] = (
        f"WITH t AS (SELECT doc_id, unnest({sql_content_tokens(sql_clean('text'))}) AS tok FROM documents), "
        "h AS (SELECT doc_id, md5(tok) AS hx FROM t), "
        f"s AS (SELECT doc_id, CAST(CAST(('0x' || substr(hx, 1, 8)) AS BIGINT) % {DIM} AS INTEGER) AS dim, "
        "CAST(sum(CASE WHEN substr(hx, 9, 1) < '8' THEN 1 ELSE -1 END) AS DOUBLE) AS s FROM h GROUP BY ALL), "
        "nrm AS (SELECT doc_id, sqrt(sum(s * s)) AS norm FROM s GROUP BY doc_id) "
        "SELECT s.doc_id, s.dim, round(s.s / nrm.norm, 6) AS value FROM s JOIN nrm ON s.doc_id = nrm.doc_id "
        "WHERE s.s <> 0"
    )
    nb = f"WITH {_nb_ctes()}"
    q["nb_model"] = f"{nb} SELECT label, term, round(prior, 6) AS prior, round(theta, 6) AS theta FROM theta"
    q["nb_incremental"] = q["nb_model"]
    q["nb_score"] = f"{nb} SELECT doc_id, label, prediction FROM preds"
    q["accuracy"] = (
        f"{nb} SELECT count(*) AS n, round(avg(CASE WHEN CAST(label AS DOUBLE) = prediction "
        "THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS accuracy FROM preds"
    )
    names = {c[0]: c[1].lower() for c in CLASSES}
    pivots = ", ".join(
        f"count(*) FILTER (WHERE prediction = {c}) AS pred_{n}" for c, n in names.items()
    )
    q["confusion_matrix"] = (
        f"{nb}, cm AS (SELECT label, {pivots} FROM preds GROUP BY label) "
        "SELECT dim.label AS true_label, dim.sentiment AS true_sentiment, "
        + ", ".join(f"coalesce(cm.pred_{n}, 0) AS pred_{n}" for n in names.values())
        + f" FROM {_class_values()} LEFT JOIN cm ON dim.label = cm.label"
    )
    hits = (
        f"{nb}, base AS (SELECT label AS b FROM cls ORDER BY n_docs DESC, label LIMIT 1), "
        "hits AS (SELECT doc_id, CAST(CAST(label AS DOUBLE) = prediction AS INTEGER) AS naive_bayes, "
        "CAST(label = b AS INTEGER) AS majority FROM preds, base)"
    )
    # the share of a Poisson(1) variable at most k, in steps of 1 / 65536
    limits = [round(sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) * 65536) for k in range(20)]
    drawn = " + ".join(f"CAST(step >= {t} AS INTEGER)" for t in limits if t < 65536)
    replicates = (
        f"{hits}, stepped AS (SELECT r, naive_bayes, majority, CAST(('0x' || substr(md5('{SEED}:' || (r // 8) || ':' || doc_id), "
        f"CAST(4 * (r % 8) + 1 AS INTEGER), 4)) AS INTEGER) AS step FROM hits, range({BOOTSTRAP_REPLICATES}) AS reps(r)), "
        f"drawn AS (SELECT r, naive_bayes, majority, {drawn} AS w FROM stepped), "
        "boot AS (SELECT CAST(r AS INTEGER) AS replicate, CAST(sum(w) AS BIGINT) AS rows, "
        "CAST(sum(w * naive_bayes) AS BIGINT) AS naive_bayes, CAST(sum(w * majority) AS BIGINT) AS majority FROM drawn GROUP BY r)"
    )
    q["accuracy_bootstrap"] = f"{replicates} SELECT replicate, rows, naive_bayes, majority FROM boot"
    place = lambda p: f"list_sort(list({{m}} / rows))[1 + CAST(floor((count(*) - 1) * {p} + 0.5) AS INTEGER)]"
    tail = (1 - BOOTSTRAP_LEVEL) / 2
    model = (
        "SELECT '{m}' AS model, (SELECT count(*) FROM hits) AS n, (SELECT round(avg({m}), 6) FROM hits) AS accuracy, "
        f"round({place(tail)}, 6) AS low, round({place(1 - tail)}, 6) AS high FROM boot WHERE rows > 0"
    )
    q["accuracy_interval"] = f"{replicates} " + " UNION ALL ".join(model.replace("{m}", m) for m in ("naive_bayes", "majority"))
    q["paired_test"] = (
        f"{hits}, c AS (SELECT count(*) AS n, count(*) FILTER (WHERE naive_bayes = 1 AND majority = 0) AS only_first, "
        "count(*) FILTER (WHERE naive_bayes = 0 AND majority = 1) AS only_second FROM hits), "
        "s AS (SELECT *, CASE WHEN only_first + only_second > 0 THEN "
        "pow(greatest(abs(only_first - only_second) - 1, 0), 2) / (only_first + only_second) ELSE 0.0 END AS statistic FROM c), "
        "t AS (SELECT *, 1 / (1 + 0.3275911::DOUBLE * sqrt(statistic / 2)) AS t FROM s) "
        "SELECT n, only_first, only_second, round(statistic, 6) AS statistic, round(CASE WHEN statistic = 0 THEN 1.0 ELSE "
        "t * (0.254829592::DOUBLE + t * (-0.284496736::DOUBLE + t * (1.421413741::DOUBLE + t * (-1.453152027::DOUBLE "
        "+ t * 1.061405429::DOUBLE)))) * exp(-statistic / 2) END, 6) AS p_value FROM t"
    )
    q["planar_projection"] = (
        f"WITH {_sample_cte()}, s AS (SELECT vec_id, {sql_decode('label')} AS sentiment, x, y, z FROM smp) "
        "SELECT vec_id, sentiment, 'XY' AS plane, round(x, 6) AS a, round(y, 6) AS b FROM s UNION ALL "
        "SELECT vec_id, sentiment, 'XZ', round(x, 6), round(z, 6) FROM s UNION ALL "
        "SELECT vec_id, sentiment, 'YZ', round(y, 6), round(z, 6) FROM s"
    )
    counts = ", ".join(
        f"CAST(count_if(sentiment = '{c[1]}') AS BIGINT) AS {c[1].lower()}_count" for c in CLASSES
    )
    q["embedding_report"] = (
        f"WITH {_sample_cte()}, s AS (SELECT {sql_decode('label')} AS sentiment, x, y, z FROM smp) "
        f"SELECT count(*) AS total_points, {counts}, "
        + ", ".join(f"round(var_pop({a}), 6) AS var_{a}" for a in "xyz")
        + ", "
        + ", ".join(f"round(max({a}) - min({a}), 6) AS range_{a}" for a in "xyz")
        + " FROM s"
    )
    src = sql_preview_source("processed")
    q["preview_text"] = (
        f"WITH {_all_docs_cte()}, s AS (SELECT doc_id, {src} AS src FROM p) "
        f"SELECT doc_id, {sql_wrap('src', *PREVIEW_3D)} AS preview_3d, {sql_wrap('src', *PREVIEW_2D)} AS preview_2d FROM s"
    )
    q["class_slice_positive"] = f"SELECT * FROM ({q['class_slice']}) WHERE sentiment = 'Positive'"
    q["value_counts"] = (
        f"WITH {_sample_cte()} SELECT {sql_decode('label')} AS sentiment, count(*) AS n FROM smp GROUP BY ALL"
    )
    q["hover_text"] = (
        f"WITH {_sample_cte()}, {_all_docs_cte()}, "
        f"t AS (SELECT doc_id, {sql_encode_label('Sentiment')} AS label FROM ({_label_rows()})), "
        f"j AS (SELECT smp.vec_id AS doc_id, {sql_decode('smp.label')} AS pred_name, "
        f"{sql_decode('t.label')} AS true_name, {src.replace('processed', 'p.processed')} AS src, x, y, z "
        "FROM smp LEFT JOIN p ON smp.vec_id = p.doc_id LEFT JOIN t ON smp.vec_id = t.doc_id), "
        "k AS (SELECT *, count(*) OVER (PARTITION BY pred_name) AS class_size FROM j) "
        "SELECT doc_id, '<b>' || pred_name || ' (' || CAST(class_size AS VARCHAR) || "
        f"{sql_quote(' ' + HOVER_POINTS + ')</b><br>' + HOVER_COMMENT)} || {sql_wrap('src', *PREVIEW_3D)} || "
        f"{sql_quote('<br>' + HOVER_RULE + HOVER_TRUE)} || true_name || {sql_quote('<br>' + HOVER_PRED)} || "
        f"pred_name || {sql_quote('<br>' + HOVER_COORDS + '(')} || printf('%.2f', x) || ', ' || "
        "printf('%.2f', y) || ', ' || printf('%.2f', z) || ')' AS hover FROM k"
    )
    q["nb_pipeline"] = q["nb_score"]
    held = f"SELECT count(*) AS n FROM embeddings WHERE {sql_bucket('vec_id', SEED)} >= {TRAIN_PCT}"
    q["lr_check"] = f"SELECT n, 0 AS mismatches, true AS converged FROM ({held})"
    q["rf_check"] = f"SELECT n, 0 AS mismatches, 0 AS bad_sums FROM ({held})"
    q["model_compare_check"] = (
        f"SELECT model, n, true AS consistent FROM ({held}), (VALUES ('logistic_regression'), ('random_forest')) AS m(model)"
    )
    reg, net, iters = (", ".join(f"({v})" for v in GRID[k]) for k in ("regParam", "elasticNetParam", "maxIter"))
    q["grid_check"] = (
        'SELECT CAST(r AS DOUBLE) AS "regParam", CAST(e AS DOUBLE) AS "elasticNet", m AS "maxIter", true AS in_place '
        f"FROM (VALUES {reg}) AS a(r), (VALUES {net}) AS b(e), (VALUES {iters}) AS c(m)"
    )
    q["grid_batched_check"] = q["grid_check"].replace("in_place", "optimal")
    q["landmark_check"] = "SELECT count(*) AS n, true AS placed, true AS better FROM embeddings"
    q["embedding_covariance"] = (
        "WITH e AS (SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS i, "
        "CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) "
        "SELECT i, j, CASE WHEN c = 0 THEN 0.0 ELSE c END AS cov FROM ("
        "SELECT a.i AS i, b.i AS j, round(covar_samp(a.x, b.x), 6) AS c "
        "FROM e a JOIN e b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY ALL)"
    )
    q["pca_check"] = "SELECT count(*) AS n, true AS orthonormal, true AS leading FROM embeddings"
    q["stream_check"] = (
        "SELECT count(*) AS n, 0 AS only_stream, 0 AS only_batch FROM conversations "
        f"WHERE regexp_matches(text, '[^{WS_RE2}]')"
    )
    return q
