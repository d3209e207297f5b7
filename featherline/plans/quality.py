"""Queries over scored tables: metrics, losses, thresholds, rankings, weights and moments."""

from __future__ import annotations

from pyspark.sql import functions as F

from featherline.functions import vectors
from featherline.operators import curves, losses, metrics, ranking, weights
from featherline.plans.encoding import MEASURES
from featherline.plans.registry import query, table


def labelled(spark, folder):
    """Documents that have labels, with a probability-like score from their length."""
    length = F.col("n_chars").cast("double")
    return table(spark, folder, "labels").join(table(spark, folder, "documents"), "doc_id").select(
        "doc_id", "lang", F.col("quality").cast("double").alias("label"), F.col("toxic").cast("double").alias("toxic"),
        (length / (length + 1000.0)).alias("score"))


LABELLED = """
    SELECT l.doc_id, d.lang, l.quality::DOUBLE AS label, l.toxic::DOUBLE AS toxic,
        d.n_chars::DOUBLE / (d.n_chars::DOUBLE + 1000.0::DOUBLE) AS score
    FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""


def rounded(df, digits=6, keep=()):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" and c not in keep else F.col(c) for c, t in df.dtypes])


RATES = """
    SELECT {head} round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round((fp + fn) / (tp + fp + fn + tn), 6) AS error,
        round(p, 6) AS precision, round(r, 6) AS recall,
        round(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END, 6) AS f1,
        round(CASE WHEN 4 * p + r = 0 THEN 0 ELSE 5 * p * r / (4 * p + r) END, 6) AS f_beta, tp, fp, fn, tn
    FROM (SELECT *, CASE WHEN tp + fp = 0 THEN 0::DOUBLE ELSE tp / (tp + fp) END AS p,
        CASE WHEN tp + fn = 0 THEN 0::DOUBLE ELSE tp / (tp + fn) END AS r FROM ({counts}))"""


@query("clf_metrics", RATES.format(head="", counts=f"""
    SELECT count(*) FILTER (label = 1 AND score >= 0.6) AS tp, count(*) FILTER (label <> 1 AND score >= 0.6) AS fp,
        count(*) FILTER (label = 1 AND score < 0.6) AS fn, count(*) FILTER (label <> 1 AND score < 0.6) AS tn
    FROM ({LABELLED})"""))
def clf_metrics(spark, folder):
    return rounded(metrics.binary_metrics(labelled(spark, folder), threshold=0.6, beta=2.0))


@query("error_at", f"""
    SELECT t AS threshold, round(avg(CASE WHEN (score > t) = (label = 1) THEN 0.0 ELSE 1.0 END), 6) AS error
    FROM ({LABELLED}), (SELECT unnest([0.25, 0.5, 0.75])::DOUBLE AS t) GROUP BY t""")
def error_at(spark, folder):
    """``error@t`` for three thresholds, in one pass."""
    found = metrics.errors_at(labelled(spark, folder), (0.25, 0.5, 0.75))
    return found.select("threshold", F.round("error", 6).alias("error"))


def class_scores(spark, folder):
    """Five positive scores per event from its value and user, and its type as the class."""
    kinds = ("click", "error", "purchase", "signup", "view")
    label = sum((F.when(F.col("event_type") == k, float(i)).otherwise(0.0) for i, k in enumerate(kinds)), F.lit(0.0))
    scores = F.array(*[(F.col("value") + 1.0) / (1.0 + (F.col("user_id") * (i + 3) % 7).cast("double")) for i in range(5)])
    return table(spark, folder, "events").select("event_id", label.alias("label"), scores.alias("raw"))


CLASS_SCORES = """
    SELECT event_id, list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) - 1 AS label,
        [(value + 1.0) / (1.0 + (user_id * (i + 3) % 7)::DOUBLE) FOR i IN [0, 1, 2, 3, 4]] AS raw FROM events"""


@query("merror", f"""
    SELECT round(avg(CASE WHEN p = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
        round(avg(CASE WHEN p = label THEN 0.0 ELSE 1.0 END), 6) AS merror
    FROM (SELECT label, list_position(raw, list_max(raw)) - 1 AS p FROM ({CLASS_SCORES}))""")
def merror(spark, folder):
    predicted = (F.array_position("raw", F.array_max("raw")) - 1).cast("double")
    return rounded(metrics.multiclass_metrics(class_scores(spark, folder).withColumn("predicted_label", predicted)))


@query("log_losses", f"""
    SELECT round(avg(-ln(greatest(CASE WHEN label = 1 THEN score ELSE 1 - score END, 1e-15))), 6) AS logloss
    FROM ({LABELLED})""")
def log_losses(spark, folder):
    return rounded(metrics.log_losses(labelled(spark, folder)))


@query("mlog_losses", f"""
    SELECT round(avg(-ln(raw[label + 1] / list_sum(raw))), 6) AS mlogloss FROM ({CLASS_SCORES})""")
def mlog_losses(spark, folder):
    total = F.aggregate("raw", F.lit(0.0), lambda acc, s: acc + s)
    shares = F.transform("raw", lambda s: s / total)
    return rounded(metrics.multiclass_log_losses(class_scores(spark, folder).withColumn("score", shares)))


def priced(spark, folder):
    """Line price in thousands, and a fixed linear guess of it."""
    return table(spark, folder, "lineitem").select(
        (F.col("l_extendedprice") / 1000.0).alias("label"),
        (F.col("l_quantity") * 1.5 + F.col("l_discount") * 10.0).alias("score"))


PRICED = "SELECT l_extendedprice / 1000.0 AS label, l_quantity * 1.5 + l_discount * 10.0 AS score FROM lineitem"


@query("reg_errors", f"""
    SELECT round(sqrt(avg((label - score) ^ 2)), 6) AS rmse, round(avg(abs(label - score)), 6) AS mae FROM ({PRICED})""")
def reg_errors(spark, folder):
    return rounded(metrics.regression_errors(priced(spark, folder)))


@query("loss_table", f"""
    SELECT round(avg(e * e), 6) AS squared_loss, round(avg(abs(e)), 6) AS absolute_loss,
        round(avg(greatest(abs(e) - 0.5, 0) ^ 2), 6) AS eps_insensitive_squared_loss,
        round(avg(greatest(abs(e) - 0.5, 0)), 6) AS eps_insensitive_absolute_loss,
        round(avg(CASE WHEN e >= 0 THEN 0.3 * e ELSE -0.7 * e END), 6) AS quantile_loss,
        round(avg(CASE WHEN abs(e) <= 2 THEN 0.5 * e * e ELSE 2 * (abs(e) - 1) END), 6) AS huber_loss
    FROM (SELECT label - score AS e FROM ({PRICED}))""")
def loss_table(spark, folder):
    return rounded(losses.regression_losses(priced(spark, folder), "label", "score", 0.5, 0.3, 2.0))


@query("loss_table_classes", f"""
    SELECT round(avg(ln(1 + exp(-m))), 6) AS logistic, round(avg(greatest(1.5 - m, 0)), 6) AS hinge_loss
    FROM (SELECT CASE WHEN label = 1 THEN 4 * score - 2 ELSE 2 - 4 * score END AS m FROM ({LABELLED}))""")
def loss_table_classes(spark, folder):
    scored = labelled(spark, folder).withColumn("score", F.col("score") * 4 - 2)
    return rounded(losses.classification_losses(scored, "label", "score", 1.5))


@query("softmax_loss", f"""
    SELECT round(avg(ln(list_sum([exp(s / 100) FOR s IN raw])) - raw[label + 1] / 100), 6) AS softmax_loss
    FROM ({CLASS_SCORES})""")
def softmax_loss(spark, folder):
    scaled = F.transform("raw", lambda s: s / 100)
    return class_scores(spark, folder).agg(F.round(F.avg(losses.softmax(F.col("label"), scaled)), 6).alias("softmax_loss"))


@query("topk_accuracy", f"""
    SELECT round(avg(CASE WHEN len([i FOR i IN [1, 2, 3, 4, 5] IF raw[i] > own OR (raw[i] = own AND i <= label)]) < 2
        THEN 1.0 ELSE 0.0 END), 6) AS top_k_accuracy
    FROM (SELECT label, raw, raw[label + 1] AS own FROM ({CLASS_SCORES}))""")
def topk_accuracy(spark, folder):
    return rounded(metrics.top_k_accuracy(class_scores(spark, folder), 2, scores="raw"))


SWEEP = f"""
    SELECT score AS threshold, tp, fp, np - tp AS fn, nn - fp AS tn FROM (
        SELECT score, sum(p) OVER (ORDER BY score DESC)::BIGINT AS tp, sum(n) OVER (ORDER BY score DESC)::BIGINT AS fp,
            sum(p) OVER ()::BIGINT AS np, sum(n) OVER ()::BIGINT AS nn
        FROM (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label <> 1) AS n
            FROM ({LABELLED}) GROUP BY score))"""


@query("threshold_sweep", RATES.format(head="threshold,", counts=SWEEP))
def threshold_sweep(spark, folder):
    return rounded(curves.threshold_sweep(labelled(spark, folder), beta=2.0), keep=("threshold",))


@query("threshold_sweep_ranges", RATES.format(head="threshold,", counts=SWEEP))
def threshold_sweep_ranges(spark, folder):
    """The same sweep over a stated number of ranges."""
    return rounded(curves.threshold_sweep(labelled(spark, folder), beta=2.0, ranges=7), keep=("threshold",))


def best_sql(criterion, goal, where="true"):
    return f"""SELECT '{criterion}' AS criterion, threshold, round({goal}, 6) AS value FROM (
        SELECT threshold, tp, fp, (tp + tn) / (tp + fp + fn + tn) AS accuracy, tp / (tp + fp) AS precision,
            tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1 FROM ({SWEEP}))
        WHERE {where} ORDER BY {goal} DESC, threshold DESC LIMIT 1"""


BEST = (
    ("accuracy", "accuracy", "true"), ("f1", "f1", "true"),
    ("precision_at_target_recall", "precision", "recall >= 0.8"),
    ("recall_at_target_precision", "recall", "precision >= 0.8"))


@query("threshold_choice", " UNION ALL ".join(f"({best_sql(*b)})" for b in BEST))
def threshold_choice(spark, folder):
    sweep = curves.threshold_sweep(labelled(spark, folder))
    parts = [
        curves.best_threshold(sweep, criterion).select(
            F.lit(criterion).alias("criterion"), "threshold", F.round(goal, 6).alias("value"))
        for criterion, goal, _ in BEST]
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    return result


@query("auc", f"""
    SELECT round(sum(n * (tp - p / 2)) / (sum(p) * sum(n)), 6) AS auc FROM (
        SELECT p, n, sum(p) OVER (ORDER BY score DESC) AS tp FROM (
            SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label <> 1) AS n
            FROM ({LABELLED}) GROUP BY score))""")
def auc(spark, folder):
    return rounded(curves.auc(labelled(spark, folder)))


def rank_sql(cut=None, empty=1):
    inside = "true" if cut is None else "{} <= " + str(cut)
    return f"""
    SELECT lang, n_rows, round(CASE WHEN best = 0 THEN {empty} ELSE dcg / best END, 6) AS ndcg,
        round(CASE WHEN positives = 0 THEN {empty} ELSE ap / positives END, 6) AS map FROM (
        SELECT lang, count(*) AS n_rows,
            sum(CASE WHEN {inside.format('rk')} THEN (2 ^ label - 1) / log2(rk + 1) ELSE 0 END) AS dcg,
            sum(CASE WHEN {inside.format('ideal')} THEN (2 ^ label - 1) / log2(ideal + 1) ELSE 0 END) AS best,
            sum(CASE WHEN label > 0 AND {inside.format('rk')} THEN hits / rk ELSE 0 END) AS ap,
            count(*) FILTER (label > 0) AS positives
        FROM (SELECT *, sum(CASE WHEN label > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY lang ORDER BY rk) AS hits FROM (
            SELECT lang, toxic + label AS label,
                row_number() OVER (PARTITION BY lang ORDER BY score DESC, doc_id) AS rk,
                row_number() OVER (PARTITION BY lang ORDER BY toxic + label DESC, doc_id) AS ideal
            FROM ({LABELLED}))) GROUP BY lang)"""


def relevance(spark, folder):
    return labelled(spark, folder).withColumn("relevance", F.col("toxic") + F.col("label"))


@query("rank_metrics", rank_sql())
def rank_metrics(spark, folder):
    return rounded(ranking.per_query(relevance(spark, folder), "lang", "relevance", "score", "doc_id"))


@query("rank_metrics_at", rank_sql(10, 0))
def rank_metrics_at(spark, folder):
    """Cut at 10, lists without positives counting 0."""
    return rounded(ranking.per_query(
        relevance(spark, folder), "lang", "relevance", "score", "doc_id", 10, True))


@query("rank_means", f"""
    SELECT round(avg(ndcg), 5) AS ndcg, round(avg(map), 5) AS map FROM ({rank_sql()})""")
def rank_means(spark, folder):
    lists = ranking.per_query(relevance(spark, folder), "lang", "relevance", "score", "doc_id")
    return lists.agg(F.round(F.avg(F.round("ndcg", 6)), 5).alias("ndcg"), F.round(F.avg(F.round("map", 6)), 5).alias("map"))


POOL = 50
HEX = "('0x' || substr(digest, {}, 8))::UBIGINT::BIGINT"


@query("rank_pairs", f"""
    WITH hashed AS (
        SELECT *, md5(lang || '|' || doc_id) AS digest FROM ({LABELLED})),
    sized AS (SELECT lang, ceil(count(*) / {POOL})::BIGINT AS pools FROM hashed GROUP BY lang),
    pooled AS (SELECT h.*, {HEX.format(1)} % s.pools AS pool, {HEX.format(9)} AS spin FROM hashed h JOIN sized s ON h.lang = s.lang),
    placed AS (SELECT *, row_number() OVER (PARTITION BY lang, pool ORDER BY label, digest, doc_id) AS place,
        rank() OVER (PARTITION BY lang, pool ORDER BY label) - 1 AS lower FROM pooled)
    SELECT a.lang, a.doc_id AS doc_id_high, b.doc_id AS doc_id_low, a.label AS label_high, b.label AS label_low,
        round(a.score - b.score, 6) AS difference
    FROM placed a JOIN placed b ON a.lang = b.lang AND a.pool = b.pool AND a.lower > 0 AND b.place = a.spin % a.lower + 1""")
def rank_pairs(spark, folder):
    pairs = ranking.training_pairs(labelled(spark, folder), "lang", "label", "doc_id", ["label", "score"], POOL)
    return pairs.select("lang", "doc_id_high", "doc_id_low", "label_high", "label_low",
                        F.round(F.col("score_high") - F.col("score_low"), 6).alias("difference"))


def digits_of(name, column):
    """Digits at which a mean of two-decimal numbers is never halfway, and few for large ones."""
    return 4 if name != "avg" else 3 if column == "l_extendedprice" else 8


def per_measure(name, names=MEASURES):
    return ", ".join(f"round({name}({c}), {digits_of(name, c)}) AS {name}_{c}" for c in names)


@query("scaler_moments", f"""
    SELECT count(*) AS n_rows, {per_measure('avg')}, {per_measure('stddev_samp')},
        round(avg(l_extendedprice / 100), 4) AS label_mean, round(stddev_samp(l_extendedprice / 100), 4) AS label_std
    FROM lineitem""")
def scaler_moments(spark, folder):
    df = table(spark, folder, "lineitem").select(
        vectors.vector_of(*MEASURES).alias("features"), (F.col("l_extendedprice") / 100).alias("label"))
    return spread(weights.moments(df, label="label"), MEASURES).withColumns(
        {c: F.round(c, 4) for c in ("label_mean", "label_std")})


def spread(summary, names):
    columns = [F.round(vectors.to_array("mean")[i], digits_of("avg", c)).alias(f"avg_{c}") for i, c in enumerate(names)]
    columns += [F.round(vectors.to_array("std")[i], 4).alias(f"stddev_samp_{c}") for i, c in enumerate(names)]
    return summary.select("n_rows", *columns, *[c for c in ("label_mean", "label_std") if c in summary.columns])


@query("scaler_sample", f"""
    SELECT count(*) AS n_rows, {per_measure('avg', ('value',))}, {per_measure('stddev_samp', ('value',))} FROM (
        SELECT value FROM events ORDER BY md5(event_id::VARCHAR), event_id LIMIT 500)""")
def scaler_sample(spark, folder):
    """Moments over a hash-ordered sample: the sample size is the operator's parameter."""
    df = table(spark, folder, "events").select("event_id", vectors.vector_of("value").alias("features"))
    return spread(weights.moments(df, max_rows=500, key=["event_id"]), ("value",))


@query("class_weights", """
    SELECT event_type, n, round(sum(n) OVER () / (count(*) OVER () * n), 9) AS weight
    FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)""")
def class_weights(spark, folder):
    return rounded(weights.class_weights(table(spark, folder, "events"), "event_type"), 9)


@query("weighted_rows", """
    SELECT e.event_id, round(t.weight, 9) AS weight FROM events e JOIN (
        SELECT event_type, sum(n) OVER () / (count(*) OVER () * n) AS weight
        FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)) t ON e.event_type = t.event_type""")
def weighted_rows(spark, folder):
    df = weights.with_class_weights(table(spark, folder, "events"), "event_type")
    return df.select("event_id", F.round("weight", 9).alias("weight"))


@query("pos_weight", """
    SELECT count(*) FILTER (quality = 1) AS n_positive, count(*) FILTER (quality <> 1) AS n_negative,
        round(count(*) FILTER (quality <> 1) / count(*) FILTER (quality = 1), 9) AS ratio FROM labels""")
def pos_weight(spark, folder):
    return rounded(weights.neg_over_pos(table(spark, folder, "labels"), "quality"), 9)


