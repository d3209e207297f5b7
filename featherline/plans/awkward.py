"""Queries on awkward inputs: absent classes, vectors of low rank, robust fits, unusual URIs and lines."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from featherline.algorithms import boosted, linear, pca
from featherline.functions import keys, text, vectors
from featherline.operators import curves, metrics
from featherline.plans.encoding import KEYED, through_files
from featherline.plans.models import OFF_TIE, one_hot, spending
from featherline.plans.registry import query, table


@query("huber_fit", """
    WITH RECURSIVE held AS (SELECT l_returnflag AS flag, l_linenumber::DOUBLE AS y, count(*) AS n FROM lineitem GROUP BY ALL),
    halves AS (
        SELECT flag, delta, 0.0::DOUBLE AS low, 8.0::DOUBLE AS high, 0 AS k
        FROM (SELECT DISTINCT flag FROM held), (SELECT unnest([0.5, 2.0])::DOUBLE AS delta)
        UNION ALL
        SELECT flag, delta, CASE WHEN pull > 0 THEN middle ELSE low END, CASE WHEN pull > 0 THEN high ELSE middle END, k + 1 FROM (
            SELECT s.flag, s.delta, s.low, s.high, s.k, (s.low + s.high) / 2 AS middle,
                sum(n * greatest(-s.delta, least(s.delta, y - (s.low + s.high) / 2))) AS pull
            FROM halves s JOIN held h ON s.flag = h.flag WHERE s.k < 45 GROUP BY s.flag, s.delta, s.low, s.high, s.k))
    SELECT flag AS l_returnflag, delta, round(low + 0.00001234, 3) AS score FROM halves WHERE k = 45""")
def huber_fit(spark, folder):
    """The Huber location of each flag's line numbers, for two deltas; SQL halves intervals around it."""
    df = one_hot(table(spark, folder, "lineitem").withColumn("label", F.col("l_linenumber").cast("double")), "l_returnflag", ("label",))
    parts = []
    for delta in (0.5, 2.0):
        trainer = linear.RegressorTable(feature_dim=3, loss="huber_loss", huber_delta=delta, use_bias=False, epochs=80)
        scored = trainer.fit(df).transform(df).groupBy("l_returnflag").agg(F.round(F.avg("score") + OFF_TIE, 3).alias("score"))
        parts.append(scored.select("l_returnflag", F.lit(delta).alias("delta"), "score"))
    return parts[0].union(parts[1])


@query("pca_low_rank", """
    SELECT round(var_samp(l_quantity) * 5, 4) AS first, 0.0::DOUBLE AS second FROM lineitem""")
def pca_low_rank(spark, folder):
    """Vectors along one line: the second direction exists, and nothing varies along it."""
    df = table(spark, folder, "lineitem").select(vectors.vector_of("l_quantity", F.col("l_quantity") * 2).alias("features"))
    projected = pca.PCATable(num_components=2, feature_dim=2, algorithm_mode="stable").fit(df).transform(df)
    spots = projected.select(vectors.to_array("projection").alias("p"))
    return spots.agg(F.round(F.var_samp(F.col("p")[0]), 4).alias("first"), F.abs(F.round(F.var_samp(F.col("p")[1]), 6)).alias("second"))


SHARES = """
    SELECT l_returnflag, k::INTEGER AS position, round(count(*) FILTER (l_linenumber % 3 = k) / count(*) + 0.00001234, 4) AS score
    FROM lineitem, (SELECT unnest(range(5)) AS k) GROUP BY ALL"""


@query("absent_classes", SHARES)
def absent_classes(spark, folder):
    """Five classes declared, three in the rows: five scores, zero for those absent."""
    df = one_hot(table(spark, folder, "lineitem").withColumn("label", (F.col("l_linenumber") % 3).cast("double")), "l_returnflag", ("label",))
    trainer = linear.MulticlassClassifierTable(feature_dim=3, num_classes=5, epochs=200, early_stopping_tolerance=1e-12)
    scored = trainer.fit(df).transform(df).select("l_returnflag", F.posexplode(vectors.to_array("score")).alias("position", "score"))
    return scored.groupBy("l_returnflag", "position").agg(F.round(F.avg("score") + OFF_TIE, 4).alias("score"))


@query("absent_boosted_classes", """
    SELECT vec_id, 5 AS n_scores, 0.0::DOUBLE AS absent FROM embeddings""")
def absent_boosted_classes(spark, folder):
    """Five classes declared, three in the rows: the two others score zero."""
    df = table(spark, folder, "embeddings").select("vec_id", vectors.from_array("embedding").alias("features"), (F.col("label") % 3).cast("double").alias("label"))
    trainer = boosted.BoostedTable(num_round=1, max_depth=1, objective="multi:softprob", num_class=5, feature_dim=64, grower="ml")
    shares = vectors.to_array("prediction")
    return trainer.fit(df).transform(df).select("vec_id", F.size(shares).alias("n_scores"), (shares[3] + shares[4]).alias("absent"))


def newton_sql(value: str, slope: str, curve: str, rounds: int = 4) -> str:
    """Group means of each round's -slope / curvature, added up from 0."""
    steps = [f"f0 AS (SELECT c_mktsegment, {value}::DOUBLE AS y, 0.0::DOUBLE AS f FROM customer JOIN (SELECT o_custkey, count(*) AS n, "
             "sum(o_totalprice) / 100000 AS amount FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey)"]
    for k in range(rounds):
        steps.append(f"f{k + 1} AS (SELECT c_mktsegment, y, f - sum({slope}) OVER w / sum({curve}) OVER w AS f FROM f{k} WINDOW w AS (PARTITION BY c_mktsegment))")
    return f"WITH {', '.join(steps)} SELECT c_mktsegment, round(avg(exp(f)) + 0.00001234, 4) AS prediction FROM f{rounds} GROUP BY c_mktsegment"


def newton_trees(objective: str, label: str):
    def run(spark, folder):
        df = spending(spark, folder)
        trainer = boosted.BoostedTable(num_round=4, objective=objective, labelCol=label, eta=1.0, min_child_weight=0.0, max_delta_step=0.0, base_score=1.0,
                                       **{"lambda": 0.0})
        return trainer.fit(df).transform(df).groupBy("c_mktsegment").agg(F.round(F.avg("prediction") + OFF_TIE, 4).alias("prediction"))

    return run


for _name, _objective, _label, _slope, _curve in (
        ("trees_poisson", "count:poisson", "n", "exp(f) - y", "exp(f)"),
        ("trees_gamma", "reg:gamma", "amount", "1 - y / exp(f)", "y / exp(f)"),
        ("trees_tweedie", "reg:tweedie", "amount", "exp(0.5 * f) - y * exp(-0.5 * f)", "0.5 * exp(0.5 * f) + 0.5 * y * exp(-0.5 * f)")):
    query(_name, newton_sql(_label, _slope, _curve))(newton_trees(_objective, _label))


@query("trees_rank", "SELECT doc_id, (quality + toxic)::DOUBLE AS label, dense_rank() OVER (ORDER BY quality + toxic) AS place FROM labels")
def trees_rank(spark, folder):
    """Trees of pairwise slopes on a feature that holds the grade: a place for every grade, in order."""
    df = table(spark, folder, "labels").withColumn("label", (F.col("toxic") + F.col("quality")).cast("double")).select(
        "doc_id", "label", F.lit("all").alias("query"), vectors.vector_of("label").alias("features"))
    trainer = boosted.BoostedTable(num_round=3, objective="rank:pairwise", queryCol="query", keyCol="doc_id")
    scored = trainer.fit(df).transform(df)
    places = scored.groupBy("prediction").agg(F.max("label").alias("top")).withColumn("place", F.dense_rank().over(Window.orderBy("prediction")))
    return scored.join(places, "prediction").select("doc_id", "label", F.col("place").cast("bigint").alias("place"))


@query("linear_evaluate", """
    WITH counts AS (SELECT l_returnflag, l_linenumber % 3 AS k, count(*) AS n FROM lineitem GROUP BY ALL),
    shares AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY n DESC) AS place FROM counts)
    SELECT round(sum(n) FILTER (place = 1) / sum(n), 6) AS accuracy, round(sum(n) FILTER (place <= 2) / sum(n), 6) AS accuracy_top_k FROM shares""")
def linear_evaluate(spark, folder):
    """What a classifier reports of itself: its accuracy, and that of its two best classes."""
    df = one_hot(table(spark, folder, "lineitem").withColumn("label", (F.col("l_linenumber") % 3).cast("double")), "l_returnflag", ("label",))
    trainer = linear.MulticlassClassifierTable(feature_dim=3, num_classes=3, accuracy_top_k=2, epochs=200, early_stopping_tolerance=1e-12)
    found = trainer.evaluate(trainer.fit(df), df)
    return df.agg(F.round(F.lit(found["accuracy"]), 6).alias("accuracy"), F.round(F.lit(found["accuracy_top_k"]), 6).alias("accuracy_top_k"))


@query("one_class_auc", "SELECT NULL::DOUBLE AS auc, count(*) FILTER (event_id IS NULL) AS fp FROM events")
def one_class_auc(spark, folder):
    """Only positives, some without a score: no area, and no false positive at any threshold."""
    df = table(spark, folder, "events").select(
        F.lit(1.0).alias("label"), F.when(F.col("event_id") % 10 != 0, F.col("value")).alias("score"))
    worst = curves.threshold_sweep(df).agg(F.max("fp").cast("bigint").alias("fp"))
    return curves.auc(df).withColumn("fp", F.lit(worst.first()["fp"]))


@query("threshold_agrees", """
    WITH scored AS (SELECT event_type = 'click' OR event_type = 'view' AS label, floor(value / 10) / 10 AS score FROM events),
    cuts AS (SELECT DISTINCT score AS t FROM scored),
    rates AS (SELECT t, avg(CASE WHEN (score >= t) = label THEN 1.0 ELSE 0.0 END) AS accuracy FROM scored, cuts GROUP BY t)
    SELECT t AS threshold, round(accuracy, 6) AS accuracy FROM rates ORDER BY rates.accuracy DESC, t DESC LIMIT 1""")
def threshold_agrees(spark, folder):
    """The accuracy of decisions at the chosen threshold, which is the one that the sweep promised."""
    df = table(spark, folder, "events").select(
        F.col("event_type").isin("click", "view").cast("double").alias("label"), (F.floor(F.col("value") / 10) / 10).alias("score"))
    threshold = curves.best_threshold(curves.threshold_sweep(df)).first()["threshold"]
    return metrics.binary_metrics(df, threshold=threshold).select(F.lit(threshold).alias("threshold"), F.round("accuracy", 6).alias("accuracy"))


@query("object_uris", f"""
    SELECT {KEYED}, 'flag_' || lower(l_returnflag) AS bucket, 'part ' || l_partkey || '+' || l_linenumber AS key FROM lineitem""")
def object_uris(spark, folder):
    """Buckets with underscores, keys with encoded blanks and plus signs."""
    uri = F.concat(F.lit("s3://flag_"), F.lower("l_returnflag"), F.lit("/part%20"), F.col("l_partkey").cast("string"), F.lit("+"),
                   F.col("l_linenumber").cast("string"))
    names = KEYED.split(", ")
    split = table(spark, folder, "lineitem").select(*names, keys.split_object_uri(uri).alias("parts"))
    return split.select(*names, "parts.bucket", "parts.key")


@query("libsvm_signs", f"""
    SELECT {KEYED}, l_quantity::DOUBLE AS label, l_tax::DOUBLE AS second FROM lineitem""")
def libsvm_signs(spark, folder):
    """Lines whose label, indices and values carry plus signs."""
    names = KEYED.split(", ")
    line = F.concat(F.lit("+"), F.col("l_quantity").cast("double").cast("string"), F.lit(" +2:+"), F.col("l_tax").cast("double").cast("string"))
    parsed = text.parse_libsvm(table(spark, folder, "lineitem").select(*names, line.alias("value")), 3, mode="PERMISSIVE")
    return parsed.select(*names, "label", vectors.to_array("features")[1].alias("second"))


@query("recordio_words", """
    WITH words AS (SELECT doc_id, least(length(w), 99) AS position FROM (
        SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w FROM documents))
    SELECT doc_id::VARCHAR AS doc_id, position - 1 AS position, count(*)::DOUBLE AS n FROM words GROUP BY ALL""")
def recordio_words(spark, folder):
    """Sparse rows of different lengths through files: how many words of each length a document has."""
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0))
    lengths = table(spark, folder, "documents").select("doc_id", F.explode(words).alias("w")).select(
        "doc_id", (F.least(F.length("w"), F.lit(99)) - 1).alias("position"))
    entries = lengths.groupBy("doc_id", "position").agg(F.count(F.lit(1)).cast("double").alias("n"))
    rows = entries.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("position", "n"))).alias("e")).select(
        F.col("doc_id").cast("string").alias("doc_id"), vectors.from_struct(F.lit(99), F.col("e.position"), F.col("e.n")).alias("features"))
    raw = F.unwrap_udt("features")
    back = through_files(rows, "words", uidColumnName="doc_id")
    return back.select("doc_id", F.inline(F.arrays_zip(raw["indices"].alias("position"), raw["values"].alias("n"))))
