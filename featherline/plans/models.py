"""Queries that train models, score tables and find models again."""

from __future__ import annotations


import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import HashingTF, OneHotEncoder, RegexTokenizer, StringIndexer
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window, functions as F

from featherline.algorithms import base, boosted, custom, factorization, kmeans, lda, linear, pca, runs
from featherline.algorithms.selection import select_model
from featherline.functions import vectors
from featherline.operators import codecs, losses, metrics, tables
from featherline.plans.encoding import KEYED
from featherline.plans.quality import rounded
from featherline.plans.registry import query, table
from featherline.sources import export
from featherline.workspace import new_path, written


# Keeps shares of small groups off the halfway points of rounding.
OFF_TIE = 0.00001234


def embedded(spark, folder) -> DataFrame:
    return table(spark, folder, "embeddings").select("vec_id", "label", vectors.from_array("embedding").alias("features"))


def mean_centers(df: DataFrame) -> np.ndarray:
    """One center per label, in label order: as many rows as there are labels."""
    rows = kmeans.label_means(df, "label").orderBy("cluster").collect()
    return np.array([row["center"].toArray() for row in rows])


ENTRIES = """
    entries AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
    centers AS (SELECT label AS cluster, i, avg(v) AS c FROM entries GROUP BY label, i)"""
NEAREST = """
    distances AS (SELECT e.vec_id, c.cluster, sqrt(sum((e.v - c.c) ^ 2)) AS d
        FROM entries e JOIN centers c ON e.i = c.i GROUP BY e.vec_id, c.cluster),
    nearest AS (SELECT vec_id, cluster, d FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) AS rn
        FROM distances) WHERE rn = 1)"""


@query("kmeans_score", f"""WITH {ENTRIES}, {NEAREST}
    SELECT e.vec_id, e.label, round(n.d, 6) AS distance_to_cluster, n.cluster::DOUBLE AS closest_cluster
    FROM embeddings e JOIN nearest n ON e.vec_id = n.vec_id""")
def kmeans_score(spark, folder):
    """Closest label mean and distance for every embedding."""
    df = embedded(spark, folder)
    scored = kmeans.KMeansTableModel.of(mean_centers(df)).transform(df)
    return scored.select("vec_id", "label", F.round("distance_to_cluster", 6).alias("distance_to_cluster"), "closest_cluster")


@query("predictions_only", f"""WITH {ENTRIES}, {NEAREST}
    SELECT round(d, 6) AS distance_to_cluster, cluster::DOUBLE AS closest_cluster FROM nearest""")
def predictions_only(spark, folder):
    df = embedded(spark, folder)
    model = kmeans.KMeansTableModel.of(mean_centers(df))
    model._set(keepInput=False)
    return rounded(model.transform(df))


@query("kmeans_lloyd_step", f"""WITH {ENTRIES}, {NEAREST}
    SELECT n.cluster::DOUBLE AS cluster, count(DISTINCT e.vec_id) AS n, (e.i - 1)::INTEGER AS position, round(avg(e.v), 6) AS center
    FROM entries e JOIN nearest n ON e.vec_id = n.vec_id GROUP BY n.cluster, e.i""")
def kmeans_lloyd_step(spark, folder):
    df = embedded(spark, folder)
    moved = kmeans.lloyd_step(df, mean_centers(df))
    return moved.select("cluster", "n", F.posexplode(vectors.to_array("center")).alias("position", "center")).withColumn(
        "center", F.round("center", 6))


@query("kmeans_loss", f"""WITH {ENTRIES}, {NEAREST}
    SELECT round(avg(d * d), 6) AS msd, round(sum(d * d), 5) AS ssd FROM nearest""")
def kmeans_loss(spark, folder):
    df = embedded(spark, folder)
    loss = metrics.clustering_loss(kmeans.KMeansTableModel.of(mean_centers(df)).transform(df))
    return loss.select(F.round("msd", 6).alias("msd"), F.round("ssd", 5).alias("ssd"))


def flagged(spark, folder) -> DataFrame:
    """Lines in three places far apart, one for each flag, spread by their quantity."""
    far = F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 10000.0).otherwise(20000.0)
    return table(spark, folder, "lineitem").select("l_returnflag", vectors.vector_of(far + F.col("l_quantity"), F.col("l_tax")).alias("features"))


FLAGGED = """
    SELECT l_returnflag, round(avg(sqrt((l_quantity - q) ^ 2 + (l_tax - t) ^ 2)), 6) AS distance, 1::BIGINT AS n_clusters FROM (
        SELECT l_returnflag, l_quantity, l_tax, avg(l_quantity) OVER (PARTITION BY l_returnflag) AS q,
            avg(l_tax) OVER (PARTITION BY l_returnflag) AS t FROM lineitem) GROUP BY l_returnflag"""


def clustered(df: DataFrame, trainer) -> DataFrame:
    """Mean distance from the trained centers, and how many of them a flag's lines went to."""
    return trainer.fit(df).transform(df).groupBy("l_returnflag").agg(
        F.round(F.avg("distance_to_cluster"), 6).alias("distance"), F.countDistinct("closest_cluster").alias("n_clusters"))


@query("kmeans_fit", FLAGGED)
def kmeans_fit(spark, folder):
    """Three clusters far apart: the trained centers are the flags' means, whatever the start."""
    return clustered(flagged(spark, folder), kmeans.KMeansTable(
        k=3, feature_dim=2, init_method="kmeans++", local_lloyd_num_trials=3, local_lloyd_tol=0.0))


@query("kmeans_surplus", FLAGGED)
def kmeans_surplus(spark, folder):
    """More centers first, then clusters of those by weight: the same means, up to rounding."""
    return clustered(flagged(spark, folder), kmeans.KMeansTable(
        k=3, feature_dim=2, init_method="kmeans++", extra_center_factor=4, epochs=20, local_lloyd_num_trials=8, local_lloyd_tol=0.0))


def two_columns(spark, folder) -> DataFrame:
    """Quantity and price in units of their deviation, the price twice as wide."""
    lineitem = table(spark, folder, "lineitem")
    q, p = lineitem.agg(F.stddev_samp("l_quantity"), F.stddev_samp("l_extendedprice")).first()
    return lineitem.select(*KEYED.split(", "), vectors.vector_of(
        F.col("l_quantity") / q, 2 * F.col("l_extendedprice") / p).alias("features"))


PCA_SQL = f"""
    WITH x AS (SELECT {KEYED}, l_quantity / (SELECT stddev_samp(l_quantity) FROM lineitem) AS a,
        2 * l_extendedprice / (SELECT stddev_samp(l_extendedprice) FROM lineitem) AS b FROM lineitem),
    m AS (SELECT avg(a) AS ma, avg(b) AS mb, var_samp(a) AS va, var_samp(b) AS vb, covar_samp(a, b) AS cab FROM x),
    e AS (SELECT *, (va + vb) / 2 + sqrt(((va - vb) / 2) ^ 2 + cab ^ 2) AS l1 FROM m),
    d AS (SELECT *, cab / sqrt(cab ^ 2 + (l1 - va) ^ 2) AS u1, (l1 - va) / sqrt(cab ^ 2 + (l1 - va) ^ 2) AS u2 FROM e)
    SELECT {KEYED}, round((a - ma) * u1 + (b - mb) * u2, 4) + 0 AS p1, round((a - ma) * u2 - (b - mb) * u1, 4) + 0 AS p2 FROM x, d"""


def pca_2d(mode):
    def run(spark, folder):
        df = two_columns(spark, folder)
        model = pca.PCATable(num_components=2, feature_dim=2, algorithm_mode=mode).fit(df)
        p = vectors.to_array("projection")
        return model.transform(df).select(
            *KEYED.split(", "), (F.round(p[0], 4) + 0).alias("p1"), (F.round(p[1], 4) + 0).alias("p2"))

    return run


for _mode, _name in (("regular", "pca_2d"), ("stable", "pca_stable"), ("randomized", "pca_randomized")):
    query(_name, PCA_SQL)(pca_2d(_mode))


@query("pca_variance", """
    SELECT round(sum(v), 6) AS total_variance FROM (SELECT var_samp(x) AS v FROM (
        SELECT generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY i)""")
def pca_variance(spark, folder):
    df = embedded(spark, folder)
    projected = pca.PCATable(num_components=64, feature_dim=64).fit(df).transform(df)
    spread = projected.select(F.posexplode(vectors.to_array("projection")).alias("i", "x"))
    return spread.groupBy("i").agg(F.var_samp("x").alias("v")).agg(F.round(F.sum("v"), 6).alias("total_variance"))


#: Columns that words are hashed into.
WORD_COLUMNS = 1 << 14


@query("lda_mix", """
    SELECT doc_id, CASE WHEN regexp_matches(text, '[A-Za-z0-9_]') THEN 1.0 ELSE 0.0 END::DOUBLE AS total, 4 AS n_topics FROM documents""")
def lda_mix(spark, folder):
    """Mixtures of four topics over hashed words, fitted with the trainer's default starts and steps."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    words = RegexTokenizer(inputCol="text", outputCol="words", pattern=r"\W+").transform(docs)
    counted = HashingTF(inputCol="words", outputCol="features", numFeatures=WORD_COLUMNS).transform(words).select("doc_id", "features")
    counted = written(counted, "counted")
    trainer = lda.LDATable(num_topics=4, feature_dim=WORD_COLUMNS, mini_batch_size=5000)
    mixture = vectors.to_array("topic_mixture")
    total = F.aggregate(mixture, F.lit(0.0), lambda acc, x: acc + x)
    # A document without a word has no mixture.
    return trainer.fit(counted).transform(counted).select("doc_id", F.round(total, 6).alias("total"), F.size(mixture).alias("n_topics"))


@query("lda_planted", """
    WITH digests AS (SELECT l_partkey, md5(l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':' || l_suppkey) AS d FROM lineitem),
    words AS (SELECT CASE WHEN substr(d, 1, 1) < 'd' THEN l_partkey % 3 ELSE ('0x' || substr(d, 2, 4))::BIGINT % 3 END AS topic,
        least(('0x' || substr(d, 6, 4))::BIGINT % 14, 9) AS word FROM digests)
    SELECT topic, word::BIGINT AS word, true AS near FROM words GROUP BY topic, word""")
def lda_planted(spark, folder):
    """Parts whose lines are words, mostly of the part's own topic: each topic's word shares come back within 0.05."""
    digest = F.md5(F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))

    def number(at: int) -> Column:
        return F.conv(F.substring(digest, at, 4), 16, 10).cast("long")

    lines = table(spark, folder, "lineitem").select(
        "l_partkey", F.when(F.substring(digest, 1, 1) < "d", F.col("l_partkey") % 3).otherwise(number(2) % 3).alias("topic"),
        F.least(number(6) % 14, F.lit(9)).alias("word"))
    counts = lines.groupBy("l_partkey", (F.col("topic") * 10 + F.col("word")).cast("int").alias("place")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    held = F.sort_array(F.collect_list(F.struct("place", "n")))
    df = counts.groupBy("l_partkey").agg(held.alias("held")).select(
        "l_partkey", vectors.from_struct(F.lit(30), F.col("held.place"), F.col("held.n")).alias("features"))
    found = lda.LDATable(num_topics=3, feature_dim=30, mini_batch_size=1000, alpha0=0.5).fit(df).arrays["topics"]
    # A topic is known by the words it has most of.
    of = {int(t.reshape(3, 10).sum(axis=1).argmax()): t.reshape(3, 10)[int(t.reshape(3, 10).sum(axis=1).argmax())] for t in found}
    guess = spark.createDataFrame([(t, w, float(x)) for t, row in of.items() for w, x in enumerate(row)], "topic long, word long, guess double")
    true = lines.groupBy("topic", "word").agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("topic"))
    shares = true.select("topic", "word", share.alias("share")).join(guess, ["topic", "word"], "left")
    return shares.select("topic", "word", F.coalesce(F.abs(F.col("share") - F.col("guess")) < 0.05, F.lit(False)).alias("near"))


@query("linreg_fit", """
    SELECT round(regr_slope(l_extendedprice / 1000, l_quantity), 6) AS slope,
        round(regr_intercept(l_extendedprice / 1000, l_quantity), 5) AS intercept FROM lineitem""")
def linreg_fit(spark, folder):
    df = table(spark, folder, "lineitem").select(
        vectors.vector_of("l_quantity").alias("features"), (F.col("l_extendedprice") / 1000).alias("label"))
    fitted = linear.RegressorTable(feature_dim=1, early_stopping_tolerance=1e-12).fit(df).stages["linear"]
    slope, intercept = float(fitted.coefficients[0]), float(fitted.intercept)
    # The rows scored at 0 and 1 give the line; the coefficients are the whole result.
    return df.agg(F.round(F.lit(slope), 6).alias("slope"), F.round(F.lit(intercept), 5).alias("intercept"))


@query("linreg_scaled", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(i + s * l_quantity, 4) AS score FROM lineitem, (
        SELECT regr_slope(l_extendedprice / 1000, l_quantity) AS s, regr_intercept(l_extendedprice / 1000, l_quantity) AS i
        FROM lineitem)""")
def linreg_scaled(spark, folder):
    """Centered and scaled features and label, undone in the score."""
    df = table(spark, folder, "lineitem").select(
        *KEYED.split(", "), vectors.vector_of("l_quantity").alias("features"), (F.col("l_extendedprice") / 1000).alias("label"))
    trainer = linear.RegressorTable(feature_dim=1, unbias_data=True, normalize_label=True, unbias_label=True,
                                    early_stopping_tolerance=1e-12)
    return trainer.fit(df).transform(df).select(*KEYED.split(", "), F.round("score", 4).alias("score"))


def one_hot(df: DataFrame, column: str, keep: tuple[str, ...] = ()) -> DataFrame:
    indexed = StringIndexer(inputCol=column, outputCol="_index", stringOrderType="alphabetAsc").fit(df).transform(df)
    return OneHotEncoder(inputCol="_index", outputCol="features", dropLast=False).fit(indexed).transform(indexed).select(
        column, "features", *keep)


@query("quantile_fit", """
    SELECT loss, l_returnflag, true AS close FROM (SELECT DISTINCT l_returnflag FROM lineitem),
        (SELECT unnest(['quantile_loss', 'absolute_loss']) AS loss)""")
def quantile_fit(spark, folder):
    """Robust fits on a one-hot flag come close to each flag's own quantile."""
    df = one_hot(table(spark, folder, "lineitem").withColumn("label", F.col("l_extendedprice") / 1000), "l_returnflag", ("label",))
    parts = []
    for loss, level in (("quantile_loss", 0.8), ("absolute_loss", 0.5)):
        trainer = linear.RegressorTable(feature_dim=3, loss=loss, quantile=level, use_bias=False)
        scored = trainer.fit(df).transform(df).groupBy("l_returnflag").agg(
            F.avg("score").alias("score"), F.percentile("label", level).alias("exact"))
        parts.append(scored.select(F.lit(loss).alias("loss"), "l_returnflag",
                                   (F.abs(F.col("score") - F.col("exact")) < 0.02 * F.col("exact")).alias("close")))
    return parts[0].union(parts[1])


@query("robust_fit", """
    SELECT loss, count(*) AS n_rows, true AS no_worse FROM lineitem,
        (SELECT unnest(['eps_insensitive_absolute_loss', 'eps_insensitive_squared_loss', 'huber_loss']) AS loss) GROUP BY loss""")
def robust_fit(spark, folder):
    """Each robust fit is no worse in its own loss than least squares, within a hundredth."""
    df = table(spark, folder, "lineitem").select(
        vectors.vector_of("l_quantity", "l_discount").alias("features"), (F.col("l_extendedprice") / 1000).alias("label"))
    plain = linear.RegressorTable(feature_dim=2).fit(df)
    own = {
        "eps_insensitive_absolute_loss": lambda y, s: losses.insensitive_absolute(y, s, 5.0),
        "eps_insensitive_squared_loss": lambda y, s: losses.insensitive_squared(y, s, 5.0),
        "huber_loss": lambda y, s: losses.huber(y, s, 1.35),
    }
    result = None
    for loss, cost in own.items():
        trainer = linear.RegressorTable(feature_dim=2, loss=loss, loss_insensitivity=5.0, huber_delta=1.35)
        scored = trainer.fit(df).transform(df).withColumnRenamed("score", "own")
        both = plain.transform(scored)
        part = both.agg(
            F.count(F.lit(1)).alias("n_rows"),
            (F.avg(cost(F.col("label"), F.col("own"))) <= 1.01 * F.avg(cost(F.col("label"), F.col("score")))).alias("no_worse"),
        ).select(F.lit(loss).alias("loss"), "n_rows", "no_worse")
        result = part if result is None else result.union(part)
    return result


@query("logit_onehot", """
    SELECT o_orderpriority, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) + 0.00001234, 4) AS score FROM orders
    GROUP BY o_orderpriority""")
def logit_onehot(spark, folder):
    """Logistic regression on a one-hot column reproduces each group's share."""
    df = one_hot(table(spark, folder, "orders").withColumn("label", (F.col("o_orderstatus") == "F").cast("double")),
                 "o_orderpriority", ("label",))
    trainer = linear.BinaryClassifierTable(feature_dim=5, epochs=200, early_stopping_tolerance=1e-12)
    return trainer.fit(df).transform(df).groupBy("o_orderpriority").agg(F.round(F.avg("score") + OFF_TIE, 4).alias("score"))


@query("binary_threshold", """
    WITH groups AS (SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS hits, count(*) AS n FROM orders GROUP BY ALL),
    cuts AS (SELECT o_orderpriority, hits / n AS share, sum(hits) OVER w AS tp, sum(n) OVER w AS chosen, (SELECT sum(hits) FROM groups) AS positives
        FROM groups WINDOW w AS (ORDER BY hits / n DESC)),
    best AS (SELECT share FROM cuts WHERE tp / positives >= 0.6 ORDER BY tp / chosen DESC, share DESC LIMIT 1)
    SELECT o_orderpriority, (share >= (SELECT share FROM best))::INTEGER::DOUBLE AS predicted_label FROM cuts""")
def binary_threshold(spark, folder):
    """A classifier whose threshold keeps a wanted recall at the best precision."""
    df = one_hot(table(spark, folder, "orders").withColumn("label", (F.col("o_orderstatus") == "F").cast("double")),
                 "o_orderpriority", ("label",))
    trainer = linear.BinaryClassifierTable(
        feature_dim=5, epochs=200, binary_classifier_model_selection_criteria="precision_at_target_recall",
        target_recall=0.6, positive_example_weight_mult="balanced", early_stopping_tolerance=1e-12)
    return trainer.fit(df).transform(df).groupBy("o_orderpriority").agg(F.avg("predicted_label").alias("predicted_label"))


@query("softmax_onehot", """
    SELECT hour, position::INTEGER AS position, round(share + 0.00001234, 4) AS score FROM (
        SELECT hour, count(*) AS n FROM (SELECT hour(ts)::VARCHAR AS hour FROM events) GROUP BY hour) h,
        LATERAL (SELECT position, count(*) FILTER (e.event_type = kind) / h.n AS share
            FROM (SELECT hour(ts)::VARCHAR AS hour2, event_type FROM events) e,
                (SELECT unnest(range(5)) AS position, unnest(['click', 'error', 'purchase', 'signup', 'view']) AS kind)
            WHERE e.hour2 = h.hour GROUP BY position)""")
def softmax_onehot(spark, folder):
    """Multinomial regression on a one-hot hour reproduces each hour's class shares."""
    kinds = F.array(*[F.lit(k) for k in ("click", "error", "purchase", "signup", "view")])
    events = table(spark, folder, "events").select(
        F.hour("ts").cast("string").alias("hour"), (F.array_position(kinds, F.col("event_type")) - 1).cast("double").alias("label"))
    df = one_hot(events, "hour", ("label",))
    trainer = linear.MulticlassClassifierTable(feature_dim=24, num_classes=5, epochs=300, early_stopping_tolerance=1e-12)
    scored = trainer.fit(df).transform(df).select("hour", F.posexplode(vectors.to_array("score")).alias("position", "score"))
    return scored.groupBy("hour", "position").agg(F.round(F.avg("score") + OFF_TIE, 4).alias("score"))


@query("gbt_onehot", """
    SELECT l_returnflag, round(avg(l_extendedprice), 4) AS prediction FROM lineitem GROUP BY l_returnflag""")
def gbt_onehot(spark, folder):
    """One round of regression trees on a one-hot flag gives each flag's mean."""
    df = one_hot(table(spark, folder, "lineitem").withColumn("label", F.col("l_extendedprice")), "l_returnflag", ("label",))
    scored = boosted.BoostedTable(num_round=1, feature_dim=3, grower="ml").fit(df).transform(df)
    return scored.groupBy("l_returnflag").agg(F.round(F.avg("prediction"), 4).alias("prediction"))


@query("gbt_binary", """
    SELECT l_returnflag, round(1 / (1 + exp(-2 * (2 * w / (w + n) - 1))) + 0.00001234, 4) AS prediction FROM (
        SELECT l_returnflag, 3.0 * count(*) FILTER (l_linestatus = 'O' OR l_linenumber < 3) AS w,
            count(*) FILTER (NOT (l_linestatus = 'O' OR l_linenumber < 3)) AS n FROM lineitem GROUP BY l_returnflag)""")
def gbt_binary(spark, folder):
    """One round of trees on a one-hot flag: each flag's weighted margin, through the logistic function."""
    label = ((F.col("l_linestatus") == "O") | (F.col("l_linenumber") < 3)).cast("double")
    df = one_hot(table(spark, folder, "lineitem").withColumn("label", label), "l_returnflag", ("label",))
    trainer = boosted.BoostedTable(num_round=1, objective="binary:logistic", scale_pos_weight=3.0, feature_dim=3, grower="ml")
    return trainer.fit(df).transform(df).groupBy("l_returnflag").agg(F.round(F.avg("prediction") + OFF_TIE, 4).alias("prediction"))


@query("boosted_classes", """
    WITH shares AS (SELECT l_returnflag, k, count(*) FILTER (l_linenumber % 3 = k) / count(*) AS p
        FROM lineitem, (SELECT unnest(range(3)) AS k) GROUP BY ALL),
    own AS (SELECT l_returnflag, k, 1 / (1 + exp(-2 * (2 * p - 1))) AS p FROM shares)
    SELECT l_returnflag, k::INTEGER AS position, round(p / sum(p) OVER (PARTITION BY l_returnflag) + 0.00001234, 4) AS prediction FROM own""")
def boosted_classes(spark, folder):
    """One round for each of three classes against the rest, scaled to shares."""
    df = one_hot(table(spark, folder, "lineitem").withColumn("label", (F.col("l_linenumber") % 3).cast("double")), "l_returnflag", ("label",))
    trainer = boosted.BoostedTable(num_round=1, objective="multi:softprob", num_class=3, feature_dim=3, grower="ml")
    scored = trainer.fit(df).transform(df).select("l_returnflag", F.posexplode(vectors.to_array("prediction")).alias("position", "prediction"))
    return scored.groupBy("l_returnflag", "position").agg(F.round(F.avg("prediction") + OFF_TIE, 4).alias("prediction"))


def spending(spark, folder) -> DataFrame:
    """Orders and amount per customer, with the segment one-hot."""
    per_customer = table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("o_totalprice").alias("amount"))
    joined = table(spark, folder, "customer").join(per_customer, F.col("c_custkey") == F.col("o_custkey"))
    return one_hot(joined.select("c_mktsegment", "n", (F.col("amount") / 100000).alias("amount")), "c_mktsegment", ("n", "amount"))


SPENDING = """
    SELECT c_mktsegment, round(avg({value}) + 0.00001234, 4) AS prediction FROM customer JOIN (
        SELECT o_custkey, count(*) AS n, sum(o_totalprice) / 100000 AS amount FROM orders GROUP BY o_custkey)
    ON c_custkey = o_custkey GROUP BY c_mktsegment"""


def glm(objective, label):
    def run(spark, folder):
        df = spending(spark, folder)
        trainer = boosted.BoostedTable(num_round=100, objective=objective, labelCol=label, booster="gblinear")
        return trainer.fit(df).transform(df).groupBy("c_mktsegment").agg(F.round(F.avg("prediction") + OFF_TIE, 4).alias("prediction"))

    return run


for _objective, _label, _name in (("count:poisson", "n", "glm_poisson"), ("reg:gamma", "amount", "glm_gamma"),
                                  ("reg:tweedie", "amount", "glm_tweedie")):
    query(_name, SPENDING.format(value=_label))(glm(_objective, _label))


@query("boosted_linear", """
    SELECT l_returnflag, round(avg(l_extendedprice / 1000), 4) AS prediction FROM lineitem GROUP BY l_returnflag""")
def boosted_linear(spark, folder):
    df = one_hot(table(spark, folder, "lineitem").withColumn("label", F.col("l_extendedprice") / 1000), "l_returnflag", ("label",))
    scored = boosted.BoostedTable(num_round=50, booster="gblinear").fit(df).transform(df)
    return scored.groupBy("l_returnflag").agg(F.round(F.avg("prediction"), 4).alias("prediction"))


@query("rank_fit", "SELECT doc_id, label, (toxic + quality)::DOUBLE AS grade FROM (SELECT doc_id, quality, toxic, (toxic + quality)::DOUBLE AS label FROM labels)")
def rank_fit(spark, folder):
    """A pairwise ranker of a feature that holds the grade: its scores order as the grades do."""
    df = table(spark, folder, "labels").withColumn("label", (F.col("toxic") + F.col("quality")).cast("double")).select(
        "doc_id", "label", F.lit("all").alias("query"), vectors.vector_of("label", (F.col("doc_id") % 2).cast("double")).alias("features"))
    trainer = boosted.BoostedTable(
        num_round=100, objective="rank:pairwise", booster="gblinear", queryCol="query", keyCol="doc_id", **{"lambda": 0.001})
    scored = trainer.fit(df).transform(df)
    # The steps between grades are equal, so scores are grades on another scale.
    low, high = scored.agg(F.min("prediction"), F.max("prediction")).first()
    top = scored.agg(F.max("label")).first()[0]
    return scored.select("doc_id", "label", F.round((F.col("prediction") - low) / F.lit((high - low) / top)).alias("grade"))


@query("auto_weight", """
    WITH rows AS (SELECT l_returnflag, (l_linenumber = 1)::INTEGER AS y FROM lineitem),
    shares AS (SELECT l_returnflag, avg(y) AS p, (SELECT avg(1 - y) / avg(y) FROM rows) AS w FROM rows GROUP BY l_returnflag),
    scores AS (SELECT l_returnflag, p, w * p / (w * p + 1 - p) AS s FROM shares)
    SELECT round(avg(-ln(CASE WHEN y = 1 THEN s ELSE 1 - s END)) + 0.00001234, 3) AS balanced, true AS auto_is_better, true AS auto_is_near_least
    FROM rows JOIN scores USING (l_returnflag)""")
def auto_weight(spark, folder):
    """Weights of positive rows by search: by its log loss, the balanced weight is worse than what the search finds, and that is near the least."""
    df = one_hot(table(spark, folder, "lineitem").withColumn("label", (F.col("l_linenumber") == 1).cast("double")), "l_returnflag", ("label",))
    found = {}
    for how in ("balanced", "auto", "1.0"):
        trainer = linear.BinaryClassifierTable(feature_dim=3, epochs=100, early_stopping_tolerance=1e-12, positive_example_weight_mult=how,
                                               binary_classifier_model_selection_criteria="cross_entropy_loss", normalize_data=False)
        scored = trainer.fit(df).transform(df)
        found[how] = scored.agg(F.avg(-F.log(F.when(F.col("label") == 1, F.col("score")).otherwise(1 - F.col("score"))))).first()[0]
    return df.agg(F.round(F.lit(found["balanced"]) + OFF_TIE, 3).alias("balanced"), F.lit(found["auto"] < found["balanced"]).alias("auto_is_better"),
                              F.lit(found["auto"] < found["1.0"] + 0.01).alias("auto_is_near_least"))


@query("fm_score", "SELECT event_id, 0.0::DOUBLE AS difference FROM events")
def fm_score(spark, folder):
    """A fitted machine's score against the sum over pairs under its own weights, worked out apart from it."""
    x = F.array(F.col("value") / 100, (F.col("user_id") % 10).cast("double") / 10, (F.col("event_id") % 7).cast("double") / 10)
    df = table(spark, folder, "events").select(
        "event_id", x.alias("x"), vectors.from_array(x).alias("features"), (F.col("value") * (F.col("user_id") % 10)).alias("label"))
    trainer = factorization.FactorizationRegressorTable(num_factors=2, feature_dim=3, epochs=10, linear_lr=0.1, factors_lr=0.1, factors_init_sigma=0.5)
    model = trainer.fit(df)
    linear_part, pairs = model.arrays["linear"].reshape(-1), model.arrays["factors"]
    own = F.lit(float(model.arrays["bias"][0, 0])) + sum(F.col("x")[i] * float(w) for i, w in enumerate(linear_part))
    for i in range(3):
        for j in range(i + 1, 3):
            own = own + F.col("x")[i] * F.col("x")[j] * float(pairs[i] @ pairs[j])
    return model.transform(df).select("event_id", F.abs(F.round(F.col("score") - own, 6)).alias("difference"))


def event_values(spark, folder) -> DataFrame:
    events = table(spark, folder, "events").withColumn("label", (F.col("value") > 60).cast("double"))
    return one_hot(events, "event_type", ("event_id", "label", "value"))


@query("fm_fit", "SELECT count(*) AS n_rows, true AS probabilities, true AS labels_match FROM events")
def fm_fit(spark, folder):
    df = event_values(spark, folder)
    trainer = factorization.FactorizationBinaryTable(num_factors=2, feature_dim=5, epochs=20, linear_lr=0.05, factors_lr=0.05)
    scored = trainer.fit(df).transform(df)
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"), ((F.min("score") >= 0) & (F.max("score") <= 1)).alias("probabilities"),
        F.bool_and((F.col("score") >= 0.5) == (F.col("predicted_label") == 1)).alias("labels_match"))


@query("fm_regress", "SELECT count(*) AS n_rows, 5::BIGINT AS n_scores FROM events")
def fm_regress(spark, folder):
    """A machine on a one-hot type gives one score per type."""
    df = event_values(spark, folder).drop("label").withColumnRenamed("value", "label")
    trainer = factorization.FactorizationRegressorTable(num_factors=2, feature_dim=5, epochs=30, linear_lr=0.5,
                                                        factors_lr=0.5, factors_init_sigma=0.1)
    scored = trainer.fit(df).transform(df)
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(F.round("score", 9)).alias("n_scores"))


@query("fm_planted", """
    SELECT count(*) FILTER (l_orderkey % 5 = 0) AS held_rows, true AS close, true AS beats_linear FROM lineitem""")
def fm_planted(spark, folder):
    """A product of two columns: on rows that were held out the machine misses less than a twentieth of the variance, a linear fit a fifth at least."""
    a, b = (F.col("l_quantity") - 25.5) / 15, (F.col("l_linenumber") - 4.0) / 2
    df = table(spark, folder, "lineitem").select(
        vectors.vector_of(a.alias("a"), b.alias("b"), (F.col("l_discount") * 20 - 1).alias("c")).alias("features"),
        (1.5 + a - 0.5 * b + 2 * a * b).alias("label"), (F.col("l_orderkey") % 5 == 0).alias("held"))
    trainer = factorization.FactorizationRegressorTable(
        num_factors=2, feature_dim=3, epochs=60, mini_batch_size=50, linear_lr=0.02, factors_lr=0.02, factors_init_sigma=0.3, bias_wd=0.0, linear_wd=0.0,
        factors_wd=0.0, validationCol="held", patience=5, tolerance=0.001)
    held = trainer.fit(df).transform(df).where("held")
    line = LinearRegression().fit(df.where("NOT held")).setPredictionCol("line").transform(held)
    miss, plain = F.col("score") - F.col("label"), F.col("line") - F.col("label")
    return line.agg(F.count(F.lit(1)).alias("held_rows"), (F.avg(miss * miss) < 0.05 * F.var_pop("label")).alias("close"),
                    (F.avg(plain * plain) > 0.2 * F.var_pop("label")).alias("beats_linear"))


@query("fm_patience", """
    SELECT count(*) AS n, true AS stopped, true AS least FROM events""")
def fm_patience(spark, folder):
    """Epochs that stop themselves on held-out rows: the chosen one is the last that gained, and patience ended the rest."""
    df = event_values(spark, folder).withColumn("held", F.col("event_id") % 4 == 0)
    trainer = factorization.FactorizationBinaryTable(num_factors=2, feature_dim=5, epochs=60, mini_batch_size=100, linear_lr=0.5, validationCol="held", patience=3, tolerance=0.01)
    facts = trainer.fit(df).facts
    losses, best = facts["losses"], facts["epoch"]
    curve = spark.createDataFrame([(k, float(x)) for k, x in enumerate(losses)], "epoch int, loss double")
    rated = curve.agg(F.max("epoch").alias("last"), F.min("loss").alias("low"), F.max(F.when(F.col("epoch") == best, F.col("loss"))).alias("chosen")).first()
    return df.agg(F.count(F.lit(1)).alias("n"), F.lit(rated.last == best + 3 and rated.last < 59).alias("stopped"),
                  F.lit(rated.chosen <= rated.low / 0.99).alias("least"))


@query("kmeans_minibatch", "SELECT count(*) AS n, true AS as_good FROM embeddings")
def kmeans_minibatch(spark, folder):
    """Ten clusters of whole embeddings by mini-batches with surplus centers: the cost is within 8 % of that of Lloyd's iterations over all rows."""
    df = embedded(spark, folder)
    costs = []
    for how in ({"extra_center_factor": 8, "epochs": 3, "mini_batch_size": 100}, {"extra_center_factor": 1}):
        trainer = kmeans.KMeansTable(k=10, feature_dim=64, init_method="kmeans++", local_lloyd_num_trials=4, seed=1, **how)
        distance = F.col("distance_to_cluster")
        costs.append(trainer.fit(df).transform(df).agg(F.sum(distance * distance)).first()[0])
    return df.agg(F.count(F.lit(1)).alias("n"), F.lit(costs[0] <= 1.08 * costs[1]).alias("as_good"))


@query("linear_patience", """
    SELECT count(*) AS n, true AS stopped, true AS near_least, true AS near_slope FROM lineitem""")
def linear_patience(spark, folder):
    """A line by epochs that stop themselves: the chosen epoch is the last that gained, three came after it, and its slope is near that of least squares."""
    label = 2 * F.col("l_quantity") + F.col("l_linenumber")
    df = table(spark, folder, "lineitem").select(vectors.vector_of("l_quantity").alias("features"), label.alias("label"))
    model = linear.RegressorTable(feature_dim=1, epochs=60, mini_batch_size=50, learning_rate=0.05, early_stopping_patience=3, early_stopping_tolerance=0.01,
                                  unbias_data=True, unbias_label=True, normalize_label=True).fit(df)
    losses, best = model.facts["losses"], model.facts["epoch"]
    ends = spark.createDataFrame([(0, Vectors.dense([0.0])), (1, Vectors.dense([1.0]))], ["at", "features"])
    slope = model.transform(ends).agg(F.sum(F.when(F.col("at") == 1, F.col("score")).otherwise(-F.col("score")))).first()[0]
    return df.agg(F.count(F.lit(1)).alias("n"), F.lit(len(losses) == best + 4 and len(losses) < 60).alias("stopped"),
                  F.lit(losses[best] <= min(losses) / 0.99).alias("near_least"),
                  (F.abs(F.lit(slope) - F.regr_slope("label", vectors.to_array("features")[0])) < 0.05).alias("near_slope"))


@query("limit_score", f"""WITH {ENTRIES}, {NEAREST}
    SELECT vec_id, cluster::DOUBLE AS closest_cluster FROM nearest ORDER BY vec_id LIMIT 25""")
def limit_score(spark, folder):
    """The first 25 rows by key, scored after the cut: the limit is the operator."""
    df = embedded(spark, folder)
    model = kmeans.KMeansTableModel.of(mean_centers(df))
    return model.transform(tables.first_rows(df, 25, "vec_id")).select("vec_id", "closest_cluster")


@query("pca_then_kmeans", "SELECT count(*) AS n_rows, 8 AS n_components, true AS same_after_loading FROM embeddings")
def pca_then_kmeans(spark, folder):
    """Two estimators chained, saved and loaded as one."""
    df = embedded(spark, folder)
    chain = Pipeline(stages=[
        pca.PCATable(num_components=8, feature_dim=64),
        kmeans.KMeansTable(k=4, feature_dim=8, featuresCol="projection")])
    model = chain.fit(df)
    path = new_path(spark, "chain")
    model.write().save(path)
    loaded = PipelineModel.load(path)
    first = model.transform(df).select("vec_id", "projection", "closest_cluster")
    second = loaded.transform(df).select("vec_id", F.col("closest_cluster").alias("again"))
    return first.join(second, "vec_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(vectors.vector_size(F.col("projection"))).alias("n_components"),
        F.bool_and(F.col("closest_cluster") == F.col("again")).alias("same_after_loading"))


@query("attach_by_path", f"""WITH {ENTRIES}, {NEAREST}
    SELECT vec_id, round(d, 6) AS distance_to_cluster, cluster::DOUBLE AS closest_cluster FROM nearest""")
def attach_by_path(spark, folder):
    """A saved model, attached by its path and applied without training."""
    df = embedded(spark, folder)
    path = new_path(spark, "centers")
    kmeans.KMeansTableModel.of(mean_centers(df)).write().save(path)
    scored = base.attach(spark, path).transform(df)
    return rounded(scored.select("vec_id", "distance_to_cluster", "closest_cluster"))


@query("run_registry", """
    SELECT run, status, n_params, k, attachable, CASE WHEN attachable THEN (SELECT count(*) FROM embeddings) ELSE 0 END AS n_scored
    FROM (VALUES ('good', 'Completed', 4, '3', true), ('broken', 'Failed', 4, '3', false)) AS t(run, status, n_params, k, attachable)""")
def run_registry(spark, folder):
    """Two runs over the embeddings, one of them over vectors of another size, which fails."""
    df = embedded(spark, folder)
    registry = runs.RunTable(spark, new_path(spark, "runs"))
    root = new_path(spark, "run-models")
    registry.fit(kmeans.KMeansTable(k=3, feature_dim=64), df, root, "good", {"owner": "tests"})
    try:
        registry.fit(kmeans.KMeansTable(k=3, feature_dim=63), df, root, "broken", {"owner": "tests"})
    except ValueError:
        pass
    scored = registry.attach("good").transform(df).count()
    rows = registry.rows().select("run", "status", F.size("params").alias("n_params"), F.col("params")["k"].alias("k"), "model_path")
    there = F.col("model_path").isNotNull()
    return rows.select(
        "run", "status", "n_params", "k", there.alias("attachable"), F.when(there, F.lit(scored)).otherwise(0).cast("bigint").alias("n_scored"))


@query("model_select", f"SELECT {KEYED}, round(l_quantity * 3 + l_tax + 1, 6) AS score FROM lineitem")
def model_select(spark, folder):
    """Candidates with falling penalties, rated on held-out rows: the one without gives the labels back."""
    df = table(spark, folder, "lineitem").select(
        *KEYED.split(", "),
        vectors.vector_of("l_quantity", "l_tax").alias("features"),
        (F.col("l_quantity") * 3 + F.col("l_tax") + 1).alias("label"))
    stage = LinearRegression(featuresCol="features", labelCol="label", predictionCol="score")
    grid = [{"regParam": penalty} for penalty in (100.0, 10.0, 1.0, 0.0)]
    model, _ = select_model(
        stage, grid, df, lambda scored: metrics.regression_errors(scored).first()["rmse"], larger_better=False)
    return model.transform(df).select(*KEYED.split(", "), F.round("score", 6).alias("score"))


@query("custom_algorithm", f"""
    SELECT {KEYED}, round(m.mean + l.l_quantity, 4) AS prediction
    FROM lineitem l, (SELECT avg(l_extendedprice) AS mean FROM lineitem) m""")
def custom_algorithm(spark, folder):
    """A user's own algorithm: a mean learned by a Spark job, a scorer of CSV payloads, the CSV decoder."""
    names = KEYED.split(", ")
    df = table(spark, folder, "lineitem").select(
        *names, F.col("l_extendedprice").alias("label"), vectors.vector_of("l_quantity").alias("features"))

    def fit(training: DataFrame, params: dict[str, str]):
        mean = training.agg(F.avg("label")).first()[0] * float(params["factor"])

        def score(payload: bytes) -> bytes:
            return ",".join(str(mean + float(line)) for line in payload.decode().splitlines()).encode()

        return score

    estimator = custom.CustomEstimator(fit, codecs.CSVEncoder(), codecs.CSVDecoder(), {"factor": "1"},
                                       columns=["label", "features"], max_records=1000)
    return estimator.fit(df).transform(df).select(*names, F.round("prediction", 4).alias("prediction"))


@query("custom_run", f"""
    SELECT {KEYED}, round(m.mean + l.l_quantity, 4) AS prediction
    FROM lineitem l, (SELECT avg(l_extendedprice) AS mean FROM lineitem) m""")
def custom_run(spark, folder):
    """A user's own algorithm with a user's own encoder, trained as a run, found again and applied."""
    names = KEYED.split(", ")
    df = table(spark, folder, "lineitem").select(
        *names, F.col("l_extendedprice").alias("label"), vectors.vector_of("l_quantity").alias("features"))

    class Halves:
        """Half of the first feature as text, a line per row."""

        content_type = "text/csv"

        def validate(self, schema):
            tables.require_columns(schema, "features")

        def encode(self):
            return F.concat((vectors.to_array("features")[0] / 2).cast("string"), F.lit("\n"))

    def fit(training: DataFrame, params: dict[str, str]):
        mean = training.agg(F.avg("label")).first()[0]
        return lambda payload: ",".join(str(mean + 2 * float(line)) for line in payload.decode().splitlines()).encode()

    registry = runs.RunTable(spark, new_path(spark, "runs"))
    estimator = custom.CustomEstimator(fit, Halves(), codecs.CSVDecoder(), columns=["label", "features"], max_records=1000)
    registry.fit(estimator, df, new_path(spark, "run-models"), "own")
    return registry.attach("own").transform(df).select(*names, F.round("prediction", 4).alias("prediction"))


@query("train_on_export", "SELECT count(*) AS n_rows, 4::BIGINT AS n_clusters, 0::BIGINT AS files_left FROM embeddings")
def train_on_export(spark, folder):
    """Training from a written record export, removed afterwards."""
    df = embedded(spark, folder)
    path = new_path(spark, "training")
    model = kmeans.KMeansTable(k=4, feature_dim=64, exportPath=path).fit(df)
    left = 1 if export.exists(path) else 0
    return model.transform(df).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("closest_cluster").alias("n_clusters"),
                                   F.lit(left).cast("bigint").alias("files_left"))


