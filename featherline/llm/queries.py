"""The registered query of every operator here, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from featherline.llm import warc
from featherline.llm.bpe import encode
from featherline.llm.hamming import near_duplicates
from featherline.llm.labelled import remainder
from featherline.llm.licenses import scan
from featherline.llm.mixing import mix
from featherline.llm.negatives import hard_negatives
from featherline.llm.nsimplex import clusters
from featherline.llm.pieces import encode_pieces
from featherline.llm.quality import quality
from featherline.llm.rtree import jaccard_join
from featherline.llm.suffixes import repeated_windows
from featherline.llm.tasks import prepare
from featherline.llm.toxicity import toxicity
from featherline.llm.vptree import nearest
from featherline.llm.warc import derivatives, responses

#: The capture date that the pages are given; the table has none.
CAPTURED = "2024-01-01T00:00:00Z"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(run)
    def prepared(spark: SparkSession, folder: str) -> DataFrame:
        prepare(spark)
        return run(spark, folder)

    QUERIES[run.__name__] = prepared
    return prepared


@query
def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    made = derivatives(responses(table(spark, folder, "pages"), CAPTURED))
    return made.select(F.col("source.page_id").alias("page_id"), F.col("source.record_id").alias("refers_to"), "warc_type", "record_id", "content_type",
                       "headers", "block")


def _sql_id(kind: str, *of: str) -> str:
    h = f"md5(concat_ws('|', '{kind}', {', '.join(of)}))"
    parts = " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"('<urn:uuid:' || {parts} || '>')"


def _sql_replaced(text: str) -> str:
    for entity, character in warc.ENTITIES:
        text = f"replace({text}, '{entity}', '{character.replace(chr(39), chr(39) * 2)}')"
    return text


def _sql_collapsed(text: str) -> str:
    return f"trim(regexp_replace(regexp_replace({text}, '{warc.BLANKS}', ' ', 'g'), '{warc.LINES}', chr(10), 'g'), ' ' || chr(10))"


def _warc_sql() -> str:
    """The same records in DuckDB's SQL, of the same expressions."""
    plain = f"regexp_replace(regexp_replace(regexp_replace(html, '{warc.DROPPED}', ' ', 'g'), '{warc.BREAKS}', chr(10), 'g'), '{warc.TAGS}', ' ', 'g')"
    title = f"replace({_sql_collapsed(_sql_replaced(f'regexp_extract(html, $${warc.TITLE}$$, 1)'))}, chr(10), ' ')"
    links = f"list_transform(regexp_extract_all(html, $${warc.LINKS}$$, 1), lambda x: 'outlink: ' || {_sql_replaced('x')})"
    line = "chr(13) || chr(10)"
    names = (("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Date", "date"), ("WARC-Target-URI", "uri"), ("WARC-Refers-To", "refers_to"),
             ("WARC-Refers-To-Target-URI", "uri"), ("WARC-Refers-To-Date", "date"), ("WARC-Source-Payload-Digest", "payload"),
             ("WARC-Block-Digest", "'sha256:' || sha256(block)"), ("Content-Type", "content_type"), ("Content-Length", "strlen(block)"))
    headers = f" || {line} || ".join(["'WARC/1.1'", *[f"'{name}: ' || {value}" for name, value in names]])
    return f"""
    WITH pages AS (SELECT page_id, coalesce(url, '') AS uri, coalesce(html, '') AS html, '{CAPTURED}' AS date FROM pages),
    source AS (SELECT *, {_sql_id("response", "coalesce(page_id::VARCHAR, '')", "uri")} AS refers_to, 'sha256:' || sha256(html) AS payload FROM pages),
    records AS (
        SELECT *, 'metadata' AS warc_type, {_sql_id("metadata", "refers_to")} AS record_id, 'application/warc-fields' AS content_type,
            array_to_string(list_concat(['source-record-id: ' || refers_to, 'source-payload-digest: ' || payload, 'status: 200', 'content-type: text/html',
                'title: ' || {title}], {links}), {line}) || {line} AS block FROM source
        UNION ALL
        SELECT *, 'conversion', {_sql_id("conversion", "refers_to")}, 'text/plain; charset=UTF-8', {_sql_collapsed(_sql_replaced(plain))} FROM source)
    SELECT page_id, refers_to, warc_type, record_id, content_type, {headers} AS headers, block FROM records"""


ORACLES["op1_warc"] = _warc_sql()


@query
def op2_windows(spark: SparkSession, folder: str) -> DataFrame:
    found = repeated_windows(table(spark, folder, "documents"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    tokens = encode(table(spark, folder, "documents"), keep=["doc_id"])
    return tokens.select(F.col("row.doc_id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op4_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"), 0.95)


@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scores = toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"), keep=["doc_id"])
    doc_id = F.col("row.doc_id")
    return scores.select(doc_id.alias("doc_id"), F.coalesce(remainder(doc_id, 4) == 2, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    scores = quality(table(spark, folder, "documents"), table(spark, folder, "labels"), keep=["doc_id"])
    doc_id = F.col("row.doc_id")
    return scores.select(doc_id.alias("doc_id"), F.coalesce(remainder(doc_id, 3) == 1, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op7_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = scan(table(spark, folder, "documents"), keep=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query
def op8_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix(table(spark, folder, "documents"), keep=["doc_id"])
    return mixed.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")


@query
def op10_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join(table(spark, folder, "documents"))


def _sql_usable(vector: str) -> str:
    return f"({vector} IS NOT NULL AND list_bool_and(list_prepend(true, list_transform({vector}, lambda x: x IS NOT NULL AND isfinite(x)))))"


@query
def op11_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    return hard_negatives(table(spark, folder, "embeddings"), F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label), vec_id % 100 == 0)


ORACLES["op11_negatives"] = f"""
    WITH kept AS MATERIALIZED (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings WHERE label IS NOT NULL AND {_sql_usable("embedding")}),
    scored AS MATERIALIZED (
        SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
            list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
        FROM kept a JOIN kept b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    positives AS (
        SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
    SELECT anchor_id, positive_id, row_number() OVER best AS rank, other_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
    QUALIFY row_number() OVER best <= 10"""


@query
def op12_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return clusters(table(spark, folder, "embeddings"))


def _clusters_sql() -> str:
    """Every round of the clustering as a common table: assignments, then the floors of the means."""
    distance = "list_sum(list_transform(list_zip(kept.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = [f"""kept AS MATERIALIZED (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings WHERE len(embedding) = 64 AND {_sql_usable("embedding")}),
    centers0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS cluster, v FROM kept ORDER BY sha256('3:' || vec_id) LIMIT 8)"""]
    for k in range(11):
        steps.append(f"""near{k} AS MATERIALIZED (
        SELECT vec_id, kept.v, cluster, {distance} AS distance FROM kept, centers{k} c
        QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY {distance}, cluster) = 1)""")
        if k < 10:
            steps.append(f"""sums{k} AS (
        SELECT cluster, i, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM near{k}) GROUP BY cluster, i),
    moved{k} AS (
        SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM sums{k} GROUP BY cluster),
    centers{k + 1} AS MATERIALIZED (SELECT cluster, coalesce(m.v, c.v) AS v FROM centers{k} c LEFT JOIN moved{k} m USING (cluster))""")
    return f"""WITH {", ".join(steps)}
    SELECT vec_id, cluster, distance::BIGINT AS distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
        (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
    FROM near10 JOIN centers10 c USING (cluster)"""


ORACLES["op12_clusters"] = _clusters_sql()


@query
def op13_pieces(spark: SparkSession, folder: str) -> DataFrame:
    tokens = encode_pieces(table(spark, folder, "documents"), keep=["doc_id"])
    return tokens.select(F.col("row.doc_id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256", "covered")
