"""From raw documents to token ids: five operators, each on all that the one before has kept.

1. quality classifier: documents that the factorisation machine scores below 0.5 go.
2. n-gram Jaccard join: of linked documents the one with the smallest doc_id stays.
3. suffix-array dedup: passages of 50 bytes and more that a smaller doc_id has too are cut out; a
   document of which nothing is left goes.
4. mixing: sources are brought to their target weights; a document comes once per whole copy taken and
   once with the first words of a part taken.
5. byte-level BPE: ids of the tokens of every text, with digests of ids and of the decoded text.

Rows without a doc_id cannot be told apart: stage 2 keeps them all. ``n_chars`` follows the text where a stage
changes it. Extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from featherline.llm.bpe import encode
from featherline.llm.mixing import mixed_texts
from featherline.llm.quality import quality
from featherline.llm.rtree import jaccard_join
from featherline.llm.suffixes import repeated_windows
from featherline.llm.tasks import prepare, settle
from featherline.workspace import written


def _columns(docs: DataFrame, text=None) -> list:
    """The columns of ``docs`` from the struct ``row``, with ``text`` and its length where it is given."""
    new = {} if text is None else {"text": text, "n_chars": F.char_length(text).cast("long")}
    return [new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("score >= 0.5").select(*_columns(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    # An id may come with several texts, of which only some are linked.
    copies = jaccard_join(docs, digest=True).where("doc_id <> component_id").select(F.col("doc_id").alias("copy"), "digest")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    same = (F.col("row.doc_id") == F.col("copy")) & (F.md5(F.col("row.text").cast("binary")) == F.col("digest"))
    return rows.join(copies, same, "left_anti").select(*_columns(docs))


def new_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    # The text goes to the operator once; the other columns and whether there was a text ride along.
    other = F.struct(F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("row"), docs["text"].isNull().alias("no_text"))
    left = repeated_windows(docs.select("doc_id", "text", other.alias("other")), digest_only=False, keep=["other"])
    text = F.when(~F.col("no_text"), F.col("kept"))
    kept = left.where("n_removed < n_bytes OR n_bytes = 0").select("kept", "row.other.row", "row.other.no_text")
    return kept.select(*_columns(docs, text))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    made = mixed_texts(docs)
    return made.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else made


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    made = encode(docs, digest_only=False, keep=["doc_id", "source"])
    ids = F.when(F.col("n_tokens") > 0, F.split("ids", ",").cast("array<int>")).otherwise(F.array().cast("array<int>"))
    return made.select(F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), "n_tokens", ids.alias("ids"), "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", one_of_each_group),
    ("suffix-array dedup", new_passages),
    ("mixing to target weights", mixed),
    ("byte-level BPE", token_ids),
]

#: No SQL learns a classifier or merges byte pairs; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each result written and read again."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        settle(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
