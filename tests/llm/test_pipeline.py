"""The pipeline's stages, each against what its own input asks for."""

import hashlib
from collections import Counter

import pytest

import corpus_pipeline
from featherline.llm import mixing
from featherline.workspace import written
from tests.llm import cases
from tests.llm.test_texts import brute_targets, tokens

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(written(stage(spark, found[-1], FOLDER), "stage"))
    return found


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns(steps):
    for before, after in zip(steps, steps[1:-1]):
        assert after.columns == before.columns and dict(after.dtypes) == dict(before.dtypes)


def test_quality_stage(spark, steps):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {i for i, _ in texts(steps[1])}
    known = [(labels[i], i in kept) for i, _ in texts(steps[0]) if labels.get(i) is not None]
    assert sum(bool(y) == k for y, k in known) >= 0.9 * len(known)
    assert set(texts(steps[1])) <= set(texts(steps[0]))


def test_join_stage(steps):
    want = Counter(i for i, _, c in cases.components(texts(steps[1])) if c == i)
    assert Counter(i for i, _ in texts(steps[2])) == want


def test_dedup_stage(steps):
    want = {i: (n, gone, digest) for i, n, gone, _, digest in cases.windows(texts(steps[2]))}
    got = dict(texts(steps[3]))
    assert set(got) == {i for i, (n, gone, _) in want.items() if gone < n or not n}
    for i, text in got.items():
        n, gone, digest = want[i]
        assert len((text or "").encode()) <= n - gone
        if len((text or "").encode()) == n - gone:
            assert hashlib.sha256((text or "").encode()).hexdigest() == digest


def test_mixing_stage(steps):
    def sizes(df):
        found = Counter()
        for r in df.select("source", mixing.word_count(df["text"]).alias("n")).collect():
            found[r.source] += r.n
        return found

    before, after = sizes(steps[3]), sizes(steps[4])
    for source, target in brute_targets(before).items():
        assert abs(after[source] - target) <= mixing.BLOCK_WORDS + 1
    assert max(Counter(i for i, _ in texts(steps[4])).values()) <= 3


def test_token_stage(steps):
    want = Counter((i, ",".join(map(str, tokens(t)))) for i, t in texts(steps[4]))
    rows = steps[5].collect()
    assert Counter((r.doc_id, ",".join(map(str, r.ids))) for r in rows) == want
    assert all(r.n_tokens == len(r.ids) for r in rows)


def test_run(spark, steps):
    got = sorted((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, FOLDER).select("doc_id", "ids_sha256").collect())
    assert got == sorted((r.doc_id, r.ids_sha256) for r in steps[5].collect())


def test_awkward_documents(spark):
    """Nulls, repeats, clashing columns; then an empty table."""
    for docs in (cases.documents(spark), cases.empty(spark)):
        for _, stage in corpus_pipeline.STAGES[1:]:
            after = written(stage(spark, docs, FOLDER), "stage")
            if stage is not corpus_pipeline.token_ids:
                assert after.columns == docs.columns
                docs = after
        assert after.count() == docs.count()
