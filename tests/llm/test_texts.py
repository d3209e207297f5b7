"""Operators on texts against plain Python, with nulls, empty and long texts, ties, repeats and clashing columns."""

import base64
import hashlib
import itertools
import random
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from featherline.llm import bpe, licenses, mixing, rtree, spans, suffixes
from tests.llm import cases


def same(got, want):
    assert Counter(got) == Counter(want)


def pairs_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def digests(df):
    found = df.select(F.col("row.doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    return [tuple(r) for r in found]


@pytest.mark.parametrize("block_bytes", [1 << 23, 40_000])
def test_windows(spark, block_bytes):
    docs = cases.documents(spark)
    same(digests(suffixes.repeated_windows(docs, block_bytes=block_bytes)), cases.windows(pairs_of(docs)))


def test_windows_of_random_texts(spark):
    """Few letters, so that passages meet in every way; many blocks."""
    random.seed(3)
    texts = []
    for k in range(120):
        t = "".join(random.choices("ab ", k=random.randint(0, 300)))
        if texts and k % 2:
            other = random.choice(texts)[1]
            a = random.randint(0, len(other))
            t = t[:100] + other[a:a + random.randint(30, 120)] + t[100:]
        texts.append((random.choice([k, k, 7, None]), t))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    for split_runs in (suffixes.SPLIT_RUNS, 1):
        same(digests(suffixes.repeated_windows(docs, block_bytes=2000, split_runs=split_runs)), cases.windows(texts))


@pytest.mark.parametrize("wide_runs", [1, 6])
def test_windows_around_a_phrase(spark, wide_runs):
    """One phrase of 33 to 49 bytes amid different texts, and passages and letters that meet in every way, window by window."""
    random.seed(5)
    word = lambda n: "".join(random.choices("ab ", k=n))
    phrase, passage = "licensed under the terms of the usual licence", "".join(random.choices("abcdefgh ", k=150))
    texts = [(random.choice([k, k, 7, None]), word(60) + random.choice(["", passage[:random.randint(40, 150)]]) + phrase + word(random.randint(0, 80)))
             for k in range(100)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    same(digests(suffixes.repeated_windows(docs, block_bytes=2000, split_runs=1, wide_runs=wide_runs)), cases.windows(texts))


def test_no_group_of_windows_grows_with_a_phrase():
    """Runs of a gram that too many share are told to send their windows one by one, whatever stands beside it."""
    n = suffixes.WIDE_RUNS + 1
    rows = np.zeros(n, suffixes.RUN)
    rows["gram"], rows["run"], rows["least"] = 77, np.arange(n), np.arange(n)
    told, _, _ = suffixes._told(pa.Table.from_batches([suffixes._first_pass(rows, np.zeros(n, np.int64), suffixes.SPLIT_RUNS)]))
    assert (told["open"] == suffixes.WIDE).all()
    told, _, _ = suffixes._told(pa.Table.from_batches([suffixes._first_pass(rows[1:], np.zeros(n - 1, np.int64), suffixes.SPLIT_RUNS)]))
    assert (told["open"] == suffixes.SPLIT).all()


def test_windows_of_documents_without_an_id(spark):
    """Runs that only such documents have whole, in several blocks, with windows that a numbered document has too."""
    random.seed(11)
    word = lambda n: "".join(random.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    shared = word(400)
    texts = [(None, word(80) + shared + word(80)) for _ in range(8)] + [(k, word(60) + shared[a:a + 70] + word(60)) for k, a in enumerate((30, 140, 250))]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    same(digests(suffixes.repeated_windows(docs, block_bytes=300)), cases.windows(texts))


def test_windows_tell_runs_of_one_hash_by_the_gram():
    rows = np.array([(1, 9, 3), (2, 9, 5), (2, 9, 6), (1, 9, 4)], suffixes.RUN)
    answers = suffixes._first_pass(rows, np.array([0, 0, 1, 2]), 2000)
    told, masked, _ = suffixes._told(pa.Table.from_batches([answers]).slice(0, 1))
    there, at = suffixes._look_up(told, np.array([1, 2, 3], np.uint64), np.array([9, 9, 9], np.uint64))
    assert there.tolist() == [True, True, False] and told["least"][at[:2]].tolist() == [3, 5] and not len(masked)
    marks = np.zeros(2, suffixes.ANSWER)
    marks["gram"], marks["run"], marks["mask"], marks["open"] = [1, 2], 9, [1, 2], suffixes.MASKED
    _, masked, _ = suffixes._told(pa.Table.from_batches([suffixes._answers(np.zeros(2, np.int64), marks)]))
    assert masked["mask"].tolist() == [1, 2]


def test_windows_keep_rows_and_text(spark):
    docs = cases.documents(spark)
    kept = suffixes.repeated_windows(docs, digest_only=False, keep=docs.columns).where("row.doc_id = 9").first()
    assert kept.row.size == "clash" and kept.row.text.startswith("ünï") and kept.kept == "ünï çode ñandú"
    assert suffixes.repeated_windows(cases.empty(spark)).count() == 0


def tokens(text):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.VOCABULARY, "rb"))}
    enc = tokens.encoding = getattr(tokens, "encoding", None) or tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return enc.encode_ordinary(text or "")


def test_bpe(spark):
    docs = cases.documents(spark).unionByName(cases.documents(spark, [
        (100, "y" * 5000 + "é" * 300, None, None, None, *["x"] * len(cases.EXTRA)), (101, "mixed 漢字 עברית ‍́ <|endoftext|> ¼½ \x00\x7f", None, None, None, *["x"] * len(cases.EXTRA))]))
    found = bpe.encode(docs, digest_only=False, keep=["doc_id", "text", "row"]).collect()
    assert len(found) == docs.count()
    for r in found:
        ids = tokens(r.row.text)
        joined = ",".join(map(str, ids))
        assert (r.n_tokens, r.ids, r.decoded, r.row.row[:1]) == (len(ids), joined, (r.row.text or "").encode(), r.row.row[:1])
        assert r.ids_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.row.text or "").encode()).hexdigest()
    assert bpe.encode(cases.empty(spark)).count() == 0


def test_long_word_merges_are_those_of_the_fold():
    rank = bpe.ranks(bpe.VOCABULARY)
    for text in ("unbelievably", "ab" * 400, "Zzzz" + "z" * 300, "ñandú" * 80):
        assert bpe.merged(text.encode(), rank) == tokens(text)


def test_rare_words_are_folded_in_one_pass():
    words = ["unbelievably", " ofhehaanwh", "ñandú", "x", "z" * 60, "z" * 61, "漢字", "Lacióndocoie"]
    found = bpe.ranked_merges(pa.array([w.encode() for w in words]), bpe.merges(bpe.VOCABULARY))
    assert [w for w, one in zip(words, found.to_pylist()) if one is None] == ["z" * 61]
    for word, one in zip(words, found.to_pylist()):
        size = len(word.encode())
        held = (1 << size + 1) - 1
        for merge in one or []:
            held ^= merge["inner"] if held & merge["span"] == merge["bounds"] else 0
        assert one is None or held.bit_count() - 1 == len(tokens(word)) and len(one) <= size * (size - 1) // 2


@pytest.mark.parametrize("frequent", [0, 400_000])
def test_bpe_of_vocabularies_whose_merges_do_not_rise(spark, tmp_path, frequent):
    # "abc" comes of "ab" and has the lower rank; the other tokens are strings whose merges follow no order.
    rng = np.random.default_rng(7)
    spelled = ["abc", "ab", *dict.fromkeys("".join(rng.choice(list("bcde"), rng.integers(2, 6))) for _ in range(80))]
    ranks = {bytes([b]): b for b in range(256)} | {w.encode(): 256 + k for k, w in enumerate(spelled)}
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(w) + b" %d\n" % r for w, r in ranks.items()))
    held = bpe.merges(str(path))
    assert not held.rising[256] and held.rising[257] and (~held.rising).sum() > 1 and held.rising[256:].sum() > 10
    own = tiktoken.Encoding("other", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["abcab", *(" ".join("".join(rng.choice(list("abcde"), n)) for n in rng.integers(1, 75, 30)) for _ in range(20))]
    docs = spark.createDataFrame([(t,) for t in texts * 2], "text string")
    for r in bpe.encode(docs, path=str(path), digest_only=False, frequent_words=frequent).collect():
        assert r.ids == ",".join(map(str, own.encode_ordinary(r.row.text)))


def test_of_two_texts_of_one_id_only_the_linked_one_goes(spark):
    texts = [(1, cases.sentence(1, 80)), (2, cases.sentence(1, 80)), (2, cases.sentence(9, 80)), (3, None), (None, cases.sentence(1, 80))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    same([tuple(r) for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()], [texts[0], *texts[2:]])


def test_jaccard(spark):
    docs = cases.documents(spark)
    got = [tuple(r) for r in rtree.jaccard_join(docs).collect()]
    same(got, cases.components(pairs_of(docs)))
    assert rtree.jaccard_join(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_of_edited_texts(spark, monkeypatch, seed):
    """Copies with edits around the threshold, small and large, in parts that are cut."""
    monkeypatch.setattr(rtree, "PART_ROWS", 20)
    monkeypatch.setattr(rtree, "PART_SHINGLES", 3000)
    random.seed(seed)
    texts = []
    for base in range(12):
        words = [f"v{random.randint(0, 400)}" for _ in range(random.choice([5, 8, 12, 40, 150, 600]))]
        for _ in range(random.choice([1, 5, 30])):
            other = list(words)
            for _ in range(random.randint(0, 1 + len(words) // 40)):
                other[random.randrange(len(other))] = f"e{random.randint(0, 9)}"
            texts.append((len(texts), " ".join(other[: len(other) - random.choice([0, 0, 1])])))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    same([tuple(r) for r in rtree.jaccard_join(docs).collect()], cases.components(texts))


@settings(max_examples=30, deadline=None)
@given(st.integers(6, 400), st.integers(0, 10**6), st.integers(0, 80))
def test_linked_sets_share_a_name(size, seed, edits):
    random = np.random.default_rng(seed)
    a = np.unique(random.integers(0, 2**63, size, dtype=np.uint64))
    b = np.unique(np.concatenate([a[min(edits, len(a) - 1):], random.integers(0, 2**63, random.integers(0, 40), dtype=np.uint64)]))
    if 100 * len(np.intersect1d(a, b)) < 85 * len(np.union1d(a, b)) or np.array_equal(a, b):
        return
    value, at = np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)])
    names, rows = rtree.names_of(value, at, np.array([len(a), len(b)]))
    assert set(names[rows == 0]) & set(names[rows == 1])


def test_tree_bounds_lose_nothing():
    random = np.random.default_rng(0)
    sets = [set(random.integers(0, 4000, random.integers(20, 60)).tolist()) for _ in range(60)]
    sets += [set(list(s)[random.integers(0, 8):]) | set(random.integers(5000, 6000, random.integers(0, 4)).tolist()) for s in sets for _ in range(3)]
    points = np.array([np.bincount(np.array(list(s)) % rtree.GROUPS, minlength=rtree.GROUPS) for s in sets])
    sizes = np.array([len(s) for s in sets])
    found = {tuple(sorted(p)) for i, j in rtree.RTree(points, sizes).candidates() for p in zip(i.tolist(), j.tolist())}
    want = {(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])}
    assert want and want <= found and len(found) < len(sets) ** 2 / 4


def base_of(text):
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(cases.LOWER))
    found = [(k, label) for phrase, label in licenses.BASE for k in range(len(words)) if words[k:k + len(phrase.split())] == phrase.split()]
    at = [k for k, _ in found]
    return len(words), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in found}))


def test_licenses(spark):
    docs = cases.documents(spark)
    found = licenses.scan(docs, keep=["doc_id", "text", "score"]).collect()
    assert len(found) == docs.count()
    for r in found:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_of(r.row.text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 and r.row.score == "clash"
        if r.row.doc_id == 17 and r.n_base:
            assert r.labels == "apache-2,cc-by-nc,gpl-3,mit" and r.score == 1.0
    assert licenses.scan(cases.empty(spark)).count() == 0


def strings(expression):
    """Every text that an expression of literals, options and choices matches."""
    parser = re._parser

    def of(items):
        choices = []
        for kind, value in items:
            name = str(kind)
            if name == "LITERAL":
                choices.append([chr(value)])
            elif name == "MAX_REPEAT":
                assert value[:2] == (0, 1)
                choices.append(["", *of(value[2])])
            elif name == "SUBPATTERN":
                choices.append(of(value[3]))
            elif name == "BRANCH":
                choices.append([x for branch in value[1] for x in of(branch)])
            else:
                assert name == "IN"
                choices.append([chr(c) for k, v in value for c in (range(v[0], v[1] + 1) if str(k) == "RANGE" else [v])])
        return ["".join(x) for x in itertools.product(*choices)]

    return of(parser.parse(expression))


def test_rules():
    assert len(licenses.RULES) >= 200
    for rule in licenses.RULES:
        for text in strings(rule.expression):
            assert rule.gate in text.split(), (rule, text)
    nested = licenses.detections("licensed under the apache license version 2 0", {"apache"})
    assert {licenses.RULES[k].label for _, _, k in nested} == {"apache-2"} and len(nested) == 2  # the base phrase stands beside the longer one


def test_many_mentions_in_one_text(spark):
    """As many detections as a megabyte holds: places and suppression against plain Python, in about the time of the text."""
    text = "under the MIT license and the apache license, version 2 or gpl " * 16_000
    began = time.process_time()
    found = licenses.detections(licenses._OTHER.sub(" ", text.lower()).strip(" "), {"mit", "apache", "gpl"})
    assert time.process_time() - began < 30
    base = [d for d in found if d[2] < len(licenses.BASE)]
    row, = licenses.scan(cases.documents(spark, [(1, text, None, None, None, *["clash"] * len(cases.EXTRA))]), keep=["doc_id"]).collect()
    assert row.n_base == len(base) == 32_000 and row.n_words == 12 * 16_000 and row.base_labels == "apache-2,mit"


def test_suppression_is_containment():
    chance = random.Random(0)
    covers, held = licenses.Covers(list(range(50))), []
    for _ in range(300):
        first = chance.randrange(50)
        end = first + chance.randrange(1, 20)
        assert (covers.last_end(first) >= end) == any(a <= first and end <= b for a, b in held)
        if chance.random() < 0.3:
            covers.add(first, end)
            held.append((first, end))


def test_words_and_shingles():
    data, offsets = spans.text_buffer(pa.array(["a b  c", None, "", "a", "b c d a b"]))
    start, end, row = spans.words(data, offsets, spans.SPACE_SEPARATED)
    assert [data[a:b].tobytes() for a, b in zip(start, end)] == b"a b c a b c d a b".split() and row.tolist() == [0, 0, 0, 3, 4, 4, 4, 4, 4]
    found, at = spans.shingles(spans.Hashes(data).of(start, end), row, 5, 2)
    assert at.tolist() == [0, 0, 3, 4, 4, 4, 4] and found[0] == found[6] and found[1] == found[3] and len(set(found.tolist())) == 5


def brute_targets(sizes, most=3):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = sum(weight[s] for s in names if s not in capped)
        rate = (total - sum(most * sizes[s] for s in capped)) / free if free else 0
        above = {s for s in names if s not in capped and rate * weight[s] > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in capped else rate * weight[s] for s in names}
        capped |= above


def test_mixing(spark):
    docs = cases.documents(spark).unionByName(cases.documents(spark, [
        (200 + k, cases.sentence(k, 30 + k), None, "tiny" if k < 2 else "mid", None, *["clash"] * len(cases.EXTRA)) for k in range(60)]))
    mixed = mixing.mix(docs, shard_words=5000, keep=["doc_id", "text", "source", "size"])
    found = mixed.collect()
    assert len(found) == docs.count() and all(r.row["size"] == "clash" for r in found)
    sizes, taken = Counter(), Counter()
    for r in found:
        assert r.asDict()["size"] == len(re.findall("[^\x20\x09-\x0D]+", r.row.text or "")) and 0 <= r.taken <= 3 * r.asDict()["size"]
        sizes[r.row.source] += r.asDict()["size"]
        taken[r.row.source] += r.taken
    target = brute_targets(sizes)
    for r in found:
        assert r.source_size == sizes[r.row.source] and r.target == pytest.approx(target[r.row.source])
    for s in sizes:
        shards = -(-sizes[s] // 5000)
        assert abs(taken[s] - target[s]) <= mixing.BLOCK_WORDS * shards
    again = mixing.mix(docs.repartition(5), shard_words=5000, keep=["doc_id", "text", "source", "size"]).collect()
    key = lambda r: (r.row.doc_id or -1, r.row.text or "", r.taken)
    assert sorted(map(key, again)) == sorted(map(key, found))
    texts = mixing.mixed_texts(docs, shard_words=5000)
    assert texts.columns == docs.columns
    words = texts.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()
    assert {r.source: r.n for r in words} == {s: n for s, n in taken.items() if n}
    assert mixing.mix(cases.empty(spark)).count() == 0
    # The session's partitions are no part of the mix.
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        few = mixing.mix(docs, shard_words=5000, keep=["doc_id", "text", "source", "size"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    same([(r.row.doc_id, r.row.text, r.taken) for r in few], [(r.row.doc_id, r.row.text, r.taken) for r in again])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(0, 1000), max_size=8), st.integers(0, 60))
def test_apportion(votes, blocks):
    votes = np.array(votes)
    seats = np.zeros(len(votes), int)
    if len(votes) and votes.sum() > 0:
        for _ in range(blocks):
            seats[np.argmax(votes / (2 * seats + 1))] += 1
    got = mixing.apportion(votes, blocks)
    assert got.sum() == seats.sum()
    quotient = lambda s: sorted(v / (2 * k + 1) for v, n in zip(votes, s) for k in range(n))
    assert quotient(got) == pytest.approx(quotient(seats))
