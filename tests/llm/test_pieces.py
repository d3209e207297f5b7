"""SentencePiece encoding against the library: ids, spans, decoded texts, normalisation."""

import hashlib
import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from featherline.llm.charmap import CharacterMap, Normalizer
from featherline.llm.pieces import MODEL, decode_pieces, encode_pieces, encode_texts, fields, model, source_bytes
from tests.llm import cases

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
ODD = list("ab  \t\n▁▁é漢字かな😀ﬁ①Ａ́ \x00<s>12 the ing") + ["the", " of", "  ", " ▁", "\r\n", "İ", "ﷺ", "ก็", "각", "각", "‍", "�"]
WHOLE = ["", " ", "▁", "a" * 3000, "xyz" * 2000, " " * 500, "漢字" * 500, "<0x0A>", "</s>", "hello world", "word " * 3000 + "x" * 5000]


def odd_texts(seed, n):
    chance = random.Random(seed)
    return WHOLE + ["".join(chance.choice(ODD) for _ in range(chance.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("at_once", [1, 50, 1000])
def test_texts_as_the_library(at_once):
    texts = odd_texts(0, 600)
    for begin in range(0, len(texts), at_once):
        some = texts[begin:begin + at_once]
        for text, (ids, spans, decimal, decoded) in zip(some, encode_texts(model(MODEL), some)):
            want = LIBRARY.encode(text, return_type="proto")
            assert [p.id for p in want.pieces] == ids.tolist()
            assert [(p.begin, p.end) for p in want.pieces] == [tuple(s) for s in spans.tolist()]
            assert decimal == ",".join(map(str, ids.tolist())) and decoded == LIBRARY.decode(ids.tolist())


def test_words_merge_alike_together_and_alone():
    held = model(MODEL)
    words = [w for text in odd_texts(1, 300) for w in held.words(held.normalize(text)[0])] + ["aaaaaaa", "\u2581\u2581\u2581", "abab" * 20]
    ids, spans = held.encode_words(words)
    assert list(zip(ids.to_pylist(), spans.to_pylist())) == [held.encode_word(w) for w in words]
    assert held.encode_words([])[0].to_pylist() == []


def test_ids_decode_as_the_library_decodes():
    chance, held = random.Random(2), model(MODEL)
    for _ in range(1500):
        ids = [chance.choice([chance.randrange(len(held.pieces)), chance.randrange(0, 259)]) for _ in range(chance.randint(0, 12))]
        assert held.decode(ids) == LIBRARY.decode(ids)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("on", [True, False])
def test_compiled_maps_as_the_library(rule, on):
    how = dict(add_dummy_prefix=on, remove_extra_whitespaces=on, escape_whitespaces=on)
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, **how)
    spec = dict(fields(dict(fields(library.serialized_model_proto()))[3]))
    own = Normalizer(CharacterMap(spec.get(2, b"")), on, on, on, False)
    for text in odd_texts(3, 400):
        got, source = own(text)
        want, places = library.normalize(text, with_offsets=True)
        assert got == want and source.tolist() == list(places)


def test_table(spark):
    docs = cases.documents(spark)
    got = encode_pieces(docs, digest_only=False).collect()
    assert len(got) == len(cases.rows())
    for row in got:
        text = row.row.text or ""
        ids = LIBRARY.encode(text)
        assert row.ids == ids and row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded == LIBRARY.decode(ids) and row.decoded_sha256 == hashlib.sha256(row.decoded.encode()).hexdigest()
        data = text.encode()
        # The spans follow each other and cover the text, as this model drops no character.
        assert all(a <= b for a, b in zip(row.begins, row.ends)) and row.begins[1:] == sorted(row.begins[1:])
        assert row.covered == len(data) and b"".join(data[a:b] for a, b in zip(row.begins, row.ends)) == data
        assert row.row.size == "clash"
    digests = {(r.row.doc_id, r.ids_sha256) for r in encode_pieces(docs).collect()}
    assert digests == {(r.row.doc_id, r.ids_sha256) for r in got}
    assert encode_pieces(cases.empty(spark)).count() == 0


def test_decoding_a_table(spark):
    rows = [(1, LIBRARY.encode(" two  words")), (2, []), (3, None), (4, [3 + 0xE6, 3 + 0xBC, 3 + 0xA2, 3 + 0xFF])]
    got = {r.row._text: r.decoded for r in decode_pieces(spark.createDataFrame(rows, "_text long, ids array<int>")).collect()}
    assert got == {1: " two  words", 2: "", 3: None, 4: "漢�"}
    with pytest.raises(Exception, match="ids outside the model"):
        decode_pieces(spark.createDataFrame([(1, [99_999_999])], "_text long, ids array<int>")).collect()


def test_source_bytes():
    for text in odd_texts(4, 100):
        assert source_bytes(text).tolist() == [len(text[:k].encode()) for k in range(len(text) + 1)]


def test_other_kinds_of_models_are_refused(tmp_path):
    path = tmp_path / "other.model"
    path.write_bytes(sentencepiece.SentencePieceNormalizer(rule_name="nfkc").serialized_model_proto())
    with pytest.raises(ValueError):
        model(str(path))
