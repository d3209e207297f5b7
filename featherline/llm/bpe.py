"""Byte-level BPE: Spark higher-order functions fold ranked merges over the distinct words of a block.

1. ``regexp_extract_all`` cuts every whole text into the pieces of the tokenizer's pattern.
2. Words are counted over all texts. The most frequent, ``FREQUENT_WORDS`` at most, are encoded once and their tokens
   broadcast: a bounded table, as no word in it is over ``FOLD_BYTES`` long. A task packs consecutive texts into
   blocks of about ``BLOCK_WORDS`` pieces: the block's other distinct words, once each, and where each text uses which.
3. Higher-order functions encode the distinct words. A word that has a rank is one token. For any other
   word, merges are folded from the lowest rank up, the first of equals first, until no two neighbours have one.
   A task looks up which strings inside a word have a rank (:func:`ranked_merges`), and :func:`ranked_fold` takes these in
   order over the word's bytes, a bit each. :func:`merge_fold` needs no such list: it searches the lowest rank in every step, and does
   the words over ``MASK_BYTES`` bytes and those in which a later merge may have a lower rank than one before it.
   Ranks come from a literal map from byte strings (as strings of the characters 0 to 255) to ranks, cut into buckets by crc32, since
   Spark searches a map entry by entry. Decoding concatenates the binary pieces of a literal array.
4. A task puts the tokens of every text together again.

Only word counts are shuffled, so the work follows the input, every block is bounded and a lost task is
only run again. The fold :func:`merge_fold` is quadratic in a word's bytes: each step copies its arrays. Words over
``FOLD_BYTES`` bytes, which natural text hardly has, are merged in the task by the same rule with a heap instead.

A null or empty text has no tokens. Equal texts, and rows that repeat, get equal tokens, a row each; an empty table gives none. Other columns,
whatever their names, only pass through.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import zlib
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F, types as T

from featherline.llm.spans import text_buffer
from featherline.llm.tasks import staged, tidy

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BUCKETS, BLOCK_WORDS, FOLD_BYTES = 1 << 13, 500_000, 250
#: Pieces that a task counts before it sends the counts on.
COUNTED_WORDS = 4_000_000
#: Words whose tokens every task gets.
FREQUENT_WORDS = 400_000
#: A character that stands for no byte, and more than any rank.
EDGE, NONE = "\u0100", 1 << 22
#: Bytes of a word whose boundaries are the bits of a long.
MASK_BYTES = 60
#: Bits from ``span``'s first to its last are a token's; it is made if of these just ``bounds`` are left, and ends ``inner``.
MERGES = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("span", "bounds", "inner")]))


@cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(word): int(rank) for word, rank in (line.split() for line in lines if line.strip())}


def _as_characters(word: bytes) -> str:
    return word.decode("latin-1")


@cache
def _literals(path: str) -> tuple[str, str]:
    """JSON of the rank map in buckets, and of the pieces by rank."""
    held = ranks(path)
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    pieces = [""] * (max(held.values(), default=-1) + 1)
    for word, rank in held.items():
        characters = _as_characters(word)
        buckets[zlib.crc32(characters.encode()) % BUCKETS][characters] = rank
        pieces[rank] = characters
    return json.dumps(buckets, separators=(",", ":")), json.dumps(pieces, separators=(",", ":"))


def literals(path: str) -> Column:
    """Struct of the rank map's buckets and of the pieces by rank; a constant once the query is planned."""
    buckets, pieces = _literals(path)
    return F.struct(F.from_json(F.lit(buckets), "array<map<string,int>>").alias("buckets"),
                    F.from_json(F.lit(pieces), "array<string>").alias("pieces"))


class Vocabulary:
    """Look-ups in one value of :func:`literals`, which a plan should hold once."""

    def __init__(self, held: Column):
        self.held = held

    def rank(self, characters: Column) -> Column:
        """Rank of a byte string, null if it has none."""
        bucket = F.get(self.held["buckets"], (F.crc32(characters.cast("binary")) % BUCKETS).cast("int"))
        return F.try_element_at(bucket, characters)

    def piece(self, rank: Column) -> Column:
        return F.get(self.held["pieces"], rank)


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def merge_fold(word: Column, vocabulary: Vocabulary) -> Column:
    """Where the tokens of ``word`` begin, as array<int>: an edge, the tokens, another edge, and the end.

    ``word`` stands between two ``EDGE`` characters, which no piece has, so nothing merges with them. The
    fold's state has an integer for every token: 256 times the rank of it joined with the next (``NONE`` if
    that has no rank), plus its place. The least integer is then the merge to do next, the first of equals.
    """

    def state(begin: Column, end: Column) -> Column:
        return F.coalesce(vocabulary.rank(F.substring(word, begin, end - begin)), F.lit(NONE)) * 256 + begin

    length = F.length(word)
    start = F.concat(F.transform(F.sequence(F.lit(1), length - 1), lambda i: state(i, i + 2)),
                     F.array(length + NONE * 256, length + 1 + NONE * 256))

    def step(held: Column, _: Column) -> Column:
        def place(k: Column) -> Column:
            return F.get(held, k).bitwiseAND(F.lit(255))

        def merge(least: Column) -> Column:
            def at(k: Column) -> Column:  # the tokens k and k + 1 become one
                end = place(k + 1)
                changed = F.array(state(place(k - 2), end), state(least.bitwiseAND(F.lit(255)), place(k + 2)))
                return F.concat(F.slice(held, F.lit(1), k - 2), changed, F.slice(held, k + 2, F.lit(256)))

            return F.when(least >= NONE * 256, held).otherwise(_bound(F.array_position(held, least).cast("int"), at))

        return _bound(F.array_min(held), merge)

    return F.transform(F.aggregate(F.sequence(F.lit(4), length), start, step), lambda x: x.bitwiseAND(F.lit(255)))


class Merges(NamedTuple):
    """The merges of a vocabulary. Nodes are the byte strings that tokens begin with: 0 to 255 the bytes, then by length and order."""

    #: Sorted; of every node from 256 on, the node without its last byte, times 256, plus that byte.
    keys: np.ndarray
    #: By node: rank of a token that merges can make, else -1.
    rank: np.ndarray
    #: By rank: bytes of the token, and of the first of the two tokens it is made of.
    length: np.ndarray
    first: np.ndarray
    #: By rank: both of them have lower ranks, or are bytes.
    rising: np.ndarray


def _last_merge(word: bytes, rank: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two tokens that merging ``word`` by itself joins last, None if it does not come to one token."""
    tokens = [word[i:i + 1] for i in range(len(word))]
    while len(tokens) > 2:
        least, k = min((rank.get(a + b, NONE), k) for k, (a, b) in enumerate(zip(tokens, tokens[1:])))
        if least == NONE:
            return None
        tokens[k:k + 2] = [tokens[k] + tokens[k + 1]]
    return tokens[0], tokens[1]


@cache
def merges(path: str) -> Merges:
    """While a token is made, nothing has crossed its ends, so it is made as if it stood alone: always of the same two."""
    held = ranks(path)
    nodes = sorted({word[:k] for word in held for k in range(2, len(word) + 1)}, key=lambda w: (len(w), w))
    number = {bytes([b]): b for b in range(256)} | {word: 256 + k for k, word in enumerate(nodes)}
    size = max(held.values(), default=-1) + 1
    rank, length, first = np.full(len(number), -1, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
    rising = np.ones(size, bool)
    for word, level in held.items():
        if len(word) > 1 and (parts := _last_merge(word, held)):
            rank[number[word]], length[level], first[level] = level, len(word), len(parts[0])
            rising[level] = all(len(part) == 1 or held[part] < level for part in parts)
    return Merges(np.array([number[word[:-1]] * 256 + word[-1] for word in nodes], np.int64), rank, length, first, rising)


def ranked_merges(words: pa.Array, held: Merges) -> pa.Array:
    """The merges that each word's bytes may come to, as ``MERGES`` by rank and place; null if :func:`ranked_fold` can't do the word."""
    data, offsets = text_buffer(words)
    size = np.diff(offsets)
    word = np.repeat(np.arange(len(size)), size)
    end = offsets[1:][word]
    begin = np.flatnonzero(size[word] <= MASK_BYTES)
    node, n, found = data[begin].astype(np.int64), 1, [np.zeros(0, np.int64)]
    while len(begin) and len(held.keys):
        inside = begin + n < end[begin]
        begin = begin[inside]
        key = node[inside] * 256 + data[begin + n]
        at = np.searchsorted(held.keys, key)
        known = held.keys[np.minimum(at, len(held.keys) - 1)] == key
        begin, node, n = begin[known], at[known] + 256, n + 1
        made = held.rank[node] >= 0
        of = word[begin[made]]
        found.append(of << 28 | held.rank[node[made]] << 6 | begin[made] - offsets[of])
    order = np.sort(np.concatenate(found))
    of, level, place = order >> 28, order >> 6 & NONE - 1, order & 63
    one = np.int64(1)
    inner = one << place + held.first[level]
    span = (one << held.length[level] + 1) - 1 << place
    bounds = inner | one << place | one << place + held.length[level]
    other = size > MASK_BYTES
    other[of[~held.rising[level]]] = True
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(size)))]), pa.int32()),
        pa.StructArray.from_arrays([pa.array(x) for x in (span, bounds, inner)], names=MERGES.elementType.names), mask=pa.array(other))


def ranked_fold(length: Column, found: Column) -> Column:
    """Where the tokens of a word of ``length`` bytes begin, and its end, as array<int> from 0.

    The fold's state has a bit for every byte that begins a token, and one for the end. No merge makes room for one of a lower rank,
    so one pass by rank and place is the order in which the lowest rank, the first of equals, would be searched step by step.
    """
    whole = F.call_function("shiftleft", F.lit(1).cast("long"), length + 1) - 1
    return F.aggregate(found, whole, lambda held, one: F.when(held.bitwiseAND(one["span"]) == one["bounds"], held.bitwiseXOR(one["inner"])).otherwise(held),
                       lambda held: F.filter(F.sequence(F.lit(0), length), lambda i: F.getbit(held, i) == 1))


def encoded(word: Column, vocabulary: Vocabulary, found: Column) -> Column:
    """Struct of the decimal ids, each followed by a comma, their number, and the decoded bytes of a word with its ``MERGES``."""

    def ids_of_places(places: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(places) - 1), lambda i: vocabulary.rank(
            F.substring(word, F.get(places, i - 1) + 1, F.get(places, i) - F.get(places, i - 1))))

    def searched(framed: Column) -> Column:
        return _bound(merge_fold(framed, vocabulary), lambda places: F.transform(F.slice(places, F.lit(2), F.size(places) - 2), lambda x: x - 2))

    def told(held: Column) -> Column:
        return F.struct(F.concat(F.array_join(held, ","), F.lit(",")).alias("ids"), F.size(held).alias("n"),
                        F.encode(F.array_join(F.transform(held, vocabulary.piece), ""), "ISO-8859-1").alias("bytes"))

    def ids(whole: Column) -> Column:
        framed = F.concat(F.lit(EDGE), word, F.lit(EDGE))
        places = F.when(found.isNull(), _bound(framed, searched)).otherwise(ranked_fold(F.length(word), found))
        return _bound(F.when(whole.isNotNull(), F.array(whole)).otherwise(_bound(places, ids_of_places)), told)

    return _bound(vocabulary.rank(word), ids)


def merged(word: bytes, rank: dict[bytes, int]) -> list[int]:
    """Tokens of one long word by the same rule, with a heap of neighbours."""
    if word in rank:
        return [rank[word]]
    n = len(word)
    begin, following, before = list(range(n)), list(range(1, n + 1)), list(range(-1, n - 1))
    end = list(range(1, n + 1))
    alive = [True] * n
    heap = []

    def offer(i: int) -> None:
        j = following[i]
        if j < n and (level := rank.get(word[begin[i]:end[j]])) is not None:
            heapq.heappush(heap, (level, i, end[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = following[i] if alive[i] else n
        if j >= n or end[j] != stop:
            continue
        alive[j], end[i], following[i] = False, end[j], following[j]
        if following[j] < n:
            before[following[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [rank[word[begin[i]:end[i]]] for i in range(n) if alive[i]]


def _pieces(docs: DataFrame, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(docs["text"], F.lit("")), F.lit("(?U)" + pattern), F.lit(0)).alias("_pieces")


def _distinct(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[int, int, np.ndarray, pa.DictionaryArray]]:
    """(first row, row after the last, pieces of each row, pieces as a dictionary) of about ``limit`` pieces."""
    column = batch.column("_pieces")
    offsets = column.offsets.to_numpy().astype(np.int64)
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield first, last, np.diff(offsets[first:last + 1]), column.values.slice(offsets[first], offsets[last] - offsets[first]).dictionary_encode()
        first = last


def _encoded_rows(words: DataFrame, path: str, shared: Broadcast) -> DataFrame:
    """``word`` with the struct ``tokens``, by the fold; ``shared`` are the vocabulary's merges."""

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("word"), ranked_merges(batch.column("word"), shared.value)], names=["word", "merges"])

    listed = words.select("word").mapInArrow(tidy(look_up), T.StructType([T.StructField("word", T.StringType()), T.StructField("merges", MERGES)]))
    return listed.select("word", _bound(literals(path), lambda held: _bound(
        F.decode(F.col("word").cast("binary"), "ISO-8859-1"), lambda c: encoded(c, Vocabulary(held), F.col("merges")))).alias("tokens"))


def _frequent(docs: DataFrame, path: str, pattern: str, most: int, shared: Broadcast) -> pa.Table:
    """``word, ids, n, bytes`` of the words that occur most often, at most ``most`` of them, counted over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []

        def counts() -> pa.RecordBatch:
            some = pa.concat_arrays(held).dictionary_encode()
            held.clear()
            times = np.bincount(some.indices.to_numpy(), minlength=len(some.dictionary))
            return pa.RecordBatch.from_arrays([some.dictionary, pa.array(times, pa.int64())], names=["word", "n"])

        for batch in batches:
            held.append(batch.column("_pieces").flatten())
            if sum(map(len, held)) >= COUNTED_WORDS:
                yield counts()
        if held:
            yield counts()

    counted = docs.select(_pieces(docs, pattern)).mapInArrow(tidy(count), "word string, n long").where(F.octet_length("word") <= FOLD_BYTES)
    totals = staged(counted.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1").withColumn(
        "step", F.floor(F.log2("n") * 16).cast("int")), "word-counts")
    held, least = 0, 1 << 20
    for step, n in sorted(((r[0], r[1]) for r in totals.groupBy("step").count().collect()), reverse=True):
        held += n
        if held > most:
            break
        least = step
    rows = _encoded_rows(totals.where(F.col("step") >= least), path, shared)
    return rows.select("word", "tokens.ids", "tokens.n", "tokens.bytes").toArrow()


def _unpack(batch: pa.RecordBatch, frequent: pa.Table, path: str, digest_only: bool) -> pa.RecordBatch:
    """Rows of a block with their tokens."""
    rows = batch.column("rows").flatten()
    counts = np.frombuffer(batch.column("counts")[0].as_buffer(), np.int64)
    places = pa.array(np.frombuffer(batch.column("places")[0].as_buffer(), np.int32))
    tokens, long = batch.column("tokens").flatten(), batch.column("long").flatten()
    ids, number, spelled = (tokens.field(k) for k in range(3))
    if long.null_count < len(long):
        rank = ranks(path)
        spelling = {r: w for w, r in rank.items()}
        mask = long.is_valid()
        found = [merged(word.as_py(), rank) for word in long.filter(mask)]
        ids = pc.replace_with_mask(ids, mask, pa.array(["".join(f"{i}," for i in f) for f in found], ids.type))
        number = pc.replace_with_mask(number, mask, pa.array([len(f) for f in found], number.type))
        spelled = pc.replace_with_mask(spelled, mask, pa.array([b"".join(spelling[i] for i in f) for f in found], spelled.type))
    ids, number, spelled = (pa.concat_arrays([held.cast(kind), own.cast(kind)]) for held, own, kind in (
        (frequent[1], ids, pa.large_string()), (frequent[2], number, pa.int64()), (frequent[3], spelled, pa.large_binary())))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    totals = np.concatenate([[0], np.cumsum(number.take(places).to_numpy())])
    texts, at = text_buffer(ids.take(places))
    texts = memoryview(texts)
    strings = [texts[at[a]:max(at[a], at[b] - 1)] for a, b in zip(bounds[:-1], bounds[1:])]
    decoded, held_at = text_buffer(spelled.take(places))
    decoded = memoryview(decoded)
    spellings = [decoded[held_at[a]:held_at[b]] for a, b in zip(bounds[:-1], bounds[1:])]
    none = [None] * len(rows)
    return pa.RecordBatch.from_arrays([
        rows, pa.array(totals[bounds[1:]] - totals[bounds[:-1]], pa.int64()),
        pa.array([hashlib.sha256(x).hexdigest() for x in strings], pa.string()),
        pa.array([hashlib.sha256(x).hexdigest() for x in spellings], pa.string()),
        pa.array(none if digest_only else [bytes(x).decode() for x in strings], pa.string()),
        pa.array(none if digest_only else [bytes(x) for x in spellings], pa.binary())],
        names=["row", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"])


def encode(docs: DataFrame, path: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN, digest_only: bool = True,
           keep: list[str] | None = None, frequent_words: int = FREQUENT_WORDS) -> DataFrame:
    """The columns ``keep`` (all by default) as struct ``row`` with ``n_tokens, ids_sha256, decoded_sha256``.

    ``ids`` (decimal, joined by commas) and ``decoded`` bytes are null with ``digest_only``.
    """
    shared_merges = docs.sparkSession.sparkContext.broadcast(merges(path))
    known = _frequent(docs, path, pattern, frequent_words, shared_merges)
    # Words up to FOLD_BYTES, so many at most: a broadcast of bounded size.
    columns = [known.column(k).combine_chunks() for k in range(4)]
    shared = docs.sparkSession.sparkContext.broadcast([c.cast(pa.string()) if k == 0 else c for k, c in enumerate(columns)])
    read = docs.select(F.struct(*[docs[c] for c in keep or docs.columns]).alias("row"), _pieces(docs, pattern))
    row = read.schema["row"].dataType

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks: rows, pieces of each row, which word every piece is, and the words that aren't frequent with their merges."""
        frequent = shared.value[0]
        for batch in batches:
            for first, last, counts, some in _distinct(batch, BLOCK_WORDS):
                held = batch.column("row").slice(first, last - first)
                at = pc.index_in(some.dictionary, value_set=frequent)
                rare = some.dictionary.filter(at.is_null()).cast(pa.binary())
                new = at.is_null().to_numpy(zero_copy_only=False)
                place = at.fill_null(0).to_numpy().astype(np.int32)
                place[new] = len(frequent) + np.arange(len(rare), dtype=np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held),
                    pa.array([counts.tobytes()], pa.binary()), pa.array([place[some.indices.to_numpy()].tobytes()], pa.binary()),
                    pa.ListArray.from_arrays(pa.array([0, len(rare)], pa.int32()), pa.StructArray.from_arrays(
                        [rare, ranked_merges(rare, shared_merges.value)], names=["word", "merges"]))],
                    names=["rows", "counts", "places", "words"])

    packed = read.mapInArrow(tidy(pack), T.StructType([
        T.StructField("rows", T.ArrayType(row)), T.StructField("counts", T.BinaryType()), T.StructField("places", T.BinaryType()),
        T.StructField("words", T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("merges", MERGES)])))]))
    # The characters 0 to 255 stand for bytes; a long word is left to the task.
    tokens = _bound(literals(path), lambda held: F.transform("words", lambda w: F.when(
        F.octet_length(w["word"]) <= FOLD_BYTES, _bound(F.decode(w["word"], "ISO-8859-1"), lambda c: encoded(c, Vocabulary(held), w["merges"])))))
    long = F.transform("words", lambda w: F.when(F.octet_length(w["word"]) > FOLD_BYTES, w["word"]))
    schema = T.StructType([T.StructField("row", row)])
    for name, kind in (("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string"), ("ids", "string"), ("decoded", "binary")):
        schema = schema.add(name, kind)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                yield _unpack(batch.slice(k, 1), frequent, path, digest_only)

    return packed.select("rows", "counts", "places", tokens.alias("tokens"), long.alias("long")).mapInArrow(tidy(unpack), schema)
