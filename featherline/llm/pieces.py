"""Encoding and decoding with a SentencePiece BPE model that keeps where every piece stands in the source.

1. A whole text is normalised by longest-prefix replacement through the model's compiled character map
   (``charmap.py``), which tells for each normalised character the source character it comes from.
2. The normalised text is cut where no piece of the vocabulary reaches across: before a blank that follows
   another character, and, in words over ``LONG_WORD`` characters, between any two neighbours that no piece holds. A word is
   merged best score first, the leftmost of equals. The distinct words of a batch are merged once, all together: numpy joins
   one pair of neighbours in each at a step. What is left of a longer word is merged by itself on a heap.
3. Lengths of pieces, added up, are places in the normalised text; the source places turn them into byte spans of the
   original text. The bytes of a character without a piece all begin at it and only the last one spans it.

A task reads its texts once and nothing is shuffled, so the work follows the input and a lost task is only run again.

A null or empty text has no pieces and decodes to the empty text. Equal texts get equal pieces. A very long text, or word, is
encoded whole: the heap takes n log n steps. An empty table gives no row. Other columns, whatever their names, only pass through.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from featherline.llm.charmap import BLANK, CharacterMap, Normalizer
from featherline.llm.tasks import tidy

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LONG_WORD = 200
#: Kinds of pieces and the kind of model, as the format numbers them.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
BETWEEN_BLANKS = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a message: integers, or bytes for all others."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at:at + size], at + size
        yield key >> 3, value


class PieceModel:
    """The pieces of a model file, with its normaliser."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            held = list(fields(file.read()))
        trainer, norm = (dict(fields(dict(held).get(number, b""))) for number in (2, 3))
        if trainer.get(3, 1) != BPE or dict(fields(dict(held).get(5, b""))).get(2):
            raise ValueError("only BPE models without a map for decoded texts can be read")
        self.pieces, self.kinds, scores = [], [], []
        for number, message in held:
            if number == 1:
                piece = dict(fields(message))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
                self.kinds.append(piece.get(3, NORMAL))
        self.unused, self.symbols = UNUSED in self.kinds, 0
        self.fallback, self.unknown_text = bool(trainer.get(35, 0)), trainer.get(44, " ⁇ ".encode()).decode()
        self.ids = {p: i for i, (p, kind) in enumerate(zip(self.pieces, self.kinds)) if kind in (NORMAL, USER_DEFINED, UNUSED)}
        self.unknown = self.kinds.index(UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, (p, kind) in enumerate(zip(self.pieces, self.kinds)) if kind == BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        place = {score: k for k, score in enumerate(sorted(set(scores), reverse=True))}
        self.level = {p: place[scores[i]] for p, i in self.ids.items()}
        self.longest = max(map(len, self.level), default=1) + 1
        #: What each piece stands for; a byte stands for a part of a character.
        self.spelled = [None if kind == BYTE else "" if kind == CONTROL else self.unknown_text if kind == UNKNOWN else p.replace(BLANK, " ")
                        for p, kind in zip(self.pieces, self.kinds)]
        self.neighbours = {pair for p in self.level for pair in zip(p, p[1:])}
        self.by_blank = not any(b == BLANK and a != BLANK for a, b in self.neighbours)
        self.own = {p for p, kind in zip(self.pieces, self.kinds) if kind == USER_DEFINED}
        self.literal = re.compile("|".join(map(re.escape, sorted(self.own, key=len, reverse=True)))) if self.own else None
        self.prefix = bool(norm.get(3, 1))
        self.normalize = Normalizer(CharacterMap(norm.get(2, b"")), self.prefix, bool(norm.get(4, 1)), bool(norm.get(5, 1)), bool(trainer.get(24, 0)), self.literal)
        self.strips = self.prefix or bool(norm.get(4, 1))

    def words(self, text: str) -> list[str]:
        """The normalised text in parts that no piece reaches across."""
        parts = [text]
        if self.literal is not None:
            parts, at = [], 0
            for found in self.literal.finditer(text):
                parts += [text[at:found.start()], found.group()]
                at = found.end()
            parts.append(text[at:])
        if self.by_blank:
            parts = [w for part in parts for w in BETWEEN_BLANKS.findall(part)]
            if self.literal is None and max(map(len, parts), default=0) <= LONG_WORD:
                return parts
        words = []
        for part in parts:
            if len(part) <= LONG_WORD or part in self.own:
                words.append(part)
                continue
            begin = 0
            for at, pair in enumerate(zip(part, part[1:]), 1):
                if pair not in self.neighbours:
                    words.append(part[begin:at])
                    begin = at
            words.append(part[begin:])
        return [w for w in words if w]

    @cached_property
    def joins(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Code points with a symbol, ascending; pairs of symbols that make a piece, ascending; the pieces' merge levels and symbols.

        A symbol is a piece's id or, for a character that only stands in longer pieces, a number after those.
        """
        symbol = dict(self.ids)
        for piece in self.ids:
            for character in piece:
                symbol.setdefault(character, len(self.pieces) + len(symbol))
        self.symbols = max(symbol.values(), default=0) + 1
        points = sorted((ord(c), k) for c, k in symbol.items() if len(c) == 1)
        pairs = sorted((symbol[p[:k]] * self.symbols + symbol[p[k:]], self.level[p], i) for p, i in self.ids.items() for k in range(1, len(p))
                       if p[:k] in symbol and p[k:] in symbol)
        return np.array(points, np.int64).reshape(-1, 2), *np.array(pairs, np.int64).reshape(-1, 3).T

    def merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, symbol or -1, characters) of every piece of many words, in order.

        All words go on together: a step joins in each the neighbours of the best score, the leftmost of equals. A word without any is done.
        """
        points, keys, levels, made = self.joins
        none = np.int64(len(self.pieces))
        held = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        at = np.minimum(np.searchsorted(points[:, 0], held), len(points) - 1)
        symbol = np.where(points[at, 0] == held, points[at, 1], -1)
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        size = np.ones(len(word), np.int64)

        def joined(left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Level and symbol of what the symbols at these places make with the next ones."""
            right = np.minimum(left + 1, len(symbol) - 1)
            key = symbol[left] * self.symbols + symbol[right]
            k = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            fits = (keys[k] == key) & (word[left] == word[right]) & (right > left) & (symbol[left] >= 0) & (symbol[right] >= 0)
            return np.where(fits, levels[k], none), made[k]

        level, result = joined(np.arange(len(symbol)))
        done = []
        while len(word):
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            counts = np.diff(np.append(first, len(word)))
            best = np.minimum.reduceat(level, first)
            going = np.repeat(best < none, counts)
            if not going.all():
                done.append((word[~going], symbol[~going], size[~going]))
                word, symbol, size, level, result = (x[going] for x in (word, symbol, size, level, result))
                best, counts = best[best < none], counts[best < none]
                if not len(word):
                    break
            places = np.flatnonzero(level == np.repeat(best, counts))
            left = places[np.append(True, word[places[1:]] != word[places[:-1]])]
            symbol[left] = result[left]
            size[left] += size[left + 1]
            stays = np.ones(len(word), bool)
            stays[left + 1] = False
            left = left - np.arange(len(left))  # one symbol less for each word before
            word, symbol, size, level, result = (x[stays] for x in (word, symbol, size, level, result))
            for changed in (left, left[left > 0] - 1):
                level[changed], result[changed] = joined(changed)
        parts = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*done)] or [np.zeros(0, np.int64)] * 3
        order = np.argsort(parts[0], kind="stable")
        return tuple(x[order] for x in parts)

    def merged_on_heap(self, word: str) -> list[str]:
        """The pieces of a word of any length, by the same rule; also for models with pieces that only lead to others."""
        n, width, level = len(word), self.longest, self.level
        held = list(word)
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        heap: list[int] = []
        unused: dict[str, tuple[str, str]] = {}

        def offer(i: int, j: int) -> None:
            joined = held[i] + held[j]
            at = level.get(joined)
            if at is not None:
                heapq.heappush(heap, (at * n + i) * width + len(joined))
                if self.kinds[self.ids[joined]] == UNUSED:
                    unused[joined] = held[i], held[j]

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            key, size = divmod(heapq.heappop(heap), width)
            i = key % n
            j = after[i]
            if not held[i] or j >= n or len(held[i]) + len(held[j]) != size:
                continue  # one of the two has been joined since
            held[i], held[j] = held[i] + held[j], ""
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                offer(i, j)
            if before[i] >= 0:
                offer(before[i], i)

        def usable(piece: str) -> list[str]:
            return [p for half in unused[piece] for p in usable(half)] if piece in unused else [piece]

        found = [piece for piece in held if piece]
        return [p for piece in found for p in usable(piece)] if unused else found

    def encode_word(self, word: str) -> tuple[list[int], list[int]]:
        """(ids, characters that each of them spans) of a word."""
        ids, spans = [], []
        for piece in [word] if word in self.own else self.merged_on_heap(word):
            known = self.ids.get(piece)
            if known is None and self.fallback:
                some = [self.bytes[b] for b in piece.encode()]
                ids += some
                spans += [0] * (len(some) - 1) + [len(piece)]
            else:
                ids.append(self.unknown if known is None else known)
                spans.append(len(piece))
        return ids, spans

    def encode_words(self, words: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids of many words, and the characters that each of them spans."""
        singly = np.array([len(w) > LONG_WORD or self.unused or w in self.own for w in words], bool)
        together = [w for w, one in zip(words, singly) if not one]
        word, symbol, size = self.merge_words(together)
        known = (symbol >= 0) & (symbol < len(self.pieces))
        repeat = np.ones(len(symbol), np.int64)
        if self.fallback and not known.all():
            begin = np.cumsum(size) - size  # in the words together
            text = "".join(together)
            bytes_of = [text[begin[k]].encode() for k in np.flatnonzero(~known)]
            repeat[~known] = [len(b) for b in bytes_of]
        ids, spans = np.repeat(np.where(known, symbol, self.unknown), repeat), np.repeat(size, repeat)
        if self.fallback and not known.all():
            ids[np.repeat(~known, repeat)] = [self.bytes[b] for some in bytes_of for b in some]
            last = np.zeros(len(ids), bool)
            last[np.cumsum(repeat) - 1] = True
            spans[~last] = 0
        ends = np.append(0, np.cumsum(np.bincount(np.repeat(word, repeat), minlength=len(together))))
        alone = [self.encode_word(w) for w, one in zip(words, singly) if one]
        order = np.argsort(np.append(np.flatnonzero(~singly), np.flatnonzero(singly)))
        return tuple(pa.concat_arrays([pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(some, pa.int32())), pa.array([a[k] for a in alone], pa.list_(pa.int32()))]).take(
            pa.array(order)) for k, some in enumerate((ids, spans)))

    def spell(self, ids: list[int]) -> str:
        """What ids stand for, before the blank in front is taken off: bytes that are no character become U+FFFD each."""
        found, held = [], bytearray()

        def flush() -> None:
            at = 0
            while at < len(held):
                for size in (1, 2, 3, 4):
                    try:
                        found.append(held[at:at + size].decode())
                        at += size
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    found.append("�")
                    at += 1
            held.clear()

        texts = [self.spelled[i] for i in ids]
        if None not in texts:
            return "".join(texts)
        for i, text in zip(ids, texts):
            if text is None:
                held.append(self.byte_of[i])
                continue
            flush()
            found.append(text)
        flush()
        return "".join(found)

    def decode(self, ids: list[int]) -> str:
        """The text of ids."""
        first = next((i for i in ids if self.kinds[i] != CONTROL), None)
        text = self.spell(ids)
        return text[1:] if first is not None and self.strips and self.kinds[first] not in (BYTE, UNKNOWN) and self.pieces[first].startswith(BLANK) else text


@lru_cache(4)
def model(path: str) -> PieceModel:
    """The model at a path that tasks can read too."""
    return PieceModel(path)


def encode_texts(held: PieceModel, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, str, str]]:
    """(ids, byte spans as rows of begin and end, decimal ids, decoded text) of each whole text; each distinct word is merged once."""
    normal = [held.normalize(text) for text in texts]
    words = [held.words(text) for text, _ in normal]
    used = pa.array([w for some in words for w in some], pa.string()).dictionary_encode()
    distinct = used.dictionary.to_pylist()
    ids, spans = held.encode_words(distinct)
    decimal, spelled = pa.array(map(str, range(len(held.pieces)))), pa.array(held.spelled, pa.string())
    pieces = ids.flatten()
    told = pc.binary_join(pa.ListArray.from_arrays(ids.offsets, decimal.take(pieces)), ",")
    spelling = pc.binary_join(pa.ListArray.from_arrays(ids.offsets, spelled.take(pieces)), "")
    by_bytes = spelling.is_null()  # a byte alone spells nothing
    spelling = pc.replace_with_mask(spelling, by_bytes, pa.array([held.spell(i) for i in ids.filter(by_bytes).to_pylist()], pa.string()))
    at = used.indices
    ends = np.append(0, np.cumsum([len(some) for some in words]))
    bounds = pa.array(ends, pa.int32())
    told, spelling = (pc.binary_join(pa.ListArray.from_arrays(bounds, column.take(at)), join) for column, join in ((told, ","), (spelling, "")))
    flat, sizes = ids.take(at), spans.take(at)
    places = np.append(0, np.cumsum(flat.value_lengths().to_numpy(zero_copy_only=False)))[ends]
    flat, sizes = (x.flatten().to_numpy(zero_copy_only=False) for x in (flat, sizes))
    for k, text in enumerate(texts):
        some, upto = flat[places[k]:places[k + 1]], np.cumsum(sizes[places[k]:places[k + 1]], dtype=np.int64)
        begins = np.append(0, upto[:-1]) if len(upto) else upto
        numbers, decoded = told[k].as_py(), spelling[k].as_py()
        if not held.fallback and len(some) > 1:  # neighbours that are unknown are one
            again = (some[1:] == held.unknown) & (some[:-1] == held.unknown)
            some, begins, upto = some[np.append(True, ~again)], begins[np.append(True, ~again)], upto[np.append(~again, True)]
            numbers, decoded = ",".join(map(str, some.tolist())), held.spell(some.tolist())
        if held.strips and len(some) and held.pieces[some[0]].startswith(BLANK):
            decoded = decoded[1:]
        source, bytes_before = normal[k][1], source_bytes(text)
        yield some, np.stack([bytes_before[source[begins]], bytes_before[source[upto]]], axis=1), numbers, decoded


def source_bytes(text: str) -> np.ndarray:
    """The byte at which each character of a text begins in UTF-8, and the end."""
    if text.isascii():
        return np.arange(len(text) + 1)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.append(0, np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)))


def _lists(values: list[np.ndarray], kind) -> pa.Array:
    ends = pa.array([0, *accumulate(map(len, values))], pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(values) if values else np.zeros(0, np.int32), kind))


def encode_pieces(docs: DataFrame, path: str = MODEL, digest_only: bool = True, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) as struct ``row`` with ``n_tokens, ids_sha256, decoded_sha256, covered``.

    ``covered`` is the number of source bytes that the pieces span. ``ids``, ``begins`` and ``ends`` (byte spans
    in the text) and ``decoded`` are null with ``digest_only``.
    """
    model(path)  # refuse a model here, not in a task
    read = docs.select(F.struct(*[docs[c] for c in keep or docs.columns]).alias("row"), F.coalesce(docs["text"], F.lit("")).alias("_text"))
    schema = T.StructType([T.StructField("row", read.schema["row"].dataType)])
    for name, kind in (("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType()), ("covered", T.LongType()),
                       ("ids", T.ArrayType(T.IntegerType())), ("begins", T.ArrayType(T.LongType())), ("ends", T.ArrayType(T.LongType())), ("decoded", T.StringType())):
        schema = schema.add(name, kind)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = model(path)
        for batch in batches:
            counts, told, spelled, covered, ids, spans, texts = [], [], [], [], [], [], []
            for some, places, decimal, decoded in encode_texts(held, batch.column("_text").to_pylist()):
                counts.append(len(some))
                told.append(hashlib.sha256(decimal.encode()).hexdigest())
                spelled.append(hashlib.sha256(decoded.encode()).hexdigest())
                covered.append(int((places[:, 1] - places[:, 0]).sum()))
                if not digest_only:
                    ids.append(some)
                    spans.append(places)
                    texts.append(decoded)
            columns = [batch.column("row"), pa.array(counts, pa.int64()), pa.array(told, pa.string()), pa.array(spelled, pa.string()), pa.array(covered, pa.int64())]
            if digest_only:
                columns += [pa.nulls(batch.num_rows, kind) for kind in (pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.string())]
            else:
                columns += [_lists(ids, pa.int32()), *[_lists([s[:, k] for s in spans], pa.int64()) for k in (0, 1)], pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return read.mapInArrow(tidy(encode), schema)


def decode_pieces(tokens: DataFrame, path: str = MODEL) -> DataFrame:
    """All columns as struct ``row`` with the text ``decoded`` of the column ``ids``; null for null ids, an error for ids the model lacks."""
    read = tokens.select(F.struct(*[tokens[c] for c in tokens.columns]).alias("row"), tokens["ids"].cast("array<int>").alias("_ids"))
    schema = T.StructType([T.StructField("row", read.schema["row"].dataType), T.StructField("decoded", T.StringType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = model(path)
        for batch in batches:
            some = [ids.as_py() for ids in batch.column("_ids")]
            if any(i is None or not 0 <= i < len(held.pieces) for ids in some if ids for i in ids):
                raise ValueError("ids outside the model")
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array([None if ids is None else held.decode(ids) for ids in some], pa.string())], names=schema.names)

    return read.mapInArrow(tidy(decode), schema)
