"""Suffix-array dedup: the 50-byte windows of all texts in radix order, most significant digit first.

A window is a suffix cut at the threshold; equal groups of windows are exactly the repeated passages. Every
window is read as digits in an order that lets many windows share the first ones:

* digit one is the least ``GRAM``-byte string in the window (by hash, the first of equals) with its place;
  neighbouring windows mostly share that occurrence, so one row stands for a run of about seventeen windows;
* digit two is the whole run around it (a hash of its bytes and of the gram's place in it);
* digit three are the windows themselves.

Pass one orders (digit one, digit two) over the corpus. A gram in one document only ends there, and so does a
run that is the same wherever its gram occurs: all its windows repeat together, and the least document is known. Only
runs that differ around a shared gram (ends of passages, edits) go on to pass two, which orders their
windows. A gram that more than ``SPLIT_RUNS`` different runs share is no single group there: the 17 bytes
before it are a further digit for windows that hold them, the 17 after it for the others. That digit divides nothing where
a phrase reaches over all of it, so of a gram with more than ``WIDE_RUNS`` runs no contexts are sent: each of their windows is a
row by itself, dealt by its own hash, once per block with its least document there. No group of pass two grows with the
frequency of a phrase. Both passes are radix sorts of packed digits in tasks that Spark deals out by the top bits of
digit one, and blocks of documents send each distinct run once, with its least document, so a passage
that a third of all documents share costs one row per block.

Documents are dealt into blocks of about ``BLOCK_BYTES`` by a hash of the id. One shuffle brings the texts there; both passes and the
result read it.

Judged on the input alone: a byte goes if some window over it also starts in a document with a smaller
doc_id. Documents of one id do not remove from one another; a null id is larger than all others. A null
text is empty; texts shorter than the window stay whole, and a very long one is read whole. Rows that repeat are documents of one id.
An empty table gives no row. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from featherline.llm.groups import starts, whole_groups
from featherline.llm.spans import Hashes, mix, row_hashes, text_buffer
from featherline.llm.tasks import give_back, tidy

WINDOW, GRAM, BLOCK_BYTES, PIECE, PARTS_PER_PARTITION = 50, 16, 8 << 20, 512 << 10, 4
SPLIT_RUNS, WIDE_RUNS, BESIDE = 2000, 20_000, (WINDOW - GRAM) // 2
_SPAN = WINDOW - GRAM + 1  # grams of a window
_LAST = np.iinfo(np.int64).max
#: Rows of pass one: gram, run, least document.
RUN = np.dtype([("gram", "<u8"), ("run", "<u8"), ("least", "<i8")])
#: Rows of pass two: gram (with the further digit, if any), what that digit changed in it, run, least document, first window of
#: the run, number of windows, and their bytes.
LONGEST = _SPAN + WINDOW - 1
CONTEXT = np.dtype([("gram", "<u8"), ("turned", "<u8"), ("run", "<u8"), ("least", "<i8"), ("first", "u1"), ("windows", "u1"), ("bytes", "u1", LONGEST)])
#: Answers: gram and run, its least document, windows of that document that go, and what kind of answer it is.
OPEN, MASKED, SPLIT, WIDE, SEEN = 1, 2, 3, 4, 5
ANSWER = np.dtype([("gram", "<u8"), ("run", "<u8"), ("least", "<i8"), ("mask", "<u8"), ("open", "u1")])
#: Bytes of a number that are sent: hashes have 48 bits, masks a bit per window.
_SENT = {"gram": 6, "turned": 6, "run": 6, "least": 8, "mask": -(-_SPAN // 8), "open": 1, "first": 1, "windows": 1}


def packed(rows: np.ndarray) -> bytes:
    """Rows field by field, numbers byte by byte, so that what is alike lies together and compresses."""
    return b"".join(
        np.ascontiguousarray(rows[name]).tobytes() if name == "bytes" else
        np.ascontiguousarray(np.ascontiguousarray(rows[name]).view(np.uint8).reshape(len(rows), -1)[:, :_SENT[name]].T).tobytes()
        for name in rows.dtype.names)


def unpacked(data: np.ndarray, kind: np.dtype) -> np.ndarray:
    widths = [LONGEST if name == "bytes" else _SENT[name] for name in kind.names]
    n = len(data) // sum(widths)
    rows, at = np.zeros(n, kind), 0
    for name, width in zip(kind.names, widths):
        held = data[at:at + n * width]
        at += n * width
        if name == "bytes":
            rows[name] = held.reshape(n, width)
            continue
        number = np.zeros((n, kind[name].itemsize), np.uint8)
        number[:, :width] = held.reshape(width, n).T
        rows[name] = number.view(kind[name]).ravel()
    return rows


def runs_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """First window, number of windows, row, gram hash, run hash and place of the gram of every run in the texts."""
    n = len(data)
    empty = np.zeros(0, np.int64)
    if n < WINDOW:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64), empty
    hashes = Hashes(data)
    grams = hashes.of_length(GRAM)
    low = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    span, least = 1, low
    while span * 2 <= _SPAN:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < _SPAN:
        rest = _SPAN - span
        least = np.minimum(least[:-rest], least[rest:])
    least = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)  # by window: where its least gram is
    size = np.diff(offsets)
    row = np.repeat(np.arange(len(size)), np.maximum(size - WINDOW + 1, 0))
    window = np.arange(len(row)) - np.repeat(np.cumsum(np.maximum(size - WINDOW + 1, 0)) - np.maximum(size - WINDOW + 1, 0), np.maximum(size - WINDOW + 1, 0))
    window += offsets[row]
    at = least[window]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    start, at, row = window[first], at[first], row[first]
    run = mix(hashes.of(start, start + count + WINDOW - 1) ^ mix((at - start + 1).astype(np.uint64))) >> np.uint64(16)
    # The least hashes are small numbers; spread again, their top bits deal out evenly.
    return start, count, row, mix(grams[at] ^ np.uint64(0xD1B54A32D192ED03)) >> np.uint64(16), run, at


def _pieces(text: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of about ``PIECE`` bytes of whole texts."""
    data, offsets = text_buffer(text)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = min(max(int(np.searchsorted(offsets, offsets[first] + PIECE, "right")) - 1, first + 1), rows)
        yield first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def _least(gram: np.ndarray, run: np.ndarray, document: np.ndarray) -> np.ndarray:
    """Packed distinct (gram, run) with the least document, in radix order."""
    order = np.lexsort((document, run, gram))
    gram, run = gram[order], run[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (run[1:] != run[:-1])
    found = np.zeros(int(new.sum()), RUN)
    found["gram"], found["run"], found["least"] = gram[new], run[new], document[order][new]
    return found


def _dealt(rows: np.ndarray, block: int, parts: int, first: int = 0) -> dict[str, pa.Array]:
    """One row per part, from ``first`` on, that the top bits of the gram name; ``rows`` are in the order of grams."""
    part = ((rows["gram"] >> np.uint64(16)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    bounds = np.searchsorted(part, np.arange(parts + 1))
    filled = np.flatnonzero(np.diff(bounds))
    return {"part": pa.array(filled + first, pa.int32()), "block": pa.array(np.full(len(filled), block), pa.int64()),
            "packed": pa.array([packed(rows[bounds[p]:bounds[p + 1]]) for p in filled], pa.binary())}


def _blobs(table: pa.Table, kind: np.dtype) -> tuple[np.ndarray, list[int]]:
    """The rows of all packed values, and how many each has."""
    data, offsets = text_buffer(table.column("packed"))
    held = [unpacked(data[a:b], kind) for a, b in zip(offsets[:-1], offsets[1:])]
    return (np.concatenate(held) if held else np.zeros(0, kind)), [len(h) for h in held]


def _parts(batches: Iterator[pa.RecordBatch], kind) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each part, its packed rows of type ``kind(part)`` and the block that each came from; batches come in the order of parts."""
    for table in whole_groups(batches, ["part"], 1):
        first = starts(table, ["part"])
        for a, b in zip(first, np.append(first[1:], table.num_rows)):
            some = table.slice(a, b - a)
            part = some.column("part")[0].as_py()
            rows, sizes = _blobs(some, kind(part))
            yield part, rows, np.repeat(some.column("block").to_numpy(), sizes)


def _answers(blocks: np.ndarray, answer: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((answer["run"], answer["gram"], blocks))
    blocks, answer = blocks[order], answer[order]
    first = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]])) if len(blocks) else np.zeros(0, np.int64)
    bounds = np.append(first, len(blocks))
    return pa.RecordBatch.from_arrays([
        pa.array(blocks[first], pa.int64()), pa.array([packed(answer[a:b]) for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())],
        names=["block", "packed"])


def _first_pass(rows: np.ndarray, block: np.ndarray, split_runs: int, wide_runs: int = WIDE_RUNS) -> pa.RecordBatch:
    """Order (gram, run) of one part; answer every block about runs that others hold or differ from."""
    order = np.lexsort((rows["least"], rows["run"], rows["gram"]))
    rows, block = rows[order], block[order]
    new_gram = np.ones(len(rows), bool)
    new_gram[1:] = rows["gram"][1:] != rows["gram"][:-1]
    new_run = new_gram.copy()
    new_run[1:] |= rows["run"][1:] != rows["run"][:-1]
    run_at = np.cumsum(new_run) - 1
    least = rows["least"][np.flatnonzero(new_run)][run_at]
    gram_at = np.cumsum(new_gram) - 1
    runs_per_gram = np.bincount(gram_at[new_run])[gram_at]
    copies = np.bincount(run_at)[run_at]
    # The block that holds the least document of a run sends its windows on where runs differ. Documents without an id
    # lie in several blocks; where a run's least is one, each of them needs the answer.
    holder = (new_run | (least == _LAST)) & (runs_per_gram > 1)
    sent = np.bincount(gram_at[holder], minlength=int(gram_at[-1]) + 1 if len(rows) else 0)[gram_at]
    kind = np.where(sent > wide_runs, WIDE, np.where(sent > split_runs, SPLIT, OPEN))
    tell = holder | (copies > 1)
    answer = np.zeros(int(tell.sum()), ANSWER)
    answer["gram"], answer["run"], answer["least"], answer["open"] = rows["gram"][tell], rows["run"][tell], least[tell], np.where(holder, kind, 0)[tell]
    return _answers(block[tell], answer)


def _second_pass(rows: np.ndarray, block: np.ndarray) -> pa.RecordBatch:
    """Order the windows of one part; answer which windows of a run's least document start in a smaller one."""
    masks = np.zeros(len(rows), np.uint64)
    order = np.argsort(rows["gram"], kind="stable")
    rows, block = rows[order], block[order]
    new = np.concatenate([[True], rows["gram"][1:] != rows["gram"][:-1]])
    bounds = np.append(np.flatnonzero(new), len(rows))
    first = 0
    while first < len(bounds) - 1:  # some groups at a time, to hold few windows at once
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + 10_000, "right")) - 1)
        some = rows[bounds[first]:bounds[last]]
        count = some["windows"].astype(np.int64)
        of = np.repeat(np.arange(len(some)), count)
        place = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        h, g = (row_hashes(some["bytes"], WINDOW, seed)[of, place] for seed in (11, 12))
        document = some["least"][of]
        ranked = np.lexsort((document, g, h))
        again = np.ones(len(ranked), bool)
        again[1:] = (h[ranked][1:] != h[ranked][:-1]) | (g[ranked][1:] != g[ranked][:-1])
        least = document[ranked][np.flatnonzero(again)][np.cumsum(again) - 1]
        goes = ranked[least < document[ranked]]
        np.bitwise_or.at(masks, of[goes] + bounds[first], np.uint64(1) << (place[goes] + some["first"][of[goes]]).astype(np.uint64))
        first = last
    some = masks != 0
    answer = np.zeros(int(some.sum()), ANSWER)
    answer["gram"], answer["run"], answer["least"], answer["mask"] = rows["gram"][some] ^ rows["turned"][some], rows["run"][some], rows["least"][some], masks[some]
    answer["open"] = MASKED
    return _answers(block[some], answer)


def _third_pass(rows: np.ndarray, block: np.ndarray) -> pa.RecordBatch:
    """Order the windows (as gram and run) of one part; answer the blocks in which a window's least document is not the least."""
    order = np.lexsort((rows["least"], rows["run"], rows["gram"]))
    rows, block = rows[order], block[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows["gram"][1:] != rows["gram"][:-1]) | (rows["run"][1:] != rows["run"][:-1])
    least = rows["least"][np.flatnonzero(new)][np.cumsum(new) - 1]
    some = least < rows["least"]
    answer = np.zeros(int(some.sum()), ANSWER)
    answer["gram"], answer["run"], answer["least"], answer["open"] = rows["gram"][some], rows["run"][some], least[some], SEEN
    return _answers(block[some], answer)


def _windows(data: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """Two hashes of every window of some runs, the run that it is of, and where it starts."""
    of = np.repeat(np.arange(len(start)), count)
    at = start[of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    h, g = (Hashes(data, seed).of(at, at + WINDOW) >> np.uint64(16) for seed in (11, 12))
    return h, g, of, at


def _told(answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Answers of all passes about one block (runs, masks, single windows), each in the order of runs."""
    told, _ = _blobs(answers, ANSWER)
    told = told[np.lexsort((told["gram"], told["run"]))]
    masked = told[told["open"] == MASKED]
    if len(masked):  # both halves of a run may have been told
        first = np.concatenate([[True], (masked["run"][1:] != masked["run"][:-1]) | (masked["gram"][1:] != masked["gram"][:-1])])
        whole = np.bitwise_or.reduceat(masked["mask"], np.flatnonzero(first))
        masked = masked[first]
        masked["mask"] = whole
    return told[(told["open"] != MASKED) & (told["open"] != SEEN)], masked, told[told["open"] == SEEN]


def _look_up(told: np.ndarray, gram: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every gram and run, whether there is an answer and where; ``told`` is in the order of runs, then grams."""
    if not len(told):
        return np.zeros(len(run), bool), np.zeros(len(run), np.int64)
    at = np.minimum(np.searchsorted(told["run"], run), len(told) - 1)
    while True:  # runs of one hash around different grams are few
        other = (told["run"][at] == run) & (told["gram"][at] < gram) & (at < len(told) - 1)
        if not other.any():
            break
        at = at + other
    return (told["run"][at] == run) & (told["gram"][at] == gram), at


def _block_runs(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray, tuple[np.ndarray, ...]]]:
    for first, data, offsets in _pieces(table.column("text")):
        yield first, data, offsets, runs_of(data, offsets)


def repeated_windows(docs: DataFrame, digest_only: bool = True, block_bytes: int = BLOCK_BYTES,
                     keep: list[str] | None = None, split_runs: int = SPLIT_RUNS,
                     wide_runs: int = WIDE_RUNS) -> DataFrame:
    """The columns ``keep`` (doc_id alone by default) as struct ``row`` with ``n_bytes, n_removed, n_spans, kept_sha256``, ``kept``.

    The digest is that of the remaining bytes; ``kept`` is their text without what is left of characters
    that a cut went through, or null with ``digest_only``.
    """
    spark = docs.sparkSession
    read = docs.select(F.struct(*[docs[c] for c in keep or ["doc_id"]]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    total = read.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = PARTS_PER_PARTITION * partitions
    dealt = read.withColumn("block", F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(blocks)))

    def documents(table: pa.Table) -> np.ndarray:
        return table.column("doc_id").fill_null(_LAST).to_numpy()

    def send_runs(table: pa.Table) -> pa.Table:
        ids = documents(table)
        held = [_least(gram, run, ids[first + row]) for first, _, _, (_, _, row, gram, run, _) in _block_runs(table)]
        held = np.concatenate(held) if held else np.zeros(0, RUN)
        give_back()
        return pa.table(_dealt(_least(held["gram"], held["run"], held["least"]), table.column("block")[0].as_py(), parts))

    def send_windows(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"part": pa.array([], pa.int32()), "block": pa.array([], pa.int64()), "packed": pa.array([], pa.binary())})
        ids, (told, _, _) = documents(table), _told(answers)
        told = told[told["open"] != 0]
        held, single = [], []
        for first, data, _, (start, count, row, gram, run, spot) in _block_runs(table):
            there, at = _look_up(told, gram, run)
            there[there] = told["least"][at[there]] == ids[first + row[there]]
            if not there.any():
                continue
            split, wide = (told["open"][at[there]] == kind for kind in (SPLIT, WIDE))
            start, count, row, gram, run, spot = (x[there] for x in (start, count, row, gram, run, spot))
            if wide.any():
                h, g, of, _ = _windows(data, start[wide], count[wide])
                single.append(_least(h, g, ids[first + row[wide]][of]))
            # Windows that begin early enough hold the bytes before the gram, the others those after it.
            early = np.clip(spot - BESIDE + 1 - start, 0, count)
            hashes = Hashes(data)
            for chosen, skipped, windows, key in (
                    (~split & ~wide, np.zeros_like(count), count, None), (split & (early > 0), np.zeros_like(count), early, (-BESIDE, 0)),
                    (split & (early < count), early, count - early, (GRAM, GRAM + BESIDE))):
                if not chosen.any():
                    continue
                a, n, g = start[chosen] + skipped[chosen], windows[chosen], gram[chosen]
                whole = g
                if key:
                    g = mix(g ^ hashes.of(spot[chosen] + key[0], spot[chosen] + key[1])) >> np.uint64(16)
                some = np.zeros(len(a), CONTEXT)
                some["gram"], some["turned"], some["run"], some["least"], some["first"], some["windows"] = g, g ^ whole, run[chosen], ids[first + row[chosen]], skipped[chosen], n
                inside = np.arange(LONGEST) < (n + WINDOW - 1)[:, None]
                some["bytes"] = np.where(inside, data[np.minimum(a[:, None] + np.arange(LONGEST), len(data) - 1)], 0)
                held.append(some)
        held = np.concatenate(held) if held else np.zeros(0, CONTEXT)
        held = held[np.lexsort((held["first"], held["run"], held["gram"]))]
        if len(held):
            held = held[np.concatenate([[True], (held["run"][1:] != held["run"][:-1]) | (held["gram"][1:] != held["gram"][:-1]) | (held["first"][1:] != held["first"][:-1])])]
        single = np.concatenate(single) if single else np.zeros(0, RUN)
        single = _least(single["gram"], single["run"], single["least"])
        give_back()
        block = table.column("block")[0].as_py()
        return pa.concat_tables([pa.table(_dealt(held, block, parts)), pa.table(_dealt(single, block, parts, parts))])

    def judge(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"row": table.column("row"), **{name: pa.array([], kind) for name, kind in result}})
        ids, (told, masked, seen) = documents(table), _told(answers)
        wide = told[told["open"] == WIDE]

        def single_windows(first: int, data: np.ndarray, start, count, row, gram, run) -> tuple[np.ndarray, ...]:
            there, at = _look_up(wide, gram, run)
            there[there] = wide["least"][at[there]] == ids[first + row[there]]
            h, g, of, at = _windows(data, start[there], count[there])
            return h, g, ids[first + row[there]][of], at

        found: dict[str, list] = {name: [] for name, _ in result}
        # Runs that this block alone holds are no answer: within it, the least document counts.
        own, single = [], []
        for first, data, _, (start, count, row, gram, run, _) in _block_runs(table):
            own.append(_least(gram, run, ids[first + row]))
            if len(wide):
                single.append(_least(*single_windows(first, data, start, count, row, gram, run)[:3]))
        single = np.concatenate(single) if single else np.zeros(0, RUN)
        single = _least(single["gram"], single["run"], single["least"])
        single = single[np.lexsort((single["gram"], single["run"]))]
        there, at = _look_up(seen, single["gram"], single["run"])
        single["least"][there] = seen["least"][at[there]]
        own = np.concatenate(own) if own else np.zeros(0, RUN)
        own = _least(own["gram"], own["run"], own["least"])
        own = own[np.lexsort((own["gram"], own["run"]))]
        for first, data, offsets, (start, count, row, gram, run, _) in _block_runs(table):
            document = ids[first + row]
            least = own["least"][_look_up(own, gram, run)[1]] if len(own) else document
            there, at = _look_up(told, gram, run)
            least = np.where(there, told["least"][at] if len(told) else least, least)
            change = np.zeros(len(data) + 1, np.int64)
            whole = least < document
            np.add.at(change, start[whole], 1)
            np.add.at(change, start[whole] + count[whole] + WINDOW - 1, -1)
            there, at = _look_up(masked, gram, run)
            there[there] = masked["least"][at[there]] == document[there]
            for place in range(_SPAN):
                bit = there.copy()
                bit[there] = (masked["mask"][at[there]] >> np.uint64(place)) & np.uint64(1) == 1
                if bit.any():
                    np.add.at(change, start[bit] + place, 1)
                    np.add.at(change, start[bit] + place + WINDOW, -1)
            if len(wide):
                h, g, of, at = single_windows(first, data, start, count, row, gram, run)
                at = at[single["least"][_look_up(single, h, g)[1]] < of] if len(of) else at
                np.add.at(change, at, 1)
                np.add.at(change, at + WINDOW, -1)
            gone = np.cumsum(change[:-1]) > 0
            edge = gone.copy()
            edge[1:] &= ~gone[:-1]
            begins = offsets[:-1][np.diff(offsets) > 0]
            edge[begins] = gone[begins]
            removed = np.concatenate([[0], np.cumsum(gone)])
            spans = np.concatenate([[0], np.cumsum(edge)])
            for k in range(len(offsets) - 1):
                a, b = offsets[k], offsets[k + 1]
                kept = data[a:b][~gone[a:b]].tobytes() if removed[b] > removed[a] else data[a:b].tobytes()
                found["n_bytes"].append(int(b - a))
                found["n_removed"].append(int(removed[b] - removed[a]))
                found["n_spans"].append(int(spans[b] - spans[a]))
                found["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                found["kept"].append(None if digest_only else kept.decode("utf-8", "ignore"))
        give_back()
        return pa.table({"row": table.column("row"), **{name: pa.array(found[name], kind) for name, kind in result}})

    result = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
              ("kept_sha256", pa.string()), ("kept", pa.string())]
    packed_rows = "part int, block long, packed binary"
    schema = read.select("row").schema
    for name, kind in (("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string"), ("kept", "string")):
        schema = schema.add(name, kind)

    def ordered(rows: DataFrame, kind: np.dtype, judge_part) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # Parts from ``parts`` on are of single windows.
            for part, held, block in _parts(batches, lambda part: kind if part < parts else RUN):
                yield (judge_part if part < parts else _third_pass)(held, block)

        return rows.repartition(partitions, "part").sortWithinPartitions("part").mapInArrow(tidy(run), "block long, packed binary")

    first = ordered(dealt.groupBy("block").applyInArrow(send_runs, packed_rows), RUN, lambda rows, block: _first_pass(rows, block, split_runs, wide_runs))
    second = ordered(dealt.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(send_windows, packed_rows), CONTEXT, _second_pass)
    return dealt.groupBy("block").cogroup(first.union(second).groupBy("block")).applyInArrow(
        judge, schema)
