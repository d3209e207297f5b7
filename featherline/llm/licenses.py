"""License scan: ordered signature rules behind a keyword gate, with priorities and suppression.

Texts are taken as words (digits, a-z after lower-casing A-Z, and every non-ASCII character). A rule is a
regular expression over the words joined by single spaces; it can only match where the words of its gate
occur, and those are found by hash over all words of a batch, so most texts never meet an expression.

Detections are intervals of words. They are taken by priority, then length, then place; one that lies
within an interval taken before is suppressed. Detections of the base phrases are never suppressed.

A null or empty text has no words, no detection, empty labels and the score 0; otherwise the score is the
highest relevance among the detections that stand. Equal texts get equal results, rows that repeat
a row each, an empty table none. A very long text is scanned whole, in n log n steps of its detections. Other columns of the
input, whatever their names, only pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from featherline.llm.spans import LOWER, PLAIN_WORDS, Hashes, per_row, pieces, text_buffer, words
from featherline.llm.tasks import tidy

#: Fixed phrases and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: label, word that every mention has, expression of the name (words joined by single spaces).
NAMES = (
    ("mit", "mit", r"(?:the )?mit"), ("mit-0", "mit", r"mit (?:0|no attribution)"),
    ("x11", "x11", r"(?:the )?x11"), ("isc", "isc", r"(?:the )?isc"),
    ("apache-2", "apache", r"(?:the )?apache(?: software)?(?: license)?(?: version)? 2(?: 0)?"),
    ("apache-1.1", "apache", r"(?:the )?apache(?: software)?(?: license)?(?: version)? 1 1"),
    ("bsd-2", "bsd", r"(?:the )?(?:simplified bsd|bsd 2 clause|2 clause bsd)"), ("bsd-2", "freebsd", r"(?:the )?freebsd"),
    ("bsd-3", "bsd", r"(?:the )?(?:new bsd|revised bsd|modified bsd|bsd 3 clause|3 clause bsd)"),
    ("bsd-4", "bsd", r"(?:the )?(?:original bsd|bsd 4 clause|4 clause bsd)"), ("0bsd", "0bsd", r"(?:the )?0bsd"),
    ("gpl-1", "gpl", r"(?:the )?(?:gnu )?gpl (?:version |v )?v?1(?: 0)?(?: only| or later)?"),
    ("gpl-2", "gpl", r"(?:the )?(?:gnu )?gpl (?:version |v )?v?2(?: 0)?(?: only| or later)?"),
    ("gpl-3", "gpl", r"(?:the )?(?:gnu )?gpl (?:version |v )?v?3(?: 0)?(?: only| or later)?"),
    ("gpl-2", "gnu", r"(?:the )?gnu general public(?: license)? (?:version |v )2(?: 0)?"),
    ("gpl-3", "gnu", r"(?:the )?gnu general public(?: license)? (?:version |v )3(?: 0)?"),
    ("gpl", "gnu", r"(?:the )?gnu general public"), ("gpl", "gpl", r"(?:the )?(?:gnu )?gpl"),
    ("lgpl-2.1", "lgpl", r"(?:the )?(?:gnu )?lgpl (?:version |v )?v?2 1(?: only| or later)?"),
    ("lgpl-3", "lgpl", r"(?:the )?(?:gnu )?lgpl (?:version |v )?v?3(?: 0)?(?: only| or later)?"),
    ("gpl-2", "gplv2", r"(?:the )?(?:gnu )?gplv2(?: only| or later)?"), ("gpl-3", "gplv3", r"(?:the )?(?:gnu )?gplv3(?: only| or later)?"),
    ("lgpl-3", "lgplv3", r"(?:the )?(?:gnu )?lgplv3(?: only| or later)?"), ("agpl-3", "agplv3", r"(?:the )?(?:gnu )?agplv3(?: only| or later)?"),
    ("lgpl", "gnu", r"(?:the )?gnu (?:lesser|library) general public"), ("lgpl", "lgpl", r"(?:the )?(?:gnu )?lgpl"),
    ("agpl-3", "agpl", r"(?:the )?(?:gnu )?agpl (?:version |v )?v?3(?: 0)?(?: only| or later)?"),
    ("agpl", "gnu", r"(?:the )?gnu affero general public"), ("gfdl", "gnu", r"(?:the )?gnu free documentation"),
    ("mpl-1.1", "mozilla", r"(?:the )?mozilla public(?: license)?(?: version)? 1 1"),
    ("mpl-2", "mozilla", r"(?:the )?mozilla public(?: license)?(?: version)? 2(?: 0)?"), ("mpl-2", "mpl", r"(?:the )?mpl 2 0"),
    ("epl-1", "eclipse", r"(?:the )?eclipse public(?: license)?(?: version| v)? 1(?: 0)?"),
    ("epl-2", "eclipse", r"(?:the )?eclipse public(?: license)?(?: version| v)? 2(?: 0)?"), ("epl-2", "epl", r"(?:the )?epl 2 0"),
    ("edl-1", "eclipse", r"(?:the )?eclipse distribution"), ("cddl-1", "cddl", r"(?:the )?cddl(?: version)? 1(?: [01])?"),
    ("cddl-1", "common", r"(?:the )?common development and distribution"), ("cpl-1", "common", r"(?:the )?common public(?: license)?(?: version)? 1(?: 0)?"),
    ("boost-1", "boost", r"(?:the )?boost software"), ("boost-1", "bsl", r"(?:the )?bsl 1 0"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"), ("wtfpl", "wtfpl", r"(?:the )?wtfpl"), ("zlib", "zlib", r"(?:the )?zlib(?: libpng)?"),
    ("artistic-1", "artistic", r"(?:the )?artistic(?: license)?(?: version)? 1(?: 0)?"),
    ("artistic-2", "artistic", r"(?:the )?artistic(?: license)?(?: version)? 2(?: 0)?"),
    ("psf-2", "python", r"(?:the )?python(?: software foundation)?(?: license)?(?: version)? 2(?: 0)?"),
    ("php-3", "php", r"(?:the )?php(?: license)?(?: version)? 3(?: 01| 0)?"), ("ruby", "ruby", r"(?:the )?ruby"),
    ("openssl", "openssl", r"(?:the )?openssl"), ("curl", "curl", r"(?:the )?curl"), ("ncsa", "ncsa", r"(?:the )?(?:university of illinois )?ncsa"),
    ("postgresql", "postgresql", r"(?:the )?postgresql"), ("eupl-1.2", "eupl", r"(?:the )?eupl(?: version| v)? 1 2"),
    ("eupl-1.2", "european", r"(?:the )?european union public"), ("ms-pl", "microsoft", r"(?:the )?microsoft public"),
    ("ms-rl", "microsoft", r"(?:the )?microsoft reciprocal"), ("upl-1", "universal", r"(?:the )?universal permissive"),
    ("ofl-1.1", "ofl", r"(?:the )?(?:sil )?ofl(?: version)? 1 1"), ("ofl-1.1", "sil", r"(?:the )?sil open font"),
    ("sspl-1", "sspl", r"(?:the )?sspl(?: version| v)? v?1"), ("sspl-1", "side", r"(?:the )?server side public"),
    ("busl-1.1", "business", r"(?:the )?business source(?: license)? 1 1"), ("elastic-2", "elastic", r"(?:the )?elastic(?: license)? 2(?: 0)?"),
    ("odbl-1", "odbl", r"(?:the )?odbl"), ("odbl-1", "database", r"(?:the )?open database"), ("afl-3", "academic", r"(?:the )?academic free"),
    ("osl-3", "open", r"(?:the )?open software"), ("ecl-2", "educational", r"(?:the )?educational community"),
)
#: label, gate, priority, relevance, expression with {} for the name.
MENTIONS = (
    (90, 1.0, r"spdx license identifier {}"), (80, 0.95, r"(?:licensed|released|distributed|available|published) under(?: the terms of)? {}"),
    (70, 0.9, r"{} (?:license|licence)"), (60, 0.8, r"(?:license|licence)(?: is| name| type)? {}"),
    (50, 0.7, r"opensource org (?:license|licenses) {}"), (65, 0.85, r"subject to(?: the terms of)? {}(?: license| licence)"),
)
#: Creative Commons terms: label, words after the family name.
CC_TERMS = (("cc-by", "by", "attribution"), ("cc-by-sa", "by sa", "attribution share ?alike"), ("cc-by-nc", "by nc", "attribution non ?commercial"),
            ("cc-by-nd", "by nd", "attribution no ?deriv(?:ative)?s?"), ("cc-by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
            ("cc-by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?"), ("cc0", "zero", "zero"))
#: label, gate, priority, relevance, expression: sentences of the licenses themselves.
SENTENCES = (
    ("mit", "charge", 75, 0.9, r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("bsd", "redistribution", 75, 0.8, r"redistribution and use in source and binary forms with or without modification"),
    ("isc", "permission", 75, 0.85, r"permission to use copy modify and or distribute this software for any purpose"),
    ("apache-2", "apache", 85, 1.0, r"(?:http|https) www apache org licenses license 2 0"),
    ("public-domain", "domain", 60, 0.7, r"(?:released|dedicated|placed) (?:to|in|into) the public domain"),
    ("zlib", "warranty", 75, 0.85, r"provided as is without any express or implied warranty"),
    ("unlicense", "unencumbered", 75, 0.95, r"free and unencumbered software released into the public domain"),
    ("cc0", "cc0", 72, 0.95, r"cc0(?: 1 0)?"),
    ("proprietary", "reserved", 40, 0.4, r"all rights reserved"),
)
BASE_PRIORITY, BASE_RELEVANCE = 100, 1.0


@dataclass(frozen=True)
class Rule:
    label: str
    gate: str
    priority: int
    relevance: float
    expression: str


def _rules() -> tuple[Rule, ...]:
    found = [Rule(label, phrase.split()[0] if phrase.startswith("cc") else phrase.split()[-2] if "mit" in phrase else "apache",
                  BASE_PRIORITY, BASE_RELEVANCE, phrase) for phrase, label in BASE]
    for label, gate, name in NAMES:
        found += [Rule(label, gate, priority, relevance, form.format(name)) for priority, relevance, form in MENTIONS]
    for k, (label, short, long) in enumerate(CC_TERMS):
        extra = len(short.split())
        found += [Rule(label, "cc", 70 + extra, 0.9, rf"cc {short}(?: [1-4] [05])?"), Rule(label, "creative", 70 + extra, 0.95, rf"creative commons {long}"),
                  Rule(label, "creativecommons", 85 + extra, 1.0, rf"creativecommons org (?:licenses|publicdomain) {short}")]
    found += [Rule(*s) for s in SENTENCES]
    return tuple(found)


RULES = _rules()


@cache
def _compiled() -> tuple[dict[str, list[int]], list[re.Pattern], np.ndarray, list[str]]:
    """Rules by gate, their expressions, and the hashes of the gate words in order."""
    by_gate: dict[str, list[int]] = {}
    for k, rule in enumerate(RULES):
        by_gate.setdefault(rule.gate, []).append(k)
    expressions = [re.compile(rf"(?<![^ ]){rule.expression}(?![^ ])") for rule in RULES]
    gates = sorted(by_gate)
    data, offsets = text_buffer(pa.array(gates))
    hashes = Hashes(data).of(offsets[:-1], offsets[1:])
    order = np.argsort(hashes)
    return by_gate, expressions, hashes[order], [gates[k] for k in order]


def detections(text: str, gates: set[str]) -> list[tuple[int, int, int]]:
    """(first word, word after the last, rule) of what stands in ``text``, words joined by single spaces."""
    by_gate, expressions, _, _ = _compiled()
    blanks = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 32)
    found = []
    for gate in gates:
        for k in by_gate[gate]:
            spans = [match.span() for match in expressions[k].finditer(text)]
            if spans:  # the words of a place are the blanks before it
                first, last = np.searchsorted(blanks, np.array(spans)).T
                found += [(a, b + 1, k) for a, b in zip(first.tolist(), last.tolist())]
    found.sort(key=lambda d: (-RULES[d[2]].priority, d[0] - d[1], d[0], d[2]))
    covers = Covers([d[0] for d in found])
    standing: list[tuple[int, int, int]] = []
    for first, end, k in found:
        if k < len(BASE) or covers.last_end(first) < end:
            standing.append((first, end, k))
            covers.add(first, end)
    return standing


class Covers:
    """Intervals, for whether one contains another: the largest end of those that begin by a place, in log n steps."""

    def __init__(self, starts: list[int]):
        self.place = {start: k for k, start in enumerate(sorted(set(starts)), 1)}
        self.ends = [0] * (len(self.place) + 1)

    def add(self, start: int, end: int) -> None:
        k = self.place[start]
        while k < len(self.ends):
            self.ends[k] = max(self.ends[k], end)
            k += k & -k

    def last_end(self, start: int) -> int:
        k, end = self.place[start], 0
        while k:
            end = max(end, self.ends[k])
            k -= k & -k
        return end


_OTHER = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RESULT = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<struct<first_word:long,end_word:long,label:string,rule:int>>"


def _scan(piece: pa.RecordBatch) -> Iterator[dict]:
    _, _, gate_hashes, gate_names = _compiled()
    data, offsets = text_buffer(piece.column("_text"))
    data = LOWER[data]
    start, end, row = words(data, offsets, PLAIN_WORDS)
    counts = per_row(row, piece.num_rows)
    hashes = Hashes(data).of(start, end)
    at = np.minimum(np.searchsorted(gate_hashes, hashes), len(gate_hashes) - 1)
    hit = gate_hashes[at] == hashes
    gates: dict[int, set[str]] = {}
    for r, g in set(zip(row[hit].tolist(), at[hit].tolist())):
        gates.setdefault(r, set()).add(gate_names[g])
    for k in range(piece.num_rows):
        standing = []
        if k in gates:
            text = _OTHER.sub(" ", data[offsets[k]:offsets[k + 1]].tobytes().decode("utf-8", "replace")).strip(" ")
            standing = detections(text, gates[k])
        base = [d for d in standing if d[2] < len(BASE)]
        yield {
            "n_words": int(counts[k]), "n_base": len(base),
            "first_word": min((d[0] for d in base), default=None), "last_word": max((d[0] for d in base), default=None),
            "base_labels": ",".join(sorted({RULES[d[2]].label for d in base})),
            "labels": ",".join(sorted({RULES[d[2]].label for d in standing})),
            "score": max((RULES[d[2]].relevance for d in standing), default=0.0),
            "detections": [{"first_word": a, "end_word": b, "label": RULES[r].label, "rule": r} for a, b, r in sorted(standing)],
        }


def scan(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) as struct ``row`` beside what was found in ``text``."""
    read = docs.select(F.struct(*[docs[c] for c in keep or docs.columns]).alias("row"), F.coalesce(docs["text"], F.lit("")).alias("_text"))
    spark = docs.sparkSession
    schema = read.select("row").schema
    for field in spark.createDataFrame([], RESULT).schema:
        schema = schema.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(),
                 "labels": pa.string(), "score": pa.float64(),
                 "detections": pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("label", pa.string()), ("rule", pa.int32())]))}
        for batch in batches:
            found = [x for piece in pieces(batch, "_text") for x in _scan(piece)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([x[name] for x in found], kind) for name, kind in kinds.items()]], names=["row", *kinds])

    return read.mapInArrow(tidy(run), schema)
