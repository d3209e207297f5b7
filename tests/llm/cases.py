"""Small tables with every awkward case, and plain Python that says what the operators should find."""

import hashlib
import re

from pyspark.sql import types as T

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Columns whose names the operators use inside, with values that must come through.
EXTRA = ("size", "score", "row", "block", "part", "s1", "names", "component", "rank", "target", "_key", "_y", "_copy", "_digest", "_no_text", "_text", "_in0", "copy",
         "digest", "other", "kept", "_source", "_id", "_pieces")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                       *[T.StructField(name, T.StringType()) for name in EXTRA]])
PASSAGE = "a passage of well over fifty bytes that several of the documents here have in common, word for word"
LONG = " ".join(f"word{k % 977} stands{k}" for k in range(20_000))


def sentence(seed, n):
    return " ".join(f"w{(seed * 7919 + k * k * 31 + k) % 5003}" for k in range(n))


def rows():
    near = sentence(5, 200).split()
    texts = [
        (1, sentence(1, 120)), (2, None), (3, ""), (4, " \t\n "), (5, LONG), (6, sentence(1, 120)), (7, f"first {PASSAGE} end"),
        (8, f"{PASSAGE}"), (9, f"ünï çode {PASSAGE[:60]} ñandú {PASSAGE}"), (10, "three words only"), (11, "THREE words ONLY"), (12, "one"),
        (13, " ".join(near)), (14, " ".join(near[:-4] + ["other", "ending", "to", "it"])), (15, " ".join(near[:100])), (16, "x" * 700 + "\U0001F600" * 90),
        (17, "Is it under the MIT License? Apache License, Version 2.0; CC BY-NC 4.0 and GPLv3 licence."), (17, "a second text of one id"),
        (18, "  12 3 456!? it's we'll\r\n\r\n  tabs\tand   spaces    end "), (18, "  12 3 456!? it's we'll\r\n\r\n  tabs\tand   spaces    end "),
        (None, f"no id {PASSAGE}"), (None, None), (19, LONG + " " + PASSAGE), (20, "aaaa" * 100), (21, "aaaa" * 100),
    ]
    return [(i, t, "en", None if (i or 0) % 5 == 0 else f"src{(i or 0) % 3}", None if t is None else len(t), *["clash"] * len(EXTRA)) for i, t in texts]


def documents(spark, some=None, cut=3):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA).repartition(cut)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def windows(docs, size=50):
    """(doc_id, n_bytes, n_removed, n_spans, digest) of every (doc_id, text)."""
    held = [(i, (t or "").encode()) for i, t in docs]
    rank = lambda i: float("inf") if i is None else i
    least = {}
    for i, b in held:
        for k in range(len(b) - size + 1):
            w = b[k:k + size]
            least[w] = min(least.get(w, float("inf")), rank(i))
    found = []
    for i, b in held:
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if least[b[k:k + size]] < rank(i):
                gone[k:k + size] = b"\x01" * size
        kept = bytes(x for x, g in zip(b, gone) if not g)
        found.append((i, len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return found


def shingle_sets(docs, size=4):
    found = []
    for i, t in docs:
        w = re.findall("[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        found.append((i, frozenset([tuple(w)] if 0 < len(w) < size else [tuple(w[k:k + size]) for k in range(len(w) - size + 1)])))
    return found


def components(docs, percent=85):
    """(doc_id, size of the set, least doc_id linked) of every (doc_id, text)."""
    sets = shingle_sets(docs)
    label = list(range(len(sets)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for x, (_, a) in enumerate(sets):
        for y, (_, b) in enumerate(sets[:x]):
            if a and b and None not in (sets[x][0], sets[y][0]) and 100 * len(a & b) >= percent * len(a | b):
                label[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[find(x)] = min(least.get(find(x), i), i)
    # Rows without an id only follow an equal set.
    equal = {s: least[find(x)] for x, (i, s) in enumerate(sets) if i is not None}
    return [(i, len(s), (least[find(x)] if i is not None else equal.get(s)) if s else i) for x, (i, s) in enumerate(sets)]
