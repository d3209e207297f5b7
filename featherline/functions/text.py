"""LibSVM and CSV text: encoding as expressions inside the JVM, LibSVM decoding over Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F, types as T

from featherline.functions import vectors

# Content types of the row formats (fixed values).
TEXT_LIBSVM = "text/x-libsvm"
TEXT_CSV = "text/csv"
RECORDS = "application/x-recordio-protobuf"

REAL = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|NaN|Infinity)$"
INTEGER = r"^[+-]?\d{1,18}$"


def libsvm_line(features: Column, label: Column | None = None) -> Column:
    """``label index:value ...`` with 1-based indices and a newline.

    Dense vectors write every entry, sparse vectors their stored ones. Without a label, 0.0 is written.
    """
    raw = F.unwrap_udt(features)
    values = raw["values"]
    dense = F.transform(values, lambda x, i: F.concat(F.lit(" "), (i + 1).cast("string"), F.lit(":"), x.cast("string")))
    sparse = F.zip_with(
        raw["indices"],
        values,
        lambda i, x: F.concat(F.lit(" "), (i + 1).cast("string"), F.lit(":"), x.cast("string")),
    )
    entries = F.when(raw["type"] == 0, sparse).otherwise(dense)
    head = (F.lit(0.0) if label is None else label.cast("double")).cast("string")
    return F.concat(head, F.array_join(entries, ""), F.lit("\n"))


def csv_line(features: Column) -> Column:
    """All entries of a vector, zeros included, joined by commas, with a newline."""
    cells = F.transform(vectors.to_array(features), lambda x: x.cast("string"))
    return F.concat(F.array_join(cells, ","), F.lit("\n"))


def without_zeros(entries: Column) -> Column:
    """Drop explicit zeros from an array of ``{index, value}`` structs, comparing numbers."""
    return F.filter(entries, lambda e: e["value"] != 0)


def _numbers(texts: pa.Array, pattern: str, kind: pa.DataType, strip: str = "") -> tuple[np.ndarray, np.ndarray]:
    """Parsed numbers (0 where malformed) and which texts were well-formed; ``strip`` may come first."""
    good = pc.fill_null(pc.match_substring_regex(texts, pattern), False)
    texts = pc.utf8_ltrim(texts, strip) if strip else texts
    numbers = pc.if_else(good, texts, pa.scalar("0")).cast(kind)
    return numbers.to_numpy(zero_copy_only=False), good.to_numpy(zero_copy_only=False)


def libsvm_batch(lines: pa.Array, dim: int) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Labels, sparse vectors and which lines are well-formed, for an Arrow column of lines."""
    tokens = pc.split_pattern(pc.fill_null(lines, ""), " ")
    per_line = tokens.value_lengths().to_numpy(zero_copy_only=False)
    flat = tokens.flatten()
    owner = np.repeat(np.arange(len(lines)), per_line)
    head = np.zeros(len(flat), bool)
    head[vectors.starts_of(per_line)] = True
    labels, good = _numbers(flat.filter(pa.array(head)), REAL, pa.float64())
    entry = ~head & pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    pairs, owner = flat.filter(pa.array(entry)), owner[entry]
    parts = pc.split_pattern(pairs, ":", max_splits=1)
    whole = pc.equal(parts.value_lengths(), 2)
    parts = pc.if_else(whole, parts, pa.scalar(["", ""], parts.type))
    index, index_good = _numbers(pc.list_element(parts, 0), INTEGER, pa.int64(), strip="+")
    value, value_good = _numbers(pc.list_element(parts, 1), REAL, pa.float64())
    index = index - 1
    fine = index_good & value_good & (index >= 0) & (index < dim)
    # Within a line, each index must be above the one before.
    fine[1:] &= (owner[1:] != owner[:-1]) | (index[1:] > index[:-1])
    good &= np.bincount(owner, weights=~fine, minlength=len(lines)) == 0
    kept = good[owner]
    counts = np.bincount(owner[kept], minlength=len(lines))
    column = vectors.sparse_column(np.full(len(lines), dim), counts, index[kept], value[kept])
    return pa.array(labels, mask=~good), column, good


def parse_libsvm(lines: DataFrame, dim: int, line: str = "value", mode: str = "FAILFAST",
                 label: str = "label", features: str = "features", bad_row: str = "bad_row") -> DataFrame:
    """Replace a text column of LibSVM lines by a label and a sparse vector of size ``dim``.

    ``FAILFAST`` stops on a malformed line. ``PERMISSIVE`` keeps it with null label and features
    and the text in ``bad_row``.
    """
    if dim < 0:
        raise ValueError("vector dimension must not be negative")
    if mode not in ("FAILFAST", "PERMISSIVE"):
        raise ValueError(f"unknown mode {mode}")
    strict = mode == "FAILFAST"
    schema = T.StructType().add("label", T.DoubleType()).add("features", VectorUDT()).add("good", T.BooleanType())

    @F.arrow_udf(schema)
    def parse(column: pa.Array) -> pa.Array:
        labels, features, good = libsvm_batch(column, dim)
        if strict and not good.all():
            raise ValueError(f"malformed line: {column[int(np.argmin(good))].as_py()!r}")
        return pa.StructArray.from_arrays([labels, features, pa.array(good)], names=schema.fieldNames())

    rest = [c for c in lines.columns if c not in (line, label, features, bad_row)]
    parsed = lines.select(*rest, F.col(line).alias("_line"), parse(F.col(line)).alias("_parsed"))
    good = F.col("_parsed.good")
    columns = [*rest, F.col("_parsed.label").alias(label)]
    if strict:
        return parsed.select(*columns, F.col("_parsed.features").alias(features))
    return parsed.select(
        *columns,
        F.when(good, F.col("_parsed.features")).alias(features),
        F.when(~good, F.col("_line")).alias(bad_row),
    )


def csv_numbers(responses: DataFrame, body: str = "body", prediction: str = "prediction") -> DataFrame:
    """One row per number of a comma-separated body, with its position; a bad number fails."""
    rest = [c for c in responses.columns if c != body]
    cells = F.split(F.btrim(F.col(body), F.lit(" \t\r\n")), ",", -1)
    exploded = responses.select(*rest, F.posexplode(cells).alias("position", "_cell"))
    value = F.col("_cell").try_cast("double")
    strict = F.when(value.isNull(), F.raise_error(F.concat(F.lit("not a number: "), "_cell"))).otherwise(value)
    return exploded.select(*rest, "position", strict.alias(prediction))
