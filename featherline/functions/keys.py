"""Predicates and parts of object keys and URIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Characters that may follow a run's prefix in its own keys (fixed values).
OWNING_DELIMITERS = ("/", ".", "_")
# File names that mark folders and finished writes (fixed values).
FOLDER_MARKER = "$folder$"
SUCCESS_MARKER = "_SUCCESS"


def is_marker(name: Column) -> Column:
    return name.endswith(FOLDER_MARKER) | (name == SUCCESS_MARKER)


def owned_by(key: Column, prefix: Column | str) -> Column:
    """Whether ``key`` is the prefix itself or continues it with a delimiter."""
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    after = F.substring(key, F.length(prefix) + 1, F.lit(1))
    return (key == prefix) | (key.startswith(prefix) & after.isin(*OWNING_DELIMITERS))


def owners(keys: DataFrame, prefixes: DataFrame, key: str = "key", prefix: str = "prefix") -> DataFrame:
    """Every (key, prefix) pair where the prefix owns the key, by an equi-join.

    A key can only be owned by itself or by a part of it that ends before a delimiter. Those
    candidates are as many as the key has delimiters, so no key meets all prefixes.
    """
    cuts = F.filter(
        F.sequence(F.lit(1), F.length(key)),
        lambda i: F.substring(F.col(key), i, F.lit(1)).isin(*OWNING_DELIMITERS),
    )
    candidates = F.array_distinct(
        F.concat(F.array(F.col(key)), F.transform(cuts, lambda i: F.substring(F.col(key), F.lit(1), i - 1)))
    )
    exploded = keys.withColumn("_candidate", F.explode(candidates))
    return exploded.join(prefixes, exploded["_candidate"] == prefixes[prefix]).drop("_candidate")


# Scheme, authority and path of a URI; an authority may hold underscores, which host names may not.
URI = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)(?:/([^?#]*))?"


def uri_bucket(uri: Column) -> Column:
    return F.nullif(F.regexp_extract(uri, URI, 2), F.lit(""))


def uri_key(uri: Column) -> Column:
    """The path without its first slash, percent signs decoded; a plus sign stays."""
    raw = F.regexp_extract(uri, URI, 3)
    return F.coalesce(F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), raw)


def is_object_uri(uri: Column) -> Column:
    """Whether the URI names an object in a bucket store, by its scheme."""
    return F.coalesce(F.regexp_extract(uri, URI, 1).startswith("s3") & uri_bucket(uri).isNotNull(), F.lit(False))


def split_object_uri(uri: Column) -> Column:
    """``struct<bucket, key>``; any other scheme fails."""
    parts = F.struct(uri_bucket(uri).alias("bucket"), uri_key(uri).alias("key"))
    return F.when(is_object_uri(uri), parts).otherwise(F.raise_error(F.concat(F.lit("not an object URI: "), uri)))
