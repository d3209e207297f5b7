"""WARC derivatives: metadata and plain-text conversion records made from response records.

A response is a row with ``record_id, target_uri, date, payload_digest`` (its WARC headers) and ``block`` (the HTTP
message, as text). Each gives

* a metadata record (application/warc-fields) with what its HTTP headers and HTML say: status, content type,
  title, outgoing links, and the identifiers and digests of the source;
* where its content type is HTML or plain text, a conversion record with the text alone.

Both name the response in WARC-Refers-To with its URI and date, keep its payload digest, have an identifier that
follows from the response's (so a rerun gives equal records) and a digest of their own block. Everything is
column expressions of the rows at hand: no shuffle, and equal input gives equal records.

Nulls count as empty strings; an empty or very long payload is a payload like any other; a response without HTTP
headers is plain text. Rows that repeat give repeated records, an empty table none. Extra columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

NEWLINE = "\r\n"
DROPPED = r"(?is)<(script|style|noscript|template)[^>]*>.*?</(script|style|noscript|template)[^>]*>|<!--.*?-->"
BREAKS = r"(?i)</?(br|p|div|li|tr|h[1-6]|table|ul|ol|section|article|blockquote|pre)([ \t\n\f\r/][^>]*)?>"
TAGS = r"<[^>]*>"
BLANKS, LINES = r"[ \t\f\r]+", r" ?\n[ \n]*"
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
LINKS = r"(?i)<a[ \t\n\f\r][^>]*href[ \t\n\f\r]*=[ \t\n\f\r]*[\x22\x27]?([^\x22\x27> \t\n\f\r]+)"
#: Entities in the order in which they are replaced.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"))


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def record_id(kind: str, *of: Column) -> Column:
    """An identifier that follows from what the record is made of."""
    h = F.md5(F.concat_ws("|", F.lit(kind), *of))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[h.substr(a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def unescaped(text: Column) -> Column:
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def collapsed(text: Column) -> Column:
    text = F.regexp_replace(text, BLANKS, " ")
    return F.btrim(F.regexp_replace(text, LINES, "\n"), F.lit(" \n"))


def plain_text(html: Column) -> Column:
    """Text of HTML: scripts, styles and comments dropped, a line per block element, entities replaced."""
    text = F.regexp_replace(F.regexp_replace(html, DROPPED, " "), BREAKS, "\n")
    return collapsed(unescaped(F.regexp_replace(text, TAGS, " ")))


def responses(pages: DataFrame, date: str) -> DataFrame:
    """The rows of ``page_id, url, html`` as response records of one capture date."""
    html = _text(F.col("html"))
    head = F.concat(F.lit("HTTP/1.1 200 OK" + NEWLINE + "Content-Type: text/html; charset=UTF-8" + NEWLINE + "Content-Length: "),
                    F.octet_length(html).cast("string"), F.lit(NEWLINE * 2))
    return pages.select(
        "page_id", record_id("response", _text(F.col("page_id")), _text(F.col("url"))).alias("record_id"), _text(F.col("url")).alias("target_uri"),
        F.lit(date).alias("date"), digest(html).alias("payload_digest"), F.concat(head, html).alias("block"))


def derivatives(source: DataFrame) -> DataFrame:
    """The columns of ``source`` as struct ``source`` with ``warc_type, record_id, content_type, headers, block``, one row per record."""
    block = _text(F.col("block"))
    cut = F.instr(block, NEWLINE * 2)
    has_head = block.startswith("HTTP/") & (cut > 0)
    head = F.when(has_head, F.substring(block, F.lit(1), cut - 1)).otherwise("")
    payload = F.when(has_head, F.substring(block, cut + 4, F.length(block))).otherwise(block)
    opened = source.select(F.struct(*[source[c] for c in source.columns]).alias("source"), head.alias("_head"), payload.alias("_payload"))
    kind = F.lower(F.regexp_extract("_head", r"(?im)^content-type:[ \t]*([^;\r\n]*)", 1))
    opened = opened.withColumn("_kind", F.when(kind == "", "text/plain").otherwise(F.btrim(kind)))
    id_, uri, date, payload_digest = (_text(F.col(f"source.{c}")) for c in ("record_id", "target_uri", "date", "payload_digest"))
    is_html = F.col("_kind").isin("text/html", "application/xhtml+xml")

    links = F.when(is_html, F.regexp_extract_all("_payload", F.lit(LINKS), F.lit(1))).otherwise(F.array().cast("array<string>"))
    title = F.when(is_html, collapsed(unescaped(F.regexp_extract("_payload", TITLE, 1)))).otherwise("")
    fields = F.concat(F.array(
        F.concat(F.lit("source-record-id: "), id_), F.concat(F.lit("source-payload-digest: "), payload_digest),
        F.concat(F.lit("status: "), F.regexp_extract("_head", r"^HTTP/[0-9.]+ ([0-9]+)", 1)), F.concat(F.lit("content-type: "), F.col("_kind")),
        F.concat(F.lit("title: "), F.replace(title, F.lit("\n"), F.lit(" ")))),
        F.transform(links, lambda x: F.concat(F.lit("outlink: "), unescaped(x))))
    metadata = F.concat(F.array_join(fields, NEWLINE), F.lit(NEWLINE))
    text = F.when(is_html, plain_text(F.col("_payload"))).when(F.col("_kind").startswith("text/"), F.col("_payload"))

    def made(warc_type: str, content_type: str, body: Column) -> Column:
        return F.struct(F.lit(warc_type).alias("warc_type"), record_id(warc_type, id_).alias("record_id"), F.lit(content_type).alias("content_type"), body.alias("block"))

    records = F.filter(F.array(made("metadata", "application/warc-fields", metadata), made("conversion", "text/plain; charset=UTF-8", text)),
                       lambda r: r["block"].isNotNull())
    rows = opened.select("source", F.explode(records).alias("r"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value)

    r = F.col("r")
    headers = F.concat_ws(
        NEWLINE, F.lit("WARC/1.1"), line("WARC-Type", r["warc_type"]), line("WARC-Record-ID", r["record_id"]), line("WARC-Date", date),
        line("WARC-Target-URI", uri), line("WARC-Refers-To", id_), line("WARC-Refers-To-Target-URI", uri), line("WARC-Refers-To-Date", date),
        line("WARC-Source-Payload-Digest", payload_digest), line("WARC-Block-Digest", digest(r["block"])), line("Content-Type", r["content_type"]),
        line("Content-Length", F.octet_length(r["block"]).cast("string")))
    return rows.select("source", r["warc_type"].alias("warc_type"), r["record_id"].alias("record_id"), r["content_type"].alias("content_type"),
                       headers.alias("headers"), r["block"].alias("block"))


def serialized(headers: Column, block: Column) -> Column:
    """The bytes of a record as they stand in a WARC file."""
    return F.concat(headers, F.lit(NEWLINE * 2), block, F.lit(NEWLINE * 2)).cast("binary")
