"""WARC derivatives: records of awkward pages, links between records, digests, serialized form."""

import hashlib

from pyspark.sql import functions as F

from featherline.llm import warc

PAGE = """<html><head><title>A &amp; B
 title</title><style>p {color: red}</style><script>var a = "<p>no</p>";</script></head><body><!-- no -->
<p>One&nbsp;&lt;two&gt;</p><A class=x HREF='/x?a=1&amp;b=2'>link</A><a href=/plain>other</a><br/>end</body></html>"""


def made(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, warc_type string, block string")
    return warc.derivatives(warc.responses(pages, "2024-05-06T07:08:09Z"))


def test_records(spark):
    rows = made(spark, [(1, "http://a/", PAGE, "x", "y")]).collect()
    by_type = {r.warc_type: r for r in rows}
    text = by_type["conversion"]
    assert text.block == "A & B\ntitle\nOne <two>\nlink other\nend"
    fields = by_type["metadata"].block.split("\r\n")
    assert fields[2:] == ["status: 200", "content-type: text/html", "title: A & B title", "outlink: /x?a=1&b=2", "outlink: /plain", ""]
    for r in rows:
        head = dict(line.split(": ", 1) for line in r.headers.split("\r\n")[1:])
        assert r.headers.startswith("WARC/1.1\r\n") and head["WARC-Type"] == r.warc_type and head["WARC-Record-ID"] == r.record_id
        assert head["WARC-Refers-To"] == r.source.record_id and head["WARC-Refers-To-Target-URI"] == head["WARC-Target-URI"] == "http://a/"
        assert head["WARC-Date"] == head["WARC-Refers-To-Date"] == "2024-05-06T07:08:09Z"
        assert head["WARC-Source-Payload-Digest"] == "sha256:" + hashlib.sha256(PAGE.encode()).hexdigest()
        assert head["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest() and int(head["Content-Length"]) == len(r.block.encode())
    assert len({r.record_id for r in rows} | {rows[0].source.record_id}) == 3
    again = made(spark, [(1, "http://a/", PAGE, "x", "y")]).collect()
    assert sorted(r.record_id for r in again) == sorted(r.record_id for r in rows)


def test_serialized(spark):
    r = made(spark, [(1, "u", PAGE, None, None)]).select(warc.serialized(F.col("headers"), F.col("block")).alias("bytes"), "headers", "block").first()
    assert bytes(r.bytes) == f"{r.headers}\r\n\r\n{r.block}\r\n\r\n".encode()


def test_awkward_pages(spark):
    rows = made(spark, [(None, None, None, None, None), (2, "u", "", "x", "y"), (3, "u", "<p>" * 50_000 + "deep" + "<b>" * 10, "x", "y"),
                        (4, "u", "<script>never closed", "x", "y"), (4, "u", "<script>never closed", "x", "y"), (5, "é", "plain é text", "x", "y")]).collect()
    assert len(rows) == 12
    texts = [(r.source.page_id, r.block) for r in rows if r.warc_type == "conversion"]
    assert sorted(texts, key=lambda t: (t[0] or 0, t[1])) == [(None, ""), (2, ""), (3, "deep"), (4, "never closed"), (4, "never closed"), (5, "plain é text")]
    assert made(spark, []).count() == 0


def test_other_responses(spark):
    rows = [("<a>", "u", "d", "sha1:ABC", "HTTP/1.1 404 Not Found\r\nContent-Type: text/plain\r\n\r\nnot < here"), ("<b>", "u", "d", None, "HTTP/1.1 200 OK\r\ncontent-type: image/png\r\n\r\nxx"),
            ("<c>", "u", "d", "p", "no head\r\n\r\nat all")]
    source = spark.createDataFrame(rows, "record_id string, target_uri string, date string, payload_digest string, block string")
    found = {(r.source.record_id, r.warc_type): r for r in warc.derivatives(source).collect()}
    assert set(found) == {("<a>", "metadata"), ("<a>", "conversion"), ("<b>", "metadata"), ("<c>", "metadata"), ("<c>", "conversion")}
    assert found["<a>", "conversion"].block == "not < here" and "status: 404" in found["<a>", "metadata"].block
    assert "WARC-Source-Payload-Digest: sha1:ABC" in found["<a>", "conversion"].headers and found["<c>", "conversion"].block == "no head\r\n\r\nat all"
