"""WARC derivatives of odd pages: every source header, long hostile pages, repeated and empty ones."""

import time

import pytest

from oreflow.llm import warc


def records(spark, blocks, date=None):
    rows = spark.createDataFrame([(i, b) for i, b in enumerate(blocks)], "page_id long, block string")
    rows = rows.selectExpr(
        "page_id", "'response' AS record_type", "concat('r', page_id) AS record_id", "'' AS target_uri",
        "'' AS content_type", "block", "'b' AS block_digest", "'p' AS payload_digest",
    )
    return rows.selectExpr("*", f"'{date}' AS warc_date") if date else rows


def test_every_header_is_kept_in_order(spark):
    block = "HTTP/1.1 404 Not Found\r\nDate: Mon\r\nServer: x: y\r\nX-Long: a\r\n  b\r\nDate: Tue\r\nodd\r\n\r\n<p>t"
    rows = warc.derivatives(records(spark, [block], "2020-02-02T00:00:00Z")).where("record_type = 'metadata'").collect()
    assert rows[0]["block"].split("\r\n")[:5] == [
        "source-status: 404", "source-date: Mon", "source-server: x: y", "source-x-long: a b", "source-date: Tue",
    ]
    assert rows[0]["warc_date"] == "2020-02-02T00:00:00Z" and rows[0]["payload_digest"] == "p"


@pytest.mark.parametrize("sign", ["<", "<a ", "<p ", "<!--", "<title", "<title>", "<script ", "</script ", "<a href=", " \n"])
def test_a_megabyte_of_openings_takes_seconds(spark, sign):
    begun = time.monotonic()
    got = warc.derivatives(records(spark, ["HTTP/1.1 200 OK\r\n\r\n" + sign * (1_000_000 // len(sign))])).collect()
    assert time.monotonic() - begun < 60 and len(got) == 2


def test_title_and_links_are_those_of_the_plain_patterns(spark):
    body = "<a b><TITLE x>one\n two</title><a\nhref=1 href=2><a b <a href=3>x<ab href=4><a><i href=5></title>"
    rows = warc.derivatives(records(spark, ["HTTP/1.1 200 OK\r\n\r\n" + body])).collect()
    meta = next(r["block"] for r in rows if r["record_type"] == "metadata")
    assert "\r\ntitle: one two\r\noutlinks: 2\r\n" in meta


def test_empty_repeated_and_headless_responses(spark):
    some = records(spark, ["", None, "no head", "no head"])
    got = warc.derivatives(some).collect()
    assert len(got) == 8 and {r["block"] for r in got if r["record_type"] == "conversion"} == {""}
    assert warc.derivatives(some.union(some)).count() == 16
    assert warc.derivatives(some.limit(0)).count() == 0
