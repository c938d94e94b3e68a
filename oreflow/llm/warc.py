"""WARC derivatives: metadata and plain-text conversion records of response records.

A record is a row: type, id, the id it refers to, target, content type, block and digests.
Ids are named by content (a UUID of the digest of what identifies the record), so a task
that runs again gives the same ones, and rows of equal content have equal ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import quoted

DATE = "2026-01-01T00:00:00Z"
# Elements that end a line of text, and the named entities that are decoded.
BLOCKS = "address|article|blockquote|br|dd|div|dt|figcaption|footer|h1|h2|h3|h4|h5|h6|header|hr|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul"
ENTITIES = (("&nbsp;", " "), ("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))
#: What is taken out of a page for its text, in order: a pattern and what stands in its place. The last two end
#: with ">" and are tried only up to the last one, for behind it each "<" would search to the end in vain.
STEPS = (
    (r"(?is)<script\b.*?(</script\s*>|$)", " "),
    (r"(?is)<style\b.*?(</style\s*>|$)", " "),
    (r"(?s)<!--.*?(-->|$)", " "),
    (rf"(?i)</?({BLOCKS})\b[^>]*>", "\n"),
    (r"<[^>]*>", ""),
)
#: After the entities: white space to single blanks, and no empty lines.
SPACES = ((r"[ \t\f\r\x0B ]+", " "), (r" ?\n[ \n]*", "\n"))


def plain_text(html: Column) -> Column:
    """The text of a page, a line for each block element."""
    def without_tags(page: Column) -> Column:
        rest = F.substring_index(page, ">", -1)
        tagged = F.substring(page, F.lit(1), F.length(page) - F.length(rest))
        for pattern, place in STEPS[-2:]:
            tagged = F.regexp_replace(tagged, pattern, place)
        return F.concat(tagged, rest)

    for pattern, place in STEPS[:-2]:
        html = F.regexp_replace(html, pattern, place)
    html = F.get(F.transform(F.array(html), without_tags), 0)  # names the page, so it is made once
    for entity, sign in ENTITIES:
        html = F.replace(html, F.lit(entity), F.lit(sign))
    for pattern, place in SPACES:
        html = F.regexp_replace(html, pattern, place)
    return F.trim(F.regexp_replace(html, r"^\n+|\n+$", ""))


def _digest(content: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(F.encode(content, "UTF-8"), 256))


def record_id(*parts: Column) -> Column:
    """A UUID urn from the digest of the parts."""
    md5 = F.md5(F.encode(F.concat_ws("|", *parts), "UTF-8"))
    pieces = [F.substring(md5, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def _text(name: str) -> Column:
    return F.coalesce(F.col(quoted(name)).cast("string"), F.lit(""))


def responses(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """A response record per page: an HTTP head and the page as its block.

    Null urls and pages are empty.
    """
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(_text(html)).cast("string"),
        F.lit("\r\n\r\n"),
    )
    rows = pages.select(
        F.col(quoted(id)).alias("page_id"), _text(url).alias("target_uri"), F.concat(head, _text(html)).alias("block"),
        _digest(_text(html)).alias("payload_digest"),
    )
    number = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    return rows.select(
        "page_id",
        F.lit("response").alias("record_type"),
        record_id(F.lit("response"), number, F.col("target_uri"), F.col("payload_digest")).alias("record_id"),
        F.lit(None).cast("string").alias("refers_to"),
        "target_uri",
        F.lit("application/http; msgtype=response").alias("content_type"),
        "block",
        _digest(F.col("block")).alias("block_digest"),
        "payload_digest",
    )


def _source_headers(head: Column) -> Column:
    """Every header of an HTTP head in its order, as ``source-<name>: value``; folded lines are joined."""
    lines = F.split(F.regexp_replace(head, r"\r?\n[ \t]+", " "), r"\r?\n")
    headers = F.filter(F.slice(lines, 2, F.size(lines)), lambda line: F.instr(line, ":") > 1)
    return F.transform(
        headers,
        lambda line: F.concat(
            F.lit("source-"),
            F.lower(F.trim(F.substring_index(line, ":", 1))),
            F.lit(": "),
            F.trim(F.substring(line, F.instr(line, ":") + 1, F.length(line))),
        ),
    )


def derivatives(records: DataFrame) -> DataFrame:
    """For each response of ``records`` a metadata and a conversion record that refer to it.

    The metadata block has the source's HTTP status and all its headers, its digests, and the
    title, the links and the characters of the text; the conversion block is the text. Both
    keep the target, the source's payload digest and its ``warc_date``, if there is one. Other
    record types are passed over; a response without a head or a body has an empty one;
    repeated responses give repeated records. All patterns take time linear in the page.
    """
    split = F.instr("block", "\r\n\r\n")
    rows = records.where("record_type = 'response'").withColumns(
        {
            "head": F.when(split > 0, F.substring("block", F.lit(1), split - 1)).otherwise(""),
            "body": F.when(split > 0, F.substring("block", split + 4, F.length("block"))).otherwise(""),
        }
    )
    rows = rows.withColumn("plain", plain_text(F.col("body")))
    # Atomic groups and the anchor keep a page of openings without ends from being read once for each.
    title = F.regexp_extract("body", r"(?is)\A(?>.*?<title)(?>[^>]*>)(.*?)</title", 1)
    title = F.trim(F.regexp_replace(title, r"\s+", " "))
    links = F.size(F.filter(F.split("body", ">"), lambda tag: tag.rlike(r"(?is)\A(?>.*?<a\s).*href=")))
    lines = F.concat_ws(
        "\r\n",
        F.concat(F.lit("source-status: "), F.regexp_extract("head", r"^HTTP/\S+ (\d+)", 1)),
        _source_headers(F.col("head")),
        F.concat(F.lit("source-block-digest: "), F.coalesce("block_digest", F.lit(""))),
        F.concat(F.lit("title: "), title),
        F.concat(F.lit("outlinks: "), links.cast("string")),
        F.concat(F.lit("text-chars: "), F.length("plain").cast("string")),
    )
    kinds = F.array(
        F.struct(
            F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("content_type"),
            F.concat(lines, F.lit("\r\n")).alias("block"),
        ),
        F.struct(
            F.lit("conversion").alias("record_type"), F.lit("text/plain; charset=utf-8").alias("content_type"),
            F.col("plain").alias("block"),
        ),
    )
    date = [c for c in records.columns if c == "warc_date"]
    rows = rows.select("page_id", "record_id", "target_uri", "payload_digest", *date, F.explode(kinds).alias("k"))
    return rows.select(
        "page_id",
        "k.record_type",
        record_id(F.col("k.record_type"), F.col("record_id")).alias("record_id"),
        F.col("record_id").alias("refers_to"),
        "target_uri",
        "k.content_type",
        "k.block",
        _digest(F.col("k.block")).alias("block_digest"),
        "payload_digest",
        *date,
    )


def write_warc(records: DataFrame, path: str, date: str = DATE) -> None:
    """Write records as WARC files, one record after the other, below a new folder ``path``.

    A record's date is its ``warc_date``, and ``date`` where that column or value is missing.
    Derivatives keep their source's payload digest in a field of its own name.
    """
    stamp = F.coalesce("warc_date", F.lit(date)) if "warc_date" in records.columns else F.lit(date)
    fields = [
        ("WARC-Type", F.col("record_type")), ("WARC-Record-ID", F.col("record_id")),
        ("WARC-Refers-To", F.col("refers_to")), ("WARC-Date", stamp),
        ("WARC-Target-URI", F.col("target_uri")), ("WARC-Block-Digest", F.col("block_digest")),
        ("WARC-Payload-Digest", F.when(F.col("record_type") == "response", F.col("payload_digest"))),
        ("WARC-Source-Payload-Digest", F.when(F.col("record_type") != "response", F.col("payload_digest"))),
        ("Content-Type", F.col("content_type")),
        ("Content-Length", F.octet_length("block").cast("string")),
    ]
    head = F.concat_ws("\r\n", F.lit("WARC/1.1"), *[F.concat(F.lit(f"{k}: "), v) for k, v in fields])
    # The writer ends each line itself.
    line = F.concat(head, F.lit("\r\n\r\n"), F.col("block"), F.lit("\r\n\r"))
    records.select(line.alias("value")).write.option("lineSep", "\n").text(path)
