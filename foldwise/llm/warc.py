"""WARC derivatives: linked metadata and plain-text conversion records.

Every response record yields a *metadata* record (application/warc-fields: source
headers, source digest, title, links) and a *conversion* record (the plain text),
each with a Record-ID of its own made from the source's, and with Refers-To,
Refers-To-Target-URI and Refers-To-Date of the source. All of it is column
expressions, one pass without a shuffle; records are written by Spark's text writer,
whose line separator is the blank lines that end a record.
"""

from __future__ import annotations

from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: elements whose end is the end of a line (fixed values)
BLOCKS = ("address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
          "header hr html li main nav ol option p pre section table tbody td tfoot th thead title tr ul").split()
#: elements whose content is no text (fixed values)
SILENT = "script style noscript template head".split()
#: the usual named character references (fixed values), tried before the whole HTML list; &amp; comes last
NAMED = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&hellip;": "…", "&mdash;": "—", "&ndash;": "–", "&copy;": "©", "&middot;": "·", "&bull;": "•", "&laquo;": "«", "&raquo;": "»"}

_SPACE = "[ \\t\\r\\f\\x0B\\x{00A0}]+"
_BLOCK = "(?i)</?(?:" + "|".join(BLOCKS) + ")(?:\\s[^>]*|/)?>"
_SPACES = "[ \\t\\r\\f\\x0B\\x{00A0}]{2,}|[\\t\\r\\f\\x0B\\x{00A0}]"  # single blanks stay as they are
_SILENT = "(?is)<(?:!--.*?-->|(" + "|".join(SILENT) + ")(?:\\s[^>]*)?>.*?</\\1\\s*>)"
_REFERENCE = "&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);"
#: code points that HTML reads as Windows-1252 in numeric references
_WINDOWS = {c: ord(x) for c in range(0x80, 0xA0) for x in bytes([c]).decode("cp1252", "ignore")}
_VALUE = "\\s*+=\\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\\s>\"']++)"
#: an anchor's attributes before href, whole with their values, and the value of href; possessive, so it takes no stack
_LINK = ("(?i)<a(?=[\\s/])(?:[\\s/]++|(?!href\\s*=)[^\\s>/=\"']++(?:" + _VALUE + ")?+|[=\"']++)*+href\\s*+=\\s*+(\"[^\"]*+\"|'[^']*+'|[^\\s>\"'][^\\s>]*+)")
_TAG = "</?[a-zA-Z!?][^>]*>"
DATE = "2024-01-01T00:00:00Z"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _character(ref: Column) -> Column:
    """Character of a decimal or hexadecimal reference, as HTML reads it."""
    hexed = F.lower(F.substring(ref, 3, 1)) == "x"
    digits = F.regexp_extract(ref, "^&#[xX]?0*([0-9a-fA-F]*)", 1)
    small = F.when(F.length(digits) > 7, F.lit("110000")).otherwise(digits)
    code = F.when(F.length(digits) > 7, 0x110000).when(digits == "", 0).otherwise(
        F.when(hexed, F.conv(small, 16, 10)).otherwise(F.conv(small, 10, 10)).cast("long"))

    def put(c):
        windows = F.create_map(*[F.lit(x) for kv in _WINDOWS.items() for x in kv])
        c = F.when((c >= 0x80) & (c < 0xA0), F.coalesce(windows[c.cast("int")].cast("long"), c)).when((c == 0) | (c > 0x10FFFF) | ((c >= 0xD800) & (c < 0xE000)), 0xFFFD).otherwise(c)

        def units(c):
            high, low = F.shiftright(c - 0x10000, 10) + 0xD800, (c - 0x10000).bitwiseAND(0x3FF) + 0xDC00
            return F.decode(F.unhex(F.when(c < 0x10000, F.lpad(F.hex(c), 4, "0")).otherwise(F.concat(F.hex(high), F.hex(low)))), "UTF-16BE")

        return _let(c, units)

    return _let(code, put)


def _resolved(text: Column) -> Column:
    """The text with all its character references (up to a semicolon) resolved, in one pass; unknown ones stay."""
    every = F.str_to_map(F.lit("\x01".join(f"&{k}\x02{v}" for k, v in html5.items() if k.endswith(";"))), F.lit("\x01"), F.lit("\x02"))

    def one(ref):
        usual = F.when(ref == "&amp;", "&")
        for name, char in NAMED.items():
            usual = usual.when(ref == name, char)
        return usual.when(ref.startswith("&#"), _character(ref)).otherwise(F.coalesce(every[ref], ref))

    def run(t):
        refs = F.transform(F.regexp_extract_all(t, F.lit(_REFERENCE), F.lit(0)), one)
        return F.when(F.instr(t, "&") > 0, F.array_join(F.zip_with(F.split(t, _REFERENCE), refs, lambda x, y: F.concat(x, F.coalesce(y, F.lit("")))), "")).otherwise(t)

    return _let(text, run)


def plain_text(html: Column) -> Column:
    """Text of a page: comments and silent elements go, block elements end lines,
    references are resolved, white space is collapsed, empty lines go."""
    t = F.regexp_replace(F.coalesce(html, F.lit("")), _SILENT, "")
    t = F.regexp_replace(F.regexp_replace(t, _BLOCK, "\n"), _TAG, "")
    t = F.regexp_replace(_resolved(t), _SPACES, " ")
    t = F.replace(F.regexp_replace(t, "\\n[ \\n]+", "\n"), F.lit(" \n"), F.lit("\n"))
    return F.trim(t, F.lit("\n "))


def title_of(html: Column) -> Column:
    t = F.regexp_extract(F.coalesce(html, F.lit("")), "(?is)<title(?:\\s[^>]*)?>(.*?)</title\\s*>", 1)
    return F.trim(F.regexp_replace(_resolved(t), "\\s+", " "))


def links_of(html: Column) -> Column:
    """Targets of the page's links, in order, as written: in double, single or no quotes."""
    found = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(_LINK), F.lit(1))
    return F.transform(found, lambda x: F.when(x.startswith('"') | x.startswith("'"), F.substr(x, F.lit(2), F.length(x) - 2)).otherwise(x))


def _uuid(seed: Column) -> Column:
    h = F.md5(seed.cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block.cast("binary"), 256))


def responses(pages: DataFrame, date: str = DATE, http: str = HTTP) -> DataFrame:
    """Response records of a table of pages (page_id, url, html). A null html is an
    empty payload, a null url an empty target. The record id is made from page_id, url and payload, so
    captures of one url with different payloads have ids of their own; equal rows are one record, repeated."""
    url = F.coalesce(F.col("url"), F.lit(""))
    html = F.coalesce(F.col("html"), F.lit(""))
    seed = F.concat_ws("|", F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), url, _digest(html))
    return pages.select("page_id", _uuid(seed).alias("record_id"), url.alias("target_uri"), F.lit(date).alias("date"), F.lit(http).alias("http"),
                        html.alias("payload"), _digest(html).alias("payload_digest"))


def derivatives(records: DataFrame, date: str = DATE, carry: tuple[str, ...] = ()) -> DataFrame:
    """Two rows per response (record_id, target_uri, date, http, payload, payload_digest):
    warc_type (metadata, conversion), record_id, refers_to, target_uri, source_payload_digest,
    block, block_digest, content_length (bytes) and record (the whole record without the
    blank lines that end it); ``carry`` names source columns to keep.

    A null payload is empty, a null digest is computed; other nulls are empty fields.
    Repeated responses yield repeated records. Columns that aren't named aren't used.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    payload = blank("payload")
    src = records.select(
        *carry, blank("record_id").alias("refers_to"), blank("target_uri").alias("target_uri"), blank("date").alias("source_date"),
        F.coalesce(F.col("payload_digest"), _digest(payload)).alias("source_payload_digest"), blank("http").alias("http"), payload.alias("payload"))
    src = src.withColumns({"links": links_of(F.col("payload")), "title": title_of(F.col("payload")), "text": plain_text(F.col("payload"))})
    links = F.col("links")
    lines = F.concat(
        F.transform(F.split("http", "\r\n"), lambda x: F.concat(F.lit("source-header: "), x)),
        F.array(F.concat(F.lit("source-payload-digest: "), "source_payload_digest"), F.concat(F.lit("title: "), "title"),
                F.concat(F.lit("links: "), F.size(links).cast("string"))),
        F.transform(links, lambda x: F.concat(F.lit("outlink: "), x)))
    block = lambda kind, mime, body: F.struct(F.lit(kind).alias("warc_type"), F.lit(mime).alias("mime"), body.alias("block"))
    made = F.array(block("metadata", "application/warc-fields", F.concat(F.array_join(lines, "\r\n"), F.lit("\r\n"))),
                   block("conversion", "text/plain; charset=UTF-8", F.col("text")))
    out = src.withColumn("d", F.explode(made)).select(*carry, "refers_to", "target_uri", "source_date", "source_payload_digest", "d.*")
    out = out.withColumn("record_id", _uuid(F.concat_ws("|", "warc_type", "refers_to"))).withColumn("block_digest", _digest(F.col("block")))
    out = out.withColumn("content_length", F.octet_length("block").cast("long"))
    head = [("WARC-Type", F.col("warc_type")), ("WARC-Record-ID", F.col("record_id")), ("WARC-Date", F.lit(date)), ("WARC-Target-URI", F.col("target_uri")),
            ("WARC-Refers-To", F.col("refers_to")), ("WARC-Refers-To-Target-URI", F.col("target_uri")), ("WARC-Refers-To-Date", F.col("source_date")),
            ("WARC-Source-Payload-Digest", F.col("source_payload_digest")), ("WARC-Block-Digest", F.col("block_digest")), ("Content-Type", F.col("mime")),
            ("Content-Length", F.col("content_length").cast("string"))]
    record = F.concat(F.lit("WARC/1.1\r\n"), *[F.concat(F.lit(f"{k}: "), v, F.lit("\r\n")) for k, v in head], F.lit("\r\n"), F.col("block"))
    return out.select(*carry, "warc_type", "record_id", "refers_to", "target_uri", "source_payload_digest", "block", "block_digest", "content_length", record.alias("record"))


def response_records(records: DataFrame) -> DataFrame:
    """``record``: the response records themselves (record_id, target_uri, date, http, payload, payload_digest) for ``write_warc``.
    Nulls as in ``derivatives``."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    block = F.concat(blank("http"), F.lit("\r\n\r\n"), blank("payload"))
    head = [("WARC-Type", F.lit("response")), ("WARC-Record-ID", blank("record_id")), ("WARC-Date", blank("date")), ("WARC-Target-URI", blank("target_uri")),
            ("WARC-Payload-Digest", F.coalesce(F.col("payload_digest"), _digest(blank("payload")))), ("Content-Type", F.lit("application/http; msgtype=response")),
            ("Content-Length", F.octet_length(block).cast("string"))]
    return records.select(F.concat(F.lit("WARC/1.1\r\n"), *[F.concat(F.lit(f"{k}: "), v, F.lit("\r\n")) for k, v in head], F.lit("\r\n"), block).alias("record"))


def write_warc(records: DataFrame, path: str, per_file: int = 100_000) -> None:
    """Write ``record`` as WARC files of at most ``per_file`` records each."""
    records.select("record").write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", per_file).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(headers, block) of every record of the WARC files under ``path``. A file
    is read by one task, as big as ``write_warc`` left it; an empty file has no records. Of a header that is
    repeated the last one is kept; names are as written."""

    def parse(batches):
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                heads, blocks, at = [], [], 0
                while at < len(raw):
                    cut = raw.index(b"\r\n\r\n", at)
                    head = {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in raw[at:cut].decode("utf-8").split("\r\n")[1:])}
                    n = int(head["Content-Length"])
                    heads.append(list(head.items()))
                    blocks.append(raw[cut + 4:cut + 4 + n])
                    at = cut + 8 + n
                yield pa.RecordBatch.from_arrays([pa.array(heads, pa.map_(pa.string(), pa.string())), pa.array(blocks, pa.binary())], names=["headers", "block"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, "headers map<string,string>, block binary")


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """The response records under ``path``, as ``derivatives`` takes them: HTTP head and payload are what stands
    before and behind the first blank line of the block. Payloads are read as UTF-8."""
    r = read_warc(spark, path).where(F.lower(F.col("headers")["WARC-Type"]) == "response")
    block, h = F.col("block").cast("string"), F.col("headers")
    cut = F.instr(block, "\r\n\r\n")
    http = F.when(cut > 0, F.substr(block, F.lit(1), cut - 1)).otherwise(block)
    payload = F.when(cut > 0, F.substr(block, cut + 4)).otherwise(F.lit(""))
    return r.select(h["WARC-Record-ID"].alias("record_id"), h["WARC-Target-URI"].alias("target_uri"), h["WARC-Date"].alias("date"), http.alias("http"),
                    payload.alias("payload"), h["WARC-Payload-Digest"].alias("payload_digest"))


def op3_warc_derivatives(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    made = derivatives(responses(pages), carry=("page_id",))
    return made.select("page_id", "warc_type", "record_id", "refers_to", "target_uri", "source_payload_digest", "block_digest", "content_length",
                       F.sha2(F.col("record").cast("binary"), 256).alias("record_sha256"))


def _oracle() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    text = "regexp_replace(payload, '(?s)<!--.*?-->', '', 'g')"
    for name in SILENT:
        text = rf"regexp_replace({text}, '(?is)<{name}(?:\s[^>]*)?>.*?</{name}\s*>', '', 'g')"
    text = f"regexp_replace(regexp_replace({text}, {q(_BLOCK)}, chr(10), 'g'), {q(_TAG)}, '', 'g')"
    title = r"regexp_extract(payload, '(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>', 1)"
    for name, char in [*NAMED.items(), ("&amp;", "&")]:
        text, title = (f"replace({x}, {q(name)}, {q(char)})" for x in (text, title))
    text = rf"trim(regexp_replace(regexp_replace({text}, {q(_SPACE)}, ' ', 'g'), '[\s]*\n[\s]*', chr(10), 'g'), chr(10) || ' ')"
    uuid = lambda s: (f"'<urn:uuid:' || substr(md5({s}), 1, 8) || '-' || substr(md5({s}), 9, 4) || '-' || substr(md5({s}), 13, 4) || '-' || "  # noqa: E731
                      f"substr(md5({s}), 17, 4) || '-' || substr(md5({s}), 21, 12) || '>'")
    crlf = "chr(13) || chr(10)"
    head = HTTP.split("\r\n")
    fields = " || ".join([f"{q('source-header: ' + h)} || {crlf}" for h in head])
    return rf"""
WITH s AS (SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS payload,
    {uuid("'response|' || coalesce(page_id::VARCHAR, '') || '|' || coalesce(url, '') || '|sha256:' || sha256(coalesce(html, ''))")} AS refers_to, 'sha256:' || sha256(coalesce(html, '')) AS source_payload_digest FROM pages),
l AS (SELECT *, regexp_extract_all(payload, '(?i)<a\s[^>]*?href="([^">]*)"', 1) AS links,
    trim(regexp_replace({title}, '\s+', ' ', 'g')) AS title FROM s),
d AS (SELECT *, 'metadata' AS warc_type, 'application/warc-fields' AS mime, {fields} || 'source-payload-digest: ' || source_payload_digest || {crlf}
    || 'title: ' || title || {crlf} || 'links: ' || len(links) || {crlf}
    || array_to_string(list_transform(links, lambda x: 'outlink: ' || x || {crlf}), '') AS block FROM l
  UNION ALL SELECT *, 'conversion', 'text/plain; charset=UTF-8', {text} FROM l),
r AS (SELECT *, {uuid("warc_type || '|' || refers_to")} AS record_id, 'sha256:' || sha256(block) AS block_digest, strlen(block)::BIGINT AS content_length FROM d)
SELECT page_id, warc_type, record_id, refers_to, target_uri, source_payload_digest, block_digest, content_length,
  sha256('WARC/1.1' || {crlf} || 'WARC-Type: ' || warc_type || {crlf} || 'WARC-Record-ID: ' || record_id || {crlf} || 'WARC-Date: {DATE}' || {crlf}
  || 'WARC-Target-URI: ' || target_uri || {crlf} || 'WARC-Refers-To: ' || refers_to || {crlf} || 'WARC-Refers-To-Target-URI: ' || target_uri || {crlf}
  || 'WARC-Refers-To-Date: {DATE}' || {crlf} || 'WARC-Source-Payload-Digest: ' || source_payload_digest || {crlf} || 'WARC-Block-Digest: ' || block_digest || {crlf}
  || 'Content-Type: ' || mime || {crlf} || 'Content-Length: ' || content_length || {crlf} || {crlf} || block) AS record_sha256
FROM r
"""


ORACLE = _oracle()
