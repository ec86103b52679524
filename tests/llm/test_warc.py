from pyspark.sql import functions as F

from foldwise.llm import warc
from foldwise.llm.warc import links_of, plain_text


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_round_trip_and_links(spark, tmp_path):
    html = "<html><head><title>A &amp; B</title><script>x('</p>')</script></head><body><!-- c --><p>One&nbsp; two<br>3 &lt; 4 &#233; &#x4e2d;</p><a href=\"/x\">x</a></body></html>"
    src = warc.responses(pages(spark, [(1, "http://a/", html), (2, None, None), (2, None, None), (3, "u", "plain\r\n\r\ntext"), (None, "v", "<p></p>")]))
    made = warc.derivatives(src, carry=("page_id",)).cache()
    assert made.count() == 10
    conversion = {r.target_uri: r.block for r in made.where("warc_type = 'conversion'").collect()}
    assert conversion["http://a/"] == "One two\n3 < 4 é 中\nx"
    assert conversion[""] == "" and conversion["u"] == "plain\ntext"
    meta = made.where("page_id = 1 and warc_type = 'metadata'").first()
    assert "title: A & B\r\n" in meta.block and "outlink: /x\r\n" in meta.block and "source-header: HTTP/1.1 200 OK\r\n" in meta.block
    ids = {r.page_id: r for r in src.collect()}
    for r in made.collect():
        assert r.refers_to == ids[r.page_id].record_id and r.source_payload_digest == ids[r.page_id].payload_digest
    path = str(tmp_path / "w")
    warc.write_warc(made, path, per_file=3)
    back = warc.read_warc(spark, path).collect()
    want = {(r.record_id, r.refers_to, r.block_digest): r.block for r in made.collect()}
    assert len(back) == 10
    for r in back:
        h = r.headers
        assert want[h["WARC-Record-ID"], h["WARC-Refers-To"], h["WARC-Block-Digest"]] == bytes(r.block).decode()


def test_captures_of_one_url_and_missing_ids(spark):
    """Different payloads have records of their own; equal rows share theirs."""
    src = warc.responses(pages(spark, [(1, "u", "<p>a</p>"), (1, "u", "<p>b</p>"), (None, None, "x"), (None, None, "y"), (None, None, "y")]))
    made = warc.derivatives(src)
    assert src.select("record_id").distinct().count() == 4
    assert made.select("record_id").distinct().count() == 8 and made.count() == 10
    assert made.select("refers_to", "block").where("warc_type = 'conversion'").distinct().count() == 4


def test_titles_resolve_as_texts_do(spark):
    src = warc.responses(pages(spark, [(1, "u", "<title>&quot;A&quot; &amp;amp; &eacute;\n&#39;b&#39;</title>")]))
    assert "title: \"A\" &amp; é 'b'\r\n" in warc.derivatives(src).where("warc_type = 'metadata'").first().block


def test_responses_with_their_headers_round_trip(spark, tmp_path):
    rows = [("<urn:uuid:1>", "http://a/", "2023-05-06T07:08:09Z", "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nX-Time: 10:11", "<title>T</title>\r\n\r\n<p>é", None),
            ("<urn:uuid:2>", "http://b/", "2022-01-01T00:00:00Z", "HTTP/1.0 404 Not Found", "", "sha1:ABC")]
    src = spark.createDataFrame(rows, "record_id string, target_uri string, date string, http string, payload string, payload_digest string")
    path = str(tmp_path / "r")
    warc.write_warc(warc.response_records(src), path, per_file=1)
    back = {r.record_id: r for r in warc.read_responses(spark, path).collect()}
    assert [(r.target_uri, r.date, r.http, r.payload) for r in (back["<urn:uuid:1>"], back["<urn:uuid:2>"])] == [r[1:5] for r in rows]
    assert back["<urn:uuid:2>"].payload_digest == "sha1:ABC"
    made = warc.derivatives(warc.read_responses(spark, path))
    meta = made.where("warc_type = 'metadata' and refers_to = '<urn:uuid:1>'").first()
    assert "source-header: X-Time: 10:11\r\n" in meta.block and "WARC-Refers-To-Date: 2023-05-06T07:08:09Z\r\n" in meta.record
    assert made.where("refers_to = '<urn:uuid:2>'").first().source_payload_digest == "sha1:ABC"
    assert warc.read_responses(spark, path).count() == 2


def test_empty_and_extra_columns(spark):
    none = warc.responses(pages(spark, []))
    assert warc.derivatives(none).collect() == []
    extra = warc.responses(pages(spark, [(1, "u", "<p>x")])).withColumn("block", F.lit("z")).withColumn("warc_type", F.lit("z"))
    assert {r.warc_type for r in warc.derivatives(extra).collect()} == {"metadata", "conversion"}


def test_links_in_all_quotes(spark):
    tags = {"<a href='/x'>": ["/x"], "<a href=/y>": ["/y"], '<A class=c HREF = "/z">': ["/z"], "<a\nhref\n=\n'/w'>": ["/w"], '<a title="href=no" href="/v">': ["/v"],
            "<a class='a>b' href=/u?a=1&b='2' id=i>": ["/u?a=1&b='2'"], '<a href="">': [""], "<a name=n>href=/no</a>": [], "<abbr href='/no'>": [], "<a data-href='/no'>": [],
            "<a class=\"c\"href='/t'>": ["/t"], "<a " + "x=1 " * 50_000 + "href=/far>": ["/far"], '<a href="/p><a href="/q">': ["/p><a href="]}
    got = spark.createDataFrame([(t, i) for i, t in enumerate(tags)], "html string, i long").select("i", links_of(F.col("html")).alias("l")).collect()
    assert {r.i: r.l for r in got} == dict(enumerate(tags.values()))


def test_all_references(spark):
    texts = {"&eacute;&uuml;&szlig;&euro;&rsquo;&ldquo;": "éüß€’“", "&#128512; &#x1F600; &#0000039; &#X41;": "😀 😀 ' A", "&amp;lt; &#38;amp; &amp;#65;": "&lt; &amp; &#65;",
             "&copy 2024 &notit; &NotEqualTilde;": "&copy 2024 &notit; ≂̸", "AT&T &unknown; & &; &#; &#x;": "AT&T &unknown; & &; &#; &#x;", "&#128; &#0; &#xD800; &#99999999999999999999;": "€ � � �",
             "&quot;a&#39;s&quot;": "\"a's\""}
    pages = spark.createDataFrame([(i, f"<p>{t}</p>") for i, t in enumerate(texts)], "i long, html string")
    for r in pages.select("i", plain_text(F.col("html")).alias("p")).collect():
        assert r.p == list(texts.values())[r.i]


def test_every_name_of_the_list(spark):
    from html.entities import html5

    names = [n for n in html5 if n.endswith(";") and n not in ("Tab;", "NewLine;", "nbsp;", "NonBreakingSpace;")]
    got = spark.createDataFrame([("<p>|" + "|".join(f"&{n}" for n in names) + "|",)], "html string").select(plain_text(F.col("html")).alias("p")).first().p
    assert got == "|" + "|".join(html5[n] for n in names) + "|"
