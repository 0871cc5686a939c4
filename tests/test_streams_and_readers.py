"""Streams give the rows of their batch twins; readers cope with broken input."""

import gzip
import shutil
import zipfile

import pytest
from pyspark.sql import functions as F

from quire.sources import pages, readers
from quire.streaming import feeds

SMALL = "/root/testdata/sf0.001"


def test_hourly_stream_equals_batch(spark, tmp_path):
    shutil.copy(f"{SMALL}/events.parquet", tmp_path / "events.parquet")
    stream = feeds.hourly(feeds.event_stream(spark, str(tmp_path)))
    query = stream.writeStream.outputMode("complete").format("memory").queryName("hourly").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(spark.table("hourly").collect()) == sorted(feeds.hourly(spark.read.parquet(f"{SMALL}/events.parquet")).collect())


def test_upsert_sink_keeps_the_newest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    for k in range(2):
        events.filter(F.col("event_id") % 2 == k).coalesce(1).write.parquet(str(tmp_path / "in" / f"p{k}"))
    stream = spark.readStream.schema(feeds.EVENTS).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = stream.writeStream.foreachBatch(feeds.upsert_sink(str(tmp_path / "out"), ["event_id"], "ts")).option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    last = max(int(p.name[1:]) for p in (tmp_path / "out").iterdir())
    assert spark.read.parquet(str(tmp_path / "out" / f"v{last}")).count() == events.count()


def test_artifacts(spark, tmp_path):
    (tmp_path / "a.html").write_text("<html><script>x</script><p>One &amp; two</p><p>three</p></html>")
    (tmp_path / "b.txt").write_bytes("café!".encode("latin-1"))
    (tmp_path / "c.txt.gz").write_bytes(gzip.compress(b"packed"))
    (tmp_path / "d.bin").write_bytes(b"\x00")
    with zipfile.ZipFile(tmp_path / "e.epub", "w") as book:
        book.writestr("1.xhtml", "<p>chapter</p>")
    (tmp_path / "f.txt.gz").write_bytes(b"\x1f\x8bbroken")
    got = {r["path"].rpartition("/")[2]: r["text"] for r in readers.read_artifacts(spark, str(tmp_path)).collect()}
    assert got == {"a.html": "One & two\nthree", "b.txt": "café!", "c.txt.gz": "packed", "d.bin": None, "e.epub": "chapter", "f.txt.gz": None}


def test_log_keeps_broken_lines(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"ts": "1", "kind": "user", "content": "hi"}\nnot json\n')
    assert [r["kind"] for r in readers.read_log(spark, str(tmp_path / "log.jsonl")).collect()] == ["user", "corrupt"]


def test_lines(spark, tmp_path):
    (tmp_path / "q.txt").write_text("one\n\n# no\n two \n")
    assert [r[0] for r in readers.read_lines(spark, str(tmp_path / "q.txt")).collect()] == ["one", "two"]


def test_epub_goes_by_its_spine(tmp_path):
    with zipfile.ZipFile(tmp_path / "e.epub", "w") as book:
        book.writestr("o/c.opf", '<package><manifest><item id="a" href="2.xhtml"/><item id="b" href="1.xhtml"/></manifest><spine><itemref idref="a"/><itemref idref="b"/></spine></package>')
        book.writestr("o/1.xhtml", "<p>last</p>")
        book.writestr("o/2.xhtml", "<p>first</p>")
    assert readers.epub_text((tmp_path / "e.epub").read_bytes()) == "first\n\nlast"


@pytest.mark.parametrize(("raw", "want"), [("é".encode(), "é"), ("ab".encode("utf-16"), "ab"), (b"caf\xe9!", "café!"), (b"", ""), (None, None)])
def test_encodings(raw, want):
    assert readers.decode_bytes(raw) == want


def test_payloads_words_and_strict_texts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pdf").write_bytes(b"x" * 10)
    (tmp_path / "in" / "b.pdf").write_bytes(b"x" * 100)
    (tmp_path / "in" / "c.tmp").write_bytes(b"x")
    (tmp_path / "in" / "d.pdf").write_bytes(b"")
    assert [r["length"] for r in readers.select_payloads(spark, str(tmp_path / "in"), (".pdf", ".epub"), 50).collect()] == [10]
    (tmp_path / "words").write_text("Garden\nthe\nx-ray\ngarden\n")
    assert [r[0] for r in readers.read_words(spark, str(tmp_path / "words")).collect()] == ["garden"]
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "1.txt").write_bytes(b"\xff\xfe\x00")
    with pytest.raises(Exception, match="(?i)utf"):
        readers.read_strict(spark, str(tmp_path / "t")).collect()


RSS = """<rss xmlns:dc="d"><channel><title>F</title><item><title> A  b </title><link>https://x.example/1.pdf</link><guid>g1</guid><dc:creator>Me</dc:creator></item>
<item><title>None</title></item><item><title>E</title><enclosure url="https://y.example/e.epub"/></item><item><title>P</title><guid isPermaLink="true">https://z.example/p</guid></item></channel></rss>"""
ATOM = """<feed xmlns="a"><entry><title>T</title><id>i</id><link rel="self" href="https://x.example/s"/><link rel="alternate" href="https://x.example/2"/><author><name>N</name></author></entry></feed>"""


def test_feeds(spark, tmp_path):
    feeds_in = spark.createDataFrame([("u", "Name", RSS), ("v", "Name", ATOM), ("w", "Name", "<broken"), ("x", "Name", None)], "feed_url string, feed_name string, xml string")
    got = {(r["id"], r["title"], r["author"], r["link"], r["site"], r["format"]) for r in pages.feed_rows(feeds_in).collect()}
    assert got == {
        ("u#g1", "A b", "Me", "https://x.example/1.pdf", "x.example", "PDF"), ("u#https://y.example/e.epub", "E", "Name", "https://y.example/e.epub", "y.example", "EPUB"),
        ("u#https://z.example/p", "P", "Name", "https://z.example/p", "z.example", "HTML"), ("v#i", "T", "N", "https://x.example/2", "x.example", "HTML"),
    }
    (tmp_path / "f.xml").write_text(RSS)
    assert readers.read_feed(spark, str(tmp_path / "f.xml")).count() == 3


def test_page_links(spark):
    page = '<a href="/a.pdf#x">1</a><a href="/a.pdf">2</a><a href="mailto:x">3</a><a href="https://y.example/z.epub">4</a><a href="/plain">5</a><a href="http://[bad">6</a>'
    rows = spark.createDataFrame([("https://x.example/", page), ("https://e.example/", None)], "page_url string, markup string")
    assert {(r["link"], r["format"], r["label"]) for r in pages.page_links(rows).collect()} == {("https://x.example/a.pdf", "PDF", "1"), ("https://y.example/z.epub", "EPUB", "4")}


def test_page_metadata(spark):
    made = [
        ("1", '<meta property="og:title" content="Og  T"><h1>H</h1><meta name="author" content="A B">'), ("2", '<title>T</title><h1>Head <b>two</b></h1><div class="x author">By C</div>'),
        ("3", "<p><strong>Title:</strong> Labelled</p><p><strong>Author(s):</strong> D; E</p>"), ("4", ""), ("5", None),
    ]
    rows = spark.createDataFrame(made, "page_url string, markup string")
    got = {r["page_url"]: (r["title"], r["author"]) for r in pages.page_metadata(rows).collect()}
    assert got == {"1": ("Og T", "A B"), "2": ("Head two", "By C"), "3": ("Labelled", "D; E"), "4": ("Untitled work", None), "5": ("Untitled work", None)}
