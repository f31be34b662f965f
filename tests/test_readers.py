"""Readers of dumps, saved pages and web archives on trap cases."""

import gzip
import zlib

import pytest

from boardlake.sources import html_posts, json_posts, mysql_dump, warc

DUMP = """-- it's a dump
CREATE TABLE `g` (
  `num` int,
  `subnum` int,
  `thread_num` int,
  `timestamp` int,
  `comment` text
) ENGINE=x;
INSERT INTO `g` VALUES (1,0,0,1404223200,'a),(b\\'s ''x'''), (2, 0, 1, 0, NULL);
INSERT INTO `g` VALUES (3,1,1,5,'ghost');
CREATE TABLE IF NOT EXISTS `staff` (
  `id` int
);
INSERT INTO `staff` VALUES (7);
"""
OTHER = """﻿INSERT INTO `g` (`comment`, `num`, `subnum`, `thread_num`, `timestamp`) VALUES ('one
(line
CREATE TABLE `no` (
  `x` int
INSERT INTO `g` VALUES (9,9,9,9,''9'')
INSERT INTO `h` said they', 4, 0, 4, 1388568600),('z',x,0,4,9);
INSERT INTO `g_deleted` (`num`, `comment`, `subnum`, `thread_num`, `timestamp`, `op`, `title`) VALUES (5,'\\0d\\n',0,4,0,'1','t');
"""
OLD = """CREATE TABLE `g` (
  `num` int,
  `subnum` int,
  `parent` int,
  `timestamp` int,
  `comment` text,
  `media` text,
  `media_filename` text
);
INSERT INTO `g` VALUES (8,0,0,5,'c `parent`','mine.jpg','123.jpg');
"""


def posts_of(spark, folder, **options):
    rows = mysql_dump.stored(mysql_dump.read_dump(spark, str(folder), **options)).collect()
    return {r.post_no: r for r in rows}


def test_dump(spark, tmp_path):
    (tmp_path / "a.sql").write_text(DUMP)
    (tmp_path / "b.sql").write_text(OTHER)
    got = posts_of(spark, tmp_path)
    assert set(got) == {1, 2, 4, 5}
    assert (got[1].thread_no, got[1].is_op, got[1].body_text, got[1].ts_utc) == (1, True, "a),(b's 'x'", 1404223200 + 4 * 3600)
    assert (got[2].thread_no, got[2].is_op, got[2].body_text, got[2].ts_utc) == (1, False, None, None)
    assert got[4].body_text == "one\n(line\nCREATE TABLE `no` (\n  `x` int\nINSERT INTO `g` VALUES (9,9,9,9,'9')\nINSERT INTO `h` said they"
    assert got[4].ts_utc == 1388568600 + 5 * 3600 and got[4].is_op
    assert (got[5].board, got[5].is_op, got[5].subject, got[5].body_text) == ("g", True, "t", "d\n")
    assert [r.table for r in mysql_dump.side_tables(spark, str(tmp_path)).collect()] == ["staff"]


def test_dump_of_the_older_schema(spark, tmp_path):
    (tmp_path / "a.sql").write_text(OLD)
    assert posts_of(spark, tmp_path) == {}
    got = posts_of(spark, tmp_path, older=True)[8]
    assert (got.thread_no, got.is_op, got.body_text, got.media_filename) == (8, True, "c `parent`", "mine.jpg")


def test_tuples_end_with_their_statement():
    rows, at, is_open = mysql_dump.complete_tuples("(1,'a;b'),(2,NULL); INSERT (3)")
    assert rows == [["1", "a;b"], ["2", None]] and not is_open and at == 19
    assert mysql_dump.complete_tuples("(1,'a")[2]


NATIVE = """<html><head><title>/g/ - x</title></head><body>
<div class="postContainer opContainer" id="pc23433058"><div class="postInfoM mobile"><span class="name">Mob</span></div>
<div class="postInfo desktop"><span class="subject">Su</span> <span class="name">Ann</span><span class="postertrip">!x</span><span class="dateTime" data-utc="1433116800">d</span></div>
<div class="fileText">File: <a href="1.jpg" title="long name.jpg">long(...).jpg</a> <img data-md5="q=="></div>
<blockquote class="postMessage" id="m1">one<br>two &amp;gt; <span class="quote">&gt;x</span><span class="abbr">Comment too long</span></blockquote></div>
<div class="postContainer replyContainer" id="pc23433060"><div class="postInfo desktop"><span class="name">Bob</span></div><div class="fileText"><a>short.png</a></div>
<blockquote class="postMessage">end &lt;span class="quote"</blockquote></div>
<div class="postContainer replyContainer" id="pc23433060"><blockquote class="postMessage">again</blockquote></div>
<div class="postContainer" id="pcx"></div></body></html>"""
LATER = """<div class="post"><span class="post_no">10</span><span class="post_now">07/01/14(Tue)10:00:00</span><b class="post_name">N</b><span class="post_sub">S</span><div class="post_com">a<br>b</div><i class="post_filename">f.png</i></div>
<div class="post"><span class="post_no">11</span><div class="post_com">c</div></div><div class="post"><span class="post_no">none</span></div>"""
CLASSIC = """<html><span class="filesize">File :99.jpg-(51 KB, 287x700, chibi rei.jpg)</span><span class="filetitle">T</span><span class="postername">moot <span>## Admin 01/05/14(Sun)10:00</span></span>
<span id="nothread77">No.77</span><blockquote>op<br>text</blockquote>
<table><tr><td class="reply" id="78"><span class="commentpostername">A</span> 07/01/14(Tue)10:00 <blockquote>said 01/01/01(Mon)01:01</blockquote></td></tr></table>
<table><tr><td class="reply" id="79"><span class="posttime">07/01/14(Tue)11:00</span><span class="filesize">File :5.jpg-(51 KB, 287x700)</span><blockquote></blockquote></td></tr></table></html>"""


def test_native_pages(spark, tmp_path):
    for folder, name in (("g", "2015-06-01_23433058.html"), ("g", "5.html"), ("g/x_files", "6.html")):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / name).write_text(NATIVE)
    (tmp_path / "g" / "index.html").write_text("<p>none</p>")
    pages = html_posts.read_pages(spark, str(tmp_path)).withColumn("board", json_posts.board_of(html_posts.F.col("file")))
    rows = html_posts.native_posts(pages).collect()
    assert len(rows) == 4
    op, reply = sorted((r for r in rows if "2015" in r.file), key=lambda r: r.post_no)
    assert (op.board, op.thread_no, op.post_no, op.is_op, op.ts_utc, op.name, op.tripcode, op.subject) == ("g", 23433058, 23433058, True, 1433116800, "Ann", "!x", "Su")
    assert (op.body_text, op.media_filename, op.media_md5) == ("one\ntwo &gt; >x", "long name.jpg", "q==")
    assert (reply.thread_no, reply.is_op, reply.ts_utc, reply.name, reply.body_text, reply.media_filename) == (23433058, False, None, "Bob", "end", "short.png")
    assert {r.thread_no for r in rows if r.file.endswith("/5.html")} == {5}
    assert [r.file.rsplit("/", 1)[1] for r in html_posts.unread_pages(pages).collect()] == ["index.html"]


def test_older_templates(spark):
    pages = spark.createDataFrame([("/a/w_10.html", None, LATER), ("/b/12 x.htm", "k", CLASSIC), ("/b/13.htm", "k", "<p>")], "file string, board string, page string")
    rows = {r.post_no: r for r in html_posts.legacy_posts(pages).collect()}
    assert set(rows) == {10, 11, 77, 78, 79}
    assert (rows[10].board, rows[10].thread_no, rows[10].is_op, rows[10].ts_utc, rows[10].name, rows[10].subject, rows[10].body_text, rows[10].media_filename) == ("w", 10, True, 1404223200, "N", "S", "a\nb", "f.png")
    assert (rows[11].thread_no, rows[11].is_op, rows[11].ts_utc) == (10, False, None)
    assert (rows[77].board, rows[77].thread_no, rows[77].is_op, rows[77].ts_utc, rows[77].subject, rows[77].body_text, rows[77].media_filename) == ("k", 77, True, 1388934000, "T", "op\ntext", "chibi rei.jpg")
    assert (rows[78].thread_no, rows[78].ts_utc, rows[78].body_text) == (77, 1404223200, "said 01/01/01(Mon)01:01")
    assert (rows[79].ts_utc, rows[79].body_text, rows[79].media_filename) == (1404226800, None, "5.jpg")


def record(uri, http, body, kind="response", sized=True):
    whole = http.replace("\n", "\r\n").encode() + b"\r\n\r\n" + body
    size = f"Content-Length: {len(whole)}\r\n" if sized else ""
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\n{size}\r\n".encode() + whole + b"\r\n\r\n"


def test_warc(spark, tmp_path):
    html, ok = "<p>naïve</p>\n".encode(), "HTTP/1.1 200 OK\nContent-Type: text/html"
    chunks = b"5\r\n" + html[:5] + b"\r\n" + f"{len(html) - 5:x};x\r\n".encode() + html[5:] + b"\r\n0\r\n\r\n"
    data = [
        record("http://a.org/1", ok, html), record("http://a.org/2", ok + "\nTransfer-Encoding: chunked", chunks), record("http://a.org/3", ok + "\nContent-Encoding: gzip", gzip.compress(html)),
        record("http://a.org/4", ok + "\nContent-Encoding: deflate", zlib.compress(html), sized=False), record("http://a.org/5", ok + "\nContent-Encoding: gzip", b"broken"), record("http://b.org/6", ok, html),
        record("http://a.org/7", "HTTP/1.1 503 No\nContent-Type: text/html", html), record("http://a.org/8", "HTTP/1.1 200 OK\nContent-Type: image/png", html), record("http://a.org/9", ok, html, kind="request"),
    ]
    (tmp_path / "a.warc").write_bytes(b"".join(data[:5]))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, data[5:])))
    responses = warc.read_responses(spark, str(tmp_path))
    assert responses.count() == 8
    got = {r.uri[-1]: bytes(r.body) for r in warc.html_pages(responses, r"^https?://a\.org/").collect()}
    assert got == {"1": html, "2": html, "3": html, "4": html, "5": b"broken"}
    assert warc.html_pages(responses, "a.org/1").first().name == "a.org_1.html"


def test_lines_end_at_line_feeds_alone(spark, tmp_path):
    (tmp_path / "x.ndjson").write_bytes("a b c\rd\r\r\nlast".encode())
    assert [r.line for r in json_posts.read_lines(spark, str(tmp_path)).collect()] == ["a b c\rd\r", "last"]


@pytest.mark.parametrize("columns", [["num", "parent"], []])
def test_tables_that_hold_no_posts(spark, columns):
    row = spark.createDataFrame([(columns,)], "c array<string>").select(mysql_dump.holds_posts(mysql_dump.normal_columns(mysql_dump.F.col("c")))).first()
    assert row[0] is False
