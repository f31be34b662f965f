"""Records over splits of every size: dumps and web archives whose texts quote the marks, against plain readers of whole files."""

import gzip
import random

import pytest

from boardlake.sources import mysql_dump, warc, warc_gz

rng = random.Random(6)


@pytest.fixture
def split(spark):
    def to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)

    yield to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def quoted(text):
    return "'" + text.replace("\\", "\\\\").replace("'", rng.choice(["''", "\\'"])) + "'"


BITS = ["\nINSERT INTO `g` VALUES (9,9,9,9,'q'),", "\nINSERT INTO `x` (`num`) VALUES ('", "\nINSERT INTO `", "'", "\\", "\n", ";", "),(", "plain words ", "é", "''", "x" * 90]


def dump(n, broken=False):
    out, want, no = ["-- it's\nCREATE TABLE `g` (\n  `num` int,\n  `subnum` int,\n  `thread_num` int,\n  `timestamp` int,\n  `comment` text\n);\n"], {}, 0
    for _ in range(n):
        rows = []
        for _ in range(rng.randint(1, 3)):
            no += 1
            want[no] = "plain " * broken + "".join(rng.choice(BITS[3:] if broken else BITS) for _ in range(rng.randint(0, 9)))
            rows.append(f"({no},0,1,0,{quoted(want[no])})")
        out.append("INSERT INTO `g` VALUES " + ",".join(rows) + ";\n")
        if broken and rng.random() < 0.2:
            no += 1
            out.append(f"INSERT INTO `g` VALUES ({no},0,1,0,'never closed\n")
        if rng.random() < 0.2 and not broken:
            out.append("-- don't\n")
    return "".join(out), want


@pytest.mark.parametrize("size", [131, 1 << 20])
def test_dumps_that_quote_inserts(spark, split, tmp_path, size):
    want = {}
    for k, broken in enumerate((False, False, True)):
        text, rows = dump(40, broken)
        (tmp_path / f"{k}.sql").write_text(text, newline="")
        want |= {(k, n): t for n, t in rows.items()}
    split(size)
    records = mysql_dump.records(spark, str(tmp_path))
    got = {}
    for r in records.select("file", mysql_dump.F.inline(mysql_dump._statements("record"))).collect():
        for v in r["rows"]:
            got[int(r.file[-5]), int(v[0])] = v[4]
    assert got == want


def test_states_of_pieces():
    state = mysql_dump.piece_state
    assert state("INSERT INTO `a` VALUES (1,'x');", False) == (False, False)
    assert state("INSERT INTO `a` VALUES (1,'x", False) == (True, False)
    assert state("INSERT INTO `a` VALUES (1,\\'y\\') more'),(2,'open", True) == (True, True)
    assert state("INSERT INTO `a` VALUES (1,''y", True) == (True, True)
    assert state("INSERT INTO `a` VALUES (1,'y');", True) == (False, False)
    assert state("INSERT INTO `a` said", False) == (False, False)


INNER = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://no.org/\r\nContent-Length: 60\r\n\r\nHTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>inner</p>\r\n\r\n"


def record(uri, body, sized=True):
    content = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + body
    size = b"\r\nContent-Length: %d" % len(content) if sized else b""
    return b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: " + uri.encode() + b"\r\nWARC-Date: 2020" + size + b"\r\n\r\n" + content + b"\r\n\r\n"


def archive(n, name):
    bits, out, want = [INNER, b"WARC/1.0\r\n", b"WARC/1.0", b"\r\n\r\n", b"<p>text</p>", bytes(range(256)), b"y" * 120], [], {}
    for k in range(n):
        body = b"".join(rng.choice(bits) for _ in range(rng.randint(0, 6)))
        want[f"http://a.org/{name}/{k}"] = body
        out.append(record(f"http://a.org/{name}/{k}", body))
    out.append(record(f"http://a.org/{name}/last", b"no length", sized=False))
    want[f"http://a.org/{name}/last"] = b"no length"
    return out, want


@pytest.mark.parametrize("size", [333, 1 << 20])
def test_bodies_that_quote_records(spark, split, tmp_path, size):
    (one, want), (two, more) = archive(40, "one"), archive(30, "two")
    (tmp_path / "one.warc").write_bytes(b"".join(one))
    (tmp_path / "two.warc").write_bytes(b"".join(two))
    split(size)
    rows = warc.read_responses(spark, str(tmp_path)).collect()
    assert len(rows) == len(want | more)
    assert {r.uri: bytes(r.body) for r in rows} == want | more


def test_compressed_archives_are_split_at_members(spark, tmp_path):
    (one, want), (two, more), (three, rest) = archive(60, "one"), archive(30, "two"), archive(9, "three")
    (tmp_path / "one.warc.gz").write_bytes(b"".join(map(gzip.compress, one)))
    (tmp_path / "two.warc.gz").write_bytes(gzip.compress(b"".join(two)))
    whole = b"".join(three)
    (tmp_path / "three.warc.gz").write_bytes(b"".join(gzip.compress(whole[k : k + 77]) for k in range(0, len(whole), 77)))
    warc_gz.register(spark)
    rows = spark.read.format("warc_gz").option("path", str(tmp_path)).option("split", 500).load()
    assert len({r[0] for r in rows.filter("file like '%one%'").select(warc.F.spark_partition_id()).collect()}) > 3
    assert rows.count() == len(want | more | rest)
    got = warc.read_responses(spark, str(tmp_path)).collect()
    assert {r.uri: bytes(r.body) for r in got} == want | more | rest
    damaged = b"".join(map(gzip.compress, one[:5])) + gzip.compress(one[5])[:-9] + b"".join(map(gzip.compress, one[6:]))
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.warc.gz").write_bytes(damaged)
    assert len({r.uri for r in warc.read_responses(spark, str(tmp_path / "d")).collect()}) >= len(one) - 1


def test_pages_are_written_one_file_each(spark, tmp_path):
    pages = [record("http://a.org/x/1", b"<p>WARC/1.0\r\n</p>"), record("http://a.org/x/2/", b"two"), record("http://b.org/", b"no")]
    (tmp_path / "a.warc").write_bytes(b"".join(pages))
    found = warc.html_pages(warc.read_responses(spark, str(tmp_path / "a.warc")), r"^http://a\.org")
    assert warc.extract_pages(found, str(tmp_path / "out")) == 2
    assert {p.name: p.read_bytes() for p in (tmp_path / "out").iterdir()} == {"a.org_x_1.html": b"<p>WARC/1.0\r\n</p>", "a.org_x_2.html": b"two"}
    with pytest.raises(ValueError):
        warc.extract_pages(found.filter("uri = 'none'"), str(tmp_path / "none"))


def test_boards_are_pushed_to_saved_pages(spark, tmp_path):
    from boardlake.sources import saved_pages

    for board in "abc":
        for k in range(5):
            (tmp_path / board / "sub").mkdir(parents=True, exist_ok=True)
            (tmp_path / board / "sub" / f"{k}.html").write_text(f"<p>{board}{k}é</p>")
        (tmp_path / board / "notes.txt").write_text("no page")
    saved_pages.register(spark)
    pages = spark.read.format("saved_pages").option("path", str(tmp_path)).option("split", 30).load()
    assert pages.count() == 15
    some = pages.filter("board in ('a', 'c') and page like '%3%'")
    assert sorted(r.page for r in some.collect()) == ["<p>a3é</p>", "<p>c3é</p>"]
    one = pages.filter("board = 'b'")
    assert one.rdd.getNumPartitions() == 3 and one.count() == 5
    reader = saved_pages.Reader(str(tmp_path), 1000)
    assert list(reader.pushFilters([saved_pages.EqualTo(("board",), "b"), saved_pages.EqualTo(("file",), "x")])) == [saved_pages.EqualTo(("file",), "x")]
    assert {b for p in reader.partitions() for b, _ in p.files} == {"b"}


def test_boards_of_a_dump(spark, tmp_path):
    text, _ = dump(5)
    (tmp_path / "a.sql").write_text(text + text.replace("`g`", "`h`") + text.replace("INTO `g`", "INTO `g_deleted`"), newline="")
    every = mysql_dump.dump_rows(spark, str(tmp_path))
    assert {r.table for r in mysql_dump.of_boards(mysql_dump.records(spark, str(tmp_path)), ["g"]).select(mysql_dump.F.inline(mysql_dump._statements("record"))).collect()} == {"g", "g_deleted"}
    assert mysql_dump.dump_rows(spark, str(tmp_path), boards=["h"]).count() == every.filter("table = 'h'").count() > 0
