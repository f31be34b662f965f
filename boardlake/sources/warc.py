"""Responses in WARC files, and their pages as files of their own.

A record is as long as its head says, whatever its body holds: plain files are cut at the records' mark by Spark's text scan, and
pieces that a record asks for beyond a mark are put back to it, also over the end of a split. Compressed files are split at
their members (`warc_gz`). A small helper undoes HTTP codings. A record without a length ends at the next mark.
"""

from __future__ import annotations

import bisect
import gzip
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardlake.functions.batches import in_pieces, mapped
from boardlake.functions.scratch import arrow_files
from boardlake.functions.texts import url_slug
from boardlake.sources import framing, warc_gz

#: What every record begins with; fixed value.
SEPARATOR = "WARC/1.0\r\n"


def unchunk(body: bytes) -> bytes:
    """The bytes of a chunked body; what does not read as a chunk ends it."""
    out, at = [], 0
    while (line := body.find(b"\r\n", at)) >= 0:
        try:
            size = int(body[at:line].split(b";")[0], 16)
        except ValueError:
            break
        if size <= 0:
            break
        out.append(body[line + 2 : line + 2 + size])
        at = line + size + 4
    return b"".join(out)


def uncoded(body: bytes, chunked: bool, coding: str | None) -> bytes:
    """The body without its codings; one that cannot be read (or is of a kind with no module here) stays as it is."""
    body = unchunk(body) if chunked else body
    try:
        if coding == "gzip":
            return gzip.decompress(body)
        if coding == "deflate":
            return zlib.decompress(body)
        if coding == "br":
            import brotli

            return brotli.decompress(body)
    except (ImportError, OSError, EOFError, zlib.error):
        return body
    except Exception as e:  # the module's own error has no common base
        if type(e).__module__.startswith(("brotli", "_brotli")):
            return body
        raise
    return body


@F.arrow_udf(T.BinaryType())
def _uncoded(body: pa.Array, chunked: pa.Array, coding: pa.Array) -> pa.Array:
    return mapped(lambda b, c, k: None if b is None else uncoded(b, bool(c), k or None), pa.binary(), body, chunked, coding)


class Chain:
    """How the records of a split follow one another, from the lengths of its pieces and what each asks for if a record begins there.

    The state at the beginning of a split is how many bytes, counted from the first mark, still belong to a record before it."""

    def __init__(self, begins_file: bool):
        self.ends, self.asks = [], []
        self.at, self.skip = 0, int(begins_file)

    def add(self, piece: bytes) -> None:
        self.at += len(piece) + len(SEPARATOR)
        self.ends.append(self.at)
        self.asks.append(warc_gz.needed(piece) or 0)

    def steps(self) -> list[tuple[int, int]]:
        """(upto, after): a state of at most `upto`, and more than the one before's, becomes `after` at the end of the split; one greater than all loses the bytes of the split."""
        n, after = len(self.ends), [0] * (len(self.ends) + 1)
        for j in range(n - 1, -1, -1):
            stop = (self.ends[j - 1] if j else 0) + len(SEPARATOR) + self.asks[j]
            nxt = max(bisect.bisect_left(self.ends, stop), j) + 1
            after[j] = after[nxt] if nxt <= n else stop - self.ends[-1]
        out = [(0, after[self.skip])]
        for j, upto in enumerate(self.ends):
            if after[j + 1] == out[-1][1]:
                out[-1] = (upto, out[-1][1])
            else:
                out.append((upto, after[j + 1]))
        return out


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (file, block), values in framing.by_split(batches):
        chain = Chain(block == 0)
        for piece in values:
            chain.add(piece)
        upto, after = zip(*chain.steps(), strict=True)
        yield pa.RecordBatch.from_pydict({"file": [file], "block": [block], "bytes": [chain.at], "upto": [list(upto)], "after": [list(after)]})


def begun_records(summaries: list) -> dict[tuple[str, int], tuple[int, int]]:
    """For each split that begins inside a record: the split that the record begins in, and how many bytes it still asks for."""
    out = {}
    for own in framing.in_order(summaries):
        owner, state = None, 0
        for r in own:
            if state:
                out[r["file"], r["block"]] = owner, state
            if state > r["bytes"]:
                state -= r["bytes"]
                continue
            state = r["after"][bisect.bisect_left(r["upto"], state)]
            owner = r["block"]
    return out


def plain_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record) of the files that aren't compressed: all bytes after a record's mark, up to the next record's."""
    scan = framing.pieces(spark, path, SEPARATOR, "*[!z]")
    begun = begun_records(scan.mapInArrow(_chains, "file string, block long, bytes long, upto array<long>, after array<long>").collect())
    mark = SEPARATOR.encode()

    def read(key: tuple[str, int], values: Iterator[bytes]) -> Iterator[tuple[int | None, bytes]]:
        owner, left = begun.get(key, (None, 0))
        held: list[bytes] | None = [] if owner is not None else None
        for k, piece in enumerate(values):
            if k == 0 and key[1] == 0:
                continue  # what stands before the first mark
            if left > 0:
                held.append(mark + piece)
                left -= len(mark) + len(piece)
                continue
            if held is not None:
                yield owner, b"".join(held)
            owner, held, left = None, [piece], (warc_gz.needed(piece) or 0) - len(piece)
        if held is not None:
            yield (owner if owner is not None or left <= 0 else key[1]), b"".join(held)

    return framing.joined(framing.fragments(scan, read))


def raw_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record) of .warc files and .warc.gz files at a path."""
    warc_gz.register(spark)
    packed = spark.read.format("warc_gz").option("path", path).load()
    return packed if path.endswith(".gz") else plain_records(spark, path).unionByName(packed)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """(uri, date, status, content_type, body) of every response record; bytes are searched as Latin letters, one a byte."""
    rec = raw_records(spark, path).select(F.decode("record", "ISO-8859-1").alias("s"))
    end = F.locate("\r\n\r\n", F.col("s"))
    rec = rec.filter(end > 0).withColumns({"head": F.substr("s", F.lit(1), end - 1), "rest": F.substr("s", end + 4)})
    field = lambda text, name: F.nullif(F.regexp_extract(text, rf"(?im)^{name}:\s*(\S+)", 1), F.lit(""))
    rec = rec.filter(field("head", "WARC-Type") == "response").withColumn("size", field("head", "Content-Length").try_cast("int"))
    rec = rec.withColumn("rest", F.when(F.col("size").isNotNull(), F.substr("rest", F.lit(1), F.col("size"))).otherwise(F.regexp_replace("rest", r"(\r\n){2}\z", "")))
    gap = F.locate("\r\n\r\n", F.col("rest"))
    rec = rec.filter(gap > 0).withColumns({"http": F.substr("rest", F.lit(1), gap - 1), "body": F.encode(F.substr("rest", gap + 4), "ISO-8859-1")})
    chunked = F.col("http").rlike(r"(?i)transfer-encoding:\s*chunked")
    coding = F.lower(F.regexp_extract("http", r"(?i)content-encoding:\s*([\w-]+)", 1))
    body = F.when(chunked | (coding != ""), _uncoded("body", chunked, coding)).otherwise(F.col("body"))
    kind = F.nullif(F.trim(F.regexp_extract("http", r"(?im)^content-type:\s*([^\r\n;]+)", 1)), F.lit(""))
    status = F.regexp_extract("http", r"^HTTP/[\d.]+\s+(\d{3})", 1).try_cast("int")
    return rec.select(field("head", "WARC-Target-URI").alias("uri"), field("head", "WARC-Date").alias("date"), status.alias("status"), kind.alias("content_type"), body.alias("body"))


def html_pages(responses: DataFrame, host: str) -> DataFrame:
    """Successful responses of HTML whose address fits the pattern, with the file name that each gets."""
    kept = responses.filter(F.col("uri").rlike(host) & F.col("content_type").rlike("(?i)text/html") & F.col("status").between(200, 299))
    return kept.withColumn("name", url_slug(F.col("uri")))


def page_text(body: Column) -> Column:
    """A page's bytes as text."""
    return F.decode(body, "UTF-8")


def extract_pages(pages: DataFrame, folder: str) -> int:
    """Writes each page (uri, date, name, body) as a file of its name below a folder, and returns how many there are; none is an error.

    Of several captures with one name the last by date is written. A task that runs again writes the same files."""
    last = pages.filter("uri is not null").groupBy("name").agg(F.max_by("body", F.struct("date", F.xxhash64("body"))).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = arrow_files(folder)
        n, made = 0, set()
        for batch in batches:
            for name, body in ((n, b) for piece in in_pieces(batch) for n, b in zip(piece.column("name").to_pylist(), piece.column("body").to_pylist(), strict=True)):
                if (within := f"{root}/{name}".rpartition("/")[0]) not in made:
                    files.create_dir(within, recursive=True)
                    made.add(within)
                with files.open_output_stream(f"{root}/{name}") as out:
                    out.write(body)
                n += 1
        yield pa.RecordBatch.from_pydict({"n": [n]})

    n = last.mapInArrow(run, "n long").agg(F.sum("n")).first()[0]
    if not n:
        raise ValueError(f"no page to write to {folder}")
    return n
