"""Posts from saved HTML pages: native thread pages, and two older hand-made templates.

Pages are read whole, one row each. A small helper over Arrow batches gives the raw texts of each post; times, file names and
clean bodies are column expressions afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.functions.batches import in_pieces
from boardlake.functions.texts import clean_body_text, file_name_from, flat_identity, nested_thread, strip_nulls, text_or_null, thread_from_name, valid_number_text
from boardlake.functions.times import parse_display_date

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Folders of a mirror that hold no pages; fixed values.
ASIDE = r"(_files|/css|/js|/images|/thumbs)/"
POSTS = pa.list_(pa.struct([(c, pa.bool_() if c == "op" else pa.string()) for c in "no op utc shown name trip subject body file md5".split()]))
POSTS_DDL = "array<struct<" + ", ".join(f"{f.name}: {'boolean' if f.name == 'op' else 'string'}" for f in POSTS.value_type) + ">>"


class Node:
    """An element: its tag, attributes, and children, which are nodes and strings."""

    __slots__ = ("tag", "attrs", "inside")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.inside = tag, attrs, []

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def walk(self, skip=lambda n: False) -> Iterator[Node]:
        """All elements inside, in page order, without those that skip names and what is in them."""
        todo = [c for c in reversed(self.inside) if isinstance(c, Node)]
        while todo:
            node = todo.pop()
            if not skip(node):
                yield node
                todo += [c for c in reversed(node.inside) if isinstance(c, Node)]

    def all(self, fits) -> list[Node]:
        return [n for n in self.walk() if fits(n)]

    def one(self, fits, skip=lambda n: False) -> Node | None:
        return next((n for n in self.walk(skip) if fits(n)), None)

    def text(self, skip=lambda n: False, stop=lambda n: False) -> str:
        """The text inside, `<br>` as a line feed, without elements that skip names, up to the first that stop names."""
        out, todo = [], list(reversed(self.inside))
        while todo:
            c = todo.pop()
            if isinstance(c, str):
                out.append(c)
            elif c.tag == "br":
                out.append("\n")
            elif stop(c):
                break
            elif not skip(c):
                todo += list(reversed(c.inside))
        return "".join(out)


class Reader(HTMLParser):
    """Builds the nodes of a page; an end tag without a start is dropped, an element left open ends with its parent."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#page", {})
        self.open, self.count = [self.root], {}

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].inside.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.count[tag] = self.count.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.open[-1].inside.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        if self.count.get(tag):
            while True:
                last = self.open.pop()
                self.count[last.tag] -= 1
                if last.tag == tag:
                    return

    def handle_data(self, data):
        self.open[-1].inside.append(data)


def page_of(html: str) -> Node:
    reader = Reader()
    reader.feed(html)
    reader.close()
    return reader.root


def has(tag: str | None = None, cls: str | None = None, **attrs):
    """A test for elements by tag, class and attributes; an attribute of None need only be there."""
    wanted = {k.replace("_", "-"): v for k, v in attrs.items()}
    return lambda n: (tag is None or n.tag == tag) and (cls is None or cls in n.classes()) and all(k in n.attrs and v in (None, n.attrs[k]) for k, v in wanted.items())


def trimmed(node: Node | None) -> str | None:
    return (node.text().strip() or None) if node else None


def native(page: Node) -> list[dict]:
    """The posts of a native page. A number that comes in a desktop and a mobile block is one post."""
    out, seen = [], set()
    for box in page.all(has(cls="postContainer")):
        m = re.fullmatch(r"pc(\d+)", box.attrs.get("id", ""))
        if not m or not int(m[1]) or m[1] in seen:
            continue
        seen.add(m[1])
        info = box.one(lambda n: {"postInfo", "desktop"} <= set(n.classes())) or box.one(lambda n: {"postInfoM", "mobile"} <= set(n.classes())) or box
        pick = lambda cls: trimmed(info.one(has(cls=cls))) or trimmed(box.one(has(cls=cls)))  # noqa: E731, B023
        stamp = info.one(has(data_utc=None)) or box.one(has(data_utc=None))
        line = box.one(has(cls="fileText"))
        link = line.one(has("a")) if line else None
        body = box.one(has("blockquote", "postMessage"))
        digest = box.one(has(data_md5=None))
        out.append({
            "no": m[1], "op": "opContainer" in box.classes(), "utc": stamp.attrs["data-utc"] if stamp else None, "shown": None, "name": pick("name"), "trip": pick("postertrip"), "subject": pick("subject"),
            "body": body.text(skip=has(cls="abbr")) if body else None, "file": (link.attrs.get("title") or link.text() or None) if link else None, "md5": digest.attrs["data-md5"] if digest else None,
        })
    return out


def later(page: Node) -> list[dict]:
    """The newer hand-made template: an element of class post for each post, the first of them opens the thread."""
    out = []
    for post in page.all(has(cls="post")):
        pick = lambda cls: trimmed(post.one(has(cls=cls)))  # noqa: E731, B023
        no = pick("post_no") or ""
        if re.fullmatch(r"\d+", no) and int(no):
            body = post.one(has(cls="post_com"))
            out.append({"no": no, "op": not out, "utc": None, "shown": pick("post_now"), "name": pick("post_name"), "trip": pick("post_id"), "subject": pick("post_sub"), "body": body.text() if body else None, "file": pick("post_filename"), "md5": None})
    return out


DATE = re.compile(r"\d{2}/\d{2}/\d{2}\([A-Za-z]{3}\)\d{2}:\d{2}(?::\d{2})?")


def shown_date(node: Node, reply) -> str | None:
    """The date of a classic post: in its .posttime, loose among its own texts, or anywhere before its body and the replies."""
    span, quote = node.one(has(cls="posttime"), reply), has("blockquote")
    loose = " ".join(c for c in node.inside if isinstance(c, str))
    for text in (span.text() if span else "", loose, node.text(stop=lambda n: quote(n) or reply(n))):
        if m := DATE.search(text):
            return m[0]
    return None


def classic(page: Node, thread: str | None) -> list[dict]:
    """The older template: the opening post lies loose in the page, replies are cells of class reply."""
    body = page.one(has("body")) or page.one(has("html")) or page
    reply = has("td", "reply")

    def post(node: Node, no: str, op: bool, name: str, title: str) -> dict:
        pick = lambda cls: trimmed(node.one(has("span", cls), reply))
        text = node.one(has("blockquote"), reply)
        return {"no": no, "op": op, "utc": None, "shown": shown_date(node, reply), "name": pick(name), "trip": pick("postertrip"), "subject": pick(title), "body": text.text() if text else None, "file": pick("filesize"), "md5": None}

    mark = body.one(lambda n: n.tag == "span" and re.fullmatch(r"nothread\d+", n.attrs.get("id", "")))
    first = mark.attrs["id"].removeprefix("nothread") if mark else thread
    out = [post(body, first, True, "postername", "filetitle")] if first else []
    return out + [post(n, n.attrs["id"], False, "commentpostername", "replytitle") for n in page.all(reply) if re.fullmatch(r"\d+", n.attrs.get("id", "")) and int(n.attrs["id"])]


def legacy(page: Node, thread: str | None) -> list[dict]:
    """By the template that the page shows: newer, older, or none."""
    if page.one(has(cls="post_com")):
        return later(page)
    if page.one(has("td", "reply")) or page.one(has("span", "postername")):
        return classic(page, thread)
    return []


def _found(batches: Iterator[pa.RecordBatch], read: Callable[[str, int | None], list[dict]]) -> Iterator[pa.RecordBatch]:
    """What read finds in the pages of a batch, a piece at a time."""
    own = ["file", "board", "thread"]
    for piece in (p for batch in batches for p in in_pieces(batch)):
        rows = zip(piece.column("page").to_pylist(), piece.column("thread").to_pylist(), strict=True)
        posts = [[] if page is None else read(page, thread) for page, thread in rows]
        yield pa.RecordBatch.from_arrays([*map(piece.column, own), pa.array(posts, POSTS)], names=[*own, "posts"])


def _with_posts(pages: DataFrame, read: Callable[[str, int | None], list[dict]]) -> DataFrame:
    """(file, board, thread, posts) of pages (file, board, thread, page): what read finds in a page."""
    return pages.select("file", F.col("board").cast("string").alias("board"), "thread", "page").mapInArrow(lambda batches: _found(batches, read), f"file string, board string, thread long, posts {POSTS_DDL}")


def read_pages(spark: SparkSession, root: str) -> DataFrame:
    """(file, page) of all saved pages below a folder but those in folders of a mirror's files."""
    text = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.htm*")
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("page")).filter(~F.col("file").rlike(ASIDE))


def _rows(each: DataFrame, ts: Column, file: Column, site: str, thread: Column) -> DataFrame:
    p = F.col("p")
    clean = lambda c: text_or_null(strip_nulls(c))
    # the helper has decoded references; what still looks like mark-up is broken mark-up
    body = clean_body_text(F.replace(strip_nulls(p["body"]), F.lit("&"), F.lit("&amp;")))
    return each.select(F.lit(site).alias("site"), "board", thread.alias("thread_no"), valid_number_text(p["no"]).alias("post_no"), p["op"].alias("is_op"), ts.alias("ts_utc"), clean(p["name"]).alias("name"), clean(p["trip"]).alias("tripcode"), clean(p["subject"]).alias("subject"), body.alias("body_text"), file.alias("media_filename"), p["md5"].alias("media_md5"), "file")


def native_posts(pages: DataFrame, site: str = "site0") -> DataFrame:
    """The posts of native pages (file, board, page). A file name of digits alone asserts the thread, else the page's opening post does."""
    name = F.element_at(F.split("file", "/"), -1)
    some = pages.filter(F.contains("page", F.lit("postContainer"))).select("file", "board", thread_from_name(name).alias("thread"), "page")
    posts = _with_posts(some, lambda page, _: native(page_of(page)))
    opening = valid_number_text(F.get(F.filter("posts", lambda p: p["op"]), F.lit(0))["no"])
    each = posts.select("file", "board", "thread", opening.alias("opening"), F.explode("posts").alias("p"))
    utc = F.when(F.col("p.utc").rlike(r"^\d+$"), F.col("p.utc").try_cast("long"))
    return _rows(each, utc, text_or_null(F.col("p.file")), site, F.coalesce("thread", "opening"))


def legacy_posts(pages: DataFrame, site: str = "site0") -> DataFrame:
    """The posts of hand-made pages (file, board, page). The board and thread are in the name <board>_<no>, else the thread is its leading digits; the page's own opening post wins."""
    name = F.element_at(F.split("file", "/"), -1)
    board, flat = flat_identity(name)
    named = pages.select("file", "page", F.coalesce("board", board).alias("board"), F.coalesce(flat, nested_thread(name)).alias("thread"))
    posts = _with_posts(named, lambda page, thread: legacy(page_of(page), None if thread is None else str(thread)))
    opening = valid_number_text(F.get(F.filter("posts", lambda p: p["op"]), F.lit(0))["no"])
    each = posts.select("file", "board", "thread", opening.alias("opening"), F.explode("posts").alias("p"))
    file = F.when(F.col("p.file").rlike(r"^File\s*:?|\(.*\)\s*$"), file_name_from(F.col("p.file"))).otherwise(text_or_null(F.col("p.file")))
    return _rows(each, parse_display_date(F.col("p.shown")), file, site, F.coalesce("opening", "thread"))


def unread_pages(pages: DataFrame, native: bool = True) -> DataFrame:
    """The files that give no post."""
    posts = (native_posts if native else legacy_posts)(pages)
    return pages.select("file").join(posts.select("file").distinct(), "file", "left_anti")
