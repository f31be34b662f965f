"""Secret scans: base patterns, then multipart credentials linked by an interval join inside scopes.

A scan over Arrow batches finds the base spans (assign, access, hex) and weak parts: identifiers (user, client or login
names that are assigned), weak secrets (runs of 20 or more token characters with a letter and a digit) and endpoints
(URLs and user@host:port). A weak part alone is no finding. It is reported when a complementary part lies within `SCOPE`
code points of the same text: an identifier or endpoint near a secret, a weak secret near an identifier or endpoint. Base
spans are always reported and count as parts.

The join is Spark's: parts are dealt to bins of SCOPE code points, each bin keeps the first and last start for each role,
and a part looks at its own bin and the two beside it. Two parts in one bin are always in scope, and for the bins beside,
the nearest start decides; so the join is exact, and no pairs are emitted however many parts a scope holds.

Defined results: a null or empty text has no spans. Rows are told apart by doc_id and a hash of the text, so repeated rows
each get the same result, and null ids work. Spans are code points, end exclusive; ties in start go by `KINDS`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import KeyFilter, row_key, table, written

SCOPE = 400
KINDS = ("assign", "access", "hex", "ident", "weak", "endpoint")
BASE = {
    "assign": (re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 20),
    "hex": (re.compile(r"[0-9a-f]{24,}"), 24),
}
#: A user before an @ begins where its run of characters does, so a run is looked at once.
WEAK = {
    "ident": re.compile(r"""(?i:user(?:name|_?id)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@+-]{3,})""", re.ASCII),
    "weak": re.compile(r"[A-Za-z0-9+/_-]{20,}"),
    "endpoint": re.compile(r"(?:https?|ftp|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]+|(?<![A-Za-z0-9_.-])[A-Za-z0-9_.-]++@[A-Za-z0-9.-]+:[0-9]{2,5}", re.ASCII),
}
#: A superset of what can hold a part, for a linear scan of a whole batch before the exact patterns run.
MAYBE = {
    "assign": r"(?i)passw|secret|token|api_?key", "access": "AKIA", "hex": "[0-9a-f]{24}",
    "ident": r"(?i)(user|login|account|client|access)[A-Za-z_]*[\"']? *[:=]", "weak": r"[A-Za-z0-9+/_-]{20}", "endpoint": r"://|@[A-Za-z0-9.-]+:[0-9]",
}
PART = "array<struct<kind:int,start:int,end:int>>"


def find(text: str, kinds: list[int]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every base span and weak part of a text, in order."""
    out = []
    for k in kinds:
        name = KINDS[k]
        if name in BASE:
            pattern, least = BASE[name]
            group = 1 if name == "assign" else 0
            out += [(m.start(), k, m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
        elif name == "weak":
            out += [(m.start(), k, m.end()) for m in WEAK[name].finditer(text) if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])]
        else:
            out += [(m.start(), k, m.end()) for m in WEAK[name].finditer(text)]
    out.sort()
    base = [(s, e) for s, k, e in out if k < len(BASE)]
    if base and len(base) < len(out):  # a weak part that touches a base span is that span
        clear, i, reach = [], 0, -1
        ends = sorted(base)
        for s, k, e in out:
            while i < len(ends) and ends[i][0] < e:
                reach = max(reach, ends[i][1])
                i += 1
            if k < len(BASE) or reach <= s:
                clear.append((s, k, e))
        out = clear
    return out


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("_k", pa.int64()), ("_h", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("base", pa.string()), ("parts", pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])))])
    nothing = hashlib.sha256(b"").hexdigest()
    for batch in batches:
        text = batch.column("text")
        flags = [pc.fill_null(pc.match_substring_regex(text, MAYBE[k]), False).to_numpy(zero_copy_only=False) for k in KINDS]
        n = batch.num_rows
        counts, base, parts = [[0] * n for _ in BASE], [""] * n, [[] for _ in range(n)]
        for i in range(n):
            kinds = [k for k in range(len(KINDS)) if flags[k][i]]
            if not kinds:
                continue
            found = find(text[i].as_py(), kinds)
            for _, k, _ in found:
                if k < len(BASE):
                    counts[k][i] += 1
            base[i] = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found if k < len(BASE))
            parts[i] = [{"kind": k, "start": s, "end": e} for s, k, e in found]
        digest = [hashlib.sha256(b.encode()).hexdigest() if b else nothing for b in base]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("_k"), batch.column("_h"), *[pa.array(c, pa.int64()) for c in counts], pa.array(digest, pa.string()), pa.array(base, pa.string()), pa.array(parts, schema.field("parts").type)], schema=schema)


def link(parts: DataFrame) -> DataFrame:
    """For each text (_k, _h) with weak parts: its reported spans as an array ordered by start and kind."""
    kind = {k: i for i, k in enumerate(KINDS)}
    is_secret = F.col("kind").isin(kind["assign"], kind["hex"], kind["weak"])
    role = F.when(is_secret, 0).when(F.col("kind") == kind["endpoint"], 2).otherwise(1)
    parts = parts.withColumns({"role": role, "bin": F.floor(F.col("start") / SCOPE)})
    bins = parts.groupBy("_k", "_h", "bin", "role").agg(F.min("start").alias("first"), F.max("start").alias("last"))
    bins = bins.groupBy("_k", "_h", "bin").agg(F.map_from_entries(F.collect_list(F.struct("role", F.struct("first", "last")))).alias("roles"))
    weak = parts.filter(F.col("kind") >= len(BASE)).withColumn("near", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)))
    bins = bins.withColumnRenamed("bin", "near")

    def in_scope(r: int) -> Column:
        got = F.element_at("roles", F.lit(r))
        return F.coalesce(F.when(F.col("near") == F.col("bin"), got.isNotNull()).when(F.col("near") < F.col("bin"), F.col("start") - got["last"] <= SCOPE).otherwise(got["first"] - F.col("start") <= SCOPE), F.lit(False))

    fits = F.when(F.col("role") == 0, in_scope(1) | in_scope(2)).otherwise(in_scope(0))
    linked = weak.join(bins, ["_k", "_h", "near"]).filter(fits).select("_k", "_h", "kind", "start", "end").distinct()
    base = parts.filter(F.col("kind") < len(BASE)).select("_k", "_h", "kind", "start", "end")
    return linked.unionByName(base).groupBy("_k", "_h").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("found"))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, the key columns _k and _h, base counts and digest, and found (all spans)."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), *row_key(key, text))
    fields = "doc_id long, _k long, _h long, n_assign long, n_access long, n_hex long, base_sha256 string, base string, parts " + PART
    scanned = written(rows.mapInArrow(scan, fields), "secret-parts")
    some = scanned.filter(F.exists("parts", lambda p: p["kind"] >= len(BASE))).select("_k", "_h", "parts")
    parts = some.dropDuplicates(["_k", "_h"]).select("_k", "_h", F.inline("parts").alias("kind", "start", "end"))
    own = F.transform("parts", lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), p["end"].alias("end")))
    out = scanned.join(link(parts), ["_k", "_h"], "left")
    return out.withColumn("found", F.coalesce("found", F.filter(own, lambda p: p["kind"] < len(BASE)))).drop("parts", "base")


def redact(text: Column, found: Column, mark: str = "[secret]") -> Column:
    """text with every span replaced by mark; spans that overlap are one."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    more = lambda a, s: F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(s["start"] >= a["at"], F.concat(a["out"], F.substr(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mark))).otherwise(a["out"]).alias("out"))
    return F.aggregate(found, start, more, lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1, F.length(text))))


def mask_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with the found secrets of every text masked; all rows and columns stay. Only rows that may hold a secret cross the network."""
    found = find_secrets(docs, key, text).filter(F.size("found") > 0).select("_k", "_h", "found").dropDuplicates(["_k", "_h"])
    found = written(found, "secret-spans")
    flagged = KeyFilter(found, ["_k", "_h"]).flagged(docs.select(F.struct("*").alias("_row"), *row_key(key, text)))
    some = flagged.filter("_maybe").join(found, ["_k", "_h"], "left")
    own = F.col("_row")[text]
    masked = F.when(F.col("found").isNotNull(), redact(own, F.col("found"))).otherwise(own)
    some = some.select(F.col("_row").withField(text, masked).alias("_row")).select("_row.*")
    return flagged.filter("not _maybe").select("_row.*").unionByName(some)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_secrets(table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = F.array_join(F.transform("found", lambda p: F.concat_ws(":", F.get(names, p["kind"]), p["start"].cast("string"), p["end"].cast("string"))), ",")
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", spans.alias("spans"))
