"""Secret scans with linking of multipart credentials.

A scan of each text finds spans. Base kinds (assign, access, hex) stand alone. Weak kinds are
parts that mean something only together: ``identifier`` (account or key names given a value),
``opaque`` (a mixed string as long as a key, not part of a base span) and ``endpoint`` (a URL or
host that is given a value). Parts are rows (text, kind, start, end); an interval join within
scopes of ``scope`` code points pairs every weak part with the complementary parts near it:

* identifier needs a secret (assign, hex or opaque) near it;
* opaque needs an identifier or access key near it;
* endpoint needs a secret and also an identifier or access key near it.

Weak parts without their complement are not reported. The join asks whether a complement is
there, so a scope crowded with parts costs a row for each, not one for each pair.

Defined results: a null or empty text has no span; offsets are code points, ends exclusive;
spans are ordered by start, then by kind as in KINDS; repeated rows are scanned alike; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

KINDS = ("assign", "access", "hex", "identifier", "opaque", "endpoint")
SCOPE = 400

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")

# Names may be the end of longer ones (DB_HOST, AWS_ACCESS_KEY_ID); a value may follow its '=' at once.
IDENTIFIER = re.compile(r"""(?<![A-Za-z0-9])(?:client_?id|access_?key(?:_?id)?|account(?:_?id|_?name)?|user_?name|login)["']?\x20*[:=]\x20*"""
                        r"""["']?([A-Za-z0-9@._-]{4,})""", re.I | re.A)
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}+={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"""(?<![A-Za-z0-9])(?:host|endpoint|server|url|uri)["']?\x20*[:=]\x20*["']?"""
                      r"""([A-Za-z0-9][A-Za-z0-9.:/_-]{3,})""", re.I | re.A)

PART = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())])


def _mixed(s: str) -> bool:
    """Digits, capitals and small letters, and at least half as many different characters as a random key has."""
    return (any(c.isdigit() for c in s) and any(c.isupper() for c in s) and any(c.islower() for c in s)
            and len(set(s)) >= 16)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of assign, access and hex."""
    out = [(0, *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        out += [(1, *m.span()) for m in ACCESS.finditer(text) if len(m.group()) >= 20]
    return out + [(2, *m.span()) for m in LONG_HEX.finditer(text)]  # runs of 24 and more, the others fail


def weak_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Weak parts outside the base spans."""
    out = [(3, *m.span()) for m in IDENTIFIER.finditer(text)]
    out += [(4, *m.span()) for m in OPAQUE.finditer(text) if _mixed(m.group())]
    out += [(5, *m.span()) for m in ENDPOINT.finditer(text)]
    if not out or not base:
        return out
    return [s for s in out if all(s[2] <= b[1] or s[1] >= b[2] for b in base)] if len(base) <= 8 else _outside(out, base)


def _outside(spans, base):
    from bisect import bisect_left
    merged: list[list[int]] = []
    for _, a, b in sorted(base, key=lambda x: x[1]):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    ends = [b for _, b in merged]
    keep = []
    for s in spans:
        k = bisect_left(ends, s[1] + 1)
        if k == len(merged) or merged[k][0] >= s[2]:
            keep.append(s)
    return keep


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted((a, k, b) for k, a, b in spans))


def scan(docs: DataFrame, keep: list[str], with_text: bool = False) -> DataFrame:
    """doc (a struct of the columns to keep), text (if asked for), base counts, digest and all parts of every row."""
    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                weak = weak_spans(text or "", base)
                parts = [{"kind": k, "start": a, "stop": b} for k, a, b in base + weak]
                out.append((*(sum(s[0] == k for s in base) for k in range(3)),
                            hashlib.sha256(joined(base).encode()).hexdigest(), parts))
            types = [*[pa.int64()] * 3, pa.string(), pa.list_(PART)]
            columns = [pa.array(list(c), t) for c, t in zip(list(zip(*out)) or [[]] * 5, types)]
            lead = [batch.column(0), batch.column(1)][:1 + with_text]
            yield pa.record_batch(lead + columns, names=schema.names)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("doc"), F.col("text").cast("string").alias("text"))
    schema = rows.select("doc", *["text"][:with_text], *(F.lit(0).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
                         F.lit("").alias("base_sha256"),
                         F.lit(None).cast("array<struct<kind:int,start:int,stop:int>>").alias("parts")).schema
    return rows.mapInArrow(run, schema)


def link(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak parts with their complement in scope, for rows (row, kind, start, stop): (row, kind, start, stop).

    Every part lies in the cells of ``scope`` code points that it touches; a weak part asks its own
    cells and both next to them. Per cell only the first and last part of each role matter:
    if any part of the role is within reach of a weak one, the nearest on either side is, and in the
    cell to the left that is the last, in the cell to the right the first. In its own cells every part
    is within reach.
    """
    secret, name = F.col("kind").isin(0, 2, 4), F.col("kind").isin(1, 3)
    weak = parts.where("kind >= 3")
    needed = parts.join(weak.select("row").distinct(), "row", "left_semi")
    role = F.when(secret, "secret").when(name, "name")
    cells = (needed.withColumn("role", role).where("role IS NOT NULL")
             .withColumn("cell", F.explode(F.sequence(F.expr(f"start div {scope}"), F.expr(f"(stop - 1) div {scope}"))))
             .groupBy("row", "cell", "role")
             .agg(F.min("start").alias("first_start"), F.max("stop").alias("last_stop"))
             .withColumn("own", F.expr(f"cell * {scope}")))
    ask = (weak.withColumn("low", F.expr(f"start div {scope}")).withColumn("high", F.expr(f"(stop - 1) div {scope}"))
           .withColumn("cell", F.explode(F.sequence(F.col("low") - 1, F.col("high") + 1))))
    near = ((F.col("cell").between(F.col("low"), F.col("high")))
            | ((F.col("cell") < F.col("low")) & (F.col("last_stop") > F.col("start") - scope))
            | ((F.col("cell") > F.col("high")) & (F.col("first_start") < F.col("stop") + scope)))
    found = (ask.join(cells, ["row", "cell"]).where(near).groupBy("row", "kind", "start", "stop")
             .agg(F.max((F.col("role") == "secret").cast("int")).alias("secret"),
                  F.max((F.col("role") == "name").cast("int")).alias("name")))
    return found.where("CASE kind WHEN 3 THEN secret = 1 WHEN 4 THEN name = 1 ELSE secret = 1 AND name = 1 END").select(
        "row", "kind", "start", "stop")


def with_spans(scanned: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Scanned rows with ``spans``, an array of (start, kind, stop): the base spans and the linked parts, in order."""
    found = cut(scanned.withColumn("row", F.monotonically_increasing_id()), "parts")
    weak = F.exists("parts", lambda p: p.kind >= 3)
    some = found.where(weak)                      # only texts with weak parts take part in the joins
    parts = some.select("row", F.explode("parts").alias("p")).select("row", "p.kind", "p.start", "p.stop")
    linked = (link(parts, scope).groupBy("row")
              .agg(F.collect_list(F.struct("kind", "start", "stop")).alias("linked")))  # parts of one text
    base = F.filter("parts", lambda p: p.kind < 3)

    def ordered(spans):
        return F.array_sort(F.transform(spans, lambda p: F.struct(
            p.start.alias("start"), p.kind.alias("kind"), p.stop.alias("stop")))).alias("spans")
    kept = [c for c in found.columns if c not in ("row", "parts")]
    return (found.where(~weak).select(*kept, ordered(base)).unionByName(
        some.join(linked, "row", "left")
        .select(*kept, ordered(F.when(F.col("linked").isNull(), base).otherwise(F.concat(base, "linked"))))))


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, base counts and digest, and all reported spans of every row of (doc_id, text)."""
    kind = F.array(*(F.lit(k) for k in KINDS))
    spans = F.array_join(F.transform("spans", lambda p: F.concat_ws(
        ":", F.element_at(kind, p.kind + 1), p.start.cast("string"), p.stop.cast("string"))), ",")
    return with_spans(scan(docs, ["doc_id"]), scope).select(
        F.col("doc.doc_id").cast("long").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256",
        spans.alias("spans"))


def mask_secrets(docs: DataFrame, scope: int = SCOPE, mark: str = "[secret]") -> DataFrame:
    """Documents with every reported span replaced by ``mark``; all rows and columns stay, n_chars follows the text."""
    def run(batches):
        for batch in batches:
            texts = [t if not s else _masked(t, [(x["start"], x["stop"]) for x in s], mark)
                     for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string()), batch.column(3)],
                                  names=["doc", "text", "changed"])
    keep = [c for c in docs.columns if c != "text"]
    found = (with_spans(scan(docs, keep, with_text=True), scope)
             .select("doc", "text", "spans", (F.size("spans") > 0).alias("changed")))
    done = found.mapInArrow(run, found.select("doc", "text", "changed").schema)

    def column(c):
        if c == "text":
            return F.col("text").cast(docs.schema[c].dataType)
        old = F.col("doc")[c]
        if c == "n_chars":
            old = F.when(F.col("changed"), F.length("text")).otherwise(old).cast(docs.schema[c].dataType)
        return old.alias(c)
    return done.select(*(column(c) for c in docs.columns))


def _masked(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """Spans in order of start; overlapping ones become one mark."""
    out, done = [], 0
    for a, b in spans:
        if a >= done:
            out += [text[done:a], mark]
        done = max(done, b)
    return "".join(out) + text[done:]
