"""WARC archives with revisit resolution.

1. Every page becomes a record: payload (the html in UTF-8), its SHA-1 in base 32, its size.
   The headers are written once.
2. Headers alone are shuffled by digest: of records with equal payloads of at least
   ``least_bytes`` the one with the largest page_id is the original, the others revisit it. The
   originals are a grouped maximum (combined before the shuffle); records are joined to them
   by digest, hot digests over salts.
3. Archives are written with fresh headers, a response with its payload, a revisit with the
   original's record id and no payload. Spark's text sink writes them: one row per record, the
   separator of rows being the blank lines that end a record, gzip-compressed and committed by task.
4. Reading takes whole archives, parses records by their Content-Length, and joins revisits to the
   responses that they name.

Defined results: a null or empty html is an empty payload; equal rows are separate records, one
of which is the response; a null page_id is smaller than any other; with no rows the archives
are empty and so is the result; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postmart.session import fresh_dir

from .common import cut, join_spread, spread_keys

LEAST_BYTES = 0
RECORDS_PER_FILE = 20_000
DATE = "2024-01-01T00:00:00Z"  # of all fresh headers, so that a rerun writes the same bytes
END = "\r\n\r\n"

HEADERS = ("record_id string, record_type string, page_id long, url string, payload_digest string, "
           "content_bytes long, refers_to_id string")


def digests(pages: DataFrame) -> DataFrame:
    """page_id, url, html, payload_bytes and payload_digest of every page."""
    def run(batches):
        for batch in batches:
            raw = [(h or "").encode() for h in batch.column(2).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(map(len, raw), pa.int64()),
                                   pa.array([base64.b32encode(hashlib.sha1(x).digest()).decode() for x in raw], pa.string())],
                                  names=["page_id", "url", "html", "payload_bytes", "payload_digest"])
    return (pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
            .mapInArrow(run, "page_id long, url string, html string, payload_bytes long, payload_digest string"))


def resolve(headers: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Digests of several records of at least ``least_bytes``: (payload_digest, original, equal, n).

    ``original`` is the largest page_id, ``equal`` the number of records that have it, ``n`` that of all.
    """
    return (headers.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "page_id")
            .agg(F.count("*").alias("n")).groupBy("payload_digest")
            .agg(F.max(F.struct("page_id", "n")).alias("top"), F.sum("n").alias("n")).where("n > 1")
            .select("payload_digest", F.col("top.page_id").alias("original"), F.col("top.n").alias("equal"), "n"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """Write deduplicated gzip-compressed archives of (page_id, url, html) to ``path``."""
    groups = cut(resolve(cut(digests(pages).drop("html", "url"), "headers"), least_bytes), "originals")
    hot = spread_keys(groups.select("payload_digest", "n"), "payload_digest", "n")
    found = join_spread(digests(pages), groups.select("payload_digest", "original", "equal"), "payload_digest", hot,
                        ["page_id", "url"], "left")
    grouped, first = F.col("equal").isNotNull(), F.col("page_id").eqNullSafe(F.col("original"))
    if groups.where("equal > 1").take(1):  # of records equal in page_id too, one is the response
        tied = grouped & first & (F.col("equal") > 1)
        order = F.row_number().over(Window.partitionBy("payload_digest").orderBy("url"))
        found = (found.where(~F.coalesce(tied, F.lit(False))).withColumn("again", grouped & ~first)
                 .unionByName(found.where(tied).withColumn("again", order > 1)))
    else:
        found = found.withColumn("again", grouped & ~first)

    def identity(name):
        return F.regexp_replace(F.md5(name), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")

    def line(name, value):
        return F.when(value.isNull(), "").otherwise(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")))
    again = F.col("again")
    of_payload = identity(F.concat(F.lit("payload-"), "payload_digest"))  # one response stands for a digest
    own = identity(F.concat(F.lit("record-"), F.monotonically_increasing_id().cast("string")))
    # A line end within a URL would end its header.
    clean = F.regexp_replace("url", "[\\r\\n]", " ")
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.when(again | (F.col("payload_bytes") < least_bytes), own).otherwise(of_payload)),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", clean),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        line("WARC-Refers-To", F.when(again, of_payload)),
        line("WARC-Profile", F.when(again, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        line("X-Page-ID", F.col("page_id").cast("string")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(again, F.lit(0)).otherwise(F.col("payload_bytes")).cast("string")),
        F.lit("\r\n"), F.when(again, "").otherwise(F.coalesce("html", F.lit(""))))
    (found.select(record.alias("value"))
     .write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def parse(stream) -> list[tuple]:
    """Header rows (as in HEADERS) of one archive's records; payloads are checked against their digests."""
    out = []
    while True:
        first = stream.readline()
        if not first:
            return out
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {first[:40]!r}")
        fields = {}
        for raw in iter(stream.readline, b"\r\n"):
            if not raw:
                raise ValueError("an archive ends within a header")
            name, _, value = raw.decode("utf-8").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        payload = stream.read(size)
        digest = fields["warc-payload-digest"].partition(":")[2]
        if len(payload) < size or stream.read(4) != END.encode():
            raise ValueError(f"record {fields['warc-record-id']} is cut short")
        if fields["warc-type"] == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"record {fields['warc-record-id']} doesn't match its digest")
        page = fields.get("x-page-id")
        out.append((fields["warc-record-id"], fields["warc-type"], page and int(page), fields.get("warc-target-uri"),
                    digest, size, fields.get("warc-refers-to")))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Headers of all records of the archives under ``path``."""
    names = [c.split()[0] for c in HEADERS.split(", ")]
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = parse(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py()))))
                columns = list(zip(*rows)) or [[]] * 7
                yield pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, HEADERS)


def resolved(headers: DataFrame) -> DataFrame:
    """Every record with the size of its full payload and, for a revisit, the page it refers to."""
    responses = headers.where("record_type = 'response'").select(
        "page_id", F.col("content_bytes").alias("payload_bytes"), "payload_digest", "record_type",
        F.lit(None).cast("long").alias("refers_to"))
    revisits = headers.where("record_type = 'revisit'")
    hot = spread_keys(revisits.groupBy("refers_to_id").agg(F.count("*").alias("n")), "refers_to_id", "n")
    named = headers.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"),
        F.col("content_bytes").alias("payload_bytes"))
    back = join_spread(revisits.select("record_id", "page_id", "payload_digest", "record_type", "refers_to_id"), named,
                       "refers_to_id", hot, ["record_id"])
    return responses.unionByName(back.select(*responses.columns))


def round_trip(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write deduplicated archives of all pages to the shared folder and report what is read back."""
    spark = pages.sparkSession
    path = fresh_dir(spark, "warc")
    write_archives(pages, path, least_bytes)
    return resolved(cut(read_archives(spark, path), "headers")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

