"""WARC archives: writing with revisit records, reading with boundary-chain verification.

Reading does not trust the magic ``WARC/1.0``, which payloads may hold too. Tasks scan byte
ranges of the files and emit each candidate record with the offset at which its successor must
start. Pointer jumping from the start of every file then keeps what the chain of records reaches:
in round k the reached set follows jumps of 2^k records, and jumps are joined with
themselves. A magic inside a payload is on no chain. Payloads of kept records are then read
by range and streamed through the digest.

Null payloads are empty; equal payloads (of at least ``least`` bytes) are written once, by the
smallest page_id, and others revisit it; rows with a null page_id are responses that nothing
revisits; a page_id that repeats with the same payload is a response each time. Null urls
have no target line; line breaks in urls are escaped.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm.common import Stage, exact, table
from tracklake.session import staging_path

MAGIC = b"WARC/1.0\r\n"
END = b"\r\n\r\n"
RANGE_BYTES = 32 << 20
RECORDS_PER_FILE = 4096
#: Revisit rows that a broadcast may hold, about 60 bytes each.
BROADCAST_ROWS = 300_000
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: each 5 hexadecimal digits are 4 base32 digits."""
    digits = F.sha1(payload)
    groups = [F.conv(F.substring(digits, 5 * i + 1, 5), 16, 10).cast("int") for i in range(8)]
    return F.concat(*(F.substring(F.lit(_BASE32), F.shiftright(g, s).bitwiseAND(31) + 1, F.lit(1)) for g in groups for s in (15, 10, 5, 0)))


def write_archives(spark: SparkSession, pages: DataFrame, folder: str, least: int = 0) -> None:
    """A WARC record per row of ``pages`` (page_id, url, html) into files under ``folder``."""
    stage = Stage(spark, "warc")
    pages = exact(pages, "page_id", "url", "html").withColumn("html", F.coalesce("html", F.lit("")))
    pages = pages.withColumn("digest", payload_digest(F.encode("html", "UTF-8"))).withColumn("length", F.octet_length("html"))
    slim = stage(pages.select("page_id", "digest", "length"), "digests").where(F.col("length") >= least)
    firsts = slim.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = slim.join(firsts, "digest").where("page_id > first").select("page_id", "digest", "first").distinct()
    again = stage(again, "again")
    again = F.broadcast(again) if again.count() <= BROADCAST_ROWS else again
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    revisit = F.col("first").isNotNull()
    head = F.concat(
        F.lit(MAGIC.decode()),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        F.coalesce(line("WARC-Record-ID", urn(F.col("page_id"))), F.lit("")),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z\r\n"),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.coalesce(line("WARC-Refers-To", urn(F.col("first"))), F.lit("")),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\n")).otherwise(""),
        F.lit("Content-Type: text/html; charset=utf-8\r\n"),
        line("Content-Length", F.when(revisit, 0).otherwise(F.col("length")).cast("string")),
        F.lit("\r\n"),
    )
    record = F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    rows = pages.join(again, ["page_id", "digest"], "left").select(record.alias("record"))
    rows.write.option("lineSep", END.decode()).option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)
    stage.drop("digests", "again")


def open_file(path: str):
    """A seekable file of any file system that pyarrow knows; local paths may hold any character."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        name = "/" + rest.lstrip("/")
        try:
            return open(name, "rb")
        except FileNotFoundError:
            return open(unquote(name), "rb")
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
    return system.open_input_file(name)


def _header(data: bytes, at: int, more) -> tuple[dict[str, str], int] | None:
    """Header fields of the record that may start at ``at``, and where its block starts; ``more`` reads on."""
    stop = data.find(END, at)
    while stop < 0 and (extra := more()):
        data += extra
        stop = data.find(END, at)
    if stop < 0:
        return None
    fields = {}
    for row in data[at + len(MAGIC) : stop].split(b"\r\n"):
        name, colon, value = row.partition(b":")
        if not colon:
            return None
        fields[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    return (fields, stop + len(END)) if fields.get("content-length", "").isdigit() else None


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["path", "offset", "successor", "block", "length", "type", "record", "digest", "refers"]
    for batch in batches:
        for path, start, stop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows = []
            with open_file(path) as f:
                f.seek(start)
                data = f.read(stop - start + len(MAGIC) + 4096)
                at = data.find(MAGIC)
                while 0 <= at < stop - start:
                    found = _header(data[at : at + 4096], 0, lambda f=f, end=[start + at + 4096]: (f.seek(end[0]), end.__setitem__(0, end[0] + 65536), f.read(65536))[2])
                    if found:
                        h, block = found
                        n = int(h["content-length"])
                        rows.append((path, start + at, start + at + block + n + len(END), start + at + block, n, h.get("warc-type"), h.get("warc-record-id"), h.get("warc-payload-digest"), h.get("warc-refers-to")))
                    at = data.find(MAGIC, at + 1)
            columns = zip(*rows, strict=True) if rows else [[]] * 9
            kinds = [pa.string(), *[pa.int64()] * 4, *[pa.string()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path, f = None, None
    for batch in batches:
        out = []
        for p, block, n in zip(*(batch.column(c).to_pylist() for c in ("path", "block", "length")), strict=True):
            if p != path:
                if f:
                    f.close()
                path, f = p, open_file(p)
            f.seek(block)
            sha = hashlib.sha1()
            while n > 0 and (part := f.read(min(n, 1 << 20))):
                sha.update(part)
                n -= len(part)
            out.append(base64.b32encode(sha.digest()).decode() if n == 0 else None)
        yield batch.append_column("seen", pa.array(out, pa.string()))
    if f:
        f.close()


def read_archives(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """path, offset, block, length, type, record, digest, refers, seen of every verified record under ``folder``.

    ``seen`` is the digest of the bytes read. Records behind a broken link of a file's chain are not returned.
    """
    stage = Stage(spark, "chain")
    files = spark.read.format("binaryFile").load(folder).select("path", "length").where("length > 0")
    ranges = files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("start"), "length")
    ranges = ranges.select("path", "start", F.least(F.col("start") + range_bytes, F.col("length")).alias("stop"))
    ranges = ranges.repartition(F.xxhash64("path", "start"))
    schema = "path string, offset long, successor long, block long, length long, type string, record string, digest string, refers string"
    found = stage(ranges.mapInArrow(_candidates, schema), "candidates")
    ends = found.select("path", F.col("offset").alias("successor"))
    jumps = stage(found.select("path", "offset", "successor").join(ends, ["path", "successor"], "left_semi"), "jumps-0")
    reached, k = stage(found.where("offset = 0").select("path", "offset"), "reached-0"), 0
    while not jumps.isEmpty():
        ahead = reached.join(jumps, ["path", "offset"]).select("path", F.col("successor").alias("offset"))
        reached = stage(reached.unionByName(ahead).distinct(), f"reached-{k + 1}")
        then = jumps.select("path", F.col("offset").alias("successor"), F.col("successor").alias("beyond"))
        jumps = stage(jumps.join(then, ["path", "successor"]).select("path", "offset", F.col("beyond").alias("successor")), f"jumps-{k + 1}")
        stage.drop(f"reached-{k}", f"jumps-{k}")
        k += 1
    kept = found.join(reached, ["path", "offset"], "left_semi").drop("successor")
    kept = kept.repartition(F.col("path"), F.floor(F.col("offset") / range_bytes)).sortWithinPartitions("path", "offset")
    return kept.mapInArrow(_digests, "path string, offset long, block long, length long, type string, record string, digest string, refers string, seen string")


def round_trip(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, read back from its archive."""
    folder = folder or staging_path(spark, "warc-files")
    write_archives(spark, pages, folder)
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(.*)>$", 1)
    kind = exact(pages, "page_id").schema["page_id"].dataType.simpleString()
    rows = Stage(spark, "warc")(read_archives(spark, folder), "records")
    # pages that share an id but not a payload share a record id: a revisit's digest says which of them it repeats
    whole = rows.where("type = 'response' AND record IS NOT NULL").groupBy(F.col("record").alias("refers"), F.col("seen").alias("held")).agg(F.first("length").alias("full"))
    meant = rows.where("type = 'revisit'").withColumn("held", F.regexp_replace("digest", "^sha1:", ""))
    plain = rows.where("type <> 'revisit'").select("record", F.col("length").alias("payload_bytes"), F.col("seen").alias("payload_digest"), "type", "refers")
    again = meant.join(whole, ["refers", "held"], "left").select("record", F.col("full").alias("payload_bytes"), F.col("held").alias("payload_digest"), "type", "refers")
    id_of = lambda c: F.when(F.col(c).isNotNull(), number(F.col(c))).cast(kind)
    return plain.unionByName(again).select(id_of("record").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), id_of("refers").alias("refers_to"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark, table(spark, sf_dir, "pages"))


ORACLE = r"""
WITH d AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
b AS (
  SELECT page_id, payload_bytes, list_reduce(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(h, (5 * (i // 4) + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31) + 1, 1)), lambda a, c: a || c) AS payload_digest FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id > min(page_id) OVER w THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > min(page_id) OVER w THEN min(page_id) OVER w END AS refers_to
FROM b WINDOW w AS (PARTITION BY payload_digest)
"""
