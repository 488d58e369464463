"""WARC archives: writing, normalising monolithic gzip files, reading back.

``write_monolithic`` writes pages as WARC/1.1 records into gzip files that are one stream
each, as crawlers that compress whole files do. ``normalise`` inflates each such file once,
as a stream, finds the records by their Content-Length, rewrites every record as a gzip
member of its own and writes a sidecar index of the members' offsets beside each archive.
``read_records`` seeks to the indexed members and inflates them one by one.
"""

from __future__ import annotations

import base64
import hashlib
import os
import zlib
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quiver.llm.common import NULL_KEY, bit_filter, bounded_batches, maybe_in, pin
from quiver.llm.shared_files import Reader, write_file
from quiver.session import shared_path

_DATE = "2024-01-01T00:00:00Z"  # the pages carry no time of their own
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(text: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a string's UTF-8 bytes, in Spark functions: five
    hexadecimal digits are four base32 ones."""
    digits = F.sha1(text.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def pages_with_fate(pages: DataFrame, min_revisit_bytes: int = 0, id_col: str = "page_id", html_col: str = "html",
                    url_col: str = "url") -> DataFrame:
    """page_id, url, html, digest (base32 SHA-1 of the payload), bytes, is_revisit, refers_to.

    Of pages with equal payloads of at least ``min_revisit_bytes`` bytes the smallest id
    (nulls last) is a response, as are rows that repeat that id; the others revisit it. A
    null payload or url counts as empty. Groups are summed up before they are shuffled, and
    only pages of groups of two or more ids (found in the scan by a bit filter of fixed
    size) are shuffled to meet them.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.select("*", base32_sha1(F.col("html")).alias("digest"),
                       F.octet_length("html").cast("long").alias("bytes"))
    key = F.coalesce("page_id", F.lit(NULL_KEY))
    groups = pin(rows.where(F.col("bytes") >= min_revisit_bytes).groupBy("digest")
                 .agg(F.min(key).alias("first"), F.max(key).alias("last")).where("first != last")
                 .select(F.col("digest").alias("_digest"), "first"), "payload-groups")
    maybe = maybe_in(bit_filter(F.col("_digest"), groups), F.col("digest"))
    joined = rows.where(maybe).join(groups, F.col("digest") == F.col("_digest"), "left").drop("_digest")
    alone = rows.where(~maybe).withColumn("first", F.lit(None).cast("long"))
    revisit = F.coalesce(key != F.col("first"), F.lit(False))
    return joined.unionByName(alone).select("page_id", "url", "html", "digest", "bytes", revisit.alias("is_revisit"),
                                            F.when(revisit, F.col("first")).alias("refers_to"))


def write_monolithic(pages: DataFrame, folder: str | None = None, records_per_file: int = 4000, **options) -> str:
    """Write one record per page into whole-file gzip streams; returns the folder. A
    revisit record has no block but names the digest, the size and the page it refers to.
    Line ends in a url become a space; an empty table writes no records."""
    folder = folder or shared_path(pages.sparkSession, "llm-warc-whole")
    rows = pages_with_fate(pages, **options)

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(name + ": "), value, F.lit("\r\n"))

    def page(number: Column) -> Column:
        return F.concat(F.lit("<urn:quiver:page:"), F.coalesce(number.cast("string"), F.lit("")), F.lit(">"))

    revisit = F.col("is_revisit")
    block = F.when(revisit, "").otherwise(F.col("html"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", page(F.col("page_id"))), line("WARC-Date", F.lit(_DATE)),
        line("WARC-Target-URI", F.regexp_replace("url", "[\\r\\n]+", " ")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Payload-Length", F.col("bytes").cast("string")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(_PROFILE)), line("WARC-Refers-To", page(F.col("refers_to")))))
        .otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block, F.lit("\r\n\r"))
    # the text writer's line end completes each record
    (rows.select(record.alias("value")).write.option("compression", "gzip").option("lineSep", "\n")
     .option("maxRecordsPerFile", records_per_file).text(folder))
    return folder


def inflate(raw, step: int = 1 << 20):
    """The content of a gzip file of one or more members, in pieces of bounded size."""
    view, at = memoryview(raw), 0
    stream = zlib.decompressobj(31)
    while at < len(view):
        piece = stream.decompress(view[at: at + step], 8 * step)
        at += step
        while True:
            if piece:
                yield piece
            if stream.eof:
                at -= len(stream.unused_data)
                stream = zlib.decompressobj(31)
                break
            if not stream.unconsumed_tail:
                break
            piece = stream.decompress(stream.unconsumed_tail, 8 * step)


def split_records(pieces):
    """Whole records (bytes, with their final line ends) of a stream of WARC content."""
    held = bytearray()
    need = None
    for piece in pieces:
        held += piece
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                need = end + 4 + int(headers(bytes(held[:end]))["content-length"]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held:
        raise ValueError("the archive ends within a record")


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def member(record: bytes, level: int = 6) -> bytes:
    out = zlib.compressobj(level, zlib.DEFLATED, 31)
    return out.compress(record) + out.flush()


_INDEX = "file string, record long, offset long, length long"


def normalise(spark: SparkSession, source: str, folder: str | None = None, pattern: str = "*.gz") -> tuple[str, DataFrame]:
    """Rewrite every archive of ``source`` with one gzip member per record. Returns the
    folder and the offset index (file, record, offset, length); the same index lies beside
    each archive as ``<archive>.idx``, one line of offset and length per record."""
    folder = folder or shared_path(spark, "llm-warc")
    bounded_batches(spark, 1)

    def rewrite(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                name = os.path.basename(path).split(".")[0] + ".warc.gz"
                members = [member(r) for r in split_records(inflate(content.as_buffer()))]
                lengths = [len(m) for m in members]
                offsets = [end - n for end, n in zip(accumulate(lengths), lengths)]
                write_file(folder, name, members)
                write_file(folder, name + ".idx", [f"{o} {n}\n".encode() for o, n in zip(offsets, lengths)])
                yield pa.RecordBatch.from_pydict({
                    "file": pa.array([name] * len(lengths), pa.string()), "record": pa.array(range(len(lengths)), pa.int64()),
                    "offset": pa.array(offsets, pa.int64()), "length": pa.array(lengths, pa.int64())})

    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(source).select("path", "content"))
    return folder, pin(files.mapInArrow(rewrite, _INDEX), "warc-index")


def read_records(folder: str, index: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per indexed record: page_id, payload_bytes, payload_digest, record_type,
    refers_to and, if asked, the payload (null for a revisit). A response's size and digest
    come from the payload read; a digest other than its header's is an error."""
    bounded_batches(index.sparkSession)

    def read(batches):
        reader = Reader(folder)
        for batch in batches:
            rows = []
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                record = zlib.decompress(reader.read(file, offset, length), 31)
                head, _, rest = record.partition(b"\r\n\r\n")
                h = headers(head)
                block = rest[: int(h["content-length"])]
                digest, size = h["warc-payload-digest"].removeprefix("sha1:"), int(h["warc-payload-length"])
                if h["warc-type"] == "response":
                    own = base64.b32encode(hashlib.sha1(block).digest()).decode()
                    if own != digest:
                        raise ValueError(f"damaged record of {file} at {offset}")
                    size = len(block)
                rows.append({"page_id": _page(h["warc-record-id"]), "payload_bytes": size, "payload_digest": digest,
                             "record_type": h["warc-type"], "refers_to": _page(h.get("warc-refers-to", "")),
                             "payload": block if h["warc-type"] == "response" else None})
            yield pa.RecordBatch.from_pylist([{k: r[k] for k in schema.names} for r in rows], schema=schema)
        reader.close()

    fields = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
              ("record_type", pa.string()), ("refers_to", pa.int64())] + [("payload", pa.binary())] * with_payload
    schema = pa.schema(fields)
    return index.select("file", "offset", "length").mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
              + ", payload binary" * with_payload)


def _page(urn: str) -> int | None:
    number = urn.strip("<>").rpartition(":")[2]
    return int(number) if number else None
