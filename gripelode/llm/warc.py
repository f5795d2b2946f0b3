"""WARC archives: written by Spark, indexed first, then read by coalesced byte ranges.

``write`` makes one archive per task: each row is one record as text, and records end with the blank lines that WARC asks
for, so the text writer with that separator gives valid archives with the usual commit of task output. ``index`` scans the
archives once, a bounded segment of work per file, and returns offset, length, URL and digest of each record. ``read`` takes
any selection of index rows, sorts them by place, and fetches neighbouring records with one read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gripelode.llm import common

END = "\r\n\r\n"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
READ_BYTES = 8 << 20  # most bytes of one read, unless a record is longer
GAP_BYTES = 64 << 10  # unselected bytes that one read may pass over
SEGMENT_BYTES = 16 << 20  # bytes of an archive whose records one task reads
INDEX = "path string, offset long, length long, record_type string, url string, payload_digest string, record_id long, refers_to long, payload_bytes long"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 5 hexadecimal digits are 4 characters."""
    digest = F.sha1(payload)
    parts = []
    for i in range(8):
        bits = F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            parts.append(F.substring(F.lit(ALPHABET), F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)))
    return F.concat(*parts)


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0) -> None:
    """Write one record per row. Of equal payloads of at least ``min_bytes`` bytes the smallest id's is the response, the
    others revisit it. Null payloads are empty; line ends in URLs become spaces; rows with a null id are not written, and
    of rows that repeat an id and payload the copies are responses as well.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload")).where("page_id is not null")
    rows = rows.withColumn("payload_digest", base32_sha1(F.col("payload"))).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    keys = rows.where(F.col("payload_bytes") >= min_bytes).select("page_id", "payload_digest", "payload_bytes")
    first = keys.groupBy("payload_digest", "payload_bytes").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    first = common.stage(first, "first")
    # Few payloads repeat as a rule; then no payload is shuffled.
    rows = rows.join(common.small(first), ["payload_digest", "payload_bytes"], "left")
    rows = rows.withColumn("refers_to", F.when(F.col("refers_to") < F.col("page_id"), F.col("refers_to")))
    revisit = F.col("refers_to").isNotNull()
    record_id = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    url = F.translate("url", "\r\n", "  ")
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", record_id(F.col("page_id"))),
        _line("WARC-Target-URI", url),
        _line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(_line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), _line("WARC-Refers-To", record_id(F.col("refers_to"))))).otherwise(F.lit("")),
        _line("X-Payload-Length", F.col("payload_bytes")),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))),
        F.lit("\r\n"),
    )
    rows.select(F.concat(header, F.when(revisit, F.lit("")).otherwise(F.col("payload"))).alias("value")).write.option("lineSep", END).text(folder)


def open_archive(path: str):
    """A seekable file of the shared store: file://, hdfs://, s3:// and whatever else Arrow's file systems read."""
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path.replace("file:///", "/", 1) if path.startswith("file:///") else path.replace("file:/", "/", 1))
    return store.open_input_file(inner)


def parse_header(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record here: {lines[0][:40]!r}")
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}


def scan(path: str) -> Iterator[tuple[int, int, dict[str, str]]]:
    """(offset, length, header) of all records of an archive, read block by block; payloads are passed over."""
    with open_archive(path) as file:
        size, base, held = file.size(), 0, b""
        while base < size:
            while (cut := held.find(END.encode())) < 0:
                block = file.read_at(min(1 << 20, size - base - len(held)), base + len(held))
                if not block:
                    raise ValueError(f"{path}: a record at {base} ends too early")
                held += block
            header = parse_header(held[:cut])
            length = cut + len(END) + int(header["content-length"]) + len(END)
            yield base, length, header
            held = held[length:] if length <= len(held) else b""
            base += length


def _page(value: str | None) -> int | None:
    return int(value.rpartition(":")[2].rstrip(">")) if value else None


def _frame(rows: list, columns: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=columns, dtype=object)
    return out.astype({c: "Int64" for c in columns if c in {"offset", "length", "record_id", "refers_to", "payload_bytes"}})


def _index(batches):
    names = [c.split()[0] for c in INDEX.split(", ")]
    for batch in batches:
        for path in batch["path"]:
            rows = []
            for offset, length, h in scan(path):
                rows.append((path, offset, length, h["warc-type"], h["warc-target-uri"], h["warc-payload-digest"].removeprefix("sha1:"), _page(h["warc-record-id"]), _page(h.get("warc-refers-to")), int(h["x-payload-length"])))
                if len(rows) == 5000:
                    yield _frame(rows, names)
                    rows = []
            yield _frame(rows, names)


def index(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of all archives in the folder, staged."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path")
    spread = files.repartition(common.partitions(spark), "path")
    return common.stage(spread.mapInPandas(_index, INDEX), "index")


def _read(batches):
    columns = ["path", "offset", "length", "payload"]
    for batch in batches:
        rows, at = batch.to_dict("records"), 0
        while at < len(rows):
            end = at + 1
            begin, stop = rows[at]["offset"], rows[at]["offset"] + rows[at]["length"]
            while end < len(rows) and rows[end]["path"] == rows[at]["path"] and rows[end]["offset"] - stop <= GAP_BYTES and rows[end]["offset"] + rows[end]["length"] - begin <= READ_BYTES:
                stop = max(stop, rows[end]["offset"] + rows[end]["length"])
                end += 1
            with open_archive(rows[at]["path"]) as file:
                raw = file.read_at(stop - begin, begin)
            out = []
            for r in rows[at:end]:
                record = raw[r["offset"] - begin : r["offset"] - begin + r["length"]]
                cut = record.index(END.encode())
                parse_header(record[:cut])
                out.append((r["path"], r["offset"], r["length"], record[cut + len(END) : -len(END)]))
            yield _frame(out, columns)
            at = end


def read(selected: DataFrame) -> DataFrame:
    """(path, offset, length, payload) of the selected index rows (path, offset, length); a revisit's payload is empty."""
    part = F.floor(F.col("offset") / SEGMENT_BYTES)
    rows = selected.select("path", "offset", "length").distinct()
    rows = rows.repartition(common.partitions(rows.sparkSession), "path", part).sortWithinPartitions("path", "offset")
    return rows.mapInPandas(_read, "path string, offset long, length long, payload binary")


def verified(selected: DataFrame) -> DataFrame:
    """The selected index rows; a response whose payload does not have the digest and length of its header fails the job."""

    def digests(batches):
        for batch in batches:
            found = [base64.b32encode(hashlib.sha1(p).digest()).decode() for p in batch["payload"]]
            yield batch[["path", "offset"]].assign(read_digest=found, read_bytes=batch["payload"].map(len).astype("int64"))

    payloads = read(selected).mapInPandas(digests, "path string, offset long, read_digest string, read_bytes long")
    joined = selected.join(payloads, ["path", "offset"])
    good = (F.col("record_type") == "revisit") | ((F.col("read_digest") == F.col("payload_digest")) & (F.col("read_bytes") == F.col("payload_bytes")))
    return joined.withColumn("payload_digest", F.when(good, F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.lit("damaged record in "), F.col("path")))))


def archive(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, **columns) -> DataFrame:
    """Write pages as archives, read them back, and return (page_id, payload_bytes, payload_digest, record_type, refers_to)
    of all records, from the headers and the payloads read. An empty table gives no rows; extra columns are not read.
    """
    spark = common.prepare(pages.sparkSession, 2048)
    folder = folder or common.new_folder(spark, "warc")
    write(pages, folder, min_bytes=min_bytes, **columns)
    rows = verified(index(spark, folder))
    return rows.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")
