"""Content-addressed WARC archive: record headers in one table, each payload once in another.

Writing: every page becomes a WARC record. Its header bytes (WARC fields and the HTTP header, exactly as in the record) go
to `records`; its payload goes to `payloads` under its SHA-256, stored once for all records that share it. Rows of one
digest are compared by length and SHA-1 before one of them is stored. Of equal payloads of at least `min_bytes` bytes
the record with the largest id is a `response` and the others are `revisit` records that refer to it; smaller payloads
are always responses. Reading joins both tables again, checks every stored payload against its digest and gives back
the bytes of each record. `export_files` writes them as plain .warc files.

The payload side of each join has one row per digest, so a payload that a third of all pages share is split by
the skew handling of the join, and payloads of one digest meet in the partial aggregate before the shuffle.

Defined cases: a null payload is empty; a null id is smaller than any other; of repeated rows exactly one is the response;
control characters and spaces in a URL are percent-encoded, a null URL is left out; an empty table gives an empty
archive; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.storage import file_scan

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed by the WARC 1.1 format


def _line(name: str, value: Column) -> Column:
    """A header field, or nothing when the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def _uri(url: Column) -> Column:
    out = url
    for code in [*range(33), 127]:
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return out


def _record_id(struct: str) -> Column:
    """A URN made from the row's place, so that repeated ids have records of their own."""
    h = F.md5(F.concat_ws("|", F.col(f"{struct}.id").cast("string"), F.col(f"{struct}.path"), F.col(f"{struct}.row").cast("string")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_archive(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 1000,
    date: str = "2000-01-01T00:00:00Z",
) -> None:
    """Write `folder`/payloads and `folder`/records. `date` is the WARC-Date of every record."""
    payload = F.encode(F.coalesce(F.col(f"`{payload_col}`"), F.lit("")), "UTF-8")
    pages = file_scan(pages)
    place = pages.metadataColumn("_metadata")
    rows = pages.select(
        F.struct(F.col(f"`{id_col}`").alias("id"), place["file_path"].alias("path"), place["row_index"].alias("row")).alias("this"),
        F.col(f"`{url_col}`").alias("url"),
        payload.alias("payload"),
        F.unhex(F.sha2(payload, 256)).alias("digest"),
        F.struct(F.octet_length(payload).cast("long").alias("bytes"), F.sha1(payload).alias("sha1")).alias("check"),
    )
    stored = rows.groupBy("digest").agg(
        F.first("payload").alias("payload"),
        F.max("this").alias("keeper"),
        F.count(F.lit(1)).alias("records"),
        F.min("check").alias("check"),
        F.max("check").alias("other"),
    )
    clash = F.raise_error(F.lit("two payloads share a SHA-256 digest"))
    stored = stored.withColumn("check", F.when(F.col("check") == F.col("other"), F.col("check")).otherwise(clash)).drop("other")
    stored.write.parquet(f"{folder}/payloads")

    store = rows.sparkSession.read.schema(stored.schema).parquet(f"{folder}/payloads").drop("payload")
    joined = rows.drop("payload", "check").join(store, "digest")
    revisit = (F.col("check.bytes") >= min_bytes) & (F.col("this") != F.col("keeper"))
    # Content-Length of the stored HTTP header names the whole payload; the WARC block of a revisit ends with that header.
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=UTF-8{CRLF}"),
        _line("Content-Length", F.col("check.bytes").cast("string")),
        F.lit(CRLF),
    )
    block = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("check.bytes"))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _record_id("this")),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", _uri(F.col("url"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("check.sha1"))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, _record_id("keeper"))),
        _line("X-Page-ID", F.col("this.id").cast("string")),
        _line("X-Refers-To-Page-ID", F.when(revisit, F.col("keeper.id").cast("string"))),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", block.cast("string")),
        F.lit(CRLF),
        http,
    )
    joined.select(F.encode(head, "UTF-8").alias("head"), "digest", revisit.alias("revisit")).write.parquet(f"{folder}/records")


def read_records(spark: SparkSession, folder: str, whole: bool = False) -> DataFrame:
    """The bytes of every record, joined from headers and payloads. `whole` gives revisits their payload, too."""
    records = spark.read.schema("head binary, digest binary, revisit boolean").parquet(f"{folder}/records")
    payloads = spark.read.schema("digest binary, payload binary").parquet(f"{folder}/payloads")
    wrong = F.raise_error(F.lit("a stored payload does not match its digest"))
    checked = F.when(F.unhex(F.sha2(F.col("payload"), 256)) == F.col("digest"), F.col("payload")).otherwise(wrong)
    end = F.encode(F.lit(CRLF * 2), "UTF-8")
    bare = records.filter(F.lit(not whole) & F.col("revisit")).select(F.concat("head", end).alias("record"))
    full = records.filter(F.lit(whole) | ~F.col("revisit")).join(payloads, "digest")
    return full.select(F.concat("head", checked, end).alias("record")).unionByName(bare)


def parse(record: bytes) -> dict:
    """Fields and payload of one record, found from its bytes and lengths alone."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split(CRLF)
    fields = dict(line.split(": ", 1) for line in lines)
    if version != "WARC/1.1" or rest[int(fields["Content-Length"]) :] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    return fields | {"http": dict(x.split(": ", 1) for x in http.decode().split(CRLF)[1:]), "payload": payload}


def describe(records: DataFrame) -> DataFrame:
    """One row per record, from its bytes: page_id, payload_bytes, payload_digest, record_type, refers_to, url."""

    def rows(batches):
        for batch in batches:
            out = []
            for record in batch.column(0):
                r = parse(record.as_py())
                kind, digest, size = r["WARC-Type"], r["WARC-Payload-Digest"].removeprefix("sha1:"), int(r["http"]["Content-Length"])
                if kind == "response" and (len(r["payload"]), hashlib.sha1(r["payload"]).hexdigest()) != (size, digest):
                    raise ValueError("a payload does not match its record")
                ids = [None if r.get(k) is None else int(r[k]) for k in ("X-Page-ID", "X-Refers-To-Page-ID")]
                out.append((ids[0], size, digest, kind, ids[1], r.get("WARC-Target-URI")))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)] if out else [pa.array([], f.type) for f in schema], schema=schema)

    schema = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
        + [("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())]
    )
    return records.select("record").mapInArrow(
        rows, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string"
    )


def export_files(records: DataFrame, folder: str) -> None:
    """Plain .warc files: the text sink writes the bytes of each record and ends it with the two line ends of the format."""
    body = F.expr("substring(record, 1, octet_length(record) - 4)").cast("string")
    records.select(body.alias("value")).write.option("lineSep", CRLF * 2).text(folder)
