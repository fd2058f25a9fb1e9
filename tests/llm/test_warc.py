import glob
import hashlib

from ledgerloom.llm import warc
from ledgerloom.llm.storage import work_folder
from tests.llm.edge import NASTY

BIG = "ä" * 600


def archive(spark, rows, schema="page_id bigint, url string, html string, digest string"):
    folder = work_folder(spark, "warc")
    warc.write_archive(spark.createDataFrame(rows, schema), folder)
    return folder


def test_roles_and_digests(spark):
    rows = [(i, f"http://x/{i}", t, "d") for i, t in NASTY]
    rows += [(1, "http://a b\r\nX-Page-ID: 9", BIG, "d"), (7, None, BIG, None), (3, "u", BIG, "d"), (7, None, BIG, None)]
    folder = archive(spark, rows)
    got = warc.describe(warc.read_records(spark, folder)).collect()
    want = {}
    for i, _, t, _ in rows:
        want.setdefault((i, hashlib.sha1((t or "").encode()).hexdigest(), len((t or "").encode())), []).append(i)
    assert len(got) == len(rows)
    for r in got:
        assert want[(r.page_id, r.payload_digest, r.payload_bytes)]
    big = sorted((r.page_id, r.record_type, r.refers_to) for r in got if r.payload_bytes == 1200)
    assert big == [(1, "revisit", 7), (3, "revisit", 7), (7, "response", None), (7, "revisit", 7)]
    small = [r for r in got if r.payload_bytes < 1000]
    assert {r.record_type for r in small} == {"response"} and {r.refers_to for r in small} == {None}
    assert spark.read.parquet(f"{folder}/payloads").count() == len({t or "" for _, _, t, _ in rows})
    whole = [warc.describe(warc.read_records(spark, folder)).count(), warc.read_records(spark, folder, whole=True).count()]
    assert whole == [len(rows), len(rows)]


def test_warc_files_parse_by_length(spark):
    rows = [(i, f"http://x/{i}", f"page {i}\r\n\r\nline\n" * (i * 10), "d") for i in range(12)] + [(99, "u", "page 11\r\n\r\nline\n" * 110, "d")]
    folder = archive(spark, rows)
    out = work_folder(spark, "files")
    warc.export_files(warc.read_records(spark, folder), out)
    seen = {}
    for name in glob.glob(f"{out}/*.txt"):
        data = open(name, "rb").read()
        while data:
            head = data[: data.index(b"\r\n\r\n") + 4]
            length = int(dict(x.split(": ", 1) for x in head.decode().strip().split("\r\n")[1:])["Content-Length"])
            record, data = data[: len(head) + length + 4], data[len(head) + length + 4 :]
            r = warc.parse(record)
            seen[int(r["X-Page-ID"])] = (r["WARC-Type"], r["payload"])
    assert seen[11] == ("revisit", b"") and seen[99][1].decode() == rows[-1][2]
    assert all(seen[i][1].decode() == t for i, _, t, _ in rows if i != 11)


def test_empty(spark):
    folder = archive(spark, [])
    assert warc.describe(warc.read_records(spark, folder)).collect() == []
