"""Operator 9: exact round trip, determinism and the revisit rule."""

from __future__ import annotations

import hashlib
import os

import pytest

from clickpath.llm.common import new_folder
from clickpath.llm.warc import archive_report, gzip_member, iter_records, make_record, parse_record, read_archive, write_archive


def page_rows():
    long_ = "<p>" + "é\r\nx" * 40000 + "</p>"
    body = "<html>" + "a" * 200 + "</html>"
    rows = [(i, f"http://h/{i}", body) for i in (9, 3, 5)] + [(4, None, body), (5, "http://again/", body)]
    rows += [(10, "u\r\nX: y", "short"), (11, "", "short"), (12, "u", None), (13, "u", ""), (14, "u", long_), (15, "u", long_)]
    rows += [(None, "u", body), (None, None, None), (2, "u", "b" * 99), (1, "u", "b" * 99), (20, "u", "b" * 100), (21, "u", "b" * 100)]
    return rows + [(100 + i, "u", f"<p>{i % 37}</p>" + "z" * 300) for i in range(150)]


def brute(rows, least=100):
    first = {}
    for page_id, _, html in rows:
        payload = (html or "").encode()
        if page_id is not None and len(payload) >= least:
            first[payload] = min(first.get(payload, page_id), page_id)
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        refers = first.get(payload)
        again = refers is not None and page_id is not None and page_id > refers
        out.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", refers if again else None))
    return sorted(out, key=str)


@pytest.fixture
def pages(spark, corpus):
    return spark.createDataFrame(page_rows(), "page_id long, url string, html string").selectExpr("*", "1 as shard", "'x' as digest", "2 as kind")


def files_of(folder):
    root = folder.removeprefix("file://").removeprefix("file:")
    return {n: open(os.path.join(root, n), "rb").read() for n in sorted(os.listdir(root)) if n.endswith(".warc.gz")}


def test_report_matches_brute_force(spark, pages):
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in archive_report(spark, pages).collect()]
    assert sorted(got, key=str) == brute(page_rows())


def test_archive_round_trip_and_determinism(spark, pages):
    archives = []
    for parts in (1, 7):
        folder = new_folder(spark, "warc-test")
        manifest = write_archive(pages.repartition(parts), folder, roll_bytes=2000, shard_bytes=20000)
        files = files_of(folder)
        assert len(files) == manifest.count() > 3
        for r in manifest.collect():
            assert hashlib.sha256(files[r["name"]]).hexdigest() == r["sha256"] and len(files[r["name"]]) == r["bytes"]
        archives.append(files)
        records = read_archive(manifest, folder).collect()
        sent = {(page_id, (html or "").encode()) for page_id, _, html in page_rows()}
        assert len(records) == len(page_rows())
        assert all((r.page_id, bytes(r.payload)) in sent for r in records if r.record_type == "response")
        assert all(r.payload is None for r in records if r.record_type == "revisit")
        rows = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read_archive(manifest, folder, payloads=False).collect()]
        assert sorted(rows, key=str) == brute(page_rows())
    assert archives[0] == archives[1]


def test_empty_table(spark, pages):
    assert archive_report(spark, pages.where("page_id < 0")).collect() == []


def test_damaged_records_are_errors(tmp_path):
    record = make_record(1, "u", b"payload", None)
    assert parse_record(record)[1] == b"payload"
    with pytest.raises(ValueError, match="digest"):
        parse_record(record.replace(b"payload\r", b"paylaod\r"))
    path = tmp_path / "x.warc.gz"
    path.write_bytes((gzip_member(record) * 3)[:-20])
    with open(path, "rb") as stream, pytest.raises(ValueError, match="inside a record"):
        list(iter_records(stream, chunk=16))
