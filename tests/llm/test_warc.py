import base64
import glob
import gzip
import hashlib

import pytest

from lapdeck.llm import warc

ROWS = [(1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (3, None, None), (4, "http://a/4", ""),
        (5, "http://a\r\nWARC-Type: x", "WARC/1.1\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"), (6, "http://a/6", "é" * 200_000),
        (7, "http://a/7", "<p>same</p>"), (7, "http://a/7", "<p>same</p>"), (None, "http://a/n", "<p>same</p>"), (None, "http://a/n", "only here")]


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warc") / "a")
    pages = spark.createDataFrame([(*r, "x", "y") for r in ROWS], "page_id long, url string, html string, file string, offset string").repartition(3)
    return folder, warc.archive(pages, folder, max_records=2).collect()


def digest(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def test_rows_digests_and_revisits(done):
    _, rows = done
    want = sorted((i or -1, len((h or "").encode()), digest((h or "").encode())) for i, _, h in ROWS)
    assert sorted((r.page_id or -1, r.payload_bytes, r.payload_digest) for r in rows) == want
    assert all(r.intact for r in rows)
    kinds = sorted((r.page_id or -1, r.record_type, r.refers_to) for r in rows if r.payload_digest == digest(b"<p>same</p>"))
    assert kinds == [(-1, "revisit", 1), (1, "response", None), (2, "revisit", 1), (7, "revisit", 1), (7, "revisit", 1)]
    empty = sorted((r.page_id, r.record_type, r.refers_to) for r in rows if r.payload_bytes == 0)
    assert empty == [(3, "response", None), (4, "revisit", 3)]


def test_archives_are_whole_and_headers_fresh(done, spark):
    folder, _ = done
    raw = warc.read_archives(spark, f"{folder}/raw", with_payload=True).collect()
    by_text = sorted((r.page_id or "", bytes(r.payload)) for r in raw)
    assert by_text == sorted((str(i) if i is not None else "", (h or "").encode()) for i, _, h in ROWS)
    blobs = [gzip.decompress(open(f, "rb").read()) for f in glob.glob(f"{folder}/dedup/part-*")]
    assert sum(b.count(b"<p>same</p>") for b in blobs) == 1
    heads = b"".join(blobs)
    assert heads.count(b"WARC-Profile: " + warc.PROFILE.encode()) == 5
    ids = [r.record_id for r in warc.read_archives(spark, f"{folder}/dedup").collect() if r.record_type == "revisit"]
    assert not {r.record_id for r in raw} & set(ids)
    to = {r.refers_to_id for r in warc.read_archives(spark, f"{folder}/dedup").collect() if r.refers_to_page == "1"}
    assert to == {r.record_id for r in raw if r.page_id == "1"}


def test_short_payloads_stay_responses_below_the_bound(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    rows = warc.archive(pages, str(tmp_path / "b"), min_bytes=3).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in rows) == [
        (1, "response", None), (2, "response", None), (3, "response", None), (4, "revisit", 3)]


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive(pages, str(tmp_path / "c")).collect() == []
