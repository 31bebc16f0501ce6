import gzip
import hashlib
import random

import pytest

from leadmill.llm import warc
from leadmill.llm.common import scratch


def test_loser_tree():
    r = random.Random(0)
    for _ in range(300):
        runs = [sorted([(f"r{k}", r.choice("abc"), str(r.randrange(5)), r.choice([None, 1, 2]), j) for j in range(r.randrange(8))], key=warc.order_of) for k in range(r.randrange(7))]
        assert list(warc.merged(runs)) == sorted((x for run in runs for x in run), key=warc.order_of)


@pytest.fixture
def pages(spark, data):
    p = spark.read.parquet(f"{data}/pages.parquet")
    copies = p.where("page_id % 3 = 0").selectExpr("page_id + 1000 as page_id", "url", "html")
    odd = [(2000, None, None), (2001, "HTTP://www.Ex.com:80/a#b", "short"), (2002, "x", "short"), (2003, "x\r\ny", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 9), (2004, "u", "é" * 60)]
    return p.unionByName(copies).unionByName(spark.createDataFrame(odd, "page_id long, url string, html string"))


def test_operator(pages):
    got, want = warc.digests(pages).collect(), {r.page_id: (r.html or "").encode() for r in pages.collect()}
    first = {}
    for k in sorted(want):
        if len(want[k]) >= warc.REVISIT_BYTES:
            first.setdefault(want[k], k)
    assert len(got) == len(want)
    for r in got:
        raw = want[r.page_id]
        again = first.get(raw, r.page_id) != r.page_id
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", first[raw]) if again else ("response", None))
    order = [(r.url_key, r.captured_at, r.page_id) for r in sorted(got, key=lambda r: r.position)]
    assert order == sorted(order) and sorted(r.position for r in got) == list(range(len(got)))


def test_several_ranges_and_archives(pages, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_ROWS", 9)
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", 7)
    got = sorted(warc.digests(pages).collect(), key=lambda r: r.position)
    order = [(r.url_key, r.captured_at, r.page_id) for r in got]
    assert order == sorted(order) and len(got) == pages.count()


def test_archives_are_bounded_by_bytes(spark, monkeypatch):
    """Pages of several sizes: archives of their own, each within the bound or of one page; read in pieces, whole or inflated."""
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", 20)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 10_000)
    rows = [(k, f"u{k}", f"page {k} " * (1 if k % 3 else 200 if k % 6 else 4000)) for k in range(120)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    path = scratch(spark, "warc-sizes")
    warc.write(warc.typed(pages), path)
    files = [f.content for f in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).collect()]
    held = [[len(block) for _, block, _ in warc.parsed(gzip.decompress(f))] for f in files]
    assert sum(map(len, held)) == 120 and all(len(x) == 1 or (len(x) <= 20 and sum(x) <= 10_000 + 200 * len(x)) for x in held)
    for f in files:
        whole = list(warc.parsed(gzip.decompress(f)))
        assert whole == list(warc.parsed(warc.inflated(f, 7))) == list(warc.parsed(warc.inflated(f)))
    two = gzip.compress(gzip.decompress(files[0])) + gzip.compress(gzip.decompress(files[1]))
    assert b"".join(warc.inflated(two, 100)) == gzip.decompress(files[0]) + gzip.decompress(files[1])
    with pytest.raises(ValueError):
        list(warc.parsed(gzip.decompress(files[0])[:-50]))
    got = warc.digests(pages).collect()
    assert {(r.page_id, r.payload_bytes) for r in got} == {(k, len(x)) for k, _, x in rows}


def test_archives_are_warc(spark, pages):
    path = scratch(spark, "warc-test")
    warc.write(warc.typed(pages), path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).collect()
    records = [x for f in files for x in warc.parsed(gzip.decompress(f.content))]
    assert len(records) == pages.count()
    responses = {h["WARC-Record-ID"]: h for h, _, _ in records if h["WARC-Type"] == "response"}
    again = [h for h, _, _ in records if h["WARC-Type"] == "revisit"]
    assert again and all(responses[h["WARC-Refers-To"]][k] == h[f"WARC-Refers-To-{k[5:]}"] for h in again for k in ("WARC-Target-URI", "WARC-Date"))
    assert all(responses[h["WARC-Refers-To"]]["X-Page"] == h["X-Refers-To-Page"] for h in again)
    for head, block, _ in records:
        body = block.split(b"\r\n\r\n", 1)[1]
        digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
        assert head["WARC-Type"] == "revisit" and body == b"" or hashlib.sha256(body).hexdigest() == digest


def test_edges(spark):
    rows = spark.createDataFrame([(None, None, None, 1), (None, "u", "x" * 200, 1), (1, "u", "x" * 200, 1), (1, "u", "x" * 200, 1), (2, "u", "x" * 200, 1)], "page_id long, url string, html string, digest int")
    got = sorted(((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in warc.digests(rows).collect()))
    assert got == [("1", 200, "response", None), ("1", 200, "response", None), ("2", 200, "revisit", 1), ("None", 0, "response", None), ("None", 200, "revisit", 1)]
    assert warc.digests(rows.limit(0)).count() == 0


def test_long_payload(spark):
    rows = spark.createDataFrame([(1, "u", "x" * 5_000_000, "a"), (2, "v", "x" * 5_000_000, "b")], "page_id long, url string, html string, payload string")
    got = sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.digests(rows).collect())
    assert got == [(1, 5_000_000, "response", None), (2, 5_000_000, "revisit", 1)]
