import gzip
import hashlib

import pytest

from billetic.llm import warc
from billetic.llm.queries import ORACLE, op3_warc
from tests.llm.helpers import rows


def pages(spark, items):
    return spark.createDataFrame([(*i, "x", 5) for i in items],
                                 "page_id long, url string, html string, record_type string, payload_bytes int")


BIG, SMALL = "é" * 700, "a" * 999
ITEMS = [(1, "http://a/", BIG), (2, "http://a/ \r\nX: y", BIG), (7, None, BIG), (3, "u", SMALL), (4, "u", SMALL),
         (5, "u", None), (6, "u", ""), (None, "n", BIG), (None, "n", "z" * 2000), (None, "n", "z" * 2000),
         (8, "u", "WARC/1.1\r\n\r\n\x1f\x8b" * 400), (9, "u", "long " * 400_000), (7, "u", BIG)]


def brute(items):
    out = []
    for i, _, html in items:
        data = (html or "").encode()
        same = [j for j, _, h in items if (h or "").encode() == data and j is not None] if len(data) >= 1000 else []
        n = sum((h or "") == (html or "") for *_, h in items)
        refers = max(same) if len(data) >= 1000 and n > 1 and same and i != max(same) else None
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


def test_round_trip(spark):
    df = warc.round_trip(pages(spark, ITEMS))
    assert found(df) == brute(ITEMS)
    assert {r.url for r in df.collect() if r.page_id == 2} == {"http://a/%20%0D%0AX:%20y"}


def test_no_rows(spark):
    assert found(warc.round_trip(pages(spark, []))) == []


def test_files_splits_and_pushdown(spark, tmp_path, monkeypatch):
    items = [(i, f"http://h{i % 5}/", f"page {i} " * 300) for i in range(200)] + [(500 + i, "v", "same " * 400) for i in range(9)]
    path = f"file://{tmp_path}/archive"
    warc.register(spark)
    warc.write_pages(pages(spark, items).coalesce(2), path)
    reader = warc.WarcReader({"path": path})
    assert len(reader.partitions()) >= 2
    # one plain gzip reader gets the same bytes as the splits
    whole = b"".join(gzip.open(f).read() for f in sorted(tmp_path.glob("archive/*.warc.gz")))
    assert whole.count(b"WARC-Record-ID") == 209
    rows_of = lambda **kw: [r for s in warc.WarcReader({"path": path, **kw}).partitions()
                            for r in warc.WarcReader({"path": path, **kw})._rows(s)]
    assert len(rows_of()) == 209 and all(r[-1] is None for r in rows_of(payload="false"))

    df = spark.read.format("warc").load(path)
    one = df.filter("record_type = 'response' and target_uri = 'http://h3/'")
    assert one.count() == 40 and df.filter("record_type = 'revisit'").count() == 8
    assert df.filter("target_uri like 'http%' and payload_bytes > 0").count() == 200
    assert df.filter("record_id in ('<urn:page:3>', '<urn:page:4>') and refers_to is null").count() == 2
    # a record that fails a pushed filter is never decoded beyond its headers
    pushed = warc.WarcReader({"path": path})
    from pyspark.sql.datasource import EqualTo, GreaterThan

    assert list(pushed.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("payload_bytes",), 1)])) == [
        GreaterThan(("payload_bytes",), 1)]
    monkeypatch.setattr(warc._Member, "block", lambda *a: pytest.fail("decoded"))
    pushed.tests = [("record_type", "in", ("metadata",))]
    assert [r for s in pushed.partitions() for r in pushed._rows(s)] == []


def test_foreign_archives(spark, tmp_path):
    recs = [warc.record([("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:page:{i}>"),
                         ("Content-Type", "application/http;msgtype=response")],
                        warc.http_block(b"p" * i, i)) for i in (3, 0, 100_000)]
    recs.append(warc.record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:x:1>")], b"software: x"))
    (tmp_path / "a.warc").write_bytes(b"".join(recs))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in recs))
    warc.register(spark)
    df = spark.read.format("warc").load(str(tmp_path))
    got = sorted((r.record_type, r.payload_bytes, len(r.payload)) for r in df.collect())
    assert got == sorted([("response", n, n) for n in (3, 0, 100_000)] * 2 + [("warcinfo", 11, 11)] * 2)
    assert df.filter("record_type = 'warcinfo'").count() == 2


def test_unlisted_files_are_not_read(spark, tmp_path):
    path = str(tmp_path / "x")
    warc.write_pages(pages(spark, ITEMS[:3]), path)
    (tmp_path / "x" / "part-lost.warc.gz").write_bytes(b"torn")
    assert len(found(warc.read_pages(spark, path))) == 3


def test_query_against_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW pages AS SELECT * FROM '/root/testdata/sf0.01/pages.parquet'")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    want = [dict(zip(names, r, strict=True)) for r in con.execute(ORACLE["op3_warc"]).fetchall()]
    assert rows(op3_warc(spark, "/root/testdata/sf0.01")) == sorted(want, key=lambda d: __import__("json").dumps(d))
