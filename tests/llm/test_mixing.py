import duckdb
import pytest

from billetic.llm import mixing
from tests.llm.helpers import docs, rows


def oracle(spark, df):
    con = duckdb.connect()
    con.register("documents", df.toPandas()) if df.count() else con.execute(
        "CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    return [dict(zip(("doc_id", "size", "source_size", "target", "taken"), r, strict=True))
            for r in con.execute(mixing.ORACLE).fetchall()]


def check(spark, items):
    import pyarrow as pa

    df = docs(spark, items, extra=True)
    got = mixing.mix(df).select("doc_id", "size", "source_size", "target", "taken")
    con = duckdb.connect()
    con.register("documents", pa.table({
        "doc_id": pa.array([i[0] for i in items], pa.int64()),
        "text": pa.array([i[1] for i in items], pa.string()),
        "source": pa.array([i[3] if len(i) > 3 else None for i in items], pa.string())}))
    names = ("doc_id", "size", "source_size", "target", "taken")
    want = [dict(zip(names, r, strict=True)) for r in con.execute(mixing.ORACLE).fetchall()]
    key = lambda d: str(sorted(d.items(), key=str))
    got = [r.asDict() for r in got.collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    kept = mixing.mixed(df)
    assert kept.columns == df.columns
    assert kept.count() == sum(r["taken"] // r["size"] for r in got if r["size"]) + sum(
        0 for r in got) + _wordless(df)
    return got


def _wordless(df):
    return sum(r.copies for r in mixing.mix(df).filter("size = 0").select("copies").collect())


def test_odd_rows(spark):
    items = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "x y z " * 9, "en", "b"), (4, "q", "en", None),
             (None, "t t", "en", None), (5, "é ü w", "en", "Z"), (5, "é ü w", "en", "Z"),
             *[(i, "w " * (i % 7), "en", "big") for i in range(10, 90)], (99, "long " * 60_000, None, "b")]
    check(spark, items)


def test_no_rows_and_no_words(spark):
    assert mixing.mix(docs(spark, [])).count() == 0
    got = check(spark, [(1, None, None, "a"), (2, " ", None, None)])
    assert all(r["target"] == 0 and r["taken"] == 0 for r in got)


def test_sums_come_near_their_targets(spark):
    items = [(i, "w " * (1 + i * 37 % 50), None, f"s{i % 11 if i % 3 else 0}") for i in range(3000)]
    got = check(spark, items)
    by = {}
    for (i, _, _, s), r in zip(items, sorted(got, key=lambda r: r["doc_id"]), strict=True):
        t = by.setdefault(s, [r["target"], r["source_size"], 0])
        t[2] += r["taken"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    for target, size, taken in by.values():
        assert abs(taken - target) <= 50 and target <= 2 * size
    assert sum(t[0] for t in by.values()) == pytest.approx(1.5 * sum(t[1] for t in by.values()))


def test_same_rows_taken_on_other_partitions(spark):
    items = [(i, "w " * (i % 9), None, f"s{i % 3}") for i in range(500)]
    df = docs(spark, items)
    assert rows(mixing.mix(df)) == rows(mixing.mix(df.repartition(7)))
