import hashlib
import random
import zlib

import numpy as np
import pytest

from billetic.llm import runs as R
from tests.llm.helpers import docs


def brute_runs(words):
    """All runs by trying every period."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q):
                unit = words[i:i + q]
                if not any(q % d == 0 and unit == unit[:d] * (q // d) for d in range(1, q)):
                    out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words, found):
    gone = set()
    for start, length, q in found:
        gone.update(range(start + q, start + length))
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


def naive_lyndon(s):
    out = []
    for i in range(len(s)):
        j = i + 1
        while j < len(s) and s[j:] > s[i:]:
            j += 1
        out.append(j - i)
    return out


@pytest.mark.parametrize("letters", [1, 2, 3, 9])
def test_lyndon_lengths(letters):
    rnd = random.Random(letters)
    for _ in range(150):
        parts = [[rnd.randrange(1, letters + 1) for _ in range(rnd.randrange(1, 30))] for _ in range(rnd.randrange(1, 4))]
        symbols = np.array([0] + [x for p in parts for x in [*p, 0]])
        got = R.lyndon_lengths(symbols)
        want = [x for p in parts for x in naive_lyndon(p)]
        assert got[symbols > 0].tolist() == want


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_runs_of_many_segments(letters):
    rnd = random.Random(10 + letters)
    segments = []
    for _ in range(150):
        s = []
        while rnd.random() < .8:
            unit = [rnd.randrange(1, letters + 1) for _ in range(rnd.randrange(1, 7))]
            s += unit * rnd.randrange(1, 8) + unit[:rnd.randrange(len(unit))]
        segments.append(np.array(s, np.int64))
    of, start, length, period = R.runs_of(segments)
    got = [[] for _ in segments]
    for row in zip(of.tolist(), start.tolist(), length.tolist(), period.tolist()):
        got[row[0]].append(row[1:])
    assert got == [brute_runs(s.tolist()) for s in segments]
    assert sum(map(len, got)) > 30


def test_cuts_lose_nothing():
    rnd = random.Random(3)
    for _ in range(300):
        s = []
        while rnd.random() < .85:
            unit = [rnd.randrange(8) for _ in range(rnd.randrange(1, 6))]
            s += unit * rnd.randrange(1, 7)
        spans = R.segments_of(np.array(s, np.int32))
        for start, length, _ in brute_runs(s):
            assert any(a <= start and start + length <= b for a, b in spans)


ODD = [(1, None), (2, ""), (3, " \t\n "), (4, "a " * 5), (5, "a " * 6), (5, "a " * 6), (None, "x a a a a a a"),
       (6, "a b a b a b a"), (7, "a b a b a b a b"), (8, ("to be or " * 5 + "not ") * 4), (9, "é é " * 7),
       (10, "p q " * 30_000), (11, " ".join(f"w{i % 700}" for i in range(9_000)))]


def found(spark, items):
    return sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed)
                   for r in R.periodic_runs(docs(spark, items, extra=True)).collect()), key=str)


def test_odd_texts(spark):
    short = ODD[:-2]
    want = [(d, brute_runs(words_of(t)), collapse(words_of(t), brute_runs(words_of(t)))) for d, t in short]
    assert found(spark, short) == sorted(want, key=str)
    assert found(spark, []) == []
    long_ = dict((d, (r, c)) for d, r, c in found(spark, ODD[-2:]))
    assert long_[10] == ([(0, 60_000, 2)], "p q")
    assert long_[11] == ([(0, 9_000, 700)], " ".join(f"w{i}" for i in range(700)))


def test_a_long_text_of_one_word_is_linear(spark):
    assert found(spark, [(1, "a " * 1_000_000)]) == [(1, [(0, 1_000_000, 1)], "a")]


def test_strongest_breaks_ties(spark):
    df = spark.createDataFrame(
        [(1, [(0, 8, 2), (9, 12, 3), (30, 6, 1)]), (2, [(5, 8, 2), (9, 12, 3), (20, 4, 1)]), (3, [])],
        "id int, runs array<struct<start:long,length:long,period:long>>")
    got = {r.id: r.best and tuple(r.best) for r in df.select("id", R.strongest("runs").alias("best")).collect()}
    assert got == {1: (30, 6, 1), 2: (5, 8, 2), 3: None}


def test_query(spark):
    from billetic.llm.queries import op11_periodic_runs

    want = []
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        words = words_of(r.text)
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
        own = brute_runs(words)
        best = max(own, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None, None, None))
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((r.doc_id, len(own), *best, 1000 * best[1] // best[2] if own else None,
                     sha("".join(f"{a},{b},{c}\n" for a, b, c in own)), sha(collapse(words, own))))
    got = op11_periodic_runs(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert sum(w[1] for w in want) > 5
