import hashlib
import random

import numpy as np
import pytest

from billetic.llm import repeats as R
from billetic.llm.runlength import RunLengthIndex
from tests.llm.helpers import docs


def brute(items):
    """items: (doc_id, text); equal rows are one document."""
    order = sorted({(d is None, d or 0, hashlib.sha256((t or "").encode()).hexdigest(), d, t or "") for d, t in items})
    seen, cover = {}, {}
    for *_, d, t in order:
        data = t.encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 99):
            w = data[i:i + 100]
            if w in seen:
                gone[i:i + 100] = True
            else:
                seen[w] = (d, i)
        cover[d, t] = gone
    out = []
    for d, t in items:
        gone = cover[d, t or ""]
        data = np.frombuffer((t or "").encode(), np.uint8)
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((d, len(data), int(gone.sum()), runs, hashlib.sha256(data[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


def found(spark, items, **kw):
    df = R.repeated_spans(docs(spark, items, extra=True), **kw)
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


def test_odd_texts(spark):
    s = "".join(random.Random(1).choice("abcdefgh ") for _ in range(150))
    items = [(5, None), (6, ""), (1, s[:99]), (2, s[:100]), (3, s[:100]), (4, "é" + s + "ü" * 60), (7, "ü" * 200),
             (None, s), (None, s), (8, "a" * 350), (9, "ab" * 130), (3, s[:100]), (10, "\0" * 300),
             (11, s + "x" + s), (12, "x" * 99 + s[:1])]
    assert found(spark, items) == brute(items)
    assert found(spark, []) == []


@pytest.mark.parametrize("max_rows", [4000, 2])
def test_random_passages(spark, monkeypatch, max_rows):
    rnd = random.Random(7)
    letters = "etaoin shrdlu"
    word = lambda n: "".join(rnd.choice(letters) for _ in range(n))
    passages = [word(rnd.randrange(60, 400)) for _ in range(12)]
    items = []
    for d in range(90):
        parts = [word(rnd.randrange(0, 200))]
        for _ in range(rnd.randrange(4)):
            p = rnd.choice(passages)
            a = rnd.randrange(len(p)) if rnd.random() < .5 else 0
            parts += [p[a:], word(rnd.randrange(0, 90))]
        items.append((500 - d, "".join(parts)))
    items += [(600 + i, items[i][1]) for i in range(10)] + [(700, passages[0] * 9), (701, word(20) * 40)]
    assert found(spark, items, max_rows=max_rows) == brute(items)


def test_a_common_line_in_many_surroundings(spark):
    """One anchor with many contexts, parted by longer ones; some share 100 bytes, most don't."""
    rnd = random.Random(5)
    line = "".join(rnd.choice("abcdefgh ") for _ in range(85))
    word = lambda n: "".join(rnd.choice("stuvwxyz") for _ in range(n))
    tails = [word(30) for _ in range(4)]
    items = [(i, word(90) + line + (rnd.choice(tails) if i % 3 == 0 else word(30)) + word(70)) for i in range(150)]
    items += [(200 + i, (word(20) + line) * 3 + word(9)) for i in range(10)]
    for max_rows in (4000, 30, 1):
        assert found(spark, items, max_rows=max_rows) == brute(items)


def test_texts_of_one_id_whose_hashes_clash(spark):
    """Texts without an id, or of one id, that agree in 31 bits of the hash that once told them apart."""
    import xxhash

    rnd = random.Random(11)
    seen, pair = {}, None
    while pair is None:
        t = f"{rnd.random()} " + "".join(rnd.choice("abcdefghij ") for _ in range(160))
        pair = seen.setdefault(xxhash.xxh64_intdigest(t.encode(), 42) & 0x7FFFFFFF, t)
        pair = (pair, t) if pair != t else None
    a, b = pair
    items = [(1, a), (None, a), (None, b), (9, b + "!"), (9, a + "?"), (9, a + "?"), ((1 << 63) - 1, b), (None, None)]
    assert found(spark, items) == brute(items)
    clean = [(None, a), (None, b), (5, a[::-1]), (5, b[::-1])]
    assert all(r[2] == 0 for r in found(spark, clean)) and found(spark, clean) == brute(clean)


def test_long_text_in_pieces(spark):
    rnd = random.Random(3)
    base = "".join(rnd.choice("abcd") for _ in range(R.PIECE + 5000))
    items = [(1, base[:400_000] + base[1000:300_000] + "q" * 300), (2, base[R.PIECE - 300:R.PIECE + 400])]
    assert found(spark, items) == brute(items)


def naive_statistics(contexts):
    text, places = b"".join(contexts), []
    for k, c in enumerate(contexts):
        places += [(c[i:], k, len(places) + i - i) for i in range(len(c))]
    suffixes = sorted(range(len(text)), key=lambda i: (places[i][0], i))
    out = [0] * len(text)
    for a, b in zip(suffixes, suffixes[1:]):
        x, y = places[a][0], places[b][0]
        n = 0
        while n < min(len(x), len(y)) and x[n] == y[n]:
            n += 1
        out[b] = n
    return out


def test_index_statistics():
    rnd = random.Random(2)
    for _ in range(40):
        base = bytes(rnd.choice(b"ab") for _ in range(60))
        contexts = [base[(a := rnd.randrange(40)):a + rnd.randrange(1, 60)] + bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(8)))
                    for _ in range(rnd.randrange(1, 9))]
        contexts = [c for c in contexts if c]
        index = RunLengthIndex(contexts)
        assert index.statistics().tolist() == naive_statistics(contexts)
        assert len(index.heads) == len(index.tail_at) <= len(index.text)


def test_query(spark):
    from billetic.llm.queries import op4_repeated_passages

    items = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = op4_repeated_passages(spark, "/root/testdata/sf0.001").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(items)
