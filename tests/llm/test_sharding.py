import zlib
from collections import Counter, defaultdict

from billetic.llm import sharding
from tests.llm.helpers import docs


def shards(spark, items, **kw):
    got = [r.asDict() for r in sharding.kd_shards(docs(spark, items, extra=True), **(kw or {"n_shards": 24})).collect()]
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in items)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return got


def sizes(got):
    total = Counter()
    for r in got:
        total[r["shard"]] += r["size"]
    return total


def test_odd_rows(spark):
    shards(spark, [])
    shards(spark, [(1, None)])
    items = [(1, None), (None, ""), (None, ""), (2, "ü€"), (2, "ü€"), (3, "x" * 300_000), (4, "a", "en", "s")]
    assert set(sizes(shards(spark, items))) <= set(range(24))


def test_near_equal_bytes_and_copies_together(spark):
    items = [(i, f"text {i // 2} " * (1 + i // 2 * 31 % 40), ("en", "de", None)[i % 3], f"src{i % 7 if i % 3 else 0}")
             for i in range(4000)]
    got = shards(spark, items)
    s = sizes(got)
    assert len(s) == 24 and max(s.values()) < 1.05 * sum(s.values()) / 24 < 1.1 * min(s.values())
    places = defaultdict(set)
    for r in got:
        places[r["text_crc32"]].add(r["shard"])
    assert all(len(p) == 1 for p in places.values())


def test_a_text_with_a_third_of_all_rows_is_dealt(spark):
    items = [(i, "copy " * 20 if i % 3 == 0 else f"text {i} " * 12, "en", "s") for i in range(3000)]
    s = sizes(shards(spark, items))
    assert len(s) == 24 and max(s.values()) < 1.1 * sum(s.values()) / 24


def test_target_bytes(spark):
    items = [(i, "w " * (i % 50), "en", f"s{i % 3}") for i in range(1000)]
    s = sizes(shards(spark, items, target_bytes=5000))
    total = sum(s.values())
    assert len(s) == -(-total // 5000) and max(s.values()) < 1.15 * 5000


def test_repeated_rows_are_dealt(spark):
    """A third of the rows repeat one id and one text, null ids among them."""
    items = [(1, "copy of one text " * 20, "en", "s")] * 600 + [(None, "copy of one text " * 20)] * 400
    items += [(10 + i, f"text {i} " * (1 + i % 40), "en", f"s{i % 5}") for i in range(2000)]
    s = sizes(shards(spark, items))
    mean = sum(s.values()) / 24
    assert len(s) == 24 and max(s.values()) < 1.05 * mean and min(s.values()) > 0.95 * mean


def tree(points, lo, hi, reach, out):
    """The k-d tree in plain Python; points: (text, weight, (d0, d1, d2), tie)."""
    if hi - lo < 2 or not points:
        out.update({p[0]: lo for p in points})
        return
    mid = (lo + hi) // 2
    budget = sum(p[1] for p in points) * (mid - lo) / (hi - lo)
    spans = [(max(p[2][i] for p in points) - min(p[2][i] for p in points)) / max(1, reach[i]) for i in range(3)]
    dim = max(range(3), key=lambda i: (spans[i], -i))
    weight, spent = Counter(), 0
    for p in points:
        weight[p[2][dim]] += p[1]
    for place in sorted(weight):
        if spent + weight[place] >= budget:
            break
        spent += weight[place]
    at_tie = Counter()
    for p in points:
        if p[2][dim] == place:
            at_tie[p[3]] += p[1]
    best, cut, upto = budget - spent, -1, spent
    for t in sorted(at_tie):
        upto += at_tie[t]
        if abs(upto - budget) <= best and (abs(upto - budget) < best or cut < 0):
            best, cut = abs(upto - budget), t
    left = [p for p in points if p[2][dim] < place or (p[2][dim] == place and p[3] <= cut)]
    kept = set(map(id, left))
    tree(left, lo, mid, reach, out)
    tree([p for p in points if id(p) not in kept], mid, hi, reach, out)


def test_the_tree_by_hand(spark):
    import math

    import xxhash

    def h(data, seed=42):
        return xxhash.xxh64_intdigest(data, seed)

    def long_(n):
        return (n % (1 << 64)).to_bytes(8, "little")

    items = [(i, f"text {i // 2} " * (1 + i // 2 * 37 % 90), ("en", "de", None)[i // 2 % 3], f"src{i // 2 % 7}")
             for i in range(1600)]
    points = {}
    for _, text, lang, source in items:
        size, key = len(text.encode()) + 8, h(text.encode())
        place = [h(v.encode()) if v is not None else 42 for v in (source, lang)]
        tie = h(long_(0), h(long_(size), h(long_(key))))
        dims = (int(math.log2(size) / 40 * 4096), *(p & 4095 for p in place))
        points[text] = (text, points.get(text, (0, 0))[1] + size, dims, tie & 4095)
    points = list(points.values())
    reach = [max(p[2][i] for p in points) - min(p[2][i] for p in points) for i in range(3)]
    want = {}
    tree(points, 0, 24, reach, want)
    got = {r["doc_id"]: r["shard"] for r in shards(spark, items)}
    assert got == {d: want[text] for d, text, *_ in items}
