import itertools

import numpy as np
import pytest

from billetic.llm import embeddings as E

INF = float("inf")


def table(spark, items):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in items],
                                 "vec_id long, embedding array<float>, label int, cid string")


def brute(items, threshold=0.95):
    xs = []
    for _, v in items:
        ok = v and all(c is not None and np.isfinite(c) for c in v) and any(v)
        xs.append(np.array(v, np.float32).astype(float) if ok else None)
    comp, links = list(range(len(items))), [0] * len(items)
    for i, j in itertools.combinations(range(len(items)), 2):
        a, b = xs[i], xs[j]
        if a is None or b is None or len(a) != len(b):
            continue
        if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
            links[i] += 1
            links[j] += 1
            x, y = sorted((comp[i], comp[j]))
            comp = [x if c == y else c for c in comp]
    out = []
    for i, (d, _) in enumerate(items):
        ids = [items[j][0] for j in range(len(items)) if comp[j] == comp[i] and items[j][0] is not None]
        c = min(ids, default=None)
        out.append((d, links[i], c, d == c))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_odd_vectors(spark):
    items = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, float("nan")]), (6, [INF, 1.0]),
             (7, [1.0, 0.0]), (8, [2.0, 0.0]), (8, [2.0, 0.0]), (None, [1.0, 0.01]), (None, [0.0, 1.0]),
             (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0]), (11, [1e30, 0.0]), (12, [3.0]), (13, [0.5])]
    assert found(E.near_duplicates(table(spark, items))) == brute(items)
    assert found(E.near_duplicates(table(spark, []))) == []


def clustered(n, dims, seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 6, dims))
    x = np.concatenate([base[rng.integers(0, len(base), n // 2)] + rng.normal(size=(n // 2, dims)) * 0.2 *
                        rng.random((n // 2, 1)), rng.normal(size=(n // 4, dims)), np.repeat(base[:1], n // 4, 0)])
    return [(1000 - i, v) for i, v in enumerate(x.astype(np.float32).tolist())]


@pytest.mark.parametrize(("dims", "turns", "block"), [(64, 2, 2000), (64, 1, 20), (48, 3, 5)])
def test_against_brute_force(spark, dims, turns, block):
    items = clustered(240, dims, dims + turns)
    got = found(E.near_duplicates(table(spark, items), turns=turns, block=block))
    want = brute(items)
    assert len(got) == len(want)
    g, w = {r[0]: r for r in got}, {r[0]: r for r in want}
    assert all(g[i][1] <= w[i][1] for i in w)                       # none below the threshold
    assert sum(r[1] for r in got) >= 0.97 * sum(r[1] for r in want)


def test_recall_at_the_threshold():
    rng, dims = np.random.default_rng(0), 64
    for turns, n in ((1, 400), (2, 1500), (3, 600)):
        a = rng.normal(size=(n, dims))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b = rng.normal(size=(n, dims))
        b -= (a * b).sum(1, keepdims=True) * a
        b = 0.951 * a + np.sqrt(1 - 0.951**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
        tables, probes = E.PLANS[turns]
        _, met = E._meets_first(E.codes(a, turns, tables, probes), E.codes(b, turns, tables, probes))
        assert met.mean() > 0.985, turns


def test_hadamard_keeps_norms():
    x = np.random.default_rng(1).normal(size=(5, 32))
    y = E.hadamard(x)
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)) and np.allclose(E.hadamard(y), x)
