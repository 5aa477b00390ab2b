import itertools
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from billetic.llm import crf
from tests.llm.helpers import docs

EN = "the quick brown fox jumps over the lazy dog and runs through the thick woods with that thing".split()
DE = "der schnelle braune fuchs springt über den faulen hund und läuft durch das dicke gehölz mit dem ding".split()


@pytest.fixture(scope="module")
def model():
    return crf.fit([(lab, (w * 3)[i:i + 30]) for lab, w in (("de", DE), ("en", EN)) for i in range(10)],
                   n_seqs=300)


def brute(model, words):
    """Sum over all label sequences."""
    em = model.emissions(words).astype(float)
    em[[not any(map(str.isalpha, w)) for w in words]] = 0
    k, total = len(model.labels), np.zeros((len(words), len(model.labels)))
    for seq in itertools.product(range(k), repeat=len(words)):
        s = sum(em[i, y] for i, y in enumerate(seq)) + sum(model.moves[a, b] for a, b in itertools.pairwise(seq))
        for i, y in enumerate(seq):
            total[i, y] += np.exp(s)
    return total / total.sum(1, keepdims=True)


def test_forward_backward_sums_all_paths(model):
    words = crf.words_of("the fuchs, 42 und that Ding runs")
    post = brute(model, words)
    weight = np.array([sum(map(str.isalpha, w)) for w in words])
    want = (post * weight[:, None]).sum(0) / weight.sum()
    labels, scores = crf.predict(model, pa.array(["the fuchs, 42 und that Ding runs"]))
    assert labels == [model.labels[int(want.argmax())]] and scores[0] == pytest.approx(want.max(), abs=1e-5)
    assert [p for _, _, p in crf.label_words(model, "the fuchs, 42 und that Ding runs")] == pytest.approx(
        post.max(1).tolist(), abs=1e-6)


def test_blocks_equal_one_chain(model):
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(EN + DE, n)) for n in (1, 31, 32, 33, 64, 65, 500, 3000)]
    _, scores = crf.predict(model, pa.array(texts))
    for text, score in zip(texts, scores, strict=True):
        words = crf.words_of(text)
        post, _ = crf._forward_backward(model.emissions(words)[None].astype(float), model.moves)
        sums = (post[0] * np.array([len(w) for w in words])[:, None]).sum(0)
        assert score == pytest.approx((sums / sums.sum()).max(), abs=1e-4)


def test_pieces_change_nothing(model, monkeypatch):
    rng = np.random.default_rng(2)
    texts = [None, "", *(" ".join(rng.choice(EN + DE, n)) for n in (3, 9, 200, 1, 40)), "12", None]
    want = [crf.predict(model, pa.array([t], pa.large_string())) for t in texts]
    for size in (1, 60, 1000):
        monkeypatch.setattr(crf, "PIECE", size)
        labels, scores = crf.predict(model, pa.array(texts, pa.large_string()))
        assert labels == [lab for (lab,), _ in want]
        assert scores == pytest.approx([x for _, (x,) in want], abs=1e-6)


def test_memory_does_not_follow_the_batch(model):
    text = " ".join(EN + DE) + " "
    text *= 4_500_000 // len(text)

    def peak(n):
        tracemalloc.start()
        try:
            labels, _ = crf.predict(model, pa.array([text] * n, pa.large_string()))
            return len(labels), tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    assert peak(6)[1] < 1.5 * peak(1)[1]


def test_code_switching(model):
    text = " ".join(EN[:8] + DE[5:14] + EN[3:10])
    labels = [lab for _, lab, _ in crf.label_words(model, text)]
    assert labels == ["en"] * 8 + ["de"] * 9 + ["en"] * 7


def test_odd_texts(model):
    labels, scores = crf.predict(model, pa.array(
        [None, "", " \n", "123 ... ²", "THE QUICK!", "ü" * 200_000, "the " * 100_000], pa.large_string()))
    assert labels[:4] == ["und"] * 4 and not scores[:4].any()
    assert labels[4] == "en" and labels[6] == "en" and ((scores >= 0) & (scores <= 1)).all()
    assert crf.predict(None, pa.array(["the"]))[0] == ["und"]
    assert crf.fit([("en", [])]) is None


def test_table(spark):
    odd = [(1, None, "en", "s"), (2, "", None, "s"), (3, "12 34", "de", None), (None, "the dog runs", "en", "s")]
    found = crf.identify(docs(spark, odd, extra=True), n_seqs=200).collect()
    assert [r.lang_pred for r in found[:3]] == ["und"] * 3 and not found[3].held_out
    assert crf.identify(docs(spark, [])).count() == 0
    items = [(i, " ".join((w * 3)[i % 9:i % 9 + 25]), lab, "s") for i in range(60) for lab, w in (("de", DE), ("en", EN))]
    df = docs(spark, items + [(500, "77 88", "en", "s")], extra=True)
    kept = crf.keep_identified(df, n_seqs=300)
    assert kept.columns == df.columns and kept.count() == len(items)


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in df.collect()}
    found = crf.identify(df).collect()
    assert len(found) == len(truth)
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 3 == 1}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98
    # no input but the text: other ids, sources and languages of the rest change nothing
    model = crf.train(df)
    again = crf.predict(model, pa.array([r.text for r in df.orderBy("doc_id").collect()]))[0]
    assert again == [r.lang_pred for r in sorted(found, key=lambda r: r.doc_id)]
