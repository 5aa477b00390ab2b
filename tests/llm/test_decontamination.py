import random
import tracemalloc

import numpy as np
import pyarrow as pa

from billetic.llm import decontamination as D
from tests.llm.helpers import docs, rows

VOCAB = [a + b for a in ("ka", "lo", "mi", "nu", "pe", "ri", "so") for b in ("tar", "ven", "dol", "bim", "zat")]


def prose(rnd, n):
    return " ".join(rnd.choice(VOCAB) for _ in range(n))


def bench(spark, items):
    df = spark.createDataFrame([(*i, "x") for i in items] or [], "item_id long, text string, pos string")
    return df


def pairs(spark, documents, items, **kw):
    found = D.leaks(docs(spark, documents, extra=True), bench(spark, items), **kw)
    return {(r.doc_id, r.item_id): r for r in found.collect()}


def test_verbatim_partial_and_clean(spark):
    rnd = random.Random(3)
    items = [(i, prose(rnd, n)) for i, n in enumerate((40, 13, 20, 8, 6, 4, 30))] + [(90, None), (91, ""), (92, None)]
    text = dict(items)
    documents = [(100 + i, f"{prose(rnd, 30)} {t} {prose(rnd, 30)}") for i, t in items if t]
    documents += [(1, " ".join(text[0].split()[10:23])), (2, " ".join(text[0].split()[10:22])), (3, None), (4, ""),
                  (5, prose(rnd, 500)), (None, text[2]), (7, text[6] + "\n" + text[6])]
    got = pairs(spark, documents, items)
    assert set(got) == {(100 + i, i) for i in (0, 1, 2, 3, 4, 6)} | {(1, 0), (None, 2), (7, 6)}
    assert got[7, 6].n_places == 2 and got[100, 0].matched_words == 40 and not got[100, 0].reparameterised
    # without the filter all windows go through the join
    assert set(pairs(spark, documents, items, max_filter=0)) == set(got)


def test_brute_force(spark):
    rnd = random.Random(8)
    items = [(i, prose(rnd, rnd.randrange(8, 40))) for i in range(30)]
    documents = []
    for d in range(80):
        w = prose(rnd, 60).split()
        if d % 2:
            t = rnd.choice(items)[1].split()
            a = rnd.randrange(len(t))
            w[30:30] = t[a:a + rnd.randrange(5, 40)]
        documents.append((d, " ".join(w)))

    def leaked(doc, item):
        need = min(13, len(item))
        found = {" ".join(doc[i:i + need]) for i in range(len(doc) - need + 1)}
        return any(" ".join(item[j:j + need]) in found for j in range(len(item) - need + 1))

    want = {(d, i) for d, t in documents for i, x in items if leaked(t.split(), x.split())}
    assert set(pairs(spark, documents, items)) == want and want


def test_reparameterised(spark):
    q = ("Yesterday Anna bought 12 apples and 30 pears for 5 euros and then Anna gave 12 apples to her neighbour "
         "who lives 3 km away from the old market")
    other = q.replace("Anna", "Berta").replace("12", "17").replace("30", "41").replace("km", "miles")
    mixed = q.replace("gave 12 apples", "gave 99 apples")
    got = pairs(spark, [(1, q), (2, other), (3, mixed), (4, "so it was that " + other.lower())], [(7, q)])
    assert got[1, 7].reparameterised is False and got[2, 7].reparameterised is True
    # 12 stands for 12 and for 99, but the 15 words before the second one are consistent
    assert got[3, 7].matched_words >= 15
    # here every stretch of 13 words holds both
    short = "then Anna had 12 or 12 of them and gave 12 to her own dear mother"
    assert (5, 8) not in pairs(spark, [(5, short.replace("12 or 12", "12 or 99")), (6, short)], [(8, short)])
    table = " ".join(f"{i} {i + 1}" for i in range(50))
    assert pairs(spark, [(1, table)], [(1, " ".join(str(i * 7) for i in range(40)))]) == {}


def test_first_word_inside_a_sentence(spark):
    rnd = random.Random(4)
    item = prose(rnd, 13).capitalize()
    assert set(pairs(spark, [(1, "so " + item), (2, "So. " + item)], [(1, item)])) == {(1, 1), (2, 1)}


def test_long_text_in_pieces(spark, monkeypatch):
    rnd = random.Random(6)
    items = [(i, prose(rnd, 25)) for i in range(12)]
    text = " ".join(prose(rnd, rnd.randrange(3, 40)) + " " + t for _, t in items)
    import pyarrow as pa

    whole = D._find([8], None)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([5, 6]), pa.array([text, "a b c"])],
                                       names=["doc_id", "text_hash", "text"])

    def found():
        return {(w, p, tuple(s)) for b in whole(iter([batch])) for w, p, s in zip(
            b.column("win").to_pylist(), b.column("pos").to_pylist(), b.column("slots").to_pylist())}

    want = found()
    monkeypatch.setattr(D, "PIECE", 150)
    assert found() == want


def test_drop_leaked(spark):
    rnd = random.Random(9)
    item = prose(rnd, 20)
    df = docs(spark, [(1, "x " + item), (2, "clean text"), (None, item), (None, "fine"), (5, None), (2, item)], extra=True)
    kept = D.drop_leaked(df, bench(spark, [(1, item)]))
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [
        ("2", "clean text"), ("5", "None"), ("None", "fine")]
    assert D.drop_leaked(df, bench(spark, [])).count() == 6
    assert rows(D.leaks(docs(spark, []), bench(spark, [(1, item)]))) == []


def test_copies_in_another_case_or_with_other_marks(spark):
    rnd = random.Random(12)
    item = f"{prose(rnd, 9).capitalize()} with Anna and a {prose(rnd, 4)}. {prose(rnd, 15).capitalize()}? Anna {prose(rnd, 5)}."
    words = item.split()
    a = next(i for i, w in enumerate(words) if w.endswith(".")) + 1
    after_unfinished = "so they said " + " ".join(words[a:a + 13]) + " and more"
    documents = [(1, item.upper()), (2, item.title()), (3, item.replace(".", "").replace("?", "")),
                 (4, after_unfinished), (5, item.replace("with Anna", 'with "Anna"')), (6, item.lower()),
                 (7, "x " + " ".join(words[3:16]).upper()), (8, "x " + " ".join(words[3:15]).upper())]
    got = pairs(spark, documents, [(1, item)])
    assert set(got) == {(i, 1) for i in range(1, 8)}
    assert got[1, 1].matched_words == len(words) and not any(r.reparameterised for r in got.values())
    assert set(pairs(spark, documents, [(1, item)], max_filter=0)) == set(got)


def test_items_of_names_or_numbers(spark):
    rnd = random.Random(14)
    names = "Name the capitals: Paris London Berlin Rome Madrid Lisbon Vienna Prague Warsaw Athens Dublin Oslo Helsinki Sofia"
    series = "Continue the series 2 3 5 7 11 13 17 19 23 29 31 37 41 43"
    short = "Add 3.5 7 -2 9"
    half = f"{names} {prose(rnd, 5)}"       # its templates cover the last 9 places
    documents = [(10 * k + i, f"{prose(rnd, 20)} {t} {prose(rnd, 20)}")
                 for i, t in enumerate((names, series, short, half)) for k in (1, 2)]
    documents += [(50, names.upper()), (51, "they wrote " + " ".join(half.split()[-9:])), (52, " ".join(names.split()[2:14])),
                  # the shape alone, other numbers, another sign
                  (60, "Continue the series " + " ".join(str(k * 3) for k in range(14))),
                  (61, " ".join(str(k) for k in range(200))), (62, "Add 3.5 7 2 9"), (63, "Add 35 7 -2 9")]
    items = list(enumerate((names, series, short, half)))
    got = pairs(spark, documents, items)
    want = {(10 * k + i, i) for i in range(4) for k in (1, 2)}
    want |= {(10 * k, 3) for k in (1, 2)} | {(10 * k + 3, 0) for k in (1, 2)} | {(50, 0), (50, 3), (51, 3)}
    assert set(got) == want and not any(r.reparameterised for r in got.values())


def test_memory_does_not_follow_the_batch():
    text = "a plain line of words with 12 km of road and some Names in it. " * 4000

    def peak(n):
        batch = pa.RecordBatch.from_arrays(
            [pa.array(range(n), pa.int64()), pa.array(range(n), pa.int64()), pa.array([text] * n)],
            names=["doc_id", "text_hash", "text"])
        tracemalloc.start()
        try:
            rows = sum(len(b) for b in D._find([8], np.zeros(1, np.uint64))(iter([batch])))
            return rows, tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    assert peak(30)[1] < 1.5 * peak(5)[1]
