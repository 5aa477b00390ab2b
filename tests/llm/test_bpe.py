import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from billetic.llm import bpe
from tests.llm.helpers import docs

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(VOCABULARY),
                             special_tokens={})


def coded(spark, items, **kw):
    df = bpe.encode(docs(spark, items, extra=True), VOCABULARY, public_tokenizers.PATTERN, **kw)
    return sorted(((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in bpe.decode(df, VOCABULARY).collect()),
                  key=str)


def plain(library, items):
    out = []
    for doc_id, text, *_ in items:
        ids = library.encode_ordinary(text or "")
        out.append((doc_id, len(ids), np.array(ids, "<u4").tobytes(), (text or "").encode()))
    return sorted(out, key=str)


ODD = [(1, None), (2, ""), (3, " "), (3, " "), (None, "don't  stop\r\n\n now"), (None, None), (4, "\0\x1c   x"),
       (5, "<|endoftext|> is text"), (6, "naïve 東京 🙂🙂 ١٢٣ é"), (7, "a" * 70_000), (8, " " * 50_000 + "b"),
       (9, "'s 'T '' ''s x's"), (10, "the " * 40_000), (2 ** 62, "big id")]


def test_odd_texts(spark, library):
    assert coded(spark, ODD) == plain(library, ODD)
    assert coded(spark, []) == []


@pytest.mark.parametrize("block_bytes", [1, 300, 1 << 20])
def test_blocks_of_any_size(spark, library, block_bytes):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdeé ") for _ in range(rnd.randrange(1, 9))) for _ in range(60)]
    items = [(i % 40, " ".join(rnd.choice(words) for _ in range(rnd.randrange(60)))) for i in range(120)]
    assert coded(spark, items, block_bytes=block_bytes) == plain(library, items)


def test_a_text_longer_than_a_piece(spark, library, monkeypatch):
    items = [(1, "one two three " * 700 + "end"), (2, "x")]
    monkeypatch.setattr(bpe, "PIECE", 100)
    assert coded(spark, items) == plain(library, items)


def test_lists_and_other_ids(spark, library):
    df = spark.createDataFrame([("k1", "hello wörld"), ("k2", None)], "key string, body string")
    got = bpe.encode(df, VOCABULARY, public_tokenizers.PATTERN, id_col="key", text_col="body").select(
        "doc_id", bpe.as_list("ids").alias("ids")).collect()
    assert sorted((r.doc_id, r.ids) for r in got) == [("k1", library.encode_ordinary("hello wörld")), ("k2", [])]


def test_decode_refuses_unknown_ids(spark):
    df = spark.createDataFrame([(bytearray(np.array([70_000], "<u4").tobytes()),)], "ids binary")
    with pytest.raises(Exception, match="no token"):
        bpe.decode(df, VOCABULARY).collect()


def test_packing():
    for a in ([], [0], [2 ** 32 - 1, 0, 5], list(range(1000))):
        assert bpe.unpack(bpe.pack(np.array(a, np.uint64))).tolist() == a
    rnd = np.random.default_rng(1)
    for a in ([], [0], [191, 192, 447, 448, 16_319, 16_320, 10 ** 6], rnd.zipf(1.2, 5000).clip(0, 2 ** 31)):
        a = np.array(a, np.uint32)
        assert (bpe.unpack_ranks(bpe.pack_ranks(a)) == a).all()
    for words in ([], [b""], [b"a", b"", b"bc\0", b"x" * 70_000]):
        assert bpe.unpack_words(bpe.pack_words(words)) == words


def test_each_word_is_encoded_once(spark):
    """All places of a word are dealt to one bucket, whatever its block."""
    seen = {}
    rows = docs(spark, [(i, f"alpha beta w{i % 50}") for i in range(400)]).select("doc_id", "text").repartition(6)
    import pyarrow as pa

    schema = "block long, bucket int, words binary, ids array<long>, sizes binary, places binary, ranks binary"
    for r in rows.mapInArrow(bpe._explode(public_tokenizers.PATTERN, 64, 50, pa.int64()), schema).collect():
        words = bpe.unpack_words(bytes(r.words)) if r.words else []
        assert words == sorted(set(words))
        for w in words:
            assert seen.setdefault(w, r.bucket) == r.bucket
    assert {b"alpha", b" beta"} < set(seen)


def test_query(spark, library):
    from billetic.llm.queries import op13_byte_bpe

    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = sorted((d, n, hashlib.sha256(i).hexdigest(), hashlib.sha256(b).hexdigest())
                  for d, n, i, b in plain(library, [(r.doc_id, r.text) for r in table]))
    got = op13_byte_bpe(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == want
