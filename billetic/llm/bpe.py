"""Byte-level BPE by a shuffle of the corpus's distinct words.

A text is cut by a pattern into pre-tokens, and each is encoded by merge
ranks on its own. So a pre-token's ids don't depend on where it stands:

1. Blocks of whole documents (``BLOCK`` bytes of text; a longer document is a
   block of its own) are exploded into pre-tokens with positions. A block
   keeps each distinct word once; its positions are the words' ranks by
   frequency, in text order.
2. The blocks' words are shuffled by a hash of the word, so all places of a
   word meet in one bucket and it is encoded once. A word that is in every
   text is one entry a block. Beyond ``GROUP`` bytes of text, blocks are dealt
   into groups, and a word is encoded once for each, so that no bucket grows
   with the corpus.
3. The ids go back to their blocks: one shuffle by block, in which the block's
   positions meet its words' ids in bucket order, and the documents are put
   together by position.

``decode`` is its inverse on its own: it looks the ids up in the token-byte
table. That table has one row per token (50,256 here) whatever the corpus, and
goes to every task.

Ids are a binary column of little-endian unsigned 32-bit integers; ``as_list``
makes an array of it. The vocabulary is a file of ``base64 rank`` lines, read
by the driver; its path is a parameter. Special tokens aren't known: their
strings are text.

Defined cases: a null or empty text has no ids, and decodes to no bytes; rows
that repeat, in id or in all, are rows of their own; an empty table gives an
empty result. Only the id and the text are read, so other columns may have
any names. An id in ``decode`` that is not in the table raises.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from billetic.llm._common import scratch

BLOCK = 32 << 20            # bytes of text in a block
BUCKET = 64 << 20           # bytes of text for which there is a bucket of words, between 64 and 4096 buckets
GROUP = 1 << 40             # bytes of text whose words meet
PIECE = 1 << 20             # pre-tokens put together at a time


def load_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file: token bytes -> id."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def pack(numbers: np.ndarray) -> bytes:
    """Small unsigned integers in few bytes: byte planes, compressed."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.copy()
    return len(numbers).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 4 * n, "zstd", asbytes=True), np.uint8)
    return planes.reshape(4, n).T.copy().view("<u4").ravel()


def _zipped(data: np.ndarray) -> bytes:
    small = pa.compress(data.tobytes(), "zstd", asbytes=True)
    return len(data).to_bytes(8, "little") + len(small).to_bytes(8, "little") + small


def pack_ranks(ranks: np.ndarray) -> bytes:
    """Ranks by frequency: one byte for the first 192, two for the next
    16,128, and the rest beside them."""
    more = ranks[ranks >= 192].astype(np.int64) - 192
    low = np.where(ranks < 192, ranks, 0).astype(np.uint8)
    low[ranks >= 192] = 192 + np.minimum(more >> 8, 63)
    return _zipped(low) + _zipped((more & 255).astype(np.uint8)) + pack((more >> 8)[more >> 8 >= 63] - 63)


def unpack_ranks(data: bytes) -> np.ndarray:
    at, parts = 0, []
    for _ in range(2):
        n, size = (int.from_bytes(data[at + k:at + k + 8], "little") for k in (0, 8))
        parts.append(np.frombuffer(pa.decompress(data[at + 16:at + 16 + size], n, "zstd", asbytes=True), np.uint8))
        at += 16 + size
    out = parts[0].astype(np.int64)
    more = out[out >= 192] - 192
    more[more == 63] += unpack(data[at:])
    out[out >= 192] = 192 + (more << 8) + parts[1]
    return out


def pack_words(words: list[bytes]) -> bytes:
    """Words, of which neighbours are alike if they are sorted, in few bytes."""
    lens = pack(np.fromiter(map(len, words), np.uint32, len(words)))
    data = b"".join(words)
    return b"".join((len(lens).to_bytes(8, "little"), len(data).to_bytes(8, "little"), lens,
                     pa.Codec("zstd", compression_level=9).compress(data, asbytes=True)))


def unpack_words(packed: bytes) -> list[bytes]:
    at, size = 16 + int.from_bytes(packed[:8], "little"), int.from_bytes(packed[8:16], "little")
    ends = np.cumsum(unpack(packed[16:at]), dtype=np.int64).tolist()
    data = pa.decompress(packed[at:], size, "zstd", asbytes=True)
    return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def gather(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The stretches ``flat[start:start + len]``, one after the other."""
    total = int(lens.sum())
    before = np.cumsum(lens) - lens
    return flat[np.repeat(starts - before, lens) + np.arange(total)]


class _Numbers(dict):
    """Numbers keys in order of first use."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def _explode(pattern: str, buckets: int, block_bytes: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = regex.compile(pattern).findall
        task, made = TaskContext.get().partitionId(), 0
        number, ids, places, size = _Numbers(), [], [], 0

        def finish():
            words = [w.encode() for w in number]
            bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
            order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
            order = order[np.argsort(bucket[order], kind="stable")]
            seq = np.concatenate(places) if places else np.empty(0, np.uint32)
            rank = np.empty(len(words), np.uint32)
            rank[np.argsort(-np.bincount(seq, minlength=len(words)), kind="stable")] = np.arange(len(words))
            used, starts = np.unique(bucket[order], return_index=True)
            ends = np.append(starts, len(words))[1:]
            block = task << 32 | made
            rows = len(used) + 1
            return pa.RecordBatch.from_arrays([
                pa.array([block] * rows, pa.int64()), pa.array([-1, *used.tolist()], pa.int32()),
                pa.array([None, *(pack_words([words[i] for i in order[a:b].tolist()])
                                  for a, b in zip(starts, ends, strict=True))], pa.binary()),
                pa.array([ids] + [None] * len(used), pa.list_(id_type)),
                pa.array([pack(np.array([len(p) for p in places]))] + [None] * len(used), pa.binary()),
                pa.array([pack_ranks(rank[seq])] + [None] * len(used), pa.binary()),
                pa.array([pack(rank[order])] + [None] * len(used), pa.binary()),
            ], names=["block", "bucket", "words", "ids", "sizes", "places", "ranks"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                n = len(text.as_buffer()) if text.is_valid else 0
                if ids and size + n > block_bytes:
                    yield finish()
                    made += 1
                    number, ids, places, size = _Numbers(), [], [], 0
                found = find(text.as_py()) if n else []
                ids.append(doc_id)
                places.append(np.fromiter(map(number.__getitem__, found), np.uint32, len(found)))
                size += n
        if ids:
            yield finish()

    return run


def _encode_words(ranks: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        # the words are cut already: one piece each
        piece = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks,
                                  special_tokens={})._encode_single_piece

        class Ids(dict):
            def __missing__(self, word):
                self[word] = found = np.array(piece(word), np.uint32)
                return found

        known, deal = Ids(), None
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if row["deal"] != deal:
                    known, deal = Ids(), row["deal"]
                found = list(map(known.__getitem__, unpack_words(row["words"])))
                rows.append((row["block"], row["bucket"], pack(np.fromiter(map(len, found), np.uint32, len(found))),
                             pack(np.concatenate(found))))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.binary(),
                                                                              pa.binary()), strict=True)],
                    names=["block", "bucket", "lens", "tokens"])

    return run


def _assemble(id_type: pa.DataType):
    def docs_of(ids, sizes, places, ranks, lens, tokens):
        lens = np.concatenate([unpack(x) for x in lens]).astype(np.int64) if lens else np.empty(0, np.int64)
        flat = np.concatenate([unpack(x) for x in tokens]) if tokens else np.empty(0, np.uint32)
        # the block's words come in bucket order, its positions name them by rank
        word_of = np.empty(len(lens), np.int64)
        word_of[unpack(ranks)] = np.arange(len(lens))
        lens, starts = lens[word_of], (np.cumsum(lens) - lens)[word_of]
        seq, at = unpack_ranks(places), 0
        out, held = [], 0
        for doc_id, n in zip(ids, unpack(sizes).tolist(), strict=True):
            parts = []
            for a in range(at, at + n, PIECE):
                words = seq[a:min(a + PIECE, at + n)]
                parts.append(gather(flat, starts[words], lens[words]).astype("<u4").tobytes())
            at += n
            data = parts[0] if len(parts) == 1 else b"".join(parts)
            out.append((doc_id, len(data) // 4, data))
            held += len(data)
            if held > 4 << 20:
                yield batch_of(out)
                out, held = [], 0
        if out:
            yield batch_of(out)

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (id_type, pa.int64(), pa.binary()), strict=True)],
            names=["doc_id", "n_tokens", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, head, lens, tokens = None, None, [], []
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                if row["block"] != block:
                    if head:
                        yield from docs_of(*head, lens, tokens)
                    block, head, lens, tokens = row["block"], None, [], []
                if row["bucket"] < 0:
                    head = row["ids"], row["sizes"], row["places"], row["ranks"]
                else:
                    lens.append(row["lens"])
                    tokens.append(row["tokens"])
        if head:
            yield from docs_of(*head, lens, tokens)

    return run


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = BLOCK, decoded: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids)`` of every row; with ``decoded``, also the
    bytes that ``decode`` makes of the ids, while they are at hand."""
    spark = docs.sparkSession
    ranks = load_ranks(vocabulary)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType
    arrow_id = spark.createDataFrame([], StructType([StructField("doc_id", id_type)])).toArrow().schema.field(0).type
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(min(4096, max(64, total // BUCKET)))
    groups = int(total // GROUP + 1)

    path = scratch(spark, "pretokens")
    schema = StructType([
        StructField("block", LongType()), StructField("bucket", IntegerType()),
        StructField("words", BinaryType()), StructField("ids", ArrayType(id_type)),
        StructField("sizes", BinaryType()), StructField("places", BinaryType()), StructField("ranks", BinaryType())])
    rows.mapInArrow(_explode(pattern, buckets, block_bytes, arrow_id), schema).write.option(
        "compression", "zstd").parquet(path)
    blocks = spark.read.schema(schema).parquet(path)

    deal = F.xxhash64("bucket", F.pmod(F.xxhash64("block"), F.lit(groups)))
    words = blocks.filter("bucket >= 0").select("block", "bucket", "words", deal.alias("deal"))
    coded = words.repartition("deal").sortWithinPartitions("deal").mapInArrow(
        _encode_words(ranks), "block long, bucket int, lens binary, tokens binary")
    heads = blocks.filter("bucket < 0").select("block", "bucket", "ids", "sizes", "places", "ranks")
    whole = heads.unionByName(coded, allowMissingColumns=True)
    out = StructType([StructField("doc_id", id_type), StructField("n_tokens", LongType()),
                      StructField("ids", BinaryType())])
    assemble = _assemble(arrow_id)
    if decoded:
        decoder = _decoder(ranks)
        out.add("decoded", BinaryType())

        def last(batches):
            return decoder(assemble(batches))
    else:
        last = assemble
    return whole.repartition("block").sortWithinPartitions("block", "bucket").mapInArrow(last, out)


def _decoder(ranks: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_id = dict(zip(ranks.values(), ranks, strict=True))
        tokens = [by_id.get(k) for k in range(max(by_id, default=-1) + 1)]
        lens = np.array([-1 if t is None else len(t) for t in tokens], np.int64)
        flat = np.frombuffer(b"".join(t or b"" for t in tokens), np.uint8)
        starts = np.cumsum(np.maximum(lens, 0)) - np.maximum(lens, 0)
        for batch in batches:
            out = []
            for value in batch.column("ids"):
                ids = np.frombuffer(value.as_py() or b"", "<u4")
                parts = []
                for a in range(0, len(ids), PIECE):
                    some = ids[a:a + PIECE]
                    if some.max() >= len(lens) or lens[some].min() < 0:
                        raise ValueError("an id has no token")
                    parts.append(gather(flat, starts[some], lens[some]).tobytes())
                out.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())],
                                             names=[*batch.schema.names, "decoded"])

    return run


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """The rows of ``encoded`` with ``decoded``, the bytes of their ``ids``."""
    schema = StructType([*encoded.schema.fields, StructField("decoded", BinaryType())])
    return encoded.mapInArrow(_decoder(load_ranks(vocabulary)), schema)


def as_list(ids: Column | str) -> Column:
    """A binary ids column as an array of integers."""

    @pandas_udf("array<int>")
    def of(values: pd.Series) -> pd.Series:
        return values.map(lambda v: np.frombuffer(v or b"", "<u4").astype(np.int32))

    return of(ids)
