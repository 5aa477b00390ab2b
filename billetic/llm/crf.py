"""Language identification with a linear-chain conditional random field.

Every word of a text (a run without white space; only its letters count, in
lower case) is a position of the chain. Its score for a language is a sum of
learned weights of its affixes (first and last 1 to 4 letters), its
letter n-grams (1 to 3, word ends marked) and, if it is in the lexicon, its
own entry; a word without letters scores nothing. Learned transition weights tie neighbouring words, so a language
switch inside a text is found where it happens (``label_words``). Forward and
backward passes give each word's probability of each language; a text's
language is the one with the largest sum over its letters, and the score is
its share.

The fit takes a bounded sample of labelled rows: about ``max_docs`` of them,
an equal number of each language, picked by a hash of the id, and of each
``seq_words * 2`` words from a place that the hash picks, too. Texts of the
sample are cut and joined into sequences that switch between languages, so
that transitions are seen. Only this sample reaches the driver. Prediction
covers every word of every text: the chain of a text is cut into blocks
whose transfer matrices are multiplied, so a text of any length is exact and
needs memory for its word numbers only. Texts are taken in pieces of about
``PIECE`` bytes (a longer text is a piece of its own), so a batch of rows
needs no more memory than its texts and the words of one piece.

Defined cases: a null text and one without letters is ``und`` with score 0,
and so is every text if there is nothing to learn from. Rows without an id
or a language are never learned from. Languages are taken as they are
written; their number is assumed small (tens).
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from billetic.llm._common import unused

UNDETERMINED = "und"
HASHED = 1 << 18
BLOCK = 32
PIECE = 4_000_000
_OTHER = re.compile(r"[\W\d_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def clean(word: str) -> str:
    """Its letters, in lower case (some letter-like signs stay)."""
    return _OTHER.sub("", word.lower())


def words_of(text: str | None) -> list[str]:
    return [clean(w) for w in (text or "").split()]


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def _features(words: list[str], lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, index of the word) pairs of a list of words, word by word in
    no order. Features below HASHED are affixes and n-grams, those from there
    on are places in the lexicon (sorted word hashes)."""
    lens = np.array([len(w) for w in words])
    codes = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"),
                          np.uint32).astype(np.uint64)
    start = np.concatenate(([0], np.cumsum(lens + 2)[:-1]))
    word = np.repeat(np.arange(len(words)), lens + 2)
    feats, owners = [], []

    def add(kind: int, value: np.ndarray, owner: np.ndarray) -> None:
        feats.append((_scramble(value + np.uint64(kind)) >> np.uint64(46)).astype(np.int64))
        owners.append(owner)

    gram = codes
    for n in (1, 2, 3):
        if n > 1:
            gram = _scramble(gram[:-1] * np.uint64(31)) + codes[n - 1:]
        inside = word[: len(gram)] == word[n - 1:]
        if n == 1:
            inside = inside & (codes > 3)
        add(n, gram[inside], word[: len(gram)][inside])
    first, last = start + 1, start + lens
    head = tail = np.zeros(len(words), np.uint64)
    for n in (1, 2, 3, 4):
        ok = lens >= n
        head, tail = head[:], tail[:]
        head = np.where(ok, _scramble(head * np.uint64(31)) + codes[np.minimum(first + n - 1, last)], head)
        tail = np.where(ok, _scramble(tail * np.uint64(37)) + codes[np.maximum(last - n + 1, first)], tail)
        add(10 + n, head[ok], np.flatnonzero(ok))
        add(20 + n, tail[ok], np.flatnonzero(ok))
    if len(lexicon):
        own = word_hashes(words, codes, start, lens)
        at = np.minimum(np.searchsorted(lexicon, own), len(lexicon) - 1)
        hit = np.flatnonzero(lexicon[at] == own)
        feats.append(HASHED + at[hit])
        owners.append(hit)
    return np.concatenate(feats), np.concatenate(owners)


def word_hashes(words, codes=None, start=None, lens=None) -> np.ndarray:
    if codes is None:
        lens = np.array([len(w) for w in words])
        codes = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"),
                              np.uint32).astype(np.uint64)
        start = np.concatenate(([0], np.cumsum(lens + 2)[:-1]))
    place = np.arange(len(codes), dtype=np.uint64) - np.repeat(start, lens + 2).astype(np.uint64)
    return np.add.reduceat(_scramble(codes + (place << np.uint64(32))), start)


@dataclass
class Model:
    labels: list[str]
    lexicon: np.ndarray         # sorted hashes of words
    weights: np.ndarray         # (HASHED + len(lexicon), labels)
    moves: np.ndarray           # (labels, labels)

    def emissions(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.labels)), np.float32)
        for at in range(0, len(words), 10_000):
            part = words[at:at + 10_000]
            feats, owners = _features(part, self.lexicon)
            for k in range(len(self.labels)):
                out[at:at + len(part), k] = np.bincount(owners, self.weights[feats, k], len(part))
        return out


def _forward_backward(scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equally long chains ``scores`` (chains, words, labels): each word's
    label probabilities, and the expected number of each move."""
    n, t, k = scores.shape
    b = np.exp(scores - scores.max(2, keepdims=True))
    a = np.exp(moves)
    alpha, beta = np.empty_like(b), np.ones_like(b)
    cur = b[:, 0]
    for i in range(t):
        if i:
            cur = (cur @ a) * b[:, i]
        cur = cur / cur.sum(1, keepdims=True)
        alpha[:, i] = cur
    expected = np.zeros((k, k))
    for i in range(t - 2, -1, -1):
        nxt = b[:, i + 1] * beta[:, i + 1]
        pair = alpha[:, i, :, None] * a[None] * nxt[:, None, :]
        expected += (pair / pair.sum((1, 2), keepdims=True)).sum(0)
        cur = nxt @ a.T
        beta[:, i] = cur / cur.sum(1, keepdims=True)
    post = alpha * beta
    return post / post.sum(2, keepdims=True), expected


def fit(sample: list[tuple[str, list[str]]], seq_words: int = 48, n_seqs: int = 4000,
        epochs: int = 4, max_lexicon: int = 50_000, seed: int = 7) -> Model | None:
    """Fit on ``(language, words)`` pairs by AdaGrad on the chains' negative
    log-likelihood; ``None`` if no pair has words."""
    sample = [(lab, [x for x in w if x]) for lab, w in sample]
    sample = [(lab, w) for lab, w in sample if w]
    if not sample:
        return None
    rng = np.random.default_rng(seed)
    labels = sorted({lab for lab, _ in sample})
    place = {lab: i for i, lab in enumerate(labels)}
    vocab: dict[str, int] = {}
    docs = [(place[lab], np.array([vocab.setdefault(x, len(vocab)) for x in w])) for lab, w in sample]
    counts = np.bincount(np.concatenate([w for _, w in docs]), minlength=len(vocab))
    words = list(vocab)
    often = np.argsort(-counts, kind="stable")[:max_lexicon]
    often = often[counts[often] >= 2]
    lexicon = np.unique(word_hashes([words[i] for i in often])) if len(often) else np.empty(0, np.uint64)
    feats, owners = _features(words, lexicon)
    order = np.argsort(owners, kind="stable")
    feats, owners = feats[order], owners[order]
    first = np.searchsorted(owners, np.arange(len(words) + 1))

    by_label = [[i for i, (lab, _) in enumerate(docs) if lab == k] for k in range(len(labels))]

    def sequence() -> tuple[np.ndarray, np.ndarray]:
        ids, labs, need = [], [], seq_words
        switching = rng.random() < 0.5
        while need > 0:
            lab = int(rng.integers(len(labels)))
            w = docs[by_label[lab][int(rng.integers(len(by_label[lab])))]][1]
            n = min(need, len(w), int(rng.integers(3, 24)) if switching else need)
            at = int(rng.integers(len(w) - n + 1))
            ids.append(w[at:at + n])
            labs.append(np.full(n, lab))
            need -= n
        return np.concatenate(ids), np.concatenate(labs)

    drawn = [sequence() for _ in range(n_seqs)]
    xs, ys = np.stack([d[0] for d in drawn]), np.stack([d[1] for d in drawn])
    k, size = len(labels), HASHED + len(lexicon)
    w, g2 = np.zeros((size, k), np.float32), np.full((size, k), 1e-3, np.float32)
    moves, m2 = np.eye(k) * 2.0, np.full((k, k), 1.0)
    for _ in range(epochs):
        mixed = rng.permutation(n_seqs)
        for at in range(0, n_seqs, 100):
            x, y = xs[mixed[at:at + 100]], ys[mixed[at:at + 100]]
            uniq, inv = np.unique(x, return_inverse=True)
            spans = [np.arange(first[u], first[u + 1]) for u in uniq]
            own = np.repeat(np.arange(len(uniq)), [len(s) for s in spans])
            f = feats[np.concatenate(spans)]
            em = np.stack([np.bincount(own, w[f, j], len(uniq)) for j in range(k)], 1)
            post, expected = _forward_backward(em[inv.reshape(x.shape)], moves)
            seen = np.zeros((k, k))
            np.add.at(seen, (y[:, :-1], y[:, 1:]), 1)
            grad = post.reshape(-1, k)
            grad[np.arange(len(grad)), y.ravel()] -= 1
            du = np.stack([np.bincount(inv.ravel(), grad[:, j], len(uniq)) for j in range(k)], 1)
            touched, back = np.unique(f, return_inverse=True)
            gw = np.stack([np.bincount(back, du[own, j], len(touched)) for j in range(k)], 1)
            gw = (gw / len(x) + 1e-5 * w[touched]).astype(np.float32)
            g2[touched] += gw * gw
            w[touched] -= 0.1 * gw / np.sqrt(g2[touched])
            gm = (expected - seen) / len(x)
            m2 += gm * gm
            moves -= 0.1 * gm / np.sqrt(m2)
    return Model(labels, lexicon, w, moves)


def _chain_sums(model: Model, ids: np.ndarray, lens: np.ndarray, expe: np.ndarray,
                weight: np.ndarray) -> np.ndarray:
    """Per chain the sum over its words of weight x label probability.
    ``expe`` (labels, words) holds the words' exponentiated scores.

    Chains are cut into blocks of BLOCK words. First the blocks' transfer
    matrices, then what enters each block from both sides, then the word
    probabilities inside. Blocks are the last axis of all arrays."""
    k, a = len(model.labels), np.exp(model.moves).astype(np.float32)
    at_t = np.ascontiguousarray(a.T)
    n_blocks = -(-lens // BLOCK)
    doc = np.repeat(np.arange(len(lens)), n_blocks)
    head = np.cumsum(n_blocks) - n_blocks
    nth = np.arange(len(doc)) - head[doc]
    begin = (np.cumsum(lens) - lens)[doc] + nth * BLOCK
    size = np.minimum(lens[doc] - nth * BLOCK, BLOCK)
    order = np.argsort(-size, kind="stable")     # the blocks that reach step t are the first ones
    transfer = np.empty((k, k, len(doc)), np.float32)

    def parts():
        for at in range(0, len(doc), 1 << 14):
            blocks = order[at:at + (1 << 14)]
            ends = [int((size[blocks] > t).sum()) for t in range(BLOCK)]
            yield blocks, ends, begin[blocks], np.flatnonzero(nth[blocks] == 0)

    for blocks, ends, begins, opens in parts():
        p = np.broadcast_to(np.eye(k, dtype=np.float32)[:, :, None], (k, k, len(blocks))).copy()
        for t in range(BLOCK):
            n = ends[t]
            if not n:
                break
            q = np.matmul(at_t, p[:, :, :n])
            if t == 0:
                q[:, :, opens] = p[:, :, opens]
            q *= expe[:, ids[begins[:n] + t]]
            q /= q.max((0, 1))
            p[:, :, :n] = q
        transfer[:, :, blocks] = p

    into, out = np.ones((k, len(doc)), np.float32), np.ones((k, len(doc)), np.float32)
    longest = np.argsort(-n_blocks, kind="stable")
    ranked = -n_blocks[longest]
    for j in range(1, int(n_blocks.max())):
        chains = longest[: np.searchsorted(ranked, -j, "left")]
        at = head[chains] + j
        v = np.einsum("in,ijn->jn", into[:, at - 1], transfer[:, :, at - 1])
        into[:, at] = v / v.max(0)
        at = head[chains] + n_blocks[chains] - 1 - j
        v = np.einsum("ijn,jn->in", transfer[:, :, at + 1], out[:, at + 1])
        out[:, at] = v / v.max(0)

    total = np.zeros((len(lens), k))
    for blocks, ends, begins, opens in parts():
        cur, alphas = into[:, blocks], []
        for t in range(BLOCK):
            n = ends[t]
            if not n:
                break
            nxt = at_t @ cur[:, :n]
            if t == 0:
                nxt[:, opens] = cur[:, opens]
            words = ids[begins[:n] + t]
            b = expe[:, words]
            nxt *= b
            nxt /= nxt.max(0)
            cur[:, :n] = nxt
            alphas.append((nxt, b, words))
        beta, sums = out[:, blocks], np.zeros((k, len(blocks)))
        for alpha, b, words in reversed(alphas):
            n = len(words)
            post = alpha * beta[:, :n]
            sums[:, :n] += post * (weight[words] / post.sum(0))
            prev = a @ (b * beta[:, :n])
            beta[:, :n] = prev / prev.max(0)
        for j in range(k):
            total[:, j] += np.bincount(doc[blocks], sums[j], len(lens))
    return total


def _pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in order, cut where another PIECE bytes have gone by: a piece
    has less than PIECE bytes before its last text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
    nth = (np.cumsum(sizes, dtype=np.int64) - sizes) // PIECE
    ends = [*(np.flatnonzero(np.diff(nth)) + 1).tolist(), len(texts)]
    for at, end in itertools.pairwise([0, *ends]):
        yield texts.slice(at, end - at)


def predict(model: Model | None, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text of an Arrow array of strings."""
    if model is None or not len(texts):
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    found = [_predict_piece(model, piece) for piece in _pieces(texts)]
    return [lab for labels, _ in found for lab in labels], np.concatenate([scores for _, scores in found])


def _predict_piece(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    labels, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    split = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    lens = pc.list_value_length(split).to_numpy()
    coded = pc.list_flatten(split).dictionary_encode()
    del split
    rows = np.flatnonzero(lens)
    if not len(rows):
        return labels, scores
    cleaned: dict[str, int] = {}
    of_token = np.array([cleaned.setdefault(clean(w), len(cleaned))
                         for w in coded.dictionary.to_pylist()], np.int32)
    words = list(cleaned)
    # a word character need not be a letter (a superscript two is none)
    weight = np.array([len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in words], np.float32)
    em = model.emissions(words)
    em[weight == 0] = 0
    em = np.maximum(em - em.max(1, keepdims=True), -30)
    ids = of_token[coded.indices.to_numpy()]
    del coded, cleaned, words, of_token
    total = _chain_sums(model, ids, lens[rows], np.ascontiguousarray(np.exp(em).T), weight)
    for row, sums in zip(rows.tolist(), total, strict=True):
        if (whole := sums.sum()) > 0:
            best = int(sums.argmax())
            labels[row], scores[row] = model.labels[best], min(1.0, float(sums[best] / whole))
    return labels, scores


def label_words(model: Model, text: str) -> list[tuple[str, str, float]]:
    """Each word of a text with its likeliest language and that probability."""
    words = words_of(text)
    if not words:
        return []
    em = model.emissions(words)
    em[[not any(map(str.isalpha, w)) for w in words]] = 0
    post, _ = _forward_backward(em[None].astype(np.float64), model.moves)
    return [(w, model.labels[int(p.argmax())], float(p.max())) for w, p in zip(words, post[0], strict=True)]


def held_out(id_col: Column | str) -> Column:
    """crc32(id as text) mod 3 is 1; false without an id."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_docs: int = 3000, seq_words: int = 48, **options) -> Model | None:
    """Fit on a bounded sample of the rows that have an id and a language and
    are not held out: about ``max_docs`` rows in all, as many of each
    language (all if a language has fewer)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.col(lang_col).alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items())
                           for x in (lang, min(1.0, max_docs / len(counts) / n))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    pick = rows.filter(draw < share[F.col("lang")])
    words = F.split(F.col("text"), r"\s+")
    take = 2 * seq_words
    at = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(F.size(words) - take, F.lit(1))) + 1
    cut = F.concat_ws(" ", F.slice(words, at.cast("int"), take))
    sample = pick.filter(F.col("text").isNotNull()).select("doc_id", "lang", cut.alias("cut"))
    # ids share their draw: where many rows have one id, twice the sample is the most that is taken
    sample = sample.orderBy(F.xxhash64("doc_id"), F.xxhash64("cut")).limit(2 * max_docs).collect()
    sample.sort(key=lambda r: (r["doc_id"], r["lang"], r["cut"]))
    return fit([(r["lang"], words_of(r["cut"])) for r in sample], seq_words=seq_words, **options)


def language(model: Model | None, text: Column | str) -> Column:
    """Struct (lang_pred, score) of a text column."""

    @arrow_udf("lang_pred string, score double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            labels, scores = predict(model, texts.cast(pa.large_string()))
            yield pa.StructArray.from_arrays([pa.array(labels, pa.string()), pa.array(scores)],
                                             names=["lang_pred", "score"])

    return of(text)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             **options) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row."""
    model = train(docs, id_col, text_col, lang_col, **options)
    return docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                       language(model, text_col).alias("found")).select("doc_id", "held_out", "found.*")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang", min_score: float = 1 / 3, **options) -> DataFrame:
    """The rows whose text has letters and whose likeliest language has at
    least ``min_score`` of them; columns unchanged."""
    model = train(docs, id_col, text_col, lang_col, **options)
    name = unused("__lang", docs)
    found = docs.withColumn(name, language(model, text_col))
    good = (F.col(name)["lang_pred"] != UNDETERMINED) & (F.col(name)["score"] >= min_score)
    return found.filter(good).drop(name) if model else docs.filter(F.lit(False))
