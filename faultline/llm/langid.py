"""Operator 6: language identification by segmentation-marginalised unigrams.

Every language has a probability per piece of a fixed public vocabulary. The
probability of a word is the sum over all its segmentations into pieces (forward
algorithm over byte positions); a text's is the product over its words. The
piece probabilities are fitted by expectation maximisation (forward-backward)
on the words of a bounded number of labelled texts per language, until the likelihood hardly rises. Words repeat, so
each worker keeps the log-probabilities of words it has met in a bounded table.

Words are whole, however long (a sentence without blanks is one word), and every piece of the vocabulary counts. Where
no piece reaches across a position, every segmentation has a boundary there, so the sum is a product of two
sums: long words are cut at such positions only, which changes nothing. What is still long is summed with a
window as long as the longest piece, rescaled as it goes.
"""

from __future__ import annotations

import math
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.byte_bpe import read_ranks, vocabulary_path
from faultline.llm.common import held, held_out, lean, prepare, same_or_new, stage, words_of

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
BLOCK = 32  # bytes up to which a sum over all segmentations is held as one row of a matrix (and can't underflow)
TRAIN_DOCS = 1000  # expected number of labelled texts per language
MAX_LANGUAGES = 400
LEAST_RISE = 0.02  # rounds go on while the log-likelihood rises by more than this share of itself
SMOOTH = 0.01  # added to every expected count
KEPT_WORDS = 75_000  # words in the per-worker table (about 15 MB); it is emptied when full
SPLIT_BYTES = 1 << 20  # bytes of texts split into words at once, unless one text alone is longer


class Pieces:
    """Vocabulary as a prefix table: bytes -> piece index, or -1 for a mere prefix."""

    def __init__(self, pieces: list[bytes]):
        self.count = len(pieces)
        self.longest = max(map(len, pieces), default=0)
        self.table: dict[bytes, int] = {}
        for i, p in enumerate(pieces):
            for k in range(1, len(p)):
                self.table.setdefault(p[:k], -1)
            self.table[p] = i
        # The same as a trie, for many words at once: node << 8 | next byte, sorted, and the node it leads to (root: 0).
        node = {p: n for n, p in enumerate(self.table, 1)}
        node[b""] = 0
        key = np.fromiter((node[p[:-1]] << 8 | p[-1] for p in self.table), np.int64, len(self.table))
        order = np.argsort(key)
        self.child_key, self.child = key[order], order + 1
        self.piece_at = np.fromiter(chain([-1], self.table.values()), np.int64, len(self.table) + 1)

    def edges(self, words: list[bytes]) -> np.ndarray:
        """Rows (word, start, end, piece) of every piece occurrence, by end position, then word.

        All positions of all words walk down the trie together, one byte a round. One integer per occurrence while
        they are gathered: end, word, start (6 bits: a word has at most BLOCK bytes) and piece, so that
        sorting the integers sorts the rows.
        """
        raw = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        size = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), size)
        begin = (np.cumsum(size) - size)[word]
        stop = begin + size[word]
        at = np.arange(len(raw))  # where a walk started, the byte it reads next, its node
        now, node, out = at, np.zeros(len(raw), np.int64), []
        while len(at) and len(self.child_key):
            key = node << 8 | raw[now]
            slot = np.minimum(np.searchsorted(self.child_key, key), len(self.child_key) - 1)
            on = np.flatnonzero(self.child_key[slot] == key)
            at, now, node = at[on], now[on] + 1, self.child[slot[on]]
            k = self.piece_at[node]
            full = np.flatnonzero(k >= 0)
            i = at[full]
            out.append((now[full] - begin[i]) << 44 | word[i] << 26 | (i - begin[i]) << 20 | k[full])
            more = np.flatnonzero(now < stop[at])
            at, now, node = at[more], now[more], node[more]
        e = np.concatenate(out) if out else np.empty(0, np.int64)
        e.sort()
        return np.stack([e >> 26 & 0x3FFFF, e >> 20 & 0x3F, e >> 44, e & 0xFFFFF], axis=1)

    def starting(self, word: bytes, i: int) -> list[tuple[int, int]]:
        """(end, piece) of the pieces that start at a position."""
        out, get = [], self.table.get
        for j in range(i + 1, len(word) + 1):
            k = get(word[i:j])
            if k is None:
                break
            if k >= 0:
                out.append((j, k))
        return out

    def blocks(self, word: bytes) -> list[bytes]:
        """A word with the blank before it, cut where no piece reaches across."""
        word = b" " + word
        if len(word) <= BLOCK:
            return [word]
        out, begin, reach = [], 0, 0
        for i in range(len(word)):
            if i and reach <= i:
                out.append(word[begin:i])
                begin = i
            found = self.starting(word, i)
            reach = max(reach, found[-1][0] if found else i + 1)
        return [*out, word[begin:]]


def load_pieces(path: str | None = None) -> list[bytes]:
    """All pieces, single bytes among them, in the order of their ranks."""
    ranks = read_ranks(path or vocabulary_path(VOCABULARY))
    return [t for t, _ in sorted(ranks.items(), key=lambda x: x[1])]


def _steps(e: np.ndarray):
    """Slices of edges with the same end position."""
    if not len(e):
        return
    cut = np.flatnonzero(np.diff(e[:, 2])) + 1
    yield from zip(np.r_[0, cut], np.r_[cut, len(e)])


def forward(words: list[bytes], e: np.ndarray, prob: np.ndarray) -> np.ndarray:
    """alpha[word, position, language]: probability of the first bytes, over all segmentations."""
    alpha = np.zeros((len(words), max(map(len, words), default=0) + 1, prob.shape[1]))
    alpha[:, 0] = 1.0
    for s, t in _steps(e):
        w, i, j, k = e[s:t].T
        first = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
        alpha[w[first], j[0]] = np.add.reduceat(alpha[w, i] * prob[k], first, axis=0)
    return alpha


def log_prob_long(block: bytes, pieces: Pieces, prob: np.ndarray) -> np.ndarray:
    """Log-probability of one block of any length per language: a window of sums, rescaled when they get small."""
    width = pieces.longest + 1
    window, scale = np.zeros((width, prob.shape[1])), np.zeros(prob.shape[1])
    window[0] = 1.0
    for i in range(len(block)):
        here = window[i % width].copy()
        window[i % width] = 0.0
        if here.min() < 1e-100:
            window /= here
            scale += np.log(here)
            here[:] = 1.0
        for j, k in pieces.starting(block, i):
            window[j % width] += here * prob[k]
    return scale + np.log(window[len(block) % width])


def log_prob(words: list[bytes], pieces: Pieces, prob: np.ndarray, step: int = 4096) -> np.ndarray:
    """Natural log of each word's probability per language."""
    out = np.empty((len(words), prob.shape[1]))
    for s in range(0, len(words), step):
        part = words[s:s + step]
        cut = [pieces.blocks(w) for w in part]
        flat = [b for c in cut for b in c]
        short = [i for i, b in enumerate(flat) if len(b) <= BLOCK]
        own = [flat[i] for i in short]
        each = np.empty((len(flat), prob.shape[1]))
        for a in range(0, len(own), 1 << 16):
            some = own[a:a + (1 << 16)]
            alpha = forward(some, pieces.edges(some), prob)
            each[short[a:a + (1 << 16)]] = np.log(alpha[np.arange(len(some)), [len(b) for b in some]])
        for i, b in enumerate(flat):
            if len(b) > BLOCK:
                each[i] = log_prob_long(b, pieces, prob)
        first = np.cumsum([0] + [len(c) for c in cut[:-1]])
        out[s:s + len(part)] = np.add.reduceat(each, first, axis=0)
    return out


def _expected_long(block: bytes, pieces: Pieces, prob: np.ndarray, weight: float, total: np.ndarray) -> float:
    """Adds the expected pieces of one long block of one language to ``total``; its log-probability."""
    n = len(block)
    found = [pieces.starting(block, i) for i in range(n)]
    log = {k: float(np.log(prob[k])) for f in found for _, k in f}
    front, back = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    front[0] = back[n] = 0.0
    for i in range(n):
        for j, k in found[i]:
            front[j] = np.logaddexp(front[j], front[i] + log[k])
    for i in reversed(range(n)):
        for j, k in found[i]:
            back[i] = np.logaddexp(back[i], back[j] + log[k])
    for i in range(n):
        for j, k in found[i]:
            total[k] += weight * math.exp(front[i] + log[k] + back[j] - front[n])
    return float(front[n])


def _expected_short(flat: list[bytes], wt: np.ndarray, la: np.ndarray, pieces: Pieces, prob: np.ndarray,
                    total: np.ndarray) -> float:
    """The same for many blocks of at most BLOCK bytes, each of one language; the sum of their weighted log-probabilities."""
    e = pieces.edges(flat)
    own = prob[e[:, 3], la[e[:, 0]]]
    size = np.array([len(b) for b in flat])
    alpha = np.zeros((len(flat), int(size.max()) + 1))
    beta = np.zeros_like(alpha)
    alpha[:, 0] = 1.0
    beta[np.arange(len(flat)), size] = 1.0
    for a, b in _steps(e):
        w, i, j = e[a:b, 0], e[a:b, 1], e[a:b, 2]
        np.add.at(alpha, (w, j), alpha[w, i] * own[a:b])
    back = np.argsort(-e[:, 1], kind="stable")
    eb, ob = e[back], own[back]
    cut = np.flatnonzero(np.diff(eb[:, 1])) + 1
    for a, b in zip(np.r_[0, cut], np.r_[cut, len(eb)]):
        w, i, j = eb[a:b, 0], eb[a:b, 1], eb[a:b, 2]
        np.add.at(beta, (w, i), beta[w, j] * ob[a:b])
    share = alpha[e[:, 0], e[:, 1]] * own * beta[e[:, 0], e[:, 2]] / beta[e[:, 0], 0]
    np.add.at(total, (e[:, 3], la[e[:, 0]]), share * wt[e[:, 0]])
    return float((wt * np.log(beta[:, 0])).sum())


def expected(words: list[bytes], weight: np.ndarray, lang: np.ndarray, pieces: Pieces,
             prob: np.ndarray) -> tuple[np.ndarray, float]:
    """Expected piece counts (pieces x languages) of weighted words, each of one language, and their log-likelihood."""
    total, likely = np.zeros((pieces.count, prob.shape[1])), 0.0
    for s in range(0, len(words), 4096):
        flat, wt, la = [], [], []
        for w, x, l in zip(words[s:s + 4096], weight[s:s + 4096], lang[s:s + 4096]):
            for b in pieces.blocks(w):
                if len(b) > BLOCK:
                    likely += x * _expected_long(b, pieces, prob[:, l], float(x), total[:, l])
                    continue
                flat.append(b)
                wt.append(x)
                la.append(l)
        for a in range(0, len(flat), 1 << 16):
            part = slice(a, a + (1 << 16))
            likely += _expected_short(flat[part], np.array(wt[part], float), np.array(la[part]), pieces, prob, total)
    return total, likely


def _pieces(shared) -> Pieces:
    return held("pieces", (len(shared.value), hash(tuple(shared.value[-50:]))), lambda: Pieces(shared.value))


def _word_counts(batches):
    from collections import Counter
    for b in batches:
        by: dict[str, Counter] = {}
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            by.setdefault(lang, Counter()).update(words_of(text))
        rows = [(l, w, n) for l, c in by.items() for w, n in c.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()),
             pa.array([r[2] for r in rows], pa.int64())], names=["lang", "word", "n"])


def _expect(shared, langs: list[str], prob):
    def run(batches):
        pieces, at = _pieces(shared), {l: i for i, l in enumerate(langs)}
        total, likely = np.zeros((pieces.count, len(langs))), 0.0
        for b in batches:
            if b.num_rows:
                more, x = expected(b.column(1).to_pylist(), np.array(b.column(2)),
                                   np.array([at[x] for x in b.column(0).to_pylist()]), pieces, prob.value)
                total += more
                likely += x
        k, l = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[k, -1].astype(np.int32)), pa.array(np.r_[l, 0].astype(np.int32)),
                                          pa.array(np.r_[total[k, l], likely])], names=["k", "l", "n"])
    return run


def fit(docs: DataFrame, path: str | None = None, train_docs: int = TRAIN_DOCS) -> dict:
    """Model from ``docs(doc_id, text, lang)``: languages, priors and piece probabilities.

    Rows with NULL text or lang are left out. About ``train_docs`` texts per
    language, chosen by a hash of the id, are the bounded training sample.
    """
    spark = docs.sparkSession
    prepare(spark)
    d = same_or_new(docs, [("doc_id", "bigint"), ("text", "binary"), ("lang", "string")])
    d = d.where("text is not null and lang is not null")
    counts = {r["lang"]: r["count"] for r in d.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    langs = sorted(counts)
    pieces = load_pieces(path)
    if not langs:
        return {"langs": [], "pieces": pieces, "prob": np.zeros((len(pieces), 0)), "prior": np.zeros(0)}
    share = spark.createDataFrame([(l, min(1.0, train_docs / n)) for l, n in counts.items()], "lang string, share double")
    place = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(1 << 30)) / float(1 << 30)
    sample = d.join(F.broadcast(share), "lang").where(F.coalesce(place < F.col("share"), F.lit(False)))
    words = stage(sample.select("lang", "text").mapInArrow(_word_counts, "lang string, word binary, n bigint")
                  .groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    shared = spark.sparkContext.broadcast(pieces)
    prob = np.full((len(pieces), len(langs)), 1.0 / len(pieces))
    before = None
    while True:
        got = (words.mapInArrow(lean(_expect(shared, langs, spark.sparkContext.broadcast(prob))), "k int, l int, n double")
               .groupBy("k", "l").agg(F.sum("n").alias("n")).toPandas())  # at most pieces x languages rows
        likely = float(got.loc[got["k"] < 0, "n"].sum())
        got = got[got["k"] >= 0]
        total = np.full(prob.shape, SMOOTH)
        total[got["k"], got["l"]] += got["n"]
        prob = total / total.sum(axis=0)
        if not likely or (before is not None and likely - before <= LEAST_RISE * abs(likely)):
            break
        before = likely
    prior = np.array([counts[l] for l in langs], float)
    return {"langs": langs, "pieces": pieces, "prob": prob, "prior": np.log(prior / prior.sum())}


class _Scorer:
    def __init__(self, pieces: Pieces, prob: np.ndarray, prior: np.ndarray):
        self.pieces, self.prob, self.prior = pieces, prob, prior
        self.at: dict[bytes, int] = {}
        self.rows = np.empty((0, prob.shape[1]))

    def __call__(self, texts: list[bytes | None]) -> np.ndarray:
        """Posterior of each language for each text, a few texts at a time: their words are many times their size."""
        lot = np.cumsum([len(t or b"") for t in texts]) // SPLIT_BYTES
        cut = [0, *(np.flatnonzero(np.diff(lot)) + 1).tolist(), len(texts)]
        return np.concatenate([self._some(texts[a:b]) for a, b in zip(cut, cut[1:])])

    def _some(self, texts: list[bytes | None]) -> np.ndarray:
        if len(self.at) > KEPT_WORDS:
            self.at, self.rows = {}, self.rows[:0]
        at = self.at
        split = [words_of(t) for t in texts]
        new = set()
        for w in split:
            new.update(w)
        new = [w for w in new if w not in at]
        if new:
            base = len(self.rows)
            self.rows = np.concatenate([self.rows, log_prob(new, self.pieces, self.prob)])
            at.update((w, base + i) for i, w in enumerate(new))
        out = np.tile(self.prior, (len(texts), 1))
        for i, w in enumerate(split):
            if w:
                out[i] += self.rows[np.fromiter(map(at.__getitem__, w), np.int64, len(w))].sum(axis=0)
        out -= out.max(axis=1, keepdims=True)
        out = np.exp(out)
        return out / out.sum(axis=1, keepdims=True)


def _predict(shared, prob, prior, langs, text_at: int, key: str):
    def run(batches):
        score = held("language", key, lambda: _Scorer(Pieces(shared.value), prob.value, prior))
        for b in batches:
            post = score(b.column(text_at).to_pylist())
            best = post.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*(c for i, c in enumerate(b.columns) if i != text_at),
                 pa.array([langs[i] for i in best], pa.string()), pa.array(post[np.arange(len(best)), best])],
                names=[*(n for i, n in enumerate(b.schema.names) if i != text_at), "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, lang_pred, score``: one row per input row.

    ``und`` with score 0 for NULL texts, texts without a letter, and when there was nothing to
    learn from. Equal texts get equal results, the first of languages with equal scores in alphabetical order; a
    text is read whole, whatever its length. Extra columns are ignored.
    """
    return _labelled(same_or_new(docs, [("doc_id", "bigint"), ("text", "string")]), model).select(
        "doc_id", "lang_pred", "score")


def _labelled(d: DataFrame, model: dict) -> DataFrame:
    """``d`` with a string column ``text`` -> the same columns but text, lang_pred, score."""
    import hashlib
    spark = d.sparkSession
    prepare(spark)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if not model["langs"]:
        return d.withColumn("lang_pred", F.lit("und")).withColumn("score", F.lit(0.0)).drop("text")
    tagged = d.select(*[c for c in d.columns if c != "text"], lettered.alias("_lettered"),
                      F.when(lettered, F.col("text").cast("binary")).alias("text"))
    key = hashlib.sha256(model["prob"].tobytes() + repr(model["langs"]).encode()).hexdigest()
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in tagged.schema if f.name != "text"),
                        "lang_pred string", "score double"])
    out = tagged.mapInArrow(lean(_predict(spark.sparkContext.broadcast(model["pieces"]), spark.sparkContext.broadcast(model["prob"]),
                                     model["prior"], model["langs"], tagged.columns.index("text"), key)), schema)
    return (out.withColumn("lang_pred", F.when(F.col("_lettered"), F.col("lang_pred")).otherwise("und"))
            .withColumn("score", F.when(F.col("_lettered"), F.col("score")).otherwise(0.0)).drop("_lettered"))


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows that may be learnt from: crc32 of the id modulo 3 is not 1."""
    return docs.where(~held_out(F.col("doc_id"), 3, 1))


def keep_known(docs: DataFrame, model: dict, least: float = 0.5) -> DataFrame:
    """Rows of ``docs``, unchanged, whose language is known: not ``und`` and score at least ``least``."""
    names = docs.columns
    tagged = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = tagged.columns[[n.lower() for n in names].index("text")]
    out = _labelled(tagged.withColumn("text", F.col(text).cast("string")), model)
    out = out.where((F.col("lang_pred") != "und") & (F.col("score") >= least))
    return out.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
