"""Operator 2: toxicity by a weighted finite-state pattern grammar.

A lexicon maps words to symbols: insults (learnt, with weights), threats, targets,
negations and words of reported speech. Four small transducers read a
clause's symbols - negation, reported speech, target, threat - and are composed
into one machine whose paths multiply the weight of an insult or a threat: less under negation or in reported
speech, more where the clause names a target. What follows a word of saying and a comma or colon belongs to its
clause. Clauses are scored, not words; a
logistic model over a text's matched clauses gives the score.

The lexicon and the model are fitted on a bounded sample of labelled texts.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import h64, held_out, prepare, same_or_new

TRAIN_ROWS = 20_000  # expected number of labelled texts that are learnt from
LEAST_TEXTS = 3  # different toxic texts that an insult must occur in
LEAST_EVIDENCE = 12.0  # log-likelihood ratio
THRESHOLD = 0.3
WEIGHT_CAP = 5.0

THREATS = frozenset("""kill hurt destroy beat burn shoot stab punch hang töten schlagen verbrennen erschießen
tuer frapper brûler détruire matar golpear quemar destruir""".split())
TARGETS = frozenset("""you your yours yourself he she him her they them du dich dir euch ihr sie
tu toi te vous ils elles lui leur tú ti usted ustedes ellos ellas""".split())
THREAT_WEIGHT = 1.0  # of a threat word, before the machine's factors
NEGATIONS = frozenset("""not no never none nor without nicht kein keine nie niemals ohne ne pas jamais sans aucun
nunca jamás sin ningún""".split())
REPORTS = frozenset("""said says saying called claimed wrote reported quoted sagte sagt schrieb behauptete
dit disait écrit affirmé dijo dice escribió afirmó""".split())

_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE = re.compile(r"[.!?;:,\n()|]+")
SYMBOLS = "insult threat target negation report other".split()
INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = range(6)


@dataclass(frozen=True)
class Transducer:
    """``step[state][symbol] = (next state, factor of an insult or threat read here)``; ``final[state]`` factor of the clause."""
    step: tuple[tuple[tuple[int, float], ...], ...]
    final: tuple[float, ...]


def transducer(states: int, rule, final) -> Transducer:
    return Transducer(tuple(tuple(rule(s, x) for x in range(len(SYMBOLS))) for s in range(states)),
                      tuple(final(s) for s in range(states)))


def compose(*parts: Transducer) -> Transducer:
    """Product machine: all parts read the same symbol, factors multiply."""
    states = list(itertools.product(*[range(len(p.final)) for p in parts]))
    number = {s: i for i, s in enumerate(states)}
    step = []
    for s in states:
        row = []
        for x in range(len(SYMBOLS)):
            moves = [p.step[q][x] for p, q in zip(parts, s)]
            row.append((number[tuple(m[0] for m in moves)], float(np.prod([m[1] for m in moves]))))
        step.append(tuple(row))
    return Transducer(tuple(step), tuple(float(np.prod([p.final[q] for p, q in zip(parts, s)])) for s in states))


#: A negation reaches three words; reported speech and a target hold to the end of the clause.
NEGATED = transducer(4, lambda s, x: (3 if x == NEGATION else max(0, s - 1), 0.3 if s and x in (INSULT, THREAT) else 1.0), lambda s: 1.0)
REPORTED = transducer(2, lambda s, x: (1 if x == REPORT else s, 0.5 if s and x in (INSULT, THREAT) else 1.0), lambda s: 1.0)
TARGETED = transducer(2, lambda s, x: (1 if x == TARGET else s, 1.0), lambda s: 1.5 if s else 1.0)
#: A threat after another, or after an insult, in one clause weighs more.
THREATENED = transducer(2, lambda s, x: (1 if x in (THREAT, INSULT) else s, 1.25 if s and x == THREAT else 1.0), lambda s: 1.0)
GRAMMAR = compose(NEGATED, REPORTED, TARGETED, THREATENED)


class Lexicon:
    def __init__(self, insults: dict[str, float]):
        self.weight = insults
        self.symbol: dict[str, int] = {}
        for words, x in ((THREATS, THREAT), (TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT)):
            self.symbol.update(dict.fromkeys(words, x))
        self.symbol.update(dict.fromkeys(insults, INSULT))  # what was learnt comes first
        self.insults = frozenset(insults)


FEATURES = ["weight", "most", "clauses", "targeted", "damped", "threats", "share"]


def clauses_of(low: str):
    """Words of each clause; one that ends in a word of saying goes on behind its comma or colon."""
    at, words = 0, []
    for m in _CLAUSE.finditer(low):
        words += _WORD.findall(low, at, m.start())
        at = m.end()
        if words and not (words[-1] in REPORTS and set(m[0].strip()) <= {",", ":", '"'}):
            yield words
            words = []
    words += _WORD.findall(low, at)
    if words:
        yield words


def features(text: str | None, lex: Lexicon) -> list[float]:
    """What the grammar matches in a whole text, clause by clause."""
    out = [0.0] * len(FEATURES)
    if not text:
        return out
    low = text.lower()
    words = _WORD.findall(low)
    if lex.insults.isdisjoint(words) and THREATS.isdisjoint(words):
        return out
    clauses = 0
    for words in clauses_of(low):
        clauses += 1
        symbols = [lex.symbol.get(w, OTHER) for w in words]
        if INSULT not in symbols and THREAT not in symbols:
            continue
        state, total, plain, threat = 0, 0.0, 0.0, 0.0
        for w, x in zip(words, symbols):
            state, factor = GRAMMAR.step[state][x]
            if x == INSULT:
                total += lex.weight[w] * factor
                plain += lex.weight[w]
            elif x == THREAT:
                threat += THREAT_WEIGHT * factor
        targeted = TARGET in symbols
        if total:
            total *= GRAMMAR.final[state]
            out[0] += total
            out[1] = max(out[1], total)
            out[2] += 1
            out[3] += targeted
            out[4] += total < plain
        out[5] += threat * GRAMMAR.final[state] if targeted else 0.0  # a threat needs someone to be threatened
    out[6] = out[2] / max(1, clauses)
    return [np.log1p(out[0]), out[1], np.log1p(out[2]), np.log1p(out[3]), np.log1p(out[4]), np.log1p(out[5]), out[6]]


def _presence(batches):
    """(word, toxic, fold, mark) once per text; near copies mostly share the mark."""
    for b in batches:
        rows: dict[tuple, None] = {}
        for text, toxic, fold in zip(*[c.to_pylist() for c in b.columns]):
            words = set(_WORD.findall((text or "").lower()))
            if words:
                mark = min(h64(w) for w in words) & 0xFFFFFFF
                rows.update(dict.fromkeys((w, toxic, fold, mark) for w in words))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
            (pa.string(), pa.int32(), pa.int32(), pa.int64()))], names=["word", "toxic", "fold", "mark"])


def _weights(rows, a_cols, b_cols, n_toxic: float, n_clean: float) -> dict[str, float]:
    """Insult weights: log odds of a toxic text, for words with enough evidence."""
    if not len(rows) or not n_toxic or not n_clean:
        return {}
    a, b = rows[a_cols].sum(axis=1).to_numpy(float), rows[b_cols].sum(axis=1).to_numpy(float)
    p, q = (a + 0.5) / (n_toxic + 1), (b + 0.5) / (n_clean + 1)
    weight = np.log(p / q)
    share = n_toxic / (n_toxic + n_clean)
    evidence = 2 * (a * np.log(np.maximum(a, 1e-9) / ((a + b) * share))
                    + b * np.log(np.maximum(b, 1e-9) / np.maximum((a + b) * (1 - share), 1e-9)))
    ok = (a >= LEAST_TEXTS) & (weight > 1.5) & (evidence >= LEAST_EVIDENCE)
    return dict(zip(rows["word"].to_numpy()[ok], np.minimum(weight[ok], WEIGHT_CAP).tolist()))


def _featured(lexicons):
    def run(batches):
        lex = [Lexicon(x) for x in lexicons.value]
        for b in batches:
            text, toxic, fold = (c.to_pylist() for c in b.columns)
            # Each fold is measured with the words learnt from the other one.
            yield pa.RecordBatch.from_arrays(
                [pa.array([features(t, lex[1 - f]) for t, f in zip(text, fold)], pa.list_(pa.float64())),
                 pa.array(toxic, pa.int32())], names=["x", "y"])
    return run


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last coefficient is the intercept."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    pen = np.r_[np.full(x.shape[1] - 1, ridge), 1e-3]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(pen)
        step = np.linalg.solve(h, x.T @ (p - y) + pen * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> dict:
    """Model from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``.

    About ``train_rows`` labelled ids, chosen by a hash, are learnt from. Rows
    with NULL id or label are left out; several labels of an id count as the largest.
    """
    spark = docs.sparkSession
    prepare(spark)
    lab = (same_or_new(labels, [("doc_id", "bigint"), ("toxic", "int")]).where("doc_id is not null and toxic is not null")
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = lab.count()
    place = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1 << 30))
    # About train_rows rows: small enough to be sent to every task.
    sample = lab.where(place < int(min(1.0, train_rows / max(1, n)) * (1 << 30))).cache()
    d = same_or_new(docs, [("doc_id", "bigint"), ("text", "string")])
    train = d.join(F.broadcast(sample), "doc_id").select(
        "text", F.col("toxic"), F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2)).cast("int").alias("fold"))
    seen = (train.mapInArrow(_presence, "word string, toxic int, fold int, mark bigint")
            .groupBy("word", "mark", "toxic", "fold").count())
    per_word = (seen.groupBy("word").agg(*[
        F.sum(F.when((F.col("toxic") == t) & (F.col("fold") == f), 1).otherwise(0)).alias(f"{'ba'[t]}{f}")
        for t in (0, 1) for f in (0, 1)]).where(f"a0 + a1 >= {LEAST_TEXTS} and a0 + a1 >= 0.1 * (b0 + b1)")
        .orderBy("word").toPandas())  # words of the sample, which train_rows bounds
    marks = Counter()
    for r in train.groupBy("toxic", "fold").count().collect():
        marks[r["toxic"], r["fold"]] += r["count"]
    t, c = [marks[1, f] for f in (0, 1)], [marks[0, f] for f in (0, 1)]
    halves = [_weights(per_word, [f"a{f}"], [f"b{f}"], t[f], c[f]) for f in (0, 1)]
    full = _weights(per_word, ["a0", "a1"], ["b0", "b1"], sum(t), sum(c))
    rows = train.mapInArrow(_featured(spark.sparkContext.broadcast(halves)), "x array<double>, y int").toPandas()
    sample.unpersist()
    if len(rows) and 0 < rows["y"].sum() < len(rows):
        coef = logistic(np.array(rows["x"].tolist()), rows["y"].to_numpy(float))
    else:
        coef = np.r_[np.ones(len(FEATURES)), -4.0]
    return {"insults": full, "coef": coef}


def _score(shared):
    def run(batches):
        lex, coef = Lexicon(shared.value["insults"]), shared.value["coef"]
        zero = 1 / (1 + np.exp(-coef[-1]))
        for b in batches:
            x = np.array([features(t, lex) for t in b.column(1).to_pylist()]).reshape(-1, len(FEATURES))
            s = np.where(x.any(axis=1), 1 / (1 + np.exp(-np.clip(x @ coef[:-1] + coef[-1], -30, 30))), zero)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], names=["doc_id", "score"])
    return run


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, score, predicted``: one row per input row, from the whole text alone.

    NULL, empty and wordless texts get the score of a text without any match. Equal texts
    get equal scores; NULL ids stay; extra columns are ignored.
    """
    prepare(docs.sparkSession)
    d = same_or_new(docs, [("doc_id", "bigint"), ("text", "string")])
    out = d.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model)), "doc_id bigint, score double")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def score_corpus(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labelled ids whose crc32 modulo 4 is not 2, score all rows."""
    model = fit(docs, labels.where(~held_out(F.col("doc_id"), 4, 2)))
    out = score(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted")
