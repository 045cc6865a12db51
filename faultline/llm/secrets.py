"""Operator 5: secret scan with a random forest that removes false positives.

Patterns propose candidates in the whole text; a random forest (Spark ML) decides on each
by its length, character classes and entropy, character transitions, dictionary
coverage, the document's path and the words beside it. The forest is trained on labelled
findings; its trees are read back as arrays, so that every task decides where it
reads the text and no text is shuffled.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.byte_bpe import read_ranks, vocabulary_path
from faultline.llm.common import held, lean, prepare, same_or_new
from faultline.session import scratch_path

TRAIN_DOCS = 2000  # expected number of documents that labelled findings are drawn from
TREES, DEPTH, SEED = 24, 8, 5
THRESHOLD = 0.5
WINDOW = 48  # characters looked at on either side of a candidate
MARK = "[secret]"

_KEY = r"(?:token|secret|passw(?:or)?d|passwd|pwd|api_?key|access_?key|private_?key|credentials?|auth(?:orization)?|bearer)"
#: A secret's name up to its value, which starts at the end of the match.
_ASSIGNED = re.compile(_KEY + r"[\w.-]{0,20}[\"']?\s{0,3}(?::=|=>|[=:])\s{0,3}[\"'`]?(?=[^\s\"'`,;<>]{8})", re.I)
#: Such a value ends where the next parameter of a URL query or form starts.
_VALUE = re.compile(r"(?:[^\s\"'`,;<>&]|&(?![\w.%\[\]-]+=))+")
_RUN = re.compile(r"[A-Za-z0-9+/_=.\-]{16,}")
#: Prefixes by which issuers mark their keys (fixed values).
_PREFIXED = (r"AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}"
             r"|AIza[0-9A-Za-z_-]{35}|[sr]k_live_[0-9A-Za-z]{16,}")
_ISSUED = re.compile(_PREFIXED + r"|eyJ[\w-]{10,}\.[\w-]{10,}\.[\w-]*")
_PREFIXED_ANYWHERE = re.compile(_PREFIXED)
#: One of these is in every such key.
_PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xox", "AIza", "k_live_")
_JWT_PART = re.compile(r"[\w-]*")
_KEY_REST = re.compile(r"[A-Za-z0-9_-]*")
_PEM_BEGIN = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----")
_PEM_END = re.compile(r"-----END [A-Z ]*PRIVATE KEY-----")
#: What a path says about its file: made for tests or readers, or made to hold settings.
_EXAMPLE_PATH = re.compile(r"(?:^|[/._-])(?:tests?|examples?|samples?|docs?|mocks?|fixtures?|demos?|spec)(?:[/._-]|$)", re.I)
_CONFIG_PATH = re.compile(r"(?:^|[/.])(?:env|conf|config|cfg|ini|ya?ml|toml|properties|tfvars|pem|key|netrc|npmrc|pypirc|credentials)(?:\.\w+)?$", re.I)
_SECRET_WORD = re.compile(_KEY, re.I)
_PLAIN_WORD = re.compile(r"\b(?:sha\d*|md5|hash|checksum|commit|digest|uuid|guid|id|example|placeholder|test|card|mail|email|ip|version)\b", re.I)
_WORD = re.compile(r"[A-Za-z]{4,}")

FEATURES = ["length", "digits", "upper", "lower", "other", "hex", "entropy", "transitions", "dictionary", "issued",
            "secret_word", "plain_word", "assigned", "quoted", "at_sign", "dots", "repeats", "path_depth", "path_example", "path_config"]


def _key_blocks(text: str) -> list[tuple[int, int]]:
    """Key blocks from a first line to the next last line; first lines that no last line follows cost no search."""
    ends = [m.span() for m in _PEM_END.finditer(text)]
    out, at, k = [], 0, 0
    for m in _PEM_BEGIN.finditer(text):
        while k < len(ends) and ends[k][0] < m.end():
            k += 1
        if k == len(ends):
            break
        if m.start() >= at:
            at = ends[k][1]
            out.append((m.start(), at))
    return out


def _issued(text: str) -> list[tuple[int, int]]:
    """Issued keys wherever they stand, each with the key characters after it."""
    found = []
    if any(x in text for x in _PREFIXES):
        found = [m.span() for m in _PREFIXED_ANYWHERE.finditer(text)]
    at = text.find("eyJ")
    while at >= 0:  # the first "eyJ" of a part decides for all of the part
        end = _JWT_PART.match(text, at).end()
        m = _ISSUED.match(text, at) if text[end:end + 1] == "." else None
        if m:
            found.append(m.span())
            end = m.end()
        at = text.find("eyJ", end)
    out: list[tuple[int, int]] = []
    for s, e in sorted(found):
        if not out or s >= out[-1][1]:
            out.append((s, max(e, _KEY_REST.match(text, e).end())))
    return out


def _assigned(text: str) -> list[tuple[int, int]]:
    """Values given to a secret's name; one that holds a further name and value comes after that one."""
    out, end = [], 0
    for m in _ASSIGNED.finditer(text):
        if m.end() >= end:
            got = _VALUE.match(text, m.end())
            end = got.end() if got else m.end()
        out.append((m.end(), end))
    return out[::-1]


def _is_base64(s: str) -> bool:
    """Whether the '/' in a run are digits of base64: mixed characters and no word or digest between two of them."""
    parts = s.rstrip("=").split("/")
    if not re.fullmatch(r"[A-Za-z0-9+/]+={0,2}", s) or "" in parts[:-1]:
        return False
    mixed = lambda x: x.lower() != x != x.upper()
    return mixed(s) and all(p.lower() not in dictionary() and (len(p) < 16 or mixed(p)) for p in parts)


def _runs(text: str) -> list[tuple[int, int]]:
    """Runs of key characters, cut at '=' other than padding and at '/' other than in base64."""
    out = []
    for m in _RUN.finditer(text):
        for part in re.finditer(r"[^=]+(?:=+$)?", m.group()):
            s, at = part.group(), m.start() + part.start()
            if "/" not in s or _is_base64(s):
                out.append((at, at + len(s)))
            else:
                out += [(at + p.start(), at + p.end()) for p in re.finditer(r"[^/]+", s)]
    return out


def candidates(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every candidate, in text order, none inside another.

    Key blocks come first, then issued keys wherever they stand, assigned values and plain runs;
    what an earlier kind leaves of a later one is a candidate if it is long enough.
    """
    if not text:
        return []
    taken: list[tuple[int, int, str]] = []

    def add(kind, spans, least):
        free, k = [], 0
        for s, e in sorted(spans):
            while k < len(taken) and taken[k][1] <= s:
                k += 1
            i, at = k, s
            while i < len(taken) and taken[i][0] < e:
                free.append((at, taken[i][0]))
                at = max(at, taken[i][1])
                i += 1
            free.append((at, e))
        for s, e in free:
            if kind == "run" and e > s and text[e - 1] in ".-":
                e = s + len(text[s:e].rstrip(".=-"))
            if e - s >= least and (kind != "run" or any(c.isdigit() for c in text[s:e])):
                taken.append((s, e, kind))
        taken.sort()

    if "-----BEGIN" in text:
        add("key block", _key_blocks(text), 1)
    add("issued", _issued(text), 15)
    inner = None
    spans = []
    for s, e in _assigned(text):  # from the right: an outer value ends where the inner one starts
        spans.append((s, min(e, inner) if inner is not None else e))
        inner = s
    add("assigned", spans, 8)
    add("run", _runs(text), 16)
    return taken


def dictionary(path: str | None = None) -> frozenset:
    """Words of at least four letters in a public vocabulary, lower-cased; a worker holds them while it scans."""
    def build():
        words = (t.strip().lower() for t in read_ranks(path or vocabulary_path()))
        return frozenset(w.decode() for w in words if len(w) >= 4 and w.isalpha() and w.isascii())
    return held("dictionary", path, build)


def coverage(s: str, words: frozenset) -> float:
    """Share of the characters that dictionary words cover, longest first from the left."""
    low, i, hit = s.lower(), 0, 0
    while i < len(low):
        for n in range(min(12, len(low) - i), 3, -1):
            if low[i:i + n] in words:
                hit += n
                i += n
                break
        else:
            i += 1
    return hit / max(1, len(low))


def _char(c: str) -> int:
    return ord(c) - 97 if "a" <= c <= "z" else 26 if c.isdigit() else 27


def transitions_of(words) -> np.ndarray:
    """Log-probabilities of one character after another (a-z, digit, other) in ordinary words."""
    n = np.ones((28, 28))
    for w in words:
        codes = [_char(c) for c in w.lower()]
        for a, b in zip(codes, codes[1:]):
            n[a, b] += 1
    return np.log(n / n.sum(axis=1, keepdims=True))


def features(cand: str, before: str, after: str, path: str | None, table: np.ndarray, words: frozenset) -> list[float]:
    n = len(cand)
    count: dict[str, int] = {}
    for c in cand:
        count[c] = count.get(c, 0) + 1
    digits = sum(k for c, k in count.items() if c.isdigit())
    upper = sum(k for c, k in count.items() if c.isupper())
    lower = sum(k for c, k in count.items() if c.islower())
    hexes = sum(k for c, k in count.items() if c in "0123456789abcdefABCDEF")
    codes = [_char(c) for c in cand.lower()]
    near = before[-24:]
    return [float(n), digits / n, upper / n, lower / n, (n - digits - upper - lower) / n, hexes / n,
            -sum(k / n * math.log2(k / n) for k in count.values()),
            float(table[codes[:-1], codes[1:]].mean()) if n > 1 else 0.0, coverage(cand, words),
            float(bool(_ISSUED.match(cand)) or cand.startswith("-----BEGIN")),
            float(bool(_SECRET_WORD.search(near))), float(bool(_PLAIN_WORD.search(near))),
            float(before.rstrip(" \"'`\t")[-1:] in ("=", ":", ">") and bool(before)), float(before[-1:] in "\"'`" and bool(before) and after[:1] in "\"'`" and bool(after)),
            float("@" in cand or after[:1] == "@"), cand.count(".") / n, 1.0 - len(count) / n,
            float((path or "").count("/")), float(bool(_EXAMPLE_PATH.search(path or ""))), float(bool(_CONFIG_PATH.search(path or "")))]


def _row(text: str, s: int, e: int, path, table, words) -> list[float]:
    return features(text[s:e], text[max(0, s - WINDOW):s], text[e:e + WINDOW], path, table, words)


def _made_up(seed: str, n: int, alphabet: str) -> str:
    """A string that looks drawn at random, the same for the same seed."""
    out, k = "", 0
    while len(out) < n:
        out += "".join(alphabet[b % len(alphabet)] for b in hashlib.sha256(f"{seed}/{k}".encode()).digest())
        k += 1
    return out[:n]


_BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


#: Prefix, alphabet and size of made-up issued keys.
_MADE_UP_ISSUED = (("AKIA", _BASE64[:26] + "0123456789", 16), ("ghp_", _BASE64[:62], 36),
                   ("xoxb-", "0123456789", 24), ("sk_live_", _BASE64[:62], 24))


def labelled(text: str, path: str | None) -> list[tuple[str, str, str, str | None, float]]:
    """Labelled findings (candidate, before, after, path, label) that one document gives.

    Its own candidates are labelled by where they stand: assigned to a secret's name and not made
    of words, or with an issuer's prefix - a secret; any other run - none. Contrasts share
    one of the two: a made-up key in the same place, a plain word as the value, and a
    made-up digest without a secret's name. The forest must weigh value and place together.
    A made-up key with an issuer's prefix is a secret in any place.
    """
    words, out = dictionary(), []
    for s, e, kind in candidates(text):
        cand, before, after = text[s:e], text[max(0, s - WINDOW):s], text[e:e + WINDOW]
        f = features(cand, before, after, path, np.zeros((28, 28)), words)
        sound = f[6] >= 3.0 and f[8] < 0.5
        out.append((cand, before, after, path, float((kind in ("issued", "key block")) or (kind == "assigned" and sound))))
    plain = _WORD.findall(text)
    if plain:
        seed = hashlib.sha256(text.encode()).hexdigest()
        k = int(seed[:8], 16)
        word, name = plain[k % len(plain)], ("token", "api_key", "password", "secret", "access_key")[k % 5]
        sep, quote = (" = ", ": ", "=", " := ")[k % 4], ('"', "'", "")[k % 3]
        size = (20, 24, 32, 40, 64)[k // 7 % 5]
        key = _made_up(seed, size, "0123456789abcdef" if k % 2 else _BASE64)
        before, after = f"{word} {name}{sep}{quote}", f"{quote} {word}"
        out.append((key, before, after, path, 1.0))
        out.append(((word * 4)[:max(8, size // 2)], before, after, path, 0.0))
        out.append((f"{word}-{plain[k // 3 % len(plain)]}", before, after, path, 0.0))
        out.append((f"https://{plain[k // 3 % len(plain)]}.com/{word}?{name}=", before, after, path, 0.0))  # an address, up to its value
        out.append((_made_up(seed + "d", 40, "0123456789abcdef"), f"{word} {('commit', 'sha256', 'checksum')[k % 3]} ", f" {word}", path, 0.0))
        out.append((_made_up(seed + "e", 40, "0123456789abcdef"), f"{word} {('commit', 'sha256', 'checksum')[k % 3]}=", f" {word}", path, 0.0))
        prefix, alphabet, size = _MADE_UP_ISSUED[k // 11 % len(_MADE_UP_ISSUED)]
        place = (f"{word} ", f"https://{word}.com/", f"{word}=", f"{word} {word}", f"{word}?{name}=", f'{word}: "')[k // 13 % 6]
        out.append((prefix + _made_up(seed + "i", size, alphabet), place, f" {word}", path, 1.0))
        out.append((_made_up(seed + "n", 16, "0123456789"), f"{word} ", f" {word}", path, 0.0))
    return out


_FINDING = "candidate string, before string, after string, path string, label double"


def _draw(batches):
    for b in batches:
        rows = [r for t, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if t for r in labelled(t, p)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(4)]
                                         + [pa.array([r[4] for r in rows], pa.float64())],
                                         names=["candidate", "before", "after", "path", "label"])


def findings_from(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Labelled findings of about ``train_docs`` documents, chosen by a hash of the id."""
    prepare(docs.sparkSession)
    d = same_or_new(docs, [("doc_id", "bigint"), ("text", "string"), ("source", "string")])
    n = max(1, d.count())
    place = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30))
    return (d.where(F.coalesce(place < int(min(1.0, train_docs / n) * (1 << 30)), F.lit(False)))
            .select("text", "source").mapInArrow(_draw, _FINDING))


def fit(findings: DataFrame) -> dict:
    """Forest from ``findings(candidate, before, after, path, label)``; its size bounds the driver's work.

    Without findings of both labels, the model confirms issued keys only.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector
    spark = findings.sparkSession
    rows = sorted(map(tuple, findings.where("candidate is not null and candidate <> '' and label is not null").collect()),
                  key=lambda r: tuple(map(str, r)))
    table = transitions_of(w for r in rows for w in _WORD.findall(f"{r[1]} {r[2]}"))
    model = {"table": table, "trees": []}
    if len({r[4] for r in rows}) < 2:
        return model
    words = dictionary()
    data = spark.createDataFrame([(features(*[x or "" for x in r[:3]], r[3], table, words), r[4]) for r in rows],
                                 "x array<double>, label double")
    # One partition in a fixed order: the same findings always grow the same forest.
    data = data.coalesce(1).select(array_to_vector("x").alias("features"), "label")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt",
                                    minInstancesPerNode=2).fit(data)
    path = scratch_path(spark, f"forest-{uuid.uuid4().hex[:12]}")
    forest.save(path)
    trees: dict[int, list] = {}
    for r in spark.read.parquet(path + "/data").collect():  # at most TREES * 2 ** (DEPTH + 1) nodes
        trees.setdefault(r["treeID"], []).append(r["nodeData"])
    for _, nodes in sorted(trees.items()):
        nodes.sort(key=lambda n: n["id"])
        model["trees"].append({
            "feature": np.array([n["split"]["featureIndex"] if n["leftChild"] >= 0 else -1 for n in nodes]),
            "cut": np.array([n["split"]["leftCategoriesOrThreshold"][0] if n["leftChild"] >= 0 else 0.0 for n in nodes]),
            "left": np.array([n["leftChild"] for n in nodes]), "right": np.array([n["rightChild"] for n in nodes]),
            "share": np.array([n["impurityStats"][1] / max(1e-12, sum(n["impurityStats"])) for n in nodes])})
    return model


def probability(x: np.ndarray, model: dict) -> np.ndarray:
    """Mean share of secrets in the leaves that each row falls into."""
    if not model["trees"]:
        return x[:, FEATURES.index("issued")].copy()
    total = np.zeros(len(x))
    for t in model["trees"]:
        at = np.zeros(len(x), np.int64)
        while True:
            f = t["feature"][at]
            go = np.flatnonzero(f >= 0)
            if not len(go):
                break
            left = x[go, f[go]] <= t["cut"][at[go]]
            at[go] = np.where(left, t["left"][at[go]], t["right"][at[go]])
        total += t["share"][at]
    return total / len(model["trees"])


def _judge(texts, paths, model):
    """Per text, (start, end, kind, probability) of its candidates."""
    words, rows, cands = dictionary(), [], []
    for t, p in zip(texts, paths):
        c = candidates(t)
        cands.append(c)
        rows += [_row(t, s, e, p, model["table"], words) for s, e, _ in c]
    prob = probability(np.array(rows), model) if rows else []
    at, out = 0, []
    for c in cands:
        out.append([(s, e, k, float(prob[at + i])) for i, (s, e, k) in enumerate(c)])
        at += len(c)
    return out


_FOUND = "doc_id bigint, start bigint, end bigint, kind string, secret_sha256 string, probability double, confirmed boolean"


def _scan(shared):
    def run(batches):
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            rows = [(i, s, e, k, hashlib.sha256(t[s:e].encode()).hexdigest(), p, p >= THRESHOLD)
                    for i, t, got in zip(ids, texts, _judge(texts, b.column(2).to_pylist(), shared.value)) for s, e, k, p in got]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                             names=["doc_id", "start", "end", "kind", "secret_sha256", "probability", "confirmed"])
    return run


def scan(docs: DataFrame, model: dict) -> DataFrame:
    """``docs(doc_id, text, source)`` -> one row per candidate, with its span, digest and probability.

    NULL and empty texts have none. Repeated rows report their findings again; NULL ids and paths
    are allowed; extra columns are ignored. The secret itself is never returned.
    """
    prepare(docs.sparkSession)
    d = same_or_new(docs, [("doc_id", "bigint"), ("text", "string"), ("source", "string")])
    return d.mapInArrow(lean(_scan(docs.sparkSession.sparkContext.broadcast(model))), _FOUND)


def _redact(shared, text_at, path_at, chars_at):
    def run(batches):
        for b in batches:
            texts = b.column(text_at).to_pylist()
            paths = b.column(path_at).to_pylist() if path_at is not None else [None] * len(texts)
            changed = {}
            for i, got in enumerate(_judge(texts, paths, shared.value)):
                spans = [(s, e) for s, e, _, p in got if p >= THRESHOLD]
                if spans:
                    parts, at = [], 0
                    for s, e in spans:
                        parts += [texts[i][at:s], MARK]
                        at = e
                    changed[i] = "".join(parts) + texts[i][at:]
            cols = list(b.columns)
            if changed:
                cols[text_at] = pa.array([changed.get(i, t) for i, t in enumerate(texts)], b.schema.field(text_at).type)
                if chars_at is not None:
                    n = b.column(chars_at).to_pylist()
                    cols[chars_at] = pa.array([len(changed[i]) if i in changed else x for i, x in enumerate(n)],
                                              b.schema.field(chars_at).type)
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)
    return run


def redact(docs: DataFrame, model: dict) -> DataFrame:
    """All rows and columns of ``docs``; confirmed secrets in ``text`` become ``[secret]``.

    ``n_chars``, where there is one, follows the new text. Other rows are unchanged.
    """
    prepare(docs.sparkSession)
    names = docs.columns
    low = [n.lower() for n in names]
    tagged = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = [low.index(n) if n in low else None for n in ("text", "source", "n_chars")]
    out = tagged.mapInArrow(lean(_redact(docs.sparkSession.sparkContext.broadcast(model), *at)), tagged.schema)
    return out.toDF(*names)
