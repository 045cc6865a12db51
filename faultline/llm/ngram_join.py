"""Operator 1: exact Jaccard join on word shingles with a token-group matrix.

1. Every text becomes its set of distinct 5-word shingles (64-bit hashes); equal
   sets collapse to one node.
2. A node can only link if enough of its shingles occur in another node too, so
   shingles are counted once over the whole corpus. They travel as packed
   numpy buffers (6 bytes each), not as rows, and those that sets of one batch share are combined before they do.
3. The nodes left are dealt into groups of similar sets by the minimum of a
   hash over the set; members of a group that reach the threshold with a
   leader of the group are linked at once. The leaders are dealt again, by the
   minima of several other hashes.
4. Token-group matrix: nodes of one component, or single nodes with the same most
   common prefix token, in chunks of bounded size, are a group whose row is the
   union of its members' tokens. A query meets the
   groups that share a prefix token with it (prefix filter: exact for every
   pair at the threshold, because two such sets share a token among the first
   ``n - ceil(t n) + 1`` of any common order). The bound
   ``|query & union| / |query|`` is computed first, and only a group that
   reaches the threshold is opened and compared member by member.

Tokens found in many components come last in the common order, the most common
ones at its very end, so a passage that many documents share hardly makes
candidates. Nothing is capped.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import distinct, give_back, h64, lean, mix64, prepare, same_or_new, stage, word_hashes
from faultline.llm.components import components
from faultline.session import broadcast_if_small

WORDS = 5
NUM, DEN = 75, 100  # similarity 0.75 as a fraction: links compare integers, no rounding
SALT_ROWS = 1000  # rows of one set that stay together in the last join
PART_TOKENS = 750_000  # about the shingles of a token partition (some 25 MB while they are counted)
FINGERPRINT = 5  # bytes of a set's identity while its tokens are counted
GROUP = 512  # about the most members of a group
HOT_GROUPS = 8  # a token in more components than this comes later in the order, the more the later
HOT_TABLE = 1_000_000  # most tokens of that kind sent to the executors (9 MB)
BROADCAST_IDS = 2_000_000  # most ids (16 MB) of a broadcast semi-join
BROADCAST_NODES = 500_000  # most rows (about 20 MB) of a table of nodes that goes to the sets instead of the sets to it

_MULT = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
# The first salt's minimum deals all nodes into groups, the others the leaders of those groups.
_SALTS = [np.uint64(0), *mix64(np.arange(1, 6, dtype=np.uint64) * _MULT[0])]
_KEYS = [f"k{i}" for i in range(len(_SALTS))]


def shingle_set(text: bytes | None, k: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; fewer than k words: one shingle of all."""
    h = word_hashes(text)
    if not len(h):
        return h
    if len(h) < k:
        return np.array([h64(h.tobytes(), 1)], np.uint64)
    s = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        s += h[i:len(h) - k + 1 + i] * (_MULT[i % 5] + np.uint64(2 * (i // 5)))
    return distinct(mix64(s))


def set_key(s: np.ndarray) -> int:
    """Signed 64-bit identity of a set."""
    return int(np.uint64(h64(s.tobytes())).astype(np.int64))


def _sets(batches):
    for b in batches:
        ids, texts = b.column(0), b.column(1).to_pylist()
        sets = [shingle_set(t) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([len(s) for s in sets], pa.int64()),
             pa.array([set_key(s) if len(s) else None for s in sets], pa.int64())],
            names=["doc_id", "n_shingles", "node"])


def _packed(parts: int):
    """Batch -> per token partition one row, and one row with the batch's nodes.

    A token is 4 bytes, its owner a 2-byte place among the batch's nodes; each owner's 5-byte fingerprint comes once a
    row, so that the same set met in two batches counts as one. A token that several sets of the batch hold
    is known to be shared: only two of its owners travel on (enough for others to see that it is shared), and
    what the rest would count is counted here. So a passage that very many documents hold is
    two entries a batch, however many hold it.
    """
    def run(batches):
        task, seq = TaskContext.get().partitionId(), 0
        for b in batches:
            seen: dict[int, np.ndarray] = {}
            for t in b.column(0).to_pylist():
                s = shingle_set(t)
                if len(s):
                    seen.setdefault(set_key(s), s)
            if not seen:
                continue
            nodes = np.fromiter(seen, np.int64, len(seen))
            sizes = np.array([len(s) for s in seen.values()], np.uint32)
            tok = np.concatenate(list(seen.values()))
            own = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)
            order = np.argsort(tok, kind="stable")  # owners of a token ascend
            tok, own = tok[order], own[order]
            first = np.r_[True, tok[1:] != tok[:-1]]
            last = np.r_[first[1:], True]
            inner = ~first & ~last
            here = np.bincount(own[inner], minlength=len(sizes)).astype(np.uint32)
            tok, own = tok[~inner], own[~inner]
            part = ((tok >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)  # ascends with the token
            low = (tok & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            cut = np.flatnonzero(np.diff(part)) + 1
            rows = {k: [] for k in ("p", "b", "tok", "idx", "own", "fp", "sizes", "nodes")}
            mark = nodes.view(np.uint8).reshape(-1, 8)[:, :FINGERPRINT]
            for s, e in zip(np.r_[0, cut], np.r_[cut, len(part)]):
                some, local = np.unique(own[s:e], return_inverse=True)
                for k, v in (("p", int(part[s])), ("b", task << 32 | seq), ("tok", low[s:e].tobytes()),
                             ("idx", local.astype(np.uint16).tobytes()), ("own", some.tobytes()),
                             ("fp", mark[some].tobytes()), ("sizes", None), ("nodes", None)):
                    rows[k].append(v)
            for k, v in (("p", -1), ("b", task << 32 | seq), ("tok", here.tobytes()), ("idx", None), ("own", None),
                         ("fp", None), ("sizes", sizes.tobytes()), ("nodes", nodes.tobytes())):
                rows[k].append(v)
            seq += 1
            yield pa.RecordBatch.from_pydict(rows, schema=_PACKED)
    return run


_PACKED = pa.schema([("p", pa.int32()), ("b", pa.int64()), *[(k, pa.binary()) for k in
                                                             ("tok", "idx", "own", "fp", "sizes", "nodes")]])
_PACKED_SQL = "p int, b bigint, tok binary, idx binary, own binary, fp binary, sizes binary, nodes binary"


def _shared_counts(key, pdf: pd.DataFrame) -> pd.DataFrame:
    """One token partition: per batch, how many tokens of each node occur in another node too."""
    owns = [np.frombuffer(x, np.uint16) for x in pdf["own"]]
    off = np.cumsum([0] + [len(x) for x in owns])
    mark = np.zeros((off[-1], 8), np.uint8)
    mark[:, :FINGERPRINT] = np.concatenate([np.frombuffer(x, np.uint8) for x in pdf["fp"]]).reshape(-1, FINGERPRINT)
    # The same node met in two batches is one document set, not two.
    _, ident = np.unique(mark.view(np.uint64).ravel(), return_inverse=True)
    del mark
    # Token and owner in one integer, sorted in place: an order and its copies would take four times the memory.
    both = np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["tok"]]).astype(np.uint64)
    both <<= np.uint64(32)
    at = 0
    for x, o in zip(pdf["idx"], off):
        x = np.frombuffer(x, np.uint16)
        both[at:at + len(x)] |= x + np.uint64(o)
        at += len(x)
    both.sort()
    own = both.astype(np.uint32)
    both >>= np.uint64(32)
    first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
    del both
    who = ident.astype(np.uint32)[own]
    shared = np.minimum.reduceat(who, first) != np.maximum.reduceat(who, first)
    del who
    shared = np.repeat(shared, np.diff(np.r_[first, len(own)]))
    cnt = np.bincount(own[shared], minlength=off[-1]).astype(np.uint32)
    out = []
    for i, (b, some) in enumerate(zip(pdf["b"], owns)):
        c = cnt[off[i]:off[i + 1]]
        k = c > 0
        if k.any():
            out.append((b, some[k].tobytes(), c[k].tobytes(), None, None))
    del own, shared, first
    give_back()
    return pd.DataFrame(out, columns=["b", "own", "cnt", "sizes", "nodes"])


def _counts(key, pdf: pd.DataFrame) -> pd.DataFrame:
    if key[0] >= 0:
        return _shared_counts(key, pdf)
    listed = pdf[["b", "own", "tok", "sizes", "nodes"]]  # a batch's own list: its counts stand in ``tok``
    return listed.rename(columns={"tok": "cnt"})


def _viable(key, pdf: pd.DataFrame) -> pd.DataFrame:
    """One batch: its nodes that have enough tokens in common with others."""
    is_list = pdf["nodes"].notna()
    listed = pdf[is_list].iloc[0]
    total = np.frombuffer(listed["cnt"], np.uint32).astype(np.int64)
    for own, cnt in zip(pdf["own"][~is_list], pdf["cnt"][~is_list]):
        total[np.frombuffer(own, np.uint16)] += np.frombuffer(cnt, np.uint32)
    sizes = np.frombuffer(listed["sizes"], np.uint32).astype(np.int64)
    return pd.DataFrame({"node": np.frombuffer(listed["nodes"], np.int64)[DEN * total >= NUM * sizes]})


def _token_rows(batches):
    for b in batches:
        sets = [shingle_set(t) for t in b.column(0).to_pylist()]
        sets = [s for s in sets if len(s)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([set_key(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([s.tobytes() for s in sets], pa.binary()),
             *[pa.array([int(mix64(s ^ x).min().astype(np.int64)) for s in sets], pa.int64()) for x in _SALTS]],
            names=["node", "n", "tok", *_KEYS])


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    i = np.searchsorted(b, a)
    i[i == len(b)] = len(b) - 1
    return int(np.count_nonzero(b[i] == a))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    n, m = len(a), len(b)
    if DEN * min(n, m) < NUM * max(n, m):
        return False
    o = overlap(a, b)
    return DEN * o >= NUM * (n + m - o)


def _leaders(key, pdf: pd.DataFrame) -> pd.DataFrame:
    """Within one bounded group: each node and the leader of its component of the group.

    A node that links to no leader leads itself; one that links to several joins their components.
    """
    pdf = pdf.sort_values("node")
    leaders: list[tuple[int, np.ndarray]] = []
    up: list[int] = []  # leader -> an earlier leader of its component
    to = []

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for node, tok in zip(pdf["node"], pdf["tok"]):
        t = np.frombuffer(tok, np.uint64)
        hits: set[int] = set()
        for i, (_, s) in enumerate(leaders):
            if top(i) not in hits and linked(t, s):
                hits.add(top(i))
        if not hits:
            leaders.append((node, t))
            up.append(len(up))
            hits = {len(up) - 1}
        first = min(hits)
        for i in hits:
            up[i] = first
        to.append(first)
    return pd.DataFrame({"node": pdf["node"].to_numpy(), "leader": [leaders[top(i)][0] for i in to]})


def _group_links(v: DataFrame, keys: list[str]) -> DataFrame:
    """(node, leader) over groups of equal ``keys``, large groups split into chunks of about GROUP."""
    sizes = v.groupBy(*keys).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    sizes = broadcast_if_small(stage(sizes, "sizes"), BROADCAST_NODES)  # so that rows of one key needn't meet to be dealt
    g = (v.select("node", "tok", *keys).join(sizes, keys)
         .withColumn("chunk", F.pmod(F.xxhash64("node", *keys), F.ceil(F.col("members") / GROUP))))
    return (g.select(*keys, "chunk", "node", "tok").groupBy(*keys, "chunk")
            .applyInPandas(_leaders, "node bigint, leader bigint"))


def _in_order(s: np.ndarray, late: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, bool]:
    """Prefix of a set in the order (how common, then hash), and whether it ends with a common token."""
    p = min(len(s), len(s) - -(-NUM * len(s) // DEN) + 1)
    if not len(late[0]):
        return s[:p], False
    tokens, level = late
    i = np.searchsorted(tokens, s)
    i[i == len(tokens)] = len(tokens) - 1
    how = np.where(tokens[i] == s, level[i], 0)
    order = np.argsort(how, kind="stable")[:p]
    return s[order], bool(how[order[-1]])


def _bases(hot):
    """(node, base): a single set with a common token in its prefix belongs to the most common one, others to their component."""
    def run(batches):
        for b in batches:
            base = b.column(3).to_pylist()
            for i, (blob, members) in enumerate(zip(b.column(2).to_pylist(), b.column(4).to_pylist())):
                if members == 1:
                    prefix, common = _in_order(np.frombuffer(blob, np.uint64), hot.value)
                    if common:
                        base[i] = int(prefix[-1].astype(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(base, pa.int64())], names=["node", "base"])
    return run


def _prefixes(hot):
    """The columns of a set but its tokens, once for each token ``t`` of its prefix (without an order: of the set)."""
    def run(batches):
        for b in batches:
            toks = [np.frombuffer(x, np.uint64) for x in b.column(2).to_pylist()]
            if hot is not None:
                toks = [_in_order(s, hot.value)[0] for s in toks]
            if not toks:
                continue
            take = pa.array(np.repeat(np.arange(len(toks)), [len(t) for t in toks]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(toks).astype(np.int64)), *(c.take(take) for i, c in enumerate(b.columns) if i != 2)],
                names=["t", *(n for i, n in enumerate(b.schema.names) if i != 2)])
    return run


_PREFIX_SQL = "t bigint, node bigint, n bigint, comp bigint, members bigint"


def _open_groups(key, queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
    """One group of the matrix: bound every query by the token union, open the group if it qualifies.

    The union's tokens stand with the members that hold them, so an opened group gives all
    overlaps of a query at once. A query gets one link to each component it links to.
    """
    out = []
    if len(queries) and len(members):
        sets = [np.frombuffer(t, np.uint64) for t in members["tok"]]
        names, comps = members["node"].to_numpy(), members["comp"].to_numpy()
        size = np.array([len(s) for s in sets])
        tok = np.concatenate(sets)
        order = np.argsort(tok, kind="stable")
        tok, owner = tok[order], np.repeat(np.arange(len(sets)), size)[order]
        for x, comp, t in zip(queries["node"], queries["comp"], queries["tok"]):
            q = np.frombuffer(t, np.uint64)
            low, high = np.searchsorted(tok, q, "left"), np.searchsorted(tok, q, "right")
            many = high - low
            if DEN * np.count_nonzero(many) < NUM * len(q):
                continue
            at = np.arange(many.sum()) + np.repeat(low - np.r_[0, np.cumsum(many)[:-1]], many)
            both = np.bincount(owner[at], minlength=len(sets))
            hit = np.flatnonzero((DEN * both >= NUM * (len(q) + size - both)) & (comps != comp))
            if len(hit):
                _, first = np.unique(comps[hit], return_index=True)
                out += [(x, y) for y in names[hit[first]].tolist()]
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _with_components(v: DataFrame, links: DataFrame) -> DataFrame:
    comp = components(links)
    named = (v.select("node").join(comp, "node", "left")
             .select("node", F.coalesce("component", "node").alias("comp")))
    sizes = named.groupBy("comp").agg(F.count(F.lit(1)).alias("members"))
    table = stage(named.join(sizes, "comp"), "named")
    return v.join(broadcast_if_small(table, BROADCAST_NODES), "node").select("node", "n", "tok", "comp", "members")


def _cross_links(v: DataFrame) -> DataFrame:
    """Links between different components of ``v(node, n, tok, comp, members)``: none is missed."""
    spark = v.sparkSession

    # Counted over whole sets: a token that no prefix by hash holds may enter one once others are moved to the end.
    cells = v.mapInArrow(lean(_prefixes(None)), _PREFIX_SQL).select("t", "comp").distinct()
    per_token = stage(cells.groupBy("t").agg(F.count(F.lit(1)).alias("groups")).where(f"groups > {HOT_GROUPS}"), "hot")
    limit = HOT_GROUPS
    while per_token.where(f"groups > {limit}").count() > HOT_TABLE:
        limit *= 2  # only the order of tokens depends on it, never which links are found
    late = per_token.where(f"groups > {limit}").toPandas()
    tokens, groups = late["t"].to_numpy(np.int64).astype(np.uint64), late["groups"].to_numpy(np.float64)
    by_hash = np.argsort(tokens)
    # Half octaves of how common a token is; below the limit all are alike.
    hot = spark.sparkContext.broadcast((tokens[by_hash], (2 * np.log2(groups[by_hash])).astype(np.uint8)))
    # Groups of the matrix: bases cut by a hash into chunks of about GROUP members.
    base = stage(v.mapInArrow(lean(_bases(hot)), "node bigint, base bigint"), "bases")
    place = (base.join(base.groupBy("base").agg(F.count(F.lit(1)).alias("held")), "base")
             .select("node", "held", F.xxhash64("base", F.pmod(F.xxhash64("node"), F.ceil(F.col("held") / GROUP))).alias("grp")))
    place = broadcast_if_small(stage(place, "places"), BROADCAST_NODES)
    v = stage(v.join(place, "node").select("node", "n", "tok", "comp", "members", "held", "grp"), "placed")
    post = v.mapInArrow(lean(_prefixes(hot)), _PREFIX_SQL + ", held bigint, grp bigint")
    cells = post.groupBy("t", "grp").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("held").alias("held"),
                                         F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    live = cells.groupBy("t").agg(F.min("c0").alias("c0"), F.max("c1").alias("c1")).where("c0 <> c1").select("t")
    q = post.join(live, "t", "left_semi").alias("q")
    c = cells.join(live, "t", "left_semi").alias("c")
    # Of two groups with a token in common, the smaller one's members ask the larger; members of one group ask it.
    cand = stage(
        q.join(c, F.col("q.t") == F.col("c.t"))
        .where("q.grp = c.grp or struct(q.held, q.grp) < struct(c.held, c.grp)")
        .where("c.c0 <> q.comp or c.c1 <> q.comp")
        .where(f"{NUM} * q.n <= {DEN} * c.high and {NUM} * c.low <= {DEN} * q.n")
        .select("q.node", F.col("c.grp").alias("grp")).distinct(), "candidates")
    wanted = cand.groupBy("grp").agg(F.count(F.lit(1)).alias("queries"))
    members = (v.join(wanted, "grp")
               .withColumn("lot", F.explode(F.expr("sequence(0L, cast(floor((queries - 1) / 4096) as bigint))"))))
    queries = (cand.join(wanted, "grp").withColumn("lot", F.pmod(F.xxhash64("node"), F.ceil(F.col("queries") / 4096)))
               .join(v.select("node", "comp", "tok"), "node"))

    def keyed(d):
        return (d.select(*[F.col(k).cast("bigint").alias(k) for k in ("grp", "lot", "node", "comp")],
                         F.col("tok").alias("tok")).groupBy("grp", "lot"))

    return keyed(queries).cogroup(keyed(members)).applyInPandas(_open_groups, "a bigint, b bigint")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per input row: ``doc_id, n_shingles, component_id``.

    NULL, empty and blank texts have an empty set, link with nothing and are
    their own component. Equal texts and repeated rows share a component. A row
    with NULL ``doc_id`` takes part in no link and gets NULL. Extra columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = same_or_new(docs, [("doc_id", "bigint"), ("text", "binary")])
    sets = stage(docs.mapInArrow(lean(_sets), "doc_id bigint, n_shingles bigint, node bigint"), "sets")
    known = docs.where("doc_id is not null and text is not null")
    tokens = sets.agg(F.sum("n_shingles")).first()[0] or 0
    parts = max(1, -(-tokens // PART_TOKENS))
    packed = known.select("text").mapInArrow(lean(_packed(parts)), _PACKED_SQL)
    # Rows of a token partition meet in one group; the lists of nodes (p = -1) go on by batch, past the groups.
    counts = packed.groupBy("p", F.when(F.col("p") < 0, F.col("b")).alias("alone")).applyInPandas(
        _counts, "b bigint, own binary, cnt binary, sizes binary, nodes binary")
    viable = stage(counts.groupBy("b").applyInPandas(_viable, "node bigint").distinct(), "viable")
    # One row per set, combined before it is shuffled: a set that a third of all rows share is no hot key from here on.
    nodes = stage(sets.where("node is not null and doc_id is not null").groupBy("node")
                  .agg(F.min("doc_id").alias("doc_id")), "nodes")
    chosen = stage(nodes.join(viable, "node", "left_semi").select("doc_id").distinct(), "chosen")
    picked = known.join(broadcast_if_small(chosen, BROADCAST_IDS), "doc_id", "left_semi")
    v = picked.select("text").mapInArrow(lean(_token_rows), "node bigint, n bigint, tok binary, " + ", ".join(f"{k} bigint" for k in _KEYS))
    # Ids are normally unique; only repeated ones can give a set twice, and only then are the sets shuffled.
    if sets.groupBy("doc_id").count().where("count > 1 and doc_id is not null").limit(1).count():
        v = v.dropDuplicates(["node"])
    v = stage(v, "tokens")
    near0 = stage(_group_links(v, _KEYS[:1]), "near")
    own = near0.where("node <> leader").select("node")
    # The leaders meet under several keys, so that copies of one text are one component before queries are made.
    again = v.join(own, "node", "left_anti").select("node", "tok", F.posexplode(F.array(*_KEYS[1:])).alias("salt", "key"))
    near1 = stage(_group_links(again, ["salt", "key"]), "near")
    links = near0.union(near1).select(F.col("node").alias("a"), F.col("leader").alias("b")).where("a <> b")
    grouped = stage(_with_components(v.select("node", "n", "tok"), links), "groups")
    cross = stage(_cross_links(grouped), "cross")
    # Components that are already known, as stars, plus the links between them.
    stars = grouped.where("node <> comp").select(F.col("node").alias("a"), F.col("comp").alias("b"))
    comp = components(stars.union(cross))
    low = nodes.join(comp, "node", "left").select("node", F.col("doc_id").alias("m"), F.coalesce("component", "node").alias("c"))
    ids = low.groupBy("c").agg(F.min("m").alias("component_id"))
    per_node = low.join(ids, "c").select("node", "component_id")
    return _named_rows(sets, per_node)


def _named_rows(sets: DataFrame, per_node: DataFrame) -> DataFrame:
    """Every row with the component of its set; sets that very many rows share are salted."""
    many = sets.where("node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("rows")).where(f"rows > {SALT_ROWS}")
    lots = broadcast_if_small(stage(many.select("node", F.ceil(F.col("rows") / SALT_ROWS).alias("lots")), "many"), BROADCAST_IDS)
    left = (sets.join(lots, "node", "left").withColumn("lot", F.when(F.col("lots") > 1, F.pmod(
        F.xxhash64("doc_id", F.monotonically_increasing_id()), F.col("lots"))).otherwise(0).cast("bigint")).drop("lots"))
    right = (per_node.join(lots, "node", "left").withColumn("lot", F.explode(F.expr("sequence(0L, coalesce(lots, 1L) - 1L)")))
             .drop("lots"))
    return (left.join(right, ["node", "lot"], "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("node").isNull() | F.col("doc_id").isNull(), F.col("doc_id"))
                    .otherwise(F.col("component_id")).alias("component_id")))
