"""Near-duplicate groups by SimHash fingerprints and sharded BK-trees.

A fingerprint is the majority vote of the shingles' hash bits. Two fingerprints
within ``RADIUS`` bits agree on at least ``KEEP`` of ``BLOCKS`` blocks of bits,
so every fingerprint goes to one shard for each choice of blocks (10 shards of
about 2^25 values); shards that hold one fingerprint are dropped. Each shard's
fingerprints form a BK-tree: children hang at their integer Hamming distance
to the parent, and a search follows only edges within the radius. Trees of many
shards are built and searched together, level by level, in arrays. What a task
finds is sent as one link per fingerprint to the least of its local group, never
as all pairs; the links' connected components are the groups.

Shards with more than ``SHARD`` fingerprints are hot. Up to ``HOT`` fingerprints
in all, their trees are broadcast and every fingerprint searches them where it
lies. (All trees cannot be: that would take every fingerprint through the
driver.) Beyond that hot shards are dealt again by a fourth of their other bits
at a time, of which a pair leaves one fourth alone; after ``LEVELS`` of this 16
bits are open, so a shard has 65,536 values at most, and one that still exceeds
``SHARD`` is split into trees of which each is sent the queries of those before.

Exact copies share a fingerprint and are one node however many there are.

``keep_one`` is the stage for training data: near duplicates are texts whose
sets of five-word shingles have a Jaccard similarity of 0.8 or more. Fingerprints
there have 128 bits, voted over distinct shingles as the sets are compared, and a
shard is the texts that share one of ``KEYS`` minimum shingle hashes. A pair is
compared in the shard of the first minimum it shares and nowhere else: by trees
within ``WIDE`` bits, and then on the sets of 64-bit shingle hashes, which are
sent to a shard only with texts that have such a neighbour there. First shards
of the first minima are cut into trees of ``TREE`` texts that are searched each
by itself, which joins the copies of one text at a cost in proportion to their
number. Then all shards whose members are still in different groups are searched
for pairs across groups. Hot ones are dealt again by a further minimum; where
that does not help, texts outside the shard's largest group visit all its trees.
A task holds one tree with its sets and sends stars, not pairs. A pair at
exactly 0.8 is missed with a probability of 0.2 ** KEYS (no common minimum;
3e-6), in a hot shard 8e-5 (one common minimum), and some 3e-6 (beyond WIDE).

Defined results: null or wordless text has fingerprint zero and is linked like
any other, and to ``keep_one`` all such texts are one; component_id is the
smallest non-null doc_id reachable (null if there is none); a repeated row is
returned as often as it occurs, by ``keep_one`` once; an empty table gives an
empty result; extra columns are ignored or kept, whatever their names. Ids are
integers or null. Texts are taken as equal by a 64-bit hash: among n texts
n^2 / 2^65 are expected to be taken for another (3 among 10^10).
"""

from __future__ import annotations

from itertools import combinations, islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytehash as bh
from . import shared as sh
from .components import components

RADIUS = 3
SHINGLE = 3
BLOCKS = 5
KEEP = BLOCKS - RADIUS
#: Fingerprints in one tree, at most about.
SHARD = 4096
#: Fingerprints of hot shards that are broadcast, at most.
HOT = 100_000
LEVELS = 3
_CHUNK = 1 << 16
SIMILAR, WORDS = 0.8, 5
KEYS, WIDE = 8, 44
#: Texts, with their sets, in one tree of the first search, at most about; afterwards SHARD.
TREE = 1024
#: Rows of a table of nodes up to which it is broadcast (16 bytes each).
FEW = 500_000
#: Minimum hashes whose shards are searched first, tree by tree.
FIRST = 2
_TURNS = np.array([pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) | 1 for k in range(KEYS)], np.uint64)


def shingle_hashes(text: bytes, size: int):
    """XXH64 of each shingle of the lower-cased words, repeats included, in arrays of bounded size."""
    from xxhash import xxh64_intdigest as digest

    words = text.lower().split()
    if not words:
        return
    n = max(1, len(words) - size + 1)
    shingles = map(b" ".join, zip(*(islice(words, k, None) for k in range(size)), strict=False)) if len(words) >= size else iter([b" ".join(words)])
    for at in range(0, n, _CHUNK):
        m = min(_CHUNK, n - at)
        yield np.fromiter((digest(s, 42) for s in islice(shingles, m)), np.dtype("<u8"), m)


def majority(hashes) -> int:
    """The bits that are set in over half of all hashes."""
    votes, n = np.zeros(64, np.int64), 0
    for h in hashes:
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for at in range(0, len(h), 255):  # what a byte can count
            votes += bits[at : at + 255].sum(axis=0, dtype=np.uint8)
        n += len(h)
    return sum(1 << k for k in np.flatnonzero(2 * votes > n).tolist())


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """SimHash of the shingles; 0 without words."""
    return majority(shingle_hashes(text, size))


def _prints(batches):
    import pyarrow as pa

    for b in batches:
        prints = [fingerprint(x.as_py() or b"") for x in b.column("body")]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.array(prints, np.uint64).view(np.int64), pa.int64())], ["doc_id", "fp"])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    own = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("body"))
    return own.mapInArrow(_prints, "doc_id long, fp long")


def _signed(masks: list[int]) -> list[int]:
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _masks() -> list[int]:
    edges = [64 * k // BLOCKS for k in range(BLOCKS + 1)]
    bits = [((1 << (z - a)) - 1) << a for a, z in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(bits, KEEP)]


def _deeper(mask: int) -> list[int]:
    """The mask with each of four parts of its other bits; a pair within the radius agrees on one part."""
    rest = [k for k in range(64) if not mask >> k & 1]
    parts = RADIUS + 1
    edges = [len(rest) * k // parts for k in range(parts + 1)]
    return [mask | sum(1 << k for k in rest[a:z]) for a, z in zip(edges, edges[1:], strict=False)]


class Forest:
    """BK-trees of several shards. values: (n, words of 64 bits), distinct within a shard; shards: from 0, all used."""

    def __init__(self, values: np.ndarray, shards: np.ndarray):
        self.values = values
        n = len(values)
        left, group = np.arange(n), shards.astype(np.int64)
        parents, distances, children = [], [], []
        above = None
        while len(left):
            _, first, inverse = np.unique(group, return_index=True, return_inverse=True)
            node = left[first]
            if above is None:
                self.roots = node
            else:
                parents.append(above[0][first])
                distances.append(above[1][first])
                children.append(node)
            mine = node[inverse]
            below = mine != left
            left, mine = left[below], mine[below]
            d = self._apart(values[left], values[mine])
            above = (mine, d)
            group = mine * 1024 + d
        whole = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        parents, distances, children = whole(parents), whole(distances), whole(children)
        order = np.argsort(parents, kind="stable")
        self.edges, self.children = distances[order], children[order]
        self.first = np.searchsorted(parents[order], np.arange(n + 1))

    @staticmethod
    def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)

    def near(self, queries: np.ndarray, shards: np.ndarray, radius: int, at_once: int = 512):
        """Pairs of arrays (query, value) within the radius; a query searches the tree of its shard."""
        for at in range(0, len(queries), at_once):
            q = np.arange(at, min(at + at_once, len(queries)))
            node = self.roots[shards[q]]
            while len(q):
                d = self._apart(queries[q], self.values[node])
                hit = d <= radius
                if hit.any():
                    yield q[hit], node[hit]
                m = self.first[node + 1] - self.first[node]
                of = np.repeat(np.arange(len(q)), m)
                edge = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + self.first[node][of]
                follow = np.abs(self.edges[edge] - d[of]) <= radius
                q, node = q[of[follow]], self.children[edge[follow]]


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The connected groups of the links a-b as links of each node to the least of its group."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    low = np.arange(len(nodes))
    while True:
        new, least = low.copy(), np.minimum(low[x], low[y])
        np.minimum.at(new, low[x], least)
        np.minimum.at(new, low[y], least)
        new = new[new]
        if (new == low).all():
            break
        low = new
    other = low != np.arange(len(nodes))
    return nodes[other], nodes[low[other]]


def _runs(batches, keys: list[str]):
    """Tables of whole runs of rows that agree on ``keys``, from rows sorted by them."""
    import pyarrow as pa

    held = []
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        last = [t.column(k)[-1] for k in keys]
        same = np.ones(t.num_rows, bool)
        for k, v in zip(keys, last, strict=True):
            same &= t.column(k).to_numpy() == v.as_py()
        open_ = int(np.argmax(same))  # the last run may go on
        if open_ == 0 and held and any(held[-1].column(k)[-1].as_py() != v.as_py() for k, v in zip(keys, last, strict=True)):
            yield pa.concat_tables(held).combine_chunks()
            held = []
        if open_:
            yield pa.concat_tables([*held, t.slice(0, open_)]).combine_chunks()
            held = []
        held.append(t.slice(open_))
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _shards(table, keys: list[str]):
    """The table without runs of ``keys`` that hold guests alone, each row's run from 0, and whether it is no guest."""
    new = np.zeros(table.num_rows, bool)
    for k in keys:
        v = table.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    run, own = np.cumsum(new), ~table.column("guest").to_numpy(zero_copy_only=False)
    held = np.zeros(run[-1] + 1, bool)
    held[run[own]] = True
    there = held[run]
    return table.filter(there), (np.cumsum(held) - 1)[run[there]], own[there]


def _links(batches):
    """Rows sorted by (choice, key, tree): a tree's own fingerprints and its guests."""
    import pyarrow as pa

    keys = ["choice", "key", "tree"]
    for t in _runs(batches, keys):
        t, shard, own = _shards(t, keys)
        fp = t.column("fp").to_numpy().view(np.uint64).reshape(-1, 1)
        forest = Forest(fp[own], shard[own])
        value = fp[own][:, 0]
        for q, v in forest.near(fp, shard, RADIUS):
            a, z = stars(fp[q, 0], value[v])
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, z)], ["a", "b"])


def _hot_links(handle, masks: list[int]):
    def run(batches):
        import pyarrow as pa

        choice, key, fp = handle.value  # sorted by choice and key
        new = np.r_[True, (choice[1:] != choice[:-1]) | (key[1:] != key[:-1])]
        forest = Forest(fp.reshape(-1, 1), np.cumsum(new) - 1)
        for b in batches:
            own, a, z = b.column("fp").to_numpy().view(np.uint64), [], []
            for c in np.unique(choice).tolist():
                here = np.flatnonzero(new & (choice == c))
                at = np.searchsorted(key[here], own & np.uint64(masks[c]))
                hit = np.flatnonzero(key[here][np.minimum(at, len(here) - 1)] == own & np.uint64(masks[c]))
                shard = (np.cumsum(new) - 1)[here[at[hit]]]
                for q, v in forest.near(own[hit].reshape(-1, 1), shard, RADIUS):
                    x, y = stars(own[hit][q], fp[v])
                    a.append(x)
                    z.append(y)
            if a:
                x, y = stars(np.concatenate(a), np.concatenate(z))
                yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)) for k in (x, y)], ["a", "b"])

    return run


def links(prints: DataFrame, shard: int = SHARD, hot: int = HOT, levels: int = LEVELS) -> DataFrame:
    """(a, b): links that join every group of the distinct fingerprints of (fp)."""
    spark, masks, out = prints.sparkSession, _masks(), []
    keyed = prints.select("fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in _signed(masks)))).alias("choice", "key"))
    for level in range(levels + 1):
        full = sh.cut(keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).where("n > 1"))
        over = full.where(F.col("n") > shard)
        n_hot = over.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        last = n_hot == 0 or level == levels
        whole = keyed.join(full if last and n_hot else full.where(F.col("n") <= shard), ["choice", "key"])
        trees = F.ceil(F.col("n") / F.lit(shard)).cast("int")
        rows = whole.withColumn("home", F.pmod(F.xxhash64("fp"), trees).cast("int"))
        # a fingerprint is a guest of the trees after its own
        rows = rows.select("choice", "key", "fp", "home", F.explode(F.sequence("home", trees - 1)).alias("tree")).withColumn("guest", F.col("tree") > F.col("home"))
        out.append(rows.repartition("choice", "key", "tree").sortWithinPartitions("choice", "key", "tree", "guest").mapInArrow(_links, "a long, b long"))
        if last:
            break
        members = keyed.join(over.select("choice", "key"), ["choice", "key"], "left_semi")
        if n_hot <= hot:
            at = members.orderBy("choice", "key", "fp").toPandas()  # at most ``hot`` rows
            key, fp = (at[c].to_numpy(np.int64).view(np.uint64) for c in ("key", "fp"))
            by = np.lexsort((fp, key, at["choice"].to_numpy()))
            handle = spark.sparkContext.broadcast((at["choice"].to_numpy()[by], key[by], fp[by]))
            out.append(members.select("fp").distinct().mapInArrow(_hot_links(handle, masks), "a long, b long"))
            break
        deeper = [m for mask in masks for m in _deeper(mask)]
        step = RADIUS + 1
        keyed = members.select("fp", F.explode(F.sequence(F.col("choice") * step, F.col("choice") * step + step - 1)).alias("choice"))
        keyed = keyed.withColumn("key", F.col("fp").bitwiseAND(F.element_at(F.array(*map(F.lit, _signed(deeper))), F.col("choice") + 1)))
        masks = deeper
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def groups(prints: DataFrame) -> DataFrame:
    """(fp, component_id) for each distinct fingerprint of (doc_id, fp)."""
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = components(links(nodes.select("fp")))
    named = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    return named.join(lows, "root").select("fp", "component_id")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``df``."""
    prints = sh.cut(fingerprints(df, id_col, text))
    named = prints.join(groups(prints), "fp")
    return named.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles."""
    hashes = list(shingle_hashes(text, WORDS))
    return np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)


def _sketches(batches):
    import pyarrow as pa

    for b in batches:
        sh.give_back()
        keys, prints, sizes = [], [], []
        for x in b.column("body"):
            own = shingle_set(x.as_py() or b"")
            keys.append([int((own * t).min().view(np.int64)) for t in _TURNS] if len(own) else [])
            prints.append([majority([own]), majority([bh.mix(own)])])
            sizes.append(len(own))
        fp = np.array(prints, np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(keys, pa.list_(pa.int64())), pa.array(fp[:, 0]), pa.array(fp[:, 1]), pa.array(sizes, pa.int64())], ["node", "keys", "fp", "fp2", "size"])


def _sets(batches):
    import pyarrow as pa

    for b in batches:
        sh.give_back()
        yield pa.RecordBatch.from_arrays([b.column("node"), pa.array([shingle_set(x.as_py() or b"").tobytes() for x in b.column("body")], pa.binary())], ["node", "shingles"])


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Jaccard similarity of sorted distinct values is ``SIMILAR`` or more."""
    few, many = (a, b) if len(a) <= len(b) else (b, a)
    if not len(few):
        return not len(many)
    both = int(np.count_nonzero(many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few))
    return both >= SIMILAR * (len(few) + len(many) - both)


def _few(df: DataFrame) -> DataFrame:
    """``df``, cut, to be broadcast if it has at most ``FEW`` rows."""
    df = sh.cut(df)
    return F.broadcast(df) if df.count() <= FEW else df


class _Texts:
    """The texts of several trees, and the pairs that may link two groups."""

    def __init__(self, table):
        table, self.shard, own = _shards(table, ["shard", "tree"])
        self.table, self.own = table, np.flatnonzero(own)
        get = lambda c: table.column(c).to_numpy()
        self.node, self.root, self.size, self.path = get("node"), get("root"), get("size"), get("path")
        self.values = np.stack([get("fp").view(np.uint64), get("fp2").view(np.uint64)], axis=1)
        keys = table.column("keys").combine_chunks()
        self.keys = keys.flatten().to_numpy().reshape(-1, KEYS)
        # texts of one fingerprint are one place in the tree
        places, at = np.unique(np.column_stack([self.shard[self.own].astype(np.uint64), self.values[self.own]]), axis=0, return_inverse=True)
        self.order, at = self.own[np.argsort(at, kind="stable")], np.sort(at)
        self.held = np.searchsorted(at, np.arange(len(places) + 1))
        self.forest = Forest(places[:, 1:], places[:, 0].astype(np.int64))

    def pairs(self):
        """Arrays of rows (one, other) in different groups whose first common minima are the shard's."""
        bit = np.int64(1) << np.arange(KEYS)
        for q, v in self.forest.near(self.values, self.shard, WIDE, 128):
            m = self.held[v + 1] - self.held[v]
            q = np.repeat(q, m)
            v = self.order[np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(self.held[v], m)]
            good = (self.root[q] != self.root[v]) & (np.minimum(self.size[q], self.size[v]) >= SIMILAR * np.maximum(self.size[q], self.size[v]))
            q, v = q[good], v[good]
            path = self.path[q]
            upto = (np.int64(1) << np.frexp(path.astype(float))[1].astype(np.int64)) - 1
            first = ((self.keys[q] == self.keys[v]) @ bit & upto) == path
            yield q[first], v[first]


def _with_neighbours(batches):
    """The rows that are in a pair, from rows sorted by (shard, tree, guest)."""
    for t in _runs(batches, ["shard", "tree"]):
        sh.give_back()
        texts = _Texts(t)
        paired = np.zeros(texts.table.num_rows, bool)
        for q, v in texts.pairs():
            paired[q] = paired[v] = True
        yield from texts.table.filter(paired).to_batches()


def _verified(batches):
    """Links of each text to the least of its group in the tree, from rows with their sets."""
    import pyarrow as pa

    for t in _runs(batches, ["shard", "tree"]):
        sh.give_back()
        texts, up, a, z = _Texts(t), {}, [], []
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in texts.table.column("shingles")]

        def root(x, up=up):
            while (y := up.get(x, x)) != x:
                up[x] = up.get(y, y)
                x = y
            return x

        for q, v in texts.pairs():
            for i, j, x, y in zip(q.tolist(), v.tolist(), texts.root[q].tolist(), texts.root[v].tolist(), strict=True):
                x, y = root(x), root(y)
                if x != y and similar(sets[i], sets[j]):
                    up[max(x, y)] = min(x, y)
                    a.append(i)
                    z.append(j)
        yield pa.RecordBatch.from_arrays([pa.array(texts.node[np.array(x, np.int64)]) for x in (a, z)], ["a", "b"])


_ROW = "shard long, tree int, guest boolean, node long, root long, fp long, fp2 long, size long, keys array<long>, path long"


def _searched(texts: DataFrame, own: DataFrame, rows: DataFrame) -> DataFrame:
    """(a, b): verified links across groups among the trees of ``rows``. own: the (node, id) that stands for each node."""
    columns = [c.split()[0] for c in _ROW.split(", ")]
    trees = lambda d: d.repartition("shard", "tree").sortWithinPartitions("shard", "tree", "guest")
    near = sh.cut(trees(rows.select(*columns)).mapInArrow(_with_neighbours, _ROW))
    wanted = _few(own.join(near.select("node").distinct(), "node", "left_semi").select(F.col("node").alias("own"), F.col("id").alias("own_id")))
    # by id too, so that the copies of one text are not dealt to one task
    bodies = texts.join(wanted, (F.col("node") == F.col("own")) & F.col("id").eqNullSafe(F.col("own_id")), "left_semi")
    sets = bodies.mapInArrow(_sets, "node long, shingles binary").dropDuplicates(["node"])
    return trees(near.join(sets, "node")).mapInArrow(_verified, "a long, b long")


def _keyed(small: DataFrame, roots: DataFrame | None) -> DataFrame:
    """A row for each node and minimum hash, with the node's group."""
    group = small.withColumn("root", F.col("node")) if roots is None else small.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    out = group.select("node", "root", "fp", "fp2", "size", "keys", F.posexplode("keys").alias("choice", "key"))
    return out.withColumn("shard", F.xxhash64("choice", "key")).withColumn("path", F.call_function("shiftleft", F.lit(1).cast("long"), F.col("choice")))


def _mixed(rows: DataFrame) -> DataFrame:
    """(shard, n): shards with members of different groups; few are broadcast, so that the rows stay where they are."""
    return _few(rows.groupBy("shard").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("shard", "n"))


def first_rows(small: DataFrame, shard: int) -> DataFrame:
    """Shards of the first minima, cut into trees without guests."""
    rows = _keyed(small, None).where(F.col("choice") < FIRST)
    tree = F.pmod(F.xxhash64("node", "choice"), F.ceil(F.col("n") / F.lit(shard))).cast("int")
    return rows.join(_mixed(rows), "shard").withColumns({"tree": tree, "guest": F.lit(False)})


def rest_rows(small: DataFrame, roots: DataFrame, shard: int, levels: int = 2) -> DataFrame:
    """Trees of all shards whose members are in different groups."""
    rows, out = _keyed(small, roots), []
    for level in range(levels):
        full = _mixed(rows)
        over = full.where(F.col("n") > shard)
        out.append(rows.join(full.where(F.col("n") <= shard), "shard").withColumns({"tree": F.lit(0), "guest": F.lit(False)}))
        if over.isEmpty():
            break
        hot = rows.join(over, "shard")
        if level == levels - 1:
            main = hot.groupBy("shard", "root").agg(F.count("*").alias("m")).groupBy("shard").agg(F.max_by("root", "m").alias("main"))
            n = F.ceil(F.col("n") / F.lit(shard)).cast("int")
            hot = hot.join(main, "shard").withColumn("home", F.pmod(F.xxhash64("node"), n).cast("int"))
            tree = F.explode(F.when(F.col("root") == F.col("main"), F.array("home")).otherwise(F.sequence(F.lit(0), n - 1))).alias("tree")
            out.append(hot.select("*", tree).withColumn("guest", F.col("tree") != F.col("home")))
            break
        # a pair that shares more minima meets in the shard of the first ones
        again = F.posexplode("keys").alias("choice", "key")
        rows = hot.select("node", "root", "fp", "fp2", "size", "keys", F.col("choice").alias("was"), F.col("shard").alias("old"), F.col("path").alias("before"), again).where("choice > was")
        path = F.col("before") + F.call_function("shiftleft", F.lit(1).cast("long"), F.col("choice"))
        rows = rows.withColumns({"shard": F.xxhash64("old", "choice", "key"), "path": path}).drop("was", "old", "before")
    columns = [c.split()[0] for c in _ROW.split(", ")]
    found = out[0].select(*columns)
    for more in out[1:]:
        found = found.unionByName(more.select(*columns))
    return found


def similar_groups(texts: DataFrame, tree: int = TREE, shard: int = SHARD) -> DataFrame:
    """(node, root) of the nodes of (node, id, body) that have a similar one; root is the least of the group."""
    small = sh.cut(texts.mapInArrow(_sketches, "node long, keys array<long>, fp long, fp2 long, size long").dropDuplicates(["node"]).where("size > 0"))
    own = sh.cut(texts.select("node", "id").groupBy("node").agg(F.min("id").alias("id")))
    found = sh.cut(_searched(texts, own, first_rows(small, tree)))
    sh.tidy(texts.sparkSession)
    more = _searched(texts, own, rest_rows(small, components(found), shard))
    return components(found.unionByName(more))


def keep_one(df: DataFrame, id_col: str = "doc_id", text: str = "text", tree: int = TREE, shard: int = SHARD) -> DataFrame:
    """``df`` with one row of each group of near duplicates: that of the smallest id (nulls last).

    Rows equal in id and text are one document, of which any row stays.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    name = sh.fresh("node", df.columns)
    node = F.xxhash64(F.when(body.rlike(r"[^\x20\x09-\x0D]"), body).otherwise(""))
    texts = df.select(node.alias("node"), F.col(id_col).cast("long").alias("id"), body.cast("binary").alias("body"))
    roots = similar_groups(texts, tree, shard)
    own = texts.groupBy("node", "id").agg(F.count("*").alias("n"))
    own = sh.cut(own.join(roots, "node", "left").select("node", "id", "n", F.coalesce("root", "node").alias("root")))
    best = own.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "node")).alias("best"))
    out = own.join(best, "root").where(~(F.col("best.node").eqNullSafe(F.col("node")) & F.col("best.id").eqNullSafe(F.col("id"))))
    gone = _few(out.select(F.col("node").alias("__own"), F.col("id").alias("__id")))
    same = lambda d: (d[name] == F.col("__own")) & F.col(id_col).cast("long").eqNullSafe(F.col("__id"))
    named = df.withColumn(name, node)
    kept = named.join(gone, same(named), "left_anti")
    twice = sh.cut(own.where("n > 1").select(F.col("node").alias("__own"), F.col("id").alias("__id")))
    if not twice.isEmpty():
        kept = kept.join(twice, same(kept), "left_anti").unionByName(kept.join(twice, same(kept), "left_semi").dropDuplicates([name, id_col]))
    return kept.select(*(F.col(f"`{c}`") for c in df.columns))


def op2_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: fingerprints of ``documents`` linked at 3 bits."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
