"""Embedding near-duplicates by navigable small-world graphs per shard.

Equal vectors of a label are one node with a count. A label's nodes are dealt
by hash to shards of bounded size, and a hierarchical graph of each is built
once. Every pair of shards is one task, which searches either graph with every
node of the other (one shard alone: with its own nodes). A query descends greedily, then
follows a beam that stays open as long as it meets vectors near the threshold.
A shard audits itself against brute force and widens its beam until the audit
passes; if the widest beam fails, it compares all. Every hit is verified by its
cosine in double precision and counts for both ends, whichever found the other.

A task reports, per node, the weight of its links and one edge into a local
union of what it linked, so pairs never leave a task; edges are united across
tasks by connected components.
"""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civora.llm.common import partitions, shared_table
from civora.llm.graph import components

THRESHOLD = 0.98
SHARD = 20_000
LINKS, BASE_LINKS, BUILD_BEAM = 10, 20, 40
BEAM, WIDEST, AUDIT, RECALL = 24, 400, 48, 0.96


class Graph:
    """Hierarchical navigable small world over unit vectors (rows of x)."""

    def __init__(self, x: np.ndarray, seed: int = 1):
        self.x = x
        n = len(x)
        u = np.random.default_rng(seed).random(n)
        self.level = np.floor(-np.log(1 - u) / np.log(LINKS)).astype(int)
        self.near: list[dict[int, list[int]]] = [{} for _ in range(int(self.level.max(initial=0)) + 1)]
        self.entry = -1
        for i in range(n):
            self._insert(i)

    def search(self, q: np.ndarray, start: list[int], beam: int, layer: int, reach: float = 2.0) -> list[tuple[float, int]]:
        """Best ``beam`` nodes, and all met whose similarity is at least ``reach``; best first."""
        x, near = self.x, self.near[layer]
        seen = set(start)
        todo = [(-s, i) for s, i in zip((x[start] @ q).tolist(), start)]
        best = [(-s, i) for s, i in todo]
        heapq.heapify(todo)
        heapq.heapify(best)
        more = []
        while todo:
            s, i = heapq.heappop(todo)
            if len(best) >= beam and -s < best[0][0] and -s < reach:
                break
            new = [j for j in near[i] if j not in seen]
            if not new:
                continue
            seen.update(new)
            for t, j in zip((x[new] @ q).tolist(), new):
                if len(best) < beam:
                    heapq.heappush(best, (t, j))
                elif t > best[0][0]:
                    out = heapq.heapreplace(best, (t, j))
                    if out[0] >= reach:
                        more.append(out)
                elif t >= reach:
                    more.append((t, j))
                else:
                    continue
                heapq.heappush(todo, (-t, j))
        return sorted(best + more, reverse=True)

    def _choose(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Near nodes that are nearer to the new one than to those chosen, then the nearest others."""
        ids = [i for _, i in found]
        sims = self.x[ids] @ self.x[ids].T
        picked: list[int] = []
        for k, (s, _) in enumerate(found):
            if len(picked) >= most:
                break
            if not picked or sims[k, picked].max() < s:
                picked.append(k)
        rest = (k for k in range(len(ids)) if k not in picked)
        while len(picked) < min(most, len(ids)):
            picked.append(next(rest))
        return [ids[k] for k in picked]

    def _insert(self, i: int) -> None:
        top = int(self.level[i])
        for layer in range(top + 1):
            self.near[layer][i] = []
        if self.entry < 0:
            self.entry = i
            return
        q, at = self.x[i], [self.entry]
        high = int(self.level[self.entry])
        for layer in range(high, top, -1):
            at = [self.search(q, at, 1, layer)[0][1]]
        for layer in range(min(top, high), -1, -1):
            found = self.search(q, at, BUILD_BEAM, layer)
            most = BASE_LINKS if layer == 0 else LINKS
            near = self.near[layer]
            near[i] = self._choose(found, LINKS)
            for j in near[i]:
                near[j].append(i)
                if len(near[j]) > most:
                    sims = (self.x[near[j]] @ self.x[j]).tolist()
                    near[j] = self._choose(sorted(zip(sims, near[j]), reverse=True), most * 3 // 4)
            at = [j for _, j in found]
        if top > high:
            self.entry = i

    def within(self, q: np.ndarray, threshold: float, beam: int, known: tuple | list = ()) -> list[int]:
        """Nodes found with similarity of at least ``threshold``, from the entry and from ``known`` ones."""
        at = [self.entry]
        for layer in range(int(self.level[self.entry]), 0, -1):
            at = [self.search(q, at, 1, layer)[0][1]]
        return [j for s, j in self.search(q, list({*at, *known}), beam, 0, threshold - 0.01) if s >= threshold]


class Shard:
    """A graph whose beam passed an audit against brute force, or brute force itself.

    Audited are every node's way to itself and the mean recall per node of its
    partners, apart for nodes with few, some and many of them, so that a large
    cluster cannot hide missed small groups. Nodes that do not find themselves
    are compared with every query, which also starts from those it is near to.
    """

    def __init__(self, x: np.ndarray, threshold: float):
        self.x, self.threshold, self.graph, self.beam, self.recall, self.lost = x, threshold, None, 0, 1.0, []
        if len(x) <= 2 * BEAM:
            return
        graph = Graph(x)
        classes = self._sample()
        beam = BEAM
        while beam <= WIDEST:
            self.lost = [i for i in range(len(x)) if i not in graph.within(x[i], threshold, beam)]
            self.graph, self.beam = graph, beam
            self.recall = min([1.0, *(np.mean([len(np.intersect1d(self.within(x[i]), t)) / len(t) for i, t in c]) for c in classes if c)])
            if self.recall >= RECALL:
                return
            beam *= 2
        self.graph, self.lost = None, []

    def _sample(self) -> list[list[tuple[int, np.ndarray]]]:
        """Nodes drawn at random with their true partners, by number of partners."""
        most = max(AUDIT, len(self.x) // 50)
        classes: list[list[tuple[int, np.ndarray]]] = [[], [], []]
        order = np.random.default_rng(2).permutation(len(self.x))
        for at in range(0, len(order), 256):
            some = order[at:at + 256]
            for i, near in zip(some, self.x[some] @ self.x.T >= self.threshold):
                near[i] = False
                n = int(near.sum())
                c = classes[0 if n <= 8 else 1 if n <= 64 else 2]
                if n and len(c) < most:
                    c.append((i, np.flatnonzero(near)))
            if all(len(c) >= most for c in classes):
                break
        return classes

    def within(self, q: np.ndarray) -> list[int]:
        if self.graph is None:
            return np.flatnonzero(self.x @ q >= self.threshold).tolist()
        known = [i for i, s in zip(self.lost, (self.x[self.lost] @ q).tolist()) if s >= self.threshold] if self.lost else []
        return list({*known, *self.graph.within(q, self.threshold, self.beam, known)})


def pair_links(one: Shard, other: Shard | None) -> np.ndarray:
    """Bit rows of the links between two shards, or inside one (``other`` None): found from either end."""
    x, y = one.x, None if other is None else other.x
    n, index = len(x if y is None else y), other or one
    bits = np.zeros((len(x), (n + 7) // 8), np.uint8)
    for i, q in enumerate(x):
        row = np.zeros(n, bool)
        row[index.within(q)] = True
        bits[i] |= np.packbits(row, bitorder="little")
    for j, q in enumerate(x if y is None else y):
        hits = one.within(q)
        bits[hits, j >> 3] |= np.uint8(1 << (j & 7))
    if y is None:
        at = np.arange(n)
        bits[at, at >> 3] &= ~np.left_shift(1, at & 7).astype(np.uint8)
    return bits


_FOUND = "key string, root string, weight long"


def _shards(rows: DataFrame, threshold: float) -> DataFrame:
    """(label, dim, shard, data) from sorted rows (label, dim, shard, key, copies, v); data: keys, copies and ``Shard``."""

    def run(batches):
        now, keys, copies, vectors = None, [], [], []

        def close():
            if now is not None:
                data = pickle.dumps((keys, np.array(copies, np.int64), Shard(np.array(vectors), threshold)))
                yield pa.RecordBatch.from_arrays([pa.array([now[0]], label), pa.array([now[1]], pa.int32()),
                                                  pa.array([now[2]], pa.int32()), pa.array([data], pa.binary())],
                                                 names=["label", "dim", "shard", "data"])

        for b in batches:
            label = b.schema.field(0).type
            cols = [b.column(i).to_pylist() for i in range(5)]
            vs = b.column(5)
            for r, (*at, key, n) in enumerate(zip(*cols)):
                if at != now:
                    yield from close()
                    now, keys, copies, vectors = at, [], [], []
                v = vs[r].values.to_numpy(zero_copy_only=False).astype(np.float64)
                v = v / np.abs(v).max()
                keys.append(key)
                copies.append(n)
                vectors.append(v / np.sqrt(v @ v))
        yield from close()

    return rows.mapInArrow(run, T.StructType([rows.schema["label"], T.StructField("dim", T.IntegerType()),
                                              T.StructField("shard", T.IntegerType()), T.StructField("data", T.BinaryType())]))


def _search(rows: DataFrame) -> DataFrame:
    """(key, root, weight) from sorted rows (label, dim, i, j, role, data): role 0 is shard i, role 1 shard j."""

    def links(sides):
        (keys, copies, one), (keys2, copies2, other) = sides[0], sides[-1]
        inside = len(sides) == 1
        bits = pair_links(one, None if inside else other)
        names = keys if inside else keys + keys2
        shift = 0 if inside else len(keys)
        parent, weight = list(range(len(names))), np.zeros(len(names), np.int64)

        def find(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for i in range(len(keys)):
            hits = np.flatnonzero(np.unpackbits(bits[i], count=len(keys2), bitorder="little"))
            weight[i] += copies2[hits].sum()
            if not inside:
                weight[shift + hits] += copies[i]
            for h in (shift + hits).tolist():
                parent[find(h)] = find(i)
        for s in range(0, len(names), 10_000):
            part = range(s, min(s + 10_000, len(names)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i in part], pa.string()), pa.array([names[find(i)] for i in part], pa.string()),
                 pa.array(weight[s:s + 10_000], pa.int64())], names=["key", "root", "weight"])

    def run(batches):
        now, sides = None, []

        def close():
            if len(sides) == 2 or sides and now[2] == now[3]:  # a shard may be empty
                yield from links(sides)

        for b in batches:
            for r, at in enumerate(zip(*(b.column(i).to_pylist() for i in range(4)))):
                if at != now:
                    yield from close()
                    now, sides = at, []
                sides.append(pickle.loads(b.column(5)[r].as_py()))
        yield from close()

    return rows.mapInArrow(run, _FOUND)


def near_vectors(table: DataFrame, threshold: float = THRESHOLD, shard: int = SHARD) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Only vectors of one label and length are compared. A null label, a null or
    empty vector, a zero one, or one with null or non-finite components links
    with nothing and is its own component. Copies (repeated rows too) are
    linked with each other; a null vec_id names no component that has another
    id; other columns are ignored; an empty table gives no rows.
    """
    v = F.col("embedding").cast("array<double>")
    fine = (F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0)
            & ~F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))) & F.exists(v, lambda e: e != 0))
    key = F.when(fine, F.md5(F.concat_ws("|", F.col("label").cast("string"), F.transform(v, lambda e: (e + 0.0).cast("string")))))
    rows = shared_table(table.select("vec_id", "label", v.alias("v"), key.alias("key")), "vectors")
    nodes = shared_table(rows.where("key is not null").groupBy("key")
                         .agg(F.first("label").alias("label"), F.first("v").alias("v"), F.count(F.lit(1)).alias("copies"))
                         .withColumn("dim", F.size("v")), "vector-nodes")
    shards = nodes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("n"))
    placed = nodes.join(shards, ["label", "dim"])
    n = partitions(table.sparkSession)
    cols = ["label", "dim", "shard", "key", "copies", "v"]
    placed = (placed.withColumn("shard", F.pmod(F.xxhash64("key"), "n").cast("int")).select(*cols)
              .repartition(n, "label", "dim", "shard").sortWithinPartitions("label", "dim", "shard", "key"))
    built = shared_table(_shards(placed, threshold), "vector-shards")
    tasks = (built.join(shards, ["label", "dim"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
             .select("label", "dim", F.least("shard", "other").alias("i"), F.greatest("shard", "other").alias("j"),
                     (F.col("shard") > F.col("other")).cast("int").alias("role"), "data"))
    dealt = tasks.repartition(n, "label", "dim", "i", "j").sortWithinPartitions("label", "dim", "i", "j", "role")
    found = shared_table(_search(dealt), "vector-links")
    parts = shared_table(components(found.where("key <> root").select(F.col("key").alias("a"), F.col("root").alias("b"))),
                         "vector-components")
    weights = found.groupBy("key").agg(F.sum("weight").alias("weight"))
    got = (rows.select("vec_id", "key").join(weights, "key", "left").join(nodes.select("key", "copies"), "key", "left")
           .join(parts, F.col("key") == F.col("node"), "left")
           .select("vec_id", F.coalesce("component", "key").alias("part"),
                   F.coalesce(F.col("weight") + F.col("copies") - 1, F.lit(0)).alias("n_links")))
    got = shared_table(got, "vector-parts")
    names = got.where("part is not null").groupBy("part").agg(F.min("vec_id").alias("component_id"))
    linked = got.where("part is not null").join(names, "part").select("vec_id", "n_links", "component_id")
    alone = got.where("part is null").select("vec_id", "n_links", F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
