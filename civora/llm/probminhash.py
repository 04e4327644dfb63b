"""Near-duplicate documents by ProbMinHash, banding and exact verification.

Sketch: every distinct five-word shingle, weighted by how often it occurs, is a
Poisson process of arrivals at rate of its weight, each arrival at a random one
of M positions; a position keeps the shingle that arrives first. Two sketches
agree in a position with the probability Jaccard similarity of the weighted
sets. Arrivals are drawn in order of time and a shingle stops as soon as its
next arrival comes after the latest first arrival of all positions.

Candidates: positions are cut into bands; texts that share a band form a
bucket. Plain Jaccard pairs can differ widely in weights, so a text whose
shingle counts differ is banded twice: by its counts and with all weights 1.
Even counts give both sketches at once. A bucket's smallest member is its lead, and every member is verified
against the lead on its shingles. Verified links are united to components, and
in rounds one member of every other component of a bucket is verified against
one of its largest component, drawn anew in each round, as long as that joins
components. What remains is decided exactly: in every bucket that still holds
several components, blocks of members outside the largest one are compared
with blocks of all members by matrix products of their shingle sets. Only links
leave a block; no pair is emitted to be tested, and no candidate is left out.

Links are united to components; texts that are equal are one node throughout.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civora.llm.common import partitions, portions, shared_path, shared_table, slices, text_key, tidy, unused
from civora.llm.graph import components

WORDS = 5
THRESHOLD = 0.8
#: 42 bands of 6: a pair at the threshold shares none with probability 3e-6, one at 0.3 shares one with 0.03.
POSITIONS = 252
BANDS = 42
#: Members verified by one task against one lead; a lead with more is split.
GROUP = 500
#: Members of a block that is compared as a whole.
BLOCK = 400
#: Rounds that join components before the remaining pairs are verified one by one.
ROUNDS = 6

_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
_BUFFER = 1 << 19
_SPACE = re.compile(r"\W+")


def mix64(z: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class Shingler:
    """64-bit hashes of the five-word shingles of many texts at once."""

    def __init__(self, words: int = WORDS):
        self.words = words
        rng = np.random.default_rng(20)
        self.table = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base, inverse = 0x9E3779B97F4A7C15 | 1, pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64)
        self.power, self.inverse, self.base, self.back = np.ones(1, np.uint64), np.ones(1, np.uint64), base, inverse

    def _powers(self, n: int):
        if len(self.power) < n:
            size = max(n, 2 * len(self.power))
            for name, base in (("power", self.base), ("inverse", self.back)):
                x = np.full(size, base, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))
        return self.power[:n], self.inverse[:n]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """One array per text, in text order; a text of fewer words is one shingle."""
        raw = [" ".join(_SPACE.split(t.lower())).strip().encode("utf-8", "surrogatepass") for t in texts]
        out: list[np.ndarray] = [np.empty(0, np.uint64)] * len(raw)
        for i, j in slices([len(x) + 1 for x in raw], _BUFFER):
            self._some(raw, i, j, out)
        return out

    def _some(self, raw, i, j, out):
        data = np.frombuffer(b"\n".join(raw[i:j]) + b"\n", np.uint8)
        power, inverse = self._powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * power[:-1], out=sums[1:])
        gap = (data == 32) | (data == 10)
        stop = np.flatnonzero(gap)
        start = np.concatenate(([0], stop[:-1] + 1))
        real = stop > start  # an empty text has an empty word
        start, stop = start[real], stop[real]
        word = mix64((sums[stop] - sums[start]) * inverse[start] + (stop - start).astype(np.uint64))
        ends = np.flatnonzero(data == 10)
        first = np.searchsorted(start, np.concatenate(([0], ends[:-1] + 1)))
        last = np.searchsorted(start, ends)
        n, k = len(word), self.words
        rolled = np.zeros(max(0, n - k + 1), np.uint64)
        for w in range(k):
            rolled = mix64(rolled + word[w:n - k + 1 + w] * np.uint64(2 * w + 1)) if n >= k else rolled
        for t in range(j - i):
            a, b = int(first[t]), int(last[t])
            if b - a >= k:
                out[i + t] = rolled[a:b - k + 1]
            elif b > a:
                h = np.zeros(1, np.uint64)
                for w in range(a, b):
                    h = mix64(h + word[w:w + 1] * np.uint64(2 * (w - a) + 1))
                out[i + t] = h


def sketch(shingles: np.ndarray, weights: np.ndarray, m: int = POSITIONS) -> np.ndarray:
    """ProbMinHash of a weighted set: m 64-bit hashes."""
    best = np.full(m, np.inf)
    kept = np.zeros(m, np.uint64)
    now, times, rate, drawn = shingles, np.zeros(len(shingles)), 1.0 / weights, 0
    while len(now):
        block = max(1, min(8 * m, 4 * m // len(now)))
        step = np.uint64(0x9E3779B97F4A7C15) * (np.arange(drawn + 1, drawn + block + 1, dtype=np.uint64))
        z = mix64(now[:, None] + step[None, :])
        gaps = -np.log(((z >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53)
        at = times[:, None] + np.cumsum(gaps * rate[:, None], axis=1)
        place = (mix64(z) % np.uint64(m)).astype(np.int64)
        flat, where = at.ravel(), place.ravel()
        early = np.flatnonzero(flat < best.max())
        early = early[np.argsort(flat[early], kind="stable")]
        spot, index = np.unique(where[early], return_index=True)
        hit = early[index]
        better = flat[hit] < best[spot]
        spot, hit = spot[better], hit[better]
        best[spot] = flat[hit]
        kept[spot] = now[hit // block]
        times, drawn = at[:, -1], drawn + block
        going = times < best.max()
        now, times, rate = now[going], times[going], rate[going]
    return kept


def band_keys(kept: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band of a sketch."""
    rows = mix64(kept).reshape(bands, -1)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows.shape[1]):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, r])
    return key


def candidate_bands(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Band keys of a text: of the plain set and, if its counts differ, of the weighted set too."""
    plain = band_keys(sketch(hashes, np.ones(len(hashes))))
    if counts.max() == counts.min():
        return plain
    return np.unique(np.concatenate((plain, band_keys(sketch(hashes, counts.astype(float))))))


def similarities(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[float, float]:
    """Plain and probability Jaccard index of two weighted sets (sorted hashes, weights)."""
    union = np.union1d(a[0], b[0])
    x, y = np.zeros(len(union)), np.zeros(len(union))
    x[np.searchsorted(union, a[0])] = a[1]
    y[np.searchsorted(union, b[0])] = b[1]
    both = (x > 0) & (y > 0)
    plain = both.sum() / len(union)
    if not both.any():
        return 0.0, 0.0
    if a[1].max() == a[1].min() and b[1].max() == b[1].min():
        # every ratio is the same on common shingles
        x, y = x / a[1][0], y / b[1][0]
        return float(plain), float(plain)
    ratio = np.where(y > 0, x / np.where(y > 0, y, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    x, y, both, ratio = x[order], y[order], both[order], ratio[order]
    # for shingle d: sum over e of max(x_e / x_d, y_e / y_d); x's share is the larger from d's ratio on
    first = np.searchsorted(ratio, ratio[both], side="left")
    tail = np.concatenate((np.cumsum(x[::-1])[::-1], [0.0]))[first]
    head = np.concatenate(([0.0], np.cumsum(y)))[first]
    return float(plain), float((1.0 / (tail / x[both] + head / y[both])).sum())


def _bands(docs: DataFrame) -> DataFrame:
    """(key, bands) of every distinct text with words."""

    def run(batches):
        shingler = Shingler()
        for b in (p for whole in batches for p in portions(whole, 1)):
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            rows = []
            for key, s in zip(keys, shingler(texts)):
                if len(s):
                    hashes, counts = np.unique(s, return_counts=True)
                    rows.append((key, candidate_bands(hashes, counts).view(np.int64)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.list_(pa.int64()))],
                    names=["key", "bands"])

    return docs.mapInArrow(tidy(run), "key binary, bands array<long>").dropDuplicates(["key"])


def _shingle_sets(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Table (key, data) of the texts ``keys``, bucketed by key in the shared folder.

    data: the sorted 32-bit hashes of all shingles, repeats included. Texts are
    shuffled once; every verification reads its buckets where they lie.
    """
    spark = docs.sparkSession

    def run(batches):
        shingler = Shingler()
        for b in (p for whole in batches for p in portions(whole, 1)):
            data = [np.sort((s >> np.uint64(32)).astype(np.uint32)).tobytes() for s in shingler(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(data, pa.binary())], names=["key", "data"])

    n = partitions(spark)
    name = f"civora_shingles_{uuid.uuid4().hex}"
    sets = docs.join(keys, "key", "left_semi").dropDuplicates(["key"]).mapInArrow(tidy(run), "key binary, data binary")
    sets.repartition(n, "key").write.bucketBy(n, "key").option("path", shared_path(spark, "shingles")).saveAsTable(name)
    return spark.table(name)


_COMPARE = "lead binary, g int, role int, key binary, data binary"


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, lead, plain, prob) of every (key, lead) pair, each once.

    A lead's shingles go once to every group of its members.
    """
    groups = pairs.groupBy("lead").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("n"))
    member = (pairs.join(groups, "lead")
              .select("key", F.struct("lead", F.lit(1).alias("role"), F.pmod(F.xxhash64("key"), F.col("n")).cast("int").alias("lo"),
                                      F.lit(0).alias("hi")).alias("task")))
    own = groups.select(F.col("lead").alias("key"), F.struct("lead", F.lit(0).alias("role"), F.lit(0).alias("lo"),
                                                             (F.col("n") - 1).alias("hi")).alias("task"))
    # a text has one task for each of its leads and one as a lead
    tasks = shared_table(member.unionByName(own).groupBy("key").agg(F.collect_list("task").alias("tasks")), "near-tasks")

    def table(rows):
        lead, g, role, key, data = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(lead, pa.binary()), pa.array(g, pa.int32()), pa.array(role, pa.int32()),
                                           pa.array(key, pa.binary()), pa.array(data, pa.binary())],
                                          names=["lead", "g", "role", "key", "data"])

    def deal(batches):
        for b in batches:
            rows = []
            for key, data, ts in zip(*(b.column(i).to_pylist() for i in range(3))):
                for t in ts:
                    for g in range(t["lo"], max(t["lo"], t["hi"]) + 1):
                        rows.append((t["lead"], g, t["role"], key, data))
                        if len(rows) >= 500:
                            yield table(rows)
                            rows = []
            if rows:
                yield table(rows)

    def compare(batches):
        lead, own_set = None, None
        for b in batches:
            rows = []
            for at, g, role, key, data in zip(*(b.column(i).to_pylist() for i in range(5))):
                hashes, counts = np.unique(np.frombuffer(data, np.uint32), return_counts=True)
                if role == 0:
                    lead, own_set = (at, g), (hashes, counts.astype(float))
                elif (at, g) == lead:
                    rows.append((key, at, *similarities((hashes, counts.astype(float)), own_set)))
            if rows:
                key, at, plain, prob = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.binary()), pa.array(at, pa.binary()),
                                                  pa.array(plain, pa.float64()), pa.array(prob, pa.float64())],
                                                 names=["key", "lead", "plain", "prob"])

    return (sets.join(tasks.hint("shuffle_hash"), "key").select("key", "data", "tasks").mapInArrow(tidy(deal), _COMPARE)
            .repartition(partitions(sets.sparkSession), "lead", "g").sortWithinPartitions("lead", "g", "role", "key")
            .mapInArrow(tidy(compare), "key binary, lead binary, plain double, prob double"))


def _open_buckets(placed: DataFrame, parts: DataFrame) -> DataFrame:
    """(band, key, part) of the members of buckets that hold more than one component."""
    members = (placed.select("band", "key").join(parts, F.col("key") == F.col("node"), "left")
               .select("band", "key", F.coalesce("component", "key").alias("part")))
    mixed = members.groupBy("band").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi")
    return members.join(mixed.select("band"), "band", "left_semi")


def _joining_pairs(members: DataFrame, parts: DataFrame, turn: int) -> DataFrame:
    """For every open bucket: one member of each component with one of its largest component."""
    size = parts.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    drawn = members.groupBy("band", "part").agg(F.min(F.struct(F.xxhash64("key", F.lit(turn)).alias("h"), "key")).alias("x"))
    drawn = (drawn.join(size, F.col("part") == F.col("component"), "left")
             .select("band", "part", F.coalesce("size", F.lit(1)).alias("size"), F.col("x.key").alias("key")))
    lead = drawn.groupBy("band").agg(F.max(F.struct("size", "part", F.col("key").alias("lead"))).alias("x"))
    return (drawn.join(lead, "band").where(F.col("part") != F.col("x.part"))
            .select("key", F.col("x.lead").alias("lead")).distinct())


def _matrices(sets, vocabulary):
    """0/1 and normalised weight rows of weighted sets over a range of sorted hashes."""
    ones = np.zeros((len(sets), len(vocabulary)), np.float32)
    mass = np.zeros((len(sets), len(vocabulary)), np.float32)
    for i, (hashes, counts) in enumerate(sets):
        a, b = np.searchsorted(hashes, vocabulary[0]), np.searchsorted(hashes, vocabulary[-1], side="right")
        at = np.searchsorted(vocabulary, hashes[a:b])
        ones[i, at] = 1
        mass[i, at] = counts[a:b] / counts.sum()
    return ones, mass


def block_links(xs, ys, threshold: float) -> list[tuple[int, int]]:
    """Index pairs of weighted sets whose plain or probability Jaccard index reaches the threshold.

    Plain indices come from one matrix product. The probability index is at
    most either set's mass on the other's support, which two more products
    give; it is worked out for the pairs that pass.
    """
    vocabulary = np.unique(np.concatenate([s[0] for s in (*xs, *ys)]))
    common, x_mass, y_mass = (np.zeros((len(xs), len(ys))) for _ in range(3))
    for c in range(0, len(vocabulary), 8192):
        part = vocabulary[c:c + 8192]
        (x1, xm), (y1, ym) = _matrices(xs, part), _matrices(ys, part)
        common += x1 @ y1.T
        x_mass += xm @ y1.T
        y_mass += x1 @ ym.T
    nx, ny = (np.array([len(s[0]) for s in t]) for t in (xs, ys))
    plain = common / (nx[:, None] + ny[None, :] - common)
    flat_x, flat_y = (np.array([s[1].max() == s[1].min() for s in t]) for t in (xs, ys))
    uneven = ~(flat_x[:, None] & flat_y[None, :])
    maybe = (plain < threshold) & uneven & (np.minimum(x_mass, y_mass) >= threshold - 1e-4)
    out = list(zip(*np.nonzero(plain >= threshold)))
    return out + [(i, j) for i, j in zip(*np.nonzero(maybe)) if similarities(xs[i], ys[j])[1] >= threshold]


def _block_links(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b) links between different components in the open buckets (band, key, part)."""
    counts = members.groupBy("band", "part").agg(F.count(F.lit(1)).alias("n"))
    shape = (counts.groupBy("band").agg(F.sum("n").alias("n"), F.max(F.struct("n", "part")).alias("x"))
             .select("band", F.col("x.part").alias("main"), F.ceil(F.col("n") / BLOCK).cast("int").alias("ny"),
                     F.ceil((F.col("n") - F.col("x.n")) / BLOCK).cast("int").alias("nx")))
    h = F.xxhash64("key")
    steps = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    at = members.join(shape, "band")
    y = F.transform(steps("nx"), lambda i: F.struct(i.alias("i"), F.pmod(h, F.col("ny")).cast("int").alias("j"), F.lit(1).alias("role")))
    x = F.transform(steps("ny"), lambda j: F.struct(F.pmod(h, F.col("nx")).cast("int").alias("i"), j.alias("j"), F.lit(0).alias("role")))
    places = F.when(F.col("part") == F.col("main"), y).otherwise(F.concat(y, x))
    tasks = (at.select("key", "part", "band", F.explode(places).alias("p"))
             .groupBy("key").agg(F.first("part").alias("part"), F.collect_list(F.struct("band", "p.i", "p.j", "p.role")).alias("tasks")))
    tasks = shared_table(tasks, "near-blocks-dealt")
    rows = (sets.join(tasks.hint("shuffle_hash"), "key").select("key", "part", "data", F.explode("tasks").alias("t"))
            .select("t.band", "t.i", "t.j", "t.role", "key", "part", "data"))

    def compare(batches):
        now, xs, ys = None, [], []

        def links():
            if not xs or not ys:
                return []
            keyed = lambda t: [(np.unique(np.frombuffer(d, np.uint32), return_counts=True)) for _, _, d in t]
            real = lambda t: [(a, b.astype(float)) for a, b in keyed(t)]
            return [(xs[i][0], ys[j][0]) for i, j in block_links(real(xs), real(ys), threshold) if xs[i][1] != ys[j][1]]

        def table(found):
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.binary()) for k in (0, 1)], names=["a", "b"])

        for b in batches:
            for band, i, j, role, key, part, data in zip(*(b.column(c).to_pylist() for c in range(7))):
                if (band, i, j) != now:
                    if found := links():
                        yield table(found)
                    now, xs, ys = (band, i, j), [], []
                (ys if role else xs).append((key, part, data))
        if found := links():
            yield table(found)

    return (rows.repartition(partitions(sets.sparkSession), "band", "i", "j").sortWithinPartitions("band", "i", "j")
            .mapInArrow(tidy(compare), "a binary, b binary")).distinct()


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, key (content), class_id, class_size, kept.

    Two texts are linked if the plain or the probability Jaccard index of their
    five-word shingles (words lower-cased, without punctuation) is at least
    ``threshold``, or if they are equal; classes are the connected components.
    class_id is the smallest id of the class, ``kept`` marks the rows that
    carry it. A text of one to four words is one shingle. A null text, or one
    without words, is linked with nothing. A null id never names a class that
    has another id. Repeated rows repeat their result; an empty table gives no
    rows; other columns are ignored.
    """
    docs = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("key"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    members = docs.select("id", "key", F.col("text").rlike(r"(?U)\w").alias("words"))
    rows = shared_table(_bands(docs.select("key", "text")), "near-bands").select("key", F.explode("bands").alias("band"))
    leads = rows.groupBy("band").agg(F.min("key").alias("lead"), F.max("key").alias("most")).where("lead <> most")
    placed = shared_table(rows.join(leads.drop("most"), "band"), "near-buckets")
    sets = _shingle_sets(docs.select("key", "text"), placed.select("key").distinct())
    near = (F.col("plain") >= threshold) | (F.col("prob") >= threshold)
    links = lambda t: t.where(near).select(F.col("key").alias("a"), F.col("lead").alias("b"))
    first = shared_table(_verify(placed.where("key <> lead").select("key", "lead").distinct(), sets), "near-verified")
    parts = shared_table(components(links(first)), "near-parts")
    rays = lambda t: t.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    for turn in range(ROUNDS):
        pairs = shared_table(_joining_pairs(_open_buckets(placed, parts), parts, turn), "near-joining")
        found = shared_table(links(_verify(pairs, sets)), "near-joined")
        parts = shared_table(components(rays(parts).unionByName(found)), "near-parts")
        if 10 * found.count() < pairs.count():
            break  # what is left seldom joins: it is verified pair by pair below

    second = shared_table(_block_links(_open_buckets(placed, parts), sets, threshold), "near-blocks")
    parts = shared_table(components(rays(parts).unionByName(second)), "near-components")

    own = (members.join(parts, F.col("key") == F.col("node"), "left")
           .select("id", "key", "words", F.coalesce("component", "key").alias("part")))
    own = shared_table(own, "near-members")
    classes = own.where("words").groupBy("part").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    got = own.where("words").join(classes, "part").select("id", "key", "class_id", "class_size")
    alone = own.where(~F.col("words")).select("id", "key", F.col("id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return (got.unionByName(alone)
            .select(F.col("id").alias(id_col), "key", "class_id", "class_size",
                    F.col("id").eqNullSafe(F.col("class_id")).alias("kept")))


def deduplicate(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class: the one of the smallest id; of rows that repeat it, any one.

    Columns may have any names: the ones needed on the way get names that ``docs`` does not use.
    """
    node, key, n, size = (unused(x, docs) for x in ("_near_id", "_near_key", "_near_n", "_near_size"))
    near = near_duplicates(docs.select(id_col, text_col), threshold, id_col, text_col).where("kept")
    keep = (near.groupBy(F.col(id_col).alias(node), F.col("key").alias(key))
            .agg(F.count(F.lit(1)).alias(n), F.max("class_size").alias(size)))
    keep = shared_table(keep, "near-keep")
    rows = docs.join(keep, F.col(id_col).eqNullSafe(F.col(node)) & (text_key(text_col) == F.col(key)))
    several = (F.col(n) > 1) & (F.col(size) > 1)
    return rows.where(~several).unionByName(rows.where(several).dropDuplicates([node, key])).select(*docs.columns)
