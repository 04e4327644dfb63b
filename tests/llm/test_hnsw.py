"""Embedding near-duplicates against brute force: recall, exactness of links, edge rows."""

import numpy as np

from civora.llm import hnsw as H

SF = "/root/testdata/sf0.1"


def brute(rows, threshold=0.98):
    ids = [r[0] for r in rows]
    x = np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([r[2] for r in rows])
    near = (x @ x.T >= threshold) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    part = np.array(ids)
    while True:
        new = np.minimum(part, np.where(near, part[None, :], 1 << 60).min(1))
        if (new == part).all():
            return {i: (int(n), int(p)) for i, n, p in zip(ids, near.sum(1), part)}
        part = new


def test_graph_recall_on_clusters():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 32))
    x = np.concatenate([c + 0.08 * rng.normal(size=(k, 32)) for c, k in zip(centres, rng.integers(1, 150, 60))])
    x = np.concatenate([x, rng.normal(size=(1500, 32))])
    x /= np.linalg.norm(x, axis=1)[:, None]
    shard = H.Shard(x, 0.98)
    true = x @ x.T >= 0.98
    hit = 0
    for i in range(len(x)):
        found = shard.within(x[i])
        assert true[i, found].all()
        hit += len(found)
    assert shard.graph is not None and hit / true.sum() >= 0.95


def test_whole_table_against_brute_force(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding, r.label) for r in df.collect()])
    got = {r.vec_id: (r.n_links, r.component_id) for r in H.near_vectors(df, shard=90).collect()}
    assert got.keys() == want.keys()
    assert sum(g[0] for g in got.values()) >= 0.95 * sum(w[0] for w in want.values())
    assert all(got[i][0] <= want[i][0] for i in got)
    assert np.mean([got[i][1] == want[i][1] for i in got]) >= 0.95


def clusters():
    """A cluster of a third of all vectors, planted pairs, isolated vectors."""
    rng = np.random.default_rng(5)
    c = rng.normal(size=24)
    big = c + 0.03 * rng.normal(size=(500, 24))
    pairs = np.repeat(rng.normal(size=(100, 24)), 2, axis=0) + 0.02 * rng.normal(size=(200, 24))
    x = np.concatenate([big, pairs, rng.normal(size=(800, 24))])
    x /= np.linalg.norm(x, axis=1)[:, None]
    return x[rng.permutation(len(x))]


def test_audit_sees_pairs_beside_a_large_cluster(monkeypatch):
    x = clusters()
    true = x @ x.T >= 0.98
    alone = true.sum(1) <= 9  # pairs and isolated vectors
    real = H.Graph.within
    # a graph that finds the cluster only
    monkeypatch.setattr(H.Graph, "within", lambda g, q, t, *a: [] if (g.x @ q >= t).sum() <= 9 else real(g, q, t, *a))
    shard = H.Shard(x, 0.98)
    assert all(set(shard.within(x[i])) == set(np.flatnonzero(true[i]).tolist()) for i in np.flatnonzero(alone))


def test_links_over_several_shards(spark):
    rows = [(i, v.tolist(), 1) for i, v in enumerate(clusters()[:600])]
    want = brute(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in H.near_vectors(df, shard=250).collect()}
    assert sum(got[i] == w for i, w in want.items()) >= 0.98 * len(want)
    assert all(got[i][0] <= want[i][0] for i in got)


def test_links_count_for_both_ends(monkeypatch):
    x = clusters()[:48]
    # only one end of each pair finds the other
    half = lambda s, q: [i for i in np.flatnonzero(s.x @ q >= 0.98) if s.x[i][0] >= q[0]]
    monkeypatch.setattr(H.Shard, "within", half)
    for y in (None, x[:30]):
        z = x if y is None else y
        links = np.unpackbits(H.pair_links(H.Shard(x, 0.98), None if y is None else H.Shard(y, 0.98)), axis=1, count=len(z), bitorder="little").astype(bool)
        near = x @ z.T >= 0.98
        if y is None:
            np.fill_diagonal(near, False)
        assert (links == near).all()


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0], 1, "own"), (2, [2.0, 0.0], 1, "own"), (3, [1.0, 0.0], 2, "own"), (4, None, 1, "own"),
            (5, [0.0, 0.0], 1, "own"), (6, [nan, 1.0], 1, "own"), (7, [inf, 1.0], 1, "own"), (8, [1.0, None], 1, "own"),
            (9, [1.0, 0.0], None, "own"), (10, [], 1, "own"), (11, [1.0, 0.0, 0.0], 1, "own"), (1, [1.0, 0.0], 1, "own"),
            (None, [1.0, 0.001], 1, "own"), (12, [1e300, -0.0], 1, "own")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, key string")
    got = sorted(((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in H.near_vectors(df).collect()))
    want = [(-1, 4, 1, False), (1, 4, 1, True), (1, 4, 1, True), (2, 4, 1, False), (12, 4, 1, False)]
    want += [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)]
    assert got == sorted(want)
    assert H.near_vectors(df.limit(0)).collect() == []
