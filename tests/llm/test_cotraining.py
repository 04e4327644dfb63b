"""Co-training: gains from the pool, held-out accuracy, edge rows."""

import numpy as np

from civora.llm import cotraining as C

SF = "/root/testdata/sf0.01"


def test_views_teach_each_other():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 4000).astype(float)
    a = np.column_stack([y * 3 + rng.normal(size=4000), rng.normal(size=4000)])
    b = np.column_stack([rng.normal(size=4000), y * 2.5 + rng.normal(size=4000)])
    few = np.arange(30)
    fold = few % 3
    model = C.cotrain([a[few], b[few]], y[few], fold, [a[30:3000], b[30:3000]])
    p = model.scores(a[3000:], b[3000:])
    right = ((p >= 0.5) == (y[3000:, None] > 0)).mean(0)
    assert right[2] > 0.93 and right[2] >= right[:2].max() - 0.01


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = C.score(docs, C.train(docs, labels)).where(C.held_out()).join(labels, "doc_id").where("quality is not null").collect()
    bad = [r.score < 0.5 for r in rows if r.quality == 0]
    good = [r.score >= 0.5 for r in rows if r.quality == 1]
    assert np.mean(bad) > 0.7 and np.mean(good) > 0.95


def test_edge_rows(spark):
    schema = "doc_id long, text string, lang string, source string, score double"
    docs = spark.createDataFrame([(1, None, None, None, 1.0), (2, "", "en", "", 1.0), (None, "x " * 50_000, "en", "s", 1.0),
                                  (1, None, None, None, 1.0)], schema)
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1)], "doc_id long, quality int")
    assert C.train(docs, labels) is None and C.train(docs.limit(0), labels.limit(0)) is None
    assert [r.score for r in C.score(docs, None).collect()] == [0.5] * 4
    model = C.Model(np.zeros(C._MASKS + 5), np.zeros(C._LANGS + C._SOURCES + 3), np.zeros(3))
    rows = C.score(docs, model).collect()
    assert [r.score for r in rows] == [0.5] * 4 and C.score(docs.limit(0), model).collect() == []


def test_pool_in_spark_equals_arrays(spark):
    """Thresholds from counts over the whole table pick the rows that a plain sort by confidence would pick."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    table = C.unlabelled(docs, labels).repartition(7).cache()
    rows = sorted(table.collect())
    views = [np.array([np.frombuffer(r[k], np.float32) for r in rows], float) for k in ("c", "m")]
    views[1] = C.spread(views[1])
    rng = np.random.default_rng(2)
    weights = [np.append(0.0, rng.normal(scale=6, size=v.shape[1])) for v in views]
    arrays, spark_pool = C.ArrayPool(views), C.TablePool(table)
    arrays.u = np.array([r.u for r in rows])
    for _ in range(2):  # the second round must not take a row again
        a = {(v, l): x for v, l, x in arrays.surest(weights, 0.5) if len(x)}
        b = {(v, l): x for v, l, x in spark_pool.surest(weights, 0.5)}
        assert a.keys() == b.keys() and a
        assert all(np.array_equal(a[k][np.lexsort(a[k].T)], b[k][np.lexsort(b[k].T)]) for k in a)
    taken = spark_pool.taken
    assert all(len(set(t)) == len(t) for t in taken)


def test_thresholds():
    """Whole cells above the threshold, a share of its own cell, never more than the batch asks for in expectation."""
    n = np.zeros(C._CELLS, int)
    n[[10, 20, 30]] = 500, 100, 150
    at, part = C._cuts(np.array([n, n]), 0.5)[1]  # 200 rows: 150 of cell 30 and half of cell 20
    assert (at, part) == (20, 0.5)
    assert C._cuts(np.zeros((2, C._CELLS), int), 0.5)[0] == (0, 1.0)
    few = np.zeros(C._CELLS, int)
    few[7] = 3
    assert C._cuts(np.array([few, few]), 0.5)[0][0] <= 7


def test_metadata_view_is_blind_to_words():
    assert np.array_equal(C.metadata_view("Ab! c\nd", "en", "s"), C.metadata_view("zzzzz\n9", "en", "s"))


def test_repeated_labelled_rows_count_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    one = C.train(docs, labels)
    two = C.train(docs.unionByName(docs.where("doc_id < 400")), labels)
    assert np.allclose(one.content, two.content) and np.allclose(one.combined, two.combined)
