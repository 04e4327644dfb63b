"""Mixing: targets against a plain loop, words near targets, edge rows, reruns."""

import collections
import re

from civora.llm import mixing

SCHEMA = "doc_id long, text string, source string, mix_copies string"


def run(spark, data):
    docs = spark.createDataFrame([(*d, "own") for d in data], SCHEMA).repartition(3)
    return [r.asDict() for r in mixing.mix(docs).collect()]


def targets(total, weights, cap=3):
    """Round by round: share, stop at the cap, share the excess again."""
    got, open_, rest = {s: 0.0 for s in total}, set(total), float(sum(total.values()))
    while rest > 1e-9 and open_:
        w = sum(weights[s] for s in open_)
        for s in open_:
            got[s] += rest * weights[s] / w
        rest = sum(max(0.0, got[s] - cap * total[s]) for s in open_)
        stopped = {s for s in open_ if got[s] >= cap * total[s]}
        for s in stopped:
            got[s] = float(cap * total[s])
        open_ -= stopped
    return got


def corpus():
    data = []
    for s, (name, docs) in enumerate([("a", 300), ("b", 5), ("Z", 60), (None, 40), ("é", 80), ("empty", 2)]):
        for i in range(docs):
            n = 0 if name == "empty" else (i * 37) % 50 + 1
            data.append((len(data), "\x0b ".join(["wörd"] * n) if n else None, name))
    return data + [(7, data[7][1], "a"), (None, "one two", "a"), (None, None, None)]


def test_targets_and_words(spark):
    data = corpus()
    rows = run(spark, data)
    assert len(rows) == len(data)
    size = {i: len(re.findall(mixing.WORD, t or "")) for i, t, _ in data}
    total = collections.Counter()
    for i, t, s in data:
        total[s] += len(re.findall(mixing.WORD, t or ""))
    order = sorted((s for s in total if s is not None), key=lambda s: s.encode()) + [None]
    want = targets(total, {s: k % 3 + 1 for k, s in enumerate(order)})
    taken = collections.Counter()
    for r in rows:
        assert r["doc_id"] is None or r["mix_size"] == size[r["doc_id"]]
        assert 0 <= r["mix_copies"] <= 3 and r["mix_source_size"] == total[r["source"]]
        assert abs(r["mix_target"] - want[r["source"]]) < 1e-6
        taken[r["source"]] += r["mix_copies"] * r["mix_size"]
    for s in total:
        assert abs(taken[s] - want[s]) <= 25, s
    again = {(r["doc_id"], r["mix_copies"]) for r in run(spark, data[::-1])}
    assert again == {(r["doc_id"], r["mix_copies"]) for r in rows}


def test_sample_repeats_rows_and_keeps_columns(spark):
    docs = spark.createDataFrame([(i, "a b c", "s" if i else "t", 3) for i in range(30)],
                                 "doc_id long, text string, source string, n_chars long")
    got = mixing.sample(docs)
    assert got.columns == docs.columns
    want = {r["doc_id"]: r["mix_copies"] for r in mixing.mix(docs).collect()}
    assert collections.Counter(r["doc_id"] for r in got.collect()) == {k: v for k, v in want.items() if v}


def test_empty_table_and_wordless(spark):
    assert run(spark, []) == []
    assert {(r["mix_target"], r["mix_size"]) for r in run(spark, [(1, None, "a"), (2, " ", None)])} == {(0.0, 0)}
