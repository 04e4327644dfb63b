"""ProbMinHash: estimates, exact indices, and classes against brute force."""

import random

import numpy as np
import pytest

from civora.llm import graph
from civora.llm import probminhash as P


def weighted(text):
    h, c = np.unique(P.Shingler()([text])[0], return_counts=True)
    return h, c.astype(float)


def brute_prob(a, b):
    x, y = dict(zip(*a)), dict(zip(*b))
    keys = x.keys() | y.keys()
    return sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in keys) for d in x.keys() & y.keys())


def test_indices_and_estimates():
    rnd = random.Random(4)
    for _ in range(30):
        words = [rnd.choice("abcdefghij") + rnd.choice("klm") for _ in range(rnd.randrange(3, 120))]
        other = [w if rnd.random() > 0.05 else "zz" for w in words] * rnd.choice([1, 1, 2])
        a, b = weighted(" ".join(words * 2)), weighted(" ".join(other))
        plain, prob = P.similarities(a, b)
        assert plain == pytest.approx(len(set(a[0]) & set(b[0])) / len(set(a[0]) | set(b[0])))
        assert prob == pytest.approx(brute_prob(a, b))
        agree = (P.sketch(*a, 4096) == P.sketch(*b, 4096)).mean()
        assert abs(agree - prob) < 0.05


def test_block_links_match_single_pairs():
    rnd = random.Random(7)
    base = [rnd.choice("abcdefghij") + rnd.choice("klmnop") for _ in range(60)]
    sets = [weighted(" ".join((w if rnd.random() > 0.02 else "zz" for w in base * rnd.choice([1, 1, 2, 3])))) for _ in range(30)]
    want = {(i, j) for i in range(12) for j in range(18) if max(P.similarities(sets[i], sets[12 + j])) >= 0.8}
    assert set(P.block_links(sets[:12], sets[12:], 0.8)) == want and 0 < len(want) < 200


def test_shingler_cuts_texts_and_words():
    texts = ["One, two; THREE four five six", "one two three four five six", "", "...", "one two", "Zwölf  größere\nWörter",
             "one two three four five six"]
    got = P.Shingler()(texts)
    assert [len(g) for g in got] == [2, 2, 0, 0, 1, 1, 2]
    assert (got[0] == got[1]).all() and (got[1] == got[6]).all()
    alone = [P.Shingler()([t])[0] for t in texts]
    assert all((x == y).all() for x, y in zip(got, alone))


def test_components(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1080)]
    want = {}

    def find(v):
        while want.setdefault(v, v) != v:
            v = want[v]
        return v
    for a, b in edges:
        a, b = find(a), find(b)
        want[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[v] == find(v) for v in got) and {v for e in edges for v in e if e[0] != e[1]} <= got.keys()


def corpus():
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(5))
    data = []
    for _ in range(12):
        base = [word() for _ in range(rnd.randrange(30, 200))]
        for _ in range(rnd.randrange(1, 9)):
            copy, edits = list(base), rnd.randrange(0, 6)
            for _ in range(edits):
                copy[rnd.randrange(len(copy))] = word()
            data.append(" ".join(copy) + rnd.choice(["", ".", " " + word()]))
    shared = [word() for _ in range(60)]
    data += [" ".join(shared + [word() for _ in range(n)]) for n in (5, 10, 20, 40, 60, 80)]
    data += ["a b", "a b", "A, b!", "a c", None, "", "...", None, "x " * 30_000, "x " * 30_001]
    return [(i * 7 % 1009, t) for i, t in enumerate(data)]


def brute(data):
    sets = [(i, t, weighted(t or "")) for i, t in data]
    link = {i: {i} for i, _ in data}
    for i, _, a in sets:
        for j, _, b in sets:
            if len(a[0]) and len(b[0]) and i < j and max(P.similarities(a, b)) >= 0.8:
                link[i].add(j)
                link[j].add(i)
    out = {}
    for i in link:
        seen, todo = {i}, [i]
        while todo:
            new = link[todo.pop()] - seen
            seen |= new
            todo += new
        out[i] = min(seen)
    return out


def test_classes_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(P, "GROUP", 3)
    monkeypatch.setattr(P, "BLOCK", 2)
    data = corpus()
    docs = spark.createDataFrame([(*d, b"own") for d in data], "doc_id long, text string, key binary").repartition(3)
    rows = P.near_duplicates(docs).collect()
    assert {r.doc_id: r.class_id for r in rows} == brute(data) and len(rows) == len(data)
    kept = P.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute(data).values()))


def test_plain_near_pairs_of_uneven_weight(spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(6))
    data = []
    for k in range(12):
        base, line = [word() for _ in range(304)], [word() for _ in range(12)]
        # once even against uneven, once two texts that repeat different lines
        other = base + [w for w in base[:12]] * 80 if k % 2 else base
        data += [(10 * k, " ".join(other)), (10 * k + 1, " ".join(base + line * 80))]
        a, b = weighted(data[-2][1]), weighted(data[-1][1])
        plain, prob = P.similarities(a, b)
        assert plain > 0.85 and prob < 0.5
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in P.near_duplicates(docs).collect()}
    assert got == brute(data) == {i: i // 10 * 10 for i, _ in data}


def test_repeated_rows_null_ids_empty(spark):
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(3, text), (3, text), (5, text), (None, text), (None, "z"), (4, ""), (4, "")],
                                 "doc_id long, text string")
    rows = P.near_duplicates(docs).collect()
    assert sorted((r.doc_id or -1, r.class_id or -1, r.class_size, r.kept) for r in rows) == [
        (-1, -1, 1, True), (-1, 3, 4, False), (3, 3, 4, True), (3, 3, 4, True), (4, 4, 1, True), (4, 4, 1, True),
        (5, 3, 4, False)]
    assert sorted((r.doc_id or -1) for r in P.deduplicate(docs).collect()) == [-1, 3, 4, 4]
    assert P.near_duplicates(docs.limit(0)).collect() == []
