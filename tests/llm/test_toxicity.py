"""Toxicity: the grammar's transducers, learning, held-out accuracy, edge rows."""

import pytest

from civora.llm import toxicity as X

SF = "/root/testdata/sf0.01"


def test_grammar():
    m = X.Model()
    s = lambda t: sum(v for _, v in m.clauses(t))
    assert s("a fine day for a walk") == 0
    assert s("you are an idiot") > s("an idiot walked by") > s("not an idiot") > 0
    assert s('he said "idiot" twice') < s("what an idiot twice")
    assert s("I will kill you") > s("I will kill time")
    assert s("idiot. idiot") > s("idiot") and m.score("You idiot! Pathetic scum, you worthless loser!") > 0.5
    assert m.score(None) == m.score("") < 0.5
    assert len(m.frame.arcs) + len(m.aim.arcs) < 500


def test_machine_is_the_product_of_its_parts():
    m = X.Machine(X._negation, X._reported, X._target, X._threat)
    symbols = list("TNIORIQHQIHTOOOOOIH")
    states, want = [0] * 4, []
    for s in symbols:
        f = 1.0
        for k, part in enumerate(m.parts):
            states[k], x = part(states[k], s)
            f *= x
        want.append(f)
    assert m.run(symbols) == pytest.approx(want)


def tables(spark):
    words = "the river runs past old houses and green hills where people walk".split()
    docs, labels = [], []
    for i in range(600):
        text = " ".join(words[(i + k * k) % len(words)] for k in range(40)) + "."
        if toxic := i % 4 == 0:
            text += f" blarg{'abcdefgh'[i % 8]}o you. snorfle{i % 3}"
        docs.append((i, text, 0.5))
        labels.append((i, int(toxic), None))
    docs += [(9000, None, 0.0), (9001, "", 0.0), (None, "the blargao", 0.0), (9002, "hill " * 60_000, 0.0), (5, docs[5][1], 0.1)]
    labels += [(5, 0, 1), (None, 1, 1), (9000, None, 1), (777_777, 1, 1)]
    return (spark.createDataFrame(docs, "doc_id long, text string, score double").repartition(3),
            spark.createDataFrame(labels, "doc_id long, toxic int, quality int"))


def test_learns_unknown_words_and_stems(spark):
    docs, labels = tables(spark)
    model = X.train(docs, labels)
    assert model.weight("blargzz") > 2 and model.weight("river") == 0
    rows = X.score(docs, model, out="score").collect()
    assert len(rows) == 605 and docs.columns == list(rows[0].asDict())
    for r in rows:
        if r.doc_id is not None and r.doc_id < 600:
            assert (r.score >= 0.5) == (r.doc_id % 4 == 0)
        assert 0 <= r.score <= 1
    kept = X.reject(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {9000, 9001, 9002}


def test_without_labels_or_rows(spark):
    docs, labels = tables(spark)
    assert X.train(docs, labels.limit(0)).lexicon == {}
    assert X.score(docs.limit(0), X.Model()).collect() == []


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = (X.score(docs, X.train(docs, labels)).where(X.held_out()).join(labels, "doc_id").collect())
    hit = sum(r.toxicity >= 0.5 for r in got if r.toxic)
    wrong = sum(r.toxicity >= 0.5 for r in got if not r.toxic)
    assert hit >= 0.6 * sum(r.toxic for r in got) and wrong <= 0.05 * len(got)
