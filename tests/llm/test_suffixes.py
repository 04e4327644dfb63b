"""Repeated passages against a brute-force table of all windows."""

import collections
import hashlib
import random

from civora.llm import suffixes as S


def brute(data):
    texts = [(i, (t or "").encode()) for i, t in data]
    seen = collections.Counter()
    for _, t in texts:
        for s in range(len(t) - S.LENGTH + 1):
            seen[t[s:s + S.LENGTH]] += 1
    out = []
    for i, t in texts:
        cut = bytearray(len(t))
        for s in range(len(t) - S.LENGTH + 1):
            if seen[t[s:s + S.LENGTH]] > 1:
                cut[s:s + S.LENGTH] = b"\1" * S.LENGTH
        kept = bytes(b for b, c in zip(t, cut) if not c)
        spans = sum(c and not p for c, p in zip(cut, [0, *cut[:-1]]))
        out.append((i, len(t), sum(cut), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus():
    rnd = random.Random(8)
    chars = "abcdefgh é\n日"
    text = lambda n: "".join(rnd.choice(chars) for _ in range(n))
    passages = [text(n) for n in (120, 160, 199, 200, 201, 230, 260, 400, 900)]
    data = [text(rnd.randrange(0, 500)) + "".join(rnd.choice(passages) + text(rnd.randrange(0, 90)) for _ in range(3))
            for _ in range(60)]
    base = text(1500)
    data += [base[:k] + "X" + base[k + 1:] for k in (0, 90, 300, 301, 700, 1499)]
    data += ["ab" * 400, "ab" * 150 + text(50), "z" * 199, "z" * 200, "z" * 201, base[200:520], None, "", None, "same" * 60, "same" * 60]
    data += [b"".join([b"q" * 100, bytes(range(65, 91)) * 5]).decode() * k for k in (1, 2)]
    return [(i, t) for i, t in enumerate(data)]


def run(spark, data, parts=4):
    docs = spark.createDataFrame([(*d, "own", 1) for d in data], "doc_id long, text string, key string, n long").repartition(parts)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.report(docs).collect()), key=str)


def test_matches_brute_force(spark, monkeypatch):
    data = corpus()
    assert run(spark, data) == brute(data)
    # mixed groups occur, so that all three digits are used
    docs = spark.createDataFrame(data, "doc_id long, text string")
    texts = S.distinct_texts(docs.select(S.text_key("text").alias("key"), S.F.coalesce("text", S.F.lit("")).alias("text")))
    first = S._pass(S._first_digit(texts), False, "t1")
    second = S._pass(S._next_digit(texts, first.where("not whole"), S.runs_of), False, "t2")
    assert first.where("whole").count() and second.where("whole").count() and second.where("not whole").count()


def test_settled_runs_leave_one_text(spark):
    rows = [(1, 1, b"a", 1), (1, 1, b"b", 2), (1, 1, b"b", 9), (1, 2, b"c", 3), (2, 1, b"a", 4), (2, 3, b"d", 5)]
    mixed = spark.createDataFrame([(d, c, bytearray(k), a) for d, c, k, a in rows], "digit long, content long, key binary, at long")
    got = {r.at: r for r in S._settle(mixed, "t3").collect()}
    assert [got[a].settled for a in (1, 2, 9, 3, 4, 5)] == [True] * 3 + [False] * 3
    assert got[2].open == got[9].open != got[1].open and all(got[a].open for a in (3, 4, 5))


def test_pieces_of_long_texts(monkeypatch):
    rnd = random.Random(9)
    text = "".join(rnd.choice("abc ") for _ in range(5000)).encode()
    roller = S.Roller()
    whole = S.blocks(roller, [text])
    cut = S.blocks(roller, [text[:2000 + S.LENGTH - 1], text[2000:]])
    windows = lambda b, base: {(int(s) + base[p] + k, int(s + o) + base[p]) for p, s, n, o in
                               zip(b[0].tolist(), b[3].tolist(), b[4].tolist(), b[5].tolist()) for k in range(n)}
    assert windows(whole, [0]) == windows(cut, [0, 2000]) and len(windows(whole, [0])) == 5000 - S.LENGTH + 1


def test_remove_keeps_rows_and_whole_characters(spark):
    rnd = random.Random(10)
    text = lambda n: "".join(rnd.choice("é日ab") for _ in range(n))
    shared = text(300)
    data = [(i, text(50) + shared + text(40), "c%d" % i) for i in range(5)] + [(7, None, "n"), (8, "", "e"), (9, text(400), None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in S.remove(docs).collect()}
    assert len(got) == 8 and S.remove(docs).columns == docs.columns
    for i, t, s in data:
        assert got[i].source == s and (got[i].text is None) == (t is None)
        if i < 5:
            assert 80 <= len(got[i].text) <= 100 and "�" not in got[i].text
    assert got[9].text == data[-1][1]


def test_empty_table(spark):
    assert run(spark, [(1, "x")])[0][:4] == (1, 1, 0, 0)
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.report(docs).collect() == []
