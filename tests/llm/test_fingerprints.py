"""Fingerprints: trees, edits, and neighbour pairs against a plain loop."""

import hashlib
import random

from civora.llm import fingerprints as fp

SCHEMA = "doc_id long, text string, fingerprint string, h long"


def test_trees():
    text = "# One\nAlpha beta. Gamma delta!\nSecond line here.\n\n# Two\nMore text, and more."
    assert fp.fingerprint(text) == fp.fingerprint(text) != fp.fingerprint(text + " ")
    assert fp.fingerprint(None) == fp.fingerprint("") and fp.likeness(fp.fingerprint(""), fp.fingerprint(None)) == 1
    assert fp.likeness(fp.fingerprint(""), fp.fingerprint("a")) == 0
    new = text.replace("Gamma delta!", "Gamma epsilon!")
    spans = fp.edits(fp.fingerprint(text), fp.fingerprint(new))
    assert [text[a:b] for a, b in spans] == ["Gamma delta!\n"]
    for t in ("", "x", "no end", "..!!", "a\n\n\nb", "ü" * 500, "a. " * 400):
        assert "".join(x for p in fp._PARAGRAPH.findall(t) for x in fp._LEAF.findall(p)) == t
        assert fp._chars(fp._leaves(fp.fingerprint(t))) == len(t)


def check(spark, data, parts=5):
    docs = spark.createDataFrame([(i, t, "own", 1) for i, t in data], SCHEMA).repartition(parts)
    got = sorted((r["doc_id"] is None, -(r["doc_id"] or 0), r["n_chars"], r["edited_sha256"], r["near_edited"],
                  r["near_next"], r["fingerprint"]) for r in fp.edited_pairs(docs).collect())
    return got


def expected(data):
    data = sorted(data, key=lambda d: (d[0] is None, -(d[0] or 0)))
    out = []
    for k, (i, t) in enumerate(data):
        t, after = t or "", data[(k + 1) % len(data)][1] or ""
        m = len(t) // 3
        e = t[:len(t) - m] + after[:m]
        a, b, c = fp.fingerprint(t), fp.fingerprint(e), fp.fingerprint(after)
        out.append((i is None, -(i or 0), len(t), hashlib.sha256(e.encode()).hexdigest(), fp.likeness(a, b),
                    fp.likeness(a, c), a))
    return sorted(out)


def test_neighbours_match_a_loop(spark):
    rnd = random.Random(1)
    text = lambda: "".join(rnd.choice("ab é.\n") for _ in range(rnd.randrange(0, 300)))
    data = [(i * 3 - 50, text()) for i in range(120)] + [(1000, "ü" * 90_000), (1001, None), (1002, ""), (None, "tail")]
    assert check(spark, data) == expected(data)
    assert check(spark, [(5, "alone here.")]) == expected([(5, "alone here.")])
    assert check(spark, []) == []


def test_repeated_rows_and_ties(spark):
    same = [(1, "same text. again")] * 40 + [(2, "other. words")] * 3
    got = check(spark, same)
    assert len(got) == 43
    assert sum(g[5] == 1.0 for g in got) == 39 + 2


def test_edited_texts_stay_closer_than_neighbours():
    rnd = random.Random(2)
    text = lambda: " ".join("w%d%s" % (rnd.randrange(900), rnd.choice(["", "", ".", ""])) for _ in range(200))
    for _ in range(20):
        a, b = text(), text()
        m = len(a) // 3
        near = fp.likeness(fp.fingerprint(a), fp.fingerprint(a[:len(a) - m] + b[:m]))
        assert 0.55 < near < 0.75 and fp.likeness(fp.fingerprint(a), fp.fingerprint(b)) < 0.1
