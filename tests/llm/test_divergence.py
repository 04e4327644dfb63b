"""Source divergence against a plain loop, bounded tables, edge rows, the registered query."""

import collections
import random
import re

import pyarrow as pa

import __spark_entry__ as E
from civora.llm import divergence as D

SCHEMA = "text string, lang string, source string, value string"


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(rows, min_df, top):
    df, counts, groups = collections.Counter(), collections.Counter(), set()
    for text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        found = terms(text)
        groups.add((lang, source))
        df.update((lang, t) for t in set(found))
        counts.update((lang, source, t) for t in found)
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for (l, t), n in df.items() if l == lang and n >= min_df]
        mine = sorted(s for l, s in groups if l == lang)
        total = {s: sum(counts[lang, s, t] for t in kept) for s in mine}
        share = {s: {t: 1 + 10 ** 9 * (counts[lang, s, t] + 5) // (total[s] + 5 * len(kept)) for t in kept} for s in mine}
        whole = sum(total.values())
        q = {t: 1 + 10 ** 9 * (sum(counts[lang, s, t] for s in mine) + 5) // (whole + 5 * len(kept)) for t in kept}
        for s in mine:
            parts = {"pair": [(sum(abs(share[s][t] - share[o][t]) for t in kept), o) for o in mine if o != s],
                     "term": [(share[s][t] - q[t], t) for t in kept if counts[lang, s, t] and share[s][t] > q[t]]}
            for part, values in parts.items():
                values.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, v, k) for k, (v, item) in enumerate(values, 1) if part == "pair" or k <= top}
    return out


def corpus():
    rng, rows = random.Random(11), []
    pool = ["Alpha", "beta", "Éa", "été", "gamma", "漢字", "z", "don't", "x9y", "\x00\x01", "\U0001d400"]
    for k in range(300):
        lang = rng.choice(["en", "en", "de", None, "nul\x00", "few"])
        source = rng.choice(["s1", "s2", "s10", None, "é", "\x00"])
        rows.append((" ".join(rng.choices(pool[:rng.randrange(1, 11)], k=rng.randrange(0, 25))), lang, source, "own"))
    rows += [(None, "en", "empty", ""), ("", "lone", "a", ""), ("", "lone", "b", ""), ("big " * 200_000, "en", "s1", "")]
    return rows + rows[:20] + [(f"only {i}", "rare", f"r{i}", "") for i in range(3)]


def test_against_loop(spark):
    df = spark.createDataFrame(corpus(), SCHEMA).repartition(5)
    want = brute(corpus(), 12, 4)
    got = [tuple(r) for r in D.audit(df, min_df=12, top=4).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_bounded_tables(monkeypatch):
    """Cut texts and flushed tables add up to the sums of whole ones."""
    monkeypatch.setattr(D, "_PIECE", 30)
    monkeypatch.setattr(D, "_HELD", 5)
    rows = [(l or "", s or "", (t or "").encode()) for t, l, s, _ in corpus() if len(t or "") < 1000]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.string(), pa.binary()))],
                                       names=["lang", "source", "text"])
    got, want = collections.Counter(), collections.Counter()
    for out in D._sum_vectors(iter([batch])):
        for lang, source, term, n, df in zip(*(c.to_pylist() for c in out.columns)):
            got.update({(lang, source, term, "n"): n, (lang, source, term, "df"): df})
    for lang, source, text in rows:
        found = terms(text.decode())
        want.update((lang, source, t, "n") for t in found)
        want.update((lang, source, t, "df") for t in set(found))
    assert got == want


def test_many_sources(spark):
    """More sources than one chunk holds."""
    rng = random.Random(2)
    rows = [(" ".join(rng.choices("abcdefgh", k=6)), "xx", f"s{i % 150}", "") for i in range(300)]
    got = D.audit(spark.createDataFrame(rows, SCHEMA), min_df=30, top=3).collect()
    assert {tuple(r) for r in got} == brute(rows, 30, 3) and len(got) >= 150 * 149


def test_nothing_kept(spark):
    few = spark.createDataFrame([("a b", "en", "s", ""), ("b", "en", "t", "")], SCHEMA)
    assert sorted(tuple(r) for r in D.audit(few).collect()) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]
    assert D.audit(few.limit(0)).count() == 0


def test_registered(spark):
    out = E.queries()["op13_source_divergence"](spark, "/root/testdata/sf0.001")
    assert out.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"),
                          ("value", "bigint"), ("rank", "int")]
    assert out.count() > 0
