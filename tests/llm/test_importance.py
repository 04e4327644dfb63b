"""Importance resampling against plain loops, pieces and sentinels, edge rows, the registered query."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np

import __spark_entry__ as E
from civora.llm import importance as I

SCHEMA = "doc_id long, text string, weight string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, max_n):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return words, [" ".join(words[i:i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]


def bucket(feature, buckets):
    return zlib.crc32(feature.encode()) % buckets


def brute(docs, target, max_n, buckets, min_words, percent):
    raw, aim = collections.Counter(), collections.Counter()
    for _, text, _ in docs:
        raw.update(bucket(f, buckets) for f in grams(text, max_n)[1])
    for text in target:
        aim.update(bucket(f, buckets) for f in grams(text, max_n)[1])
    s_all, t_all = sum(raw.values()), sum(aim.values())
    gain = {b: math.floor(1000 * math.log((aim[b] + 1) * (s_all + buckets) / ((raw[b] + 1) * (t_all + buckets)))) for b in raw}
    rows = []
    for i, text, _ in docs:
        words, features = grams(text, max_n)
        weight = sum(gain[bucket(f, buckets)] for f in features)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(features), weight, score, None, len(words) >= min_words])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = k
    return sorted((r[:5] for r in rows), key=str)


def corpus():
    rng = random.Random(5)
    pool = ["Alpha", "beta", "ÉTÉ", "été", "x1", "漢字", "Z", "né\x00e", "don't", "\U0001d400"]
    docs = [(i, " ,\n".join(rng.choices(pool, k=rng.randrange(0, 60))), "own") for i in range(80)]
    docs += [(100, None, ""), (101, "", ""), (102, "\x00\x00", ""), (None, "beta " * 30, ""), docs[3], docs[3]]
    return docs + [(103, "word " * 400_000, "")]


def test_against_loop(spark):
    target = ["alpha Beta été", None, "", "x1 x1 z"]
    df = spark.createDataFrame(corpus(), SCHEMA).repartition(4)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    for max_n, buckets in ((1, 10_000), (3, 64)):
        out = I.resample(df, aim, max_n=max_n, buckets=buckets, min_words=5, percent=30)
        got = sorted(([*r] for r in out.collect()), key=str)
        assert got == brute(corpus(), [t or "" for t in target], max_n, buckets, 5, 30), max_n


def test_pieces(monkeypatch):
    """Cut texts give the n-grams of whole ones; no n-gram crosses a document."""
    monkeypatch.setattr(I, "_SLICE", 40)
    texts = [t.encode() if t else None for _, t, _ in corpus()[:86]]
    got, words = collections.Counter(), np.zeros(len(texts), int)
    for rows, counted, at, hashed in I._features(texts, 3, 10_000, I._Checksums()):
        np.add.at(words, rows, counted)
        got.update(zip(at.tolist(), hashed.tolist()))
    want = collections.Counter()
    for k, t in enumerate(texts):
        found, features = grams(t.decode() if t else "", 3)
        want.update((k, bucket(f, 10_000)) for f in features)
        assert words[k] == len(found)
    assert got == want


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, "a b", "")], SCHEMA)
    assert I.resample(none, some).count() == 0
    assert [r.rank for r in I.resample(some, none, min_words=1, percent=100).collect()] == [1]


def test_registered(spark):
    out = E.queries()["op12_importance_resampling"](spark, "/root/testdata/sf0.001")
    assert out.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert out.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
