"""Packing: exact round trip of the ids, bins, little padding, edge rows."""

import numpy as np

from civora.llm import packing

SCHEMA = "doc_id long, text string, length long, start string"


def rows_of(spark, data):
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in data], SCHEMA).coalesce(2)
    return [r.asDict() for r in packing.pack(docs).collect()]


def reference(text):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_tokenizer_path())
    return tok.encode(text or "", add_special_tokens=False).ids + [1]


def test_encoder_equals_the_tokenizer():
    enc = packing.Encoder(packing.default_tokenizer_path())
    texts = ["", "  \n", "It's Ann'S dog, isn't it?", "Straße ÀÉÿ ŉ", "İstanbul ΣΑΣ é á\x1cy",
             "日本語 テスト123", "<|endoftext|> a</w>", "'' ''s 'st $$%% 1234 ²³ Ⅷ", "a b　c\x0bd"]
    assert [np.frombuffer(x, "<u4").tolist() + [1] for x in enc.encode(texts)] == [reference(t) for t in texts]


def test_every_code_point_of_the_short_cut_equals_the_tokenizer():
    enc = packing.Encoder(packing.default_tokenizer_path())
    whole = enc.tok  # the tokenizer itself, read once
    points = [chr(c) for c in range(0x250) if packing._LATIN.fullmatch(chr(c))]
    texts = [f"{c}a{c}b {c}li a{c} 7{c}. {c}" for c in points] + ["Əli Məmmədov", "ƏLI ƊAN ƁIRNI Ɖ", "ȺȾ"]
    assert len(points) > 400 and "Ə" in points
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == want


def test_round_trip_and_bins(spark):
    long = " ".join(f"word{i} the quick" for i in range(2500))
    data = [(1, "one two three"), (2, None), (3, ""), (4, long), (4, long), (None, "no id"), (5, "x" * 5000)]
    data += [(10 + i, " ".join(["alpha beta"] * (i * 7 % 900))) for i in range(60)]
    rows = rows_of(spark, data)
    got: dict = {}
    for r in rows:
        assert r["length"] == len(r["ids"]) // 4 > 0
        got.setdefault(r["doc_id"], []).append((r["start"], np.frombuffer(r["ids"], "<u4").tolist(), r["doc_tokens"]))
    for i, t in data:
        want, copies = reference(t), sum(d[0] == i for d in data)
        pieces = sorted(got[i])
        assert sum(len(p[1]) for p in pieces) == copies * len(want)
        for start, ids, total in pieces:
            assert ids == want[start:start + len(ids)] and total == len(want)
    seqs: dict = {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    padded = used = 0
    for pieces in seqs.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
        used += at
        padded += at if at & (at - 1) == 0 else packing.CAPACITY
    assert used / padded > 0.97


def test_cuts_fill_their_class():
    for r in range(1, packing.CAPACITY):
        pieces = packing.cuts(r)
        assert sum(n for _, n in pieces) == r and len(pieces) <= 5
        for k, n in pieces:
            assert k * n <= packing.CAPACITY and (k + 1) * n > packing.CAPACITY * (1 - 2 * packing.SLACK)


def test_empty_table(spark):
    assert rows_of(spark, []) == []
