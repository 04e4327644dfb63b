"""Pipeline on a small table: every stage against its operator's rule, columns, rows at the end."""

import collections

import corpus_pipeline as C
import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns, name
        seen[name] = {r.doc_id: r for r in docs.collect()}
    counts = collections.Counter(r.doc_id for r in docs.collect())
    toxic, near, cut, mixed = seen.values()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(toxic) > 150 and sum(labels.get(i) == 0 for i in toxic) >= 0.97 * sum(v == 0 for v in labels.values())
    assert near.keys() <= toxic.keys() and len({r.text for r in near.values()}) == len(near)
    assert cut.keys() == near.keys() and all(r.n_chars == len(r.text) <= len(near[i].text) for i, r in cut.items())
    windows = collections.Counter()
    for r in near.values():
        b = r.text.encode()
        windows.update({b[k:k + 200] for k in range(len(b) - 199)})
    for r in cut.values():  # no long passage of two documents is left
        b = r.text.encode()
        original = near[r.doc_id].text.encode()
        assert not any(windows[b[k:k + 200]] > 1 for k in range(len(b) - 199) if b[k:k + 200] in original)
    assert mixed.keys() <= cut.keys() and max(counts.values()) <= 3
    pieces = C.STAGES[-1][1](spark, docs, SF).collect()
    assert collections.Counter({k: 0 for k in counts}) | collections.Counter(
        p.doc_id for p in pieces if p.start + p.length == p.doc_tokens) == counts


def test_registered():
    assert "pipeline" in E.queries() and (C.ORACLE_SQL is None) == ("pipeline" not in E.oracle_sql())
    assert all(any(n.startswith(f"op{k}_") for n in E.queries()) for k in range(1, 11))


def test_stages_keep_columns_of_any_name(spark):
    """Every stage but the last over nulls, an empty text, repeated rows and columns named like its own."""
    names = ["_suffix_key", "_SUFFIX_TEXT", "_suffix_null", "_near_id", "_near_key", "_near_n", "_near_size", "_mix", "_mix_own",
             "_mix_size", "_mix_source", "_mix_total", "mix_size", "mix_copies", "_toxicity", "key", "id", "band", "component"]
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(1, long, "en", "a"), (1, long, "en", "a"), (2, None, None, None), (3, "", "en", "a"), (4, "a few plain words", "de", "b"),
            (None, "words without an id", "en", "b")]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame([r + tuple(f"{n}{i}" for n in names) for i, r in enumerate(rows)], schema)
    for table in (docs, docs.limit(0)):
        for name, stage in C.STAGES[:-1]:
            out = stage(spark, table, SF)
            assert out.columns == docs.columns, name
            got = out.collect()
            assert all(r["_near_n"] == "_near_n" + r["mix_copies"][10:] for r in got), name  # extra columns stay with their rows
            if name == "toxicity":
                assert len(got) == table.count()
            if name == "MinHash near-dedup":
                assert sorted(str(r.doc_id) for r in got) == (["1", "2", "3", "4", "None"] if got else [])
        C.STAGES[-1][1](spark, table, SF).collect()
