"""Source divergence audit: how far each source's words are from the other sources of its language.

Documents are turned into exact sparse count vectors over their language's
vocabulary, as a count vectorizer with a minimum document frequency and the
largest integer as vocabulary size gives them, and the vectors are summed per
(language, source). Unlike ``pyspark.ml``'s ``CountVectorizer``, whose fit takes the
whole vocabulary to the driver and broadcasts it, vocabulary and vectors here
stay distributed tables keyed by the term itself: words grow with the corpus,
so no bound on them would hold. A task counts each document's terms, adds the
vectors of its documents up per (language, source) in bounded tables, and one
shuffle by (language, term) gives the sums and the document frequencies at
once.

Distances between sources are evaluated from the sparse sums. Sources come in
chunks, a language's terms in blocks; one task holds the entries of two chunks
and one block, about ``2 * _CHUNK * _BLOCK`` of them, and returns one number
per pair of sources. Terms that neither source has add a constant each, which
is added at the end. Neither a language nor a source is ever gathered whole.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civora.llm.common import shared_table, tidy

MIN_DF, TOP, SMOOTHING, SCALE = 30, 50, 5, 1_000_000_000
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_GAP = re.compile(rb"[^a-z\x80-\xff]")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_PIECE = 1 << 20  # bytes of text whose terms are listed at once
_HELD = 400_000  # entries of vector sums that a task holds
_CHUNK, _BLOCK, _SALTS = 64, 4096, 64


def _pieces(data: bytes):
    """``data`` in pieces of about ``_PIECE`` bytes, cut between terms."""
    at = 0
    while len(data) - at > _PIECE:
        gap = _GAP.search(data, at + _PIECE)
        if not gap:
            break
        yield data[at:gap.end()]
        at = gap.end()
    yield data[at:]


def _sum_vectors(batches):
    """Per (lang, source, term): occurrences and documents, summed over a task's documents."""
    sums, held = {}, 0

    def flush():
        for (lang, source), (counts, documents) in sums.items():
            if counts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counts), pa.string()), pa.array([source] * len(counts), pa.string()),
                     pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64()),
                     pa.array([documents[t] for t in counts], pa.int64())], names=["lang", "source", "term", "n", "df"])

    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if (lang, source) not in sums:
                sums[lang, source] = Counter(), Counter()
            counts, documents = sums[lang, source]
            held -= len(counts)
            met = set()
            for piece in _pieces(text.as_py().translate(_LOWER)):
                found = _TERM.findall(piece)
                counts.update(found)
                met.update(found)
            documents.update(met)
            held += len(counts)
            if held > _HELD:
                yield from flush()
                sums, held = {}, 0
    yield from flush()


def group_counts(named: DataFrame, min_df: int = MIN_DF) -> DataFrame:
    """lang, source, term, n: occurrences of each kept term in each (lang, source) that has any."""
    sums = (named.select("lang", "source", F.col("text").cast("binary"))
            .mapInArrow(tidy(_sum_vectors), "lang string, source string, term string, n long, df long")
            .repartition("lang", "term").groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("df").alias("df")))
    in_lang = F.sum("df").over(Window.partitionBy("lang", "term"))  # one row per source and term
    return sums.withColumn("df", in_lang).where(F.col("df") >= min_df).drop("df")


def _share(n: str, total: str, v: str, smoothing: int, scale: int) -> Column:
    """1 + floor(scale (n + smoothing) / (total + smoothing v)) in exact decimals."""
    return F.expr(f"1 + (({scale}BD * cast({n} + {smoothing} as decimal(28,0))) div "
                  f"cast({total} + {smoothing} * {v} as decimal(28,0)))")


def _block_distances(pdf: pd.DataFrame) -> pd.DataFrame:
    """Distances over one block of terms between the sources of two chunks (a, b).

    Rows: the entries (term, at, base, p). A pair's figure is the sum, over the
    terms met, of |p - q| less what an unmet term would add.
    """
    a, b = int(pdf["a"].iat[0]), int(pdf["b"].iat[0])
    sources, col = np.unique(pdf["at"].to_numpy(), return_inverse=True)
    row = pd.factorize(pdf["term"])[0]
    base = np.zeros(len(sources), np.int64)
    base[col] = pdf["base"].to_numpy()
    shares = np.tile(base, (row.max() + 1, 1))
    shares[row, col] = pdf["p"].to_numpy()
    left, right = np.flatnonzero(sources // _CHUNK == a), np.flatnonzero(sources // _CHUNK == b)
    out = []
    for i in left:
        others = right[right > i] if a == b else right
        if len(others):
            over = np.abs(shares[:, others] - shares[:, [i]]).sum(0) - len(shares) * np.abs(base[others] - base[i])
            out.append(pd.DataFrame({"i": sources[i], "j": sources[others], "d": over}))
    whole = pd.concat(out) if out else pd.DataFrame({"i": [], "j": [], "d": []})
    whole.insert(0, "lang", pdf["lang"].iat[0])
    return whole.astype({"i": "int64", "j": "int64", "d": "int64"})


def distances(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value for every ordered pair of sources of a language.

    ``groups``: lang, source, at (its place in the language), v, base (the share of
    a term it lacks). ``shares``: lang, at, base, v, term, p of the terms it has.

    An entry of a source meets every chunk of sources of its language once. A
    source that has no term in a block is not among its rows: its difference is
    that of the base shares, which the rows of the other source bring.
    """
    chunks = groups.groupBy("lang").agg((F.floor(F.max("at") / _CHUNK) + 1).alias("chunks"))
    mine = F.floor(F.col("at") / _CHUNK)
    placed = (shares.join(chunks, "lang")
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
              .select("lang", F.least(mine, "other").alias("a"), F.greatest(mine, "other").alias("b"),
                      F.pmod(F.xxhash64("term"), F.ceil(F.col("v") / _BLOCK)).alias("block"), "term", "at", "base", "p"))
    # Every source of the two chunks takes part in every block: one row without a term carries its base.
    seats = (groups.where("v > 0").join(chunks, "lang")
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
             .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("v") / _BLOCK) - 1)))
             .select("lang", F.least(mine, "other").alias("a"), F.greatest(mine, "other").alias("b"), "block",
                     F.lit("").alias("term"), "at", "base", F.col("base").alias("p")))
    summed = (placed.unionByName(seats).groupBy("lang", "a", "b", "block")
              .applyInPandas(_block_distances, "lang string, i long, j long, d long")
              .groupBy("lang", "i", "j").agg(F.sum("d").alias("d")))
    side = [groups.select("lang", "v", F.col("source").alias(s), F.col("at").alias(k), F.col("base").alias(f"base_{k}"))
            for s, k in (("source", "i"), ("item", "j"))]
    pairs = (side[0].join(side[1].drop("v"), "lang").where("i < j").join(summed, ["lang", "i", "j"], "left")
             .select("lang", "source", "item", F.when(F.col("v") > 0, F.coalesce("d", F.lit(0)) + F.col("v") * F.abs(
                 F.col("base_i") - F.col("base_j"))).otherwise(F.lit(0)).cast("long").alias("value")))
    both = F.explode(F.array(F.struct(F.col("source").alias("s"), F.col("item").alias("t")),
                             F.struct(F.col("item").alias("s"), F.col("source").alias("t"))))
    return pairs.select("lang", both.alias("p"), "value").select("lang", F.col("p.s").alias("source"),
                                                                 F.col("p.t").alias("item"), "value")


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_df: int = MIN_DF,
          top: int = TOP, smoothing: int = SMOOTHING, scale: int = SCALE) -> DataFrame:
    """lang, source, part, item, value, rank: distances to other sources, and the terms a source overuses.

    Part ``pair`` ranks all other sources of the language by the summed
    difference of their term shares; part ``term`` the ``top`` terms whose
    share exceeds the language's. Equal values go by the item's bytes.

    Null text, lang or source is ''. Empty texts make a group but no terms; a
    group without kept terms has the share that smoothing gives it; a language
    without kept terms has distances of 0. Repeated rows count as documents of
    their own. Texts of any length are counted whole. Other columns are not
    read, so their names do not matter; an empty table gives no rows.
    """
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(k)
                          for c, k in ((lang, "lang"), (source, "source"), (text, "text"))])
    counts = shared_table(group_counts(named, min_df), "divergence-counts")
    in_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    langs = in_lang.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    place = Window.partitionBy("lang").orderBy("source")
    groups = (named.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .na.fill(0, ["total", "v", "lang_total"])
              .withColumn("at", (F.row_number().over(place) - 1).cast("long"))
              .withColumn("base", F.when(F.col("v") > 0, _share("0", "total", "v", smoothing, scale))))
    groups = shared_table(groups, "divergence-groups")
    shares = shared_table(
        counts.join(groups, ["lang", "source"]).withColumn("p", _share("n", "total", "v", smoothing, scale)),
        "divergence-shares")
    pairs = distances(shares, groups).withColumn("part", F.lit("pair"))
    by_value = [F.col("value").desc(), F.col("item")]
    ranked_pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*by_value)))
    over = (shares.join(in_lang, ["lang", "term"])
            .withColumn("value", F.col("p") - _share("lang_n", "lang_total", "v", smoothing, scale)).where("value > 0")
            .select("lang", "source", F.col("term").alias("item"), "value", F.pmod(F.xxhash64("term"), F.lit(_SALTS)).alias("salt")))
    for keys in (("lang", "source", "salt"), ("lang", "source")):  # the best of each share of the terms, then of all
        over = (over.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*by_value)))
                .where(F.col("rank") <= top))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (ranked_pairs.select(columns)
            .unionByName(over.withColumn("part", F.lit("term")).select(columns))
            .withColumn("rank", F.col("rank").cast("int")))


def oracle() -> str:
    """The audit as DuckDB SQL over ``documents``."""
    term, upper = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
    with docs as (
      select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
             regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{term}') as ts from documents),
    tokens as (select d, lang, source, unnest(ts) as term from docs),
    kept as (select lang, term, count(*) as lang_n from tokens group by lang, term having count(distinct d) >= {MIN_DF}),
    counts as (select lang, source, term, count(*) as n from tokens semi join kept using (lang, term)
               group by lang, source, term),
    langs as (select lang, count(*)::hugeint as v, sum(lang_n)::hugeint as lang_total from kept group by lang),
    groups as (
      select g.lang, g.source, coalesce(v, 0) as v, coalesce(lang_total, 0) as lang_total, coalesce(total, 0)::hugeint as total
      from (select distinct lang, source from docs) g left join langs using (lang)
      left join (select lang, source, sum(n) as total from counts group by all) t using (lang, source)),
    grid as (
      select g.lang, g.source, k.term, coalesce(n, 0) as n,
             1 + ({SCALE}::hugeint * (coalesce(n, 0) + {SMOOTHING})) // (total + {SMOOTHING} * v) as p,
             1 + ({SCALE}::hugeint * (lang_n + {SMOOTHING})) // (lang_total + {SMOOTHING} * v) as q
      from groups g join kept k using (lang) left join counts using (lang, source, term)),
    sums as (
      select x.lang, x.source, y.source as item, sum(abs(x.p - y.p)) as value
      from grid x join grid y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by all),
    parts as (
      select x.lang, x.source, 'pair' as part, y.source as item, coalesce(value, 0)::bigint as value
      from groups x join groups y on x.lang = y.lang and x.source <> y.source
      left join sums s on s.lang = x.lang and s.source = x.source and s.item = y.source
      union all
      select lang, source, 'term', term, (p - q)::bigint from grid where n > 0 and p > q),
    ranked as (
      select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from parts)
    select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= {TOP}
    """
