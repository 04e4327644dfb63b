"""Mixing sources to target weights by Pareto order sampling.

Every source gets a share of all words by its weight, at most ``cap`` times
what it has; what a capped source cannot take is shared out again. A document
of expected copies e = target / source size first gets its floor(e) certain
whole copies. The fraction p = e - floor(e) is the inclusion probability of
one copy more: documents are ranked by their random odds u / (1 - u) divided
by their inclusion odds p / (1 - p), and the head of that order is taken until
the source's words are filled (a fixed-size sample, the size measured in
words). One more document, the one whose size comes nearest to what is still
missing, closes the gap.

The head is found without sorting a source: words are summed per cell of the
rank, the cell that crosses the target is split once more, and only the rows
of that last cell are ordered. What crosses the network is one row per source
and cell, so a source holding a third of all rows is no hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civora.llm.common import shared_table, unused

CAP = 3
WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix"
_CELLS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _uniform(id_col: Column, seed: str) -> Column:
    """A number in (0, 1) fixed by the id: 52 bits of an MD5 sum."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2 ** 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = CAP) -> DataFrame:
    """One row per source: _source, _total (words), _weight, _target.

    Sources are ordered by code point, null last, and weigh ``weights`` in
    turn. The order is a range-partitioned sort: a partition's first rank is
    the number of sources in the partitions before it. Targets share all words
    by weight; those above ``cap`` times their source's words stop there and
    the excess is shared again, until none is above.
    """
    per = sizes.groupBy("_source").agg(F.sum("_size").alias("_total"))
    ordered = shared_table(
        per.orderBy(F.col("_source").isNull(), "_source")
           .select("_source", "_total", F.spark_partition_id().alias("_part"),
                   F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_at")), "mix-sources")
    first, before = {}, 0
    for r in ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect():
        first[r["_part"]] = before  # one row per partition
        before += r["n"]
    spark = sizes.sparkSession
    starts = spark.createDataFrame(list(first.items()), "_part int, _first long")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]),
                        ((F.col("_first") + F.col("_at")) % len(weights) + 1).cast("int"))
    ranked = ordered.join(starts, "_part").select("_source", "_total", turn.cast("long").alias("_weight"))
    level, capped = 0.0, -1
    while True:
        above = F.col("_weight") * F.lit(level) > F.col("_total") * cap
        r = ranked.agg(F.sum("_total").alias("all"), F.sum(F.when(above, F.col("_total") * cap)).alias("stopped"),
                       F.sum(F.when(~above, F.col("_weight"))).alias("open"), F.count_if(above).alias("n")).first()
        if r["n"] == capped or not r["open"]:
            break
        capped, level = r["n"], ((r["all"] or 0) - (r["stopped"] or 0)) / r["open"]
    return ranked.withColumn("_target", F.least((F.col("_total") * cap).cast("double"),
                                                F.col("_weight") * F.lit(level)))


def _order(expected: Column, u: Column) -> Column:
    """Pareto rank u/(1-u) / (p/(1-p)) as rank/(1 + rank), in (0, 1); null where p is 0."""
    p = expected - F.floor(expected)
    rank = (u / (1 - u)) / (p / (1 - p))
    return F.when(p > 0, rank / (1 + rank))


def _crossing(rows: DataFrame, room: DataFrame, cell: Column) -> DataFrame:
    """Per source: the first cell whose running words exceed the room, and the words before it."""
    sums = rows.groupBy("_source", cell.alias("_cell")).agg(F.sum("_size").alias("_words"))
    w = Window.partitionBy("_source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    run = sums.withColumn("_run", F.sum("_words").over(w)).join(room, F.col("_source").eqNullSafe(F.col("_s")))
    return (run.where(F.col("_run") > F.col("_room")).groupBy("_s", "_room")
            .agg(F.min(F.struct("_cell", (F.col("_run") - F.col("_words")).alias("_before"))).alias("_x"))
            .select("_s", (F.col("_room") - F.col("_x._before")).alias("_room"), F.col("_x._cell").alias("_cell")))


def plan(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = CAP, seed: str = SEED,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per source: what ``decide`` needs to settle each document alone.

    _source, _total, _target, _whole (certain copies), _stop (rank of the first
    document left out), _extra (the document that closes the gap).
    """
    sized = shared_table(docs.select(
        F.col(source_col).alias("_source"), F.col(id_col).alias("_id"),
        word_count(F.col(text_col)).alias("_size"), _uniform(F.col(id_col), seed).alias("_u")), "mix-sizes")
    targets = shared_table(
        source_targets(sized, weights, cap)
        .withColumn("_expected", F.when(F.col("_total") > 0, F.col("_target") / F.col("_total")).otherwise(F.lit(0.0)))
        .withColumn("_whole", F.floor("_expected"))
        .withColumn("_room", F.col("_target") - F.col("_whole") * F.col("_total")), "mix-targets")
    t = targets.select(F.col("_source").alias("_s"), "_expected")
    ranked = (sized.join(t, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
              .withColumn("_rank", _order(F.col("_expected"), F.col("_u"))).where("_rank is not null")
              .withColumn("_key", F.struct("_rank", F.col("_id"), "_size")))
    coarse, fine = F.floor(F.col("_rank") * _CELLS), F.floor(F.col("_rank") * _CELLS * _CELLS)
    room = targets.select(F.col("_source").alias("_s"), "_room")
    here = F.col("_source").eqNullSafe(F.col("_s"))
    first = _crossing(ranked, room, coarse)
    inside = ranked.join(first.drop("_room"), here & (coarse == F.col("_cell"))).drop("_s", "_cell")
    second = shared_table(_crossing(inside, first.drop("_cell"), fine), "mix-cells")
    last = ranked.join(second, here & (fine == F.col("_cell")))
    w = Window.partitionBy("_source").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    stop = shared_table(
        last.withColumn("_run", F.sum("_size").over(w)).where(F.col("_run") > F.col("_room"))
        .groupBy("_s").agg(F.min(F.struct(F.col("_key"), (F.col("_room") - F.col("_run") + F.col("_size")).alias("_gap")))
                           .alias("_x"))
        .select("_s", F.col("_x._key").alias("_stop"), F.col("_x._gap").alias("_gap")), "mix-stops")
    off = F.abs(F.col("_size") - F.col("_gap"))
    extra = (ranked.join(stop, here).where((F.col("_key") >= F.col("_stop")) & (off < F.col("_gap")))
             .groupBy("_s").agg(F.min(F.struct(off.alias("_off"), F.col("_key"))).alias("_x"))
             .select(F.col("_s").alias("_s2"), F.col("_x._key").alias("_extra")))
    return (targets.join(stop.drop("_gap"), here, "left").drop("_s")
            .join(extra, F.col("_source").eqNullSafe(F.col("_s2")), "left").drop("_s2")
            .select(F.col("_source").alias("_mix_source"), F.col("_total").alias("_mix_total"),
                    F.col("_target").alias("_mix_target"), F.col("_expected").alias("_mix_expected"),
                    F.col("_whole").alias("_mix_whole"), F.col("_stop").alias("_mix_stop"),
                    F.col("_extra").alias("_mix_extra")))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = CAP, seed: str = SEED,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Every row of ``docs`` plus mix_size, mix_source_size, mix_target, mix_copies.

    Only the small table of sources is joined, so texts stay where they are
    (broadcast when Spark measures it as small, else a join by source whose
    hot source adaptive execution splits).

    A null text has size 0; null sources form one source, last in order; a
    null id is drawn like any other. Repeated rows share one draw: they are
    taken or left together. A source without words has target 0. Columns that
    are called like the added ones are replaced; an empty table gives no rows.
    """
    docs = docs.drop("mix_size", "mix_source_size", "mix_target", "mix_copies")
    both, at = _drawn(docs, weights, cap, seed, id_col, text_col, source_col)
    return both.select(*docs.columns, *[F.col(at)[c].alias(c) for c in ("mix_size", "mix_source_size", "mix_target", "mix_copies")])


def _drawn(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = CAP, seed: str = SEED, id_col: str = "doc_id",
           text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, str]:
    """``docs`` and one more column, a struct of what ``mix`` adds, under a name that ``docs`` does not use."""
    chosen = shared_table(plan(docs, weights=weights, cap=cap, seed=seed, id_col=id_col, text_col=text_col,
                               source_col=source_col), "mix-plan")
    size, own, out = (unused(n, docs) for n in ("_mix_size", "_mix_own", "_mix"))
    chosen = chosen.select(F.struct(*chosen.columns).alias(own))
    both = (docs.withColumn(size, word_count(F.col(text_col)))
            .join(chosen, F.col(source_col).eqNullSafe(F.col(own)["_mix_source"]), "left"))
    rank = _order(F.col(own)["_mix_expected"], _uniform(F.col(id_col), seed))
    key = F.struct(rank, F.col(id_col), F.col(size))
    drawn = rank.isNotNull() & (F.coalesce(key < F.col(own)["_mix_stop"], F.lit(True))
                                | F.coalesce(key == F.col(own)["_mix_extra"], F.lit(False)))
    copies = F.coalesce(F.col(own)["_mix_whole"], F.lit(0)) + drawn.cast("long")
    added = F.struct(F.col(size).alias("mix_size"), F.coalesce(F.col(own)["_mix_total"], F.lit(0)).alias("mix_source_size"),
                     F.coalesce(F.col(own)["_mix_target"], F.lit(0.0)).alias("mix_target"), copies.alias("mix_copies"))
    return both.select(*docs.columns, added.alias(out)), out


def sample(docs: DataFrame, **args) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as it is taken; columns may have any names."""
    both, at = _drawn(docs, **args)
    copies = F.col(at)["mix_copies"]
    times = F.explode(F.sequence(F.lit(1), copies.cast("int")))
    return both.where(copies > 0).select(*docs.columns, times.alias(at)).select(*docs.columns)


def oracle(docs: str = "documents") -> str:
    """The same mix as DuckDB SQL over the view ``docs``."""
    return f"""
    with sized as (
      select doc_id, source,
             coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
             ((('0x' || substr(md5('{SEED}:' || coalesce(cast(doc_id as varchar), 'null')), 1, 13))::bigint) + 0.5::double)
               / 4503599627370496.0::double as u
      from {docs}),
    per as (select source, sum(size)::bigint as total from sized group by source),
    ranked as (
      select source, total,
             1 + (row_number() over (order by source is null, source collate "C") - 1) % 3 as w from per),
    steps as (
      select *, sum(3 * total) over s - 3 * total as stopped,
             sum(w) over (order by (3 * total)::double / w desc, source rows unbounded preceding) as still,
             sum(total) over () as everything
      from ranked window s as (order by (3 * total)::double / w, source desc nulls last rows unbounded preceding)),
    water as (
      select max(lvl) as lvl from (
        select (everything - stopped)::double / still as lvl, (3 * total)::double / w as stops from steps)
      where lvl <= stops),
    targets as (
      select source, total, least((3 * total)::double, w * coalesce(lvl, 0)) as target from ranked, water),
    expected as (
      select *, case when total > 0 then target / total else 0 end as e from targets),
    odds as (
      select z.doc_id, z.source, z.size, t.total, t.target, floor(e)::bigint as whole, e - floor(e) as p,
             t.target - floor(e) * total as room, u
      from sized z join expected t on z.source is not distinct from t.source),
    ranks as (
      select *, case when p > 0 then ((u / (1 - u)) / (p / (1 - p))) / (1 + (u / (1 - u)) / (p / (1 - p))) end as k
      from odds),
    running as (
      select *, sum(size) over (partition by source order by k, doc_id nulls first, size rows unbounded preceding) as run
      from ranks where k is not null),
    gaps as (
      select source, max(case when run <= room then run else 0 end) as got, max(room) as room from running group by source),
    extras as (
      select r.source, true as source_hit, arg_min(r.doc_id, (abs(size - (g.room - got)), k, coalesce(r.doc_id, -1), size)) as doc_id
      from running r join gaps g on r.source is not distinct from g.source
      where run > r.room and abs(size - (g.room - got)) < g.room - got group by r.source)
    select r.doc_id, r.size, r.total as source_size, r.target,
           (r.size * (r.whole + (case when q.run is not null and (q.run <= r.room or x.source_hit) then 1 else 0 end)))::bigint
             as taken
    from ranks r
    left join running q on r.doc_id is not distinct from q.doc_id and r.source is not distinct from q.source
    left join extras x on x.doc_id is not distinct from r.doc_id and x.source is not distinct from r.source
    """
