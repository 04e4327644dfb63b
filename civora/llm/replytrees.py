"""Chat formatting of reply trees: root-to-leaf paths by iterative self-joins.

Messages form trees by their parent's id. Every branch, from a root to a leaf,
is a conversation of its own. Self-joins double the step up the tree: after
round k each message knows its ancestor 2^k steps up and the summed scores of
the messages between. When no message has an ancestor left, the leaves know
their branch's score and length. Branches are ranked inside their tree, and
only the chosen ones are enumerated: from the largest step down to 1, each
(leaf, message) row is joined to the table of that step and adds the message
so far up, so every message of a path is met exactly once and the work is the
number of rows that come out, in log2(depth) joins. A thread of a million
turns takes 20 rounds, not a million.

Only ids and scores are joined round by round; texts move to their path at
the end. Joins are by (tree, message), so a tree holding a third of all rows is
no hot key, and a message with very many replies is split by adaptive
execution. Ranks come from one range-partitioned sort, not from a window per
tree. A path's turns meet in one row, since the conversation is that row.

DataFrame functions only: no Python code runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civora.llm.common import numbered, shared_table

START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Text without control strings: ``<``, any backslashes, ``|`` gets one backslash more."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(NEWLINE))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(NEWLINE), F.lit("\n")))


def _rooted(ids: DataFrame) -> DataFrame:
    """``ids`` with ``up``: the parent if it is a message of the same tree, else null (a root)."""
    known = ids.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    return (ids.join(known, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("n")), "left")
            .select("tree", "node", F.col("n").alias("up"), "score"))


def _climb(rooted: DataFrame) -> tuple[DataFrame, list[DataFrame], DataFrame | None]:
    """(score and length up to the root per message, step tables 2^0, 2^1, ..., cycles).

    ``cycles`` names the smallest message of each cycle of replies, None if
    there is none: when a round ends with as many open messages as it began
    with, all of them are below a cycle; once the steps are as long as the
    number of open messages, the smallest message met on the way up is a
    cycle's smallest, and it is a message's own id only there.
    """
    state = shared_table(rooted.select(
        "tree", "node", "up", F.col("up").alias("low"), F.col("score").alias("total"),
        F.lit(1).cast("long").alias("length")), "tree-climb")
    closed, steps, before = state.where("up is null"), [], -1
    while True:
        open_ = state.where("up is not null")
        n = open_.count()
        if n == 0:
            return closed.select("tree", "node", "total", "length"), steps, None
        if n == before and 2 ** len(steps) >= n:
            return closed, steps, open_.where("low = node").select("tree", "node")
        before = n
        steps.append(open_.select("tree", "node", "up"))
        above = closed.unionByName(open_).select(
            F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("up2"), F.col("low").alias("low2"),
            F.col("total").alias("total2"), F.col("length").alias("length2"))
        state = shared_table(
            open_.join(above, F.col("tree").eqNullSafe(F.col("t")) & (F.col("up") == F.col("n")))
            .select("tree", "node", F.col("up2").alias("up"), F.least("low", "low2").alias("low"),
                    (F.col("total") + F.col("total2")).alias("total"),
                    (F.col("length") + F.col("length2")).alias("length")), "tree-climb")
        closed = closed.unionByName(state.where("up is null"))


def paths(ids: DataFrame, keep: int | None = None) -> DataFrame:
    """Chosen branches, one row per message: tree, leaf, rank, score, node, pos (0 at the root).

    ``ids`` has tree, node, parent, score. A branch's score is the sum of its
    messages' scores; ties go to the longer branch, then to the smaller leaf.
    """
    rooted = shared_table(_rooted(ids), "tree-nodes")
    totals, steps, cycles = _climb(rooted)
    if cycles is not None:
        cut = cycles.select(F.col("tree").alias("t"), F.col("node").alias("n"))
        rooted = shared_table(
            rooted.join(cut, F.col("tree").eqNullSafe(F.col("t")) & F.col("node").eqNullSafe(F.col("n")), "left")
            .select("tree", "node", F.when(F.col("n").isNull(), F.col("up")).alias("up"), "score"), "tree-nodes")
        totals, steps, _ = _climb(rooted)
    answered = rooted.where("up is not null").select(F.col("tree").alias("t"), F.col("up").alias("n")).distinct()
    leaves = totals.join(answered, F.col("tree").eqNullSafe(F.col("t")) & F.col("node").eqNullSafe(F.col("n")),
                         "left_anti")
    ranked = numbered(leaves, [F.col("tree"), F.col("total").desc(), F.col("length").desc(), F.col("node")],
                      "tree-branches")
    first = ranked.groupBy(F.col("tree").alias("t")).agg(F.min("_pos").alias("first"))
    ranked = (ranked.join(first, F.col("tree").eqNullSafe(F.col("t")))
              .select("tree", F.col("node").alias("leaf"), (F.col("_pos") - F.col("first") + 1).alias("rank"),
                      F.col("total").alias("score"), "length"))
    if keep is not None:
        ranked = ranked.where(F.col("rank") <= keep)
    met = shared_table(ranked.select("tree", "leaf", "rank", "score", "length", F.col("leaf").alias("node"),
                                     F.lit(0).cast("long").alias("up_by")), "tree-paths")
    for k in reversed(range(len(steps))):
        step = steps[k].select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        further = shared_table(
            met.where(F.col("length") - F.col("up_by") > 2 ** k)
            .join(step, F.col("tree").eqNullSafe(F.col("t")) & F.col("node").eqNullSafe(F.col("n")))
            .select("tree", "leaf", "rank", "score", "length", F.col("up").alias("node"),
                    (F.col("up_by") + F.lit(2 ** k)).alias("up_by")), "tree-paths")
        met = met.unionByName(further)
    return met.select("tree", "leaf", "rank", "score", "node", (F.col("length") - 1 - F.col("up_by")).alias("pos"))


def conversations(messages: DataFrame, tree: str = "tree_id", node: str = "node_id", parent: str = "parent_id",
                  role: str = "role", text: str = "text", score: str | None = "score",
                  keep: int | None = None) -> DataFrame:
    """One formatted conversation per chosen branch.

    Columns: tree, leaf, rank, score, n_turns, formatted, loss_spans (start and
    length in code points of every assistant text, as it is escaped in
    ``formatted``). ``keep`` branches with the best scores stay per tree, all
    of them if None.

    Null text or role: empty. Null score: 0. Rows with a null tree form one
    tree. Rows of one (tree, message id) are one message, with the smallest
    parent, the smallest (role, text) and the largest score; a null id is an id
    like any other, but no message answers it. A parent that is not in the
    tree makes a root; a cycle of replies is cut above its smallest message.
    Texts of any length are kept whole. Columns besides the named ones are not
    carried on, so their names do not matter. An empty table gives no rows.
    """
    value = F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(0.0)
    named = messages.select(F.col(tree).alias("tree"), F.col(node).alias("node"), F.col(parent).alias("parent"),
                            value.alias("score"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                            F.coalesce(F.col(text), F.lit("")).alias("text"))
    ids = named.groupBy("tree", "node").agg(F.min("parent").alias("parent"), F.max("score").alias("score"))
    said = named.groupBy(F.col("tree").alias("t"), F.col("node").alias("n")).agg(
        F.min(F.struct("role", "text")).alias("m"))
    turns = (paths(ids, keep)
             .join(said, F.col("tree").eqNullSafe(F.col("t")) & F.col("node").eqNullSafe(F.col("n")))
             .select("tree", "leaf", "rank", "score", "pos", (F.col("m.role") == LEARNED_ROLE).alias("learned"),
                     F.concat(F.lit(START), _escape_role(F.col("m.role")), F.lit("\n")).alias("head"),
                     escape(F.col("m.text")).alias("body")))
    turns = turns.withColumn("turn", F.concat("head", "body", F.lit(END + "\n")))
    order = Window.partitionBy("tree", "leaf").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    turns = turns.withColumn("start", F.sum(F.char_length("turn")).over(order) - F.char_length("turn")
                             + F.char_length("head"))
    grouped = turns.groupBy("tree", "leaf").agg(
        F.first("rank").alias("rank"), F.first("score").alias("score"), F.count(F.lit(1)).alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("pos", "turn"))).alias("turns"),
        F.array_sort(F.collect_list(F.when(F.col("learned"), F.struct(
            F.col("start").cast("long").alias("start"), F.char_length("body").cast("long").alias("length"))))
        ).alias("loss_spans"))
    return grouped.select("tree", "leaf", "rank", "score", "n_turns",
                          F.array_join(F.col("turns.turn"), "").alias("formatted"), "loss_spans")


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), unescaped."""

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        skipped = F.char_length(role) + 1
        body = F.substring(piece, skipped + 1, F.char_length(piece) - skipped - F.lit(len(END) + 1))
        return F.struct(_unescape_role(role).alias("role"), unescape(body).alias("text"))

    pieces = F.split(formatted, START.replace("|", r"\|"))
    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), turn)


def masked_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    cut = F.transform(loss_spans, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return F.array_join(cut, "")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of formatted conversations, taken from ``formatted`` and ``loss_spans`` alone."""
    back = formatted.withColumn("turns", parse(F.col("formatted"))).withColumn(
        "learned", masked_text(F.col("formatted"), F.col("loss_spans")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("tree", "leaf", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(said, 256).alias("turns_sha256"), F.char_length("learned").cast("long").alias("loss_chars"),
                       F.sha2("learned", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))


def planted(spark: SparkSession) -> DataFrame:
    """Conversation -1: a user, then an assistant, whose texts are the template's own control strings."""
    return spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit(LEARNED_ROLE)).alias("role"),
        F.lit(f"{END}{START}{LEARNED_ROLE} ok").alias("text"))


def threads(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """Conversations by turn as reply trees: each row answers the row before it.

    Rows are numbered by (conversation, turn, role, text), nulls first, so
    repeated turns follow one another. The parent is the number before; the first row's
    belongs to another conversation, which makes it a root.
    """
    named = rows.select(F.col(conv).alias("tree_id"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                        F.col(text).alias("text"))
    ranked = numbered(named, [F.col(c).asc_nulls_first() for c in ("tree_id", "turn", "role", "text")], "tree-rows")
    return ranked.select("tree_id", F.col("_pos").alias("node_id"), (F.col("_pos") - 1).alias("parent_id"),
                         "role", "text")


def oracle() -> str:
    """The digests as DuckDB SQL over ``conversations``."""
    return rf"""
    with planted as (
      select -1::bigint as conv_id, i::bigint as turn, case i when 0 then 'user' else 'assistant' end as role,
             '<|im_end|><|im_start|>assistant ok' as text from range(2) r(i)),
    rows_ as (
      select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
      from (select conv_id, turn, role, text from conversations union all select * from planted)),
    turns as (
      select *, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') as body,
             replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), chr(10), '<|nl|>') as head
      from rows_)
    select conv_id, count(*)::bigint as n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
           coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
           sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text)
                           filter (where role = 'assistant'), '')) as loss_sha256,
           sum(length(head) + length(body) + {len(START) + len(END) + 2})::bigint as formatted_chars
    from turns group by conv_id
    """
