"""Exact repeated passages by a depth-limited most-significant-digit radix sort of suffixes.

A suffix matters only through its first LENGTH bytes (its window): two
suffixes that agree so far are equal here, and the groups of equal suffixes
are exactly the repeated windows. The sort goes by digits of growing width and
stops at that depth; a group of one suffix leaves at once, a group whose
members agree to full depth is settled at once.

* First digit: the anchor, the 48-byte string of the window whose hash is the
  least. Equal windows have equal anchors at equal places, and neighbouring
  windows share one, so a run of windows (a block) moves as a single row.
* Second digit: the 176 bytes that 25 neighbouring windows of a block have in
  common, for blocks in groups that the first digit leaves mixed.
* Third digit: all LENGTH bytes of each window of the runs still mixed. Runs
  of one content repeat as a whole and are settled before; one text's runs
  stand for all of them, as partners of the runs that are still open.

Each pass counts its groups with partial sums and joins the counts back, so no
group is collected in one task. The rows of a group that holds much of a pass
are dealt over several keys of that join. Digits are 64-bit hashes; a later digit is only compared within the
groups of the earlier ones, which makes 128 bits for every decision.

Equal texts are one text with a count. Texts are compressed and shuffled once,
into a table bucketed by content key, and every pass reads its buckets.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civora.llm.common import partitions, shared_path, shared_table, slices, text_key, tidy, unused
from civora.llm.probminhash import mix64

LENGTH = 200
ANCHOR = 48
STEP = 25

_BUFFER = 1 << 20
_PIECE = 1 << 22  # longer texts are cut into overlapping pieces
_PLACE = np.uint64((1 << 24) - 1)
_BASE = 0xD1342543DE82EF95
_BACK = pow(_BASE, -1, 1 << 64)
_SALT = np.uint64(0x9E3779B97F4A7C15)


def pack(text: bytes) -> bytes:
    return pa.compress(text, codec="zstd", asbytes=True)


def unpack(data: bytes, n: int) -> bytes:
    return pa.decompress(data, decompressed_size=n, codec="zstd", asbytes=True) if n else b""


class Roller:
    """Hashes of any substring of a buffer from prefix sums."""

    def __init__(self):
        self.table = np.random.default_rng(4).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.power = self.back = np.ones(0, np.uint64)

    def load(self, data: np.ndarray):
        if len(self.power) < len(data) + 1:
            size = max(len(data) + 1, min(2 * len(data), _BUFFER + LENGTH))
            for name, base in (("power", _BASE), ("back", _BACK)):
                x = np.full(size, base, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.power[:len(data)], out=self.sums[1:])

    def hash(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix64((self.sums[stop] - self.sums[start]) * self.back[start] + (stop - start).astype(np.uint64))


def _least(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours, by running minima forwards and backwards in chunks of w."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - w + 1], ahead[w - 1:n])


def blocks(roller: Roller, pieces: list[bytes]):
    """Blocks of the pieces: piece, anchor hash, content hash, start, windows, anchor offset."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    ends = np.cumsum([len(p) for p in pieces])
    starts = ends - np.array([len(p) for p in pieces])
    valid = np.zeros(max(0, len(data) - LENGTH + 1), bool)
    for a, b in zip(starts.tolist(), ends.tolist()):
        if b - a >= LENGTH:
            valid[a:b - LENGTH + 1] = True
    windows = np.flatnonzero(valid)
    if not len(windows):
        return (np.empty(0, np.int64),) * 6
    roller.load(data)
    at = np.arange(len(data) - ANCHOR + 1)
    anchor = roller.hash(at, at + ANCHOR)
    rank = (anchor & ~_PLACE) | at.astype(np.uint64)
    owner = (_least(rank, LENGTH - ANCHOR + 1)[windows] & _PLACE).astype(np.int64)
    fresh = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (windows[1:] != windows[:-1] + 1))))
    first = windows[fresh]
    count = np.diff(np.concatenate((fresh, [len(windows)])))
    place = owner[fresh]
    offset = place - first
    content = mix64(roller.hash(first, first + count - 1 + LENGTH) + _SALT * (offset * 256 + count).astype(np.uint64))
    piece = np.searchsorted(starts, first, side="right") - 1
    return piece, anchor[place], content, first - starts[piece], count, offset


def code(start, count, offset):
    """A run of windows as one number."""
    return (start << 16) | (count << 8) | offset


def decode(at):
    return at >> 16, (at >> 8) & 255, at & 255


def runs_of(roller: Roller, base: int, at: np.ndarray):
    """Second digit: runs of at most STEP windows of the blocks ``at`` of the text at ``base``."""
    start, count, offset = decode(at)
    high, low = offset, offset - count + 1
    each = high // STEP - low // STEP + 1
    row = np.repeat(np.arange(len(at)), each)
    j = (low // STEP)[row] + np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    place = (start + offset)[row]
    top, bottom = np.minimum(high[row], STEP * j + STEP - 1), np.maximum(low[row], STEP * j)
    core = base + place - STEP * j
    digit = mix64(roller.hash(core, core + LENGTH - STEP + 1) + _SALT * j.astype(np.uint64))
    begin, size = place - top, top - bottom + 1
    content = mix64(roller.hash(base + begin, base + place - bottom + LENGTH) + _SALT * (top * 256 + size).astype(np.uint64))
    return digit, content, code(begin, size, top)


def windows_of(roller: Roller, base: int, at: np.ndarray):
    """Third digit: every window of the runs ``at``, within the run's second digit."""
    start, count, offset = decode(at)
    row = np.repeat(np.arange(len(at)), count)
    k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    begin, place = start[row] + k, offset[row] - k
    core = base + begin + place - STEP * (place // STEP)
    digit = mix64(roller.hash(core, core + LENGTH - STEP + 1) + _SALT * (place // STEP).astype(np.uint64))
    full = mix64(roller.hash(base + begin, base + begin + LENGTH) + _SALT * place.astype(np.uint64))
    return digit, full, code(begin, np.ones_like(begin), place)


_DIGITS = "digit long, content long, key binary, at long"


def _digit_batch(digit, content, keys, at):
    return pa.RecordBatch.from_arrays(
        [pa.array(digit.view(np.int64)), pa.array(content.view(np.int64)), keys, pa.array(at.astype(np.int64))],
        names=["digit", "content", "key", "at"])


def distinct_texts(docs: DataFrame) -> DataFrame:
    """Table (key, n, data, copies) of the distinct texts, bucketed by key in the shared folder."""
    spark = docs.sparkSession

    def run(batches):
        for b in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(t) for t in texts], pa.int64()),
                                              pa.array([pack(t) for t in texts], pa.binary())], names=["key", "n", "data"])

    packed = docs.select("key", "text").mapInArrow(tidy(run), "key binary, n long, data binary")
    one = packed.groupBy("key").agg(F.first("n").alias("n"), F.first("data").alias("data"), F.count(F.lit(1)).alias("copies"))
    name = f"civora_texts_{uuid.uuid4().hex}"
    n = partitions(spark)
    one.repartition(n, "key").write.bucketBy(n, "key").option("path", shared_path(spark, "texts")).saveAsTable(name)
    return spark.table(name)


def _first_digit(texts: DataFrame) -> DataFrame:
    def run(batches):
        roller = Roller()
        for b in batches:
            keys, sizes, data = b.column(0), b.column(1).to_pylist(), b.column(2)
            pieces = [(i, c) for i, n in enumerate(sizes) if n >= LENGTH
                      for c in range(0, max(1, n - LENGTH + 1), _PIECE)]
            spans = [min(_PIECE + LENGTH - 1, sizes[i] - c) for i, c in pieces]
            for x, y in slices(spans, _BUFFER):
                part, text, at = [], b"", -1
                for (i, c), size in zip(pieces[x:y], spans[x:y]):
                    if i != at:
                        text, at = unpack(data[i].as_py(), sizes[i]), i
                    part.append(text[c:c + size])
                piece, digit, content, start, count, offset = blocks(roller, part)
                if len(piece):
                    rows = np.array([i for i, _ in pieces[x:y]])[piece]
                    start = start + np.array([c for _, c in pieces[x:y]])[piece]
                    yield _digit_batch(digit, content, keys.take(pa.array(rows)), code(start, count, offset))

    return texts.where(F.col("n") >= LENGTH).select("key", "n", "data").mapInArrow(tidy(run), _DIGITS)


def _next_digit(texts: DataFrame, mixed: DataFrame, digits) -> DataFrame:
    """Rows of the next pass for the mixed rows (key, at): their texts are met in their buckets."""
    todo = mixed.groupBy("key").agg(F.collect_list("at").alias("ats"))  # at most a text's length

    def run(batches):
        roller = Roller()
        for b in batches:
            sizes = b.column(1).to_pylist()
            for x, y in slices(sizes, _BUFFER):
                text = [unpack(b.column(2)[i].as_py(), sizes[i]) for i in range(x, y)]
                roller.load(np.frombuffer(b"".join(text), np.uint8))
                base, out = 0, []
                for i in range(x, y):
                    got = digits(roller, base, np.array(b.column(3)[i].as_py(), np.int64))
                    out.append((*got, np.full(len(got[2]), i)))
                    base += sizes[i]
                digit, content, at, rows = (np.concatenate(c) for c in zip(*out))
                for s in range(0, len(at), 50_000):
                    e = s + 50_000
                    yield _digit_batch(digit[s:e], content[s:e], b.column(0).take(pa.array(rows[s:e])), at[s:e])

    return texts.join(todo.hint("shuffle_hash"), "key").select("key", "n", "data", "ats").mapInArrow(tidy(run), _DIGITS)


def _with_groups(rows: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` (..., key, at) joined with their ``groups`` (by, n, ...), hot groups dealt over several keys.

    A group is hot if it has more than its share, 1 / (4 x partitions), of all
    grouped rows. Fewer than 4 x partitions groups can be hot: their table is
    broadcast, and each has as many keys as it has shares.
    """
    total = groups.agg(F.sum("n")).first()[0] or 0
    share = max(1, total // (4 * partitions(rows.sparkSession)))
    keys = F.ceil(F.col("n") / share).cast("int")
    hot = groups.where(F.col("n") > share).select(*by, keys.alias("keys"))
    dealt = (rows.join(F.broadcast(hot), by, "left")
             .withColumn("deal", F.pmod(F.xxhash64("key", "at"), F.coalesce("keys", F.lit(1))).cast("int")).drop("keys"))
    return dealt.join(groups.withColumn("deal", F.explode(F.sequence(F.lit(0), keys - 1))), [*by, "deal"])


def _pass(rows: DataFrame, full: bool, name: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, at, whole) of the rows in groups of two or more; whole: the group agrees to full depth.

    At the last digit a group is a digit and its content, and always whole.
    ``carry`` names columns of the rows to keep.
    """
    by = ["digit", "content"] if full else ["digit"]
    groups = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("content").alias("lo"), F.max("content").alias("hi"))
    groups = groups.where("n > 1").select(*by, "n", (F.col("lo") == F.col("hi")).alias("whole"))
    names = [*by, *(c for c in carry if c not in by)]
    both = _with_groups(rows.select(*names, "key", "at"), shared_table(groups, name + "-groups"), by)
    return shared_table(both.select(*carry, "key", "at", "whole"), name)


def _settle(mixed: DataFrame, name: str) -> DataFrame:
    """(key, at, settled, open) of mixed rows (digit, content, key, at).

    settled: another row of the group has the same content, so all its windows
    repeat. open: the row goes to the next digit; rows of one content go only
    as those of one text, which other contents of the group are compared with.
    """
    text = F.xxhash64("key")
    cells = mixed.groupBy("digit", "content").agg(F.count(F.lit(1)).alias("n"), F.min(text).alias("one"))
    both = _with_groups(mixed.select("digit", "content", "key", "at"), shared_table(cells, name + "-cells"), ["digit", "content"])
    return shared_table(both.select("key", "at", (F.col("n") > 1).alias("settled"), (text == F.col("one")).alias("open")), name)


_KEPT = "key binary, n_bytes long, n_removed long, spans array<struct<start:long,stop:long>>, kept binary"


def removed_spans(at: list[int], n: int, whole: bool) -> list[tuple[int, int]]:
    """Maximal runs of bytes that repeated windows cover."""
    if whole:
        return [(0, n)] if n else []
    out: list[list[int]] = []
    for start, count in sorted((a >> 16, (a >> 8) & 255) for a in at or ()):
        stop = start + count - 1 + LENGTH
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def _between(text: bytes, spans) -> bytes:
    at, keep = 0, []
    for a, b in spans:
        keep.append(text[at:a])
        at = b
    return b"".join([*keep, text[at:]])


def whole_characters(text: bytes, spans) -> list[tuple[int, int]]:
    """Spans shrunk to whole UTF-8 characters."""
    out = []
    for a, b in spans:
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def repeats(docs: DataFrame, characters: bool = False) -> DataFrame:
    """(key, n_bytes, n_removed, spans, kept) of every distinct text of docs(key, text).

    ``characters``: spans are shrunk to whole characters, so what is kept is text.
    """
    texts = distinct_texts(docs)
    first = _pass(_first_digit(texts), False, "suffix-first")
    second = _pass(_next_digit(texts, first.where("not whole"), runs_of), False, "suffix-second", ("digit", "content"))
    rest = _settle(second.where("not whole"), "suffix-rest")
    third = _pass(_next_digit(texts, rest.where("open"), windows_of), True, "suffix-third")
    repeated = [first.where("whole"), second.where("whole"), rest.where("settled"), third]
    found = (reduce(DataFrame.unionByName, [t.select("key", "at") for t in repeated])
             .groupBy("key").agg(F.collect_list("at").alias("ats")))

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for b in batches:
            for x in range(0, b.num_rows, 500):
                p = b.slice(x, 500)
                sizes, copies, ats = (p.column(i).to_pylist() for i in (1, 3, 4))
                spans, kept = [], []
                for i, n in enumerate(sizes):
                    text = unpack(p.column(2)[i].as_py(), n)
                    s = removed_spans(ats[i], n, copies[i] > 1 and n >= LENGTH)
                    s = whole_characters(text, s) if characters else s
                    spans.append([{"start": a, "stop": e} for a, e in s])
                    kept.append(_between(text, s))
                yield pa.RecordBatch.from_arrays(
                    [p.column(0), p.column(1), pa.array([sum(e["stop"] - e["start"] for e in s) for s in spans], pa.int64()),
                     pa.array(spans, kind), pa.array(kept, pa.binary())],
                    names=["key", "n_bytes", "n_removed", "spans", "kept"])

    return (texts.join(found.hint("shuffle_hash"), "key", "left").select("key", "n", "data", "copies", "ats")
            .mapInArrow(tidy(run), _KEPT))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    Every byte covered by a LENGTH-byte string that starts anywhere else too,
    in any text or in the same, is removed; strings are judged on the input.
    A null text is empty; texts shorter than LENGTH keep all; copies of a text
    (repeated rows too) of at least LENGTH bytes lose all; other columns are
    ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("key"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    got = repeats(rows.select("key", "text")).select(
        "key", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"), "spans")
    return rows.select("id", "key").join(got, "key").select(
        F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")


def remove(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut out of the texts, at whole characters; a null text stays null.

    Columns may have any names: the ones needed on the way get names that ``docs`` does not use.
    """
    key, null, cut = (unused(n, docs) for n in ("_suffix_key", "_suffix_null", "_suffix_text"))
    got = repeats(docs.select(text_key(text_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text")),
                  characters=True).select(F.col("key").alias(key), F.decode("kept", "UTF-8").alias(cut))
    rows = docs.select(*[c for c in docs.columns if c != text_col], F.col(text_col).isNull().alias(null),
                       text_key(text_col).alias(key))
    text = F.when(~F.col(null), F.col(cut)).alias(text_col)
    return rows.join(got, key).select(*[text if c == text_col else F.col(c) for c in docs.columns])
