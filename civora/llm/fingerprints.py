"""Merkle-tree document fingerprints.

A text is cut, without losing a character, into sections, paragraphs (lines)
and leaves (sentences, at most 64 characters before a cut). A section starts at
a blank line or a Markdown heading, or after a paragraph whose digest says so,
so that section borders move with the text. Leaves are hashed, a paragraph's
digest covers its leaves', a section's its paragraphs', the root its sections'.

A fingerprint is the tree in text form::

    root;section:paragraph=leaf.len,leaf.len&paragraph=...;section:...

Equal roots mean equal texts. Where roots differ, only branches whose digests
differ are opened, down to the leaves that were edited. The likeness of two
fingerprints is the share of characters under leaves they have in common.
"""

from __future__ import annotations

import re
from collections import Counter
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civora.llm.common import partitions

_PARAGRAPH = re.compile(r"[^\n]*\n|[^\n]+")
_LEAF = re.compile(r"(?s)[^.!?。！？]{1,64}(?:[.!?。！？]+\s*)?|[.!?。！？]+\s*")
_START = re.compile(r"\s*$|#{1,6} ")
_ROWS = 256


def _digest(data: bytes) -> bytes:
    return blake2b(data, digest_size=16).digest()


def _paragraph(text: str) -> tuple[bytes, str]:
    """Digest of a paragraph and its branch in text form."""
    leaves = _LEAF.findall(text)
    digests = [_digest(x.encode("utf-8", "surrogatepass")) for x in leaves]
    node = _digest(b"P" + b"".join(digests))
    names = ",".join([f"{d[:4].hex()}.{len(x):x}" for d, x in zip(digests, leaves)])
    return node, f"{node[:4].hex()}={names}"


def fingerprint(text: str | None, seen: dict | None = None) -> str:
    """The Merkle tree of a text (null: of the empty text).

    ``seen`` keeps paragraphs already hashed, for texts that share some.
    """
    seen = {} if seen is None else seen
    sections, now, fresh = [], [], True
    for p in _PARAGRAPH.findall(text or ""):
        node = seen.get(p)
        if node is None:
            node = seen[p] = _paragraph(p)
        if now and (fresh or _START.match(p)):
            sections.append(now)
            now = []
        now.append(node)
        fresh = node[0][0] < 32
    if now:
        sections.append(now)
    digests = [_digest(b"S" + b"".join([n[0] for n in s])) for s in sections]
    root = _digest(b"R" + b"".join(digests)).hex()
    return ";".join([root] + [f"{d[:4].hex()}:" + "&".join([n[1] for n in s]) for d, s in zip(digests, sections)])


def _parse(fp: str) -> list[tuple[str, list[tuple[str, list[tuple[str, int]]]]]]:
    out = []
    for s in fp.split(";")[1:]:
        name, body = s.split(":")
        paragraphs = []
        for p in body.split("&"):
            digest, leaves = p.split("=")
            paragraphs.append((digest, [(x, int(x[9:], 16)) for x in leaves.split(",")]))
        out.append((name, paragraphs))
    return out


_TOKEN = re.compile(r"[0-9a-f]{8}\.([0-9a-f]+)")


def _leaves(fp: str) -> Counter:
    return Counter(m.group(0) for m in _TOKEN.finditer(fp))


def _chars(leaves: Counter) -> int:
    return sum(int(x[9:], 16) * n for x, n in leaves.items())


def likeness(a: str, b: str) -> float:
    """Share of characters under common leaves: 1 for equal trees, 0 for nothing in common."""
    if a[:32] == b[:32]:
        return 1.0
    x, y = _leaves(a), _leaves(b)
    total = _chars(x) + _chars(y)
    return min(1.0, 2.0 * _chars(x & y) / total) if total else 1.0


def edits(a: str, b: str) -> list[tuple[int, int]]:
    """Character ranges of the first text whose leaves the second one lacks.

    Opens a section only if no section of the other tree has its digest, and
    so on below; neighbouring ranges are joined.
    """
    if a[:32] == b[:32]:
        return []
    other = _parse(b)
    sections = Counter(s for s, _ in other)
    paragraphs = Counter(p for _, ps in other for p, _ in ps)
    leaves = Counter(x for _, ps in other for _, xs in ps for x, _ in xs)
    out, at = [], 0

    def spend(pool, key):
        pool[key] -= 1
        return pool[key] >= 0

    for s, ps in _parse(a):
        whole = spend(sections, s)
        for p, xs in ps:
            known = whole or spend(paragraphs, p)
            for x, n in xs:
                if not (known or spend(leaves, x)):
                    if out and out[-1][1] == at:
                        out[-1] = (out[-1][0], at + n)
                    else:
                        out.append((at, at + n))
                at += n
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row; a null text counts as empty."""
    schema = T.StructType([docs.schema[id_col], T.StructField("fingerprint", T.StringType())])

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([fingerprint(t) for t in b.column(1).to_pylist()], pa.string())],
                names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_bucket, _guest, _key, text) such that, sorted by these, every row is followed by the next
    document in descending id order, ties by content; after the last comes the first.

    Rows go to range buckets of the key; a bucket's first row is sent to the
    bucket before it too, as its last ("guest") row. Texts cross the network
    once. Bounds come from a range partitioning of the keys alone.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"))
    n = 3 * partitions(spark)
    keys = docs.select(key.alias("_key")).repartitionByRange(n, F.col("_key").desc())
    firsts = (keys.groupBy(F.spark_partition_id().alias("p")).agg(F.max("_key").alias("k"))
              .orderBy(F.col("k").desc()).collect())  # one row per partition
    kind = docs.schema[id_col].dataType
    bounds = [F.struct(F.lit(r["k"]["id"]).cast(kind).alias("id"), F.lit(r["k"]["h"]).cast("long").alias("h"))
              for r in firsts]
    rows = docs.select(key.alias("_key"), text.alias("text"))
    if not bounds:
        return rows.select(F.lit(0).alias("_bucket"), F.lit(0).alias("_guest"), "_key", "text")
    table = F.array(*bounds)
    steps = F.array(*[F.lit(1 << b) for b in range(len(bounds).bit_length(), -1, -1)])
    # binary search: the number of bounds that are not below the key, less one
    own = F.aggregate(steps, F.lit(0), lambda at, s: F.when(
        (at + s <= len(bounds)) & (F.get(table, at + s - 1) >= F.col("_key")), at + s).otherwise(at)) - 1
    rows = rows.withColumn("_own", own)
    at = F.array(F.struct(F.col("_own").alias("_bucket"), F.lit(0).alias("_guest")))
    before = F.array(F.struct(F.pmod(F.col("_own") - 1, F.lit(len(bounds))).alias("_bucket"), F.lit(1).alias("_guest")))
    first = F.get(table, F.col("_own")) == F.col("_key")
    places = F.explode(F.when(first, F.concat(at, before)).otherwise(at))
    return rows.withColumn("_at", places).select("_at._bucket", "_at._guest", "_key", "text")


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited form, and how alike they and the next text's are.

    The edited form replaces the last third of the text by the head of the next
    document in descending id order. Rows: id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next, edit_start (first
    character of the text that its tree shows as changed; null if none).

    A null text is empty; its likeness is 1 to an empty text and 0 to others.
    Rows of equal ids follow one another by content, null ids come last, a
    single row is its own next, an empty table gives no rows. Tasks stream
    their rows and hold two texts at a time, however long a bucket is.
    """
    spark = docs.sparkSession
    placed = neighbours(docs, id_col, text_col)
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()), T.StructField("edit_start", T.LongType())])

    def run(batches):
        out, last, kind = [], None, None

        def pair(this, after):
            doc, text, seen, fp = this
            m = len(text) // 3
            edited = text[:len(text) - m] + after[1][:m]
            efp = fingerprint(edited, seen)
            changed = edits(fp, efp)
            return (doc, len(text), sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), fp, efp,
                    likeness(fp, efp), likeness(fp, after[3]), changed[0][0] if changed else None)

        def table():
            cols = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kind if i == 0 else t) for i, (c, t) in enumerate(zip(cols, (
                    None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64())))],
                names=schema.names)

        for b in batches:
            kind = b.schema.field(2).type
            for i in range(0, b.num_rows, _ROWS):
                part = b.slice(i, _ROWS)
                for bucket, guest, doc, text in zip(*(part.column(c).to_pylist() for c in range(4))):
                    if last and last[0] == bucket and last[1]:
                        continue  # the bucket has met its guest
                    seen: dict = {}
                    row = (doc, text, seen, fingerprint(text, seen))
                    if last and last[0] == bucket:
                        out.append(pair(last[2], row))
                    last = (bucket, guest, row)
                if len(out) >= _ROWS:
                    yield table()
        if out:
            yield table()

    sorted_rows = (placed.repartition(partitions(spark), "_bucket")
                   .sortWithinPartitions("_bucket", "_guest", F.col("_key").desc())
                   .select("_bucket", "_guest", F.col("_key.id").alias("_id"), "text"))
    return sorted_rows.mapInArrow(run, schema)
