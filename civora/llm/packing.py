"""Harmonic packing of tokenized documents into fixed-capacity sequences.

Lengths are classed by reciprocals of the capacity C: class k holds pieces of
at most C/k tokens, and a bin of class k is closed as soon as it holds k
pieces, whatever else arrives. A worker therefore fills its bins alone, with at
most k - 1 pieces waiting per class: no shuffle, no coordination, and state
bounded by the capacity times the number of classes.

Plain harmonic packing wastes up to half a bin when a length lies just above
a reciprocal. Documents may be cut freely, so a remainder r that would leave
more than ``slack`` of a bin unused is cut at the next reciprocal below it:
the piece C//(k+1) fills its class exactly and the rest goes on. What still
waits when a worker's input ends is laid out end to end; the last tokens are
cut into sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CAPACITY = 2048
EOS_ID = 1
SLACK = 1 / 64
TOKENIZER = "word_bpe_49k.json"

# Latin text without combining marks: lower-casing and normalising leave its pre-tokens
# as this pattern finds them, if the lower-cased text stays in the range (Ə and some other
# capitals leave it). Any other text goes to the tokenizer whole.
_LATIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-įı-ɏ]*")
_PRETOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ɏ]+|[0-9]|[^ \t\n\ra-z0-9ß-öø-ɏ]+")
_CACHE_WORDS = 600_000
_BATCH_ROWS = 2_000


def default_tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


class Encoder:
    """Texts to little-endian uint32 id strings, equal to the tokenizer's own.

    The tokenizer lower-cases, drops white space and merges inside pre-tokens
    only, so the ids of a text are the ids of its pre-tokens one after the
    other: the model encodes each distinct pre-token once, afterwards it is
    looked up. Texts outside the plain Latin range, or that may hold a special
    token, are encoded whole. The table is emptied when it exceeds
    ``_CACHE_WORDS``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer
        self.tok, self.known = Tokenizer.from_file(path), {}
        self.merge, self.normal, self.split = (self.tok.model.tokenize, self.tok.normalizer.normalize_str,
                                               self.tok.pre_tokenizer.pre_tokenize_str)

    def _learn(self, words) -> None:
        for w in words:  # ASCII pre-tokens reach the model as they are
            parts = (w,) if w.isascii() else [x for x, _ in self.split(self.normal(w))]
            self.known[w] = array("I", [t.id for x in parts for t in self.merge(x)]).tobytes()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > _CACHE_WORDS:
            self.known.clear()
        out, get = [], self.known.get
        for t in texts:
            if "<|" in t or not _LATIN.fullmatch(t) or not _LATIN.fullmatch(low := t.lower()):
                out.append(self._whole(t))
                continue
            words = _PRETOKEN.findall(low)
            ids = list(map(get, words))
            if None in ids:
                self._learn({w for w, i in zip(words, ids) if i is None})
                ids = map(get, words)
            out.append(b"".join(ids))
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker: later tasks find the words of earlier ones."""
    return Encoder(path)


def cuts(r: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[tuple[int, int]]:
    """(class, length) pieces of a remainder of r < capacity tokens, in order."""
    out = []
    while r:
        k = capacity // r
        if k * r >= capacity * (1 - slack) or r <= capacity * slack:
            out.append((k, r))
            break
        piece = capacity // (k + 1)
        out.append((k + 1, piece))
        r -= piece
    return out


def _powers(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class Packer:
    """One worker's bins. ``add`` and ``close`` yield finished pieces:
    (doc, start, ids, doc_tokens, sequence number, offset)."""

    def __init__(self, capacity: int, slack: float):
        self.capacity, self.slack = capacity, slack
        self.bins: dict[int, list] = {}
        self.sequences = 0

    def _emit(self, pieces):
        at = 0
        for doc, start, ids, total in pieces:
            yield doc, start, ids, total, self.sequences, at
            at += len(ids) // 4
        self.sequences += 1

    def add(self, doc, ids: bytes):
        total, step, start = len(ids) // 4, self.capacity, 0
        while total - start >= step:
            yield from self._emit([(doc, start, ids[4 * start:4 * (start + step)], total)])
            start += step
        for k, n in cuts(total - start, step, self.slack):
            waiting = self.bins.setdefault(k, [])
            waiting.append((doc, start, ids[4 * start:4 * (start + n)], total))
            start += n
            if len(waiting) == k:
                yield from self._emit(self.bins.pop(k))

    def close(self):
        rest = [p for k in sorted(self.bins) for p in self.bins[k]]
        self.bins = {}
        left = sum(len(p[2]) // 4 for p in rest)
        room = [self.capacity] * (left // self.capacity) + _powers(left % self.capacity)
        rest.reverse()
        for size in room:
            now = []
            while size:
                doc, start, ids, total = rest.pop()
                n = min(size, len(ids) // 4)
                now.append((doc, start, ids[:4 * n], total))
                if 4 * n < len(ids):
                    rest.append((doc, start + n, ids[4 * n:], total))
                size -= n
            yield from self._emit(now)


def pack(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY,
         eos_id: int = EOS_ID, slack: float = SLACK, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Pieces of every document: id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit
    integers; every document ends with ``eos_id``. Sequence ids are the worker's
    partition number times 2^33 plus a running number. Rows depend only on the
    partition's rows and their order, so a lost task makes the same pieces again
    when its input does (a file scan does).

    A null text is an empty text: one piece holding only ``eos_id``. Repeated
    rows and ties of ids are packed each on their own; a null id stays null; an
    empty table gives no rows; other columns are ignored, whatever their names.
    Very long texts leave as full sequences and never wait in a bin.
    """
    path = tokenizer_path or default_tokenizer_path()
    src = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType())])
    end = eos_id.to_bytes(4, "little")

    def run(batches):
        enc, packer = encoder(path), Packer(capacity, slack)
        base = TaskContext.get().partitionId() << 33
        kind = None

        def table(rows):
            doc, start, ids, total, seq, at = zip(*rows)
            return pa.RecordBatch.from_arrays([
                pa.array(doc, kind), pa.array(start, pa.int64()),
                pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                pa.array(total, pa.int64()), pa.array([base + s for s in seq], pa.int64()),
                pa.array(at, pa.int64())], names=schema.names)

        for batch in batches:
            kind = batch.schema.field(0).type
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                rows = []
                for doc, ids in zip(part.column(0).to_pylist(), enc.encode(part.column(1).to_pylist())):
                    rows.extend(packer.add(doc, ids + end))
                    if len(rows) >= _BATCH_ROWS:
                        yield table(rows)
                        rows = []
                if rows:
                    yield table(rows)
        rows = list(packer.close())
        if rows:
            yield table(rows)

    return src.mapInArrow(run, schema)
