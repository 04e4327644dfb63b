"""Quality by co-training two views of a document.

The content view sees how words are written: the mix of word masks (letters,
capitals, digits, attached symbols), how varied and how long words are. The
metadata view sees language, source, length and number of lines, nothing of
the text itself. Each view's classifier is fitted on the labelled rows; in
every round each scores all unlabelled rows and labels the ``BATCH`` it is
surest of, and these join the other's training rows. Both scores are then
calibrated on labelled rows kept aside and combined to score all rows.

The unlabelled rows are a table: a round counts the confidences per view and
class in Spark, reads the thresholds off these counts and fetches the rows
above them. At most ``MAX_LABELS`` labelled rows, those with the smallest id
hashes, and ``rounds * BATCH`` pseudo-labelled rows a view are fitted on.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civora.llm.common import portions, shared_table, tidy
from civora.llm.toxicity import held_out, logistic

MAX_LABELS = 9_000
ROUNDS = 4
#: Rows a view labels in a round (split by the classes' shares), and how sure it must be.
BATCH, SURE = 400, 0.95

#: Languages and sources are hashed: where there are more than these, some share a weight.
_MASKS, _LANGS, _SOURCES = 128, 64, 512
#: Cells of the confidence counts, between SURE and the largest logit.
_CELLS, _LARGEST = 1_024, 15.0
_UPPER, _LOWER, _DIGIT = re.compile(r"[^\W\d_a-zß-öø-ÿ]+"), re.compile(r"[a-zß-öø-ÿ]+"), re.compile(r"\d+")
_REPEAT = re.compile(r"([^\w\s])\1+")


def _mask(word: str) -> int:
    if word.isalpha():
        return 0 if word.islower() else 1 if word[1:].islower() else 2
    mask = _REPEAT.sub(r"\1", _DIGIT.sub("9", _UPPER.sub("A", _LOWER.sub("a", word))))
    return 3 + zlib.crc32(mask.encode("utf-8", "surrogatepass")) % (_MASKS - 3)


def content_view(text: str | None, known: dict | None = None) -> np.ndarray:
    """Mask shares, distinct share, mean word length, no words."""
    known = {} if known is None else known
    out = np.zeros(_MASKS + 4)
    words = (text or "").split()
    if not words:
        out[-1] = 1
        return out
    if len(known) > 200_000:
        known.clear()
    distinct: dict[str, int] = {}
    for w in words:
        distinct[w] = distinct.get(w, 0) + 1
    for w, n in distinct.items():
        m = known.get(w)
        if m is None:
            m = known[w] = _mask(w)
        out[m] += n
    out[:_MASKS] = np.sqrt(out[:_MASKS] / len(words))
    out[_MASKS] = len(distinct) / len(words)
    out[_MASKS + 1] = max(distinct.values()) / len(words)
    out[_MASKS + 2] = min(20.0, sum(len(w) * n for w, n in distinct.items()) / len(words)) / 10
    return out


def metadata_view(text: str | None, lang: str | None, source: str | None) -> np.ndarray:
    """Hashed language and source, length, number of lines; ``spread`` turns the hashes into indicators."""
    text = text or ""
    return np.array([zlib.crc32((lang or "").encode()) % _LANGS, zlib.crc32((source or "").encode()) % _SOURCES,
                     np.log1p(len(text)) / 10, np.log1p(text.count("\n")) / 5])


def spread(m: np.ndarray) -> np.ndarray:
    """Rows of ``metadata_view`` with one indicator for each language and source slot."""
    out, rows = np.zeros((len(m), _LANGS + _SOURCES + 2)), np.arange(len(m))
    out[rows, m[:, 0].astype(int)] = 1
    out[rows, _LANGS + m[:, 1].astype(int)] = 1
    out[:, -2:] = m[:, 2:]
    return out


def _scale(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x.mean(0), np.where((s := x.std(0)) > 1e-9, s, 1.0)


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 5.0) -> np.ndarray:
    """Weights on raw features (constant first) of a ridge logistic regression on scaled ones."""
    mean, scale = _scale(x)
    b = logistic(np.column_stack([np.ones(len(x)), (x - mean) / scale]), y, ridge)
    w = b[1:] / scale
    return np.concatenate([[b[0] - w @ mean], w])


def _logit(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[1:] + w[0], -_LARGEST, _LARGEST)


@dataclass
class Model:
    """Weights of both views and of the logistic combination of their logits."""

    content: np.ndarray
    metadata: np.ndarray
    combined: np.ndarray

    def scores(self, c: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Columns: content score, metadata score, combined score."""
        a, b = _logit(self.content, c), _logit(self.metadata, m)
        z = _logit(self.combined, np.column_stack([a, b]))
        return 1 / (1 + np.exp(-np.column_stack([a, b, z])))


def _cells(weights: list[np.ndarray], views: list[np.ndarray], free: np.ndarray) -> np.ndarray:
    """Per (view, label) and row the cell of its confidence, -1 where it is below SURE or taken.

    Row 2k + label is what view k says; ``free[k]`` marks the rows that view k may still label.
    """
    low = np.log(SURE / (1 - SURE))
    out = []
    for w, x, f in zip(weights, views, free):
        z = _logit(w, x)
        for side in (-z, z):
            cell = np.minimum((side - low) / (_LARGEST - low) * _CELLS, _CELLS - 1).astype(int)
            out.append(np.where(f & (side >= low), cell, -1))
    return np.array(out)


def _counts(cells: np.ndarray) -> np.ndarray:
    return np.array([np.bincount(c[c >= 0], minlength=_CELLS) for c in cells])


def _cuts(counts: np.ndarray, rate: float) -> list[tuple[int, float]]:
    """Per (view, label) the cell from which rows are taken and the share of that cell that still fits."""
    out = []
    for i, n in enumerate(counts):
        room = int(np.ceil(BATCH * (rate if i % 2 else 1 - rate)))
        above = np.cumsum(n[::-1])[::-1] - n  # rows in higher cells
        fits = np.flatnonzero(above < room)
        at = int(fits[0])
        out.append((at, min(1.0, (room - above[at]) / n[at]) if n[at] else 1.0))
    return out


def _above(cells: np.ndarray, u: np.ndarray, cuts: list[tuple[int, float]]) -> np.ndarray:
    """Rows above each threshold; of its own cell those whose draw ``u`` lies below the share."""
    return np.array([(c > at) | ((c == at) & (u < part)) for c, (at, part) in zip(cells, cuts)])


class ArrayPool:
    """Unlabelled rows in memory; the counterpart of ``TablePool`` in tests."""

    def __init__(self, views: list[np.ndarray]):
        self.views, self.u = views, np.arange(len(views[0])) * 0.6180339887 % 1
        self.free = np.ones((2, len(self.u)), bool)

    def surest(self, weights: list[np.ndarray], rate: float) -> list[tuple[int, int, np.ndarray]]:
        """(view that labels, label, the other view of the rows) of this round; they are then taken."""
        cells = _cells(weights, self.views, self.free)
        rows = _above(cells, self.u, _cuts(_counts(cells), rate))
        for i, r in enumerate(rows):
            self.free[i // 2] &= ~r
        return [(i // 2, i % 2, self.views[1 - i // 2][r]) for i, r in enumerate(rows)]


def _matrix(column: pa.Array, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1).astype(float)


class TablePool:
    """Unlabelled rows (key, u, c, m) in Spark: two passes a round, the counts first, then the rows above the cuts."""

    def __init__(self, rows: DataFrame):
        self.rows, self.taken = rows, [[], []]

    def _scan(self, weights, finish, schema: str) -> DataFrame:
        taken = [np.array(t, np.int64) for t in self.taken]

        def run(batches):
            for b in batches:
                if b.num_rows:
                    key, u = (b.column(i).to_numpy() for i in (0, 1))
                    views = [_matrix(b.column(2), np.float32), spread(_matrix(b.column(3), np.float32))]
                    yield from finish(b, u, _cells(weights, views, np.array([~np.isin(key, t) for t in taken])))

        return self.rows.select("key", "u", "c", "m").mapInArrow(run, schema)

    def surest(self, weights: list[np.ndarray], rate: float) -> list[tuple[int, int, np.ndarray]]:
        """As ``ArrayPool.surest``; the driver gets 4 * 1,024 counts and about 2 * BATCH rows."""
        names = ["side", "cell", "n"]

        def count(b, u, cells):
            n = _counts(cells)
            side, cell = np.nonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (side, cell, n[side, cell])], names=names)

        counts = np.zeros((4, _CELLS), int)
        found = self._scan(weights, count, "side long, cell long, n long").groupBy("side", "cell").agg(F.sum("n").alias("n"))
        for r in found.collect():
            counts[r["side"], r["cell"]] = r["n"]
        cuts = _cuts(counts, rate)

        def fetch(b, u, cells):
            for side, keep in enumerate(_above(cells, u, cuts)):
                got = b.filter(pa.array(keep))
                yield pa.RecordBatch.from_arrays([pa.array([side] * got.num_rows, pa.int64()), got.column(0),
                                                  got.column(2 if side // 2 else 3)], names=["side", "key", "view"])

        rows = self._scan(weights, fetch, "side long, key long, view binary").orderBy("side", "key").collect()
        out = []
        for side in range(4):
            mine = [r for r in rows if r["side"] == side]
            self.taken[side // 2] += [r["key"] for r in mine]
            if mine:
                x = np.array([np.frombuffer(r["view"], np.float32) for r in mine], float)
                out.append((side // 2, side % 2, x if side // 2 else spread(x)))
        return out


def cotrain(views: list[np.ndarray], y: np.ndarray, fold: np.ndarray, pool, rounds: int = ROUNDS) -> Model:
    """Fit on rows of fold 0 and 1, exchange pseudo-labels over ``pool`` (a pool or arrays), calibrate on fold 2."""
    pool = ArrayPool(pool) if isinstance(pool, list) else pool
    fit, held = fold < 2, fold == 2
    known = [([v[fit]], [y[fit]]) for v in views]
    rate = y[fit].mean()
    for turn in range(rounds + 1):
        weights = [_fit(np.concatenate(xs), np.concatenate(ys)) for xs, ys in known]
        if turn == rounds:
            break
        for view, label, rows in pool.surest(weights, rate):
            known[1 - view][0].append(rows)
            known[1 - view][1].append(np.full(len(rows), float(label)))
    both = np.column_stack([_logit(w, v) for w, v in zip(weights, views)])
    ok = held if 0 < y[held].sum() < held.sum() else fit
    return Model(*weights, _fit(both[ok], y[ok], 1.0))


def view_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, c, m): both views of every row, in single precision."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("c", T.BinaryType()), T.StructField("m", T.BinaryType())])

    def run(batches):
        known: dict = {}
        for batch in batches:
            for b in portions(batch, 1):
                text, lang, source = (b.column(i).to_pylist() for i in (1, 2, 3))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([content_view(t, known).astype(np.float32).tobytes() for t in text], pa.binary()),
                     pa.array([metadata_view(*r).astype(np.float32).tobytes() for r in zip(text, lang, source)], pa.binary())],
                    names=["doc_id", "c", "m"])

    return docs.select("doc_id", "text", "lang", "source").mapInArrow(tidy(run), schema)


def unlabelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, u, c, m) of the rows outside the held-out part whose id has no label; rows that look alike in both views count once.

    ``key`` is the hash of the views and ``u`` a draw in [0, 1) made from it.
    """
    rows = view_rows(docs.where(F.col("doc_id").isNotNull() & ~held_out()))
    rows = rows.join(labels.select("doc_id").distinct(), "doc_id", "left_anti").groupBy("c", "m").agg(F.count(F.lit(1)).alias("n"))
    key = F.xxhash64("c", "m")
    return rows.select(key.alias("key"), (F.pmod(F.xxhash64(F.lit("draw"), key), F.lit(1 << 30)) / (1 << 30)).alias("u"), "c", "m")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model | None:
    """The co-trained model, or None if the labels do not hold both classes.

    An id with several labels has the largest, an id with several rows in
    ``docs`` the row whose views sort first; null ids are left out; ties of
    confidence at a threshold are settled by a hash of the views.
    """
    hashed = F.xxhash64("doc_id")
    train_ids = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = (train_ids.groupBy("doc_id").agg(F.max(label).cast("int").alias("y")).orderBy(hashed, "doc_id").limit(MAX_LABELS)
             .withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(3)).cast("int")))
    known = F.broadcast(known)  # at most MAX_LABELS ids
    rows = (view_rows(docs.join(known, "doc_id", "left_semi")).join(known, "doc_id")
            .groupBy("doc_id", "y", "fold").agg(F.min(F.struct("c", "m")).alias("v")).orderBy("doc_id").collect())
    y, fold = (np.array([r[k] for r in rows], float) for k in ("y", "fold"))
    if not 0 < y[fold < 2].sum() < (fold < 2).sum():
        return None
    view = [np.array([np.frombuffer(r["v"][k], np.float32) for r in rows], float) for k in ("c", "m")]
    pool = shared_table(unlabelled(docs, labels), "quality-pool")
    return cotrain([view[0], spread(view[1])], y, fold, TablePool(pool))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, content_score, metadata_score, score) of every row; without a model all are 0.5.

    Null texts, languages and sources count as empty; repeated rows score
    alike; texts are read whole; other columns are ignored; an empty table
    gives no rows.
    """
    names = ["content_score", "metadata_score", "score"]
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(n, T.DoubleType()) for n in names]])

    def run(batches):
        known: dict = {}
        for b in batches:
            text, lang, source = (b.column(i).to_pylist() for i in (1, 2, 3))
            if model is None:
                got = np.full((b.num_rows, 3), 0.5)
            else:
                got = model.scores(np.array([content_view(t, known) for t in text]).reshape(b.num_rows, -1),
                                   spread(np.array([metadata_view(*r) for r in zip(text, lang, source)]).reshape(-1, 4)))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(got[:, k]) for k in range(3)]], names=["doc_id", *names])

    return docs.select("doc_id", "text", "lang", "source").mapInArrow(run, schema)
