"""Target-distribution importance resampling over hashed word n-grams.

Every document is weighed by how much likelier its n-grams are in a target
corpus than in the whole raw corpus, and the best are drawn after adding
Gumbel noise (sampling without replacement in proportion to the weights).

Texts are counted by batch concatenation: the texts of a slice are joined with
separator sentinels into one byte string, one regular expression pass finds
all words and all sentinels, the sentinels' places in that list are the
documents' offsets, and ``searchsorted`` over them tells for each word its
document. An n-gram whose first and last words lie in different documents is
masked; the buckets of the others are counted with ``bincount`` (corpus
counts) or their gains summed per document.

Corpus counts are one number per bucket and task, summed by Spark. The gain
table has ``buckets`` rows, a parameter, and is all that is broadcast. The
ranking is one range-partitioned sort of (document, score) rows; no task holds
all documents.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civora.llm.common import numbered, shared_table, tidy

BUCKETS, MAX_N, MIN_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, "2024"
_SENTINEL = b"\x00"
_FOUND = re.compile(rb"[0-9a-z\x80-\xff]+|\x00")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
_LOWER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\x00", b"abcdefghijklmnopqrstuvwxyz "))
_SLICE = 1 << 20  # bytes of text that are taken apart at once
_KNOWN = 300_000  # words whose checksum a task remembers


class _Checksums(dict):
    """Word -> crc32 of its bytes, learned as words are met."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN:
            self.clear()
        value = self[word] = zlib.crc32(word)
        return value


def _slices(texts):
    """Lists of (row, piece, words repeated from the piece before) of about ``_SLICE`` bytes.

    A text longer than that is cut between words, so memory follows the slice
    (or the longest single word), not the text.
    """
    held, size = [], 0
    for row, text in enumerate(texts):
        data = (text or b"").translate(_LOWER)
        at = 0
        while True:
            end = len(data)
            if end - at > _SLICE:
                gap = _GAP.search(data, at + _SLICE)
                end = gap.end() if gap else end
            held.append((row, data[at:end]))
            size += end - at
            if size >= _SLICE:
                yield held
                held, size = [], 0
            at = end
            if at >= len(data):
                break
    if held:
        yield held


def _features(texts, max_n: int, buckets: int, known: _Checksums):
    """Per slice: (documents' rows, words per document, feature rows, feature buckets).

    A text cut into pieces lends the last max_n - 1 words of a piece to the
    next one; n-grams that end inside the lent words were counted before.
    """
    lent_row, lent = -1, []
    for held in _slices(texts):
        rows = [row for row, _ in held]
        carried = lent if rows[0] == lent_row else []
        joined = _SENTINEL.join(piece for _, piece in held) + _SENTINEL
        found = carried + _FOUND.findall(joined)
        sums = np.fromiter(map(known.__getitem__, found), np.uint32, len(found))
        is_end = sums == known[_SENTINEL]
        if is_end.sum() != len(held):  # a word with the sentinel's checksum
            is_end = np.fromiter((w == _SENTINEL for w in found), bool, len(found))
        ends = np.flatnonzero(is_end) - np.arange(len(held))  # words up to each document's end
        words = np.delete(np.asarray(found, object), np.flatnonzero(is_end)) if max_n > 1 else None
        sums = sums[~is_end]
        doc = np.searchsorted(ends, np.arange(len(sums)), side="right")
        rows = np.asarray(rows)
        at, hashed = [rows[doc[len(carried):]]], [sums[len(carried):]]
        for n in range(2, max_n + 1):
            last = np.arange(max(n - 1, len(carried)), len(sums))
            last = last[doc[last - n + 1] == doc[last]]
            at.append(rows[doc[last]])
            hashed.append(np.fromiter((zlib.crc32(b" ".join(words[i - n + 1:i + 1])) for i in last), np.uint32, len(last)))
        counted = np.bincount(doc[len(carried):], minlength=len(held))
        yield rows, counted, np.concatenate(at), (np.concatenate(hashed) % np.uint32(buckets)).astype(np.int64)
        if max_n > 1:
            start = ends[-2] if len(ends) > 1 else 0
            lent_row, lent = rows[-1], list(words[max(start, len(words) - max_n + 1):])


def _texts(batch: pa.RecordBatch):
    column = batch.column(batch.schema.get_field_index("_text"))
    return (x.as_py() for x in column)


def bucket_counts(texts: DataFrame, text: str = "text", max_n: int = MAX_N, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): occurrences of all n-grams of all texts; buckets without any are left out."""

    def run(batches):
        counts, known = np.zeros(buckets, np.int64), _Checksums()
        for batch in batches:
            for _, _, _, hashed in _features(_texts(batch), max_n, buckets, known):
                counts += np.bincount(hashed, minlength=buckets)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(counts[met], pa.int64())], names=["bucket", "n"])

    return (texts.select(F.col(text).cast("binary").alias("_text"))
            .mapInArrow(tidy(run), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """floor(1000 ln(target share / raw share)) per bucket, with one added to every count."""
    table = np.zeros((2, buckets), np.int64)
    for k, counts in enumerate((raw, target)):
        for r in counts.collect():  # at most one row per bucket
            table[k, r["bucket"]] = r["n"]
    s, t = table.astype(np.float64)
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return [int(x) for x in np.floor(1000 * np.log(ratio))]


def weigh(docs: DataFrame, gain: list[int], text: str = "text", max_n: int = MAX_N) -> DataFrame:
    """``docs`` (its columns first) with n_words, n_features and weight, the sum of its features' gains."""
    table = docs.sparkSession.sparkContext.broadcast(np.asarray(gain, np.int64))
    buckets, kept = len(gain), [c for c in docs.columns if c != text]

    def run(batches):
        known = _Checksums()
        for batch in batches:
            n_words, n_features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for rows, counted, at, hashed in _features(_texts(batch), max_n, buckets, known):
                np.add.at(n_words, rows, counted)
                if len(at):
                    n_features += np.bincount(at, minlength=batch.num_rows)
                    order = np.argsort(at, kind="stable") if max_n > 1 else slice(None)
                    at, value = at[order], table.value[hashed[order]]
                    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                    weight[at[starts]] += np.add.reduceat(value, starts)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(kept))), *(pa.array(x) for x in (n_words, n_features, weight))],
                names=[*kept, "n_words", "n_features", "weight"])

    out = docs.select(*kept).schema.add("n_words", "long").add("n_features", "long").add("weight", "long")
    return docs.select(*kept, F.col(text).cast("binary").alias("_text")).mapInArrow(tidy(run), out)


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths, fixed by the id (a null id is drawn as an empty text)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text",
             target_text: str = "text", max_n: int = MAX_N, buckets: int = BUCKETS,
             min_words: int = MIN_WORDS, percent: int = PERCENT, seed: str = SEED) -> DataFrame:
    """Every document with n_features, weight, score and, if drawn, its rank.

    ``percent`` of the documents with at least ``min_words`` words are drawn,
    the highest scores first, ties to the smaller id.

    Null and empty texts have no features, weight 0 and are never drawn. Texts
    of any length are counted whole. A null id is drawn like any other and
    comes last among equals; repeated rows are documents of their own, so they
    get neighbouring ranks. With an empty target all documents are weighed
    against the uniform distribution; an empty table gives no rows. Only the
    id and the text are carried, so other columns and their names do not matter.
    """
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    gain = gains(bucket_counts(named, "text", max_n, buckets), bucket_counts(target, target_text, max_n, buckets), buckets)
    weighed = shared_table(weigh(named, gain, "text", max_n), "importance-weights")
    able = F.col("n_words") >= min_words
    drawn = weighed.where(able).count() * percent // 100
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    ranked = numbered(scored.select("doc_id", "n_features", "weight", "score", able.alias("able")),
                      [F.col("able").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "importance-ranks")
    return ranked.select("doc_id", "n_features", "weight", "score",
                         F.when(F.col("_pos") < drawn, F.col("_pos") + 1).alias("rank"))


def oracle() -> str:
    """The same draw as DuckDB SQL over ``documents`` and ``benchmark`` (checksums by half bytes)."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
    with recursive
    nibble(i, k, c) as (
      select i::ubigint, 0, i::ubigint from range(16) r(i)
      union all
      select i, k + 1, case when (c & 1) = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end from nibble where k < 4),
    tab as (select list(c order by i) as t from nibble where k = 4),
    raw_words as (
      select doc_id, row_id, unnest(regexp_extract_all({lower.format('text')}, '{word}')) as w
      from (select doc_id, text, row_number() over () as row_id from documents)),
    target_words as (
      select unnest(regexp_extract_all({lower.format('text')}, '{word}')) as w from benchmark),
    vocabulary as (select distinct w from raw_words union select distinct w from target_words),
    halves as (
      select w, list_transform(range(strlen(w) * 2), lambda i:
                 ('0x' || substr(hex(encode(w)), ((i // 2) * 2 + 2 - (i % 2))::int, 1))::ubigint) as h from vocabulary),
    hashed as (
      select w, xor(list_reduce(list_prepend(4294967295::ubigint, h),
                    lambda c, x: xor(c >> 4, t[(xor(c, x) & 15)::int + 1])), 4294967295::ubigint) % 10000 as bucket
      from halves, tab),
    raw_counts as (select bucket, count(*) as s from raw_words join hashed using (w) group by bucket),
    target_counts as (select bucket, count(*) as t from target_words join hashed using (w) group by bucket),
    sums as (select (select count(*) from raw_words) as s_all, (select count(*) from target_words) as t_all),
    gain as (
      select bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::double * (s_all + 10000)::double)
                                     / ((s + 1)::double * (t_all + 10000)::double)))::bigint as g
      from raw_counts left join target_counts using (bucket), sums),
    weights as (
      select row_id, count(*) as n_features, sum(g)::bigint as weight
      from raw_words join hashed using (w) join gain using (bucket) group by row_id),
    scored as (
      select doc_id, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
             (coalesce(weight, 0) + floor(-1000 * ln(-ln((
               ('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint::double + 0.5)
               / 4294967296::double))))::bigint as score
      from (select doc_id, row_number() over () as row_id from documents) left join weights using (row_id)),
    ranked as (
      select *, n_features >= {MIN_WORDS} as able,
             row_number() over (partition by n_features >= {MIN_WORDS} order by score desc, doc_id nulls last) as r
      from scored)
    select doc_id, n_features, weight, score,
           case when able and r <= (select count(*) from ranked where able) * {PERCENT} // 100 then r end as rank
    from ranked
    """
