"""Draw documents that look like a target collection: importance resampling over hashed word runs.

Method. Features are the runs of 1 to ``longest`` words of a text. Within a slice of a batch an open-addressed numpy table
interns them: the 64-bit xxhash of a run is its key, equal keys are verified byte by byte, and linear probing goes on
where they differ. A slot stores the run's bucket (crc32 modulo ``buckets``) and its count, so each distinct run is hashed into
its bucket once. Bucket totals of corpus and target give a gain a bucket; a second pass interns again, and the slot ids of
the occurrences gather the gains of their texts. Scores add Gumbel noise made from the key, so the highest scores are a draw without
replacement in proportion to the importance.

What is broadcast: one gain a bucket. What reaches the driver: bucket totals, and how many documents have each
score. Scores are whole numbers between bounds that the logarithms set (under 300 000 different ones), whatever the corpus.
Only documents drawn are shuffled, by score.

Nulls: a null text has no words; a null key draws the noise of the empty string. Texts without words weigh 0. Very long texts are
taken whole, a slice of about 1 MB holds at least one text. Ties go to the smaller key; rows with the same key and score
are ranked one after the other in no set order. Repeated rows count as often as they occur. An empty corpus gives an empty table, an
empty target gains by the smoothing alone. Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from regionlake.llm.base import map_batches, stored, table, texts_of
from regionlake.llm.spans import LOWER, ranges, runs
from regionlake.llm.words import slices

_WORD = np.ones(256, bool)
_WORD[:0x30] = _WORD[0x3A:0x61] = _WORD[0x7B:0x80] = False
_GAP = 0x20


class Interned:
    """Distinct byte ranges of one buffer in an open-addressed table; ``slot`` is the slot of each range."""

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, buckets: int):
        raw, digest = data.tobytes(), xxhash.xxh64_intdigest
        key = np.fromiter((digest(raw[a:b]) for a, b in zip(start.tolist(), (start + size).tolist())), np.uint64, len(start))
        capacity = 1 << max(4, (2 * len(start)).bit_length())
        self.owner = np.full(capacity, -1, np.int64)
        self.slot = (key & np.uint64(capacity - 1)).astype(np.int64)
        pending = np.arange(len(start))
        while len(pending):
            at = self.slot[pending]
            free = self.owner[at] < 0
            self.owner[at[free]] = pending[free]
            own = self.owner[at]
            same = (key[own] == key[pending]) & (size[own] == size[pending])
            same[same] = _equal(data, start[own[same]], start[pending[same]], size[pending[same]])
            pending = pending[~same]
            self.slot[pending] = (self.slot[pending] + 1) & (capacity - 1)
        self.used = np.flatnonzero(self.owner >= 0)
        self.bucket = np.zeros(capacity, np.int64)
        first = self.owner[self.used]
        self.bucket[self.used] = [zlib.crc32(raw[a:b]) % buckets for a, b in zip(start[first].tolist(), (start + size)[first].tolist())]
        self.count = np.bincount(self.slot, minlength=capacity)


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether ranges of equal size (none empty) hold the same bytes."""
    different = a != b
    out = ~different
    if different.any():
        a, b, size = a[different], b[different], size[different]
        hits = data[ranges(a, size)] == data[ranges(b, size)]
        out[different] = np.logical_and.reduceat(hits, np.cumsum(size) - size)
    return out


def features(data: np.ndarray, offsets: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words joined by one space, the (start, size, row) of their runs of 1 to ``longest``, and the words of each row."""
    start, end, row = runs(_WORD[LOWER[data]], offsets)
    size = end - start + 1
    after = np.cumsum(size)
    text = np.full(int(after[-1]) if len(after) else 0, _GAP, np.uint8)
    letters = np.ones(len(text), bool)
    letters[after - 1] = False
    text[letters] = LOWER[data[ranges(start, size - 1)]]
    found = []
    for n in range(1, min(longest, len(start)) + 1):
        same = row[: len(row) - n + 1] == row[n - 1 :]
        first = (after - size)[: len(row) - n + 1][same]
        found.append((first, after[n - 1 :][same] - 1 - first, row[: len(row) - n + 1][same]))
    parts = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
    return text, *parts, np.bincount(row, minlength=len(offsets) - 1)


def bucket_totals(docs: DataFrame, longest: int, buckets: int, key: str = "doc_id", text: str = "text") -> np.ndarray:
    """Occurrences in each bucket over all texts; a task adds up its own before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column("text")):
                joined, start, size, _, _ = features(data, offsets, longest)
                seen = Interned(joined, start, size, buckets)
                np.add.at(total, seen.bucket[seen.used], seen.count[seen.used])
        held = np.flatnonzero(total)
        yield table({"bucket": held, "n": total[held]})

    rows = map_batches(texts_of(docs, key, text).select("text"), count, "bucket bigint, n bigint")
    found = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, np.int64)
    out[found["bucket"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of the smoothed share of each bucket in the target against that in the corpus."""
    m = len(corpus)
    s_all, t_all = float(corpus.sum() + m), float(target.sum() + m)
    pairs = zip(corpus.tolist(), target.tolist())
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in pairs], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, longest: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_features, weight): the floored mean gain of each text's runs, 0 without any."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text")):
                joined, start, size, row, n_words = features(data, offsets, longest)
                seen = Interned(joined, start, size, len(gain))
                each = gain[seen.bucket][seen.slot]
                n = np.bincount(row, minlength=hi - lo)
                total = np.zeros(hi - lo, np.int64)
                np.add.at(total, row, each)
                yield table({"key": batch.column("key").slice(lo, hi - lo), "n_words": n_words, "n_features": n, "weight": total // np.maximum(n, 1)})

    of = texts_of(docs, key, text)
    schema = f"key {of.schema['key'].dataType.simpleString()}, n_words bigint, n_features bigint, weight bigint"
    return map_batches(of, weigh, schema).withColumnRenamed("key", key)


def noisy(weighed: DataFrame, seed: int, key: str = "doc_id") -> DataFrame:
    """With ``score``: the weight and 1000 times a Gumbel draw that the key alone decides."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    drawn = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + 0.5) / 4294967296
    return weighed.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(drawn))).cast("long"))


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20,
             seed: int = 2024, key: str = "doc_id", text: str = "text", target_key: str = "item_id", target_text: str = "text") -> DataFrame:
    """(key, n_features, weight, score, rank) of every document.

    ``rank`` counts from 1 over the ``percent`` of the documents with ``least_words`` words or more that score highest, null for the others.
    """
    gain = gains(bucket_totals(docs, longest, buckets, key, text), bucket_totals(target, longest, buckets, target_key, target_text))
    scored = stored(noisy(weights(docs, gain, longest, key, text), seed, key), "resampled")
    enough = F.col("n_words") >= least_words
    tally = scored.where(enough).groupBy("score").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("score", ascending=False)
    above = (tally["n"].cumsum() - tally["n"]).to_numpy(np.int64)
    take = int(tally["n"].sum()) * percent // 100
    tally = pd.DataFrame({"score": tally["score"].to_numpy(np.int64), "above": above})[above < take]
    columns = [key, "n_features", "weight", "score"]
    if not len(tally):
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    last = int(tally["score"].min())
    near = enough & (F.col("score") >= last)
    in_score = F.row_number().over(Window.partitionBy("score").orderBy(F.col(key).asc_nulls_last()))
    counted = F.broadcast(docs.sparkSession.createDataFrame(tally))
    ranked = scored.where(near).join(counted, "score").withColumn("rank", F.col("above") + in_score)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= take, F.col("rank")))
    return ranked.select(*columns, "rank").union(scored.where(~near).select(*columns, F.lit(None).cast("long").alias("rank")))
