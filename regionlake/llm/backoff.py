"""Stupid-backoff scores of documents, computed from n-gram count tables partitioned by hash.

Method. Texts are dealt to blocks: the input split they are read from and a few parts of it by key. In rounds, one for words and
pairs and one for each longer order, each block explodes its texts into n-grams and asks for the count of each distinct one: the
hashes, sorted, with the block's own counts, go to the partition of their leading bits. There the count tables are built (all blocks'
counts summed) and joined to the requests, and the total of every n-gram asked for is stored for its block, in the order asked. A
round's requests, six bytes an n-gram, leave the disks before the next round; only the counts stay. Then the texts of a block meet
its answers; positions look their counts up and the logarithms are summed per document.

A word's score is count(n-gram) / count(context) for the longest n-gram whose count is at least ``least``, times ``penalty`` for
each order given up; at order 1 it is count(word) / words. Counts cover all rows. Contexts do not
cross texts. A hot n-gram is one entry in each block, so no task receives its occurrences.

Nulls and empty texts have no words and score 0 (mean null). A null key is dealt with as one more key; repeated rows are
counted and scored each. One very long text only makes its own block larger. Empty tables give empty
tables; other columns are not read. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from regionlake.llm.base import binary, map_batches, partitions, stored, table
from regionlake.llm.words import Words, joined, slices, words
from regionlake.session import settings

PARTS = 8  # blocks of an input split
BUCKETS = 2  # of each shuffle partition, in each round


def rounds(order: int) -> list[range]:
    """The orders asked for together: words with pairs, as words are few, and each longer order alone."""
    return [range(1, min(order, 2) + 1), *(range(n, n + 1) for n in range(3, order + 1))]


def placed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(block, key, text): the same block on every read, as long as the files and the split size stay."""
    split = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"))
    part = F.pmod(F.xxhash64(docs[key].cast("string"), F.lit(7)), F.lit(PARTS))
    return docs.select(F.xxhash64(split, part).alias("block"), docs[key].cast("long").alias("key"), docs[text].cast("string").alias("text"))


class Block:
    """The word hashes of some texts, and for each order the hashes and rows of their n-grams."""

    def __init__(self):
        self.keys: list = []
        self.hashes: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []

    def add(self, keys: pa.Array, texts: pa.Array) -> "Block":
        for lo, hi, data, offsets in slices(texts):
            w: Words = words(data, offsets)
            self.keys += keys.slice(lo, hi - lo).to_pylist()
            self.hashes.append(w.hash)
            self.sizes.append(np.diff(w.first()))
        return self

    def close(self) -> "Block":
        self.word = np.concatenate(self.hashes) if self.hashes else np.zeros(0, np.uint64)
        self.size = np.concatenate(self.sizes) if self.sizes else np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(len(self.size)), self.size)
        self.place = np.arange(len(self.word)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        return self

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the last words of the n-grams, and the n-grams' hashes."""
        at = np.flatnonzero(self.place >= n - 1)
        if n == 1:
            return at, self.word
        return at, joined(self.word, n)[at - n + 1] if len(self.word) >= n else np.zeros(0, np.uint64)

    def types(self, orders: range) -> tuple[np.ndarray, np.ndarray]:
        """The distinct n-grams of some orders, sorted, and how often each occurs in the block."""
        return np.unique(np.concatenate([self.grams(n)[1] for n in orders]), return_counts=True)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def packed(sorted_hashes: np.ndarray) -> bytes:
    """Sorted hashes as the bytes of their differences, without the leading ones that are zero in all but the first."""
    if not len(sorted_hashes):
        return b""
    gaps = np.diff(sorted_hashes)
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    low = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + sorted_hashes[:1].astype("<u8").tobytes() + low.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, np.uint64)
    width = raw[0]
    low = np.frombuffer(raw, np.uint8, offset=9).reshape(-1, width)
    gaps = np.zeros((len(low), 8), np.uint8)
    gaps[:, :width] = low
    first = np.frombuffer(raw, "<u8", 1, offset=1)
    return np.cumsum(np.concatenate((first, gaps.view("<u8").ravel())), dtype=np.uint64)


def small(counts: np.ndarray) -> bytes:
    """Counts in the narrowest whole-number type that holds them."""
    kind = np.uint8 if counts.max(initial=0) < 2**8 else np.uint16 if counts.max() < 2**16 else np.uint32 if counts.max() < 2**32 else np.uint64
    return bytes([np.dtype(kind).itemsize]) + counts.astype(kind).tobytes()


def counts_of(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.uint64)


class Requests:
    """One row for each block and bucket: the hashes asked for, and the block's counts. A task reads whole blocks,
    since a block is a part of one input split."""

    schema = "bucket int, block long, hashes binary, counts binary"

    def __init__(self, orders: range, buckets: int):
        self.orders, self.buckets = orders, buckets

    def __call__(self, batches):
        held: dict[int, Block] = {}
        for batch in batches:
            for block, rows in by_block(batch):
                held.setdefault(block, Block()).add(rows["key"], rows["text"])
        for block in list(held):
            yield self._rows(block, held.pop(block).close())

    def _rows(self, block: int, texts: Block):
        types, own = texts.types(self.orders)
        bucket = _bucket(types, self.buckets)
        cuts = np.searchsorted(bucket, np.arange(self.buckets + 1, dtype=np.uint64))
        used = np.flatnonzero(np.diff(cuts))
        return table({
            "bucket": used.astype(np.int32), "block": np.full(len(used), block, np.int64),
            "hashes": binary([packed(types[cuts[i] : cuts[i + 1]]) for i in used]),
            "counts": binary([small(own[cuts[i] : cuts[i + 1]]) for i in used]),
        })


def by_block(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    blocks = batch["block"].to_numpy()
    for block in np.unique(blocks):
        yield int(block), batch.filter(pa.array(blocks == block))


class Answers:
    """The total count of every hash asked for in a round: rows sorted by bucket."""

    schema = "block long, turn int, bucket int, counts binary"

    def __init__(self, turn: int):
        self.turn = turn

    def __call__(self, batches):
        held, now = [], None
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != now and held:
                    yield self._bucket(held)
                    held = []
                now = row["bucket"]
                held.append((row["block"], row["bucket"], row["hashes"], row["counts"]))
        if held:
            yield self._bucket(held)

    def _bucket(self, held):
        asked = [unpacked(h) for _, _, h, _ in held]
        types, place = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.zeros(len(types), np.uint64)
        own = np.concatenate([counts_of(c) for *_, c in held])
        np.add.at(total, place, own)
        ends = np.cumsum([0, *map(len, asked)])
        return table({
            "block": np.array([r[0] for r in held], np.int64), "turn": np.full(len(held), self.turn, np.int32), "bucket": np.array([r[1] for r in held], np.int32),
            "counts": binary([small(total[place[a:b]]) for a, b in zip(ends, ends[1:])]),
        })


class Scores:
    """Scores of a block's texts from its answers: rows sorted by block, round, bucket; texts have neither of the last."""

    schema = "key long, n_words long, log_score double"

    def __init__(self, order: int, words: int, least: int, penalty: float):
        self.order, self.words, self.least, self.penalty = order, words, least, penalty

    def __call__(self, batches):
        now, texts, answers = None, Block(), {}
        for batch in batches:
            blocks = batch["block"].to_numpy()
            edges = np.flatnonzero(np.diff(blocks)) + 1
            for lo, hi in zip([0, *edges], [*edges, len(blocks)]):
                if not hi:
                    continue
                if blocks[lo] != now:
                    if texts.keys:
                        yield self._scored(texts.close(), answers)
                    now, texts, answers = blocks[lo], Block(), {}
                part = batch.slice(lo, hi - lo)
                answered = part["bucket"].is_valid()
                for row in part.filter(answered).select(["turn", "bucket", "counts"]).to_pylist():
                    answers[row["turn"], row["bucket"]] = row["counts"]
                rows = part.filter(part["bucket"].is_null())
                texts.add(rows["key"], rows["text"])
        if texts.keys:
            yield self._scored(texts.close(), answers)

    def _scored(self, b: Block, answers):
        logs = np.zeros(len(b.word))
        if len(b.word):
            found = [np.zeros(len(b.word), np.uint64) for _ in range(self.order + 1)]
            for turn, orders in enumerate(rounds(self.order)):
                types = b.types(orders)[0]
                totals = np.concatenate([np.zeros(0, np.uint64), *(counts_of(answers[k]) for k in sorted(answers) if k[0] == turn)])
                for n in orders:
                    at, grams = b.grams(n)
                    found[n][at] = totals[np.searchsorted(types, grams)]
            logs = np.log(found[1].astype(float)) - np.log(self.words)
            for n in range(2, self.order + 1):
                known = found[n] >= self.least
                context = np.append(np.uint64(0), found[n - 1][:-1])
                seen = np.log(np.maximum(found[n], 1).astype(float)) - np.log(np.maximum(context, 1).astype(float))
                logs = np.where(b.place < n - 1, logs, np.where(known, seen, logs + np.log(self.penalty)))
        score = np.bincount(b.row, logs, len(b.size)) if len(b.word) else np.zeros(len(b.size))
        return table({"key": pa.array(b.keys, pa.int64()), "n_words": b.size.astype(np.int64), "log_score": score.astype(float)})


class WordCount:
    schema = "n long"

    def __call__(self, batches):
        total = 0
        for batch in batches:
            for _, _, data, offsets in slices(batch["text"]):
                total += len(words(data, offsets).start)
        yield table({"n": np.array([total], np.int64)})


def answered(rows: DataFrame, turn: int, orders: range) -> DataFrame:
    """The answers of a round, stored; what it shuffled is removed with the write."""
    spark = rows.sparkSession
    asked = map_batches(rows, Requests(orders, BUCKETS * partitions(spark)), Requests.schema)
    dealt = asked.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket")
    with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        return stored(map_batches(dealt, Answers(turn), Answers.schema), f"answers-{turn}")


def stupid_backoff(docs: DataFrame, key: str = "doc_id", text: str = "text", order: int = 2, least: int = 2,
                   penalty: float = 0.4) -> DataFrame:
    """(``key``, ``n_words``, ``log_score``, ``mean_log_score``) of every row; ``docs`` is read from files.

    The context's count is that of the n-gram one word shorter that ends before the word.
    """
    spark = docs.sparkSession
    rows = placed(docs, key, text)
    total = map_batches(rows.select("text"), WordCount(), WordCount.schema).agg(F.sum("n")).first()[0] or 1
    none: Column = F.lit(None)
    blocks = rows.select("block", none.cast("int").alias("turn"), none.cast("int").alias("bucket"), none.cast("binary").alias("counts"), "key", "text")
    for turn, orders in enumerate(rounds(order)):
        back = answered(rows, turn, orders)
        blocks = blocks.union(back.select("*", none.cast("long").alias("key"), none.cast("string").alias("text")))
    blocks = blocks.repartition(partitions(spark), "block").sortWithinPartitions("block", "turn", "bucket")
    scored = map_batches(blocks, Scores(order, total, least, penalty), Scores.schema)
    return scored.select(F.col("key").alias(key), "n_words", "log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).alias("mean_log_score"))
