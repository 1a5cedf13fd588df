"""Pack documents into as few training sequences as possible: best-fit decreasing over token lengths.

Method. A text's ids and an end id are cut into pieces of at most ``limit`` tokens, the first may be shorter. Best-fit decreasing puts the
longest piece first, each into the open sequence with the least room that still takes it. A segment tree over the
remaining capacities 0 to ``limit`` finds that room in logarithmic time. Pieces of one length are alike, and so are sequences with the same room, so the
packing follows from the number of pieces of each length alone: the tree's leaves count the open sequences of each room, and one search places a run
of equal pieces. The result has as many sequences as one search a piece would give. Which piece takes which place follows
from its rank among those of its length: tasks number their own pieces, and the numbers before a task are a window sum over counts.

What reaches the driver and goes back: the number of pieces of each length (``limit`` rows) and the runs placed; both depend on
``limit``, not on the corpus. Pieces are shuffled by (task, length) without regard to size of a source or of a group of copies.

Ids are those of the ``tokenizers`` library. Its byte-level merges are applied by ``tiktoken`` with the ranks of the same file, which gives
the same ids six times as fast; a text that it refuses goes through ``tokenizers`` itself. Strings of special tokens in a text are ordinary text.

Nulls: a null text is empty and gives one piece, the end id; a null key stays. Very long texts are encoded whole, and a task holds the ids
of one text and a few megabytes of pieces. Ties between equal sequences go to the earlier one; rows that repeat are packed as often as they occur. Empty tables
give empty tables. Other columns are not read, and a table with a column named like a result is fine.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from regionlake.llm.base import binary, map_batches, same, stored, table, texts_of

FLUSH_BYTES = 4 << 20


def model_text(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _byte_of() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself where it is printable, else one after 255."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def encoder(model: str, pattern: str):
    """Function from a text to its ids (unsigned 32 bits)."""
    library = Tokenizer.from_str(model)
    library.encode_special_tokens = True
    parts = json.loads(model)["model"]
    special = {t["content"] for t in json.loads(model)["added_tokens"]}
    of, vocabulary = _byte_of(), parts["vocab"]
    ranks = {bytes(of[c] for c in t): i for t, i in vocabulary.items() if t not in special}
    merged = ("".join(m if isinstance(m, list) else m.split(" ")) for m in parts["merges"])
    if any(vocabulary[t] != 256 + i for i, t in enumerate(merged)):
        raise ValueError("ids of a byte-level vocabulary must follow the order of its merges")
    fast = tiktoken.Encoding("packed", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, disallowed_special=())
        except ValueError:  # a run of blanks too long for the pattern
            return np.array(library.encode(text, add_special_tokens=False).ids, np.uint32)

    return encode


def starts(n: int, limit: int) -> list[int]:
    """Where the pieces of ``n`` tokens begin: the first takes what full pieces leave over."""
    rest = n % limit
    return ([0] if rest else []) + list(range(rest, n, limit))


def tokenized(docs: DataFrame, model: str, pattern: str, limit: int = 1024, end_id: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, piece, start, length, ids, task, nth): every text's ids and ``end_id`` in pieces, written to the shared folder.

    ``ids`` are little-endian unsigned 32-bit numbers; ``nth`` numbers the pieces of one length within a ``task``.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(model, pattern), TaskContext.get().partitionId()
        seen = np.zeros(limit + 1, np.int64)
        for batch in batches:
            keys, texts = batch.column("key"), batch.column("text")
            row, piece, start, length, nth, ids, held = [], [], [], [], [], [], 0

            def flush():
                n = len(row)
                return table({"key": keys.take(pa.array(row, pa.int64())), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                              "length": pa.array(length, pa.int64()), "ids": binary(ids), "task": pa.array([task] * n, pa.int32()),
                              "nth": pa.array(nth, pa.int64())})

            for i in range(len(texts)):
                own = np.append(encode(texts[i].as_py() or ""), np.uint32(end_id)).astype("<u4")
                at = starts(len(own), limit)
                for j, (a, b) in enumerate(zip(at, [*at[1:], len(own)])):
                    row.append(i), piece.append(j), start.append(a), length.append(b - a), nth.append(int(seen[b - a])), ids.append(own[a:b].tobytes())
                    seen[b - a] += 1
                held += own.nbytes
                if held > FLUSH_BYTES:
                    yield flush()
                    row, piece, start, length, nth, ids, held = [], [], [], [], [], [], 0
            yield flush()

    of = texts_of(docs, key, text)
    schema = f"key {of.schema['key'].dataType.simpleString()}, piece int, start bigint, length bigint, ids binary, task int, nth bigint"
    return stored(map_batches(of, cut, schema).withColumnRenamed("key", key), "pieces")


class Rooms:
    """Segment tree over remaining capacities; a leaf counts the open sequences with that much room."""

    def __init__(self, limit: int):
        self.width = 1 << limit.bit_length()
        self.sums = np.zeros(2 * self.width, np.int64)

    def add(self, room: int, n: int) -> None:
        at = room + self.width
        while at:
            self.sums[at] += n
            at >>= 1

    def tightest(self, need: int) -> int:
        """The least room of ``need`` or more that some open sequence has, or -1."""
        at = need + self.width
        while not self.sums[at]:
            while at & 1:  # a right child: nothing further right below this parent
                at >>= 1
            if at <= 1:
                return -1
            at += 1
        while at < self.width:
            at = 2 * at if self.sums[2 * at] else 2 * at + 1
        return at - self.width


def best_fit(counts: dict[int, int], limit: int) -> np.ndarray:
    """Runs (length, first, n, sequence, each, offset) of the best-fit decreasing packing of ``counts[length]`` pieces.

    The run's piece j goes to ``sequence + j // each``, at ``offset + j % each * length``.
    """
    rooms, open_, runs, sequences = Rooms(limit), [[] for _ in range(limit + 1)], [], 0

    def put(length, first, n, sequence, each, room):
        """``n`` pieces, ``each`` a sequence, into sequences that had ``room``."""
        runs.append((length, first, n, sequence, each, limit - room))
        left, bins = room - each * length, n // each
        if left:
            open_[left].append((sequence, bins))
            rooms.add(left, bins)

    for length in sorted(counts, reverse=True):
        first, left = 0, counts[length]
        while left:
            room = rooms.tightest(length)
            if room < 0:
                room, sequence, bins = limit, sequences, -(-left // (limit // length))
                sequences += bins
            else:
                sequence, bins = open_[room].pop()
                rooms.add(room, -bins)
            each = room // length
            full = min(bins, left // each)
            if full:
                put(length, first, full * each, sequence, each, room)
                first, left = first + full * each, left - full * each
            if full < bins and left:
                put(length, first, left, sequence + full, left, room)
                full, left = full + 1, 0
            if full < bins:
                open_[room].append((sequence + full, bins - full))
                rooms.add(room, bins - full)
    return np.array(runs, np.int64).reshape(-1, 6)


def placed(pieces: DataFrame, limit: int = 1024) -> DataFrame:
    """``pieces`` with (sequence_id, offset) in place of (task, nth); all other columns pass through."""
    counts = stored(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")
    counts = counts.withColumn("before", before).select(F.col("task").alias("_task"), F.col("length").alias("_length"), "before")
    totals = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).toPandas()
    plan = best_fit({int(k): int(n) for k, n in zip(totals["length"], totals["n"])}, limit)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    # Pieces of one length number fewer than 2**48.
    run_at = (plan[:, 0] << 48) + plan[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, nth = (batch.column(c).to_numpy() for c in ("length", "nth"))
            run = plan[np.searchsorted(run_at, (length << 48) + nth, "right") - 1]
            j = nth - run[:, 1]
            kept = {c: batch.column(c) for c in batch.schema.names if c not in ("task", "nth")}
            yield table(kept | {"sequence_id": run[:, 3] + j // run[:, 4], "offset": run[:, 5] + j % run[:, 4] * length})

    ranked = pieces.join(counts, same("task", "_task") & same("length", "_length"))
    ranked = ranked.withColumn("nth", F.col("nth") + F.col("before")).select(*pieces.columns)
    shape = pieces.drop("task", "nth").schema
    return map_batches(ranked, place, shape.add("sequence_id", "long").add("offset", "long"))


def pack(docs: DataFrame, model: str, pattern: str, limit: int = 1024, end_id: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, piece, start, length, ids, sequence_id, offset): every piece with its place in a sequence of at most ``limit`` tokens."""
    return placed(tokenized(docs, model, pattern, limit, end_id, key, text), limit)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the sequences written out; a group holds at most ``limit`` tokens."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(F.col("parts"), F.unhex(F.lit("")), lambda a, p: F.concat(a, p["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), ordered.alias("parts")).select("sequence_id", "length", joined.alias("ids"))
