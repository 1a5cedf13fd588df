"""Document fingerprints by I-Match over randomised lexicon subsets.

Method. The lexicon is the terms whose document frequency lies within a band (a band of inverse document
frequency): words of more than ``high`` of the texts say little, words of fewer than ``low`` are often noise.
A text keeps its distinct terms of the lexicon, sorted, and each of several random subsets of the lexicon
hashes the kept terms that it contains. Subsets come in levels, each half as dense as the one before, so that short and long
texts both have levels at which a subset holds a few of their terms. The likeness of two fingerprints is the share of
equal signatures at the best level of those where half of the subsets hold a term of either text.

Document frequencies are over all rows. The lexicon has at most (mean distinct terms of a text) / ``low``
terms whatever the corpus, since each needs ``low`` of all texts; that bounds the broadcast.

Words are lower case without punctuation around them. A text without terms of the lexicon is hashed by all its terms, so equal texts
have equal fingerprints and empty texts one of their own. Nulls: a null text is empty, a null key comes before all others. Rows with equal keys
follow each other by text. Very long texts are read whole. Empty tables give empty tables; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from regionlake.llm.base import BitSet, map_batches, partitions, stored, table
from regionlake.llm.words import mixed

LEVELS, REPEATS, DIGITS = 10, 8, 6
EDGES = ".,;:!?\"'()[]{}<>|*_`#$%&@~=+-/\\«»“”‘’…"
BLOCK = 512  # neighbouring keys that are dealt to one task together


def terms(text: str) -> np.ndarray:
    """Sorted hashes of the distinct words."""
    words = {w.strip(EDGES) for w in set(text.lower().split())}
    words.discard("")
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))


class Frequencies:
    """Texts of a task that have each term."""

    schema = "term long, n long"

    def __call__(self, batches):
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for text in batch["text"]:
                own = terms(text.as_py() or "")
                held.append(own)
                size += len(own)
                if size > 4_000_000:
                    yield self._counted(held)
                    held, size = [], 0
        if held:
            yield self._counted(held)

    def _counted(self, held):
        found, n = np.unique(np.concatenate(held), return_counts=True)
        return table({"term": found.view(np.int64), "n": n.astype(np.int64)})


class Lexicon:
    """Terms of the band, and the subsets and the random value of each."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes.view(np.uint64))

    def __getstate__(self):
        return {"hashes": self.hashes}

    def _subsets(self) -> np.ndarray:
        if "members" not in self.__dict__:
            columns = []
            for level in range(1, LEVELS + 1):
                for r in range(REPEATS):
                    salt = np.uint64((level * REPEATS + r) * 0x9E3779B97F4A7C15 & (2**64 - 1))
                    columns.append(mixed(self.hashes ^ salt) >> np.uint64(64 - level) == 0)
            self.members = np.stack(columns, 1) if columns else np.zeros((0, 0), bool)
            self.values = mixed(self.hashes + np.uint64(1))
            self.ended = np.append(self.hashes, np.uint64(0))
        return self.members

    def signatures(self, text: str) -> tuple[int, np.ndarray]:
        """The hash of all kept terms, and one for each subset (0: it holds none)."""
        own = terms(text)
        members = self._subsets()
        at = np.searchsorted(self.hashes, own)
        at = at[self.ended[at] == own] if len(self.hashes) else at[:0]
        whole = xxhash.xxh3_64_intdigest((self.hashes[at] if len(at) else own).tobytes())
        if not len(at):
            return whole, np.zeros(LEVELS * REPEATS, np.uint64)
        picked = members[at]
        sums = np.where(picked, self.values[at][:, None], np.uint64(0)).sum(0, dtype=np.uint64)
        signs = mixed(sums) >> np.uint64(64 - 4 * DIGITS)
        return whole, np.where(picked.any(0), np.maximum(signs, np.uint64(1)), np.uint64(0))


def written(whole: int, signs: np.ndarray) -> str:
    packed = signs.astype(">u8").tobytes().hex()
    return f"{whole:016x}" + "".join(packed[i + 16 - DIGITS : i + 16] for i in range(0, len(packed), 16))


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """0 to 1; 1 for equal fingerprints."""
    if a[0] == b[0]:
        return 1.0
    x, y = a[1].reshape(LEVELS, REPEATS), b[1].reshape(LEVELS, REPEATS)
    filled = (x | y) > 0
    level = filled.sum(1) >= REPEATS // 2
    if not level.any():
        return 0.0
    return float((((x == y) & filled).sum(1)[level] / filled.sum(1)[level]).max())


def lexicon(docs: DataFrame, text: str = "text", low: float = 0.0005, high: float = 0.1) -> np.ndarray:
    """Hashes of the terms that ``low`` to ``high`` of all rows have, and two rows at least."""
    rows = docs.select(docs[text].cast("string").alias("text"))
    total = rows.count()
    counts = map_batches(rows, Frequencies(), Frequencies.schema).groupBy("term").agg(F.sum("n").alias("n"))
    band = counts.where((F.col("n") >= max(2, low * total)) & (F.col("n") <= max(2, high * total)))
    return band.select("term").toPandas()["term"].to_numpy(np.int64)


class Fingerprint:
    def __init__(self, words):
        self.words = words

    def __call__(self, batches):
        for batch in batches:
            prints = [written(*self.words.value.signatures(t.as_py() or "")) for t in batch["text"]]
            yield table({"key": batch["key"], "fingerprint": pa.array(prints, pa.string())})


def fingerprints(docs: DataFrame, words: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, ``fingerprint``) of every row."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(Lexicon(words))
    return map_batches(rows, Fingerprint(shared), f"key {kind}, fingerprint string").withColumnRenamed("key", key)


def successors(keys: DataFrame, key: str) -> DataFrame:
    """(``key``, ``next``) of distinct, non-null keys: the next larger one, after the last the first.

    Keys are range-partitioned; a task's last key takes the first key of the next task, of which there is one row a task.
    """
    part = keys.select(key).where(F.col(key).isNotNull()).distinct().repartitionByRange(partitions(keys.sparkSession), key)
    part = stored(part.withColumn("part", F.spark_partition_id()), "successors")
    heads = part.groupBy("part").agg(F.min(key).alias("head"))
    after = heads.select("part", F.lead("head").over(Window.orderBy("part")).alias("after"))
    first = F.lit(part.agg(F.min(key)).first()[0])
    own = part.withColumn("own", F.lead(key).over(Window.partitionBy("part").orderBy(key))).join(F.broadcast(after), "part")
    return own.select(key, F.coalesce("own", "after", first.cast("long")).alias("next"))


class Heads:
    """Rows whose key a bit set has."""

    schema = "key long, text string"

    def __init__(self, wanted):
        self.wanted = wanted

    def __call__(self, batches):
        for batch in batches:
            key = batch["key"].fill_null(0).to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(self.wanted.value.has(key) & ~batch["key"].is_null().to_numpy(zero_copy_only=False)))


class Edited:
    """Each row of a block against the next: rows sorted by block, visitor, key and text."""

    schema = (
        "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )

    def __init__(self, words):
        self.words = words

    def __call__(self, batches: Iterator[pa.RecordBatch]):
        words, held, out = self.words.value, None, []
        for batch in batches:
            columns = zip(batch["block"].to_pylist(), batch["visitor"].to_pylist(), batch["key"].to_pylist(), batch["text"])
            for block, visitor, key, text in columns:
                text = text.as_py() or ""
                now = (block, visitor, key, text, words.signatures(text))
                if held is not None:
                    out.append(self._pair(words, held, now))
                held = None if visitor else now
                if len(out) >= 512:
                    yield self._rows(out)
                    out = []
        if out:
            yield self._rows(out)

    def _pair(self, words, held, now):
        _, _, key, text, own = held
        n = len(text)
        edited = text[: n - n // 4] + now[3][: n // 4]
        other = words.signatures(edited)
        digest = hashlib.sha256(edited.encode()).hexdigest()
        return key, n, digest, written(*own), written(*other), likeness(own, other), likeness(own, now[4])

    def _rows(self, out):
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        names = ("key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
        return table({n: pa.array(c, k) for n, c, k in zip(names, zip(*out), kinds)})


def edit_stability(docs: DataFrame, words: np.ndarray, key: str = "doc_id", text: str = "text", log_bits: int = 23) -> DataFrame:
    """Fingerprints of every text and of its edit: its last quarter gives way to the start of the next text by key.

    Neighbouring keys travel in blocks of ``BLOCK``; the first row of a block also visits the block before.
    Texts are shuffled once. A null key has the block before all others.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[key].cast("long").alias("key"), docs[text].cast("string").alias("text"))
    none = -(2**62)
    block = F.coalesce(F.shiftright("key", BLOCK.bit_length() - 1), F.lit(none))
    firsts = stored(rows.groupBy(block.alias("block")).agg(F.min("key").alias("key")), "block-heads")
    order = successors(firsts, "block")
    visits = firsts.join(order.select(F.col("block").alias("before"), F.col("next").alias("block")), "block")
    visits = stored(visits.select("before", F.col("block").alias("home"), F.col("key").alias("head")), "visits")
    wanted = spark.sparkContext.broadcast(BitSet.of(visits, "head", log_bits))
    heads = map_batches(rows, Heads(wanted), Heads.schema)
    # The first row of a block by key, then text; rows without a key have a block of their own.
    heads = heads.join(visits, F.col("key") == F.col("head")).groupBy("before", "key").agg(F.min("text").alias("text"))
    bare = rows.where("key is null").select(F.min("text").alias("text"), F.count(F.lit(1)).alias("n")).where("n > 0")
    before = visits.where(F.col("home") == none).agg(F.max("before").alias("before")).scalar()
    bare = bare.select(before.alias("before"), F.lit(None).cast("long").alias("key"), "text")
    own = rows.select(block.alias("block"), F.lit(False).alias("visitor"), "key", "text")
    guests = heads.union(bare).select(F.col("before").alias("block"), F.lit(True).alias("visitor"), "key", "text")
    dealt = own.union(guests).repartition(partitions(spark), "block").sortWithinPartitions("block", "visitor", "key", "text")
    shared = spark.sparkContext.broadcast(Lexicon(words))
    return map_batches(dealt, Edited(shared), Edited.schema).withColumnRenamed("key", key)
