"""Phrases whose words stick together: exact n-gram counts in counting quotient filters, scored at their weakest cut.

Method. Texts become blocks of word numbers. Level by level the n-grams of a block are pairs of numbers: of the phrase that begins here and of the
one that begins a word later, both one word shorter and both frequent; no other n-gram can reach the least count. A pair is packed into one
key, and a Feistel network permutes the keys of exactly that many bits. The high bits are the quotient, the rest is the full
remainder, so nothing is lost and the permutation is undone to read a pair. A block's filter keeps for each quotient the sorted
remainders and their counts in one byte each, with larger counts aside. Filters are shuffled by quotient and merged there: equal remainders add up.
Remainders that reach the least count get numbers, each block hears which of its own did, and its positions become the numbers of the next level.
Words go the same way, by a hash of the word in place of the permutation and with the word itself as remainder.

At scale: everything moves as a few filters a block, of 8 MB of text or one longer text; a block holds each n-gram once, however often it occurs, so a hot phrase, source or group of
copies is one entry a block. Quotients follow the number of shuffle partitions. The driver sees one offset a quotient. Each level is written to the shared folder, so that
a lost executor costs only the tasks that it held, and removed when the next one is there. Numbers of a level take 32 bits: more than 4 294 967 295 frequent phrases of one length end in an error,
not in wrong counts.

Nulls: a null text has no words, a null language is ``und``. Very long texts are one block of their own; very long words are words. Ties of a cut go to the
first one, ties of score and count to the phrase in byte order. Repeated rows count each time. An empty table, or one
without frequent phrases, gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from regionlake.llm.base import discard, map_batches, partitions, stored, table
from regionlake.llm.spans import LOWER, ranges, runs
from regionlake.llm.words import SLICE_BYTES, slices

BLOCK_BYTES = 8 << 20

_CUT = np.zeros(256, bool)
_CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_INSIDE = ~_CUT
_INSIDE[[0x20, 0x09]] = False

# A row is a block's text as numbers, or one quotient of a block's filter.
FILTER = "block bigint, body binary, quotient int, size int, remainders binary, small binary, large binary"
MERGED = "quotient int, block bigint, at binary, nth binary, size int, keys binary, counts binary"


def packed(a: np.ndarray) -> bytes:
    """Whole numbers from 0 on, compressed byte by byte of equal weight; numbers in order as differences."""
    if not len(a):
        return b""
    a = a.astype(np.uint64)
    ordered = bool((a[1:] >= a[:-1]).all())
    a = np.diff(a, prepend=np.uint64(0)) if ordered else a
    width = next(w for w in (1, 2, 4, 8) if int(a.max()) < 1 << 8 * w)
    planes = a.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()
    return bytes([width | (16 if ordered else 0)]) + pa.compress(planes, "zstd", asbytes=True)


def unpacked(raw: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    width, ordered = raw[0] & 15, raw[0] & 16
    planes = np.frombuffer(pa.decompress(raw[1:], n * width, "zstd", asbytes=True), np.uint8)
    a = np.ascontiguousarray(planes.reshape(width, n).T).view(f"<u{width}").ravel().astype(np.uint64)
    return np.cumsum(a, dtype=np.uint64) if ordered else a


def whole_numbers(raw: bytes, n: int) -> np.ndarray:
    return unpacked(raw, n).astype(np.int64)


def small_large(counts: np.ndarray) -> tuple[bytes, bytes]:
    """One byte a count; 255 refers to the next of the large ones."""
    return packed(np.minimum(counts, 255)), counts[counts >= 255].astype("<i8").tobytes()


def counts_of(small: bytes, large: bytes, n: int) -> np.ndarray:
    out = whole_numbers(small, n)
    out[out == 255] = np.frombuffer(large, "<i8")
    return out


def packed_words(words: list[bytes]) -> bytes:
    sizes, joined = packed(np.array([len(w) for w in words])), b"".join(words)
    return len(sizes).to_bytes(4, "big") + sizes + pa.compress(joined, "zstd", asbytes=True)


def unpacked_words(raw: bytes, n: int) -> pa.Array:
    cut = 4 + int.from_bytes(raw[:4], "big")
    ends = np.concatenate(([0], np.cumsum(whole_numbers(raw[4:cut], n))))
    data = pa.decompress(raw[cut:], int(ends[-1]), "zstd") if ends[-1] else pa.py_buffer(b"")
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends), data])


class Permutation:
    """Invertible map of pairs of ``half``-bit numbers onto keys of twice as many bits: a Feistel network of four rounds."""

    ROUNDS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]

    def __init__(self, half: int):
        self.half, self.mask = np.uint64(half), np.uint64((1 << half) - 1)

    def _round(self, x: np.ndarray, by: np.uint64) -> np.ndarray:
        x = (x + np.uint64(1)) * by
        x ^= x >> np.uint64(29)
        return (x * self.ROUNDS[1]) >> np.uint64(32) & self.mask

    def keys(self, first: np.ndarray, rest: np.ndarray) -> np.ndarray:
        left, right = first.astype(np.uint64), rest.astype(np.uint64)
        for by in self.ROUNDS:
            left, right = right, left ^ self._round(right, by)
        return left << self.half | right

    def pairs(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left, right = keys >> self.half, keys & self.mask
        for by in reversed(self.ROUNDS):
            left, right = right ^ self._round(left, by), left
        return left.astype(np.int64), right.astype(np.int64)


def _row(block: int | None, body: bytes | None, quotient=None, size=None, remainders=None, small=None, large=None) -> dict:
    return {"block": block, "body": body, "quotient": quotient, "size": size, "remainders": remainders, "small": small, "large": large}


_ARROW = {"block": pa.int64(), "body": pa.binary(), "quotient": pa.int32(), "size": pa.int32(), "remainders": pa.binary(), "small": pa.binary(),
          "large": pa.binary()}


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in _ARROW.items()], names=list(_ARROW))


class Words:
    """A block of texts: its words with their languages numbered, and the texts as numbers.

    A word stands behind its language and that one's length in bytes.
    """

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.bodies: list[np.ndarray] = []
        self.spoken: Counter[str] = Counter()
        self.bytes = 0

    def add(self, langs: np.ndarray, names: list[str], data: np.ndarray, offsets: np.ndarray) -> None:
        low = LOWER[data]
        start, end, row = runs(_INSIDE[low], offsets)
        edge = np.concatenate(([0], np.cumsum(end - start)))
        letters = pa.py_buffer(low[ranges(start, end - start)])
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(edge), letters]).dictionary_encode()
        pair = coded.indices.to_numpy().astype(np.int64) * len(names) + langs[row]
        own, at = np.unique(pair, return_inverse=True)
        heads = [len(n.encode()).to_bytes(4, "big") + n.encode() for n in names]
        full = (heads[k % len(names)] + w for k, w in zip(own.tolist(), coded.dictionary.take(pa.array(own // len(names))).to_pylist()))
        known = self.known
        number = np.fromiter((known.setdefault(w, len(known) + 1) for w in full), np.int64, len(own))
        # One zero between words that a mark, a line or a text's end separates, and one behind the last.
        after = np.zeros(len(start), np.int64)
        if len(start):
            pieces = np.cumsum(_CUT[low])[start]
            after[1:] = np.cumsum((np.diff(row) > 0) | (np.diff(pieces) > 0))
            body = np.zeros(len(start) + int(after[-1]) + 1, np.uint32)
            body[np.arange(len(start)) + after] = number[at]
            self.bodies.append(body)
        for name, n in zip(names, np.bincount(langs[row], minlength=len(names)).tolist()):
            self.spoken[name] += n
        self.bytes += len(data)

    def rows(self, block: int, quotients: int) -> Iterator[dict]:
        """The body with the words of each language, and the words by quotient; ``body`` then has their numbers."""
        body = np.concatenate(self.bodies) if self.bodies else np.zeros(0, np.uint32)
        langs = [(n.encode(), c) for n, c in self.spoken.items() if c]
        yield _row(block, packed(body), size=len(body), remainders=packed_words([n for n, _ in langs]),
                   large=np.array([c for _, c in langs], "<i8").tobytes())
        counts = np.bincount(body, minlength=len(self.known) + 1)
        full = list(self.known)
        quotient = np.fromiter((zlib.crc32(w) % quotients for w in full), np.int64, len(full))
        order = np.argsort(quotient, kind="stable")
        cuts = np.flatnonzero(np.diff(quotient[order], prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            own = np.array(sorted(order[a:b].tolist(), key=full.__getitem__))
            yield _row(block, packed(own + 1), int(quotient[own[0]]), b - a, packed_words([full[i] for i in own.tolist()]), *small_large(counts[own + 1]))


def word_filters(docs: DataFrame, quotients: int, block_bytes: int, lang: str, text: str) -> DataFrame:
    """Blocks of word numbers, and the words of each block by quotient. In a word row ``body`` holds the words' numbers."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 32, Words()
        for batch in batches:
            coded = batch.column("lang").dictionary_encode()
            names, langs = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            for lo, hi, data, offsets in slices(batch.column("text"), min(block_bytes, SLICE_BYTES)):
                block.add(langs[lo:hi], names, data, offsets)
                if block.bytes >= block_bytes:
                    yield _batch(list(block.rows(number, quotients)))
                    number, block = number + 1, Words()
        if block.bytes:
            yield _batch(list(block.rows(number, quotients)))

    of = docs.select(F.coalesce(docs[lang].cast("string"), F.lit("und")).alias("lang"), docs[text].cast("string").alias("text"))
    return stored(map_batches(of, cut, FILTER), "word-filters")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """Rows of each quotient; they arrive sorted by it."""
    held, quotient = [], None
    for batch in batches:
        for r in batch.to_pylist():
            if held and r["quotient"] != quotient:
                yield quotient, held
                held = []
            quotient = r["quotient"]
            held.append(r)
    if held:
        yield quotient, held


def _merged(filters: DataFrame, quotients: int, union: Callable, least: int, label: str) -> DataFrame:
    """Filters of all blocks merged by quotient.

    A row without block holds the remainders with ``least`` or more and their counts; a row with a block says which
    of the block's entries (``at``) they are (``nth``).
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for quotient, rows in _groups(batches):
            sizes = np.array([r["size"] for r in rows])
            entry, frequent, counts, keys = union(rows, sizes, least)
            out = [(quotient, None, b"", b"", len(counts), keys, packed(counts))]
            ends = np.cumsum(sizes)
            for r, a, b in zip(rows, ends - sizes, ends):
                mine = np.flatnonzero(frequent[entry[a:b]] > 0)
                if len(mine):
                    nth = frequent[entry[a:b][mine]] - 1
                    at = unpacked(r["body"], b - a)[mine] if r["body"] else mine
                    out.append((quotient, r["block"], packed(at), packed(nth), len(mine), b"", b""))
            names = [c.split()[0] for c in MERGED.split(", ")]
            types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    dealt = filters.where(F.col("quotient").isNotNull()).repartition(max(1, min(quotients, partitions(filters.sparkSession))), "quotient")
    return stored(map_batches(dealt.sortWithinPartitions("quotient"), merge, MERGED), label)


def _union_words(rows: list[dict], sizes: np.ndarray, least: int):
    coded = pa.concat_arrays([unpacked_words(r["remainders"], n) for r, n in zip(rows, sizes.tolist())]).dictionary_encode()
    entry = coded.indices.to_numpy()
    total = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(total, entry, np.concatenate([counts_of(r["small"], r["large"], n) for r, n in zip(rows, sizes.tolist())]))
    kept = np.flatnonzero(total >= least)
    frequent = np.zeros(len(total), np.int64)
    frequent[kept] = np.arange(1, len(kept) + 1)
    return entry, frequent, total[kept], packed_words(coded.dictionary.take(pa.array(kept)).to_pylist())


def _union_keys(rows: list[dict], sizes: np.ndarray, least: int):
    keys = np.concatenate([unpacked(r["remainders"], n) for r, n in zip(rows, sizes.tolist())])
    known, entry = np.unique(keys, return_inverse=True)
    total = np.zeros(len(known), np.int64)
    np.add.at(total, entry, np.concatenate([counts_of(r["small"], r["large"], n) for r, n in zip(rows, sizes.tolist())]))
    kept = np.flatnonzero(total >= least)
    frequent = np.zeros(len(total), np.int64)
    frequent[kept] = np.arange(1, len(kept) + 1)
    return entry, frequent, total[kept], packed(known[kept])


def _offsets(merged: DataFrame, quotients: int) -> np.ndarray:
    """Numbers given before each quotient; one entry a quotient, and the total at the end."""
    found = merged.where(F.col("block").isNull()).select("quotient", "size").toPandas()
    sizes = np.zeros(quotients + 1, np.int64)
    sizes[found["quotient"].to_numpy(np.int64) + 1] = found["size"].to_numpy(np.int64)
    out = np.cumsum(sizes)
    if out[-1] >= 1 << 32:
        raise ValueError("more frequent phrases of one length than numbers of 32 bits; raise the least count")
    return out


def _dense(body: np.ndarray) -> np.ndarray:
    """Without positions that have no neighbour, and with single zeros between the others."""
    alive = body > 0
    near = np.zeros(len(body), bool)
    both = alive[1:] & alive[:-1]
    near[1:] |= both
    near[:-1] |= both
    body = np.where(near, body, 0)
    keep = near.copy()
    keep[1:] |= near[:-1]
    return body[keep]


def _pair_rows(block: int, body: np.ndarray, half: int, bits: int) -> Iterator[dict]:
    """The body, and its filter: sorted remainders and counts of each quotient, the key's ``bits`` high bits."""
    body = _dense(body)
    if not len(body):
        return
    yield _row(block, packed(body), size=len(body))
    here = np.flatnonzero((body[:-1] > 0) & (body[1:] > 0))
    keys, counts = np.unique(Permutation(half).keys(body[here], body[here + 1]), return_counts=True)
    shift = np.uint64(2 * half - bits)
    quotient = (keys >> shift).astype(np.int64)
    rest = keys & ((np.uint64(1) << shift) - np.uint64(1))
    cuts = np.flatnonzero(np.diff(quotient, prepend=-1, append=-1))
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield _row(block, None, int(quotient[a]), b - a, packed(rest[a:b]), *small_large(counts[a:b]))


def _half_bits(numbers: int, bits: int) -> int:
    """Bits of one number, enough that a key has ``bits`` for the quotient."""
    return max(int(numbers).bit_length(), -(-bits // 2))


def _answers(merged: DataFrame) -> DataFrame:
    told = merged.where(F.col("block").isNotNull()).select(F.col("block").alias("_block"), F.struct("quotient", "size", "at", "nth").alias("one"))
    return told.groupBy("_block").agg(F.collect_list("one").alias("told"))


def _next(filters: DataFrame, merged: DataFrame, offsets: np.ndarray, bits: int, half: int | None, label: str) -> DataFrame:
    """Bodies and filters of the next level: numbers of frequent entries in place of what the blocks held.

    ``half`` is the width of the numbers in the keys just merged, None after words.
    """
    wide = _half_bits(offsets[-1], bits)

    def renumber(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                body = whole_numbers(r["body"], r["size"])
                if half is None:
                    number = np.zeros(int(body.max(initial=0)) + 1, np.int64)
                    for t in r["told"]:
                        number[whole_numbers(t["at"], t["size"])] = offsets[t["quotient"]] + 1 + whole_numbers(t["nth"], t["size"])
                    new = number[body]
                else:
                    new = np.zeros(len(body), np.int64)
                    here = np.flatnonzero((body[:-1] > 0) & (body[1:] > 0))
                    keys = Permutation(half).keys(body[here], body[here + 1])
                    known, entry = np.unique(keys, return_inverse=True)
                    first = np.searchsorted(known >> np.uint64(2 * half - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
                    number = np.zeros(len(known), np.int64)
                    for t in r["told"]:
                        at = first[t["quotient"]] + whole_numbers(t["at"], t["size"])
                        number[at] = offsets[t["quotient"]] + 1 + whole_numbers(t["nth"], t["size"])
                    new[here] = number[entry]
                found = list(_pair_rows(r["block"], new, wide, bits))
                if found:
                    yield _batch(found)

    bodies = filters.where(F.col("quotient").isNull()).select("block", "size", "body")
    both = bodies.hint("merge").join(_answers(merged).hint("merge"), F.col("block") == F.col("_block")).drop("_block")
    return stored(map_batches(both, renumber, FILTER), label)


def _entries(merged: DataFrame, offsets: np.ndarray, decode: Callable, schema: str) -> DataFrame:
    """One row for each frequent entry of a level, with its number and count."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                n = r["size"]
                if n:
                    number = offsets[r["quotient"]] + 1 + np.arange(n)
                    yield table({"number": number, "f": whole_numbers(r["counts"], n)} | decode(r["quotient"], r["keys"], n))

    return map_batches(merged.where(F.col("block").isNull()), rows, "number bigint, f bigint, " + schema)


def _word_of(quotient: int, raw: bytes, n: int) -> dict:
    both = unpacked_words(raw, n).to_pylist()
    after = [4 + int.from_bytes(x[:4], "big") for x in both]
    return {"lang": pa.array([x[4:i].decode() for x, i in zip(both, after)], pa.string()),
            "word": pa.array([x[i:].decode("utf-8", "replace") for x, i in zip(both, after)], pa.string())}


def frequent_phrases(docs: DataFrame, least: int = 100, longest: int = 5, lang: str = "lang", text: str = "text",
                     block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """All runs of 1 to ``longest`` words within pieces that occur ``least`` times or more in a language, with exact counts.

    Returns (lang, words, f, prefixes, suffixes, longer), where ``prefixes[i]`` and ``suffixes[i]`` are the counts of the first and
    last i + 1 words and ``longer`` is the highest count of a phrase one word longer that holds it, and (lang, n) with all word occurrences.
    """
    spark = docs.sparkSession
    bits = max(4, partitions(spark).bit_length())
    quotients = 1 << bits
    filters = word_filters(docs, quotients, block_bytes, lang, text)
    n = _occurrences(filters)
    merged = _merged(filters, quotients, _union_words, least, "words")
    offsets = _offsets(merged, quotients)
    words = _entries(merged, offsets, _word_of, "lang string, word string")
    whole = stored(words.select("number", "lang", F.array("word").alias("words"), "f", F.array("f").alias("prefixes"), F.array("f").alias("suffixes")),
                   "phrases-1")
    levels, half = [], None
    for k in range(2, longest + 1):
        before = (filters, merged)
        filters = _next(filters, merged, offsets, bits, half, f"filters-{k}")
        for done in before:  # the next level is written, nothing reads these again
            discard(done)
        half = _half_bits(offsets[-1], bits)
        merged = _merged(filters, quotients, _union_keys, least, f"merged-{k}")
        offsets = _offsets(merged, quotients)

        def pair_of(quotient: int, raw: bytes, n: int, half=half) -> dict:
            first, rest = Permutation(half).pairs(unpacked(raw, n) | np.uint64(quotient) << np.uint64(2 * half - bits))
            return {"first": first, "rest": rest}

        pairs = _entries(merged, offsets, pair_of, "first bigint, rest bigint")
        shorter = whole
        first = shorter.select(F.col("number").alias("first"), "lang", F.col("words").alias("head"), F.col("prefixes").alias("before"))
        rest = shorter.select(F.col("number").alias("rest"), F.element_at("words", -1).alias("last"), F.col("suffixes").alias("after"))
        whole = stored(pairs.join(first, "first").join(rest, "rest").select(
            "number", "lang", F.concat("head", F.array("last")).alias("words"), "f", F.concat("before", F.array("f")).alias("prefixes"),
            F.concat("after", F.array("f")).alias("suffixes"), "first", "rest"), f"phrases-{k}")
        inside = whole.select(F.col("first").alias("number"), "f").union(whole.select(F.col("rest").alias("number"), "f"))
        levels.append(shorter.drop("first", "rest").join(inside.groupBy("number").agg(F.max("f").alias("longer")), "number", "left"))
    levels.append(whole.drop("first", "rest").withColumn("longer", F.lit(None).cast("long")))
    out = levels[0]
    for level in levels[1:]:
        out = out.union(level)
    return out.drop("number"), n


def _occurrences(filters: DataFrame) -> DataFrame:
    """(lang, n): word occurrences of each language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, n in zip(batch.column("remainders").to_pylist(), batch.column("large").to_pylist()):
                counts = np.frombuffer(n, "<i8")
                yield table({"lang": unpacked_words(names, len(counts)).cast(pa.large_string()).cast(pa.string()), "n": counts})

    rows = map_batches(filters.where(F.col("quotient").isNull()).select("remainders", "large"), count, "lang string, n bigint")
    return stored(rows.groupBy("lang").agg(F.sum("n").alias("n")), "occurrences")


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, factor: int = 1000, inside_percent: int = 100, top: int = 2000,
                 lang: str = "lang", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    A phrase's score is ``floor(factor * a * n / (l * r))`` at its lowest cut. Phrases that lie in a longer one with ``inside_percent`` of
    their count or more are left out.
    """
    phrases, n = frequent_phrases(docs, least, longest, lang, text, block_bytes)
    wide = lambda c: F.col(c).cast("decimal(38,0)") if isinstance(c, str) else c.cast("decimal(38,0)")
    phrases = phrases.where((F.size("words") > 1) & ~F.coalesce(100 * F.col("longer") >= inside_percent * F.col("f"), F.lit(False)))
    counted = phrases.join(n, "lang")
    k = F.size("words")

    def cut(i):
        left, right = F.element_at("prefixes", i), F.element_at("suffixes", k - i)
        score = F.call_function("div", wide("f") * wide("n") * factor, wide(left) * wide(right))
        return F.struct(score.alias("score"), i.alias("k"), left.alias("l"), right.alias("r"))

    lowest = F.array_min(F.transform(F.sequence(F.lit(1), k - 1), cut))
    scored = counted.withColumn("cut", lowest).select(
        "lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
        F.col("cut.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
