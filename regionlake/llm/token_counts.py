"""Token counts of texts that are edited: pre-token segment trees.

Method. A text is cut into pre-tokens by the tokenizer's pattern; ``LEAF`` neighbours are a leaf with their code
points and tokens, and a segment tree keeps the sums of both. An edit finds its leaves by the tree of
code points, re-encodes from the leaf that holds the boundary context before it, and goes on until a pre-token ends where
an old leaf ended; a match of the pattern depends only on the text from its start on, so all that follows is as it was. The
changed leaves and the sums above them are updated; the root is the new count.

``context`` code points before an edit are read again: a pre-token's end can depend on as many code points behind it (two in
the patterns given).

Nulls: a null text or replacement is empty, null or missing edits change nothing. Edits apply one after the other, each
in the code points of the text before it; places beyond the text's end mean its end. Very long texts cost a logarithm more
an edit. Repeated rows stay; empty tables give empty tables; other columns are not read.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F

from regionlake.llm.base import map_batches, table

LEAF = 16
CACHE = 400_000


def ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a ranks file: a token in base 64 and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Counter:
    """Tokens of pre-tokens, the latest remembered."""

    def __init__(self, pattern: str, vocabulary: dict[bytes, int]):
        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("counted", pat_str=pattern, mergeable_ranks=vocabulary, special_tokens={})
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def count(self, piece: str) -> int:
        found = self.known.get(piece)
        if found is None:
            found = self.older.get(piece)
            if found is None:
                found = len(self.encoding.encode_ordinary(piece))
            if len(self.known) >= CACHE // 2:
                self.known, self.older = {}, self.known
            self.known[piece] = found
        return found


class Tree:
    """Sums of code points and tokens over leaves, in heap order."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.width = 1 << max(0, (len(chars) - 1).bit_length())
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        self.sums[self.width : self.width + len(chars), 0] = chars
        self.sums[self.width : self.width + len(chars), 1] = tokens
        level = self.width
        while level > 1:
            level //= 2
            self.sums[level : 2 * level] = self.sums[2 * level : 4 * level].reshape(level, 2, 2).sum(1)
        self.touched = 0

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a code point, and the code points before it; the last leaf for the end."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            left = int(self.sums[node, 0])
            if place >= before + left and self.sums[node + 1, 0]:
                before += left
                node += 1
        return node - self.width, before

    def set(self, first: int, last: int, chars: int, tokens: int) -> None:
        """Give a leaf new sums and empty those after it up to ``last``."""
        lo, hi = first + self.width, last + self.width
        self.sums[lo : hi + 1] = 0
        self.sums[lo] = chars, tokens
        while lo > 1:
            lo, hi = lo // 2, hi // 2
            self.sums[lo : hi + 1] = self.sums[2 * lo : 2 * hi + 2].reshape(-1, 2, 2).sum(1)
            self.touched += hi - lo + 1


def leaves(counter: Counter, text: str) -> tuple[list[int], list[int]]:
    """Code points and tokens of the leaves; one empty leaf for an empty text."""
    found = counter.pattern.findall(text)
    known, count = counter.known, counter.count
    tokens = [known.get(p) or count(p) for p in found]
    chars = list(map(len, found))
    return ([sum(chars[i : i + LEAF]) for i in range(0, len(found), LEAF)] or [0],
            [sum(tokens[i : i + LEAF]) for i in range(0, len(found), LEAF)] or [0])


def edit(counter: Counter, tree: Tree, text: str, start: int, stop: int, new: str, context: int) -> tuple[str, int]:
    """The text after an edit, with the tree brought up to date, and how many code points were encoded again."""
    n = len(text)
    start = min(max(start, 0), n)
    stop = min(max(stop, start), n)
    after = text[:start] + new + text[stop:]
    first, begin = tree.leaf_at(max(0, start - context))
    last, before = tree.leaf_at(stop)
    shift = len(after) - n
    width = tree.sums[tree.width :]
    end = before + int(width[last, 0])  # of the old leaf; the first that ends at or behind the edit
    place, tokens = begin, 0
    for m in counter.pattern.finditer(after, begin) if begin < len(after) else ():
        place = m.end()
        tokens += counter.count(m.group())
        while end + shift < place and last + 1 < len(width):
            last += 1
            end += int(width[last, 0])
        if place == end + shift and place >= start + len(new):
            break
    while end < n and end + shift < place and last + 1 < len(width):
        last += 1
        end += int(width[last, 0])
    if place >= len(after):
        last = len(width) - 1
    tree.set(first, last, place - begin, tokens)
    return after, place - begin


_counters: dict[tuple, Counter] = {}


class _Shared:
    """The pattern and vocabulary of a tokenizer, of fixed size, on every executor."""

    def __init__(self, df: DataFrame, pattern: str, vocabulary: dict[bytes, int]):
        self.pattern, self.value = pattern, df.sparkSession.sparkContext.broadcast(vocabulary)

    def counter(self) -> Counter:
        key = (self.pattern, len(self.value.value), hash(frozenset(self.value.value.items())))
        if key not in _counters:
            _counters[key] = Counter(self.pattern, self.value.value)
        return _counters[key]


class Build:
    def __init__(self, shared: _Shared):
        self.shared = shared

    def __call__(self, batches):
        counter = self.shared.counter()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                found = [leaves(counter, t or "") for t in part["text"].to_pylist()]
                yield table({
                    "key": part["key"], "text": part["text"].fill_null(""), "chars": pa.array([c for c, _ in found], pa.list_(pa.int32())),
                    "tokens": pa.array([t for _, t in found], pa.list_(pa.int32())), "n_tokens": pa.array([sum(t) for _, t in found], pa.int64()),
                })


class Apply:
    def __init__(self, shared: _Shared, context: int):
        self.shared, self.context = shared, context

    def __call__(self, batches):
        counter = self.shared.counter()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows = [self._row(counter, r) for r in part.select(["text", "chars", "tokens", "edits"]).to_pylist()]
                kinds = (pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.int64())
                names = ("text", "chars", "tokens", "n_tokens", "reencoded", "nodes")
                yield table({"key": part["key"], **{n: pa.array(c, k) for n, c, k in zip(names, zip(*rows), kinds)}})

    def _row(self, counter: Counter, row: dict) -> tuple:
        text, again = row["text"] or "", 0
        tree = Tree(row["chars"] or [0], row["tokens"] or [0])
        for e in row["edits"] or ():
            if e is not None:
                start = len(text) if e["start"] is None else e["start"]
                text, n = edit(counter, tree, text, start, start if e["stop"] is None else e["stop"], e["replacement"] or "", self.context)
                again += n
        own = tree.sums[tree.width :]
        own = own[own[:, 0] > 0] if len(text) else own[:1]
        return text, own[:, 0].tolist(), own[:, 1].tolist(), tree.tokens, again, tree.touched


EDITS = "array<struct<start:int,stop:int,replacement:string>>"


def token_trees(docs: DataFrame, pattern: str, vocabulary: dict[bytes, int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, ``text``, ``chars``, ``tokens``, ``n_tokens``): the leaves of each text's tree, to be stored with it."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    schema = f"key {kind}, text string, chars array<int>, tokens array<int>, n_tokens long"
    return map_batches(rows, Build(_Shared(docs, pattern, vocabulary)), schema).withColumnsRenamed({"key": key, "text": text})


def apply_edits(trees: DataFrame, edits: str, pattern: str, vocabulary: dict[bytes, int], key: str = "doc_id", text: str = "text",
                context: int = 4) -> DataFrame:
    """The trees after each row's ``edits`` (``EDITS``), with the code points ``reencoded`` and the tree ``nodes`` updated."""
    kind = trees.schema[key].dataType.simpleString()
    rows = trees.select(trees[key].alias("key"), trees[text].alias("text"), "chars", "tokens", trees[edits].cast(EDITS).alias("edits"))
    schema = f"key {kind}, text string, chars array<int>, tokens array<int>, n_tokens long, reencoded long, nodes long"
    return map_batches(rows, Apply(_Shared(trees, pattern, vocabulary), context), schema).withColumnsRenamed({"key": key, "text": text})
