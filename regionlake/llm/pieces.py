"""SentencePiece encoding and decoding with merge-type vocabularies.

Method. The library normalises a text. It is cut where no piece can cross: before a run of word
marks, when no piece has a mark behind another symbol, and around line breaks that no longer piece contains.
Each segment is encoded by an agenda: adjacent symbol pairs that form a piece wait in a heap by
score, leftmost first on a tie; a popped pair whose symbols still stand is merged and its new neighbours join the
agenda. What is left is looked up, unknown characters as their bytes. Segments repeat, so each Python
worker keeps the ids of a bounded number of short ones, the latest used, whatever the corpus.

``agreement`` compares whole texts with the library in Arrow batches; ``encode`` does so for the
first text of each run of rows and fails on a difference, so a vocabulary of another type is refused.

Nulls: a null text counts as empty and has no ids; null ids decode to the empty text; keys pass through as
they are. Very long texts and segments cost n log n. Repeated rows stay. An empty table gives an empty one.
"""

from __future__ import annotations

import re
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from regionlake.llm.base import map_batches, table
from regionlake.llm.words import slices

CACHE = 450_000  # words of a generation; parts of words have three times as many
CACHED_LENGTH = 48
MARK = "▁"
UNKNOWN_TEXT = " ⁇ "


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class Vocabulary:
    """Pieces, scores and the agenda of one model."""

    def __init__(self, model: bytes):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        count = lib.vocab_size()
        names = [lib.id_to_piece(i) for i in range(count)]
        plain = [i for i in range(count) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        self.unknown = lib.unk_id()
        self.ids = {names[i]: i for i in plain}
        self.cost = {names[i]: -lib.get_score(i) for i in plain if len(names[i]) > 1}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.has_bytes = all(lib.is_byte(i) for i in self.bytes)
        self.split_marks = not any(MARK in p.lstrip(MARK) for p in self.cost)
        self.split_lines = not any("\n" in p for p in self.cost)
        self.text = {i: names[i].replace(MARK, " ") for i in plain} | {self.unknown: UNKNOWN_TEXT}
        self.opens = {i for i in plain if names[i].startswith(MARK)}  # lose the mark at the start of a text
        self.text |= {i: "" for i in range(count) if lib.is_control(i)}
        if self.has_bytes:
            self.text |= {self.bytes[b]: chr(b) for b in range(128)}
        self.high = {self.bytes[b]: b for b in range(128, 256)} if self.has_bytes else {}
        self.low = {self.bytes[b]: b for b in range(128)} if self.has_bytes else {}
        self.raw = {p: np.int32(i).tobytes() for p, i in self.ids.items()}
        self.touching = {p[i : i + 2] for p in self.cost for i in range(len(p) - 1)}
        self.solid = _Cache(self.agenda, 3 * CACHE)
        self.marked = _Cache(lambda s: self.segment(MARK + s), CACHE)
        self.bare = _Cache(self.segment, CACHE)
        self.line = self.symbol("\n")

    def symbol(self, s: str) -> bytes:
        found = self.raw.get(s)
        if found is not None:
            return found
        if self.has_bytes:
            return np.array([self.bytes[b] for b in s.encode()], np.int32).tobytes()
        return np.int32(self.unknown).tobytes()

    def segment(self, s: str) -> bytes:
        """Ids of one segment, as 32-bit integers; no piece joins two characters that touch in none."""
        whole = self.solid.get(s)
        if whole is not None:
            return whole
        touching, out, lo = self.touching, [], 0
        for i in range(1, len(s)):
            if s[i - 1 : i + 1] not in touching:
                out.append(self.part(s[lo:i]))
                lo = i
        out.append(self.part(s[lo:]))
        return b"".join(out)

    def part(self, s: str) -> bytes:
        return self.raw.get(s) or self.solid[s]

    def agenda(self, s: str) -> bytes:
        n, cost = len(s), self.cost
        end = list(range(1, n + 1))  # of the symbol that starts here; 0: merged away
        before = list(range(-1, n))
        agenda = [(c, i, i + 1, i + 2) for i in range(n - 1) if (c := cost.get(s[i : i + 2])) is not None]
        heapify(agenda)
        while agenda:
            _, left, middle, stop = heappop(agenda)
            if end[left] != middle or end[middle] != stop:
                continue
            end[left], end[middle] = stop, 0
            before[stop] = left
            if left > 0:
                prior = before[left]
                c = cost.get(s[prior:stop])
                if c is not None:
                    heappush(agenda, (c, prior, left, stop))
            if stop < n:
                c = cost.get(s[left : end[stop]])
                if c is not None:
                    heappush(agenda, (c, left, stop, end[stop]))
        out, i, raw = [], 0, self.raw
        while i < n:
            piece = s[i : end[i]]
            out.append(raw.get(piece) or self.symbol(piece))
            i = end[i]
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        text = self.library.normalize(text)
        if not text:
            return b""
        if not self.split_marks:
            found = self.segment(text)
        else:
            lines = text.split("\n") if self.split_lines else [text]
            found = self.line.join(map(self._line, lines))
        return found if self.has_bytes else self._unknown_once(found)

    def _line(self, line: str) -> bytes:
        first, *rest = line.split(MARK)
        head = self.bare[first] if first else b""
        if "" in rest:
            runs = re.findall(f"{MARK}+[^{MARK}]*", line[len(first):])
            return head + b"".join([self.marked[r[1:]] for r in runs])
        return head + b"".join(map(self.marked.__getitem__, rest))

    def _unknown_once(self, ids: bytes) -> bytes:
        """Without byte pieces the library gives neighbouring unknown symbols one id."""
        a = np.frombuffer(ids, np.int32)
        again = np.zeros(len(a), bool)
        again[1:] = (a[1:] == self.unknown) & (a[:-1] == self.unknown)
        return a[~again].tobytes()

    def decode(self, ids: list[int]) -> str:
        if not ids:
            return ""
        skip = 1 if ids[0] in self.opens else 0
        if self.high and not self.high.keys().isdisjoint(ids):
            return self._with_bytes(ids)[skip:]
        return "".join(map(self.text.__getitem__, ids))[skip:]

    def _with_bytes(self, ids: list[int]) -> str:
        out, run = [], bytearray()
        for i in ids:
            b = self.high.get(i, self.low.get(i))
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(characters(bytes(run)))
                run.clear()
            out.append(self.text[i])
        return "".join(out) + characters(bytes(run))


class _Cache(dict):
    """Values of a function for short strings, in two generations: what the older one gives is kept on."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.older = make, limit // 2, {}

    def __missing__(self, s: str) -> bytes:
        found = self.older.get(s)
        if found is None:
            found = self.make(s)
        if len(s) <= CACHED_LENGTH:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[s] = found
        return found


def characters(raw: bytes) -> str:
    """UTF-8 bytes as text; each byte that is part of no character becomes U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError as problem:
        good = raw[: problem.start].decode()
        return good + "�" + characters(raw[problem.start + 1 :])


_known: dict[bytes, Vocabulary] = {}


def vocabulary(model: bytes) -> Vocabulary:
    """One vocabulary and cache for each model and Python worker."""
    if model not in _known:
        _known[model] = Vocabulary(model)
    return _known[model]


class Encode:
    def __init__(self, model):
        self.model = model

    def __call__(self, batches):
        v = vocabulary(self.model.value)
        for batch in batches:
            for lo, hi, *_ in slices(batch["text"]):
                texts = [x or "" for x in batch["text"].slice(lo, hi - lo).to_pylist()]
                ids = [v.encode(t) for t in texts]
                if v.library.encode(texts[0]) != np.frombuffer(ids[0], np.int32).tolist():
                    raise ValueError("this vocabulary is not of the merge type: the library gives other ids")
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
                values = pa.array(np.frombuffer(b"".join(ids), np.int32))
                yield table({"key": batch["key"].slice(lo, hi - lo), "ids": pa.ListArray.from_arrays(pa.array(ends), values)})


class RoundTrip:
    """Ids and the text they decode to, in one pass."""

    def __init__(self, model):
        self.model = model

    def __call__(self, batches):
        v = vocabulary(self.model.value)
        for batch in Encode(self.model)(batches):
            ends = batch["ids"].offsets.to_pylist()
            ids = batch["ids"].values.to_pylist()
            decoded = pa.array([v.decode(ids[a:b]) for a, b in zip(ends, ends[1:])], pa.string())
            yield pa.RecordBatch.from_arrays([batch["key"], batch["ids"], decoded], names=["key", "ids", "decoded"])


class Decode:
    def __init__(self, model):
        self.model = model

    def __call__(self, batches):
        v = vocabulary(self.model.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = pa.array([v.decode(x) for x in part["ids"].fill_null([]).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([part["key"], part["ids"], texts], names=["key", "ids", "decoded"])


class Agreement:
    def __init__(self, model):
        self.model = model

    def __call__(self, batches):
        v = vocabulary(self.model.value)
        for batch in batches:
            for lo, hi, *_ in slices(batch["text"]):
                texts = [x or "" for x in batch["text"].slice(lo, hi - lo).to_pylist()]
                theirs = v.library.encode(texts, num_threads=1)
                same = [
                    np.frombuffer(v.encode(t), np.int32).tolist() == ids and v.decode(ids) == text
                    for t, ids, text in zip(texts, theirs, v.library.decode(theirs))
                ]
                yield table({"key": batch["key"].slice(lo, hi - lo), "agrees": pa.array(same, pa.bool_())})


def _shared(df: DataFrame, model: str | bytes):
    """The model's bytes for every executor; a vocabulary has a fixed size."""
    return df.sparkSession.sparkContext.broadcast(model_bytes(model) if isinstance(model, str) else model)


def _keyed(df: DataFrame, key: str, column: str, name: str) -> DataFrame:
    return df.select(df[key].alias("key"), df[column].alias(name))


def encode(df: DataFrame, model: str | bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, ``ids`` array<int>) of every text."""
    kind = df.schema[key].dataType.simpleString()
    texts = _keyed(df, key, text, "text").withColumn("text", F.col("text").cast("string"))
    return map_batches(texts, Encode(_shared(df, model)), f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(df: DataFrame, model: str | bytes, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(``key``, ``ids``, ``decoded``) of every row of ids."""
    kind = df.schema[key].dataType.simpleString()
    rows = _keyed(df, key, ids, "ids").withColumn("ids", F.col("ids").cast("array<int>"))
    out = map_batches(rows, Decode(_shared(df, model)), f"key {kind}, ids array<int>, decoded string")
    return out.withColumnRenamed("key", key)


def round_trip(df: DataFrame, model: str | bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, ``ids``, ``decoded``) of every text: ``encode`` and ``decode`` without handing the ids back and forth."""
    kind = df.schema[key].dataType.simpleString()
    texts = _keyed(df, key, text, "text").withColumn("text", F.col("text").cast("string"))
    out = map_batches(texts, RoundTrip(_shared(df, model)), f"key {kind}, ids array<int>, decoded string")
    return out.withColumnRenamed("key", key)


def agreement(df: DataFrame, model: str | bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, ``agrees``): whether ids and decoded text equal the library's, for every text."""
    kind = df.schema[key].dataType.simpleString()
    texts = _keyed(df, key, text, "text").withColumn("text", F.col("text").cast("string"))
    return map_batches(texts, Agreement(_shared(df, model)), f"key {kind}, agrees boolean").withColumnRenamed("key", key)
