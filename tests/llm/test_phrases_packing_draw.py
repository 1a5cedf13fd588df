"""Collocations, packing and importance resampling against brute force and on edge cases."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from regionlake.llm import collocations, importance, packing

JSON = public_tokenizers.path("byte_bpe_50k.json")
MODEL = packing.model_text(JSON)
LIBRARY = Tokenizer.from_file(JSON)
LIBRARY.encode_special_tokens = True


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def prose(rows, words, seed, mark=".,;:!?\n\x0b\x0c\r", few=4, most=60):
    random.seed(seed)
    out = []
    for i in range(rows):
        text = ""
        for _ in range(random.randint(few, most)):
            text += random.choice(words) + random.choice([" ", " ", "  ", "\t", random.choice(mark) + " "])
        out.append((i, text))
    return out


def brute_phrases(rows, least, longest, top, inside=100):
    f, total = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = []
        often = {p: a for p, a in counts.items() if a >= least}
        held = collections.defaultdict(int)
        for p, a in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    held[p[i : i + k]] = max(held[p[i : i + k]], a)
        for p, a in often.items():
            if len(p) < 2 or (p in held and 100 * held[p] >= inside * a):
                continue
            cuts = [(1000 * a * total[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), a, counts[p[:k]], counts[p[k:]], total[lang], score))
        for rank, x in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, x[2].decode(), *x[3:]))
    return sorted(out)


LANGS = "doc_id long, text string, lang string, phrase int, quotient string"


@pytest.mark.parametrize("block_bytes,inside", [(4 << 20, 100), (300, 100), (2000, 60)])
def test_collocations_equal_brute_force(spark, block_bytes, inside):
    random.seed(block_bytes)
    rows = [(i, t, random.choice(["en", "en", "de", None, "é\0x"])) for i, t in prose(120, ["The", "old", "é日本", "house", "of", "wind", "x" * 40, "it's"], 7)]
    rows += [(900 + i, "a fixed phrase that repeats. the old house", "en") for i in range(30)]
    rows += [(None, "the old house of wind", "en"), (5, None, "en"), (5, "", None)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], LANGS).repartition(3)
    got = collocations.collocations(docs, least=6, top=40, inside_percent=inside, block_bytes=block_bytes)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_phrases([(r[2], r[1]) for r in rows], 6, 5, 40, inside)


def test_counts_above_a_byte_and_long_texts(spark):
    rows = [(1, "left right " * 120_000, "en", 1, "x"), (2, "left right, " * 40, "en", 1, "x")]  # 1.3 MB; a count far above 255
    assert len(rows[0][1]) > 1 << 20
    got = collocations.collocations(spark.createDataFrame(rows, LANGS), least=40, longest=3, block_bytes=1 << 16)
    assert sorted(tuple(r) for r in got.collect()) == brute_phrases([(r[2], r[1]) for r in rows], 40, 3, 2000)


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], LANGS)
    assert collocations.collocations(empty).collect() == []
    rare = spark.createDataFrame([(1, "once only here", "en", 1, "x")], LANGS)
    assert collocations.collocations(rare).collect() == []


@pytest.mark.parametrize("half", [3, 17, 32])
def test_permutation_is_invertible(half):
    rng = np.random.default_rng(half)
    a, b = (rng.integers(0, 1 << half, 5000) for _ in range(2))
    keys = collocations.Permutation(half).keys(a, b)
    first, rest = collocations.Permutation(half).pairs(keys)
    assert (first == a).all() and (rest == b).all() and (half == 32 or int(keys.max()) < 1 << 2 * half)
    counts = np.array([1, 254, 255, 256, 10**12, 3])
    assert collocations.counts_of(*collocations.small_large(counts), len(counts)).tolist() == counts.tolist()


def brute_best_fit(lengths, limit):
    room = []
    for x in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= x]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - x)
        else:
            room.append(limit - x)
    return sorted(room)


@pytest.mark.parametrize("limit", [1, 7, 64, 100])
def test_best_fit_equals_one_search_a_piece(limit):
    for seed in range(60):
        random.seed(seed)
        lengths = [random.randint(1, random.choice([limit, limit, max(1, limit // 4)])) for _ in range(random.randint(0, 300))]
        used = collections.defaultdict(list)
        for length, first, n, sequence, each, offset in packing.best_fit(collections.Counter(lengths), limit).tolist():
            for j in range(n):
                used[sequence + j // each].append((offset + j % each * length, length))
        for places in used.values():
            ends = 0
            for offset, length in sorted(places):
                assert offset == ends
                ends += length
        assert sorted(limit - sum(x for _, x in p) for p in used.values()) == brute_best_fit(lengths, limit)


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("limit", [16, 1024])
def test_packing_holds_all_ids(docs, edges, limit):
    rows = [(i, t) for i, t in prose(150, ["word", "naïve", "日本", "12345", "<|endoftext|>", "the"], 3, most=90)] + [(7, "long text " * 60_000)]
    table = docs(rows).union(edges).withColumn("length", F.lit("x")).withColumn("task", F.lit(1))
    packed = packing.pack(table, MODEL, public_tokenizers.PATTERN, limit).collect()
    texts = collections.Counter((r.doc_id, tuple(ids_of(r.text))) for r in table.collect())
    whole, open_ = collections.Counter(), collections.defaultdict(list)
    for r in sorted(packed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.piece)):
        assert len(r.ids) == 4 * r.length and 1 <= r.length <= limit and (r.piece == 0 or r.length == limit)
        assert r.start == (0 if r.piece == 0 else r.start) and r.offset + r.length <= limit
    assert sum(r.length for r in packed) == sum(len(k[1]) * n for k, n in texts.items())
    for key in {k for k, _ in texts if k is not None and sum(n for (a, _), n in texts.items() if a == k) == 1}:
        own = sorted((r for r in packed if r.doc_id == key), key=lambda r: r.piece)
        ids = tuple(x for r in own for x in np.frombuffer(r.ids, "<u4").tolist())
        assert texts[key, ids] == 1 and [r.start for r in own] == list(np.cumsum([0] + [r.length for r in own])[:-1])
        whole[key] += 1
    assert len(whole) > 100
    for r in packed:
        open_[r.sequence_id].append((r.offset, r.length))
    for places in open_.values():
        assert [o for o, _ in sorted(places)] == list(np.cumsum([0] + [n for _, n in sorted(places)])[:-1])
    assert sorted(limit - sum(n for _, n in p) for p in open_.values()) == brute_best_fit([r.length for r in packed], limit)


def test_sequences_join_their_pieces(docs):
    packed = packing.pack(docs([(1, "a b c"), (2, ""), (3, None), (4, "x " * 40)]), MODEL, public_tokenizers.PATTERN, 32)
    pieces = collections.defaultdict(list)
    for r in packed.collect():
        pieces[r.sequence_id].append((r.offset, bytes(r.ids)))
    got = {r.sequence_id: (r.length, bytes(r.ids)) for r in packing.sequences(packed).collect()}
    assert got == {k: (sum(len(b) for _, b in v) // 4, b"".join(b for _, b in sorted(v))) for k, v in pieces.items()}


def test_packing_of_nothing_and_of_blanks(docs):
    assert packing.pack(docs([]), MODEL, public_tokenizers.PATTERN).collect() == []
    blanks = " " * 1_200_000 + "a"  # the pattern of the fast encoder gives up on it
    rows = packing.pack(docs([(1, blanks)]), MODEL, public_tokenizers.PATTERN).collect()
    own = [x for r in sorted(rows, key=lambda r: r.piece) for x in np.frombuffer(r.ids, "<u4").tolist()]
    assert own == ids_of(blanks)


def brute_draw(rows, items, longest, buckets, percent, least, seed):
    def grams(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
        return len(w), [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = (collections.Counter(bucket(g) for _, text in table for g in grams(text)[1]) for table in (rows, items))
    gain = lambda b: math.floor(1000 * math.log(
        (t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    out = []
    for key, text in rows:
        n, found = grams(text)
        weight = sum(gain(bucket(g)) for g in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    enough = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, r in enumerate(enough[: len(enough) * percent // 100], 1):
        r[5] = rank
    return sorted(((r[0], *r[2:]) for r in out), key=repr)


@pytest.mark.parametrize("longest,buckets", [(1, 10_000), (3, 97)])
def test_resampling_equals_brute_force(spark, docs, longest, buckets):
    words = ["The", "RIVER", "naïve", "日本語", "x9", "under_score", "a-b", "zz", "q" * 70, "É"]
    rows = prose(200, words, 11) + [(None, "river the the " * 10), (400, None), (401, ""), (402, "!!"), (403, "the " * 300_000)]
    items = [(i, t) for i, t in prose(9, words[:4], 12)] + [(None, None)]
    target = spark.createDataFrame(items, "item_id long, text string")
    table = docs(rows).withColumn("rank", F.lit("clash")).withColumn("bucket", F.lit(1))
    got = importance.resample(table, target, longest, buckets, percent=30, least_words=20, seed=5)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_draw(rows, items, longest, buckets, 30, 20, 5)


def test_resampling_of_repeats_and_of_nothing(spark, docs):
    target = spark.createDataFrame([(1, "the river")], "item_id long, text string")
    same = importance.resample(docs([(7, "the river " * 15)] * 6 + [(8, "short")]), target, percent=50).collect()
    assert sorted(r["rank"] for r in same if r["rank"]) == [1, 2, 3] and len(same) == 7
    assert importance.resample(docs([]), target).collect() == []
    none = importance.resample(docs([(1, "some words here")]), target.limit(0)).collect()
    assert len(none) == 1 and none[0]["rank"] is None


def test_equal_keys_of_different_bytes_stay_apart(monkeypatch):
    monkeypatch.setattr(importance.xxhash, "xxh64_intdigest", lambda b: len(b) % 2)
    data = np.frombuffer(b"aa bb aa cc b aa ", np.uint8)
    text, start, size, row, _ = importance.features(data, np.array([0, len(data)]), 1)
    seen = importance.Interned(text, start, size, 1000)
    assert sorted(seen.count[seen.used].tolist()) == [1, 1, 1, 3] and len(set(seen.slot.tolist())) == 4
