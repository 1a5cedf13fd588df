"""N-gram Jaccard join: exact near-copy components over word shingles.

Method. Every text becomes the sorted set of the 64-bit hashes of its k-word shingles, in one scan that writes
the head of each set (eight bytes a shingle) to the shared folder; equal sets are one class. Whole sets are made again from the
texts only where the head does not settle the prefix or a pair is to be decided. Two sets within the threshold share a token among the first few of each under any
common order, so tokens of these prefixes are the tile keys, and inside a tile a set only meets
sets of its own size band (sizes within the threshold's ratio). A pair passes on only if the bit
parities of two hashed bitmaps leave room for enough overlap: each differing bit has an
element that only one set has. The pairs left are decided by intersecting the sorted arrays.

Two texts that have much in common share many tiles, so tiles with the same members become one, with the number of them, before
anything is paired: pairs follow the groups of texts, not their tokens.

The order puts tokens of many texts last; they are marked in a bit set of fixed size, and an
error in it changes the work only, since the order is the same for all rows. A first
round compares each member of a tile with a lead of its size band. Pairs within a component change nothing, so further rounds give
each member of a large tile its best partner in another component, while that links one in twenty, and the last
round takes all pairs of a tile whose components still differ.
No tile lists all its pairs, and no link between components is lost.

Nulls: a null text is an empty set, linked with nothing. A row with a null key is returned with a
null component. Repeated keys: each row belongs to the class of its own text. Very long texts only lengthen their own
arrays. An empty table gives an empty table. Other columns are not read. The texts are read up to four times, so they
should be a stored table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from regionlake.llm.base import BitSet, binary, discard, map_batches, partitions, signed, stored, table, texts_of
from regionlake.llm.components import components
from regionlake.llm.words import mixed, shingles, slices, words
from regionlake.session import settings

FLUSH = 1 << 20  # rows a task holds before it hands them on
LARGE = 32  # members of a tile from which each first looks for its best partner
MAPPED = 8  # members of a tile from which their bitmaps travel with them; below, pairs are bounded later


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    for batch in batches:
        for lo, hi, data, offsets in slices(batch["text"]):
            yield batch["key"].slice(lo, hi - lo), shingles(words(data, offsets), k)


def _identity(tokens: np.ndarray) -> int:
    """Hash of a whole set, 0 for the empty one."""
    if not len(tokens):
        return 0
    place = mixed(np.arange(1, len(tokens) + 1, dtype=np.uint64))
    total = np.bitwise_xor.reduce(mixed(tokens ^ place), keepdims=True)
    return int(mixed(total ^ mixed(np.array([len(tokens)], np.uint64)))[0]) or 1


def _width(n: int) -> int:
    """Bits of a bitmap: a power of two at least twice the set's size, so that few elements of a difference share a bit."""
    return 1 << max(6, (2 * n - 1).bit_length())


def _bitmap(tokens: np.ndarray) -> bytes:
    """Whether a bit has an odd number of elements: what two sets share leaves no trace in their difference."""
    width = _width(len(tokens))
    bits = (np.bincount((tokens & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1).astype(np.uint8)
    return np.packbits(bits, bitorder="little").tobytes()


def differing(a: bytes, b: bytes) -> int:
    """A lower bound of the elements that only one set has; the wider bitmap is folded to the narrower."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) > len(y):
        x, y = y, x
    if len(y) > len(x):
        y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def shared(n: int) -> int:
    """Tokens that a set of ``n`` must share with another in their prefixes; longer prefixes ask for more."""
    return max(2, n // 20)


def _prefix(n: int, percent: int) -> int:
    """A set within the threshold has at least ``need`` tokens in common, ``shared`` of them among these."""
    need = -(-percent * n // 100)
    return min(n, n - need + min(shared(n), need))


class Signatures:
    """The scan of the texts: size and identity of each row's set; prefix tokens that a task sees often.

    The bitmap and the head, half as long again as the prefix, come along with the first row of a task that has the set.
    """

    schema = "key bigint, n bigint, set_id bigint, bitmap binary, tokens binary, token bigint, seen bigint"

    def __init__(self, k: int, percent: int, often: int = 2):
        self.k, self.percent, self.often = k, percent, often

    def __call__(self, batches):
        pending: list[np.ndarray] = []
        known = {0}
        for keys, sets in _sets(batches, self.k):
            ids = [_identity(s) for s in sets]
            new = [i not in known and not known.add(i) for i in ids]
            pending += [s[: _prefix(len(s), self.percent)] for s in sets]
            yield self._rows(keys, np.array(ids, np.uint64), sets, new)
            if sum(map(len, pending)) > 4 * FLUSH:
                yield self._tokens(pending)
                pending = []
        if pending:
            yield self._tokens(pending)

    def _rows(self, keys, ids, sets, new):
        n = len(sets)
        heads = binary([s[: 3 * _prefix(len(s), self.percent) // 2].tobytes() if first else None for s, first in zip(sets, new)])
        return table({
            "key": keys.cast(pa.int64()), "n": np.array([len(s) for s in sets], np.int64), "set_id": signed(ids),
            "bitmap": binary([_bitmap(s) if first else None for s, first in zip(sets, new)]), "tokens": heads,
            "token": pa.nulls(n, pa.int64()), "seen": pa.nulls(n, pa.int64()),
        })

    def _tokens(self, pending):
        tokens, seen = np.unique(np.concatenate(pending), return_counts=True)
        tokens, seen = tokens[seen >= self.often], seen[seen >= self.often]
        none = pa.nulls(len(tokens), pa.int64())
        empty = pa.nulls(len(tokens), pa.binary())
        return table({"key": none, "n": none, "set_id": none, "bitmap": empty, "tokens": empty, "token": signed(tokens), "seen": seen.astype(np.int64)})


class Prefixes:
    """(token, n, set_id) of each prefix, tokens of many texts last, from heads or whole sets; heads too short for it are left out."""

    schema = "token bigint, n bigint, set_id bigint"

    def __init__(self, percent: int, common):
        self.percent, self.common = percent, common

    def of(self, batch: pa.RecordBatch) -> list[np.ndarray | None]:
        common = self.common.value
        found = []
        for x, n in zip(batch["tokens"], batch["n"].to_pylist()):
            s, take = np.frombuffer(x.as_buffer(), np.uint64), _prefix(n, self.percent)
            head = s[:take]
            if common.has(head).any():
                late = common.has(s)
                head = s[~late][:take]
                if len(head) < take:
                    head = np.concatenate((head, s[late][: take - len(head)])) if len(s) == n else None
            found.append(head)
        return found

    def __call__(self, batches):
        for batch in batches:
            heads = self.of(batch)
            each = np.array([0 if x is None else len(x) for x in heads], np.int64)
            if each.any():
                yield table({"token": signed(np.concatenate([x for x in heads if x is not None])),
                             "n": np.repeat(batch["n"].to_numpy(), each), "set_id": np.repeat(batch["set_id"].to_numpy(), each)})


class Short(Prefixes):
    """Keys of the rows whose head is too short for the prefix."""

    schema = "key bigint"

    def __call__(self, batches):
        for batch in batches:
            yield batch.select(["key"]).filter(pa.array([x is None for x in self.of(batch)], pa.bool_()))


class Whole:
    """The whole sets of the rows asked for, of these only the sets asked for if those are given."""

    schema = "set_id bigint, n bigint, tokens binary"

    def __init__(self, k: int, rows, sets=None):
        self.k, self.rows, self.sets = k, rows, sets

    def __call__(self, batches):
        for batch in batches:
            found = batch.filter(pa.array(self.rows.value.has(batch["row"].to_numpy()), pa.bool_()))
            if not found.num_rows:
                continue
            for _, sets in _sets([found], self.k):
                ids = signed(np.array([_identity(s) for s in sets], np.uint64))
                keep = np.array([len(s) > 0 for s in sets], bool)
                if self.sets:
                    keep &= self.sets.value.has(ids)
                kept = [s for s, k in zip(sets, keep) if k]
                yield table({"set_id": ids[keep], "n": np.array([len(s) for s in kept], np.int64), "tokens": binary([s.tobytes() for s in kept])})


def whole_groups(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[pa.Table]:
    """Rows sorted by the bigint column ``by``, cut between groups."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch[by].to_numpy()
        cut = int(np.searchsorted(key, key[-1]))
        if cut or (kept and kept[-1][by][-1].as_py() != key[0]):
            yield pa.Table.from_batches([*kept, batch.slice(0, cut)])
            kept = []
        kept.append(batch.slice(cut))
    if kept:
        yield pa.Table.from_batches(kept)


class Tiles:
    """Members of the tiles with two or more sets, each with a lead of its band and of the band below.

    The lead is the set that most tasks hold: copies are often made from one text that is itself common.
    Rows of ``Alike`` bring the tasks as ``seen``; there, ``copies`` is the number of tiles with these members.
    """

    schema = "token bigint, n bigint, set_id bigint, members bigint, copies bigint, lead bigint, lead_n bigint, below bigint, below_n bigint"

    def __init__(self, percent: int):
        self.ratio = math.log(100 / percent)

    def members(self, batches):
        """Arrays of (token, n, set, rows, tasks, members) and the first members of their tiles."""
        for g in whole_groups(batches, "token"):
            token, n, own = (g[c].to_numpy() for c in ("token", "n", "set_id"))
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (own[1:] != own[:-1])
            at = np.flatnonzero(new)
            rows = np.diff(np.append(at, len(token)))
            seen = np.maximum.reduceat(g["seen"].to_numpy(), at) if "seen" in g.column_names else rows
            token, n, own = token[new], n[new], own[new]
            first = np.ones(len(token), bool)
            first[1:] = token[1:] != token[:-1]
            size = np.diff(np.append(np.flatnonzero(first), len(token)))
            members = np.repeat(size, size)
            keep = members > 1
            if keep.any():
                yield [x[keep] for x in (token, n, own, rows, seen, members, first)]

    def __call__(self, batches):
        for token, n, own, rows, seen, members, first in self.members(batches):
            band = np.floor(np.log(n) / self.ratio)
            head = first.copy()
            head[1:] |= band[1:] != band[:-1]
            run = np.cumsum(head) - 1
            order = np.lexsort((-seen, run))
            lead = order[np.searchsorted(run[order], np.arange(run[-1] + 1))]
            prior = lead[np.maximum(run - 1, 0)]
            prior = np.where(token[prior] == token, prior, lead[run])
            yield table({"token": token, "n": n, "set_id": own, "members": members, "copies": rows.astype(np.int64), "lead": own[lead[run]],
                         "lead_n": n[lead[run]], "below": own[prior], "below_n": n[prior]})


class Alike(Tiles):
    """Members of the tiles with two or more sets, under a hash of the members instead of the token.

    Two tiles under one hash by chance are taken as one with the members of both, which changes the work only.
    """

    schema = "token bigint, n bigint, set_id bigint, seen bigint"

    def __call__(self, batches):
        for _, n, own, _, seen, members, first in self.members(batches):
            at = np.flatnonzero(first)
            every = np.add.reduceat(mixed(own.view(np.uint64)), at)
            name = mixed(every ^ mixed(members[at].astype(np.uint64)))
            yield table({"token": signed(np.repeat(name, members[at])), "n": n, "set_id": own, "seen": seen.astype(np.int64)})


class AcrossPairs:
    """Pairs of a tile's members of fitting sizes that are in different components, with the tiles that have them.

    A tile counts as often as its ``copies`` say, if given. Members of a large tile bring their bitmaps, and only pairs within the bound leave it; with ``best``, of each
    member only the pair with the most room for overlap.
    """

    schema = "a bigint, b bigint, na bigint, nb bigint, tiles bigint"

    def __init__(self, percent: int, best: bool = False):
        self.percent, self.best = percent, best

    def __call__(self, batches):
        held: list[np.ndarray] = []
        for g in whole_groups(batches, "token"):
            token, n, own, comp = (g[c].to_numpy() for c in ("token", "n", "set_id", "component"))
            copies = g["copies"].to_numpy() if "copies" in g.column_names else np.ones(len(token), np.int64)
            large = g["bitmap"].is_valid().to_numpy()
            for x, y in (*self._small(np.flatnonzero(~large), token, n, comp), *self._large(g, np.flatnonzero(large), token, n, comp)):
                flip = own[x] > own[y]
                x, y = np.where(flip, y, x), np.where(flip, x, y)
                held.append(np.stack((own[x], own[y], n[x], n[y], np.maximum(copies[x], copies[y])), 1))
                if sum(map(len, held)) > FLUSH:
                    yield self._counted(held)
                    held = []
        if held:
            yield self._counted(held)

    def _small(self, rows, token, n, comp):
        """All pairs at distance 1, 2, ... while any has fitting sizes."""
        at, step = np.arange(len(rows)), 1
        while True:
            at = at[at + step < len(rows)]
            x, y = rows[at], rows[at + step]
            fit = (token[x] == token[y]) & (100 * n[x] >= self.percent * n[y])
            at, x, y = at[fit], x[fit], y[fit]
            if not len(at):
                return
            part = comp[x] != comp[y]
            yield x[part], y[part]
            step += 1

    def _large(self, g, rows, token, n, comp):
        """Each member of a tile against the larger ones of fitting sizes, by the bits of their bitmaps."""
        cuts = np.flatnonzero(np.diff(token[rows])) + 1
        for tile in np.split(rows, cuts) if len(rows) else ():
            maps = [np.frombuffer(x.as_buffer(), np.uint64) for x in g["bitmap"].take(pa.array(tile))]
            size, width = n[tile], np.array([len(m) for m in maps])
            high = np.searchsorted(size, 100 * size // self.percent, "right")
            for w in np.unique(width):
                lo, hi = int(np.searchsorted(width, w)), int(np.searchsorted(width, 2 * w, "right"))
                bits = np.stack([np.bitwise_xor.reduce(m.reshape(-1, w), axis=0) for m in maps[lo:hi]])
                for i in range(lo, int(np.searchsorted(width, w, "right"))):
                    far = np.arange(i + 1, high[i])
                    far = far[comp[tile[far]] != comp[tile[i]]]
                    if len(far):
                        differ = np.bitwise_count(bits[far - lo] ^ bits[i - lo]).sum(1, dtype=np.int64)
                        both = (size[i] + size[far] - differ) // 2
                        fit = (100 + self.percent) * both >= self.percent * (size[i] + size[far])
                        if self.best and fit.any():
                            share = both / (size[i] + size[far])
                            fit = np.arange(len(far)) == int(np.argmax(share))
                        far = far[fit]
                        if len(far):
                            yield np.full(len(far), tile[i]), tile[far]

    def _counted(self, held):
        rows = np.concatenate(held)
        order = np.lexsort((rows[:, 1], rows[:, 0]))
        rows = rows[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
        at = np.flatnonzero(new)
        count = np.add.reduceat(rows[:, 4], at)
        return table({**{c: np.ascontiguousarray(rows[at, i]) for i, c in enumerate(("a", "b", "na", "nb"))}, "tiles": count})


class Bounded:
    """Pairs whose bitmaps leave room for enough overlap."""

    schema = "a bigint, b bigint"

    def __init__(self, percent: int):
        self.percent = percent

    def __call__(self, batches):
        p = self.percent
        for batch in batches:
            na, nb = batch["na"].to_pylist(), batch["nb"].to_pylist()
            keep = [
                (100 + p) * ((m + n - differing(x, y)) // 2) >= p * (m + n)
                for m, n, x, y in zip(na, nb, batch["x"].to_pylist(), batch["y"].to_pylist())
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


class Exact:
    """Pairs whose sorted arrays intersect enough."""

    schema = "a bigint, b bigint"

    def __init__(self, percent: int):
        self.percent = percent

    def __call__(self, batches):
        p = self.percent
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"]):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.intersect1d(x, y, assume_unique=True).size
                keep.append((100 + p) * both >= p * (len(x) + len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


class Join:
    """The steps of one join over one corpus."""

    def __init__(self, docs: DataFrame, key: str, text: str, k: int, percent: int, log_bits: int):
        self.spark: SparkSession = docs.sparkSession
        self.texts = texts_of(docs, key, text).withColumn("key", F.col("key").cast("bigint"))
        self.k, self.percent, self.log_bits = k, percent, log_bits

    def share(self, bits: BitSet):
        return self.spark.sparkContext.broadcast(bits)

    def rows(self) -> DataFrame:
        self.scan = scan = stored(map_batches(self.texts, Signatures(self.k, self.percent), Signatures.schema), "signatures")
        self.heads = scan.where("tokens is not null").select("key", "n", "set_id", "tokens")
        self.seen = scan.where("token is not null").groupBy("token").agg(F.sum("seen").alias("seen"))
        return scan.where("token is null").select("key", "n", "set_id", "bitmap")

    def keys(self, rows: DataFrame):
        """The rows' keys, null included, as a bit set of their hashes."""
        return self.share(BitSet.of(rows.select(F.xxhash64("key").alias("row")), "row", self.log_bits))

    def whole(self, rows, sets=None) -> DataFrame:
        return map_batches(self.texts.withColumn("row", F.xxhash64("key")), Whole(self.k, rows, sets), Whole.schema)

    def tiles(self) -> DataFrame:
        """Tokens count as common from 16 texts, and from more where more than 2**(log_bits-3) tokens would."""
        total = self.seen.agg(F.sum("seen")).first()[0] or 0
        least = max(16, total >> (self.log_bits - 3))
        common = self.share(BitSet.of(self.seen.where(F.col("seen") >= least), "token", self.log_bits))
        short = self.keys(map_batches(self.heads, Short(self.percent, common), Short.schema))
        each = Prefixes(self.percent, common)
        prefixes = map_batches(self.heads, each, each.schema).union(map_batches(self.whole(short), each, each.schema))
        alike = map_batches(self.by_token(prefixes), Alike(self.percent), Alike.schema)
        return stored(map_batches(self.by_token(alike), Tiles(self.percent), Tiles.schema), "tiles")

    def placed(self, tiles: DataFrame, comps: DataFrame, bitmaps: DataFrame | None) -> DataFrame:
        """Members of tiles with their components, and with their bitmaps where these are given."""
        own = tiles.select("token", "n", "set_id", "copies").join(comps.select(F.col("node").alias("set_id"), "component"), "set_id", "left")
        own = own.withColumn("component", F.coalesce("component", "set_id"))
        own = own.withColumn("bitmap", F.lit(None).cast("binary")) if bitmaps is None else own.join(bitmaps, "set_id")
        own = own.select("token", "n", "set_id", "copies", "component", "bitmap")
        return own

    def by_token(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(partitions(self.spark), "token").sortWithinPartitions("token", "n", "set_id")

    def bounded(self, pairs: DataFrame, bitmaps: DataFrame, label: str) -> DataFrame:
        """The pairs (a, b) of (a, b, na, nb) whose bitmaps leave room for the threshold."""
        side = lambda name, by, col: bitmaps.select(F.col("set_id").alias(by), F.col(col).alias(name))
        near = pairs.join(side("x", "a", "bitmap"), "a").join(side("y", "b", "bitmap"), "b").select("a", "b", "na", "nb", "x", "y")
        return stored(map_batches(near, Bounded(self.percent), Bounded.schema), label)

    def arrays(self, sets: DataFrame, classes: DataFrame, label: str) -> DataFrame:
        """(set_id, tokens) of the sets asked for, made again from a row of each."""
        rows = classes.join(sets.distinct(), "set_id", "left_semi").select(F.col("rep").alias("key"))
        found = self.whole(self.keys(rows), self.share(BitSet.of(sets, "set_id", self.log_bits)))
        return stored(found.groupBy("set_id").agg(F.first("tokens").alias("tokens")), f"{label}-arrays")

    def exact(self, near: DataFrame, arrays: DataFrame, label: str) -> DataFrame:
        x, y = (arrays.select(F.col("set_id").alias(by), F.col("tokens").alias(name)) for by, name in (("a", "x"), ("b", "y")))
        both = near.join(x, "a").join(y, "b").select("a", "b", "x", "y")
        return stored(map_batches(both, Exact(self.percent), Exact.schema), f"{label}-links")


def _links(join: Join) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows' sets, the classes of equal sets, and links between classes that join each component; tables go when nothing reads them again."""
    percent = join.percent
    scan = join.rows()
    rows = stored(scan.select("key", "n", "set_id"), "rows")
    classes = stored(rows.where("n > 0").groupBy("set_id").agg(F.min("key").alias("rep")), "classes")
    bitmaps = scan.where("n > 0").groupBy("set_id").agg(F.max("bitmap").alias("bitmap"))
    bitmaps = stored(bitmaps, "bitmaps")
    tiles = join.tiles()
    discard(join.scan)
    fits = (F.col("a") != F.col("b")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    star = None
    for lead in ("lead", "below"):
        flip = F.col(lead) > F.col("set_id")
        part = tiles.select(
            F.least(lead, "set_id").alias("a"), F.greatest(lead, "set_id").alias("b"),
            F.when(flip, F.col("n")).otherwise(F.col(f"{lead}_n")).alias("na"),
            F.when(flip, F.col(f"{lead}_n")).otherwise(F.col("n")).alias("nb"),
        ).where(fits)
        star = part if star is None else star.union(part)
    ends = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("set_id"))
    first = join.bounded(star.groupBy("a", "b").agg(F.max("na").alias("na"), F.max("nb").alias("nb")), bitmaps, "star")
    large = tiles.where(F.col("members") > LARGE)
    arrays = join.arrays(ends(first).union(large.select("set_id")), classes, "large")
    links = join.exact(first, arrays, "star")
    comps = components(links)
    while True:
        best = map_batches(join.by_token(join.placed(large, comps, bitmaps)), AcrossPairs(percent, best=True), AcrossPairs.schema)
        asked = stored(best.select("a", "b").distinct(), "best")
        more = join.exact(asked, arrays, "best")
        found = more.count()
        if found:
            links = stored(links.union(more), "links")
            comps = components(links)
        if 20 * found <= asked.count():
            break
    discard(arrays)
    few, many = tiles.where(F.col("members") <= MAPPED), tiles.where(F.col("members") > MAPPED)
    dealt = join.placed(few, comps, None).unionByName(join.placed(many, comps, bitmaps))
    dealt = join.by_token(dealt)
    across = map_batches(dealt, AcrossPairs(percent), AcrossPairs.schema)
    less = F.least("na", "nb")
    need = F.least(F.greatest(F.lit(2), F.floor(less / 20)), F.ceil(less * percent / 100))
    across = across.groupBy("a", "b").agg(F.max("na").alias("na"), F.max("nb").alias("nb"), F.sum("tiles").alias("tiles"))
    second = join.bounded(across.where(F.col("tiles") >= need), bitmaps, "across")
    discard(tiles)
    discard(bitmaps)
    arrays = join.arrays(ends(second), classes, "across")
    second = join.exact(second, arrays, "across")
    discard(arrays)
    named = links.union(second)
    for end in ("a", "b"):
        named = named.join(classes.select(F.col("set_id").alias(end), F.col("rep").alias(f"{end}_rep")), end)
    return rows, classes, named


def ngram_jaccard(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 4, percent: int = 85,
                  log_bits: int = 23) -> DataFrame:
    """(``key``, ``n_shingles``, ``component_id``) of each row.

    Two texts link when 100 * intersection >= ``percent`` * union over their distinct ``k``-word shingles.
    ``log_bits`` sets the size of the broadcast bit sets (2**log_bits bits; 1 MB by default, whatever the corpus).
    """
    join = Join(docs, key, text, k, percent, log_bits)
    # Shuffle files go with the write that read them.
    with settings(join.spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        rows, classes, named = _links(join)
        groups = components(named, "a_rep", "b_rep")
    of_class = classes.join(groups.select(F.col("node").alias("rep"), "component"), "rep", "left")
    of_class = of_class.select("set_id", F.coalesce("component", "rep").alias("component"))
    whole = rows.select("key", "n", "set_id").join(of_class, "set_id", "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("component", "key"))
    return whole.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))
