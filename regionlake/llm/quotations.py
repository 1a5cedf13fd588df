"""Chat formatting by quotation linking: messages that quote others become reply-ordered conversations without quotes.

Method. Leading ``>`` marks give a line's quote level; neighbouring lines of a level are a passage, and what has no mark
is the message's own text (a line that only announces a quote, ending in "wrote:", goes with it). Passages are normalised (case, white space)
and hashed. A message answers the one whose own text equals a passage it quotes at level 1; failing that, one that has a line of it.
Of several candidates the earliest in the scope counts, so each hash has one original and a
frequent text makes no product. Roots and depths come from pointer doubling over the parents: rounds grow with the
logarithm of the longest chain of replies, and no conversation is gathered into one task.

A conversation reads in the order of (root, depth, position). Nulls: a null text is empty; rows whose scope or position is null are
returned as roots of their own and link with nothing. Rows that repeat a scope and position share the link of their message (the least parent).
Only earlier messages are candidates, so replies have no cycles. Deep quotes (level 2 and more) are dropped from the text like the others.
Empty tables give empty tables. Other columns pass through; names that begin with ``_q_`` are the operator's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from regionlake.llm.base import stored

MARKS = r"^\s*(>[>\s]*)"
ANNOUNCES = r"(?i)\bwrote:\s*$"


def parsed(text: Column) -> Column:
    """array<struct<level, body>> of the lines."""
    def line(l):
        marks = F.regexp_extract(l, MARKS, 1)
        level = F.char_length(F.regexp_replace(marks, "[^>]", ""))
        return F.struct(level.alias("level"), F.when(level > 0, F.regexp_replace(l, MARKS, "")).otherwise(l).alias("body"))

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), line)


def _next_level(lines: str) -> Column:
    """Each line with the level of the line after it."""
    return F.transform(lines, lambda l, i: F.struct(l["level"].alias("level"), l["body"].alias("body"),
                                                   F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)).alias("next")))


def own_text(lines: str) -> Column:
    """What the message says itself."""
    keep = F.filter(_next_level(lines), lambda l: (l["level"] == 0) & ~((l["next"] > 0) & l["body"].rlike(ANNOUNCES)))
    return F.rtrim(F.array_join(F.transform(keep, lambda l: l["body"]), "\n"))


def passages(lines: str, level: int) -> Column:
    """Runs of neighbouring lines of one level, each joined by line feeds."""
    start = F.array().cast("array<array<string>>")

    def step(acc, l):
        last = F.element_at(acc["runs"], -1)
        more = F.concat(F.slice(acc["runs"], 1, F.size(acc["runs"]) - 1), F.array(F.concat(last, F.array(l["body"]))))
        runs = F.when(l["level"] != level, acc["runs"]).when(acc["open"], more).otherwise(F.concat(acc["runs"], F.array(F.array(l["body"]))))
        return F.struct((l["level"] == level).alias("open"), runs.alias("runs"))

    runs = F.aggregate(lines, F.struct(F.lit(False).alias("open"), start.alias("runs")), step, lambda acc: acc["runs"])
    return F.transform(runs, lambda r: F.array_join(r, "\n"))


def normal(text: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(text, r"\s+", " ")))


def _keys(whole: Column, parts: Column) -> Column:
    """array<struct<kind, hash>>: 1 a whole text or passage, 0 a line; blank ones have none."""
    one = lambda kind, x: F.struct(F.lit(kind).alias("kind"), F.when(normal(x) != "", F.xxhash64(normal(x))).alias("hash"))
    return F.filter(F.concat(F.transform(whole, lambda x: one(1, x)), F.transform(parts, lambda x: one(0, x))), lambda k: k["hash"].isNotNull())


def linked(messages: DataFrame, scope: str = "conv_id", position: str = "turn", text: str = "text") -> DataFrame:
    """``messages`` with its own text in place of the whole, ``parent``, ``root`` (positions) and ``depth``."""
    rows = messages.withColumn("_q_lines", parsed(messages[text]))
    rows = rows.withColumn("_q_own", own_text("_q_lines"))
    named = rows.select(F.col(scope).alias("s"), F.col(position).alias("p"), "_q_own", "_q_lines").where("s is not null and p is not null")
    lines = lambda x: F.split(x, "\n")
    originals = named.select("s", "p", F.explode(_keys(F.array("_q_own"), lines(F.col("_q_own")))).alias("k"))
    originals = originals.groupBy("s", "k.kind", "k.hash").agg(F.min("p").alias("parent"))
    quoted = passages("_q_lines", 1)
    asked = named.select("s", "p", F.explode(_keys(quoted, F.flatten(F.transform(quoted, lines)))).alias("k")).select("s", "p", "k.kind", "k.hash")
    found = asked.distinct().join(originals, ["s", "kind", "hash"]).where("parent < p")
    best = F.max(F.struct("kind", F.negative(F.col("parent")).alias("least")))
    parents = stored(found.groupBy("s", "p").agg(F.negative(best["least"]).alias("parent")), "parents")
    placed = roots(parents).select(F.col("s").alias("_q_s"), F.col("p").alias("_q_p"), "parent", "root", "depth")
    plain = [c for c in messages.columns if c not in (text, "parent", "root", "depth")]
    out = rows.join(placed, (F.col(scope) == F.col("_q_s")) & (F.col(position) == F.col("_q_p")), "left")
    return out.select(*plain, F.col("_q_own").alias(text), placed["parent"], F.coalesce(placed["root"], F.col(position)).alias("root"),
                      F.coalesce(placed["depth"], F.lit(0)).cast("long").alias("depth"))


def roots(parents: DataFrame) -> DataFrame:
    """(s, p, parent, root, depth) of every message that has a parent, from (s, p, parent).

    Each round doubles how far the pointers reach; a row whose pointer is at a message without a parent is done
    and only serves the others.
    """
    active = stored(parents.select("s", "p", F.col("parent").alias("to"), F.lit(1).cast("long").alias("hops")), "pointers")
    done = active.limit(0)
    while True:
        ahead = active.union(done).select("s", F.col("p").alias("to"), F.col("to").alias("next"), F.col("hops").alias("more"))
        moved = stored(active.join(ahead, ["s", "to"], "left"), "pointer-doubling")
        done = done.union(moved.where("next is null").select("s", "p", "to", "hops"))
        active = moved.where("next is not null").select("s", "p", F.col("next").alias("to"), (F.col("hops") + F.col("more")).alias("hops"))
        if active.isEmpty():
            break
    return parents.join(done.select("s", "p", F.col("to").alias("root"), F.col("hops").alias("depth")), ["s", "p"])
