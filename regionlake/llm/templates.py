"""Benchmark decontamination by template canonicalisation.

Method (DataFrame functions only). Words lose the punctuation around them and become lower case; numbers, quantities,
units and names (words that begin with a capital) become typed placeholders, with their text as the
slot's value. Every window of ``window`` words of the items that has ``literals`` words other than placeholders is hashed and
hash-joined to the windows of all texts. For the texts that match, runs of windows along one
alignment are put together and the slots compared: a benchmark value must stand for one value of the text throughout,
and one value of the text for one of the benchmark. Runs whose slots agree are leaks: with the same values an exact one,
with other values a re-parameterised question.

The items' windows are broadcast only after their rows are counted (``sized``); beyond that the join shuffles.

Nulls and empty texts have no windows and match nothing; a null key is reported as null. An item
shorter than ``window`` words is one window of all its words. Repeated rows of one key and text are
reported once; the same text under several items is reported for each. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from regionlake.llm.base import same, stored
from regionlake.operators.sizing import sized

SPACE = r"[ \t\n\x0B\f\r]+"
EDGES = ".,;:!?\"'()[]{}<>|*_`«»“”‘’…"
UNITS = ("% km m cm mm kg g mg l ml km/h mph s min h hour hours day days week weeks year years mile miles "
         "meter meters litre litres liter liters dollar dollars euro euros pound pounds cent cents $ € £").split()


def cores(text: Column) -> Column:
    """Words without the punctuation around them; a word of nothing else stays."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")

    def core(w):
        bare = F.btrim(w, F.lit(EDGES))
        return F.when(bare == "", w).otherwise(bare)

    return F.transform(words, core)


def placeholder(core: Column) -> Column:
    """The word's canonical form: lower case, or the type of its slot."""
    head, low = F.substring(core, 1, 1), F.lower(core)
    number = (
        F.when(core.rlike(r"^[0-9][0-9.,:/-]*$"), "<num>").when(core.rlike(r"^[0-9][0-9.,]*[^0-9]{1,4}$"), "<qty>").otherwise(low)
    )
    return F.when((head >= "0") & (head <= "9"), number).when(low.isin(UNITS), "<unit>").when(head != F.lower(head), "<name>").otherwise(low)


def _starts(words: str, window: int) -> Column:
    """First words of the windows, from 0: one window where there are fewer words; none without words."""
    n = F.size(words)
    return F.when(n > 0, F.sequence(F.lit(0), F.greatest(F.lit(0), n - window))).otherwise(F.array().cast("array<int>"))


def _slot(canonical: Column) -> Column:
    return canonical.isin("<num>", "<qty>", "<unit>", "<name>")


def item_windows(items: DataFrame, key: str, text: str, window: int, literals: int) -> DataFrame:
    """(hash, item, at): windows of the items with enough words that are no placeholders."""
    rows = items.select(items[key].alias("item"), cores(items[text]).alias("core"))
    rows = rows.withColumn("canon", F.transform("core", placeholder))
    cut = F.transform(_starts("core", window), lambda i: F.struct(i.alias("at"), F.slice("canon", i + 1, window).alias("w")))
    rows = rows.select("item", F.explode(cut).alias("c")).select("item", "c.at", "c.w")
    enough = F.size(F.filter("w", lambda x: ~_slot(x))) >= F.least(F.lit(literals), F.size("w"))
    return rows.where(enough).select(_window_hash("w").alias("hash"), "item", "at").distinct()


def _window_hash(w: str | Column) -> Column:
    return F.xxhash64(F.transform(w, lambda x: F.xxhash64(x)))


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
          item_text: str = "text", window: int = 8, literals: int = 5) -> DataFrame:
    """(``key``, ``item_key``, first_word, last_word, item_first, item_last, n_words, changed_slots, reparameterised) of every leak.

    Words count from 0. ``n_words`` is the length of the run in words, ``changed_slots`` the slots with another value.
    """
    probes = sized(item_windows(items, item_key, item_text, window, literals))
    rows = docs.select(docs[key].alias("k"), docs[text].alias("x")).where(F.col("x").isNotNull())
    hashes = rows.select("k", F.xxhash64("x").alias("t"), F.transform(F.transform(cores(F.col("x")), placeholder), lambda w: F.xxhash64(w)).alias("h"))
    cut = F.transform(_starts("h", window), lambda i: F.xxhash64(F.slice("h", i + 1, window)))
    found = hashes.select("k", "t", F.posexplode(cut).alias("pos", "hash"))
    # A short text is one short window, which only equals an item of as few words.
    hits = found.join(probes.hinted(), "hash").groupBy("k", "t", "item", (F.col("pos") - F.col("at")).alias("shift")).agg(
        F.array_sort(F.collect_set("at")).alias("at"))
    hits = stored(hits, "template-hits")

    def extend(runs, at):
        last = F.element_at(runs, -1)
        grown = F.struct(last["a"].alias("a"), at.alias("b"))
        return F.when(at <= last["b"] + window, F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(grown))) \
            .otherwise(F.concat(runs, F.array(F.struct(at.alias("a"), at.alias("b")))))

    head = F.array(F.struct(F.col("at")[0].alias("a"), F.col("at")[0].alias("b")))
    runs = hits.select("k", "t", "item", "shift", F.explode(F.aggregate("at", head, extend)).alias("run"))
    own = rows.withColumn("t", F.xxhash64("x")).join(hits.select(F.col("k").alias("hk"), F.col("t").alias("ht")).distinct(),
                                                     same("k", "hk") & (F.col("t") == F.col("ht")), "left_semi")
    own = own.groupBy("k", "t").agg(F.first("x").alias("x")).select(F.col("k").alias("ok"), F.col("t").alias("ot"), cores(F.col("x")).alias("mine"))
    theirs = items.select(items[item_key].alias("oi"), cores(items[item_text]).alias("theirs")).distinct()
    both = runs.join(own, same("k", "ok") & (F.col("t") == F.col("ot"))).join(theirs, same("item", "oi"))
    from_ = F.col("run.a") + 1
    size = F.least(F.col("run.b") + window, F.size("theirs")) - F.col("run.a")
    both = both.withColumn("size", size).withColumn("a", F.slice("theirs", from_, F.col("size"))).withColumn(
        "b", F.slice("mine", from_ + F.col("shift"), F.col("size")))
    # Windows may be apart by as much as one window: words between them that differ in their template end nothing.
    pairs = F.filter(F.arrays_zip("a", "b"), lambda p: _slot(placeholder(p["a"])) & (placeholder(p["a"]) == placeholder(p["b"])))
    both = both.withColumn("slots", F.array_distinct(pairs))
    one = lambda side: F.size(F.array_distinct(F.transform("slots", lambda p: p[side]))) == F.size("slots")
    changed = F.size(F.filter("slots", lambda p: p["a"] != p["b"]))
    return both.where(one("a") & one("b")).select(
        F.col("k").alias(key), F.col("item").alias(item_key), (F.col("run.a") + F.col("shift")).alias("first_word"),
        (F.col("run.a") + F.col("shift") + F.col("size") - 1).alias("last_word"), F.col("run.a").alias("item_first"),
        (F.col("run.a") + F.col("size") - 1).alias("item_last"), F.col("size").alias("n_words"),
        changed.alias("changed_slots"), (changed > 0).alias("reparameterised"),
    ).distinct()
