"""Line dedup: later copies of runs of lines go, by winnowing over line hashes.

Method (DataFrame functions only). The lines of a text that are not blank, trimmed, are hashed. Every
window of ``window`` neighbouring lines has its least hash as a fingerprint, so two texts that share
a run of that length share a fingerprint. Fingerprints that occur once are set aside. For the
others the windows' positions are joined to the first position, by (key, place), of the same window. Matches that
overlap or touch are extended into one run, both ways, as far as windows match, and every run but
the first occurrence is deleted. A text of fewer lines is one window: it is deleted when it repeats a whole text.

Ties: the smallest key comes first, then the place in the text; rows with equal key and
text count as one text and are treated alike. A null key comes first. A null text stays null, an empty text or blank lines
stay; lines are joined by line feeds as before. A text that consists of copies alone becomes empty. Long
texts are one array of hashes each. An empty table gives an empty one. Other columns pass through; names with
a leading ``_ld_`` are the operator's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from regionlake.llm.base import same, stored

BLANK = " \t\r\x0b\x0c"


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n")


def windows(df: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """(k, t, i, lines, fingerprint, hash): every window of each text; ``i`` is its place among the lines that count."""
    hashes = F.transform(_lines("x"), lambda l: F.when(F.btrim(l, F.lit(BLANK)) != "", F.xxhash64(F.btrim(l, F.lit(BLANK)))))
    rows = df.select(df[key].alias("k"), df[text].alias("x")).where(F.col("x").isNotNull() & (F.col("x") != ""))
    rows = rows.select("k", F.xxhash64("x").alias("t"), F.array_compact(hashes).alias("h"))
    rows = rows.where(F.size("h") > 0).withColumn("n", F.least(F.lit(window), F.size("h")))
    starts = F.sequence(F.lit(0), F.size("h") - F.col("n"))
    cut = F.transform(starts, lambda i: F.struct(
        i.alias("i"), F.array_min(F.slice("h", i + 1, F.col("n"))).alias("fingerprint"),
        F.xxhash64(F.slice("h", i + 1, F.col("n"))).alias("hash"),
    ))
    rows = rows.select("k", "t", F.col("n").alias("lines"), F.explode(cut).alias("w"))
    return rows.select("k", "t", "w.i", "lines", "w.fingerprint", "w.hash")


def repeated_runs(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = 3) -> DataFrame:
    """(k, t, runs): for each text (key and hash) its later copies as array<struct<from, to, first_key, first_from>>.

    ``from`` and ``to`` count the lines that are not blank, from 0; ``first_*`` is where the run's first window occurs first.
    """
    found = stored(windows(df, key, text, window), "windows")
    often = found.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fingerprint")
    found = found.join(often, "fingerprint", "left_semi")
    place = F.struct("k", "t", "i")
    first = found.groupBy("hash", "lines").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = stored(first.where(F.col("first") != F.col("last")).drop("last"), "first-windows")
    later = found.join(first, ["hash", "lines"]).where(place != F.col("first")).distinct()
    hits = F.array_sort(F.collect_set(F.struct("i", "lines", F.col("first.k").alias("fk"), F.col("first.i").alias("fi"))))
    per_text = later.groupBy("k", "t").agg(hits.alias("hits"))
    head = F.struct(
        F.col("hits")[0]["i"].alias("from"), (F.col("hits")[0]["i"] + F.col("hits")[0]["lines"] - 1).alias("to"),
        F.col("hits")[0]["fk"].alias("first_key"), F.col("hits")[0]["fi"].alias("first_from"),
    )

    def extend(runs, hit):
        end = hit["i"] + hit["lines"] - 1
        last = F.element_at(runs, -1)
        grown = F.struct(last["from"].alias("from"), F.greatest(last["to"], end).alias("to"),
                         last["first_key"].alias("first_key"), last["first_from"].alias("first_from"))
        new = F.struct(hit["i"].alias("from"), end.alias("to"), hit["fk"].alias("first_key"), hit["fi"].alias("first_from"))
        return F.when(hit["i"] <= last["to"] + 1, F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(grown))) \
            .otherwise(F.concat(runs, F.array(new)))

    return per_text.select("k", "t", F.aggregate("hits", F.array(head), extend).alias("runs"))


def without_runs(df: DataFrame, runs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with the runs' lines taken out of the text, and ``_ld_runs`` (null where nothing was)."""
    named = runs.select(F.col("k").alias("_ld_k"), F.col("t").alias("_ld_t"), F.col("runs").alias("_ld_runs"))
    rows = df.withColumn("_ld_hash", F.xxhash64(df[text]))
    # Always by a shuffle: how many texts have runs grows with the corpus.
    rows = rows.join(named.hint("merge"), same(key, "_ld_k") & (F.col("_ld_hash") == F.col("_ld_t")), "left").drop("_ld_k", "_ld_t", "_ld_hash")
    lines = F.split(F.col(text), "\n")
    blank = lambda l: F.btrim(l, F.lit(BLANK)) == ""
    # The place of each line among those that count, then the lines that no run covers.
    counted = F.aggregate(
        lines, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("kept")),
        lambda acc, l: F.struct(
            F.when(blank(l), acc["at"]).otherwise(acc["at"] + 1).alias("at"),
            F.when(~blank(l) & F.exists("_ld_runs", lambda r: (r["from"] <= acc["at"]) & (acc["at"] <= r["to"])), acc["kept"])
            .otherwise(F.concat(acc["kept"], F.array(l))).alias("kept"),
        ), lambda acc: F.array_join(acc["kept"], "\n"),
    )
    return rows.withColumn(text, F.when(F.col("_ld_runs").isNull(), F.col(text)).otherwise(counted))


def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = 3) -> DataFrame:
    """``df`` without later copies of runs of at least ``window`` lines."""
    runs = stored(repeated_runs(df, key, text, window), "runs")
    return without_runs(df, runs, key, text)
