"""Keyed upsert, reload and retention."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from regionlake import config as C
from regionlake.operators.sizing import sized
from regionlake.operators.windows import keep_first, latest_per_key


def upserted(
    target: DataFrame, source: DataFrame, pk: list[str], version: list[str] | None = None,
) -> DataFrame:
    """Target with the source's rows put in, key by key.

    Keys compare null-safely, so a null key part replaces its row on a rerun instead of
    adding one. Several source rows of a key are reduced to the newest by ``version``
    (or to the first in column order). When the key columns are all there is, existing
    rows stay. Columns that only the target has keep their values, and are null in new rows. Only the target rows whose key the source lacks are read through; they
    are not shuffled when the source is small.
    """
    incoming = source.select(*[c for c in target.columns if c in source.columns])
    rest = [c for c in incoming.columns if c not in pk]
    if version:
        incoming = latest_per_key(incoming, pk, version)
    else:
        incoming = keep_first(incoming, pk, rest) if rest else incoming.distinct()
    lacking = [c for c in target.columns if c not in incoming.columns]
    if lacking:
        old = target.select(*[F.col(k).alias(f"_o{i}") for i, k in enumerate(pk)], *lacking)
        incoming = incoming.join(old, _equal(pk, "_o"), "left").select(*target.columns)
    stored = sized(incoming)
    keys = stored.df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(pk)])
    if stored.small:
        keys = F.broadcast(keys)
    kept = target.join(keys, _equal(pk, "_k"), "left_anti")
    return kept.unionByName(stored.df)


def _equal(pk: list[str], other: str):
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{other}{i}")) for i, k in enumerate(pk)])


def retained(events: DataFrame, as_of, ts: str = "ingested_at", days: int = C.RETENTION_DAYS) -> DataFrame:
    """Events not older than ``days`` before ``as_of``.

    A plain range filter: on a table partitioned or sorted by the column it prunes files.
    """
    moment = as_of if not isinstance(as_of, str) else F.lit(as_of).cast("timestamp")
    moment = moment if not hasattr(moment, "isoformat") else F.lit(moment)
    return events.where(F.col(ts) >= moment - F.expr(f"INTERVAL {int(days)} DAYS"))
