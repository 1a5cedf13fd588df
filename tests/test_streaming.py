"""Streams run over split files and must equal the batch result."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from regionlake import schemas as T
from regionlake.operators.aggregates import batch_stats
from regionlake.operators.sizing import Spine
from regionlake.operators.windows import rolling_mean
from regionlake.plans.serving import air_summary, events
from regionlake.session import settings
from regionlake.streaming import air, sales, state

START = datetime(2024, 1, 1)


def landed(spark, tmp_path, parts, schema):
    """One file per part; later parts get later modification times."""
    import os

    path = tmp_path / "in"
    path.mkdir()
    for i, rows in enumerate(parts):
        folder = str(tmp_path / f"part{i}")
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(folder)
        name = next(n for n in os.listdir(folder) if n.endswith(".parquet"))
        target = str(path / f"{i:03d}.parquet")
        os.link(os.path.join(folder, name), target)
        os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(path)


def wait(q):
    q.awaitTermination()
    assert q.exception() is None


SALES = "arrondissement int, prix_m2 double, timestamp timestamp"


def test_micro_batches(spark, tmp_path, rows):
    parts = [[(1 + j % 3, float(100 * i + j), START + timedelta(hours=i)) for j in range(7)] for i in range(4)]
    source = landed(spark, tmp_path, parts, SALES)
    out, log, mark = (str(tmp_path / x) for x in ("out", "log", "mark"))
    stream = lambda: sales.read_stream(spark, source, SALES, files_per_batch=1)
    record = sales.logged(spark, log, out)
    record.finish(sales.run_sales_stream(stream(), out, mark, log=record))
    table = spark.read.parquet(out)
    for i, part in enumerate(parts):
        want = batch_stats(spark.createDataFrame(part, SALES))
        assert rows(table.where(F.col("batch_id") == i).select(want.columns)) == rows(want)
    entries = spark.read.parquet(log)
    assert rows(entries.select("batch_id", "n_records", "output", "state_rows", "late_rows")) == [(i, 7, out, 0, 0) for i in range(4)]
    assert entries.where("elapsed_ms > 0 AND ts IS NOT NULL").count() == 4
    assert {r["timestamp"] for r in table.collect()} == {START + timedelta(hours=i) for i in range(4)}
    done = sales.consolidate(spark, out)
    assert {r["arrondissement"]: (r["nb_transactions_total"], r["nb_batchs"]) for r in done.collect()} == {1: (12, 4), 2: (8, 4), 3: (8, 4)}
    record = sales.logged(spark, log, out)
    record.finish(sales.run_sales_stream(stream(), out, mark, log=record))  # nothing new, nothing added
    assert spark.read.parquet(out).count() == 12 and spark.read.parquet(log).count() == 4
    assert sales.consolidate(spark, str(tmp_path / "never")) is None


def test_log_of_a_failing_stream_holds_what_was_done(spark, tmp_path):
    source = landed(spark, tmp_path, [[(1, 5.0, START)], [(1, 6.0, START)]], SALES)
    log = sales.logged(spark, str(tmp_path / "log"), "none")

    def handle(batch, batch_id):
        batch.count()
        if batch_id == 1:
            raise ValueError("second batch")

    with pytest.raises(Exception, match="second batch"):
        log.finish(sales.start(sales.read_stream(spark, source, SALES, files_per_batch=1), handle, str(tmp_path / "mark"), name=log.name))
    assert [r["batch_id"] for r in spark.read.parquet(str(tmp_path / "log")).collect()] == [0]


def test_repeated_batch_replaces_itself(spark, tmp_path):
    handle = sales.batch_writer(str(tmp_path / "o"))
    batch = spark.createDataFrame([(1, 5.0, START)], SALES)
    handle(batch, 0)
    handle(batch, 1)
    handle(batch, 1)
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2


AIR = "event_id int, source string, timestamp timestamp, arrondissement int, iqa double, no2 double, pm25 double"


def readings():
    out = []
    for i in range(90):
        out.append((i, "x", START + timedelta(hours=i // 2, minutes=7 * (i % 2)), 1 + (i % 7 == 0), float((i * 37) % 130), 1.0, 2.0))
    return out


def test_rolling_mean_over_batches_equals_batch(spark, tmp_path):
    import os

    data = readings()
    source = landed(spark, tmp_path, [data[:20], data[20:50], data[50:51], data[51:]], AIR)
    table, alerts, mark = (str(tmp_path / x) for x in ("table", "alerts", "mark"))
    stream = air.events_of(sales.read_stream(spark, source, AIR, files_per_batch=1))
    wait(air.run_air_stream(stream, table, mark))
    whole = rolling_mean(air.events_of(spark.createDataFrame(data, AIR)), "arrondissement", "ingested_at", "iqa", "m")
    want = {(r["arrondissement"], r["ingested_at"]): r["m"] for r in whole.collect()}
    got = spark.read.parquet(table)
    assert got.count() == 90 and {x.split("=")[0] for x in os.listdir(table) if "=" in x} == {"jour"}
    for r in got.collect():
        assert r["iqa_24h_mean"] == pytest.approx(want[r["arrondissement"], r["ingested_at"]], abs=0.051)
    wait(air.run_alert_stream(spark, table, alerts, str(tmp_path / "mark2")))
    red = spark.read.parquet(alerts)
    assert red.count() == sum(d[4] > 75 for d in data)
    assert {r["level"] for r in red.collect()} == {"orange", "rouge"}
    text = red.where("level = 'rouge'").orderBy("ingested_at").first()
    assert text["message"] == f"POLLUTION FORTE — Arr.{text['arrondissement']} IQA={text['iqa']:.0f} > 100"


KEYED = "id int, k string, at timestamp, v double"


def brute_means(rows, hours):
    def mean(row):
        _, k, t, _ = row
        near = [v for _, k2, t2, v in rows if k2 == k and k is not None and v is not None and v == v and t - timedelta(hours=hours) <= t2 <= t]
        return sum(near) / len(near) if near else None

    return {r[0]: mean(r) for r in rows}


def test_state_of_slices_equals_brute_force(spark, tmp_path):
    """Random times on and around slice edges, values that miss, a key that misses, rows of one batch out of order, a restart."""
    import random

    random.seed(8)
    hour = timedelta(hours=1)
    rows = []
    for i in range(400):
        t = START + hour * random.randint(0, 90) + random.choice([timedelta(0), timedelta(microseconds=1), timedelta(minutes=59, seconds=59, microseconds=999999),
                                                                   timedelta(minutes=random.randint(0, 59))])
        rows.append((i, random.choice(["a", "a", "b", None]), t, random.choice([None, float("nan"), *[random.uniform(-50, 150) for _ in range(8)]])))
    rows.sort(key=lambda r: r[2])
    # Rows of one time arrive together: a mean counts what has arrived.
    cuts = [next(i for i in range(n, 400) if rows[i - 1][2] < rows[i][2]) for n in (150, 160, 330)]
    parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, 400])]
    for p in parts:
        random.shuffle(p)
    source = landed(spark, tmp_path, parts[:2], KEYED)
    means = lambda: state.rolling_stream(sales.read_stream(spark, source, KEYED, files_per_batch=1), "k", "at", "v", "m", hours=6, slice_minutes=30)
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    wait(sales.append_to(means(), out, mark))
    (tmp_path / "more").mkdir()
    later = landed(spark, tmp_path / "more", parts[2:], KEYED)
    import os

    for i, name in enumerate(sorted(os.listdir(later))):
        os.link(os.path.join(later, name), os.path.join(source, f"9{i}.parquet"))
    wait(sales.append_to(means(), out, mark))
    got = {r["id"]: r["m"] for r in spark.read.parquet(out).collect()}
    want = brute_means(rows, 6)
    assert got.keys() == want.keys()
    for i, m in want.items():
        assert got[i] is None if m is None else got[i] == pytest.approx(m, abs=1e-9), i
    held = spark.read.format("statestore").option("path", mark).option("stateVarName", "totals").load()
    kept = {(r["key"][0], r["user_map_key"] if "user_map_key" in held.columns else r[1]) for r in held.collect()}
    assert 0 < len(kept) < 60  # far fewer than the slices that got rows: the timers let old ones go


def test_repeats_and_late_rows(spark, tmp_path, rows):
    hour = timedelta(hours=1)
    first = [(i, "a", START + hour * i, float(i)) for i in range(10)]
    second = [(3, "a", START + hour * 3, 3.0), (9, "a", START + hour * 9, 9.0), (10, "a", START + hour * 10, 10.0), (10, "a", START + hour * 10, 10.0),
              (77, "a", START - 400 * 24 * hour, 1e6), (78, "a", None, 1e6)]
    source = landed(spark, tmp_path, [first, second], KEYED)
    stream = lambda: sales.read_stream(spark, source, KEYED, files_per_batch=1)
    wait(sales.append_to(state.rolling_stream(stream(), "k", "at", "v", "m", hours=2, unique=["id"], slice_minutes=60), str(tmp_path / "o"), str(tmp_path / "m")))
    got = {r["id"]: r["m"] for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    assert got == {i: m for i, m in brute_means(first + [second[2]], 2).items()}
    wait(sales.append_to(state.late_rows(stream(), "at"), str(tmp_path / "late"), str(tmp_path / "m2")))
    late = spark.read.parquet(str(tmp_path / "late"))
    assert late.columns == ["id", "k", "at", "v"]
    assert rows(late.select("id", "at")) == [(3, START + hour * 3), (77, START - 400 * 24 * hour)]
    with pytest.raises(ValueError):
        state.rolling_stream(stream(), "k", "at", "v", "m", hours=1, slice_minutes=45)


def test_live_responses(spark):
    schema = ("timestamp timestamp, features array<struct<properties: struct<date_ech: string, valeur: string, val_no2: string, val_pm25: string>>>")
    one = lambda *p: (p,)
    raw = spark.createDataFrame([
        (START, [one("2024-01-01", "10", "1", "1"), one("2024-01-02", "52.35", "38.35", None), one("2024-01-02", "99", "1", "1")]),
        (START + timedelta(hours=1), []), (START + timedelta(hours=2), None), (START + timedelta(hours=3), [one(None, "x", "1", "1")]),
    ], schema)
    fallback = spark.createDataFrame([(1, 11.0, None, 2.0)], "arrondissement int, iqa_moyen double, `no2_µg_m3` double, `pm25_µg_m3` double")
    out = air.live_events(raw, Spine.numbered(spark), fallback)
    got = {(r["timestamp"].hour, r["arrondissement"]): (r["iqa"], r["no2"], r["pm25"], r["source"]) for r in out.collect()}
    assert len(got) == 80
    assert got[0, 1] == (52.0, 38.0, 12.0, air.LIVE) and got[0, 19] == (64.0, 50.0, 17.0, air.LIVE)
    for hour in (1, 2, 3):
        assert got[hour, 1] == (11.0, 38.0, 2.0, air.FALLBACK) and got[hour, 2] == (54.0, 40.0, 13.0, air.FALLBACK)


def test_windowed_stream_equals_batch(spark, tmp_path):
    parts = [[(1, float(j), START + timedelta(minutes=30 * i + j)) for j in range(9)] for i in range(6)]
    source = landed(spark, tmp_path, parts, SALES)
    stream = sales.windowed_stats(sales.read_stream(spark, source, SALES, files_per_batch=2))
    wait(sales.append_to(stream, str(tmp_path / "o"), str(tmp_path / "m")))
    got = {r["debut"].hour: (r["nb_transactions"], r["prix_m2_median"], r["prix_m2_moyen"]) for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    assert got == {0: (18, 4.0, 4.0), 1: (18, 4.0, 4.0)}  # the last hour is still open


EVENT_ROWS = [
    ("air_quality", "live", START + timedelta(hours=h), START, r, iqa, 1.0, 2.0, level)
    for h, r, iqa, level in (
        (0, 1, 10.0, None), (1, 1, 20.0, None), (24, 1, 120.0, "rouge"), (24, 2, 80.0, "orange"), (23, 2, None, None), (20, 3, 5.0, None), (24, 99, 500.0, "rouge"))
]
EVENTS = T.AIR_EVENT.rsplit(",", 1)[0]


def test_air_summary(spark):
    table = spark.createDataFrame(EVENT_ROWS + [("other", "x", START + timedelta(hours=24), START, 4, 200.0, 1.0, 1.0, "rouge")], EVENTS)
    s = air_summary(table, "2024-01-02 00:00:00")
    got = {r["arrondissement"]: (r["iqa_latest"], r["iqa_mean"], r["n_mesures"]) for r in s.readings.collect()}
    assert got == {1: (120.0, 50.0, 3), 2: (80.0, 80.0, 2), 3: (5.0, 5.0, 1)}  # exactly 24 h old is kept
    assert [r["arrondissement"] for r in s.alerts.collect()] == [1, 2]
    assert tuple(s.overview.first()) == (24, 2, "live", None)
    only = air_summary(table, "2024-01-02 00:00:00", alert_only=True)
    assert only.readings.count() == 2 and only.overview.first()["alerts_active"] == 2
    none = air_summary(table, "2030-01-01 00:00:00").overview.first()
    assert (none["alerts_active"], none["source"], none["message"]) == (0, "unknown", "no reading in the window")
    for bad in (0, 169):
        with pytest.raises(ValueError):
            air_summary(table, "2024-01-02 00:00:00", bad)
    assert [r["iqa"] for r in events(table, 1, 2).collect()] == [120.0, 20.0]


def test_fallback_and_live_records(spark):
    schema = "arrondissement int, iqa double"
    live, static = spark.createDataFrame([(1, 9.0)], schema), spark.createDataFrame([(1, 5.0), (2, 6.0)], schema)
    got = {tuple(r) for r in air.with_fallback(live, static, ["arrondissement"]).collect()}
    assert got == {(1, 9.0, air.LIVE), (2, 6.0, air.FALLBACK)}
    raw = spark.createDataFrame([("75105", None, "40", None, None, None, "0"), (None, "75106", None, None, "3", "4", None), ("75200", None, "1", "1", "1", "1", "1")],
                                "commune_code string, insee string, indice string, iqa string, no2 string, pm25 string, pm2_5 string")
    rows = sorted(tuple(r) for r in air.live_readings(raw, Spine.numbered(spark)).collect())
    assert rows == [(5, 40.0, 34.0, 10.0, air.LIVE), (6, 47.0, 3.0, 4.0, air.LIVE)]


def test_spread_keeps_the_mean(spark):
    base = air.base_table(Spine.numbered(spark))
    city = spark.createDataFrame([(1, 60.0, 40.0)], "id int, iqa double, no2 double")
    out = air.spread_reading(city, base, {"iqa": "iqa_base", "no2": "no2_base"}, digits=None)
    assert out.count() == 20 and out.agg(F.avg("iqa")).first()[0] == pytest.approx(60.0)
    assert out.where("arrondissement = 19").first()["iqa"] == pytest.approx(60 * 64 / 52.35)


def test_rows_without_a_numeric_key_are_a_group_of_their_own(spark, tmp_path):
    at = lambda minute: START + timedelta(minutes=minute)
    part = [(i, None if i % 3 == 0 else i % 3, at(i), float(i)) for i in range(12)]
    part = part[::-1]  # whatever the order they come in
    shape = "id int, k int, at timestamp, v double"
    source = landed(spark, tmp_path, [part], shape)
    stream = sales.read_stream(spark, source, shape, files_per_batch=1)
    wait(sales.append_to(state.rolling_stream(stream, "k", "at", "v", "m", hours=4), str(tmp_path / "o"), str(tmp_path / "m")))
    got = {r["id"]: (r["k"], r["m"]) for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    for i, k, _, _ in part:
        near = [v for j, k2, _, v in part if k2 == k and j <= i]
        assert got[i] == (k, pytest.approx(sum(near) / len(near))), i


def test_keyed_state_gets_packs_of_rows(spark, tmp_path, rows):
    """Late rows and others of one pack, columns of several types, keys that come in turns."""
    shape = "id int, k string, at timestamp, v double, note string, seen timestamp, tags array<string>"
    row = lambda i, minute: (i, "ab"[i % 2], START + timedelta(minutes=minute), None if i % 5 == 0 else float(i),
                             None if i % 3 else "ü" * i, START if i % 4 else None, ["x", None] if i % 7 else None)
    first, second = [row(i, 10 * i) for i in range(60)], [row(i, 10 * (i if i % 3 else i - 60)) for i in range(60, 90)]
    source = landed(spark, tmp_path, [first, second], shape)
    stream = lambda: sales.read_stream(spark, source, shape, files_per_batch=1)
    means = state.rolling_stream(stream(), "k", "at", "v", "m", hours=4)
    plan = means._jdf.queryExecution().analyzed().toString()
    assert [x for x in ("MapInArrow", "TransformWithState") if x in plan[plan.index("TransformWithState"):]] == ["MapInArrow", "TransformWithState"]
    wait(sales.append_to(means, str(tmp_path / "o"), str(tmp_path / "m")))
    mark = max(r[2] for r in first) - timedelta(hours=1)
    kept = first + [r for r in second if r[2] >= mark]
    late = [r for r in second if r[2] < mark]
    assert late and len(kept) > 60
    stored = spark.read.parquet(str(tmp_path / "o"))
    assert rows(stored.drop("m")) == sorted([(*r[:6], r[6]) for r in kept], key=repr)
    want = brute_means([r[:4] for r in kept], 4)
    got = {r["id"]: r["m"] for r in stored.collect()}
    assert {i: got[i] is None for i in got} == {i: m is None for i, m in want.items()}
    assert [got[i] for i in got if got[i] is not None] == pytest.approx([want[i] for i in got if got[i] is not None])
    wait(sales.append_to(state.late_rows(stream(), "at"), str(tmp_path / "late"), str(tmp_path / "m2")))
    assert rows(spark.read.parquet(str(tmp_path / "late"))) == sorted(late, key=repr)


def test_reading_stream_equals_air_stream(spark, tmp_path, rows):
    data = readings()
    source = landed(spark, tmp_path, [data[:20], data[20:50], data[50:]], AIR)
    stream = lambda: sales.read_stream(spark, source, AIR, files_per_batch=1)
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    wait(air.run_air_stream(air.events_of(stream()), one, str(tmp_path / "m1")))
    wait(air.run_reading_stream(stream(), two, str(tmp_path / "m2")))
    a, b = spark.read.parquet(one), spark.read.parquet(two)
    assert a.columns == b.columns and a.dtypes == b.dtypes
    assert rows(a) == rows(b) and len(rows(a)) == 90


def test_shuffle_files_go_with_their_batch(spark, tmp_path):
    """those of a stream and of the landing went only when the driver collected its garbage."""
    from suite import streams

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    spark._jvm.System.gc()
    held = lambda: {n for n in (disk.getAllFiles().apply(i).getName() for i in range(disk.getAllFiles().size())) if n.startswith("shuffle_")}
    known, before = held(), spark.conf.get(cleanup)
    events = spark.range(2000).select((F.col("id") % 4).alias("_part"), (F.col("id") % 3).cast("string").alias("k"),
                                      F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60).alias("at"), F.col("id").cast("double").alias("v"))
    source = str(tmp_path / "in")
    streams.land(events, source)
    stream = sales.read_stream(spark, source, "k string, at timestamp, v double", files_per_batch=streams.FILES)
    wait(sales.append_to(state.rolling_stream(stream, "k", "at", "v", "m", delay="2 days"), str(tmp_path / "o"), str(tmp_path / "m")))
    assert not held() - known and spark.conf.get(cleanup) == before
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2000


def test_packs_are_small_and_give_back_what_they_got():
    """F1: all rows of a micro-batch are shuffled twice in packs."""
    import numpy as np
    import pyarrow as pa

    for numbers, kind in (([], np.int64), ([7, -2**63, 2**63 - 1, 0], np.int64), ([float("nan"), -0.0, 0.0, float("-inf"), 1.5], float), ([True, False, True], bool)):
        numbers = np.array(numbers, kind)
        assert state._numbers(state._squeezed(numbers), kind).tobytes() == numbers.tobytes()
    random, n = np.random.default_rng(3), 30_000
    at, value = random.integers(0, 7 * 24 * state.HOUR_US, n), np.round(random.uniform(0, 150, n), 1)
    value[:2] = -0.0, 0.0
    rows = pa.record_batch({
        state.AT: at, "rolled": value, "c0": pa.array(random.integers(1, 3, n), pa.int32()), "c1": pa.array(["live", "other", None] * (n // 3)), "c2": value,
        "c3": pa.array([["x"], None] * (n // 2)), "c4": pa.array(at, pa.timestamp("us", "UTC")), "c5": pa.nulls(n), "key": pa.array(["a", "b", None] * (n // 3))})
    packs = list(state.Pack(state.AT, "rolled")([rows.slice(0, 100), rows.slice(100)]))
    assert [p["key"].to_pylist() for p in packs] == [["a", "b", None]]
    small = next(state.Pack(state.AT, "rolled")([rows.select([state.AT, "rolled", "c0", "c1", "c2", "key"])]))
    assert sum(len(x) for c in (state.AT, "rolled", "rest") for x in small[c].to_pylist()) < 16 * n
    kept = pa.array([state._squeezed(np.ones(len(state._numbers(x, np.int64)), bool)) for x in packs[0][state.AT].to_pylist()])
    back = pa.Table.from_batches(state.Unpack()([packs[0].append_column("kept", kept).drop_columns(["key", "rolled"])]))
    assert back.column_names == [state.AT, "c0", "c1", "c2", "c3", "c4", "c5"]
    assert [str(back.schema.field(c).type) for c in back.column_names] == [str(rows.schema.field(c).type) for c in back.column_names]
    text = lambda table: sorted(repr(r) for r in table.to_pylist())
    assert text(back) == text(pa.Table.from_batches([rows]).select(back.column_names))


def test_state_holds_only_slices_that_later_rows_reach(spark, tmp_path):
    """a batch of many days stored all its times; a watermark of the caller's own still keeps them."""
    shape = "id int, k string, at timestamp, v double"
    part = [(i, "a", START + timedelta(minutes=10 * i), float(i)) for i in range(1440)]
    later = [(2000 + i, "a", part[-1][2] - timedelta(hours=1) + timedelta(minutes=i), 1.0) for i in range(120)]
    source = landed(spark, tmp_path, [part, later], shape)
    stream = sales.read_stream(spark, source, shape, files_per_batch=1)
    slices, first, means = [], brute_means(part, 6), brute_means(part + later, 6)
    for name, rows in (("one", stream), ("own", stream.withWatermark("at", "8 days").select("id", "k", F.col("at").alias("seen"), "v"))):
        ts, mark, out = "at" if name == "one" else "seen", str(tmp_path / f"m{name}"), str(tmp_path / f"o{name}")
        with settings(spark, spark__sql__streaming__statefulOperator__allowMultiple=str(name == "one").lower()):  # else one watermark alone is allowed
            wait(sales.append_to(state.rolling_stream(rows, "k", ts, "v", "m", hours=6, slice_minutes=30), out, mark))
        slices.append(spark.read.format("statestore").option("path", mark).option("stateVarName", "times").option("batchId", 0).load().count())
        got = {r["id"]: r["m"] for r in spark.read.parquet(out).collect()}
        assert {i for i in got if i >= 2000} == {r[0] for r in later} and len(got) == 1560
        for i in (0, 700, 1439, *(r[0] for r in later)):
            assert got[i] == pytest.approx((first if i < 2000 else means)[i]), i
    assert slices[0] <= 16 and slices[1] >= 400
