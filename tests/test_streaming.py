"""Stream mechanisms: rejected rows, state that ends, the upsert table, services."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from framewise.plans import ml_queries as Q
from framewise.plans import stream_queries as ST
from framewise.session import fresh_path
from framewise.sources import fixtures as fx
from framewise.streaming import burst_state as BS
from framewise.streaming import feeder
from framewise.streaming import queries as SQ
from framewise.streaming import rejects as RJ
from framewise.streaming import service as SV
from framewise.streaming.upsert import UpsertTable


# ---- rejects ----

def _raw(spark, rows, root):
    spark.createDataFrame(rows, "frame_id long, Time string, stream_name string").coalesce(1) \
         .write.mode("append").partitionBy("stream_name").parquet(root)


def test_every_bad_time_comes_out_once(spark, sf_dir):
    """All bad texts are flagged; the run after a restart adds only the new arrival."""
    root, out = fresh_path(spark, "gate-in"), fresh_path(spark, "gate-out")
    bursts = ST.damaged_bursts(spark, sf_dir)
    for arrival in (bursts.where("frame_id % 2 = 0"), bursts.where("frame_id % 2 = 1")):
        arrival.write.mode("append").partitionBy("stream_name").parquet(root)
        stream = SQ.burst_stream(spark, root).drop("Pixels")
        RJ.run_gate(stream, "timestamp", out)
    RJ.run_gate(SQ.burst_stream(spark, root).drop("Pixels"), "timestamp", out)  # nothing new
    rows = RJ.gated(spark, out, stream.schema)
    assert rows.count() == bursts.count() == rows.select("frame_id").distinct().count()
    bad = bursts.where("Time is null or Time = '' or Time like 'bad%'")
    assert rows.where("is_reject").select("frame_id", "Time").exceptAll(bad.select("frame_id", "Time")).count() == 0
    assert rows.where("is_reject").count() == bad.count() > 0
    counts = RJ.gate_counts(spark, out).agg(F.sum("n_rows"), F.sum("n_rejected")).first()
    assert tuple(counts) == (rows.count(), bad.count())


def test_replayed_batch_replaces_its_rows(spark):
    """A batch that was written but not committed is written again, not added."""
    root, out, ckpt = (fresh_path(spark, k) for k in ("gate-in", "gate-out", "gate-ckpt"))
    _raw(spark, [(1, "20240101 00:00:00", "s"), (2, "x", "s"), (3, None, "s")], root)
    schema = "frame_id long, Time string, stream_name string"

    def run(checkpoint):
        stream = spark.readStream.schema(schema).parquet(root).withColumn("at", F.try_to_timestamp("Time", F.lit("yyyyMMdd HH:mm:ss")))
        RJ.run_gate(stream, "at", out, checkpoint)
        return RJ.gated(spark, out, stream.schema)

    assert run(ckpt).count() == 3
    assert run(fresh_path(spark, "gate-ckpt")).count() == 3  # batch 0 once more, as after a crash before its commit
    assert {r.frame_id for r in run(ckpt).where("is_reject").collect()} == {2, 3}


def test_windows_keep_rows_without_a_time(spark):
    root = fresh_path(spark, "win-in")
    _raw(spark, [(i, "20240101 00:00:0%d" % (i % 3) if i % 5 else "soon", "s%d" % (i % 2)) for i in range(60)], root)
    stream = spark.readStream.schema("frame_id long, Time string, stream_name string").parquet(root) \
                  .withColumn("at", SQ.as_instant(SQ.parse_stream_time("Time")))
    got = SQ.run_windows(stream, "at", "1 second", ["stream_name"], {"top": F.max("frame_id")})
    assert got.agg(F.sum("n")).first()[0] == 60
    lost = {r.stream_name: (r.n, r.top) for r in got.where("window_start is null").collect()}
    assert lost == {"s0": (6, 50), "s1": (6, 55)}


# ---- state ----

def test_burst_state_ends(spark):
    """Ten bursts a batch, each batch a minute later: the state holds the last bursts only."""
    root = fresh_path(spark, "evict-in")
    for minute in range(6):
        rows = spark.range(200).selectExpr(f"concat('b', {minute}, '_', id % 10) as burst", "char(65 + (id * 7) % 26) as letter",
                                           f"timestamp_seconds(1704067200 + {minute} * 60 + id % 2) as at")
        rows.coalesce(1).write.mode("append").parquet(root)
    stream = spark.readStream.schema("burst string, letter string, at timestamp").option("maxFilesPerTrigger", 1).parquet(root)
    seen: dict = {}

    def keep(batch, _):
        seen.update({r.burst: r.max_letter for r in batch.collect()})

    with SQ.state_store(spark, *BS.STATE_STORE):
        q = (BS.greatest_letters(stream, "burst", "letter", "at").writeStream.outputMode("update").foreachBatch(keep)
               .option("checkpointLocation", fresh_path(spark, "evict-ckpt")).trigger(availableNow=True).start())
        SQ._check(q)
    want = {r.burst: r.m for r in spark.read.parquet(root).groupBy("burst").agg(F.max("letter").alias("m")).collect()}
    assert seen == want and len(want) == 60
    states = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress]
    assert max(states) <= 40 < len(want) * 2  # a value and a timer for each of at most two batches' bursts
    assert spark.conf.get(BS.STATE_STORE[0], None) != BS.STATE_STORE[1]


def test_evicting_flow_equals_the_other_over_a_restart(spark, sf_dir):
    fr = fx.frames(spark, sf_dir).where("frame_id < 200")
    root, out, ckpt = (fresh_path(spark, k) for k in ("ev-in", "ev-out", "ev-ckpt"))
    for half in ("frame_id < 100", "frame_id >= 100"):
        feeder.write_bursts(fr.where(half), root)
        Q.burst_letters_evicting(spark, root, out=out, checkpoint=ckpt)
    plain = SQ.latest_per_key(spark, Q.burst_letters(spark, root), ["burst"])
    got = SQ.latest_per_key(spark, out, ["burst"])
    assert got.exceptAll(plain).count() == plain.exceptAll(got).count() == 0 < plain.count()


# ---- upsert table ----

def _batch(spark, n):
    return spark.createDataFrame([(k, n * 100 + k) for k in range(n % 5, n % 5 + 3)], "key long, value long")


def test_upsert_reads_stay_flat(spark):
    path = fresh_path(spark, "upsert")
    table = UpsertTable(spark, path, ["key"], every=8)
    table.create(_batch(spark, 0).schema)
    want, files = {}, []
    for n in range(200):
        table.write(_batch(spark, n).coalesce(1), n)
        want.update({k: n * 100 + k for k in range(n % 5, n % 5 + 3)})
        if n % 20 == 19:
            files.append(table.files())
    assert {r.key: r.value for r in table.read().collect()} == want
    assert max(files[1:]) <= max(files[:2]) + 2 and max(files) < 40


def test_upsert_replay_and_restart(spark):
    path = fresh_path(spark, "upsert")
    first = UpsertTable(spark, path, ["key"], every=3)
    first.create(_batch(spark, 0).schema)
    for n in range(5):
        first.write(_batch(spark, n), n)
    before = sorted(map(tuple, first.read().collect()))
    again = UpsertTable(spark, path, ["key"], every=3)  # a restart
    again.create(_batch(spark, 0).schema)
    again.write(_batch(spark, 4), 4)  # not in a generation: its folder is replaced
    again.write(_batch(spark, 1), 1)  # in a generation already
    assert sorted(map(tuple, again.read().collect())) == before
    # a crash after the next generation was written and before its pointer: readers do not see it
    spark.createDataFrame([(9, 9, 9)], "key long, value long, _batch long").write.mode("overwrite").parquet(f"{path}/generation=2")
    assert sorted(map(tuple, again.read().collect())) == before
    again.write(_batch(spark, 5), 5)
    assert {r.key: r.value for r in again.read().collect()} == {0: 500, 1: 501, 2: 502, 3: 303, 4: 404, 5: 405, 6: 406}
    assert again._pointer() == (2, 5)


def test_upsert_reader_while_a_pointer_is_replaced(spark):
    """With one pointer gone (being rewritten), the other generation is read, whole."""
    path = fresh_path(spark, "upsert")
    table = UpsertTable(spark, path, ["key"], every=2)
    table.create(_batch(spark, 0).schema)
    for n in range(4):
        table.write(_batch(spark, n), n)
    generation, _ = table._pointer()
    current = sorted(map(tuple, table.read().collect()))
    spark.createDataFrame([], "generation long, batch long").write.mode("overwrite").parquet(f"{path}/pointer-{generation % 2}")
    assert table._pointer()[0] == generation - 1
    assert sorted(map(tuple, table.read().collect())) == current  # its generation and the batches after it


# ---- services ----

def test_timed_service_loses_nothing(spark):
    """Rows in are rows out over two timed runs, and the progress table says so."""
    root, out, ckpt, log = (fresh_path(spark, k) for k in ("svc-in", "svc-out", "svc-ckpt", "svc-log"))
    progress = SV.ProgressTable(spark, log)
    spark.streams.addListener(progress)
    try:
        total = 0
        for run in range(2):
            for arrival in range(3):
                spark.range(total, total + 50).coalesce(1).write.mode("append").parquet(root)
                total += 50
            stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(root)
            query = SV.start_service(stream, "parquet", out, ckpt, every="1 second")
            SV.run_for(query, 8)
            assert not query.isActive
        got = spark.read.parquet(out)
        assert got.count() == total == got.distinct().count()
        for _ in range(50):
            if sum(r[4] for r in progress.rows) >= total:
                break
            time.sleep(0.1)
        progress.flush()
        assert progress.table().agg(F.sum("n_rows")).first()[0] == total
        assert progress.failures == {}
    finally:
        spark.streams.removeListener(progress)


def test_stop_waits_for_the_running_batch(spark):
    class Query:
        isActive = True
        calls: list = []

        @property
        def status(self):
            self.calls.append("status")
            return {"isTriggerActive": len(self.calls) < 4}

        def stop(self):
            self.calls.append("stop")

        def exception(self):
            return None

    q = Query()
    SV.stop_after_batch(q)
    assert q.calls == ["status"] * 4 + ["stop"]
    q.exception = lambda: "broken"
    with pytest.raises(RuntimeError):
        SV.stop_after_batch(q)
