"""The page campaign: batch fold, gate and locks, stream, batches."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from quire.operators import campaign
from quire.streaming import campaign as streams

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)


def log(*events):
    return [("c", k, T0 + dt.timedelta(minutes=minute), page, action, actor) for k, (minute, page, action, actor) in enumerate(events)]


FULL = log(
    (0, 2, "claim", "w"), (0, 1, "claim", "w"), (1, 1, "claim", "x"), (1, 1, "start", "x"), (2, 1, "start", "w"), (3, 1, "submit", "w"), (4, 1, "approve", "w"),
    (4, 1, "rework", "r"), (5, 1, "claim", "w"), (6, 1, "start", "w"), (7, 1, "submit", "w"), (8, 1, "approve", "r"), (8, 2, "claim", "w"), (9, 1, "commit", "r"),
    (10, 2, "claim", "x"), (10, 2, "block", "x"), (11, 3, "claim", "x"), (12, 2, "unblock", "o"), (13, 2, "claim", "x"), (14, 9, "claim", "x"), (50, 2, "heartbeat", "x"),
)
ACCEPTED = [0, 1, 0, 0, 1, 1, 0, 1, 1, 1, 1, 1, 0, 1, 1, 1, 0, 1, 1, 0, 0]


def test_batch_campaign(spark):
    got = streams.batch(spark.createDataFrame(FULL, streams.EVENT), 3).orderBy("seq").collect()
    assert [int(r.accepted) for r in got] == ACCEPTED
    assert got[6].reason == "a reviewer must be someone else" and got[0].reason == "the gate is at page 1" and got[2].reason.startswith(("cannot claim", "page 1"))


def test_stream_equals_batch(spark, tmp_path):
    src = tmp_path / "events"
    src.mkdir()
    for part, rows in enumerate((FULL[:8], FULL[8:])):
        lines = [json.dumps({"campaign": c, "seq": s, "ts": t.isoformat(), "page": p, "action": a, "actor": w}) for c, s, t, p, a, w in rows]
        (src / f"{part}.json").write_text("\n".join(lines))
        verdicts = streams.stateful(streams.event_stream(spark, str(src)), 3)
        streams.append_events(verdicts, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    rows = spark.read.schema(streams.OUT).json(str(tmp_path / "out"))
    assert [int(r.accepted) for r in rows.orderBy("seq").collect()] == ACCEPTED


def test_a_stale_lock_goes_without_another_event(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "0.json").write_text(json.dumps({"campaign": "c", "seq": 0, "ts": "2026-01-01T00:00:00", "page": 1, "action": "claim", "actor": "w"}))
    query = streams.stateful(streams.event_stream(spark, str(src)), 3, stale=1.0, timers=True).writeStream.format("memory").queryName("released").trigger(processingTime="1 second").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        for _ in range(60):
            time.sleep(1)
            if spark.table("released").filter("action = 'release'").count():
                break
        found = {(r.seq, r.page, r.action, r.status) for r in spark.table("released").collect()}
    finally:
        query.stop()
    assert found == {(0, 1, "claim", "claimed"), (-1, 1, "release", "claimed")}


def test_state_is_replaced(spark, tmp_path):
    src = tmp_path / "verdicts"
    rows = [("c", 0, 1, "claim", "claimed", True, ""), ("c", 1, 1, "start", "in_progress", True, ""), ("c", 2, 2, "claim", "pending", False, "no")]
    spark.createDataFrame(rows, streams.OUT).write.json(str(src))
    streams.replace_state(spark.readStream.schema(streams.OUT).json(str(src)), str(tmp_path / "state"), str(tmp_path / "cp2")).awaitTermination()
    assert [(r.page, r.status) for r in streams.current_state(spark, str(tmp_path / "state")).collect()] == [(1, "in_progress")]


def test_fold_and_gate(spark):
    events = spark.createDataFrame([(1, 0, "claim", "w"), (1, 1, "start", "w"), (1, 2, "submit", "w"), (1, 3, "approve", "w"), (1, 4, "approve", "r"), (1, 5, "commit", "r"), (2, 0, "start", "w")], "page int, seq int, action string, actor string")
    state = campaign.fold(events)
    got = {r.page: (r.status, r.owner, r.attempts, r.n_refused) for r in state.collect()}
    assert got == {1: ("committed", "w", 1, 1), 2: ("pending", None, 0, 1)}
    assert tuple(campaign.sequence_gate(state).first()) == (2, "pending")
    assert [tuple(r) for r in campaign.state_errors(state.withColumn("page", F.col("page").cast("long")), 3).collect()] == [(3, "missing")]


def test_retry_batch(spark):
    now = F.lit("2024-01-03 00:00:00").cast("timestamp")
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 12)
    rows = [(5, "failed", old), (4, "failed", new), (3, "failed", None), (2, "raw_ocr_done", new), (1, "pending", None), (6, "done", old)]
    got = campaign.retry_batch(spark.createDataFrame(rows, "page int, status string, updated timestamp"), "page", now, 4).orderBy("place").collect()
    assert [(r.page, r.priority) for r in got] == [(3, 0), (5, 0), (2, 1), (1, 2)]


@pytest.mark.parametrize(("paths", "ok"), [(["ocr/1.txt"], True), (["ocr/1.txt", "x"], False), (["state/1.json"], False), ([], False)])
def test_commit_scope(spark, paths, ok):
    allowed = spark.createDataFrame([(1, ["ocr/1.txt", "state/1.json"], ["ocr/1.txt"])], "page int, paths array<string>, targets array<string>")
    commits = spark.createDataFrame([(1, "abcdef12", paths)], "page int, sha string, paths array<string>")
    assert campaign.commit_scope(commits, allowed).first().ok == ok


def test_marks_and_checklist(spark):
    state = spark.createDataFrame([(1, "pending", None), (2, "committed", None)], "page int, status string, updated timestamp")
    marked = campaign.mark(state, spark.createDataFrame([(1, "committed", T0), (3, "pending", T0)], state.schema))
    assert {r.page: r.status for r in marked.collect()} == {1: "committed", 2: "committed", 3: "pending"}
    assert tuple(campaign.checklist(marked, "page").first()) == (0, "- [x] 1\n- [x] 2\n- [ ] 3", 2, 3)
