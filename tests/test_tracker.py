"""The tracker's stream: rules of gate, lock and review, leases by event time, and runs that are cut and taken up again."""

import datetime as dt
import json
import os
import time

import pytest

from quire.streaming import tracker

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)


def feed(folder, name, events):
    """events: (minute, page, action, actor, extra fields)."""
    lines = []
    for seq, (minute, page, action, actor, *more) in events:
        e = {"campaign": 7, "seq": seq, "ts": (T0 + dt.timedelta(minutes=minute)).isoformat(), "page": page, "action": action, "actor": actor} | (more[0] if more else {})
        lines.append(json.dumps(e))
    (folder / name).write_text("\n".join(lines))
    # Files come in the order of their times.
    at = 1_700_000_000 + 60 * len(list(folder.iterdir()))
    os.utime(folder / name, (at, at))


def run(spark, tmp_path, total=3, **options):
    rows = spark.readStream.schema(tracker.EVENT).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    tracker.logged(tracker.verdicts(rows, total, **options), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    found = spark.read.schema(tracker.VERDICT).parquet(str(tmp_path / "out")).orderBy("us", "seq").collect()
    return [(r.seq, r.action, r.page, r.status, r.accepted, r.reason, r.token) for r in found]


RULES = [
    ((0, 2, "claim", "w"), (2, "pending", False, "not the gate")), ((1, None, "claim", "w"), (1, "claimed", True, "")), ((2, None, "claim", "x"), (1, "claimed", False, "busy")),
    ((3, 1, "start", "x"), (1, "claimed", False, "not the holder")), ((4, 1, "start", "w"), (1, "in_progress", True, "")), ((5, 1, "submit", "w"), (1, "in_progress", False, "validator failed")),
    ((6, 1, "submit", "w", {"flag": True}), (1, "review", True, "")), ((7, 1, "approve", "w"), (1, "review", False, "independent review required")), ((8, 1, "rework", "w"), (1, "rework", True, "")),
    ((9, 1, "start", "w"), (1, "in_progress", True, "")), ((10, 1, "submit", "w", {"flag": True}), (1, "review", True, "")), ((11, 1, "approve", "w", {"flag": True}), (1, "approved", True, "")),
    ((12, 1, "commit", "x"), (1, "approved", False, "not the holder")), ((13, 1, "commit", "w"), (1, "committed", True, "")), ((14, None, "claim", "x"), (2, "claimed", True, "")),
    ((15, 2, "reclaim", "o"), (2, "claimed", False, "lock is not stale")), ((16, 2, "reclaim", "o", {"flag": True}), (2, "blocked", True, "forced")), ((17, None, "claim", "w"), (2, "blocked", False, "gate is blocked")),
    ((18, 2, "unblock", "o"), (2, "pending", True, "")), ((19, None, "claim", "w"), (2, "claimed", True, "")), ((20, 2, "block", "w"), (2, "blocked", True, "")), ((21, 9, "start", "w"), (9, "", False, "no such page")), ((22, 2, "dance", "w"), (2, "blocked", False, "no such action")),
]


@pytest.mark.parametrize("cuts", [[0, 23], [0, 4, 9, 10, 23]])
def test_rules(spark, tmp_path, cuts):
    (tmp_path / "in").mkdir()
    events = list(enumerate(e for e, _ in RULES))
    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        feed(tmp_path / "in", f"{k}.json", events[a:b])
    assert [r[2:6] for r in run(spark, tmp_path)] == [w for _, w in RULES]


def test_a_stopped_stream_goes_on(spark, tmp_path):
    (tmp_path / "in").mkdir()
    events = list(enumerate(e for e, _ in RULES))
    feed(tmp_path / "in", "0.json", events[:9])
    run(spark, tmp_path)
    feed(tmp_path / "in", "1.json", events[9:])
    assert [r[2:6] for r in run(spark, tmp_path)] == [w for _, w in RULES]


def test_it_begins_from_a_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    feed(tmp_path / "in", "0.json", [(0, (0, None, "claim", "w"))])
    pages = spark.createDataFrame([(7, 1, "committed", None), (7, 2, "committed", "a")], tracker.PAGE)
    assert run(spark, tmp_path, pages=pages) == [(0, "claim", 3, "claimed", True, "", 1)]


def test_pages_are_forgotten(spark, tmp_path):
    (tmp_path / "in").mkdir()
    feed(tmp_path / "in", "0.json", list(enumerate(e for e, _ in RULES[:14])))
    rows = tracker.verdicts(spark.readStream.schema(tracker.EVENT).json(str(tmp_path / "in")), 3, retain_ms=3000)
    with tracker.rocks(spark):
        query = rows.writeStream.format("memory").queryName("forgotten").trigger(processingTime="1 second").option("checkpointLocation", str(tmp_path / "state")).start()

    def wait(n):
        for _ in range(40):
            if spark.table("forgotten").count() == n:
                return
            time.sleep(0.5)

    try:
        wait(14)
        time.sleep(4)
        feed(tmp_path / "in", "1.json", [(20, (30, 1, "approve", "z"))])
        wait(15)
        found = {r.seq: r.status for r in spark.table("forgotten").collect()}
    finally:
        query.stop()
    assert found[13] == "committed" and found[20] == "pending"
    with pytest.raises(ValueError, match="choose one"):
        tracker.verdicts(spark.readStream.schema(tracker.EVENT).json(str(tmp_path)), 3, leases=True, retain_ms=1)


LEASED = [
    (0, None, "claim", "w"), (20, None, "heartbeat", "w", {"token": 1}), (49, 1, "start", "w", {"token": 1}), (60, 1, "submit", "w", {"flag": True, "token": 1}), (61, 1, "unblock", "o"), (62, None, "claim", "x"),
    (63, 1, "start", "w", {"token": 1}), (64, 1, "start", "x", {"token": 1}), (65, 1, "start", "x", {"token": 2}), (66, 1, "block", "x", {"crashed": True}), (70, 1, "block", "x"), (72, 1, "heartbeat", "x"), (80, 1, "heartbeat", "x"),
]


@pytest.mark.parametrize("cuts", [[0, 13], [0, 2, 3, 7, 10, 11, 13]])
def test_leases(spark, tmp_path, cuts):
    (tmp_path / "in").mkdir()
    events = list(enumerate(LEASED))
    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        feed(tmp_path / "in", f"{k}.json", events[a:b])
    feed(tmp_path / "in", "z.json", [(50, (200, 9, "claim", "z"))])
    got = run(spark, tmp_path, leases=True)
    assert [r[:6] for r in got if r[0] is not None and r[0] < 50] == [
        (0, "claim", 1, "claimed", True, ""), (1, "heartbeat", 1, "claimed", True, ""), (2, "start", 1, "in_progress", True, ""), (3, "submit", 1, "blocked", False, "not the holder"), (4, "unblock", 1, "pending", True, ""),
        (5, "claim", 1, "claimed", True, ""), (6, "start", 1, "claimed", False, "not the holder"), (7, "start", 1, "claimed", False, "stale token"), (8, "start", 1, "in_progress", True, ""), (9, "block", 1, "in_progress", False, "crashed"),
        (10, "block", 1, "in_progress", False, "state lock is held"), (11, "heartbeat", 1, "in_progress", True, ""), (12, "heartbeat", 1, "in_progress", True, ""),
    ]
    assert [(r[1], r[2]) for r in got if r[0] is None] == [("expire", 1), ("unlock", None), ("expire", 1)]


def test_a_lock_runs_out_by_a_timer(spark, tmp_path):
    """The other campaign's clock moves the watermark; no event of its own comes."""
    (tmp_path / "in").mkdir()
    feed(tmp_path / "in", "0.json", [(0, (0, None, "claim", "w")), (1, (1, None, "heartbeat", "w", {"crashed": True}))])
    feed(tmp_path / "in", "1.json", [(0, (45, None, "claim", "other", {"campaign": 8}))])
    got = run(spark, tmp_path, leases=True)
    assert [(r[0], r[1], r[3]) for r in got] == [(0, "claim", "claimed"), (1, "heartbeat", "claimed"), (None, "unlock", None), (None, "expire", "blocked"), (0, "claim", "claimed")]


def test_the_sessions_provider_comes_back(spark):
    before = spark.conf.get(tracker.PROVIDER[0], None)
    with tracker.rocks(spark):
        assert spark.conf.get(tracker.PROVIDER[0]).endswith("RocksDBStateStoreProvider")
    assert spark.conf.get(tracker.PROVIDER[0], None) == before
