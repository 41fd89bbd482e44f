"""State by manifests: a writer stopped between any two steps loses nothing; two writers at once lose nothing."""

import json
import threading

import pytest

from quire.sources.store import Store
from quire.streaming import campaign, state_log
from quire.streaming.state_log import StateLog


def rows(spark, *pairs):
    return spark.createDataFrame(pairs, "page int, status string")


def state(log):
    found = log.read()
    return None if found is None else sorted(map(tuple, found.collect()))


def test_put_is_once(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/a")
    assert store.names() == [] and store.put("1", "x") and not store.put("1", "y")
    assert store.read("1") == "x" and store.names() == ["1"]
    assert [f.name for f in (tmp_path / "a").iterdir() if not f.name.endswith(".crc")] == ["1"]


class Stopped(Exception):
    pass


@pytest.mark.parametrize("step", ["newest", "read", "make", "write", "put"])
@pytest.mark.parametrize("after", [False, True])
def test_a_writer_stopped_between_two_steps(spark, tmp_path, monkeypatch, step, after):
    log = StateLog(spark, str(tmp_path))
    log.commit(lambda old: rows(spark, (1, "a")), "w", 0)
    with monkeypatch.context() as m:
        if step == "put":
            put = Store.put
            m.setattr(Store, "put", lambda *a: stop(put, after, *a))
        elif step in ("newest", "read"):
            real = getattr(StateLog, step)
            m.setattr(StateLog, step, lambda *a, **k: stop(real, after, *a, **k))
        elif step == "write":
            from pyspark.sql.readwriter import DataFrameWriter

            write = DataFrameWriter.parquet
            m.setattr(DataFrameWriter, "parquet", lambda *a, **k: stop(write, after, *a, **k))

        def make(old):
            if step == "make":
                raise Stopped
            return old.unionByName(rows(spark, (2, "b")))

        with pytest.raises(Stopped):
            log.commit(make, "w", 1)
    assert state(log) == ([(1, "a"), (2, "b")] if step == "put" and after else [(1, "a")])
    # The batch is run again, as a stream does it, and is in the state once.
    log.commit(lambda old: old.unionByName(rows(spark, (2, "b"))), "w", 1)
    assert state(log) == [(1, "a"), (2, "b")]


def stop(real, after, *a, **k):
    if after:
        real(*a, **k)
    raise Stopped


def test_two_writers_at_once(spark, tmp_path):
    log, gate = StateLog(spark, str(tmp_path)), threading.Barrier(2)
    log.commit(lambda old: rows(spark, (0, "first")))

    def work(k):
        met = []

        def make(old):
            if not met:
                met.append(gate.wait(60))
            return old.unionByName(rows(spark, (k, "x")))

        StateLog(spark, str(tmp_path)).commit(make, f"w{k}", 0)

    threads = [threading.Thread(target=work, args=(k,)) for k in (1, 2)]
    [t.start() for t in threads]
    [t.join(120) for t in threads]
    assert state(log) == [(0, "first"), (1, "x"), (2, "x")]
    assert log.newest()["version"] == 2 and log.newest()["writers"] == {"w1": 0, "w2": 0}
    assert log.sweep(keep=1) == 3 and state(log) == [(0, "first"), (1, "x"), (2, "x")]


def test_half_a_manifest_is_passed_over(spark, tmp_path):
    log = StateLog(spark, str(tmp_path))
    assert log.newest() is None and log.read() is None
    log.commit(lambda old: rows(spark, (1, "a")))
    (tmp_path / "manifests" / "000000000007.json").write_text('{"version": 7, "ta')
    assert state(log) == [(1, "a")]


def test_a_stream_keeps_the_latest(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for k, events in enumerate([[(0, 1, "claimed"), (1, 2, "claimed")], [(2, 1, "review"), (3, 3, "claimed")]]):
        (src / f"{k}.json").write_text("\n".join(json.dumps({"campaign": "c", "seq": s, "page": p, "status": x, "accepted": True}) for s, p, x in events))
        stream = spark.readStream.schema(campaign.OUT).json(str(src))
        campaign.replace_state(stream, str(tmp_path / "state"), str(tmp_path / "cp")).awaitTermination()
    found = campaign.current_state(spark, str(tmp_path / "state"))
    assert sorted((r.page, r.status, r.seq) for r in found.collect()) == [(1, "review", 2), (2, "claimed", 1), (3, "claimed", 3)]
    with pytest.raises(state_log.Conflict):
        log = StateLog(spark, str(tmp_path / "state"))
        log.store.put = lambda *a: False
        log.commit(lambda old: old, tries=2)
