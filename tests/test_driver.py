"""The daily driver: killed runs, two drivers, days that are over."""

import json
import os

import pytest

from quire.streaming import driver


@pytest.fixture
def pages(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(5):
        (tmp_path / "in" / f"{k}.json").write_text(json.dumps({"page": k + 1}))
        os.utime(tmp_path / "in" / f"{k}.json", (1_700_000_000 + 60 * k,) * 2)
    return lambda: spark.readStream.schema("page int").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))


def done(spark, where):
    found = driver.results(spark, where)
    return [] if found is None else sorted(r.page for r in found.collect())


def test_days_and_bursts(spark, pages, tmp_path):
    where, ran = str(tmp_path / "run"), []
    go = lambda day, now: driver.run_day(pages(), where, day, lambda b: ran.append(1) or b, "a", lambda: now, batches=2)
    assert go("2024-01-01", 0.0) == 2 and done(spark, where) == [1, 2]
    assert go("2024-01-01", 9e9) is None
    assert go("2024-01-02", 9e4) == 2 and go("2024-01-03", 2e5) == 1
    assert done(spark, where) == [1, 2, 3, 4, 5] and len(ran) == 5
    assert go("2024-01-04", 3e5) == 0


@pytest.mark.parametrize("where_killed", ["before", "after"])
def test_a_killed_run_repeats_nothing(spark, pages, tmp_path, monkeypatch, where_killed):
    where, ran = str(tmp_path / "run"), []

    def job(batch):
        ran.extend(r.page for r in batch.collect())
        if where_killed == "before" and ran == [1, 2]:
            raise KeyError("killed")
        return batch

    if where_killed == "after":
        commit = driver.StateLog.commit

        def killed(self, make, writer, batch):
            out = commit(self, make, writer, batch)
            if ran == [1, 2]:
                raise KeyError("killed")
            return out

        monkeypatch.setattr(driver.StateLog, "commit", killed)
    with pytest.raises(Exception, match="killed"):
        driver.run_day(pages(), where, "d", job, "a", lambda: 0.0, lease=100)
    assert done(spark, where) == ([1] if where_killed == "before" else [1, 2])
    assert driver.run_day(pages(), where, "d", job, "b", lambda: 50.0, lease=100) is None
    driver.run_day(pages(), where, "d", job, "b", lambda: 101.0, lease=100)
    assert done(spark, where) == [1, 2, 3, 4, 5]
    assert ran == ([1, 2, 2, 3, 4, 5] if where_killed == "before" else [1, 2, 3, 4, 5])


def test_whoever_lost_the_day_stops(spark, pages, tmp_path):
    where, now = str(tmp_path / "run"), [0.0]

    def slow(batch):
        now[0] += 1000.0
        other = driver.Days(spark, f"{where}/days", 100)
        if now[0] == 1000.0:
            assert other.claim("d", "b", now[0]) == 2
            assert other.claim("d", "c", now[0]) is None
        return batch

    with pytest.raises(Exception, match=driver.LOST):
        driver.run_day(pages(), where, "d", slow, "a", lambda: now[0], lease=100)
    assert done(spark, where) == [1]
