"""One portfolio for batch jobs and streams: commits, crashes, replays, conflicts."""

from dataclasses import replace

import pytest

from tallybook.params import Scenario
from tallybook.plans import build as build_module
from tallybook.plans.build import build_portfolio
from tallybook.plans.portfolio import score_portfolio
from tallybook.sources import snapshots as S
from tallybook.sources.keys import key_table
from tallybook.sources.store import read_portfolio, write_portfolio
from tallybook.streaming.scoring import append_portfolio, score_stream

BASE = Scenario()
UP = replace(BASE, scenario_name="UP", rate_shift_bps=200)


def counted(n, *scenarios):
    return [replace(s, application_count=n) for s in scenarios]


def run_stream(spark, tmp_path, path):
    source = str(tmp_path / "in")
    stream = spark.readStream.schema("application_seq long").parquet(source)
    append_portfolio(score_stream(stream), path, str(tmp_path / "progress")).awaitTermination(120)


def counts(spark, path):
    return {r[0]: r[1] for r in read_portfolio(spark, path).groupBy("scenario_name").count().collect()}


@pytest.mark.parametrize("order", ["batch first", "stream first"])
def test_batch_and_stream_write_one_portfolio(spark, tmp_path, order):
    path = str(tmp_path / "p")
    key_table(spark, 50).selectExpr("application_seq + 1000 AS application_seq").write.parquet(str(tmp_path / "in"))
    keys = key_table(spark, 30)
    steps = [lambda: build_portfolio(keys, counted(30, BASE, UP), path), lambda: run_stream(spark, tmp_path, path)]
    for step in steps if order == "batch first" else steps[::-1]:
        step()
    assert counts(spark, path) == {"BASELINE": 80, "UP": 30}
    build_portfolio(key_table(spark, 20), counted(20, BASE), path)  # the stream's rows stay
    run_stream(spark, tmp_path, path)  # nothing new
    assert counts(spark, path) == {"BASELINE": 70, "UP": 30}
    key_table(spark, 5).selectExpr("application_seq + 2000 AS application_seq").write.mode("append").parquet(str(tmp_path / "in"))
    run_stream(spark, tmp_path, path)
    assert counts(spark, path) == {"BASELINE": 75, "UP": 30}
    want = score_portfolio(key_table(spark, 20)).drop("created_ts")
    got = read_portfolio(spark, path).where("scenario_name = 'BASELINE' AND application_seq <= 20").drop("created_ts")
    assert got.exceptAll(want).count() == 0 and got.count() == 20


def test_a_crash_at_any_step_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "p")
    build_portfolio(key_table(spark, 20), counted(20, BASE), path)
    before = S.state(spark, path)

    def crash(*_):
        raise OSError("lost")

    for module, name in ((build_module, "write_folder"), (build_module, "require"), (build_module, "replace_batch"), (S, "_put")):
        with monkeypatch.context() as m, pytest.raises(OSError, match="lost"):
            m.setattr(module, name, crash)
            build_portfolio(key_table(spark, 30), counted(30, BASE), path)
        assert S.state(spark, path) == before and counts(spark, path) == {"BASELINE": 20}
    # what a writer leaves that dies while it writes its commit file
    (tmp_path / "p" / "_commits" / ".abc.draft").write_text('{"version": 2, "fold')
    assert counts(spark, path) == {"BASELINE": 20}
    build_portfolio(key_table(spark, 30), counted(30, BASE), path)
    assert counts(spark, path) == {"BASELINE": 30}


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = score_portfolio(key_table(spark, 10))
    assert S.append_batch(rows, 0, path, "s") and not S.append_batch(rows, 0, path, "s")
    assert S.append_batch(rows, 0, path, "other") and S.append_batch(rows, 1, path, "s")
    assert counts(spark, path) == {"BASELINE": 30}


def test_a_batch_that_was_written_but_not_committed_is_written_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "p")
    rows = score_portfolio(key_table(spark, 10))
    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(S, "_put", lambda *_: (_ for _ in ()).throw(OSError()))
        S.append_batch(rows, 0, path, "s")
    assert read_portfolio(spark, path).count() == 0
    assert S.append_batch(rows, 0, path, "s") and counts(spark, path) == {"BASELINE": 10}


def test_writers_at_the_same_time_both_count(spark, tmp_path):
    path = str(tmp_path / "p")
    base, up = (S.write_folder(score_portfolio(key_table(spark, 10), s), path) for s in (BASE, UP))
    asked = []

    def change(now):
        if not asked:  # the other writer commits between our look and our commit
            S.replace_batch(spark, path, *up)
        asked.append(now["version"])
        new = [{"snapshot": base[0], "partition": p, "origin": S.BATCH} for p in base[1]]
        return {"folders": now["folders"] + new, "streams": now["streams"]}

    assert S.commit(spark, path, change)
    assert asked == [0, 1] and counts(spark, path) == {"BASELINE": 10, "UP": 10}
    with pytest.raises(S.Conflict):
        S._put(spark, path, {"version": 1, "folders": [], "streams": {}})


def test_older_versions_compaction_and_vacuum(spark, tmp_path):
    path = str(tmp_path / "p")
    build_portfolio(key_table(spark, 7), counted(7, BASE), path)
    for i in range(3):
        S.append_batch(score_portfolio(key_table(spark, 10).selectExpr(f"application_seq + {100 * i + 100} AS application_seq")), i, path, "s")
    assert S.read_snapshot(spark, path, 2).count() == 17 and S.read_snapshot(spark, path).count() == 37
    assert S.compact(spark, path, "s") and not S.compact(spark, path, "s")
    assert len(S.history(spark, path).where("origin = 'stream s'").collect()) == 1
    assert S.read_snapshot(spark, path).count() == 37
    assert S.vacuum(spark, path, keep=1) == []  # all folders are young
    S.append_batch(score_portfolio(key_table(spark, 1)), 3, path, "s")
    gone = S.vacuum(spark, path, keep=1, older_than_seconds=-60)
    assert len(gone) == 3 and S.versions(spark, path) == [6] and read_portfolio(spark, path).count() == 38
    assert not S.append_batch(score_portfolio(key_table(spark, 1)), 3, path, "s")


def test_names_and_filters(spark, tmp_path):
    path = str(tmp_path / "p")
    odd = replace(BASE, scenario_name="a/b=c %{d}*", population_id="x|y")
    build_portfolio(key_table(spark, 4), counted(4, BASE, odd), path)
    built = build_portfolio(key_table(spark, 3), counted(3, odd), path)
    assert built.count() == 3 and read_portfolio(spark, path).count() == 7
    text = read_portfolio(spark, path).where("scenario_name = 'BASELINE'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(scenario_name" in text


def test_folders_of_another_kind_are_refused(spark, tmp_path):
    plain, shots = str(tmp_path / "plain"), str(tmp_path / "shots")
    write_portfolio(score_portfolio(key_table(spark, 3)), plain)
    with pytest.raises(ValueError, match="snapshots"):
        build_portfolio(key_table(spark, 3), counted(3, BASE), plain)
    key_table(spark, 3).write.parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="snapshots"):
        run_stream(spark, tmp_path, plain)
    build_portfolio(key_table(spark, 3), counted(3, BASE), shots)
    with pytest.raises(ValueError, match="snapshots"):
        write_portfolio(score_portfolio(key_table(spark, 3)), shots)
