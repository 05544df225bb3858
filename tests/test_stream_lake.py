"""The stream of events into the lake that the gold run reads."""

import json
from pathlib import Path

import pytest

from silverthread.operators import events as E
from silverthread.plans import jobs, stream
from silverthread.sources import read_table

from test_events import event


@pytest.fixture
def lake(tmp_path):
    layout = jobs.Layout(str(tmp_path / "lake"))
    Path(layout.raw("events")).mkdir(parents=True)
    return layout


def land(layout, name, documents):
    Path(layout.raw("events"), name).write_text("\n".join(json.dumps(d) for d in documents))


def files(layout):
    return sorted(Path(layout.silver("events")).rglob("*.parquet"))


def test_batches_are_stored_once_and_merged(spark, lake, rows):
    for n in range(5):
        new = [event("POLICY", "v1", event_id=f"E{n}-{k}") for k in range(20)]
        land(lake, f"{n}.json", [*new, event("POLICY", "v1", event_id="E0-0"), event("OTHER", "v1", {}, event_id=f"X{n}")])
        run = stream.stream_events(spark, lake, fan=3)
        assert run.processed == 20 and run.counts["batches"] == 1
    wide = jobs.events_table(spark, lake)
    valid = rows(E.valid_rows(wide, E.POLICY), "event_id")
    assert valid == sorted((f"E{n}-{k}",) for n in range(5) for k in range(20))
    assert E.rejected_events(wide).count() == 5
    assert read_table(spark, lake.quarantine("rejected_events")).count() == 5
    live = stream.Manifests(spark, lake.generations("events")).newest()
    assert len(live) <= 3 and sum(g.rows for g in live) == 5 * 21
    # One file for each outcome and domain of a generation, and replaced ones are gone.
    assert len(files(lake)) <= 2 * 2 * len(live) + 6


def test_bad_rows_go_to_quarantine(spark, lake):
    land(lake, "1.json", [event("POLICY", "v1", {"policy_id": None}), event("POLICY", "v1", event_id="E2")])
    run = stream.stream_events(spark, lake)
    assert (run.processed, run.failed) == (1, 1)
    assert read_table(spark, lake.quarantine("policy_events")).count() == 1
    assert stream.stream_events(spark, lake).counts["batches"] == 0
    assert jobs.events_table(spark, lake).count() == 2


def test_an_uncommitted_batch_is_not_seen_and_runs_again(spark, lake, rows, monkeypatch):
    land(lake, "1.json", [event("POLICY", "v1")])
    stream.stream_events(spark, lake)
    land(lake, "2.json", [event("POLICY", "v1", event_id="E2")])

    def fail(*_):
        raise RuntimeError("lost before the commit")

    with monkeypatch.context() as broken:
        broken.setattr(stream, "add_ids", fail)
        with pytest.raises(Exception, match="lost before the commit"):
            stream.stream_events(spark, lake)
    assert rows(jobs.events_table(spark, lake), "event_id") == [("E1",)]
    stream.stream_events(spark, lake)
    assert rows(jobs.events_table(spark, lake), "event_id") == [("E1",), ("E2",)]


def test_stream_and_batch_do_not_mix(spark, lake):
    land(lake, "1.json", [event("POLICY", "v1")])
    stream.stream_events(spark, lake)
    with pytest.raises(ValueError, match="stream"):
        jobs.run_events(spark, lake)
