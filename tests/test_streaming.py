import json

from pyspark.sql import functions as F

from silverthread import streaming
from silverthread.operators import events as E
from silverthread.sources import read_events
from silverthread.streaming.ingest import add_ids, fresh_events

from test_events import PAYLOADS, event


def land(folder, name, documents):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(d) for d in documents))


def ingest(spark, tmp_path, events):
    out = str(tmp_path / "out")
    streaming.ingest_events(events, out, str(tmp_path / "progress")).awaitTermination()
    return spark.read.parquet(out)


def test_stream_gives_the_rows_of_the_batch(spark, tmp_path, rows):
    landing = tmp_path / "landing"
    land(landing, "1.json", [event(*shape) for shape in PAYLOADS])
    land(landing, "2.json", [event("OTHER", "v1", {}), event("CLAIMS", "v1", {"claim_id": "x"})])
    found = ingest(spark, tmp_path, streaming.events_stream(spark, str(landing), files_per_batch=1))
    batch = E.normalize_all(read_events(spark, str(landing)))
    assert rows(found, *batch.columns) == rows(batch)


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "1.json", [event("POLICY", "v1")])
    stream = lambda: streaming.events_stream(spark, str(landing))
    assert ingest(spark, tmp_path, stream()).count() == 1
    land(landing, "2.json", [event("POLICY", "v1", event_id="E2")])
    assert ingest(spark, tmp_path, stream()).count() == 2
    assert ingest(spark, tmp_path, stream()).count() == 2


def test_redelivered_and_late_events_come_once(spark, tmp_path, rows):
    landing, out = tmp_path / "landing", str(tmp_path / "out")

    def deliver(name, documents):
        land(landing, name, documents)
        streaming.ingest_once(
            streaming.events_stream(spark, str(landing)), out, str(tmp_path / "progress")
        ).awaitTermination()

    first = event("POLICY", "v1")
    late = {**event("POLICY", "v1", event_id="E2"), "event_timestamp": "2019-01-01T00:00:00"}
    deliver("1.json", [first, first])
    deliver("2.json", [late, first] + [event("POLICY", "v1", event_id=None)] * 2)
    deliver("3.json", [late, event("POLICY", "v1", event_id="E3")])
    found = spark.read.parquet(out)
    assert rows(E.valid_rows(found, E.POLICY), "event_id") == [("E1",), ("E2",), ("E3",)]
    assert E.rejected_events(found).count() == 2


def test_a_redelivery_with_another_time_comes_once(spark, tmp_path, rows):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    first = event("POLICY", "v1")
    others = ["2031-05-06T07:08:09", first["event_timestamp"].replace(" ", "T"), None]
    for n, documents in enumerate([[first], *[[{**first, "event_timestamp": t}] for t in others]]):
        land(landing, f"{n}.json", documents)
        streaming.ingest_once(
            streaming.events_stream(spark, str(landing)), out, str(tmp_path / "progress")
        ).awaitTermination()
    assert rows(spark.read.parquet(out), "event_id", "event_timestamp") == [("E1", first["event_timestamp"])]


def test_the_newest_of_two_differing_deliveries_of_a_batch_stays(spark, tmp_path, rows):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    first = event("POLICY", "v1")
    later = {**first, "event_timestamp": "2031-05-06 07:08:09"}
    timeless = {**first, "event_timestamp": None}
    land(landing, "1.json", [timeless, later, first])
    streaming.ingest_once(
        streaming.events_stream(spark, str(landing)), out, str(tmp_path / "progress")
    ).awaitTermination()
    assert rows(spark.read.parquet(out), "event_timestamp") == [("2031-05-06 07:08:09",)]


def test_a_table_stored_without_ids_has_them_added(spark, tmp_path, rows):
    landing, out = tmp_path / "landing", str(tmp_path / "out")

    def deliver(name, documents, ids):
        land(landing, name, documents)
        streaming.ingest_once(
            streaming.events_stream(spark, str(landing)), out, str(tmp_path / "progress"), ids=ids
        ).awaitTermination()

    deliver("1.json", [event("POLICY", "v1")], str(tmp_path / "a"))
    deliver("2.json", [event("POLICY", "v1"), event("POLICY", "v1", event_id="E2")], str(tmp_path / "b"))
    assert rows(spark.read.parquet(out), "event_id") == [("E1",), ("E2",)]


def test_a_batch_is_read_and_parsed_once(spark, tmp_path, rows):
    read = spark.sparkContext.accumulator(0)

    def counted(parts):
        for part in parts:
            read.add(len(part))
            yield part

    def batch(*found):
        given = spark.createDataFrame(found, "event_id string, event_timestamp string")
        return given.mapInPandas(counted, given.schema)

    index = streaming.IdIndex(spark, str(tmp_path / "ids"))
    first = fresh_events(batch(("E1", "1"), ("E1", "2"), (None, "3")), index, 0, str(tmp_path / "a"))
    add_ids(first, index, 0)
    assert rows(first) == [("E1", "2"), (None, "3")]
    assert read.value == 3
    again = fresh_events(batch(("E1", "9"), ("E2", "4"), (None, None)), index, 1, str(tmp_path / "b"))
    assert rows(again) == [("E2", "4"), (None, None)]
    assert read.value == 6


def test_many_ids_are_not_broadcast(spark, tmp_path, conf):
    """Their files are under the threshold of a broadcast, the table built of them is not.
    Such a table takes whole pages of up to 64 MB."""
    conf("spark.sql.maxBroadcastTableSize", "72m")

    def batch(first, n=1_000_000):
        return spark.range(first, first + n).selectExpr("concat('E', id) AS event_id", "'2024-01-01' AS event_timestamp")

    def span(events):
        number = F.substring("event_id", 2, 9).cast("int")
        return tuple(events.agg(F.count("*"), F.count_distinct(number), F.min(number), F.max(number)).first())

    index = streaming.IdIndex(spark, str(tmp_path / "ids"))
    add_ids(fresh_events(batch(0), index, 0, str(tmp_path / "a")), index, 0)
    again = fresh_events(batch(200_000), index, 1, str(tmp_path / "b"))
    assert span(again) == (200_000, 200_000, 1_000_000, 1_199_999)
    add_ids(again, index, 1)
    few = fresh_events(batch(1_199_990, 20), index, 2, str(tmp_path / "c"))
    assert span(few) == (10, 10, 1_200_000, 1_200_009)
