import datetime as dt
import json

import pytest

from catalog import queries
from silverthread import constants as K, schemas, sinks, sources
from silverthread.operators import events as E
from silverthread.plans import jobs

from test_events import PAYLOADS, event

AS_OF = dt.date(2025, 6, 30)

RAW = {
    "historical_member_policy": """\
legacy_member_id,effective_date,record_updated_ts,birth_year,gender,coverage_start_date,coverage_end_date,policy_id,policy_type,state,enrollment_date,member_segment
L1,2024-01-01,2024-01-02 00:00:00,1990,F,2024-01-01,,P1,HMO,CA,2023-01-01,gold
L1,2024-01-01,2024-01-02 00:00:00,1990,F,2024-01-01,,P1,HMO,CA,2023-01-01,gold
L1,2023-01-01,2023-01-02 00:00:00,1990,F,2023-01-01,,P0,HMO,CA,2023-01-01,gold
L2,2024-01-01,2024-01-02 00:00:00,1980,M,2024-01-01,2024-12-31,P2,PPO,NY,2023-01-01,blue
L3,2024-01-01,2024-01-02 00:00:00,1980,X,2024-01-01,,P3,PPO,NY,2023-01-01,blue
L3,2024-01-01,2024-01-02 00:00:00,1980,X,2024-01-01,,P3,PPO,NY,2023-01-01,blue
L4,2024-01-01,2024-01-02 00:00:00,1980,M,2024-01-01,unknown,P4,PPO,NY,2023-01-01,blue
""",
    "migrated_members": """\
legacy_member_id,member_id,ssn_raw,patient_first_name,patient_last_name,email,phone_number,address_line,city,zip_code,migration_flag
L1,M1,111,A,B,a@b,1,s,c,00001,Y
L2,M2,222,C,D,c@d,2,t,e,00002,Y
L4,M4,444,E,F,e@f,4,u,g,00004,N
""",
    "members_current": "member_id\nM1\nM2\n",
    "claims": """\
claim_id,member_id,claim_date,claim_amount
C1,M1,2024-02-01,100.5
C1,M1,2024-02-01,100.5
C2,M2,2024-02-01,80000
C3,M9,2024-02-01,5
""",
    "claims_adjustments": """\
adjustment_id,claim_id,member_id,original_claim_amount,adjustment_amount,adjusted_final_amount,adjustment_date
A1,C1,M1,100.5,-0.5,100,2024-03-01
A2,C1,M1,100.5,-0.5,99,2024-03-01
A3,C3,M9,5,0,5,2024-03-01
""",
    "revenue": "member_id,premium_collected\nM1,500\nM1,-1\nM2,\n",
    "violations": "violation_id,member_id\nV1,M1\nV1,M1\n",
}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    for name, text in RAW.items():
        folder = base / "bronze" / name
        folder.mkdir(parents=True)
        (folder / "part.csv").write_text(text)
    landing = base / "bronze" / "events"
    landing.mkdir()
    documents = [event(*shape) for shape in PAYLOADS] + [event("OTHER", "v1", {})] * 2
    documents += [event("POLICY", "v1", {})] * 2
    (landing / "e.json").write_text("\n".join(json.dumps(d) for d in documents))
    layout = jobs.Layout(str(base))
    return layout, {r.job_name: r for r in jobs.run_all(spark, layout, AS_OF, domain_tables=True)}


def test_dimension_and_quarantine(spark, lake, rows):
    layout, runs = lake
    dimension = sources.read_table(spark, layout.silver("member_dimension"))
    assert rows(dimension, "member_id", "policy_id", "active_flag") == [
        ("M1", "P1", "Active"),
        ("M2", "P2", "Terminated"),
    ]
    bad = sources.read_table(spark, layout.quarantine("member_records"))
    assert rows(bad, "policy_id") == [("P3",), ("P4",)]
    assert (runs["member_dimension"].processed, runs["member_dimension"].failed) == (3, 2)


def test_claims_outputs(spark, lake, rows):
    layout, runs = lake
    fact = sources.read_table(spark, layout.silver("claims_fact"))
    assert rows(fact, "claim_id", "adjustment_id", "final_claim_amount", "claim_year") == [
        ("C1", "A1", 100.0, 2024)
    ]
    read = lambda path: sources.read_table(spark, path)
    assert rows(read(layout.quarantine("claims")), "claim_id") == [("C2",), ("C3",)]
    assert rows(read(layout.quarantine("adjustments")), "adjustment_id") == [("A2",), ("A3",)]
    assert read(layout.silver("revenue")).count() == 1
    assert read(layout.quarantine("revenue")).count() == 2
    assert read(layout.silver("violations")).count() == 1
    assert runs["claims_fact"].counts == {
        "claims": 1,
        "claims_bad": 2,
        "adjustments": 1,
        "adjustments_bad": 2,
        "claims_fact": 1,
        "revenue": 1,
        "revenue_bad": 2,
        "violations": 1,
    }


def test_event_outputs(spark, lake):
    layout, runs = lake
    stored = jobs.events_table(spark, layout)
    for domain in E.DOMAINS:
        name = f"{domain.category.lower()}_events"
        own = sources.read_table(spark, layout.silver(name))
        assert own.columns == domain.output
        assert own.count() == E.valid_rows(stored, domain).count() > 0
    assert sources.read_table(spark, layout.quarantine("policy_events")).count() == 1
    assert sources.read_table(spark, layout.quarantine("rejected_events")).count() == 2
    run = runs["event_domains"]
    assert run.counts["rejected"] == 2 and run.failed == 1 and run.processed == 9


def test_gold_and_log(spark, lake):
    layout, runs = lake
    gold = sources.read_table(spark, layout.gold("member_360")).collect()
    assert len(gold) == 1
    row = gold[0]
    assert (row["member_id"], row["state"], row["run_date"]) == ("M1", "CA", AS_OF)
    assert row["lifetime_value"] == 400.0 and row["violation_count"] == 1
    assert row["streaming_claim_events"] == 3 and row["streaming_payment_events"] == 2
    assert row["risk_tier"] == "MEDIUM"
    log = sources.read_table(spark, layout.run_log)
    assert log.filter(log.status == K.SUCCESS).count() == 4 == len(runs)


def test_gold_rerun_and_repeated_members(spark, lake):
    layout, _ = lake
    jobs.run_gold(spark, layout, AS_OF)
    assert sources.read_table(spark, layout.gold("member_360")).count() == 1
    jobs.run_gold(spark, layout, AS_OF, on_repeated_member="fail")
    jobs.run_gold(spark, layout, AS_OF, on_repeated_member="latest", count_events_once=True)
    row = sources.read_table(spark, layout.gold("member_360")).first()
    assert row["streaming_claim_events"] == 1  # both claim events have the id E1


def test_unused_adjustments_are_reported_on_request(spark, lake):
    layout, _ = lake
    run = jobs.run_claims(spark, layout, report_unused=True)
    assert run.counts["adjustments_unused"] == 0 and run.counts["claims_fact"] == 1


def test_rebalance_is_a_choice_of_layout_only(spark, lake, rows):
    layout, runs = lake
    before = {
        name: rows(sources.read_table(spark, layout.silver(name)).drop("processing_timestamp"))
        for name in ("events", "claims_fact")
    }
    jobs.run_claims(spark, layout, rebalance=False)
    run = jobs.run_events(spark, layout, rebalance=False)
    assert run.counts == runs["event_domains"].counts
    for name, found in before.items():
        stored = sources.read_table(spark, layout.silver(name)).drop("processing_timestamp")
        assert rows(stored) == found


def test_masked_quarantine(spark, lake):
    layout, _ = lake
    jobs.run_members(spark, layout, AS_OF, salt="s", mask_quarantine=True)
    bad = sources.read_table(spark, layout.quarantine("member_records")).collect()
    assert all(len(r["_malformed"]) == 64 for r in bad if r["_malformed"] is not None)


def test_runs_on_tables_without_rows(spark, tmp_path):
    for name, text in RAW.items():
        folder = tmp_path / "bronze" / name
        folder.mkdir(parents=True)
        (folder / "part.csv").write_text(text.splitlines()[0] + "\n")
    (tmp_path / "bronze" / "events").mkdir()
    (tmp_path / "bronze" / "events" / "e.json").write_text("")
    runs = jobs.run_all(spark, jobs.Layout(str(tmp_path)), AS_OF)
    assert [(r.processed, r.failed) for r in runs] == [(0, 0)] * 4


def test_stored_schemas_are_those_the_plans_write(spark, lake):
    layout, _ = lake
    for name, schema in (
        ("member_dimension", schemas.MEMBER_DIMENSION),
        ("events", schemas.EVENT_ROWS),
        ("claims_fact", schemas.CLAIMS_FACT_AMOUNTS),
    ):
        stored = dict(sources.read_table(spark, layout.silver(name)).dtypes)
        assert {f.name: f.dataType.simpleString() for f in schema}.items() <= stored.items()


def test_all_writes_end_before_an_error_is_raised(spark, tmp_path):
    done = []

    def fails():
        raise RuntimeError("boom")

    with pytest.raises(RuntimeError):
        sinks.write_together(fails, lambda: done.append(spark.range(3).count()))
    assert done == [3]


def test_landed_text_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "LANDED_ROWS", 100)
    made = {
        "customer": "id AS c_custkey, 'n' AS c_name, 'A' AS c_mktsegment, id AS c_nationkey",
        "orders": "id AS o_orderkey, id AS o_custkey, date '2000-01-01' AS o_orderdate, 'F' AS o_orderstatus,"
        " 1.5D AS o_totalprice, 'p' AS o_orderpriority",
        "lineitem": "id AS l_orderkey, 1 AS l_linenumber, 1D AS l_extendedprice, 1D AS l_quantity,"
        " date '2000-02-01' AS l_shipdate",
        "events": "id AS event_id, id AS user_id, 'purchase' AS event_type, timestamp '2000-01-01' AS ts,"
        " 1D AS value, '{\"k\": 1}' AS props",
    }
    for name, columns in made.items():
        spark.range(0, 1000, 1, 1).selectExpr(columns.split(", ")[0], *columns.split(", ")[1:]).write.parquet(
            str(tmp_path / f"{name}.parquet")
        )
    layout = jobs.Layout(str(tmp_path / "lake"))
    queries.land_raw(spark, str(tmp_path), layout)
    for name in ("historical_member_policy", "claims", "revenue", "violations", "members_current", "events"):
        assert len(list((tmp_path / "lake" / "bronze" / name).glob("part-*"))) == 10 + (name == "members_current")
    assert sources.read_csv(spark, layout.raw("claims"), schemas.CLAIMS).count() == 1000
    assert sources.read_csv(spark, layout.raw("claims_adjustments"), schemas.CLAIMS_ADJUSTMENTS).count() == 1000
    assert sources.read_events(spark, layout.raw("events")).count() == 1000
