import json

import pytest

from silverthread import schemas
from silverthread.operators import events as E
from silverthread.sources import parse_events, read_events

PAYLOADS = {
    ("CLAIMS", "v2"): {
        "claim": {"id": "C1", "amount": 10.5, "diagnosis_codes": ["A", "B"]},
        "provider": {"id": "P1"},
    },
    ("CLAIMS", "v1"): {"claim_id": "C2", "claim_amount": "12.5", "provider_id": "P2"},
    ("BILLING", "v2"): {"payment": {"amount": "3", "methods": ["CARD"]}},
    ("BILLING", "v1"): {"payment_amount": 4},
    ("POLICY", "v2"): {
        "policy": {"id": "Y1", "coverage": {"start_date": "2024-01-01", "end_date": "2025-01-01"}}
    },
    ("POLICY", "v1"): {"policy_id": "Y2"},
    ("MEMBER", "v2"): {
        "profile": {"first_name": "A", "last_name": "B", "email": "e", "address": {"city": "c"}}
    },
    ("MEMBER", "v1"): {"first_name": "D", "last_name": "E", "email": "f", "city": "g"},
}


def event(category, version, payload="default", event_id="E1", member_id="M1"):
    if payload == "default":
        payload = PAYLOADS[category, version]
    return {
        "event_id": event_id,
        "event_timestamp": "2024-01-01 00:00:00",
        "member_id": member_id,
        "event_category": category,
        "schema_version": version,
        "payload": payload,
    }


@pytest.fixture
def parsed(spark):
    def parse(*documents):
        texts = [(d if isinstance(d, str) else json.dumps(d),) for d in documents]
        return parse_events(spark.createDataFrame(texts, "doc string"), "doc")

    return parse


def test_every_domain_and_version(parsed, rows):
    events = parsed(*[event(*shape) for shape in PAYLOADS])
    wide = E.normalize_all(events)
    data = {d.category: rows(E.valid_rows(wide, d), *d.columns) for d in E.DOMAINS}
    assert data == {
        "CLAIMS": [("C1", 10.5, "P1", "A"), ("C1", 10.5, "P1", "B"), ("C2", 12.5, "P2", None)],
        "BILLING": [(3.0, "CARD"), (4.0, None)],
        "POLICY": [("Y1", "2024-01-01", "2025-01-01"), ("Y2", None, None)],
        "MEMBER": [("A", "B", "e", "c"), ("D", "E", "f", "g")],
    }
    assert E.rejected_events(wide).count() == 0
    for domain in E.DOMAINS:
        assert rows(E.normalize(events, domain), *domain.columns) == data[domain.category]
        assert E.normalize(events, domain).columns == domain.output


def test_v1_alone_needs_no_v2_fields(parsed, rows):
    events = parsed(event("CLAIMS", "v1"))
    assert rows(E.normalize(events, E.CLAIMS), "claim_id") == [("C2",)]


def test_empty_and_missing_arrays(parsed, rows):
    def claim(codes, name):
        body = {"claim": {"id": name, "amount": 1, **codes}, "provider": {"id": "P"}}
        return event("CLAIMS", "v2", body)

    events = parsed(
        claim({"diagnosis_codes": []}, "empty"),
        claim({"diagnosis_codes": None}, "null"),
        claim({}, "none"),
        claim({"diagnosis_codes": [None]}, "null element"),
    )
    assert rows(E.normalize(events, E.CLAIMS), "claim_id") == [("null element",)]
    kept = E.normalize(events, E.CLAIMS, keep_empty=True)
    assert kept.count() == 4 and kept.filter("diagnosis_code IS NULL").count() == 4
    assert E.normalize_all(events, keep_empty=True).count() == 4


@pytest.mark.parametrize(
    "amount, good", [("abc", False), (0, False), (-1, False), ("12.5", True), (None, False)]
)
def test_amounts(parsed, amount, good):
    body = {"claim_id": "C", "claim_amount": amount, "provider_id": "P"}
    split = E.split_domain(parsed(event("CLAIMS", "v1", body)), E.CLAIMS)
    assert (split.valid.count(), split.rejected.count()) == ((1, 0) if good else (0, 1))


def test_quality_rules_of_each_domain(parsed):
    events = parsed(
        event("CLAIMS", "v1", {"claim_amount": 1, "provider_id": "P"}),
        event("CLAIMS", "v1", {"claim_amount": 1, "claim_id": "C"}),
        event("BILLING", "v1", {}),
        event("POLICY", "v1", {}),
        event("MEMBER", "v1", {"first_name": "A"}),
        event("MEMBER", "v1", {"last_name": "B"}),
        event("MEMBER", "v1", {"last_name": "B"}),
    )
    wide = E.normalize_all(events)
    assert wide.filter("outcome = 'bad'").count() == 7
    assert {d.category: E.bad_rows(wide, d).count() for d in E.DOMAINS} == {
        "CLAIMS": 2,
        "BILLING": 1,
        "POLICY": 1,
        "MEMBER": 2,
    }


def test_rejects_name_their_reason(parsed, rows):
    wide = E.normalize_all(
        parsed(
            event("CLAIMS", "v1", event_id=None),
            event("CLAIMS", "v2", member_id=None),
            event("CLAIMS", "v1", payload=None),
            event("OTHER", "v1", {}),
            event("CLAIMS", "v3", {}),
            event(None, "v1", {}),
            event("CLAIMS", None, {}),
            '{"event_id": broken',
        )
    )
    rejected = E.rejected_events(wide)
    assert sorted(r[0] for r in rejected.select("reject_reason").collect()) == [
        "event_id_missing",
        "malformed",
        "member_id_missing",
        "payload_missing",
        *["unknown_category_or_version"] * 4,
    ]
    assert wide.count() == 8
    texts = {r["reject_reason"]: r["raw_event"] for r in rejected.collect()}
    assert texts["malformed"] == '{"event_id": broken'
    assert json.loads(texts["member_id_missing"])["payload"]["claim"]["id"] == "C1"


def test_files_of_lines_arrays_and_documents(spark, tmp_path):
    one, two = event("POLICY", "v1"), event("MEMBER", "v1", event_id="E2")
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "a.json").write_text(json.dumps(one) + "\n" + json.dumps([one, two]) + "\nnot json\n")
    found = read_events(spark, str(lines)).collect()
    assert [r[schemas.MALFORMED] for r in found if r["event_id"] is None] == ["not json"]
    assert sorted(r["event_id"] or "" for r in found) == ["", "E1", "E1", "E2"]
    whole = tmp_path / "whole"
    whole.mkdir()
    (whole / "b.json").write_text(json.dumps([one, two], indent=2))
    assert read_events(spark, str(whole), multiline=True).count() == 2
