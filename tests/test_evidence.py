"""What a payload shows, against a model that walks the parsed JSON."""

from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import documents, flat_rows, page, record

from tidegate.functions.evidence import DEPTH, Shown
from tidegate.operators.contract import require_contract_schema
from tidegate.operators.flatten import flatten_table
from tidegate.errors import ContractError
from tidegate.plans.chapters import CHAPTERS
from tidegate.spec import Field, OrderBy, ProductSpec

COMMON = settings(
    deadline=None, derandomize=True, database=None, max_examples=25,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
NAMES = st.sampled_from(["a", "B", "Hid", "hID", "x.y", "é"])
VALUES = st.recursive(
    st.one_of(st.none(), st.booleans(), st.integers(-5, 5), st.just(12.5), st.sampled_from(["hid", "", "t"])),
    lambda inner: st.one_of(st.lists(inner, max_size=3), st.dictionaries(NAMES, inner, max_size=3)),
    max_leaves=12,
)


def modelled(value, shown, path=""):
    if isinstance(value, list):
        return [modelled(item, shown, path) for item in value]
    if not isinstance(value, dict):
        return value
    kept = {}
    for name, inner in value.items():
        below = f"{path}.{name.lower()}" if path else name.lower()
        if name.lower() in shown.names or below in shown.paths:
            continue
        if shown.only is not None and not any(
            below == p or below.startswith(p + ".") or p.startswith(below + ".") for p in shown.only
        ):
            continue
        kept[name] = modelled(inner, shown, below)
    return kept


RULES = [
    Shown.of(["HID"]),
    Shown.of([], ["a.b", "B"]),
    Shown.of(["hid"], ["a.a"], ["a", "b.a", "b.é"]),
    Shown.of(),
]


@settings(COMMON)
@given(values=st.lists(VALUES, min_size=1, max_size=4), rule=st.sampled_from(RULES))
def test_variants_equal_the_model(spark, values, rule):
    texts = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, t string")
    cleaned = texts.select("i", F.to_json(rule.variant(F.parse_json("t"))).alias("t")).collect()
    assert {r["i"]: json.loads(r["t"]) for r in cleaned} == {
        i: modelled(v, rule) for i, v in enumerate(values)
    }


def nested(value, levels):
    for _ in range(levels):
        value = {"a": value}
    return value


def test_below_the_depth_nothing_hidden_is_shown(spark):
    rule = Shown.of(["hid"])
    for inner in ({"Hid": "secret"}, {"k": [{"hiD": "secret"}]}, {"k": "fine"}):
        text = json.dumps(nested(inner, DEPTH + 2))
        frame = spark.createDataFrame([(text,)], "t string")
        found = frame.select(F.to_json(rule.variant(F.parse_json("t")))).first()[0]
        assert "secret" not in found
        assert ("fine" in found) == ("fine" in text)
    by_path = Shown.of([], ["a." * (DEPTH + 2) + "k"])
    found = frame.select(F.to_json(by_path.variant(F.parse_json("t")))).first()[0]
    assert "fine" not in found


SECRET = "a person"
TYPES = (
    "id bigint, Hid string, s struct<hid: string, k: string>, l array<struct<HID: string, k: string>>, "
    "m map<string, struct<hid: string, k: string>>, only_hidden struct<hid: string>, n map<int, array<string>>, "
    "none struct<k: string, hid: string>"
)


def test_typed_columns_lose_hidden_names_at_any_depth(spark):
    row = (1, SECRET, (SECRET, "k1"), [(SECRET, "k2"), None], {"HID": (SECRET, "x"), "p": (SECRET, "k3"), "q": None},
           (SECRET,), {1: ["k4"]}, None)
    table = spark.createDataFrame([row], TYPES).withColumn("v", F.parse_json(F.lit('{"hiD": "a person", "k": "k5"}')))
    spec = ProductSpec(
        fields=(Field("id", "id", "bigint"),), key=("id",), order=(OrderBy("id"),), contract=(("id", "bigint"),),
        forbidden_columns=("hid",), redact=("m.q", "l.nothing"), lineage={},
    )
    shown = json.loads(flatten_table(table, spec).first()["raw_payload"])
    assert shown == {
        "id": 1, "s": {"k": "k1"}, "l": [{"k": "k2"}, None], "m": {"p": {"k": "k3"}}, "only_hidden": None,
        "n": {"1": ["k4"]}, "none": None, "v": {"k": "k5"},
    }
    below = spec.with_changes(forbidden_columns=(), redact=("m.P.hid", "s.K"))
    shown = json.loads(flatten_table(table, below).first()["raw_payload"])
    assert shown["m"]["p"] == {"hid": None, "k": "k3"} and shown["m"]["HID"]["hid"] == SECRET
    assert shown["s"] == {"hid": SECRET}


def test_the_page_payload_is_the_whole_record(spark):
    bad = record(7, "CA-7", "CA", x="abc", Extra={"n": 12.50, "list": [1, {"mevr_rd": "Secret Person"}]})
    payload = flat_rows(spark, [page(bad)]).first()["raw_payload"]
    assert "Secret Person" not in payload
    shown = json.loads(payload)
    assert shown["attributes"]["Extra"] == {"n": 12.5, "list": [1, {}]}
    assert shown["attributes"]["OBJECTID"] == 7 and shown["geometry"]["x"] == "abc"


def test_payload_paths_limit_the_payload(spark):
    spec = CHAPTERS.with_changes(payload_paths=("attributes.Extra",))
    row = flat_rows(spark, [page(record(7, "CA-7", "CA", Extra={"n": 1}, Other=2))], spec).first()
    shown = json.loads(row["raw_payload"])
    assert shown["attributes"]["Extra"] == {"n": 1} and "Other" not in shown["attributes"]


def test_a_record_that_repeats_a_name_keeps_its_fields_as_evidence(spark):
    text = '{"features": [{"attributes": {"State": "CA", "State": "OR", "MEVR_RD": "Secret Person"}}]}'
    row = flat_rows(spark, [text]).first()
    assert row["state"] == "OR" and json.loads(row["raw_payload"])["attributes"]["State"] == "OR"
    assert "Secret" not in row["raw_payload"]


def test_hidden_names_are_refused_as_fields_and_in_contracts(spark):
    with pytest.raises(ValueError, match="forbidden"):
        CHAPTERS.with_changes(fields=(*CHAPTERS.fields, Field("contact", "attributes.mevr_rd")))
    with pytest.raises(ValueError, match="forbidden"):
        CHAPTERS.with_changes(payload_paths=("attributes.Mevr_Rd",))
    CHAPTERS.with_changes(payload_paths=("attributes.MEVR_RD",), redact=("Attributes.mevr_rd",))
    exposed = ProductSpec(
        fields=(Field("Secret", "s"),), key=("Secret",), order=(OrderBy("Secret"),), contract=(("Secret", "string"),)
    )
    object.__setattr__(exposed, "forbidden_columns", ("SECRET",))
    with pytest.raises(ContractError, match="forbidden"):
        require_contract_schema(spark.createDataFrame([("x",)], "Secret string"), exposed)


def test_records_are_taken_apart_whatever_they_hold(spark):
    from tidegate.sources import parse_documents

    text = '{"features": [ {"attributes": {"n": 12.50,  "big": 12345678901234567890123}} , null, 9]}'
    records = parse_documents(documents(spark, [text]), CHAPTERS).first()["records"]
    assert records == ['{"attributes":{"n":12.5,"big":12345678901234567890123}}', None, "9"]
