import json
from decimal import Decimal

from pyspark.sql import functions as F

from relaykit.operators import transform
from relaykit.registry import REGISTRY, TableSpec


def test_registry_basics():
    assert sorted(REGISTRY.names()) == sorted(["page_vidw", "element_click", "pay", "pay_result", "user_info"])
    for bad in ("invalid_table", "", None):
        assert not REGISTRY.is_valid(bad)
    assert REGISTRY.get("page_vidw").select_fields() == ["user_unique_id", "et", "refer_page_id", "page_id"]
    assert REGISTRY.get("user_info").event_name == "__profile_set"
    assert REGISTRY.get("pay").event_name == "pay"
    assert {"pay_result", "pay_type", "pay_amount"} <= set(REGISTRY.get("pay_result").param_fields)


def _payloads(spark, spec, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return transform.to_payloads(df, spec, 1000).collect()


def test_params_cases(spark):
    spec = REGISTRY.get("pay")
    schema = ("event_id long, dt string, user_unique_id string, et long, pay_type string, pay_amount decimal(10,2), "
              "package_type string, package_id string, package_name string, is_ai int")
    rows = [(1, "d", "user_00000001", None, None, None, None, None, None, None),
            (2, "d", "u1", 7, 'a"b', Decimal("12.50"), None, "p", "Pakét ✓", 1)]
    out = {r.event_id: r for r in _payloads(spark, spec, rows, schema)}
    assert out[1].params == '{"report_type":"poc_v1"}'
    assert out[1].local_time_ms == 1000
    assert out[2].params == '{"report_type":"poc_v1","pay_type":"a\\"b","pay_amount":12.50,"package_id":"p","package_name":"Pakét ✓","is_ai":1}'
    assert out[2].local_time_ms == 7
    body = json.loads(out[2].body)
    assert body == {"user": {"user_unique_id": "u1", "device_id": None, "web_id": None}, "header": {},
                    "events": [{"event": "pay", "params": out[2].params, "local_time_ms": 7}]}


def test_all_null_without_report_type(spark):
    spec = REGISTRY.get("user_info")
    schema = "event_id long, dt string, user_unique_id string, reg_time long, ys_dev_cnt int, user_add_day int"
    out = _payloads(spark, spec, [(1, "d", None, None, None, None)], schema)[0]
    assert out.params == "{}"
    assert out.local_time_ms == 1000  # no et: processing time
    assert json.loads(out.body)["user"]["user_unique_id"] is None


def test_custom_table_registration(spark):
    spec = TableSpec("my_table", "my_event", ("a",), "SINGLE", False, False)
    df = spark.createDataFrame([(1, "d", "uid", "x")], "event_id long, dt string, user_unique_id string, a string")
    r = transform.to_payloads(df, spec, 5).first()
    assert json.loads(r.body)["events"][0] == {"event": "my_event", "params": '{"a":"x"}', "local_time_ms": 5}


def test_reject_marks_errors(spark):
    spec = REGISTRY.get("element_click")
    df = spark.createDataFrame([(1, "d", "short", 3, "t", "p", "n", None)],
                               "event_id long, dt string, user_unique_id string, et long, click_type string, "
                               "click_position string, click_name string, click_area string")
    r = transform.to_payloads(df, spec, 5, reject_if=F.length("user_unique_id") < 8).first()
    assert r.error == "Transform failed"
