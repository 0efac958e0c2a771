import pytest
from pyspark.sql import functions as F

from relaykit.functions import jsonfn, masking
from relaykit.functions.coercion import event_time_ms, to_long
from relaykit.operators import status_log as sl
from relaykit.registry import parse_mode


def one_col(spark, values, t="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {t}")


def test_mask_user_id(spark):
    cases = {"user123456789": "user***6789", "short": "***", None: "***", "": "***",
             "12345678": "***", "123456789": "1234***6789"}
    df = one_col(spark, list(cases)).select("v", masking.mask_user_id(F.col("v")).alias("m"))
    assert {r.v: r.m for r in df.collect()} == cases


def test_mask_json(spark):
    cases = {
        '{"username":"user","password":"secret123"}': '{"username":"user","password":"***"}',
        '{"appKey":"abc123xyz","data":"value"}': '{"appKey":"***","data":"value"}',
        '{"password":"pass","token":"tok","apiKey":"key"}': '{"password":"***","token":"***","apiKey":"***"}',
        '{"secret" : "s", "api_key":"k", "n": 1}': '{"secret" : "***", "api_key":"***", "n": 1}',
        '{"Password":"x","token":5}': '{"Password":"x","token":5}',
        "": "",
        None: None,
    }
    df = one_col(spark, list(cases)).select("v", masking.mask_json(F.col("v")).alias("m"))
    assert {r.v: r.m for r in df.collect()} == cases


def test_mask_url(spark):
    cases = {
        "https://api.example.com/endpoint?key=secret123&other=value": "https://api.example.com/endpoint?***",
        "https://api.example.com/endpoint?foo=bar&baz=qux": "https://api.example.com/endpoint?foo=bar&baz=qux",
        "https://api.example.com/endpoint": "https://api.example.com/endpoint",
        "https://a/monkey=1?x=2": "https://a/monkey=1?***",
        None: None,
        "": "",
    }
    df = one_col(spark, list(cases)).select("v", masking.mask_url(F.col("v")).alias("m"))
    assert {r.v: r.m for r in df.collect()} == cases


def test_long_coercion_text(spark):
    cases = {"12": 12, "+7": 7, "-3": -3, " 12 ": None, "1.9": None, "abc": None,
             "99999999999999999999": None, None: None}
    df = one_col(spark, list(cases)).select("v", to_long(F.col("v")).alias("n"))
    assert {r.v: r.n for r in df.collect()} == cases


def test_long_coercion_numeric(spark):
    df = spark.createDataFrame([(1.9,), (-1.9,), (None,)], "v double")
    out = [r.n for r in df.select(to_long(F.col("v"), df.schema["v"].dataType).alias("n")).collect()]
    assert out == [1, -1, None]


def test_event_time(spark):
    df = spark.createDataFrame([("5",), (None,), ("x",)], "et string")
    got = [r.t for r in df.select(event_time_ms(F.col("et"), 99).alias("t")).collect()]
    assert got == [5, 99, 99]
    assert df.select(event_time_ms(None, 99).alias("t")).first().t == 99


def test_mode_parse(spark):
    cases = {"single": "SINGLE", " SINGLE ": "SINGLE", "BATCH": "BATCH", "": "BATCH", None: "BATCH", "x": "BATCH"}
    df = one_col(spark, list(cases)).select("v", parse_mode(F.col("v")).alias("m"))
    assert {r.v: r.m for r in df.collect()} == cases


def test_status_decode(spark):
    df = spark.createDataFrame([(c,) for c in (0, 1, 2, 3, 4, -1, 999)], "code int")
    d = {r.code: (r.description, r.is_valid) for r in sl.decode_status(df, "code", sl.status_dim(spark)).collect()}
    assert d[0] == ("Pending", True) and d[3] == ("Failed", True)
    assert d[4] == (None, False) and d[-1] == (None, False) and d[999] == (None, False)
    ok = spark.createDataFrame([(2,)], "code int").select(sl.decode_status_strict(F.col("code")).alias("d"))
    assert ok.first().d == "Success"
    bad = spark.createDataFrame([(999,)], "code int").select(sl.decode_status_strict(F.col("code")).alias("d"))
    with pytest.raises(Exception, match="Unknown status code"):
        bad.collect()


def test_json_helpers(spark):
    df = spark.createDataFrame([("test", 123)], "name string, value int")
    j = df.select(jsonfn.record_json("name", "value").alias("j")).first().j
    assert j == '{"name":"test","value":123}'
    nul = spark.createDataFrame([(None, 1)], "name string, value int")
    assert nul.select(jsonfn.record_json("name", "value").alias("j")).first().j == '{"name":null,"value":1}'
    pretty = df.select(jsonfn.pretty_json(F.struct("name", "value")).alias("p")).first().p
    assert "\n" in pretty
    m = spark.createDataFrame([({"key1": "value1", "key2": "42"},), ({},), (None,)], "m map<string,string>")
    got = [r.j for r in m.select(jsonfn.map_json(F.col("m")).alias("j")).collect()]
    assert got[0] == '{"key1":"value1","key2":"42"}' and got[1] == "{}" and got[2] == "{}"
    txt = spark.createDataFrame([('{"name":"test","value":123,"extra":1}',), (None,), ("",), ("invalid json",)], "t string")
    parsed = txt.select(jsonfn.parse_typed(F.col("t"), "name string, value int").alias("p")).collect()
    assert parsed[0].p.name == "test" and parsed[0].p.value == 123
    assert parsed[1].p is None and parsed[2].p is None
    assert parsed[3].p.name is None  # permissive: malformed → nulls
    strict = txt.where(F.col("t") == "invalid json").select(jsonfn.parse_typed(F.col("t"), "name string", strict=True).alias("p"))
    with pytest.raises(Exception):
        strict.collect()
