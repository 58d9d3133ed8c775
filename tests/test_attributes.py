import json

from pyspark.sql import Row
from pyspark.sql import functions as F

from flowtables.functions import headers
from flowtables.operators import attributes as attrs

FLOW = {
    "filename": "a.txt",
    "path": "./",
    "uuid": "u-1",
    "lang": "en",
    "source": "s1",
    "sources": "s2",
    "note": "",
    "empty": None,
}


def one(spark, attributes=FLOW):
    return spark.createDataFrame([(1, attributes)], "flow_id long, attributes map<string,string>")


def selected(spark, attributes=FLOW, **selection):
    return attrs.select_attributes(one(spark, attributes), **selection).first()["attributes"]


def test_all_attributes_by_default(spark):
    assert selected(spark) == FLOW


def test_core_attributes_can_be_left_out(spark):
    assert set(selected(spark, include_core=False)) == {"lang", "source", "sources", "note", "empty"}


def test_list_is_trimmed_and_missing_names_are_empty(spark):
    assert selected(spark, names=" lang,,note , absent") == {"lang": "en", "note": "", "absent": ""}


def test_missing_names_can_be_null_but_empty_values_stay(spark):
    assert selected(spark, names="note,absent", null_for_missing=True) == {"note": "", "absent": None}


def test_blank_list_is_no_list(spark):
    assert selected(spark, names="  ") == FLOW


def test_list_of_core_names_only_leaves_nothing(spark):
    assert selected(spark, names="uuid,path", include_core=False) == {}


def test_regex_matches_whole_names_and_keeps_core(spark):
    assert set(selected(spark, regex="source|uu.*", include_core=False)) == {"source", "uuid"}


def test_regex_alternatives_are_anchored_together(spark):
    assert set(selected(spark, regex="lang|sour")) == {"lang"}


def test_list_and_regex_are_united(spark):
    assert selected(spark, names="lang,absent", regex="l.*|note") == {"lang": "en", "absent": "", "note": ""}


def test_names_are_case_sensitive(spark):
    assert selected(spark, names="LANG") == {"LANG": ""}


def test_no_attributes_means_no_header(spark):
    row = attrs.encode_attributes(attrs.select_attributes(one(spark), include_attributes=False)).first()
    assert row["header_json"] is None and row["header_len"] == 0


def test_header_is_sorted_json_in_bytes(spark):
    row = attrs.encode_attributes(one(spark, {"b": "é\"\n", "a": None})).first()
    assert row["header_json"] == '{"a":null,"b":"é\\"\\n"}'
    assert row["header_len"] == len(row["header_json"].encode())


def test_typed_header(spark):
    values = {"n": "12", "f": "1.5", "t": "true", "o": '{"x":[1]}', "s": "plain", "z": "007", "q": 'say "hi"', "e": ""}
    row = attrs.encode_attributes(one(spark, values), typed=True).first()
    expected = {"n": 12, "f": 1.5, "t": True, "o": {"x": [1]}, "s": "plain", "z": "007", "q": 'say "hi"', "e": ""}
    assert json.loads(row["header_json"]) == expected
    assert list(json.loads(row["header_json"])) == sorted(expected)


def test_typed_header_keeps_names_selected_by_regex_as_text(spark):
    row = attrs.encode_attributes(one(spark, {"n": "12", "nn": "12", "x": None}), typed=True, text_regex="n|y").first()
    assert row["header_json"] == '{"n":"12","nn":12,"x":null}'


def test_typed_header_of_no_attributes(spark):
    row = attrs.encode_attributes(one(spark, {}), typed=True).first()
    assert row["header_json"] == "{}" and row["header_len"] == 2


def test_type_attributes(spark):
    typed = attrs.type_attributes(one(spark, {"n": "1e3", "s": "x"})).select(
        F.col("typed.n").alias("n"), F.col("typed.s").alias("s")
    )
    kinds = typed.select(headers.json_type(F.col("n")), headers.json_type(F.col("s"))).first()
    assert tuple(kinds) == ("number", "string")


def test_decode_quarantines_bad_headers(spark):
    texts = ['{"a":"b","n":null,"i":3}', "{}", '{"a":', "[1]", "null", "", None]
    df = spark.createDataFrame([Row(i=i, h=t) for i, t in enumerate(texts)], "i int, h string")
    rows = {r["i"]: r for r in attrs.decode_attributes(df, "h").collect()}
    assert rows[0]["attributes"] == {"a": "b", "n": "null", "i": "3"}
    assert rows[1]["attributes"] == {}
    assert [rows[i]["outcome"] for i in range(7)] == ["success"] * 2 + ["error"] * 4 + ["success"]


def test_header_round_trip(spark):
    df = attrs.encode_attributes(one(spark, {"k": "v", "ü": "\\ \t"}))
    assert attrs.decode_attributes(df, "header_json").first()["attributes"] == {"k": "v", "ü": "\\ \t"}


def test_endpoint_attributes(spark):
    df = one(spark, {"a": "b", "tcp.sender": "old"}).union(one(spark, {}))
    rows = attrs.add_endpoint_attributes(df, "1.1.1.1", "2.2.2.2", 99, local_ip="3.3.3.3").collect()
    assert rows[0]["attributes"] == {
        "a": "b", "tcp.sender": "1.1.1.1", "tcp.receiver": "2.2.2.2", "tcp.receiver_port": "99",
    }
    assert rows[1]["attributes"] == {}
    swapped = attrs.add_endpoint_attributes(df, "1.1.1.1", "2.2.2.2", 99, local_ip="3.3.3.3", compat=True).first()
    assert swapped["attributes"]["tcp.sender"] == "3.3.3.3"


def test_attributes_long(spark):
    rows = {(r["key"], r["value"]) for r in attrs.attributes_long(one(spark, {"a": "b", "c": None})).collect()}
    assert rows == {("a", "b"), ("c", None)}
