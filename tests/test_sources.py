import os

import pytest
from pyspark.sql import functions as F

from flowtables.operators.attributes import encode_attributes
from flowtables.sources import capture, flows
from flowtables.sources.workdir import work_dir
from flowtables.streaming.transfer import FLOW_SCHEMA, transfer_stream


def some_flows(spark, n=20):
    rows = [(i, {"filename": f"f{i}", "lang": "en"}, b"\x00\xff" * i, 2 * i) for i in range(n)]
    return spark.createDataFrame(rows, "flow_id long, attributes map<string,string>, content binary, size long")


def test_flows_from_table_leaves_out_null_attributes(spark):
    df = spark.createDataFrame([(1, "é", None), (2, "", "x")], "id long, text string, a string")
    rows = flows.flows_from_table(df, "id", F.encode("text", "UTF-8"), {"a": F.col("a"), "n": F.lit(5)}).collect()
    assert [(r["flow_id"], r["attributes"], bytes(r["content"]), r["size"]) for r in rows] == [
        (1, {"n": "5"}, "é".encode(), 2), (2, {"a": "x", "n": "5"}, b"", 0),
    ]


def test_files_become_flows(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a +.bin").write_bytes(b"one")
    (tmp_path / "sub" / "b.bin").write_bytes(b"")
    rows = {r["attributes"]["filename"]: r for r in flows.read_flows(spark, str(tmp_path)).collect()}
    assert (bytes(rows["a +.bin"]["content"]), rows["a +.bin"]["size"], rows["b.bin"]["size"]) == (b"one", 3, 0)
    assert rows["b.bin"]["attributes"]["path"].endswith("/sub/")
    assert rows["a +.bin"]["flow_id"] != rows["b.bin"]["flow_id"]


def test_outcomes_are_stored_apart(spark, tmp_path):
    df = some_flows(spark).withColumn("outcome", F.when(F.col("flow_id") % 3 == 0, "failure").otherwise("success"))
    path = str(tmp_path / "out")
    flows.write_outcomes(df, path)
    assert {d for d in os.listdir(path) if d.startswith("outcome")} == {"outcome=failure", "outcome=success"}
    assert spark.read.parquet(path).filter("outcome = 'failure'").count() == 7


def test_outcomes_of_a_stream(spark, tmp_path):
    landing, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    some_flows(spark).write.parquet(landing)
    stream = spark.readStream.schema(FLOW_SCHEMA).parquet(landing).withColumn("outcome", F.lit("success"))
    for _ in range(2):
        flows.stream_outcomes(stream, out, checkpoint).awaitTermination()
    assert spark.read.parquet(out).groupBy("outcome").count().collect() == [("success", 20)]


@pytest.mark.parametrize("profile", ["v2", "v0", "legacy"])
def test_capture_files_round_trip(spark, tmp_path, profile):
    path = str(tmp_path / "cap")
    capture.write_capture(some_flows(spark).repartition(3), path, profile)
    assert all(n.endswith(".frames") and not n.startswith("_") for n in os.listdir(path))
    rows = capture.read_capture(spark, path, profile).collect()
    got = sorted((r["attributes"]["filename"], bytes(r["content"]), r["outcome"], r["truncated"]) for r in rows)
    assert got == sorted((f"f{i}", b"\x00\xff" * i, "success", False) for i in range(20))
    assert spark.read.format("flowcapture").option("profile", profile).option("output", "pieces").load(path).count() > 20


def test_capture_of_broken_files(spark, tmp_path):
    frame = bytes.fromhex("00000002" "0000000000000003") + b"{}abc"
    (tmp_path / "cut").write_bytes(frame + frame[:-1])
    (tmp_path / "empty").write_bytes(b"")
    (tmp_path / "neg").write_bytes(frame + b"\xff" * 30)
    (tmp_path / "bad").write_bytes(frame.replace(b"{}", b"[]") + frame)
    (tmp_path / "_hidden").write_bytes(frame)
    rows = {
        (os.path.basename(r["file"]), r["frame_no"]): (r["content"], r["reason"], r["truncated"])
        for r in capture.read_capture(spark, str(tmp_path)).collect()
    }
    assert rows == {
        ("cut", 0): (b"abc", None, False), ("cut", 1): (b"ab", None, True), ("empty", 0): (b"", None, True),
        ("neg", 0): (b"abc", None, False), ("neg", 1): (None, "bad_length", False),
        ("bad", 0): (None, "bad_header", False), ("bad", 1): (b"abc", None, False),
    }
    assert capture.read_capture(spark, str(tmp_path), max_blob_bytes=2).filter("reason = 'oversize'").count() == 4


def test_transfer_copies_every_flow_once(spark, tmp_path):
    landing, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    flows_df = some_flows(spark)
    flows_df.filter("flow_id < 12").repartition(5).write.parquet(landing)
    transfer_stream(spark, landing, out, checkpoint, max_files=2, names="lang").awaitTermination()
    flows_df.filter("flow_id >= 12").write.mode("append").parquet(landing)
    for _ in range(2):
        transfer_stream(spark, landing, out, checkpoint, max_files=2, names="lang").awaitTermination()
    rows = encode_attributes(spark.read.parquet(out)).collect()
    assert sorted((r["flow_id"], bytes(r["content"])) for r in rows) == [(i, b"\x00\xff" * i) for i in range(20)]
    assert {r["header_json"] for r in rows} == {'{"lang":"en"}'}


def test_work_dir_follows_the_session():
    class Session:
        def __init__(self, folder, master):
            self.conf = {"spark.checkpoint.dir": folder} if folder else {}
            self.sparkContext = type("Context", (), {"master": master})

    shared = Session("hdfs://shared/", "yarn")
    assert work_dir(shared, "x").startswith("hdfs://shared/x-")
    assert work_dir(shared, "x") != work_dir(shared, "x")
    assert work_dir(Session(None, "local[2]"), "x")
    with pytest.raises(RuntimeError):
        work_dir(Session(None, "yarn"), "x")
