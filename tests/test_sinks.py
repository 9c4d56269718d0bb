"""Reading sinks and keyed records."""

import glob
import json
import os

import pytest

from airlens.sinks.files import keyed_records, write_readings


def test_local_sink_writes_json_lines(spark, scratch):
    df = spark.createDataFrame([("Dublin", 8.2), ("Delhi", 120.5)], "city string, value double")
    out = os.path.join(scratch, "raw")
    assert write_readings(df.coalesce(1), "local", directory=out) == 2
    files = glob.glob(os.path.join(out, "*.json"))
    lines = [json.loads(l) for f in files for l in open(f) if l.strip()]
    assert sorted(l["city"] for l in lines) == ["Delhi", "Dublin"]


def test_empty_write_creates_no_file(spark, scratch):
    df = spark.createDataFrame([], "city string, value double")
    out = os.path.join(scratch, "raw")
    assert write_readings(df, "local", directory=out) == 0
    assert not os.path.exists(out)


def test_a_write_runs_its_plan_once(spark, scratch):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(20).mapInArrow(count, "id long")
    assert write_readings(df, "local", directory=os.path.join(scratch, "raw")) == 20
    assert seen.value == 20
    assert os.listdir(scratch) == ["raw"]              # nothing staged is left


def test_each_write_adds_files(spark, scratch):
    out = os.path.join(scratch, "raw")
    for v in (1, 2):
        write_readings(spark.createDataFrame([(v,)], "a int").coalesce(1), "local", directory=out)
    assert len(glob.glob(os.path.join(out, "*.json"))) == 2


def test_unknown_kind_raises(spark):
    with pytest.raises(ValueError, match="Unknown sink kind"):
        write_readings(spark.createDataFrame([(1,)], "a int"), "kinesis-ish", directory="/nowhere")


def test_keyed_record_key_rule(spark):
    df = spark.createDataFrame([("Dublin", 5), ("", 7), ("", 0), (None, None)],
                               "city string, location_id int")
    keys = [r.key for r in keyed_records(df).collect()]
    assert keys == ["Dublin", "7", "unknown", "unknown"]
    assert json.loads(keyed_records(df).first().value) == {"city": "Dublin", "location_id": 5}
