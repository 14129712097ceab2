import json
import os

from triploom.operators.output import scalar_text, to_json_rows, write_json


def test_json_rows_and_text(spark, workdir):
    df = spark.createDataFrame([("EUROPE", 317.4), ("ASIA", 344.8)],
                               "region string, weekly_avg_trips double")
    rows = [json.loads(r.json) for r in to_json_rows(df).collect()]
    assert rows == [{"region": "EUROPE", "weekly_avg_trips": 317.4},
                    {"region": "ASIA", "weekly_avg_trips": 344.8}]
    one = spark.createDataFrame([(0.0,)], "weekly_avg_trips_bb double")
    assert scalar_text(one, "weekly_avg_trips_bb").first()[0] == "0.0"
    out = os.path.join(workdir, "json")
    write_json(df, out)
    back = sorted((r.region, r.weekly_avg_trips) for r in spark.read.json(out).collect())
    assert back == [("ASIA", 344.8), ("EUROPE", 317.4)]
