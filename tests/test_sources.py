import json

import pytest
from pyspark.sql import functions as F

from lotmetrics.sources import readers, writers


def put(tmp_path, name, text):
    (tmp_path / name).write_text(text if isinstance(text, str) else json.dumps(text))
    return f"file://{tmp_path / name}"


def test_statistics_json(spark, tmp_path):
    records = [{"geocod": "9990102", "geodsg": "Vale Verde", "valor": "7.654,25", "dim_5": "Q", "other": 1}, {"geocod": "PT", "geodsg": "todo", "valor": ".."}]
    path = put(tmp_path, "a.json", [{"Sucesso": {}}, {"Dados": {"3.º Trimestre de 2031": records, "sem data": records}}])
    rows = readers.statistics_json(spark, path, "7").orderBy("geocod").collect()
    assert [(r["period"], r["level"], r["municipality"], r["value"], r["dims"]) for r in rows] == [("2031Q3", "municipality", "0102", 7654.25, {"dim_5": "Q"}), ("2031Q3", "national", None, None, {})]
    with pytest.raises(Exception, match="no data block"):
        readers.statistics_json(spark, put(tmp_path, "b.json", [{"Sucesso": {}}]), "7").collect()


def test_json_stat(spark, tmp_path):
    js = {"id": ["unit", "geo", "time"], "size": [1, 2, 3], "value": {"0": 1, "2": 3.5, "4": 5}, "dimension": {"unit": {"category": {"index": ["x"]}}, "geo": {"category": {"index": {"ZB": 1, "ZA": 0}}}, "time": {"category": {"index": ["2020-Q1", "2020-Q2", "2020-Q3"]}}}}
    want = [("ZA", "2020Q1", 1.0), ("ZA", "2020Q3", 3.5), ("ZB", "2020Q2", 5.0)]
    assert sorted(map(tuple, readers.json_stat(spark, put(tmp_path, "m.json", js), "geo").collect())) == want
    js["value"] = [1, None, 3.5, None, 5, None]
    path = put(tmp_path, "l.json", js)
    assert sorted(map(tuple, readers.json_stat(spark, path, "geo").collect())) == want
    with pytest.raises(Exception, match="not filtered"):
        readers.json_stat(spark, path).collect()


def test_csv(spark, tmp_path):
    assert [tuple(r) for r in readers.sdmx_csv(spark, put(tmp_path, "s.csv", "TIME_PERIOD,OBS_VALUE\n2020-Q1,1.5\n2020-Q2,\n")).collect()] == [("2020Q1", 1.5)]
    assert readers.sniffed_csv(spark, put(tmp_path, "c.csv", "a;b\n1,5;2\n")).first()["a"] == "1,5"


def test_geojson(spark, tmp_path):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    js = {"features": [{"properties": {"id": 1}, "geometry": {"type": "Polygon", "coordinates": [ring]}}, {"properties": {"id": 2}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}}]}
    rows = readers.geojson(spark, put(tmp_path, "g.json", js)).collect()
    assert [(r["properties"]["id"], len(r["rings"])) for r in rows] == [("1", 1), ("2", 2)] and rows[0]["rings"][0][1] == [1.0, 0.0]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a<b", "u1", None, 1), ("c", "u2", "x & y", 2)], "title string, link string, description string, k int")
    writers.compact_json(df.select("title", "description").where("k = 1"), f"file://{tmp_path}/out")
    assert [r["value"] for r in spark.read.text(f"file://{tmp_path}/out").collect()] == ['{"title":"a<b"}']
    feed = writers.rss(df.withColumn("published", F.timestamp_seconds(F.col("k") * 86400)), "T & t", "http://x").first()["value"]
    assert feed.index("u2") < feed.index("u1") and "a&lt;b" in feed and "x &amp; y" in feed and feed.endswith("</rss>")
