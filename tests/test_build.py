import json

import pytest
from pyspark.sql import functions as F

from lotmetrics.plans import build
from lotmetrics.sources import published


def test_build(spark, tmp_path):
    out = f"file://{tmp_path}"
    status = build.build(spark, "/root/testdata/sf0.01", out)
    assert set(status.values()) == {"ok"}, status
    assert set(status) == {"municipalities", "series", "history", "national", "changes", "outlook", "parishes", "map"}
    store = published.Store(spark, out)
    rows = [json.loads(r["value"]) for r in spark.read.text(f"{out}/json/00000001/municipalities").collect()]
    assert len(rows) == 25 and {"price", "score_overall", "band"} <= set(rows[0])
    assert store.read("series").first()["series"][0]["period"] == "1995Q1"
    assert {len(r["forecasts"]) for r in store.read("outlook").collect()} == {3}
    assert json.loads(store.read("map").first()["value"])["geometry"]["type"] == "Polygon"
    assert {r["part"]: r["status"] for r in store.read("meta").collect()} == status


def numbers(df):
    return sorted(r["id"] for r in df.collect())


def test_readers_see_the_last_whole_build(spark, tmp_path, monkeypatch):
    store = published.Store(spark, f"file://{tmp_path}/a b")
    with pytest.raises(KeyError):
        store.read("x")
    two = {"x": lambda: spark.range(3), "y": lambda: spark.range(5)}
    assert store.publish(two) == {"x": "ok", "y": "ok"}
    # a product that fails in the middle of its rows, and one that is too short, keep their last version
    bad = F.when(F.col("id") < 900, F.col("id")).otherwise(F.raise_error("row 900").cast("long"))
    got = store.publish({"x": lambda: spark.range(0, 1000, 1, 4).select(bad.alias("id")), "y": lambda: spark.range(1), "z": lambda: 1 / 0}, {"y": 2})
    assert got["x"].startswith("CACHE") and "too few" in got["y"] and got["z"].startswith("ERRO")
    assert numbers(store.read("x")) == [0, 1, 2] and store.read("y").count() == 5 and "z" not in store.manifest()["tables"]

    # a crash after everything is written and before the switch
    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(store, "switch", crash)
        with pytest.raises(RuntimeError):
            store.publish({"x": lambda: spark.range(10, 12), "y": lambda: spark.range(1)})
    assert store.manifest()["number"] == 2 and numbers(store.read("x")) == [0, 1, 2] and store.read("y").count() == 5
    store.publish({"x": lambda: spark.range(10, 12)})
    assert numbers(store.read("x")) == [10, 11] and numbers(store.read("x", 1)) == [0, 1, 2] and store.read("y").count() == 5
    # a writer that began from an older build
    with pytest.raises(FileExistsError):
        store.switch({"number": 2}, {})
    assert store.manifest()["number"] == 3
    assert store.prune(1) > 0
    assert numbers(store.read("x")) == [10, 11] and store.read("y").count() == 5 and store.manifests() == [3]
    assert store.prune(1) == 0


def test_archive_grows_by_new_keys_only(spark, tmp_path):
    store = published.Store(spark, f"file://{tmp_path}")
    rows = lambda *v: spark.createDataFrame(v, "kind string, vintage string, place long, mid double")
    keys = ["kind", "vintage"]
    assert store.append("archive", rows(("sales", "v1", 1, 1.0), ("sales", "v1", 2, 2.0)), keys) == 2
    first = store.manifest()["tables"]["archive"]["parts"]
    assert store.append("archive", rows(("sales", "v1", 1, 9.0), ("rent", "v1", 1, 3.0)), keys) == 1
    assert store.append("archive", rows(("rent", "v1", 7, 9.0)), keys) == 0
    entry = store.manifest()["tables"]["archive"]
    assert entry["parts"][:1] == first and len(entry["parts"]) == 2 and entry["rows"] == 3 and store.manifest()["number"] == 2
    assert sorted(map(tuple, store.read("archive").collect())) == [("rent", "v1", 1, 3.0), ("sales", "v1", 1, 1.0), ("sales", "v1", 2, 2.0)]


def test_parts_are_merged(spark):
    places = spark.createDataFrame([(1, 2)], "place int, v int")
    with pytest.raises(ValueError, match="twice"):
        build.merged(places, places)
    assert build.merged(places, None).columns == ["place", "v"]
