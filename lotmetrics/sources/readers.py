"""Readers of public statistics formats; nested payloads are taken apart by SQL functions on the executors."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys

SEPARATORS = (";", ",", "\t", "|")


def whole(spark: SparkSession, path: str) -> DataFrame:
    """One row a file: its text as `value`."""
    return spark.read.text(path, wholetext=True)


def or_fail(value: Column, text: str) -> Column:
    return F.coalesce(value, F.raise_error(F.lit(text)))


def statistics_json(spark: SparkSession, path: str, indicator: str) -> DataFrame:
    """Records by period label: one row a record, with period, place, value and the map of extra dimensions.

    Records of unreadable periods are left out; a payload without data is an error.
    """
    blocks = F.from_json("value", "array<struct<Dados: map<string, array<map<string, string>>>>>")
    block = F.get(F.filter(blocks, lambda b: b["Dados"].isNotNull()), 0)["Dados"]
    rows = whole(spark, path).select(F.explode(or_fail(block, f"no data block for {indicator}")).alias("raw", "records"))
    rows = rows.select(keys.period(F.col("raw")).alias("p"), F.explode("records").alias("r")).where("p is not null")
    place = F.trim(F.coalesce(F.col("r.geocod"), F.lit("")))
    return rows.select(
        F.lit(indicator).alias("indicator"), F.col("p.label").alias("period"), F.col("p.kind").alias("period_kind"), F.col("p.sort_key").alias("sort_key"), place.alias("geocod"),
        F.col("r.geodsg").alias("geoname"), keys.level(place).alias("level"), keys.municipality(place).alias("municipality"), keys.number(F.col("r.valor")).alias("value"),
        F.map_filter("r", lambda k, _: k.rlike(r"^dim_\d+(_t)?$")).alias("dims"),
    )


def quarter_label(c: Column) -> Column:
    return F.replace(c, F.lit("-Q"), F.lit("Q"))


def sdmx_csv(spark: SparkSession, path: str) -> DataFrame:
    """period and value of the observations that have one."""
    rows = spark.read.csv(path, header=True)
    return rows.select(quarter_label(F.col("TIME_PERIOD")).alias("period"), F.col("OBS_VALUE").try_cast("double").alias("value")).where("value is not null")


def json_stat(spark: SparkSession, path: str, panel: str | None = None) -> DataFrame:
    """JSON-stat 2.0 to (panel,) period and value; every other dimension must have one category.

    Category indexes and values may be lists or objects.
    """
    schema = "id array<string>, size array<int>, value string, dimension map<string, struct<category: struct<index: string>>>"
    js = whole(spark, path).select(F.from_json("value", schema).alias("j")).select("j.*")
    kept = ["time"] if panel is None else [panel, "time"]
    wide = F.exists(F.arrays_zip("id", "size"), lambda d: ~d["id"].isin(kept) & (d["size"] != 1))
    js = js.withColumn("id", F.when(wide, F.raise_error(F.lit("JSON-stat with dimensions that are not filtered")).cast("array<string>")).otherwise(F.col("id")))
    listed = F.from_json("value", "array<double>")
    by_place = F.when(F.col("value").startswith("{"), F.from_json("value", "map<string, double>")).otherwise(
        F.map_from_arrays(F.transform(listed, lambda _, i: i.cast("string")), listed)
    )
    rows = js.select("id", "size", "dimension", F.explode(by_place).alias("at", "value")).where("value is not null")

    def label(dim: str) -> Column:
        index = F.col("dimension")[dim]["category"]["index"]
        names = F.transform(
            F.array_sort(F.transform(F.map_entries(F.from_json(index, "map<string, int>")), lambda e: F.struct(e["value"].alias("at"), e["key"].alias("name")))), lambda e: e["name"]
        )
        names = F.when(index.startswith("["), F.from_json(index, "array<string>")).otherwise(names)
        i = F.array_position("id", dim).cast("int")
        stride = F.aggregate(F.slice("size", i + 1, F.size("size")), F.lit(1), lambda a, b: a * b)
        return F.get(names, F.pmod(F.floor(F.col("at").cast("int") / stride), F.element_at("size", i)).cast("int"))

    places = [] if panel is None else [label(panel).alias(panel)]
    return rows.select(*places, quarter_label(label("time")).alias("period"), "value")


def sniffed_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, by the separator that its first line holds most often."""
    first = spark.read.text(path).first()
    line = first["value"] if first else ""
    return spark.read.csv(path, header=True, sep=max(SEPARATORS, key=line.count))


def geojson(spark: SparkSession, path: str) -> DataFrame:
    """properties (map) and rings (all rings of a polygon or multipolygon, as lists of x, y)."""
    schema = "features array<struct<properties: map<string, string>, geometry: struct<type: string, coordinates: string>>>"
    rows = whole(spark, path).select(F.explode(F.from_json("value", schema)["features"]).alias("f"))
    at, kind = F.col("f.geometry.coordinates"), F.col("f.geometry.type")
    one, many = F.from_json(at, "array<array<array<double>>>"), F.from_json(at, "array<array<array<array<double>>>>")
    return rows.select(F.col("f.properties").alias("properties"), F.when(kind == "Polygon", one).when(kind == "MultiPolygon", F.flatten(many)).alias("rings"))
