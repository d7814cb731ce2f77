"""Published outputs: series by place, feed items, features with properties, cleaned values."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import keys
from .writers import escaped

#: Names of the bands in feeds.
BANDS = {"green": "verde", "amber": "amarela", "red": "vermelha"}


def clean(c: Column, digits: int = 4) -> Column:
    """Rounded, null where not a finite number."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), F.round(c, digits))


def cleaned(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.select(*[clean(F.col(c), digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def series_by_place(df: DataFrame, kind: str, digits: int = 4) -> DataFrame:
    """place and its series: array of struct<period, value> in order. A place's series is as long as its calendar."""
    rows = df.where("value is not null").select("place", "idx", F.struct(keys.index_label(F.col("idx"), kind).alias("period"), F.round("value", digits).alias("value")).alias("x"))
    return rows.groupBy("place").agg(F.transform(F.sort_array(F.collect_list(F.struct("idx", "x"))), lambda r: r["x"]).alias("series"))


def percent(x: Column) -> Column:
    """+1,2%."""
    return F.replace(F.format_string("%+.1f%%", x * 100), F.lit("."), F.lit(","))


def euros(x: Column) -> Column:
    """1 234 €."""
    return F.concat(F.replace(F.format_number(x, 0), F.lit(","), F.lit(" ")), F.lit(" €"))


def quarter_text(label: Column) -> Column:
    return F.replace(label, F.lit("Q"), F.lit("T"))


def price_items(prices: DataFrame, most: int = 8) -> DataFrame:
    """place, key, guid, title, description: the newest quarters of each place but its first one. prices: place, name, idx, value."""
    w = W.partitionBy("place").orderBy("idx")
    rows = prices.withColumns({"_b": F.lag("value").over(w), "_y": F.max("value").over(w.rangeBetween(-4, -4)), "_k": F.row_number().over(W.partitionBy("place").orderBy(F.desc("idx"))), "_first": F.row_number().over(w) == 1})
    rows = rows.where((F.col("_k") <= most) & ~F.col("_first"))
    key = keys.index_label(F.col("idx"), "quarter")
    step = lambda before, text: F.coalesce(F.concat(F.lit(", "), percent(F.try_divide(F.col("value"), F.col(before)) - 1), F.lit(f" {text}")), F.lit(""))
    text = F.concat(F.lit("Preço mediano das vendas, "), quarter_text(key), F.lit(": "), euros(F.col("value")), F.lit("/m²"), step("_b", "no trimestre"), step("_y", "num ano"), F.lit("."))
    return rows.select("place", key.alias("key"), F.concat(F.col("place").cast("string"), F.lit("-preco-"), key).alias("guid"), F.concat(F.col("name"), F.lit(": preço mediano de venda "), quarter_text(key)).alias("title"), text.alias("description"))


def rent_items(rents: DataFrame, most: int = 3) -> DataFrame:
    """The newest years of each place but its first one. rents: place, name, idx (year), value."""
    w = W.partitionBy("place").orderBy("idx")
    rows = rents.withColumns({"_b": F.lag("value").over(w), "_k": F.row_number().over(W.partitionBy("place").orderBy(F.desc("idx")))}).where((F.col("_k") <= most) & F.col("_b").isNotNull())
    year = F.col("idx").cast("string")
    text = F.concat(F.lit("Renda mediana dos novos contratos, "), year, F.lit(": "), F.replace(F.format_string("%.2f", F.col("value")), F.lit("."), F.lit(",")), F.lit(" €/m² ("), percent(F.try_divide(F.col("value"), F.col("_b")) - 1), F.lit(" num ano)."))
    return rows.select("place", F.concat(year, F.lit("Q4")).alias("key"), F.concat(F.col("place").cast("string"), F.lit("-renda-"), year).alias("guid"), F.concat(F.col("name"), F.lit(": renda mediana "), year).alias("title"), text.alias("description"))


def band_items(changes: DataFrame, period: str) -> DataFrame:
    """Places whose band changed. changes: place, name, score, score_prev, band, band_prev."""
    named = lambda c: F.coalesce(*[F.when(F.col(c) == k, F.lit(v)) for k, v in BANDS.items()], F.col(c))
    text = F.concat(F.lit(f"Com os preços de {period.replace('Q', 'T')}, o score passou de "), F.format_string("%.0f", F.col("score_prev")), F.lit(" para "), F.format_string("%.0f", F.col("score")), F.lit(" (faixa "), named("band_prev"), F.lit(" → "), named("band"), F.lit(")."))
    return changes.where("band <> band_prev").select("place", F.lit(period).alias("key"), F.concat(F.col("place").cast("string"), F.lit(f"-faixa-{period}")).alias("guid"), F.concat(F.col("name"), F.lit(": faixa de risco "), named("band")).alias("title"), text.alias("description"))


def feeds(items: DataFrame, places: DataFrame, site: str, built: str, most: int = 50) -> DataFrame:
    """place and xml: a feed for each place with its newest items. places: place, name."""
    rank = F.row_number().over(W.partitionBy("place").orderBy(F.desc("key"), "guid"))
    rows = items.withColumn("_k", rank).where(F.col("_k") <= most)
    link = lambda c: F.concat(F.lit(f"{site}#c-"), c.cast("string"))
    one = F.concat(F.lit("<item><title>"), escaped(F.col("title")), F.lit("</title><link>"), link(F.col("place")), F.lit('</link><guid isPermaLink="false">'), escaped(F.col("guid")), F.lit("</guid><description>"), escaped(F.col("description")), F.lit("</description></item>"))
    bodies = rows.groupBy("place").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_k", one.alias("x")))), lambda r: r["x"]), "").alias("_body"))
    head = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<rss version="2.0"><channel><title>'), escaped(F.col("name")), F.lit("</title><link>"), link(F.col("place")), F.lit(f"</link><language>pt-PT</language><lastBuildDate>{built}</lastBuildDate>"))
    return places.join(bodies, "place", "left").select("place", F.concat(head, F.coalesce("_body", F.lit("")), F.lit("</channel></rss>\n")).alias("xml"))


def write_feeds(df: DataFrame, path: str) -> None:
    """A folder for each place."""
    df.select("place", F.col("xml").alias("value")).write.mode("overwrite").partitionBy("place").text(path)


def features(polygons: DataFrame, table: DataFrame, key: str, columns: list[str], only_kept: bool = False, digits: int = 4) -> DataFrame:
    """One row a polygon, value: a GeoJSON feature with the table's columns as properties and rounded corners. polygons: key, rings."""
    from ..operators.spatial import rounded_rings

    rows = polygons.join(table.select(key, *columns), key, "inner" if only_kept else "left")
    props = F.struct(F.col(key), *columns)
    shape = F.struct(F.lit("Polygon").alias("type"), rounded_rings(F.col("rings"), digits).alias("coordinates"))
    return rows.select(F.to_json(F.struct(F.lit("Feature").alias("type"), props.alias("properties"), shape.alias("geometry"))).alias("value"))
