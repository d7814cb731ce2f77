"""The build: every product of the panel, each failing on its own, published together."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as S
from ..operators import indices as I
from ..sources import feeds, published
from . import catalog, geometry
from .panels import column, months, quarters, stored, years


def merged(places: DataFrame, *patches: DataFrame | None) -> DataFrame:
    """places with the columns of every patch (place, ...); patches that are missing or clash with columns before them are an error."""
    for patch in patches:
        if patch is None:
            continue
        twice = {c.lower() for c in patch.columns} & {c.lower() for c in places.columns} - {"place"}
        if twice:
            raise ValueError(f"columns come twice: {sorted(twice)}")
        places = places.join(patch, "place", "left")
    return places


def outlook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """place and its forecasts: an array of h, pred and the bounds, by h."""
    rows = catalog.QUERIES["ridge_forecast"](spark, sf_dir)
    made = F.struct("h", "pred", "q10", "q25", "q75", "q90")
    return rows.groupBy("place").agg(F.array_sort(F.collect_list(made)).alias("forecasts"))


def products(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    """The published tables over the stand-in panels."""
    sales, monthly, yearly = stored(quarters(spark, sf_dir)), stored(months(spark, sf_dir)), stored(years(spark, sf_dir))
    price, rent = column(sales, "value"), column(yearly, F.col("value") / 25)

    def municipalities() -> DataFrame:
        feats = S.municipal_features(price, rent, permits=column(yearly, "n"), completed=column(yearly, "urgent"))
        return feeds.cleaned(merged(feats, S.quarter_changes(price, rent).select("place", "qoq", "score_prev", "band_prev"), I.last_twelve(column(monthly, "n"))))

    return {
        "municipalities": municipalities,
        "series": lambda: feeds.series_by_place(price, "quarter").join(feeds.series_by_place(rent, "year").withColumnRenamed("series", "rent"), "place", "left"),
        "history": lambda: feeds.series_by_place(I.monthly_to_quarterly(column(monthly, "value"), 2), "quarter", 0),
        "national": lambda: S.national_scores(price, column(monthly, "value"), column(sales, "n")),
        "changes": lambda: S.change_summary(S.quarter_changes(price, rent)),
        "outlook": lambda: outlook(spark, sf_dir),
        "parishes": lambda: feeds.cleaned(catalog.QUERIES["parish_table"](spark, sf_dir)),
        "map": lambda: feeds.features(geometry.squares(spark, sf_dir, 0.1, -10.0, 36.0), catalog.QUERIES["parish_prices"](spark, sf_dir), "place", ["town", "price", "volatile"]),
    }


def build(spark: SparkSession, sf_dir: str, out: str) -> dict[str, str]:
    """Publishes the products and the state of the build (meta) under `out`, all at once, and their JSON lines."""
    store = published.Store(spark, out)
    status = store.publish(products(spark, sf_dir), meta="meta")
    published.exported(store, sorted(n for n in store.manifest()["tables"]))
    return status
