"""Points in polygons by a grid equi-join and an exact test; no cross join."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def inside(x: Column, y: Column, rings: Column) -> Column:
    """Even-odd rule over all rings (lists of x, y), so holes and several parts need nothing more. Rings may be open."""
    def crossings(ring: Column) -> Column:
        n = F.size(ring)
        def step(count: Column, k: Column) -> Column:
            a, b = F.get(ring, k), F.get(ring, F.pmod(k + 1, n))
            ax, ay, bx, by = a[0], a[1], b[0], b[1]
            return count + F.when(((ay > y) != (by > y)) & (x < F.try_divide((bx - ax) * (y - ay), by - ay) + ax), 1).otherwise(0)

        return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), step)

    solid = F.filter(rings, lambda r: F.size(r) >= 3)
    return F.aggregate(solid, F.lit(0), lambda total, r: total + crossings(r)) % 2 == 1


def points_in_polygons(points: DataFrame, polygons: DataFrame, cell: float) -> DataFrame:
    """points (x, y and more), polygons (polygon, rings): a row for each containment. A polygon meets only the points of cells under its bounds."""
    corners = F.flatten("rings")
    xs, ys = F.transform(corners, lambda p: p[0]), F.transform(corners, lambda p: p[1])
    def at(v: Column) -> Column:
        return F.floor(v / cell)

    gridded = polygons.where(F.size(F.flatten("rings")) > 0).withColumn("_cx", F.explode(F.sequence(at(F.array_min(xs)), at(F.array_max(xs)))))
    gridded = gridded.withColumn("_cy", F.explode(F.sequence(at(F.array_min(ys)), at(F.array_max(ys)))))
    placed = points.withColumn("_cx", at(F.col("x"))).withColumn("_cy", at(F.col("y")))
    return placed.join(gridded, ["_cx", "_cy"]).where(inside(F.col("x"), F.col("y"), F.col("rings"))).drop("_cx", "_cy", "rings")


def layers_at(points: DataFrame, layers: DataFrame, cell: float, reach: float = 0.00005, most: int = 5) -> DataFrame:
    """id, layer, found: for every point (id, x, y) and every layer that exists, up to `most` of the layer's polygons (layer, polygon, rings) there, in order.

    A polygon is there if it holds the point or a corner of the square of `reach` around
    it.  A layer without one has an empty list, so that nothing found is told from
    nothing asked.
    """
    steps = F.array(*[F.struct(F.lit(a * reach).alias("a"), F.lit(b * reach).alias("b")) for a, b in ((0, 0), (-1, -1), (-1, 1), (1, -1), (1, 1))])
    around = points.select("id", F.col("x").alias("_x"), F.col("y").alias("_y"), F.inline(steps)).select("id", (F.col("_x") + F.col("a")).alias("x"), (F.col("_y") + F.col("b")).alias("y"))
    here = points_in_polygons(around, layers.select("layer", "polygon", "rings"), cell).groupBy("id", "layer").agg(F.slice(F.array_sort(F.collect_set("polygon")), 1, most).alias("found"))
    asked = points.select("id").distinct().join(layers.select("layer").distinct(), F.lit(True))
    kind = layers.schema["polygon"].dataType.simpleString()
    return asked.join(here, ["id", "layer"], "left").select("id", "layer", F.coalesce("found", F.array().cast(f"array<{kind}>")).alias("found"))


#: Lower limits of the distance bands in kilometres.
BANDS = (0, 25, 50, 100, 200)


def distance_band(km: Column) -> Column:
    """The label of a distance's band."""
    out = F.lit(None).cast("string")
    for k, low in enumerate(BANDS):
        label = f"{low}–{BANDS[k + 1]} km" if k + 1 < len(BANDS) else f"mais de {low} km"
        out = F.when(km >= low, F.lit(label)).otherwise(out)
    return out


def nearest_centre(places: DataFrame, centres: DataFrame, levels: int = 1) -> DataFrame:
    """places (place, lat, lon) with centre, dist_km and band: the nearest of any number of centres (centre, lat, lon), the first by name of equal ones.

    See geometry.nearest; one level suits some hundred centres, seven any number.
    """
    from .geometry import nearest

    near = nearest(places, centres, 1, levels).select("place", "centre", "dist_km")
    return places.join(near, "place").select(*places.columns, "centre", "dist_km", distance_band(F.col("dist_km")).alias("band"))


def ring_area(ring: Column) -> Column:
    """Signed area of a ring of (x, y): positive where it runs counterclockwise."""
    n = F.size(ring)
    term = lambda k: F.get(ring, k)[0] * F.get(ring, F.pmod(k + 1, n))[1] - F.get(ring, F.pmod(k + 1, n))[0] * F.get(ring, k)[1]
    return F.when(n >= 3, F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), lambda a, k: a + term(k)) / 2)


def area_km2(rings: Column, lat: Column) -> Column:
    """Area of a polygon in degrees (outer rings less holes, whatever their direction where the first one is outer) at a latitude."""
    km = 111.32
    sizes = F.transform(rings, lambda r: F.coalesce(ring_area(r), F.lit(0.0)))
    return F.abs(F.aggregate(sizes, F.lit(0.0), lambda a, x: a + x)) * km * km * F.cos(F.radians(lat))


def outer_and_holes(rings: Column) -> Column:
    """Rings of a service that draws outer rings clockwise, as polygons: each outer ring with the holes that follow it."""
    begin = F.array().cast("array<array<array<array<double>>>>")

    def step(done: Column, ring: Column) -> Column:
        hole = (ring_area(ring) > 0) & (F.size(done) > 0)
        grown = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.concat(F.element_at(done, -1), F.array(ring))))
        return F.when(hole, grown).otherwise(F.concat(done, F.array(F.array(ring))))

    return F.aggregate(rings, begin, step)


def rounded_rings(rings: Column, digits: int = 4) -> Column:
    return F.transform(rings, lambda r: F.transform(r, lambda p: F.transform(p, lambda v: F.round(v, digits))))


def touching(polygons: DataFrame, digits: int = 3) -> DataFrame:
    """place, neighbour: polygons (place, rings) that share a corner when rounded to `digits`. An equi-join on corners."""
    corners = polygons.select("place", F.explode(F.flatten("rings")).alias("p")).select("place", F.round(F.col("p")[0], digits).alias("x"), F.round(F.col("p")[1], digits).alias("y")).distinct()
    other = corners.withColumnRenamed("place", "neighbour")
    return corners.join(other, ["x", "y"]).where("place <> neighbour").select("place", "neighbour").distinct()


def propagation(monthly: DataFrame, near: DataFrame, most_lag: int = 24, least: int = 60) -> DataFrame:
    """place, lag, r: correlation of a place's yearly log growth with its centre's `lag` months before, over `least` months.

    monthly: place, idx, value (ln); near: place, centre (a place).
    """
    from .panel import lagged

    growth = lagged(monthly, 12, "_b").select("place", "idx", (F.col("value") - F.col("_b")).alias("g")).where("g is not null")
    lags = F.explode(F.sequence(F.lit(0), F.lit(most_lag)))
    centres = near.select("centre").distinct()
    lead = growth.join(centres, F.col("place") == F.col("centre")).select("centre", "idx", F.col("g").alias("_c")).withColumn("lag", lags).withColumn("idx", F.col("idx") + F.col("lag"))
    rows = growth.join(near.select("place", "centre"), "place").join(lead, ["centre", "idx"])
    out = rows.groupBy("place", "lag").agg(F.corr("g", "_c").alias("r"), F.count("*").alias("n")).where(F.col("n") >= least)
    return out.drop("n")


def band_curves(curves: DataFrame, near: DataFrame, least: int = 3) -> DataFrame:
    """band, lag, r: the mean curve of the places of a band; best: whether the lag has the highest mean."""
    from pyspark.sql import Window as W

    held = curves.where("r is not null").join(near.select("place", "band"), "place")
    enough = held.groupBy("band").agg(F.count_distinct("place").alias("places")).where(F.col("places") >= least)
    rows = held.join(enough, "band").groupBy("band", "places", "lag").agg(F.avg("r").alias("r"))
    first = F.row_number().over(W.partitionBy("band").orderBy(F.desc("r"), "lag"))
    return rows.withColumn("best", first == 1)


def points_by_place(points: DataFrame, polygons: DataFrame, codes: DataFrame, names: DataFrame, cell: float) -> DataFrame:
    """points (id, code, x, y, parish, town) with `place`: by a known code, else by the polygon, else by the parish's and town's plain names.

    polygons: polygon, rings; codes: place; names: place, parish, town.
    """
    from ..functions.keys import plain

    known = codes.select(F.col("place").alias("_by_code")).distinct()
    rows = points.join(known, F.col("code") == F.col("_by_code"), "left")
    inside_of = points_in_polygons(rows.where("_by_code is null and x is not null and y is not null").select("id", "x", "y"), polygons, cell).groupBy("id").agg(F.min("polygon").alias("_by_shape"))
    named = names.groupBy(plain(F.col("parish")).alias("_p"), plain(F.col("town")).alias("_t")).agg(F.min("place").alias("_by_name"))
    rows = rows.join(inside_of, "id", "left").withColumns({"_p": plain(F.col("parish")), "_t": plain(F.col("town"))}).join(named, ["_p", "_t"], "left")
    return rows.withColumn("place", F.coalesce("_by_code", "_by_shape", "_by_name")).drop("_by_code", "_by_shape", "_by_name", "_p", "_t")


def counts_by_kind(placed: DataFrame, kinds: tuple[str, ...] = ("school", "health", "station")) -> DataFrame:
    """place and n_* of each kind."""
    return placed.where("place is not null").groupBy("place").agg(*[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in kinds])


def covered_share(polygons: DataFrame, zones: DataFrame, cell: float) -> DataFrame:
    """place, share: the part of each polygon (place, rings) inside the union of zones (polygon, rings), for polygons that any zone touches.

    Areas are counted by the centres of a grid of `cell` degrees: the error is
    bounded by the cells that a border crosses. Zones that overlap count once.
    """
    corners = F.flatten("rings")
    ends = lambda k, f: f(F.transform(corners, lambda p: p[k]))
    span = lambda k: F.sequence(F.floor(ends(k, F.array_min) / cell), F.floor(ends(k, F.array_max) / cell))
    grid = polygons.where(F.size(corners) > 0).withColumn("_i", F.explode(span(0))).withColumn("_j", F.explode(span(1)))
    grid = grid.withColumns({"x": (F.col("_i") + 0.5) * cell, "y": (F.col("_j") + 0.5) * cell}).where(inside(F.col("x"), F.col("y"), F.col("rings"))).select("place", "x", "y")
    wet = points_in_polygons(grid, zones, cell * 16).select("place", "x", "y").distinct().groupBy("place").agg(F.count("*").alias("_w"))
    return grid.groupBy("place").agg(F.count("*").alias("_n")).join(wet, "place").select("place", (F.col("_w") / F.col("_n")).alias("share"))


def cluster_name(level: Column, before: Column, after: Column, median_before: Column, median_after: Column, split: str) -> Column:
    """The fixed wording of a typology's price level and dynamics."""
    at = F.when(level > 0.25, "Mais caros").when(level < -0.25, "Mais baratos").otherwise("Preço médio")
    slowing = F.when(before > median_before + 0.03, f"boom até {split}, agora a abrandar").otherwise("subida a abrandar")
    steady = F.concat(F.lit("subida estável e "), F.when(after > median_after + 0.02, "forte").when(after < median_after - 0.02, "fraca").otherwise("moderada"))
    how = F.when((before < 0.02) & (after > median_after), f"arranque tardio (parados até {split}, a subir depois)").when(after > before + 0.03, "subida a acelerar").when(after < before - 0.03, slowing).otherwise(steady)
    return F.concat(at, F.lit(", "), how)
