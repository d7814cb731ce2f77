"""Queries over polygons and points: covered shares, borders and coasts, nearest points. Squares and points come from the suppliers and customers."""

from pyspark.sql import functions as F

from ..operators import geometry as G
from ..operators import spatial
from .base import query, r, rounded
from .panels import table


def box(x, y, w, h):
    """The rings of a rectangle."""
    return F.array(F.array(*[F.array(a, b) for a, b in ((x, y), (x + w, y), (x + w, y + h), (x, y + h))]))


def squares(spark, sf_dir, side: float = 1.0, west: float = 0.0, south: float = 0.0):
    """A square a supplier, twenty in a row."""
    k = F.col("s_suppkey").cast("long")
    x, y = F.round(west + (k % 20) * side, 6), F.round(south + F.floor(k / 20) * side, 6)
    return table(spark, sf_dir, "supplier").select(k.alias("place"), box(x, y, F.lit(side), F.lit(side)).alias("rings"))


def zones(spark, sf_dir):
    """A rectangle a customer, somewhere over the squares."""
    k = F.col("c_custkey").cast("long")
    x, y = (k * 7919 % 20000) / 1000.0 + 0.0003, F.floor(k / 300) + (k * 104729 % 1000) / 1000.0 + 0.0007
    return table(spark, sf_dir, "customer").select(k.alias("zone"), box(x, y, (k % 7 + 1) / 20.0, (k % 5 + 1) / 15.0).alias("rings"))


@query("""with p as (select s_suppkey::bigint place, (s_suppkey % 20)::double x0, (s_suppkey // 20)::double y0 from supplier),
z0 as (select c_custkey::bigint k, (c_custkey::bigint * 7919 % 20000) / 1000e0 + 3e-4 x, c_custkey // 300 + (c_custkey::bigint * 104729 % 1000) / 1000e0 + 7e-4 y from customer), z as (select x, y, x + (k % 7 + 1) / 20e0 x1, y + (k % 5 + 1) / 15e0 y1 from z0),
m as (select place, greatest(x0, x) a, least(x0 + 1, x1) b, greatest(y0, y) c, least(y0 + 1, y1) d from p join z on x < x0 + 1 and x1 > x0 and y < y0 + 1 and y1 > y0),
xs as (select place, v, lead(v) over (partition by place order by v) w from (select place, a v from m union select place, b from m)), ys as (select place, v, lead(v) over (partition by place order by v) w from (select place, c v from m union select place, d from m)),
g as (select xs.place, xs.v xa, xs.w xb, ys.v ya, ys.w yb from xs join ys using (place) where xs.w is not null and ys.w is not null),
s as (select place, sum((xb - xa) * (yb - ya)) c from g where exists (select 1 from m where m.place = g.place and a <= xa and b >= xb and c <= ya and d >= yb) group by 1)
select place, round(1e0, 6) area, round(coalesce(c, 0), 6) covered, round(coalesce(c, 0), 6) share from p left join s using (place)""")
def covered_shares(spark, sf_dir):
    """How much of each square the union of the rectangles covers."""
    return rounded(G.covered_shares(squares(spark, sf_dir), zones(spark, sf_dir), 1.5))


KM = "2 * 6371 * asin(sqrt(least(1, pow(sin(radians(by_ - ay) / 2), 2) + cos(radians(ay)) * cos(radians(by_)) * pow(sin(radians(bx - ax) / 2), 2))))"
EDGES = f"""sq as (select s_suppkey::bigint place, round(-10 + (s_suppkey % 20) * 1e-1, 6) x, round(36 + (s_suppkey // 20) * 1e-1, 6) y from supplier),
ee as (select place, round(x, 4) ax, round(y, 4) ay, round(x + 1e-1, 4) bx, round(y, 4) by_ from sq union all select place, round(x, 4), round(y + 1e-1, 4), round(x + 1e-1, 4), round(y + 1e-1, 4) from sq union all select place, round(x, 4), round(y, 4), round(x, 4), round(y + 1e-1, 4) from sq union all select place, round(x + 1e-1, 4), round(y, 4), round(x + 1e-1, 4), round(y + 1e-1, 4) from sq),
ed as (select *, {KM} km, count(*) over (partition by ax, ay, bx, by_) n, (ax + bx) / 2 mx, (ay + by_) / 2 my from ee)"""


def index(spark, sf_dir):
    return G.edge_index(squares(spark, sf_dir, 0.1, -10.0, 36.0))


@query(f"with {EDGES}, nb as (select a.place, count(distinct b.place) k from ed a join ed b on b.ax = a.ax and b.ay = a.ay and b.bx = a.bx and b.by_ = a.by_ and b.place <> a.place group by 1), t as (select place, sum(km) b, coalesce(sum(km) filter (n = 1), 0) o, coalesce(sum(km) filter (n = 1 and (mx < -15 or (mx < -855e-2 and my < 4187e-2) or (my < 3725e-2 and mx < -742e-2))), 0) c from ed group by 1) select place, round(b, 6) border_km, round(o, 6) outer_km, round(c, 6) coast_km, coalesce(k, 0)::bigint neighbours, c >= 1 coastal from t left join nb using (place)")
def coast_lengths(spark, sf_dir):
    """Border, outer border and coast of each square of a grid on the west coast."""
    return rounded(G.coasts(index(spark, sf_dir)))


@query(f"with {EDGES} select a.place, b.place neighbour, round(sum(a.km), 6) km from ed a join ed b on b.ax = a.ax and b.ay = a.ay and b.bx = a.bx and b.by_ = a.by_ and b.place <> a.place group by 1, 2")
def border_lengths(spark, sf_dir):
    return rounded(G.borders(index(spark, sf_dir)))


POINTS = "select {0}::bigint {1}, ({0}::bigint * {2} % 17900) / 100e0 - 895e-1 lat, ({0}::bigint * {3} % 36000) / 100e0 - 180 lon from {4}"


def points(spark, sf_dir, name, key, out, a, b):
    k = F.col(key).cast("long")
    return table(spark, sf_dir, name).select(k.alias(out), (k * a % 17900 / 100.0 - 89.5).alias("lat"), (k * b % 36000 / 100.0 - 180).alias("lon"))


@query(f"""with pl as ({POINTS.format("c_custkey", "place", 7919, 104729, "customer")}), ce as ({POINTS.format("s_suppkey", "centre", 6101, 15485, "supplier")}),
d as (select place, centre, 2 * 6371 * asin(sqrt(least(1, pow(sin(radians(ce.lat - pl.lat) / 2), 2) + cos(radians(pl.lat)) * cos(radians(ce.lat)) * pow(sin(radians(ce.lon - pl.lon) / 2), 2)))) km from pl cross join ce), k as (select *, row_number() over (partition by place order by km, centre) nth from d)
select place, centre, round(km, 5) dist_km, nth::int nth from k where nth <= 3""")
def nearest_three(spark, sf_dir):
    """The three suppliers nearest to each customer, all over the globe."""
    near = G.nearest(points(spark, sf_dir, "customer", "c_custkey", "place", 7919, 104729), points(spark, sf_dir, "supplier", "s_suppkey", "centre", 6101, 15485), 3, 4)
    return near.withColumn("dist_km", r("dist_km", 5))


@query("""with p as (select s_suppkey::bigint id, (s_suppkey::bigint * 7919 % 2000) / 1e2 + 13e-4 x, s_suppkey // 20 + (s_suppkey::bigint * 613 % 1000) / 1e3 + 7e-4 y from supplier),
z as (select c_custkey::bigint k, c_custkey % 3 layer, (c_custkey::bigint * 7919 % 20000) / 1000e0 + 3e-4 x, c_custkey // 300 + (c_custkey::bigint * 104729 % 1000) / 1000e0 + 7e-4 y, (c_custkey % 7 + 1) / 20e0 w, (c_custkey % 5 + 1) / 15e0 h from customer),
e as (select p.id, z.layer, z.k, row_number() over (partition by p.id, z.layer order by z.k) n from p join z on p.x + 5e-5 > z.x and p.x - 5e-5 < z.x + w and p.y + 5e-5 > z.y and p.y - 5e-5 < z.y + h)
select a.id, a.layer, coalesce(string_agg(e.k::varchar, ',' order by e.k), '') found from (select id, layer from p cross join (select distinct layer from z)) a left join e on e.id = a.id and e.layer = a.layer and n <= 5 group by 1, 2""")
def layers_at_points(spark, sf_dir):
    """What each of three layers of rectangles has at a point a supplier."""
    k = F.col("s_suppkey").cast("long")
    at = table(spark, sf_dir, "supplier").select(k.alias("id"), (k * 7919 % 2000 / 100.0 + 0.0013).alias("x"), (F.floor(k / 20) + k * 613 % 1000 / 1000.0 + 0.0007).alias("y"))
    layers = zones(spark, sf_dir).select((F.col("zone") % 3).alias("layer"), F.col("zone").alias("polygon"), "rings")
    return spatial.layers_at(at, layers, 0.5).select("id", "layer", F.array_join(F.transform("found", lambda x: x.cast("string")), ",").alias("found"))
