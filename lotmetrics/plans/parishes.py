"""Queries of the parish tables; suppliers stand in for parishes, the rest of their key by 25 for towns."""

from pyspark.sql import functions as F

from ..operators import clusters
from ..operators import parishes as P
from ..operators import spatial
from .base import query, r, rounded
from .panels import M, column, months, stored, table

SP = "sp as (select l_suppkey place, (year(l_shipdate) * 4 + quarter(l_shipdate) - 1)::bigint idx, avg(l_extendedprice / l_quantity) as value, count(*) n from lineitem where l_quantity > 0 group by 1, 2)"
SY = "sy as (select l_suppkey place, year(l_shipdate)::bigint idx, avg(l_extendedprice / l_quantity) as value, count(*)::double n from lineitem where l_quantity > 0 group by 1, 2)"


def parts(spark, sf_dir, kind):
    rows = table(spark, sf_dir, "lineitem").where("l_quantity > 0")
    idx = F.year("l_shipdate") if kind == "year" else F.year("l_shipdate") * 4 + F.quarter("l_shipdate") - 1
    return rows.groupBy(F.col("l_suppkey").alias("place"), idx.cast("bigint").alias("idx")).agg(F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("value"), F.count("*").cast("double").alias("n"))


PRICES = "e as (select max(idx) e from sp), k as (select idx, row_number() over (order by idx desc) b from (select distinct idx from sp)), st as (select a.place, ln(a.value / b.value) step from (select sp.*, b from sp join k using (idx) where b <= 13) a join (select sp.*, b from sp join k using (idx) where b <= 13) b on b.place = a.place and b.b = a.b + 1), vo as (select place, stddev_samp(step) v from st group by 1 having count(*) >= 6), tw as (select place % 25 town, avg(value) tp from sp group by 1), pr as (select a.place, a.place % 25 town, a.value price, a.value / b.value - 1 g1y, a.value / tp - 1 rel_town, v from sp a join e on a.idx = e left join sp b on b.place = a.place and b.idx = a.idx - 4 join tw on tw.town = a.place % 25 left join vo on vo.place = a.place)"


def prices(spark, sf_dir):
    q = parts(spark, sf_dir, "quarter")
    towns = q.groupBy((F.col("place") % 25).alias("town")).agg(F.avg("value").alias("town_price"))
    return P.price_table(column(q, "value"), towns, F.col("place") % 25)


@query(f"with {SP}, {PRICES} select place, town, round(price, 6) price, round(g1y, 6) g1y, round(rel_town, 6) rel_town, round(v, 6) volatility, v >= (select case when count(v) >= 20 then quantile_cont(v, 0.75) end from pr) volatile from pr")
def parish_prices(spark, sf_dir):
    return rounded(prices(spark, sf_dir))


@query(f"with {SY}, e as (select max(idx) e from sy) select a.place, round(a.value, 6) rent, round(a.value / b.value - 1, 6) rent_g1y, round(a.value / c.value - 1, 6) rent_g3y, a.n rent_contracts from sy a join e on a.idx = e left join sy b on b.place = a.place and b.idx = a.idx - 1 left join sy c on c.place = a.place and c.idx = a.idx - 3")
def parish_rents(spark, sf_dir):
    y = parts(spark, sf_dir, "year")
    return rounded(P.rent_table(column(y, "value"), column(y, "n")))


@query(f"with {SY}, e as (select max(idx) e from sy) select place, max(n) filter (idx = e) lic_new, sum(n) filter (idx > e - 3) lic_3y, round(sum(n) filter (idx > e - 3) / (1000.0 + place % 7) * 100, 6) lic_per_100 from sy cross join e group by place having sum(n) filter (idx > e - 3) is not null")
def parish_licences(spark, sf_dir):
    y = parts(spark, sf_dir, "year")
    homes = y.select("place", (1000.0 + F.col("place") % 7).alias("homes")).distinct()
    return rounded(P.licences(column(y, "n"), homes))


KINDS = ("total", "pre1919", "1919_1945", "1946_1960", "repair_mid", "repair_deep")


@query("with c as (select l_suppkey place, l_linenumber % 6 k, count(*)::double n from lineitem group by 1, 2) select place, sum(n) filter (k = 0) * 3 buildings, round(least(coalesce(sum(n) filter (k in (1, 2, 3)), 0) / (sum(n) filter (k = 0) * 3), 1), 6) old_share, round(least(coalesce(sum(n) filter (k in (4, 5)), 0) / (sum(n) filter (k = 0) * 3), 1), 6) repair_share from c group by 1 having sum(n) filter (k = 0) > 0")
def parish_buildings(spark, sf_dir):
    k = F.col("l_linenumber") % 6
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("place"), F.element_at(F.array(*map(F.lit, KINDS)), (k + 1).cast("int")).alias("kind")).agg(F.count("*").cast("double").alias("value"))
    return rounded(P.buildings(rows.withColumn("value", F.when(F.col("kind") == "total", F.col("value") * 3).otherwise(F.col("value")))))


@query(f"with {SP}, {PRICES}, ed as (select a.place, b.place neighbour from pr a join pr b on abs(a.place - b.place) in (1, 10)), nb as (select ed.place, count(*) n, quantile_cont(pr.price, 0.5) m from ed join pr on pr.place = ed.neighbour group by 1) select pr.place, round(price, 6) price, coalesce(n, 0)::bigint n_nb, round(case when n >= 2 then price / m - 1 end, 6) rel_nb from pr left join nb using (place)")
def parish_neighbours(spark, sf_dir):
    rows = prices(spark, sf_dir).select("place", "price")
    edges = rows.select("place", F.explode(F.array(*[F.col("place") + k for k in (-10, -1, 1, 10)])).alias("neighbour"))
    return rounded(P.with_neighbours(rows, edges))


@query(f"with {SP}, {PRICES}, f as (select *, row_number() over (partition by town order by price desc, place) k from pr) select place, town, round(price, 6) price, k::int as \"rank\" from f where k <= 3")
def top_parishes(spark, sf_dir):
    return rounded(P.top_parishes(prices(spark, sf_dir).select("place", "town", "price"), "price"))


@query(f"with {SP}, {SY}, {PRICES}, y as (select place, value rent from sy where idx = (select max(idx) from sy) and place % 3 = 0), c as (select s_suppkey place, 100.0 + s_suppkey % 9 homes from supplier where s_suppkey % 4 = 0), n as (select s_suppkey place, s_name as name from supplier where s_suppkey % 2 = 0), n2 as (select s_suppkey place, 'x' || s_name as name from supplier) select place, round(price, 6) price, round(rent, 6) rent, homes::double homes, coalesce(n.name, n2.name) as name, left(place::varchar, 4) dico from (select place, price from pr where place % 5 <> 0) p full join y using (place) full join c using (place) left join n using (place) left join n2 using (place)")
def parish_table(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("place"), F.col("s_name").alias("name"))
    rents = P.rent_table(column(parts(spark, sf_dir, "year"), "value")).where("place % 3 = 0").select("place", "rent")
    census = suppliers.where("place % 4 = 0").select("place", (100.0 + F.col("place") % 9).alias("homes"))
    own = prices(spark, sf_dir).where("place % 5 <> 0").select("place", "price")
    empty = own.select("place").limit(0)
    return rounded(P.parish_table(own, rents, empty, census, [suppliers.where("place % 2 = 0"), suppliers.withColumn("name", F.concat(F.lit("x"), "name"))]))


PLACES = "pl as (select n_nationkey::bigint place, 38.0::double + n_nationkey * 2e-1 lat, -9e0 + (n_nationkey % 5) * 3e-1 lon from nation)"
KM = "2 * 6371 * asin(sqrt(least(1, pow(sin(radians({1}.lat - {0}.lat) / 2), 2) + cos(radians({0}.lat)) * cos(radians({1}.lat)) * pow(sin(radians({1}.lon - {0}.lon) / 2), 2))))"
NEAR = f"d as (select a.place, b.place centre, {KM.format('a', 'b')} km from pl a join pl b on b.place in (0, 12)), nr as (select place, arg_min(centre, (km, centre)) centre, min(km) km, case when min(km) >= 200 then 'mais de 200 km' when min(km) >= 100 then '100–200 km' when min(km) >= 50 then '50–100 km' when min(km) >= 25 then '25–50 km' else '0–25 km' end band from d group by 1)"


def near(spark, sf_dir):
    k = F.col("n_nationkey").cast("bigint")
    places = table(spark, sf_dir, "nation").select(k.alias("place"), (38.0 + k * 0.2).alias("lat"), (-9.0 + (k % 5) * 0.3).alias("lon"))
    return spatial.nearest_centre(places, places.where("place in (0, 12)").withColumnRenamed("place", "centre"))


@query(f"with {PLACES}, {NEAR} select place, centre, round(km, 4) dist_km, band from nr")
def metro_distances(spark, sf_dir):
    return near(spark, sf_dir).select("place", "centre", r("dist_km", 4).alias("dist_km"), "band")


RIPPLE = f"g as (select a.place, a.idx, ln(a.value) - ln(b.value) g from m a join m b on b.place = a.place and b.idx = a.idx - 12), cu as (select x.place, l.lag, corr(x.g, y.g) r from g x join nr using (place) cross join (select unnest(generate_series(0, 6)) lag) l join g y on y.place = nr.centre and y.idx = x.idx - l.lag group by 1, 2 having count(*) >= 40)"


def curves(spark, sf_dir):
    return spatial.propagation(column(months(spark, sf_dir), F.log("value")), near(spark, sf_dir), 6, 40)


@query(f"with {M}, {PLACES}, {NEAR}, {RIPPLE} select place, lag::int lag, round(r, 6) r from cu")
def propagation(spark, sf_dir):
    return rounded(curves(spark, sf_dir))


@query(f"with {M}, {PLACES}, {NEAR}, {RIPPLE}, b as (select band, lag, avg(r) r, count(distinct place) p from cu join nr using (place) group by 1, 2), e as (select band, count(distinct place) places from cu join nr using (place) where r is not null group by 1 having count(distinct place) >= 3) select b.band, places::bigint places, lag::int lag, round(b.r, 6) r, row_number() over (partition by b.band order by b.r desc, lag) = 1 best from b join e on e.band = b.band")
def band_curves(spark, sf_dir):
    return rounded(spatial.band_curves(curves(spark, sf_dir), near(spark, sf_dir)))


@query(None)
def typologies(spark, sf_dir):
    """Groups of places by price level and growth before and after a quarter (no SQL: the starts are many and the steps iterate)."""
    q = parts(spark, sf_dir, "quarter").where("value > 0").withColumn("l", F.log("value"))
    ends = q.agg(F.min("idx").alias("a"), F.max("idx").alias("b")).select("a", "b", F.floor((F.col("a") + F.col("b")) / 2).alias("m"))
    at = lambda k: F.max(F.when(F.col("idx") == F.col(k), F.col("l")))
    rows = q.join(ends, F.lit(True)).groupBy("place", "a", "b", "m").agg(at("a").alias("l0"), at("m").alias("l1"), at("b").alias("l2"))
    rate = lambda x, y, i, j: F.exp((F.col(y) - F.col(x)) * 4 / (F.col(j) - F.col(i))) - 1
    rows = rows.select("place", F.col("l2").alias("level"), rate("l0", "l1", "a", "m").alias("before"), rate("l1", "l2", "m", "b").alias("after")).where("level is not null and before is not null and after is not null")
    out, found = clusters.typologies(stored(rows), ["level", "before", "after"])
    return rounded(out.withColumn("silhouette", F.lit(max(found.values(), default=None)).cast("double")))
