"""Queries of hierarchies, pivots, indicators and names."""

from pyspark.sql import functions as F

from ..operators import panel as P
from ..operators import rollup as L
from .base import query, r
from .panels import table


def placed_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", F.col("c_acctbal").alias("weight"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_nationkey").cast("bigint").alias("place"), F.col("n_regionkey").cast("bigint").alias("region"))
    return orders.join(customers, "o_custkey").join(nations, "c_nationkey")


ORDERS = "po as (select o_totalprice p, year(o_orderdate)::int \"year\", c_acctbal w, n_nationkey::bigint place, n_regionkey::bigint region from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey)"


@query(f"with {ORDERS} select \"year\", region, place, ((region is not null)::int + (place is not null)::int)::int depth, (count(*) filter (w > 0))::bigint n, round(sum(w) filter (w > 0), 4) weight, round(sum(w * p) filter (w > 0) / sum(w) filter (w > 0), 4) as \"value\" from po group by grouping sets ((\"year\"), (\"year\", region), (\"year\", region, place))")
def region_rollup(spark, sf_dir):
    """Mean order prices, weighted by the customers' balance, by country, region and in all, each year."""
    out = L.region_rollup(placed_orders(spark, sf_dir), ["region", "place"], ["year"], "o_totalprice", "weight")
    return out.select("year", "region", "place", "depth", "n", r("weight", 4).alias("weight"), r("value", 4).alias("value"))


YEARS = {y: f"y{y}" for y in range(1992, 1999)}


@query(f"with {ORDERS}, m as (select place, \"year\", avg(p) v from po group by 1, 2) select place, {', '.join(f'round(max(v) filter (\"year\" = {y}), 4) {n}' for y, n in YEARS.items())} from m group by 1")
def wide_years(spark, sf_dir):
    """A row a country, a column a year."""
    m = placed_orders(spark, sf_dir).groupBy("place", "year").agg(F.avg("o_totalprice").alias("value"))
    out = L.wide(m, "place", "year", YEARS)
    return out.select("place", *[r(n, 4).alias(n) for n in YEARS.values()])


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("with n as (select c_mktsegment s, count(*) n from customer group by 1), t as (select s from n order by n desc, s limit 1), x as (select c_nationkey::bigint place, " + ", ".join(f"case when c_mktsegment = '{s}' and '{s}' <> (select s from t) then 1e0 else 0e0 end \"is_{s}\"" for s in SEGMENTS) + ", case when c_acctbal is null then null else c_acctbal end b from customer) select place, " + ", ".join(f"round(avg(\"is_{s}\"), 6) \"is_{s}\"" for s in SEGMENTS) + " from x group by 1")
def segment_indicators(spark, sf_dir):
    """Shares of the segments from indicators, with none for the most frequent one."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("bigint").alias("place"), "c_mktsegment")
    most = L.most_frequent(rows, "c_mktsegment")
    out = L.indicators(rows.withColumn("c_mktsegment", F.nullif("c_mktsegment", most)), "c_mktsegment", SEGMENTS, "is_")
    return out.groupBy("place").agg(*[r(F.avg(f"is_{s}")).alias(f"is_{s}") for s in SEGMENTS])


@query("with a as (select s_suppkey k, translate(s_name, 'Supier', 'ŞŭṗîĕŘ') n from supplier), b as (select s_suppkey::bigint code, lower(s_name) n from supplier where s_suppkey % 4 <> 0) select a.k as id, code from a left join b on regexp_replace(lower(strip_accents(a.n)), '[^a-z0-9]+', ' ', 'g') = regexp_replace(b.n, '[^a-z0-9]+', ' ', 'g')")
def names_by_letters(spark, sf_dir):
    """Names written with letters beyond any one language's, matched with plain ones."""
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(k.alias("id"), F.translate("s_name", "Supier", "ŞŭṗîĕŘ").alias("name"))
    known = table(spark, sf_dir, "supplier").where(k % 4 != 0).select(k.cast("bigint").alias("code"), F.lower("s_name").alias("plain"))
    return L.match_names(rows, "name", known, "plain", "code").select("id", "code")


@query("with b as (select o_orderpriority g, quantile_cont(o_totalprice, 25e-3) l, quantile_cont(o_totalprice, 975e-3) h from orders group by 1) select o_orderpriority priority, count(*)::bigint n, round(min(least(greatest(o_totalprice, l), h)), 4) low, round(max(least(greatest(o_totalprice, l), h)), 4) high, round(avg(least(greatest(o_totalprice, l), h)), 4) mean from orders join b on g = o_orderpriority group by 1")
def winsorised_prices(spark, sf_dir):
    """Order prices held to the percentiles of their priority."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").cast("double").alias("value"))
    return P.winsorised(rows, "value", "priority").groupBy("priority").agg(F.count("*").alias("n"), r(F.min("value"), 4).alias("low"), r(F.max("value"), 4).alias("high"), r(F.avg("value"), 4).alias("mean"))


@query("with a as (select distinct o_custkey k from orders where year(o_orderdate) = 1996), b as (select distinct o_custkey k from orders where year(o_orderdate) = 1997) select 'kept' as \"change\", count(*)::bigint n from (select * from a intersect select * from b) union all select 'new', count(*) from (select * from b except select * from a) union all select 'gone', count(*) from (select * from a except select * from b)")
def customer_changes(spark, sf_dir):
    """How many customers ordered in both of two years, only in the later and only in the earlier one."""
    of = lambda y: table(spark, sf_dir, "orders").where(F.year("o_orderdate") == y).select("o_custkey")
    return P.set_changes(of(1996), of(1997)).groupBy("change").agg(F.count("*").alias("n"))
