"""Queries of rate effects, ages of series and ranks of large tables."""

from pyspark.sql import functions as F

from ..functions import keys
from ..operators import panel as P
from ..operators import rates as R
from .base import query, r, rounded
from .panels import M, Q, column, months, quarters, stored, table

#: Monthly values, scaled to percent, stand for the market rate of each country; the mortgage rate follows half of it.
PAIR = "e as (select place, idx, value / 100000 as value from m), g as (select place, idx, value / 200000 + 15e-1 + (idx % 5) / 20 as value from m where idx <= (select max(idx) from m) - 2)"
SLOPE = "bo as (select e.place, e.idx, e.value e, g.value m from e join g using (place, idx)), st as (select a.place, a.idx, a.e - b.e de, a.m - b.m dm from bo a join bo b on b.place = a.place and b.idx = a.idx - 1), rk as (select *, row_number() over (partition by place order by idx desc) k from st), sl as (select place, least(greatest(regr_slope(dm, de), 0), 15e-1) slope from rk where k <= 36 group by 1 having count(*) >= 24 and var_samp(de) > 0)"
NOW = "le as (select place, max_by(value, idx) market from e group by 1), lg as (select place, max_by(value, idx) mortgage, max(idx) at_ from g group by 1), rn as (select le.place, market, case when mortgage - t.value between 0 and 4 then mortgage - t.value else 1 end spread, case when mortgage - t.value between 0 and 4 then slope end slope, mortgage, t.value then_ from le left join lg using (place) left join sl using (place) left join e t on t.place = lg.place and t.idx = lg.at_), ra as (select *, coalesce(mortgage + slope * (market - then_), market + spread) rate from rn)"


def pair(spark, sf_dir):
    m = stored(months(spark, sf_dir))
    last = m.agg(F.max("idx")).scalar()
    return column(m, F.col("value") / 100000), column(m.where(F.col("idx") <= last - 2), F.col("value") / 200000 + 1.5 + (F.col("idx") % 5) / 20)


@query(f"with {M}, {PAIR}, {SLOPE} select place, round(slope, 6) slope from sl")
def rate_passthrough(spark, sf_dir):
    return rounded(R.passthrough(*pair(spark, sf_dir)))


@query(f"with {M}, {PAIR}, {SLOPE}, {NOW} select place, round(market, 6) market, round(spread, 6) spread, round(slope, 6) slope, round(rate, 6) rate from ra")
def rate_now(spark, sf_dir):
    return rounded(R.rate_now(*pair(spark, sf_dir)))


@query(f"with {M}, {PAIR}, {SLOPE}, {NOW}, s as (select place, rate, d::double shock, greatest(rate + d, 0) after from ra, (values (-1), (1)) t(d)) select place, shock, round((after / (1 - pow(1 + after / 1200, -360))) / (rate / (1 - pow(1 + rate / 1200, -360))) - 1, 6) instalment, round(((1 - pow(1 + after / 1200, -360)) / after) / ((1 - pow(1 + rate / 1200, -360)) / rate) - 1, 6) capacity from s")
def rate_scenarios(spark, sf_dir):
    return rounded(R.shock_effects(R.rate_now(*pair(spark, sf_dir))))


EFFECT = f"""eq as (select place, (idx // 3)::bigint idx, avg(value) v from e group by 1, 2), ch as (select q.place, q.idx, ln(f.value) - ln(q.value) y, b.v - a.v d, ln(q.value) - ln(p.value) m from q join q f on f.place = q.place and f.idx = q.idx + 4 join q p on p.place = q.place and p.idx = q.idx - 4 join eq a on a.place = q.place and a.idx = q.idx join eq b on b.place = q.place and b.idx = q.idx + 4),
cn as (select *, row_number() over (partition by place order by idx) - 1 t, count(*) over (partition by place) n from ch), co as (select * from cn where n >= 12),
tu as (select place, n, dr, tn, case when tn = ceil(n / 4) - 1 then n - tn * 4 else 4 end size, ('0x' || substr(md5(dr || ':' || tn), 1, 8))::bigint % (n - 4 + 1) bg from (select distinct place, n from co), (select unnest(range(400)) dr), (select unnest(range(20)) tn) where tn < ceil(n / 4)),
bo as (select tu.place, dr, (covar_pop(y, d) * var_pop(m) - covar_pop(y, m) * covar_pop(d, m)) / nullif(var_pop(d) * var_pop(m) - pow(covar_pop(d, m), 2), 0) b from tu join co on co.place = tu.place and t >= bg and t < bg + size group by 1, 2),
fu as (select place, count(*) n, (covar_pop(y, d) * var_pop(m) - covar_pop(y, m) * covar_pop(d, m)) / (var_pop(d) * var_pop(m) - pow(covar_pop(d, m), 2)) beta from co group by 1), ef as (select fu.*, low, high from fu join (select place, quantile_cont(b, 5e-2) low, quantile_cont(b, 95e-2) high from bo group by 1) using (place))"""


def effects(spark, sf_dir):
    market, _ = pair(spark, sf_dir)
    return R.rate_effect(R.rate_changes(column(quarters(spark, sf_dir), "value"), market), 400, 4, 12)


@query(f"with {Q}, {M}, {PAIR}, {EFFECT} select place, n::bigint n, round(beta, 6) beta, round(low, 6) low, round(high, 6) high, high < 0 credible from ef")
def rate_effect(spark, sf_dir):
    """What a point of the rate does to prices within a year, with bounds from 400 resampled histories."""
    return rounded(effects(spark, sf_dir))


@query(f"with {Q}, {M}, {PAIR}, {EFFECT} select place, s::double shock, round(exp(beta * s) - 1, 6) price_effect, round(exp(least(low * s, high * s)) - 1, 6) low, round(exp(greatest(low * s, high * s)) - 1, 6) high from ef, (values (-1), (1)) t(s) where high < 0")
def rate_price_effects(spark, sf_dir):
    return rounded(R.price_effects(effects(spark, sf_dir)))


@query(f"with {Q}, l as (select 'S' as source, 'k' || place as key, (max(idx) // 4) || 'Q' || (max(idx) % 4 + 1) as last, max(idx) i, place from q where idx <= 8000 - place group by place), a as (select *, (2002 * 12 + 2) - (i // 4 * 12 + (i % 4) * 3 + 3) as months, case when place % 3 = 0 then 20 else 9 end lim from l where place % 7 <> 0) select source, key, last, months::int as months, lim::int as \"limit\", (row_number() over (order by months / lim::double desc, source, key))::int as \"position\" from a where months > lim")
def stale_series(spark, sf_dir):
    q = quarters(spark, sf_dir).where("idx <= 8000 - place")
    key = F.concat(F.lit("k"), F.col("place").cast("string"))
    last = q.groupBy("place").agg(F.max("idx").alias("i")).select(F.lit("S").alias("source"), key.alias("key"), keys.index_label(F.col("i"), "quarter").alias("last"))
    specs = q.select("place").distinct().select(F.lit("S").alias("source"), key.alias("key"), F.when(F.col("place") % 3 == 0, 20).alias("max_months"), (F.col("place") % 7 == 0).alias("static"))
    return R.stale_series(last, specs, F.to_date(F.lit("2002-02-10")))


@query("with v as (select l_extendedprice v, count(*) t from lineitem group by 1), w as (select v, 100 * (sum(t) over (order by v) - t + (t + 1) / 2e0) / sum(t) over () p from v) select (floor(v / 10000))::bigint as bin, count(*)::bigint n, round(min(p), 6) low, round(max(p), 6) high from w group by 1")
def percentile_ranks(spark, sf_dir):
    rows = P.percentile_ranks(table(spark, sf_dir, "lineitem").select("l_extendedprice"), "l_extendedprice", "p").distinct()
    return rows.groupBy(F.floor(F.col("l_extendedprice") / 10000).cast("bigint").alias("bin")).agg(F.count("*").alias("n"), r(F.min("p")).alias("low"), r(F.max("p")).alias("high"))


@query(f"with {Q}, s as (select place, idx, ln(value) l, ln(value) - lag(ln(value)) over (partition by place order by idx) d from q) select place, round(max_by(l, idx) + 4 * avg(d), 6) as value from s group by 1")
def drift(spark, sf_dir):
    return rounded(R.drift(column(quarters(spark, sf_dir), F.log("value")), 4))
