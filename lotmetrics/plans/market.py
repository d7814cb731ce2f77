"""Queries of the market and housing context."""

from pyspark.sql import functions as F

from ..operators import context as C
from .base import query, r, rounded
from .panels import D, M, Q, Y, column, deflator, months, quarters, stored, table, years

#: Monthly values stand for valuations: a tenth under the quarters' prices, so that gaps have either sign.
V = "v as (select place, idx, value * 98e-2 as value from m)"
GAPS = f"w as (select q.place, q.idx, avg(v.value) / nullif(max(q.value), 0) - 1 g from q join v on v.place = q.place and v.idx between q.idx * 3 - 9 and q.idx * 3 + 2 group by 1, 2 having count(*) >= 9), gg as (select a.place, a.idx, a.g gap, a.g - b.g change from w a left join w b on b.place = a.place and b.idx = a.idx - 4), gl as (select place, gap, change from gg where idx = (select max(idx) from q))"


def frames(spark, sf_dir):
    return column(quarters(spark, sf_dir), "value"), column(months(spark, sf_dir), F.col("value") * 0.98)


@query(f"with {Q}, {M}, {V}, {GAPS} select place, round(gap, 6) gap, round(change, 6) change from gl")
def valuation_gap_places(spark, sf_dir):
    return rounded(C.valuation_gap(*frames(spark, sf_dir)))


@query(f"with {Q}, {M}, {V}, {GAPS} select count(gap)::bigint n, round(quantile_cont(gap, 0.5), 6) median_gap, round(quantile_cont(change, 0.5), 6) median_change, round(avg((change > 0)::int), 6) share_widening, count(change)::bigint n_change from gl")
def valuation_gap_summary(spark, sf_dir):
    return rounded(C.gap_summary(C.valuation_gap(*frames(spark, sf_dir))))


@query(f"with {Q}, {M}, {V}, {GAPS}, l as (select * from gl where change is not null and place in (select place from q where idx = (select max(idx) from q) and n * 10 >= 20)) (select place, round(change, 6) change, 'up' direction from l order by l.change desc, place limit 5) union all (select place, round(change, 6), 'down' from l order by l.change, place limit 5)")
def valuation_gap_listed(spark, sf_dir):
    q = quarters(spark, sf_dir)
    volume = C.at_last(q.select("place", "idx", (F.col("n") * 10).alias("value"))).select("place", F.col("value").alias("volume"))
    return rounded(C.listed(C.valuation_gap(*frames(spark, sf_dir)), "change", volume, 5).select("place", "change", "direction"))


PHASES = "e as (select max(idx) e from q), l as (select place, max(value) filter (idx = e) / nullif(max(value) filter (idx = e - 4), 0) - 1 p, 10 * max(n) filter (idx = e) n, max(n) filter (idx = e)::double / nullif(max(n) filter (idx = e - 4), 0) - 1 v from q cross join e group by 1), ph as (select *, case when p > 0 and v > 0 then 'up_up' when p > 0 then 'up_down' when v <= 0 then 'down_down' else 'down_up' end phase from l where p is not null and v is not null and n >= 20)"


def phases(spark, sf_dir):
    q = quarters(spark, sf_dir)
    price = C.latest(column(q, "value"), {"b": 4}, "a").select("place", C.change("a", "b").alias("price_growth_1y"))
    count = C.latest(column(q, F.col("n") * 10), {"b": 4}, "val_count").select("place", "val_count", C.change("val_count", "b").alias("val_count_growth_1y"))
    return C.cycle_phases(price.join(count, "place"))


@query(f"with {Q}, {PHASES} select place, round(p, 6) price_growth_1y, n::double val_count, round(v, 6) val_count_growth_1y, phase from ph")
def price_volume_cycle(spark, sf_dir):
    return rounded(phases(spark, sf_dir))


@query(f"with {Q}, {PHASES} select phase, count(*)::bigint n, round(quantile_cont(p, 0.5), 6) median_price_growth, round(quantile_cont(v, 0.5), 6) median_volume_growth from ph group by 1")
def cycle_summary(spark, sf_dir):
    return rounded(C.cycle_summary(phases(spark, sf_dir)))


@query(f"with {Q}, {PHASES} select place, round(v, 6) val_count_growth_1y from ph where phase = 'up_down' order by v, place limit 10")
def late_cycle(spark, sf_dir):
    return rounded(C.late_cycle(phases(spark, sf_dir)).select("place", "val_count_growth_1y"))


@query(f"with {M}, p as (select place, idx // 3 i, avg(value) a from m group by 1, 2 having count(value) = 3), c as (select place, idx // 3 i, n from m where idx % 3 = 2) select p.place, p.i::bigint idx, round(p.a / nullif(b.a, 0) - 1, 6) price, round(c.n / d.n::double - 1, 6) volume from p join p b on b.place = p.place and b.i = p.i - 4 join c on c.place = p.place and c.i = p.i join c d on d.place = p.place and d.i = p.i - 4 where d.n > 0")
def national_cycle(spark, sf_dir):
    m = months(spark, sf_dir)
    return rounded(C.national_cycle(column(m, "value"), column(m, "n")))


@query(f"with {M}, w as (select a.place, a.idx, sum(b.n) s, sum(b.n // 2) h from m a join m b on b.place = a.place and b.idx between a.idx - 11 and a.idx group by 1, 2 having count(*) = 12), e as (select place, max(idx) e from w group by 1), k as (select place from m group by 1 having count(*) >= 36) select e.place, e.e until, a.s::double last12, round(a.s / b.s::double - 1, 6) change, (select max(s) from w where w.place = e.place)::double peak, (select arg_min(idx, (-s, idx)) from w where w.place = e.place) peak_at, a.h::double pure12, round(1 - a.h / a.s::double, 6) reneg_share from e join k using (place) join w a on a.place = e.place and a.idx = e.e left join w b on b.place = e.place and b.idx = e.e - 12")
def credit_flow(spark, sf_dir):
    m = months(spark, sf_dir)
    return rounded(C.credit_flow(column(m, "n"), column(m, F.floor(F.col("n") / 2))))


@query(f"with {M}, e as (select place, max(idx) e from m group by 1) select e.place, e idx, round(a.value, 6) as value, round(b.value, 6) year_ago from e join m a on a.place = e.place and a.idx = e left join m b on b.place = e.place and b.idx = e - 12")
def rate_mix(spark, sf_dir):
    return rounded(C.last_and_year_ago(column(months(spark, sf_dir), "value")))


TYPES = "t as (select o_orderpriority kind, year(o_orderdate)::bigint idx, count(*)::double as value from orders where year(o_orderdate) <= 2000 group by 1, 2), tp as (select o_orderpriority kind, (year(o_orderdate) * 4 + quarter(o_orderdate) - 1)::bigint idx, avg(o_totalprice) as value from orders group by 1, 2)"


@query(f"with {TYPES}, s as (select kind, idx, value / sum(value) over (partition by idx) s from t), e as (select max(idx) e from s), g as (select kind, idx, value / lag(value, 4) over (partition by kind order by idx) - 1 g from tp) select kind, round(max(s) filter (s.idx = e), 6) share_now, round(max(s) filter (s.idx = e - 5), 6) share_before, (select round(max_by(g, idx), 6) from g where g.kind = s.kind) price_growth_1y from s cross join e group by 1")
def typology_mix_years(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    keyed = orders.select(F.col("o_orderpriority").alias("kind"), F.year("o_orderdate").cast("bigint").alias("y"), (F.year("o_orderdate") * 4 + F.quarter("o_orderdate") - 1).cast("bigint").alias("q"), "o_totalprice")
    yearly = keyed.where("y <= 2000").groupBy("kind", F.col("y").alias("idx")).agg(F.count("*").cast("double").alias("value"))
    prices = keyed.groupBy("kind", F.col("q").alias("idx")).agg(F.avg("o_totalprice").alias("value"))
    return rounded(C.typology_mix(yearly, prices))


@query(f"with {M}, {Y}, a as (select place, idx // 12 idx, sum(n)::double as value from m group by 1, 2 having count(*) = 12), k as (select place, idx, value s from y where idx % 2 = 0) select a.place, a.idx::bigint idx, a.value, round(a.value / (select max_by(s, k.idx) from k where k.place = a.place and k.idx <= a.idx) * 1000, 6) per_1000 from a")
def supply_series(spark, sf_dir):
    stock = column(years(spark, sf_dir), "value").where("idx % 2 = 0")
    return rounded(C.supply_series(column(months(spark, sf_dir), "n"), "month", stock))


@query(f"with {M}, b as (select *, row_number() over (partition by place order by idx desc) b from m) select place, max(idx) until, (sum(n) filter (b <= 12))::double as last, round((sum(n) filter (b <= 12))::double / nullif(sum(n) filter (b between 13 and 24), 0) - 1, 6) change from b where b <= 24 group by 1 having count(*) = 24")
def recent_total(spark, sf_dir):
    return rounded(C.recent_total(column(months(spark, sf_dir), "n"), 12))


RATES = "rm as (select (year(l_shipdate) * 12 + month(l_shipdate) - 1)::bigint idx, avg(l_discount) * 100 as value from lineitem group by 1), rq as (select idx // 3 idx, avg(value) rate from rm group by 1)"
PAYMENT = "({0} * 81 * (rate / 1200) / (1 - pow(1 + rate / 1200, -360)))"
EFFORT = f"ef as (select q.place, q.idx, {PAYMENT.format('q.value')} payment, (select max_by(y.value, y.idx) from y where y.place = q.place and y.idx <= q.idx // 4 and y.idx % 4 <> 3 and q.idx // 4 - y.idx <= 2 and y.value > 0 and y.idx > 1993) v, (select max(y.idx) from y where y.place = q.place and y.idx <= q.idx // 4 and y.idx % 4 <> 3) vy from q join rq using (idx)), en as (select place, idx, payment, payment / (v / 12) effort_tax from ef)"


def effort(spark, sf_dir):
    rates = table(spark, sf_dir, "lineitem").groupBy((F.year("l_shipdate") * 12 + F.month("l_shipdate") - 1).cast("bigint").alias("idx")).agg((F.avg("l_discount") * 100).alias("value"))
    income = column(years(spark, sf_dir), "value").where("idx % 4 <> 3")
    return C.effort_history(column(quarters(spark, sf_dir), "value"), rates, {"tax": income}, {"tax": 12})


@query(f"with {Q}, {Y}, {RATES}, {EFFORT} select place, idx, round(payment, 4) payment, round(effort_tax, 6) effort_tax from en")
def effort_history(spark, sf_dir):
    return rounded(effort(spark, sf_dir), 6, payment=4)


@query(f"with {Q}, {Y}, {RATES}, {EFFORT} select idx, round(quantile_cont(effort_tax, 0.5), 6) effort_tax from en where effort_tax is not null group by 1")
def effort_medians(spark, sf_dir):
    return rounded(C.effort_medians(effort(spark, sf_dir), ["tax"]))


@query(f"with {Q}, {Y}, {RATES}, {EFFORT}, h as (select * from en where effort_tax is not null), e as (select min(idx) a, max(idx) b from h) select x.place, round(x.effort_tax, 6) as \"first\", round(z.effort_tax, 6) as \"last\", round(z.effort_tax - x.effort_tax, 6) change, z.effort_tax >= 2 * x.effort_tax doubled from h x join e on x.idx = e.a join h z on z.place = x.place and z.idx = e.b")
def effort_risers(spark, sf_dir):
    return rounded(C.effort_risers(effort(spark, sf_dir), "tax"))


@query(f"with {Q}, {Y}, {RATES}, {EFFORT} select place, round(min(effort_tax), 6) low, arg_min(idx, (effort_tax, idx)) low_at, round(max(effort_tax), 6) high, arg_min(idx, (-effort_tax, idx)) high_at from en where effort_tax is not null group by 1")
def effort_extremes(spark, sf_dir):
    return rounded(C.extremes(effort(spark, sf_dir), "effort_tax"))


@query(f"with {M}, b as (select place, avg(value) b from m where idx between 23976 and 23987 group by 1), e as (select place, max(idx) e from m group by 1) select e.place, e until, round(a.value / nullif(p.value, 0) - 1, 6) yoy, round(a.value / nullif(b.b, 0) - 1, 6) since from e join m a on a.place = e.place and a.idx = e left join m p on p.place = e.place and p.idx = e - 12 left join b on b.place = e.place")
def construction_costs(spark, sf_dir):
    return rounded(C.since_base(column(months(spark, sf_dir), "value"), 23976, 23987, 12))


@query(f"with {Y}, {M}, e as (select max(idx) e from y), l as (select place, max(value) filter (idx = e) income, max(value) filter (idx = e) / nullif(max(value) filter (idx = e - 1), 0) - 1 income_growth_1y, max(n) filter (idx = e) beds, max(n - urgent) filter (idx = e) b1, max(urgent) filter (idx = e) b2 from y cross join e group by 1), me as (select max(idx) e from m), g as (select place, sum(n) filter (idx > e - 12) a, count(*) filter (idx > e - 12) k, sum(n) filter (idx between e - 23 and e - 12) b, count(*) filter (idx between e - 23 and e - 12) kb from m cross join me group by 1) select place, round(income, 4) income, round(income_growth_1y, 6) income_growth_1y, beds, (coalesce(b1, 0) + coalesce(b2, 0))::double households, round(b1 / nullif(coalesce(b1, 0) + coalesce(b2, 0), 0), 6) share_1, round(b2 / nullif(coalesce(b1, 0) + coalesce(b2, 0), 0), 6) share_2, case when k = 12 then a::double end guests_12m, round(case when k = 12 and kb = 12 and b > 0 then a / b::double - 1 end, 6) guests_growth_1y, round(beds / income * 100, 6) beds_per_100 from l full join g using (place)")
def context_features(spark, sf_dir):
    y, m = stored(years(spark, sf_dir)), stored(months(spark, sf_dir))
    brackets = [column(y, F.col("n") - F.col("urgent")), column(y, "urgent")]
    out = C.context_features({"income": column(y, "value"), "beds": column(y, "n")}, ("income",), brackets, column(m, "n"), per_100={"beds_per_100": ("beds", "income")})
    return rounded(out, 6, income=4)


COUNTRIES = "x as (select q.place, q.idx, q.value / nullif(d.value, 0) v from q join d using (idx) where not (q.place % 5 = 0 and q.idx > 8000)), b as (select place, avg(v) m from x where idx between 7988 and 7991 group by 1 having count(*) = 4), z as (select x.place, idx, v * 100 / m r from x join b using (place) where place in (select place from x group by 1 having count(*) >= 20)), k as (select place, max(idx) e from z group by 1), t as (select max(a.e) t from (select distinct e from k) a where (select count(*) from k where k.e >= a.e) >= (select count(*) from k) * 2 / 3.0)"


@query(f"with {Q}, {D}, {COUNTRIES}, o as (select z.place, z.idx, z.r / 100 - 1 r, q.value / 100 - 1 nom, z.r / nullif(a.r, 0) - 1 r1, z.r / nullif(c.r, 0) - 1 r5, z.r / (select max(r) from z w where w.place = z.place and w.idx <= z.idx) - 1 fp from z join t on z.idx = t.t left join q on q.place = z.place and q.idx = z.idx left join z a on a.place = z.place and a.idx = z.idx - 4 left join z c on c.place = z.place and c.idx = z.idx - 20) select place, idx, round(r, 6) as \"real\", round(nom, 4) nominal, round(r1, 6) real_1y, round(r5, 6) real_5y, round(fp, 6) from_peak, (row_number() over (order by r desc, place))::int as \"position\", case when r1 is not null then (row_number() over (order by r1 desc nulls last, place))::int end position_1y from o")
def compare_countries(spark, sf_dir):
    q = column(quarters(spark, sf_dir), "value")
    d = deflator(spark, sf_dir).crossJoin(q.select("place").distinct()).select("place", "idx", "value")
    own = q.where("not (place % 5 = 0 and idx > 8000)")
    return rounded(C.compare_countries(own, d, 1997), 6, nominal=4)


@query(f"with {Q}, {PHASES} select count(*)::bigint n, round(quantile_cont(v, 0.5), 6) median, round(avg((v > 0)::int), 6) share_positive from ph")
def demand(spark, sf_dir):
    return rounded(C.demand(phases(spark, sf_dir), "val_count_growth_1y"))


@query(f"with {Q}, {PHASES} select sum(n)::double total, round(sum(n / (1 + v)), 4) as \"before\", round(sum(n) / sum(n / (1 + v)) - 1, 6) growth from ph where v > -1")
def volume_growth(spark, sf_dir):
    return rounded(C.volume_growth(phases(spark, sf_dir), "val_count", "val_count_growth_1y"), 6, before=4)
