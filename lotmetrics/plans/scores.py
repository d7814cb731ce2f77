"""Queries of the features, scores and index construction."""

from pyspark.sql import functions as F

from ..operators import features as S
from ..operators import indices as I
from .base import query, r, rounded
from .panels import D, M, Q, Y, column, deflator, months, quarters, stored, years

PR = "case when {0} is not null then 100.0 * (rank() over (partition by {0} is null order by {0}) + (count(*) over (partition by {0}) - 1) / 2.0) / count({0}) over (partition by {0} is null) end"


def features_sql(source: str, tag: str = "", supply: bool = True) -> str:
    """The features of the frame `source` as CTEs that end with f{tag}."""
    lag = lambda k: f"max(value) filter (idx = (select max(idx) from {source}) - {k})"
    year = lambda v, k: f"max({v}) filter (idx = (select max(idx) from y) - {k})"
    return f"""k{tag} as (select idx, row_number() over (order by idx desc) b from (select distinct idx from {source})),
s{tag} as (select a.place, ln(a.value) - ln(b.value) step from (select {source}.*, b from {source} join k{tag} using (idx) where b <= 13 and value > 0) a join (select {source}.*, b from {source} join k{tag} using (idx) where b <= 13 and value > 0) b on b.place = a.place and b.b = a.b + 1),
v{tag} as (select place, stddev_samp(step) volatility from s{tag} group by 1),
g{tag} as (select place, {lag(0)} price, {lag(0)} / nullif({lag(4)}, 0) - 1 g1, {lag(0)} / nullif({lag(12)}, 0) - 1 g3, {lag(0)} / nullif({lag(20)}, 0) - 1 g5 from {source} group by 1),
r{tag} as (select place, {year('value', 0)} / 25 rent, {year('value', 0)} / nullif({year('value', 1)}, 0) - 1 rent_growth, {year('n', 0)} / nullif({year('n', 3)}, 0) - 1 pg, {year('urgent', 0)} / nullif({year('urgent', 3)}, 0) - 1 cg from y group by 1),
j{tag} as (select g{tag}.*, rent, rent_growth, rent * 12 / nullif(price, 0) gross_yield, pg, cg, volatility from g{tag} left join r{tag} using (place) left join v{tag} using (place)),
p{tag} as (select *, {PR.format('g1')} p1, {PR.format('g3')} p3, 100 - {PR.format('gross_yield')} py, 100 - {PR.format('pg')} pp, 100 - {PR.format('cg')} pc from j{tag}),
q{tag}_ as (select *, list_avg(list_filter([p1, p3, py], lambda x: x is not null)) val, {'list_avg(list_filter([pp, pc], lambda x: x is not null))' if supply else 'null::double'} sup, coalesce(volatility >= (select case when count(volatility) >= 10 then quantile_cont(volatility, 0.9) end from j{tag}), false) volatile from p{tag}),
w{tag} as (select *, list_avg(list_filter([val, sup], lambda x: x is not null)) raw from q{tag}_),
f{tag} as (select *, case when volatile then 50 + 5e-1 * (raw - 50) else raw end score, case when (case when volatile then 50 + 5e-1 * (raw - 50) else raw end) <= 40 then 'green' when (case when volatile then 50 + 5e-1 * (raw - 50) else raw end) <= 70 then 'amber' when raw is not null then 'red' end band from w{tag})"""


def yearly(spark, sf_dir):
    y = stored(years(spark, sf_dir))
    return column(y, F.col("value") / 25), column(y, "n"), column(y, "urgent")


def features_of(spark, sf_dir):
    rent, n, urgent = yearly(spark, sf_dir)
    return S.municipal_features(column(stored(quarters(spark, sf_dir)), "value"), rent, permits=n, completed=urgent)


@query(f"with {Q}, {Y}, {features_sql('q')} select place, round(price, 4) price, round(g1, 6) price_growth_1y, round(g5, 6) price_growth_5y, round(rent, 4) rent, round(gross_yield, 6) gross_yield, round(val, 4) score_valuation, round(sup, 4) score_supply, round(volatility, 6) volatility, volatile, round(score, 4) score_overall, band from f")
def municipal_features(spark, sf_dir):
    rows = features_of(spark, sf_dir)
    return rows.select("place", r("price", 4).alias("price"), *[r(c).alias(c) for c in ("price_growth_1y", "price_growth_5y", "gross_yield", "volatility")], *[r(c, 4).alias(c) for c in ("rent", "score_valuation", "score_supply", "score_overall")], "volatile", "band")


@query(f"with {Q}, {D}, e as (select least((select max(idx) from q), (select max(idx) from d)) e), i as (select max_by(value, idx) filter (idx <= (select e from e)) a, max_by(value, idx) filter (idx <= (select e from e) - 4) b1, max_by(value, idx) filter (idx <= (select e from e) - 12) b3 from d), l as (select max(idx) m from q) select q.place, round((q.value / b.value) / (i.a / i.b1) - 1, 6) price_growth_1y_real, round((q.value / c.value) / (i.a / i.b3) - 1, 6) price_growth_3y_real from q cross join i left join q b on b.place = q.place and b.idx = q.idx - 4 left join q c on c.place = q.place and c.idx = q.idx - 12 where q.idx = (select m from l)")
def real_growth_aligned(spark, sf_dir):
    sales = column(stored(quarters(spark, sf_dir)), "value")
    rows = S.real_growth(S.municipal_features(sales), sales, stored(deflator(spark, sf_dir)))
    return rows.where("price is not null").select("place", r("price_growth_1y_real").alias("price_growth_1y_real"), r("price_growth_3y_real").alias("price_growth_3y_real"))


@query(f"with {Q} , k as (select idx, row_number() over (order by idx desc) b from (select distinct idx from q)), s as (select a.place, ln(a.value) - ln(b.value) step from (select q.*, b from q join k using (idx) where b <= 13) a join (select q.*, b from q join k using (idx) where b <= 13) b on b.place = a.place and b.b = a.b + 1) select place, round(stddev_samp(step), 6) volatility from s group by 1")
def log_volatility(spark, sf_dir):
    return rounded(S.volatility(column(quarters(spark, sf_dir), "value")).drop("steps"))


Z = "case when count({0}) >= 8 and stddev_samp({0}) <> 0 then (max_by({0}, idx) - avg({0})) / stddev_samp({0}) end"
NATIONAL = f"""g as (select *, value / nullif(lag(value, 4) over w, 0) - 1 g, row_number() over w x, ln(value) l from q window w as (partition by place order by idx)),
a as (select place, max_by(g, idx) v, {Z.format('g')} z from g group by 1 having count(*) >= 20),
t as (select place, (max_by(l, idx) - avg(l) - regr_slope(l, x) * (max(x) - avg(x))) / sqrt((regr_syy(l, x) - regr_slope(l, x) * regr_sxy(l, x)) / (count(*) - 1)) z from g group by 1 having count(*) >= 20),
h as (select *, value - lag(value, 12) over (partition by place order by idx) g from m), b as (select place, max_by(g, idx) v, {Z.format('g')} z from h group by 1 having count(*) >= 24),
c as (select place, max_by(n, idx)::double v, {Z.format('n')} z from q group by 1 having count(*) >= 8),
u as (select place, 'growth' component, v, z from a union all select place, 'trend', z, z from t union all select place, 'rates', v, z from b union all select place, 'credit', v, z from c)"""


def national(spark, sf_dir):
    q = quarters(spark, sf_dir)
    return S.national_scores(column(q, "value"), column(months(spark, sf_dir), "value"), column(q, "n"))


@query(f"with {Q}, {M}, {NATIONAL} select place, component, round(v, 4) as value, round(100 / (1 + exp(-z)), 4) score from u")
def national_components(spark, sf_dir):
    return national(spark, sf_dir).select("place", F.explode("components").alias("component", "x")).select("place", "component", r("x.value", 4).alias("value"), r("x.score", 4).alias("score"))


@query(f"with {Q}, {M}, {NATIONAL}, o as (select place, avg(100 / (1 + exp(-z))) overall from u group by 1) select place, round(overall, 4) overall, case when overall < 40 then 'green' when overall < 70 then 'amber' else 'red' end band from o")
def national_scores(spark, sf_dir):
    return national(spark, sf_dir).select("place", r("overall", 4).alias("overall"), "band")


CHANGES = f"with {Q}, {Y}, b4 as (select * from q where idx < (select max(idx) from q)), {features_sql('q', '1', False)}, {features_sql('b4', '2', False)}, c as (select a.place, a.price, b.price price_prev, a.price / nullif(b.price, 0) - 1 qoq, a.score, b.score score_prev, a.band, b.band band_prev, a.volatile, sign(case a.band when 'green' then 0 when 'amber' then 1 when 'red' then 2 end - case b.band when 'green' then 0 when 'amber' then 1 when 'red' then 2 end)::int moved from f1 a left join f2 b using (place))"


def changes(spark, sf_dir):
    return S.quarter_changes(column(stored(quarters(spark, sf_dir)), "value"), yearly(spark, sf_dir)[0])


@query(f"{CHANGES} select place, round(price, 4) price, round(price_prev, 4) price_prev, round(qoq, 6) qoq, round(score, 4) score, round(score_prev, 4) score_prev, round(score - score_prev, 4) dscore, band, band_prev, volatile, moved from c")
def quarter_changes(spark, sf_dir):
    return rounded(changes(spark, sf_dir), 4, qoq=6)


@query(f"{CHANGES} select count(qoq)::bigint n, round(quantile_cont(qoq, 0.5), 6) median_qoq, round(avg((qoq > 0)::int), 6) share_up, (count(*) filter (moved > 0))::bigint band_up, (count(*) filter (moved < 0))::bigint band_down, (count(*) filter (band = 'red'))::bigint red, (count(*) filter (band_prev = 'red'))::bigint red_prev from c")
def change_summary(spark, sf_dir):
    return rounded(S.change_summary(changes(spark, sf_dir)))


@query(f"with {M}, e as (select max(idx) e from m), l as (select place, max(value) filter (idx = e) a0, max(value) filter (idx = e - 1) a1, max(value) filter (idx = e - 2) a2, max(value) filter (idx = e - 12) b0, max(value) filter (idx = e - 13) b1, max(value) filter (idx = e - 14) b2, max(n) filter (idx = e) n0, max(n) filter (idx = e - 12) n1 from m cross join e group by 1), k as (select *, list_avg(list_filter([a0, a1, a2], lambda x: x is not null)) now_, list_avg(list_filter([b0, b1, b2], lambda x: x is not null)) ago from l) select place, round(now_, 4) val_apt, round(now_ / ago - 1, 6) val_apt_growth_1y, n0::double val_count, round(n0 / nullif(n1, 0) - 1, 6) val_count_growth_1y, round(now_ / n0 - 1, 4) premium from k")
def extra_features(spark, sf_dir):
    m = months(spark, sf_dir)
    out = S.extra_features({}, {"val_apt": column(m, "value")}, {"val_count": column(m, "n")}, {}, {"premium": ("val_apt", "val_count")})
    return rounded(out, 6, val_apt=4, premium=4)


REAL = "x as (select q.place, q.idx, q.value / nullif(d.value, 0) * 100 v from q join d using (idx) where q.value / nullif(d.value, 0) is not null), b as (select place, avg(v) m, count(*) n from x where idx between 7988 and 7991 group by 1), ri as (select x.place, x.idx, case when n = 4 then v * 100 / m else v end as value from x left join b using (place))"


@query(f"with {Q}, {D}, {REAL} select place, idx, round(value, 6) as value from ri")
def real_index(spark, sf_dir):
    return rounded(I.real_index(column(quarters(spark, sf_dir), "value"), deflator(spark, sf_dir).withColumn("place", F.lit(None)).crossJoin(quarters(spark, sf_dir).select(F.col("place").alias("p")).distinct()).select(F.col("p").alias("place"), "idx", "value"), 1997))


@query(f"""with {Q}, {D}, {Y}, {REAL}, l as (select place, max(idx) e from ri group by 1), k as (select l.place, e, a.value r1, b.value r0, c.value p1, d0.value p0 from l join ri a on a.place = l.place and a.idx = e join ri b on b.place = l.place and b.idx = e - 20 join q c on c.place = l.place and c.idx = e join q d0 on d0.place = l.place and d0.idx = e - 20 where b.value > 0),
a as (select place, idx // 4 yr, avg(value) lv from q group by 1, 2), z as (select k.place, avg(y.value / 25 * 12 / lv) gross, count(*) n from k join y on y.place = k.place and y.idx between (e - 20) // 4 and e // 4 join a on a.place = k.place and a.yr = y.idx group by 1 having count(*) >= 3)
select place, round(pow(r1 / r0, 2e-1) - 1, 6) price_real, round(pow((p1 / r1) / (p0 / r0), 2e-1) - 1, 6) inflation, round(gross * 75e-2, 6) yield_net, round(pow(r1 / r0, 2e-1) - 1 + gross * 75e-2, 6) total, n::bigint rent_years from k join z using (place)""")
def total_return(spark, sf_dir):
    q = column(quarters(spark, sf_dir), "value")
    d = deflator(spark, sf_dir).crossJoin(q.select("place").distinct()).select("place", "idx", "value")
    return rounded(S.total_return(q, I.real_index(q, d, 1997), yearly(spark, sf_dir)[0]))


@query(f"with {M} select place, (idx // 12)::bigint idx, round(sum(n), 6) as value from m group by 1, 2 having count(*) = 12")
def to_annual(spark, sf_dir):
    return rounded(I.to_annual(column(months(spark, sf_dir), "n"), "month"))


@query(f"with {M}, e as (select max(idx) e from m), g as (select place, sum(n) filter (idx > e - 12) a, count(*) filter (idx > e - 12) ka, sum(n) filter (idx between e - 23 and e - 12) b, count(*) filter (idx between e - 23 and e - 12) kb from m cross join e group by 1) select place, a::double as now, round(case when kb = 12 and b > 0 then a / b - 1 end, 6) growth from g where ka = 12")
def last_twelve(spark, sf_dir):
    return rounded(I.last_twelve(column(months(spark, sf_dir), "n")))


@query(f"with {M} select place, (idx // 3)::bigint idx, round(avg(value), 6) as value from m group by 1, 2 having count(*) >= 2")
def two_month_quarters(spark, sf_dir):
    return rounded(I.monthly_to_quarterly(column(months(spark, sf_dir), "value"), 2))


BASES = "a as (select place, idx, value from m where idx < 23990), b as (select place, idx, value * 3 + idx % 5 as value from m where idx >= 23980 and idx < 24010), c as (select place, idx, value / 2 as value from m where idx >= 24000)"
LINK = "{0} as (select place, avg(x.value / y.value) k from {1} x join {2} y using (place, idx) where y.value <> 0 group by 1), {3} as (select * from {1} union all select y.place, y.idx, y.value * k from {2} y join {0} using (place) where y.idx > (select max(idx) from {1} x where x.place = y.place))"


@query(f"with {M}, {BASES}, {LINK.format('k1', 'a', 'b', 's1')}, {LINK.format('k2', 's1', 'c', 's2')} select place, idx, round(value, 6) as value from s2")
def chained_index(spark, sf_dir):
    m = column(months(spark, sf_dir), "value")
    return rounded(I.chained(m.where("idx < 23990"), column(m.where("idx >= 23980 and idx < 24010"), F.col("value") * 3 + F.col("idx") % 5), column(m.where("idx >= 24000"), F.col("value") / 2)))


@query(f"with recursive {M}, a as (select place, idx, value from m where idx < 23976), t as (select place, idx, (idx % 7) - 2.0 as rate from m where idx >= 23970 and not (place % 4 = 1 and idx = 23980)), e as (select place, max(idx) e from a group by 1), o as (select place, idx, rate, e, row_number() over (partition by place order by idx) k from t join e using (place) where idx > e), s as (select place, 0 k, map_from_entries(list((idx, value))) v from a group by 1 union all select s.place, s.k + 1, map_concat(s.v, map([o.idx], [s.v[o.idx - 12] * (1 + o.rate / 100)])) from s join o on o.place = s.place and o.k = s.k + 1 where s.v[o.idx - 12] is not null), f as (select place, unnest(map_entries(max_by(v, k))) x from s group by 1) select place, x.key idx, round(x.value, 6) as value from f")
def extended_index(spark, sf_dir):
    m = column(months(spark, sf_dir), "value")
    rates = column(m.where((F.col("idx") >= 23970) & ~((F.col("place") % 4 == 1) & (F.col("idx") == 23980))), F.col("idx") % 7 - 2)
    return rounded(I.extended_by_rates(m.where("idx < 23976"), rates))


@query(f"with {M}, s as (select min(idx) a, max(idx) b from m where value > 0), p as (select distinct place from m), g as (select place, unnest(generate_series(a, b)) idx from p cross join s), v as (select g.place, g.idx, m.value from g left join m using (place, idx)) select place, idx, round(case when count(value) over w >= 2 then ln(avg(value) over w) end, 6) as value from v window w as (partition by place order by idx rows between 2 preceding and current row)")
def rolling_log(spark, sf_dir):
    return rounded(I.rolling_log(column(months(spark, sf_dir), "value")))


@query(f"with {M}, h as (select * from m where (idx + place) % 6 < 2), s as (select min(idx) a, max(idx) b from h), p as (select distinct place from h), g as (select place, unnest(generate_series(a, b)) idx from p cross join s), v as (select g.place, g.idx, ln(h.value) as value from g left join h using (place, idx)) select place, idx, round(last_value(value ignore nulls) over (partition by place order by idx rows between 3 preceding and current row), 6) as value from v")
def bounded_fill(spark, sf_dir):
    return rounded(I.filled(I.log_grid(column(months(spark, sf_dir), "value").where((F.col("idx") + F.col("place")) % 6 < 2)), 3))


@query(f"with {M}, {Q} select q.place, q.idx, round(avg(m.value), 6) as mean from q join m on m.place = q.place and m.idx between q.idx * 3 - 9 and q.idx * 3 + 2 group by 1, 2 having count(*) >= 9")
def window_mean(spark, sf_dir):
    return rounded(I.window_mean(column(months(spark, sf_dir), "value"), quarters(spark, sf_dir)))


@query(f"with {M}, o as (select * from m where idx < 24000), n as (select place, idx, value * 2 as value from m where place % 3 = 0) select place, idx, round(value, 6) as value from n union all select place, idx, round(value, 6) from o where place not in (select place from n)")
def upsert(spark, sf_dir):
    m = column(months(spark, sf_dir), "value")
    return rounded(I.upserted(m.where("idx < 24000"), column(m.where("place % 3 = 0"), F.col("value") * 2), "place"))
