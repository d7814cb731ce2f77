"""Queries of backtests, forecast features and the forecast archive."""

from pyspark.sql import functions as F

from ..operators import evaluation as E
from ..operators import indices as I
from ..operators import models
from ..operators import panel as P
from ..operators import signals as S
from ..operators.models import POLYNOMIAL as P0
from ..operators.models import TAIL
from .base import query, r, rounded
from .panels import D, M, Q, Y, column, deflator, months, quarters, stored, table, years
from .ridgesql import known, predicted, ridge

W_ = "window w as (partition by place order by idx rows unbounded preceding)"
ZW = "case when count({0}) over w >= 8 and stddev_samp({0}) over w <> 0 then ({0} - avg({0}) over w) / stddev_samp({0}) over w end"
HISTORY = f"""rm as (select (year(l_shipdate) * 12 + month(l_shipdate) - 1)::bigint idx, avg(l_discount) * 100 as value from lineitem group by 1),
g as (select *, value / nullif(lag(value, 4) over (partition by place order by idx), 0) - 1 g, row_number() over (partition by place order by idx) x, ln(value) l from q),
h as (select place, idx, x, {ZW.format('g')} zg, (l - avg(l) over w - regr_slope(l, x) over w * (x - avg(x) over w)) / sqrt((regr_syy(l, x) over w - regr_slope(l, x) over w * regr_sxy(l, x) over w) / (nullif(count(*) over w - 1, 0))) zt, {ZW.format('n')} zc from g {W_}),
rc as (select idx, value - lag(value, 12) over (order by idx) c, row_number() over (order by idx) k from rm), rz as (select idx, k, case when count(c) over w2 >= 8 and stddev_samp(c) over w2 <> 0 then (c - avg(c) over w2) / stddev_samp(c) over w2 end z from rc window w2 as (order by idx rows unbounded preceding)),
s0 as (select place, h.idx, 100 / (1 + exp(-zg)) a, case when x >= 20 then 100 / (1 + exp(-zt)) end b, 100 / (1 + exp(-zc)) c, case when h.idx // 4 >= 1998 then 100 / (1 + exp(-(select max_by(z, rz.idx) from rz where rz.idx <= h.idx * 3 + 2 and rz.k >= 24))) end d from h where x >= 20),
hist as (select *, list_avg(list_filter([a, b, c, d], lambda v: v is not null)) score from s0)"""


def history(spark, sf_dir):
    q = stored(quarters(spark, sf_dir))
    rates = table(spark, sf_dir, "lineitem").groupBy((F.year("l_shipdate") * 12 + F.month("l_shipdate") - 1).cast("bigint").alias("idx")).agg((F.avg("l_discount") * 100).alias("value"))
    since = q.select("place").distinct().withColumn("year", F.lit(1998))
    return E.national_history(column(q, "value"), rates, column(q, "n"), since, 20)


@query(f"with {Q}, {HISTORY} select place, idx, round(score, 4) score, round(a, 4) growth_score, round(c, 4) credit_score, case when score < 40 then 'green' when score < 70 then 'amber' else 'red' end band from hist")
def national_history(spark, sf_dir):
    return rounded(history(spark, sf_dir), 4)


OUT = f"""b as (select q.place, avg(q.value / d.value * 100) m, count(*) n from q join d using (idx) where idx between 7988 and 7991 group by 1), rl as (select q.place, q.idx, q.value nom, q.value / nullif(d.value, 0) * 100 * case when b.n = 4 then 100 / b.m else 1 end v from q left join d using (idx) left join b on b.place = q.place),
oc as (select a.place, a.idx, {", ".join(f"x{h}.nom / nullif(a.nom, 0) - 1 ret_nom_{h}q, x{h}.v / nullif(a.v, 0) - 1 ret_real_{h}q" for h in (4, 8, 12))}, (select case when count(f.v) = 12 then min(f.v) end from rl f where f.place = a.place and f.idx between a.idx + 1 and a.idx + 12) / nullif(a.v, 0) - 1 drawdown from rl a {" ".join(f"left join rl x{h} on x{h}.place = a.place and x{h}.idx = a.idx + {h}" for h in (4, 8, 12))}),
ev as (select *, (drawdown <= -1e-1)::int event from oc)"""


def evaluated(spark, sf_dir):
    return outcomes_of(stored(quarters(spark, sf_dir)), deflator(spark, sf_dir))


def outcomes_of(q, d):
    prices = stored(d).join(q.select("place").distinct(), F.lit(True)).select("place", "idx", "value")
    return E.outcomes(column(q, "value"), prices, 1997)


@query(f"with {Q}, {D}, {OUT} select place, idx, {', '.join(f'round(ret_nom_{h}q, 6) ret_nom_{h}q, round(ret_real_{h}q, 6) ret_real_{h}q' for h in (4, 8, 12))}, round(drawdown, 6) drawdown, event from ev")
def outcomes(spark, sf_dir):
    return rounded(evaluated(spark, sf_dir))


def pooled(spark, sf_dir):
    """A score for every quarter: the level's percentile in its place, so that there are outcomes to judge."""
    q = stored(quarters(spark, sf_dir))
    rows = outcomes_of(q, deflator(spark, sf_dir)).join(q.select("place", "idx", F.col("n").alias("score")), ["place", "idx"])
    return stored(rows.withColumn("group", F.col("place") % 3))


POOL = f"{OUT}, po as (select ev.*, q.n score, ev.place % 3 grp from ev join q using (place, idx))"


@query(f"with {Q}, {D}, {POOL}, t as (select grp, t::double threshold, score >= t alarm, event from po, (values (8), (24)) v(t) where event is not null), c as (select grp, threshold, count(*) filter (alarm and event = 1) tp, count(*) filter (event = 1) n1, count(*) filter (alarm and event = 0) fp, count(*) filter (event = 0) n0 from t group by 1, 2) select grp as \"group\", threshold, round(case when n1 > 0 and n0 > 0 then tp / n1 end, 6) hit_rate, round(case when n1 > 0 and n0 > 0 then fp / n0 end, 6) false_alarm_rate, n1::bigint n_events, n0::bigint n_no_events from c")
def alarm_rates(spark, sf_dir):
    return rounded(E.alarm_rates(pooled(spark, sf_dir), "score", (8, 24)))


RK = "(rank() over (partition by {1} order by {0}) + (count(*) over (partition by {1}, {0}) - 1) / 2e0)"


@query(f"with {Q}, {D}, {POOL}, a as (select grp, {RK.format('score', 'grp')} x, {RK.format('ret_real_12q', 'grp')} y from po where ret_real_12q is not null), c as (select grp, corr(x, y) rho from a group by 1 having count(*) >= 5), u as (select grp, event, {RK.format('score', 'grp')} k from po where event is not null), v as (select grp, sum(k) filter (event = 1) s, count(*) filter (event = 1)::double p, count(*) filter (event = 0)::double n from u group by 1), n as (select grp, count(*) n from po group by 1) select n.grp as \"group\", n.n::bigint n, round(rho, 6) spearman_real_12q, round((s - p * (p + 1) / 2) / nullif(p * v.n, 0), 6) auc_drawdown from n left join c using (grp) left join v using (grp)")
def score_summary(spark, sf_dir):
    return rounded(E.summary(pooled(spark, sf_dir), "score").select("group", "n", "spearman_real_12q", "auc_drawdown"))


@query(f"with {Q}, {D}, {POOL}, p as (select distinct place lo from po), o as (select p.lo, po.* from po join p on po.place <> p.lo), u as (select lo, event, {RK.format('score', 'lo')} k from o where event is not null), v as (select lo, sum(k) filter (event = 1) s, count(*) filter (event = 1)::double p, count(*) filter (event = 0)::double n from u group by 1), a as (select lo, {RK.format('score', 'lo')} x, {RK.format('ret_real_12q', 'lo')} y from o where ret_real_12q is not null), c as (select lo, corr(x, y) rho from a group by 1 having count(*) >= 5) select coalesce(v.lo, c.lo) place, round(rho, 6) rho, round((s - p * (p + 1) / 2) / nullif(p * n, 0), 6) auc from v full join c on c.lo = v.lo")
def leave_one_out(spark, sf_dir):
    return rounded(E.left_out(pooled(spark, sf_dir), "score"))


@query(f"with {Q}, {D}, {POOL}, e as (select *, coalesce(event = 1, false) one from po), f as (select *, sum((one and not coalesce(lag_, false))::int) over (partition by place order by idx) run from (select *, lag(one) over (partition by place order by idx) lag_ from e)) select place, min(idx) as \"first\", max(idx) as \"last\", bool_or(score >= 10) signalled from f where one group by place, run")
def episode_hits(spark, sf_dir):
    return E.episode_hits(pooled(spark, sf_dir), "score", 10)


# the archive


def forecasts(spark, sf_dir):
    q = quarters(spark, sf_dir).where("idx % 3 = 0")
    mid = F.col("value") * (1 + 0.01 * (F.col("place") % 5 - 2))
    rows = q.withColumn("h", F.explode(F.array(F.lit(1), F.lit(2))))
    return rows.select(
        F.when(F.col("place") % 2 == 0, "sales").otherwise("rent").alias("kind"), F.concat(F.lit("v:"), F.col("idx").cast("string")).alias("vintage"), F.col("idx").cast("string").alias("issued"), F.col("idx").cast("string").alias("origin"), "place", (F.col("idx") + F.col("h")).alias("target"), "h", mid.alias("mid"),
        F.when(F.col("place") % 3 != 0, mid * 0.96).alias("lo50"), F.when(F.col("place") % 3 != 0, mid * 1.04).alias("hi50"), (mid * 0.9).alias("lo80"), (mid * 1.1).alias("hi80"), F.when(F.col("place") != 7, F.col("value")).alias("last_actual"),
    )


def archived(spark, sf_dir):
    rows = forecasts(spark, sf_dir)
    return E.recorded(rows.where("target < 8000"), rows.where("target >= 7990"))


def confronted(spark, sf_dir):
    q = quarters(spark, sf_dir)
    actuals = q.select(F.when(F.col("place") % 2 == 0, "sales").otherwise("rent").alias("kind"), "place", F.col("idx").alias("target"), F.col("value").alias("actual"))
    return E.confronted(archived(spark, sf_dir), actuals)


ARCHIVE = """f as (select case when place % 2 = 0 then 'sales' else 'rent' end kind, 'v:' || idx vintage, idx::varchar issued, place, idx + h target, h, value * (1 + 1e-2 * (place % 5 - 2)) mid, case when place <> 7 then value end last_actual, place % 3 <> 0 has50 from q, (values (1), (2)) t(h) where idx % 3 = 0),
old as (select * from f where target < 8000), ar as (select * from old union all select * from f where target >= 7990 and last_actual is not null and not exists (select 1 from old o where o.kind = f.kind and o.vintage = f.vintage)),
cf as (select ar.*, q.value actual from ar left join q on q.place = ar.place and q.idx = ar.target), j as (select *, ln(actual / mid) err, ln(actual / last_actual) naive, actual between mid * 9e-1 and mid * 11e-1 in80, actual between mid * 96e-2 and mid * 104e-2 in50 from cf where actual is not null and last_actual is not null)"""


@query(f"with {Q}, {ARCHIVE} select kind, vintage, place, target, h::int h, round(mid, 4) mid from ar")
def archive_record(spark, sf_dir):
    return archived(spark, sf_dir).select("kind", "vintage", "place", "target", "h", r("mid", 4).alias("mid"))


@query(f"with {Q}, {ARCHIVE} select kind, h::int h, count(*)::bigint n, count(distinct vintage)::bigint vintages, count(distinct place)::bigint places, round(avg(abs(err)), 6) mae_model, round(avg(abs(naive)), 6) mae_naive, round(-avg(err), 6) bias, round(avg(in80::int), 6) coverage80, round(avg(in50::int) filter (has50), 6) coverage50, round(1 - avg(abs(err)) / avg(abs(naive)), 6) skill from j group by 1, 2")
def archive_accuracy(spark, sf_dir):
    return rounded(E.accuracy(confronted(spark, sf_dir), "kind", "h"))


@query(f"with {Q}, {ARCHIVE} select count(*)::bigint archived, count(distinct vintage)::bigint vintages, min(issued) first_issued, (count(*) filter (actual is null))::bigint pending, (select count(*) from j)::bigint evaluated from cf")
def archive_state(spark, sf_dir):
    return E.archive_state(confronted(spark, sf_dir))


@query(f"with {Q}, {ARCHIVE} select place, target, arg_min(issued, (issued, -h)) issued, arg_min(h, (issued, -h))::int h from j where kind = 'sales' group by 1, 2")
def archive_first(spark, sf_dir):
    return E.earliest_forecasts(confronted(spark, sf_dir), "sales").select("place", "target", "issued", "h")


EDGES = "ed as (select a.p place, b.p neighbour from (select distinct place p from q) a join (select distinct place p from q) b on abs(a.p - b.p) = 1)"


NINE = ("s_mom1", "s_mom4", "nat_lead", "v_mom", "v_lead", "nb_mom4", "rel_level", "eur_chg", "vol_chg")
NINE_SQL = f"""{EDGES}, rm as (select (year(l_shipdate) * 12 + month(l_shipdate) - 1)::bigint idx, avg(l_discount) * 100 as value from lineitem group by 1), nm as (select (year(o_orderdate) * 12 + month(o_orderdate) - 1)::bigint idx, ln(avg(o_totalprice)) l from orders group by 1),
s as (select place, idx, ln(value) l from q), v as (select place, idx, ln(value) l from m), vn as (select place, idx, ln(n) l from m),
f as (select a.place, a.idx, a.l - b.l s_mom1, a.l - c.l s_mom4, a.l - (select quantile_cont(x.l, 0.5) from s x where x.idx = a.idx) rel_level, n1.l - n0.l nat_lead, coalesce(v0.l - v12.l, n0.l - n12.l) v_mom, coalesce(v1.l - v0.l, n1.l - n0.l) v_lead, (select max_by(value, idx) from rm where rm.idx <= a.idx * 3 + 3) - (select max_by(value, idx) from rm where rm.idx <= a.idx * 3 - 9) eur_chg, c1.l - c0.l vc
from s a left join s b on b.place = a.place and b.idx = a.idx - 1 left join s c on c.place = a.place and c.idx = a.idx - 4 left join nm n0 on n0.idx = a.idx * 3 + 2 left join nm n1 on n1.idx = a.idx * 3 + 3 left join nm n12 on n12.idx = a.idx * 3 - 10
left join v v0 on v0.place = a.place and v0.idx = a.idx * 3 + 2 left join v v1 on v1.place = a.place and v1.idx = a.idx * 3 + 3 left join v v12 on v12.place = a.place and v12.idx = a.idx * 3 - 10 left join vn c1 on c1.place = a.place and c1.idx = a.idx * 3 + 3 left join vn c0 on c0.place = a.place and c0.idx = a.idx * 3 - 9),
ff as (select place, idx, s_mom1, s_mom4, nat_lead, v_mom, v_lead, coalesce((select avg(g.s_mom4) from ed join f g on g.place = ed.neighbour and g.idx = f.idx where ed.place = f.place), s_mom4) nb_mom4, rel_level, eur_chg, coalesce(vc, (select quantile_cont(g.vc, 0.5) from f g where g.idx = f.idx)) vol_chg from f)"""


def nine_features(spark, sf_dir):
    m = stored(months(spark, sf_dir))
    orders = table(spark, sf_dir, "orders")
    country = orders.groupBy((F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).cast("bigint").alias("idx")).agg(F.log(F.avg("o_totalprice")).alias("value")).select(F.lit(None).cast("bigint").alias("place"), "idx", "value")
    rates = table(spark, sf_dir, "lineitem").groupBy((F.year("l_shipdate") * 12 + F.month("l_shipdate") - 1).cast("bigint").alias("idx")).agg((F.avg("l_discount") * 100).alias("value"))
    sales = stored(column(quarters(spark, sf_dir), F.log("value")))
    edges = sales.select("place").distinct().select("place", F.explode(F.array(F.col("place") - 1, F.col("place") + 1)).alias("neighbour"))
    return sales, E.forecast_features(sales, column(m, F.log("value")).unionByName(stored(country)), stored(rates), edges, 1, column(m, F.log("n")))


@query(f"with {Q}, {M}, {NINE_SQL} select place, idx, {', '.join(f'round({x}, 6) {x}' for x in NINE)} from ff")
def forecast_features(spark, sf_dir):
    return rounded(nine_features(spark, sf_dir)[1])


HS = (1, 2, 4)
SIGMA = """dd as (select a.place, a.idx, a.l - b.l d from s a left join s b on b.place = a.place and b.idx = a.idx - 1),
ls as (select place, idx, list(d) filter (where d is not null) over (partition by place order by idx range between 11 preceding and current row) ds from dd), md as (select place, idx, ds, list_aggregate(ds, 'median') m from ls),
ma as (select place, idx, 14826e-4 * list_aggregate(list_transform(ds, lambda x: abs(x - m)), 'median') mad from md), gd as (select idx, quantile_cont(mad, 0.1) low, quantile_cont(mad, 0.5) mid from ma where mad > 0 group by 1),
sg as (select place, idx, case when mad is null then coalesce(mid, 2e-2) else greatest(mad, coalesce(low, 1e-2), 1e-3) end sigma from ma left join gd using (idx))"""
PHI = "(case when {z} >= 0 then 1 - {p} else {p} end)".format(z="y.z", p="exp(-y.z * y.z / 2) / sqrt(2 * pi()) * y.t * (" + f"{P0[0]!r} + y.t * ({P0[1]!r} + y.t * ({P0[2]!r} + y.t * ({P0[3]!r} + y.t * {P0[4]!r}))))")
NINE_ROWS = f"""{SIGMA}, fr as (select ff.place, ff.idx origin, h, {', '.join(f'{x} x{i + 1}' for i, x in enumerate(NINE))}, b.l - a.l y, a.l as value, sigma from ff join s a on a.place = ff.place and a.idx = ff.idx join sg on sg.place = ff.place and sg.idx = ff.idx cross join (values (1), (2), (4)) v(h) left join s b on b.place = ff.place and b.idx = ff.idx + h),
{known(9, weight='pow(sigma, -2)')}, {ridge(9, 30, '5e-2')}, pr as (select fr.*, {predicted(9)} pred from fr left join fit on fit.key = fr.h * 100000 + fr.origin)"""
BOUNDS = f"""pa as (select * from pr where y is not null and pred is not null), cs as (select h, origin, sum((y - pred) / (sigma * sigma)) / sum(1 / (sigma * sigma)) c from pa group by 1, 2), ck as (select * from (select *, row_number() over (partition by h order by origin desc) k from cs) where k <= 8),
sz as (select h, sqrt(avg(c * c)) * sqrt((count(*) + 1) / count(*)::double) size from ck group by 1), ce as (select h, avg(u) u, count(*) n from (select pa.h, (y - pred - c) / sigma u from pa join ck on ck.h = pa.h and ck.origin = pa.origin) group by h, floor(asinh(u) / 2e-2)),
st as (select h, list(struct_pack(u := u, n := n)) cells, sum(n)::double total, min(u) low, max(u) high from ce group by 1),
bi as (select pr.place, pr.h, lv, sigma, size, cells, total, low * sigma - 8 * size a, high * sigma + 8 * size b, 0 i from pr join st using (h) join sz using (h) cross join (values (1e-1), (25e-2), (75e-2), (9e-1)) l(lv) where origin = (select max(origin) from pr where pred is not null)
union all select place, h, lv, sigma, size, cells, total, case when list_sum(list_transform(list_transform(cells, lambda x: struct_pack(n := x.n, z := ((a + b) / 2 - x.u * sigma) / size, t := 1 / (1 + {TAIL!r} * abs(((a + b) / 2 - x.u * sigma) / size)))), lambda y: y.n * {PHI})) / total < lv then (a + b) / 2 else a end, case when list_sum(list_transform(list_transform(cells, lambda x: struct_pack(n := x.n, z := ((a + b) / 2 - x.u * sigma) / size, t := 1 / (1 + {TAIL!r} * abs(((a + b) / 2 - x.u * sigma) / size)))), lambda y: y.n * {PHI})) / total < lv then b else (a + b) / 2 end, i + 1 from bi where i < 60),
qu as (select place, h, max((a + b) / 2) filter (where lv = 1e-1) q10, max((a + b) / 2) filter (where lv = 25e-2) q25, max((a + b) / 2) filter (where lv = 75e-2) q75, max((a + b) / 2) filter (where lv = 9e-1) q90 from bi where i = 60 group by 1, 2)"""


def nine_rows(spark, sf_dir):
    """place, origin, h, the nine features, y, the price and its scale as known at the origin."""
    sales, features = nine_features(spark, sf_dir)
    later = sales
    for h in HS:
        later = P.lagged(later, -h, f"l{h}")
    ahead = F.array(*[F.struct(F.lit(h).alias("h"), F.col(f"l{h}").alias("then")) for h in HS])
    later = later.select("place", F.col("idx"), "value", F.inline(ahead)).withColumn("y", F.col("then") - F.col("value")).drop("then")
    return later.join(features, ["place", "idx"]).join(models.rolling_sigma(sales), ["place", "idx"]).withColumnRenamed("idx", "origin")


@query(f"with recursive {Q}, {M}, {NINE_SQL}, {NINE_ROWS}, {BOUNDS} select pr.place, origin, pr.h::int h, round(pred, 6) pred, {', '.join(f'round(pred + {k}, 6) {k}' for k in models.LEVELS)} from pr left join qu using (place, h) where origin = (select max(origin) from pr where pred is not null)")
def ridge_forecast(spark, sf_dir):
    """Predictions at the last origin that has all nine features, with bounds from the errors of the backtest; all as log changes."""
    rows = stored(nine_rows(spark, sf_dir))
    done = stored(models.backtest(rows, list(NINE), "y", F.pow("sigma", F.lit(-2.0)), 0.05, 30).select("place", "origin", "h", "y", "pred", "sigma"))
    now = done.where(F.col("origin") == done.where("pred is not null").agg(F.max("origin")).scalar())
    return models.intervals(done, now).select("place", "origin", "h", r("pred").alias("pred"), *[r(F.col("pred") + F.col(k)).alias(k) for k in models.LEVELS])


BASE3 = ["mom1", "mom4", "vol4"]
SIGNALS = ["x_credit", "x_cost", "x_lic", "x_vgap", "x_tourism", "x_effort"]


def rows_with_signals(spark, sf_dir):
    from .catalog import forecast_rows

    q, y = stored(quarters(spark, sf_dir)), stored(years(spark, sf_dir))
    line = table(spark, sf_dir, "lineitem").groupBy((F.year("l_shipdate") * 12 + F.month("l_shipdate") - 1).cast("bigint").alias("idx"))
    line = stored(line.agg(F.sum("l_extendedprice").alias("credit"), F.avg(F.try_divide("l_extendedprice", "l_quantity")).alias("cost"), (F.avg("l_discount") * 100).alias("rate")))
    m = stored(months(spark, sf_dir))
    of = lambda c: line.select("idx", F.col(c).alias("value"))
    sales = column(q, F.log("value"))
    found = {
        "x_credit": S.yearly_change(of("credit"), q, "x_credit", True), "x_cost": S.yearly_change(of("cost"), q, "x_cost"), "x_lic": S.yearly_change(m.groupBy("idx").agg(F.sum("n").alias("value")), q, "x_lic", True),
        "x_vgap": S.valuation_gap(sales, column(m, F.log("value")), "x_vgap"), "x_tourism": S.published_change(column(y, "n"), q, "x_tourism"), "x_effort": S.purchase_effort(sales, of("rate"), column(y, "value"), "x_effort"),
    }
    known = S.candidates(q, found).withColumnRenamed("idx", "origin")
    return stored(forecast_rows(q).join(known, ["place", "origin"]))


TESTS = f"""mk as (select (year(l_shipdate) * 12 + month(l_shipdate) - 1)::bigint k, sum(l_extendedprice) credit, avg(l_extendedprice / nullif(l_quantity, 0)) cost, avg(l_discount) * 100 rate from lineitem group by 1), lk as (select idx k, sum(n) lic from m group by 1),
c1 as (select k, ln(t) v from (select k, case when count(*) over w = 12 then sum(credit) over w end t from mk window w as (order by k range between 11 preceding and current row)) where t > 0), c2 as (select k, ln(cost) v from mk), c3 as (select k, ln(t) v from (select k, case when count(*) over w = 12 then sum(lic) over w end t from lk window w as (order by k range between 11 preceding and current row)) where t > 0),
nt as (select idx, {", ".join(f"(select max_by(v, k) from c{i} where k <= idx * 3 + 2) - (select max_by(v, k) from c{i} where k <= idx * 3 - 10) n{i}" for i in (1, 2, 3))}, (select max_by(rate, k) from mk where k <= idx * 3 + 2) / 1200 rt, (idx * 3 + 2) // 12 - case when (idx * 3 + 2) % 12 >= 6 then 1 else 2 end ty, (select max(y.idx) from y where y.idx <= (u.idx * 3 + 2) // 12 - 2) iy from (select distinct idx from q) u),
w0 as (select q.place, q.idx, n1, n2, n3, ln(m.value) - ln(q.value) n4, ln(ya.n) - ln(yb.n) n5, ln(q.value) + ln(case when rt > 1e-9 then rt / (1 - pow(1 + rt, -360)) else 1 / 360e0 end) - ln(yi.value) n6 from q join nt using (idx) left join m on m.place = q.place and m.idx = q.idx * 3 + 2 left join y ya on ya.place = q.place and ya.idx = ty left join y yb on yb.place = q.place and yb.idx = ty - 1 left join y yi on yi.place = q.place and yi.idx = iy),
wm as (select idx, {", ".join(f"quantile_cont(n{i}, 0.5) d{i}" for i in range(1, 7))} from w0 group by 1), sn as (select w0.place, w0.idx, unnest([{", ".join(f"struct_pack(sk := {i}, x4 := coalesce(n{i}, d{i}))" for i in range(1, 7))}], recursive := true) from w0 join wm using (idx)),
f4 as (select sk, fr.* exclude (x4), sn.x4 from (select *, null x4 from fr) fr join sn on sn.place = fr.place and sn.idx = fr.origin), {known(3)}, {ridge(3, 30, '5e-2')},
t4 as (select o.sk * 10000000 + o.h * 100000 + o.origin as key, x1, x2, x3, x4, y, 1e0 w from (select distinct sk, h, origin from f4) o join f4 on f4.sk = o.sk and f4.h = o.h and f4.origin + f4.h <= o.origin where x1 is not null and x2 is not null and x3 is not null and x4 is not null and y is not null), {ridge(4, 30, '5e-2', 's', 't4')},
pd as (select f4.sk, f4.h, y, {predicted(3, 'fit', 'f4')} b, {predicted(4, 'fits', 'f4')} s from f4 join fit on fit.key = f4.h * 100000 + f4.origin join fits on fits.key = f4.sk * 10000000 + f4.h * 100000 + f4.origin),
ts as (select sk, h, count(*) n, avg(abs(b - y)) mb, avg(abs(s - y)) ms from pd where y is not null and b is not null and s is not null group by 1, 2)"""
ROWS3 = "fr as (select a.place, a.idx origin, h, ln(a.value) - ln(b.value) x1, ln(a.value) - ln(c.value) x2, ln(a.n) - ln(c.n) x3, ln(d.value) - ln(a.value) y from q a cross join (values (1), (2), (4)) v(h) left join q b on b.place = a.place and b.idx = a.idx - 1 left join q c on c.place = a.place and c.idx = a.idx - 4 left join q d on d.place = a.place and d.idx = a.idx + h)"
NAMED = "(['" + "', '".join(SIGNALS) + "'])[sk]"


@query(f"with {Q}, {M}, {Y}, {ROWS3}, {TESTS} select {NAMED} signal, h::int h, n::bigint n, round(mb, 6) mae_base, round(ms, 6) mae_signal, round(1 - ms / mb, 6) gain from ts")
def signal_tests(spark, sf_dir):
    """Whether each of six candidate signals improves the forecast."""
    return rounded(models.signal_tests(rows_with_signals(spark, sf_dir), BASE3, SIGNALS, "y"))


@query(f"with {Q}, {M}, {Y}, {ROWS3}, {TESTS}, g as (select sk, max_by(1 - ms / mb, h) a, min_by(1 - ms / mb, h) b from ts group by 1) select {NAMED} signal, round(a, 6) gain_far, round(b, 6) gain_near, a >= 1e-2 and b >= -1e-2 passes from g")
def signals_passing(spark, sf_dir):
    return rounded(models.passing(models.signal_tests(rows_with_signals(spark, sf_dir), BASE3, SIGNALS, "y")))


REGIONAL = f"""pl as (select c_custkey place, n_regionkey::bigint region, c_custkey % 10 fold, ln(avg(o_totalprice)) y, ln(count(*)) x1, ln(c_acctbal) x2, avg((o_orderpriority = '1-URGENT')::int) x3 from customer join orders on o_custkey = c_custkey join nation on n_nationkey = c_nationkey where c_acctbal > 0 group by c_custkey, n_regionkey, c_acctbal),
bg as (select region from (select region, count(*) n from pl group by 1) order by n desc, region limit 1), fr as (select pl.*, {", ".join(f"(region = {k} and region <> (select region from bg))::int::double x{4 + k}" for k in range(5))} from pl),
tr as (select f.fold as key, {", ".join(f"x{i}" for i in range(1, 9))}, y, 1e0 w from (select distinct fold from fr) f join fr on fr.fold <> f.fold), {ridge(8, 1, '1e-2')}"""


@query(f"with {REGIONAL} select place, region, round({predicted(8)}, 6) pred, round(exp(y - ({predicted(8)})) - 1, 6) gap from fr join fit on fit.key = fr.fold")
def regional_fair_value(spark, sf_dir):
    """A customer's mean order price against its out-of-fold estimate, with effects of the regions."""
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("place")).agg(F.log(F.avg("o_totalprice")).alias("y"), F.log(F.count("*").cast("double")).alias("orders"), F.avg((F.col("o_orderpriority") == "1-URGENT").cast("double")).alias("urgent"))
    regions = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").cast("bigint").alias("region"))
    places = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("place"), "c_nationkey", F.log("c_acctbal").alias("balance")).join(regions, "c_nationkey")
    rows = places.join(orders, "place").withColumn("fold", F.col("place") % 10)
    out = models.with_groups(rows, ["orders", "balance", "urgent"], "region", "y", "fold")
    return out.select("place", "region", r("pred").alias("pred"), r(F.exp(F.col("y") - F.col("pred")) - 1).alias("gap"))
