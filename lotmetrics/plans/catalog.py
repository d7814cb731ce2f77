"""The queries of the panel library, each with the SQL that states its result."""

from pyspark.sql import functions as F

from ..functions import finance, keys
from ..operators import models, spatial
from ..operators import panel as P
from .base import ORACLE, QUERIES, query, r  # noqa: F401
from .panels import D, M, Q, Y, deflator, months, quarters, stored, table, years

RANK = "100.0 * (rank() over (partition by {0} is null order by {0}) + (count(*) over (partition by {0}) - 1) / 2.0) / count({0}) over (partition by {0} is null)"


@query(f"""with {Q}, l as (select a.place, a.value, b.value v4, c.value v12 from q a left join q b on b.place = a.place and b.idx = a.idx - 4 left join q c on c.place = a.place and c.idx = a.idx - 12 where a.idx = (select max(idx) from q)),
g as (select place, value, 100 * (value / nullif(v4, 0) - 1) g1, 100 * (value / nullif(v12, 0) - 1) g3 from l),
s as (select *, case when g1 is not null then {RANK.format("g1")} end p1, case when g3 is not null then {RANK.format("g3")} end p3 from g),
t as (select *, coalesce((p1 + p3) / 2, p1, p3) score from s)
select place, round(value, 6) as value, round(g1, 6) growth_1y, round(g3, 6) growth_3y, round(score, 6) score, case when score <= 40 then 'green' when score <= 70 then 'amber' when score is not null then 'red' end band from t""")
def price_score_band(spark, sf_dir):
    rows = P.latest_with_lags(quarters(spark, sf_dir), {"v4": 4, "v12": 12}).select("place", "value", P.growth(F.col("value"), F.col("v4")).alias("g1"), P.growth(F.col("value"), F.col("v12")).alias("g3"))
    rows = rows.withColumns({"p1": P.pct_rank(F.col("g1")), "p3": P.pct_rank(F.col("g3"))})
    score = F.coalesce((F.col("p1") + F.col("p3")) / 2, "p1", "p3")
    return rows.select("place", r("value").alias("value"), r("g1").alias("growth_1y"), r("g3").alias("growth_3y"), r(score).alias("score"), P.band(score).alias("band"))


@query(f"with {Q}, {D} select q.place, q.idx, round(100 * ((q.value / b.value) / (d.value / e.value) - 1), 6) real_growth from q join q b on b.place = q.place and b.idx = q.idx - 4 join d on d.idx = q.idx join d e on e.idx = q.idx - 4")
def real_growth(spark, sf_dir):
    d = deflator(spark, sf_dir)
    d = P.lagged(d.withColumn("place", F.lit(0)), 4, "then").select("idx", F.try_divide("value", "then").alias("rise")).where("rise is not null")
    rows = P.lagged(quarters(spark, sf_dir), 4, "before").where("before is not null").join(d, "idx")
    return rows.select("place", "idx", r(100 * (F.try_divide("value", "before") / F.col("rise") - 1)).alias("real_growth"))


@query(f"with {M} select place, idx, case when count(value) over w = 12 then sum(n) over w end::bigint n12 from m window w as (partition by place order by idx rows between 11 preceding and current row)")
def rolling_volume(spark, sf_dir):
    return months(spark, sf_dir).select("place", "idx", P.rolling_sum("n", 12).cast("bigint").alias("n12"))


@query(f"with {M} select place, (idx // 3)::bigint as quarter, round(avg(value), 6) as value from m group by 1, 2 having count(value) = 3")
def monthly_to_quarterly(spark, sf_dir):
    rows = P.complete_mean(months(spark, sf_dir), F.floor(F.col("idx") / 3).cast("bigint"), "quarter", 3)
    return rows.select("place", "quarter", r("value").alias("value"))


@query(f"with {Q}, {M} select q.place, q.idx, round((select max_by(m.value, m.idx) from m where m.place = q.place and m.idx <= q.idx * 3 + 1 and m.idx >= q.idx * 3 - 1), 6) valuation from q")
def asof_valuation(spark, sf_dir):
    left = quarters(spark, sf_dir).select("place", (F.col("idx") * 3 + 1).alias("idx"), F.col("idx").alias("q"))
    out = P.asof(left, months(spark, sf_dir).select("place", "idx", F.col("value").alias("v")), "v", "valuation", 2)
    return out.select("place", F.col("q").alias("idx"), r("valuation").alias("valuation"))


@query(f"with {Q} select place, idx, round(case when count(value) over w >= 8 then (value - avg(value) over w) / nullif(stddev_samp(value) over w, 0) end, 6) z from q window w as (partition by place order by idx rows between unbounded preceding and current row)")
def expanding_national_score(spark, sf_dir):
    return quarters(spark, sf_dir).select("place", "idx", r(P.expanding_z()).alias("z"))


EVENT = f"{Q}, e as (select place, idx, value, case when count(value) over w = 12 then (min(value) over w / value - 1 <= -0.10)::int end ev from q window w as (partition by place order by idx range between 1 following and 12 following))"


@query(f"with {EVENT} select place, idx, ev event from e")
def drawdown_event(spark, sf_dir):
    return quarters(spark, sf_dir).select("place", "idx", P.drawdown_event().alias("event"))


@query(f"with {EVENT}, f as (select *, coalesce(ev = 1, false) one from e), g as (select *, sum((one and not coalesce(p, false))::int) over (partition by place order by idx rows unbounded preceding) run from (select *, lag(one) over (partition by place order by idx) p from f)) select place, min(idx) as first, max(idx) as last, count(*) n from g where one group by place, run")
def episodes(spark, sf_dir):
    return P.episodes(quarters(spark, sf_dir).select("place", "idx", P.drawdown_event().alias("event")), "event").select("place", "first", "last", "n")


@query(f"with {Q} select place, idx, round(100 * (value / max(value) over (partition by place order by idx rows unbounded preceding) - 1), 6) drawdown from q")
def drawdown_series(spark, sf_dir):
    return quarters(spark, sf_dir).select("place", "idx", r(P.drawdown()).alias("drawdown"))


@query(f"with {Q}, x as (select place, value::double x, n::double y, rank() over (partition by place order by value) + (count(*) over (partition by place, value) - 1) / 2.0 rx, rank() over (partition by place order by n) + (count(*) over (partition by place, n) - 1) / 2.0 ry from q) select place, round(case when count(*) >= 5 and count(distinct x) >= 2 and count(distinct y) >= 2 then corr(rx, ry) end, 6) rho, count(*) n from x group by 1")
def spearman(spark, sf_dir):
    return P.spearman(quarters(spark, sf_dir).withColumnRenamed("n", "y"), "value", "y", "place").select("place", r("rho").alias("rho"), "n")


@query(f"with {EVENT}, x as (select place, ev, rank() over (partition by place order by value) + (count(*) over (partition by place, value) - 1) / 2.0 rk from e where ev is not null), s as (select place, sum(case when ev = 1 then rk end) s, sum(ev)::double p, sum(1 - ev)::double n from x group by 1) select place, round((s - p * (p + 1) / 2) / nullif(p * n, 0), 6) auc from s")
def auc(spark, sf_dir):
    rows = quarters(spark, sf_dir).select("place", "value", P.drawdown_event().alias("event"))
    return P.auc(rows, "value", "event", "place").select("place", r("auc").alias("auc"))


@query(f"with {EVENT} select (value >= (select avg(value) from q)) flagged, ev event, count(*) n from e where ev is not null group by 1, 2")
def confusion(spark, sf_dir):
    q = quarters(spark, sf_dir)
    rows = q.select("value", P.drawdown_event().alias("event")).where("event is not null")
    return rows.groupBy((F.col("value") >= q.agg(F.avg("value")).scalar()).alias("flagged"), "event").agg(F.count("*").alias("n"))


@query(f"with {Q}, g as (select a.place, 100 * (a.value / b.value - 1) g from q a join q b on b.place = a.place and b.idx = a.idx - 4 where a.idx = (select max(idx) from q)) (select place, round(g, 6) growth, 'up' direction from g order by g desc, place limit 10) union all (select place, round(g, 6), 'down' from g order by g, place limit 10)")
def topk_movers(spark, sf_dir):
    rows = P.latest_with_lags(quarters(spark, sf_dir), {"before": 4}).select("place", P.growth(F.col("value"), F.col("before")).alias("growth"))
    return P.top_movers(rows, "growth", 10).select("place", r("growth").alias("growth"), "direction")


@query(f"with {Q}, n as (select idx, avg(value) as value from q group by 1), l as (select unnest([0, 1, 2, 3, 4]) lag) select q.place, l.lag::int lag, round(corr(q.value, n.value), 6) r, count(*) n from q join l on true join n on n.idx + l.lag = q.idx group by 1, 2")
def lag_correlations(spark, sf_dir):
    q = quarters(spark, sf_dir)
    rows = P.correlation_at_lags(q, q.groupBy("idx").agg(F.avg("value").alias("value")), [0, 1, 2, 3, 4])
    return rows.select("place", "lag", r("r").alias("r"), "n")


@query(f"with {Q}, a as (select idx, value, place from q where idx >= 7988), b as (select place, idx, value * 2 as value from q where idx <= 7992), j as (select coalesce(a.place, b.place) place, coalesce(a.idx, b.idx) idx, a.value m, b.value o from a full join b on a.place = b.place and a.idx = b.idx), k as (select place, min_by(m / o, idx) filter (where m is not null and o is not null) link, min(idx) filter (where m is not null) first from j group by 1) select j.place, j.idx, round(coalesce(m, case when idx < first then o * link end), 6) as value from j join k on k.place = j.place where coalesce(m, case when idx < first then o * link end) is not null")
def index_splice(spark, sf_dir):
    q = quarters(spark, sf_dir).select("place", "idx", "value")
    out = P.splice(q.where("idx >= 7988"), q.where("idx <= 7992").withColumn("value", F.col("value") * 2))
    return out.select("place", "idx", r("value").alias("value"))


@query("select s_suppkey id, round(case when s_acctbal > 0 then s_acctbal * (0.035 / 12) / (1 - power(1 + 0.035 / 12, -360.0)) end, 6) instalment, round(case when s_acctbal > 0 then s_acctbal * (power(1 + 0.035 / 12, 360.0) - power(1 + 0.035 / 12, 60.0)) / (power(1 + 0.035 / 12, 360.0) - 1) end, 6) owed from supplier")
def annuity_table(spark, sf_dir):
    loan, rate, years = F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")), F.lit(3.5), F.lit(30.0)
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), r(finance.instalment(loan, rate, years)).alias("instalment"), r(finance.balance(loan, rate, years, F.lit(60.0))).alias("owed"))


@query("select c_custkey id, round(0.02 * greatest(least(c_acctbal, 2000) - 0, 0) + 0.05 * greatest(least(c_acctbal, 5000) - 2000, 0) + 0.08 * greatest(c_acctbal - 5000, 0), 6) tax from customer")
def tax_bracket(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), r(finance.bracket_tax(F.col("c_acctbal"), [(0.0, 0.02), (2000.0, 0.05), (5000.0, 0.08)])).alias("tax"))


@query("select n_nationkey::bigint place, replace(lower(n_name), '_', ' ') as name, 2 * 6371.0 * asin(sqrt(least(power(sin(radians(40 - n_nationkey) / 2), 2) + cos(radians(n_nationkey)) * cos(radians(40.0)) * power(sin(radians(-8.0 - n_nationkey / 10.0) / 2), 2), 1.0))) > 3000 far from nation")
def distance_band(spark, sf_dir):
    k = F.col("n_nationkey").cast("double")
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("place"), keys.plain(F.col("n_name")).alias("name"), (finance.haversine(k, k / 10, F.lit(40.0), F.lit(-8.0)) > 3000).alias("far"))


@query("select event_type, count(*) n, round(quantile_cont((props::json->>'k')::double, 0.5), 6) median_k, round(quantile_cont(value, 0.9), 6) p90 from events group by 1")
def event_properties(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_type", "value", F.get_json_object("props", "$.k").cast("double").alias("k"))
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), r(F.expr("percentile(k, 0.5)")).alias("median_k"), r(F.expr("percentile(value, 0.9)")).alias("p90"))


@query("select user_id, max_by(event_id, struct_pack(t := ts, e := event_id)) event_id, max_by(event_type, struct_pack(t := ts, e := event_id)) event_type from events group by 1")
def dedupe_latest(spark, sf_dir):
    key = F.struct("ts", "event_id")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.max_by("event_id", key).alias("event_id"), F.max_by("event_type", key).alias("event_type"))


@query("select o_custkey, count(*) n from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0) group by 1")
def archive_antijoin(spark, sf_dir):
    seen = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, sf_dir, "orders").join(seen, "o_custkey", "left_anti").groupBy("o_custkey").agg(F.count("*").alias("n"))


@query("select p_brand, round(100.0 * count(*) filter (where p_type like '%BRASS%') / count(*), 6) share, count(*) n from part group by 1")
def brand_shares(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(r(100 * F.avg(F.col("p_type").contains("BRASS").cast("double"))).alias("share"), F.count("*").alias("n"))


@query(f"with {Q}, x as (select place, round(stddev_samp(g), 6) vol, count(*) n from (select place, 100 * (value / nullif(lag(value) over (partition by place order by idx), 0) - 1) g from q) where g is not null group by 1) select place, vol, case when n >= 6 then vol >= (select quantile_cont(vol, 0.9) from x) end volatile from x")
def step_spread(spark, sf_dir):
    steps = quarters(spark, sf_dir).select("place", P.growth(F.col("value"), F.lag("value").over(P.ordered())).alias("g")).where("g is not null")
    rows = steps.groupBy("place").agg(r(F.stddev_samp("g")).alias("vol"), F.count("*").alias("n"))
    limit = rows.agg(F.expr("percentile(vol, 0.9)")).scalar()
    return rows.select("place", "vol", F.when(F.col("n") >= 6, F.col("vol") >= limit).alias("volatile"))


@query(f"with {Q}, s as (select place, count(*) n, avg(idx - 7980) mx, avg(value) my, regr_slope(value, idx - 7980) slope, regr_intercept(value, idx - 7980) base, regr_r2(value, idx - 7980) r2 from q group by 1) select place, round(slope, 6) slope, round(base, 4) base, round(r2, 6) r2, round(base + slope * (8006 - 7980), 4) forecast, n from s")
def trend_forecast(spark, sf_dir):
    x = F.col("idx") - 7980
    rows = quarters(spark, sf_dir).groupBy("place").agg(F.regr_slope("value", x).alias("slope"), F.regr_intercept("value", x).alias("base"), F.regr_r2("value", x).alias("r2"), F.count("*").alias("n"))
    return rows.select("place", r("slope").alias("slope"), r("base", 4).alias("base"), r("r2").alias("r2"), r(F.col("base") + F.col("slope") * (8006 - 7980), 4).alias("forecast"), "n")


@query(f"with {Q}, f as (select a.idx, a.value y, b.value naive, b.value * b.value / nullif(c.value, 0) drift from q a join q b on b.place = a.place and b.idx = a.idx - 4 join q c on c.place = a.place and c.idx = a.idx - 8) select idx, count(*) n, round(avg(abs(y / naive - 1)) * 100, 6) naive_mae, round(avg(abs(y / drift - 1)) * 100, 6) drift_mae from f group by 1")
def naive_metrics(spark, sf_dir):
    rows = P.lagged(P.lagged(quarters(spark, sf_dir), 4, "naive"), 8, "older").where("naive is not null and older is not null")
    rows = rows.withColumn("drift", F.try_divide(F.col("naive") * F.col("naive"), F.col("older")))
    error = lambda c: r(F.avg(F.abs(F.try_divide("value", c) - 1)) * 100)
    return rows.groupBy("idx").agg(F.count("*").alias("n"), error("naive").alias("naive_mae"), error("drift").alias("drift_mae"))


@query(f"with {Q}, g as (select a.place, a.idx, case when a.value / b.value - 1 > 0.02 then 1 when a.value / b.value - 1 < -0.02 then -1 else 0 end p, case when a.n > b.n then 1 else -1 end v from q a join q b on b.place = a.place and b.idx = a.idx - 4) select place, idx, case when p > 0 and v > 0 then 'expansion' when p > 0 then 'late' when p < 0 and v < 0 then 'contraction' when p < 0 then 'recovery' else 'flat' end phase from g")
def price_volume_signs(spark, sf_dir):
    w = P.W.partitionBy("place").orderBy("idx").rangeBetween(-4, -4)
    rows = quarters(spark, sf_dir).withColumns({"before": F.max("value").over(w), "n0": F.max("n").over(w)}).where("before is not null")
    g, up = F.try_divide("value", "before") - 1, F.col("n") > F.col("n0")
    phase = F.when((g > 0.02) & up, "expansion").when(g > 0.02, "late").when((g < -0.02) & ~up, "contraction").when(g < -0.02, "recovery").otherwise("flat")
    return rows.select("place", "idx", phase.alias("phase"))


@query(f"with {Q}, {M}, l as (select place, avg(value) v from m where idx > (select max(idx) from m) - 12 group by 1), p as (select place, value as p from q where idx = (select max(idx) - 1 from q)) select p.place, round(100 * (l.v / nullif(p.p, 0) - 1), 6) gap from p left join l on l.place = p.place")
def recent_mean_gap(spark, sf_dir):
    m, q = months(spark, sf_dir), quarters(spark, sf_dir)
    late = m.where(F.col("idx") > m.agg(F.max("idx") - 12).scalar()).groupBy("place").agg(F.avg("value").alias("v"))
    price = q.where(F.col("idx") == q.agg(F.max("idx") - 1).scalar()).select("place", F.col("value").alias("p"))
    return price.join(late, "place", "left").select("place", r(P.growth(F.col("v"), F.col("p"))).alias("gap"))


@query(f"with {M}, x as (select place, max(idx) as last from m group by 1) select place, last, (select max(idx) from m) - last as age, case when (select max(idx) from m) - last <= 1 then 'fresh' else 'stale' end status from x")
def freshness(spark, sf_dir):
    m = months(spark, sf_dir)
    now = m.agg(F.max("idx")).scalar()
    rows = m.groupBy("place").agg(F.max("idx").alias("last"))
    return rows.select("place", "last", (now - F.col("last")).alias("age"), F.when(now - F.col("last") <= 1, "fresh").otherwise("stale").alias("status"))


@query(f"with {Q} select place, count(*) n, round(100.0 * count(*) filter (where value > (select median(value) from q)) / count(*), 6) share_above from q group by 1")
def share_over_median(spark, sf_dir):
    q = quarters(spark, sf_dir)
    mid = q.agg(F.expr("percentile(value, 0.5)")).scalar()
    return q.groupBy("place").agg(F.count("*").alias("n"), r(100 * F.avg((F.col("value") > mid).cast("double"))).alias("share_above"))


@query(f"with {Q}, c as (select n_regionkey::bigint region, idx, sum(value * n) / sum(n) as value from q join nation on n_nationkey = place group by 1, 2), b as (select region, idx, value, first_value(value) over (partition by region order by idx) base, max(value) over (partition by region order by idx rows unbounded preceding) peak from c) select region as place, idx, round(100 * value / base, 6) level, round(100 * (value / peak - 1), 6) below_peak, rank() over (partition by idx order by value desc) position from b")
def country_compare(spark, sf_dir):
    regions = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("place"), F.col("n_regionkey").cast("long").alias("region"))
    rows = quarters(spark, sf_dir).join(regions, "place").groupBy(F.col("region").alias("place"), "idx").agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("value"))
    base = F.first("value").over(P.ordered())
    return rows.select("place", "idx", r(100 * F.try_divide("value", base)).alias("level"), r(P.drawdown()).alias("below_peak"), F.rank().over(P.W.partitionBy("idx").orderBy(F.desc("value"))).cast("long").alias("position"))


BRACKETS = {use: "case " + " ".join(f"when p <= {limit} then greatest(p * {rate} - {off}, 0)" if off is not None else (f"when p <= {limit} then p * {rate}" if limit else f"else p * {rate}") for limit, rate, off in finance.TRANSFER_TAX[use]) + " end" for use in finance.TRANSFER_TAX}


@query(f"""with x as (select c_custkey id, (c_acctbal * 120)::double p from customer where c_acctbal > 0)
select id, round({BRACKETS["own"]}, 4) own, round({BRACKETS["second"]}, 4) as second, round(case when p <= 330539 then 0 when p <= 660982 then 0.08 * (p - 330539) else {BRACKETS["own"]} end, 4) young,
round({BRACKETS["own"]} + 0.008 * p + 0.006 * 0.9 * p, 4) total from x""")
def purchase_tax(spark, sf_dir):
    p = (F.col("c_acctbal") * 120).cast("double")
    rows = table(spark, sf_dir, "customer").where("c_acctbal > 0")
    taxes = [finance.transfer_tax(p), finance.transfer_tax(p, "second"), finance.transfer_tax(p, "own", True), finance.purchase_taxes(p, 0.9 * p)["total"]]
    return rows.select(F.col("c_custkey").alias("id"), *[r(t, 4).alias(n) for t, n in zip(taxes, ("own", "second", "young", "total"), strict=True)])


@query("""with p as (select s_suppkey id, ((s_suppkey * 7919) % 5000) / 100.0 x, ((s_suppkey * 104729) % 5000) / 100.0 + 0.0031 y from supplier),
g as (select n_nationkey::bigint polygon, (n_nationkey % 5) * 10.0 cx, (n_nationkey // 5) * 10.0 cy from nation)
select id, polygon from p join g on abs(x - cx) + abs(y - cy) < 6""")
def points_in_places(spark, sf_dir):
    k = F.col("s_suppkey")
    points = table(spark, sf_dir, "supplier").select(k.alias("id"), (F.pmod(k * 7919, F.lit(5000)) / 100.0).alias("x"), (F.pmod(k * 104729, F.lit(5000)) / 100.0 + 0.0031).alias("y"))
    cx, cy = (F.col("n_nationkey") % 5) * 10.0, F.floor(F.col("n_nationkey") / 5) * 10.0
    ring = F.array(*[F.array(cx + a, cy + b) for a, b in ((6.0, 0.0), (0.0, 6.0), (-6.0, 0.0), (0.0, -6.0))])
    places = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("polygon"), F.array(ring).alias("rings"))
    return spatial.points_in_polygons(points, places, 5.0).select("id", "polygon")


@query(f"""with {Q}, d as (select place, ln(value) - lag(ln(value)) over w d, row_number() over (partition by place order by idx desc) k from q window w as (partition by place order by idx)),
m as (select place, median(d) filter (where k <= 12) m from d group by 1), a as (select d.place, 1.4826 * median(abs(d - m)) filter (where k <= 12) mad from d join m on m.place = d.place group by 1),
g as (select quantile_cont(mad, 0.1) low, median(mad) mid from a where mad > 0)
select place, round(case when mad is null then coalesce(mid, 0.02) else greatest(mad, coalesce(low, 0.01), 0.001) end, 8) sigma from a, g""")
def volatility_scale(spark, sf_dir):
    return models.robust_sigma(quarters(spark, sf_dir).withColumn("value", F.ln("value"))).select("place", r("sigma", 8).alias("sigma"))


def forecast_rows(q):
    """Rows (place, origin, h) with the features known at the origin and the log price change h quarters on; q: a stored panel."""
    q = q.withColumns({"value": F.ln("value"), "n": F.ln("n")})
    for name, of, lag in (("s1", "value", 1), ("s4", "value", 4), ("n4", "n", 4), *((f"l{h}", "value", -h) for h in HS)):
        q = P.lagged(q, lag, name, of)
    later = F.array(*[F.struct(F.lit(h).alias("h"), F.col(f"l{h}").alias("then")) for h in HS])
    q = q.select("place", F.col("idx").alias("origin"), (F.col("value") - F.col("s1")).alias("mom1"), (F.col("value") - F.col("s4")).alias("mom4"), (F.col("n") - F.col("n4")).alias("vol4"), "value", F.inline(later))
    return q.withColumn("y", F.col("then") - F.col("value")).drop("then")


FEATURES, HS = ["mom1", "mom4", "vol4"], (1, 2, 4)
#: Ridge regression on three features in SQL: tr(key, x1, x2, x3, y, w) to fit(key, b0..b3, lo1..hi3); lam is relative to the rows.
FIT = """mo as (select key, count(*) n, sum(w) sw, sum(w * x1) / sum(w) m1, sum(w * x2) / sum(w) m2, sum(w * x3) / sum(w) m3, sum(w * y) / sum(w) my, min(x1) lo1, max(x1) hi1, min(x2) lo2, max(x2) hi2, min(x3) lo3, max(x3) hi3 from tr group by 1 having count(*) >= {least}),
cv as (select mo.key, sum(w * (x1 - m1) * (x1 - m1)) / any_value(sw) c11, sum(w * (x1 - m1) * (x2 - m2)) / any_value(sw) c12, sum(w * (x1 - m1) * (x3 - m3)) / any_value(sw) c13, sum(w * (x2 - m2) * (x2 - m2)) / any_value(sw) c22, sum(w * (x2 - m2) * (x3 - m3)) / any_value(sw) c23, sum(w * (x3 - m3) * (x3 - m3)) / any_value(sw) c33,
sum(w * (x1 - m1) * (y - my)) / any_value(sw) d1, sum(w * (x2 - m2) * (y - my)) / any_value(sw) d2, sum(w * (x3 - m3) * (y - my)) / any_value(sw) d3 from tr join mo using (key) group by 1),
co as (select key, sqrt(c11) s1, sqrt(c22) s2, sqrt(c33) s3, 1 + {lam} a, c12 / sqrt(c11 * c22) f, c13 / sqrt(c11 * c33) g, c23 / sqrt(c22 * c33) h, d1 / sqrt(c11) r1, d2 / sqrt(c22) r2, d3 / sqrt(c33) r3 from cv),
de as (select *, a * (a * a - h * h) - f * (f * a - h * g) + g * (f * h - a * g) det from co),
be as (select key, (r1 * (a * a - h * h) - f * (r2 * a - h * r3) + g * (r2 * h - a * r3)) / det / s1 b1, (a * (r2 * a - h * r3) - r1 * (f * a - h * g) + g * (f * r3 - r2 * g)) / det / s2 b2, (a * (a * r3 - r2 * h) - f * (f * r3 - r2 * g) + r1 * (f * h - a * g)) / det / s3 b3 from de),
fit as (select mo.*, b1, b2, b3, my - b1 * m1 - b2 * m2 - b3 * m3 b0 from mo join be using (key))"""
PRED = "b0 + b1 * least(greatest(x1, lo1), hi1) + b2 * least(greatest(x2, lo2), hi2) + b3 * least(greatest(x3, lo3), hi3)"
ROWS = f"fr as (select a.place, a.idx origin, h, ln(a.value) - ln(b.value) x1, ln(a.value) - ln(c.value) x2, ln(a.n) - ln(c.n) x3, ln(d.value) - ln(a.value) y from {{source}} a cross join (values (1), (2), (4)) v(h) left join {{source}} b on b.place = a.place and b.idx = a.idx - 1 left join {{source}} c on c.place = a.place and c.idx = a.idx - 4 left join {{source}} d on d.place = a.place and d.idx = a.idx + h)"
PAST = "tr as (select o.h * 100000 + o.origin as key, x1, x2, x3, y, {w} w from (select distinct h, origin from fr) o join fr on fr.h = o.h and fr.origin + fr.h <= o.origin where x1 is not null and x2 is not null and x3 is not null and y is not null)"


@query(f"with {Q}, {ROWS.format(source='q')}, {PAST.format(w='1e0')}, {FIT.format(least=30, lam='5e-2')} select place, origin, fr.h::int h, round({PRED}, 6) pred from fr left join fit on fit.key = fr.h * 100000 + fr.origin")
def ridge_backtest(spark, sf_dir):
    """Predictions at every origin by the model of what was known then."""
    return models.backtest(forecast_rows(stored(quarters(spark, sf_dir))), FEATURES, "y", None, 0.05, 30).select("place", "origin", "h", r("pred").alias("pred"))


@query(f"with {Q}, {ROWS.format(source='q')}, {PAST.format(w='1e0')}, {FIT.format(least=30, lam='5e-2')}, dn as (select fr.*, {PRED} pred from fr join fit on fit.key = fr.h * 100000 + fr.origin), ok as (select * from dn where y is not null and pred is not null), me as (select h, count(*) n, avg(abs(pred - y)) a, avg(abs(y)) b, avg(abs(x2 * h / 4 - y)) c, avg(pred - y) bias, quantile_cont(abs(pred - y), 0.5) med from ok group by 1) select h::int h, n::bigint n, round(a, 6) mae_model, round(b, 6) mae_same, round(c, 6) mae_drift, round(bias, 6) bias, round(med, 6) median_error, round(1 - a / nullif(least(b, c), 0), 6) skill from me")
def forecast_metrics(spark, sf_dir):
    """Error of the model and of no change and drift, by horizon, on the same rows."""
    done = models.backtest(forecast_rows(stored(quarters(spark, sf_dir))), FEATURES, "y", None, 0.05, 30).where("y is not null and pred is not null")
    off = {"model": F.abs(F.col("pred") - F.col("y")), "same": F.abs("y"), "drift": F.abs(F.col("mom4") * F.col("h") / 4 - F.col("y"))}
    means = done.groupBy("h").agg(F.count("*").alias("n"), *[F.avg(c).alias(f"mae_{k}") for k, c in off.items()], F.avg(F.col("pred") - F.col("y")).alias("bias"), F.expr("percentile(abs(pred - y), 0.5)").alias("median_error"))
    skill = 1 - F.try_divide(F.col("mae_model"), F.least("mae_same", "mae_drift"))
    return means.select("h", "n", *[r(c).alias(c) for c in ("mae_model", "mae_same", "mae_drift", "bias", "median_error")], r(skill).alias("skill"))


@query(f"with li as (select l_orderkey id, ln(sum(l_quantity)) x1, count(*)::double x2, avg(l_discount) x3 from lineitem group by 1), fr as (select o_orderkey id, o_orderkey % 10 fold, x1, x2, x3, ln(o_totalprice) y from orders join li on li.id = o_orderkey where o_totalprice > 0), tr as (select f.fold as key, x1, x2, x3, y, 1e0 w from (select distinct fold from fr) f join fr on fr.fold <> f.fold), {FIT.format(least=1, lam='1e-2')} select id, round({PRED}, 6) pred, round(exp(y - ({PRED})) - 1, 6) gap from fr join fit on fit.key = fr.fold")
def fair_value(spark, sf_dir):
    """Order price against its out-of-fold estimate: ridge in ten folds by key."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.sum("l_quantity").alias("quantity"), F.count("*").alias("lines"), F.avg("l_discount").alias("discount"))
    rows = table(spark, sf_dir, "orders").where("o_totalprice > 0").select(F.col("o_orderkey").alias("id"), F.ln("o_totalprice").alias("y")).join(lines, "id").withColumn("quantity", F.ln("quantity"))
    out = models.out_of_fold(rows.withColumn("fold", F.col("id") % 10), ["quantity", "lines", "discount"], "y", "fold")
    return out.select("id", r("pred").alias("pred"), r(F.exp(F.col("y") - F.col("pred")) - 1).alias("gap"))


#: The same on two features, under other names.
FIT2 = """mo2 as (select key, count(*) n, avg(x1) m1, avg(x2) m2, avg(y) my, min(x1) lo1, max(x1) hi1, min(x2) lo2, max(x2) hi2, var_pop(x1) c11, var_pop(x2) c22, covar_pop(x1, x2) c12, covar_pop(y, x1) d1, covar_pop(y, x2) d2 from tr group by 1 having count(*) >= {least}),
co2 as (select *, 1 + {lam} a, c12 / sqrt(c11 * c22) f, d1 / sqrt(c11) r1, d2 / sqrt(c22) r2 from mo2), be2 as (select *, (a * r1 - f * r2) / (a * a - f * f) / sqrt(c11) b1, (a * r2 - f * r1) / (a * a - f * f) / sqrt(c22) b2 from co2)"""


@query(f"with {Q}, {ROWS.format(source='q')}, {PAST.format(w='1e0')}, {FIT.format(least=30, lam='5e-2')}, {FIT2.format(least=30, lam='5e-2')}, p as (select fr.h, fr.y, {PRED.replace('b0', 'fit.b0').replace('b1', 'fit.b1').replace('b2', 'fit.b2').replace('lo1', 'fit.lo1').replace('hi1', 'fit.hi1').replace('lo2', 'fit.lo2').replace('hi2', 'fit.hi2')} s, be2.my + be2.b1 * (least(greatest(x1, be2.lo1), be2.hi1) - be2.m1) + be2.b2 * (least(greatest(x2, be2.lo2), be2.hi2) - be2.m2) b from fr join fit on fit.key = fr.h * 100000 + fr.origin join be2 on be2.key = fit.key) select h::int h, count(*)::bigint n, round(avg(abs(b - y)), 6) mae_base, round(avg(abs(s - y)), 6) mae_signal, round(1 - avg(abs(s - y)) / avg(abs(b - y)), 6) gain from p where y is not null and s is not null and b is not null group by 1")
def signal_test(spark, sf_dir):
    """Whether the volume's yearly change improves the forecast."""
    out = models.signal_test(forecast_rows(stored(quarters(spark, sf_dir))), FEATURES[:2], FEATURES[2], "y")
    return out.select("h", "n", *[r(c).alias(c) for c in ("mae_base", "mae_signal", "gain")])


@query(f"with {Y}, fr as (select a.place, a.idx origin, 1 h, ln(a.value) - ln(b.value) x1, ln(a.n) - ln(b.n) x2, 0 x3, ln(c.value) - ln(a.value) y, a.value from y a left join y b on b.place = a.place and b.idx = a.idx - 1 left join y c on c.place = a.place and c.idx = a.idx + 1), {PAST.format(w='1e0')}, {FIT2.format(least=20, lam='5e-2')} select place, origin, round(my + b1 * (least(greatest(x1, lo1), hi1) - m1) + b2 * (least(greatest(x2, lo2), hi2) - m2), 6) pred, round(fr.value * exp(my + b1 * (least(greatest(x1, lo1), hi1) - m1) + b2 * (least(greatest(x2, lo2), hi2) - m2)), 4) mid from fr left join be2 on be2.key = 100000 + fr.origin")
def rent_forecast(spark, sf_dir):
    """The yearly forecast: next year's level from the growth of the level and of the number of contracts, as known at each origin."""
    q = stored(years(spark, sf_dir))
    for name, of, lag in (("v1", "value", 1), ("n1", "n", 1), ("then", "value", -1)):
        q = P.lagged(q, lag, name, of)
    step = lambda a, b: F.ln(a) - F.ln(b)
    rows = q.select("place", F.col("idx").alias("origin"), F.lit(1).alias("h"), "value", step("value", "v1").alias("mom"), step("n", "n1").alias("contracts"), step("then", "value").alias("y"))
    out = models.backtest(rows, ["mom", "contracts"], "y", None, 0.05, 20)
    return out.select("place", "origin", r("pred").alias("pred"), r(F.col("value") * F.exp("pred"), 4).alias("mid"))


@query(f"with {Q}, s as (select place, ln(value) - lag(ln(value)) over (partition by place order by idx) d from q), o as (select place, stddev_samp(d) s, count(d) n from s group by 1), m as (select quantile_cont(s, 0.5) m from o) select place, round(case when s is null then m else sqrt((n * s * s + 3 * m * m) / (n + 3)) end, 6) sigma from o cross join m")
def shrunk_sigma(spark, sf_dir):
    return models.shrunk_sigma(quarters(spark, sf_dir).withColumn("value", F.ln("value"))).select("place", r("sigma").alias("sigma"))


@query(f"with li as (select l_orderkey id, ln(sum(l_quantity)) x1, count(*)::double x2, avg(l_discount) x3 from lineitem group by 1), fr as (select o_orderkey id, rp, ((o_orderkey // (rp + 1)) % 10) fold, x1, x2, x3, ln(o_totalprice) y from orders join li on li.id = o_orderkey cross join (select unnest(range(2)) rp) where o_totalprice > 0), tr as (select f.rp * 100 + f.fold as key, x1, x2, x3, y, 1e0 w from (select distinct rp, fold from fr) f join fr on fr.rp = f.rp and fr.fold <> f.fold), {FIT.format(least=1, lam='1e-2')} select rp::int as \"repeat\", round(1 - sum(pow(y - ({PRED}), 2)) / (var_pop(y) * count(*)), 6) r2 from fr join fit on fit.key = fr.rp * 100 + fr.fold group by 1")
def cross_validated_r2(spark, sf_dir):
    """How much of the order price the fair value explains out of fold."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.sum("l_quantity").alias("quantity"), F.count("*").alias("lines"), F.avg("l_discount").alias("discount"))
    rows = table(spark, sf_dir, "orders").where("o_totalprice > 0").select(F.col("o_orderkey").alias("id"), F.ln("o_totalprice").alias("y")).join(lines, "id").withColumn("quantity", F.ln("quantity"))
    return models.cross_validated(rows, ["quantity", "lines", "discount"], "y", "id", 10, 2).select("repeat", r("r2").alias("r2"))


STEP = "b{k} as (select c.place, c.j, min(p.c + c.c) c, arg_min(list_append(p.path, c.j), p.c + c.c) path from b{p} p join c on c.place = p.place and c.i = p.j group by 1, 2)"


@query(f"""with {Q}, y as (select place, idx, ln(value) l, row_number() over (partition by place order by idx) - 1 t, count(*) over (partition by place) n from q where value > 0), c as (select a.place, a.t i, b.t + 1 j, greatest(regr_syy(x.l, x.t) - coalesce(regr_sxy(x.l, x.t) * regr_sxy(x.l, x.t) / nullif(regr_sxx(x.l, x.t), 0), 0), 0) c from y a join y b on b.place = a.place and b.t >= a.t + 5 join y x on x.place = a.place and x.t between a.t and b.t where a.n >= 12 group by 1, 2, 3),
b1 as (select place, j, c, [0, j] path from c where i = 0), {", ".join(STEP.format(k=k, p=k - 1) for k in range(2, 7))}, al as ({" union all ".join(f"select {k} k, * from b{k}" for k in range(1, 7))}), bi as (select al.*, n * ln(greatest(c, 1e-12) / n) + 3 * k * ln(n) bic from al join (select distinct place, n from y) u on u.place = al.place and u.n = al.j), be as (select place, arg_min(path, (bic, k)) path from bi group by 1), sg as (select place, unnest(generate_series(0, len(path) - 2)) s, path from be)
select sg.place, s as segment, min(y.idx) as "first", max(y.idx) as "last", count(*)::bigint n, round(exp(4 * regr_slope(l, t)) - 1, 6) growth from sg join y on y.place = sg.place and y.t >= path[s + 1] and y.t < path[s + 2] group by 1, 2""")
def regimes(spark, sf_dir):
    return models.regimes(quarters(spark, sf_dir)).withColumn("growth", r("growth"))


from . import backtests, calculators, geometry, market, parishes, rates, rollup, scores, views  # noqa: E402, F401  register their queries
