"""Queries of the panel's tables, the guide, keys and published outputs."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import keys
from ..operators import parishes as PA
from ..operators import views as V
from ..sources import feeds, landed
from .base import query, r, rounded
from .panels import M, Q, Y, column, quarters, stored, table, years
from .parishes import PRICES, SP, SY, parts, prices
from .scores import NATIONAL, features_of, features_sql, national

FEATS = f"with {Q}, {Y}, {features_sql('q')}, nm as (select n_nationkey::bigint place, n_name as name from nation)"


def named(spark, sf_dir):
    names = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("place"), F.col("n_name").alias("name"))
    return features_of(spark, sf_dir).join(names, "place")


@query(f"{FEATS} select place, name, round(score, 4) score_overall, (row_number() over (order by score desc nulls last, place))::int as \"position\" from f join nm using (place) where contains(lower(name), '1')")
def ranking_table(spark, sf_dir):
    return V.ranked_table(named(spark, sf_dir), "score_overall", search=" 1").select("place", "name", r("score_overall", 4).alias("score_overall"), "position")


@query(f"{FEATS}, b as (select (count(*) filter (band = 'red'))::bigint red, (count(*) filter (band = 'amber'))::bigint amber, (count(*) filter (band = 'green'))::bigint green, (count(*) filter (band is null))::bigint as \"none\", quantile_cont(price, 0.5) filter (band = 'red') a, quantile_cont(price, 0.5) filter (band = 'green') g from f) select red, amber, green, \"none\", round(a, 4) price_red, round(g, 4) price_green, round(a / g, 6) ratio, case when a / g <= 0.85 then 'cheaper' when a / g >= 1.15 then 'dearer' when a / g is not null then 'alike' end reading from b")
def band_summary(spark, sf_dir):
    return rounded(V.band_summary(features_of(spark, sf_dir)), 4, ratio=6)


@query(f"{FEATS}, a as (select place, price * 90 / 100 home, rent * 90 / 2 rent_home, rent * 20 inc from f where price is not null), pa as (select *, home * 9e-1 loan, home * 9e-1 * (35e-3 / 12) / (1 - pow(1 + 35e-3 / 12, -360)) pay, home * 9e-1 * (5e-2 / 12) / (1 - pow(1 + 5e-2 / 12, -360)) pay_rule from a) select place, round(home, 2) home, round(pay, 4) pay, round(pay / inc, 6) effort, round(pay_rule / inc, 6) effort_rule, round(home / (inc * 14), 6) years_of_income, round(pay / rent_home - 1, 6) pay_vs_rent, round(35e-3 + 13e-3 - rent_home * 12 / home, 6) breakeven from pa")
def affordability(spark, sf_dir):
    rows = features_of(spark, sf_dir).withColumns({"price": F.col("price") / 100, "income": F.col("rent") * 20, "rent": F.col("rent") / 2, "code": F.lpad(F.col("place").cast("string"), 4, "0")})
    out = V.affordability(rows, 3.5).where("aff is not null").select("place", "aff.*")
    return rounded(out.select("place", "home", "pay", "effort", "effort_rule", "years_of_income", "pay_vs_rent", "breakeven"), 6, home=2, pay=4)


@query(f"{FEATS}, d as (select quantile_cont(g1, 0.05) a, quantile_cont(g1, 0.95) b, quantile_cont(price, 0.05) c, quantile_cont(price, 0.95) e from f), so as (select -greatest(abs(a), abs(b)) low, greatest(abs(a), abs(b)) high, 'growth' metric from d union all select c, e, 'price' from d) select metric, i, round(low + (high - low) * i / 4, 4) stop from so, unnest(range(5)) t(i)")
def map_stops(spark, sf_dir):
    rows = features_of(spark, sf_dir).agg(V.domain(F.col("price_growth_1y"), True).alias("growth"), V.domain(F.col("price")).alias("price"))
    each = F.array(*[F.struct(F.lit(m).alias("metric"), V.stops(F.col(m), 5).alias("s")) for m in ("growth", "price")])
    return rows.select(F.inline(each)).select("metric", F.posexplode("s").alias("i", "stop")).select("metric", F.col("i").cast("bigint").alias("i"), r("stop", 4).alias("stop"))


@query(f"{FEATS} select place, reference, round(v, 4) as value, round(price * 95e-2 / nullif(v, 0) - 1, 6) difference from (select place, price, unnest([struct_pack(reference := 'price', v := price), struct_pack(reference := 'rent', v := rent)], recursive := true) from f) where v is not null")
def safety_margins(spark, sf_dir):
    return rounded(V.safety_margins(features_of(spark, sf_dir), F.col("price") * 0.95, ["price", "rent"]), 6, value=4)


@query(f"with {SY}, e as (select max(idx) e from sy), pr as (select a.place, a.value rent, a.value / c.value - 1 g3, a.n from sy a join e on a.idx = e left join sy c on c.place = a.place and c.idx = a.idx - 3), h as (select * from pr where g3 is not null and n >= 20) select place, round(g3, 6) rent_g3y, round(rent, 4) rent from h where (select count(*) from h) >= 10 order by g3 desc, place limit 12")
def rent_risers(spark, sf_dir):
    y = parts(spark, sf_dir, "year")
    return rounded(V.rent_risers(PA.rent_table(column(y, "value"), column(y, "n")), least=20).select("place", "rent_g3y", "rent"), 6, rent=4)


@query(f"with {SP}, {PRICES} select place, round(price, 4) price, (row_number() over (order by price desc nulls last, place))::int as \"position\" from pr where town = 3")
def parish_list(spark, sf_dir):
    rows = prices(spark, sf_dir).withColumn("name", F.lpad(F.col("place").cast("string"), 9, "0"))
    return V.parish_list(rows, F.col("town") == 3).select("place", r("price", 4).alias("price"), "position")


@query(f"with {SP}, {PRICES} select place, round(price * 10 / 12, 4) irs_month, round(price * 81 * (3e-2 / 12) / (1 - pow(1 + 3e-2 / 12, -360)) / (price * 10 / 12), 6) effort from pr")
def parish_effort(spark, sf_dir):
    rows = prices(spark, sf_dir).select("place", "price").withColumn("irs_median", F.col("price") * 10)
    return rounded(V.parish_effort(rows, 3.0).select("place", "irs_month", "effort"), 6, irs_month=4)


@query("with p as (select s_suppkey % 25 town, case when s_suppkey % 4 <> 0 then s_suppkey % 3 end sc, (s_suppkey % 2)::double he, 100.0::double + s_suppkey % 50 n, case when s_suppkey % 3 = 0 then (s_suppkey % 10) / 10e0 end f, (s_suppkey % 7) / 10e0 rp, 10.0::double + s_suppkey % 5 b from supplier) select town, round(sum(case when sc is not null then sc + he end) / sum(case when sc is not null then n end) * 1000, 6) services, round(sum(coalesce(f, 0) * n) / sum(n), 6) flood, round(sum(rp * b) / sum(b), 6) repair from p group by 1")
def guide_totals(spark, sf_dir):
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select((k % 25).alias("town"), F.when(k % 4 != 0, k % 3).alias("n_school"), (k % 2).cast("double").alias("n_health"), (100.0 + k % 50).alias("homes"), F.when(k % 3 == 0, (k % 10) / 10).alias("flooded"), ((k % 7) / 10).alias("repair_share"), (10.0 + k % 5).alias("buildings"))
    return rounded(V.parish_totals(rows))


@query(f"{FEATS}, gc as (select place, price cost, 240000 / price - 1 fit, g1, score from f where price is not null and 240000 / price - 1 >= -5e-2), gk as (select place, unnest([struct_pack(k := 'fit', v := fit, w := 2, d := 1), struct_pack(k := 'price_growth_1y', v := g1, w := 3, d := 1), struct_pack(k := 'score_overall', v := score, w := 1, d := -1)], recursive := true) from gc), gp as (select place, k, w, d, (rank() over (partition by k order by v) - 1 + (count(*) over (partition by k, v) - 1) / 2e0) / nullif(count(*) over (partition by k) - 1, 0) p from gk where v is not null), gs as (select place, sum(w * coalesce(case when d < 0 then 1 - p else p end, 5e-1)) / sum(w) s from gp group by 1) select gc.place, round(cost, 4) cost, round(fit, 6) fit, round(s, 6) score, (row_number() over (order by s desc, gc.place))::int as \"position\" from gc join gs using (place)")
def guide_results(spark, sf_dir):
    criteria = spark.createDataFrame([("fit", 2, 1), ("price_growth_1y", 3, 1), ("score_overall", 1, -1)], "key string, weight int, direction int")
    out = V.guide(stored(features_of(spark, sf_dir)), criteria, F.lit(240000.0), F.col("price"), ["fit", "price_growth_1y", "score_overall"])
    return rounded(out.drop("missing"), 6, cost=4)


TENANTS = "tr as (select place, rent * 80 rent, case when place % 3 <> 0 then rent * 2000 end pi, case when place % 4 <> 1 then rent * 2600 end irs, rent * 170 wage from f), tp as (select place, rent, unnest([struct_pack(profile := 'one, parish', income := pi / 12), struct_pack(profile := 'one, municipality', income := irs / 12), struct_pack(profile := 'two, municipality', income := irs / 6), struct_pack(profile := 'one wage', income := wage::double), struct_pack(profile := 'two wages', income := 2 * wage::double)], recursive := true) from tr), tb as (select place, profile, income, rent / income share, case when rent / income <= 35e-2 then 'easy' when rent / income <= 5e-1 then 'heavy' else 'too heavy' end burden from tp where income > 0 and rent is not null)"


def tenants(spark, sf_dir):
    k, rent = F.col("place"), F.col("rent")
    return features_of(spark, sf_dir).select("place", (rent * 80).alias("rent"), F.when(k % 3 != 0, rent * 2000).alias("parish_irs"), F.when(k % 4 != 1, rent * 2600).alias("irs_median"), (rent * 170).alias("wage"))


@query(f"{FEATS}, {TENANTS} select place, profile, round(income, 4) income, round(share, 6) share, burden from tb")
def tenant_profiles(spark, sf_dir):
    return rounded(V.tenant_profiles(tenants(spark, sf_dir)), 6, income=4)


@query(f"{FEATS}, {TENANTS}, e as (select place, count(*) filter (burden = 'easy') easy from tb group by 1), vd as (select tr.place, coalesce(easy, 0)::bigint easy, case when tr.place % 5 <> 2 then (tr.place % 10) / 10e0 end above from tr left join e using (place)) select place, easy, above, case when easy > 0 and (above is null or above >= 3e-1) then 'viable' when easy > 0 or above >= 15e-2 then 'tight' else 'hard' end verdict from vd")
def tenant_verdicts(spark, sf_dir):
    rows = stored(tenants(spark, sf_dir))
    return V.tenant_verdict(rows, rows.select("place", F.when(F.col("place") % 5 != 2, (F.col("place") % 10) / 10).alias("above")))


@query(f"{FEATS}, x as (select place, price / nullif(lag(price) over (order by place), 0) - 1 d from f) select place, round(d, 6) difference, case when abs(d) <= 1e-1 then 'aligned' when abs(d) <= 25e-2 then case when d > 0 then 'above' else 'below' end else case when d > 0 then 'well above' else 'well below' end end reading from x where d is not null")
def market_positions(spark, sf_dir):
    """Each place's price against the place's before."""
    rows = features_of(spark, sf_dir).select("place", "price", F.lag("price").over(W.orderBy("place")).alias("other"))
    return rows.withColumn("x", V.against(F.col("price"), F.col("other"))).where("x is not null").select("place", r("x.difference").alias("difference"), "x.reading")


@query(f"{FEATS}, x as (select place, rent * 70 / 12e5 u, rent * 6e-1 * 70 / 12e5 l from f) select place, round(u, 6) rent_user, case when u <= 35e-2 then 'fits' when l <= 35e-2 then 'cheap part' when u <= 5e-1 then 'tight' when u is not null then 'over' end fit from x")
def rent_fit(spark, sf_dir):
    rows = features_of(spark, sf_dir).select("place", "rent", (F.col("rent") * 0.6).alias("rent_q1"))
    return rounded(V.rent_fit(rows, F.lit(1_200_000.0), F.lit(70.0), F.lit(0.35)))


METRICS = {"price": "price", "price_growth_1y": "g1", "gross_yield": "gross_yield", "score_overall": "score"}


@query(f"{FEATS}, md as (select {', '.join(f'quantile_cont({c}, 5e-1) d_{m}' for m, c in METRICS.items())} from f), x as (select place, unnest([{', '.join(f'struct_pack(metric := {chr(39)}{m}{chr(39)}, v := {c}::double, d := d_{m}::double)' for m, c in METRICS.items())}], recursive := true) from f cross join md) select place, metric, round(v, 6) as \"value\", round(d, 6) as \"median\", round(case when d > 0 then v / d - 1 end, 6) difference, case when d > 0 and v / d - 1 >= 1 then 'multiple' when v > d then 'above' when v < d then 'below' else 'level' end reading from x where v is not null and d is not null")
def place_readings(spark, sf_dir):
    return rounded(V.place_readings(stored(features_of(spark, sf_dir)), list(METRICS)))


@query(f"with {Q}, {M}, {NATIONAL}, s as (select place, component, 100 / (1 + exp(-z)) s from u where v is not null and z is not null) select place, round(avg(s), 4) overall, count(*)::bigint known, case when count(*) > 1 then arg_min(component, (-s, component)) end component, round(case when count(*) > 1 then max(s) end, 4) score from s group by 1")
def national_readings(spark, sf_dir):
    parts_ = national(spark, sf_dir).select("place", F.explode("components").alias("component", "x")).select("place", "component", "x.value", "x.score")
    return rounded(V.strongest(parts_), 4)


# keys

DAYS = "d as (select distinct year(o_orderdate) y, quarter(o_orderdate) q, month(o_orderdate) m from orders)"
NAMES = "['" + "', '".join(keys.MONTHS) + "']"
FORM = "(y + m) % 7"


@query(f"""with {DAYS} select y, m, case when {FORM} in (0, 1, 2) then y || 'Q' || q when {FORM} in (3, 4, 5) then y || '-' || lpad(m::varchar, 2, '0') else y::varchar end label, case when {FORM} in (0, 1, 2) then 'quarter' when {FORM} in (3, 4, 5) then 'month' else 'year' end kind, case when {FORM} in (0, 1, 2) then y * 100 + q when {FORM} in (3, 4, 5) then y * 100 + m else y * 100 end sort_key from d""")
def period_labels(spark, sf_dir):
    """What labels in seven spellings, made from the orders' dates, are read as."""
    d = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q"), F.month("o_orderdate").alias("m")).distinct()
    y, q, m = (F.col(c).cast("string") for c in ("y", "q", "m"))
    name = F.element_at(F.array(*map(F.lit, keys.MONTHS)), F.col("m"))
    spelled = [F.concat(q, F.lit(".º Trimestre de "), y), F.concat(F.lit(" T"), q, F.lit(" "), y), F.concat(y, F.lit("q"), q), F.concat(y, F.lit("M"), m), F.concat(F.initcap(name), F.lit(" de "), y), F.concat(F.upper(name), F.lit(" "), y), F.concat(y, F.lit("-"), m)]
    rows = stored(d.withColumn("raw", F.element_at(F.array(*spelled), (F.expr(FORM) + 1).cast("int")))).withColumn("p", keys.period(F.col("raw")))
    return rows.select("y", "m", "p.label", "p.kind", "p.sort_key")


K4 = "lpad((c_custkey % 10000)::varchar, 4, '0')"


@query(f"""select c_custkey id, case c_custkey % 8 when 0 then 'municipality' when 1 then 'parish' when 2 then 'nuts3' when 3 then 'nuts2' when 4 then 'nuts1' when 5 then 'national' when 6 then 'nuts3' else 'other' end as level, case when c_custkey % 8 = 0 then {K4} end municipality from customer""")
def place_codes(spark, sf_dir):
    """The levels and municipalities of codes made from the customers' keys, in all forms."""
    k = F.col("c_custkey")
    digits = F.lpad((k % 10000).cast("string"), 4, "0")
    forms = [F.concat(F.lit(" 11a"), digits), F.concat(F.lit("11101"), digits), F.lit("1b0"), F.concat(F.lit("1"), (k % 10).cast("string")), (k % 10).cast("string"), F.when(k % 3 == 0, "pt").otherwise("PT "), F.lit("200"), F.concat(digits, F.lit("x"))]
    rows = table(spark, sf_dir, "customer").select(k.alias("id"), F.element_at(F.array(*forms), (k % 8 + 1).cast("int")).alias("code"))
    return rows.select("id", keys.level(F.col("code")).alias("level"), keys.municipality(F.col("code")).alias("municipality"))


@query("with d as (select distinct year(o_orderdate) y, quarter(o_orderdate) q, month(o_orderdate) m from orders) select y * 100 + q as quarter_key, y * 100 + m as month_key, ((y * 4 + q - 1 - 5) // 4) * 100 + (y * 4 + q - 1 - 5) % 4 + 1 quarter_before, ((y * 12 + m - 1 - 14) // 12) * 100 + (y * 12 + m - 1 - 14) % 12 + 1 month_before, y || 'Q' || q quarter_label, y || '-' || lpad(m::varchar, 2, '0') month_label, y * 12 + q * 3 - 1 end_month, case when y >= 2000 then y || 'Q' || q end quarter_of_month, last_day(make_date(y, q * 3, 1))::varchar quarter_end, case when y * 12 + q * 3 - 3 <= 1998 * 12 + 5 then 'nowcast' else 'forecast' end kind from d")
def period_arithmetic(spark, sf_dir):
    d = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q"), F.month("o_orderdate").alias("m")).distinct()
    rows = d.select((F.col("y") * 100 + F.col("q")).cast("bigint").alias("quarter_key"), (F.col("y") * 100 + F.col("m")).cast("bigint").alias("month_key"))
    quarter = keys.index_of_key(F.col("quarter_key"), "quarter")
    month = keys.key_label(F.col("month_key"), "month")
    return rows.select(
        "quarter_key", "month_key", keys.shift_key(F.col("quarter_key"), "quarter", 5).alias("quarter_before"), keys.shift_key(F.col("month_key"), "month", 14).alias("month_before"), keys.key_label(F.col("quarter_key"), "quarter").alias("quarter_label"), month.alias("month_label"),
        keys.quarter_end_month(quarter).alias("end_month"), keys.quarter_of_month_label(month).alias("quarter_of_month"), keys.period_end(keys.key_label(F.col("quarter_key"), "quarter"))["day"].cast("string").alias("quarter_end"), keys.forecast_kind(quarter, F.to_date(F.lit("1998-06-15"))).alias("kind"),
    )


# outputs


@query(f"with {Q}, s as (select place, idx, (idx // 4) || 'Q' || (idx % 4 + 1) as period, round(value, 2) v, row_number() over (partition by place order by idx) k, count(*) over (partition by place) n from q) select place, max(n)::int size, min_by(period, k) \"first\", max_by(period, k) \"last\", max_by(v, k) \"value\" from s group by 1")
def published_series(spark, sf_dir):
    rows = feeds.series_by_place(column(quarters(spark, sf_dir), "value"), "quarter", 2)
    return rows.select("place", F.size("series").alias("size"), F.col("series")[0]["period"].alias("first"), F.element_at("series", -1)["period"].alias("last"), F.element_at("series", -1)["value"].alias("value"))


@query(f"with {Q}, s as (select *, lag(value) over (partition by place order by idx) b, row_number() over (partition by place order by idx desc) k from q) select place, place || '-preco-' || (idx // 4) || 'Q' || (idx % 4 + 1) as guid, 'P' || place || ': preço mediano de venda ' || (idx // 4) || 'T' || (idx % 4 + 1) title from s where k <= 8 and b is not null")
def feed_items(spark, sf_dir):
    rows = column(quarters(spark, sf_dir), "value").withColumn("name", F.concat(F.lit("P"), F.col("place").cast("string")))
    return feeds.price_items(rows).select("place", "guid", "title")


@query("with s as (select case when s_suppkey % 50 = 7 then 'geo' end g, s_suppkey % 5 c from supplier), t as (select * from s where g is null and c <> 3) select (count(*) filter (c in (0, 1)) > 0 and count(*) filter (c = 2) = 0) live, (count(*) filter (c in (0, 1)))::bigint n_ok, (count(*) filter (c = 2))::bigint n_cache, (count(*) filter (c = 4))::bigint n_error from t")
def live_state(spark, sf_dir):
    """The state of a build whose sources are the suppliers."""
    k = F.col("s_suppkey")
    said = F.element_at(F.array(*map(F.lit, ("ok (3 rows)", "ok", "CACHE (old)", "sem código", "ERRO: x"))), (k % 5 + 1).cast("int"))
    rows = table(spark, sf_dir, "supplier").select(F.when(k % 50 == 7, "geo").otherwise(k.cast("string")).alias("key"), said.alias("status"))
    return landed.live_state(rows)
