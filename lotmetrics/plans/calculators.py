"""Queries of the calculators over a parameter row for each supplier."""

from pyspark.sql import functions as F

from ..functions import finance, keys
from ..operators import calculators as C
from .base import query, r, rounded
from .panels import Q, months, quarters, table


def homes(spark, sf_dir):
    """Parameters of a purchase and a letting, by arithmetic on keys and balances."""
    s, b = F.col("s_suppkey"), F.col("s_acctbal")
    price = 90000 + 60 * (b + 1000)
    return table(spark, sf_dir, "supplier").select(
        s.alias("id"), price.alias("price"), (0.1 + 0.1 * (s % 4)).alias("down"), (1.5 + 0.1 * (s % 30)).alias("rate"), (20 + s % 21).cast("double").alias("years"), (F.round(price * 0.0035) + s % 300).alias("rent"),
        (0.01 * (s % 4)).alias("rent_growth"), (0.01 * (s % 6) - 0.01).alias("price_growth"), (0.5 * (s % 4)).alias("vacancy"), (30.0 + s % 50).alias("condo"), (150.0 + s % 100).alias("ins"), (0.02 + 0.01 * (s % 5)).alias("maint"),
        (0.003 + 0.0005 * (s % 4)).alias("imi_rate"), F.when(s % 3 == 0, price * 0.7).alias("vpt"), F.array(F.lit(1), F.lit(5), F.lit(10))[(s % 3).cast("int")].alias("contract_years"), (5 + s % 11).cast("int").alias("hold"),
        F.lit(0.05).alias("sell_cost"), F.lit(0.35).alias("marginal"), F.lit(800.0).alias("closing"), (s % 5 == 0).alias("island"), F.lit(2026).alias("start_year"), (20000.0 + (s * 977) % 90000).alias("savings"),
        (1200.0 + (s * 37) % 3000).alias("income"), (0.02 + 0.01 * (s % 3)).alias("alt"),
    )


#: The same in SQL, with the tax brackets (region, use, low, high, rate, off).
H = """h as (select s_suppkey id, 90000 + 60 * (s_acctbal + 1000) price, 1e-1 + 1e-1 * (s_suppkey % 4) down, 15e-1 + 1e-1 * (s_suppkey % 30) rate, (20 + s_suppkey % 21)::double as years,
round((90000 + 60 * (s_acctbal + 1000)) * 35e-4) + s_suppkey % 300 rent, 1e-2 * (s_suppkey % 4) rent_growth, 1e-2 * (s_suppkey % 6) - 1e-2 price_growth, 5e-1 * (s_suppkey % 4) vacancy, 3e1 + s_suppkey % 50 condo,
15e1 + s_suppkey % 100 ins, 2e-2 + 1e-2 * (s_suppkey % 5) maint, 3e-3 + 5e-4 * (s_suppkey % 4) imi_rate, case when s_suppkey % 3 = 0 then (90000 + 60 * (s_acctbal + 1000)) * 7e-1 end vpt, [1, 5, 10][s_suppkey % 3 + 1] contract_years,
(5 + s_suppkey % 11)::int hold, 5e-2 sell_cost, 35e-2 marginal, 8e2 closing, s_suppkey % 5 = 0 island, 2026 start_year, 2e4 + (s_suppkey * 977) % 90000 savings, 12e2 + (s_suppkey * 37) % 3000 income, 2e-2 + 1e-2 * (s_suppkey % 3) alt from supplier)"""
_ROWS = [(use, k, limit, rate, off) for use, t in finance.TRANSFER_TAX.items() for k, (limit, rate, off) in enumerate(t)]
BRACKETS = f"""main(use, k, high, rate, off) as (values {", ".join(f"('{u}', {k}, {'1e18' if h is None else f'{h}::double'}, {x}::double, {'null' if o is None else f'{o}::double'})" for u, k, h, x, o in _ROWS)}),
away as (select use, k, case when high < 1e18 then floor(high * 125e-2 + 5e-1) else high end high, rate, case when off is null then null when k = 0 then 0e0 else -1e0 end off from main),
steps as (select use, k, high, rate, off from away where k = 0 union all select a.use, a.k, a.high, a.rate, case when a.off is null then null else floor((s.off + (a.rate - s.rate) * s.high) * 100 + 5e-1) / 100 end from steps s join away a on a.use = s.use and a.k = s.k + 1),
brackets as (select false island, use, coalesce(lag(high) over (partition by use order by k), -1e18) low, high, rate, coalesce(off, 0) off from main union all select true, use, coalesce(lag(high) over (partition by use order by k), -1e18), high, rate, coalesce(off, 0) from steps)"""
PAY = "case when {1} = 0 then {0} / ({2} * 12) else {0} * ({1} / 1200) / (1 - pow(1 + {1} / 1200, -({2} * 12))) end"
RATE = "case when {0} <= 2300 and {2} <= 2029 then 1e-1 when {1} >= 10 then 1e-1 when {1} >= 5 then 15e-2 else 25e-2 end"


def pay(loan, rate, years):
    return PAY.format(loan, rate, years)


@query(f"""with recursive {BRACKETS}, {H} select h.id, round(b.rate * price - b.off, 4) transfer, round(case when price <= case when h.island then 826228e0 else 660982e0 end then 8e-3 * greatest(price - case when h.island then 413174e0 else 330539e0 end, 0) else 8e-3 * price end, 4) young_stamp,
round(greatest(b.rate * price - b.off, 0) + 8e-3 * price + 6e-3 * price * (1 - down), 4) total from h join brackets b on b.use = 'own' and b.island = h.island and price > b.low and price <= b.high""")
def island_taxes(spark, sf_dir):
    rows = homes(spark, sf_dir)
    made = finance.purchase_taxes(F.col("price"), F.col("price") * (1 - F.col("down")), "own", False, F.col("island"))
    young = finance.purchase_stamp(F.col("price"), "own", True, F.col("island"))
    return rows.select("id", made.alias("x"), young.alias("young_stamp")).select("id", r("x.transfer", 4).alias("transfer"), r("young_stamp", 4).alias("young_stamp"), r("x.total", 4).alias("total"))


LOANS = "l as (select id, price * (1 - down) loan, years, rate f, case when id % 7 <> 0 then rate + 3e-1 end i, rate + 5e-1 o, rate + 9e-1 p, 3 + id % 3 fix_short, 10 fix_long from h)"


def loans(spark, sf_dir):
    c = F.col
    return homes(spark, sf_dir).select(
        "id", (c("price") * (1 - c("down"))).alias("loan"), "years", c("rate").alias("f"), F.when(c("id") % 7 != 0, c("rate") + 0.3).alias("i"), (c("rate") + 0.5).alias("o"), (c("rate") + 0.9).alias("p"), (3 + c("id") % 3).alias("fix_short"), F.lit(10).alias("fix_long")
    )


@query(f"""with recursive {H}, {LOANS}, p as (select id, loan, years, f, unnest([struct_pack(plan := 'f', rate := f, fixed := 1e0), struct_pack(plan := 'i', rate := i, fixed := fix_short::double), struct_pack(plan := 'o', rate := o, fixed := fix_long::double), struct_pack(plan := 'p', rate := p, fixed := years)]) x from l),
q as (select id, x.plan as plan, loan, years, x.rate rate, least(x.fixed, years) fixed, d::double delta, greatest(f + d, 0) later from p, (values (-1), (0), (1), (2)) t(d) where x.rate is not null),
m as (select *, 0 k, loan owed, {pay('loan', 'rate', 'years')} payment, 0e0 total, 0e0 interest from q
union all select id, plan, loan, years, rate, fixed, delta, later, k + 1, owed - (payment - owed * (case when k < fixed * 12 then rate else later end) / 1200),
case when k + 1 = fixed * 12 and k + 1 < years * 12 then {pay('(owed - (payment - owed * rate / 1200))', 'later', '((years * 12 - k - 1) / 12)')} else payment end, total + payment, interest + owed * (case when k < fixed * 12 then rate else later end) / 1200 from m where k < years * 12)
select id, plan, delta, fixed fixed_years, round(min(payment) filter (k = 0), 4) as "first", round(max(payment), 4) highest, round(max(total), 2) total, round(max(interest), 2) interest from m group by id, plan, delta, fixed""")
def loan_plans(spark, sf_dir):
    rows = C.loan_plans(loans(spark, sf_dir))
    return rows.select("id", "plan", "delta", "fixed_years", r("first", 4).alias("first"), r("highest", 4).alias("highest"), r("total", 2).alias("total"), r("interest", 2).alias("interest"))


OWED = "case when loan > 0 and {0} < years * 12 then case when rate = 0 then loan * (1 - ({0}) / (years * 12)) else loan * (pow(1 + rate / 1200, years * 12) - pow(1 + rate / 1200, {0})) / (pow(1 + rate / 1200, years * 12) - 1) end else 0 end"
INVEST = f"""x as (select h.*, price * (1 - down) loan, greatest(b.rate * price - b.off, 0) transfer, 8e-3 * price stamp, 6e-3 * price * (1 - down) of_loan, coalesce(vpt, price) * imi_rate imi from h join brackets b on b.use = 'second' and b.island = h.island and price > b.low and price <= b.high),
y as (select *, rent * pow(1 + rent_growth, t - 1) rent_t, start_year + t - 1 as yr, {pay('loan', 'rate', 'years')} * (least(t * 12, years * 12) - least(t * 12 - 12, years * 12)) debt, {OWED.format('(t * 12)')} owed from x, unnest(generate_series(1, hold)) s(t)),
z as (select *, rent_t * (12 - vacancy) gross, {RATE.format('rent_t', 'contract_years', 'yr')} tax_rate from y),
c as (select *, gross - imi - condo * 12 - maint * gross - ins noi, greatest(gross - imi - condo * 12 - maint * gross, 0) * tax_rate irs from z),
e as (select id, any_value(price - loan + transfer + stamp + of_loan + closing) cash, max_by(price * pow(1 + price_growth, hold) * (1 - sell_cost) - owed - greatest(price * pow(1 + price_growth, hold) * (1 - sell_cost) - (price + transfer + stamp + closing), 0) * 5e-1 * marginal, t) net_sale,
list(noi - irs - debt order by t) cfs, min_by(noi, t) noi, min_by(irs, t) irs, min_by(debt, t) debt, min_by(gross, t) gross, any_value(price) price, any_value(rent) rent, any_value(rate) rate, any_value(loan) loan, any_value(transfer + stamp + of_loan + closing) costs from c group by id),
f as (select *, [-cash] || list_transform(cfs, lambda v, i: case when i = len(cfs) then v + net_sale else v end) flows from e)"""
WORTH = "list_sum(list_transform(flows, lambda v, i: v / pow(1 + {0}, i - 1)))"
IRR = f"""b as (select id, -99e-2 lo, 1e0 hi, 0 k, flows, sign({WORTH.format('(-99e-2)')}) side from f where {WORTH.format('(-99e-2)')} * {WORTH.format('1e0')} <= 0
union all select id, case when {WORTH.format('((lo + hi) / 2)')} * side > 0 then (lo + hi) / 2 else lo end, case when {WORTH.format('((lo + hi) / 2)')} * side > 0 then hi else (lo + hi) / 2 end, k + 1, flows, side from b where k < 60)"""


@query(f"""with recursive {BRACKETS}, {H}, {INVEST}, {IRR} select f.id, round(cash, 2) cash, round(net_sale, 2) net_sale, round(list_sum(f.flows), 2) profit, round(lo, 6) irr, round((noi - irs) / (price + costs), 6) net_yield, round((noi - irs - debt) / cash, 6) cash_on_cash,
round((noi - irs - debt) / 12, 4) cash_month, round(noi / price, 6) cap_rate, round(case when debt > 0 then noi / debt end, 6) dscr, round((gross - noi + rent * 12 - gross) / (rent * 12), 6) cost_ratio, noi / price > rate / 100 positive_leverage from f left join b on b.id = f.id and b.k = 60""")
def invest(spark, sf_dir):
    rows = C.invest(homes(spark, sf_dir)).withColumn("t", C.investor_tests())
    x = F.col("invest")
    return rows.select(
        "id", r(x["cash"], 2).alias("cash"), r(x["net_sale"], 2).alias("net_sale"), r(x["profit"], 2).alias("profit"), r(x["irr"]).alias("irr"), r(x["net_yield"]).alias("net_yield"), r(x["cash_on_cash"]).alias("cash_on_cash"),
        r("t.cash_month", 4).alias("cash_month"), r("t.cap_rate").alias("cap_rate"), r("t.dscr").alias("dscr"), r("t.cost_ratio").alias("cost_ratio"), F.col("t.positive_leverage").alias("positive_leverage"),
    )


@query(f"""with recursive {BRACKETS}, g as (select s_suppkey from supplier), h0 as (select * from (with {H} select * from h)), h as (select * replace (rate + 2 as rate, rent * (1 - 15e-2) as rent, least(12, 3e0) as vacancy), savings reserve from h0), {INVEST},
calm as (select h0.id, price - price * (1 - down) + greatest(b.rate * price - b.off, 0) + 8e-3 * price + 6e-3 * price * (1 - down) + closing cash from h0 join brackets b on b.use = 'second' and b.island = h0.island and price > b.low and price <= b.high),
k as (select c.id, any_value(c.price) * (1 - 25e-2) as worth, max(owed) filter (t = least(2, hold)) owed, max((noi - irs - debt) / 12) filter (t = 1) cash_month, any_value(reserve) reserve, any_value(sell_cost) sell_cost from c group by c.id)
select k.id, round(cash_month, 4) cash_month, round(owed, 2) balance, round(worth * (1 - sell_cost) - owed - cash, 2) loss_if_sold, case when cash_month < 0 then round(reserve / -cash_month, 4) end months_covered, cash_month >= 0 or reserve / -cash_month >= 24 survives from k join calm using (id)""")
def crisis_test(spark, sf_dir):
    rows = homes(spark, sf_dir)
    out = C.crisis_test(rows, 2.0, 0.15, 3.0, 0.25, F.col("savings")).select("id", "crisis.*")
    return out.select("id", r("cash_month", 4).alias("cash_month"), r("balance", 2).alias("balance"), r("loss_if_sold", 2).alias("loss_if_sold"), r("months_covered", 4).alias("months_covered"), F.coalesce("survives", F.lit(False)).alias("survives"))


@query(f"""with recursive {BRACKETS}, {H}, o as (select *, least(35e-2 * income / ({pay('1e0', 'rate', 'years')}), 45e-2 * income / ({pay('1e0', '(rate + 15e-1)', 'years')})) carried from h),
s as (select id, 0e0 lo, 2e7 hi, 0 k from o union all select s.id, case when (mid - least(9e-1 * mid, carried) + greatest(b.rate * mid - b.off, 0) + 8e-3 * mid + 6e-3 * least(9e-1 * mid, carried) + closing) <= savings then mid else lo end,
case when (mid - least(9e-1 * mid, carried) + greatest(b.rate * mid - b.off, 0) + 8e-3 * mid + 6e-3 * least(9e-1 * mid, carried) + closing) <= savings then hi else mid end, k + 1 from (select *, (lo + hi) / 2 mid from s where k < 60) s join o on o.id = s.id join brackets b on b.use = 'own' and b.island = o.island and mid > b.low and mid <= b.high)
select s.id, round(lo, 2) price, round(least(9e-1 * lo, carried), 2) loan, case when carried < 9e-1 * lo then 'income' else 'savings' end as "limit" from s join o on o.id = s.id where k = 60""")
def highest_price(spark, sf_dir):
    c = F.col
    got = C.highest_price(c("savings"), c("income"), c("rate"), c("years"), "own", island=c("island"), closing=c("closing"))
    return homes(spark, sf_dir).select("id", got.alias("x")).select("id", r("x.price", 2).alias("price"), r("x.loan", 2).alias("loan"), "x.limit")


@query(f"""with {H}, a as (select *, start_year + t yr, rent * pow(1 + rent_growth, t) rent_t from h, unnest([1, 5, 10]) u(term), unnest(range(10)) s(t)), b as (select id, term, t, {RATE.format('rent_t', 'term', 'yr')} tax_rate, rent_t * (12 - vacancy) gross, (rent_t * (12 - vacancy)) * (1 - maint) - imi_rate * price - condo * 12 base, ins, marginal from a)
select id, term contract_years, round(sum(base - ins - greatest(base, 0) * tax_rate), 2) net, round(sum(greatest(base, 0) * tax_rate), 2) tax, round(sum(base - ins - greatest(base, 0) * tax_rate) filter (t = 0), 2) first_net, round(sum(greatest(base, 0) * marginal), 2) pooled_tax from b group by 1, 2""")
def landlord(spark, sf_dir):
    rows = homes(spark, sf_dir).withColumn("imi", F.col("imi_rate") * F.col("price")).withColumn("horizon", F.lit(10))
    return rounded(C.landlord(rows), 2)


@query(f"""with {H}, o as (select *, price * 6e-1 loan, price * 8e-1 buy_cost, imi_rate * price imi, id % 2 = 0 exempt from h), y as (select *, rent * pow(1 + rent_growth, t - 1) rent_t, start_year + t - 1 yr, {pay('loan', 'rate', 'years')} * 12 debt, {OWED.format('(hold * 12)')} owed from o, unnest(generate_series(1, hold)) s(t)),
z as (select *, rent_t * (12 - vacancy) * (1 - maint) - imi - condo * 12 base, {RATE.format('rent_t', 'contract_years', 'yr')} tax_rate from y),
e as (select id, any_value(hold) n, any_value(alt) alt, any_value(price * (1 - sell_cost) - loan - case when exempt then 0 else greatest(price * (1 - sell_cost) - buy_cost, 0) * 5e-1 * marginal end) as now_,
any_value(price * pow(1 + price_growth, hold) * (1 - sell_cost) - owed - greatest(price * pow(1 + price_growth, hold) * (1 - sell_cost) - buy_cost, 0) * 5e-1 * marginal) as end_, sum((base - ins - greatest(base, 0) * tax_rate - debt) * pow(1 + alt, hold - t)) let, sum((-imi - condo * 12 - ins - debt) * pow(1 + alt, hold - t)) idle from z group by id)
select id, round(now_, 2) as "now", round(now_ * pow(1 + alt, n), 2) sell, round(let + end_, 2) rent, round(idle + end_, 2) keep from e""")
def hold_options(spark, sf_dir):
    c = F.col
    rows = homes(spark, sf_dir).withColumns({"value": c("price"), "balance": c("price") * 0.6, "years_left": c("years"), "buy_cost": c("price") * 0.8, "imi": c("imi_rate") * c("price"), "exempt": c("id") % 2 == 0, "horizon": c("hold")})
    return rounded(C.hold_options(rows), 2)


@query(f"""with {H}, o as (select *, 4e-1 * price amount, price * 6e-1 balance, 5e-3 fee_rate from h), p as (select *, {pay('balance', 'rate', 'years')} pay0, {pay('(balance - amount)', 'rate', 'years')} pay1 from o)
select id, round(pay0, 4) pay_before, round(pay1, 4) pay_after, (years * 12)::int months_before, round(amount * fee_rate * 104e-2, 4) fee, round((pay0 - pay1) * years * 12 - amount, 2) saved, round(rate / 72, 6) gross_needed from p""")
def amortisation(spark, sf_dir):
    c = F.col
    got = C.amortisation(c("price") * 0.6, c("rate"), c("years"), c("price") * 0.4, False, F.lit(0.005))
    return homes(spark, sf_dir).select("id", got.alias("x")).select("id", r("x.pay_before", 4).alias("pay_before"), r("x.pay_after", 4).alias("pay_after"), "x.months_before", r("x.fee", 4).alias("fee"), r("x.saved", 2).alias("saved"), r("x.gross_needed").alias("gross_needed"))


@query(f"""with recursive {H}, o as (select *, price * 6e-1 balance, {pay('(price * 6e-1)', 'rate', 'years')} payment from h), m as (select id, 0 k, balance * 75e-2 owed, 0e0 interest, payment, rate from o
union all select id, k + 1, greatest(owed - (payment - owed * rate / 1200), 0), interest + owed * rate / 1200, payment, rate from m where owed > 5e-3) select id, max(k)::int months_after, round(max(interest), 2) interest from m group by id""")
def shorter_term(spark, sf_dir):
    c = F.col
    balance = c("price") * 0.6
    got = C.repaid(balance * 0.75, c("rate"), finance.instalment(balance, c("rate"), c("years")), c("years") * 12)
    return homes(spark, sf_dir).select("id", got.alias("x")).select("id", F.col("x.months").alias("months_after"), r("x.interest", 2).alias("interest"))


@query(f"""with recursive {H}, o as (select id, savings v, 5e4 + (id % 7) * 5e4 goal, 1e2 + id % 900 monthly, alt from h), m as (select id, 0 k, v, goal, monthly, alt from o union all select id, k + 1, v * (1 + alt / 12) + monthly, goal, monthly, alt from m where v < goal and k < 1200) select id, max(k)::int as months from m group by id""")
def months_to_goal(spark, sf_dir):
    c = F.col
    return homes(spark, sf_dir).select("id", C.months_to(5e4 + (c("id") % 7) * 5e4, c("savings"), 1e2 + c("id") % 900, c("alt")).alias("months"))


@query(f"""with {H}, o as (select *, price * (1 - down) loan from h), p as (select *, price - loan + 2e4 cash, {pay('loan', 'rate', 'years')} payment, {pay('loan', '(rate + 3)', 'years')} stressed from o), q as (select *, savings - cash "left", payment + 9e2 + 2e2 monthly, price - loan equity, greatest(savings - cash, 0) + 1e4 liquid from p)
select id, round("left", 2) as "left", round("left" / monthly, 6) months_covered, round(payment / income, 6) effort, round(stressed / income, 6) effort_stressed, round(equity / (equity + liquid), 6) concentration, round(price / (equity + liquid), 6) exposure from q""")
def before_signing(spark, sf_dir):
    c = F.col
    loan = c("price") * (1 - c("down"))
    got = C.before_signing(c("savings"), c("price") - loan + 2e4, F.lit(1e4), F.lit(9e2), finance.instalment(loan, c("rate"), c("years")), F.lit(2e2), c("income"), loan, c("rate"), c("years"), c("price"))
    return homes(spark, sf_dir).select("id", got.alias("x")).select("id", r("x.left", 2).alias("left"), *[r(f"x.{k}").alias(k) for k in ("months_covered", "effort", "effort_stressed", "concentration", "exposure")])


@query(f"""with recursive {BRACKETS}, {H}, o as (select h.*, price * (1 - down) loan, price * pow(1 + price_growth, hold) later, {pay('(price * (1 - down))', 'rate', 'years')} payment, hold * 12 m, income * 8e-1 budget from h),
p as (select o.*, price - loan + greatest(a.rate * price - a.off, 0) + 8e-3 * price + 6e-3 * loan + 1000 cash_now, greatest(b.rate * later - b.off, 0) + 8e-3 * later + 6e-3 * later * (1 - down) taxes_later from o join brackets a on a.use = 'own' and a.island = o.island and price > a.low and price <= a.high join brackets b on b.use = 'own' and b.island = o.island and later > b.low and later <= b.high),
s as (select id, 0 k, savings - cash_now own, savings other, loan owed, m, cash_now, taxes_later, later, down, payment, budget, rent, rate, alt, price from p union all select id, k + 1, own * (1 + alt / 12) + budget - payment - price * 12e-3 / 12, other * (1 + alt / 12) + budget - rent, owed * (1 + rate / 1200) - payment, m, cash_now, taxes_later, later, down, payment, budget, rent, rate, alt, price from s where k < m)
select id, round(cash_now, 2) cash_now, round(later * down + taxes_later + 1000, 2) cash_later, round(other, 2) saved, round(later - owed + own, 2) wealth_now, round(other - taxes_later - 1000, 2) wealth_wait from s where k = m""")
def wait_or_buy(spark, sf_dir):
    c = F.col
    got = C.wait_or_buy(c("price"), c("price_growth"), c("hold"), c("savings"), c("income") * 0.8, c("rent"), c("rate"), c("years"), c("down"), "own", F.lit(0.012), c("alt"), island=c("island"))
    return homes(spark, sf_dir).select("id", got.alias("x")).select("id", *[r(f"x.{k}", 2).alias(k) for k in ("cash_now", "cash_later", "saved", "wealth_now", "wealth_wait")])


@query(f"""with {H}, o as (select id, 5e2 + id % 500 built, 85e-2 usable, price / 150 sale, 12e2 + id % 300 cost, id % 2 = 0 rustic, rate / 100 * 2 i, price asking from h), p as (select *, case when rustic then 5e-2 else 65e-3 end + 8e-3 tax, built * usable * sale as worth, built * cost * (1 + 12e-2) works from o),
q as (select *, works + 2e3 * (1 + i) + 5e-1 * i * works + worth * 3e-2 costs, (1 + tax) * (1 + i) carry from p) select id, round(worth, 0) as worth, round(greatest((worth - costs - worth * 15e-2) / carry, 0), 2) most, round(worth - costs - asking * carry, 2) profit, round((costs - worth * 3e-2 + asking * carry) / 82e-2 / (built * usable), 4) sale_needed, round(asking * tax, 2) land_taxes from q""")
def land_value(spark, sf_dir):
    c = F.col
    got = C.land_value(5e2 + c("id") % 500, F.lit(0.85), c("price") / 150, 12e2 + c("id") % 300, F.lit(0.12), F.lit(0.03), F.lit(0.15), c("rate"), F.lit(2.0), F.lit(2e3), c("id") % 2 == 0, c("price"))
    return homes(spark, sf_dir).select("id", got.alias("x")).select("id", *[r(f"x.{k}", {"sale_needed": 4, "worth": 0}.get(k, 2)).alias(k) for k in ("worth", "most", "profit", "sale_needed", "land_taxes")])


YOUNG = "case when {0} <= 660982 then {1} * greatest({0} - 330539, 0) else {2} end"


@query(f"""with recursive {BRACKETS}, {H}, o as (select h.*, greatest(b.rate * price - b.off, 0) full_tax, price <= 450000 aided from h join brackets b on b.use = 'own' and not b.island and price > b.low and price <= b.high),
p as (select *, {YOUNG.format('price', '8e-2', 'full_tax')} + {YOUNG.format('price', '8e-3', '8e-3 * price')} buy from o), q as (select *, greatest(case when aided then 0 else 1e-1 * price end, greatest(savings - buy - 6e-3 * price * (case when aided then 1 else 9e-1 end) - closing, 0)) d from p), s as (select *, least(price, d) paid from q)
select id, aided guarantee, round(paid, 2) down, round(price - paid, 2) loan, round(paid + buy + 6e-3 * (price - paid) + closing, 2) cash, round({pay('(price - paid)', 'rate', '40')}, 4) pay, {pay('(price - paid)', '(rate + 15e-1)', '40')} <= 45e-2 * income within_effort from s""")
def first_home(spark, sf_dir):
    c = F.col
    got = C.first_home(c("price"), c("savings"), c("income"), c("rate"), c("closing"), True, True)
    return homes(spark, sf_dir).select("id", got.alias("x")).select("id", "x.guarantee", r("x.down", 2).alias("down"), r("x.loan", 2).alias("loan"), r("x.cash", 2).alias("cash"), r("x.pay", 4).alias("pay"), "x.within_effort")


PAYBACK = f"""o as (select *, price * (1 - down) + 15000 invested, price * down loan0, imi_rate * price imi, price * 105e-2 cost_basis, 1e2 * (id % 3) extra0, id % 2 = 0 lower_pay from h),
m as (select id, 0 k, loan0 owed, case when loan0 > 0 then {pay('loan0', 'rate', 'years')} end payment, 0e0 interest, 0e0 principal, 0e0 extra, 0e0 fee, rate, years, extra0, lower_pay, (hold + 10) * 12 n from o
union all select id, k + 1, owed - p - x, case when lower_pay and x > 0 and years * 12 - k - 1 > 0 then {pay('(owed - p - x)', 'rate', '((years * 12 - k - 1) / 12)')} else payment end, interest + i, principal + p, extra + x, fee + x * 5e-3 * 104e-2, rate, years, extra0, lower_pay, n
from (select *, case when owed - p > 5e-3 then least(extra0, owed - p) else 0 end x from (select *, case when owed > 5e-3 then least(payment - i, owed) else 0 end p from (select *, case when owed > 5e-3 then owed * rate / 1200 else 0 end i from m where k < n))) q),
e as (select id, k // 12 t, owed, interest, principal, extra, fee from m where k % 12 = 0),
y as (select o.*, b.t, b.owed, b.interest - a.interest i, b.principal - a.principal p, b.extra - a.extra x, b.fee - a.fee fee, rent * pow(1 + rent_growth, b.t - 1) rent_t, start_year + b.t - 1 yr from e a join e b on b.id = a.id and b.t = a.t + 1 join o on o.id = b.id),
z as (select *, rent_t * (12 - vacancy) * (1 - maint) - imi - condo * 12 base, {RATE.format('rent_t', 'contract_years', 'yr')} tax_rate, price * pow(1 + price_growth, t) as worth from y),
w as (select *, base - ins - greatest(base, 0) * tax_rate - i - p - x - fee cf, worth * (1 - sell_cost) - owed - greatest(worth * (1 - sell_cost) - cost_basis, 0) * 5e-1 * marginal sold from z),
v as (select *, -invested + sum(cf) over s cash, -invested + sum(cf + p + x) over s equity, -invested + sum(cf) over s + sold if_sold, sum(x) over s xs, sum(fee) over s fees, sum(i) over s ints from w window s as (partition by id order by t))"""
CROSS = "select id, min_by(t - 1 + case when before < 0 and {0} > before then -before / ({0} - before) else 0 end, t) {1} from (select *, lag({0}, 1, -invested) over (partition by id order by t) before from v) where {0} >= 0 group by id"


@query(f"""with recursive {H}, {PAYBACK}, a as ({CROSS.format('cash', 'by_cash')}), b as ({CROSS.format('equity', 'by_equity')}), c as ({CROSS.format('if_sold', 'by_sale')}), d as (select id, max_by(if_sold, t) profit, max(xs) extra, max(fees) fees, max(ints) interest from v group by id)
select id, round(by_cash, 4) by_cash, round(by_equity, 4) by_equity, round(by_sale, 4) by_sale, round(profit, 2) profit, round(extra, 2) extra, round(fees, 2) fees, round(interest, 2) interest from d left join a using (id) left join b using (id) left join c using (id)""")
def payback(spark, sf_dir):
    c = F.col
    rows = homes(spark, sf_dir).withColumns({
        "invested": c("price") * (1 - c("down")) + 15000, "received": F.lit(0.0), "loan": c("price") * c("down"), "imi": c("imi_rate") * c("price"), "cost_basis": c("price") * 1.05, "extra": 1e2 * (c("id") % 3),
        "lower_pay": c("id") % 2 == 0, "value": c("price"), "horizon": c("hold") + 10, "fee_rate": F.lit(0.005),
    })
    out = C.payback(rows).select("id", "payback.*")
    return out.select("id", *[r(k, 4).alias(k) for k in ("by_cash", "by_equity", "by_sale")], *[r(k, 2).alias(k) for k in ("profit", "extra", "fees", "interest")])


@query("""with v as (select p_partkey id, p_retailprice a, p_size::double b, case when p_partkey % 7 <> 0 then (p_partkey % 40)::double end c from part), k as (select id, unnest([struct_pack(k := 'a', v := a, w := 3, d := 1), struct_pack(k := 'b', v := b, w := 2, d := -1), struct_pack(k := 'c', v := c, w := 1, d := 1)]) x from v),
p as (select id, x.k k, x.w w, x.d d, (rank() over (partition by x.k order by x.v) - 1 + (count(*) over (partition by x.k, x.v) - 1) / 2e0) / (count(*) over (partition by x.k) - 1) p from k where x.v is not null), s as (select k.id, x.k k, x.w w, case when p.d < 0 then 1 - p else p end p from k left join p on p.id = k.id and p.k = x.k)
select id, round(sum(w * coalesce(p, 5e-1)) / sum(w), 6) score, count(*) filter (p is null) n_missing from s group by id""")
def rank_by(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    keyed = lambda k, v: F.struct(F.lit(k).alias("key"), v.cast("double").alias("value"))
    values = part.select(F.col("p_partkey").alias("id"), F.explode(F.array(keyed("a", F.col("p_retailprice")), keyed("b", F.col("p_size")), keyed("c", F.when(F.col("p_partkey") % 7 != 0, F.col("p_partkey") % 40)))).alias("x")).select("id", "x.*")
    criteria = spark.createDataFrame([("a", 3, 1), ("b", 2, -1), ("c", 1, 1), ("d", 0, 1)], "key string, weight int, direction int")
    return C.rank_by(values, criteria).select("id", r("score").alias("score"), F.size("missing").cast("bigint").alias("n_missing"))


def series(spark, sf_dir):
    """A place's quarters as a list."""
    rows = quarters(spark, sf_dir).select("place", "idx", F.struct(keys.index_label(F.col("idx"), "quarter").alias("period"), "value").alias("x"))
    return rows.groupBy("place").agg(F.transform(F.sort_array(F.collect_list(F.struct("idx", "x"))), lambda s: s["x"]).alias("series"))


@query(f"""with {Q}, l as (select place, max(idx) last, max_by(value, idx) tip from q group by 1), t as (select place, unnest([0, 4, 10, 24, 25, 26]) + 7980 idx from l) select t.place, (t.idx // 4) || 'Q' || (t.idx % 4 + 1) as quarter, round(case when a.value is not null and b.value is not null then (a.value + b.value) / 2 when t.idx >= l.last - 1
then l.tip * pow(coalesce(l.tip / y.value, 1), (t.idx + 15e-1 - l.last) / 4) else c.value end, 4) as value, round(case when t.idx < l.last then l.tip / c.value - 1 else 0 end, 6) growth
from t join l using (place) left join q a on a.place = t.place and a.idx = t.idx + 1 left join q b on b.place = t.place and b.idx = t.idx + 2 left join q c on c.place = t.place and c.idx = t.idx left join q y on y.place = t.place and y.idx = l.last - 4""")
def rolling_series(spark, sf_dir):
    rows = series(spark, sf_dir).withColumn("quarter", F.explode(F.array(*[keys.index_label(F.lit(7980 + k), "quarter") for k in (0, 4, 10, 24, 25, 26)])))
    value = C.rolling_value(F.col("series"), F.col("quarter"))["value"]
    return rows.select("place", "quarter", r(value, 4).alias("value"), r(C.series_growth(F.col("series"), F.col("quarter"))["growth"]).alias("growth"))


@query(f"""with {Q}, s as (select place, idx, value from q where idx between 1996 * 4 and 2000 * 4 + 3), p as (select *, max(value) over (partition by place order by idx) top from s), b as (select place, min(value / top - 1) "drop" from p group by 1)
select b.place, round("drop", 6) as "drop", (min(idx) // 4) || 'Q' || (min(idx) % 4 + 1) trough_period from b join p on p.place = b.place and p.value / p.top - 1 = b."drop" where "drop" < 0 group by 1, 2""")
def deepest_fall(spark, sf_dir):
    rows = series(spark, sf_dir).select("place", C.deepest_fall(F.col("series"), F.lit("1996"), F.lit("2000")).alias("x")).where("x is not null")
    return rows.select("place", r("x.drop").alias("drop"), "x.trough_period")


@query("with m as (select c_nationkey::bigint place, (year(o_orderdate) * 12 + month(o_orderdate) - 1)::bigint idx, avg(o_totalprice) as value from orders join customer on c_custkey = o_custkey group by 1, 2), j as (select a.place, a.idx, a.value - b.value rise from m a join m b on b.place = a.place and b.idx = a.idx - 12) select place, round(max(rise), 4) rise, (max_by(idx, rise) - 12)::bigint since, max_by(idx, rise)::bigint until from j group by 1")
def steepest_rise(spark, sf_dir):
    return C.steepest_rise(months(spark, sf_dir)).select("place", r("rise", 4).alias("rise"), "since", "until")


@query("""with b as (select c_nationkey::bigint place, c_custkey % 6 k, count(*)::double n from customer group by 1, 2), w as (select place, k, n / sum(n) over (partition by place) s from b), e(k, low, high) as (values (0, 0e0, 5e3), (1, 5e3, 1e4), (2, 1e4, 135e2), (3, 135e2, 19e3), (4, 19e3, 325e2))
select place, income, round(case when income > 325e2 then max(s) filter (w.k = 5) else coalesce(sum(s * case when income <= low then 1 when income >= high then 0 else (high - income) / (high - low) end), 0) + max(s) filter (w.k = 5) end, 6) share, income <= 325e2 exact
from w left join e on e.k = w.k, (values (4000e0), (12000e0), (19000e0), (40000e0)) t(income) group by 1, 2 having count(distinct w.k) = 6""")
def income_share_above(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").cast("long").alias("place"), (F.col("c_custkey") % 6).alias("k")).count()
    whole = rows.groupBy("place").agg(*[F.sum(F.when(F.col("k") == k, F.col("count"))).cast("double").alias(f"b{k}") for k in range(6)])
    every = sum((F.coalesce(f"b{k}", F.lit(0.0)) for k in range(6)), F.lit(0.0))
    shares = whole.select("place", *[(F.col(f"b{k}") / every).alias(f"b{k}") for k in range(6)], F.explode(F.array(*map(F.lit, (4000.0, 12000.0, 19000.0, 40000.0)))).alias("income"))
    got = shares.select("place", "income", C.share_above([F.col(f"b{k}") for k in range(6)], F.col("income")).alias("x")).where("x is not null")
    return got.select("place", "income", r("x.share").alias("share"), "x.exact")
