"""Household and investor calculators: columns of a parameter table in, columns out.

Loans have closed forms, so nothing here walks month by month but the plan with
extra payments.  Rates are in percent, growth and shares are fractions, money is
in one currency.  Null parameters give null results.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import finance
from ..functions.finance import TAX_YEAR, instalment

#: The supervisor's limits: effort, shock on the rate, financing share (own, other), longest terms.
EFFORT, SHOCK, SHARE, TERMS = 0.45, 1.5, {"own": 0.9, "second": 0.8}, {"young": 40, "other": 35}
#: Tax on rents: base, cuts from 5 and 10 years on, the moderate rate with its limit and last year.
RENT_TAX, CUT_5, CUT_10, MODERATE, MODERATE_RENT, MODERATE_UNTIL = 0.25, 0.10, 0.15, 0.10, 2300, 2029
#: Lower limits of the income brackets.
INCOME_EDGES = (0, 5000, 10000, 13500, 19000, 32500)
#: The state's guarantee for the young: highest price; land tax (urban, rustic), stamp duty; stamp on fees; tax on capital.
GUARANTEE_PRICE, LAND_TAX, LAND_STAMP, FEE_STAMP, CAPITAL_TAX = 450_000, (0.065, 0.05), 0.008, 0.04, 0.28
#: Lease terms that the tax tells apart.
LEASES = (1, 5, 10)


def over(cond: Column, then) -> Column:
    return F.when(cond, then).otherwise(F.lit(0.0))


def extended(rows: Column, **fields: Callable[[Column], Column]) -> Column:
    """An array of structs with more fields, each a function of the struct."""
    def more(x: Column) -> Column:
        out = x
        for name, make in fields.items():
            out = out.withField(name, make(x))
        return out

    return F.transform(rows, more)


def total(rows: Column, field: str) -> Column:
    return F.aggregate(rows, F.lit(0.0), lambda a, x: a + x[field])


def let(value: Column, make: Callable[[Column], Column]) -> Column:
    """make(value) with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), make), F.lit(0))


def bisected(low, high, right: Callable[[Column], Column], steps: int = 100) -> Column:
    """The border between low and high where right(x) turns from true to false."""
    begin = F.struct(F.lit(low).cast("double").alias("lo"), F.lit(high).cast("double").alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        ends = lambda m: lambda keep: F.struct(F.when(keep, m).otherwise(s["lo"]).alias("lo"), F.when(keep, s["hi"]).otherwise(m).alias("hi"))
        return let((s["lo"] + s["hi"]) / 2, lambda m: let(right(m), ends(m)))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), begin, halve)["lo"]


def irr(flows: Column) -> Column:
    """The yearly rate between -99 % and 100 % at which the flows are worth nothing; null where none is."""
    def worth(rate: Column) -> Column:
        return F.aggregate(F.reverse(flows), F.lit(0.0), lambda later, flow: later / (1 + rate) + flow)

    return let(worth(F.lit(-0.99)), lambda low: F.when(low * worth(F.lit(1.0)) <= 0, bisected(-0.99, 1.0, lambda x: worth(x) * F.signum(low) > 0)))


def rent_tax_rate(rent: Column, contract_years: Column, year: Column) -> Column:
    by_term = RENT_TAX - F.when(contract_years >= 10, CUT_10).when(contract_years >= 5, CUT_5).otherwise(0.0)
    return F.when((rent <= MODERATE_RENT) & (year <= MODERATE_UNTIL), MODERATE).otherwise(by_term)


def share_above(brackets: list[Column], income: Column) -> Column:
    """struct<share,exact>: households with at least the income, linear inside a bracket; above the last limit only its share is known."""
    parts = []
    for k, (low, high) in enumerate(zip(INCOME_EDGES, INCOME_EDGES[1:])):
        parts.append(brackets[k] * F.least(F.greatest((high - income) / (high - low), F.lit(0.0)), F.lit(1.0)))
    exact = income <= INCOME_EDGES[-1]
    known = F.greatest(*[b.isNull().cast("int") for b in brackets]) == 0
    return F.when(known, F.struct(F.when(exact, sum(parts, brackets[5])).otherwise(brackets[5]).alias("share"), exact.alias("exact")))


# series: arrays of struct<period, value> in order


def series_value(series: Column, period: Column) -> Column:
    return F.get(F.filter(series, lambda x: x["period"] == period), F.lit(0))["value"]


def rolling_value(series: Column, quarter: Column, trend: Column | None = None) -> Column:
    """struct<value,projected_from,growth>: the market of a quarter from medians of twelve months.

    The mean of the windows that end one and two quarters later; where these are
    not out, the last value carried on with the trend's yearly growth.
    """
    from ..functions.keys import add_quarters, label_index

    trend = series if trend is None else F.when(F.size(trend) > 0, trend).otherwise(series)
    a, b = (series_value(series, add_quarters(quarter, F.lit(k))) for k in (1, 2))
    last, tip = F.element_at(series, -1), F.element_at(trend, -1)
    before = series_value(trend, add_quarters(tip["period"], F.lit(-4)))
    growth = F.try_divide(tip["value"], before)
    step = label_index(quarter) + 1.5 - label_index(last["period"])
    here = series_value(series, quarter)
    made = lambda v, since=F.lit(None).cast("string"), g=F.lit(None).cast("double"): F.struct(v.alias("value"), since.alias("projected_from"), g.alias("growth"))
    ready = (a != 0) & (b != 0)
    gap = quarter < add_quarters(last["period"], F.lit(-1))
    carried = made(last["value"] * F.pow(F.coalesce(growth, F.lit(1.0)), step / 4), last["period"], growth - 1)
    found = F.when(ready, made((a + b) / 2)).when(gap, F.when(here != 0, made(here))).otherwise(carried)
    return F.when((F.size(series) > 0) & (quarter >= F.get(series, F.lit(0))["period"]), found)


def series_growth(series: Column, since: Column, rolling: bool = False) -> Column:
    """struct<growth,since,until,recent>: growth of the last value over that of a quarter."""
    last = F.element_at(series, -1)
    made = lambda g, recent: F.struct(g.alias("growth"), since.alias("since"), last["period"].alias("until"), F.lit(recent).alias("recent"))
    none = made(F.lit(0.0), True)
    if rolling:
        then = rolling_value(series, since)
        out = F.when(then.isNull() | then["projected_from"].isNotNull(), none).otherwise(made(F.try_divide(last["value"], then["value"]) - 1, False))
    else:
        then = series_value(series, since)
        out = F.when(since >= last["period"], none).when(then != 0, made(last["value"] / then - 1, False))
    return F.when((F.size(series) > 0) & (since >= F.get(series, F.lit(0))["period"]), out)


def deepest_fall(series: Column, first_year: Column, last_year: Column) -> Column:
    """struct<drop,peak_period,peak,trough_period,trough>: the largest fall from a running peak; null if nothing fell."""
    own = F.filter(series, lambda x: x["value"].isNotNull() & F.left(x["period"], F.lit(4)).between(first_year, last_year))
    blank = F.struct(F.lit(0.0).alias("drop"), *[F.lit(None).cast(t).alias(n) for n, t in (("peak_period", "string"), ("peak", "double"), ("trough_period", "string"), ("trough", "double"))])
    begin = F.struct(F.lit(None).cast("struct<period:string,value:double>").alias("top"), blank.alias("best"))

    def step(s: Column, x: Column) -> Column:
        x = F.struct(x["period"].alias("period"), x["value"].cast("double").alias("value"))
        top = F.when(s["top"].isNull() | (x["value"] > s["top"]["value"]), x).otherwise(s["top"])
        drop = F.try_divide(x["value"], top["value"]) - 1
        fell = F.struct(drop.alias("drop"), top["period"].alias("peak_period"), top["value"].alias("peak"), x["period"].alias("trough_period"), x["value"].alias("trough"))
        return F.struct(top.alias("top"), F.when(drop < s["best"]["drop"], fell).otherwise(s["best"]).alias("best"))

    best = F.aggregate(own, begin, step)["best"]
    return F.when(best["drop"] < 0, best)


def steepest_rise(df: DataFrame, place: str = "place", idx: str = "idx", value: str = "value") -> DataFrame:
    """place, rise, since, until: the largest rise of a monthly series over twelve months, the earliest of equal ones."""
    then = F.max(value).over(W.partitionBy(place).orderBy(idx).rangeBetween(-12, -12))
    rows = df.withColumn("rise", F.col(value) - then).where("rise is not null")
    top = rows.groupBy(place).agg(F.max_by(F.struct("rise", F.col(idx).alias("until")), F.struct("rise", (-F.col(idx)).alias("x"))).alias("b"))
    return top.select(place, "b.rise", (F.col("b.until") - 12).alias("since"), "b.until")


# loans


def owed(loan: Column, rate: Column, years: Column, months: Column) -> Column:
    """What is owed after so many months, nothing after the last one."""
    return over((loan > 0) & (months < years * 12), finance.balance(loan, rate, years, months))


def in_segments(loan: Column, years: Column, segments: Column) -> Column:
    """struct<first,highest,total,interest> of a loan whose rate changes.

    segments: array of struct<months,rate> in order; the payment is worked out
    anew from what is owed at each change.
    """
    def step(s: Column, x: Column) -> Column:
        def moved(left: Column, months: Column, pay: Column) -> Column:
            return F.struct(
                (s["month"] + months).alias("month"), over((months > 0) & (months < left), finance.balance(s["owed"], x["rate"], left / 12, months)).alias("owed"),
                F.when(s["month"] == 0, pay).otherwise(s["first"]).alias("first"), F.greatest(s["highest"], pay).alias("highest"), (s["total"] + pay * months).alias("total"),
            )

        months = lambda left: F.least(x["months"].cast("double"), left)
        pay = lambda left, m: over(m > 0, instalment(s["owed"], x["rate"], left / 12))
        return let(years * 12 - s["month"], lambda left: let(months(left), lambda m: let(pay(left, m), lambda p: moved(left, m, p))))

    begin = F.struct(F.lit(0.0).alias("month"), loan.cast("double").alias("owed"), *[F.lit(0.0).alias(n) for n in ("first", "highest", "total")])
    told = lambda end: F.struct(end["first"].alias("first"), end["highest"].alias("highest"), end["total"].alias("total"), (end["total"] - loan).alias("interest"))
    return let(F.aggregate(segments, begin, step), told)


def two_rates(loan: Column, years: Column, fixed_years: Column, rate: Column, after: Column) -> Column:
    months = F.least(fixed_years, years) * 12
    part = lambda m, r: F.struct(m.cast("double").alias("months"), r.cast("double").alias("rate"))
    return in_segments(loan, years, F.array(part(months, rate), part(years * 12 - months, after)))


def loan_plans(loans: DataFrame, deltas: tuple[float, ...] = (-1, 0, 1, 2)) -> DataFrame:
    """A row for each plan and shift of the market rate.

    loans: id, loan, years, f, i, o, p (rates of the variable, the two mixed and
    the fixed plan, null: not offered), fix_short, fix_long.  After its fixed time
    a plan follows today's variable rate plus the shift.  breakeven: the constant
    shift between -4 and 8 that makes the plan cost what the variable one costs.
    """
    plan = lambda key, fixed: F.struct(F.lit(key).alias("plan"), F.col(key).cast("double").alias("rate"), F.least(fixed, F.col("years")).cast("double").alias("fixed"))
    plans = F.array(plan("f", F.lit(1)), plan("i", F.col("fix_short")), plan("o", F.col("fix_long")), plan("p", F.col("years")))
    rows = loans.withColumn("x", F.explode(F.filter(plans, lambda x: x["rate"].isNotNull()))).select("id", "loan", "years", "f", "x.*")
    loan, years, now = F.col("loan"), F.col("years").cast("double"), F.col("f")

    def cost(d: Column, fixed: Column, rate: Column) -> Column:
        return two_rates(loan, years, fixed, rate, F.greatest(now + d, F.lit(0.0)))

    def dearer(d: Column) -> Column:
        return cost(d, F.col("fixed"), F.col("rate"))["total"] - cost(d, F.lit(1), now)["total"]

    border = lambda low: F.when(low * dearer(F.lit(8.0)) <= 0, bisected(-4.0, 8.0, lambda d: dearer(d) * F.signum(low) > 0, 60))
    even = F.when(F.col("plan") != "f", let(dearer(F.lit(-4.0)), border))
    rows = rows.withColumn("breakeven", even).withColumn("delta", F.explode(F.array(*[F.lit(float(d)) for d in deltas])))
    return rows.withColumn("cost", cost(F.col("delta"), F.col("fixed"), F.col("rate"))).select("id", "plan", "rate", F.col("fixed").alias("fixed_years"), "breakeven", "delta", "cost.*")


def repaid(balance: Column, rate: Column, pay: Column, most: Column) -> Column:
    """struct<months,interest> until a loan is paid off by a payment, after `most` months at the latest."""
    r = rate / 1200
    level = F.try_divide(pay, r)
    grown = F.log((level - 0.005) / (level - balance)) / F.log(1 + r)
    # a hair less, so that a term that ends at a month's end is not counted on
    needed = F.when(r == 0, F.ceil((balance - 0.005) / pay - 1e-9)).otherwise(F.ceil(grown - 1e-9))
    months = F.greatest(F.least(needed.cast("double"), most), F.lit(0.0))
    left = F.when(r == 0, balance - pay * (months - 1)).otherwise(level - (level - balance) * F.pow(1 + r, months - 1))
    interest = over(months > 0, pay * (months - 1) - (balance - left) + left * r)
    return F.struct(months.cast("int").alias("months"), interest.alias("interest"))


def amortisation(balance: Column, rate: Column, years: Column, amount: Column, shorter: bool, fee_rate: Column) -> Column:
    """struct: paying off part of a loan, for a shorter term or a lower payment, against its fee."""
    months, pay = years * 12, instalment(balance, rate, years)
    rest, fee = F.greatest(balance - amount, F.lit(0.0)), amount * fee_rate * (1 + FEE_STAMP)
    new = pay if shorter else instalment(rest, rate, years)
    before, after = repaid(balance, rate, pay, months), F.when(rest > 0.005, repaid(rest, rate, new, months)).otherwise(F.struct(F.lit(0).alias("months"), F.lit(0.0).alias("interest")))
    saved = before["interest"] - after["interest"]
    return F.struct(pay.alias("pay_before"), new.alias("pay_after"), before["months"].alias("months_before"), after["months"].alias("months_after"), fee.alias("fee"), saved.alias("saved"), (saved - fee).alias("net"), (rate / 100 / (1 - CAPITAL_TAX)).alias("gross_needed"))


def months_to(goal: Column, start: Column, monthly: Column, rate: Column) -> Column:
    """Months until savings with their yearly return reach the goal; null beyond 1,200."""
    r = rate / 12
    grown = F.log((goal * r + monthly) / (start * r + monthly)) / F.log(1 + r)
    needed = F.ceil(F.when(r == 0, F.try_divide(goal - start, monthly)).otherwise(grown) - 1e-9).cast("int")
    return F.when(start >= goal, 0).when(needed.between(1, 1200), needed)


# buying


def highest_price(savings: Column, income: Column, rate: Column, years: Column, use: str, young: bool = False, island=False, closing: Column | None = None, effort: float = 0.35, credit: bool = True) -> Column:
    """struct<price,loan,taxes,cash,pay,limit>: the dearest home that savings and income carry."""
    closing = F.lit(0.0) if closing is None else closing
    share = SHARE[use] if credit else 0.0
    earned = F.greatest(F.coalesce(income, F.lit(0.0)), F.lit(0.0)) if credit else F.lit(0.0)
    one = F.lit(1.0)
    most = over(earned > 0, F.least(effort * earned / instalment(one, rate, years), EFFORT * earned / instalment(one, rate + SHOCK, years)))
    saved = F.coalesce(savings, F.lit(0.0))

    def found(carried: Column) -> Column:
        def plan(price: Column) -> Column:
            def made(loan: Column) -> Column:
                taxes = finance.transfer_tax(price, use, young, island) + finance.purchase_stamp(price, use, young, island) + finance.STAMP_LOAN * loan
                return let(taxes, lambda t: F.struct(price.alias("price"), loan.alias("loan"), t.alias("taxes"), (price - loan + t + closing).alias("cash")))

            return let(F.least(share * price, carried), made)

        def told(got: Column) -> Column:
            by_income = (got["loan"] > 0) & (got["loan"] >= carried - 1) & (carried < share * got["price"])
            return F.struct(*[got[k].alias(k) for k in ("price", "loan", "taxes", "cash")], instalment(got["loan"], rate, years).alias("pay"), F.when(by_income, "income").otherwise("savings").alias("limit"))

        best = F.when(closing > saved, 0.0).otherwise(bisected(0.0, 2e7, lambda p: plan(p)["cash"] <= saved, 60))
        return let(let(best, plan), told)

    return let(most, found)


def first_home(price: Column, savings: Column, income: Column, rate: Column, closing: Column, young: bool, guaranteed: bool, island=False) -> Column:
    """struct of a first home with (young, guaranteed) or without aid: terms, down payment, taxes, payment, what is short."""
    aided = (price <= GUARANTEE_PRICE) if guaranteed else F.lit(False)
    years = F.lit(float(TERMS["young"] if young else 30))
    least = F.when(aided, 0.0).otherwise(1 - SHARE["own"])
    before = finance.purchase_taxes(price, price * (1 - least), "own", young, island)["total"]
    spare = F.greatest(F.coalesce(savings, F.lit(0.0)) - before - closing, F.lit(0.0))
    down = F.least(price, F.greatest(least * price, spare))
    loan = price - down
    taxes = finance.purchase_taxes(price, loan, "own", young, island)["total"]
    cash, stressed = down + taxes + closing, instalment(loan, rate + SHOCK, years)
    return F.struct(
        aided.alias("guarantee"), years.alias("years"), down.alias("down"), loan.alias("loan"), taxes.alias("taxes"), cash.alias("cash"), instalment(loan, rate, years).alias("pay"),
        F.greatest(cash - F.coalesce(savings, F.lit(0.0)), F.lit(0.0)).alias("short"), stressed.alias("pay_stressed"), F.when(income > 0, stressed <= EFFORT * income).alias("within_effort"),
    )


def before_signing(savings: Column, cash: Column, other: Column, expenses: Column, pay: Column, home_costs: Column, income: Column, loan: Column, rate: Column, years: Column, value: Column) -> Column:
    """struct: how much room is left after a purchase."""
    left, monthly = savings - cash, expenses + pay + home_costs
    stressed = over(loan > 0, instalment(loan, rate + 3, years))
    equity, liquid = value - loan, F.greatest(savings - cash, F.lit(0.0)) + other
    wealth, earned = F.when(equity + liquid > 0, equity + liquid), F.when(income > 0, income)
    return F.struct(left.alias("left"), monthly.alias("monthly"), F.when(monthly > 0, left / monthly).alias("months_covered"), (pay / earned).alias("effort"), (stressed / earned).alias("effort_stressed"), (equity / wealth).alias("concentration"), (value / wealth).alias("exposure"), (pay + home_costs).alias("own_cost"))


def wait_or_buy(price: Column, growth: Column, years: Column, savings: Column, budget: Column, rent: Column, rate: Column, loan_years: Column, down: Column, use: str, own_cost: Column, alt: Column, young: bool = False, island=False) -> Column:
    """struct: wealth after so many years of owning now against renting and buying then; 1,000 of closing costs either way."""
    months, a = years * 12, alt / 12

    def saved(begin: Column, monthly: Column) -> Column:
        up = F.pow(1 + a, months)
        return begin * up + monthly * F.when(a == 0, months).otherwise((up - 1) / a)

    def bought(p: Column) -> tuple[Column, Column, Column]:
        loan = p * (1 - down)
        taxes = finance.purchase_taxes(p, loan, use, young, island)["total"]
        return loan, taxes, p - loan + taxes + 1000

    loan, _, cash = bought(price)
    pay = instalment(loan, rate, loan_years)
    later = price * F.pow(1 + growth, years)
    loan_later, taxes_later, cash_later = bought(later)
    now = later - owed(loan, rate, loan_years, months) + saved(savings - cash, budget - pay - price * own_cost / 12)
    waited = saved(savings, budget - rent)
    wait = waited - taxes_later - 1000
    return F.struct(
        (savings >= cash).alias("can_now"), (waited >= cash_later).alias("can_later"), cash.alias("cash_now"), cash_later.alias("cash_later"), waited.alias("saved"), pay.alias("pay_now"),
        instalment(loan_later, rate, loan_years).alias("pay_later"), later.alias("price_later"), (rent * months).alias("rent_paid"), now.alias("wealth_now"), wait.alias("wealth_wait"), (now - wait).alias("difference"),
    )


def land_value(built: Column, usable: Column, sale: Column, cost: Column, soft: Column, sales: Column, margin: Column, rate: Column, years: Column, closing: Column, rustic: Column, asking: Column) -> Column:
    """struct: the most that a developer can pay for land, and what its asking price leaves."""
    tax, interest = F.when(rustic, LAND_TAX[1]).otherwise(LAND_TAX[0]) + LAND_STAMP, rate / 100 * years
    worth, build = built * usable * sale, built * cost
    works = build * (1 + soft)
    common = works + closing * (1 + interest) + 0.5 * interest * works
    carry = (1 + tax) * (1 + interest)
    most = F.greatest((worth * (1 - sales - margin) - common) / carry, F.lit(0.0))
    profit = worth * (1 - sales) - common - asking * carry
    return F.struct(
        worth.alias("worth"), build.alias("build"), most.alias("most"), F.try_divide(most, built).alias("most_per_m2"), F.try_divide(most, worth).alias("land_share"), profit.alias("profit"),
        F.try_divide(profit, worth).alias("margin_at_asking"), F.try_divide((common + asking * carry) / (1 - sales - margin), built * usable).alias("sale_needed"), (asking * tax).alias("land_taxes"),
    )


# letting


def let_years(df: DataFrame, horizon: Column) -> Column:
    """array of struct<t,year,rent,gross,maint,rate> for the years of a letting (columns rent, rent_growth, vacancy, maint, contract_years, start_year)."""
    rows = F.transform(F.sequence(F.lit(1), horizon.cast("int")), lambda t: F.struct(t.alias("t"), (F.col("start_year") + t - 1).alias("year"), (F.col("rent") * F.pow(1 + F.col("rent_growth"), t - 1)).alias("rent")))
    rows = extended(rows, gross=lambda x: x["rent"] * (12 - F.col("vacancy")), rate=lambda x: rent_tax_rate(x["rent"], F.col("contract_years"), x["year"]))
    return extended(rows, maint=lambda x: F.col("maint") * x["gross"])


def with_debt(rows: Column, loan: Column, rate: Column, years: Column) -> Column:
    """The rows with the loan's balance, debt service and interest of each year."""
    pay = over(loan > 0, instalment(loan, rate, years))
    paid = lambda t: F.least(t * 12, years * 12)
    rows = extended(rows, balance=lambda x: owed(loan, rate, years, x["t"] * 12), opening=lambda x: owed(loan, rate, years, (x["t"] - 1) * 12), debt=lambda x: pay * (paid(x["t"]) - paid(x["t"] - 1)))
    return extended(rows, interest=lambda x: x["debt"] - (x["opening"] - x["balance"]))


def invest(df: DataFrame) -> DataFrame:
    """Buying to let: yearly flows, sale and internal rate of return, as column `invest`.

    df: price, down, rate, years, rent, rent_growth, price_growth, vacancy, condo
    (a month), ins, maint, imi_rate, vpt (null: the price), contract_years, hold,
    sell_cost, marginal, closing, island, start_year.
    """
    c = F.col
    rows = df.withColumn("_loan", c("price") * (1 - c("down")))
    rows = rows.withColumn("_tax", finance.purchase_taxes(c("price"), c("_loan"), "second", False, c("island")))
    rows = rows.withColumns({"_cash": c("price") - c("_loan") + c("_tax.total") + c("closing"), "_imi": F.coalesce("vpt", "price") * c("imi_rate")})
    rows = rows.withColumn("_rows", with_debt(let_years(df, c("hold")), c("_loan"), c("rate"), c("years")))
    rows = rows.withColumn("_rows", extended(c("_rows"), irs=lambda x: F.greatest(x["gross"] - c("_imi") - c("condo") * 12 - x["maint"], F.lit(0.0)) * x["rate"]))
    rows = rows.withColumn("_rows", extended(c("_rows"), cf=lambda x: x["gross"] - c("_imi") - c("condo") * 12 - x["maint"] - c("ins") - x["irs"] - x["debt"]))
    rows = rows.withColumn("_sale", c("price") * F.pow(1 + c("price_growth"), c("hold")))
    rows = rows.withColumn("_gain", c("_sale") * (1 - c("sell_cost")) - (c("price") + c("_tax.transfer") + c("_tax.stamp") + c("closing")))
    rows = rows.withColumn("_cgt", F.greatest(c("_gain"), F.lit(0.0)) * 0.5 * c("marginal"))
    rows = rows.withColumn("_net", c("_sale") * (1 - c("sell_cost")) - F.element_at("_rows", -1)["balance"] - c("_cgt"))
    flows = F.concat(F.array(-c("_cash")), F.transform("_rows", lambda x: x["cf"] + over(x["t"] == c("hold"), c("_net"))))
    rows = rows.withColumn("_flows", flows)
    first = F.element_at("_rows", 1)
    noi = first["gross"] - c("_imi") - c("condo") * 12 - first["maint"] - c("ins")
    made = F.struct(
        c("_loan").alias("loan"), c("_tax.total").alias("taxes"), c("_cash").alias("cash"), over(c("_loan") > 0, instalment(c("_loan"), c("rate"), c("years"))).alias("pay"), c("_rows").alias("rows"), c("_sale").alias("sale"),
        c("_gain").alias("gain"), c("_cgt").alias("cgt"), c("_net").alias("net_sale"), c("_flows").alias("flows"), irr(c("_flows")).alias("irr"), (c("rent") * 12 / c("price")).alias("gross_yield"), noi.alias("noi"),
        ((noi - first["irs"]) / (c("price") + c("_tax.total") + c("closing"))).alias("net_yield"), (first["cf"] / c("_cash")).alias("cash_on_cash"), F.aggregate("_flows", F.lit(0.0), lambda a, x: a + x).alias("profit"),
    )
    return rows.withColumn("invest", made).select(*df.columns, "invest")


def investor_tests(alt: float | None = None) -> Column:
    """struct of the first year's tests, over the columns of invest()."""
    x, first = F.col("invest"), F.element_at(F.col("invest.rows"), 1)
    full = F.col("rent") * 12
    costs = first["gross"] - x["noi"] + (full - first["gross"])
    cap = x["noi"] / F.col("price")
    beats = F.lit(None).cast("boolean") if alt is None else x["irr"] > alt
    return F.struct(
        (first["cf"] / 12).alias("cash_month"), (first["cf"] > 0).alias("asset"), cap.alias("cap_rate"), F.when(x["cash"] > 0, first["cf"] / x["cash"]).alias("cash_on_cash"), F.when(first["debt"] > 0, x["noi"] / first["debt"]).alias("dscr"),
        (F.col("rent") / F.col("price")).alias("one_percent"), F.when(full > 0, costs / full).alias("cost_ratio"), F.when(x["loan"] > 0, cap > F.col("rate") / 100).alias("positive_leverage"), beats.alias("beats_alternative"),
    )


def crisis_test(df: DataFrame, rate_up: float, rent_drop: float, vacancy: float, drop: float, reserve: Column, hold: float = 24) -> DataFrame:
    """df with column `crisis`: the same investment with a higher rate, a lower rent and the home worth less after two years."""
    base = invest(df)
    hard = base.withColumn("_calm", F.col("invest.cash")).drop("invest").withColumns({"rate": F.col("rate") + rate_up, "rent": F.col("rent") * (1 - rent_drop), "vacancy": F.lit(min(12.0, vacancy))})
    rows = invest(hard)
    x = F.col("invest")
    month = F.element_at(x["rows"], 1)["cf"] / 12
    value, owed_then = F.col("price") * (1 - drop), F.coalesce(F.get(x["rows"], F.lit(1)), F.element_at(x["rows"], 1))["balance"]
    sold = value * (1 - F.col("sell_cost")) - owed_then
    months = F.when(month < 0, F.coalesce(reserve, F.lit(0.0)) / -month)
    made = F.struct(month.alias("cash_month"), x["pay"].alias("pay"), value.alias("value"), owed_then.alias("balance"), F.when(value > 0, owed_then / value).alias("ltv"), sold.alias("sold"), (sold - F.col("_calm")).alias("loss_if_sold"), months.alias("months_covered"), ((month >= 0) | (months >= hold)).alias("survives"))
    return rows.withColumn("crisis", made).select(*[c for c in df.columns], "crisis")


def landlord(df: DataFrame) -> DataFrame:
    """A row for each lease term of LEASES: net income and tax over `horizon` years.

    df: id, rent, rent_growth, vacancy, imi, condo, ins, maint, horizon, start_year, marginal.
    """
    rows = df.withColumn("contract_years", F.explode(F.array(*map(F.lit, LEASES))))
    years = let_years(rows, F.col("horizon"))
    base = lambda x: F.greatest(x["gross"] - F.col("imi") - F.col("condo") * 12 - x["maint"], F.lit(0.0))
    years = extended(years, tax=lambda x: base(x) * x["rate"], pooled=lambda x: base(x) * F.col("marginal"))
    years = extended(years, net=lambda x: x["gross"] - F.col("imi") - F.col("condo") * 12 - x["maint"] - F.col("ins") - x["tax"])
    rows = rows.withColumn("_years", years)
    return rows.select("id", "contract_years", total(F.col("_years"), "net").alias("net"), total(F.col("_years"), "tax").alias("tax"), F.element_at("_years", 1)["net"].alias("first_net"), total(F.col("_years"), "pooled").alias("pooled_tax"))


def hold_options(df: DataFrame) -> DataFrame:
    """id, now, sell, rent, keep: wealth after `horizon` years of selling now, letting or keeping, all money earning `alt`.

    df: id, value, sell_cost, balance, rate, years_left, buy_cost, exempt, marginal,
    rent, rent_growth, vacancy, imi, condo, ins, maint, contract_years,
    price_growth, alt, horizon, start_year.
    """
    c = F.col
    gain_tax = lambda sale: F.greatest(sale * (1 - c("sell_cost")) - c("buy_cost"), F.lit(0.0)) * 0.5 * c("marginal")
    years = with_debt(let_years(df, c("horizon")), c("balance"), c("rate"), c("years_left"))
    irs = lambda x: F.greatest(x["gross"] - c("imi") - c("condo") * 12 - x["maint"], F.lit(0.0)) * x["rate"]
    years = extended(years, let=lambda x: x["gross"] - x["maint"] - irs(x) - c("imi") - c("condo") * 12 - c("ins") - x["debt"], idle=lambda x: -c("imi") - c("condo") * 12 - c("ins") - x["debt"])
    rows = df.withColumn("_years", years).withColumn("_sale", c("value") * F.pow(1 + c("price_growth"), c("horizon")))
    end = c("_sale") * (1 - c("sell_cost")) - F.element_at("_years", -1)["balance"] - gain_tax(c("_sale"))
    kept = lambda field: F.aggregate("_years", F.lit(0.0), lambda a, x: a * (1 + c("alt")) + x[field]) + end
    now = c("value") * (1 - c("sell_cost")) - c("balance") - F.when(c("exempt"), 0.0).otherwise(gain_tax(c("value")))
    return rows.select("id", now.alias("now"), (now * F.pow(1 + c("alt"), c("horizon"))).alias("sell"), kept("let").alias("rent"), kept("idle").alias("keep"))


def payback(df: DataFrame) -> DataFrame:
    """df with column `payback`: years until a letting returns the money invested, with extra payments on the loan.

    df: invested, received, rent, rent_growth, vacancy, condo, ins, imi, maint,
    contract_years, start_year, loan, rate, years, value, sell_cost, cost_basis
    (null: no tax on gains), marginal, price_growth, alt, horizon, extra (a month),
    lower_pay (bool: extra payments lower the payment, else the term), fee_rate.
    """
    c, zero = F.col, F.lit(0.0)
    pay0 = over(c("loan") > 0, instalment(c("loan"), c("rate"), c("years")))
    extra, term, r = over(c("loan") > 0, F.coalesce(c("extra"), zero)), F.round(c("years") * 12), c("rate") / 1200
    names = ("owed", "pay", "interest", "principal", "extra", "fee")
    begin = F.struct(c("loan").cast("double").alias("owed"), pay0.alias("pay"), *[zero.alias(n) for n in names[2:]], F.lit(None).cast("double").alias("off"))

    def month(s: Column, m: Column) -> Column:
        due, late = s["owed"] > 0.005, m >= term  # late: what rounding left
        principal = lambda i: over(due, F.when(late, s["owed"]).otherwise(F.least(s["pay"] - i, s["owed"])))
        more = lambda p: over((extra > 0) & (s["owed"] - p > 0.005) & ~late, F.least(extra, s["owed"] - p))
        return let(over(due & ~late, s["owed"] * r), lambda i: let(principal(i), lambda p: let(more(p), lambda x: paid(s, m, i, p, x))))

    def paid(s: Column, m: Column, interest: Column, principal: Column, more: Column) -> Column:
        late, after = m >= term, s["owed"] - principal - more
        pay = F.when(c("lower_pay") & (more > 0) & (term - m - 1 > 0), instalment(after, c("rate"), (term - m - 1) / 12)).otherwise(s["pay"])
        done = (s["owed"] > 0.005) & (after <= 0.005)
        return F.struct(
            F.when(done, zero).otherwise(after).alias("owed"), pay.alias("pay"), (s["interest"] + interest).alias("interest"), (s["principal"] + principal).alias("principal"), (s["extra"] + more).alias("extra"),
            (s["fee"] + more * F.coalesce(c("fee_rate"), zero) * (1 + FEE_STAMP)).alias("fee"), F.when(done, F.coalesce(s["off"], F.when(late, m / 12).otherwise((m + 1) / 12))).otherwise(s["off"]).alias("off"),
        )

    # the state at the end of each year; a year's sums are differences of the running ones
    ends = F.aggregate(
        F.sequence(F.lit(1), c("horizon").cast("int")), F.array(begin),
        lambda states, t: F.concat(states, F.array(F.aggregate(F.sequence((t - 1) * 12, t * 12 - 1), F.element_at(states, -1), month))),
    )
    rows = df.withColumn("_ends", ends).withColumn("_years", let_years(df, c("horizon")))
    moved = lambda name: (lambda x: F.element_at("_ends", x["t"] + 1)[name] - F.element_at("_ends", x["t"])[name])
    years = extended(c("_years"), interest=moved("interest"), principal=moved("principal"), extra=moved("extra"), fee=moved("fee"), balance=lambda x: F.element_at("_ends", x["t"] + 1)["owed"])
    years = extended(years, costs=lambda x: c("imi") + c("condo") * 12 + c("ins") + x["maint"], irs=lambda x: F.greatest(x["gross"] - c("imi") - c("condo") * 12 - x["maint"], zero) * x["rate"])
    rows = rows.withColumn("_years", years)
    years = extended(c("_years"), cf=lambda x: x["gross"] - x["costs"] - x["irs"] - x["interest"] - x["principal"] - x["extra"] - x["fee"], worth=lambda x: c("value") * F.pow(1 + c("price_growth"), x["t"]))
    years = extended(years, cgt=lambda x: F.coalesce(F.greatest(x["worth"] * (1 - c("sell_cost")) - c("cost_basis"), zero) * 0.5 * F.coalesce(c("marginal"), zero), zero))
    years = extended(years, sold=lambda x: x["worth"] * (1 - c("sell_cost")) - x["balance"] - x["cgt"])
    rows = rows.withColumn("_years", years)
    opening = -c("invested") + F.coalesce(c("received"), zero)
    sums = lambda field: F.transform("_years", lambda x: F.aggregate(F.slice("_years", F.lit(1), x["t"]), opening, lambda a, y: a + field(y)))
    cash, equity = sums(lambda y: y["cf"]), sums(lambda y: y["cf"] + y["principal"] + y["extra"])
    rows = rows.withColumns({"_cash": cash, "_equity": equity}).withColumn("_if_sold", F.zip_with("_cash", "_years", lambda a, x: a + x["sold"]))

    def when(name: str) -> Column:
        line = F.concat(F.array(opening), c(name))
        t = F.get(F.filter(F.sequence(F.lit(1), c("horizon").cast("int")), lambda k: F.get(line, k) >= 0), F.lit(0))
        before, here = F.get(line, t - 1), F.get(line, t)
        return t - 1 + over((before < 0) & (here > before), -before / (here - before))

    last, first = F.element_at("_years", -1), F.element_at("_years", 1)
    flows = F.concat(F.array(opening), F.transform("_years", lambda x: x["cf"] + over(x["t"] == c("horizon"), x["sold"])))
    noi = first["gross"] - first["costs"] - first["irs"]
    other = F.aggregate("_years", c("invested").cast("double"), lambda a, x: a * (1 + c("alt")) + (x["extra"] + x["fee"]) * F.sqrt(1 + c("alt")))
    made = F.struct(
        pay0.alias("pay"), F.element_at("_ends", -1)["off"].alias("paid_off"), total(c("_years"), "extra").alias("extra"), total(c("_years"), "fee").alias("fees"), total(c("_years"), "interest").alias("interest"), when("_cash").alias("by_cash"),
        when("_equity").alias("by_equity"), when("_if_sold").alias("by_sale"), F.when(noi > 0, c("invested") / noi).alias("simple"), irr(flows).alias("irr"), F.element_at("_if_sold", -1).alias("profit"), other.alias("alternative"),
    )
    return rows.withColumn("payback", made).select(*df.columns, "payback")


# ranking


def rank_by(values: DataFrame, criteria: DataFrame) -> DataFrame:
    """id, score, parts, missing: candidates by weighted percentiles (0 worst, 1 best) in order of score.

    values: id, key, value (null or not finite: missing, counts a half); criteria:
    key, weight, direction (1: more is better, -1).  Keys of no weight do not count.
    """
    use = criteria.where("weight > 0")
    ids = values.select("id").distinct()
    held = values.where(F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") != float("inf")))
    w = W.partitionBy("key").orderBy("value")
    held = held.join(use, "key")
    ties, n = F.count("*").over(W.partitionBy("key", "value")), F.count("*").over(W.partitionBy("key"))
    p = F.when(n >= 2, (F.rank().over(w) - 1 + (ties - 1) / 2) / (n - 1))
    parts = held.select("id", "key", F.when(F.col("direction") < 0, 1 - p).otherwise(p).alias("part"))
    every = ids.crossJoin(use).join(parts, ["id", "key"], "left")
    out = every.groupBy("id").agg(
        (F.sum(F.col("weight") * F.coalesce("part", F.lit(0.5))) / F.sum("weight")).alias("score"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "part")))).alias("parts"),
        F.sort_array(F.collect_list(F.when(F.col("part").isNull(), F.col("key")))).alias("missing"),
    )
    return out
