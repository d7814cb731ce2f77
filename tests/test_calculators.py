"""Properties of the calculators that SQL does not state."""

from pyspark.sql import functions as F

from lotmetrics.functions import finance, keys
from lotmetrics.operators import calculators as C
from lotmetrics.operators import indices as I
from lotmetrics.operators import spatial, views


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_rate_of_return_makes_flows_worthless(spark):
    flows = [-1000.0, 60.0, 70.0, 1200.0]
    rate = one(spark, C.irr(F.array(*map(F.lit, flows))))
    assert abs(sum(f / (1 + rate) ** t for t, f in enumerate(flows))) < 1e-6
    assert one(spark, C.irr(F.array(F.lit(1.0), F.lit(2.0)))) is None


def test_breakeven_costs_the_same(spark):
    loans = spark.createDataFrame([(1, 150_000.0, 30.0, 2.5, 2.8, 3.0, 3.4, 2, 10)], "id int, loan double, years double, f double, i double, o double, p double, fix_short int, fix_long int")
    even = {r["plan"]: r["breakeven"] for r in C.loan_plans(loans, (0,)).collect()}
    assert even["f"] is None
    for plan, d in even.items():
        if d is not None:
            cost = {r["plan"]: r["total"] for r in C.loan_plans(loans, (d,)).collect()}
            assert abs(cost[plan] - cost["f"]) < 0.01


def test_a_loan_repays_itself(spark):
    loan, years = F.lit(90_000.0), F.lit(25.0)
    got = one(spark, C.in_segments(loan, years, F.array(F.struct(F.lit(60.0).alias("months"), F.lit(2.0).alias("rate")), F.struct(F.lit(240.0).alias("months"), F.lit(2.0).alias("rate")))))
    assert abs(got["first"] - got["highest"]) < 1e-9 and abs(got["total"] - 300 * got["first"]) < 1e-6 and abs(got["interest"] - got["total"] + 90_000) < 1e-6


def test_island_brackets_have_no_jumps():
    for use in ("own", "second"):
        rows = finance.island_brackets(finance.TRANSFER_TAX[use])
        for (limit, rate, off), (_, later, later_off) in zip(rows, rows[1:]):
            if later_off is not None:
                assert abs((rate * limit - off) - (later * limit - later_off)) < 0.01
    assert finance.young_limits(True) == (413174, 826228)


def test_coordinates(spark):
    for raw, want in (("38.5, -9.25", (38.5, -9.25)), ("-9,25 38,5", (38.5, -9.25)), ("51.5, 0.1", None), ("x", None)):
        got = one(spark, keys.coordinates(F.lit(raw)))
        assert got == want if got is None else (got["lat"], got["lon"]) == want


def test_empty_frames(spark):
    empty = spark.createDataFrame([], "place long, idx long, value double")
    for made in (I.chained(empty, empty), I.extended_by_rates(empty, empty), I.real_index(empty, empty), I.log_grid(empty), I.last_twelve(empty), I.to_annual(empty, "month")):
        assert made.count() == 0


def test_demo_panel(spark):
    from lotmetrics.operators import evaluation as E
    from lotmetrics.operators import features as S
    from lotmetrics.sources import demo

    squares, parishes = demo.places(spark), demo.places(spark, parts=2)
    assert squares.count() == 48 and parishes.count() == 192 and parishes.select("place").distinct().count() == 192
    assert spatial.touching(squares).where("place = '0101'").count() == 3
    sales = demo.series(spark, 2019 * 4 + 3, 2026 * 4 + 1)
    feats = S.municipal_features(sales).collect()
    assert len(feats) == 48 and {r["band"] for r in feats} == {"green", "amber", "red"} and sum(r["volatile"] for r in feats) == 5
    index = demo.boom_and_bust(spark, ["AA", "BB"])
    prices = index.select("place", "idx", F.lit(100.0).alias("value"))
    events = {r["place"]: r["n"] for r in E.outcomes(index, prices).where("event = 1").groupBy("place").agg(F.count("*").alias("n")).collect()}
    assert set(events) == {"AA"}
    history = E.national_history(index).join(E.outcomes(index, prices), ["place", "idx"])
    assert E.episode_hits(history, "score", 70).first()["signalled"]


def test_points_and_zones(spark):
    from lotmetrics.sources import demo

    squares = demo.places(spark).withColumnRenamed("place", "polygon")
    points = spark.createDataFrame([(1, "0105", None, None, None, None), (2, "9999", -9.25, 37.2, None, None), (3, None, 0.0, 0.0, "Vila-Nova", "São X"), (4, None, None, None, "?", "?")], "id int, code string, x double, y double, parish string, town string")
    codes, names = squares.select(F.col("polygon").alias("place")), spark.createDataFrame([("0110", "vila nova", "SAO X")], "place string, parish string, town string")
    got = {r["id"]: r["place"] for r in spatial.points_by_place(points, squares.select("polygon", "rings"), codes, names, 0.5).collect()}
    assert got == {1: "0105", 2: "0101", 3: "0110", 4: None}
    zone = spark.createDataFrame([(1, [[[-9.5, 37.0], [-9.25, 37.0], [-9.25, 37.4], [-9.5, 37.4]]]), (2, [[[-9.5, 37.0], [-9.25, 37.0], [-9.25, 37.4], [-9.5, 37.4]]])], "polygon int, rings array<array<array<double>>>")
    share = spatial.covered_share(demo.places(spark).select("place", "rings"), zone, 0.01).collect()
    assert [(r["place"], round(r["share"], 2)) for r in share] == [("0101", 0.5)]
    kinds = spark.createDataFrame([("a", "school"), ("a", "station"), (None, "school")], "place string, kind string")
    assert tuple(spatial.counts_by_kind(kinds).first()) == ("a", 1, 0, 1)


def test_letting_parameters(spark):
    rows = spark.createDataFrame([("0101", 2000.0, 9.0, None), ("3101", 1500.0, 8.0, 0.004), ("0102", None, 5.0, 0.003)], "place string, price double, rent double, imi_rate double")
    got = {r["place"]: r for r in views.letting_parameters(rows, F.lit(3.0), F.lit(0.02), 2026).collect()}
    assert set(got) == {"0101", "3101"} and (got["0101"]["price"], got["0101"]["rent"], got["0101"]["down"], got["0101"]["imi_rate"]) == (180_000.0, 810.0, 0.2, 0.003)
    assert got["3101"]["island"] and not got["0101"]["island"] and got["3101"]["imi_rate"] == 0.004
    told = views.letting_parameters(rows, F.lit(3.0), F.lit(0.02), 2026, {"area": F.lit(50.0), "price": F.when(F.col("place") == "0102", 100_000.0), "down": F.lit(100)})
    assert {r["place"]: (r["price"], r["down"]) for r in told.collect()} == {"0101": (100_000.0, 1.0), "3101": (75_000.0, 1.0), "0102": (100_000.0, 1.0)}
    net = {r["place"]: r["net_yield"] for r in views.net_yields(rows, F.lit(3.0), F.lit(0.02), 2026).collect()}
    assert set(net) == {"0101", "3101"} and all(0 < v < 0.06 for v in net.values())
    assert views.rent_update(F.lit(800.0), F.lit(1.0224)) is not None
    assert tuple(spark.range(1).select(views.rent_update(F.lit(800.0), F.lit(1.25)).alias("x")).first()["x"]) == (1000.0, 200.0)
