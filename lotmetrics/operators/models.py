"""Pooled models on sufficient statistics: one aggregation gathers the moments, small solves follow.

The moments of a model are some dozen numbers however many rows it is trained on, so
rows are shuffled only as partial sums and training windows are running sums.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .panel import asof, ordered
from .storage import stored

#: The error bounds.
LEVELS = {"q10": 0.10, "q25": 0.25, "q75": 0.75, "q90": 0.90}


def moments(df: DataFrame, by: list[str], xs: list[str], y: str, weight: Column | None = None) -> DataFrame:
    """Weighted sums, products and ranges by group; rows with a null in x, y or weight do not count."""
    df = df.withColumn("_w", F.lit(1.0) if weight is None else weight.cast("double")).na.drop(subset=[*xs, y, "_w"])
    every = [*xs, y]
    sums = {"m_n": "double(count(*))", "m_w": "sum(_w)"}
    sums |= {f"m_{i}": f"sum(_w * `{a}`)" for i, a in enumerate(every)}
    sums |= {f"m_{i}_{j}": f"sum(_w * `{a}` * `{every[j]}`)" for i, a in enumerate(every) for j in range(i + 1)}
    ends = {f"lo_{i}": f"min(`{a}`)" for i, a in enumerate(xs)} | {f"hi_{i}": f"max(`{a}`)" for i, a in enumerate(xs)}
    return df.groupBy(*by).agg(*[F.expr(f"{e} as {k}") for k, e in (sums | ends).items()])


def joined_moments(m: DataFrame, windows: list) -> DataFrame:
    """The moments of all rows in the windows (disjoint ones) instead of the own."""
    out = {}
    for c in m.columns:
        if c.startswith("m_"):
            out[c] = sum((F.coalesce(F.sum(c).over(w), F.lit(0.0)) for w in windows), F.lit(0.0))
        elif c.startswith(("lo_", "hi_")):
            of, pick = (F.min, F.least) if c.startswith("lo_") else (F.max, F.greatest)
            found = [of(c).over(w) for w in windows]
            out[c] = found[0] if len(found) == 1 else pick(*found)
    return m.select(*[out.get(c, F.col(c)).alias(c) for c in m.columns])


def ridge(m: DataFrame, p: int, lam: float = 0.05, least: int = 1) -> DataFrame:
    """Adds `fit`: intercept and slopes of standardised ridge regression and the ranges seen; null below `least` rows.

    The penalty is relative to the number of rows; a constant feature has slope 0.
    """
    names = ["m_n", "m_w", *[f"m_{i}" for i in range(p + 1)], *[f"m_{i}_{j}" for i in range(p + 1) for j in range(i + 1)]]

    def solve(rows: pd.Series) -> pd.Series:
        out = []
        for v in rows:
            if v is None or v[0] < least or not v[1] > 0:
                out.append(None)
                continue
            mean, second = np.array(v[2 : p + 3]) / v[1], np.zeros((p + 1, p + 1))
            second[np.tril_indices(p + 1)] = np.array(v[p + 3 :]) / v[1]
            cov = second + np.tril(second, -1).T - np.outer(mean, mean)
            sd = np.sqrt(np.clip(np.diag(cov)[:p], 0, None))
            sd[sd < 1e-12] = 1.0
            slope = np.linalg.solve(cov[:p, :p] / np.outer(sd, sd) + lam * np.eye(p), cov[:p, p] / sd) / sd
            out.append([float(mean[p] - slope @ mean[:p]), *map(float, slope)])
        return pd.Series(out)

    solved = F.pandas_udf(solve, "array<double>")(F.array(*[F.col(c) for c in names]))
    rows = m.withColumn("_coef", solved)
    fit = F.struct(F.col("_coef").alias("coef"), F.array(*[F.col(f"lo_{i}") for i in range(p)]).alias("lo"), F.array(*[F.col(f"hi_{i}") for i in range(p)]).alias("hi"))
    return rows.withColumn("fit", F.when(F.col("_coef").isNotNull(), fit)).drop("_coef")


def predicted(fit: Column, xs: list[str]) -> Column:
    """No extrapolation: each feature is held to the range of the training rows."""
    out = fit["coef"][0]
    for i, x in enumerate(xs):
        held = F.when(F.col(x).isNotNull(), F.least(F.greatest(F.col(x), fit["lo"][i]), fit["hi"][i]))
        out = out + fit["coef"][i + 1] * held
    return out


def backtest(df: DataFrame, xs: list[str], y: str, weight: Column | None = None, lam: float = 0.05, least: int = 300) -> DataFrame:
    """df: place, origin, h, features, y. Adds pred of the model trained on rows known at the origin (origin' + h <= origin)."""
    m = moments(df.withColumn("_known", F.col("origin") + F.col("h")), ["h", "_known"], xs, y, weight)
    run = joined_moments(m, [W.partitionBy("h").orderBy("_known").rowsBetween(W.unboundedPreceding, 0)])
    fits = ridge(run, len(xs), lam, least).select(F.col("h").alias("place"), F.col("_known").alias("idx"), "fit")
    asked = df.select(F.col("h").alias("place"), F.col("origin").alias("idx")).distinct()
    chosen = asof(asked, fits, "fit", "fit").select(F.col("place").alias("h"), F.col("idx").alias("origin"), "fit")
    return df.join(chosen, ["h", "origin"], "left").withColumn("pred", predicted(F.col("fit"), xs)).drop("fit")


def out_of_fold(df: DataFrame, xs: list[str], y: str, fold: str, lam: float = 0.01, weight: Column | None = None) -> DataFrame:
    """Adds pred of the model trained on all other folds."""
    w = W.partitionBy(F.lit(1)).orderBy(fold)  # a row a fold
    rest = joined_moments(moments(df, [fold], xs, y, weight), [w.rowsBetween(W.unboundedPreceding, -1), w.rowsBetween(1, W.unboundedFollowing)])
    fits = ridge(rest, len(xs), lam).select(fold, "fit")
    return df.join(fits, fold, "left").withColumn("pred", predicted(F.col("fit"), xs)).drop("fit")


def robust_sigma(df: DataFrame, window: int = 12, value: str = "value") -> DataFrame:
    """place, sigma: 1.4826 * MAD of the last `window` steps, at least the 10th percentile of the positive ones and 0.001; their median where none is known."""
    steps = df.withColumn("_d", F.col(value) - F.lag(value).over(ordered())).withColumn("_r", F.row_number().over(W.partitionBy("place").orderBy(F.desc("idx"))))
    steps = steps.withColumn("_d", F.when(F.col("_r") <= window, F.col("_d")))
    off = steps.withColumn("_m", F.expr("percentile(_d, 0.5)").over(W.partitionBy("place"))).groupBy("place").agg((F.expr("percentile(abs(_d - _m), 0.5)") * 1.4826).alias("_mad"))
    good = off.where("_mad > 0").agg(F.expr("percentile(_mad, 0.1)").alias("low"), F.expr("percentile(_mad, 0.5)").alias("mid")).select(F.struct("low", "mid").alias("x")).scalar()
    floor = F.greatest(F.coalesce(good["low"], F.lit(0.01)), F.lit(1e-3))
    return off.select("place", F.coalesce(F.greatest("_mad", F.when(F.col("_mad").isNotNull(), floor)), good["mid"], F.lit(0.02)).alias("sigma"))


def median_of(values: Column) -> Column:
    """The median of an array without nulls; null for an empty one."""
    def middle(x: Column) -> Column:
        n = F.size(x)
        return F.when(n > 0, (F.get(x, F.floor((n - 1) / 2).cast("int")) + F.get(x, F.floor(n / 2).cast("int"))) / 2)

    return F.transform(F.array(F.array_sort(values)), middle)[0]


def rolling_sigma(df: DataFrame, window: int = 12, value: str = "value") -> DataFrame:
    """place, idx, sigma: robust_sigma as known at every key, from the steps of the `window` keys up to it; floor and filling are of the rows of the key (null values included)."""
    step = F.col(value) - F.max(value).over(ordered().rangeBetween(-1, -1))
    steps = F.collect_list("_d").over(ordered().rangeBetween(1 - window, 0))
    rows = df.withColumn("_d", step).select("place", "idx", steps.alias("_s")).withColumn("_m", median_of(F.col("_s")))
    rows = rows.select("place", "idx", (1.4826 * median_of(F.transform("_s", lambda d: F.abs(d - F.col("_m"))))).alias("_mad"))
    good = rows.where("_mad > 0").groupBy("idx").agg(F.percentile("_mad", [0.1, 0.5]).alias("_p"))
    low, mid = F.coalesce(F.col("_p")[0], F.lit(0.01)), F.coalesce(F.col("_p")[1], F.lit(0.02))
    sigma = F.when(F.col("_mad").isNotNull(), F.greatest("_mad", low, F.lit(1e-3))).otherwise(mid)
    return rows.join(good, "idx", "left").select("place", "idx", sigma.alias("sigma"))


#: The normal distribution as a polynomial of t = 1 / (1 + TAIL * |z|) times its density (off by less than 1e-7).
TAIL, POLYNOMIAL = 0.2316419, (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)


def normal(z: np.ndarray) -> np.ndarray:
    """The share of a normal distribution below z."""
    t = 1 / (1 + TAIL * np.abs(z))
    upper = np.exp(-z * z / 2) / np.sqrt(2 * np.pi) * t * np.polyval(POLYNOMIAL[::-1], t)
    return np.where(z >= 0, 1 - upper, upper)


def mixture_quantiles(u: np.ndarray, n: np.ndarray, size: float, sigma: np.ndarray, levels: list[float], steps: int = 60) -> np.ndarray:
    """Quantiles (rows x levels) of a normal shock of `size` plus sigma times a value u that occurs n times, by bisection of the distribution."""
    out = np.empty((len(sigma), len(levels)))
    size = max(size, 1e-12)
    for a in range(0, len(sigma), 256):
        s = sigma[a : a + 256, None]
        for k, level in enumerate(levels):
            low, high = u.min() * s[:, 0] - 8 * size, u.max() * s[:, 0] + 8 * size
            for _ in range(steps):
                mid = (low + high) / 2
                below = (normal((mid[:, None] - u * s) / size) @ n) / n.sum() < level
                low, high = np.where(below, mid, low), np.where(below, high, mid)
            out[a : a + 256, k] = (low + high) / 2
    return out


def error_state(past: DataFrame, origins: int = 8, width: float = 0.02) -> tuple[DataFrame, DataFrame]:
    """h, size (of the shock that an origin's errors share) and h, u, n (the rest in units of sigma) of past (h, origin, y, pred, sigma).

    The shock is an origin's mean error by precision; its size is the root mean square
    over the last `origins` origins, for one more. The rest is kept as means of cells
    of asinh(u), `width` wide: their number does not grow with the rows.
    """
    seen = past.where("y is not null and pred is not null and sigma > 0").withColumn("_w", F.pow("sigma", F.lit(-2.0))).withColumn("_e", F.col("y") - F.col("pred"))
    shock = seen.groupBy("h", "origin").agg((F.sum(F.col("_e") * F.col("_w")) / F.sum("_w")).alias("_c"))
    shock = shock.withColumn("_k", F.row_number().over(W.partitionBy("h").orderBy(F.desc("origin")))).where(F.col("_k") <= origins).drop("_k")
    size = shock.groupBy("h").agg((F.sqrt(F.avg(F.col("_c") * F.col("_c"))) * F.sqrt((F.count("*") + 1) / F.count("*"))).alias("size"))
    u = (F.col("_e") - F.col("_c")) / F.col("sigma")
    cells = seen.join(shock, ["h", "origin"]).select("h", u.alias("u")).groupBy("h", F.floor(F.asinh("u") / width).alias("_b")).agg(F.avg("u").alias("u"), F.count("*").alias("n"))
    return size, cells.drop("_b")


def intervals(past: DataFrame, now: DataFrame, origins: int = 8, width: float = 0.02, shards: int = 16) -> DataFrame:
    """now (h, pred, sigma) with q10 to q90 of the error that past (h, origin, y, pred, sigma) shows.

    Quantiles are of a normal shock, common to all places of an origin, plus the past
    rest times sigma (error_state), from their joint distribution and without random
    numbers. Rows of a horizon are dealt to `shards` groups that each get its cells.
    Horizons without a past have null bounds.
    """
    size, cells = error_state(past, origins, width)
    dealt = now.withColumn("_shard", F.pmod(F.xxhash64(*now.columns), F.lit(shards)).cast("int"))
    state = cells.join(size, "h").select(F.col("h").alias("_h"), "u", "n", "size", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("_to"))

    def bounds(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        q = np.full((len(rows), len(LEVELS)), np.nan)
        sigma = rows["sigma"].to_numpy(float)
        good = np.flatnonzero(~np.isnan(sigma))
        if len(known) and len(good):
            known = known.sort_values("u")
            q[good] = mixture_quantiles(known["u"].to_numpy(float), known["n"].to_numpy(float), float(known["size"].iloc[0]), sigma[good], list(LEVELS.values()))
        return rows.drop(columns="_shard").assign(**{k: q[:, j] for j, k in enumerate(LEVELS)})

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in now.schema), *(f"{k} double" for k in LEVELS)])
    made = dealt.groupBy("h", "_shard").cogroup(state.groupBy("_h", "_to")).applyInPandas(bounds, schema)
    return made.select(*now.columns, *[F.when(~F.isnan(k), F.col(k)).alias(k) for k in LEVELS])


def segments(y: np.ndarray, least: int, most: int) -> list[tuple[int, int]]:
    """The piecewise linear split of y with the least BIC, n ln(SSE / n) + 3 k ln n. Holds n * n numbers: a calendar's length, some hundred keys."""
    n = len(y)
    t = np.arange(n, dtype=float)
    sums = [np.concatenate([[0.0], np.cumsum(v)]) for v in (np.ones(n), t, y, t * t, t * y, y * y)]
    with np.errstate(divide="ignore", invalid="ignore"):
        m, st, sy, stt, sty, syy = (s[None, :] - s[:, None] for s in sums)
        spread = stt - st * st / m
        sse = np.clip(syy - sy * sy / m - np.where(spread > 0, (sty - st * sy / m) ** 2 / spread, 0.0), 0, None)
    sse[m < least] = np.inf
    best, came, found = sse[0].copy(), [], (np.inf, [])
    for k in range(1, most + 1):
        if k > 1:
            total = best[:, None] + sse
            came.append(total.argmin(axis=0))
            best = total.min(axis=0)
        if not np.isfinite(best[n]):
            break
        bic = n * np.log(max(best[n], 1e-12) / n) + 3 * k * np.log(n)
        if bic < found[0]:
            cuts = [n]
            for back in reversed(came):
                cuts.append(int(back[cuts[-1]]))
            cuts.append(0)
            found = (bic, list(zip(cuts[:0:-1], cuts[-2::-1], strict=True)))
    return found[1]


def regimes(df: DataFrame, least: int = 6, most: int = 6, per_year: int = 4) -> DataFrame:
    """place, segment, first, last, n, growth (a year) of log-linear regimes; places with under 2 * least positive values are absent. A place's series is as long as its calendar."""
    def split(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        y, out = np.log(rows["value"].to_numpy(float)), []
        for k, (i, j) in enumerate(segments(y, least, most) if len(y) >= 2 * least else []):
            slope = np.polyfit(np.arange(i, j), y[i:j], 1)[0]
            out.append((rows["place"].iloc[0], k, rows["idx"].iloc[i], rows["idx"].iloc[j - 1], j - i, float(np.exp(per_year * slope) - 1)))
        return pd.DataFrame(out, columns=["place", "segment", "first", "last", "n", "growth"])

    kind = df.schema["place"].dataType.simpleString()
    return df.where("value > 0").select("place", "idx", "value").groupBy("place").applyInPandas(split, f"place {kind}, segment long, first long, last long, n long, growth double")


def signal_test(df: DataFrame, base: list[str], signal: str, y: str, lam: float = 0.05, least: int = 30) -> DataFrame:
    """h, n, mae_base, mae_signal, gain: the same backtest without and with a candidate signal, over rows that both predict."""
    keys = ["place", "origin", "h"]
    plain = backtest(df, base, y, None, lam, least).select(*keys, y, F.col("pred").alias("_b"))
    more = backtest(df, [*base, signal], y, None, lam, least).select(*keys, F.col("pred").alias("_s"))
    rows = plain.join(more, keys).where(F.col(y).isNotNull() & F.col("_b").isNotNull() & F.col("_s").isNotNull())
    out = rows.groupBy("h").agg(F.count("*").alias("n"), F.avg(F.abs(F.col("_b") - F.col(y))).alias("mae_base"), F.avg(F.abs(F.col("_s") - F.col(y))).alias("mae_signal"))
    return out.withColumn("gain", 1 - F.try_divide("mae_signal", "mae_base"))


def signal_tests(df: DataFrame, base: list[str], signals: list[str], y: str, weight: Column | None = None, lam: float = 0.05, least: int = 30) -> DataFrame:
    """signal, h, n, mae_base, mae_signal, gain: the backtest without and with each of the signals, over the rows that both predict.

    df: place, origin, h, features, y.  One aggregation gathers the moments of the base
    features and all signals; rows are told apart by the signals that they lack, so a
    signal's model learns from exactly the rows that have it.  Each model is solved
    from its part of the moments; a second reading of df compares the predictions.
    """
    known = [F.col(c).isNotNull() for c in signals]
    mask = sum((k.cast("int") * (1 << i) for i, k in enumerate(known)), F.lit(0))
    # the mask is taken before the nulls are filled
    rows = df.withColumn("_mask", mask).withColumns({**{c: F.coalesce(c, F.lit(0.0)) for c in signals}, "_known": F.col("origin") + F.col("h")})
    m = stored(moments(rows, ["h", "_known", "_mask"], [*base, *signals], y, weight))
    p, every = len(base), len(base) + len(signals)

    def part(number: int) -> Column:
        """The sums of the base features and one signal, under the names that a model of p + 1 features has."""
        took = [*range(p), p + number, every]
        pair = lambda i, j: F.col(f"m_{max(i, j)}_{min(i, j)}")
        fields = {"m_n": F.col("m_n"), "m_w": F.col("m_w")} | {f"m_{a}": F.col(f"m_{i}") for a, i in enumerate(took)} | {f"m_{a}_{b}": pair(i, took[b]) for a, i in enumerate(took) for b in range(a + 1)}
        fields |= {f"lo_{a}": F.col(f"lo_{i}") for a, i in enumerate(took[:-1])} | {f"hi_{a}": F.col(f"hi_{i}") for a, i in enumerate(took[:-1])}
        return F.struct(F.lit(number).alias("signal"), *[c.alias(k) for k, c in fields.items()])

    each = m.select("h", "_known", "_mask", F.explode(F.array(*map(part, range(len(signals))))).alias("s")).select("h", "_known", "_mask", "s.*")
    each = each.where(F.expr("(_mask >> signal) & 1 = 1"))
    merged = [c for c in each.columns if c not in ("h", "_known", "_mask", "signal")]
    how = lambda c: F.min(c) if c.startswith("lo_") else F.max(c) if c.startswith("hi_") else F.sum(c)
    each = each.groupBy("signal", "h", "_known").agg(*[how(c).alias(c) for c in merged])
    own = [c for c in m.columns if c not in ("h", "_known", "_mask")]
    plain = m.groupBy("h", "_known").agg(*[how(c).alias(c) for c in own])
    short = {"m_n": "m_n", "m_w": "m_w"} | {f"m_{a}": f"m_{i}" for a, i in enumerate([*range(p), every])} | {f"m_{a}_{b}": f"m_{max(i, j)}_{min(i, j)}" for a, i in enumerate([*range(p), every]) for b, j in enumerate([*range(p), every][: a + 1])}
    plain = plain.select("h", "_known", *[F.col(v).alias(k) for k, v in short.items()], *[F.col(f"{e}_{i}") for i in range(p) for e in ("lo", "hi")])

    def fits(sums: DataFrame, by: list[str], n: int) -> DataFrame:
        run = joined_moments(sums, [W.partitionBy(*by).orderBy("_known").rowsBetween(W.unboundedPreceding, 0)])
        return ridge(run, n, lam, least).select(F.concat_ws(":", *[F.col(c).cast("string") for c in by]).alias("place"), F.col("_known").alias("idx"), "fit")

    asked = df.select("h", "origin").distinct()
    key = lambda *c: F.concat_ws(":", *[F.col(x).cast("string") for x in c])
    of_base = asof(asked.select("h", "origin", key("h").alias("place"), F.col("origin").alias("idx")), fits(plain, ["h"], p), "fit", "_base").select("h", "origin", "_base")
    wanted = asked.withColumn("signal", F.explode(F.array(*map(F.lit, range(len(signals)))))).select("signal", "h", "origin", key("signal", "h").alias("place"), F.col("origin").alias("idx"))
    of_signal = asof(wanted, fits(each, ["signal", "h"], p + 1), "fit", "_fit").select("signal", "h", "origin", "_fit")
    # a row an origin and horizon: few, whatever the panel
    models = stored(of_signal.groupBy("h", "origin").agg(F.map_from_entries(F.collect_list(F.struct("signal", "_fit"))).alias("_fits")).join(of_base, ["h", "origin"]))
    both = df.join(models, ["h", "origin"]).withColumn("_b", predicted(F.col("_base"), base)).where(F.col(y).isNotNull() & F.col("_b").isNotNull())
    tried = [F.struct(F.lit(name).alias("signal"), predicted(F.col("_fits")[F.lit(k)], [*base, name]).alias("_s")) for k, name in enumerate(signals)]
    rows = both.select("h", "_b", F.col(y).alias("_y"), F.inline(F.array(*tried))).where("_s is not null")
    out = rows.groupBy("signal", "h").agg(F.count("*").alias("n"), F.avg(F.abs(F.col("_b") - F.col("_y"))).alias("mae_base"), F.avg(F.abs(F.col("_s") - F.col("_y"))).alias("mae_signal"))
    return out.withColumn("gain", 1 - F.try_divide("mae_signal", "mae_base"))


def passing(tests: DataFrame, least: float = 0.01, most_loss: float = 0.01) -> DataFrame:
    """signal, gain_far, gain_near, passes: whether a signal gains enough at the farthest horizon and loses little at the nearest. A row a signal."""
    by = tests.groupBy("signal").agg(F.max_by("gain", "h").alias("gain_far"), F.min_by("gain", "h").alias("gain_near"))
    return by.withColumn("passes", (F.col("gain_far") >= least) & (F.col("gain_near") >= -most_loss))


def with_groups(df: DataFrame, xs: list[str], group: str, y: str, fold: str, lam: float = 0.01) -> DataFrame:
    """Adds pred: out-of-fold ridge regression on features and an indicator of each group but the largest (ties: the first).

    No indicator is made: moments by fold and group hold all products with them (an
    indicator's sum is the group's count, its product with a feature the feature's sum
    there), so the scan costs the same whatever the number of groups. A fold's model is
    solved from a row a group; groups that its rows lack count as the largest.
    """
    held = df.na.drop(subset=[*xs, y])
    m = stored(moments(held, [fold, group], xs, y))
    folds = m.select(F.collect_set(fold).alias("_folds"))
    others = m.join(folds, F.lit(True)).withColumn("_of", F.explode(F.filter("_folds", lambda f: f != F.col(fold)))).drop("_folds")
    biggest = m.groupBy(group).agg(F.sum("m_n").alias("n")).agg(F.min_by(group, F.struct((-F.col("n")).alias("n"), F.col(group)))).scalar()
    p = len(xs)

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        ends = [f"{e}_{i}" for i in range(p) for e in ("lo", "hi")]
        sums = [c for c in rows.columns if c.startswith("m_")]
        base = rows["_base"].iloc[0]
        low, high = rows[[c for c in ends if c[0] == "l"]].min(), rows[[c for c in ends if c[0] == "h"]].max()
        per = rows.groupby(group)[sums].sum()
        total = per.sum()
        named = [g for g in per.index if g != base]
        n, k = total["m_n"], p + len(named)
        mean, second = np.zeros(k + 1), np.zeros((k + 1, k + 1))
        at = [*range(p), k]
        for a, i in enumerate(at):
            mean[i] = total[f"m_{a}"] / n
            for b, j in enumerate(at[: a + 1]):
                second[i, j] = second[j, i] = total[f"m_{a}_{b}"] / n
        for d, g in enumerate(named):
            mean[p + d] = second[p + d, p + d] = per.at[g, "m_n"] / n
            for a, i in enumerate(at):
                second[i, p + d] = second[p + d, i] = per.at[g, f"m_{a}"] / n
        cov = second - np.outer(mean, mean)
        sd = np.sqrt(np.clip(np.diag(cov)[:k], 0, None))
        sd[sd < 1e-12] = 1.0
        slope = np.linalg.solve(cov[:k, :k] / np.outer(sd, sd) + lam * np.eye(k), cov[:k, k] / sd) / sd
        coef = [float(mean[k] - slope @ mean[:k]), *map(float, slope[:p])]
        offsets = dict(zip(named, map(float, slope[p:]), strict=True))
        return pd.DataFrame([{fold: rows["_of"].iloc[0], "coef": coef, "lo": low.to_list(), "hi": high.to_list(), "offsets": list(offsets.items())}])

    kinds = {c: df.schema[c].dataType.simpleString() for c in (fold, group)}
    made = others.withColumn("_base", biggest).groupBy("_of").applyInPandas(solve, f"`{fold}` {kinds[fold]}, coef array<double>, lo array<double>, hi array<double>, offsets array<struct<g:{kinds[group]},v:double>>")
    fits = made.select(fold, F.struct("coef", "lo", "hi").alias("_fit"), F.map_from_entries("offsets").alias("_offsets"))
    rows = df.join(fits, fold, "left")
    return rows.withColumn("pred", predicted(F.col("_fit"), xs) + F.when(F.col("_fit").isNotNull(), F.coalesce(F.try_element_at("_offsets", F.col(group)), F.lit(0.0)))).drop("_fit", "_offsets")


def population(df: DataFrame, least: int = 30) -> DataFrame:
    """df (place, published, density, area_km2) with `population`: the published number where it is positive, else density times area; only the latter below `least` published ones."""
    estimate = F.col("density") * F.col("area_km2")
    enough = df.agg(F.count("published") >= least).scalar()
    return df.withColumn("population", F.when(enough & (F.col("published") > 0), F.col("published").cast("double")).otherwise(estimate))


def shrunk_sigma(df: DataFrame, weight: float = 3.0, value: str = "value") -> DataFrame:
    """place, sigma: the spread of a place's steps, drawn towards the median place's by the number of its steps against `weight`."""
    steps = df.withColumn("_d", F.col(value) - F.lag(value).over(ordered()))
    own = steps.groupBy("place").agg(F.stddev_samp("_d").alias("_s"), F.count("_d").alias("_n"))
    middle = own.agg(F.percentile("_s", 0.5).alias("m")).scalar()
    pooled = F.sqrt((F.col("_n") * F.pow(F.coalesce("_s", F.lit(0.0)), 2) + weight * F.pow(middle, 2)) / (F.col("_n") + weight))
    return own.select("place", F.when(F.col("_s").isNull(), middle).otherwise(pooled).alias("sigma"))


def cross_validated(df: DataFrame, xs: list[str], y: str, key: str, folds: int = 10, repeats: int = 5, lam: float = 0.01) -> DataFrame:
    """repeat, r2: out-of-fold share of variance explained, the folds dealt anew by the key's remainder after each shift."""
    rows = df.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    rows = rows.withColumn("fold", F.pmod(F.floor(F.col(key) / (F.col("repeat") + 1)), F.lit(folds)).cast("int"))
    m = moments(rows, ["repeat", "fold"], xs, y)
    w = W.partitionBy("repeat").orderBy("fold")  # a row a fold
    rest = joined_moments(m, [w.rowsBetween(W.unboundedPreceding, -1), w.rowsBetween(1, W.unboundedFollowing)])
    fits = ridge(rest, len(xs), lam).select("repeat", "fold", "fit")
    held = rows.join(fits, ["repeat", "fold"]).withColumn("pred", predicted(F.col("fit"), xs)).where(F.col("pred").isNotNull())
    return held.groupBy("repeat").agg((1 - F.sum(F.pow(F.col(y) - F.col("pred"), 2)) / (F.var_pop(y) * F.count("*"))).alias("r2"))
