"""Groups of places by k-means with many starts, chosen by their silhouette over plain distances.

All starts of all numbers of groups step together: a step is one job over the rows,
in which a task adds up, for every start and group, the rows nearest to its centre.
Only these sums, whose number the parameters fix, reach the driver.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .storage import stored

SHARE = (0.025, 0.975)


def standardised(features: DataFrame, columns: list[str], place: str = "place") -> DataFrame:
    """place, z: the columns held to their 2.5 and 97.5 percentiles, then standardised; rows with a null are left out. A constant column is 0."""
    rows = features.select(place, *[F.col(c).cast("double").alias(c) for c in columns]).na.drop(subset=columns)
    ends = rows.agg(*[F.percentile(c, list(SHARE)).alias(f"_{c}") for c in columns])
    held = rows.join(ends, F.lit(True)).select(place, *[F.least(F.greatest(F.col(c), F.col(f"_{c}")[0]), F.col(f"_{c}")[1]).alias(c) for c in columns])
    size = held.agg(*[F.avg(c).alias(f"_m{c}") for c in columns], *[F.stddev_pop(c).alias(f"_s{c}") for c in columns])
    z = [(F.col(c) - F.col(f"_m{c}")) / F.when(F.col(f"_s{c}") > 0, F.col(f"_s{c}")).otherwise(1.0) for c in columns]
    return held.join(size, F.lit(True)).select(place, F.array(*z).alias("z"))


def points(batch: pd.DataFrame) -> np.ndarray:
    return np.array(batch["z"].to_list(), dtype=float).reshape(len(batch), -1)


def gaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, rows by centres."""
    out = np.zeros((len(x), len(centres)))
    for a in range(x.shape[1]):
        d = x[:, a, None] - centres[None, :, a]
        d *= d
        out += d
    return out


def first_centres(rows: DataFrame, place: str, starts: dict[int, int], seed: int) -> dict[int, np.ndarray]:
    """Centres of each start ({start: groups}) by the k-means++ rule: every next one is drawn by its squared distance to those before.

    A draw with weights is the least of -log(u) / weight, so it is a minimum over the
    rows; u comes from a digest of place, start and turn.
    """
    found: dict[int, np.ndarray] = {}
    for turn in range(max(starts.values(), default=0)):
        open_, known = [s for s, k in starts.items() if turn < k], dict(found)

        def draws(batches):
            for b in batches:
                x, texts = points(b), b["_text"].to_numpy()
                out = []
                for s in open_:
                    u = pd.util.hash_array(np.array([f"{t}:{s}:{turn}:{seed}" for t in texts], dtype=object)).astype(float) / 2.0**64
                    weight = gaps(x, known[s]).min(axis=1) if s in known else np.ones(len(x))
                    with np.errstate(divide="ignore"):
                        # rows on a centre are drawn only if there are no others
                        score = np.where(weight > 0, -np.log(np.clip(u, 1e-300, 1)) / np.where(weight > 0, weight, 1), 1e300 * (1 + u))
                    i = int(score.argmin())
                    out.append((s, float(score[i]), str(texts[i]), x[i].tolist()))
                yield pd.DataFrame(out, columns=["start", "score", "_text", "z"])

        best = rows.withColumn("_text", F.col(place).cast("string")).mapInPandas(draws, "start long, score double, _text string, z array<double>")
        for r in best.groupBy("start").agg(F.min_by("z", F.struct("score", "_text")).alias("z")).collect():
            new = np.array(r["z"], dtype=float)[None]
            found[r["start"]] = np.vstack([found[r["start"]], new]) if r["start"] in found else new
    return found


def settled(rows: DataFrame, centres: dict[int, np.ndarray], steps: int) -> tuple[dict[int, np.ndarray], dict[int, float]]:
    """The centres after at most `steps` steps, and each start's sum of squared distances to them. A group without rows keeps its centre."""
    moving, centres, inertia = set(centres), dict(centres), {}
    for _ in range(steps):
        at = {s: centres[s] for s in moving}

        def sums(batches):
            for b in batches:
                x = points(b)
                out = []
                for s, c in at.items():
                    d = gaps(x, c)
                    own = d.argmin(axis=1)
                    n, off = np.bincount(own, minlength=len(c)), np.bincount(own, d[np.arange(len(x)), own], len(c))
                    total = np.stack([np.bincount(own, x[:, i], len(c)) for i in range(x.shape[1])], axis=1)
                    out += [(s, int(k), int(n[k]), total[k].tolist(), float(off[k])) for k in np.flatnonzero(n)]
                yield pd.DataFrame(out, columns=["start", "k", "n", "total", "off"])

        made = rows.mapInPandas(sums, "start long, k long, n long, total array<double>, off double")
        width = len(next(iter(at.values()))[0])
        got = made.groupBy("start", "k").agg(F.sum("n").alias("n"), F.sum("off").alias("off"), *[F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(width)]).collect()
        new = {s: c.copy() for s, c in at.items()}
        inertia |= dict.fromkeys(at, 0.0)
        for r in got:
            new[r["start"]][r["k"]] = [r[f"t{i}"] / r["n"] for i in range(width)]
            inertia[r["start"]] += r["off"]
        moving = {s for s in moving if not np.allclose(new[s], centres[s])}
        centres |= {s: new[s] for s in moving}
        if not moving:
            break
    return centres, inertia


def labelled(rows: DataFrame, best: dict[int, np.ndarray]) -> DataFrame:
    """rows with `groups`: the number of the nearest centre for each number of groups, in ascending order of k."""
    def label(column: pd.Series) -> pd.Series:
        x = np.array(column.to_list(), dtype=float).reshape(len(column), -1)
        return pd.Series(np.stack([gaps(x, best[k]).argmin(axis=1) for k in sorted(best)], axis=1).tolist())

    return rows.withColumn("groups", F.pandas_udf(label, "array<long>")(F.col("z")))


def distance_sums(x: np.ndarray, y: np.ndarray, of_x: np.ndarray, of_y: np.ndarray, groups: int, tile: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Each row's sum of distances to every group of the other side, for both sides; of_x and of_y number the groups, in ascending order."""
    to_y, to_x = np.zeros((len(x), groups)), np.zeros((len(y), groups))
    first = lambda of: np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    for i in range(0, len(x), 4 * tile):
        rows = slice(i, i + 4 * tile)
        here = first(of_x[rows])
        for j in range(0, len(y), tile):
            columns = slice(j, j + tile)
            there = first(of_y[columns])
            d = np.sqrt(gaps(x[rows], y[columns]))
            to_y[rows, of_y[columns][there]] += np.add.reduceat(d, there, axis=1)
            to_x[columns, of_x[rows][here]] += np.add.reduceat(d, here, axis=0).T
    return to_y, to_x


def silhouettes(rows: DataFrame, place: str, ks: list[int], rows_a_block: int = 2000) -> dict[int, float]:
    """The mean silhouette of each k over plain distances; rows: place, z, groups.

    Every row meets every other, as the measure asks, but in parts of about ten blocks
    at most: a task holds two parts, works out a tile of their distances at a time and
    gives each row one array of sums by group. A pair of parts meets once.
    """
    n = rows.count()
    parts = max(1, -(-n // (10 * rows_a_block)), min(-(-n // rows_a_block), 12))
    tasks = parts * (parts + 1) // 2
    dealt = rows.withColumn("_b", F.pmod(F.xxhash64(place), F.lit(parts)).cast("int"))
    left = dealt.select(place, "z", "groups", F.col("_b").alias("_i"), F.explode(F.sequence("_b", F.lit(parts - 1))).alias("_j"))
    right = dealt.select(F.col(place).alias("_place"), F.col("z").alias("z"), F.col("groups").alias("groups"), F.explode(F.sequence(F.lit(0), "_b")).alias("_p"), F.col("_b").alias("_q"))
    kind = rows.schema[place].dataType.simpleString()
    offsets = dict(zip(ks, np.cumsum([0, *ks[:-1]]).tolist(), strict=True))

    def sums(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame(columns=[place, "groups", "total"])
        # rows that are together for every k are one kind
        labels = [np.array(side["groups"].to_list(), dtype=np.int64).reshape(len(side), -1) for side in (a, b)]
        kinds, of = np.unique(np.concatenate(labels), axis=0, return_inverse=True)
        of = of.reshape(-1)
        orders = [np.argsort(o, kind="stable") for o in (of[: len(a)], of[len(a) :])]
        a, b = a.iloc[orders[0]], b.iloc[orders[1]]
        found = distance_sums(points(a), points(b), of[: len(a)][orders[0]], of[len(a) :][orders[1]], len(kinds))
        wide = np.zeros((len(kinds), sum(ks)))
        for c, k in enumerate(ks):
            wide[np.arange(len(kinds)), offsets[k] + kinds[:, c]] = 1
        out = [pd.DataFrame({place: a[place].to_numpy(), "groups": a["groups"].to_numpy(), "total": (found[0] @ wide).tolist()})]
        if key[0] != key[1]:
            out.append(pd.DataFrame({place: b["_place"].to_numpy(), "groups": b["groups"].to_numpy(), "total": (found[1] @ wide).tolist()}))
        return pd.concat(out)

    met = left.repartition(tasks, "_i", "_j").groupBy("_i", "_j").cogroup(right.repartition(tasks, "_p", "_q").groupBy("_p", "_q"))
    made = met.applyInPandas(sums, f"`{place}` {kind}, groups array<long>, total array<double>")
    per = made.groupBy(place, "groups").agg(*[F.sum(F.col("total")[i]).alias(f"_t{i}") for i in range(sum(ks))])
    sizes = [{r["g"]: r["n"] for r in rows.groupBy(F.col("groups")[i].alias("g")).agg(F.count("*").alias("n")).collect()} for i in range(len(ks))]
    means = []
    none = F.lit(None).cast("double")
    for i, k in enumerate(ks):
        own, held = F.col("groups")[i], sorted(sizes[i].items())
        a, size = none, F.lit(0)
        for g, m in held:
            size = F.when(own == g, m).otherwise(size)
            a = F.when(own == g, F.col(f"_t{offsets[k] + g}") / (m - 1) if m > 1 else none).otherwise(a)
        b = F.least(none, none, *[F.when(own != g, F.col(f"_t{offsets[k] + g}") / m) for g, m in held])
        s = F.when((size <= 1) | b.isNull() | (F.greatest(a, b) <= 0), 0.0).otherwise((b - a) / F.greatest(a, b))
        means.append(F.avg(s).alias(str(k)))
    got = per.agg(*means).first()
    return {k: got[str(k)] for k in ks}


def typologies(features: DataFrame, columns: list[str], ks: tuple[int, ...] = (3, 4, 5, 6), starts: int = 20, steps: int = 200, seed: int = 0, place: str = "place") -> tuple[DataFrame, dict[int, float]]:
    """features with `typology` (1: the highest median of the first column) and the silhouette of each k; the k of the best one is taken.

    Columns are held to their percentiles and standardised; of the starts of a k, the one
    with the least sum of squares counts.  A k needs more than 3 k rows; without any,
    typology is null and there are no silhouettes.  Rows with nulls have null. Places
    are unique.
    """
    # as many files as tasks that have enough to do: every step reads them
    n = features.count()
    tasks = max(1, min(-(-n // 1000), max(features.sparkSession.sparkContext.defaultParallelism, -(-n // 50000))))
    z = stored(standardised(features, columns, place).repartition(tasks))
    n = z.count()
    numbered = {i: k for i, k in enumerate(k for k in ks if n > 3 * k for _ in range(starts))}
    if not numbered:
        return features.withColumn("typology", F.lit(None).cast("int")), {}
    centres, inertia = settled(z, first_centres(z, place, numbered, seed), steps)
    best = {k: centres[min((inertia[s], s) for s, j in numbered.items() if j == k)[1]] for k in set(numbered.values())}
    rows = stored(labelled(z, best))
    found = silhouettes(rows, place, sorted(best))
    chosen = max(sorted(found), key=lambda k: found[k])
    own = rows.select(place, F.col("groups")[sorted(best).index(chosen)].alias("_g"))
    held = features.join(own, place, "left")
    order = held.where("_g is not null").groupBy("_g").agg(F.percentile(columns[0], 0.5).alias("_m"))
    order = order.select("_g", F.row_number().over(W.orderBy(F.desc("_m"), "_g")).alias("typology"))  # a row a group
    return held.join(order, "_g", "left").select(*features.columns, "typology"), found
