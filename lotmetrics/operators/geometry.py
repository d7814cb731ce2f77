"""Exact plane geometry over tables of polygons: clipping to a grid, covered areas, an index of edges, nearest points.

Polygons are rows with `rings`, an array of rings of [x, y]; the even-odd rule holds over all
rings, so holes and several parts need nothing more, and rings may be open or closed.
Work is dealt by grid cells, never by all pairs of polygons.
"""

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.finance import haversine
from .storage import stored

RINGS = "array<array<array<double>>>"


# clipping and areas


def half(ring: np.ndarray, axis: int, at: float, above: bool) -> np.ndarray:
    """The ring cut by a line across an axis. What it leaves along the line cancels under the even-odd rule."""
    if not len(ring):
        return ring
    keep = ring[:, axis] >= at if above else ring[:, axis] <= at
    if keep.all() or not keep.any():
        return ring if keep.all() else ring[:0]
    after = np.roll(ring, -1, axis=0)
    crossed = keep != np.roll(keep, -1)
    with np.errstate(divide="ignore", invalid="ignore"):
        cut = ring + (after - ring) * ((at - ring[:, axis]) / (after - ring)[:, axis])[:, None]
    cut[:, axis] = at
    return np.stack([ring, cut], axis=1)[np.stack([keep, crossed], axis=1)]


def pieces(rings: list, cell: float) -> list[tuple[int, int, list]]:
    """(column, row, rings) of the polygon's part in every cell that it meets; a range of cells is halved until it is one cell."""
    rings = [np.asarray([p[:2] for p in r], dtype=float) for r in rings if len(r) >= 3]
    if not rings:
        return []
    low, high = np.min([r.min(axis=0) for r in rings], axis=0), np.max([r.max(axis=0) for r in rings], axis=0)
    todo, out = [(np.floor(low / cell).astype(int), np.floor(high / cell).astype(int), rings)], []
    while todo:
        first, last, part = todo.pop()
        axis = int(np.argmax(last - first))
        if first[axis] == last[axis]:
            out.append((int(first[0]), int(first[1]), [r.tolist() for r in part]))
            continue
        mid = (first[axis] + last[axis]) // 2
        for above in (False, True):
            cut = [h for r in part if len(h := half(r, axis, (mid + 1) * cell, above)) >= 3]
            if cut:
                a, b = first.copy(), last.copy()
                if above:
                    a[axis] = mid + 1
                else:
                    b[axis] = mid
                todo.append((a, b, cut))
    return out


def corners(rings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Polygon, ring and [x, y] of every corner of a column of polygons; rings of less than three corners are left out."""
    size = lambda lists: pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    parts = rings.flatten()
    n, points = size(parts), parts.flatten()
    ring = np.repeat(np.arange(len(parts)), n)
    xy = np.stack([pc.list_element(points, k).to_numpy(zero_copy_only=False) for k in (0, 1)], axis=1)
    solid = n[ring] >= 3
    return np.repeat(np.arange(len(rings)), size(rings))[ring[solid]], ring[solid], xy[solid]


def bounds(owner: np.ndarray, xy: np.ndarray, n: int) -> np.ndarray:
    """The least and greatest x and y of n polygons, whose corners are in order; without corners they hold nothing."""
    out = np.tile([np.inf, np.inf, -np.inf, -np.inf], (n, 1))
    if len(owner):
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        out[owner[first]] = np.hstack([np.minimum.reduceat(xy, first, axis=0), np.maximum.reduceat(xy, first, axis=0)])
    return out


def gridded(polygons: DataFrame, key: str, cell: float) -> DataFrame:
    """key, cx, cy, rings: polygons (key, rings) clipped to the cells of a grid. Those inside one cell need no clipping."""
    kind = polygons.schema[key].dataType.simpleString()

    def split(batches):
        for b in batches:
            rings = b.column("rings")
            owner, _, xy = corners(rings)
            ends = bounds(owner, xy, len(rings))
            some = np.flatnonzero(ends[:, 0] <= ends[:, 2])
            at = np.floor(ends[some] / cell).astype(np.int64)
            one = (at[:, :2] == at[:, 2:]).all(axis=1)
            whole = pa.array(some[one])
            yield pa.RecordBatch.from_arrays([b.column(key).take(whole), pa.array(at[one, 0]), pa.array(at[one, 1]), rings.take(whole)], [key, "cx", "cy", "rings"])
            found = [(i, *piece) for i in some[~one].tolist() for piece in pieces(rings[i].as_py(), cell)]
            own, cx, cy, part = zip(*found, strict=True) if found else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([b.column(key).take(pa.array(own, pa.int64())), pa.array(cx, pa.int64()), pa.array(cy, pa.int64()), pa.array(part, rings.type)], [key, "cx", "cy", "rings"])

    # a small file is one task's, but clipping takes long
    dealt = polygons.select(key, F.col("rings").cast(RINGS).alias("rings")).repartition(F.xxhash64(key))
    return dealt.mapInArrow(split, f"`{key}` {kind}, cx long, cy long, rings {RINGS}")


def spread(n: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The row number, n times each, and beside it first, first + 1 and so on."""
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n - first, n)


def chunks(n: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Ranges of rows that weigh at most `most` together, or are one row."""
    total, out, begin = np.concatenate([[0], np.cumsum(n)]), [], 0
    while begin < len(n):
        end = max(begin + 1, int(np.searchsorted(total, total[begin] + most, "right")) - 1)
        out.append((begin, end))
        begin = end
    return out


def covered_jobs(e: np.ndarray, job: np.ndarray, owner: np.ndarray, jobs: int, slabs: int = 2048, most: int = 2**20) -> tuple[np.ndarray, np.ndarray]:
    """For each job, the area of its polygon (owner 0) and of the part that at least one of its other polygons covers. Exact up to rounding.

    e: edges [x, y, x, y] to the right, not upright, in order of their job.  The plane of
    a job is cut into slabs at all corners and crossings; inside a slab edges do not
    cross, so what lies between two neighbours is a trapezoid.  `slabs` are worked out at
    once, and about `most` pairs of edges.
    """
    whole, shared = np.zeros(jobs), np.zeros(jobs)
    if not len(e):
        return whole, shared
    slope = (e[:, 3] - e[:, 1]) / (e[:, 2] - e[:, 0])
    cuts, cut_jobs = [e[:, 0], e[:, 2]], [job, job]
    later = np.searchsorted(job, job, "right") - np.arange(len(e)) - 1
    for begin, end in chunks(later, most):  # edges against the later ones of their job
        i, k = spread(later[begin:end], np.arange(begin, end) + 1)
        i += begin
        with np.errstate(divide="ignore", invalid="ignore"):
            x = ((e[k, 1] - slope[k] * e[k, 0]) - (e[i, 1] - slope[i] * e[i, 0])) / (slope[i] - slope[k])
            met = (x > np.maximum(e[i, 0], e[k, 0])) & (x < np.minimum(e[i, 2], e[k, 2]))
        cuts.append(x[met])
        cut_jobs.append(job[i[met]])
    at, at_job = np.concatenate(cuts), np.concatenate(cut_jobs)
    order = np.lexsort((at, at_job))
    at, at_job = at[order], at_job[order]
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (at_job[1:] != at_job[:-1])])
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    at, at_job = at[new], at_job[new]
    first, last = place[: len(e)], place[len(e) : 2 * len(e)]
    for begin in range(0, len(at) - 1, slabs):
        low, high = np.clip(first, begin, begin + slabs), np.clip(last, begin, begin + slabs)
        edge, slab = spread(high - low, low)
        y = e[edge, 1] + slope[edge] * ((at[slab] + at[np.minimum(slab + 1, len(at) - 1)]) / 2 - e[edge, 0])
        # going up, a polygon's edges lead into it and out of it by turns
        by_owner = np.lexsort((y, owner[edge], slab))
        turn = np.empty(len(edge), dtype=np.int64)
        turn[by_owner] = 1 - 2 * (np.arange(len(edge)) % 2)
        up = np.lexsort((y, slab))
        own = owner[edge][up] == 0
        inside, over = np.cumsum(np.where(own, turn[up], 0))[:-1] > 0, np.cumsum(np.where(own, 0, turn[up]))[:-1] > 0
        here = slab[up][:-1]
        sizes = np.where(inside, np.diff(y[up]) * (at[np.minimum(here + 1, len(at) - 1)] - at[here]), 0.0)
        whole += np.bincount(at_job[here], sizes, jobs)
        shared += np.bincount(at_job[here][over], sizes[over], jobs)
    return whole, shared


def covered_parts(cell: np.ndarray, own: np.ndarray, rings: pa.Array, most: int = 2**15) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows of own parts, with their area and the part of it that the others of their cell cover; cells are in order. About `most` edges are worked out at once."""
    owner, ring, xy = corners(rings)
    ends = bounds(owner, xy, len(rings))
    following = np.arange(len(ring)) + 1
    if len(ring):
        begins = np.flatnonzero(np.concatenate([[True], ring[1:] != ring[:-1]]))
        following[np.concatenate([begins[1:], [len(ring)]]) - 1] = begins
    e = np.hstack([xy, xy[following]])
    slanted = e[:, 0] != e[:, 2]
    e, owner = e[slanted], owner[slanted]
    e = np.where((e[:, 0] < e[:, 2])[:, None], e, e[:, [2, 3, 0, 1]])
    n = np.bincount(owner, minlength=len(rings))
    first = np.cumsum(n) - n
    mine, others = np.flatnonzero(own), np.flatnonzero(~own)
    # the others of a cell are neighbours in `others`
    low, high = (np.searchsorted(cell[others], cell[mine], side) for side in ("left", "right"))
    edges_before = np.concatenate([[0], np.cumsum(n[others])])
    whole, shared = np.zeros(len(mine)), np.zeros(len(mine))
    for begin, end in chunks(n[mine] + edges_before[high] - edges_before[low] + high - low, most):
        job, k = spread((high - low)[begin:end], low[begin:end])
        a, b = ends[mine[begin:end][job]], ends[others[k]]
        near = (b[:, :2] < a[:, 2:]).all(axis=1) & (b[:, 2:] > a[:, :2]).all(axis=1)
        # a job's own polygon, then those that meet its bounds
        polygon = np.concatenate([mine[begin:end], others[k[near]]])
        jobs = np.concatenate([np.arange(end - begin), job[near]])
        number = np.concatenate([np.zeros(end - begin, dtype=np.int64), np.arange(1, near.sum() + 1)])
        by_job = np.argsort(jobs, kind="stable")
        row, edge = spread(n[polygon[by_job]], first[polygon[by_job]])
        whole[begin:end], shared[begin:end] = covered_jobs(e[edge], jobs[by_job][row], number[by_job][row], end - begin)
    return mine, whole, shared


def covered(base: list, others: list) -> tuple[float, float]:
    """Area of a polygon, and of the part that at least one of the others covers."""
    rings = pa.array([base, *others], pa.list_(pa.list_(pa.list_(pa.float64()))))
    _, whole, shared = covered_parts(np.zeros(len(rings), dtype=np.int64), np.arange(len(rings)) == 0, rings)
    return float(whole[0]), float(shared[0])


def covered_shares(places: DataFrame, zones: DataFrame, cell: float) -> DataFrame:
    """place, area, covered, share: how much of each polygon (place, rings) the union of zones (zone, rings) covers, in square units.

    Both sides are clipped to cells and meet there: a task goes through its cells in
    order and holds the parts of as many as come in a batch, at least those of one
    cell, whatever the size of a polygon. Zones that overlap count once.  Places
    without area are absent; those that no zone meets have share 0. Null rings are no
    polygon; places are unique. A smaller `cell` gives smaller groups.
    """
    kind = places.schema["place"].dataType.simpleString()
    mine = gridded(places, "place", cell).withColumn("own", F.lit(True))
    both = mine.unionByName(gridded(zones, "zone", cell).drop("zone").withColumns({"place": F.lit(None).cast(kind), "own": F.lit(False)}))

    def shared(batches):
        def worked(held):
            b = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            cx, cy = b.column("cx").to_numpy(), b.column("cy").to_numpy()
            number = np.cumsum(np.concatenate([[0], (cx[1:] != cx[:-1]) | (cy[1:] != cy[:-1])]))
            rows, area, over = covered_parts(number, b.column("own").to_numpy(zero_copy_only=False), b.column("rings"))
            return pa.RecordBatch.from_arrays([b.column("place").take(pa.array(rows)), pa.array(area), pa.array(over)], ["place", "area", "covered"])

        held = []
        for b in batches:
            if not len(b):
                continue
            # the last cell may go on in the next batch
            cx, cy = b.column("cx").to_numpy(), b.column("cy").to_numpy()
            other = np.flatnonzero((cx != cx[-1]) | (cy != cy[-1]))
            if held and not len(other):
                last = held[-1]
                if (last.column("cx")[0].as_py(), last.column("cy")[0].as_py()) != (cx[0], cy[0]):
                    yield worked(held)
                    held = []
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield worked([*held, b.slice(0, cut)])
                held = []
            held.append(b.slice(cut))
        if held:
            yield worked(held)

    ordered = both.select("place", "cx", "cy", "rings", "own").repartition("cx", "cy").sortWithinPartitions("cx", "cy")
    out = ordered.mapInArrow(shared, f"place {kind}, area double, covered double")
    out = out.groupBy("place").agg(F.sum("area").alias("area"), F.sum("covered").alias("covered")).where("area > 0")
    return out.withColumn("share", F.col("covered") / F.col("area"))


# edges


def corner_edges(polygons: DataFrame, digits: int) -> DataFrame:
    """place, ax, ay, bx, by: the edges of polygons (place, rings) between rounded corners, ends in ascending order."""
    ring = F.filter("ring", lambda p: p.isNotNull())
    rings = polygons.select("place", F.explode("rings").alias("ring")).select("place", F.transform(ring, lambda p: F.struct(F.round(p[0], digits).alias("x"), F.round(p[1], digits).alias("y"))).alias("p"))
    steps = rings.where(F.size("p") >= 3).select("place", F.explode(F.arrays_zip(F.col("p").alias("a"), F.concat(F.slice("p", 2, F.size("p") - 1), F.slice("p", 1, 1)).alias("b"))).alias("e"))
    ends = steps.select("place", F.least("e.a", "e.b").alias("a"), F.greatest("e.a", "e.b").alias("b")).where("a <> b")
    return ends.select("place", F.col("a.x").alias("ax"), F.col("a.y").alias("ay"), F.col("b.x").alias("bx"), F.col("b.y").alias("by"))


def split_edges(edges: DataFrame, cell: float, within: float) -> DataFrame:
    """The edges cut at every corner of any edge that lies on them (up to `within`), so that borders drawn with different corners agree.

    Edges meet corners in the cells that they pass.
    """
    ends = edges.select(F.explode(F.array(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y")))).alias("c")).select("c.*").distinct()
    ends = ends.select("x", "y", F.floor(F.col("x") / cell).alias("cx"), F.floor(F.col("y") / cell).alias("cy"))
    span = lambda a, b: F.sequence(F.floor((F.least(a, b) - within) / cell), F.floor((F.greatest(a, b) + within) / cell))
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    single = edges.select("ax", "ay", "bx", "by").distinct().withColumn("cx", F.explode(span(F.col("ax"), F.col("bx"))))
    # of a column of cells, only the rows that the edge passes there
    left, right = F.greatest(F.col("cx") * cell - within, F.least("ax", "bx")), F.least((F.col("cx") + 1) * cell + within, F.greatest("ax", "bx"))
    y_at = lambda x: F.when(dx == 0, F.col("ay")).otherwise(F.col("ay") + F.try_divide(dy, dx) * (x - F.col("ax")))
    low, high = F.when(dx == 0, F.col("ay")).otherwise(y_at(left)), F.when(dx == 0, F.col("by")).otherwise(y_at(right))
    passed = single.withColumn("cy", F.explode(span(low, high)))
    t = ((F.col("x") - F.col("ax")) * dx + (F.col("y") - F.col("ay")) * dy) / (dx * dx + dy * dy)
    off = F.sqrt(F.pow(F.col("ax") + F.col("t") * dx - F.col("x"), 2) + F.pow(F.col("ay") + F.col("t") * dy - F.col("y"), 2))
    own = ((F.col("x") == F.col("ax")) & (F.col("y") == F.col("ay"))) | ((F.col("x") == F.col("bx")) & (F.col("y") == F.col("by")))
    on = passed.join(ends, ["cx", "cy"]).withColumn("t", t).where((F.col("t") > 0) & (F.col("t") < 1) & ~own & (off <= within))
    stops = on.groupBy("ax", "ay", "bx", "by").agg(F.array_sort(F.collect_set(F.struct("t", "x", "y"))).alias("stops"))
    every = edges.join(stops, ["ax", "ay", "bx", "by"], "left")
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    way = F.concat(F.array(point(F.col("ax"), F.col("ay"))), F.coalesce(F.transform("stops", lambda s: point(s["x"], s["y"])), F.array().cast("array<struct<x:double,y:double>>")), F.array(point(F.col("bx"), F.col("by"))))
    legs = every.select("place", way.alias("w")).select("place", F.explode(F.arrays_zip(F.slice("w", 1, F.size("w") - 1).alias("a"), F.slice("w", 2, F.size("w") - 1).alias("b"))).alias("e"))
    ends = legs.select("place", F.least("e.a", "e.b").alias("a"), F.greatest("e.a", "e.b").alias("b")).where("a <> b")
    return ends.select("place", F.col("a.x").alias("ax"), F.col("a.y").alias("ay"), F.col("b.x").alias("bx"), F.col("b.y").alias("by"))


def edge_index(polygons: DataFrame, digits: int = 4, cell: float = 0.05, within: float | None = None) -> DataFrame:
    """ax, ay, bx, by, places: every edge on a place's border, with the places (ascending) that it bounds.

    polygons: place, rings in degrees.  An edge that a place has twice lies inside it
    (parts that touch) and bounds nothing.  Corners are rounded to `digits`; edges
    are cut where corners of others lie on them, up to `within` (half a unit of the
    last digit by default).  An edge of one place is outer, one of several a border.
    """
    legs = split_edges(corner_edges(polygons, digits), cell, 0.5 * 10**-digits if within is None else within)
    ends = ["ax", "ay", "bx", "by"]
    own = legs.groupBy(*ends, "place").agg(F.count("*").alias("n")).where("n % 2 = 1")
    return own.groupBy(*ends).agg(F.array_sort(F.collect_set("place")).alias("places"))


def length_km(edge: DataFrame) -> Column:
    return haversine(edge["ay"], edge["ax"], edge["by"], edge["bx"])


def by_the_sea(lon: Column, lat: Column) -> Column:
    """Whether an outer edge faces the sea: the islands, the west coast south of the northern river and the south coast.

    Fixed values: the limits in degrees.
    """
    islands, west, north, south, east = -15, -8.55, 41.87, 37.25, -7.42
    return (lon < islands) | ((lon < west) & (lat < north)) | ((lat < south) & (lon < east))


def borders(index: DataFrame) -> DataFrame:
    """place, neighbour, km: the length of the border of every two places that share edges, both ways round."""
    shared = index.where(F.size("places") > 1).select(length_km(index).alias("km"), F.explode("places").alias("place"), "places")
    return shared.select("place", F.explode("places").alias("neighbour"), "km").where("place <> neighbour").groupBy("place", "neighbour").agg(F.sum("km").alias("km"))


def coasts(index: DataFrame, least_km: float = 1.0) -> DataFrame:
    """place, border_km, outer_km, coast_km, neighbours, coastal: lengths of all edges, of the outer ones and of those by the sea."""
    sea = by_the_sea((F.col("ax") + F.col("bx")) / 2, (F.col("ay") + F.col("by")) / 2)
    outer = F.size("places") == 1
    rows = index.select(length_km(index).alias("km"), outer.alias("outer"), (outer & sea).alias("sea"), F.explode("places").alias("place"), "places")
    met = rows.select("place", F.explode("places").alias("o")).where("place <> o").groupBy("place").agg(F.count_distinct("o").alias("neighbours"))
    sums = rows.groupBy("place").agg(F.sum("km").alias("border_km"), F.sum(F.when(F.col("outer"), F.col("km")).otherwise(0.0)).alias("outer_km"), F.sum(F.when(F.col("sea"), F.col("km")).otherwise(0.0)).alias("coast_km"))
    return sums.join(met, "place", "left").withColumns({"neighbours": F.coalesce("neighbours", F.lit(0).cast("long")), "coastal": F.col("coast_km") >= least_km})


def spatial_table(polygons: DataFrame, digits: int = 4, cell: float = 0.05) -> DataFrame:
    """place, lon, lat, area_km2 and the columns of coasts(): centroid and area come from one sum over the border's edges."""
    ring = polygons.select("place", F.explode("rings").alias("r")).where(F.size("r") >= 3)
    steps = ring.select("place", F.explode(F.arrays_zip(F.col("r").alias("a"), F.concat(F.slice("r", 2, F.size("r") - 1), F.slice("r", 1, 1)).alias("b"))).alias("e"))
    ax, ay, bx, by = F.col("e.a")[0], F.col("e.a")[1], F.col("e.b")[0], F.col("e.b")[1]
    cross = ax * by - bx * ay
    sums = steps.groupBy("place").agg(F.sum(cross).alias("_s"), F.sum((ax + bx) * cross).alias("_x"), F.sum((ay + by) * cross).alias("_y")).where("_s <> 0")
    middle = sums.select("place", (F.col("_x") / F.col("_s") / 3).alias("lon"), (F.col("_y") / F.col("_s") / 3).alias("lat"), F.abs(F.col("_s") / 2).alias("_a"))
    # kilometres of a degree: along a meridian, and along a parallel at the equator
    area = (F.col("_a") * 110.57 * 111.32 * F.cos(F.radians("lat"))).alias("area_km2")
    return middle.select("place", "lon", "lat", area).join(coasts(edge_index(polygons, digits, cell)), "place", "left")


# nearest points


def on_sphere(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """Points on the unit sphere: nearest by angle is nearest by chord, with no date line and no poles."""
    lat, lon = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)], axis=1)


CUBE = ("_i", "_j", "_l")


def in_cubes(points: DataFrame, key: str, size: float) -> DataFrame:
    """key, lat, lon and the cube of the unit sphere that holds the point. Null coordinates are nowhere."""
    rows = points.where("lat is not null and lon is not null").select(key, F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))
    lat, lon = F.radians("lat"), F.radians("lon")
    at = (F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat))
    return rows.select("*", *[F.floor((v + 1.0) / size).alias(n) for v, n in zip(at, CUBE, strict=True)])


def with_reach(met: DataFrame, k: int) -> DataFrame:
    """Pairs of cubes of places and of centres (_i, _ic and so on, _n centres) that can hold one of the k nearest of any point of the former.

    The nearest corners are no farther than the farthest corners of the cubes that
    hold k centres for sure; distances are whole numbers of cubes, squared.  _total is
    the number of centres left for a cube of places.
    """
    apart = [F.abs(F.col(n) - F.col(f"{n}c")) for n in CUBE]
    near = sum((F.pow(F.greatest(d - 1, F.lit(0)), 2) for d in apart), F.lit(0.0))
    far = sum((F.pow(d + 1, 2) for d in apart), F.lit(0.0))
    running = W.partitionBy(*CUBE).orderBy("_far").rangeBetween(W.unboundedPreceding, 0)
    held = met.withColumns({"_near": near, "_far": far}).withColumn("_k", F.sum("_n").over(running))
    held = held.withColumn("_bound", F.min(F.when(F.col("_k") >= k, F.col("_far"))).over(W.partitionBy(*CUBE)))
    alive = held.where(F.col("_bound").isNull() | (F.col("_near") <= F.col("_bound"))).drop("_near", "_far", "_k", "_bound")
    return alive.withColumn("_total", F.sum("_n").over(W.partitionBy(*CUBE)))


def shortlists(places: pd.DataFrame, centres: pd.DataFrame, k: int) -> pd.DataFrame:
    """place, lat, lon, centre, _clat, _clon: for every place the centres no farther than the k-th nearest, and those as far up to rounding."""
    p, c = on_sphere(places["lat"].to_numpy(), places["lon"].to_numpy()), on_sphere(centres["lat"].to_numpy(), centres["lon"].to_numpy())
    rows, found = [], []
    step = max(1, 2**18 // max(len(c), 1))
    for begin in range(0, len(p) if len(c) else 0, step):
        gap = sum((p[begin : begin + step, None, axis] - c[None, :, axis]) ** 2 for axis in range(3))
        last = np.partition(gap, k - 1, axis=1)[:, k - 1 : k] if len(c) > k else np.full((len(gap), 1), 4.0)
        i, j = np.nonzero(gap <= (np.sqrt(last) + 1e-12) ** 2)
        rows.append(i + begin)
        found.append(j)
    i, j = (np.concatenate(x) if x else np.zeros(0, dtype=int) for x in (rows, found))
    ours, theirs = places[["place", "lat", "lon"]].take(i).reset_index(drop=True), centres[["centre", "lat", "lon"]].take(j).reset_index(drop=True)
    return pd.concat([ours, theirs.rename(columns={"lat": "_clat", "lon": "_clon"})], axis=1)


def nearest(places: DataFrame, centres: DataFrame, k: int = 1, levels: int = 7, fan: int = 4, most: int = 1000, rows_a_group: int = 20000) -> DataFrame:
    """place, centre, dist_km, nth: the k nearest of any number of centres (centre, lat, lon) to each place (place, lat, lon).

    Places and centres lie in cubes of the unit sphere, each cut into fan ** 3 at the
    next of `levels`.  A cube of places goes down the levels with the cubes that can
    hold one of the k nearest of its places, until these hold at most `most` centres
    or the levels end; so nothing is lost, whatever the data, and pairs are of cubes:
    their number does not grow with the places.  Then the places of a cube meet its
    centres and are compared exactly, at most about `rows_a_group` of either side in a
    group.  Ties: the first by name.  Centres at one point meet as their k first
    names.  Null coordinates are nowhere; places are unique.
    """
    deepest = 0.5 / fan ** (levels - 1)
    first = F.row_number().over(W.partitionBy("lat", "lon").orderBy("centre"))
    sites = stored(in_cubes(centres, "centre", deepest).withColumn("_nth", first).where(F.col("_nth") <= k).drop("_nth"))
    start = stored(in_cubes(places, "place", deepest))
    kinds = {c: df.schema[c].dataType.simpleString() for df, c in ((start, "place"), (sites, "centre"))}
    group = ["_level", *CUBE, "_a", "_b"]
    ours, theirs, open_ = [], [], None
    for level in range(levels):
        at = lambda n: F.floor(F.col(n) / fan ** (levels - 1 - level))  # noqa: B023, E731
        mine = start.groupBy(*[at(n).alias(n) for n in CUBE]).agg(F.count("*").alias("_p"))
        theirs_at = [at(n).alias(f"{n}c") for n in CUBE]
        cubes = sites.groupBy(*theirs_at).agg(F.count("*").alias("_n"))
        if open_ is None:
            met = mine.join(cubes, F.lit(True))  # at most 5 ** 3 cubes each, as many as the sphere has
        else:
            met = open_.join(mine, [F.floor(F.col(n) / fan) == F.col(f"{n}up") for n in CUBE]).join(cubes, [F.floor(F.col(f"{n}c") / fan) == F.col(f"{n}cup") for n in CUBE])
        pairs = stored(with_reach(met.select(*CUBE, "_p", *[f"{n}c" for n in CUBE], "_n"), k))
        going = F.lit(level < levels - 1) & (F.col("_total") > most)
        parts = lambda n: F.ceil(F.col(n) / rows_a_group).cast("int")
        done = pairs.where(~going).withColumns({"_level": F.lit(level), "_as": parts("_p"), "_bs": parts("_total")})
        # a cube with many places or centres is dealt to several groups
        deal = lambda n, key: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        asked = done.select("_level", *CUBE, "_as", "_bs").distinct()
        here = start.select("place", "lat", "lon", *[at(n).alias(n) for n in CUBE]).join(asked, list(CUBE))
        ours.append(here.withColumn("_a", deal("_as", "place")).withColumn("_b", every("_bs")))
        there = sites.select("centre", "lat", "lon", *theirs_at).join(done, [f"{n}c" for n in CUBE])
        theirs.append(there.withColumn("_b", deal("_bs", "centre")).withColumn("_a", every("_as")))
        open_ = pairs.where(going).select(*[F.col(n).alias(f"{n}up") for n in CUBE], *[F.col(f"{n}c").alias(f"{n}cup") for n in CUBE])
        if open_.isEmpty():
            break
    left = reduce(DataFrame.unionByName, ours).select(*group, "place", "lat", "lon")
    right = reduce(DataFrame.unionByName, theirs).select(*[F.col(c).alias(f"{c}r") for c in group], "centre", "lat", "lon")
    met = left.groupBy(*group).cogroup(right.groupBy(*[f"{c}r" for c in group])).applyInPandas(lambda a, b: shortlists(a, b, k), f"place {kinds['place']}, lat double, lon double, centre {kinds['centre']}, _clat double, _clon double")
    met = met.select("place", "centre", haversine(F.col("lat"), F.col("lon"), F.col("_clat"), F.col("_clon")).alias("dist_km"))
    nth = F.row_number().over(W.partitionBy("place").orderBy("dist_km", "centre"))
    return met.withColumn("nth", nth).where(F.col("nth") <= k)
