"""Spatial joins without nested loops: geocell equi-joins.

The globe is cut into square cells, ``n_lon`` = 360 / cell columns and rows from the south pole. A
join on the cell is a plain hash equi-join, so it shuffles on the cell and AQE can split hot cells
(a busy hub) as skewed partitions.

* ``within_join``  -- point in circle (ST_DWithin, C22), on request only while the circle is valid:
  circles are put into classes of radius, a factor of four each, and each class has a grid of its
  own, so a circle lists a handful of cells whatever its size; with times, it lists them for each
  day of its validity. Points join on their cell of every class that occurs (and their day).
  Circles around one centre go together, so the distance to it is found once.
* ``nearest_join`` -- nearest site per point (KNN top-1, C23): a pyramid of the cells that hold
  sites, with counts, is descended together with the cells that hold points. A pair of cells stays
  only while its least possible distance is not beyond the least upper bound of the point cell;
  a site cell is opened while it holds more than a few sites. Empty cells are never listed, and
  the work follows the number of occupied cells, not the size of the searched area.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions.codes import EARTH_RADIUS_SPHERE_M
from contrail.functions.geo import with_near_distance, with_spheroid_distance

DEG_M = math.pi * EARTH_RADIUS_SPHERE_M / 180.0
#: A geodesic and the distance on the sphere differ by less than this share.
SPHERE_SLACK = 0.01


def grid(cell_deg_min: float) -> tuple[float, int, int]:
    """Cell size dividing 360 evenly, at least ``cell_deg_min``; (cell, n_lon, n_lat)."""
    n_lon = max(1, int(360.0 // max(cell_deg_min, 1e-6)))
    cell = 360.0 / n_lon
    n_lat = int(math.ceil(180.0 / cell))
    return cell, n_lon, n_lat


def _d(c) -> Column:
    return (c if isinstance(c, Column) else F.col(c)).cast("double")


def cell_of(lat, lon, cell: float, n_lon: int, n_lat: int) -> tuple[Column, Column]:
    cy = F.least(F.floor((_d(lat) + 90.0) / cell), F.lit(n_lat - 1)).cast("int")
    cx = F.pmod(F.floor((_d(lon) + 180.0) / cell), F.lit(n_lon)).cast("int")
    return cy, cx


def block_cells(lat, lon, radius_deg_lat: Column, cell: float, n_lon: int, n_lat: int) -> Column:
    """Distinct (cy, cx) cells covering a circle of the given latitude-degree radius."""
    la, lo = _d(lat), _d(lon)
    lat_lo = F.greatest(la - radius_deg_lat, F.lit(-90.0))
    lat_hi = F.least(la + radius_deg_lat, F.lit(90.0))
    edge = F.greatest(F.abs(lat_lo), F.abs(lat_hi))
    full = (edge >= 89.999) | (radius_deg_lat >= 90.0)
    dlon = F.when(full, F.lit(360.0)).otherwise(radius_deg_lat / F.cos(F.radians(edge)))
    cy0 = F.least(F.floor((lat_lo + 90.0) / cell), F.lit(n_lat - 1)).cast("int")
    cy1 = F.least(F.floor((lat_hi + 90.0) / cell), F.lit(n_lat - 1)).cast("int")
    all_x = dlon * 2 >= 360.0 - cell
    cx0 = F.when(all_x, F.lit(0)).otherwise(F.floor((lo - dlon + 180.0) / cell)).cast("int")
    cx1 = F.when(all_x, F.lit(n_lon - 1)).otherwise(F.floor((lo + dlon + 180.0) / cell)).cast("int")
    xs = F.array_distinct(F.transform(F.sequence(cx0, cx1), lambda x: F.pmod(x, F.lit(n_lon))))
    return F.flatten(F.transform(F.sequence(cy0, cy1),
                                 lambda y: F.transform(xs, lambda x: F.struct(y.alias("cy"), x.alias("cx")))))


def _radius_class(radius: Column) -> Column:
    """0 up to 1 km, then a class for every factor of four."""
    return F.greatest(F.ceil(F.log(F.greatest(radius, F.lit(1.0)) / 1000.0) / math.log(4.0)), F.lit(0)).cast("int")


#: Zones of one centre held together in one array.
PACK = 64


def _on_sphere(lat, lon) -> Column:
    """Point of the unit sphere, to compare distances without trigonometry."""
    la, lo = F.radians(_d(lat)), F.radians(_d(lon))
    return F.struct((F.cos(la) * F.cos(lo)).alias("x"), (F.cos(la) * F.sin(lo)).alias("y"), F.sin(la).alias("z"))


def _chord2(a, b) -> Column:
    """Square of the straight line between two points of the unit sphere."""
    return sum((a[c] - b[c]) * (a[c] - b[c]) for c in "xyz")


def _packed(df: DataFrame, keys: list[str], order: list[Column], pack: int, out: str) -> DataFrame:
    """Rows with equal ``keys`` as arrays of at most ``pack`` structs, neighbours in ``order`` together."""
    fields = df.columns
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (df.withColumn("_part", F.floor((nth - 1) / pack)).groupBy(*keys, "_part")
              .agg(F.collect_list(F.struct(*fields)).alias(out)).drop("_part"))


def within_join(points: DataFrame, p_lat: str, p_lon: str, zones: DataFrame, z_lat: str, z_lon: str, radius_m: str,
                p_time: str | None = None, z_from: str | None = None, z_to: str | None = None) -> DataFrame:
    """All (point, zone) pairs with geodesic distance <= the zone radius; adds ``dist_m``.

    With times, only pairs whose point lies in [z_from, z_to] too, both ends included; a null end
    is open. Points or zones without coordinates, radius or (with times) point time match nothing.
    Zones around one centre are joined as one, in packs of similar radius: a distance is found once
    for a point and a pack, and the pack's zones that reach it are listed after.
    """
    radius = F.col(radius_m).cast("double")
    columns = [F.col(f"_z.{c}").alias(c) for c in zones.columns]
    zones = zones.where(F.col(z_lat).isNotNull() & F.col(z_lon).isNotNull() & (radius >= 0))
    points = points.where(F.col(p_lat).isNotNull() & F.col(p_lon).isNotNull())
    found = points.columns
    timed = p_time is not None
    days = ["_day"] if timed else []
    if timed:
        points = points.where(F.col(p_time).isNotNull()).withColumn("_day", F.col(p_time).cast("date"))
        first, last = points.agg(F.min("_day"), F.max("_day")).first()
        # days without points need no entry, so an open end lists no more days than the points have
        low, high = (F.coalesce(f(F.col(c).cast("date"), F.lit(e)), F.lit(e)) for f, c, e in ((F.greatest, z_from, first), (F.least, z_to, last)))
        zones = zones.where(F.lit(first is not None) & (low <= high)).withColumn("_day", F.explode(F.sequence(low, high)))
    centred = zones.withColumn("_clat", _d(z_lat)).withColumn("_clon", _d(z_lon)).withColumn("_far", radius)
    packs = _packed(centred, ["_clat", "_clon", *days], [F.col("_far")], PACK, "_zones")
    packs = packs.withColumn("_far", F.array_max("_zones._far")).withColumn("_k", _radius_class(F.col("_far")))
    # classes of radius that occur: at most eleven, from 1 km to the globe
    classes = sorted(r[0] for r in packs.select("_k").distinct().collect())
    # widened so that the sphere-based cover also holds for geodesic distances
    reach = F.col("_far") * (1 + SPHERE_SLACK) + 1.0
    half = F.sin(F.least(reach / (2 * EARTH_RADIUS_SPHERE_M), F.lit(math.pi / 2)))
    packs = packs.withColumn("_cp", _on_sphere("_clat", "_clon")).withColumn("_chord2", 4 * half * half + 1e-13)
    cells, at = None, []
    for k in classes:
        cell, n_lon, n_lat = grid(min(max(1000.0 * 4.0**k / DEG_M, 0.01), 90.0))
        mine = packs.where(F.col("_k") == k).withColumn("_c", F.explode(block_cells("_clat", "_clon", reach / DEG_M, cell, n_lon, n_lat))) \
            .select("*", F.col("_c.cy").alias("_cy"), F.col("_c.cx").alias("_cx")).drop("_c")
        cells = mine if cells is None else cells.unionByName(mine)
        cy, cx = cell_of(p_lat, p_lon, cell, n_lon, n_lat)
        at.append(F.struct(F.lit(k).alias("_k"), cy.alias("_cy"), cx.alias("_cx")))
    if cells is None:
        cells, at = packs.withColumn("_cy", F.lit(0)).withColumn("_cx", F.lit(0)), [F.struct(F.lit(0).alias("_k"), F.lit(0).alias("_cy"), F.lit(0).alias("_cx"))]
    placed = points.withColumn("_pp", _on_sphere(p_lat, p_lon)).withColumn("_c", F.explode(F.array(*at))).select("*", "_c.*").drop("_c")
    j = placed.join(cells, ["_k", "_cy", "_cx", *days]).where(_chord2(F.col("_pp"), F.col("_cp")) <= F.col("_chord2"))
    j = with_spheroid_distance(j.select(*found, "_clat", "_clon", "_far", "_zones"), "dist_m", p_lat, p_lon, "_clat", "_clon").where("dist_m <= _far")
    j = j.select(*found, "dist_m", F.explode(F.filter("_zones", lambda z: z["_far"] >= F.col("dist_m"))).alias("_z"))
    j = j.select(*found, *columns, "dist_m")
    if timed:
        j = j.where((F.col(z_from).isNull() | (F.col(p_time) >= F.col(z_from))) & (F.col(z_to).isNull() | (F.col(p_time) <= F.col(z_to))))
    return j


#: Cells of the pyramid's levels: 45 degrees, then a quarter of the level above, down to about 1.2 km.
_TOP_DEG, _STEP, _LEVELS = 45, 4, 7


def _level(level: int) -> tuple[float, int, int]:
    cell = _TOP_DEG / _STEP**level
    return cell, round(360 / cell), round(180 / cell)


def _bounded(pairs: DataFrame, q_cell: float) -> DataFrame:
    """``pairs`` with _least and _most, the least and greatest possible distance between points of two cells.

    Both are the geodesic between the centres, less or plus what the cells reach around them.
    """
    c_cell = F.lit(float(_TOP_DEG)) / F.pow(F.lit(float(_STEP)), F.col("cl"))
    centred = pairs.select("*", *[(((F.col(c) + 0.5) * w) - o).alias(f"_{c}") for c, w, o in (
        ("qy", F.lit(q_cell), 90), ("qx", F.lit(q_cell), 180), ("cy", c_cell, 90), ("cx", c_cell, 180))])
    apart = with_near_distance(centred, "_apart", "_qy", "_qx", "_cy", "_cx")
    reach = (F.lit(q_cell) + c_cell) * (math.sqrt(0.5) * DEG_M * (1 + SPHERE_SLACK))
    # the closed formula is coarse towards antipodes
    reach = reach + F.when(F.col("_apart") > 1.6e7, 1e5).otherwise(1.0)
    return apart.withColumn("_least", F.col("_apart") - reach).withColumn("_most", F.col("_apart") + reach).drop("_qy", "_qx", "_cy", "_cx", "_apart")


def candidate_cells(points: DataFrame, sites: DataFrame, per_cell: int = 8) -> tuple[DataFrame, int]:
    """(qy, qx, cl, cy, cx, n): site cells that may hold the nearest site of a point in cell (qy, qx); and the points' level.

    ``points`` has _plat, _plon and ``sites`` _slat, _slon, without nulls.
    """
    def cells(lat: str, lon: str, level: int) -> Column:
        cell, n_lon, n_lat = _level(level)
        cy, cx = cell_of(lat, lon, cell, n_lon, n_lat)
        return F.struct(F.lit(level).alias("cl"), cy.alias("cy"), cx.alias("cx"))

    pyramid = sites.select(F.explode(F.array(*[cells("_slat", "_slon", k) for k in range(_LEVELS)])).alias("c")).select("c.*").groupBy("cl", "cy", "cx").agg(F.count("*").alias("n"))
    crowd = {r.cl: r.n for r in pyramid.groupBy("cl").agg(F.max("n").alias("n")).collect()}  # a row a level
    depth = next((k for k in range(_LEVELS) if crowd.get(k, 0) <= per_cell), _LEVELS - 1)
    finest = points.select(cells("_plat", "_plon", depth).alias("c")).select(F.col("c.cy").alias("qy"), F.col("c.cx").alias("qx")).distinct()

    def up(df: DataFrame, levels: int) -> DataFrame:
        step = _STEP**levels
        return df.select(F.floor(F.col("qy") / step).cast("int").alias("qy"), F.floor(F.col("qx") / step).cast("int").alias("qx")).distinct() if levels else df

    def prune(pairs: DataFrame, level: int) -> DataFrame:
        reach = F.min("_most").over(Window.partitionBy("qy", "qx"))
        return _bounded(pairs, float(_level(level)[0])).withColumn("_reach", reach).where("_least <= _reach").drop("_least", "_most", "_reach")

    # the top level: at most 32 cells on either side
    pairs = prune(up(finest, depth).crossJoin(F.broadcast(pyramid.where("cl = 0"))), 0)
    for level in range(1, depth + 1):
        below = up(finest, depth - level).select(F.floor(F.col("qy") / _STEP).cast("int").alias("_uy"), F.floor(F.col("qx") / _STEP).cast("int").alias("_ux"), "qy", "qx")
        opened = pyramid.where(F.col("cl") == level).select(F.floor(F.col("cy") / _STEP).cast("int").alias("_oy"), F.floor(F.col("cx") / _STEP).cast("int").alias("_ox"),
                                                            F.col("cl").alias("_cl"), F.col("cy").alias("_cy"), F.col("cx").alias("_cx"), F.col("n").alias("_n"))
        full = (F.col("n") > per_cell) & (F.col("cl") == level - 1)  # such a cell has cells below
        pairs = pairs.join(opened, full & (F.col("cy") == F.col("_oy")) & (F.col("cx") == F.col("_ox")), "left").select(
            F.col("qy").alias("_uy"), F.col("qx").alias("_ux"), *[F.coalesce(f"_{c}", c).alias(c) for c in ("cl", "cy", "cx", "n")])
        pairs = pairs.join(below, ["_uy", "_ux"]).select("qy", "qx", "cl", "cy", "cx", "n")
        pairs = prune(pairs, level)
    return pairs, depth


def _nearest_on_sphere(met: DataFrame) -> DataFrame:
    """Points with an array ``_sites`` each to (point, site) rows, only of sites that may be the array's nearest.

    A site passes unless it is farther on the sphere than the nearest one there by more than sphere and
    geodesic can differ, so that few rows a point are compared and grouped after.
    """
    def apart(site) -> Column:
        return -sum((F.col("_pp")[c] * site["_sp"][c] for c in "xyz"), F.lit(0.0))  # less cosine of the angle: NaN is the greatest

    least = F.acos(F.least(F.greatest(-F.array_min(F.transform("_sites", apart)), F.lit(-1.0)), F.lit(1.0)))
    # the closed formula is coarse towards antipodes
    reach = least * ((1 + SPHERE_SLACK) / (1 - SPHERE_SLACK)) + F.when(least > 2.3, 0.035).otherwise(1e-6)
    cut = met.withColumn("_pp", _on_sphere("_plat", "_plon")).withColumn("_cut", 1e-12 - F.cos(F.least(reach, F.lit(math.pi))))
    rows = cut.select("_pid", "_plat", "_plon", "_pp", "_cut", F.explode("_sites").alias("_s"))
    return rows.where(apart(F.col("_s")) <= F.col("_cut")).select("_pid", "_plat", "_plon", "_s._sid", "_s._slat", "_s._slon")


def nearest_join(points: DataFrame, pid: str, p_lat: str, p_lon: str, sites: DataFrame, sid: str,
                 s_lat: str, s_lon: str, site_cols: list[str] | None = None, per_cell: int = 8) -> DataFrame:
    """Nearest site (geodesic distance, ties by site id) for every point; adds ``dist_m``.

    A point without coordinates, and every point when no site has any, is kept with a null site.
    Sites compare by ``with_near_distance``; ``dist_m`` is the solver's distance to the one chosen.
    The sites near a cell are held in arrays, and only those that may be the nearest become rows.
    """
    site_cols = site_cols or []
    no_site = [F.lit(None).cast(sites.schema[sid].dataType).alias(sid), F.lit(None).cast("double").alias("dist_m"),
               *[F.lit(None).cast(sites.schema[c].dataType).alias(c) for c in site_cols]]
    placed = sites.where(F.col(s_lat).isNotNull() & F.col(s_lon).isNotNull()).select(
        F.col(sid).alias("_sid"), F.col(s_lat).cast("double").alias("_slat"), F.col(s_lon).cast("double").alias("_slon"))
    if placed.isEmpty():
        return points.select(pid, *no_site)
    lost = points.where(F.col(p_lat).isNull() | F.col(p_lon).isNull()).select(pid, *no_site)
    todo = points.where(F.col(p_lat).isNotNull() & F.col(p_lon).isNotNull()).select(
        F.col(pid).alias("_pid"), F.col(p_lat).cast("double").alias("_plat"), F.col(p_lon).cast("double").alias("_plon"))
    pairs, depth = candidate_cells(todo, placed, per_cell)

    def keyed(df: DataFrame, lat: str, lon: str, level: int, names: tuple[str, str]) -> DataFrame:
        cy, cx = cell_of(lat, lon, *_level(level))
        return df.withColumn(names[0], cy).withColumn(names[1], cx)

    held = None
    for level in range(depth + 1):
        mine = keyed(placed, "_slat", "_slon", level, ("cy", "cx")).withColumn("cl", F.lit(level))
        held = mine if held is None else held.unionByName(mine)
    near = pairs.join(held.withColumn("_sp", _on_sphere("_slat", "_slon")), ["cl", "cy", "cx"]).select("qy", "qx", "_sid", "_slat", "_slon", "_sp")
    packs = _packed(near, ["qy", "qx"], [F.col("_sid")], PACK, "_sites")
    met = _nearest_on_sphere(keyed(todo, "_plat", "_plon", depth, ("qy", "qx")).join(packs, ["qy", "qx"]))
    met = with_near_distance(met, "_d", "_plat", "_plon", "_slat", "_slon")
    # (distance, site id): ties go to the smaller id, on every run
    best = met.groupBy("_pid").agg(F.min(F.struct("_d", "_sid", "_plat", "_plon", "_slat", "_slon")).alias("_b")).select("_pid", "_b.*")
    res = with_spheroid_distance(best, "dist_m", "_plat", "_plon", "_slat", "_slon").select(F.col("_pid").alias(pid), F.col("_sid").alias(sid), "dist_m")
    if site_cols:
        # site attributes join once, on the winner only (N:1 on the site id)
        res = res.join(sites.select(sid, *site_cols), sid, "left")
    return res.select(lost.columns).unionByName(lost)
