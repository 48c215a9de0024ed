"""Rings of ``array<struct<x,y>>`` and projections as column expressions (GEO1-GEO6)."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: WGS 84.
_A, _F = 6378137.0, 1 / 298.257223563
_E2 = _F * (2 - _F)
_E = math.sqrt(_E2)


def utm_zone(lon: Column) -> Column:
    """The zone of a longitude, 1 to 60."""
    return (F.floor((lon + 180) / 6) % 60 + 1).cast("int")


#: The third flattening and the radius of the rectifying sphere.
_N = _F / (2 - _F)
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)


def _geodetic(chi: Column) -> Column:
    """The latitude of a conformal latitude, in radians, by its series in the third flattening (off by less than 1e-11)."""
    n = _N
    delta = (
        2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45, 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45, 56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630,
    )
    phi = chi
    for j, d in enumerate(delta, 1):
        phi = phi + d * F.sin(2 * j * chi)
    return phi


def to_utm(lon: Column, lat: Column, zone: Column | int, south: Column | bool | None = None) -> Column:
    """GEO1: metres east and north in a UTM zone, by Krueger's series in the third flattening.

    ``south`` says which hemisphere's zone it is; that of the point by default.
    """
    below = lat < 0 if south is None else F.lit(south)
    xi, eta = _sphere(_conformal(lat), F.radians(lon - (F.lit(zone) * 6 - 183)))
    return _utm_metres(xi, eta, below)


def _conformal(lat: Column) -> Column:
    """The tangent of the conformal latitude."""
    s, c = F.sin(F.radians(lat)), 2 * math.sqrt(_N) / (1 + _N)
    return F.sinh(_atanh(s) - c * _atanh(c * s))


def _atanh(v: Column) -> Column:
    return 0.5 * F.ln((1 + v) / (1 - v))


def _sphere(t: Column, lam: Column) -> tuple[Column, Column]:
    """Transverse Mercator coordinates on the sphere."""
    return F.atan2(t, F.cos(lam)), _atanh(F.sin(lam) / F.sqrt(1 + t * t))


def _utm_metres(xi: Column, eta: Column, south: Column) -> Column:
    n = _N
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    east, north = eta, xi
    for j, a in enumerate(alpha, 1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return F.struct((500000 + 0.9996 * _RADIUS * east).alias("x"), (F.when(south, 1e7).otherwise(0.0) + 0.9996 * _RADIUS * north).alias("y"))


def from_utm(x: Column, y: Column, zone: Column | int, south: Column | bool = False) -> Column:
    """GEO1 back: longitude and latitude, by Krueger's inverse series; longitudes go on beyond 180 degrees beside the date line."""
    n = _N
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440, 17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280)
    east, north = (x - 500000) / (0.9996 * _RADIUS), (y - F.when(F.lit(south), 1e7).otherwise(0.0)) / (0.9996 * _RADIUS)
    eta, xi = east, north
    for j, b in enumerate(beta, 1):
        eta = eta - b * F.cos(2 * j * north) * F.sinh(2 * j * east)
        xi = xi - b * F.sin(2 * j * north) * F.cosh(2 * j * east)
    phi = _geodetic(F.asin(F.sin(xi) / F.cosh(eta)))
    lon0 = F.lit(zone) * 6 - 183
    return F.struct((lon0 + F.degrees(F.atan2(F.sinh(eta), F.cos(xi)))).alias("x"), F.degrees(phi).alias("y"))


def to_polar(lon: Column, lat: Column, north: bool = True, true_scale: float | None = None, central: float | None = None) -> Column:
    """GEO1: metres in a polar stereographic projection (70 N, -45 E or 71 S, 0 E by default)."""
    sign, scale, lon0 = _polar(north, true_scale, central)
    phi, lam = F.radians(sign * lat), F.radians(lon - lon0)
    e = _E * F.sin(phi)
    rho = scale * F.tan(math.pi / 4 - phi / 2) / F.pow((1 - e) / (1 + e), F.lit(_E / 2))
    return F.struct((rho * F.sin(lam)).alias("x"), (-sign * rho * F.cos(lam)).alias("y"))


def from_polar(x: Column, y: Column, north: bool = True, true_scale: float | None = None, central: float | None = None) -> Column:
    """GEO1 back: longitude (-180 to 180) and latitude; the pole itself has the central meridian."""
    sign, scale, lon0 = _polar(north, true_scale, central)
    chi = math.pi / 2 - 2 * F.atan(F.sqrt(x * x + y * y) / scale)
    lon = lon0 + F.degrees(F.when((x == 0) & (y == 0), 0.0).otherwise(F.atan2(x, -sign * y)))
    return F.struct(F.when(lon > 180, lon - 360).when(lon < -180, lon + 360).otherwise(lon).alias("x"), (sign * F.degrees(_geodetic(chi))).alias("y"))


def _polar(north: bool, true_scale: float | None, central: float | None) -> tuple[int, float, float]:
    """The sign, the scale at the pole in metres and the central meridian of a polar stereographic projection."""
    ts = math.radians(abs(true_scale if true_scale is not None else (70.0 if north else 71.0)))
    e = _E * math.sin(ts)
    t = math.tan(math.pi / 4 - ts / 2) / ((1 - e) / (1 + e)) ** (_E / 2)
    m = math.cos(ts) / math.sqrt(1 - _E2 * math.sin(ts) ** 2)
    return 1 if north else -1, _A * m / t, central if central is not None else (-45.0 if north else 0.0)


def _by_code(epsg: Column | int, utm: Callable, polar: Callable) -> Column:
    """One of two kinds of formulas by code: UTM on WGS 84 (326zz, 327zz), or 3413 and 3031."""
    if isinstance(epsg, int):
        if 32601 <= epsg <= 32660 or 32701 <= epsg <= 32760:
            return utm(epsg % 100, epsg > 32700)
        if epsg in (3413, 3031):
            return polar(epsg == 3413)
        raise ValueError(f"no formula for EPSG {epsg}")
    unknown = F.raise_error(F.concat(F.lit("no formula for EPSG "), epsg.cast("string"))).cast("struct<x:double,y:double>")
    return (
        F.when(epsg.between(32601, 32660) | epsg.between(32701, 32760), utm(epsg % 100, epsg > 32700))
        .when(epsg == 3413, polar(True)).when(epsg == 3031, polar(False)).otherwise(unknown)
    )


def project(lon: Column, lat: Column, epsg: Column | int) -> Column:
    """GEO1 by code, one for all rows or a column of them; others raise."""
    return _by_code(epsg, lambda zone, south: to_utm(lon, lat, zone, south), lambda north: to_polar(lon, lat, north))


def with_projected(df: DataFrame, lon: str, lat: str, epsg: str, out: str) -> DataFrame:
    """GEO1 for many rows: :func:`project` as a column ``out``, in steps that each stand in the plan once."""
    code = F.col(epsg)
    utm = code.between(32601, 32660) | code.between(32701, 32760)
    zone = code % 100
    steps = df.withColumns({"__t": F.when(utm, _conformal(F.col(lat))), "__lam": F.when(utm, F.radians(F.col(lon) - (zone * 6 - 183)))})
    xi, eta = _sphere(F.col("__t"), F.col("__lam"))
    steps = steps.withColumns({"__xi": xi, "__eta": eta})
    polar = _by_code(code, lambda zone, south: F.lit(None).cast("struct<x:double,y:double>"), lambda north: to_polar(F.col(lon), F.col(lat), north))
    return steps.withColumn(out, F.when(utm, _utm_metres(F.col("__xi"), F.col("__eta"), code > 32700)).otherwise(polar)).drop("__t", "__lam", "__xi", "__eta")


def unproject(x: Column, y: Column, epsg: Column | int) -> Column:
    """GEO1 back, by code."""
    return _by_code(epsg, lambda zone, south: from_utm(x, y, zone, south), lambda north: from_polar(x, y, north))


def box_ring(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """The closed ring of a box, anticlockwise."""
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(point(xmin, ymin), point(xmax, ymin), point(xmax, ymax), point(xmin, ymax), point(xmin, ymin))


def densified(ring: Column, steps: int) -> Column:
    """GEO2: each edge cut into ``steps`` equal parts; infinite points are dropped."""
    starts = F.slice(ring, 1, F.size(ring) - 1)
    ends = F.slice(ring, 2, F.size(ring) - 1)
    part = lambda a, b, k: a + (b - a) * k / float(steps)
    edges = F.zip_with(
        starts, ends,
        lambda a, b: F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), lambda k: F.struct(part(a["x"], b["x"], k).alias("x"), part(a["y"], b["y"], k).alias("y"))),
    )
    whole = F.concat(F.flatten(edges), F.slice(ring, -1, 1))
    return F.filter(whole, lambda p: (F.abs(p["x"]) < float("inf")) & (F.abs(p["y"]) < float("inf")))


def crosses_dateline(ring: Column, tolerance: float = 1e-6) -> Column:
    """GEO3: vertices at both edges of the map."""
    return F.exists(ring, lambda p: p["x"] <= -180 + tolerance) & F.exists(ring, lambda p: p["x"] >= 180 - tolerance)


def signed_area(ring: Column) -> Column:
    """GEO4: the shoelace sum of a closed ring, positive anticlockwise."""
    cross = F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    return F.aggregate(cross, F.lit(0.0), lambda s, v: s + v) / 2


def anticlockwise(ring: Column) -> Column:
    """GEO4: the ring, turned if need be; a ring without area raises."""
    area = signed_area(ring)
    return F.when(area > 0, ring).when(area < 0, F.reverse(ring)).otherwise(F.raise_error(F.lit("the ring has no area")))


def contains(ring: Column, x: Column, y: Column) -> Column:
    """GEO5: even-odd rule; lower and left edges belong to the ring, upper and right ones do not."""

    def crossed(a: Column, b: Column) -> Column:
        spans = (a["y"] <= y) != (b["y"] <= y)
        at = a["x"] + (y - a["y"]) * (b["x"] - a["x"]) / (b["y"] - a["y"])
        return F.when(spans, (x < at).cast("int")).otherwise(0)

    hits = F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), crossed)
    return F.aggregate(hits, F.lit(0), lambda s, v: s + v) % 2 == 1


def pole(ring: Column) -> Column:
    """GEO6: N or S when a lon/lat ring holds a pole, NI or SI when it has a vertex there, else null.

    Going around a pole turns the longitudes by a full circle.
    """
    step = lambda a, b: (b["x"] - a["x"] + 540) % 360 - 180
    turn = F.aggregate(F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), step), F.lit(0.0), lambda s, v: s + v)
    mean = F.aggregate(ring, F.lit(0.0), lambda s, p: s + p["y"]) / F.size(ring)
    return (
        F.when(F.exists(ring, lambda p: p["y"] >= 90), "NI").when(F.exists(ring, lambda p: p["y"] <= -90), "SI")
        .when((F.abs(turn) > 180) & (mean > 0), "N").when((F.abs(turn) > 180) & (mean < 0), "S")
    )


def box_wkt(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """GEO10: a box as POLYGON text."""
    at = lambda x, y: F.concat_ws(" ", x.cast("string"), y.cast("string"))
    return F.concat(F.lit("POLYGON (("), F.concat_ws(", ", at(xmin, ymin), at(xmax, ymin), at(xmax, ymax), at(xmin, ymax), at(xmin, ymin)), F.lit("))"))


def rmse(error: Column) -> Column:
    """S19, as an aggregate."""
    return F.sqrt(F.avg(error * error))


def latitude_weight(lat: Column) -> Column:
    """The share of a cell's area."""
    return F.cos(F.radians(lat))


def arc_seconds(degrees: Column) -> Column:
    """S19."""
    return degrees * 3600
