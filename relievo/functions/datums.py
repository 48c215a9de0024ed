"""Vertical and horizontal datums from names (S12, S13, GEO9, A25)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Vertical datum names and their EPSG codes.
VERTICAL = {
    "wgs84": 7912, "itrf2014": 7912, "navd88": 5703, "guvd04": 6644, "nmvd03": 6644, "asvd02": 6643, "prvd02": 6641, "vivd09": 6641,
    "egm2008": 3855, "egm96": 5773, "egm84": 5798, "msl": 5174, "wgs84(g1150)": 7660, "cgvd2013(cgg2013)": 6647, "cgvd2013": 6647,
    "cgvd2013(cgg2013a)": 9245,
}


def vertical_epsg(name: Column) -> Column:
    """The code of a datum's name; a number passes through, other text is null."""
    table = F.create_map(*(F.lit(v) for pair in VERTICAL.items() for v in pair))
    return F.coalesce(F.trim(name).try_cast("int"), F.try_element_at(table, F.lower(F.trim(name))))


def datum_of_path(path: Column) -> Column:
    """The first datum that a path names, in a fixed order."""
    low = F.lower(path)
    out = F.when(low.contains("navd88"), "navd88")
    for name in ("mhhw", "mhw", "mllw", "msl", "prvd02", "egm2008"):
        out = out.when(low.contains(name), name)
    return out


def datum_code(name: Column) -> Column:
    """The datum code in a file name, lower-cased; null without one."""
    return F.nullif(F.lower(F.regexp_extract(name, r"(?i)_(navd88|mhhw|mhw|mllw|msl|prvd02)(?=[_.])", 1)), F.lit(""))


def horizontal_epsg(text: Column) -> Column:
    """GEO9: the horizontal code of a reference text; NAD83 without a code is 4269."""
    code = F.regexp_extract(text, r'(?i)(?:AUTHORITY\["EPSG",\s*"|EPSG:|ID\["EPSG",)(\d{4,5})', 1)
    return F.coalesce(F.nullif(code, F.lit("")).cast("int"), F.when(F.upper(text).contains("NAD83"), F.lit(4269)))


def epoch_time(seconds: Column, epoch_seconds: int = 1514764800) -> Column:
    """Seconds since 2018-01-01 (or another epoch) as a timestamp."""
    return F.timestamp_micros(F.round((seconds + epoch_seconds) * 1e6).cast("bigint"))
