"""Names of tiles, granules, beams and files as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tile_tag(y: Column, x: Column) -> Column:
    """``N05W120`` from the south-west corner."""
    y, x = y.cast("int"), x.cast("int")
    return F.format_string("%s%02d%s%03d", F.when(y < 0, "S").otherwise("N"), F.abs(y), F.when(x < 0, "W").otherwise("E"), F.abs(x))


def tag_corner(name: Column) -> Column:
    """S1 the other way: a struct of y and x from the first tag in a name, null without one."""
    part = lambda i: F.regexp_extract(name, r"([NSns])(\d{2})([EWew])(\d{3})", i)
    number = lambda i, minus: F.when(part(i) != "", part(i).cast("int") * F.when(F.upper(part(i - 1)) == minus, -1).otherwise(1))
    return F.struct(number(2, "S").alias("y"), number(4, "W").alias("x"))


def photon_tile_name(y: Column, x: Column) -> Column:
    """Two decimals, zero padded: ``photon_tile_N05.25_W120.50``."""
    return F.format_string("photon_tile_%s%05.2f_%s%06.2f", F.when(y < 0, "S").otherwise("N"), F.abs(y), F.when(x < 0, "W").otherwise("E"), F.abs(x))


def one_degree_box(name: Column) -> Column:
    """S3: ``(xmin, ymin, xmax, ymax)`` of a one-degree file name."""
    at = tag_corner(name)
    return F.struct(at["x"].alias("xmin"), at["y"].alias("ymin"), (at["x"] + 1).alias("xmax"), (at["y"] + 1).alias("ymax"))


def granule_numbers(name: Column) -> Column:
    """Two numbers of a granule name: its time stamp, and track, cycle and versions together."""
    part = lambda i: F.regexp_extract(name, r"^ATL\d\d_(\d{14})_(\d{8})_(\d{3})_(\d{2})", i)
    return F.struct(part(1).cast("bigint").alias("id1"), F.concat(part(2), part(3), part(4)).cast("bigint").alias("id2"))


def granule_name(id1: Column, id2: Column, product: str = "ATL03") -> Column:
    """S4 back: the name from its two numbers, zero padded."""
    tail = F.lpad(id2.cast("string"), 13, "0")
    return F.concat(
        F.lit(f"{product}_"), F.lpad(id1.cast("string"), 14, "0"), F.lit("_"), F.substring(tail, 1, 8), F.lit("_"), F.substring(tail, 9, 3), F.lit("_"),
        F.substring(tail, 12, 2), F.lit(".h5"),
    )


def granule_version(name: Column) -> Column:
    """The release number of a granule name."""
    return F.regexp_extract(name, r"_(\d{3})_\d{2}(?:\.h5)?$", 1).cast("int")


def other_product(name: Column) -> Column:
    """ATL03 for ATL08 and back; a name with neither raises."""
    return (
        F.when(name.contains("ATL03"), F.replace(name, F.lit("ATL03"), F.lit("ATL08")))
        .when(name.contains("ATL08"), F.replace(name, F.lit("ATL08"), F.lit("ATL03")))
        .otherwise(F.raise_error(F.concat(F.lit("no product in "), name)).cast("string"))
    )


#: Beams in order of their codes.
BEAMS = ["gt1l", "gt1r", "gt2l", "gt2r", "gt3l", "gt3r"]


def beam_code(name: Column) -> Column:
    """0 to 5, null for other names."""
    at = F.array_position(F.array(*map(F.lit, BEAMS)), F.lower(name))
    return F.when(at > 0, (at - 1).cast("int"))


def beam_name(code: Column) -> Column:
    """S6 back."""
    return F.get(F.array(*map(F.lit, BEAMS)), code.cast("int"))


def _lon(x: Column) -> Column:
    return F.concat(F.when(x < 0, "W").otherwise("E"), F.lpad(F.abs(x).cast("int").cast("string"), 3, "0"))


def bin_suffix(x: Column, width: int) -> Column:
    """``_W012_W010`` for the longitude bin that holds x."""
    low = F.floor(x / width) * width
    return F.concat(F.lit("_"), _lon(low), F.lit("_"), _lon(low + width))


def release_name(name: Column, size: Column) -> Column:
    """A south-west corner name as a north-west one, without its date stamp.

    Names with ``_w`` before the suffix give null.
    """
    at = tag_corner(name)
    north = at["y"] + size
    moved = F.regexp_replace(name, r"[NS]\d{2}[EW]\d{3}", "@")
    clean = F.regexp_replace(moved, r"_\d{4}\.\d{2}\.\d{2}", "")
    return F.when(~name.rlike(r"_w\.tif$"), F.replace(clean, F.lit("@"), tile_tag(north, at["x"])))


def release_path(name: Column) -> Column:
    """Where a finished tile goes in a release, by its file name; null for what is not released.

    Weights (``_w``), tiles of 1 arc-second, ids (``_sid``) of 30 and 60 arc-seconds
    and other files than .tif and .nc are not. Tags move to the north-west corner,
    date stamps go, and surface tiles are called so.
    """
    seconds = F.regexp_extract(name, r"_(\d{1,2})s_", 1).try_cast("int")
    kind = F.when(name.endswith(".tif"), "gtif").when(name.endswith(".nc"), "netcdf")
    bed, sid, geoid = name.contains("_bed"), name.contains("_sid"), name.contains("_geoid")
    tag = F.regexp_extract(name, r"_([NS]\d{2}[EW]\d{3})[_.]", 1)
    at = tag_corner(tag)
    moved = F.replace(name, tag, F.when(seconds == 15, tile_tag(at["y"] + 15, at["x"])).otherwise(F.lit("N90W180")))
    clean = F.regexp_replace(moved, r"_\d{4}\.\d{2}\.\d{2}", "")
    named = F.when(bed | geoid, clean).otherwise(F.regexp_replace(clean, r"(_sid)?(\.tif|\.nc)$", "_surface$1$2"))
    what = F.concat(F.when(geoid, "geoid").when(bed, "bed").otherwise("surface"), F.when(geoid, "").when(sid, "_sid").otherwise("_elev"))
    width = F.concat(seconds.cast("string"), F.lit("s"))
    path = F.concat(kind, F.lit("/"), width, F.lit("/"), width, F.lit("_"), what, F.lit("_"), kind, F.lit("/"), named)
    return F.when(~name.rlike(r"_w[_.]") & seconds.isin(15, 30, 60) & ~(sid & (seconds > 15)), path)


def chart_name(y: Column, x: Column, year: int, version: int = 1) -> Column:
    """``ncei1_n46x00_w125x00_2022v1`` from the north-west corner."""
    h = F.format_string("%s%02dx%02d", F.when(y < 0, "s").otherwise("n"), F.floor(F.abs(y)).cast("int"), ((F.abs(y) % 1) * 100).cast("int"))
    v = F.format_string("%s%03dx%02d", F.when(x < 0, "w").otherwise("e"), F.floor(F.abs(x)).cast("int"), ((F.abs(x) % 1) * 100).cast("int"))
    return F.concat(F.lit("ncei1_"), h, F.lit("_"), v, F.lit(f"_{year}v{version}"))


def dated(name: Column, day: Column) -> Column:
    """A date stamp before the suffix."""
    return F.concat(F.regexp_extract(name, r"^(.*)(\.[^.]+)$", 1), F.lit("_"), F.date_format(day, "yyyy.MM.dd"), F.regexp_extract(name, r"(\.[^.]+)$", 1))


def date_stamp(name: Column) -> Column:
    """The last date stamp of a name, null without one."""
    return F.nullif(F.regexp_extract(name, r"_(\d{4}\.\d{2}\.\d{2})(?!.*_\d{4}\.\d{2}\.\d{2})", 1), F.lit(""))


def datalist_line(path: Column, weight: Column) -> Column:
    """``path 200 weight``."""
    return F.concat_ws(" ", path, F.lit("200"), weight.cast("string"))


def parse_datalist(line: Column) -> Column:
    """S11 back: path, format and weight; fewer than three fields give nulls."""
    parts = F.split(F.trim(line), r"\s+")
    return F.struct(F.get(parts, 0).alias("path"), F.get(parts, 1).try_cast("int").alias("format"), F.get(parts, 2).try_cast("double").alias("weight"))


def region_number(granule: Column) -> Column:
    """The orbit region of a granule name, the last two digits of its track field."""
    return F.regexp_extract(granule, r"_\d{6}(\d{2})_\d{3}_\d{2}", 1).try_cast("int")
