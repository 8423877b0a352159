"""Pure Column -> Column functions. Bad input gives null, never an error, also in ANSI mode."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "air_key", "basename", "bbox_overlap", "bbox_wkt", "blank_to_null", "change_parts", "clamp", "clean", "coverage_pct", "date_range",
    "decimal_comma", "default", "display_parameter", "finite", "human_bytes", "iso_utc", "list_items", "lonlat_to_sinusoidal", "lonlat_to_utm", "masked", "nan_to_null", "parent_folder", "parse_date",
    "parse_time", "polygon_holds", "product_key", "rings_meet", "safe_bigint", "safe_double", "sanitized", "sinusoidal_to_lonlat", "stem", "tile_address", "utm_to_lonlat", "weather_key",
]


def clean(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    """Null for blank text and for the text nan, which is how a missing number is written."""
    text = clean(c)
    return F.when((text != "") & (F.lower(text) != "nan"), text)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def finite(c: Column) -> Column:
    """Whether a number is there and neither NaN nor infinite."""
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def safe_double(c: Column) -> Column:
    return nan_to_null(blank_to_null(c.cast("string")).try_cast("double"))


def safe_bigint(c: Column) -> Column:
    """Also from the text of a float; its fraction is cut off."""
    return safe_double(c).try_cast("bigint")


def default(c: Column, *others) -> Column:
    """c, or where it is null, empty or 0 the first of others."""
    text = c.cast("string")
    return F.coalesce(F.when((text != "") & ~text.rlike(r"^-?0+(\.0+)?$"), c), *(o if isinstance(o, Column) else F.lit(o) for o in others))


def parse_date(c: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.try_to_timestamp(c, F.lit(pattern)).cast("date")


def parse_time(c: Column, pattern: str | None = None) -> Column:
    """ISO text (with T or a blank, with or without an offset) or text of a pattern; in the session's zone, UTC."""
    return F.try_to_timestamp(c, F.lit(pattern)) if pattern else F.try_to_timestamp(c)


def iso_utc(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def date_range(first: Column, last: Column) -> Column:
    """All days from first to last, both included; none where last is before first."""
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))


def decimal_comma(c: Column) -> Column:
    return F.replace(clean(c), F.lit(","), F.lit(".")).try_cast("double")


def change_parts(c: Column) -> Column:
    """struct(change, pct) of texts like -0,6(-2,44 %)."""
    part = lambda i: decimal_comma(F.regexp_extract(c, r"^\s*([+-]?[0-9]+(?:,[0-9]+)?)\s*\(\s*([+-]?[0-9]+(?:,[0-9]+)?)\s*%\s*\)", i))
    return F.struct(part(1).alias("change"), part(2).alias("pct"))


def coverage_pct(observed: Column, expected: Column) -> Column:
    """Observed over expected, at least 1, in percent with one digit; halves are rounded up."""
    return F.round(F.coalesce(observed, F.lit(0)) / F.greatest(F.coalesce(expected, F.lit(1)), F.lit(1)) * 100, 1)


def clamp(c: Column, low: float, high: float, missing: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.coalesce(c, F.lit(missing)), F.lit(high)))


def masked(value: Column, fill: Column | float | None = None, qa: Column | None = None, qa_least: float = 0.5, low: float | None = None, high: float | None = None, floor: float = -1e30) -> Column:
    """value, or null where it is NaN, the fill value, under floor, of a quality under qa_least, or out of low..high.

    A null quality doesn't mask.
    """
    out = F.when(~F.isnan(value) & (value >= floor), value)
    out = F.nullif(out, fill if isinstance(fill, Column) else F.lit(fill)) if fill is not None else out
    out = F.when(F.coalesce(qa < qa_least, F.lit(False)), None).otherwise(out) if qa is not None else out
    return F.when(out.between(low, high), out) if low is not None else out


def human_bytes(c: Column) -> Column:
    """A size with a unit: 512 B, 1.5 KB, 2.0 MB, up to TB."""
    out = F.format_string("%d B", c)
    for power, unit in enumerate(("KB", "MB", "GB", "TB"), 1):
        out = F.when(c >= 1024**power, F.format_string(f"%.1f {unit}", c / float(1024**power))).otherwise(out)
    return F.when(c.isNotNull(), out)


def list_items(c: Column) -> Column:
    """The items of a comma list, trimmed, without blank ones."""
    return F.filter(F.transform(F.split(c, ","), clean), lambda x: x != "")


def display_parameter(c: Column) -> Column:
    """pm25 -> PM2.5, others in upper case."""
    return F.replace(F.upper(c), F.lit("PM25"), F.lit("PM2.5"))


def sanitized(c: Column) -> Column:
    """A file name of letters, digits, hyphens, underscores and dots."""
    return F.regexp_replace(c, r"[^\p{L}\p{N}\-_.]", "_")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(basename(path), r"\.[^.]*$", "")


def parent_folder(path: Column) -> Column:
    """The name of the folder that holds a file, blanks for underscores; null where there is none."""
    return F.replace(F.try_element_at(F.split(path, "/"), F.lit(-2)), F.lit("_"), F.lit(" "))


def weather_key(province: Column, time: Column) -> Column:
    return F.concat(province, F.lit("_"), time)


def air_key(location: Column, sensor: Column, parameter: Column, time: Column, prefix: str = "openaq") -> Column:
    """Null where any part is: such rows can't be told apart."""
    return F.concat(F.lit(prefix), *(F.concat(F.lit("_"), c.cast("string")) for c in (location, sensor, parameter, time)))


def product_key(product: Column, id_: Column, start: Column, end: Column, prefix: str = "s5p") -> Column:
    return F.replace(F.concat(F.lit(prefix), *(F.concat(F.lit("_"), c) for c in (product, id_, start, end))), F.lit(" "), F.lit(""))


def bbox_wkt(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A closed ring, from the lower left corner against the clock."""
    point = lambda x, y: F.concat_ws(" ", x.cast("string"), y.cast("string"))
    return F.concat(F.lit("POLYGON(("), F.concat_ws(", ", point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0)), F.lit("))"))


def bbox_overlap(a: tuple, b: tuple) -> Column:
    """Whether boxes (x0, y0, x1, y1) have a point in common, borders included."""
    return (a[0] <= b[2]) & (b[0] <= a[2]) & (a[1] <= b[3]) & (b[1] <= a[3])


def polygon_holds(ring: Column, x: Column, y: Column) -> Column:
    """Whether a point lies in a ring of points [x, y], by the even-odd rule; the ring may be open or closed."""
    after = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))

    def crosses(edge: Column) -> Column:
        ax, ay, bx, by = edge["p"][0], edge["p"][1], edge["q"][0], edge["q"][1]
        return F.when(((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / F.nullif(by - ay, F.lit(0.0)) + ax), 1).otherwise(0)

    edges = F.arrays_zip(ring.alias("p"), after.alias("q"))
    return F.aggregate(edges, F.lit(0), lambda n, e: n + crosses(e)) % 2 == 1


def _edges(ring: Column) -> Column:
    return F.arrays_zip(ring.alias("p"), F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1)).alias("q"))


def _turn(p: Column, q: Column, r: Column) -> Column:
    return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])


def _cross(a: Column, b: Column) -> Column:
    """Whether two edges have a point in common, ends included."""
    near = lambda i: (F.least(a["p"][i], a["q"][i]) <= F.greatest(b["p"][i], b["q"][i])) & (F.least(b["p"][i], b["q"][i]) <= F.greatest(a["p"][i], a["q"][i]))
    sides = lambda s, t: _turn(s["p"], s["q"], t["p"]) * _turn(s["p"], s["q"], t["q"]) <= 0
    return near(0) & near(1) & sides(a, b) & sides(b, a)


def rings_meet(a: Column, b: Column) -> Column:
    """Whether two polygons, given by their rings of points [x, y], have a point in common, borders included."""
    touch = F.exists(_edges(a), lambda x: F.exists(_edges(b), lambda y: _cross(x, y)))
    return touch | polygon_holds(a, b[0][0], b[0][1]) | polygon_holds(b, a[0][0], a[0][1])


def sinusoidal_to_lonlat(x: Column, y: Column, radius: float = 6371007.181) -> Column:
    """struct(lon, lat) in degrees of a sinusoidal projection on a sphere."""
    lat = y / radius
    return F.struct(F.degrees(x / (F.lit(radius) * F.cos(lat))).alias("lon"), F.degrees(lat).alias("lat"))


def lonlat_to_sinusoidal(lon: Column, lat: Column, radius: float = 6371007.181) -> Column:
    """struct(x, y): sinusoidal_to_lonlat the other way."""
    phi = F.radians(lat)
    return F.struct((F.lit(radius) * F.radians(lon) * F.cos(phi)).alias("x"), (F.lit(radius) * phi).alias("y"))


#: Fixed values of the sinusoidal tile grid: 36 columns of 18 rows of tiles, each so many metres wide.
TILE, TILES_X, TILES_Y = 1111950.5196666666, 36, 18


def tile_address(lon: Column, lat: Column, cells: int) -> Column:
    """struct(h, v, row, col): the tile of the sinusoidal grid that holds a position, and the cell of its cells x cells; null outside."""
    at = lonlat_to_sinusoidal(lon, lat)
    x, y = at["x"] / TILE + TILES_X / 2, F.lit(TILES_Y / 2) - at["y"] / TILE
    h, v = F.floor(x), F.floor(y)
    cell = lambda value, tile: F.floor((value - tile) * cells).cast("int")
    inside = h.between(0, TILES_X - 1) & v.between(0, TILES_Y - 1)
    return F.when(inside, F.struct(h.cast("int").alias("h"), v.cast("int").alias("v"), cell(y, v).alias("row"), cell(x, h).alias("col")))


#: Fixed values of the WGS 84 ellipsoid and of the universal transverse Mercator projection.
_AXIS, _FLATTENING, _SCALE, _EAST, _NORTH = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0, 10000000.0
_N = _FLATTENING / (2 - _FLATTENING)
_RADIUS = _SCALE * _AXIS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def _series(factors: tuple[float, ...], term) -> Column:
    return reduce(lambda a, b: a + b, (F.lit(f) * term(2.0 * j) for j, f in enumerate(factors, 1)))


def lonlat_to_utm(lon: Column, lat: Column, zone: Column | int) -> Column:
    """struct(x, y) in metres of a transverse Mercator zone, by series in the third flattening; y of the south counts from 10,000 km."""
    zone = zone if isinstance(zone, Column) else F.lit(zone)
    phi, away = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    e = 2 * _N**0.5 / (1 + _N)
    t = F.sinh(F.atanh(F.sin(phi)) - F.lit(e) * F.atanh(F.lit(e) * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(away)), F.atanh(F.sin(away) / F.sqrt(1 + t * t))
    x = F.lit(_EAST) + F.lit(_RADIUS) * (eta + _series(_ALPHA, lambda j: F.cos(xi * j) * F.sinh(eta * j)))
    y = F.when(lat < 0, _NORTH).otherwise(0.0) + F.lit(_RADIUS) * (xi + _series(_ALPHA, lambda j: F.sin(xi * j) * F.cosh(eta * j)))
    return F.struct(x.alias("x"), y.alias("y"))


def utm_to_lonlat(x: Column, y: Column, zone: Column | int, south: Column | bool = False) -> Column:
    """struct(lon, lat) in degrees: lonlat_to_utm the other way."""
    zone, south = (c if isinstance(c, Column) else F.lit(c) for c in (zone, south))
    xi, eta = (y - F.when(south, _NORTH).otherwise(0.0)) / _RADIUS, (x - _EAST) / _RADIUS
    a = xi - _series(_BETA, lambda j: F.sin(xi * j) * F.cosh(eta * j))
    b = eta - _series(_BETA, lambda j: F.cos(xi * j) * F.sinh(eta * j))
    chi = F.asin(F.sin(a) / F.cosh(b))
    phi = chi + _series(_DELTA, lambda j: F.sin(chi * j))
    return F.struct((F.degrees(F.atan2(F.sinh(b), F.cos(a))) + (zone * 6 - 183)).alias("lon"), F.degrees(phi).alias("lat"))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
