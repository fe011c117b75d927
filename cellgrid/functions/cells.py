"""Column expressions of the cell table: grid geometry, quality bits, band arithmetic, classes, colours, radiation."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    """A grid of rows from the north and columns from the west, in degrees."""

    north: float
    west: float
    step: float
    rows: int
    cols: int

    def lat(self, row: Column) -> Column:
        return F.lit(self.north) - (row + 0.5) * self.step

    def lon(self, col: Column) -> Column:
        return F.lit(self.west) + (col + 0.5) * self.step

    def area_m2(self, row: Column) -> Column:
        """Metres of a degree of latitude and, at the cell's latitude, of longitude (fixed values)."""
        return F.lit(self.step * 110574.0) * (self.step * 111320.0 * F.cos(F.radians(self.lat(row))))

    def row_of(self, lat: Column) -> Column:
        """Null outside the grid."""
        row = F.floor((F.lit(self.north) - lat) / self.step)
        return F.when(row.between(0, self.rows - 1), row)

    def col_of(self, lon: Column) -> Column:
        col = F.floor((lon - F.lit(self.west)) / self.step)
        return F.when(col.between(0, self.cols - 1), col)

    def cell_id(self, row: Column, col: Column) -> Column:
        return row * self.cols + col


def passes_quality(flags: Column, mask: int | Column) -> Column:
    """Some flag is set, and none of the mask's."""
    return (flags != 0) & (flags.bitwiseAND(mask) == 0)


def thermal_celsius(number: Column, valid: Column) -> Column:
    """Surface temperature from a thermal band's stored numbers (scale and offset are fixed values)."""
    return F.when(valid & (number != 0), number * 0.00341802 + 149.0 - 273.15)


def ratio_index(near: Column, red: Column) -> Column:
    """(near - red) / (near + red) of reflectances in (0, 1]; null elsewhere."""
    good = (near > 0) & (near <= 1) & (red > 0) & (red <= 1)
    return F.when(good, F.try_divide(near - red, near + red))


def censored_index(near: Column, red: Column, least: int = 1, scale: int = 10_000) -> Column:
    """The same of stored numbers above least, clipped to [-1, 1], as an integer by scale."""
    value = F.try_divide(near - red, near + red)
    clipped = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value))
    return F.when((near > least) & (red > least) & value.isNotNull(), F.bround(clipped * scale).cast("int"))


def platform_band(platform: Column, newer: Sequence[str], new: tuple[str, int], old: tuple[str, int]) -> tuple[Column, Column]:
    """Name of the thermal band and quality mask of an item, by the set of platforms it belongs to."""
    is_new = platform.isin(*newer)
    return F.when(is_new, new[0]).otherwise(old[0]), F.when(is_new, new[1]).otherwise(old[1])


def item_used(tier: Column, wanted: str, platform: Column, without: Sequence[str], day: Column, since: str) -> Column:
    """Items of one tier, not of some platforms, from a day on."""
    return (tier == wanted) & ~platform.isin(*without) & (day >= F.lit(since).cast("timestamp_ntz"))


def hazard_class(height: Column, height_major: Column, distance: Column, low: float, mid: float, high: float, reach: float, near: float) -> Column:
    """0 to 3; the last rule that holds wins: low, then middle height, then a floor near the river, then the major river."""
    return (
        F.when((height_major <= high) & (distance <= reach), 3)
        .when((distance <= near) | (height <= mid), 2)
        .when(height <= low, 1)
        .otherwise(0)
    )


def band(value: Column, cuts: Sequence[float | Column], names: Sequence[str]) -> Column:
    """The name of the band that value lies in: names has one more than cuts, which are inclusive from below."""
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for cut, name in reversed(list(zip(cuts, names[1:], strict=True))):
        out = out.when(value >= cut, name)
    return out.otherwise(names[0])


def colour(value: Column, low: float, high: float, palette: Sequence[tuple[int, int, int]]) -> Column:
    """array of red, green, blue: linear between the palette's colours; null for null."""
    place = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (value - low) / (high - low))) * (len(palette) - 1)
    left = F.least(F.floor(place), F.lit(len(palette) - 2))
    part = place - left

    def channel(k: int) -> Column:
        tones = F.array(*[F.lit(float(c[k])) for c in palette])
        a, b = F.get(tones, left.cast("int")), F.get(tones, (left + 1).cast("int"))
        return F.round(a + (b - a) * part).cast("int")

    return F.when(value.isNotNull(), F.array(*map(channel, range(3))))


def encode_layer(value: Column, scale: float, offset: float) -> Column:
    """16-bit code: 0 for no data, else the scaled value in 1..65535."""
    code = F.round((value - offset) / scale) + 1
    return F.when(value.isNull() | F.isnan(value), 0).otherwise(F.least(F.lit(65535), F.greatest(F.lit(1), code))).cast("int")


def decode_layer(code: Column, scale: float, offset: float) -> Column:
    return F.when(code != 0, (code - 1) * F.lit(scale) + offset)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a, b = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(a), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(b), 2)
    return 2 * 6371.0 * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def cos_zenith(day_of_year: Column, hour_utc: Column, lat: Column, lon: Column) -> Column:
    """Cosine of the sun's zenith angle by the Fourier series of declination and equation of time (fixed values)."""
    g = 2 * math.pi / 365 * (day_of_year - 1 + (hour_utc - 12) / 24)
    declination = 0.006918 - 0.399912 * F.cos(g) + 0.070257 * F.sin(g) - 0.006758 * F.cos(2 * g) + 0.000907 * F.sin(2 * g)
    minutes = 229.18 * (0.000075 + 0.001868 * F.cos(g) - 0.032077 * F.sin(g) - 0.014615 * F.cos(2 * g) - 0.040849 * F.sin(2 * g))
    angle = F.radians((hour_utc * 60 + minutes + 4 * lon) / 4 - 180)
    return F.sin(F.radians(lat)) * F.sin(declination) + F.cos(F.radians(lat)) * F.cos(declination) * F.cos(angle)


def clear_sky(cosine: Column) -> Column:
    """Clear-sky radiation in W/m2 from the cosine of the zenith angle."""
    return F.when(cosine > 0.01, 1098 * cosine * F.exp(-0.057 / cosine)).otherwise(0.0)


def significant(value: Column, figures: int = 3) -> Column:
    """Rounded to so many significant figures."""
    digits = F.lit(figures - 1) - F.floor(F.log10(F.abs(value)))
    unit = F.pow(F.lit(10.0), digits)
    return F.when(value == 0, 0.0).otherwise(F.round(value * unit) / unit)


def class_weight(kind: Column, access: Column, weights: Mapping[str, float]) -> Column:
    """Weight of a road class; a link has that of its class; private ways and unknown classes have none."""
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    return F.when(access.eqNullSafe(F.lit("no")), 0.0).otherwise(F.coalesce(F.try_element_at(table, F.regexp_replace(kind, "_link$", "")), F.lit(0.0)))


def let(value: Column, body) -> Column:
    """body(value) with the value worked out once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def utm(lat: Column, lon: Column, meridian: float, north: bool = True) -> tuple[Column, Column]:
    """Easting and northing in metres on WGS84 by the Krueger series (third order in the flattening; fixed values)."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    n = f / (2 - f)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    phi, lam = F.radians(lat), F.radians(lon - meridian)
    e = 2 * math.sqrt(n) / (1 + n)
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
    ball = let(F.struct(t.alias("t"), lam.alias("l")), lambda s: F.struct(F.atan2(s["t"], F.cos(s["l"])).alias("xi"), F.atanh(F.sin(s["l"]) / F.sqrt(1 + s["t"] * s["t"])).alias("eta")))

    def flat(s: Column) -> Column:
        x, y = s["eta"], s["xi"]
        for j, c in enumerate(alpha, 1):
            x = x + c * F.cos(2 * j * s["xi"]) * F.sinh(2 * j * s["eta"])
            y = y + c * F.sin(2 * j * s["xi"]) * F.cosh(2 * j * s["eta"])
        return F.struct((F.lit(500_000.0) + k0 * radius * x).alias("x"), (k0 * radius * y + F.lit(0.0 if north else 10_000_000.0)).alias("y"))

    made = let(ball, flat)
    return made["x"], made["y"]


def from_utm(x: Column, y: Column, meridian: float, north: bool = True) -> tuple[Column, Column]:
    """Latitude and longitude in degrees of an easting and northing: the series of utm the other way (fixed values)."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    n = f / (2 - f)
    radius = k0 * a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    start = F.struct(((y - F.lit(0.0 if north else 10_000_000.0)) / radius).alias("xi"), ((x - F.lit(500_000.0)) / radius).alias("eta"))

    def ball(s: Column) -> Column:
        up, across = s["xi"], s["eta"]
        for j, c in enumerate(beta, 1):
            up = up - c * F.sin(2 * j * s["xi"]) * F.cosh(2 * j * s["eta"])
            across = across - c * F.cos(2 * j * s["xi"]) * F.sinh(2 * j * s["eta"])
        return F.struct(up.alias("u"), across.alias("v"))

    def degrees(s: Column) -> Column:
        lon = F.lit(meridian) + F.degrees(F.atan2(F.sinh(s["v"]), F.cos(s["u"])))
        return F.struct(F.asin(F.sin(s["u"]) / F.cosh(s["v"])).alias("chi"), lon.alias("lon"))

    def latitude(s: Column) -> Column:
        lat = s["chi"]
        for j, c in enumerate(delta, 1):
            lat = lat + c * F.sin(2 * j * s["chi"])
        return F.struct(F.degrees(lat).alias("lat"), s["lon"].alias("lon"))

    made = let(let(let(start, ball), degrees), latitude)
    return made["lat"], made["lon"]


def inside_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd rule on an array of struct<x, y>; the ring closes itself."""
    n = F.size(ring)

    def crosses(i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, F.pmod(i + 1, n))
        at = (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"]
        return F.when(((a["y"] > y) != (b["y"] > y)) & (x < at), 1).otherwise(0)

    steps = F.transform(F.sequence(F.lit(0), n - 1), crosses)
    return F.aggregate(steps, F.lit(0), lambda s, v: s + v) % 2 == 1


def segment_distance(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance of a point to a segment in the plane."""
    dx, dy = x2 - x1, y2 - y1
    t = F.coalesce(F.try_divide((x - x1) * dx + (y - y1) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    return F.hypot(x - x1 - t * dx, y - y1 - t * dy)
