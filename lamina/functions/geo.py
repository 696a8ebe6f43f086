"""Coordinates: envelope cleaning, point construction, radius search and radius join."""

from __future__ import annotations

import math

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions.cleaning import parse_float, strip_blank
from lamina.session import PARTITIONS

# Envelope of the country (degrees) and the WGS84 identifier.
LATITUDE_RANGE = (-35.0, 6.0)
LONGITUDE_RANGE = (-75.0, -33.0)
SRID = 4326

EARTH_RADIUS_M = 6_371_008.8
EQUATOR_RADIUS_M = 6_378_137.0
FLATTENING = 1 / 298.257223563
# The least radius of curvature (north to south at the equator): no angle between two
# points is larger than their distance over this.
LEAST_RADIUS_M = EQUATOR_RADIUS_M * (1 - FLATTENING) ** 2
CROWD = 4_096  # points and centres of one cell that are compared as one block
TASK_PAIRS = 2 * CROWD * CROWD  # pairs that one task compares, or so
ZERO_TOLERANCE = 1e-6


def within_envelope(degrees: str, low: float, high: float) -> str:
    """NULL for a placeholder near zero or a value outside ``[low, high]``."""
    return (
        f"if(abs({degrees}) >= {ZERO_TOLERANCE!r}D AND {degrees} BETWEEN {low!r}D AND {high!r}D,"
        f" {degrees}, NULL)"
    )


def coordinate(value: str, low: float, high: float) -> str:
    """Decimal-point string to degrees."""
    return within_envelope(parse_float(value), low, high)


def coordinate_decimal_comma(value: str, low: float, high: float) -> str:
    """Decimal-comma string, possibly padded with blanks, to degrees."""
    return coordinate(f"translate({strip_blank(value)}, ',', '.')", low, high)


def point(longitude: str, latitude: str) -> str:
    """``struct<srid,lon,lat>``, NULL unless both coordinates are present."""
    return (
        f"if({longitude} IS NOT NULL AND {latitude} IS NOT NULL,"
        f" named_struct('srid', {SRID}, 'lon', {longitude}, 'lat', {latitude}), NULL)"
    )


def point_wkt(longitude: str, latitude: str) -> str:
    """The point as EWKT text, NULL unless both coordinates are present."""
    return f"concat('SRID={SRID};POINT(', {longitude}, ' ', {latitude}, ')')"


def great_circle_m(
    longitude: str, latitude: str, other_longitude: str, other_latitude: str
) -> str:
    """Haversine distance in metres."""
    half_lat = f"radians({other_latitude} - {latitude}) / 2"
    half_lon = f"radians({other_longitude} - {longitude}) / 2"
    chord = (
        f"pow(sin({half_lat}), 2) + cos(radians({latitude})) * cos(radians({other_latitude}))"
        f" * pow(sin({half_lon}), 2)"
    )
    return f"({2 * EARTH_RADIUS_M!r}D * asin(sqrt(least({chord}, 1D))))"


def within_radius(
    df: DataFrame,
    longitude: float,
    latitude: float,
    metres: float,
    *,
    lon_column: str = "nu_longitude",
    lat_column: str = "nu_latitude",
    distance_column: str = "distance_m",
) -> DataFrame:
    """Rows within ``metres`` of one centre.

    A bounding box of plain comparisons comes first, so that Parquet statistics
    can skip row groups; the distance is computed on what is left. Where the
    box would touch a pole or the antimeridian it covers every longitude.
    """
    d_lat = math.degrees(metres / EARTH_RADIUS_M) * 1.000001
    box = F.col(lat_column).between(latitude - d_lat, latitude + d_lat)
    widest = max(abs(latitude - d_lat), abs(latitude + d_lat))
    if widest < 90.0:
        reach = math.sin(metres / (2 * EARTH_RADIUS_M)) / math.cos(math.radians(widest))
        d_lon = math.degrees(2 * math.asin(min(1.0, reach))) * 1.000001
        if longitude - d_lon >= -180.0 and longitude + d_lon <= 180.0:
            box = box & F.col(lon_column).between(longitude - d_lon, longitude + d_lon)
    distance = great_circle_m(
        f"{float(longitude)!r}D", f"{float(latitude)!r}D", lon_column, lat_column
    )
    return (
        df.where(box)
        .withColumn(distance_column, F.expr(distance))
        .where(F.col(distance_column) <= float(metres))
    )


def spheroid_m(longitude: str, latitude: str, other_longitude: str, other_latitude: str) -> str:
    """Distance on the WGS84 spheroid in metres, by the first-order formula in its flattening.

    What it leaves out is of the flattening's square, about a metre in 100 km.
    Points that are (nearly) opposite each other get the spherical value.
    """
    mean, half = f"radians({latitude} + {other_latitude}) / 2", f"radians({latitude} - {other_latitude}) / 2"
    turn = f"radians({longitude} - {other_longitude}) / 2"
    # Squares of the sine and the cosine of half the angle between the points.
    s = (
        f"(pow(sin({half}), 2) * pow(cos({turn}), 2) + pow(cos({mean}), 2) * pow(sin({turn}), 2))"
    )
    c = (
        f"(pow(cos({half}), 2) * pow(cos({turn}), 2) + pow(sin({mean}), 2) * pow(sin({turn}), 2))"
    )
    w = f"atan(sqrt({s} / {c}))"
    r = f"(sqrt({s} * {c}) / {w})"
    by_mean = f"(3 * {r} - 1) / (2 * {c}) * pow(sin({mean}), 2) * pow(cos({half}), 2)"
    by_half = f"(3 * {r} + 1) / (2 * {s}) * pow(cos({mean}), 2) * pow(sin({half}), 2)"
    return (
        f"(CASE WHEN {s} = 0D THEN 0D WHEN {c} < 1e-9D THEN {2 * EARTH_RADIUS_M!r}D * asin(sqrt(least({s}, 1D)))"
        f" ELSE 2 * {w} * {EQUATOR_RADIUS_M!r}D * (1 + {FLATTENING!r}D * ({by_mean} - {by_half})) END)"
    )


class Cells:
    """Grid whose cells are at least as wide as a radius, so that a circle meets few of them.

    The sphere is cut into bands of latitude as high as the radius, and each
    band into equal cells of longitude, as many as fit around it where it is
    narrowest among the places a circle that reaches it can have; a band at a
    pole is one cell. Longitudes wrap, so the antimeridian is no border.
    """

    def __init__(self, metres: float) -> None:
        if not 0 < metres < math.inf:
            raise ValueError("the radius must be positive")
        reach = math.degrees(metres / LEAST_RADIUS_M) * 1.0001
        self.bands = max(1, int(180.0 / reach))
        self.height = 180.0 / self.bands

    def band(self, latitude: str) -> str:
        return f"least(greatest(int(floor(({latitude} + 90D) / {self.height!r}D)), 0), {self.bands - 1})"

    def around(self, band: str) -> str:
        """Cells of a band: 1 near the poles, else as many as the radius fits around it.

        Of two points within the radius, one of them in this band, neither lies
        beyond the next band; there their longitudes differ by no more than a cell.
        """
        widest = f"({self.height!r}D * (abs({band} - {(self.bands - 1) / 2!r}D) + 1.5D))"
        sine = f"(sin(radians({self.height / 2!r}D)) / cos(radians(least({widest}, 89.999D))))"
        width = f"degrees(2 * asin(least({sine}, 1D)))"
        return f"if({widest} >= 90D, 1, greatest(1, int(floor(360D / ({width} * 1.000001D)))))"

    def turn(self, longitude: str, band: str) -> str:
        share = f"(pmod({longitude} + 180D, 360D) / 360D)"
        return f"least(int(floor({share} * {self.around(band)})), {self.around(band)} - 1)"

    def key(self, longitude: str, latitude: str) -> str:
        """The one cell of a point, as ``band << 32 | turn``."""
        band = self.band(latitude)
        return f"(shiftleft(bigint({band}), 32) + {self.turn(longitude, f'({band})')})"

    def keys(self, longitude: str, latitude: str) -> str:
        """Array of the cells that hold all points within the radius of a centre: nine at most."""
        band = f"({self.band(latitude)})"
        bands = f"sequence(greatest({band} - 1, 0), least({band} + 1, {self.bands - 1}))"
        turns = f"transform(sequence(-1, 1), d -> pmod({self.turn(longitude, 'b')} + d, {self.around('b')}))"
        cells = f"transform(array_distinct({turns}), t -> shiftleft(bigint(b), 32) + t)"
        return f"flatten(transform({bands}, b -> {cells}))"


def radius_join(
    points: DataFrame,
    centres: DataFrame,
    metres: float,
    *,
    point_at: Sequence[str] = ("nu_longitude", "nu_latitude"),
    centre_at: Sequence[str] = ("longitude", "latitude"),
    distance_column: str = "distance_m",
) -> DataFrame:
    """Every pair of a centre and a point within ``metres`` on the spheroid, with its distance.

    Columns are those of the centre, those of the point and the distance; a name
    on both sides is an error. Rows without a whole, finite position on the
    globe (longitudes -180 to 180) meet nothing. Repeated rows give repeated pairs.

    It is an equi-join on cells (:class:`Cells`): a point is in one cell, a
    centre in nine at most, and neither side is broadcast but by its size. A
    cell with more than ``CROWD`` points or centres is cut into blocks of about
    so many of each, by the hash of the row. (Equal rows have one share, which
    adaptive execution splits where it has to.) The work goes with the pairs and
    not with the bytes, so the tasks are as many as the pairs that the cells
    hold ask for; these are counted first.
    """
    clash = set(points.columns) & set(centres.columns) | ({distance_column} & {*points.columns, *centres.columns})
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    cells = Cells(metres)

    def placed(df: DataFrame, at: Sequence[str], side: str) -> DataFrame:
        lon, lat = (F.col(c).cast("double") for c in at)
        row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(side)
        rows = df.select(row, lon.alias(f"{side}_lon"), lat.alias(f"{side}_lat"))
        return rows.where(f"{side}_lon BETWEEN -180D AND 180D AND {side}_lat BETWEEN -90D AND 90D")

    def ball(lon: str, lat: str) -> list[Column]:
        """The place on the unit sphere."""
        places = f"cos(radians({lat})) * cos(radians({lon}))", f"cos(radians({lat})) * sin(radians({lon}))", f"sin(radians({lat}))"
        return [F.expr(e).alias(f"{lon[0]}_{axis}") for axis, e in zip("xyz", places)]

    p = placed(points, point_at, "p").withColumn("cell", F.expr(cells.key("p_lon", "p_lat")))
    c = placed(centres, centre_at, "c").withColumn("cell", F.explode(F.expr(cells.keys("c_lon", "c_lat"))))
    held = p.groupBy("cell").agg(F.count("*").alias("points")).join(
        c.groupBy("cell").agg(F.count("*").alias("centres")), "cell"
    )
    pairs = held.agg(F.sum(F.col("points").cast("double") * F.col("centres"))).first()[0] or 0.0
    shares = [F.ceil(F.col(n) / CROWD).cast("int").alias(f"{n}_shares") for n in ("points", "centres")]
    crowded = held.where((F.col("points") > CROWD) | (F.col("centres") > CROWD)).select("cell", *shares)
    block = ["cell", "p_share", "c_share"]

    def dealt(df: DataFrame, side: str, other: str, own: str, across: str) -> DataFrame:
        """A row in its own share, beside every share of the other side."""
        every = F.explode(F.expr(f"sequence(0, coalesce({across}_shares, 1) - 1)"))
        known = df.join(crowded, "cell", "left").select(
            *df.columns, F.expr(f"int(pmod(xxhash64({side}), coalesce({own}_shares, 1)))").alias(f"{side}_share"),
            every.alias(f"{other}_share"),
        )
        placed_rows = known.select("*", *ball(f"{side}_lon", f"{side}_lat"))
        tasks = math.ceil(pairs / TASK_PAIRS)
        if tasks < 2:
            return placed_rows
        return placed_rows.repartition(max(tasks, int(df.sparkSession.conf.get(PARTITIONS))), *block)

    # No chord is longer than that of the widest angle; a few products spare most pairs the spheroid.
    reach = min(math.pi, metres / LEAST_RADIUS_M * 1.0001)
    chord = " + ".join(f"(p_{a} - c_{a}) * (p_{a} - c_{a})" for a in "xyz")
    near = F.expr(f"{chord} <= {(2 * math.sin(reach / 2) + 1e-12) ** 2!r}D")
    together = dealt(p, "p", "c", "points", "centres").join(dealt(c, "c", "p", "centres", "points"), block)
    found = together.where(near).withColumn("metres", F.expr(spheroid_m("c_lon", "c_lat", "p_lon", "p_lat")))
    return found.where(F.col("metres") <= float(metres)).select(
        *[F.col("c")[name].alias(name) for name in centres.columns],
        *[F.col("p")[name].alias(name) for name in points.columns],
        F.col("metres").alias(distance_column),
    )
