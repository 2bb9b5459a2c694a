"""Column expressions: safe typing, rounding, keys, bands and distances. All run in codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

DATE_PATTERN = r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
EXACT = "decimal(24,6)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- safe typing -------------------------------------------------------------------------

def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def safe_date(c: Column | str) -> Column:
    """DATE or NULL; a bare year, a year and month or a timestamp is not a date."""
    return F.when(col(c).rlike(DATE_PATTERN), col(c).try_cast("date"))


def safe_int(c: Column | str) -> Column:
    return col(c).try_cast("bigint")


def safe_float(c: Column | str) -> Column:
    """Finite DOUBLE or NULL. The pattern keeps out the NaN, infinity, hexadecimal and suffix
    spellings of the JVM parser, and spares dirty cells the cost of a failed parse."""
    return F.when(col(c).rlike(NUMBER_PATTERN), col(c).try_cast("double"))


# ---- numbers -----------------------------------------------------------------------------

def round_half_away(c: Column | str, digits: int = 0) -> Column:
    """Half away from zero on the binary value, reproducible on any engine."""
    scale = float(10 ** digits)
    x = col(c)
    return F.signum(x) * F.floor(F.abs(x) * scale + 0.5) / scale + F.lit(0.0)


def round_half_even(c: Column | str, digits: int = 0) -> Column:
    scale = float(10) ** digits
    return F.rint(col(c) * scale) / scale + F.lit(0.0)


def exact_sum(c: Column | str) -> Column:
    """Sum that does not depend on the order of the rows."""
    return F.sum(col(c).cast(EXACT)).cast("double")


def exact_avg(c: Column | str) -> Column:
    return F.try_divide(exact_sum(c), F.count(col(c)).cast("double"))


def ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def share_pct(num: Column, den: Column, digits: int = 1) -> Column:
    return round_half_away(ratio(num, den) * 100.0, digits)


def blank_change(cur: Column, prev: Column) -> Column:
    """(cur - prev) / prev where a missing operand counts as 0 and a missing base gives NULL."""
    cur, prev = cur.cast("double"), prev.cast("double")
    return F.try_divide(F.coalesce(cur, F.lit(0.0)) - F.coalesce(prev, F.lit(0.0)), prev)


# ---- keys and texts ----------------------------------------------------------------------

def surrogate_key(*cols: Column | str) -> Column:
    parts = [F.coalesce(col(c).cast("string"), F.lit(K.KEY_NULL_MARKER)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def number_text(c: Column | str) -> Column:
    """Shortest decimal spelling: 49 and 48.85 rather than 49.0 and 48.850."""
    return F.regexp_replace(col(c).cast("string"), r"\.0$", "")


def station_key(name: Column | str, lat: Column | str, lon: Column | str) -> Column:
    return F.md5(F.concat(col(name), F.lit("|"), number_text(lat), F.lit("|"), number_text(lon)))


def point(lon: Column | str, lat: Column | str) -> Column:
    return F.struct(col(lon).alias("lon"), col(lat).alias("lat"))


def date_key(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyyMMdd").cast("int")


def split_point(c: Column | str) -> tuple[Column, Column]:
    """'lat, lon' text as two trimmed text columns; NULL gives '' and NULL."""
    parts = F.split(F.coalesce(col(c), F.lit("")), ",", 2)
    return F.trim(F.get(parts, F.lit(0))), F.trim(F.get(parts, F.lit(1)))


def vintage(url: Column | str) -> Column:
    return blank_to_null(F.regexp_extract(col(url), r"(20\d\d)", 1))


# ---- classes and bands -------------------------------------------------------------------

def banded(c: Column | str, bands: list[tuple[float | None, str]]) -> Column:
    """Label of the first band whose exclusive upper bound is above the value; NULL stays NULL."""
    x = col(c)
    steps = [(x < bound if bound is not None else x.isNotNull(), label) for bound, label in bands]
    return reduce(lambda acc, s: acc.when(s[0], s[1]), steps[1:], F.when(steps[0][0], steps[0][1]))


def surface_band(c: Column | str) -> Column:
    return F.coalesce(banded(c, K.SURFACE_BANDS), F.lit(K.SURFACE_UNKNOWN))


def room_class(rooms: Column | str, sale_class: Column | str) -> Column:
    rooms, sale_class = col(rooms), col(sale_class)
    dwelling = (
        F.when(F.coalesce(rooms, F.lit(0)) == 0, K.ROOMS_UNKNOWN)
        .when(rooms >= 5, K.ROOMS_LARGE)
        .otherwise(F.concat(F.lit("T"), rooms.cast("string")))
    )
    return F.when(~sale_class.isin(K.DWELLINGS), K.ROOMS_NOT_DWELLING).otherwise(dwelling)


def sale_class(flats: Column, houses: Column, business: Column, outbuildings: Column) -> Column:
    return (
        F.when((flats == 1) & (houses == 0), K.FLAT)
        .when((houses == 1) & (flats == 0), K.HOUSE)
        .when(flats + houses > 1, K.CLASS_MULTI)
        .when(business > 0, K.CLASS_BUSINESS)
        .when(outbuildings > 0, K.CLASS_OUTBUILDING)
        .otherwise(K.CLASS_LAND)
    )


def simple_sale(flats: Column, houses: Column, business: Column, prices: Column,
                surface: Column) -> Column:
    """Three-valued: NULL only when everything else holds and the surface is unknown."""
    return (
        (flats + houses == 1) & (business == 0) & (prices == 1) & (surface >= K.MIN_DWELLING_M2)
    )


def price_per_m2(simple: Column | str, price: Column | str, surface: Column | str) -> Column:
    return F.when(col(simple), round_half_away(F.try_divide(col(price), col(surface)), 2))


def reliable_price(c: Column | str) -> Column:
    return F.coalesce(col(c).between(K.RELIABLE_MIN, K.RELIABLE_MAX), F.lit(False))


def market_position(gap: Column | str) -> Column:
    """Bounds are asymmetric: -20 is under, -10 and 10 are market, 20 is above; so is NULL."""
    g = col(gap)
    return (
        F.when(g <= -20, K.POSITION_UNDER)
        .when(g < -10, K.POSITION_SLIGHTLY_UNDER)
        .when(g <= 10, K.POSITION_MARKET)
        .when(g < 20, K.POSITION_SLIGHTLY_ABOVE)
        .otherwise(K.POSITION_ABOVE)
    )


def gap_pct(actual: Column | str, predicted: Column | str) -> Column:
    p = col(predicted)
    return round_half_even(F.try_divide(col(actual) - p, p) * 100.0, 1)


# ---- distances ---------------------------------------------------------------------------

def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2.0), 2.0) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2.0), 2.0)
    )
    return F.lit(2.0 * K.EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))
