import math

import pytest
from pyspark.sql import functions as F

from cadastria.functions import columns as C
from cadastria.functions import constants as K


def one(df):
    return [r[0] for r in df.collect()]


def test_safe_date_rejects_partial_dates_and_timestamps(spark):
    texts = ["2024-01-05", "2024-1-5", "2024", "2024-01", "2024-01-05 10:00", "n/a", "", None,
             "2024-02-30"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [None if d is None else d.isoformat() for d in one(df.select(C.safe_date("t")))]
    assert found == ["2024-01-05", "2024-01-05"] + [None] * 7


def test_safe_numbers(spark):
    texts = ["1.5", " 2 ", "1e3", "NaN", "Infinity", "1d", "2f", "0x1p3", "", "abc", None, "-.5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert one(df.select(C.safe_float("t"))) == [1.5, 2.0, 1000.0] + [None] * 8 + [-0.5]
    ints = spark.createDataFrame([(t,) for t in ["3", "3.0", "", "x", "-4"]], "t string")
    assert one(ints.select(C.safe_int("t"))) == [3, None, None, None, -4]


def test_rounding_modes(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (3.5,), (0.125,), (-0.2,)], "x double")
    assert one(df.select(C.round_half_away("x", 0))) == [3.0, -3.0, 4.0, 0.0, 0.0]
    assert one(df.select(C.round_half_even("x", 0))) == [2.0, -2.0, 4.0, 0.0, 0.0]
    assert math.copysign(1, one(df.select(C.round_half_away("x", 0)))[-1]) == 1.0
    assert one(df.select(C.round_half_away("x", 2)))[3] == 0.13


@pytest.mark.parametrize("surface, band", [
    (None, "Inconnue"), (29.99, "< 30 m²"), (30.0, "30-50 m²"), (50.0, "50-80 m²"),
    (119.9, "80-120 m²"), (120.0, "120 m² et +")])
def test_surface_bands_are_open_on_the_right(spark, surface, band):
    df = spark.createDataFrame([(surface,)], "s double")
    assert one(df.select(C.surface_band("s"))) == [band]


@pytest.mark.parametrize("rooms, kind, label", [
    (3, K.FLAT, "T3"), (5, K.HOUSE, "T5+"), (0, K.FLAT, "Inconnu"), (None, K.HOUSE, "Inconnu"),
    (3, K.CLASS_LAND, "n/a"), (None, K.CLASS_MULTI, "n/a")])
def test_room_classes(spark, rooms, kind, label):
    df = spark.createDataFrame([(rooms, kind)], "r bigint, k string")
    assert one(df.select(C.room_class("r", "k"))) == [label]


@pytest.mark.parametrize("gap, position", [
    (-20.0, K.POSITION_UNDER), (-19.9, K.POSITION_SLIGHTLY_UNDER), (-10.0, K.POSITION_MARKET),
    (10.0, K.POSITION_MARKET), (10.1, K.POSITION_SLIGHTLY_ABOVE), (20.0, K.POSITION_ABOVE),
    (None, K.POSITION_ABOVE)])
def test_market_positions_at_their_bounds(spark, gap, position):
    df = spark.createDataFrame([(gap,)], "g double")
    assert one(df.select(C.market_position("g"))) == [position]


def test_distance_bands_keep_null(spark):
    df = spark.createDataFrame([(None,), (499.0,), (500.0,), (2000.0,)], "d double")
    assert one(df.select(C.banded("d", K.STATION_BANDS))) == [
        None, "1. Moins de 500 m", "2. 500 m à 1 km", "4. Plus de 2 km"]


def test_simple_sale_is_three_valued(spark):
    rows = [(1, 0, 0, 1, 30.0), (1, 0, 0, 1, None), (2, 0, 0, 1, None), (1, 0, 1, 1, None),
            (0, 1, 0, 1, 8.9), (1, 0, 0, 2, None)]
    df = spark.createDataFrame(rows, "f int, h int, b int, p int, s double")
    flag = C.simple_sale(*[F.col(c) for c in "fhbps"])
    assert one(df.select(flag)) == [True, None, False, False, False, False]


def test_reliable_price_is_never_null(spark):
    df = spark.createDataFrame([(None,), (999.99,), (1000.0,), (30000.0,), (30000.01,)], "p double")
    assert one(df.select(C.reliable_price("p"))) == [False, False, True, True, False]


def test_blank_change(spark):
    rows = [(110.0, 100.0), (None, 100.0), (110.0, None), (None, None), (5.0, 0.0)]
    df = spark.createDataFrame(rows, "c double, p double")
    assert [None if v is None else round(v, 6)
            for v in one(df.select(C.blank_change(F.col("c"), F.col("p"))))] == [
        0.1, -1.0, None, None, None]


def test_keys_are_shared_and_stable(spark):
    import hashlib

    df = spark.createDataFrame([("a", None, 49.0, 2.35)], "x string, y string, lat double, lon double")
    assert one(df.select(C.surrogate_key("x", "y"))) == [
        hashlib.md5(f"a-{K.KEY_NULL_MARKER}".encode()).hexdigest()]
    assert one(df.select(C.station_key("x", "lat", "lon"))) == [
        hashlib.md5(b"a|49|2.35").hexdigest()]


def test_gap_sign(spark):
    df = spark.createDataFrame([(1100.0, 1000.0), (900.0, 1000.0)], "y double, p double")
    assert one(df.select(C.gap_pct("y", "p"))) == [10.0, -10.0]


def test_split_point_and_vintage(spark):
    df = spark.createDataFrame([("48.85, 2.35",), (None,), ("48.85",)], "g string")
    lat, lon = C.split_point("g")
    assert [tuple(r) for r in df.select(lat, lon).collect()] == [
        ("48.85", "2.35"), ("", None), ("48.85", None)]
    urls = spark.createDataFrame([("http://x/f2021.csv",), ("http://x/f.csv",)], "u string")
    assert one(urls.select(C.vintage("u"))) == ["2021", None]
