import math

import pytest
from pyspark.sql import functions as F

from tickloom.functions import coerce


@pytest.mark.parametrize(
    "text, value",
    [
        (None, 0.0), ("N/A", 0.0), ("", 0.0), ("85000.5", 85000.5), ("42", 42.0), ("-3.5", -3.5), ("0", 0.0),
        (" 7 ", 7.0), ("1e3", 1000.0), ("1_000", 1000.0), ("1__0", 0.0), ("_1", 0.0), ("1d", 0.0), ("2.5F", 0.0),
        ("0x1p3", 0.0), ("inf", math.inf), ("-Infinity", -math.inf),
    ],
)
def test_to_double(one, text, value):
    assert one(coerce.to_double(F.lit(text).cast("string")))[0] == value


def test_to_double_keeps_nan_and_takes_a_default(one):
    assert math.isnan(one(coerce.to_double(F.lit("nan")))[0])
    assert one(coerce.to_double(F.lit(None), 99.9))[0] == 99.9
    assert one(coerce.to_double(F.lit(42), text=False))[0] == 42.0


@pytest.mark.parametrize(
    "text, value",
    [(None, 0), ("bad", 0), ("1234.9", 1234), ("1000000", 1000000), ("-5", -5), ("-5.9", -5), ("nan", 0)],
)
def test_to_bigint(one, text, value):
    assert one(coerce.to_bigint(F.lit(text).cast("string")))[0] == value


def test_to_bigint_default(one):
    assert one(coerce.to_bigint(F.lit(None), 5))[0] == 5


@pytest.mark.parametrize(
    "value, beyond", [(1.0, False), (float("inf"), True), (-1e30, True), (float("nan"), False), (-float(2**63), False)]
)
def test_beyond_bigint(one, value, beyond):
    assert one(coerce.beyond_bigint(F.lit(value)))[0] is beyond


@pytest.mark.parametrize(
    "source, name",
    [("vnstock/KBS", "stock"), ("ccxt/binance", "crypto"), ("other", "unknown"), ("", "unknown"), (None, "unknown")],
)
def test_asset_class_of_source(one, source, name):
    assert one(coerce.asset_class_of_source(F.lit(source).cast("string")))[0] == name


def test_symbol_helpers(one):
    row = one(
        coerce.asset_class_of_symbol(F.lit("BTC/USDT")), coerce.asset_class_of_symbol(F.lit("VCB")),
        coerce.symbol_key(F.lit("BTC/USDT")), coerce.symbol_key(F.lit(None).cast("string")),
    )
    assert tuple(row) == ("crypto", "stock", "BTC-USDT", "UNKNOWN")


@pytest.mark.parametrize(
    "text, utc",
    [
        ("2024-05-10T08:00:00+00:00", "2024-05-10 08:00:00"),
        ("2024-05-10T02:00:00+07:00", "2024-05-09 19:00:00"),
        ("2024-05-10T08:00:00Z", "2024-05-10 08:00:00"),
        ("2024-05-10", "2024-05-10 00:00:00"),
        ("20240510T080000", None), ("2024", None), ("soon", None), (None, None),
    ],
)
def test_parse_iso(one, text, utc):
    parsed = coerce.parse_iso(F.lit(text).cast("string"))
    assert one(F.date_format(parsed, "yyyy-MM-dd HH:mm:ss"))[0] == utc


def test_to_iso_text(one):
    row = one(
        coerce.to_iso_text(F.lit("2024-05-10")), coerce.to_iso_text(F.lit("2024-05-10T08:00:00+07:00")),
        coerce.to_iso_text(F.lit("2024-05-10").cast("date")),
    )
    assert tuple(row) == ("2024-05-10T00:00:00+00:00", "2024-05-10T08:00:00+07:00", "2024-05-10T00:00:00+00:00")


def test_date_parts(one):
    time = F.lit("2024-05-03 10:00:00").cast("timestamp")
    assert tuple(one(*coerce.date_parts(time))) == ("2024", "05", "03")
    assert tuple(one(*coerce.date_parts(F.lit(None).cast("timestamp")))) == ("unknown",) * 3
