"""Helper functions: NUMERIC rounding, guarded percentage, windows, distance."""

import math
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from helpers import at, stg_tx
from riskstream.functions.geo import equirectangular_km
from riskstream.functions.numeric import pct, round_numeric
from riskstream.functions.time import interval_micros, window_start


def test_round_numeric_is_decimal_half_up(spark):
    rnd = random.Random(3)
    vals = [1.005, 2.675, -1.005, 0.125, 123.4549999, 1e-11, 9999.995]
    vals += [round(rnd.uniform(-1e4, 1e4), rnd.randint(0, 6)) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(round_numeric("x", 2)).collect()]

    def want(v):
        d = Decimal(repr(v)).quantize(Decimal("1e-10"), rounding=ROUND_HALF_UP)
        return float(d.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))

    assert got == [want(v) for v in vals]


def test_pct_guards_zero(spark):
    df = spark.createDataFrame([(1, 4), (0, 0), (3, 3)], "a long, n long")
    got = [r[0] for r in df.select(pct(F.col("a"), F.col("n"))).collect()]
    assert got == [25.0, 0.0, 100.0]


def test_window_start_matches_window_and_keeps_nulls(spark):
    df = stg_tx(spark, [{"occurred_at": at(s)} for s in (0, 59.9, 60, 3599, 3600)]
                + [{"occurred_at": None}])
    for d in ["60 seconds", "5 minutes", "1 hour"]:
        rows = df.select(window_start(F.col("occurred_at"), d).alias("a"),
                         F.window("occurred_at", d).start.alias("b")).collect()
        assert len(rows) == 5 and all(r.a == r.b for r in rows)
        # F.window drops NULL times from the whole projection; window_start keeps them
        alone = df.select(window_start(F.col("occurred_at"), d).alias("a")).collect()
        assert len(alone) == 6 and sum(1 for r in alone if r.a is None) == 1
    assert interval_micros("5 minutes") == 300_000_000


def test_equirectangular_km(spark):
    pts = [(51.5074, -0.1278, -33.8688, 151.2093), (0.0, 0.0, 4.6, 0.0),
           (10.0, 179.0, 10.0, -179.0)]
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(equirectangular_km(
        F.col("c"), F.col("d"), F.col("a"), F.col("b"))).collect()]
    for (a, b, c, d), g in zip(pts, got):
        dy = (c - a) * 111.0
        dx = (d - b) * 111.0 * abs(math.cos(math.radians((c + a) / 2)))
        assert math.isclose(g, math.sqrt(dy * dy + dx * dx), rel_tol=1e-12)
