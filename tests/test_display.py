"""Display text equals Python's formatting."""

import random

from pyspark.sql import functions as F

from quayside.functions import display as D


def test_formats_equal_python(spark):
    rng = random.Random(3)
    values = [0.0, -0.3, 0.5, 1.5, 2.5, 86.25, 86.35, 0.8625, 1234567.5, -1234.5, 0.125]
    values += [rng.uniform(-10**5, 10**5) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    v = F.col("v")
    got = df.select("v", D.fixed(v, 1), D.percent(v), D.dollars(v), D.days(v), D.signed(v), D.signed_dollars(v), D.grouped(v, 0)).collect()
    for x, fixed, percent, dollars, days, signed, signed_dollars, grouped in got:
        assert fixed == f"{x:.1f}"
        assert percent == f"{x * 100:.1f}%"
        assert dollars == f"${x:,.0f}"
        assert days == f"{x:.1f} days"
        assert signed == f"{x:+.0f}"
        assert signed_dollars == f"${x:+,.0f}" and grouped == f"{x:,.0f}"


def test_missing_is_nan(spark):
    none = F.lit(None).cast("double")
    assert tuple(spark.range(1).select(D.percent(none), D.dollars(none), D.days(none), D.signed(none)).first()) == (
        "nan%",
        "$nan",
        "nan days",
        "nan",
    )
