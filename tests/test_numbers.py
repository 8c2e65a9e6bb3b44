import math
import random

from pyspark.sql import functions as F

from navloom.functions.numbers import exact_round


def test_exact_round_equals_python(spark):
    rng = random.Random(1)
    values = [2.675, 0.125, 0.375, -0.125, 1.005, -2.675, 0.0, 1e17, 123456.785, 1e-9, -0.004, 2.5, 3.5]
    values += [round(rng.uniform(-500, 500), 3) for _ in range(3000)]
    values += [rng.randrange(-4000, 4000) / 8 for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select("v", *[exact_round("v", d).alias(f"r{d}") for d in (0, 2, 4)]).collect()
    for row in rows:
        for digits in (0, 2, 4):
            assert row[f"r{digits}"] == round(row.v, digits), (row.v, digits)
            assert math.copysign(1, row[f"r{digits}"]) > 0 or row[f"r{digits}"] < 0


def test_exact_round_of_null(spark):
    assert spark.range(1).select(exact_round("cast(null as double)", 2).alias("r")).first().r is None
    assert spark.range(1).select(F.isnan(exact_round("double('NaN')", 2)).alias("r")).first().r
