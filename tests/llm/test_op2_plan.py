"""Size of the plan of op2's tests, and their values."""

import random

from pyspark.sql import functions as F

from fraudmart.llm import op2_secret_scan as op2


def test_battery_is_planned_once(spark):
    rng = random.Random(3)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(64)) for _ in range(50)]
    words = ["".join(rng.choice("eeeettaaoinsr") for _ in range(64)) for _ in range(50)]
    df = spark.createDataFrame([(t,) for t in hexes + words], "t string")
    counts = df.select("t", F.transform(F.array("t"), op2._counts).alias("x"))
    tested = counts.select("t", F.get(F.transform("x", op2._battery), F.lit(0)).alias("y"))
    assert tested._jdf.queryExecution().optimizedPlan().toJSON().count('"class"') < 5000  # 200,000 when values were copied
    got = {r["t"]: r["y"] for r in tested.collect()}
    assert all(got[t]["encoding"] == "hex" and got[t]["octave"] == 6 for t in hexes)
    assert sum(got[t]["random"] for t in hexes) >= 45 and not any(got[t]["random"] for t in words)
