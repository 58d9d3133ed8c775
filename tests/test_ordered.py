import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowtables.operators.ordered import counter_block, running


def test_running_equals_one_window_per_group(spark):
    rng = random.Random(1)
    rows = [(rng.choice("aab"), i, rng.randint(-9, 9)) for i in rng.sample(range(3000), 900)]
    df = spark.createDataFrame(rows, "g string, i long, v long")
    values = {"s": ("sum", F.col("v")), "hi": ("max", F.col("v")), "lo": ("min", F.col("v")), "n": ("sum", F.lit(1))}
    result = running(df, ["g"], counter_block("i", 64), ["i"], values)
    w = Window.partitionBy("g").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    expected = df.select(
        "*", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("hi"), F.min("v").over(w).alias("lo"),
        F.count("*").over(w).alias("n"),
    )
    assert sorted(map(tuple, result.collect())) == sorted(map(tuple, expected.collect()))


def test_running_windows_cover_blocks_only(spark):
    df = spark.range(10).withColumn("g", F.lit(1))
    plan = running(df, ["g"], counter_block("id", 4), ["id"], {"n": ("sum", F.lit(1))})._jdf.queryExecution().toString()
    assert "[g#" in plan and "_block#" in plan.split("Window")[1]
