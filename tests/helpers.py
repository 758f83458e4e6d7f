from pyspark.sql import functions as F


def column(spark, values, expr, kind="string"):
    """Results of a Column expression over a list of values, in order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r[1] for r in sorted(df.select("i", expr(F.col("x")).alias("y")).collect())]


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
