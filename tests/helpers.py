from collections import Counter


def bag(df):
    """Rows with their number, for comparison regardless of order."""
    return Counter(tuple(row) for row in df.collect())


def column(spark, make, values, kind="string"):
    """Apply a column function to a one-column frame and return the results in order."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [row.y for row in rows.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def details_of(df):
    """The plan with the arguments of each operator in full."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)
