"""What several test modules share; fixtures stay in conftest."""


def evaluate(spark, column, values, kind="string"):
    """Values of a column expression over ``v``, in input order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", column.alias("x")).orderBy("i").collect()]


def as_set(df):
    return {tuple(r) for r in df.collect()}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
