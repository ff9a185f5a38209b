"""Small helpers shared by the tests."""

import os

DATA = "/root/testdata"
VOCABULARY = "label bigint, intent string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def vocabulary(spark, names):
    return spark.createDataFrame(list(enumerate(names)), VOCABULARY)


def executed_plan(df):
    """The physical plan text after adaptive execution."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def table_views(connection, folder):
    for name in os.listdir(folder):
        table = name.removesuffix(".parquet")
        connection.execute(f"create view {table} as select * from '{folder}/{name}'")


def comparable(table):
    """Order-free, engine-neutral form of an Arrow table."""

    def shown(value):
        return f"{value:.9g}" if isinstance(value, float) else repr(value)

    names = sorted(table.column_names)
    columns = [[shown(v) for v in table.column(n).to_pylist()] for n in names]
    return names, sorted(zip(*columns))
