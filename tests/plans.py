"""Reading physical plans."""


def plan(df) -> str:
    """The physical plan before adaptive execution changes it."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def final_plan(df) -> str:
    """The plan after running it, with what adaptive execution made of it."""
    df.collect()
    return plan(df)
