"""Facts about a physical plan, for tests and tuning."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame


def plan_text(df: DataFrame) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def final_plan(df: DataFrame) -> str:
    """The plan as it ran: after adaptive changes, with repeated exchanges replaced by references to the first."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def scans(df: DataFrame) -> Counter:
    """Runs the query and tells how often each Parquet input was read, by file name."""
    return Counter(re.findall(r"FileScan parquet .*?Location: \w+\(.*?/(\w+)\.parquet\]", final_plan(df)))


def operators(df: DataFrame) -> Counter:
    """How often each physical operator occurs."""
    return Counter(re.findall(r"^\(\d+\) (\w+)", plan_text(df), flags=re.MULTILINE))
