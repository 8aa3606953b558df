"""Reading a physical plan."""

from __future__ import annotations

import contextlib
import re

from pyspark.sql import DataFrame, SparkSession


def physical(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(df: DataFrame, operator: str) -> int:
    return len(re.findall(rf"(?m)^[\s:+\-*()\d]*{operator}\b", physical(df)))


@contextlib.contextmanager
def settings(spark: SparkSession, **values: object):
    """Session settings for a block; ``__`` in a name stands for a full stop."""
    names = {name.replace("__", "."): str(value) for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
