"""Constraint suites: named checks as queries, one row each, and a status made of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECK = "check string, ok boolean, detail string"


def check(df: DataFrame, name: str, bad: Column) -> DataFrame:
    """One row (check, ok, detail): ok if ``bad`` holds for no row; detail counts those for which it does. Null counts as bad."""
    n = F.count_if(F.coalesce(bad, F.lit(True)))
    return df.agg(n.alias("n")).select(F.lit(name).alias("check"), (F.col("n") == 0).alias("ok"), F.when(F.col("n") > 0, F.concat(F.col("n").cast("string"), F.lit(" rows"))).otherwise("").alias("detail"))


def empty(df: DataFrame, name: str) -> DataFrame:
    """ok if ``df`` has no row: for anti joins, intersections, differences."""
    return check(df, name, F.lit(True))


def unique(df: DataFrame, name: str, *keys: str) -> DataFrame:
    return empty(df.groupBy(*keys).count().where("count > 1"), name)


def same_keys(a: DataFrame, b: DataFrame, name: str, *keys: str) -> DataFrame:
    """ok if both sides have the same keys: one full outer join, not two differences."""
    left, right = (d.select(*keys).distinct().withColumn(m, F.lit(1)) for d, m in ((a, "_l"), (b, "_r")))
    return empty(left.join(right, list(keys), "full").where("_l is null or _r is null"), name)


def disjoint(a: DataFrame, b: DataFrame, name: str, *keys: str) -> DataFrame:
    return empty(a.select(*keys).join(b.select(*keys), list(keys), "left_semi"), name)


def contained(a: DataFrame, b: DataFrame, name: str, *keys: str) -> DataFrame:
    return empty(a.select(*keys).join(b.select(*keys), list(keys), "left_anti"), name)


def fact(spark: SparkSession, name: str, ok: bool, detail: str = "") -> DataFrame:
    """A check that the driver has made itself (a file that is there, a folder's contents)."""
    return spark.range(1).select(F.lit(name).alias("check"), F.lit(ok).alias("ok"), F.lit(detail).alias("detail"))


def run(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def lot_status(results: DataFrame, structural: list[str], rejected: bool = False) -> str:
    """FAIL if a reviewer rejects or a structural check fails, HOLD if another one does, else PASS."""
    row = results.where("not ok").agg(F.coalesce(F.bool_or(F.col("check").isin(structural)), F.lit(False)).alias("structural"), F.count("*").alias("n")).first()
    return "FAIL" if rejected or row.structural else "HOLD" if row.n else "PASS"


def derived_status(statuses: DataFrame, column: str = "status") -> DataFrame:
    """Counts by status and the gravest: ERROR, FAIL, HOLD, PASS."""
    n = lambda s: F.count_if(F.col(column) == s)
    return statuses.agg(n("PASS").alias("n_pass"), n("HOLD").alias("n_hold"), n("FAIL").alias("n_fail"), n("ERROR").alias("n_error")).withColumn("status", F.when(F.col("n_error") > 0, "ERROR").when(F.col("n_fail") > 0, "FAIL").when(F.col("n_hold") > 0, "HOLD").otherwise("PASS"))


def gaps(*lists: Column) -> Column:
    """All gaps that any of the lists names, once each, sorted; a null list names none."""
    none = F.expr("cast(array() as array<string>)")
    return F.array_sort(F.array_distinct(F.array_compact(F.concat(*[F.coalesce(x, none) for x in lists], none))))
