"""Totals per employee that the annuity models take as inputs.

Counting goes over (employee, policy) first. That spreads an employee with very
many policies over all tasks; the second step then adds one row per policy and
is combined on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.operators.projection import quoted


def task_ratio(
    df: DataFrame, employee: str, policy: str, is_task: Column, high_at: int
) -> DataFrame:
    """Policies with many tasks, relative to those with any; NULL without tasks."""
    per_policy = df.groupBy(employee, policy).agg(
        F.sum(F.when(is_task, 1).otherwise(0)).alias("_tasks")
    )
    totals = per_policy.groupBy(employee).agg(
        F.count(F.lit(1)).alias("policy_count"),
        F.sum("_tasks").alias("task_count"),
        F.sum(F.when(F.col("_tasks") >= high_at, 1).otherwise(0)).alias("high_task_count"),
        F.sum(F.when(F.col("_tasks") == 0, 1).otherwise(0)).alias("zero_task_count"),
    )
    busy = F.col("policy_count") - F.col("zero_task_count")
    return totals.withColumn("ratio", F.try_divide(F.col("high_task_count"), busy))


def change_ratio(
    df: DataFrame, employee: str, policy: str, is_change: Column, days: Column
) -> DataFrame:
    """Share of policies with a change, and mean days until the change."""
    per_policy = df.groupBy(employee, policy).agg(
        F.sum(F.when(is_change, 1).otherwise(0)).alias("_changes"),
        F.sum(F.when(is_change, days)).alias("_days"),
    )
    totals = per_policy.groupBy(employee).agg(
        F.count(F.lit(1)).alias("policy_count"),
        F.sum(F.when(F.col("_changes") > 0, 1).otherwise(0)).alias("change_policy_count"),
        F.sum("_changes").alias("party_change_count"),
        F.sum("_days").alias("_days"),
    )
    return totals.select(
        employee, "policy_count", "change_policy_count", "party_change_count",
        F.try_divide(F.col("_days"), F.col("party_change_count")).alias("mean_change_days"),
        F.try_divide(F.col("change_policy_count"), F.col("policy_count")).alias("ratio"),
    )


def policy_totals(
    df: DataFrame, employee: str, policy: str, value: Column, is_withdrawal: Column,
    amount: Column, denominator: Column | None = None,
) -> DataFrame:
    """Policies, withdrawals, value and withdrawn amount of an employee.

    The value of a policy counts once. The ratio's denominator is the caller's,
    an expression over the totals; the policy count unless given.
    """
    per_policy = df.groupBy(employee, policy).agg(
        F.max(value).alias("_value"),
        F.max(F.when(is_withdrawal, 1).otherwise(0)).alias("_withdrawn"),
        F.sum(F.when(is_withdrawal, amount)).alias("_amount"),
    )
    totals = per_policy.groupBy(employee).agg(
        F.count(F.lit(1)).alias("total_policy_count"),
        F.sum("_withdrawn").alias("withdrawal_policy_count"),
        F.sum("_value").alias("policy_value"),
        F.coalesce(F.sum("_amount"), F.lit(0.0)).alias("policy_withdrawal"),
    )
    base = F.col("total_policy_count") if denominator is None else denominator
    return totals.withColumn("ratio", F.try_divide(F.col("withdrawal_policy_count"), base))


def hypothesis_score(flags: Sequence[str]) -> dict[str, Column]:
    """Mean of the flags that are known, and how many of how many those are."""
    known = F.filter(F.array(*[quoted(f).cast("double") for f in flags]), lambda x: x.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda acc, x: acc + x)
    return {
        "numerator": F.size(known),
        "denominator": F.lit(len(flags)),
        "score": F.try_divide(total, F.size(known)),
        "eligible_hypothesis": F.concat(F.size(known).cast("string"), F.lit("/"), F.lit(str(len(flags)))),
    }


def logins_per_transaction(df: DataFrame, transaction: str, login: str) -> DataFrame:
    """Sorted distinct logins of each transaction.

    Duplicates go first, so a list is never longer than the number of employees.
    """
    pairs = df.select(quoted(transaction), quoted(login)).distinct()
    return pairs.groupBy(transaction).agg(F.sort_array(F.collect_list(login)).alias("logins"))
