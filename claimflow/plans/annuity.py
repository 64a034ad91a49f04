"""Consistency of annuity applications and transactions, in batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow import fixed_values as fixed
from claimflow.functions import categories, cleaning, scoring, tenure
from claimflow.operators.employee import change_ratio, policy_totals, task_ratio
from claimflow.operators.encode import TargetEncoder
from claimflow.operators.projection import quoted
from claimflow.operators.scale import QuantileTransform, Scaler
from claimflow.operators.skew import lookup_join
from claimflow.session import materialise

LOGINS = "V_SYSTEM_LOGON_ID"
ENTITY = "TRXNUM"
APPLICATION_TRANSFORMED = [
    c for c in fixed.APPLICATION_NUMERIC if c not in fixed.APPLICATION_NOT_TRANSFORMED
]


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """NULL becomes the column's default; columns that are absent are skipped."""

    def filled(c: str, value: object) -> Column:
        # flags with a text default become categories of their own
        x = quoted(c).cast("string") if isinstance(value, str) else quoted(c).cast("double")
        return F.coalesce(x, F.lit(value))

    return df.withColumns({c: filled(c, v) for c, v in defaults.items() if c in df.columns})


def login_features(df: DataFrame, logins: Sequence[str]) -> DataFrame:
    """Which known employees took part, and how many logins there were."""
    who = quoted(LOGINS)
    levels = {f"emp_level_{i}": categories.mentions(who, x).cast("boolean") for i, x in enumerate(logins, 1)}
    return df.withColumns(
        {
            "webservices": categories.mentions(who, fixed.WEB_LOGIN),
            **levels,
            "no_employees": cleaning.list_length(who),
        }
    ).drop(LOGINS)


def lag_features(df: DataFrame, base: str, events: Sequence[str]) -> DataFrame:
    """``<event>diff``: whole days from each event to the base date, -1 if unknown or later."""
    day = cleaning.parse_timestamp(quoted(base))
    return df.withColumns(
        {f"{c}diff": tenure.event_lag(day, cleaning.parse_timestamp(quoted(c))) for c in events}
    )


def employee_totals(
    events: DataFrame, employee: str, policy: str, is_task: Column, is_change: Column, days: Column,
    value: Column, is_withdrawal: Column, amount: Column, high_at: int,
) -> DataFrame:
    """One row per employee with the totals that transactions take as features, from raw events."""
    tasks = task_ratio(events, employee, policy, is_task, high_at).select(
        employee, F.col("zero_task_count").alias("uc7_employee_zero_task_count"), F.col("ratio").alias("uc7_employee_ratio")
    )
    changes = change_ratio(events, employee, policy, is_change, days).select(
        employee, F.col("policy_count").alias("uc8_employee_policy_count"),
        F.col("mean_change_days").alias("uc8_employee_mean_change_days"), F.col("ratio").alias("uc8_employee_ratio"),
    )
    policies = policy_totals(events, employee, policy, value, is_withdrawal, amount).select(
        employee, F.col("total_policy_count").alias("uc2_employee_total_policy_count")
    )
    return tasks.join(changes, employee).join(policies, employee)


def transactions_of_events(df: DataFrame, totals: DataFrame, employee: str, base: str, events: Sequence[str]) -> DataFrame:
    """Transactions with the totals of their employee and the days since each event.

    ``totals`` has one row per employee; an employee who made very many transactions is
    spread over tasks where that table is too large to be broadcast.
    """
    kept = [c for c in df.columns if c not in totals.columns or c == employee]
    joined = lookup_join(df.select(*[quoted(c) for c in kept]), materialise(totals), [employee])
    return lag_features(joined, base, events)


def application_features(df: DataFrame, carry: Sequence[str] = (ENTITY,)) -> DataFrame:
    """Features in model order; ``carry`` columns, such as a label to fit on, stay in front."""
    filled = login_features(fill_defaults(df, fixed.APPLICATION_DEFAULTS), fixed.APPLICATION_LOGINS)
    levels = [f"emp_level_{i}" for i in range(1, len(fixed.APPLICATION_LOGINS) + 1)]
    return filled.select(
        *[
            quoted(c)
            for c in [*carry, *fixed.APPLICATION_NUMERIC, *fixed.APPLICATION_CATEGORICAL, *levels]
        ]
    )


def transaction_features(df: DataFrame, carry: Sequence[str] = (ENTITY,)) -> DataFrame:
    """Features in model order; ``carry`` columns stay in front."""
    filled = fill_defaults(df, fixed.TRANSACTION_DEFAULTS)
    named = filled.withColumn("CONTRACTDATA_WRITINGCODE", cleaning.list_first("CONTRACTDATA_WRITINGCODE"))
    known = login_features(named, fixed.TRANSACTION_LOGINS)
    levels = [
        f"emp_level_{i}"
        for i in range(1, len(fixed.TRANSACTION_LOGINS) + 1)
        if f"emp_level_{i}" not in fixed.TRANSACTION_UNUSED_LEVELS
    ]
    flags = {c: cleaning.as_flag(quoted(c)) for c in fixed.TRANSACTION_BOOLEAN}
    columns = [
        *carry, *fixed.TRANSACTION_CATEGORICAL, *fixed.TRANSACTION_NUMERIC,
        *fixed.TRANSACTION_BOOLEAN, *levels,
    ]
    return known.withColumns(flags).select(*[quoted(c) for c in columns])


def disposition(scored: DataFrame, probability: str, threshold: float) -> DataFrame:
    """(TRXNUM, predicted_disposition); the entity never left the row."""
    return scored.select(
        quoted(ENTITY), scoring.label(F.col(probability), threshold).alias("predicted_disposition")
    )


def score_applications(df: DataFrame, quantiles: QuantileTransform, encoder: TargetEncoder, model) -> DataFrame:
    features = quantiles.transform(application_features(df))
    encoded = encoder.transform(features, fixed.APPLICATION_CATEGORICAL)
    return disposition(model.score(encoded, "p"), "p", fixed.APPLICATION_THRESHOLD)


def score_transactions(df: DataFrame, scaler: Scaler, encoder: TargetEncoder, model) -> DataFrame:
    features = scaler.transform(transaction_features(df))
    encoded = encoder.transform(features, fixed.TRANSACTION_CATEGORICAL)
    return disposition(model.score(encoded, "p"), "p", fixed.TRANSACTION_THRESHOLD)
