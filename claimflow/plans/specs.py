"""What differs between the claim models."""

from __future__ import annotations

from dataclasses import dataclass

from claimflow import fixed_values as fixed


@dataclass(frozen=True)
class ModelSpec:
    columns: tuple[str, ...]
    dates: tuple[str, ...]
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    required: tuple[str, ...]
    prior_original: float | None = None
    prior_train: float | None = None
    threshold: float = 0.5


STD = ModelSpec(
    tuple(fixed.STD_COLUMNS), tuple(fixed.STD_DATES), tuple(fixed.STD_NUMERIC),
    tuple(fixed.STD_CATEGORICAL), tuple(fixed.STD_REQUIRED),
    fixed.STD_PRIOR_ORIGINAL, fixed.STD_PRIOR_TRAIN,
)
LTD = ModelSpec(
    tuple(fixed.LTD_COLUMNS), tuple(fixed.LTD_DATES), tuple(fixed.LTD_NUMERIC),
    tuple(fixed.LTD_CATEGORICAL), tuple(fixed.LTD_REQUIRED),
)
SETTLEMENT = ModelSpec(
    tuple(fixed.SETTLEMENT_COLUMNS), tuple(fixed.SETTLEMENT_DATES),
    tuple(fixed.SETTLEMENT_NUMERIC), tuple(fixed.SETTLEMENT_ONE_HOT),
    tuple(fixed.SETTLEMENT_REQUIRED),
    fixed.SETTLEMENT_PRIOR_ORIGINAL, fixed.SETTLEMENT_PRIOR_TRAIN,
)
