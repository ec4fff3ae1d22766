"""Column expressions shared by the operators."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text form of a run id, a UTC instant.
RUN_ID_PATTERN = "^[0-9]{8}T[0-9]{6}Z$"
RUN_ID_FORMAT = "yyyyMMdd'T'HHmmss'Z'"
_RUN_ID = "%Y%m%dT%H%M%SZ"


def yes_no(column: str) -> Column:
    """'Yes' is true, 'No' is false, any other text is NULL."""
    return F.expr(f"CASE `{column}` WHEN 'Yes' THEN true WHEN 'No' THEN false END")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that gives NULL for an empty denominator."""
    bottom = denominator.cast("double")
    return F.when(bottom != 0, numerator.cast("double") / bottom)


def count_where(condition: Column) -> Column:
    """Number of rows for which the condition is true (0 for no rows)."""
    return F.count(F.when(condition, True))


def check_fraction(fraction: float) -> float:
    if isinstance(fraction, bool) or not 0 < fraction <= 1:
        raise ValueError(f"K must be in (0, 1], got {fraction!r}")
    return float(fraction)


def top_k_count(rows: Column, fraction: float) -> Column:
    """How many rows the top fraction holds: at least one, exact halves go to even."""
    share = F.rint(rows.cast("double") * F.lit(check_fraction(fraction)))
    return F.greatest(F.lit(1), share.cast("bigint"))


def hash_order(key: Column, salt: int) -> Column:
    """A pseudo-random order, the same in every engine and partitioning: eight hex digits."""
    return F.substring(F.md5(F.concat(key.cast("string"), F.lit(f"|{salt}"))), 1, 8)


def is_run_id(text: Column) -> Column:
    """True only for text of the run-id shape that is also a real instant."""
    real = F.try_to_timestamp(text, F.lit(RUN_ID_FORMAT)).isNotNull()
    return F.coalesce(text.rlike(RUN_ID_PATTERN) & real, F.lit(False))


def run_id_of(instant: datetime) -> str:
    """The run id of an instant, in UTC."""
    return instant.astimezone(timezone.utc).strftime(_RUN_ID)


def require_run_id(text: str) -> str:
    """The text itself, or an error unless it is a run id."""
    try:
        if datetime.strptime(text, _RUN_ID).strftime(_RUN_ID) == text:
            return text
    except (TypeError, ValueError):
        pass
    raise ValueError(f"not a run id: {text!r}")


def log_loss_term(label: Column, probability: Column, clip: float = 1e-15) -> Column:
    p = F.greatest(F.lit(clip), F.least(F.lit(1.0 - clip), probability))
    return -F.when(label == 1, F.log(p)).otherwise(F.log(F.lit(1.0) - p))
