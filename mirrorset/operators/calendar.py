"""Farm visits: control types, dates, steps, laboratory dates and slots."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorset.config import DEFAULT_LIMITS, Limits
from mirrorset.functions.dates import add_days, subtract_years
from mirrorset.functions.draws import coin, hash_u60, scale_u60
from mirrorset.operators.keys import first_per_key, running_total
from mirrorset.operators.profile import profile
from mirrorset.operators.sample import sample_from

# Fixed values of the data model.
CONTROL_TYPES = [1, 2, 9, 10]
FOUR_WEEK_TYPES = [1, 9]
SHARED_SLOT_TYPES = [1, 2]
ALTERNATING_TYPES = [9, 10]
SHORT_STEP, LONG_STEP = 28, 42
VISIT_START = 700_000
YEARS = 5


def control_types(
    farms: DataFrame,
    visits: DataFrame,
    farm_id: str,
    visit_farm: str,
    visit_type: str,
    visit_order: Sequence[str],
    seed: int,
    allowed: Sequence = tuple(CONTROL_TYPES),
    filter_first: bool = True,
    name: str = "control_type",
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Draw each farm's control type from the first type of every source farm.

    ``filter_first=False`` takes a farm's first visit before the types are
    restricted to the allowed ones, which loses farms that start otherwise.
    """
    usable = F.col(visit_type).isin(list(allowed))
    source = visits.where(usable) if filter_first else visits
    first = first_per_key(source, [visit_farm], visit_order, [visit_type]).where(usable)
    draw = hash_u60(seed, "control type", F.col(farm_id))
    return sample_from(farms, profile(first, visit_type, limits=limits), {}, draw, name)


def step_days(control_type: Column, short_types: Sequence = tuple(FOUR_WEEK_TYPES)) -> Column:
    return F.when(control_type.isin(list(short_types)), F.lit(SHORT_STEP)).otherwise(F.lit(LONG_STEP))


def visit_plan(
    farms: DataFrame, farm_id: str, as_of: date, step: Column, seed: int, years: int = YEARS
) -> DataFrame:
    """Per farm the first visit date ``first_visit``, ``step`` and number ``n_visits``."""
    last = F.lit(as_of)
    start = subtract_years(last, years)
    span = F.datediff(last, start) + 1
    draw = hash_u60(seed, "first visit", F.col(farm_id))
    planned = farms.withColumn("first_visit", add_days(start, scale_u60(draw, span))).withColumn("step", step)
    room = F.floor(F.datediff(last, F.col("first_visit")) / F.col("step")) + 1
    cap = F.floor(F.lit(365 * years) / F.col("step")) + 1
    return planned.withColumn("n_visits", F.least(room, cap).cast("int"))


def visit_calendar(plan: DataFrame, date_column: str = "visit_date") -> DataFrame:
    """One row per planned visit, with its position ``pos`` from 0."""
    visits = plan.withColumn("pos", F.explode(F.sequence(F.lit(0), F.col("n_visits") - 1)))
    return visits.withColumn(date_column, add_days(F.col("first_visit"), F.col("pos") * F.col("step")))


def visit_ids(
    plan: DataFrame,
    farm_id: str,
    start: int = VISIT_START,
    name: str = "visit_id",
    n_farms: int | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Calendar with consecutive ids in the order (farm, date).

    The running sum is taken over farms, before the visits are laid out.
    """
    summed = running_total(plan, [farm_id], F.col("n_visits"), "_end", (), n_farms, limits)
    visits = visit_calendar(summed.withColumn("_start", F.col("_end") - F.col("n_visits")))
    return visits.withColumn(name, F.lit(start) + F.col("_start") + F.col("pos")).drop("_start", "_end")


def control_steps(
    visits: DataFrame,
    source: DataFrame,
    source_step: str,
    row_keys: Sequence[str],
    seed: int,
    name: str,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Draw the control step of each visit from the shares of the source."""
    draw = hash_u60(seed, "control step", *[F.col(k) for k in row_keys])
    return sample_from(visits, profile(source, source_step, limits=limits), {}, draw, name)


def last_period(df: DataFrame, day: str, months: int = 12) -> DataFrame:
    """Rows of the last months up to the latest date in the data, both ends included."""
    latest = df.agg(F.max(day).alias("latest")).select("latest").scalar()
    return df.where(F.col(day).between(F.add_months(latest, -months), latest))


def mean_lag(df: DataFrame, start: str, end: str, months: int = 12) -> DataFrame:
    """One row: mean days from start to end in the last months, rounded half to even."""
    days = F.datediff(F.col(end), F.col(start))
    return last_period(df, start, months).agg(F.bround(F.avg(days)).cast("int").alias("mean_lag"))


def lab_dates(visits: DataFrame, day: str, lag: DataFrame, name: str = "lab_date") -> DataFrame:
    """Reception date: visit date plus the one-row mean lag."""
    return visits.withColumn(name, add_days(F.col(day), lag.scalar()))


def alternating_slot(pos: Column, farm: Column, seed: int) -> Column:
    """AM and PM in turn along a farm's visits, starting with either."""
    return coin(pos + hash_u60(seed, "slot start", farm) % 2, "AM", "PM")


def slots(
    visits: DataFrame,
    source: DataFrame,
    source_type: str,
    source_slot: str,
    control_type: str,
    farm_id: str,
    seed: int,
    shared: Sequence = tuple(SHARED_SLOT_TYPES),
    alternating: Sequence = tuple(ALTERNATING_TYPES),
    name: str = "slot",
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Milking slot: by source shares for some control types, in turn for others."""
    prof = profile(source.where(F.col(source_type).isin(list(shared))), source_slot, limits=limits)
    draw = hash_u60(seed, "slot", F.col(farm_id), F.col("pos"))
    drawn = sample_from(visits, prof, {}, draw, "_drawn")
    slot = F.when(F.col(control_type).isin(list(shared)), F.col("_drawn")).when(
        F.col(control_type).isin(list(alternating)), alternating_slot(F.col("pos"), F.col(farm_id), seed)
    )
    return drawn.withColumn(name, slot).drop("_drawn")
