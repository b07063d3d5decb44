"""Monitoring analytics over tables of states and events. No clock is read: as_of is a parameter, zoneless times are UTC."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .ranks import running_total

#: Names of the databases that a server keeps for itself.
SYSTEM = ("master", "model", "msdb", "tempdb", "distribution")
#: Outcomes of a job's run by its status.
OUTCOMES = {0: "Failed", 1: "Succeeded", 2: "Retry", 3: "Cancelled", 4: "InProgress"}


#: Keys that one task may sum.
FEW = 100_000


@dataclass(frozen=True)
class Ages:
    """How old the last of each kind may be."""

    full: datetime.timedelta = datetime.timedelta(days=1)
    differential: datetime.timedelta = datetime.timedelta(days=1)
    log: datetime.timedelta = datetime.timedelta(hours=1)
    check: datetime.timedelta = datetime.timedelta(days=7)


def pareto(df: DataFrame, key: str, amount: Column, percent: float = 80.0, floor: float = 1.0, ranges: int | None = None) -> DataFrame:
    """Sum by key with share and running share of the total; keys until the running share exceeds percent, or
    with a share of at least floor. Ties by key. Shares are null where the total is 0. The running sum is distributed:
    there may be as many keys as rows; up to FEW of them are summed by one task."""
    sums = cut(df.groupBy(key).agg(F.sum(amount).alias("amount")))
    total = F.broadcast(sums.agg(F.nullif(F.sum("amount"), F.lit(0).cast("decimal(38,2)")).cast("double").alias("_total")))  # one row
    order = [F.col("amount").desc(), F.col(key)]
    if ranges is None and sums.count() <= FEW:
        ran = sums.withColumn("_running", F.sum("amount").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))).join(total)
    else:
        ran = running_total(sums, F.col("amount"), order, "_running", ranges).join(total)
    out = ran.withColumn("pct", F.lit(100.0) * F.col("amount").cast("double") / F.col("_total")).withColumn("running", F.lit(100.0) * F.col("_running").cast("double") / F.col("_total"))
    return out.where((F.col("running") <= percent) | (F.col("pct") >= floor)).drop("_running", "_total")


def shares(df: DataFrame, key: str, amount: Column) -> DataFrame:
    """Sum by key and its share of the total in percent, null where that is 0."""
    sums = df.groupBy(key).agg(F.sum(amount).alias("amount"))
    total = df.agg(F.nullif(F.sum(amount), F.lit(0).cast("decimal(38,2)")).alias("_total"))  # one row
    return sums.join(F.broadcast(total)).withColumn("pct", F.lit(100.0) * F.col("amount").cast("double") / F.col("_total").cast("double")).drop("_total")


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by order."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")


def age(time: Column, as_of: Column) -> Column:
    """as_of - time in seconds; null for null."""
    return F.timestamp_diff("SECOND", time, as_of)


def _older(time: Column, as_of: Column, most: datetime.timedelta) -> Column:
    """Whether time is further back than that; false for null."""
    return F.coalesce(time.cast("timestamp_ntz") < as_of.cast("timestamp_ntz") - F.lit(most), F.lit(False))


def freshness(last_full: Column, last_differential: Column, last_log: Column, created: Column, as_of: Column, needs_log: Column, ages: Ages = Ages()) -> Column:
    """Status ladder: New or MissingFull without a full one, FullOverdue, LogOverdue (where logs are needed; none is
    overdue), DifferentialOld, Ok."""
    return (
        F.when(last_full.isNull() & created.isNotNull() & ~_older(created, as_of, ages.full), "New")
        .when(last_full.isNull(), "MissingFull")
        .when(_older(last_full, as_of, ages.full), "FullOverdue")
        .when(F.coalesce(needs_log, F.lit(False)) & (last_log.isNull() | _older(last_log, as_of, ages.log)), "LogOverdue")
        .when(_older(last_differential, as_of, ages.differential), "DifferentialOld")
        .otherwise("Ok")
    )


def check_status(last_good: Column, created: Column, error: Column, as_of: Column, ages: Ages = Ages()) -> Column:
    """Status ladder of integrity checks: Unknown if looking failed, New or Missing without one, Overdue, Ok."""
    return (
        F.when(F.trim(F.coalesce(error, F.lit(""))) != "", "Unknown")
        .when(last_good.isNull() & created.isNotNull() & ~_older(created, as_of, ages.check), "New")
        .when(last_good.isNull(), "Missing")
        .when(_older(last_good, as_of, ages.check), "Overdue")
        .otherwise("Ok")
    )


def database_states(databases: DataFrame, include_system: bool = False, system: tuple[str, ...] = SYSTEM) -> DataFrame:
    """databases (name, state, is_read_only, ..) with read_write and is_system; the system's own only if asked for."""
    out = databases.withColumn("read_write", F.when(F.col("is_read_only"), "READ_ONLY").otherwise("READ_WRITE")).withColumn("is_system", F.col("name").isin(*system))
    return out if include_system else out.where(~F.col("name").isin(*system))


def backup_freshness(databases: DataFrame, backups: DataFrame, as_of: Column, ages: Ages = Ages()) -> DataFrame:
    """databases (name, created, recovery_model) with the last backup of each type in backups (name, type D, I or L,
    finished) and status; full recovery and bulk-logged need logs."""
    last = backups.groupBy("name").agg(*[F.max(F.when(F.col("type") == t, F.col("finished"))).alias(c) for t, c in (("D", "last_full"), ("I", "last_differential"), ("L", "last_log"))])
    found = databases.join(last, "name", "left")
    needs = F.upper("recovery_model").isin("FULL", "BULK_LOGGED")
    return found.withColumn("status", freshness(F.col("last_full"), F.col("last_differential"), F.col("last_log"), F.col("created"), as_of, needs, ages))


def check_freshness(databases: DataFrame, checks: DataFrame, as_of: Column, ages: Ages = Ages()) -> DataFrame:
    """databases (name, created) with the last good check in checks (name, finished, error) and status; an error of the
    latest attempt makes it Unknown."""
    attempt = F.struct("finished", "error")
    last = checks.groupBy("name").agg(F.max(F.when(F.col("error").isNull(), F.col("finished"))).alias("last_good"), F.max(attempt)["error"].alias("error"))
    found = databases.join(last, "name", "left")
    return found.withColumn("status", check_status(F.col("last_good"), F.col("created"), F.col("error"), as_of, ages))


def job_health(jobs: DataFrame, categories: DataFrame, history: DataFrame, activity: DataFrame, include_disabled: bool = False) -> DataFrame:
    """jobs (job_id, name, category_id, enabled) with their category (category_id, category), the outcome and time of
    the last whole run in history (job_id, instance_id, step_id, run_status, run_at, run_clock HHMMSS), and whether they
    run in the latest session of activity (job_id, session_id, started, stopped)."""
    ran = latest(history.where("step_id = 0"), ["job_id"], [F.col("instance_id").desc()])
    outcome = F.create_map(*[F.lit(x) for kv in OUTCOMES.items() for x in kv])[F.col("run_status")]
    clock = F.col("run_clock").cast("long")
    ran = ran.select("job_id", F.col("run_at").alias("last_run"), outcome.alias("last_outcome"), (F.floor(clock / 10000) * 3600 + F.floor(clock / 100) % 100 * 60 + clock % 100).alias("last_seconds"))
    current = activity.agg(F.max("session_id").alias("session_id"))  # one row
    now = latest(activity.join(F.broadcast(current), "session_id").where("started IS NOT NULL"), ["job_id"], [F.col("started").desc()]).select("job_id", "started", "stopped")
    found = jobs.join(categories, "category_id", "left").join(ran, "job_id", "left").join(now, "job_id", "left")
    running = F.col("started").isNotNull() & F.col("stopped").isNull()
    found = found.select("job_id", "name", "category", "enabled", running.alias("is_running"), F.when(running, F.col("started")).alias("current_start"), "last_run", "last_outcome", "last_seconds")
    return found if include_disabled else found.where("enabled")


def availability(groups: DataFrame, replicas: DataFrame, replica_states: DataFrame, database_states_: DataFrame, enabled: bool = True) -> DataFrame:
    """A row for each replica of each group (group_id) and database of it (replica_id), with states where there are any;
    no rows where the feature is off."""
    found = groups.join(replicas, "group_id").join(replica_states, "replica_id", "left").join(database_states_, "replica_id", "left")
    found = found.withColumn("is_suspended", F.coalesce("is_suspended", F.lit(False)))
    return found if enabled else found.limit(0)


def snapshot(sections: dict[str, Callable[[], DataFrame]], wanted: set[str] | None = None, connected: Callable[[], bool] | None = None) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Sections (name -> function giving a DataFrame) that could be made, and the errors of those that couldn't. Each is
    computed here, once, and kept, so what fails when it runs is an error of its section too. Nothing is tried if the
    source doesn't answer."""
    made, errors = {}, {}
    if connected is not None:
        try:
            if not connected():
                return {}, {"connection": "not connected"}
        except Exception as error:
            return {}, {"connection": f"{type(error).__name__}: {error}"}
    for name, make in sections.items():
        if wanted is None or name in wanted:
            try:
                made[name] = cut(make())
            except Exception as error:  # a section's failure is a result here
                errors[name] = f"{type(error).__name__}: {str(error).splitlines()[0] if str(error) else ''}"
    return made, errors
