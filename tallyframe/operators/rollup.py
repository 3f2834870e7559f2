"""A kept rollup of step sums, from which alert rules read only what their windows reach back to.

The rollup is a Parquet table ``(day, tick, sums...)`` partitioned by the day of the log rows. ``refresh`` sums the given days of a
log and replaces just their partitions, so a repeated run changes nothing and each day is read once. A step that
ends at midnight can have a row in two days; readers add them up. Several rules share one rollup.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.timing import second_of, tick_after
from tallyframe.operators.alerts import Rule, recent

DAY = "day"


def shared_sums(rules: Sequence[Rule]) -> dict[str, Column]:
    """The sums of all rules; the same name has to mean the same sum."""
    out: dict[str, Column] = {}
    for rule in rules:
        for name, column in rule.sums.items():
            if str(out.setdefault(name, column)) != str(column):
                raise ValueError(f"rules sum different things as {name}")
    return out


def refresh(log: DataFrame, path: str, rules: Sequence[Rule], day: str, days: Sequence[dt.date] | None = None, ts: str = "ts") -> str:
    """Sum the steps of the given ``days`` of a log (all of them if not given) into the rollup below ``path``.

    ``day`` names the date column the log is partitioned by, so only these days are read. All rules must have one step.
    """
    steps = {rule.step for rule in rules}
    if len(steps) != 1:
        raise ValueError("rules over one rollup need one step")
    rows = log if days is None else log.where(F.col(day).isin(list(days)))
    keyed = rows.where(F.col(ts).isNotNull()).withColumn("tick", tick_after(ts, steps.pop()))
    sums = [F.sum(c).alias(n) for n, c in shared_sums(rules).items()]
    out = keyed.groupBy(F.col(day).alias(DAY), "tick").agg(*sums)
    # one file per day: a day has as many rows as steps
    out.repartition(DAY).write.partitionBy(DAY).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return path


def step_sums(stored: DataFrame, sums: Mapping[str, Column] | Sequence[str], first: int, last: int, step: int) -> DataFrame:
    """Sums per step for ticks from ``first`` to ``last``; other days are not read."""
    days = [dt.datetime.fromtimestamp(t, dt.timezone.utc).date() for t in (first - step, last)]
    kept = stored.where(F.col(DAY).between(*days) & F.col("tick").between(first, last))
    return kept.groupBy("tick").agg(*[F.sum(n).alias(n) for n in sums])


def judge(
    spark: SparkSession, path: str, rule: Rule, start: dt.datetime, as_of: dt.datetime | None = None
) -> DataFrame:
    """Alert rows of the ticks after ``start`` up to ``as_of`` (or the last step kept), as the whole log would give them.

    Reads the days between ``start`` less window and hold time, and ``as_of``; besides, the ticks of the first day kept, as ticks begin
    with the first row of the log, and without ``as_of`` those of the last.
    """
    stored = spark.read.parquet(path)
    low, high = stored.agg(F.min(DAY), F.max(DAY)).first()
    if low is None:
        return recent(rule, stored, None, None, second_of(start))
    first = stored.where(F.col(DAY) == F.lit(low)).agg(F.min("tick")).first()[0]
    if as_of is None:
        last = stored.where(F.col(DAY) == F.lit(high)).agg(F.max("tick")).first()[0]
    else:
        last = second_of(as_of) // rule.step * rule.step
    begin = second_of(start) // rule.step * rule.step + rule.step
    sums = step_sums(stored, rule.sums, begin - rule.hold - rule.window, last, rule.step)
    return recent(rule, sums, first, last, second_of(start))
