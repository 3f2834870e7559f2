"""Least squares from sums of products: one fit per group of rows, however many folds there are.

The sums of all products of two columns are kept per fold. What a fold is trained on is the total less its own
sums, so every fold's fit comes from the same scan; only these sums, a number per pair of columns, reach the
driver. Two scans make the sums (means first, so that products of centred values are added), one the metrics.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.cleaning import fold_of
from tallyframe.operators.evaluation import evaluate, fold_summary
from tallyframe.plans.training import ModelSpec

MAX_INPUTS = 2000
DEPENDENT = 1e-9  # an input is left out if the earlier ones leave less than this share of its variance


@dataclass(frozen=True)
class LinearFit:
    intercept: float
    coefficients: Mapping[str, float]

    def predict(self) -> Column:
        terms = [F.lit(b) * F.col(f"`{c}`") for c, b in self.coefficients.items() if b != 0]
        return reduce(lambda a, b: a + b, terms, F.lit(self.intercept))


def design(df: DataFrame, spec: ModelSpec, keep: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The columns ``keep`` and ``y`` with one number per input of the specification: plain or logged numbers, ratios
    and flags of all categories but the first. Rows in which one of them is missing, NaN or infinite are left out."""
    numbers = {c: F.col(f"`{c}`").cast("double") for c in spec.numeric}
    numbers |= {n: F.try_divide(F.col(f"`{a}`").cast("double"), F.col(f"`{b}`").cast("double")) for n, (a, b) in spec.ratios.items()}
    inputs = [F.when(x > -1, F.log1p(x)) if c in spec.log_columns else x for c, x in numbers.items()]
    names = list(numbers)
    needed = F.lit(True)
    if spec.category:
        needed = F.col(f"`{spec.category}`").isNotNull()
        rows = df.where(needed).select(F.col(f"`{spec.category}`").alias("c")).distinct().limit(MAX_INPUTS + 1).collect()
        for value in sorted(r.c for r in rows)[1:]:
            inputs.append((F.col(f"`{spec.category}`") == F.lit(value)).cast("double"))
            names.append(f"{spec.category}_{value}")
    if len(names) > MAX_INPUTS:
        raise ValueError(f"more than {MAX_INPUTS} inputs")
    own = [f"x{k}" for k in range(len(names))]
    out = df.where(needed).select(*keep, F.col(f"`{spec.target}`").cast("double").alias("y"), *[x.alias(c) for c, x in zip(own, inputs)])
    whole = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf")) for c in ["y", *own]]
    return out.where(reduce(and_, whole)), names


def product_sums(rows: DataFrame, width: int, group: str) -> tuple[dict[object, np.ndarray], np.ndarray]:
    """Per group the sums of products of ``1, x0 .., y`` less their means over all rows, and these means."""
    columns = [*[f"x{k}" for k in range(width)], "y"]
    means = rows.agg(*[F.avg(c).alias(c) for c in columns]).first()
    shift = np.array([means[c] or 0.0 for c in columns])
    first, second = np.triu_indices(width + 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict = {}
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]], axis=1) - shift
            x = np.hstack([np.ones((len(x), 1)), x])
            coded = batch.column(0).dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False)
            for code, value in enumerate(coded.dictionary.to_pylist()):
                part = x[codes == code]
                totals[value] = totals.get(value, 0) + part.T @ part
        for value, total in totals.items():
            arrays = [pa.array([value] * len(first), kind), pa.array(first.astype(np.int32)), pa.array(second.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(total[first, second])], ["g", "i", "j", "v"])

    named = rows.select(F.col(group).alias("g"), *columns).where("g is not null")
    sql_kind = named.schema["g"].dataType.simpleString()
    kind = pa.string() if sql_kind == "string" else pa.int32()
    parts = named.mapInArrow(run, f"g {'string' if sql_kind == 'string' else 'int'}, i int, j int, v double")
    sums: dict[object, np.ndarray] = {}
    for r in parts.groupBy("g", "i", "j").agg(F.sum("v").alias("v")).collect():
        one = sums.setdefault(r.g, np.zeros((width + 2, width + 2)))
        one[r.i, r.j] = one[r.j, r.i] = r.v
    return sums, shift


def solve(sums: np.ndarray, shift: np.ndarray) -> LinearFit | None:
    """The least-squares fit; None without rows. Constant inputs, and those that earlier inputs determine, get 0."""
    n, width = sums[0, 0], len(shift) - 1
    if n < 1:
        return None
    spread = sums[1:, 1:] - np.outer(sums[0, 1:], sums[0, 1:]) / n
    rest, kept = spread[:width, :width].copy(), []
    for j in range(width):
        # rounding of the sums themselves must not pass for variance
        if rest[j, j] > DEPENDENT * spread[j, j] and spread[j, j] > 1e-12 * sums[j + 1, j + 1]:
            kept.append(j)
            rest -= np.outer(rest[:, j], rest[j, :]) / rest[j, j]
    b = np.zeros(width)
    if kept:
        size = np.sqrt(np.diag(spread)[kept])
        b[kept] = np.linalg.solve(spread[np.ix_(kept, kept)] / np.outer(size, size), spread[kept, width] / size) / size
    cut = shift[-1] + (sums[0, -1] - b @ sums[0, 1:-1]) / n - b @ shift[:-1]
    return LinearFit(float(cut), {f"x{k}": float(v) for k, v in enumerate(b)})


def _predicted(rows: DataFrame, fits: Mapping[object, LinearFit | None], group: str) -> DataFrame:
    """``group, y, y_hat``: every row by the fit of its group; groups without a fit are left out."""
    known = [F.when(F.col(group) == F.lit(g), fit.predict()) for g, fit in fits.items() if fit is not None]
    return rows.select(group, "y", F.coalesce(*known, F.lit(None).cast("double")).alias("y_hat")).where("y_hat is not null")


def cross_validate_sums(df: DataFrame, key: Column | str, spec: ModelSpec, folds: int = 5, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Metrics of each fold for a linear model trained on the others, and their mean and deviation.

    Fold membership is a hash of the key. Missing numbers are not filled: such rows take no part. A fold whose
    other folds are empty has no row.
    """
    rows, names = design(df.withColumn("_fold", fold_of(key, folds, seed)), spec, ["_fold"])
    sums, shift = product_sums(rows, len(names), "_fold")
    total = sum(sums.values()) if sums else None
    fits = {f: solve(total - own, shift) for f, own in sums.items()}
    per_fold = evaluate(_predicted(rows, fits, "_fold"), ["_fold"]).withColumnRenamed("_fold", "fold")
    return per_fold, fold_summary(per_fold)


def train_sums(labelled: DataFrame, spec: ModelSpec, split: str = "split") -> tuple[LinearFit | None, DataFrame]:
    """The fit of the train rows by input name, and the metrics of each side."""
    rows, names = design(labelled, spec, [split])
    sums, shift = product_sums(rows, len(names), split)
    fit = solve(sums["train"], shift) if "train" in sums else None
    scores = evaluate(_predicted(rows, {s: fit for s in sums}, split), [split])
    named = fit and LinearFit(fit.intercept, dict(zip(names, fit.coefficients.values())))
    return named, scores
