"""Feature steps as ML stages, so that a fitted chain is saved and loaded as one model.

``ColumnRecipe`` is the only transformer: a step name plus JSON-able constants. The
estimators fit the constants where a step needs data (population deviation, alphabetical
codes and so on, where the built-in stages define things differently).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.numeric import log1p_or_null, numeric_columns, ratio, right_closed_label, sqrt_or_null
from tallyframe.operators import features as feat
from tallyframe.operators.cleaning import fill_constants, medians


def _flag_vector(df: DataFrame, column: str, values: Sequence[str], out: str) -> DataFrame:
    """0/1 vector with one slot per value; NULL and unseen values set none."""
    slots = [F.coalesce(F.col(column) == F.lit(v), F.lit(False)).cast("double") for v in values]
    names = [{"idx": i, "name": f"{column}_{v}"} for i, v in enumerate(values)]
    attributes = {"ml_attr": {"attrs": {"binary": names}, "num_attrs": len(names)}}
    flags = array_to_vector(F.array(*slots).cast("array<double>"))
    return df.withColumn(out, flags).withMetadata(out, attributes)


STEPS = {
    "fill": lambda df, values: fill_constants(df, values),
    "ratios": lambda df, ratios: df.withColumns({n: ratio(a, b) for n, (a, b) in ratios.items()}),
    "labels": lambda df, column, edges, labels, out: df.withColumn(out, right_closed_label(column, edges, labels)),
    "log1p": lambda df, columns: df.withColumns({f"{c}_log": log1p_or_null(c) for c in columns}),
    "sqrt": lambda df, columns: df.withColumns({f"{c}_sqrt": sqrt_or_null(c) for c in columns}),
    "powers": lambda df, columns, degree: feat.poly_features(df, columns, degree),
    "scale": lambda df, stats: feat.apply_scaler(df, stats),
    "codes": lambda df, column, values: df.withColumn(f"{column}_encoded", feat.label_code(column, values)),
    "flags": _flag_vector,
    "flag_columns": lambda df, column, values: feat.one_hot(df, column, values),
    "select": lambda df, columns: df.select(*[c for c in columns if c in df.columns]),
}


class ColumnRecipe(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A named step with its constants."""

    step = Param(Params._dummy(), "step", "name of the step")
    constants = Param(Params._dummy(), "constants", "arguments of the step")

    def __init__(self, step: str | None = None, constants: Mapping | None = None):
        super().__init__()
        if step is not None:
            if step not in STEPS:
                raise ValueError(f"unknown step {step}")
            self._set(step=step, constants=dict(constants or {}))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return STEPS[self.getOrDefault("step")](dataset, **self.getOrDefault("constants"))


class _Fitted(Estimator):
    """Estimator whose model is a recipe."""

    def recipe(self, df: DataFrame) -> ColumnRecipe:
        raise NotImplementedError

    def _fit(self, dataset: DataFrame) -> ColumnRecipe:
        return self.recipe(dataset)


class MedianFiller(_Fitted):
    def __init__(self, columns: Sequence[str]):
        super().__init__()
        self.columns = list(columns)

    def recipe(self, df):
        return ColumnRecipe("fill", {"values": medians(df, self.columns)})


class ColumnScaler(_Fitted):
    """``standard`` uses the population deviation; a constant column is divided by 1."""

    def __init__(self, columns: Sequence[str] | None = None, kind: str = "standard", exclude: Sequence[str] = ()):
        super().__init__()
        self.columns, self.kind, self.exclude = columns, kind, list(exclude)

    def recipe(self, df):
        columns = numeric_columns(df, self.exclude) if self.columns is None else self.columns
        stats = {c: list(ms) for c, ms in feat.fit_scaler(df, columns, self.kind).items()}
        return ColumnRecipe("scale", {"stats": stats})


class CategoryFlags(_Fitted):
    """One slot per category in a vector column; the alphabetically first can be dropped."""

    def __init__(self, column: str, out: str | None = None, drop_first: bool = True, cap: int = feat.MAX_FLAG_COLUMNS):
        super().__init__()
        self.column, self.out, self.drop_first, self.cap = column, out or f"{column}_flags", drop_first, cap

    def recipe(self, df):
        values = feat.categories(df, self.column, self.cap)
        if values is None:
            raise ValueError(f"{self.column} has more than {self.cap} categories")
        values = values[1:] if self.drop_first else values
        return ColumnRecipe("flags", {"column": self.column, "values": values, "out": self.out})


class CategoryColumns(_Fitted):
    """One boolean column per category."""

    def __init__(self, column: str, cap: int = feat.MAX_FLAG_COLUMNS):
        super().__init__()
        self.column, self.cap = column, cap

    def recipe(self, df):
        values = feat.categories(df, self.column, self.cap)
        if values is None:
            raise ValueError(f"{self.column} has more than {self.cap} categories")
        return ColumnRecipe("flag_columns", {"column": self.column, "values": values})


class CategoryCodes(_Fitted):
    """Alphabetical codes for a short category list, with NULL as a class of its own."""

    def __init__(self, column: str):
        super().__init__()
        self.column = column

    def recipe(self, df):
        values = feat.categories(df, self.column, feat.SMALL_CATEGORY, "nan")
        if values is None:
            raise ValueError(f"{self.column} has too many categories for a saved code table; use label_encode")
        return ColumnRecipe("codes", {"column": self.column, "values": values})


class VarianceKeeper(_Fitted):
    def __init__(self, target: str, threshold: float = 0.01, keep: Sequence[str] = ()):
        super().__init__()
        self.target, self.threshold, self.keep = target, threshold, list(keep)

    def recipe(self, df):
        numeric = numeric_columns(df, [self.target, *self.keep])
        kept = feat.high_variance_columns(df, numeric, self.threshold)
        other = [c for c in df.columns if c not in numeric and c not in self.keep and c != self.target]
        return ColumnRecipe("select", {"columns": [*self.keep, *kept, *other, self.target]})


def feature_stages(
    target: str = "median_house_value", keep: Sequence[str] = (), polynomial: bool = False, scaler: str = "standard"
) -> list:
    """The feature chain as stages of a ``pyspark.ml.Pipeline``."""
    stages = [
        ColumnRecipe("ratios", {"ratios": {n: list(ab) for n, ab in feat.HOUSEHOLD_RATIOS.items()}}),
        ColumnRecipe(
            "labels",
            {
                "column": "median_income",
                "edges": list(feat.INCOME_EDGES),
                "labels": list(feat.INCOME_LABELS),
                "out": "income_category",
            },
        ),
        ColumnRecipe(
            "labels",
            {
                "column": "housing_median_age",
                "edges": list(feat.AGE_EDGES),
                "labels": list(feat.AGE_LABELS),
                "out": "age_category",
            },
        ),
        ColumnRecipe("log1p", {"columns": list(feat.SKEWED)}),
        ColumnRecipe("sqrt", {"columns": list(feat.SKEWED)}),
        CategoryColumns("ocean_proximity"),
        CategoryCodes("income_category"),
        CategoryCodes("age_category"),
    ]
    if polynomial:
        stages.append(ColumnRecipe("powers", {"columns": ["median_income", "housing_median_age"], "degree": 2}))
    stages.append(ColumnScaler(kind=scaler, exclude=[target, *keep]))
    stages.append(VarianceKeeper(target, keep=keep))
    return stages
