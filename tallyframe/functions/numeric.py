"""Column builders for arithmetic, binning and distribution moments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def category_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """Quotient, NULL for a zero denominator."""
    return F.try_divide(_col(top), _col(bottom))


def round_to(c: Column | str, digits: int) -> Column:
    """Round half away from zero on the scaled value, the way SQL engines with binary doubles do."""
    scale = float(10**digits)
    return F.round(_col(c) * F.lit(scale)) / F.lit(scale)


def right_closed_label(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval ``(edges[i], edges[i+1]]``; one label more than inner edges means open top.

    Values at or below the first edge and NULL get NULL.
    """
    c = _col(c)
    uppers = list(edges[1:]) + [None] * (len(labels) - len(edges) + 1)
    out = F.when(c <= F.lit(float(edges[0])), F.lit(None).cast("string"))
    for upper, label in zip(uppers, labels):
        inside = c.isNotNull() if upper is None else c <= F.lit(float(upper))
        out = out.when(inside, F.lit(label))
    return out


def log1p_or_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c > -1, F.log1p(c))


def sqrt_or_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c >= 0, F.sqrt(c))


def capped(c: Column | str, cap: float) -> Column:
    """``min(c, cap)`` that keeps NULL (``least`` would turn it into the cap)."""
    c = _col(c)
    return F.when(c > F.lit(float(cap)), F.lit(float(cap))).otherwise(c)


def as_number(c: Column | str) -> Column:
    """Text to double, NULL where the text is not a number or is NaN."""
    value = _col(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def ms_to_seconds(c: Column | str) -> Column:
    return _col(c) / F.lit(1000.0)


def adjusted_skewness(c: Column | str) -> Column:
    """Sample skewness corrected for bias (aggregate); NULL below three values or zero spread."""
    c = _col(c)
    n = F.count(c).cast("double")
    g1 = F.when(F.var_pop(c) > 0, F.skewness(c))
    return F.when(F.count(c) >= 3, g1 * F.sqrt(n * F.greatest(n - 1, F.lit(0.0))) / F.nullif(n - 2, F.lit(0.0)))


def adjusted_kurtosis(c: Column | str) -> Column:
    """Excess kurtosis corrected for bias (aggregate); NULL below four values or zero spread."""
    c = _col(c)
    n = F.count(c).cast("double")
    g2 = F.when(F.var_pop(c) > 0, F.kurtosis(c))
    bottom = F.nullif((n - 2) * (n - 3), F.lit(0.0))
    return F.when(F.count(c) >= 4, (n - 1) / bottom * ((n + 1) * g2 + 6))


def pairwise_corr(a: Column | str, b: Column | str) -> Column:
    """Pearson correlation over rows where both are present (aggregate); NULL for a constant side."""
    a, b = _col(a), _col(b)
    spread = F.sqrt(F.regr_sxx(a, b) * F.regr_syy(a, b))
    return F.regr_sxy(a, b) / F.nullif(spread, F.lit(0.0))
