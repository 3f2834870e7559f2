import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import quantiles
from tallyframe.operators.ordering import number_rows
from tallyframe.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def frame(spark, data):
    return spark.createDataFrame([(None if pd.isna(x) else float(x),) for x in data], "x double").repartition(4)


def shapes():
    rng = random.Random(5)
    yield "uniform", [rng.random() for _ in range(3000)]
    yield "hot value", [7.0] * 1500 + [rng.gauss(0, 5) for _ in range(1500)]
    yield "two hot ends", [1.0] * 1200 + [1.0 + i / 1000 for i in range(600)] + [2.0] * 1200
    yield "few values", [float(rng.randrange(4)) for _ in range(3000)]
    yield "with nulls", [None if i % 3 == 0 else rng.expovariate(1) for i in range(3000)]
    yield "outlier", [rng.random() for _ in range(2999)] + [1e12]


@pytest.mark.parametrize("name,data", list(shapes()), ids=[n for n, _ in shapes()])
@pytest.mark.parametrize("options", [{}, {"accuracy": 20, "bracket_rows": 40}], ids=["usual", "narrowed"])
def test_quantiles_match_pandas(spark, name, data, options):
    want = pd.Series(data, dtype=float).quantile(PROBS).tolist()
    got = exact_quantiles(frame(spark, data), ["x"], PROBS, **options)["x"]
    assert got == pytest.approx(want, rel=1e-12)


@pytest.mark.parametrize("options", [{}, {"bracket_rows": 1}])
@pytest.mark.parametrize("data,want", [([], [None]), ([None], [None]), ([3.0], [3.0]), ([1.0, 2.0], [1.5]), ([4.0] * 9, [4.0])])
def test_quantiles_of_small_columns(spark, data, want, options):
    assert exact_quantiles(frame(spark, data), ["x"], [0.5], **options)["x"] == want


def test_quantiles_of_several_columns(spark):
    df = spark.range(2000).select(F.col("id").alias("a"), (F.col("id") * F.col("id")).alias("b"))
    got = exact_quantiles(df, ["a", "b"], [0.5, 0.9], accuracy=50, bracket_rows=30)
    want = df.toPandas().quantile([0.5, 0.9])
    assert got["a"] == pytest.approx(want["a"].tolist()) and got["b"] == pytest.approx(want["b"].tolist())


def reads_of(monkeypatch, df, columns, probabilities, **options):
    """Quantiles and the number of reads of the table they took."""
    made = []
    real = quantiles._counted
    monkeypatch.setattr(quantiles, "_counted", lambda *args: made.append(1) or real(*args))
    got = exact_quantiles(df, columns, probabilities, **options)
    monkeypatch.setattr(quantiles, "_counted", real)
    return got, len(made)


def test_reads_do_not_depend_on_width(spark, monkeypatch):
    df = spark.range(3000).select(*[F.hash("id", F.lit(i % 4)).cast("double").alias(f"c{i}") for i in range(40)]).persist()
    options = {"accuracy": 64, "bracket_rows": 50}
    narrow, few = reads_of(monkeypatch, df, df.columns[:4], [0.25, 0.5, 0.75], **options)
    wide, many = reads_of(monkeypatch, df, df.columns, [0.25, 0.5, 0.75], **options)
    assert few == many <= 4
    want = df.toPandas().quantile([0.25, 0.5, 0.75])
    assert all(wide[c] == pytest.approx(want[c].tolist()) for c in df.columns) and narrow["c3"] == wide["c3"]
    df.unpersist()


def test_reads_do_not_depend_on_skew(spark, monkeypatch):
    rng = random.Random(8)
    data = [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(1500)] + [1.0 + i * 2.0**-52 for i in range(1500)]
    data += [0.0, -0.0, 5e-324, -5e-324, 1.7976931348623157e308, 3.5] * 20
    got, reads = reads_of(monkeypatch, frame(spark, data), ["x"], PROBS[:-2], bracket_rows=1)
    assert got["x"] == pytest.approx(pd.Series(data).quantile(PROBS[:-2]).tolist(), rel=1e-15) and reads <= 6


@pytest.mark.parametrize("limit", [10**6, 0], ids=["window", "ranged"])
def test_numbering_with_a_hot_key(spark, limit):
    rows = [("hot" if i % 3 else f"k{i % 30}", (i * 7919) % 10007, i) for i in range(4000)] + [(None, 1, 10**6)]
    df = spark.createDataFrame(rows, "k string, t long, id long").repartition(5)
    got = number_rows(df, ["k"], ["t", "id"], "no", window_rows=limit).toPandas()
    want = df.toPandas().sort_values(["t", "id"])
    want["no"] = want.groupby("k", dropna=False).cumcount() + 1
    merged = got.merge(want[["id", "no"]], on="id", suffixes=("", "_want"))
    assert len(got) == len(rows) and (merged.no == merged.no_want).all()


def test_numbering_without_keys(spark):
    df = spark.range(1000).repartition(6)
    got = number_rows(df, [], [F.col("id").desc()], "no").collect()
    assert all(r.no == 1000 - r.id for r in got)
