"""Row validation: rule sets as column predicates, errors as an array per row.

A field reports at most one error, its first failing check. Cross-field checks run only
where both fields are otherwise valid. Errors come in field order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ERROR_TYPE = "array<struct<field:string,message:string,type:string>>"

# Legal categories, in declaration order.
OCEAN_PROXIMITY = ("NEAR BAY", "<1H OCEAN", "INLAND", "NEAR OCEAN", "ISLAND")
NUMERIC_FIELDS = (
    "longitude",
    "latitude",
    "housing_median_age",
    "total_rooms",
    "total_bedrooms",
    "population",
    "households",
    "median_income",
)
CATEGORY_FIELD = "ocean_proximity"


@dataclass(frozen=True)
class Check:
    """A condition that must hold, with the message and type reported when it does not."""

    holds: Callable[[Column], Column]
    message: str
    type: str


@dataclass(frozen=True)
class CrossCheck:
    """A condition on two fields, reported on the first; skipped unless the second is valid."""

    other: str
    holds: Callable[[Column, Column], Column]
    message: str


@dataclass(frozen=True)
class FieldRule:
    name: str
    checks: tuple[Check, ...] = ()
    cross: tuple[CrossCheck, ...] = ()


@dataclass(frozen=True)
class RuleSet:
    name: str
    rules: tuple[FieldRule, ...] = field(default_factory=tuple)

    def without_cross(self) -> "RuleSet":
        return RuleSet(self.name, tuple(FieldRule(r.name, r.checks) for r in self.rules))


def _num(v: float) -> str:
    return f"{v:g}"


def at_least(v: float) -> Check:
    return Check(lambda c: (c >= F.lit(float(v))) & ~F.isnan(c), f"Input should be greater than or equal to {_num(v)}", "greater_than_equal")


def at_most(v: float) -> Check:
    return Check(lambda c: (c <= F.lit(float(v))) & ~F.isnan(c), f"Input should be less than or equal to {_num(v)}", "less_than_equal")


def above(v: float) -> Check:
    return Check(lambda c: (c > F.lit(float(v))) & ~F.isnan(c), f"Input should be greater than {_num(v)}", "greater_than")


def custom(holds: Callable[[Column], Column], message: str) -> Check:
    return Check(holds, f"Value error, {message}", "value_error")


def one_of(values: Sequence[str]) -> Check:
    listed = ", ".join(f"'{v}'" for v in values[:-1]) + f" or '{values[-1]}'"
    return Check(lambda c: c.isin(*values), f"Input should be {listed}", "enum")


def _ranged(name: str, low: float, high: float | None = None, *more: Check, cross: tuple[CrossCheck, ...] = ()):
    checks = (at_least(low),) + (() if high is None else (at_most(high),)) + more
    return FieldRule(name, checks, cross)


# The three published rule sets.
STRICT = RuleSet(
    "strict",
    (
        _ranged("longitude", -124.6, -114.1),
        _ranged("latitude", 32.5, 42.0),
        _ranged("housing_median_age", 0, 100),
        _ranged("total_rooms", 1),
        _ranged(
            "total_bedrooms",
            1,
            cross=(CrossCheck("total_rooms", lambda v, o: v <= o, "Total bedrooms cannot exceed total rooms"),),
        ),
        _ranged("population", 1),
        _ranged(
            "households",
            1,
            cross=(CrossCheck("population", lambda v, o: v <= o, "Number of households cannot exceed population"),),
        ),
        _ranged("median_income", 0),
        FieldRule(CATEGORY_FIELD, (one_of(OCEAN_PROXIMITY),)),
    ),
)
BUSINESS = RuleSet(
    "business",
    (
        _ranged(
            "longitude",
            -180,
            180,
            custom(
                lambda c: c.between(-124.5, -114.0), "Longitude should be within California bounds (-124.5 to -114.0)"
            ),
        ),
        _ranged(
            "latitude",
            -90,
            90,
            custom(lambda c: c.between(32.0, 42.0), "Latitude should be within California bounds (32.0 to 42.0)"),
        ),
        _ranged("housing_median_age", 0, 100),
        FieldRule("total_rooms", (above(0),)),
        FieldRule(
            "total_bedrooms",
            (above(0),),
            (CrossCheck("total_rooms", lambda v, o: v <= o, "total_bedrooms cannot exceed total_rooms"),),
        ),
        FieldRule("population", (above(0),)),
        FieldRule(
            "households",
            (above(0),),
            (
                CrossCheck(
                    "population",
                    lambda v, o: F.try_divide(o, v) <= 20.0,
                    "Average household size seems unrealistic (>20 people/household)",
                ),
                CrossCheck(
                    "population",
                    lambda v, o: F.try_divide(o, v) >= 0.5,
                    "Average household size seems unrealistic (<0.5 people/household)",
                ),
            ),
        ),
        FieldRule("median_income", (above(0),)),
        FieldRule(CATEGORY_FIELD, (one_of(OCEAN_PROXIMITY),)),
    ),
)
DOCUMENTED = RuleSet(
    "documented",
    (
        _ranged("longitude", -124.48, -114.13),
        _ranged("latitude", 32.53, 42.01),
        _ranged("housing_median_age", 1, 52),
        _ranged("total_rooms", 1, 50000),
        _ranged("total_bedrooms", 1, 10000),
        _ranged("population", 1, 50000),
        _ranged("households", 1, 10000),
        _ranged("median_income", 0.5, 15),
        FieldRule(CATEGORY_FIELD, (one_of(OCEAN_PROXIMITY),)),
    ),
)
RULE_SETS = {r.name: r for r in (STRICT, BUSINESS, DOCUMENTED)}


def _error(name: str, message: str, kind: str) -> Column:
    return F.struct(F.lit(name).alias("field"), F.lit(message).alias("message"), F.lit(kind).alias("type"))


def error_array(rules: RuleSet, present: Sequence[str]) -> Column:
    """The errors of one row. ``present`` are the columns the table has."""
    own_valid: dict[str, Column] = {}
    slots = []
    for rule in rules.rules:
        if rule.name not in present:
            own_valid[rule.name] = F.lit(False)
            slots.append(_error(rule.name, "Field required", "missing"))
            continue
        c = F.col(rule.name)
        slot = F.when(c.isNull(), _error(rule.name, "Field required", "missing"))
        valid = c.isNotNull()
        for check in rule.checks:
            slot = slot.when(~check.holds(c), _error(rule.name, check.message, check.type))
            valid = valid & check.holds(c)
        for cross in rule.cross:
            other = own_valid.get(cross.other, F.lit(False))
            bad = F.coalesce(other, F.lit(False)) & ~cross.holds(c, F.col(cross.other))
            slot = slot.when(bad, _error(rule.name, f"Value error, {cross.message}", "value_error"))
        own_valid[rule.name] = valid
        slots.append(slot)
    return F.array_compact(F.array(*slots))


def warning_array(
    high_income: float = 15.0, old_age: float = 50.0, many_rooms: float = 10.0
) -> Column:
    texts = (
        (F.col("median_income") > high_income, "High median income detected - ensure data quality"),
        (F.col("housing_median_age") > old_age, "Very old housing detected - prediction may be less accurate"),
        (
            F.try_divide(F.col("total_rooms"), F.col("households")) > many_rooms,
            "High rooms per household ratio - verify data accuracy",
        ),
    )
    return F.array_compact(F.array(*[F.when(cond, F.lit(text)) for cond, text in texts]))


def validate(df: DataFrame, rules: RuleSet | str = BUSINESS, warn: bool = True) -> DataFrame:
    """Add ``errors``, ``is_valid`` and (on valid rows only) ``warnings``. One projection."""
    rules = RULE_SETS[rules] if isinstance(rules, str) else rules
    out = df.withColumn("errors", error_array(rules, df.columns)).withColumn("is_valid", F.size("errors") == 0)
    if warn:
        nothing = F.array().cast("array<string>")
        out = out.withColumn("warnings", F.when(F.col("is_valid"), warning_array()).otherwise(nothing))
    return out


def required_fields_ok(
    df: DataFrame,
    numeric: Sequence[str] = NUMERIC_FIELDS,
    category: str = CATEGORY_FIELD,
    legal: Sequence[str] = OCEAN_PROXIMITY,
) -> Column:
    """Whether a row has every field, readable numbers and a legal category."""
    if any(c not in df.columns for c in (*numeric, category)):
        return F.lit(False)
    good = F.coalesce(F.col(category).isin(*legal), F.lit(False))
    for c in numeric:
        good = good & F.col(c).cast("string").try_cast("double").isNotNull()
    return good


def error_text(errors: Column | str = "errors", prefix: str = "Input validation failed: ") -> Column:
    """``field: message; field: message``; NULL without errors."""
    errors = F.col(errors) if isinstance(errors, str) else errors
    joined = F.concat_ws("; ", F.transform(errors, lambda e: F.concat_ws(": ", e["field"], e["message"])))
    return F.when(F.size(errors) > 0, F.concat(F.lit(prefix), joined))


def rule_counts(validated: DataFrame) -> DataFrame:
    return (
        validated.select(F.explode("errors").alias("e"))
        .groupBy(F.col("e.field").alias("field"), F.col("e.type").alias("type"))
        .agg(F.count(F.lit(1)).alias("failures"))
    )


def validate_batches(
    df: DataFrame,
    batch: str,
    position: str,
    rules: RuleSet | str = BUSINESS,
    max_size: int = 1000,
) -> DataFrame:
    """One row per batch: size, validity, failed items, item-numbered warnings.

    Items are numbered 1, 2, ... in the order of ``position``, whatever its values; equal positions
    in no set order. A batch is invalid if it holds a bad item or more than ``max_size`` items; such a batch
    has no warnings. Batches that are too large are told by a first count, so no list of theirs is collected.
    """
    checked = validate(df, rules)
    sizes = df.groupBy(batch).agg(F.count(F.lit(1)).alias("batch_size"))
    counted = checked.groupBy(batch).agg(F.count_if(~F.col("is_valid")).alias("invalid_items"))
    good = sizes.join(counted, batch).where((F.col("batch_size") <= max_size) & (F.col("invalid_items") == 0)).select(batch)
    number = F.row_number().over(Window.partitionBy(batch).orderBy(position))
    item = F.concat(F.lit("Prediction "), F.col("_number").cast("string"), F.lit(": "))
    texts = F.transform(F.col("warnings"), lambda w: F.concat(item, w))
    listed = checked.join(good, batch, "left_semi").withColumn("_number", number).where(F.size("warnings") > 0)
    listed = listed.groupBy(batch).agg(F.collect_list(F.struct("_number", texts.alias("w"))).alias("_listed"))
    grouped = sizes.join(counted, batch).join(listed, batch, "left")
    fits = F.col("batch_size").between(1, max_size)
    is_valid = fits & (F.col("invalid_items") == 0)
    ordered = F.flatten(F.transform(F.array_sort("_listed"), lambda s: s["w"]))
    return grouped.select(
        batch,
        "batch_size",
        "invalid_items",
        is_valid.alias("is_valid"),
        F.when(~fits, F.lit(f"List should have between 1 and {max_size} items")).alias("size_error"),
        F.when(is_valid & F.col("_listed").isNotNull(), ordered).otherwise(F.array().cast("array<string>")).alias("warnings"),
    )


def validate_batch_arrays(df: DataFrame, batch: str, items: str, rules: RuleSet | str = BUSINESS, max_size: int = 1000):
    """Same for batches held as an array of structs; an empty array is an invalid batch."""
    flat = df.select(batch, F.posexplode(items).alias("_pos", "_item"))
    flat = flat.select(batch, (F.col("_pos") + 1).alias("_position"), "_item.*")
    filled = validate_batches(flat, batch, "_position", rules, max_size)
    empty = df.where(F.coalesce(F.size(items), F.lit(0)) <= 0).select(
        batch,
        F.lit(0).cast("long").alias("batch_size"),
        F.lit(0).cast("long").alias("invalid_items"),
        F.lit(False).alias("is_valid"),
        F.lit(f"List should have between 1 and {max_size} items").alias("size_error"),
        F.array().cast("array<string>").alias("warnings"),
    )
    return filled.unionByName(empty)
