"""Feature columns for the strength-of-case model."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame, functions as F

from casewright import fixed_values as fv
from casewright.functions.text import digits, has, has_any, number, strip_punctuation, truthy


def destination_flags(df: DataFrame, places, unknown: bool = False,
                      null_is_true: bool = False) -> DataFrame:
    """One flag per place named in the planned destination, and one for the gulf states."""
    text = strip_punctuation("planned_destination")
    flags = {"destination_gulf": has_any(text, fv.GULF_WORDS, null_is_true)}
    if unknown:
        flags["destination_unknown"] = has(text, fv.UNKNOWN_DESTINATION_WORD, null_is_true)
    flags.update({f"destination_{p}": has(text, p, null_is_true) for p in places})
    return df.withColumns({"planned_destination": text, **flags})


def box_flags(df: DataFrame, as_coded: bool = False) -> DataFrame:
    """For every ``*_pb`` column, whether the row's box number is among the numbers listed there.

    ``as_coded`` compares single characters, so boxes from 10 on never match.
    """
    columns = [c for c in df.columns if c.endswith("_pb")]
    box = F.col("pb_number").cast("string")
    flags = {}
    for c in columns:
        if as_coded:
            found = (F.length(box) == 1) & F.contains(F.col(c), box)
        else:
            found = F.array_contains(F.split(F.regexp_replace(c, "[^0-9]+", ","), ","), box)
        flags[f"{c}2"] = F.coalesce(found, F.lit(False))
    return df.withColumns(flags).drop(*columns) if flags else df


def belief_flags(df: DataFrame, null_is_true: bool = False) -> DataFrame:
    """One flag per belief, read from words in the belief text."""
    return df.withColumns({flag: has("pv_believes", word, null_is_true)
                           for flag, word in fv.BELIEF_WORDS})


def fill_defaults(df: DataFrame) -> DataFrame:
    """A missing number of victims means one; the earning is the digits of its text."""
    return df.withColumns({
        "number_of_victims": F.coalesce("number_of_victims", F.lit(1)),
        "expected_earning": digits("expected_earning"),
    })


def coerce_types(df: DataFrame, numbers, keep, null_is_true: bool = False) -> DataFrame:
    """Numbers to double (missing is 0), every other column to boolean, except those to keep."""
    types = dict(df.dtypes)

    def typed(c: str):
        if c in keep:
            return F.col(c)
        if c in numbers:
            return number(c, 0).alias(c)
        return truthy(c, types[c], null_is_true).alias(c)

    return df.select(*[typed(c) for c in df.columns])


def category_levels(df: DataFrame, columns) -> dict[str, list[str]]:
    """Distinct values per category column, from one pass over the data, for callers that want a named column
    per value. The values become column names, so they are on the driver by nature; models do not need them
    (``encode_categories``, and the model pipeline, index any number of values)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level"))
                      for c in columns])
    levels = {c: [] for c in columns}
    rows = df.select(F.inline(pairs)).distinct().collect()
    for row in sorted(rows, key=lambda r: (r["feature"], r["level"] is not None, r["level"] or "")):
        levels[row["feature"]].append(row["level"])
    return levels


def category_flags(df: DataFrame, levels: dict[str, list[str]]) -> DataFrame:
    """One flag per known category value (``column_value``; missing is ``column_nan``)."""
    flags = {}
    for c, values in levels.items():
        for value in values:
            hit = F.col(c).isNull() if value is None else F.coalesce(
                F.col(c).cast("string") == value, F.lit(False))
            flags[f"{c}_{'nan' if value is None else value}"] = hit
    return df.withColumns(flags).drop(*levels) if flags else df


def encode_categories(df: DataFrame, columns) -> DataFrame:
    """Sparse one-hot vectors for category columns with any number of values."""
    indexers = StringIndexer(inputCols=list(columns), outputCols=[f"{c}_index" for c in columns],
                             handleInvalid="keep", stringOrderType="alphabetAsc")
    encoder = OneHotEncoder(inputCols=[f"{c}_index" for c in columns],
                            outputCols=[f"{c}_vector" for c in columns], dropLast=False)
    text = df.withColumns({c: F.col(c).cast("string") for c in columns})
    model = Pipeline(stages=[indexers, encoder]).fit(text)
    return model.transform(text).drop(*columns, *[f"{c}_index" for c in columns])


def used_features(df: DataFrame, keep) -> list[str]:
    """Columns with at least one true or non-zero value (one pass), and those to keep."""
    types = dict(df.dtypes)
    tested = [c for c in df.columns if c not in keep]
    if not tested:
        return list(df.columns)
    used = df.agg(*[F.max(truthy(c, types[c])).alias(c) for c in tested]).first().asDict()
    return [c for c in df.columns if c in keep or used[c]]


def drop_empty_features(df: DataFrame, keep) -> DataFrame:
    return df.select(*used_features(df, keep))


def engineer_v3(forms: DataFrame, keep=(*fv.ROW_IDENTITY_COLUMNS, "arrest"),
                places=fv.PLACES_V3, null_is_true: bool = False) -> DataFrame:
    """Form rows to features, newer rules. Empty columns stay: only the model drops them."""
    df = belief_flags(fill_defaults(destination_flags(forms, places, null_is_true=null_is_true)), null_is_true)
    df = df.drop(*fv.FEATURE_DROP_V3)
    return coerce_types(df, fv.NUMBER_FEATURES_V3, keep, null_is_true)


def engineer_v2(forms: DataFrame, levels: dict[str, list[str]] | None = None,
                keep=("suspect_id", "cif_number", "interview_date", "arrest"), null_is_true: bool = False,
                as_coded: bool = False) -> DataFrame:
    """Form rows to features, older rules: box flags and categories.

    With ``levels`` there is one flag column per listed category value. Without, categories stay text columns, which the
    model pipeline indexes and encodes as sparse vectors, whatever their number of values.
    """
    categories = [c for c in fv.CATEGORY_FEATURES_V2 if c in forms.columns]
    df = box_flags(destination_flags(forms, fv.PLACES_V2, unknown=True, null_is_true=null_is_true), as_coded)
    df = df.drop("planned_destination", "pb_number", "arrest_date")
    df = coerce_types(df, fv.NUMBER_FEATURES_V2, (*keep, *categories), null_is_true)
    if levels is None:
        return df.withColumns({c: F.col(c).cast("string") for c in categories})
    return category_flags(df, levels)
