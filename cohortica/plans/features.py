"""From a raw passenger-like table to a model: the feature table, and a baseline without it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.functions import columns as c
from cohortica.operators.binning import cut, qcut
from cohortica.operators.encode import (
    binary_columns,
    label_encode,
    one_hot,
    rare_encode,
    useless_columns,
)
from cohortica.operators.missing import (
    fill_by_group,
    fill_categorical,
    fill_numeric,
    regression_impute_all,
    zero_to_null,
)
from cohortica.operators.model import (
    fit_forest,
    fit_gbt,
    importances,
    predict,
    scorecard,
    split,
    spread,
)
from cohortica.operators.outliers import clip_outliers, outlier_thresholds
from cohortica.operators.profile import grab_col_names, numeric_columns, string_columns
from cohortica.operators.relational import upper_columns
from cohortica.operators.scale import standard_scale
from cohortica.session import settle

# Bands, labels and texts that results must agree on.
AGE_EDGES, AGE_LABELS = (18, 56), ("young", "mature", "senior")
HEALTH_AGE_EDGES, HEALTH_AGE_LABELS = (50,), ("mature", "senior")
WEIGHT_EDGES = (0.0, 18.5, 24.9, 29.9, float("inf"))
WEIGHT_LABELS = ("Underweight", "Healthy", "Overweight", "Obese")
SUGAR_EDGES, SUGAR_LABELS = (70, 100, 125), ("low", "normal", "hidden", "high")
GLUCOSE_EDGES, GLUCOSE_LABELS = (0.0, 140.0, 200.0, 300.0), ("Normal", "Prediabetes", "Diabetes")
INSULIN_RANGE = (16, 166)
MEASURED = ("glucose", "pressure", "skin", "insulin", "bmi")
TENURE_EDGES = (12, 24, 36, 48, 60)
TENURE_YEARS = ("0-1 Year", "1-2 Year", "2-3 Year", "3-4 Year", "4-5 Year", "5-6 Year")
LONG_CONTRACTS, AUTOMATIC = ("One year", "Two year"), "(automatic)"
SERVICES = ("phone", "lines", "security", "backup", "protection", "support", "tv", "movies")


def _age_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "NEW_AGE_PCLASS": c.interact("AGE", "PCLASS"),
            "NEW_AGE_CAT": c.range_label("AGE", AGE_EDGES, AGE_LABELS),
        }
    ).withColumn("NEW_SEX_CAT", c.cross_label("NEW_AGE_CAT", "SEX"))


def family_features(df: DataFrame, siblings: str = "SIBSP", parents: str = "PARCH") -> DataFrame:
    """Family size with the person, and whether they travel alone."""
    others = F.col(siblings) + F.col(parents)
    return df.withColumns(
        {
            "NEW_FAMILY_SIZE": others + 1,
            "NEW_IS_ALONE": F.when(others > 0, "NO").when(others == 0, "YES"),
        }
    )


def derived_features(df: DataFrame) -> DataFrame:
    """Upper-case names and the features that need one row only."""
    df = upper_columns(df).withColumns(
        {
            "NEW_CABIN_BOOL": c.notnull_flag("CABIN"),
            "NEW_NAME_COUNT": c.char_count("NAME"),
            "NEW_NAME_WORD_COUNT": c.word_count("NAME"),
            "NEW_NAME_DR": c.prefix_count("NAME", "Dr"),
            "NEW_TITLE": c.regex_feature("NAME", r"([A-Za-z]+)\."),
        }
    )
    return _age_features(family_features(df))


def feature_table(
    df: DataFrame, key: str = "ID", target: str = "SURVIVED", rare: float = 0.01, max_levels: int = 100
) -> DataFrame:
    """Derive, clip, fill, encode and scale, in this order; numbers end with mean 0 and spread 1.

    Every step adds expressions with literal statistics, so passes for statistics read the input
    again, with the columns they need, and the table is written once in between, not per step.
    """
    df = derived_features(df)
    roles = grab_col_names(df)
    numbers = [x for x in roles.numeric if x != key]
    df = clip_outliers(df, outlier_thresholds(df, numbers, 0.05, 0.95))
    df = df.drop("CABIN", "NAME")
    df = settle(_age_features(fill_by_group(df, "NEW_TITLE", "AGE", "median")))
    many = [x for x in roles.categorical if x != target]
    return encode_and_scale(fill_categorical(df, "mode"), key, target, rare, max_levels, many)


def encode_and_scale(
    df: DataFrame, key: str, target: str, rare: float | None = None, max_levels: int = 100,
    categorical: Sequence[str] | None = None,
) -> DataFrame:
    """Two-valued text to 0/1, other categories to 0/1 columns without their first level, numbers to
    mean 0 and spread 1. ``rare`` merges rare levels and drops nearly constant columns;
    ``max_levels`` bounds the levels that become columns. Text that is neither is left as it is."""
    for name in binary_columns(df):
        if name not in (key, target):
            df = label_encode(df, name)
    if rare is not None:
        df = rare_encode(df, [x for x in string_columns(df) if x != key], rare)
    roles = grab_col_names(df)
    many = roles.categorical if categorical is None else categorical
    many = [x for x in many if x in df.columns and x not in (key, target) and roles.distinct[x] > 2]
    df = one_hot(df, many, drop_first=True, max_levels=max_levels)
    roles = grab_col_names(df)
    numbers = [x for x in roles.numeric if x not in (key, target)]
    if rare is not None:
        df = df.drop(*[x for x in useless_columns(df, distinct=roles.distinct) if x not in (key, target)])
        numbers = [x for x in numbers if x in df.columns]
    return standard_scale(df, numbers)


def health_features(df: DataFrame) -> DataFrame:
    """Weight, age and glucose bands, their combinations, the insulin flag and two products.

    Ages below 21 have no band, and neither has what is combined with them.
    """
    age = F.when(
        F.col("age") >= 21, c.range_label("age", HEALTH_AGE_EDGES, HEALTH_AGE_LABELS, "left")
    )
    sugar = c.range_label("glucose", SUGAR_EDGES, SUGAR_LABELS, "left")
    weight = cut(F.col("bmi"), list(WEIGHT_EDGES), list(WEIGHT_LABELS))
    return df.withColumns(
        {
            "bmi_category": weight,
            "age_category": age,
            "glucose_category": cut(F.col("glucose"), list(GLUCOSE_EDGES), list(GLUCOSE_LABELS)),
            "age_bmi": c.cross_label(F.lower(weight), age),
            "age_glucose": c.cross_label(sugar, age),
            "insulin_score": c.range_flag("insulin", *INSULIN_RANGE),
            "glucose_insulin": c.interact("glucose", "insulin"),
            "glucose_pregnancies": c.interact("glucose", "pregnancies"),
        }
    )


def health_table(df: DataFrame, key: str = "id", target: str = "outcome") -> DataFrame:
    """A zero measurement is missing: impute it by regression, clip outliers, derive features."""
    df = zero_to_null(df, list(MEASURED))
    df = regression_impute_all(df, MEASURED, target, exclude=[key])
    numbers = [x for x in numeric_columns(df) if x not in (key, target)]
    return health_features(clip_outliers(df, outlier_thresholds(df, numbers, 0.05, 0.95)))


def health_model_table(df: DataFrame, key: str = "id", target: str = "outcome", max_levels: int = 100) -> DataFrame:
    """The health flow up to the model: ``health_table``, encoded and scaled."""
    return encode_and_scale(settle(health_table(df, key, target)), key, target, max_levels=max_levels)


def churn_features(df: DataFrame, services: tuple[str, ...] = SERVICES) -> DataFrame:
    """Charge level, tenure band, engagement and service flags, and charge ratios.

    Charges that are no number become the median of those that are.
    """
    df = df.withColumn("total_charges", c.to_numeric("total_charges"))
    df = fill_numeric(df, ["total_charges"], "median")
    df = qcut(df, "monthly_charges", 3, ["low", "medium", "high"], out="charges_level")
    engaged = c.flag_in("contract", list(LONG_CONTRACTS))
    average = c.ratio("total_charges", F.col("tenure") + 1)
    protected = ["backup", "protection", "support"]
    return df.withColumns(
        {
            "churned": c.yes_flag("churn"),
            "tenure_year": c.range_label("tenure", TENURE_EDGES, TENURE_YEARS),
            "engaged": engaged,
            "no_prot": (c.count_equal(protected, "Yes") < len(protected)).cast("int"),
            "young_not_engaged": (c.is_value("senior", 0) & (engaged == 0)).cast("int"),
            "services": c.count_equal(services, "Yes"),
            "any_streaming": (c.count_equal(["tv", "movies"], "Yes") > 0).cast("int"),
            "auto_payment": c.flag_contains("payment", AUTOMATIC),
            "avg_charge": average,
            "increase": c.ratio(average, "monthly_charges"),
            "service_fee": c.ratio("monthly_charges", c.count_equal(services, "Yes") + 1),
        }
    )


def churn_table(
    df: DataFrame, key: str = "customer_id", services: tuple[str, ...] = SERVICES, max_levels: int = 100
) -> DataFrame:
    """The churn flow up to the model: features, fences at 1 and 99 percent, encoded and scaled."""
    df = settle(churn_features(df, services).drop("churn"))
    numbers = [x for x in grab_col_names(df).numeric if x not in (key, "churned")]
    df = settle(clip_outliers(df, outlier_thresholds(df, numbers, 0.01, 0.99)))
    return encode_and_scale(df, key, "churned", max_levels=max_levels)


def fitted_table(
    df: DataFrame, key: str, target: str, trees: int = 100, seed: int = 42, boosted: bool = False
) -> tuple[PipelineModel, list[str], DataFrame]:
    """A forest, or boosted trees, fitted on 70 percent of the complete rows; its features, and the
    other rows. Training makes many passes, so the rows are settled first."""
    rows = settle(df.na.drop())
    feats = [x for x in numeric_columns(rows) if x not in (key, target)]
    train, test = split(rows, key)
    if boosted:
        return fit_gbt(train, feats, target, seed=seed), feats, test
    return fit_forest(train, feats, target, trees=trees, seed=seed), feats, test


def judge(
    df: DataFrame, key: str, target: str, trees: int = 100, seed: int = 42, boosted: bool = False
) -> DataFrame:
    """Scores of ``fitted_table`` on the rows it was not fitted on."""
    model, _, test = fitted_table(df, key, target, trees, seed, boosted)
    return scorecard(predict(model, spread(test)), target)


def table_importances(
    df: DataFrame, key: str, target: str, trees: int = 100, seed: int = 42, boosted: bool = False
) -> DataFrame:
    """Importances of the features in the flow's own model."""
    model, feats, _ = fitted_table(df, key, target, trees, seed, boosted)
    return importances(model, feats)


def baseline_model(
    df: DataFrame, key: str, target: str, trees: int = 100, max_levels: int = 20, boosted: bool = False
) -> DataFrame:
    """Scores of the raw table: complete rows, text one-hot encoded, no engineered features."""
    rows = df.na.drop()
    roles = grab_col_names(rows, car_th=max_levels)
    text = [x for x in roles.categorical if x in string_columns(rows)]
    wide = one_hot(rows.drop(*roles.cardinal), text, drop_first=True)
    return judge(wide, key, target, trees, boosted=boosted)
