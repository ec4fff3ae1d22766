"""From the five source tables to the feature table, as one lazy plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.functions import yes_no

ID = "customer_id"
TARGET = "is_voluntary_churn"

# Text columns holding Yes or No, per table.
YES_NO_COLUMNS = {
    "demographics": ["under_30", "senior_citizen", "married", "dependents"],
    "services": [
        "referred_a_friend",
        "phone_service",
        "multiple_lines",
        "internet_service",
        "online_security",
        "online_backup",
        "device_protection_plan",
        "premium_tech_support",
        "streaming_tv",
        "streaming_movies",
        "streaming_music",
        "unlimited_data",
        "paperless_billing",
    ],
    "status": ["churn_label"],
}

# The columns of the modelling view, by the table they come from.
DEMOGRAPHIC_FEATURES = [
    "gender",
    "age",
    "under_30",
    "senior_citizen",
    "married",
    "dependents",
    "number_of_dependents",
]
LOCATION_FEATURES = ["country", "state", "city", "zip_code", "latitude", "longitude"]
POPULATION_FEATURES = ["population"]
SERVICE_FEATURES = [
    "referred_a_friend",
    "number_of_referrals",
    "tenure_in_months",
    "offer",
    "phone_service",
    "avg_monthly_long_distance_charges",
    "multiple_lines",
    "internet_service",
    "internet_type",
    "avg_monthly_gb_download",
    "online_security",
    "online_backup",
    "device_protection_plan",
    "premium_tech_support",
    "streaming_tv",
    "streaming_movies",
    "streaming_music",
    "unlimited_data",
    "contract",
    "paperless_billing",
    "payment_method",
    "monthly_charge",
    "total_charges",
    "total_refunds",
    "total_extra_data_charges",
    "total_long_distance_charges",
    "total_revenue",
]
VIEW_COLUMNS = [
    ID,
    TARGET,
    *DEMOGRAPHIC_FEATURES,
    *LOCATION_FEATURES,
    *POPULATION_FEATURES,
    *SERVICE_FEATURES,
]

# Known only after the outcome, or restating it; never model inputs.
POST_OUTCOME_COLUMNS = [
    "satisfaction_score",
    "churn_score",
    "cltv",
    "churn_category",
    "churn_reason",
]
TARGET_DERIVED_COLUMNS = ["customer_status", "churn_label", "churn_value"]
FORBIDDEN_COLUMNS = [*POST_OUTCOME_COLUMNS, *TARGET_DERIVED_COLUMNS]

# The eight services that count as add-ons, the longest tenure recorded.
ADDON_COLUMNS = [
    "online_security",
    "online_backup",
    "device_protection_plan",
    "premium_tech_support",
    "streaming_tv",
    "streaming_movies",
    "streaming_music",
    "unlimited_data",
]
TENURE_LIMIT = 72
EXCLUDED_REASON = "Deceased"


def snake_case(header: str) -> str:
    return header.lower().replace(" ", "_")


def stage(raw: DataFrame, artifacts: Sequence[str] = ("Count",)) -> DataFrame:
    """Rename the file headers to snake case and leave out constant artifacts."""
    kept = raw.drop(*artifacts)
    return kept.toDF(*[snake_case(c) for c in kept.columns])


def clean(staged: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Turn the Yes/No text columns into booleans; keep the rest."""
    return staged.withColumns({c: yes_no(c) for c in flags})


def target(status: DataFrame, excluded_reason: str = EXCLUDED_REASON) -> DataFrame:
    """The outcome of every customer but those lost for the excluded reason."""
    return status.where(~F.col("churn_reason").eqNullSafe(excluded_reason)).select(
        ID,
        "customer_status",
        "churn_category",
        "churn_reason",
        (F.col("customer_status") == "Churned").alias(TARGET),
    )


def modeling_view(
    outcome: DataFrame,
    demographics: DataFrame,
    location: DataFrame,
    population: DataFrame,
    services: DataFrame,
) -> DataFrame:
    """One row per labelled customer with the allowed columns only."""
    people = demographics.select(ID, *DEMOGRAPHIC_FEATURES)
    places = location.select(ID, *LOCATION_FEATURES).join(
        population.select("zip_code", *POPULATION_FEATURES), "zip_code", "left"
    )
    return (
        outcome.select(ID, TARGET)
        .join(people, ID)
        .join(places, ID)
        .join(services.select(ID, *SERVICE_FEATURES), ID)
        .select(*VIEW_COLUMNS)
    )


def add_features(view: DataFrame) -> DataFrame:
    """The five derived features; a NULL add-on makes the add-on count NULL."""
    addons = reduce(add, [F.col(c).cast("int") for c in ADDON_COLUMNS])
    return view.withColumn("num_addon_services", addons).withColumns(
        {
            "is_month_to_month": F.col("contract") == "Month-to-Month",
            "internet_without_security": F.col("internet_service") & ~F.col("online_security"),
            "no_addons_despite_internet": F.col("internet_service")
            & (F.col("num_addon_services") == 0),
            "is_tenure_censored": F.col("tenure_in_months") == TENURE_LIMIT,
        }
    )


def cleaned_tables(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        name: clean(stage(df), YES_NO_COLUMNS.get(name, [])) for name, df in raw.items()
    }


def view_from_sources(raw: Mapping[str, DataFrame]) -> DataFrame:
    tables = cleaned_tables(raw)
    return modeling_view(
        target(tables["status"]),
        tables["demographics"],
        tables["location"],
        tables["population"],
        tables["services"],
    )


def feature_table(raw: Mapping[str, DataFrame]) -> DataFrame:
    return add_features(view_from_sources(raw))
