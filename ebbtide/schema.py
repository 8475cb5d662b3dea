"""Column layout of a subscriber table and the roles its columns play."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names and category domains of the telecom subscriber table.
YES_NO = ("Yes", "No")
INTERNET_ADDON = ("Yes", "No", "No internet service")
CUSTOMER_DOMAINS = {
    "gender": ("Male", "Female"),
    "SeniorCitizen": ("0", "1"),
    "Partner": YES_NO,
    "Dependents": YES_NO,
    "PhoneService": YES_NO,
    "MultipleLines": ("Yes", "No", "No phone service"),
    "InternetService": ("DSL", "Fiber optic", "No"),
    "OnlineSecurity": INTERNET_ADDON,
    "OnlineBackup": INTERNET_ADDON,
    "DeviceProtection": INTERNET_ADDON,
    "TechSupport": INTERNET_ADDON,
    "StreamingTV": INTERNET_ADDON,
    "StreamingMovies": INTERNET_ADDON,
    "Contract": ("Month-to-month", "One year", "Two year"),
    "PaperlessBilling": YES_NO,
    "PaymentMethod": (
        "Electronic check",
        "Mailed check",
        "Bank transfer (automatic)",
        "Credit card (automatic)",
    ),
}

# The column order of the subscriber table.
CUSTOMER_SCHEMA = T.StructType(
    [
        T.StructField("customerID", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("SeniorCitizen", T.IntegerType()),
        T.StructField("Partner", T.StringType()),
        T.StructField("Dependents", T.StringType()),
        T.StructField("tenure", T.IntegerType()),
        T.StructField("PhoneService", T.StringType()),
        T.StructField("MultipleLines", T.StringType()),
        T.StructField("InternetService", T.StringType()),
        T.StructField("OnlineSecurity", T.StringType()),
        T.StructField("OnlineBackup", T.StringType()),
        T.StructField("DeviceProtection", T.StringType()),
        T.StructField("TechSupport", T.StringType()),
        T.StructField("StreamingTV", T.StringType()),
        T.StructField("StreamingMovies", T.StringType()),
        T.StructField("Contract", T.StringType()),
        T.StructField("PaperlessBilling", T.StringType()),
        T.StructField("PaymentMethod", T.StringType()),
        T.StructField("MonthlyCharges", T.DoubleType()),
        T.StructField("TotalCharges", T.StringType()),
        T.StructField("Churn", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Layout:
    """Which column of a table plays which role; operators take names from here only."""

    key: str
    target: str
    tenure: str
    monthly: str
    total: str
    senior: str | None
    contract: str
    payment: str
    internet: str
    streaming: str | None
    services: tuple[str, ...]
    categorical: tuple[str, ...]

    @property
    def numeric(self) -> tuple[str, ...]:
        return (self.tenure, self.monthly, self.total)

    @property
    def required(self) -> tuple[str, ...]:
        return self.categorical + self.numeric

    def present_in(self, df: DataFrame) -> Layout:
        """The same roles without the categorical columns the table lacks."""
        have = set(df.columns)
        return replace(
            self,
            categorical=tuple(c for c in self.categorical if c in have),
            services=tuple(c for c in self.services if c in have),
        )


CUSTOMERS = Layout(
    key="customerID",
    target="Churn",
    tenure="tenure",
    monthly="MonthlyCharges",
    total="TotalCharges",
    senior="SeniorCitizen",
    contract="Contract",
    payment="PaymentMethod",
    internet="InternetService",
    streaming="StreamingTV",
    services=(
        "PhoneService",
        "MultipleLines",
        "OnlineSecurity",
        "OnlineBackup",
        "DeviceProtection",
        "TechSupport",
        "StreamingTV",
        "StreamingMovies",
    ),
    categorical=tuple(CUSTOMER_DOMAINS),
)

SNAPSHOTS = Layout(
    key="customer_id",
    target="churn",
    tenure="tenure",
    monthly="monthly_charges",
    total="total_charges",
    senior="senior_citizen",
    contract="contract",
    payment="payment_method",
    internet="internet_service",
    streaming="region",
    services=(),
    categorical=("internet_service", "region", "contract", "payment_method", "senior_citizen"),
)


def column_roles(df: DataFrame) -> DataFrame:
    """One row per column: its name and whether its type makes it numerical or categorical."""

    def role(dtype: T.DataType) -> str:
        if isinstance(dtype, T.NumericType):
            return "numerical"
        return "categorical" if isinstance(dtype, T.StringType) else "other"

    rows = [(f.name, role(f.dataType)) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, role string")


def missing_columns(df: DataFrame, required) -> list[str]:
    """Required column names the table lacks, in the order they were asked for."""
    have = set(df.columns)
    return [c for c in required if c not in have]
