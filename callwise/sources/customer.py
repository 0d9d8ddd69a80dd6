"""The customer table: its columns, their roles, and the constraints a daily batch must meet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callwise.operators.schema import CONSTRAINTS
from callwise.sources.staging import local_rows

# ---- fixed values: names, order, types and domains are those of the existing table ----
KEY = "Id"
LABEL = "Response"
SERVING_COLUMNS = [
    "Id", "Year_Birth", "Education", "Marital_Status", "Income", "Kidhome", "Teenhome", "Dt_Customer", "Recency", "MntWines",
    "MntFruits", "MntMeatProducts", "MntFishProducts", "MntSweetProducts", "MntGoldProds", "NumDealsPurchases",
    "NumWebPurchases", "NumCatalogPurchases", "NumStorePurchases", "NumWebVisitsMonth", "Complain",
]
NUMERIC = [
    "Year_Birth", "Income", "Kidhome", "Teenhome", "Recency", "MntFruits", "MntMeatProducts", "MntFishProducts",
    "MntSweetProducts", "MntGoldProds", "NumDealsPurchases", "NumWebPurchases", "NumCatalogPurchases", "NumStorePurchases",
    "NumWebVisitsMonth",
]
CATEGORICAL = ["Education", "Marital_Status", "Complain"]
DATE = "Dt_Customer"
MINIMUM = ("Year_Birth", 1923)
DOMAINS = {
    "Education": ["2n Cycle", "Basic", "Graduation", "Master", "PhD"],
    "Marital_Status": ["Absurd", "Alone", "Divorced", "Married", "Single", "Together", "Widow", "YOLO"],
}
BOOLEAN = ["Complain", "Response"]
ABLATION_SIZES = [5, 10, 15, 18]
# ---- end of fixed values ----

FEATURES = NUMERIC + CATEGORICAL


def feature_kind(column: str) -> str:
    if column in DOMAINS or column == DATE:
        return "BYTES"
    return "FLOAT" if column == "Income" else "INT"


def table_schema(labelled: bool) -> str:
    """Column types as DDL."""
    kinds = {"INT": "int", "FLOAT": "double", "BYTES": "string"}
    types = {c: kinds[feature_kind(c)] for c in SERVING_COLUMNS} | {KEY: "bigint", DATE: "date"}
    return ", ".join(f"{c} {t}" for c, t in types.items()) + (f", {LABEL} int" if labelled else "")


def constraints(spark: SparkSession) -> DataFrame:
    """The frozen constraints; the date is rendered as text before it is checked."""
    rows = [
        (c, feature_kind(c), 1.0, 1, 1, DOMAINS.get(c), c in BOOLEAN, ["SERVING"] if c == LABEL else [], None, None)
        for c in [*SERVING_COLUMNS[1:], LABEL]
    ]
    return local_rows(spark, rows, CONSTRAINTS)
