"""Product and promotion catalog files (CSV with a header, UTF-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Columns of the two files.
PRODUCTS = (
    "workspace_id string, project_id string, mall_name string, product_id string, "
    "product_name string, category_id string, category_name string, unit_price int, currency string"
)
PROMOTIONS = (
    "workspace_id string, project_id string, mall_name string, campaign_id string, "
    "campaign_name string, promotion_id string, promotion_name string, placement string, "
    "page_url string, creative_id string, creative_type string, start_at timestamp, "
    "end_at timestamp, status string"
)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=PRODUCTS, header=True, encoding="UTF-8")


def read_promotions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=PROMOTIONS, header=True, encoding="UTF-8")
