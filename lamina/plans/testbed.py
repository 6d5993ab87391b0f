"""The provided tables in the roles of the incident model.

Orders with their customer stand in for incidents, line items summed per order
for the financial table (orders without lines have no loss), returned line
items for the sparse market table. Missing and malformed values come from the
data: negative balances, unspecified priorities, pending orders.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina import domain
from lamina.operators import features, ordering, refine, trees
from lamina.plans import stages
from lamina.session import fresh_path, ship
from lamina.sources.layers import read_layer, write_layer

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def incidents(spark: SparkSession, folder: str) -> DataFrame:
    """Raw incidents: numbers still text, some missing or malformed."""
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    joined = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    revenue = F.col("c_acctbal").cast("string")
    odd = (F.col("o_orderstatus") == "P") & (F.col("c_acctbal") > 9000)
    price = F.col("o_totalprice")
    return joined.select(
        F.col("o_orderkey").alias("incident_id"),
        F.when(F.col("c_acctbal") < 0, None)
        .when(odd, F.concat(F.lit("$"), revenue))
        .otherwise(revenue)
        .alias("company_revenue_usd"),
        F.when(price >= 10000, price.cast("string")).alias("employee_count"),
        (price > 250000).alias("is_public_company"),
        F.col("c_mktsegment").alias("industry_primary"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias(
            "attack_vector_primary"
        ),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("data_type"),
        F.substring("o_orderpriority", 1, 1).alias("confidence_tier"),
        F.month("o_orderdate").cast("string").alias("quality_score"),
        F.col("c_nationkey").cast("string").alias("country_hq"),
        F.col("c_name").alias("company_name"),
        F.col("o_orderstatus").alias("review_flag"),
    )


def financial(spark: SparkSession, folder: str) -> DataFrame:
    """Loss per order as text; very long orders carry a malformed one."""
    lines = table(spark, folder, "lineitem")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    sums = lines.groupBy(F.col("l_orderkey").alias("incident_id")).agg(
        F.round(F.sum(net), 4).cast("string").alias("loss"),
        F.round(F.sum("l_extendedprice"), 4).alias("direct_loss_usd"),
        F.count("*").alias("lines"),
    )
    text = F.when(F.col("lines") >= 10, F.concat(F.lit("$"), F.col("loss"))).otherwise(
        F.col("loss")
    )
    return sums.select("incident_id", text.alias("total_loss_usd"), "direct_loss_usd")


def market(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").filter(F.col("l_returnflag") == "R")
    return lines.groupBy(F.col("l_orderkey").alias("incident_id")).agg(
        F.sum("l_quantity").alias("returned_quantity")
    )


def refined_rows(spark: SparkSession, folder: str) -> DataFrame:
    return refine.refine(incidents(spark, folder), financial(spark, folder))


_written: dict[tuple[str, str, str], str] = {}


def _layer(spark: SparkSession, folder: str, name: str, build) -> DataFrame:
    """A layer written once per application and input folder, then read."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _written:
        _written[key] = write_layer(build(), fresh_path(spark, name))
    return read_layer(spark, _written[key])


def refined(spark: SparkSession, folder: str) -> DataFrame:
    """The refined layer as a written table, as later stages read it."""
    return _layer(spark, folder, "refined", lambda: refined_rows(spark, folder))


def split_rows(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.with_ordered_split(refined(spark, folder), domain.ROW_KEY)


def fitted(spark: SparkSession, folder: str) -> features.FitParams:
    train = split_rows(spark, folder).filter(F.col("split") == "train")
    return features.fit(train)


def feature_layer(spark: SparkSession, folder: str) -> DataFrame:
    return _layer(
        spark,
        folder,
        "feature",
        lambda: features.build_features(refined(spark, folder))[0],
    )


SHALLOW = (replace(trees.GINI, depth=2), replace(trees.ENTROPY, depth=2))
_scored: dict[tuple, stages.Scored] = {}


def scored(
    spark: SparkSession, folder: str, specs: tuple[trees.TreeSpec, ...], layer: str = "refined"
) -> stages.Scored:
    """A layer with the predictions of trees, trained and written once per application."""
    key = (spark.sparkContext.applicationId, folder, specs, layer)
    if key not in _scored:
        rows = split_rows(spark, folder) if layer == "refined" else feature_layer(spark, folder)
        fresh = stages.score_layer(rows, features.detect_features(rows), specs)
        _scored[key] = stages.stored_scores(fresh, fresh_path(spark, f"scored-{layer}"))
    return _scored[key]
