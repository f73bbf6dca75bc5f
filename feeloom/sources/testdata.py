"""Fee ledgers derived from the TPC-H-like test tables: every lineitem is a fee of its order's customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feeloom.schemas import FEE_COLUMNS

# Which lines the source system gets wrong. All variants keep every line; the predicates only add faults.
RESENT = "l_quantity = 50"
LOST_CLIENT = "l_quantity = 1 AND l_tax = 0.08"
WRONG_NINO = "l_tax = 0"
RESENT_OFTEN = "l_quantity >= 45"
FAULTS = {"resent": RESENT, "lost_client": LOST_CLIENT, "wrong_nino": WRONG_NINO, "resent_often": RESENT_OFTEN}


def fee_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line as a fee, and which faults it has."""
    # What the lines and the orders say is worked out ahead of the join, and only that is sent through it.
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("fee_date"))
    amount = F.col("l_extendedprice")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey",
        "l_suppkey",
        F.when(F.col("l_returnflag") == "R", -amount).otherwise(amount).alias("fee_amount"),
        *[F.expr(test).alias(name) for name, test in FAULTS.items()],
    )
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("string").alias("client_id"),
        F.concat(F.lit("NI"), F.col("o_custkey").cast("string")).alias("client_nino"),
        F.col("l_suppkey").cast("string").alias("adviser_id"),
        "fee_date",
        "fee_amount",
        *FAULTS,
    )


def fee_ledger(spark: SparkSession, sf_dir: str, variant: str = "base") -> DataFrame:
    """``base``: one row per line. ``raw``: some lines lack the client, some arrive twice. ``faulty``: raw, with a
    wrong national insurance number on some second copies. ``bulky``: base with more than 5 % second copies.
    """
    return fees_sent(fee_lines(spark, sf_dir), variant)


def fees_sent(lines: DataFrame, variant: str) -> DataFrame:
    """A variant of the ledger from its fee_lines()."""
    if variant == "base":
        return lines.select(*FEE_COLUMNS)
    if variant not in ("raw", "faulty", "bulky"):
        raise ValueError(f"unknown variant {variant!r}")
    resent = F.col("resent_often" if variant == "bulky" else "resent")
    once, twice = F.array(F.lit(False)), F.array(F.lit(False), F.lit(True))
    sent = lines.withColumn("is_copy", F.explode(F.when(resent, twice).otherwise(once)))
    if variant != "bulky":
        sent = sent.withColumn("client_id", F.when(~F.col("lost_client"), F.col("client_id")))
    if variant == "faulty":
        nino = F.col("client_nino")
        wrong = F.col("is_copy") & F.col("wrong_nino")
        sent = sent.withColumn("client_nino", F.when(wrong, F.concat(nino, F.lit("X"))).otherwise(nino))
    return sent.select(*FEE_COLUMNS)


def event_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a short ledger: users pay, event types advise."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("user_id").cast("string").alias("client_id"),
        F.concat(F.lit("NI"), F.col("user_id").cast("string")).alias("client_nino"),
        F.col("event_type").alias("adviser_id"),
        F.col("ts").cast("date").alias("fee_date"),
        F.col("value").alias("fee_amount"),
    )
