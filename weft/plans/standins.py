"""How the test tables stand for episodes, steps, signals, scenes and assets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.sources.tables import table

STEP_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")

STEPS = """steps AS (
  SELECT l_orderkey AS episode, row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) - 1 AS t,
    l_returnflag = 'R' AS success, l_extendedprice AS reward, l_quantity AS q, l_discount AS d, l_tax AS x,
    l_partkey AS part, l_suppkey AS robot, l_linestatus AS status, l_shipdate AS shipped
  FROM lineitem)"""
EPISODES = """episodes AS (
  SELECT o_orderkey AS episode, n_name AS house, n_regionkey AS region, o_orderpriority AS policy,
    o_totalprice AS price, o_orderstatus AS state
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


#: Rows of a partition of steps, which a task sorts.
STEP_ROWS = 1 << 19


def by_episode(lines: DataFrame) -> DataFrame:
    """Line items dealt by order to partitions of about STEP_ROWS rows, so that these grow in number, not in size."""
    parts = -(-lines.count() // STEP_ROWS)
    return lines.repartition(max(parts, lines.sparkSession.sparkContext.defaultParallelism), "l_orderkey") if parts > 2 else lines


def dealt_parts(lines: DataFrame) -> int:
    """Partitions of about STEP_ROWS rows, and one for each core at least."""
    return max(-(-lines.count() // STEP_ROWS), lines.sparkSession.sparkContext.defaultParallelism)


def house_of(episode: str, size: int) -> Column:
    return F.floor(F.col(episode) / size)


def steps(spark: SparkSession, sf_dir: str, house: int | None = None) -> DataFrame:
    """Timesteps: line items of an order in a total order.

    With `house`, so many neighbouring episodes are a house, whose number is a column more; rows are dealt by it, so that windows and groups
    of houses, and of episodes with their houses, need no other shuffle.
    """
    lines = table(spark, sf_dir, "lineitem")
    if house:
        lines = lines.withColumn("house", house_of("l_orderkey", house)).repartition(dealt_parts(lines), "house")
    else:
        lines = by_episode(lines)
    within = Window.partitionBy(*["house"] * bool(house), "l_orderkey").orderBy(*STEP_ORDER)
    return lines.select(
        *["house"] * bool(house),
        F.col("l_orderkey").alias("episode"),
        (F.row_number().over(within) - 1).cast("long").alias("t"),
        (F.col("l_returnflag") == "R").alias("success"),
        F.col("l_extendedprice").alias("reward"),
        F.col("l_quantity").alias("q"),
        F.col("l_discount").alias("d"),
        F.col("l_tax").alias("x"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("robot"),
        F.col("l_linestatus").alias("status"),
        F.col("l_shipdate").alias("shipped"),
    )


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes: orders, with the customer's nation as house. Nations are 25 rows by definition of the table."""
    nation = F.broadcast(table(spark, sf_dir, "nation"))
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("episode"),
            F.col("n_name").alias("house"),
            F.col("n_regionkey").alias("region"),
            F.col("o_orderpriority").alias("policy"),
            F.col("o_totalprice").alias("price"),
            F.col("o_orderstatus").alias("state"),
        )
    )


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signal samples: events of a user by time, the event type as move group."""
    within = Window.partitionBy("user_id").orderBy("ts")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("episode"),
        (F.row_number().over(within) - 1).cast("long").alias("t"),
        F.col("event_type").alias("key"),
        "value",
        "ts",
        "props",
        "event_id",
    )


SIGNALS = """signals AS (
  SELECT user_id AS episode, row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 AS t,
    event_type AS key, value, ts, props, event_id FROM events)"""
