"""The evidence domain as views over the star-schema tables, as DataFrames and as the same views in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """Base tables of a folder and the domain views over them, each read or built when it is asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def compound(self) -> DataFrame:
        return self.part.select(F.col("p_partkey").alias("cid"), F.col("p_name").alias("name"))

    @property
    def protein(self) -> DataFrame:
        return self.supplier.select(F.col("s_suppkey").alias("protein_id"), F.col("s_nationkey").alias("taxid"))

    @property
    def measuregroup(self) -> DataFrame:
        return self.orders.select(F.col("o_orderkey").alias("mg_id"), F.col("o_custkey").alias("aid"))

    @property
    def endpoint(self) -> DataFrame:
        share = F.round(F.col("l_discount") * 100)
        return self.lineitem.select(
            endpoint_id().alias("endpoint_id"),
            F.col("l_orderkey").alias("mg_id"),
            (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("sid"),
            F.when(F.col("l_linenumber") % 7 == 0, "IC50").when(F.col("l_linenumber") % 7 == 1, "Ki").when(F.col("l_linenumber") % 7 == 2, "Kd").when(F.col("l_linenumber") % 7 == 3, "EC50")
            .when(F.col("l_linenumber") % 7 == 4, "AC50").when(F.col("l_linenumber") % 7 == 5, "Km").alias("endpoint_type"),
            F.col("l_extendedprice").alias("value"),
            F.when(F.col("l_returnflag") == "A", "pM").when(F.col("l_returnflag") == "N", "nM").otherwise("uM").alias("unit"),
            F.when(F.col("l_quantity") < 30, "=").when(F.col("l_quantity") < 40, "<").otherwise(">").alias("qualifier"),
            F.when(share == 10, "active").when(share == 9, "inactive").when(share == 8, "inconclusive").alias("outcome"),
        )

    @property
    def substance(self) -> DataFrame:
        return self.lineitem.select((F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("sid"), F.col("l_partkey").alias("cid")).distinct()

    @property
    def tested_on(self) -> DataFrame:
        return self.lineitem.select(F.col("l_orderkey").alias("mg_id"), F.col("l_suppkey").alias("protein_id")).distinct()

    @property
    def supported_by(self) -> DataFrame:
        return self.lineitem.select(endpoint_id().alias("endpoint_id"), F.concat(F.lit("PMID:"), (F.col("l_orderkey") % 1000).cast("string")).alias("reference_id"))

    @property
    def similar_to(self) -> DataFrame:
        """Each compound with the next one of its brand, type and size class."""
        from pyspark.sql import Window

        order = Window.partitionBy("p_brand", "p_type", F.floor(F.col("p_size") / 10)).orderBy("p_partkey")
        return self.part.select(F.col("p_partkey").alias("a"), F.lead("p_partkey").over(order).alias("b")).filter("b is not null")


def endpoint_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


#: The same views for DuckDB.
SQL_VIEWS = """
compound AS (SELECT p_partkey AS cid, p_name AS name FROM part),
protein AS (SELECT s_suppkey AS protein_id, s_nationkey AS taxid FROM supplier),
measuregroup AS (SELECT o_orderkey AS mg_id, o_custkey AS aid FROM orders),
endpoint AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS endpoint_id, l_orderkey AS mg_id, l_partkey * 10 + l_linenumber AS sid,
         CASE l_linenumber % 7 WHEN 0 THEN 'IC50' WHEN 1 THEN 'Ki' WHEN 2 THEN 'Kd' WHEN 3 THEN 'EC50' WHEN 4 THEN 'AC50' WHEN 5 THEN 'Km' END AS endpoint_type,
         l_extendedprice AS value, CASE l_returnflag WHEN 'A' THEN 'pM' WHEN 'N' THEN 'nM' ELSE 'uM' END AS unit,
         CASE WHEN l_quantity < 30 THEN '=' WHEN l_quantity < 40 THEN '<' ELSE '>' END AS qualifier,
         CASE round(l_discount * 100) WHEN 10 THEN 'active' WHEN 9 THEN 'inactive' WHEN 8 THEN 'inconclusive' END AS outcome
  FROM lineitem
),
substance AS (SELECT DISTINCT l_partkey * 10 + l_linenumber AS sid, l_partkey AS cid FROM lineitem),
tested_on AS (SELECT DISTINCT l_orderkey AS mg_id, l_suppkey AS protein_id FROM lineitem),
supported_by AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS endpoint_id, 'PMID:' || (l_orderkey % 1000) AS reference_id FROM lineitem),
similar_to AS (
  SELECT a, b FROM (SELECT p_partkey AS a, lead(p_partkey) OVER (PARTITION BY p_brand, p_type, p_size // 10 ORDER BY p_partkey) AS b FROM part) WHERE b IS NOT NULL
),
measured AS (
  SELECT *, value * CASE unit WHEN 'pM' THEN 1e-12 WHEN 'nM' THEN 1e-9 ELSE 1e-6 END AS value_molar,
         endpoint_type IN ('IC50', 'Ki', 'Kd', 'EC50', 'AC50') AS comparable
  FROM endpoint
),
bounded AS (
  SELECT *, CASE WHEN qualifier IN ('=', '>') THEN value_molar END AS low, CASE WHEN qualifier IN ('=', '<') THEN value_molar END AS high,
         qualifier = '=' AS closed
  FROM measured
),
sided AS (
  SELECT *, coalesce(comparable AND high <= 1e-5, false) AS under, coalesce(comparable AND (low > 1e-5 OR (low = 1e-5 AND NOT closed)), false) AS above FROM bounded
),
labelled AS (
  SELECT *, CASE WHEN outcome = 'inconclusive' THEN NULL
                 WHEN under THEN CASE WHEN outcome = 'inactive' THEN NULL ELSE 1 END
                 WHEN above THEN CASE WHEN outcome = 'active' THEN NULL ELSE 0 END
                 WHEN coalesce(comparable, false) THEN NULL
                 WHEN outcome = 'inactive' THEN 0 WHEN outcome = 'active' THEN 1 END AS label
  FROM sided
),
evidence AS (
  SELECT DISTINCT s.cid, t.protein_id, e.endpoint_id, e.mg_id, e.sid, e.endpoint_type, e.value_molar, e.label
  FROM labelled e JOIN substance s USING (sid) JOIN tested_on t USING (mg_id)
)
"""


def over_views(sql: str) -> str:
    """DuckDB SQL over the domain views; ``sql`` may go on with views of its own."""
    return f"WITH RECURSIVE {SQL_VIEWS} {sql}"
