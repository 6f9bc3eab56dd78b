"""An incident table made from ``orders``, for tests, checks and benchmarks.

The same SQL text runs in Spark and in other engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bitacora.operators.rows import spread_rows

INCIDENTS_SQL = """
SELECT o_orderkey AS fila,
 CAST(1000000000 + o_orderkey AS STRING) AS Folio,
 CASE WHEN o_orderkey % 10 = 3 THEN '70104' WHEN o_orderkey % 17 = 5 THEN NULL ELSE '30301' END AS tipo,
 CASE o_orderkey % 6 WHEN 0 THEN 'TLAXCALA' WHEN 1 THEN 'apizaco' WHEN 2 THEN 'MUÑOZ DE DOMINGO ARENAS' WHEN 3 THEN 'CALPULALPAN' WHEN 4 THEN 'NO EXISTE' ELSE NULL END AS Municipio,
 CASE WHEN o_orderkey % 23 = 7 THEN concat('[''', CAST(1000000000 + o_orderkey + 4 AS STRING), ''', ''', CAST(1000000000 + o_orderkey AS STRING), ''']')
      WHEN o_orderkey % 29 = 11 THEN concat(CAST(1000000000 + o_orderkey + 2 AS STRING), ', ', CAST(3000000000 + o_custkey AS STRING))
      ELSE NULL END AS Divididos,
 CASE o_orderkey % 8
  WHEN 0 THEN concat('El incidente ', CAST(1000000000 + o_orderkey AS STRING), ' ha sido ligado al incidente ', CAST(1000000000 + o_orderkey + 2 AS STRING), '. reporta que SEGURIDAD PUBLICA acude 12/05/2023 10:30')
  WHEN 1 THEN concat('Folio ', CAST(1000000000 + o_orderkey AS STRING), ' cancelado por OPERADOR (', CAST(o_custkey AS STRING), '). Sin novedad')
  WHEN 2 THEN concat('EN REFERENCIA AL FOLIO ', CAST(1000000000 + o_orderkey + 3 AS STRING), ', enterado monitoreo conforme')
  WHEN 3 THEN concat(CAST(1000000000 + o_orderkey AS STRING), ' se dividio al folio ', CAST(1000000000 + o_orderkey + 5 AS STRING), ' turno 2 por MARIA. pide apoyo')
  WHEN 4 THEN concat('referencia a ', CAST(o_custkey AS STRING), ' ', o_orderpriority)
  WHEN 5 THEN NULL
  WHEN 6 THEN concat('EspaÃ±ita   ', o_orderpriority, ' 10.5 km')
  ELSE 'nan' END AS Notas
FROM orders
"""

# Order of the rows of the table.
ROW = "fila"


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw incident rows; ``fila`` is their order."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    table = spark.sql(INCIDENTS_SQL.replace("FROM orders", "FROM {orders}"), orders=orders)
    return spread_rows(table.withColumnRenamed("tipo", "Tipo de Incidente"))
