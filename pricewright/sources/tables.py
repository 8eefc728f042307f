"""The benchmark tables, and the two catalogs derived from them.

The catalog texts run unchanged in Spark SQL and in DuckDB, so the oracles start from the same rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

# One row per part: missing names, values, prices and links, a malformed number, accents, tags.
CATALOG_SQL = """
SELECT p_partkey AS sample_id,
  CASE WHEN p_partkey % 50 = 7 THEN '' ELSE 'Item Name: ' || p_brand || ' ' || p_name
    || CASE WHEN p_partkey % 3 = 0 THEN ', Pack of ' || CAST(p_partkey % 12 + 1 AS STRING) ELSE '' END
    || CASE WHEN p_partkey % 9 = 2 THEN ' Café' ELSE '' END || chr(10) END
  || 'Bullet Point 1: ' || lower(p_type) || ' grade ' || p_name
  || CASE WHEN p_partkey % 5 = 0 THEN chr(10) || 'Bullet Point 2: 12.5 oz bag' ELSE '' END
  || CASE WHEN p_partkey % 6 = 1 THEN chr(10) || 'Count: ' || CAST(p_partkey % 24 + 1 AS STRING) ELSE '' END
  || CASE WHEN p_partkey % 4 = 0 THEN chr(10) || 'Product Description: great kitchen battery <b>vitamin</b>' ELSE '' END
  || CASE WHEN p_partkey % 10 = 0 THEN '' WHEN p_partkey % 25 = 3 THEN chr(10) || 'Value: 1.2.3'
          ELSE chr(10) || 'Value: ' || CAST(p_size AS STRING) || '.5' END
  || chr(10) || 'Unit: Ounce' AS catalog_content,
  CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN 'ftp://img.example.org/x.jpg'
       ELSE 'https://img.example.org/' || CAST(p_partkey AS STRING) || '.jpg' END AS image_link,
  CASE WHEN p_partkey % 40 = 39 THEN NULL ELSE p_retailprice * (1 + p_size % 7) / 10.0e0 END AS price
FROM {part}
"""

# One row per line item: many priced rows per brand, prices with a long tail.
LINE_SQL = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, p_brand AS brand, p_name AS item_name,
  CAST(p_size AS DOUBLE) AS value, CAST(l_quantity AS INT) AS pack_count,
  l_extendedprice / l_quantity AS price
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
"""


# Row keys of the tables that hold most of the work.
_KEYS = {"documents": "doc_id", "lineitem": "l_orderkey", "pages": "page_id", "part": "p_partkey"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A benchmark table. Each is a file of one row group, which one task reads, so a session that works on such files
    may say in ``spark.pricewright.scanTasks`` over how many tasks to deal the rows; without it nothing is shuffled."""
    rows = spark.read.parquet(f"{folder}/{name}.parquet")
    tasks = spark.conf.get("spark.pricewright.scanTasks", None)
    return rows.repartition(int(tasks), _KEYS[name]) if tasks and name in _KEYS else rows


ROWS_A_TASK = 1 << 13  # texts are worth a task: parsing and scoring them takes seconds


def dealt(rows: DataFrame, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """Rows of a scan over as many tasks as they are worth.

    Splits follow bytes. A table of short, alike rows has few of them, while the work that follows is by the row, so its tasks
    would grow with the table. The rows are counted from the file's footers; a scan that has enough splits is left as it is.
    """
    tasks = math.ceil(rows.count() / rows_a_task)
    return rows.repartition(tasks) if tasks > rows.rdd.getNumPartitions() else rows


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    if not spark.conf.get("spark.pricewright.scanTasks", None):
        part = dealt(part)
    return spark.sql(CATALOG_SQL, part=part)


def catalog_line(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(LINE_SQL, part=table(spark, folder, "part"), lineitem=table(spark, folder, "lineitem"))
