"""Stations, grids and forecast pairs as views over the driver's tables.

Each view is portable SQL: the same text runs in Spark and, as a common table expression, in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS: dict[str, tuple[str, str]] = {
    # name: (table it reads, SQL)
    "fx_national": (
        "supplier",
        """SELECT CAST(s_suppkey AS BIGINT) AS seq, concat('N', CAST(s_suppkey AS VARCHAR(20))) AS code,
       CAST(109 AS DOUBLE) + CAST((s_suppkey * 7919) % 8000 AS DOUBLE) / 1000 AS lon,
       CAST(20 AS DOUBLE) + CAST((s_suppkey * 104729) % 5500 AS DOUBLE) / 1000 AS lat,
       CAST((s_suppkey * 31) % 1200 AS DOUBLE) AS altitude,
       CASE WHEN s_suppkey % 17 = 16 THEN NULL ELSE CAST(40 + (s_suppkey * 17) % 61 AS DOUBLE) END AS rh,
       CASE WHEN s_suppkey % 11 = 10 THEN NULL ELSE CAST(200 + (s_suppkey * 6151) % 30000 AS DOUBLE) END AS vis
FROM supplier""",
    ),
    "fx_regional": (
        "customer",
        """SELECT CAST(c_custkey AS BIGINT) + 1000000 AS seq, concat('R', CAST(c_custkey AS VARCHAR(20))) AS code,
       CAST(109 AS DOUBLE) + CAST((c_custkey * 6007) % 8000 AS DOUBLE) / 1000 AS lon,
       CAST(20 AS DOUBLE) + CAST((c_custkey * 15013) % 5500 AS DOUBLE) / 1000 AS lat,
       CAST((c_custkey * 37) % 1500 AS DOUBLE) AS altitude,
       CASE WHEN c_custkey % 13 = 12 THEN NULL ELSE CAST(35 + (c_custkey * 19) % 66 AS DOUBLE) END AS rh,
       CASE WHEN c_custkey % 5 = 0 THEN CAST(300 + (c_custkey * 4409) % 28000 AS DOUBLE) END AS vis
FROM customer""",
    ),
    "fx_dem": (
        "part",
        """SELECT CAST(p_partkey AS BIGINT) AS id, CAST(floor(p_partkey / 100.0) AS BIGINT) AS r, CAST(p_partkey % 100 AS BIGINT) AS c,
       CAST(110 AS DOUBLE) + CAST(p_partkey % 100 AS DOUBLE) * CAST(0.02 AS DOUBLE) AS lon,
       CAST(21 AS DOUBLE) + CAST(floor(p_partkey / 100.0) AS DOUBLE) * CAST(0.02 AS DOUBLE) AS lat,
       CASE WHEN p_partkey % 97 = 5 THEN NULL ELSE CAST((p_partkey * 53) % 1500 AS DOUBLE) END AS elevation
FROM part""",
    ),
    "fx_raw_feed": (
        "customer",
        """SELECT CAST(c_custkey AS BIGINT) * 2 + d.k AS seq,
       CASE WHEN c_custkey % 3 = 0 THEN concat(' ', CAST(c_custkey AS VARCHAR(20)), '.0 ') ELSE CAST(c_custkey AS VARCHAR(20)) END AS v_code,
       CASE WHEN (c_custkey + d.k) % 7 = 0 THEN '9999' WHEN (c_custkey + d.k) % 19 = 0 THEN 'abc' ELSE CAST(300 + (c_custkey * 4409) % 28000 AS VARCHAR(20)) END AS v_vis_primary,
       CASE WHEN c_custkey % 4 = 0 THEN '999999' ELSE CAST(500 + (c_custkey * 101) % 9000 AS VARCHAR(20)) END AS v_vis_secondary,
       CASE WHEN (c_custkey * 3 + d.k) % 5 = 0 THEN '9999' ELSE CAST((c_custkey * 19) % 101 AS VARCHAR(20)) END AS v_rh,
       CAST((c_custkey * 13 + d.k * 7) % 60 AS BIGINT) AS update_minute
FROM customer CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 AS k) d""",
    ),
    "fx_pairs": (
        "lineitem",
        """SELECT CASE l_returnflag WHEN 'A' THEN 'M1' WHEN 'N' THEN 'M2' ELSE 'M3' END AS model,
       CASE l_linestatus WHEN 'F' THEN 'national' ELSE 'regional' END AS station_type,
       l_shipdate AS dt, l_quantity / 10 AS obs,
       l_extendedprice / 20000 + CASE WHEN l_linenumber % 7 = 0 THEN -6 ELSE 0 END AS fc
FROM lineitem""",
    ),
    "fx_tiles": (
        "part",
        """SELECT t.tile_id, g.r, g.c, g.lon, g.lat, g.elevation + t.bias AS elevation
FROM (SELECT CAST(floor(p_partkey / 100.0) AS BIGINT) AS r, CAST(p_partkey % 100 AS BIGINT) AS c,
             CAST(110 AS DOUBLE) + CAST(p_partkey % 100 AS DOUBLE) * CAST(0.02 AS DOUBLE) AS lon,
             CAST(21 AS DOUBLE) + CAST(floor(p_partkey / 100.0) AS DOUBLE) * CAST(0.02 AS DOUBLE) AS lat,
             CASE WHEN p_partkey % 97 = 5 THEN NULL ELSE CAST((p_partkey * 53) % 1500 AS DOUBLE) END AS elevation FROM part) g
JOIN (SELECT 1 AS tile_id, 0 AS c0, 50 AS c1, 0 AS p, CAST(0 AS DOUBLE) AS bias UNION ALL SELECT 2, 49, 99, 0, CAST(7 AS DOUBLE)
      UNION ALL SELECT 3, 0, 48, 1, CAST(0 AS DOUBLE) UNION ALL SELECT 4, 51, 99, 1, CAST(3 AS DOUBLE)) t
  ON g.c BETWEEN t.c0 AND t.c1 AND ((t.p = 0 AND g.r < 9) OR (t.p = 1 AND g.r > 10))""",
    ),
}

#: A concave ring (lon, lat), closed; its vertices lie off the grid.
RING = ((110.31, 21.03), (111.71, 21.05), (111.51, 21.35), (110.91, 21.21), (110.41, 21.37), (110.31, 21.03))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, sql = VIEWS[name]
    return spark.sql(sql.replace(f"FROM {source}", "FROM {source}"), source=table(spark, sf_dir, source))


def cte(*names: str) -> str:
    """The views as the front of a query: "WITH a AS (...), b AS (...)"."""
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n][1]})" for n in names)
