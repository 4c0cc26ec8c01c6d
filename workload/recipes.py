"""Pairs of table versions to compare, made from the test tables.

A comparison needs two versions of a table that differ in known ways. Each recipe reads a whole table and
changes some of its rows (every fiftieth, say) by a fixed rule; nothing is left out to save work. Every recipe
exists twice: as a DataFrame and as SQL text, written separately.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY_OFFSET = 10_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def one_in(column: str, n: int, remainder: int) -> Column:
    return F.pmod(F.col(column), F.lit(n)) == remainder


def copies(df: DataFrame, number: Column) -> DataFrame:
    """Each row as often as ``number`` says (0 drops it), numbered from 0 in ``copy``; one pass over the table."""
    return df.withColumn("copy", F.explode(F.slice(F.array(F.lit(0), F.lit(1)), F.lit(1), number)))


def change(df: DataFrame, column: str, where: Column, value: Column) -> DataFrame:
    return df.withColumn(column, F.when(where, value).otherwise(F.col(column)))


# -- R1, R3: orders against an altered copy ------------------------------------------------------------------


def orders_pair(spark: SparkSession, sf_dir: str, null_keys: bool = False) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    key = "o_orderkey"

    def is_(remainder: int) -> Column:
        return one_in("old_key", 50, remainder)

    def finish(df: DataFrame) -> DataFrame:
        if null_keys:
            df = change(df, key, one_in("old_key", 1000, 29), F.lit(None))
        return df.select(*orders.columns)

    old = orders.withColumn("old_key", F.col(key))
    source = copies(old, F.when(is_(23), 2).otherwise(1))
    target = copies(old, F.when(is_(7), 0).when(is_(11) | is_(19), 2).otherwise(1))
    target = change(target, key, is_(11) & (F.col("copy") == 1), F.col(key) + KEY_OFFSET)
    target = change(target, "o_totalprice", is_(13), F.col("o_totalprice") + 1)
    target = change(target, "o_orderstatus", is_(17), F.lit(None))
    return finish(source), finish(target)


ORDERS_PAIR_SQL = """
source AS (
  SELECT * FROM orders
  UNION ALL SELECT * FROM orders WHERE o_orderkey % 50 = 23
),
target AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 50 = 17 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderkey % 50 = 13 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 50 <> 7
  UNION ALL SELECT * REPLACE (o_orderkey + 10000000 AS o_orderkey) FROM orders WHERE o_orderkey % 50 = 11
  UNION ALL SELECT * FROM orders WHERE o_orderkey % 50 = 19
)"""

# The offset and both moduli are multiples of each other, so the altered key still tells the original remainder.
ORDERS_NULL_KEYS_SQL = (
    ORDERS_PAIR_SQL.replace("source AS (", "source0 AS (").replace("target AS (", "target0 AS (")
    + """,
source AS (
  SELECT * REPLACE (CASE WHEN o_orderkey % 1000 = 29 THEN NULL ELSE o_orderkey END AS o_orderkey) FROM source0
),
target AS (
  SELECT * REPLACE (CASE WHEN o_orderkey % 1000 = 29 THEN NULL ELSE o_orderkey END AS o_orderkey) FROM target0
)"""
)


# -- R2: lineitem by a composite key with natural duplicates -------------------------------------------------


def lineitem_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lineitem = table(spark, sf_dir, "lineitem")
    target = lineitem.where(~one_in("l_orderkey", 40, 3))
    return lineitem, change(target, "l_tax", one_in("l_orderkey", 40, 5), F.col("l_tax") + 0.5)


LINEITEM_PAIR_SQL = """
source AS (SELECT * FROM lineitem),
target AS (
  SELECT * REPLACE (CASE WHEN l_orderkey % 40 = 5 THEN l_tax + 0.5 ELSE l_tax END AS l_tax)
  FROM lineitem WHERE l_orderkey % 40 <> 3
)"""


# -- R4: orders before and after a load ----------------------------------------------------------------------


def orders_load(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(after, before)"""
    orders = table(spark, sf_dir, "orders")

    def is_(remainder: int) -> Column:
        return one_in("old_key", 50, remainder)

    old = orders.withColumn("old_key", F.col("o_orderkey"))
    before = copies(old, F.when(is_(7), 0).when(is_(11), 2).otherwise(1))
    before = change(before, "o_orderkey", is_(11) & (F.col("copy") == 1), F.col("o_orderkey") + KEY_OFFSET)
    before = change(before, "o_totalprice", is_(13), F.col("o_totalprice") - 1)
    before = change(before, "o_orderpriority", is_(17), F.lit(None))
    return orders, before.select(*orders.columns)


ORDERS_LOAD_SQL = """
after_load AS (SELECT * FROM orders),
before_load AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % 50 = 13 THEN o_totalprice - 1 ELSE o_totalprice END AS o_totalprice,
         o_orderdate,
         CASE WHEN o_orderkey % 50 = 17 THEN NULL ELSE o_orderpriority END AS o_orderpriority
  FROM orders WHERE o_orderkey % 50 <> 7
  UNION ALL SELECT * REPLACE (o_orderkey + 10000000 AS o_orderkey) FROM orders WHERE o_orderkey % 50 = 11
)"""


# -- R5: lineitem before and after a load, with duplicate keys -----------------------------------------------


def lineitem_load(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(after, before)"""
    lineitem = table(spark, sf_dir, "lineitem")
    repeated = copies(lineitem, F.when(one_in("l_orderkey", 40, 9), 2).otherwise(1)).drop("copy")
    before = repeated.where(~one_in("l_orderkey", 40, 3))
    taxed = one_in("l_orderkey", 40, 5) & (F.col("l_quantity") > 25)
    return repeated, change(before, "l_tax", taxed, F.col("l_tax") + 0.5)


LINEITEM_LOAD_SQL = """
after_load AS (
  SELECT * FROM lineitem
  UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 40 = 9
),
before_load AS (
  SELECT * REPLACE (CASE WHEN l_orderkey % 40 = 5 AND l_quantity > 25 THEN l_tax + 0.5 ELSE l_tax END AS l_tax)
  FROM after_load WHERE l_orderkey % 40 <> 3
)"""


# -- R6: events up to a point in time ------------------------------------------------------------------------


def events_so_far(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(all events, events already loaded)"""
    events = table(spark, sf_dir, "events")
    return events, events.where(F.col("ts") < F.lit("2024-01-25 00:00:00").cast("timestamp_ntz"))


EVENTS_SQL = "loaded AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-25 00:00:00')"


# -- R7: orders and a batch to load --------------------------------------------------------------------------


def orders_batch(spark: SparkSession, sf_dir: str, repeats: bool = False) -> tuple[DataFrame, DataFrame]:
    """(target, batch): changed rows, new rows and, if asked for, repeated rows."""
    orders = table(spark, sf_dir, "orders")
    changed, added = one_in("old_key", 20, 0), one_in("old_key", 20, 1)
    number = F.when(one_in("old_key", 40, 0), 2 if repeats else 1).when(changed | added, 1).otherwise(0)
    batch = copies(orders.withColumn("old_key", F.col("o_orderkey")), number)
    batch = change(batch, "o_totalprice", changed, F.col("o_totalprice") + 5)
    batch = change(batch, "o_orderkey", added, F.col("o_orderkey") + KEY_OFFSET)
    return orders, batch.select(*orders.columns)


ORDERS_BATCH_SQL = """
batch AS (
  SELECT * REPLACE (o_totalprice + 5 AS o_totalprice) FROM orders WHERE o_orderkey % 20 = 0
  UNION ALL SELECT * REPLACE (o_orderkey + 10000000 AS o_orderkey) FROM orders WHERE o_orderkey % 20 = 1
)"""
ORDERS_REPEATED_BATCH_SQL = """
batch AS (
  SELECT * REPLACE (o_totalprice + 5 AS o_totalprice) FROM orders WHERE o_orderkey % 20 = 0
  UNION ALL SELECT * REPLACE (o_totalprice + 5 AS o_totalprice) FROM orders WHERE o_orderkey % 40 = 0
  UNION ALL SELECT * REPLACE (o_orderkey + 10000000 AS o_orderkey) FROM orders WHERE o_orderkey % 20 = 1
)"""


def orders_moving_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(target, batch): rows of one status change, some of them to another status, and new ones come."""
    orders, batch = orders_batch(spark, sf_dir)
    batch = batch.where(F.col("o_orderstatus") == "F")
    return orders, change(batch, "o_orderstatus", one_in("o_orderkey", 60, 0), F.lit("P"))


ORDERS_MOVING_BATCH_SQL = """
batch AS (
  SELECT * REPLACE (o_totalprice + 5 AS o_totalprice, CASE WHEN o_orderkey % 60 = 0 THEN 'P' ELSE o_orderstatus END AS o_orderstatus)
  FROM orders WHERE o_orderkey % 20 = 0 AND o_orderstatus = 'F'
  UNION ALL
  SELECT * REPLACE (o_orderkey + 10000000 AS o_orderkey, CASE WHEN (o_orderkey + 10000000) % 60 = 0 THEN 'P' ELSE o_orderstatus END AS o_orderstatus)
  FROM orders WHERE o_orderkey % 20 = 1 AND o_orderstatus = 'F'
)"""


# -- R8: part and an older copy of it ------------------------------------------------------------------------


def _older_part(part: DataFrame, key: str, brand: str, size: str) -> DataFrame:
    older = part.where(~one_in(key, 25, 2))
    older = change(older, brand, one_in(key, 25, 4), F.lit(None))
    return change(older, size, one_in(key, 25, 6), F.col(size) + 1)


def part_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(current, snapshot)"""
    part = table(spark, sf_dir, "part")
    return part, _older_part(part, "p_partkey", "p_brand", "p_size")


PART_PAIR_SQL = """
snapshot AS (
  SELECT * REPLACE (
    CASE WHEN p_partkey % 25 = 4 THEN NULL ELSE p_brand END AS p_brand,
    CASE WHEN p_partkey % 25 = 6 THEN p_size + 1 ELSE p_size END AS p_size)
  FROM part WHERE p_partkey % 25 <> 2
)"""


# -- raw master data for the staging transforms --------------------------------------------------------------


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customers, under the raw customer table's column names."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    segment, priority, status = F.col("c_mktsegment"), F.col("o_orderpriority"), F.col("o_orderstatus")
    role = (
        F.when(segment == "BUILDING", " Sales Associate ")
        .when(segment == "MACHINERY", "inside sales")
        .otherwise(segment)
    )
    raw = {
        "CUST_NBR": F.col("o_orderkey"),
        "STREET": F.col("c_name"),
        "CITY": F.when(one_in("o_orderkey", 50, 17), None).otherwise(status),
        "PO_CD": priority,
        "REGION_KEY": F.col("c_nationkey"),
        "TEL_NBR_1": F.col("c_name"),
        "ANNUAL_SALES": F.col("o_totalprice"),
        "CENTRAL_SALES_BLK": F.when(status != "P", status),
        "ADRS_NBR": F.col("c_custkey"),
        "ACCT_GRP": segment,
        "CENTRAL_POST_BLK": status,
        "LANG_KEY": F.concat(F.lit("  "), priority, F.lit(" ")),
        "CENTRAL_ORDR_BLK": status,
        "SALES_REP_TP": priority,
        "SALES_REP_ROLE_CLASSIFICATION": role,
        "SALES_REP_CMPNY_CD": F.col("c_nationkey"),
        "SALES_REP_MISC_CD": priority,
        "CREATED_BY": F.col("c_name"),
        "CREATED_DT": F.col("o_orderdate"),
        "FIVETRANSYNC_DATE": F.col("o_orderdate"),
    }
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(*[value.alias(name) for name, value in raw.items()])


STAGED_CUSTOMERS_SQL = """
staged AS (
  SELECT o_orderkey AS CUSTOMER_ID,
         CASE WHEN o_orderkey % 50 = 17 THEN NULL
              ELSE c_name || ' ' || o_orderstatus || ' ' || o_orderpriority END AS ADDRESS,
         c_nationkey AS REGION_CODE,
         c_name AS PRIMARY_PHONE,
         o_totalprice AS ANNUAL_REVENUE,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS SALES_BLOCK_FLAG,
         c_custkey AS ADDRESS_ID,
         c_mktsegment AS ACCOUNT_GROUP,
         o_orderstatus AS POSTING_BLOCK_FLAG,
         o_orderpriority AS LANGUAGE_CODE,
         o_orderstatus AS ORDER_BLOCK_FLAG,
         replace(o_orderpriority, 'C', 'Z') AS SALES_REP_TYPE,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'SA' WHEN 'MACHINERY' THEN 'IS' END AS SALES_REP_ROLE,
         c_nationkey AS SALES_COMPANY_CODE,
         lower(o_orderpriority) AS SALES_REP_NAME,
         c_name AS CREATED_USER,
         strftime(o_orderdate, '%Y-%m-%d') AS CREATED_TIMESTAMP,
         o_orderdate AS FIVETRANSYNC_DATE
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""


def raw_material(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts, under the raw material table's column names."""
    raw = {
        "PRODUCT": F.col("p_partkey"),
        "PRODHIERARCHY": F.col("p_type"),
        "PRODGROUP": F.col("p_brand"),
        "PRODOLDID": F.col("p_name"),
        "PRODTYPE": F.col("p_type"),
        "TSHELFLIFE": F.col("p_size"),
        "MSHELF": F.col("p_retailprice"),
        "BUNIT": F.lower("p_type"),
        "ISBMREQUIRED": F.when(F.col("p_brand") == "Brand#2", "True").when(F.col("p_size") > 40, "true"),
    }
    return table(spark, sf_dir, "part").select(*[value.alias(name) for name, value in raw.items()])


STAGED_MATERIAL_SQL = """
staged AS (
  SELECT p_partkey AS M_NBR, p_type AS LVL_CD, p_brand AS M_GRP, p_name AS OM_NBR, p_type AS M_TP,
         p_size AS T_SH_LF, p_retailprice AS M_SH_LF, upper(p_type) AS BA_UOM,
         CASE WHEN p_brand = 'Brand#2' THEN 'X' ELSE ' ' END AS B_M_IND
  FROM part
)"""


def older_material(staged: DataFrame) -> DataFrame:
    return _older_part(staged, "M_NBR", "M_GRP", "T_SH_LF")


OLDER_MATERIAL_SQL = """
snapshot AS (
  SELECT * REPLACE (
    CASE WHEN M_NBR % 25 = 4 THEN NULL ELSE M_GRP END AS M_GRP,
    CASE WHEN M_NBR % 25 = 6 THEN T_SH_LF + 1 ELSE T_SH_LF END AS T_SH_LF)
  FROM staged WHERE M_NBR % 25 <> 2
)"""


# -- run results: every event is one executed node, every day one run ----------------------------------------


def run_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, event = F.col("event_type"), F.col("event_id").cast("string")
    status = (
        F.when(kind == "click", "Success")
        .when(kind == "view", "pass")
        .when(kind == "signup", "fail")
        .when(kind == "error", "Error")
        .otherwise("skipped")
    )
    unique_id = (
        F.when(kind == "signup", F.concat(F.lit("test.shop.check_"), event, F.lit("."), F.substring(F.md5(event), 1, 10)))
        .when(kind == "error", F.concat(F.lit("model.shop.load_"), event, F.lit("_"), F.md5(event)))
        .when(kind == "purchase", F.concat(F.lit("seed."), event))
        .otherwise(F.concat(F.lit("model.shop.load_"), event))
    )
    return table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("run"),
        unique_id.alias("unique_id"),
        status.alias("status"),
        F.col("value").alias("execution_time"),
        F.col("user_id").alias("rows_affected"),
    )


RUN_NODES_SQL = """
nodes AS (
  SELECT strftime(ts, '%Y%m%d') AS run,
         CASE event_type
           WHEN 'signup' THEN 'test.shop.check_' || event_id || '.' || substr(md5(event_id::VARCHAR), 1, 10)
           WHEN 'error' THEN 'model.shop.load_' || event_id || '_' || md5(event_id::VARCHAR)
           WHEN 'purchase' THEN 'seed.' || event_id
           ELSE 'model.shop.load_' || event_id END AS unique_id,
         CASE event_type
           WHEN 'signup' THEN 'check_' || event_id
           WHEN 'error' THEN CASE
             WHEN length('load_' || event_id || '_') + 32 > 48
             THEN substr('load_' || event_id || '_' || md5(event_id::VARCHAR), 1, 45) || '...'
             ELSE 'load_' || event_id || '_' || md5(event_id::VARCHAR) END
           WHEN 'purchase' THEN 'seed.' || event_id
           ELSE 'load_' || event_id END AS name,
         CASE event_type WHEN 'signup' THEN 'test' WHEN 'purchase' THEN 'seed' ELSE 'model' END AS type,
         CASE event_type WHEN 'click' THEN 'success' WHEN 'view' THEN 'pass' WHEN 'signup' THEN 'fail'
           WHEN 'error' THEN 'error' ELSE 'skipped' END AS status,
         value AS execution_time,
         user_id AS rows_affected
  FROM events
)"""


def run_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of a day and user as one document; some numbers are written as text, some documents are broken."""
    nodes = run_nodes(spark, sf_dir)
    user = F.col("rows_affected")
    known = ["unique_id", "status", "execution_time"]
    plain = F.to_json(F.struct(*known, "rows_affected"))
    odd = F.to_json(
        F.struct("unique_id", "status", F.col("execution_time").cast("string").alias("execution_time"),
                 user.cast("string").alias("rows_affected"), F.lit("OK").alias("adapter_response"))
    )
    texts = nodes.select(
        F.concat("run", F.lit("_"), user.cast("string")).alias("run"),
        user.alias("user"),
        F.when(F.col("status") == "pass", odd).otherwise(plain).alias("node"),
    )
    listed = F.array_join(F.collect_list("node"), ",")
    whole = F.concat(F.lit('{"elapsed_time": "1.5", "results": ['), listed, F.lit("]}"))
    return texts.groupBy("run", "user").agg(whole.alias("whole")).select(
        "run",
        F.lit(None).cast("timestamp").alias("modified_at"),
        F.when(one_in("user", 97, 5), "{ broken").otherwise(F.col("whole")).alias("text"),
    )


def daily_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of a day as one document: run, text."""
    node = F.to_json(F.struct("unique_id", "status", "execution_time", "rows_affected"))
    whole = F.concat(F.lit('{"elapsed_time": 2.5, "results": ['), F.array_join(F.collect_list("node"), ","), F.lit("]}"))
    nodes = run_nodes(spark, sf_dir).select("run", node.alias("node"))
    return nodes.groupBy("run").agg(whole.alias("text"))


def write_documents(documents: DataFrame, reports: str) -> None:
    """Each document as ``<reports>/<run>/run_results.json``. Spark writes one file per run; the driver names them."""
    spark = documents.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    written = f"{reports}_written"
    documents.repartition("run").write.mode("overwrite").partitionBy("run").option("lineSep", " ").text(written)
    fs = path(written).getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in fs.listStatus(path(written)):
        if not folder.isDirectory():
            continue
        target = path(f"{reports}/{folder.getPath().getName().removeprefix('run=')}/run_results.json")
        fs.mkdirs(target.getParent())
        fs.delete(target, False)
        (part,) = [f.getPath() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]
        if not fs.rename(part, target):
            raise RuntimeError(f"cannot move {part} to {target}")


Query = Callable[[SparkSession, str], DataFrame]
