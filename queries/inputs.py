"""Inputs of the registered queries.

The given tables hold no missing cells and no equal rows, so three dirty tables are
derived from them. One SQL text serves both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DIRTY_CUSTOMER = """
select c_custkey,
  case when c_custkey % 7 = 0 then null when c_custkey % 97 = 1 then cast('NaN' as double) else c_acctbal end as acctbal,
  case when c_custkey % 11 = 0 then null else c_nationkey end as nation,
  case when c_custkey % 13 = 0 then 'N/A' when c_custkey % 17 = 0 then '  '
       else concat(chr(9), ' ', c_mktsegment, ' ') end as segment,
  case c_custkey % 5 when 0 then 'Y' when 1 then ' no' when 2 then 'TRUE' when 3 then '0' else 'null' end as active,
  case c_custkey % 4 when 0 then 'yes' when 1 then 'No' when 2 then 'maybe' else '' end as opinion,
  case when c_custkey % 3 = 0 then null else c_acctbal > 0 end as in_credit,
  cast(null as double) as all_null,
  cast(1 as double) as constant
from customer
"""

DIRTY_CUSTOMER_DUP = """
select * from dirty_customer union all select * from dirty_customer where c_custkey % 50 = 0
"""

SPIKY_LINEITEM = """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
  case when l_orderkey % 500 = 0 then l_extendedprice * 50 else l_extendedprice end as price,
  case when l_orderkey % 19 = 0 then null else l_discount end as discount,
  l_tax, l_returnflag
from lineitem
"""

# What standardizing the text of dirty_customer must give, spelled out in SQL.
CLEAN_CUSTOMER = """
select c_custkey, acctbal, nation,
  case when lower(trim(segment, ' ' || chr(9) || chr(10) || chr(13))) in ('', 'na', 'n/a', 'null', 'none', 'nan') then null
       else trim(segment, ' ' || chr(9) || chr(10) || chr(13)) end as segment,
  case when lower(trim(active)) in ('y', 'yes', 'true', '1') then 'Yes'
       when lower(trim(active)) in ('n', 'no', 'false', '0') then 'No' end as active,
  case when opinion = '' then null else opinion end as opinion,
  in_credit, all_null, constant
from {source}
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _select(text: str) -> list[str]:
    """The select list of one of the texts above, split at the commas between columns."""
    body = text.strip().removeprefix("select").rsplit("\nfrom", 1)[0]
    items, depth, start = [], 0, 0
    for i, c in enumerate(body):
        depth += (c == "(") - (c == ")")
        if c == "," and depth == 0:
            items.append(body[start:i])
            start = i + 1
    return [*items, body[start:]]


def dirty_customer(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(*_select(DIRTY_CUSTOMER))


def dirty_customer_dup(spark: SparkSession, folder: str) -> DataFrame:
    dirty = dirty_customer(spark, folder)
    return dirty.unionAll(dirty.where("c_custkey % 50 = 0"))


def spiky_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(*_select(SPIKY_LINEITEM))


def with_inputs(sql: str) -> str:
    """Put the derived tables in front of an oracle query that uses them."""
    return f"""with dirty_customer as ({DIRTY_CUSTOMER}),
dirty_customer_dup as ({DIRTY_CUSTOMER_DUP}),
spiky_lineitem as ({SPIKY_LINEITEM}),
clean_customer as ({CLEAN_CUSTOMER.format(source='dirty_customer')}),
clean_customer_dup as ({CLEAN_CUSTOMER.format(source='dirty_customer_dup')})
{sql.strip()}"""
