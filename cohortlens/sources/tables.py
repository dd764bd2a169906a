"""Event / mortality inputs derived from the star-schema parquet tables.

The benchmark data has no clinical tables, so patients are customers,
events are order lines (code class from the return flag, code from the part
key, date from the order date) and every third customer has a mortality row.
To bring out the rules for odd input some of these rows have label 0 or no
label, some customers have two rows, and some events no code or no date. The
mapping is plain SQL so the same text runs in DuckDB as the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the mapping: return flag -> code class, part-key modulus,
# death-date origin and spread, the dead-customer stride, and the strides of
# label 0, no label, a second mortality row, no code and no date.
FLAG_CLASS = {"A": "DIAG", "N": "LAB"}   # every other flag -> DRUG
CODE_MODULUS = 100
DEATH_ORIGIN = "2000-01-01"
DEATH_SPREAD_DAYS = 500
DEAD_STRIDE = 3
ZERO_STRIDE, NULL_STRIDE, TWICE_STRIDE = 15, 21, 12
NO_CODE_STRIDE, NO_DATE_STRIDE = 97, 89
SECOND_ROW_DAYS = 10


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_from_orders(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """(patientid bigint, eventid string, etimestamp date, value float).

    The patient key stays BIGINT: customer keys pass 2^31 at large scale
    factors, where an INT cast would fail under ANSI mode.

    One event per order line; a sort-merge (or AQE broadcast) join on the
    order key, with only four columns read from each table.
    """
    code_class = (F.when(F.col("l_returnflag") == "A", F.lit(FLAG_CLASS["A"]))
                  .when(F.col("l_returnflag") == "N", F.lit(FLAG_CLASS["N"]))
                  .otherwise(F.lit("DRUG")))
    lines = lineitem.select("l_orderkey", "l_partkey", "l_returnflag", "l_quantity")
    heads = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return (lines.join(heads, lines.l_orderkey == heads.o_orderkey, "inner")
            .select(F.col("o_custkey").alias("patientid"),
                    F.when(F.col("l_partkey") % NO_CODE_STRIDE != 0,
                           F.concat(code_class, (F.col("l_partkey") % CODE_MODULUS).cast("string"))).alias("eventid"),
                    F.when(F.col("l_orderkey") % NO_DATE_STRIDE != 0,
                           F.col("o_orderdate").cast("date")).alias("etimestamp"),
                    F.col("l_quantity").cast("float").alias("value")))


def mortality_from_customers(customer: DataFrame) -> DataFrame:
    """(patientid bigint, mtimestamp date, label int): every third customer,
    some with label 0 or none, some with a second row."""
    key = F.col("c_custkey")
    label = (F.when(key % ZERO_STRIDE == 0, F.lit(0)).when(key % NULL_STRIDE == 0, F.lit(None).cast("int"))
             .otherwise(F.lit(1)))
    later = F.when(key % TWICE_STRIDE == 0, F.array(F.lit(0), F.lit(SECOND_ROW_DAYS))).otherwise(F.array(F.lit(0)))
    return (customer.select("c_custkey").where(key % DEAD_STRIDE == 0)
            .select(key.alias("patientid"), label.alias("label"), F.explode(later).alias("later"))
            .select("patientid",
                    F.date_add(F.lit(DEATH_ORIGIN).cast("date"),
                               (F.col("patientid") % DEATH_SPREAD_DAYS).cast("int") + F.col("later")).alias("mtimestamp"),
                    "label"))


def cohort_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(events, mortality) for one scale-factor folder."""
    events = events_from_orders(read_table(spark, sf_dir, "lineitem"),
                                read_table(spark, sf_dir, "orders"))
    mortality = mortality_from_customers(read_table(spark, sf_dir, "customer"))
    return events, mortality


# The same mapping as DuckDB SQL, used by the oracle queries.
EV_SQL = """
select o.o_custkey as patientid,
       case when l.l_partkey % 97 <> 0 then
         concat(case l.l_returnflag when 'A' then 'DIAG' when 'N' then 'LAB' else 'DRUG' end,
                cast(l.l_partkey % 100 as varchar)) end as eventid,
       case when l.l_orderkey % 89 <> 0 then cast(o.o_orderdate as date) end as etimestamp,
       cast(l.l_quantity as float) as value
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
"""

MO_SQL = """
select c_custkey as patientid,
       cast(date '2000-01-01' + cast(c_custkey % 500 + later as int) as date) as mtimestamp,
       case when c_custkey % 15 = 0 then 0 when c_custkey % 21 = 0 then null else 1 end as label
from (select c_custkey, unnest(case when c_custkey % 12 = 0 then [0, 10] else [0] end) as later
      from customer where c_custkey % 3 = 0)
"""
