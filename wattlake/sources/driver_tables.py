"""Contract-shaped landing frame derived from the star-schema test tables.

The lake's landing input is a wide, all-text contract file.  For benchmarks
and oracle checks the same shape is derived from the driver tables
(``lineitem`` joined to its dimensions), so every job runs on data that grows
with the scale factor.  Mapping (one contract line per ``lineitem`` row):

* ``id_transaccion``    ``orderkey-linenumber-partkey-suppkey``
* ``fecha_transaccion`` order date;  ``fecha_contrato`` ship date
* ``tipo_transaccion``  return flag A/R/other -> ``Compra``/``VENTA``/``ajuste``
  (mixed case on purpose: the views compare case-insensitively)
* ``cliente_proveedor`` customer name; ``tipo_cliente`` lower-cased market
  segment, NULL on every fifth line number (exercises the default)
* ``cantidad_kwh``/``precio_kwh``  quantity / discount, as text
* ``tipo_energia``      part type; ``ciudad`` the supplier's nation
* ``nombre_proveedor``/``capacidad_mw``  supplier name / account balance

Real landing files are dirty, so some order keys give broken lines, by
divisibility (``DIRTY``): missing or repeated ids, values that do not parse,
missing cities, and provider-only lines shifted by one column.

Join shape: ``orders`` is joined to ``customer`` *before* meeting
``lineitem``, so the lineitem-sized side is shuffled on at most three keys
(part, order, supplier) instead of four, and in this order: ``part`` adds one
short column, so the rows are still narrow when they are shuffled by order;
after that the lines of an order stay together, which their files compress
well; ``supplier``, the smallest of the three, is the last that may need a
shuffle of the wide rows. ``nation`` (a fixed 25-row
dimension) comes last, where its static size estimate alone makes it a
broadcast.  No side is force-broadcast; Spark's size-checked broadcast
threshold and AQE (runtime sizes) pick the strategy of every join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.schemas import DRIVER_TABLES


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    reader = spark.read
    if name in DRIVER_TABLES:
        reader = reader.schema(DRIVER_TABLES[name])
    df = reader.parquet(path)
    if columns:
        df = df.select(*columns)
    return df


def _as_text(c: str):
    return F.col(c).cast("string")


#: What is broken -> lines with an order key divisible by this number have it.
DIRTY = {"no_id": 97, "same_id": 31, "kwh": 41, "price": 43, "date": 47, "shifted": 53, "no_city": 59,
         "capacity": 61, "contract_date": 67}


def contratos_from_tables(spark: SparkSession, sf_dir: str, order_dates: tuple[str, str] | None = None) -> DataFrame:
    """The landing frame; ``order_dates`` (first, last day) limits it to
    orders of that range, at the scan."""
    li = table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_discount", "l_returnflag", "l_shipdate"]).withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    orders = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    if order_dates is not None:
        first, last = (F.lit(d).cast("timestamp_ntz") for d in order_dates)
        orders = orders.where((F.col("o_orderdate") >= first) & (F.col("o_orderdate") < last + F.expr("INTERVAL 1 DAY")))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    order_cust = (orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
                  .join(customer, orders.o_custkey == customer.c_custkey))

    j = (li.join(part, li.l_partkey == part.p_partkey)
           .join(order_cust, li.l_orderkey == order_cust.o_orderkey)
           .join(supplier, li.l_suppkey == supplier.s_suppkey)
           .join(nation, F.col("s_nationkey") == nation.n_nationkey))

    flag = F.col("l_returnflag")
    dirty = {k: F.col("l_orderkey") % n == 0 for k, n in DIRTY.items()}
    shifted, nothing = dirty["shifted"], F.lit(None).cast("string")
    order, line = _as_text("l_orderkey"), _as_text("l_linenumber")
    own_id = F.concat(order, F.lit("-"), line, F.lit("-"), _as_text("l_partkey"), F.lit("-"), _as_text("l_suppkey"))
    unless = lambda bad, value, instead=nothing: F.when(bad, instead).otherwise(value)
    return j.select(
        unless(shifted | dirty["no_id"], F.when(dirty["same_id"], F.concat(order, F.lit("-again"))).otherwise(own_id))
        .alias("id_transaccion"),
        unless(dirty["date"], _as_text("o_orderdate"), F.lit("sin fecha")).alias("fecha_transaccion"),
        F.when(flag == "A", "Compra").when(flag == "R", "VENTA").otherwise("ajuste")
         .alias("tipo_transaccion"),
        unless(shifted, F.col("c_name")).alias("cliente_proveedor"),
        unless(dirty["kwh"], _as_text("l_quantity"), F.lit("n/d")).alias("cantidad_kwh"),
        unless(dirty["price"], _as_text("l_discount"), F.lit("gratis")).alias("precio_kwh"),
        F.col("p_type").alias("tipo_energia"),
        F.lit("12:00:00").alias("hora_transaccion"),
        F.when(shifted, F.col("s_name")).when(dirty["no_city"], nothing).otherwise(F.col("n_name")).alias("ciudad"),
        unless(shifted, F.col("s_name"), _as_text("s_acctbal")).alias("nombre_proveedor"),
        F.when(shifted, _as_text("l_shipdate")).when(dirty["capacity"], F.lit("alta"))
         .otherwise(_as_text("s_acctbal")).alias("capacidad_mw"),
        F.when(shifted, nothing).when(dirty["contract_date"], F.lit("ayer"))
         .otherwise(_as_text("l_shipdate")).alias("fecha_contrato"),
        F.when((F.col("l_linenumber") % 5 == 0) | shifted, nothing)
         .otherwise(F.lower("c_mktsegment")).alias("tipo_cliente"),
    )


# The same mapping as SQL, for the DuckDB oracle (tables pre-registered).
CONTRATOS_SQL = """
select case when l_orderkey % 53 = 0 or l_orderkey % 97 = 0 then null
            when l_orderkey % 31 = 0 then concat(cast(l_orderkey as varchar), '-again')
            else concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) end as id_transaccion,
       case when l_orderkey % 47 = 0 then 'sin fecha' else cast(cast(o_orderdate as date) as varchar) end as fecha_transaccion,
       case l_returnflag when 'A' then 'Compra' when 'R' then 'VENTA' else 'ajuste' end as tipo_transaccion,
       if(l_orderkey % 53 = 0, null, c_name) as cliente_proveedor,
       if(l_orderkey % 41 = 0, 'n/d', cast(l_quantity as varchar)) as cantidad_kwh,
       if(l_orderkey % 43 = 0, 'gratis', cast(l_discount as varchar)) as precio_kwh, p_type as tipo_energia,
       '12:00:00' as hora_transaccion,
       case when l_orderkey % 53 = 0 then s_name when l_orderkey % 59 = 0 then null else n_name end as ciudad,
       if(l_orderkey % 53 = 0, cast(s_acctbal as varchar), s_name) as nombre_proveedor,
       case when l_orderkey % 53 = 0 then cast(cast(l_shipdate as date) as varchar)
            when l_orderkey % 61 = 0 then 'alta' else cast(s_acctbal as varchar) end as capacidad_mw,
       case when l_orderkey % 53 = 0 then null when l_orderkey % 67 = 0 then 'ayer'
            else cast(cast(l_shipdate as date) as varchar) end as fecha_contrato,
       case when l_linenumber % 5 = 0 or l_orderkey % 53 = 0 then null else lower(c_mktsegment) end as tipo_cliente
from lineitem
join orders on l_orderkey = o_orderkey
join customer on o_custkey = c_custkey
join part on l_partkey = p_partkey
join supplier on l_suppkey = s_suppkey
join nation on s_nationkey = n_nationkey
"""
