"""What the sources and tables do with rows that cannot load as they are."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.checks.files import _write_with_header, write_delimited
from tallyward.checks.registry import query, table
from tallyward.operators.attach import attach
from tallyward.operators.paging import page
from tallyward.plans import staging
from tallyward.session import materialise, work_path
from tallyward.sources.delimited import FAULT, ORIGINAL, SOURCE, scan
from tallyward.sources.keyed import KEYS, append_new_keys
from tallyward.sources.tables import create_table, read_table, write_table

_HOT_KEY = "case when l_partkey % 5 = 0 then null when l_partkey % 5 < 4 then l_suppkey % 200 else l_orderkey end"


@query(
    "skewed_lookup",
    f"""select l_orderkey, l_linenumber, key, o_custkey as place
    from (select l_orderkey, l_linenumber, {_HOT_KEY} as key from lineitem)
    left join orders on o_orderkey = key""",
)
def _(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.expr(_HOT_KEY).alias("key"))
    return attach(lines, "key", table(spark, folder, "orders"), "o_orderkey", {"place": "o_custkey"})


@query(
    "deep_page",
    "select o_orderkey, o_totalprice from orders order by o_totalprice, o_orderkey limit 50 offset 1200",
)
def _(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return page(orders, ["o_totalprice", "o_orderkey"], limit=50, offset=1200)


@query("append_table", "select count(*) as n, count(*) as ids, cast(1 as bigint) as least from customer")
def _(spark, folder):
    """One table filled by two appends; its row ids stay unique."""
    name = f"tallyward_checks.t{uuid.uuid4().hex}"
    spark.sql("CREATE DATABASE IF NOT EXISTS tallyward_checks")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    columns = T.StructType([T.StructField("id", T.LongType()), *customers.schema.fields])
    early = F.col("c_custkey") % 3 == 0
    for part in (customers.filter(early), customers.filter(~early)):
        write_table(part, name, columns=columns)
    result = spark.table(name).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"), F.min("id").alias("least")
    )
    return _without_table(result, name)


def _without_table(result, *names):
    """The result, written, after its tables are gone."""
    written = materialise(result, "result")
    for name in names:
        result.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    return written


# The first delivery has some rows twice and some without a key; the second repeats others inside, and
# brings some that the first has loaded or set aside.
_DELIVERIES = {
    1: ["o_orderkey % 3 <> 0", "o_orderkey % 3 <> 0 and o_orderkey % 11 = 1"],
    2: ["o_orderkey % 3 = 0", "o_orderkey % 3 = 0 and o_orderkey % 13 = 2", "o_orderkey % 3 <> 0 and o_orderkey % 5 = 0"],
}
_KEY = "case when o_orderkey % 17 = 4 then null else o_orderkey end"
_DELIVERED = {
    n: " union all ".join(f"select {_KEY} as key, o_custkey as place from orders where {part}" for part in parts)
    for n, parts in _DELIVERIES.items()
}


@query(
    "pk_across_loads",
    f"""with one as (select *, count(*) over (partition by key) as n from ({_DELIVERED[1]})),
    two as (select *, count(*) over (partition by key) as n from ({_DELIVERED[2]})),
    held as (select key from one where n = 1 and key is not null)
    select 1 as load, key, place, case when key is null then 'missing key' when n > 1 then 'repeated key' end as reason
    from one union all
    select 2, key, place, case when key is null then 'missing key'
      when key in (select key from held) then 'the table has this key' when n > 1 then 'repeated key' end
    from two""",
)
def _(spark, folder):
    """Two deliveries into one table; its key holds over both."""
    name = f"tallyward_checks.t{uuid.uuid4().hex}"
    spark.sql("CREATE DATABASE IF NOT EXISTS tallyward_checks")
    orders, parts = table(spark, folder, "orders"), []
    for n, wanted in _DELIVERIES.items():
        rows = [orders.filter(w).select(F.expr(_KEY).alias("key"), F.col("o_custkey").alias("place")) for w in wanted]
        split = append_new_keys(reduce(DataFrame.unionByName, rows), name, ["key"])
        load = F.lit(n).alias("load")
        parts.append(split.violations.select(load, "key", "place", "reason"))
        parts.append(split.valid.select(load, "key", "place", F.lit(None).cast("string").alias("reason")))
    return _without_table(reduce(DataFrame.unionByName, parts), name, f"{name}_{KEYS}")


_WIDE = "c_custkey % 10 = 3"


@query(
    "wide_lines",
    f"""select c_custkey, case when {_WIDE} then 'too many cells' end as fault,
      case when {_WIDE} then cast(c_custkey as varchar) || ';' || c_name || ';' || c_mktsegment end as text
    from customer""",
)
def _(spark, folder):
    path = work_path(spark, "wide")
    cells = F.when(F.expr(_WIDE), F.concat_ws(";", "c_name", "c_mktsegment")).otherwise(F.col("c_name"))
    _write_with_header(table(spark, folder, "customer").select("c_custkey", cells.alias("name")), path, "key;name")
    read = scan(spark, f"{path}/*.txt", ";", lineage=True)
    return read.select(
        F.col("key").cast("long").alias("c_custkey"), F.col(FAULT).alias("fault"), F.col(ORIGINAL).alias("text")
    )


@query("quoted_newline", "select p_partkey, p_name || chr(10) || '\"' || p_type || '\"' as text from part")
def _(spark, folder):
    path = work_path(spark, "quoted")
    text = F.concat("p_name", F.lit('\n"'), "p_type", F.lit('"')).alias("text")
    write_delimited(table(spark, folder, "part").select("p_partkey", text), path, ",")
    return scan(spark, f"{path}/*.csv", ",", multi_line=True).select(F.col("p_partkey").cast("long"), "text")


_CODED = T.StructType([T.StructField("key", T.IntegerType()), T.StructField("half", T.IntegerType())])


def _deliver(rows, path, *columns):
    write_delimited(rows.select(*[F.expr(c).alias(n) for n, c in zip(_CODED.names, columns)]), path, ";")


@query(
    "stage_coercion",
    """select cast(c_custkey as integer) as key,
      case when c_custkey % 7 = 0 then null else cast(round_even(c_custkey / 2.0, 0) as integer) end as half
    from customer""",
)
def _(spark, folder):
    """Decimal texts in an integer column: halves go to the even neighbour."""
    path = work_path(spark, "decimals")
    half = "case when c_custkey % 7 = 0 then '' else cast(c_custkey / 2.0D as string) end"
    _deliver(table(spark, folder, "customer"), path, "cast(c_custkey as string) || '.0'", half)
    return staging.table_rows(staging.load_files(spark, f"{path}/*.csv", ";", {}, _CODED))


@query(
    "rejected_rows",
    """select cast(c_custkey as integer) as key, case when c_custkey % 10 = 0
      then '{"key":"' || cast(c_custkey as varchar) || '","half":"12x"}' end as text
    from customer where c_custkey % 2 = 0""",
)
def _(spark, folder):
    """Of two deliveries the one with faults is set aside whole; faulty rows keep their text.

    Both are as many files as there are partitions; blocks of keys are dealt out whole, so that every
    file of the second has a fault.
    """
    root, rows = work_path(spark, "halves"), table(spark, folder, "customer")
    _deliver(rows.filter("c_custkey % 2 = 1"), f"{root}/odd", "c_custkey", "1")
    bad = "case when c_custkey % 10 = 0 then '12x' else '3' end"
    even = rows.filter("c_custkey % 2 = 0").repartition(F.expr("c_custkey div 100"))
    _deliver(even, f"{root}/even", "c_custkey", bad)
    load = staging.load_files(spark, f"{root}/*/*.csv", ";", {}, _CODED)
    return load.rejected.select("key", F.col(ORIGINAL).alias("text"))


_PLACES = T.StructType([T.StructField("place", T.IntegerType()), T.StructField("municipio_uf", T.StringType())])


@query(
    "varchar_table",
    """select cast(c_custkey as integer) as place, substr(c_mktsegment, 1, 2) as municipio_uf from customer
    where c_custkey % 3 <> 1""",
)
def _(spark, folder):
    """Of three deliveries one has texts over their length and is set aside; the table would refuse them."""
    name, root = f"tallyward_checks.t{uuid.uuid4().hex}", work_path(spark, "states")
    spark.sql("CREATE DATABASE IF NOT EXISTS tallyward_checks")
    create_table(spark, name, _PLACES, {"municipio_uf": 2})
    customers = table(spark, folder, "customer")
    for n in range(3):
        state = F.substring("c_mktsegment", 1, 3 if n == 1 else 2).alias("municipio_uf")
        rows = customers.filter(F.col("c_custkey") % 3 == n).select(F.col("c_custkey").alias("place"), state)
        write_delimited(rows, f"{root}/{n}", ";")
    load = staging.load_files(spark, f"{root}/*/*.csv", ";", {}, _PLACES)
    staging.table_rows(load).write.insertInto(name)
    return _without_table(read_table(spark, name, ["place", "municipio_uf"]), name)


@query(
    "file_stats",
    """select 'full' as delivery, count(*) as n_read, cast(0 as bigint) as n_faulty, count(*) as n_loaded
    from customer union all select 'header', 0, 0, 0""",
)
def _(spark, folder):
    """A file that has only a header has its line in the statistics too."""
    root, rows = work_path(spark, "stats"), table(spark, folder, "customer")
    _deliver(rows, f"{root}/full", "c_custkey", "1")
    _deliver(rows.limit(0), f"{root}/header", "c_custkey", "1")
    stats = staging.load_files(spark, f"{root}/*/*.csv", ";", {}, _CODED).stats
    delivery = F.regexp_extract(SOURCE, "(full|header)/[^/]*$", 1).alias("delivery")
    return stats.groupBy(delivery).agg(*[F.sum(c).alias(c) for c in ("n_read", "n_faulty", "n_loaded")])
