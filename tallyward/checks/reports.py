"""Ad hoc SQL and report tables."""

from pyspark.sql import functions as F

from tallyward.checks.registry import query, table
from tallyward.fixed_values import UNKNOWN
from tallyward.functions.text import clean_text
from tallyward.operators.attach import attach
from tallyward.plans import marts, report_state
from tallyward.plans.adhoc import run_sql
from tallyward.session import work_path
from tallyward.sources.tables import replace_partitions

_PARAM = """select o_orderpriority, count(*) as n, min(o_totalprice) as lowest
    from {orders} where o_orderstatus = {status} and o_totalprice >= {price}
    group by o_orderpriority"""


@query("param_sql", _PARAM.format(orders="orders", status="'F'", price="1000.5"))
def _(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("incident_orders")
    text = _PARAM.format(orders="incident_orders", status="%(status)s", price="%(price)s")
    return run_sql(spark, text, {"status": "F", "price": 1000.5})


def _order_places(spark, folder, *by):
    """Orders counted by customer and ``by``, then with the nation: one row per group is joined."""
    counts = table(spark, folder, "orders").groupBy("o_custkey", *by).agg(F.count(F.lit(1)).alias("orders"))
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return counts.join(customers, F.col("o_custkey") == F.col("c_custkey"))


@query(
    "mart_monthly",
    """select cast(date_trunc('month', o_orderdate) as date) as month, c_nationkey, count(*) as n
    from orders join customer on c_custkey = o_custkey group by 1, 2""",
)
def _(spark, folder):
    month = F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month")
    return marts.monthly(_order_places(spark, folder, month), F.col("month"), [F.col("c_nationkey")], "orders")


@query(
    "mart_by_dimension",
    """select coalesce(n_name, 'DESCONHECIDO') as label, count(*) as n
    from (select case when o_orderkey % 10 = 0 then -1 else c_nationkey end as place
      from orders join customer on c_custkey = o_custkey)
    left join nation on n_nationkey = place group by 1""",
)
def _(spark, folder):
    tenth = (F.col("o_orderkey") % 10 == 0).alias("tenth")
    place = F.when(F.col("tenth"), -1).otherwise(F.col("c_nationkey"))
    rows = _order_places(spark, folder, tenth).withColumn("place", place)
    nations = table(spark, folder, "nation")
    return marts.by_dimension(rows, "place", nations, "n_nationkey", "n_name", UNKNOWN, "orders")


@query(
    "mart_rate",
    """select o_orderpriority as agent, count(*) as n,
      count(*) filter (where o_orderstatus = 'F') as n_positive,
      cast(count(*) filter (where o_orderstatus = 'F') as double) / count(*) as rate
    from orders group by 1""",
)
def _(spark, folder):
    orders = table(spark, folder, "orders")
    flag = clean_text(F.col("o_orderstatus"))
    return marts.rate(orders, F.col("o_orderpriority").alias("agent"), flag, ["F"])


@query(
    "mart_topk",
    """select c_nationkey, o_orderpriority, n, rank from (
      select *, cast(row_number() over (partition by c_nationkey order by n desc, o_orderpriority)
        as integer) as rank
      from (select c_nationkey, o_orderpriority, count(*) as n
        from orders join customer on c_custkey = o_custkey group by 1, 2))
    where rank <= 3""",
)
def _(spark, folder):
    rows = _order_places(spark, folder, "o_orderpriority")
    return marts.top_k(rows, "c_nationkey", "o_orderpriority", 3, "orders")


@query(
    "mart_age_band",
    """select case when age is null then 'DESCONHECIDO' when age < 1 then '0-0' when age < 2 then '1-1'
        when age < 4 then '2-3' else '4+' end as band, count(*) as n
    from (select case when l_shipdate >= o_orderdate
      then date_sub('year', cast(o_orderdate as date), cast(l_shipdate as date)) end as age from lineitem join orders on o_orderkey = l_orderkey) group by 1""",
)
def _(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_shipdate")
    age = marts.age_in_years(F.col("o_orderdate"), F.col("l_shipdate"))
    band = marts.age_band(age, [1, 2, 4], UNKNOWN).alias("band")
    dated = attach(lines, "l_orderkey", orders, "o_orderkey", {"o_orderdate": "o_orderdate"})
    joined = dated.filter("o_orderdate is not null")
    return joined.groupBy(band).agg(F.count(F.lit(1)).alias("n"))


@query(
    "dedup",
    """select md5(text) as digest, lang, min(doc_id) as doc_id, count(*) as copies
    from documents group by text, lang""",
)
def _(spark, folder):
    # Whole texts are compared by digest: 16 bytes shuffle per row, not the text.
    documents = table(spark, folder, "documents")
    return marts.deduplicate(
        documents, [F.md5("text").alias("digest"), F.col("lang")], F.min("doc_id").alias("doc_id")
    )


@query(
    "mart_cube",
    """select c_nationkey, c_mktsegment, o_orderstatus, count(*) as n,
      grouping_id(c_nationkey, c_mktsegment, o_orderstatus) as level
    from orders join customer on c_custkey = o_custkey group by cube (c_nationkey, c_mktsegment, o_orderstatus)""",
)
def _(spark, folder):
    counts = table(spark, folder, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    placed = attach(counts, "o_custkey", customers, "c_custkey", {"c_nationkey": "c_nationkey", "c_mktsegment": "c_mktsegment"})
    return marts.cube(placed.filter("c_nationkey is not null"), ["c_nationkey", "c_mktsegment", "o_orderstatus"], "orders")


@query(
    "mart_incremental",
    """select cast(date_trunc('month', o_orderdate) as date) as month, o_orderstatus, count(*) as n,
      count(*) filter (o_orderpriority = '1-URGENT') as n_urgent
    from orders group by 1, 2""",
)
def _(spark, folder):
    """Three loads, the second of them first with other rows and then again."""
    path, orders = work_path(spark, "state"), table(spark, folder, "orders")
    by = {"month": F.trunc(F.col("o_orderdate").cast("date"), "month"), "o_orderstatus": F.col("o_orderstatus")}
    flags = {"urgent": F.col("o_orderpriority") == "1-URGENT"}
    for load, wanted in ((1, "= 0"), (2, "<> 0"), (2, "= 1"), (3, "= 2")):
        counts = report_state.partial_counts(orders.filter(f"o_orderkey % 3 {wanted}"), by, flags)
        report_state.record(counts, path, load)
    return report_state.report(spark, path, counts.schema)


_RELOADED = "year(o_orderdate) in (1994, 1996)"


@query(
    "reload_year",
    f"""select o_orderkey, cast(year(o_orderdate) as integer) as year,
      case when {_RELOADED} then 2 else 1 end as delivery
    from orders where not ({_RELOADED}) or o_orderkey % 5 <> 0""",
)
def _(spark, folder):
    """All years are delivered once, two of them again with fewer rows."""
    path, orders = work_path(spark, "years"), table(spark, folder, "orders")
    rows = orders.select("o_orderkey", F.year("o_orderdate").alias("year"), F.lit(1).alias("delivery"))
    replace_partitions(rows, path, ["year"])
    again = orders.filter(f"{_RELOADED} and o_orderkey % 5 <> 0")
    replace_partitions(again.select("o_orderkey", F.year("o_orderdate").alias("year"), F.lit(2).alias("delivery")), path, ["year"])
    return spark.read.schema(rows.schema).parquet(path)
