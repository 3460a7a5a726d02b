"""Projections, dimensions, keys, pages."""

from pyspark.sql import functions as F

from tallyward.checks.registry import query, table
from tallyward.operators.dimensions import dense_keys, lookup, with_unknown
from tallyward.operators.paging import page
from tallyward.operators.quality import (
    count_rows,
    count_violations,
    fk_split,
    pk_violations,
    report,
    too_long,
)
from tallyward.operators.shape import rename, subset


@query(
    "rename_map",
    """select s_suppkey as codigo, s_name as descricao, s_nationkey, s_acctbal as "saldo.1"
    from supplier""",
)
def _(spark, folder):
    return rename(
        table(spark, folder, "supplier"),
        {"s_suppkey": "codigo", "s_name": "descricao", "s_acctbal": "saldo.1", "absent": "x"},
    )


@query("tolerant_select", "select s_name, s_suppkey from supplier")
def _(spark, folder):
    return subset(table(spark, folder, "supplier"), ["s_name", "absent", "s_suppkey"])


@query("table_projection", "select o_orderkey, o_custkey, o_orderdate from orders")
def _(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")


@query(
    "unknown_member",
    """select c_custkey + 1 as code, c_name as label from customer
    union all select 0, 'DESCONHECIDO'""",
)
def _(spark, folder):
    dim = table(spark, folder, "customer").select(
        (F.col("c_custkey") + 1).alias("code"), F.col("c_name").alias("label")
    )
    return with_unknown(dim, "code", "label")


@query(
    "empty_source",
    """select 'empty' as rule, cast(0 as bigint) as n
    union all select 'filled', count(*) + 1 from customer""",
)
def _(spark, folder):
    filled = table(spark, folder, "customer").select("c_custkey", "c_name")
    empty = filled.filter(F.col("c_name").isNull())
    return report(
        *[
            count_rows(rule, with_unknown(dim, "c_custkey", "c_name", unknown_code=-1))
            for rule, dim in (("empty", empty), ("filled", filled))
        ]
    )


@query(
    "surrogate_key",
    """select cast(row_number() over (order by p_name, p_brand, p_type) as integer) as id,
      p_name, p_brand, p_type
    from (select distinct p_name, p_brand, p_type from part)""",
)
def _(spark, folder):
    names = ["p_name", "p_brand", "p_type"]
    return dense_keys(table(spark, folder, "part").select(names).distinct(), names)


@query(
    "ordered_page",
    """select o_orderkey, o_orderdate, o_totalprice from orders
    order by o_orderdate, o_orderkey limit 1000 offset 500""",
)
def _(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return page(orders, ["o_orderdate", "o_orderkey"], limit=1000, offset=500)


@query(
    "pk_duplicates",
    """select l_orderkey, l_linenumber, count(*) as n
    from (select case when l_partkey % 50 = 0 then null else l_orderkey end as l_orderkey, l_linenumber
      from lineitem)
    group by 1, 2 having count(*) > 1 or l_orderkey is null or l_linenumber is null""",
)
def _(spark, folder):
    key = F.when(F.col("l_partkey") % 50 != 0, F.col("l_orderkey")).alias("l_orderkey")
    rows = table(spark, folder, "lineitem").select(key, "l_linenumber")
    return pk_violations(rows, ["l_orderkey", "l_linenumber"])


LABEL = "case when p_partkey % 9 = 0 then 'DESCONHECIDO' else p_name end"


@query(
    "length_violations",
    f"""select p_partkey, {LABEL} as name from part
    where length({LABEL}) > 9 and {LABEL} <> 'DESCONHECIDO'""",
)
def _(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", F.expr(LABEL).alias("name"))
    return parts.filter(too_long(F.col("name"), 9))


MOVED = """case when o_orderkey % 10 = 0 then o_custkey + 1000000000
  when o_orderkey % 17 = 0 then null else o_custkey end"""
_ORDERS = f"(select o_orderkey, {MOVED} as o_custkey, o_orderpriority from orders) o"


def _orders(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", F.expr(MOVED).alias("o_custkey"), "o_orderpriority"
    )


def _customer_keys(spark, folder):
    return table(spark, folder, "customer").select("c_custkey")


@query(
    "fk_orphans",
    f"""select * from {_ORDERS} where o_custkey is not null
      and not exists (select 1 from customer c where c.c_custkey = o.o_custkey)""",
)
def _(spark, folder):
    orders, customers = _orders(spark, folder), _customer_keys(spark, folder)
    return fk_split(orders, "o_custkey", customers, "c_custkey").violations


@query(
    "fk_valid",
    f"""select * from {_ORDERS} where o_custkey is null
      or exists (select 1 from customer c where c.c_custkey = o.o_custkey)""",
)
def _(spark, folder):
    orders, customers = _orders(spark, folder), _customer_keys(spark, folder)
    return fk_split(orders, "o_custkey", customers, "c_custkey").valid


@query(
    "quality_report",
    f"""select 'o_orderpriority too long' as rule, count(*) as n from {_ORDERS}
      where length(o_orderpriority) > 8
    union all select 'o_custkey missing', count(*) from {_ORDERS} where o_custkey is null
    union all select 'o_orderkey repeated', count(*) from (select o_orderkey from orders group by 1
      having count(*) > 1)
    union all select 'o_custkey not in customer', count(*) from {_ORDERS}
      where o_custkey is not null
        and not exists (select 1 from customer c where c.c_custkey = o.o_custkey)""",
)
def _(spark, folder):
    orders = _orders(spark, folder)
    orphans = fk_split(orders, "o_custkey", _customer_keys(spark, folder), "c_custkey").violations
    return report(
        count_violations(
            orders,
            {
                "o_orderpriority too long": too_long(F.col("o_orderpriority"), 8),
                "o_custkey missing": F.col("o_custkey").isNull(),
            },
        ),
        count_rows("o_orderkey repeated", pk_violations(orders, ["o_orderkey"])),
        count_rows("o_custkey not in customer", orphans),
    )


@query(
    "star_lookup",
    f"""select o.o_orderkey, o.o_custkey, o.o_orderpriority,
      coalesce(c.c_name, 'DESCONHECIDO') as customer, coalesce(n.n_name, 'DESCONHECIDO') as nation,
      l.n_lines, l.quantity
    from {_ORDERS} left join customer c on c.c_custkey = o.o_custkey
      left join nation n on n.n_nationkey = c.c_nationkey
      left join (select l_orderkey, count(*) as n_lines, sum(l_quantity) as quantity
        from lineitem group by 1) l on l.l_orderkey = o.o_orderkey""",
)
def _(spark, folder):
    # Labels are resolved on the dimension side first, so the rows meet one joined dimension.
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    places = lookup(customers, "c_nationkey", nations, "n_nationkey", {"nation": "n_name"})
    lines = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("quantity"))
    )
    orders = _orders(spark, folder)
    # Both sides are one row per order: no key can be hot.
    rows = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").drop("l_orderkey")
    labels = {"customer": "c_name", "nation": "nation"}
    return lookup(rows, "o_custkey", places, "c_custkey", labels)
