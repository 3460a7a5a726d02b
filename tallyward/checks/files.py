"""Scans and sinks: tables are written as text files, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.checks.registry import query, table
from tallyward.operators.shape import typed
from tallyward.session import materialise, work_path
from tallyward.sources.delimited import FAULT, ORIGINAL, SOURCE, scan
from tallyward.sources.isolation import isolate, load_stats
from tallyward.sources.tables import append_files


def write_delimited(df: DataFrame, path: str, sep: str, **options) -> None:
    df.write.options(**options).csv(
        path, sep=sep, header=True, encoding="ISO-8859-1", escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def _write_with_header(df: DataFrame, path: str, header: str) -> None:
    """Lines under a header of our own, which may repeat names: once at the top of each file."""
    first_of_file = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    line = F.concat_ws(";", *[F.col(c).cast("string") for c in df.columns])
    df.select(
        F.when(first_of_file, F.concat(F.lit(header + "\n"), line)).otherwise(line).alias("value")
    ).write.text(path)


TEXT = "c_name || ' ñ;ó \"' || c_mktsegment || '\"'"


@query(
    "csv_scan_semicolon",
    f"select c_custkey, {TEXT} as name, c_acctbal from customer",
)
def _(spark, folder):
    path = work_path(spark, "csv")
    rows = table(spark, folder, "customer")
    write_delimited(rows.select("c_custkey", F.expr(TEXT).alias("name"), "c_acctbal"), path, ";")
    return scan(spark, f"{path}/*.csv", ";").select(
        F.col("c_custkey").cast("long"), "name", F.col("c_acctbal").cast("double")
    )


QUOTED = "p_name || ', \"' || p_type || '\", é'"


@query(
    "csv_scan_comma",
    f"select p_partkey as codigo, {QUOTED} as descricao, p_size from part",
)
def _(spark, folder):
    path = work_path(spark, "csv")
    rows = table(spark, folder, "part")
    write_delimited(rows.select("p_partkey", F.expr(QUOTED).alias("text"), "p_size"), path, ",")
    read = scan(spark, f"{path}/*.csv", ",", renames={"p_partkey": "codigo", "text": "descricao"})
    return read.select(F.col("codigo").cast("long"), "descricao", F.col("p_size").cast("int"))


@query("append_sink", "select o_orderkey, o_orderstatus, o_totalprice from orders")
def _(spark, folder):
    path = work_path(spark, "appended")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    first = F.col("o_orderstatus").eqNullSafe("F")
    append_files(orders.filter(first), path)
    append_files(orders.filter(~first), path)
    return spark.read.schema(orders.schema).parquet(path)


@query(
    "duplicate_header",
    """select event_id, value, event_type, user_id as "value.1", props as "event_type.1" from events""",
)
def _(spark, folder):
    path = work_path(spark, "repeated")
    events = table(spark, folder, "events")
    _write_with_header(
        events.select("event_id", "value", "event_type", "user_id", "props"),
        path,
        "event_id;value;event_type;value;event_type",
    )
    read = scan(spark, f"{path}/*.txt", ";")
    return read.select(
        F.col("event_id").cast("long"), F.col("value").cast("double"), "event_type",
        F.col("`value.1`").cast("long").alias("value.1"), "`event_type.1`",
    )


@query(
    "optional_scan",
    "select c_custkey, c_name from customer",
)
def _(spark, folder):
    path = work_path(spark, "present")
    write_delimited(table(spark, folder, "customer").select("c_custkey", "c_name"), path, ";")
    columns = T.StructType(
        [T.StructField("c_custkey", T.StringType()), T.StructField("c_name", T.StringType())]
    )
    present = scan(spark, f"{path}/*.csv", ";", expected=columns)
    absent = scan(spark, f"{path}/absent.csv", ";", expected=columns)
    return present.unionByName(absent).select(F.col("c_custkey").cast("long"), "c_name")


# Four folders of files; columns in another order in each, one lacks a column.
_PIECES = {
    0: ["o_orderkey", "o_custkey", "o_orderpriority"],
    1: ["o_orderpriority", "o_orderkey", "o_custkey"],
    2: ["o_custkey", "o_orderkey"],
    3: ["o_orderkey", "o_custkey", "o_orderpriority"],
}
_TABLE = T.StructType(
    [
        T.StructField("o_orderkey", T.IntegerType()),
        T.StructField("o_custkey", T.IntegerType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)
_CUSTOMER = """case when o_orderkey % 4 = 3 and o_orderkey % 100 = 3 then cast(o_custkey as varchar(20)) || 'a'
  else cast(o_custkey as varchar(20)) end"""


def _pieces(spark, folder) -> DataFrame:
    """Orders from four deliveries, lineage by delivery; the last one holds bad integers."""
    root = work_path(spark, "deliveries")
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.expr(_CUSTOMER).alias("o_custkey"), "o_orderpriority"
    )
    for piece, columns in _PIECES.items():
        part = orders.filter(F.col("o_orderkey") % len(_PIECES) == piece)
        write_delimited(part.select(columns), f"{root}/piece-{piece}", ";")
    rows = scan(spark, f"{root}/*/*.csv", ";", expected=_TABLE, lineage=True)
    delivery = F.regexp_extract(SOURCE, "(piece-[0-9])", 1)
    return typed(rows.withColumn(SOURCE, delivery).drop(ORIGINAL), _TABLE, FAULT)


_SQL_PIECES = f"""(select cast(o_orderkey as integer) as o_orderkey,
    try_cast({_CUSTOMER} as integer) as o_custkey,
    case when o_orderkey % 4 <> 2 then o_orderpriority end as o_orderpriority,
    'piece-' || cast(o_orderkey % 4 as varchar(2)) as arquivo_origem,
    case when try_cast({_CUSTOMER} as integer) is null then 'o_custkey is not an integer' end
      as motivo_rejeicao
  from orders)"""


@query("multi_file_union", f"select * from {_SQL_PIECES}")
def _(spark, folder):
    return _pieces(spark, folder)


@query(
    "load_stats",
    f"""select arquivo_origem, count(*) as n_read, count(motivo_rejeicao) as n_faulty,
      case when count(motivo_rejeicao) = 0 then count(*) else 0 end as n_loaded,
      min(motivo_rejeicao) as reason
    from {_SQL_PIECES} group by 1""",
)
def _(spark, folder):
    return load_stats(_pieces(spark, folder))


@query(
    "file_isolation",
    f"""with p as {_SQL_PIECES}
    select *, arquivo_origem not in (select arquivo_origem from p where motivo_rejeicao is not null)
      as loaded from p""",
)
def _(spark, folder):
    load = isolate(materialise(_pieces(spark, folder), "landed"))
    return load.rows.withColumn("loaded", F.lit(True)).unionByName(
        load.rejected.withColumn("loaded", F.lit(False))
    )
