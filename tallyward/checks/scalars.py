"""Cleaning functions. The inputs are made dirty by one expression that both engines run."""

from pyspark.sql import functions as F

from tallyward.checks.registry import query, table
from tallyward.functions.dates import parse_date
from tallyward.functions.numbers import (
    blank_to_null,
    drop_check_digit,
    municipality_code,
    strict_int,
)
from tallyward.functions.text import clean_text, leading_code, missing_to_null

DIRTY_NAME = """case when p_partkey % 13 = 0 then null when p_partkey % 11 = 0 then ''
  when p_partkey % 7 = 0 then '{ñ class}' when p_partkey % 5 = 0 then ' nan '
  when p_partkey % 3 = 0 then chr(9) || p_name || '  ' else '  ' || p_name || ' ' end"""


@query(
    "clean_text",
    f"""select p_partkey, case when u is null or u in ('', 'NAN', 'NONE', '{{Ñ CLASS}}')
      then 'DESCONHECIDO' else u end as name
    from (select p_partkey, upper(trim({DIRTY_NAME}, ' ' || chr(9))) as u from part)""",
)
def _(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", clean_text(F.expr(DIRTY_NAME)).alias("name")
    )


MISSING = """case cast(p_partkey % 24 as int) when 0 then 'NA' when 1 then 'null' when 2 then 'None'
  when 3 then '#N/A N/A' when 4 then '-1.#QNAN' when 5 then '<NA>' when 6 then ''
  when 7 then 'n/a' when 8 then 'none' when 9 then ' ' when 10 then '-nan' else p_name end"""


@query(
    "missing_tokens",
    f"""select p_partkey, case when t in ('', 'NA', 'N/A', 'n/a', 'null', 'NULL', 'NaN', 'nan',
      '-NaN', '-nan', 'None', '<NA>', '#N/A', '#N/A N/A', '#NA', '1.#IND', '-1.#IND', '1.#QNAN',
      '-1.#QNAN') then null else t end as name
    from (select p_partkey, {MISSING} as t from part)""",
)
def _(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", missing_to_null(F.expr(MISSING)).alias("name")
    )


BLANK = """case when l_orderkey % 7 = 0 then '' when l_orderkey % 11 = 0 then 'NAN'
  when l_orderkey % 13 = 0 then 'NONE' else cast(cast(l_quantity as int) as varchar(10)) end"""


@query(
    "blank_numeric",
    f"""select l_orderkey, l_linenumber,
      case when t not in ('', 'NAN', 'NONE') then cast(t as integer) end as quantity
    from (select l_orderkey, l_linenumber,
      {BLANK} as t from lineitem)""",
)
def _(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", strict_int(blank_to_null(F.expr(BLANK))).alias("quantity")
    )


NUMBER = """case cast(l_orderkey % 9 as int) when 0 then '12a' when 1 then '' when 2 then '12.0'
  when 3 then ' 7 ' when 4 then '99999999999' when 5 then null
  when 6 then '+' || cast(cast(l_quantity as int) as varchar(10))
  when 7 then '-' || cast(cast(l_quantity as int) as varchar(10))
  else cast(cast(l_quantity as int) as varchar(10)) end"""


@query(
    "strict_int",
    f"""select l_orderkey, l_linenumber, v as quantity, t is not null and v is null as bad
    from (select l_orderkey, l_linenumber, t, case when regexp_full_match(trim(t), '[+-]?[0-9]+')
        then try_cast(replace(trim(t), '+', '') as integer) end as v
      from (select l_orderkey, l_linenumber, {NUMBER} as t from lineitem))""",
)
def _(spark, folder):
    texts = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.expr(NUMBER).alias("text"))
    read = texts.withColumn("quantity", strict_int(F.col("text")))  # parsed once, judged by the result
    bad = F.col("text").isNotNull() & F.col("quantity").isNull()
    return read.select("l_orderkey", "l_linenumber", "quantity", bad.alias("bad"))


def date_text(column: str, key: str) -> str:
    """A timestamp column as text in one of many spellings, some of them unreadable."""
    y, m, d = (f"cast({part}({column}) as varchar(4))" for part in ("year", "month", "day"))
    two = f"lpad({d}, 2, '0') || '/' || lpad({m}, 2, '0') || '/' || {y}"
    return f"""case cast({key} % 11 as int) when 0 then {d} || '/' || {m} || '/' || {y}
      when 1 then {y} || '/' || {m} || '/' || {d} when 2 then {y} || '-' || {m} || '-' || {d}
      when 3 then {y} || '/' || {m} when 4 then '31/02/' || {y} when 5 then '{{ñ class}}'
      when 6 then '  ' || {two} || ' ' when 7 then null when 8 then '01/02/25' else {two} end"""


def date_sql(text: str) -> str:
    """The same reading in DuckDB."""
    shapes = {
        "[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}": "%d/%m/%Y",
        "[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}": "%Y/%m/%d",
        "[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}": "%Y-%m-%d",
        "[0-9]{4}/[0-9]{1,2}": "%Y/%m",
    }
    tries = [
        f"case when regexp_full_match(trim({text}), '{shape}') "
        f"then try_strptime(trim({text}), '{fmt}') end"
        for shape, fmt in shapes.items()
    ]
    return f"cast(coalesce({', '.join(tries)}) as date)"


@query(
    "parse_date",
    f"""select o_orderkey, {date_sql('t')} as order_date
    from (select o_orderkey, {date_text('o_orderdate', 'o_orderkey')} as t from orders)""",
)
def _(spark, folder):
    text = F.expr(date_text("o_orderdate", "o_orderkey"))
    return table(spark, folder, "orders").select("o_orderkey", parse_date(text).alias("order_date"))


PLACE = """case when c_custkey % 17 = 0 then '-' || c_name when c_custkey % 11 = 0 then ' DESCONHECIDO '
  when c_custkey % 7 = 0 then cast(c_custkey as varchar(20))
  else '  ' || cast(c_custkey as varchar(20)) || ' -' || c_name || '-x' end"""


@query(
    "leading_code",
    f"""select c_custkey, trim(split_part(t, '-', 1)) as code
    from (select c_custkey, {PLACE} as t from customer)""",
)
def _(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", leading_code(F.expr(PLACE)).alias("code")
    )


@query(
    "default_code",
    f"""select c_custkey, try_cast(case when code = 'DESCONHECIDO' then '0' else code end as integer)
      as code
    from (select c_custkey, trim(split_part(case when trim(t) in ('', 'NAN', 'NONE') or t is null
        then 'DESCONHECIDO' else trim(t) end, '-', 1)) as code
      from (select c_custkey, case when c_custkey % 5 = 0 then null else {PLACE} end as t
        from customer))""",
)
def _(spark, folder):
    raw = F.when(F.col("c_custkey") % 5 != 0, F.expr(PLACE))
    return table(spark, folder, "customer").select(
        "c_custkey", municipality_code(raw).alias("code")
    )


@query(
    "drop_check_digit",
    """select c_name, cast(c_custkey // 10 as integer) as code from customer
    where c_custkey > 9 and c_custkey // 10 <> 0""",
)
def _(spark, folder):
    code = drop_check_digit(F.col("c_custkey"))
    # Short codes and code 0 go.
    return table(spark, folder, "customer").select("c_name", code.alias("code")).filter("code <> 0")
