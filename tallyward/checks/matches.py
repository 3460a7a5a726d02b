"""Fuzzy joins, checked against all pairs in SQL."""

from pyspark.sql import functions as F

from tallyward.checks.registry import query, table
from tallyward.functions.text import clean_text
from tallyward.operators.matching import fuzzy_join

_AT = "cast(1 + p_partkey % length(p_name) as int)"

# Part names with a letter lost, a letter too many, reversed, or with more text behind.
MISSPELT = f"""case cast(p_partkey % 5 as int)
  when 1 then substr(p_name, 1, {_AT} - 1) || substr(p_name, {_AT} + 1)
  when 2 then substr(p_name, 1, {_AT}) || 'x' || substr(p_name, {_AT} + 1)
  when 3 then reverse(p_name) when 4 then p_name || ' ' || p_brand else p_name end"""

# A suffix for the names of these steps goes where the @ is.
LEVENSHTEIN_SQL = """pairs@ as (
    select v, e, 1 - cast(levenshtein(v, e) as double) / greatest(length(v), length(e)) as score
    from vals@, ents@)"""

# Similarity by matching blocks: the longest common run (leftmost in the entry, then in the value), then the
# same on what lies to its left and to its right. Twice the matched length over both lengths.
RATIO_SQL = """pieces@ as (
    select v, e, e as a, v as b, 0 as n from vals@, ents@
    union all
    select v, e,
      unnest([substr(a, 1, best.i - 1), substr(a, best.i + best.n)]),
      unnest([substr(b, 1, best.j - 1), substr(b, best.j + best.n)]),
      unnest([best.n, 0])
    from (select v, e, a, b, {'n': run.n, 'i': -run.i, 'j': instr(b, substr(a, -run.i, run.n))} as best
      from (select v, e, a, b, list_max(list_transform(range(1, length(a) + 1), lambda i:
          {'n': cast(list_max(list_transform(range(0, length(a) - i + 2), lambda l:
            case when contains(b, substr(a, i, l)) then l else 0 end)) as integer),
           'i': cast(-i as integer)})) as run
        from pieces@ where a <> '' and b <> '')
      where run.n > 0)),
  pairs@ as (
    select v, e, cast(2 * sum(n) as double) / (length(v) + length(e)) as score
    from pieces@ group by v, e)"""


def closest_sql(pairs: str, values: str, entries: str, suffix: str = "") -> str:
    """CTEs ending in ``closest(v, e, score)`` for value and entry selects."""
    return f"""vals@ as ({values}), ents@ as ({entries}), {pairs},
  closest@ as (
    select v, e, score from (select *, row_number() over (partition by v order by score desc, e desc)
      as place from pairs@ where score >= 0.3) where place = 1)""".replace("@", suffix)


def _sql(pairs: str) -> str:
    closest = closest_sql(
        pairs, "select distinct name as v from named", "select distinct upper(p_name) as e from part"
    )
    return f"""with recursive named as (select p_partkey, upper({MISSPELT}) as name from part),
  {closest}
  select p_partkey, coalesce(e, name) as name, score from named left join closest on name = v"""


def _match(spark, folder, scorer):
    parts = table(spark, folder, "part")
    named = parts.select("p_partkey", clean_text(F.expr(MISSPELT)).alias("name"))
    return fuzzy_join(named, "name", parts, "p_name", scorer=scorer, score_column="score")


@query("fuzzy_ratio", _sql(RATIO_SQL))
def _(spark, folder):
    return _match(spark, folder, "ratio")


@query("fuzzy_levenshtein", _sql(LEVENSHTEIN_SQL))
def _(spark, folder):
    return _match(spark, folder, "levenshtein")
