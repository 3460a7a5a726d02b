"""Report tables over the core layer. Everything is counted before it is labelled."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward import fixed_values as fx
from tallyward.functions.text import clean_text


def incident_reports(
    fact: DataFrame, places: DataFrame, diseases: DataFrame, unknown: str = fx.UNKNOWN, k: int = 10
) -> dict[str, DataFrame]:
    """The report tables of the incident fact, by name. Every one counts before it joins."""
    agent, kind, died = "agente_causador_acidente", "tipo_acidente", F.col("indica_obito_acidente")
    codes = diseases.select(clean_text(F.col("cid10_codigo")).alias("code"), "cid10_descricao").distinct()
    age = age_band(age_in_years(F.col("data_nascimento"), F.col("data_acidente")), fx.AGE_EDGES, unknown)
    return {
        "acidentes_por_mes": monthly(fact, F.col("data_acidente"), [F.col(kind)]),
        "acidentes_por_municipio": by_dimension(
            fact, "municipio_empregador", places, "municipio_ibge_codigo", "municipio_ibge_descricao", unknown
        ),
        "acidentes_por_doenca": by_dimension(fact, "cid_10_codigo", codes, "code", "cid10_descricao", unknown),
        "obitos_por_agente": rate(fact, F.col(agent), died, ["SIM"]),
        "acidentes_por_idade": fact.groupBy(age.alias("faixa")).agg(F.count(F.lit(1)).alias("n")),
        "agentes_por_tipo": top_k(fact, kind, agent, k),
    }


# Reports count rows, or add up a column of rows that were counted before, e.g. ahead of a join.


def _total(counted: str | None) -> Column:
    return F.sum(counted) if counted else F.count(F.lit(1))


def monthly(
    rows: DataFrame, date: Column, by: Iterable[Column] = (), counted: str | None = None
) -> DataFrame:
    """Rows per calendar month and group."""
    month = F.trunc(date.cast("date"), "month").alias("month")
    return rows.groupBy(month, *by).agg(_total(counted).alias("n"))


def by_dimension(
    rows: DataFrame,
    key: str,
    dim: DataFrame,
    dim_key: str,
    label: str,
    unknown: str,
    counted: str | None = None,
) -> DataFrame:
    """Rows per dimension label. Counting by key first makes the join one row per key."""
    counts = rows.groupBy(F.col(key).alias("_key")).agg(_total(counted).alias("_n"))
    labels = dim.select(F.col(dim_key).alias("_dim_key"), F.col(label).alias("_label"))
    return (
        counts.join(labels, F.col("_key") == F.col("_dim_key"), "left")
        .groupBy(F.coalesce("_label", F.lit(unknown)).alias("label"))
        .agg(F.sum("_n").alias("n"))
    )


def rate(rows: DataFrame, group: Column, flag: Column, positive: Sequence[str]) -> DataFrame:
    """Share of rows per group whose flag has one of the positive values."""
    hits = F.count_if(F.coalesce(flag.isin(*positive), F.lit(False)))
    return rows.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), hits.alias("n_positive"), (hits / F.count(F.lit(1))).alias("rate")
    )


def cube(rows: DataFrame, by: Sequence[str], counted: str | None = None) -> DataFrame:
    """Rows for every combination of the columns, with all subtotals and the total.

    ``level`` tells a subtotal from a group whose value is missing: it has a bit for each column, the
    first one highest, that is set where the row is a total over that column. Rows are counted once
    by all columns before they multiply, so subtotals cost groups and not rows.
    """
    counts = rows.groupBy(*by).agg(_total(counted).alias("_n"))
    return counts.cube(*by).agg(F.sum("_n").alias("n"), F.grouping_id().cast("long").alias("level"))


def age_in_years(born: Column, at: Column) -> Column:
    """Completed years; an unknown date or one before birth gives NULL."""
    years = F.floor(F.months_between(at.cast("date"), born.cast("date")) / 12).cast("int")
    return F.when(years >= 0, years)


def age_band(age: Column, edges: Sequence[int], unknown: str) -> Column:
    """``lo-hi`` band of an age, ``edge+`` from the last edge on."""
    band = F.when(age.isNull(), unknown)
    for low, high in zip([0, *edges], edges):
        band = band.when(age < high, f"{low}-{high - 1}")
    return band.otherwise(f"{edges[-1]}+")


def top_k(
    rows: DataFrame, group: str, item: str, k: int, counted: str | None = None
) -> DataFrame:
    """The k most frequent items per group; ties go by name."""
    counts = rows.groupBy(group, item).agg(_total(counted).alias("n"))
    order = Window.partitionBy(group).orderBy(F.desc("n"), F.asc(item))
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def deduplicate(rows: DataFrame, key: Sequence[Column], keep: Column) -> DataFrame:
    """One row per distinct key with the number of copies.

    Copies are folded map-side, so a text that fills a third of the rows is no hot spot.
    """
    return rows.groupBy(*key).agg(keep, F.count(F.lit(1)).alias("copies"))
