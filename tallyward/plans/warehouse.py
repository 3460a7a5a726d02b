"""The whole load: files -> stage -> core, tables of the session catalog."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tallyward import fixed_values as fx
from tallyward.plans import core, marts, staging
from tallyward.session import use_all_cores, work_only_here
from tallyward.sources.isolation import Load
from tallyward.sources.tables import create_layers, read_table, write_table

REJECTED = "rejeitado"  # suffix of the tables of rows that were set aside
STATISTICS = "carga"  # and of those with a line for each file


def _publish(df: DataFrame, name: str) -> None:
    write_table(df, name, mode="overwrite")


def _set_aside(df: DataFrame, name: str) -> None:
    write_table(df, f"{name}_{REJECTED}", mode="overwrite")


def to_stage(spark: SparkSession, incident_folder: str, dictionary_folder: str) -> dict[str, Load]:
    """Fill the stage tables. Reruns replace them, so a repeated load is the same load."""
    create_layers(spark)
    loads = {
        "municipio": staging.municipalities(spark, dictionary_folder),
        "agente_causador": staging.agents(spark, dictionary_folder),
        "natureza_lesao": staging.natures(spark, dictionary_folder),
        "cid10": staging.diseases(spark, dictionary_folder),
        "acidente_trabalho": staging.incidents(spark, f"{incident_folder}/*.csv"),
    }
    for name, load in loads.items():
        _publish(staging.table_rows(load), f"{fx.STAGE}.{name}")
        _set_aside(load.rejected, f"{fx.STAGE}.{name}")
    return loads


def to_core(
    spark: SparkSession,
    *,
    on_violation: str = "quarantine",
    protected: Iterable[str] = (fx.UNKNOWN,),
    drop_repeats: bool = False,
) -> None:
    """Fill the core tables from the stage tables; dimensions first, the fact needs them.

    With ``drop_repeats`` incidents that agree in every column of the fact load once.
    """
    create_layers(spark)
    places = core.municipality(read_table(spark, f"{fx.STAGE}.municipio"))
    if on_violation == "fail" and not places.violations.isEmpty():
        raise ValueError("municipality rows without a usable, unique code")
    _publish(places.valid, f"{fx.CORE}.municipio")
    _set_aside(places.violations, f"{fx.CORE}.municipio")
    for name, code, text in (
        ("agente_causador", "agente_codigo", "agente_descricao"),
        ("natureza_lesao", "natureza_codigo", "natureza_descricao"),
    ):
        stage = read_table(spark, f"{fx.STAGE}.{name}")
        _publish(core.dictionary(stage, code, text), f"{fx.CORE}.{name}")
    _publish(core.disease(read_table(spark, f"{fx.STAGE}.cid10")), f"{fx.CORE}.cid10")

    tagged = core.incidents(
        use_all_cores(read_table(spark, f"{fx.STAGE}.acidente_trabalho")),
        read_table(spark, f"{fx.CORE}.municipio"),
        read_table(spark, f"{fx.CORE}.agente_causador"),
        read_table(spark, f"{fx.CORE}.natureza_lesao"),
        protected=protected,
    )
    checked = core.split_tagged(tagged, on_violation)
    valid = checked.valid.dropDuplicates() if drop_repeats else checked.valid
    _publish(valid, f"{fx.CORE}.acidente_trabalho")
    _set_aside(checked.violations, f"{fx.CORE}.acidente_trabalho")


def to_mart(spark: SparkSession) -> None:
    """Fill the report tables from the core tables."""
    create_layers(spark)
    fact, places, diseases = (
        read_table(spark, f"{fx.CORE}.{name}") for name in ("acidente_trabalho", "municipio", "cid10")
    )
    for name, report in marts.incident_reports(fact, places, diseases).items():
        _publish(report, f"{fx.MART}.{name}")


def run(spark: SparkSession, incident_folder: str, dictionary_folder: str, **options) -> dict[str, Load]:
    """All steps; gives the loads of the stage as its tables have them. No work files are left."""
    with work_only_here(spark):
        loads = to_stage(spark, incident_folder, dictionary_folder)
        to_core(spark, **options)
        to_mart(spark)
        for name, load in loads.items():
            _publish(load.stats, f"{fx.STAGE}.{name}_{STATISTICS}")
    tables = {name: f"{fx.STAGE}.{name}" for name in loads}
    return {
        name: Load(*[read_table(spark, t) for t in (table, f"{table}_{REJECTED}", f"{table}_{STATISTICS}")])
        for name, table in tables.items()
    }
