"""Files -> stage: columns renamed and typed, faulty files set aside whole."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward import fixed_values as fx
from tallyward.operators.quality import pk_flag, too_long
from tallyward.operators.shape import typed
from tallyward.session import materialise
from tallyward.sources.delimited import FAULT, ORIGINAL, SOURCE, original, scan
from tallyward.sources.headers import list_files
from tallyward.sources.isolation import Load, isolate


def load_files(
    spark: SparkSession,
    pattern: str | Sequence[str],
    sep: str,
    renames: Mapping[str, str],
    table: T.StructType,
    *,
    key: str | None = None,
    strict: bool = False,
    **scan_options,
) -> Load:
    """Load every file behind ``pattern``; a file with any fault loads no row.

    Faults are a line with too many cells, a column the table does not have, a text in an
    integer column, a text over its length, and (with ``key``) a missing or repeated key. Rejected
    rows with a fault keep their original text; statistics have a line for files without rows too.
    Parsed once into Parquet; checks and results read that. Faulty rows are counted while they are
    written, so that a load without any is not searched for them. ``strict`` raises instead.
    """
    rows = scan(
        spark, pattern, sep, renames=renames, expected=table, lineage=True, **scan_options
    )
    long_texts = [
        F.when(too_long(F.col(c), n, exempt=()), F.lit(f"{c} is too long"))
        for c, n in fx.STAGE_MAX_LENGTHS.items()
        if c in table.names
    ]
    cells = [c for c in rows.columns if c not in (SOURCE, FAULT, ORIGINAL)]
    raw = rows.withColumn("_raw", original(cells)).withColumn(FAULT, F.coalesce(FAULT, *long_texts))
    landed = typed(raw, table, FAULT)
    text = F.coalesce(ORIGINAL, F.when(F.col(FAULT).isNotNull(), F.col("_raw")))
    counted = Observation(f"landed-{uuid.uuid4().hex}")
    landed = landed.withColumn(ORIGINAL, text).drop("_raw").observe(counted, F.count(FAULT).alias("n_faulty"))
    landed = materialise(landed, "landed")
    if key:
        repeated = F.when(F.col("_repeated"), F.lit(f"{key} is not a key"))
        landed = (
            pk_flag(landed, [key], "_repeated")
            .withColumn(FAULT, F.coalesce(FAULT, repeated))
            .drop("_repeated")
        )
    clean = not key and counted.get["n_faulty"] == 0
    load = isolate(landed, files=list_files(spark, pattern), clean=clean)
    if strict and (fault := load.stats.filter("n_faulty > 0").first()):
        raise ValueError(f"{fault[SOURCE]}: {fault.reason}")
    return load


def incidents(spark: SparkSession, pattern: str | Sequence[str], **options) -> Load:
    return load_files(spark, pattern, ";", fx.INCIDENT_HEADERS, fx.STAGE_INCIDENT, **options)


def municipalities(spark: SparkSession, folder: str) -> Load:
    return load_files(
        spark, f"{folder}/municipios.csv", ";", fx.MUNICIPALITY_HEADERS, fx.STAGE_MUNICIPALITY,
        multi_line=True,
    )


def agents(spark: SparkSession, folder: str) -> Load:
    return load_files(
        spark, f"{folder}/agente_causador.csv", ",", fx.AGENT_HEADERS, fx.STAGE_AGENT,
        key="agente_codigo", multi_line=True,
    )


def natures(spark: SparkSession, folder: str) -> Load:
    return load_files(
        spark, f"{folder}/natureza_lesao.csv", ",", fx.NATURE_HEADERS, fx.STAGE_NATURE,
        key="natureza_codigo", multi_line=True,
    )


def diseases(spark: SparkSession, folder: str) -> Load:
    return load_files(
        spark, f"{folder}/cid10.csv", ",", fx.DISEASE_HEADERS, fx.STAGE_DISEASE,
        key="cid10_codigo", strict=True, multi_line=True,
    )


def table_rows(load: Load) -> DataFrame:
    """The loaded rows without their lineage."""
    return load.rows.drop(SOURCE, FAULT, ORIGINAL)
