"""Layer databases and their tables in the session catalog."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward import fixed_values as fx
from tallyward.operators.dimensions import number_rows
from tallyward.operators.shape import col

_ID = T.StructField("id", T.LongType())
_LOADED = T.StructField("data_carga", T.TimestampType())
_YEAR = T.StructField("ano", T.IntegerType())  # of the incident


def _table(columns: T.StructType, first=(), last=()) -> T.StructType:
    return T.StructType([*first, *columns.fields, *last])


TABLES = {
    f"{fx.STAGE}.acidente_trabalho": _table(fx.STAGE_INCIDENT, [_ID], [_LOADED]),
    f"{fx.STAGE}.municipio": _table(fx.STAGE_MUNICIPALITY, [_ID]),
    f"{fx.STAGE}.agente_causador": fx.STAGE_AGENT,
    f"{fx.STAGE}.natureza_lesao": fx.STAGE_NATURE,
    f"{fx.STAGE}.cid10": fx.STAGE_DISEASE,
    f"{fx.CORE}.acidente_trabalho": _table(fx.CORE_INCIDENT, [_ID], [_LOADED, _YEAR]),
    f"{fx.CORE}.municipio": fx.CORE_MUNICIPALITY,
    f"{fx.CORE}.agente_causador": fx.CORE_AGENT,
    f"{fx.CORE}.natureza_lesao": fx.CORE_NATURE,
    f"{fx.CORE}.cid10": fx.CORE_DISEASE,
}


# A text column with a limit, by layer. The unknown word may stand in a core column of a shorter one.
LENGTHS = {
    fx.STAGE: fx.STAGE_MAX_LENGTHS,
    fx.CORE: {c: max(n, len(fx.UNKNOWN)) for c, n in fx.CORE_MAX_LENGTHS.items()},
}

LAST_ID = "tallyward.last_id"  # property of a table: the largest row id that it was given

PARTITIONS = {f"{fx.CORE}.acidente_trabalho": ["ano"]}  # so that dated reports read their years


def location(spark: SparkSession, name: str) -> str:
    """Where a table's files are, so that a later session finds them without a metastore."""
    layer, table = name.split(".")
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/{layer}.db/{table}"


def create_table(
    spark: SparkSession,
    name: str,
    columns: T.StructType,
    lengths: Mapping[str, int] | None = None,
    partitions: Iterable[str] = (),
) -> None:
    """A typed table of the catalog, if it does not exist yet.

    Text columns in ``lengths`` are ``varchar(n)``: the catalog refuses a longer text, whoever writes it.
    """
    lengths, partitions = lengths or {}, list(partitions)
    kinds = ", ".join(
        f"`{f.name}` " + (f"varchar({lengths[f.name]})" if f.name in lengths else f.dataType.simpleString()) for f in columns
    )
    parts = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    path = location(spark, name).replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({kinds}) USING parquet {parts} LOCATION '{path}'")


def create_layers(spark: SparkSession) -> None:
    """The three layer databases and the ten tables, where they do not exist yet."""
    for layer in (fx.STAGE, fx.CORE, fx.MART):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    for name, columns in TABLES.items():
        create_table(spark, name, columns, LENGTHS.get(name.split(".")[0]), PARTITIONS.get(name, ()))


def with_defaults(df: DataFrame, columns: T.StructType, after: int = 0) -> DataFrame:
    """Fill the generated columns of a table: row ids from ``after + 1`` on, the time of the load
    and the year of the incident."""
    if "ano" in columns.names and "ano" not in df.columns and "data_acidente" in df.columns:
        df = df.withColumn("ano", F.year("data_acidente"))
    if "id" in columns.names and "id" not in df.columns:
        df = number_rows(df, after=after)
    if "data_carga" in columns.names and "data_carga" not in df.columns:
        df = df.withColumn("data_carga", F.current_timestamp())
    return df


def conform(df: DataFrame, columns: T.StructType) -> DataFrame:
    """Columns by name in table order; absent ones are NULL, unknown ones an error."""
    unknown = set(df.columns) - set(columns.names)
    if unknown:
        raise ValueError(f"columns not in the table: {sorted(unknown)}")
    return df.select(
        [
            (col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in columns
        ]
    )


def write_table(
    df: DataFrame, name: str, mode: str = "append", columns: T.StructType | None = None
) -> None:
    """Append to (or overwrite) a table of the catalog, by column name.

    Row ids go on from the largest that the table was given, so they stay unique over appends. It is
    kept as a property of the table and found while rows are written: an append reads no old row.
    The tables of the layers keep their types and lengths when they are overwritten. Two appends to
    one table must not run at once.
    """
    spark = df.sparkSession
    there = spark.catalog.tableExists(name)
    exists = mode == "append" and there
    columns = columns or TABLES.get(name) or (spark.table(name).schema if exists else df.schema)
    numbered = "id" in columns.names and isinstance(columns["id"].dataType, (T.LongType, T.IntegerType))
    after = last_id(spark, name) if exists and numbered else 0
    rows = conform(with_defaults(df, columns, after), columns)
    written = Observation(f"ids-{uuid.uuid4().hex}")
    if numbered:
        rows = rows.observe(written, F.max("id").alias("last"))
    if there and name in TABLES:
        rows.write.insertInto(name, overwrite=mode == "overwrite")
    else:
        writer = rows.write.mode(mode).format("parquet").option("path", location(spark, name))
        if name in PARTITIONS:
            writer = writer.partitionBy(*PARTITIONS[name])
        writer.saveAsTable(name)
    if numbered:
        last = max(after, written.get["last"] or 0)
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{LAST_ID}' = '{last}')")


def last_id(spark: SparkSession, name: str) -> int:
    """The largest row id that a table was given; read from its rows only if no mark was kept."""
    marks = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if LAST_ID in marks:
        return int(marks[LAST_ID])
    return spark.table(name).agg(F.max("id")).first()[0] or 0


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Write a folder of Parquet files by partitions; only partitions that ``df`` has are replaced.

    Files of the others stay as they are, so a rerun of one year costs that year.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def append_files(df: DataFrame, path: str) -> None:
    """Append to a folder of Parquet files."""
    df.write.mode("append").parquet(path)


def read_table(spark: SparkSession, name: str, columns: Iterable[str] | None = None) -> DataFrame:
    """A table, or only some of its columns (the others are not read from disk)."""
    table = spark.table(name)
    return table.select(*columns) if columns else table
