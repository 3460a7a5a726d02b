"""Stage and core of the incident fact, and incremental loads."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward import fixed_values as fx
from tallyward.checks.files import write_delimited
from tallyward.checks.matches import MISSPELT, RATIO_SQL, closest_sql
from tallyward.checks.registry import query, table
from tallyward.checks.scalars import date_sql, date_text
from tallyward.functions.text import clean_text
from tallyward.operators.attach import attach, fits_broadcast, hot_values
from tallyward.plans import core, marts, staging
from tallyward.plans.star import incident_star
from tallyward.session import discard, materialise, shuffles_go, use_all_cores, work_path
from tallyward.streaming.incremental import clean_stream, incremental_incidents, load_new_files
from tallyward.streaming.repeats import drop_stream_repeats

# Raw incident columns, by the table that they are made from.
RAW = {
    "lineitem": {
        "data_acidente": date_text("l_shipdate", "l_orderkey"),
        "cid_10_codigo": """case when l_orderkey % 97 = 0 then 'S61.23' when l_orderkey % 13 = 0 then null
          else ' ' || l_returnflag || cast(l_linenumber as varchar(4)) end""",
        "cnae_empregador_codigo": "cast(l_suppkey as int)",
        "indica_obito_acidente": "case when l_linestatus = 'O' then 'Sim' else ' Não ' end",
        "uf_municipio_empregador": "' nan '",
    },
    "part": {
        "agente_causador_acidente": f"case when p_size % 9 = 0 then '{{ñ class}}' else {MISSPELT} end",
        "natureza_lesao": "substr(p_type, 1, length(p_type) - 1) || cast(p_size as varchar(4))",
        "parte_corpo_atingida": "p_brand",
    },
    "orders": {
        "sexo": "o_orderstatus",
        "tipo_acidente": "o_orderpriority",
        "data_nascimento": date_text("o_orderdate", "o_orderkey"),
    },
    "customer": {
        "municipio_empregador": """case when c_custkey % 101 = 0 then 'x1-' || c_name
          when c_custkey % 53 = 0 then '999-' || c_name when c_custkey % 19 = 0 then null
          else cast(c_custkey + 100000 as varchar(20)) || '-' || c_name end""",
        "uf_municipio_acidente": "c_mktsegment",
    },
}
_RAW_TEXT = {name: text for columns in RAW.values() for name, text in columns.items()}
_JOINS = """lineitem left join orders on l_orderkey = o_orderkey
    left join customer on o_custkey = c_custkey left join part on l_partkey = p_partkey"""
_KEYS = {
    "lineitem": ["l_orderkey", "l_partkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey", "o_custkey"],
    "customer": ["c_custkey"],
}


def raw_incidents(spark, folder, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """Raw columns are made before the joins, on the table that has them.

    Customers meet the orders, which are fewer than the lines and have the same keys; then lines meet both
    other tables, whose hot keys are found in one pass over the lines as they are read. Parts come first, since
    they add fewer columns to what the second join shuffles. ``part=(i, n)`` gives the lines of the orders in
    the i-th of n groups by hash; together the groups have every line once.
    """
    tables = {name: table(spark, folder, name) for name in RAW}
    i, n = part
    if n > 1:
        for name, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
            group = F.pmod(F.xxhash64(F.col(key).cast("double")), F.lit(n))  # equal keys of any two types agree
            tables[name] = tables[name].filter(group == i)
    rows = {
        name: tables[name].select(*_KEYS[name], *[F.expr(text).alias(column) for column, text in columns.items()])
        for name, columns in RAW.items()
    }
    ordered = {name: name for name in [*RAW["orders"], *RAW["customer"]]}
    wanted = {name: name for name in RAW["customer"]}
    orders = attach(rows["orders"], "o_custkey", rows["customer"], "c_custkey", wanted)
    sides = {"l_partkey": (rows["part"], "p_partkey", {name: name for name in RAW["part"]}), "l_orderkey": (orders, "o_orderkey", ordered)}
    incidents = use_all_cores(rows["lineitem"])
    large = [column for column, (side, *_) in sides.items() if not fits_broadcast(side)]
    hot = hot_values(rows["lineitem"], large) if large else None
    for column, (side, key, found) in sides.items():
        incidents = attach(incidents, column, side, key, found, hot)
    return incidents.select([name for columns in RAW.values() for name in columns])


def dimensions(spark, folder) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Municipalities from customers, agents and natures from the words of parts."""
    parts = table(spark, folder, "part")
    places = table(spark, folder, "customer").select(
        ((F.col("c_custkey") + 100000) * 10 + F.col("c_custkey") % 10)
        .cast("int")
        .alias("municipio_ibge_codigo"),
        F.col("c_name").alias("municipio_ibge_descricao"),
    )
    return (
        core.municipality(places).valid,
        parts.select(clean_text(F.col("p_name")).alias("agente_descricao")).distinct(),
        parts.select(clean_text(F.col("p_type")).alias("natureza_descricao")).distinct(),
    )


def _clean(text: str) -> str:
    upper = f"upper(trim({text}))"
    return (
        f"case when {upper} is null or {upper} in ('', 'NAN', 'NONE', '{{Ñ CLASS}}')"
        f" then 'DESCONHECIDO' else {upper} end"
    )


def _core_sql() -> str:
    raw = ", ".join(f"{text} as {name}" for name, text in _RAW_TEXT.items())
    plain = ["cid_10_codigo", "indica_obito_acidente", "parte_corpo_atingida", "sexo",
             "tipo_acidente", "uf_municipio_acidente", "uf_municipio_empregador"]
    cleaned = ", ".join(f"{_clean(c)} as {c}" for c in plain)
    agents, natures = (
        closest_sql(
            RATIO_SQL,
            f"select distinct {column} as v from cleaned where {column} <> 'DESCONHECIDO'",
            f"select distinct upper({entry}) as e from part",
            suffix,
        )
        for column, entry, suffix in (
            ("agente_causador_acidente", "p_name", "_agent"),
            ("natureza_lesao", "p_type", "_nature"),
        )
    )
    return f"""with recursive raw as (select {raw} from {_JOINS}),
  cleaned as (select {_clean('agente_causador_acidente')} as agente_causador_acidente,
    {date_sql('data_acidente')} as data_acidente, cnae_empregador_codigo, {cleaned},
    trim(split_part({_clean('municipio_empregador')}, '-', 1)) as place,
    {_clean('natureza_lesao')} as natureza_lesao, {date_sql('data_nascimento')} as data_nascimento
    from raw),
  {agents},
  {natures},
  placed as (select *, try_cast(case when place = 'DESCONHECIDO' then '0' else place end as integer)
    as municipio_empregador from cleaned)
  select coalesce(a.e, agente_causador_acidente) as agente_causador_acidente, data_acidente,
    cid_10_codigo, cnae_empregador_codigo, indica_obito_acidente, municipio_empregador,
    coalesce(n.e, natureza_lesao) as natureza_lesao, parte_corpo_atingida, sexo, tipo_acidente,
    uf_municipio_acidente, uf_municipio_empregador, data_nascimento
  from placed left join closest_agent a on a.v = agente_causador_acidente
    left join closest_nature n on n.v = natureza_lesao
  where (length(cid_10_codigo) <= 4 or cid_10_codigo = 'DESCONHECIDO')
    and (municipio_empregador = 0
      or municipio_empregador in (select c_custkey + 100000 from customer))"""


@query("incident_core", _core_sql())
def incident_core(spark, folder):
    places, agents, natures = dimensions(spark, folder)
    stage = raw_incidents(spark, folder)  # written once, cleaned
    tagged = core.incidents(stage, places, agents, natures)
    return core.split_tagged(tagged).valid


def _diseases(spark, folder) -> DataFrame:
    """Diseases for the codes of some incidents, not of all."""
    codes = table(spark, folder, "lineitem").filter("l_linenumber <= 5").select("l_returnflag", "l_linenumber").distinct()
    code = F.concat("l_returnflag", F.col("l_linenumber").cast("string"))
    return core.disease(codes.select(code.alias("cid10_codigo"), F.concat(F.lit("doença "), code).alias("cid10_descricao")))


_DISEASES_SQL = """select distinct l_returnflag || cast(l_linenumber as varchar) as code,
    'DOENÇA ' || l_returnflag || cast(l_linenumber as varchar) as disease from lineitem where l_linenumber <= 5"""
_PLACES_SQL = """select c_custkey + 100000 as code, upper(c_name) as place from customer
    union all select 0, 'DESCONHECIDO'"""


def _numbered(spark, folder, text: str, name: str) -> DataFrame:
    """The distinct texts of parts, numbered in the order of the first part that has each."""
    entries = table(spark, folder, "part").groupBy(F.col(text).alias(name)).agg(F.min("p_partkey").alias("code"))
    return core.dictionary(entries, "code", name)


def _ids_sql(text: str) -> str:
    return f"""select upper({text}) as entry, cast(min(id) as integer) as id
    from (select {text}, row_number() over (order by min(p_partkey)) as id from part group by {text}) group by 1"""


@query(
    "incident_star",
    f"""with fact as ({_core_sql()}), agents as ({_ids_sql("p_name")}), natures as ({_ids_sql("p_type")}),
    places as ({_PLACES_SQL}), diseases as ({_DISEASES_SQL})
  select fact.*, coalesce(agents.id, 0) as agente_id, coalesce(natures.id, 0) as natureza_id,
    coalesce(place, 'DESCONHECIDO') as municipio_ibge_descricao, coalesce(disease, 'DESCONHECIDO') as cid10_descricao
  from fact left join agents on agents.entry = agente_causador_acidente
    left join natures on natures.entry = natureza_lesao
    left join places on places.code = municipio_empregador left join diseases on diseases.code = cid_10_codigo""",
)
def _(spark, folder):
    places, _, _ = dimensions(spark, folder)
    agents = _numbered(spark, folder, "p_name", "agente_descricao")
    natures = _numbered(spark, folder, "p_type", "natureza_descricao")
    return incident_star(incident_core(spark, folder), places, agents, natures, _diseases(spark, folder))


_AGE_SQL = """select case when age is null then 'DESCONHECIDO' when age < 18 then '0-17' when age < 25 then '18-24'
      when age < 35 then '25-34' when age < 45 then '35-44' when age < 60 then '45-59' else '60+' end as faixa
    from (select case when data_acidente >= data_nascimento then date_sub('year', data_nascimento, data_acidente) end as age
      from fact)"""


@query(
    "incident_marts",
    f"""with fact as materialized ({_core_sql()}), places as ({_PLACES_SQL}), diseases as ({_DISEASES_SQL})
  select 'acidentes_por_mes' as report, strftime(date_trunc('month', data_acidente), '%Y-%m-%d') as of, tipo_acidente as item,
    count(*) as n, cast(null as bigint) as n_positive, cast(null as integer) as rank from fact group by 2, 3
  union all select 'acidentes_por_municipio', coalesce(place, 'DESCONHECIDO'), null, count(*), null, null
    from fact left join places on code = municipio_empregador group by 2
  union all select 'acidentes_por_doenca', coalesce(disease, 'DESCONHECIDO'), null, count(*), null, null
    from fact left join diseases on code = cid_10_codigo group by 2
  union all select 'obitos_por_agente', agente_causador_acidente, null, count(*),
    count(*) filter (indica_obito_acidente = 'SIM'), null from fact group by 2
  union all select 'acidentes_por_idade', faixa, null, count(*), null, null
    from ({_AGE_SQL}) group by 2
  union all select 'agentes_por_tipo', tipo_acidente, agente_causador_acidente, n, null, cast(place as integer)
    from (select *, row_number() over (partition by tipo_acidente order by n desc, agente_causador_acidente) as place
      from (select tipo_acidente, agente_causador_acidente, count(*) as n from fact group by 1, 2)) where place <= 10""",
)
def _(spark, folder):
    """All report tables of the incident fact, one below the other."""
    places, _, _ = dimensions(spark, folder)
    reports = marts.incident_reports(incident_core(spark, folder), places, _diseases(spark, folder))
    names = {"month": "of", "label": "of", "faixa": "of"}
    for_report = {
        "obitos_por_agente": {"agente_causador_acidente": "of"},
        "agentes_por_tipo": {"tipo_acidente": "of", "agente_causador_acidente": "item"},
        "acidentes_por_mes": {"month": "of", "tipo_acidente": "item"},
    }
    columns = {"of": "string", "item": "string", "n": "long", "n_positive": "long", "rank": "int"}
    parts = []
    for name, report in reports.items():
        report = report.withColumnsRenamed(for_report.get(name, names))
        cells = [(F.col(c) if c in report.columns else F.lit(None)).cast(kind).alias(c) for c, kind in columns.items()]
        parts.append(report.select(F.lit(name).alias("report"), *cells))
    return reduce(DataFrame.unionByName, parts)


# Above so many bytes of lines a join shuffles a part of them at a time; a fourth of them is less than what the
# loads need beside the files.
LINES_AT_ONCE, MOST_PARTS = 128 << 20, 4

# Text files are packed, which costs little at this level, and kept so small that each is one task's work.
_PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 1_000_000}


def _written_incidents(spark, folder) -> DataFrame:
    """The raw incidents, written part by part: what a join shuffles is gone before the next begins."""
    path = work_path(spark, "raw-incidents")
    lines = table(spark, folder, "lineitem")
    size = int(lines._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    n = max(1, min(-(-size // LINES_AT_ONCE), MOST_PARTS))
    for i in range(n):
        rows = raw_incidents(spark, folder, (i, n))
        with shuffles_go(spark):
            rows.write.parquet(f"{path}/part={i}")
    return spark.read.schema(rows.schema).parquet(f"{path}/part=*")


@query("incremental_incidents", _core_sql())
def _(spark, folder):
    """The raw incidents as files in two deliveries, a load after each: the fact of one load of all."""
    root, target, progress = (work_path(spark, label) for label in ("delivered", "fact", "progress"))
    raw = _written_incidents(spark, folder)
    texts = raw.select(
        [(F.col(c) if c in _RAW_TEXT else F.lit(None)).cast("string").alias(h) for h, c in fx.INCIDENT_HEADERS.items()]
    )
    first = F.coalesce(F.col("Sexo") == "F", F.lit(False))
    places, agents, natures = (materialise(dim, "dimension") for dim in dimensions(spark, folder))
    write_delimited(texts.filter(first), f"{root}/{uuid.uuid4().hex}", ";", **_PACKED)
    incremental_incidents(spark, f"{root}/*", target, progress, places, agents, natures, names="*.csv.gz")
    write_delimited(texts.filter(~first), f"{root}/{uuid.uuid4().hex}", ";", **_PACKED)
    discard(raw)
    incremental_incidents(spark, f"{root}/*", target, progress, places, agents, natures, names="*.csv.gz")
    return spark.read.parquet(f"{target}/fact").select(fx.CORE_INCIDENT.names)


def _stage_sql() -> str:
    """All stage columns; the ones without a source are NULL, as are empty cells."""
    columns = []
    for field in fx.STAGE_INCIDENT:
        kind = "integer" if field.dataType == T.IntegerType() else "varchar"
        text = _RAW_TEXT.get(field.name, "null")
        value = text if kind == "integer" else f"nullif({text}, '')"
        columns.append(f"cast({value} as {kind}) as {field.name}")
    return f"select {', '.join(columns)} from {_JOINS}"


@query("stage_incidents", _stage_sql())
def _(spark, folder):
    path = work_path(spark, "incident-files")
    raw = raw_incidents(spark, folder)
    columns = [
        (F.col(name) if name in _RAW_TEXT else F.lit(None)).cast("string").alias(header)
        for header, name in fx.INCIDENT_HEADERS.items()
    ]
    write_delimited(raw.select(columns), path, ";")
    return staging.table_rows(staging.incidents(spark, f"{path}/*.csv"))


_DELIVERED = T.StructType(
    [
        T.StructField("c_custkey", T.IntegerType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)


@query(
    "incremental_files",
    "select cast(c_custkey as integer) as c_custkey, c_name, c_mktsegment from customer",
)
def _(spark, folder):
    """Two deliveries into one folder, a load after each and one without news."""
    root, target, checkpoint = (work_path(spark, x) for x in ("arrivals", "loaded", "progress"))
    customers = table(spark, folder, "customer").select(_DELIVERED.names)
    early = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")

    def load(paths: list[str], batch: int) -> None:
        rows = staging.load_files(spark, paths, ";", {}, _DELIVERED).rows
        rows.select(_DELIVERED.names).write.mode("overwrite").parquet(f"{target}/batch={batch}")

    for delivery in (customers.filter(early), customers.filter(~early), None):
        if delivery is not None:
            write_delimited(delivery, f"{root}/{uuid.uuid4().hex}", ";")
        load_new_files(spark, f"{root}/*", checkpoint, load)
    return spark.read.schema(_DELIVERED).parquet(f"{target}/batch=*")


@query(
    "incremental_stream",
    """select upper(event_type) as event_type, user_id, count(*) as n, max(ts) as latest
    from events group by 1, 2""",
)
def _(spark, folder):
    target, checkpoint = work_path(spark, "streamed"), work_path(spark, "progress")
    schema = table(spark, folder, "events").schema
    events = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    )

    def clean(rows: DataFrame) -> DataFrame:
        return rows.select(clean_text(F.col("event_type")).alias("event_type"), "user_id", "ts")

    clean_stream(events, clean, target, checkpoint)
    return (
        spark.read.parquet(target)
        .groupBy("event_type", "user_id")
        .agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("latest"))
    )


_REPEATS = "event_id % 7 = 0"
_LATER = "timestamp '2024-01-16 00:00:00'"


@query("stream_dedup", "select event_id, ts, user_id, event_type from events")
def _(spark, folder):
    """Two runs of one stream. Both deliveries have repeats, the second also of the first's last hours."""
    root, target, progress = (work_path(spark, label) for label in ("delivered", "single", "progress"))
    events = table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type")
    events = events.withColumn("at", F.col("ts").cast("timestamp"))
    early = F.expr(f"ts < {_LATER}")
    last = early & F.expr(f"ts >= {_LATER} - interval 12 hours and event_id % 3 = 0")
    for n, wanted in enumerate(([early, early & F.expr(_REPEATS)], [~early, ~early & F.expr(_REPEATS), last])):
        for k, rows in enumerate(wanted):
            events.filter(rows).write.parquet(f"{root}/{n}/{k}")
        stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(root)
        drop_stream_repeats(stream, ["event_id"], "at", "1 day", target, progress)
    return spark.read.parquet(target).drop("at")
