import csv
import datetime as dt
import gzip
from difflib import get_close_matches
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyward import fixed_values as fx
from tallyward.checks import warehouse as checks
from tallyward.functions.dates import parse_date
from tallyward.functions.numbers import municipality_code
from tallyward.functions.text import clean_text
from tallyward.plans import core, staging, warehouse
from tallyward.plans.star import incident_star
from tallyward.session import materialise, work_folder
from tallyward.sources.tables import LAST_ID, TABLES, create_layers, last_id, read_table, write_table
from tallyward.streaming import incremental
from tallyward.streaming.incremental import incremental_incidents

AGENTS = ["Escada móvel", "Serra circular, máquina", "Prensa", "Ácido sulfúrico", "Rua e estrada"]
NATURES = ["Fratura", "Corte, laceração", "Queimadura"]
PLACES = [(1, 3550308, "São Paulo", "SP"), (2, 3304557, "Rio de Janeiro", "RJ"), (3, 5, "Exterior", "EX")]

HEADERS = list(fx.INCIDENT_HEADERS)
REPEATED = {"CBO.1": "CBO", "CID-10.1": "CID-10", "CNAE2.0 Empregador.1": "CNAE2.0 Empregador",
            "Data Acidente.1": "Data Acidente"}


def incident(**changes):
    row = dict.fromkeys(fx.STAGE_INCIDENT.names, "")
    row |= {
        "agente_causador_acidente": " escada movel ", "data_acidente": "05/01/2025", "cbo_codigo": "123",
        "cid_10_codigo": "s610", "cnae_empregador_codigo": "4711", "indica_obito_acidente": "Não",
        "municipio_empregador": "355030-São Paulo", "natureza_lesao": "Fratur", "sexo": "Masculino",
        "tipo_acidente": "Típico", "uf_municipio_acidente": "São Paulo", "data_nascimento": "1990/03/02",
        "cnpj_cei_empregador": "0012",
    }
    return row | changes


def write_incidents(path, rows, order=None):
    headers = order or HEADERS
    with open(path, "w", encoding="latin-1", newline="") as out:
        writer = csv.writer(out, delimiter=";")
        writer.writerow([REPEATED.get(h, h) for h in headers])
        for row in rows:
            writer.writerow([row[fx.INCIDENT_HEADERS[h]] for h in headers])


def write_dictionaries(folder):
    def put(name, sep, rows):
        with open(folder / name, "w", encoding="latin-1", newline="") as out:
            csv.writer(out, delimiter=sep).writerows(rows)

    put("agente_causador.csv", ",", [["codigo", "descricao"], *[[900 - i, t] for i, t in enumerate(AGENTS)]])
    put("natureza_lesao.csv", ",", [["codigo", "descricao"], *enumerate(NATURES, 10)])
    put("cid10.csv", ",", [["SUBCAT", "DESCRICAO"], ["S610", "ferida "], ["A000", ""]])
    put("municipios.csv", ";", [
        list(fx.MUNICIPALITY_HEADERS),
        *[[tom, ibge, name.upper(), name, uf] for tom, ibge, name, uf in PLACES],
    ])


@pytest.fixture
def folders(tmp_path):
    incidents, dictionaries = tmp_path / "incidents", tmp_path / "dictionaries"
    incidents.mkdir(), dictionaries.mkdir()
    write_dictionaries(dictionaries)
    write_incidents(
        incidents / "a.csv",
        [
            incident(),
            incident(agente_causador_acidente="{ñ class}", municipio_empregador="{ñ class}"),
            incident(municipio_empregador="999999-Nowhere"),
            incident(cid_10_codigo="S61.23"),
            incident(cid_10_codigo="", data_acidente="31/02/2025"),
            incident(municipio_empregador="abc-x"),
        ],
    )
    swapped = list(reversed([h for h in HEADERS if not h.endswith(".1")]))
    write_incidents(incidents / "b.csv", [incident(natureza_lesao="QUEIMADURAS")], swapped)
    write_incidents(incidents / "c.csv", [incident(), incident(cbo_codigo="12x")])
    return str(incidents), str(dictionaries)


def work_files(spark):
    return {p for p in Path(work_folder(spark)).rglob("*") if p.is_file()}


def test_files_to_core(spark, folders):
    before = work_files(spark)
    loads = warehouse.run(spark, *folders)
    assert work_files(spark) <= before
    months = spark.table("schema_mart.acidentes_por_mes").collect()
    assert {(r.month, r.tipo_acidente, r.n) for r in months} == {(dt.date(2025, 1, 1), "TÍPICO", 3), (None, "TÍPICO", 1)}
    places = {tuple(r) for r in spark.table("schema_mart.acidentes_por_municipio").collect()}
    assert places == {("SÃO PAULO", 3), ("DESCONHECIDO", 1)}
    diseases = {tuple(r) for r in spark.table("schema_mart.acidentes_por_doenca").collect()}
    assert diseases == {("FERIDA", 3), ("DESCONHECIDO", 1)}
    assert spark.table("schema_mart.acidentes_por_idade").agg(F.sum("n")).first()[0] == 4
    stats = {r[0].rsplit("/", 1)[1]: r for r in loads["acidente_trabalho"].stats.collect()}
    assert {n: (r.n_read, r.n_loaded) for n, r in stats.items()} == {
        "a.csv": (6, 6), "b.csv": (1, 1), "c.csv": (2, 0),
    }
    stage = spark.table("schema_stage.acidente_trabalho")
    assert stage.columns == TABLES["schema_stage.acidente_trabalho"].names
    assert stage.count() == 7 and stage.select("id").distinct().count() == 7
    assert stage.filter("data_carga is null").isEmpty()
    assert {r[0] for r in stage.select("cnpj_cei_empregador").collect()} == {"0012"}

    places = spark.table("schema_core.municipio")
    assert {tuple(r) for r in places.collect()} == {
        (0, "DESCONHECIDO"), (355030, "SÃO PAULO"), (330455, "RIO DE JANEIRO"),
    }
    agents = spark.table("schema_core.agente_causador").orderBy("id").collect()
    assert [tuple(r) for r in agents] == [(i, t.upper()) for i, t in enumerate(reversed(AGENTS), 1)]
    diseases = spark.table("schema_core.cid10").collect()
    assert {tuple(r) for r in diseases} == {("S610", "FERIDA"), ("A000", "DESCONHECIDO")}

    fact = spark.table("schema_core.acidente_trabalho")
    assert fact.columns == TABLES["schema_core.acidente_trabalho"].names
    got = {
        (r.agente_causador_acidente, r.natureza_lesao, r.cid_10_codigo, r.municipio_empregador, r.data_acidente)
        for r in fact.collect()
    }
    day = dt.date(2025, 1, 5)
    assert got == {
        ("ESCADA MÓVEL", "FRATURA", "S610", 355030, day),
        ("DESCONHECIDO", "FRATURA", "S610", 0, day),
        ("ESCADA MÓVEL", "FRATURA", "DESCONHECIDO", 355030, None),
        ("ESCADA MÓVEL", "QUEIMADURA", "S610", 355030, day),
    }
    assert fact.count() == 4
    aside = spark.table("schema_core.acidente_trabalho_rejeitado")
    assert sorted(sum([r.violations for r in aside.collect()], [])) == [
        "cid_10_codigo too long", "municipio_empregador not an integer",
        "municipio_empregador not in municipio",
    ]

    warehouse.run(spark, *folders)
    assert spark.table("schema_core.acidente_trabalho").count() == 4
    assert spark.table("schema_stage.municipio").count() == 3
    assert spark.catalog.databaseExists("schema_mart")

    with pytest.raises(ValueError, match="break rules"):
        warehouse.to_core(spark, on_violation="fail")
    warehouse.to_core(spark, protected=())
    unprotected = {r[0] for r in spark.table("schema_core.acidente_trabalho").select("agente_causador_acidente").collect()}
    closest = get_close_matches("DESCONHECIDO", [a.upper() for a in AGENTS], 1, 0.3)
    assert unprotected == {"ESCADA MÓVEL", *(closest or ["DESCONHECIDO"])}


def test_no_files_at_all(spark, tmp_path):
    loads = warehouse.run(spark, str(tmp_path), str(tmp_path))
    assert all(load.stats.isEmpty() for load in loads.values())
    # Without a source not even the unknown member is written.
    assert all(spark.table(name).isEmpty() for name in TABLES)


def test_absent_and_faulty_dictionaries(spark, tmp_path):
    folder = str(tmp_path)
    assert staging.agents(spark, folder).rows.isEmpty()
    assert core.municipality(staging.table_rows(staging.municipalities(spark, folder))).valid.isEmpty()
    (tmp_path / "agente_causador.csv").write_text("codigo,descricao\n1,a\n1,b\n2,c\n")
    load = staging.agents(spark, folder)
    assert load.rows.isEmpty() and load.stats.first().reason == "agente_codigo is not a key"
    (tmp_path / "municipios.csv").write_text(
        ";".join(fx.MUNICIPALITY_HEADERS) + "\n1;10;a;a;SPX\n", encoding="latin-1"
    )
    assert staging.municipalities(spark, folder).stats.first().reason == "municipio_uf is too long"
    (tmp_path / "cid10.csv").write_text("SUBCAT,DESCRICAO\nA,x\nA,y\n")
    with pytest.raises(ValueError, match="cid10_codigo is not a key"):
        staging.diseases(spark, folder)


def test_municipality_codes_that_collide_or_lack(spark):
    stage = spark.createDataFrame(
        [(3550308, "a"), (3550309, "b"), (None, "c"), (20, "d"), (7, "e")],
        "municipio_ibge_codigo int, municipio_ibge_descricao string",
    )
    split = core.municipality(stage)
    assert {tuple(r) for r in split.valid.collect()} == {(0, "DESCONHECIDO"), (2, "D")}
    assert {r[1] for r in split.violations.collect()} == {"A", "B", "c"}


def test_text_activity_codes(spark):
    stage = spark.createDataFrame([("NONE",), ("12",), ("1x",)], "cnae_empregador_codigo string")
    got = [(r.cnae_empregador_codigo, r._bad_activity) for r in core.clean_incidents(stage).collect()]
    assert got == [(None, False), (12, False), (None, True)]


def test_append_goes_by_name(spark):
    create_layers(spark)
    create_layers(spark)
    name = "schema_stage.cid10"
    before = spark.table(name).count()
    write_table(spark.createDataFrame([("text", "Z999")], ["cid10_descricao", "cid10_codigo"]), name)
    assert spark.table(name).count() == before + 1
    assert read_table(spark, name, ["cid10_descricao"]).columns == ["cid10_descricao"]
    assert spark.table(name).filter("cid10_codigo = 'Z999'").first().cid10_descricao == "text"
    with pytest.raises(ValueError, match="not in the table"):
        write_table(spark.createDataFrame([("x",)], ["other"]), name)


def test_incremental_equals_batch(spark, folders, tmp_path):
    incident_folder, dictionary_folder = folders
    places = core.municipality(staging.table_rows(staging.municipalities(spark, dictionary_folder))).valid
    agents = spark.createDataFrame([(a.upper(),) for a in AGENTS], "agente_descricao string")
    natures = spark.createDataFrame([(n.upper(),) for n in NATURES], "natureza_descricao string")
    target, checkpoint = str(tmp_path / "target"), str(tmp_path / "checkpoint")

    def load():
        incremental_incidents(
            spark, incident_folder, target, checkpoint, places, agents, natures, files_per_batch=2
        )
        return spark.read.parquet(f"{target}/fact")

    def rows(df):
        return sorted((tuple(r) for r in df.select(fx.CORE_INCIDENT.names).collect()), key=repr)

    def batch():
        staged = staging.incidents(spark, f"{incident_folder}/*.csv")
        tagged = core.incidents(staging.table_rows(staged), places, agents, natures)
        return rows(core.split_tagged(tagged).valid)

    first = load()
    assert rows(first) == batch() and len(rows(first)) == 4
    assert first.select("batch").distinct().count() == 2 - (first.filter("batch = 1").isEmpty())
    write_incidents(f"{incident_folder}/d.csv", [incident(natureza_lesao="corte")])
    second = load()
    assert rows(second) == batch() and len(rows(second)) == 5
    assert rows(load()) == rows(second)
    stats = spark.read.parquet(f"{target}/stats")
    assert stats.agg(F.sum("n_read"), F.sum("n_loaded")).first() == (10, 8)


def test_incremental_steps_go_when_the_next_one_stands(spark, folders, tmp_path, monkeypatch):
    """Also with a faulty file; dimensions, and files that others wrote, stay. The deliveries are packed."""
    incident_folder, dictionary_folder = folders
    for path in Path(incident_folder).glob("*.csv"):
        with gzip.open(f"{path}.gz", "wb") as out:
            out.write(path.read_bytes())
        path.unlink()
    (tmp_path / "incidents" / "not_named.csv").write_text("x\n1\n")
    places = materialise(
        core.municipality(staging.table_rows(staging.municipalities(spark, dictionary_folder))).valid, "dimension"
    )
    agents, natures = (
        materialise(spark.createDataFrame([(t.upper(),) for t in texts], f"{name} string"), "dimension")
        for texts, name in ((AGENTS, "agente_descricao"), (NATURES, "natureza_descricao"))
    )
    before, seen = work_files(spark), {}

    def watched(module, name):
        plain = getattr(module, name)

        def run(*args, **kwargs):
            new = work_files(spark) - before
            seen.setdefault(name, set()).update(p.relative_to(work_folder(spark)).parts[0].rsplit("-", 1)[0] for p in new)
            return plain(*args, **kwargs)

        monkeypatch.setattr(module, name, run)

    watched(core, "split_tagged")
    watched(incremental, "with_defaults")
    target, checkpoint = str(tmp_path / "target"), str(tmp_path / "checkpoint")
    for _ in range(2):
        incremental_incidents(
            spark, incident_folder, target, checkpoint, places, agents, natures, files_per_batch=2, names="*.csv.gz"
        )
        assert work_files(spark) == before
        with gzip.open(f"{incident_folder}/d.csv.gz", "wb") as out:
            write_incidents(tmp_path / "d.csv", [incident(natureza_lesao="corte")])
            out.write((tmp_path / "d.csv").read_bytes())
    assert "cleaned" in seen["split_tagged"] and "landed" not in seen["split_tagged"]
    assert "checked" in seen["with_defaults"] and not {"landed", "cleaned", "mapping"} & seen["with_defaults"]
    assert spark.read.parquet(f"{target}/fact").count() == 5
    assert spark.read.parquet(f"{target}/violations").count() == 3
    assert spark.read.parquet(f"{target}/rejected").count() == 2
    stats = spark.read.parquet(f"{target}/stats")
    assert stats.agg(F.sum("n_read"), F.sum("n_loaded")).first() == (10, 8)


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_raw_incidents_in_parts_are_all_of_them(spark, tmp_path, monkeypatch, broadcast):
    """Keys are of two types, absent, NULL, or there twice."""
    lines = [(k, p, s, n, "A", "O", dt.datetime(1995, 1, 1 + n)) for n, (k, p, s) in enumerate(
        [(1, 1, 1), (1, 2, 2), (2, 1, 3), (3, None, 4), (None, 2, 5), (None, None, 6), (99, 98, 7), (4, 2, 8), (5, 1, 9), (5, 1, 9)]
    )]
    tables = {
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "part": ([(1, "hot bolt", "LARGE", 9, "B1"), (2, "blue ring", "SMALL", 4, "B2"), (2, "blue nut", "SMALL", 4, "B2")], "p_partkey long, p_name string, p_type string, p_size int, p_brand string"),
        "orders": ([(k, c, "F" if k % 2 else "O", "1-URGENT", dt.datetime(1990, 2, k)) for k, c in ((1, 1), (2, 2), (3, None), (4, 7), (5, 1), (5, 2))] + [(None, 1, "F", "2-HIGH", None)], "o_orderkey int, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp"),
        "customer": ([(1, "Customer#1", "BUILDING"), (2, "Customer#2", None)], "c_custkey long, c_name string, c_mktsegment string"),
    }
    for name, (rows, kinds) in tables.items():
        spark.createDataFrame(rows, kinds).write.parquet(str(tmp_path / f"{name}.parquet"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        whole = checks.raw_incidents(spark, str(tmp_path))
        want = sorted(map(str, whole.collect()))
        assert len(want) == 15  # one line more for each repeated key
        parts = [sorted(map(str, checks.raw_incidents(spark, str(tmp_path), (i, 3)).collect())) for i in range(3)]
        assert sorted(sum(parts, [])) == want and sum(map(bool, parts)) > 1
        monkeypatch.setattr(checks, "LINES_AT_ONCE", 1)
        written = checks._written_incidents(spark, str(tmp_path))
        assert written.columns == whole.columns and sorted(map(str, written.collect())) == want
        assert len({file.rsplit("/", 2)[1] for file in written.inputFiles()}) == checks.MOST_PARTS
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_catalog_refuses_longer_texts(spark, folders):
    """Also after a load has overwritten the tables."""
    create_layers(spark)
    warehouse.to_stage(spark, *folders)
    rows = spark.createDataFrame([(7, 8, "a", "b", "SPX")], "x int, y int, a string, b string, uf string")
    columns = dict(zip(rows.columns, fx.STAGE_MUNICIPALITY.names))
    name = "schema_stage.municipio"
    before = spark.table(name).count()
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        write_table(rows.withColumnsRenamed(columns), name)
    write_table(rows.withColumnsRenamed(columns).withColumn("municipio_uf", F.lit("SP")), name)
    assert spark.table(name).count() == before + 1


def test_an_append_reads_no_old_rows(spark):
    name = "schema_stage.numbered"
    create_layers(spark)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = spark.range(1).selectExpr("id", "id as v", "1 as w").schema
    write_table(spark.range(5).select(F.col("id").alias("v"), F.lit(1).alias("w")), name, columns=columns)
    assert last_id(spark, name) == 5
    for file in spark.table(name).inputFiles():  # what is gone cannot be read
        Path(file.removeprefix("file:")).unlink()
    spark.catalog.refreshTable(name)
    write_table(spark.range(3).select(F.col("id").alias("v"), F.lit(2).alias("w")), name)
    assert sorted(r.id for r in spark.table(name).collect()) == [6, 7, 8] and last_id(spark, name) == 8
    spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES ('{LAST_ID}')")
    assert last_id(spark, name) == 8
    spark.sql(f"DROP TABLE {name}")


def test_star_keeps_every_row_once(spark):
    fact = spark.createDataFrame(
        [("A", "N", 1, "X1"), ("A", None, 2, None), ("Z", "N", None, "x9"), ("A", "N", 1, "X1")],
        "agente_causador_acidente string, natureza_lesao string, municipio_empregador int, cid_10_codigo string",
    )
    agents = spark.createDataFrame([(3, "A"), (2, "A"), (9, None)], "id int, agente_descricao string")
    natures = spark.createDataFrame([(5, "N")], "id int, natureza_descricao string")
    places = spark.createDataFrame([(1, "P"), (1, "Q")], "municipio_ibge_codigo int, municipio_ibge_descricao string")
    diseases = spark.createDataFrame([(" x1", "D")], "cid10_codigo string, cid10_descricao string")
    for limit in ("10485760", "-1"):  # broadcast, and hot values dealt out
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            star = incident_star(fact, places, agents, natures, diseases)
            got = sorted(tuple(r)[4:] for r in star.collect())
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        unknown = fx.UNKNOWN
        assert got == sorted([(2, 5, "P", "D"), (2, 0, unknown, unknown), (0, 5, unknown, unknown), (2, 5, "P", "D")])
    assert incident_star(fact.limit(0), places, agents, natures, diseases).isEmpty()


def test_incidents_are_cleaned_once(spark):
    """Also ends that are no blanks, and codes, are read as the plain functions read them."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    texts = [" escada movel ", " Prensa ", "\tnan\n", "", "  ", None, "é", "Serra　", "31/02/2025", "\x1c05/1/2025 "]
    rows = spark.createDataFrame(
        [(t, t, t, p) for t, p in zip(texts, ["1-a", " 2 -b", " 3-c", "x", None, "nan", "4", "5-", "1-a", "99-z"])],
        "agente_causador_acidente string, sexo string, data_acidente string, municipio_empregador string",
    )
    stage = rows.withColumn("agente_causador_acidente", counted("agente_causador_acidente"))
    places = spark.createDataFrame([(i, str(i)) for i in range(6)], "municipio_ibge_codigo int, municipio_ibge_descricao string")
    agents = spark.createDataFrame([(a.upper(),) for a in AGENTS], "agente_descricao string")
    natures = spark.createDataFrame([(n.upper(),) for n in NATURES], "natureza_descricao string")
    got = core.incidents(stage, places, agents, natures).collect()
    assert seen.value == len(texts)
    want = rows.select(
        clean_text(F.col("sexo")).alias("sexo"),
        parse_date(F.col("data_acidente")).alias("data_acidente"),
        municipality_code(F.col("municipio_empregador")).alias("place"),
    ).collect()

    def order(found):
        return sorted(map(str, found))

    assert order((r.sexo, r.data_acidente, r.municipio_empregador) for r in got) == order(map(tuple, want))
    wrong = "municipio_empregador not in municipio"
    assert [r.municipio_empregador for r in got if wrong in r.violations] == [99]
