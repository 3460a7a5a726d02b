"""Values that must be exactly these for results to be right.

Plain data only: table layouts, header names, word lists and date shapes.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values: cleaning

UNKNOWN = "DESCONHECIDO"
UNKNOWN_CODE = 0

# Upper-cased texts that mean "not known".
UNKNOWN_TOKENS = ("", "NAN", "NONE", "{Ñ CLASS}")

# Texts that mean "no number".
BLANK_NUMERIC_TOKENS = ("", "NAN", "NONE")

# Cells that a scan reads as NULL (case-sensitive).
MISSING_TOKENS = (
    "", "NA", "N/A", "n/a", "null", "NULL", "NaN", "nan", "-NaN", "-nan", "None", "<NA>",
    "#N/A", "#N/A N/A", "#NA", "1.#IND", "-1.#IND", "1.#QNAN", "-1.#QNAN",
)

# Every character that counts as white space at the ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Tried in this order; the day comes first.
DATE_FORMATS = ("d/M/yyyy", "yyyy/M/d", "yyyy-M-d", "yyyy/M")

MATCH_CUTOFF = 0.3

AGE_EDGES = (18, 25, 35, 45, 60)  # where the age bands of the reports begin

# ---------------------------------------------------------------- fixed values: layers

STAGE, CORE, MART = "schema_stage", "schema_core", "schema_mart"

# ---------------------------------------------------------------- fixed values: headers

INCIDENT_HEADERS = {
    "Agente  Causador  Acidente": "agente_causador_acidente",
    "Data Acidente": "data_acidente",
    "CBO": "cbo_codigo",
    "CBO.1": "cbo_descricao",
    "CID-10": "cid_10_codigo",
    "CID-10.1": "cid_10_descricao",
    "CNAE2.0 Empregador": "cnae_empregador_codigo",
    "CNAE2.0 Empregador.1": "cnae_empregador_descricao",
    "Emitente CAT": "emitente_cat",
    "Espécie do benefício": "especie_beneficio",
    "Filiação Segurado": "filiacao_segurado",
    "Indica Óbito Acidente": "indica_obito_acidente",
    "Munic Empr": "municipio_empregador",
    "Natureza da Lesão": "natureza_lesao",
    "Origem de Cadastramento CAT": "origem_cadastramento_cat",
    "Parte Corpo Atingida": "parte_corpo_atingida",
    "Sexo": "sexo",
    "Tipo do Acidente": "tipo_acidente",
    "UF  Munic.  Acidente": "uf_municipio_acidente",
    "UF Munic. Empregador": "uf_municipio_empregador",
    "Data  Afastamento": "data_afastamento",
    "Data Despacho Benefício": "data_despacho_beneficio",
    "Data Acidente.1": "data_acidente_duplicada",
    "Data Nascimento": "data_nascimento",
    "Data Emissão CAT": "data_emissao_cat",
    "Tipo de Empregador": "tipo_empregador",
    "CNPJ/CEI Empregador": "cnpj_cei_empregador",
}
MUNICIPALITY_HEADERS = {
    "CÓDIGO DO MUNICÍPIO - TOM": "municipio_tom_codigo",
    "CÓDIGO DO MUNICÍPIO - IBGE": "municipio_ibge_codigo",
    "MUNICÍPIO - TOM": "municipio_tom_descricao",
    "MUNICÍPIO - IBGE": "municipio_ibge_descricao",
    "UF": "municipio_uf",
}
AGENT_HEADERS = {"codigo": "agente_codigo", "descricao": "agente_descricao"}
NATURE_HEADERS = {"codigo": "natureza_codigo", "descricao": "natureza_descricao"}
DISEASE_HEADERS = {"SUBCAT": "cid10_codigo", "DESCRICAO": "cid10_descricao"}

# ---------------------------------------------------------------- fixed values: tables


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "date": T.DateType()}


def _columns(spec: str) -> T.StructType:
    pairs = (column.split() for column in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


STAGE_INCIDENT = _columns(
    "agente_causador_acidente string, data_acidente string, cbo_codigo int, cbo_descricao string,"
    "cid_10_codigo string, cid_10_descricao string, cnae_empregador_codigo int,"
    "cnae_empregador_descricao string, emitente_cat string, especie_beneficio string,"
    "filiacao_segurado string, indica_obito_acidente string, municipio_empregador string,"
    "natureza_lesao string, origem_cadastramento_cat string, parte_corpo_atingida string,"
    "sexo string, tipo_acidente string, uf_municipio_acidente string,"
    "uf_municipio_empregador string, data_afastamento string, data_despacho_beneficio string,"
    "data_acidente_duplicada string, data_nascimento string, data_emissao_cat string,"
    "tipo_empregador string, cnpj_cei_empregador string"
)
STAGE_MUNICIPALITY = _columns(
    "municipio_tom_codigo int, municipio_ibge_codigo int, municipio_tom_descricao string,"
    "municipio_ibge_descricao string, municipio_uf string"
)
STAGE_AGENT = _columns("agente_codigo int, agente_descricao string")
STAGE_NATURE = _columns("natureza_codigo int, natureza_descricao string")
STAGE_DISEASE = _columns("cid10_codigo string, cid10_descricao string")

CORE_INCIDENT = _columns(
    "agente_causador_acidente string, data_acidente date, cid_10_codigo string,"
    "cnae_empregador_codigo int, indica_obito_acidente string, municipio_empregador int,"
    "natureza_lesao string, parte_corpo_atingida string, sexo string, tipo_acidente string,"
    "uf_municipio_acidente string, uf_municipio_empregador string, data_nascimento date"
)
CORE_MUNICIPALITY = _columns("municipio_ibge_codigo int, municipio_ibge_descricao string")
CORE_AGENT = _columns("id int, agente_descricao string")
CORE_NATURE = _columns("id int, natureza_descricao string")
CORE_DISEASE = _columns("cid10_codigo string, cid10_descricao string")

# Text columns of the incident fact that get cleaned.
INCIDENT_TEXTS = (
    "agente_causador_acidente", "cid_10_codigo", "indica_obito_acidente", "municipio_empregador",
    "natureza_lesao", "parte_corpo_atingida", "sexo", "tipo_acidente", "uf_municipio_acidente",
    "uf_municipio_empregador",
)
INCIDENT_DATES = ("data_acidente", "data_nascimento")

STAGE_MAX_LENGTHS = {"municipio_uf": 2}
CORE_MAX_LENGTHS = {"cid_10_codigo": 4}
