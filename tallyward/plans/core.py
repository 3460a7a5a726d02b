"""Stage -> core: clean, canonicalise, check references."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward import fixed_values as fx
from tallyward.functions.dates import trimmed_date
from tallyward.functions.numbers import (
    blank_to_null,
    drop_check_digit,
    no_check_digit_to_drop,
    not_an_int,
    strict_int,
)
from tallyward.functions.text import clean_text, default_code, known_text, leading_code, strip, upper_text
from tallyward.operators.attach import attach, fits_broadcast, hot_values
from tallyward.operators.dimensions import dense_keys, with_unknown
from tallyward.operators.matching import apply_map, canonical_map
from tallyward.operators.quality import Split, missing_references, split_on_pk, tag, too_long
from tallyward.operators.shape import subset
from tallyward.session import materialise


def municipality(stage: DataFrame) -> Split:
    """Codes without check digit plus the unknown member; rows without a usable code aside."""
    code, name = "municipio_ibge_codigo", "municipio_ibge_descricao"
    unusable = no_check_digit_to_drop(F.col(code))
    cleaned = (
        stage.filter(~unusable)
        .select(drop_check_digit(F.col(code)).alias(code), clean_text(F.col(name)).alias(name))
        .filter(F.col(code).isNotNull() & (F.col(code) != fx.UNKNOWN_CODE))
    )
    keyed = split_on_pk(cleaned, [code])
    return Split(
        with_unknown(keyed.valid, code, name, source=stage),
        keyed.violations.unionByName(stage.filter(unusable).select(code, name)),
    )


def dictionary(stage: DataFrame, code: str, text: str) -> DataFrame:
    """Cleaned descriptions numbered in the order of their source codes."""
    numbered = dense_keys(stage.select(code, text), [code])
    return numbered.select("id", clean_text(F.col(text)).alias(text))


def disease(stage: DataFrame) -> DataFrame:
    text = "cid10_descricao"
    return stage.select("cid10_codigo", clean_text(F.col(text)).alias(text))


def clean_incidents(stage: DataFrame) -> DataFrame:
    """The fact columns that exist, cleaned; no shuffle.

    A text that several tests look at is a column of a projection below them, so it is made once.

    ``_bad_place`` and ``_bad_activity`` mark texts that should hold an integer and do not.
    """
    place, activity = "municipio_empregador", "cnae_empregador_codigo"
    fact = subset(stage, fx.CORE_INCIDENT.names)
    kinds = dict(fact.dtypes)
    texts = [c for c in fx.INCIDENT_TEXTS if c in kinds]
    dates = [c for c in fx.INCIDENT_DATES if c in kinds]
    fact = fact.withColumns({c: upper_text(F.col(c)) for c in texts} | {c: strip(F.col(c)) for c in dates})
    cleaned = {c: known_text(F.col(c)) for c in texts} | {c: trimmed_date(F.col(c)) for c in dates}
    if kinds.get(activity) == "string":
        cleaned[activity] = blank_to_null(F.col(activity))
    fact = fact.withColumns(cleaned)
    marks = {"_bad_place": F.lit(False), "_bad_activity": F.lit(False)}
    if place in kinds:
        for step in (leading_code, default_code, strict_int):
            fact = fact.withColumn(place, step(F.col(place)))
        marks["_bad_place"] = F.col(place).isNull()
    if kinds.get(activity) == "string":
        marks["_bad_activity"] = not_an_int(F.col(activity))
        return fact.withColumns(marks).withColumn(activity, strict_int(F.col(activity)))
    return fact.withColumns(marks)


def incidents(
    stage: DataFrame,
    municipality_dim: DataFrame,
    agent_dim: DataFrame,
    nature_dim: DataFrame,
    *,
    protected: Iterable[str] = (fx.UNKNOWN,),
    cutoff: float = fx.MATCH_CUTOFF,
) -> DataFrame:
    """The incident fact with a ``violations`` array (empty for rows that may load).

    ``protected=()`` also matches the unknown word against the dictionaries. Rows are cleaned once and
    written; what the mappings, the reference check and the joins read of them are columns of that.
    """
    protected = tuple(protected)
    fact = materialise(clean_incidents(stage), "cleaned")
    dictionaries = {
        "agente_causador_acidente": (agent_dim, "agente_descricao"),
        "natureza_lesao": (nature_dim, "natureza_descricao"),
    }
    # Each mapping reads one column of the cleaned rows; only then are they joined, once.
    mappings = {
        column: canonical_map(fact, column, dim, text, cutoff=cutoff, protected=protected)
        for column, (dim, text) in dictionaries.items()
        if column in fact.columns
    }
    place = "municipio_empregador"
    nowhere = missing_references(fact, place, municipality_dim, "municipio_ibge_codigo")
    nowhere = nowhere.withColumn("_found", F.lit(True))
    # Hot values are looked for before any join, in all columns whose side is large.
    large = [c for c, side in {**mappings, place: nowhere}.items() if not fits_broadcast(side)]
    hot = hot_values(fact, large) if large else None
    for column, mapping in mappings.items():
        fact = apply_map(fact, column, mapping, hot=hot)
    fact = attach(fact, place, nowhere, "_value", {"_no_place": "_found"}, hot)
    fact = fact.withColumn("_no_place", F.col("_no_place").isNotNull())
    rules = {
        f"{column} too long": too_long(F.col(column), limit)
        for column, limit in fx.CORE_MAX_LENGTHS.items()
        if column in fact.columns
    }
    rules |= {
        "municipio_empregador not an integer": F.col("_bad_place"),
        "municipio_empregador not in municipio": F.col("_no_place"),
        "cnae_empregador_codigo not an integer": F.col("_bad_activity"),
    }
    return tag(fact, rules).drop("_bad_place", "_bad_activity", "_no_place")


def split_tagged(tagged: DataFrame, on_violation: str = "quarantine") -> Split:
    """Written once, then split; ``fail`` raises before anything is published."""
    if on_violation not in ("quarantine", "fail"):
        raise ValueError(f"unknown policy: {on_violation}")
    written = materialise(tagged, "checked")
    violations = written.filter(F.size("violations") > 0)
    if on_violation == "fail" and (bad := violations.first()):
        raise ValueError(f"rows break rules, e.g. {bad.violations}")
    return Split(written.filter(F.size("violations") == 0).drop("violations"), violations)
