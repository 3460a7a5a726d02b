"""The incident fact beside its dimensions: their ids and their labels, one row for each incident."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward import fixed_values as fx
from tallyward.functions.text import clean_text
from tallyward.operators.attach import attach, fits_broadcast, hot_values


def _one(dim: DataFrame, key: Column, value: str) -> DataFrame:
    """``(key, value)`` with the smallest value of each key, so that a join adds no row."""
    return dim.select(key.alias("key"), F.col(value).alias("value")).groupBy("key").agg(F.min("value").alias("value"))


def incident_star(
    fact: DataFrame,
    places: DataFrame,
    agents: DataFrame,
    natures: DataFrame,
    diseases: DataFrame,
    unknown: str = fx.UNKNOWN,
) -> DataFrame:
    """``fact`` plus ``agente_id``, ``natureza_id``, ``municipio_ibge_descricao`` and ``cid10_descricao``.

    An agent or nature that its dimension does not have gets the unknown member's id, a place or
    disease its word. Of entries that share a text the one with the smallest id counts. ``fact`` should
    be written: beside dimensions too large to broadcast, hot values of all keys are found in one pass.
    """
    lookups = [
        ("agente_causador_acidente", _one(agents, F.col("agente_descricao"), "id"), "agente_id", fx.UNKNOWN_CODE),
        ("natureza_lesao", _one(natures, F.col("natureza_descricao"), "id"), "natureza_id", fx.UNKNOWN_CODE),
        (
            "municipio_empregador",
            _one(places, F.col("municipio_ibge_codigo"), "municipio_ibge_descricao"),
            "municipio_ibge_descricao",
            unknown,
        ),
        ("cid_10_codigo", _one(diseases, clean_text(F.col("cid10_codigo")), "cid10_descricao"), "cid10_descricao", unknown),
    ]
    large = [column for column, side, *_ in lookups if not fits_broadcast(side)]
    hot = hot_values(fact, large) if large else None
    star = fact
    for column, side, name, otherwise in lookups:
        star = attach(star, column, side, "key", {name: "value"}, hot)
        star = star.withColumn(name, F.coalesce(name, F.lit(otherwise)))
    return star
