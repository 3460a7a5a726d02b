"""Quality rules with thresholds taken from the data, on DataFrame functions only.

Each text is measured once, by column expressions. Measures of all texts go into quantile sketches
per language and source, which merge from task to task; the fences that they give replace fixed
cutoffs and are joined to the measures. Sketches of a source merge into those of its language, and
those of languages into that of all texts, for groups too small to have fences of their own.

A measure is a count over a size: characters over words, symbols over characters, repeated lines
over lines. One more in the count moves it by a step, which is known from the sizes alone. Where the
quartiles are equal, the distance of a fence is taken from the tail of the sketch, and is at least
that of a few steps in a text of median size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.text import fresh
from tallyward.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
BLANKS, SYMBOLS = " \t\n\u000b\f\r", "#*$%&|<>"
MIN_WORDS, MAX_REPEATED = 10, 20  # base rules: words, percent of words in repeated windows
WINDOW = 5

#: Measures with a fence, and the size that each is a count over.
MEASURES = {"word_length": "n_words", "symbol_share": "word_chars", "dup_line_share": "n_lines"}
NEW = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
SPREAD = 6.0  # fences are so many interquartile ranges, or tails, or steps outside the quartiles
LOW, MEDIAN, HIGH, TAIL = 0.25, 0.5, 0.75, 0.9
MIN_GROUP = 50  # texts; a smaller group takes the fences of its language, then those of all


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _repeat_words(words: Column) -> Column:
    """How many words are in a window of words that occurs twice or more."""
    n = F.size(words)
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def covered(windows: Column) -> Column:
        # Windows ordered by hash; those that equal a neighbour are repeated.
        places = F.sort_array(
            F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
        )
        return F.aggregate(
            F.sort_array(_repeated(places)),
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda done, i: F.struct(
                (done["n"] + i + WINDOW - F.greatest(i, done["end"])).alias("n"), (i + WINDOW).alias("end")
            ),
            lambda done: done["n"],
        )

    def measured(h: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), n - WINDOW),
            lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]),
        )
        return _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(covered(w)))

    return F.when(n < WINDOW + 1, 0).otherwise(_let(hashes, measured))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeated(places: Column) -> Column:
    """Positions ``i`` of the entries whose ``w`` equals that of an entry beside them."""

    def found(p: Column) -> Column:
        same = lambda entry, other: F.coalesce(entry["w"] == F.get(p, other)["w"], F.lit(False))
        return F.transform(
            F.filter(p, lambda e, k: same(e, k - 1) | same(e, k + 1)), lambda e: e["i"]
        )

    return _let(places, found)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines``, ``n_dup_lines``,
    ``n_repeat_words`` and ``base_failed``. A null text has no words and one line. Columns of these
    names are replaced."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all(whole, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(whole, "\n", -1), lambda line: F.length(_without(line, BLANKS)) > 0)
    dup_lines = _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    counts = _let(words, lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("r")))
    both = fresh("_counts", docs)
    measured = docs.withColumn(both, counts)
    measured = measured.withColumns(
        {
            "n_words": F.col(both)["n"].cast("long"),
            "word_chars": F.length(_without(whole, BLANKS)).cast("long"),
            "n_symbols": (F.length(whole) - F.length(_without(whole, SYMBOLS))).cast("long"),
            "n_lines": F.size(F.split(whole, "\n", -1)).cast("long"),
            "n_dup_lines": dup_lines.cast("long"),
            "n_repeat_words": F.col(both)["r"].cast("long"),
        }
    ).drop(both)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return measured.withColumn("base_failed", failed)


def shares() -> dict[str, Column]:
    """The measures that fences apply to; NULL for texts without words."""
    some = F.col("n_words") > 0
    counts = {"word_length": "word_chars", "symbol_share": "n_symbols", "dup_line_share": "n_dup_lines"}
    return {name: F.when(some, F.col(count) / F.col(MEASURES[name])) for name, count in counts.items()}


def fences(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``(group_lang, group_source)`` and for each measure a struct of ``low``, ``high`` and ``reach``:
    the quartiles, and how far from them a value may be.

    ``reach`` is ``SPREAD`` interquartile ranges. Where the quartiles are equal it is ``SPREAD`` times
    the distance from the median to the tail quantile, and at least ``SPREAD`` steps in a text of
    median size. Sketches are made once per language and source; merging those of a language serves
    its groups that are too small, and merging all of them serves languages that are too small.
    """
    values = shares()
    sketched = values | {f"{m}_size": F.when(v.isNotNull(), F.col(MEASURES[m]).cast("double")) for m, v in values.items()}
    groups = (
        measured.select(F.col(lang).alias("lang"), F.col(source).alias("source"), *[c.alias(m) for m, c in sketched.items()])
        .groupBy("lang", "source")
        .agg(F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(m).alias(m) for m in sketched])
    )
    groups = materialise(groups, "sketches")
    whole = groups.groupBy(F.col("lang").alias("of")).agg(
        F.sum("n").alias("n_lang"), *[F.kll_merge_agg_double(m).alias(f"{m}_lang") for m in sketched]
    )
    every = groups.agg(*[F.kll_merge_agg_double(m).alias(f"{m}_all") for m in sketched])
    both = groups.join(whole, F.col("lang").eqNullSafe(F.col("of"))).crossJoin(every)

    def quantile(name: str, at: float) -> Column:
        sketch = (
            F.when(F.col("n") >= MIN_GROUP, F.col(name))
            .when(F.col("n_lang") >= MIN_GROUP, F.col(f"{name}_lang"))
            .otherwise(F.col(f"{name}_all"))
        )
        return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(at)))

    columns = []
    for name in MEASURES:
        low, high = quantile(name, LOW), quantile(name, HIGH)
        tail, step = quantile(name, TAIL) - quantile(name, MEDIAN), 1 / quantile(f"{name}_size", MEDIAN)
        reach = SPREAD * F.when(high > low, high - low).otherwise(F.greatest(tail, step))
        columns.append(F.struct(low.alias("low"), high.alias("high"), reach.alias("reach")).alias(name))
    return both.select(F.col("lang").alias("group_lang"), F.col("source").alias("group_source"), *columns)


def judge(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", columns: list[str] | None = None
) -> DataFrame:
    """``docs`` plus the measures, ``base_failed`` and ``kept``; with ``columns`` only these of ``docs``.

    A text is kept if it passes the base rules and each measure is inside the fences of its language
    and source, or within ``SPREAD`` steps of its quartiles: a few symbols or repeated lines never
    fail a short text. Null and empty texts fail the base rules; long ones are measured whole. A null
    language or source is a group like any other; repeated rows and ties count as often as they
    occur, an empty table gives an empty one. Fences come from quantile sketches, so that they are
    exact for small groups and close to it for large ones. Measures are written once, with the text
    only if it is asked for. Columns with the names of new ones are replaced, all others stay
    whatever their names.
    """
    asked = [c for c in (columns or docs.columns) if c.lower() not in NEW]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in asked]).alias("row"),
        F.col(text).alias("text"),
        F.col(lang).alias("lang"),
        F.col(source).alias("source"),
    )
    measured = materialise(measure(rows).drop("text"), "measured")
    limits = materialise(fences(measured), "fences")
    same = F.col("lang").eqNullSafe(F.col("group_lang")) & F.col("source").eqNullSafe(F.col("group_source"))
    joined = measured.join(limits, same, "left")
    fine = ~F.col("base_failed")
    for name, value in shares().items():
        reach = F.greatest(F.col(f"{name}.reach"), SPREAD / F.nullif(F.col(MEASURES[name]), F.lit(0)))
        outside = (value < F.col(f"{name}.low") - reach) | (value > F.col(f"{name}.high") + reach)
        fine = fine & ~F.coalesce(outside, F.lit(False))
    return joined.withColumn("kept", fine).select("row.*", *NEW)
