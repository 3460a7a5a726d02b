"""Line dedup: lines that differ by a few edits, found by a segment-partition join.

Only DataFrame functions are used. A line that may have ``t`` edits has ``t + 1`` segments, placed
from its start and from its end: one of them is untouched in any line within that distance, and
hardly moved (see ``segment_keys``). Segments are indexed by a step of the line's length, number and
content. Candidates are verified by an edit distance within the band of the threshold.

Many lines may share a segment and little else. Those that did not end in one class are indexed again
by a segment and counts of a few letters: ``t`` edits change these by ``2 t`` in all, so of
``2 t + 1`` groups of counts one is the same. Of lines that meet there, only those whose counts are as
close as that are compared.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.linking import link, shared_groups
from tallyward.llm.text import fresh
from tallyward.session import materialise

LENGTHS = (20, 60, 240)  # characters from which a line may have one, two, three edits; shorter ones must be equal
STEPS = (8, 16, 16)  # of lengths that are indexed alike, with one, two, three edits
COUNTED = "etaoinsrhlduc "  # characters that are counted in each half of a line
WORDS = ("w0", "w1", "w2", "w3")  # long integers of seven counts, seven bits each in a byte
LANES = (  # bytes of all words together, of which one group at least is the same after one, two, three edits
    ((0, 1), (2, 3), (4, 5, 6)),
    ((0,), (1,), (2,), (3, 4), (5, 6)),
    ((0,), (1,), (2,), (3,), (4,), (5,), (6,)),
)


def allowed_edits(length: Column, lengths: Sequence[int]) -> Column:
    return sum((F.when(length >= least, 1).otherwise(0) for least in lengths), F.lit(0))


def measured(line: Column) -> list[Column]:
    """``line``, its ``size`` and ``ascii_bytes``, which are null for a line that is not ASCII.

    Of bytes, substrings are found without counting characters.
    """
    ascii_only = F.octet_length(line) == F.length(line)
    return [line.alias("line"), F.length(line).alias("size"), F.when(ascii_only, line.cast("binary")).alias("ascii_bytes")]


def segment_keys(lengths: Sequence[int]) -> Column:
    """Keys of a ``measured`` line's segments, for its own length and for the shorter lines within reach."""
    return F.flatten(F.transform(_steps(lengths), lambda step: F.transform(step["keys"], lambda k: k["key"])))


def part_keys(lengths: Sequence[int]) -> Column:
    """Keys of a ``measured`` line's segments, each with a group of counts."""
    return F.transform(_narrow_keys(lengths), lambda k: k["key"])


def _steps(lengths: Sequence[int]) -> Column:
    """For each step of lengths that a ``measured`` line is indexed with: its least length ``least``, the
    ``edits`` allowed, whether it is the line's ``own``, and ``keys`` with ``place`` and ``key``.

    Two lines meet in the step of the shorter one: a longer one is indexed with each step that its
    length less the edits reaches into, which are two at most.

    With ``t`` edits the segments are ``t + 1`` parts of the least length of the step, so they do not
    overlap; the first half is placed from the line's start, the others from its end. If the outer
    ones have an edit each, at most ``t - 2`` are left for the inner ones, and for ``t`` up to three one
    inner segment is untouched with at most one edit between it and its end of the line. So it has
    moved by one at most: leaving out its last and its first character tells both cases.
    """
    steps = []
    for edits, least in enumerate(lengths, 1):
        width = STEPS[edits - 1]
        most = f"least(size, {lengths[edits] - 1})" if edits < len(lengths) else "size"
        reached = f"greatest(size - {edits}, {least})"
        own, low = (f"({least} + ({n} - {least}) div {width} * {width})" for n in (most, reached))
        there = f"{most} >= {reached}"
        steps.append(_step(own, edits, f"{there}", f"size = {most}"))
        steps.append(_step(low, edits, f"{there} and {low} < {own}", "false"))
    # The filter keeps Spark from compiling the many expressions into one method that is too large
    # for the JVM to make fast.
    return F.filter(F.expr(f"array({', '.join(steps)})"), lambda step: step.isNotNull())


def _step(least: str, edits: int, there: str, own: str) -> str:
    of_bytes, of_text = (
        ", ".join(_segments("v", edits, piece))
        for piece in ("substring(ascii_bytes, {}, {})", "cast(substring(line, {}, {}) as binary)")
    )
    keys = f"if(ascii_bytes is null, array({of_text}), array({of_bytes}))"
    step = f"named_struct('least', v, 'edits', {edits}, 'own', {own}, 'keys', {keys})"
    return f"case when {there} then get(transform(array(int({least})), v -> {step}), 0) end"


def _segments(least: str, edits: int, piece: str) -> list[str]:
    keys = []
    for i in range(edits + 1):
        begin, end = (f"int({least} * {k} div {edits + 1})" for k in (i, i + 1))
        if 2 * i > edits:  # placed from the end
            begin, end = (f"(size - {least} + {at})" for at in (begin, end))
        moves = min(i, edits - i)
        for move in range(moves + 1):
            part = piece.format(f"{begin} + {1 + move}", f"{end} - {begin} - {moves}")
            keys.append(f"named_struct('place', {i}, 'key', xxhash64({least}, {i}, {part}))")
    return keys


def _mask(lanes: Sequence[int], byte: int) -> int:
    return sum(byte << (8 * lane) for lane in lanes)


def _narrow_keys(lengths: Sequence[int]) -> Column:
    """``key`` and ``about`` of a ``measured`` line's segments, each with each group of its counts."""

    def with_counts(step: Column) -> Column:
        return _let(F.struct(step.alias("step"), _counts(step["least"]).alias("n")), expanded)

    def expanded(p: Column) -> Column:
        by_edits = F.lit(None)
        for edits in range(1, len(lengths) + 1):
            keys = F.flatten(F.array(*[one_group(p, edits, g) for g in range(2 * edits + 1)]))
            by_edits = F.when(p["step"]["edits"] == edits, keys).otherwise(by_edits)
        return by_edits

    def one_group(p: Column, edits: int, g: int) -> Column:
        groups, own = LANES[edits - 1], p["step"]["own"]
        counts = [p["n"][w].bitwiseAND(F.lit(_mask(groups[g], 0x7F))) for w in WORDS]
        before = _mask([lanes[0] for lanes in groups[:g] if len(lanes) == 1], 0x80)
        about = [F.lit(edits).alias("edits"), own.alias("own"), F.lit(before).cast("long").alias("before")]
        about = F.struct(*about, *[p["n"][w].alias(w) for w in WORDS])
        return F.transform(
            p["step"]["keys"], lambda k: F.struct(F.xxhash64(k["key"], F.lit(g), *counts).alias("key"), about.alias("about"))
        )

    return F.flatten(F.transform(_steps(lengths), with_counts))


def _counts(least: Column) -> Column:
    """How often a ``measured`` line has each of a few characters in its first and in its last half of
    ``least`` characters, modulo 128, packed into ``WORDS``."""
    half = F.floor(least / 2).cast("int")
    first = F.substring(F.col("line"), F.lit(1), half)
    last = F.substring(F.col("line"), F.col("size") - half + 1, half)

    def packed(halves: Column) -> Column:
        words = []
        for i, name in enumerate(WORDS):
            half, seven = halves["first" if i < 2 else "last"], COUNTED[7 * (i % 2) : 7 * (i % 2) + 7]
            word = F.lit(0).cast("long")
            for lane, c in enumerate(seven):
                left = F.length(F.replace(half, F.lit(c), F.lit("")))
                n = (F.length(half) - left).bitwiseAND(127).cast("long")
                word = word.bitwiseOR(F.shiftleft(n, 8 * lane))
            words.append(word.alias(name))
        return F.struct(*words)

    return _let(F.struct(first.alias("first"), last.alias("last")), packed)


def _apart(a: Column, b: Column) -> Column:
    """At most how much two lines' counts differ in all, by seven at once.

    In each byte it is the way around the circle of 128, whichever is shorter. The bytes' sum is
    taken modulo 255, so it is never too large.
    """
    low, one, top = (F.lit(_mask(range(7), byte)) for byte in (0x7F, 0x01, 0x80))

    def word(x: Column, y: Column) -> Column:
        minus = x.bitwiseOR(top) - y
        far = F.shiftright(minus, 6).bitwiseAND(one)
        return (minus.bitwiseXOR(F.shiftleft(far, 7) - far).bitwiseAND(low) + far) % 255

    return sum((word(a[w], b[w]) for w in WORDS[1:]), word(a[WORDS[0]], b[WORDS[0]]))


def _near_counts(a: Column, b: Column) -> Column:
    """Whether of two lines that meet the shorter one is in its own step, their counts are as close as
    the edits allow, and they did not meet by an earlier group of one byte."""
    differ = a[WORDS[0]].bitwiseXOR(b[WORDS[0]])
    for w in WORDS[1:]:
        differ = differ.bitwiseOR(a[w].bitwiseXOR(b[w]))
    new = (differ + F.lit(_mask(range(7), 0x7F))).bitwiseAND(a["before"]) == a["before"]
    return (a["own"] | b["own"]) & (_apart(a, b) <= 2 * a["edits"]) & new


def edits_within(a: Column, b: Column, threshold: int) -> Column:
    """True if two texts are at most ``threshold`` edits apart; computed only within that band."""
    return F.levenshtein(a, b, threshold) >= 0


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _occurrences(docs: DataFrame, row: str, doc_id: str, text: str, lengths: Sequence[int]) -> DataFrame:
    """``(_row, _id, place, line)`` of every line that is not blank, or long enough for an edit."""
    lines = docs.select(F.col(row).alias("_row"), F.col(doc_id).alias("_id"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("place", "line"))
    inked = F.col("line").rlike(r"[^\x20\x09-\x0D]")
    return lines.filter(inked | (allowed_edits(F.length("line"), lengths) > 0))


def row_key(doc_id: str, text: str) -> Column:
    """What tells rows apart: their id and text together."""
    whole = F.coalesce(F.md5(F.col(text).cast("binary")), F.lit("-"))
    return F.unhex(F.md5(F.concat_ws(":", whole, F.col(doc_id).cast("string")).cast("binary")))


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lengths: Sequence[int] = LENGTHS
) -> DataFrame:
    """``docs`` with each line of a class but its first left out, plus ``n_lines``, ``n_removed`` and
    ``removed``: number (from 0) of each line left out, and id and line of the one that stays.

    Lines are what line feeds separate. Two are linked if they are equal, or at most as many edits apart
    as the shorter one's length allows: one from ``lengths[0]`` characters on, two from ``lengths[1]``
    on, and so on, at most three. Blank lines below ``lengths[0]`` characters stay. Lines of any length
    are compared whole. Classes are what links connect, over all documents. The first line of a class is that of the
    smallest id, then the smallest line number; null ids come last. Rows of one id and one text are
    treated alike, so both keep a first line. A null text stays null and has no lines. Columns with
    the names of new ones are replaced.
    """
    if len(lengths) > len(STEPS) or list(lengths) != sorted(lengths) or any(n < 16 for n in lengths):
        raise ValueError("lengths must be at most three, ascending, from 16 on")
    new = ("n_lines", "n_removed", "removed")
    docs = docs.drop(*new)
    row, kept_columns = fresh("_row", docs), docs.columns
    docs = docs.withColumn(row, row_key(doc_id, text))
    found = _occurrences(docs, row, doc_id, text, lengths)
    node = F.xxhash64("line", F.md5(F.col("line").cast("binary")))
    order = F.struct(F.col("_id").isNull().alias("last"), F.col("_id").alias("id"), F.col("place").alias("place"))
    places = materialise(found.select("_row", "_id", "place", node.alias("node")), "lines")
    firsts = materialise(places.groupBy("node").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")), "firsts")

    keys = found.select(node.alias("node"), *measured(F.col("line"))).select(
        "node", F.explode(segment_keys(lengths)).alias("key")
    )
    shared = shared_groups(keys)
    wanted = materialise(shared.select("node").distinct(), "wanted")
    lines = found.select(node.alias("node"), "line").join(wanted, "node", "left_semi")
    lines = lines.groupBy("node").agg(F.min("line").alias("line"))
    lines = materialise(lines, "line-texts")

    def narrow(nodes: DataFrame) -> DataFrame:
        apart = lines.join(nodes, "node", "left_semi").select("node", *measured(F.col("line")))
        return apart.select("node", F.explode(_narrow_keys(lengths)).alias("k")).select("k.key", "node", "k.about")

    labels = link(shared, lambda pairs: _verify(pairs, lines, lengths), narrow, _near_counts)

    classes = firsts.join(labels, "node", "left").withColumn("class", F.coalesce("component", "node"))
    heads = classes.groupBy("class").agg(F.min("first").alias("head"), F.sum("n").alias("total")).filter("total > 1")
    heads = materialise(classes.join(heads, "class").select("node", "head"), "classes")
    later = places.join(heads, "node").filter(~order.eqNullSafe(F.col("head")))
    entry = F.struct(F.col("place").alias("line"), F.col("head.id").alias("first_id"), F.col("head.place").alias("first_line"))
    removed = later.groupBy(F.col("_row").alias(row)).agg(F.array_sort(F.collect_set(entry)).alias("removed"))

    joined = docs.join(materialise(removed, "removed-lines"), row, "left")
    all_lines = F.split(F.col(text), "\n", -1)
    gone = F.transform("removed", lambda r: r["line"])
    kept = _let(gone, lambda g: F.filter(all_lines, lambda _, i: ~F.array_contains(g, i)))
    shorter = F.when(F.col("removed").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    return joined.select(
        *[shorter.alias(c) if c == text else F.col(f"`{c}`") for c in kept_columns],
        F.coalesce(F.size(all_lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        "removed",
    )


def _verify(pairs: DataFrame, lines: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """The pairs of lines that are close enough."""
    left = lines.select(F.col("node").alias("a"), F.col("line").alias("la"))
    right = lines.select(F.col("node").alias("b"), F.col("line").alias("lb"))
    both = pairs.join(left, "a").join(right, "b")
    swap = F.length("la") > F.length("lb")
    short, long = F.when(swap, F.col("lb")).otherwise(F.col("la")), F.when(swap, F.col("la")).otherwise(F.col("lb"))
    allowed = allowed_edits(F.length("short"), lengths)
    close = F.lit(False)
    for edits in range(1, len(lengths) + 1):
        close = F.when(allowed == edits, edits_within(F.col("short"), F.col("long"), edits)).otherwise(close)
    return both.select("a", "b", short.alias("short"), long.alias("long")).filter(close).select("a", "b")
