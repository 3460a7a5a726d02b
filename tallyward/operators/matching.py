"""Fuzzy join: free text onto the closest entry of a dictionary.

The rows are first reduced to distinct values. The dictionary becomes an inverted index: posting
lists of characters and of pairs of neighbouring characters (the second time that a text has one, it
is another token). A value is searched in two rounds, and no entry is skipped unless it provably
cannot win:

1. Its rare pairs lead to one promising entry, whose similarity is a lower bound of the best.
2. Only entries whose upper bound reaches it are admitted. The bound follows from the two lengths,
   the shared characters and the shared pairs, which the posting lists count for all entries at once.
   The longest common subsequence lowers it further; what is left is scored in falling order of the
   bound, until the bound is below the best score found.

Values do not shuffle for this. The index is broadcast, of at most ``MAX_ENTRIES`` entries and
``MAX_CHARACTERS`` characters. A larger dictionary goes out in several such blocks, one pass over the
values for each and round: first all blocks give a lower bound, then all admit what can beat it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.fixed_values import MATCH_CUTOFF
from tallyward.operators.attach import attach
from tallyward.session import materialise

MAX_ENTRIES = 20_000
MAX_CHARACTERS = 2_000_000
_RARE = 16  # a pair is rare that fewer than one in so many entries have
_LANE = 63  # characters of a value that fit a machine word

_RESULT = "value string, entry string, score double, scored long"


def _tokens(text: str) -> tuple[list[tuple], list[tuple]]:
    """Characters and pairs of a text, each with the number of its earlier occurrences."""
    result: tuple[list[tuple], list[tuple]] = ([], [])
    for tokens, grams in zip(result, (text, [text[i : i + 2] for i in range(len(text) - 1)])):
        seen: dict[str, int] = {}
        for gram in grams:
            n = seen[gram] = seen.get(gram, 0) + 1
            tokens.append((gram, n))
    return result


class Index:
    """Entries with the posting lists of their characters and pairs."""

    def __init__(self, entries: list[str]):
        self.entries = entries
        self.place = {e: i for i, e in enumerate(entries)}
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self.lists: tuple[dict, dict] = ({}, {})
        for i, entry in enumerate(entries):
            for lists, tokens in zip(self.lists, _tokens(entry)):
                for token in tokens:
                    lists.setdefault(token, []).append(i)
        for lists in self.lists:
            for token, members in lists.items():
                lists[token] = np.array(members, np.int32)
        self.codes = None

    def shared(self, kind: int, tokens: list[tuple], most: float = np.inf) -> np.ndarray:
        """How many of the tokens each entry has; tokens of ``most`` entries or more are left out."""
        lists = [m for t in tokens if (m := self.lists[kind].get(t)) is not None and len(m) < most]
        return np.bincount(np.concatenate(lists), minlength=len(self.entries)) if lists else np.zeros(len(self.entries), np.int64)

    def columns(self, chosen: np.ndarray) -> np.ndarray:
        """The code points of some entries, a row for each position; -1 behind an entry's end."""
        if self.codes is None:
            points = np.frombuffer("".join(self.entries).encode("utf-32-le"), np.int32)
            self.codes = points, np.cumsum(self.sizes) - self.sizes
        points, start = self.codes
        at = np.arange(int(self.sizes[chosen].max(initial=0)))[:, None]
        inside = at < self.sizes[chosen]
        return np.where(inside, points[np.minimum(start[chosen] + at, len(points) - 1)], -1)


def _masks(value: str, codes: np.ndarray) -> np.ndarray:
    """For each code the places where the value has it, as bits."""
    bits: dict[int, int] = {}
    for i, ch in enumerate(value):
        bits[ord(ch)] = bits.get(ord(ch), 0) | 1 << i
    known = np.array(sorted(bits), np.int64)
    masks = np.array([bits[c] for c in known.tolist()], np.uint64)
    at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
    return np.where(known[at] == codes, masks[at], np.uint64(0))


def _common_subsequences(value: str, index: Index, chosen: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences with some entries, all at once by bit-parallel rows."""
    if len(value) > _LANE:
        return np.array([_common_subsequence(value, index.entries[i]) for i in chosen.tolist()], np.int64)
    full = np.uint64((1 << len(value)) - 1)
    row = np.full(len(chosen), full, np.uint64)
    for mask in _masks(value, index.columns(chosen)):
        hit = row & mask
        row = ((row + hit) | (row - hit)) & full
    return len(value) - np.bitwise_count(row).astype(np.int64)


def _common_subsequence(value: str, other: str) -> int:
    positions: dict[str, int] = {}
    for i, ch in enumerate(value):
        positions[ch] = positions.get(ch, 0) | (1 << i)
    row = full = (1 << len(value)) - 1
    for ch in other:
        hit = row & positions.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(value) - row.bit_count()


def _distance(value: str, other: str) -> int:
    """Edit distance, by bit-parallel columns."""
    if not value or not other:
        return len(value) or len(other)
    positions: dict[str, int] = {}
    for i, ch in enumerate(value):
        positions[ch] = positions.get(ch, 0) | (1 << i)
    full, last = (1 << len(value)) - 1, 1 << len(value) - 1
    up, down, distance = full, 0, len(value)
    for ch in other:
        same = positions.get(ch, 0)
        across = (((same & up) + up) ^ up) | same | down
        more, less = down | ~(across | up) & full, up & across
        distance += bool(more & last) - bool(less & last)
        more, less = (more << 1 | 1) & full, less << 1 & full
        up, down = less | ~(across | more) & full, more & across
    return distance


class Ratio:
    """Twice the characters in matching blocks over both lengths.

    Blocks of n characters have n - 1 pairs. Between two blocks at least one character is left over,
    so there is at most one block more than characters left over: M matched characters of both
    lengths' sum T leave shared pairs >= M - (T - 2 M + 1).
    """

    def __init__(self, value: str):
        self.value = value
        self.matcher: SequenceMatcher | None = None

    def bounds(self, sizes: np.ndarray, characters: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        total = sizes + len(self.value)
        return 2.0 * np.minimum(characters, (pairs + total + 1) // 3) / np.maximum(total, 1)

    def lowered(self, index: Index, chosen: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        common = _common_subsequences(self.value, index, chosen)
        return 2.0 * common / (index.sizes[chosen] + len(self.value))

    def score(self, entry: str) -> float:
        if self.matcher is None:
            self.matcher = SequenceMatcher(None, "", self.value)
        self.matcher.set_seq1(entry)
        return self.matcher.ratio()


class Levenshtein:
    """One less the edit distance over the longer length. An edit changes two pairs at most."""

    def __init__(self, value: str):
        self.value = value

    def bounds(self, sizes: np.ndarray, characters: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        longer = np.maximum(sizes, len(self.value))
        edits = np.maximum(longer - characters, -((pairs + 1 - longer) // 2))
        return 1 - edits / np.maximum(longer, 1)

    def lowered(self, index: Index, chosen: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        # Of the longer text no more characters stay than a common subsequence has.
        longer = np.maximum(index.sizes[chosen], len(self.value))
        edits = longer - _common_subsequences(self.value, index, chosen)
        return np.minimum(bounds, 1 - edits / longer)

    def score(self, entry: str) -> float:
        return 1 - _distance(self.value, entry) / max(len(self.value), len(entry))


_SCORERS = {"ratio": Ratio, "levenshtein": Levenshtein}
Best = tuple[float, str]  # a score and the entry that has it, "" below the cutoff


def first_round(index: Index, measure: Ratio | Levenshtein, best: Best) -> tuple[Best, int]:
    """The score of one promising entry, and how many were scored."""
    value = measure.value
    if value in index.place:
        return max(best, (1.0, value)), 0
    pairs = _tokens(value)[1]
    shared = index.shared(1, pairs, max(2.0, len(index.entries) / _RARE))
    if not shared.any():
        return best, 0
    most = np.flatnonzero(shared == shared.max())
    nearest = most[np.argmin(np.abs(index.sizes[most] - len(value)))]
    entry = index.entries[nearest]
    return max(best, (measure.score(entry), entry)), 1


def second_round(index: Index, measure: Ratio | Levenshtein, best: Best) -> tuple[Best, int]:
    """The best of ``best`` and all entries, and how many were scored."""
    if best[0] == 1.0:  # nothing but the value itself
        return best, 0
    characters, pairs = _tokens(measure.value)
    bounds = measure.bounds(index.sizes, index.shared(0, characters), index.shared(1, pairs))
    chosen = np.flatnonzero(bounds >= best[0])
    if not len(chosen):
        return best, 0
    tighter = np.minimum(bounds[chosen], measure.lowered(index, chosen, bounds[chosen]))
    scored = 0
    for k in np.argsort(-tighter, kind="stable").tolist():
        if tighter[k] < best[0]:
            break
        entry = index.entries[chosen[k]]
        if tighter[k] == best[0] and entry <= best[1]:
            continue  # a tie at most, which goes to the greater entry
        best = max(best, (measure.score(entry), entry))
        scored += 1
    return best, scored


def _pass(values: DataFrame, index: Index, scorer: str, rounds: tuple) -> DataFrame:
    """Some rounds against one block, for values with the best that they have found so far."""
    shared = values.sparkSession.sparkContext.broadcast(index)
    measure = _SCORERS[scorer]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            rows = []
            for value, entry, score, scored in zip(*[column.to_pylist() for column in batch.columns]):
                best, mine = (score, entry), measure(value)
                for one in rounds:
                    best, n = one(index, mine, best)
                    scored += n
                rows.append((value, best[1], best[0], scored))
            columns = list(zip(*rows)) if rows else [[]] * 4
            kinds = (pa.string(), pa.string(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["value", "entry", "score", "scored"])

    return values.mapInArrow(run, _RESULT)


def search(values: DataFrame, entries: DataFrame, cutoff: float, scorer: str) -> DataFrame:
    """``(value, entry, score, scored)`` of all values; the entry is empty if none reaches the cutoff,
    and ``scored`` says how many entries the value was compared with in full."""
    entries = entries.filter("entry <> ''")
    # Values are few bytes and much work: they go to all tasks, whatever their size.
    tasks = 2 * int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    start = [F.lit("").alias("entry"), F.lit(float(cutoff)).alias("score"), F.lit(0).cast("long").alias("scored")]
    started = values.filter("value <> ''").repartition(tasks).select("value", *start)
    some = [r.entry for r in entries.limit(MAX_ENTRIES + 1).collect()]
    if len(some) <= MAX_ENTRIES and sum(map(len, some)) <= MAX_CHARACTERS:
        return _pass(started, Index(sorted(some)), scorer, (first_round, second_round)) if some else started
    entries = materialise(entries, "entries")
    size = entries.agg(F.count("entry").alias("n"), F.sum(F.length("entry")).alias("characters")).first()
    # Blocks are half full on average, so that none holds more than it may.
    blocks = 2 * max(-(-size.n // MAX_ENTRIES), -(-size.characters // MAX_CHARACTERS))
    block = F.pmod(F.xxhash64("entry"), F.lit(blocks))
    for one in (first_round, second_round):
        for b in range(blocks):
            index = Index(sorted(r.entry for r in entries.filter(block == b).collect()))
            if index.entries:
                started = materialise(_pass(started, index, scorer, (one,)), "matched")
    return started


def match_values(
    values: DataFrame,
    entries: DataFrame,
    *,
    cutoff: float = MATCH_CUTOFF,
    scorer: str = "ratio",
) -> DataFrame:
    """``(value, entry, score)`` for every value that has an entry at or above the cutoff.

    ``values`` and ``entries`` each have one column of distinct, non-null texts named
    ``value`` and ``entry``. Ties go to the lexicographically greatest entry. Empty texts match nothing.
    """
    if not 0 < cutoff <= 1:
        raise ValueError("cutoff must be above 0 and at most 1")
    return search(values, entries, cutoff, scorer).filter("entry <> ''").drop("scored")


def canonical_map(
    rows: DataFrame,
    column: str,
    dictionary: DataFrame,
    entry: str,
    *,
    cutoff: float = MATCH_CUTOFF,
    scorer: str = "ratio",
    protected: Iterable[str] = (),
) -> DataFrame:
    """The written mapping from each distinct value of ``column`` to its entry."""
    values = rows.select(F.col(column).alias("value")).filter(F.col("value").isNotNull())
    if protected := list(protected):
        values = values.filter(~F.col("value").isin(*protected))
    entries = dictionary.select(F.upper(entry).alias("entry")).filter(F.col("entry").isNotNull())
    mapping = match_values(values.distinct(), entries.distinct(), cutoff=cutoff, scorer=scorer)
    return materialise(mapping, "mapping")


def apply_map(
    rows: DataFrame,
    column: str,
    mapping: DataFrame,
    score_column: str | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Replace ``column`` by its entry in a mapping; values without one stay as they are.

    The mapping is a written table of known size: the planner broadcasts a small one, and the
    rows do not shuffle. ``hot`` are the column's hot values, if they are known.
    """
    joined = attach(rows, column, mapping, "value", {"_entry": "entry", "_score": "score"}, hot)
    joined = joined.withColumn(column, F.coalesce("_entry", column))
    if score_column:
        joined = joined.withColumn(score_column, F.col("_score"))
    return joined.drop("_entry", "_score")


def fuzzy_join(
    rows: DataFrame,
    column: str,
    dictionary: DataFrame,
    entry: str,
    *,
    cutoff: float = MATCH_CUTOFF,
    scorer: str = "ratio",
    protected: Iterable[str] = (),
    score_column: str | None = None,
) -> DataFrame:
    """Replace ``column`` by the closest upper-cased dictionary entry; keep it without one.

    ``protected`` values are left as they are. ``score_column`` adds the similarity.
    """
    mapping = canonical_map(
        rows, column, dictionary, entry, cutoff=cutoff, scorer=scorer, protected=protected
    )
    return apply_map(rows, column, mapping, score_column)
