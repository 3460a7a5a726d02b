"""Near-duplicate documents: MinHash signatures, a multi-index Hamming join, exact confirmation.

A signature is minimum hashes cut to ``BITS`` bits, split into chunks of ``WIDTH``. Two texts are
candidates if their signatures differ in less than two symbols a chunk: by the pigeonhole principle
one chunk of such a pair has at most one error, so every chunk is indexed once for each place of
that error, with the place left out. Texts with one and the same shingle set are one node.
Candidates must also agree in a longer signature, and are confirmed on their full sets. The number
of chunks and of errors in the longer signature follow the similarity asked for.

Texts that share a frequent passage share keys without being similar. Of those, only pairs that
have one of their rarest shingles in common can be links, and only if at the first of these enough
shingles are left in both sets; only such pairs are compared.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import blake2b
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.llm.linking import link, shared_groups
from tallyward.llm.text import INK_BYTES, LOWER, add_columns, binary_array, fresh, mix, split_words, utf8, window_keys
from tallyward.session import discard, materialise

SHINGLE = 5
SYMBOLS, BITS, CHUNKS = 40, 16, 10  # the least; lower similarities have more chunks
WIDTH = SYMBOLS // CHUNKS
ERRORS = 2 * CHUNKS - 1  # one error for each chunk, and one less than a second for each

CHECKS = 128  # symbols of one byte in the longer signature
MAX_LOSS = 2.5e-7  # probability that a signature loses a link at the border
PIECE = 1 << 18  # bytes of texts handled at once: their shingles take many times that
COUNTERS = 1 << 20  # of the shingle frequencies that are broadcast
ID_BITS = 1 << 26  # of the ids whose texts are fetched, broadcast as at most 8 MB

_SEEDS = mix(np.arange(1, CHECKS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def loss(symbols: int, errors: int, percent: int) -> float:
    """Probability that a pair of similarity ``percent`` differs in more than ``errors`` symbols."""
    same = percent / 100
    return sum(comb(symbols, k) * (1 - same) ** k * same ** (symbols - k) for k in range(errors + 1, symbols + 1))


def permitted(percent: int) -> tuple[int, int]:
    """Chunks of the index and errors of the longer signature that lose hardly any link."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be above 0 and at most 100")
    fits = [c for c in range(CHUNKS, CHECKS // WIDTH + 1) if loss(WIDTH * c, 2 * c - 1, percent) <= MAX_LOSS]
    if not fits:
        raise ValueError(f"the index cannot find all pairs of similarity {percent} percent")
    return fits[0], next(e for e in range(CHECKS + 1) if loss(CHECKS, e, percent) <= MAX_LOSS)


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, one text after the other, and where each
    text's begin. Fewer words than ``size`` are one shingle."""
    data, bounds = utf8(texts)
    words = split_words(LOWER[data], bounds, INK_BYTES)
    keys, sets = window_keys(words.key, size), []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a < size:
            sets.append(window_keys(words.key[a:b], b - a) if a < b else keys[:0])
        else:
            sets.append(np.unique(keys[a : b - size + 1]))
    ends = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int64)
    return np.concatenate(sets) if sets else keys[:0], ends


def signatures(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of symbols for each non-empty set: the low bits of the minimum of each hash."""
    begin = bounds[:-1][np.diff(bounds) > 0]
    symbols = np.zeros((len(begin), CHECKS), np.uint64)
    if len(begin):
        for i, seed in enumerate(_SEEDS):
            value = (flat ^ seed) * (seed | np.uint64(1))
            value ^= value >> np.uint64(31)
            value *= np.uint64(0x94D049BB133111EB)
            symbols[:, i] = np.minimum.reduceat(value, begin)
    return mix(symbols) & np.uint64((1 << BITS) - 1)


def index_keys(symbols: np.ndarray, count: int = CHUNKS) -> np.ndarray:
    """For each row, chunk and place in the chunk, a key of the chunk without that place."""
    chunks = symbols[:, : WIDTH * count].reshape(-1, count, WIDTH)
    keys = np.zeros(chunks.shape, np.uint64)
    for left_out in range(WIDTH):
        for place in range(WIDTH):
            if place != left_out:
                keys[:, :, left_out] = (keys[:, :, left_out] << np.uint64(BITS)) | chunks[:, :, place]
    slot = np.arange(WIDTH * count, dtype=np.uint64).reshape(count, WIDTH)
    return mix(keys | (slot << np.uint64(BITS * (WIDTH - 1)))).reshape(-1, WIDTH * count)


def describe(docs: DataFrame, text: str = "text", percent: int = 85) -> DataFrame:
    """``docs`` plus ``n_shingles``, ``set_key`` (a digest of the shingle set, null if it is empty),
    ``index_keys`` and ``checks``, the longer signature."""
    count = permitted(percent)[0]

    def make():
        def work(texts: pa.Array) -> list[pa.Array]:
            flat, bounds = shingle_sets(texts)
            sizes = np.diff(bounds)
            symbols = signatures(flat, bounds)
            keys, some = index_keys(symbols, count).view(np.int64), np.concatenate(([0], np.cumsum(sizes > 0)))
            lists = pa.ListArray.from_arrays(pa.array(some * WIDTH * count, pa.int32()), pa.array(keys.ravel(), pa.int64()))
            checks = binary_array(symbols.astype(np.uint8).ravel(), some * CHECKS)
            return [pa.array(sizes, pa.int64()), _digests(flat, bounds), lists, checks]

        return work

    fields = [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_key", T.BinaryType()),
        T.StructField("index_keys", T.ArrayType(T.LongType())),
        T.StructField("checks", T.BinaryType()),
    ]
    return add_columns(docs, make, fields, text, piece=PIECE)


def _digests(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    spans = zip(bounds[:-1].tolist(), bounds[1:].tolist())
    rows = [blake2b(flat[a:b].tobytes(), digest_size=16).digest() if a < b else None for a, b in spans]
    return pa.array(rows, pa.binary())


def _add_sets(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``node``, the digest of each text's shingle set, and the packed ``shingles``."""

    def make():
        def work(texts: pa.Array) -> list[pa.Array]:
            flat, bounds = shingle_sets(texts)
            return [_digests(flat, bounds), binary_array(flat.view(np.uint8), bounds * 8)]

        return work

    fields = [T.StructField("node", T.BinaryType()), T.StructField("shingles", T.BinaryType())]
    return add_columns(docs, make, fields, piece=PIECE)


def _alike(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose longer signatures differ little enough."""
    errors = permitted(percent)[1]
    left = nodes.select(F.col("node").alias("a"), F.col("checks").alias("x"))
    right = nodes.select(F.col("node").alias("b"), F.col("checks").alias("y"))

    def run(batches):
        for batch in batches:
            x, y = (_all_bytes(batch.column(c)).reshape(-1, CHECKS) for c in ("x", "y"))
            near = (x != y).sum(1) <= errors
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, pairs.schema)


def _all_bytes(column: pa.Array) -> np.ndarray:
    """All bytes of a binary column without nulls."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8)


def _enough_left(percent: int) -> Callable[[Column, Column], Column]:
    """Whether two sets can be similar whose first common shingle, in the order of rarity, this is."""

    def admit(a: Column, b: Column) -> Column:
        common = F.least(a["size"] - a["place"], b["size"] - b["place"])
        return 100 * common >= percent * (a["size"] + b["size"] - common)

    return admit


def _rare_shingles(sets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``(key, node, about)`` of each set's rarest shingles, as many as two similar sets must overlap in;
    ``about`` has the place of the shingle in the set's order and the set's size.

    Any one order of all shingles is right; frequencies, counted into a table of fixed size, make
    it one that puts the shingles of frequent passages last.
    """
    wanted = materialise(sets.join(nodes, "node", "left_semi"), "apart-sets")

    def count(batches):
        table = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            table += np.bincount(_slots(_all_bytes(batch.column("shingles")).view(np.uint64)), minlength=COUNTERS)
        used = np.flatnonzero(table)
        for at in range(0, len(used), 100_000):
            some = used[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(table[some])], ["slot", "n"])

    counted = wanted.select("shingles").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    table = np.zeros(COUNTERS, np.int64)
    table[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    shared = sets.sparkSession.sparkContext.broadcast(table)

    def choose(batches):
        table = shared.value
        for batch in batches:
            keys, owners, places, sizes = [], [], [], []
            for node, packed in zip(batch.column("node").to_pylist(), batch.column("shingles").to_pylist()):
                shingles = np.frombuffer(packed, np.uint64)
                order = np.lexsort((shingles, table[_slots(shingles)]))
                keys.append(shingles[order[: len(shingles) + (-percent * len(shingles)) // 100 + 1]].view(np.int64))
                owners += [node] * len(keys[-1])
                places.append(np.arange(len(keys[-1])))
                sizes.append(np.full(len(keys[-1]), len(shingles)))
            if keys:
                about = [pa.array(np.concatenate(c), pa.int64()) for c in (places, sizes)]
                columns = [pa.array(np.concatenate(keys)), pa.array(owners, pa.binary()), pa.StructArray.from_arrays(about, ["place", "size"])]
                yield pa.RecordBatch.from_arrays(columns, ["key", "node", "about"])

    return wanted.mapInArrow(choose, "key long, node binary, about struct<place: long, size: long>")


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(COUNTERS - 1)).astype(np.int64)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                y = np.frombuffer(y.as_buffer(), np.uint64)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                if 100 * len(small) < percent * len(large):
                    keep.append(False)
                    continue
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, pairs.schema)


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85
) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_shingles``, ``component_id`` and ``kept``.

    Texts are linked if their 5-word shingle sets (of texts with A-Z lower-cased) are similar by
    ``percent`` or more; ``component_id`` is the smallest id reachable over links, ``kept`` says
    that it is the row's own id. Null and empty texts have no shingles and are linked with nothing.
    Repeated rows stay, each with the same result. A row with a null id can link others but is
    never a component's name; it is kept only if no id is reachable. Other columns are not used.
    """
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"))
    described = materialise(describe(rows, percent=percent).drop("text"), "described")
    return _label(rows, described, percent).select(
        F.col("_id").alias(doc_id),
        "n_shingles",
        F.col("name").alias("component_id"),
        F.col("_id").eqNullSafe(F.col("name")).alias("kept"),
    )


def _label(rows: DataFrame, described: DataFrame, percent: int) -> DataFrame:
    """``described`` plus ``name``, the smallest id of each row's component."""
    nodes = (
        described.filter("set_key is not null")
        .groupBy(F.col("set_key").alias("node"))
        .agg(F.min("_id").alias("least"), F.first("index_keys").alias("index_keys"), F.first("checks").alias("checks"))
    )
    nodes = materialise(nodes, "nodes")
    shared = shared_groups(nodes.select("node", F.explode("index_keys").alias("key")))
    # Texts are fetched by id, once for each set; an id that has several texts fetches them all.
    wanted = materialise(nodes.select("node", "least", "checks").join(shared, "node", "left_semi"), "wanted")
    discard(nodes)
    ids = materialise(wanted.select(F.col("least").alias("_wanted")).distinct(), "wanted-ids")
    some = _maybe_in(rows, "_id", ids, "_wanted")
    texts = some.join(ids, F.col("_id").eqNullSafe(F.col("_wanted")), "left_semi").select("text")
    sets = _add_sets(texts).drop("text").join(wanted, "node", "left_semi").dropDuplicates(["node"])
    sets = materialise(sets, "sets")
    labels = link(
        shared,
        lambda pairs: _confirm(materialise(_alike(pairs, wanted, percent), "alike"), sets, percent),
        lambda nodes: _rare_shingles(sets, nodes, percent),
        _enough_left(percent),
    )
    placed = described.drop("index_keys", "checks").withColumnRenamed("set_key", "node").join(labels, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    names = placed.filter("node is not null").groupBy("component").agg(F.min("_id").alias("name"))
    return placed.join(names, "component", "left").withColumn("name", F.coalesce("name", "_id"))


def _maybe_in(rows: DataFrame, column: str, ids: DataFrame, wanted: str) -> DataFrame:
    """``rows`` without most of those whose ``column`` is not among ``ids``: what meets them by id then
    hardly shuffles other texts. The ids' bits are broadcast, a fixed number of them."""

    def place(c: str) -> tuple[Column, Column]:
        slot = F.pmod(F.xxhash64(c), F.lit(ID_BITS))
        return F.shiftright(slot, 15).alias("bucket"), slot.bitwiseAND(32767).alias("bit")

    bits = ids.select(*place(wanted)).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    bits = F.broadcast(materialise(bits, "id-bits"))
    bucket, bit = place(column)
    byte = F.conv(F.hex(F.substring("bits", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, bit.bitwiseAND(7).cast("int")) == 1
    return rows.join(bits, bucket == F.col("bucket")).filter(is_set).select(*rows.columns)


def deduplicate(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85
) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one with the smallest id.

    Of repeated rows with that id and one and the same text, one stays; so does the row with the
    smallest text digest where one id has several texts of a group. Rows without a shingle all stay.
    """
    key = F.md5(F.concat_ws(":", F.coalesce(F.md5(F.col(text).cast("binary")), F.lit("-")), F.col(doc_id).cast("string")))
    row = fresh("_row", docs)
    marked = docs.withColumn(row, key)
    rows = marked.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"), F.col(row).alias("_row"))
    described = materialise(describe(rows, percent=percent).drop("text"), "described")
    placed = _label(rows.drop("_row"), described, percent).filter("node is not null")
    chosen = placed.groupBy("component").agg(F.min_by("_row", F.struct(F.col("_id").isNull(), "_id", "_row")).alias("_row"))
    empty = described.filter("set_key is null").select(F.col("_row").alias(row))
    one = marked.join(chosen.withColumnRenamed("_row", row), row, "left_semi").dropDuplicates([row])
    return one.unionByName(marked.join(empty, row, "left_semi")).drop(row)
