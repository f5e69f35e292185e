"""SimHash fingerprints and their near duplicates, found with BK-trees.

A fingerprint has a bit where more than half of the shingle hashes have it. Two fingerprints
link if they differ in at most ``radius`` bits. Fingerprints are cut into ``radius + 2`` blocks;
two that link agree in two blocks at least, so each fingerprint is sent to one shard for every
pair of its blocks. A shard holds a BK-tree: a node's children are keyed by their Hamming
distance to it, and a query at distance d from a node follows only the edges from d - radius
to d + radius. A shard of more than ``SHARD_ROWS`` fingerprints becomes several trees, and
each tree is sent to all tasks with queries for that shard; so what is sent is bounded, and no
fingerprint meets trees that cannot hold a partner.

Fingerprints are the nodes, not ids: texts that share an id, or have none, link on their own account.
Null, empty and blank texts have fingerprint 0 and link like any other. Rows with a null id keep
their row; an id that repeats has a row for each of its rows. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import Forest, dealt_and_sorted, free_name, freeing, groups, in_block_pairs, snapshot, texts
from quayside.llm.components import components

SEED = 42
SHINGLE_WORDS = 3
RADIUS = 2
#: Fingerprints of one tree.
SHARD_ROWS = 2048
#: Shingles whose bits are counted at a time.
_BITS_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    width = min(shingle_words, len(words))
    starts = (ends - lengths)[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    view = memoryview(line)
    hashes = [digest(view[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())]
    packed = np.array(hashes, dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(packed), _BITS_AT_ONCE):
        part = packed[k : k + _BITS_AT_ONCE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(packed), bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str, text_col: str, shingle_words: int = SHINGLE_WORDS, marked: bool = False
) -> DataFrame:
    """(id, fp) for every row; fp is the fingerprint's 64 bits as a long. If marked, also mark, which tells texts apart."""
    kept = ["id", "mark"] if marked else ["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle_words) for t in batch.column("text")]
            fp = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), fp], [*kept, "fp"])

    rows = texts(docs, id_col, text_col)
    if not marked:
        return rows.mapInArrow(freeing(run), "id long, fp long")
    return rows.withColumn("mark", _mark(F.col("text"))).mapInArrow(freeing(run), "id long, mark string, fp long")


def _mark(text: Column) -> Column:
    return F.sha2(text.cast("string"), 256)


class BKTree:
    """Distinct 64-bit integers; the children of a node are keyed by their distance to it."""

    def __init__(self, values: list[int]):
        self.values = values
        self.children: list[dict[int, int]] = [{} for _ in values]
        for k in range(1, len(values)):
            self._insert(k)

    def _insert(self, new: int) -> None:
        value, at = self.values[new], 0
        while True:
            distance = (self.values[at] ^ value).bit_count()
            below = self.children[at].setdefault(distance, new)
            if below == new:
                return
            at = below

    def near(self, query: int, radius: int) -> Iterator[int]:
        """Positions of the values within the radius of a query."""
        open_nodes = [0] if self.values else []
        while open_nodes:
            at = open_nodes.pop()
            distance = (self.values[at] ^ query).bit_count()
            if distance <= radius:
                yield at
            edges = self.children[at]
            if len(edges) > 2 * radius + 1:
                open_nodes.extend(edges[d] for d in range(distance - radius, distance + radius + 1) if d in edges)
            else:
                open_nodes.extend(n for d, n in edges.items() if abs(d - distance) <= radius)


def _shard_keys(fp: Column, radius: int) -> Column:
    """One long for each pair of the radius + 2 blocks: the two blocks' bits and which pair it is."""
    edges = [round(k * 64 / (radius + 2)) for k in range(radius + 3)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    keys = []
    for n, (a, b) in enumerate(combinations(masks, 2)):
        mask = np.array(a | b, dtype=np.uint64).view(np.int64).item()
        keys.append(F.xxhash64(F.lit(n), fp.bitwiseAND(F.lit(mask))))
    return F.array(*keys)


def _links_of_shards(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Edges that span what each group of shard tree and queries links."""
    found: list[tuple[int, int]] = []
    for shard in groups(batches, ["shard", "block_a", "block_b"]):
        values = shard.column("fp").to_numpy().view(np.uint64).tolist()
        nodes = shard.column("node").to_pylist()
        own, first = shard.column("own").to_numpy(), shard.column("block_a")[0].as_py()
        alone = first == shard.column("block_b")[0].as_py()
        in_tree = np.arange(len(values)) if alone else np.flatnonzero(own == first)
        asking = in_tree if alone else np.flatnonzero(own != first)
        tree, forest = BKTree([values[k] for k in in_tree]), Forest(len(values))
        for q in asking.tolist():
            for hit in tree.near(values[q], radius):
                k = int(in_tree[hit])
                if k != q and forest.join(k, q):
                    found.append((nodes[k], nodes[q]))
        if len(found) > 50_000:
            yield _edges(found)
            found = []
    yield _edges(found)


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def links(prints: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges (a, b) between nodes that span all links; prints: distinct fp with one node each."""
    rows = prints.select(F.explode(_shard_keys(F.col("fp"), radius)).alias("shard"), "fp", "node")
    dealt = in_block_pairs(rows, ["shard"], "fp", shard_rows)
    dealt = dealt_and_sorted(dealt, "shard", "block_a", "block_b")
    return dealt.mapInArrow(partial(_links_of_shards, radius=radius), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(id, fp, component) for every row; component is the smallest id reachable by links.

    Copies collapse to their fingerprint before anything is compared. The component of fingerprints whose rows
    all have a null id is null.
    """
    prints = snapshot(fingerprints(docs, id_col, text_col, shingle_words), "prints")
    return prints.join(_named(prints, radius, shard_rows), "fp", "left").select("id", "fp", "component")


def _named(prints: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(fp, root, component) for every distinct fp: one fingerprint of its group, and the group's smallest id."""
    distinct = snapshot(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    found = components(links(distinct.select("fp", F.col("fp").alias("node")), radius, shard_rows))
    found = found.select(F.col("node").alias("fp"), F.col("component").alias("_root"))
    rooted = distinct.join(found, "fp", "left").select("fp", "least", F.coalesce("_root", "fp").alias("root"))
    rooted = snapshot(rooted, "rooted")
    least = snapshot(rooted.groupBy("root").agg(F.min("least").alias("component")), "least")
    return snapshot(rooted.join(least, "root").select("fp", "root", "component"), "named")


def one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row of ``docs`` of each group of near duplicates, that with the smallest id, columns unchanged.

    Rows are told apart by id and text together, so that different texts of one id are decided apart. A row with a
    null id stays only if no row of its group has an id; of such rows, and of those equal in id and text, one
    stays. A row with neither an id nor a text (null, not empty) is no copy of anything, and stays.
    """
    prints = snapshot(fingerprints(docs, id_col, text_col, shingle_words, marked=True), "prints")
    known = prints.where("id is not null or mark is not null")
    keys = known.groupBy("id", "mark", "fp").agg(F.count("*").alias("rows"))
    named = _named(prints, radius, shard_rows).select("fp", "root")
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "mark", "rows")).alias("k")
    kept = snapshot(keys.join(named, "fp").groupBy("root").agg(first), "kept")
    own_id, own_text, kept_id, kept_text, times = (free_name(docs, n) for n in ("_id", "_text", "_kept", "_mark", "_rows"))
    kept = kept.select(F.col("k.id").alias(kept_id), F.col("k.mark").alias(kept_text), F.col("k.rows").alias(times))
    own = docs.withColumns({own_id: F.col(id_col).cast("long"), own_text: _mark(F.col(text_col))})
    same = F.col(own_id).eqNullSafe(F.col(kept_id)) & F.col(own_text).eqNullSafe(F.col(kept_text))
    rows = own.join(kept, same, "left")
    alone = (F.col(times) == 1) | (F.col(own_id).isNull() & F.col(own_text).isNull())
    once = rows.where(alone).select(*docs.columns)
    again = rows.where(F.col(times) > 1).dropDuplicates([own_id, own_text]).select(*docs.columns)
    return once.unionByName(again)
