"""Near-duplicate embeddings by spherical-cap filters.

A filter is a direction; its cap holds the vectors that lean towards it. The directions are a random
product code: a vector is cut into two halves, each half has a code of ``width`` random unit
vectors, and each pair of codewords is one direction, so width**2 directions cost 2 * width products.
Each vector is decoded to the list of all directions whose product with it is within a margin of its
best one: the codewords of the first half that can still reach that, each with those of the second that do.
Two unit vectors at distance d differ in their product with a direction by a normal deviate of about
d / sqrt(dimensions), and by d at most; the margin is ``DEVIATIONS`` of the one, or twice the other if that is less, which
misses nothing. In few dimensions many directions lie close, so the code is narrowed until lists are of about
``LIST_FILTERS``. Vectors to be linked share many filters; the tests and README have the measured recall.

Vectors of equal label meet in every filter that both have; their cosine is computed there in double
precision, and a pair counts in the lowest filter that the two share, so once. Equal vectors
are one vector with a number of copies throughout. The codes grow with the number of
vectors so that a filter's list stays short, and a list that is long all the same (many near copies)
is dealt to pairs of blocks. No pair is ever a row: a group gives each vector's number of links, and edges that span
what it links.

A vector that is null, zero, or holds a null or a value that is not finite links with nothing, and so does one
whose label is null: 0 links, a component of its own, kept. Vectors of different
lengths never link. Null ids: their rows are kept, count as links of others, and have the component of their
copies, null if no copy has an id. An empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import dealt_and_sorted, groups, in_block_pairs, snapshot
from quayside.llm.components import components

LEAST_COSINE = 0.98
DEVIATIONS = 2.4
#: Filters of a vector, about, at most.
LIST_FILTERS = 32
#: Vectors that a filter's list holds on average, about; and the most of a block.
LIST_ROWS = 64
BLOCK_ROWS = 8192
#: Vectors of a block compared with the others at a time.
_CHUNK = 64
SEED = 20240229
#: Vectors without an id are known by a hash from here on, above all ids, while links are followed.
_UNNAMED = 1 << 62


def code_width(vectors: int) -> int:
    """Codewords of a half: so many that width**2 filters, of which a vector is in about 20, are enough.

    Filters are numbered in 32 bits; the width that this allows is enough for 6.8 billion different vectors.
    """
    return max(16, min(46_340, math.ceil(math.sqrt(20 * vectors / LIST_ROWS))))


def margin_of(dimensions: int, least_cosine: float = LEAST_COSINE) -> float:
    distance = math.sqrt(max(0.0, 2 - 2 * least_cosine))
    return min(2 * distance, DEVIATIONS * distance / math.sqrt(dimensions))


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; first by a power of two, which is exact, so that no square overflows."""
    rows = rows.astype(np.float64)
    _, power = np.frexp(np.abs(rows).max(axis=1, keepdims=True))
    rows = np.ldexp(rows, -power)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def codes(dimensions: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two codes of unit vectors, the same wherever they are drawn."""
    random = np.random.default_rng([SEED, dimensions, width])
    half = dimensions - dimensions // 2
    first, second = random.standard_normal((width, half)), random.standard_normal((width, dimensions - half))
    scale = lambda code: code / np.maximum(np.linalg.norm(code, axis=1, keepdims=True), 1e-12)
    return scale(first), scale(second)


@cache
def codes_for(dimensions: int, width: int, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """The codes of at most so many codewords whose lists are of about LIST_FILTERS, the same wherever they are drawn."""
    probes = unit_rows(np.random.default_rng([SEED, dimensions]).standard_normal((64, dimensions)))
    while True:
        drawn = codes(dimensions, width)
        if width <= 2 or np.mean([len(decode(p, *drawn, margin)) for p in probes]) <= LIST_FILTERS:
            return drawn
        width = max(2, width // 2)


def decode(vector: np.ndarray, first: np.ndarray, second: np.ndarray, margin: float) -> np.ndarray:
    """The filters of a unit vector, ascending: all pairs of codewords within the margin of the best pair."""
    half = first.shape[1]
    left, right = first @ vector[:half] / math.sqrt(2), second @ vector[half:] / math.sqrt(2)
    least = left.max() + right.max() - margin
    order = np.argsort(-right, kind="stable")
    ordered = -right[order]
    able = np.flatnonzero(left + right.max() >= least)
    reach = np.searchsorted(ordered, left[able] - least, side="right")
    found = np.concatenate([k * len(second) + order[:n] for k, n in zip(able, reach)])
    return np.sort(found)


def _filters(vectors: DataFrame, width: int, least_cosine: float, margin: float | None) -> DataFrame:
    """``vectors`` with a list of filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = []
            for vector in batch.column("vector"):
                unit = unit_rows(vector.values.to_numpy()[None, :])[0]
                near = margin_of(len(unit), least_cosine) if margin is None else margin
                lists.append(decode(unit, *codes_for(len(unit), width, near), near))
            columns = [batch.column(n) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(lists, pa.list_(pa.int32()))], [*batch.schema.names, "filters"]
            )

    schema = vectors.select("*", F.array().cast("array<int>").alias("filters")).schema
    return vectors.mapInArrow(run, schema)


def _verify(batches: Iterator[pa.RecordBatch], least_cosine: float) -> Iterator[pa.RecordBatch]:
    """Rows (node, links, other): links to add to a vector, or an edge to another one."""
    for group in groups(batches, ["label", "filter", "block_a", "block_b"]):
        nodes, copies = group.column("node").to_numpy(), group.column("copies").to_numpy()
        own, first = group.column("own").to_numpy(), group.column("block_a")[0].as_py()
        here = group.column("filter")[0].as_py()
        alone = first == group.column("block_b")[0].as_py()
        vectors, lists = _Lists(group.column("vector")), _Lists(group.column("filters"))
        links, edges, label = np.zeros(len(nodes), np.int64), [], np.arange(len(nodes))
        for length in np.unique(vectors.sizes[vectors.sizes > 0]).tolist():
            rows = np.flatnonzero(vectors.sizes == length)
            units = unit_rows(vectors.rows(rows).reshape(-1, length))
            left = np.arange(len(rows)) if alone else np.flatnonzero(own[rows] == first)
            right = left if alone else np.flatnonzero(own[rows] != first)
            for k in range(0, len(left), _CHUNK):
                part = left[k : k + _CHUNK]
                close = units[part] @ units[right].T >= least_cosine
                if alone:
                    close[np.arange(len(part)), np.arange(k, k + len(part))] = False
                a, b = close.any(axis=1), close.any(axis=0)
                if not a.any():
                    continue
                close, from_rows, to_rows = close[np.ix_(a, b)], rows[part[a]], rows[right[b]]
                counted = close & ~_share_before(lists, from_rows, to_rows, here)
                links[from_rows] += counted @ copies[to_rows]
                if not alone:
                    links[to_rows] += counted.T @ copies[from_rows]
                for row, near in zip(from_rows.tolist(), close):
                    _span(row, to_rows[near], label, edges)
        used = np.flatnonzero(links)
        found = [(int(nodes[k]), int(links[k]), None) for k in used]
        found += [(int(nodes[a]), None, int(nodes[b])) for a, b in edges]
        if found:
            columns = [pa.array(x, pa.int64()) for x in zip(*found)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "links", "other"])


class _Lists:
    """A column of lists as flat values and sizes."""

    def __init__(self, column: pa.ChunkedArray):
        whole = column.combine_chunks()
        self.flat = whole.flatten().to_numpy()
        self.sizes = whole.value_lengths().to_numpy().astype(np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes

    def rows(self, rows: np.ndarray) -> np.ndarray:
        """The values of some rows, one after another."""
        sizes = self.sizes[rows]
        shift = np.repeat(self.begins[rows] - (np.cumsum(sizes) - sizes), sizes)
        return self.flat[np.arange(len(shift)) + shift]


def _share_before(lists: _Lists, left: np.ndarray, right: np.ndarray, here: int) -> np.ndarray:
    """Which pairs of rows have a filter lower than ``here`` in common, so were counted there."""
    flat = lists.rows(left)
    columns = np.unique(flat[flat < here])
    if not len(columns):
        return np.zeros((len(left), len(right)), dtype=bool)

    def members(rows: np.ndarray) -> np.ndarray:
        values, owner = lists.rows(rows), np.repeat(np.arange(len(rows)), lists.sizes[rows])
        at = np.minimum(np.searchsorted(columns, values), len(columns) - 1)
        kept = columns[at] == values
        matrix = np.zeros((len(rows), len(columns)), dtype=np.float32)
        matrix[owner[kept], at[kept]] = 1
        return matrix

    return members(left) @ members(right).T > 0


def _span(row: int, near: np.ndarray, label: np.ndarray, edges: list[tuple[int, int]]) -> None:
    """Join a row with its neighbours, keeping an edge for each set that was apart."""
    sets, places = np.unique(label[near], return_index=True)
    apart = sets != label[row]
    if apart.any():
        edges.extend((row, int(near[k])) for k in places[apart])
        label[np.isin(label, sets)] = label[row]


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    least_cosine: float = LEAST_COSINE,
    margin: float | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(id, links, component) for every row: links to other rows, and the smallest id reachable by them.

    Without a ``margin`` it goes with the dimension and the least cosine.
    """
    floats = vectors.schema[vector_col].dataType.simpleString() == "array<float>"  # as narrow as they come
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<float>" if floats else "array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    able = F.col("label").isNotNull() & F.coalesce(finite & some, F.lit(False))
    # an equal vector has an equal key; groups are of the vector itself
    rows = snapshot(rows.select("id", "label", F.when(able, F.col("vector")).alias("vector")), "vectors")
    linked = rows.where("vector is not null")
    distinct = linked.groupBy("label", "vector").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    unnamed = F.shiftrightunsigned(F.xxhash64("label", "vector"), 2) + F.lit(_UNNAMED)
    distinct = snapshot(distinct, "distinct").withColumn("node", F.coalesce("first", unnamed))
    width = code_width(distinct.count())
    listed = _filters(distinct.select("node", "copies", "label", "vector"), width, least_cosine, margin)
    met = snapshot(listed, "filters").select("*", F.explode("filters").alias("filter"))
    dealt = dealt_and_sorted(in_block_pairs(met, ["label", "filter"], "node", block_rows), "label", "filter", "block_a", "block_b")
    found = dealt.mapInArrow(lambda batches: _verify(batches, least_cosine), "node long, links long, other long")
    found = snapshot(found, "found")
    counts = found.where("links is not null").groupBy("node").agg(F.sum("links").alias("others"))
    joined = components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    known = distinct.join(counts, "node", "left").join(joined, "node", "left").select(
        "label",
        "vector",
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.when(F.coalesce("component", "node") < _UNNAMED, F.coalesce("component", "node")).alias("component"),
    )
    known = snapshot(known, "known").withColumnsRenamed({"label": "_label", "vector": "_vector"})
    same = (F.col("label") == F.col("_label")) & (F.col("vector") == F.col("_vector"))
    return rows.join(known, same, "left").select(
        "id", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "id").alias("component")
    )
