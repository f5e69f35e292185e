"""A distributed positional inverted index, and exact phrase and proximity search in it.

The index is a table of segments. A segment holds about ``SEGMENT_WORDS`` words of whole documents:
its terms, and for each term the places where it stands, counted through the segment with a gap
after every document, so that no phrase runs from one into the next. Segments are built where the documents
are read and searched where they are stored: building and searching shuffle nothing, however often a
document, a term or a phrase repeats. A document is never cut; one of more words is a segment of its own.

A search takes a stated set of phrases to every segment; a set of any size is a table of windows, which goes there
in blocks of ``BLOCK_WINDOWS``, and what the blocks hit is merged by document. For each phrase it starts from the term that is
rarest in the segment and intersects the lists of the others, each shifted by its offset in the phrase; a
phrase with a term that the segment lacks ends there. Only the lists of the phrases' terms are unpacked.

A null or empty text has no words and is found by nothing. Ids may be null or repeat: each row is a document of
its own. An empty table gives an empty index. Phrases without words match nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import freeing, small_batches, snapshot, texts
from quayside.session import new_folder, written

SEGMENT_WORDS = 1 << 18
#: Places left free after each document, so also the longest phrase that can be asked for.
GAP = 1 << 12
#: Windows that are looked for together, and their bytes: what the driver and each Python worker hold of a table of them.
BLOCK_WINDOWS = 1 << 17
BLOCK_BYTES = 16 << 20
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

SEGMENT = "segment long, ids binary, marks binary, sizes binary, terms binary, counts binary, places binary"


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters (lower-cased), digits and all characters beyond ASCII."""
    return (text or "").encode().translate(_LETTERS).split()


def _pack(values: np.ndarray | bytes) -> bytes:
    raw = values if isinstance(values, bytes) else np.ascontiguousarray(values).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(packed: bytes, dtype=None):
    raw = zstandard.ZstdDecompressor().decompress(packed)
    return raw if dtype is None else np.frombuffer(raw, dtype)


class _Builder:
    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.stream: list[np.ndarray] = []
        self.ids: list[int | None] = []
        self.marks: list[int] = []
        self.sizes: list[int] = []
        self.words = 0

    def add(self, doc_id: int | None, mark: int, words: list[bytes]) -> None:
        number = self.numbers.setdefault
        self.stream.append(np.fromiter((number(w, len(self.numbers)) for w in words), np.int32, len(words)))
        self.ids.append(doc_id)
        self.marks.append(mark)
        self.sizes.append(len(words))
        self.words += len(words)

    def row(self) -> tuple[bytes, ...]:
        numbers = np.concatenate(self.stream)
        sizes = np.array(self.sizes, dtype=np.int64)
        places = np.arange(len(numbers)) + np.repeat(np.arange(len(sizes)) * GAP, sizes)
        order = np.argsort(numbers, kind="stable")
        counts = np.bincount(numbers, minlength=len(self.numbers))
        ordered = places[order]
        steps = np.diff(ordered, prepend=0)
        first = np.cumsum(counts) - counts
        steps[first[counts > 0]] = ordered[first[counts > 0]]  # each list starts anew
        known = np.array([i is not None for i in self.ids])
        ids = np.array([i or 0 for i in self.ids], dtype=np.int64)
        return (
            _pack(np.concatenate([known.astype(np.int64), ids])),
            _pack(np.array(self.marks, dtype=np.int64)),
            _pack(sizes),
            _pack(b"\n".join(self.numbers)),
            _pack(counts.astype(np.int32)),
            _pack(steps.astype(np.uint32)),
        )


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The index of all documents: one row for each segment, in the columns of SEGMENT; a document's mark is its text's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        building = _Builder()
        for batch in batches:
            for doc_id, mark, text in zip(batch.column("id").to_pylist(), batch.column("mark").to_pylist(), batch.column("text")):
                words = words_of(text.as_py())
                if building.words and building.words + len(words) > segment_words or len(building.ids) >= segment_words // 4:
                    yield _segment(building, number)
                    number, building = number + 1, _Builder()
                building.add(doc_id, mark, words)
        if building.ids:
            yield _segment(building, number)

    return texts(docs, id_col, text_col).withColumn("mark", F.xxhash64("text")).mapInArrow(freeing(run), SEGMENT)


def _segment(building: _Builder, number: int) -> pa.RecordBatch:
    names = [field.split()[0] for field in SEGMENT.split(", ")]
    packed = [pa.array([x], pa.binary()) for x in building.row()]
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *packed], names)


class Segment:
    """One segment, with the lists of the wanted terms unpacked."""

    def __init__(self, row: dict, wanted: dict[bytes, int]):
        self.number = row["segment"]
        self.marks = _unpack(row["marks"], np.int64)
        known, ids = _unpack(row["ids"], np.int64).reshape(2, -1)
        self.ids = [int(i) if k else None for i, k in zip(ids, known)]
        self.sizes = _unpack(row["sizes"], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes + np.arange(len(self.sizes)) * GAP
        raw = _unpack(row["terms"])
        counts = _unpack(row["counts"], np.int32).astype(np.int64)
        ends = np.cumsum(counts)
        steps = _unpack(row["places"], np.uint32)
        self.places: dict[int, np.ndarray] = {}
        if raw:
            for k, term in enumerate(raw.split(b"\n")):
                if (number := wanted.get(term)) is not None:
                    self.places[number] = np.cumsum(steps[ends[k] - counts[k] : ends[k]].astype(np.int64))

    def phrase(self, terms: tuple[int, ...]) -> np.ndarray:
        """The places where a phrase begins."""
        lists = [self.places.get(t) for t in terms]
        if any(x is None for x in lists):
            return _NONE
        found: np.ndarray | None = None
        for offset in sorted(range(len(terms)), key=lambda k: len(lists[k])):
            shifted = lists[offset] - offset
            found = shifted if found is None else found[_among(found, shifted)]
            if not len(found):
                return _NONE
        return found

    def near(self, terms: tuple[int, ...], span: int) -> np.ndarray:
        """Places of the rarest term with all the others at most ``span`` words from it, in any order."""
        lists = [self.places.get(t) for t in set(terms)]
        if any(x is None for x in lists):
            return _NONE
        lists.sort(key=len)
        found = lists[0]
        for other in lists[1:]:
            after = np.searchsorted(other, found)
            left = other[np.maximum(after - 1, 0)]
            right = other[np.minimum(after, len(other) - 1)]
            found = found[np.minimum(np.abs(found - left), np.abs(right - found)) <= span]
            if not len(found):
                break
        return found

    def documents(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, side="right") - 1


_NONE = np.empty(0, dtype=np.int64)


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


@dataclass(frozen=True)
class Phrases:
    """The stated phrases: their terms as numbers, and the items that each belongs to."""

    terms: dict[bytes, int]
    items: list[str | None]
    of: dict[tuple[int, ...], list[int]]

    def possible(self, held: Iterable[int]) -> Iterator[tuple[tuple[int, ...], list[int]]]:
        """The phrases of which every term is held; only these can be found."""
        if not hasattr(self, "_table"):  # made once in each worker; a term's number past the last stands for no more words
            every, width = list(self.of.items()), max(map(len, self.of), default=0)
            padded = [(*terms, *[len(self.terms)] * (width - len(terms))) for terms, _ in every]
            object.__setattr__(self, "_table", (every, np.array(padded, dtype=np.int64).reshape(len(every), width)))
        every, table = self._table
        there = np.zeros(len(self.terms) + 1, dtype=bool)
        there[[*held, len(self.terms)]] = True
        for k in np.flatnonzero(there[table].all(axis=1)).tolist():
            yield every[k]


def phrases_of(items: list[tuple[str, str | None]], width: int) -> Phrases:
    """Every run of ``width`` words of each item; an item of fewer words is one phrase, one of none is none."""
    if width > GAP:
        raise ValueError(f"phrases of more than {GAP} words cannot be asked for")
    terms: dict[bytes, int] = {}
    of: dict[tuple[int, ...], list[int]] = defaultdict(list)
    for k, (_, text) in enumerate(items):
        numbers = [terms.setdefault(w, len(terms)) for w in words_of(text)]
        for window in {tuple(numbers[i : i + width]) for i in range(max(1, len(numbers) - width + 1))}:
            if window:
                of[window].append(k)
    return Phrases(terms, [name for name, _ in items], dict(of))


def search(index: DataFrame, phrases: Phrases, span: int | None = None) -> DataFrame:
    """(id, mark, n_words, n_hit, items, near_items) for every document of the index.

    n_hit counts the words inside any occurrence of a phrase, items lists (sorted, once each) the items of
    the phrases that occur. With a ``span``, near_items lists the items of which a phrase's terms all
    stand within that many words of its rarest one; else it is null.
    """
    _check_span(span)
    shared = index.sparkSession.sparkContext.broadcast(phrases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _search_segment(Segment(row, shared.value.terms), shared.value, span)

    return index.mapInArrow(freeing(run), FOUND)


def _check_span(span: int | None) -> None:
    if span is not None and not 0 <= span < GAP:
        raise ValueError(f"words can be looked for within less than {GAP} words of each other")


FOUND = "id long, mark long, n_words long, n_hit long, items array<string>, near_items array<string>"
_HIT = "segment long, doc long, ranges array<struct<begin:long,end:long>>, items array<string>, near_items array<string>"


def _hits(
    segment: Segment, phrases: Phrases, span: int | None
) -> tuple[np.ndarray, np.ndarray, dict[int, set[int]], dict[int, set[int]]]:
    """Begins and ends of all occurrences, by begin, and the items found in each document, exactly and nearly."""
    exact: dict[int, set[int]] = defaultdict(set)
    near: dict[int, set[int]] = defaultdict(set)
    begins, ends = [_NONE], [_NONE]
    for terms, items in phrases.possible(segment.places):
        found = segment.phrase(terms)
        if len(found):
            begins.append(found)
            ends.append(found + len(terms))
            for doc in np.unique(segment.documents(found)).tolist():
                exact[doc].update(items)
        if span is not None:
            for doc in np.unique(segment.documents(segment.near(terms, span))).tolist():
                near[doc].update(items)
    begin, end = np.concatenate(begins), np.concatenate(ends)
    order = np.argsort(begin, kind="stable")
    return begin[order], np.maximum.accumulate(end[order]), exact, near


def _names(phrases: Phrases, of: dict[int, set[int]], doc: int) -> list[str]:
    return sorted({phrases.items[k] for k in of[doc]} - {None}) if doc in of else []


def _search_segment(segment: Segment, phrases: Phrases, span: int | None) -> pa.RecordBatch:
    begin, end, exact, near = _hits(segment, phrases, span)
    hits = np.zeros(len(segment.ids), dtype=np.int64)
    fresh = np.maximum(begin, np.concatenate([[0], end])[: len(end)])  # counted up to here by those before
    np.add.at(hits, segment.documents(begin), np.maximum(0, end - fresh))
    every = range(len(segment.ids))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(segment.ids, pa.int64()),
            pa.array(segment.marks),
            pa.array(segment.sizes),
            pa.array(hits),
            pa.array([_names(phrases, exact, d) for d in every], pa.list_(pa.string())),
            pa.array([None if span is None else _names(phrases, near, d) for d in every], pa.list_(pa.string())),
        ],
        ["id", "mark", "n_words", "n_hit", "items", "near_items"],
    )


def _hits_of_segment(segment: Segment, phrases: Phrases, span: int | None) -> pa.RecordBatch:
    """What a part of the phrases hits: a row for each document with a hit, in the columns of _HIT."""
    begin, end, exact, near = _hits(segment, phrases, span)
    apart = np.flatnonzero(np.concatenate([[True], begin[1:] > end[:-1]])) if len(begin) else _NONE
    begin, end = begin[apart], end[np.concatenate([apart[1:] - 1, [len(end) - 1]])] if len(end) else end
    ranges: dict[int, list[dict[str, int]]] = defaultdict(list)
    for doc, a, b in zip(segment.documents(begin).tolist(), begin.tolist(), end.tolist()):
        ranges[doc].append({"begin": a, "end": b})
    docs = sorted({*ranges, *near})
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([segment.number] * len(docs), pa.int64()),
            pa.array(docs, pa.int64()),
            pa.array([ranges.get(d, []) for d in docs], kind),
            pa.array([_names(phrases, exact, d) for d in docs], pa.list_(pa.string())),
            pa.array([_names(phrases, near, d) for d in docs], pa.list_(pa.string())),
        ],
        ["segment", "doc", "ranges", "items", "near_items"],
    )


def windows(items: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(window, item), once each, for a table of items of any size; a window is its words with spaces between.

    As in phrases_of, but an item with a null id has windows too: they count as hits and name no item.
    """
    if width > GAP:
        raise ValueError(f"phrases of more than {GAP} words cannot be asked for")
    small_batches(items.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item"), batch.column("text")):
                words = words_of(text.as_py())
                count = max(1, len(words) - width + 1) if words else 0
                for at in range(0, count, 10_000):
                    found = {b" ".join(words[k : k + width]) for k in range(at, min(at + 10_000, count))}
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found, pa.binary()), pa.array([item.as_py()] * len(found), pa.string())], ["window", "item"]
                    )

    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "window binary, item string").distinct()


def _phrases_of_windows(rows: list) -> Phrases:
    terms: dict[bytes, int] = {}
    names: dict[str | None, int] = {}
    of: dict[tuple[int, ...], list[int]] = defaultdict(list)
    for window, item in rows:
        numbers = tuple(terms.setdefault(w, len(terms)) for w in bytes(window).split(b" "))
        of[numbers].append(names.setdefault(item, len(names)))
    return Phrases(terms, list(names), dict(of))


def search_windows(
    index: DataFrame, asked: DataFrame, span: int | None = None, block_windows: int = BLOCK_WINDOWS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """As search(), for a table of ``windows`` of any size; ``index`` should be a written table.

    The windows are dealt into blocks that a driver and a worker can hold, each block goes to every segment, and what it
    hits is written: ranges and items of the documents with a hit. These are merged by document at the end.
    """
    _check_span(span)
    asked = snapshot(asked, "windows")
    rows, size = asked.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("window")), F.lit(0))).first()
    blocks = max(1, -(-rows // block_windows), -(-size // block_bytes))
    if blocks == 1:
        return search(index, _phrases_of_windows(asked.collect()), span)
    spark = index.sparkSession
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("window", "item"), F.lit(blocks)))
    dealt = written(dealt.repartition("block"), new_folder(spark, "blocks"), "block")
    folder = new_folder(spark, "hits")
    for block in range(blocks):
        phrases = _phrases_of_windows(dealt.where(F.col("block") == block).select("window", "item").collect())
        shared = spark.sparkContext.broadcast(phrases)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    yield _hits_of_segment(Segment(row, shared.value.terms), shared.value, span)

        index.mapInArrow(run, _HIT).write.mode("append").parquet(folder)
        shared.destroy()
    return _merged(index, spark.read.schema(_HIT).parquet(folder), span)


def _merged(index: DataFrame, hits: DataFrame, span: int | None) -> DataFrame:
    """What search() gives, from the documents of an index and the hits of all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row, {})
                count = len(segment.ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([segment.number] * count, pa.int64()),
                        pa.array(range(count), pa.int64()),
                        pa.array(segment.ids, pa.int64()),
                        pa.array(segment.marks),
                        pa.array(segment.sizes),
                    ],
                    ["segment", "doc", "id", "mark", "n_words"],
                )

    every = index.mapInArrow(run, "segment long, doc long, id long, mark long, n_words long")
    long = F.lit(0).cast("long")
    count = F.aggregate(
        F.array_sort("ranges"),
        F.struct(long.alias("hit"), long.alias("at")),
        lambda s, r: F.struct(
            (s["hit"] + F.greatest(long, r["end"] - F.greatest(r["begin"], s["at"]))).alias("hit"),
            F.greatest(s["at"], r["end"]).alias("at"),
        ),
        lambda s: s["hit"],
    )
    whole = hits.groupBy("segment", "doc").agg(
        *(F.flatten(F.collect_list(c)).alias(c) for c in ("ranges", "items", "near_items"))
    )
    none = F.array().cast("array<string>")

    def named(items: str):
        return F.coalesce(F.array_sort(F.array_distinct(items)), none).alias(items)

    return every.join(whole, ["segment", "doc"], "left").select(
        "id",
        "mark",
        "n_words",
        F.coalesce(count, long).alias("n_hit"),
        named("items"),
        F.lit(None).cast("array<string>").alias("near_items") if span is None else named("near_items"),
    )
