"""Byte-level BPE: Spark's higher-order functions fold the ranked merges over distinct words.

A word (one match of the pattern) is an array of one-byte pieces. The fold merges, again and
again, the leftmost pair of neighbours with the lowest rank; ranks come from one literal map.
Higher-order functions are interpreted, so a word must not be folded at each of its
occurrences, and a join of all occurrences with their words would shuffle the corpus:

* words are counted over the whole corpus; the ``HOT_WORDS`` most frequent ones (a bound on
  what is broadcast, not on what is encoded) are folded once and broadcast with their ids;
* documents are handled a megabyte at a time. Distinct words that are not in the map are numbered as a task finds them
  and travel ahead of the documents that they are in, as arrays of pieces, to be folded in place; the task's next step
  keeps their ids, so a word travels once in a task, until ``SENT_BYTES`` of words are kept and the numbers begin
  again. No text and no token is shuffled.

Texts are split as whole columns of bytes where the pattern is the one that ``_BY_CLASSES`` names: words begin where
classes of characters change. Other patterns are searched in each text.

Rows are kept one for one. A null text is an empty one and has no ids. Ids that repeat or are null change
nothing, as rows are never matched by them. An empty table gives an empty one.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import broadcast, by_bytes, freeing, let_go, short_plans, snapshot, strings, texts

#: Words in the broadcast map, at most, and the bytes of each.
HOT_WORDS = 1 << 18
HOT_BYTES = 64
#: Longer words are merged with a heap: a fold copies its state at each step, so its time is quadratic.
FOLD_BYTES = 1 << 13
#: Bytes of texts whose words are looked up together, and which are split together.
SKETCH_BYTES = 1 << 20
SPLIT_BYTES = 1 << 18
#: Bytes of words whose ids a task keeps, each with so many more for what it takes to keep it; and bytes of words in a row.
SENT_BYTES = 8 << 20
_KEPT = 64
_ROW_BYTES = 1 << 14
#: Words counted in a task before they are handed on.
_COUNTED = 400_000
#: Small maps in the literal; a prime.
_MAPS = 32_771
_NO_RANK = 1 << 20
_LOW = (1 << 16) - 1
_HOLE = 1 << 31


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    if max(ranks.values(), default=0) > _LOW:
        raise ValueError(f"ranks beyond {_LOW} are not supported")
    return ranks


def _merge_literal(ranks: dict[bytes, int]) -> Column:
    """Which two ids merge, and their rank (which is the new id), as one literal.

    It is cut into small maps by key, as Spark scans a map's keys in turn.
    """
    maps: list[dict[int, int]] = [{} for _ in range(_MAPS)]
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                key = left << 16 | right
                maps[key % _MAPS][key] = rank
    keyed_by_text = F.from_json(F.lit(json.dumps(maps, separators=(",", ":"))), "array<map<string,bigint>>")
    return keyed_by_text.cast("array<map<bigint,bigint>>")


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fold_merges(word: Column, merges: Column) -> Column:
    """The ids of a word, given by ``_as_pieces`` as the pieces that are its bytes.

    The state is an array of longs, one for each piece: the rank of its merge with the next
    piece, where it starts, and its id. Its minimum is the leftmost of the best merges.
    """

    def ids(maps: Column) -> Column:
        def piece(own: Column, start: Column, following: Column) -> Column:
            key = F.shiftleft(own, 16).bitwiseOR(following)
            rank = F.element_at(F.get(maps, F.pmod(key, F.lit(_MAPS)).cast("int")), key)
            rank = F.coalesce(rank, F.lit(_NO_RANK))
            return F.shiftleft(rank, 32).bitwiseOR(F.shiftleft(start, 16)).bitwiseOR(own)

        def id_of(state: Column) -> Column:
            return state.bitwiseAND(F.lit(_LOW))

        def start_of(state: Column) -> Column:
            return F.shiftright(state, 16).bitwiseAND(F.lit(_LOW))

        def merge(pieces: Column, _: Column) -> Column:
            return _let(F.array_min(pieces), lambda best: merged(pieces, best))

        def merged(pieces: Column, best: Column) -> Column:
            def at(i: Column) -> Column:
                own = F.shiftright(best, 32)
                new = piece(own, start_of(best), id_of(F.get(pieces, i + 1)))
                left = F.get(pieces, i - 2)
                changed = F.when(
                    i > 1, F.array(piece(id_of(left), start_of(left), own), new)
                ).otherwise(F.array(new))
                return F.concat(
                    F.slice(pieces, 1, F.greatest(i - 2, F.lit(0))), changed, F.slice(pieces, i + 2, F.size(pieces))
                )

            place = F.array_position(pieces, best).cast("int")
            return F.when(best >= F.lit(_NO_RANK << 32), pieces).otherwise(_let(place, at))

        steps = F.when(F.size(word) > 1, F.sequence(F.lit(2), F.size(word))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, word, merge, lambda pieces: F.transform(pieces, id_of))

    return _let(merges, ids)


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for one very long word, with a heap and linked neighbours."""
    if word in ranks:
        return [ranks[word]]
    size = len(word)
    ends, before, alive = list(range(1, size + 1)), list(range(-1, size - 1)), [True] * size
    heap = [(r, k, k + 2) for k in range(size - 1) if (r := ranks.get(word[k : k + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, at, end = heapq.heappop(heap)
        if not alive[at] or ends[at] >= size or ends[ends[at]] != end:
            continue
        gone = ends[at]
        alive[gone] = False
        ends[at] = end
        if end < size:
            before[end] = at
            if (r := ranks.get(word[at : ends[end]])) is not None:
                heapq.heappush(heap, (r, at, ends[end]))
        if (left := before[at]) >= 0 and (r := ranks.get(word[left:end])) is not None:
            heapq.heappush(heap, (r, left, end))
    return [ranks[word[k : ends[k]]] for k in range(size) if alive[k]]


# Letters and numbers below U+0250; a text with other characters, or with separators that the two libraries
# class differently, is split by the pattern itself.
_LETTERS, _NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
_BEYOND = re.compile("[\x1c-\x1f\x85\u0250-\U0010ffff]")


#: The pattern whose matches are found by classes of characters.
_BY_CLASSES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SPACE = 3


class Splitter:
    """All matches of a pattern in a text, or in a column of texts."""

    def __init__(self, pattern: str):
        self.by_classes = pattern == _BY_CLASSES
        self.general = regex.compile(pattern).findall
        written = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{_LETTERS}{_NUMBERS}]")
        written = written.replace(r"\p{L}", f"[{_LETTERS}]").replace(r"\p{N}", f"[{_NUMBERS}]")
        self.special = None if "\\p" in written or "[[" in written else re.compile(written).findall

    def __call__(self, text: str) -> list[str]:
        """The matches in one text; where the pattern's classes can be written out, by the faster library."""
        return self.general(text) if self.special is None or _BEYOND.search(text) else self.special(text)

    def column(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The matches in some texts (null: none), one after another, and where those of each text end."""
        if self.by_classes:
            return _split_by_classes(texts)
        found = [self(text or "") for text in strings(texts)]
        return pa.array([w for words in found for w in words], pa.string()), np.cumsum([len(w) for w in found], dtype=np.int64)


def splitter(pattern: str) -> Splitter:
    return Splitter(pattern)


@cache
def _classes() -> np.ndarray:
    """The class of each character: 1 for letters, 2 for numbers, 3 for white space, 0 for others."""
    found = np.zeros(0x110000, np.uint8)
    for first in range(0, len(found), 1 << 12):
        some = np.arange(first, first + (1 << 12), dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")
        for kind, pattern in ((1, r"\p{L}+"), (2, r"\p{N}+"), (_SPACE, r"\s+")):
            for run in regex.finditer(pattern, some):
                found[first + run.start() : first + run.end()] = kind
    return found


def _classes_of(raw: np.ndarray) -> np.ndarray:
    """The class of the character that each byte of some UTF-8 is part of."""
    kinds = _classes()[:256][raw]
    wide = np.flatnonzero(raw >= 0xC0)
    if len(wide):
        lead = raw[wide]
        for least, size, mask in ((0xC0, 2, 0x1F), (0xE0, 3, 0x0F), (0xF0, 4, 0x07)):
            at = wide[(lead >= least) & (lead < 0x100 - mask - 1)]
            code = (raw[at] & mask).astype(np.int32)
            for k in range(1, size):
                code = code << 6 | raw[at + k] & 0x3F
            own = _classes()[code]
            for k in range(size):
                kinds[at + k] = own
    return kinds


def _split_by_classes(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The matches of _BY_CLASSES: begins of words are marked among the bytes of all texts."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    _, places, data = texts.buffers()
    bounds = np.frombuffer(places, np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    size, bounds = int(bounds[-1] - bounds[0]), bounds - bounds[0]
    if not size:
        return pa.array([], pa.string()), np.zeros(len(texts), np.int64)
    data = data.slice(int(np.frombuffer(places, np.int32)[texts.offset]), size)
    raw = np.frombuffer(data, np.uint8)
    kinds = _classes_of(raw)
    of_text = np.zeros(size + 1, bool)
    of_text[bounds] = True
    begins = of_text.copy()
    begins[1:-1] |= kinds[1:] != kinds[:-1]
    # The last white space before a word stands apart from what is before it; a blank belongs to the word.
    behind = np.flatnonzero((kinds[:-1] == _SPACE) & begins[1:-1]) + 1
    behind = behind[~of_text[behind]]
    last = behind - 1
    for _ in range(3):  # to the first byte of a character
        last = last - ((raw[last] & 0xC0) == 0x80)
    begins[last] = True
    begins[behind[raw[last] == ord(" ")]] = False
    # An apostrophe at which a word begins takes the letters of a contraction.
    sign = np.flatnonzero((raw[:-1] == ord("'")) & begins[:-2])
    sign = sign[~of_text[sign + 1]]
    short = sign[np.isin(raw[sign + 1], list(b"stmd"))]
    sign = sign[sign + 2 < size]
    sign = sign[~of_text[sign + 2]]
    pair = raw[sign + 1].astype(np.int32) << 8 | raw[sign + 2]
    long = sign[np.isin(pair, [int.from_bytes(x) for x in (b"re", b"ve", b"ll")])]
    for at, length in ((short, 2), (long, 3)):
        begins[at + 1] = False
        begins[at + length] = True
    starts = np.flatnonzero(begins).astype(np.int32)
    ends = np.searchsorted(starts, bounds[1:])
    return pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), data), ends


def _coded(texts: pa.Array, find: Splitter) -> tuple[pa.Array, np.ndarray, list[int]]:
    """The distinct words of some texts, which of them each word is, and where those of each text end.

    The words of SPLIT_BYTES of texts are found at a time.
    """
    chunks, ends, held = [], [np.empty(0, np.int64)], 0
    for begin, end in by_bytes(texts, SPLIT_BYTES):
        words, places = find.column(texts.slice(begin, end - begin))
        chunks.append(words)
        ends.append(places + held)
        held += len(words)
    coded = pa.chunked_array(chunks, pa.string()).dictionary_encode().combine_chunks()
    return coded.dictionary, coded.indices.to_numpy(), np.concatenate(ends).tolist()


def _words(texts: pa.Array, find: Splitter) -> tuple[list[str], np.ndarray, list[int]]:
    words, which, ends = _coded(texts, find)
    return strings(words), which, ends


def _counted(batches: Iterator[pa.RecordBatch], find: Splitter) -> Iterator[pa.RecordBatch]:
    """Words and how often they occur, handed on whenever _COUNTED of them are held."""
    held: list[pa.Table] = []
    fresh = 0

    def summed() -> pa.Table:
        return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"])

    for batch in batches:
        column = batch.column("text")
        for begin, end in by_bytes(column, SKETCH_BYTES):
            words, which, _ = _coded(column.slice(begin, end - begin), find)
            part = pa.table({"word": words, "n": np.bincount(which, minlength=len(words)).astype(np.int64)})
            held.append(part.filter(pc.less_equal(pc.utf8_length(part["word"]), HOT_BYTES)))
            fresh += len(words)
            if fresh > _COUNTED:
                held, fresh = [summed()], 0
                if held[0].num_rows > _COUNTED:
                    yield from held.pop().to_batches()
    if held:
        yield from summed().to_batches()


def _count_words(rows: DataFrame, pattern: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _counted(batches, splitter(pattern))

    return rows.mapInArrow(freeing(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words above the lowest count that at most ``most`` words reach; no sort and no single task.

    The threshold comes from a histogram of the counts' logarithms, of at most 64 * 16 rows.
    """
    level = F.floor(F.log2("n") * 16).cast("int")
    steps = counts.where("n > 1").groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()
    lowest, total = None, 0
    for row in sorted(steps, key=lambda r: -r.level):
        total += row.words
        if total > most:
            break
        lowest = row.level
    return counts.where(F.lit(False) if lowest is None else (F.col("n") > 1) & (level >= lowest))


def _of_bytes(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """The id of each byte, and the rank of each pair of bytes."""
    ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
    pairs = np.array([[ranks.get(bytes([a, b]), _NO_RANK) for b in range(256)] for a in range(256)], dtype=np.int32)
    return ids, pairs


def _as_pieces(words: list[bytes], of_bytes: tuple[np.ndarray, np.ndarray]) -> pa.ListArray:
    """What ``fold_merges`` begins with, for each word: its bytes as pieces."""
    ids, pairs = of_bytes
    sizes = np.fromiter(map(len, words), np.int32, len(words))
    ends = np.cumsum(sizes, dtype=np.int32)
    raw = np.frombuffer(b"".join(words), np.uint8)
    ranks = np.full(len(raw), _NO_RANK, dtype=np.int64)
    ranks[:-1] = pairs[raw[:-1], raw[1:]]
    ranks[ends - 1] = _NO_RANK
    starts = np.arange(len(raw)) - np.repeat(ends - sizes, sizes)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ranks << 32 | starts << 16 | ids[raw]))


def _hot_words(rows: DataFrame, pattern: str, ranks: dict[bytes, int], literal: Column, most: int) -> bytes:
    """The ids of the most frequent words, as an Arrow stream: the driver makes no object of each word."""
    counts = snapshot(_count_words(rows, pattern), "words")
    of_bytes = _of_bytes(ranks)

    def as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w.as_py().encode() for w in batch.column("word")]
            yield pa.RecordBatch.from_arrays([batch.column("word"), _as_pieces(words, of_bytes)], ["word", "pieces"])

    hot = snapshot(_most_frequent(counts, most).select("word"), "hot").repartition(16)  # small, but much work
    hot = hot.mapInArrow(as_bytes, "word string, pieces array<bigint>")
    found = hot.select("word", fold_merges(F.col("pieces"), literal).alias("ids")).toArrow()
    stream = pa.BufferOutputStream()
    with pa.ipc.new_stream(stream, found.schema) as writer:
        writer.write_table(found)
    return stream.getvalue().to_pybytes()


@lru_cache(1)
def _hot_map(stream: bytes, tokens: tuple[bytes, ...]) -> dict[str, bytes]:
    """The ids of the most frequent words, and of all words that are tokens."""
    found = pa.ipc.open_stream(stream).read_all()
    ids: dict[str, bytes] = {}
    for batch in found.to_batches():
        lists = batch.column("ids")
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)).tolist()
        raw = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
        ids.update((w, raw[4 * a : 4 * b]) for w, a, b in zip(strings(batch.column("word")), [0, *ends], ends))
    for rank, token in enumerate(tokens):
        try:
            ids[token.decode()] = rank.to_bytes(4, "little")
        except UnicodeDecodeError:  # a part of a character, so never a word
            continue
    return ids


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    hot_words: int = HOT_WORDS,
    decoded: bool = False,
) -> DataFrame:
    """(id, ids) for every row; ids is a binary of little-endian unsigned 32-bit integers.

    With ``decoded`` the ids are decoded again where they are made, as another column.
    """
    rows = texts(docs, id_col, text_col)
    spark = docs.sparkSession
    short_plans(spark)
    ranks = load_ranks(ranks_path)
    literal, of_bytes = _merge_literal(ranks), _of_bytes(ranks)
    hot = broadcast(spark, _hot_words(rows, pattern, ranks, literal, hot_words))
    all_ranks = broadcast(spark, ranks)
    pieces = broadcast(spark, tuple(_pieces(ranks)))
    let_go()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sketched(batches, splitter(pattern), _hot_map(hot.value, pieces.value), all_ranks, of_bytes)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _filled(batches, pa.array(pieces.value, pa.binary()) if decoded else None)

    # The rows of a task stay in order between the two steps: nothing is shuffled there.
    folded = rows.mapInArrow(freeing(sketch), "id long, sketch binary, first long, rare array<array<bigint>>").select(
        "id", "sketch", "first", F.transform("rare", lambda word: fold_merges(word, literal)).alias("found")
    )
    return folded.mapInArrow(freeing(fill), "id long, ids binary" + (", decoded binary" if decoded else ""))


_RARE = pa.list_(pa.list_(pa.int64()))


def _sketched(
    batches: Iterator[pa.RecordBatch], find: Splitter, hot: dict[str, bytes], all_ranks: Broadcast, of_bytes: tuple[np.ndarray, np.ndarray]
) -> Iterator[pa.RecordBatch]:
    """Documents as ids of frequent words and holes, and ahead of them the words of holes that were not sent before."""
    sent: dict[str, int] = {}
    kept = 0
    for batch in batches:
        column = batch.column("text")
        for begin, end in by_bytes(column, SKETCH_BYTES):
            if kept > SENT_BYTES:
                sent.clear()
                kept = 0
            words, which, ends = _words(column.slice(begin, end - begin), find)
            rare, first = [], len(sent)
            parts = list(map(hot.get, words))
            for k, part in enumerate(parts):
                if part is not None:
                    continue
                number = sent.get(words[k])
                if number is None:
                    raw = words[k].encode()
                    if len(raw) > FOLD_BYTES:
                        parts[k] = np.array(merge_long(raw, all_ranks.value), dtype="<u4").tobytes()
                        continue
                    number = sent[words[k]] = len(sent)
                    kept += len(raw) + _KEPT
                    rare.append(raw)
                parts[k] = (_HOLE | number).to_bytes(4, "little")
            if rare:
                yield _rare_rows(_as_pieces(rare, of_bytes), first)
            found, places = _laid_out(parts, which, ends)
            ids = batch.column("id").slice(begin, end - begin)
            yield pa.RecordBatch.from_arrays(
                [ids, _cut(found, np.array(places)), pa.array(np.full(len(ids), -1)), pa.nulls(len(ids), _RARE)],
                ["id", "sketch", "first", "rare"],
            )


def _filled(batches: Iterator[pa.RecordBatch], pieces: pa.Array | None) -> Iterator[pa.RecordBatch]:
    """The documents with their holes filled; rows of folded words are kept until their numbers begin again."""
    lengths, flat = np.empty(0, np.int64), np.empty(0, "<u4")
    for batch in batches:
        firsts = batch.column("first").to_numpy()
        turns = np.flatnonzero(np.diff(firsts < 0)) + 1
        for begin, end in zip([0, *turns.tolist()], [*turns.tolist(), len(firsts)]):
            rows = batch.slice(begin, end - begin)
            if firsts[begin] >= 0:
                again = np.flatnonzero(firsts[begin:end] == 0)
                if len(again):
                    rows = rows.slice(int(again[-1]))
                    lengths, flat = lengths[:0], flat[:0]
                words = rows.column("found").flatten()
                lengths = np.concatenate([lengths, words.value_lengths().to_numpy(zero_copy_only=False)])
                flat = np.concatenate([flat, words.flatten().to_numpy(zero_copy_only=False).astype("<u4")])
                continue
            raw, places = _laid_open(rows.column("sketch"))
            filled, ends = _fill_holes(np.frombuffer(raw, "<u4"), lengths, flat, places // 4)
            columns = {"id": rows.column("id"), "ids": _cut(filled, ends)}
            if pieces is not None:
                decoded, places = _laid_open(pieces.take(pa.array(filled)))
                columns["decoded"] = _cut(np.frombuffer(decoded, np.uint8), np.concatenate([[0], places])[ends])
            yield pa.RecordBatch.from_pydict(columns)


def _rare_rows(words: pa.ListArray, first: int) -> pa.RecordBatch:
    """Rows of about _ROW_BYTES of words, each with the number of its first word."""
    held = np.cumsum(words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)) // _ROW_BYTES
    begins = np.concatenate([[0], np.flatnonzero(np.diff(held)) + 1, [len(words)]]).astype(np.int32)
    size = len(begins) - 1
    return pa.RecordBatch.from_arrays(
        [
            pa.nulls(size, pa.int64()),
            pa.nulls(size, pa.binary()),
            pa.array(begins[:-1].astype(np.int64) + first),
            pa.ListArray.from_arrays(pa.array(begins), words),
        ],
        ["id", "sketch", "first", "rare"],
    )


def _cut(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A column of binaries from all values one after another and where those of each row end."""
    places = (np.concatenate([[0], ends]) * values.itemsize).astype(np.int32)
    if len(values) * values.itemsize >= 1 << 31:
        raise OverflowError("the ids or bytes of one text exceed 2 GiB")
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(values))])


def _laid_open(column: pa.Array) -> tuple[pa.Buffer | bytes, np.ndarray]:
    """All bytes of a column of binaries without nulls, and where those of each row end."""
    column = column.cast(pa.binary())
    _, places, data = column.buffers()
    if not len(column) or data is None:
        return b"", np.zeros(len(column), np.int64)
    places = np.frombuffer(places, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return data.slice(int(places[0]), int(places[-1] - places[0])), places[1:] - places[0]


def _laid_out(parts: list[bytes], which: np.ndarray, ends: list[int]) -> tuple[np.ndarray, list[int]]:
    """The parts of all words one after another, as 32-bit integers, and where those of each text end."""
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    flat, starts = np.frombuffer(b"".join(parts), "<u4"), np.cumsum(lengths) - lengths
    sizes = lengths[which]
    word_ends = np.cumsum(sizes)
    places = np.arange(word_ends[-1] if len(which) else 0) + np.repeat(starts[which] - (word_ends - sizes), sizes)
    return flat[places], np.concatenate([[0], word_ends])[ends].tolist()


def _fill_holes(sketch: np.ndarray, lengths: np.ndarray, flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids with each hole replaced by the ids of its word, and where those of each text end now."""
    holes = np.flatnonzero(sketch & _HOLE)
    if not len(holes):
        return sketch, ends
    which = sketch[holes] & (_HOLE - 1)
    sizes = lengths[which]
    grown = np.concatenate([[0], np.cumsum(sizes - 1)])  # by how much the holes so far are longer than one id
    counts = np.ones(len(sketch), dtype=np.int32)
    counts[holes] = sizes
    out = np.repeat(sketch, counts)
    # places in the result and in flat of the ids of all holes
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(holes + grown[:-1], sizes) + within] = flat[np.repeat((np.cumsum(lengths) - lengths)[which], sizes) + within]
    return out, ends + grown[np.searchsorted(holes, ends)]


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, decoded) for every row: decoded joins the pieces of its ids. Null ids give no bytes."""
    shared = encoded.sparkSession.sparkContext.broadcast(_pieces(load_ranks(ranks_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            decoded = [_join_pieces(x.as_py() or b"", shared.value) for x in batch.column("ids")]
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column("id"), "ids": batch.column("ids"), "decoded": pa.array(decoded, pa.binary())}
            )

    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, "id long, ids binary, decoded binary")


def _pieces(ranks: dict[bytes, int]) -> list[bytes]:
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return pieces


def _join_pieces(ids: bytes, pieces: list[bytes]) -> bytes:
    return b"".join(map(pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))
