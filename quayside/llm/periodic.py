"""Periodic runs in texts: a suffix automaton over words, and link-cut access to what was last seen where.

A run is a stretch of words in which words ``period`` apart are equal, for its smallest such period, and which no
neighbouring word extends. Each appended word adds a state to the automaton. The path from it along suffix links to
the start holds all suffixes of the text so far; it consists of segments whose suffixes last ended at the same
place. An access recolours the path with the new end. If a segment's longest suffix has ``length`` words and last
ended ``distance`` words before, and ``distance <= length``, then the last ``length + distance`` words repeat with
that period: a square, with its greatest extent to the left. Ends of one start and period follow each other, so the last
one ends the run. Segments are the preferred paths of a link-cut tree of splay trees (a colour belongs to
a whole preferred path and is kept at its splay root), so all accesses together take O(n log n) steps amortised.

Words that cannot be in a run asked for never enter an automaton: in a run of at least three periods every gram of
some words occurs twice, ``period`` words apart, so a run lies within consecutive places whose grams repeat in
the text (equal hashes, which can only let more through). That is a whole-array step over a batch of texts; the automaton gets
each such stretch alone. Texts are independent, so nothing is shuffled; a task holds one batch of texts, and the
automaton of one stretch.

Null, empty and blank texts have no words and no runs. Very long texts are one automaton at most. Of equal runs nothing is
lost or joined: a result lists each (start, period) once, in that order. Rows are kept one for one, also those with a null
or repeated id. Other columns are not read, so their names cannot clash. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from quayside.llm.common import texts

LEAST_WORDS = 24
LEAST_PERIODS = 3
#: Words of the grams whose repetition is looked for before a text meets an automaton.
GRAM_WORDS = 8

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = "id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class LastSeen:
    """Suffix automaton of a growing sequence whose suffix links are a link-cut tree; state 0 is none, 1 the start."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}, {}]
        self.link, self.length = [0, 0], [0, 0]
        self.left, self.right, self.up, self.colour = [0, 0], [0, 0], [0, 0], [-1, -1]
        self.last, self.size = 1, 0

    def append(self, word: int) -> list[tuple[int, int]]:
        """Adds a word; returns (distance, length) of each segment that last ended at most its length before."""
        state = self._extended(word)
        self.last, self.size = state, self.size + 1
        return self._access(state, self.size)

    def _state(self, length: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.length.append(length)
        for column in (self.link, self.left, self.right, self.up):
            column.append(0)
        self.colour.append(-1)
        return len(self.length) - 1

    def _extended(self, word: int) -> int:
        following, link, length = self.next, self.link, self.length
        at = self.last
        new = self._state(length[at] + 1, {})
        while at and word not in following[at]:
            following[at][word] = new
            at = link[at]
        if not at:
            parent = 1
        else:
            parent = following[at][word]
            if length[parent] != length[at] + 1:
                parent = self._split(parent, at, word)
        link[new] = self.up[new] = parent
        return new

    def _split(self, old: int, at: int, word: int) -> int:
        """A state between an old one and its link, for its suffixes that the new word has also made; seen where it was."""
        following, link = self.next, self.link
        new = self._state(self.length[at] + 1, dict(following[old]))
        link[new], link[old] = link[old], new
        while at and following[at].get(word) == old:
            following[at][word] = new
            at = link[at]
        self._splay(old)
        above = self.left[new] = self.left[old]
        if above:
            self.up[above] = new
        self.left[old], self.up[new] = new, old
        return new

    def _access(self, state: int, end: int) -> list[tuple[int, int]]:
        right, up, colour, length = self.right, self.up, self.colour, self.length
        found, below = [], 0
        while state:
            self._splay(state)
            seen = colour[state]
            if seen > 0 and end - seen <= length[state]:
                found.append((end - seen, length[state]))
            deeper = right[state]
            if deeper:
                colour[deeper] = seen  # a path of its own, last seen where it was
            right[state] = below
            below, state = state, up[state]
        colour[below] = end
        return found

    def _splay(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                self._rotate(p if (left[g] == p) == (left[p] == x) else x)
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        p = up[x]
        g = up[p]
        if g and left[g] == p:
            left[g] = x
        elif g and right[g] == p:
            right[g] = x
        else:
            self.colour[x] = self.colour[p]
        if left[p] == x:
            moved = left[p] = right[x]
            right[x] = p
        else:
            moved = right[p] = left[x]
            left[x] = p
        if moved:
            up[moved] = p
        up[x], up[p] = g, x


def runs(words: list[int], least_words: int = 2, least_periods: int = 2) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence, by start, then period. least_periods is 2 at least."""
    seen, ends = LastSeen(), {}
    for end, word in enumerate(words, 1):
        for period, length in seen.append(word):
            if length >= (least_periods - 1) * period:
                ends[end - length - period, period] = end
    found = ((start, end - start, period) for (start, period), end in ends.items())
    return sorted((r for r in found if r[1] >= least_words), key=lambda r: (r[0], r[2]))


def gram_words(least_words: int, least_periods: int) -> int:
    """Words of the longest grams that all occur twice in a run (one word, if it may have less than three periods).

    A gram of g words has a partner one period to the left or right if the run has at least 2 * period + g - 1 words.
    Three periods are enough for that if period >= g - 1; else 2 * (g - 2) + g - 1 words are.
    """
    return max(1, min(GRAM_WORDS, (least_words + 5) // 3)) if least_periods >= 3 else 1


def repeated(words: np.ndarray, ends: np.ndarray, gram: int) -> np.ndarray:
    """Places whose gram may occur twice in its text: all that do, and a few others. ends: of each text in words."""
    where = np.repeat(np.arange(len(ends), dtype=np.uint64), np.diff(ends, prepend=0))
    whole = np.arange(len(words)) + gram <= np.repeat(ends, np.diff(ends, prepend=0))
    hashed = words.astype(np.uint64)
    mixed = hashed = (hashed + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    for k in range(1, gram):
        mixed = mixed[:-1] * np.uint64(0xBF58476D1CE4E5B9) + hashed[k:]
    flags = np.zeros(len(words), dtype=bool)
    places = np.flatnonzero(whole)
    if not len(places):
        return flags
    keys = (mixed[places] + where[places] * np.uint64(0x94D049BB133111EB)) * np.uint64(0xD6E8FEB86659FD93)
    keys ^= keys >> np.uint64(32)
    slots = ((keys * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - (4 * len(places)).bit_length())).astype(np.int64)
    flags[places] = np.bincount(slots)[slots] > 1
    return flags


def _stretches(flags: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if end - begin >= least:
            yield begin, end


def _words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a batch of texts, and where those of each text end."""
    parts = pc.ascii_split_whitespace(pc.fill_null(column, ""))
    flat, ends = parts.flatten(), np.cumsum(parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():  # white space at an end of a text, or no word at all
        before = np.concatenate([[0], np.cumsum(full)])
        flat, ends = flat.filter(pa.array(full)), before[ends]
    return flat, ends


def _of_batch(batch: pa.RecordBatch, least_words: int, least_periods: int) -> pa.RecordBatch:
    flat, ends = _words(batch.column("text"))
    coded = flat.dictionary_encode()
    words, gram = coded.indices.to_numpy(zero_copy_only=False), gram_words(least_words, least_periods)
    flags, keep = repeated(words, ends, gram), np.ones(len(words), dtype=bool)
    begins, least = np.concatenate([[0], ends[:-1]]), least_words - gram + 1
    flagged = np.concatenate([[0], np.cumsum(flags)])
    found: list[list[dict]] = [[] for _ in range(len(ends))]
    for k in np.flatnonzero(flagged[ends] - flagged[begins] >= least).tolist():
        base = int(begins[k])
        for begin, end in _stretches(flags[base : ends[k]], least):
            stretch = words[base + begin : base + end + gram - 1]
            for start, length, period in runs(stretch.tolist(), least_words, least_periods):
                start += begin
                found[k].append({"start": start, "length": length, "period": period})
                keep[base + start + period : base + start + length] = False
    kept = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], ends])]
    texts_left = pa.ListArray.from_arrays(pa.array(kept, pa.int32()), flat if keep.all() else flat.filter(pa.array(keep)))
    return pa.RecordBatch.from_pydict(
        {
            "id": batch.column("id"),
            "n_words": pa.array(ends - begins, pa.int64()),
            "runs": pa.array(found, pa.list_(_RUN)),
            "collapsed": pc.binary_join(texts_left, " "),
        }
    )


def find(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_words: int = LEAST_WORDS,
    least_periods: int = LEAST_PERIODS,
) -> DataFrame:
    """(id, n_words, runs, collapsed) for every row; words are what stands between ASCII white space.

    ``runs`` lists (start, length, period) of every run of at least so many words and whole periods, by start, then
    period. ``collapsed`` is the text with one space between words, without the words that stand after the first period of any run.
    """
    if least_periods < 2 or least_words < 2:
        raise ValueError("a run has two periods and two words at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _of_batch(batch, least_words, least_periods)

    return texts(docs, id_col, text_col).mapInArrow(run, _FOUND)
