"""Secrets: base patterns, and strings that a character Markov model finds random.

Two models give the probability of each character after the one before it: one of random strings, one of ordinary
identifiers. Their labelled samples are the corpus itself: what the base patterns take as a secret is
random, and identifiers of ``IDENTIFIER_CHARS`` letters, digits and signs or more outside all base spans are ordinary, as are
numbers of ``NUMBER_CHARS`` digits or more, wherever they stand; both are counted over all documents. Base spans are cut out of the runs of such characters. What is left of a run, or a part of it
between two of / = _ -, is a secret if it has ``CANDIDATE_CHARS`` or more and its log-likelihood ratio for each
character is ``LEAST_RATIO`` or more; of parts that overlap, the one that exceeds this ratio most in all is taken.

The counts are one row for each class and pair of characters and task, so the models are of fixed size.
Without samples of either class only base spans are found. A null or empty text has no spans; rows
are kept one for one whatever their ids. An empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import small_batches, texts

# Fixed values of the base kinds.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_CHARS = 6
#: A run that is too short never matches in part either, so the least lengths stand in the patterns.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: One of these is in every text that ASSIGN matches.
_KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")

MARKOV = "markov"
IDENTIFIER_CHARS = 8
NUMBER_CHARS = 2
CANDIDATE_CHARS = 16
LEAST_RATIO = 0.7
#: Added to each count of a character, and how many pairs the characters' own frequencies count for.
SMOOTHING = 0.5
BACKOFF = 500.0
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % CANDIDATE_CHARS)
_NUMBER = re.compile(rb"[0-9]{%d,}" % NUMBER_CHARS)
_PIECE = re.compile(r"[^/=_-]+")
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_SIZE = len(_ALPHABET)
_SIGNS = 5
_CODES = np.full(256, _SIZE, dtype=np.int64)
_CODES[list(_ALPHABET.encode())] = np.arange(_SIZE)
_SPANS = "array<struct<kind:string,start:int,end:int>>"


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, the secret itself), by start, then by kind as listed; code points, ends exclusive."""
    found = []
    low = text.lower()
    if any(word in low for word in _KEYWORDS):
        found += [("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    found += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _without(text: str, spans: list[tuple[str, int, int, str]]) -> str:
    at, parts = 0, []
    for _, start, end, _ in spans:
        if start >= at:
            parts += [text[at:start], " "]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def _pairs(raw: bytes, least: int) -> np.ndarray:
    """How often each pair of characters stands in runs of the alphabet of a least length."""
    codes = _CODES[np.frombuffer(raw, np.uint8)]
    inside = codes < _SIZE
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    begins, ends = edges[::2], edges[1::2]
    long = ends - begins >= least
    kept = np.zeros(len(codes) + 1, dtype=np.int64)
    kept[begins[long]] += 1
    kept[ends[long]] -= 1
    member = np.cumsum(kept[:-1]).astype(bool)
    both = member[1:] & member[:-1] & inside[1:]
    return np.bincount(codes[:-1][both] * _SIZE + codes[1:][both], minlength=_SIZE * _SIZE)


def _ordinary(raw: bytes) -> np.ndarray:
    return _pairs(raw, IDENTIFIER_CHARS) + _pairs(b" ".join(_NUMBER.findall(raw)), NUMBER_CHARS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ordinary, random = np.zeros(_SIZE * _SIZE, np.int64), np.zeros(_SIZE * _SIZE, np.int64)
    for batch in batches:
        held, size = [], 0
        for text in batch.column("text"):
            text = text.as_py() or ""
            spans = base_spans(text)
            if spans:
                random += _pairs(" ".join(s[3] for s in spans).encode(), 2)
            held.append((_without(text, spans) if spans else text).encode())
            size += len(held[-1])
            if size > 1 << 20:
                ordinary += _ordinary(b" ".join(held))
                held, size = [], 0
        if held:
            ordinary += _ordinary(b" ".join(held))
    for name, counts in (("ordinary", ordinary), ("random", random)):
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {"class": pa.array([name] * len(used), pa.string()), "pair": used, "n": counts[used]}
        )


def learn(docs: DataFrame, text_col: str = "text") -> np.ndarray | None:
    """The log ratio of both models for each pair of characters; None without samples of both."""
    small_batches(docs.sparkSession)
    whole = docs.select(F.col(text_col).cast("string").alias("text"))
    rows = whole.mapInArrow(_count, "class string, pair long, n long").groupBy("class", "pair").agg(F.sum("n").alias("n"))
    counts = {"ordinary": np.zeros(_SIZE * _SIZE), "random": np.zeros(_SIZE * _SIZE)}
    for row in rows.collect():  # at most two classes of _SIZE**2 pairs
        counts[row["class"]][row["pair"]] = row["n"]
    if not all(c.any() for c in counts.values()):
        return None
    return log_ratio(counts["random"], counts["ordinary"])


def log_ratio(random: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    """The log ratio of two models from their counts of pairs.

    A pair that is rare falls back on what its class makes of a character alone: ordinary identifiers on their characters'
    frequencies, random strings on letters and digits being equally likely, as the few labelled ones need not show all alphabets.
    """
    even = np.where(np.arange(_SIZE) < _SIZE - _SIGNS, 1.0, SMOOTHING / BACKOFF)
    logs = []
    for own, single in ((random, even), (ordinary, ordinary.reshape(_SIZE, _SIZE).sum(axis=0) + SMOOTHING)):
        pairs = own.reshape(_SIZE, _SIZE)
        logs.append(np.log((pairs + BACKOFF * single / single.sum()) / (pairs.sum(axis=1, keepdims=True) + BACKOFF)))
    return logs[0] - logs[1]


def ratio(value: str, model: np.ndarray) -> float:
    """The log-likelihood ratio for each character of a string of the alphabet."""
    codes = _CODES[np.frombuffer(value.encode(), np.uint8)]
    return float(model[codes[:-1], codes[1:]].sum() / (len(codes) - 1))


def _best(edges: list[tuple[int, int]], excess: np.ndarray) -> tuple[float, int, int] | None:
    """The stretch of whole pieces, of CANDIDATE_CHARS at least, that exceeds the least ratio most: (by how much, first, last)."""
    best, low, ready = None, None, 0
    for last, (_, end) in enumerate(edges):
        while ready <= last and end - edges[ready][0] >= CANDIDATE_CHARS:
            if low is None or excess[edges[ready][0]] < excess[edges[low][0]]:
                low = ready
            ready += 1
        if low is not None:
            over = float(excess[end - 1] - excess[edges[low][0]])
            if best is None or over > best[0]:
                best = (over, low, last)
    return best


def secrets_of(value: str, model: np.ndarray) -> list[tuple[int, int]]:
    """The spans of a run that are secrets, as a whole or between its separators."""
    codes = _CODES[np.frombuffer(value.encode(), np.uint8)]
    steps = model[codes[:-1], codes[1:]]
    if steps.sum() >= LEAST_RATIO * len(steps):
        return [(0, len(value))]
    # sums of what each pair of characters has above the least ratio, up to each character
    excess = np.concatenate([[0.0], np.cumsum(steps - LEAST_RATIO)])
    pieces = [m.span() for m in _PIECE.finditer(value)]
    found, left = [], [pieces]
    while left:
        edges = left.pop()
        best = _best(edges, excess)
        if best is not None and best[0] >= 0:
            _, first, last = best
            found.append((edges[first][0], edges[last][1]))
            left += [edges[:first], edges[last + 1 :]]
    return found


def _outside(start: int, end: int, base: list[tuple[str, int, int, str]]) -> Iterator[tuple[int, int]]:
    """What of a span lies outside the base spans, which are sorted by start."""
    for _, a, b, _ in base:
        if a < end and start < b:
            if start < a:
                yield start, a
            start = max(start, b)
    if start < end:
        yield start, end


def find_in(text: str, model: np.ndarray | None) -> list[tuple[str, int, int]]:
    """All spans of a text, by start, then by kind; those of the model after base ones."""
    base = base_spans(text)
    found = [s[:3] for s in base]
    if model is not None:
        for m in _CANDIDATE.finditer(text):
            for start, end in _outside(*m.span(), base):
                if end - start >= CANDIDATE_CHARS:
                    found += [(MARKOV, start + a, start + b) for a, b in secrets_of(text[start:end], model)]
    order = (*KINDS, MARKOV)
    return sorted(found, key=lambda s: (s[1], order.index(s[0])))


def find(docs: DataFrame, model: np.ndarray | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) for every row; spans hold kind, start and end."""
    rows = texts(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            found = [
                [{"kind": k, "start": a, "end": b} for k, a, b in find_in(text.as_py() or "", shared.value)]
                for text in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, kind)], ["id", "spans"])

    return rows.mapInArrow(run, f"id long, spans {_SPANS}")
