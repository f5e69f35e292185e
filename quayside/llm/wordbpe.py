"""Ids of texts by a tokenizer file whose words are separate, each ending in a token that marks it.

The results are the library's. What makes it fast is that few words reach it: a batch's distinct words are found
as whole arrays, signs behind letters being words of their own, and the ids of words are remembered. New words of Latin letters
go to the library's merges together, past its normaliser and its pattern, which change nothing in them but the
case. All other words go to the whole library one by one.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quayside.llm.common import by_bytes, strings

#: Words whose ids a Python worker remembers: two generations of so many.
REMEMBERED = 1 << 18
#: Letters whose lower case is one letter of the same kind, and a sign behind one; no apostrophe, which the pattern treats apart.
_LETTERS = re.compile(r"[a-zÀ-ÖØ-öø-ÿ]+")
_BOUNDARY = r"([a-zÀ-ÖØ-öø-ÿ])([!-&(-/:-@\[-`{-~])"


@cache
def encoder(tokenizer_path: str) -> Encoder:
    """The encoder of this Python process for a file, with what it remembers."""
    return Encoder(tokenizer_path)


class Encoder:
    """Ids of texts as 16-bit integers, a column of texts at a time; texts are split at spaces and line ends first.

    The tokenizer must drop white space and treat words on their own. The fast way for plain words is taken only
    if the file lower-cases, keeps runs of letters together, is byte-level and marks ends of words. Then a space
    between a letter and a sign, and lower case, change no ids, and fewer words differ.
    """

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        vocabulary = self.tokenizer.get_vocab()
        if max(vocabulary.values()) >= 1 << 16:
            raise ValueError("ids of this tokenizer do not fit into 16 bits")
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, number in vocabulary.items():
            self.ends[number] = token.endswith("</w>")
        with open(tokenizer_path, encoding="utf-8") as file:
            settings = json.load(file)
        self.added = [t["content"] for t in settings.get("added_tokens", [])]
        self.merges = _merges_only(settings) and Tokenizer.from_str(json.dumps(settings | _BARE))
        self.words: dict[str, bytes] = {"": b""}
        self.before: dict[str, bytes] = {}

    def __call__(self, text: str) -> np.ndarray:
        """The ids of one text."""
        return next(self._each(pa.array([text])))

    def column(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text (null: none), some megabytes of texts at a time."""
        for begin, end in by_bytes(texts):
            yield from self._each(texts.slice(begin, end - begin))

    def _each(self, texts: pa.Array) -> Iterator[np.ndarray]:
        special = self._special(texts)
        ids, ends = self._encoded(pc.if_else(special, "", texts) if special else texts)
        begin = 0
        for k, end in enumerate(ends.tolist()):
            if special and special[k].as_py():
                yield np.frombuffer(self._whole([texts[k].as_py()])[0][1], "<u2")
            else:
                yield ids[begin:end]
            begin = end

    def _special(self, texts: pa.Array) -> pa.Array | None:
        """Which texts may hold a token that the library looks for before all else; those it gets whole."""
        found = None
        for token in self.added:
            holds = pc.fill_null(pc.match_substring(texts, token, ignore_case=True), False)
            found = holds if found is None else pc.or_(found, holds)
        return found if found is not None and pc.any(found).as_py() else None

    def _encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts, and where those of each text end."""
        lines = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        if self.merges:
            lines = pc.replace_substring_regex(pc.ascii_lower(lines), _BOUNDARY, r"\1 \2")
        lists = pc.split_pattern(lines, " ")
        coded = lists.flatten().dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False)
        raw = self._ids_of(strings(coded.dictionary))
        lengths = np.fromiter(map(len, raw), np.int64, len(raw)) // 2
        flat, starts = np.frombuffer(b"".join(raw), "<u2"), np.cumsum(lengths) - lengths
        sizes = lengths[which]
        word_ends = np.cumsum(sizes)
        total = int(word_ends[-1]) if len(which) else 0
        narrow = np.int32 if total < 1 << 31 else np.int64
        places = np.arange(total, dtype=narrow) + np.repeat((starts[which] - (word_ends - sizes)).astype(narrow), sizes)
        text_ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        return flat[places], np.concatenate([[0], word_ends])[text_ends]

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words."""
        found = list(map(self.words.get, words))
        missing = [k for k, raw in enumerate(found) if raw is None]
        if not missing:
            return found
        if len(self.words) + len(missing) > REMEMBERED:  # frequent words come back from what was before
            self.before, self.words = self.words, {w: raw for w, raw in zip(words, found) if raw is not None}
        known, before = self.words, self.before
        for k in missing:
            raw = before.get(words[k])
            if raw is not None:
                known[words[k]] = raw
        self._learn([words[k] for k in missing if words[k] not in known])
        for k in missing:
            found[k] = known[words[k]]
        return found

    def _learn(self, new: list[str]) -> None:
        plain = list(map(_LETTERS.fullmatch, new)) if self.merges else [None] * len(new)
        letters = [w for w, is_plain in zip(new, plain) if is_plain]
        if letters:
            self.words.update(zip(letters, self._merged(letters)))
        self.words.update(self._whole([w for w, is_plain in zip(new, plain) if not is_plain]))

    def _whole(self, words: list[str]) -> list[tuple[str, bytes]]:
        encoded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False) if words else []
        return [(w, np.array(e.ids, dtype="<u2").tobytes()) for w, e in zip(words, encoded)]

    def _merged(self, words: list[str]) -> list[bytes]:
        line = " ".join(words)
        if not line.isascii():
            raw = np.frombuffer(line.lower().encode(), np.uint8)
            line = _byte_letters()[raw].tobytes().decode("utf-32-le")
        ids = np.array(self.merges.encode_batch_fast([line], add_special_tokens=False)[0].ids, dtype="<u2")
        ends = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        if len(ends) != len(words) or ends[-1] != len(ids):
            raise ValueError("the tokenizer does not mark the ends of words as expected")
        raw = ids.tobytes()
        return [raw[2 * a : 2 * b] for a, b in zip([0, *ends], ends)]


#: What remains of a tokenizer's settings: its merges, on words between spaces.
_BARE = {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None, "added_tokens": []}


def _merges_only(settings: dict) -> bool:
    """Whether letters in lower case pass the normaliser unchanged and the pattern in one piece."""
    shape = [p["type"] for p in (settings["pre_tokenizer"] or {}).get("pretokenizers", [])]
    pattern = str((settings["pre_tokenizer"] or {}).get("pretokenizers", [""])[0])
    steps = {n["type"] for n in (settings["normalizer"] or {}).get("normalizers", [])}
    return (
        shape == ["Split", "ByteLevel"] and "|[\\\\p{L}]+|" in pattern and "[^\\\\s\\\\p{L}\\\\p{N}]+" in pattern
        and "Lowercase" in steps and steps <= {"NFC", "Replace", "Lowercase"}
        and settings["model"].get("end_of_word_suffix") == "</w>"
    )


@cache
def _byte_letters() -> np.ndarray:
    """The letter that byte-level tokenizers write for each byte: itself if it can be seen, else one from 256 on.

    A space stays one, as it stands between words.
    """
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in seen]
    letters = np.arange(256, dtype="<u4")
    letters[hidden] = 256 + np.arange(len(hidden))
    letters[ord(" ")] = ord(" ")
    return letters
