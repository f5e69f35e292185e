import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quayside.llm import wavelet, wordbpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("size,values", [(0, 1), (1, 3), (513, 2), (4000, 40), (1024, 65536)])
def test_matrix(size, values):
    ids = np.random.default_rng(size).integers(0, values, size).astype("<u2")
    doc_ids, sizes, matrix = wavelet.unpack(wavelet.pack([7, None], [size, 0], ids))
    assert (doc_ids, sizes.tolist()) == ([7, None], [size, 0])
    assert (matrix.all() == ids).all()
    for at in range(0, size, 97):
        assert matrix.access(at) == ids[at]
    for value in {0, values - 1, *ids[:5].tolist()}:
        places = np.flatnonzero(ids == value)
        for before in (0, size // 3, size):
            assert matrix.rank(value, before) == (ids[:before] == value).sum()
        for nth in (0, 1, len(places) - 1):
            expected = int(places[nth]) if 0 <= nth < len(places) else None
            assert matrix.select(value, nth) == expected
        assert matrix.select(value, len(places)) is None


def test_not_a_shard():
    with pytest.raises(ValueError):
        wavelet.unpack(b"something else, long enough for a header")


@pytest.mark.parametrize("shard_ids", [wavelet.SHARD_IDS, 50])
def test_files_hold_what_the_library_gives(spark, odd_docs, odd_texts, tmp_path, shard_ids):
    folder = str(tmp_path / "tokens")
    wavelet.write(odd_docs, folder, PATH, 2, shard_ids=shard_ids)
    found = sorted(wavelet.read(spark, folder).collect(), key=lambda r: r.start)
    library = Tokenizer.from_file(PATH)
    expected = {(str(i), np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for i, t in odd_texts}
    assert {(str(r.id), bytes(r.ids)) for r in found} == expected and len(found) == len(odd_texts)
    assert [r.id is not None for r in found] == sorted(r.id is not None for r in found)
    ids = [r.id for r in found if r.id is not None]
    assert ids == sorted(ids)
    at = 0
    for row in found:
        assert (row.start, row.n_ids) == (at, len(row.ids) // 4)
        at += row.n_ids


def test_empty(no_docs):
    assert wavelet.round_trip(no_docs, PATH, 2).count() == 0


def test_new_words_of_a_batch_are_merged_together(monkeypatch):
    encode, library = wordbpe.Encoder(PATH), Tokenizer.from_file(PATH)
    monkeypatch.setattr(wordbpe, "REMEMBERED", 40)  # words are forgotten and come back
    asked = []
    merged = encode._merged
    monkeypatch.setattr(encode, "_merged", lambda words: asked.append(len(words)) or merged(words))
    rng = np.random.default_rng(4)
    for _ in range(30):
        letters = rng.choice(list("abcéÀßÿ ,.中\n"), (20, 40))
        texts = ["".join(row) for row in letters.tolist()] + [None, "", "Éte ÄÖÜ <unk>"]
        found = [ids.tolist() for ids in encode.column(pa.array(texts, pa.string()))]
        assert found == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert len(asked) == 30  # once a batch, not once a word


def test_a_matrix_is_read_in_ids_of_its_own_width():
    ids = np.random.default_rng(1).integers(0, 1 << 16, 5000).astype("<u2")
    assert wavelet.WaveletMatrix.of(ids).all().dtype == np.uint16
    wide = np.random.default_rng(2).integers(0, 1 << 20, 5000).astype("<u4")
    assert (wavelet.WaveletMatrix.of(wide, 20).all() == wide).all()
