import hashlib
import os
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

import corpus_pipeline
from quayside.llm import bpe
from quayside.llm.common import snapshot

from .test_pii import brute as spans_of
from .test_posindex import words
from .test_simhash import brute as near

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")


def test_stages_keep_columns_and_clean_rows(spark):
    docs = corpus_pipeline.table(spark, SF_DIR, "documents")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, snapshot(stage(spark, docs, SF_DIR), name)
        sizes.append(docs.count())
        assert {r.doc_id for r in docs.select("doc_id").collect()} <= {r.doc_id for r in before.select("doc_id").collect()}
        if name != "tokens":
            assert docs.columns == COLUMNS
    assert sizes[0] == sizes[1] >= sizes[2] >= sizes[3] == sizes[4] == sizes[5] > 0.8 * sizes[0]


def fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k : k + 3]), 42) for k in range(max(1, len(words) - 2))] if words else []
    return sum((2 * sum(h >> bit & 1 for h in hashes) > len(hashes)) << bit for bit in range(64))


def plain_pipeline(rows, items):
    """The five stages on (id, text) rows with distinct ids, one document after another."""
    kept = [(i, t) for i, t in rows if t is not None and any(c.isalpha() for c in t)]
    groups = near([fingerprint(t) for _, t in kept], 2)
    least = {}
    for group, (i, _) in zip(groups, kept):
        least[group] = min(i, least.get(group, i))
    kept = [(i, t) for i, t in kept if i in set(least.values())]
    asked = set()
    for _, text in items:
        own = words(text)
        asked |= {tuple(own[k : k + 10]) for k in range(max(1, len(own) - 9))} if own else set()
    by_width = {n: {w for w in asked if len(w) == n} for n in {len(w) for w in asked}}

    def leaked(text):
        own = words(text)
        return any(tuple(own[k : k + n]) in those for n, those in by_width.items() for k in range(len(own) - n + 1))

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    for doc_id, text in kept:
        if leaked(text):
            continue
        out, at = [], 0
        for start, end, kind in sorted((a, b, k) for k, spans in spans_of(text).items() for a, b in spans):
            if start >= at:
                out += [text[at:start], f"[{kind.upper()}]"]
            at = max(at, end)
        clean = "".join([*out, text[at:]])
        ids = np.array(library.encode_ordinary(clean), dtype="<u4").tobytes()
        yield doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(clean.encode()).hexdigest()


def test_rows_are_those_of_the_plain_version(spark):
    rows = [(r.doc_id, r.text) for r in corpus_pipeline.table(spark, SF_DIR, "documents").collect()]
    items = [(r.item_id, r.text) for r in corpus_pipeline.table(spark, SF_DIR, "benchmark").collect()]
    found = corpus_pipeline.run(spark, SF_DIR).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert len(rows) > len(found) > 0.8 * len(rows)
    assert sorted(map(tuple, found)) == sorted(plain_pipeline(rows, items))


def test_odd_rows_pass_every_stage(spark, odd_docs, no_docs):
    docs = no_docs
    for name, stage in corpus_pipeline.STAGES:
        docs = snapshot(stage(spark, docs, SF_DIR), name)
        assert docs.count() == 0
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, snapshot(stage(spark, docs, SF_DIR), name)
        assert docs.columns == odd_docs.columns
        # a stage may change texts and their sizes, and nothing else
        others = [c for c in docs.columns if c not in ("text", "n_chars")]
        assert {str(r) for r in docs.select(others).collect()} <= {str(r) for r in before.select(others).collect()}
    # 2 and 3 near 1 only if their fingerprints are, 4 to 7 have no language
    docs = odd_docs
    for _, stage in corpus_pipeline.STAGES[:2]:
        docs = stage(spark, docs, SF_DIR)
    found = [r.doc_id for r in docs.collect()]
    assert {1, 8, 9, 10, 11, 12, None} <= set(found) and not {2, 4, 5, 6, 7} & set(found)


def test_contaminated_rows_go_by_id_and_text(spark, tmp_path):
    leaked = " ".join(f"word{k}" for k in range(12))
    spark.createDataFrame([("i", leaked)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, f"x {leaked}"), (1, "clean"), (None, leaked), (None, "clean too"), (None, None), (2, leaked)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in left) == [("1", "clean"), ("None", "None"), ("None", "clean too")]
