import random
import re

import pytest

from quayside.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return {k: [m.span() for m in re.finditer(p, text) if valid(k, m[0])] for k, p in PLAIN.items()}


@pytest.fixture(scope="module")
def strange(spark, odd_docs, odd_texts):
    rng = random.Random(11)
    alphabet = ["@", ".", "-", "+", " ", "_", "(", ")", "é", "\U0001f600", "a", "B", "1", "25", "255", "0" * 30, "4111 1111 1111 1111"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    texts += ["a@b.c_d@e.f", "x@y.z@u.v.w", "1.2.3.4.5.6.7.8", "+1 (555) 010-9999+44 20 7946 0018", "4111-1111-1111-1111 0", "a" * 20000 + "@", "1 " * 9000]
    docs = [(100 + k, t) for k, t in enumerate(texts)] + odd_texts
    return spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, start int, kind string"), docs


def test_base_spans_as_plain_patterns(strange):
    frame, docs = strange
    found = pii.find(frame).collect()
    assert len(found) == len(docs)
    got = sorted(str((str(r.id), {k: [(s.start, s.end) for s in r[k]] for k in pii.KINDS})) for r in found)
    assert got == sorted(str((str(i), brute(t or ""))) for i, t in docs)


@pytest.fixture(scope="module")
def letters(spark):
    rng = random.Random(5)
    filler = lambda: " ".join(rng.choice(["some", "words", "that", "mean", "little"]) for _ in range(12))
    rows = [(k, f"{filler()} please ring +1 (555) 010-{k:04d} {filler()}") for k in range(40)]
    rows += [(50, f"{filler()} please ring 0171-5550199, {filler()}"), (51, f"{filler()} in year 19990101 {filler()}"), (52, None)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_contexts_discover_what_no_pattern_knows(letters):
    rows = {r.id: r for r in pii.find(letters).collect()}
    assert [m.kind for m in rows[50].more] == ["phone"]
    assert all(not r.more for k, r in rows.items() if k != 50)
    assert rows[50].phone == [] and len(rows[7].phone) == 1


def test_redaction(letters, odd_docs, no_docs):
    clean = {r.doc_id: r.text for r in pii.redact(letters).collect()}
    assert "please ring [PHONE], " in clean[50] and "19990101" in clean[51] and clean[52] is None
    assert all(" please ring [PHONE] " in clean[k] for k in range(40))
    odd = pii.redact(odd_docs)
    assert odd.columns == odd_docs.columns and odd.count() == odd_docs.count()
    texts = [r.text for r in odd.collect() if r.doc_id in (None, 12)]
    assert "a text without an id, write to [EMAIL] or [PHONE] now" in texts
    assert any(t and t.startswith("card [CARD], ip [IP], bad ip 10.0.0.256") for t in texts)
    assert pii.redact(no_docs).count() == 0 and pii.find(no_docs).count() == 0


def test_discovered_identifiers_are_seeds_and_found_everywhere(spark):
    rows = [(k, f"so please ring +1 (555) 010-{k:04d} now") for k in range(60)]
    # the first numbers no base pattern knows, in a known context and in one that only they give away
    rows += [(100 + k, f"so please ring 0171-55501{k:02d} now") for k in range(10)]
    rows += [(200 + k, f"or the fax line 0171-55501{k:02d} now") for k in range(10)]
    rows += [(300, "or the fax line 0171-7770000 now"), (301, "0171-7770000 is new"), (302, "at number 0171-5550101 we are"), (303, "in year 19990101 it was")]
    found = {r.id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k for k, r in found.items() if r.more} == {*range(100, 110), *range(200, 210), 300, 301, 302}
    assert {m.kind for r in found.values() for m in r.more} == {"phone"}
    assert [(m.start, m.end) for m in found[301].more] == [(0, 12)]
