import gzip
import hashlib
import io

import pytest

from quayside.llm import warc


def test_members_in_any_ranges():
    payloads = [b"", b"x" * 3000, bytes(range(256)) * 40, b"\x1f\x8b\x08 not a member \x1f\x8b\x08"]
    raw, places = b"", []
    for k, payload in enumerate(payloads):
        places.append(len(raw))
        record = warc.record(k, f"http://e/{k}", payload, hashlib.sha1(payload).hexdigest(), None)
        # stored blocks keep the magic of a payload readable inside a member
        raw += gzip.compress(record, 0 if k == 3 else 6, mtime=0)
    places.append(len(raw))
    raw += gzip.compress(b"not a record of ours, only a member" * 9, mtime=0)
    for step in (1, 7, 100, 997, len(raw)):
        found = []
        for begin in range(0, len(raw), step):
            found += warc.members(io.BytesIO(raw), begin, begin + step, len(raw))
        assert [at for at, _ in found] == places[:4], step
        assert [warc.parse(r)["payload"] for _, r in found] == payloads


PAGES = [
    (1, "http://a", "same" * 300), (2, "http://b", "same" * 300), (5, None, "same" * 300), (3, "http://c/é \n", "short"),
    (4, "http://d", "short"), (6, "", None), (7, "u", ""), (8, "u", "é" * 500), (9, "u", "é" * 500), (9, "u", "é" * 500),
    (None, "u", "é" * 500), (None, "u", "n" * 2000), (10, "u", "x" * 999), (11, "u", "x" * 999), (12, "u", "long " * 400000),
]


@pytest.mark.parametrize("range_bytes", [warc.RANGE_BYTES, 300])
def test_archives(spark, tmp_path, range_bytes):
    pages = spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, digest string, size int")
    folder = str(tmp_path / "archives")
    assert sum(r.records for r in warc.write(pages, folder).collect()) == len(PAGES)
    found = warc.read(spark, folder, range_bytes).collect()
    size = lambda text: len((text or "").encode())
    expected = []
    for page_id, _, html in PAGES:
        same = [p[0] for p in PAGES if (p[2] or "") == (html or "") and p[0] is not None]
        newest = max(same, default=None)
        again = size(html) >= 1000 and newest is not None and page_id != newest
        expected.append((str(page_id), size(html), hashlib.sha1((html or "").encode()).hexdigest(), "revisit" if again else "response", newest if again else None))
    assert sorted(map(str, expected)) == sorted(str((str(r.page_id), r.payload_bytes, r.digest, r.record_type, r.refers_to)) for r in found)
    for row in found:
        if row.record_type == "response":
            assert hashlib.sha1(bytes(row.payload)).hexdigest() == row.digest
        else:
            assert row.payload is None
    assert {r.page_id: r.url for r in found}[5] is None


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(pages).count() == 0


def test_archives_of_lost_attempts_are_not_read(spark, tmp_path):
    pages = spark.createDataFrame([(k, f"http://x/{k}", f"<p>{k}</p>" * 20) for k in range(30)], "page_id long, url string, html string")
    folder = f"file:{tmp_path}/warc"
    archives = warc.write(pages.repartition(3), folder)
    written = sorted(p.name for p in (tmp_path / "warc").iterdir() if p.name.endswith(".warc.gz"))
    assert written == sorted(r.archive for r in archives.collect()) and sum(r.records for r in archives.collect()) == 30
    for name in written:  # as a speculative attempt leaves them
        (tmp_path / "warc" / f"{name[:14]}-0123456789ab.warc.gz").write_bytes((tmp_path / "warc" / name).read_bytes())
    assert sorted(r.page_id for r in warc.read(spark, folder, archives=archives).collect()) == list(range(30))
