import csv
import io
import random

import pytest

from quayside.operators.measure import measure_files
from quayside.session import new_folder
from quayside.sources import quoted


def make_csv(rng, n_rows, line_end="\n"):
    words = ["a", "two words", "x,y", 'say "hi"', "line\nbreak", "\n\nblank\n", "", '"', "tail\n", 'q"\n"q']
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=line_end, quoting=csv.QUOTE_MINIMAL)
    writer.writerow(["ID", "T", "U"])
    rows = [[str(i), rng.choice(words), rng.choice(words)] for i in range(n_rows)]
    for row in rows:
        writer.writerow(row)
        if rng.random() < 0.1:
            out.write(line_end)
    return out.getvalue(), rows


@pytest.fixture
def tiny_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize(("seed", "split"), [(1, 90), (3, 1 << 20)])
@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_records_match_a_sequential_reader(spark, tmp_path, tiny_splits, seed, split, line_end):
    rng = random.Random(seed)
    expected, paths = {}, []
    for i, n_rows in enumerate((40, 1, 12)):
        content, rows = make_csv(rng, n_rows, line_end)
        path = tmp_path / f"f{i} x.csv"
        path.write_bytes(content.encode())
        paths.append(f"file:{path}")
        expected[paths[-1]] = rows
    tiny_splits(split)
    scratch = new_folder(spark, "test")
    records = quoted.quoted_records(spark, paths, scratch)
    counts = {r.file_uri.replace("%20", " "): r for r in quoted.record_counts(records).collect()}
    parsed = quoted.parse_records(quoted.record_texts(records), ["string"] * 3, "FAILFAST")
    found = {}
    for row in parsed.collect():
        found.setdefault(row.file_uri.replace("%20", " "), []).append([row.c0, row.c1, row.c2])
    for path, rows in expected.items():
        assert counts[path].records == len(rows)
        assert not counts[path].unclosed
        # the writer leaves empty fields unquoted, and those are NULL
        same = [[x if x != "" else None for x in row] for row in rows]
        assert sorted(found[path], key=lambda r: int(r[0])) == same


def test_only_files_with_open_quotes_are_numbered(spark, tmp_path):
    (tmp_path / "plain.csv").write_text('A,B\n1,"x, y"\n\n2,in"ch\n')
    (tmp_path / "broken.csv").write_text('A,B\n1,"x\n\ny"\n2,z\n')
    (tmp_path / "endless.csv").write_text('A,B\n1,"x\n2,z\n')
    paths = [f"file:{p}" for p in sorted(tmp_path.iterdir())]
    measured, _ = measure_files(spark, paths, new_folder(spark, "test"))
    rows = {r.file_path.rsplit("/", 1)[1]: r for r in measured.collect()}
    assert [rows[n].act_rows for n in ("plain.csv", "broken.csv")] == [2, 2]
    assert [rows[n].broken_lines for n in ("plain.csv", "broken.csv")] == [False, True]
    assert rows["endless.csv"].unclosed


def test_one_split_cannot_know_where_it_starts(spark, tmp_path, tiny_splits):
    """A field that spans many splits, with text inside that looks like records."""
    body = 'A,B\n1,"' + "fake,row\n" * 200 + '"\n2,z\n'
    (tmp_path / "f.csv").write_text(body)
    tiny_splits(64)
    records = quoted.quoted_records(spark, [f"file:{tmp_path}/f.csv"], new_folder(spark, "test"))
    assert records.splits.count() > 10
    assert quoted.record_counts(records).first().records == 2
    parsed = quoted.parse_records(quoted.record_texts(records), ["int", "string"], "FAILFAST")
    assert {r.c0: r.c1 for r in parsed.collect()} == {1: "fake,row\n" * 200, 2: "z"}


def test_a_record_too_long_to_be_gathered_fails_its_file(spark, tmp_path, tiny_splits, monkeypatch):
    monkeypatch.setattr(quoted, "MAX_RECORD_BYTES", 1000)
    (tmp_path / "long.csv").write_text('A,B\n1,"' + "fake,row\n" * 200 + '"\n2,z\n')
    (tmp_path / "short.csv").write_text('A,B\n1,"x\ny"\n2,"' + "a\n" * 50 + '"\n')
    tiny_splits(64)
    paths = [f"file:{p}" for p in sorted(tmp_path.iterdir())]
    measured, records = measure_files(spark, paths, new_folder(spark, "test"))
    assert {r.file_path.rsplit("/", 1)[1]: r.unclosed for r in measured.collect()} == {"long.csv": True, "short.csv": False}
    assert {r.record_no for r in quoted.record_texts(records.of(paths[1:])).collect()} == {1, 2, 3}


def test_only_fragments_at_edges_are_gathered(spark, tmp_path, tiny_splits):
    rng = random.Random(4)
    content, rows = make_csv(rng, 300)
    (tmp_path / "f.csv").write_text(content)
    tiny_splits(400)
    records = quoted.quoted_records(spark, [f"file:{tmp_path}/f.csv"], new_folder(spark, "test"))
    fragments = records.records.where("fragment").count()
    assert 0 < fragments <= 2 * records.splits.count()
    assert quoted.record_texts(records).count() == len(rows) + 1
