import pytest
from pyspark.sql import functions as F

from quayside.plans.probe import matching_files, probe_files
from quayside.sources import catalog, hadoop
from quayside.sources.files import CSV_FORMAT, read_records, rows_per_file
from quayside.sources.folder import list_folder, waiting_files
from quayside.sources.manifest import read_all_manifests, read_manifest


@pytest.fixture
def zone(tmp_path):
    for path, text in {
        "HDS/RDS_Inventory_HDS.csv": "FILE_NM,COL_CNT,ROW_CNT,DATE,OWNER\n F_20260914.csv ,2, 20 ,2026-09-14,TEAM\n,1,1,,\nG.csv,n/a,19.6,,\n",
        "IHP/RDS_Inventory_IHP.csv": "FILE_NM,COL_CNT,ROW_CNT,DATE,OWNER\nP_20260914.csv,13,18,2026-09-14,OTHER\n",
        "HDS/F_20260914.csv": 'A,B\n1,"x\ny"\n2,z\n',
        "HDS/History/F_20260913.csv": "A,B\n1,2\n",
        "HDS/rds_inventory_old.csv": "x\n",
        "HDS/deep/N_20260914.csv": "A\n",
        "HDS/empty.csv": "",
        "IHP/P_20260914.csv": "A,B,C\n1,2,3\n\n4,5,6\n",
    }.items():
        target = tmp_path / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(text)
    return str(tmp_path)


def names(df):
    return sorted(r.relative_path for r in df.collect())


def test_listing_sees_empty_files_and_can_skip_folders(spark, zone):
    listing = list_folder(spark, zone)
    assert "HDS/empty.csv" in names(listing) and "HDS/History/F_20260913.csv" in names(listing)
    below = list_folder(spark, zone, "HDS/", skip=("HDS/History/",))
    assert "HDS/History/F_20260913.csv" not in names(below)
    assert all(n.startswith("HDS/") for n in names(below))
    assert list_folder(spark, zone, "NOPE/").count() == 0


def test_waiting_files(spark, zone):
    waiting = waiting_files(list_folder(spark, zone), "HDS/", "HDS/History/", "RDS_Inventory")
    assert names(waiting) == ["HDS/F_20260914.csv", "HDS/deep/N_20260914.csv", "HDS/empty.csv"]
    placeholder = spark.createDataFrame([("HDS/",), ("hds/x.csv",)], "relative_path string")
    assert waiting_files(placeholder, "HDS/", "HDS/History/", "RDS_Inventory").count() == 0


def test_manifest(spark, zone):
    rows = {r.file_nm: r for r in read_manifest(spark, f"{zone}/HDS/RDS_Inventory_HDS.csv").collect()}
    assert set(rows) == {"F_20260914.csv", "G.csv"}
    assert (rows["F_20260914.csv"].col_cnt, rows["F_20260914.csv"].row_cnt) == (2, 20)
    assert (rows["G.csv"].col_cnt, rows["G.csv"].row_cnt) == (None, 20)
    assert rows["F_20260914.csv"].owner == "TEAM"
    assert read_manifest(spark, f"{zone}/HDS/none.csv").count() == 0


def test_all_manifests(spark, zone):
    rows = read_all_manifests(spark, zone, "RDS_Inventory").collect()
    assert sorted(r.inventory_file.rsplit("/", 1)[1] for r in rows) == [
        "RDS_Inventory_HDS.csv"
    ] * 3 + ["RDS_Inventory_IHP.csv"]
    assert {r.file_date for r in rows if r.owner == "OTHER"} == {"2026-09-14"}


def test_probe(spark, zone):
    pattern = r".*(F|P)_[0-9]{8}[.]csv"
    assert len(names(matching_files(spark, zone, pattern))) == 3
    found = {r.file_path.rsplit("/", 1)[1]: r for r in probe_files(spark, zone, pattern).collect()}
    assert {n: (r.actual_col_cnt, r.actual_row_cnt) for n, r in found.items()} == {
        "F_20260914.csv": (2, 2),
        "F_20260913.csv": (2, 1),
        "P_20260914.csv": (3, 2),
    }


def test_probe_is_anchored(spark, zone):
    assert names(matching_files(spark, zone, "F_[0-9]{8}")) == []


def test_rows_per_file(spark, zone):
    schema = spark.createDataFrame([], "a string, b string, c string").schema
    scan = read_records(spark, [f"{zone}/IHP/P_20260914.csv"], schema).withColumn(
        "file_path", F.col("file_uri")
    )
    assert rows_per_file(scan, ".*P_.*").first().actual_row_cnt == 2


def test_csv_format(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text('A,B,C\n"q ""x"" y",  padded  ,"  kept  "\n"",,\\N\n   ,x,y\n\n  \n')
    rows = spark.read.schema("A string, B string, C string").options(
        header=True, mode="FAILFAST", **CSV_FORMAT
    ).csv(str(path)).collect()
    assert [tuple(r) for r in rows] == [
        ('q "x" y', "padded", "  kept  "),
        ("", None, None),
        (None, "x", "y"),
    ]


def test_move_replaces_and_reports(spark, tmp_path):
    (tmp_path / "a").write_text("new")
    (tmp_path / "b").write_text("old")
    hadoop.move(spark, f"{tmp_path}/a", f"{tmp_path}/b")
    assert (tmp_path / "b").read_text() == "new" and not (tmp_path / "a").exists()
    with pytest.raises(FileNotFoundError):
        hadoop.move(spark, f"{tmp_path}/a", f"{tmp_path}/b")
    assert (tmp_path / "b").read_text() == "new"


def test_catalog(spark, tmp_path):
    spark.sql("create database if not exists cat_t")
    spark.sql("create table if not exists cat_t.base_20240101 (a int) using parquet")
    spark.sql("create or replace view cat_t.v comment 'to base' as select * from cat_t.base_20240101")
    spark.range(1).createOrReplaceTempView("of_the_session")
    assert {t.name for t in catalog.entries(spark, "cat_t")} == {"base_20240101", "v"}
    listed = catalog.list_catalog(spark, "cat_t")
    assert [r.table_nm for r in catalog.base_tables(listed).collect()] == ["BASE_20240101"]
    assert [(r.table_nm, r.comment) for r in catalog.views(listed).collect()] == [("V", "to base")]
    assert catalog.list_catalog(spark, "no_such").count() == 0
