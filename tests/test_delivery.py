from pyspark.sql import functions as F

from standins import delivery


def test_a_table_is_spread_by_its_text_not_by_its_compressed_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(delivery, "FILE_BYTES", 40_000)
    rows = spark.range(2000).select(F.col("id").alias("k"), F.lit("the same text, " * 10 + "again").alias("t"))
    rows.write.parquet(str(tmp_path / "rows.parquet"))  # some 10 kB
    source = spark.read.parquet(str(tmp_path / "rows.parquet"))
    sizes = [r["count"] for r in source.groupBy(delivery.spread(source, "k").alias("stamp")).count().collect()]
    assert 7 <= len(sizes) <= 9 and max(sizes) < 400

    back = delivery.round_trip(spark, str(tmp_path), "rows", "k")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, source.collect()))


def test_each_stamp_has_a_writer_of_its_own(spark):
    stamps = [f"2000{month:02d}01" for month in range(1, 13)]
    days = F.date_format(F.add_months(F.lit("2000-01-01").cast("date"), (F.col("id") % 13).cast("int")), "yyyyMMdd")
    texts = spark.range(1300).select("id", F.when(F.col("id") % 13 < 12, days).alias("stamp"))
    where = delivery.dealt(texts, stamps).groupBy(F.spark_partition_id().alias("at")).agg(
        F.count_distinct("stamp").alias("stamps"), F.count("*").alias("n")
    )
    found = {r["at"]: (r["stamps"], r["n"]) for r in where.collect()}
    assert found == {0: (0, 100)} | {at: (1, 100) for at in range(1, 13)}
    assert delivery.dealt(texts.limit(0), []).count() == 0


def test_a_delivery_is_written_without_a_sort(spark, monkeypatch):
    seen, at = [], delivery.dealt
    names = delivery.WRITE_SETTINGS
    before = {name: spark.conf.get(name) for name in names}

    def noted(texts, stamps):
        seen.append({name: spark.conf.get(name) for name in names})
        return at(texts, stamps)

    monkeypatch.setattr(delivery, "dealt", noted)
    made = delivery.Delivery(spark)
    rows = spark.range(30).select("id", F.lit(None).cast("string").alias("t"))
    made.put("ROWS", rows, F.when(F.col("id") < 25, F.lit("20000101")))
    assert seen == [names] and {name: spark.conf.get(name) for name in names} == before
    found = {(r.file_nm, r.col_cnt, r.row_cnt) for r in made.counts[0].collect()}
    assert found == {("ROWS_20000101.csv", 2, 25), (None, 2, 5)}
