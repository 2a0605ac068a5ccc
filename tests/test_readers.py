import pytest
from pyspark.errors import AnalysisException

from ledgerlake.schemas import FLAT_SCHEMA
from ledgerlake.session import fit_shuffles, fit_to_input, shuffle_partitions
from ledgerlake.sources.readers import read_flat_csv, read_parquet


def test_row_positions_over_one_and_several_files(spark, tmp_path):
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    spark.range(100).selectExpr("id * 3 AS v").coalesce(1).write.parquet(one)
    rows = read_parquet(spark, one).collect()
    assert all(r["_source_row"] * 3 == r["v"] for r in rows)
    spark.range(100).selectExpr("id * 3 AS v").repartition(7).write.parquet(many)
    first = {r["v"]: r["_source_row"] for r in read_parquet(spark, many).collect()}
    assert sorted(first.values()) == list(range(100))
    again = {r["v"]: r["_source_row"] for r in read_parquet(spark, many).repartition(3).collect()}
    assert again == first


def test_flat_csv(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    header = ",".join(FLAT_SCHEMA.fieldNames())
    path.write_text(f"{header}\nL1,A,2025-01-01,C1,Laptop,Computers,Austin,three,1.5,0.1,PayPal\nL2,A,31/31/2025,C1,Laptop,Computers,,2,1.5,0.1,\n")
    rows = read_flat_csv(spark, str(path), str(tmp_path / "scratch")).orderBy("_source_row").collect()
    assert [(r["Order_Line_ID"], r["Quantity"], r["City"], r["_source_row"]) for r in rows] == [("L1", "three", "Austin", 0), ("L2", "2", None, 1)]


def test_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_parquet(spark, str(tmp_path / "nothing"))
    with pytest.raises(AnalysisException):
        read_flat_csv(spark, str(tmp_path / "nothing.csv"), str(tmp_path / "scratch"))


def test_partitions_are_only_raised(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    before = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert fit_to_input(spark, path) == before


def test_csv_rows_are_numbered_as_they_stand(spark, tmp_path):
    """Also over several files and many splits, and with equal lines."""
    folder, header = tmp_path / "sheet", ",".join(FLAT_SCHEMA.fieldNames())
    folder.mkdir()
    names = [f"L{(i * 7919) % 600}" if i % 5 else "same" for i in range(600)]
    for f in range(3):
        lines = [f"{n},A,2025-01-01,C1,Laptop,Computers,Austin,1,1.5,0.1,PayPal" for n in names[f * 200 : f * 200 + 200]]
        (folder / f"part-{f}.csv").write_text("\n".join([header, *lines]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = read_flat_csv(spark, str(folder), str(tmp_path / "scratch")).orderBy("_source_row").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["_source_row"] for r in rows] == list(range(600))
    assert [r["Order_Line_ID"] for r in rows] == names


def test_partitions_grow_slower_than_very_large_inputs():
    assert [shuffle_partitions(n << 20) for n in (0, 63, 640)] == [0, 0, 10]
    assert shuffle_partitions(1 << 40) == 16_384
    assert 90_000 < shuffle_partitions(100 << 40) < 110_000
    sizes = [1 << n for n in range(20, 50)]
    assert sorted(map(shuffle_partitions, sizes)) == [shuffle_partitions(n) for n in sizes]


def test_given_partitions_are_never_lowered(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.range(10).write.parquet(f"{tmp_path}/t")
    assert fit_shuffles(spark, f"{tmp_path}/t") == int(before) == int(spark.conf.get("spark.sql.shuffle.partitions"))
