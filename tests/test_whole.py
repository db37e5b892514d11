"""Queries over all rows of their tables: against their SQL without the filters that it has."""

from oracle_check import connect, same

from malgeul.plans import catalog, oracle
from malgeul.sources import io

SF = "/root/testdata/sf0.001"


def whole(name, cut):
    return oracle.SQL[name].replace(cut, "")


def test_weighted_means_of_all_utterances(spark):
    """sf0.1 has conversations from 150 on, sf0.001 documents without one."""
    for sf in ("/root/testdata/sf0.1", SF):
        same(spark, connect(sf), catalog.a5_weighted_means, whole("a5_weighted_means", " WHERE doc_id < 150"), sf)


def test_overlaps_with_all_lines(spark, tmp_path):
    same(spark, connect(SF), catalog.j5_overlaps, whole("j5_overlaps", " WHERE l_linenumber <= 3"), SF)
    lines = [(1, 1, 10.0), (1, 2, 30.0), (1, 5, 9.0), (2, 1, 10.0), (2, 7, 20.0)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert dict(map(tuple, catalog.j5_overlaps(spark, str(tmp_path)).collect())) == {1: True, 2: False}


def test_bucket_files_of_all_splits(spark, tmp_path):
    same(spark, connect(SF), catalog.s14_bucket_files, whole("s14_bucket_files", " WHERE language = 'fr'"), SF)
    rows = [("01", "1", "B"), ("01", "2", "C"), ("x/y=z", "3", "A"), (None, "4", None)]
    io.write_buckets(spark.createDataFrame(rows, "split string, sentence_id string, bucket string"), f"{tmp_path}/b")
    made = io.read_written_buckets(spark, f"{tmp_path}/b").select("split", "sentence_id", "bucket")
    assert sorted(map(tuple, made.collect()), key=lambda r: r[1]) == [*rows[:3], (None, "4", "unknown")]
    io.write_buckets(spark.createDataFrame([], "split string, sentence_id string, bucket string"), f"{tmp_path}/none")
    assert io.read_written_buckets(spark, f"{tmp_path}/none").count() == 0
