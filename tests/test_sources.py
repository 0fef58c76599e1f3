from types import SimpleNamespace

import pytest
from pyspark.sql import types as T

from millrace import session
from millrace.sources import csv, files, jdbc

SCHEMA = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("x", T.DoubleType())]
)


@pytest.fixture
def drop(tmp_path):
    def write(name, *lines):
        path = tmp_path / name
        path.write_text("".join(f"{line}\r\n" for line in lines))
        return str(path)

    return write


def test_inferred_scan_over_all_files(spark, drop, tmp_path):
    drop("a.csv", "id,day,scores", '1,9/1/2023,"[85, 90]"')
    drop("b.csv", "id,day,scores", "2,9/2/2023,")
    df = csv.scan_inferred(spark, str(tmp_path))
    assert dict(df.dtypes) == {"id": "int", "day": "string", "scores": "string"}
    assert {tuple(r) for r in df.collect()} == {(1, "9/1/2023", "[85, 90]"), (2, "9/2/2023", None)}


def test_declared_scan_binds_by_position(spark, drop):
    path = drop("a.csv", "x,id,n", "k,1,2.5", "l,many,3.5")
    df = csv.scan(spark, path, SCHEMA)
    assert [tuple(r) for r in df.collect()] == [("k", 1, 2.5), ("l", None, 3.5)]
    kept = csv.scan(spark, path, SCHEMA, keep_corrupt=True)
    assert [r[csv.CORRUPT] for r in kept.collect()] == [None, "l,many,3.5"]
    with pytest.raises(Exception, match="CSV header"):
        csv.scan(spark, path, SCHEMA, check_header=True).collect()


def test_listing_and_scan_take_csv_names_only(spark, drop, tmp_path):
    path = drop("a.csv", "id,n,x", "1,1,1")
    drop("notes.txt", "id,n,x", "2,2,2")
    listed = [r.path for r in files.listing(spark, str(tmp_path)).collect()]
    assert [p.rsplit("/", 1)[1] for p in listed] == ["a.csv"]
    rows = csv.with_source(csv.scan(spark, str(tmp_path), SCHEMA)).collect()
    assert [r[csv.SOURCE_FILE] for r in rows] == listed
    assert path.endswith("a.csv")


def test_jdbc_read_options():
    assert jdbc.read_options() == {}
    assert jdbc.read_options("id", 0, 100, 8, fetch_size=1000) == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100",
        "numPartitions": "8", "fetchsize": "1000",
    }
    with pytest.raises(ValueError, match="lowerBound"):
        jdbc.read_options("id", num_partitions=4)


def test_jdbc_needs_the_driver_it_is_given(spark):
    with pytest.raises(Exception, match="no.such.Driver"):
        jdbc.read_jdbc_table(spark, "jdbc:none:x", "t", "no.such.Driver")
    with pytest.raises(Exception, match="no.such.Driver"):
        jdbc.write_jdbc_table(spark.range(1), "jdbc:none:x", "t", "no.such.Driver", batch_size=10)


def test_shared_dir_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        assert session.shared_dir(spark) == configured.rstrip("/")
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_without_a_shared_folder_only_a_local_session_runs():
    class Context:
        def __init__(self, master):
            self.master, self.folder = master, None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    def fake(master, **conf):
        return SimpleNamespace(conf=conf, sparkContext=Context(master))

    local = fake("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local) == local.sparkContext.folder
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(fake("yarn"))
    cluster = fake("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert session.shared_dir(cluster) == "hdfs:///shared"


def test_staged_copy_is_exact_and_goes_away(spark):
    with session.staged(spark.range(5).selectExpr("id", "id * 2 as v")) as copy:
        path = copy.inputFiles()[0].rsplit("/", 1)[0]
        assert copy.count() == 5 and files.exists(spark, path)
        assert session.estimated_bytes(copy) < 10_000
    assert not files.exists(spark, path)
    assert session.broadcast_limit(spark) == 10 * 1024 * 1024
