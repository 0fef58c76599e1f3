import pytest
from pyspark.sql import functions as F

from millrace.plans.specs import schema_of
from millrace.sources import columntypes as c
from millrace.sources import headers
from millrace.sources.columntypes import scan_common, types_by_file

SCHEMA = schema_of("id string, n int, x double")


@pytest.fixture
def drop(tmp_path):
    def write(name, *lines):
        (tmp_path / name).write_text("".join(f"{line}\n" for line in lines))
        return str(tmp_path)

    return write


def test_matching_by_name():
    assert headers.match(["X", " id ", "N"], SCHEMA).columns == ("x", "id", "n")
    layout = headers.match(["id", "other"], SCHEMA)
    assert layout.columns == ("id", None) and layout.note == "missing: n, x; unknown: other"
    for header, reason in ((["a"], "no known"), (["id", "ID"], "twice"), (["x"], "missing: id")):
        with pytest.raises(ValueError, match=reason):
            headers.match(header, SCHEMA, ["id"])


def test_columns_bind_by_name_in_one_scan_per_layout(spark, drop, rows, plan):
    drop("a.csv", "id,n,x", "a,1,1.5")
    drop("b.csv", "x,id,n", "2.5,b,2")
    drop("c.csv", "id,n,x", "c,many,3.5")
    drop("d.csv", "more,id", "z,d")
    folder = drop("e.csv", '﻿id,"n"', "e,5")
    df = headers.scan_by_name(spark, folder, SCHEMA)
    assert rows(df) == [("a", 1, 1.5), ("b", 2, 2.5), ("c", None, 3.5), ("d", None, None), ("e", 5, None)]
    assert plan(df).count("FileScan csv") == 4
    drop("f.csv", "nothing", "1")
    with pytest.raises(ValueError, match="no known column"):
        headers.scan_by_name(spark, folder, SCHEMA)


def test_only_the_first_line_is_read(spark, drop):
    folder = drop("a.csv", "id,n", *["x" * 100] * 5)
    drop("empty.csv")
    found = headers.headers_of(spark, [f"file:{folder}/a.csv", f"file:{folder}/empty.csv", f"file:{folder}/absent.csv"])
    kinds = list(found.values())
    assert kinds[:2] == [["id", "n"], []] and isinstance(kinds[2], Exception)


def test_types_over_all_files(spark, drop, rows):
    drop("a.csv", "id,n,day,x", "1,1,2024-01-02,", "2,,,")
    folder = drop("b.csv", "n,id,day", "3000000000,k,2024-01-03", "1.5,4,nine")
    found = {(r.path.rsplit("/", 1)[1], r.column): (r.type, r.common, r.differs) for r in types_by_file(spark, folder).collect()}
    assert found["a.csv", "id"] == ("int", "string", True) and found["b.csv", "id"] == ("string", "string", False)
    assert found["a.csv", "n"] == ("int", "double", True) and found["b.csv", "n"] == ("double", "double", False)
    assert found["a.csv", "day"] == ("date", "string", True) and found["a.csv", "x"] == ("void", "void", False)
    df = scan_common(spark, folder)
    assert dict(df.dtypes) == {"id": "string", "n": "double", "day": "string", "x": "string"}
    assert rows(df.select("id", "n")) == [("1", 1.0), ("2", None), ("4", 1.5), ("k", 3e9)]


def test_type_lattice(spark):
    expected = {0: "void", c.INT: "int", c.INT | c.LONG: "bigint", c.LONG | c.DOUBLE: "double", c.DATE: "date",
                c.DATE | c.INT: "string", c.TEXT: "string", c.TEXT | c.DATE: "string"}
    got = spark.createDataFrame([(k,) for k in expected], "k int").select("k", c.type_of(F.col("k")).alias("t")).collect()
    assert {r.k: r.t for r in got} == expected


def test_files_of_a_folder_count_as_parts_of_one(spark, tmp_path):
    for name, line in (("d=1/a", "1"), ("d=1/b", "3000000000"), ("d=2/a", "x")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / f"{name}.csv").write_text(f"id\n{line}\n")
    found = types_by_file(spark, str(tmp_path), by_folder=True).collect()
    assert sorted((r.path.rsplit("/", 1)[1], r.type, r.common, r.differs) for r in found) == [("d=1", "bigint", "string", True), ("d=2", "string", "string", False)]


def test_a_look_at_the_text_rules_out_no_number(spark):
    texts = ["1", " 1\t", "+7", "-7", "-", "+", "", " ", "1.5", "1.", ".5", ".", "1e3", "1E-3", "1e", "1d", "1F", "1L", "0x1p3", "0x1.8p-1", "0xAp0", "2147483648", "9223372036854775808",
             "NaN", "nan", "inf", "-Infinity", "+INF", "infinite", "2024-01-02", "2024-13-02", "K12", "1 2", "1,5", "\x0012\x1f", "12\x7f", "١", " 1", "1e400", "--1", "1\n", None]
    v = F.col("v")
    slow = F.when(v.isNull(), 0).when(v.try_cast("int").isNotNull(), c.INT).when(v.try_cast("bigint").isNotNull(), c.LONG).when(
        v.try_cast("double").isNotNull(), c.DOUBLE).when(F.try_to_date(v, "yyyy-MM-dd").isNotNull(), c.DATE).otherwise(c.TEXT)
    got = spark.createDataFrame([(t,) for t in texts], "v string").select("v", c.kind_of(v, "yyyy-MM-dd").alias("kind"), slow.alias("expected")).collect()
    assert [r for r in got if r.kind != r.expected] == []


def test_the_types_query_writes_each_drop_in_many_tasks(spark, tmp_path, monkeypatch):
    from millrace.catalog import arrivals

    spark.range(4000).repartition(4).selectExpr(
        "id as o_orderkey", "id as o_custkey", "1.5 * id as o_totalprice", "date'2024-01-01' as o_orderdate", "substr('FOP', cast(id % 3 as int) + 1, 1) as o_orderstatus"
    ).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(arrivals, "scratch_path", lambda spark, name: str(tmp_path / "drops"))
    assert len(arrivals.csv_types_by_file(spark, str(tmp_path)).collect()) == 12
    assert len(list((tmp_path / "drops/o_orderstatus=F").glob("*.csv"))) > 1
