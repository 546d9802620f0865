from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starmart import catalog, schemas
from starmart.sources import arrivals as source
from starmart.sources import lookups, sinks


def table(lookup):
    return {(r.lookup, r.code): r.description for r in lookup.collect()}


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_lookup_files(spark, tmp_path):
    write(tmp_path, "i94prtl.csv", 'code,description\nALC,"ALCAN, AK"\nQQ ,PLAIN\nDBL,"THE ""BIG"" ONE"\nALC,"ALCAN, AK (NEW)"\n')
    write(tmp_path, "i94cntyl.csv", "note,description,code\nx, AVALON , 101 \ny,INVALID: X,0\n")
    write(tmp_path, "ignored.txt", "code,description\n1,2\n")
    assert table(lookups.read_csv_dir(spark, str(tmp_path))) == {
        ("i94prtl", "ALC"): "ALCAN, AK (NEW)",
        ("i94prtl", "QQ "): "PLAIN",
        ("i94prtl", "DBL"): 'THE "BIG" ONE',
        ("i94cntyl", "101"): "AVALON",
        ("i94cntyl", "0"): "INVALID: X",
    }
    assert ("i94prtl", "QQ") in table(lookups.read_csv_dir(spark, str(tmp_path), trim_codes=True))


def test_named_lookup_files(spark, tmp_path):
    write(tmp_path, "i94model.csv", "code,description\n1,Air\n")
    write(tmp_path, "i94addrl.csv", "code,description\nAL,ALABAMA\n")
    assert table(lookups.read_csv_dir(spark, str(tmp_path), names=["i94model"])) == {("i94model", "1"): "Air"}
    with pytest.raises(FileNotFoundError, match="i94prtl"):
        lookups.read_csv_dir(spark, str(tmp_path), names=["i94model", "i94prtl"])


def test_lookup_file_without_its_columns(spark, tmp_path):
    write(tmp_path, "i94model.csv", "code,text\n1,Air\n")
    with pytest.raises(ValueError, match="description"):
        lookups.read_csv_dir(spark, str(tmp_path))


def test_no_lookup_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        lookups.read_csv_dir(spark, str(tmp_path))


def test_required_lookups():
    lookups.require(schemas.REQUIRED_LOOKUPS)
    with pytest.raises(ValueError, match="i94model"):
        lookups.require(["i94cntyl", "i94prtl"])


CATALOG = """
libname library 'x' ;
proc format library=library ;
value i94cntyl
   582 =  'MEXICO Air Sea, and Not Reported'
   007 =  ' AVALON '
   7 = 'AVALON AGAIN'
   none = 'No Country'
   a line without the sign
;
value $i94prtl
\t'ALC'\t=\t'ALCAN, AK             '
\t'QQ '\t=\t'EQ = SIGN'
;
value i94model
\t1 = 'Air'
\t2 = 'Sea' ;
"""


def test_format_catalog(spark, tmp_path):
    write(tmp_path, "formats.sas", CATALOG)
    rows = lookups.from_format_catalog(spark, str(tmp_path / "formats.sas"))
    assert table(rows) == {
        ("i94cntyl", "582"): "MEXICO Air Sea, and Not Reported",
        ("i94cntyl", "7"): "AVALON AGAIN",
        ("i94cntyl", "none"): "No Country",
        ("i94prtl", "ALC"): "ALCAN, AK",
        ("i94prtl", "QQ "): "EQ = SIGN",
        ("i94model", "1"): "Air",
        ("i94model", "2"): "Sea",
    }


def test_lookups_written_and_read_back(spark, tmp_path):
    write(tmp_path, "formats.sas", CATALOG)
    rows = lookups.from_format_catalog(spark, str(tmp_path / "formats.sas"))
    out = str(tmp_path / "staging")
    lookups.write_csv(rows, out)
    back = lookups.read_csv_dir(spark, out)
    assert table(back) == table(rows)
    assert lookups.names(back) == ["i94cntyl", "i94model", "i94prtl"]
    named = lookups.by_name(back)
    assert {r.code for r in named["i94model"].collect()} == {"1", "2"}


def test_catalog_command(spark, tmp_path):
    write(tmp_path, "formats.sas", CATALOG)
    out = str(tmp_path / "staging")
    assert catalog.main([str(tmp_path / "formats.sas"), out, "--partial"]) == 0
    assert lookups.names(lookups.read_csv_dir(spark, out)) == ["i94cntyl", "i94model", "i94prtl"]
    write(tmp_path, "few.sas", "value i94model 1 = 'Air' ;")
    with pytest.raises(ValueError):
        catalog.main([str(tmp_path / "few.sas"), out])


def test_arrivals_from_several_folders(spark, tmp_path, arrivals):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    arrivals({}, {"cicid": 2.0}).coalesce(1).write.parquet(one)
    arrivals({"cicid": 3.0}).write.parquet(two)
    rows = source.read(spark, one, two, schema=schemas.ARRIVALS, drop_columns=["gender", "not there"], origin=True)
    assert "gender" not in rows.columns
    assert sorted(r.cicid for r in rows.collect()) == [1.0, 2.0, 3.0]
    assert rows.select("source_file", "source_row").distinct().count() == 3
    plan = source.read(spark, one, schema=schemas.ARRIVALS).select("cicid")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<cicid:double>" in plan
    assert ("cicid", "double") in source.fields(rows)
    assert [r.cicid for r in source.peek(rows, 2, by=["cicid"]).collect()] == [1.0, 2.0]
    both = source.read(spark, one).unionByName(source.read(spark, two))
    assert both.count() == 3


def test_corrupt_file_fails_unless_told_otherwise(spark, tmp_path, arrivals):
    folder = tmp_path / "in"
    arrivals({}).coalesce(1).write.parquet(str(folder))
    (folder / "part-broken.parquet").write_bytes(b"PAR1 this is no parquet file PAR1")
    with pytest.raises(Exception):
        source.read(spark, str(folder), schema=schemas.ARRIVALS).collect()
    assert source.read(spark, str(folder), schema=schemas.ARRIVALS, skip_corrupt=True).count() == 1


def test_sample_takes_the_share(spark):
    assert source.sample(spark.range(100), 1_000_000, 40_000_000).count() < 20
    assert source.sample(spark.range(100), 10, 5).count() == 100


def test_rows_with_a_schema(spark):
    rows = lookups.from_rows(spark, [("1", None)])
    assert rows.schema == schemas.LOOKUP and rows.count() == 1


def test_table_formats_and_row_counts(spark, tmp_path):
    rows = spark.range(10).select("id", (F.col("id") % 3).alias("part"))
    assert sinks.write_table(rows, str(tmp_path / "p")) == 10
    assert sinks.write_table(rows.limit(4), str(tmp_path / "p")) == 4
    assert spark.read.parquet(str(tmp_path / "p")).count() == 4
    assert sinks.write_table(rows, str(tmp_path / "c"), fmt="CSV") == 10
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["id", "part"]
    assert sinks.write_table(rows, str(tmp_path / "m"), partition_by="part") == 10
    assert spark.read.parquet(str(tmp_path / "m")).where("part = 1").count() == 3
    with pytest.raises(ValueError):
        sinks.write_table(rows, str(tmp_path / "x"), fmt="xml")


def test_samples_have_as_many_rows_of_each_file(spark, tmp_path, arrivals):
    import hashlib

    folder = str(tmp_path / "in")
    for rows in (200, 37, 5):
        arrivals(*[{"cicid": float(i)} for i in range(rows)]).coalesce(1).write.mode("append").parquet(folder)
    raw = source.read(spark, folder, schema=schemas.ARRIVALS, origin=True)
    want = set()
    files = {}
    for r in raw.collect():
        files.setdefault(r.source_file, []).append((hashlib.md5(f"{r.source_file}#{r.source_row}".encode()).hexdigest()[:13], r.source_row))
    for file, rows in files.items():
        want |= {(file, row) for _, row in sorted(rows)[:20]}
    for parts in (1, 7):
        got = source.sample_files(raw.repartition(parts), 20)
        assert got.columns == raw.columns
        assert {(r.source_file, r.source_row) for r in got.collect()} == want and got.count() == len(want) == 45
    odd = spark.createDataFrame([(None, 1), (None, 1), (None, 1), ("a", None)], "g string, k int")
    assert source.sample_rows(odd, 2, "k", "g").count() == 3 and source.sample_rows(odd.limit(0), 2, "k", "g").count() == 0
