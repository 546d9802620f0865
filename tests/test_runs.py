from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from starmart import schemas, session
from starmart.operators import rules
from starmart.plans import etl, reports
from starmart.sources import arrivals as source
from starmart.sources import runs, sinks
from tests.test_job import paths  # noqa: F401
from tests.test_rules import BAD


def tables_of(where):
    found = {}
    for root in where[2:]:
        for name in sorted(os.listdir(root)):
            if not name.startswith((".", "_")):
                found[name] = sorted(f for f in os.listdir(f"{root}/{name}") if f.endswith(".parquet"))
    return found


def test_a_failed_write_leaves_all_old_tables(spark, paths, monkeypatch):  # noqa: F811
    where = paths({}, {"cicid": 2.0}, BAD["age"])
    first = etl.run(spark, *where)
    old = tables_of(where)
    assert set(old) == set(first.rows) and runs.manifest(spark, where[2])["rows"] == first.rows
    write, calls = sinks.write_observed, []

    def failing(*args, **options):
        calls.append(args[1])
        if len(calls) == 7:  # the staged rows are the first
            raise OSError("disk full")
        return write(*args, **options)

    monkeypatch.setattr(sinks, "write_observed", failing)
    with pytest.raises(OSError):
        etl.run(spark, *where)
    assert tables_of(where) == old and not [n for root in where[2:] for n in os.listdir(root) if n.startswith("_run")]
    monkeypatch.undo()
    assert etl.run(spark, *where).rows == first.rows and tables_of(where) != old


def test_a_publication_that_broke_off_is_finished(spark, paths, monkeypatch):  # noqa: F811
    where = paths({}, BAD["age"])
    etl.run(spark, *where)
    spark.read.parquet(where[0]).where("i94bir >= 0").coalesce(1).write.parquet(where[0] + "_good")
    move, moved = session.move, []

    def dying(*args):
        if len(moved) == 4:
            raise KeyboardInterrupt
        moved.append(args)
        move(*args)

    monkeypatch.setattr(session, "move", dying)
    with pytest.raises(KeyboardInterrupt):
        etl.run(spark, where[0] + "_good", *where[1:])
    monkeypatch.undo()
    assert runs.manifest(spark, where[2])["state"] == "publishing"
    assert reports.load(spark, where[2])[schemas.FACT].count() == 1
    assert runs.manifest(spark, where[2])["state"] == "published"
    assert spark.read.parquet(f"{where[3]}/{schemas.REJECTED}").count() == 0
    assert not [n for root in where[2:] for n in os.listdir(root) if n.startswith("_run")]
    assert runs.settle(spark, where[3]) is None  # nothing was published under that folder


def test_counts_that_disagree_stop_the_run(spark, paths, monkeypatch):  # noqa: F811
    where = paths({}, {"cicid": 2.0}, BAD["age"], BAD["port"])
    result = etl.run(spark, *where)
    assert result.ledger == {"raw": 4, "clean": 2, "rejected": 2, "summarised": 2, "judged": 4, "counted_rejected": 2}
    old = tables_of(where)
    quarantine = rules.quarantine
    monkeypatch.setattr(rules, "quarantine", lambda rejected: quarantine(rejected).limit(1))
    with pytest.raises(runs.Unbalanced, match="raw 4 is not clean 2 . rejected 1"):
        etl.run(spark, *where)
    assert tables_of(where) == old


def test_the_manifest_is_whole_or_as_it_was(spark, tmp_path):
    path = str(tmp_path / "m.json")
    assert session.read_text(spark, path) is None
    for text in ("", "{}", json.dumps({"é": [1]})):
        session.write_text(spark, path, text)
        assert session.read_text(spark, path) == text
    assert os.listdir(tmp_path).count("m.json") == 1 and not [n for n in os.listdir(tmp_path) if n.endswith(".new")]


def shared_rules(df):
    """Three rules that need a share of all rows: one that is met, one that is just not, one that never is."""
    rule = lambda name, condition, share: rules.Rule(name, f"{name} reason", condition, ("i94bir",), ("i94bir",), min_share=share)
    return [rule("old", F.col("i94bir") > 60, 0.36), rule("young", F.col("i94bir") < 20, 0.21), rule("all", F.col("i94bir") >= 0, 1.1), *rules.default_rules(df)[:2]]


def test_shares_are_taken_while_the_rows_are_staged(spark, paths, named):  # noqa: F811
    ages = [70.0, 80.0, 90.0, 5.0, 10.0, 30.0, 40.0, 61.0, None, 50.0]
    where = paths(*[{"cicid": float(i), "i94bir": age} for i, age in enumerate(ages)], BAD["port"])
    raw = source.read(spark, where[0], origin=True)
    deferred, checks = etl.check(raw, named, shared_rules, defer=True)
    plan = deferred._jdf.queryExecution().optimizedPlan().toString()
    assert "subquery" not in plan.lower() and plan.count("parquet") == 1
    at_once, _ = etl.check(raw, named, shared_rules)
    want = {(r.cicid, r.rejection_reason) for r in at_once.where("is_rejected").collect()}
    seen = deferred.agg(F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in rules.broken_counts(checks).items()]).first().asDict()
    decided = rules.decide(deferred, checks, seen["rows"], seen)
    assert {(r.cicid, r.rejection_reason) for r in decided.where("is_rejected").collect()} == want
    result = etl.run(spark, *where, rule_set=shared_rules)
    kept = spark.read.parquet(f"{where[3]}/{schemas.REJECTED}").select("original_record.cicid", "rejection_reason")
    assert {tuple(r) for r in kept.collect()} == want and result.ledger["raw"] == len(ages) + 1
    assert {r for _, r in want} == {"old reason", "Invalid port code"}


def test_skipped_files_are_named(spark, paths):  # noqa: F811
    where = paths({"cicid": 1.0}, {"cicid": 2.0})
    folder = where[0]
    good = [f for f in os.listdir(folder) if f.endswith(".parquet")]
    whole = open(f"{folder}/{good[0]}", "rb").read()
    with open(f"{folder}/part broken.parquet", "wb") as file:
        file.write(b"PAR1 this is no parquet file PAR1")
    spark.read.parquet(f"{folder}/{good[0]}").limit(0).coalesce(1).write.mode("append").parquet(folder)
    before = len([f for f in os.listdir(folder) if f.endswith(".parquet")])
    result = etl.run(spark, *where, skip_corrupt=True)
    assert [os.path.basename(f) for f in result.skipped_files] == ["part broken.parquet"] and result.rows[schemas.SKIPPED_FILES] == 1
    told = spark.read.parquet(f"{where[3]}/{schemas.SKIPPED_FILES}").collect()
    assert len(told) == 1 and told[0].bytes == 33 and told[0].file_rows is None and "Arrow" in told[0].error
    assert result.rows[schemas.FACT] == 2 and before >= 3 and len(whole) > 0
    os.remove(f"{folder}/part broken.parquet")
    assert schemas.SKIPPED_FILES not in etl.run(spark, *where).rows
    assert not os.path.exists(f"{where[3]}/{schemas.SKIPPED_FILES}")


def test_files_that_break_off_are_named(spark, tmp_path, arrivals):
    folder = str(tmp_path / "in")
    for start in (0, 1000, 2000):
        arrivals(*[{"cicid": float(start + i)} for i in range(500)]).coalesce(1).write.option("compression", "none").mode("append").parquet(folder)
    victim = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))[1]
    data = bytearray(open(f"{folder}/{victim}", "rb").read())
    data[4:400] = b"\xff" * 396  # pages, not the footer
    open(f"{folder}/{victim}", "wb").write(data)
    crc = f"{folder}/.{victim}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    raw = source.read(spark, folder, schema=schemas.ARRIVALS, origin=True, skip_corrupt=True)
    read = raw.where("cicid IS NOT NULL OR gender IS NOT NULL").groupBy(F.col("source_file").alias("file")).agg(F.count("*").alias("read_rows"))
    told = source.skipped(spark, [folder], schemas.ARRIVALS, read).collect()
    assert [(os.path.basename(r.file), r.file_rows) for r in told] == [(victim, 500)] and (told[0].read_rows or 0) < 500
    assert told[0].error == "broken off while it was read"
