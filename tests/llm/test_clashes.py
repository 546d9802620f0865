"""Columns whose names the operators use themselves come through unchanged; tables go when work is done."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from starmart.llm import language, minhash, mixing, tables, winnow

NAMES = ("rate", "rows", "docs", "learned", "size", "weight", "_language", "_Source", "_rate", "_steps", "_key", "_row", "copy_", "row", "of", "found", "bucket", "component")


def test_clashing_columns(spark, frame, corpus):
    docs = frame.drop("row").withColumns({name: F.concat(F.lit(f"{name} "), F.coalesce(F.col("doc_id"), F.lit(0)).cast("string")) for name in NAMES})
    bench = spark.createDataFrame([(1, corpus[0][1])], "item_id long, text string").withColumns({"row": F.lit(1), "doc_id": F.lit(2)})
    results = {
        "language": language.known_language(docs),
        "mixed": mixing.mixed(docs).drop("copy"),
        "decontaminated": winnow.decontaminated(docs, bench),
        "apart": minhash.without_near_copies(docs),
    }
    for name, result in results.items():
        assert result.columns == docs.columns, name
        rows = result.collect()
        assert rows and all(r[n] == f"{n} {r.doc_id or 0}" for r in rows for n in NAMES), name
    plain = language.identified(frame).select("doc_id", "lang_pred", "score")
    clashing = language.identified(docs).select("doc_id", "lang_pred", "score")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, clashing.collect()))


def test_tables_go_when_work_is_done(spark, frame):
    shared = tables.folder(spark)
    before = set(os.listdir(shared))
    with tables.passing(spark):
        kept = tables.written(spark.range(3).toDF("x"), "stays", stays=True)
        tables.written(spark.range(3).toDF("x"), "goes")
    assert kept.count() == 3 and len(set(os.listdir(shared)) - before) == 1
    before = set(os.listdir(shared))
    with tables.passing(spark):
        assert minhash.near_copies(frame).count() == frame.count()
    assert set(os.listdir(shared)) == before
    assert minhash.without_near_copies(frame).count() > 0
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(shared)) - before}
    assert left == {"dropped", "twice"}
    assert tables.free(spark.range(1).toDF("_Row"), "_row") == "_row_"
