"""Language and toxicity: held-out accuracy on the given documents, and odd input."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starmart.llm import kernels, language, toxicity

SF_DIR, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"
ODD = [(1, None, None), (2, "", "en"), (3, "12 ...", "en"), (4, "The of and", None), (None, "der die das", "de"), (4, "The of and", None), (5, "aaa " * 200_000, None)]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, lang string").withColumn("row", F.lit("x"))


def test_language_of_held_out_documents(documents):
    found = language.identified(documents).join(documents.select("doc_id", "lang"), "doc_id")
    held = found.where("held_out").collect()
    assert len(held) > 200 and np.mean([r.lang == r.lang_pred for r in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in held)


def test_texts_without_letters_have_no_language(spark, documents):
    """Neither emoji, dashes nor punctuation beyond ASCII are letters; é and ideographs are."""
    texts = ["\U0001f600\U0001f680 \U0001f600\U0001f680", "———— — ————", "……… ………", "。、「」 。、「」", "été été", "漢字漢字"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = docs.withColumn("found", language.predicted(spark, language.learn(documents))).orderBy("doc_id").collect()
    assert [(r.found.lang_pred, r.found.score) for r in rows[:4]] == [("und", 0.0)] * 4
    assert "und" not in {r.found.lang_pred for r in rows[4:]}


def test_language_never_sees_held_out_labels(documents):
    spoiled = documents.withColumn("lang", F.when(language.held_out(), "xx").otherwise(F.col("lang")))
    assert {r.lang_pred for r in language.identified(spoiled).collect()} <= {"en", "fr", "de", "es", "und"}


def test_language_of_odd_rows(spark, documents, odd):
    model = language.learn(documents)
    rows = odd.withColumn("found", language.predicted(spark, model)).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert (r.found.lang_pred == "und") == (r.text in (None, "", "12 ...")) and 0 <= r.found.score <= 1
    both = documents.select("doc_id", "text", "lang").union(odd.select("doc_id", "text", "lang")).withColumn("row", F.lit(1))
    kept = language.known_language(both)
    assert kept.columns == both.columns and kept.count() == both.count() - 3
    assert language.identified(documents.limit(0)).count() == 0
    assert {r.lang_pred for r in language.identified(odd.where("lang IS NULL")).collect()} == {"und"}


def test_filter_counts_are_corrected():
    grams = np.arange(1, 4001, dtype=np.uint64) * np.uint64(2654435761)
    known = language.Filter.of(["a", "b"], grams, np.arange(4000) % 2)
    masks = known.holds(grams)[:, 0]
    assert ((masks >> (np.arange(4000) % 2).astype(np.uint64)) & np.uint64(1)).all()
    assert known.false_rate.max() < 0.02


def test_toxicity_of_held_out_documents(spark):
    documents = spark.read.parquet(f"{LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    found = toxicity.rated(documents, labels).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = [r for r in found if r.toxic == 1], [r for r in found if r.toxic == 0]
    assert len(found) > 800 and all(0 <= r.score <= 1 for r in found)
    assert np.mean([r.predicted for r in toxic]) >= 0.85 and np.mean([r.predicted for r in clean]) <= 0.01


def test_toxicity_of_odd_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.rated(odd, none).collect()} == {0.0}
    one = spark.createDataFrame([(4, 1), (4, 0), (3, None), (None, 1)], "doc_id long, toxic int")
    rows = toxicity.rated(odd, one).collect()
    assert len(rows) == len(ODD) and {r.predicted for r in rows} <= {0, 1}
    assert toxicity.rated(odd.limit(0), one).count() == 0


def test_features_of_insults():
    import pyarrow as pa

    code = toxicity._hashes(["idiot", "scum"])
    order = np.argsort(code)
    lexicon = toxicity.Lexicon(code[order], np.array([3.0, 2.0])[order])
    texts = pa.array(["You IDIOT, you", "1d10t and sc4m", "calm words", "", None])
    found = {n: v for n, v in zip(toxicity.FEATURES, toxicity.measure(texts, lexicon).T)}
    assert found["lexicon_count"].tolist() == [1, 0, 0, 0, 0] and found["near_rate"][0] > 0 == found["near_rate"][2]
    assert found["obfuscated_count"].tolist() == [0, 1, 0, 0, 0] and found["capital_rate"][0] > found["capital_rate"][2]


def test_grams_of_languages_are_those_of_a_plain_count():
    """Every n-gram whose inner bytes are letters, with any other byte at its ends taken for the same edge."""
    texts = [" ", " é ", " the cat, the cat 42 sat ", " a-b ñandú x ", "  ", " " + "abc de " * 3000, " ß1ß22ß "]
    plain = []
    for text in texts:
        marks = [b if 0x61 <= b <= 0x7A or b >= 0x80 else -1 for b in text.encode()]
        found = Counter()
        for n in language.GRAMS:
            for i in range(len(marks) - n + 1):
                gram = tuple(marks[i : i + n])
                if -1 not in gram[1:-1]:
                    found[gram] += 1
        plain.append(found)
    hashed = [Counter() for _ in texts]
    for of, grams in language._grams(*kernels.flat(pa.array(texts))):
        for i, gram in zip(of.tolist(), grams.tolist()):
            hashed[i][gram] += 1
    assert [sorted(c.values()) for c in hashed] == [sorted(c.values()) for c in plain]
    # n-grams that two texts share are the same ones, so equal n-grams have equal hashes and others do not
    for a in range(len(texts)):
        for b in range(len(texts)):
            assert sum((hashed[a] & hashed[b]).values()) == sum((plain[a] & plain[b]).values())
