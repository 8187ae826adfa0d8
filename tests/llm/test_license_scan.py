"""License scan: places of phrases against a plain search, edited notices, odd rows."""

import random
import re

import pytest

from emisplit.llm import license_scan

from .helpers import DOCS, documents, odd_documents

NOTICE = {label: words for label, words, _ in license_scan.NOTICES}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _base(text):
    """(number of words, [(start, label)]) by trying every place."""
    words = WORD.findall((text or "").translate(ASCII))
    found = []
    for label, phrase in license_scan.PHRASES:
        want = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(want)] == want]
    return len(words), sorted(found)


def _scan(spark, texts):
    return {r["doc_id"]: r for r in license_scan.scan(documents(spark, texts)).collect()}


def test_base_places_match_a_plain_search(spark):
    rng = random.Random(7)
    words = "under the mit license apache version 2 cc by nc BY-NC CC Licensed, The MIT License. été É".split()
    texts = [" ".join(rng.choices(words, k=rng.randrange(0, 120))) for _ in range(150)]
    texts += ["cc by nc cc by nc", "CCK by nc", "Under\nTHE (MIT) license!", "under the mit licence", "ccby nc", "cc by", None, "", "..."]
    texts += ["released under the mit license " * 2000]
    got = _scan(spark, texts)
    assert sum(bool(_base(t)[1]) for t in texts) > 20
    for i, text in enumerate(texts):
        n, found = _base(text)
        row = got[i]
        starts = [s for s, _ in found]
        assert (row["n_words"], row["n_base"]) == (n, len(found)), text
        assert (row["first_word"], row["last_word"]) == ((min(starts), max(starts)) if starts else (None, None))
        assert row["base_labels"] == ",".join(sorted({x for _, x in found}))
        assert set(row["base_labels"].split(",")) - {""} <= set(row["labels"].split(","))
        assert row["score"] == 1.0 if found else row["score"] < 1.0


@pytest.mark.parametrize("label", sorted(NOTICE))
def test_notices_are_found_as_they_are_and_edited(spark, label):
    words = NOTICE[label].split()
    inserted = [*words[:4], "hereby", *words[4:]]
    texts = [
        "x y z. " + " ".join(words).upper() + " and more",
        "some text " + " ".join(inserted) + ".",
        " ".join(words[: len(words) // 2]),  # half of it is not it
        "the of license this work software version",
    ]
    got = _scan(spark, texts)
    assert label in got[0]["labels"].split(",") and got[0]["score"] == 1.0
    # A word put in breaks two runs; the diagonals around it are one span.
    if (len(words) - 4) / (len(words) - 2) >= license_scan.COVER:
        assert label in got[1]["labels"].split(",") and license_scan.COVER <= got[1]["score"] < 1.0
    assert [got[i]["labels"] for i in (2, 3)] == ["", ""]


def test_relatives_are_told_apart_by_the_words_to_keep(spark):
    texts = [
        "This work is licensed under the GNU General Public License, version 3.",
        "This work is licensed under the GNU General Public License, version 2.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ]
    got = _scan(spark, texts)
    assert [got[i]["labels"] for i in range(3)] == ["gpl-3", "gpl-2", ""]


def test_words_of_other_hashes_do_not_count(spark, monkeypatch):
    """With a hash that takes all runs for equal, only equal words are found."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(license_scan, "_hash", lambda: F.length("gram.w0") * 0)
    texts = ["it is under the mit license now", "a b c d e f"]
    rows = documents(spark, texts).select("doc_id", "text")
    got = license_scan.spans(rows, license_scan.templates(spark)).where("exact").collect()
    assert [(r["doc_id"], r["label"], r["first"], r["end"]) for r in got] == [(0, "mit", 2, 6)]


def test_own_templates_and_bad_ones(spark):
    known = license_scan.templates(spark, [("x", "alpha beta gamma")], [])
    got = license_scan.scan(documents(spark, ["Alpha, beta GAMMA", "alpha beta"]), known).orderBy("doc_id").collect()
    assert [(r["labels"], r["n_base"]) for r in got] == [("x", 1), ("", 0)]
    for phrases, notices in (([("x", "two words")], []), ([], [("x", "one two three four", "not in it")])):
        with pytest.raises(ValueError, match="x: a template"):
            license_scan.templates(spark, phrases, notices)


def test_odd_rows(spark):
    rows = odd_documents(spark)
    got = license_scan.scan(rows)
    assert got.count() == rows.count()
    copies = documents(spark, ["under the mit license"] * 6 + [None, None], [1, 1, 1, None, None, 2, None, None])
    got = license_scan.scan(copies).collect()
    assert sorted((str(r["doc_id"]), r["n_base"], r["first_word"]) for r in got) == sorted(
        [("1", 1, 0)] * 3 + [("None", 1, 0)] * 2 + [("2", 1, 0)] + [("None", 0, None)] * 2
    )
    assert license_scan.scan(spark.createDataFrame([], DOCS)).collect() == []
    clashing = documents(spark, ["cc by nc"]).selectExpr("*", "1 as key1", "2 as hash", "3 as words", "map('a', 1) as label")
    assert [r["labels"] for r in license_scan.scan(clashing).collect()] == ["cc-by-nc"]


def test_no_python_worker_on_the_main_path(spark):
    plan = license_scan.scan(documents(spark, ["a b c"]))._jdf.queryExecution().toString()
    rows = documents(spark, ["a b c"]).select("doc_id", "text")
    plan += license_scan.spans(rows, license_scan.templates(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|InArrow|InPandas|RDD", plan.replace("Scan ExistingRDD", "").replace("LogicalRDD", ""))
