"""Language ID, mixing, archives and the pipeline: held-out accuracy, exact quotas, round trips."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from emisplit.llm import langid, mixing, warc
from emisplit.llm.sentence_spans import dedup_spans

from .helpers import ODD_TEXTS, documents, odd_documents


def _languages(rng, n):
    parts = {"aa": "ba da ka lo mi".split(), "bb": "sch ein ung ver ich".split(), "cc": "ción ñas que el ra".split()}
    langs = [rng.choice(list(parts)) for _ in range(n)]
    word = lambda g: "".join(rng.choices(parts[g], k=rng.randrange(1, 4)))
    return [" ".join(word(g) for _ in range(rng.randrange(3, 60))) for g in langs], langs


def test_held_out_accuracy(spark):
    import zlib

    texts, langs = _languages(random.Random(4), 600)
    ids = list(range(600))
    # Labels of held-out documents are wrong on purpose: training must not see them.
    held = [zlib.crc32(str(i).encode()) % 4 == 2 for i in ids]
    docs = documents(spark, texts, ids, langs=["zz" if h else g for h, g in zip(held, langs, strict=True)])
    got = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert [got[i]["held_out"] for i in ids] == held
    assert all(0 <= r["score"] <= 1 for r in got.values())
    right = [got[i]["lang_pred"] == langs[i] for i in ids if held[i]]
    assert len(right) > 100 and sum(right) >= 0.98 * len(right)
    assert sum(r["rejected"] for r in got.values()) <= 3
    again = {r["doc_id"]: r for r in langid.identify(docs.repartition(7)).collect()}
    assert again == got


def test_texts_unlike_all_learned_ones_are_rejected(spark):
    rng = random.Random(6)
    texts, langs = _languages(rng, 400)
    word = lambda letters: "".join(rng.choices(letters, k=rng.randrange(3, 9)))
    alphabets = ["абвгдежзийклмнопрст", [chr(0x4E00 + i) for i in range(900)], "αβγδεζηθικλμ", "qxjwvzyp"]
    strange = [" ".join(word(a) for _ in range(n)) for a in alphabets for n in (8, 40, 200) for _ in range(3)]
    docs = documents(spark, texts + strange, langs=langs + [None] * len(strange))
    rejected = {r["doc_id"] for r in langid.identify(docs).where("rejected").collect()}
    assert set(range(400, 400 + len(strange))) <= rejected
    assert len(rejected) <= len(strange) + 2
    kept = {r["doc_id"] for r in langid.keep_identified(docs).collect()}
    assert kept == set(range(len(texts + strange))) - rejected


def test_identify_odd_and_no_rows(spark):
    docs = odd_documents(spark)
    got = langid.identify(docs).collect()
    assert len(got) == docs.count()
    assert {r["lang_pred"] for r in got} == {"en", "und"}
    assert all(r["score"] == 0 and r["rejected"] for r in got if r["lang_pred"] == "und")
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["lang_pred"] == "en" for r in got)
    assert langid.identify(docs.limit(0)).collect() == []
    unlabelled = langid.identify(documents(spark, ["abc", None], langs=[None, None])).collect()
    assert {(r["lang_pred"], r["rejected"]) for r in unlabelled} == {("und", True)}


def test_targets_share_what_a_source_cannot_take():
    assert mixing.targets([10, 20, 30], [1, 2, 3]) == [10, 20, 30]
    assert mixing.targets([100, 1, 100], [1, 2, 3]) == pytest.approx([49.5, 3, 148.5])
    assert mixing.targets([], []) == [] and mixing.targets([0, 0], [1, 2]) == [0, 0]
    rng = random.Random(2)
    sizes = [rng.randrange(1, 1000) ** 2 for _ in range(40)]
    weights = [i % 3 + 1 for i in range(40)]
    goals = mixing.targets(sizes, weights)
    assert sum(goals) == pytest.approx(sum(sizes))
    level = max(g / w for g, w in zip(goals, weights, strict=True))
    assert all(g == pytest.approx(min(3 * s, level * w)) for g, s, w in zip(goals, sizes, weights, strict=True))


def test_splitting_tree_keeps_every_quota():
    quotas = np.array([1000, 1, 0, 37, 512])
    for shards in (1, 3, 16):
        dealt = mixing.split(quotas, shards, seed=5)
        assert (dealt.sum(axis=1) == quotas).all() and (dealt >= 0).all()
        assert np.ptp(dealt.sum(axis=0)) <= 2
        assert (dealt == mixing.split(quotas, shards, seed=5)).all()


def test_mix_meets_its_targets(spark):
    rng = random.Random(3)
    texts = ["w " * rng.randrange(0, 60) for _ in range(1500)]
    sources = [rng.choice(["a", "a", "a", "b", "é", "z", None]) for _ in texts]
    docs = documents(spark, texts, sources=sources)
    got = mixing.mix(docs, shards=4).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(1500))
    names = sorted({s for s in sources if s}) + [None]
    sizes = [sum(len(t.split()) for t, s in zip(texts, sources, strict=True) if s == n) for n in names]
    goals = dict(zip(names, mixing.targets(sizes, [1, 2, 3, 1, 2]), strict=True))
    for name, size in zip(names, sizes, strict=True):
        own = [r for r in got if sources[r["doc_id"]] == name]
        assert {(r["source_size"], r["target"]) for r in own} == {(size, goals[name])}
        assert abs(sum(r["taken"] for r in own) - goals[name]) <= 120
    assert all(r["size"] == len(texts[r["doc_id"]].split()) and r["taken"] == r["size"] * len(r["draws"]) for r in got)
    assert max(len(r["draws"]) for r in got) <= 3
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(5), shards=4).collect()))
    rows = mixing.mixture(docs, shards=4).collect()
    assert [(r["mix_shard"], r["mix_order"]) for r in rows] == sorted((r["mix_shard"], r["mix_order"]) for r in rows)
    assert sorted((r["doc_id"], r["mix_shard"]) for r in rows) == sorted((r["doc_id"], s) for r in got for s in r["draws"])


def test_mix_of_odd_and_no_rows(spark):
    docs = odd_documents(spark)
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count() and all(r["taken"] <= 3 * r["size"] for r in got)
    assert mixing.mix(docs.limit(0)).collect() == [] and mixing.mixture(docs.limit(0)).collect() == []
    assert {r["target"] for r in mixing.mix(documents(spark, [None, ""])).collect()} == {0.0}


def test_mixture_takes_rows_without_ids_and_with_shared_ids(spark):
    rng = random.Random(12)
    texts = [f"t{i} " + "w " * rng.randrange(60) for i in range(900)]
    ids = [None if i % 3 == 0 else i // 2 for i in range(900)]
    sources = [rng.choice(["a", "b", None]) for _ in texts]
    docs = documents(spark, texts, ids, sources)
    planned: dict = {}
    for r in mixing.mix(docs, shards=4).collect():
        planned[r["source_size"], r["target"]] = planned.get((r["source_size"], r["target"]), 0) + r["taken"]
    rows = mixing.mixture(docs, shards=4).collect()
    assert {r["text"] for r in rows if r["doc_id"] is None} and all(r["text"] in texts for r in rows)
    for name in ("a", "b", None):
        size = sum(len(t.split()) for t, s in zip(texts, sources, strict=True) if s == name)
        words = sum(len(r["text"].split()) for r in rows if r["source"] == name)
        ((_, goal),) = [k for k in planned if k[0] == size]
        assert words == planned[size, goal] and abs(words - goal) <= 200
    again = mixing.mixture(docs.repartition(7), shards=4).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, value string, archive string")


def test_archives_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "PER_FILE", 7)
    rng = random.Random(9)
    big = ["é" * 500, "x" * 999, "y" * 1000, "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 40]
    rows = [(i, rng.choice(["http://A.example/%s x\n" % (i % 5), None, "b.example"]), rng.choice([*big, None, "", f"<p>{i}"]), "", "") for i in range(80)]
    rows += [(3, "u", "y" * 1000, "", ""), (None, "u", "y" * 1000, "", "")]
    got = warc.capture_index(_pages(spark, rows).repartition(4)).collect()
    assert [(r["url_key"], r["captured"]) for r in got] == sorted((r["url_key"], r["captured"]) for r in got)
    kept = {h: max(p for p, _, x, _, _ in rows if x == h and p is not None) for h in {r[2] for r in rows if len((r[2] or "").encode()) >= 1000}}
    want = []
    for page_id, url, html, _, _ in rows:
        raw = (html or "").encode()
        refers = kept.get(html) if html in kept and page_id is not None and page_id < kept[html] else None
        want.append((page_id, url, len(raw), hashlib.sha1(raw).hexdigest(), "response" if refers is None else "revisit", refers))
    names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(str, (tuple(r[n] for n in names) for r in got))) == sorted(map(str, want))


def test_no_pages(spark):
    assert warc.capture_index(_pages(spark, [])).collect() == []


def test_loser_tree_merges_runs_of_any_number():
    rng = random.Random(7)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted((rng.randrange(50), i, j) for j in range(rng.randrange(0, 20))) for i in range(k)]
        assert list(warc.loser_tree(runs)) == sorted(x for r in runs for x in r)


def test_pipeline_stages_follow_from_each_other(spark, tmp_path):
    rng = random.Random(11)
    texts, langs = _languages(rng, 120)
    texts = [re.sub(r"((?:\S+ ){9})", r"\1\n", t) + f"\nend {i} of this text" for i, t in enumerate(texts)]
    texts[5] = texts[4] + " x"  # a near copy
    item = " ".join(f"item{i}" for i in range(12))
    texts[7] += "\n" + item
    docs = documents(spark, [*texts, None, "12 34"], langs=[*langs, "aa", "aa"])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_duplicates", "benchmark", "mix"]
    now, ids = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns, name
        ids.append({r["doc_id"] for r in now.collect()})
    assert not {120, 121} & ids[0] and len(ids[0]) >= 118
    assert all(later <= earlier for earlier, later in zip(ids, ids[1:], strict=False))
    assert 4 in ids[2] and 7 in ids[2] and 7 not in ids[3]
    mixed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in mixed} <= ids[3] and len(mixed) > 50


def test_one_of_equal_rows_stays_in_near_duplicates(spark):
    rng = random.Random(8)
    a, b, c, d = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for _ in range(4))
    rows = [(5, a, "s2"), *[(5, a, "s1")] * 30, (None, a + " x", "s"), *[(None, b, "s")] * 20, (None, b + " x", "s"), (9, c, None), (9, d, None)]
    docs = documents(spark, [t for _, t, _ in rows], [i for i, _, _ in rows], [x for _, _, x in rows]).repartition(3)
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns and got.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    kept = sorted((str(r["doc_id"]), r["text"], r["source"]) for r in got.collect())
    assert [k for k in kept if k[0] != "None"] == sorted([("5", a, "s1"), ("9", c, None), ("9", d, None)], key=str)
    (alone,) = [k for k in kept if k[0] == "None"]
    assert alone[1] in (b, b + " x")


def test_pipeline_of_odd_rows(spark, tmp_path):
    odd_documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert {r["text"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} <= set(ODD_TEXTS)


def test_a_text_is_judged_alike_alone_and_among_others():
    import numpy as np

    rng = random.Random(17)
    pieces = ["Hello there", '"quoted" text', "  leading", "trailing  ", "abc", "", "123", "\n\nnew lines", "é à ü", "--", "a", "word " * 50]
    texts = ["abc", '"Hello there', " x", *(rng.choice(pieces) + rng.choice(pieces) for _ in range(300))]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    bucket, first = langid.subwords(data, offsets)
    for i, r in enumerate(raw):
        alone, _ = langid.subwords(np.frombuffer(r, np.uint8), np.array([0, len(r)]))
        assert sorted(alone.tolist()) == sorted(bucket[first[i] : first[i + 1]].tolist()), texts[i]


def test_too_many_languages_are_an_error(spark):
    docs = documents(spark, [f"text number {i}" for i in range(40)], langs=[f"l{i}" for i in range(40)])
    assert len(langid.train(docs, 5, most_langs=40).langs) > 20
    with pytest.raises(ValueError, match="languages"):
        langid.train(docs, 5, most_langs=20)


def test_pipeline_keeps_user_columns_of_any_name_and_kind(spark, tmp_path):
    rng = random.Random(12)
    texts, langs = _languages(rng, 60)
    docs = documents(spark, [t + f"\nend {i} of this text" for i, t in enumerate(texts)], langs=langs)
    odd = ["__row", "__gone", "__hash", "__judged", "__from", "__in", "__done", "__id", "__group", "__one"]
    mine = {c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in odd}
    docs = docs.withColumns(mine).withColumn("pairs", F.create_map(F.lit("k"), F.col("doc_id")))
    docs = docs.unionByName(docs.where("doc_id < 5"))
    spark.createDataFrame([(1, "no such words in any text here at all today")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        rows = docs.select("doc_id", "pairs", *odd).collect()
        assert len(rows) > 20, name
        assert all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in odd) and all(r["pairs"] == {"k": r["doc_id"]} for r in rows), name
    assert dedup_spans(docs.select("doc_id", "text", "__row")).columns[:3] == ["doc_id", "text", "__row"]


def test_pipeline_without_documents(spark, tmp_path):
    documents(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_draws_of_the_query_follow_the_splitting_tree(spark, tmp_path):
    """Blocks drawn per source and shard are the quotas of the tree, whatever the documents in them."""
    from emisplit.llm import queries

    rng = random.Random(21)
    texts = ["w " * rng.randrange(1, 40) for _ in range(900)]
    sources = [rng.choice(["a", "a", "b", None]) for _ in texts]
    documents(spark, texts, sources=sources).write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op10_mixing(spark, str(tmp_path)).collect()
    assert all(r["taken"] == r["size"] * len(r["draws"]) for r in rows)
    shards = [s for r in rows for s in r["draws"]]
    assert set(shards) <= set(range(16)) and len(set(shards)) > 8
    sized = mixing._sized(documents(spark, texts, sources=sources), "doc_id", 64, 11)
    placed = mixing._placed(sized, mixing.WEIGHTS, 4, 11).collect()
    quotas = {s: sum(r["copies"] for r in placed if r["source"] == s) for s in ("a", "b", None)}
    dealt = {s: [sum(x == i for r in placed if r["source"] == s for x in r["draws"]) for i in range(4)] for s in quotas}
    assert {s: sum(d) for s, d in dealt.items()} == quotas
    want = mixing.split(np.array([quotas[s] for s in ("a", "b", None)]), 4, 11)
    assert [dealt[s] for s in ("a", "b", None)] == want.tolist()
