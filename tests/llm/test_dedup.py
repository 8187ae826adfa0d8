"""Sentence spans, line chunks and near duplicates against plain versions."""

import random
import re

import pytest

from emisplit.llm import line_chunks, minhash, sentence_spans
from emisplit.llm.components import components, contracted

from .helpers import documents, odd_documents


def _texts(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    sentence = lambda: " ".join(rng.choices(words, k=rng.randrange(2, 15))) + rng.choice(".!?") + rng.choice([" ", "\n", "  "])
    shared = ["".join(sentence() for _ in range(rng.randrange(3, 9))) for _ in range(8)]
    out = []
    for _ in range(n):
        parts = ["".join(sentence() for _ in range(rng.randrange(1, 6))) for _ in range(3)]
        parts.insert(rng.randrange(4), rng.choice(shared) if rng.random() < 0.6 else "")
        out.append("".join(parts))
    return out + out[:5]


def test_sentence_spans_match_brute_force(spark):
    texts = _texts(1)
    pattern = re.compile(sentence_spans.SENTENCE)
    seen, want = set(), []
    for text in texts:
        parts = [p for p in pattern.findall(text) if p]
        assert "".join(parts) == text
        gone = set()
        for i in range(len(parts) - 2):
            span = " ".join(p.strip() for p in parts[i : i + 3])
            if len(span) >= sentence_spans.SHORTEST:
                gone |= {i, i + 1, i + 2} if span in seen else set()
                seen.add(span)
        want.append(("".join(p for i, p in enumerate(parts) if i not in gone), len(parts), len(gone)))
    got = sentence_spans.dedup_spans(documents(spark, texts)).orderBy("doc_id").collect()
    assert [(r["text"], r["n_sentences"], r["removed_sentences"]) for r in got] == want
    assert any(w[2] for w in want)


def test_a_repeated_passage_goes_but_for_the_first(spark):
    rng = random.Random(4)
    words = lambda n: " ".join(f"u{rng.randrange(10**6)}" for _ in range(n))
    passage = words(60)  # one sentence without any mark inside
    texts = [f"{words(9)}.\n{passage}\n{words(8)}." for _ in range(5)]
    got = [r["text"] for r in sentence_spans.dedup_spans(documents(spark, texts)).orderBy("doc_id").collect()]
    assert got[0] == texts[0]
    assert got[1:] == [t.replace(passage + "\n", "") for t in texts[1:]]


def _plain_chunks(text):
    import hashlib

    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:13], 16) for x in lines]
    chunks, first = [], 0
    for i in range(len(lines)):
        if i == len(lines) - 1 or i >= 1 and (h[i] + 2 * h[i - 1]) % 3 == 0:
            chunks.append(lines[first : i + 1])
            first = i + 1
    return chunks


def test_line_chunks_match_brute_force(spark):
    rng = random.Random(2)
    block = [[f"b{k}-{i}" for i in range(9)] for k in range(5)]
    texts = ["\n".join([f"t{d}-{i}" for i in range(rng.randrange(4))] + rng.choice(block) + [f"e{d}"] * rng.randrange(4)) for d in range(50)]
    seen, want = set(), []
    for text in texts:
        left, gone = [], [0, 0]
        for chunk in _plain_chunks(text):
            if len(chunk) > 1 and tuple(chunk) in seen:
                gone[0] += len(chunk)
                gone[1] += 1
            else:
                left += chunk
            if len(chunk) > 1:
                seen.add(tuple(chunk))
        want.append(("\n".join(left), *gone))
    got = line_chunks.dedup_lines(documents(spark, texts)).orderBy("doc_id").collect()
    assert [(r["text"], r["removed_lines"], r["removed_chunks"]) for r in got] == want
    assert sum(w[2] for w in want) > 20


def _sets(texts):
    out = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def _components(sets):
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


@pytest.mark.parametrize("light", [32, 2])
def test_near_duplicates_match_brute_force(spark, monkeypatch, light):
    """With ``light`` at 2 nearly all buckets are compared in chunks."""
    monkeypatch.setattr(minhash, "LIGHT", light)
    monkeypatch.setattr(minhash, "CHUNK_ITEMS", 1 << 11)
    rng = random.Random(3)
    base = [[f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60, 150))] for _ in range(6)]
    texts = []
    for _ in range(90):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(7)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    texts += texts[:6] + ["A b c", "a B c", "a b", None, "", " \x0b", "one two three four five", "one two three four five six"]
    sets = _sets(texts)
    got = minhash.near_duplicates(documents(spark, texts)).orderBy("doc_id").collect()
    assert [r["n_shingles"] for r in got] == [len(s) for s in sets]
    assert [r["component_id"] for r in got] == _components(sets)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_chunks_of_short_texts_are_bounded_in_nodes(spark):
    nodes = spark.range(3 * minhash.CHUNK_NODES).selectExpr("id as node", "2L as n", "1L as group")
    sizes = [r["count"] for r in minhash.dealt(nodes, ["group"]).groupBy("group", "chunk").count().collect()]
    assert len(sizes) == 3 and sum(sizes) == 3 * minhash.CHUNK_NODES and max(sizes) < 1.2 * minhash.CHUNK_NODES


def test_short_lines_with_a_common_start_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(minhash, "LIGHT", 2)
    monkeypatch.setattr(minhash, "CHUNK_NODES", 16)
    texts = [f"please sign in to continue {'x' * (i % 97)}{i}" for i in range(150)]
    texts += [f"{texts[i]} now and then or at any other time" for i in range(20)]
    got = minhash.near_duplicates(documents(spark, texts)).orderBy("doc_id").collect()
    assert [r["component_id"] for r in got] == _components(_sets(texts))


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(200, 200)]
    rng = random.Random(1)
    rng.shuffle(edges)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    n = docs.count()
    spans = sentence_spans.dedup_spans(docs)
    assert spans.columns == [*docs.columns, "n_sentences", "removed_sentences"]
    assert spans.count() == n and spans.where("text is null").count() == 1
    lines = line_chunks.dedup_lines(docs)
    assert lines.columns == [*docs.columns, "removed_lines", "removed_chunks"]
    assert lines.count() == n and lines.where("text is null").count() == 1
    near = minhash.near_duplicates(docs).collect()
    assert len(near) == n
    assert all(r["component_id"] == r["doc_id"] for r in near if not r["n_shingles"])


def test_no_rows(spark):
    docs = odd_documents(spark).limit(0)
    for rows in (sentence_spans.dedup_spans(docs), line_chunks.dedup_lines(docs), minhash.near_duplicates(docs)):
        assert rows.collect() == []


def test_contracted_edges_are_stars_of_the_same_components():
    import numpy as np

    rng = random.Random(8)
    for n in (1, 3, 10, 60, 400):
        edges = [(rng.randrange(n * 2), rng.randrange(n * 2)) for _ in range(n)]
        edges += [(i, i + 1) for i in range(0, n // 2)]  # a path
        group = {}

        def find(x):
            while group.setdefault(x, x) != x:
                x = group[x]
            return x

        for a, b in edges:
            x, y = find(a), find(b)
            group[max(x, y)] = min(x, y)
        got = dict(zip(*(c.tolist() for c in contracted(*np.array(edges).T))))
        assert got == {x: find(x) for x in list(group) if find(x) != x}


def test_chunks_are_compared_strip_by_strip(spark, monkeypatch):
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(12)
    base = [rng.randrange(1 << 40) for _ in range(40)]

    def chunk(first, count):
        kept = lambda: sorted({x if rng.random() < 0.93 else rng.randrange(1 << 40) for x in base})
        return [{"node": first + i, "root": first + i // 2, "items": kept()} for i in range(count)]

    left, right = chunk(0, 300), chunk(10_000, 50)
    kind = pa.list_(pa.struct([("node", pa.int64()), ("root", pa.int64()), ("items", pa.list_(pa.int64()))]))
    batch = pa.RecordBatch.from_arrays([pa.array([left], kind), pa.array([right], kind)], names=["left", "right"])
    monkeypatch.setattr(minhash, "_COLUMNS", 7)
    links = {tuple(r.values()) for b in minhash._block_links([batch]) for r in b.to_pylist()}
    same = lambda a, b: 100 * len({*a["items"]} & {*b["items"]}) >= 75 * len({*a["items"]} | {*b["items"]})
    want = {(a["root"], b["root"]) for a in left for b in right if same(a, b)}
    roots = {r["node"]: r["root"] for r in left + right}
    nodes = {r["node"]: r for r in left + right}
    assert want and {(roots[a], roots[b]) for a, b in links} == want and all(same(nodes[a], nodes[b]) for a, b in links)
    # Two chunks of many small sets: nothing as large as the whole grid beside the sums.
    many = pa.array([[{"node": i, "root": i, "items": [i % 7, *range(100 + i, 104 + i)]} for i in range(2000)]], kind)
    batch = pa.RecordBatch.from_arrays([many, many], names=["left", "right"])
    monkeypatch.undo()
    tracemalloc.start()
    for _ in minhash._block_links([batch]):
        pass
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60e6
