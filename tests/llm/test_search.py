"""Top-k search, decontamination and secrets against plain versions."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from emisplit.llm import decontaminate, hamming_search, secret_scan

from .helpers import documents, odd_documents


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string, code string")


@pytest.mark.parametrize("bits", [64, 20])
def test_search_matches_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(hamming_search, "BLOCK", 100)
    monkeypatch.setattr(hamming_search, "CHUNK", 3)
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 1) for _ in range(bits)], "", "") for i in range(400)]
    rows += [(400 + i, rows[0][1], "", "") for i in range(30)]  # more copies than k
    rows += [(None, rows[1][1], "", ""), (500, None, "", ""), (501, [], "", ""), (502, [None, float("nan"), 1.0], "", "")] + rows[5:8]
    code = lambda v: tuple(x is not None and x == x and x > 0 for x in (v + [None] * bits)[:bits])
    known = sorted({(i, code(v)) for i, v, _, _ in rows if i is not None and v is not None})
    want = []
    for q, c in known:
        if q % 25 == 0:
            near = sorted((sum(a != b for a, b in zip(c, d, strict=True)), i) for i, d in known if i != q)[:7]
            want += [(q, k + 1, i, n) for k, (n, i) in enumerate(near)]
    got = hamming_search.search(_vectors(spark, rows), k=7, every=25, bits=bits).collect()
    assert sorted(map(tuple, got)) == want


def test_search_of_few_and_no_rows(spark):
    two = _vectors(spark, [(0, [1.0], "", ""), (3, [-1.0], "", "")])
    assert [tuple(r) for r in hamming_search.search(two).collect()] == [(0, 1, 3, 1)]
    assert hamming_search.search(two.limit(0)).collect() == []


def _hits(text, items):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, ids = set(), set()
    for item, body in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), body or ""))
        size = min(10, len(w))
        windows = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                ids.add("" if item is None else str(item))
    return len(words), len(hit), sorted(ids)


@pytest.mark.parametrize("block", [100_000, 40])
def test_decontamination_matches_brute_force(spark, block):
    """With small blocks the benchmark takes several passes, whose results are united."""
    rng = random.Random(8)
    vocab = [f"v{i}" for i in range(60)] + ["É", "ß", "Straße"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 2, 5, 9, 10, 14, 30])))) for i in range(25)]
    items += [(3, items[4][1]), items[5], (None, "q1 q2 q3"), (77, None), (78, "..."), (79, "Same same SAME same same same same same same same same")]
    texts = [" ".join(rng.choices(vocab, k=rng.randrange(40))) for _ in range(40)]
    for i in range(30):
        words = texts[i].split()
        body = rng.choice(items)[1] or ""
        words.insert(rng.randrange(len(words) + 1), body.upper().replace(" ", " - ") if i % 2 else body)
        texts[i] = " ".join(words)
    texts += ["same " * 15, None, "", "q1, q2; q3", texts[0], texts[0]]
    ids = [*range(len(texts) - 2), 0, 0]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, n_words string")
    got = decontaminate.hit_words(documents(spark, texts, ids), bench, words=block).collect()
    want = [(i, *_hits(t, items)) for i, t in zip(ids, texts, strict=True)]
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got) == sorted(want)
    kept = decontaminate.decontaminated(documents(spark, texts, ids), bench)
    assert kept.columns == documents(spark, [], []).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(w[0] for w in want if not w[2])


def test_decontamination_of_nothing(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert {r["n_hit"] for r in decontaminate.hit_words(odd_documents(spark), bench).collect()} == {0}
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.hit_words(odd_documents(spark).limit(0), some).collect() == []
    assert decontaminate.hit_words(odd_documents(spark), some).where("n_hit > 0").count() == 3


@pytest.mark.parametrize(
    ("text", "spans"),
    [
        ('x password=abcdefgh, Token : "AB/+=_.-1" secret=short', ["assign:2:19", "assign:21:39"]),
        ("API_KEY='12345678' apikey:abcdefgh_", ["assign:0:17", "assign:19:35"]),
        ("AKIA123456789012 AKIA12345678901 xAKIAAKIAABCDEFGH", ["access:0:16", "access:34:50"]),
        ("f" * 31 + " " + "0" * 32 + "g" + "é" + "a1" * 20, ["hex:32:64", "hex:66:106"]),
        ("token=" + "ab" * 20, ["assign:0:46", "hex:6:46"]),
        ("\u017fecret=abcdefgh1 to\u212aen=abcdefgh1", []),  # look like s and K, but are no ASCII letters
        ("toKEN=abcdefgh1", ["assign:0:15"]),
        ("", []),
    ],
)
def test_base_findings(text, spans):
    assert secret_scan.written(secret_scan.base_findings(text)) == ",".join(spans)


def _secret_texts(rng, n):
    out = []
    for i in range(n):
        hexed = "".join(rng.choices("0123456789abcdef", k=40))
        kind = i % 4
        middle = [f'token = "{hexed}"', f"password={hexed[:18]}", f"call {rng.randrange(10**9, 10**10)} now", f"see page-{rng.randrange(10**5)}-of-book"][kind]
        out.append(f"some words before it {middle} and words behind")
    return out


def test_scan_matches_the_patterns_and_adds_what_looks_alike(spark):
    rng = random.Random(2)
    texts = [*_secret_texts(rng, 400), None, ""]
    hidden = "nothing to see 9f8a7b6c5d4e3f2a1b or so"
    got = {r["doc_id"]: r for r in secret_scan.find(documents(spark, [*texts, hidden])).collect()}
    for i, text in enumerate(texts):
        base = secret_scan.base_findings(text or "")
        assert got[i]["base_sha256"] == hashlib.sha256(secret_scan.written(base).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(b[1] == k for b in base) for k in range(3)]
        if i % 4 > 1:
            assert got[i]["n_cnn"] == 0
    assert got[len(texts)]["spans"] == "cnn:15:33"


def test_network_keeps_the_recall_it_is_held_to():
    rng = random.Random(3)
    views, known = [], []
    for text in _secret_texts(rng, 600):
        base = secret_scan.base_findings(text)
        for s, e in secret_scan.candidates(text):
            views.append(secret_scan.window(text, s, e))
            known.append(any(a < e and s < b for a, _, b in base))
    net = secret_scan.fit(views[:800], known[:800])
    score = net.scores(secret_scan.codes(views[400:]))
    truth = known[400:]
    found = [s >= net.threshold for s in score]
    assert sum(f and t for f, t in zip(found, truth, strict=True)) >= 0.95 * sum(truth)
    assert not any(f and not t for f, t in zip(found, truth, strict=True))


def test_every_candidate_trains_or_calibrates(spark, monkeypatch):
    rng = random.Random(4)
    cands = []
    for i in range(5000):
        key = "".join(rng.choices("0123456789abcdef", k=16)) if i % 2 else f"page-{rng.randrange(10**8)}"
        cands.append((0, 16, secret_scan.window(f"key {key} and", 4, 4 + len(key)), bool(i % 2)))
    rows = [(i, cands[i : i + 50]) for i in range(0, 5000, 50)] + [(1, cands[:9])]
    scanned = spark.createDataFrame(rows, "doc_id long, " + secret_scan._CAND).repartition(3)
    trained, calibrated = [], []
    one_round, outputs = secret_scan._round, secret_scan._outputs
    monkeypatch.setattr(secret_scan, "SHARD", 1500)
    monkeypatch.setattr(secret_scan, "_round", lambda x, *rest: trained.append(x.count()) or one_round(x, *rest))
    monkeypatch.setattr(secret_scan, "_outputs", lambda x, net: calibrated.append(x.count()) or outputs(x, net))
    net = secret_scan.train(scanned, epochs=2)
    distinct = len({c[2:] for c in cands})
    assert len(trained) == 2 and {t + calibrated[0] for t in trained} == {distinct}
    again = secret_scan.train(scanned.repartition(5), epochs=2)
    assert np.array_equal(net.kernel, again.kernel) and (net.scale, net.threshold) == (again.scale, again.threshold)
    score = net.scores(secret_scan.codes([c[2] for c in cands]))
    found = [s >= net.threshold for s in score]
    assert sum(found[1::2]) >= 0.95 * 2500 and sum(found[::2]) <= 0.05 * 2500


def test_ranked_value_equals_sorting(spark):
    rng = random.Random(6)
    for values in ([rng.gauss(0, 1) ** 5 for _ in range(500)], [1.0] * 20 + [2.0] * 30 + [1e9], [3.5]):
        rows = spark.createDataFrame([(v,) for v in values], "z double")
        for rank in (0, len(values) // 2, len(values) - 1):
            assert secret_scan._ranked(rows, rank, most=4) == sorted(values)[rank]


def test_scan_of_odd_and_no_rows(spark):
    docs = odd_documents(spark)
    rows = secret_scan.find(docs).collect()
    assert len(rows) == docs.count() and {r["spans"] for r in rows} == {""}
    assert secret_scan.find(docs.limit(0)).collect() == []


def _plain_base(text):
    """Base findings by trying every start of every kind, without regular expressions."""
    keys, found = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_.=-", []
    low = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))

    def run(at, allowed):
        end = at
        while end < len(text) and text[end] in allowed:
            end += 1
        return end

    at = 0
    while at < len(text):
        end = None
        for word in ("password", "passwd", "secret", "token", "apikey", "api_key"):
            if end is None and low.startswith(word, at):
                i = at + len(word)
                i += text[i : i + 1] in ('"', "'") and i < len(text)
                i = run(i, " ")
                if text[i : i + 1] and text[i] in ":=":
                    i = run(i + 1, " ")
                    i += text[i : i + 1] in ('"', "'") and i < len(text)
                    stop = run(i, keys)
                    if stop > i:
                        end = stop
                        if stop - i >= 8:
                            found.append((at, 0, stop))
        at = end or at + 1
    for kind, first, allowed, least in ((1, "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16), (2, "", "0123456789abcdef", 32)):
        at = 0
        while at < len(text):
            end = run(at + len(first), allowed) if text.startswith(first, at) else at
            if end > at + len(first):
                if end - at >= least:
                    found.append((at, kind, end))
                at = end
            else:
                at += 1
    return sorted(found)


def _tricky_texts(rng, n):
    pieces = ["secret", "token", "Api_Key", "passwd", "password", "=", ":", " ", "  ", '"', "'", "AKIA", "abcdefgh", "deadbeef" * 4, "0" * 31]
    pieces += ["the secre", "t", "oken=", "é", "X9Y8Z7W6V5U4T3S2", "\n", "short", "+/_.-"]
    return ["".join(rng.choices(pieces, k=rng.randrange(0, 14))) for _ in range(n)]


def test_base_findings_match_a_search_without_patterns():
    rng = random.Random(31)
    texts = _tricky_texts(rng, 3000) + ["the secre", "token=abcdefgh here"]
    assert sum(bool(_plain_base(t)) for t in texts) > 500
    for text in texts:
        assert secret_scan.base_findings(text) == _plain_base(text), text


def test_base_spans_do_not_depend_on_the_rows_around(spark):
    """Rows whose ends and starts make keywords together, cut into batches of any size."""
    rng = random.Random(32)
    texts = ["the secre", "token=abcdefgh here", "passwo", "rd=abcdefgh1", "", None, "sec", "ret: abcdefgh"] * 3 + _tricky_texts(rng, 200)
    want = [(len(f), secret_scan.written(f)) for f in (_plain_base(t or "") for t in texts)]
    for size in ("1", "3", "1000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            rows = secret_scan.find(documents(spark, texts).coalesce(1)).orderBy("doc_id").collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        got = [(r["n_assign"] + r["n_access"] + r["n_hex"], ",".join(x for x in r["spans"].split(",") if not x.startswith("cnn"))) for r in rows]
        assert got == want


def test_candidates_are_runs_that_do_not_look_like_words():
    text = "ordinary Capitals well-known.words x1234567 aB3 innerCap AKEYHERE under_score base64+/= short1"
    found = [text[s:e] for s, e in secret_scan.candidates(text)]
    assert found == ["x1234567", "innerCap", "AKEYHERE", "under_score", "base64+/="]


def test_vectors_wider_than_a_code_raise(spark):
    wide = spark.createDataFrame([(1, [0.5] * 65)], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="65"):
        wide.select(hamming_search.sign_code(F.col("embedding"))).collect()
    code = wide.select(hamming_search.sign_code(F.slice("embedding", 1, 64))).first()[0]
    assert code == -1
