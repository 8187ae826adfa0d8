"""Find secrets in texts: fixed patterns, and a character convolutional network for what they miss.

One pass over the texts finds the pattern matches and every candidate: a run of
at least ``SHORTEST`` of the characters that keys are written in, unless it looks like a word, that is, has
neither a digit nor one of ``+/_=`` nor a capital after its first character.
A candidate that overlaps a pattern match is a labelled finding, any other one
a negative. The network sees the candidate and its surroundings. It is trained on every distinct candidate: shards of
them are trained side by side in numpy for a pass and their weights averaged, round by round. A fifth of the
candidates, by a hash, is not trained on: all of it calibrates the scores, and the threshold is the highest one that keeps ``recall`` of
the findings there. The network then scores every candidate; those above the threshold
that no pattern covers are added as kind ``cnn``. Pattern matches always stay.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emisplit.llm.common import buffer, slices, stored
from emisplit.llm.words import spans

KINDS = ("assign", "access", "hex", "cnn")
SHORTEST = 8

_ANY_CASE = "|".join(
    re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", word) for word in ("password", "passwd", "secret", "token", "api_?key")
)
_ASSIGN = re.compile(rf"""({_ANY_CASE})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]+")
_NOT_WORD = re.compile(r"[0-9+/_=]")
_CAPITAL = re.compile(r"[A-Z]")
_WORDS = re.compile(rb"password|passwd|secret|token|api_?key")

_IS_HEX = np.array([chr(b) in "0123456789abcdef" for b in range(256)])
_IS_KEY = np.array([bool(_CANDIDATE.match(chr(b))) and b < 128 for b in range(256)])
_IS_NOT_WORD = np.array([bool(_NOT_WORD.match(chr(b))) and b < 128 for b in range(256)])
_IS_CAPITAL = np.array([0x41 <= b <= 0x5A for b in range(256)])

#: Characters before, of and after the candidate that the network sees.
BEFORE, INSIDE, AFTER = 32, 48, 16
_WIDTH = BEFORE + INSIDE + AFTER


def base_findings(text: str) -> list[tuple[int, int, int]]:
    """(start, index of the kind, end) of the pattern matches, in that order; ends are exclusive."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text) if len(m[0]) >= 32]
    return sorted(found)


def written(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(found))


def window(text: str, start: int, end: int) -> str:
    """Fixed-width surroundings: the end of what precedes, the candidate, the start of what follows.

    A candidate longer than its part keeps its two ends.
    """
    body = text[start:end]
    if len(body) > INSIDE:
        body = body[: INSIDE // 2] + body[-INSIDE // 2 :]
    return text[max(0, start - BEFORE) : start].rjust(BEFORE) + body.ljust(INSIDE) + text[end : end + AFTER].ljust(AFTER)


def candidates(text: str) -> list[tuple[int, int]]:
    runs = ((m.start(), m.end()) for m in _CANDIDATE.finditer(text))
    return [(s, e) for s, e in runs if e - s >= SHORTEST and (_NOT_WORD.search(text, s, e) or _CAPITAL.search(text, s + 1, e))]


def _suspects(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that may hold a match or a candidate; the others hold none for sure."""
    # A line end after each row, so that no word reaches from one row into the next.
    raw = np.insert(data, offsets[1:-1], 10).tobytes().lower()
    words = np.array([m.start() for m in _WORDS.finditer(raw)], np.int64)
    at = [words - (np.searchsorted(offsets + np.arange(len(offsets)), words, "right") - 1)]
    starts, ends = spans(data, offsets, _IS_HEX)
    at.append(starts[ends - starts >= 32])
    starts, ends = spans(data, offsets, _IS_KEY)
    starts, ends = starts[ends - starts >= SHORTEST], ends[ends - starts >= SHORTEST]
    marks = np.concatenate([[0], np.cumsum(_IS_NOT_WORD[data])])
    capitals = np.concatenate([[0], np.cumsum(_IS_CAPITAL[data])])
    at.append(starts[(marks[ends] > marks[starts]) | (capitals[ends] > capitals[starts + 1])])
    at.append(starts[ends - starts >= 16])  # access keys may lack a digit
    flags = np.zeros(len(offsets) - 1, bool)
    flags[np.searchsorted(offsets, np.concatenate(at), "right") - 1] = True
    return np.flatnonzero(flags)


_CAND = "cand array<struct<s:int,e:int,view:string,known:boolean>>"
_SCAN = f"doc_id long, found array<array<int>>, {_CAND}"
_SCAN_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("found", pa.list_(pa.list_(pa.int32()))),
        ("cand", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("view", pa.string()), ("known", pa.bool_())]))),
    ]
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (s for b in batches for s in slices(b, "text")):
        data, offsets = buffer(batch.column("text"))
        found: list[list] = [[] for _ in range(batch.num_rows)]
        cand: list[list] = [[] for _ in range(batch.num_rows)]
        for i in _suspects(data, offsets):
            text = data[offsets[i] : offsets[i + 1]].tobytes().decode()
            base = base_findings(text)
            found[i] = [list(f) for f in base]
            for s, e in candidates(text):
                known = any(a < e and s < b for a, _, b in base)
                cand[i].append({"s": s, "e": e, "view": window(text, s, e), "known": known})
        arrays = [batch.column("doc_id"), pa.array(found, _SCAN_ARROW.field(1).type), pa.array(cand, _SCAN_ARROW.field(2).type)]
        yield pa.RecordBatch.from_arrays(arrays, schema=_SCAN_ARROW)


# ---------------------------------------------------------------- the network


def codes(views: list[str]) -> np.ndarray:
    """Characters as small numbers, non-ASCII ones alike."""
    chars = np.array(views, dtype=f"<U{_WIDTH}").view(np.uint32).reshape(len(views), _WIDTH)
    return np.minimum(chars, 127).astype(np.int64)


_PARTS = ((0, BEFORE), (BEFORE, BEFORE + INSIDE), (BEFORE + INSIDE, _WIDTH))
_KERNEL = 5


@dataclass
class Network:
    """Embedding, one convolution, a maximum over each of the three parts, a logistic output.

    ``scale`` and ``shift`` calibrate the output; ``threshold`` is on the calibrated score.
    """

    embed: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 1.1

    def forward(self, x: np.ndarray):
        padded = np.pad(x, ((0, 0), (_KERNEL // 2, _KERNEL // 2)), constant_values=32)
        e = self.embed[padded]
        cols = np.concatenate([e[:, i : i + _WIDTH] for i in range(_KERNEL)], axis=2)
        act = cols @ self.kernel + self.bias
        peaks = [a + act[:, a:b].argmax(axis=1) for a, b in _PARTS]
        top = np.stack([np.take_along_axis(act, p[:, None], 1)[:, 0] for p in peaks], axis=1)
        hidden = np.maximum(top, 0).reshape(len(x), -1)
        return cols, peaks, top, hidden, hidden @ self.out[:-1] + self.out[-1]

    def scores(self, x: np.ndarray) -> np.ndarray:
        parts = [self.forward(x[i : i + 512])[-1] for i in range(0, len(x), 512)]
        z = np.concatenate(parts) if parts else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -40, 40)))


def _start(seed: int = 7, filters: int = 24, dim: int = 8) -> Network:
    rng = np.random.default_rng(seed)
    return Network(
        rng.normal(0, 0.5, (128, dim)), rng.normal(0, 0.25, (_KERNEL * dim, filters)), np.zeros(filters), rng.normal(0, 0.1, 3 * filters + 1)
    )


def _blanked(x: np.ndarray) -> np.ndarray:
    """Candidates with blank surroundings."""
    blank = x.copy()
    blank[:, :BEFORE] = 32
    blank[:, BEFORE + INSIDE :] = 32
    return blank


def _moments(net: Network) -> list[np.ndarray]:
    """State of the optimizer before its first step: first and second moments of each parameter, and the number of steps."""
    params = (net.embed, net.kernel, net.bias, net.out)
    return [np.zeros_like(p) for p in (*params, *params)] + [np.zeros(1)]


def _pass(net: Network, state: list[np.ndarray], x: np.ndarray, y: np.ndarray, positive: float, rng: np.random.Generator) -> None:
    """Train ``net`` in place on each example, with and without its surroundings, once; ``positive`` is the share of findings among all examples.

    Half of the examples come with blank surroundings, so that the network also learns what keys
    themselves look like and does not only repeat the patterns' keywords.
    """
    dim, filters = net.embed.shape[1], net.kernel.shape[1]
    params = [net.embed, net.kernel, net.bias, net.out]
    first, second, step = state[:4], state[4:8], state[8]
    blank = _blanked(x)
    weight = np.where(y == 1, 0.5 / positive, 0.5 / (1 - positive))
    order = rng.permutation(2 * len(y))
    for i in range(0, len(order), 64):
        part = order[i : i + 64]
        row = part % len(y)
        xs = np.where((part < len(y))[:, None], x[row], blank[row])
        cols, peaks, top, hidden, z = net.forward(xs)
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[row]) * weight[row] / len(part)
        g_out = np.concatenate([hidden.T @ error, [error.sum()]])
        back = (error[:, None] * net.out[:-1]).reshape(top.shape) * (top > 0)
        g_kernel, g_embed = np.zeros_like(net.kernel), np.zeros_like(net.embed)
        rows = np.arange(len(part))
        padded = np.pad(xs, ((0, 0), (_KERNEL // 2, _KERNEL // 2)), constant_values=32)
        for r, peak in enumerate(peaks):
            for f in range(filters):
                at = peak[:, f]
                g_kernel[:, f] += cols[rows, at].T @ back[:, r, f]
                g_cols = back[:, r, f, None, None] * net.kernel[:, f].reshape(_KERNEL, dim)
                np.add.at(g_embed, padded[rows[:, None], at[:, None] + np.arange(_KERNEL)], g_cols)
        step += 1
        for p, g, m, v in zip(params, (g_embed, g_kernel, back.sum(axis=(0, 1)), g_out), first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= 0.005 * (m / (1 - 0.9 ** step[0])) / (np.sqrt(v / (1 - 0.999 ** step[0])) + 1e-8)


def fit(views: list[str], known: list[bool], recall: float = 0.98, epochs: int = 6, seed: int = 7) -> Network:
    """Train on labelled candidates in one process; every fifth, by position, calibrates instead. ``train`` does so for tables."""
    net, rng = _start(seed), np.random.default_rng(seed)
    y = np.array(known, float)
    x = codes(views) if views else np.zeros((0, _WIDTH), np.int64)
    test = np.arange(len(y)) % 5 == 4
    if not 0 < y[~test].sum() < (~test).sum() or not 0 < y[test].sum() < test.sum():
        return net  # one class only: nothing to learn, nothing is added
    state = _moments(net)
    for _ in range(epochs):
        _pass(net, state, x[~test], y[~test], y[~test].mean(), rng)
    z = np.concatenate([net.forward(x[test])[-1], net.forward(_blanked(x[test]))[-1]])
    truth = np.concatenate([y[test], y[test]])
    positive = truth.sum()
    net.scale, net.shift = _calibrated(lambda w: _slopes(z, truth, w, positive, len(truth) - positive).sum(axis=1))
    findings = np.sort(net.scores(np.concatenate([x[test], _blanked(x[test])]))[truth == 1])
    net.threshold = float(findings[int((1 - recall) * len(findings))])
    return net


def _slopes(z: np.ndarray, truth: np.ndarray, w: np.ndarray, positive: float, negative: float) -> np.ndarray:
    """For each example: slope of the logistic loss in scale and shift, and its three second derivatives."""
    goal = np.where(truth == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    p = 1 / (1 + np.exp(-np.clip(w[0] * z + w[1], -40, 40)))
    bend = p * (1 - p)
    return np.stack([(p - goal) * z, p - goal, bend * z * z, bend * z, bend])


def _calibrated(sums: Callable[[np.ndarray], np.ndarray]) -> tuple[float, float]:
    """Scale and shift that make scores probabilities, by Newton steps on the logistic loss; ``sums`` adds up its ``_slopes``."""
    w = np.array([1.0, 0.0])
    for _ in range(30):
        a, b, zz, z, one = sums(w)
        slope = np.array([a, b]) + 1e-3 * (w - [1.0, 0.0])
        step = np.clip(np.linalg.solve(np.array([[zz, z], [z, one]]) + 1e-3 * np.eye(2), slope), -2, 2)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return float(max(w[0], 1e-3)), float(w[1])


# ---------------------------------------------------------------- training on tables

#: Examples that one task trains on before weights are averaged, about.
SHARD = 20_000

_EXACT = "decimal(38,18)"  # sums of these don't depend on the order of tasks
_SUMMED = "i int, value double"
_SUMMED_ARROW = pa.schema([("i", pa.int32()), ("value", pa.float64())])


def _flat(net: Network, state: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([a.ravel() for a in (net.embed, net.kernel, net.bias, net.out, *state)])


def _unflat(values: np.ndarray) -> tuple[Network, list[np.ndarray]]:
    net = _start()
    state = _moments(net)
    arrays, at = [], 0
    for like in (net.embed, net.kernel, net.bias, net.out, *state):
        arrays.append(values[at : at + like.size].reshape(like.shape).copy())
        at += like.size
    return Network(*arrays[:4]), arrays[4:]


def _means(rows: DataFrame, count: int) -> np.ndarray:
    """Sums of ``value`` for each ``i``, the same in any order of the rows, by ``count``."""
    sums = rows.groupBy("i").agg(F.sum(F.col("value").cast(_EXACT)).alias("value")).orderBy("i").collect()
    return np.array([float(r["value"]) for r in sums]) / count


def _round(examples: DataFrame, shards: int, count: int, positive: float, values: np.ndarray, seed: int) -> np.ndarray:
    """Weights after a pass over every shard that starts with ``values``, averaged by the shards' sizes."""
    shared = examples.sparkSession.sparkContext.broadcast(values)

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        order = table.sort_by([("view", "ascending"), ("known", "ascending")])
        x, y = codes(order.column("view").to_pylist()), np.array(order.column("known").to_pylist(), float)
        net, state = _unflat(shared.value)
        _pass(net, state, x, y, positive, np.random.default_rng([seed, shard]))
        out = _flat(net, state) * len(y)
        return pa.table([pa.array(np.arange(len(out), dtype=np.int32)), pa.array(out)], schema=_SUMMED_ARROW)

    dealt = examples.withColumn("shard", F.pmod(F.xxhash64("view", F.lit(seed)), F.lit(shards)))
    return _means(dealt.groupBy("shard").applyInArrow(run, _SUMMED), count)


def _outputs(examples: DataFrame, net: Network) -> DataFrame:
    """``z, known`` of every example with and without its surroundings."""
    shared = examples.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            x = codes(batch.column("view").to_pylist())
            for version in (x, _blanked(x)):
                # Rounded, so that the size of a batch can't show.
                z = np.round(shared.value.forward(version)[-1], 9)
                yield pa.RecordBatch.from_arrays([pa.array(z), batch.column("known")], names=["z", "known"])

    return stored(examples.select("view", "known").mapInArrow(run, "z double, known boolean"), "outputs")


def _slope_sums(outputs: DataFrame, w: np.ndarray, positive: int, negative: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, truth = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("z", "known"))
            each = _slopes(z, truth, w, positive, negative)
            # Each example is rounded before it is added, so sums are the same however rows were dealt.
            sums = np.round(each * 2.0**20).sum(axis=1) / 2.0**20
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(5, dtype=np.int32)), pa.array(sums)], schema=_SUMMED_ARROW)

    return _means(outputs.select("z", "known").mapInArrow(run, _SUMMED), 1)


def _ranked(values: DataFrame, rank: int, most: int = 4096) -> float:
    """The value of ``z`` that has ``rank`` others before it in ascending order, found by counting in ever smaller ranges."""
    low, high = values.agg(F.min("z"), F.max("z")).first()
    while low < high and values.count() > most:
        width = (high - low) / 1024
        place = F.least(F.floor((F.col("z") - low) / width), F.lit(1023))
        for r in values.groupBy(place.alias("place")).agg(F.count("*").alias("n"), F.min("z").alias("low"), F.max("z").alias("high")).orderBy("place").collect():
            if rank < r["n"]:
                break
            rank -= r["n"]
        low, high = r["low"], r["high"]
        values = values.where(F.col("z").between(low, high))
    return low if low == high else sorted(r["z"] for r in values.collect())[rank]


def train(scanned: DataFrame, recall: float = 0.98, epochs: int = 6, seed: int = 9) -> Network:
    """Fit on all distinct candidates: four fifths of them train, in shards of a bounded size, and the others calibrate.

    The same candidates give the same network, however rows are dealt among tasks.
    """
    views = scanned.select(F.explode("cand").alias("c")).select("c.view", "c.known").distinct()
    test = F.pmod(F.xxhash64("view", F.lit(seed + 1)), F.lit(5)) == 4
    views = stored(views.withColumn("test", test), "views")
    counts = {(r["test"], r["known"]): r["count"] for r in views.groupBy("test", "known").count().collect()}
    net = _start()
    if any((t, k) not in counts for t in (False, True) for k in (False, True)):
        return net  # one class only: nothing to learn, nothing is added
    examples, count = views.where("not test"), counts[False, True] + counts[False, False]
    shards = -(-count // SHARD)
    values = _flat(net, _moments(net))
    for epoch in range(epochs):
        values = _round(examples, shards, count, counts[False, True] / count, values, seed + 10 + epoch)
    net, _ = _unflat(values)
    outputs = _outputs(views.where("test"), net)
    positive, negative = 2 * counts[True, True], 2 * counts[True, False]
    net.scale, net.shift = _calibrated(lambda w: _slope_sums(outputs, w, positive, negative))
    lowest = _ranked(outputs.where("known").select("z"), int((1 - recall) * positive))
    net.threshold = float(1 / (1 + np.exp(-np.clip(net.scale * (lowest - 1e-9) + net.shift, -40, 40))))
    return net


_RESULT = "doc_id long, n_assign long, n_access long, n_hex long, n_cnn long, base_sha256 string, spans string"
_RESULT_ARROW = pa.schema(
    [(n, pa.string() if n in ("base_sha256", "spans") else pa.int64()) for n in (x.split()[0] for x in _RESULT.split(", "))]
)


def find(docs: DataFrame, recall: float = 0.98) -> DataFrame:
    """Secrets of each row of ``docs``.

    Returns ``doc_id, n_assign, n_access, n_hex, n_cnn, base_sha256, spans``;
    ``spans`` lists ``kind:start:end`` in code points, ends exclusive, by start and kind.
    NULL and empty texts have no spans. Rows with equal or NULL ids are
    scanned one by one. Without both findings and other candidates there is no network and
    nothing is added. Other columns are not looked at.
    """
    scanned = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan, _SCAN), "secrets")
    shared = docs.sparkSession.sparkContext.broadcast(train(scanned, recall))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            rows = batch.to_pylist()
            views = [c["view"] for r in rows for c in r["cand"] if not c["known"]]
            score = iter(net.scores(codes(views)) if views else ())
            out = []
            for r in rows:
                base = [tuple(f) for f in r["found"]]
                more = [(c["s"], 3, c["e"]) for c in r["cand"] if not c["known"] and next(score) >= net.threshold]
                counts = [sum(k == i for _, k, _ in base) for i in range(3)]
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                out.append((r["doc_id"], *counts, len(more), digest, written(base + more)))
            columns = [list(c) for c in zip(*out, strict=True)] if out else [[] for _ in _RESULT_ARROW]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RESULT_ARROW, strict=True)], schema=_RESULT_ARROW)

    return scanned.mapInArrow(run, _RESULT)
