"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text's subwords are its runs of three and of four bytes in lower case, taken
over letters and single blanks. Each is hashed to a bucket with an embedding; the embeddings are
averaged over the whole text and fed to a linear softmax. Both layers are
trained together by stochastic gradient descent in numpy on a bounded sample.
As the model is linear after the average, prediction uses each bucket's product
with the softmax weights, which is the same sum at a fraction of the reads.

Scores are calibrated with a temperature fitted on a part of the sample that
training never saw. So are the two rejection thresholds, fractions of a low quantile
that right answers there reach: of the score, and of the share of subwords that
training has seen. The largest of k probabilities is 1 / k at least and says nothing of
texts unlike all that was learned; those have few subwords in common with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emisplit.llm.common import buffer, shielded, slices

UNKNOWN = "und"
_BITS = 17
#: Bytes of text that a task looks at together; arrays take about seventy times as much.
_SLICE = 1 << 19

# Bytes of a text as subwords see them: letters in lower case, bytes of non-ASCII characters, all else blank.
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def held_out(doc_id: Column) -> Column:
    """Documents that training must not see; documents without an id belong to them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every subword, index of each text's first one and the total)."""
    folded = _FOLD[data]
    blank = folded == 0x20
    keep = ~blank
    keep[1:] |= ~blank[:-1]  # of several blanks the first stays
    # A text begins with its first letter, whatever text stands before it.
    begin = offsets[:-1][offsets[:-1] < len(data)]
    keep[begin] = ~blank[begin]
    starts = np.concatenate([[0], np.cumsum(keep)])[offsets]
    folded = folded[keep].astype(np.uint32)
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(starts))
    buckets, rows = [], []
    for width, factor in ((3, 0x9E3779B1), (4, 0x85EBCA6B)):
        count = len(folded) - width + 1
        if count <= 0:
            continue
        gram = np.zeros(count, np.uint32)
        for i in range(width):
            gram |= folded[i : i + count] << np.uint32(8 * i)
        inside = row[:count] == row[width - 1 :]
        gram = gram[inside] * np.uint32(factor)
        buckets.append((gram >> np.uint32(32 - _BITS)).astype(np.int32) + ((width - 3) << _BITS))
        rows.append(row[:count][inside])
    if not buckets:
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    bucket, rows = np.concatenate(buckets), np.concatenate(rows)
    order = np.argsort(rows, kind="stable")
    return bucket[order], np.searchsorted(rows[order], np.arange(len(offsets)))


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def shares(known: np.ndarray, bucket: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Share of each text's subwords that are known; 1 for texts without any."""
    out, counts = np.ones(len(first) - 1), np.diff(first)
    some = np.flatnonzero(counts)
    if len(some):
        out[some] = np.add.reduceat(known[bucket], first[some], dtype=np.int64) / counts[some]
    return out


@dataclass(frozen=True)
class Model:
    """``table`` has each bucket's share of the logits; ``temperature`` calibrates them.

    ``known`` marks the buckets training has seen; texts with a score below ``threshold`` or
    a share of known subwords below ``least_known`` are rejected.
    """

    langs: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float
    known: np.ndarray
    least_known: float

    def logits(self, bucket: np.ndarray, first: np.ndarray) -> np.ndarray:
        out = np.zeros((len(first) - 1, len(self.langs)), np.float64)
        counts = np.diff(first)
        some = np.flatnonzero(counts)
        if len(some):
            for j in range(len(self.langs)):
                out[some, j] = np.add.reduceat(self.table[:, j][bucket], first[some]) / counts[some]
        return out + self.bias

    def judge(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of the languages, and whether a text is unlike all of them."""
        bucket, first = subwords(data, offsets)
        p = _softmax(self.logits(bucket, first) / self.temperature)
        return p, (p.max(axis=1) < self.threshold) | (shares(self.known, bucket, first) < self.least_known)


def fit(
    texts: list[str], langs: list[str], dim: int = 16, epochs: int = 4, rate: float = 0.5, seed: int = 3
) -> Model:
    """Train on labelled texts; every fifth, by position, calibrates instead."""
    names = tuple(sorted(set(langs)))
    if not names:
        return Model((), np.zeros((2 << _BITS, 0), np.float32), np.zeros(0), 1.0, 0.0, np.zeros(2 << _BITS, bool), 0.0)
    labels = np.array([names.index(x) for x in langs])
    raw = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    used = [np.unique(subwords(r, np.array([0, len(r)]))[0], return_counts=True) for r in raw]
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 1 / dim, (2 << _BITS, dim)).astype(np.float32)
    weight, bias = np.zeros((dim, len(names)), np.float32), np.zeros(len(names), np.float32)
    kept = np.arange(len(texts)) % 5 == 4 if len(texts) >= 50 else np.zeros(len(texts), bool)
    train, steps, done = np.flatnonzero(~kept), epochs * int((~kept).sum()), 0
    for _ in range(epochs):
        for i in rng.permutation(train):
            step = rate * (1 - done / steps)
            done += 1
            bucket, count = used[i]
            if not len(bucket):
                continue
            share = (count / count.sum()).astype(np.float32)
            hidden = share @ embed[bucket]
            error = _softmax((hidden @ weight + bias)[None])[0]
            error[labels[i]] -= 1
            back = weight @ error
            weight -= step * np.outer(hidden, error)
            bias -= 0.01 * step * error
            # Long texts spread a step over many subwords; scale it so that the average moves by about one step.
            embed[bucket] -= step * min(1 / float(share @ share), 64.0) * share[:, None] * back
    seen = np.zeros(2 << _BITS, np.int64)
    for i in train:
        seen[used[i][0]] += 1
    model = Model(names, embed @ weight, bias.astype(np.float64), 1.0, 0.0, seen > 0, 0.0)
    checks = np.flatnonzero(kept) if kept.any() else train
    data = np.concatenate([raw[i] for i in checks])
    bucket, first = subwords(data, np.concatenate([[0], np.cumsum([len(raw[i]) for i in checks])]))
    logits = model.logits(bucket, first)
    truth = labels[checks]

    def loss(t: float) -> float:
        return -np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean()

    temperature = min(np.geomspace(0.05, 20, 61), key=loss)
    p = _softmax(logits / temperature)
    right = p.argmax(axis=1) == truth
    if not right.any():
        return replace(model, temperature=float(temperature))
    # Half of what all but one in a hundred right answers reach. Texts that training saw know a subword if another one has it.
    share = shares(model.known if kept.any() else seen > 1, bucket, first)
    lows = [0.5 * float(np.quantile(x[right], 0.01, method="lower")) for x in (p.max(axis=1), share)]
    return replace(model, temperature=float(temperature), threshold=lows[0], least_known=lows[1])


def train(docs: DataFrame, per_lang: int = 500, most_langs: int = 400, seed: int = 5) -> Model:
    """Fit on a sample of about ``per_lang`` labelled texts of each language.

    The sample is drawn by a hash of the id among documents that are not held
    out, have a language and a letter; it is the only part of this operator
    that does not see all rows. All languages are learned; more than ``most_langs`` would make a model
    too large to send to every task, and raise.
    """
    rows = docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_langs + 1).collect()
    if not counts:
        return fit([], [])
    if len(counts) > most_langs:
        raise ValueError(f"more than {most_langs} languages to learn: raise most_langs, or name fewer languages")
    part = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / (1 << 30)
    quota = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], per_lang / r["count"])])
    chosen = rows.where(part < quota[F.col("lang")]).where(has_letter(F.col("text")))
    sample = chosen.orderBy(F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id").limit(2 * per_lang * len(counts)).collect()
    return fit([r["text"] for r in sample], [r["lang"] for r in sample])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of each row of ``docs``.

    The whole text counts. Texts that are NULL, empty or without a letter get
    ``und`` with score 0 and are rejected, as are texts scored below the
    model's threshold and those with too few subwords that training has seen. Rows with equal ids are predicted one by one. NULL ids
    count as held out. A model without languages rejects everything. Language
    and other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in (s for b in batches for s in slices(b, "text", _SLICE)):
            data, offsets = buffer(batch.column("text"))
            letters = batch.column("__letter").to_numpy(zero_copy_only=False).astype(bool) & bool(m.langs)
            if m.langs:
                p, unlike = m.judge(data, offsets)
                best, score = p.argmax(axis=1), np.where(letters, p.max(axis=1), 0.0)
            else:
                best, score, unlike = np.zeros(batch.num_rows, int), np.zeros(batch.num_rows), np.ones(batch.num_rows, bool)
            lang = [m.langs[i] if ok else UNKNOWN for i, ok in zip(best, letters, strict=True)]
            rejected = ~letters | unlike
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(lang), pa.array(score), pa.array(rejected)],
                schema=names,
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        held_out(F.col("doc_id")).alias("held_out"),
        has_letter(F.col("text")).alias("__letter"),
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame, per_lang: int = 500) -> DataFrame:
    """Train on a bounded sample of ``docs`` and predict all of them."""
    return predict(docs, train(docs, per_lang))


@shielded
def keep_identified(docs: DataFrame, per_lang: int = 500) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, with the columns of ``docs``.

    Rows without an id are judged together with all others; a row goes if a row with its
    id and text is rejected.
    """
    judged = docs.withColumn("__judged", F.xxhash64("doc_id", "text"))
    by_row = predict(judged.select(F.col("__judged").alias("doc_id"), "text"), train(docs, per_lang))
    rejected = by_row.where("rejected").select(F.col("doc_id").alias("__judged")).distinct()
    return judged.join(rejected, "__judged", "left_anti").select(*docs.columns)
