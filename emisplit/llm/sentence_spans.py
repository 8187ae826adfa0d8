"""Substring dedup with sliding spans of sentences, in built-in functions only.

A text is cut into sentences: runs of at most ``LONGEST`` words that end at a
word with a closing mark, at a line end or at that length. Every run of ``RUN``
consecutive sentences is hashed; hashes are counted over all texts; sentences
covered by a span that occurs before, in this text or in an earlier one, go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emisplit.llm.common import shielded, stored
from emisplit.session import tune

#: Sentences in a span, and the least length of a span in characters.
RUN = 3
SHORTEST = 40
LONGEST = 12

_BLANK = r" \t\r"
#: Words without a closing mark and their blanks, then one word with what follows it up to the next word.
SENTENCE = rf"(?:[^{_BLANK}\n]*[^{_BLANK}\n.!?][{_BLANK}]+){{0,{LONGEST - 1}}}[^{_BLANK}\n]*[{_BLANK}\n]*"


def sentences(text: Column) -> Column:
    """The sentences with the blanks behind them; joined they are the text."""
    return F.filter(F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0)), lambda s: s != "")


def spans(text: Column) -> Column:
    """``struct<first, h1, h2>`` of every span of at least ``SHORTEST`` characters.

    Blanks at the ends of sentences don't count. The two hashes are seeded
    apart, 128 bits in all.
    """

    def hashed(trimmed: Column) -> Column:
        def one(i: Column) -> Column:
            body = F.concat_ws(" ", *[trimmed[i - 1 + k] for k in range(RUN)])
            return F.struct(
                i.alias("first"),
                F.length(body).alias("size"),
                F.xxhash64(body).alias("h1"),
                F.xxhash64(F.lit(1), body).alias("h2"),
            )

        every = F.transform(F.sequence(F.lit(1), F.size(trimmed) - (RUN - 1)), one)
        return F.when(F.size(trimmed) >= RUN, F.filter(every, lambda s: s["size"] >= SHORTEST))

    trimmed = F.transform(sentences(text), lambda s: F.rtrim(s, F.lit(" \t\r\n")))
    return F.transform(F.array(trimmed), hashed)[0]


def repeated(rows: DataFrame) -> DataFrame:
    """``row, first`` of every span that occurs before; ``rows`` has ``row, doc_id, text``.

    The earliest occurrence is the one with the smallest document id, then row hash, then place.
    """
    keyed = rows.where("text is not null").select("doc_id", "row", F.explode(spans(F.col("text"))).alias("s"))
    keyed = keyed.select(F.struct("doc_id", "row", "s.first").alias("place"), "s.h1", "s.h2")
    firsts = keyed.groupBy("h1", "h2").agg(F.min("place").alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n")
    # Stored, so that the join reads it through a shuffle of its own and a hot span can be split.
    firsts = stored(firsts, "spans")
    return keyed.join(firsts, ["h1", "h2"]).where("place != kept").select("place.row", "place.first")


@shielded
def dedup_spans(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated spans; plus ``n_sentences`` and ``removed_sentences``.

    What stays of a text is its other sentences, byte for byte and in order.
    Texts with fewer than ``RUN`` sentences stay whole. A text all of whose
    spans occur earlier becomes empty. NULL texts stay NULL and have no
    sentences. Rows that are equal in id and text are one row for the search and are
    treated alike, so copies under one id keep what the first keeps. No rows
    give no rows. Other columns come back as they are.
    """
    tune(docs.sparkSession)
    names = list(docs.columns)
    marked = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    # Copies of a row share id, hash and places, so no copy is an earlier occurrence of another.
    gone = repeated(marked.select(F.col("__row").alias("row"), "doc_id", "text"))
    gone = gone.groupBy("row").agg(F.array_sort(F.collect_set("first")).alias("__gone"))
    joined = marked.join(gone.withColumnRenamed("row", "__row"), "__row", "left")
    starts = F.coalesce(F.col("__gone"), F.array().cast("array<int>"))

    def rest(parts: Column) -> Column:
        def between(k: Column) -> Column:
            start = F.when(k > 0, F.element_at(starts, F.greatest(k, F.lit(1))) + RUN).otherwise(1)
            end = F.when(k < F.size(starts), F.element_at(starts, F.least(k + 1, F.size(starts))) - 1).otherwise(F.size(parts))
            return F.slice(parts, start, F.greatest(end - start + 1, F.lit(0)))

        kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size(starts)), between))
        return F.struct(F.size(parts).alias("n"), F.size(kept).alias("left"), F.array_join(kept, "").alias("text"))

    done = F.transform(F.array(sentences(F.coalesce("text", F.lit("")))), rest)[0]
    joined = joined.withColumn("__done", done)
    text = F.when(F.col("text").isNotNull(), F.col("__done.text"))
    columns = [text.alias("text") if n == "text" else joined[n] for n in names]
    n, left = F.col("__done.n").cast("long"), F.col("__done.left").cast("long")
    return joined.select(*columns, n.alias("n_sentences"), (n - left).alias("removed_sentences"))

