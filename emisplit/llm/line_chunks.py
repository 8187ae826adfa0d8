"""Line dedup with content-defined chunks of lines, in built-in functions only.

A rolling hash over the hashes of ``window`` neighbouring lines decides where a
chunk ends, so boundaries depend on nearby lines alone and the same passage is
cut the same way wherever it stands. Chunks of several lines are hashed, hashes
that occur more than once anywhere are looked up, and each later chunk is
compared byte by byte with the first one of its hash before it is removed.

Only hashes and positions are shuffled to find repeats; texts meet their own
repeats by document id and are compared chunk by chunk afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emisplit.llm.common import shielded, stored
from emisplit.session import tune


def _number(text: Column, digits: int = 13) -> Column:
    """A number from the MD5 of a text, the same in every SQL engine."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def _let(value: Column, body) -> Column:
    """``body`` of ``value`` with ``value`` worked out once, also inside lambda functions."""
    return F.transform(F.array(value), body)[0]


def chunks(text: Column, window: int = 2, divisor: int = 3) -> Column:
    """Chunks of a text as an array of ``struct<first, size, body>``.

    ``first`` is the number of the chunk's first line from 1 on. A line ends a chunk if the sum of
    the hashes of the last ``window`` lines, each shifted by its place, is 0 modulo ``divisor``; the
    last line of a text does too. Texts of up to ``window - 1`` lines are one chunk.
    """

    def cut(lines: Column) -> Column:
        def by_hash(hashes: Column) -> Column:
            n = F.size(lines)
            rolling = lambda i: sum((hashes[i - 1 - k] * (k + 1) for k in range(window)), F.lit(0).cast("long"))
            ends = F.filter(
                F.sequence(F.lit(1), n), lambda i: (i == n) | F.when(i >= window, rolling(i) % divisor == 0).otherwise(False)
            )

            def bodies(e: Column) -> Column:
                def one(end: Column, k: Column) -> Column:
                    first = F.when(k > 0, e[F.greatest(k - 1, F.lit(0))] + 1).otherwise(1)
                    body = F.array_join(F.slice(lines, first, end - first + 1), "\n")
                    return F.struct(first.alias("first"), (end - first + 1).alias("size"), body.alias("body"))

                return F.transform(e, one)

            return _let(ends, bodies)

        return _let(F.transform(lines, lambda line: _number(line)), by_hash)

    return _let(F.split(text, "\n", -1), cut)


def repeated(docs: DataFrame, window: int = 2, divisor: int = 3) -> DataFrame:
    """``row, doc_id, first, size`` of every chunk to remove: it repeats an earlier one.

    The earliest chunk by (document id, row hash, line) stays.
    """
    texts = docs.where("text is not null").select("row", "doc_id", "text")
    parts = texts.select("row", "doc_id", F.explode(chunks(F.col("text"), window, divisor)).alias("c")).where("c.size > 1")
    place = F.struct("doc_id", "row", F.col("c.first").alias("first"))
    keyed = parts.select(
        F.xxhash64("c.body").alias("h1"), F.xxhash64(F.lit(1), "c.body").alias("h2"), place.alias("place"), F.col("c.size").alias("size")
    )
    keyed = stored(keyed, "chunks")
    firsts = keyed.groupBy("h1", "h2").agg(F.min("place").alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n")
    # Stored, so that the join reads it through a shuffle of its own and a hot hash can be split.
    firsts = stored(firsts, "firsts")
    seen = stored(keyed.join(firsts, ["h1", "h2"]), "repeats")

    # Each document that has a repeat, or the first one of it, cuts out the chunks to compare.
    is_kept = F.col("place") == F.col("kept")
    asked = seen.select("place.row", F.struct("place.first", "size", "h1", "h2", is_kept.alias("is_kept")).alias("w"))
    asked = asked.groupBy("row").agg(F.collect_set("w").alias("asked"))

    def cut(lines: Column) -> Column:
        body = lambda w: F.array_join(F.slice(lines, w["first"], w["size"]), "\n")
        return F.transform("asked", lambda w: F.struct(w.alias("w"), body(w).alias("body")))

    cuts = _let(F.split("text", "\n", -1), cut)
    bodies = texts.join(asked, "row").select("row", "doc_id", F.explode(cuts).alias("c")).select("row", "doc_id", "c.w.*", "c.body")
    bodies = stored(bodies, "bodies")
    original = bodies.where("is_kept").dropDuplicates(["h1", "h2"]).select("h1", "h2", F.col("body").alias("kept_body"))
    return (
        bodies.where("not is_kept")
        .join(original, ["h1", "h2"])
        .where("body = kept_body")
        .select("row", "doc_id", "first", "size")
    )


@shielded
def dedup_lines(docs: DataFrame, window: int = 2, divisor: int = 3) -> DataFrame:
    """``docs`` without repeated chunks of lines; plus ``removed_lines``, ``removed_chunks``.

    Lines end at LF; empty lines count. A chunk is removed with its line ends;
    the lines that stay are joined by LF again. A text none of whose chunks
    repeats comes back byte for byte; one that is removed whole becomes empty. NULL texts
    stay NULL. Chunks of one line stay. Repeats within a text count too. Rows
    that are equal in id and text are one row for the search and are treated alike, so
    copies under one id keep what the first keeps. No rows give no rows. Other columns come back as they are.
    """
    tune(docs.sparkSession)
    names = list(docs.columns)
    marked = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    # Copies of a row share id, hash and places, so no copy is an earlier occurrence of another.
    gone = repeated(marked.select(F.col("__row").alias("row"), "doc_id", "text"), window, divisor)
    gone = gone.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("first", "size"))).alias("__gone"))
    joined = marked.join(gone.withColumnRenamed("row", "__row"), "__row", "left")

    def rest(lines: Column) -> Column:
        def between(k: Column) -> Column:
            before = F.element_at(ranges, F.greatest(k, F.lit(1)))
            start = F.when(k > 0, before["first"] + before["size"]).otherwise(1)
            end = F.when(k < F.size(ranges), F.element_at(ranges, F.least(k + 1, F.size(ranges)))["first"] - 1).otherwise(F.size(lines))
            return F.slice(lines, start, F.greatest(end - start + 1, F.lit(0)))

        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(ranges)), between)), "\n")

    ranges = F.col("__gone")
    kept = _let(F.split("text", "\n", -1), rest)
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept)
    lost = F.coalesce(F.aggregate("__gone", F.lit(0), lambda t, g: t + g["size"]), F.lit(0)).cast("long")
    count = F.coalesce(F.size("__gone"), F.lit(0)).cast("long")
    columns = [text.alias("text") if n == "text" else joined[n] for n in names]
    return joined.select(*columns, lost.alias("removed_lines"), F.greatest(count, F.lit(0)).alias("removed_chunks"))
