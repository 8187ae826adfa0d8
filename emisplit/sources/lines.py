"""Line parsers: text lines in a DataFrame column to typed tables.

All of them take a DataFrame with a string column ``value``, one input line per
row, so the same parser serves files and lines that Spark derived elsewhere.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emisplit.schemas import INVTABLE_WIDTHS, REQUIRED, schema


def clean_text(text: Column | str) -> Column:
    """Drop every character outside printable ASCII and newline."""
    col = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(col, r"[^\x20-\x7E\n]", "")


def _without_comments(lines: DataFrame) -> DataFrame:
    return lines.where(~F.col("value").startswith("#"))


def _typed(field: T.StructField, text: Column) -> Column:
    """One text field as its column type; a malformed number raises."""
    bare = F.regexp_replace(text, '"', "")
    if isinstance(field.dataType, T.StringType):
        return F.coalesce(bare, F.lit("")).alias(field.name)
    return F.trim(F.coalesce(bare, F.lit(""))).cast(field.dataType).alias(field.name)


def parse_csv(lines: DataFrame, table: str) -> DataFrame:
    """Headerless quoted CSV in the column order of ``table``.

    Lines starting with ``#`` are skipped. A line with too few or too many
    fields, or a number that does not parse, fails the whole read.
    """
    fields = schema(table).fields
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
    options = {"mode": "FAILFAST", "escape": '"', "nullValue": "\u0001"}
    # The schema travels as DDL text; backquotes keep words such as `comment`.
    ddl = ", ".join(f"`{f.name}` string" for f in raw)
    parsed = _without_comments(lines).select(F.from_csv("value", ddl, options).alias("row"))
    return parsed.select(*[_typed(f, F.col("row")[f.name]) for f in fields])


def parse_plain(lines: DataFrame, table: str) -> DataFrame:
    """Plain comma split: quotes are removed, nothing is quoted or skipped."""
    fields = schema(table).fields
    parts = lines.select("value", F.split("value", ",").alias("parts"))
    complete = F.when(F.size("parts") == len(fields), F.col("parts")).otherwise(
        F.raise_error(F.format_string(f"{table}: expected {len(fields)} fields in line: %s", "value"))
    )
    checked = parts.select(complete.alias("parts"))
    return checked.select(*[_typed(f, F.col("parts")[i]) for i, f in enumerate(fields)])


def parse_invtable(lines: DataFrame) -> DataFrame:
    """Fixed-width inventory table; every field is trimmed on both sides."""
    starts = accumulate(INVTABLE_WIDTHS, initial=1)
    fields = schema("invtable").fields
    return _without_comments(lines).select(
        *[
            _typed(field, F.regexp_replace(F.substring("value", start, width), r"^\s+|\s+$", ""))
            for field, start, width in zip(fields, starts, INVTABLE_WIDTHS)
        ]
    )


#: What ``judged_lines`` keeps of a line besides its fields.
PLACE = ("file", "block", "mark")


def numbered_lines(lines: DataFrame) -> DataFrame:
    """File lines with their place: the file, the byte its block starts at, and a number that grows within a block."""
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("mark"),
    )


def judged_lines(lines: DataFrame, table: str, *, plain: bool = False) -> DataFrame:
    """The fields of ``table``, ``problem`` (NULL for a good line), and the other columns of ``lines``.

    ``plain`` lines are split at commas and have no quoting or comments. A bad line has a problem for a wrong number of fields or else for each field that is
    no value of its type; an empty text is a value of text columns only.
    """
    fields = schema(table).fields
    others = [F.col(c) for c in lines.columns]
    if table == "invtable":
        starts = accumulate(INVTABLE_WIDTHS, initial=1)
        texts = [F.regexp_replace(F.substring("value", s, w), r"^\s+|\s+$", "") for s, w in zip(starts, INVTABLE_WIDTHS)]
        rows, wrong = _without_comments(lines).select(*others, F.array(*texts).alias("texts")), F.lit(False)
    elif plain:
        rows = lines.select(*others, F.split("value", ",").alias("texts"))
        wrong = F.size("texts") != len(fields)
    else:
        ddl = ", ".join(f"`{f.name}` string" for f in fields) + ", `bad line` string"
        options = {"mode": "PERMISSIVE", "escape": '"', "nullValue": "\u0001", "columnNameOfCorruptRecord": "bad line"}
        parsed = _without_comments(lines).select(*others, F.from_csv("value", ddl, options).alias("row"))
        rows = parsed.select(*others, F.array(*[F.col("row")[f.name] for f in fields]).alias("texts"), F.col("row")["bad line"].alias("bad line"))
        wrong = F.col("`bad line`").isNotNull()
    rows = rows.withColumn("wrong", wrong)
    named, problems = [], [F.when(F.col("wrong"), f"expected {len(fields)} fields")]
    for i, f in enumerate(fields):
        bare = F.coalesce(F.regexp_replace(F.get("texts", F.lit(i)), '"', ""), F.lit(""))
        if isinstance(f.dataType, T.StringType):
            named.append(bare.alias(f.name))
            continue
        value = F.trim(bare).try_cast(f.dataType)
        named.append(value.alias(f.name))
        kind = f"{f.name} is no {f.dataType.simpleString()}: "
        problems.append(F.when(~F.col("wrong") & value.isNull(), F.concat(F.lit(kind), bare)))
    problem = F.concat_ws("; ", *problems)
    return rows.select(*named, F.when(problem != "", problem).alias("problem"), *others)


def line_numbers(found: DataFrame, lines: DataFrame) -> DataFrame:
    """``found`` rows of ``numbered_lines`` with ``line``, their number in their file from 1 on."""
    blocks = lines.groupBy("file", "block").agg(F.min("mark").alias("first"), F.count("*").alias("many"))
    # One row per block of a file, which has many lines.
    so_far = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select("file", "block", "first", F.coalesce(F.sum("many").over(so_far), F.lit(0)).alias("before"))
    line = F.col("before") + F.col("mark") - F.col("first") + 1
    return found.join(before, ["file", "block"]).withColumn("line", line).drop("block", "mark", "first", "before")


def parse_process_modes(lines: DataFrame) -> DataFrame:
    """Profile and process mode pairs of a ``;`` separated cross-reference.

    A line counts when its third field holds VOC or TOG after a quoted mode
    prefix, as in ``"EXH__VOC"``.
    """
    fields = _without_comments(lines).select(F.split("value", ";").alias("f"))
    pollutant = F.get("f", F.lit(2))
    return (
        fields.where(F.substring(pollutant, 7, 3).isin("VOC", "TOG"))
        .select(
            F.regexp_replace(F.get("f", F.lit(1)), '"', "").alias("profile_id"),
            F.substring(pollutant, 2, 3).alias("process"),
        )
        .distinct()
    )


def missing_values(rows: DataFrame, table: str) -> DataFrame:
    """Rows with NULL in a column that must be filled."""
    required = REQUIRED.get(table, [])
    blank = F.lit(False)
    for name in required:
        blank = blank | F.col(name).isNull()
    return rows.where(blank)
