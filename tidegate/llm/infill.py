"""Fill-in-the-middle: a text's tokens are cut in three and written in another order.

A token is a run of other characters with the white space before it, or white space at the end of
the text; tokens join to the text again. ``regexp_count`` gives their number, hashes of the id
choose the two cuts, and one match of a pattern made for the row, with counted possessive groups of
whole tokens, captures prefix, middle and suffix. A possessive count is matched in a loop, never by
recursion or by trying again, so a text may have any number of tokens. Everything is a column
expression over whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One token. The second branch is reached at the end of a text only.
UNIT = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = "<[PSM]>"
PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Infill:
    """What is transformed: per cent of texts, per cent of those suffix first, and the seed."""

    rate: int = 50
    suffix_first: int = 80
    seed: int = 42


def hash_groups(id_column: str, seed: int, n: int = 4) -> list[Column]:
    """The first ``n`` groups of eight hex digits of SHA-256 of ``seed:id``, as numbers.

    A NULL id counts as empty text.
    """
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    digest = F.sha2(named, 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(n)]


def pattern(before: Column, between: Column) -> Column:
    """The pattern of a row that takes so many tokens, then so many, then the rest."""
    counted = [F.concat(F.lit(f"((?:{UNIT}){{"), n.cast("string"), F.lit("}+)")) for n in (before, between)]
    return F.concat(F.lit(r"(?s)\A"), *counted, F.lit(r"(.*+)\z"))


def transform(docs: DataFrame, settings: Infill = Infill()) -> DataFrame:
    """doc_id, text, n, form, prefix, middle, suffix and output, a row for each row of ``docs``.

    ``n`` is the number of tokens. Form is plain, and the parts are NULL, where the text is empty or
    NULL, where it has a mark in it already, or where the hash says so; output is then the text.
    Parts may be empty. Rows with equal ids are cut alike as far as their texts are; other columns
    are left out.
    """
    h1, h2, h3, h4 = hash_groups("doc_id", settings.seed)
    counted = docs.select(
        "doc_id",
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).withColumn("n", F.regexp_count("text", F.lit(UNIT)).cast("long"))
    has_mark = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        has_mark = has_mark | F.contains("text", F.lit(mark))
    plain = (F.col("text") == "") | has_mark | (h3 % 100 >= settings.rate)
    cuts = [h % (F.col("n") + 1) for h in (h1, h2)]
    shaped = counted.select(
        "*",
        F.when(plain, F.lit(PLAIN))
        .when(h4 % 100 < settings.suffix_first, F.lit(SPM))
        .otherwise(F.lit(PSM))
        .alias("form"),
        F.least(*cuts).alias("low"),
        F.greatest(*cuts).alias("high"),
    )
    # no mark is in the text, and none can arise where a part meets a mark, so the marks cut exactly
    marked = F.regexp_replace(
        "text",
        pattern(F.col("low"), F.col("high") - F.col("low")),
        F.lit(f"$1{MIDDLE}$2{SUFFIX}$3"),
    )
    parts = shaped.withColumn("parts", F.when(F.col("form") != PLAIN, F.split(marked, MARKS, -1)))
    prefix, middle, suffix = (F.col("parts")[i] for i in range(3))
    return parts.select(
        "doc_id",
        "text",
        "n",
        "form",
        prefix.alias("prefix"),
        middle.alias("middle"),
        suffix.alias("suffix"),
        F.when(F.col("form") == PLAIN, F.col("text"))
        .when(
            F.col("form") == PSM,
            F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle),
        )
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that ``transform`` was given, from what it made of it."""
    parts = F.split(output, MARKS, -1)  # the first is what is before the first mark: nothing
    return (
        F.when(form == PLAIN, output)
        .when(form == PSM, F.concat(parts[1], parts[3], parts[2]))
        .when(form == SPM, F.concat(parts[2], parts[3], parts[1]))
    )


def digests(transformed: DataFrame) -> DataFrame:
    """doc_id, n, form, the lengths of prefix and middle, and digests of output and rebuilt text."""
    return transformed.select(
        "doc_id",
        "n",
        "form",
        F.char_length("prefix").cast("long").alias("prefix_chars"),
        F.char_length("middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
