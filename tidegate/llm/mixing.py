"""Mixing sources to target weights: Sainte-Laguë apportionment of equal-token blocks.

1. A source's target is its weight's share of all words, at most ``MAX_REPEAT`` times its size,
   the excess shared out again by weight.
2. Units of equal size, at most a FINEST of the smallest target, go to sources by highest quotients
   target / (2k + 1): integer quotas, turned into blocks of the source's own size.
3. A source's blocks go to its shards (documents dealt by a seeded hash) in the same way.
4. In a shard the documents form a line in seeded order, cut into equal blocks. A quota takes
   whole passes over the line, and the rest as evenly spaced blocks from a seeded offset.

Which words of a document are taken follows from its place on the line by arithmetic, so blocks
are never rows. DataFrame functions only; the one wide step is a running sum within a shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.llm.common import WORD, saved

MAX_REPEAT = 3
#: About so many blocks are given out in all, whatever the size of the corpus, and more of sources
#: whose target would otherwise be under FINEST of them.
BLOCKS = 1 << 16
FINEST = 100
#: Documents of a shard on average; a source has up to SHARDS shards, which hold more beyond that.
SHARD_DOCS = 128
SHARDS = 4096
SEED = 17


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame) -> DataFrame:
    """Adds ``weight`` and ``target`` to a table of source, source_size (one row a source).

    Water-filling: sources whose cap binds are those of the least cap per weight. In that order,
    sharing what the caps before a source leave over the weights from it on gives a level; the
    first source whose cap lies above its level fixes the level of all that follow.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = sources.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1).withColumn(
        "limit", (MAX_REPEAT * F.col("source_size")).cast("double")
    )
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    filled = (
        weighted.withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("spent", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("spent")) / F.sum("weight").over(after))
        .withColumn("free", F.col("level") * F.col("weight") < F.col("limit"))
        .withColumn(
            "level",
            F.first(F.when(F.col("free"), F.col("level")), ignorenulls=True).over(
                order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            ),
        )
    )
    target = F.least(
        F.col("limit"), F.coalesce(F.col("level") * F.col("weight"), F.col("limit"))
    )
    return filled.withColumn("target", target).select("source", "source_size", "weight", "target")


def sainte_lague(claims: DataFrame, within: list[str], key: list[str]) -> DataFrame:
    """``quota`` for each row: ``seats`` seats of a group given to ``claim`` by highest quotients.

    With a divisor of (sum of claims) / (seats ± rows / 2), rounding gives too few or too many
    seats. So only the quotients between the two are ranked: about two for each claimant.
    """
    group = Window.partitionBy(*within)
    n, total = F.count(F.lit(1)).over(group), F.sum("claim").over(group)

    def rounded(seats: Column) -> Column:
        return F.floor(F.col("claim") * F.greatest(seats, F.lit(0)) / F.col("total") + 0.5)

    bounds = (
        claims.filter("claim > 0")
        .withColumn("total", total)
        .withColumn("n", n)
        .withColumn("sure", F.greatest(rounded(F.col("seats") - F.col("n") / 2) - 1, F.lit(0)))
        .withColumn("most", rounded(F.col("seats") + F.col("n") / 2) + 1)
        .withColumn("open", F.col("seats") - F.sum("sure").over(group))
    )
    quotients = bounds.withColumn("k", F.explode(F.expr("sequence(sure, most)"))).withColumn(
        "quotient", F.col("claim") / (2 * F.col("k") + 1)
    )
    ranked = quotients.withColumn(
        "rank",
        F.row_number().over(group.orderBy(F.desc("quotient"), *(F.asc_nulls_last(k) for k in key))),
    )
    return ranked.groupBy(*within, *(k for k in key if k not in within)).agg(
        (F.max("sure") + F.sum(F.when(F.col("rank") <= F.col("open"), 1).otherwise(0)))
        .cast("long")
        .alias("quota")
    )


def _shards(spark: SparkSession, sized: DataFrame) -> DataFrame:
    """source, shard, target, source_size, and how a shard's line is cut and taken."""
    source = Window.partitionBy("source")
    parts = saved(
        spark,
        sized.groupBy("source", "h").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("docs")),
        "shard-sizes",
    )
    totals = parts.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = saved(spark, source_targets(totals), "targets")
    total, smallest = targets.agg(
        F.sum("source_size"), F.min(F.when(F.col("target") > 0, F.col("target")))
    ).first()
    largest_block = max(1, int(total or 0) // BLOCKS)
    unit = max(1, min(largest_block, int(smallest or 0) // FINEST))
    quotas = sainte_lague(
        targets.select(
            "source", F.col("target").alias("claim"), F.lit(round(int(total or 0) / unit)).alias("seats")
        ),
        [],
        ["source"],
    ).select("source", F.col("quota").alias("source_quota"))

    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    block = F.floor(F.col("b.target") / FINEST).cast("long")
    block = F.greatest(F.lit(1), F.least(F.lit(largest_block), block))
    wanted = F.ceil(F.sum("docs").over(source) / SHARD_DOCS).cast("long")
    pieces = F.greatest(F.lit(1), F.round(F.col("line") / F.col("block")).cast("long"))
    cut = (
        parts.withColumn("shards", F.least(F.lit(SHARDS).cast("long"), wanted))
        .groupBy("source", "shards", (F.col("h") % F.col("shards")).alias("shard"))
        .agg(F.sum("size").alias("line"))
        .alias("a")
        .join(targets.alias("b"), same)
        .select("a.*", "b.target", "b.source_size", block.alias("block"))
        .withColumn("block_words", F.greatest(F.lit(1), F.ceil(F.col("line") / pieces).cast("long")))
        .withColumn("blocks", F.ceil(F.col("line") / F.col("block_words")).cast("long"))
    )
    blocks_of_source = F.sum(F.col("line") / F.col("block_words")).over(source)
    cut = cut.withColumn("source_blocks", blocks_of_source)
    cut = cut.alias("a").join(quotas.alias("b"), same, "left").select("a.*", "b.source_quota")
    # the source's quota in blocks as long as its shards' blocks are on average
    seats = F.round(F.col("source_quota") * unit * F.col("source_blocks") / F.col("source_size"))
    claims = cut.withColumn("claim", F.col("line") / F.col("block_words")).withColumn(
        "seats", F.coalesce(seats, F.lit(0)).cast("long")
    )
    claims = saved(spark, claims, "claims")
    shard_quotas = sainte_lague(claims, ["source"], ["source", "shard"])
    joined = claims.alias("a").join(
        shard_quotas.alias("b"), same & (F.col("a.shard") == F.col("b.shard")), "left"
    )
    # passes are counted in words, as a line's last block may be short
    quota = F.coalesce("b.quota", F.lit(0))
    wanted = F.least(F.col("quota") * F.col("block_words"), MAX_REPEAT * F.col("line"))
    line = F.greatest(F.col("line"), F.lit(1))
    some = F.greatest(F.col("blocks"), F.lit(1))
    left = (F.col("wanted") - F.col("passes") * F.col("line")) / F.col("block_words")
    plan = (
        joined.select("a.*", quota.alias("quota"))
        .withColumn("wanted", wanted)
        .withColumn("passes", F.floor(F.col("wanted") / line).cast("long"))
        .withColumn("part", F.least(F.round(left).cast("long"), F.col("blocks")))
        .withColumn("offset", F.pmod(F.xxhash64(F.lit(SEED), "source", "shard"), some))
        .withColumn("shard_key", shard_key())
    )
    return saved(spark, plan, "mix-plan")


def shard_key() -> Column:
    """Source and shard as one number, so that a NULL source is a key like any other."""
    return F.xxhash64(F.col("source").isNull(), F.coalesce("source", F.lit("")), "shard")


def _chosen(blocks_before: Column) -> Column:
    """How many of the first so many blocks the last, partial pass takes."""
    blocks = F.greatest(F.col("blocks"), F.lit(1))
    return F.floor((blocks_before * F.col("part") + F.col("offset")) / blocks).cast("long")


def in_part(place: Column) -> Column:
    """Whether the partial pass takes the word at this place of the line."""
    block = F.floor(place / F.col("block_words")).cast("long")
    return _chosen(block + 1) > _chosen(block)


def _part_before(place: Column) -> Column:
    """Words of the partial pass before a place of the line."""
    block = F.floor(place / F.col("block_words")).cast("long")
    inside = place - block * F.col("block_words")
    return _chosen(block) * F.col("block_words") + F.when(in_part(place), inside).otherwise(0)


#: What a kept column's name begins with, so that it cannot clash with the plan's own.
_OWN = "_mix_"


def mixed(spark: SparkSession, docs: DataFrame, keep: list[str]) -> DataFrame:
    """doc_id, source, size and ``keep`` (their names prefixed) of every row, and what the mix takes.

    Adds source_size, target, taken, and for partly taken rows passes, place, block_words, blocks,
    part and offset. Sources are ordered by code point, NULL last, with weights 1, 2, 3, repeating.
    A NULL or empty text has size 0 and nothing is taken; repeated rows count each time; no rows
    give no rows. The seed and the ids alone decide, so reruns agree.
    """
    dealt = docs.select(
        F.col("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(SHARDS)).alias("h"),
        *(F.col(name).alias(_OWN + name) for name in keep),
    )
    if not keep:
        dealt = saved(spark, dealt, "sizes")
    plan = _shards(spark, dealt)
    counts = saved(spark, plan.groupBy("source").agg(F.first("shards").alias("shards")), "counts")
    placed = (
        dealt.alias("a")
        .join(counts.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")))
        .select("a.*", (F.col("h") % F.col("shards")).alias("shard"))
        .withColumn("shard_key", shard_key())
    )
    line = Window.partitionBy("shard_key").orderBy(
        F.xxhash64(F.lit(SEED + 1), "doc_id"), "doc_id", "size"
    )
    start = F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    lined = placed.withColumn("place", start - F.col("size"))
    cut = plan.select(
        "shard_key", "source_size", "target", "passes", "part", "offset", "block_words", "blocks"
    )
    end = F.col("place") + F.col("size")
    taken = F.col("passes") * F.col("size") + _part_before(end) - _part_before(F.col("place"))
    return lined.join(cut, "shard_key").withColumn("taken", taken.cast("long"))


def mix(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row; see ``mixed``."""
    return mixed(spark, docs, []).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The mix as documents: a row for each whole pass over a document's words, unchanged, and one
    with just the words the partial pass takes of it, joined by spaces. Documents of which nothing
    is taken go. The columns are those of ``docs``."""
    names = docs.columns
    rows = mixed(spark, docs, names)
    text = F.col(_OWN + "text")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    part = F.filter(words, lambda word, i: in_part(F.col("place") + i))
    rest = F.col("taken") - F.col("passes") * F.col("size")
    whole = F.col("passes") + F.when(rest == F.col("size"), 1).otherwise(0)
    copies = F.array_repeat(text, F.when(F.col("size") > 0, whole).otherwise(0).cast("int"))
    cut = F.when(
        (rest > 0) & (rest < F.col("size")), F.array(F.concat_ws(" ", part))
    ).otherwise(F.array().cast("array<string>"))
    made = "_mix made"
    columns = {name: F.col(f"`{_OWN}{name}`") for name in names}
    out = rows.withColumn(made, F.explode(F.concat(copies, cut)))
    columns["text"] = F.col(f"`{made}`")
    if "n_chars" in names:
        columns["n_chars"] = F.char_length(f"`{made}`").cast(docs.schema["n_chars"].dataType)
    return out.select(*(column.alias(name) for name, column in columns.items()))
