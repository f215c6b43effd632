"""Mixing sources to target weights.

The words of a source form one stream, document after document in the order of
a hash of their keys, cut into blocks of fixed length. Output shards have a fixed
number of slots. Every slot draws a source with the sources' shares as chances,
so the counts of a shard are a multinomial draw. Draws beyond what a source is
to give are taken back, evenly spread over the shards, and given to the sources
that were drawn too rarely, so totals are exact while shards vary.

The j-th slot of a source takes the block that a pseudorandom permutation of the
block numbers puts there; when all blocks are used up, a second permutation
begins. Slots and blocks are then joined by (source, block). A source's last,
shorter block comes last in each round, and its very last slot is cut to what
is left of the target, so a source gives its target to the word.

Only DataFrame functions are used. No step holds a source together: streams are
laid out per (source, bucket of keys), equal keys are counted per input task
first, and all other rows are one per slot, block or (shard, source).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from weirflow.llm.common import query
from weirflow.plans.registry import table
from weirflow.workspace import materialize

# Fixed values of the contract.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2

BLOCK_WORDS = 1024
SHARD_SLOTS = 1024
KEYS_PER_BUCKET = 1024
SLOTS_PER_TASK = 32_768
CELLS = 1024
ROUNDS = 32


@dataclass(frozen=True)
class Mix:
    """`rows` (uid, row, size, part), `sources` (part, source_size, target, …),
    `pieces` (uid, shard, place, offset, first, words): `words` words of a
    document from its word `first` (from 0) stand at word `offset` of the block in
    slot `place` of an output shard."""

    rows: DataFrame
    sources: DataFrame
    pieces: DataFrame


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, *, weights: Sequence[float], share: float, most: int) -> DataFrame:
    """Add `number`, `weight` and `target` to (part, source_size).

    Weights repeat over the sources in the order of their names, null last. The
    shares of `share` times all words stop at `most` times a source, and what is
    over goes to the others by weight: target = least(most * size, level * weight).
    With the sources by size per weight, the level that shares all is the highest
    of those reached by giving the first k sources their most. One row per source
    passes through one task.
    """
    if share > most:
        raise ValueError("the sources can't give that much")
    by_name = Window.orderBy(F.col("part") == "", "part")
    number = F.row_number().over(by_name) - 1
    values = F.array(*[F.lit(float(w)) for w in weights])
    named = sizes.withColumn("number", number).withColumn(
        "weight", F.get(values, F.col("number") % len(weights))
    ).withColumn("most", F.col("source_size") * F.lit(float(most)))
    everything = Window.partitionBy()
    earlier = Window.orderBy(F.col("most") / F.col("weight"), "number").rowsBetween(
        Window.unboundedPreceding, -1
    )
    given = F.coalesce(F.sum("most").over(earlier), F.lit(0.0))
    weighed = F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    left = F.sum("source_size").over(everything) * F.lit(share) - given
    levels = named.withColumn("level", left / (F.sum("weight").over(everything) - weighed))
    target = F.least("most", F.max("level").over(everything) * F.col("weight"))
    return levels.select("part", "source_size", "number", "weight", target.alias("target"))


def with_slots(targets: DataFrame, block_words: int) -> DataFrame:
    """Add the words a source gives (`quota`), its full blocks and blocks, its
    slots and the first of them among the slots of all sources."""
    size, length = F.col("source_size"), F.lit(block_words)
    whole = F.expr(f"source_size div {block_words}")
    counted = targets.withColumns({
        "quota": F.round("target").cast("long"),
        "full": whole,
        "blocks": whole + F.when(size % length > 0, 1).otherwise(0),
    })
    rest = F.col("quota") % size
    slots = F.expr("quota div source_size") * F.col("blocks") + F.ceil(rest / length)
    counted = counted.withColumn("slots", F.when(size > 0, slots).otherwise(0).cast("long"))
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("first_slot", F.coalesce(F.sum("slots").over(before), F.lit(0)))


def permuted(i: Column, size: Column, *seed: Column) -> Column:
    """Place of `i` in a pseudorandom permutation of 0 .. size - 1.

    In every round the numbers are paired by x + y = k (mod size), k from a hash,
    and a hash of the pair's larger number decides whether the two change places.
    Each round is a permutation, so the whole is one, for any size.
    """
    size = F.greatest(size, F.lit(1)).cast("long")

    def swap(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(F.lit("pair"), *seed, r), size) - x, size)
        coin = F.xxhash64(F.lit("swap"), *seed, r, F.greatest(x, other))
        return F.when(F.pmod(coin, F.lit(2)) == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), i.cast("long"), swap)


def lay_out(placed: DataFrame, rows: int) -> DataFrame:
    """(uid, part, size, start): the documents' places in their sources' streams.

    The order is that of (bucket, hash, key, size) and so doesn't hang on how the
    input is split; rows alike in all of these can't be told apart in the result.
    They are counted per input task first, so a key with most of the rows is one
    row per task here.
    """
    alike = ["part", "key", "size", "task"]
    mark = F.xxhash64("key", "size")
    buckets = F.lit(max(1, -(-rows // KEYS_PER_BUCKET)))
    units = placed.groupBy(*alike).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "bucket", F.pmod(mark, buckets)
    )
    words = F.col("n") * F.col("size")
    in_bucket = Window.partitionBy("part", "bucket").orderBy(mark, "key", "size", "task")
    in_part = Window.partitionBy("part").orderBy("bucket")
    earlier = (Window.unboundedPreceding, -1)
    units = units.withColumn(
        "within", F.coalesce(F.sum(words).over(in_bucket.rowsBetween(*earlier)), F.lit(0))
    )
    sums = units.groupBy("part", "bucket").agg(F.sum(words).alias("words")).select(
        "part", "bucket",
        F.coalesce(F.sum("words").over(in_part.rowsBetween(*earlier)), F.lit(0)).alias("before"),
    )
    starts = units.join(sums, ["part", "bucket"]).select(
        *alike, (F.col("before") + F.col("within")).alias("start")
    )
    copy = F.row_number().over(Window.partitionBy(*alike).orderBy("uid")) - 1
    return placed.select("uid", *alike, copy.alias("copy")).join(starts, alike).select(
        "uid", "part", "size", (F.col("start") + F.col("copy") * F.col("size")).alias("start")
    )


def draw_counts(spark: SparkSession, sources: DataFrame, slots: int, shard_slots: int) -> DataFrame:
    """(shard, number, drawn): how many slots of every shard drew a source."""
    count = sources.count()
    width = max(1, -(-slots // max(CELLS, count)))
    cell = F.explode(F.sequence(
        F.expr(f"first_slot div {width}"), F.expr(f"(first_slot + slots - 1) div {width}")
    ))
    owners = sources.filter("slots > 0").select("number", "first_slot", "slots", cell.alias("cell"))
    draw = F.pmod(F.xxhash64(F.lit("draw"), "id"), F.lit(slots))
    draws = spark.range(slots).select(
        F.expr(f"id div {shard_slots}").alias("shard"), draw.alias("draw")
    ).withColumn("cell", F.expr(f"draw div {width}"))
    inside = (F.col("draw") >= F.col("first_slot")) & (
        F.col("draw") < F.col("first_slot") + F.col("slots")
    )
    return draws.join(owners, "cell").filter(inside).groupBy("shard", "number").agg(
        F.count(F.lit(1)).alias("drawn")
    )


def fill_slots(sources: DataFrame, counts: DataFrame, slots: int) -> DataFrame:
    """(shard, number, turn): every slot with the source that fills it and the
    slot's turn among those of the source, from 0 to its slots less one.

    Of the d draws of a source with x too many, draw j goes when j * x / d passes
    a whole number at j + 1: x of them, evenly spaced. They pass in a pseudorandom
    order to the sources with too few.
    """
    per_source = Window.partitionBy("number")
    earlier = per_source.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("drawn").over(earlier), F.lit(0))
    totals = counts.groupBy("number").agg(F.sum("drawn").alias("total"))
    in_order = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    quotas = sources.select("number", "slots").join(totals, "number", "left").select(
        "number", "slots", F.coalesce("total", F.lit(0)).alias("total")
    ).withColumns({
        "over": F.greatest(F.col("total") - F.col("slots"), F.lit(0)),
        "under": F.greatest(F.col("slots") - F.col("total"), F.lit(0)),
    }).withColumns({
        "over_before": F.coalesce(F.sum("over").over(in_order), F.lit(0)),
        "under_before": F.coalesce(F.sum("under").over(in_order), F.lit(0)),
        "moved": F.sum("over").over(Window.partitionBy()),
    })
    turn = F.explode(F.sequence("before", F.col("before") + F.col("drawn") - 1))
    # A source's counts come out of one task; its slots are spread again.
    tasks = max(1, -(-slots // SLOTS_PER_TASK))
    ordered = counts.withColumn("before", before).repartition(tasks, "shard", "number")
    draws = ordered.join(quotas, "number").select(
        "shard", "number", "total", "over", "over_before", "moved", turn.alias("draw")
    ).withColumns({
        "gone": F.expr("draw * over div total"),
        "gone_next": F.expr("(draw + 1) * over div total"),
    })
    kept = draws.filter("gone = gone_next").select(
        "shard", "number", (F.col("draw") - F.col("gone")).alias("turn")
    )
    again = draws.filter("gone < gone_next").select("shard", permuted(
        F.col("over_before") + F.col("gone"), F.col("moved"), F.lit("again")
    ).alias("want"))
    extra = F.explode(F.sequence(F.lit(0).cast("long"), F.col("under") - 1))
    wants = quotas.filter("under > 0").select(
        "number", "total", "under_before", extra.alias("extra")
    ).select(
        (F.col("under_before") + F.col("extra")).alias("want"), "number",
        (F.col("total") + F.col("extra")).alias("turn"),
    )
    return kept.unionByName(again.join(wants, "want").select("shard", "number", "turn"))


def take_blocks(slots: DataFrame, sources: DataFrame, block_words: int) -> DataFrame:
    """(shard, place, part, block, cut): the block of every slot and how many of
    its words count."""
    known = slots.join(sources, "number").withColumns({
        "round": F.expr("turn div blocks"), "at": F.expr("turn % blocks"),
    })
    mixed = permuted(F.col("at"), F.col("full"), F.col("number"), F.col("round"))
    block = F.when(F.col("at") < F.col("full"), mixed).otherwise(F.col("full"))
    left = F.col("quota") - F.col("round") * F.col("source_size") - F.col("at") * block_words
    in_shard = Window.partitionBy("shard").orderBy(F.xxhash64("number", "turn"), "number", "turn")
    return known.select(
        "shard", (F.row_number().over(in_shard) - 1).alias("place"), "part",
        block.alias("block"), F.least(left, F.lit(block_words)).alias("cut"),
    )


def join_blocks(documents: DataFrame, taken: DataFrame, block_words: int) -> DataFrame:
    """The pieces of documents in the blocks that slots take; see `Mix`."""
    end = F.col("start") + F.col("size")
    block = F.explode(F.sequence(
        F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}")
    ))
    parts = documents.filter("size > 0").select(
        "uid", "part", "start", end.alias("end"), block.alias("block")
    ).withColumn("head", F.col("block") * block_words).withColumn(
        "from", F.greatest("start", "head")
    ).select(
        "uid", "part", "block", (F.col("from") - F.col("head")).alias("offset"),
        (F.col("from") - F.col("start")).alias("first"),
        (F.least("end", F.col("head") + block_words) - F.col("from")).alias("held"),
    )
    words = F.least(F.col("held"), F.col("cut") - F.col("offset"))
    return parts.join(taken, ["part", "block"]).select(
        "uid", "shard", "place", "offset", "first", words.alias("words")
    ).filter("words > 0")


def mix_sources(
    rows: DataFrame, *, source: str, key: str, size: str,
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST,
    block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS,
) -> Mix:
    """Mix a table of `row` structs by the words counted in `row.size`.

    Rows without a source are one source, the last. A null or zero size gives
    nothing and takes no part. Null and repeated keys are allowed; every row is
    one document. No word is taken more than `most` times. An empty table, or one
    without a word, gives no pieces. The result hangs on keys, sizes and sources
    only, not on how the table is split.
    """
    spark = rows.sparkSession
    if not weights or min(weights) <= 0:
        raise ValueError("every weight must be above zero")
    mark = F.monotonically_increasing_id()
    own = F.col("row")[source].cast("string")
    placed = materialize(
        rows.select(
            "row", mark.alias("uid"), F.shiftrightunsigned(mark, 33).alias("task"),
            F.when(own.isNull(), "").otherwise(F.concat(F.lit("="), own)).alias("part"),
            F.coalesce(F.col("row")[key].cast("string"), F.lit("\0null")).alias("key"),
            F.coalesce(F.col("row")[size], F.lit(0)).cast("long").alias("size"),
        ),
        "mix-rows",
    )
    sizes = placed.groupBy("part").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents")
    )
    targets = source_targets(sizes.drop("documents"), weights=weights, share=share, most=most)
    sources = materialize(
        with_slots(targets, block_words).join(sizes.select("part", "documents"), "part"), "mix-sources"
    )
    slots, documents = sources.agg(
        F.coalesce(F.sum("slots"), F.lit(0)), F.coalesce(F.sum("documents"), F.lit(0))
    ).first()
    counts = materialize(draw_counts(spark, sources, slots, shard_slots), "mix-draws") if slots else (
        spark.createDataFrame([], "shard long, number int, drawn long")
    )
    taken = take_blocks(fill_slots(sources, counts, slots), sources, block_words)
    pieces = join_blocks(lay_out(placed, documents), taken, block_words)
    return Mix(placed.select("uid", "row", "size", "part"), sources, pieces)


def words_taken(mix: Mix) -> DataFrame:
    """All rows with their source's size and target and the words the mix takes
    of them."""
    taken = mix.pieces.groupBy("uid").agg(F.sum("words").alias("taken"))
    return mix.rows.join(taken, "uid", "left").join(mix.sources, "part").select(
        "row", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def block_texts(mix: Mix, text: str) -> DataFrame:
    """(shard, place, text): the mixture itself, one row per slot, its words
    joined by single spaces. A slot gathers at most its block's words."""
    words = F.filter(F.split(F.col("row")[text], GAP), lambda w: w != "")
    piece = F.array_join(F.slice(words, (F.col("first") + 1).cast("int"), F.col("words").cast("int")), " ")
    cut = mix.pieces.join(mix.rows, "uid").select("shard", "place", "offset", piece.alias("piece"))
    ordered = F.array_sort(F.collect_list(F.struct("offset", "piece")))
    return cut.groupBy("shard", "place").agg(
        F.array_join(F.transform(ordered, lambda p: p["piece"]), " ").alias("text")
    )


@query("op11_mixing")
def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(F.struct("doc_id", "source", count_words(F.col("text")).alias("size")).alias("row"))
    mix = mix_sources(rows, source="source", key="doc_id", size="size")
    return words_taken(mix).select(
        "row.doc_id", "row.size", "source_size", "target", "taken"
    )
