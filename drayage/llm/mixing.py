"""Mixing sources to target weights, in blocks of words.

The words of a source, document after document in a fixed pseudorandom order, are packed
into blocks of ``BLOCK_WORDS``. The output is made of shards of ``SHARD_BLOCKS`` slots.
Each shard draws how many of its slots each source gets: the whole part of the source's
expected number is certain, and the slots that remain are drawn multinomially by the
fractions, which keeps the means and lessens the noise. The slots of a source are numbered
on through the shards, and slot k of a source of n blocks takes block p(k mod n), where p
is a pseudorandom permutation of its own for every pass k div n. Blocks and slots meet in a
join by source and index. At most ``MOST_PASSES`` passes are taken.

Everything is an expression of the ids, sizes and sources, so reruns agree. Where a table
holds rows with the same id, their order is that of their sizes and a hash of the text.

Sources in the order of their code points, null last, weigh 5, 2, 1, and so on again, and
share all sizes by weight; a target stops at ``MOST_PASSES`` times its source's size, and
what is over is shared again among the others. A null text has no words; a document without
words takes part with nothing. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drayage.functions.binding import let
from drayage.llm.frames import WORD, numbered, stored

WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
BLOCK_WORDS = 64
SHARD_BLOCKS = 65_536
SEED = 20_240
#: Rounds of the permutation, and the modulus of its arithmetic.
ROUNDS = 12
PRIME = 2_147_483_647


def with_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sizes(key, source_size)``, one row per source, with the ``target`` of each and its place ``n``.

    Sources are filled up in the order in which they reach their limits: those before the first
    that keeps below its limit stop there, all others share the rest by weight. The windows run
    over one row for each source.
    """
    n = F.row_number().over(Window.orderBy("key")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("n", F.lit(len(weights))).cast("int") + 1)
    limit = (F.lit(MOST_PASSES) * F.col("source_size")).cast("double")
    filled = Window.orderBy("ratio", "n")
    everything = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn("n", n.cast("long")).withColumn("weight", weight).withColumn("limit", limit)
    shared = ranked.withColumn("ratio", F.col("limit") / F.col("weight")).withColumns({
        "before": F.coalesce(F.sum("limit").over(filled.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "left": F.sum("weight").over(filled.rowsBetween(0, Window.unboundedFollowing)),
        "total": F.sum("source_size").over(everything).cast("double"),
    }).withColumn("level", (F.col("total") - F.col("before")) / F.col("left"))
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "n", "level"))).over(everything)
    return shared.withColumn("target", F.least("limit", F.col("weight") * level["level"])).select(
        "key", "n", "source_size", "target"
    )


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, carry: bool = False) -> tuple[DataFrame, DataFrame]:
    """Where each document's words lie, and which of them the mix takes.

    The first table has one row for each row of ``docs``: ``doc_id``, ``size``, ``source_size``,
    ``target``, ``n`` (the source's place) and ``start`` (its first word in the source's words); with
    ``carry`` also the columns of ``docs``, as ``c0``, ``c1`` and so on.
    The second one has a row for each part of a document in each slot: ``shard``, ``n``, ``slot``,
    ``pass``, ``block``, ``start`` and the words from ``from_word`` on, ``n_words`` of them.
    """
    docs, names = numbered(docs)
    text, source = F.col(names[text_col]).cast("string"), F.col(names[source_col]).cast("string")
    sized = stored(
        docs.select(
            *(docs.columns if carry else []),
            F.col(names[id_col]).alias("doc_id"),
            F.coalesce(F.concat(F.lit("0"), source), F.lit("1")).alias("key"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(text).alias("tie"),
        ).withColumn("chunk", F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 3)),
        "sizes",
    )
    sources = stored(
        with_targets(sized.groupBy("key").agg(F.sum("size").alias("source_size")))
        .withColumn("blocks", F.ceil(F.col("source_size") / block_words)),
        "sources",
    )
    placed = _placed(sized, sources)
    parts = placed.filter("size > 0").select(
        "n", "start", "size",
        F.explode(F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))).alias("block"),
    ).select(
        "n", "start", "block",
        F.greatest(F.col("block") * block_words - F.col("start"), F.lit(0)).alias("from_word"),
        F.least((F.col("block") + 1) * block_words - F.col("start"), "size").alias("to_word"),
    )
    # Never a broadcast, however small the table is from which the slots are made.
    taken = parts.join(_slots(sources, shard_blocks).hint("merge"), ["n", "block"]).select(
        "shard", "n", "slot", "pass", "block", "start", "from_word",
        (F.col("to_word") - F.col("from_word")).alias("n_words"),
    )
    return placed, taken


def _placed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds where each document starts: sums within 4,096 chunks of a source, and before them."""
    along = Window.partitionBy("key").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = sized.groupBy("key", "chunk").agg(F.sum("size").alias("words")).select(
        "key", "chunk", F.coalesce(F.sum("words").over(along), F.lit(0)).alias("before")
    ).join(sources, "key")
    inside = Window.partitionBy("key", "chunk").orderBy(
        F.col("doc_id").asc_nulls_last(), "size", "tie"
    ).rowsBetween(Window.unboundedPreceding, -1)
    return sized.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        chunks, ["key", "chunk"]
    ).select(
        *[c for c in sized.columns if c.startswith("c") and c[1:].isdigit()],
        "doc_id", "size", "source_size", "target", "n", (F.col("before") + F.col("inside")).alias("start")
    )


def _slots(sources: DataFrame, shard_blocks: int) -> DataFrame:
    """Each slot of the mix with the source and the block it takes."""
    everything = Window.partitionBy(F.lit(0))
    share = F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(0.0)
    shares = sources.select("n", "blocks", share.alias("share")).withColumn("all", F.sum("share").over(everything))
    total = F.round("all").cast("long")
    shards = F.ceil(total / shard_blocks)
    # One row for each shard and source.
    expected = shares.filter(total > 0).select(
        "n", "blocks", "share", "all", total.alias("total"),
        F.explode(F.sequence(F.lit(0).cast("long"), shards - 1)).alias("shard"),
    ).repartition("shard").withColumn("slots", F.least(F.lit(shard_blocks).cast("long"), F.col("total") - F.col("shard") * shard_blocks)
    ).withColumn("mean", F.col("slots") * F.col("share") / F.col("all")).withColumn("sure", F.floor(F.col("mean") + 1e-9)
    ).withColumn("part", F.greatest(F.col("mean") - F.col("sure"), F.lit(0.0)))
    shard = Window.partitionBy("shard")
    drawn = _drawn(expected.withColumns({
        "rest": F.col("slots") - F.sum("sure").over(shard),
        "parts": F.sum("part").over(shard),
        "at": F.sum("part").over(shard.orderBy("n").rowsBetween(Window.unboundedPreceding, 0)) - F.col("part"),
    }))
    earlier = Window.partitionBy("n").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = drawn.withColumn("first", F.coalesce(F.sum("count").over(earlier), F.lit(0))).withColumn(
        "end", F.least(F.col("first") + F.col("count"), F.col("blocks") * MOST_PASSES)
    ).filter("end > first")
    # Few rows that make many: dealt out before they do, to as many tasks as it says here.
    partitions = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = counts.select("shard", "n", "blocks", "first", "end").repartition(partitions, "shard", "n").select(
        "shard", "n", "blocks", F.explode(F.sequence("first", F.col("end") - 1)).alias("slot")
    )
    passes = slots.withColumn("pass", F.expr("slot div blocks"))
    return _permuted(passes.withColumn("x", F.col("slot") % F.col("blocks"))).select(
        "shard", "n", "slot", "pass", F.col("x").alias("block")
    )


def _drawn(expected: DataFrame) -> DataFrame:
    """Adds ``count``: the slots that are sure and those drawn. A draw is a point among the
    fractions laid end to end; it goes to the source whose start is the last before it."""
    starts = expected.select("shard", F.col("at").alias("place"), F.lit(0).alias("draw"), "n")
    draws = expected.filter("n = 0 AND rest > 0").select(
        "shard", "parts", F.explode(F.sequence(F.lit(1).cast("long"), "rest")).alias("j")
    ).select(
        "shard", (_uniform("shard", "j") * F.col("parts")).alias("place"), F.lit(1).alias("draw"),
        F.lit(None).cast("long").alias("n"),
    )
    upto = Window.partitionBy("shard").orderBy("place", "draw", "n").rowsBetween(Window.unboundedPreceding, 0)
    found = starts.union(draws).withColumn("n", F.last("n", ignorenulls=True).over(upto)).filter("draw = 1")
    counts = found.groupBy("shard", "n").agg(F.count(F.lit(1)).alias("more"))
    return expected.join(counts, ["shard", "n"], "left").withColumn(
        "count", F.col("sure") + F.coalesce("more", F.lit(0))
    )


def _uniform(*columns: str) -> Column:
    """A number in [0, 1) from the first 32 bits of a digest."""
    digest = F.md5(F.concat_ws(":", F.lit(str(SEED)), *[F.col(c).cast("string") for c in columns]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def _permuted(slots: DataFrame) -> DataFrame:
    """``x`` < ``blocks`` under the permutation of its source and pass. In each round a key pairs the
    numbers up, and a bit of the pair's larger number tells whether the two change places."""
    blocks = F.col("blocks")
    begin = (F.lit(SEED) + (F.col("n") + 1) * 7919 + (F.col("pass") + 1) * 104729) % PRIME * 48271 % PRIME

    def round_(x: Column, i: Column) -> Column:
        key = (F.col("begin") + (i + 1) * 69621) % PRIME * 16807 % PRIME % blocks
        other = (key - x + blocks) % blocks
        mixed = (F.greatest(x, other) % PRIME * 1103515245 + key * 12345 + i * 777) % PRIME
        return F.when(F.shiftright(mixed, 16) % 2 == 1, other).otherwise(x)

    rounds = F.sequence(F.lit(0).cast("long"), F.lit(ROUNDS - 1).cast("long"))
    moved = F.aggregate(rounds, F.col("x"), round_)
    # Never null; saying so spares the join a filter that computes it twice.
    return slots.withColumn("begin", begin).withColumn("x", F.coalesce(moved, F.lit(0).cast("long")))


def taken_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``size``, ``source_size``, ``target`` and ``taken``."""
    placed, taken = plan(docs, id_col, text_col, source_col)
    sums = taken.groupBy("n", "start").agg(F.sum("n_words").alias("words"))
    # Documents without words start where the next one does and take nothing.
    return placed.join(sums, ["n", "start"], "left").select(
        "doc_id", "size", "source_size", "target",
        F.when(F.col("size") > 0, F.coalesce("words", F.lit(0))).otherwise(0).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    chars_col: str | None = "n_chars") -> DataFrame:
    """The mix as documents: for each pass over a document that takes any of its words a row with
    all columns of ``docs``, whose text is what was taken, in the order of the text, and whose
    ``chars_col``, if there is one, is the length of that. A document taken whole keeps its text."""
    placed, taken = plan(docs, id_col, text_col, source_col, carry=True)
    ranges = taken.groupBy("n", "start", "pass").agg(
        F.sort_array(F.collect_list(F.struct("from_word", "n_words"))).alias("ranges"), F.sum("n_words").alias("words")
    )
    columns = [f"c{i}" for i in range(len(docs.columns))]
    chosen = placed.filter("size > 0").join(ranges, ["n", "start"])
    at = docs.columns.index(text_col)
    words = F.regexp_extract_all(F.col(f"c{at}"), F.lit(f"{WORD}[\\x20\\x09-\\x0D]*"), F.lit(0))
    # The words are found once for all ranges.
    picked = let(words, lambda all_: F.array_join(F.transform("ranges", lambda r: F.array_join(
        F.slice(all_, (r["from_word"] + 1).cast("int"), r["n_words"].cast("int")), ""
    )), ""))
    chosen = chosen.withColumn(f"c{at}", F.when(F.col("words") == F.col("size"), F.col(f"c{at}")).otherwise(picked))
    if chars_col in docs.columns:
        chars = docs.columns.index(chars_col)
        chosen = chosen.withColumn(f"c{chars}", F.length(f"c{at}").cast(docs.schema[chars_col].dataType))
    return chosen.select(*columns).toDF(*docs.columns)
