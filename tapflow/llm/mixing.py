"""Mixing sources to target weights in fixed-length blocks of words; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapflow.llm.order import in_global_order
from tapflow.llm.store import parts_for, written

BLOCK = 128
SHARDS = 40
ROUNDS = 10
# Tickets unrolled from one row, and those that a task makes.
STRIDE = 4096
TICKETS = 1 << 18
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def permuted(at: Column, n: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """A pseudorandom permutation of 0 to n - 1 for any n, by swap-or-not rounds.

    Each round pairs x with (k - x) mod n and swaps the pair or not by a hash of its larger
    member, so every round is a permutation and no value is walked or rejected.
    """

    def swapped(x: Column, turn: Column) -> Column:
        partner = F.pmod(F.xxhash64(key, turn) - x, n)
        swap = F.xxhash64(key, turn, F.greatest(x, partner)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, partner).otherwise(x)

    return F.aggregate(F.lit(list(range(rounds))), at, swapped)


def source_targets(sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """Words wanted of each source: ``share`` of all words by weight, at most ``most`` times a source's size.

    ``sizes`` has one row per source: none (true for the null source), name, source_size.
    Sources are numbered by code point, null last, and weigh ``weights`` in turn. What a
    source can't give is reshared by weight until none is above its limit: with sources in
    order of limit / weight, those that fill up are a prefix, and the rest share evenly.
    Adds number, target, base (words of the sources before it).
    """
    by_name = Window.orderBy("none", "name")
    ahead = by_name.rowsBetween(Window.unboundedPreceding, -1)
    numbered = sizes.withColumn("number", F.row_number().over(by_name) - 1).withColumn(
        "base", F.coalesce(F.sum("source_size").over(ahead), F.lit(0)).cast("long")
    ).withColumn("weight", F.lit([float(w) for w in weights])[F.pmod("number", F.lit(len(weights)))])
    limit = F.col("source_size") * float(most)
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), "number")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    share_of = F.col("limit") / F.col("weight")
    filled = (
        numbered.withColumn("limit", limit)
        .withColumn("total", F.sum("source_size").over(whole) * float(share))
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after))
        # the level of the first source that it doesn't fill holds for all after it
        .withColumn("first", F.min(F.when(F.col("level") <= share_of, F.struct(share_of.alias("at"), "number", "level"))).over(whole))
    )
    target = F.least("limit", F.coalesce(F.col("first.level"), F.lit(float("inf"))) * F.col("weight"))
    return filled.withColumn("target", target).select("none", "name", "number", "source_size", "base", "target")


def tickets(targets: DataFrame, block: int, shards: int, seed: int, parts: int) -> DataFrame:
    """One row per drawn block: number, pass, block, words, shard, slot.

    A source gives one ticket per block and pass; a pass goes through all its blocks in a
    pseudorandom order (its short last block at the end) before the next begins, and the
    last ticket is cut so that the words come to the target exactly. Shards draw their
    slots from all tickets without replacement, which makes the counts of sources in a
    shard multinomial given the totals. Source rows are unrolled in strides over ``parts``
    tasks (a stated number, as small rows would be put together again), so no task makes
    all tickets of a hot source.
    """
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    planned = (
        targets.where("source_size > 0").withColumn("blocks", blocks)
        .withColumn("words_wanted", F.floor("target").cast("long"))
        .withColumn("passes", F.expr("words_wanted div source_size"))
        .withColumn("rest", F.expr("words_wanted % source_size"))
        .withColumn("drawn", F.expr(f"passes * blocks + (rest + {block - 1}) div {block}"))
    )
    ahead = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    planned = planned.withColumn("offset", F.coalesce(F.sum("drawn").over(ahead), F.lit(0))).withColumn(
        "all_drawn", F.sum("drawn").over(Window.partitionBy())
    ).where("drawn > 0")
    strides = planned.withColumn("stride", F.explode(F.expr(f"sequence(0L, (drawn - 1) div {STRIDE})")))
    spread = strides.repartition(parts, "number", "stride")
    unrolled = spread.withColumn(
        "i", F.explode(F.expr(f"sequence(stride * {STRIDE}, least((stride + 1) * {STRIDE}, drawn) - 1)"))
    )
    place = F.expr("i % blocks")
    full = F.col("blocks") - 1
    shuffled = F.when(place == full, place).otherwise(permuted(place, F.greatest(full, F.lit(1)), F.xxhash64("number", F.lit(seed))))
    length = F.when(F.col("block") == full, F.col("source_size") - full * block).otherwise(F.lit(block)).cast("long")
    last = (F.col("i") == F.col("drawn") - 1) & (F.col("rest") > 0)
    cut = F.col("rest") - F.expr(f"((rest + {block - 1}) div {block} - 1) * {block}")
    position = permuted(F.col("offset") + F.col("i"), F.col("all_drawn"), F.lit(seed + 1).cast("long"))
    return (
        unrolled.withColumn("block", shuffled).withColumn("pass", F.expr("i div blocks"))
        .withColumn("words", F.when(last, F.least(cut, length)).otherwise(length))
        .withColumn("position", position)
        .withColumn("shard", F.expr(f"position * {shards} div all_drawn").cast("int"))
        .withColumn("slot", F.col("position") - F.expr(f"(shard * all_drawn + {shards - 1}) div {shards}"))
        .select("number", "pass", "block", "words", "shard", "slot")
    )


def placed_documents(docs: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """Documents in a fixed pseudorandom order inside their source, with the word each starts at."""
    order = ["none", "name", F.xxhash64("doc_id", F.lit(seed)), "doc_id", "text_hash"]
    running = in_global_order(docs, order, "ahead", "size")
    about = targets.select("none", "name", "number", "source_size", "target", "base")
    return running.join(about, ["none", "name"]).withColumn("start", F.col("ahead") - F.col("base")).drop("ahead", "base", "none", "name", "text_hash")


def pieces(placed: DataFrame, block: int) -> DataFrame:
    """The part of each block that a document fills: number, block, start (of the document), low, high."""
    spread = placed.where("size > 0").select(
        "number", "start", "size", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")).alias("block")
    )
    edge = F.col("block") * block
    return spread.select(
        "number", "block", "start", F.greatest(edge, F.col("start")).alias("low"),
        F.least(edge + block, F.col("start") + F.col("size")).alias("high"),
    )


def mixed(
    docs: DataFrame, weights: list[float], share: float, most: float = 2.0, block: int = BLOCK,
    shards: int = SHARDS, seed: int = 7, text: str = "text", carry: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Mix sources to target weights. Returns (documents, draws).

    documents: one row per row of ``docs`` with doc_id, size (words), number (of its source),
    start (its place in the source's stream), source_size, target; with ``carry`` also two
    hashes of the whole row, key_a and key_b.
    draws: one row per piece of a document in a drawn block: shard, slot, number, start,
    pass, first and last word (half-open, counted in the document).

    Words are laid end to end by source in a fixed order and packed into blocks of ``block``
    words; see ``tickets`` for the draw. All randomness is hashing, so reruns agree. Null
    texts have no words; a null source is a source of its own, sorted last; null and
    repeated doc_ids are rows of their own. Empty tables give empty results.
    """
    columns = ["doc_id", word_count(text).alias("size"), F.col("source").isNull().alias("none"),
               F.coalesce("source", F.lit("")).alias("name")]
    rows = docs.select(*columns, F.xxhash64(text).alias("text_hash"), *(_row_keys(docs) if carry else []))
    rows = written(rows, "sizes")  # a narrow table: the texts are counted once
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    parts = parts_for(docs.sparkSession, int(total * share) // block, TICKETS)
    sizes = rows.groupBy("none", "name").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    placed = placed_documents(rows, targets, seed)
    # Both sides unroll sequences, which Spark's size estimates don't see: never broadcast one.
    drawn = tickets(targets, block, shards, seed, parts).hint("merge").join(pieces(placed, block), ["number", "block"])
    end = F.least("high", F.col("block") * block + F.col("words"))
    draws = drawn.where(F.col("low") < end).select(
        "shard", "slot", "number", "start", "pass",
        (F.col("low") - F.col("start")).alias("first"), (end - F.col("start")).alias("last"),
    )
    return placed, draws


def mixture_report(docs: DataFrame, weights: list[float], share: float, most: float = 2.0, block: int = BLOCK, **more) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes, repeats counted)."""
    placed, draws = mixed(docs, weights, share, most, block, **more)
    taken = draws.groupBy("number", "start").agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
    full = placed.where("size > 0").join(taken, ["number", "start"], "left")
    out = ["doc_id", "size", "source_size", "target"]
    return full.select(*out, F.coalesce("taken", F.lit(0)).cast("long").alias("taken")).unionByName(
        placed.where("size = 0").select(*out, F.lit(0).cast("long").alias("taken"))
    )


def _row_keys(docs: DataFrame) -> list[Column]:
    """Two hashes of all columns of a row."""
    return [F.xxhash64(*docs.columns).alias("key_a"), F.xxhash64(F.lit(1), *docs.columns).alias("key_b")]


def mixed_documents(docs: DataFrame, weights: list[float], share: float, most: float = 2.0, block: int = BLOCK, **more) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: one row per document and pass.

    A document that a pass takes whole keeps its text; of others the row holds the words of
    the drawn blocks, in order, joined by spaces. n_chars, where there is one, is counted anew.
    """
    placed, draws = mixed(docs, weights, share, most, block, carry=True, **more)
    packed = "row"
    while packed in docs.columns:
        packed = f"_{packed}"
    # rows that agree in every column are interchangeable; the text is shuffled here, once
    unique = docs.select(F.struct(*docs.columns).alias(packed), *_row_keys(docs)).groupBy("key_a", "key_b").agg(F.first(packed).alias(packed))
    part = F.struct(F.col("first").alias("at"), (F.col("last") - F.col("first")).alias("n"))
    taken = draws.groupBy("number", "start", "pass").agg(F.sort_array(F.collect_list(part)).alias("parts"), F.sum("last").alias("ends"), F.sum("first").alias("begins"))
    rows = placed.where("size > 0").join(taken, ["number", "start"]).join(unique, ["key_a", "key_b"])
    found = F.regexp_extract_all(F.col(packed)["text"], F.lit(WORD), F.lit(0))
    some = F.array_join(F.flatten(F.transform("parts", lambda x: F.slice(found, (x["at"] + 1).cast("int"), x["n"].cast("int")))), " ")
    whole = F.col("ends") - F.col("begins") == F.col("size")
    own = {c: F.col(packed)[c] for c in docs.columns}
    out = rows.select(*(value.alias(c) for c, value in own.items() if c not in ("text", "n_chars")), F.when(whole, own["text"]).otherwise(some).alias("text"))
    if "n_chars" in own:
        out = out.withColumn("n_chars", F.char_length(F.col("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
