"""Operator 5: mixing sources to target weights by Sainte-Lague apportionment.

All work is DataFrame expressions. Targets are cut into blocks of equally many
words. Blocks go to sources by the highest quotients ``entitlement / (k + 1/2)``,
then those of a source to its shards by the same rule, so every shard has an
integer quota. A shard lays its documents end to end in a seeded order and takes
its quota: whole passes first, then consecutive blocks from a seeded one on. A
shard is a bounded share of a source, so no source, however large, is
ordered in one task.

The highest quotients need no queue: seats up to a first bound surely are among
them, seats from a second bound on surely aren't, and fewer than two seats a
unit lie between, which are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sliceflow.llm.common import spill

WEIGHTS = (1, 2, 3)
#: a document is taken so many times at most
REPEATS = 3
#: words in a block
BLOCK = 16
#: words in a shard, about
SHARD = 1 << 22
#: a source has so many shards at most
#: rows of a shard on average, at most
SHARD_ROWS = 1_000_000
SLOTS = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Adds (target, place) to a table with one row per source (source,
    source_size): sources in order of code points, null last, have the weights
    in turn and share all words by them; what exceeds ``repeats`` times a
    source is shared again among the others by weight, until none is above.

    That is ``min(weight * level, cap)`` for one level: when the first sources
    by cap / weight are full, the rest share what is left. One row per
    source is ordered in one task, documents are not.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    s = sources.withColumn("place", place)
    s = s.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * F.lit(float(repeats))).withColumn("fill", F.col("cap") / F.col("w"))
    order = Window.orderBy("fill", "place")
    full = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_ = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    whole = Window.partitionBy()
    s = s.withColumn("level", (F.sum("source_size").over(whole) - full) / open_)
    level = F.max(F.when(F.col("level") <= F.col("fill"), F.col("level"))).over(whole)
    return s.withColumn("target", F.least(F.col("w") * F.coalesce(level, F.lit(0.0)), F.col("cap"))).select("source", "source_size", "place", "target")


def sainte_lague(units: DataFrame, group: list[str], order: list[str], entitlement: str, seats: str, quota: str) -> DataFrame:
    """Adds ``quota``: the ``seats`` of each group, dealt to its units by the
    highest quotients entitlement / (k + 1/2), ties to the first by ``order``
    (which names a unit of its group). Entitlements below or equal to 0 get none."""
    w = Window.partitionBy(*group)
    e, n = F.col(entitlement).cast("double"), F.col(seats).cast("double")
    total, half = F.sum(e).over(w), F.sum(F.when(e > 0, 0.5).otherwise(0.0)).over(w)
    sure = F.greatest(F.floor(e * (n - half) / total + 0.5), F.lit(0).cast("long"))
    last = F.floor(e * (n + half) / total + 0.5) + 1
    u = units.withColumn("_sure", F.when(e > 0, sure).otherwise(F.lit(0).cast("long"))).withColumn("_last", F.when(e > 0, last))
    u = u.withColumn("_left", n.cast("long") - F.sum("_sure").over(w))
    seat = (u.where("_last > _sure").select(*group, *order, e.alias("_e"), "_left", F.explode(F.sequence(F.col("_sure"), F.col("_last") - 1)).alias("_k")))
    best = Window.partitionBy(*group).orderBy(F.desc(F.col("_e") / (F.col("_k") + 0.5)), *order, "_k")
    won = (seat.withColumn("_r", F.row_number().over(best)).where("_r <= _left").groupBy(*group, *order).agg(F.count("*").alias("_more")))
    keys = [*group, *order]
    won = won.select(*[F.col(k).alias(f"_x{i}") for i, k in enumerate(keys)], "_more")
    on = [u[k].eqNullSafe(won[f"_x{i}"]) for i, k in enumerate(keys)]
    joined = u.join(won, on, "left") if keys else u.crossJoin(won)
    return joined.select(*units.columns, (F.col("_sure") + F.coalesce("_more", F.lit(0).cast("long"))).alias(quota))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, block: int = BLOCK, shard: int = SHARD, seed: int = 0,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: list[str] | None = None) -> DataFrame:
    """Adds (size, source_size, target, taken) to every row of ``docs``: words of
    its text (null: 0), of its source, the words that its source should
    give, and those that the mix takes of this row, repeats counted.

    A row is taken ``repeats`` times its size at most. Columns of these four
    names are replaced, other columns are kept whatever they are called (those of ``keep``
    alone, if it is given: texts that nobody wants are not sent). Rows
    that repeat an id are rows of their own; null sources are one source, the
    last. An empty table gives no rows. The same seed gives the same mix.
    """
    made = ["size", "source_size", "target", "taken"]
    own = [c for c in (docs.columns if keep is None else keep) if c not in made]
    row = docs.select(F.struct(*[docs[c] for c in own]).alias("row"), docs[id_col].alias("id"), docs[source_col].cast("string").alias("source"), word_count(docs[text_col]).alias("size"),
                      F.xxhash64(F.lit(seed), docs[id_col], docs[text_col]).alias("draw")).withColumn("slot", F.pmod("draw", F.lit(SLOTS)))
    slots = spill(row.groupBy("source", "slot").agg(F.sum("size").alias("words"), F.count("*").alias("rows")), "slots")
    heads = slots.groupBy("source").agg(F.sum("rows").alias("rows")).withColumnRenamed("source", "_h")

    s = targets(slots.groupBy("source").agg(F.sum("words").alias("source_size")), weights, repeats)
    s = s.withColumn("blocks", F.col("target") / block).withColumn("seats", F.round(F.sum("target").over(Window.partitionBy()) / block))
    s = sainte_lague(s, [], ["place"], "blocks", "seats", "quota")
    # a shard has so many words and rows on average, whichever are more
    parts = F.greatest(F.col("source_size") / shard, F.col("rows") / SHARD_ROWS)
    s = (s.join(heads, F.col("source").eqNullSafe(F.col("_h"))).withColumn("shards", F.greatest(F.lit(1), F.least(F.lit(SLOTS), F.ceil(parts))).cast("long")).drop("_h", "rows"))

    u = slots.join(s.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).withColumn("shard", F.pmod("slot", F.col("shards")))
    u = (u.groupBy("place", "shard").agg(F.first("source").alias("source"), F.first("shards").alias("shards"), F.first("source_size").alias("source_size"),
                                         F.first("target").alias("target"), F.first("quota").alias("quota"), F.sum("words").alias("unit_size")))
    u = sainte_lague(u, ["place"], ["shard"], "unit_size", "quota", "unit_quota")
    words = F.least(F.col("unit_quota") * block, F.col("unit_size") * repeats)
    u = (u.withColumn("passes", F.when(F.col("unit_size") > 0, F.floor(words / F.col("unit_size"))).otherwise(F.lit(0)).cast("long"))
         .withColumn("rest", F.when(F.col("unit_size") > 0, words - F.col("passes") * F.col("unit_size")).otherwise(F.lit(0)).cast("long"))
         .withColumn("first", F.pmod(F.xxhash64(F.lit(seed), "source", "shard"), F.greatest(F.lit(1), F.ceil(F.col("unit_size") / block)).cast("long")) * block))
    u = spill(u.select(F.col("source").alias("_s"), "shard", "shards", "source_size", "target", "unit_size", "passes", "rest", "first"), "quotas")

    # a source has a row for each of its shards here; documents find the number first
    n = u.groupBy("_s").agg(F.first("shards").alias("shards")).withColumnRenamed("_s", "_n")
    row = row.join(n, F.col("source").eqNullSafe(F.col("_n"))).withColumn("_shard", F.pmod("slot", F.col("shards"))).drop("shards", "_n")
    row = row.join(u.drop("shards"), F.col("source").eqNullSafe(F.col("_s")) & (F.col("_shard") == F.col("shard")))
    order = Window.partitionBy("source", "shard").orderBy("draw", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    row = row.withColumn("start", F.coalesce(F.sum("size").over(order), F.lit(0).cast("long")))
    end = F.col("start") + F.col("size")
    overlap = lambda a, b: F.greatest(F.least(end, b) - F.greatest(F.col("start"), a), F.lit(0).cast("long"))
    stop = F.col("first") + F.col("rest")
    extra = overlap(F.col("first"), F.least(stop, F.col("unit_size"))) + overlap(F.lit(0).cast("long"), stop - F.col("unit_size"))
    return row.select("row.*", "size", "source_size", "target", (F.col("passes") * F.col("size") + extra).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix with their own columns: every row as often as the
    words taken of it fill it, to the nearest whole document; rows of which
    less than half is taken, and those without words, go."""
    at = {name: i for i, name in reversed(list(enumerate(docs.columns)))}
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # whatever the names are
    t = mix(plain, id_col=f"c{at['doc_id']}", text_col=f"c{at['text']}", source_col=f"c{at['source']}", **options)
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(F.lit(0)).cast("int")
    t = t.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies)))
    return t.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(docs.columns)])


def op5_mixing(spark, sf_dir):
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep=["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")
