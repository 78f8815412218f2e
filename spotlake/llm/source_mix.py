"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target number of words; a document of a source takes part
``target / source size`` times. The whole part of that factor is copied outright, the rest
is a fractional copy that has to become 0 or 1. Two fractional copies play against each
other: one gains what the other gives, in a random direction with odds that keep both
expectations, until one of them is integral.

The plays form a reduction tree: documents of a source are dealt into chunks of about
CHUNK by the hash of id and text. A chunk plays its copies in order of size down to at most one
open copy; neighbouring chunks then form a chunk of the next level. A source with a third of all
rows simply has more chunks. Inside the tree copies pass on words, so the words expected of a
source never change. Such a game leaves the larger copy open, so a chunk keeps a ladder of copies
out of play (one in LADDER by size and a few of the smallest): the last chunk of a source then holds copies
of every size. There copies pass on probabilities, from the largest to the smallest: a game
errs by the difference of two neighbouring sizes times what was passed on, and the following,
smaller copy takes the error into its own odds. A copy that stays open until only much smaller ones are left
is drawn and its error carried on likewise, as is the last open copy, a small one.
Everything random is a hash of the seed, ids and texts, so reruns agree.

Targets: sources by code point, null last, weigh 5, 2, 1, 5, 2, 1 ... and share
``share`` times all words; a target stops at ``most`` times the size of its source, and the
excess is shared by weight among the others until none is above. In closed form: sources
sorted by size per weight are capped one after the other while the level of the rest lies
above their cap. The table of sources (one row each) is ranked in one task.

Nulls: a null text has size 0, a null source is a source of its own, a null id is an id.
Documents without words take 0; a source without words has target 0. Repeated rows are rows
of their own; different texts under one id are dealt apart. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from spotlake.llm.common import WORD, cut, let, text_of, uniform

WEIGHTS = (5, 2, 1)
CHUNK = 128
LADDER = 8


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights=WEIGHTS) -> DataFrame:
    """source, source_size, n_docs, target: one row per source of ``sizes`` (source, size)."""
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    every = Window.partitionBy()
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int")))
    # sorted by size per weight, what the sources before this one have used up
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    filled = (weighed
              .withColumn("total", F.sum("source_size").over(every) * share)
              .withColumn("cap", F.col("source_size") * most)
              .withColumn("rest", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
              .withColumn("rest_weight", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
              .withColumn("level", F.col("rest") / F.col("rest_weight"))
              .withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight")))
    # the level is that of the first source that is not capped
    final = F.min(F.when(~F.col("capped"), F.struct(F.col("rest_weight") * -1, F.col("level")))).over(every)["level"]
    return filled.select(
        "source", "source_size", "n_docs",
        F.when(F.col("capped"), F.col("cap")).otherwise(F.least(F.col("cap"), final * F.col("weight"))).alias("target"))


NAMES = ("id", "key", "size", "base")


def copy_of(unit: Column, mass: Column) -> Column:
    return F.struct(*[unit[n].alias(n) for n in NAMES], mass.alias("mass"))


def closed(unit: Column, taken: Column) -> Column:
    return F.array(F.struct(
        unit["id"].alias("id"), unit["size"].alias("size"), (unit["base"] + taken.cast("int")).alias("copies")))


def unit_of(seed: int, name: Column, key: Column, size: Column, base: Column, mass: Column, owed: Column) -> Column:
    """An open copy with its place in the order of play: large ones first, equal ones shuffled."""
    return F.struct((-size).alias("first"), F.xxhash64(F.lit(seed + 1), key).alias("turn"), name.alias("id"), key.alias("key"),
                    size.alias("size"), base.alias("base"), mass.alias("mass"), owed.alias("owed")).alias("unit")


def play(mine: Column, other: Column, last: Column, seed: int, close) -> Column:
    """One game of two open copies; ``close`` receives its result, at least one copy is settled.

    Copies pass on words, in the ``last`` chunk probabilities; ``owed`` is what their words lack
    after the game, 0 where words are passed on.
    """
    mine_rate = F.when(last, mine["size"].cast("double")).otherwise(1.0)
    other_rate = F.when(last, other["size"].cast("double")).otherwise(1.0)
    odds = F.struct(
        mine_rate.alias("mine_rate"), other_rate.alias("other_rate"),
        ((mine["size"] - mine["mass"]) / mine_rate).alias("room"), (other["mass"] / other_rate).alias("offer"),
        (mine["mass"] / mine_rate).alias("stock"), ((other["size"] - other["mass"]) / other_rate).alias("demand"))

    def settle(o: Column) -> Column:
        up, down = F.least(o["room"], o["offer"]), F.least(o["stock"], o["demand"])
        gain = uniform(F.lit(seed), mine["key"], other["key"]) * (up + down) < down
        moved = F.when(gain, up).otherwise(-down)
        return let(F.struct(
            gain.alias("gain"),
            (mine["mass"] + moved * o["mine_rate"]).alias("mine"),
            (other["mass"] - moved * o["other_rate"]).alias("other"),
            (moved * (o["other_rate"] - o["mine_rate"])).alias("owed"),
            F.when(gain, o["room"] <= o["offer"]).otherwise(o["stock"] <= o["demand"]).alias("mine_done"),
            F.when(gain, o["offer"] <= o["room"]).otherwise(o["demand"] <= o["stock"]).alias("other_done")), close)

    return let(odds, settle)


def play_chunk(units: Column, last: Column, id_type: str, seed: int) -> Column:
    """Let the copies of one chunk play one after the other, from large to small.

    What a game of the ``last`` chunk of a source owes enters the odds of the next copy. A copy
    still open there when the next one is less than half as large is drawn, so that smaller ones can
    take up what the draw owes.
    """
    opened = f"struct<id:{id_type},key:bigint,size:bigint,base:int,mass:double>"
    done = f"array<struct<id:{id_type},size:bigint,copies:int>>"
    state_type = f"struct<open:{opened},owed:double,done:{done}>"
    empty = F.struct(F.lit(None).cast(opened).alias("open"), F.lit(0.0).alias("owed"), F.array().cast(done).alias("done"))
    nothing = F.array().cast(done)

    def step(before: Column, unit: Column) -> Column:
        def lingering() -> Column:
            mine = before["open"]
            drawn = uniform(F.lit(seed + 1), mine["key"]) * mine["size"] < mine["mass"]
            return F.struct(
                F.lit(None).cast(opened).alias("open"),
                (before["owed"] + mine["mass"] - F.when(drawn, mine["size"]).otherwise(0)).alias("owed"),
                F.concat(before["done"], closed(mine, drawn)).alias("done"))

        large = last & before["open"].isNotNull() & (before["open"]["size"] > 2 * unit["size"])
        return let(F.when(large, lingering().cast(state_type)).otherwise(before.cast(state_type)), lambda s: play_unit(s, unit))

    def play_unit(state: Column, unit: Column) -> Column:
        def enter(now: Column) -> Column:
            mass, mine = now["mass"], state["open"]
            other = let(copy_of(unit, mass), lambda u: play(mine, u, last, seed, lambda g: F.struct(
                F.when(g["mine_done"] & g["other_done"], F.lit(None).cast(opened))
                 .when(g["mine_done"], copy_of(unit, g["other"])).otherwise(copy_of(mine, g["mine"])).alias("open"),
                (now["owed"] + g["owed"]).alias("owed"),
                F.concat(state["done"], F.when(g["mine_done"], closed(mine, g["gain"])).otherwise(nothing),
                         F.when(g["other_done"], closed(unit, ~g["gain"])).otherwise(nothing)).alias("done"))))
            settled = F.struct(mine.alias("open"), now["owed"].alias("owed"),
                               F.concat(state["done"], closed(unit, mass > 0)).alias("done"))
            first = F.struct(copy_of(unit, mass).alias("open"), now["owed"].alias("owed"), state["done"].alias("done"))
            return (F.when((mass <= 0) | (mass >= unit["size"]), settled.cast(state_type))
                    .when(mine.isNull(), first.cast(state_type)).otherwise(other.cast(state_type)))

        def clamped(wanted: Column) -> Column:
            mass = F.greatest(F.lit(0.0), F.least(unit["size"].cast("double"), wanted))
            return let(F.struct(mass.alias("mass"), (wanted - mass).alias("owed")), enter)

        return let(unit["mass"] + unit["owed"] + state["owed"], clamped)

    return F.aggregate(units, empty, step)


def on_ladder(units: Column, index: Column) -> Column:
    """Whether a chunk keeps the copy out of play: one in eight by size, and a few of the smallest."""
    rank = F.size(units) - index
    return (rank % LADDER == 0) | ((rank.bitwiseAND(rank - 1) == 0) & (rank * 16 < CHUNK))


def source_mix(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    share: float = 1.5, most: float = 2.0, weights=WEIGHTS, seed: int = 7,
) -> DataFrame:
    """id, size, source_size, target and taken (words, repeats counted) of every row."""
    kind = docs.schema[id_column].dataType.simpleString()
    sizes = cut(docs.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{source_column}`").alias("source"),
        F.regexp_count(text_of(text_column), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(f"`{id_column}`"), text_of(text_column)).alias("key")), "mix-sizes")
    targets = cut(source_targets(sizes, share, most, weights), "mix-targets")
    sizes, targets = sizes.alias("d"), targets.alias("t")
    # one row per source: Spark broadcasts it after checking its size
    units = sizes.join(targets, F.col("d.source").eqNullSafe(F.col("t.source"))).select(
        "id", "key", "size", "d.source", "source_size", "target", "n_docs",
        F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("factor"),
    ).withColumn("base", F.floor("factor").cast("int")).withColumn("part", F.col("factor") - F.col("base"))
    output = [F.col("id").alias(id_column), "size", "source_size", "target"]
    settled = [units.where(F.col("part") == 0).select(*output, (F.col("base") * F.col("size")).alias("taken"))]

    # a chunk hands on its ladder and one open copy, so this many fill the next chunk
    fan = max(2, CHUNK // (CHUNK // LADDER + 4))
    chunks = F.greatest(F.ceil(F.col("n_docs") / CHUNK), F.lit(1))
    group = ["source", "source_size", "target", "n_docs"]
    level = units.where(F.col("part") > 0).select(
        *group, F.pmod("key", chunks).alias("chunk"),
        unit_of(seed, F.col("id"), F.col("key"), F.col("size"), F.col("base"), F.col("part") * F.col("size"), F.lit(0.0)))
    largest = targets.agg(F.max("n_docs")).first()[0] or 1
    number, left = 0, None
    while left is None or left > 1:
        left = math.ceil(max(1, math.ceil(largest / CHUNK)) / fan**number)
        last = chunks <= fan**number
        held = F.when(last, F.slice("units", 1, 0)).otherwise(F.filter("units", lambda u, i: on_ladder(F.col("units"), i)))
        playing = F.when(last, F.col("units")).otherwise(F.filter("units", lambda u, i: ~on_ladder(F.col("units"), i)))
        played = cut(level.groupBy(*group, "chunk").agg(F.sort_array(F.collect_list("unit")).alias("units")).select(
            *group, "chunk", held.alias("held"), play_chunk(playing, last, kind, seed + 2 + 2 * number).alias("state"),
        ), f"mix-level-{number}")
        settled.append(played.select(*group, F.explode("state.done").alias("unit")).where("unit.size > 0").select(
            F.col("unit.id").alias(id_column), "unit.size", "source_size", "target",
            (F.col("unit.copies") * F.col("unit.size")).alias("taken")))
        # a chunk without an open copy may still owe words: a copy of size 0 carries them on
        chunk = F.floor(F.col("chunk") / fan).alias("chunk")
        opened = played.where(F.col("state.open").isNotNull() | (F.col("state.owed") != 0)).select(
            *group, chunk, unit_of(seed, F.col("state.open.id"), *[
                F.coalesce(F.col(f"state.open.{name}"), F.lit(0).cast(number_type)) for name, number_type in
                (("key", "long"), ("size", "long"), ("base", "int"), ("mass", "double"))], F.col("state.owed")))
        level = opened.unionAll(played.select(*group, chunk, F.explode("held").alias("unit")))
        number += 1
    drawn = uniform(F.lit(seed + 1000), F.col("unit.key")) * F.col("unit.size") < F.col("unit.mass") + F.col("unit.owed")
    settled.append(level.where("unit.size > 0").select(
        F.col("unit.id").alias(id_column), "unit.size", "source_size", "target",
        ((F.col("unit.base") + drawn.cast("int")) * F.col("unit.size")).alias("taken")))
    mixed = settled[0]
    for part in settled[1:]:
        mixed = mixed.unionAll(part)
    return mixed
