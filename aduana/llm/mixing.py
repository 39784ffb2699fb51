"""Mixing sources to target weights by pivotal dependent rounding.

A source's target and its size give the number of copies that each of its documents should have on average, up to two:
a whole part, and a fraction, which is the probability of one more copy. The fractions are rounded in pairs: of two
documents, words' worth of probability moves from one to the other, in a random direction whose odds keep both
expectations, until one of the two probabilities is 0 or 1. That one is settled; the other meets the next. The expected
words of the source never change, so what a source takes differs from its target by one document at most.

Documents meet within buckets of about `FAN_IN`, by hash; each bucket leaves one unsettled document, and these meet in
buckets of the next level, until a source has one left, which a last draw settles. The reduction tree has a level for
each power of `FAN_IN`; a hot source has more buckets, not longer ones. Draws are hashes of the documents that meet, so
reruns agree. All of it is built-in DataFrame and SQL functions.

Sources are in code point order, null last, and get `WEIGHTS` in turn. They share `SHARE` times all words by weight; a
target stops at `MOST` times its source's size, and what is over is shared anew by weight until none is above. There is
one row per source at that point, and they are ranked together.

Rows equal in doc_id, source and size are one unit. Of r such rows, r p are to get a further copy: the whole part of them
does, and one row more meets others with the fraction as its probability.

Cases: null and empty texts have size 0 and take nothing; a source without words has target 0; of repeated rows as many as
the mix asks for get a further copy; null doc_ids and sources are values like others; an empty table gives no rows. `mixture`
keeps all columns of the rows, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from aduana.functions.frames import quoted
from aduana.llm.common import WORD_REGEX, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
FAN_IN = 64
#: Rows of a unit that one part of it makes.
PART_ROWS = 10_000
_UNIT = "struct<h: bigint, doc_id: bigint, size: bigint, s: double, p: double>"
_DONE = "array<struct<doc_id: bigint, size: bigint, up: int>>"

# Two documents i and j meet: `up` is what i can gain from j, `down` what j can gain from i, in words.
_PAIR = """named_struct(
  'i', acc.carry, 'j', x,
  'up', least((1 - acc.carry.p) * acc.carry.s, x.p * x.s),
  'down', least(acc.carry.p * acc.carry.s, (1 - x.p) * x.s),
  'draw', pmod(xxhash64({seed}, acc.carry.h, x.h), 9007199254740992) / 9007199254740992.0)"""
_MEET = f"""aggregate(units, named_struct('carry', CAST(NULL AS {_UNIT}), 'done', CAST(array() AS {_DONE})), (acc, x) ->
  CASE WHEN acc.carry IS NULL THEN named_struct('carry', x, 'done', acc.done)
  ELSE transform(array({_PAIR}), t -> CASE
    WHEN t.draw * (t.up + t.down) < t.down AND (1 - t.i.p) * t.i.s <= t.j.p * t.j.s THEN named_struct(
      'carry', named_struct('h', t.j.h, 'doc_id', t.j.doc_id, 'size', t.j.size, 's', t.j.s, 'p', t.j.p - t.up / t.j.s),
      'done', concat(acc.done, array(named_struct('doc_id', t.i.doc_id, 'size', t.i.size, 'up', 1))))
    WHEN t.draw * (t.up + t.down) < t.down THEN named_struct(
      'carry', named_struct('h', t.i.h, 'doc_id', t.i.doc_id, 'size', t.i.size, 's', t.i.s, 'p', t.i.p + t.up / t.i.s),
      'done', concat(acc.done, array(named_struct('doc_id', t.j.doc_id, 'size', t.j.size, 'up', 0))))
    WHEN t.i.p * t.i.s <= (1 - t.j.p) * t.j.s THEN named_struct(
      'carry', named_struct('h', t.j.h, 'doc_id', t.j.doc_id, 'size', t.j.size, 's', t.j.s, 'p', t.j.p + t.down / t.j.s),
      'done', concat(acc.done, array(named_struct('doc_id', t.i.doc_id, 'size', t.i.size, 'up', 0))))
    ELSE named_struct(
      'carry', named_struct('h', t.i.h, 'doc_id', t.i.doc_id, 'size', t.i.size, 's', t.i.s, 'p', t.i.p - t.down / t.i.s),
      'done', concat(acc.done, array(named_struct('doc_id', t.j.doc_id, 'size', t.j.size, 'up', 1))))
    END)[0] END)"""


def size_in_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_REGEX)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, n_units and target of each source, from units with source, s (words) and their number."""
    sources = sizes.groupBy("source").agg(F.sum("s").alias("source_size"), F.count(F.lit(1)).alias("n_units"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(WEIGHTS)
    weights = F.array(*(F.lit(w) for w in WEIGHTS))
    everything = Window.partitionBy()
    ranked = sources.withColumn("weight", F.element_at(weights, turn + 1)).withColumns({
        "budget": SHARE * F.sum("source_size").over(everything),
        "cap": MOST * F.col("source_size"),
        "fills_at": MOST * F.col("source_size") / F.col("weight"),
    })
    # Sources fill up in order of words per weight; `rate` is the share per weight if all before this one are full.
    before = Window.orderBy("fills_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("fills_at", F.col("source").asc_nulls_last()).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = ranked.withColumn(
        "rate", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after))
    open_rate = F.min(F.when(F.col("fills_at") > F.col("rate"), F.struct("fills_at", "rate"))).over(everything)["rate"]
    full = open_rate.isNull() | (F.col("fills_at") <= open_rate)
    target = F.when(full, F.col("cap").cast("double")).otherwise(open_rate * F.col("weight"))
    return ranked.select("source", "source_size", "n_units", target.alias("target"))


def _settled(units: DataFrame, seed: int) -> DataFrame:
    """source, doc_id, size, up: 1 for units that get a further copy. Units have source, n_units, doc_id, size, s, p."""
    largest = units.agg(F.max("n_units")).first()[0]
    if largest is None:
        return units.select("source", "doc_id", "size", F.lit(0).alias("up"))
    draw = F.xxhash64(F.lit(seed), "doc_id", "size")
    buckets = F.ceil(F.col("n_units") / FAN_IN)
    left = units.select(
        "source", F.pmod(draw, buckets).alias("bucket"), F.struct(draw.alias("h"), "doc_id", "size", "s", "p").alias("unit"))
    settled, span, level = [], -(-largest // FAN_IN), 0
    while True:
        met = left.groupBy("source", "bucket").agg(F.array_sort(F.collect_list("unit")).alias("units"))
        met = written(met.select("source", "bucket", F.expr(_MEET.format(seed=seed + level)).alias("met")), "mixing-level")
        settled.append(met.select("source", F.explode("met.done").alias("d")).select("source", "d.doc_id", "d.size", "d.up"))
        left = met.select("source", F.floor(F.col("bucket") / FAN_IN).alias("bucket"), F.col("met.carry").alias("unit"))
        level += 1
        if span <= 1:
            break
        span = -(-span // FAN_IN)
    last = F.pmod(F.xxhash64(F.lit(seed - 1), "unit.h"), F.lit(1 << 53)) / F.lit(float(1 << 53)) < F.col("unit.p")
    out = left.select("source", "unit.doc_id", "unit.size", last.cast("int").alias("up"))
    for part in settled:
        out = out.unionByName(part)
    return out


def copies_of_units(sizes: DataFrame, seed: int = 11) -> DataFrame:
    """source, doc_id, size, source_size, target, rows, copies, more for each distinct (source, doc_id, size) of `sizes`: each
    of its `rows` has `copies` copies, and `more` of them one further."""
    units = sizes.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("rows"))
    units = units.withColumn("s", F.col("rows") * F.col("size"))
    units = written(units, "mixing-units")
    targets = source_targets(units).withColumnRenamed("source", "source_")
    # One row per source.
    units = units.join(targets, F.col("source").eqNullSafe(F.col("source_"))).drop("source_")
    mean = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = units.withColumn("whole", F.floor(mean)).withColumn("ups", F.col("rows") * (mean - F.floor(mean)))
    units = written(units.withColumn("p", F.col("ups") - F.floor("ups")), "mixing-shares")
    open_units = units.where("s > 0 AND p > 0").withColumn("s", F.col("size").cast("double"))
    ups = _settled(open_units, seed).select(
        F.col("source").alias("u_source"), F.col("doc_id").alias("u_id"), F.col("size").alias("u_size"), "up")
    same = F.col("source").eqNullSafe(F.col("u_source")) & F.col("doc_id").eqNullSafe(F.col("u_id")) & (F.col("size") == F.col("u_size"))
    counted = units.join(ups, same, "left").select(
        "source", "doc_id", "size", "source_size", "target", "rows",
        F.when(F.col("size") > 0, F.col("whole")).otherwise(0).cast("int").alias("copies"),
        F.when(F.col("size") > 0, F.floor("ups") + F.coalesce("up", F.lit(0))).otherwise(0).alias("more"))
    # The same for all rows of a unit, where it can be.
    alike = F.col("more") == F.col("rows")
    return counted.withColumn("copies", F.col("copies") + alike.cast("int")).withColumn("more", F.when(alike, 0).otherwise(F.col("more")))


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size_in_words(F.col("text")).alias("size"))


def mixed_sizes(docs: DataFrame, seed: int = 11) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every row."""
    units = written(copies_of_units(_sized(docs), seed), "mixing-copies")
    columns = ["doc_id", "source", "size", "source_size", "target"]
    lone = units.where("rows = 1").select(*columns, (F.col("copies") * F.col("size")).alias("taken"))
    # Rows of a unit are equal here, so they are made of it, in parts of a bounded number of rows.
    parts = units.where("rows > 1").select("*", F.explode(F.expr(f"sequence(0L, (rows - 1) div {PART_ROWS})")).alias("part"))
    numbered = parts.repartition("source", "doc_id", "size", "part").select(
        "*", F.explode(F.expr(f"sequence(part * {PART_ROWS} + 1, least(rows, (part + 1) * {PART_ROWS}))")).alias("number"))
    taken = F.col("size") * (F.col("copies") + (F.col("number") <= F.col("more")).cast("int"))
    return lone.unionByName(numbered.select(*columns, taken.alias("taken")))


def mixture(docs: DataFrame, seed: int = 11) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it."""
    units = copies_of_units(_sized(docs), seed).where("copies > 0 OR more > 0")
    units = written(units.select(F.struct("source", "doc_id", "size", "copies", "more").alias("__mix__")), "mixing-copies")
    whole = docs.select(F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("__row__"))
    row, mix = F.col("__row__"), F.col("__mix__")
    same = (
        row["doc_id"].cast("long").eqNullSafe(mix["doc_id"]) & row["source"].cast("string").eqNullSafe(mix["source"])
        & (size_in_words(row["text"]) == mix["size"]))
    met = whole.join(units, same)
    taken = met.select("__row__", F.explode(F.array_repeat(F.lit(True), mix["copies"])).alias("__copy__")).select("__row__")
    if not units.where(mix["more"] > 0).isEmpty():
        # Of repeated rows that are not all taken alike, the first ones by their text get the further copy.
        unit = Window.partitionBy(mix["source"], mix["doc_id"], mix["size"]).orderBy(F.xxhash64(row["text"]))
        some = met.where(mix["more"] > 0).withColumn("__number__", F.row_number().over(unit))
        taken = taken.unionByName(some.where(F.col("__number__") <= mix["more"]).select("__row__"))
    return taken.select("__row__.*")
