"""Mixing sources to target weights as a time-varying curriculum; DataFrame operations only."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faremeter.llm.common import WORD, as_row, partitions, text_of
from faremeter.sources.scratch import stored

WEIGHTS = (5, 2, 1)
#: How strongly a source of each weight fades over the training: its rate is target * (1 + ramp * (1 - 2 * t)).
RAMPS = (0.5, 0.0, -0.5)
MOST_REPEATS = 3
_NO_ID = -(1 << 63)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _pick(values: Sequence[float], place: Column) -> Column:
    """The value at a place of a repeating list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (place % len(values) + 1).cast("int"))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, ramps: Sequence[float] = RAMPS, most: int = MOST_REPEATS
) -> DataFrame:
    """Targets of the sources of a table (source, size): weights repeat in code point order of the sources, null last.

    All sizes are shared by weight; a source stops at `most` times its own size and the excess goes to the others. In
    ascending order of cap / weight the stopped sources come first, so one pass of running sums finds the level: a
    source is stopped if its cap / weight lies below what the sources from it on would share per weight. The windows
    run over one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    named = totals.withColumns({"_place": place}).withColumns(
        {
            "weight": _pick([int(w) for w in weights], F.col("_place")).cast("long"),
            "ramp": _pick([float(r) for r in ramps], F.col("_place")),
            "_cap": F.col("source_size") * most,
        }
    )
    order = Window.orderBy(F.col("_cap") / F.col("weight"), "_place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0))).cast("double") / (
        F.col("_weights") - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    levels = (
        named.withColumns({"_total": F.sum("source_size").over(everything), "_weights": F.sum("weight").over(everything)})
        .withColumn("_level", level)
        .withColumn("_stopped", F.col("_cap") / F.col("weight") < F.col("_level"))
        .withColumn("_shared", F.max(F.when(~F.col("_stopped"), F.col("_level"))).over(everything))
    )
    target = F.when(F.col("_stopped"), F.col("_cap").cast("double")).otherwise(F.col("weight") * F.col("_shared"))
    return levels.select("source", "source_size", "weight", "ramp", target.alias("target"))


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, ramps: Sequence[float] = RAMPS, most: int = MOST_REPEATS,
    size: Column | None = None,
) -> DataFrame:
    """How much of each document a mix to target weights takes, and when.

    In a source the documents follow each other in order of md5(doc_id). The mix takes whole passes over that order and
    then the beginning of one more, so a source's taken words are its target rounded to a word and no document is taken
    more than `most` times. The demand of a source up to time t is target * ((1 + ramp) * t - ramp * t * t), the
    integral of its schedule; the inverse of that gives the time at which a document starts.

    The running sum inside a source is taken per range partition and completed by one offset per (source, partition),
    so a source of any size is spread over many tasks.

    `size` is what a document counts, by default the words of its text; a table that has sizes needs no text.
    The rows come range-sorted by position, so that they are the training sequence; what is not taken comes last.
    Returns `row` (a struct of all columns of docs), size, source_size, target, taken, words_before (in the source's
    order), source_words (what the mix takes of the source), ramp, position (0 to 1, null if nothing is taken).
    Null text, or text without words: size 0, taken 0. Null source: a source of its own, the last. Null doc_id: first in
    its source. Repeated rows are separate documents. No rows give no rows.
    """
    order = [F.col("position").asc_nulls_last(), "source", "words_before"]
    timed = _timed(docs, weights, ramps, most, size)
    ranged = stored(timed.withColumn("source", F.col("row.source")), "mixed").repartitionByRange(partitions(docs.sparkSession), *order)
    return ranged.sortWithinPartitions(*order).drop("source")


def _timed(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, ramps: Sequence[float] = RAMPS, most: int = MOST_REPEATS,
    size: Column | None = None,
) -> DataFrame:
    """`mix` before its sort."""
    n = partitions(docs.sparkSession)
    keyed = docs.select(
        as_row(docs), F.col("source").alias("source"), F.col("doc_id").alias("doc_id"),
        (word_count(text_of()) if size is None else size).cast("long").alias("size"), F.md5(F.col("doc_id").cast("string").cast("binary")).alias("order"),
    )
    keys = ["source", "order", "doc_id", "size"]
    ordered = keyed.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    ranged = stored(ordered.withColumn("at", F.monotonically_increasing_id()), "mix")
    ranged = ranged.withColumn("part", F.shiftright("at", 33))
    in_part = Window.partitionBy("source", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    slices = ranged.groupBy("source", "part").agg(F.sum("size").alias("slice"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select("source", "part", F.coalesce(F.sum("slice").over(earlier), F.lit(0)).alias("offset"))
    targets = source_targets(ranged.select("source", "size"), weights, ramps, most)
    known = offsets.alias("o").join(targets.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source"))).select(
        "o.source", "o.part", "o.offset", "t.source_size", "t.target", "t.ramp",
        F.floor(F.col("t.target") + 0.5).cast("long").alias("source_words"),
    )
    placed = ranged.withColumn("inside", F.coalesce(F.sum("size").over(in_part), F.lit(0))).alias("r")
    joined = placed.join(
        known.alias("k"), F.col("r.source").eqNullSafe(F.col("k.source")) & (F.col("r.part") == F.col("k.part"))
    )
    before = F.col("offset") + F.col("inside")
    whole = F.coalesce(F.expr("try_divide(source_words - source_words % source_size, source_size)").cast("long"), F.lit(0))
    rest = F.coalesce(F.expr("try_mod(source_words, source_size)"), F.lit(0))
    out = joined.select(
        "row", "size", "source_size", "target", before.alias("words_before"), "source_words", "ramp", "order",
        (whole * F.col("size") + F.least(F.greatest(rest - before, F.lit(0)), F.col("size"))).cast("long").alias("taken"),
    )
    return out.withColumn("position", F.when(F.col("taken") > 0, _time(F.col("words_before")))).drop("order")


def _time(words: Column) -> Column:
    """The time at which a source's demand reaches so many words."""
    x = words.cast("double") / F.col("source_words")
    a = F.col("ramp")
    return x * 2 / ((a + 1) + F.sqrt((a + 1) * (a + 1) - a * 4 * x))


def curriculum(docs: DataFrame, **options) -> DataFrame:
    """The training sequence of a mix: the documents, repeated as often as it takes them, sorted by position.

    A last partial pass over a document counts as a copy from half of its words on. The mix is made of sizes; texts are
    joined to its positions and sorted once. Rows that are equal in all columns have the same mark, so one of them is
    joined to the positions of all. Returns the columns of docs; a document that the mix does not take, or without words,
    does not appear.
    """
    n = partitions(docs.sparkSession)
    mark = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("mark")
    known = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("known")
    sizes = docs.select("doc_id", "source", word_count(text_of()).alias("size"), mark, known)
    mixed = _timed(sizes, size=F.col("size"), **options)  # sorted below, by the position of each copy
    copies = F.floor((F.col("taken") * 2 + F.col("size")) / (F.col("size") * 2)).cast("int")
    repeated = mixed.filter((F.col("size") > 0) & (F.col("taken") * 2 >= F.col("size"))).select(
        "row.known", "row.mark", "words_before", "source_size", "source_words", "ramp",
        F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"),
    )
    start = F.least(F.col("words_before") + F.col("copy") * F.col("source_size"), F.col("source_words"))
    timed = stored(repeated.select("known", "mark", _time(start).alias("position")), "positions")
    single = docs.select(as_row(docs), mark, known).dropDuplicates(["known", "mark"])
    ranged = timed.join(single, ["known", "mark"]).repartitionByRange(n, "position", "known")
    return ranged.sortWithinPartitions("position", "known").select("row.*")


SQL = """
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size from documents),
named as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as place
  from sized group by source),
capped as (
  select *, [5, 2, 1][(place % 3 + 1)::int]::bigint as weight, [0.5e0, 0e0, -0.5e0][(place % 3 + 1)::int] as ramp,
    source_size * 3 as cap from named),
levels as (
  select *, (sum(source_size) over () - coalesce(sum(cap) over earlier, 0))::double
    / (sum(weight) over () - coalesce(sum(weight) over earlier, 0))::double as level
  from capped window earlier as (order by cap::double / weight, place rows between unbounded preceding and 1 preceding)),
targets as (
  select *, case when stopped then cap::double else weight * max(case when not stopped then level end) over () end as target
  from (select *, cap::double / weight < level as stopped from levels)),
placed as (
  select doc_id, size, source_size, target, ramp, floor(target + 0.5)::bigint as words,
    coalesce(sum(size) over (partition by s.source order by md5(doc_id::varchar) nulls first, doc_id nulls first, size
      rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from sized s join targets t on s.source is not distinct from t.source),
taken as (
  select *, case when source_size = 0 then 0
    else (words // source_size) * size + least(greatest(words % source_size - before, 0), size) end as taken from placed)
select doc_id, size, source_size, target, taken::bigint as taken,
  case when taken > 0 then (before::double / words) * 2
    / ((ramp + 1) + sqrt((ramp + 1) * (ramp + 1) - ramp * 4 * (before::double / words))) end as position
from taken
"""
