"""Mixing sources to target weights along a time-varying curriculum, native Spark only.

Every source has a target in words (its share of the budget, at most ``epochs``
times what it holds) and a schedule: relative weights at evenly spaced moments of
the training, linear in between.  The integral of the schedule, scaled to the
target, is the source's cumulative demand D(t).  Documents of a source stand in
a fixed pseudo-random order, once per epoch; a document that starts at word c of
that sequence is due at the time t with D(t) = c.  So the time of a document is
the inverse of the demand at its running total, and sorting all documents by
time range by range gives the training order.

Running totals never meet in one task: a source is cut into ``cells`` by the hash
that orders it (of doc_id and text, so that rows of one doc_id are spread as well), a
window sums within a cell, and the totals of the cells before it come from a second
window over one row per (source, cell).  Targets need all sources in one order: a row
per source goes through one task, which may spill.

Edge cases: null text has size 0; a null source is a source, and the last one;
sources or documents of size 0 get target 0 and take nothing; a text of any length is one
document; repeated rows are documents of their own, and which of rows equal in source,
doc_id and text is taken makes no difference; an empty table gives an empty table; other
columns stay with their rows, but those named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.shared import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Relative demand at the start, in the middle and at the end of the training; dealt to the sources in turn.
SCHEDULES = ((2.0, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 2.0))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    """Empty for null, else a letter and the name."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit(""))


def targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """Per source (columns source, source_size): its ordinal, weight and target.

    Resharing the excess of full sources until none is above its limit ends where
    every source that is not full has weight times one common level.  Sources fill
    up in the order of limit / weight, so the level is found by looking, for each
    source in that order, whether the level left by those before it stays below
    its own ratio.  One row per source goes through one task.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("ordinal") % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("ordinal", (F.row_number().over(by_name) - 1).cast("int")).withColumn("weight", weight)
    rows = rows.withColumn("limit", F.col("source_size") * epochs).withColumn("ratio", F.col("limit") / F.col("weight"))
    filling = Window.orderBy("ratio", "ordinal")
    everything = Window.partitionBy()
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        rows.withColumn("budget", F.sum("source_size").over(everything) * share)
        .withColumn("full_before", F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", (F.col("budget") - F.col("full_before")) / F.col("weight_left"))
        .withColumn("common", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "ordinal", "level"))).over(everything)["level"])
    )
    return rows.select(
        "source", "source_size", "ordinal", F.least(F.col("limit").cast("double"), F.coalesce(F.col("weight") * F.col("common"), F.col("limit").cast("double"))).alias("target")
    )


def due(demand: Column, ordinal: Column, schedules=SCHEDULES) -> Column:
    """The time (0 to 1) at which a source has asked for this part (0 to 1) of its target."""
    out = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        step = 1.0 / (len(knots) - 1)
        areas = [(a + b) / 2 * step for a, b in zip(knots, knots[1:], strict=False)]
        whole = sum(areas)
        inverse = F.lit(1.0)
        for j in reversed(range(len(areas))):
            a, slope = knots[j], (knots[j + 1] - knots[j]) / step
            rest = F.greatest(demand * whole - sum(areas[:j]), F.lit(0.0))
            # rest = a x + slope x^2 / 2, in the form that does not cancel
            x = 2 * rest / (a + F.sqrt(F.greatest(F.lit(a * a) + 2 * slope * rest, F.lit(0.0))))
            inverse = F.when(demand * whole <= sum(areas[: j + 1]), F.least(j * step + x, F.lit(1.0))).otherwise(inverse)
        out = F.when(ordinal % len(schedules) == k, inverse).otherwise(out)
    return out


RESULTS = ("size", "source_size", "target", "taken", "positions")


def mix(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, epochs: int = 2, cells: int = 4096, schedules=SCHEDULES, size: Column | None = None, tie: Column | None = None) -> DataFrame:
    """Add size, source_size, target, taken, and positions (array<double>, one for each time the document is due).

    ``docs`` needs doc_id, source and either text or ``size`` and ``tie``, the words of a
    document and what tells documents of equal doc_id apart.  It is read twice, so it
    should be a table.
    """
    size = word_count(F.col("text")) if size is None else size
    tie = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")) if tie is None else tie
    # a key without nulls: the window and the join after it then share one shuffle of the rows
    rows = docs.withColumns({"__size": size, "__source": _source_key(F.col("source"))})
    rows = rows.withColumn("__h", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), tie).cast("binary")))
    rows = rows.drop(*RESULTS).withColumn("__cell", F.conv(F.substring("__h", 1, 6), 16, 10).cast("int") % cells)
    per_cell = rows.groupBy("__source", "__cell").agg(F.sum("__size").alias("__words"))
    name = F.when(F.col("__source") != "", F.substring("__source", 2, 1 << 30))
    sizes = per_cell.groupBy("__source").agg(F.sum("__words").alias("source_size")).select(name.alias("source"), "source_size")
    aims = targets(sizes, weights, share, epochs).select(_source_key(F.col("source")).alias("__source"), "source_size", F.col("ordinal").alias("__ordinal"), "target")
    before = Window.partitionBy("__source").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_cell.withColumn("__from", F.coalesce(F.sum("__words").over(before), F.lit(0))).drop("__words").join(aims, "__source")
    within = Window.partitionBy("__source", "__cell").orderBy("__h").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("__start", F.coalesce(F.sum("__size").over(within), F.lit(0)))
    placed = placed.join(starts, ["__source", "__cell"])
    placed = placed.withColumn("__start", F.col("__start") + F.col("__from")).withColumn("__aim", F.round("target").cast("long"))
    parts = [F.greatest(F.lit(0).cast("long"), F.least(F.col("__size"), F.col("__aim") - F.col("__start") - e * F.col("source_size"))) for e in range(epochs)]
    when = [F.when(p > 0, due((F.col("__start") + e * F.col("source_size")) / F.col("target"), F.col("__ordinal"), schedules)) for e, p in enumerate(parts)]
    return (
        placed.withColumn("taken", sum(parts[1:], parts[0]))
        .withColumn("positions", F.filter(F.array(*when), lambda x: x.isNotNull()))
        .withColumnRenamed("__size", "size")
        .drop("__h", "__cell", "__start", "__source", "__from", "__aim", "__ordinal")
    )


def schedule(mixed: DataFrame, ties: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row for each time a document is due, sorted by position over ranges: the training order."""
    each = mixed.drop("position").withColumn("position", F.explode("positions")).drop("positions")
    return each.repartitionByRange("position", *ties).sortWithinPartitions("position", *ties)


def numbered(ordered: DataFrame) -> DataFrame:
    """Rows sorted over ranges with ``place``, their number from 0; a row per task goes through one window."""
    placed = materialize(ordered.withColumn("__id", F.monotonically_increasing_id()), "training-order").withColumn("__part", F.shiftright("__id", 33))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("__part").count().select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__from"))
    return placed.join(starts, "__part").withColumn("place", F.col("__from") + F.col("__id").bitwiseAND((1 << 33) - 1)).drop("__part", "__from", "__id")


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, and where in the training order: the times (0 to 1) and the places (from 0) of its first and second use."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tie = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("tie")
    slim = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("words"), tie, F.monotonically_increasing_id().alias("row")), "mixing")
    mixed = materialize(mix(slim, size=F.col("words"), tie=F.col("tie")).drop("words"), "mixed")
    order = numbered(schedule(mixed.select("row", "doc_id", "tie", "positions"), ("doc_id", "tie", "row")))
    places = order.groupBy(F.col("row").alias("of")).agg(F.min("place").alias("place"), F.when(F.count("*") > 1, F.max("place")).alias("place_2"))
    found = mixed.join(places, mixed["row"] == places["of"], "left")
    return found.select("doc_id", "size", "source_size", "target", "taken", F.get("positions", 0).alias("position"), F.get("positions", 1).alias("position_2"), "place", "place_2")


_POSITION = []
for _k, _knots in enumerate(SCHEDULES):
    _step = 1.0 / (len(_knots) - 1)
    _areas = [(a + b) / 2 * _step for a, b in zip(_knots, _knots[1:], strict=False)]
    _cases = []
    for _j in range(len(_areas)):
        _a, _slope = _knots[_j], (_knots[_j + 1] - _knots[_j]) / _step
        _rest = f"greatest(demand * {sum(_areas)}::double - {sum(_areas[:_j])}::double, 0::double)"
        _x = f"2 * {_rest} / ({_a}::double + sqrt(greatest({_a * _a}::double + {2 * _slope}::double * {_rest}, 0::double)))"
        _cases.append(f"when demand * {sum(_areas)}::double <= {sum(_areas[: _j + 1])}::double then least({_j * _step}::double + {_x}, 1::double)")
    _POSITION.append(f"when ordinal % {len(SCHEDULES)} = {_k} then case {' '.join(_cases)} else 1::double end")

ORACLE = rf"""
with d as (
  select row_number() over () as n, doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size, md5(coalesce(text, '')) as tie,
         md5(coalesce(doc_id::varchar, 'null') || ':' || md5(coalesce(text, ''))) as h from documents),
s as (
  select source, sum(size)::bigint as source_size from d group by source),
o as (
  select *, (row_number() over (order by source is null, encode(source)) - 1)::int as ordinal from s),
w as (
  select *, (case ordinal % 3 when 0 then 3 when 1 then 1 else 2 end) as weight, source_size * 2 as lim from o),
r as (
  select *, lim::double / weight as ratio, (sum(source_size) over ())::double * 1.5::double as budget from w),
l as (
  select *, (budget - coalesce(sum(lim) over (order by ratio, ordinal rows between unbounded preceding and 1 preceding), 0)::double)
         / (sum(weight) over () - coalesce(sum(weight) over (order by ratio, ordinal rows between unbounded preceding and 1 preceding), 0))::double as level from r),
c as (
  select *, (select level from l where level <= ratio order by ratio, ordinal limit 1) as common from l),
t as (
  select source, source_size, ordinal, least(lim::double, coalesce(weight * common, lim::double)) as target from c),
p as (
  select d.n, d.doc_id, d.tie, d.size, t.source_size, t.target, t.ordinal, round(t.target)::bigint as aim,
         coalesce(sum(d.size) over (partition by d.source order by (('0x' || substr(h, 1, 6))::bigint % 4096), h
           rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from d join t on d.source is not distinct from t.source),
q as (
  select *, greatest(0, least(size, aim - start)) as first, greatest(0, least(size, aim - start - source_size)) as second from p),
u as (
  select n, doc_id, tie, ordinal, 0 as epoch, start::double / target as demand from q where first > 0
  union all
  select n, doc_id, tie, ordinal, 1, (start + source_size)::double / target from q where second > 0),
v as (
  select n, doc_id, tie, epoch, case {' '.join(_POSITION)} end as position from u),
x as (
  select *, row_number() over (order by position, doc_id nulls first, tie, n) - 1 as place, row_number() over (partition by n order by epoch) as k from v)
select q.doc_id, q.size, q.source_size, q.target, (q.first + q.second)::bigint as taken, a.position, b.position as position_2, least(a.place, b.place) as place,
  case when b.place is not null then greatest(a.place, b.place) end as place_2
from q left join x a on a.n = q.n and a.k = 1 left join x b on b.n = q.n and b.k = 2
"""
