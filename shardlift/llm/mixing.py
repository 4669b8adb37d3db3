"""Mixing sources to target weights by pivotal rounding of the documents' copies, in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardlift.shared import write_shared

WEIGHTS = (3, 1, 2)
# Of all sizes, what the targets share.
SHARE = 1.5
# A target is at most this many times its source's size.
MOST = 2.0
# Documents that are rounded together in one step of the tree.
FAN_IN = 128
_WORD = r"[^\x20\x09-\x0D]+"


def text_size(text: Column) -> Column:
    """Words of a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def numbered(sources: DataFrame, name: str) -> DataFrame:
    """Adds `sid`, from 0 in code point order with null last: counted inside ranges, then across them."""
    ranged = sources.repartitionByRange(F.col(name).asc_nulls_last()).withColumn("range", F.spark_partition_id())
    ranged = write_shared(ranged, "ranges")
    sizes = ranged.groupBy("range").agg(F.count("*").alias("n"))
    # One row for each partition.
    before = sizes.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(F.col(name).asc_nulls_last()))
    return ranged.join(before, "range").withColumn("sid", (F.col("before") + inside - 1).cast("long")).drop(
        "range", "before"
    )


def _level(sources: DataFrame, total: float, share: float, most: float) -> float:
    """The target for one unit of weight, once the sources above their limit are held at it.

    The limits that are reached only grow from round to round, so it ends; every round is one row of sums.
    """
    limit, held = most * F.col("source_size"), F.lit(False)
    level, above = 0.0, -1
    while True:
        limits, weights, now = sources.agg(
            F.coalesce(F.sum(F.when(held, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~held, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(held, True)),
        ).first()
        if now == above or not weights:
            return level
        above, level = now, (share * total - limits) / weights
        held = F.col("weight") * level > limit


def source_targets(
    sizes: DataFrame,
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """Rows (source, units, source_size, sid, target) from rows (source, size)."""
    sums = sizes.groupBy(source).agg(F.sum("size").alias("source_size"), F.count("*").alias("units"))
    sources = numbered(sums, source)
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    sources = sources.withColumn("weight", F.get(cycle, (F.col("sid") % len(weights)).cast("int")))
    sources = write_shared(sources, "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = _level(sources, total, share, most)
    target = F.least(F.col("weight") * level, most * F.col("source_size"))
    return sources.withColumn("target", target.cast("double")).drop("weight")


def _uniform(*of: Column) -> Column:
    return (F.pmod(F.xxhash64(*of), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


# One step: the carried unit `c` meets the next unit `x`. Mass goes from one to the other, so that the sum of
# mass times probability stays and each expectation stays, until one of them is 0 or 1. That one is done; the
# other is carried on. `up` is how far `c` can rise, `down` how far it can fall.
_STEP = """
(s, x) -> if(s.c is null, named_struct('c', x, 'done', s.done),
  transform(array(named_struct(
      'up', least(s.c.mass * (1 - s.c.p), x.mass * x.p), 'down', least(s.c.mass * s.c.p, x.mass * (1 - x.p)))), m ->
    transform(array(if({draw} * (m.up + m.down) < m.down, m.up, -m.down)), d ->
      transform(array(named_struct(
          'c', named_struct('mass', s.c.mass, 'h', s.c.h, 'doc_id', s.c.doc_id, 'size', s.c.size,
                            'p', {clean_c}),
          'x', named_struct('mass', x.mass, 'h', x.h, 'doc_id', x.doc_id, 'size', x.size,
                            'p', {clean_x}))), y ->
        named_struct(
          'c', if(y.c.p > 0 and y.c.p < 1, y.c, if(y.x.p > 0 and y.x.p < 1, y.x, cast(null as {unit}))),
          'done', concat(s.done, filter(array(y.c, y.x), u -> u.p <= 0 or u.p >= 1)))
      )[0])[0])[0])
"""
_UNIT = "struct<mass:double,h:bigint,doc_id:bigint,size:bigint,p:double>"


def _clean(p: str) -> str:
    """Probabilities that rounding left within 1e-9 of 0 or 1 are there."""
    return f"if({p} < 1e-9, 0D, if({p} > 1 - 1e-9, 1D, {p}))"


def _reduce(units: DataFrame, depth: int, seed: int) -> DataFrame:
    """One layer of the tree: every bucket's units are done but for one, which stays open."""
    draw = f"((xxhash64(s.c.h, x.h, {depth}L, {seed}L) & 4503599627370495L) + 0.5D) / 4503599627370496D"
    step = _STEP.format(
        draw=draw, clean_c=_clean("s.c.p + d / s.c.mass"), clean_x=_clean("x.p - d / x.mass"), unit=_UNIT
    )
    unit = F.struct("mass", "h", "doc_id", "size", "p")
    # From the largest mass on, so that what stays open is likely a small one.
    grouped = units.groupBy("sid", "bucket").agg(F.sort_array(F.collect_list(unit), asc=False).alias("units"))
    start = f"named_struct('c', cast(null as {_UNIT}), 'done', cast(array() as array<{_UNIT}>))"
    grouped = grouped.select("sid", F.expr(f"aggregate(units, {start}, {step})").alias("s"))
    out = F.explode(F.when(F.col("s.c").isNull(), F.col("s.done")).otherwise(F.array_append("s.done", F.col("s.c"))))
    return grouped.select("sid", out.alias("u")).select("sid", "u.*")


def rounded(units: DataFrame, most_units: int, fan_in: int = FAN_IN, seed: int = 0) -> DataFrame:
    """Rows (sid, doc_id, size, up) from units (sid, units, doc_id, size, mass, p): `up` is 0 or 1.

    Units of a source are dealt by hash into buckets of about `fan_in`, and what a bucket leaves open meets
    the others' in the next layer, until each source has one open unit, which is drawn by its probability.
    A source with most of the documents has more buckets, not a larger one.
    """
    layers = max(1, math.ceil(math.log(max(2, most_units), fan_in)))
    open_units, finished = units, []
    columns = ["sid", "doc_id", "size", F.col("p").cast("int").alias("up")]
    for depth in range(layers):
        buckets = F.ceil(F.col("units") / float(fan_in ** (depth + 1)))
        h = F.xxhash64("doc_id", "size", F.lit(seed), F.lit(depth))
        placed = open_units.withColumn("h", h).withColumn("bucket", F.pmod("h", buckets))
        layer = write_shared(_reduce(placed, depth, seed), "layer")
        if depth == 0:
            counts = units.select("sid", "units").distinct()
        done = (F.col("p") <= 0) | (F.col("p") >= 1)
        finished.append(layer.where(done).select(*columns))
        open_units = layer.where(~done).drop("h").join(counts, "sid")
    last = F.when(_uniform(F.xxhash64("doc_id", "size", F.lit(seed))) < F.col("p"), 1).otherwise(0)
    out = open_units.select("sid", "doc_id", "size", last.alias("up"))
    for part in finished:
        out = out.unionByName(part)
    return out


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    fan_in: int = FAN_IN,
    seed: int = 0,
) -> DataFrame:
    """All rows of `docs` with `size`, `source_size`, `target` and `copies`, how often the mix takes the row.

    Every document of a source is to be taken target / source_size times: its whole part, and one more for some
    documents, chosen by pivotal rounding of the rest with the size as mass, so a source's words differ from its
    target by at most one document. Draws are hashes of ids, so runs agree. Null texts have size 0; rows of size
    0 add no words and get the whole part. Sources may be null (one source, the last). Rows that repeat doc_id,
    source and size are one unit with all their mass and get the same copies. An empty table gives no rows.
    """
    names = ["size", "source_size", "target", "copies"]
    sized = docs.drop(*names).withColumn("size", text_size(F.col(text)))
    narrow = sized.select(F.col(key).cast("long").alias("doc_id"), F.col(source).alias("source"), "size")
    units = narrow.groupBy("source", "doc_id", "size").agg(F.count("*").alias("rows"))
    units = write_shared(units, "units")
    targets = source_targets(
        units.select("source", (F.col("size") * F.col("rows")).alias("size")), "source", weights, share, most
    )
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rest = ratio - F.floor(ratio)
    # Ratios that are whole but for the last digits are whole.
    whole = F.when(rest > 1 - 1e-9, F.floor(ratio) + 1).otherwise(F.floor(ratio)).cast("long")
    targets = targets.withColumn("whole", whole).withColumn(
        "p", F.when((rest < 1e-9) | (rest > 1 - 1e-9), 0.0).otherwise(rest)
    )
    targets = write_shared(targets, "targets")
    most_units = targets.agg(F.max("units")).first()[0] or 0
    u, t = units.alias("u"), targets.alias("t")
    open_units = (
        u.join(t, F.col("u.source").eqNullSafe(F.col("t.source")))
        .where("u.size > 0 and t.p > 0")
        .select(
            "t.sid",
            "t.units",
            "u.doc_id",
            "u.size",
            (F.col("u.size") * F.col("rows")).cast("double").alias("mass"),
            "t.p",
        )
    )
    ups = rounded(open_units, most_units, fan_in, seed)
    chosen = ups.where("up = 1")
    ups = write_shared(chosen.select("sid", F.col("doc_id").alias("up_id"), F.col("size").alias("up_size")), "ups")
    d = sized.alias("d")
    placed = d.join(t, F.col(f"d.{source}").eqNullSafe(F.col("t.source"))).select(
        "d.*", "t.source_size", "t.target", F.col("t.sid").alias("_sid"), F.col("t.whole").alias("_whole")
    )
    same = (
        (F.col("_sid") == F.col("up.sid"))
        & F.col(key).cast("long").eqNullSafe(F.col("up.up_id"))
        & (F.col("size") == F.col("up.up_size"))
    )
    # The chosen units are a fixed share of all documents, so they are merged at every size and never broadcast.
    joined = placed.alias("p").join(ups.hint("merge").alias("up"), same, "left")
    copies = F.col("_whole") + F.col("up.sid").isNotNull().cast("long")
    return joined.select("p.*", copies.alias("copies")).drop("_sid", "_whole")
