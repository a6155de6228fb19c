"""Mixing sources to target weights by entropy balancing.

The mix takes ``copies`` of every document, so that the words taken from each
source meet the source's target. The rates are those closest to one copy each
(in relative entropy, at most ``cap``) that meet the targets:

    rate = min(cap, exp(lambda_source * size / mean))

The multipliers maximise the convex dual, one per source. Newton's iterations
run on Spark: rates depend on a document's source and size only, so each
iteration sums over the (source, size) histogram, grouped by source, and keeps
a bracket to fall back on. Nothing of it is collected but whether a source has
not met its target.

Rounding into copies is systematic: along the sizes of a source, largest first,
every class of equal size gets the whole number of copies that keeps the
running count within one half of the running rate. Inside a class the extra
copies go to the documents whose id hashes lowest. Then a few corrections add
or take one copy of the size nearest to what the source is still off.

Everything is DataFrame functions. Groups of any size stay split: per-document
ranks are counted per (source, size, salt) and shifted by the counts of the
lower salts.

Defined cases: a null text has size 0; a null source is a source of its own,
last in order; documents of size 0 are taken once and add nothing; repeated
doc_ids are separate rows; an empty table gives an empty mix; columns other than
doc_id, source and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketbars.llm.common import stage

WORDS = r"[^\x20\x09-\x0D]+"
CYCLE = (3, 1, 2)       # weights by the source's place, repeating
SHARE = 1.5             # words of the mix per word of all documents
CAP = 2.0               # most copies of a document
SALTS = 256
TOLERANCE = 0.25        # words
MAX_STEPS = 80
CORRECTIONS = 4


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, cycle=CYCLE, share: float = SHARE,
                   cap: float = CAP) -> DataFrame:
    """(source, source_size, target): weights repeat along the sources by code
    point, null last; a target stops at ``cap`` times its source, and what is
    over goes to the others by weight until none is above.

    The resharing ends at the level t with sum(min(cap * size, weight * t)) =
    share * total; the sources in order of cap * size / weight are full up to
    the last whose own level would not use up the total.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())    # one row per source
    weights = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]),
                           (F.pmod(F.row_number().over(order) - 1, F.lit(len(cycle))) + 1)
                           .cast("int"))
    full = F.col("source_size") * F.lit(cap)
    by_level = Window.orderBy("level", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    table = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
             .withColumn("w", weights)
             .withColumn("full", full)
             .withColumn("level", F.col("full") / F.col("w"))
             .withColumn("total", F.sum("source_size").over(everything) * F.lit(share))
             .withColumn("filled", F.sum("full").over(by_level))
             .withColumn("rest", F.sum("w").over(everything) - F.sum("w").over(by_level))
             .withColumn("is_full", F.col("filled") + F.col("level") * F.col("rest")
                         <= F.col("total")))
    open_w = F.sum(F.when(~F.col("is_full"), F.col("w"))).over(everything)
    spent = F.coalesce(F.sum(F.when(F.col("is_full"), F.col("full"))).over(everything),
                       F.lit(0.0))
    return (table
            .withColumn("t", (F.col("total") - spent) / open_w)
            .select("source", "source_size",
                    F.when(F.col("is_full"), F.col("full"))
                    .otherwise(F.least(F.col("full"), F.col("w") * F.col("t")))
                    .alias("target")))


def solve_rates(histogram: DataFrame, targets: DataFrame, cap: float = CAP) -> DataFrame:
    """(source, lam, mean): Newton's iterations on the dual, one multiplier per
    source; ``lam`` is null where the target takes every document ``cap`` times."""
    shape = histogram.groupBy("source").agg(
        (F.sum(F.col("n").cast("double") * F.col("size") * F.col("size"))
         / F.sum(F.col("n") * F.col("size"))).alias("mean"),
        F.min("size").alias("least"), F.max("size").alias("most"))
    ratio = F.log(F.col("target") / F.col("source_size"))
    state = (targets.alias("t").where("source_size > 0 and target > 0")
             .join(shape.alias("s"), F.expr("t.source <=> s.source"))
             .select("t.source", "target", "mean",
                     (F.col("target") >= F.lit(cap) * F.col("source_size")).alias("full"),
                     F.when(ratio < 0, ratio * F.col("mean") / F.col("least"))
                     .otherwise(ratio * F.col("mean") / F.col("most")).alias("lo"),
                     F.when(ratio < 0, ratio)
                     .otherwise(F.lit(cap) * F.col("mean") / F.col("least")).alias("hi"))
             .withColumn("lam", F.when(F.col("full"), F.lit(None).cast("double"))
                         .when(F.col("hi") < 0, F.col("hi")).otherwise(F.col("lo")))
             .withColumn("done", F.col("full")))
    # small tables written out: their known size lets joins broadcast them from the start,
    # and every step is planned on its own
    state = stage(state, "mix-rates")
    carried = ["source", "target", "mean", "full", "lo", "hi", "lam"]
    for _ in range(MAX_STEPS):
        if state.where("not done").isEmpty():
            break
        x = F.col("h.size") / F.col("s.mean")
        tilt = F.exp(F.least(F.col("s.lam") * x, F.lit(50.0)))
        words = F.col("h.n") * F.col("h.size")
        sums = (state.alias("s").where("not done")
                .join(histogram.alias("h"), F.expr("s.source <=> h.source"))
                .groupBy(*[F.col(f"s.{c}") for c in carried])
                .agg(F.sum(words * F.least(F.lit(cap), tilt)).alias("f"),
                     F.sum(F.when(tilt < cap, words * tilt * x).otherwise(F.lit(0.0)))
                     .alias("slope")))
        off = F.col("f") - F.col("target")
        newton = F.col("lam") - F.try_divide(off, F.col("slope"))
        moved = (F.when((newton > F.col("lo2")) & (newton < F.col("hi2")), newton)
                 .otherwise((F.col("lo2") + F.col("hi2")) / 2))
        met = (F.abs(off) <= TOLERANCE) | (F.col("hi2") <= F.col("lo2"))
        tried = (sums.withColumn("lo2", F.when(off < 0, F.col("lam")).otherwise(F.col("lo")))
                 .withColumn("hi2", F.when(off > 0, F.col("lam")).otherwise(F.col("hi")))
                 .withColumn("met", met)
                 .select("source", "target", "mean", "full", F.col("lo2").alias("lo"),
                         F.col("hi2").alias("hi"),
                         F.when(F.col("met"), F.col("lam")).otherwise(moved).alias("lam"),
                         F.col("met").alias("done")))
        state = stage(state.where("done").unionByName(tried), "mix-rates")
    return state.select("source", "lam", "mean")


def class_copies(histogram: DataFrame, targets: DataFrame, rates: DataFrame,
                 cap: float = CAP) -> DataFrame:
    """(source, size, n, copies): whole copies of every class of equal size."""
    tilt = F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(50.0)))
    along = (Window.partitionBy("source").orderBy(F.col("size").desc())
             .rowsBetween(Window.unboundedPreceding, 0))
    rated = (histogram.alias("h")
             .join(targets.alias("t"), F.expr("h.source <=> t.source"))
             .join(rates.alias("r"), F.expr("h.source <=> r.source"), "left")
             .select("h.source", "h.size", "h.n", "t.target",
                     F.when(F.col("t.target") <= 0, F.lit(0.0))
                     .when(F.col("lam").isNull(), F.lit(cap))
                     .otherwise(F.least(F.lit(cap), tilt)).alias("rate"))
             .withColumn("upto", F.sum(F.col("n") * F.col("rate")).over(along))
             .withColumn("whole", F.floor(F.col("upto") + F.lit(0.5)))
             .withColumn("before", F.floor(F.col("upto") - F.col("n") * F.col("rate")
                                           + F.lit(0.5)))
             .select("source", "size", "n", "target",
                     F.greatest(F.lit(0), F.least((F.col("n") * F.lit(cap)).cast("long"),
                                                  F.col("whole") - F.col("before")))
                     .cast("long").alias("copies")))
    # all corrections in one job: they need a source's classes only
    own = Window.partitionBy("source")
    for _ in range(CORRECTIONS):
        off = F.col("off")
        room = F.when(off > 0, F.col("copies") < F.col("n") * F.lit(cap)).otherwise(F.col("copies") > 0)
        gap = F.abs(F.abs(off) - F.col("size"))
        choice = F.when(room & (gap < F.abs(off)), F.struct(
            gap.alias("gap"), F.col("size").alias("size"), F.signum(off).cast("long").alias("step")))
        rated = (rated.withColumn("off", F.max("target").over(own)
                                  - F.sum(F.col("copies") * F.col("size")).over(own))
                 .withColumn("m", F.min(choice).over(own))
                 .select("source", "size", "n", "target",
                         (F.col("copies") + F.when(F.col("size") == F.col("m.size"), F.col("m.step"))
                          .otherwise(F.lit(0))).alias("copies")))
    rated = stage(rated, "mix-classes")
    return rated.select("source", "size", "n", "copies")


def mix_sources(docs: DataFrame, cycle=CYCLE, share: float = SHARE,
                cap: float = CAP) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    sizes = stage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")),
                  "mix-sizes")
    targets = stage(source_targets(sizes, cycle, share, cap), "mix-targets")
    histogram = stage(sizes.where("size > 0").groupBy("source", "size")
                      .agg(F.count(F.lit(1)).alias("n")), "mix-histogram")
    classes = class_copies(histogram, targets, solve_rates(histogram, targets, cap), cap)

    h = F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1)), F.col("doc_id").isNull())
    salted = sizes.withColumn("h", h).withColumn("salt", F.pmod("h", F.lit(SALTS)))
    key = ["source", "size"]
    # how many documents of the class have a lower salt, for classes that split
    split = classes.withColumn("extra", F.col("copies") % F.col("n")).where("extra > 0")
    lower = (salted.groupBy(*key, "salt").agg(F.count(F.lit(1)).alias("m"))
             .withColumn("lower", F.sum("m").over(
                 Window.partitionBy(*key).orderBy("salt")
                 .rowsBetween(Window.unboundedPreceding, 0)) - F.col("m")))
    offsets = (lower.alias("l")
               .join(split.alias("c"), F.expr("l.source <=> c.source and l.size = c.size"),
                     "left_semi")
               .select("l.source", "l.size", "l.salt", "l.lower"))
    place = Window.partitionBy(*key, "salt").orderBy("h", F.col("doc_id").asc_nulls_last())
    ranked = salted.withColumn("place", F.row_number().over(place))
    base = F.floor(F.col("c.copies") / F.col("c.n"))
    more = (F.col("o.lower") + F.col("d.place")
            <= F.col("c.copies") - base * F.col("c.n")).cast("long")
    copies = (F.when(F.col("d.size") == 0, F.lit(1))
              .otherwise(base + F.coalesce(more, F.lit(0)))).cast("long")
    return (ranked.alias("d")
            .join(classes.alias("c"), F.expr("d.source <=> c.source and d.size = c.size"), "left")
            .join(offsets.alias("o"), F.expr("d.source <=> o.source and d.size = o.size "
                                             "and d.salt = o.salt"), "left")
            .join(targets.alias("t"), F.expr("d.source <=> t.source"), "left")
            .select("d.doc_id", "d.source", "d.size",
                    F.col("t.source_size").alias("source_size"), F.col("t.target"),
                    copies.alias("copies"))
            .withColumn("taken", F.col("copies") * F.col("size")))


def mixed_documents(docs: DataFrame, cycle=CYCLE, share: float = SHARE,
                    cap: float = CAP) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it.

    Rows meet their copies by (doc_id, source, size); repeated rows that differ
    in copies are matched by their place among equals.
    """
    plan = mix_sources(docs, cycle, share, cap)
    totals = (plan.groupBy("doc_id", "source", "size")
              .agg(F.sum("copies").alias("total"), F.count(F.lit(1)).alias("rows")))
    found = (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         "doc_id", "source", word_count(F.col("text")).alias("size"),
                         F.xxhash64("text").alias("text_hash")).alias("d")
             .join(totals.alias("k"), F.expr("d.doc_id <=> k.doc_id and d.source <=> k.source "
                                             "and d.size = k.size"))
             .select("d.*", "k.total", "k.rows"))
    place = Window.partitionBy("doc_id", "source", "size").orderBy("text_hash")
    once = found.where("rows = 1").select("row", F.col("total").alias("times"))
    again = (found.where("rows > 1").withColumn("place", F.row_number().over(place))
             .select("row", (F.floor(F.col("total") / F.col("rows"))
                             + (F.col("place") <= F.col("total") % F.col("rows")).cast("long"))
                     .alias("times")))
    return (once.unionByName(again).where("times > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
            .select("row.*"))
