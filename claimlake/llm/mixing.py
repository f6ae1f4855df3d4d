r"""Operator 7: mixing sources to target weights by pivotal dependent rounding.

Sizes are words. Sources in code-point order (null last) weigh 5, 2, 1,
repeating, and share SHARE of all sizes; no target exceeds CAP times its
source's size, and the excess is shared again by weight. With caps c and weights
w the result is min(c, L w) for the level L at which targets sum to the whole;
L is found from running sums over sources sorted by c / w.

Every document should be copied target / source size times: the whole copies are
taken, and the fractional ones are rounded by the pivotal method: two documents
trade probability so that the words expected from the pair stay the same, by
chance in one direction or the other (with the odds that keep both expectations),
until one of them becomes 0 or 1; the other goes on. This runs as a reduction
tree: groups of about FAN documents of a source are folded with one ``aggregate``
each, their residuals are grouped again, and so on to one residual a source.

Since a residual may be a long document, documents are decided in BANDS of
falling size, and what a band took more or less than planned is made up by the
next, smaller one. Chance comes from hashes of ids, so reruns agree.

Equal rows (doc_id, text and source) are counted before anything moves and are one
item with that many times the copies, so a text that a third of the rows repeat is
no hot group. Its copies are dealt evenly over its rows.

Only DataFrame functions are used: no Python runs on the executors. The table of
targets has a row for each source; where the sources are at most MOST_SOURCES it is
broadcast, so a source with a third of the rows is no hot key of a join; beyond that
Spark joins by source and splits skewed partitions.

Defined cases: null text has size 0 and takes 0; a source of size 0 has target
0; null is a source of its own; null doc_id is a value like others; ties in size go
by hash; very long texts are single items; an empty table gives none; other columns
are ignored in ``mix`` and kept in ``mix_stage``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

WEIGHTS, SHARE, CAP = (5, 2, 1), 1.5, 2.0
#: Documents folded at a time, and the least sizes of the bands.
FAN, BANDS = 48, (2048, 256, 48, 0)
#: Sources up to which their plan is broadcast (under 100 bytes each), and rows made from one row at a time.
MOST_SOURCES, MADE = 20_000, 4096
SEED = 17


def size_of(text):
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target, one row for each source, from rows (source, size, times)."""
    by = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))  # over sources, not rows
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((rank - 1) % len(WEIGHTS) + 1).cast("int")).cast("double")
    by = by.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * F.lit(CAP))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rising = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    total = F.sum("source_size").over(everything) * F.lit(SHARE)
    # Were all sources before this one capped, the rest would share what is left at this level.
    before = F.coalesce(F.sum("_cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("_w").over(rising.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    by = by.withColumn("_level", (total - before) / rest)
    level = F.max(F.when(F.col("_level") <= F.col("_cap") / F.col("_w") + F.col("_cap") * 1e-15, F.col("_level"))).over(everything)
    target = F.least(F.col("_cap"), F.coalesce(level * F.col("_w"), F.col("_cap")))
    return by.select("source", "source_size", target.alias("target"))


def _chance(*parts):
    """Uniform in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*parts, F.lit(SEED)), F.lit(1 << 52)).cast("double") / float(1 << 52)


def _step(state, item):
    """One pivotal trade between the carried residual and the next document."""
    a, b = state["carry"], item
    sa, sb, pa, pb = a["size"], b["size"], a["p"], b["p"]
    up = F.least((1 - pa) * sa, pb * sb)  # words that may go from b to a
    down = F.least(pa * sa, (1 - pb) * sb)
    rise = F.xxhash64(a["h"], b["h"], F.lit(SEED))
    take_up = F.pmod(rise, F.lit(1 << 52)).cast("double") / float(1 << 52) * (up + down) < down
    words = F.when(take_up, up).otherwise(-down)
    na, nb = pa + words / sa, pb - words / sb
    # The side whose bound was met is exactly 0 or 1.
    a_ends = F.when(take_up, (1 - pa) * sa <= pb * sb).otherwise(pa * sa <= (1 - pb) * sb)
    done_p = F.when(a_ends, F.when(take_up, 1.0).otherwise(0.0)).otherwise(F.when(take_up, 0.0).otherwise(1.0))
    carry_p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.when(a_ends, nb).otherwise(na)))
    done, carry = F.when(a_ends, a).otherwise(b), F.when(a_ends, b).otherwise(a)
    return F.struct(carry.withField("p", carry_p).alias("carry"), F.concat(state["done"], F.array(done.withField("p", done_p))).alias("done"))


FIELDS = ("size", "h", "doc_id", "times", "whole", "p")


def _fold(rows: DataFrame, groups, level: int) -> DataFrame:
    """Fold each group of documents of a source: all but one become integral."""
    bucket = F.pmod(F.xxhash64("h", F.lit(level)), groups)
    item = F.struct(*FIELDS)
    grouped = rows.groupBy("source", "source_size", "target", bucket.alias("_g")).agg(F.sort_array(F.collect_list(item), asc=False).alias("_items"))
    first = F.col("_items")[0]
    start = F.struct(first.alias("carry"), F.slice("_items", 1, 0).alias("done"))
    folded = grouped.select("source", "source_size", "target", F.aggregate(F.slice("_items", 2, F.size("_items")), start, _step).alias("_s"))
    pieces = F.concat(F.transform(F.col("_s.done"), lambda x: F.struct(x.alias("x"), F.lit(True).alias("done"))), F.array(F.struct(F.col("_s.carry").alias("x"), F.lit(False).alias("done"))))
    return folded.select("source", "source_size", "target", F.explode(pieces).alias("_e")).select("source", "source_size", "target", *(F.col(f"_e.x.{f}").alias(f) for f in FIELDS), F.col("_e.done").alias("_done"))


def round_copies(rows: DataFrame, work: common.Workspace) -> DataFrame:
    """Adds ``copies`` (of all its equal rows) to rows (source, source_size, target, size, h, doc_id, times)."""
    spark, decided = rows.sparkSession, []
    keep = ("source", "source_size", "target", "size", "h", "doc_id", "times", "copies")
    rows = rows.withColumn("_band", sum((F.col("size") < b).cast("int") for b in BANDS[:-1]))
    sizes = rows.groupBy("source", "_band").agg(F.sum(F.col("size") * F.col("times")).alias("_size"), F.count(F.lit(1)).alias("_rows"))
    sizes = work.save(sizes, "bands")  # sources x bands rows
    small = _small(sizes.select("source").distinct())
    most = sizes.groupBy("_band").agg(F.max("_rows").alias("n")).collect()
    for band, n in sorted((r["_band"], r["n"]) for r in most):
        left = sizes.where(F.col("_band") >= band).groupBy("source").agg(F.sum("_size").alias("_left"), F.max(F.when(F.col("_band") == band, F.col("_rows"))).alias("_n"))
        taken = None
        for d in decided:
            part = d.select("source", (F.col("copies") * F.col("size")).alias("_took"))
            taken = part if taken is None else taken.unionByName(part)
        plan = left
        if taken is not None:
            taken = taken.groupBy("source").agg(F.sum("_took").alias("_took"))
            plan = left.join(taken.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
        plan = plan.withColumn("_took", F.coalesce(F.col("_took"), F.lit(0)) if taken is not None else F.lit(0)).withColumnRenamed("source", "_s")
        mine = rows.where(F.col("_band") == band).join(small(plan), F.col("source").eqNullSafe(F.col("_s")))
        share = F.least(F.lit(CAP), F.greatest(F.lit(0.0), (F.col("target") - F.col("_took")) / F.col("_left")))
        mine = mine.withColumn("_share", F.when(F.col("_left") > 0, share).otherwise(0.0))
        mine = mine.withColumn("_share", F.col("_share") * F.col("times"))
        mine = mine.withColumn("whole", F.floor("_share").cast("long")).withColumn("p", F.col("_share") - F.col("whole"))
        groups, level = F.greatest(F.lit(1), F.ceil(F.col("_n") / FAN)), 0
        while True:
            step = work.save(_fold(mine.withColumn("_g2", groups), F.col("_g2"), level), f"band{band}_{level}")
            decided.append(step.where("_done").withColumn("copies", F.col("whole") + F.round("p").cast("long")).select(*keep))
            rest = step.where("NOT _done")
            n = -(-n // FAN)
            if n <= 1:
                break
            mine, level = rest, level + 1
            groups = F.lit(max(1, -(-n // FAN)))
        last = rest.withColumn("copies", F.col("whole") + (_chance("h", F.lit(band)) < F.col("p")).cast("long"))
        decided.append(last.select(*keep))
    if not decided:
        return spark.createDataFrame([], "source string, source_size long, target double, size long, h long, doc_id long, times long, copies long")
    out = decided[0]
    for d in decided[1:]:
        out = out.unionByName(d)
    return out


def _small(sources: DataFrame):
    """A function that marks a table with a row for each source for broadcast where its size is proven small."""
    return F.broadcast if sources.limit(MOST_SOURCES + 1).count() <= MOST_SOURCES else (lambda df: df)


def _sized(docs: DataFrame, key) -> DataFrame:
    """A row for each doc_id, source and text with its number of equal rows."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size_of("text").alias("size"), key.alias("h"))
    return rows.groupBy("doc_id", "source", "size", "h").agg(F.count(F.lit(1)).alias("times"))


def plan_copies(docs: DataFrame, key, work: common.Workspace) -> DataFrame:
    """source, source_size, target, size, h, doc_id, times, copies for each different row."""
    sized = work.save(_sized(docs, key), "sized")
    targets = work.save(source_targets(sized), "targets").withColumnRenamed("source", "_s")
    rows = sized.join(_small(targets.select("_s"))(targets), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    some = round_copies(rows.where("size > 0"), work)
    none = rows.where("size <= 0").withColumn("copies", F.lit(0).cast("long")).select(*some.columns)
    return some.unionByName(none)


def _each(rows: DataFrame, times: str, number: str) -> DataFrame:
    """Each row ``times`` times, numbered from 0: long runs are dealt out in parts of MADE."""
    part = f"{number}_part"
    one = rows.where(F.col(times) == 1).withColumn(number, F.lit(0).cast("long"))
    parts = rows.where(F.col(times) > 1).withColumn(part, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / MADE))))
    here = F.least(F.col(times) - F.col(part) * MADE, F.lit(MADE))
    return one.unionByName(parts.withColumn(number, F.explode(F.sequence(F.col(part) * MADE, F.col(part) * MADE + here - 1))).drop(part))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, source of every row."""
    work = common.Workspace(docs.sparkSession, "mixing")
    plan = work.save(plan_copies(docs, F.xxhash64("doc_id", "text"), work), "plan")
    rows = _each(plan, "times", "_n")
    copies = F.floor(F.col("copies") / F.col("times")) + (F.col("_n") < F.col("copies") % F.col("times")).cast("long")
    return rows.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).cast("long").alias("taken"), "source")


def mix_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: each row as many times as the mix takes it; rows without words go, as they take nothing.

    Rows with the same doc_id, text and source are one item. Where its rows differ in other columns, its copies are
    dealt over those variants in proportion to their rows, by running sums.
    """
    work = common.Workspace(spark, "mix_stage")
    key = F.xxhash64("doc_id", "text", "source")
    h, k, copies, times, rows_, until, before, number = common.unused(docs, "_h", "_k", "_copies", "_times", "_rows", "_until", "_before", "_number")
    plan = plan_copies(docs, key, work).where("copies > 0").groupBy("h").agg(F.sum("copies").alias(copies), F.sum("times").alias(times)).withColumnRenamed("h", k)
    plan = work.save(plan, "plan")
    held = docs.withColumn(h, key)
    columns = common.columns(docs)
    # The plan grows with the documents, so it is joined by key at every size.
    alone = held.join(plan.where(F.col(times) == 1).hint("merge"), F.col(h) == F.col(k))
    out = alone.withColumn(number, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(*columns)
    repeated = plan.where(F.col(times) > 1)
    if repeated.limit(1).count():
        variants = held.join(repeated, F.col(h) == F.col(k), "left_semi").groupBy(h, *columns).agg(F.count(F.lit(1)).alias(rows_))
        order = Window.partitionBy(h).orderBy(F.xxhash64(*columns), *columns)
        summed = variants.withColumn(until, F.sum(rows_).over(order.rowsBetween(Window.unboundedPreceding, 0))).join(repeated, F.col(h) == F.col(k))
        upto = lambda c: F.floor(F.col(copies) * c / F.col(times))
        mine = summed.withColumn(before, upto(F.col(until)) - upto(F.col(until) - F.col(rows_))).where(F.col(before) > 0)
        out = out.unionByName(_each(mine, before, number).select(*columns))
    return out
