"""Mixing sources to target weights by pivotal dependent rounding.

Sources in code point order, null last, weigh ``WEIGHTS`` in turn and share the words of all documents; no target is above
``LIMIT`` times its source's size, and what is above is shared again by weight. Within a source every document is due the
same number of copies, target over size; its whole part is certain. The fractions are rounded in pairs: mass, counted in
words, moves from one document to the other until one of them is integral, in a direction drawn so that each keeps its
expected number of copies. So the words of a pair never change, and those of a source stay within one document of its
target.

The pairs form a reduction tree. Documents are dealt to leaves of about ``LEAF`` by a hash of their id, each leaf leaves
at most one document undecided, and ``FAN`` leaves at a time are combined, until one document of the source is drawn
alone. All draws are hashes of ids and the level, so reruns agree, however the rows lie.

Rows of equal id, source and size (among them rows without an id) form a unit. Of a unit of n rows the whole part of n times
the fraction is certain, and only what is left of it is rounded, as the fraction of one row; the unit's rows are numbered,
and the first of them get a copy more than the others.

Defined cases. Null and empty texts have size 0 and take 0 words; so does a source without words. A null source is a
source. An empty table gives an empty result. Columns of the input named like a result are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeworks.llm.words import mix
from noticeworks.session import scratch_dir

WEIGHTS = (5, 2, 1)
LIMIT = 3
LEAF = 1000
FAN = 64
SEED = 29
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again, so that later steps start there."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def size_of(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``number``, the place of each row in this order from 0 on: sorted by ranges, which are then counted."""
    ranged = written(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    starts = ranged.groupBy("_range").count()  # as many rows as there are ranges
    before = F.coalesce(F.sum("count").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = starts.select("_range", before.alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return ranged.join(F.broadcast(starts), "_range").withColumn("number", place + F.col("_before")).drop("_range", "_before")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """source, source_size, documents and target, one row for each source."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    order = numbered(totals, F.col("source").isNull(), F.col("source"))
    weight = F.array(*map(F.lit, weights))[(F.col("number") % len(weights)).cast("int")].cast("double")
    weighed = written(order.withColumn("weight", weight).drop("number"), "sources")
    # The level of water in vessels as wide as the weights and as high as the limits: three numbers come back each round.
    level, full = 0.0, -1
    while True:
        above = F.lit(level) * F.col("weight") >= limit * F.col("source_size")
        row = weighed.agg(
            F.sum("source_size").alias("words"),
            F.sum(F.when(above, limit * F.col("source_size"))).alias("held"),
            F.sum(F.when(~above, F.col("weight"))).alias("open"),
            F.count(F.when(above, 1)).alias("full"),
        ).first()
        if row["full"] == full or not row["open"]:
            break
        full = row["full"]
        level = ((row["words"] or 0) - (row["held"] or 0)) / row["open"]
    share = F.least(F.lit(level) * F.col("weight"), (limit * F.col("source_size")).cast("double"))
    return weighed.withColumn("target", share)


def drawn(hashes: np.ndarray, level: int) -> np.ndarray:
    """Numbers from 0 to 1 for ids by their hash, others on each level."""
    return (mix(hashes.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(11)) * 2.0**-53


def round_in_pairs(words: list[int], due: list[float], draws: list[float]) -> tuple[list[float], int | None]:
    """Each fraction rounded to 0.0 or 1.0 but at most one, whose place comes second. Keeps sum(words * due)."""
    due = list(due)
    held = None
    for k in range(len(due)):
        if not 0.0 < due[k] < 1.0:
            continue
        if held is None:
            held = k
            continue
        a, b = held, k
        up_a, up_b = (1 - due[a]) * words[a], due[b] * words[b]
        down_a, down_b = due[a] * words[a], (1 - due[b]) * words[b]
        up, down = min(up_a, up_b), min(down_a, down_b)
        if draws[k] * (up + down) < down:  # a gains what b loses
            new_a = 1.0 if up_a <= up_b else due[a] + up / words[a]
            new_b = 0.0 if up_b <= up_a else due[b] - up / words[b]
        else:
            new_a = 0.0 if down_a <= down_b else due[a] - down / words[a]
            new_b = 1.0 if down_b <= down_a else due[b] + down / words[b]
        due[a], due[b] = new_a, new_b
        held = a if 0.0 < new_a < 1.0 else b if 0.0 < new_b < 1.0 else None
    return due, held


_NODE = "doc_id long, source string, size long, repeats long, whole int, more long, due double, hash long, node long"


def _level(rows: DataFrame, level: int) -> DataFrame:
    """One level of the tree: every node's units are rounded; ``due`` is left between 0 and 1 for at most one."""

    def combined(group: pa.Table) -> pa.Table:
        # Long documents first: the one that is left undecided is then mostly a short one.
        order = [("size", "descending"), ("hash", "ascending"), ("doc_id", "ascending")]
        group = group.take(pc.sort_indices(group, order))
        draws = drawn(group["hash"].to_numpy(), level).tolist()
        due, _ = round_in_pairs(group["size"].to_pylist(), group["due"].to_pylist(), draws)
        return group.set_column(group.column_names.index("due"), "due", pa.array(due, pa.float64()))

    return rows.groupBy("source", "node").applyInArrow(combined, _NODE)


def copies(sizes: DataFrame, shares: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, source, size, repeats (rows of the unit), copies and more: how often the mix takes each of these rows, and
    how many of them it takes once more."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    leaves = F.ceil(F.col("documents") / LEAF)
    # Rows without words need no rounding.
    part = F.when(F.col("size") > 0, F.col("repeats") * (F.col("rate") - F.col("whole"))).otherwise(F.lit(0.0))
    units = (
        sizes.groupBy("doc_id", "source", "size")
        .agg(F.count("*").alias("repeats"))
        .join(shares.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("rate", F.least(rate, F.lit(float(limit))))
        .withColumn("whole", F.floor("rate").cast("int"))
        .withColumn("hash", F.xxhash64(F.lit(SEED), "doc_id", "size"))
        .withColumn("part", part)
        .withColumn("more", F.floor("part"))
        .withColumn("due", F.col("part") - F.col("more"))
        .withColumn("node", F.pmod(F.xxhash64(F.lit(SEED + 1), "hash"), leaves))
        .select("doc_id", "source", "size", "repeats", "whole", "more", "due", "hash", "node")
    )
    undecided = (F.col("due") > 0) & (F.col("due") < 1)
    decided, level = None, 0
    nodes = shares.agg(F.max(F.ceil(F.col("documents") / LEAF))).first()[0] or 1
    rows = units
    while True:
        done = written(_level(rows, level), "mixing-level")
        own = done.where(~undecided)
        decided = own if decided is None else decided.unionByName(own)
        rows, level = done.where(undecided), level + 1
        if nodes <= 1:
            break
        nodes = -(-nodes // FAN)
        rows = rows.withColumn("node", F.floor(F.col("node") / FAN))
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(SEED + 2), "hash"), 11) * F.lit(2.0**-53)
    last = rows.withColumn("due", (chance < F.col("due")).cast("double"))
    more = F.col("more") + F.col("due").cast("long")
    return decided.unionByName(last).select("doc_id", "source", "size", "repeats", F.col("whole").alias("copies"), more.alias("more"))


def plan(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The copies of each document and the target of each source."""
    sizes = written(docs.select("doc_id", "source", size_of(text).alias("size")), "sizes")
    shares = targets(sizes)
    return copies(sizes, shares), shares


def taken_rows(docs: DataFrame, taken: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``_mix_copies``: how often the mix takes each row."""
    names = {"doc_id": "_mix_doc_id", "source": "_mix_source", "size": "_mix_size", "repeats": "_mix_repeats"}
    units = taken.withColumnsRenamed({**names, "copies": "_mix_copies", "more": "_mix_more"})
    sized = docs.withColumn("_mix_own_size", size_of(text))
    same = (
        F.col("doc_id").eqNullSafe(F.col("_mix_doc_id"))
        & F.col("source").eqNullSafe(F.col("_mix_source"))
        & (F.col("_mix_own_size") == F.col("_mix_size"))
    )
    kept = [F.col(f"`{c}`") for c in docs.columns]
    joined = sized.join(units.where("_mix_copies > 0 or _mix_more > 0"), same)
    alone = joined.where("_mix_repeats = 1").select(*kept, (F.col("_mix_copies") + F.col("_mix_more")).alias("_mix_copies"))
    several = units.where("_mix_repeats > 1 and (_mix_copies > 0 or _mix_more > 0)")
    if several.isEmpty():
        return alone
    # Number the rows of units of several rows: over all of them, less the number that its unit starts with.
    order = [F.col("_mix_doc_id"), F.col("_mix_source"), F.col("_mix_size"), F.xxhash64(text), F.col("_mix_row")]
    rows = sized.join(several, same).withColumn("_mix_row", F.monotonically_increasing_id())
    rows = numbered(rows, *order).withColumnRenamed("number", "_mix_number")
    unit = ["_mix_doc_id", "_mix_source", "_mix_size"]
    starts = rows.groupBy(*unit).agg(F.min("_mix_number").alias("_mix_start"))
    starts = starts.withColumnsRenamed({c: f"{c}_of" for c in unit})
    of_unit = F.lit(True)
    for c in unit:
        of_unit = of_unit & F.col(c).eqNullSafe(F.col(f"{c}_of"))
    first = (F.col("_mix_number") - F.col("_mix_start") < F.col("_mix_more")).cast("long")
    numbered_rows = rows.join(starts, of_unit).select(*kept, (F.col("_mix_copies") + first).alias("_mix_copies"))
    return alone.unionByName(numbered_rows)


def mixed(docs: DataFrame, text: str = "text") -> DataFrame:
    """The mix: each row of ``docs`` as often as it is taken."""
    taken, _ = plan(docs, text)
    kept = [F.col(f"`{c}`") for c in docs.columns]
    repeated = F.explode(F.array_repeat(F.lit(1), F.col("_mix_copies").cast("int"))).alias("_mix_copy")
    return taken_rows(docs, written(taken, "mix"), text).where("_mix_copies > 0").select(*kept, repeated).drop("_mix_copy")


def report(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, size, source_size, target and taken, one row for each document."""
    taken, shares = plan(docs, text)
    shares = shares.select(F.col("source").alias("_source"), "source_size", "target")
    # A unit's rows in stretches of LEAF, so that no row holds a list as long as the unit.
    stretch = F.explode(F.sequence(F.lit(0), F.col("repeats") - 1, F.lit(LEAF))).alias("_start")
    numbers = F.explode(F.sequence(F.col("_start"), F.least(F.col("_start") + LEAF, F.col("repeats")) - 1)).alias("_number")
    rows = taken.select("*", stretch).select("*", numbers)
    number = F.col("copies") + (F.col("_number") < F.col("more")).cast("long")
    return rows.join(shares, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * number).alias("taken")
    )
