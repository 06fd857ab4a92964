"""Source divergence audit by ranking count cells.

How much do the sources of a language differ in their terms? Each language keeps the terms that stand in at least
``MIN_DOCUMENTS`` of its documents. A group (language and source) and the language as a whole give each kept term a
smoothed share ``p`` of ``UNIT``; ``f = floor((p - q)^2 / q)`` compares two shares, all in whole numbers.

Shares depend on counts alone, so terms are first put in cells of equal counts. For a group against its language a cell
is (count in the group, count in the language) with the number of its terms. f is evaluated per cell, cells of equal f are
merged, the merged cells are ranked by the terms above them, and only those that reach the first ``TERMS`` ranks are
expanded to terms, in UTF-8 order among equals. For two groups the terms with equal counts in all sources of the language
are merged first; a cell is (count here, count there), and the cells with a zero follow from the cells of each group alone:

    sum f = sum over common cells of n (f(a,b) - f(a,0) - f(0,b) + f(0,0))
          + sum over cells of one group (f(a,0) - f(0,0)) + sum over the other's (f(0,b) - f(0,0)) + V f(0,0)

so a term costs as many pairs as it has sources, squared, and the sources that lack it cost nothing.

Words are counted in bounded tables inside the tasks that read the texts, so a frequent word leaves each of them a few times.

Defined cases. Null text, language and source count as ''. A text without a term still makes its group. Repeated rows are
documents of their own. A language without a kept term has value 0 for all pairs and no terms; a group alone in its
language has no pairs. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeworks.llm.mixing import written
from noticeworks.llm.words import slices

UNIT = 1_000_000_000
MIN_DOCUMENTS = 3
TERMS = 200
#: Entries that a task holds before it hands its counts on.
HELD = 400_000
#: Letters and all bytes of other characters than ASCII make terms; A-Z are lower-cased.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COUNTED = "lang string, source string, term string, n long, docs long"


def term_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """lang, source, term, occurrences and documents, counted within tasks: a term may come several times."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        unseen = 0

        def flush() -> pa.RecordBatch:
            langs, sources, terms, found, docs_ = [], [], [], [], []
            for (lang, source), (occurrences, documents) in held.items():
                langs += [lang] * len(occurrences)
                sources += [source] * len(occurrences)
                terms += [x.decode() for x in occurrences]
                found += occurrences.values()
                docs_ += map(documents.__getitem__, occurrences)
            arrays = [pa.array(x, pa.string()) for x in (langs, sources, terms)]
            arrays += [pa.array(x, pa.int64()) for x in (found, docs_)]
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, ["lang", "source", "term", "n", "docs"])

        for batch in slices(batches, 64):
            for lang, source, value in zip(*[column.to_pylist() for column in batch.columns]):
                occurrences, documents = held.setdefault((lang or "", source or ""), (Counter(), Counter()))
                terms = (value or "").encode().translate(_LETTERS).split()
                before = len(occurrences)
                occurrences.update(terms)
                documents.update(set(terms))
                unseen += len(occurrences) - before
                if unseen >= HELD:
                    yield flush()
                    unseen = 0
        if held:
            yield flush()

    return docs.select("lang", "source", text).mapInArrow(rows_of, _COUNTED)


def share(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(UNIT * (n + 1) / (total + terms))``; beyond 64 bits in decimals."""
    narrow = _divided(F.lit(UNIT).cast("long") * (n + 1), total + terms)
    wide = _divided(F.lit(UNIT).cast("decimal(10,0)") * (n + 1).cast("decimal(19,0)"), (total + terms).cast("decimal(20,0)"))
    return F.when(n < 2**63 // UNIT - 1, narrow).otherwise(wide) + 1


def _divided(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def distance(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / q)`` of two shares, which are at most UNIT + 1."""
    return _divided((p - q) * (p - q), q)


def kept_terms(counted: DataFrame) -> DataFrame:
    """lang, term, lang_n (occurrences in the language) and places (array of source and n) of the terms that are kept.

    An array has at most one entry for each source of the language; the result has a row for each pair of sources.
    """
    # One exchange serves both aggregations.
    at_term = counted.repartition("lang", "term")
    by_source = at_term.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return (
        by_source.groupBy("lang", "term")
        .agg(
            F.sum("n").alias("lang_n"),
            F.sum("docs").alias("docs"),
            F.array_sort(F.collect_list(F.struct("source", "n"))).alias("places"),
        )
        .where(F.col("docs") >= MIN_DOCUMENTS)
        .drop("docs")
    )


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, total (occurrences of kept terms), lang_total and terms (V), one row for each group that occurs."""
    groups = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    own = kept.select("lang", F.explode("places").alias("at")).groupBy("lang", F.col("at.source").alias("source"))
    of_lang = kept.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("terms"))
    found = groups.join(own.agg(F.sum("at.n").alias("total")), ["lang", "source"], "left").join(of_lang, "lang", "left")
    return found.na.fill(0, ["total", "lang_total", "terms"])


def pair_values(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, source, item (another source of the language) and value."""
    here = totals.select("lang", "source", "total", "terms")
    there = totals.select("lang", F.col("source").alias("item"), F.col("total").alias("item_total"))
    n, m, terms = F.col("n"), F.col("m"), F.col("terms")
    p, q = share(n, F.col("total"), terms), share(m, F.col("item_total"), terms)
    p0, q0, none = F.col("p0"), F.col("q0"), F.col("none")
    zero = F.lit(0).cast("long")
    pairs = (
        here.join(there, "lang")
        .where("source <> item")
        .withColumn("p0", F.when(terms > 0, share(zero, F.col("total"), terms)))
        .withColumn("q0", F.when(terms > 0, share(zero, F.col("item_total"), terms)))
        .withColumn("none", distance(p0, q0))
    )

    # Terms with the same counts everywhere first, then cells of two sources, the smaller name first.
    alike = kept.groupBy("lang", "places").agg(F.count("*").alias("times"))
    first = alike.select("lang", "times", "places", F.posexplode("places").alias("at", "a"))
    behind = F.explode(F.slice("places", F.col("at") + 2, F.size("places"))).alias("b")
    two = first.select("lang", "times", "a", behind)
    cells = (
        two.groupBy("lang", F.col("a.source").alias("s"), F.col("b.source").alias("t"), F.col("a.n").alias("n"), F.col("b.n").alias("m"))
        .agg(F.sum("times").alias("times"))
    )
    common = cells.select(
        "lang",
        "times",
        F.inline(
            F.array(
                F.struct(F.col("s").alias("source"), F.col("t").alias("item"), n.alias("n"), m.alias("m")),
                F.struct(F.col("t").alias("source"), F.col("s").alias("item"), m.alias("n"), n.alias("m")),
            )
        ),
    )
    own = (
        kept.select("lang", F.explode("places").alias("at"))
        .groupBy("lang", F.col("at.source").alias("source"), F.col("at.n").alias("n"))
        .agg(F.count("*").alias("times"))
    )
    keys = ["lang", "source", "item"]
    wide = F.col("times").cast("decimal(20,0)")
    parts = [
        common.join(pairs, keys).select(
            *keys, (wide * (distance(p, q) - distance(p, q0) - distance(p0, q) + none)).alias("value")
        ),
        own.join(pairs, ["lang", "source"]).select(*keys, (wide * (distance(p, q0) - none)).alias("value")),
        own.select("lang", F.col("source").alias("item"), F.col("n").alias("m"), "times")
        .join(pairs, ["lang", "item"])
        .select(*keys, (wide * (distance(p0, q) - none)).alias("value")),
        pairs.select(*keys, (terms.cast("decimal(20,0)") * none).alias("value")),
    ]
    summed = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return summed.groupBy(*keys).agg(F.coalesce(F.sum("value"), F.lit(0)).cast("long").alias("value"))


def term_values(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, source, item (a term that the group uses more than its language) and value: the first ``TERMS`` of each group."""
    group, by_value = ["lang", "source"], F.col("value").desc()
    placed = kept.select("lang", F.col("term").alias("item"), "lang_n", F.inline("places"))
    p, q = share(F.col("n"), F.col("total"), F.col("terms")), share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    cells = (
        placed.groupBy(*group, "n", "lang_n")
        .agg(F.count("*").alias("times"))
        .join(totals, group)
        .where(p > q)
        .withColumn("value", distance(p, q))
    )
    # Every merged cell holds a term, so the first TERMS values hold the first TERMS ranks.
    merged = cells.groupBy(*group, "value").agg(F.sum("times").alias("times"))
    first = merged.withColumn("place", F.row_number().over(Window.partitionBy(*group).orderBy(by_value))).where(
        F.col("place") <= TERMS
    )
    above = F.sum("times").over(Window.partitionBy(*group).orderBy(by_value).rowsBetween(Window.unboundedPreceding, -1))
    reached = first.withColumn("above", F.coalesce(above, F.lit(0))).where(F.col("above") < TERMS)
    least = reached.groupBy(*group).agg(F.min("value").alias("least"))
    wanted = cells.join(least, group).where("value >= least").select(*group, "n", "lang_n", "value")
    order = Window.partitionBy(*group).orderBy(by_value, F.col("item"))
    expanded = placed.join(wanted, [*group, "n", "lang_n"]).select(*group, "item", "value")
    return expanded.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TERMS)


def audit(docs: DataFrame, text: str = "text") -> DataFrame:
    """lang, source, part (pair or term), item, value and rank: the sources that differ most from each source, and the
    terms that set it apart from its language."""
    kept = written(kept_terms(term_counts(docs, text)), "kept-terms")
    totals = written(group_totals(docs, kept), "group-totals")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    pairs = pair_values(kept, totals).withColumn("rank", F.row_number().over(order))
    names = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("part", F.lit("pair")).select(names)
        .unionByName(term_values(kept, totals).withColumn("part", F.lit("term")).select(names))
    )
