"""Matching award criteria to a model taxonomy."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from noticeworks import fixed_values as V
from noticeworks.functions import text
from noticeworks.functions.json_text import strict
from noticeworks.operators.ranking import keep_first
from noticeworks.session import remove, scratch_dir

# Up to MAX_ENTRIES and MAX_BYTES a taxonomy is scored inside each row. Beyond, both sides are shuffled.
MAX_ENTRIES = 10_000
MAX_BYTES = 4 * 1024 * 1024


def measured_entries(taxonomy: DataFrame, content: str) -> int | None:
    """Number of entries of a taxonomy, or None if it exceeds either bound."""
    size = taxonomy.limit(MAX_ENTRIES + 1).agg(
        F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(content)), F.lit(0)).alias("bytes")
    )
    row = size.first()
    return row["n"] if row["n"] <= MAX_ENTRIES and row["bytes"] <= MAX_BYTES else None


def model_criteria_of_groups(criteria: DataFrame, groups: list[int]) -> DataFrame:
    """(id, text) of the criteria tied to a product group.

    A repeated id keeps its last text; at equal places in several documents the largest text.
    """
    tied = criteria.where(F.exists("groups", lambda g: g.isin(groups)))
    return tied.groupBy("id").agg(F.max(F.struct("pos", "text")).alias("_last")).select("id", F.col("_last.text").alias("text"))


def taxonomy_text(taxonomy: DataFrame, key: str, content: str) -> Column:
    """A whole taxonomy as one text, ``key: content`` per line in key order; it goes into every prompt."""
    line = text.joined(F.col(key), ": ", F.col(content))
    ordered = F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), line.alias("line"))))
    return taxonomy.agg(F.array_join(F.transform(ordered, lambda e: e["line"]), "\n")).scalar()


def taxonomy_literal(taxonomy: dict[str, str]) -> Column:
    return F.lit("\n".join(f"{key}: {content}" for key, content in taxonomy.items()))


INSTRUCTION = (
    "Decide which model criterion, if any, the contract criterion below corresponds to. "
    "The contract criterion is in Romanian; translate it to English. Answer with one JSON object "
    f"with exactly the keys {', '.join(V.RESPONSE_KEYS)}, where match is the id of the model criterion."
)


def prompts(criteria: DataFrame, taxonomy: Column, name: str, description: str, detail: str) -> DataFrame:
    """Adds the prompt for each criterion: instruction, taxonomy, ``name: description, detail``."""
    return criteria.withColumn(
        "prompt",
        text.joined(
            INSTRUCTION,
            "\nModel criteria:\n",
            taxonomy,
            "\nContract criterion: ",
            F.col(name),
            ": ",
            F.col(description),
            ", ",
            F.col(detail),
        ),
    )


def prompts_of(criteria: DataFrame, taxonomy: Column, content: str) -> DataFrame:
    """Adds the prompt for criteria that one column describes: instruction, taxonomy, that text."""
    parts = [INSTRUCTION, "\nModel criteria:\n", taxonomy, "\nContract criterion: ", F.col(content)]
    return criteria.withColumn("prompt", text.joined(*parts))


def read_responses(responses: DataFrame, column: str) -> DataFrame:
    """Adds the fields of each response and its ``status``.

    ``ok``: one JSON object and nothing behind it, with all required keys, all strings, and no
    other key. Otherwise ``not_json``, ``missing_key``, ``extra_key`` or ``wrong_type`` (a null
    too); those rows are for quarantine. Fields that are strings are shown in any case.
    """
    keys = F.array(*[F.lit(k) for k in V.RESPONSE_KEYS])
    strings = [F.schema_of_variant(F.col("_fields")[k]) == "STRING" for k in V.RESPONSE_KEYS]
    status = (
        F.when(F.col("_fields").isNull(), "not_json")
        .when(F.size(F.array_except(keys, F.map_keys("_fields"))) > 0, "missing_key")
        .when(F.size(F.array_except(F.map_keys("_fields"), keys)) > 0, "extra_key")
        .when(~reduce(lambda a, b: a & b, strings), "wrong_type")
        .otherwise("ok")
    )
    fields = F.try_variant_get(strict(text.strip_fence(F.col(column))), "$", "map<string,variant>")
    shown = [
        F.when(F.schema_of_variant(F.col("_fields")[k]) == "STRING", F.try_variant_get(F.col("_fields")[k], "$", "string"))
        for k in V.RESPONSE_KEYS
    ]
    return (
        responses.withColumn("_fields", fields)
        .withColumn("status", status)
        .select(*responses.columns, "status", *[c.alias(k) for c, k in zip(shown, V.RESPONSE_KEYS)])
    )


def accepted(read: DataFrame) -> DataFrame:
    return read.where(F.col("status") == "ok").drop("status")


def quarantined(read: DataFrame) -> DataFrame:
    return read.where(F.col("status") != "ok").drop(*V.RESPONSE_KEYS)


def best_match(
    criteria: DataFrame,
    key: str,
    content: str,
    taxonomy: DataFrame,
    entry_key: str,
    entry_content: str,
    threshold: int = 1,
) -> DataFrame:
    """(key, entry key, overlap, jaccard) of the entry sharing most distinct words, for every criterion.

    Each taxonomy row is an entry of its own, also if its key repeats or is NULL. Of equal overlaps the
    smallest entry key wins, NULL last, then the larger jaccard. A criterion whose best overlap is below
    ``threshold`` (at least 1) has a NULL entry, overlap and jaccard. Words are taken from whole texts.

    A taxonomy within the measured bounds is scored inside each row against an index of its words; nothing is
    shuffled and no pair becomes a row. A larger one is joined by words, of a criterion only its rarest that one
    of an entry with ``threshold`` words in common must be among. Both give the same rows.
    """
    left = criteria.select(F.col(key).alias("_key"), text.tokens(F.col(content)).alias("_words"))
    right = taxonomy.select(F.col(entry_key).alias("_entry"), text.tokens(F.col(entry_content)).alias("_entry_words"))
    bounded = measured_entries(taxonomy, entry_content) is not None
    best = (_best_in_row if bounded else _best_by_join)(left, right, max(1, threshold))
    return best.select(F.col("_key").alias(key), F.col("_entry").alias(entry_key), "overlap", "jaccard")


def _best_in_row(left: DataFrame, right: DataFrame, threshold: int) -> DataFrame:
    """Taxonomy within the bounds: the overlaps of a row are counted from the entries that each of its words has."""
    order = Window.orderBy(F.col("_entry").asc_nulls_last(), F.size("_entry_words"), "_entry_words")
    entries = right.where(F.size("_entry_words") > 0).withColumn("_place", F.row_number().over(order) - 1)
    rows = entries.select("_place", "_entry_words").toPandas()
    sizes = np.zeros(len(rows), np.int64)
    found: dict[str, list[int]] = {}
    for place, words in zip(rows["_place"], rows["_entry_words"]):
        sizes[place] = len(words)
        for word in words:
            found.setdefault(word, []).append(place)
    sent = left.sparkSession.sparkContext.broadcast(({w: np.array(p) for w, p in found.items()}, sizes))

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index, lengths = sent.value
        for batch in batches:
            out = []
            for words in batch:
                hits = [index[w] for w in words if w in index] if words is not None else []
                counts = np.bincount(np.concatenate(hits), minlength=len(lengths)) if hits else np.zeros(1, np.int64)
                place = int(counts.argmax())  # the first of the best
                top = int(counts[place])
                good = top >= threshold
                out.append((place, top, top / (len(words) + lengths[place] - top)) if good else (None, None, None))
            yield pd.DataFrame(out, columns=["_place", "overlap", "jaccard"]).astype(
                {"_place": "Int32", "overlap": "Int64", "jaccard": "float64"}
            )

    score = F.pandas_udf(scored, "_place int, overlap long, jaccard double")
    # As a generator the score is computed once.
    best = left.select("_key", F.inline(F.array(score("_words"))))
    return best.join(F.broadcast(entries.select("_place", "_entry")), "_place", "left")


def _best_by_join(left: DataFrame, right: DataFrame, threshold: int, spread: int = 64) -> DataFrame:
    """Taxonomy of any size: entries are met by the words of a criterion, and compared by all.

    Criteria of equal words are scored once. Of the words that any entry has, the rarest come first, and all but
    ``threshold`` - 1 of them are enough to meet every entry with ``threshold`` words in common. A common word is
    spread over ``spread`` join keys, the taxonomy side repeated for each.
    """
    text_of = F.md5(F.to_json(F.struct("_words"))).alias("_text")
    texts = left.where(F.size("_words") > 0).select(text_of, "_words").dropDuplicates(["_text"])
    entries = right.where(F.size("_entry_words") > 0).dropDuplicates(["_entry", "_entry_words"])
    entries = entries.withColumn("_id", F.md5(F.to_json(F.struct("_entry", "_entry_words"))))
    held = entries.select("_id", F.explode("_entry_words").alias("_word"))
    known = held.groupBy("_word").agg(F.count("*").alias("_often"))
    words = texts.select("_text", F.explode("_words").alias("_word"))
    own = Window.partitionBy("_text")
    rare = (
        words.join(known, "_word")
        .withColumn("_rank", F.row_number().over(own.orderBy("_often", "_word")))
        .withColumn("_known", F.count("*").over(own))
        .where(F.col("_rank") <= F.col("_known") - threshold + 1)
    )
    slots = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long")))
    met = rare.withColumn("_slot", F.pmod(F.xxhash64("_text"), F.lit(spread))).join(
        held.withColumn("_slot", slots).hint("merge"), ["_word", "_slot"]
    )
    pairs = met.select("_text", "_id").distinct()
    compared = (
        pairs.join(texts, "_text")
        .join(entries, "_id")
        .select(
            "_text",
            "_entry",
            F.size(F.array_intersect("_words", "_entry_words")).cast("long").alias("overlap"),
            F.size("_words").alias("_n"),
            F.size("_entry_words").alias("_m"),
        )
        .where(F.col("overlap") >= threshold)
    )
    best = keep_first(compared, ["_text"], [F.col("overlap").desc(), F.col("_entry").asc_nulls_last(), F.col("_m")])
    union = F.col("_n") + F.col("_m") - F.col("overlap")
    best = best.select("_text", "_entry", "overlap", (F.col("overlap") / union).alias("jaccard"))
    keyed = left.select("_key", text_of)
    # The hash makes both sides of the join plain shuffles, so that hot copies can be split.
    hashed = F.xxhash64("_text")
    return keyed.withColumn("_hash", hashed).join(best.withColumn("_hash", hashed), ["_text", "_hash"], "left")


Scorer = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def score_rows(rows: DataFrame, scorer: Scorer, schema: StructType | str) -> DataFrame:
    """Runs a user's scorer over batches of rows on the executors."""
    return rows.mapInPandas(scorer, schema)


def score_distinct(rows: DataFrame, column: str, scorer: Scorer, response: str = "response") -> DataFrame:
    """Adds a scorer's answer to a text; each distinct text is scored once.

    The scorer takes batches of the text column and gives batches of (text, answer).
    """
    # Never NULL, so that no filter is derived that would read the texts a second time.
    digest = F.coalesce(F.unhex(F.md5(column)), F.lit(b"")).alias("_digest")
    texts = rows.select(column).where(F.col(column).isNotNull()).distinct()
    answers = score_rows(texts, scorer, f"{column} string, {response} string").select(digest, response)
    return rows.select("*", digest).join(answers, "_digest", "left").drop("_digest")


def _guarded(scorer: Scorer, column: str, response: str) -> Scorer:
    """The scorer batch by batch; a batch that fails is tried again text by text, and what fails then keeps its error."""

    def answers(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([*scorer(iter([batch])), pd.DataFrame({column: [], response: []}, dtype=object)])

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            try:
                yield answers(batch).assign(error=None)
            except Exception:  # noqa: BLE001 (whatever a user's scorer raises becomes a row)
                for k in range(len(batch)):
                    one = batch.iloc[k : k + 1]
                    try:
                        yield answers(one).assign(error=None)
                    except Exception as error:  # noqa: BLE001
                        yield one.assign(**{response: None, "error": f"{type(error).__name__}: {error}"})

    return scored


def read_answers(spark: SparkSession, path: str, response: str = "response") -> DataFrame:
    """digest, answer, error, run and portion of all answers kept at ``path``; empty without any."""
    schema = f"digest binary, {response} string, error string, run long, portion int"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def score_resumed(
    rows: DataFrame, column: str, scorer: Scorer, path: str, response: str = "response", portion: int = 100_000
) -> DataFrame:
    """Adds a scorer's answer to a text and the ``error`` of one that could not be scored; answers are kept at ``path``.

    Each distinct text is scored once over all runs: a run leaves out what has an answer and tries again what failed.
    Answers are appended in portions of about ``portion`` texts, so a run that dies loses no more than one of them.
    Texts are told apart by SHA-256. One run at a time.
    """
    spark = rows.sparkSession
    digest = F.coalesce(F.unhex(F.sha2(column, 256)), F.lit(b"")).alias("digest")
    kept = read_answers(spark, path, response)
    known = kept.where(F.col("error").isNull()).select("digest").distinct()
    texts = rows.select(digest, column).where(F.col(column).isNotNull()).dropDuplicates(["digest"])
    staged = scratch_dir(spark, "unanswered")
    texts.join(known, "digest", "left_anti").write.parquet(staged)
    new = spark.read.schema(texts.schema).parquet(staged)
    run = (kept.agg(F.max("run")).first()[0] or 0) + 1
    portions = -(-new.count() // portion)
    guarded = _guarded(scorer, column, response)
    own = F.coalesce(F.unhex(F.sha2(column, 256)), F.lit(b"")).alias("digest")
    for k in range(portions):
        some = new.where(F.pmod(F.xxhash64("digest"), F.lit(portions)) == k).select(column)
        scored = score_rows(some, guarded, f"{column} string, {response} string, error string")
        scored.select(own, response, "error").write.mode("overwrite").parquet(f"{path}/run={run}/portion={k}")
    remove(spark, staged)
    latest = keep_first(
        read_answers(spark, path, response), ["digest"], [F.col("error").isNotNull(), F.col("run").desc(), F.col("portion")]
    ).select("digest", response, "error")
    return rows.select("*", digest).join(latest, "digest", "left").drop("digest")


# A taxonomy larger than a prompt


#: Entries that are packed together: each task packs this many, whatever the size of the taxonomy.
PACKED_TOGETHER = 2_000


def first_fit(sizes: list[int], budget: int) -> list[int]:
    """The number of a pack for each size, in this order: the first pack that has room. What exceeds the budget is alone."""
    room: list[int] = []
    packs = []
    for size in sizes:
        at = next((k for k, left in enumerate(room) if size <= left), len(room))
        if at == len(room):
            room.append(max(budget, size))
        room[at] -= size
        packs.append(at)
    return packs


def packed_taxonomy(taxonomy: DataFrame, key: str, content: str, budget: int) -> DataFrame:
    """pack, entries (their number) and lines: the entries as ``key: content`` lines, packed by first fit, longest first,
    so that the lines of a pack have at most ``budget`` characters. An entry longer than that is a pack of its own.

    Entries are dealt by their hash to groups of about ``PACKED_TOGETHER``, and packed group by group.
    """
    groups = -(-taxonomy.count() // PACKED_TOGETHER) or 1
    line = text.joined(F.col(key), ": ", F.col(content))
    lines = taxonomy.select(F.col(key).cast("string").alias("key"), line.alias("line"))
    dealt = lines.withColumn("group", F.pmod(F.xxhash64("key", "line"), F.lit(groups)))

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(size=group["line"].str.len() + 1)
        group = group.sort_values(["size", "key", "line"], ascending=[False, True, True], na_position="last")
        group["pack"] = first_fit(group["size"].tolist(), budget + 1)
        made = group.sort_values(["key", "line"]).groupby("pack")["line"]
        return pd.DataFrame(
            {"group": group["group"].iloc[0], "within": made.size().index, "entries": made.size().values, "lines": made.agg("\n".join).values}
        )

    packs = dealt.groupBy("group").applyInPandas(packed, "group long, within long, entries long, lines string")
    return packs.select(F.concat_ws("-", "group", "within").alias("pack"), "entries", "lines")


def packed_prompts(criteria: DataFrame, packs: DataFrame, content: str) -> DataFrame:
    """For each criterion a prompt for every pack of the taxonomy: ``pack``, ``entries`` and ``prompt``.

    The prompts are as many as criteria times packs, as they have to be; rows meet their pack by its name.
    """
    names = packs.agg(F.sort_array(F.collect_list("pack"))).scalar()
    joined = criteria.withColumn("pack", F.explode(names)).join(packs, "pack")
    return prompts_of(joined, F.col("lines"), content).drop("lines")


def merged_answers(read: DataFrame, key: str) -> DataFrame:
    """One answer for each criterion out of those for its packs (as ``read_responses`` gives them): the first that is
    accepted, else the first; packs in order of their names."""
    return keep_first(read, [key], [F.col("status") != "ok", F.col("pack")])


def with_url(matches: DataFrame, id_column: str, url_base: str) -> DataFrame:
    return matches.withColumn("URL", text.notice_url(F.col(id_column), url_base))
