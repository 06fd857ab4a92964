"""Incremental load of landed files: each file once, each id once, no record lost.

A target is a folder of loads. Every micro-batch writes its rows, its bad records and an index of its ids to folders named
after itself, and then one small manifest, which makes all of them count at once:

    rows/_load=<name>/        the rows, sorted by a hash bucket of their id
    keys/_load=<name>/        Bloom filters of the ids, in blocks of 4 KB
    quarantine/_load=<name>/  records that cannot be loaded, as they landed
    manifest/v=<number>/      the loads that count; the highest number holds

A new id is first looked up in the filters of the live loads: one block for each load, whatever the load's size. Only for
ids that a filter may know are the id columns of that load and bucket read. ``compact`` merges loads of a like size into
one, so there are at most ``FAN`` loads for each power of ``FAN`` of rows, and the files stay few. Merged folders stay for
``GRACE`` more manifests, so a reader that has resolved the manifest before is not disturbed, and what a crash leaves behind
is never listed.

One writer at a time; readers may come at any time.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from noticeworks.functions import json_text
from noticeworks.operators.joins import rows_in, rows_not_in
from noticeworks.operators.ranking import keep_first
from noticeworks.session import newest_note, remove, write_note

LOAD, BUCKET = "_load", "_bucket"
#: Hash buckets of ids within each load.
BUCKETS = 64
#: Bits of a block, bits for each id, and bits that an id sets: about one id in 300 is looked up in vain.
BLOCK_BITS = 32_768
BITS_PER_ID = 16
PROBES = 4
ROWS_PER_FILE = 1_000_000
FAN = 4
GRACE = 3

MALFORMED, WRONG_TYPE, NO_ID = "malformed", "wrong_type", "no_id"
BAD = ["file", "modified", "record", "reason"]
QUARANTINE = "file string, modified timestamp, record string, reason string"


@dataclass
class Load:
    """A load by its name, with its number of rows in each bucket."""

    name: str
    counts: list[int]

    @property
    def rows(self) -> int:
        return sum(self.counts)

    @property
    def blocks(self) -> list[int]:
        return [-(-n * BITS_PER_ID // BLOCK_BITS) for n in self.counts]


@dataclass
class Manifest:
    """What counts: loads, loads with bad records, the last batch of each checkpoint, and folders on their way out."""

    version: int = 0
    loads: list[Load] = field(default_factory=list)
    bad: list[str] = field(default_factory=list)
    done: dict[str, int] = field(default_factory=dict)
    dropped: list[tuple[str, int]] = field(default_factory=list)


def manifest(spark: SparkSession, target: str) -> Manifest:
    """The manifest that holds now. Its size is that of the list of loads."""
    newest = newest_note(spark, f"{target}/manifest")
    if newest is None:
        return Manifest()
    given = json.loads(newest["body"])
    return Manifest(**{**given, "loads": [Load(**x) for x in given["loads"]]})


def commit(spark: SparkSession, target: str, now: Manifest) -> None:
    """Makes the next manifest hold, then drops the folders whose time is over."""
    now.version += 1
    gone = [path for path, since in now.dropped if since + GRACE <= now.version]
    now.dropped = [(path, since) for path, since in now.dropped if since + GRACE > now.version]
    write_note(spark, f"{target}/manifest", now.version, json.dumps(asdict(now)))
    for path in gone:
        remove(spark, f"{target}/{path}")
    if now.version > GRACE:
        remove(spark, f"{target}/manifest/v={now.version - GRACE}")


def target_schema(schema: StructType) -> StructType:
    return StructType(schema.fields + [StructField(BUCKET, IntegerType(), True), StructField(LOAD, StringType(), True)])


def _part(spark: SparkSession, target: str, part: str, names: list[str], schema) -> DataFrame:
    """These loads' folders of one part of the target."""
    if not names:
        return spark.createDataFrame([], schema)
    paths = [f"{target}/{part}/{LOAD}={name}" for name in names]
    return spark.read.schema(schema).option("basePath", f"{target}/{part}").parquet(*paths)


def read_loads(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """The loaded rows with their load and bucket."""
    return _part(spark, target, "rows", [x.name for x in manifest(spark, target).loads], target_schema(schema))


def read_target(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """The loaded rows."""
    return read_loads(spark, target, schema).drop(LOAD, BUCKET)


def read_quarantine(spark: SparkSession, target: str) -> DataFrame:
    """file, modified, record and reason of every landed record that is not loaded."""
    return _part(spark, target, "quarantine", manifest(spark, target).bad, QUARANTINE).select(*BAD)


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(BUCKETS)).cast("int")


def identity(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a checkpoint; with the batch number it names a load."""
    ident = json_text.field(F.col("value"), "id")
    return spark.read.text(f"{checkpoint}/metadata").select(ident).first()[0]


def unreadable(spark: SparkSession, landing: str, key: str) -> DataFrame:
    """Landed JSON lines that are malformed or have no id, with their file; ``read_quarantine`` has those of loaded files."""
    record = F.col("record")
    lines = spark.read.text(landing).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("record"))
    lost = json_text.malformed(record) | json_text.field(record, key).isNull()
    return lines.where((F.trim("record") != "") & lost)


# The index of ids


def _block(key: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), F.col(key).cast("string")), blocks).cast("int")


def _places(key: str) -> list[Column]:
    """The bits that an id sets in its block."""
    bits = F.xxhash64(F.lit(2), F.col(key).cast("string"))
    return [F.shiftright(bits, 15 * k).bitwiseAND(F.lit(BLOCK_BITS - 1)) for k in range(PROBES)]


def _has(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, place.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1)) == 1


def index_of(rows: DataFrame, key: str, load: Load) -> DataFrame:
    """The filter blocks of a load's ids."""
    blocks = F.get(F.array(*[F.lit(max(n, 1)) for n in load.blocks]), F.col(BUCKET))
    set_bits = rows.select(BUCKET, _block(key, blocks).alias("block"), F.explode(F.array(*_places(key))).alias("place"))
    return set_bits.groupBy(BUCKET, "block").agg(F.bitmap_construct_agg("place").alias("bits"))


def suspects(spark: SparkSession, target: str, now: Manifest, ids: DataFrame, key: str) -> DataFrame:
    """``ids`` (key and bucket) that the filter of a load may know: key, load and bucket. Reads filters only."""
    filled = [x for x in now.loads if x.rows]
    loads = F.array(
        *[
            F.struct(F.lit(x.name).alias(LOAD), F.get(F.array(*map(F.lit, x.blocks)), F.col(BUCKET)).alias("blocks"))
            for x in filled
        ]
    )
    schema = f"{BUCKET} int, block int, bits binary, {LOAD} string"
    index = _part(spark, target, "keys", [x.name for x in filled], schema)
    asked = ids.select(key, BUCKET, F.explode(loads).alias("_at")).select(key, BUCKET, f"_at.{LOAD}", "_at.blocks")
    asked = asked.where("blocks > 0").withColumn("block", _block(key, F.col("blocks"))).drop("blocks")
    found = asked.join(index, [LOAD, BUCKET, "block"])
    known = F.lit(True)
    for place in _places(key):
        known = known & _has(F.col("bits"), place)
    return found.where(known).select(key, LOAD, BUCKET)


def stored_ids(spark: SparkSession, target: str, now: Manifest, hits: DataFrame, key: str, schema: StructType) -> DataFrame | None:
    """The ids of all loads and buckets with a hit: what an exact check has to read; None without a hit."""
    pairs = hits.select(LOAD, BUCKET).distinct().collect()  # at most loads times BUCKETS
    if not pairs:
        return None
    of_load: dict[str, list[int]] = {}
    for pair in pairs:
        of_load.setdefault(pair[LOAD], []).append(pair[BUCKET])
    stored = _part(spark, target, "rows", sorted(of_load), target_schema(schema))
    wanted = F.lit(False)
    for name, buckets in of_load.items():
        wanted = wanted | ((F.col(LOAD) == name) & F.col(BUCKET).isin(buckets))
    return stored.where(wanted).select(key)


# Loading


def _audited(lines: DataFrame, schema: StructType, key: str) -> DataFrame:
    """Landed JSON lines parsed once: file, modified, record, reason (NULL if the row can be loaded) and row."""
    parsed = lines.where(F.trim("value") != "").withColumn("_parsed", json_text.parse_whole(F.col("value"), schema))
    row = F.col("_parsed.value")
    reason = (
        F.when(~F.col("_parsed.whole") | row.isNull(), MALFORMED)
        .when(F.col("_parsed.lost"), WRONG_TYPE)
        .when(row[key].isNull(), NO_ID)
    )
    return parsed.select("file", "modified", F.col("value").alias("record"), reason.alias("reason"), row.alias("row"))


def _write_rows(rows: DataFrame, path: str, n: int) -> None:
    files = max(1, math.ceil(n / ROWS_PER_FILE))
    rows.repartition(files, BUCKET).sortWithinPartitions(BUCKET).write.mode("overwrite").parquet(path)


def _counts(rows: DataFrame) -> list[int]:
    found = dict(rows.groupBy(BUCKET).count().collect())  # at most BUCKETS numbers
    return [found.get(k, 0) for k in range(BUCKETS)]


def _write_index(rows: DataFrame, target: str, key: str, load: Load) -> None:
    files = max(1, math.ceil(load.rows / (8 * ROWS_PER_FILE)))
    index = index_of(rows, key, load).repartition(files, BUCKET).sortWithinPartitions(BUCKET, "block")
    index.write.mode("overwrite").parquet(f"{target}/keys/{LOAD}={load.name}")


def _quarantine(spark: SparkSession, target: str, now: Manifest, bad: DataFrame, own: str) -> None:
    """Writes bad records, but for those of files that an earlier load has quarantined (after a lost checkpoint)."""
    if now.bad:
        before = _part(spark, target, "quarantine", now.bad, QUARANTINE).select("file", "modified").distinct()
        bad = bad.join(before, ["file", "modified"], "left_anti")
    bad.write.mode("overwrite").parquet(f"{target}/quarantine/{LOAD}={own}")
    now.bad.append(own)


def add_batch(batch: DataFrame, own: str, target: str, now: Manifest, schema: StructType, key: str) -> None:
    """Writes the new rows and the bad records of a batch (as ``_audited`` gives them) and lists them in ``now``."""
    session = batch.sparkSession
    batch = batch.persist()
    good = batch.where(F.col("reason").isNull()).select("file", "modified", "row.*")
    order = [F.col(c) for c in ["modified", "file", *schema.names] if c != key]
    first = keep_first(good, [key], order).drop("file", "modified").withColumn(BUCKET, bucket_of(key)).persist()
    try:
        bad = batch.where(F.col("reason").isNotNull()).drop("row")
        if not bad.isEmpty():
            _quarantine(session, target, now, bad, own)
        load = Load(own, _counts(first))
        if not load.rows:
            return
        stored = None
        if now.loads:
            hits = suspects(session, target, now, first.select(key, BUCKET), key)
            stored = stored_ids(session, target, now, hits, key, schema)
        rows = first if stored is None else rows_not_in(first, rows_in(stored, first, key, key), key, key)
        _write_rows(rows, f"{target}/rows/{LOAD}={own}", load.rows)
        if stored is not None:
            rows = _part(session, target, "rows", [own], target_schema(schema))
            load = Load(own, _counts(rows))
        if load.rows:
            _write_index(rows, target, key, load)
            now.loads.append(load)
        else:
            now.dropped.append((f"rows/{LOAD}={own}", now.version))
    finally:
        first.unpersist()
        batch.unpersist()


def load_new(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    schema: StructType,
    key: str,
    fmt: str = "json",
    files_per_batch: int | None = None,
    compacted: bool = True,
) -> None:
    """Loads the files not loaded so far and returns; rows of known ids are left out.

    JSON lines are parsed once. A line that is not one JSON object, has a value of a wrong type or no id goes to the
    quarantine with its text and the reason; blank lines are no records. Of other formats rows without an id go there.

    Of rows with the same id the one in the oldest file stays. ``files_per_batch`` bounds a batch, so that a failure
    repeats no more than that. A batch counts from its manifest on; one that is run again after that does nothing, one
    that is run again before writes the same folders anew. Several landing folders, each with a checkpoint, may share a
    target, and after a lost checkpoint the loaded rows stay. ``compacted=False`` leaves merging to a call of ``compact``.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        ident = identity(session, checkpoint)
        now = manifest(session, target)
        if now.done.get(ident, -1) >= batch_id:
            return
        if fmt == "json":
            batch = _audited(batch, schema, key)
        else:
            row = F.struct(*schema.names)
            reason = F.when(F.col(key).isNull(), NO_ID)
            batch = batch.select(
                "file", "modified", json_text.to_text(row).alias("record"), reason.alias("reason"), row.alias("row")
            )
        add_batch(batch, f"{ident}-{batch_id}", target, now, schema, key)
        now.done[ident] = batch_id
        commit(session, target, now)

    source = spark.readStream.format("text") if fmt == "json" else spark.readStream.format(fmt).schema(schema)
    if files_per_batch is not None:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    file, modified = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified")
    (
        source.load(landing)
        .select("*", file, modified)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    if compacted:
        compact(spark, target, schema, key)


def tier(rows: int) -> int:
    return int(math.log(max(rows, 1), FAN))


def compact(spark: SparkSession, target: str, schema: StructType, key: str) -> None:
    """Merges loads of a like size, smallest first, while ``FAN`` of them lie in one power of ``FAN``."""
    while True:
        now = manifest(spark, target)
        tiers: dict[int, list[Load]] = {}
        for load in now.loads:
            tiers.setdefault(tier(load.rows), []).append(load)
        full = [tiers[k] for k in sorted(tiers) if len(tiers[k]) >= FAN]
        if not full and len(now.bad) < FAN:
            return
        name = f"merged-{now.version + 1}"
        if full:
            names = [x.name for x in full[0]]
            rows = _part(spark, target, "rows", names, target_schema(schema)).drop(LOAD)
            _write_rows(rows, f"{target}/rows/{LOAD}={name}", sum(x.rows for x in full[0]))
            # The loads share no id, so the counts add up.
            merged = Load(name, [sum(x) for x in zip(*[load.counts for load in full[0]])])
            _write_index(_part(spark, target, "rows", [name], target_schema(schema)), target, key, merged)
            now.loads = [x for x in now.loads if x.name not in names] + [merged]
            now.dropped += [(f"{part}/{LOAD}={x}", now.version) for x in names for part in ("rows", "keys")]
        if len(now.bad) >= FAN:
            records = _part(spark, target, "quarantine", now.bad, QUARANTINE).select(*BAD)
            records.coalesce(8).write.mode("overwrite").parquet(f"{target}/quarantine/{LOAD}={name}")
            now.dropped += [(f"quarantine/{LOAD}={x}", now.version) for x in now.bad]
            now.bad = [name]
        commit(spark, target, now)
