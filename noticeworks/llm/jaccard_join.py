"""N-gram Jaccard join: exact near copies by size-banded tiles, bitmap signatures and sorted arrays.

A document's set holds the hashes of its distinct five-word shingles. Two sets link when 100 * |A and B| >= ``PERCENT`` *
|A or B|. Equal sets are one class, known by a 64-bit hash of the sorted set, and are compared once.

Which sets can link at all. |A and B| >= ``least(n)`` = ceil(0.75 n) for either size n, so in the order of the hashes the
first ``prefix(n)`` = n - least(n) + extra(n) of both share ``extra`` (of the smaller) or more. Only these prefixes are
shuffled. A hash that no other set has is dropped, and a set left with fewer than ``need(n)`` hashes links with nothing.
Of the others the rarest are enough: with s shared hashes left, the s - need(n) + 1 rarest of each set must meet. A tile
is one such hash with the sets that hold it.

Which of them do. A set is first compared with one centre of each of its tiles (stars, so a group of n near copies costs a
few n comparisons and not n * n), then with a few others that the first has not joined it to. Tiles whose sets are not all
linked by then are cut in cells: bands of sizes by which only neighbours can link, and blocks if large. In a cell brief
bitmaps of all remaining pairs are compared. Every bit of A that B lacks is a shingle of A that B lacks, so bit counts bound
the overlap from above. Small cells give the pairs that pass; whole bitmaps of these are compared, then sorted arrays. Large
cells give the sets that are in such a pair, once each; these meet again with whole bitmaps, those left with their sorted
arrays, and give the links that join something, so what leaves a cell is never more than its rows. Nothing is capped or sampled.

Defined cases. Null and empty texts, and texts without words, have size 0 and link with nothing. Texts of fewer than five
words are one shingle. A null id counts as smaller than all others where one row of a group is chosen. Rows of equal id
are rows of their own, each in the class of its text. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from noticeworks.llm.components import components
from noticeworks.llm.mixing import written
from noticeworks.llm.words import mix, shingles, slices

PERCENT = 75
#: A prefix holds 1/12 of the set more than one shared hash would need.
SPARE = 12
#: The centres of a tile are its least sids after these bits are flipped; the same sets have the same centres everywhere.
CENTRES = [0x0, 0x1E3779B97F4A7C15, 0x42B2AE3D27D4EB4F, 0x565667B19E3779F9, 0x66E8FEB86659FD93, 0x20761D6478BD642F]
#: Sets of a tile that are compared at once.
BLOCK = 1024
#: Tiles of at most so many sets of a band give pairs; in larger ones these would grow with the square of a group.
FEW = 64
#: Hashes of the sets of a tile that are compared at once.
BLOCK_HASHES = 2**20
#: Pairs that a task remembers so as not to give them again.
REMEMBERED = 100_000
#: Frequencies are counted up to here; beyond, the order of hashes alone decides.
FREQUENT = 65_536
#: Ids that may be broadcast to pick documents; beyond, they are shuffled.
BROADCAST_ROWS = 1_000_000
#: A bitmap has BITS to twice as many bits for each hash; tiles are compared by a brief one, folded to BRIEF to twice as many.
BITS, BRIEF = 8, 2
MIN_BITS, MAX_BITS = 64, 65_536
_SMALLEST = -(2**63)
_GROWTH = 100 / PERCENT + 1e-9


def least(n):
    """The overlap without which a set of this size links with nothing; for numbers, arrays and columns alike."""
    return (n * PERCENT + 99) // 100


def extra(n):
    return n // SPARE + 1


def prefix(n):
    return n - least(n) + extra(n)


def need(n):
    return extra(least(n))


def need_column(n: Column) -> Column:
    return F.floor(F.floor((n * PERCENT + 99) / 100) / SPARE) + 1


def set_id(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - 2**63


def width(n: int, bits: int) -> int:
    """Bits of a bitmap of ``n`` hashes: a power of two, so that it can be folded in halves."""
    size = MIN_BITS
    while size < min(bits * n, MAX_BITS):
        size *= 2
    return size


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """Bytes of the bitmap of a set."""
    size = width(len(hashes), BITS)
    bits = np.zeros(size, bool)
    bits[(mix(hashes) & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits)


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (rows of bytes) folded to ``size`` bytes."""
    while bits.shape[-1] > size:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def brief(bits: np.ndarray, n: int) -> np.ndarray:
    """The bitmap of ``n`` hashes folded to what tiles are compared by."""
    return folded(bits, width(n, BRIEF) // 8)


def overlap_bound(n_a, bits_a: np.ndarray, n_b, bits_b: np.ndarray):
    """No fewer than |A and B|: of each set, what the other's bitmap lacks is left out."""
    size = min(bits_a.shape[-1], bits_b.shape[-1])
    a, b = folded(bits_a, size), folded(bits_b, size)
    only_a = np.bitwise_count(a & ~b).sum(-1, dtype=np.int64)
    only_b = np.bitwise_count(b & ~a).sum(-1, dtype=np.int64)
    return np.minimum(n_a - only_a, n_b - only_b)


def enough(overlap, n_a, n_b):
    return 100 * overlap >= PERCENT * (n_a + n_b - overlap)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    place = np.searchsorted(b, a)
    place[place == len(b)] = 0
    return int((b[place] == a).sum()) if len(b) else 0


def classes(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text_hash, n, sid) of each document, written to the shared folder."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingles(x) for x in batch["t"].to_pylist()]
            n, sid = pa.array([len(x) for x in sets], pa.int64()), pa.array([set_id(x) for x in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_hash"], n, sid], ["doc_id", "text_hash", "n", "sid"])

    kind = docs.schema[doc_id].dataType.simpleString()
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("t"))
    return written(keyed.mapInArrow(rows_of, f"doc_id {kind}, text_hash long, n long, sid long"), "classes")


def prefixes(docs: DataFrame, text: str) -> DataFrame:
    """(sid, n, token): the prefix of each set, a set that comes twice in a task once."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in slices(batches):
            if len(seen) > 1_000_000:
                seen.clear()  # what comes again is left out later
            sids, sizes, tokens = [], [], []
            for text in batch["t"].to_pylist():
                hashes = shingles(text)
                sid = set_id(hashes)
                if len(hashes) and sid not in seen:
                    seen.add(sid)
                    own = hashes[: prefix(len(hashes))].view(np.int64)
                    sids.append(np.full(len(own), sid))
                    sizes.append(np.full(len(own), len(hashes), np.int32))
                    tokens.append(own)
            if sids:
                columns = [pa.array(np.concatenate(x)) for x in (sids, sizes, tokens)]
                yield pa.RecordBatch.from_arrays(columns, ["sid", "n", "token"])

    return docs.select(F.col(text).alias("t")).mapInArrow(rows_of, "sid long, n int, token long")


def _shared_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token and sid: those whose token two or more sets have, with their number up to ``FREQUENT``.

    The last run of a batch waits for the next batch, unless it is known to be frequent; so what waits is bounded.
    """

    def batch_of(token, sid, n, df):
        return pa.RecordBatch.from_arrays(
            [pa.array(sid), pa.array(n), pa.array(token), pa.array(df.astype(np.int32))], ["sid", "n", "token", "df"]
        )

    def runs(token, sid, n):
        starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        counts = np.diff(np.r_[starts, len(token)])
        df = np.repeat(np.minimum(counts, FREQUENT), counts)
        keep = df > 1
        return batch_of(token[keep], sid[keep], n[keep], df[keep])

    none = np.array([], np.int64)
    wait = (none, none, none.astype(np.int32))
    frequent = last_sid = None
    for batch in batches:
        token, sid, n = (batch[c].to_numpy(zero_copy_only=False) for c in ("token", "sid", "n"))
        if frequent is not None:  # rows of a token whose count has reached the limit
            more = int(np.searchsorted(token, frequent, side="right"))
            new = np.r_[sid[:1] != last_sid, sid[1:more] != sid[: max(0, more - 1)]][:more]
            if new.any():
                yield batch_of(token[:more][new], sid[:more][new], n[:more][new], np.full(int(new.sum()), FREQUENT))
            if more:
                last_sid = sid[more - 1]
            token, sid, n = token[more:], sid[more:], n[more:]
            if not len(token):
                continue
            frequent = None
        token, sid, n = (np.concatenate(x) for x in zip(wait, (token, sid, n)))
        if not len(token):
            continue
        new = np.r_[True, (token[1:] != token[:-1]) | (sid[1:] != sid[:-1])]
        token, sid, n = token[new], sid[new], n[new]
        cut = int(np.searchsorted(token, token[-1], side="left"))
        if cut:
            yield runs(token[:cut], sid[:cut], n[:cut])
        if len(token) - cut >= FREQUENT:
            yield batch_of(token[cut:], sid[cut:], n[cut:], np.full(len(token) - cut, FREQUENT))
            frequent, last_sid, wait = token[-1], sid[-1], (none, none, none.astype(np.int32))
        else:
            wait = (token[cut:], sid[cut:], n[cut:])
    if len(wait[0]):
        yield runs(*wait)


def tiles(docs: DataFrame, text: str) -> DataFrame:
    """(token, centres, sid, n): each tile with the sets that hold its hash. Written to the shared folder.

    Of hashes that the same sets hold, as those of a shared passage are, one is enough: the lists of two hashes are taken
    as equal if their length and two 64-bit sums of their sids are.
    """
    sorted_rows = prefixes(docs, text).repartition("token").sortWithinPartitions("token", "sid")
    shared = sorted_rows.mapInArrow(_shared_runs, "sid long, n int, token long, df int")
    own = Window.partitionBy("sid")
    needed = need_column(F.col("n"))
    ranked = (
        shared.withColumn("shared", F.count("*").over(own))
        .withColumn("rank", F.row_number().over(own.orderBy("df", "token")))
        .where(F.col("rank") <= F.col("shared") - needed + 1)
    )
    met = written(ranked.select("token", "sid", "n"), "meetings")
    sums = [F.bit_xor(F.xxhash64(F.lit(seed), "sid")).alias(f"sum{seed}") for seed in (1, 2)]
    least_of = [F.min(F.col("sid").bitwiseXOR(F.lit(mask))).alias(f"least{k}") for k, mask in enumerate(CENTRES)]
    lists = met.groupBy("token").agg(F.count("*").alias("found"), *sums, *least_of).where("found > 1")
    same = ["found", "sum1", "sum2", *(f"least{k}" for k in range(len(CENTRES)))]
    centres = F.array_distinct(F.array(*[F.col(f"least{k}").bitwiseXOR(F.lit(mask)) for k, mask in enumerate(CENTRES)]))
    chosen = lists.groupBy(*same).agg(F.min("token").alias("token")).select("token", centres.alias("centres"))
    return written(met.join(chosen, "token").select("token", "centres", "sid", "n"), "tiles")


def sets_of(docs: DataFrame, known: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(sid, n, brief, bits, hashes) of the wanted sids, each from its smallest document. Written to the shared folder."""
    ids = known.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_SMALLEST)))
    ids = ids.groupBy("sid", "_id").agg(F.count("*").alias("found"))
    firsts = ids.groupBy("sid").agg(F.min("_id").alias("_id"), F.min_by("found", "_id").alias("found"))
    chosen = written(firsts.join(wanted, "sid", "left_semi"), "chosen")
    few = _few(chosen)
    texts = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_SMALLEST)).alias("_id"), F.col(text).alias("_t"))

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own = [(sid, shingles(x)) for sid, x in zip(batch["sid"].to_pylist(), batch["_t"].to_pylist())]
            # Rows of one id may have different texts; equal rows give equal sets.
            own = [(sid, x) for sid, x in own if set_id(x) == sid]
            bits = [bitmap(x) for _, x in own]
            columns = [
                pa.array([sid for sid, _ in own], pa.int64()),
                pa.array([len(x) for _, x in own], pa.int32()),
                pa.array([brief(b, len(x)).tobytes() for b, (_, x) in zip(bits, own)], pa.binary()),
                pa.array([b.tobytes() for b in bits], pa.binary()),
                pa.array([x.tobytes() for _, x in own], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["sid", "n", "brief", "bits", "hashes"])

    def made(chosen: DataFrame) -> DataFrame:
        picked = texts.join(F.broadcast(chosen) if few else chosen, "_id").select("sid", "_t")
        return picked.mapInArrow(rows_of, "sid long, n int, brief binary, bits binary, hashes binary")

    # Only sets that come from several equal rows of one id are shuffled, to leave one of each.
    repeated = made(chosen.where("found > 1")).dropDuplicates(["sid"])
    return written(made(chosen.where("found = 1")).unionByName(repeated), "sets")


def _few(rows: DataFrame) -> bool:
    return rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def _only(sets: DataFrame, sids: Column, rows: DataFrame) -> DataFrame:
    """The sets that rows name: hashes are the bulk of a set, and those of no others leave their task."""
    left = rows.select(sids.alias("sid")).distinct()
    return sets.join(F.broadcast(left) if _few(left) else left, "sid", "left_semi")


def _unpacked(column: pa.ChunkedArray | pa.Array, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link: first by the bound of the bitmaps, then exactly."""

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in slices(batches):
            rows = zip(*(x[c].to_pylist() for c in ("n_a", "bits_a", "n_b", "bits_b")))
            keep = [
                bool(enough(overlap_bound(n, np.frombuffer(s, np.uint8), m, np.frombuffer(t, np.uint8)), n, m))
                for n, s, m, t in rows
            ]
            yield x.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in slices(batches):
            both = zip(_unpacked(x["hashes_a"], np.uint64), _unpacked(x["hashes_b"], np.uint64))
            keep = [bool(enough(overlap(s, t), len(s), len(t))) for s, t in both]
            yield x.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def with_sets(pairs: DataFrame, sets: DataFrame, fields: list[str]) -> DataFrame:
        for side in "ab":
            own = sets.select(F.col("sid").alias(side), *[F.col(f).alias(f"{f}_{side}") for f in fields])
            pairs = pairs.join(own, side)
        return pairs

    sized = with_sets(pairs, sets, ["n", "bits"])
    near = sized.where(100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b"))
    bounded = written(near.mapInArrow(possible, "a long, b long"), "bounded")
    compared = _only(sets, F.explode(F.array("a", "b")), bounded)
    return written(with_sets(bounded, compared, ["hashes"]).mapInArrow(exact, "a long, b long"), "links")


def _band(n: Column) -> Column:
    """Sizes that link lie in one band or in neighbouring ones: the bands grow by 4/3, with a margin for rounding."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(_GROWTH))).cast("int")


_CELL = ["band", "token", "i", "j"]
_ROW = [*_CELL, "sid", "root", "n", "up", "block"]


def _stacked(bitmaps: list[np.ndarray], size: int) -> np.ndarray:
    """The bitmaps folded to ``size`` bytes as rows; zeros for those that are smaller."""
    none = np.zeros(size, np.uint8)
    return np.stack([folded(x, size) if len(x) >= size else none for x in bitmaps])


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by cell, dealt so that cells stay whole and all rows are of one band."""
    wait = None

    def bands(rows: pa.Table) -> Iterator[pa.Table]:
        band = rows["band"].to_numpy()
        for cut in np.split(np.arange(len(band)), np.flatnonzero(np.diff(band)) + 1):
            yield rows.slice(int(cut[0]), len(cut))

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([wait, rows]) if wait is not None else rows
        if not len(rows):
            continue
        same = np.logical_and.reduce([(v := rows[c].to_numpy()) == v[-1] for c in _CELL])
        cut = int(np.argmax(same))
        yield from bands(rows.slice(0, cut)) if cut else ()
        wait = rows.slice(cut)
    if wait is not None and len(wait):
        yield from bands(wait)


def _candidates(
    own: pa.Table, given: list[np.ndarray], wanted: Callable[[np.ndarray, np.ndarray], np.ndarray]
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of wanted pairs of one cell that the bounds of sizes and of the given bitmaps let through.

    All cells of a band are compared at once: each row with the next one, then with the one after that, and so on while
    they share a cell. ``wanted`` is asked at each step, so it may depend on what has been found.
    """
    token, i, j, n, up, block = (own[c].to_numpy() for c in [*_CELL[1:], "n", "up", "block"])
    wide = np.array([len(x) for x in given])
    # The sizes of a cell's sets differ by less than a factor of two, so their bitmaps have two widths at most.
    folds = {size: _stacked(given, size) for size in np.unique(wide).tolist()}
    halves = {size: folded(bits, max(MIN_BITS // 8, size // 2)) for size, bits in folds.items()}
    new = np.r_[True, (token[1:] != token[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]
    cell = np.cumsum(new)
    last = np.append(np.flatnonzero(new)[1:], len(cell))[cell - 1]  # behind the last row of the cell
    first = np.arange(len(cell))
    step = 1
    while len(first := first[first + step < last[first]]):
        a, b = first, first + step
        step += 1
        ok = wanted(a, b) & ((up[a] == 0) | (up[b] == 0)) & ((i[a] == j[a]) | (block[a] != block[b]))
        ok &= 100 * np.minimum(n[a], n[b]) >= PERCENT * np.maximum(n[a], n[b])
        a, b = a[ok], b[ok]
        if len(a):
            size_of = np.minimum(wide[a], wide[b])
            for size in folds:
                x, y = a[size_of == size], b[size_of == size]
                for bits in (halves[size], folds[size]):
                    near = enough(overlap_bound(n[x], bits[x], n[y], bits[y]), n[x], n[y])
                    x, y = x[near], y[near]
                if len(x):
                    yield x, y


def _near_in_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that the bounds of sizes and bitmaps let through, of rows sorted by cell.

    A pair that meets in several tiles is given once while a task remembers it; what comes again is left out later.
    """
    given_out: set[tuple[int, int]] = set()
    for own in _whole_cells(batches):
        sid, root = own["sid"].to_numpy(), own["root"].to_numpy()
        for a, b in _candidates(own, _unpacked(own["bits"], np.uint8), lambda a, b, root=root: root[a] != root[b]):
            found = zip(np.minimum(sid[a], sid[b]).tolist(), np.maximum(sid[a], sid[b]).tolist())
            if new := [pair for pair in dict.fromkeys(found) if pair not in given_out]:
                if len(given_out) > REMEMBERED:
                    given_out.clear()
                given_out.update(new)
                yield pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in zip(*new)], ["a", "b"])


def _paired_in_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by cell: those in a pair that the bounds of sizes and bitmaps let through, without their bitmaps."""
    for own in _whole_cells(batches):
        root, paired = own["root"].to_numpy(), np.zeros(len(own), bool)
        wanted = lambda a, b, root=root, paired=paired: (root[a] != root[b]) & ~(paired[a] & paired[b])
        for a, b in _candidates(own, _unpacked(own["bits"], np.uint8), wanted):
            paired[a] = paired[b] = True
        yield from own.select(_ROW).filter(pa.array(paired)).to_batches()


def _links_in_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of rows sorted by cell, found exactly; what earlier links of the same rows have joined is not compared."""
    for own in _whole_cells(batches):
        sid, root = own["sid"].to_numpy(), own["root"].to_numpy().copy()
        hashes = _unpacked(own["hashes"], np.uint64)
        links = []
        for a, b in _candidates(own, [bitmap(x) for x in hashes], lambda a, b, root=root: root[a] != root[b]):
            for x, y in zip(a.tolist(), b.tolist()):
                s, t = hashes[x], hashes[y]
                if root[x] != root[y] and enough(overlap(s, t), len(s), len(t)):
                    root[root == root[y]] = root[x]
                    links.append((min(sid[x], sid[y]), max(sid[x], sid[y])))
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in zip(*links)], ["a", "b"])


def open_cells(tiles: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of tiles whose sets no link joins yet, by cell: a tile's sets of neighbouring sizes, in blocks if large."""
    rooted = tiles.join(roots.select(F.col("node").alias("sid"), "root"), "sid", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "sid"))
    unsettled = rooted.groupBy("token").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s")
    rows = written(
        rooted.join(unsettled.select("token"), "token").select("token", "sid", "root", "n", _band(F.col("n")).alias("band")),
        "open-tiles",
    )
    # A set stands in its own band and, as the smaller one, in the next.
    placed = rows.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("up"))
    placed = placed.withColumn("band", F.col("band") + F.col("up"))
    counted = placed.groupBy("token", "band").agg(
        F.count("*").alias("found"), F.sum(1 - F.col("up")).alias("own"), F.min("root").alias("r"), F.max("root").alias("s"),
        F.sum("n").alias("hashes"),
    )
    blocks = F.ceil(F.greatest(F.col("found") / BLOCK, F.col("hashes") / BLOCK_HASHES))
    counted = counted.where("own > 0 and r <> s").select("token", "band", "found", blocks.alias("blocks"))
    cut = placed.join(counted, ["token", "band"]).withColumn("block", F.pmod(F.xxhash64("sid"), "blocks"))
    cells = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j")),
    )
    spread = cut.select("found", "token", "band", "sid", "root", "n", "up", "block", F.explode(cells).alias("cell"))
    return spread.select("found", "band", "token", "cell.i", "cell.j", "sid", "root", "n", "up", "block")


def _met_in_cells(rows: DataFrame, sets: DataFrame, field: str, name: str) -> DataFrame:
    """Rows of cells with a field of their sets, cell by cell."""
    full = rows.join(sets.select("sid", F.col(field).alias(name)), "sid")
    return full.repartition(*_CELL).sortWithinPartitions(*_CELL)


def open_pairs(tiles: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b) of the tiles of up to ``FEW`` sets that no link joins yet and that the bounds let through."""
    return cell_pairs(open_cells(tiles, roots), sets)


def open_links(tiles: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
    """Links (a, b) of the larger tiles: enough to join all sets that their links join. Written to the shared folder."""
    return cell_links(open_cells(tiles, roots), sets)


def cell_pairs(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """``open_pairs`` of given cells."""
    rows = cells.where(F.col("found") <= FEW).select(_ROW)
    return _met_in_cells(rows, sets, "brief", "bits").mapInArrow(_near_in_cells, "a long, b long").distinct()


def cell_links(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """``open_links`` of given cells."""
    rows = cells.where(F.col("found") > FEW).select(_ROW)
    # Brief bitmaps let many sets through; whole ones are a fraction of the hashes that the rest are spared.
    for field in ("brief", "bits"):
        paired = _met_in_cells(rows, sets, field, "bits").mapInArrow(_paired_in_cells, rows.schema)
        rows = written(paired, "open-rows")
    met = _met_in_cells(rows, _only(sets, F.col("sid"), rows), "hashes", "hashes")
    return written(met.mapInArrow(_links_in_cells, "a long, b long"), "open-links")


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The classes of all documents, and (sid, root) of the classes that link with another."""
    known = classes(docs, doc_id, text)
    met = tiles(docs, text)
    sets = sets_of(docs, known, met.select("sid").distinct(), doc_id, text)
    star = stars(met.select(F.get("centres", 0).alias("a"), F.col("sid").alias("b")))
    roots = written(components(linked(star, sets)), "roots")
    # The other centres meet only the sets that the first has not joined to them.
    others = met.select(F.explode(F.slice("centres", 2, len(CENTRES))).alias("a"), F.col("sid").alias("b"))
    for side in "ab":
        own = roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
        others = others.join(own, side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
    more_stars = stars(others.where("root_a <> root_b"), star)
    roots = written(components(joined_to(roots, linked(more_stars, sets))), "roots")
    compared = star.unionByName(more_stars)
    cells = written(open_cells(met, roots), "open-cells")
    rest = written(cell_pairs(cells, sets).join(compared, ["a", "b"], "left_anti"), "open-pairs")
    links = linked(rest, sets).unionByName(cell_links(cells, sets))
    roots = components(joined_to(roots, links))
    return known, roots.withColumnRenamed("node", "sid")


def stars(pairs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The different pairs, smaller sid first, but for known ones. Written to the shared folder."""
    sided = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return written(sided.join(known, ["a", "b"], "left_anti") if known is not None else sided, "stars")


def joined_to(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Known components and more links as edges."""
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links)


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id: the smallest id that the document reaches by links, itself included."""
    known, roots = grouped(docs, doc_id, text)
    # Classes, then components, get their smallest document before the documents are met.
    firsts = known.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("first"))
    rooted = firsts.join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    heads = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_class = written(rooted.join(heads, "root").select("sid", "component_id"), "components")
    own = known.where("n > 0").join(by_class, "sid", "left").select("doc_id", "n", "component_id")
    alone = known.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return own.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id, a null id before all others.

    Texts without words are groups of their own. Rows of equal id and text are one document and leave one row.
    """
    known, roots = grouped(docs, doc_id, text)
    key = F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(_SMALLEST)).alias("id"), "text_hash")
    firsts = known.where("n > 0").groupBy("sid").agg(F.min(key).alias("first"))
    rooted = firsts.join(roots, "sid", "left").groupBy(F.coalesce("root", "sid")).agg(F.min("first").alias("k"))
    alone = known.where("n = 0").select(key.alias("k"))
    names = ["_group_id", "_group_text"]
    heads = rooted.select("k").unionByName(alone).select("k.*").toDF(*names)
    heads = written(heads.distinct(), "heads")
    own_id = F.coalesce(F.col(doc_id).cast("long"), F.lit(_SMALLEST))
    keyed = docs.withColumns({"_group_id": own_id, "_group_text": F.xxhash64(text)})
    row = F.row_number().over(Window.partitionBy(*names).orderBy("_group_id"))
    found = keyed.join(heads, names, "left_semi").withColumn("_group_row", row)
    return found.where("_group_row = 1").drop("_group_id", "_group_text", "_group_row")
