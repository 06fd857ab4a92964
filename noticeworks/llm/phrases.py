"""Phrase collocations by counting in a HAT-trie.

Words and phrases of up to three words are counted per language, pieces of text apart. Each task that reads texts numbers
the words that it meets and counts phrases in a trie over word numbers: its leaves are hash containers, each for a range of
neighbouring prefixes. A container that grows past ``BURST`` entries bursts: a range of several first words is cut in two
between words, one first word's container is cut between second words, and so on, so the trie is deep only where a prefix
is frequent. When a task holds ``HELD`` entries, the largest containers, which are whole subtrees, leave the trie until half of the
entries are left; what leaves together is one sorted run.

A run is cut by prefix partition (first word, and a few parts of its second words, so that a frequent first word is spread)
into compressed blocks of sorted phrases with their counts. Spark brings the blocks of a partition together, sorted by their
first phrase, and they are merged in that order: a phrase below the first one of the next block is complete. Of the merged
phrases only those counted ``LEAST`` times or more go on, and nothing else is needed: the parts of a phrase are at least as
frequent as itself.

Phrases of two and three words are scored by their weakest cut: ``floor(SCALE * a * a / (l * r))`` in exact decimals.

Defined cases. Null texts are empty, a null language is ``und``. Texts without words give nothing. Repeated rows count
again. A language without phrases has no rows; an empty table gives an empty result. Other columns are ignored. Words may
hold any bytes but blanks and piece ends: zero bytes are escaped within the runs so that their order is that of UTF-8.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeworks.llm.mixing import written
from noticeworks.llm.words import mix, slices

WORDS = 3
LEAST = 10
SCALE = 1_000_000
COVERED = 50
FIRST = 2000
#: Entries that a container and a task hold, and the most phrases in a block.
BURST = 1 << 15
HELD = 1 << 21
BLOCK = 4096
#: Prefix partitions of each language; as many tasks can merge its runs.
PARTS = 512
#: Parts that the second words behind one first word are dealt to.
SECOND_PARTS = 16
#: Words that are numbered at once.
AT_ONCE = 1 << 18
_BITS = 21
_MASK = (1 << _BITS) - 1
#: A-Z are lower-cased, tabs are blanks, and the ends of pieces become a byte that no UTF-8 text holds.
_END = b"\xff"
_BYTES = bytes(
    0xFF if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
_RUN = "lang string, part int, first binary, phrases binary, counts binary"
_MERGED = "lang string, words int, phrase string, n long"


def words_of(texts: list[str | None]) -> list[bytes]:
    """The words of some texts, in order; ``_END`` wherever a piece ends."""
    data = "\n".join([x or "" for x in texts]).encode().translate(_BYTES)
    if b"\x00" in data or b"\x01" in data:
        data = data.replace(b"\x01", b"\x01\x02").replace(b"\x00", b"\x01\x01")
    return data.replace(_END, b" " + _END + b" ").split(b" ")


def plain(phrase: bytes) -> str:
    """A phrase of a run as text: zero bytes part its words."""
    phrase = phrase.replace(b"\x00", b" ")
    if b"\x01" in phrase:
        phrase = phrase.replace(b"\x01\x01", b"\x00").replace(b"\x01\x02", b"\x01")
    return phrase.decode()


class Numbers(dict):
    """The words of a task, numbered as they come; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({_END: 0})
        self.words = [_END]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        return number


def keys_of(numbers: np.ndarray) -> np.ndarray:
    """A key for every phrase: its word numbers from the left, 21 bits each, zeros behind."""
    shifted = [numbers << (2 * _BITS)]
    within = numbers > 0
    for k in range(1, WORDS):
        key = shifted[-1][:-1] + (numbers[k:] << ((WORDS - 1 - k) * _BITS))
        shifted.append(key)
    keys = [shifted[0][within]]
    for k in range(1, WORDS):
        within = within[:-1] & (numbers[k:] > 0)
        keys.append(shifted[k][within])
    return np.concatenate(keys)


class Container:
    """A hash table of keys and counts, open addressing in arrays; many keys are added at once."""

    def __init__(self, keys: np.ndarray | None = None, counts: np.ndarray | None = None):
        self.size = 0
        self._empty(1 << 10)
        if keys is not None:
            self.add(keys, counts)

    def _empty(self, slots: int) -> None:
        self.keys, self.counts = np.full(slots, -1, np.int64), np.zeros(slots, np.int64)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        filled = self.keys >= 0
        return self.keys[filled], self.counts[filled]

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Adds the counts of different keys."""
        if 2 * (self.size + len(keys)) > len(self.keys):
            held = self.entries()
            self._empty(1 << (2 * (self.size + len(keys))).bit_length())
            self.size = 0
            self._put(*held)
        self._put(keys, counts)

    def _put(self, keys: np.ndarray, counts: np.ndarray) -> None:
        mask = len(self.keys) - 1
        slots = (mix(keys.view(np.uint64)) & np.uint64(mask)).view(np.int64)
        while len(keys):
            free = self.keys[slots] < 0
            # Of several keys on one free slot one takes it; the others find it taken.
            self.keys[slots[free]] = keys[free]
            own = self.keys[slots] == keys
            self.size += int((free & own).sum())
            self.counts[slots[own]] += counts[own]
            other = ~own
            keys, counts, slots = keys[other], counts[other], (slots[other] + 1) & mask


class Trie:
    """Counts of keys in hash containers; container k holds the keys from ``lows[k]`` up to the next."""

    def __init__(self):
        self.lows = [0]
        self.containers = [Container()]

    @property
    def size(self) -> int:
        return sum(x.size for x in self.containers)

    def add(self, keys: np.ndarray) -> None:
        keys = np.sort(keys)
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else keys
        counts = np.diff(np.r_[starts, len(keys)])
        keys = keys[starts]
        cuts = [*np.searchsorted(keys, self.lows).tolist(), len(keys)]
        full = []
        for k, held in enumerate(self.containers):
            if cuts[k] < cuts[k + 1]:
                held.add(keys[cuts[k] : cuts[k + 1]], counts[cuts[k] : cuts[k + 1]])
                if held.size > BURST:
                    full.append(self.lows[k])
        for low in full:
            self._burst(low)

    def _burst(self, low: int) -> None:
        """Cuts a container between words until no part is full; single phrases cannot be cut."""
        k = bisect_right(self.lows, low) - 1
        keys, counts = self.containers[k].entries()
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        middle, cut = int(keys[len(keys) // 2]), None
        for level in range(WORDS - 1, -1, -1):  # between first words if that parts it, else between second words
            at = middle >> (level * _BITS) << (level * _BITS)
            if at > keys[0]:
                cut = at
                break
            if (at := at + (1 << (level * _BITS))) <= keys[-1]:
                cut = at
                break
        if cut is None:
            return
        half = int(np.searchsorted(keys, cut))
        parts = [Container(keys[:half], counts[:half]), Container(keys[half:], counts[half:])]
        self.lows.insert(k + 1, cut)
        self.containers[k : k + 1] = parts
        for low, part in zip((low, cut), parts):
            if part.size > BURST:
                self._burst(low)

    def spill(self, left: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys and counts of the largest containers, taken out until ``left`` entries stay."""
        out, size = [], self.size
        for k in sorted(range(len(self.containers)), key=lambda k: -self.containers[k].size):
            if size <= left:
                break
            out.append(self.containers[k].entries())
            size -= self.containers[k].size
            self.containers[k] = Container()
        if not out:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([keys for keys, _ in out]), np.concatenate([counts for _, counts in out])


def blocks(keys: np.ndarray, counts: np.ndarray, numbers: Numbers, parts: int, lang: str) -> Iterator[tuple]:
    """Phrases and their counts as rows of ``_RUN``: sorted within each prefix partition."""
    columns = [(keys >> ((WORDS - 1 - k) * _BITS)) & _MASK for k in range(WORDS)]
    # Words by their bytes: the numbers of those in here, in order. The end of a piece stands for no word.
    used = np.zeros(len(numbers.words), bool)
    for column in columns:
        used[column] = True
    used = np.flatnonzero(used)
    names = [numbers.words[x] if x else b"" for x in used.tolist()]
    order = sorted(range(len(names)), key=names.__getitem__)
    names = [names[k] for k in order]
    rank = np.zeros(len(numbers.words), np.int64)
    rank[used[order]] = np.arange(len(names))
    places = [rank[x] for x in columns]
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, names), np.uint64, len(names))
    second = hashes[places[1]] % np.uint64(SECOND_PARTS)
    part = ((hashes[places[0]] + second * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(16)) % np.uint64(parts)
    sort = np.argsort((places[0] << (2 * _BITS)) + (places[1] << _BITS) + places[2])
    sort = sort[np.argsort(part[sort].astype(np.uint16), kind="stable")]
    part, counts = part[sort], counts[sort]
    # All phrases behind one another, a line each, without an object for any of them.
    words = pa.array(names, pa.large_binary())
    tails = pa.array([b"\x00" + x if x else x for x in names], pa.large_binary())
    ends = pa.array([(b"\x00" + x if x else x) + b"\n" for x in names], pa.large_binary())
    parts_of = [x.take(pa.array(column[sort])) for x, column in zip((words, tails, ends), places)]
    phrases = pc.binary_join_element_wise(*parts_of, pa.scalar(b"", pa.large_binary()))
    _, offsets, data = phrases.buffers()
    offsets, data = np.frombuffer(offsets, np.int64)[phrases.offset :], memoryview(data)
    pack = zstandard.ZstdCompressor(level=1).compress
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]).tolist()
    for start, end in zip(starts, [*starts[1:], len(part)]):
        for at in range(start, end, BLOCK):
            to = min(at + BLOCK, end)
            first = bytes(data[offsets[at] : offsets[at + 1] - 1])
            yield lang, int(part[start]), first, pack(data[offsets[at] : offsets[to] - 1]), pack(counts[at:to].tobytes())


def runs(docs: DataFrame, parts: int, text: str = "text") -> DataFrame:
    """The sorted runs of all tasks."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers()
        tries: dict[str, Trie] = {}

        def spilled(left: int) -> Iterator[pa.RecordBatch]:
            whole = sum(trie.size for trie in tries.values())
            for lang, trie in tries.items():
                keys, counts = trie.spill(left * trie.size // max(whole, 1))
                if len(keys):
                    columns = zip(*blocks(keys, counts, numbers, parts, lang))
                    kinds = [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                    arrays = [pa.array(x, kind) for x, kind in zip(columns, kinds)]
                    yield pa.RecordBatch.from_arrays(arrays, ["lang", "part", "first", "phrases", "counts"])

        for batch in slices(batches, 128):
            texts: dict[str, list[str | None]] = {}
            for lang, value in zip(*[column.to_pylist() for column in batch.columns]):
                texts.setdefault("und" if lang is None else lang, []).append(value)
            for lang, values in texts.items():
                words = [x for x in words_of(values) if x]
                for start in range(0, len(words), AT_ONCE):  # phrases across this cut come with the next part
                    part = words[max(0, start - WORDS + 1) : start + AT_ONCE]
                    if len(numbers.words) + len(part) > _MASK:
                        yield from spilled(0)
                        numbers, tries = Numbers(), {}
                    numbered = np.fromiter(map(numbers.__getitem__, part), np.int64, len(part))
                    tries.setdefault(lang, Trie()).add(keys_after(numbered, min(start, WORDS - 1)))
            if sum(trie.size for trie in tries.values()) > HELD:
                yield from spilled(HELD // 2)
        yield from spilled(0)

    return docs.select("lang", text).mapInArrow(rows_of, _RUN)


def keys_after(numbers: np.ndarray, known: int) -> np.ndarray:
    """The keys of all phrases that do not lie whole within the first ``known`` words, which were counted before."""
    if not known:
        return keys_of(numbers)
    keys, before = keys_of(numbers), keys_of(numbers[:known])
    keys, counts = np.unique(keys, return_counts=True)
    for key in before.tolist():
        counts[np.searchsorted(keys, key)] -= 1
    return np.repeat(keys, counts)


def merged(rows: Iterator[tuple[str, int, bytes, bytes, bytes]], least: int) -> Iterator[tuple]:
    """Rows of ``_MERGED`` for blocks that come sorted by language, partition and first phrase: the phrases counted
    ``least`` times or more, and for each partition a row without a phrase that holds its number of words."""
    unpack = zstandard.ZstdDecompressor().decompress
    pending: dict[bytes, int] = {}
    floor, place, total = 0, None, 0

    def complete(below: bytes | None) -> Iterator[tuple]:
        nonlocal total
        done = pending if below is None else {x: n for x, n in pending.items() if x < below}
        for phrase, n in done.items():
            words = phrase.count(b"\x00") + 1
            if words == 1:
                total += n
            if n >= least:
                yield place[0], words, plain(phrase), n
        if below is None:
            pending.clear()
        else:
            for phrase in done:
                del pending[phrase]

    for lang, part, first, phrases, counts in rows:
        if place != (lang, part):
            if place:
                yield from complete(None)
                yield place[0], 0, None, total
            place, total, floor = (lang, part), 0, 0
        if len(pending) > 2 * floor + 16 * BLOCK:
            yield from complete(first)
            floor = len(pending)
        for phrase, n in zip(unpack(phrases).split(b"\n"), np.frombuffer(unpack(counts), np.int64).tolist()):
            pending[phrase] = pending.get(phrase, 0) + n
    if place:
        yield from complete(None)
        yield place[0], 0, None, total


def frequent(docs: DataFrame, text: str = "text", least: int = LEAST, parts: int = PARTS) -> DataFrame:
    """lang, words, phrase and n of all words and phrases counted ``least`` times or more; rows without a phrase hold
    numbers of all words."""
    kinds = [pa.string(), pa.int32(), pa.string(), pa.int64()]

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks_in() -> Iterator[tuple]:
            for batch in slices(batches, 16):
                yield from zip(*[column.to_pylist() for column in batch.columns])

        held: list[tuple] = []

        def table() -> pa.RecordBatch:
            arrays = [pa.array(x, kind) for x, kind in zip(zip(*held), kinds)]
            return pa.RecordBatch.from_arrays(arrays, ["lang", "words", "phrase", "n"])

        for row in merged(blocks_in(), least):
            held.append(row)
            if len(held) >= BLOCK:
                yield table()
                held = []
        if held:
            yield table()

    together = runs(docs, parts, text).repartition("lang", "part").sortWithinPartitions("lang", "part", "first")
    return together.mapInArrow(rows_of, _MERGED)


def _exact(n: Column) -> Column:
    return n.cast("decimal(15,0)")


def score(a: Column, left: Column, right: Column) -> Column:
    """``floor(SCALE * a * a / (l * r))``, exact for counts of up to fifteen digits; at most SCALE."""
    above = _exact(a) * _exact(a) * F.lit(SCALE).cast("decimal(7,0)")
    return F.call_function("div", above, _exact(left) * _exact(right))


def collocations(docs: DataFrame, text: str = "text", first: int = FIRST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: the first phrases of each language."""
    found = written(frequent(docs, text), "phrases")
    phrases = found.where(F.col("phrase").isNotNull())
    sizes = found.where(F.col("phrase").isNull()).groupBy("lang").agg(F.sum("n").alias("n"))
    longer = phrases.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))

    words = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = longer.select("lang", "phrase", "words", "a", cut)
    sides = cuts.withColumns(
        {
            "left": F.array_join(F.slice(words, 1, F.col("k")), " "),
            "right": F.array_join(F.slice(words, F.col("k") + 1, F.col("words") - F.col("k")), " "),
        }
    )
    lefts = phrases.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    rights = phrases.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    scored = sides.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"])
    scored = scored.withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))
    weakest = (
        scored.groupBy("lang", "phrase", "words", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")
    )
    # What a phrase one word longer holds of two words and more. Longer phrases are at most as frequent as the parts
    # between, so these are all that can cover it.
    inside = longer.where("words > 2").select(
        "lang",
        F.explode(
            F.array(F.array_join(F.slice(words, 1, F.col("words") - 1), " "), F.array_join(F.slice(words, 2, F.col("words") - 1), " "))
        ).alias("phrase"),
        F.col("a").alias("longer"),
    )
    covers = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = weakest.join(covers, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * _exact(F.col("longer")) < COVERED * _exact(F.col("a")))
    )
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= first)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
