"""URL filters by a sorted digest array.

A list holds keys of host and path start, such as ``example.com/en/``, with an action. Its 64-bit xxhash digests lie
sorted in one file, followed by the offsets and bytes of the keys. The file is written once to the shared folder and
handed out by Spark; each worker maps it into memory. A URL asks for every suffix of its host at a dot, with every start of
its path that is as long as some key's. All questions of a batch are one vectorised binary search; a digest that is found
counts only if the stored key is the same string. Of the keys found the longest wins, of equal ones that of the longer host.

Lists of up to ``MAX_KEYS`` keys are mapped. Longer ones, and lists that are tables, are joined by host and path start
(``judged_by_join``), which has no bound and gives the same rows.

Defined cases. A null URL or one without ``://`` has an empty host and path and asks for nothing. Keys that come twice
count once, the last action winning; in a table, which has no order, ``block`` wins. Repeated rows are judged alike. An empty table or list gives no findings. Columns of
the input named like a result are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.llm.mixing import written
from noticeworks.llm.words import add_fields
from noticeworks.session import scratch_dir

MAX_KEYS = 20_000_000
ACTIONS = ["allow", "block"]
#: The rules, as (action, host, path), and the names that the default list blocks under each ending.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
BLOCKED_NAMES = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
BLOCKED = [("block", f"{name}.example.{end}", "") for name in BLOCKED_NAMES for end in ("com", "net", "org")]
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[\s\S]*?://([^/?#]*)", 1), _CAPITALS, _SMALL)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[\s\S]*?://[^/?#]*([^?#]*)", 1)


def pack(rules: list[tuple[str, str, str]]) -> bytes:
    """The file: number of keys, then digests, offsets, host lengths and actions of the keys in digest order, then the keys."""
    actions = {host + path: (len(host.encode()), ACTIONS.index(action)) for action, host, path in rules}
    if len(actions) > MAX_KEYS:
        raise ValueError(f"{len(actions)} keys are over the bound of {MAX_KEYS}; join them as a table")
    keys = [k.encode() for k in actions]
    digests = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
    order = np.argsort(digests, kind="stable")
    ends = np.cumsum([0, *(len(keys[k]) for k in order)]).astype(np.uint64)
    host_and_action = np.array([actions[keys[k].decode()] for k in order], np.uint32).reshape(-1, 2)
    head = np.array([len(keys)], np.uint64)
    return b"".join([x.tobytes() for x in (head, digests[order], ends, host_and_action)] + [keys[k] for k in order])


class DigestArray:
    """A packed list, mapped into memory."""

    def __init__(self, path: str):
        self.count = n = int(np.fromfile(path, np.uint64, 1)[0])
        self.digests = np.memmap(path, np.uint64, "r", 8, (n,)) if n else np.zeros(0, np.uint64)
        self.ends = np.memmap(path, np.uint64, "r", 8 + 8 * n, (n + 1,))
        self.about = np.memmap(path, np.uint32, "r", 16 + 16 * n, (n, 2)) if n else np.zeros((0, 2), np.uint32)
        self.first = 16 + 24 * n
        total = int(self.ends[-1])
        self.keys = np.memmap(path, np.uint8, "r", self.first, (total,)) if total else np.zeros(0, np.uint8)
        if n:
            lengths = np.diff(self.ends.astype(np.int64)) - self.about[:, 0]
            self.path_lengths = sorted(set(lengths.tolist()))
        else:
            self.path_lengths = []

    def key(self, place: int) -> bytes:
        return self.keys[int(self.ends[place]) : int(self.ends[place + 1])].tobytes()

    def find(self, asked: list[bytes]) -> list[int]:
        """The place of each key, or -1: a binary search by digest, confirmed by the string."""
        digests = np.fromiter(map(xxhash.xxh64_intdigest, asked), np.uint64, len(asked))
        left, right = np.searchsorted(self.digests, digests, "left"), np.searchsorted(self.digests, digests, "right")
        places = [-1] * len(asked)
        for k in np.flatnonzero(right > left).tolist():
            places[k] = next((p for p in range(left[k], right[k]) if self.key(p) == asked[k]), -1)
        return places

    def judge(self, hosts: list[str], paths: list[str]) -> list[tuple[str, str] | None]:
        """(key, action) of the longest key that fits each host and path."""
        asked, owners = [], []
        for owner, (host, path) in enumerate(zip(hosts, paths)):
            if not host:
                continue
            path = path.encode()
            starts = [path[:n] for n in self.path_lengths if n <= len(path)]
            labels = host.split(".")
            for k in range(len(labels)):
                suffix = ".".join(labels[k:]).encode()
                asked += [suffix + x for x in starts]
                owners += [owner] * len(starts)
        best: list[tuple[int, int, int] | None] = [None] * len(hosts)
        for owner, place in zip(owners, self.find(asked)):
            if place >= 0:
                size = int(self.ends[place + 1] - self.ends[place])
                found = (size, int(self.about[place, 0]), place)
                best[owner] = max(best[owner], found) if best[owner] else found
        return [x and (self.key(x[2]).decode(), ACTIONS[self.about[x[2], 1]]) for x in best]


def publish(spark: SparkSession, rules: list[tuple[str, str, str]]) -> str:
    """Writes the packed list to the shared folder and has Spark hand it to all workers; returns its name."""
    name = f"keys-{uuid.uuid4().hex}.bin"
    path = f"{scratch_dir(spark, 'url-keys')}/{name}"
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        out.write(bytearray(pack(rules)))
    finally:
        out.close()
    spark.sparkContext.addFile(path)
    return name


def judged(pages: DataFrame, rules: list[tuple[str, str, str]], prefix: str = "", host: str = "host", path: str = "path") -> DataFrame:
    """``pages`` with ``<prefix>rule`` and ``<prefix>action`` of the key that wins, or nulls."""
    if len(rules) > MAX_KEYS:
        table = pages.sparkSession.createDataFrame(last_of_each(rules), "action string, host string, path string")
        return judged_by_join(pages, table, prefix, host, path)
    name = publish(pages.sparkSession, rules)

    def rows_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        keys = DigestArray(SparkFiles.get(name))
        for hosts, paths in batches:
            found = keys.judge(hosts.fillna("").tolist(), paths.fillna("").tolist())
            yield pd.DataFrame([x or (None, None) for x in found], columns=names, dtype=object)

    names = [f"{prefix}rule", f"{prefix}action"]
    kind = ", ".join(f"{n} string" for n in names)
    return add_fields(pages, F.pandas_udf(rows_of, kind)(F.col(host), F.col(path)), names)


def last_of_each(rules: list[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    return [(action, host, path) for (host, path), action in {(h, p): a for a, h, p in rules}.items()]


def judged_by_join(pages: DataFrame, rules: DataFrame, prefix: str = "", host: str = "host", path: str = "path") -> DataFrame:
    """``judged`` for a table of rules (action, host, path) of any length.

    Each suffix of a host first meets the hosts of the rules, with the lengths of their paths; only for those does a URL
    ask for starts of its path.
    """
    keys = rules.groupBy(F.col("host").alias("_host"), F.col("path").alias("_start")).agg(F.max("action").alias("_action"))
    hosts = keys.groupBy("_host").agg(F.collect_set(F.length("_start")).alias("_lengths"))
    rows = written(pages.withColumn("_rules_row", F.monotonically_increasing_id()), "pages")
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    asked = (
        rows.where(F.length(host) > 0)
        .select("_rules_row", F.col(path).alias("_path"), F.explode(suffixes).alias("_host"))
        .join(hosts, "_host")
        .select("_rules_row", "_host", "_path", F.explode(F.filter("_lengths", lambda n: n <= F.length("_path"))).alias("_n"))
        .select("_rules_row", "_host", F.expr("substring(_path, 1, _n)").alias("_start"))
    )
    size = F.octet_length("_host") + F.octet_length("_start")
    best = F.max(F.struct(size.alias("size"), F.octet_length("_host").alias("h"), F.concat("_host", "_start").alias("rule"), "_action"))
    won = asked.join(keys, ["_host", "_start"]).groupBy("_rules_row").agg(best.alias("_rules_won"))
    fields = F.struct(F.col("_rules_won.rule").alias(f"{prefix}rule"), F.col("_rules_won._action").alias(f"{prefix}action"))
    joined = rows.join(won, "_rules_row", "left")
    return add_fields(joined, fields, [f"{prefix}rule", f"{prefix}action"]).drop("_rules_row", "_rules_won")


def verdicts(
    pages: DataFrame,
    url: str = "url",
    rules: list[tuple[str, str, str]] = RULES,
    blocked: list[tuple[str, str, str]] | DataFrame = BLOCKED,
) -> DataFrame:
    """``pages`` with host, path, rule and verdict: the action of the rule that wins, else of the list, else ``allow``.

    The list may be a table (action, host, path).
    """
    fields = F.struct(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    split = add_fields(pages, fields, ["host", "path"])
    by_list = judged_by_join if isinstance(blocked, DataFrame) else judged
    found = by_list(judged(split, rules), blocked, "listed_")
    verdict = F.coalesce("action", "listed_action", F.lit("allow"))
    return found.withColumn("verdict", verdict).drop("action", "listed_action")
