import random

import numpy as np
import pyarrow as pa
from cases import LONG, ROWS, frame

from noticeworks.llm import jaccard_join as j
from noticeworks.llm import queries
from noticeworks.llm.components import components
from noticeworks.llm.words import shingles


def sets(texts):
    out = []
    for text in texts:
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
        out.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    return out


def plain(rows):
    """(doc_id, size, smallest id of the component) of each row, by comparing all pairs."""
    own = sets(r[1] for r in rows)
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if own[a] and 100 * len(own[a] & own[b]) >= 75 * len(own[a] | own[b]):
                root[top(a)] = top(b)
    firsts = {}
    for k, r in enumerate(rows):
        if own[k] and r[0] is not None:
            firsts[top(k)] = min(firsts.get(top(k), r[0]), r[0])
    return sorted(
        ((r[0], len(own[k]), firsts.get(top(k)) if own[k] else r[0]) for k, r in enumerate(rows)), key=repr
    )


def found(df):
    return sorted(map(tuple, j.near_copies(df).collect()), key=repr)


def varied(text, rnd, share):
    return " ".join(w if rnd.random() > share else f"x{rnd.randint(0, 10**6)}" for w in text.split(" "))


def corpus(seed=5):
    """Near copies at and around the limit, chains, a group of many copies, and a passage that many texts share."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randint(0, 500)}"
    rows = []
    for k in range(25):
        text = " ".join(word() for _ in range(rnd.choice([3, 5, 8, 40, 150, 400])))
        for _ in range(rnd.randint(1, 5)):
            rows.append((len(rows), text, "en", "a", 1))
            text = varied(text, rnd, rnd.choice([0, 0.005, 0.02, 0.04, 0.06]))
    star = " ".join(word() for _ in range(100))
    rows += [(len(rows) + k, varied(star, rnd, 0.015), "en", "a", 1) for k in range(60)]
    rows += [(len(rows) + k, star.upper(), "en", "a", 1) for k in range(40)]
    passage = " ".join(word() for _ in range(60))
    for k in range(50):
        rows.append((len(rows), passage + " " + " ".join(word() for _ in range(rnd.randint(5, 40))), "en", "a", 1))
    return rows


def test_against_all_pairs(spark):
    rows = corpus()
    assert found(frame(spark, rows)) == plain(rows)


def test_sizes_at_the_limit(spark):
    words = [f"w{k}" for k in range(400)]
    rows = []
    for n in (5, 8, 11, 12, 20, 28, 47, 100, 204, 304):
        for cut in (0, n // 4 - 1, n // 4, n // 4 + 1, (n - 4) // 4, -(-(n - 4) // 4)):
            text = " ".join(f"{n}{w}" for w in words[: max(1, n - max(0, cut))])
            rows.append((len(rows), text, "en", "a", 1))
    assert found(frame(spark, rows)) == plain(rows)


def test_odd_rows_and_names(spark):
    df = frame(spark, [*ROWS, (30, LONG + " end", "en", "a", 1)], {"sid": "x", "component_id": "y"})
    assert found(df) == plain([*ROWS, (30, LONG + " end", "en", "a", 1)])
    assert found(frame(spark, [])) == []


def test_one_of_each(spark):
    df = frame(spark, [*ROWS, (30, LONG + " end", "en", "a", 1)], {"_row": "x", "_id": "y", "sid": "z"})
    left = sorted((r["doc_id"] for r in j.one_of_each(df).select("doc_id").collect()), key=repr)
    # 2 equals 1, 7 equals 6, 30 is near 5; texts without words stay, as does the null id.
    assert left == sorted([1, 3, 4, 5, 6, None, None, 8, 9], key=repr)
    assert j.one_of_each(df).columns == df.columns
    assert j.one_of_each(frame(spark, [])).count() == 0


def test_the_least_overlap_never_rules_out_a_link():
    for a in range(1, 130):
        for b in range(a, 130):
            for k in range(1, a + 1):
                if j.enough(k, a, b):
                    assert k >= j.least(b) and j.prefix(a) <= a
                    assert min(j.extra(a), j.extra(b)) >= max(j.need(a), j.need(b))


def test_linking_sets_meet_in_their_prefixes():
    rnd = np.random.RandomState(3)
    for _ in range(300):
        n = rnd.randint(1, 200)
        a = np.unique(rnd.randint(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.r_[a[rnd.rand(len(a)) > 0.1], rnd.randint(0, 2**63, rnd.randint(0, 1 + n // 10)).astype(np.uint64)])
        if len(b) and j.enough(j.overlap(a, b), len(a), len(b)):
            common = np.intersect1d(a[: j.prefix(len(a))], b[: j.prefix(len(b))])
            assert len(common) >= max(j.need(len(a)), j.need(len(b)))


def test_bitmaps_bound_the_overlap_from_above():
    rnd = np.random.RandomState(4)
    for _ in range(300):
        a = np.unique(rnd.randint(0, 300, rnd.randint(1, 250)).astype(np.uint64))
        b = np.unique(rnd.randint(0, 300, rnd.randint(1, 250)).astype(np.uint64))
        exact = len(np.intersect1d(a, b))
        assert j.overlap(a, b) == exact
        assert j.overlap_bound(len(a), j.bitmap(a), len(b), j.bitmap(b)) >= exact


def batches(columns, size):
    table = pa.table(columns)
    return [b for k in range(0, len(table), size) for b in table.slice(k, size).to_batches()]


def test_runs_over_batches_and_frequent_hashes(monkeypatch):
    monkeypatch.setattr(j, "FREQUENT", 5)
    rnd = random.Random(6)
    for size in (1, 2, 3, 7, 100):
        rows = sorted({(t, rnd.randint(0, 12)) for t in range(30) for _ in range(rnd.randint(1, 9))})
        doubled = sorted(rows + rnd.sample(rows, 40))
        given = {
            "token": pa.array([t for t, _ in doubled], pa.int64()),
            "sid": pa.array([s for _, s in doubled], pa.int64()),
            "n": pa.array([s + 1 for _, s in doubled], pa.int32()),
        }
        out = pa.Table.from_batches(j._shared_runs(iter(batches(given, size)))).to_pylist()
        count = {t: sum(x == t for x, _ in rows) for t, _ in rows}
        assert sorted((r["token"], r["sid"], r["df"]) for r in out) == [
            (t, s, min(count[t], 5)) for t, s in rows if count[t] > 1
        ]


def test_cells_compare_each_pair_that_may_link():
    rnd = np.random.RandomState(8)
    own = []
    for sid in range(40):
        base = np.unique(np.random.RandomState(sid // 4).randint(0, 2**62, 60).astype(np.uint64))
        own.append(np.unique(np.r_[base[rnd.rand(len(base)) > 0.06], rnd.randint(0, 2**62, 2).astype(np.uint64)]))
    rows = sorted((10 + token % 2, token, 0, 0, sid) for token in range(6) for sid in range(40) if rnd.rand() < 0.7)
    columns = {
        "band": [r[0] for r in rows], "token": [r[1] for r in rows], "i": [0] * len(rows), "j": [0] * len(rows),
        "sid": [r[4] for r in rows], "root": [r[4] for r in rows], "n": [len(own[r[4]]) for r in rows],
        "up": [0] * len(rows), "block": [0] * len(rows), "bits": [j.bitmap(own[r[4]]).tobytes() for r in rows],
        "tokens": [sorted({x[1] for x in rows if x[4] == r[4]}) for r in rows],
    }
    expected = {
        (min(a, b), max(a, b))
        for band, token, _, _, a in rows
        for other, same, _, _, b in rows
        if (band, token) == (other, same) and a != b and j.enough(j.overlap(own[a], own[b]), len(own[a]), len(own[b]))
    }
    for size in (3, 10, 1000):
        out = [p for x in j._near_in_cells(iter(batches(columns, size))) for p in zip(*(x[c].to_pylist() for c in "ab"))]
        assert expected <= set(out) and len(expected) > 20 and len(out) == len(set(out))


def test_components(spark):
    rnd = random.Random(7)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(180)]
    edges += [(1000 + k, 1001 + k) for k in range(70)] + [(5000, 5001 + k) for k in range(500)] + [(7, 7)]
    root = {k: k for e in edges for k in e}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in edges:
        low, high = sorted((top(a), top(b)))
        root[high] = low
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: top(k) for k in root if top(k) != k}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_blocks_of_a_large_tile(spark, monkeypatch):
    """Tiles over the bound are cut in blocks on the driver's side of the plan; every pair still meets."""
    monkeypatch.setattr(j, "BLOCK", 8)
    rows = corpus(11)
    assert found(frame(spark, rows)) == plain(rows)


def test_shingles():
    assert len(shingles("a b c d")) == 1 and len(shingles(None)) == len(shingles(" \t")) == 0
    assert shingles("A b c d e").tolist() == shingles("a\nb  c d\te").tolist()
    assert shingles("a b c").tolist() != shingles("a b c d").tolist()


def test_the_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries.op3_ngram_jaccard(spark, "/root/testdata/sf0.001").collect()), key=repr)
    assert got == plain(rows)


def test_pairs_grow_in_line_with_a_group(spark, monkeypatch):
    """One group of near copies, three times as large: about three times the stars and open pairs, not nine times.

    In smaller groups tiles still multiply: from 100 to 300 sets the pairs grow five times.
    """
    rnd, counts = random.Random(1), {}
    words = [f"w{k}" for k in range(5000)]
    base = [rnd.choice(words) for _ in range(300)]
    keep = j.written

    def counted(df, label):
        out = keep(df, label)
        if label in ("stars", "open-pairs"):
            counts[n] = counts.get(n, 0) + out.count()
        return out

    monkeypatch.setattr(j, "written", counted)
    for n in (300, 900):
        rows = []
        for k in range(n):
            text = list(base)
            for _ in range(rnd.randint(0, 14)):
                text[rnd.randrange(300)] = rnd.choice(words)
            rows.append((k, " ".join(text), "en", "a", 1))
        j.near_copies(frame(spark, rows)).count()
    assert counts[900] <= 4 * counts[300]


def test_tiles_are_compared_by_brief_bitmaps(spark):
    """What open tiles are dealt with needs no whole bitmaps, and their brief ones still let every link through."""
    rnd = random.Random(12)
    base = [f"w{rnd.randint(0, 500)}" for _ in range(400)]
    rows = [(k, varied(" ".join(base[: rnd.randint(300, 400)]), rnd, 0.02), "en", "a", 1) for k in range(60)]
    docs = frame(spark, rows)
    known = j.classes(docs, "doc_id", "text")
    sets = j.sets_of(docs, known, known.select("sid"), "doc_id", "text")
    for row in sets.collect():
        assert row["n"] * j.BRIEF <= 8 * len(row["brief"]) < max(2 * j.MIN_BITS, 2 * row["n"] * j.BRIEF)
        assert bytes(j.folded(np.frombuffer(row["bits"], np.uint8), len(row["brief"]))) == bytes(row["brief"])
    tile = known.selectExpr("1L token", "array(sid) centres", "sid", "cast(n as int) n")
    nobody = spark.createDataFrame([], "node long, root long")
    found = {tuple(r) for r in j.open_pairs(tile, sets.drop("bits", "hashes"), nobody).collect()}
    own = {r["sid"]: np.frombuffer(r["hashes"], np.uint64) for r in sets.collect()}
    linked = {(a, b) for a in own for b in own if a < b and j.enough(j.overlap(own[a], own[b]), len(own[a]), len(own[b]))}
    assert linked <= found and len(linked) > 20


def test_only_sets_in_a_pair_send_their_hashes(spark, monkeypatch):
    keep, plans = j.written, {}

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return keep(df, label)

    monkeypatch.setattr(j, "written", seen)
    text = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [(k, f"{text} {x}", "en", "a", 1) for k, x in enumerate(("1", "2", "3"))]
    assert found(frame(spark, rows)) == plain(rows)
    assert plans["links"].count("LeftSemi") == 2


def test_large_cells_give_no_more_rows_than_they_have(spark, monkeypatch):
    """A group of copies of which only some link: its pairs stay in their cells, and the links of it suffice."""
    rnd = random.Random(13)
    base = [f"w{rnd.randint(0, 500)}" for _ in range(150)]
    rows = [(k, varied(" ".join(base), rnd, rnd.choice([0.01, 0.03, 0.05])), "en", "a", 1) for k in range(200)]
    docs = frame(spark, rows)
    known = j.classes(docs, "doc_id", "text")
    sets = j.sets_of(docs, known, known.select("sid"), "doc_id", "text")
    tile = known.selectExpr("1L token", "array(sid) centres", "sid", "cast(n as int) n").distinct()
    nobody = spark.createDataFrame([], "node long, root long")
    own = {r["sid"]: np.frombuffer(r["hashes"], np.uint64) for r in sets.collect()}
    linked = {(a, b) for a in own for b in own if a < b and j.enough(j.overlap(own[a], own[b]), len(own[a]), len(own[b]))}
    assert len(linked) > 5 * len(own)
    keep, counts = j.written, {}

    def counted(df, label):
        out = keep(df, label)
        counts[label] = out.count()
        return out

    monkeypatch.setattr(j, "written", counted)
    assert j.open_pairs(tile, sets, nobody).count() <= j.FEW // 2 * len(own)
    links = j.open_links(tile, sets, nobody)
    # Each set stands in two bands; a band's rows are in one block here.
    assert counts["open-rows"] <= 2 * len(own) and counts["open-links"] < 2 * len(own)
    assert {tuple(r) for r in links.collect()} <= linked
    whole = components(spark.createDataFrame(sorted(linked), "a long, b long"))
    assert sorted(components(links).collect()) == sorted(whole.collect())


def test_all_sizes_of_cells_give_the_same_groups(spark, monkeypatch):
    rows = corpus(14)
    monkeypatch.setattr(j, "FEW", 3)
    monkeypatch.setattr(j, "BLOCK_HASHES", 1000)
    assert found(frame(spark, rows)) == plain(rows)


def test_large_cells_send_hashes_of_sets_near_by_whole_bitmaps(spark, monkeypatch):
    """Sets that share a passage and do not link: brief bitmaps let them through, whole ones do not."""
    keep, counts, plans = j.written, {}, {}

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        out = keep(df, label)
        counts.setdefault(label, []).append(out.count())
        return out

    rnd = random.Random(15)
    base = [f"w{k}" for k in range(304)]
    rows = [(k, " ".join(base + [f"x{rnd.randint(0, 10**6)}" for _ in range(70)]), "en", "a", 1) for k in range(100)]
    rows += [(100 + k, rows[k][1] + " end", "en", "a", 1) for k in range(5)]
    docs = frame(spark, rows)
    known = j.classes(docs, "doc_id", "text")
    sets = j.sets_of(docs, known, known.select("sid"), "doc_id", "text")
    tile = known.selectExpr("1L token", "array(sid) centres", "sid", "cast(n as int) n")
    monkeypatch.setattr(j, "written", seen)
    links = j.open_links(tile, sets, spark.createDataFrame([], "node long, root long"))
    sid = {r["doc_id"]: r["sid"] for r in known.collect()}
    assert {tuple(r) for r in links.collect()} == {tuple(sorted((sid[k], sid[100 + k]))) for k in range(5)}
    # Each set stands in two bands.
    assert counts["open-rows"][0] >= 100 and counts["open-rows"][-1] <= 2 * 10
    assert plans["open-links"].count("LeftSemi") == 1


def test_only_sets_of_repeated_rows_are_shuffled(spark, monkeypatch):
    keep, plans = j.written, {}

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return keep(df, label)

    monkeypatch.setattr(j, "written", seen)
    text = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [(None, text), (None, text), (1, text), (2, text + " 2"), (2, text + " 2"), (2, text + " 3"), (3, "a b"), (4, None)]
    docs = frame(spark, [(*r, "en", "a", 1) for r in rows])
    known = j.classes(docs, "doc_id", "text")
    sets = j.sets_of(docs, known, known.where("n > 0").select("sid"), "doc_id", "text")
    assert sorted(r["sid"] for r in sets.collect()) == sorted({j.set_id(shingles(t)) for _, t in rows if t})
    # The other sets are made first, and nothing is grouped above them.
    assert plans["sets"].index("MapInArrow") < plans["sets"].index("Aggregate")
    assert found(docs) == plain([(*r, "en", "a", 1) for r in rows])
