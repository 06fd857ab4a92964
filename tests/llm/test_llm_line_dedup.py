import random
from collections import Counter

from cases import ROWS, frame

from noticeworks.llm import line_dedup as d
from noticeworks.llm import stages


def plain(rows, least=d.MIN_CHARACTERS):
    """What is left of each row, found by comparing the bytes of all pairs of lines."""
    cut = {}
    for key in rows:
        lines = (key[1] or "").split("\n")
        places = [k for k, x in enumerate(lines) if x.strip()]
        cut[key[:2]] = lines, places, ["\n".join(lines[i : j + 1]) for i, j in zip(places, places[1:])]
    ordered = sorted(cut, key=lambda r: (r[0] is not None, r[0] or 0))
    first, found = {}, Counter()
    for key in ordered:
        for k, body in enumerate(cut[key][2]):
            first.setdefault(body, (key, k))
            found[body] += 1
    left = []
    for key in rows:
        lines, places, bodies = cut[key[:2]]
        own = [(key[:2], k) for k in range(len(bodies))]
        stay = {j for k, body in enumerate(bodies) if found[body] > 1 and first[body] == own[k] for j in (k, k + 1)}
        gone, k = set(), 0
        while k < len(bodies):
            end = k
            if first[bodies[k]] != own[k]:
                doc, place = first[bodies[k]]
                while end + 1 < len(bodies) and first[bodies[end + 1]] == (doc, place + end + 1 - k) != own[end + 1]:
                    end += 1
                if sum(map(len, lines[places[k] : places[end + 1] + 1])) >= least:
                    gone |= set(range(k, end + 2)) - stay
            k = end + 1
        if gone and len(gone) == len(places):
            left.append((key[0], ""))
            continue
        dropped = {places[k] for k in gone}
        dropped |= {j for k in gone if k - 1 in gone for j in range(places[k - 1], places[k])}
        text = key[1] if key[1] is None else "\n".join(x for k, x in enumerate(lines) if k not in dropped)
        left.append((key[0], text))
    return left


def order(rows):
    return sorted(rows, key=repr)


def lines(seed, n):
    rnd = random.Random(seed)
    return [" ".join(rnd.choice(["a", "bc", "def", "gh"]) + str(rnd.randint(0, 999)) for _ in range(6)) for _ in range(n)]


def test_rolling_hashes_depend_on_their_two_lines_only():
    passage = lines(1, 40)
    own = set(map(tuple, d.pair_hashes("\n".join(passage)).tolist()))
    assert len(own) == 39
    for s in range(2, 9):
        text = "\n".join(lines(s, s) + passage + lines(s + 50, 7))
        assert own <= set(map(tuple, d.pair_hashes(text).tolist()))
    assert d.pair_hashes("a\nb").tolist() != d.pair_hashes("a\n\nb").tolist() != d.pair_hashes("a\n \nb").tolist()


def test_against_brute_force(spark):
    shared, rnd = [lines(k, 12) for k in range(3)], random.Random(9)
    rows = []
    for k in range(80):
        own = lines(100 + k, rnd.randint(0, 9))
        place = rnd.randint(0, len(own))
        rows.append((k, "\n".join(own[:place] + rnd.choice(shared) + own[place:]), "en", "a", 1))
    rows += [(k + 100, rows[k][1], "en", "b", 1) for k in range(20)]
    out = d.remove_repeated_chunks(frame(spark, rows))
    assert order((r["doc_id"], r["text"]) for r in out.collect()) == order(plain(rows))
    assert sum(r["n_removed_lines"] for r in out.collect()) > 500


def test_chunks_within_one_document(spark):
    chunk = "\n".join(lines(1, 10))
    rows = [(1, "\n".join([chunk, "x y", chunk]), "en", "a", 1)]
    out = d.remove_repeated_chunks(frame(spark, rows)).first()
    assert out["text"] == plain(rows)[0][1] and out["n_removed_lines"] > 4


def test_odd_rows_and_names(spark):
    df = frame(spark, extra={"removed": "x", "_kept": "y"})
    out = d.remove_repeated_chunks(df)
    assert set(out.columns) == {*df.columns, "n_removed_lines"}
    assert order((r["doc_id"], r["text"]) for r in out.collect()) == order(plain(ROWS))


def test_a_copy_loses_all_its_lines(spark):
    rows = [(k, "\n".join(lines(k % 9, 2 + k % 9)), "en", "a", 1) for k in range(36)]
    out = d.remove_repeated_chunks(frame(spark, rows)).collect()
    assert {r["doc_id"] for r in out if r["text"]} == set(range(9)) and len(out) == 36


def test_clean_documents_stay(spark):
    rows = [(k, "\n".join(lines(k, 9)), "en", "a", 1) for k in range(30)]
    out = d.remove_repeated_chunks(frame(spark, rows))
    assert order((r["doc_id"], r["text"]) for r in out.collect()) == order(r[:2] for r in rows)


def test_blank_lines_are_no_pair():
    assert len(d.pair_hashes("\n" * 50)) == len(d.pair_hashes("one\n\n\n\n")) == len(d.pair_hashes("")) == 0


def texts_left(spark, rows, **options):
    out = d.remove_repeated_chunks(frame(spark, rows), **options).collect()
    return [(r["doc_id"], r["text"]) for r in sorted(out, key=lambda r: (r["doc_id"] or 0, r["text"] or ""))]


def test_a_passage_stays_whole_where_it_stood_first(spark):
    x, a, b, c, e = lines(3, 5)
    rows = [(k, "\n".join(t), "en", "a", 1) for k, t in enumerate([(x, a, b), (a, b, c), (b, c, e)])]
    assert texts_left(spark, rows) == [(0, f"{x}\n{a}\n{b}"), (1, f"{b}\n{c}"), (2, e)]


def test_short_chunks_stay(spark):
    rows = [(k, f"{lines(k, 1)[0]}\n    }}\n}}\n{lines(k + 50, 1)[0]}", "en", "a", 1) for k in range(4)]
    assert texts_left(spark, rows) == [r[:2] for r in rows]
    assert {n.count("}") for _, n in texts_left(spark, rows, least=2)} == {2, 0}


def test_rows_of_equal_or_null_ids_are_compared(spark):
    shared = "\n".join(lines(8, 3))
    rows = [(i, f"{lines(20 + k, 1)[0]}\n{shared}", "en", "a", 1) for k, i in enumerate([None, None, 5, 5])]
    out = [text for _, text in texts_left(spark, rows)]
    assert sorted(shared in x for x in out) == [False, False, False, True]
    assert sorted(x.count("\n") for x in out) == [0, 0, 0, 3]
    # Equal rows are one document.
    assert texts_left(spark, [rows[0], rows[0]]) == [rows[0][:2]] * 2


def test_a_hash_of_different_bytes_is_left_alone(spark, monkeypatch):
    """With all rolling hashes equal, what stands for them differs and nothing may go."""
    rows = [(k, "\n".join(lines(k, 3)), "en", "a", 1) for k in range(6)]
    pairs = d.pair_table(frame(spark, rows), "doc_id", "text")
    one = pairs.select("_dedup_id", "_dedup_text", "pair", (pairs["high"] * 0).alias("high"), (pairs["low"] * 0).alias("low"))
    monkeypatch.setattr(d, "pair_table", lambda *_: one)
    assert texts_left(spark, rows) == [r[:2] for r in rows]


def test_empty_table(spark):
    assert d.remove_repeated_chunks(frame(spark, [])).count() == 0


def repeated_lines(rows):
    """Of each row, by comparing all pairs of lines: the lines that stand, with a neighbour, in an earlier document."""
    seen, out = set(), []
    for _, text, *_ in rows:
        own = text.split("\n")
        pairs = list(zip(own, own[1:]))
        out.append({k + j for k, pair in enumerate(pairs) if pair in seen for j in (0, 1)})
        seen |= set(pairs)
    return out


def test_short_passages_between_other_lines(spark):
    rnd, rows = random.Random(4), []
    for size in range(2, 9):
        for k in range(30):
            passage, own = lines(1000 * size + k, size), [lines(rnd.random(), 6) for _ in range(2)]
            for half, before in zip(own, (rnd.randint(1, 5), rnd.randint(1, 5))):
                rows.append((len(rows), "\n".join(half[:before] + passage + half[before:]), "en", "a", 1))
    wanted = repeated_lines(rows)
    assert sum(map(len, wanted)) == 30 * sum(range(2, 9))
    out = {r["doc_id"]: r for r in d.remove_repeated_chunks(frame(spark, rows)).collect()}
    for k, (gone, row) in enumerate(zip(wanted, rows)):
        kept = [x for n, x in enumerate(row[1].split("\n")) if n not in gone]
        assert out[k]["text"] == "\n".join(kept)
        assert out[k]["n_removed_lines"] == len(gone) == sum(p["lines"] for p in out[k]["removed"])
        assert len(out[k]["removed"]) == (1 if gone else 0)


def test_blank_lines_within_and_around_a_passage(spark):
    a, b, c, x, y = lines(5, 5)
    texts = [f"{a}\n\n{b}\n{c}", f"{x}\n{a}\n\n{b}\n{y}", f"\n{c}\n{x}\n\n", f"\n{c}\n{x}\n\n", f"{x}\n\n{c}\n{y}"]
    out = d.remove_repeated_chunks(frame(spark, [(k, t, "en", "a", 1) for k, t in enumerate(texts)])).collect()
    assert [r["text"] for r in sorted(out)] == [texts[0], f"{x}\n{y}", texts[2], "", texts[4]]


def test_runs_of_one_line_keep_a_passage(spark):
    rows = [(k, "\n".join(["a b"] * n), "en", "a", 1) for k, n in ((1, 5), (2, 3))]
    assert texts_left(spark, rows, least=1) == [(1, "a b\na b"), (2, "")]


def test_a_filter_on_what_is_left_does_not_cut_texts_twice(spark):
    left = d.remove_repeated_chunks(frame(spark))
    for df in (left.where("text <> ''"), stages.lines(spark, frame(spark), "")):
        assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
