"""The source divergence audit and phrase mining against plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import LONG, ROWS, SCHEMA, frame

from noticeworks.llm import divergence, phrases

# Source divergence audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
A_Z = {k: k + 32 for k in range(65, 91)}


def plain_audit(rows):
    used, documents = defaultdict(Counter), defaultdict(Counter)
    sources = defaultdict(set)
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(A_Z))
        used[lang, source].update(terms)
        documents[lang].update(set(terms))
        sources[lang].add(source)
    out = []
    for lang in sources:
        kept = sorted((t for t, n in documents[lang].items() if n >= 3), key=str.encode)
        counts = {s: [used[lang, s][t] for t in kept] for s in sources[lang]}
        whole = [sum(counts[s][k] for s in counts) for k in range(len(kept))]

        def shares(values):
            return [1 + 1000000000 * (n + 1) // (sum(values) + len(kept)) for n in values]

        q_lang = shares(whole)
        for s in sources[lang]:
            p = shares(counts[s])
            pairs = [(o, sum((a - b) ** 2 // b for a, b in zip(p, shares(counts[o])))) for o in sources[lang] if o != s]
            terms = [(t, (a - b) ** 2 // b) for t, a, b, n in zip(kept, p, q_lang, counts[s]) if n > 0 and a > b]
            for part, items, first in (("pair", pairs, None), ("term", terms, 200)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:first]
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return sorted(out)


def audited(spark, rows, **extra):
    return sorted(tuple(r) for r in divergence.audit(frame(spark, rows, extra)).collect())


def test_audit_of_odd_rows(spark):
    assert audited(spark, ROWS, n="x", term="y", value="z") == plain_audit(ROWS)


def test_audit_of_ties_and_hot_groups(spark, monkeypatch):
    """A third of the rows in one source, words that all sources share, many terms of one value at rank 200."""
    monkeypatch.setattr(divergence, "HELD", 50)
    rnd = random.Random(7)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(500)] + ["Été", "日本", "the"]
    rows = []
    for k in range(400):
        source = "hot" if k % 3 == 0 else rnd.choice(["a", "b", "é", "z", None])
        rows.append((k, " ".join(rnd.choices(words, k=30)) + " the THE", rnd.choice(["en", "en", None]), source, 1))
    rows.append((500, None, "en", "silent", 1))
    rows.append((501, "twice only", "fr", "x", 1))
    rows.append((502, "twice only", "fr", "y", 1))
    expected = plain_audit(rows)
    assert audited(spark, rows) == expected
    assert any(r[2] == "term" and r[5] == 200 for r in expected)
    assert [r[4] for r in expected if r[0] == "fr"] == [0, 0]


def test_audit_of_an_empty_table(spark):
    assert audited(spark, []) == []


# Phrases


def plain_phrases(rows, first=2000, least=10):
    counts, sizes = defaultdict(Counter), Counter()
    for _, text, lang, _, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(A_Z)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in (1, 2, 3):
                counts[lang].update(zip(*[words[i:] for i in range(k)]))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in candidates.items():
            if any(
                100 * b >= 50 * a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, b in candidates.items()
            ):
                continue
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:first]):
            out.append((lang, rank + 1, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def mined(spark, rows, **extra):
    return sorted(tuple(r) for r in phrases.collocations(frame(spark, rows, extra)).collect())


def some_rows(seed, words, n=120, size=60):
    rnd = random.Random(seed)
    weights = [1 / (k + 1) for k in range(len(words))]
    ends = [" ", " ", " ", " ", "  ", "\t", ". ", ", ", "\n"]
    made = lambda: "".join(w + rnd.choice(ends) for w in rnd.choices(words, weights, k=size))
    return [(k, made(), rnd.choice(["en", "de", None]), "s", 1) for k in range(n)]


@pytest.mark.parametrize(("held", "at_once"), [(1 << 20, 1 << 18), (60, 1 << 18), (1 << 20, 7)])
def test_phrases_of_ties_and_spills(spark, monkeypatch, held, at_once):
    monkeypatch.setattr(phrases, "HELD", held)
    monkeypatch.setattr(phrases, "AT_ONCE", at_once)
    monkeypatch.setattr(phrases, "BURST", 16)
    monkeypatch.setattr(phrases, "BLOCK", 8)
    rows = some_rows(3, ["the", "OF", "and", "zéro", "\x00a", "a\x00", "\x01", "日本", "\x1c", "b", "ab", "\U0001f600", "￮"])
    rows += [(900 + k, "new york city hall", "en", "s", 1) for k in range(30)]
    assert mined(spark, rows, words="x", n="y", phrase="z") == plain_phrases(rows)


def test_phrases_of_odd_rows(spark):
    rows = ROWS + [(50 + k, "one two three", "de", "b", 13) for k in range(12)] + [(99, LONG, "", "a", 1)]
    assert mined(spark, rows) == plain_phrases(rows)


def test_phrases_of_an_empty_table_and_without_words(spark):
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert mined(spark, [(1, None, "en", "a", 1), (2, " .\t", None, "a", 1)]) == []


def test_runs_leave_in_few_blocks(spark):
    """A task that holds all its entries hands them on once: a block for each partition and language at most."""
    rows = some_rows(5, [f"w{k}" for k in range(300)], n=600)
    blocks = phrases.runs(frame(spark, rows).coalesce(1), 8).groupBy("lang", "part").count().collect()
    assert len(blocks) == 24 and all(r["count"] <= 4 for r in blocks)


def test_a_trie_counts_and_spills_whole(monkeypatch):
    monkeypatch.setattr(phrases, "BURST", 64)
    rnd = np.random.default_rng(5)
    trie, whole = phrases.Trie(), Counter()
    for _ in range(20):
        numbers = np.minimum(rnd.zipf(1.3, 300), 500) - 1
        keys = phrases.keys_of(numbers)
        trie.add(keys)
        whole.update(keys.tolist())
    assert len(trie.lows) > 10 and trie.lows == sorted(trie.lows)
    assert trie.size == len(whole) == sum(x.size for x in trie.containers)
    found = Counter()
    for left in (trie.size // 2, 0):
        found.update(dict(zip(*[x.tolist() for x in trie.spill(left)])))
        assert trie.size <= left
    assert found == whole


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3 * 10**12 + 7
    df = spark.createDataFrame([(big, big + 1, big + 5)], "a long, l long, r long")
    value = df.select(phrases.score(*[df[c] for c in "alr"])).first()[0]
    assert value == 1000000 * big * big // ((big + 1) * (big + 5))
