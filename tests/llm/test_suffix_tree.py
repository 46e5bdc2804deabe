"""Scores of the suffix tree against a plain implementation with dictionaries."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from daybook.llm import suffix_tree
from daybook.llm.suffix_tree import score

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
END = object()
DOCS = "doc_id long, text string, id string, row long, word string, score double, held_out int"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "w", 0.5, 2) for r in rows], DOCS)


def rows_of(seed, n=260):
    rng = random.Random(seed)
    after = {w: [rng.choice("abcdefghijklmnop") + rng.choice(["", "X", "é", "日"]) for _ in range(4)] for w in "abcdefghijklmnop"}
    rows = []
    for k in range(n):
        w, out = rng.choice("abcdefghijklmnop"), []
        for _ in range(rng.randint(0, 60)):
            out.append(w if rng.random() < 0.93 else f"rare{rng.randint(0, 300)}")
            if rng.random() < 0.1:  # what follows depends on the word three places before
                out += rng.choice([["one", "s", "t", "first"], ["two", "s", "t", "second"]])
            w = rng.choice(after[w[0].lower()] if w[0].lower() in after else "abc") if rng.random() < 0.8 else rng.choice("abcdefghijklmnop")
        rows.append((k, rng.choice([" ", "\n", "\t "]).join(out)))
    rows += [(1001, None), (1002, ""), (1003, " \x0b "), (None, "a b c"), (1004, "y" * 70_000), (1005, "a b " * 20_000), rows[0], rows[0], rows[4]]
    return rows


def brute(rows, depth, word_share, context_share, pair_share, min_gain):
    texts = [(i, zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + [END]) for i, t in rows]
    train = [t for _, out, t in texts if not out]
    c = Counter(w for t in train for w in t)
    total, vocabulary = sum(c.values()), len(c)
    common = {w for w in c if w is END or c[w] >= max(1, math.ceil(word_share * total))}
    least_context, least_pair = max(4, math.ceil(context_share * total)), max(2, math.ceil(pair_share * total))

    def before(t, k, size):
        """The words before place k, the latest first; None if they do not form a context."""
        start = [END, *t]
        if k + 1 < size or any(w not in common for w in start[k + 1 - size : k + 1]):
            return None
        return tuple(reversed(start[k + 1 - size : k + 1]))

    seen = defaultdict(Counter)
    for t in train:
        for k, w in enumerate(t):
            for size in range(1, depth + 1):
                s = before(t, k, size)
                if s is not None:
                    seen[s][w] += 1
    size_of = {s: sum(f.values()) for s, f in seen.items()}
    root = lambda w: (c[w] + 1) / (total + vocabulary + 1)
    p, rest, gain = {}, {}, {}
    for s in sorted((s for s in seen if size_of[s] >= least_context), key=len):
        f = {w: n for w, n in seen[s].items() if w in common and n >= least_pair}
        rest[s] = 1 - sum((n - 0.75) / size_of[s] for n in f.values())
        short = {w: p[s[:-1]][w] if len(s) > 1 else root(w) for w in f}
        p[s] = {w: (n - 0.75) / size_of[s] + rest[s] * short[w] for w, n in f.items()}
        gain[s] = sum(n * math.log2(p[s][w] / short[w]) for w, n in f.items())
    kept = {s[:k] for s in p if p[s] and gain[s] >= min_gain for k in range(1, len(s) + 1)}

    def probability(s, w):
        while s and s not in kept:
            s = s[:-1]
        if not s:
            return root(w)
        return p[s][w] if w in p[s] else rest[s] * probability(s[:-1], w)

    def longest(t, k):
        return next((s for size in range(depth, 0, -1) if (s := before(t, k, size)) in kept), ())

    for s in list(kept)[:20]:  # every distribution adds up to one, unknown words being one
        assert math.isclose(sum(probability(s, w) for w in c) + probability(s, "unknown"), 1, rel_tol=1e-9)
    out = []
    for i, held, t in texts:
        out.append((i, held, len(t), sum(c[w] > 0 for w in t), total, sum(math.log10(root(w)) for w in t),
                    sum(math.log10(probability(longest(t, k), w)) for k, w in enumerate(t))))
    return out, kept


@pytest.mark.parametrize("depth,shares", [(3, (5e-7, 1e-6, 2.5e-7, 16.0)), (2, (0.004, 0.003, 0.0005, 4.0)), (3, (0.002, 0.0005, 0.0002, 25.0)), (1, (1.0, 1.0, 1.0, 1.0))])
def test_scores(spark, depth, shares):
    rows = rows_of(4)
    want, kept = brute(rows, depth, *shares)
    assert {len(s) for s in kept} == (set(range(1, depth + 1)) if depth > 1 else set())
    names = ("word_share", "context_share", "pair_share", "min_gain")
    found = score(docs_of(spark, rows), depth=depth, **dict(zip(names, shares))).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    want, found = sorted(want, key=key), sorted(map(tuple, found), key=key)
    assert [r[:5] for r in found] == [r[:5] for r in want]
    for a, b in zip(found, want):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_flushing_changes_nothing(spark, monkeypatch):
    rows = rows_of(6, 80)
    monkeypatch.setattr(suffix_tree, "HELD", 5)
    monkeypatch.setattr(suffix_tree, "SLICE", 300)
    found = sorted(r[-1] for r in score(docs_of(spark, rows)).collect())
    assert found == pytest.approx(sorted(r[-1] for r in brute(rows, 3, 5e-7, 1e-6, 2.5e-7, 16.0)[0]), rel=1e-9)


def test_nothing_to_learn_from(spark):
    assert score(docs_of(spark, [])).collect() == []
    out = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    found = [tuple(r) for r in score(docs_of(spark, [(out, "a b"), (out, None)])).collect()]
    assert sorted(found) == [(out, True, 1, 0, 0, 0.0, 0.0), (out, True, 3, 0, 0, 0.0, 0.0)]


def test_better_than_words_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = score(docs).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert found["sum(score)"] > 0.97 * found["sum(base_score)"]


def test_larger_corpus_keeps_rare_contexts(spark):
    """What occurs five times is learned, however large the rest is."""
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 7 != 2][:6]
    rows = [(i, "alpha beta gamma delta") for i in ids[:5]] + [(ids[5], "x " * 6_000_000)]
    found = {r.doc_id: r for r in score(docs_of(spark, rows)).collect()}
    assert found[ids[5]].n_tokens == 6_000_001
    for i in ids[:5]:
        assert found[i].base_score < -20 and found[i].score > -1


@pytest.mark.parametrize("share", [0.02, 2.0])
def test_words_outside_the_dictionary(spark, monkeypatch, share):
    monkeypatch.setattr(suffix_tree, "DICTIONARY_SHARE", share)
    monkeypatch.setattr(suffix_tree, "SLICE", 300)
    rows = rows_of(8, 80)
    found = sorted(r[-1] for r in score(docs_of(spark, rows)).collect())
    assert found == pytest.approx(sorted(r[-1] for r in brute(rows, 3, 5e-7, 1e-6, 2.5e-7, 16.0)[0]), rel=1e-9)


def test_one_row_of_sums_for_each_text(spark, monkeypatch):
    """However many groups the tokens of a text are dealt to, and the stored chunks are not shuffled again to get their numbers."""
    monkeypatch.setattr(suffix_tree, "HELD", 500)
    monkeypatch.setattr(suffix_tree, "STEP", 7)
    monkeypatch.setattr(suffix_tree, "SLICE", 300)
    real, counted, plans = suffix_tree._sums, [], []

    def sums(windows, *rest):
        plans.append(windows._jdf.queryExecution().executedPlan().toString())
        out = real(windows, *rest)
        counted.append(out.count())
        return out

    monkeypatch.setattr(suffix_tree, "_sums", sums)
    rows = rows_of(5, 80)
    found = sorted(r[-1] for r in score(docs_of(spark, rows)).collect())
    assert found == pytest.approx(sorted(r[-1] for r in brute(rows, 3, 5e-7, 1e-6, 2.5e-7, 16.0)[0]), rel=1e-9)
    assert counted == [len(rows)]
    assert "Bucketed: true" in plans[0]
