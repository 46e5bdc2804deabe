"""The interaction audit of five filters against a plain loop over all orders."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest

from daybook.llm import filter_audit
from daybook.llm.filter_audit import audit, possible_repeats, repeated_slots

DOCS = "doc_id long, text string, source string, id string, n int, fails string, slot long"


def docs_of(spark, rows):
    """Documents with further columns of names that the operator uses itself."""
    return spark.createDataFrame([(*r, "x", 7, "ABC", 3) for r in rows], DOCS)


def rows_of(seed=5):
    rng = random.Random(seed)
    texts = ["", None, " \t\n", "one", "ONE", "a & b", "Ä" * 300, "X" * 70_000, "w " * 40_000, "\x0b\x1c word"]
    texts += [" ".join(rng.choice(["the", "of", "Word", "x%", f"u{rng.random()}"]) for _ in range(rng.choice([5, 150, 250]))) for _ in range(60)]
    texts += [" ".join(f"w{rng.random()}" for _ in range(230)) for _ in range(15)]
    rows = [(k, rng.choice(texts), rng.choice(["s1", "s1", "s2", None, ""])) for k in range(300)]
    return rows + [rows[3], rows[3], (5, "other text", "s2"), (None, "one", "s1"), (None, None, "s3")]


def brute(rows, labels):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    good, toxic = ({i for i, *m in labels if m[k] == 1} for k in (0, 1))
    counts = {}
    for i, t, part in rows:
        t = t or ""
        w = word.findall(t)
        fails = "A" * (len(w) < 200) + "B" * (100 * len(set(w)) < 50 * len(w))
        fails += "C" * (100 * len(re.findall("[A-Z]", t)) > 2 * len(t)) + "D" * bool(re.search("[#$%&*|]", t))
        fails += "E" * (i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows))
        counts.setdefault(part or "", Counter())[fails, i is not None and i in good, i is not None and i in toxic] += 1
    out = {}
    for part, cells in counts.items():
        for order in map("".join, permutations("ABCDE")):
            for k, letter in enumerate(order):
                c = Counter()
                for (fails, g, x), n in cells.items():
                    there = not set(fails) & set(order[:k])
                    fail = letter in fails
                    c["kept"] += n * (there and not fail)
                    c["removed"] += n * (there and fail)
                    c["redundant"] += n * (fail and not there)
                    c["unique_fails"] += n * (fails == letter)
                    c["good_lost"] += n * (there and fail and g)
                    c["toxic_lost"] += n * (there and fail and x)
                out[part, order, k + 1] = c
        for letter in "ABCDE":
            total = sum(c["removed"] for (p, o, k), c in out.items() if p == part and o[k - 1] == letter)
            for (p, o, k), c in out.items():
                if p == part and o[k - 1] == letter:
                    c["shapley"] = total
    return {(*key, *(c[n] for n in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))) for key, c in out.items()}


@pytest.mark.parametrize("slots", [filter_audit.MAX_SLOTS, 4096])
def test_all_orders(spark, monkeypatch, slots):
    rows = rows_of()
    labels = [(k, k % 2, k % 3 == 0) for k in range(0, 300, 2)] + [(4, 0, 1), (None, 1, 1), (7, None, 1), (10_000, 1, 1)]
    labels = [(i, g, None if x is None else int(x)) for i, g, x in labels]
    marks = spark.createDataFrame([(*r, "y") for r in labels], "doc_id long, quality int, toxic int, part string")
    found = audit(docs_of(spark, rows), marks, max_slots=slots).collect()
    assert len(found) == len(set(map(tuple, found)))
    assert set(map(tuple, found)) == brute(rows, labels)


def test_empty_tables(spark):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit(docs_of(spark, []), marks).collect() == []
    assert audit(docs_of(spark, [(1, None, None)]), marks).count() == 600


def test_prepass_loses_no_repeat(spark):
    digests = spark.range(4000).selectExpr("unhex(sha2(string(id % 3000), 256)) as digest", "id")
    for slots in (4096, 1 << 16):
        left = possible_repeats(digests, repeated_slots(digests, slots), slots)
        assert {r.id % 3000 for r in left.collect()} >= set(range(1000))
    # with 16 slots a row hardly a unique text passes
    assert left.where("id between 1000 and 2999").count() < 200
