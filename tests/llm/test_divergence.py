"""The divergence audit and its transducers against plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from daybook.llm.divergence import audit
from daybook.llm.transducer import Transducer, build

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, term string, ord long, p int, n int"


def spans(words):
    ends = np.cumsum([len(w) for w in words]) if words else np.zeros(0, np.int64)
    return np.frombuffer(b"".join(words), np.uint8), ends - [len(w) for w in words], ends


@settings(max_examples=150, deadline=None)
@given(st.sets(st.binary(max_size=6)), st.lists(st.binary(max_size=6), max_size=20))
def test_transducer(known, others):
    ordered = sorted(known)
    machine = Transducer(build(ordered), 7)
    queries = ordered + others
    place = {w: 7 + k for k, w in enumerate(ordered)}
    assert machine.places(*spans(queries)).tolist() == [place.get(w, -1) for w in queries]
    assert [machine.word(7 + k) for k in range(len(ordered))] == ordered
    assert len(machine) == len(ordered)


def test_transducer_is_minimal():
    words = sorted(f"{a}{b}{c}".encode() for a in "abcd" for b in "efgh" for c in ("ing", "ed", "s"))
    # one state per distinct set of endings: start, after the first and second letter, and within ing, ed and s
    endings = {tuple(sorted(w[k:] for w in words if w[:k] == prefix)) for w in words for k in range(len(w) + 1) for prefix in [w[:k]]}
    assert len(build(words)["final"]) == len(endings)


def brute(rows, min_docs, top):
    langs = defaultdict(lambda: (Counter(), defaultdict(Counter)))
    for text, lang, source in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        docs, by_source = langs[lang or ""]
        docs.update(set(terms))
        by_source[source or ""].update(terms)
    out = set()
    for lang, (docs, by_source) in langs.items():
        kept = sorted((t for t, n in docs.items() if n >= min_docs), key=str.encode)

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in by_source.items()}
        q = shares(sum(by_source.values(), Counter()))
        for s in p:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in p if o != s]
            out |= {(lang, s, "pair", o, -f, k + 1) for k, (f, _, o) in enumerate(sorted(pairs))}
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if by_source[s][t] and p[s][t] > q[t]]
            out |= {(lang, s, "term", t, -f, k + 1) for k, (f, _, t) in enumerate(sorted(terms)[:top])}
    return out


def rows_of(seed=9, n=400):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("Ab", "ab", "é", "Éz", "日本", "x", "zz", " q", "q\x85") for b in ("", "a", "B", "ö", "ing")] + ["tie" + c for c in "abcdefgh"]
    rows = [(" ".join(rng.choice(words) + rng.choice(["", "1", "-", "_"]) for _ in range(rng.randint(0, 30))),
             rng.choice(["en", "en", "en", "de", None, ""]), rng.choice(["hot", "hot", "s1", "s2", None, "ä"])) for _ in range(n)]
    rows += [(None, "en", "s9"), ("", "fr", "a"), ("12 34", "fr", "b"), ("x" * 70_000 + " ab " * 30_000, "en", "s1"), rows[0], rows[0]]
    return rows


def docs_of(spark, rows):
    return spark.createDataFrame([(1, *r, "t", 3, 4, 5) for r in rows], DOCS)


@pytest.mark.parametrize("limits", [{}, {"shard_terms": 7, "round_bytes": 1}, {"shard_terms": 20, "round_bytes": 1500}])
def test_audit(spark, limits):
    rows = rows_of()
    found = audit(docs_of(spark, rows), min_docs=4, top=6, **limits).collect()
    assert len(found) == len(set(map(tuple, found)))
    assert set(map(tuple, found)) == brute(rows, 4, 6)


def test_blocks_of_ordinals(spark, monkeypatch):
    from daybook.llm import divergence

    monkeypatch.setattr(divergence, "BLOCK", 4)
    monkeypatch.setattr(divergence, "HELD", 10)
    rows = rows_of(seed=2, n=150)
    found = audit(docs_of(spark, rows), min_docs=2, top=50).collect()
    assert set(map(tuple, found)) == brute(rows, 2, 50)


def test_nothing_kept(spark):
    assert audit(docs_of(spark, [])).collect() == []
    found = audit(docs_of(spark, [("a b", "en", "x"), ("c", "en", "y"), (None, None, None)])).collect()
    assert set(map(tuple, found)) == {("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)}
