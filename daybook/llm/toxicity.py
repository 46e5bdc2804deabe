"""Toxicity scores from a learned lexicon, its misspellings and the words around them.

1. Labelled rows (at most ``MAX_LABELLED``, drawn by a hash of the id) give document counts per word. Words that are much more
   frequent in toxic rows form the lexicon, at most ``MAX_TERMS``.
2. The lexicon is a trie. Its intersection with the Levenshtein automaton of distance one is determinised once, into
   a table of states and symbols; all words of about a megabyte of text run through it together.
3. Each match is judged in its window of text: inside quotation marks or after a word of reporting it is a quotation, with a
   word of address it is direct. Every kind of match of a term (exact or misspelt, quoted or not) has its own log odds.
4. A logistic model over the log odds and numbers of matches gives the score. Language, source, id and labels are no inputs of it.

Only the bounded labelled sample and the model pass the driver; scoring runs in the scan of the documents, without a shuffle.
Null texts count as empty; an empty text has the score of a text without matches. Rows without a label or id do
not train. Without labelled rows of both kinds every score is 0. Repeated rows are scored each, repeated labels train each.
"""

from __future__ import annotations

import math
import re
import sys
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import slices, store, tidy

MAX_LABELLED = 10_000
MAX_TERMS = 256
MIN_ODDS = 2.5
FUZZY_LENGTH = 5
THRESHOLD = 0.7
WINDOW = 48

TOP = sys.maxunicode


def _inside(c: str) -> bool:
    """Whether a sign can stand in a word: letters, digits and the marks written with them, but not those that choose the look of a symbol."""
    return c.isalnum() or (unicodedata.category(c) in ("Mn", "Mc") and not ("\ufe00" <= c <= "\ufe0f" or "\U000e0100" <= c <= "\U000e01ef"))


_SIGNS = list(map(chr, range(TOP + 1)))
ALNUM = np.fromiter(map(_inside, _SIGNS), bool, TOP + 1)
LOWER = np.fromiter((ord(x) if len(x) == 1 else i for i, x in enumerate(map(str.lower, _SIGNS))), np.int32, TOP + 1)
# typographic apostrophe and hyphens are read as the plain ones
LOWER[[0x2019, 0x2010, 0x2011]] = [ord("'"), ord("-"), ord("-")]
INNER = np.zeros(TOP + 1, bool)
INNER[[ord(c) for c in "@$*!'-_"]] = True
del _SIGNS

# fixed values: words that report speech or address someone, in the four languages of the texts
REPORTING = "said says called wrote quote quoted word term sagte nannte schrieb wort dit appelle mot dijo llama palabra".split()
ADDRESS = "you your you're du dich dein ihr tu te ton vous eres usted".split()
QUOTES = "\"'“”„«»‘’"
_REPORT = re.compile(r"\b(?:" + "|".join(REPORTING) + r")\b\W{0,3}(?:\w+\W{1,3}){0,2}$")
_ADDRESS = re.compile(r"\b(?:" + "|".join(ADDRESS) + r")\b")


def codes(data: np.ndarray) -> tuple[str, np.ndarray]:
    """The text of UTF-8 bytes and its code points."""
    text = data.tobytes().decode("utf-8", "replace")
    return text, np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int32)


def tokens(points: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word: letters and digits, with signs such as * or @ between them. Words end at edges."""
    inside = ALNUM[points]
    joined = INNER[points]
    if len(points) > 2:
        joined[1:-1] &= inside[:-2] & inside[2:]
    joined[:1] = joined[-1:] = False
    # the neighbours of a row's first and last sign are in other rows
    joined[edges[edges < len(points)]] = False
    joined[edges[edges > 0] - 1] = False
    inside = inside | joined
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    start[edges[edges < len(points)]] |= inside[edges[edges < len(points)]]
    end[edges[edges > 0] - 1] |= inside[edges[edges > 0] - 1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


class Automaton:
    """Deterministic automaton of all words within one edit of a lexicon term; exact words of any length, others from
    ``FUZZY_LENGTH`` letters on."""

    def __init__(self, terms: list[str]):
        self.terms = terms
        children: list[dict[str, int]] = [{}]
        ends: list[int] = [-1]
        for number, term in enumerate(terms):
            node = 0
            for letter in term:
                if letter not in children[node]:
                    children[node][letter] = len(children)
                    children.append({})
                    ends.append(-1)
                node = children[node][letter]
            ends[node] = number
        letters = sorted({c for t in terms for c in t})
        # all code points above the letters of the terms share the last place
        self.symbol = np.zeros(max(map(ord, letters), default=0) + 2, np.int32)
        for i, c in enumerate(letters):
            self.symbol[ord(c)] = i + 1

        def closed(states: set[tuple[int, int]]) -> frozenset:
            """With a letter of a term left out: after one edit nothing more."""
            return frozenset(states | {(child, 1) for node, edits in states if edits == 0 for child in children[node].values()})

        start = closed({(0, 0)})
        number = {frozenset(): 0, start: 1}
        queue, rows = [start], [np.zeros(len(letters) + 1, np.int32)]
        while queue:
            state = queue.pop(0)
            other = {(node, 1) for node, edits in state if edits == 0}
            other |= {(child, 1) for node, edits in state if edits == 0 for child in children[node].values()}
            by_letter: dict[str, set] = defaultdict(set)
            for node, edits in state:
                for letter, child in children[node].items():
                    by_letter[letter].add((child, edits))

            def numbered(states: set) -> int:
                whole = closed(states)
                if whole not in number:
                    number[whole] = len(number)
                    queue.append(whole)
                return number[whole]

            row = np.full(len(letters) + 1, numbered(other), np.int32)
            for letter, matched in by_letter.items():
                row[self.symbol[ord(letter)]] = numbered(other | matched)
            rows.append(row)
        self.table = np.stack(rows)
        self.exact = np.full(len(rows), -1, np.int32)
        self.fuzzy: dict[int, list[int]] = {}
        for state, at in number.items():
            for node, edits in state:
                if ends[node] >= 0 and edits == 0:
                    self.exact[at] = ends[node]
                elif ends[node] >= 0 and len(terms[ends[node]]) >= FUZZY_LENGTH:
                    self.fuzzy.setdefault(at, []).append(ends[node])
        self.accepts = self.exact >= 0
        self.accepts[list(self.fuzzy)] = True
        lengths = [len(t) for t in terms] or [0]
        self.shortest, self.longest = max(1, min(lengths) - 1), max(lengths) + 1

    def matches(self, points: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words (numbers) that are accepted, and the states they end in."""
        length = end - start
        live = np.flatnonzero((length >= self.shortest) & (length <= self.longest))
        state = np.ones(len(live), np.int32)
        words, states = [], []
        for step in range(self.longest + 1):
            done = length[live] == step
            if done.any():
                words.append(live[done])
                states.append(state[done])
                live, state = live[~done], state[~done]
            if not len(live):
                break
            state = self.table[state, self.symbol[np.minimum(points[start[live] + step], len(self.symbol) - 1)]]
            alive = state > 0
            live, state = live[alive], state[alive]
        words, states = np.concatenate(words or [np.zeros(0, np.int64)]), np.concatenate(states or [np.zeros(0, np.int32)])
        good = self.accepts[states]
        order = np.argsort(words[good])
        return words[good][order], states[good][order]


def context(text: str, start: int, end: int, low: int, high: int) -> tuple[bool, bool]:
    """Whether a match is quoted, and whether somebody is addressed near it; nothing outside low..high is looked at."""
    before = text[max(low, start - WINDOW) : start].rpartition("\n")[2]
    after = text[end : min(high, end + WINDOW)].partition("\n")[0]
    left, right = before[-1:], after[:1]
    quoted = (left in QUOTES and right in QUOTES and left != "" and right != "") or (
        sum(c in "\"“”„«»" for c in before) % 2 == 1 and any(c in "\"“”«»" for c in after)
    )
    quoted = quoted or bool(_REPORT.search(before.lower()))
    return quoted, bool(_ADDRESS.search((before + " " + after).lower()))


def found_terms(column: pa.Array, automaton: Automaton) -> Iterator[tuple[list[tuple], int]]:
    """Per row: its matches as (state, quoted, addressed), and its number of words."""
    for _, _, data, offsets in slices(column):
        text, points = codes(data)
        # places of the rows in code points: bytes that begin a character are counted
        begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        edges = begins[offsets]
        if edges[-1] != len(points):  # not valid UTF-8: row by row
            rows = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
            text = "".join(rows)
            points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int32)
            edges = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        points = LOWER[points]
        start, end = tokens(points, edges)
        words, states = automaton.matches(points, start, end)
        first = np.searchsorted(start, edges)
        row_of = np.searchsorted(first, words, "right") - 1
        per_row: dict[int, list] = defaultdict(list)
        for word, state, row in zip(words.tolist(), states.tolist(), row_of.tolist()):
            quoted, addressed = context(text, int(start[word]), int(end[word]), int(edges[row]), int(edges[row + 1]))
            per_row[row].append((state, quoted, addressed))
        counts = np.diff(first).tolist()
        for row in range(len(offsets) - 1):
            yield per_row.get(row, []), counts[row]


class Model:
    """Log odds of each kind of match and the logistic weights of a document's matches."""

    def __init__(self, automaton: Automaton, odds: dict[tuple[int, bool, bool], float], weights: np.ndarray):
        self.automaton, self.odds, self.weights = automaton, odds, weights

    def features(self, found: list[tuple], words: int) -> list[float]:
        kinds: dict[str, list[float]] = {"exact": [], "fuzzy": [], "quoted": []}
        direct = 0
        for state, quoted, addressed in found:
            kind, odds = best_kind(self.automaton, state, quoted, self.odds)
            kinds[kind].append(odds)
            direct += addressed and not quoted
        total = sum(len(v) for v in kinds.values())
        out = [1.0]
        for values in kinds.values():
            out += [max(values, default=0.0) / 4, min(2.0, math.log1p(len(values)))]
        return [*out, min(2.0, math.log1p(direct)), min(1.0, 20 * total / max(1, words))]

    def score(self, found: list[tuple], words: int) -> float:
        z = float(np.dot(self.weights, self.features(found, words))) if len(self.weights) else -math.inf
        return round(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), 6) if z > -math.inf else 0.0


def best_kind(automaton: Automaton, state: int, quoted: bool, odds: dict) -> tuple[str, float]:
    term = int(automaton.exact[state])
    if term >= 0:
        return ("quoted" if quoted else "exact"), odds.get((term, False, quoted), 0.0)
    values = [odds.get((t, True, quoted), 0.0) for t in automaton.fuzzy[state]]
    return ("quoted" if quoted else "fuzzy"), max(values)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per word, all and toxic; rows (text, toxic)."""
    for batch in batches:
        counts: dict[str, list[int]] = {}
        labels = batch.column(1).to_pylist()
        row = 0
        for _, _, data, offsets in slices(batch.column(0)):
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                text, points = codes(data[a:b])
                points = LOWER[points]
                start, end = tokens(points, np.array([0, len(points)]))
                low = "".join(map(chr, points.tolist()))
                for word in {low[x:y] for x, y in zip(start.tolist(), end.tolist()) if 3 <= y - x <= 24}:
                    entry = counts.setdefault(word, [0, 0])
                    entry[0] += 1
                    entry[1] += labels[row]
                row += 1
        names = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([counts[w][0] for w in names], pa.int64()), pa.array([counts[w][1] for w in names], pa.int64())],
            names=["word", "n", "toxic"],
        )


def labelled_rows(docs: DataFrame, labels: DataFrame, where, max_rows: int, id_column: str, text_column: str, label_column: str) -> DataFrame:
    """(text, toxic) of at most about ``max_rows`` labelled rows, the same rows every time."""
    chosen = labels.select(F.col(id_column).alias("__id"), F.col(label_column).cast("int").alias("toxic"))
    chosen = chosen.where(F.col("__id").isNotNull() & F.col("toxic").isNotNull() & where(F.col("__id")))
    n = chosen.count()
    if n > max_rows:
        chosen = chosen.where(F.pmod(F.xxhash64("__id"), F.lit(1 << 20)) < (1 << 20) * max_rows // n)
    texts = docs.select(F.col(id_column).alias("__id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "__id").select("text", "toxic")


def train(sample: DataFrame, max_terms: int = MAX_TERMS, min_odds: float = MIN_ODDS) -> Model:
    """A model from (text, toxic 0/1) rows; their number must be bounded."""
    sample = store(sample, "toxic-sample")
    sizes = dict(sample.groupBy("toxic").count().collect())
    good, bad = sizes.get(0, 0), sizes.get(1, 0)
    if not good or not bad:
        return Model(Automaton([]), {}, np.zeros(0))
    counts = sample.mapInArrow(lambda batches: tidy(_counted(batches)), "word string, n long, toxic long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (bad + 1)) - F.log((F.col("n") - F.col("toxic") + 0.5) / (good + 1))
    terms = counts.where(F.col("toxic") >= max(2, bad // 500)).withColumn("odds", odds).where(F.col("odds") >= min_odds)
    terms = [r[0] for r in terms.orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "word").limit(max_terms).collect()]
    automaton = Automaton(terms)
    held = sample.sparkSession.sparkContext.broadcast(automaton)

    def observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(found_terms(batch.column(0), held.value))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([[s for s, _, _ in f] for f, _ in rows], pa.list_(pa.int32())),
                    pa.array([[q for _, q, _ in f] for f, _ in rows], pa.list_(pa.bool_())),
                    pa.array([[d for _, _, d in f] for f, _ in rows], pa.list_(pa.bool_())),
                    pa.array([n for _, n in rows], pa.int64()),
                    batch.column(1),
                ],
                names=["states", "quoted", "direct", "words", "toxic"],
            )

    shape = "states array<int>, quoted array<boolean>, direct array<boolean>, words long, toxic int"
    rows = [(list(zip(r.states, r.quoted, r.direct)), r.words, r.toxic) for r in sample.mapInArrow(lambda batches: tidy(observed(batches)), shape).collect()]
    seen: dict[tuple, list[int]] = defaultdict(lambda: [0, 0])
    for found, _, toxic in rows:
        kinds = set()
        for state, quoted, _ in found:
            term = int(automaton.exact[state])
            kinds |= {(term, False, quoted)} if term >= 0 else {(t, True, quoted) for t in automaton.fuzzy[state]}
        for kind in kinds:
            seen[kind][toxic] += 1
    # a misspelling or a quotation seen seldom is judged like all of its kind
    overall: dict[tuple[bool, bool], Counter] = defaultdict(Counter)
    for (_, fuzzy, quoted), (a, b) in seen.items():
        overall[fuzzy, quoted].update(good=a, bad=b)
    odds_of = {}
    for term in range(len(terms)):
        for fuzzy in (False, True):
            for quoted in (False, True):
                every = overall[fuzzy, quoted]
                share = (every["bad"] + 0.5) / (every["bad"] + every["good"] + 1)
                a, b = seen.get((term, fuzzy, quoted), (0, 0))
                odds_of[term, fuzzy, quoted] = math.log((b + 2 * share) / (bad + 2)) - math.log((a + 2 * (1 - share)) / (good + 2))
    model = Model(automaton, odds_of, np.zeros(0))
    x = np.array([model.features(found, words) for found, words, _ in rows])
    y = np.array([toxic for _, _, toxic in rows], float)
    model.weights = logistic(x, y)
    return model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic model, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def with_scores(docs: DataFrame, model: Model, text_column: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text in one more column."""
    from pyspark.sql.pandas.types import to_arrow_schema

    held = docs.sparkSession.sparkContext.broadcast(model)
    shape = docs.withColumn(name, F.lit(0.0)).schema
    arrow = to_arrow_schema(shape)
    at = docs.columns.index(text_column)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [held.value.score(found, words) for found, words in found_terms(batch.column(at), held.value.automaton)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], schema=arrow)

    return docs.mapInArrow(lambda batches: tidy(scored(batches)), shape)


def may_train(id_column: Column) -> Column:
    """Rows whose label may be learned: the checksum of the id as text is not 1 modulo 3."""
    return F.crc32(id_column.cast("string").cast("binary")) % 3 != 1


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_LABELLED) -> Model:
    return train(labelled_rows(docs, labels, may_train, max_rows, "doc_id", "text", "toxic"))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_rows: int = MAX_LABELLED) -> DataFrame:
    """Per document: whether its label was withheld from training, score and prediction."""
    scored = with_scores(docs.select("doc_id", F.col("text").cast("string").alias("text")), fit(docs, labels, max_rows))
    return scored.select(
        "doc_id", F.coalesce(~may_train(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score at least ``threshold``; all columns stay."""
    name = "__score"
    return with_scores(docs, model, name=name).where(F.col(name) < threshold).drop(name)
