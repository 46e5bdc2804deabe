"""Packing of tokenised documents into sequences, in order, by dynamic programming.

A task reads its documents one after another as one stream of ids, each document followed by a separator. A sequence
is a window of the stream. Its cost is its padding plus the penalty of its end: none at the end of a document,
``SENTENCE`` after a sentence, ``INSIDE`` elsewhere. Sequences have ``length / 2`` to ``length`` ids; one is
padded to ``length`` unless its size is a power of two. The best cut before position i is

    cost(i) = min over i - length <= j <= i - length / 2 of (cost(j) + j) + length - i + penalty(i),

a minimum over a sliding window. The monotone queue that gives these minima is kept in blocks: for ``length / 2``
positions at once they are the pairwise minima of running minima from both sides, so the work per id is constant.
Of each block of about ``CHUNK`` ids the best cut near its end is taken; ids after it open the next block. What is left at the end
of a task, less than ``length`` ids, is cut into powers of two, which need no padding.

Documents never meet those of another task, nothing is shuffled, and a task holds one block and one document.
Null texts count as empty: only the separator. Repeated rows and ids are packed each; an empty table gives no pieces.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import tidy

LENGTH = 1024
SENTENCE = 4
INSIDE = 16
CHUNK = 1 << 18
SEPARATOR = 0

SCHEMA = "doc_id {id}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, padded_length long"


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself, or 256 and up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str) -> tuple[Callable[[str], np.ndarray], np.ndarray]:
    """A function from text to ids as the ``tokenizers`` library gives them without special tokens added, and per id
    whether it ends a sentence.

    Byte-level BPE files are run by ``tiktoken``, several times as fast with the same ids; others by ``tokenizers``.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    simple = all(not (t.get("lstrip") or t.get("rstrip") or t.get("single_word")) for t in spec.get("added_tokens", []))
    letters = byte_letters()
    if model.get("type", "BPE") == "BPE" and not spec.get("normalizer") and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True) and simple:
        import tiktoken

        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        encoding = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        ends = np.zeros(max([*ranks.values(), *special.values()]) + 1, bool)
        for token, i in ranks.items():
            ends[i] = token.rstrip(b" ").endswith((b".", b"!", b"?", b"\n"))
        slow = []

        def encode(text: str) -> np.ndarray:
            try:
                return np.array(encoding.encode(text, allowed_special="all"), np.uint32)
            except ValueError:  # a run of white space beyond the stack of the pattern's engine
                from tokenizers import Tokenizer

                if not slow:
                    slow.append(Tokenizer.from_file(path))
                return np.array(slow[0].encode(text, add_special_tokens=False).ids, np.uint32)

        return encode, ends
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    ends = np.zeros(tokenizer.get_vocab_size() + 1, bool)
    for token, i in tokenizer.get_vocab().items():
        ends[i] = token.replace("</w>", "").endswith((".", "!", "?", "\n"))
    return (lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)), ends


def best_cuts(penalty: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Least cost of cutting before each position 0..n and the cut before it; ``penalty[i]`` holds for a cut at i."""
    n, half = len(penalty) - 1, length // 2
    far = np.int64(1) << 40
    cost = np.full(n + 1 + half, far, np.int64)
    parent = np.full(n + 1 + half, -1, np.int64)
    cost[0] = 0
    padded = np.concatenate([np.full(length, far, np.int64), cost])  # padded[i + length] = cost(i)
    bits = 22
    low = np.arange(length, dtype=np.int64)
    penalty = np.concatenate([penalty, np.zeros(half, np.int64)])
    for a in range(half, n + 1, half):
        before = padded[a : a + length]  # cost(j) for j = a - length ... a - 1
        j = low + (a - length)
        key = ((before + j + length) << bits) | low  # j + length is never negative
        down = np.minimum.accumulate(key[:half][::-1])[::-1]
        up = np.minimum.accumulate(key[half:])
        best = np.minimum(down, up)
        i = np.arange(a, a + half)
        value = (best >> bits) - i + penalty[a : a + half]
        where = (best & ((1 << bits) - 1)) + (a - length)
        exact = before[half:] + penalty[a : a + half]  # of length / 2 ids, a power of two: no padding
        take = exact < value
        cost[a : a + half] = np.minimum(np.where(take, exact, value), far)
        parent[a : a + half] = np.where(take, i - half, where)
        padded[a + length : a + length + half] = cost[a : a + half]
    return cost[: n + 1], parent[: n + 1]


def windows(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray, final: bool, length: int = LENGTH) -> list[int]:
    """Cuts of a block of ids, from 0 on; unless ``final``, ids after the last cut are left for the next block."""
    n = len(ids)
    penalty = np.full(n + 1, INSIDE, np.int64)
    penalty[1:][ends[ids]] = SENTENCE
    penalty[doc_ends] = 0
    cost, parent = best_cuts(penalty, length)
    tail = np.arange(max(0, n - length + 1), n + 1)
    reach = cost[tail]
    at = int(tail[len(tail) - 1 - int(np.argmin(reach[::-1]))]) if reach.min() < 1 << 40 else 0
    cuts = [at]
    while cuts[-1] > 0:
        cuts.append(int(parent[cuts[-1]]))
    cuts.reverse()
    if final:
        rest = n - at
        for bit in range(length.bit_length() - 1, -1, -1):
            if rest >> bit & 1:
                cuts.append(cuts[-1] + (1 << bit))
    return cuts


def padded_size(size: int, length: int = LENGTH) -> int:
    return size if size & (size - 1) == 0 else length


def _pack(batches: Iterator[pa.RecordBatch], path: str, length: int, chunk: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    encode, ends = encoder(path)
    sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    segments: list[tuple] = []  # (id, place in its document, ids, ids of the document)
    held = 0

    def emit(final: bool) -> Iterator[pa.RecordBatch]:
        nonlocal segments, held, sequence
        sizes = np.array([len(s[2]) for s in segments], np.int64)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        ids = np.concatenate([s[2] for s in segments]) if segments else np.zeros(0, np.uint32)
        closed = np.array([s[1] + len(s[2]) == s[3] for s in segments], bool)
        cuts = windows(ids, edges[1:][closed], ends, final, length)
        rows: list[tuple] = []
        at = 0
        for a, b in zip(cuts, cuts[1:]):
            place = a
            while place < b:
                if edges[at + 1] <= place:
                    at += 1
                    continue
                end = min(b, int(edges[at + 1]))
                name, begin, _, total = segments[at]
                rows.append((name, begin + place - int(edges[at]), end - place, ids[place:end].astype("<u4").tobytes(), total, sequence, place - a, padded_size(b - a, length)))
                place = end
            sequence += 1
        left = []
        for k, (name, begin, own, total) in enumerate(segments):
            skip = max(0, cuts[-1] - int(edges[k]))
            if skip < len(own):
                left.append((name, begin + skip, own[skip:], total))
        segments, held = left, len(ids) - cuts[-1]
        for i in range(0, len(rows), 4096):
            columns = list(zip(*rows[i : i + 4096]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for batch in batches:
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = np.append(encode(text.as_py() or ""), np.uint32(SEPARATOR))
            segments.append((name, 0, own, len(own)))
            held += len(own)
            if held >= chunk:
                yield from emit(False)
    if segments:
        yield from emit(True)


def pack(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH, chunk: int = CHUNK) -> DataFrame:
    """Pieces of documents in sequences: which ids (little-endian 32 bits each), in which sequence and where.

    ``tokenizer`` is the path of a vocabulary file that every executor has; ``length`` is a power of two.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    empty = docs.sparkSession.createDataFrame([], SCHEMA.format(id=kind))
    schema = to_arrow_schema(empty.schema)
    return rows.mapInArrow(lambda batches: tidy(_pack(batches, tokenizer, length, chunk, schema)), empty.schema).withColumnRenamed("doc_id", id_column)
