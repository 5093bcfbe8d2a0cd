"""Encoding of a corpus with a public byte-level BPE tokenizer (problem 8).

The words that occur often in the corpus are compiled into a minimal acyclic transducer: a byte automaton whose suffixes are
shared, whose arcs carry how many words they pass over, so that a word's path adds up to its number, under which its ids stand.
The file is shipped to every executor and memory-mapped there. A word that the transducer lacks is merged exactly, pair by pair in
rank order.

The texts are read where they lie, once to count the words and once to encode them; only word counts are shuffled.
"""

from __future__ import annotations

import base64
import heapq
import mmap
import re
import struct
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.runtime import scratch_path

#: Where the tokenizers' files lie, and the vocabulary in ranks.
TOKENIZERS, VOCABULARY = "/opt/tokenizers", "byte_bpe_50k.tiktoken"
#: Documented bound of the transducer in words; occurrences that make a word frequent; words a worker keeps at hand.
LEXICON, FREQUENT, AT_HAND = 100_000, 2, 200_000
#: Bytes from which a word is neither compiled nor kept at hand, but merged over a heap: the same ids in n log n steps.
LONG = 64

# Fixed value: the pattern that splits a text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SPLIT = regex.compile(PATTERN)
# Fixed value: the same pattern among ASCII characters, for the plainer and faster engine.
ASCII_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"""
_SPLIT_ASCII = re.compile(ASCII_PATTERN, re.ASCII)


def split(text: str) -> list[str]:
    """The words of a text, which joined give it again."""
    return (_SPLIT_ASCII if text.isascii() else _SPLIT).findall(text)


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word: its bytes, the adjacent pair of least rank joined as long as there is one, the leftmost first."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    parts = [word[i : i + 1] for i in range(len(word))]
    joined = [ranks.get(a + b, -1) for a, b in zip(parts, parts[1:])]
    while joined:
        least, at = min(((r, i) for i, r in enumerate(joined) if r >= 0), default=(-1, -1))
        if least < 0:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del joined[at]
        if at < len(joined):
            joined[at] = ranks.get(parts[at] + parts[at + 1], -1)
        if at:
            joined[at - 1] = ranks.get(parts[at - 1] + parts[at], -1)
    return [ranks[p] for p in parts]


def _heap_merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """``merge`` for long words: the same joins from a heap over a linked list, in n log n steps."""
    n = len(word)
    end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), [*range(1, n), -1]
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j >= 0 and (r := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[i], end[j]))

    for i in range(n - 1):
        offer(i)
    gone = bytearray(n)
    while heap:
        _, i, mid, stop = heapq.heappop(heap)
        j = after[i] if not gone[i] else -1
        if j < 0 or end[i] != mid or end[j] != stop:
            continue
        end[i], after[i], gone[j] = stop, after[j], 1
        if after[i] >= 0:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i >= 0 and n:
        out.append(ranks[word[i : end[i]]])
        i = after[i]
    return out


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """The transducer of ``words`` as one block of bytes: header, first arc by state, arcs' labels, targets and outputs, finals, offsets, ids."""
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

    def settle(final: bool, arcs: list[tuple[int, int]]) -> int:
        key = (final, tuple(arcs))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    order = sorted(w for w in words if w)
    path: list[tuple[list[tuple[int, int]], list[bool]]] = [([], [False])]  # arcs and final of the open states along the last word
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            arcs, final = path.pop()
            path[-1][0].append((last[len(path) - 1], settle(final[0], arcs)))

    for word in order:
        common = next((i for i, (x, y) in enumerate(zip(last, word)) if x != y), min(len(last), len(word)))
        close(common)
        path.extend(([], [False]) for _ in range(len(word) - common))
        path[-1][1][0] = True
        last = word
    close(0)
    root = settle(False, path[0][0])
    count = [0] * len(states)
    for s, (final, arcs) in enumerate(states):  # children are settled before their parents
        count[s] = final + sum(count[t] for _, t in arcs)
    first, labels, targets, outputs, finals = array("i"), bytearray(), array("i"), array("i"), bytearray()
    for final, arcs in states:
        first.append(len(labels))
        finals.append(final)
        passed = int(final)
        for label, target in arcs:
            labels.append(label)
            targets.append(target)
            outputs.append(passed)
            passed += count[target]
    first.append(len(labels))
    offsets, ids = array("i", [0]), array("i")
    for word in order:
        ids.extend(words[word])
        offsets.append(len(ids))
    pad = lambda b: bytes(b) + b"\0" * (-len(b) % 4)
    head = struct.pack("<6i", len(states), len(labels), root, len(order), len(ids), 0)
    return b"".join([head, first.tobytes(), targets.tobytes(), outputs.tobytes(), offsets.tobytes(), ids.tobytes(), pad(labels), pad(finals)])


class Lexicon:
    """A compiled transducer, read in place from a memory-mapped file or a block of bytes."""

    def __init__(self, source: str | bytes):
        if isinstance(source, str):
            with open(source, "rb") as f:
                self._block = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        else:
            self._block = source
        states, arcs, self._root, words, ids, _ = struct.unpack_from("<6i", self._block, 0)
        view, at = memoryview(self._block), 24
        parts = []
        for n in (states + 1, arcs, arcs, words + 1, ids):
            parts.append(view[at : at + 4 * n].cast("i"))
            at += 4 * n
        self._first, self._targets, self._outputs, self._offsets, self._ids = parts
        self._labels = at
        self._finals = at + arcs + (-arcs % 4)

    def get(self, word: bytes) -> list[int] | None:
        """The ids of ``word``, or None if the transducer lacks it."""
        block, state, number = self._block, self._root, 0
        for b in word:
            lo, hi = self._first[state], self._first[state + 1]
            at = block.find(b.to_bytes(), self._labels + lo, self._labels + hi) - self._labels
            if at < 0:
                return None
            number += self._outputs[at]
            state = self._targets[at]
        if not word or not block[self._finals + state]:
            return None
        return self._ids[self._offsets[number] : self._offsets[number + 1]].tolist()


@lru_cache(maxsize=2)
def _mapped(name: str) -> Lexicon:
    """The shipped transducer ``name``, mapped once a worker."""
    return Lexicon(SparkFiles.get(name))


class WordIds(dict):
    """The ids of words: those at hand, else the transducer's, else merged exactly. At most AT_HAND words are kept."""

    def __init__(self, lexicon: Lexicon, ranks: dict[bytes, int]):
        super().__init__()
        self.lexicon, self.ranks = lexicon, ranks

    def __missing__(self, word: str) -> list[int]:
        raw = word.encode("utf-8", "replace")
        got = self.lexicon.get(raw)
        if got is None:
            got = merge(raw, self.ranks) if len(raw) < LONG else _heap_merge(raw, self.ranks)
        if len(self) >= AT_HAND:
            self.clear()
        if len(raw) < LONG:
            self[word] = got
        return got

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.__getitem__, split(text))))


def _count_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: Counter[str] = Counter()
    for pdf in batches:
        for text in pdf["text"]:
            if text:
                seen.update(split(text))
        if len(seen) > AT_HAND:
            yield pd.DataFrame(seen.items(), columns=["word", "n"])
            seen.clear()
    yield pd.DataFrame(seen.items(), columns=["word", "n"])


def frequent_words(texts: DataFrame) -> list[str]:
    """At most LEXICON of the words that occur FREQUENT times or more, the most frequent first; counted over all texts."""
    counts = texts.mapInPandas(_count_batches, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.where((F.col("n") >= FREQUENT) & (F.length("word") < LONG)).orderBy(F.col("n").desc(), "word").limit(LEXICON)
    return top.toArrow().column("word").to_pylist()


def ship_lexicon(spark: SparkSession, words: list[str], ranks: dict[bytes, int]) -> str:
    """Compiles the transducer of ``words``, writes it to the shared folder on whatever file system that is, and ships it to every executor, later ones too; its name among the session's files."""
    block = compile_lexicon({(w := word.encode("utf-8", "replace")): merge(w, ranks) for word in words})
    target = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "lexicon"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(target)
    out.write(bytearray(block))
    out.close()
    spark.sparkContext.addFile(fs.makeQualified(target).toString())
    return target.getName()


def encode(documents: DataFrame, tokenizers: str = TOKENIZERS, count_only: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """``documents``' doc_id with ids (array<int>), or n_tokens (bigint) if ``count_only``: the text's ids without special tokens.

    An empty and a null text have no ids: an empty list, never null. Strings of special tokens are ordinary text. One row per
    row of ``documents``; texts are encoded whole. The columns of ``carry`` pass through. The vocabulary lies at the same path on
    every executor, as the tokenizers' package puts it there.
    """
    spark = documents.sparkSession
    vocabulary = f"{tokenizers}/{VOCABULARY}"
    name = ship_lexicon(spark, frequent_words(documents.select("text")), load_ranks(vocabulary))

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(_mapped(name), load_ranks(vocabulary))
        for batch in stream:
            ids, sizes = array("i"), []
            for text in batch.column("text"):
                t = text.as_py()
                got = words.encode(t) if t else []
                sizes.append(len(got))
                if not count_only:
                    ids.extend(got)
            kept = [batch.column(c) for c in ("doc_id", *carry)]
            if count_only:
                result = pa.array(sizes, pa.int64())
            else:
                ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
                result = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(ids, np.int32), pa.int32()))
            yield pa.RecordBatch.from_arrays([*kept, result], ["doc_id", *carry, "n_tokens" if count_only else "ids"])

    rows = documents.select("doc_id", *carry, "text")
    kept = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in ("doc_id", *carry))
    return rows.mapInArrow(batches, f"{kept}, n_tokens bigint" if count_only else f"{kept}, ids array<int>")
