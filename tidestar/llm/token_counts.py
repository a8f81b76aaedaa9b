"""Token counts by a linear longest-match automaton.

A trie of the vocabulary's byte strings gets failure links, and at each node the
number of tokens that are certain once the match fails there. A word is then
counted in one pass over its bytes, without going back and without building a
piece: greedy, always the longest token next. The words of a slice go through
the automaton side by side, equal words once.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidestar.llm import textops
from tidestar.llm.shared import col, ship, table

# Lines of a token in base64 and its rank. Every single byte has to be a token.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
ROOT = 0
MULTIPLIER = np.uint32(2654435769)  # a fixed odd number for hashing


@dataclass
class Automaton:
    """``fail`` and ``popped`` for each node; the moves are a hash table of key (node * 256 + byte) and node; ``start[b]``: after a first byte."""

    fail: np.ndarray
    popped: np.ndarray
    keys: np.ndarray
    nodes: np.ndarray
    start: np.ndarray

    def move(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The next node, or -1 where there is none."""
        key = node.astype(np.int64) * 256 + byte
        slot = self._slot(key)
        out = np.full(len(key), -1, np.int32)
        open_ = np.arange(len(key))
        while len(open_):
            found = self.keys[slot]
            hit = found == key[open_]
            out[open_[hit]] = self.nodes[slot[hit]]
            go = ~hit & (found >= 0)
            open_, slot = open_[go], (slot[go] + 1) & (len(self.keys) - 1)
        return out

    def _slot(self, key: np.ndarray) -> np.ndarray:
        bits = len(self.keys).bit_length() - 1
        return ((key.astype(np.uint32) * MULTIPLIER) >> np.uint32(32 - bits)).astype(np.int64)

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, prefix: bytes = b" ") -> np.ndarray:
        """Number of tokens of each stretch of bytes, as if ``prefix`` stood before it."""
        length = ends - starts
        order = np.argsort(-length, kind="stable")
        starts, length = starts[order], length[order]
        node, total = np.zeros(len(order), np.int32), np.zeros(len(order), np.int64)
        for byte in prefix:
            self._step(node, total, np.full(len(node), byte, np.uint8), len(node))
        for t in range(int(length[0]) if len(length) else 0):
            m = int(np.searchsorted(-length, -t))
            self._step(node, total, data[starts[:m] + t], m)
        while (left := np.flatnonzero(node != ROOT)).size:
            total[left] += self.popped[node[left]]
            node[left] = self.fail[node[left]]
        out = np.empty(len(order), np.int64)
        out[order] = total
        return out

    def _step(self, node: np.ndarray, total: np.ndarray, byte: np.ndarray, m: int) -> None:
        open_ = np.arange(m)
        while len(open_):
            after = self.move(node[open_], byte[open_])
            at_root = node[open_] == ROOT
            after[at_root] = self.start[byte[open_[at_root]]]
            done = after >= 0
            node[open_[done]] = after[done]
            open_ = open_[~done]
            total[open_] += self.popped[node[open_]]
            node[open_] = self.fail[node[open_]]


def build(tokens: list[bytes]) -> Automaton:
    """From a vocabulary that holds every single byte."""
    children: list[dict[int, int]] = [{}]
    is_token = [False]
    for token in tokens:
        at = ROOT
        for b in token:
            if b not in children[at]:
                children[at][b] = len(children)
                children.append({})
                is_token.append(False)
            at = children[at][b]
        if token:
            is_token[at] = True
    missing = [b for b in range(256) if b not in children[ROOT] or not is_token[children[ROOT][b]]]
    if missing:
        raise ValueError(f"{len(missing)} single bytes are no tokens of the vocabulary")
    fail, popped = np.zeros(len(children), np.int32), np.zeros(len(children), np.int32)
    level = [ROOT]
    while level:
        after = []
        for u in level:
            for b, v in children[u].items():
                after.append(v)
                if is_token[v]:
                    popped[v] = 1
                    continue
                # What fails at v has failed at u first; the last byte goes on from there.
                z, n = int(fail[u]), int(popped[u])
                while b not in children[z]:
                    n += int(popped[z])
                    z = int(fail[z])
                fail[v], popped[v] = children[z][b], n
        level = after
    moves = np.array([(u * 256 + b, v) for u, c in enumerate(children) if u for b, v in c.items()], np.int64).reshape(-1, 2)
    bits = max(8, int(4 * len(moves) + 1).bit_length())
    made = Automaton(fail, popped, np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32), np.array([children[ROOT][b] for b in range(256)], np.int32))
    slot, rows = made._slot(moves[:, 0]), np.arange(len(moves))
    while len(rows):
        free = made.keys[slot] < 0
        _, first = np.unique(slot, return_index=True)
        winner = np.zeros(len(rows), bool)
        winner[first] = True
        winner &= free
        made.keys[slot[winner]], made.nodes[slot[winner]] = moves[rows[winner]].T
        rows, slot = rows[~winner], (slot[~winner] + 1) & ((1 << bits) - 1)
    return made


def read_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


def count_tokens(docs: DataFrame, tokens: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_tokens.

    Words are runs of anything but white space; each counts with one space
    before it. A null or empty text has no words and no tokens. Nulls elsewhere,
    repeated rows and an empty table need no care; other columns are ignored.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(build(tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            for part in textops.slices(batch.column(1)):
                starts, ends = textops.words(part)
                at = part.per_row(starts)
                _, first, same = np.unique(textops.hashes(part.data, starts, ends), return_index=True, return_inverse=True)
                n = automaton.count(part.data, starts[first], ends[first])[same]
                sums = np.r_[0, np.cumsum(n)]
                ids = batch.column(0).slice(part.first, len(part))
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(at)), pa.array(np.diff(sums[at]))], ["doc_id", "n_words", "n_tokens"])

    frame = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    return frame.mapInArrow(run, f"doc_id {frame.schema[0].dataType.simpleString()}, n_words long, n_tokens long")


def op8_longest_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), read_vocabulary())
