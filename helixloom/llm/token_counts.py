"""Token counts by a linear longest-match automaton.

The vocabulary is a byte trie. Each node has a failure link: where matching goes on after the longest pieces that can be
taken off its string, and the number of those pieces. So a word's greedy word-piece length comes from one pass over its
bytes, without trying prefixes again and without building pieces (Song et al. 2021). Word-initial pieces carry a leading
space in the trie, so that one root serves initial and continuing pieces. Counts of words are kept in a bounded memo.
"""

from __future__ import annotations

import json
from collections import deque
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixloom.llm.bpe_codec import byte_characters

MEMO_WORDS = 400_000


class Automaton:
    """Greedy longest-match piece counts of words."""

    def __init__(self, pieces: set[bytes]):
        """``pieces``: word-initial ones start with a space byte, no other byte of any piece is one."""
        goto: dict[int, int] = {}
        parent, via, final = [0], [0], [False]
        for piece in sorted(pieces):
            node = 0
            for b in piece:
                key = node << 8 | b
                if key not in goto:
                    goto[key] = len(parent)
                    parent.append(node), via.append(b), final.append(False)
                node = goto[key]
            final[node] = True
        final[0] = False
        children: dict[int, list[int]] = {}
        for node in range(1, len(parent)):
            children.setdefault(parent[node], []).append(node)
        fail, popped = [-1] * len(parent), [0] * len(parent)
        queue = deque(children.get(0, ()))
        while queue:
            node = queue.popleft()
            queue.extend(children.get(node, ()))
            if final[node]:
                fail[node], popped[node] = 0, 1
                continue
            z, n = fail[parent[node]], popped[parent[node]]
            while z >= 0 and z << 8 | via[node] not in goto:
                n, z = n + popped[z], fail[z]
            if z >= 0:
                fail[node], popped[node] = goto[z << 8 | via[node]], n
        self.goto, self.fail, self.popped = goto, fail, popped

    def count(self, word: bytes) -> int:
        """Pieces of one word, 0 if it can't be cut into pieces."""
        goto, fail, popped = self.goto, self.fail, self.popped
        node, n = 0, 0
        for b in b" " + word:
            while (to := goto.get(node << 8 | b, -1)) < 0:
                n += popped[node]
                node = fail[node]
                if node < 0:
                    return 0
            node = to
        while node:
            n += popped[node]
            node = fail[node]
            if node < 0:
                return 0
        return n


def word_pieces(spec: str) -> set[bytes]:
    """Byte pieces of a byte-level vocabulary: initial ones keep their space, pieces with other white space are left out.

    The space alone is an initial piece too: a word for which no longer one fits is cut into it and continuing pieces."""
    byte = {c: b for b, c in enumerate(byte_characters())}
    special = {x["content"] for x in json.loads(spec)["added_tokens"]}
    out = set()
    for token in json.loads(spec)["model"]["vocab"]:
        if token not in special:
            piece = bytes(byte[c] for c in token)
            if len(piece[1:].split()) <= 1 and not any(b in b"\x20\t\n\x0b\x0c\r" for b in piece[1:]) and piece[:1] not in (b"\t", b"\n", b"\x0b", b"\x0c", b"\r"):
                out.add(piece)
    return out


@lru_cache(1)
def _tools(spec: str) -> tuple[Automaton, dict[bytes, int]]:
    """One automaton and memo a worker, whatever the number of its tasks."""
    return Automaton(word_pieces(spec)), {}


def _counter(spec):
    def run(batches):
        automaton, memo = _tools(spec.value)
        for batch in batches:
            n_words, n_tokens, n_unknown = [], [], []
            for x in batch.column(1):
                words = (x.as_py() or "").encode().split()
                try:
                    counts = [memo[w] for w in words]
                except KeyError:
                    if len(memo) > MEMO_WORDS:
                        memo.clear()
                    for w in set(words):
                        if w not in memo:
                            memo[w] = automaton.count(w)
                    counts = [memo[w] for w in words]
                unknown = counts.count(0)
                n_words.append(len(words)), n_tokens.append(sum(counts) + unknown), n_unknown.append(unknown)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in (n_words, n_tokens, n_unknown))], names=["id", "n_words", "n_tokens", "n_unknown"])

    return run


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, n_words, n_tokens, n_unknown`` of each whole text.

    Words are runs of bytes other than ASCII white space; one that can't be cut into pieces counts as one unknown token
    (none with a vocabulary of all bytes and the space). Null and empty texts have zeros. Row by row: repeated rows, null
    ids and very long texts need no special case; an empty table gives an empty result and other columns are not read.
    """
    with open(path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())  # a tokenizer file, megabytes
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col))
    return rows.mapInArrow(_counter(spec), "id bigint, n_words bigint, n_tokens bigint, n_unknown bigint").withColumnRenamed("id", id_col)
