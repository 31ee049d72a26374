"""Byte-pair encoding and decoding with the vocabulary of a tokenizer file, merged by batched numpy rounds.

The symbols of many words lie in one flat array. Each round looks all neighbouring pairs up in the sorted array of
mergeable pairs by binary search, takes each word's pair of lowest rank and merges it, in all its places from the left if
the file's ranks allow that (a pair with a made token always ranks behind the pairs that make it), else in the first;
words without a mergeable pair are finished. Words of more than LONG_WORD symbols, for which rounds would be too many, go
through a queue of pairs by rank and place, n log n in their length. Words that occurred before are taken from a bounded
memo of finished words.

Supports the pipeline of files of this kind: special tokens cut out of the raw text first; NFC, white space runs to one
space, lower case; a regular expression that picks words; bytes as printable characters; BPE with a word-end suffix.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEMO_WORDS = 400_000
MEMO_CHARS = 32 << 20
LONG_WORD = 512
MERGE_WORDS = 20_000
GROUP_CHARS = 4 << 20


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    chars = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [chars[b] for b in range(256)]


class Codec:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, spec: str):
        """``spec``: the file's JSON text."""
        told = json.loads(spec)
        model = told["model"]
        self.vocab: dict[str, int] = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        steps = (told.get("normalizer") or {}).get("normalizers", [])
        kinds = [x["type"] for x in steps]
        self.nfc, self.spaces, self.lower = "NFC" in kinds, "Replace" in kinds, "Lowercase" in kinds
        split = next(x for x in told["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        special = {x["content"]: x["id"] for x in told["added_tokens"]}
        self.special = special
        self.cut = regex.compile("(" + "|".join(regex.escape(x) for x in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.names: dict[int, str] = {i: t for t, i in [*self.vocab.items(), *special.items()]}
        chars = byte_characters()
        self.byte = np.array([self.vocab[c] for c in chars], np.int64)
        self.last = np.array([self.vocab[c + suffix] for c in chars], np.int64)
        size = max(self.vocab.values()) + 1
        merges = [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in model["merges"]]
        pairs = np.array([self.vocab[a] * size + self.vocab[b] for a, b in merges], np.int64)
        made = np.array([self.vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(pairs, kind="stable")
        self.size, self.pairs, self.ranks, self.made = size, pairs[order], order, made[order]
        self.made_by_rank = made
        latest = np.full(size, -1, np.int64)
        np.maximum.at(latest, made, np.arange(len(made)))
        self.ordered = bool((np.maximum(latest[pairs // size], latest[pairs % size]) < np.arange(len(made))).all())
        self.rank_of = dict(zip(pairs.tolist(), range(len(pairs)), strict=True))
        self.memo: dict[str, tuple[bytes, str]] = {}
        self.held = 0

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and the bounds of each word in it."""
        raw = [w.encode() for w in words]
        flat = np.frombuffer(b"".join(raw), np.uint8)
        lens = np.array([len(x) for x in raw], np.int64)
        ends = np.cumsum(lens) - 1
        sym = self.byte[flat]
        sym[ends] = self.last[flat[ends]]
        word = np.repeat(np.arange(len(words)), lens)
        out_sym, out_word = [], []
        none = len(self.pairs)
        while len(sym):
            key = sym[:-1] * self.size + sym[1:]
            at = np.minimum(np.searchsorted(self.pairs, key), none - 1)
            rank = np.where((self.pairs[at] == key) & (word[:-1] == word[1:]), self.ranks[at], none)
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            best = np.minimum.reduceat(np.append(rank, none), first)
            group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(sym))))
            live = best[group] < none
            out_sym.append(sym[~live]), out_word.append(word[~live])
            hits = np.flatnonzero((rank == best[group[:-1]]) & (rank < none))
            if self.ordered:  # all places of the word's lowest pair; of places that overlap (aaa) every other one
                begins = np.concatenate(([True], hits[1:] != hits[:-1] + 1))[: len(hits)]
                place = np.arange(len(hits))
                take = hits[(place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0]
            else:  # its first place: the others wait for the next round
                take = hits[np.concatenate(([True], group[hits[1:]] != group[hits[:-1]]))[: len(hits)]]
            sym = sym.copy()
            sym[take] = self.made[at[take]]
            keep = live.copy()
            keep[take + 1] = False
            sym, word = sym[keep], word[keep]
        sym, word = np.concatenate(out_sym), np.concatenate(out_word)
        order = np.argsort(word, kind="stable")
        return sym[order], np.concatenate(([0], np.cumsum(np.bincount(word, minlength=len(words)))))

    def merge_long(self, word: str) -> np.ndarray:
        """Ids of one word by a queue of (rank, place)."""
        raw = np.frombuffer(word.encode(), np.uint8)
        first = self.byte[raw]
        first[-1] = self.last[raw[-1]]
        n, size, rank_of, made = len(first), self.size, self.rank_of, self.made_by_rank.tolist()
        sym = first.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = [rank_of.get(k) for k in (first[:-1] * size + first[1:]).tolist()]
        queue = [r * n + i for i, r in enumerate(ranks) if r is not None]
        heapq.heapify(queue)
        while queue:
            r, i = divmod(heapq.heappop(queue), n)
            j = after[i]
            if sym[i] < 0 or j >= n or rank_of.get(sym[i] * size + sym[j]) != r:
                continue  # merged meanwhile
            sym[i], sym[j] = made[r], -1
            k = after[i] = after[j]
            h = before[i]
            if k < n:
                before[k] = i
                q = rank_of.get(sym[i] * size + sym[k])
                if q is not None:
                    heapq.heappush(queue, q * n + i)
            if h >= 0:
                q = rank_of.get(sym[h] * size + sym[i])
                if q is not None:
                    heapq.heappush(queue, q * n + h)
        out = np.array(sym, np.int64)
        return out[out >= 0]

    def normal(self, text: str) -> str:
        if self.nfc and not text.isascii():
            text = unicodedata.normalize("NFC", text)
        if self.lower:
            text = text.replace("Σ", "σ").lower()  # letter by letter: no final form of sigma
        return text

    def pieces(self, text: str) -> list[str]:
        """Words and special tokens in order; no word that the pattern picks is the name of a special token."""
        if self.cut is None or "<" not in text:
            return self.words.findall(self.normal(text))
        out = []
        for i, part in enumerate(self.cut.split(text)):
            if i % 2:
                out.append(part)
            elif part:
                out += self.words.findall(self.normal(part))
        return out

    def learn(self, words: set[str]) -> None:
        memo, names = self.memo, self.names
        plain = []
        for w in words:
            self.held += len(w)
            if w in self.special:
                memo[w] = (np.array([self.special[w]], "<u4").tobytes(), w)
            elif len(w) > LONG_WORD:
                ids = self.merge_long(w)
                memo[w] = (ids.astype("<u4").tobytes(), " ".join([names[i] for i in ids.tolist()]))
            else:
                plain.append(w)
        for lo in range(0, len(plain), MERGE_WORDS):
            part = plain[lo : lo + MERGE_WORDS]
            ids, bounds = self.merge(part)
            body, shown, cuts = ids.astype("<u4").tobytes(), [names[i] for i in ids.tolist()], bounds.tolist()
            for w, a, b in zip(part, cuts, cuts[1:], strict=False):
                memo[w] = (body[4 * a : 4 * b], " ".join(shown[a:b]))

    def encode_all(self, texts: list[str]) -> Iterator[tuple[bytes, list[str]]]:
        """For each text its ids as little-endian 32-bit bytes and its token names, word by word."""
        memo, lo = self.memo, 0
        while lo < len(texts):
            hi, size = lo, 0
            while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= GROUP_CHARS):
                size += len(texts[hi])
                hi += 1
            words = [self.pieces(t) for t in texts[lo:hi]]
            distinct = set(chain.from_iterable(words))
            new = distinct.difference(memo)
            if len(memo) + len(new) > MEMO_WORDS or self.held > MEMO_CHARS:
                memo.clear()
                self.held, new = 0, distinct
            self.learn(new)
            for w in words:
                got = [memo[x] for x in w]
                yield b"".join([x[0] for x in got]), [x[1] for x in got]
            lo = hi

    def decode(self, ids: np.ndarray) -> str:
        """What a file without a decoder gives: token names joined by spaces."""
        names = self.names
        return " ".join([names[i] for i in ids.tolist()])


@lru_cache(1)
def codec_of(spec: str) -> Codec:
    """One codec a worker, whatever the number of its tasks."""
    return Codec(spec)


def _digests(spec):
    def run(batches):
        codec = codec_of(spec.value)
        for batch in batches:
            n_tokens, ids_sha, text_sha = [], [], []
            for ids, names in codec.encode_all([x or "" for x in batch.column(1).to_pylist()]):
                n_tokens.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(" ".join(names).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_tokens, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _encoded(spec):
    def run(batches):
        codec = codec_of(spec.value)
        for batch in batches:
            ids = [np.frombuffer(b, "<u4").astype(np.int32) for b, _ in codec.encode_all([x or "" for x in batch.column(1).to_pylist()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    return run


def _decoded(spec):
    def run(batches):
        codec = codec_of(spec.value)
        for batch in batches:
            texts = [None if x.as_py() is None else codec.decode(np.array(x.as_py(), np.int64)) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return run


def _spec(df: DataFrame, path: str):
    """A tokenizer file has a fixed size (megabytes); its text goes to the workers by broadcast."""
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, ids``: the token ids of each row's whole text. Null and empty texts have no ids; row by row, so nulls,
    repeats and very long texts need no special case. Other columns are not read; an empty table gives an empty one."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col))
    return rows.mapInArrow(_encoded(_spec(docs, path)), "id bigint, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``<id_col>, text``: the decoded ids; null ids stay null, empty ids give an empty text."""
    rows = encoded.select(F.col(id_col).cast("bigint").alias("id"), F.col(ids_col))
    return rows.mapInArrow(_decoded(_spec(encoded, path)), "id bigint, text string").withColumnRenamed("id", id_col)


def codec_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, n_tokens, ids_sha256, decoded_sha256`` of each whole text, with the null and empty rules of ``encode``."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col))
    out = rows.mapInArrow(_digests(_spec(docs, path)), "id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
