"""Secrets in texts: fixed patterns, and strings that look random to a pair of character Markov models.

Two first-order Markov models over the characters of keys, one of random strings and one of ordinary identifiers. Both
are sums of counts over all texts: random are the values that the base patterns find, and generated strings (each half of
the model); ordinary are the words outside the base spans, alone and joined by underscores, hyphens, slashes and capitals,
whose counts follow from those of the words. A string outside the fixed patterns' spans is a secret when its
log-likelihood ratio per character exceeds a limit that all but a thousandth of the ordinary strings of all texts (words,
and joins of three words that follow each other) stay below; a second pass adds up their histogram.
"""

from __future__ import annotations

import hashlib
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixloom.llm.words import sub_batches, utf8

LEAST = 20
#: Share of the ordinary strings below the limit, bins of the histogram of ratios (a thousandth wide, around 0).
BELOW, BIN, BINS = 0.999, 1e-3, 1 << 15
#: Bytes of text whose characters are counted at once: some thirty times that is held meanwhile.
COUNT_BYTES = 1 << 18
#: Patterns and least lengths of the base kinds (fixed values).
ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")
_HINTS = ("passw", "secret", "token", "key")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
ALPHABET = string.ascii_letters + string.digits + "+/_=-."
_CODE = np.full(128, -1, np.int64)
_CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base kinds."""
    found = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans of at least LEAST key-like characters outside the base spans: of a string that these touch, what is left."""
    apart: list[list[int]] = []  # base spans without overlaps
    for s, _, e in taken:
        if apart and s <= apart[-1][1]:
            apart[-1][1] = max(apart[-1][1], e)
        else:
            apart.append([s, e])
    found, k = [], 0
    for m in _CANDIDATE.finditer(text):  # both lists are in order: one sweep
        at, end = m.span()
        while k < len(apart) and apart[k][0] < end:
            if at < apart[k][1]:
                found.append((at, apart[k][0]))
                at = apart[k][1]
            if apart[k][1] > end:
                break  # it may reach into the next candidate too
            k += 1
        found.append((at, end))
    return [(s, e) for s, e in found if e - s >= LEAST]


N = len(ALPHABET)
_LETTERS = np.zeros(256, bool)
_LETTERS[[ord(c) for c in string.ascii_letters]] = True
_AS_CODE = np.full(256, -1, np.int64)
_AS_CODE[:128] = _CODE
_LOW, _UP = np.arange(26), np.arange(26, 52)  # lower and upper case in ALPHABET


class Counts:
    """Counts of first characters, last characters, first pairs and inner pairs of strings."""

    def __init__(self, flat: np.ndarray | None = None):
        flat = np.zeros(2 * N + 2 * N * N) if flat is None else flat
        self.flat = flat
        self.first, self.last = flat[:N], flat[N : 2 * N]
        self.head, self.pairs = flat[2 * N : 2 * N + N * N].reshape(N, N), flat[2 * N + N * N :].reshape(N, N)

    def add(self, code: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Strings as runs of codes."""
        if not len(starts):
            return
        self.first += np.bincount(code[starts], minlength=N)
        self.last += np.bincount(code[ends - 1], minlength=N)
        long = starts[ends - starts > 1]
        self.head += np.bincount(code[long] * N + code[long + 1], minlength=N * N).reshape(N, N)
        joint = np.zeros(len(code) + 1, bool)
        joint[starts] = True
        inside = np.zeros(len(code) + 1, np.int64)
        np.add.at(inside, starts, 1)
        np.add.at(inside, ends, -1)
        second = np.flatnonzero((np.cumsum(inside)[:-1] > 0) & ~joint[:-1])
        self.pairs += np.bincount(code[second - 1] * N + code[second], minlength=N * N).reshape(N, N)


def _probabilities(first: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first, pairs = first + 0.5, pairs + 0.05
    return np.log(first / first.sum()), np.log(pairs / pairs.sum(1, keepdims=True))


def _scaled(first: np.ndarray, pairs: np.ndarray, total: float) -> tuple[np.ndarray, np.ndarray]:
    """Counts brought down to a total of pairs."""
    by = min(1.0, total / max(pairs.sum(), 1.0))
    return first * by, pairs * by


def _folded(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Letter counts of both cases, on the places ``to`` of one case; along all axes."""
    for axis in range(x.ndim):
        both = x.take(_LOW, axis) + x.take(_UP, axis)
        shape = list(x.shape)
        shape[axis] = N
        x = np.zeros(shape)
        x[(slice(None),) * axis + (to,)] = both
    return x


def _ordinary(words: Counts) -> tuple[np.ndarray, np.ndarray]:
    """Expected counts of words alone, and of joins of three words on average: a fifth each by _, - and /, by capitals, and in
    upper case by _; three in ten joins end in a number of two digits."""
    n = max(words.first.sum(), 1.0)
    low = Counts(np.concatenate([_folded(words.first, _LOW), _folded(words.last, _LOW), _folded(words.head, _LOW).ravel(), _folded(words.pairs, _LOW).ravel()]))
    up = Counts(np.concatenate([_folded(words.first, _UP), _folded(words.last, _UP), _folded(words.head, _UP).ravel(), _folded(words.pairs, _UP).ravel()]))
    pairs, first = words.pairs.copy(), words.first.copy()
    cap_first = up.first
    cap_pairs = low.pairs - low.head
    cap_pairs[_UP] += low.head[_LOW]  # the first letter is the capital
    digits = _CODE[[ord(c) for c in string.digits]]
    styles = [(words.first, words.last, words.pairs, c) for c in "_-/"] + [(cap_first, low.last, cap_pairs, ""), (up.first, up.last, up.pairs, "_")]
    for begins, ends, inner, sep in styles:
        pairs += inner / 5
        first += begins / 15
        joints = 2 / 3 / 5
        if sep:
            s = _CODE[ord(sep)]
            pairs[:, s] += joints * ends
            pairs[s] += joints * begins
        else:
            pairs += joints * np.outer(ends, begins) / n
        numbers = 0.3 / 15
        pairs[:, digits] += numbers * ends[:, None] / 10
        pairs[np.ix_(digits, digits)] += numbers * n / 100
    return first, pairs


class Markov:
    """Log-likelihood ratio of random strings against ordinary identifiers."""

    def __init__(self, values: Counts, words: Counts, seed: int = 9):
        made = Counts()
        for x in random_strings(3000, seed):
            code = _CODE[np.frombuffer(x.encode("ascii"), np.uint8)]
            made.add(code, np.array([0]), np.array([len(code)]))
        first, pairs = _scaled(values.first, values.pairs, made.pairs.sum())
        random = _probabilities(made.first + first, made.pairs + pairs)
        ordinary = _probabilities(*_scaled(*_ordinary(words), 1e6))
        self.start, self.step = (random[i] - ordinary[i] for i in (0, 1))
        self.limit = 0.0

    def ratio(self, s: str) -> float:
        """Per character."""
        c = _CODE[np.frombuffer(s.encode("ascii"), np.uint8)]
        return float((self.start[c[0]] + self.step[c[:-1], c[1:]].sum()) / len(c))

    def set_limit(self, histogram: np.ndarray) -> None:
        """From the numbers of ordinary strings by bin of their ratios."""
        if histogram.sum():
            at = np.searchsorted(np.cumsum(histogram), BELOW * histogram.sum())
            self.limit = max(0.0, float((at + 1 - BINS // 2) * BIN))


def random_strings(n: int, seed: int = 9) -> list[str]:
    """Labelled random strings over the alphabets that keys use."""
    rng = np.random.default_rng(seed)
    kinds = [string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "-_", "0123456789abcdef", string.ascii_uppercase + string.digits, string.ascii_lowercase + string.digits]
    return ["".join(rng.choice(list(kinds[i % len(kinds)]), rng.integers(20, 64))) for i in range(n)]


def _outside(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """UTF-8 of what the base spans of each text leave, the texts' bounds in it, and the key-like values of the spans."""
    values, rest = [], []
    for text in texts.to_pylist():
        spans = base_spans(text) if text else []
        if not spans:
            rest.append(text)
            continue
        parts, at = [], 0
        for s, _, e in spans:
            values += re.findall(r"[A-Za-z0-9+/_.=-]{12,}", text[s:e])
            parts.append(text[at : max(at, s)])
            at = max(at, e)
        rest.append("\n".join([*parts, text[at:]]))
    data, offsets = utf8(pa.array(rest, pa.large_string()))
    return data, offsets, values


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of two and more ASCII letters, and the text of each."""
    letter = np.zeros(len(data) + 1, bool)
    letter[:-1] = _LETTERS[data]
    begins = letter[:-1].copy()
    begins[1:] &= ~letter[:-2]
    stops = letter[:-1] & ~letter[1:]
    cut = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]  # a text's end ends a word
    begins[cut] = letter[cut]
    stops[cut - 1] = letter[cut - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    long = ends - starts > 1
    starts, ends = starts[long], ends[long]
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _count(texts: pa.Array, values: Counts, words: Counts) -> None:
    data, offsets, found = _outside(texts)
    code = _AS_CODE[data]
    starts, ends, _ = _words(data, offsets)
    words.add(code, starts, ends)
    for x in found:
        c = _CODE[np.frombuffer(x.encode("ascii"), np.uint8)]
        values.add(c, np.array([0]), np.array([len(c)]))


def _ratios(texts: pa.Array, models: Markov) -> np.ndarray:
    """Ratios of the ordinary strings of texts: words of eight letters and more, and joins of three in turn by _, - and /,
    by capitals, and in upper case by _."""
    data, offsets, _ = _outside(texts)
    starts, ends, doc = _words(data, offsets)
    if not len(starts):
        return np.zeros(0)
    code = _AS_CODE[data]
    low = np.where(code >= 26, code - 26, code)
    cap = low.copy()
    cap[starts] += 26
    step, start = models.step, models.start

    def inner(c):
        sums = np.concatenate(([0.0, 0.0], np.cumsum(step[c[:-1], c[1:]])))
        return sums[ends] - sums[starts + 1]

    size = ends - starts
    plain, whole, capital, upper = code, inner(code), inner(cap), inner(low + 26)
    out = [((start[plain[starts]] + whole) / size)[size >= 8]]
    nth = np.arange(len(doc)) - np.searchsorted(doc, doc)
    a = np.flatnonzero(nth[:-2] % 3 == 0) if len(doc) > 2 else np.zeros(0, np.int64)
    a = a[doc[a + 2] == doc[a]]
    length = size[a] + size[a + 1] + size[a + 2]
    begins, lasts = plain[starts], plain[ends - 1]
    for k, (sep, sums, b, e) in enumerate([*((s, whole, begins, lasts) for s in "_-/"), ("", capital, low[starts] + 26, low[ends - 1]), ("_", upper, low[starts] + 26, low[ends - 1] + 26)]):
        x = a[nth[a] // 3 % 5 == k]
        joint = lambda i, j: step[e[i], _CODE[ord(sep)]] + step[_CODE[ord(sep)], b[j]] if sep else step[e[i], b[j]]  # noqa: B023, E731
        total = start[b[x]] + sums[x] + sums[x + 1] + sums[x + 2] + joint(x, x + 1) + joint(x + 1, x + 2)
        out.append(total / (length[nth[a] // 3 % 5 == k] + 2 * len(sep)))
    return np.concatenate(out)


def _histogram(ratios: np.ndarray) -> np.ndarray:
    return np.bincount(np.clip(np.floor(ratios / BIN).astype(np.int64) + BINS // 2, 0, BINS - 1), minlength=BINS)


def train(texts: list[str], seed: int = 9) -> Markov:
    """The models of a list of texts, as ``fit`` makes them of a table."""
    values, words = Counts(), Counts()
    column = pa.array(texts, pa.large_string())
    _count(column, values, words)
    models = Markov(values, words, seed)
    models.set_limit(_histogram(_ratios(column, models)))
    return models


def _texts(batches):
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        for lo, hi, _, _ in sub_batches(data, offsets, COUNT_BYTES):
            yield batch.column(0).slice(lo, hi - lo)


def _sums(flat: np.ndarray):
    at = np.flatnonzero(flat)
    return pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at].astype(np.int64))], names=["at", "n"])


def fit(docs: DataFrame, text_col: str = "text", seed: int = 9) -> Markov:
    """Models trained on all texts of ``docs``: one pass adds up character counts, a second the histogram of ordinary ratios.
    The driver gets sums of a fixed size. Null and empty texts add nothing; from an empty table the models know only the
    generated strings; other columns are not read."""
    spark, texts = docs.sparkSession, docs.select(F.col(text_col).alias("text"))

    def count(batches):
        values, words = Counts(), Counts()
        for part in _texts(batches):
            _count(part, values, words)
        yield _sums(np.concatenate((values.flat, words.flat)))

    def added(rows: DataFrame, size: int) -> np.ndarray:
        out = np.zeros(size)
        for at, n in rows.groupBy("at").agg(F.sum("n").alias("n")).collect():  # at most ``size`` rows
            out[at] = n
        return out

    flat = added(texts.mapInArrow(count, "at bigint, n bigint"), 2 * len(Counts().flat))
    models = Markov(Counts(flat[: len(flat) // 2]), Counts(flat[len(flat) // 2 :]), seed)
    sent = spark.sparkContext.broadcast(models)

    def ratios(batches):
        out = np.zeros(BINS, np.int64)
        for part in _texts(batches):
            out += _histogram(_ratios(part, sent.value))
        yield _sums(out)

    models.set_limit(added(texts.mapInArrow(ratios, "at bigint, n bigint"), BINS))
    return models


def all_spans(text: str, models: Markov) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and base and model spans together, by start, then kind."""
    base = base_spans(text)
    more = [(s, 3, e) for s, e in candidates(text, base) if models.ratio(text[s:e]) > models.limit]
    return base, sorted(base + more)


def _written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scanner(model):
    def scan(batches):
        models = model.value
        for batch in batches:
            cols = [[], [], [], [], []]
            for x in batch.column(1):
                base, spans = all_spans(x.as_py() or "", models)
                kinds = [k for _, k, _ in base]
                for col, v in zip(cols, (kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(_written(base).encode()).hexdigest(), _written(spans)), strict=True):
                    col.append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return scan


def secret_spans(docs: DataFrame, models: Markov, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, n_assign, n_access, n_hex, base_sha256, spans``, row by row.

    Spans are kind:start:end in code points, end exclusive, in order of start and then of ``KINDS``. Null and empty texts
    have none. Whole texts are scanned; repeated rows and null ids need no special case; an empty table gives an empty
    result and other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(models)  # fixed size: two tables over the alphabet
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col))
    return rows.mapInArrow(_scanner(model), "id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string").withColumnRenamed("id", id_col)


def redact(text: str | None, models: Markov, mark: str = "[SECRET]") -> str | None:
    """The text with every span replaced; overlapping spans become one mark, null stays null."""
    if text is None:
        return None
    out, at = [], 0
    for s, _, e in all_spans(text, models)[1]:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def without_secrets(docs: DataFrame, models: Markov, text_col: str = "text", size_col: str | None = None) -> DataFrame:
    """``docs`` with secrets replaced in its text, and the text's length in ``size_col`` if given; all else as it was.
    Null and empty texts stay as they are. Row by row: repeats and null ids need no special case, other columns pass
    through, an empty table gives an empty one."""
    model = docs.sparkSession.sparkContext.broadcast(models)
    schema = docs.schema

    def clean(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = [redact(x, model.value) for x in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(clean, schema)
    return out.withColumn(size_col, F.length(text_col).cast(schema[size_col].dataType)) if size_col else out
