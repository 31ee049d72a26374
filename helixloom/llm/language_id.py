"""Language identification by a byte convolutional network in numpy.

Bytes are embedded, convolved by filters of several widths, max-pooled over a window of fixed length and classified by a
softmax. Because embedding and convolution are linear, each filter bank is a sum of table look-ups; for inference two
neighbouring positions share one table of 65,536 rows. A text is cut into consecutive windows, all of which count: its
probabilities are the length-weighted mean over its windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixloom.llm.sampling import sample_rows
from helixloom.llm.words import sub_batches, utf8

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBED = 8
TRAIN_DOCS = 3000
UNKNOWN = "und"
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[48:58] = 48
_LETTER = regex.compile(r"\p{L}")


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all documents (padded with zeros), the document of each, and their lengths."""
    sizes = np.diff(offsets)
    per = -(-sizes // WINDOW)
    doc = np.repeat(np.arange(len(sizes)), per)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    start = offsets[:-1][doc] + nth * WINDOW
    length = np.minimum(WINDOW, offsets[1:][doc] - start)
    at = start[:, None] + np.arange(WINDOW)
    ok = np.arange(WINDOW)[None, :] < length[:, None]
    out = np.zeros(at.shape, np.uint8)
    out[ok] = _FOLD[data[at[ok]]]
    return out, doc, length


class ByteConvNet:
    """Parameters, training and inference."""

    def __init__(self, langs: list[str], seed: int = 3):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.embed = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.kernels = [rng.normal(0, 1 / np.sqrt(w * EMBED), (w, EMBED, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.dense = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(langs))).astype(np.float32)
        self.out = np.zeros(len(langs), np.float32)

    def _params(self):
        return [self.embed, *self.kernels, self.bias, self.dense, self.out]

    def _pool(self, x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        best, where = [], []
        for w, kernel in zip(WIDTHS, self.kernels, strict=True):
            n = WINDOW - w + 1
            total = sum((self.embed @ kernel[k])[x[:, k : k + n]] for k in range(w))
            at = total.argmax(1)
            where.append(at)
            best.append(np.take_along_axis(total, at[:, None, :], 1)[:, 0])
        return best, where

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 3, batch: int = 128, rate: float = 4e-3, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        share = np.bincount(y, minlength=len(self.langs)) / len(y)
        weight = 1 / np.maximum(share * len(self.langs), 1e-6)
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self._params()]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for lo in range(0, len(x), batch):
                i = order[lo : lo + batch]
                grads = self._gradients(x[i], y[i], weight[y[i]])
                step += 1
                for p, g, (m, v) in zip(self._params(), grads, moments, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def _gradients(self, x, y, weight):
        best, where = self._pool(x)
        pre = np.concatenate(best, 1) + self.bias
        hidden = np.maximum(pre, 0)
        prob = _softmax(hidden @ self.dense + self.out)
        prob[np.arange(len(y)), y] -= 1
        d_out = (prob * (weight / weight.sum())[:, None]).astype(np.float32)
        d_hidden = (d_out @ self.dense.T) * (pre > 0)
        d_embed, d_kernels = np.zeros_like(self.embed), []
        rows = np.arange(len(x))[:, None]
        for j, (w, kernel) in enumerate(zip(WIDTHS, self.kernels, strict=True)):
            g, at = d_hidden[:, j * FILTERS : (j + 1) * FILTERS], where[j]
            d_kernel = np.zeros_like(kernel)
            for k in range(w):
                b = x[rows, at + k]  # the byte under each filter's maximum
                d_kernel[k] = np.einsum("nf,nfe->ef", g, self.embed[b])
                np.add.at(d_embed, b, g[:, :, None] * kernel[k].T[None])
            d_kernels.append(d_kernel)
        return [d_embed, *d_kernels, d_hidden.sum(0), hidden.T @ d_out, d_out.sum(0)]

    def tables(self):
        """For each width: (table, offset, is a pair) look-ups whose sum is the filter bank."""
        out = []
        for w, kernel in zip(WIDTHS, self.kernels, strict=True):
            single = [self.embed @ kernel[k] for k in range(w)]
            looks = [((single[k][:, None, :] + single[k + 1][None, :, :]).reshape(65536, FILTERS), k, True) for k in range(0, w - 1, 2)]
            out.append((w, looks + ([(single[w - 1], w - 1, False)] if w % 2 else [])))
        return out

    def probabilities(self, x: np.ndarray, tables, chunk: int = 128) -> np.ndarray:
        pooled = np.empty((len(x), len(WIDTHS) * FILTERS), np.float32)
        for lo in range(0, len(x), chunk):
            part = x[lo : lo + chunk]
            pair = (part[:, :-1].astype(np.int32) << 8) | part[:, 1:]
            for j, (w, looks) in enumerate(tables):
                n = WINDOW - w + 1
                total = None
                for table, k, paired in looks:
                    got = table.take((pair if paired else part)[:, k : k + n], axis=0)
                    total = got if total is None else np.add(total, got, out=total)
                pooled[lo : lo + chunk, j * FILTERS : (j + 1) * FILTERS] = total.max(1)
        return _softmax(np.maximum(pooled + self.bias, 0) @ self.dense + self.out)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def train(rows: list[tuple[str, str]], seed: int = 3) -> ByteConvNet | None:
    """A network from (text, language) rows; None without usable rows."""
    rows = [(t.encode(), y) for t, y in rows if t and y and _LETTER.search(t)]
    langs = sorted({y for _, y in rows})
    if not langs:
        return None
    data = np.frombuffer(b"".join(t for t, _ in rows), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t, _ in rows])))
    x, doc, _ = windows_of(data, offsets)
    rng = np.random.default_rng(seed)
    y = np.array([langs.index(v) for _, v in rows])[doc]
    # short texts are windows too: a third of the windows is cut short
    cut = np.where(rng.random(len(x)) < 1 / 3, rng.integers(8, 80, len(x)), WINDOW)
    x[np.arange(WINDOW)[None, :] >= cut[:, None]] = 0
    net = ByteConvNet(langs, seed)
    if len(langs) > 1:
        net.train(x, y)
    return net


def _classified(net: ByteConvNet | None, tables, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    letters = np.array([bool(t.is_valid and _LETTER.search(t.as_py())) for t in texts], bool)
    lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
    data, offsets = utf8(texts)
    for lo, hi, part, offs in sub_batches(data, offsets, 1 << 20) if net else ():
        x, doc, length = windows_of(part, offs)
        if not len(x):
            continue
        prob = net.probabilities(x, tables).astype(np.float64) * length[:, None]
        total = np.zeros((hi - lo, prob.shape[1]))
        np.add.at(total, doc, prob)
        total /= np.maximum(total.sum(1, keepdims=True), 1e-300)
        top = total.argmax(1)
        for i in range(hi - lo):
            if letters[lo + i]:
                lang[lo + i], score[lo + i] = net.langs[top[i]], min(1.0, total[i, top[i]])
    return lang, score


def _predictor(model):
    def predict(batches):
        net = model.value
        tables = net.tables() if net else None
        for batch in batches:
            lang, score = _classified(net, tables, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score)], names=["key", "lang_pred", "score"])

    return predict


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = TRAIN_DOCS) -> ByteConvNet | None:
    """Trains on the whole texts of at most ``most`` labelled documents (by hash order of ids, one row an id, 64 million
    characters) that have a language, a text and ``learn``. None if there is no such row; other columns are not read."""
    keep = learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
    rows = sample_rows(docs, id_col, keep, [text_col, lang_col], most, 11)
    return train([(r[1], r[2]) for r in rows])


def predict(docs: DataFrame, net: ByteConvNet | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, lang_pred, score``, row by row.

    Null texts and texts without a letter get ``und`` and score 0; so does everything if there was nothing to learn from.
    Otherwise the whole text counts, however long, and the score is the mean probability (0 to 1) of the language. Ties go
    to the first language in alphabetical order. An empty table gives an empty result; other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(net)  # fixed size: its parameters
    rows = docs.select(F.col(id_col).cast("bigint").alias("key"), F.col(text_col))
    return rows.mapInArrow(_predictor(model), "key bigint, lang_pred string, score double").withColumnRenamed("key", id_col)


def known_language(docs: DataFrame, net: ByteConvNet | None, text_col: str = "text", least: float = 0.4) -> DataFrame:
    """The rows of ``docs``, unchanged, whose language is predicted with a score of at least ``least``; ``und`` goes.

    So null, empty and blank texts and texts without a letter go, and everything if there is no model. Rows are judged one
    by one: repeats and null ids need no special case, other columns pass through, an empty table gives an empty one.
    """
    model = docs.sparkSession.sparkContext.broadcast(net)

    def keep(batches):
        tables = model.value.tables() if model.value else None
        for batch in batches:
            _, score = _classified(model.value, tables, batch.column(batch.schema.get_field_index(text_col)))
            yield batch.filter(pa.array((score >= least) & (score > 0)))

    return docs.mapInArrow(keep, docs.schema)
