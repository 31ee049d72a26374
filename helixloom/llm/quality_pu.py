"""Document quality by positive-unlabelled learning.

A small network is trained in numpy on trusted positives and unlabelled web text by minimising the non-negative unbiased
risk (Kiryo et al. 2017): with class prior p, loss l, R = p R_P(+) + max(0, R_U(-) - p R_P(-)); when the difference turns
negative the step goes against it. The prior is estimated from a first classifier of positives against unlabelled text:
the least ratio of the shares of all texts and of held-back positives above a threshold, with a confidence margin.
A logistic calibration on labelled rows turns the output into a probability.

Networks are trained on bounded samples; what describes the corpus covers all of its texts: means and deviations of the
features come from one pass, the shares above the thresholds from another.

Features are computed for whole texts from their bytes: frequencies of pairs of neighbouring byte classes, and shares of
distinct, of most frequent and of repeated words, lengths of words and lines.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixloom.llm.sampling import rows_of, sample_rows
from helixloom.llm.words import sub_batches, utf8, word_hashes, word_spans

MOST_POSITIVE = 2500
MOST_UNLABELLED = 3500
CUT = 0.7
HIDDEN = 16


def _byte_classes() -> np.ndarray:
    """Letters by case, digits, white space and each common mark apart; bytes of longer code points by their lead."""
    groups = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", "\t\r\x0b\x0c", ".", ",", "!", "?", ";:", "|", "#", "$", "%", "&", "*", "@", "-_", "=+~^", "/\\", "<>", "()[]{}", "\"'`"]
    table = np.full(256, len(groups), np.uint8)
    for i, chars in enumerate(groups):
        table[[ord(c) for c in chars]] = i
    table[128:192] = len(groups) + 1
    table[192:] = len(groups) + 2
    return table


CLASS = _byte_classes()
CLASSES = int(CLASS.max()) + 1
EXTRA = 9
WIDTH = CLASSES * CLASSES + EXTRA


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of WIDTH numbers per document; zeros for an empty one."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    out = np.zeros((n, WIDTH), np.float32)
    kinds = CLASS[data].astype(np.int64)
    doc = np.repeat(np.arange(n, dtype=np.int64), sizes)
    if len(data) > 1:
        same = doc[1:] == doc[:-1]
        key = (doc[1:] * CLASSES + kinds[:-1]) * CLASSES + kinds[1:]
        pairs = np.bincount(key[same], minlength=n * CLASSES * CLASSES).reshape(n, -1)
        out[:, : CLASSES * CLASSES] = np.sqrt(pairs / np.maximum(sizes - 1, 1)[:, None])
    starts, ends, first = word_spans(data, offsets)
    words = word_hashes(data, starts, ends)
    count = np.diff(first)
    lengths = np.concatenate(([0], np.cumsum(ends - starts)))
    lines = np.concatenate(([0], np.cumsum(data == 10)))
    again = np.concatenate(([0], np.cumsum(np.concatenate(([False], words[1:] == words[:-1])))))
    for i in np.flatnonzero(count):
        lo, hi, n = first[i], first[i + 1], count[i]
        _, each = np.unique(words[lo:hi], return_counts=True)
        repeat = (again[hi] - again[lo + 1]) / n
        out[i, -EXTRA:] = (len(each) / n, np.log(len(each) / n) / 4, each.max() / n, np.sqrt(repeat), np.log1p(len(each)) / 10, (lengths[hi] - lengths[lo]) / n / 10, np.log1p(n) / 10, (lines[offsets[i + 1]] - lines[offsets[i]]) / n, 1)
    return out


class Net:
    """One hidden layer; output is a margin."""

    def __init__(self, seed: int, mean: np.ndarray, scale: np.ndarray):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.w = rng.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, HIDDEN)).astype(np.float32)
        self.b = np.zeros(HIDDEN, np.float32)
        self.v = rng.normal(0, 0.3, HIDDEN).astype(np.float32)
        self.c = np.zeros(1, np.float32)
        self.slope, self.shift = 1.0, 0.0

    def ready(self, x):
        return np.clip((x - self.mean) / self.scale, -5, 5).astype(np.float32)

    def margin(self, z):
        return np.tanh(z @ self.w + self.b) @ self.v + self.c[0]

    def gradients(self, z, d):
        """Of the sum of margins weighted by ``d``."""
        h = np.tanh(z @ self.w + self.b)
        back = (d[:, None] * self.v) * (1 - h * h)
        return [z.T @ back, back.sum(0), h.T @ d, d.sum(keepdims=True)]

    def params(self):
        return [self.w, self.b, self.v, self.c]

    def score(self, x):
        return _sigmoid(self.slope * self.margin(self.ready(x)).astype(np.float64) + self.shift)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class _Adam:
    def __init__(self, params, rate, decay):
        self.params, self.rate, self.decay, self.step = params, rate, decay, 0
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]

    def move(self, grads):
        self.step += 1
        for p, g, (m, v) in zip(self.params, grads, self.moments, strict=True):
            g = g + self.decay * p
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= self.rate * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)


def train_risk(net: Net, pos: np.ndarray, unl: np.ndarray, prior: float, epochs: int = 40, batch: int = 500, seed: int = 1) -> None:
    """Non-negative unbiased risk with the sigmoid loss l(z) = 1 / (1 + e^z)."""
    rng = np.random.default_rng(seed)
    adam = _Adam(net.params(), 3e-3, 1e-3)
    steps = max(1, len(unl) // batch)
    for _ in range(epochs):
        pi, ui = rng.permutation(len(pos)), rng.permutation(len(unl))
        for s in range(steps):
            p, u = pos[pi[s::steps]], unl[ui[s::steps]]
            if not len(p) or not len(u):
                continue
            mp, mu = _sigmoid(net.margin(p)), _sigmoid(net.margin(u))
            slope_p, slope_u = mp * (1 - mp) / len(p), mu * (1 - mu) / len(u)
            negative = mu.mean() - prior * mp.mean()
            if negative >= 0:
                dp, du = -prior * slope_p - prior * slope_p, slope_u
            else:
                dp, du = prior * slope_p, -slope_u
            a, b = net.gradients(p, dp.astype(np.float32)), net.gradients(u, du.astype(np.float32))
            adam.move([x + y for x, y in zip(a, b, strict=True)])


def train_plain(net: Net, x: np.ndarray, y: np.ndarray, epochs: int = 25, batch: int = 500, seed: int = 2) -> None:
    """Balanced logistic loss."""
    rng = np.random.default_rng(seed)
    adam = _Adam(net.params(), 3e-3, 1e-3)
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6))
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), batch):
            i = order[lo : lo + batch]
            d = (_sigmoid(net.margin(x[i])) - y[i]) * weight[i] / len(i)
            adam.move(net.gradients(x[i], d.astype(np.float32)))


def estimated_prior(pos: np.ndarray, unl: np.ndarray, mean: np.ndarray, scale: np.ndarray, above=None, seed: int = 4) -> float:
    """Share of positives in unlabelled text, from a classifier of every other row. ``above`` (network, thresholds) counts the
    corpus: how many texts reach each threshold, and all texts; without it the other unlabelled rows stand for the corpus."""
    net = Net(seed, mean, scale)
    train_plain(net, np.concatenate((pos[::2], unl[::2])), np.concatenate((np.ones(len(pos[::2])), np.zeros(len(unl[::2])))))
    p, u = np.sort(net.margin(pos[1::2])), np.sort(net.margin(unl[1::2]))
    if not len(p) or not len(u):
        return 0.5
    steps = np.quantile(p, np.linspace(0, 0.95, 96))
    counts, n = above(net, steps) if above else (len(u) - np.searchsorted(u, steps), len(u))
    qp, qu = 1 - np.searchsorted(p, steps) / len(p), counts / n
    width = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(p)) + 1 / np.sqrt(n))
    ok = qp > 0
    best = np.argmin((qu[ok] + width) / qp[ok])
    return float(np.clip(qu[ok][best] / qp[ok][best], 0.05, 0.98))


def calibrate(net: Net, x: np.ndarray, y: np.ndarray) -> None:
    """Logistic regression of the label on the margin, with smoothed targets."""
    m = net.margin(net.ready(x)).astype(np.float64)
    if not 0 < y.sum() < len(y):
        return
    up, down = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    ab = np.array([1.0, 0.0])
    design = np.stack((m, np.ones_like(m)), 1)
    for _ in range(50):
        q = _sigmoid(design @ ab)
        hess = (design * (q * (1 - q))[:, None]).T @ design + 1e-6 * np.eye(2)
        move = np.linalg.solve(hess, design.T @ (q - target))
        ab -= np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-9:
            break
    net.slope, net.shift = float(max(ab[0], 1e-3)), float(ab[1])


def _matrix(texts: list[str]) -> np.ndarray:
    out = []
    for text in texts:
        raw = np.frombuffer(text.encode(), np.uint8)
        out.append(features(raw, np.array([0, len(raw)])))
    return np.concatenate(out) if out else np.zeros((0, WIDTH), np.float32)


#: Feature sums are kept in whole units of 2^-16, so that they don't depend on the order of adding.
UNIT = 1 << 16


def feature_sums(x: np.ndarray) -> np.ndarray:
    """Number of rows, and sums and sums of squares of each feature in units."""
    units = np.rint(x.astype(np.float64) * UNIT)
    squares = np.rint(x.astype(np.float64) ** 2 * UNIT)
    return np.concatenate(([len(x)], units.sum(0), squares.sum(0))).astype(np.int64)


def moments(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations out of ``feature_sums``."""
    n = max(1, int(sums[0]))
    mean, square = (sums[1 + i * WIDTH : 1 + (i + 1) * WIDTH] / UNIT / n for i in (0, 1))
    return mean.astype(np.float32), (np.sqrt(np.maximum(square - mean**2, 0)) + 1e-3).astype(np.float32)


def train(labelled: list[tuple[str, int]], unlabelled: list[str], about: tuple[np.ndarray, np.ndarray] | None = None, above=None, seed: int = 4) -> Net | None:
    """A calibrated network; None without positives or unlabelled texts. ``about`` (means and deviations of the features) and
    ``above`` (see ``estimated_prior``) describe the corpus; without them the unlabelled texts do."""
    x, y = _matrix([t for t, _ in labelled]), np.array([v for _, v in labelled], np.float64)
    u = _matrix(unlabelled)
    if not y.sum() or not len(u):
        return None
    mean, scale = about or moments(feature_sums(u))
    net = Net(seed, mean, scale)
    pos, unl = net.ready(x[y == 1]), net.ready(u)
    net.prior = estimated_prior(pos, unl, mean, scale, above)
    train_risk(net, pos, unl, net.prior)
    calibrate(net, x, y)
    return net


def _features_of(batches):
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        for _, _, part, offs in sub_batches(data, offsets, 1 << 20):
            yield features(part, offs)


def _added(rows: DataFrame, size: int) -> np.ndarray:
    """The sums by place of rows (at, n): at most ``size`` numbers reach the driver."""
    out = np.zeros(size, np.int64)
    for at, n in rows.groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[at] = n
    return out


def _placed(values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["at", "n"])


def corpus_moments(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the features of all rows of ``texts`` (one column)."""

    def run(batches):
        total = np.zeros(1 + 2 * WIDTH, np.int64)
        for x in _features_of(batches):
            total += feature_sums(x)
        yield _placed(total)

    return moments(_added(texts.mapInArrow(run, "at bigint, n bigint"), 1 + 2 * WIDTH))


def corpus_above(texts: DataFrame):
    """For ``estimated_prior``: counts over all rows of ``texts``."""

    def above(net: Net, steps: np.ndarray) -> tuple[np.ndarray, int]:
        sent = texts.sparkSession.sparkContext.broadcast(net)  # fixed size: its parameters

        def run(batches):
            total = np.zeros(len(steps) + 1, np.int64)
            for x in _features_of(batches):
                margins = np.sort(sent.value.margin(sent.value.ready(x)))
                total[:-1] += len(margins) - np.searchsorted(margins, steps)
                total[-1] += len(margins)
            yield _placed(total)

        counts = _added(texts.mapInArrow(run, "at bigint, n bigint"), len(steps) + 1)
        return counts[:-1], max(1, int(counts[-1]))

    return above


def _scores(net: Net | None, texts: pa.Array) -> np.ndarray:
    out = np.zeros(len(texts))
    data, offsets = utf8(texts)
    for lo, hi, part, offs in sub_batches(data, offsets, 1 << 20) if net else ():
        out[lo:hi] = net.score(features(part, offs))
    return out


def _scorer(model, cut: float):
    def score(batches):
        for batch in batches:
            out = _scores(model.value, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out), pa.array((out >= cut).astype(np.int32))], names=["key", "score", "predicted"])

    return score


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most_labelled: int = MOST_POSITIVE, most_unlabelled: int = MOST_UNLABELLED) -> Net | None:
    """Trains on at most ``most_labelled`` labelled documents and ``most_unlabelled`` documents of any kind, both where
    ``learn`` holds and by hash order of ids, one row an id, each sample of 64 million characters at most. Labels other
    than 0 and 1, null ids and null texts are left out; of contradicting labels of an id one counts. Features are scaled, and
    the prior is estimated, by all rows of ``docs`` where ``learn`` holds, two passes over their whole texts. None if there
    are no positives or no texts. Other columns are not read."""
    picked = {r[0]: int(r[1]) for r in sample_rows(labels, id_col, learn & F.col(label_col).isin(0, 1), [label_col], most_labelled, 21)}
    has_text = F.col(text_col).isNotNull()
    labelled = rows_of(docs, id_col, list(picked), [text_col], has_text)
    others = sample_rows(docs, id_col, learn & has_text, [text_col], most_unlabelled, 22)
    if not any(picked[i] for i, _ in labelled) or not others:
        return None
    texts = docs.where(learn & has_text).select(F.col(text_col).alias("text"))
    return train([(text, picked[i]) for i, text in labelled], [text for _, text in others], corpus_moments(texts), corpus_above(texts))


def predict(docs: DataFrame, net: Net | None, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """``<id_col>, score, predicted``, row by row: 0 to 1, and 1 where the score reaches ``cut``.

    Null texts are scored like empty ones, from features that are all zero. Without a model (no positives) scores are 0.
    Whole texts count; an empty table gives an empty result; other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(net)  # fixed size: its parameters
    rows = docs.select(F.col(id_col).cast("bigint").alias("key"), F.col(text_col))
    return rows.mapInArrow(_scorer(model, cut), "key bigint, score double, predicted int").withColumnRenamed("key", id_col)


def good_quality(docs: DataFrame, net: Net | None, text_col: str = "text", cut: float = 0.5) -> DataFrame:
    """The rows of ``docs``, unchanged, whose score reaches ``cut``; all of them if there is no model.

    Null texts are scored like empty ones. Rows are judged one by one: repeats and null ids need no special case, other
    columns pass through, an empty table gives an empty one.
    """
    model = docs.sparkSession.sparkContext.broadcast(net)

    def keep(batches):
        for batch in batches:
            score = _scores(model.value, batch.column(batch.schema.get_field_index(text_col)))
            yield batch.filter(pa.array((score >= cut) | (model.value is None)))

    return docs.mapInArrow(keep, docs.schema)
