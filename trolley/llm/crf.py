"""Quality classifier: a linear-chain conditional random field labels every line
good or bad from its own and its neighbours' features; the lines' marginals,
weighted by length, make up the document's score."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import bytes_and_offsets, fresh_name, row_slices, text_column, word_hashes, words_of

#: the field is fitted on so many labelled documents at most, in hash order, of so many lines each at most
TRAINING_DOCUMENTS, TRAINING_LINES = 2000, 300
ROUNDS, RATE, RIDGE = 400, 0.2, 1e-5

#: character classes: lower, upper, digit, white space, sentence marks, bars, other ASCII, first byte of the rest
_N_CLASSES = 8
_CLASS = np.full(256, 6, np.int64)
_CLASS[ord("a"):ord("z") + 1] = 0
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("0"):ord("9") + 1] = 2
_CLASS[[9, 11, 12, 13, 32]] = 3
_CLASS[list(b".,;:!?'\"()-")] = 4
_CLASS[ord("|")] = 5
_CLASS[0xC0:] = 7
_CLASS[0x80:0xC0] = 8
_OWN = _N_CLASSES + 6
N_FEATURES = 3 * _OWN + 3


def line_features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line (own, those of the line before and the line after), the
    line's document, and its length in bytes.  Every document has a line at least."""
    breaks = np.flatnonzero(data == 10)
    first = np.sort(np.concatenate([off[:-1], breaks + 1]), kind="stable")
    # a line feed that ends a document begins an empty line of it; a break's line belongs to the break's document
    row = np.sort(np.concatenate([np.arange(len(off) - 1), np.searchsorted(off, breaks, "right") - 1]), kind="stable")
    last = np.append(first[1:], len(data))
    same = np.append(row[1:] == row[:-1], False)
    last = np.where(same, last - 1, off[row + 1])
    n, size = len(first), last - first

    line_of = np.zeros(len(data) + 1, np.int64)
    np.add.at(line_of, first, 1)
    line_of = np.cumsum(line_of)[:len(data)] - 1
    cls = _CLASS[data]
    use = (cls < _N_CLASSES) & (data != 10)
    hist = np.bincount(line_of[use] * _N_CLASSES + cls[use], minlength=n * _N_CLASSES).reshape(n, _N_CLASSES)
    chars = hist.sum(axis=1)

    start, end, word_row = words_of(data, off)
    code = word_hashes(data, start, end)
    word_line = line_of[start]
    words = np.bincount(word_line, minlength=n)
    order = np.lexsort((code, word_line))
    new = np.append(True, (code[order][1:] != code[order][:-1]) | (word_line[order][1:] != word_line[order][:-1])) if len(code) else np.zeros(0, bool)
    distinct = np.bincount(word_line[order][new], minlength=n)
    # words that the document has had before
    by_doc = np.lexsort((np.arange(len(code)), code, word_row))
    again = np.zeros(len(code), bool)
    again[by_doc[1:]] = (code[by_doc][1:] == code[by_doc][:-1]) & (word_row[by_doc][1:] == word_row[by_doc][:-1])
    repeated = np.bincount(word_line[again], minlength=n)
    short = np.bincount(word_line[end - start <= 3], minlength=n)

    own = np.zeros((n, _OWN))
    own[:, :_N_CLASSES] = hist / np.maximum(chars, 1)[:, None]
    w = np.maximum(words, 1)
    own[:, _N_CLASSES:] = np.column_stack([distinct / w, repeated / w, short / w, np.minimum(chars / w, 20) / 20,
                                           np.log1p(words) / 8, (words == 0)])
    before, after = np.zeros_like(own), np.zeros_like(own)
    inner = np.flatnonzero(same)
    before[inner + 1], after[inner] = own[inner], own[inner + 1]
    edge = np.ones((n, 2))
    edge[inner + 1, 0], edge[inner, 1] = 0, 0
    return np.concatenate([own, before, after, edge, np.ones((n, 1))], axis=1), row, size


def _by_length(row: np.ndarray):
    """Documents in groups of similar length: places of their lines (padded with -1)."""
    count = np.bincount(row)
    first = np.cumsum(count) - count
    group = np.ceil(np.log2(np.maximum(count, 1))).astype(int)
    for g in np.unique(group[count > 0]):
        docs = np.flatnonzero((group == g) & (count > 0))
        width = int(count[docs].max())
        place = first[docs][:, None] + np.arange(width)
        yield np.where(np.arange(width) < count[docs][:, None], place, -1)


def _lse(a, b):
    return np.logaddexp(a, b)


def forward_backward(node: np.ndarray, edge: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of the label good that come to each line from the left (its own
    included) and from the right; ``edge[i, j]`` scores label j after label i."""
    x = np.where(place >= 0, node[place], 0.0)
    left, right = x.copy(), np.zeros_like(x)
    for t in range(1, x.shape[1]):
        f = left[:, t - 1]
        left[:, t] = x[:, t] + _lse(edge[0, 1], f + edge[1, 1]) - _lse(edge[0, 0], f + edge[1, 0])
    for t in range(x.shape[1] - 2, -1, -1):
        b = x[:, t + 1] + right[:, t + 1]
        step = _lse(edge[1, 0], b + edge[1, 1]) - _lse(edge[0, 0], b + edge[0, 1])
        right[:, t] = np.where(place[:, t + 1] >= 0, step, 0.0)
    return left, right


def marginals(node: np.ndarray, edge: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Probability of the label good for each line."""
    out = np.zeros(len(node))
    for place in _by_length(row):
        left, right = forward_backward(node, edge, place)
        real = place >= 0
        out[place[real]] = 1 / (1 + np.exp(-np.clip(left + right, -500, 500)[real]))
    return out


def fit(features: np.ndarray, row: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and edge scores that maximise the likelihood of the lines' labels
    (Adam over all documents at once)."""
    groups = list(_by_length(row))
    n = len(features)
    theta = np.zeros(features.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for round_ in range(1, ROUNDS + 1):
        node, edge = features @ theta[:-4], theta[-4:].reshape(2, 2)
        expect, pair = np.zeros(n), np.zeros((2, 2))
        for place in groups:
            left, right = forward_backward(node, edge, place)
            real = place >= 0
            expect[place[real]] = 1 / (1 + np.exp(-np.clip(left + right, -500, 500)[real]))
            if place.shape[1] > 1:
                both = real[:, 1:]
                f, b = left[:, :-1][both], (np.where(real, node[place], 0.0) + right)[:, 1:][both]
                score = np.stack([edge[0, 0] + 0 * f, edge[0, 1] + b, edge[1, 0] + f, edge[1, 1] + f + b])
                p = np.exp(score - score.max(axis=0))
                y = label[place]
                seen = np.array([((1 - y[:, :-1]) * (1 - y[:, 1:]))[both].sum(), ((1 - y[:, :-1]) * y[:, 1:])[both].sum(),
                                 (y[:, :-1] * (1 - y[:, 1:]))[both].sum(), (y[:, :-1] * y[:, 1:])[both].sum()])
                pair += (seen - (p / p.sum(axis=0)).sum(axis=1)).reshape(2, 2)
        grad = np.concatenate([features.T @ (label - expect), pair.ravel()]) / n - RIDGE * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta += RATE * (m / (1 - 0.9 ** round_)) / (np.sqrt(v / (1 - 0.999 ** round_)) + 1e-8)
    return theta[:-4], theta[-4:].reshape(2, 2)


def train(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Fits the field on ``labelled`` (columns text, label 0 or 1): at most
    TRAINING_DOCUMENTS rows arrive, and texts of more than TRAINING_LINES lines are
    passed over.  Every line has its document's label.  Without rows every
    score is one half."""
    some = labelled.where(F.size(F.split("text", "\n")) <= TRAINING_LINES).select("text", F.col("label").cast("double")).collect()
    if not some:
        return np.zeros(N_FEATURES), np.zeros((2, 2))
    some.sort(key=lambda r: r[0])  # the order of sums, and so the fit, doesn't depend on the tasks
    data, off = bytes_and_offsets(pa.array([r[0] for r in some]))
    features, row, _ = line_features(data, off)
    return fit(features, row, np.array([r[1] for r in some])[row])


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``docs`` (doc_id and text) with score, predicted, n_lines and bad_lines.

    The score is the mean of the lines' marginals, each by its length and one
    byte more, so an empty or null text is one empty line.  Repeated rows get
    equal scores, null doc_ids stay, an empty table gives no rows.
    """
    weights, edge = model
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32()),
                        ("n_lines", pa.int64()), ("bad_lines", pa.int64())])

    def run(batches):
        for batch in batches:
            for part in row_slices(batch, "text"):
                data, off = bytes_and_offsets(text_column(part, "text"))
                features, row, size = line_features(data, off)
                good = marginals(features @ weights, edge, row)
                n = len(off) - 1
                value = np.bincount(row, good * (size + 1), n) / np.bincount(row, size + 1, n)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(value), pa.array((value >= 0.5).astype(np.int32)),
                                                  pa.array(np.bincount(row, minlength=n)),
                                                  pa.array(np.bincount(row[good < 0.5], minlength=n))], schema=schema)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, score double, predicted int, n_lines long, bad_lines long"))


def held_out():
    """Documents that no label is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (and line counts) of every row of ``docs``.

    Labels of held-out documents are not looked at; documents whose labels
    disagree or are null teach nothing.
    """
    name = fresh_name(docs.columns, "label")
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.min("quality").alias(name), F.max("quality").alias("_most")).where(F.col(name) == F.col("_most"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAINING_DOCUMENTS).select("doc_id", name))
    model = train(docs.where("text is not null").join(F.broadcast(known), "doc_id").select("text", F.col(name).alias("label")))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted", "n_lines", "bad_lines")
