"""Operator 10: document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own and its neighbours' features. Forward-backward gives
each line's marginal probability; a document's quality is their mean weighted by line length, mapped
to a probability by a logistic curve that is fitted on the training documents.

Null and empty texts have one empty line. Rows with a null label teach nothing; without labels of
both classes every score is 0.5. Equal texts have equal scores, so repeated rows and ties do, too; an
empty table gives an empty result. Texts are read whole, in training as well. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm.common import crc_mod, draw_labelled, table, text_chunks

#: Documents of each class in the training sample: the bound of what reaches the driver.
SAMPLE_PER_CLASS = 1_500
#: In training, chains run over so many lines at a time; a long text is several chains, with all its lines.
CHAIN_LINES = 64
ROUNDS = 150

_KIND = np.zeros((256, 7))  # byte -> letter, capital, digit, space, sentence mark, exclamation or bar, other symbol
for _b in range(256):
    _c = chr(_b)
    _KIND[_b] = [
        _c.isascii() and _c.isalpha() or _b >= 128, "A" <= _c <= "Z", _c.isascii() and _c.isdigit(), _b in (9, 11, 12, 13, 32), _c in ".,;:'\"-?()", _c in "!|",
        33 <= _b < 127 and not _c.isalnum() and _c not in ".,;:'\"-?()!|",
    ]
N_OWN = 12


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own features of every line, the line's UTF-8 length, lines of each text)."""
    lines = [t.encode().split(b"\n") for t in texts]
    counts = np.array([len(x) for x in lines])
    flat = [s for x in lines for s in x]
    lengths = np.array([len(s) for s in flat])
    raw = np.frombuffer(b"\n".join(flat) + b"\n", np.uint8)  # a line's end keeps every line's run non-empty
    starts = np.r_[0, np.cumsum(lengths + 1)[:-1]]
    kinds = np.empty((len(flat), 7))
    for k in range(7):
        kinds[:, k] = np.add.reduceat(_KIND[:, k].astype(np.uint8)[raw], starts, dtype=np.int64)
    share = kinds / np.maximum(lengths, 1)[:, None]
    words = [s.split() for s in flat]
    n_words = np.array([len(w) for w in words])
    distinct = np.array([len(set(w)) for w in words])
    repeated = np.zeros(len(flat))
    at = 0
    for x in lines:
        seen: set[bytes] = set()
        for i, s in enumerate(x, at):
            repeated[i] = s in seen and len(s) > 0
            seen.add(s)
        at += len(x)
    own = np.column_stack([
        share[:, 0], kinds[:, 1] / np.maximum(kinds[:, 0], 1), share[:, 2], np.minimum(share[:, 4] * 5, 1), np.minimum(share[:, 5] * 8, 1), np.minimum(share[:, 6] * 8, 1),
        np.minimum(lengths / np.maximum(n_words, 1) / 20, 2), np.log1p(n_words) / 6, distinct / np.maximum(n_words, 1), np.minimum(n_words / np.maximum(distinct, 1) - 1, 5) / 5, repeated, lengths == 0,
    ])
    return own, lengths, counts


def with_neighbours(own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each line's features, those of the lines before and after it in its text, and 1; missing neighbours are 0."""
    n = len(own)
    first = np.r_[0, np.cumsum(counts)[:-1]]
    before, after = np.vstack([np.zeros((1, own.shape[1])), own[:-1]]), np.vstack([own[1:], np.zeros((1, own.shape[1]))])
    before[first] = 0
    after[first + counts - 1] = 0
    return np.hstack([own, before, after, np.ones((n, 1))])


def _steps(counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Texts by falling number of lines, and the rows of line t of those that have one."""
    order = np.argsort(-counts, kind="stable")
    first, sizes = np.r_[0, np.cumsum(counts)[:-1]][order], counts[order]
    return order, [first[: np.searchsorted(-sizes, -t, side="left")] + t for t in range(int(sizes[0]))]


def marginals(unary: np.ndarray, transition: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(P(good) of each line, expected transitions summed over lines); unary is the log potential of good over bad."""
    _, steps = _steps(counts)
    potential = np.column_stack([np.zeros(len(unary)), unary])
    forward, backward = np.empty_like(potential), np.zeros_like(potential)
    moves = np.zeros((2, 2))
    forward[steps[0]] = potential[steps[0]]
    for here in steps[1:]:
        prior = forward[here - 1][:, :, None] + transition
        forward[here] = np.logaddexp(prior[:, 0], prior[:, 1]) + potential[here]
        forward[here] -= forward[here].max(1, keepdims=True)
    for here in reversed(steps[1:]):
        later = transition + (potential[here] + backward[here])[:, None, :]
        joint = np.exp((z := forward[here - 1][:, :, None] + later) - z.max((1, 2), keepdims=True))
        moves += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        out = np.logaddexp(later[:, :, 0], later[:, :, 1])
        backward[here - 1] = out - out.max(1, keepdims=True)
    both = forward + backward
    return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -40, 40))), moves


def _adam(w: np.ndarray, gradient, rounds: int, rate: float = 0.1) -> np.ndarray:
    m = v = np.zeros_like(w)
    for t in range(1, rounds + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _mean(values: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of each text, weighted by line length (an empty line weighs as one byte)."""
    first = np.r_[0, np.cumsum(counts)[:-1]]
    weight = np.maximum(lengths, 1)
    return np.add.reduceat(values * weight, first) / np.add.reduceat(weight, first)


def chains(counts: np.ndarray, most: int = CHAIN_LINES) -> np.ndarray:
    """Lines of the chains that texts of so many lines are cut into."""
    return np.concatenate([np.r_[np.full((c - 1) // most, most), (c - 1) % most + 1] for c in counts.tolist()])


class LineField:
    """The field's weights, fitted to labels of documents.

    All lines of good documents are good. In bad documents a line starts as bad if a model of single
    lines thinks so, and the worst line always is; the chain is then fitted to these line labels.
    """

    def __init__(self, own: np.ndarray, lengths: np.ndarray, counts: np.ndarray, y: np.ndarray):
        x, n = with_neighbours(own, counts), len(own)
        document = np.repeat(np.arange(len(counts)), counts)
        weight = 1 / counts[document]
        good = y[document].astype(float)
        single = _adam(np.zeros(x.shape[1]), lambda w: x.T @ (weight * (_sigmoid(x @ w) - good)) / weight.sum() + 1e-4 * w, ROUNDS)
        p = _sigmoid(x @ single)
        worst = np.minimum.reduceat(p, np.r_[0, np.cumsum(counts)[:-1]])[document]
        target = np.where(good == 1, 1.0, (p > 0.5) & (p > worst))
        moved = np.zeros((2, 2))
        inner, cut = np.ones(n, bool), chains(counts)
        inner[np.r_[0, np.cumsum(cut)[:-1]]] = False
        np.add.at(moved, (target[:-1][inner[1:]].astype(int), target[inner].astype(int)), 1)

        def gradient(w: np.ndarray) -> np.ndarray:
            q, moves = marginals(x @ w[4:], w[:4].reshape(2, 2), cut)
            return np.r_[(moves - moved).ravel(), x.T @ (q - target)] / n + 1e-4 * w

        w = _adam(np.r_[np.zeros(4), single], gradient, ROUNDS, 0.05)
        self.transition, self.unary = w[:4].reshape(2, 2), w[4:]
        raw = _mean(self.lines(own, counts), lengths, counts)
        balance = np.where(y, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
        z = np.column_stack([raw, np.ones(len(raw))])
        self.curve = _adam(np.array([4.0, -2.0]), lambda v: z.T @ (balance * (_sigmoid(z @ v) - y)) / len(y) + 1e-4 * v, 400)

    def lines(self, own: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """P(good) of every line."""
        return marginals(with_neighbours(own, counts) @ self.unary, self.transition, counts)[0]

    def documents(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(score, length-weighted mean of P(good)) of each text."""
        own, lengths, counts = line_features(texts)
        raw = _mean(self.lines(own, counts), lengths, counts)
        return _sigmoid(raw * self.curve[0] + self.curve[1]), raw


def fit(docs: DataFrame, marks: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", per_class: int = SAMPLE_PER_CLASS) -> LineField | None:
    """A field from a bounded sample, drawn by a hash of the key, of the documents that marks (key, label 0/1/null) label."""
    drawn = draw_labelled(docs, marks.select(key, F.col(label).cast("int").alias("y")), key, "y", per_class)
    if drawn is None:
        return None

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in text_chunks(batch, text):
                own, lengths, n = line_features(texts)
                ends = np.cumsum(n)
                spans = [slice(e - c, e) for e, c in zip(ends, n, strict=True)]
                part = batch.slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([own[s].astype("<f4").tobytes() for s in spans], pa.binary()), pa.array([lengths[s].astype("<i4").tobytes() for s in spans], pa.binary())], names=["draw", "y", "own", "lengths"])

    rows = docs.select(key, text).join(F.broadcast(drawn), key).select("draw", "y", text)  # at most 2 x per_class labels
    # documents that share an id enter together; the sample's bound holds for them, too
    place = F.row_number().over(Window.partitionBy("y").orderBy("draw", F.xxhash64("own")))
    found = rows.mapInArrow(featurize, "draw long, y int, own binary, lengths binary").withColumn("place", place).filter(F.col("place") <= per_class)
    sample = sorted(found.collect(), key=lambda r: (r.draw, r.y, r.place))
    y = np.array([r.y == 1 for r in sample])
    if len(set(y.tolist())) < 2:
        return None
    own = np.frombuffer(b"".join([r.own for r in sample]), "<f4").reshape(-1, N_OWN).astype(np.float64)
    lengths = np.frombuffer(b"".join([r.lengths for r in sample]), "<i4").astype(np.int64)
    return LineField(own, lengths, np.array([len(r.lengths) // 4 for r in sample]), y)


def score(docs: DataFrame, field: LineField | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, predicted, good_share) of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(field)  # under a hundred numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in text_chunks(batch, text):
                p, raw = shared.value.documents(texts) if shared.value else (np.full(len(texts), 0.5), np.full(len(texts), 0.5))
                ids = batch.column(batch.schema.get_field_index(key)).slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays([ids, pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(raw)], names=[key, "score", "predicted", "good_share"])

    return docs.select(key, text).mapInArrow(run, f"{key} long, score double, predicted int, good_share double")


def op10_quality_lines(spark, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), crc_mod("doc_id", 3) == 1
    out = score(docs, fit(docs, table(spark, sf_dir, "labels").filter(~held_out)))
    return out.select("doc_id", held_out.alias("held_out"), "score", "predicted", "good_share")
