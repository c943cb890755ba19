"""Operator 1: toxicity by a classifier chain.

Linear models in a fixed order predict toxicity categories; each also sees the probabilities of the
categories before it. During training those probabilities are out-of-fold predictions: features are
chosen and weights fitted without the fold, so a later model learns from the errors its inputs will
really have. The categories come from the labels: poor text, poor and toxic text, toxic text.

Null and empty texts have no features: their probabilities are those of the intercepts. Documents
that share a labelled id all count; null labels teach their category nothing. Without labels of both
classes every probability is 0. Repeated rows are scored alike; features that tie in weight are taken in
the order of their names, and drawn documents that tie in that of their ids; an empty table gives an
empty result.
Texts are read whole, whatever their length. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm.common import crc_mod, draw_labelled, keep, table, text_chunks

#: Documents of each class in the training sample, and features of a category: the bounds of what reaches the driver.
SAMPLE_PER_CLASS, FEATURES, FOLDS = 2_000, 600, 5
#: Word starts of these lengths are features beside whole words, so that inflected forms count.
STEMS = (4, 5, 6)
CATEGORIES = ("poor", "poor_toxic", "toxic")
#: Different words whose features one worker remembers.
CACHE_WORDS = 100_000
_WORD = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[str]:
    return [f"={word}", *(f"{word[:n]}*" for n in STEMS if len(word) > n)]


def document_features(text: str) -> set[str]:
    return {f for w in set(_WORD.findall(text.lower())) for f in features_of(w)}


class Linear:
    """Logistic regression with an L2 penalty, by accelerated gradient descent."""

    def __init__(self, x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 200):
        n = len(y)
        x, y = np.hstack([x, np.ones((n, 1))]).astype(np.float32), y.astype(np.float32)
        step = np.float32(4 / (np.linalg.eigvalsh((x.T @ x).astype(np.float64))[-1] / n + 4 * penalty) if n else 0)
        w = v = np.zeros(x.shape[1], np.float32)
        for t in range(rounds):
            gradient = (_sigmoid(x @ v) - y) @ x / np.float32(max(n, 1))
            gradient[:-1] += np.float32(penalty) * v[:-1]
            new = v - step * gradient
            v, w = new + np.float32(t / (t + 3)) * (new - w), new
        self.weights, self.bias = w[:-1].astype(np.float64), float(w[-1])

    def predict(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(x @ self.weights + self.bias)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def select_features(sample: DataFrame, categories: list[str], limit: int = FEATURES) -> dict[tuple[str, int], list[str]]:
    """Of each category, and each fold left out (-1: none), the features that say most, by the z-score of the smoothed log odds.

    sample is a stored table (fold, one 0/1/null column a category, found).
    """
    sides = {f"{c}_{y}": F.col(c) == y for c in categories for y in (1, 0)}
    parts = [F.count_if(s & (F.col("fold") == k)).alias(f"{n}_{k}") for n, s in sides.items() for k in range(FOLDS)]
    sizes = sample.agg(*parts).first().asDict()
    per = sample.select("fold", *categories, F.explode("found").alias("f")).groupBy("f").agg(*parts)
    ranked = []
    for c in categories:
        for left_out in range(-1, FOLDS):
            a, b = ([f"{c}_{y}_{k}" for k in range(FOLDS) if k != left_out] for y in (1, 0))
            yes, no = sum((F.col(x) for x in a), F.lit(0.5)), sum((F.col(x) for x in b), F.lit(0.5))
            z = F.abs(F.log(yes / (sum(sizes[x] for x in a) + 1)) - F.log(no / (sum(sizes[x] for x in b) + 1))) / F.sqrt(1 / yes + 1 / no)
            ranked.append(F.struct(F.lit(c).alias("c"), F.lit(left_out).alias("k"), F.when(yes + no >= 4, F.round(z, 9)).alias("z")))
    place = F.row_number().over(Window.partitionBy("c", "k").orderBy(F.desc("z"), "f"))
    best = per.select("f", F.inline(F.array(*ranked))).filter("z is not null").withColumn("place", place).filter(F.col("place") <= limit)
    out: dict[tuple[str, int], list[str]] = {(c, k): [] for c in categories for k in range(-1, FOLDS)}
    for r in sorted(best.collect(), key=lambda r: r.place):
        out[r.c, r.k].append(r.f)
    return out


class Chain:
    """One linear model per category, in order: columns of x, and the probabilities of the categories before it."""

    def __init__(self, x: np.ndarray, labels: dict[str, np.ndarray], folds: np.ndarray, chosen: dict[tuple[str, int], np.ndarray]):
        """labels hold 0, 1 or NaN; chosen has the columns of each category's model and of each of its folds' models."""
        self.categories, self.models, self.columns = list(labels), [], []
        earlier = np.zeros((len(x), 0))
        for c, y in labels.items():
            known = ~np.isnan(y)
            self.columns.append(chosen[c, -1])
            self.models.append(Linear(np.hstack([x[:, chosen[c, -1]], earlier])[known], y[known]))
            out = np.zeros(len(x))
            for k in range(FOLDS):
                here, others = folds == k, (folds != k) & known
                if here.any() and others.any():
                    inputs = np.hstack([x[:, chosen[c, k]], earlier])
                    out[here] = Linear(inputs[others], y[others]).predict(inputs[here])
            earlier = np.hstack([earlier, out[:, None]])

    def predict(self, x: np.ndarray) -> np.ndarray:
        earlier = np.zeros((len(x), 0))
        for m, at in zip(self.models, self.columns, strict=True):
            earlier = np.hstack([earlier, m.predict(np.hstack([x[:, at], earlier]))[:, None]])
        return earlier

    def named(self, names: list[str]) -> Chain:
        """Keeps the names of the columns that the final models use, and renumbers these."""
        used = np.unique(np.concatenate(self.columns).astype(int))
        self.names, self.columns = [names[i] for i in used], [np.searchsorted(used, at) for at in self.columns]
        return self


def fit(docs: DataFrame, marks: DataFrame, key: str = "doc_id", text: str = "text", per_class: int = SAMPLE_PER_CLASS) -> Chain | None:
    """A chain from a bounded sample of the documents that marks (key, one 0/1/null column a category, in order) label.

    Keys are drawn before texts are read; at most per_class documents of either value of the last category train.
    """
    categories = [c for c in marks.columns if c != key]
    last = categories[-1]
    drawn = draw_labelled(docs, marks, key, last, per_class)
    if drawn is None:
        return None
    rows = docs.filter(F.col(text).isNotNull()).select(key, text).join(F.broadcast(drawn), key)  # at most 2 x per_class labels
    rows = rows.select("draw", *categories, text)

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in text_chunks(batch, text):
                part = batch.slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array([sorted(document_features(t)) for t in texts], pa.list_(pa.string()))], names=[*part.schema.names[:-1], "found"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != text)
    found = rows.mapInArrow(featurize, f"{kinds}, found array<string>")
    # documents that share an id enter together; the sample's bound holds for them, too
    found = keep(found.withColumn("fold", F.pmod(F.xxhash64("draw"), F.lit(FOLDS)).cast("int")), "features")
    best = [found.filter(F.col(last) == c).orderBy("draw", F.xxhash64("found")).limit(per_class) for c in (0, 1)]
    stored = found if found.count() <= per_class else keep(best[0].unionByName(best[1]), "features")
    chosen = select_features(stored, categories)
    names = sorted(set().union(*chosen.values()))
    index = {f: i for i, f in enumerate(names)}

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.zeros((batch.num_rows, len(names)), bool)
            for i, fs in enumerate(batch.column(batch.schema.get_field_index("found"))):
                bits[i, [index[f] for f in fs.as_py() if f in index]] = True
            packed = pa.array([row.tobytes() for row in np.packbits(bits, axis=1)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], packed], names=[*batch.schema.names[:-1], "bits"])

    kinds = "draw long, fold int, " + ", ".join(f"`{c}` double" for c in categories)
    marked = stored.select("draw", "fold", *[F.col(c).cast("double").alias(c) for c in categories], "found").mapInArrow(mark, f"{kinds}, bits binary")
    sample = sorted(marked.collect(), key=lambda r: (r.draw, r.bits))
    if len({r[last] for r in sample}) < 2:
        return None
    x = np.unpackbits(np.array([np.frombuffer(r.bits, np.uint8) for r in sample]), axis=1, count=len(names)).astype(np.float32)
    labels = {c: np.array([np.nan if r[c] is None else r[c] for r in sample]) for c in categories}
    at = {ck: np.array([index[f] for f in fs], int) for ck, fs in chosen.items()}
    return Chain(x, labels, np.array([r.fold for r in sample]), at).named(names)


def score(docs: DataFrame, chain: Chain | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, p_<category>..., score, predicted) of each text; score is the last category's probability."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # at most FEATURES names and weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, begin, p in _scored(batches, shared.value, text):
            ids = batch.column(batch.schema.get_field_index(key)).slice(begin, len(p))
            p = p if shared.value else np.zeros((len(p), len(columns)))
            last = p[:, -1]
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c) for c in p.T), pa.array(last), pa.array((last >= 0.5).astype(np.int32))], names=[key, *columns, "score", "predicted"])

    categories = chain.categories if chain else list(CATEGORIES)
    columns = [f"p_{c}" for c in categories]
    return docs.select(key, text).mapInArrow(run, f"{key} long, {', '.join(f'{c} double' for c in columns)}, score double, predicted int")


def _scored(batches: Iterator[pa.RecordBatch], chain: Chain | None, text: str) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
    """(batch, first row, probabilities) of runs of rows."""
    index = {f: i for i, f in enumerate(chain.names)} if chain else {}
    seen: dict[str, tuple] = {}
    for batch in batches:
        for begin, texts in text_chunks(batch, text):
            if chain is None:
                yield batch, begin, np.zeros((len(texts), 1))
                continue
            x = np.zeros((len(texts), len(chain.names)))
            for i, t in enumerate(texts):
                words = set(_WORD.findall(t.lower()))
                for w in words:
                    hits = seen.get(w)
                    if hits is None:
                        if len(seen) > CACHE_WORDS:
                            seen.clear()
                        hits = seen[w] = tuple(index[f] for f in features_of(w) if f in index)
                    for h in hits:
                        x[i, h] = 1
            yield batch, begin, chain.predict(x)


def _marks(labels: DataFrame) -> DataFrame:
    """Training labels: those of the folds 0 and 2."""
    poor, toxic = F.col("quality") == 0, F.col("toxic") == 1
    return labels.filter(crc_mod("doc_id", 3) != 1).select("doc_id", *[m.cast("int").alias(c) for c, m in zip(CATEGORIES, (poor, poor & toxic, toxic), strict=True)])


def op1_toxicity_chain(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, fit(docs, _marks(table(spark, sf_dir, "labels"))))
    return out.withColumn("held_out", crc_mod("doc_id", 3) == 1)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pipeline stage: drops the documents whose toxicity probability is 0.5 or more, in one pass over them.

    Null and empty texts have the intercepts' probability; copies go or stay together; without labels of both
    classes, or documents, nothing goes. Other columns stay as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, _marks(labels)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, begin, p in _scored(batches, shared.value, "text"):
            yield batch.slice(begin, len(p)).filter(pa.array(p[:, -1] < 0.5))

    return docs.mapInArrow(run, docs.schema)
