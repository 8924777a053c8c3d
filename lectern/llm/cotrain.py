"""Quality and toxicity classifiers by co-training.

Two views of a document are judged apart: its text (hashed distinct words and
binned figures of form) and its metadata (language, source, size). Each view
has a log-odds classifier over features whose association with the label is
significant. In each round a view's confident verdicts on unlabelled documents
become labels for the other. Both views are then calibrated on held-out
labelled documents, and a document's odds are the prior's times both views'
calibrated evidence.

Fitting reads all labelled and all unlabelled documents. What reaches the
driver is one count per feature and class (at most ``FEATURES`` of each view)
and one histogram of scores: the same size for any corpus.

Defined results: a null text has no words; labels of a document that
contradict each other are dropped; with labels of one class only, every
document gets that class's share as its probability; rows with equal ids share
their label and are scored separately.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm import kit

FEATURES = 1 << 18
FORM = 64
ROUNDS, CONFIDENT, SIGNIFICANT = 2, 4.0, 3.0
#: A fifth of the labelled documents is held out for calibration.
HELD_OUT = 5
EDGES = np.linspace(-30, 30, 241)
TARGETS = ("quality", "toxic")
_SYMBOLS = b"#*$%&|<>!"


def _form(text: bytes, n_words: int, n_distinct: int) -> list[int]:
    """Binned figures of a text's form, as features 0 .. FORM - 1."""
    size = max(1, len(text))
    upper = size - len(text.translate(None, bytes(range(0x41, 0x5B))))
    symbols = size - len(text.translate(None, _SYMBOLS))
    lines = text.count(b"\n") + 1
    figures = (8 * n_distinct / max(1, n_words), 40 * upper / size, 40 * symbols / size, 0.7 * size / max(1, n_words), np.log2(1 + n_words) / 2, np.log2(1 + lines), np.log2(1 + n_words / lines), 0)
    return [8 * i + int(min(7, f)) for i, f in enumerate(figures[:-1])]


def text_features(texts: list[bytes | None]) -> list[np.ndarray]:
    """Distinct features of each text: form bins, then hashed words."""
    words, counts = kit.word_hashes(texts, kit.WORDLIKE, lower=True)
    bucket = (words >> np.uint64(46)).astype(np.int64)
    out, at = [], 0
    for t, n in zip(texts, counts.tolist(), strict=True):
        own = np.unique(bucket[at : at + n])
        out.append(np.concatenate([np.array(_form(t or b"", n, len(own)), np.int64), own % (FEATURES - FORM) + FORM]).astype(np.int32))
        at += n
    return out


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in kit.cut(batch, "text"):
            yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array([f.tobytes() for f in text_features(texts)], pa.binary()), part.column("meta")], ["doc", "content", "meta"])


@dataclass
class View:
    """Weights of one view's features and the score of a document that has none."""

    weights: np.ndarray
    prior: float

    @classmethod
    def fitted(cls, yes: np.ndarray, no: np.ndarray, n_yes: float, n_no: float) -> View:
        """Log odds ratios of the features, 0 where not significant."""
        a, b = yes + 0.5, no + 0.5
        c, d = np.maximum(n_yes - yes, 0) + 0.5, np.maximum(n_no - no, 0) + 0.5
        ratio = np.log(a) - np.log(c) - np.log(b) + np.log(d)
        sure = np.abs(ratio) >= SIGNIFICANT * np.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
        return cls(np.where(sure, ratio, 0).astype(np.float32), float(np.log((n_yes + 1) / (n_no + 1))))


def _scores(rows: list[bytes], view: View) -> np.ndarray:
    lengths = np.array([len(r) // 4 for r in rows])
    joined = np.frombuffer(b"".join(rows), np.int32)
    sums = np.concatenate([[0.0], np.cumsum(view.weights[joined].astype(np.float64))])
    ends = np.cumsum(lengths)
    return view.prior + sums[ends] - sums[ends - lengths]


def _decode(batch: pa.RecordBatch) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    names = batch.schema.names
    views = [batch.column(names.index(v)).to_pylist() for v in ("content", "meta")]
    labels = np.stack([batch.column(names.index(t)).fill_null(-1).to_numpy(zero_copy_only=False).astype(int) for t in TARGETS])
    return views, labels, batch.column(names.index("held")).to_numpy(zero_copy_only=False).astype(bool)


def _count(models):
    """Per view, target and class: documents with each feature, and documents, from labels and the other view's verdicts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        views_now = models.value
        total = np.zeros((2, len(TARGETS), 2, FEATURES + 1), np.int64)
        for batch in batches:
            views, labels, held = _decode(batch)
            for t in range(len(TARGETS)):
                for v in range(2):
                    label = np.where(held, -1, labels[t])
                    if views_now is not None:
                        other = _scores(views[1 - v], views_now[t][1 - v])
                        sure = (labels[t] < 0) & (np.abs(other) >= CONFIDENT)
                        label = np.where(sure, (other > 0).astype(int), label)
                    for c in (0, 1):
                        at = np.flatnonzero(label == c)
                        if len(at):
                            joined = np.frombuffer(b"".join(views[v][i] for i in at), np.int32)
                            total[v, t, c, :-1] += np.bincount(joined, minlength=FEATURES)
                            total[v, t, c, -1] += len(at)
        at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.ravel_multi_index(at, total.shape)), pa.array(total[at])], ["cell", "n"])

    return work


def _histogram(models):
    """Held-out labelled documents by view, target, label and bin of the view's score."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, len(TARGETS), 2, len(EDGES) + 1), np.int64)
        for batch in batches:
            views, labels, held = _decode(batch)
            for t in range(len(TARGETS)):
                for v in range(2):
                    at = np.digitize(_scores(views[v], models.value[t][v]), EDGES)
                    for c in (0, 1):
                        total[v, t, c] += np.bincount(at[held & (labels[t] == c)], minlength=len(EDGES) + 1)
        at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.ravel_multi_index(at, total.shape)), pa.array(total[at])], ["cell", "n"])

    return work


def _gathered(rows: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    out = np.zeros(shape)
    table = rows.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out.ravel()[table.column("cell").to_numpy()] = table.column("n").to_numpy()
    return out


def calibrated(no: np.ndarray, yes: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the log odds as a function of the score, by Newton steps on binned counts with a weak prior."""
    x = np.concatenate([[EDGES[0]], (EDGES[1:] + EDGES[:-1]) / 2, [EDGES[-1]]])
    w = np.array([0.0, np.log((yes.sum() + 1) / (no.sum() + 1))])
    n = no + yes
    pull = np.array([1e-2, 1e-2])

    def loss(w: np.ndarray) -> float:
        z = w[0] * x + w[1]
        return float((n * np.logaddexp(0, z) - yes * z).sum() + (pull * w * w).sum() / 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(w[0] * x + w[1], -50, 50)))
        slope = np.array([(x * (yes - n * p)).sum(), (yes - n * p).sum()]) - pull * w
        h = n * p * (1 - p)
        curve = np.array([[(h * x * x).sum(), (h * x).sum()], [(h * x).sum(), h.sum()]]) + np.diag(pull)
        step = np.linalg.solve(curve, slope)
        while np.abs(step).max() > 1e-9 and loss(w + step) > loss(w):
            step = step / 2
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 0.0)), float(w[1])


def _judge(models, lines, priors):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            views, _, _ = _decode(batch)
            own = []
            for t in range(len(TARGETS)):
                odds = []
                for v in range(2):
                    slope, offset = lines[t][v]
                    odds.append(slope * np.clip(_scores(views[v], models.value[t][v]), EDGES[0], EDGES[-1]) + offset)
                odds.append(odds[0] + odds[1] - priors[t])
                own += [1 / (1 + np.exp(-np.clip(o, -50, 50))) for o in odds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(o) for o in own)], ["doc", *(f"{t}{s}" for t in TARGETS for s in ("_text", "_meta", ""))])

    return work


def scored(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", metadata: tuple[str, ...] = ("lang", "source"), rounds: int = ROUNDS) -> DataFrame:
    """doc_id, probability of quality and of toxicity by each view and combined, and kept (good and not toxic)."""
    spark = docs.sparkSession
    size = F.floor(F.log2(F.coalesce(F.octet_length(text), F.lit(0)) + 1)).cast("string")
    values = [F.concat_ws("=", F.lit(c), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in metadata] + [F.concat(F.lit("size="), size)]
    meta = F.transform(F.array(*values), lambda v: F.pmod(F.xxhash64(v), F.lit(FEATURES)).cast("int"))
    # Four little-endian bytes per feature, as the text view has them.
    packed = F.unhex(F.array_join(F.transform(meta, lambda m: F.hex(F.reverse(F.unhex(F.lpad(F.hex(m.cast("long")), 8, "0"))))), ""))
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"), packed.alias("meta"))
    schema = T.StructType([T.StructField("doc", docs.schema[doc_id].dataType), T.StructField("content", T.BinaryType()), T.StructField("meta", T.BinaryType())])
    agreed = labels.groupBy(F.col(doc_id).alias("labelled")).agg(*(F.when(F.min(t) == F.max(t), F.max(t)).alias(t) for t in TARGETS))
    table = rows.mapInArrow(_featurise, schema).join(agreed.hint("shuffle_hash"), F.col("doc") == F.col("labelled"), "left").drop("labelled")
    table = kit.written(table.withColumn("held", F.pmod(F.xxhash64("doc"), F.lit(HELD_OUT)) == 0), "features")

    models, fitted = spark.sparkContext.broadcast(None), []
    for _ in range(rounds + 1):
        counts = _gathered(table.mapInArrow(_count(models), "cell long, n long"), (2, len(TARGETS), 2, FEATURES + 1))
        fitted = [[View.fitted(c[1, :-1], c[0, :-1], c[1, -1], c[0, -1]) for c in counts[:, t]] for t in range(len(TARGETS))]
        models = spark.sparkContext.broadcast(fitted)
    seen = _gathered(table.where("held").mapInArrow(_histogram(models), "cell long, n long"), (2, len(TARGETS), 2, len(EDGES) + 1))
    lines = [[calibrated(seen[v, t, 0], seen[v, t, 1]) for v in range(2)] for t in range(len(TARGETS))]
    priors = [float(np.log((seen[0, t, 1].sum() + 1) / (seen[0, t, 0].sum() + 1))) for t in range(len(TARGETS))]
    names = [f"{t}{s}" for t in TARGETS for s in ("_text", "_meta", "")]
    out = table.mapInArrow(_judge(models, lines, priors), T.StructType([T.StructField("doc", docs.schema[doc_id].dataType), *(T.StructField(n, T.DoubleType()) for n in names)]))
    return out.select(F.col("doc").alias(doc_id), *names, ((F.col("quality") >= 0.5) & (F.col("toxic") < 0.5)).alias("kept"))
