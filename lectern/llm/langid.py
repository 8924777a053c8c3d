"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
The probability of a word is the sum over all its segmentations into pieces,
computed by the forward algorithm; a text's likelihood is the product over its
words. Probabilities are fitted by expectation-maximisation over word counts.

Fit: about ``FIT_DOCS`` distinct texts of each language at most, drawn by a hash
of the text, as whole texts; words of over ``FIT_LETTERS`` letters are left out of
the fit (never out of prediction). Counting words and the expectation step run
in Spark; only pieces x languages numbers reach the driver.

Defined results: text that is null or has no letter is ``und`` with score 0;
so is everything if nothing could be learned. Equal likelihoods go to the
alphabetically first language. The score is the winner's posterior
probability under equal priors.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm import kit

FIT_DOCS, FIT_LETTERS, ROUNDS, SMOOTHING = 1000, 64, 4, 0.1
CACHE = 300_000
UNKNOWN = "und"
_WORD = regex.compile(r"\p{L}+")
_STEP = 1 << 20
_EDGE = "▁"


def words_of(text: str) -> Iterator[list[str]]:
    """Lower-case runs of letters, some at a time."""
    text = text.lower()
    at = 0
    while at < len(text):
        end = min(len(text), at + _STEP)
        while end < len(text) and _WORD.match(text, end - 1) and _WORD.match(text, end):
            end += 1
        yield _WORD.findall(text, at, end)
        at = end


class Pieces:
    """The vocabulary: numbers of pieces, 0 for a string that is none, 1 for any character that is none."""

    _shared: dict[str, Pieces] = {}

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = (model.id_to_piece(i) for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
        self.number = {p: i for i, p in enumerate(dict.fromkeys(names), 2)}
        self.size = len(self.number) + 2
        self.longest = max(map(len, self.number))

    @classmethod
    def shared(cls, path: str) -> Pieces:
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]

    def table(self, words: list[str], start: int, end: int) -> np.ndarray:
        """Piece number of word[start:end] for words of one length."""
        get = self.number.get
        none = int(end - start == 1)
        return np.fromiter((get(w[start:end], none) for w in words), np.int32, len(words))


def _by_length(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        out.setdefault(len(w), []).append(i)
    return out


def log_likelihoods(words: list[str], pieces: Pieces, probability: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language, summed over all segmentations."""
    marked = [_EDGE + w for w in words]
    out = np.empty((len(words), probability.shape[1]))
    for length, at in _by_length(marked).items():
        group = [marked[i] for i in at]
        forward = {0: np.ones((len(group), probability.shape[1]))}
        logs = np.zeros((len(group), 1))
        for end in range(1, length + 1):
            total = np.zeros((len(group), probability.shape[1]))
            for start in range(max(0, end - pieces.longest), end):
                total += forward[start] * probability[pieces.table(group, start, end)]
            forward[end] = total
            forward.pop(end - pieces.longest, None)
            if end % 16 == 0:  # keeps long words from underflowing
                top = total.max(axis=1, keepdims=True)
                forward = {k: v / top for k, v in forward.items()}
                logs += np.log(top)
        out[at] = np.log(np.maximum(forward[length], 1e-300)) + logs
    return out


def expected_counts(words: list[str], langs: np.ndarray, weights: np.ndarray, pieces: Pieces, probability: np.ndarray) -> np.ndarray:
    """Expected number of times each piece is used in each language (forward-backward)."""
    counts = np.zeros(probability.shape)
    marked = [_EDGE + w for w in words]
    for length, rows in _by_length(marked).items():
        at = np.array(rows)
        group, lang = [marked[i] for i in rows], langs[at]
        ids = {(a, b): pieces.table(group, a, b) for b in range(1, length + 1) for a in range(max(0, b - pieces.longest), b)}
        p = {k: probability[v, lang] for k, v in ids.items()}
        forward, backward = np.zeros((length + 1, len(group))), np.zeros((length + 1, len(group)))
        forward[0], backward[length] = 1, 1
        for (a, b), q in p.items():  # by end
            forward[b] += forward[a] * q
        for a, b in sorted(p, reverse=True):  # by start, from the last
            backward[a] += backward[b] * p[a, b]
        scale = weights[at] / np.maximum(forward[length], 1e-300)
        for k, q in p.items():
            np.add.at(counts, (ids[k], lang), forward[k[0]] * q * backward[k[1]] * scale)
    return counts


def _count_words(number: dict[str, int]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            keys = list(held)
            out = pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.string()), pa.array([held[k] for k in keys], pa.int64())], ["lang", "word", "n"])
            held.clear()
            return out

        for batch in batches:
            langs = batch.column(1).to_pylist()
            for text, lang in zip(batch.column(0).to_pylist(), langs, strict=True):
                for words in words_of(text):
                    held.update((number[lang], w) for w in words if len(w) <= FIT_LETTERS)
                if len(held) > 200_000:
                    yield flush()
        yield flush()

    return work


def _expect(path: str, model):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, probability = Pieces.shared(path), model.value
        total = np.zeros(probability.shape)
        for batch in batches:
            for lo in range(0, batch.num_rows, 20_000):
                b = batch.slice(lo, 20_000)
                total += expected_counts(b.column(1).to_pylist(), b.column(0).to_numpy(), b.column(2).to_numpy().astype(float), pieces, probability)
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(piece.astype(np.int32)), pa.array(lang.astype(np.int32)), pa.array(total[piece, lang])], ["piece", "lang", "n"])

    return work


def fit(labelled: DataFrame, vocabulary: str, *, text: str = "text", lang: str = "lang", fit_docs: int = FIT_DOCS, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """Languages in alphabetical order, and the probability of each piece in each."""
    spark = labelled.sparkSession
    known = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    pieces = Pieces.shared(vocabulary)
    if not langs:
        return [], np.zeros((pieces.size, 0))
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, fit_docs / sizes[k])))])
    drawn = known.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)).dropDuplicates(["lang", "text"])
    counted = drawn.mapInArrow(_count_words({k: i for i, k in enumerate(langs)}), "lang int, word string, n long")
    counted = kit.written(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "word-counts")
    probability = np.full((pieces.size, len(langs)), 1.0 / pieces.size)
    probability[0] = 0
    for _ in range(rounds):
        model = spark.sparkContext.broadcast(probability)
        rows = counted.mapInArrow(_expect(vocabulary, model), "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toArrow()
        counts = np.full(probability.shape, SMOOTHING)
        counts[rows.column("piece").to_numpy(), rows.column("lang").to_numpy()] += rows.column("n").to_numpy()
        counts[0] = 0
        probability = counts / counts.sum(axis=0)
    return langs, probability


class Scorer:
    """Sums of word log likelihoods, with the words met so far kept."""

    _shared: dict[str, Scorer] = {}

    def __init__(self, pieces: Pieces, probability: np.ndarray):
        self.pieces, self.probability = pieces, probability
        self.place: dict[str, int] = {}
        self.logs = np.empty((1 << 14, probability.shape[1]))

    @classmethod
    def shared(cls, key: str, path: str, probability: np.ndarray) -> Scorer:
        if key not in cls._shared:
            cls._shared = {key: cls(Pieces.shared(path), probability)}
        return cls._shared[key]

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.place]
        if not new:
            return
        if len(self.place) + len(new) > CACHE:
            self.place.clear()
            new = list(words)
        first = len(self.place)
        if first + len(new) > len(self.logs):
            self.logs = np.concatenate([self.logs[:first], np.empty((max(len(new), len(self.logs)), self.logs.shape[1]))])
        self.logs[first : first + len(new)] = log_likelihoods(new, self.pieces, self.probability)
        self.place.update(zip(new, range(first, first + len(new)), strict=True))

    def total(self, words: list[str]) -> np.ndarray:
        return self.logs[np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))].sum(axis=0)


def _predict(langs: list[str], path: str, model, key: str, text: str, keep: list[str], names: tuple[str, str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer.shared(key, path, model.value)
        for batch in batches:
            for part, texts in kit.cut(batch, text, 1 << 20):
                lists = [list(words_of((t or b"").decode())) for t in texts]
                if langs:
                    scorer.learn({w for doc in lists for words in doc if len(doc) == 1 for w in words})
                out = []
                for doc in lists:
                    if not langs or not any(doc):
                        out.append((UNKNOWN, 0.0))
                        continue
                    total = np.zeros(len(langs))
                    for words in doc:
                        if len(doc) > 1:
                            scorer.learn(set(words))
                        total += scorer.total(words)
                    best = int(total.argmax())
                    out.append((langs[best], float(1 / np.exp(np.maximum(total - total[best], -700)).sum())))
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in keep), pa.array([x for x, _ in out]), pa.array([x for _, x in out])], [*keep, *names])

    return work


def predicted(docs: DataFrame, langs: list[str], probability: np.ndarray, vocabulary: str, *, text: str = "text") -> tuple[DataFrame, tuple[str, str]]:
    """docs with the predicted language and its posterior probability; returns those columns' names too."""
    names = (kit.free_name(docs, "lang_pred"), kit.free_name(docs, "lang_score"))
    model = docs.sparkSession.sparkContext.broadcast(probability)
    key = f"{vocabulary}:{langs}:{hash(probability.tobytes())}"
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return docs.mapInArrow(_predict(langs, vocabulary, model, key, text, docs.columns, names), schema), names


def held_out(doc_id: str):
    """Whether a document is kept out of learning: crc32 of its id as text divides by 5. A null id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def report(docs: DataFrame, vocabulary: str, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; learns from the rows that are not held out."""
    langs, probability = fit(docs.where(~held_out(doc_id)), vocabulary, text=text, lang=lang, **options)
    out, (name, score) = predicted(docs.select(doc_id, text), langs, probability, vocabulary, text=text)
    return out.select(F.col(doc_id), held_out(doc_id).alias("held_out"), F.col(name).alias("lang_pred"), F.col(score).alias("score"))
