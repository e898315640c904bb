"""Toxicity by multiple-instance learning.

Only documents are labelled, but what makes one toxic is a sentence. Each sentence gets a
logistic score from its words; a document is toxic if any of its sentences is, so its score is
the noisy-or of theirs: 1 - prod(1 - p). The loss is taken on documents and its gradient
reaches the sentences through the noisy-or, so the trained weights locate them.

Features of a word are the word itself and its prefixes of four to six characters.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.llm.common import arrow_rows, map_rows, materialize, table

#: Bounds of the training sample: documents of each label, and characters in all. Documents
#: enter in the order of a hash of their id; the others are scored but not learnt from.
SAMPLE_PER_LABEL = 6_000
SAMPLE_CHARS = 1 << 26
#: Features kept of the sample, and the least documents of a label that show one.
MAX_FEATURES = 50_000
LEAST_DOCS = 3
#: Log-odds to which the words of a sentence add. A sentence without any known word has no part
#: in the noisy-or, in training and scoring alike: a document is not toxic for its length.
SILENT = -12.0
#: Words whose weights a task keeps at most.
KEPT_WORDS = 500_000

PREFIXES = (4, 5, 6)
THRESHOLD = 0.5

_SENTENCE = re.compile(r"[^.!?\n]+")
_PARTS = re.compile(r"\w+|[.!?\n]+")
_WORDS = re.compile(r"\w+")

SCORED = (
    "doc_id bigint, score double, n_sentences bigint, "
    "offending array<struct<start:bigint,stop:bigint,score:double>>"
)


def features(word: str) -> list[int]:
    """Hashed features of a lower-case word."""
    out = [zlib.crc32(word.encode())]
    out += [zlib.crc32(f"^{word[:n]}".encode()) for n in PREFIXES if len(word) >= n]
    return out


@dataclass
class Model:
    """Weights by feature and the bias that every sentence has."""

    weights: dict[int, float]
    bias: float

    def word(self, word: str) -> float:
        get = self.weights.get
        return sum([get(f, 0.0) for f in features(word)])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40.0, 40.0)))


def fit(
    rows: np.ndarray, cols: np.ndarray, doc_of_row: np.ndarray, labels: np.ndarray, n_cols: int,
    rounds: int = 300, rate: float = 0.1, ridge: float = 1e-4, bias: float = SILENT,
) -> np.ndarray:
    """Weights that minimise the documents' log loss, by full-batch Adam.

    ``rows, cols``: a sentence and one of its features, ``doc_of_row``: the sentence's document.
    Every document weighs the same; the bias is given. A sentence without a feature is silent.
    """
    labels = labels.astype(float)
    n_rows, n_docs = len(doc_of_row), len(labels)
    heard = np.bincount(rows, minlength=n_rows) > 0
    theta = np.zeros(n_cols)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        z = np.bincount(rows, theta[cols], n_rows) + bias
        p = _sigmoid(z)
        log_clean = -np.bincount(doc_of_row, np.where(heard, np.logaddexp(0.0, z), 0.0), n_docs)
        toxic = np.maximum(-np.expm1(log_clean), 1e-12)
        pull = np.where(labels > 0, -np.exp(log_clean) / toxic, 1.0) / n_docs
        dz = p * pull[doc_of_row]
        grad = np.bincount(cols, dz[rows], n_cols) + ridge / n_docs * theta
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-12)
    return theta


def _sample(docs: DataFrame, labels: DataFrame, per_label: int, chars: int) -> tuple[DataFrame, dict[int, int]]:
    """Labelled documents to learn from (``label, text``, a stored table), and their number by label."""
    spark = docs.sparkSession
    one = labels.groupBy("doc_id").agg(F.max("label").alias("label"))
    # At most twice ``per_label`` ids: a proven bound for what is sent around.
    ids = [
        r
        for label in (0, 1)
        for r in one.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label).collect()
    ]
    chosen = spark.createDataFrame([(r.doc_id, int(r.label)) for r in ids], "doc_id bigint, label int")
    texts = materialize(docs.join(F.broadcast(chosen), "doc_id").filter(F.col("text").isNotNull()))
    sizes = texts.groupBy("doc_id", "label").agg(
        F.sum(F.length("text")).alias("n"), F.count(F.lit(1)).alias("rows"), F.xxhash64("doc_id").alias("h")
    )
    total, kept, by_label = 0, [], {0: 0, 1: 0}
    for r in sorted(sizes.collect(), key=lambda r: (r.h, r.doc_id)):
        total += r.n
        if total > chars and kept:
            break
        kept.append((r.doc_id,))
        by_label[r.label] += r.rows
    kept = spark.createDataFrame(kept, "doc_id bigint")
    return texts.join(F.broadcast(kept), "doc_id", "left_semi").select("label", "text"), by_label


def _vocabulary(sample: DataFrame, by_label: dict[int, int], most: int) -> np.ndarray:
    """Features that documents of one label show more often than those of the other, sorted.

    Counted by Spark; at most ``most`` of them, those of the clearest difference, come here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[int]] = {}
        for batch in batches:
            shown = []
            for text in batch.column(1):
                found: set[int] = set()
                for word in set(_WORDS.findall(text.as_py().lower())):
                    f = known.get(word)
                    if f is None:
                        f = known[word] = features(word)
                    found.update(f)
                shown.append(np.fromiter(found, np.int64, len(found)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(shown, pa.list_(pa.int64()))], names=["label", "features"]
            )

    each = arrow_rows(sample).mapInArrow(run, "label int, features array<bigint>")
    counts = each.select("label", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.sum(F.when(F.col("label") == 1, 1.0).otherwise(0.0)).alias("a"),
        F.sum(F.when(F.col("label") == 0, 1.0).otherwise(0.0)).alias("b"),
    )
    odds, error = F.lit(0.0), F.lit(0.0)
    for name, label, sign in (("a", 1, 1.0), ("b", 0, -1.0)):
        there, away = F.col(name) + 0.5, by_label[label] + 0.5 - F.col(name)
        odds = odds + sign * F.log(there / away)
        error = error + 1 / there + 1 / away
    signal = F.abs(odds) / F.sqrt(error)
    clear = counts.filter(F.greatest("a", "b") >= LEAST_DOCS).select("feature", signal.alias("signal"))
    rows = clear.filter("signal > 2").orderBy(F.desc("signal"), "feature").limit(most).collect()
    return np.array(sorted(r.feature for r in rows), dtype=np.int64)


def _bags(sample: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Per document: its label, places in the vocabulary of the features of its sentences one
    after another, and how many each sentence has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {f: i for i, f in enumerate(vocabulary.tolist())}
        known: dict[str, list[int]] = {}
        for batch in batches:
            flat, sizes = [], []
            for text in batch.column(1):
                found, counts = [], []
                for m in _SENTENCE.finditer(text.as_py().lower()):
                    n = len(found)
                    for word in sorted(set(_WORDS.findall(m[0]))):
                        f = known.get(word)
                        if f is None:
                            f = known[word] = [place[x] for x in features(word) if x in place]
                        found += f
                    counts.append(len(found) - n)
                flat.append(np.array(found, "<u4").tobytes())
                sizes.append(np.array(counts, "<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(flat, pa.binary()), pa.array(sizes, pa.binary())],
                names=["label", "features", "sizes"],
            )

    return arrow_rows(sample).mapInArrow(run, "label int, features binary, sizes binary")


def train(
    docs: DataFrame,
    labels: DataFrame,
    per_label: int = SAMPLE_PER_LABEL,
    chars: int = SAMPLE_CHARS,
    max_features: int = MAX_FEATURES,
) -> Model:
    """Model from ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0 or 1).

    Other labels and documents without a label or text are not learnt from. With no document
    of one of the labels the model knows no word and scores everything near 0. The driver holds
    the vocabulary and, of the sample, the places of known features.
    """
    labels = labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    sample, by_label = _sample(docs.select("doc_id", "text"), labels, per_label, chars)
    if not by_label[0] or not by_label[1]:
        return Model({}, SILENT)
    vocabulary = _vocabulary(sample, by_label, max_features)
    if not len(vocabulary):
        return Model({}, SILENT)
    # Rows arrive in the order of the sample's files, which may differ between runs.
    bags = sorted((r.label, bytes(r.features), bytes(r.sizes)) for r in _bags(sample, vocabulary).toLocalIterator())
    rows, cols, doc_of_row, first = [], [], [], 0
    for doc, (_, flat, sizes) in enumerate(bags):
        counts = np.frombuffer(sizes, "<u4")
        rows.append(np.repeat(np.arange(first, first + len(counts), dtype=np.int32), counts))
        cols.append(np.frombuffer(flat, "<u4").astype(np.int32))
        doc_of_row.append(np.full(len(counts), doc, dtype=np.int32))
        first += len(counts)
    y = np.array([label for label, _, _ in bags])
    weights = fit(np.concatenate(rows), np.concatenate(cols), np.concatenate(doc_of_row), y, len(vocabulary))
    return Model(dict(zip(vocabulary.tolist(), weights.tolist())), SILENT)


def sentence_scores(text: str, model: Model) -> list[tuple[int, int, float]]:
    """Start, stop and score of each sentence of ``text``; 0 for one without a known word."""
    out = []
    for m in _SENTENCE.finditer(text):
        # Sorted: a sum of floats depends on its order.
        known = [z for w in sorted(set(_WORDS.findall(m[0].lower()))) if (z := model.word(w))]
        z = max(-40.0, min(40.0, model.bias + sum(known)))
        out.append((m.start(), m.end(), 1.0 / (1.0 + math.exp(-z)) if known else 0.0))
    return out


def document_score(scores: list[float]) -> float:
    """Noisy-or of the sentences' scores; 0 without a sentence."""
    return -math.expm1(sum(math.log1p(-min(p, 1 - 1e-12)) for p in scores))


class _Scorer:
    """Scores of whole documents; the weights of words already met are kept."""

    def __init__(self, model: Model) -> None:
        self._model = model
        self._known: dict[str, float] = {}

    def score(self, text: str) -> tuple[float, int]:
        """The document's score, and its number of sentences."""
        model, known = self._model, self._known
        if len(known) > KEPT_WORDS:
            known.clear()
        words, scores = {}, []
        for part in _PARTS.findall(text.lower()):
            z = known.get(part)
            if z is None:
                z = known[part] = math.inf if part[0] in ".!?\n" else model.word(part)
            if z == math.inf:
                if words:
                    scores.append(sum([words[w] for w in sorted(words)]))
                    words = {}
            elif z:
                words[part] = z
        if words:
            scores.append(sum([words[w] for w in sorted(words)]))
        n = sum(1 for _ in _SENTENCE.finditer(text))
        clean = 0.0
        for z in scores:
            clean -= np.logaddexp(0.0, max(-40.0, min(40.0, z + model.bias)))
        return min(1.0, max(0.0, -math.expm1(clean))), n


def _scorer(model: Model) -> Callable[[], Callable]:
    located = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())]))

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        scorer = _Scorer(model)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores, counts, places = [], [], []
            for text in batch.column(1).to_pylist():
                score, n = scorer.score(text or "")
                scores.append(score)
                counts.append(n)
                found = sentence_scores(text, model) if score >= THRESHOLD else []
                most = max([p for _, _, p in found], default=0.0)
                places.append([{"start": a, "stop": b, "score": p} for a, b, p in found if p >= min(THRESHOLD, most)])
            return pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(scores, pa.float64()), pa.array(counts, pa.int64()),
                 pa.array(places, located)],
                names=["doc_id", "score", "n_sentences", "offending"],
            )

        return step

    return make


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, n_sentences, offending`` for each row of ``docs``.

    ``offending``: the sentences of a document of at least the threshold that score as much
    themselves, or the highest one. Null and empty texts have no sentence and score 0;
    repeated rows are scored each; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
    return map_rows(rows, _scorer(model), SCORED)


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score the threshold or more; row-local, all columns kept."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model)
        for batch in batches:
            texts = batch.column(place).to_pylist()
            yield batch.filter(pa.array([scorer.score(t or "")[0] < THRESHOLD for t in texts], pa.bool_()))

    return arrow_rows(docs).mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    """The fold that no label is learnt from: crc32 of the id as text, mod 5, is 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def training_labels(labels: DataFrame) -> DataFrame:
    return labels.filter(~held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").alias("label"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, training_labels(table(spark, sf_dir, "labels")))
    return score(docs, model).select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_sentences",
        F.size("offending").alias("n_offending"),
        F.array_join(
            F.transform("offending", lambda s: F.concat_ws(":", s["start"].cast("string"), s["stop"].cast("string"))), ","
        ).alias("offending"),
    )
