"""Language identification: averaged hashed subword embeddings, linear softmax.

A text's features are its subwords: all letter n-grams of words with a space
on either side, hashed into buckets.  Each bucket has an embedding; a text is
the average of its subwords' embeddings, and a linear layer with softmax reads
the language off it.  Both are trained by stochastic gradient descent in numpy,
in one Spark task, on a bounded sample of labelled documents (``PER_LANGUAGE``
per label, chosen by hash, of each at most ``PER_TEXT`` subwords spread evenly
over the whole text), from all of these and random subsets of them, so short
texts are learnt as well.  Because average and linear layer commute, prediction needs one table
of bucket scores.

Confidence is calibrated on labelled documents kept out of training: logits are
scaled by ``sharpness * sqrt(n / (n + pivot))`` for n subwords, fitted by
log-loss, and a text whose calibrated confidence is below ``MIN_CONFIDENCE`` is
rejected, as is one without letters.

Defined cases: a null text, or one without a letter, is ``und`` with score 0
and rejected; so is every text if no label was there to learn from; equal
scores go to the label first in order; rows that repeat id, label and text are
learnt from once; columns not named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm import common, pretoken
from ledgerflow.llm.pieces import utf8

UNKNOWN = "und"
BUCKETS = 1 << 16
DIMENSIONS = 16
ORDERS = (2, 3, 4)
#: Labelled documents of each language that training and calibration see.
PER_LANGUAGE = 400
#: Subwords of each of them; a longer text gives every k-th, so a sample's size is bounded.
PER_TEXT = 1 << 16
EPOCHS = 6
RATE = 0.5
MIN_CONFIDENCE = 0.5
#: Subwords in the random subsets that training adds, and calibration sizes.
SUBSETS = (8, 24, 80)


def subwords_by_order(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every order: the bucket of each subword, text by text, and the bounds."""
    raw, at = utf8(column)
    points = pretoken.code_points(raw.tobytes().decode())
    starts = raw & 0xC0
    sizes = np.add.reduceat(np.append(starts != 0x80, False), at[:-1], dtype=np.int64) if len(at) > 1 else np.zeros(0, np.int64)
    sizes[np.diff(at) == 0] = 0
    breaks = np.concatenate([[0], np.cumsum(sizes)])
    letter = pretoken.classes()[points] == pretoken.LETTER
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    inner = breaks[:-1][breaks[:-1] < len(points)]
    begins[inner] |= letter[inner]
    kept = np.flatnonzero(letter)
    # the stream holds every word with a space before it, and a space at its end; 0 is the space
    words = np.cumsum(begins, dtype=np.int32)
    place = np.arange(1, len(kept) + 1) + words[kept] - 1
    stream = np.zeros(len(kept) + (int(words[-1]) if len(words) else 0) + 1, np.uint32)
    lower = points[kept]
    stream[place] = lower + ((lower >= 65) & (lower <= 90)) * np.uint32(32)
    # a text's part of the stream begins with the space before its first word
    before = np.searchsorted(kept, breaks)  # letters before each text
    words_before = np.concatenate([[0], words])[breaks]
    edges = before + words_before
    gap = stream == 0
    out = []
    for order in ORDERS:
        size = max(len(stream) - order + 1, 0)
        value, inside = np.full(size, order, np.uint32), np.ones(size, bool)
        for k in range(order):
            value = (value ^ stream[k:k + size]) * np.uint32(0x01000193)
            value ^= value >> np.uint32(15)
            if 0 < k < order - 1:
                inside &= ~gap[k:k + size]
        take = np.flatnonzero(inside)
        out.append(((value[take] * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.int32) & np.int32(BUCKETS - 1), np.searchsorted(take, edges)))
    return out


def subwords(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all orders, text by text, and the bounds."""
    orders = subwords_by_order(column)
    owner = np.concatenate([np.repeat(np.arange(len(column)), np.diff(bounds)) for _, bounds in orders])
    buckets = np.concatenate([b[bounds[0]:bounds[-1]] for b, bounds in orders])
    turn = np.argsort(owner, kind="stable")
    return buckets[turn], np.searchsorted(owner[turn], np.arange(len(column) + 1))


@dataclass(frozen=True)
class Model:
    """``scores[b]``: what a subword of bucket b adds to each label's logit."""

    labels: tuple[str, ...]
    scores: np.ndarray
    bias: np.ndarray
    sharpness: float = 1.0
    pivot: float = 0.0

    def logits(self, orders: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Logits of texts given their subwords (in any number of lists, each
        with bounds per text), and the number of subwords."""
        counts = sum(np.diff(bounds) for _, bounds in orders)
        sums = np.zeros((len(counts), len(self.labels)))
        for k, column in enumerate(np.ascontiguousarray(self.scores.T)):
            for buckets, bounds in orders:
                full = np.flatnonzero(np.diff(bounds))
                if len(full):
                    sums[full, k] += np.add.reduceat(column[buckets[:bounds[-1]]], bounds[:-1][full])
        return sums / np.maximum(counts, 1)[:, None] + self.bias, counts

    def confidences(self, logits: np.ndarray, counts: np.ndarray) -> np.ndarray:
        scaled = logits * (self.sharpness * np.sqrt(counts / (counts + self.pivot + 1e-9)))[:, None]
        scaled = np.exp(scaled - scaled.max(axis=1, keepdims=True))
        return scaled / scaled.sum(axis=1, keepdims=True)

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        if not self.labels or not len(column):
            return [UNKNOWN] * len(column), np.zeros(len(column))
        logits, counts = self.logits(subwords_by_order(column))
        sure = self.confidences(logits, counts)
        best = logits.argmax(axis=1)
        names = [self.labels[k] if n else UNKNOWN for k, n in zip(best, counts)]
        return names, np.where(counts > 0, sure[np.arange(len(best)), best], 0.0)


def train(texts: list[np.ndarray], labels: list[str], seed: int = 17) -> Model:
    """Fit a model to the subwords of labelled texts; every fifth text of the
    shuffled sample is kept for calibration."""
    names = tuple(sorted(set(labels)))
    if not names:
        return Model((), np.zeros((BUCKETS, 0)), np.zeros(0))
    rng = np.random.default_rng(seed)
    target = np.array([names.index(x) for x in labels])
    order = rng.permutation(len(texts))
    learn, check = order[len(order) // 5:], order[:len(order) // 5]
    embed = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    linear, bias = np.zeros((DIMENSIONS, len(names))), np.zeros(len(names))
    linear += rng.normal(0, 0.1, linear.shape)
    steps = EPOCHS * len(learn) * 2
    done = 0
    for _ in range(EPOCHS):
        for k in rng.permutation(learn):
            whole = texts[k]
            for part in (whole, rng.choice(whole, min(len(whole), int(rng.choice(SUBSETS))))) if len(whole) else ():
                rate, done = RATE * (1 - done / (steps + 1)), done + 1
                bucket, times = np.unique(part, return_counts=True)
                share = (times / len(part))[:, None]
                rows = embed[bucket]
                mean = (rows * share).sum(axis=0)
                logit = mean @ linear + bias
                error = np.exp(logit - logit.max())
                error /= error.sum()
                error[target[k]] -= 1
                pull = linear @ error
                linear -= rate * np.outer(mean, error)
                bias -= rate * 0.1 * error
                # a subword's step follows its share, scaled so that rare ones move as well
                embed[bucket] -= rate * np.minimum(share * 20, 1.0) * pull
    model = Model(names, embed @ linear, bias)
    return calibrate(model, [texts[k] for k in check], target[check], rng)


def calibrate(model: Model, texts: list[np.ndarray], target: np.ndarray, rng: np.random.Generator) -> Model:
    """Sharpness and pivot of least log-loss over whole texts and subsets."""
    parts = [(t, y) for t, y in zip(texts, target) if len(t)]
    parts += [(rng.choice(t, min(len(t), n)), y) for t, y in parts for n in SUBSETS]
    if not parts:
        return model
    bounds = np.concatenate([[0], np.cumsum([len(t) for t, _ in parts])])
    logits, counts = model.logits([(np.concatenate([t for t, _ in parts]), bounds)])
    want, best = np.array([y for _, y in parts]), (np.inf, 1.0, 0.0)
    for sharpness in np.geomspace(0.25, 8, 16):
        for pivot in (0.0, 4.0, 16.0, 64.0, 256.0):
            tried = Model(model.labels, model.scores, model.bias, float(sharpness), pivot)
            sure = tried.confidences(logits, counts)[np.arange(len(want)), want]
            loss = -np.log(np.maximum(sure, 1e-12)).mean()
            if loss < best[0]:
                best = (loss, float(sharpness), pivot)
    return Model(model.labels, model.scores, model.bias, best[1], best[2])


def fold(id_col: str):
    """crc32 of the id as text, modulo 5; documents of fold 0 are held out."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(5))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", per_language: int = PER_LANGUAGE, per_text: int = PER_TEXT) -> Model:
    """Train on the labelled documents outside fold 0: of each label the
    ``per_language`` first by hash of id and text.  Tasks turn whole texts into
    subword buckets, one task trains on the sample, and the driver gets the
    model's table only."""
    known = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull() & (fold(id_col) != 0))
    known = known.select(F.col(id_col).cast("string").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(text_col).cast("binary").alias("raw"))
    known = known.withColumn("digest", F.xxhash64("raw"))
    place = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id", "digest")
    # copies count once: they must not use the bound up
    chosen = known.select("id", "label", "digest").distinct().withColumn("n", F.row_number().over(place)).where(F.col("n") <= per_language)
    chosen = chosen.select(F.col("id").alias("i"), F.col("label").alias("l"), F.col("digest").alias("d"))
    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("label") == F.col("l")) & (F.col("digest") == F.col("d"))
    rows = known.join(F.broadcast(chosen), same, "left_semi").groupBy("id", "label", "digest").agg(F.first("raw").alias("raw"))  # per_language rows a label

    def buckets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.slices(batches, "raw"):
            buckets, bounds = subwords(piece.column("raw"))
            parts = [buckets[a:b][::max(1, -(-(b - a) // per_text))].astype("<u2").tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([piece.column("id"), piece.column("label"), pa.array(parts, pa.binary())], ["id", "label", "buckets"])

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("id", "label", "buckets")))]
        found.sort(key=lambda r: (r[0] or "", r[1], r[2]))
        model = train([np.frombuffer(r[2], "<u2") for r in found], [r[1] for r in found])
        table = np.concatenate([model.scores.ravel(), model.bias, [model.sharpness, model.pivot]])
        yield pa.RecordBatch.from_arrays([pa.array([list(model.labels)], pa.list_(pa.string())), pa.array([table.astype("<f8").tobytes()], pa.binary())], ["labels", "numbers"])

    sample = rows.mapInArrow(common.lean(buckets_of), "id string, label string, buckets binary")
    found = sample.repartition(1).mapInArrow(common.lean(trained), "labels array<string>, numbers binary").first()
    if found is None:
        return train([], [])
    labels, numbers = tuple(found["labels"]), np.frombuffer(found["numbers"], "<f8")
    size = BUCKETS * len(labels)
    return Model(labels, numbers[:size].reshape(BUCKETS, len(labels)), numbers[size:-2], float(numbers[-2]), float(numbers[-1]))


def predict(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "language") -> DataFrame:
    """``docs`` with ``out_col``: struct of ``lang`` and calibrated ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang:string,score:double>")
    def language(raw: pa.Array) -> pa.Array:
        names, scores = [], []
        batch = pa.RecordBatch.from_arrays([raw], ["raw"])
        for piece in common.slices(iter([batch]), "raw"):
            lang, score = shared.value.predict(piece.column("raw"))
            names += lang
            scores.append(score)
        common.give_back()
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else np.zeros(0))], ["lang", "score"])

    return docs.withColumn(out_col, language(F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))))


def rejected(out_col: str = "language", least: float = MIN_CONFIDENCE):
    """Whether the calibrated model declines to name a language."""
    return (F.col(f"{out_col}.lang") == UNKNOWN) | (F.col(f"{out_col}.score") < least)
