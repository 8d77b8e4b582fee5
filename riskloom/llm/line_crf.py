"""Quality classifier: a linear-chain conditional random field over lines (operator 3).

Every line with a word is labelled good or bad. A line's features are its own
and those of its neighbours (the line before and after); a transition weight
ties neighbouring labels. Forward-backward gives each line's marginal of
"good"; their mean, weighted by line length, is brought to a probability by a
logistic curve fitted on the same sample: the document's quality.

Training. Lines carry their document's label. The field is fitted by gradient
ascent on its penalised likelihood over at most ``SAMPLE`` labelled documents
(the least by a hash of the id); features are computed by Spark, and only the
sample's feature rows reach the driver. Scoring is one pass over the texts,
many documents at a time, without a shuffle.

Only the text is an input of a score. Defined cases: null, empty and word-free
texts get the share of label 1 in the sample; without labelled rows all scores
are 0.5, with labels of one class all are that class's smoothed share; null
labels are not learnt from; repeated rows are scored alike; very long texts are
whole; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_code
from .rolling import gram_hashes, lowered, mix, text_bytes, word_bounds, word_hashes
from .substring_dedup import slices

SAMPLE = 4000
THRESHOLD = 0.3
FOLDS = 5
STEPS, RATE, PENALTY = 250, 0.1, 1e-3

#: byte classes that are counted per line
CLASSES = [b"#*$%&<>", b"|", b"!?", b".,;:", b"0123456789", bytes(range(65, 91)), b"\"'()[]{}/\\=+_@^~`"]
N_OWN = len(CLASSES) + 6

_LUTS = np.zeros((len(CLASSES), 256), np.uint8)
for _i, _c in enumerate(CLASSES):
    _LUTS[_i, list(_c)] = 1


def line_features(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own features of every line with a word, its length in bytes, and the number of such lines before each text."""
    data, rows = text_bytes(column)
    starts, ends, _ = word_bounds(data, rows)
    if not len(starts):
        return np.zeros((0, N_OWN)), np.zeros(0), np.zeros(len(rows), np.int64)
    breaks = np.unique(np.concatenate([rows[:-1], np.flatnonzero(data == 10) + 1]))
    breaks = breaks[breaks < len(data)]
    of_word = np.searchsorted(breaks, starts, side="right") - 1
    words = np.bincount(of_word, minlength=len(breaks))
    full = words > 0
    size = np.diff(np.concatenate([breaks, [len(data)]]))
    solid = np.bincount(of_word, weights=ends - starts, minlength=len(breaks))
    hashes = word_hashes(lowered(data), starts, ends)
    row = np.searchsorted(rows, starts, side="right") - 1
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    grams = np.zeros(len(hashes), np.uint64)
    if len(hashes) >= 3:
        grams[:-2] = mix(gram_hashes(hashes, 3)) ^ mix(row[:-2].astype(np.uint64))
    order = np.argsort(grams)
    twin = np.zeros(len(grams), bool)
    same = grams[order][1:] == grams[order][:-1]
    twin[order[1:][same]] = True
    inside = np.zeros(len(grams), bool)
    inside[:-2] = row[2:] == row[:-2]
    twin &= inside
    short = (ends - starts) <= 3

    def per_word(flags):
        return np.bincount(of_word, weights=flags, minlength=len(breaks)) / np.maximum(words, 1)

    out = np.empty((int(full.sum()), N_OWN))
    solid_ = np.maximum(solid[full], 1)
    for i, lut in enumerate(_LUTS):
        out[:, i] = np.sqrt(np.add.reduceat(lut[data], breaks, dtype=np.int64)[full] / solid_)
    n = len(CLASSES)
    out[:, n] = per_word(again)[full]
    out[:, n + 1] = per_word(twin)[full]
    out[:, n + 2] = per_word(short)[full]
    out[:, n + 3] = np.log1p(words[full])
    out[:, n + 4] = solid_ / words[full] / 10
    out[:, n + 5] = 1 / np.sqrt(words[full])
    kept = np.concatenate([[0], np.cumsum(full)])
    return out, solid[full], kept[np.searchsorted(breaks, rows)]


def with_neighbours(own: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A bias, each line's features and those of the lines before and after it in its text (zeros at the ends)."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first[:-1][first[:-1] < len(own)]] = 0
    ends = first[1:] - 1
    after[ends[ends >= 0]] = 0
    return np.hstack([np.ones((len(own), 1)), own, before, after])


def marginals(scores: np.ndarray, lengths: np.ndarray, trans: np.ndarray):
    """Forward-backward over padded chains: P(good) per line, expected transitions, log partition.

    ``scores`` (texts, lines) favour good over bad; ``trans`` is 2 x 2 (from, to).
    """
    d, t = scores.shape
    e = np.stack([np.zeros_like(scores), scores], axis=2)
    top = e.max(axis=2, keepdims=True)
    e = np.exp(e - top)
    live = np.arange(t)[None, :] < lengths[:, None]
    a = np.exp(trans - trans.max())
    fwd, bwd, norm = np.empty((t, d, 2)), np.ones((t, d, 2)), np.ones((t, d))
    fwd[0] = e[:, 0]
    norm[0] = fwd[0].sum(axis=1)
    fwd[0] /= norm[0][:, None]
    for i in range(1, t):
        f = (fwd[i - 1] @ a) * e[:, i]
        z = f.sum(axis=1)
        on = live[:, i]
        fwd[i] = np.where(on[:, None], f / z[:, None], fwd[i - 1])
        norm[i] = np.where(on, z, 1)
    pairs = np.zeros((2, 2))
    for i in range(t - 2, -1, -1):
        on = live[:, i + 1]
        x = e[:, i + 1] * bwd[i + 1]
        b = (x @ a.T) / norm[i + 1][:, None]
        bwd[i] = np.where(on[:, None], b, 1)
        pairs += a * ((fwd[i][on] / norm[i + 1][on][:, None]).T @ x[on])
    p = fwd * bwd
    p = p[:, :, 1] / p.sum(axis=2)
    log_z = (np.log(norm) * live.T).sum() + (top[:, :, 0] * live).sum() + (lengths - 1).clip(0).sum() * trans.max()
    return p.T, pairs, log_z


def padded(values: np.ndarray, first: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of the texts ``pick`` as rows of one width, their lengths and the flat places."""
    lengths = (first[1:] - first[:-1])[pick]
    place = first[:-1][pick][:, None] + np.arange(lengths.max())[None, :]
    place = np.where(np.arange(lengths.max())[None, :] < lengths[:, None], place, 0)
    return values[place], lengths, place


def chains(first: np.ndarray, cells: int = 1 << 16):
    """Texts with lines, in groups of like length and at most about ``cells`` padded lines."""
    n = first[1:] - first[:-1]
    order = np.argsort(n, kind="stable")
    order = order[n[order] > 0]
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and n[order[end]] * (end + 1 - at) <= cells and n[order[end]] <= 2 * n[order[at]] + 8:
            end += 1
        yield order[at:end]
        at = end


def document_means(scores: np.ndarray, weight: np.ndarray, first: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Length-weighted mean of the marginals per text; NaN without lines."""
    out = np.full(len(first) - 1, np.nan)
    for pick in chains(first):
        s, n, place = padded(scores, first, pick)
        p, _, _ = marginals(s, n, trans)
        w = np.where(np.arange(s.shape[1])[None, :] < n[:, None], weight[place], 0)
        out[pick] = (p * w).sum(axis=1) / w.sum(axis=1)
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    trans: np.ndarray
    slope: float
    offset: float
    prior: float

    def means(self, own: np.ndarray, weight: np.ndarray, first: np.ndarray) -> np.ndarray:
        x = with_neighbours((own - self.mean) / self.scale, first)
        return document_means(x @ self.weights, weight, first, self.trans)

    def scores(self, own: np.ndarray, weight: np.ndarray, first: np.ndarray) -> np.ndarray:
        m = self.means(own, weight, first)
        return np.where(np.isnan(m), self.prior, 1 / (1 + np.exp(-(self.slope * _logit(m) + self.offset))))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


class _Ascent:
    """Adam, on a gradient to climb."""

    def __init__(self, size: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, grad: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.01 * (grad * grad - self.v)
        return self.rate * (self.m / (1 - 0.9 ** self.t)) / (np.sqrt(self.v / (1 - 0.99 ** self.t)) + 1e-8)


def train(own: np.ndarray, weight: np.ndarray, first: np.ndarray, labels: np.ndarray, steps: int = STEPS) -> Model:
    """Fit on texts whose lines all carry their text's label (0 or 1)."""
    n = len(labels)
    prior = (labels.sum() + 1) / (n + 2)
    mean = own.mean(axis=0) if len(own) else np.zeros(N_OWN)
    scale = np.maximum(own.std(axis=0), 1e-6) if len(own) else np.ones(N_OWN)
    model = Model(mean, scale, np.zeros(1 + 3 * N_OWN), np.zeros((2, 2)), 0.0, float(np.log(prior / (1 - prior))), float(prior))
    if not len(own) or labels.min() == labels.max():
        return model
    x = with_neighbours((own - mean) / scale, first)
    size = first[1:] - first[:-1]
    y = np.repeat(labels, size).astype(float)
    seen = np.zeros((2, 2))
    for k in (0, 1):
        seen[k, k] = np.maximum(size[labels == k] - 1, 0).sum()
    groups = [(pick, *padded(np.arange(len(own)), first, pick)[1:]) for pick in chains(first, 1 << 18)]
    ascent = _Ascent(x.shape[1] + 4, RATE)
    for _ in range(steps):
        scores, p, pairs = x @ model.weights, np.zeros(len(own)), np.zeros((2, 2))
        for _pick, lengths, place in groups:
            q, e, _ = marginals(scores[place], lengths, model.trans)
            on = np.arange(place.shape[1])[None, :] < lengths[:, None]
            p[place[on]] = q[on]
            pairs += e
        grad = np.concatenate([x.T @ (y - p), (seen - pairs).ravel()]) / len(own)
        grad -= PENALTY * np.concatenate([model.weights, model.trans.ravel()])
        move = ascent.step(grad)
        model.weights, model.trans = model.weights + move[:-4], model.trans + move[-4:].reshape(2, 2)
    m = document_means(x @ model.weights, weight, first, model.trans)
    z, t = _logit(m[~np.isnan(m)]), labels[~np.isnan(m)]
    ab, ascent = np.array([1.0, 0.0]), _Ascent(2, 0.05)
    for _ in range(400):
        p = 1 / (1 + np.exp(-(ab[0] * z + ab[1])))
        ab = ab + ascent.step(np.array([((t - p) * z).mean(), (t - p).mean()]) - 1e-3 * ab)
    model.slope, model.offset = float(ab[0]), float(ab[1])
    return model


def _sample_features(batches):
    schema = pa.schema([("place", pa.int64()), ("label", pa.int64()), ("own", pa.binary()), ("weight", pa.binary())])
    for batch in slices(batches, 128):
        own, weight, first = line_features(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("place"), batch.column("label"),
             pa.array([own[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary()),
             pa.array([weight[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())], schema=schema)


def held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Learn from at most ``sample`` labelled documents outside the held-out fold."""
    ship_code(docs.sparkSession)
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("long").alias("label")).filter(
        F.col("_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("_id")))
    known = known.withColumn("place", F.xxhash64("_id")).orderBy("place", "label").limit(sample)
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).join(F.broadcast(known), "_id")  # ``known``: at most ``sample`` rows
    # a document id may be met any number of times: equal texts count once, and ``sample`` rows are the most
    rows = rows.select("place", "label", "text").dropDuplicates().orderBy("place", "label", F.xxhash64("text")).limit(sample)
    got = rows.mapInArrow(_sample_features, "place long, label long, own binary, weight binary").collect()
    own = [np.frombuffer(r["own"]).reshape(-1, N_OWN) for r in got]
    weight = [np.frombuffer(r["weight"]) for r in got]
    first = np.concatenate([[0], np.cumsum([len(w) for w in weight])]).astype(np.int64)
    return train(np.vstack(own) if own else np.zeros((0, N_OWN)), np.concatenate(weight) if weight else np.zeros(0),
                 first, np.array([r["label"] for r in got], np.int64))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, score."""
    ship_code(docs.sparkSession)

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
        for batch in slices(batches, 256):
            own, weight, first = line_features(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(own, weight, first))], schema=schema)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **params) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scored = score(docs, fit(docs, labels, **params))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
