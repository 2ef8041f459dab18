"""Toxicity by a small convolutional text classifier, trained in numpy.

A word's embedding is the sum of hashed rows: one for the word and one for
each of its first 4, 5, 6 and 7 bytes, so inflected and joined forms of a stem
share rows.  Filters of widths 1, 2 and 3 run over the words, each filter
keeps its largest value over the whole text (never below 0), and a logistic
unit gives the score.  The embedding starts from the class log-odds of the
rows and is trained on by Adagrad.  The language never enters a score; it only
chooses the threshold of ``flagged``, calibrated on labelled rows that the fit
did not see.

The fit reads a bounded sample of labelled rows: about ``MAX_TRAIN`` of them,
chosen by a hash of ``doc_id``, of at most ``MAX_TRAIN_CHARS`` characters each,
without the one in ``CALIBRATE`` that is left to the thresholds.  The thresholds
come from all labelled rows, not held out, that the fit did not read: whole
texts of any length are scored in Spark, counted by language and score (in
steps of 1 / ``STEPS`` of its logit) and cut where running sums give the best
F1.  Scoring covers every row and whole texts.

Defined cases: a null text counts as empty; an empty text gets the score of a
text without any signal; without labels of both classes every score is the
share of toxic labels (0 without labels) and nothing is flagged; repeated rows
get equal scores; labels without a row, or null labels, are ignored; rows that
share a ``doc_id`` share its label; further columns are ignored.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.shared import bounded_batches, discard, lean_task, stash, text_slices
from cohortlens.llm.shingles import word_codes

MAX_TRAIN = 6_000
MAX_TRAIN_CHARS = 60_000
#: One in so many rows of the labelled sample is left to the thresholds.
CALIBRATE = 5
#: Steps of a logit; scores lie within 30 on both sides, which bounds a language's counts.
STEPS = 4096
ROWS_BITS = 16
DIM = 16
FILTERS = 8
WIDTHS = (1, 2, 3)
PREFIXES = (4, 5, 6, 7)
EPOCHS = 3
BATCH = 32
PAD = max(WIDTHS)
EDGE = b".,;:!?\"'()[]"


@dataclass
class Model:
    embedding: np.ndarray
    filters: list[np.ndarray]  # for each width: (width, DIM, FILTERS)
    shift: np.ndarray  # of each filter
    out: np.ndarray
    bias: float
    constant: float | None = None
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5


def word_rows(words: list[bytes]) -> np.ndarray:
    """The embedding rows of each word; a word shorter than a prefix repeats itself there."""
    mask, bare = (1 << ROWS_BITS) - 1, [w.strip(EDGE) for w in words]
    out = np.empty((len(words), 1 + len(PREFIXES)), np.int64)
    out[:, 0] = np.fromiter((xxhash.xxh32_intdigest(w, 1) for w in bare), np.int64, len(words)) & mask
    column = pa.array(bare, pa.binary())
    for j, n in enumerate(PREFIXES, 1):
        heads = pc.binary_slice(column, 0, n).dictionary_encode()
        hashes = np.array([xxhash.xxh32_intdigest(w, n) for w in heads.dictionary.to_pylist()], np.int64) & mask
        out[:, j] = hashes[heads.indices.to_numpy()] if len(words) else 0
    return out


def padded(at: np.ndarray, counts: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Word places with PAD blank words after each text, and where each text begins."""
    starts = np.cumsum(counts + PAD) - (counts + PAD)
    flat = np.full(int((counts + PAD).sum()), pad, np.int64)
    shift = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    flat[np.arange(len(at)) + shift] = at
    return flat, starts


def tables(model: Model, rows: np.ndarray) -> np.ndarray:
    """What each word (the last is the blank) adds to every filter at each of its places."""
    emb = np.concatenate([model.embedding[rows].sum(axis=1), np.zeros((1, DIM), np.float32)])
    flat = np.concatenate([w.transpose(1, 0, 2).reshape(DIM, -1) for w in model.filters], axis=1)
    return emb @ flat


def convolve(model: Model, table: np.ndarray, flat: np.ndarray, starts: np.ndarray, counts: np.ndarray, where=False):
    """The largest value of each filter over each text, and where it stands."""
    tops, places, at = [], [], 0
    bounds = np.stack([starts, starts + counts + 1], axis=1).ravel()
    for width in WIDTHS:
        n = len(flat) - PAD + 1
        total = table[flat[:n], at:at + FILTERS]
        for j in range(1, width):
            total = total + table[flat[j:j + n], at + j * FILTERS:at + (j + 1) * FILTERS]
        at += width * FILTERS
        # The last bound may lie at the end of the windows.
        tops.append(np.maximum.reduceat(total, np.minimum(bounds, n - 1), axis=0)[::2] if len(starts) else total[:0])
        if where:
            places.append(np.stack([s + total[s:s + c + 1].argmax(axis=0) for s, c in zip(starts, counts, strict=True)]))
    return np.concatenate(tops, axis=1) + model.shift, places


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def score_texts(model: Model, column: pa.Array) -> np.ndarray:
    at, words, counts = word_codes(column)
    if model.constant is not None or not len(counts):
        return np.full(len(counts), model.constant or 0.0)
    flat, starts = padded(at, counts, len(words))
    tops, _ = convolve(model, tables(model, word_rows(words)), flat, starts, counts)
    return sigmoid(np.maximum(tops, 0) @ model.out + model.bias).astype(float)


def fit(column: pa.Array, toxic: np.ndarray, seed: int = 7) -> Model:
    """Train on texts and 0/1 labels."""
    random = np.random.default_rng(seed)
    n_filters = FILTERS * len(WIDTHS)
    blank = Model(np.zeros((1 << ROWS_BITS, DIM), np.float32), [np.zeros((w, DIM, FILTERS), np.float32) for w in WIDTHS],
                  np.zeros(n_filters, np.float32), np.zeros(n_filters, np.float32), 0.0)
    if not len(toxic) or toxic.min() == toxic.max():
        blank.constant = float(toxic.mean()) if len(toxic) else 0.0
        return blank
    at, words, counts = word_codes(column)
    rows = word_rows(words)
    ends = np.cumsum(counts)
    texts = [at[e - c:e] for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]

    # Class log-odds of each embedding row, by the texts that hold it.
    held = np.zeros((2, 1 << ROWS_BITS))
    for text, label in zip(texts, toxic, strict=True):
        held[label, np.unique(rows[text].ravel())] += 1
    size = np.array([(toxic == 0).sum(), (toxic == 1).sum()], float)
    prior = held.sum(axis=0) / size.sum()
    weight = 4.0
    odds = (np.log((held[1] + weight * prior) / (size[1] + weight) + 1e-9)
            - np.log((held[0] + weight * prior) / (size[0] + weight) + 1e-9))
    odds[held.sum(axis=0) < 3] = 0
    model = blank
    model.embedding[:] = random.normal(0, 0.05, model.embedding.shape)
    model.embedding[held.sum(axis=0) == 0] = 0
    model.embedding[:, 0] = np.clip(odds, -4, 4) / (1 + len(PREFIXES))
    for w in model.filters:
        w[:] = random.normal(0, 0.1, w.shape)
        w[0, 0, 0] = 1.0
    model.shift[:] = -0.5
    model.out[:] = 0.5
    model.bias = float(np.log(size[1] / size[0]))

    params = [model.embedding, *model.filters, model.shift, model.out]
    sums = [np.full(p.shape, 1e-3, np.float32) for p in params]
    bias_sum = 1e-3
    rate = 0.05
    for _ in range(EPOCHS):
        order = random.permutation(len(texts))
        for k in range(0, len(order), BATCH):
            pick = order[k:k + BATCH]
            words_here, at_here = np.unique(np.concatenate([texts[i] for i in pick]), return_inverse=True)
            n = np.array([len(texts[i]) for i in pick])
            flat, starts = padded(at_here, n, len(words_here))
            here = rows[words_here]
            tops, places = convolve(model, tables(model, here), flat, starts, n, where=True)
            pooled = np.maximum(tops, 0)
            gap = (sigmoid(pooled @ model.out + model.bias) - toxic[pick]).astype(np.float32) / len(pick)
            back = gap[:, None] * model.out * (tops > 0)
            grads = [None, *(np.zeros_like(w) for w in model.filters), back.sum(axis=0), pooled.T @ gap]
            emb = np.concatenate([model.embedding[here].sum(axis=1), np.zeros((1, DIM), np.float32)])
            down = np.zeros_like(emb)
            for i, width in enumerate(WIDTHS):
                part = back[:, i * FILTERS:(i + 1) * FILTERS]
                for j in range(width):
                    at_j = flat[places[i] + j]
                    grads[1 + i][j] = np.einsum("bf,bfd->df", part, emb[at_j])
                    np.add.at(down, at_j, part[:, :, None] * model.filters[i][j].T[None])
            bias_grad = float(gap.sum())
            bias_sum += bias_grad ** 2
            model.bias -= rate * bias_grad / bias_sum ** 0.5
            used = np.flatnonzero(np.abs(down[:-1]).sum(axis=1))
            touched, inverse = np.unique(here[used], return_inverse=True)
            step = np.zeros((len(touched), DIM), np.float32)
            np.add.at(step, inverse.ravel(), np.repeat(down[used], here.shape[1], axis=0))
            sums[0][touched] += step ** 2
            model.embedding[touched] -= 0.2 * rate * step / np.sqrt(sums[0][touched])
            for p, s, g in zip(params[1:], sums[1:], grads[1:], strict=True):
                s += g ** 2
                p -= rate * g / np.sqrt(s)
    return model


def _best_cut(counts: pa.Table) -> pa.Table:
    """The threshold of the best F1 (then the highest) of one language's counts by score step."""
    counts = counts.sort_by([("step", "descending")])
    n, hit, low, high = (counts.column(c).to_numpy() for c in ("n", "hit", "low", "high"))
    flagged, right = np.cumsum(n), np.cumsum(hit)
    best = int(np.argmax(2 * right / (flagged + right[-1])))
    below = high[best + 1] if best + 1 < len(high) else 0.0
    return pa.table({"lang": counts.column("lang").slice(0, 1), "n": [int(flagged[-1])], "hit": [int(right[-1])],
                     "cut": [float(low[best] + below) / 2]},
                    schema=pa.schema([("lang", pa.string()), ("n", pa.int64()), ("hit", pa.int64()), ("cut", pa.float64())]))


def calibrate(model: Model, scored: DataFrame, least: int = 30) -> None:
    """A threshold for each language: the best F1 over ``scored`` (lang, score, toxic), rows that the fit did not see.

    A language with fewer than ``least`` such rows, or one class only, takes
    the threshold of all rows together.  The threshold lies midway between the
    lowest score that is flagged and the next below it, and not under 0.2.
    Rows are counted by language and score step before they meet, so a
    language's group is bounded by the steps; only the thresholds, a row for
    each language, come to the driver.
    """
    step = F.floor(F.log(F.col("score") / (1 - F.col("score"))) * STEPS).alias("step")
    # The rows of all languages together have no language.
    each = F.explode(F.array(F.coalesce("lang", F.lit("")), F.lit(None).cast("string"))).alias("lang")
    counts = scored.select(each, step, "toxic", "score").groupBy("lang", "step").agg(
        F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("hit"), F.min("score").alias("low"), F.max("score").alias("high"))
    cuts = counts.groupBy("lang").applyInArrow(_best_cut, "lang string, n long, hit long, cut double").collect()
    found = {r["lang"]: max(0.2, r["cut"]) for r in cuts
             if 0 < r["hit"] < r["n"] and (r["lang"] is None or r["n"] >= least)}
    model.threshold = found.pop(None, model.threshold)
    model.thresholds = found


def held_out(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string")) % 4 == 2


def _fit_sample(batches):
    """The one task that fits: the bounded sample in, the pickled model out."""
    rows = [r for batch in batches for r in batch.to_pylist()]
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    model = fit(pa.array([r["text"] for r in rows], pa.string()), np.array([r["toxic"] for r in rows], np.int64))
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])


def _lang(docs: DataFrame) -> Column:
    return (F.col("lang") if "lang" in docs.columns else F.lit(None)).cast("string")


def _labelled(labels: DataFrame, max_train: int) -> DataFrame:
    """l_id, toxic, sampled (whether the fit may read it) of the labels that are not held out."""
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(F.max("toxic").cast("int").alias("toxic")))
    share = min(1.0, max_train / max(known.count(), 1))
    return known.withColumn("sampled", (F.pmod(F.xxhash64("l_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
                            & (F.pmod(F.xxhash64("l_id", F.lit(3)), F.lit(CALIBRATE)) != 0))


def _short(text: str = "text") -> Column:
    return F.length(F.coalesce(text, F.lit(""))) <= MAX_TRAIN_CHARS


def _fitted(docs: DataFrame, known: DataFrame) -> Model:
    """The model, still without thresholds.

    The sample goes to one task, which is bounded by ``max_train`` and
    ``MAX_TRAIN_CHARS``; only the model, of a fixed size, comes to the driver.
    """
    sample = (docs.where(_short()).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
              .join(known.where("sampled"), F.col("doc_id") == F.col("l_id")).select("doc_id", "text", "toxic"))
    found = sample.repartition(1).mapInArrow(lean_task(_fit_sample), "model binary").collect()
    return pickle.loads(bytes(found[0]["model"])) if found else fit(pa.array([], pa.string()), np.empty(0, np.int64))


def _scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang, short, score of every row, written once; texts are not shuffled to meet their labels."""
    return stash(_scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _lang(docs).alias("lang"),
                                     _short().alias("short")), model, ("doc_id", "lang", "short"), "score"), "toxicity-scores")


def _calibrated(model: Model, scores: DataFrame, known: DataFrame) -> Model:
    """``model`` with thresholds from all rows of ``scores`` that have a label and that the fit did not read."""
    if model.constant is None:
        calibrate(model, scores.join(known, F.col("doc_id") == F.col("l_id")).where("not (sampled and short)"))
    return model


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Fit and calibrate on the labelled rows that are not held out."""
    known = _labelled(labels, max_train)
    model = _fitted(docs, known)
    if model.constant is not None:
        return model
    scores = _scores(docs.where(F.col("doc_id").isNotNull() & ~held_out()), model)
    _calibrated(model, scores, known)
    discard(scores)
    return model


def _score(model, alias: str):
    def run(batches):
        for piece in text_slices(batches, 0, 2 << 20):
            yield pa.RecordBatch.from_arrays(
                [*piece.columns[1:], pa.array(score_texts(model.value, piece.column(0)), pa.float64())],
                names=[*piece.schema.names[1:], alias])
    return lean_task(run)


def _scored(docs: DataFrame, model: Model, names, alias: str) -> DataFrame:
    """The columns ``names`` of ``docs`` and the score."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = T.StructType([*(docs.schema[c] for c in names), T.StructField(alias, T.DoubleType())])
    return docs.select(F.col("text").cast("string").alias("__text"), *[f"`{c}`" for c in names]).mapInArrow(_score(shared, alias), kind)


def _flagged(model: Model, score: str, lang: Column) -> Column:
    """Whether a score reaches the threshold of its language."""
    own = F.lit(model.threshold)
    if model.thresholds:
        each = F.create_map(*[F.lit(x) for pair in sorted(model.thresholds.items()) for x in pair])
        own = F.coalesce(F.try_element_at(each, F.coalesce(lang, F.lit(""))), own)
    return (F.col(score) >= own) & F.lit(model.constant is None)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` with ``__score`` and ``__flagged``."""
    out = _scored(docs, model, docs.columns, "__score")
    return out.withColumn("__flagged", _flagged(model, "__score", _lang(docs)))


def toxicity_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (score of 0.3 and over), flagged (the language's threshold)."""
    known = _labelled(labels, MAX_TRAIN)
    model = _fitted(docs, known)
    scores = _scores(docs, model)
    _calibrated(model, scores, known)
    return scores.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"), _flagged(model, "score", F.col("lang")).alias("flagged"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not flag, with all their columns.

    Each row is scored once: it is written with its score, and the thresholds
    that the written scores give decide which rows are read back.
    """
    known = _labelled(labels, MAX_TRAIN)
    model = _fitted(docs, known)
    if model.constant is not None:
        return docs
    rows = stash(_scored(docs.withColumn("__short", _short()), model, [*docs.columns, "__short"], "__score"), "toxicity-rows")
    _calibrated(model, rows.select(F.col("doc_id").cast("long").alias("doc_id"), _lang(docs).alias("lang"),
                                   F.col("__short").alias("short"), F.col("__score").alias("score")), known)
    return rows.where(~_flagged(model, "__score", _lang(docs))).select(*[f"`{c}`" for c in docs.columns])
