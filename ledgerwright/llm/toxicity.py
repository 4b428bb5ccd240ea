"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

A text is cut into windows of a few words. Each is compressed with a dictionary of
toxic text and with one of ordinary text; the gain is how many bytes shorter the toxic
one makes it. The gains of a text (greatest ones, mean, share above a threshold) give
its score by a logistic calibration.

Training, on at most ``SAMPLE`` labelled documents of each class, those with the least
hash of their id, of at most ``LONGEST`` characters:

1. Five eighths teach, the others calibrate. Passages seen before are taken out, so
   copies do not vouch for each other. The rest is dealt into ``FOLDS`` parts, each with
   a raw dictionary for each class.
2. A window is typical of its class if every dictionary of the class, from the other
   folds, makes it shorter than any of the other class by ``GAIN`` bytes. Chance
   repetitions do not pass several independent dictionaries.
3. Separate dictionaries are trained on the typical toxic and ordinary windows, for
   each of ``PAIRS``; both are put on the same base of ordinary text, so that windows
   with nothing typical compress alike.
4. The calibration weighs the classes by their counts over all labelled rows.

Null and empty texts score 0. A text is lower-cased; it is never cut short. Without
rows of both classes every text scores 0. Rows with a null label teach nothing.
Repeated ids among the labels count once for each label. Further columns do not matter.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwright.llm.shared import arrow_map, held_out, slices

SAMPLE = 2000
LONGEST = 20_000
FOLDS = 6
FOLD_BYTES = 150_000
MINED_WORDS = 4
GAIN = 2
BASE_BYTES = 100_000
#: Size of the trained dictionaries, length of their segments, words in a window.
PAIRS = ((1024, 32, 7), (1536, 20, 7), (1024, 24, 10))
LEVEL = 3
THRESHOLD = 0.7
_RUN = 5
_BYTES = 4 << 20


@dataclass
class Model:
    pairs: list[tuple[bytes, bytes, int]]  # ordinary and toxic dictionary, words in a window
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False
    )


def windows(words: list[str], n: int) -> list[bytes]:
    return [" ".join(words[k : k + n]).encode() for k in range(0, len(words), n)]


def features(words: list[str], pairs: list[tuple]) -> list[float]:
    """``pairs`` hold the compressors of the ordinary and the toxic dictionary and the window's words."""
    out = []
    for ordinary, toxic, n in pairs:
        gains = np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in windows(words, n)], float)
        top = np.partition(gains, -3)[-3:] if len(gains) > 3 else gains
        out += [top.mean(), gains.mean(), (gains > GAIN).mean(), gains.mean() * np.sqrt(len(gains))]
    return [*out, np.log1p(len(words))]


def _unseen(words: list[str], seen: set) -> list[list[str]]:
    """Runs of words outside passages that an earlier text had."""
    out, run = [], []
    for k, word in enumerate(words):
        passage = hash(tuple(words[k : k + _RUN]))
        if len(words) - k >= _RUN and passage in seen:
            if run:
                out.append(run)
                run = []
            continue
        seen.add(passage)
        run.append(word)
    return [*out, run] if run else out


def _raw(texts: list[list[list[str]]], most: int) -> bytes:
    data = []
    size = 0
    for runs in texts:
        if size > most:
            break
        data.append(" ".join(" ".join(r) for r in runs).encode())
        size += len(data[-1]) + 1
    return b" ".join(data)[:most] or b" "


def _typical(folds: list[list], own: list, other: list) -> list[bytes]:
    """Windows that all dictionaries of their class but their fold's own explain better than the other class's."""
    out = []
    for fold, texts in enumerate(folds):
        a, b = ([c for k, c in enumerate(x) if k != fold] for x in (own, other))
        for w in (w for runs in texts for run in runs for w in windows(run, MINED_WORDS)):
            least, most = len(b[0].compress(w)), len(a[0].compress(w))
            if least - most < GAIN:
                continue
            least = min([least, *(len(c.compress(w)) for c in b[1:])])
            most = max([most, *(len(c.compress(w)) for c in a[1:])])
            if least - most >= GAIN:
                out.append(w)
    return out


def _trained(samples: list[bytes], size: int, segment: int, seed: int) -> bytes:
    shuffled = sorted(samples)
    random.Random(seed).shuffle(shuffled)
    try:
        return zstandard.train_dictionary(size + 256, shuffled, k=segment, d=6, level=LEVEL).as_bytes()[-size:]
    except zstandard.ZstdError:  # too few samples to choose from: all of them
        return b" ".join(shuffled)[-size:]


def _fitted(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 0.3) -> np.ndarray:
    """Logistic regression with an intercept by Newton's method."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (weight * (y - p)) - penalty * w)
    return w


def fit(teach: dict[int, list[str]], calibrate: dict[int, list[str]], counts: dict[int, int]) -> Model | None:
    """A model of texts by class; ``counts`` are the classes' rows in all."""
    if not all(teach.get(c) and calibrate.get(c) for c in (0, 1)):
        return None
    seen: set = set()
    runs = {c: [_unseen(t.lower().split(), seen) for t in teach[c]] for c in (1, 0)}
    folds = {c: [runs[c][k::FOLDS] for k in range(FOLDS)] for c in runs}
    raw = {c: [_compressor(_raw(f, FOLD_BYTES)) for f in folds[c]] for c in folds}
    typical = {c: _typical(folds[c], raw[c], raw[1 - c]) for c in raw}
    if not typical[1]:
        return None
    base = _raw(runs[0], BASE_BYTES)
    pairs = [
        (base + _trained(typical[0], size, segment, k), base + _trained(typical[1], size, segment, k), n)
        for k, (size, segment, n) in enumerate(PAIRS)
    ]
    ready = [(_compressor(o), _compressor(t), n) for o, t, n in pairs]
    rows = [(c, t.lower().split()) for c in (0, 1) for t in calibrate[c]]
    rows = [(c, words) for c, words in rows if words]
    if len({c for c, _ in rows}) < 2:
        return None
    y = np.array([c for c, _ in rows], float)
    x = np.array([features(words, ready) for _, words in rows])
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    share = counts[1] / (counts[0] + counts[1])
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    return Model(pairs, center, scale, _fitted((x - center) / scale, y, weight))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, longest: int = LONGEST) -> Model | None:
    """A model of all the given rows (doc_id, text) with a label (doc_id, toxic)."""
    named = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    named = named.distinct()
    counts = {r.toxic: r.n for r in named.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = named.withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample)
    # At most ``sample`` ids of each class.
    texts = docs.where(F.length("text").between(1, longest)).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    teach: dict[int, list[str]] = {0: [], 1: []}
    calibrate: dict[int, list[str]] = {0: [], 1: []}
    for row in sorted(texts.collect(), key=lambda r: (r.toxic, r.n, r.text)):
        (teach if row.n % 8 < 5 else calibrate)[row.toxic].append(row.text)
    return fit(teach, calibrate, counts)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every row (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        ready = [(_compressor(o), _compressor(t), n) for o, t, n in m.pairs] if m else []
        for whole in batches:
            for batch in slices(whole, "text", _BYTES):
                out = []
                for text in batch.column(1).to_pylist():
                    words = text.lower().split() if text and m else []
                    if not words:
                        out.append(0.0)
                        continue
                    x = (np.array(features(words, ready)) - m.center) / m.scale
                    out.append(1 / (1 + float(np.exp(-np.clip(x @ m.weights[:-1] + m.weights[-1], -30, 30)))))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["doc_id", "score"])

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), of, "doc_id long, score double")


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; learned from labels that are not held out."""
    model = train(docs, labels.where(~held_out(F.col("doc_id"))))
    return score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
