"""Language identification by word frequencies, backing off to character n-grams.

A known word scores each language by its log relative frequency there. An unseen word
is looked up by its character n-grams with word-edge marks: by all of the longest order
of which the model knows any, averaged; by the next shorter order otherwise; and by
nothing if even its characters are new. A text's score for a language is the sum over
its words; the answer is the best language.

Training uses at most ``SAMPLE`` documents of each language, those with the least hash
of their id, in full. Of the counts the model keeps the ``VOCABULARY`` most frequent
words and as many n-grams of each order, so what is sent to the tasks is bounded.

A word is a run of letters, lower-cased. A null text, an empty one, or one without a
letter is ``und`` with score 0, and so is every text where nothing was learned. Rows
without a language teach nothing. The score is the posterior of the best language with
the evidence of ``EVIDENCE`` words at most, so it does not saturate with length.
Ties go to the first language in order of name. Further columns do not matter.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwright.llm.shared import arrow_map, held_out, slices

SAMPLE = 1000
VOCABULARY = 50_000
ORDERS = (5, 4, 3, 2, 1)
EVIDENCE = 20
UNKNOWN = "und"
_SMOOTH = 0.1
_MEMORY = 200_000
_BYTES = 4 << 20
_WORD = re.compile(r"[^\W\d_]+")


def grams(word: str, order: int) -> list[str]:
    marked = f"<{word}>" if order > 1 else word
    return [marked[k : k + order] for k in range(len(marked) - order + 1)]


class Scores:
    """Scores of keys for each language as rows of one array, not an array for each key."""

    def __init__(self, keys: list[str], logs: np.ndarray):
        self._row = {key: k for k, key in enumerate(keys)}
        self._logs = logs

    def get(self, key: str) -> np.ndarray | None:
        row = self._row.get(key)
        return None if row is None else self._logs[row]


@dataclass
class Model:
    languages: list[str]
    words: Scores
    grams: dict[int, Scores]

    def vector(self, word: str) -> np.ndarray:
        """The word's score for each language."""
        found = self.words.get(word)
        if found is not None:
            return found
        for order in ORDERS:
            known = [v for g in grams(word, order) if (v := self.grams[order].get(g)) is not None]
            if known:
                return np.mean(known, axis=0)
        return np.zeros(len(self.languages))


def _scores(counts: dict[str, Counter], languages: list[str], most: int) -> Scores:
    """Log relative frequency by language for the most frequent keys, smoothed."""
    total = Counter()
    for c in counts.values():
        total.update(c)
    kept = [k for k, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:most]]
    sizes = np.array([sum(counts[x].values()) for x in languages], float)
    table = np.array([[counts[x][k] for x in languages] for k in kept], float).reshape(len(kept), len(languages))
    logs = np.log(table + _SMOOTH) - np.log(sizes + _SMOOTH * max(1, len(total)))
    return Scores(kept, logs)


def train(docs: DataFrame, sample: int = SAMPLE, vocabulary: int = VOCABULARY) -> Model:
    """A model of ``docs`` (doc_id, text, lang); all of its rows may teach."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL AND text != ''")
    chosen = labelled.select("doc_id", "lang").withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample)
    # At most ``sample`` ids for each language.
    texts = labelled.join(F.broadcast(chosen.select("doc_id", "lang").distinct()), ["doc_id", "lang"]).select("lang", "text")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[lang].update(_WORD.findall(text.lower()))
        rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)],
            ["lang", "word", "n"],
        )

    counted = arrow_map(texts, of, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    by_word: dict[str, Counter] = defaultdict(Counter)
    for row in counted.collect():  # the words of the sample
        by_word[row.lang][row.word] = row.n
    languages = sorted(by_word)
    by_gram = {}
    for n in ORDERS:
        counts: dict[str, Counter] = defaultdict(Counter)
        for lang, words in by_word.items():
            for word, times in words.items():
                for g in grams(word, n):
                    counts[lang][g] += times
        by_gram[n] = _scores(counts, languages, vocabulary)
    return Model(languages, _scores(by_word, languages, vocabulary), by_gram)


class Identifier:
    """Scores texts with a model; remembers the vectors of the words it has seen."""

    def __init__(self, model: Model):
        self._model = model
        self._clear()

    def _clear(self) -> None:
        self._row: dict[str, int] = {}
        self._vectors = np.zeros((1024, len(self._model.languages)))

    def _rows(self, words: list[str]) -> np.ndarray:
        known = self._row
        for word in set(words).difference(known):
            n = len(known)
            if n == len(self._vectors):
                self._vectors = np.concatenate([self._vectors, np.zeros_like(self._vectors)])
            self._vectors[n] = self._model.vector(word)
            known[word] = n
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def identify(self, text: str | None) -> tuple[str, float]:
        words = _WORD.findall(text.lower()) if text else []
        if not words or not self._model.languages:
            return UNKNOWN, 0.0
        if len(self._row) > _MEMORY:
            self._clear()
        rows = self._rows(words)
        total = self._vectors[rows].sum(axis=0)
        best = int(total.argmax())
        evidence = (total - total[best]) * (min(len(words), EVIDENCE) / len(words))
        return self._model.languages[best], 1.0 / float(np.exp(evidence).sum())


def identify(
    docs: DataFrame, model: Model, keep: list[str], names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """The columns ``keep`` of ``docs`` with the language and the score of the column ``text`` under ``names``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = Identifier(shared.value)
        for whole in batches:
            for batch in slices(whole, "text", _BYTES):
                answers = [identifier.identify(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(batch.schema.get_field_index(c)) for c in keep),
                        pa.array([a for a, _ in answers], pa.string()),
                        pa.array([s for _, s in answers], pa.float64()),
                    ],
                    [*keep, *names],
                )

    schema = docs.select(*keep).schema.add(names[0], "string").add(names[1], "double")
    wanted = dict.fromkeys([*keep, "text"])
    return arrow_map(docs.select(*wanted), of, schema)


def predict(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; learned from the rows that are not held out."""
    model = train(docs.where(~held_out(F.col("doc_id"))))
    found = identify(docs.select("doc_id", "text"), model, ["doc_id"])
    return found.select(
        F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )
