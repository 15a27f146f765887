"""Language identification, words first: log frequencies of known words, shorter and shorter n-grams for the others.

The model holds per-language log frequencies of the words and character n-grams of a labelled sample. A known
word adds its log frequencies; an unseen word adds the mean over its known n-grams of the longest length at which it
has any, from ``LONGEST`` characters down to one. The language with the largest sum is the prediction, its share of the
exponentials the score.

Model bound (documented parameter): about ``sample_rows`` different texts per language, chosen by a hash of the text.
That bounds what is collected and broadcast, whatever the corpus size; every word and n-gram of the sample is kept.
Counting runs on Spark, n-grams are counted from the counted words, and every text is predicted whole.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; rows with a null label or text are not
learned from; without any labelled row every text is ``und``. Of equal languages the first by name wins.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladegrid.llm import words as text_words
from cladegrid.session import cut_lineage

LONGEST = 5
SAMPLE_ROWS = 3000
UNDETERMINED = "und"
# Unseen words remembered by a worker; only speed depends on it.
REMEMBERED = 20_000
# Tokens a task counts before it hands them on, so that long texts need no more memory.
COUNTED = 50_000
# Characters of texts whose words are looked up together.
TOGETHER = 1 << 20

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> Counter:
    """Counts of the lower-cased words (runs of letters) of a text."""
    found = Counter(_WORD.findall(text.lower())) if text else Counter()
    if not found or "".join(found).isalpha():
        return found
    for word in [w for w in found if not w.isalpha()]:  # numerals such as superscripts are no letters
        n = found.pop(word)
        for piece in "".join(c if c.isalpha() else " " for c in word).split():
            found[piece] += n
    return found


def grams_of(word: str, length: int) -> list[str]:
    """Character n-grams of a word with marked ends; single characters without the marks."""
    marked = f"<{word}>" if length > 1 else word
    return [marked[i : i + length] for i in range(len(marked) - length + 1)]


def _places(tokens: set[str], known: pa.Array) -> dict[str, int]:
    """The places of those tokens that are known."""
    given = pa.array(list(tokens), pa.string())
    at = pc.index_in(given, value_set=known)
    found = pc.is_valid(at)
    return dict(zip(given.filter(found).to_pylist(), at.filter(found).to_pylist()))


class Model:
    """Languages in order, log frequencies by language of words, and those of the n-grams of each length.

    Tokens stay Arrow arrays, in which many are looked up at once, so that no worker keeps a table of all.
    """

    def __init__(self, languages: list[str], words: pa.Array, word_logs: np.ndarray, grams: dict[int, tuple[pa.Array, np.ndarray]]) -> None:
        self.languages, self.known_words, self.word_logs, self.grams = languages, words, word_logs, grams

    @property
    def words(self) -> dict[str, int]:
        return {t: i for i, t in enumerate(self.known_words.to_pylist())}

    def unseen(self, words: list[str]) -> dict[str, np.ndarray]:
        """For each word the mean over its known n-grams of the longest length at which it has any, else zeros."""
        out: dict[str, np.ndarray] = {}
        for length in range(LONGEST, 0, -1):
            if length not in self.grams or not words:
                continue
            known, logs = self.grams[length]
            own = [grams_of(word, length) for word in words]
            places = _places(set().union(*own), known)
            for word, grams in zip(words, own):
                at = [places[g] for g in grams if g in places]
                if at:
                    out[word] = logs[at].mean(0)
            words = [word for word in words if word not in out]
        return out | dict.fromkeys(words, np.zeros(len(self.languages)))


class Predictor:
    def __init__(self, model: Model) -> None:
        self.model, self.seen = model, {}

    def many(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Predictions for texts, whose words are looked up together."""
        out: list[tuple[str, float]] = []
        counted, size = [], 0
        for k, text in enumerate(texts):
            counted.append(words_of(text))
            size += len(text or "")
            if size >= TOGETHER or k + 1 == len(texts):
                words = set().union(*counted)
                known = _places(words, self.model.known_words)
                if len(self.seen) >= REMEMBERED:
                    self.seen.clear()
                self.seen |= self.model.unseen([w for w in words if w not in known and w not in self.seen])
                out += [self._judge(counts, known) for counts in counted]
                counted, size = [], 0
        return out

    def _judge(self, counts: Counter, places_of: dict[str, int]) -> tuple[str, float]:
        if not counts or not self.model.languages:
            return UNDETERMINED, 0.0
        places = list(map(places_of.get, counts))
        times = np.fromiter(counts.values(), float, len(counts))
        total = np.zeros(len(self.model.languages))
        if None in places:
            known = np.array([at is not None for at in places])
            for word, at, n in zip(counts, places, times.tolist()):
                if at is None:
                    total += self.seen[word] * n
            places, times = [at for at in places if at is not None], times[known]
        if len(places):
            total += times @ self.model.word_logs[places]
        best = int(np.argmax(total))
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


def _word_counts(rows: DataFrame, languages: list[str]) -> DataFrame:
    """(token, counts by language) of the words of rows (lang, text)."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                for token, n in words_of(text).items():
                    found[lang, token] += n
                if len(found) >= COUNTED:
                    yield listed(found)
                    found = Counter()
        yield listed(found)
        del found
        text_words.give_back()

    def listed(found: Counter) -> pa.RecordBatch:
        columns = list(zip(*((lang, token, n) for (lang, token), n in found.items()))) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())], names=["lang", "token", "n"])

    by_language = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"n{i}") for i, lang in enumerate(languages)]
    return rows.mapInArrow(tokens, "lang string, token string, n long").groupBy("token").agg(*by_language)


def _gram_counts(words: DataFrame, languages: list[str]) -> DataFrame:
    """(token, counts by language) of the n-grams of counted words."""
    names = [f"n{i}" for i in range(len(languages))]

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, COUNTED // 50):
                batch = whole.slice(start, COUNTED // 50)
                places: dict[str, int] = {}
                own, of_word = [], []
                for k, word in enumerate(batch.column("token").to_pylist()):
                    for length in range(1, LONGEST + 1):
                        for gram in grams_of(word, length):
                            own.append(places.setdefault(gram, len(places)))
                            of_word.append(k)
                counts = np.zeros((len(places), len(names)), np.int64)
                np.add.at(counts, own, np.stack([batch.column(n).to_numpy() for n in names], 1)[of_word])
                yield pa.RecordBatch.from_arrays([pa.array(list(places), pa.string()), *(pa.array(counts[:, i]) for i in range(len(names)))], names=["token", *names])

    counted = words.mapInArrow(tokens, ", ".join(["token string", *(f"{n} long" for n in names)]))
    return counted.groupBy("token").agg(*[F.sum(n).alias(n) for n in names])


def _logs(table: pa.Table, languages: list[str]) -> tuple[pa.Array, np.ndarray]:
    """Tokens and their log relative frequencies, smoothed by a half."""
    counts = np.stack([table.column(f"n{i}").to_numpy() for i in range(len(languages))], 1) + 0.5
    return table.column("token").combine_chunks(), np.log(counts / counts.sum(0))


def _logs_by_length(table: pa.Table, languages: list[str]) -> dict[int, tuple[pa.Array, np.ndarray]]:
    lengths = pc.utf8_length(table.column("token"))
    return {n: _logs(table.filter(pc.equal(lengths, n)), languages) for n in pc.unique(lengths).to_pylist()}


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from the rows with a label and a text."""
    rows = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.where("lang is not null and text is not null")
    # the share is one of different texts, as copies are picked together and learned from once
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.countDistinct(F.xxhash64("text")).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], pa.array([], pa.string()), np.zeros((0, 0)), {})
    share = F.create_map(*[F.lit(x) for lang_ in languages for x in (lang_, sample_rows / sizes[lang_])])
    picked = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 32)) < share[F.col("lang")] * (1 << 32)).distinct()
    # the counted words are kept, as they are read twice
    words = cut_lineage(_word_counts(picked, languages))
    ordered = [x.orderBy("token").toArrow() for x in (words, _gram_counts(words, languages))]
    return Model(languages, *_logs(ordered[0], languages), _logs_by_length(ordered[1], languages))


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, lang_pred, score): the columns ``keep`` (all by default) as a struct with the prediction for the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(shared.value)
        for batch in batches:
            found = predictor.many(batch.column("text").to_pylist())
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *columns], names=["row", "lang_pred", "score"])
        text_words.give_back()

    kept = F.struct("*") if keep is None else F.struct(*[f"`{c}`" for c in keep])
    chosen = docs.select(kept.alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    return chosen.mapInArrow(scan, chosen.select("row", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema)
