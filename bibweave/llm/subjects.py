"""Problem 8: the subject areas of each document.

Method: subject-specific n-gram language models.  P(word | word before) of each
subject interpolates its bigrams, its unigrams and a background model of all
subjects, each the more the less its context was seen; the weights are those
under which the labelled examples are most probable.  A sentence has, for each subject, the gain per token of that model's
cross-entropy over the background's, and is about the best subject if the gain
is over a threshold, calibrated per subject on the labelled examples.  A second
subject of the sentence is accepted by its own threshold if it gains at least
half as much.  A document has every subject that carries at least ``share`` of
its subject-bearing text.

Words and bigrams of which no subject has most are pruned: for them the
background stands in for every subject, so neither frames of sentences nor a
language in which one subject is written about more often tell anything.

The seed models are fitted on the labelled examples.  They are refitted on all
documents that a model finds to be about one subject: n-grams are counted over
the whole corpus, combined in the tasks before they are shuffled, and n-grams
that make up a fixed fraction of all counts are kept, so the model that is sent
to the tasks is bounded whatever the corpus.  The examples are then held out:
the refitted counts don't contain them.

Two further models of the same kind tell remarks in passing from the text's own
matter: one of lone sentences about a subject that the rest of their document
isn't about ("the word is borrowed from ..."), and one of sentences about their
document's subject.  They are fitted in the same pass, without labels; a sentence
that the first predicts clearly better carries no subject.

Defined results: null, blank and content-free documents have no row; ids that
occur twice give one row per subject; texts are read whole; an empty set of
examples gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.session import cut_lineage

SENTENCE = re.compile(r"(?<=[.!?。！？])\s*|\n+")
RUN = re.compile(r"[぀-ヿ一-鿿]+|[^\W\d_]+")
PLAIN = re.compile(r"[a-z]+")
KANA_KANJI = re.compile(r"[぀-ヿ一-鿿]")
BEGIN, OTHER = 0, 1  # ids of a sentence's begin and of words that the models don't know


@dataclass(frozen=True)
class Settings:
    max_examples: int = 5_000  # bound of the labelled sample
    rounds: int = 1  # a second one changes next to nothing: 3 of 11 000 labels at sf0.1
    seed_gain: float = 0.03  # threshold of the seed models, which have no examples left to calibrate it on
    share: float = 0.2
    pure: float = 0.75  # a document teaches a subject if so much of its subject-bearing text carries it
    passing: float = 2.0  # nats by which the model of remarks in passing must predict a sentence better
    fraction: float = 4e-7  # least share of an n-gram in all counts
    few: int = 5_000  # words of a subject below which the examples stay part of the counts, and nothing is left to calibrate on
    max_model_mb: int = 200
    chunk: int = 2_000_000  # characters that are scored at once


def tokens(sentence: str) -> list[str]:
    """Words of a folded sentence; overlapping character pairs of Japanese."""
    if sentence.isascii():
        return PLAIN.findall(sentence)
    out: list[str] = []
    for w in RUN.findall(sentence):
        if KANA_KANJI.match(w):
            out += [w[i : i + 2] for i in range(len(w) - 1)] or [w]
        else:
            out.append(w)
    return out


def sentences(text: str | None) -> list[tuple[int, list[str]]]:
    """(characters, words) of each sentence that has words."""
    folded = (text or "").casefold()
    if not folded.isascii():
        folded = unicodedata.normalize("NFKC", folded)
    return [(len(s), w) for s in SENTENCE.split(folded) if (w := tokens(s))]


def _segment_sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums over consecutive runs of rows."""
    return np.add.reduceat(values, np.concatenate(([0], np.cumsum(sizes)[:-1])), axis=0)


class NgramModels:
    """Interpolated bigram models of several labels, their background, and the thresholds of the subjects.

    ``counts``: (word before, word) -> counts per label.
    ``labels``: the first ``k`` are subjects, then remarks in passing and the document's own matter.
    The more often a label's context was seen, the more its own counts weigh: n / (n + mu).
    """

    def __init__(self, subjects: list[str], counts: dict[tuple[str, str], np.ndarray], skew: float = 0.6):
        self.subjects, self.k = subjects, len(subjects)
        k = self.k
        self.skew = skew if k > 2 else 0.5
        self.thresholds = np.full(k, 0.05)
        words = sorted({w for _, w in counts})
        self.vocabulary = {w: n for n, w in enumerate(words, 2)}
        m = k + 2
        self.uni, seen = np.zeros((len(words) + 2, m), np.float32), []
        for (before, word), c in counts.items():
            self.uni[self.vocabulary[word]] += c
            seen.append((self.vocabulary.get(before, BEGIN) << 32 | self.vocabulary[word], c))
        seen.sort(key=lambda x: x[0])
        self.codes = np.array([c for c, _ in seen], np.int64)
        self.bi = np.array([c for _, c in seen], np.float32) if seen else np.zeros((0, m), np.float32)
        self.context = np.zeros((len(words) + 2, m), np.float32)
        np.add.at(self.context, self.codes >> 32, self.bi)
        self.total = np.maximum(self.uni.sum(axis=0), 1.0)
        self.fit(300.0, 5.0)

    def fit(self, mu_uni: float, mu_bi: float) -> None:
        """Set the weights. The background weighs all subjects alike, however many texts they have."""
        k = self.k
        self.mu = mu_uni, mu_bi
        live = self.total[:k] > 1.0
        shares = self.uni[:, :k] / self.total[:k]
        background = shares[:, live].mean(axis=1) if live.any() else shares.sum(axis=1)
        self.background = (background + 0.5 / (len(self.uni) * max(2.0, float(self.total[:k].sum())))).astype(np.float32)
        flat, flat_two = self._flat()
        own = self.total / (self.total + mu_uni)
        self.one = (own * self.uni / self.total + (1 - own) * self.background[:, None]).astype(np.float32)
        self.one[flat, :k] = self.background[flat, None]
        held = self.context / (self.context + mu_bi)
        self.held = held.astype(np.float32)
        before = self.codes >> 32
        self.two = (held[before] * self.bi / np.maximum(self.context[before], 1.0)).astype(np.float32)
        # The background's bigrams are those of the average subject.
        self.held_b = held[:, :k].mean(axis=1).astype(np.float32)
        self.two[flat_two, :k] = self.two[flat_two, :k].mean(axis=1, keepdims=True)
        self.held[:, :k] = self.held_b[:, None]
        self.two_b = self.two[:, :k].mean(axis=1)

    def _flat(self) -> tuple[np.ndarray, np.ndarray]:
        """Pruning: words and bigrams of which no subject has most; they tell nothing, and the background is taken for all subjects."""
        out = []
        for counts in (self.uni, self.bi):
            share = counts[:, : self.k] / self.total[: self.k] + 1e-12
            out.append(share.max(axis=1) < self.skew * share.sum(axis=1))
        return out[0], out[1]

    @property
    def nbytes(self) -> int:
        return sum(a.nbytes for a in (self.uni, self.bi, self.codes, self.context, self.one, self.two, self.held)) + 100 * len(self.vocabulary)

    def ids(self, parts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, word before, words per sentence) as ids."""
        get = self.vocabulary.get
        word = np.array([get(w, OTHER) for p in parts for w in p], np.int64)
        sizes = np.array([len(p) for p in parts])
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[np.concatenate(([0], np.cumsum(sizes)[:-1]))] = BEGIN
        return word, before, sizes

    def log_p(self, word: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ln P(word | before) of each label, and of the background."""
        code = before << 32 | word
        at = np.searchsorted(self.codes, code)
        at[at == len(self.codes)] = 0
        known = np.flatnonzero(self.codes[at] == code) if len(self.codes) else np.zeros(0, np.int64)
        p = (1 - self.held[before]) * self.one[word]
        b = (1 - self.held_b[before]) * self.background[word]
        p[known] += self.two[at[known]]
        b[known] += self.two_b[at[known]]
        return np.log(np.maximum(p, 1e-12)), np.log(np.maximum(b, 1e-12))

    def gains(self, parts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Gain per token of each subject over the background, and nats by which a sentence is rather one in passing."""
        word, before, sizes = self.ids(parts)
        p, b = self.log_p(word, before)
        ratio = p - b[:, None]
        ratio[word == OTHER] = 0  # words that no model knows
        sums = _segment_sums(ratio, sizes)
        return sums[:, : self.k] / sizes[:, None], sums[:, self.k] - sums[:, self.k + 1]

    def fit_weights(self, labelled: list[tuple[int, list[str]]]) -> None:
        """The weights under which labelled sentences that the counts don't contain are most probable."""
        word, before, sizes = self.ids([w for _, w in labelled])
        label = np.repeat([n for n, _ in labelled], sizes)
        here = np.flatnonzero(word != OTHER)

        def likelihood(mu: tuple[float, float]) -> float:
            self.fit(*mu)
            return float(self.log_p(word, before)[0][here, label[here]].sum())

        self.fit(*max(((u, v) for u in (100.0, 300.0, 1_000.0) for v in (5.0, 20.0, 80.0)), key=likelihood))

    def calibrate(self, labelled: list[tuple[int, list[str]]]) -> None:
        """Each subject's threshold: the gain above which most labelled sentences are right, less those that are wrong."""
        gain, _ = self.gains([w for _, w in labelled])
        label = np.array([n for n, _ in labelled])
        best, top = gain.argmax(axis=1), gain.max(axis=1)
        for s in range(self.k):
            mine = best == s
            order = np.argsort(-top[mine], kind="stable")
            right = np.cumsum(np.where(label[mine][order] == s, 1, -1))
            if len(right):
                self.thresholds[s] = max(0.02, top[mine][order][: int(right.argmax()) + 1].min() if right.max() > 0 else top[mine].max())

    def subjects_of(self, parts: list[list[str]], passing: float | None) -> list[list[int]]:
        """Subjects of each sentence, the best first."""
        gain, aside = self.gains(parts)
        ok = gain >= self.thresholds
        if passing is not None:
            ok &= (aside <= passing)[:, None]
        order = np.argsort(-gain, axis=1, kind="stable")[:, :2]
        out = []
        for row, (a, b) in enumerate(order.tolist() if self.k > 1 else [(0, 0)] * len(gain)):
            found = [a] if ok[row, a] else []
            if found and b != a and ok[row, b] and gain[row, b] >= 0.5 * gain[row, a]:
                found.append(b)
            out.append(found)
        return out


def _chunks(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[list[tuple[int | None, list[tuple[int, list[str]]]]]]:
    """Documents as (id, sentences), so many characters at a time."""
    held, size = [], 0
    for batch in batches:
        ids = batch.column("doc_id").to_pylist() if "doc_id" in batch.schema.names else [None] * batch.num_rows
        for d, text in zip(ids, batch.column("text").to_pylist()):
            parts = sentences(text)
            if parts:
                held.append((d, parts))
                size += len(text)
            if size >= chunk:
                yield held
                held, size = [], 0
    if held:
        yield held


def _labelled(docs: list, models: NgramModels, passing: float | None) -> Iterator[tuple[int | None, list[tuple[int, list[str]]], list[list[int]], dict[int, float]]]:
    """(id, sentences, subjects of each, characters of each subject) of documents that are scored together."""
    found = iter(models.subjects_of([w for _, parts in docs for _, w in parts], passing))
    for d, parts in docs:
        own = [next(found) for _ in parts]
        size: dict[int, float] = {}
        for (n, _), named in zip(parts, own):
            for s in named:
                size[s] = size.get(s, 0) + n / len(named)
        yield d, parts, own, size


def train(documents: DataFrame, text_col: str, examples: DataFrame, subject_col: str, example_col: str, settings: Settings = Settings()) -> NgramModels | None:
    spark = documents.sparkSession
    rows = examples.select(F.col(subject_col).alias("s"), F.col(example_col).alias("t")).where("s IS NOT NULL AND t IS NOT NULL").orderBy(F.xxhash64("t")).limit(settings.max_examples).collect()
    subjects = sorted({r.s for r in rows})
    if not subjects:
        return None
    k = len(subjects)
    labelled = [(subjects.index(r.s), w) for r in rows for _, w in sentences(r.t)]
    if not labelled:
        return None
    seed: dict[tuple[str, str], np.ndarray] = {}
    for label, w in labelled:
        for pair in zip(("^", *w), w):
            seed.setdefault(pair, np.zeros(k + 2))[label] += 1
    models = NgramModels(subjects, seed)
    models.thresholds[:] = settings.seed_gain
    texts = documents.select(F.col(text_col).alias("text")).where(F.col("text").rlike(r"\S"))

    for n in range(settings.rounds):
        held = spark.sparkContext.broadcast(models)
        passing = settings.passing if n else None

        def count(batches: Iterator[pa.RecordBatch], held=held, passing=passing) -> Iterator[pa.RecordBatch]:
            model = held.value
            tallies = [Counter() for _ in range(k + 2)]

            def flush() -> pa.RecordBatch:
                keys = [(b, w, s, c) for s, t in enumerate(tallies) for (b, w), c in t.items()]
                for t in tallies:
                    t.clear()
                kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
                return pa.RecordBatch.from_arrays([pa.array([x[i] for x in keys], kind) for i, kind in enumerate(kinds)], names=["before", "word", "label", "n"])

            def add(label: int, words: list[str]) -> None:
                tallies[label].update(zip(("^", *words), words))

            for docs in _chunks(batches, settings.chunk):
                for _, parts, own, size in _labelled(docs, model, passing):
                    whole = sum(size.values())
                    if not whole:
                        continue
                    main = max(size, key=lambda s: (size[s], -s))
                    pure = size[main] >= settings.pure * whole
                    if pure:
                        for _, w in parts:
                            add(main, w)
                    if pure or passing is None:  # a seed model takes remarks in passing for a second subject, so these texts teach what such remarks look like
                        alone = Counter(s for named in own for s in named)
                        for (_, w), named in zip(parts, own):
                            if named:
                                add(k if named[0] != main and alone[named[0]] == 1 else k + 1, w)
                if sum(map(len, tallies)) > 400_000:
                    yield flush()
            yield flush()

        gram = ("before", "word")
        counted = texts.mapInArrow(count, "before string, word string, label int, n long").groupBy(*gram, "label").agg(F.sum("n").alias("n"))
        by_gram = cut_lineage(counted.groupBy(*gram).agg(F.collect_list(F.struct("label", "n")).alias("by"), F.sum("n").alias("n")))  # at most one entry per label
        whole = by_gram.agg(F.sum("n")).first()[0] or 0
        least = max(2, math.ceil(settings.fraction * whole))
        counts: dict[tuple[str, str], np.ndarray] = {}
        for r in by_gram.where(F.col("n") >= least).toLocalIterator():  # bounded: at most 1 / fraction rows
            c = counts.setdefault((r.before, r.word), np.zeros(k + 2))
            for b in r.by:
                c[b.label] += b.n
        few = not counts or sum(c[:k] for c in counts.values()).min() < settings.few
        if few:  # too few documents of a subject to learn from alone
            for pair, c in seed.items():
                counts[pair] = counts.get(pair, 0) + c
        models = NgramModels(subjects, counts)
        if not few:
            models.fit_weights(labelled)
            models.calibrate(labelled)
        if models.nbytes > settings.max_model_mb << 20:
            raise ValueError("the models outgrow max_model_mb; raise Settings.fraction")
    return models


def subjects_of(documents: DataFrame, id_col: str, text_col: str, examples: DataFrame, subject_col: str, example_col: str, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, subject, share) of each document and subject that carries enough of it."""
    models = train(documents, text_col, examples, subject_col, example_col, settings)
    schema = "doc_id long, subject string, share double"
    spark = documents.sparkSession
    if models is None:
        return spark.createDataFrame([], schema)
    held = spark.sparkContext.broadcast(models)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for docs in _chunks(batches, settings.chunk):
            rows = [(d, model.subjects[s], n / sum(size.values())) for d, _, _, size in _labelled(docs, model, settings.passing) for s, n in sorted(size.items()) if n >= settings.share * sum(size.values())]
            kinds = (pa.int64(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["doc_id", "subject", "share"])

    texts = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where(F.col("doc_id").isNotNull() & F.col("text").rlike(r"\S"))
    return texts.mapInArrow(label, schema).groupBy("doc_id", "subject").agg(F.max("share").alias("share"))
