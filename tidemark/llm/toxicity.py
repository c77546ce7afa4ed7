"""Toxicity of documents by multiple-instance learning over their sentences.

Method: a sentence has probability p = sigmoid(sum of its words' weights + bias),
and a document is toxic if any sentence is: 1 - prod(1 - p), noisy-or. Weights are
trained from labels of documents alone; afterwards the sentences with a high p
are the offending ones. A word's weight is that of the word and of its beginnings
of 3 to 6 bytes, so unseen endings of a known stem count.

The model is fitted in the driver on at most `positives` + `negatives` labelled
texts of at most `most_bytes` a label and has a fixed number of weights; every document is scored whole, in
one pass without a shuffle.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.hashing import PLAIN_WORDS, mixed, prefix_sums, runs
from tidemark.llm.shared import examples, held_out, parts, shipped, text_facts
from tidemark.operators.joins import join_grouped

POSITIVES, NEGATIVES = 2000, 4000
MOST_BYTES = 32 << 20  # of texts with one label
WEIGHTS = 1 << 18
THRESHOLD = 0.3
OFFENDING = 0.1
ROUNDS = 60
PART_BYTES = 4 << 20
PIECE = 1 << 20
FORMS = 5  # of a word: itself, and its beginnings of 3 to 6 bytes
# As PLAIN_WORDS, with the ends of sentences kept apart.
_END = 1
_SENTENCES = bytes(_END if chr(c) in ".!?\n" else PLAIN_WORDS[c] for c in range(256))
SCORED = (
    "score double, n_sentences long, "
    "offending array<struct<sentence:long,first_word:long,n_words:long,score:double>>"
)


@dataclass
class _Words:
    """Words in order: their hashes, places of the weights of their forms, sentences and texts by number."""

    hashes: np.ndarray
    places: np.ndarray  # a row per form; WEIGHTS where a word is too short for it
    sentence: np.ndarray
    text: np.ndarray


def _words(texts: list[bytes]) -> Iterator[_Words]:
    """The words of texts, about PIECE bytes at a time; a sentence may go on in the next piece.

    Sentences are numbered through all texts, those without words included.
    """
    raw = np.frombuffer(b".".join([*texts, b""]).translate(_SENTENCES), np.uint8)
    bounds = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    a = before = 0
    while a < len(raw):
        b = min(a + PIECE, len(raw))
        while b < len(raw) and raw[b - 1] > 32:  # pieces end behind a gap
            gaps = np.flatnonzero(raw[a:b] <= 32)
            b = a + int(gaps[-1]) + 1 if len(gaps) else min(b + PIECE, len(raw))
        piece = raw[a:b]
        edges = np.flatnonzero(np.diff(piece > 32, prepend=False))
        first, last = edges[::2], edges[1::2]
        sums, back = prefix_sums(piece)
        places = np.full((FORMS, len(first)), WEIGHTS, np.int32)
        whole = mixed((sums[last] - sums[first]) * back[first])
        places[0] = whole % np.uint64(WEIGHTS)
        for form, n in enumerate(range(3, 7), 1):
            long = np.flatnonzero(last - first >= n)
            start = first[long]
            places[form, long] = mixed((sums[start + n] - sums[start]) * back[start], n) % np.uint64(WEIGHTS)
        ends = np.flatnonzero(piece == _END)
        sentence = before + np.searchsorted(ends, first)
        yield _Words(whole, places, sentence, np.searchsorted(bounds, a + first, "right"))
        a, before = b, before + len(ends)


@dataclass
class Model:
    weights: np.ndarray
    bias: float


def _sentences(texts: list[bytes], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, word count and summed weights of each sentence that has words; `weights` end with a 0 for no form."""
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    for words in _words(texts):
        if len(words.hashes):
            new = np.flatnonzero(runs(words.sentence))
            sums = np.add.reduceat(weights[words.places].sum(axis=0), new)
            found.append((words.sentence[new], words.text[new], np.diff(np.append(new, len(words.hashes))), sums))
    sentence, text, sizes, sums = map(np.concatenate, zip(*found))
    new = np.flatnonzero(runs(sentence))  # a sentence that two pieces share is one
    if not len(new):
        return text, sizes, sums
    return text[new], np.add.reduceat(sizes, new), np.add.reduceat(sums, new)


def fit(examples: list[tuple[str | None, int, float]], rounds: int = ROUNDS) -> Model:
    """Weights from (text, label 0 or 1, weight) of documents; none of a kind gives a model that scores 0."""
    labels = np.array([label for _, label, _ in examples], float)
    importance = np.array([weight for *_, weight in examples], float)
    if not len(examples) or labels.min() == labels.max():
        return Model(np.zeros(WEIGHTS), -np.inf)
    # Each word by number, for each word its sentence, for each sentence its document.
    hashes, sentences, texts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    known_hashes, known_places = [np.empty(0, np.uint64)], [np.empty((FORMS, 0), np.int32)]
    bodies, before = [(text or "").encode() for text, _, _ in examples], 0
    for a, b in parts(bodies, PART_BYTES):
        for own in _words(bodies[a:b]):
            distinct, at = np.unique(own.hashes, return_index=True)
            known_hashes.append(distinct)
            known_places.append(own.places[:, at])
            hashes.append(own.hashes)
            sentences.append(own.sentence + before)
            texts.append((own.text + a).astype(np.int32))
        before += sum(len(re.findall(rb"[.!?\n]", body)) + 1 for body in bodies[a:b])
    distinct, at = np.unique(np.concatenate(known_hashes), return_index=True)
    forms = np.concatenate(known_places, axis=1)[:, at].T
    n_words = len(distinct)
    words = np.concatenate([np.searchsorted(distinct, own).astype(np.int32) for own in hashes])
    del hashes, known_hashes, known_places, bodies
    new = runs(np.concatenate(sentences))
    sentence_of = np.cumsum(new, dtype=np.int32) - 1
    doc_of = np.concatenate(texts)[new]
    n_sentences = len(doc_of)
    held = forms < WEIGHTS
    places, of_word = forms[held], np.repeat(np.arange(n_words, dtype=np.int32), held.sum(axis=1))
    del sentences, texts, forms, held
    # Start from how much more often documents with label 1 have a feature.
    pairs = np.sort(doc_of[sentence_of].astype(np.int64) * n_words + words)
    pairs = pairs[runs(pairs)]
    docs, types = pairs // n_words, pairs % n_words
    counts = []
    for label in (1, 0):
        own = np.bincount(types[labels[docs] == label], minlength=n_words)
        counts.append(np.bincount(places, own[of_word], minlength=WEIGHTS))
    del pairs, docs, types
    total = [max(float((labels == label).sum()), 1.0) for label in (1, 0)]
    odds = np.log((counts[0] + 0.5) / total[0]) - np.log((counts[1] + 0.5) / total[1])
    known = counts[0] + counts[1] >= 3
    weights = np.where(known & (odds > 2) & (counts[0] >= 3), np.minimum(odds, 4.0), 0.0)
    bias = -7.0
    # Adam on the weighted log loss of the noisy-or.
    first, second, b_first, b_second = np.zeros(WEIGHTS), np.zeros(WEIGHTS), 0.0, 0.0
    for step in range(1, rounds + 1):
        by_word = np.bincount(of_word, weights[places], minlength=n_words)
        logit = np.bincount(sentence_of, by_word[words], minlength=n_sentences) + bias
        soft = np.logaddexp(0.0, logit)
        none = np.bincount(doc_of, soft, minlength=len(examples))  # -log(1 - P)
        # d loss / d none: 1 for label 0, and -(1 - P) / P for label 1.
        slope = np.where(labels > 0, -1.0 / np.maximum(np.expm1(np.minimum(none, 500)), 1e-9), 1.0)
        g = (importance * np.maximum(slope, -1e3))[doc_of] * np.exp(logit - soft)
        norm = importance.sum()
        g_word = np.bincount(words, g[sentence_of], minlength=n_words)
        gradient = np.where(known, np.bincount(places, g_word[of_word], minlength=WEIGHTS) / norm, 0.0) + 1e-5 * weights
        g_bias = g.sum() / norm
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        b_first, b_second = 0.9 * b_first + 0.1 * g_bias, 0.99 * b_second + 0.01 * g_bias**2
        rate = 0.05 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        weights = weights - rate * first / (np.sqrt(second) + 1e-7)
        bias -= rate * b_first / (np.sqrt(b_second) + 1e-7)
    return Model(weights, float(bias))


def train(
    docs: DataFrame,
    labels: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    label: str = "toxic",
    most_bytes: int = MOST_BYTES,
) -> Model:
    """A model from labels (doc_id, `label` 0 or 1) of documents that are not held out.

    Takes at most `positives` and `negatives` texts and `most_bytes` of each kind,
    those whose id and text hash lowest, and none of over a sixteenth of
    `most_bytes`; the two kinds are weighed to their share of all labelled texts.
    Equal rows of one id are one text. A document with several labels has the
    largest; null labels and null ids do not count.
    """
    own = labels.select("doc_id", F.col(label).cast("int").alias("y"))
    own = own.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("y").isin(0, 1))
    own = own.groupBy("doc_id").agg(F.max("y").alias("y"))
    facts = text_facts(docs).select("doc_id", "digest", "size").distinct()
    marked = join_grouped(facts, own, ["doc_id"]).select("l.*", "y")
    most = F.when(F.col("y") == 1, positives).otherwise(negatives)
    rows, totals = examples(docs, marked, "y", 2, most, most_bytes, seed=5)
    taken = {y: sum(r["y"] == y for r in rows) for y in (0, 1)}
    return fit([(r["text"], r["y"], totals[r["y"]] / taken[r["y"]]) for r in rows])


def scored(docs: DataFrame, model: Model, keep: Sequence[str] | None = None, text: str = "text") -> DataFrame:
    """The columns `keep` (all by default) with score (0 to 1), n_sentences and offending sentences.

    One row per input row. Sentences end at . ! ? and line ends; those without a
    word do not count. The offending ones, with a score of at least OFFENDING,
    carry their number among all sentences, their first word in the document and
    their number of words, from 0. Null and empty texts have score 0. Kept columns
    of the new names are replaced.
    """
    shared = shipped(docs.sparkSession, model)
    new = T.StructType.fromDDL(SCORED)
    names = [c for c in (docs.columns if keep is None else keep) if c not in new.names]
    own_name = f"_text_{uuid.uuid4().hex}"
    schema = T.StructType([*docs.select(*names).schema.fields, *new.fields])
    sentence = pa.struct(
        [("sentence", pa.int64()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("score", pa.float64())]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared()
        weights, bias = np.append(model.weights, 0.0), model.bias
        for batch in batches:
            bodies = [t or b"" for t in batch.column(own_name).cast(pa.binary()).to_pylist()]
            for a, b in parts(bodies, PART_BYTES):
                doc, sizes, sums = _sentences(bodies[a:b], weights)
                logit = sums + bias
                soft = np.logaddexp(0.0, logit)
                none = np.bincount(doc, soft, minlength=b - a)
                bad = np.flatnonzero(logit - soft >= np.log(OFFENDING))
                first_sentence = np.searchsorted(doc, np.arange(b - a))
                word_at = np.cumsum(sizes) - sizes
                found: list[list[dict]] = [[] for _ in range(b - a)]
                for s in bad.tolist():
                    d, lead = int(doc[s]), int(first_sentence[doc[s]])
                    found[d].append(
                        {
                            "sentence": s - lead,
                            "first_word": int(word_at[s] - word_at[lead]),
                            "n_words": int(sizes[s]),
                            "score": float(np.exp(logit[s] - soft[s])),
                        }
                    )
                yield pa.RecordBatch.from_pydict(
                    {
                        **{name: batch.column(name).slice(a, b - a) for name in names},
                        "score": pa.array(-np.expm1(-none)),
                        "n_sentences": pa.array(np.bincount(doc, minlength=b - a), pa.int64()),
                        "offending": pa.array(found, pa.list_(sentence)),
                    }
                )

    return docs.select(*names, F.col(text).cast("string").alias(own_name)).mapInArrow(score, schema)
