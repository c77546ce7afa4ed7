"""Language of documents in two steps: the family, then the language within it.

Method: hierarchical discrimination. A one-versus-rest linear classifier picks
the language family; within it, linear support vector machines for every two
languages vote. Features are shares of hashed letter trigrams of the whole
lower-cased text, so long texts count like short ones.

The machines are fitted in the driver on at most `per_language` texts of each of
the `languages` most frequent languages and have a fixed number of weights; every document is classified in one
pass without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import examples, parts, shipped, text_facts

PER_LANGUAGE = 500
WEIGHTS = 1 << 16
MOST_BYTES = 4 << 20  # of texts of one language
LANGUAGES = 64
ROUNDS = 80
PART_BYTES = 1 << 18  # of text that a task works on at a time
UNDETERMINED = "und"
# Language families by ISO 639-1 code. A language not listed is a family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fy", "is", "lb", "nl", "nn", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "celtic": ["br", "cy", "ga", "gd"],
    "baltic": ["lt", "lv"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "ky", "tr", "uz"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}
_LETTER = re.compile(r"[^\W\d_]")
# ASCII letters and all other bytes of letters beyond ASCII stay; the rest are gaps.
_KEEP = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
PREDICTED = "doc_id long, lang_pred string, score double, family string"


def family_of(language: str) -> str:
    return _FAMILY.get(language.lower(), language)


def _plain(text: str) -> bytes:
    """Lower-cased words with one gap around each."""
    return b" " + b" ".join(text.lower().encode().translate(_KEEP).split()) + b" "


def _trigrams(raw: bytes) -> np.ndarray:
    """Hashed place of each three bytes."""
    a = np.frombuffer(raw, np.uint8).astype(np.uint32)
    value = (a[:-2] << np.uint32(16)) | (a[1:-1] << np.uint32(8)) | a[2:]
    return (value * np.uint32(2654435761)) >> np.uint32(16)


@dataclass
class Model:
    languages: dict[str, list[str]] = field(default_factory=dict)  # by family
    families: dict[str, tuple[np.ndarray, float]] = field(default_factory=dict)
    pairs: dict[tuple[str, str], tuple[np.ndarray, float]] = field(default_factory=dict)


def _machine(place: np.ndarray, doc: np.ndarray, share: np.ndarray, sign: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear support vector machine (squared hinge loss, both sides weighed alike)."""
    n = len(sign)
    cost = np.where(sign > 0, 0.5 / max((sign > 0).sum(), 1), 0.5 / max((sign < 0).sum(), 1))
    weights, bias = np.zeros(WEIGHTS), 0.0
    first, second, b_first, b_second = np.zeros(WEIGHTS), np.zeros(WEIGHTS), 0.0, 0.0
    for step in range(1, ROUNDS + 1):
        margin = sign * (np.bincount(doc, share * weights[place], minlength=n) + bias)
        g = -cost * sign * 2 * np.maximum(1 - margin, 0)
        gradient, g_bias = np.bincount(place, share * g[doc], minlength=WEIGHTS) + 1e-7 * weights, g.sum()
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        b_first, b_second = 0.9 * b_first + 0.1 * g_bias, 0.99 * b_second + 0.01 * g_bias**2
        rate = 2.0 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        weights = weights - rate * first / (np.sqrt(second) + 1e-9)
        bias -= 0.05 * rate * b_first / (np.sqrt(b_second) + 1e-9)
    return weights.astype(np.float32), float(bias)


def fit(examples: list[tuple[str, str]]) -> Model:
    """A model from (text, language); texts without letters teach nothing."""
    examples = [(text, language) for text, language in examples if _LETTER.search(text)]
    places, docs, shares = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
    for doc, (text, _) in enumerate(examples):
        found = _trigrams(_plain(text))
        counts = np.bincount(found, minlength=WEIGHTS)
        place = np.flatnonzero(counts)
        places.append(place)
        docs.append(np.full(len(place), doc))
        shares.append(counts[place] / max(len(found), 1))
    place, doc, share = np.concatenate(places), np.concatenate(docs), np.concatenate(shares)
    language = np.array([name for _, name in examples], object)
    family = np.array([family_of(name) for _, name in examples], object)
    model = Model()
    for name in sorted(set(language)):
        model.languages.setdefault(family_of(name), []).append(name)
    if len(model.languages) > 1:
        for name in sorted(model.languages):
            model.families[name] = _machine(place, doc, share, np.where(family == name, 1.0, -1.0))
    for names in model.languages.values():
        for one, other in combinations(names, 2):
            chosen = (language == one) | (language == other)
            number = np.cumsum(chosen) - 1
            held = chosen[doc]
            sign = np.where(language[chosen] == one, 1.0, -1.0)
            model.pairs[one, other] = _machine(place[held], number[doc[held]], share[held], sign)
    return model


def train(
    docs: DataFrame, per_language: int = PER_LANGUAGE, most_bytes: int = MOST_BYTES, languages: int = LANGUAGES
) -> Model:
    """A model from text and non-null lang of documents that are not held out.

    Takes of each of the `languages` most frequent languages at most `per_language`
    texts and `most_bytes` bytes, those whose id and text hash lowest, and none of
    over a sixteenth of `most_bytes`. Rarer languages are not learned. Equal rows
    of one id and language are one text; null ids and texts do not count.
    """
    facts = text_facts(docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()), "lang")
    marked = facts.select("doc_id", "digest", "size", "lang").distinct()
    rows, _ = examples(docs, marked, "lang", languages, F.lit(per_language), most_bytes, seed=8)
    return fit([(r["text"], r["lang"]) for r in rows])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


class _Classifier:
    def __init__(self, model: Model):
        self.model = model
        self.machines = [*model.families.values(), *model.pairs.values()]

    def __call__(self, texts: list[str]) -> tuple[list[str], np.ndarray, list[str]]:
        """Language, score and family of texts that have letters."""
        raw = [_plain(text) for text in texts]
        starts = np.cumsum([0, *map(len, raw)])[:-1]
        place = _trigrams(b"".join(raw))
        # Trigrams of each text alone: the last two of each range reach into the next text.
        sizes = np.array([len(r) - 2 for r in raw])
        margins = []
        for weights, bias in self.machines:
            sums = np.concatenate([[0.0], np.cumsum(weights[place], dtype=np.float64)])
            margins.append((sums[starts + sizes] - sums[starts]) / sizes + bias)
        n_families = len(self.model.families)
        names = sorted(self.model.languages)
        if n_families:
            values = np.array(margins[:n_families]) * 2
            odds = np.exp(values - values.max(axis=0))
            odds /= odds.sum(axis=0)
            family, sure = odds.argmax(axis=0), odds.max(axis=0)
        else:
            family, sure = np.zeros(len(texts), int), np.ones(len(texts))
        pairs = dict(zip(self.model.pairs, margins[n_families:]))
        languages, scores = np.empty(len(texts), object), sure.copy()
        for number, name in enumerate(names):
            own = self.model.languages[name]
            here = np.flatnonzero(family == number)
            if not len(here):
                continue
            votes, trust = np.zeros((len(own), len(here))), np.zeros((len(own), len(here)))
            for i, j in combinations(range(len(own)), 2):
                margin = pairs[own[i], own[j]][here]
                votes[i] += margin >= 0
                votes[j] += margin < 0
                trust[i] += _sigmoid(2 * margin)
                trust[j] += _sigmoid(-2 * margin)
            best = (votes + trust / (len(own) + 1)).argmax(axis=0)
            languages[here] = np.array(own, object)[best]
            if len(own) > 1:
                scores[here] *= trust[best, np.arange(len(here))] / (len(own) - 1)
        return languages.tolist(), scores, [names[f] for f in family]


def _classified(batch: pa.RecordBatch, classifier: _Classifier) -> pa.RecordBatch:
    """Predictions of a batch of (doc_id, text), whose texts become Python strings part by part."""
    languages, scores, families = [], [], []
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
    for a, b in parts([range(s) for s in sizes], PART_BYTES):
        own = [t or "" for t in batch.column("text").slice(a, b - a).to_pylist()]
        lettered = [i for i, t in enumerate(own) if classifier.model.languages and _LETTER.search(t)]
        name, score, family = [UNDETERMINED] * (b - a), np.zeros(b - a), [None] * (b - a)
        if lettered:
            found = classifier([own[i] for i in lettered])
            score[lettered] = found[1]
            for i, one, kind in zip(lettered, found[0], found[2]):
                name[i], family[i] = one, kind
        languages += name
        scores.append(score)
        families += family
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": batch.column("doc_id"),
            "lang_pred": pa.array(languages, pa.string()),
            "score": pa.array(np.concatenate([np.empty(0), *scores])),
            "family": pa.array(families, pa.string()),
        }
    )


def predicted(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score (0 to 1), family.

    A null or empty text and one without letters is `und` with score 0 and no
    family; so is every text where the model has learned no language. Other
    columns are not looked at.
    """
    shared = shipped(docs.sparkSession, model)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = _Classifier(shared())
        for batch in batches:
            yield _classified(batch, classifier)

    return texts.mapInArrow(classify, PREDICTED)
