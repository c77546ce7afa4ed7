"""Phrases whose words keep together, per language.

Method: counting quotient filters. A word's id is a 64-bit hash of language and
word that is checked to be one to one on all frequent words. Tasks pack the ids
of an n-gram, permute the packed number (see quotient_filter.py) and count keys
in filters; a filter is cut into shards by quotient, and the shards of all tasks
are merged by Spark. Keys come back from the merged filters exactly.

n-grams are counted level by level: one of k words is frequent only if both its
parts of k - 1 words are, so tasks leave out those with a part that a Bloom
filter of the frequent ones does not know. What such a filter passes in error is
counted like the rest and found infrequent. No task holds a table of all words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import bloom
from tidemark.llm.hashing import mixed, word_hashes
from tidemark.llm.quotient_filter import Filter, permuted, restored
from tidemark.llm.shared import parts, shipped, written
from tidemark.operators.joins import join_grouped

LONGEST = 3
MIN_COUNT = 10
COVERED = 50  # percent of a phrase's places that a longer one may not reach
TOP = 2000
NO_LANG = "und"
PART_BYTES = 2 << 20  # of text that a task works on at a time
WORDS_HELD = 1 << 19  # distinct words that a task counts before it passes them on
KEYS_HELD = 1 << 21  # n-grams that a task gathers before it sorts them
SHARD_KEYS = 1 << 20  # places of n-grams per shard of the filters
LEAST_SHARDS = 256
RANK_PARTS = 64
ROWS = 64  # shards that a task passes on at a time
SEEDS = 8
# A-Z to a-z, ends of pieces to \n; words of a piece lie between spaces and tabs.
_ENDS = b".,;:!?\n\x0b\x0c\r"
PIECES = bytes(10 if c in _ENDS else c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACES = b" \t\n\x0b\x0c\r"
WORDS = "lang string, word binary, n long"
SHARDS = "shard int, payload binary"


@dataclass(frozen=True)
class Phrases:
    """Frequent n-grams by their number of words: columns w1 to wk (ids), h (a hash of them) and n.

    `words` has id, lang, word and n of the frequent words, `totals` lang and n, the number of all its words.
    """

    words: DataFrame
    totals: DataFrame
    grams: dict[int, DataFrame] = field(default_factory=dict)


def _spelling(seed: int) -> bytes:
    """PIECES, and for other seeds than 0 other letters, so that other words share a hash."""
    letters = [c for c in range(256) if c not in _SPACES]
    turned = dict(zip(letters, letters[31 * seed % len(letters) :] + letters[: 31 * seed % len(letters)]))
    return bytes(turned.get(c, c) for c in PIECES)


def _lang_hash(lang: str, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode(), seed + 1)


def _gram_hash(ids: list[np.ndarray]) -> np.ndarray:
    """One well spread number per n-gram; that of a single id is the id."""
    return reduce(lambda h, c: mixed(mixed(h, 3) + c, 5), ids)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}

    def held() -> Iterator[pa.RecordBatch]:
        for lang, own in counts.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * len(own), pa.string()),
                    "word": pa.array(list(own), pa.binary()),
                    "n": pa.array(list(own.values()), pa.int64()),
                }
            )
        counts.clear()

    for batch in batches:
        bodies, langs = _texts(batch), batch.column("lang").to_pylist()
        for a, b in parts(bodies, PART_BYTES):
            for lang, body in zip(langs[a:b], bodies[a:b]):
                counts.setdefault(lang, Counter()).update(body.translate(PIECES).split())
            if sum(map(len, counts.values())) >= WORDS_HELD:
                yield from held()
    yield from held()


def _identified(words: DataFrame) -> tuple[DataFrame, int]:
    """The words with ids that no two of them share, and the seed of the ids."""

    def with_seed(seed: int) -> DataFrame:
        spelling = _spelling(seed)

        def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                # Words are lower case already, so that only the seed's letters change.
                hashes, _ = word_hashes([w.translate(spelling) for w in batch.column("word").to_pylist()])
                salt = np.array([_lang_hash(x, seed) for x in batch.column("lang").to_pylist()], np.uint64)
                ids = pa.array(mixed(hashes ^ salt, seed).view(np.int64))
                yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, "id"])

        return written(words.mapInArrow(identify, f"{WORDS}, id long"), "words")

    for seed in range(SEEDS):
        found = with_seed(seed)
        most = found.groupBy("id").count().agg(F.max("count")).first()[0]
        if (most or 1) == 1:
            return found.select("id", "lang", F.col("word").cast("string").alias("word"), "n"), seed
    raise RuntimeError(f"words share an id with each of {SEEDS} seeds")


class _Part:
    """Words of some texts: their ids, and whether the next word belongs to the same piece."""

    def __init__(self, bodies: list[bytes], langs: list[str], spelling: bytes, seed: int):
        spelled = [body.translate(spelling) for body in bodies]
        hashes, counts = word_hashes(spelled)
        # As word_hashes joins them: texts end with a space. A text's end ends its last piece.
        raw = np.frombuffer(b"\n".join([*spelled, b""]), np.uint8)
        inside = (raw != 32) & (raw != 9) & (raw != 10)
        starts = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0) == 1)
        piece = np.cumsum(raw == 10, dtype=np.int32)[starts]
        salt = np.array([_lang_hash(lang, seed) for lang in langs], np.uint64)
        self.ids = mixed(hashes ^ np.repeat(salt, counts), seed)
        self.tied = piece[1:] == piece[:-1]

    def grams(self, k: int, known: np.ndarray) -> list[np.ndarray]:
        """Ids of all places of k words whose parts of k - 1 words the Bloom filter knows."""
        n = len(self.ids)
        if n < k:
            return [np.empty(0, np.uint64)] * k
        shorter = [self.ids[i : n - k + 2 + i] for i in range(k - 1)]
        frequent = bloom.may_hold(known, _gram_hash(shorter))
        here = frequent[1:] & frequent[:-1]
        for i in range(k - 1):
            here = here & self.tied[i : n - k + 1 + i]
        places = np.flatnonzero(here)
        return [self.ids[places + i] for i in range(k)]


def _counted(texts: DataFrame, k: int, known: np.ndarray, seed: int, bits: int, min_count: int) -> DataFrame:
    """Columns w1 to wk, h and n of the n-grams of k words with at least `min_count` places."""
    shared, spelling = shipped(texts.sparkSession, known), _spelling(seed)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, gathered, size = shared(), [], 0

        def passed_on(whole: Filter) -> Iterator[pa.RecordBatch]:
            found = whole.shards(bits)
            for a in range(0, len(found), ROWS):
                b = a + ROWS
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array([s for s, _ in found[a:b]], pa.int32()),
                        "payload": pa.array([f.packed(bits) for _, f in found[a:b]], pa.binary()),
                    }
                )

        for batch in batches:
            bodies, langs = _texts(batch), batch.column("lang").to_pylist()
            for a, b in parts(bodies, PART_BYTES):
                columns = permuted(_Part(bodies[a:b], langs[a:b], spelling, seed).grams(k, frequent))
                gathered.append(Filter.of(columns, np.ones(len(columns[0]), np.uint64)))
                size += len(gathered[-1])
                if size >= KEYS_HELD:
                    gathered = [Filter.merged(gathered)]
                    size = len(gathered[0])
                    if size >= KEYS_HELD // 2:
                        yield from passed_on(gathered.pop())
                        size = 0
        if gathered:
            yield from passed_on(Filter.merged(gathered))

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        whole = Filter.merged([Filter.unpacked(p, shard, bits, k) for p in table["payload"].to_pylist()])
        often = whole.counts >= np.uint64(min_count)
        ids = restored([c[often] for c in whole.columns])
        columns = {f"w{i + 1}": ids[i].view(np.int64) for i in range(k)}
        counts = whole.counts[often].astype(np.int64)
        return pa.table({**columns, "h": _gram_hash(ids).view(np.int64), "n": counts})

    schema = ", ".join([*(f"w{i + 1} long" for i in range(k)), "h long", "n long"])
    return texts.mapInArrow(count, SHARDS).groupBy("shard").applyInArrow(merge, schema)


def count_phrases(
    docs: DataFrame,
    longest: int = LONGEST,
    min_count: int = MIN_COUNT,
    text: str = "text",
    lang: str = "lang",
) -> Phrases:
    """Exact counts per language of all n-grams of up to `longest` words with at least `min_count` places.

    Texts are cut at .,;:!? and line ends into pieces and those at spaces and tabs
    into words, A-Z in lower case; places of an n-gram lie within a piece and may
    overlap. A null language is `und`; null and empty texts have no words; each
    row counts, also where rows repeat. Other columns are not looked at, whatever
    their names. Runs a job per level when called and stores what it finds.
    """
    if longest < 2 or min_count < 1:
        raise ValueError("phrases have two words and one place at least")
    texts = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.col(text).cast("string").alias("text"),
    )
    counted = texts.mapInArrow(_word_counts, WORDS).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    # One pass for both: languages have a row of their own without a word.
    kept = written(
        counted.groupBy("lang", F.when(F.col("n") >= min_count, F.col("word")).alias("word")).agg(
            F.sum("n").alias("n"), F.count("*").alias("kinds")
        ),
        "counts",
    )
    totals = kept.groupBy("lang").agg(F.sum("n").alias("n"))
    words, seed = _identified(kept.filter(F.col("word").isNotNull()).select("lang", "word", "n"))
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    bits = max(LEAST_SHARDS, n_words // SHARD_KEYS).bit_length() - 1
    phrases = Phrases(words, totals)
    known = bloom.build(words, "id", words.count())
    for k in range(2, longest + 1):
        grams = written(_counted(texts, k, known, seed, bits, min_count), f"grams{k}")
        phrases.grams[k] = grams
        if k < longest:
            known = bloom.build(grams, "h", grams.count())
    return phrases


def _score(a: Column, first: Column, rest: Column) -> Column:
    wide = [c.cast("decimal(19,0)") for c in (a, first, rest)]
    million = F.lit(1_000_000).cast("decimal(7,0)")
    over, under = million * (wide[0] * wide[0]), wide[1] * wide[2]
    # Decimal quotients round; the whole part is put right by the remainder.
    return ((over - F.pmod(over, under)) / under).cast("long")


def scored(phrases: Phrases, covered: int = COVERED) -> DataFrame:
    """Candidates with lang, phrase, a, l, r, n and score, those covered by longer ones left out.

    l and r count the parts of the cut with the lowest score, the first such cut;
    the score is floor(10^6 a a / (l r)). A candidate goes whose words lie within
    a longer frequent n-gram that has at least `covered` percent of its places.
    """
    longest = max(phrases.grams)
    rows = [_scored(phrases, k, covered) for k in range(2, longest + 1)]
    joined = reduce(DataFrame.unionByName, rows).alias("p")
    totals = phrases.totals.alias("t")
    return joined.join(totals, F.col("p.lang") == F.col("t.lang")).select("p.*", F.col("t.n").alias("n"))


def _scored(phrases: Phrases, k: int, covered: int) -> DataFrame:
    ids = [f"w{i + 1}" for i in range(k)]
    rows = phrases.grams[k].select(*ids, F.col("n").alias("a"))
    rows = _left_out(phrases, rows, k, covered)
    for i, name in enumerate(ids):
        word = phrases.words.select(F.col("id").alias(name), "lang", "word", "n")
        own = [F.col("r.word").alias(f"word{i}"), F.col("r.n").alias(f"f_{i}_{i + 1}")]
        rows = join_grouped(rows, word, [name]).select("l.*", *own, *([F.col("r.lang").alias("lang")] if not i else []))
    for size in range(2, k):
        for i in {0, k - size}:
            own = ids[i : i + size]
            part = phrases.grams[size].select(*[F.col(f"w{j + 1}").alias(c) for j, c in enumerate(own)], "n")
            rows = join_grouped(rows, part, own).select("l.*", F.col("r.n").alias(f"f_{i}_{i + size}"))
    a = F.col("a")
    cuts = [
        F.struct(
            _score(a, F.col(f"f_0_{c}"), F.col(f"f_{c}_{k}")).alias("score"),
            F.lit(c).alias("cut"),
            F.col(f"f_0_{c}").alias("l"),
            F.col(f"f_{c}_{k}").alias("r"),
        )
        for c in range(1, k)
    ]
    phrase = F.concat_ws(" ", *[f"word{i}" for i in range(k)]).alias("phrase")
    best = rows.select("lang", phrase, "a", F.array_min(F.array(*cuts)).alias("best"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def _left_out(phrases: Phrases, rows: DataFrame, k: int, covered: int) -> DataFrame:
    """The n-grams of k words that no longer one covers."""
    ids = [f"w{i + 1}" for i in range(k)]
    within = [
        phrases.grams[longer].select(*[F.col(f"w{at + i + 1}").alias(ids[i]) for i in range(k)], "n")
        for longer in range(k + 1, max(phrases.grams) + 1)
        for at in range(longer - k + 1)
    ]
    if not within:
        return rows
    largest = reduce(DataFrame.unionByName, within).groupBy(*ids).agg(F.max("n").alias("n"))
    joined = join_grouped(rows, largest, ids, "left")
    stays = F.col("r.n").isNull() | (100 * F.col("r.n") < covered * F.col("l.a"))
    return joined.filter(stays).select("l.*")


def best_phrases(phrases: Phrases, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """Each language's first `top` phrases by score, then a, both falling, then phrase by code point."""
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    part = F.pmod(F.hash("phrase"), F.lit(RANK_PARTS))
    # A language's rows meet in one task only after each of its parts has sent its first ones.
    rows = scored(phrases, covered).withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order)))
    rows = rows.filter(F.col("rank") <= top)
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("long"))
