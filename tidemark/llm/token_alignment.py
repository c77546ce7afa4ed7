"""Alignment of two tokenizers' tokens by the bytes they cover, and how often their ids meet.

Method: an Arrow pipeline. Token lists of both sides are flattened with their
parent indices, a cumulative sum of token bytes per document gives each token's
end, and a hash join on (document, end) finds where both sides end; a token that
has no partner there meets the next token of the other side. Pairs of ids are
counted by Table.group_by in tasks, and Spark adds the partial counts up.

Counts of pairs go back to the documents in two ways: the most frequent pairs, a
bounded number, go to all tasks, and each document's other pairs, which are rare
one by one, are joined. A document's pairs lie in the shared folder meanwhile, so
that every text is encoded once.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from tidemark.llm.shared import parts, shipped, written
from tidemark.operators.joins import join_grouped

BYTE_LEVEL = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
PART_BYTES = 1 << 20  # of text that a task encodes at a time
FREQUENT_PAIRS = 1 << 19  # pairs whose counts go to all tasks
PAIRS_HELD = 1 << 20  # pairs that a task gathers before it passes their counts on
LONG_SPACE = re.compile(r"\s{500}")
ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "codes array<long>, places array<int>"
)
COUNTED = "code long, n long"
TOTALS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


@dataclass(frozen=True)
class Files:
    """Contents of the tokenizers' files, so that tasks need no path; some MB."""

    byte_level: str
    pieces: bytes

    @staticmethod
    def read(byte_level: str | None = None, pieces: str | None = None) -> Files:
        """From paths on the driver, by default those of the installed public files."""
        with open(byte_level or public_tokenizers.path(BYTE_LEVEL), encoding="utf-8") as file:
            first = file.read()
        with open(pieces or public_tokenizers.path(PIECES), "rb") as file:
            return Files(first, file.read())


def _byte_alphabet() -> dict[str, int]:
    """Bytes by the characters that stand for them in byte-level entries: printable Latin-1, then code points from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    assert sorted(letters) == sorted(ByteLevel.alphabet())
    return letters


class Encoders:
    """Both tokenizers, and the bytes of their entries by id."""

    def __init__(self, files: Files):
        self.files = files
        model = json.loads(files.byte_level)["model"]
        letters = _byte_alphabet()
        self._slow: Tokenizer | None = None
        by_id = {i: entry for entry, i in Tokenizer.from_str(files.byte_level).get_vocab(True).items()}
        plain = set(model["vocab"])
        first = [
            bytes(letters[c] for c in by_id[i]) if by_id.get(i) in plain else b"" for i in range(max(by_id) + 1)
        ]
        self._fast = self._ranked(model, first)
        self._pieces = sentencepiece.SentencePieceProcessor(model_proto=files.pieces)
        second = [
            bytes([int(piece[3:5], 16)]) if self._pieces.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(self._pieces.id_to_piece, range(self._pieces.get_piece_size())))
        ]
        self.entries = [pa.array(x, pa.binary()) for x in (first, second)]
        self.lengths = [pc.binary_length(x) for x in self.entries]
        self.sizes = [len(first), len(second)]
        # Decimal ids with the sign behind them: within a side of a group, and at its end.
        self.decimals = pa.array([f"{i}{sign}" for n, last in zip(self.sizes, "|;") for sign in ("," + last) for i in range(n)])

    @staticmethod
    def _ranked(model: dict, entries: list[bytes]) -> tiktoken.Encoding | None:
        """A faster encoder of the same ids where merges are ranked by the id of what they make, as here."""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        vocab, options = model["vocab"], ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        if any(model.get(o) for o in options) or any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
            return None
        ranks = {entries[i]: i for i in vocab.values()}
        return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def first(self, text: str) -> np.ndarray:
        """Ids of the byte-level side, without special tokens."""
        if self._fast and not LONG_SPACE.search(text):
            return self._fast.encode_to_numpy(text)
        # The faster one's pattern nests as deep as a run of spaces is long.
        if not self._slow:
            self._slow = Tokenizer.from_str(self.files.byte_level)
            self._slow.encode_special_tokens = True
        return np.array(self._slow.encode(text, add_special_tokens=False).ids, np.uint32)

    def second(self, texts: list[str]) -> list[list[int]]:
        return self._pieces.encode(texts, num_threads=1) if texts else []


def _list(ids: list) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, ids)])
    flat = np.concatenate([np.asarray(x, np.int32) for x in ids]) if ids else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))


def _joined(tokens: pa.ListArray, entries: pa.Array) -> tuple[bytes, np.ndarray]:
    """The bytes of all tokens in order, and where each document's begin and end."""
    taken = entries.take(tokens.flatten())
    offsets = np.frombuffer(taken.buffers()[1], np.int32, len(taken) + 1, taken.offset * 4)
    data = taken.buffers()[2]
    whole = data.to_pybytes()[offsets[0] : offsets[-1]] if data else b""
    return whole, (offsets - offsets[0])[tokens.offsets.to_numpy()]


def _same(texts: list[bytes], sides: list[tuple[bytes, np.ndarray]]) -> list[bool]:
    """Which documents' tokens join to their text on both sides."""
    whole = b"".join(texts)
    ends = np.cumsum([0, *map(len, texts)])
    if all(data == whole and np.array_equal(at, ends) for data, at in sides):
        return [True] * len(texts)
    return [all(data[at[i] : at[i + 1]] == text for data, at in sides) for i, text in enumerate(texts)]


class _Alignment:
    """Groups and links of documents whose tokens cover their text."""

    def __init__(self, encoders: Encoders, tokens: list[pa.ListArray]):
        self.encoders, self.n_docs = encoders, len(tokens[0])
        self.ids = [pc.list_flatten(t) for t in tokens]
        self.docs = [pc.list_parent_indices(t) for t in tokens]
        # Ends by a cumulative sum that runs on over documents, whose bytes are the same on
        # both sides: a document and an end within it make one number.
        self.ends = [pc.cumulative_sum(n.take(i).cast(pa.int64())) for n, i in zip(encoders.lengths, self.ids)]
        tables = [
            pa.table({"end": end, name: pa.array(np.arange(len(end)))}) for end, name in zip(self.ends, ("a", "b"))
        ]
        met = tables[0].join(tables[1], "end", join_type="full outer", use_threads=False).sort_by("end")
        both = pc.and_(pc.is_valid(met["a"]), pc.is_valid(met["b"])).to_numpy()
        # Up to each end, one token of either side goes on: the next that ends.
        at = [pc.fill_null_backward(met[name]).combine_chunks() for name in ("a", "b")]
        self.link_ids = [i.take(x).to_numpy().astype(np.int64) for i, x in zip(self.ids, at)]
        self.link_docs = self.docs[0].take(at[0]).to_numpy()
        self.shared = met["end"].to_numpy()[both]
        self.group_docs = self.link_docs[both]

    def per_doc(self, docs: np.ndarray) -> np.ndarray:
        return np.bincount(docs, minlength=self.n_docs)

    def digests(self) -> list[str]:
        """sha256 of a1,a2|b1;a3|b2,b3 per document."""
        ends = [e.to_numpy() for e in self.ends]
        group = [np.searchsorted(self.shared, e) for e in ends]
        last = [np.diff(g, append=-1) != 0 for g in group]
        counts = [np.bincount(g, minlength=len(self.shared)) for g in group]
        # Each group's tokens of the first side, then those of the second.
        before = [np.cumsum(c) - c for c in counts]
        place = [np.arange(len(ends[0])) + before[1][group[0]], np.arange(len(ends[1])) + (before[0] + counts[0])[group[1]]]
        order, shift = np.empty(len(ends[0]) + len(ends[1]), np.int64), 0
        for ids, end, at, size in zip(self.ids, last, place, self.encoders.sizes):
            order[at] = ids.to_numpy() + shift + size * end
            shift += 2 * size
        words = self.encoders.decimals.take(pa.array(order))
        offsets = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, words.offset * 4)
        data = words.buffers()[2].to_pybytes() if len(words) else b""
        tokens = np.cumsum([0, *sum(self.per_doc(d.to_numpy()) for d in self.docs)])
        cuts = offsets[tokens].tolist()
        return [hashlib.sha256(data[a : b - 1]).hexdigest() for a, b in zip(cuts, cuts[1:])]

    def pairs(self) -> tuple[pa.Array, pa.Array]:
        """Per document the distinct pairs of ids, as one number, and their links."""
        codes = self.link_ids[0] * self.encoders.sizes[1] + self.link_ids[1]
        links = pa.table({"doc": self.link_docs, "code": codes})
        found = links.group_by(["doc", "code"], use_threads=False).aggregate([([], "count_all")])
        found = found.sort_by([("doc", "ascending"), ("code", "ascending")])
        offsets = pa.array(np.cumsum([0, *self.per_doc(found["doc"].to_numpy())]), pa.int32())
        values = found["code"].combine_chunks(), found["count_all"].combine_chunks().cast(pa.int32())
        return tuple(pa.ListArray.from_arrays(offsets, v) for v in values)


def _aligned(texts: list[str | None], encoders: Encoders) -> pa.Table:
    """The columns n_a to places of ALIGNED."""
    spaced = [f" {t}" for t in texts if t]
    encoded = [[t.encode() for t in spaced], _list([encoders.first(t) for t in spaced])]
    encoded.append(_list(encoders.second([t[1:] for t in spaced])))
    same = _same(encoded[0], [_joined(t, e) for t, e in zip(encoded[1:], encoders.entries)])
    rows = np.flatnonzero([bool(t) for t in texts])[same] if spaced else np.empty(0, np.int64)
    keep = pa.array(same, pa.bool_())
    tokens = [t.filter(keep) for t in encoded[1:]]
    found = _Alignment(encoders, [pa.ListArray.from_arrays(_offsets(t), t.flatten()) for t in tokens])
    codes, places = found.pairs()
    at = np.full(len(texts), -1)
    at[rows] = np.arange(len(rows))
    to = pa.array(at, mask=at < 0)
    n_a, n_b = (found.per_doc(d.to_numpy()) for d in found.docs)
    numbers = {
        "n_a": n_a,
        "n_b": n_b,
        "n_groups": found.per_doc(found.group_docs),
        "n_links": found.per_doc(found.link_docs),
    }
    return pa.table(
        {
            **{name: pc.fill_null(pa.array(x, pa.int64()).take(to), 0) for name, x in numbers.items()},
            "groups_sha256": pc.fill_null(pa.array(found.digests(), pa.string()).take(to), ""),
            "codes": codes.take(to),
            "places": places.take(to),
        }
    )


def _offsets(lists: pa.ListArray) -> pa.Array:
    return pa.array(np.cumsum([0, *pc.list_value_length(lists).to_pylist()]), pa.int32())


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        flat = {"code": pc.list_flatten(batch.column("codes")), "n": pc.list_flatten(batch.column("places")).cast(pa.int64())}
        held.append(_added(pa.table(flat)))
        size += held[-1].num_rows
        if size >= PAIRS_HELD:
            held = [_added(pa.concat_tables(held))]
            size = held[0].num_rows
            if size >= PAIRS_HELD // 2:
                yield from held.pop().to_batches(max_chunksize=1 << 16)
                size = 0
    if held:
        yield from _added(pa.concat_tables(held)).to_batches(max_chunksize=1 << 16)


def _added(counts: pa.Table) -> pa.Table:
    total = counts.group_by("code", use_threads=False).aggregate([("n", "sum")])
    return total.select(["code", "n_sum"]).rename_columns(["code", "n"])


@dataclass(frozen=True)
class Alignments:
    """Documents with their groups and links, and how often ids are linked.

    `documents` has a row number, doc_id, n_a, n_b, n_groups, n_links,
    groups_sha256, and codes and places: the distinct linked pairs, as
    id of A * `size_b` + id of B, and their links. `pairs` has code and n.
    """

    documents: DataFrame
    pairs: DataFrame
    size_b: int


def align(docs: DataFrame, files: Files | None = None, doc_id: str = "doc_id", text: str = "text") -> Alignments:
    """Align the tokens of every text, encoded with a space in front, by byte ranges.

    A group is what lies between two places where tokens of both sides end; a link
    is a pair of tokens whose byte ranges overlap. Null and empty texts, and those
    whose tokens do not join to a space and the text on both sides, have no tokens.
    Each row is a document, also where ids are null or rows repeat; other columns
    are not looked at, whatever their names. A text's tokens must fit a task.
    Encodes and stores the documents when called.
    """
    files = files or Files.read()
    shared = shipped(docs.sparkSession, files)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders, n = Encoders(shared()), TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            for a, b in parts([range(s) for s in sizes], PART_BYTES):
                found = _aligned(texts[a:b], encoders)
                row = pa.array(np.arange(n, n + b - a))
                n += b - a
                columns = [row, batch.column("doc_id").slice(a, b - a), *(c.combine_chunks() for c in found.columns)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", *found.column_names])

    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    documents = written(texts.mapInArrow(encode, ALIGNED), "aligned")
    partial = documents.select("codes", "places").filter("codes IS NOT NULL").mapInArrow(_count_pairs, COUNTED)
    pairs = written(partial.groupBy("code").agg(F.sum("n").alias("n")), "pairs")
    size_b = sentencepiece.SentencePieceProcessor(model_proto=files.pieces).get_piece_size()
    return Alignments(documents, pairs, size_b)


def _frequent(pairs: DataFrame, most: int) -> DataFrame:
    """The pairs with the highest counts, at most `most`, by steps of counts and never a part of a step."""
    step = F.floor(F.log2(F.col("n")) * 64).cast("int")
    # Some thousands of steps hold any counts that fit 64 bits.
    sizes = pairs.groupBy(step.alias("step")).count().collect()
    total, lowest = 0, None
    for row in sorted(sizes, key=lambda r: -r["step"]):
        total += row["count"]
        if total > most:
            break
        lowest = row["step"]
    return pairs.filter(step >= lowest) if lowest is not None else pairs.limit(0)


def _best(spark: SparkSession, found: Alignments) -> np.ndarray:
    """By id of B, the highest count of its pairs: as many numbers as B has entries."""
    rows = found.pairs.groupBy((F.col("code") % found.size_b).alias("b")).agg(F.max("n").alias("n")).collect()
    best = np.zeros(found.size_b, np.int64)
    best[[r["b"] for r in rows]] = [r["n"] for r in rows]
    return best


def linked(found: Alignments, frequent_pairs: int = FREQUENT_PAIRS) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    count_sum adds, over the document's links, how many links of the corpus have
    the same pair of ids; n_best counts the links whose pair is the most frequent
    of its B id, ties included. Documents without tokens have zeros.
    """
    spark = found.documents.sparkSession
    frequent = _frequent(found.pairs, frequent_pairs)
    table = frequent.toArrow().sort_by("code")  # frequent_pairs rows at most
    codes, counts = (table[name].to_numpy() for name in ("code", "n"))
    shared = shipped(spark, (codes, counts, _best(spark, found)))
    size_b = found.size_b

    def flat(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        rows = pc.list_parent_indices(batch.column("codes")).to_numpy()
        own = [pc.list_flatten(batch.column(name)).to_numpy() for name in ("codes", "places")]
        known, numbers, best = shared()
        at = np.minimum(np.searchsorted(known, own[0]), max(len(known) - 1, 0))
        there = known[at] == own[0] if len(known) else np.zeros(len(own[0]), bool)
        return rows, own[0], own[1].astype(np.int64), there, numbers, at, best

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, own, places, there, numbers, at, best = flat(batch)
            total, n_best = (np.zeros(batch.num_rows, np.int64) for _ in range(2))
            n, places, own, rows = numbers[at[there]], places[there], own[there], rows[there]
            np.add.at(total, rows, n * places)
            np.add.at(n_best, rows, places * (n == best[own % size_b]))
            kept = batch.select(names)
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(total), pa.array(n_best)], [*names, "known", "best"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, own, places, there, _, _, best = flat(batch)
            left = ~there
            columns = [batch.column("row").to_numpy()[rows[left]], own[left], places[left], best[own[left] % size_b]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row", "code", "places", "best"])

    names = [n.split()[0] for n in TOTALS.split(", ")]
    documents = found.documents
    sums = documents.mapInArrow(add, f"{TOTALS}, known long, best long")
    rare = documents.select("row", "codes", "places").filter("codes IS NOT NULL")
    rare = rare.mapInArrow(others, "row long, code long, places long, best long")
    counted = join_grouped(rare, found.pairs, ["code"]).select("l.*", "r.n")
    more = counted.groupBy("row").agg(
        F.sum(F.col("n") * F.col("places")).alias("known"),
        F.sum(F.when(F.col("n") == F.col("best"), F.col("places")).otherwise(0)).alias("best"),
    )
    joined = join_grouped(sums, more, ["row"], "left")
    return joined.select(
        *[F.col(f"l.{n}") for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")],
        (F.col("l.best") + F.coalesce("r.best", F.lit(0))).cast("long").alias("n_best"),
        (F.col("l.known") + F.coalesce("r.known", F.lit(0))).cast("long").alias("count_sum"),
        "l.groups_sha256",
    )
