"""Join of documents whose sets of word n-grams are similar, and the groups the links form.

Method: prefix filters under several global token orders. Two sets with a Jaccard
similarity of at least t share a token among the first n - ceil(t n) + 1 of each,
whatever total order sorts the tokens. Candidates come from the order that puts
rare tokens first; they must also share a prefix token under two orders by hash
before whole sets are compared.

Token frequencies are questions of pages (see pages.py). Documents whose prefix
holds only tokens of their own can have no partner and go no further. Documents
with equal sets are one node. Within a group of near copies links are not made
all to all: each document is first compared with the smallest holder of its
prefix tokens; then the documents that share a prefix token with another component
are compared with the members of their cluster, block by block, by posting lists
in memory. Every pair that passes the filter of the first order is either in one
component already or compared, so no group is lost and no pairs are written out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import pages
from tidemark.llm.components import clusters, components
from tidemark.llm.hashing import by_small, mixed, rolling, runs, window_starts, word_hashes
from tidemark.llm.shared import written
from tidemark.operators.joins import join_grouped

WORDS = 5
PERCENT = 75
# Nodes of a cluster that are compared with as many others at a time.
BLOCK = 256
Key = tuple[pa.Scalar, ...]

# A document with its set: `shared` are its tokens that other documents have too, rare
# ones first, of which the first `lead` are its prefix; second and third are what of
# `shared` belongs to the prefixes under the two other orders.
SETS = (
    "doc_id long, n_shingles long, digest binary, lead int, "
    "shared array<long>, second array<long>, third array<long>"
)


def _prefix(n: np.ndarray, percent: int) -> np.ndarray:
    """How many first tokens of sets of these sizes must hold one of a similar set; 1 for none."""
    return n - -(-n * percent // 100) + 1


class _Page:
    """The distinct tokens of a page's documents, by document."""

    def __init__(self, table: pa.Table, words: int, buckets: int):
        self.ids, texts = pages.page_rows(table)
        hashes, counts = word_hashes([t.lower() for t in texts])
        n_docs = len(counts)
        tokens, owner = [], []
        for k in range(1, words + 1):  # a text of fewer words is one token of its own kind
            sized = counts >= k if k == words else counts == k
            if not sized.any():
                continue
            starts, doc = window_starts(counts, k)
            starts, doc = starts[sized[doc]], doc[sized[doc]]
            tokens.append(mixed(rolling(hashes, k)[starts], k))
            owner.append(doc)
        tokens = np.concatenate(tokens) if tokens else np.empty(0, np.uint64)
        owner = np.concatenate(owner) if owner else np.empty(0, np.int64)
        # Tokens of one document lie together at first: a stable sort keeps owners in order.
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        new = runs(tokens) | runs(owner)
        self.tokens, self.owner = tokens[new], owner[new]
        self.codes = pages.short_codes(self.tokens, buckets)
        self.n = np.bincount(self.owner, minlength=n_docs)
        self.first = runs(self.codes)

    def questions(self, page: int) -> pa.Table:
        at = np.flatnonzero(self.first)
        holders = np.minimum(np.diff(np.append(at, len(self.codes))), 3)
        payload = pages.code_payload(self.codes[at], holders)
        spans = pages.spans_of(pages.code_buckets(self.codes[at]))
        return pages.questions(page, [b for b, _, _ in spans], [payload[i:j].tobytes() for _, i, j in spans])

    def sets(self, replies: pa.Table, percent: int) -> pa.Table:
        frequency = np.frombuffer(b"".join(pages.answers_of(replies, 1)), np.uint8)
        frequency = frequency[np.cumsum(self.first) - 1] if len(self.codes) else np.empty(0, np.uint8)
        n_docs = len(self.n)
        start, prefix = np.cumsum(self.n) - self.n, _prefix(self.n, percent)
        # Tokens of a document in ascending order; then in the order that puts rare ones first.
        ascending = by_small(np.arange(len(self.tokens)), self.owner, n_docs)
        rare = by_small(by_small(ascending, frequency, 255), self.owner, n_docs)
        alone = np.bincount(self.owner[frequency == 0], minlength=n_docs).astype(np.int64)
        lead = np.maximum(prefix - alone, 0)
        wanted = lead > 0
        ranked = []
        for seed in (2, 3):
            some = np.flatnonzero(wanted[self.owner])
            some = by_small(some[np.argsort(mixed(self.tokens[some], seed))], self.owner, n_docs)
            own = np.where(wanted, self.n, 0)
            rank = np.arange(len(some)) - np.repeat(np.cumsum(own) - own, own)
            inside = np.zeros(len(self.tokens), bool)
            inside[some] = rank < np.repeat(prefix, own)
            ranked.append(inside[rare])
        sorted_tokens, tokens = self.tokens[ascending], self.tokens[rare]
        columns = {name: [] for name in ("digest", "lead", "shared", "second", "third")}
        signed = tokens.view(np.int64)
        empty = np.empty(0, np.int64)
        for i, (a, n) in enumerate(zip(start.tolist(), self.n.tolist())):
            whole = sorted_tokens[a : a + n].tobytes()
            columns["digest"].append(hashlib.blake2b(whole, digest_size=16).digest() if n else None)
            part = slice(a + int(alone[i]), a + n)
            columns["lead"].append(int(lead[i]))
            columns["shared"].append(signed[part] if wanted[i] else empty)
            columns["second"].append(signed[part][ranked[0][part]] if wanted[i] else empty)
            columns["third"].append(signed[part][ranked[1][part]] if wanted[i] else empty)
        longs = pa.list_(pa.int64())
        ids = [None if i == pages.LAST_ID else i for i in self.ids.tolist()]
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_shingles": pa.array(self.n, pa.int64()),
                "digest": pa.array(columns["digest"], pa.binary()),
                "lead": pa.array(columns["lead"], pa.int32()),
                "shared": pa.array(columns["shared"], longs),
                "second": pa.array(columns["second"], longs),
                "third": pa.array(columns["third"], longs),
            }
        )


def _answer(key: Key, table: pa.Table) -> pa.Table:
    """How frequent each token is: 0 where only one document has it, else a step of its logarithm."""
    asked = [np.frombuffer(p, np.uint32) for p in table["payload"].to_pylist()]
    every = np.sort(np.concatenate(asked))
    codes = every >> np.uint32(2)
    first = np.flatnonzero(runs(codes))
    holders = np.add.reduceat((every & np.uint32(3)).astype(np.int64), first)
    several = holders > 1
    known, steps = codes[first][several], np.minimum(4 * np.log2(holders[several]), 255).astype(np.uint8)
    replies = []
    for payload in asked:
        code = payload >> np.uint32(2)
        at = np.minimum(np.searchsorted(known, code), max(len(known) - 1, 0))
        found = known[at] == code if len(known) else np.zeros(len(code), bool)
        replies.append((np.where(found, steps[at], 0) if len(known) else found).astype(np.uint8).tobytes())
    return pages.answers(1, key[0].as_py(), table["page"].to_pylist(), replies)


def shingle_sets(docs: DataFrame, words: int, percent: int, doc_id: str, text: str) -> DataFrame:
    size = pages.layout(docs.select(F.col(text).cast("string").alias("text")))
    by_page = pages.paged(docs, size.pages, doc_id, text).groupBy("page")

    def ask(key: Key, table: pa.Table) -> pa.Table:
        return _Page(table, words, size.buckets).questions(key[0].as_py())

    def collect_sets(key: Key, table: pa.Table, replies: pa.Table) -> pa.Table:
        return _Page(table, words, size.buckets).sets(replies, percent)

    asked = by_page.applyInArrow(ask, pages.QUESTION).groupBy("bucket")
    replies = asked.applyInArrow(_answer, pages.ANSWER)
    return by_page.cogroup(replies.groupBy("page")).applyInArrow(collect_sets, SETS)


def _similar(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose sets are similar: filters of the other orders first, then whole sets."""
    sides = nodes.select(
        F.col("node").alias("a"), F.struct("n_shingles", "second", "third", "shared").alias("s")
    )
    one = join_grouped(pairs, sides, ["a"]).select(F.col("l.a").alias("x"), F.col("b").alias("a"), F.col("s").alias("t"))
    two = join_grouped(one, sides, ["a"]).select("x", F.col("l.a").alias("y"), "s", "t")
    passed = two.filter(F.arrays_overlap("s.second", "t.second") & F.arrays_overlap("s.third", "t.third"))
    common = F.size(F.array_intersect("s.shared", "t.shared")).cast("long")
    union = F.col("s.n_shingles") + F.col("t.n_shingles") - common
    return passed.filter(100 * common >= percent * union).select(F.col("x").alias("a"), F.col("y").alias("b"))


def _comparable(percent: int):
    """Sets of sizes n and m can only be similar if the smaller has that share of the larger."""
    return 100 * F.least("n", "m") >= percent * F.greatest("n", "m")


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _grouped(nodes: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """(node, component) of the nodes that have a link, by their sets or among the known ones."""
    tokens = nodes.select("node", "n_shingles", F.explode(F.slice("shared", F.lit(1), F.col("lead"))).alias("token"))
    holders = tokens.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("node", "n_shingles")).alias("least"),
        F.max(F.struct("node", "n_shingles")).alias("last"),
    )
    tokens = written(
        join_grouped(tokens, holders.filter("n > 1").drop("n"), ["token"]).select(
            "node", F.col("n_shingles").alias("n"), F.col("l.token").alias("token"), "least", "last"
        )
    )
    # First the holder of most of a document's prefix tokens: near copies meet there.
    ends = F.explode(F.array("least", "last"))
    star = tokens.select("node", "n", ends.alias("e")).select("node", "n", "e.node", "e.n_shingles")
    star = star.toDF("a", "n", "b", "m").filter((F.col("a") != F.col("b")) & _comparable(percent))
    star = star.groupBy("a", "b").count().groupBy("a").agg(F.max_by("b", F.struct("count", -F.col("b"))).alias("b"))
    links = written(_similar(_pairs(star), nodes, percent).unionByName(known))
    group = written(components(links))

    # Then what shares a prefix token across components.
    placed = join_grouped(tokens.select("node", "token"), group, ["node"], "left")
    placed = placed.select(F.col("l.node").alias("node"), "token", F.coalesce("component", "l.node").alias("c"))
    split = placed.groupBy("token").agg(F.min("c").alias("low"), F.max("c").alias("high"))
    split = split.filter("low < high").select("token")
    near = written(join_grouped(placed, split, ["token"], "left_semi").select("node", "c", "token"))
    return components(links.unionByName(_across(near, nodes, percent)))


class _Holders:
    """Which rows of a block hold a token."""

    def __init__(self, lists: pa.ListArray):
        flat = lists.flatten().to_numpy()
        row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        order = np.argsort(flat, kind="stable")
        ordered = flat[order]
        first = np.flatnonzero(runs(ordered))
        self.tokens, self.rows, self.n = ordered[first], row[order], len(lists)
        self.bounds = np.append(first, len(ordered))

    def common(self, tokens: np.ndarray) -> np.ndarray:
        """How many of the tokens each row holds."""
        at = np.minimum(np.searchsorted(self.tokens, tokens), max(len(self.tokens) - 1, 0))
        at = at[self.tokens[at] == tokens] if len(self.tokens) else at[:0]
        if not len(at):
            return np.zeros(self.n, np.int64)
        return np.bincount(
            np.concatenate([self.rows[self.bounds[i] : self.bounds[i + 1]] for i in at.tolist()]), minlength=self.n
        )


def _block_links(percent: int):
    """Links between the probes and the members of a block; of those to one component, one per probe."""

    def compare(key: Key, members: pa.Table, probes: pa.Table) -> pa.Table:
        columns = {name: members[name].combine_chunks() for name in members.column_names}
        nodes, c, n = (columns[name].to_numpy() for name in ("node", "c", "n_shingles"))
        orders = [_Holders(columns[name]) for name in ("leading", "second", "third")]
        whole = _Holders(columns["shared"])
        links: list[tuple[int, int]] = []
        for probe in probes.to_batches(max_chunksize=64):
            lists = [probe.column(name) for name in ("leading", "second", "third", "shared")]
            for i, (node, own, size) in enumerate(zip(*(probe.column(x).to_pylist() for x in ("node", "c", "n_shingles")))):
                leading, second, third, shared = (x[i].values.to_numpy() for x in lists)
                left = (c != own) & (100 * np.minimum(n, size) >= percent * np.maximum(n, size))
                for order, prefix in zip(orders, (leading, second, third)):
                    if left.any():
                        left &= order.common(prefix) > 0
                if left.any():
                    common = whole.common(shared)
                    left &= 100 * common >= percent * (n + size - common)
                    at = np.flatnonzero(left)
                    links.extend((node, other) for other in nodes[at[np.unique(c[at], return_index=True)[1]]].tolist())
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return compare


def _across(near: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Links between components, from rows (node, c, token) of prefix tokens that several components have.

    Nodes that such tokens connect are a cluster. Its members outside its largest
    component are compared with all members, in blocks of BLOCK by BLOCK nodes.
    """
    groups = clusters(near.select("node", F.col("token").alias("key")))
    members = join_grouped(near.select("node", "c").distinct(), groups, ["node"])
    members = written(members.select(F.col("l.node").alias("node"), "c", "cluster"))
    counts = members.groupBy("cluster", "c").count()
    facts = counts.groupBy("cluster").agg(
        F.sum("count").alias("size"), F.max(F.struct("count", "c")).alias("main")
    )
    members = join_grouped(members, facts, ["cluster"]).select(
        "node", "c", F.col("l.cluster").alias("cluster"), "size", "main"
    )
    blocks = F.ceil(F.col("size") / BLOCK)
    probe_blocks = F.ceil((F.col("size") - F.col("main.count")) / BLOCK)
    own = F.xxhash64("node")

    def every(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), n - 1))

    index = members.withColumn("i", F.pmod(own, blocks)).withColumn("j", every(probe_blocks))
    probes = members.filter("c <> main.c").withColumn("j", F.pmod(own, probe_blocks)).withColumn("i", every(blocks))
    sides = []
    for side in (index, probes):
        whole = join_grouped(side.select("node", "c", "cluster", "i", "j"), nodes, ["node"])
        whole = whole.select(
            F.col("l.node").alias("node"), "c", "cluster", "i", "j", "n_shingles", "second", "third", "shared",
            F.slice("shared", F.lit(1), F.col("lead")).alias("leading"),
        )
        sides.append(whole.toDF(*whole.columns).groupBy("cluster", "i", "j"))
    return sides[0].cogroup(sides[1]).applyInArrow(_block_links(percent), "a long, b long")


def similar_groups(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Groups of documents linked by similar sets of word n-grams.

    Words are runs of other characters than ASCII whitespace with A-Z in lower
    case. A document's set has its distinct sequences of `words` words; with fewer
    words, the whole sequence. Two documents link when their intersection is at
    least `percent` percent of their union. One row per input row: doc_id,
    n_shingles, component_id, the smallest doc_id that links reach, itself included.

    Null texts and texts without words have no set and link with nothing. Rows of
    one id count as one document with several sets; a row with a null id takes
    part as a copy of documents with its set and has no links of its own
    (component_id null where it has no copy). Other columns are not looked at.
    Builds and runs intermediate jobs when called.
    """
    if words < 1 or not 1 <= percent <= 100:
        raise ValueError("words must be at least 1 and percent from 1 to 100")
    sets = written(shingle_sets(docs, words, percent, doc_id, text))
    classes = sets.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("node"))
    light = sets.select("doc_id", "n_shingles", "digest")
    rows = join_grouped(light, classes, ["digest"], "left").select("doc_id", "n_shingles", "node")
    nodes = join_grouped(sets.filter("lead > 0"), classes, ["digest"]).filter("doc_id = node")
    nodes = nodes.drop("digest", "doc_id")
    # Rows of one id with several sets link those sets.
    several = rows.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("d")).filter("b < d")
    known = join_grouped(rows, several, ["doc_id"]).select(F.col("node").alias("a"), "b").filter("a <> b")
    group = _grouped(nodes, known, percent)
    placed = join_grouped(rows, group, ["node"], "left")
    component = F.coalesce("component", "l.node", "doc_id")
    return placed.select("doc_id", "n_shingles", component.alias("component_id"))
