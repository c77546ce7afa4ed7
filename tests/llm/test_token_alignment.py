import hashlib
from collections import Counter

import pytest
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import documents, rows_of, text_of
from tidemark.llm import token_alignment as alignment

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = [
    (300, "text with ▁ in it", "en", "x"),
    (301, "<|endoftext|> <s> </s> <unk> <0x41> it's", "en", "x"),
    (302, "  two  spaces \t\n\n end  ", "en", "x"),
    (303, " " * 3000 + "x" + "\n" * 700, "en", "x"),
    (304, "漢字かな 🤷🏽‍♀️ é́ ​﻿ \x00\x07 ﬁ ½", "ja", "x"),
    (305, "a" * 20_000, "en", "x"),
]


@pytest.fixture(scope="module")
def tokenizers():
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    letters = alignment._byte_alphabet()
    bytes_a = {i: bytes(letters.get(c, 0) for c in entry) for entry, i in first.get_vocab().items()}
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def bytes_b(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()

    return first, second, bytes_a.__getitem__, bytes_b


def spans(ids, entry):
    ends, at = [], 0
    for i in ids:
        at += len(entry(i))
        ends.append(at)
    return ends


def plain(rows, tokenizers):
    """The query's rows from token lists, byte by byte."""
    first, second, bytes_a, bytes_b = tokenizers
    docs, counts = [], Counter()
    for doc_id, text, *_ in rows:
        whole = f" {text}".encode()
        a = first.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        if not text or b"".join(map(bytes_a, a)) != whole or b"".join(map(bytes_b, b)) != whole:
            docs.append((doc_id, [], [], [], None))
            continue
        ends = spans(a, bytes_a), spans(b, bytes_b)
        owner = [[k for k, (s, e) in enumerate(zip([0, *own], own)) for _ in range(e - s)] for own in ends]
        links = [(a[i], b[j]) for i, j in dict.fromkeys(zip(*owner))]
        shared = sorted(set(ends[0]) & set(ends[1]))
        groups = [
            "|".join(
                ",".join(str(i) for i, end in zip(ids, own) if start < end <= stop) for ids, own in zip((a, b), ends)
            )
            for start, stop in zip([0, *shared], shared)
        ] if len(a) < 3000 else None
        counts.update(links)
        docs.append((doc_id, a, b, links, (len(shared), groups)))
    best = Counter()
    for (a, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for doc_id, a, b, links, shared in docs:
        digest = ""
        if shared:
            digest = hashlib.sha256(";".join(shared[1]).encode()).hexdigest() if shared[1] is not None else "long"
        total = sum(counts[x] for x in links)
        n_best = sum(counts[x] == best[x[1]] for x in links)
        out.append((doc_id, len(a), len(b), shared[0] if shared else 0, len(links), n_best, total, digest))
    return sorted(out, key=lambda row: [(x is None, x) for x in row])


@pytest.fixture(scope="module")
def rows():
    return [r for r in documents() if len(r[1] or "") < 50_000] + ODD + [(306, text_of(9, 200), "en", "x")]


@pytest.fixture(scope="module")
def frame(spark, rows):
    clash = "row codes places n code known best n_a n_b groups_sha256 b a end".split()
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return made.repartition(3).withColumns({name: F.lit(name) for name in clash})


@pytest.fixture(scope="module")
def want(rows, tokenizers):
    return plain(rows, tokenizers)


@pytest.mark.parametrize("frequent", [0, 40, alignment.FREQUENT_PAIRS])
def test_equals_plain_version(frame, want, frequent):
    got = rows_of(alignment.linked(alignment.align(frame), frequent), *COLUMNS)
    long = {w[0] for w in want if w[7] == "long"}
    assert [g[:7] if g[0] in long else g for g in got] == [w[:7] if w[0] in long else w for w in want]
    assert sum(w[1] > 0 for w in want) > 20 and any(w[0] == 300 and not w[1] for w in want)


def test_texts_in_portions(frame, want, monkeypatch):
    monkeypatch.setattr(alignment, "PART_BYTES", 50)
    monkeypatch.setattr(alignment, "PAIRS_HELD", 20)
    got = rows_of(alignment.linked(alignment.align(frame)), *COLUMNS)
    assert [g[:7] for g in got] == [w[:7] for w in want]


def test_no_documents(frame):
    found = alignment.align(frame.limit(0))
    assert alignment.linked(found).count() == 0 and found.pairs.count() == 0


def test_both_encoders_of_the_first_side_agree(tokenizers):
    encoders = alignment.Encoders(alignment.Files.read())
    assert encoders._fast is not None
    for text in [" it's 42 ÀÉ 漢字  x\n\n y z  \x1c", *[f" {t}" for _, t, *_ in ODD]]:
        assert encoders.first(text).tolist() == tokenizers[0].encode(text, add_special_tokens=False).ids


def test_tokenizers_with_other_merges_take_the_plain_way(tmp_path):
    files = alignment.Files.read()
    changed = alignment.Files(files.byte_level.replace('"dropout":null', '"dropout":0.0').replace('"dropout": null', '"dropout": 0.0'), files.pieces)
    assert alignment.Encoders(changed).first(" plain text").tolist() == alignment.Encoders(files).first(" plain text").tolist()


def test_frequent_pairs_are_bounded_and_whole_steps(spark):
    pairs = spark.createDataFrame([(i, n) for i, n in enumerate([100, 100, 100, 50, 50, 7, 1, 1, 1, 1])], "code long, n long")
    taken = [sorted(r["n"] for r in alignment._frequent(pairs, most).collect()) for most in (0, 2, 3, 4, 5, 6, 9, 10)]
    assert [len(t) for t in taken] == [0, 0, 3, 3, 5, 6, 6, 10]
