import re
import zlib

import numpy as np

from conftest import documents
from tidemark.llm import toxicity
from tidemark.llm.shared import held_out


def test_held_out_by_crc32(spark):
    ids = spark.createDataFrame([(i,) for i in [*range(200), -7]], "doc_id long").select("doc_id", held_out().alias("h"))
    for row in ids.collect():
        assert row["h"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2)


def test_finds_held_out_toxic_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = toxicity.scored(docs, toxicity.train(docs, labels), keep=["doc_id"])
    rows = rows.filter(held_out()).join(labels, "doc_id").select("score", "toxic").collect()
    found = np.array([r["score"] >= toxicity.THRESHOLD for r in rows])
    truth = np.array([r["toxic"] == 1 for r in rows])
    # Some labelled documents hold no toxic word at all, so not every label can be met.
    assert (found == truth).mean() > 0.96
    assert found[truth].mean() > 0.75 and truth[found].mean() > 0.9


def example_model():
    clean = [(f"Word one{i}. Nothing here of note{i}! Fine day.", 0, 1.0) for i in range(60)]
    bad = [(f"Word one{i}. You awful{i % 3} thing. Fine day.", 1, 1.0) for i in range(30)]
    return toxicity.fit(clean + bad)


def test_locates_the_sentence(spark):
    frame = spark.createDataFrame([(1, "Fine day. Word one. You awful1 thing\nEnd."), (2, "Fine day.")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in toxicity.scored(frame, example_model()).collect()}
    assert rows[1]["score"] >= toxicity.THRESHOLD > rows[2]["score"]
    (sentence,) = rows[1]["offending"]
    assert (sentence["sentence"], sentence["first_word"], sentence["n_words"]) == (2, 4, 3)
    assert rows[1]["n_sentences"] == 4 and rows[2]["offending"] == []


def test_odd_documents(docs, no_docs):
    rows = toxicity.scored(docs, example_model()).collect()
    assert len(rows) == len(documents())
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in rows if not (r["text"] or "").strip()} == {0.0}
    assert set(docs.columns) <= set(toxicity.scored(docs, example_model()).columns)
    assert toxicity.scored(no_docs, example_model()).count() == 0


def test_labels_of_one_kind_or_none(spark, docs):
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, None)], "doc_id long, toxic int")
    for some in (labels, labels.limit(0)):
        rows = toxicity.scored(docs, toxicity.train(docs, some)).collect()
        assert {r["score"] for r in rows} == {0.0}


def test_noisy_or_of_sentences():
    model = example_model()
    _, _, sums = toxicity._sentences([b"You awful1 thing. You awful2 thing."], np.append(model.weights, 0.0))
    p = 1 / (1 + np.exp(-(sums + model.bias)))
    assert len(p) == 2 and 1 - np.prod(1 - p) > p.max()


def test_repeated_ids_teach_once_and_in_bounds(spark):
    """One id with thousands of equal rows is one text; one id with many texts gives no more than the bound."""
    same = [(1, "You awful thing. Fine day.")] * 3001
    many = [(3, f"Word one{i}. You awful{i} thing.") for i in range(500)]
    clean = [(100 + i, f"Fine day number{i}. Nothing here.") for i in range(200)] + [(None, "You awful"), (4, None)]
    docs = spark.createDataFrame(same + many + clean, "doc_id long, text string").repartition(4)
    labels = [(1, 1), (3, 1), (4, 0), (None, 1), *((100 + i, 0) for i in range(200))]
    taught = []
    own = spark.createDataFrame(labels, "doc_id long, toxic int")
    plain, toxicity.fit = toxicity.fit, lambda rows: taught.append(rows) or plain(rows)
    try:
        toxicity.train(docs, own, positives=50, negatives=60)
        toxicity.train(docs, own, positives=50, negatives=60, most_bytes=700)
        model = toxicity.train(docs, own)
    finally:
        toxicity.fit = plain
    ids = {i for i, _ in labels if i is not None and zlib.crc32(str(i).encode()) % 4 != 2}
    texts = {(y, text) for i, y in labels for doc, text in same + many + clean if doc == i and i in ids}
    for rows, bounds in zip(taught, ((60, 50), (60, 50), (4000, 2000))):
        for y in (0, 1):
            found = [text for text, label, _ in rows if label == y]
            assert 0 < len(found) <= bounds[y] and len(set(found)) == len(found)
            assert {(y, text) for text in found} <= texts
    assert sum(len(t or "") for t, y, _ in taught[1] if y == 1) <= 700
    assert {(y, t) for t, y, _ in taught[2]} == texts
    weights = {y: sum(w for _, label, w in taught[0] if label == y) for y in (0, 1)}
    for y in (0, 1):
        assert abs(weights[y] - sum(label == y for label, _ in texts)) < 1e-6
    scores = {r["text"]: r["score"] for r in toxicity.scored(docs.distinct(), model).collect()}
    assert scores["Word one7. You awful7 thing."] > 0.3 > scores["Fine day number3. Nothing here."]


def test_sentences_against_plain_ones(monkeypatch):
    """Texts, sizes and sums of sentences, from pieces of any size, as words and sentences split one by one give them."""
    texts = [(t or "").encode() for _, t, *_ in documents() if len(t or "") < 5000]
    texts += [b"", b"...", b"One. Two? " + b"x" * 300 + b"! three\x01four", "Ünï\nçødé 漢字 a ab abc abcd".encode(), b"no end"]
    weights = np.append(np.random.default_rng(1).normal(size=toxicity.WEIGHTS), 0.0)

    def of_word(word: str) -> float:
        (own,) = toxicity._words([word.encode()])
        return weights[own.places[:, 0]].sum()

    plain = []
    for number, text in enumerate(texts):
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text.decode())
        for sentence in re.split(r"[.!?\n]", lowered):
            words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", sentence)
            if words:
                plain.append((number, len(words), sum(map(of_word, words))))
    for size in (1 << 20, 64, 1):
        monkeypatch.setattr(toxicity, "PIECE", size)
        found = toxicity._sentences(texts, weights)
        assert found[0].tolist() == [n for n, _, _ in plain] and found[1].tolist() == [n for _, n, _ in plain]
        assert np.allclose(found[2], [total for *_, total in plain])


def test_forms_of_words():
    (own,) = toxicity._words([b"abcdefgh abcdefgh abcdefxx abc ab"])
    whole, more = own.places[:, 0].tolist(), own.places[:, 2].tolist()
    assert own.places[:, 1].tolist() == whole and more[0] != whole[0] and more[1:] == whole[1:]
    assert own.places[1, 3] == whole[1] and (own.places[2:, 3] == toxicity.WEIGHTS).all()
    assert (own.places[1:, 4] == toxicity.WEIGHTS).all() and own.places[0, 4] < toxicity.WEIGHTS
