import re
import tracemalloc
import zlib

import pyarrow as pa

from conftest import documents
from tidemark.llm import language_id
from tidemark.llm.shared import held_out


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.predicted(docs, language_id.train(docs))
    rows = rows.filter(held_out()).join(docs.select("doc_id", "lang"), "doc_id").collect()
    right = [r["lang_pred"] == r["lang"] for r in rows]
    families = [r["family"] == language_id.family_of(r["lang"]) for r in rows]
    assert sum(right) > 0.95 * len(right) and sum(families) > 0.95 * len(families)
    assert all(0 <= r["score"] <= 1 for r in rows)


def example_model(languages=("en", "de", "fr", "es", "xx")):
    words = {
        "en": "the house with water and winter things",
        "de": "das haus mit wasser und winter dinge ß",
        "fr": "la maison avec de l'eau où été choses",
        "es": "la casa con agua y niño cosas año",
        "xx": "qzq zzq qqz zqz",
    }
    return language_id.fit([(words[name] + " " + words[name][i:], name) for name in languages for i in range(8)])


def test_families_and_pairs():
    model = example_model()
    assert model.languages == {"germanic": ["de", "en"], "romance": ["es", "fr"], "xx": ["xx"]}
    assert set(model.families) == {"germanic", "romance", "xx"} and set(model.pairs) == {("de", "en"), ("es", "fr")}
    one = example_model(("en", "de"))
    assert not one.families and set(one.pairs) == {("de", "en")}


def test_plain_score_of_one_text():
    model = example_model()
    names, scores, families = language_id._Classifier(model)(["das wasser und das haus", "la casa con agua"])
    assert names == ["de", "es"] and families == ["germanic", "romance"] and (scores > 0.5).all()


def test_odd_documents(docs, no_docs):
    rows = language_id.predicted(docs, example_model()).collect()
    assert len(rows) == len(documents())
    texts = {doc_id: text for doc_id, text, *_ in documents() if doc_id is not None}
    for row in rows:
        if row["doc_id"] is not None:
            lettered = re.search(r"[^\W\d_]", texts[row["doc_id"]] or "") is not None
            assert (row["lang_pred"] == "und") == (not lettered)
            assert (row["score"] == 0) == (not lettered)
    assert language_id.predicted(no_docs, example_model()).count() == 0


def test_nothing_learned(docs, no_docs):
    model = language_id.train(no_docs)
    assert {r["lang_pred"] for r in language_id.predicted(docs, model).collect()} == {"und"}


def test_repeated_ids_teach_once_and_in_bounds(spark):
    """Thousands of rows of one id are learned from, equal ones once, up to the bounds; rare languages are left out."""
    kept = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(kept[0], f"the house number{chr(97 + i % 26)}{chr(97 + i // 26)} with water", "en") for i in range(600)]
    rows += [(kept[1], "das haus mit wasser", "de")] * 3000
    rows += [(i, f"das wasser und {'winter ' * i}", "de") for i in kept[2:]]
    rows += [(kept[3], "la maison", "fr"), (kept[4], None, "fr"), (None, "null id", "fr"), (kept[5], "no lang", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    taught = []
    plain, language_id.fit = language_id.fit, lambda found: taught.append(found) or plain(found)
    try:
        language_id.train(docs, per_language=40)
        language_id.train(docs, per_language=40, most_bytes=1600, languages=2)
        language_id.train(docs)
    finally:
        language_id.fit = plain
    assert all(len(set(found)) == len(found) for found in taught)
    sizes = [{name: sum(one == name for _, one in found) for name in ("en", "de", "fr")} for found in taught]
    assert sizes[0] == {"en": 40, "de": min(40, len(kept) - 1), "fr": 1}
    assert 0 < sizes[1]["en"] <= 40 and sizes[1]["fr"] == 0
    for name in ("en", "de"):
        assert sum(len(text) for text, one in taught[1] if one == name) <= 1600
        assert all(len(text) <= 100 for text, one in taught[1])
    assert sizes[2] == {"en": 500, "de": len(kept) - 1, "fr": 1}


def test_memory_of_a_large_batch():
    """A task's memory depends on a part of its batch: texts are not all made Python strings at once."""
    classifier = language_id._Classifier(example_model())
    text = "das haus mit wasser und winter dinge " * 50
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(10_000)), "text": [None, "", *[text] * 9_998]})
    tracemalloc.start()
    found = language_id._classified(batch, classifier)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < batch.nbytes and batch.nbytes > 18e6
    assert found.column("lang_pred").to_pylist() == ["und"] * 2 + ["de"] * 9_998
