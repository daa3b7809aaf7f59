import pickle
import re
import zlib

import numpy as np
import pytest
from llm import edge
from pyspark.sql import functions as F

from devicewatch.llm import langid, toxicity
from devicewatch.llm.queries import QUERIES
from devicewatch.llm.shared import PLACES, places

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    got = QUERIES["op4_language_id"](spark, SF).join(docs, "doc_id").collect()
    assert len(got) == docs.count()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97


@pytest.mark.parametrize("clash", [False, True])
def test_language_edge_rows(spark, clash):
    docs = edge.documents(spark, clash=clash)
    model = langid.fit(docs, settings=langid.Settings(epochs=1))
    assert model.languages == ("en", "fr")
    got = docs.withColumn("found", langid.identify("text", model)).collect()
    assert len(got) == len(edge.texts())
    for r in got:
        letters = r["text"] is not None and any(map(str.isalpha, r["text"]))
        assert (r["found"]["lang"] == "und") == (not letters)
        assert letters or (r["found"]["score"] == 0 and not r["found"]["accepted"])


def test_language_without_labels(spark):
    docs = edge.documents(spark, [])
    model = langid.fit(docs)
    assert docs.withColumn("found", langid.identify("text", model)).count() == 0
    one = edge.documents(spark, [(1, "abc")]).withColumn("f", langid.identify("text", model))
    assert one.collect()[0]["f"]["lang"] == "und"


def test_samples_of_any_number_of_rows():
    for there in (0, 1, 2000, 2_000_000_001, 10 ** 12, 10 ** 18):
        share = places(2000, there)
        assert 1 <= share <= PLACES
        assert there <= 2000 or 1900 < share * there / PLACES < 2100
    assert places(1, 10 ** 30) == 1


def test_too_many_languages_and_an_empty_sample_are_errors(spark, monkeypatch):
    docs = edge.documents(spark)
    with pytest.raises(ValueError):
        langid.fit(docs, settings=langid.Settings(languages=1))
    monkeypatch.setattr(langid, "places", lambda wanted, there: 0)
    with pytest.raises(RuntimeError):
        langid.fit(docs)


def test_chunks_do_not_change_the_mean(monkeypatch):
    model = langid.train(["abc def", "xyz uvw"] * 10, ["a", "b"] * 10)
    text = edge.words(3, 500)
    whole = model.probabilities(text)
    monkeypatch.setattr(langid, "_CHUNK", 64)
    assert np.allclose(whole, model.probabilities(text), atol=1e-6)


def test_toxicity_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = QUERIES["op8_toxicity"](spark, SF)
    rows = got.join(labels, "doc_id").collect()
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == r["toxic"] for r in held]) > 0.9
    assert np.mean([r["predicted"] for r in rows if not r["toxic"]]) < 0.05


def toxic_table(spark, clash):
    rows = [(k, f"{edge.words(k, 30)} {'nasty awful' if k % 4 == 0 else 'fine'} "
                f"{edge.words(-k, 9)}") for k in range(400)] + [(1000, None), (1001, "")]
    rows += [(1002, "nasty awful"), (1002, "fine day"), (None, "nasty awful")]
    labels = spark.createDataFrame(
        [(k, int(k % 4 == 0), "x") for k in range(300)] + [(None, 1, "x"), (5, None, "x"),
                                                           (1001, 0, "x"), (4, 1, "x")],
        "doc_id long, toxic int, vector string")
    return edge.documents(spark, rows, clash=clash), labels, rows


@pytest.mark.parametrize("clash", [False, True])
def test_toxicity_edge_rows(spark, clash):
    docs, labels, rows = toxic_table(spark, clash)
    model, vectors = toxicity.fit(docs, labels)
    got = toxicity.score(vectors, model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["score"] <= 1
        if r["id"] is not None and r["id"] < 400:
            assert (r["score"] >= 0.5) == (r["id"] % 4 == 0)
        if r["id"] in (1000, 1001):
            assert r["score"] < 0.5 and not r["evidence"]
    assert all(e["toxic"] == 1 and e["cosine"] <= 1 for r in got if r["id"] == 8
               for e in r["evidence"])


def test_toxicity_without_documents_or_labels(spark):
    docs, labels, _ = toxic_table(spark, False)
    model, vectors = toxicity.fit(docs, labels.where("false"))
    assert all(r["score"] < 0.5 for r in toxicity.score(vectors, model).collect())
    model, vectors = toxicity.fit(docs.where("false"), labels)
    assert toxicity.score(vectors, model).count() == 0


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(2)
    for trial in range(30):
        dense = rng.random((150, 40)) * (rng.random((150, 40)) < 0.15)
        dense[::7] = dense[3]  # ties
        idf = rng.random(40) + 0.5
        units = [toxicity.unit(np.nonzero(d)[0].tolist(), np.ceil(d[d > 0] * 5).tolist(), idf)
                 for d in dense]
        index = toxicity.Index(units, 8)
        full = np.zeros((150, 40))
        for k, (at, w) in enumerate(units):
            full[k, at] = w
        for q in range(0, 150, 11):
            got = index.nearest(*units[q], 10)
            cosine = full @ full[q]
            best = sorted([(-c, k) for k, c in enumerate(cosine) if c > 0])[:10]
            assert np.allclose([s for s, _ in got], [-c for c, _ in best])
            assert {e for s, e in got if s > -best[-1][0] + 1e-9} == {
                k for c, k in best if -c > -best[-1][0] + 1e-9}


def test_toxicity_searches_all_words_of_all_examples(spark):
    """Words that lean to no class, or stand in one text only, count in the cosine as well."""
    rows = [(k, f"{edge.words(k, 12)} common rare{k}x") for k in range(60)]
    rows += [(100, rows[7][1]), (101, "quite unseen rare7x"), (102, "unseen elsewhere")]
    labels = spark.createDataFrame([(k, int(k % 6 == 0)) for k in range(60)],
                                   "doc_id long, toxic int")
    model, vectors = toxicity.fit(edge.documents(spark, rows), labels)
    assert len(model.ids) == 60 and (model.toxic == 0).sum() == 50
    got = {r["id"]: r for r in toxicity.score(vectors, model).collect()}
    counts = []
    for _, text in rows:
        terms = [t for w in text.split() for t in toxicity.word_terms(w)]
        counts.append({t: terms.count(t) for t in terms})
    n = {t: sum(t in c for c in counts) for c in counts for t in c}
    whole = [{t: (1 + np.log(k)) * (np.log((1 + len(rows)) / (1 + n[t])) + 1)
              for t, k in c.items()} for c in counts]
    norm = [sum(w * w for w in v.values()) ** 0.5 for v in whole]
    for q, (id_, _) in enumerate(rows):
        cosine = [sum(w * whole[k].get(t, 0) for t, w in whole[q].items()) / norm[q] / norm[k]
                  for k in range(60)]
        best = sorted([(-c, k) for k, c in enumerate(cosine) if c > 0])[:3]
        assert np.allclose([e["cosine"] for e in got[id_]["evidence"]], [-c for c, _ in best])
    assert got[100]["evidence"][0]["id"] == 7 and got[101]["evidence"][0]["id"] == 7
    assert not got[102]["evidence"]


def test_scores_are_the_calibrated_vote_of_the_nearest():
    """The vote over all cosines, taken one by one, through the chances of the calibration."""
    rng = np.random.default_rng(4)
    idf = rng.random(50).astype(np.float32) + 1
    examples = []
    for k in range(200):
        at = np.sort(rng.choice(48, 9, replace=False)) if k % 3 else np.unique(
            np.append(rng.choice(48, 8, replace=False), [48, 49]))
        examples.append((k, int(k % 3 == 0), at, rng.integers(1, 4, len(at))))
    settings = toxicity.Settings(nearest=20, block=8)
    model = pickle.loads(pickle.dumps(toxicity.train(examples, {0: 900, 1: 67}, idf, settings)))
    assert (np.diff(model.chances[1]) >= 0).all() and (np.diff(model.chances[0]) >= 0).all()
    full = np.zeros((200, 50))
    for k, (_, _, at, n) in enumerate(examples):
        full[k, at] = toxicity.unit(at, n, idf)[1]
    right = 0
    for k, (score, evidence) in enumerate(model.scores([e[2:] for e in examples])):
        cosine = full @ full[k]
        best = sorted([(-c, e) for e, c in enumerate(cosine) if c > 0])[:20]
        votes = [0.1 * w / model.weight.sum() for w in model.weight]
        for c, e in best:
            votes[e % 3 == 0] -= model.weight[int(e % 3 == 0)] * c
        assert np.isclose(score, np.interp(np.log(votes[1] / votes[0]), *model.chances), atol=1e-6)
        assert np.allclose([s for _, s, _ in evidence], [-c for c, _ in best[:3]])
        assert all(t == (i % 3 == 0) for i, _, t in evidence)
        right += (score >= 0.5) == (k % 3 == 0)
    assert right > 190


def test_chances_never_fall():
    x = np.array([0.0, 1, 1, 2, 3, 4])
    at, p = toxicity._monotone(x, np.array([0, 1, 0, 0, 1, 1]), np.ones(6))
    assert np.allclose(np.interp(x, at, p), [0, 1 / 3, 1 / 3, 1 / 3, 1, 1])
    at, p = toxicity._monotone(np.ones(3), np.array([0, 1, 1]), np.array([2.0, 1, 1]))
    assert np.allclose(np.interp([0, 1, 2], at, p), 0.5)


@pytest.mark.parametrize("space", [1, 97, 1 << 21])
def test_terms_of_many_texts_are_made_together(space):
    """As term by term: any letters, words around the lengths of beginnings and of long words."""
    texts = ["", " \n", "a", "one  two\x00three a_b a_b", "Σίσυφος ΟΔΟΣ straße İstanbul", "日本語テキスト 🙂ab🙂cdefgh",
             "z" * 4 + " " + "z" * 5 + " " + "Z" * 6, "x" * 32 + " " + "y" * 33, "é" * 16 + " " + "é" * 500, ""]
    for (at, counts), text in zip(toxicity.text_vectors(texts, space), texts, strict=True):
        terms = [zlib.crc32(t.encode()) % space for w in re.findall(r"\w+", text.lower())
                 for t in toxicity.word_terms(w)]
        assert at.tolist() == sorted(set(terms))
        assert counts.tolist() == [terms.count(t) for t in at.tolist()]


def test_lists_of_any_length_are_added_up():
    """Long posting lists are copied whole, short ones picked: both, and unknown terms, count."""
    rng = np.random.default_rng(6)
    dense = rng.random((3000, 60)) < np.linspace(0.0005, 0.15, 60)
    idf = np.ones(90)
    units = [toxicity.unit(np.nonzero(d)[0], np.ones(int(d.sum())), idf) for d in dense]
    index = toxicity.Index([u for u in units if len(u[0])], 64)
    full = np.array([d / max(1, d.sum()) ** 0.5 for d in dense if d.any()])
    sizes = np.diff(index.stops, prepend=0)
    assert (sizes >= toxicity._SLICED).any() and ((sizes > 0) & (sizes < toxicity._SLICED)).any()
    for q in range(0, 3000, 200):
        at, _ = units[q]
        at, weight = toxicity.unit(np.append(at, [70, 85]), np.ones(len(at) + 2), idf)
        cosine = np.sort(full @ np.bincount(at, weight, 90)[:60])[::-1][:20]
        got = np.array([c for c, _ in index.nearest(at, weight, 20)])
        assert np.allclose(got, cosine[cosine > 0], atol=1e-6)


def test_a_long_text_has_the_terms_of_its_pieces(spark, monkeypatch):
    text = " ".join(f"Wörter{k % 91} ΟΔΟΣ x{k} \n" for k in range(900))
    at, counts = toxicity.text_vectors([text], 1 << 21)[0]
    found = spark.createDataFrame([(1, "ab"), (2, text * 40), (3, "cd ef")], "id long, text string").coalesce(1)
    got = {r["id"]: toxicity.unpacked(r["vector"]) for r in found.select(
        "id", toxicity.term_vector("text", 1 << 21).alias("vector")).collect()}
    assert len(text) * 40 > toxicity._CHARACTERS
    assert (got[2][0] == at).all() and (got[2][1] == 40 * counts).all()
    assert len(got[1][0]) == 1 and len(got[3][0]) == 2
    monkeypatch.setattr(toxicity, "_CHARACTERS", 50)
    cut = toxicity.long_text_vector(text, 1 << 21)
    assert (cut[0] == at).all() and (cut[1] == counts).all()
    assert not len(toxicity.long_text_vector("", 1 << 21)[0])
