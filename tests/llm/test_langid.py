import random

import pytest

from seqloom.llm import langid

WORDS = {
    "en": "the house with river and morning every opens quiet window under small bridge because nothing shows".split(),
    "de": "das haus mit fluss und morgen jeder öffnet ruhig fenster unter kleine brücke weil nichts zeigt".split(),
    "pl": "ten dom przez rzeka oraz ranek każdy otwiera cichy okno pod mały most ponieważ nic pokazuje".split(),
}
LANGS = [("en", "eng", "English"), ("de", "deu", "German"), ("pl", "pol", "Polish")]


def text(rng, lang, letters):
    out = ""
    while len(out) < letters:
        out += " ".join(rng.choice(WORDS[lang]) for _ in range(9)).capitalize() + ". "
    return out.strip()


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(60):
        lang = LANGS[i % 3][0]
        docs.append((i, text(rng, lang, 500), lang))
        labels.append((i, lang))
    case = {
        100: (text(rng, "en", 400), "eng"),
        101: (text(rng, "en", 400), "German"),
        102: (text(rng, "de", 400), "DE_at"),
        103: (text(rng, "de", 900) + "\n" + text(rng, "pl", 500), "de"),
        104: (text(rng, "de", 900) + "\n" + text(rng, "pl", 120), "de"),
        105: (text(rng, "pl", 300), None),
        106: (None, "en"),
        107: ("", None),
        108: ("".join(rng.choice("ACGT") for _ in range(700)), None),
        109: ("12345 67890 " * 50, "xx"),
        110: (text(rng, "de", 500).encode().decode("latin-1"), "de"),
        111: (text(rng, "de", 300).upper(), "und"),
        112: (text(rng, "en", 15000), "EN-GB"),
    }
    docs += [(i, t, lang) for i, (t, lang) in case.items()]
    spark_docs = spark.createDataFrame(docs + docs[-5:], "doc_id bigint, text string, lang string")
    return spark_docs, spark.createDataFrame(labels, "doc_id bigint, lang string"), spark.createDataFrame(LANGS, "lang string, lang3 string, lang_name string")


def test_cases(tables):
    docs, labels, languages = tables
    got = [tuple(r) for r in langid.wrong_labels(langid.document_languages(docs, labels, languages)).collect()]
    assert sorted(got) == [(101, "en"), (103, "de"), (103, "pl"), (105, "pl"), (111, "de")]


def test_passages_and_confidence(tables):
    docs, labels, languages = tables
    rows = langid.passage_languages(docs, labels, languages).filter("doc_id = 103").orderBy("passage").collect()
    assert [r.lang for r in rows] == ["de", "pl"]
    assert abs(rows[0].end - 900) < 120 and all(r.confidence > 0.1 for r in rows)


def test_delivered_labels_stand_in_for_missing_hand_checked_ones(tables, spark):
    docs, labels, languages = tables
    model = langid.train(labels.filter("lang <> 'pl'"), docs, languages)
    assert "pl" in model.langs
    rng = random.Random(7)
    assert langid.languages_of(model.passages(text(rng, "pl", 400)))[0][0] == "pl"


@pytest.fixture(scope="module")
def held_out(spark):
    """A model of half of the hand-checked documents, and the other half."""
    folder = "/root/testdata/sf0.1"
    docs, labels, languages = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "lang_labels", "languages"))
    model = langid.train(labels.filter("doc_id % 2 = 0"), docs.select("doc_id", "text", "lang"), languages)
    return model, labels.filter("doc_id % 2 = 1").join(docs.select("doc_id", "text"), "doc_id").distinct().collect()


def test_held_out_accuracy(held_out):
    model, rest = held_out
    right = {r.doc_id: [x for x, _ in langid.languages_of(model.passages(r.text))] == [r.lang] for r in rest}
    assert sum(right.values()) / len(rest) > 0.97
    for lang in {r.lang for r in rest}:
        own = [right[r.doc_id] for r in rest if r.lang == lang]
        assert sum(own) >= 0.9 * len(own) - 1, lang


def test_held_out_passages(held_out):
    """Two texts after each other: nearly all letters lie in a passage of their language."""
    model, rest = held_out
    rng, texts = random.Random(1), [r for r in rest if r.text and len(r.text) >= 400]
    right = total = whole = 0
    for _ in range(60):
        a = rng.choice(texts)
        b = rng.choice([r for r in texts if r.lang != a.lang])
        cut = len(langid.repaired(a.text))
        found = model.passages(a.text + "\n" + b.text)
        for start, end, lang, confidence, _ in found:
            assert 0 <= confidence < 1
            for want, n in ((a.lang, min(end, cut) - start), (b.lang, end - max(start, cut))):
                total += max(0, n)
                right += max(0, n) * (lang == want)
        whole += {x for x, _ in langid.languages_of(found)} == {a.lang, b.lang}
    assert right > 0.97 * total and whole >= 57


def test_the_sample_is_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_BYTES", 3200)
    docs = spark.createDataFrame([(i, "ä" * (90 if i else 5000)) for i in range(50)], "doc_id bigint, text string")
    labels = docs.select("doc_id").selectExpr("doc_id", "if(doc_id % 2 = 0, 'de', 'sv') as lang")
    sample = langid._sample(labels, docs)
    assert all(0 < sum(len(t.encode()) for t in texts) <= 3200 for texts in sample.values()) and max(len(t) for texts in sample.values() for t in texts) <= 100


def test_empty(tables, spark):
    _, labels, languages = tables
    none = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert langid.document_languages(none, labels, languages).collect() == []


def test_repair_and_sentences():
    assert langid.repaired("Ã¤ und Ð¡Ñ‚ und Ä") == "ä und Ст und Ä"
    t = "One. Two!\nThree " + "x" * 1000
    spans = langid.sentences(t)
    assert "".join(t[a:b] for a, b in spans).replace(" ", "") == t.replace("\n", "").replace(" ", "") and max(b - a for a, b in spans) <= langid.UNIT
