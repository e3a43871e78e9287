from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from cartwise.llm import centroids as C

SAMPLE = {
    "en": "the thing that she had with them was not there when they came back from the house",
    "de": "der mann und die frau sind nicht mit dem kind über die straße nach hause gegangen",
    "fr": "la maison était près de la rivière où les enfants jouaient avec leurs amis après",
}


def documents(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(300):
        lang = sorted(SAMPLE)[i % 3]
        words = SAMPLE[lang].split()
        rows.append((i, " ".join(rng.choice(words, rng.integers(4, 40))), lang))
    rows += [(900, None, "en"), (901, "12 34", "de"), (902, "", None), (903, "中文 漢字" * 5, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_rows_are_predicted_and_strangers_rejected(spark):
    docs = documents(spark)
    rows = {r["doc_id"]: r for r in C.identify(docs, C.fit(docs)).collect()}
    right = [rows[i]["lang_pred"] == sorted(SAMPLE)[i % 3] for i in range(300)]
    assert np.mean(right) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert [rows[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3
    assert all(rows[i]["rejected"] for i in (900, 901, 902, 903))
    assert not any(rows[i]["rejected"] for i in range(300))
    assert rows[903]["lang_pred"] in SAMPLE


def test_training_leaves_held_out_rows_alone(spark):
    docs = documents(spark)
    changed = docs.selectExpr(
        "doc_id", "text", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 'xx' ELSE lang END AS lang"
    )
    a, b = C.fit(docs), C.fit(changed)
    assert a.languages == b.languages and np.allclose(a.centroids, b.centroids)


def test_long_texts_are_read_in_parts(monkeypatch):
    text = "Wörter " * 5000
    whole = C.gram_counts(C.letters_of(text))
    monkeypatch.setattr(C, "PART", 1000)
    assert (C.gram_counts(C.letters_of(text)) == whole).all()


def test_awkward_rows(awkward, nothing):
    model = C.fit(awkward)
    out = C.identify(awkward, model)
    assert out.count() == awkward.count()
    kept = C.drop_rejected(awkward)
    assert kept.columns == awkward.columns
    assert {r["doc_id"] for r in kept.collect()}.isdisjoint({3, 4, 5, 8})
    assert C.drop_rejected(nothing).collect() == []
    assert C.identify(awkward, None).where("lang_pred <> 'und'").collect() == []


def brute_score(model, text):
    """Language and cosine by dictionaries of grams, one after the other."""
    letters = [b if b >= 128 or 97 <= b <= 122 else 32 for b in f" {text} ".lower().encode()]
    letters = [b for i, b in enumerate(letters) if not (b == 32 and i and letters[i - 1] == 32)]
    counts = {}
    for n in (1, 2, 3):
        for i in range(len(letters) - n + 1):
            mixed = sum((letters[i + j] + 1) * int(C._TIMES[j]) for j in range(n)) % 2**32
            hashed = mixed * 0x27D4EB2F % 2**32
            hashed ^= hashed >> 15
            place = (hashed * 0x165667B1 % 2**32) >> int(C._SHIFT)
            counts[place] = counts.get(place, 0) + 1
    weights = {p: np.log1p(c) * float(model.idf[p]) for p, c in counts.items()}
    size = sum(w * w for w in weights.values()) ** 0.5
    cosines = [sum(w * float(c[p]) for p, w in weights.items()) / size for c in model.centroids]
    best = max(range(len(cosines)), key=cosines.__getitem__)
    return model.languages[best], max(0.0, min(1.0, cosines[best])), len(letters)


def test_scores_are_those_of_brute_force(spark):
    docs = documents(spark)
    model = C.fit(docs)
    texts = [r["text"] for r in docs.where("doc_id < 60").collect()] + ["Ünïcode, 中文!", "a", "x" * 3000, "é è"]
    for text, lang, cosine, gone in zip(texts, *model.score(texts), strict=True):
        want, score, size = brute_score(model, text)
        floors = model.floors[model.languages.index(want)]
        assert lang == want and abs(cosine - score) < 1e-4
        assert gone == (cosine < floors[sum(size >= n for n in C.LENGTHS)])


def test_unknown_languages_and_junk_are_rejected_and_short_texts_are_not(spark):
    model = C.fit(documents(spark))
    strangers = [
        "Az emberi jogok egyetemes nyilatkozata szerint minden ember szabadnak születik és egyenlő méltósága van",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw",
        "a3f9c2b17e" * 4,
        "xkcd zxqw vbnm qqqq wwww xxxx zzzz vvvv kkkk jjjj",
    ]
    assert model.score(strangers)[2].all()
    assert not model.score(["the", "der mann", "la maison", "they came back", *SAMPLE.values()])[2].any()


def test_clusters_hold_a_share_of_their_rows():
    rng = np.random.default_rng(3)
    bulk = C.unit(rng.normal(size=(300, 8)) * 0.05 + np.eye(8)[0])
    other = C.unit(rng.normal(size=(100, 8)) * 0.05 + np.eye(8)[1])
    outliers = np.eye(8)[[5, 6]]
    rows = np.concatenate([bulk, other, outliers]).astype(np.float32)
    centres = C._clusters(rows, 3)
    held = np.bincount((rows @ centres.T).argmax(axis=1), minlength=len(centres))
    assert (held >= C.LEAST_SHARE * len(rows)).all() and len(centres) >= 2
    assert max((centres @ np.eye(8)[1])) > 0.95 and max((centres @ np.eye(8)[0])) > 0.95


def test_more_labels_than_the_model_takes(spark, monkeypatch):
    monkeypatch.setattr(C, "MOST_LANGUAGES", 2)
    docs = documents(spark).where("lang <> 'fr' OR doc_id < 30")
    assert set(C.fit(docs).languages) == {"de", "en"}


def test_training_rows_are_unpacked_a_few_at_a_time():
    """The driver held several float copies of a language's rows at once."""
    rng = np.random.default_rng(3)
    packed = rng.integers(0, 40, (1500, C.DIMENSIONS), np.uint8)
    packed[7] = 0
    idf = rng.random(C.DIMENSIONS).astype(np.float32) + 1
    whole = C.unit(packed.astype(np.float32) / C.STEPS * idf)
    tracemalloc.start()
    found = C._vectors(packed, idf)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(found, whole)
    assert peak < 1.6 * found.nbytes
    chunks = pa.chunked_array([pa.array([r.tobytes() for r in part], pa.binary()) for part in (packed[:2], [], packed[2:9])])
    assert np.array_equal(C._gathered(chunks), packed[:9])
