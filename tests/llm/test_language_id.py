"""Languages of held-out texts, codewords and what is decoded from them."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from conform.llm.language_id import (
    UNKNOWN,
    codewords,
    document_languages,
    fit,
    grams,
    normalised,
)

SCHEMA = "doc_id long, text string, lang string, source string, score double, held_out string"
# Public sentences that everyone may use, a few of each language.
SENTENCES = {
    "de": "der die das und ist nicht ein zu den mit sich von auf für ich wir auch werden",
    "en": "the of and to in is that for it was on are as with his they be at this have from",
    "fr": "le la les et des est que une dans pour qui pas sur plus par avec tout mais nous",
    "it": "il che di per un non sono con una si del della gli anche questo come più nella",
    "es": "el los las que y en un por con no una su para es al lo como más pero sus",
    "pt": "o os as que e do da em um para com não uma se na por mais dos como mas foi",
}


def corpus(names, each=60):
    draw = np.random.default_rng(2)
    rows = []
    for lang in names:
        words = SENTENCES[lang].split()
        for _ in range(each):
            text = " ".join(draw.choice(words, draw.integers(3, 30)))
            rows.append((len(rows), text, lang, "s", 1.0, "h"))
    return rows


@pytest.mark.parametrize("names", [["de", "en"], ["de", "en", "fr", "it"], list(SENTENCES)])
def test_held_out_texts(spark, names):
    rows = corpus(names)
    found = {r.doc_id: r for r in document_languages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(found) == len(rows)
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert {i for i, r in found.items() if r.held_out} == {r[0] for r in held}
    right = sum(found[r[0]].lang_pred == r[2] for r in held)
    assert right >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 and r.lang_pred in names for r in found.values())


def test_awkward_rows(spark):
    rows = corpus(["de", "en"]) + [
        (1000, None, "de", "s", 1.0, "h"),
        (1001, "", "de", "s", 1.0, "h"),
        (1002, "123 ?! ①½ \U0001f600", "en", "s", 1.0, "h"),
        (1003, "the and of to", None, "s", 1.0, "h"),
        (None, "die und das ist nicht", None, "s", 1.0, "h"),
        (1005, "die und das ist nicht " * 50_000, "de", "s", 1.0, "h"),
        (1005, "die und das ist nicht", "de", "s", 1.0, "h"),
        (1006, "7" * 1_000_000, "de", "s", 1.0, "h"),
    ]
    found = document_languages(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append(r)
    for i in (1000, 1001, 1002, 1006):
        assert [(r.lang_pred, r.score) for r in by_id[i]] == [(UNKNOWN, 0.0)]
    assert by_id[1003][0].lang_pred == "en"
    assert by_id[None][0].lang_pred == "de" and by_id[None][0].held_out is False
    assert [r.lang_pred for r in by_id[1005]] == ["de", "de"]


def test_languages_are_no_input_of_a_prediction(spark):
    rows = corpus(["de", "en"])
    held = [r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    other = [
        (*r[:2], "xx", "other", 2.0, "h") if r[0] in held else r for r in rows
    ]
    one, two = (
        sorted(map(str, document_languages(spark.createDataFrame(x, SCHEMA)).collect()))
        for x in (rows, other)
    )
    assert one == two


def test_nothing_or_one_language_to_learn(spark):
    rows = corpus(["de"], 8)
    found = document_languages(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("de", 1.0)}
    nothing = [(*r[:2], None, *r[3:]) for r in rows]
    found = document_languages(spark.createDataFrame(nothing, SCHEMA)).collect()
    assert {(r.lang_pred, r.score) for r in found} == {(UNKNOWN, 0.0)}


@pytest.mark.parametrize("languages", [2, 3, 4, 5, 6, 9, 40, 200])
def test_codewords_lie_apart(languages):
    words = codewords(languages)
    apart = [(a != b).sum() for n, a in enumerate(words) for b in words[:n]]
    bits = words.shape[1]
    # A few languages: half of all ways to part them tell any two apart.
    least = 1 << (languages - 2) if languages <= 5 else bits // 5
    assert min(apart) >= least
    assert all(len(set(column)) == 2 for column in words.T)
    assert (codewords(languages) == words).all()


def test_wrong_bits_are_corrected():
    """With one classifier turned round the nearest codeword is still the right one."""
    texts = [(r[1], r[2]) for r in corpus(["de", "en", "es", "fr", "it"])]
    languages = ["de", "en", "es", "fr", "it"]
    vectors = np.stack([grams(normalised(t)) for t, _ in texts])
    owners = np.array([languages.index(lang) for _, lang in texts])
    model = fit(vectors, owners, languages)
    for bit in range(model.words.shape[1]):
        weights, offsets = model.weights.copy(), model.offsets.copy()
        weights[:, bit] *= -1
        offsets[bit] *= -1
        turned = type(model)(languages, model.words, weights, offsets, model.trust)
        found = turned.identify([t for t, _ in texts])
        assert np.mean([f[0] == lang for f, (_, lang) in zip(found, texts)]) > 0.95


def test_a_mixed_text_is_ambiguous():
    texts = [(r[1], r[2]) for r in corpus(["de", "en", "fr"])]
    languages = ["de", "en", "fr"]
    vectors = np.stack([grams(normalised(t)) for t, _ in texts])
    model = fit(vectors, np.array([languages.index(lang) for _, lang in texts]), languages)
    mixed = f"{SENTENCES['de']} {SENTENCES['en']}"
    plain, both = model.identify([SENTENCES["de"], mixed])
    assert plain[0] == "de" and not plain[3]
    assert {both[0], both[2]} == {"de", "en"} and both[1] < plain[1]
