"""Language identification: gradients, long texts, many languages."""

from __future__ import annotations

import numpy as np

from callsheet.llm import langid


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(1)
    net = langid.train([b"abc def", "äöü ß".encode(), b"xyz"], ["a", "b", "c"], steps=3, rows=8)
    data, mask = rng.integers(60, 70, (6, langid.WINDOW)).astype(np.uint8), np.ones((6, langid.WINDOW), np.float32)
    mask[0, 10:] = 0
    label = rng.integers(3, size=6)
    _, grads = langid.gradients(net, data, label, mask)
    for p, g in zip(net.parameters(), grads):
        flat, step = np.argsort(-np.abs(g).ravel())[:3], 1e-2
        for at in flat:
            old = p.ravel()[at]
            p.ravel()[at] = old + step
            up, _ = langid.gradients(net, data, label, mask)
            p.ravel()[at] = old - step
            down, _ = langid.gradients(net, data, label, mask)
            p.ravel()[at] = old
            slope = (up - down) / (2 * step)
            assert abs(slope - g.ravel()[at]) <= 0.1 * abs(g.ravel()[at]) + 2e-3


def test_languages_with_long_texts_only_are_learned(spark):
    rng = np.random.default_rng(2)
    make = lambda words, n: " ".join(rng.choice(words, n))
    words = {"en": ["the", "and", "with", "house", "which"], "de": ["der", "und", "mit", "haus", "welche"], "ru": ["это", "дом", "который", "был"]}
    rows = []
    for i in range(240):
        lang = ("en", "de", "ru")[i % 3]
        rows.append((i, make(words[lang], 20_000 if lang == "ru" and i < 60 else 40), lang if lang != "ru" or i < 60 else None, lang))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, truth string")
    got = {r.doc_id: r.lang_pred for r in langid.identify(frame).collect()}
    right = [got[i] == t for i, _, _, t in rows]
    assert np.mean(right) > 0.95 and np.mean([ok for ok, r in zip(right, rows) if r[3] == "ru"]) > 0.9


def test_sample_is_the_same_however_it_is_cut(spark):
    """The hash threshold before the ranking changes nothing: with and without it the first by hash are taken."""
    rows = [(i, f"text {i}", "en" if i % 10 else "de") for i in range(5000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    train, langid.train = langid.train, lambda texts, labels, steps: seen.append(sorted(zip(labels, texts)))
    try:
        langid.learn(frame, per_language=50)
        langid.learn(frame.repartition(3), per_language=50)
    finally:
        langid.train = train
    assert seen[0] == seen[1] and [sum(lab == x for lab, _ in seen[0]) for x in ("de", "en")] == [50, 50]
