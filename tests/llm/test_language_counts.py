"""The language model counts every labelled document."""

import numpy as np

from tallyhouse.llm import langid


def test_every_document_is_trained_on(spark):
    """Each of 3,000 documents, twice what was once sampled, brings a word of its own."""
    words = ["".join(chr(97 + i // 26 ** k % 26) for k in range(3)) for i in range(3000)]
    docs = spark.createDataFrame([(i, w, "xx") for i, w in enumerate(words)], "doc_id long, text string, lang string")
    model = langid.train(docs, calibration=0.0)
    codes = np.array([langid.letters_of(w)[-langid.ORDER:] for w in words], np.uint32)
    assert np.isin(langid._fold(list(codes.T)), model.orders[-1].grams).all()


def test_grams_stay_within_texts_of_any_alphabet():
    for letters in (range(97, 100), range(0x4E00, 0x4E00 + 70_000)):
        draw = np.random.default_rng(1)
        texts = [np.concatenate([np.full(langid.ORDER - 1, 32), draw.choice(list(letters), n)]).astype(np.uint32) for n in (0, 1, 5, 3000)]
        texts.append(np.concatenate([np.full(langid.ORDER - 1, 32), np.array(list(letters))]).astype(np.uint32))
        found, number = langid._distinct_grams(texts)
        plain = np.concatenate([np.lib.stride_tricks.sliding_window_view(t, langid.ORDER) for t in texts if len(t) >= langid.ORDER])
        expected, times = np.unique(plain, axis=0, return_counts=True)
        assert (found == expected).all() and (number == times).all()
