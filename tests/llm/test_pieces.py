"""Texts are worked on in small pieces, with the results of whole shards."""

import numpy as np
import pyarrow as pa

from riskweave.llm import langid, language_model


def test_a_shard_in_pieces_is_the_shard(monkeypatch):
    texts = ["b a B", None, "", "a c\x0ba", "\u00e9 d", "c  b", "  "]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    places, words, sizes = language_model._numbered(batch)
    monkeypatch.setattr(language_model, "PIECE_BYTES", 4)
    few, same_words, same_sizes = language_model._numbered(batch)
    assert words.to_pylist() == same_words.to_pylist() == [b"b", b"a", b"c", "\u00e9".encode(), b"d"]
    assert places.tolist() == few.tolist() == [0, 1, 0, 1, 2, 1, 3, 4, 2, 0]
    assert sizes.tolist() == same_sizes.tolist() == [3, 0, 0, 3, 2, 2, 0]
    empty = language_model._numbered(batch.slice(1, 2))
    assert len(empty[0]) == len(empty[1]) == 0 and empty[2].tolist() == [0, 0]


def test_prediction_takes_small_pieces(monkeypatch):
    seen = []

    def predict(texts, model):
        seen.append(sum(len(x) for x in texts.to_pylist()))
        n = len(texts)
        return langid.Prediction(["en"] * n, np.ones(n), np.ones((n, 1)), np.ones(n), np.zeros(n + 1, int), np.zeros(0, int))

    monkeypatch.setattr(langid, "predict", predict)
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 500_000] * 9)], names=["text"])
    assert sum(b.num_rows for b in langid._accept(None, 0, 0.5)([batch])) == 9
    assert max(seen) <= langid.PREDICT_BYTES == 1 << 20
