import numpy as np
import pyarrow as pa
import pytest

from tristar.llm.toxicity import DISCOUNTED, PLAIN, TARGETED, Grammar, _hash_words


@pytest.mark.parametrize("word", ["isn't", "Don't", "aren't", "won't", "isn’t", "DON’T"])
def test_contractions_negate(word):
    grammar = Grammar({int(_hash_words(["idiot"])[0]): 2.0})
    got = grammar.features(pa.array([f"that {word} an idiot", "n", "'t an idiot", "I'd t idiot",
                                     f"you {word} kill", None]))
    assert np.flatnonzero(got[0]).tolist() == [DISCOUNTED]
    assert np.flatnonzero(got[2]).tolist() == [PLAIN] == np.flatnonzero(got[3]).tolist()
    assert np.flatnonzero(got[4]).tolist() == [DISCOUNTED] != [TARGETED] and not got[5].any()
