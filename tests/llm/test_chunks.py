import random

import numpy as np
import pytest

from loanweave.llm import packing


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(packing.Vocabulary.public())


def test_white_space_around_chunks(encoder):
    rng = random.Random(2)
    letters = ["a", "bc", " ", " ", "\n", "\t", " ", "　", "\x1c", "1", "é", "<|endoftext|>"]
    texts = ["", " ", "a ", " a", "a\n", "a b\n", "a \nb", "a\n b", "a  b"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 10))) for _ in range(3000)]
    for text in texts:
        ids = encoder.whole.encode(text, add_special_tokens=False).ids
        assert encoder.ids(text) == np.array(ids, dtype="<u4").tobytes(), repr(text)


def test_a_chunk_is_looked_at_once(encoder):
    encoder.ids("x kept y")
    assert "kept" in encoder.rest
    before = len(encoder.rest)
    encoder.ids("x kept  y")
    encoder.ids("x kept\n y")
    assert len(encoder.rest) == before
