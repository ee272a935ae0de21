import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from pickwise.llm import words

MASK = (1 << 64) - 1


def one(word):
    """The number of a word, by its definition."""
    total, power = 0, 1
    for byte in word:
        total, power = (total + int(words._BYTE_VALUES[byte]) * power) & MASK, power * words._MULTIPLIER & MASK
    return int(words.mix(np.array([total], np.uint64))[0])


def hashed(texts, is_word=words.SPACED):
    data, offsets = words.utf8(pa.array(texts, pa.string()))
    starts, ends, _ = words.spans(data, offsets, is_word)
    return data, starts, ends, words.hashes(data, starts, ends)


@pytest.mark.parametrize("bound", [1, 7, words.HASHED_BYTES])
def test_hashes_by_definition(monkeypatch, bound):
    monkeypatch.setattr(words, "HASHED_BYTES", bound)
    texts = ["a bc  déf", None, "", "ab", "ab", " " * 3000 + "x" * 2500 + " y ", "bc"]
    data, starts, ends, found = hashed(texts)
    assert found.tolist() == [one(data[a:b].tobytes()) for a, b in zip(starts, ends)]
    assert len(found) == 8
    assert len(hashed([None, " "])[3]) == 0


def test_hashing_keeps_nothing_and_takes_little_memory():
    """Tables as long as the text would stay in every Python worker, eight bytes a character and more."""
    data, offsets = words.utf8(pa.array(["some words of it " * 200_000]))
    starts, ends, _ = words.spans(data, offsets, words.SPACED)
    tracemalloc.start()
    words.hashes(data, starts, ends)
    kept, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert kept < 1 << 20
    assert peak < 16 * len(data)
