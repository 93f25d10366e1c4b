import random
import re

import numpy as np
import pyarrow as pa
import pytest

from shelfwise.llm.bulk_words import Texts

WORD = np.zeros(256, bool)
WORD[[ord(c) for c in "abc"]] = True


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("size", [1, 3, 10, 1000])
def test_slices_hold_every_word_once(seed, size):
    rng = random.Random(seed)
    texts = [rng.choice([None, "", "".join(rng.choice("aabc  .") for _ in range(rng.randrange(30)))]) for _ in range(40)]
    column = pa.array(["skipped", *texts])[1:]
    expected = [(i, w) for i, t in enumerate(texts) for w in re.findall("[abc]+", t or "")]
    got, sizes = [], []
    for part in Texts.of(column).slices(~WORD, size):
        words = part.words(WORD[part.data], part.data)
        sizes.append(len(part.data))
        got += zip(part.rows(words.starts).tolist(), [words.distinct[c].as_py().decode() for c in words.codes.tolist()], strict=True)
    assert got == expected
    assert sum(sizes) == sum(len(t or "") for t in texts)
    longest = max(len(w) for _, w in expected)
    assert max(sizes) <= size + longest


def test_no_rows_and_no_bytes():
    assert list(Texts.of(pa.array([], pa.string())).slices(~WORD)) == []
    assert list(Texts.of(pa.array([None, ""], pa.string())).slices(~WORD)) == []
