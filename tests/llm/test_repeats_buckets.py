"""Refinement of buckets in one process: names that collide remove nothing."""

import random

import numpy as np
import pytest

from chartlake.llm import repeats

LENGTH = 32


def covered(texts):
    """Bytes of each text inside a LENGTH-byte string that starts at another place too."""
    seen = {}
    for t, data in enumerate(texts):
        for i in range(len(data) - LENGTH + 1):
            seen.setdefault(data[i:i + LENGTH], []).append((t, i))
    return {(t, k) for at in seen.values() if len(at) > 1 for t, i in at for k in range(i, i + LENGTH)}


def refined(texts):
    """The same through anchors and buckets, as the tasks do it."""
    reach, rows = LENGTH - LENGTH // 4, []
    for t, data in enumerate(texts):
        if len(data) >= LENGTH:
            at, names, weights = repeats.anchors(np.frombuffer(data, np.uint8), LENGTH)
            for p, h, w in zip(at.tolist(), names.tolist(), weights.tolist(), strict=True):
                rows.append((h, w, t, 0, max(0, p - reach), data[max(0, p - reach):p + LENGTH]))
    rows.sort(key=lambda x: x[0])
    found = set()
    for t, _, a, b in repeats._repeated(rows, LENGTH) if rows else []:
        assert b - a >= LENGTH
        found |= {(t, k) for k in range(a, min(b, len(texts[t])))}
    return found


def some_texts(r):
    bits = ["".join(r.choice("abc"[:r.randrange(2, 4)]) for _ in range(r.randrange(5, 60))) for _ in range(5)]
    return list(dict.fromkeys("".join(r.choice(bits) for _ in range(r.randrange(1, 9))).encode() for _ in range(8)))


@pytest.mark.parametrize("values", [None, 1, 2, 5, 1000])
def test_buckets_are_refined_to_equal_bytes(monkeypatch, values):
    plain = repeats.gram_names
    if values:  # so few names that strings of different bytes share them
        monkeypatch.setattr(repeats, "gram_names", lambda *a: plain(*a) % np.uint64(values))
    r = random.Random(values or 0)
    for _ in range(60):
        texts = some_texts(r)
        assert refined(texts) == covered(texts)


def test_two_sets_of_names_are_independent():
    data = np.frombuffer(random.Random(1).randbytes(5000), np.uint8)
    one, two = repeats.string_names(data, LENGTH), repeats.string_names(data, LENGTH, 1)
    assert len(one) == len(two) == 5000 - LENGTH + 1
    assert not (one == two).any() and len(np.unique(one)) == len(np.unique(two)) == len(one)
