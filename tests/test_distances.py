import random

import numpy as np

from tallyloom.functions import wer


def table(a, b):
    d = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        d.append([i])
        for j, y in enumerate(b, 1):
            d[i].append(min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (x != y)))
    return d[-1][-1]


def marks(a, b):
    """By the whole table, cell by cell."""
    left, right = a.lower().split(), b.lower().split()
    best = np.zeros((len(left) + 1, len(right) + 1), int)
    for i in range(len(left) - 1, -1, -1):
        for j in range(len(right) - 1, -1, -1):
            best[i, j] = best[i + 1, j + 1] + 1 if left[i] == right[j] else max(best[i + 1, j], best[i, j + 1])
    i, out = 0, []
    for j, word in enumerate(b.split()):
        while i < len(left) and left[i] != right[j] and best[i + 1, j] >= best[i, j + 1]:
            i += 1
        same = i < len(left) and left[i] == right[j]
        i += same
        out.append((word, "same" if same else "changed"))
    return out


def pairs(seed, n, longest):
    rng = random.Random(seed)
    for _ in range(n):
        letters = "abcdefgh"[: rng.randrange(1, 9)]
        yield [[rng.choice(letters) for _ in range(rng.randrange(longest))] for _ in range(2)]


def test_distance_equals_the_table():
    for a, b in [*pairs(1, 400, 12), *pairs(2, 30, 200), ([], []), (["a"], []), ([], ["a"])]:
        assert wer.distance(a, b) == table(a, b) == wer.distance(b, a)


def test_marks_equal_the_table():
    for a, b in [*pairs(3, 300, 12), *pairs(4, 15, 150)]:
        a, b = " ".join(a).upper(), " ".join(b)
        assert wer.word_diff(a, b) == marks(a, b)
    assert wer.word_diff("", "x y") == [("x", "changed"), ("y", "changed")] and wer.word_diff("x", "") == []


def test_long_texts():
    rng = random.Random(5)
    a = [rng.choice("abcdefghij") for _ in range(6000)]
    b = list(a)
    for i in range(0, 6000, 300):
        b[i] = "z"
    assert wer.distance(a, b) == 20
    told = wer.word_diff(" ".join(a), " ".join(b))
    assert sum(t == "changed" for _, t in told) == 20
