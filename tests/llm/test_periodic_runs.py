"""Runs of words against a plain search of all starts and periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import periodic_runs
from tidemark.llm.queries import repeat_words


def plain_runs(seq, least=24, times=3):
    """Every maximal stretch of every period, the smallest period of each stretch only."""
    best = {}
    size = len(seq)
    for period in range(1, size // times + 1):
        at = 0
        while at + period < size:
            if seq[at] != seq[at + period]:
                at += 1
                continue
            end = at
            while end + period < size and seq[end] == seq[end + period]:
                end += 1
            if end + period - at >= max(least, times * period):
                best.setdefault((at, end + period), period)
            at = end
    return sorted((s, p, e - s) for (s, e), p in best.items())


def expected(doc, text, change=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc).encode())
    if doc is not None and change and h % 10 == 0 and words:
        g = h // 10
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {i for s, p, n in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1])) if runs else None
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        len(runs), *((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4),
        sha("".join(f"{s},{n},{p}\n" for s, p, n in sorted(runs))),
        sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def made(seed, count):
    rnd = random.Random(seed)
    out = []
    for _ in range(count):
        kind = rnd.randrange(4)
        letters = "abcdefgh"[: rnd.randint(1, 6)]
        if kind == 0:
            seq = [rnd.choice(letters) for _ in range(rnd.randint(0, 120))]
        elif kind == 1:  # runs of random periods one after the other
            seq = []
            for _ in range(rnd.randint(1, 4)):
                base = [rnd.choice(letters) for _ in range(rnd.randint(1, 25))]
                seq += (base * rnd.randint(2, 9))[: rnd.randint(5, 90)]
        elif kind == 2:  # runs of runs
            seq = [rnd.choice(letters)]
            while len(seq) < 100:
                seq = seq * rnd.randint(2, 4) + [rnd.choice(letters)]
            seq = seq[:250]
        else:
            a, b = ["a"], ["a", "b"]
            while len(b) < 200:
                a, b = b, b + a
            seq = b
        out.append(seq)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_all_runs_and_no_others(seed):
    for seq in made(seed, 60):
        numbers = np.array([ord(w[0]) for w in seq], np.int64)
        found = list(zip(*(part.tolist() for part in periodic_runs.find_runs(numbers))))
        assert sorted(found) == plain_runs(seq), seq
        found = list(zip(*(part.tolist() for part in periodic_runs.find_runs(numbers, 6, 3))))
        assert sorted(found) == plain_runs(seq, 6), seq


def test_long_runs_are_extended():
    rnd = random.Random(9)
    base = [rnd.randrange(50) for _ in range(777)]
    seq = [99] + (base * 40)[:30000] + [98, 97]
    found = [part.tolist() for part in periodic_runs.find_runs(np.array(seq))]
    assert found == [[1], [777], [30000]]
    assert [p.tolist() for p in periodic_runs.find_runs(np.zeros(100_000, np.int64))] == [[0], [1], [100_000]]


def test_results_of_texts(docs):
    data = [(k, " ".join(seq)) for k, seq in enumerate(made(11, 150))]
    data += [(1001, None), (1002, ""), (1003, " \t\n "), (None, "a " * 60), (5, "a b c " * 20), (5, "a b c " * 20)]
    data += [(1004, "x y " * 30 + "\x1c \x85 z\n"), (1005, "w" * 100_000), (1006, ("k " * 9 + "l ") * 3000)]
    df = docs(data).withColumnRenamed("source", "n_runs")
    found = periodic_runs.periodic_runs(df, change=repeat_words).drop("runs").collect()
    key = lambda r: str(r)
    small = [r for r in found if r[0] not in (1006,)]
    assert sorted(map(tuple, small), key=key) == sorted(((d, *expected(d, t)) for d, t in data if d != 1006), key=key)
    long = next(r for r in found if r[0] == 1006)
    assert (long["n_runs"] >= 1, long["start"]) == (True, 0) if long["n_runs"] else False
    assert periodic_runs.periodic_runs(docs([])).count() == 0


def test_small_batches_give_the_same(monkeypatch):
    data = [" ".join(seq) for seq in made(12, 80)]
    whole = periodic_runs.results(list(range(80)), data)
    monkeypatch.setattr(periodic_runs, "BATCH", 100)
    monkeypatch.setattr(periodic_runs, "SLICE", 7)
    assert periodic_runs.results(list(range(80)), data) == whole
