"""Periodic runs of words, found with a dictionary of basic factors.

Every stretch of 2^k words gets a number, made from the numbers of its two halves, so equal stretches
have equal numbers; stretches that occur once are left out of the longer ones. Occurrences of a stretch
that follow one another within twice its length form arithmetic progressions, whose difference is
proposed as a period. Proposals are joined where they overlap by a period, extended word by word to both
sides, and kept once if they are long enough.

This finds every run: take a run of smallest period q and length >= 3q and the 2^k with q <= 2^k < 2q. The
stretch at the run's start fits twice (2^k + q < 3q) and cannot come again sooner than after q words, as
the period would not be the smallest then.

The words of many texts are numbered and searched together. Numbers hold the text's place, so no run
spans two texts. Memory is in proportion to a batch of about ``BATCH`` bytes or, beyond that, to one text.

Contract. Words are ``[^\\x20\\x09-\\x0D]+``; a null or empty text has none, no run, four nulls for the
best one and the hash of the empty string. Ties for the best run go to the smaller start, then period.
Every row gives one row, repeated rows and null keys included; an empty table gives an empty one. Only the
key and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame

from tidemark.llm.common import map_rows, own_names, utf8

#: A run has at least this many words and this many periods.
LEAST, TIMES = 24, 3
#: Bytes of text searched together, and bytes split at once.
BATCH, SLICE = 1 << 21, 1 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
#: Steps that all proposals are extended by together, before the longer ones go on alone.
_STEPS = 32


def words(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, in lists of about ``SLICE`` bytes."""
    raw = utf8(text)
    start = 0
    while start < len(raw):
        cut = _BLANK.search(raw, start + SLICE)
        end = cut.start() if cut else len(raw)
        yield raw[start:end].split()  # ASCII white space only, as bytes know no other
        start = end


def _proposals(where: np.ndarray, gap: np.ndarray, last: np.ndarray, width: int):
    """Progressions (start, difference, end) of the successors at ``where``; ``last`` marks the end of a stretch's occurrences.

    Occurrences further apart than they are wide leave words between them unseen, so each pair stands alone.
    """
    near = gap <= 2 * width
    begins = near.copy()
    begins[1:] &= ~near[:-1] | (gap[1:] != gap[:-1]) | last[:-1] | (gap[1:] > width)
    first = np.flatnonzero(begins)
    # a progression ends before the next one or before a successor that is too far
    stops = near & ~np.append(near[1:] & ~begins[1:], False)
    final = np.flatnonzero(stops)
    return where[first], gap[first], where[final] + gap[final] + width


def _join(start: np.ndarray, period: np.ndarray, end: np.ndarray):
    """Stretches of one period that overlap by a period or more are one stretch."""
    if not len(start):
        return start, period, end
    order = np.lexsort((start, period))
    start, period, end = start[order], period[order], end[order]
    far = int(end.max()) + 1
    group = np.cumsum(np.append(0, np.diff(period) != 0)) * far
    reach = np.maximum.accumulate(end + group) - group
    fresh = np.ones(len(start), bool)
    fresh[1:] = (np.diff(period) != 0) | (start[1:] > reach[:-1] - period[1:])
    first = np.flatnonzero(fresh)
    return start[first], period[first], reach[np.append(first[1:] - 1, len(start) - 1)]


def _extend(symbols: np.ndarray, start: np.ndarray, period: np.ndarray, end: np.ndarray):
    size = len(symbols)
    for grow in ("end", "start"):
        going = np.arange(len(start))
        for _ in range(_STEPS):
            if grow == "end":
                going = going[end[going] < size]
                going = going[symbols[end[going]] == symbols[end[going] - period[going]]]
                end[going] += 1
            else:
                going = going[start[going] > 0]
                going = going[symbols[start[going] - 1] == symbols[start[going] - 1 + period[going]]]
                start[going] -= 1
            if not len(going):
                break
        for at in going.tolist():
            p, step = int(period[at]), 256
            while True:
                if grow == "end":
                    place = int(end[at])
                    same = symbols[place : place + step] == symbols[place - p : place - p + min(step, size - place)]
                else:
                    place = int(start[at])
                    low = max(0, place - step)
                    same = (symbols[low:place] == symbols[low + p : place + p])[::-1]
                more = len(same) if same.all() else int(same.argmin())
                if grow == "end":
                    end[at] += more
                else:
                    start[at] -= more
                if more < step:
                    break
                step *= 2
    return start, period, end


def find_runs(symbols: np.ndarray, least: int = LEAST, times: int = TIMES):
    """(start, period, length) arrays of all runs in a sequence of numbers, by start and period."""
    size = len(symbols)
    place, name, width = np.arange(size), symbols.astype(np.int64), 1
    found = []
    while len(place):
        order = np.argsort(name, kind="stable")
        here, value = place[order], name[order]
        same = value[1:] == value[:-1]
        at = np.flatnonzero(same)
        if not len(at):
            break
        last = np.append(at[1:] != at[:-1] + 1, True)
        start, period, end = _join(*_proposals(here[at], here[at + 1] - here[at], last, width))
        start, period, end = _extend(symbols, start, period, end)
        long = end - start >= np.maximum(least, times * period)
        found.append((start[long], period[long], end[long]))
        # twice the length: from the numbers of both halves, where both occur again
        again = np.append(same, False) | np.append(False, same)
        number = np.append(0, np.cumsum(~same))
        full = np.full(size, -1, np.int64)
        full[here[again]] = number[again]
        place = np.sort(here[again])
        place = place[place + width < size]
        second = full[place + width]
        place, second = place[second >= 0], second[second >= 0]
        name = full[place] * (int(number[-1]) + 1) + second
        width *= 2
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    start, period, end = _join(*(np.concatenate(part) for part in zip(*found)))
    order = np.lexsort((period, end, start))
    start, period, end = start[order], period[order], end[order]
    new = np.ones(len(start), bool)
    new[1:] = (np.diff(start) != 0) | (np.diff(end) != 0)
    return start[new], period[new], (end - start)[new]


class _Batch:
    """Words of some texts as numbers."""

    def __init__(self):
        self.known: dict[bytes, int] = defaultdict()
        self.known.default_factory = self.known.__len__
        self.numbers: list[np.ndarray] = []
        self.bytes = 0

    def add(self, text: str | None) -> np.ndarray:
        number = self.known.__getitem__
        parts = [np.fromiter(map(number, part), np.int64, len(part)) for part in words(text)]
        return np.concatenate(parts) if parts else np.empty(0, np.int64)


def _collapsed(vocabulary: list[bytes], numbers: np.ndarray) -> str:
    digest = hashlib.sha256()
    step = 1 << 16
    for at in range(0, len(numbers), step):
        digest.update((b" " if at else b"") + b" ".join([vocabulary[i] for i in numbers[at : at + step].tolist()]))
    return digest.hexdigest()


_EMPTY = hashlib.sha256(b"").hexdigest()


def _report(batch: _Batch) -> Iterator[tuple]:
    """One result for each text of a batch."""
    sizes = np.array([len(n) for n in batch.numbers], np.int64)
    begin = np.append(0, np.cumsum(sizes))
    flat = np.concatenate(batch.numbers)
    starts, periods, lengths = find_runs(np.repeat(np.arange(len(sizes)), sizes) * (len(batch.known) + 1) + flat)
    vocabulary = list(batch.known)
    cut = np.searchsorted(starts, begin)
    for number, words_of in enumerate(batch.numbers):
        low, high = int(cut[number]), int(cut[number + 1])
        if low == high:
            yield 0, None, None, None, None, _EMPTY, _collapsed(vocabulary, words_of), []
            continue
        runs = sorted(zip((starts[low:high] - begin[number]).tolist(), periods[low:high].tolist(), lengths[low:high].tolist()))
        first, period, length = min(runs, key=lambda r: (Fraction(-r[2], r[1]), r[0], r[1]))
        edges = np.zeros(len(words_of) + 1, np.int64)
        for s, p, n in runs:
            edges[s + p] += 1
            edges[s + n] -= 1
        kept = words_of[np.cumsum(edges)[:-1] == 0]
        listed = "".join(f"{s},{n},{p}\n" for s, p, n in runs)
        yield (
            len(runs), first, length, period, 1000 * length // period,
            hashlib.sha256(listed.encode()).hexdigest(), _collapsed(vocabulary, kept), [(s, n, p) for s, p, n in runs],
        )


def results(keys: list, texts: list[str | None], change: Callable[[object, np.ndarray], np.ndarray] | None = None) -> list[tuple]:
    out: list[tuple] = []
    batch = _Batch()
    for key, text in zip(keys, texts):
        numbers = batch.add(text)
        batch.numbers.append(numbers if change is None else change(key, numbers))
        batch.bytes += len(text or "")
        if batch.bytes >= BATCH:
            out.extend(_report(batch))
            batch = _Batch()
    if batch.numbers:
        out.extend(_report(batch))
    return out


def periodic_runs(
    df: DataFrame, key: str = "doc_id", text: str = "text",
    change: Callable[[object, np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """Runs of every text: their number, the one with most periods, all of them, and the text without repetitions.

    ``runs`` lists (start, length, period) by start and period; ``collapsed_sha256`` is the hash of the words
    left when each run keeps its first period, joined by spaces. ``change`` may replace the word numbers of a
    text, given its key, before the search. Nothing is shuffled.
    """
    kind = df.schema[key].dataType.simpleString()

    def work(batch):
        rows = results(batch.column(0).to_pylist(), batch.column(1).to_pylist(), change)
        columns = list(zip(*rows)) if rows else [[] for _ in range(8)]
        runs = [[{"start": s, "length": n, "period": p} for s, n, p in found] for found in columns[7]]
        return [batch.column(0), *map(list, columns[:7]), runs]

    schema = (
        f"`{key}` {kind}, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
        "runs_sha256 string, collapsed_sha256 string, runs array<struct<start: bigint, length: bigint, period: bigint>>"
    )
    return map_rows(own_names(df, {"key": key, "text": text}), work, schema)
