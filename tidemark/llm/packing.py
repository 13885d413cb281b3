"""Packing documents into sequences: best fit, then swaps between underfull sequences.

Texts become ids with an end mark; only documents longer than a sequence are cut, into whole sequences
and a rest. Pieces are dealt by a hash into groups of about ``group`` pieces. In a group each piece, the
longest first, goes to the fullest sequence it fits. While the group has more sequences than its tokens
ask for, a local search empties the emptiest ones: pieces move to, or are exchanged one for one or two
for one with pieces of, fuller sequences, so that the sum of squared fills grows with every step. It ends
when a pass over all sequences that are not full finds no such step; nothing else stops it. Sequences are kept by
what they can take, so a giver finds its best step without trying all others. The
sequences that stay clearly underfull in each group are packed once more, many groups together but about
``GROUP`` pieces at most, so the loss is about one sequence for hundreds of groups.

Words that are not remembered get their ids by byte-pair ranks of the tokenizer's file, many in one call; the library
itself takes those with special strings, odd blanks or letters that are not Latin, Greek or Cyrillic.

Contract. A null text is empty and consists of the end mark. Each row is packed for itself, repeated
rows and null ids included. An empty table gives an empty result. A piece never spans two sequences,
and the pieces of a sequence follow one another without gaps. Only the named columns are read.
"""

from __future__ import annotations

import bisect
import functools
import heapq
import json
import math
import os
import re
import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.byte_bpe import byte_letters
from tidemark.llm.common import map_rows, quoted
from tidemark.session import stage

CAPACITY = 4096
END = 1
#: Pieces of a group, about, and groups whose underfull sequences are packed together.
GROUP, TOGETHER = 20_000, 256
#: Sequences filled less than this are packed a second time.
FULL = 0.98
#: Characters of remembered words, and the longest of them.
REMEMBERED, LONGEST = 6_000_000, 200

#: A single mark between a plain letter and a blank.
_MARK = re.compile(r"(?<=[A-Za-z])([,.])(?=[ \n]|\Z)")
#: Words the ranks are not used for.
_ODD = re.compile(r"[^\u0000-\u037e\u0380-\u04ff]|[\s\x01]|<\|")
#: Stands for the end of a word, in place of the vocabulary's own mark.
_STOP, _SUFFIX = "\x01", "</w>"


class Ranks:
    """Ids of words by byte-pair merges, if the ``tokenizers`` file is one of words with ends and without capitals."""

    def __init__(self, spec: dict, tokenizer):
        import tiktoken

        byte_of = {letter: number for number, letter in enumerate(byte_letters())}
        stop = _STOP.encode()

        def raw(entry: str) -> bytes:
            plain = entry.removesuffix(_SUFFIX)
            return bytes(byte_of[c] for c in plain) + (stop if plain != entry else b"")

        vocabulary = spec["model"]["vocab"]
        # a letter meets the end of its word before anything else is merged
        ranks = {bytes([b]): b for b in range(256)} | {bytes([b]) + stop: 256 + b for b in range(256)}
        ids = [vocabulary[c] for c in byte_letters()] + [vocabulary[c + _SUFFIX] for c in byte_letters()]
        for merge in spec["model"]["merges"]:
            entry = "".join(merge.split(" ") if isinstance(merge, str) else merge)
            ranks[raw(entry)] = len(ids)
            ids.append(vocabulary[entry])
        if len(ranks) != len(ids):
            raise ValueError("two merges make the same entry")
        self.ids = np.array(ids, "<u4")
        self.blank = 256 + ord(" ")  # a blank that ends a word of its own: never part of a word
        self.encoding = tiktoken.Encoding("words", pat_str=r"[^\n]+", mergeable_ranks=ranks, special_tokens={})
        self.normal = tokenizer.normalizer.normalize_str
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.parts = regex.compile(f"{pattern}| ").findall

    @staticmethod
    def fits(spec: dict) -> bool:
        model, cut = spec["model"], spec["pre_tokenizer"]
        plain = model["type"] == "BPE" and model.get("end_of_word_suffix") == _SUFFIX
        plain = plain and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges", "byte_fallback"))
        steps = cut.get("pretokenizers", []) if cut and cut["type"] == "Sequence" else []
        plain = plain and [s["type"] for s in steps] == ["Split", "ByteLevel"] and spec["normalizer"] is not None
        return plain and steps[0]["invert"] and steps[0]["behavior"] == "Removed" and not (
            steps[1]["use_regex"] or steps[1]["add_prefix_space"]
        )

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of words without blanks, in batches of one call each."""
        out: list[bytes] = []
        for at in range(0, len(words), 1000):
            parts = self.parts(self.normal(" ".join(words[at : at + 1000])))
            found = np.array(self.encoding.encode_ordinary("".join([p + _STOP + "\n" for p in parts])), np.int64)
            ends = np.flatnonzero(found == self.blank)
            raw = self.ids[found].tobytes()
            starts = [0, *(4 * (ends + 1)).tolist()]
            out.extend([raw[a:b] for a, b in zip(starts, [*(4 * ends).tolist(), len(raw)])])
        return out


class Words:
    """Ids of texts by a ``tokenizers`` file, remembered by word.

    The tokenizer must drop blanks and capitals and cut words at marks, so that no token lies across a
    space or line end, or holds a letter and the mark behind it. Remembered words are bounded by their characters;
    those of more than ``LONGEST`` are forgotten after their batch.
    """

    def __init__(self, path: str, most: int = REMEMBERED):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.most = most
        self.known: dict[str, bytes] = {"": b""}
        self.held = 0
        self.ranks: Ranks | None = None
        probe = self._ids(["a b", "a", "b", "a\nb", "A"])
        if not probe[0] == probe[1] + probe[2] == probe[3] or probe[4] != probe[1]:
            raise ValueError(f"{path} keeps blanks or capitals; its texts cannot be cut at blanks")
        probe = self._ids(["a,", "a", ",", "a.", "."])
        if probe[0] != probe[1] + probe[2] or probe[3] != probe[1] + probe[4]:
            raise ValueError(f"{path} joins letters and marks; its words cannot be cut there")
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if Ranks.fits(spec):
            self.ranks = Ranks(spec, self.tokenizer)

    def _ids(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _learn(self, words: list[str]) -> None:
        odd = words
        if self.ranks is not None:
            odd = list(filter(_ODD.search, words))
            plain = list(set(words).difference(odd))
            self.known.update(zip(plain, self.ranks.words(plain)))
        self.known.update(zip(odd, self._ids(odd)))
        self.held += sum(map(len, words))

    @staticmethod
    def _cut(text: str) -> list[str]:
        """Words of a text, so that as many as can be are the same: a mark at the end of a word stands alone."""
        plain = text.lower() if text.isascii() else text
        return _MARK.sub(r" \1", plain).replace("\n", " ").split(" ")

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        cut = [self._cut(t) if t else [] for t in texts]
        if self.held > self.most:
            self.known, self.held = {"": b""}, 0
        new = list(set().union(*cut).difference(self.known))
        self._learn(new)
        ids = self.known.__getitem__
        out = [b"".join(map(ids, words)) for words in cut]
        for word in [w for w in new if len(w) > LONGEST]:
            del self.known[word]
            self.held -= len(word)
        return out


@functools.lru_cache(maxsize=2)
def words(path: str) -> Words:
    return Words(path)


def pieces(docs: DataFrame, path: str, key: str, text: str, capacity: int, end: int) -> DataFrame:
    """(doc, row, piece, start, length, crc) of each piece of each row."""
    plain = docs.select(quoted(key).alias("doc"), F.monotonically_increasing_id().alias("row"), quoted(text).alias("text"))

    def work(batch):
        mark = np.array([end], "<u4").tobytes()
        step = 4 * capacity
        out = [[], [], [], [], [], []]
        coded = words(path).encode(batch.column(2).to_pylist())
        for doc, row, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), coded):
            ids += mark
            for number, start in enumerate(range(0, len(ids), step)):
                part = ids[start : start + step]
                made = (doc, row, number, start // 4, len(part) // 4, zlib.crc32(part))
                for column, value in zip(out, made):
                    column.append(value)
        return out

    kind = plain.schema["doc"].dataType.simpleString()
    return map_rows(plain, work, f"doc {kind}, row bigint, piece int, start bigint, length bigint, crc bigint")


def best_fit(sizes: Sequence[int], capacity: int) -> list[list[int]]:
    """Bins of places in ``sizes``: the longest first, each into the fullest bin it fits."""
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps: list[int] = []  # the gaps that some bin has, sorted
    bins: list[list[int]] = []
    for place in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[place]
        at = bisect.bisect_left(gaps, size)
        if at < len(gaps):
            gap = gaps[at]
            number = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps.pop(at)
            bins[number].append(place)
        else:
            gap, number = capacity, len(bins)
            bins.append([place])
        rest = gap - size
        if rest:
            if not by_gap[rest]:
                bisect.insort(gaps, rest)
            by_gap[rest].append(number)
    return bins


class Takers:
    """Open bins by what they can take: one of their pieces goes (or none), and what comes may fill the gap as well."""

    def __init__(self, sizes: Sequence[int], capacity: int, count: int):
        self.sizes, self.capacity = sizes, capacity
        self.state = [0] * count  # entries of an earlier state of a bin are void
        # by the most that may come: the pieces that would go, the smallest first
        self.by_reach: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]
        self.least = np.full(capacity + 1, capacity + 1, np.int64)

    def add(self, number: int, places: Sequence[int], fill: int) -> None:
        self.state[number] += 1
        for size in {0, *(self.sizes[i] for i in places)} if fill < self.capacity else ():
            reach = size + self.capacity - fill
            heapq.heappush(self.by_reach[reach], (size, number, self.state[number]))
            self.least[reach] = min(self.least[reach], size)

    def remove(self, number: int) -> None:
        self.state[number] += 1

    def best(self, offers: np.ndarray) -> tuple[int, int, int] | None:
        """The offer, the bin and the size that comes back with the greatest gain."""
        while True:
            least = np.minimum.accumulate(self.least[::-1])[::-1]  # the smallest piece that lets so much come
            gain = offers - least[offers]
            at = int(gain.argmax()) if len(gain) else -1
            if at < 0 or gain[at] <= 0:
                return None
            offer = int(offers[at])
            reach = offer + int(self.least[offer:].argmin())
            heap = self.by_reach[reach]
            size, number, state = heap[0]
            if self.state[number] == state:
                return offer, number, size
            while heap and self.state[heap[0][1]] != heap[0][2]:
                heapq.heappop(heap)
            self.least[reach] = heap[0][0] if heap else self.capacity + 1


def _offers(lengths: Sequence[int], capacity: int) -> np.ndarray:
    """Sizes of one and of two pieces."""
    own = np.unique(np.array(lengths, np.int64))
    twice = [s for s in own.tolist() if lengths.count(s) > 1]
    pairs = (own[:, None] + own)[np.triu_indices(len(own), 1)]
    found = np.unique(np.concatenate([own, pairs, 2 * np.array(twice, np.int64)]))
    return found[found <= capacity]


def _places(places: Sequence[int], sizes: Sequence[int], total: int) -> list[int]:
    """One or two of ``places`` with the given total size."""
    by_size: dict[int, int] = {}
    for i in places:
        if sizes[i] == total:
            return [i]
    for i in places:
        if total - sizes[i] in by_size:
            return [by_size[total - sizes[i]], i]
        by_size[sizes[i]] = i
    raise LookupError(total)


def local_search(bins: list[list[int]], sizes: Sequence[int], capacity: int, tries: int | None = None) -> list[list[int]]:
    """Empties bins by moves and exchanges towards fuller ones; every step raises the sum of squared fills.

    Ends when the tokens ask for all bins that are left, or when a pass over all bins finds no step (or after
    ``tries`` steps, if given).
    """
    bins = [list(b) for b in bins]
    fill = [sum(sizes[i] for i in b) for b in bins]
    fewest = math.ceil(sum(fill) / capacity)
    live = len(bins)
    moved = True
    while moved and live > fewest:
        moved = False
        takers = Takers(sizes, capacity, len(bins))
        order = sorted((b for b in range(len(bins)) if 0 < fill[b] < capacity), key=lambda b: (fill[b], b))
        for number in order:
            takers.add(number, bins[number], fill[number])
        for giver in order:
            # those before it in the order are done; those after it were fuller and only got fuller since
            takers.remove(giver)
            while bins[giver] and live > fewest and (tries is None or tries > 0):
                found = takers.best(_offers([sizes[i] for i in bins[giver]], capacity))
                if found is None:
                    break
                offer, taker, size = found
                out = _places(bins[giver], sizes, offer)
                back = [next(i for i in bins[taker] if sizes[i] == size)] if size else []
                bins[giver] = [i for i in bins[giver] if i not in out] + back
                bins[taker] = [i for i in bins[taker] if i not in back] + out
                fill[giver] -= offer - size
                fill[taker] += offer - size
                takers.add(taker, bins[taker], fill[taker])
                moved = True
                tries = None if tries is None else tries - 1
            live -= not bins[giver]
    return [b for b in bins if b]


def _pack(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Sequence, offset and fill of the pieces of one group."""
    rows = rows.sort_values(["row", "piece"], ignore_index=True)  # the same result in whatever order rows come
    sizes = rows["length"].tolist()
    bins = local_search(best_fit(sizes, capacity), sizes, capacity)
    sequence, offset, fill = (np.zeros(len(rows), np.int64) for _ in range(3))
    for number, places in enumerate(bins):
        lengths = [sizes[i] for i in places]
        sequence[places], fill[places] = number, sum(lengths)
        offset[places] = np.cumsum([0, *lengths[:-1]])
    return rows.assign(sequence=sequence, offset=offset, fill=fill)


def pack(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY, end: int = END, group: int = GROUP, together: int = TOGETHER,
) -> DataFrame:
    """``key``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset`` of each piece."""
    made = stage(pieces(docs, path, key, text, capacity, end), "pieces")
    groups = max(1, math.ceil(made.count() / group))
    fields = [*made.schema.fields, T.StructField("group", T.LongType())]
    packed = [T.StructField(n, T.LongType()) for n in ("sequence", "offset", "fill")]

    def run(rows: DataFrame) -> DataFrame:
        return rows.groupBy("group").applyInPandas(lambda g: _pack(g, capacity), T.StructType(fields + packed))

    dealt = made.withColumn("group", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)))
    first = run(dealt)
    if groups > 1:
        first = stage(first, "packed")
        again = first.where(F.col("fill") < FULL * capacity).drop("sequence", "offset", "fill")
        # as few groups as can be, but none with more pieces than a task can hold
        second = max(1, math.ceil(groups / together), math.ceil(again.count() / GROUP))
        # numbers from ``groups`` on are those of the second pass
        second = run(again.withColumn("group", F.lit(groups) + F.pmod(F.xxhash64("piece", "row"), F.lit(second))))
        first = first.where(F.col("fill") >= FULL * capacity).unionByName(second)
    return first.select(
        F.col("doc").alias(key), "piece", "start", "length", F.col("crc").alias("ids_crc32"),
        (F.shiftleft("group", 32) + F.col("sequence")).alias("sequence_id"), "offset",
    )
