"""Token counts by byte-pair merging with a heap and a linked list; no ids are made.

A word starts as one symbol for each byte. The adjacent pair with the lowest rank (the leftmost of
equal ones) is popped from a heap and merged, its neighbours form new pairs, and stale entries are
skipped. The count is the number of first symbols minus the number of merges.

Contract: a null text has 0 bytes and 0 tokens. Special strings inside a text count as one token
each, as the tokenizer's file says. Every row gives one row, repeated rows included; an empty table
gives an empty one. A word of any length takes n log n steps. Only the named columns are read.
"""

from __future__ import annotations

import functools
import heapq
import json

import regex
from pyspark.sql import DataFrame

from tidemark.llm.byte_bpe import byte_letters
from tidemark.llm.chunks import Chunks
from tidemark.llm.common import map_rows, own_names


class Counter:
    """Counts tokens as the byte-level tokenizer in a ``tokenizers`` file does."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec["pre_tokenizer"]
        plain = model["type"] == "BPE" and not (model.get("dropout") or model.get("ignore_merges"))
        plain = plain and not (model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"))
        plain = plain and spec["normalizer"] is None and spec["truncation"] is None and spec["padding"] is None
        if not plain or cut["type"] != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"]:
            raise ValueError(f"{path} is not a plain byte-level tokenizer")
        if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path} has added tokens that take blanks with them")
        self.letters = byte_letters()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.chunks = Chunks(pattern, lambda matches: list(map(self.word, matches)), sum)

    def word(self, match: str) -> int:
        letters = self.letters
        symbols: list = [letters[b] for b in match.encode("utf-8")]
        size = len(symbols)
        rank_of = self.ranks.get
        # an entry holds rank and place in one number, so the lowest rank and then the leftmost pair comes first
        heap = [r << 32 | a for a, pair in enumerate(zip(symbols, symbols[1:])) if (r := rank_of(pair)) is not None]
        heapq.heapify(heap)
        left, right = list(range(-1, size - 1)), list(range(1, size + 1))
        merges = 0
        while heap:
            entry = heapq.heappop(heap)
            a = entry & 0xFFFFFFFF
            b = right[a]
            first = symbols[a]
            if first is None or b >= size or rank_of((first, symbols[b])) != entry >> 32:
                continue  # one of the two has been merged since
            merges += 1
            symbols[a] = both = first + symbols[b]
            symbols[b] = None
            after = right[a] = right[b]
            if after < size:
                left[after] = a
                if (r := rank_of((both, symbols[after]))) is not None:
                    heapq.heappush(heap, r << 32 | a)
            before = left[a]
            if before >= 0 and (r := rank_of((symbols[before], both))) is not None:
                heapq.heappush(heap, r << 32 | before)
        return size - merges

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text."""
        if self.special is None:
            return self.chunks.totals(texts)
        parts = [self.special.split(t) if t and self.special.search(t) else [t] for t in texts]
        totals = iter(self.chunks.totals([p for pieces in parts for p in pieces]))
        return [len(pieces) - 1 + sum(next(totals) for _ in pieces) for pieces in parts]


@functools.lru_cache(maxsize=4)
def counter(path: str, pattern: str) -> Counter:
    return Counter(path, pattern)


def token_counts(
    df: DataFrame, path: str, pattern: str, limit: int = 1024, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every text; nothing is shuffled."""
    kind = df.schema[key].dataType.simpleString()

    def work(batch):
        count = counter(path, pattern).count
        texts = batch.column(1).to_pylist()
        tokens = count(texts)
        return [batch.column(0), [len((t or "").encode("utf-8")) for t in texts], tokens, [n > limit for n in tokens]]

    schema = f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return map_rows(own_names(df, {"key": key, "text": text}), work, schema)
