"""Alignment of the tokens of two tokenizers, and how often their tokens meet in the whole corpus.

The documents are shuffled by their full text, and each distinct text is encoded and aligned once. Byte
offsets where tokens of both sides end cut the tokens into groups; two tokens are linked if their bytes
overlap. How often a pair of ids is linked is counted over all texts, each as often as it occurs, and the
measures of a text are joined back to the documents that hold it, by the text's SHA-256.

Within a text, pieces that begin with a single space or line end are encoded once a worker and remembered (in
a dictionary bounded by bytes): neither tokenizer joins a letter before them with what follows, which is
checked when the vocabularies are read; a text is encoded whole where a piece's bytes do not come back.

Every text looks up the counts of its pairs. Pairs in the most texts, a fixed number of them, are broadcast;
all others, which are rare, are found by a shuffled join. So no key is hot, whatever the number of pairs.

Contract. A text that is null or empty, or whose tokens do not give back the bytes of a space and the text on
either side, has no tokens: zeros, and an empty string for the hash. Special strings inside texts are plain
text. Every row gives one row, repeated rows and null keys included; an empty table gives an empty one. Only
the key and the text are read, so other columns cannot clash. Memory is in proportion to one text beyond a
batch of about ``BATCH`` characters.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.byte_bpe import byte_letters
from tidemark.llm.common import lists, map_rows, own_names
from tidemark.session import stage

#: Pairs whose counts are broadcast: 16 bytes each and a flag.
FREQUENT = 1 << 18
#: Characters of texts encoded together, and bytes of remembered pieces and their results.
BATCH, REMEMBERED = 1 << 20, 192 << 20
_BETWEEN = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: Unknown pieces are encoded together in texts of this many characters, behind a piece that is thrown away.
_TOGETHER, _FIRST = 1 << 12, " a"


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of many ranges, one after the other."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


class Pieces:
    """Results by number: four measures, the groups as text (none if the bytes do not come back) and the linked pairs."""

    def __init__(self):
        self.numbers: dict[str, int] = {}
        self.groups: list[str | None] = []
        self.measures = np.empty((0, 4), np.int64)
        self.start = np.empty(0, np.int64)
        self.pairs = np.empty(0, np.int64)
        self.bytes = 0

    def add(self, pieces: list[str], groups: list[str | None], measures: np.ndarray, pairs: np.ndarray) -> None:
        """``pairs`` holds as many of each piece as the last of its measures says."""
        self.numbers.update(zip(pieces, range(len(self.groups), len(self.groups) + len(pieces))))
        self.groups.extend(groups)
        links = measures[:, 3]
        self.start = np.append(self.start, len(self.pairs) + np.cumsum(links) - links)
        self.measures = np.concatenate([self.measures, measures])
        self.pairs = np.append(self.pairs, pairs)
        self.bytes += 300 * len(pieces) + 4 * sum(map(len, pieces)) + 16 * len(pairs)

    def linked(self, numbers: np.ndarray) -> np.ndarray:
        return self.pairs[_ranges(self.start[numbers], self.measures[numbers, 3])]


class Aligner:
    """Aligns a byte-level tokenizer (a ``tokenizers`` file) with a sentencepiece model."""

    def __init__(self, first: str, second: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_file(first)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=second)
        byte_of = {letter: number for number, letter in enumerate(byte_letters())}
        entries = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size(with_added_tokens=True))]
        self.bytes_a = [
            bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode() for entry in entries
        ]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(pieces)
        ]
        self.length_a = np.array([len(b) for b in self.bytes_a], np.int64)
        self.length_b = np.array([len(b) for b in self.bytes_b], np.int64)
        # ids as text with what follows them: another id of the group, or its other side, or the next group
        self.text_a = np.array([[f"{i},", f"{i}|"] for i in range(len(entries))], object)
        self.text_b = np.array([[f"{i},", f"{i};"] for i in range(len(pieces))], object)
        with open(first, encoding="utf-8") as file:
            spec = json.load(file)
        cut = spec["pre_tokenizer"] or {}
        plain = cut.get("type") == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]
        crossing = any("▁" in p.lstrip("▁") or ("\n" in p and len(p) > 1) for p in pieces)
        self.by_piece = plain and spec["normalizer"] is None and not crossing
        self.known = Pieces()

    def _encode(self, chunks: list[list[str]]) -> None:
        """Encode and remember pieces, each chunk of them as one text that begins with a space."""
        joined = ["".join(chunk) for chunk in chunks]
        ids_a = [e.ids for e in self.a.encode_batch(joined, add_special_tokens=False)]
        ids_b = self.b.encode([text[1:] for text in joined], num_threads=1)
        good, torn = [], []
        for k, text in enumerate(joined):
            raw = text.encode("utf-8")
            back = b"".join([self.bytes_a[i] for i in ids_a[k]]) == raw == b"".join([self.bytes_b[i] for i in ids_b[k]])
            (good if back else torn).append(k)
        if good:
            self._align([chunks[k] for k in good], [ids_a[k] for k in good], [ids_b[k] for k in good])
        alone = []
        for k in torn:
            if len(chunks[k]) == 1:
                self.known.add(chunks[k], [None], np.zeros((1, 4), np.int64), np.empty(0, np.int64))
            elif len(chunks[k]) == 2 and chunks[k][0] == _FIRST:
                self.known.add(chunks[k][1:], [None], np.zeros((1, 4), np.int64), np.empty(0, np.int64))
            else:
                alone.extend([_FIRST, piece] for piece in chunks[k][1:])
        if alone:
            self._encode(alone)

    def _align(self, chunks: list[list[str]], ids_a: list[list[int]], ids_b: list[list[int]]) -> None:
        """All tokens as one sequence over the bytes of all pieces."""
        pieces = [piece for chunk in chunks for piece in chunk]
        kept = np.array([k > 0 or len(chunk) == 1 for chunk in chunks for k in range(len(chunk))])
        flat_a = np.fromiter(itertools.chain.from_iterable(ids_a), np.int64)
        flat_b = np.fromiter(itertools.chain.from_iterable(ids_b), np.int64)
        ends_a, ends_b = np.cumsum(self.length_a[flat_a]), np.cumsum(self.length_b[flat_b])
        stop = np.cumsum([len(p) if p.isascii() else len(p.encode("utf-8")) for p in pieces])
        # between two neighbouring ends lies one token of either side: one link
        cuts = np.union1d(ends_a, ends_b)
        pairs = flat_a[np.searchsorted(ends_a, cuts)] << 32 | flat_b[np.searchsorted(ends_b, cuts)]
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        before_a = np.searchsorted(ends_a, shared, "right")  # tokens up to the end of each group
        before_b = np.searchsorted(ends_b, shared, "right")
        texts = np.empty(len(flat_a) + len(flat_b), object)
        texts[np.arange(len(flat_a)) + np.append(0, before_b)[group_a]] = self.text_a[flat_a, (shared[group_a] == ends_a).astype(int)]
        texts[np.arange(len(flat_b)) + before_a[group_b]] = self.text_b[flat_b, (shared[group_b] == ends_b).astype(int)]
        at_a, at_b = np.searchsorted(ends_a, stop, "right"), np.searchsorted(ends_b, stop, "right")
        whole = shared[np.minimum(np.searchsorted(shared, stop), len(shared) - 1)] == stop
        whole &= np.append(True, whole[:-1])
        counts = [at_a, at_b, np.searchsorted(shared, stop, "right"), np.searchsorted(cuts, stop, "right")]
        measures = np.stack([np.diff(c, prepend=0) for c in counts], axis=1)
        text_ends = (at_a + at_b).tolist()
        listed, first = texts.tolist(), 0
        groups: list[str | None] = []
        for end, keep, good in zip(text_ends, kept.tolist(), whole.tolist()):
            if keep:
                groups.append("".join(listed[first:end]) if good else None)
            first = end
        linked = np.repeat(kept, measures[:, 3])
        self.known.add([p for p, keep in zip(pieces, kept.tolist()) if keep], groups, measures[kept], pairs[linked])

    def _numbers(self, cut: list[list[str]]) -> list[np.ndarray]:
        known = self.known.numbers
        unknown = [p for p in set().union(*cut) if p not in known]
        if not self.by_piece:
            self._encode([[p] for p in unknown])
            unknown = []
        chunks: list[list[str]] = []
        room = 0
        for piece in unknown:
            if room <= 0:
                chunks.append([_FIRST])
                room = _TOGETHER
            chunks[-1].append(piece)
            # nothing may follow white space
            room = 0 if piece[-1].isspace() else room - len(piece)
        if chunks:
            self._encode(chunks)
        number = known.__getitem__
        return [np.fromiter(map(number, pieces), np.int64, len(pieces)) for pieces in cut]

    def align(self, texts: list[str]) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, hash of the groups, distinct pairs, their links) of each text."""
        if self.known.bytes > REMEMBERED:
            self.known = Pieces()
        known = self.known
        spaced = [" " + t for t in texts]
        numbers = self._numbers([_BETWEEN.split(t) if self.by_piece else [t] for t in spaced])
        out = []
        for text, own in zip(spaced, numbers):
            groups = [known.groups[n] for n in own.tolist()]
            if None in groups and len(groups) > 1:
                alone = Aligner.__new__(Aligner)  # the same tokenizers, the text as a whole, nothing remembered
                alone.__dict__.update(self.__dict__, by_piece=False, known=Pieces())
                out.extend(alone.align([text[1:]]))
            elif None in groups:
                out.append((0, 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64)))
            else:
                pairs, links = np.unique(known.linked(own), return_counts=True)
                totals = known.measures[own].sum(axis=0).tolist()
                out.append((*totals, hashlib.sha256("".join(groups)[:-1].encode()).hexdigest(), pairs, links))
        return out


@functools.lru_cache(maxsize=2)
def aligner(first: str, second: str) -> Aligner:
    return Aligner(first, second)


def align_texts(texts: DataFrame, first: str, second: str) -> DataFrame:
    """``texts`` (text, times) with a row for each distinct text: its digest, measures, pairs and links."""

    def work(batch):
        align = aligner(first, second).align
        values = batch.column(0).to_pylist()
        found, part, size = [], [], 0
        for number, value in enumerate(values):
            part.append(value)
            size += len(value)
            if size >= BATCH or number + 1 == len(values):
                found.extend(align(part))
                part, size = [], 0
        columns = list(zip(*found)) if found else [[] for _ in range(7)]
        digests = [hashlib.sha256(v.encode("utf-8")).digest() for v in values]
        return [
            digests, batch.column(1), *map(list, columns[:5]),
            lists(list(columns[5]), "int64"), lists(list(columns[6]), "int64"),
        ]

    schema = (
        "digest binary, times bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
        "pairs array<bigint>, links array<bigint>"
    )
    return map_rows(texts.select("text", "times"), work, schema)


def _links(aligned: DataFrame, *columns: str) -> DataFrame:
    one = F.explode(F.arrays_zip("pairs", "links")).alias("one")
    return aligned.select(*columns, one).select(*columns, F.col("one.pairs").alias("pair"), F.col("one.links").alias("links"))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair``, ``count`` (links of all documents), ``texts`` (distinct texts) and ``best`` (highest of its second id)."""
    counted = stage(
        _links(aligned, "times").groupBy("pair").agg(F.sum(F.col("links") * F.col("times")).alias("count"), F.count("*").alias("texts")),
        "pairs",
    )
    second = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    highest = counted.groupBy(second.alias("second")).agg(F.max("count").alias("highest"))
    return counted.withColumn("second", second).join(highest, "second").select(
        "pair", "count", "texts", (F.col("count") == F.col("highest")).alias("best")
    )


def _measures(links: DataFrame, digest: Column) -> DataFrame:
    return links.groupBy(digest.alias("digest")).agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
        F.sum(F.col("links") * F.col("count")).alias("count_sum"),
    )


def token_alignment(
    df: DataFrame, first: str, second: str, key: str = "doc_id", text: str = "text", frequent: int = FREQUENT
) -> tuple[DataFrame, DataFrame]:
    """The measures of every document, and the linked id pairs of the corpus (first, second, count, best)."""
    docs = own_names(df, {key: key, "text": text}) if key != "text" else df.select("text")
    whole = docs.where(F.length("text") > 0)
    texts = whole.groupBy("text").agg(F.count("*").alias("times"))
    aligned = stage(align_texts(texts, first, second), "aligned")
    counts = stage(pair_counts(aligned), "counts")
    # a fixed number of pairs, those of most texts; what is left has no hot key
    common = stage(counts.orderBy(F.desc("texts"), "pair").limit(frequent), "frequent")
    links = _links(aligned, "digest")
    near = links.join(F.broadcast(common), "pair")
    rare = counts.join(F.broadcast(common.select("pair")), "pair", "left_anti")
    far = links.join(F.broadcast(common.select("pair")), "pair", "left_anti").join(rare, "pair")
    met = _measures(near, F.col("digest")).unionByName(_measures(far, F.col("digest")))
    met = met.groupBy("digest").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    own = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    measures = aligned.select("digest", *own).join(met, "digest", "left")
    digest = F.when(F.length("text") > 0, F.unhex(F.sha2("text", 256)))
    joined = docs.select(key, digest.alias("__digest")).join(
        measures.withColumnRenamed("digest", "__digest"), "__digest", "left"
    )
    zero = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    result = joined.select(key, *zero, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
    pairs = counts.select(
        F.shiftright("pair", 32).alias("first"), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("second"), "count", "best"
    )
    return result, pairs
