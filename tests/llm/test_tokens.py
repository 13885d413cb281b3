"""Encoding, decoding, counting and packing against the tokenizers' own libraries."""

import math
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from tidemark.llm import byte_bpe, packing, token_counts

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
COUNTS = P.path("byte_bpe_50k.json")
PIECES = P.path("word_bpe_49k.json")
LETTERS = "ab É cde  \n\n\t\r  \x85\x1c\x0bé́日本'sll1239!?#☃😀"


def texts(count=400, seed=3):
    rnd = random.Random(seed)
    made = ["".join(rnd.choice(LETTERS) for _ in range(rnd.randint(0, 50))) for _ in range(count)]
    plain = ["The quick brown fox.\nJumps over it, doesn't it?", " leading", "trailing ", "\n", " \n ", "a\n\t\tb"]
    special = ["x<|endoftext|>y", "<|endoftext|>", "a <|startoftext|> b<|endoftext|><|endoftext|>"]
    return [None, "", *plain, *special, "x" * 5000, " " * 3000, "ab " * 3000, *made]


def test_ids_are_those_of_the_library():
    import tiktoken

    code = byte_bpe.codec(RANKS, P.PATTERN)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=code.ranks, special_tokens={})
    found = code.encode(texts())
    for text, ids in zip(texts(), found):
        assert ids.tolist() == library.encode_ordinary(text or "")
        assert code.decode(ids.tolist()) == (text or "").encode("utf-8")


def test_ranks_with_gaps_are_refused():
    with pytest.raises(ValueError):
        byte_bpe.sentencepiece_model({b"a": 0, b"b": 2})


def test_small_memory_gives_the_same():
    code = byte_bpe.Codec(RANKS, P.PATTERN)
    code.chunks.most = 10
    whole = byte_bpe.codec(RANKS, P.PATTERN).encode(texts())
    parts = [ids for t in texts() for ids in code.encode([t])]
    assert [p.tolist() for p in parts] == [w.tolist() for w in whole]


def test_round_trip_in_spark(spark, docs, rows):
    data = [(k, t) for k, t in enumerate(texts(50))] + [(None, "again"), (7, "again"), (7, "again")]
    df = docs(data)
    coded = byte_bpe.encode(df, RANKS, P.PATTERN)
    back = byte_bpe.decode(coded, RANKS, P.PATTERN)
    key = lambda r: (r[0] is not None, r[0], bytes(r[1]))
    found = sorted(((r["doc_id"], bytes(r["decoded"])) for r in back.collect()), key=key)
    assert found == sorted(((k, (t or "").encode()) for k, t in data), key=key)
    both = byte_bpe.round_trip(df, RANKS, P.PATTERN)
    assert sorted(map(str, both.select("doc_id", "ids").collect())) == sorted(map(str, coded.collect()))
    assert byte_bpe.round_trip(df.limit(0), RANKS, P.PATTERN).count() == 0


def test_counts_are_those_of_the_library(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(COUNTS)
    data = texts()
    found = token_counts.token_counts(docs(list(enumerate(data))).withColumnRenamed("source", "n_tokens"), COUNTS, P.PATTERN)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    for r in found.collect():
        text = data[r["doc_id"]] or ""
        size = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), size, size > 1024)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        token_counts.Counter(PIECES, P.PATTERN)
    with pytest.raises(ValueError):
        packing.Words(COUNTS)


def test_word_ids_are_those_of_the_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PIECES)
    found = packing.words(PIECES).encode(texts())
    for text, ids in zip(texts(), found):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids


def check_packing(found, data, capacity):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PIECES)
    bins = {}
    by_doc = {}
    for r in found:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    for doc, text in data:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        cut = [(k, s, len(ids[s : s + capacity]), zlib.crc32(ids[s : s + capacity].tobytes()))
               for k, s in enumerate(range(0, len(ids), capacity))]
        assert sorted(by_doc[doc]) == cut
    total = sum(length for places in bins.values() for _, length in places)
    return len(bins), math.ceil(total / capacity)


def test_packing_in_one_and_many_groups(docs):
    data = [(k, t) for k, t in enumerate(texts(150))]
    for group in (1000, 40):
        found = packing.pack(docs(data), PIECES, capacity=256, group=group, together=100).collect()
        used, least = check_packing(found, data, 256)
        assert used <= least + (1 if group == 1000 else 4)
    assert packing.pack(docs([]), PIECES).count() == 0
    twice = packing.pack(docs([(1, "a b"), (1, "a b"), (None, None)]), PIECES).collect()
    assert sorted(r["offset"] for r in twice) == [0, 3, 6] or sorted(r["length"] for r in twice) == [1, 3, 3]


def test_local_search_empties_bins():
    rnd = random.Random(5)
    # pairs that fill a bin exactly, in bins that do not
    sizes = [s for _ in range(40) for s in (lambda a: (a, 100 - a))(rnd.randint(30, 70))]
    start = [[i] for i in range(len(sizes))]
    found = packing.local_search(start, sizes, 100)
    assert sorted(i for b in found for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 100 for b in found)
    assert len(found) < len(start) * 0.6
    square = lambda bins: sum(sum(sizes[i] for i in b) ** 2 for b in bins)
    assert square(found) > square(start)
    assert packing.local_search(start, sizes, 100, tries=0) == start
    best = packing.best_fit(sizes, 100)
    assert len(packing.local_search(best, sizes, 100)) <= len(best)


def test_ranks_give_the_ids_of_the_library():
    """Words made of entries of the vocabulary, so that many merges compete."""
    import json

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PIECES)
    with open(PIECES, encoding="utf-8") as file:
        entries = list(json.load(file)["model"]["vocab"])
    code = {c: n for n, c in enumerate(byte_bpe.byte_letters())}
    plain = [bytes(code[c] for c in e.removesuffix("</w>")).decode("utf-8", "ignore") for e in entries[:-2]]
    rnd = random.Random(8)
    made = ["".join(rnd.choice(plain) for _ in range(rnd.randint(1, 5))) for _ in range(40_000)] + plain
    made += ["e\u0301a", "\u0301", "ΣΑΣ", "İ", "don't", "a\x01b", "a<|endoftext|>b", "1234", "ǅ", "x\u2028y", "\u037f"]
    code = packing.words(PIECES)
    assert code.ranks is not None
    found = code.encode(made)
    expected = library.encode_batch(made, add_special_tokens=False)
    for word, ids, e in zip(made, found, expected):
        assert np.frombuffer(ids, "<u4").tolist() == e.ids, word


def test_small_memory_of_words():
    code = packing.Words(PIECES, most=20)
    whole = packing.words(PIECES).encode(texts())
    assert [ids for t in texts() for ids in code.encode([t])] == whole
    assert sum(map(len, code.known)) < 3000


def square(bins, sizes):
    return sum(sum(sizes[i] for i in b) ** 2 for b in bins)


def plain_steps(bins, sizes, capacity):
    """Whether a move or exchange from any bin to a fuller one (a later one of the same fill) raises the sum of squares."""
    fill = [sum(sizes[i] for i in b) for b in bins]
    for g, giver in enumerate(bins):
        offers = [sizes[i] for i in giver] + [sizes[i] + sizes[j] for n, i in enumerate(giver) for j in giver[n + 1 :]]
        for t, taker in enumerate(bins):
            if (fill[g], g) < (fill[t], t) and fill[t] < capacity:
                for back in [0, *(sizes[i] for i in taker)]:
                    if any(0 < x - back <= capacity - fill[t] for x in offers):
                        return True
    return False


@pytest.mark.parametrize("low, high", [(1, 100), (25, 45), (51, 100), (30, 60), (1, 9)])
def test_local_search_ends_where_nothing_helps(low, high):
    rnd = random.Random(low)
    for _ in range(12):
        sizes = [rnd.randint(low, high) for _ in range(rnd.randint(1, 60))]
        start = packing.best_fit(sizes, 100) if rnd.random() < 0.5 else [[i] for i in range(len(sizes))]
        found = packing.local_search(start, sizes, 100)
        assert sorted(i for b in found for i in b) == list(range(len(sizes)))
        assert all(0 < sum(sizes[i] for i in b) <= 100 for b in found)
        assert square(found, sizes) >= square(start, sizes) and len(found) <= len(start)
        least = math.ceil(sum(sizes) / 100)
        assert len(found) == least or not plain_steps(found, sizes, 100)


def test_packing_of_a_whole_group_of_large_pieces():
    """No two pieces fit together: a search over pairs of bins would take 2e8 tries."""
    rnd = random.Random(1)
    sizes = [rnd.randint(2100, 4000) for _ in range(20_000)]
    assert len(packing.local_search(packing.best_fit(sizes, 4096), sizes, 4096)) == 20_000
