"""Aligned tokens against the two libraries applied to whole texts."""

import hashlib
from collections import Counter

import public_tokenizers as P
import pytest

from test_tokens import texts
from tidemark.llm import token_alignment

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def plain(data):
    """Whole texts through the libraries, every pair of tokens compared."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    code = {ch: n for n, ch in enumerate(token_alignment.byte_letters())}

    def cut(lengths):
        ends, at = [], 0
        for size in lengths:
            ends.append((at, at + size))
            at += size
        return ends

    aligned = []
    for _, text in data:
        raw = (" " + (text or "")).encode()
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        bytes_a = [bytes(code[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
            for i in ids_b
        ]
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            aligned.append(None)
            continue
        spans_a, spans_b = cut(map(len, bytes_a)), cut(map(len, bytes_b))
        links, first = [], 0
        for i, (s, e) in enumerate(spans_a):
            while spans_b[first][1] <= s:
                first += 1
            j = first
            while j < len(spans_b) and spans_b[j][0] < e:
                links.append((ids_a[i], ids_b[j]))
                j += 1
        shared = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
        groups, last = [], 0
        for end in shared:
            one = ",".join(str(i) for i, (s, e) in zip(ids_a, spans_a) if last <= s and e <= end)
            two = ",".join(str(i) for i, (s, e) in zip(ids_b, spans_b) if last <= s and e <= end)
            groups.append(f"{one}|{two}")
            last = end
        aligned.append((len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    counts = Counter(pair for one in aligned if one for pair in one[3])
    highest = {}
    for (_, second), n in counts.items():
        highest[second] = max(n, highest.get(second, 0))
    rows = []
    for (doc, _), one in zip(data, aligned):
        if one is None:
            rows.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, digest = one
        best = sum(counts[p] == highest[p[1]] for p in links)
        rows.append((doc, n_a, n_b, n_groups, len(links), best, sum(counts[p] for p in links), digest))
    return sorted(rows, key=str), {(*p, n, n == highest[p[1]]) for p, n in counts.items()}


def data():
    some = [t for t in texts(150) if not t or len(t) < 1000]
    some += ["a▁b", "plain words with ▁ inside", "x" * 600, "日本語" * 50, "ab " * 200, "the cat", "the cat", "the cat"]
    return [(None, "the cat"), (7, "the cat"), (7, "the cat"), (None, None), *enumerate(some, 100)]


@pytest.mark.parametrize("frequent", [token_alignment.FREQUENT, 20, 1])
def test_measures_of_documents_and_pairs(docs, frequent):
    df = docs(data()).withColumnRenamed("source", "n_links")
    found, pairs = token_alignment.token_alignment(df, A, B, frequent=frequent)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows, counts = plain(data())
    assert sorted((tuple(r) for r in found.select(*names).collect()), key=str) == rows
    assert {tuple(r) for r in pairs.collect()} == counts


def test_pieces_are_as_whole_texts(monkeypatch):
    some = [t for _, t in data() if t]
    code = token_alignment.Aligner(A, B)
    assert code.by_piece
    as_pieces = code.align(some)
    code = token_alignment.Aligner(A, B)
    code.by_piece = False
    key = lambda rows: [(*r[:5], r[5].tolist(), r[6].tolist()) for r in rows]
    assert key(as_pieces) == key(code.align(some))
    monkeypatch.setattr(token_alignment, "REMEMBERED", 0)
    code = token_alignment.Aligner(A, B)
    assert key(as_pieces) == key([r for t in some for r in code.align([t])])


def test_very_long_and_empty(docs):
    long = "word and word " * 20_000
    found, _ = token_alignment.token_alignment(docs([(1, long), (2, "y" * 50_000)]), A, B)
    rows = {r["doc_id"]: r for r in found.collect()}
    assert rows[1]["n_links"] > 60_000 and rows[2]["n_a"] > 0
    found, pairs = token_alignment.token_alignment(docs([]), A, B)
    assert found.count() == 0 and pairs.count() == 0
