"""Near duplicates and repeated lines against plain versions."""

import hashlib
import random
import re

import numpy as np
import pytest

from tidemark.llm import line_dedup, near_dedup
from tidemark.llm.components import components


def plain_sets(data, size):
    sets = {}
    for doc, text in data:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        if words and len(words) < size:
            found = {tuple(words)}
        else:
            found = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
        sets.setdefault(doc, []).append(found)
    return sets


def plain_groups(data, size):
    sets = plain_sets(data, size)
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = [d for d in sets if d is not None]
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in ids}


def corpus(seed=1):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    data = []
    for _ in range(25):
        base = [rnd.choice(words) for _ in range(rnd.randint(3, 160))]
        for _ in range(rnd.randint(1, 9)):
            copy = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 25))):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            data.append(" ".join(copy))
    rnd.shuffle(data)
    return [(k * 3 + 1, t) for k, t in enumerate(data)]


@pytest.mark.parametrize("size", [4, 5])
def test_groups_are_those_of_all_pairs(docs, size):
    data = corpus() + [(9001, None), (9002, ""), (9003, "  \n"), (9004, "Two words"), (9005, "two  WORDS"), (9006, "two")]
    data += [(None, "two words"), (9004, "Two words"), (9007, " ".join(f"long{k}" for k in range(30_000)))]
    found = near_dedup.near_duplicates(docs(data), size=size).collect()
    assert len(found) == len(data)
    groups, sets = plain_groups(data, size), plain_sets(data, size)
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
            continue
        assert r["component_id"] == groups[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["component_id"])
        assert r["n_shingles"] in {len(s) for s in sets[r["doc_id"]]}


@pytest.mark.parametrize("large, block", [(1, 3), (4, 512)])
def test_large_groups_in_blocks(docs, monkeypatch, large, block):
    """Copies around one text, many of them too far from it, but some near to each other."""
    monkeypatch.setattr(near_dedup, "LARGE", large)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rnd = random.Random(8)
    base = [f"w{rnd.randrange(500)}" for _ in range(120)]
    data = []
    for _ in range(60):
        copy = list(base)
        for _ in range(rnd.choice([0, 1, 2, 3, 4, 6, 8])):
            copy[rnd.randrange(120)] = f"x{rnd.randrange(10**6)}"
        data.append(list(copy))
        if rnd.random() < 0.4:  # a child, near to its parent
            copy[rnd.randrange(120)] = "child"
            data.append(copy)
    data = [(k, " ".join(words)) for k, words in enumerate(data)]
    expected = plain_groups(data, 4)
    assert len(set(expected.values())) > 3
    found = near_dedup.near_duplicates(docs(data), size=4).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == expected


@pytest.mark.parametrize("crowd, block", [(2, 512), (2, 3), (64, 512)])
def test_crowded_buckets_lose_no_link(docs, monkeypatch, crowd, block):
    """Texts of one template: most are apart, some near to each other, none near to all."""
    monkeypatch.setattr(near_dedup, "CROWD", crowd)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rnd = random.Random(5)
    base = [f"t{k}" for k in range(150)]
    data = []
    for k in range(120):
        own = [f"u{k}x{j}" for j in range(rnd.choice([12, 20, 30, 45]))]
        data.append(base + own)
        if rnd.random() < 0.3:  # a sibling with most of the same words of its own
            data.append(base + own[: len(own) - rnd.randint(0, 6)] + ["other"])
    data = [(k, " ".join(words)) for k, words in enumerate(data)] + [(7001, None), (7002, ""), (3, " ".join(base))]
    expected = plain_groups(data, 4)
    assert len(set(expected.values())) > 3
    found = near_dedup.near_duplicates(docs(data), size=4).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == expected


def test_candidates_of_a_template_grow_in_proportion(spark, docs):
    counts = []
    for many in (200, 400, 800):
        base = " ".join(f"t{k}" for k in range(150))
        plain = docs([(k, base + " " + " ".join(f"u{k}x{j}" for j in range(40))) for k in range(many)])
        texts = plain.selectExpr("doc_id AS doc", "text")
        pairs, grouped = near_dedup._crowded_pairs(
            texts.selectExpr("doc", "doc AS component"), texts, 4, near_dedup.Fraction("0.8")
        )
        counts.append(pairs.distinct().count())
        assert grouped.count() == 0
    assert counts[2] <= 2.5 * max(counts[1], 400) and counts[2] <= 8 * 800


def test_intersections():
    rnd = np.random.default_rng(1)
    sets = [np.unique(rnd.integers(0, 300, 80, dtype=np.uint64)) for _ in range(9)]
    found = near_dedup.intersections(sets[:4], sets[4:], width=16)
    assert found.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets[4:]] for a in sets[:4]]


def test_chains_and_empty_tables(docs):
    # each text is near to the next only
    words = [f"w{k}" for k in range(300)]
    chain = [(k, " ".join(words[k * 8 : k * 8 + 120])) for k in range(20)]
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs(chain), size=4).collect()}
    assert found == plain_groups(chain, 4)
    assert near_dedup.near_duplicates(docs([])).count() == 0


def test_signatures_estimate_similarity():
    rnd = np.random.default_rng(2)
    a = rnd.integers(0, 2**63, 1000, dtype=np.uint64)
    b = np.concatenate([a[:900], rnd.integers(0, 2**63, 100, dtype=np.uint64)])
    same = (near_dedup.signature(a, 4000) == near_dedup.signature(b, 4000)).mean()
    assert abs(same - 900 / 1100) < 0.03
    least = near_dedup.fewest_matches(0.8, 64, 1e-6)
    assert least == sorted(least) and 0 < least[-1] < 52


def test_components_of_random_links(spark, rows):
    rnd = random.Random(4)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)] + [(500 + k, 501 + k) for k in range(40)]
    links += [(700, 700 + k) for k in range(1, 50)] + [(5, 5), (5, 6), (6, 5)]
    parent = {}

    def root(d):
        while parent.setdefault(d, d) != d:
            d = parent[d]
        return d

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    named = {n for a, b in links if a != b for n in (a, b)}
    found = components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert rows(found, "node", "component") == sorted(((n, root(n)) for n in named), key=lambda r: [(True, str(v)) for v in r])


def plain_lines(data, min_chars=20, min_docs=3):
    strip = " \t\n\x0b\x0c\r"
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(strip))
    holders = {}
    for doc, text in data:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(-1 if doc is None else doc)
    out = []
    for doc, text in data:
        own = -1 if doc is None else doc
        lines = (text or "").split("\n")
        keep = [x for x in lines if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == own]
        out.append((doc, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


def line_corpus(seed=3):
    rnd = random.Random(seed)
    shared = [f"A shared line number {k} of the corpus" for k in range(30)] + ["short", "é" * 19, "é" * 20]
    data = [
        (k, "\n".join(rnd.choice(shared + [f"  own line {k} {j} of this document"]) for j in range(rnd.randint(0, 12))))
        for k in range(120)
    ]
    data += [(200 + k, "The line that very many of the documents hold \t\nand " + str(k)) for k in range(300)]
    data += [(600, None), (601, ""), (602, "\n\n"), (None, "a SHARED line number 1 of the corpus"), (5, "A shared line number 2 of the corpus")]
    return data + [(200, "The line that very many of the documents hold\nx"), data[3], data[3]]


@pytest.mark.parametrize("parts", ["1", "8", "40"])
def test_lines_of_plain_version(spark, docs, parts):
    data = line_corpus()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        for min_docs in (3, 1, 2):
            found = line_dedup.line_dedup(docs(data), min_docs=min_docs).collect()
            got = [(r["doc_id"], r["__n_lines"], r["__n_dropped"], r["text"] or "") for r in found]
            order = lambda r: (r[0] is not None, r[0] or 0, r[1:])
            assert sorted(got, key=order) == sorted(plain_lines(data, min_docs=min_docs), key=order)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_line_dedup_keeps_other_columns(docs):
    df = docs([(1, "x")]).selectExpr("doc_id", "text", "source AS n_dropped", "1 AS n_lines", "array(1) AS `a.b`")
    row = line_dedup.line_dedup(df).first()
    assert (row["n_dropped"], row["n_lines"], row["a.b"], row["text"]) == ("a", 1, [1], "x")
    assert line_dedup.line_dedup(docs([])).count() == 0
    assert line_dedup.keep_lines(None, None) == (1, None)
    assert hashlib.sha256(b"").hexdigest()
