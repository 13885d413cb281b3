"""Base spans against the patterns as regular expressions, the graph against a plain one, and what it discovers."""

import hashlib
import math
import random
import re
import time
from collections import defaultdict

from tidemark.llm import private_data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    found = [
        (m.start(), n, m.end())
        for n, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if passes(kind, m.group())
    ]
    return sorted(found)


def number(rnd):
    while True:
        digits = "".join(rnd.choice("0123456789") for _ in range(rnd.randint(12, 19)))
        if passes("card", digits):
            return digits if rnd.random() < 0.5 else "-".join(re.findall("..?.?.?", digits))


def made(count, seed=4):
    rnd = random.Random(seed)
    parts = [
        lambda: "".join(rnd.choice("a1.@-+ 09()é") for _ in range(rnd.randint(0, 14))),
        lambda: ".".join(str(rnd.choice([1, 25, 255, 256, 999, "007", ""])) for _ in range(rnd.randint(2, 9))),
        lambda: f"{rnd.choice(['a.b', 'x%', '@', 'né'])}@{rnd.choice(['m-1.example.com', 'b', 'c..d', 'e.f.'])}",
        lambda: f"+{rnd.randint(1, 99)} ({rnd.randint(1, 999)}) {rnd.randint(1, 9999)}-{rnd.randint(0, 99999)}",
        lambda: number(rnd),
        lambda: rnd.choice(["word", "\n", "日本", " ", ","]),
    ]
    return ["".join(rnd.choice(parts)() + rnd.choice(["", " "]) for _ in range(rnd.randint(0, 12))) for _ in range(count)]


def test_base_spans_are_those_of_the_patterns():
    texts = made(8000)
    assert sum(map(len, map(plain, texts))) > 2000
    for text in texts:
        assert private_data.base_spans(text) == plain(text), text


def test_long_texts_take_one_pass():
    start = time.perf_counter()
    for text in ("a" * 10**6, "1" * 10**6, "1." * 10**6, "a@" * 10**6, "1" * 10**6 + "..1.1", "+1" * 10**6, "1 " * 10**6,
                 "+1" + " " * 10**6, "a1" * 10**6, "x1 " * 10**6, "@a." * 10**6):
        private_data.examine(text)
    assert time.perf_counter() - start < 60


def corpus():
    rnd = random.Random(7)
    filler = ["lorem", "ipsum", "dolor", "sit", "amet", "elit"]
    rows, wanted = [], {}
    word = lambda: " ".join(rnd.choice(filler) for _ in range(rnd.randint(1, 6)))
    for k in range(40):  # seeds behind a telling context
        rows.append((k, f"{word()} call me at +1 ({rnd.randint(100, 999)}) 555-{rnd.randint(1000, 9999)} {word()}"))
    for k in range(40, 44):  # the same context, a form the patterns do not know
        before, unseen = f"{word()} call me at ", f"0{rnd.randint(100, 999)} 555 {rnd.randint(1000, 9999)}"
        rows.append((k, f"{before}{unseen} {word()}"))
        wanted[k] = f"phone:{len(before)}:{len(before) + len(unseen)}"
    for k in range(44, 200):  # numbers that are nothing, and seeds in contexts that tell nothing
        rows.append((k, f"{word()} {rnd.randint(1000, 10**9)} {word()} {word()} {number(rnd)} {word()}"))
    return rows, wanted


def test_unseen_identifiers_are_discovered(docs):
    rows, wanted = corpus()
    rows += [rows[40]] * 3 + [(None, None), (500, "")]
    found = private_data.find(docs(rows).withColumnRenamed("source", "spans")).collect()
    assert len(found) == len(rows)
    empty = hashlib.sha256(b"").hexdigest()
    for r in found:
        text = dict(rows)[r["doc_id"]]
        base = plain(text)
        assert r["base_sha256"] == hashlib.sha256(private_data.listed(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(n == i for _, n, _ in base) for i in range(4)]
        if r["doc_id"] in wanted:
            assert (r["spans"], r["n_added"]) == (wanted[r["doc_id"]], 1)
        else:
            assert (r["spans"], r["n_added"]) == (private_data.listed(base), 0)
        if not text:
            assert (r["base_sha256"], r["spans"]) == (empty, "")
    assert private_data.find(docs([])).count() == 0


def plain_beliefs(edges, confidence, rounds):
    by_pattern = defaultdict(dict)
    for p, i, k in edges:
        by_pattern[p][i] = k
    scores, found = {}, {}
    for _ in range(rounds):
        found = {}
        for p, own in by_pattern.items():
            for kind in range(4):
                mass = sum(1.0 if k == kind else scores.get(i, (0, -1))[0] * (k < 0 and scores.get(i, (0, -1))[1] == kind)
                           for i, k in own.items())
                n, z = len(own), 1.96
                share = min(mass, n) / n
                low = (share + z * z / (2 * n) - z * math.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
                if mass and low >= confidence:
                    found[p] = (low, kind)
        scores = {}
        for i in {i for _, i, k in edges if k < 0}:
            for kind in range(4):
                near = [found[p][0] for p, own in by_pattern.items() if own.get(i, 0) == -1 and p in found and found[p][1] == kind]
                if near:
                    scores[i] = max(scores.get(i, (0, -1)), (1 - math.prod(1 - c for c in near), kind))
    return found


def test_scores_are_those_of_a_plain_graph(spark):
    rnd = random.Random(3)
    edges = {}
    for _ in range(900):
        instance = rnd.randrange(200)
        kind = instance % 4 if instance < 140 else -1
        pattern = rnd.randrange(30) * 4 + (kind if rnd.random() < 0.9 and kind >= 0 else rnd.randrange(4))
        edges[(f"p{pattern % 60}", f"i{instance}")] = kind
    rows = [(p, i, k) for (p, i), k in edges.items()]
    df = spark.createDataFrame(rows, "pattern string, instance string, kind int")
    for rounds in (1, 2, 3):
        found = private_data.believed_patterns(df, 0.45, rounds).collect()
        expected = plain_beliefs(rows, 0.45, rounds)
        assert len(expected) > 3
        assert {r["pattern"]: (round(r["confidence"], 9), r["kind"]) for r in found} == {
            p: (round(c, 9), k) for p, (c, k) in expected.items()
        }
