"""Personal data: fixed patterns, and unseen identifiers found by the words around them.

Spans that the fixed patterns find (e-mail, ip, card and phone) are seeds. The words before and after a seed
are lexical patterns, and so are those around every other stretch that looks like an identifier (words
with digits). Spark keeps them as a graph of patterns and instances and scores it in rounds:

* A pattern's share of a kind is the number of its distinct instances of that kind (1 for a seed, its score for
  a discovered one) over all its distinct instances; its confidence is the lower end of the 95 % Wilson
  interval of that share. Patterns below ``confidence`` are not believed.
* A stretch that is no seed has the score 1 - prod(1 - confidence) over the believed patterns it stands in.

After ``rounds`` the stretches that stand in a believed pattern become spans of its kind. An instance counts
once for a pattern however often it is met, so copies of a document add nothing.

Contract. Places are code points, ends exclusive. Spans of a kind do not overlap; matches that fail their kind's
test (parts of an ip, digits and Luhn sum of a card, digits of a phone) are dropped and not tried again. Base
spans always stay; added ones never overlap one. A null or empty text has none: zeros, the hash of the empty
string, an empty list. Every row gives one row, repeated rows and null keys included; an empty table gives
an empty one. Only the key and the text are read, so other columns cannot clash. Texts of any length take one pass:
no search goes back over more than one match.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, own_names
from tidemark.session import stage

KINDS = ("email", "ip", "card", "phone")
#: A believed pattern's least confidence, and the rounds of scoring.
CONFIDENCE, ROUNDS = 0.7, 3
#: A stretch that may be an identifier: at most so many characters, at least so many digits.
LONGEST, DIGITS = 64, 4

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9][0-9.]*")
_CARD = re.compile(r"[0-9]+(?:[ -][0-9]+)*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_BLANK = re.compile(r"[\x20\x09-\x0D]")
_NOT_DIGITS = re.compile(r"[^0-9]+")
_EDGE = re.compile(r"^[^A-Za-z0-9]+|[^A-Za-z0-9]+$")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Letters before each @, however far they reach, and the domain after it."""
    free = 0
    at = text.find("@")
    while at >= 0:
        # no letter of a name is an @, so what lies before the last one need not be looked at again
        name = at - len(text[free:at]) + len(text[free:at].rstrip(_LOCAL))
        free = at + 1
        domain = _DOMAIN.match(text, at + 1) if name < at else None
        if domain:
            free = domain.end()
            yield name, free
        at = text.find("@", free)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers with single dots between them."""
    for found in _NUMBERS.finditer(text):
        parts = found.group().split(".")
        if len(parts) < 4:
            continue
        place, starts = found.start(), []
        for part in parts:
            starts.append(place)
            place += len(part) + 1
        k = 0
        while k + 4 <= len(parts):
            four = parts[k : k + 4]
            if not all(four):
                k += 1
                continue
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield starts[k], starts[k + 3] + len(four[3])
            k += 4


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _CARD.finditer(text):
        if 12 <= found.end() - found.start():
            digits = _NOT_DIGITS.sub("", found.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield found.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for found in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGITS.sub("", found.group())) <= 15:
                yield found.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all matches that pass, in order."""
    found = [(s, 0, e) for s, e in emails(text)]
    if _DIGIT.search(text):
        for kind, search in enumerate((addresses, cards, phones), 1):
            found.extend((s, kind, e) for s, e in search(text))
    return sorted(found)


def stretches(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Neighbouring words with digits that may be an identifier and overlap no span of ``taken``."""
    words: list[tuple[int, int]] = []
    place = 0
    digit = _DIGIT.search(text)
    while digit:
        at = digit.start()
        start = at
        while start > place and at - start <= LONGEST and not _BLANK.match(text, start - 1):
            start -= 1
        blank = _BLANK.search(text, at)
        place = blank.start() if blank else len(text)
        words.append((start, place))
        digit = _DIGIT.search(text, place)
    spans = iter(sorted((s, e) for s, _, e in taken))
    span = next(spans, None)
    joined: list[tuple[int, int]] = []
    apart = True
    for start, end in words:
        while span and span[1] <= start:
            span = next(spans, None)
        if span and span[0] < end:
            apart = True
            continue
        if not apart and text[joined[-1][1] : start] == " ":
            joined[-1] = (joined[-1][0], end)
        else:
            joined.append((start, end))
        apart = False
    for start, end in joined:
        if end - start > 2 * LONGEST:
            continue
        whole = text[start:end]
        inner = _EDGE.sub("", whole)
        first = start + whole.find(inner) if inner else start
        if len(inner) <= LONGEST and sum(map(inner.count, "0123456789")) >= DIGITS:
            yield first, first + len(inner)


def _context(words: str) -> list[str]:
    return [_NOT_PLAIN.sub("0", w) for w in words.lower().split()]


_NOT_PLAIN = re.compile(r"[0-9]+")


def patterns(text: str, start: int, end: int) -> list[str]:
    """Two words before, one before, and one on either side; digits count as one."""
    before = _context(text[max(0, start - 80) : start])
    after = _context(text[end : end + 40])
    joint = lambda at: "" if 0 < at < len(text) and not _BLANK.match(text, at - 1) else " "
    left = ["^", "^", *before][-2:]
    right = (after or ["$"])[0]
    glue, close = joint(start), "" if end < len(text) and not _BLANK.match(text, end) else " "
    return [f"{left[0]} {left[1]}{glue}_", f"{left[1]}{glue}_", f"{left[1]}{glue}_{close}{right}"]


def examine(text: str | None) -> tuple[list, list]:
    """The base spans, and mentions (start, end, kind, instance, patterns) of seeds and other stretches (kind -1)."""
    if not text:
        return [], []
    spans = base_spans(text)
    seen = [(s, e, kind) for s, kind, e in spans] + [(s, e, -1) for s, e in stretches(text, spans)]
    return spans, [(s, e, kind, text[s:e].lower(), patterns(text, s, e)) for s, e, kind in seen]


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def _examine_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    kind = df.schema[key].dataType.simpleString()

    def work(batch):
        found = [examine(t) for t in batch.column(1).to_pylist()]
        counts = [[sum(k == n for _, k, _ in spans) for spans, _ in found] for n in range(len(KINDS))]
        base = [[{"start": s, "kind": k, "end": e} for s, k, e in spans] for spans, _ in found]
        names = ("start", "end", "kind", "instance", "patterns")
        seen = [[dict(zip(names, m)) for m in mentions] for _, mentions in found]
        digests = [hashlib.sha256(listed(spans).encode()).hexdigest() for spans, _ in found]
        return [batch.column(0), *counts, digests, base, seen]

    schema = (
        f"`{key}` {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, "
        "base array<struct<start: bigint, kind: int, end: bigint>>, "
        "mentions array<struct<start: bigint, end: bigint, kind: int, instance: string, patterns: array<string>>>"
    )
    return map_rows(own_names(df, {key: key, text: text}), work, schema)


def wilson(mass: Column, total: Column, z: float = 1.96) -> Column:
    """The lower end of the interval of a share."""
    share, square = mass / total, z * z
    spread = F.sqrt(share * (1 - share) / total + square / (4 * total * total))
    return (share + square / (2 * total) - z * spread) / (1 + square / total)


def believed_patterns(edges: DataFrame, confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """``pattern``, ``kind`` and ``confidence`` of the believed patterns of ``edges`` (pattern, instance, kind or -1), all distinct."""
    totals = stage(
        edges.groupBy("pattern").agg(
            F.count("*").alias("total"), *[F.sum((F.col("kind") == k).cast("double")).alias(f"seeds_{k}") for k in range(len(KINDS))]
        ),
        "patterns",
    )
    seeds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"seeds_{k}").alias("mass")) for k in range(len(KINDS))]))
    mass = totals.select("pattern", seeds.alias("one")).select("pattern", "one.kind", "one.mass").where("mass > 0")
    unknown = edges.where("kind < 0").select("pattern", "instance")
    found = None
    for _ in range(rounds):
        if found is not None:
            scores = unknown.join(found, "pattern").groupBy("instance", "kind").agg(
                (1 - F.exp(F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(1 - 1e-9)))))).alias("score")
            )
            # an instance speaks for the kind it most likely is
            scores = scores.groupBy("instance").agg(
                F.max(F.struct("score", F.col("kind"))).alias("best")
            ).select("instance", "best.kind", "best.score")
            discovered = unknown.join(scores, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("mass"))
            all_mass = mass.unionByName(discovered).groupBy("pattern", "kind").agg(F.sum("mass").alias("mass"))
        else:
            all_mass = mass
        scored = all_mass.join(totals.select("pattern", "total"), "pattern").withColumn(
            "confidence", wilson(F.least("mass", "total"), F.col("total"))
        )
        # shares of a pattern's kinds add up to 1, so no two are believed with more than a half
        found = stage(
            scored.where(F.col("confidence") >= confidence).groupBy("pattern").agg(
                F.max(F.struct("confidence", "kind")).alias("best")
            ).select("pattern", "best.kind", "best.confidence"),
            "believed",
        )
    return found


def find(
    df: DataFrame, key: str = "doc_id", text: str = "text", confidence: float = CONFIDENCE, rounds: int = ROUNDS
) -> DataFrame:
    """Numbers and hash of the base spans, ``n_added`` and the list of all ``spans`` of every text."""
    # a row's number is stored with it, so it is the same wherever the rows are read
    rows = stage(_examine_rows(df, key, text).withColumn("__row", F.monotonically_increasing_id()), "examined")
    mentions = rows.select("__row", F.explode("mentions").alias("m"))
    edges = stage(
        mentions.select(F.explode("m.patterns").alias("pattern"), "m.instance", "m.kind").groupBy("pattern", "instance").agg(
            F.max("kind").alias("kind")
        ),
        "edges",
    )
    found = believed_patterns(edges, confidence, rounds)
    unseen = mentions.where("m.kind < 0").select("__row", "m.start", "m.end", F.explode("m.patterns").alias("pattern"))
    added = unseen.join(found, "pattern").groupBy("__row", "start", "end").agg(
        F.max(F.struct("confidence", "kind")).alias("best")
    )
    # the spans of one row, no more than its text has
    by_row = added.groupBy("__row").agg(
        F.collect_list(F.struct("start", F.col("best.kind").alias("kind"), "end")).alias("added")
    )
    spans = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast("array<struct<start: bigint, kind: int, end: bigint>>"))))
    names = F.array(*[F.lit(n) for n in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
    whole = rows.drop("mentions").join(by_row, "__row", "left")
    return whole.select(
        key, *[f"n_{n}" for n in KINDS], "base_sha256", F.array_join(F.transform(spans, one), ",").alias("spans"),
        F.coalesce(F.size("added"), F.lit(0)).cast("bigint").alias("n_added"),
    )
