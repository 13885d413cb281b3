"""Near-duplicate groups by MinHash with sequential Bayesian verification.

1. Each text becomes the set of its distinct word shingles (64-bit hashes), a digest of that set, a
   signature of 16-bit minima and one hash for each band of ``rows`` minima.
2. Documents with the same digest are one class, stood for by its smallest id; only these go on.
3. Classes that share a band are candidates. A bucket is never expanded into all pairs: first each class
   is compared with one pivot, the member of its buckets that meets most others over all bands, and
   the links so found are merged into components. Only buckets whose members are still apart are looked
   at again. If one of their components is large, the members outside it are compared with it and with
   each other in blocks, inside tasks that hand on links and no pairs. Of the others, buckets of up to
   ``CROWD`` members list their pairs; members of larger ones (texts of one template) are candidates only
   if they also share one of their rarest shingles, which every pair at the threshold does.
4. Candidates are compared a batch of minima at a time. After each batch the posterior probability
   (uniform prior) that the similarity reaches the threshold is bounded; pairs below the chosen miss
   probability are pruned, survivors are verified on their full sets.

Contract. Words are runs of ``[^\\x20\\x09-\\x0D]`` with A-Z in lower case; a text with fewer words than
a shingle is one shingle; a text without words, or null, has an empty set and is linked with nothing.
Two texts are linked if ``100 * intersection >= 100 * threshold * union``. Rows with the same id are
one document with several texts. A row without an id is linked with nothing, has no component and is
kept. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import functools
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lists, map_rows, own_names, prepare
from tidemark.llm.components import components
from tidemark.session import stage

ROWS, BANDS = 6, 32
#: Minima compared before the posterior is looked at again.
STEP = 32
#: Accepted probability that a pair at or above the threshold is pruned at a step.
MISS = 1e-6
#: Components of more classes than this are compared in blocks, of about so many classes.
LARGE, BLOCK = 50, 512
#: Buckets of more members than this list only pairs that share a rare shingle.
CROWD = 64
#: Counters that tell rare shingles from frequent ones.
COUNTERS = 1 << 18


class _WordHashes(dict):
    """64-bit hashes of words; starts anew when it is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _WordHashes()


@functools.cache
def _odd(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of ``text``."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    values = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    factors = _odd(size, 7)
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total += values[k : len(words) - size + 1 + k] * factors[k]
    return np.unique(_mix(total))


def signature(shingle_set: np.ndarray, count: int) -> np.ndarray:
    """``count`` minima of a non-empty set under different hash functions, as 16-bit numbers."""
    factors, shifts = _odd(count, 11)[:, None], _odd(count, 13)[:, None]
    least = np.full(count, np.iinfo(np.uint32).max, np.uint32)
    for start in range(0, len(shingle_set), 4096):  # bounded memory for very long texts
        part = shingle_set[None, start : start + 4096] * factors + shifts
        least = np.minimum(least, (part >> np.uint64(32)).astype(np.uint32).min(axis=1))
    return (_mix(least.astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)


def fewest_matches(threshold: float, count: int, miss: float) -> list[int]:
    """After 1, 2, ... ``count`` compared minima: the fewest equal ones a pair may have to go on.

    With a uniform prior the similarity after ``m`` of ``n`` equal minima has a Beta(m+1, n-m+1)
    posterior, whose tail above ``threshold`` is P(Binomial(n+1, threshold) <= m).
    """
    least = []
    for n in range(1, count + 1):
        tail, m = 0.0, -1
        while tail < miss and m < n:
            m += 1
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        least.append(m)
    return least


def sketches(docs: DataFrame, key: str, text: str, size: int, rows: int, bands: int) -> DataFrame:
    """(doc, n, digest, sig, bands) of every text."""

    def work(batch):
        n, digests, sigs, hashed = [], [], [], []
        for t in batch.column(1).to_pylist():
            found = shingles(t, size)
            n.append(len(found))
            if len(found):
                sig = signature(found, rows * bands)
                parts = sig.reshape(bands, rows)
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                sigs.append(sig.tobytes())
                band_seed = range(bands)
                hashed.append(np.array([xxhash.xxh3_64_intdigest(parts[b].tobytes(), seed=b) for b in band_seed], np.uint64))
            else:
                digests.append(None)
                sigs.append(None)
                hashed.append(np.empty(0, np.uint64))
        return [batch.column(0), n, digests, sigs, lists([h.view(np.int64) for h in hashed], "int64")]

    plain = own_names(docs, {"doc": key, "text": text})
    kind = plain.schema["doc"].dataType.simpleString()
    return map_rows(plain, work, f"doc {kind}, n bigint, digest binary, sig binary, bands array<bigint>")


def _survivors(pairs: DataFrame, sigs: DataFrame, threshold: float, count: int, miss: float) -> DataFrame:
    """(a, b) of the pairs that no step prunes."""
    least = fewest_matches(threshold, count, miss)
    kind = pairs.schema["a"].dataType.simpleString()
    a = sigs.select(F.col("doc").alias("a"), F.col("sig").alias("sig_a"))
    b = sigs.select(F.col("doc").alias("b"), F.col("sig").alias("sig_b"))

    def work(batch):
        left, right = (
            np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, count) for k in (2, 3)
        )
        open_pairs = np.arange(batch.num_rows)
        matches = np.zeros(batch.num_rows, np.int32)
        for start in range(0, count, STEP):
            end = min(start + STEP, count)
            matches[open_pairs] += (left[open_pairs, start:end] == right[open_pairs, start:end]).sum(axis=1)
            open_pairs = open_pairs[matches[open_pairs] >= least[end - 1]]
        chosen = pa.array(open_pairs)
        return [batch.column(0).take(chosen), batch.column(1).take(chosen)]

    return map_rows(pairs.join(a, "a").join(b, "b").select("a", "b", "sig_a", "sig_b"), work, f"a {kind}, b {kind}")


def _verified(pairs: DataFrame, docs: DataFrame, size: int, threshold: Fraction) -> DataFrame:
    """(a, b) of the pairs whose full sets reach the threshold."""
    kind = pairs.schema["a"].dataType.simpleString()
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    texts = docs.join(wanted, "doc", "left_semi").distinct()
    a = texts.select(F.col("doc").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("doc").alias("b"), F.col("text").alias("text_b"))
    up, down = threshold.numerator, threshold.denominator

    def work(batch):
        linked = []
        kept: dict[int, np.ndarray] = {}  # sets of this batch: a pivot meets many partners

        def of(doc, text):
            found = kept.get((doc, text))
            if found is None:
                found = kept[doc, text] = shingles(text, size)
            return found

        columns = [c.to_pylist() for c in batch.columns]
        for doc_a, doc_b, text_a, text_b in zip(*columns):
            x, y = of(doc_a, text_a), of(doc_b, text_b)
            common = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(down * common >= up * (len(x) + len(y) - common) > 0)
        mask = pa.array(linked, type=pa.bool_())
        return [batch.column(0).filter(mask), batch.column(1).filter(mask)]

    return map_rows(pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b"), work, f"a {kind}, b {kind}")


def _near(x: str, y: str, threshold: Fraction) -> Column:
    """Sets whose sizes differ too much cannot reach the threshold."""
    return F.least(x, y) * threshold.denominator >= F.greatest(x, y) * threshold.numerator


def intersections(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of each set of ``left`` with each of ``right``."""
    found = np.zeros((len(left), len(right)), np.float32)
    sets = [*left, *right]
    values, number = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    # only what both sides hold counts; numbered anew
    both = np.zeros((2, len(values)), bool)
    both[(row >= len(left)).astype(int), number] = True
    shared = both.all(axis=0)
    place = np.cumsum(shared) - 1
    use = shared[number]
    row, column = row[use], place[number[use]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for start in range(0, int(shared.sum()), width):  # bounded memory for long texts
        part = slice(*np.searchsorted(column, [start, start + width]))
        marks = np.zeros((len(sets), width), np.float32)
        marks[row[part], column[part] - start] = 1
        found += marks[: len(left)] @ marks[len(left) :].T
    return found


def _rare_prefixes(texts: DataFrame, size: int, threshold: Fraction) -> DataFrame:
    """(doc, n, shingle, indexed) for the rarest shingles of every text (doc, text).

    All sets are ordered by one rule, rarest first. Two sets at the threshold share one of the first
    ``n - ceil(t * n) + 1`` shingles of the larger set, which is also among the first
    ``n - ceil(2t / (1 + t) * n) + 1`` of the smaller one; those are marked ``indexed``. How frequent a shingle
    is tells a fixed number of counters, so that the order fits into every task; a shared counter costs time only.
    """
    kind = texts.schema["doc"].dataType.simpleString()
    up, down = threshold.numerator, threshold.denominator

    def hashes(batch):
        sets = [shingles(t, size).view(np.int64) for t in batch.column(1).to_pylist()]
        return [lists(sets, "int64")]

    slots = map_rows(texts, hashes, "sets array<bigint>").select(F.explode("sets").alias("s"))
    counted = slots.groupBy(F.pmod("s", F.lit(COUNTERS)).cast("int").alias("slot")).agg(F.count(F.lit(1)).alias("uses")).toArrow()
    uses = np.zeros(COUNTERS, np.uint32)
    uses[counted["slot"].to_numpy()] = np.minimum(counted["uses"].to_numpy(), np.iinfo(np.uint32).max)

    def rarest(batch):
        docs, n, found, marks = [], [], [], []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            values = shingles(text, size)
            count = len(values)
            if not count:
                continue
            probe = count + up * count // -down + 1
            index = count + 2 * up * count // -(up + down) + 1
            order = np.lexsort((values, uses[values.view(np.int64) % COUNTERS]))[:probe]
            docs.append(doc)
            n.append(count)
            found.append(values[order].view(np.int64))
            marks.append(index)
        return [pa.array(docs, type=batch.schema.field(0).type), n, lists(found, "int64"), marks]

    rows = map_rows(texts, rarest, f"doc {kind}, n bigint, found array<bigint>, index int")
    each = rows.select("doc", "n", "index", F.posexplode("found").alias("place", "shingle"))
    return each.select("doc", "n", "shingle", (F.col("place") < F.col("index")).alias("indexed"))


def _crowded_pairs(crowd: DataFrame, docs: DataFrame, size: int, threshold: Fraction) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a, b) of the classes in ``crowd`` (doc, component), and groups (doc, large) for blocks.

    A pair shares a rare shingle and lies in two components. Shingles that more than ``BLOCK`` sets have
    indexed are handed back as groups, so the pairs grow in proportion to the listed shingles.
    """
    texts = docs.join(crowd.select("doc").distinct(), "doc", "left_semi").distinct()
    prefixes = stage(_rare_prefixes(texts, size, threshold).join(crowd, "doc"), "prefixes")
    held = prefixes.where("indexed").groupBy("shingle").agg(F.count(F.lit(1)).alias("sets"))
    heavy = held.where(F.col("sets") > BLOCK)
    light = prefixes.join(heavy, "shingle", "left_anti")
    a = light.select("shingle", F.col("doc").alias("a"), F.col("n").alias("n_a"), F.col("component").alias("c_a"))
    b = light.where("indexed").select("shingle", F.col("doc").alias("b"), F.col("n").alias("n_b"), F.col("component").alias("c_b"))
    pairs = a.join(b, "shingle").where((F.col("n_b") <= F.col("n_a")) & (F.col("c_a") != F.col("c_b")) & _near("n_a", "n_b", threshold))
    grouped = prefixes.join(heavy, "shingle", "left_semi").select("doc", F.col("shingle").alias("large")).distinct()
    return pairs.select("a", "b"), grouped


def _block_links(outside, member, docs, sigs, size: int, threshold: Fraction, count: int, miss: float) -> DataFrame:
    """Links (a, b) of the members in ``outside`` (doc, large) with those in ``member`` and each other.

    ``member`` holds the classes of each large component, joined already; it is None for groups without one.

    Both sides are dealt into blocks of about ``BLOCK`` documents by a hash, and every pair of blocks is
    one group of bounded size. Pairs go through the same steps as elsewhere, in place. A group hands on
    only links that join what its earlier ones have not, at most one for each of its documents.
    """
    kind = docs.schema["doc"].dataType
    least = fewest_matches(float(threshold), count, miss)
    asked = outside.groupBy("large").agg(F.count(F.lit(1)).alias("asks"))
    every = outside.withColumn("inside", F.lit(False))
    if member is not None:
        every = member.withColumn("inside", F.lit(True)).unionByName(every)
    sizes = every.groupBy("large").agg(F.count(F.lit(1)).alias("members")).join(asked, "large").select(
        "large",
        F.ceil(F.col("members") / BLOCK).cast("int").alias("columns"),
        F.ceil(F.col("asks") / BLOCK).cast("int").alias("lines"),
    )
    # repeated rows of one document count once
    needed = every.select("doc").distinct()
    texts = docs.join(needed, "doc", "left_semi").distinct().join(sigs.join(needed, "doc", "left_semi").distinct(), "doc")
    deal = lambda n: F.pmod(F.xxhash64("doc"), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = outside.join(sizes, "large").select("doc", "large", deal("lines").alias("line"), all_of("columns").alias("column"))
    right = every.join(sizes, "large").select("doc", "large", "inside", deal("columns").alias("column"), all_of("lines").alias("line"))
    up, down = threshold.numerator, threshold.denominator

    def work(asking: pa.Table, others: pa.Table) -> pa.Table:
        out: tuple[list, list] = ([], [])
        if len(asking) and len(others):
            a, b = asking["doc"].to_pylist(), others["doc"].to_pylist()
            x, y = (np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint16).reshape(-1, count) for t in (asking, others))
            alive = np.array(a, dtype=object)[:, None] != np.array(b, dtype=object)[None, :]
            matches = np.zeros(alive.shape, np.int16)
            for start in range(0, count, STEP):
                end = min(start + STEP, count)
                for k in range(start, end):
                    matches += x[:, k, None] == y[None, :, k]
                alive &= matches >= least[end - 1]
            if alive.any():
                rows, columns = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
                asked_texts, other_texts = asking["text"].to_pylist(), others["text"].to_pylist()
                sets = [shingles(asked_texts[r], size) for r in rows], [shingles(other_texts[c], size) for c in columns]
                common = intersections(*sets)
                both = np.add.outer(*[np.array([len(s) for s in side]) for side in sets]) - common
                linked = (down * common >= up * both) & alive[np.ix_(rows, columns)]
                # what is joined already has one label; the large component is joined from the start
                label = np.where(np.asarray(others["inside"])[columns], 0, 1 + np.arange(len(columns)))
                for r in np.flatnonzero(linked.any(axis=1)):
                    hits = np.flatnonzero(linked[r])
                    joined, first = np.unique(label[hits], return_index=True)
                    for hit in hits[first]:
                        out[0].append(a[rows[r]])
                        out[1].append(b[columns[hit]])
                    label[np.isin(label, joined)] = joined[0]
        types = asking.schema.field("doc").type
        return pa.table([pa.array(c, type=types) for c in out], names=["a", "b"])

    keys = ["large", "line", "column"]
    asking = left.join(texts, "doc").groupBy(*keys)
    others = right.join(texts, "doc")
    others = others.toDF(*others.columns).groupBy(*keys)  # columns of their own
    return asking.cogroup(others).applyInArrow(
        work, f"a {kind.simpleString()}, b {kind.simpleString()}"
    )


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = 5,
    threshold: float = 0.8,
    rows: int = ROWS,
    bands: int = BANDS,
    miss: float = MISS,
) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` and ``kept`` of every row."""
    prepare(docs.sparkSession)
    exact = Fraction(str(threshold))
    plain = own_names(docs, {"doc": key, "text": text})
    all_sketches = stage(sketches(docs, key, text, size, rows, bands), "sketches")
    known = all_sketches.where(F.col("doc").isNotNull() & F.col("digest").isNotNull())
    # one document stands for each distinct set
    classes = stage(known.groupBy("digest").agg(F.min("doc").alias("rep")), "classes")
    chosen = known.join(
        classes, (known["digest"] == classes["digest"]) & (known["doc"] == classes["rep"]), "left_semi"
    ).dropDuplicates(["doc", "digest"])
    buckets = chosen.select("doc", "n", F.explode("bands").alias("bucket"))
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = buckets.join(sizes, "bucket")
    # the more other classes a class meets, the better it stands for its buckets
    weight = shared.groupBy("doc").agg(F.sum("members").alias("weight"))
    members = stage(shared.join(weight, "doc").select("bucket", "doc", "n", "weight"), "buckets")
    pivots = members.groupBy("bucket").agg(F.max(F.struct("weight", F.negative("doc").alias("doc"), "n")).alias("p"))
    sigs = known.select("doc", "sig")

    def links_of(pairs: DataFrame) -> DataFrame:
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        alive = stage(_survivors(pairs, sigs, threshold, rows * bands, miss), "pairs")
        return stage(_verified(alive, plain, size, exact), "verified")

    star = members.join(pivots, "bucket").where((F.negative("doc") != F.col("p.doc")) & _near("n", "p.n", exact))
    best = star.groupBy("doc").agg(F.max(F.struct("p.weight", "p.doc")).alias("p"))
    links = links_of(best.select(F.col("doc").alias("a"), F.negative("p.doc").alias("b")))
    groups = components(links)

    # buckets whose members are still apart
    large = groups.groupBy("component").agg(F.count(F.lit(1)).alias("nodes")).where(F.col("nodes") > LARGE)
    placed = members.join(groups, members["doc"] == groups["node"], "left").select(
        "bucket", "doc", "n", F.coalesce("component", "doc").alias("component")
    )
    apart = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
    rest = stage(placed.join(apart, "bucket", "left_semi").join(large, "component", "left"), "apart")
    with_large = stage(rest.where("nodes IS NOT NULL").select("bucket", "component", "nodes").distinct(), "large")
    # a member and a large component of another member of the bucket, from the smaller to the larger
    outside = (
        rest.alias("x").join(with_large.alias("c"), "bucket")
        .where("coalesce(x.nodes, 1) < c.nodes OR (x.nodes = c.nodes AND x.component < c.component)")
        .select(F.col("x.doc").alias("doc"), F.col("c.component").alias("large")).distinct()
    )
    outside = stage(outside, "outside")
    wanted = outside.select("large").distinct()
    member = groups.join(wanted, groups["component"] == wanted["large"]).select(F.col("node").alias("doc"), "large")

    def blocks(group: DataFrame, joined: DataFrame | None) -> DataFrame:
        return stage(_block_links(group, joined, plain, sigs, size, exact, rows * bands, miss), "blocks")

    more = blocks(outside, member)
    without = rest.join(with_large, "bucket", "left_anti")
    crowds = without.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > CROWD)
    few = without.join(crowds, "bucket", "left_anti")
    left = few.select("bucket", F.col("doc").alias("a"), F.col("n").alias("n_a"), F.col("component").alias("c_a"))
    right = few.select("bucket", F.col("doc").alias("b"), F.col("n").alias("n_b"), F.col("component").alias("c_b"))
    pairs = left.join(right, "bucket").where((F.col("a") < F.col("b")) & (F.col("c_a") != F.col("c_b")) & _near("n_a", "n_b", exact))
    pairs = pairs.select("a", "b")
    crowd = stage(without.join(crowds, "bucket", "left_semi").select("doc", "component").distinct(), "crowd")
    if not crowd.isEmpty():
        rare, grouped = _crowded_pairs(crowd, plain, size, exact)
        pairs = pairs.unionByName(rare)
        more = more.unionByName(blocks(stage(grouped, "grouped"), None))
    groups = components(links.unionByName(links_of(pairs)).unionByName(more))
    # back from classes to documents
    named = classes.join(groups, classes["rep"] == groups["node"], "left").select(
        F.col("digest").alias("class"), F.coalesce("component", "rep").alias("of_class")
    )
    by_doc = all_sketches.select("doc", "n", "digest").join(named, F.col("digest") == F.col("class"), "left")
    component = F.when(F.col("doc").isNotNull(), F.coalesce("of_class", "doc"))
    return by_doc.select(
        F.col("doc").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"),
    )
