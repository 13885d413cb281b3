"""Page text, quality rules, sharding, search and toxicity."""

import random
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ann, html_text, quality_rules, queries, sharding, toxicity
from tidemark.llm.common import prepare

PAGE = (
    '<!DOCTYPE html><html><head><title>Head line</title><style>p{{}}</style><script>var t="</p>";</script></head><body>'
    "<header>Site name</header><nav><ul><li><a href=/x>Home</a></li><li><a>About us</a></li></ul></nav>"
    '<!-- c --><div class="ad">Buy this now, it is cheap.</div>{}<form>Send <input></form>'
    '<div id="comments"><p>First comment that somebody wrote here.</p></div><footer>&copy; site, all rights</footer></body></html>'
)
ARTICLE = "<article><h1>A title &amp; more</h1><p><b>First</b> block\n of &lt;text&gt;<br>goes on<p>Second one.</p></article>"


def test_article_of_a_page():
    model = html_text.Model({}, {})
    assert html_text.main_text(PAGE.format(ARTICLE), model) == "A title & more\nFirst block of <text> goes on\nSecond one."
    inner = '<article><p>One two three four five six seven.</p><aside>Not this</aside><p>Eight nine ten eleven.</p></article>'
    assert html_text.main_text(PAGE.format(inner), model) == "One two three four five six seven.\nEight nine ten eleven."


@pytest.mark.parametrize(
    "page, text",
    [(None, ""), ("", ""), ("<", "<"), ("<p", ""), ("a<b", "a"), ("a < b", "a < b"), ("<p>x", "x"), ("<!-- x", ""),
     ("<script>x", ""), ("</p></p>", ""), ("<br><br>", ""), ("<p>a&nbsp; b</p>", "a b"), ("<div class='x>y", "y"),
     ("<nav>only a menu</nav>", ""), ("<p></p><p>a</p>\n<p> </p><p>b</p>", "a\nb"), ("<p>a" * 3000, "\n".join("a" * 3000))],
)
def test_odd_pages(page, text):
    assert html_text.main_text(page, html_text.Model({}, {})) == text


def test_omitted_end_tags():
    model = html_text.Model({}, {})
    words = lambda k: f"One two three four five six seven {k}."
    inner = "<article><p>{}<p class=ad>Buy.<p>{}<ul><li class=share>Us<li>{}<ul><li>{}</ul><li>{}</ul></article>".format(*map(words, range(5)))
    assert html_text.main_text(PAGE.format(inner), model) == "\n".join(map(words, range(5)))
    cells = f"<article><table><tr><td class=ad>Buy<td>{words(1)}<tr><td>{words(2)}<table><tr><td>{words(3)}</table></table></article>"
    assert html_text.main_text(PAGE.format(cells), model) == "\n".join(map(words, (1, 2, 3)))
    for tag in ("p", "li", "div"):
        assert html_text.main_text(f"<{tag}>some words here that count" * 100_000, model).count("\n") == 99_999


STORY = "<h1>Title of it</h1><p>" + "word and word " * 30 + "</p><p>" + "more and more " * 20 + "</p>"


@pytest.mark.parametrize("story", [STORY, f"<article>{STORY}</article>"])
@pytest.mark.parametrize(
    "around",
    ["<form id=aspnetForm>{}</form>", "<div class='layout has-sidebar'>{}<aside>x y z</aside></div>", "<div id='search-page'>{}</div>",
     "<div class='page-header-visible'>{}</div>", "<div class='content-menu-open'>{}</div>", "<div class=widget><div class=banner>{}</div></div>",
     "<form><header><h1>Site</h1></header><nav>a b c</nav><div class=menu-wrap>{}</div><footer>f g</footer></form>",
     "<div id=comments-open>{}<div class=comments><p>aa bb cc</p></div></div>",
     "<div>{}</div><section class=comments><article><p>" + "readers write " * 300 + "</p></article></section>"],
)
def test_wrappers_named_as_furniture(around, story):
    page = f"<html><body><div class=ad>buy it</div>{around.format(story)}<footer>foot words here</footer></body></html>"
    wanted = "\n".join(["Title of it", " ".join(["word and word"] * 30), " ".join(["more and more"] * 20)])
    assert html_text.main_text(page, html_text.Model({}, {})) == wanted


def test_labelled_pages_overrule_names():
    page = "<body><div class=widget><p>Some words of the text.</p></div><div class=ad>Buy.</div></body>"
    assert html_text.main_text(page, html_text.Model({}, {})) == ""
    assert html_text.main_text(page, html_text.Model({}, {".widget": 0.0})) == "Some words of the text."


def test_scan_against_all_runs():
    rng = random.Random(3)
    for _ in range(500):
        scores = [rng.choice([-2, -1, -0.5, 0, 0.5, 1, 3]) for _ in range(rng.randrange(12))]
        runs = [(sum(scores[a : b + 1]), a, b) for a in range(len(scores)) for b in range(a, len(scores))]
        most = max([r[0] for r in runs], default=0)
        got = html_text.best_run(scores)
        assert (got is None) == (most <= 0)
        if got:
            assert sum(scores[got[0] : got[1] + 1]) == most and got[1] == min(b for total, _, b in runs if total == most)


def test_whole_page_table(spark):
    folder = "/root/testdata/sf0.001"
    got = {r["page_id"]: r for r in queries.QUERIES["op2_html_text"](spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    told = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert got.keys() == {r["page_id"] for r in pages}
    known = [(got[r["page_id"]]["text"], told[int(m[1])]) for r in pages if (m := re.match(queries.PAGE_DOC, r["url"])) and int(m[1]) in told]
    # the heading of a page repeats how its document begins
    lines = [[" ".join(line.split()) for line in (text or "").split("\n")] for _, text in known]
    right = sum(found.split("\n")[1:] == [line for line in wanted if line] for (found, _), wanted in zip(known, lines))
    assert known and right >= 0.95 * len(known), (right, len(known))


def test_weights_from_labelled_pages(spark):
    pages = [(k, PAGE.format(f"<div class=story><p>Words of page {k} that are the text.</p><p>And a second line here.</p></div>"),
              f"Words of page {k} that are the text.\nAnd a second line here.") for k in range(20)]
    df = spark.createDataFrame(pages, "page_id bigint, html string, text string")
    model = html_text.fit(df)
    assert model.keys["nav"] < -1 and model.keys["p"] <= 0 and model.tags["li"] < model.tags["p"] < 0
    found = {r["page_id"]: r["text"] for r in html_text.extract(df, model).collect()}
    assert found == {k: text for k, _, text in pages}
    none = html_text.fit(df.limit(0))
    assert none.tags == {} and html_text.extract(df.limit(0), none).count() == 0


def plain_repeats(text):
    words = text.split()
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    return len({p for places in seen.values() if len(places) > 1 for i in places for p in (i, i + 1, i + 2)})


def test_base_measures(spark, docs):
    prepare(spark)
    rnd = random.Random(1)
    data = [" ".join(rnd.choice("ab*cé") for _ in range(rnd.randint(0, 40))) for _ in range(60)]
    data += [None, "", " ", "a a a a", "x\nx\n\n \nx y", "long " * 30_000]
    df = docs(list(enumerate(data))).withColumn("n_words", F.lit("clash")).withColumn("kept", F.lit(1))
    for r in quality_rules.quality_rules(df).collect():
        text = data[r["row"]["doc_id"]] or ""
        lines = [x for x in text.split("\n") if x.split()]
        words, repeats = text.split(), plain_repeats(text)
        assert r["n_words"] == len(words) and r["word_chars"] == sum(map(len, words))
        assert r["n_symbols"] == sum(c in quality_rules.SYMBOLS for c in text)
        assert r["n_dup_lines"] == len(lines) - len(set(lines)) and r["n_repeat_words"] == repeats
        assert r["base_failed"] == (len(words) < 50 or 100 * repeats > 50 * len(words))
        assert r["row"]["n_words"] == "clash" and r["kept"] == (not r["base_failed"])
    assert quality_rules.quality_rules(docs([])).count() == 0


def test_depleted_documents(spark, docs):
    letters = lambda n: "".join(chr(97 + int(c)) for c in str(n))
    own = lambda k: " ".join(f"own{letters(k)}x{letters(j)}" for j in range(60))
    notice = " ".join(f"notice{j}" for j in range(60))
    copy = own(999)
    data = [(k, f"{notice}\nown line {letters(k)} here" if k < 40 else own(k)) for k in range(100)]
    data += [(200 + k, copy) for k in range(100)]  # exact copies are one text
    data += [(400, f"  {notice.upper()}  "), (401, f"{notice}\n{own(401)}"), (402, None)]
    found = {r["row"]["doc_id"]: (r["kept"], r["depleted"]) for r in quality_rules.quality_rules(docs(data)).collect()}
    assert {d for d, (_, poor) in found.items() if poor} == {*range(40), 400}
    assert all(found[200 + k][0] for k in range(100)) and found[401][0] and not found[402][0]
    none = docs(data).withColumn("source", F.lit(None).cast("string"))
    assert quality_rules.quality_rules(none).where("depleted").count() == 41


def test_frequent_lines_are_cut(spark, docs):
    own = lambda k: [" ".join(f"own{'ab'[k % 2]}{chr(97 + k // 2)}x{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(60)), "", "tail"]
    notice = "  Page 7 of this SITE "
    data = [(k, "\n".join([notice.replace("7", str(k)), *own(k)[:2], notice])) for k in range(40)]
    data += [(100, "\n".join(own(45))), (101, None)]
    found = {r["row"]["doc_id"]: r for r in quality_rules.quality_rules(docs(data)).collect()}
    assert all(found[k]["kept"] and found[k]["cleaned"] == "\n".join(own(k)[:2]) for k in range(40))
    assert found[100]["cleaned"] == data[40][1] and found[101]["cleaned"] is None
    full = docs(data).withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("bigint"))
    kept = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.keep_quality(spark, full, "").collect()}
    whole = {**{k: "\n".join(own(k)[:2]) for k in range(40)}, 100: data[40][1]}
    assert kept == {k: (t, len(t)) for k, t in whole.items()}


def plain_cut(rows):
    """By id the text without the frequent lines of its host and whether it is depleted, from (id, host, text) rows."""
    norm = lambda line: re.sub("[0-9]", "0", line.strip(" \t\n\x0b\x0c\r").lower())
    worded = lambda text: [line for line in text.split("\n") if line.split()]
    texts, found = defaultdict(set), Counter()
    for _, host, text in rows:
        texts[host].add(text or "")
    for host, own in texts.items():
        for text in own:
            found.update((host, line) for line in {norm(line) for line in worded(text)})
    frequent = {key for key, n in found.items() if n >= 3 and n > 0.1 * len(texts[key[0]])}
    out = {}
    for doc, host, text in rows:
        left = [line for line in (text or "").split("\n") if not line.split() or (host, norm(line)) not in frequent]
        total, rest = len((text or "").split()), sum(len(line.split()) for line in left)
        out[doc] = (text if rest == total else "\n".join(left), rest < total and rest < 0.3 * total)
    return out


@pytest.mark.parametrize("size", [2, 3, 9, 24, 31, 60])
def test_small_hosts_are_judged_as_large_ones(docs, size):
    """A notice in every text of a host, another in three of them: frequent in hosts of less than 30."""
    letters = lambda n: "".join(chr(97 + int(c)) for c in str(n))
    notice, three = ("all rights reserved " * 40).strip(), "seen in three of them"
    data = [(k, f"{notice}\nown line {letters(k)}" + (f"\n{three}" if k < 3 else "")) for k in range(size)]
    data += [(100 + k, data[0][1]) for k in range(40)]
    expected = plain_cut([(d, "a", t) for d, t in data])
    found = {r["row"]["doc_id"]: (r["cleaned"], r["depleted"]) for r in quality_rules.quality_rules(docs(data)).collect()}
    assert found == expected
    assert found[0][1] is (size > 2) and (three in found[0][0]) is (size < 3 or size >= 30)


def test_native_plan(docs):
    plan = quality_rules.quality_rules(docs([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_shards(docs):
    rnd = random.Random(2)
    data = [(k, "é" * rnd.randint(0, 50)) for k in range(300)] + [(None, None), (None, "x"), (7, "again"), (7, "again"), (300, "y" * 2000)]
    for part_rows in (20, 100_000):
        found = sharding.shards(docs(data), 8, part_rows=part_rows).orderBy("place").collect()
        assert [r["place"] for r in found] == list(range(len(data)))
        ids = [r["doc_id"] for r in found]
        assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])
        sizes = {}
        for r in found:
            assert r["slot"] == len(sizes.setdefault(r["shard"], []))
            sizes[r["shard"]].append(r["size"])
        total = sum(map(sum, sizes.values()))
        assert total == sum(len((t or "").encode()) + 1 for _, t in data)
        assert [r["shard"] for r in found] == sorted(r["shard"] for r in found)
        largest = max(max(s) for s in sizes.values())
        assert all(abs(sum(s) - total / 8) <= largest for s in sizes.values())
        pairs = lambda rows: sorted(rows, key=str)
        assert pairs((r["doc_id"], r["text_crc32"]) for r in found) == pairs((k, zlib.crc32((t or "").encode())) for k, t in data)
    assert sharding.shards(docs([])).count() == 0


def test_search_against_brute_force(spark):
    rng = np.random.default_rng(3)
    data = rng.standard_normal((3000, 24)) * rng.uniform(0.5, 2, (3000, 1))
    data[100:140] = data[100]  # ties
    table = [(k, v.tolist()) for k, v in enumerate(data)]
    bad = [(9000, None), (9001, []), (9002, [0.0] * 24), (9003, [None] + [1.0] * 23), (9004, [float("nan")] * 24),
           (9005, [float("inf")] * 24), (None, [1.0] * 24), (9020, [1.0, 2.0]), (9040, [2.0, 1.0])]
    df = spark.createDataFrame(table + bad, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("clash"))
    for block in (700, 8192):
        found = {}
        for r in ann.search(df, F.col("vec_id") % 20 == 0, k=20, block=block, chunk=64).collect():
            found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
        assert set(found) == {*range(0, 3000, 20), 9020, 9040}
        hits = 0
        for query in range(0, 3000, 20):
            scores = (data * data[query]).sum(axis=1)
            scores[query] = -np.inf
            truth = np.lexsort((np.arange(3000), -scores))[:20]
            got = sorted(found[query])
            assert [g[0] for g in got] == list(range(1, 21))
            assert all(abs(scores[v] - s) < 1e-12 for _, v, s in got)
            assert [(-s, v) for _, v, s in got] == sorted((-s, v) for _, v, s in got)
            hits += len({v for _, v, _ in got} & set(truth.tolist()))
        assert hits >= 0.9 * 20 * 150
        assert found[9020] == [(1, 9040, 4.0)]
    assert ann.search(df.limit(0), F.lit(True)).count() == 0
    # sizes far apart, and many rows of the query's own id
    odd = [(20, [1e200, 1.0])] * 30 + [(k, [1e-200 * k, 1.0]) for k in (1, 2, 3)]
    found = ann.search(spark.createDataFrame(odd, "vec_id bigint, embedding array<double>"), F.col("vec_id") == 20, k=2)
    assert [(r["rank"], r["vec_id"]) for r in found.orderBy("rank", "vec_id").collect()] == [(1, 3)] * 30 + [(2, 2)] * 30


@pytest.mark.parametrize("count, copies", [(500, 0), (2000, 0), (10_000, 3000), (50_000, 0)])
def test_recall_at_every_size(spark, count, copies):
    """Random directions, the hardest case: nothing is much nearer than the rest. All queries are compared."""
    rng = np.random.default_rng(count)
    data = rng.standard_normal((count, 64))
    data[count - copies :] = data[0]
    ends = pa.array(np.arange(count + 1, dtype=np.int32) * 64)
    vectors = pa.ListArray.from_arrays(ends, pa.array(data.ravel()))
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(count), "embedding": vectors})).repartition(8)
    found = ann.search(df, F.col("vec_id") % 20 == 0, k=20).toPandas()
    asked = np.arange(0, count, 20) if not copies else np.arange(20, count - copies, 20)
    rank = found.sort_values(["query_id", "rank"])
    assert (rank.groupby("query_id").size() == 20).all() and rank["query_id"].nunique() == len(range(0, count, 20))
    got = {q: set(v) for q, v in found.groupby("query_id")["vec_id"]}
    hits = 0
    for start in range(0, len(asked), 250):
        part = asked[start : start + 250]
        scores = data[part] @ data.T
        scores[np.arange(len(part)), part] = -np.inf
        limit = np.partition(scores, count - 20, axis=1)[:, count - 20]
        # ties at the limit are as good as one another
        hits += sum(int((scores[i, list(got[q])] >= limit[i] - 1e-9).sum()) for i, q in enumerate(part))
    assert hits >= 0.9 * 20 * len(asked)


@pytest.mark.parametrize("n, marks", [(1, 5), (63, 63), (64, 16), (1000, 37)])
def test_counters_equal_a_plain_count(n, marks):
    rng = np.random.default_rng(n)
    places, centre, width = rng.standard_normal((n, 21)), rng.standard_normal((7, 21)), rng.random(7) * 2
    windows = ann.Windows(places, marks)
    line = np.sort(places, axis=0)
    edges = np.arange(min(marks, n) + 1) * n // min(marks, n)
    for least in (1, 5, 13, 21):
        found = np.unpackbits(windows.reached(centre, width, least).view(np.uint8), axis=1, bitorder="little")[:, :n]
        for q in range(7):
            count = np.zeros(n, int)
            for j in range(21):
                low = edges[edges <= (line[:, j] < centre[q, j] - width[q]).sum()].max()
                high = edges[edges >= (line[:, j] <= centre[q, j] + width[q]).sum()].min()
                rank = np.argsort(np.argsort(places[:, j], kind="stable"), kind="stable")
                count += (rank >= low) & (rank < high)
            assert found[q].tolist() == (count >= least).astype(int).tolist()


def test_search_among_copies(spark):
    """A third of the rows is one vector near the mean of the others."""
    rng = np.random.default_rng(5)
    mean = rng.standard_normal(64)
    data = rng.standard_normal((4000, 64)) + mean
    data[2666:] = 1.5 * mean
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(data)], "vec_id bigint, embedding array<double>")
    found = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0, k=20).where("query_id < 2666").collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    recalls = []
    for query in range(0, 2666, 20):
        scores = (data * data[query]).sum(axis=1)
        scores[query] = -np.inf
        recalls.append(len(found[query] & set(np.lexsort((np.arange(4000), -scores))[:20].tolist())) / 20)
    assert np.mean(recalls) >= 0.95 and np.mean(np.array(recalls) < 0.9) < 0.1


def toxic_corpus(spark, count=900):
    rnd = random.Random(6)
    words = [f"{a}{b}" for a in ("on", "the", "re", "in", "at") for b in ("tion", "ing", "er", "ed", "ly", "es")]
    docs, labels = [], []
    for k in range(count):
        text = [rnd.choice(words) for _ in range(rnd.randint(5, 60))]
        toxic = k % 5 == 0
        if toxic:
            for _ in range(3):
                text.insert(rnd.randrange(len(text)), rnd.choice(["scumbag", "moronic", "idiot"]))
        docs.append((k, " ".join(text), "a"))
        labels.append((k, int(toxic)))
    docs += [(5000, None, "a"), (5001, "", "a"), (None, "idiot", "a"), (3, docs[3][1], "a"), (6000, "idiot " * 50_000, "a")]
    labels += [(1, None), (None, 1), (2, 0), (2, 0)]
    return (spark.createDataFrame(docs, "doc_id bigint, text string, score string"),
            spark.createDataFrame(labels, "doc_id bigint, toxic int"))


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_corpus(spark)
    train = ~toxicity.held_out(F.col("doc"))
    rows = toxicity.training_rows(docs, labels, "doc_id", "text", "toxic", train, 20_000)
    assert rows.where(toxicity.held_out(F.col("doc"))).count() == 0
    model = toxicity.fit(rows)
    scored = toxicity.score(docs, model).collect()
    assert len(scored) == docs.count() and all(0 <= r["score"] <= 1 for r in scored)
    held = [r for r in scored if r["doc_id"] is not None and r["doc_id"] < 900 and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    right = sum((r["score"] >= 0.7) == (r["doc_id"] % 5 == 0) for r in held)
    assert right >= 0.95 * len(held)
    by_id = {r["doc_id"]: r["score"] for r in scored}
    assert by_id[5000] == by_id[5001] < 0.7 < by_id[6000]
    again = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.fit(rows)).collect()}
    assert again == by_id


def test_toxicity_without_labels(spark):
    docs, labels = toxic_corpus(spark, 30)
    train = ~toxicity.held_out(F.col("doc"))
    for kept, expected in ((labels.limit(0), 0.0), (labels.where("toxic = 0"), 0.0), (labels.where("toxic = 1"), 1.0)):
        model = toxicity.fit(toxicity.training_rows(docs, kept, "doc_id", "text", "toxic", train, 100))
        assert {round(r["score"], 6) for r in toxicity.score(docs, model).collect()} == {expected}
    assert toxicity.score(docs.limit(0), model).count() == 0
