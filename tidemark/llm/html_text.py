"""Main text of HTML pages as the best-scoring run of words and tags.

A page becomes a row of tokens. A word scores positive, a tag negative, by weights from labelled pages:
a tag costs the more, the larger the share of its kind that lies outside the main text, and a word
under elements (by name, or by words of their class, id or role) that hold mostly other text loses its
score. One linear scan finds the contiguous run with the largest sum. Its blocks, and those of an article
it begins or ends in, are the main text, without what lies in menus, forms, adverts and the like there.

An element is furniture by its name or a word of its class, id or role, unless labelled pages show main text
under that name, or the element wraps the page: it holds a heading, article, menu, header or footer, and at
least twice as many words of its own as lie around it. Comments wrap a page only around its first heading or
``main``. Class names that tell a state (``has-sidebar``, ``menu-open``) stand for themselves.

Contract. A null or empty page, or one without words, has an empty text. Character references are
decoded, white space inside a block is one space, blocks are trimmed and joined by one line end, empty
blocks left out. Paragraphs, list items, table parts and options whose end tag is left out end where the next
one or a block begins; other unclosed tags, comments and quotes end where the page does. Ties go to the first run.
Every row gives one row, repeated rows included; an empty table gives an empty result. Pages of any
length take one pass. Only the named columns are read.
"""

from __future__ import annotations

import dataclasses
import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, own_names, prepare

# Names of HTML elements by their meaning, and words that classes and ids use for page furniture.
RAW = set("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section select summary table tbody td tfoot th thead tr ul".split()
)
ROOTS = set("html body main article".split())
FURNITURE = set("nav header footer aside form button select option dialog menu label fieldset object canvas audio video".split())
FURNITURE_WORDS = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo sidebar comment comments disqus "
    "respond reply replies menu navigation nav navbar breadcrumb breadcrumbs cookie cookies consent notice popup modal "
    "newsletter subscribe signup share sharing social related recommended footer header masthead widget pagination "
    "pager login search toolbar contentinfo complementary".split()
)
#: Of these, the words for what readers write, prose as the main text is; and words of names that tell a state of a page.
READERS_WORDS = set("comment comments disqus respond reply replies".split())
STATE_WORDS = set("has no not is with without open opened closed visible hidden active enabled disabled page layout wrap wrapper".split())
#: What an element holds that wraps a whole page.
LANDMARKS = set("main article h1 nav header footer".split())
#: Elements whose end tag may be left out, in kinds; the kinds that an opening tag ends; and those that it hides from what is inside.
_KINDS = {"p": 0, "li": 1, "dt": 2, "dd": 2, "option": 3, "optgroup": 4, "td": 5, "th": 5, "tr": 6, "thead": 7, "tbody": 7, "tfoot": 7}
_CLOSERS = {name: (0,) for name in BLOCKS - set("html head body button caption legend option optgroup select summary tbody td tfoot th thead tr".split())}
_CLOSERS |= {"li": (0, 1), "dt": (0, 2), "dd": (0, 2), "option": (3,), "optgroup": (3, 4), "td": (5,), "th": (5,), "tr": (5, 6)}
_CLOSERS |= dict.fromkeys(("thead", "tbody", "tfoot"), (5, 6, 7))
_HIDES = {name: (1, 2) for name in BLOCKS - {"p", "li", "dt", "dd", "div", "address"}}
_HIDES |= {name: (0, 1, 2) for name in ("td", "th", "caption", "button", "object")}
_HIDES |= {"table": tuple(range(8)), "select": (3, 4)}
CONTENT = set("p h1 h2 h3 h4 h5 h6 b i em strong br article main blockquote pre code".split())

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORD = re.compile(r"[a-z]+")
#: Words of labelled pages that the weight of a name needs; and words outside the main text that a furniture name starts from.
EVIDENCE = 20
_ENDS = {name: re.compile(rf"</{name}\b[^>]*>?", re.I) for name in RAW}
#: Labelled pages that the weights come from, at most.
SAMPLE = 2_000


class Around:
    """The keys of an open element, linked to those around it, with what has been found out about the chain."""

    __slots__ = ("own", "outer", "names", "model", "weight", "mark")

    def __init__(self, own: tuple[str, ...], outer: Around | None, mark: Mark | None = None):
        self.own, self.outer = own, outer
        self.mark = mark  # set where this element is named as furniture
        self.names: frozenset[str] | None = None
        self.model, self.weight = None, 0.0

    def _open(self, known) -> list[Around]:
        """The elements from this one outwards for which nothing is ``known`` yet, the outermost first."""
        chain, node = [], self
        while node is not None and not known(node):
            chain.append(node)
            node = node.outer
        return chain[::-1]

    def all_names(self) -> frozenset[str]:
        for node in self._open(lambda n: n.names is not None):
            names = node.outer.names if node.outer else frozenset()
            node.names = names if names.issuperset(node.own) else names.union(node.own)
        return self.names

    def least(self, model: Model) -> float:
        """The smallest weight of all keys."""
        for node in self._open(lambda n: n.model is model):
            wraps = node.mark is not None and not node.mark.named
            weights = [model.keys.get(k, _prior(k)) for k in node.own if not (wraps and _prior(k))]
            if node.outer and (node.outer.own or node.outer.outer):
                weights.append(node.outer.weight)
            node.model, node.weight = model, min(weights, default=0.0)
        return self.weight


class Mark:
    """An element named as furniture, linked to the one around it."""

    __slots__ = ("keys", "outer", "words", "holds", "around", "named", "cut")

    def __init__(self, keys: list[str], outer: Mark | None):
        self.keys, self.outer = keys, outer
        self.words = self.around = 0  # words in no mark further in; and those in the marks around and in none
        self.holds: set[str] = set()
        self.named = self.cut = True  # furniture itself; it or one around it

    def wraps(self) -> bool:
        """Whether it stands around a page rather than beside its main text."""
        signs = {"main", "h1"} if any(k[1:] in READERS_WORDS for k in self.keys) else LANDMARKS
        return not signs.isdisjoint(self.holds) and self.words >= max(1, 2 * self.around)


def _judge(found: list[Token], model: Model) -> None:
    """Decide for every mark of a page whether it is furniture."""
    marks: dict[Mark, None] = {}  # outer ones first
    free = 0
    for token in found:
        if token.inside is not None:
            marks[token.inside] = None
        if token.text is not None:
            size = len(token.text.split())
            if token.inside is None:
                free += size
            else:
                token.inside.words += size
    for mark in marks:
        mark.around = free if mark.outer is None else mark.outer.around + mark.outer.words
    for mark in reversed(marks):
        mark.named = not mark.wraps() and any(model.keys.get(k, _prior(k)) <= -1 for k in mark.keys)
        if mark.outer is not None:
            mark.outer.holds |= mark.holds
            if not mark.named:
                mark.outer.words += mark.words
    for mark in marks:
        mark.cut = mark.named or mark.outer is not None and mark.outer.cut


@dataclasses.dataclass(slots=True)
class Token:
    """A tag (``text`` is None) or a run of text, with the keys of the elements open around it."""

    name: str
    text: str | None
    keys: Around
    inside: Mark | None  # the innermost element around it that is named as furniture
    root: int = 0  # number of the article or main element around it, 0 for none


def _element_keys(name: str, attributes: str) -> tuple[str, ...]:
    if name in ROOTS or not attributes:
        return (name,)
    words = set()
    for value in _NAMES.findall(attributes):
        for given in value.strip("\"'").lower().split():
            parts = _WORD.findall(given)
            words.update(parts if STATE_WORDS.isdisjoint(parts) else (given,))
    return (name, *sorted("." + w for w in words))


def tokens(page: str | None) -> Iterator[Token]:
    """Tags and texts of a page in order; unseen parts (head, scripts, comments) are left out."""
    page = page or ""
    # open elements: name, keys of it and all around it, innermost furniture name, number of the article around it
    stack: list[tuple[str, Around, Mark | None, int]] = [("", Around((), None), None, 0)]
    # for each of them the depths of the elements in reach that may end unclosed, by kind; and open elements by name
    reach: list[tuple[int, ...]] = [(0,) * 8]
    named: Counter = Counter()

    def close_from(depth: int) -> None:
        named.subtract(s[0] for s in stack[depth:])
        del stack[depth:], reach[depth:]

    at, end, roots = 0, len(page), 0
    while at < end:
        open_at = page.find("<", at)
        if open_at < 0:
            open_at = end
        found = _NAME.match(page, open_at) if open_at < end else None
        special = page[open_at + 1 : open_at + 2] in ("!", "?") if open_at < end else False
        if open_at < end and not found and not special:
            # a lone sign is text, up to the next one
            following = page.find("<", open_at + 1)
            open_at = end if following < 0 else following
            if stack[-1][0] != "head":
                yield Token("", page[at:open_at], *stack[-1][1:])
            at = open_at
            continue
        if open_at > at and stack[-1][0] != "head":
            yield Token("", page[at:open_at], *stack[-1][1:])
        if open_at >= end:
            return
        if special:
            long = page.startswith("<!--", open_at)
            close = page.find("-->" if long else ">", open_at + (4 if long else 1))
            at = end if close < 0 else close + (3 if long else 1)
            continue
        name = found[1].lower()
        rest = _REST.match(page, found.end())
        close = rest.end() - 1 if rest else page.find(">", found.end())
        at = end if close < 0 else close + 1
        if page[open_at + 1] == "/":
            if named[name] > 0:
                close_from(next(d for d in range(len(stack) - 1, 0, -1) if stack[d][0] == name))
            yield Token(name, None, *stack[-1][1:])
            continue
        attributes = page[found.end() : at - 1] if close >= 0 else ""
        if name in RAW:
            ended = _ENDS[name].search(page, at)
            at = ended.end() if ended else end
            continue
        keys = _element_keys(name, attributes)
        own = [k for k in keys if _prior(k)]
        if name in _CLOSERS and (depth := min((d for k in _CLOSERS[name] if (d := reach[-1][k])), default=0)):
            close_from(depth)
        if name == "header" and stack[-1][3]:
            own = []  # an article's own heading
        if name == "body" and stack[-1][0] == "head":
            close_from(len(stack) - 1)
        root = stack[-1][3]
        if name in ("article", "main"):
            roots += 1
            root = roots
        mark = outer = stack[-1][2]
        if outer is not None and name in LANDMARKS:
            outer.holds.add(name)
        if own:
            mark = Mark(own, outer)
        around = Around(keys, stack[-1][1], mark if own else None)
        yield Token(name, None, around, mark, root)
        if name not in VOID:
            if name in _KINDS or name in _HIDES:
                depths = list(reach[-1])
                for kind in _HIDES.get(name, ()):
                    depths[kind] = 0
                if name in _KINDS:
                    depths[_KINDS[name]] = len(stack)
                reach.append(tuple(depths))
            else:
                reach.append(reach[-1])
            stack.append((name, around, mark, root))
            named[name] += 1


@dataclasses.dataclass(frozen=True)
class Model:
    """Costs of tags by name, and weights (at most 0) of words by the keys around them."""

    tags: dict[str, float]
    keys: dict[str, float]

    def word(self, token: Token) -> float:
        return max(-1.0, 1.0 + token.keys.least(self))

    def tag(self, token: Token) -> float:
        cost = self.tags.get(token.name)
        return -2 * _outside(token.name, 0, 0) if cost is None else cost


def _prior(key: str) -> float:
    return -2.0 if key in FURNITURE or key[0] == "." and key[1:] in FURNITURE_WORDS else 0.0


def _outside(name: str, main: int, other: int) -> float:
    """Smoothed share of a tag's places outside the main text."""
    a, b = (20, 1) if name in CONTENT else (1, 20) if name in FURNITURE else (4, 1)
    return (other + b) / (main + other + a + b)


def blocks(page: str | None) -> list[list[Token]]:
    """Runs of text tokens between block tags."""
    out: list[list[Token]] = [[]]
    for token in tokens(page):
        if token.text is None:
            if token.name in BLOCKS and out[-1]:
                out.append([])
        else:
            out[-1].append(token)
    return out


def _plain(texts: list[str]) -> str:
    return " ".join("".join(texts).split())


def _decoded(token: Token) -> str:
    return " " if token.text is None else entities.unescape(token.text)


def _counts(page: str | None, main: str | None) -> tuple[Counter, Counter]:
    """Words in and outside the main text by key (places 0 and 1), and tags likewise."""
    lines = {_plain([line]) for line in (main or "").split("\n")}
    starts = {line[:20] for line in lines if len(line) >= 20}
    words, tags = Counter(), Counter()
    parts: list[tuple[list[Token], list[str]]] = [([], [])]  # text tokens, and names of the tags before the next block
    for token in tokens(page):
        if token.text is not None:
            parts[-1][0].append(token)
        elif token.name in BLOCKS:
            if parts[-1][0]:
                parts.append(([], []))
            parts[-1][1].append(token.name)
        else:
            parts[-1][1].append(token.name)
    for found, names in parts:
        text = _plain([_decoded(t) for t in found])
        hit = text in lines or text[:20] in starts and any(line.startswith(text) for line in lines)
        place = 0 if hit and text else 1
        if text:
            for name in names:
                tags[name, place] += 1
            for token in found:
                size = len(token.text.split())
                words["", place] += size
                for key in token.keys.all_names():
                    words[key, place] += size
    return words, tags


def fit(labelled: DataFrame) -> Model:
    """Weights from labelled pages (html, text), a bounded sample; counted on the executors."""
    prepare(labelled.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, tags = Counter(), Counter()
        for batch in batches:
            for page, main in zip(batch.column("html").to_pylist(), batch.column("text").to_pylist()):
                more_words, more_tags = _counts(page, main)
                words.update(more_words)
                tags.update(more_tags)
        rows = [(kind, *key, n) for kind, found in (("word", words), ("tag", tags)) for key, n in found.items()]
        columns = list(zip(*rows)) if rows else [(), (), (), ()]
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, type=k) for c, k in zip(columns, kinds)], names=["kind", "key", "place", "n"]
        )

    counted = labelled.select("html", "text").mapInArrow(count, "kind string, key string, place int, n bigint")
    sums = counted.groupBy("kind", "key").agg(
        F.sum(F.when(F.col("place") == 0, F.col("n")).otherwise(0)).alias("main"),
        F.sum(F.when(F.col("place") == 1, F.col("n")).otherwise(0)).alias("other"),
    )
    # names with evidence on a bounded number of pages
    rows = sums.where((F.col("kind") == "tag") | (F.col("main") + F.col("other") >= EVIDENCE)).orderBy("kind", "key").collect()
    total = next(((r["main"], r["other"]) for r in rows if r["kind"] == "word" and r["key"] == ""), (0, 0))
    usual = math.log((total[0] + 1) / (total[1] + 1))
    keys, tags = {}, {}
    for r in rows:
        name, main, other = r["key"], r["main"], r["other"]
        if r["kind"] == "tag":
            tags[name] = -2 * _outside(name, main, other)
        elif name and name not in ROOTS and name != "div":
            # how much rarer main text is under this key than on the whole; a plain container says nothing
            doubt = EVIDENCE if _prior(name) else 0
            keys[name] = min(math.log((main + 1) / (other + doubt + 1)) - usual, 0.0)
    return Model(tags, keys)


def best_run(scores: list[float]) -> tuple[int, int] | None:
    """First and last place of the first contiguous run with the largest sum above 0, by one scan."""
    best, found, total, start = 0.0, None, 0.0, 0
    for place, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, place
        total += score
        if total > best:
            best, found = total, (start, place)
    return found


def main_text(page: str | None, model: Model) -> str:
    """The main text of one page."""
    page_tokens = list(tokens(page))
    _judge(page_tokens, model)
    found: list[tuple[Token, int]] = []  # tokens with the number of their block
    scores: list[float] = []
    block = 0
    for token in page_tokens:
        if token.text is None:
            block += token.name in BLOCKS
            scores.append(model.tag(token))
        else:
            scores.append(model.word(token) * len(token.text.split()))
        found.append((token, block))
    run = best_run(scores)
    if run is None:
        return ""
    (head, first), (tail, last) = (found[place] for place in run)
    # a run that begins or ends in an article takes the whole of it, also beyond furniture between its blocks
    first = min([first, *(number for token, number in found if token.root and token.root == head.root)])
    last = max([last, *(number for token, number in found if token.root and token.root == tail.root)])
    texts: dict[int, list[str]] = {}
    for token, number in found:
        if first <= number <= last and not (token.inside is not None and token.inside.cut):
            if token.text is not None or token.name == "br":
                texts.setdefault(number, []).append(_decoded(token))
    return "\n".join(text for number in sorted(texts) if (text := _plain(texts[number])))


def extract(pages: DataFrame, model: Model, key: str = "page_id", html: str = "html") -> DataFrame:
    """``key`` and ``text`` of every page; nothing is shuffled."""
    kind = pages.schema[key].dataType.simpleString()

    def work(batch):
        return [batch.column(0), [main_text(page, model) for page in batch.column(1).to_pylist()]]

    return map_rows(own_names(pages, {"key": key, "html": html}), work, f"`{key}` {kind}, text string")
