"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks: runs of text between block-level tags. Each block has
binary features of its ancestor tags, of their class and id words, and of its own text;
labels of neighbouring blocks are tied by transition weights. The model is trained on
labelled pages and decoded by Viterbi; blocks labelled as main text are joined.

Labels come from pages that mark their article themselves (``article`` or ``main``
elements, less parts that name themselves menus, adverts and the like). As other
sites mark it by class words or not at all, each labelled page is also rewritten into
other layouts, with its own paragraphs as article, sidebar, notice, form and comments.
Training reads the first ``sample`` pages that mark main text, in the order of a hash of
page_id. Where no page does, the weights are the fixed ones of ``prior``.

Every text of a page is in some block but for those of scripts and styles; the page's title
is a block that the model rejects. Elements inside a line of text, such as formulas and
scripts, do not cut it.

Cases: a null or empty page, or one without text, has the empty text; broken and unclosed
markup and left out ends of ``head`` and ``body`` are read as browsers do; pages of any
length and depth are read whole, in time linear in both; repeated rows give equal rows; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from html import escape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

#: How HTML lays out its elements. Every other element is inline, as browsers have it.
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li listing main menu nav ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead title tr ul xmp".split())
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
NAMED = BLOCK | INLINE
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(["script", "style"])
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
CLOSES = {"p": frozenset({"p"}), "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr", "td", "th"}), "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}), "option": frozenset({"option"})}
SCOPES = frozenset("ul ol dl table div section article main body td th blockquote".split())

#: Words by which parts of a page call themselves something other than the article.
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie consent footer form header login menu nav navbar newsletter notice popup promo related replies reply respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
ASIDE_TAGS = frozenset("nav aside footer form header button select textarea dialog menu".split())
MAIN_TAGS = frozenset({"article", "main"})

SAMPLE = 300
BUCKETS = 1 << 13
#: Innermost ancestors whose class, id and role words are features.
NEAR = 32
_WORDS = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    tags: frozenset[str]  # of all open elements that HTML names
    path: tuple[str, ...]  # the innermost three
    names: frozenset[str]  # class, id and role words of the innermost NEAR
    linked: int
    main: bool
    aside: bool  # under any element that names itself so
    tags_of_run: frozenset[str] = frozenset()


@dataclass
class _Element:
    tag: str
    words: frozenset[str]
    main: bool
    block: bool


class _Blocks(HTMLParser):
    """Collects the leaf blocks of a page. ``data-main`` marks labelled training pages and is no feature.

    What a block is told of its ancestors comes from running counts and from the innermost
    elements, so the work is linear in the page however many elements it leaves open.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[_Element] = []
        self.at: dict[str, list[int]] = defaultdict(list)  # places of the open elements by tag
        self.block_at: list[int] = []  # of the open block elements
        self.named: set[str] = set()  # open tags that HTML names
        self.known: frozenset[str] | None = frozenset()  # the same, made anew when they change
        self.marked = self.named_aside = 0
        self.blocks: list[Block] = []
        self.run: list[str] = []
        self.linked = 0
        self.inner: set[str] = set()

    def flush(self) -> None:
        text = " ".join("".join(self.run).split())
        if text:
            if self.known is None:
                self.known = frozenset(self.named)
            near = frozenset().union(*(e.words for e in self.open[-NEAR:] if e.words))
            self.blocks.append(
                Block(text, self.known, tuple(e.tag for e in self.open[-3:]), near, self.linked, self.marked > 0, self.named_aside > 0, frozenset(self.inner))
            )
        self.run, self.linked, self.inner = [], 0, set()

    def _drop(self, at: int) -> None:
        """Close the element at ``at`` and all inside it."""
        while len(self.open) > at:
            e = self.open.pop()
            self.at[e.tag].pop()
            if e.block:
                self.block_at.pop()
            if not self.at[e.tag]:
                self.named.discard(e.tag)
                self.known = None
            self.marked -= e.main
            self.named_aside -= bool(e.words & ASIDE_WORDS)

    def _last(self, tags) -> int:
        """The place of the innermost open element of ``tags``, -1 if there is none."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=-1)

    def handle_starttag(self, tag, attrs):
        block = tag in BLOCK
        if tag == "br":
            self.run.append(" ")
        if block:
            self.flush()
        elif tag in INLINE:
            self.inner.add(tag)
        if tag not in IN_HEAD and self.at.get("head"):  # its end may be left out
            self.flush()
            self._drop(self.at["head"][-1])
        if tag in VOID or (tag in ("html", "head", "body") and (self.at.get(tag) or self.at.get("body"))):
            return
        if block:
            closes = self._last(CLOSES.get(tag, CLOSES["p"]))
            if closes >= 0 and closes >= self._last(SCOPES):
                self._drop(closes)
        elif tag == "a" and self._last(["a"]) > (self.block_at[-1] if self.block_at else -1):
            self._drop(self.at["a"][-1])  # links do not nest
        values = dict(attrs)
        words = frozenset(w for k in ("class", "id", "role") for w in _WORDS.findall((values.get(k) or "").lower()))
        if not self.at.get(tag) and tag in NAMED:
            self.named.add(tag)
            self.known = None
        self.at[tag].append(len(self.open))
        if block:
            self.block_at.append(len(self.open))
        self.open.append(_Element(tag, words, "data-main" in values, block))
        self.marked += "data-main" in values
        self.named_aside += bool(words & ASIDE_WORDS)

    def handle_endtag(self, tag):
        last = self._last([tag])
        around_block = last >= 0 and bool(self.block_at) and last < self.block_at[-1]
        if tag in BLOCK or (around_block and tag not in INLINE):
            self.flush()
        if last >= 0 and not (around_block and tag in INLINE):
            self._drop(last)

    def handle_data(self, data):
        if self.open and self.open[-1].tag in SILENT:
            return
        if self.open and self.open[-1].tag == "head" and data.strip():
            self._drop(len(self.open) - 1)
        self.run.append(data)
        if self.at.get("a") and self.at["a"][-1] >= len(self.open) - 3:
            self.linked += len(data)


def blocks(html: str) -> list[Block]:
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.blocks


def _size(n: int) -> int:
    return min(int(n).bit_length(), 9)


def features(page: list[Block]) -> list[np.ndarray]:
    """The numbers of each block's binary features."""
    out = []
    for i, b in enumerate(page):
        n = max(len(b.text), 1)
        words = b.text.count(" ") + 1
        stops = sum(b.text.count(c) for c in ".!?")
        own = b.path[-1] if b.path else ""
        found = ["bias", f"own={own}", f"words={_size(words)}", f"link={int(4 * min(b.linked / n, 1))}", f"stops={_size(stops)}"]
        found += [f"under={t}" for t in b.tags]
        found += [f"path={'/'.join(b.path)}"]
        found += [f"name={w}" for w in b.names]
        found += [f"holds={t}" for t in b.tags_of_run]
        found += [f"first={b.text[0] if not b.text[0].isalnum() else ''}", f"ends={b.text[-1] in '.!?'}", f"upper={b.text.isupper()}"]
        found += [f"place={min(i, 3)}", f"left={min(len(page) - 1 - i, 3)}"]
        found += [f"aside={b.aside}", f"asidetag={bool(ASIDE_TAGS & b.tags)}", f"maintag={bool(MAIN_TAGS & b.tags)}"]
        out.append(np.unique([zlib.crc32(x.encode()) % BUCKETS for x in found]))
    return out


@dataclass
class Model:
    weights: np.ndarray  # features x 2
    moves: np.ndarray  # 2 x 2, from label to label

    def scores(self, page: list[np.ndarray]) -> np.ndarray:
        return np.array([self.weights[f].sum(axis=0) for f in page])


def viterbi(model: Model, page: list[np.ndarray]) -> list[int]:
    """The likeliest labels of a page's blocks."""
    if not page:
        return []
    scores = model.scores(page)
    best, back = scores[0], []
    for s in scores[1:]:
        through = best[:, None] + model.moves
        back.append(through.argmax(axis=0))
        best = through.max(axis=0) + s
    label = [int(best.argmax())]
    for b in reversed(back):
        label.append(int(b[label[-1]]))
    return label[::-1]


def likelihood(model: Model, page: list[np.ndarray], labels: list[int]) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood of the labels, and the expected less the true counts of labels and of moves, by forward-backward."""
    s, n = model.scores(page), len(page)
    ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
    ahead[0] = s[0]
    for i in range(1, n):
        ahead[i] = s[i] + np.logaddexp.reduce(ahead[i - 1][:, None] + model.moves, axis=0)
    for i in range(n - 2, -1, -1):
        behind[i] = np.logaddexp.reduce(model.moves + (s[i + 1] + behind[i + 1])[None], axis=1)
    z = np.logaddexp.reduce(ahead[-1])
    states = np.exp(ahead + behind - z)
    moves = np.zeros((2, 2))
    value = s[0, labels[0]]
    for i in range(1, n):
        moves += np.exp(ahead[i - 1][:, None] + model.moves + (s[i] + behind[i])[None] - z)
        moves[labels[i - 1], labels[i]] -= 1
        value += model.moves[labels[i - 1], labels[i]] + s[i, labels[i]]
    states[np.arange(n), labels] -= 1
    return value - z, states, moves


def train(pages: list[tuple[list[np.ndarray], list[int]]], rounds: int = 8, rate: float = 0.3, decay: float = 1e-4) -> Model:
    """Weights by AdaGrad over the pages, one page a step."""
    model = Model(np.zeros((BUCKETS, 2)), np.zeros((2, 2)))
    past, past_moves = np.full((BUCKETS, 2), 1e-8), np.full((2, 2), 1e-8)
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for k in order.permutation(len(pages)):
            page, labels = pages[k]
            _, states, moves = likelihood(model, page, labels)
            used = np.concatenate(page)
            unique, inverse = np.unique(used, return_inverse=True)
            slope = np.zeros((len(unique), 2))
            np.add.at(slope, inverse, np.repeat(states, [len(f) for f in page], axis=0))
            slope += decay * model.weights[unique]
            past[unique] += slope**2
            model.weights[unique] -= rate * slope / np.sqrt(past[unique])
            past_moves += moves**2
            model.moves -= rate * moves / np.sqrt(past_moves)
    return model


def own_labels(page: list[Block]) -> list[int] | None:
    """1 for blocks of an element that the page marks as its article, less its asides; None if it marks none."""
    if not any(MAIN_TAGS & b.tags for b in page):
        return None
    return [int(bool(MAIN_TAGS & b.tags) and not (ASIDE_TAGS & b.tags) and not b.aside) for b in page]


#: Names for the wrapper of an article in rewritten pages, as (tag, class).
WRAPPERS = [("div", "content"), ("div", "post"), ("div", "entry-content"), ("section", "story"), ("div", "article-body"), ("div", "text"), ("td", ""), ("div", ""), ("main", ""), ("article", "post")]
SITE_PARTS = ["header", "menu", "sidebar", "notice", "advert", "form", "share", "related"]


def _part(kind: str, short: list[str], sentences: list[str], rng) -> str:
    """A part of a page that is no article."""
    pick = lambda n: [short[i] for i in rng.integers(0, len(short), n)]
    links = "".join(f'<li><a href="/{escape(w)}">{escape(w)}</a></li>' for w in pick(int(rng.integers(2, 7))))
    line = escape(sentences[int(rng.integers(0, len(sentences)))])
    some = escape(" ".join(pick(int(rng.integers(2, 9)))))
    return {
        "header": f'<header><a href="/">{some}</a><p>{some}</p></header>',
        "menu": f'<div class="menu"><ul>{links}</ul></div>',
        "sidebar": f'<aside><h3>{some}</h3><ul>{links}</ul><p>{line}</p></aside>' if rng.random() < 0.5 else f'<div id="sidebar" class="widget"><p>{line}</p><ul>{links}</ul></div>',
        "notice": f'<div class="{["cookie-notice", "consent", "notice", "popup"][int(rng.integers(0, 4))]}"><p>{line}</p><button>{some}</button></div>',
        "advert": f'<div class="{["ad", "ads", "advert", "sponsored", "promo"][int(rng.integers(0, 5))]}">{line}</div>',
        "form": f'<form action="/s"><label>{some}</label><input name="q"><button>{some}</button><p>{line}</p></form>',
        "share": f'<div class="share social"><a href="#">{some}</a> <a href="#">{some}</a></div>',
        "related": f'<div class="related"><h3>{some}</h3><ul>{links}</ul></div>',
        "comments": f'<div class="{["comments", "replies", "comment-list"][int(rng.integers(0, 3))]}" id="comments"><h3>{some}</h3><div class="comment"><p>{line}</p><p>{line}</p></div></div>',
        "footer": f"<footer>&copy; {some}. {line}</footer>",
    }[kind]


def rewritten(article: list[str], short: list[str], rng) -> str:
    """A page of another layout around the given article."""
    parts = list(rng.permutation(SITE_PARTS))[: int(rng.integers(3, 7))]
    cut = int(rng.integers(1, len(parts)))
    tag, name = WRAPPERS[int(rng.integers(0, len(WRAPPERS)))]
    body = [f"<h{int(rng.integers(1, 3))}>{escape(article[0])}</h1>", *(f"<p>{escape(x)}</p>" for x in article[1:])]
    if rng.random() < 0.5 and len(body) > 2:
        body[-1] = f"<ul><li>{escape(article[-1])}</li></ul>" if rng.random() < 0.5 else f"<blockquote>{escape(article[-1])}</blockquote>"
    inner = "".join(f"{'<div data-main>' if k == 0 else ''}{x}" for k, x in enumerate(body)) + "</div>"
    if rng.random() < 0.4:
        inner += _part(["share", "advert", "related", "comments"][int(rng.integers(0, 4))], short, article, rng)
    made = [_part(p, short, article, rng) for p in parts]
    after = [_part("comments", short, article, rng)] * (rng.random() < 0.6) + made[cut:] + [_part("footer", short, article, rng)]
    head = f"<head><title>{escape(article[0])}</title></head>" if rng.random() < 0.7 else ""
    return f'<html>{head}<body>{"".join(made[:cut])}<{tag} class="{name}">{inner}</{tag}>{"".join(after)}</body></html>'


def labelled_pages(htmls: list[str], copies: int = 3) -> list[tuple[list[np.ndarray], list[int]]]:
    """Training pages: those that mark their article, and rewritten ones with their paragraphs."""
    rng, out = np.random.default_rng(11), []
    for html in htmls:
        page = blocks(html)
        labels = own_labels(page)
        if not labels:
            continue
        out.append((features(page), labels))
        article = [b.text for b, y in zip(page, labels, strict=True) if y]
        short = [w for b, y in zip(page, labels, strict=True) if not y for w in b.text.split()] or ["home"]
        for _ in range(copies if article else 0):
            made = blocks(rewritten(article, short, rng))
            out.append((features(made), [int(b.main) for b in made]))
    return out


#: What the label of main text gains by a feature, where no page tells.
PRIOR = {
    "bias": -0.5, "maintag=True": 2.0, "aside=True": -4.0, "asidetag=True": -4.0, "own=title": -9.0, "own=h1": 3.0, "own=h2": 2.5, "own=p": 2.5,
    "link=2": -1.0, "link=3": -2.0, "link=4": -3.0, "stops=0": -0.5, "stops=1": 0.5, "stops=2": 0.5, "stops=3": 1.0,
    "words=1": -1.5, "words=2": -1.0, "words=3": -0.5, "words=4": 0.5, "words=5": 1.0, "words=6": 1.5, "words=7": 2.0, "words=8": 2.0, "words=9": 2.0,
}


def prior() -> Model:
    """Weights without training: long sentences and headings are main text, links and parts named otherwise are not."""
    model = Model(np.zeros((BUCKETS, 2)), np.array([[0.5, -0.5], [-0.5, 0.5]]))
    for name, gain in PRIOR.items():
        model.weights[zlib.crc32(name.encode()) % BUCKETS, 1] += gain
    return model


def _marking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pages that mark main text."""
    for batch in batches:
        yield batch.filter(pa.array([any(own_labels(blocks(h)) or ()) for h in batch.column("html").to_pylist()], pa.bool_()))


def fit(pages: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of at most ``sample`` pages that mark main text, which are all that the driver reads.

    Pages with a fitting tag are found by a pattern; a share of them that holds about twice as many as needed is drawn by hash
    and parsed, and a larger one as long as too few of them mark any text, at last all.
    """
    parts = 1 << 40
    tagged = pages.select("html", F.pmod(F.xxhash64("page_id"), F.lit(parts)).alias("k")).filter(F.col("html").rlike(r"(?i)<(article|main)\b"))
    share = 2.0 * sample / max(tagged.count(), 1)
    while True:
        drawn = tagged.filter(F.col("k") < int(min(share, 1.0) * parts)).mapInArrow(_marking, "html string, k long")
        rows = drawn.orderBy("k", "html").limit(sample).collect()
        if len(rows) == sample or share >= 1.0:
            break
        share *= 8
    return train(labelled_pages([r["html"] for r in rows])) if rows else prior()


def main_text(model: Model, html: str | None) -> str:
    page = blocks(html) if html else []
    return "\n".join(b.text for b, y in zip(page, viterbi(model, features(page)), strict=True) if y)


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, url and text of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(shared.value, h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id").cast(pa.int64()), batch.column("url").cast(pa.string()), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    return pages.select("page_id", "url", "html").mapInArrow(rows, "page_id long, url string, text string")


def op3_block_crf(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit(pages)).withColumn("n_chars", F.char_length("text").cast("long"))
