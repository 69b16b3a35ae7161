"""Main text of web pages by consensus host paths.

Pass 1 parses each page, scores its containers and votes for the best one's
generalised path (tags and classes from the root, digits removed).  The votes
are summed per host and path, and each host's winning path is found.  Pass 2
parses the pages again and takes the text below the host's winning path where it
holds most of what the page's own best container holds; elsewhere the page uses
its own best container, and the winning path's text with it.

Votes are one small row per page, summed before the shuffle.  The winners are
one row per host in a written table, so Spark knows their size and broadcasts
them only below its own threshold; beyond it the join shuffles, and a hot host
splits on the pages' side.

Class names are evidence, not a veto by a single word: a name marks surroundings
only if all its words do (``share-buttons``, not ``share-of-market``).  Paths are
numbers per page (parent's number and step) and sums run once over the elements,
so time and memory stay linear in the page, however deep or broken it is.

Defined results: a null or empty page gives an empty text; a page whose url has
no host (or is null) votes within the host ``''``; rows repeating a ``page_id``
are separate rows; other columns of the input are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stakeflow.llm.tables import materialise, read

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
SILENT = frozenset("head title script style noscript template svg math canvas iframe object audio video "
                   "map select option button textarea dialog".split())
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template")
#: Elements that are never part of the article.
BOILER = frozenset("nav footer aside form menu fieldset header".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
                  "ol p pre section summary table tbody tfoot thead tr ul".split())
CONTAINER = frozenset("article body center div main section td table tbody tr html blockquote".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu "
                  "menubar".split())
#: Words of class and id that mark what surrounds an article, always or unless a content word stands by.
ALWAYS = frozenset("ad ads advert advertisement adverts advertising banner-ad breadcrumb breadcrumbs comment "
                   "comments cookie cookies consent disqus footer gdpr login menu modal nav navbar navigation "
                   "newsletter pagination pager popup promo promoted promotion recommended related respond "
                   "replies reply share sharing signup sponsor sponsored subscribe subscription".split())
USUALLY = frozenset("aside banner bottombar header masthead notice notification alert sidebar sidenav social "
                    "toolbar topbar widget widgets rail outbrain taboola search".split())
#: Words that name the form of a part, not its content.
FORM = frozenset("area bar block bottom box btn button buttons col column container content frame group head icon icons "
                 "inner item items layer left line link links list menu nav outer panel right row section slot text title "
                 "top unit wrap wrapper".split())
#: Share of the own container's text that the host's path has to hold to stand alone.
MOST = 2 / 3
CONTENT = frozenset("article body content entry main page post story text wrapper container layout".split())
#: The end tag may be left out: a start tag closes the open element of these kinds.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
          "tfoot": {"tr", "td", "th", "thead", "tbody"}}
#: Elements that an implied end does not reach over.
BARRIER = frozenset("table ul ol dl article section div main body html nav aside footer header form td".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")


@dataclass
class Element:
    tag: str
    #: number of the generalised path (``Page.paths``)
    path: int
    parent: int
    #: 0 article text, 1 header inside an article (only headings count), 2 surroundings, 3 no text
    state: int
    link: bool
    good: float = 0.0
    bad: float = 0.0
    bonus: float = 1.0


@dataclass
class Page:
    elements: list[Element] = field(default_factory=list)
    #: (element, text, characters in links)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)
    #: path numbers by (number of the path above, step), and back
    numbers: dict[tuple[int, str], int] = field(default_factory=dict)
    steps: list[tuple[int, str]] = field(default_factory=lambda: [(-1, "")])

    def number(self, above: int, step: str) -> int:
        key = above, step
        if key not in self.numbers:
            self.numbers[key] = len(self.steps)
            self.steps.append(key)
        return self.numbers[key]

    def path_text(self, number: int) -> str:
        out = []
        while number:
            number, step = self.steps[number]
            out.append(step)
        return "".join(f">{step}" for step in reversed(out))

    def find(self, path: str) -> int | None:
        """The number of a path given as text, if the page has it."""
        at = 0
        for step in path.split(">")[1:]:
            at = self.numbers.get((at, step))
            if at is None:
                return None
        return at


def _marks(names: str, words: frozenset) -> set[str]:
    """The words of ``words`` in those class or id names of which every word marks surroundings or names a form."""
    out: set[str] = set()
    for name in names.split():
        parts = {w.lower() for w in WORD.findall(name)}
        if parts & words and parts <= ALWAYS | USUALLY | FORM:
            out |= parts & words
    return out


def _kind(tag: str, rest: str, state: int, inside: bool) -> tuple[int, str, float]:
    """State, generalised path step and score bonus of a new element."""
    attrs = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(rest)} if "=" in rest else {}
    classes = attrs.get("class", "")
    step = tag
    names = frozenset()
    if classes or "id" in attrs:
        words = {w.lower() for w in WORD.findall(f"{classes} {attrs.get('id', '')}")}
        names = frozenset(words)
        marks = sorted({re.sub(r"[\d>]+", "", c).strip("-_").lower() for c in classes.split()} - {""})
        step = ".".join([tag, *marks])
    bonus = 1.25 if tag in ("article", "main") or attrs.get("role") == "main" else \
        1.1 if names & {"article", "content", "entry", "post", "story"} else 1.0
    if state == 3 or tag in SILENT:
        return 3, step, bonus
    if "hidden" in rest and re.search(r"(?<![\w-])hidden(?![\w-])", re.sub(r"\"[^\"]*\"|'[^']*'", "", rest)):
        return 3, step, bonus
    if "style" in attrs and HIDDEN.search(attrs["style"]):
        return 3, step, bonus
    given = f"{classes} {attrs.get('id', '')}"
    always, usually = _marks(given, ALWAYS) if names else set(), _marks(given, USUALLY) if names else set()
    surrounds = (tag in BOILER or attrs.get("role") in ROLES
                 or (tag not in ("html", "body", "main", "article") and bool(always))
                 or (tag not in ("html", "body", "main") and bool(usually) and not names & CONTENT)
                 or (tag == "article" and bool(always & {"comment", "comments", "reply", "ad", "sponsored"})))
    if tag == "header" and inside and state == 0 and not always:
        return 1, step, bonus
    return (2 if surrounds else state), step, bonus


def parse(source: str) -> Page:
    page = Page([Element("#root", 0, -1, 0, False)])
    elements, blocks = page.elements, page.blocks
    stack = [0]
    open_: Counter = Counter()  # open elements by tag
    inside = 0  # open article and main elements
    text: list[str] = []
    linked = 0
    owner = 0

    def flush():
        nonlocal linked
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                blocks.append((owner, joined, linked))
            text.clear()
        linked = 0

    def close(at: int):
        nonlocal inside
        for e in stack[at:]:
            inside -= elements[e].tag in ("article", "main")
            open_[elements[e].tag] -= 1
        del stack[at:]

    def any_open(tags) -> bool:
        return any(open_[t] > 0 for t in tags)

    pos, n = 0, len(source)
    while pos < n:
        m = TOKEN.search(source, pos)
        stop = m.start() if m else n
        top = elements[stack[-1]]
        if stop > pos and top.state < 2 and (top.state == 0 or any_open(HEADINGS)):
            part = html_lib.unescape(source[pos:stop])
            if not text:
                owner = stack[-1]
            text.append(part)
            if top.link:
                linked += len(part.strip())
        if not m:
            break
        pos = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:  # end tag
            if tag in BLOCK:
                flush()
            elif tag in ("td", "th") and text:
                text.append(" ")
            for at in range(len(stack) - 1, 0, -1) if open_[tag] > 0 else ():
                open_tag = elements[stack[at]].tag
                if open_tag == tag:
                    close(at)
                    break
                if open_tag in BARRIER and tag not in BLOCK:
                    break  # an inline end tag does not close blocks
            continue
        if m[4] != ">":
            break  # the page ends inside a tag
        if tag == "br" or tag in ("td", "th", "img"):
            if text:
                text.append(" ")
        if tag in BLOCK:
            flush()
            # a block ends an open paragraph, and inline elements left open in it
            for at in range(len(stack) - 1, 0, -1) if open_["p"] > 0 or tag in HEADINGS and any_open(HEADINGS) else ():
                open_tag = elements[stack[at]].tag
                if open_tag == "p" or open_tag in HEADINGS and tag in HEADINGS:
                    close(at)
                    break
                if open_tag in BARRIER:
                    break
        if tag in CLOSES:
            for at in range(len(stack) - 1, 0, -1) if any_open(CLOSES[tag]) else ():
                open_tag = elements[stack[at]].tag
                if open_tag in CLOSES[tag]:
                    close(at)
                    break
                if open_tag in BARRIER:
                    break
        if tag in VOID or m[3].endswith("/") and tag not in BLOCK:
            continue
        if tag == "article" or tag == "main":
            # an article is no part of a menu or header that was left open
            for at in range(1, len(stack)) if any_open(("nav", "header", "menu", "head")) else ():
                if elements[stack[at]].tag in ("nav", "header", "menu", "head"):
                    close(at)
                    break
        if tag == "body":
            for at in range(1, len(stack)) if open_["head"] > 0 else ():
                if elements[stack[at]].tag == "head":
                    close(at)
                    break
        parent = elements[stack[-1]]
        state, step, bonus = _kind(tag, m[3], parent.state, inside > 0)
        block = tag in CONTAINER
        elements.append(Element(tag, page.number(parent.path, step) if block else parent.path, stack[-1], state,
                                parent.link or tag == "a", bonus=bonus if block else 1.0))
        stack.append(len(elements) - 1)
        open_[tag] += 1
        inside += tag in ("article", "main")
        if tag in RAW_END:
            end = RAW_END[tag].search(source, pos)
            pos = end.start() if end else n
    flush()
    return page


def score(page: Page) -> int:
    """Element that holds the article best: text outside links for it, link lists against it."""
    elements = page.elements
    for owner, text, linked in page.blocks:
        size = len(text)
        if 2 * linked > size:
            elements[owner].bad += size
        else:
            elements[owner].good += max(0, size - linked)
    for e in reversed(elements[1:]):  # children come after their parents
        elements[e.parent].good += e.good
        elements[e.parent].bad += e.bad
    best, value = 0, -1.0
    for i, e in enumerate(elements):
        if e.state < 2 and (i == 0 or e.tag in CONTAINER) and e.good > 0:
            v = (e.good - e.bad) * e.bonus
            if v >= value:  # of equal ones the inner
                best, value = i, v
    return best


def text_below(page: Page, chosen: set[int]) -> str:
    """Blocks below the chosen elements, in page order."""
    below: dict[int, bool] = {-1: False}
    for i, e in enumerate(page.elements):
        below[i] = i in chosen or below[e.parent]
    return "\n\n".join(text for owner, text, _ in page.blocks if below[owner])


def main_text(page: Page, path: str | None) -> str:
    """Text below the host's winning path, or below the page's own best container."""
    best = score(page)
    own = page.elements[best]
    voted = page.find(path) if path is not None else None
    if path is not None and voted != own.path:
        same = {i for i, e in enumerate(page.elements)
                if e.path == voted and e.tag in CONTAINER and page.elements[max(e.parent, 0)].path != voted}
        held = sum(page.elements[i].good for i in same)
        return text_below(page, same if held >= MOST * own.good and same else same | {best})
    same = {i for i, e in enumerate(page.elements)
            if e.path == own.path and e.tag == own.tag and e.parent == own.parent and e.good > 0}
    return text_below(page, same | {best})


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = []
        for source in batch.column("html"):
            page = parse(source.as_py() or "")
            best = page.elements[score(page)]
            paths.append(page.path_text(best.path) if best.good > 0 else None)
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(paths, pa.string())],
                                         names=["host", "path"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [main_text(parse(s.as_py() or ""), p.as_py())
               for s, p in zip(batch.column("html"), batch.column("path"))]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())],
                                         names=["page_id", "url", "text"])


def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)),
                      F.lit(""))


def host_paths(pages: DataFrame, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """``host, path, votes``: the path with most votes of each host (of equal ones the first by name)."""
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    votes = (rows.mapInArrow(_votes, "host string, path string").where("path is not null")
             .groupBy("host", "path").agg(F.count("*").alias("votes")))
    rank = F.row_number().over(W.partitionBy("host").orderBy(F.desc("votes"), "path"))
    return votes.withColumn("r", rank).where("r = 1").drop("r")


def extract(pages: DataFrame, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """``page_id, url, text`` per input row."""
    winners = materialise(host_paths(pages, id_col, url_col, html_col), "host_paths")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host"))
    return (rows.join(winners.select("host", "path"), "host", "left")
            .select("page_id", "url", "html", "path")
            .mapInArrow(_texts, "page_id bigint, url string, text string"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
