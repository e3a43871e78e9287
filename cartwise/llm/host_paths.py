"""Main text of web pages by consensus host paths.

Each page's containers are scored by the running text they hold directly. A container is named by its
generalised path: the tags with classes from the body down, digits as `#`. In Spark every page votes for its
best path, votes are counted per host, and the paths with a fair share of a host's votes are the host's
winning paths. Every page is then read again with them: of the winners that it has, the one with the largest
product of votes and own score is its container; a page without any of them, or without a host, uses its own
best path. All elements of that path give the text, so an article in several parts is whole.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are left out
wherever they stand, told by tag, role or class; in a header inside the container headings stay.

Pages are never shuffled while the winners' table is under Spark's broadcast limit; beyond it they are joined
on host and salt, each winner repeated per salt, so that a host with a third of all pages is spread.

Defined cases: a null or empty page has an empty text; a page without any running text votes for nothing and
uses its host's winners, or else the whole body; a page without tags is one block; a null or unreadable URL has
no host; repeated rows are voted and extracted each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.shared import map_batches, slices, type_of, write_table

SHARE = 0.05  # of a host's votes that a winning path has at least, so a host has 20 at most
SALTS = 16
GOOD_CHARS = 25  # of a paragraph that counts as running text
GOOD_BARE = 80  # of text outside paragraphs that counts as running text
MENU_LINKS, MENU_SHARE = 3, 0.9  # links and their share of the characters in a list that is a menu
TAG_WEIGHT = {"article": 1.5, "main": 1.3}
CLASS_WEIGHT = 1.25

_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*"|'[^']*')*+"""
_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    rf"|<(?P<raw>script|style|textarea|title|iframe|xmp|noembed|noframes|noscript)(?=[\s/>]){_ATTRIBUTES}>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>{_ATTRIBUTES})>"
    r"|<(?:[!?]|/(?![a-zA-Z]))[^>]*>"
    r"|(?P<broken><(?=/?[a-zA-Z]))",
    re.S | re.I,
)
#: From a tag whose quotes do not close: tags end at the next `>`, whatever is quoted.
_LOOSE = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>[^>]*)>|<[!?/][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# HTML's elements by what they mean for blocks of text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr br".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset(
    "nav aside footer form button select svg canvas audio video object menu dialog template head datalist map".split()
)
PARAGRAPHS = frozenset("p li blockquote pre dd dt td th h1 h2 h3 h4 h5 h6 figcaption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol dl".split())
#: Elements that are no containers of their own: their text belongs to what holds them.
PASSED = PARAGRAPHS | LISTS | frozenset("table caption thead tbody tfoot tr figure details summary hgroup header".split())
#: Elements that a start tag closes, up to the elements that stop the search.
CLOSES = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu".split())
SKIPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners breadcrumb breadcrumbs byline comment comments "
    "consent cookie cookies dialog discussion disqus dropdown footer form gdpr header masthead menu modal nav navbar "
    "navigation newsletter notice notices notification outbrain pager pagination paywall popup promo promos promotion "
    "related recommended reply replies respond responses search share sharing shares sidebar sidebars signup social "
    "sponsor sponsored sponsors subscribe subscription taboola toolbar topbar tracking widget widgets".split()
)
CONTENT_NAMES = frozenset("article body content entry main page post story text wrapper container".split())
NO_NAMES = frozenset("has with no without is".split())


@dataclass
class Element:
    tag: str
    path: str
    skipped: bool
    header: bool  # inside a header, where only headings count


@dataclass
class Block:
    path: str
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    links: int = 0
    paragraph: bool = False
    lists: tuple[int, ...] = ()
    text: str = ""


def names_of(attributes: str) -> dict[str, str]:
    return {k.lower(): a or b or c or "" for k, a, b, c in _ATTRIBUTE.findall(attributes)}


def left_out(tag: str, names: dict[str, str]) -> bool:
    """Whether an element is none of the main text by its tag, role, class or identifier."""
    if tag in SKIPPED:
        return True
    if not names or tag in ("html", "body"):
        return False
    if "hidden" in names or names.get("aria-hidden") == "true" or names.get("role") in SKIPPED_ROLES:
        return True
    if "display:none" in names.get("style", "").replace(" ", "").lower():
        return True
    if tag in ("article", "main"):
        return False
    found = False
    for name in f"{names.get('class', '')} {names.get('id', '')}".split():
        words = [w.lower() for w in _WORD.findall(name)]
        if not words or words[0] in NO_NAMES:
            continue
        if words[-1] in CONTENT_NAMES and words[0] not in SKIPPED_NAMES:
            return False
        found = found or words[0] in SKIPPED_NAMES or words[-1] in SKIPPED_NAMES
    return found


def step(tag: str, names: dict[str, str]) -> str:
    """An element's part of a path."""
    named = names.get("class") or ("#" + names["id"] if names.get("id") else "")
    return re.sub(r"\d+", "#", ".".join([tag, *sorted(set(named.split()))]))


def blocks(page: str) -> list[Block]:
    """Blocks of visible text in page order, without what is left out. Lenient as browsers are: elements that are
    not closed end with their parents, and closing tags without an element are passed over."""
    stack = [Element("", "", False, False)]
    out: list[Block] = []
    current: Block | None = None
    link = False
    lists = 0
    open_lists: list[tuple[int, int]] = []  # (depth of the stack, number)

    def put(text: str) -> None:
        nonlocal current
        top = stack[-1]
        if top.skipped or top.header and top.tag not in HEADINGS:
            return
        if current is None:
            if text.isspace():
                return
            holder = next((e for e in reversed(stack) if e.tag not in PASSED), stack[0])
            current = Block(holder.path, paragraph=top.tag in PARAGRAPHS, lists=tuple(n for _, n in open_lists))
            out.append(current)
        text = html.unescape(text) if "&" in text else text
        current.parts.append(text)
        if link:
            current.linked += len(text)

    def pop_to(depth: int) -> None:
        nonlocal current
        del stack[depth:]
        while open_lists and open_lists[-1][0] >= depth:
            open_lists.pop()
        current = None

    at, pattern = 0, _TOKEN
    while True:
        for m in pattern.finditer(page, at):
            if m.start() > at:
                put(page[at : m.start()])
            at = m.end()
            if pattern is _TOKEN and m.lastgroup == "broken":
                at = m.start()
                break
            tag = m.group("tag")
            if tag is None:
                continue
            tag = tag.lower()
            if tag in INLINE:
                if tag == "a":
                    link = not m.group("close")
                    if link and current is not None:
                        current.links += 1
                elif tag == "br":
                    put(" ")
                continue
            if m.group("close"):
                depth = len(stack) - 1
                while depth and stack[depth].tag != tag:
                    depth -= 1
                if depth:
                    pop_to(depth)
                    link = False
                continue
            if tag in VOID:
                if tag == "hr":
                    current = None
                continue
            link = False
            if stack[-1].tag == "p":
                pop_to(len(stack) - 1)
            if tag in CLOSES:
                ended, stops = CLOSES[tag]
                depth = len(stack) - 1
                while depth and stack[depth].tag not in ended | stops:
                    depth -= 1
                if depth and stack[depth].tag in ended:
                    pop_to(depth)
                    if tag == "tr":
                        while stack[-1].tag in ended:
                            pop_to(len(stack) - 1)
            current = None
            names = names_of(m.group("attributes")) if m.group("attributes") else {}
            top = stack[-1]
            skipped = top.skipped or left_out(tag, names)
            path = top.path if tag in ("html", "body") else f"{top.path}/{step(tag, names)}"
            stack.append(Element(tag, path, skipped, top.header or tag == "header"))
            if tag in LISTS:
                lists += 1
                open_lists.append((len(stack) - 1, lists))
        else:
            break
        pattern = _LOOSE
    if at < len(page):
        put(page[at:])
    for b in out:
        b.text = _SPACE.sub(" ", "".join(b.parts)).strip()
    return _without_menus([b for b in out if b.text])


def _without_menus(found: list[Block]) -> list[Block]:
    """Leaves out lists that are nothing but links."""
    chars, linked, links = Counter(), Counter(), Counter()
    for b in found:
        for n in b.lists:
            chars[n] += len(b.text)
            linked[n] += b.linked
            links[n] += b.linked > 0
    menus = {n for n in chars if links[n] >= MENU_LINKS and linked[n] >= MENU_SHARE * chars[n]}
    return [b for b in found if not menus.intersection(b.lists)] if menus else found


def scores(found: list[Block]) -> dict[str, float]:
    """Running text of each container path that holds some, weighted by what its tags and classes say."""
    held: dict[str, float] = defaultdict(float)
    for b in found:
        if len(b.text) >= (GOOD_CHARS if b.paragraph else GOOD_BARE):
            held[b.path] += max(len(b.text) - b.linked, 0)
    for path in held:
        steps = path.split("/")
        held[path] *= max((w for t, w in TAG_WEIGHT.items() for s in steps if s.split(".")[0] == t), default=1.0)
        last = [w.lower() for name in steps[-1].split(".")[1:] for w in _WORD.findall(name)[-1:]]
        held[path] *= CLASS_WEIGHT if CONTENT_NAMES.intersection(last) else 1.0
    return {p: s for p, s in held.items() if s > 0}


def whole(path: str) -> str:
    """The path, or its article or main element, to which parts of an article belong."""
    steps = path.split("/")
    for i in range(len(steps) - 1, 0, -1):
        if steps[i].split(".")[0] in TAG_WEIGHT:
            return "/".join(steps[: i + 1])
    return path


def container_scores(found: list[Block]) -> dict[str, float]:
    out: dict[str, float] = defaultdict(float)
    for path, score in scores(found).items():
        out[whole(path)] += score
    return out


def best_path(held: dict[str, float]) -> str | None:
    return max(held, key=lambda p: (held[p], p), default=None)


def inside(path: str, container: str) -> bool:
    return path == container or path.startswith(container + "/")


def extract(page: str | None, winners: list[tuple[str, int]]) -> str:
    """Text of the page's container: of the winning (path, votes) that it has, or else its own best."""
    found = blocks(page or "")
    held = container_scores(found)
    own = [(votes * held[path], path) for path, votes in winners if path in held]
    path = max(own)[1] if own else None
    if path is None:
        # Short pages without running text: the host's strongest path that holds any text.
        path = next((p for p, _ in winners if not held and any(inside(b.path, p) for b in found)), None)
    if path is None:
        path = best_path(held)
    return "\n".join(b.text for b in found if path is None or inside(b.path, path))


def host(url: Column) -> Column:
    """Host of a URL in lower case, null without one."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def host_winners(pages: DataFrame) -> DataFrame:
    """(host, winners): each host's paths with at least SHARE of its pages' votes, most votes first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                votes: Counter = Counter()
                for at, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                    path = best_path(container_scores(blocks(page)))
                    if path is not None:
                        votes[at, path] += 1
                rows = [(*k, n) for k, n in votes.items()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))],
                    ["host", "path", "votes"],
                )

    cast = map_batches(pages.where("host IS NOT NULL AND html <> ''").select("host", "html"), work, "host string, path string, votes long")
    counted = write_table(cast.groupBy("host", "path").agg(F.sum("votes").alias("votes")), "path_votes")
    totals = counted.groupBy("host").agg(F.sum("votes").alias("cast"))
    fair = counted.join(totals, "host").where(F.col("votes") >= SHARE * F.col("cast"))
    ranked = F.transform(
        F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("rank"), "path", "votes"))),
        lambda w: F.struct(w["path"].alias("path"), w["votes"].alias("votes")),
    )
    return write_table(fair.groupBy("host").agg(ranked.alias("winners")), "host_winners")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row."""
    pages = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    winners = host_winners(pages).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = pages.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    joined = salted.join(winners, ["host", "salt"], "left").select("page_id", "url", "html", "winners")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                known = [[(w["path"], w["votes"]) for w in ws or ()] for ws in part.column("winners").to_pylist()]
                texts = [extract(p, w) for p, w in zip(part.column("html").to_pylist(), known, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return map_batches(joined, work, f"page_id {type_of(pages, 'page_id')}, url string, text string, n_chars long")
