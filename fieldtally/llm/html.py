"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame

from fieldtally.llm.common import with_columns_of

#: A comment or declaration without an end reaches to the end of the page.
OPEN_MARK = re.compile(r"<[!?]")
#: A quote delimits only behind an equals sign. Nothing is tried twice, so a broken tag costs
#: one look at the rest.
MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|"""
    r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""", re.DOTALL)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?+""")
#: Words of a class or id: at marks, digits and where capitals begin.
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
#: Tags whose text is never part of the article.
ASIDE = RAW | {"head", "nav", "footer", "aside", "button", "select", "option", "noscript",
               "template", "svg", "math", "canvas", "object", "audio", "video", "menu", "dialog",
               "label", "datalist", "map"}
#: Tags of forms: a mark against their text, unless the form holds most of the page.
FORM = {"form", "fieldset"}
#: A class or id that ends in one of these words, but for words of PLACES, is a mark against its text.
ASIDE_NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promos "
    "promotion banner banners nav navbar navigation menu menus header masthead footer topbar "
    "sidebar sidebars aside comment comments reply replies respond disqus discussion "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "breadcrumb breadcrumbs share sharing social related recommended recommendations newsletter "
    "subscribe subscription signup login search pagination pager toolbar "
    "copyright disclaimer hidden".split())
PLACES = set(
    "area bar block body bottom box button buttons card container content inner item items left "
    "links list outer panel right section slot text thread top unit wrap wrapper".split())
#: Words that say whether something else has such a part.
WITHOUT = {"with", "without", "has", "no"}
ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog",
               "alert", "menu", "menubar", "alertdialog"}
#: Tags that begin and end a block of text.
BLOCK = set(
    "address article blockquote body center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 "
    "h6 header hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr "
    "ul".split()) | FORM | ASIDE - {"label", "button", "svg", "math", "map", "object"}
CONTAINER = {"article", "main"}
#: A tag that a new one closes, up to the nearest of the tags that hold it.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
          "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
ENDS_PARAGRAPH = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "body", "html", "head"}
MARKS = re.compile(r"[.,;:!?。，、；：！？…]")
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Parts of a page. The paths from a part to its paragraphs, lists, tables and headings belong together.
PARTS = {"article", "body", "center", "div", "fieldset", "form", "header", "html", "main", "section"}
#: What a path's score is multiplied by for each mark against it, and outside the main container.
BESIDE = 0.01
#: A path holds content from this share of the page's level on; within the main container from the second.
SHARE = 0.1
SHARE_WITHIN = 0.02


@dataclass
class Block:
    """A run of text, its path of tags from the root, the element around it, its standing,
    the part of the page (the nearest element of PARTS) that it lies in, its letters in links."""

    path: int
    element: int
    text: str
    aside: bool
    part: int
    linked: int


@dataclass
class Path:
    """A path of block tags and class words from the root: its last tag, and how many marks
    and forms are on it."""

    tag: str
    marks: int
    forms: int


@dataclass
class Page:
    """The blocks in order, the paths, and the elements: each one's tag and the lower number of its holder.

    Element 0 is the whole page. Holders instead of lists of all elements above keep a page
    of any depth in memory that follows its length.
    """

    blocks: list[Block]
    paths: list[Path]
    tags: list[str]
    holder: list[int]


def _named_aside(value: str, in_container: bool) -> bool:
    for name in value.split():
        words = [w.lower() for w in NAME.findall(name)]
        if WITHOUT.intersection(words):
            continue
        while len(words) > 1 and words[-1] in PLACES:
            words.pop()
        if words and words[-1] in ASIDE_NAMES and not (in_container and words[-1] == "header"):
            return True
    return False


def _standing(tag: str, attributes: str, in_container: bool) -> tuple[bool, bool, tuple[str, ...]]:
    """Whether an element stands aside, whether it is marked, and the words of its class."""
    aside, marked, words = tag in ASIDE, tag == "header" and not in_container, ()
    if attributes and not aside:
        for name, value in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true" \
                    or name == "role" and value.lower() in ASIDE_ROLES:
                aside = True
            elif name in ("class", "id") and tag not in ("html", "body") and tag not in CONTAINER:
                marked = marked or _named_aside(value, in_container)
                if name == "class":
                    words = tuple(w.lower() for w in NAME.findall(value))
    return aside or marked and tag not in BLOCK, marked, words


def page_of(page: str) -> Page:
    """The page's blocks and elements. Unclosed and crossed tags are mended as browsers do."""
    found = Page([], [Path("", 0, 0)], [""], [0])
    paths: dict[tuple, int] = {}
    opened: list[str] = []  # the open tags, and for each its element, path, standing and part
    places: list[tuple[int, int, bool, int]] = [(0, 0, False, 0)]
    times: dict = defaultdict(int)
    held: list[str] = []
    place = places[0]
    linked = 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                found.blocks.append(Block(place[1], place[0], text, place[2], place[3],
                                          min(linked, len(text))))
            held.clear()
        linked = 0

    def put(text: str) -> None:
        nonlocal place, linked
        if text:
            if not held or len(held) == 1 and not held[0].strip():
                place = places[-1]
            elif place[2] != places[-1][2]:
                flush()
                place = places[-1]
            held.append(text)
            if times["a"]:
                linked += len(text.strip())

    def last(tag: str) -> int:
        return next(d for d in range(len(opened) - 1, -1, -1) if opened[d] == tag)

    def close(depth: int) -> None:
        if any(t in BLOCK for t in opened[depth:]):
            flush()
        for tag in opened[depth:]:
            times[tag] -= 1
        del opened[depth:], places[depth + 1:]

    at = 0
    lower = None
    end_of_tags = page.rfind(">")
    while True:
        match = MARKUP.search(page, at) if at <= end_of_tags else None
        unended = OPEN_MARK.search(page, at) if match is None else match
        text = page[at:unended.start() if unended else len(page)]
        if text:
            put(html.unescape(text) if "&" in text else text)
        if not match:
            break
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if match[1]:
            if times[tag]:
                depth = last(tag)
                if tag in BLOCK or not any(t in BLOCK for t in opened[depth:]):
                    close(depth)
            elif tag in ("br", "p"):
                put("\n")
            continue
        if tag in ENDS_PARAGRAPH and times["p"]:
            close(last("p"))
        if tag in CLOSES:
            closed, within = CLOSES[tag]
            if any(times[t] for t in closed):
                for depth in range(len(opened) - 1, -1, -1):
                    if opened[depth] in within:
                        break
                    if opened[depth] in closed:
                        close(depth)
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                put("\n")
            continue
        if tag in BLOCK:
            flush()
        if match[3].endswith("/") and tag in ("svg", "math"):
            continue
        if tag in RAW:
            lower = page.lower() if lower is None else lower
            if len(lower) == len(page):
                end = lower.find("</" + tag, at)
            else:  # lower case of another length moves places
                ending = re.compile("</" + tag, re.IGNORECASE).search(page, at)
                end = ending.start() if ending else -1
            end = len(page) if end < 0 else end
            at = page.find(">", end) + 1 or len(page)
            continue
        element, path, aside, part = places[-1]
        off, marked, words = _standing(tag, match[3], bool(times["article"] or times["main"]))
        aside = aside or off
        if tag in BLOCK:
            key = (path, tag, words, marked)
            if key not in paths:
                above = found.paths[path]
                paths[key] = len(found.paths)
                found.paths.append(Path(tag, above.marks + marked, above.forms + (tag in FORM)))
            path = paths[key]
        places.append((len(found.tags), path, aside, len(found.tags) if tag in PARTS else part))
        found.tags.append(tag)
        found.holder.append(element)
        opened.append(tag)
        times[tag] += 1
    flush()
    return found


def _within(page: Page, sizes: list[float]) -> tuple[list[float], list[bool]]:
    """Sizes of elements with all inside them, and which lie in the main container.

    That is the article or main element with most text; the outermost of equal ones, as
    an article within another is part of it. Without one, none does.
    """
    sizes = list(sizes)
    for element in range(len(sizes) - 1, 0, -1):
        sizes[page.holder[element]] += sizes[element]
    held = [(-n, e) for e, n in enumerate(sizes) if n and page.tags[e] in CONTAINER]
    within = [False] * len(sizes)
    if held:
        root = min(held)[1]
        for element in range(root, len(sizes)):
            within[element] = element == root or within[page.holder[element]]
    return sizes, within


def path_scores(page: Page) -> tuple[list[tuple[Block, bool]], dict[tuple[int, int], float]]:
    """Blocks that do not stand aside, with whether they lie in the main container, and
    the score of each path in each part of the page.

    A path's length ratio is its letters divided by its blocks, its mark ratio one and
    its punctuation marks divided by its blocks; their product fuses them. It is smoothed
    over the paths that meet in a part of the page: half its own, half the part's mean,
    weighed by letters out of links. Then it is multiplied by the square of its share of
    letters out of links there, and by BESIDE for each mark (a telling class or id, a header
    out of articles, a form) and if another part of the page is the main container. Forms
    are no mark on a page with half its text in one.
    """
    inner = [b for b in page.blocks if not b.aside]
    letters: dict = defaultdict(int)
    for b in inner:
        letters[b.element] += len(b.text)
    sizes, _ = _within(page, [letters[e] for e in range(len(page.tags))])
    framed = any(n >= sizes[0] / 2 and page.tags[e] == "form" for e, n in enumerate(sizes))

    def marks(path: int) -> int:
        return page.paths[path].marks + (0 if framed else page.paths[path].forms)

    weighed: dict = defaultdict(float)
    for b in inner:
        weighed[b.element] += len(b.text) * BESIDE ** marks(b.path)
    _, within = _within(page, [weighed[e] for e in range(len(page.tags))])
    contained = any(within)
    total: dict = defaultdict(lambda: [0, 0, 0])
    there: dict = defaultdict(lambda: [0, 0])
    for b in inner:
        for sums, values in ((total[b.path], (1, len(b.text), len(MARKS.findall(b.text)))),
                             (there[b.path, b.part], (len(b.text), b.linked))):
            for i, n in enumerate(values):
                sums[i] += n
    if not contained and all(marks(path) for path in total):
        return [], {}
    own = {path: n / times * (1 + m / times) for path, (times, n, m) in total.items()}
    parts: dict = defaultdict(lambda: [0.0, 0])
    for (path, part), (n, linked) in there.items():
        parts[part][0] += (n - linked) * own[path]
        parts[part][1] += n - linked
    scores = {}
    for (path, part), (n, linked) in there.items():
        mean, weight = parts[part]
        smoothed = own[path] / 2 + (mean / weight if weight else 0.0) / 2
        scores[path, part] = (smoothed * (1 - linked / n) ** 2 * BESIDE ** marks(path)
                              * (BESIDE if contained and not within[part] else 1))
    return [(b, within[b.part]) for b in inner], scores


def content_of(page: Page) -> list[Block]:
    """The blocks of the main text.

    The page's level is the mean of its paths' scores, weighed by letters times score.
    Paths that reach SHARE of it (SHARE_WITHIN in the main container) hold content. A
    heading without a mark goes as the next block that is none and does not stand aside.
    Where all text is in links, the paths with fewest marks hold content. If there is no
    main container and all text is marked, there is none.
    """
    blocks, scores = path_scores(page)
    if not scores:
        return []
    mass: dict = defaultdict(int)
    for b, _ in blocks:
        mass[b.path, b.part] += len(b.text)
    first = sum(mass[k] * s for k, s in scores.items())
    if not first:
        fewest = min(page.paths[path].marks for path, _ in scores)
        return [b for b, _ in blocks if page.paths[b.path].marks == fewest]
    level = sum(mass[k] * s * s for k, s in scores.items()) / first
    kept, chosen = False, []
    for b, inside in reversed(blocks):
        path = page.paths[b.path]
        reached = scores[b.path, b.part] >= level * (SHARE_WITHIN if inside else SHARE)
        if path.tag not in HEADINGS:
            kept = reached
        elif not path.marks:
            reached = reached or kept
        if reached:
            chosen.append(b)
    return chosen[::-1]


def main_text(page: str | None) -> str:
    return "\n\n".join(b.text for b in content_of(page_of(page or "")))


def extract(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, text): the main text of each page.

    A null or empty page, and one without text beside what stands aside or is marked,
    gives an empty text. Ties keep page order. Whole pages are read, however long; a page that is plain text is its own main
    text. Only page_id, url and html are used; rows may repeat, and an empty table gives
    an empty result.
    """
    return with_columns_of(pages, "html", ["page_id", "url"], {"text": "string"},
                           lambda found: ([main_text(p) for p in found],))
