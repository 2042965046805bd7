"""The main text of web pages by line-block distribution.

A page's markup is stripped into lines, one for each block of text, and an empty one where
a container begins or ends. The lengths of their texts, without those of links, are summed
over windows of consecutive lines: the main text lies between the points where the sums
surge and dive. What elements, roles and names say of a page's parts only refines that:
it takes menus, notices, adverts and the like from it, and adds the rest of an article.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import named

#: Lines of a window, the sum at which it surges, and the share of the largest sum it needs as well, in percent.
WINDOW, SURGE, PEAK_PERCENT = 3, 86, 20
#: A line is part of a menu if links hold more than this share of it, in percent.
LINKED_PERCENT = 50

#: The elements of HTML by what they mean here.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary"
    " table tbody td tfoot th thead title tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no text of the page, and those that hold another part of it. A form may wrap a whole page.
TEXTLESS = set(
    "applet audio button canvas datalist embed head iframe map noscript object optgroup script select style svg template"
    " textarea title video".split()
)
OTHER = set("aside dialog footer menu nav".split())
#: Containers: where one begins or ends, lines are parted.
CONTAINERS = set(
    "article aside blockquote body details dialog div dl fieldset figure footer form header main menu nav ol section table ul".split()
)
MAIN = {"article", "main"}
#: Words in class or id names, and roles, that mark other parts of a page.
NAMES = set(
    "ad ads advert adverts advertisement advertising alert alerts banner banners breadcrumb breadcrumbs byline comment"
    " comments consent cookie cookies copyright dialog disclaimer discussion disqus feedback footer form gdpr hidden login"
    " masthead menu menus modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall"
    " popup promo promoted promotion recommended related replies reply respond responses search share sharing sidebar"
    " signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
#: Words that make a name say what an element has, shows or is filed under, not what it is.
STATES = set("cat category format has no not overflow tag tagged type with without".split())
#: An element stays, whatever its names, if it holds more than this share of the page's text, in percent.
DOMINANT_PERCENT = 50
ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

#: Elements whose end tag may be left out: the start tags that end them, and the elements beyond which these do not reach.
_ROW = set("tbody td tfoot th thead tr".split())
ENDED_BY = {
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "li": ({"li"}, {"ol", "ul", "menu"}),
    "option": ({"option", "optgroup"}, {"datalist"}),
    "p": (
        set(
            "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1"
            " h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
        ),
        {"button", "caption", "object"},
    ),
    "tbody": ({"tbody", "tfoot"}, {"table"}),
    "td": (_ROW, {"table"}),
    "tfoot": ({"tbody"}, {"table"}),
    "th": (_ROW, {"table"}),
    "thead": ({"tbody", "tfoot"}, {"table"}),
    "tr": (_ROW - {"td", "th"}, {"table"}),
}
_ENDING = {x: [name for name, (names, _) in ENDED_BY.items() if x in names] for names, _ in ENDED_BY.values() for x in names}
_BARRIERS = {name for _, names in ENDED_BY.values() for name in names}

_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<raw>script|style|textarea|title|noscript|template|iframe|svg|select)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"
    r".*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")


@dataclass
class Line:
    """A block's text, the characters of it in links, the article it lies in (0: none),
    whether elements or names say that it belongs to another part of the page, and the
    innermost container that holds it."""

    text: str
    linked: int
    article: int
    other: bool = False
    container: int = 0


def _unseen(name: str, rest: str) -> bool:
    """Whether an element's text is none of the page, or hidden."""
    if name in TEXTLESS:
        return True
    if name in ("html", "body", "main") or not rest:
        return False
    for key, value in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return True
    return False


def _other_part(name: str, rest: str, in_article: bool) -> bool:
    """Whether an element or its role says that it is another part, whatever its names say."""
    if name in OTHER or (name == "header" and not in_article):
        return True
    if name in ("html", "body", "main") or not rest:
        return False
    return any(k.lower() == "role" and v.strip("\"'").lower() in ROLES for k, v in _ATTRIBUTE.findall(rest))


def _named_other(name: str, rest: str, in_article: bool) -> bool:
    """Whether a class or id says that an element is another part: as a whole or in a compound, not as a state or a modifier."""
    if name == "form":
        return True
    if name in ("html", "body", "main") or not rest:
        return False
    for key, value in _ATTRIBUTE.findall(rest):
        if key.lower() in ("class", "id"):
            for token in value.strip("\"'").split():
                words = {w.lower() for w in _SPLIT.split(token.split("--")[0])}
                if not words & STATES and (words & NAMES or ("header" in words and not in_article)):
                    return True
    return False


def lines_of(page: str) -> list[Line]:
    """The blocks of a page in order, an empty line where a container begins or ends."""
    marks = list(_MARKUP.finditer(page))
    ends = _ends(marks)
    held: _Held | None = None
    out: list[Line] = []
    parts: list[str] = []
    linked = link = article = articles = depth = 0
    held_by, containers = _Containers(), 0
    #: While in another part: the mark that ends it, and the state to go on with then.
    other: tuple[int, str, int, int, int, int] | None = None

    def close(gap: bool = False) -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Line(text, linked, article, other is not None, held_by.innermost()))
        if gap:
            out.append(Line("", 0, 0, other is not None))
        parts.clear()
        linked = 0

    at, k = 0, 0
    while k < len(marks):
        mark = marks[k]
        text = page[at : mark.start()]
        parts.append(text)
        if link:
            linked += len(text.strip())
        at, k = mark.end(), k + 1
        if other and k - 1 >= other[0]:
            own = bool(mark["end"]) and mark["name"].lower() == other[1]
            close()
            _, _, link, article, depth, n = other
            held_by.leave(n)
            other = None
            if own:
                close(mark["name"].lower() in CONTAINERS)
                continue
        name = (mark["name"] or "").lower()
        if not name:
            continue
        if mark["end"]:
            if name == "a":
                link = max(0, link - 1)
            if name in BLOCKS:
                close(name in CONTAINERS)
            held_by.end(name)
            if name in MAIN and depth:
                depth -= 1
                article = article if depth else 0
            continue
        if name not in VOID and _unseen(name, mark["rest"]):
            if name in BLOCKS:
                close(True)
            k = ends[k - 1]
            at = marks[k].start() if k < len(marks) else len(page)
            if k < len(marks) and marks[k]["end"] and marks[k]["name"].lower() == name:
                at, k = marks[k].end(), k + 1
            continue
        begins = other is None and name not in VOID and _other_part(name, mark["rest"], depth > 0)
        if other is None and not begins and name not in VOID and _named_other(name, mark["rest"], depth > 0):
            held = held or _Held(page, marks, ends)
            begins = not held.main(k - 1)
        if begins or name in BLOCKS:
            close(name in CONTAINERS)
        if begins:
            other = (ends[k - 1], name, link, article, depth, len(held_by.open))
        if name in CONTAINERS:
            containers += 1
            held_by.begin(name, containers)
        if name == "br":
            parts.append(" ")
        elif name == "a":
            link += not mark["rest"].endswith("/")
        elif name in BLOCKS:
            link = 0 if name in ("p", "li", "td") else link
        if name in MAIN:
            if not depth:
                articles += 1
                article = articles
            depth += 1
    parts.append(page[at:])
    close()
    return out


class _Containers:
    """The containers open at a place."""

    def __init__(self):
        self.open: list[tuple[str, int]] = []
        self.places: dict[str, list[int]] = {}

    def innermost(self) -> int:
        return self.open[-1][1] if self.open else 0

    def begin(self, name: str, number: int) -> None:
        self.places.setdefault(name, []).append(len(self.open))
        self.open.append((name, number))

    def end(self, name: str) -> None:
        if places := self.places.get(name):
            self.leave(places[-1])

    def leave(self, n: int) -> None:
        """Only the first ``n`` stay open."""
        while len(self.open) > n:
            self.places[self.open.pop()[0]].pop()


class _Open:
    """The elements open at a place, by their order; some may be closed below others."""

    def __init__(self):
        self.names: list[str | None] = []
        self.marks: list[int] = []
        #: For each name, and for each kind of elements, the places of open ones, ascending.
        self.places: dict[str, list[int]] = {}

    def _keys(self, name: str) -> list[str]:
        kinds = [name]
        if name in BLOCKS:
            kinds.append("*block")
            if name not in ENDED_BY:
                kinds.append("*lasting")
        if name in _BARRIERS:
            kinds.append("*barrier")
        return kinds

    def push(self, name: str, mark: int) -> None:
        for key in self._keys(name):
            self.places.setdefault(key, []).append(len(self.names))
        self.names.append(name)
        self.marks.append(mark)

    def last(self, key: str) -> int:
        """The place of the last open one, -1 if there is none."""
        places = self.places.get(key, ())
        return places[-1] if places else -1

    def first_above(self, key: str, place: int) -> int | None:
        places = self.places.get(key, ())
        i = bisect_right(places, place)
        return places[i] if i < len(places) else None

    def close(self, place: int) -> None:
        """Closes the last open element of its name, wherever others stand."""
        for key in self._keys(self.names[place]):
            places = self.places[key]
            del places[bisect_left(places, place)]
        self.names[place] = None
        while self.names and self.names[-1] is None:
            self.names.pop()
            self.marks.pop()


def _ends(marks: list[re.Match]) -> dict[int, int]:
    """For each start tag the place of the mark that ends it, the number of marks if none does.

    An end tag that may be left out is implied by the next sibling or the parent's end.
    Another element without its own end tag goes at most to the next article. The work
    grows with the marks (times a logarithm), whatever is left unclosed.
    """
    mains = [k for k, x in enumerate(marks) if (x["name"] or "").lower() in MAIN and not x["end"]]
    out: dict[int, int] = {}
    held = _Open()

    def implied(first: int, place: int) -> None:
        """Ends what is open from ``first`` on, without own end tags."""
        while len(held.names) > first:
            name, k = held.names[-1], held.marks[-1]
            later = bisect_right(mains, k)
            out[k] = place if name in ENDED_BY or later == len(mains) else min(place, mains[later])
            held.close(len(held.names) - 1)

    for k, mark in enumerate(marks):
        name = (mark["name"] or "").lower()
        if not name or name in VOID and name not in _ENDING:
            continue
        if not mark["end"]:
            # What ends a part also ends what is open inside it, up to an element that holds siblings of its own.
            stop = max(held.last("*barrier"), -1 if name in ENDED_BY else held.last("*lasting"))
            firsts = [held.first_above(x, stop) for x in _ENDING.get(name, ())]
            first = min((x for x in firsts if x is not None), default=None)
            if first is not None:
                implied(first, k)
            if name not in VOID:
                held.push(name, k)
            continue
        at = held.last(name)
        # An end tag in a table's cell or a list does not end what lies around them.
        scopes = {"table", *ENDED_BY.get(name, (0, ()))[1]} - {name}
        if at < 0 or any(held.last(x) > at for x in scopes):
            continue
        if name in BLOCKS or held.last("*block") <= at:
            implied(at + 1, k)
        out[held.marks[at]] = k
        held.close(at)
    implied(0, len(marks))
    return out


class _Held:
    """What text the elements of a page hold."""

    def __init__(self, page: str, marks: list[re.Match], ends: dict[int, int]):
        self.ends = ends
        #: Characters of text before each mark, without what is no text by its element.
        self.before = [0]
        #: The articles that lie in no element which names mark as another part.
        self.free: list[tuple[int, int]] = []
        self.articles: list[int] = []
        at, dropped, marked = 0, 0, 0
        for k, mark in enumerate(marks):
            size = 0 if k < dropped else len(page[at : mark.start()].strip())
            self.before.append(self.before[-1] + size)
            at = mark.end()
            name = (mark["name"] or "").lower()
            if not name or mark["end"] or name in VOID or k < dropped:
                continue
            if _unseen(name, mark["rest"]) or _other_part(name, mark["rest"], True):
                dropped = ends[k] + 1
                continue
            named = _named_other(name, mark["rest"], True)
            if named:
                marked = max(marked, ends[k])
            elif name in MAIN:
                self.articles.append(k)
                if k >= marked:
                    self.free.append((k, ends[k]))
        self.all = self.before[-1] + (0 if dropped >= len(marks) and dropped else len(page[at:].strip()))
        self.before.append(self.all)
        self.first_end = min((b for _, b in self.free), default=len(marks))
        self.last_start = max((a for a, _ in self.free), default=-1)

    def main(self, k: int) -> bool:
        """Whether an element holds the main text: an article, or the larger part of the page's text,
        and no article that names do not mark lies elsewhere."""
        end = self.ends[k]
        if self.first_end < k or self.last_start > end:
            return False
        text = self.before[end + 1] - self.before[k + 1]
        return bisect_right(self.articles, k) < bisect_left(self.articles, end) or text * 100 > DOMINANT_PERCENT * self.all


def surges(sizes: list[int]) -> list[bool]:
    """Which lines lie between a surge and a dive of the window sums.

    Runs of lines that hold text are kept where the sum over a window of them reaches the
    surge and a share of the largest such sum; without a surge, those of the largest sum.
    What lies between two kept runs, no window apart, is kept with them.
    """
    runs: list[tuple[int, int, int]] = []
    i = 0
    while i < len(sizes):
        j = i
        while j < len(sizes) and sizes[j]:
            j += 1
        if j > i:
            runs.append((i, j, max(sum(sizes[k : min(k + WINDOW, j)]) for k in range(i, j))))
        i = j + 1
    largest = max((peak for _, _, peak in runs), default=0)
    level = max(min(SURGE, largest), largest * PEAK_PERCENT / 100)
    kept = [False] * len(sizes)
    high = [k for k, (_, _, peak) in enumerate(runs) if peak >= level]
    last = None
    for k in high:
        first = runs[k][0]
        if last is not None and all(runs[n + 1][0] - runs[n][1] <= WINDOW for n in range(last, k)):
            first = runs[last][0]
        for line in range(first, runs[k][1]):
            kept[line] = True
        last = k
    return kept


def kept_lines(lines: list[Line]) -> list[bool]:
    """Which lines are main text: those the window sums find, as elements and names refine them.

    Lines of other parts are taken from them; lines that stand in one container with kept
    ones are added. Where an article holds kept lines, all its lines are added, and what lies
    outside of it goes. If the sums find other parts only, they are formed again without these.
    """
    sizes = [0 if x.linked * 100 > LINKED_PERCENT * len(x.text) else len(x.text) for x in lines]
    kept = [k and not x.other for x, k in zip(lines, surges(sizes), strict=True)]
    if not any(kept):
        sizes = [0 if x.other else n for x, n in zip(lines, sizes, strict=True)]
        kept = surges(sizes)
    main = {x.article for x, k in zip(lines, kept, strict=True) if k and x.article}
    if main:
        return [x.article in main and bool(x.text) and not x.other for x in lines]
    beside = {x.container for x, k in zip(lines, kept, strict=True) if k and x.text}
    return [(k or x.container in beside and n > 0) and bool(x.text) and not x.other for x, k, n in zip(lines, kept, sizes, strict=True)]


def main_text(page: str) -> str:
    lines = lines_of(page)
    return "\n\n".join(x.text for x, keep in zip(lines, kept_lines(lines), strict=True) if keep)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 512):
            part = batch.slice(a, 512)
            texts = [main_text(page or "") for page in part.column(2).to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"]
            )


def extracted(pages: DataFrame, id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per row of ``pages``: page_id, url, text (blocks parted by an empty line), n_chars.

    A null or empty page, and one without text, gives an empty text. Broken markup is read
    as far as it goes: an unclosed article ends with the page, a paragraph or list entry as in HTML. Null ids and
    urls stay, repeated rows are extracted each, other columns are not read. Pages are read whole, in time that
    grows with their length however their markup is broken.
    """
    source = pages.select(
        named(id).cast("long").alias("page_id"), named(url).cast("string").alias("url"), F.coalesce(named(page), F.lit("")).alias("html")
    )
    return source.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
