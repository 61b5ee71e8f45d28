"""Main text of web pages by line-block distribution.

Markup is stripped into lines (one per block element; a blank line stands for
every block boundary, one more for each element in between that holds others,
several for a removed zone).  The text lengths of the lines, without link text,
are summed over sliding windows; a run of lines goes from a surge point (the sum
leaves zero) to the next dive point (it falls to zero: so many boundaries, or a
zone, follow one another).  Runs whose sums reach both ``surge`` and one
``share``-th of the page's highest are kept, and with them the short runs that
lie in the same element, in one within, or in the innermost element around all
kept runs.  Zones that markup itself names as
boilerplate (navigation, page headers and footers, asides, forms, adverts,
notices, comments, scripts, styles) count as removed; a form, an unclosed element
or one that only its class, id or role names is no zone where it holds an article,
or the page's highest window sum and the bulk of its text.  Where a page marks its
article (``article`` or ``main``), runs end at the element's borders, link text
in it counts like other text and all of its runs are kept; runs outside are kept
where they surge by themselves.  Lines of links alone between two kept lines stay.

Null and empty pages give an empty text.  Where nothing surges, the run with
the highest window sum that isn't all links is kept, so that short pages keep
their text.  Repeated rows are extracted each for itself; extra columns stay
out of the result.
"""

from __future__ import annotations

import html as _html
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

#: Elements whose content is never text of a page: those without markup inside
#: (up to the first close tag), and those with elements inside.
RAW = "script style iframe textarea title"
HIDDEN = frozenset("noscript template svg object canvas math select button".split())
FOREIGN = frozenset("svg math".split())
#: Elements that are boilerplate as a whole.
ZONES = frozenset("nav header footer aside form dialog menu figure-ad".split())
#: Words in class, id or role that name boilerplate.
ZONE_WORDS = frozenset(
    "nav navbar navigation menu topbar header masthead banner footer sidebar aside ad ads advert "
    "adverts advertisement advertising sponsor sponsored promo promoted cookie cookies consent gdpr "
    "notice notices alert popup modal overlay comment comments commentlist disqus reply replies "
    "respond share sharing social related recommended breadcrumb breadcrumbs pagination pager "
    "subscribe subscription newsletter signup login widget search searchbox toolbar skip "
    "contentinfo complementary form".split())
#: First words of class names that say something about a page and name no zone.
STATES = frozenset("has have no not non with without is are show hide hidden enable enabled disable disabled".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol "
    "option p pre section summary table tbody td tfoot th thead tr ul".split())
LANDMARKS = frozenset("article main nav header footer aside".split())
CONTAINERS = LANDMARKS | frozenset(
    "div section ul ol dl table form dialog menu p span td tr tbody li blockquote figure h1 h2 h3 "
    "details fieldset".split())
#: Elements whose children belong together.
HOLDERS = frozenset("article main body div section td blockquote ul ol table".split())

#: Elements that are followed from their open to their close tag.
TREE = (BLOCKS | CONTAINERS | HIDDEN) - {"body", "html", "head"}
NOT_INLINE = (BLOCKS | HIDDEN) - {"p"}
#: What a close tag of a block within doesn't end.
CELLS = frozenset("td th caption object template button".split())
PARTS = frozenset("table caption tbody thead tfoot tr td th".split())
_TABLE = frozenset(("table",))
_LISTS = frozenset("ul ol menu dir dl table select article main section nav aside header footer".split())
SIBLINGS = ({"li": (("li",), _LISTS), "option": (("option",), _LISTS), "tr": (("tr",), _TABLE)}
            | dict.fromkeys(("dt", "dd"), (("dt", "dd"), _LISTS))
            | dict.fromkeys(("td", "th"), (("td", "th"), _TABLE | {"tr"}))
            | dict.fromkeys(("tbody", "thead", "tfoot"), (("tbody", "thead", "tfoot"), _TABLE)))

#: Comment, CDATA, declaration, tag: in one scan, so that none starts within another.
_TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|(<!\[CDATA\[)|<[!?][^>]*>"""
    r"""|<(/?)([a-zA-Z][^\s/<>]*)((?:"[^"]*+"|'[^']*+'|[^'"<>])*+)>""", re.S)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I) for name in RAW.split()}
_NAMED = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORD = re.compile(r"[a-z]+")


def _scan(page: str) -> list[tuple]:
    """(is a close tag, name, attributes, start, end) of all tags in order.  A comment is
    named "!" and a left-out element "#".  As in browsers, an unclosed comment, script
    or style has the rest of the page; another unclosed element has only its tag."""
    tags, at, depth, missing = [], 0, 0, set()
    while m := _TOKEN.search(page, at):
        at = m.end()
        if m[1]:
            stop = -1 if "cdata" in missing else page.find("]]>", at)
            if stop < 0:
                missing.add("cdata")
                at = max(at, page.find(">", at) + 1)
            else:
                at = stop + 3
        if not m[3]:
            tags.append((False, "!", "", m.start(), at))
            continue
        end, tag, attrs = m[2] == "/", m[3].lower(), m[4]
        closed = attrs.endswith("/")
        if tag in FOREIGN:
            if end or not closed:
                depth = max(0, depth + (-1 if end else 1))
            else:
                tag = "#"
        elif tag in _RAW_END and not end:
            found = None
            if not (closed and depth) and tag not in missing:
                found = _RAW_END[tag].search(page, at)
                if not found:
                    missing.add(tag)
            if found:
                at = found.end()
            elif tag in ("script", "style") and not closed:
                at = len(page)
            tag = "#"
        tags.append((end, tag, attrs, m.start(), at))
    ends = _ends(tags) if any(t[1] in HIDDEN for t in tags) else {}
    out, skip = [], -1
    for i, t in enumerate(tags):
        if i > skip:
            if t[1] in HIDDEN and not t[0] and ends.get(i, (0, False))[1]:
                skip = ends[i][0]
                t = (False, "#", "", t[3], tags[skip][4])
            out.append(t)
    return out


def _ends(tags: list[tuple]) -> dict[int, tuple[int, bool]]:
    """Per open tag: (index of the tag that ends its element, whether it's its own close
    tag).  A p ends at the next block, list items and table parts at the next of their kind
    in the same list or table, and everything open in an element ends with it."""
    ends: dict[int, tuple[int, bool]] = {}
    open_: list[tuple[str, int]] = []
    count: dict[str, int] = {}

    def cut(depth: int, k: int, own: bool) -> None:
        while len(open_) > depth:
            name, i = open_.pop()
            count[name] -= 1
            ends[i] = (k, own and len(open_) == depth)

    def find(names, borders) -> int:
        if any(count.get(x) for x in names):
            for d in range(len(open_) - 1, -1, -1):
                if open_[d][0] in names:
                    return d
                if open_[d][0] in borders:
                    break
        return -1

    for k, (end, tag, _, _, _) in enumerate(tags):
        if tag not in TREE:
            continue
        if not end:
            if tag in BLOCKS and (d := find(("p",), NOT_INLINE)) >= 0:
                cut(d, k, False)
            if tag in SIBLINGS and (d := find(*SIBLINGS[tag])) >= 0:
                cut(d, k, False)
            if tag != "hr":
                open_.append((tag, k))
                count[tag] = count.get(tag, 0) + 1
        elif (d := find((tag,), NOT_INLINE if tag == "span" else _TABLE if tag in PARTS else CELLS)) >= 0:
            cut(d, k, True)
    return ends


def _words_of(token: str) -> set[str]:
    """Boilerplate words that one class, id or role is named by: the whole of it, its
    first word, or its last; none where the first word says a state (``has-sidebar``)."""
    words = _WORD.findall(token.split("--")[0])
    if not words or words[0] in STATES:
        return set()
    return {token, words[0], words[-1]} & ZONE_WORDS


def _named_zone(tag: str, attrs: str, inside: bool) -> bool:
    if tag in ("body", "html", "article", "main") or not attrs:
        return False
    for value in _NAMED.findall(attrs):
        for token in value.strip("\"'").lower().split():
            hits = _words_of(token)
            if hits and not (inside and hits <= {"header", "banner"}):
                return True
    return False


def _zones(tags: list[tuple]) -> tuple[list[tuple], list[tuple], list[tuple]]:
    """(sure zones, doubtful zones, outermost article elements), each a range of tags:
    (the first, the one that ends it, whether that is its own close tag).

    Sure are closed elements of ``ZONES`` other than forms.  No zone holds an article,
    but a sure one beside an article outside all of them.  An element that nothing
    closes ends as a zone at the next landmark."""
    ends, n = _ends(tags), len(tags)
    marks = [i for i, t in enumerate(tags) if not t[0] and t[1] in LANDMARKS]
    articles, sure, doubtful, covered = [], [], [], -1
    for i, (end, tag, attrs, _, _) in enumerate(tags):
        if end or tag not in CONTAINERS and tag not in ZONES:
            continue
        stop, own = ends.get(i, (n, False))
        inside = i < covered
        if tag in ("article", "main"):
            if not inside:
                covered = stop
                articles.append((i, stop, own))
            continue
        by_tag = tag in ZONES and not (inside and tag == "header")
        if not (by_tag or _named_zone(tag, attrs, inside)):
            continue
        if not own and (later := bisect_right(marks, i)) < len(marks):
            stop = min(stop, marks[later])
        (sure if by_tag and own and tag != "form" else doubtful).append((i, stop, own))
    starts = [a[0] for a in articles]

    def holds(zone: tuple) -> bool:
        return bisect_left(starts, zone[0]) < bisect_left(starts, zone[1])

    if articles and sum(bisect_left(starts, z[1]) - bisect_left(starts, z[0])
                        for z in _outermost(sure)) == len(articles):
        sure = [z for z in sure if not holds(z)]
    return sure, [z for z in doubtful if not holds(z)], articles


def _outermost(zones: list[tuple]) -> list[tuple]:
    out: list[tuple] = []
    for zone in sorted(zones):
        if not out or zone[0] >= out[-1][1]:
            out.append(zone)
    return out


def _removed(page: str, tags: list[tuple], window: int, surge: int) -> tuple[list[tuple], list[tuple]]:
    """(zones to remove, article elements).  A doubtful zone is none where it holds the
    page's highest window sum and, beside it, more text than is left or twice the highest
    sum that is left; a closed one that isn't a form only if that sum surges."""
    sure, doubtful, articles = _zones(tags)
    if not doubtful:
        return _outermost(sure), articles
    lines = _lines(page, tags, _outermost(sure), articles, window)
    size = [x[1] * max(1, surge) if x[2] else x[1] for x in lines]
    sums = [sum(size[j:j + window]) for j in range(len(size))]
    best = max(range(len(sums)), key=sums.__getitem__)
    at = lines[max(range(best, min(best + window, len(size))), key=size.__getitem__)][4]
    around = [z for z in doubtful if z[0] <= at < z[1]]
    if not (sums[best] and around):
        return _outermost(sure + doubtful), articles
    others = _outermost([z for z in doubtful if not z[0] <= at < z[1]])
    where = [k for k, x in enumerate(lines) if x[4] >= 0]
    place = [lines[k][4] for k in where]
    o = 0
    for k in where:  # what stays a zone isn't left
        while o < len(others) and others[o][1] <= lines[k][4]:
            o += 1
        if o < len(others) and others[o][0] <= lines[k][4]:
            size[k] = 0
    left = [sum(size[j:j + window]) for j in range(len(size))]
    upto = list(accumulate(size, initial=0))
    before = list(accumulate(left, max, initial=0))
    after = list(accumulate(reversed(left), max, initial=0))[::-1]
    void = set()
    for z in around:
        lo, hi = where[bisect_left(place, z[0])], where[bisect_left(place, z[1]) - 1] + 1
        inside = upto[hi] - upto[lo]
        rest = max(before[max(0, lo - window + 1)], after[hi])
        if (inside > upto[-1] - inside or sums[best] >= 2 * rest) and (
                sums[best] >= surge or not z[2] or tags[z[0]][1] == "form"):
            void.add(z)
    return _outermost(sure + [z for z in doubtful if z not in void]), articles


def _lines(page: str, tags: list[tuple], zones: list[tuple], articles: list[tuple],
           window: int, parents: dict[int, int] | None = None) -> list[list]:
    """[text pieces, counted length, number of its article or 0, innermost holder, tag
    before its longest piece] per line; blank lines stand for block boundaries and
    removed zones."""
    blank = [[], 0, 0, -1, -1]
    parents = {} if parents is None else parents
    lines: list[list] = [[[], 0, 0, -1, -1]]
    holders: list[tuple[str, int]] = []
    z = a = links = longest = 0
    skip = None
    n = len(tags)
    for i in range(-1, n):
        end, tag, _, _, at = tags[i] if i >= 0 else (False, "", "", 0, 0)
        own = False
        if skip is not None:
            if i < skip[1]:
                continue
            own, skip = skip[2], None
            lines += [blank] * window + [[[], 0, 0, -1, -1]]
        if z < len(zones) and zones[z][0] == i:
            skip = zones[z]
            z += 1
            continue
        if not own:
            if tag in HOLDERS:
                if not end:
                    parents[i] = holders[-1][1] if holders else -1
                    holders.append((tag, i))
                else:
                    open_at = next((k for k in range(len(holders) - 1, -1, -1) if holders[k][0] == tag), None)
                    if open_at is not None:
                        del holders[open_at:]
            if tag == "a":
                links = 0 if end else 1
            elif tag in ("br", "#"):
                lines[-1][0].append(" ")
            elif tag in BLOCKS:
                links = 0
                if lines[-1][0]:
                    lines += [blank, [[], 0, 0, -1, -1]]
                if tag in HOLDERS:
                    lines.insert(-1, blank)
        stop = tags[i + 1][3] if i + 1 < n else len(page)
        if at < stop:
            while a < len(articles) and articles[a][1] <= i:
                a += 1
            piece = page[at:stop]
            line = lines[-1]
            mark = a + 1 if a < len(articles) and articles[a][0] <= i else 0
            size = len(piece.strip())
            line[0].append(piece)
            if mark or not links:
                line[1] += size
            line[2] = line[2] or mark
            if size:
                line[3] = holders[-1][1] if holders else -1
                if line[4] < 0 or size > longest:
                    line[4], longest = i, size
    return lines


def _inside(within: set[int], parents: dict[int, int], tags: list[tuple]) -> set[int]:
    """The given holders, all holders in them (the page's body is none), and all in
    the innermost holder around every one of them."""
    held = dict.fromkeys(parents, 0)
    for h in within:
        if h in held:
            held[h] = 1
    for h in reversed(parents):  # an element opens after those around it
        if parents[h] in held:
            held[parents[h]] += held[h]
    common = max((h for h, n in held.items() if n == len(within)), default=-1)
    out = set(within)
    for h, around in parents.items():
        wraps = around >= 0 and around in out and tags[around][1] != "body"
        if tags[h][1] != "body" and (h == common or wraps):
            out.add(h)
    return out


def main_text(page: str | None, window: int = 3, surge: int = 80, share: int = 3) -> str:
    """The main text of one page; blocks joined by one newline."""
    if not page:
        return ""
    tags = _scan(page)
    parents: dict[int, int] = {}
    lines = _lines(page, tags, *_removed(page, tags, window, surge), window, parents)
    texts = [" ".join(_html.unescape("".join(x[0])).split()) if x[0] else "" for x in lines]
    size = [x[1] if t else 0 for x, t in zip(lines, texts)]
    n = len(size)
    border = [n] * n  # the next line of another article, or outside of it
    after = n
    for k in range(n - 1, -1, -1):
        if size[k]:
            border[k] = (n if after == n else
                         border[after] if lines[after][2] == lines[k][2] else after)
            after = k
    runs = []
    i = 0
    while i < n:
        if not size[i]:
            i += 1
            continue
        j, peak, edge = i, 0, border[i]
        while j < edge and (block := sum(size[j:min(j + window, edge)])) > 0:  # the dive point ends the run
            peak = max(peak, block)
            j += 1
        runs.append((peak, i, j))
        i = j
    least = max(surge, max((r[0] for r in runs), default=0) / share)
    kept = {r for r in runs if r[0] >= (1 if lines[r[1]][2] else least)} or set(
        [max(runs, key=lambda r: (r[0], -r[1]))] if runs else ())
    within = {lines[k][3] for _, i, j in kept for k in range(i, j) if texts[k]}
    inside = _inside(within, parents, tags)
    chosen = [k for r in runs for k in range(r[1], r[2])
              if texts[k] and (r in kept or lines[k][3] in inside)]
    if not chosen:
        return ""
    stay = set(chosen)
    return "\n".join(texts[k] for k in range(chosen[0], chosen[-1] + 1)
                     if k in stay or texts[k] and not size[k])


def extract_main_text(pages: DataFrame, key: str = "page_id", url: str = "url",
                      html: str = "html", window: int = 3, surge: int = 80,
                      share: int = 3) -> DataFrame:
    """(key, url, text, n_chars) for every row; nothing is shuffled."""

    def run(batches):
        for b in batches:
            texts = [main_text(x, window, surge, share) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=names)

    names = [key, url, "text", "n_chars"]
    kinds = dict(pages.dtypes)
    return pages.select(key, url, html).mapInArrow(
        run, f"`{key}` {kinds[key]}, `{url}` {kinds[url]}, text string, n_chars bigint")
