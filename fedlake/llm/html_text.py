"""HTML extraction by line-block distribution.

Markup is stripped into lines, one per block-level element. The weight of a line is its text length; lines
of page furniture (menus, forms, adverts, comments ...) weigh nothing. Weights are summed over sliding windows of
WINDOW lines; text begins where the sums first surge above a threshold, and from there all lines are kept but those of a
dive: WINDOW lines or more without weight, as lists of links are. Furniture removed after the beginning is no dive. If the
page marks its article, only lines in it weigh anything and any weight is a surge.
"""

from __future__ import annotations

import html as _html
import re
from bisect import bisect
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
#: Sum of a window at which text begins on a page without an article element.
SURGE = 80
#: Share of a line's text in links from which only what is beside them weighs, on such a page.
LINKS = 0.5
FLUSH_CHARS = 4 << 20

# Fixed values of HTML and of common naming.
_BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td tfoot th thead title tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_FURNITURE = frozenset("aside button datalist dialog fieldset footer form head header iframe menu nav object search select".split())
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
_NAMES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo "
    "recommended related reply replies search share sharing sidebar signup social sponsor sponsored subscribe toolbar "
    "widget widgets".split())
_QUALIFIERS = frozenset("with has no without".split())
#: Names that text elements often have, too.
_LOOSE = frozenset("banner header menu modal notice notices recommended related reply search social widget widgets".split())
#: Elements whose classes and ids name a part of the page; those of others name a part of its text.
_CONTAINERS = frozenset(
    "address article aside center details dialog div dl figure footer form header hgroup main menu nav ol search section "
    "table tbody tfoot thead tr ul".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Names that wrappers of a whole page often have, too.
_LAYOUT = frozenset(
    "banner cookie cookies footer header login masthead menu modal nav navbar navigation notice notices search sidebar toolbar "
    "widget widgets".split())
_ARTICLES = frozenset(("article", "main"))
#: Names of article elements that are not the page's article, and words that may stand beside them.
_OTHER_ARTICLES = frozenset(
    "ad ads advert advertisement adverts comment comments promo recommended related reply replies teaser teasers".split())
_BESIDE = frozenset(
    "article block body box c card child content default div entry featured inner item large li list m mode nested node o parent post "
    "reader small summary thread type user view wrapper".split())
# End tags that HTML lets authors leave out: elements that a start tag ends if they are the innermost open.
_ENDS_P = _BLOCKS - frozenset("body br button caption html legend optgroup option select title".split())
_ROWS = frozenset("caption tbody td tfoot th thead tr".split())
_IMPLIED_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "optgroup": {"option", "optgroup"}, "td": {"td", "th"},
    "th": {"td", "th"}, "tr": {"td", "th", "tr"}, "tbody": _ROWS, "tfoot": _ROWS, "thead": _ROWS}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|svg|canvas|title)\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>"
    r"|<[a-z/!?][^>]*(?:>|\Z)", re.I | re.S)
# every attribute with its value, so that no value is read as a name
_ATTR = re.compile(r"""([^\s"'/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"']+))?|"[^"]*"|'[^']*'""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


def _names_furniture(label: str, container: bool, inside: bool, but: frozenset[str]) -> bool:
    """Whether one class or id of an element, in an article or not, names furniture."""
    words = [w.lower() for w in _WORD.findall(label)]
    named = {w for i, w in enumerate(words) if w in _NAMES and w not in but and not (i and words[i - 1] in _QUALIFIERS)}
    if container:
        return bool(named - {"header"} if inside else named)  # a header in an article is the article's
    if inside and not all(w in named or w.isdigit() for w in words):
        return False
    return bool(named - _LOOSE)


def _names_other_article(label: str) -> bool:
    """Whether one class or id of an article element says that it is a comment, teaser or the like."""
    words = [w.lower() for w in _WORD.findall(label)]
    return any(w in _OTHER_ARTICLES for w in words) and all(w in _OTHER_ARTICLES or w in _BESIDE or w.isdigit() for w in words)


def _is_furniture(name: str, attrs: str, inside: bool) -> bool:
    """Whether an element is furniture by its tag or attributes, ``inside`` an article or not."""
    return name in _FURNITURE and not (inside and name == "header") or _says_furniture(name, attrs, inside)


def _says_furniture(name: str, attrs: str, inside: bool, but: frozenset[str] = frozenset()) -> bool:
    """Whether attributes say that an element is furniture, by other names than those of ``but``."""
    if not attrs or attrs.isspace() or name in ("html", "body", "main"):
        return False
    if name == "article":
        return any(_names_other_article(label) for m in _ATTR.finditer(attrs) if (m[1] or "").lower() in ("class", "id")
                   for label in (m[2] or "").strip("\"'").split())
    for m in _ATTR.finditer(attrs):
        key, value = (m[1] or "").lower(), (m[2] or "").strip("\"'")
        if key == "role":
            if value.lower() in _ROLES:
                return True
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        elif key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
        elif key == "class" or (key == "id" and not (inside and name in _HEADINGS)):  # ids of headings are made of their text
            if any(_names_furniture(label, name in _CONTAINERS, inside, but) for label in value.split()):
                return True
    return False


def _ends(tags: list[tuple[str, bool]]) -> list[tuple[int, bool]]:
    """Of each start tag among (name, whether an end tag), the number of the tag that ends its element, and whether it is its own end tag.

    An end tag ends what is still open in its element, too. Elements that are open at the end have the number of tags.
    """
    ends = [(len(tags), False)] * len(tags)
    blocks: list[tuple[str, int]] = []
    opened: Counter[str] = Counter()
    inline: defaultdict[str, list[int]] = defaultdict(list)
    parents: dict[int, int] = {}

    def end(k: int, own: bool = False) -> None:
        name, i = blocks.pop()
        opened[name] -= 1
        ends[i] = (k, own)

    for k, (name, closing) in enumerate(tags):
        if not name or (name in _VOID and name != "hr"):
            continue
        if name not in _BLOCKS and name not in _FURNITURE:
            if not closing:
                inline[name].append(k)
                if blocks:
                    parents[k] = blocks[-1][1]
            elif inline[name]:
                ends[inline[name].pop()] = (k, True)
        elif closing:
            if opened[name]:
                while blocks[-1][0] != name:
                    end(k)
                end(k, True)
        else:
            if blocks and (blocks[-1][0] == "p" and name in _ENDS_P or blocks[-1][0] == "head" and name in _BLOCKS):
                end(k)
            while blocks and blocks[-1][0] in _IMPLIED_ENDS.get(name, ()):
                end(k)
            if name != "hr":
                blocks.append((name, k))
                opened[name] += 1
    for k, i in parents.items():
        if ends[i][0] < ends[k][0]:
            ends[k] = (ends[i][0], False)
    return ends


def lines(html: str, wrappers: bool = False) -> tuple[list[tuple[str, int, bool]], bool, bool]:
    """Lines of a page, as (text, weight, in an article), whether it marks an article, and whether one may be in a wrapper.

    An empty text stands for furniture. The weight is the text's length; for a line of links, the number of letters and
    digits beside them. Character references are decoded, white space is one space.

    Articles in furniture are left out with it, unless it has no end tag. A form that holds an article, and an element named as
    furniture that holds the page's main element, are none. An element that has an article and a name of layout may be a
    wrapper of the page: with ``wrappers`` it is no furniture.
    """
    out: list[tuple[str, int, bool]] = []
    words: list[str] = []
    in_link: list[str] = []
    state = {"articles": 0, "links": 0}
    marked, wrapped, at = False, False, 0
    tags = list(_TAG.finditer(html))
    names = [((m["name"] or "").lower(), bool(m["close"])) for m in tags]
    ends = _ends(names)
    articles = [k for k, (name, closing) in enumerate(names) if name in _ARTICLES and not closing]
    skip, own = -1, False  # the tag at which furniture ends, and whether it belongs to it

    def text(part: str) -> None:
        if part:
            part = _html.unescape(part)
            words.append(part)
            if state["links"]:
                in_link.append(part.strip())

    def end_line() -> None:
        joined = " ".join("".join(words).split())
        if joined:
            weight = len(joined)
            if sum(map(len, in_link)) >= LINKS * weight:
                weight = sum(map(str.isalnum, joined)) - sum(map(str.isalnum, "".join(in_link)))
            out.append((joined, weight, state["articles"] > 0))
        words.clear()
        in_link.clear()

    for k, m in enumerate(tags):
        if k < skip:
            continue
        if k > skip:
            text(html[at:m.start()])
        at = m.end()
        name, closing = names[k]
        if not name or (k == skip and own):
            continue
        if name in _BLOCKS:
            end_line()
        if closing:
            if name in _ARTICLES:
                state["articles"] = max(0, state["articles"] - 1)
            elif name == "a":
                state["links"] = 0
            continue
        if name == "a":
            state["links"] = 1
            continue
        inside = state["articles"] > 0
        if name not in _VOID and _is_furniture(name, m["attrs"], inside):
            to, closed = ends[k]
            first = bisect(articles, k)
            if not closed and first < len(articles):
                to = min(to, articles[first])
            held = articles[first:bisect(articles, to)]
            wrapper = False
            if closed and held and (name == "form" or name not in _FURNITURE) and name != "article":
                if name == "form":
                    wrapper = not _says_furniture(name, m["attrs"], inside)
                wrapper = wrapper or any(names[i][0] == "main" for i in held)
                if not wrapper and not _says_furniture(name, m["attrs"], inside, _LAYOUT):
                    wrapped, wrapper = True, wrappers
            if not wrapper:
                end_line()
                skip, own = to, closed
                out.extend([("", 0, False)] * WINDOW)
                continue
        if name in _ARTICLES:
            state["articles"] += 1
            marked = True
    if skip < len(tags):
        text(html[at:])
    end_line()
    return out, marked and any(a and t for t, _, a in out), wrapped


def main_text(html: str) -> str:
    """The main text of a page; empty if it has none."""
    found, marked, wrapped = lines(html)
    if wrapped and not marked:
        # no article but in an element named as furniture: a wrapper of the page if it has more text than the rest
        return max(_main_text(found, marked), _main_text(*lines(html, True)[:2]), key=len)
    return _main_text(found, marked)


def _main_text(found: list[tuple[str, int, bool]], marked: bool) -> str:
    """The main text among a page's lines."""
    if marked:
        return " ".join(t for t, _, inside in found if inside and t)
    weights = [w for _, w, _ in found]
    sums = [sum(weights[i:i + WINDOW]) for i in range(len(weights))]
    # if no window of a short page is a surge, its text begins with its first line
    surge = SURGE if max(sums, default=0) >= SURGE else 1
    for start, (t, weight, _) in enumerate(found):
        # surge: the window that begins here is high enough, and this line is not of links or has its share of it
        if weight and sums[start] >= surge and (weight == len(t) or weight * WINDOW >= surge):
            break
    else:
        return ""
    kept: list[str] = []
    gap: list[str] = []
    for t, weight, _ in found[start:]:
        if weight:
            # dive: a whole window of lines without weight; removed elements are none
            if len(gap) < WINDOW:
                kept.extend(gap)
            kept.append(t)
            gap = []
        elif t:
            gap.append(t)
    return " ".join(kept)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """(id_col, *keep, text, n_chars) of every page, one row per input row, from the whole html.

    Null and empty html give an empty text; null ids and urls stay; repeated pages are extracted each. Other
    columns are left out. An empty table gives no rows.
    """
    rows = pages.select(F.col(id_col), *keep, F.coalesce(F.col(html_col), F.lit("")).alias("_html"))
    at_html = len(keep) + 1

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            start, size, texts = 0, 0, []
            for i, page in enumerate(batch.column(at_html)):
                page = page.as_py()
                texts.append(main_text(page))
                size += len(page)
                if size >= FLUSH_CHARS or i == batch.num_rows - 1:
                    part = batch.slice(start, len(texts))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns[:at_html], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                        names=[id_col, *keep, "text", "n_chars"])
                    start, size, texts = i + 1, 0, []

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:at_html])
    return rows.mapInArrow(run, f"{fields}, text string, n_chars long")
