"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. Each block knows its text, its letters inside links, the share of
stop words of the page's likeliest language, whether it stands in an article or main element, and whether an element
around it is of a kind or carries a class, id or role that marks boilerplate (menus, headers, footers, sidebars,
notices, adverts, forms, comments). A class, id or role says less than a kind of element, so the mark of a wrapper (and
of a form around the page) is void when the wrapper holds a main element or the page's largest article, or, in an
article or on a page without one, more than half of the text there, little of it linked. Marks of reader comments
are void only around a main element or the page's single article.

Pass one, each block alone: boilerplate marks or a high link density make it bad. Inside an article, a block of at
least SHORT letters is good. Elsewhere long blocks with many stop words are good, those with few are bad, middling ones
follow their stop-word density. Where most letters of the page are of scripts without a list of stop words, length and
links alone decide; an ideograph or kana counts as three letters. Short blocks stay undecided. Pass two: undecided blocks take the label of the nearest
decided block (of the same article, if they are in one); of two equally near, good wins inside an article and bad
outside. Undecided blocks of an article without any decided block are good.

Character references are decoded, white space inside a block becomes one space. A null or empty page has an empty text.
Broken, unclosed and truncated markup is read as far as it goes: a tag without its end is dropped. Rows are judged one by one: repeated
rows get equal results, an empty table an empty one. Other columns are not read. Pages are used whole.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

from threadloom.llm.common import map_rows

SHORT = 70  # letters
LONG = 200
LINKS = 0.5
LINKS_IN_ARTICLE = 0.8
STOP_LOW, STOP_HIGH = 0.15, 0.30

_BLOCKS = frozenset(
    "address article aside blockquote body br caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frame"
    " frameset h1 h2 h3 h4 h5 h6 head header hr html iframe legend li link main menu meta nav noframes noscript object ol optgroup option p pre"
    " section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN = frozenset("script style template svg annotation annotation-xml head title noscript iframe object canvas audio video textarea select button datalist".split())
_RAW = frozenset("script style textarea title".split())
_BOILERPLATE = frozenset("nav header footer aside menu dialog fieldset label legend input option optgroup".split())
_ARTICLE = frozenset(("article", "main"))
# Elements whose end tags may be missing: a new one of the same group ends the one before.
_ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_MARKS = frozenset(
    "ad ads adv advert advertisement advertising adbox adsense banner sponsor sponsored promo promotion comment comments reply replies respond disqus"
    " sidebar side-bar rail widget related recommended nav navbar navigation menu breadcrumb breadcrumbs pagination pager header masthead topbar footer"
    " foot bottom copyright legal cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login share sharing"
    " social toolbar tags skip-link complementary contentinfo search".split()
)
_READERS = frozenset("comment comments reply replies respond disqus".split())
_WHOLE = frozenset("alert bottom foot legal rail search".split())  # marks as a word of their own only, not as in article-bottom
_NO_MARK, _MARK, _READER, _UNSEEN = range(4)

# Common function words by language.
STOP_WORDS = {
    "en": "a an and are as at be been but by for from had has have he her his i in is it its not of on or she that the their they this to was we were which with you".split(),
    "de": "aber als am an auch auf aus bei das dass dem den der des die ein eine einem einen einer er es für hat ich im in ist mit nicht oder sich sie sind und von war werden wie zu zum zur".split(),
    "fr": "au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qu que qui sa se ses son sont sur un une vous".split(),
    "it": "a al alla anche che come con da dal dei del della di e è gli ha i il in la le lo ma nel nella non per più se si sono su un una".split(),
    "nl": "aan als bij dat de die dit door een en er heeft het hij in is je maar met naar niet nog of om ook op te tot uit van voor was wordt zich zijn".split(),
    "pt": "a ao as com como da das de do dos e é em está foi mais mas não na nas no nos o os ou para pela pelo por que se sem seu sua um uma".split(),
    "es": "a al como con de del el ella en es esta este fue ha hay la las lo los más mi no o para pero por que se si sin sobre son su sus un una y ya".split(),
}
_STOPS = {k: frozenset(v) for k, v in STOP_WORDS.items()}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORDS = re.compile(r"[^\W\d_]+")
_PARTS = re.compile(r"[\s_]+")
_SPACE = re.compile(r"\s+")
_LATIN = re.compile(r"[A-Za-z\u00AA-\u024F\u1E00-\u1EFF]")
_IDEOGRAPHS = re.compile(r"[\u3041-\u30FF\u3400-\u9FFF\uF900-\uFAFF\U00020000-\U0003FFFF]")


@dataclass
class Block:
    text: str
    linked: int  # letters inside links
    boilerplate: bool
    article: int  # number of the article around it, 0 for none


def _mark(attributes: str, inside: bool) -> int:
    """What class, id, role and attributes that hide an element say about it; inside: it stands in an article."""
    found = _NO_MARK
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return _UNSEEN
        if name in ("class", "id", "role"):
            for part in _PARTS.split(value):
                pieces = part.split("-")
                words = {part} | {pieces[0], pieces[-1]} - _WHOLE
                if inside:
                    words.discard("header")
                found = max(found, _READER if words & _READERS else _MARK if words & _MARKS else _NO_MARK)
    return found


@dataclass
class Mark:
    """An element with a mark, and the text in it that is not boilerplate by the kind of an element."""

    parent: int  # the marked element around it, -1 for none
    readers: bool
    article: int
    letters: int = 0
    linked: int = 0
    void: bool = False


def _void_around(marks: list[Mark], at: int, readers: bool) -> None:
    """Void the marks from `at` outwards; beyond one that is void already for readers' marks, all are."""
    while at >= 0 and not (readers and marks[at].void):
        marks[at].void |= readers or not marks[at].readers
        at = marks[at].parent


def _judge_marks(blocks: list[Block], marks: list[Mark], within: list[int], around: dict[int, int], main: bool) -> None:
    """Make the blocks within marks that hold boilerplate; around: the mark in which each outermost article begins."""
    letters: dict[int, int] = {}
    for block, at in zip(blocks, within):
        if not block.boilerplate:
            size = _letters(block.text)
            letters[block.article] = letters.get(block.article, 0) + size
            if at >= 0:
                marks[at].letters += size
                marks[at].linked += block.linked
    for mark in reversed(marks):
        if mark.parent >= 0:
            marks[mark.parent].letters += mark.letters
            marks[mark.parent].linked += mark.linked
    articles = {k: n for k, n in letters.items() if k}
    if articles and not main:
        largest = max(articles, key=lambda k: (articles[k], -k))
        _void_around(marks, around[largest], len(articles) == 1)
    for mark in marks:
        share = letters.get(mark.article, 0) if mark.article or not articles else None
        if share is not None and not mark.readers:
            mark.void |= 2 * mark.letters > share and mark.linked <= LINKS * mark.letters
    bad: list[bool] = []
    for mark in marks:
        bad.append(not mark.void or mark.parent >= 0 and bad[mark.parent])
    for block, at in zip(blocks, within):
        block.boilerplate |= at >= 0 and bad[at]


def _letters(text: str) -> int:
    return len(text.replace(" ", ""))


def blocks_of(page: str | None) -> list[Block]:
    """Blocks with text, in page order."""
    blocks: list[Block] = []
    page = page or ""
    open_tags: list[tuple[str, bool, int, int]] = []  # name, boilerplate from here on, article, innermost mark
    marks: list[Mark] = []
    within: list[int] = []  # innermost mark of each block
    around: dict[int, int] = {}
    main = False
    parts: list[tuple[str, bool]] = []
    hidden = links = articles = 0
    boilerplate, article, mark = False, 0, -1

    def flush():
        text = _SPACE.sub(" ", html.unescape("".join(p for p, _ in parts))).strip()
        if text:
            linked = len(_SPACE.sub("", html.unescape("".join(p for p, in_link in parts if in_link))))
            blocks.append(Block(text, linked, boilerplate, article))
            within.append(mark)
        parts.clear()

    def state():
        return open_tags[-1][1:] if open_tags else (False, 0, -1)

    at, end = 0, len(page)
    while at < end:
        found = _TOKEN.search(page, at)
        stop = found.start() if found else end
        if stop > at and not hidden:
            parts.append((page[at:stop], links > 0))
        if not found:
            break
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if name in _BLOCKS or name in _HIDDEN:
            flush()
        if found[1]:
            depth = next((i for i in range(len(open_tags) - 1, -1, -1) if open_tags[i][0] == name), -1)
            if depth >= 0:
                for gone, *_ in open_tags[depth:]:
                    hidden -= gone in _HIDDEN
                    links -= gone == "a"
                del open_tags[depth:]
                boilerplate, article, mark = state()
            continue
        if name in _ENDS and open_tags and open_tags[-1][0] in _ENDS[name]:
            open_tags.pop()
            boilerplate, article, mark = state()
        attributes = found[3] or ""
        if name in _VOID or attributes.endswith("/") and name not in _BLOCKS and name not in _HIDDEN:
            continue
        kind = _mark(attributes, bool(article))
        if name in _ARTICLE:
            articles += 1
            around.setdefault(articles, mark)
            if name == "main":
                main = True
                _void_around(marks, mark, True)
            # An article in another one may be a comment of it; other marks of an article are of what it holds.
            kind = kind if kind == _READER and article and name == "article" else _NO_MARK
        elif name in ("body", "html"):
            kind = _NO_MARK
        inside = article or (articles if name in _ARTICLE else 0)
        hard = boilerplate or kind == _UNSEEN or name in _BOILERPLATE and not (name == "header" and inside)
        if not hard and (kind or name == "form"):
            marks.append(Mark(mark, kind == _READER, article))
            mark = len(marks) - 1
        open_tags.append((name, hard, inside, mark))
        boilerplate, article = hard, inside
        hidden += name in _HIDDEN
        links += name == "a"
        if name in _RAW:
            close = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.start() if close else end
    flush()
    _judge_marks(blocks, marks, within, around, main)
    return blocks


def classify(blocks: list[Block]) -> list[bool]:
    """Whether each block is main text."""
    words: list[list[str]] = []

    def density(i: int) -> float:
        """Share of stop words of the page's likeliest language; counted only where the rules ask for it."""
        if not words:
            words.extend([w.lower() for w in _WORDS.findall(b.text)] for b in blocks)
            totals = {lang: sum(w in stops for ws in words for w in ws) for lang, stops in _STOPS.items()}
            words.append([max(totals, key=lambda lang: (totals[lang], lang))])
        stops, own = _STOPS[words[-1][0]], words[i]
        return sum(w in stops for w in own) / len(own) if own else 0.0

    foreign = None  # whether the page is of a script without stop words, asked only where a block depends on it

    def of_other_script() -> bool:
        text = "".join("".join(_WORDS.findall(b.text)) for b in blocks)
        return 2 * len(_LATIN.findall(text)) < len(text)

    first: list[bool | None] = []
    for i, block in enumerate(blocks):
        letters = _letters(block.text)
        links = block.linked / letters
        if letters < LONG:
            letters += 2 * len(_IDEOGRAPHS.findall(block.text))
        if block.boilerplate or links > (LINKS_IN_ARTICLE if block.article else LINKS):
            first.append(False)
        elif letters < SHORT:
            first.append(None)
        elif block.article:
            first.append(True)
        elif foreign or foreign is None and (foreign := of_other_script()):
            first.append(True)
        elif letters >= LONG:
            first.append(density(i) >= STOP_LOW)
        else:
            first.append(density(i) >= STOP_HIGH)
    # Marked boilerplate within an article says nothing about its neighbours there.
    return _inherit(first, [-1 if b.article and b.boilerplate else b.article for b in blocks])


def _inherit(first: list[bool | None], articles: list[int]) -> list[bool]:
    """Undecided blocks take the label of the nearest decided one of their article, or of the page outside articles."""
    n = len(first)

    def nearest(order) -> list[tuple[int, bool] | None]:
        last: dict[int, tuple[int, bool]] = {}
        found: list[tuple[int, bool] | None] = [None] * n
        for i in order:
            found[i] = last.get(articles[i])
            if first[i] is not None:
                last[articles[i]] = (i, first[i])
        return found

    before, after = nearest(range(n)), nearest(range(n - 1, -1, -1))
    out = []
    for i, label in enumerate(first):
        if label is None:
            sides = [(abs(x[0] - i), x[1]) for x in (before[i], after[i]) if x]
            closest = [good for distance, good in sides if distance == min(d for d, _ in sides)]
            label = (any(closest) if articles[i] else all(closest)) if closest else bool(articles[i])
        out.append(label)
    return out


def main_text(page: str | None) -> str:
    blocks = blocks_of(page)
    return "\n".join(b.text for b, good in zip(blocks, classify(blocks)) if good)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, carried columns, text, n_blocks, n_good) per page."""

    def run(rows):
        for key, *rest, page in rows:
            blocks = blocks_of(page)
            good = [b.text for b, is_good in zip(blocks, classify(blocks)) if is_good]
            yield key, *rest, "\n".join(good), len(blocks), len(good)

    columns = [id_col, *carry]
    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in columns)
    return map_rows(pages.select(*columns, html_col), run, f"{kinds}, text string, n_blocks int, n_good int", rows=500)
