"""Main text of HTML pages by block rules in two passes.

A page is cut into blocks at block-level tags. The first pass decides blocks from their containers, length, link
density and density of stop words; short blocks stay open. The second gives an open block the label of the nearest
decided neighbours. Forms and elements with the class or id of boilerplate are left out, unless they hold most of the
page's text. Everything happens inside one row, so pages are handled independently.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from vitaspan.llm.common import by_value

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset("""
the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one
you were all her she there would their we him been has when who will no if out so what up said about than into them
der die und von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach
wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein
le la les de des du un une et en que qui dans pour pas sur au avec ce il par plus ne se son est sont mais ou elle
el los las del y por con para una no su al lo como más pero sus este ya o fue ha sí porque esta son entre cuando muy
""".split())
#: Frequent function characters of Japanese, Chinese and Thai, which write without blanks.
STOP_CHARACTERS = frozenset("のにはをたがでてとしれさいるも的了是在不有和我这那个就他她你们也都而与之于以为等ที่และการในเป็นของ")
SKIPPED = frozenset("script style noscript template svg math iframe object canvas head title select option button "
                    "textarea fieldset audio video map datalist dialog".split())
BOILER_TAGS = frozenset("nav footer aside menu".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
#: Words in class or id names that mark what is not the article.
BOILER_NAMES = frozenset("""
nav navbar navigation menu sidebar side footer header masthead ad ads advert adverts advertisement adsense banner cookie
cookies consent gdpr notice notices alert popup modal overlay promo promotion sponsor sponsored share sharing social
comment comments reply replies respond disqus related recommended recommendations newsletter subscribe subscription
signup login breadcrumb breadcrumbs pagination pager widget toolbar copyright legal disclaimer skip search form tags
""".split())
#: Of these, names that inside an article only say where something stands.
PLACE_NAMES = frozenset("header masthead side banner overlay widget".split())
#: Of these, names of what readers wrote; it stays out however long it is.
READER_NAMES = frozenset("comment comments reply replies respond disqus".split())
MAIN_TAGS = frozenset(["article", "main"])
#: Tags that may stand in a head; any other one ends it.
HEAD_TAGS = frozenset("head base basefont bgsound link meta title noscript noframes style script template".split())
BLOCKS = frozenset("""
address article aside blockquote body caption center dd details div dl dt figcaption figure footer form h1 h2 h3 h4 h5
h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul
""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_NAME = re.compile(r"[A-Za-z]+")

#: Letters of scripts without blanks: Thai to Khmer, kana, Han.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff]")
#: Characters of an alphabet that one such letter stands for, and the same for the share of function characters.
DENSE = 2.5

SHORT, LONG = 70, 200
LINKS, FEW_STOPS, MANY_STOPS = 0.33, 0.10, 0.25


#: skipped, boilerplate, main, link, mark: of a place outside all elements.
NOTHING = (False, False, False, False, None)


class _Mark:
    """An element that looks like boilerplate by its class, id or tag; ``n`` counts the characters of its blocks."""

    __slots__ = ("outer", "form", "n", "dropped", "unseen")

    def __init__(self, outer: _Mark | None, form: bool = False):
        self.outer, self.form, self.n, self.dropped, self.unseen = outer, form, 0, True, False


class _Blocks(HTMLParser):
    """Collects (text, characters in links, is boilerplate, is inside the article, is a heading, is a list item, innermost mark)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, int, bool, bool, bool, bool, _Mark | None]] = []
        self.open: list[tuple[str, bool, bool, bool, bool, _Mark | None]] = []  # tag, skipped, boilerplate, main, link, mark
        self.marks: list[_Mark] = []
        self.parts: list[str] = []
        self.linked = 0
        self.state = NOTHING

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                heading = any(t[0] in ("h1", "h2", "h3", "h4", "h5", "h6") for t in self.open)
                item = any(t[0] in ("li", "dd", "dt") for t in self.open)
                self.found.append((text, self.linked, self.state[1], self.state[2], heading, item, self.state[4]))
                if self.state[4] and not self.state[1]:
                    self.state[4].n += len(text)
        self.parts, self.linked = [], 0

    def cut(self, k: int) -> None:
        """Close all elements from the k-th on."""
        del self.open[k:]
        self.state = self.open[-1][1:] if self.open else NOTHING

    def end_head(self) -> None:
        if self.open and self.open[-1][0] == "head":
            self.flush()
            self.cut(len(self.open) - 1)

    def handle_starttag(self, tag, attrs):
        if tag == "body":
            for k in range(len(self.open)):
                if self.open[k][0] == "head":
                    self.cut(k)
                    break
        elif tag not in HEAD_TAGS:
            self.end_head()
        if tag in BLOCKS:
            self.flush()
            ends = CLOSES.get(tag, ()) + (("p",) if tag != "html" else ())
            for k in range(len(self.open) - 1, -1, -1):
                t = self.open[k][0]
                if t in ends:
                    self.cut(k)
                    break
                if t in BLOCKS:
                    break
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        skipped, boiler, main, link, mark = self.state
        skipped = skipped or tag in SKIPPED
        if not skipped:
            if tag in BOILER_TAGS or tag == "header" and not main:
                boiler = True
            elif tag in MAIN_TAGS and not boiler:
                main = True
            if attrs and not boiler and tag not in ("html", "body"):
                given = dict(attrs)
                names = _NAME.findall(f"{given.get('class') or ''} {given.get('id') or ''}")
                named = {n.lower() for n in names} & BOILER_NAMES if not (main and tag in ("header", *MAIN_TAGS)) else set()
                named -= PLACE_NAMES if main else set()
                boiler = (bool(named & READER_NAMES) or (given.get("role") or "").lower() in BOILER_ROLES
                          or "hidden" in given or given.get("aria-hidden") == "true")
                main = main or (given.get("role") or "").lower() in MAIN_TAGS and not boiler
                if named and not boiler:
                    self.marks.append(mark := _Mark(mark))
            if tag == "form":
                self.marks.append(mark := _Mark(mark, True))
        self.open.append((tag, skipped, boiler, main, link or tag == "a", mark))
        self.state = self.open[-1][1:]

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        else:
            # a slash closes no element of HTML, but those of other markup
            self.handle_starttag(tag, attrs)
            if tag in ("svg", "math"):
                self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush()
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self.cut(k)
                return

    def handle_data(self, data):
        if data.strip():
            self.end_head()
        skipped, _, _, link, _ = self.state
        if not skipped:
            self.parts.append(data)
            if link:
                self.linked += len(data.strip())


def _blocks(parser: _Blocks) -> list[tuple[str, int, bool, bool, bool, bool]]:
    """The blocks, boilerplate if a mark holds; a mark does not hold on more than half of the text that is no other boilerplate."""
    for m in reversed(parser.marks):
        if m.outer:
            m.outer.n += m.n
    total = sum(len(b[0]) for b in parser.found if not b[2])
    for m in parser.marks:
        m.dropped = 2 * m.n <= total or m.outer is not None and m.outer.dropped
        # neighbours are not judged by what a form says
        m.unseen = m.dropped and (m.form or m.outer is not None and m.outer.unseen)
    return [(text, linked, boiler or mark is not None and mark.dropped, main, heading, item)
            for text, linked, boiler, main, heading, item, mark in parser.found if mark is None or not mark.unseen]


def _measure(text: str) -> tuple[float, float]:
    """Length of a text and share of stop words in it; scripts without blanks are measured by characters."""
    unspaced = len(_UNSPACED.findall(text))
    if 3 * unspaced > len(text):
        return len(text) + (DENSE - 1) * unspaced, DENSE * sum(c in STOP_CHARACTERS for c in text) / len(text)
    words = text.lower().split()
    return len(text), sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) / len(words)


def _first_pass(block: tuple[str, int, bool, bool, bool, bool], has_main: bool) -> bool | None:
    """True: text of the article; False: not; None: open. Inside an article, what no container marks is its text."""
    text, linked, boiler, main, heading, _ = block
    if boiler or has_main and not main:
        return False
    if main:
        return None if heading or len(text) < SHORT else True
    if linked > LINKS * len(text):
        return False
    length, stops = _measure(text)
    if heading or length < SHORT:
        return None
    if stops >= MANY_STOPS or length >= LONG and stops >= FEW_STOPS:
        return True
    return None if length < LONG and stops >= FEW_STOPS else False


def _without_menus(blocks: list[tuple[str, int, bool, bool, bool, bool]]) -> list[tuple[str, int, bool, bool, bool, bool]]:
    """Three or more list items in a row that are nothing but links are a menu, also inside an article: boilerplate."""
    out, run = list(blocks), []
    for i, (text, linked, _, _, heading, item) in enumerate([*blocks, ("", 0, False, False, False, False)]):
        if item and not heading and linked >= 0.9 * len(text.replace(" ", "")):
            run.append(i)
            continue
        if len(run) >= 3:
            for k in run:
                out[k] = (*blocks[k][:2], True, *blocks[k][3:])
        run = []
    return out


def main_text(html: str | None) -> str:
    """The article of a page as one line; NULL or no article: empty.

    If no block is decided to be text, all that no container marks and that is not mostly links is taken.
    """
    if not html:
        return ""
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    blocks = _without_menus(_blocks(parser))
    has_main = any(b[3] and not b[2] for b in blocks)
    labels = [_first_pass(b, has_main) for b in blocks]
    n = len(labels)
    before, last = [None] * n, None
    for i in range(n):
        if labels[i] is not None:
            last = i
        before[i] = last
    after, last = [None] * n, None
    for i in range(n - 1, -1, -1):
        if labels[i] is not None:
            last = i
        after[i] = last
    kept = []
    for i, (text, _, _, main, heading, _) in enumerate(blocks):
        label = labels[i]
        if label is None:
            p, q = before[i], after[i]
            if main:
                # inside the article only its own text decides; a short article has nothing else
                near = [labels[k] for k in (p, q) if k is not None and blocks[k][3] and not blocks[k][2]]
                label = any(near) or not near
            elif p is None or q is None:
                k = q if p is None else p
                label = k is not None and labels[k]
            elif labels[p] == labels[q]:
                label = labels[p]
            elif heading:
                label = labels[q]
            else:
                label = labels[p] if i - p < q - i else labels[q] if q - i < i - p else False
        if label:
            kept.append(text)
    if not kept:
        kept = [text for text, linked, boiler, main, heading, _ in blocks
                if not boiler and main >= has_main and (heading or linked <= LINKS * len(text))]
    return " ".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``; repeated rows are repeated, other columns are ignored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


by_value(__name__)
