"""Main text of web pages from streamed parser events.

The standard library's parser is fed the page piece by piece.  Its events cut
the page into lines, one per block element, each with its text, the number of
tags inside and how much of it is link text.  The text-to-tag ratios of the
lines are smoothed by a Gaussian over neighbouring lines, and two-means
clustering of the smoothed values gives the threshold of content.  Lines of
elements that hold no article by their markup (menus, page headers, footers,
sidebars, notices, adverts, forms, comments, scripts) count as ratio 0 and are
never content.  A form is hidden if it has more controls than lines of text of
its own.  A class name hides an element if it names it (``sidebar``,
``comment-list``); a name that only mentions such a word (``has-sidebar``,
``comments-open``) does not hide an article, nor an element that holds more text
than the rest of the page.  Lines of links alone go if they lie below the
threshold, inside an article too.  If ``article`` and ``main`` elements hold most of the content
lines, all lines shown in those that hold any are the text, so a short
paragraph between long ones stays.  Else the text lies in the innermost
container that holds all content lines: everything from the first to the last
of them, and the lines beside them in the containers that hold them, so short
first and last paragraphs stay too.

Rules: null html is an empty page; a page without content gives the empty
text; broken or cut markup is read as far as it goes; references are decoded;
white space inside a block becomes one blank, blocks are joined by ``\\n``; a
repeated row is extracted again; an empty table gives an empty result; other
columns of the input are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEED = 1 << 16          # characters given to the parser at once
SIGMA = 1.0             # of the Gaussian, in lines
LINK_SHARE = 0.75       # a list line with at least this share of link text is a menu line
HOLDS = 0.6             # share of the content that article and main elements must hold to decide

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary
    table tbody td tfoot th thead tr ul caption""".split())
# elements whose text is never an article's
HIDDEN = frozenset("""head title script style noscript template nav footer aside button select textarea input iframe
    object svg canvas menu dialog datalist audio video""".split())
# start of one of these ends an open paragraph
SCOPE = frozenset("article aside body div footer form header html li main nav section table td th ul ol blockquote".split())
SAME = frozenset("li dt dd td th tr option p".split())
CHROME = re.compile(r"""ads?|advert\w*|sponsor\w*|promo\w*|banner|sidebar|side|menu|nav|navbar|navigation|
    breadcrumbs?|footer|foot|masthead|topbar|comments?|commentlist|respond|replies|disqus|share|sharing|social|
    cookies?|consent|gdpr|notice|notification|alert|newsletter|subscribe|signup|popup|modal|overlay|related|recommended|
    recommendations|widget|pagination|pager|login|search|toolbar|copyright|legal|disclaimer|skip|hidden|teaser""", re.X | re.I)
# words that say what kind of box it is, not what it holds
BOX = frozenset("""list section box area block wrapper wrap container bar panel content body item items text inner outer
    thread form top bottom left right main primary secondary left1 small large""".split())
# of an article's own class names only these hide it
APART = re.compile(r"comments?|teaser|related|promo\w*|sponsor\w*|advert\w*", re.I)
HEADER = re.compile("header", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar status".split())
# elements that divide a page; others (quotations, lists, sections) are parts of a text
CONTAINER = frozenset("article main body div td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTROLS = frozenset("button select textarea".split())
LABELS = frozenset("label legend option summary".split())
SKIPPED, CHROMY, SHOWN = 2, 1, 0
NAMED, MENTIONED = 2, 1     # how a class name speaks of an element that is no text


def _names(value: str, words: re.Pattern) -> int:
    """Whether some name in a class or id is made of such words (NAMED) or has one among others (MENTIONED)."""
    most = 0
    for token in value.split():
        parts = [p.rstrip("0123456789") for p in re.split(r"[_-]+", token) if p.rstrip("0123456789")]
        hits = [bool(words.fullmatch(p)) for p in parts]
        if any(hits):
            known = all(h or p.lower() in BOX for h, p in zip(hits, parts, strict=True))
            most = max(most, NAMED if known else MENTIONED)
    return most


class Lines(HTMLParser):
    """Collects the lines of a page; elements are rows of ``tags`` and ``parents``."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.state, self.own = ["#root"], [0], [SHOWN], [SHOWN]    # state: the worst of own and all around
        self.open = [0]
        self.mentioned: set[int] = set()    # elements hidden by a name that only mentions a word
        self.controls: list[int] = []       # the elements that hold a visible control
        self.links = self.articles = 0      # open elements
        self.lines: list[tuple[str, int, int, int]] = []     # text, tags, link characters, element
        self.text, self.n_tags, self.link_chars, self.at = [], 0, 0, 0

    def _flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                self.lines.append((text, self.n_tags, min(self.link_chars, len(text)), self.at))
        self.text, self.n_tags, self.link_chars = [], 0, 0

    def _close(self, at: int) -> None:
        for e in self.open[at:]:
            self.links -= self.tags[e] == "a"
            self.articles -= self.tags[e] in ("article", "main")
        del self.open[at:]

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self._flush()
            # a block ends an open paragraph, a list item the one before it
            for k in range(len(self.open) - 1, 0, -1):
                name = self.tags[self.open[k]]
                if name == "p" or (name == tag and tag in SAME):
                    self._close(k)
                    break
                if name in SCOPE and not (name == "li" and tag == "li"):
                    break
        elif tag == "br":
            self.text.append(" ")
        self.n_tags += 1
        if tag in CONTROLS or (tag == "input" and ("type", "hidden") not in attrs):
            self.controls.append(self.open[-1])
        if tag in VOID:
            return
        kind, only_mentioned = self._kind(tag, attrs)
        if only_mentioned:
            self.mentioned.add(len(self.tags))
        state = max(self.state[self.open[-1]], kind)
        self.tags.append(tag)
        self.parents.append(self.open[-1])
        self.state.append(state)
        self.own.append(kind)
        self.open.append(len(self.tags) - 1)
        self.links += tag == "a"
        self.articles += tag in ("article", "main")

    def _kind(self, tag, attrs) -> tuple[int, bool]:
        """State of an element, and whether it is hidden by a name that only mentions a word."""
        if tag in HIDDEN:
            return SKIPPED, False
        inside = self.articles > 0
        if tag == "header" and not inside:
            return SKIPPED, False
        named = 0
        for key, value in attrs:
            value = value or ""
            if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                return SKIPPED, False
            if key == "role" and value.lower() in ROLES:
                return SKIPPED, False
            if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return SKIPPED, False
            if key in ("class", "id"):
                if tag == "article":
                    named = max(named, NAMED if _names(value, APART) == NAMED else 0)
                elif tag not in ("html", "body", "main", *HEADINGS):
                    named = max(named, _names(value, CHROME), 0 if inside else _names(value, HEADER))
        return (CHROMY if named else SHOWN), named == MENTIONED

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self._flush()
        self.n_tags += 1
        for k in range(len(self.open) - 1, 0, -1):
            if self.tags[self.open[k]] == tag:
                self._close(k)
                break
            if self.tags[self.open[k]] in ("article", "main", "body") and tag not in ("body", "html", "article", "main"):
                break

    def handle_data(self, data):
        e = self.open[-1]
        if self.state[e] == SKIPPED:
            return
        if not self.text:
            self.at = e
        self.text.append(data)
        if self.links:
            self.link_chars += len(data.strip())

    def finish(self) -> None:
        self.close()
        self._flush()


def smooth(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing with the border lines repeated."""
    r = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return np.convolve(np.pad(values, r, mode="edge"), kernel / kernel.sum(), mode="valid")


def threshold(values: np.ndarray) -> float:
    """Border between the two clusters of one-dimensional two-means, started at the extremes."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        cut = (low + high) / 2
        a, b = values[values < cut], values[values >= cut]
        if not len(a) or not len(b):
            return cut
        if (low, high) == (new := (float(a.mean()), float(b.mean()))):
            break
        low, high = new
    return (low + high) / 2


def main_text(html: str | None) -> str:
    page = Lines()
    html = html or ""
    for s in range(0, len(html), FEED):
        page.feed(html[s:s + FEED])
    page.finish()
    lines = page.lines
    _hide_forms(page)
    _release(page)
    shown = [i for i, x in enumerate(lines) if page.state[x[3]] == SHOWN]
    if not shown:       # a page that is chrome by its class names alone: its text is all there is
        shown = [i for i, x in enumerate(lines) if page.state[x[3]] == CHROMY and _semantic(page, x[3])]
    if not shown:
        return ""
    ratio = np.zeros(len(lines))
    for i in shown:
        text, tags, links, _ = lines[i]
        ratio[i] = (len(text) - links) / (1 + tags)
    smoothed = smooth(np.log1p(ratio))
    cut = threshold(smoothed)
    content = [i for i in shown if smoothed[i] >= cut and ratio[i] > 0] or shown
    marked = _marked(page)
    held = [i for i in content if marked[lines[i][3]]]
    if sum(len(lines[i][0]) for i in held) >= HOLDS * sum(len(lines[i][0]) for i in content):
        # article or main: all that is shown in those below the element that holds their content
        tops = {marked[lines[i][3]] for i in held}
        holder = _common(page, [lines[i][3] for i in held])
        inner = holder
        while inner and page.tags[inner] not in ("article", "main"):
            inner = page.parents[inner]
        inside = _below(page, inner or holder)
        out = [i for i in shown if inside[lines[i][3]] and marked[lines[i][3]] in tops]
    else:               # no markup tells where the article ends
        container = _containers(page)
        holder = container[_common(page, [lines[i][3] for i in content])]
        inside, on_path = _below(page, holder), {holder}
        for i in content:
            e = lines[i][3]
            while e not in on_path:
                on_path.add(e)
                e = page.parents[e]
        # besides the lines from the first to the last content line, those of the containers that hold them
        out = [i for i in shown if inside[lines[i][3]]
               and (content[0] <= i <= content[-1] or container[lines[i][3]] in on_path)]
        lead = [i for i in shown if i < content[0] and inside[lines[i][3]] and page.tags[lines[i][3]] in HEADINGS]
        out = sorted({*lead[-1:], *out})
    return "\n".join(lines[i][0] for i in out if not _menu(page, lines[i], smoothed[i] < cut))


def _hide_forms(page: Lines) -> None:
    """Hides forms that hold no article or title and no more lines of text (labels and links apart) than controls."""
    if "form" not in page.tags:
        return
    form, label, kept = [0] * len(page.tags), [False] * len(page.tags), set()
    for e in range(1, len(page.tags)):
        form[e] = e if page.tags[e] == "form" else form[page.parents[e]]
        label[e] = page.tags[e] in LABELS or label[page.parents[e]]
        if page.tags[e] in ("article", "main", "h1"):
            kept.add(form[e])
    balance = dict.fromkeys(form, 0)
    for e in page.controls:
        balance[form[e]] -= 1
    for text, _, links, e in page.lines:
        if page.state[e] == SHOWN and not label[e] and links < LINK_SHARE * len(text):
            balance[form[e]] += 1
    kept |= {f for f, n in balance.items() if n > 0}
    for e in range(len(form) - 1, 0, -1):       # and the forms around them
        if page.tags[e] == "form" and e in kept:
            kept.add(form[page.parents[e]])
    for e in range(1, len(page.tags)):
        if page.tags[e] == "form" and e not in kept:
            page.own[e] = SKIPPED
        page.state[e] = max(page.state[page.parents[e]], page.own[e])


def _release(page: Lines) -> None:
    """Shows elements whose names only mention a hiding word if they hold more text than all that is shown, and no
    article outside holds a fair part of it (a fifth)."""
    if not page.mentioned:
        return
    n = len(page.tags)
    chars = [0] * n
    for text, _, links, e in page.lines:
        chars[e] += len(text) - links
    marked = _marked(page)
    shown = sum(c for e, c in enumerate(chars) if page.state[e] == SHOWN)
    article = sum(c for e, c in enumerate(chars) if page.state[e] == SHOWN and marked[e])
    for e in range(n - 1, 0, -1):       # inner elements first; what they show counts for those around them
        if e in page.mentioned and page.own[e] == CHROMY and chars[e] > shown and 5 * article < chars[e]:
            page.own[e] = SHOWN
        if page.own[e] == SHOWN:
            chars[page.parents[e]] += chars[e]
    for e in range(1, n):
        page.state[e] = max(page.state[page.parents[e]], page.own[e])


def _semantic(page: Lines, e: int) -> bool:
    while e:
        if page.tags[e] in ("article", "main"):
            return True
        e = page.parents[e]
    return False


def _menu(page: Lines, line: tuple[str, int, int, int], low: bool) -> bool:
    """A line of links: in a list or table, or anywhere but in a paragraph or heading if it is ``low``."""
    text, _, links, e = line
    if links < LINK_SHARE * len(text):
        return False
    if low and page.tags[e] == "a":
        e = page.parents[e]
    if low and page.tags[e] not in ("p", "#root", "body", *HEADINGS) and not any(page.tags[x] == "p" for x in _ancestors(page, e)):
        return True
    while e:
        if page.tags[e] in ("li", "ul", "ol", "td"):
            return True
        if page.tags[e] in ("p", "article", "main"):
            return False
        e = page.parents[e]
    return False


def _ancestors(page: Lines, e: int) -> Iterator[int]:
    while e:
        e = page.parents[e]
        yield e


def _marked(page: Lines) -> list[int]:
    """The outermost article or main around each element, 0 if there is none."""
    out = [0] * len(page.tags)
    for e in range(1, len(page.tags)):      # a child comes after its parent
        out[e] = out[page.parents[e]] or (e if page.tags[e] in ("article", "main") else 0)
    return out


def _below(page: Lines, top: int) -> np.ndarray:
    """Whether each element is ``top`` or inside it."""
    inside = np.zeros(len(page.tags), bool)
    inside[top] = True
    for e in range(top + 1, len(page.tags)):
        inside[e] = inside[page.parents[e]]
    return inside


def _common(page: Lines, elements: list[int]) -> int:
    """The innermost element that holds all of ``elements``."""
    held = np.bincount(elements, minlength=len(page.tags)).tolist()
    for e in range(len(held) - 1, 0, -1):
        held[page.parents[e]] += held[e]
    return max(e for e, n in enumerate(held) if n == len(elements))


def _containers(page: Lines) -> list[int]:
    """The innermost container around each element, or itself."""
    out = [0] * len(page.tags)
    for e in range(1, len(page.tags)):
        out[e] = e if page.tags[e] in CONTAINER else out[page.parents[e]]
    return out


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x.as_py()) for x in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
            names=["id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page; no shuffle, one page in memory at a time besides its batch."""
    return (pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
            .mapInArrow(_extracted, "id long, url string, text string, n_chars long"))
