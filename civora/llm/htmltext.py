"""Main-text extraction by consensus of a host's pages.

1. Every page is parsed once; its containers are scored by the prose they hold
   (a block's characters without its link text, halved on the way up).
2. A page votes for the generalised tag-class path of its best container.
   Votes are counted per host and path in Spark with partial sums, so a host
   with a third of all pages is no hot key.
   The best container is widened first: to the article around it, or while
   what a parent adds is prose too, so headings, leads and sibling parts stay.
3. A host's winning paths go back to its pages, which are extracted again from
   the containers under those paths.

Menus, headers, footers, sidebars, notices, adverts, forms, comments and code
are left out of scoring and of the extracted text alike.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civora.llm.common import record_batch, shared_table

#: A path wins if it has at least this share of its host's votes: at most 20 paths a host.
SHARE = 0.05

#: A path is generalised to its last steps, however deep a page nests.
_DEPTH = 24

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|"
    r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in
        ("script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes", "plaintext")}
_ATTR = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CONTAINER = frozenset("html body div article main section td center form".split())
_BLOCK = _CONTAINER | frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr th thead tbody tfoot caption blockquote pre address figure "
    "figcaption details summary fieldset legend header footer nav aside menu hgroup hr dialog option search".split())
_OUT = frozenset("head nav footer aside form script style noscript template button select textarea iframe svg math "
                 "object canvas audio video menu dialog search title input label fieldset datalist xmp".split())
_OUT_ROLE = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar "
                      "toolbar".split())
_OUT_NAME = frozenset(
    "nav navbar navigation menu menus submenu sidebar sidebars footer footers masthead ad ads adv advert adverts "
    "advertisement advertising sponsor sponsored sponsors promo promotion promos banner banners cookie cookies consent "
    "gdpr notice notices alert alerts popup modal overlay comment comments commentlist disqus reply replies respond "
    "share sharing sharebar social related recommended recommendations newsletter subscribe subscription signup login "
    "search searchbox breadcrumb breadcrumbs pagination pager widget widgets toolbar skip discussion".split())
_HEADER_NAME = frozenset("header headers".split())
_NEGATED = frozenset("has with no without is".split())
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_CLOSES = {t: frozenset(c.split()) for t, c in {  # a start tag ends these open elements
    "li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th",
    "option": "option", "thead": "tr td th", "tbody": "tr td th thead", "tfoot": "tr td th tbody"}.items()}
_SCOPE = frozenset("ul ol dl table div article section body td".split())


def _unwanted(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in _OUT or (tag == "header" and not in_article):
        return True
    if not attrs or tag in ("html", "body"):
        return False
    for m in _ATTR.finditer(attrs):
        name, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        if name in ("class", "id"):
            for word in value.split():
                t = [x.lower() for x in _TOKEN.findall(word)]
                t = t[:-1] if len(t) > 1 and t[-1].isdigit() else t
                if t and t[0] not in _NEGATED and (
                        t[0] in _OUT_NAME or t[-1] in _OUT_NAME
                        or not in_article and (t[0] in _HEADER_NAME or t[-1] in _HEADER_NAME)):
                    return True
        elif name == "role" and value.lower() in _OUT_ROLE:
            return True
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        elif name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
    return False


def _step(tag: str, attrs: str) -> str:
    """Tag with its classes, digits generalised, order ignored."""
    for m in _ATTR.finditer(attrs or ""):
        if m.group(1).lower() == "class":
            value = m.group(2) or m.group(3) or m.group(4) or ""
            return ".".join([tag, *sorted({re.sub(r"\d+", "#", x) for x in value.split()})])
    return tag


def _element_ends(html: str, tag: str) -> dict[int, int]:
    """End of every element of an inline tag by its start; nested elements match from the inside."""
    open_at, out = [], {}
    for m in re.finditer(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*>", html, re.I):
        if not m.group(1):
            open_at.append(m.start())
        elif open_at:
            out[open_at.pop()] = m.end()
    return out


class Page:
    """Containers and text blocks of one page, in page order."""

    def __init__(self, html: str):
        self.paths, self.parents, self.steps = ["body"], [-1], [("body",)]
        self.blocks: list[tuple[int, str, int]] = []  # container, text, characters in links
        self._read(html)
        self.tops = self._widen()

    def _read(self, html: str) -> None:
        stack: list[tuple[str, int, bool, bool]] = []  # tag, container, unwanted, inside an article
        here, out, article = 0, False, False
        text: list[str] = []
        link = 0  # open links
        linked = 0

        def add(raw: str):
            nonlocal linked
            if raw and not out:
                text.append(raw)
                if link:
                    linked += len(raw)

        def flush():
            nonlocal linked
            if text:
                words = unescape("".join(text)).split()
                if words:
                    self.blocks.append((here, " ".join(words), linked))
                text.clear()
            linked = 0

        def pop(n: int):
            nonlocal here, out, article
            del stack[n:]
            here, out, article = stack[-1][1:] if stack else (0, False, False)

        at, ends = 0, {}
        while m := _MARKUP.search(html, at):
            add(html[at:m.start()])
            at = m.end()
            tag = m.group(2)
            if tag is None:
                if m.group().startswith("<![CDATA["):
                    add(m.group()[9:-3])
                continue
            tag, attrs = tag.lower(), m.group(3)
            if m.group(1):  # end tag
                if tag == "a":
                    link = max(0, link - 1)
                elif tag in _BLOCK or tag in _OUT:
                    for n in range(len(stack) - 1, -1, -1):
                        if stack[n][0] == tag:
                            flush()
                            pop(n)
                            break
                    else:
                        if tag in _BLOCK:
                            flush()
                continue
            if tag in _RAW:
                end = _RAW[tag].search(html, at)
                at = end.end() if end else len(html)
                continue
            if tag == "br" or tag in _VOID and tag != "hr":
                add(" ")
                continue
            if tag == "a":
                link += 1
            if tag == "body":
                flush()
                pop(0)  # an unclosed head ends here
            if tag not in _BLOCK and tag not in _OUT:
                unwanted = not out and bool(attrs) and _unwanted(tag, attrs, article)
                if unwanted and tag != "a":
                    if tag not in ends:
                        ends[tag] = _element_ends(html, tag)
                    at = ends[tag].get(m.start(), at)  # without an end tag nothing is skipped
                continue
            flush()
            for n in range(len(stack) - 1, -1, -1):  # implied end tags
                if stack[n][0] in _CLOSES.get(tag, ()) or stack[n][0] == "p" and tag in _BLOCK:
                    pop(n)
                    break
                if stack[n][0] in _SCOPE:
                    break
            if tag == "hr":
                continue
            unwanted = out or _unwanted(tag, attrs, article)
            if tag in _CONTAINER and tag not in ("html", "body") and not unwanted:
                self.steps.append((*self.steps[here], _step(tag, attrs))[-_DEPTH:])
                self.paths.append(">".join(self.steps[-1]))
                self.parents.append(here)
                here = len(self.paths) - 1
            out = unwanted
            article = article or tag in ("article", "main")
            stack.append((tag, here, out, article))
        add(html[at:])
        flush()

    def best(self) -> tuple[str, float] | None:
        """Path and score of the container with most prose."""
        if not self.blocks:
            return None
        scores = [0.0] * len(self.paths)
        for node, text, linked in self.blocks:
            weight, share = max(0.0, len(text) - 1.5 * linked), 1.0
            while node >= 0 and share > 0.2:
                scores[node] += weight * share
                node, share = self.parents[node], share / 2
        for i, p in enumerate(self.paths):
            if p.rsplit(">", 1)[-1].startswith(("article", "main")):
                scores[i] *= 1.5
        i = max(range(len(scores)), key=lambda k: (scores[k], -k))
        return self.paths[self.tops[i]], scores[i]

    def _widen(self) -> list[int]:
        """For every container the outermost one around it that still is main text.

        Inside an article the article; in a main part that part, unless it
        lists several articles; elsewhere a parent below body, as long as
        it adds no container of another kind and most of what it adds is no link.
        """
        n = len(self.paths)
        chars, links, articles = [0] * n, [0] * n, [0] * n
        kinds: list[set[str]] = [set() for _ in range(n)]  # steps of the children that hold text
        for node, text, linked in self.blocks:
            chars[node] += len(text)
            links[node] += linked
        names = [steps[-1].split(".")[0] for steps in self.steps]
        for i in range(n - 1, 0, -1):  # a parent comes before its children
            up = self.parents[i]
            articles[i] += names[i] == "article"
            for sums in (chars, links, articles):
                sums[up] += sums[i]
            if chars[i]:
                kinds[up].add(self.steps[i][-1])
        article, main, tops = [-1] * n, [-1] * n, list(range(n))
        for i in range(1, n):
            up = self.parents[i]
            article[i] = article[up] if article[up] >= 0 else i if names[i] == "article" else -1
            main[i] = main[up] if main[up] >= 0 else i if names[i] == "main" else -1
            if main[i] >= 0 and articles[main[i]] < 2:
                tops[i] = main[i]
            elif article[i] >= 0:
                tops[i] = article[i]
            elif (up > 0 and main[i] < 0 and not articles[up] and kinds[up] <= {self.steps[i][-1]}
                  and 2 * (links[up] - links[i]) <= chars[up] - chars[i]):
                tops[i] = tops[up]
        return tops

    def text(self, path: str) -> str:
        """Blocks under every container with this path."""
        inside = [False] * len(self.paths)
        tops = {self.tops[i] for i, p in enumerate(self.paths) if p == path}
        for i in range(len(self.paths)):
            inside[i] = i in tops or (self.parents[i] >= 0 and inside[self.parents[i]])
        return "\n".join(t for node, t, _ in self.blocks if inside[node])

    def main_text(self, winners: list[str]) -> tuple[str, str | None]:
        """Text and the path used: the page's best if it won, else the first winner the page has, else its best."""
        best = self.best()
        if best is None:
            return "", None
        if best[0] not in winners:
            for path in winners:
                if found := self.text(path):
                    return found, path
        return self.text(best[0]), best[0]


_VOTES = "host string, path string, score double"
_TEXTS = "page_id long, url string, text string, n_chars long, path string"


def _host():
    return F.coalesce(F.lower(F.regexp_extract("url", r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def winning_paths(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """(host, paths): the paths with at least ``share`` of the host's votes, most votes first."""

    def run(batches):
        for b in batches:
            rows = []
            for host, html in zip(b.column(0).to_pylist(), b.column(1)):
                best = Page(html.as_py() or "").best()
                if best:
                    rows.append((host, *best))
            yield record_batch(rows, _VOTES)

    votes = (pages.select(_host().alias("host"), "html").mapInArrow(run, _VOTES)
             .groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"), F.round(F.sum("score")).alias("score")))
    votes = shared_table(votes, "html-votes")
    all_votes = votes.groupBy("host").agg(F.sum("votes").alias("all"))
    order = F.struct((-F.col("votes")).alias("v"), (-F.col("score")).alias("s"), F.col("path"))
    return (votes.join(all_votes, "host").where(F.col("votes") >= F.col("all") * F.lit(share))
            .groupBy("host").agg(F.sort_array(F.collect_list(order)).alias("x"))
            .select("host", F.col("x.path").alias("paths")))


def extract(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """(page_id, url, text, n_chars, path) of every page.

    Pages stay where they are when the table of winning paths is small enough
    to be broadcast (Spark knows its file size); otherwise they are joined by
    host and adaptive execution splits a hot host.

    A null or empty html has the empty text; pages without a host (null or
    odd url) vote together; repeated rows give repeated rows; other columns are
    ignored; an empty table gives no rows. Texts are read whole. Of containers
    with equal scores the first in page order votes; paths with equal votes go
    by score, then by name.
    """
    winners = shared_table(winning_paths(pages, share), "html-winners")

    def run(batches):
        for b in batches:
            rows, size = [], 0
            ids, urls, paths = (b.column(i).to_pylist() for i in (0, 1, 3))
            for page_id, url, html, won in zip(ids, urls, b.column(2), paths):
                text, path = Page(html.as_py() or "").main_text(won or [])
                rows.append((page_id, url, text, len(text), path))
                size += len(text)
                if size > 1 << 24:
                    yield record_batch(rows, _TEXTS)
                    rows, size = [], 0
            if rows:
                yield record_batch(rows, _TEXTS)

    both = pages.select("page_id", "url", "html", _host().alias("host")).join(winners, "host", "left")
    return both.select("page_id", "url", "html", "paths").mapInArrow(run, _TEXTS)
