"""Main text of HTML pages by tree scoring.

Each block's own text earns points for its length and commas. They go to the block's parent,
and in smaller parts to the ancestors above. A container's points are discounted by the share
of its text that is link text. The best container is kept with what stands beside it and
beside its ancestors, except for blocks of links and for short blocks that are named otherwise; where it
is or stands in an article or main element, only with what stands beside that. Elements that are no text by
their kind, role or style are left out while the page is read. Words in class and id lower the score
of an element to a tenth: it goes if the page has more text than that elsewhere.
"""

from __future__ import annotations

import html
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .common import present, text_slices

# What the elements of HTML mean for reading a page.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed", "noframes"}
DROPPED = {
    "nav", "header", "footer", "aside", "form", "button", "select", "input", "dialog", "menu", "svg", "object",
    "embed", "canvas", "audio", "video", "map", "fieldset", "datalist", "head", "label", "option",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
    "mark", "q", "ruby", "rb", "rp", "rt", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
PARAGRAPHS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "ul", "ol", "dl", "li", "dt", "dd", "table", "figure", "figcaption"}
#: An element that begins ends open ones of these kinds, up to the nearest of the second set.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Words in class or id that speak against an article: in any case, or unless an article word is there too.
NEVER = {
    "ad", "ads", "advert", "adverts", "advertisement", "adsense", "sponsor", "sponsored", "comment", "comments", "disqus", "cookie",
    "cookies", "consent", "gdpr", "footer", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "newsletter", "popup",
    "modal", "overlay", "social", "pagination", "pager", "login", "signup", "skip", "replies",
}
RARELY = {"sidebar", "header", "masthead", "banner", "promo", "related", "recommended", "share", "sharing", "notice", "alert", "widget", "toolbar", "subscribe", "search", "tags",
          "discussion", "bottom", "copyright", "legal", "colophon"}
ARTICLE_WORDS = {"article", "main", "content", "body", "column", "story", "with", "has", "no"}
#: A class such as has-comments, comments-open or ad-free tells of a state, not of what an element is.
STATES_BEFORE = {"has", "with", "no", "non", "not", "without", "is", "show", "hide"}
STATES_AFTER = {"open", "closed", "free", "on", "off", "enabled", "disabled"}
ROLES = {"navigation", "banner", "complementary", "contentinfo", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form", "toolbar"}
#: Weight of a container's points by element; 1 for all others.
WEIGHTS = {"article": 3.0, "main": 2.0, "body": 0.3, "html": 0.1, "#root": 0.1}
#: Ancestors that get points, and the share of link text from which a sibling is a block of links.
LEVELS = 6
LINK_LIMIT = 0.25
#: The share of its score that an element keeps where words speak against it, and the least text for which it is kept.
SUSPECT_SHARE = 0.1
SUSPECT_CHARS = 250
#: A block beside the best one is short below so many points, as one line without commas has.
SHORT_POINTS = 2.0

_COMMENT = regex.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))", regex.S)
_TAG = regex.compile(r"</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", regex.S)
_BROKEN_TAG = regex.compile(r"</?([a-zA-Z][^\s/>]*)([^>]*+)>", regex.S)
_TAG_BEGIN = regex.compile(r"</?[a-zA-Z]|<[!?]")
_ATTRIBUTE = regex.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW_END = {tag: regex.compile(rf"</{tag}(?=[\s/>]|\Z)", regex.A | regex.I) for tag in RAW}
_WORD = regex.compile(r"[a-z]+")
_HIDDEN = regex.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(text)} if text.strip() else {}


def _is_dropped(tag: str, found: dict[str, str]) -> bool:
    if tag in DROPPED:
        return True
    if not found or tag in ("html", "body"):
        return False
    return ("hidden" in found or found.get("aria-hidden") == "true" or _HIDDEN.search(found.get("style", "")) is not None
            or found.get("role") in ROLES)


def _is_suspect(tag: str, found: dict[str, str]) -> bool:
    """Whether words in class and id speak against the element."""
    if tag in ("html", "body", "article", "main"):
        return False
    names = [_WORD.findall(name) for name in f"{found.get('class', '')} {found.get('id', '')}".split()]
    names = [n for n in names if n and n[0] not in STATES_BEFORE and n[-1] not in STATES_AFTER]
    words = {word for n in names for word in n}
    return bool(words & NEVER) or bool(words & RARELY) and not words & ARTICLE_WORDS


class _Page:
    """A page in reading order: elements with their range of text pieces."""

    def __init__(self) -> None:
        self.tags, self.parents, self.begin, self.end = ["#root"], [-1], [0], [0]
        self.texts: list[str] = []
        self.owner: list[int] = []  # the block a piece stands in
        self.linked: list[bool] = []
        self.suspects: list[int] = []
        self.names: dict[int, str] = {}  # class and id of the elements that have any

    def _tags(self, page: str) -> Iterator[tuple[int, int, str | None, str]]:
        """begin, end, name (none for comments and declarations), attributes of each tag.

        The page is read once: where a quote stays open to the end, quotes count no more from there on.
        """
        at, last, pattern = 0, page.rfind(">"), _TAG
        while (m := _TAG_BEGIN.search(page, at)) is not None:
            at = m.start()
            if page.startswith("<!--", at):
                end, name, attributes = _COMMENT.match(page, at).end(), None, ""
            elif page[at + 1] in "!?":
                end, name, attributes = page.find(">", at) + 1 or len(page), None, ""
            elif at > last:  # no tag ends any more, but a comment may begin
                at += 1
                continue
            else:
                found = pattern.match(page, at)
                if not found:
                    pattern = _BROKEN_TAG
                    found = pattern.match(page, at)
                end, name, attributes = found.end(), found[1].lower(), found[2]
            at = (yield at, end, name, attributes) or end

    def read(self, page: str) -> None:
        stack, blocks, at, dropped, links = [0], [0], 0, 0, 0
        depths: dict[str, list[int]] = {}  # where elements of a name are open

        def put(text: str) -> None:
            if not dropped and text:
                self.texts.append(text)
                self.owner.append(blocks[-1])
                self.linked.append(links > 0)

        def close(depth: int) -> None:
            """End the elements from stack position ``depth`` on."""
            nonlocal dropped, links
            while len(stack) > depth:
                node = stack.pop()
                tag = self.tags[node]
                depths[tag].pop()
                if tag not in INLINE:
                    put(" ")
                    blocks.pop()
                elif tag == "a":
                    links -= 1
                self.end[node] = len(self.texts)
                if dropped and len(stack) < dropped:
                    dropped = 0

        def innermost(kinds: set[str], stop: set[str]) -> int | None:
            def deepest(names: set[str]) -> int:
                return max((depths[n][-1] for n in names if depths.get(n)), default=0)

            depth = deepest(kinds)
            return depth if depth and depth >= deepest(stop) else None

        tags, skip = self._tags(page), None
        while True:
            try:
                start, end, tag, attributes = tags.send(skip)
            except StopIteration:
                break
            skip = None
            put(html.unescape(page[at:start]))
            at = end
            if not tag:
                continue
            if page[start + 1] == "/":
                if tag == "br":
                    put(" ")
                    continue
                stop = {"p", "div", "article", "section", "td", "li", "body", "main"} if tag in INLINE else {"table", "article"} if tag == "p" else set()
                depth = innermost({tag}, stop)
                if depth:
                    close(depth)
                continue
            if tag in RAW:
                closing = _RAW_END[tag].search(page, at)
                at = skip = closing.start() if closing else len(page)
                continue
            if tag in VOID:
                if tag in ("br", "hr"):
                    put(" ")
                continue
            if tag in ENDS:
                depth = innermost(*ENDS[tag])
                if depth:
                    close(depth)
            elif tag not in INLINE:
                depth = innermost({"p"}, {"div", "article", "section", "main", "td", "th", "li", "body", "table", "blockquote", "button"})
                if depth:
                    close(depth)
            if tag == "body" and depths.get("head"):
                close(depths["head"][0])
            node = len(self.tags)
            self.tags.append(tag)
            self.parents.append(stack[-1])
            if tag not in INLINE:
                put(" ")
                blocks.append(node)
            elif tag == "a":
                links += 1
            self.begin.append(len(self.texts))
            self.end.append(-1)
            depths.setdefault(tag, []).append(len(stack))
            stack.append(node)
            found = _attributes(attributes)
            if not dropped and _is_dropped(tag, found):
                dropped = len(stack)
            if name := f"{found.get('class', '')}#{found.get('id', '')}".strip(" #"):
                self.names[node] = name
            if not dropped and _is_suspect(tag, found):
                self.suspects.append(node)
        put(html.unescape(page[at:]))
        close(1)
        self.end[0] = len(self.texts)

    def _leave_out_suspects(self) -> None:
        """Empty the texts of elements that words speak against, but for one that is the page's text."""
        plain = [0]  # text that is not in links, up to each piece
        for text, linked in zip(self.texts, self.linked, strict=True):
            plain.append(plain[-1] + (0 if linked else len(text.strip())))
        outside, outer, last = plain[-1], [], 0
        for node in self.suspects:  # in page order, so that outer ones come before those inside them
            if self.begin[node] >= last:
                outer.append(node)
                last = self.end[node]
                outside -= plain[last] - plain[self.begin[node]]
        kept = set()
        if outer:
            best = max(outer, key=lambda n: plain[self.end[n]] - plain[self.begin[n]])
            most = plain[self.end[best]] - plain[self.begin[best]]
            inside = [(self.begin[n], self.end[n]) for n in outer]
            if most >= SUSPECT_CHARS and most * SUSPECT_SHARE > outside and not self._has_article(plain, inside):
                kept.add(best)
        done = 0
        for node in self.suspects:
            if node not in kept:
                for k in range(max(done, self.begin[node]), self.end[node]):
                    if self.texts[k] != " ":
                        self.texts[k] = ""
                done = max(done, self.end[node])

    def _has_article(self, plain: list[int], ranges: list[tuple[int, int]]) -> bool:
        """Whether an article or main element has text outside the ranges."""
        without, at = [0], 0
        for k in range(len(self.texts)):
            while at < len(ranges) and ranges[at][1] <= k:
                at += 1
            inside = at < len(ranges) and ranges[at][0] <= k
            without.append(without[-1] + (0 if inside else plain[k + 1] - plain[k]))
        return any(without[self.end[n]] > without[self.begin[n]] for n, tag in enumerate(self.tags) if tag in ("article", "main"))

    def main_text(self) -> str:
        self._leave_out_suspects()
        size = [0]
        link_size = [0]
        points, earned_in = [0.0] * len(self.tags), [0.0] * len(self.tags)
        own: dict[int, list[int]] = {}
        for text, owner, linked in zip(self.texts, self.owner, self.linked, strict=True):
            n = len(text.strip())
            size.append(size[-1] + n)
            link_size.append(link_size[-1] + n * linked)
            if n:
                seen = own.setdefault(owner, [0, 0])
                seen[0] += n
                seen[1] += text.count(",") + text.count("、") + text.count("，")
        if not own:
            return ""
        for block, (n, commas) in own.items():
            earned = (1.0 if n >= 25 else n / 25) + commas + min(n / 100, 3.0)
            earned_in[block] += earned
            node = block if self.tags[block] not in PARAGRAPHS else self.parents[block]
            for level in range(LEVELS):
                if node < 0:
                    break
                points[node] += earned / (level + 1)
                node = self.parents[node]

        def link_share(node: int) -> float:
            n = size[self.end[node]] - size[self.begin[node]]
            return (link_size[self.end[node]] - link_size[self.begin[node]]) / n if n else 0.0

        def score(node: int) -> float:
            return points[node] * (1 - link_share(node)) * WEIGHTS.get(self.tags[node], 1.0)

        candidates = [n for n in range(len(self.tags)) if points[n] and self.tags[n] not in PARAGRAPHS and self.tags[n] not in INLINE]
        best = max(candidates, key=lambda n: (score(n), -n))
        node = best
        while node > 0:  # an article or main part around the best container is the container
            if self.tags[node] in ("article", "main"):
                best = node
                break
            node = self.parents[node]
        children: dict[int, list[int]] = {}
        for node in range(1, len(self.tags)):
            children.setdefault(self.parents[node], []).append(node)
        pieces: dict[int, list[int]] = {}
        for k, owner in enumerate(self.owner):
            pieces.setdefault(owner, []).append(k)
        for node in range(len(self.tags) - 1, 0, -1):  # children come after their parents
            earned_in[self.parents[node]] += earned_in[node]
        titles = {node for node, tag in enumerate(self.tags) if tag == "h1"}

        def is_aside(node: int, inner: int) -> bool:
            """Short, and named otherwise than the part beside it."""
            if self.tags[node] in PARAGRAPHS or earned_in[node] >= SHORT_POINTS or node not in self.names:
                return False
            return self.names[node] != self.names.get(inner) and not any(n in titles for n in children.get(node, []))

        whole, top, left_out = self.tags[best] in ("article", "main"), best, []
        while top and self.tags[top] not in ("body", "html"):
            inner, top = top, self.parents[top]
            blocks = [n for n in children[top] if self.tags[n] not in INLINE]
            left_out += [(self.begin[n], self.end[n]) for n in blocks if n != inner and (link_share(n) >= LINK_LIMIT or is_aside(n, inner))]
            # text of the ancestor itself, between its blocks, is a sibling too
            own_at = pieces.get(top, [])
            n = sum(size[k + 1] - size[k] for k in own_at)
            if n and sum(link_size[k + 1] - link_size[k] for k in own_at) / n >= LINK_LIMIT:
                left_out += [(k, k + 1) for k in own_at]
            if whole:
                break
        kept, at = [], self.begin[top]
        for start, end in [*sorted(left_out), (self.end[top], self.end[top])]:
            kept += self.texts[at:start]
            kept.append(" ")
            at = max(at, end)
        return "".join(kept)


def main_text(page: str | None) -> str:
    """The main text of a page; empty for null, empty and text-free pages."""
    if not page:
        return ""
    read = _Page()
    read.read(page)
    return " ".join(read.main_text().split())


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points); one row for each row of ``pages``.

    Null and empty pages, and pages without text, give an empty text. Repeated rows and null
    ids are kept as they are. Columns other than page_id, url and html are not looked at, whatever their names.
    An empty table gives an empty result. A page, however long, is read once and whole, by the task that has its
    row, in a time linear in its length; nothing is shuffled. Header elements go, also inside an article:
    a title is kept where it is a heading of the text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "html"):
                texts = [main_text(page) for page in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    rows = pages.select(present(pages, "page_id", "bigint").alias("page_id"), present(pages, "url", "string").alias("url"),
                        present(pages, "html", "string").alias("html"))
    return rows.mapInArrow(run, "page_id bigint, url string, text string").withColumn("n_chars", F.length("text").cast("bigint"))
