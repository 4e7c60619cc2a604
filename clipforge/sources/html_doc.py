"""A small element tree from the standard library's ``html.parser``.

Used inside ``mapInPandas`` tasks only (per-row helper); everything after the
parse is Spark expressions.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
        "track", "wbr"}
HIDDEN = {"script", "style", "template"}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs=None, parent=None):
        self.tag = tag
        self.attrs = dict(attrs or [])
        self.children = []
        self.parent = parent

    # text of all descendants but style and script, like ``.text`` / ``get_text()``
    def text(self, strip: bool = False, sep: str = "") -> str:
        parts = []
        for s in self.strings():
            if strip:
                s = s.strip()
                if not s:
                    continue
            parts.append(s)
        return sep.join(parts)

    def strings(self):
        for c in self.children:
            if isinstance(c, str):
                yield c
            elif isinstance(c, Node) and c.tag != "#comment" and c.tag not in HIDDEN:
                yield from c.strings()

    def iter(self):
        for c in self.children:
            if isinstance(c, Node):
                yield c
                yield from c.iter()

    def find_all(self, tag=None, cls=None, pred=None):
        for n in self.iter():
            if tag is not None and n.tag != tag:
                continue
            if cls is not None and cls not in (n.attrs.get("class") or "").split():
                continue
            if pred is not None and not pred(n):
                continue
            yield n

    def find(self, tag=None, cls=None):
        return next(self.find_all(tag, cls), None)

    def string(self):
        """The single text child (``tag.string``), else None."""
        if len(self.children) == 1:
            c = self.children[0]
            if isinstance(c, str):
                return c
            if isinstance(c, Node):
                return c.string()
        return None


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.cur = self.root

    def handle_starttag(self, tag, attrs):
        n = Node(tag, attrs, self.cur)
        self.cur.children.append(n)
        if tag not in VOID:
            self.cur = n

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(Node(tag, attrs, self.cur))

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent

    def handle_data(self, data):
        self.cur.children.append(data)

    def handle_comment(self, data):
        self.cur.children.append(Node("#comment"))


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def visible_text(html: str) -> str:
    """Newline-separated stripped text nodes outside script/style/template and comments."""
    out = []

    def walk(n):
        for c in n.children:
            if isinstance(c, str):
                s = c.strip()
                if s:
                    out.append(s)
            elif c.tag not in HIDDEN and c.tag != "#comment":
                walk(c)
    walk(parse(html))
    return "\n".join(out)


def article_blocks(html: str, *, block_class: str, headline_class: str, date_class: str,
                   source_class: str, persons_label: str, highlight_pattern: str) -> list[dict]:
    """One dict per article block that has a headline link."""
    root = parse(html)
    hl = re.compile(highlight_pattern, re.IGNORECASE)
    out = []
    for no, block in enumerate(root.find_all("tr", block_class)):
        head = block.find("a", headline_class)
        if head is None:
            continue
        date = block.find("span", date_class)
        src = block.find("a", source_class)
        labelled = [s.parent.text() for s in block.find_all("strong")
                    if s.string() == persons_label and s.parent is not None]
        spans = [s.text(strip=True) for s in block.find_all("span", pred=lambda x: hl.search(x.attrs.get("style") or ""))]
        out.append({
            "block_no": no,
            "title": head.text(),
            "url": head.attrs.get("href") or "",
            "date_text": date.text(strip=True) if date is not None else None,
            "source": src.text(strip=True) if src is not None else None,
            "block_text": block.text(),
            "labelled_text": labelled,
            "highlighted": [s for s in spans if s],
        })
    return out
