"""A small element tree over ``html.parser`` with descendant selectors.

Used one page at a time inside Arrow batch functions. Tags are closed only by their own end
tag (or an outer one), so an unclosed ``<p>`` nests what follows, and nothing is invented.
"""

from __future__ import annotations

import codecs
import re
from html import unescape
from html.parser import HTMLParser

# Elements without an end tag, and those whose content is not text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "template"))
KEEP_SPACE = frozenset(("pre", "textarea"))

#: Longer marks first: that of UTF-32 begins like that of UTF-16.
_MARKS = (
    (codecs.BOM_UTF32_LE, "utf-32-le"),
    (codecs.BOM_UTF32_BE, "utf-32-be"),
    (codecs.BOM_UTF8, "utf-8"),
    (codecs.BOM_UTF16_LE, "utf-16-le"),
    (codecs.BOM_UTF16_BE, "utf-16-be"),
)
_XML_ENCODING = re.compile(rb"""\s*<\?xml[^>]*\bencoding\s*=\s*["']([A-Za-z0-9_.:-]+)""")
_CHARSET = re.compile(rb"""<\s*meta[^>]+charset\s*=\s*["']?([^>]*?)[ /;'">]""", re.I)
_COMPOUND = re.compile(r"""(?P<tag>^[\w-]+)|\.(?P<cls>[\w-]+)|#(?P<id>[\w-]+)|\[(?P<attr>[\w-]+)(?:=(?P<value>[\w-]+))?\]""")


# Text and the tag, comment or doctype behind it, in the shapes that leave nothing to a parser's tolerance.
_TOKEN = re.compile(
    r"""([^<]*)<(?:(/?)([a-z][a-z0-9-]*)((?:\ [a-z][a-z0-9-]*="[^"<>&]*")*)(\ ?/)?>"""
    r"""|!--([^<>-]*(?:-(?!-)[^<>-]*)*)-->|!((?i:doctype)[^<>]*)>)"""
)
_ATTRIBUTE = re.compile(r""" ([a-z][a-z0-9-]*)="([^"]*)\"""")
#: Elements whose content parsers read in ways of their own, and how it looks where they all agree.
_OWN_RULES = frozenset("script style title textarea iframe noembed noframes noscript plaintext xmp".split())
_AGREED = {name: re.compile(f"([^<]*)</{name}>") for name in ("script", "style", "title", "textarea")}


class Element:
    __slots__ = ("name", "attrs", "parent", "children")

    def __init__(self, name, attrs, parent):
        self.name, self.attrs, self.parent, self.children = name, attrs, parent, []

    def walk(self):
        """Every element below this one, in document order."""
        pending = [c for c in reversed(self.children) if c.__class__ is Element]
        while pending:
            node = pending.pop()
            yield node
            if node.children:
                pending += [c for c in reversed(node.children) if c.__class__ is Element]

    def strings(self):
        """Text below this element; script and style bodies and comments do not count."""
        pending = list(reversed(self.children))
        while pending:
            node = pending.pop()
            if node.__class__ is str:
                yield node
            elif node.__class__ is Element and node.name not in RAW:
                pending += reversed(node.children)

    def text(self, separator=""):
        return separator.join(self.strings())

    def stripped_text(self):
        return "".join(s.strip() for s in self.strings())

    def remove(self):
        if self.parent is not None:
            self.parent.children = [c for c in self.parent.children if c is not self]
            self.parent = None

    def inner_html(self):
        out, pending = [], list(reversed(self.children))
        while pending:
            node = pending.pop()
            if isinstance(node, str):
                out.append(_escape(node))
            elif isinstance(node, tuple):
                out.append(node[0])
            else:
                attrs = "".join(f" {k}={_quote(v)}" for k, v in node.attrs.items())
                if node.name in VOID:
                    out.append(f"<{node.name}{attrs}/>")
                    continue
                out.append(f"<{node.name}{attrs}>")
                pending.append((f"</{node.name}>",))
                if node.name in RAW:
                    pending.extend((c,) if isinstance(c, str) else c for c in reversed(node.children))
                else:
                    pending.extend(reversed(node.children))
        return "".join(out)


def _escape(text):
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def _quote(value):
    value = _escape(value)
    if '"' not in value:
        return f'"{value}"'
    return f"'{value}'" if "'" not in value else '"' + value.replace('"', "&quot;") + '"'


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.top = Element("", {}, None)
        self.open = {}
        self.buffer = []

    def updatepos(self, i, j):
        # line numbers are not wanted
        return j

    def read(self, page):
        """The page in plain tokens, as far as they go; the library's parser reads the rest."""
        at, match, opened = 0, _TOKEN.match, self.open
        while found := match(page, at):
            text, closing, tag, attrs, empty, comment, decl = found.groups()
            end, content = found.end(), None
            if closing:
                if attrs or empty:
                    break
            elif tag in _OWN_RULES:
                content = tag in _AGREED and not empty and _AGREED[tag].match(page, end)
                if not content:
                    break
            at = end
            if text:
                self.buffer.append(unescape(text) if "&" in text else text)
            if tag in VOID and closing:
                continue
            if self.buffer:
                self.flush()
            if closing:
                # the usual case, inline: the innermost element ends
                if (top := self.top).name == tag:
                    self.top = top.parent
                    opened[tag] -= 1
                else:
                    self.handle_endtag(tag)
            elif not tag:
                self._verbatim(f"<!{decl}>" if comment is None else f"<!--{comment}-->")
            else:
                self.handle_starttag(tag, _ATTRIBUTE.findall(attrs) if attrs else ())
                if empty and tag not in VOID:
                    self.handle_endtag(tag)
                elif content and tag in RAW:
                    at = content.end()
                    if content[1]:
                        self.buffer.append(content[1])
                    self.handle_endtag(tag)
        self.feed(page[at:])
        self.close()
        self.flush()

    def flush(self):
        if not self.buffer:
            return
        text = self.buffer[0] if len(self.buffer) == 1 else "".join(self.buffer)
        self.buffer.clear()
        if not text.strip(" \t\n\r\f\v") and not any(self.open.get(name) for name in KEEP_SPACE):
            text = "\n" if "\n" in text else " "
        self.top.children.append(text)

    def handle_starttag(self, tag, attrs):
        if self.buffer:
            self.flush()
        values = {k: v if v is not None else "" for k, v in attrs} if attrs else {}
        if "class" in values:
            values["class"] = " ".join(values["class"].split())
        node = Element(tag, values, self.top)
        self.top.children.append(node)
        if tag not in VOID:
            self.top = node
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        self.flush()
        if not self.open.get(tag):
            return
        while True:
            closed, self.top = self.top, self.top.parent
            self.open[closed.name] -= 1
            if closed.name == tag:
                return

    def handle_data(self, data):
        self.buffer.append(data)

    def _verbatim(self, text):
        self.flush()
        self.top.children.append((text,))

    def handle_comment(self, data):
        self._verbatim(f"<!--{data}-->")

    def handle_decl(self, decl):
        self._verbatim(f"<!{decl}>")

    def unknown_decl(self, data):
        self._verbatim(f"<![{data}]]>")

    def handle_pi(self, data):
        self._verbatim(f"<?{data}>")


def decode(payload: bytes) -> str:
    """Byte-order mark, charset declared by XML or HTML, UTF-8, then windows-1252."""
    for mark, name in _MARKS:
        if payload.startswith(mark):
            return payload[len(mark) :].decode(name, "replace")
    declared = _XML_ENCODING.match(payload) or _CHARSET.search(payload)
    names = [declared.group(1).decode("ascii", "replace")] if declared else []
    for name in (*names, "utf-8", "windows-1252"):
        try:
            return payload.decode(name)
        except (UnicodeDecodeError, LookupError):
            continue
    return payload.decode("utf-8", "replace")


def parse(payload: bytes) -> Element:
    builder = _Builder()
    builder.read(decode(payload))
    return builder.root


def compile_selector(selector: str):
    """``div.row span#x a[href]`` -> a list of per-element tests, innermost last."""
    steps = []
    for compound in selector.split():
        tag, classes, attrs = None, set(), []
        for m in _COMPOUND.finditer(compound):
            if m["tag"]:
                tag = m["tag"]
            elif m["cls"]:
                classes.add(m["cls"])
            elif m["id"]:
                attrs.append(("id", m["id"]))
            else:
                attrs.append((m["attr"], m["value"]))
        steps.append((tag, frozenset(classes), tuple(attrs)))
    return tuple(steps)


def _fits(node, step):
    tag, classes, attrs = step
    if tag is not None and node.name != tag:
        return False
    if classes and ("class" not in node.attrs or not classes.issubset(node.attrs["class"].split())):
        return False
    return all(k in node.attrs and (v is None or node.attrs[k] == v) for k, v in attrs)


def matches(node: Element, steps) -> bool:
    """Does the element itself fit the last step, inside ancestors that fit the ones before?"""
    if not _fits(node, steps[-1]):
        return False
    wanted, outer = len(steps) - 2, node.parent
    while wanted >= 0 and outer is not None:
        if _fits(outer, steps[wanted]):
            wanted -= 1
        outer = outer.parent
    return wanted < 0


def select(root: Element, steps):
    """Matches below ``root`` in document order; ancestors may lie outside it."""
    tag = steps[-1][0]
    return (node for node in root.walk() if (tag is None or node.name == tag) and matches(node, steps))


def select_one(root: Element, steps):
    return next(select(root, steps), None)


def select_firsts(root: Element, several):
    """What ``select_one`` gives for each of several selectors, in one walk."""
    out, open_ones = [None] * len(several), [(i, steps[-1][0], steps) for i, steps in enumerate(several)]
    for node in root.walk():
        for wanted in open_ones:
            i, tag, steps = wanted
            if (tag is None or node.name == tag) and matches(node, steps):
                out[i] = node
        if any(out):
            open_ones = [wanted for wanted in open_ones if out[wanted[0]] is None]
            if not open_ones:
                break
    return out
