"""Elements of a page by selector: one pass over its tags with a stack of open elements.

Rules: comments, and scripts and styles with their content, are not there. A tag ends at the first ">".
An end tag closes the nearest open element of its name and all inside it; without one it is ignored. Void
elements and tags that end in "/>" are never open. An element that is not closed ends with its parent or the page; its
text is given if ``unclosed`` is set.
Paragraphs and list items don't hold their own kind but in a container (``_NEXT``): one that is not closed goes on
through the next one, up to its end tag. An element's text is all text in it, that of inner elements included; an
inner element that a selector names is given too.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

_SELECTOR = re.compile(r"""^([A-Za-z][\w-]*)(?:\[([A-Za-z][\w:-]*)(?:=["']?([^"'\]]*)["']?)?\])?$""")
_DROP = re.compile(rb"(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<!--.*?-->")
_TAG = re.compile(rb"<(/?)([A-Za-z][A-Za-z0-9:-]*)?([^>]*)>")
_ATTRIBUTE = re.compile(rb"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_VOID = frozenset(b"area base br col embed hr img input link meta source track wbr".split())
# element -> containers in which it may be inside its own kind
_NEXT = {b"li": frozenset([b"ul", b"ol", b"menu"]), b"p": frozenset(b"div li td th body section article blockquote".split())}


@dataclass(frozen=True)
class Selector:
    """ "tag", "tag[attr]" or "tag[attr='value']"; tag and attribute names in any case."""

    tag: bytes
    attr: bytes | None = None
    value: bytes | None = None

    @staticmethod
    def parse(text: str) -> Selector:
        m = _SELECTOR.match(text)
        if not m:
            raise ValueError(f"not a block selector: {text!r}")
        tag, attr, value = (x.encode() if x is not None else None for x in m.groups())
        return Selector(tag.lower(), attr.lower() if attr else None, value)

    def takes(self, name: bytes, attributes: bytes) -> bool:
        if name != self.tag:
            return False
        if self.attr is None:
            return True
        for a in _ATTRIBUTE.finditer(attributes):
            if a[1].lower() == self.attr:
                return self.value is None or next((v for v in a.groups()[1:] if v is not None), b"") == self.value
        return False


def elements(html: bytes, selectors: list[Selector], unclosed: bool = False) -> list[str]:
    """Text of the elements that any of the selectors takes, in the order in which they end."""
    html = _DROP.sub(b"", html)
    out: list[str] = []
    texts: list[bytes] = []  # pieces of text between tags
    stack: list[tuple[bytes, int]] = []  # open elements: name, and the pieces before it, or -1 if no selector takes it
    at = 0

    def close(down_to: int, own: bool = True) -> None:
        """Close the elements from ``down_to`` on; only the first of them has an end tag, if it is its own."""
        while len(stack) > down_to:
            first = stack.pop()[1]
            if first >= 0 and (unclosed or own and len(stack) == down_to):
                out.append(b"".join(texts[first:]).decode("utf-8", "replace"))

    for m in _TAG.finditer(html):
        if m.start() > at:
            texts.append(html[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            found = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if found is not None:
                close(found)
            continue
        if name in _VOID or m[3].endswith(b"/"):
            continue
        if name in _NEXT and next((n for n, _ in reversed(stack) if n == name or n in _NEXT[name]), None) == name:
            continue
        stack.append((name, len(texts) if any(s.takes(name, m[3]) for s in selectors) else -1))
    if at < len(html):
        texts.append(html[at:])
    close(0, own=False)
    return out
