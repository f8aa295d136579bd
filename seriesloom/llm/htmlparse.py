"""A small forgiving HTML reader: elements with their paths, and text in blocks."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from html import unescape

from seriesloom.llm.common import ship

ship(__name__)

# Element names and the words in class, id and role that mark what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|iframe|textarea|title|svg|math|xmp|noembed|noframes"
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul".split()
)
OUTSIDE = frozenset("head nav footer aside button select option dialog menu object audio video canvas".split())
CUES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promoted promotion banner sidebar "
    "menu menus nav navbar navigation breadcrumb breadcrumbs footer comment comments disqus reply replies respond cookie "
    "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share "
    "sharing social related recommended recommendations pagination pager toolbar masthead copyright search widget "
    "contentinfo complementary".split()
)
#: Cues of what readers or the site say beside the article, however much it is; not in names like "no-comments".
TALK = frozenset("comment comments disqus reply replies respond cookie cookies consent gdpr notice notices newsletter".split())
WRAPPER = frozenset("with without no has layout page site".split())
PLAIN = frozenset(("html", "body", "main", "article"))
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)|[^<]+|<",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"(?:^|(?<=[\s\"'/]))(class|id|role|hidden)(?=[\s=/]|$)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
WORD = re.compile(r"[a-z]+|[0-9]+")
HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
NUMBER = re.compile(r"[0-9]+")


def number(*parts: object) -> int:
    """A stable 63-bit number of the parts."""
    return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big") >> 1


class Reader:
    """Reads pages; remembers the paths it has met, which are few."""

    def __init__(self) -> None:
        self.paths: dict[tuple, tuple[int, bool, int]] = {}
        self.kept = 0

    def _enter(self, parent: int, tag: str, attributes: str, in_article: bool) -> tuple[int, bool, int]:
        known = self.paths.get((parent, tag, attributes, in_article))
        if known is None:
            found, marks = {}, []
            for m in ATTRIBUTE.finditer(attributes):
                found.setdefault(m[1].lower(), next((g for g in m.groups()[1:] if g is not None), ""))
            named = " ".join(found.get(a, "") for a in ("class", "id", "role"))
            marks = set(WORD.findall(HUMP.sub(" ", named).lower()))
            outside = tag in OUTSIDE or (tag == "header" and not in_article)
            cued = tag == "form" or "hidden" in found or (tag not in PLAIN and (bool(marks & CUES) or (not in_article and "header" in marks)))
            talk = cued and bool(marks & TALK) and not marks & WRAPPER
            if len(self.paths) > 50_000:
                self.paths.clear()
            label = NUMBER.sub("0", found.get("class", ""))
            known = self.paths[parent, tag, attributes, in_article] = number(parent, tag, label), outside, cued + talk
        return known

    def read(self, html: str) -> tuple[list[tuple[int, int]], list[tuple], list[tuple[int, int, str]]]:
        """Elements as (path, parent path), texts as (block, path, node, outside, in article, text), nodes.

        The path is a number of the tags and classes down to the element. Nodes are the elements that
        can hold text, as (number of the node around it, cue, tag), from 1 in page order; the cue is 0 for
        none, 1, or 2 for talk beside the article, and does not count for ``outside``. Text of a block comes in page order, decoded, inline markup cut out.
        """
        elements, texts, nodes = [], [], [(0, 0, "")]
        stack: list[tuple[str, int, bool, bool, bool, int]] = [("", 0, False, False, False, 0)]  # tag, path, outside, in article, block, node
        # How many elements of a name are open: what is not open is not looked for.
        opened: Counter[str] = Counter()

        def close(i: int) -> None:
            opened.subtract(s[0] for s in stack[i:])
            del stack[i:]

        block = 0
        for m in TOKEN.finditer(html):
            whole = m[0]
            if whole[0] != "<" or whole == "<":
                _, path, outside, inside, _, node = stack[-1]
                texts.append((block, path, node, outside, inside, unescape(whole)))
                continue
            name = m[3] or m[6]
            if not name:  # a comment, a declaration or an element whose text is no text
                continue
            tag = name.lower()
            if m[2] or m[5]:
                if not opened[tag]:
                    block += tag in BLOCKS
                    continue
                i = len(stack) - 1
                while stack[i][0] != tag:
                    i -= 1
                block += any(s[4] for s in stack[i:])
                close(i)
                continue
            if tag == "br":
                _, path, outside, inside, _, node = stack[-1]
                texts.append((block, path, node, outside, inside, " "))
            if tag in BLOCKS:
                block += 1
                closed = CLOSED_BY.get(tag, ())
                for i in range(len(stack) - 1, 0, -1) if opened["p"] or any(opened[c] for c in closed) else ():
                    if stack[i][0] == "p" or stack[i][0] in closed:
                        close(i)
                        if not closed:
                            break
                    elif stack[i][4] and (not closed or stack[i][0] in SCOPES.get(tag, ())):
                        break
            _, parent, outside, inside, _, node = stack[-1]
            path, off, cued = self._enter(parent, tag, m[4] or m[7] or "", inside)
            elements.append((path, parent))
            if tag not in VOID and not (m[4] or m[7] or "").rstrip().endswith("/") or tag in BLOCKS - VOID:
                nodes.append((node, cued, tag))
                opened[tag] += 1
                stack.append((tag, path, outside or off, inside or (tag in ("article", "main") and not outside and not off), tag in BLOCKS, len(nodes) - 1))
        return elements, texts, nodes
