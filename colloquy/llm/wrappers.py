"""HTML extraction by wrapper inference (union-free regular expressions).

The token stream of a page (tags, text) is nested by the usual implied end
tags. The pages of a host are folded one after another into a wrapper: token
sequences are aligned, matching tags are merged, and mismatches become
optional groups (a tag that some pages lack), repeated groups (neighbours of
one tag, aligned into one body), or text slots (strings that differ). The
wrapper is a union-free expression: tags, constants, slots, ( )? and ( )+.

Groups are told apart by marks (class and id words) that enough of a host's
pages share, which a Spark aggregate counts; marks of single pages are dropped,
so the number of a host's keys does not grow with its pages. Pages of one
shape (the same nested keys) are folded in the map tasks, a small row per host
and shape; the shapes of a host are then merged in the order of their
hashes, in rounds of bounded groups, so a hot host is never gathered and the
wrapper does not depend on how pages lie in partitions. From the wrapper
follows the host's rule: where the article lies, which groups hold most of the
text that varies, and which may be constants of the template. A constant must
stand beside different texts: it is left out only if enough different
remainders of pages, repeated and mirrored pages counted once, hold it. Pages
are read again under their host's rule. Fixed lists of tags, and class marks
made of listed words alone, tell what of the rest is no text; headings,
paragraphs, tables and list items are never left out by a word.
"""

from __future__ import annotations

import hashlib
import html
import itertools
import json
import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, arrow_map, materialize

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</?[A-Za-z][^\s/>]*(?:[^>\"']|\"[^\"]*\"|'[^']*')*>?|[^<]+|<",
                   re.S)
NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")

# HTML element names by their part in a page, and the elements whose end tag may be left out.
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "plaintext")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
INLINE = ("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "br", "wbr", "img")
NOT_TEXT = ("head", "nav", "header", "footer", "aside", "form", "script", "style", "noscript", "template", "button", "select",
            "option", "input", "textarea", "title", "iframe", "object", "svg", "canvas", "audio", "video", "dialog", "menu",
            "fieldset", "noembed", "noframes", "map")
NOT_TEXT_WORDS = ("ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion",
                  "banner", "sidebar", "side", "aside", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs",
                  "header", "masthead", "footer", "comment", "comments", "disqus", "reply", "replies", "notice", "cookie",
                  "cookies", "consent", "gdpr", "popup", "modal", "newsletter", "subscribe", "share", "sharing", "social",
                  "related", "recommended", "widget", "toolbar", "login", "signup", "form", "search", "pager", "pagination",
                  "alert", "hidden", "skip")
PLAIN_WORDS = ("article", "main", "content", "post", "entry", "story", "page", "site", "box", "block", "wrap", "wrapper", "container",
               "inner", "outer", "area", "bar", "list", "links", "link", "button", "buttons", "unit", "slot", "posts", "articles",
               "stories", "top", "bottom", "left", "right")
TEXT_TAGS = ("p", "pre", "blockquote", "table", "thead", "tbody", "tfoot", "figure", "dl", "hgroup", "address", "math")
COMMENT_WORDS = ("comment", "comments", "disqus", "reply", "replies")
CONTAINERS = ("html", "body", "main", "article")
WRAPPERS = ("form", "fieldset")
MAIN_WORDS = ("article", "main", "content", "post", "entry", "story")
CLOSES_P = ("address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset",
            "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main",
            "menu", "nav", "ol", "p", "pre", "section", "table", "ul")
IMPLIED_END = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
               "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"),
               "body": ("head",)}
SCOPES = ("ul", "ol", "dl", "table", "select", "article", "section", "div", "main", "aside", "blockquote", "body", "html")

LABELS = ("h1", "h2", "h3", "h4", "h5", "h6", "dt", "th", "td", "tr", "li", "caption", "figcaption", "legend", "summary")

CONSTANT_PAGES = 3
CONSTANT_SHARE = 0.25
STABLE_SHARE = 0.05
MAX_CHILDREN = 200
KEYS_HELD = 20_000
MARKS_HELD = 100_000
MERGE_SHAPES = 500
SHAPES_HELD = 500
MAX_DEPTH = 150

_RAW, _VOID, _INLINE, _NOT_TEXT, _CLOSES_P, _SCOPES = map(frozenset, (RAW, VOID, INLINE, NOT_TEXT, CLOSES_P, SCOPES))
_NOT_WORDS, _MAIN_WORDS, _COMMENT_WORDS = map(frozenset, (NOT_TEXT_WORDS, MAIN_WORDS, COMMENT_WORDS))
_KEPT = frozenset(LABELS + CONTAINERS)
_PLAIN_WORDS, _NEVER = frozenset(PLAIN_WORDS), frozenset(LABELS + TEXT_TAGS)
_TAGS = frozenset(RAW + VOID + INLINE + NOT_TEXT + CLOSES_P + SCOPES + LABELS + CONTAINERS + tuple(IMPLIED_END) + ("tfoot", "picture"))
HIDDEN = "!hidden"            # the mark of the attribute; no class word, which may be "hidden" as well
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _key(tag: str, token: str) -> str:
    """A tag's name with its class, id and role: what tells groups of a page apart."""
    marks = []
    if len(token) > len(tag) + 3:
        for m in ATTRIBUTE.finditer(token, len(tag) + 1):
            name, value = m[1].lower(), (m[2] or "").strip("\"'")
            if name == "hidden" or (name == "aria-hidden" and value.strip().lower() != "false"):
                marks.append(HIDDEN)
            elif name in ("class", "role", "itemprop") or (name == "id" and not any(c.isdigit() for c in value)):
                marks += [w for w in value.split() if w != HIDDEN]
    return " ".join([tag, *marks])


def _mark_words(mark: str) -> list[str]:
    return [x.lower() for x in _WORD.findall(mark)]


def _listed(mark: str) -> bool:
    """Whether a mark says that its group is no text: listed words, plain ones beside them at most ("menu-recipe" does not)."""
    words = _mark_words(mark)
    return any(w in _NOT_WORDS for w in words) and all(w in _NOT_WORDS or w in _PLAIN_WORDS for w in words)


def key_marks(key: str) -> list[str]:
    """What is counted of a key: itself, and its tag with each single mark."""
    tag, *marks = key.split(" ")
    return [key, *(f"{tag} {m}" for m in marks)] if len(marks) > 1 else [key]


def stable_key(key: str, stable: frozenset) -> str:
    """The key as it is if enough pages of the host have it, else what is bounded of it.

    That is a known tag (x for another) with the first mark that enough pages
    have, whether it is hidden, and its first listed word of each kind.
    """
    if key in stable:
        return key
    tag, *marks = key.split(" ")
    out = [next((m for m in marks if f"{tag} {m}" in stable), ""), HIDDEN if HIDDEN in marks else ""]
    marks = [m for m in marks if m != HIDDEN]
    listed = [w for m in marks if _listed(m) for w in _mark_words(m)]
    for known, words in ((_COMMENT_WORDS, listed), (_NOT_WORDS, listed), (_MAIN_WORDS, [w for m in marks for w in _mark_words(m)])):
        out.append(next((w for w in words if w in known), ""))
    return " ".join(dict.fromkeys([tag if tag in _TAGS else "x", *filter(None, out)]))


class Node:
    """An element: its key, and its children in order (strings are text)."""
    __slots__ = ("key", "tag", "children")

    def __init__(self, key: str, tag: str):
        self.key, self.tag, self.children = key, tag, []


def page_keys(page: str) -> set[str]:
    """The keys of a page's start tags, from its token stream alone."""
    out: set[str] = set()
    at = 0
    while (m := TOKEN.match(page, at)) is not None:
        token, at = m[0], m.end()
        if token[0] == "<" and token != "<" and token[1] not in "/!?":
            tag = NAME.match(token)[1].lower()
            out.add(_key(tag, token))
            if tag in _RAW:
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
    return out


class Keys(dict):
    """Key -> stable key of one host, looked up once; None for the stable ones leaves all keys as they are."""

    def __init__(self, stable: frozenset | None = None):
        super().__init__()
        self.stable = stable

    def __missing__(self, key: str) -> str:
        if self.stable is None:
            return key
        if len(self) >= KEYS_HELD:
            self.clear()
        out = self[key] = stable_key(key, self.stable)
        return out


def parse(page: str, keys: Keys | None = None) -> Node:
    """Nest the token stream of a whole page; unclosed elements end where HTML ends them."""
    root = Node("", "")
    keys = Keys() if keys is None else keys
    stack = [root]
    at, n = 0, len(page)
    while at < n:
        m = TOKEN.match(page, at)
        if m is None:                     # cannot happen: the last alternatives take any character
            break
        token, at = m[0], m.end()
        if token[0] != "<" or token == "<":
            stack[-1].children.append(token)
            continue
        if token.startswith(("<!", "<?")):
            if token.startswith("<![CDATA["):
                stack[-1].children.append(html.escape(token[9:].removesuffix("]]>"), quote=False))
            continue
        tag = NAME.match(token)[1].lower()
        if token[1] == "/":
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        if tag in _CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in _SCOPES:
                    break
        ends = IMPLIED_END.get(tag)
        if ends:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    del stack[i:]
                elif stack[i].tag in _SCOPES and stack[i].tag != tag:
                    break
        node = Node(keys[_key(tag, token)], tag)
        stack[-1].children.append(node)
        if tag in _RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            node.children.append(page[at:end.start() if end else n])
            at = end.end() if end else n
        elif tag not in _VOID and not token.endswith("/>"):
            stack.append(node)
    return root


# A wrapper node is [key, optional, repeated, children, pages]; a text is ["#", optional, constant or None, chars, pages].
# ``pages`` counts those that have it (never too many); a constant of over 40 characters is kept as its hash.


def _constant(text: str) -> str:
    return text if len(text) <= 40 else "~" + hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=12).hexdigest()


def _wrap(node: Node, depth: int = 0) -> list:
    if depth > MAX_DEPTH:
        raise RecursionError
    kids: list = []
    for is_text, run in itertools.groupby(node.children, lambda c: isinstance(c, str)):
        if is_text:
            t = "".join(run).strip()
            if t:
                kids.append(["#", False, _constant(t), len(t), 1])
        else:
            kids += [_wrap(c, depth + 1) for c in run]
    return [node.key, False, False, _fold_repeats(kids), 1]


def _gather(kids: list) -> list:
    """A long row of children as one group per key, optional and repeated, in order of first place."""
    out: dict[str, list] = {}
    for k in kids:
        out[k[0]] = merge(out[k[0]], k, max) if k[0] in out else k
    return [[k[0], True, *k[2:]] if k[0] == "#" else [k[0], True, True, *k[3:]] for k in out.values()]


def _fold_repeats(kids: list) -> list:
    """Neighbours of one key become one repeated group, their bodies aligned into one.

    Over ``MAX_CHILDREN`` groups that remain are gathered by key, so a node has
    no more children than that or the number of the host's keys.
    """
    out: list = []
    for k in kids:
        if out and out[-1][0] == k[0] and k[0] != "#":
            out[-1] = merge(out[-1], k, max)
            out[-1][2] = True
        else:
            out.append(k)
    return _gather(out) if len(out) > MAX_CHILDREN else out


def merge(a: list, b: list, count=operator.add) -> list:
    """The wrapper of both: same keys merge, a text that differs becomes a slot, unmatched groups become optional.

    ``count`` joins the numbers of pages: their sum, or for parts of one page the larger.
    """
    if a[0] == "#":
        return ["#", a[1] or b[1], a[2] if a[2] == b[2] else None, a[3] + b[3], count(a[4], b[4])]
    return [a[0], a[1] or b[1], a[2] or b[2], _align(a[3], b[3], count), count(a[4], b[4])]


def _align(x: list, y: list, count=operator.add) -> list:
    if [k[0] for k in x] == [k[0] for k in y]:
        return [merge(a, b, count) for a, b in zip(x, y)]
    n, m = len(x), len(y)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[i][0] == y[j][0] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and x[i][0] == y[j][0]:
            out.append(merge(x[i], y[j], count))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append([x[i][0], True, *x[i][2:]])
            i += 1
        else:
            out.append([y[j][0], True, *y[j][2:]])
            j += 1
    return _fold_repeats(out)


def expression(w: list) -> str:
    """The wrapper spelled as a union-free expression."""
    if w[0] == "#":
        body = f"'{w[2]}'" if w[2] is not None else "#"
        return f"({body})?" if w[1] else body
    inner = " ".join(expression(k) for k in w[3])
    body = f"<{w[0]}>{' ' + inner if inner else ''} </{w[0].split(' ')[0]}>" if w[0] else inner
    return f"( {body} )" + ("*" if w[1] and w[2] else "?" if w[1] else "+") if w[1] or w[2] else body


def _words(key: str) -> set[str]:
    return {x.lower() for x in _WORD.findall(key.partition(" ")[2])}


def _left_out(key: str, spared: frozenset = frozenset()) -> bool:
    """Whether a group is no text: by its tag, a hidden attribute, or a mark of listed words, which says nothing of a
    container, a heading, paragraph, table or item.

    ``spared`` are the groups that hold most of a host's text. An article can
    be a reader's comment, if a class says just that.
    """
    tag, *marks = key.split(" ")
    if HIDDEN in marks or tag in _NOT_TEXT and not (tag in WRAPPERS and key in spared):
        return True
    if tag in CONTAINERS:
        return tag == "article" and not _COMMENT_WORDS.isdisjoint(marks)
    return tag not in _NEVER and key not in spared and any(map(_listed, marks))


def _mass(w: list, spared: frozenset, linked: bool = False) -> int:
    """Characters of text that are not in links or left-out groups."""
    if w[0] == "#":
        return 0 if linked else w[3]
    if _left_out(w[0], spared):
        return 0
    return sum(_mass(k, spared, linked or w[0].split(" ")[0] == "a") for k in w[3])


def _spared(w: list, pages: int) -> frozenset:
    """The groups with a listed word that hold more than half of the host's text that varies (of one page: of its text).

    Comments are never among them, however long: they are not the article.
    """
    sums: dict[str, int] = {}

    def walk(node: list, linked: bool, within: frozenset) -> int:
        if node[0] == "#":
            return 0 if linked or (pages > 1 and node[2] is not None) else node[3]
        tag, *marks = node[0].split(" ")
        words = _words(node[0])
        if HIDDEN in marks or (tag in _NOT_TEXT and tag not in WRAPPERS) or words & _COMMENT_WORDS:
            return 0
        inner = within | {node[0]}
        n = sum(walk(k, linked or tag == "a", inner) for k in node[3])
        if node[0] not in within and (tag in WRAPPERS or words & _NOT_WORDS):
            sums[node[0]] = sums.get(node[0], 0) + n
        return n
    total = walk(w, False, frozenset())
    return frozenset(k for k, n in sums.items() if 2 * n > total)


def _spell(w: list) -> str | None:
    """A group of constants spelled out; None if it holds a slot."""
    if w[0] == "#":
        return w[2]
    inner = [_spell(k) for k in w[3]]
    return None if None in inner else f"<{w[0]}>{' '.join(inner)}</>"


def _mark(spelled: str) -> str:
    return hashlib.blake2b(spelled.encode("utf-8", "replace"), digest_size=12).hexdigest()


def _has_text(w: list) -> bool:
    return w[0] == "#" or any(map(_has_text, w[3]))


def _constants(w: list, pages: int, spared: frozenset) -> dict[str, list[str]]:
    """The constants of a host's template, as marks by the path of the group that holds them.

    These are the outermost block groups without a slot, and strings with
    block groups or nothing beside them, on at least ``CONSTANT_PAGES`` pages
    and a share of ``CONSTANT_SHARE``. Labels (headings, cells, items) and
    paragraphs, tables and the like without marks belong to the slots that they
    stand beside; they go with a constant group around them alone. Inline
    groups are parts of a line and stay with it. ``proven`` then asks for as
    many different pages.
    """
    least = max(CONSTANT_PAGES, pages * CONSTANT_SHARE)
    out: dict[str, set[str]] = {}

    def walk(node: list, path: str) -> None:
        tags = ["", *("#" if k[0] == "#" else k[0].partition(" ")[0] for k in node[3]), ""]
        for i, k in enumerate(node[3]):
            if k[0] == "#":
                alone = tags[i] not in _INLINE and tags[i + 2] not in _INLINE
                if alone and path and len(node[3]) > 1 and k[2] is not None and k[4] >= least:
                    out.setdefault(path, set()).add(_mark(k[2]))
            elif not _left_out(k[0], spared) and tags[i + 1] not in _INLINE:
                flow = tags[i + 1] in _KEPT or k[0] in _NEVER       # a key without marks is its tag
                spelled = _spell(k) if not flow and k[4] >= least and _has_text(k) else None
                if spelled is not None:
                    out.setdefault(path, set()).add(_mark(spelled))
                else:
                    walk(k, f"{path}\x1f{k[0]}")
    walk(w, "")
    return {k: sorted(v) for k, v in out.items()}


def rule(w: list, pages: int) -> dict:
    """What is read of the pages of a host: the keys of ``spared`` groups and of ``roots``, and what is left out as constant.

    Roots are the elements that hold the article, for each test in order:
    article elements, main elements, groups named as content (and at
    last the body, which needs no key). A host can have several templates, so
    each page takes the first test that gives it text. Left-out groups are
    never entered.
    """
    found: dict[str, set[str]] = {"article": set(), "main": set(), "named": set()}
    spared = _spared(w, pages)

    def walk(node: list) -> None:
        if node[0] == "#" or (node[0] and _left_out(node[0], spared)):
            return
        tag = node[0].partition(" ")[0]
        if _mass(node, spared):
            if tag in ("article", "main"):
                found[tag].add(node[0])
            elif tag not in ("html", "body") and _words(node[0]) & _MAIN_WORDS:
                found["named"].add(node[0])
        for k in node[3]:
            walk(k)
    walk(w)
    return {"spared": sorted(spared), "constants": _constants(w, pages, spared), "roots": [sorted(found[k]) for k in ("article", "main", "named") if found[k]]}


@dataclass
class Rule:
    """A host's rule as the pages need it."""
    roots: list[frozenset] = field(default_factory=list)
    keys: Keys = field(default_factory=lambda: Keys(frozenset()))
    spared: frozenset = frozenset()
    constants: dict[str, frozenset] = field(default_factory=dict)

    @classmethod
    def of_json(cls, spelled: str | None, stable: list[str], proven: list[str] | None = None) -> "Rule":
        """A rule with the constants among ``proven``, or all that it proposes."""
        keys = Keys(frozenset(stable))
        if spelled is None:
            return cls(keys=keys)
        r = json.loads(spelled)
        marks = {k: frozenset(v if proven is None else set(v) & set(proven)) for k, v in r["constants"].items()}
        return cls([frozenset(x) for x in r["roots"]], keys, frozenset(r["spared"]), {k: v for k, v in marks.items() if v})


def article(page: str, r: Rule, met: set[str] | None = None) -> list[str]:
    """The blocks of a page under the first of a rule's roots that give text, at last of its whole body.

    A page that has constants alone keeps them: they are its text. ``met``
    receives the constants left out.
    """
    root = parse(page, r.keys)
    for roots in (*r.roots, frozenset()):
        out = blocks(root, roots, r, met)
        if not out and r.constants:
            out = blocks(root, roots, Rule(r.roots, r.keys, r.spared))
        if out:
            return out
    return []


def _constant_group(c: Node) -> str | None:
    """The mark of a group if it were a constant."""
    try:
        spelled = _spell(_wrap(c))
    except RecursionError:
        return None
    return None if spelled is None else _mark(spelled)


def blocks(root: Node, roots: frozenset, r: Rule, met: set[str] | None = None) -> list[str]:
    """The blocks inside ``roots`` in page order (none: the whole body); references decoded, white space single."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(run)).split())
        run.clear()
        if text:
            out.append(text)

    # (element, index of its next child, inside the article, path where the host has constants)
    stack = [[root, 0, not roots, ""]]
    while stack:
        top = stack[-1]
        node, i, inside, path = top
        if i == len(node.children):
            stack.pop()
            if node.tag not in _INLINE:
                flush()
            continue
        top[1] += 1
        c = node.children[i]
        marks = r.constants.get(path) if inside else None
        if isinstance(c, str):
            if marks and not (i and isinstance(node.children[i - 1], str)):
                text = "".join(itertools.takewhile(lambda x: isinstance(x, str), itertools.islice(node.children, i, None)))
                if text.strip() and (mark := _mark(_constant(text.strip()))) in marks:
                    if met is not None:
                        met.add(mark)
                    while top[1] < len(node.children) and isinstance(node.children[top[1]], str):
                        top[1] += 1
                    continue
            if inside:
                run.append(c)
        elif c.tag in ("br", "wbr", "img"):
            if inside and c.tag == "br":
                run.append(" ")
        elif not _left_out(c.key, r.spared):
            if c.tag not in _INLINE:
                flush()
                if marks and (mark := _constant_group(c)) in marks:
                    if met is not None:
                        met.add(mark)
                    continue
            # Wrappers are no deeper than MAX_DEPTH, so deeper groups need no path.
            deeper = f"{path}\x1f{c.key}" if r.constants and len(stack) <= MAX_DEPTH and path is not None else None
            stack.append([c, 0, inside or c.key in roots, deeper])
    flush()
    return out


def _host(url: str | None) -> str:
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:", "", url or "").lstrip("/").partition("/")[0].partition("?")[0] \
        .partition("#")[0].lower()


def _hosted(pages: DataFrame) -> DataFrame:
    def host(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([_host(u) for u in batch.column("url").to_pylist()], pa.string())]
    return add_columns(pages, host, "__host string")


def stable_marks(pages: DataFrame, share: float = STABLE_SHARE) -> DataFrame:
    """(__host, __stable) of ``pages`` (url, html): the key marks that at least ``share`` of a host's pages have.

    A host whose pages have m different marks on average has at most m / share
    of them, however many pages there are; marks of single pages (numbers,
    slugs) are counted by the aggregate and gathered nowhere. A host of at
    most 1 / share pages keeps all its marks.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], int] = {}

        def give() -> pa.RecordBatch:
            rows = list(held.items())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.string()),
                                               pa.array([n for _, n in rows], pa.int64())], ["__host", "mark", "n"])
        for b in batches:
            for url, page in zip(b.column("url").to_pylist(), b.column("html").to_pylist()):
                if page is None:
                    continue
                h = _host(url)
                for m in {"", *(m for k in page_keys(page) for m in key_marks(k))}:
                    held[h, m] = held.get((h, m), 0) + 1
                if len(held) >= MARKS_HELD:
                    yield give()
        if held:
            yield give()
    some = pages.select(F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    counts = materialize(some.mapInArrow(run, "__host string, mark string, n long").groupBy("__host", "mark")
                             .agg(F.sum("n").alias("n")), "wrapper-marks")
    # The empty mark is on every page: its count is the host's number of pages.
    total = counts.where("mark = ''").select("__host", F.col("n").alias("pages"))
    kept = counts.where("mark <> ''").join(total, "__host").where(F.col("n") >= F.col("pages") * F.lit(share))
    listed = kept.groupBy("__host").agg(F.array_sort(F.collect_list("mark")).alias("__stable"))
    return materialize(total.select("__host").join(listed, "__host", "left")
                            .select("__host", F.coalesce("__stable", F.array().cast("array<string>")).alias("__stable")), "wrapper-keys")


def _shape(w: list) -> str:
    """The nested keys of a wrapper, spelled."""
    return "#" if w[0] == "#" else f"{w[0]}{'+' if w[2] else ''}({','.join(map(_shape, w[3]))})"


def infer_wrappers(pages: DataFrame, merge_shapes: int = MERGE_SHAPES, stable: DataFrame | None = None) -> DataFrame:
    """(host, pages, wrapper as JSON) of ``pages`` (url, html), folded over all pages of each host.

    Pages of null html are left out, a null url has the host "". Pages nested
    deeper than ``MAX_DEPTH`` elements do not shape the wrapper; their text is
    read under the rule that the host's other pages give. Keys are made of the
    marks ``stable`` (those of ``stable_marks``), so their number does not grow
    with the pages, nor does a node's number of children. Pages of one shape
    merge the same in any order; the shapes of a host merge in the order of
    their hashes, in groups of about ``merge_shapes`` by round, so the result
    depends on the pages alone.
    """
    names = ["host", "shape", "pages", "wrapper"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], list] = {}
        named: dict[str, Keys] = {}

        def give() -> pa.RecordBatch:
            rows = list(held.items())
            held.clear()
            named.clear()
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.string()),
                                               pa.array([v[0] for _, v in rows], pa.int64()),
                                               pa.array([json.dumps(v[1]) for _, v in rows], pa.string())], names)
        for b in batches:
            for h, page, marks in zip(b.column("__host").to_pylist(), b.column("html").to_pylist(), b.column("__stable")):
                if page is None:
                    continue
                if h not in named:
                    named[h] = Keys(frozenset(marks.as_py() or ()))
                try:
                    w = _wrap(parse(page, named[h]))
                except RecursionError:
                    w = ["", False, False, [], 1]
                key = h, _mark(_shape(w))
                if key in held:
                    held[key][0] += 1
                    held[key][1] = merge(held[key][1], w)
                else:
                    held[key] = [1, w]
                if len(held) >= SHAPES_HELD:
                    yield give()
        if held:
            yield give()

    def join(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("shape", kind="stable")
        w = None
        for x in part["wrapper"]:
            w = json.loads(x) if w is None else merge(w, json.loads(x))
        return pd.DataFrame({"host": [part["host"].iloc[0]], "shape": [part["shape"].iloc[0]], "pages": [int(part["pages"].sum())],
                             "wrapper": [json.dumps(w)]})

    schema = "host string, shape string, pages long, wrapper string"
    some = pages.select(F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    marks = stable_marks(pages) if stable is None else stable
    some = _hosted(some).join(marks, "__host", "left").select("__host", "html", "__stable").mapInArrow(run, schema)
    out = materialize(some.groupBy("host", "shape").applyInPandas(join, schema), "wrapper-shapes")
    while True:
        counts = out.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
        most = counts.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return out.select("host", "pages", "wrapper")
        way = F.pmod(F.xxhash64("shape"), F.ceil(F.col("n") / merge_shapes))
        out = materialize(out.join(counts, "host").groupBy("host", way.alias("way")).applyInPandas(join, schema), "wrapper-shapes")


def proven(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(__host, __proven): the proposed constants of each host that stand beside enough different texts.

    What a page holds without its constants is its remainder. A constant is
    proven if at least ``CONSTANT_PAGES`` different remainders, and a share of
    ``CONSTANT_SHARE`` of its host's, come with it. Only (host, remainder,
    constant) hashes are shuffled.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        held: dict[str, Rule] = {}
        rows = []
        for h, page, spelled, stable in zip(batch.column("__host").to_pylist(), batch.column("html").to_pylist(),
                                            batch.column("__rule"), batch.column("__stable")):
            if h not in held:
                held[h] = Rule.of_json(spelled.as_py(), stable.as_py() or [])
            met: set[str] = set()
            rest = _mark("\n\n".join(article(page or "", held[h], met)))
            rows += [(h, rest, m) for m in ("", *sorted(met))]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], ["__host", "rest", "mark"])
    proposing = rules.where(~F.col("__rule").contains('"constants": {}'))
    asked = _hosted(pages.select("url", "html")).join(proposing, "__host")
    seen = arrow_map(asked, run, "__host string, rest string, mark string").distinct()
    counts = materialize(seen.groupBy("__host", "mark").agg(F.count(F.lit(1)).alias("n")), "wrapper-constants")
    total = counts.where("mark = ''").select("__host", F.col("n").alias("all"))
    kept = counts.where("mark <> ''").join(total, "__host").where(
        (F.col("n") >= CONSTANT_PAGES) & (F.col("n") >= F.col("all") * F.lit(CONSTANT_SHARE)))
    return kept.groupBy("__host").agg(F.array_sort(F.collect_list("mark")).alias("__proven"))


def extract(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``pages`` (or its columns ``keep``) with ``text``: the article's blocks, joined by two newlines.

    Null, empty and text-less pages give an empty text. Repeated pages are
    read each, and make nothing a constant of their host. A column called text
    is replaced. An empty table gives no rows.
    """
    rule_of = F.udf(lambda wrapper, n: json.dumps(rule(json.loads(wrapper), n)), "string")   # one call per host
    stable = stable_marks(pages)
    found = infer_wrappers(pages, stable=stable).select(F.col("host").alias("__host"), rule_of("wrapper", "pages").alias("__rule"))
    rules = materialize(stable.join(found, "__host", "left"), "wrapper-rules")
    rules = materialize(rules.join(proven(pages, rules), "__host", "left"), "wrappers")

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        held: dict[str | None, Rule] = {}
        out = []
        rows = zip(*(batch.column(c).to_pylist() for c in ("__host", "html")), *(batch.column(c) for c in ("__rule", "__stable", "__proven")))
        for h, page, spelled, stable, proven in rows:
            if h not in held:
                held[h] = Rule.of_json(spelled.as_py(), stable.as_py() or [], proven.as_py() or [])
            out.append("\n\n".join(article(page or "", held[h])))
        return [pa.array(out, pa.string())]
    cols = [c for c in (keep or pages.columns) if c != "text"]
    need = list(dict.fromkeys([*cols, "url", "html"]))
    hosted = _hosted(pages.select(*need))
    # Spark broadcasts the rules only where the written table is small; else a hot host's pages are split by AQE.
    ruled = hosted.join(rules, "__host", "left")
    return add_columns(ruled, run, "text string", cols)
