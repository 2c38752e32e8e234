"""Clean text from documents in HTML, rich-text JSON, Markdown, wiki and LaTeX markup.

Every document becomes one tree, whatever its markup: elements, nodes, and
what looks like markup inside running text are its nodes. Boosted trees give
each node the probability of being a heading, list item, code block, formula
or nothing, from its tag, attribute tokens, depth, the density of its subtree
and its siblings. Decoding takes the best labelling in which nothing lies
inside a code block or a formula and no heading inside a heading.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomgrid import storage
from fathomgrid.llm.boosting import Trees
from fathomgrid.operators.nested import load_document

KINDS = ("none", "heading", "list_item", "code_block", "formula")
#: Labelled snippets drawn for training, and the seed of the draw.
SNIPPETS, SEED = 2600, 17

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCK = frozenset("address article aside blockquote dd details div dl dt figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td th thead tr ul".split())
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"})}
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^<>]*>|<(/?)([a-zA-Z][\w:-]*)((?:\s+(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)?)(/?)>", re.S)
_KNOWN = re.compile(r"</?(?:h[1-6]|ul|ol|li|dl|dt|dd|p|br|pre|code|div|span|table|tr|td|th|b|i|em|strong|a|blockquote|script|style|img|font|math|hr|sub|sup|u|s|del|ins)(?:\s[^<>]*)?/?>", re.I)
_ESCAPED = re.compile(r"&lt;/?[a-zA-Z]")
_ATTRIBUTE = re.compile(r"[a-z]+")
_SUSPECT = re.compile(r"[\\$`{<~]|&lt;|^[ \t]*(?:[-*+#•‣◦=]|\d{1,18}[.)][ \t]|h[1-6]\.[ \t])|^[ \t]*[=-]{3,}[ \t]*$", re.M)
# Environments and commands of LaTeX, macros of wikis.
_REGION = re.compile(
    r"(?P<pre><pre\b[^<>]*>.*?</pre\s*>)"
    r"|(?P<source><(?P<st>syntaxhighlight|source|nowiki)\b[^<>]*>.*?</(?P=st)\s*>)"
    r"|^[ \t]*(?P<tick>`{3,}|~{3,})[^\n`]*\n(?P<fence>.*?)(?:\n[ \t]*(?P=tick)[`~]*[ \t]*$|\n?\Z)"
    r"|(?P<macro>\{(?P<mt>code|noformat)(?::[^{}\n]*)?\}.*?\{(?P=mt)\})"
    r"|(?P<listing>\\begin\{(?P<lt>verbatim\*?|lstlisting|minted|Verbatim|alltt)\}.*?\\end\{(?P=lt)\})"
    r"|(?P<environment>\\begin\{(?P<et>equation\*?|align\*?|displaymath|math|gather\*?|eqnarray\*?|multline\*?)\}.*?\\end\{(?P=et)\})"
    r"|(?P<script><script\b[^<>]*>.*?</script\s*>)"
    r"|(?P<style><style\b[^<>]*>.*?</style\s*>)"
    r"|(?P<mathml><math\b[^<>]*>.*?</math\s*>)"
    r"|(?P<macromath>\{(?P<ft>latex|math|mathblock|mathinline)(?::[^{}\n]*)?\}.*?\{(?P=ft)\})"
    r"|(?P<double>(?<![\\$])\$\$(?!\$)[^$]+?\$\$)"
    r"|(?P<bracket>\\\[.+?\\\])"
    r"|(?P<paren>\\\(.+?\\\))"
    r"|(?P<dollar>(?<![\\$\w])\$(?=\S)[^$\n]+(?<=\S)\$(?![\w$]))",
    re.S | re.M,
)
_LINE = re.compile(
    r"[ \t]*(?:>[ \t]*)*(?:"
    r"(?P<atx>#{1,6})[ \t]+(?P<atx_t>\S.*)"
    r"|(?P<wiki>h[1-6]\.)[ \t]+(?P<wiki_t>\S.*)"
    r"|(?P<equals>={2,6})[ \t]*(?P<equals_t>[^=\s](?:.*[^=\s])?)[ \t]*=*[ \t]*"
    r"|(?P<section>\\(?:part|chapter|section|subsection|subsubsection|paragraph)\*?(?:\[[^\]]*\])?\{)(?P<section_t>.*)\}.*"
    r"|(?P<item>\\item\b)(?:\[[^\]]*\])?[ \t]*(?P<item_t>.*)"
    r"|(?P<bullet>(?:[*]{1,6}|[-+•‣◦–]|#{1,6}(?=[*#-])[*#-]*))[ \t]+(?P<bullet_t>\S.*)"
    r"|(?P<number>\d{1,18}[.)]|\(?[a-z]\))[ \t]+(?P<number_t>\S.*)"
    r")$"
)
_NUMBERED = re.compile(r"^[ \t]*(?:>[ \t]*)*(\d{1,18})[.)][ \t]+\S", re.M)
_UNDERLINE = re.compile(r"[ \t]*(=+|-{3,})[ \t]*$")
_MATHS = re.compile(r"[\\^_=<>+*/]|\b[a-z]\b")

TAGS = [
    "other", "#doc", "p", "div", "span", "a", "b", "em", "font", "blockquote", "table", "tr", "td", "ul", "ol", "li", "dl", "dt", "dd", "pre", "code", "img", "script", "math", "h1", "h2", "h3", "h4", "h5", "h6",
    "doc", "paragraph", "heading", "bulletList", "orderedList", "taskList", "decisionList", "listItem", "taskItem", "decisionItem", "codeBlock", "extension", "inlineExtension", "bodiedExtension", "panel", "expand", "nestedExpand", "rule", "media", "mention", "inlineCard", "tableRow", "tableCell", "tableHeader", "x-unknown",
    "~pre", "~source", "~fence", "~macro", "~listing", "~environment", "~script", "~mathml", "~macromath", "~double", "~bracket", "~paren", "~dollar", "~atx", "~wiki", "~equals", "~section", "~item", "~bullet", "~number", "~setext",
]
_TAG_ID = {t: i for i, t in enumerate(TAGS)}
_LEAF_TEXT = frozenset(["pre", "script", "math"])
_HINTS = ("math", "latex", "tex", "code", "formula", "equation", "katex", "panel")


class Dom:
    """A document's tree: per node tag, attribute tokens, parent and the texts and children in it in order; numbers that lines begin with."""

    __slots__ = ("attrs", "items", "numbers", "parents", "tags")

    def __init__(self) -> None:
        self.tags, self.attrs, self.parents, self.items = ["#doc"], [""], [-1], [[]]
        self.numbers: set[int] = set()

    def add(self, tag: str, parent: int, attrs: str = "", text: str = "") -> int:
        k = len(self.tags)
        self.tags.append(tag)
        self.attrs.append(attrs)
        self.parents.append(parent)
        self.items.append([text] if text else [])
        self.items[parent].append(k)
        return k

    def text(self, parent: int, text: str) -> None:
        """Add text to a node; next to other text it is one with it."""
        own = self.items[parent]
        if own and isinstance(own[-1], str):
            own[-1] += text
        else:
            own.append(text)


def read_html(dom: Dom, root: int, source: str) -> None:
    """Add the elements of an HTML fragment below a node, the way browsers mend what is left open."""
    stack = [root]
    names = [""]
    at = 0
    for m in _TAG.finditer(source):
        if m.start() < at:
            continue
        if m.start() > at:
            dom.text(stack[-1], html.unescape(source[at : m.start()]))
        at = m.end()
        name = m.group(2)
        if not name:
            continue
        name = name.lower()
        if m.group(1):
            if name in names:
                while names[-1] != name:
                    names.pop()
                    stack.pop()
                names.pop()
                stack.pop()
            if name in _BLOCK:
                dom.text(stack[-1], "\n")
            continue
        if name == "br":
            dom.text(stack[-1], "\n")
            continue
        if name in ("script", "style", "pre", "math", "textarea", "title"):
            end = re.compile(rf"</{name}\s*>", re.I).search(source, at)
            inner = source[at : end.start() if end else len(source)]
            at = end.end() if end else len(source)
            if name == "style" or name == "script" and "math" not in m.group(3):
                continue
            text = inner if name == "script" else html.unescape(_TAG.sub("", inner))
            dom.add(name, stack[-1], " ".join(_ATTRIBUTE.findall(m.group(3).lower())), text)
            continue
        if name in _CLOSES:
            closes, until = _CLOSES[name]
            for i in range(len(names) - 1, 0, -1):
                if names[i] in until:
                    break
                if names[i] in closes:
                    del names[i:], stack[i:]
                    break
        elif name in _BLOCK and names[-1] == "p":
            names.pop()
            stack.pop()
        node = dom.add(name, stack[-1], " ".join(_ATTRIBUTE.findall(m.group(3).lower())) if m.group(3) else "")
        if name == "img" and (alt := re.search(r"alt\s*=\s*(?:\"([^\"]*)\"|'([^']*)')", m.group(3))):
            dom.text(node, html.unescape(alt.group(1) or alt.group(2) or ""))
        if name not in _VOID and not m.group(4):
            stack.append(node)
            names.append(name)
    if at < len(source):
        dom.text(stack[-1], html.unescape(source[at:]))


def read_adf(dom: Dom, root: int, document: dict) -> None:
    """Add the nodes of a rich-text JSON document below a node."""
    stack = [(root, document)]
    while stack:
        parent, node = stack.pop()
        kind = node.get("type")
        if kind == "text":
            text = node.get("text")
            if isinstance(text, str):
                marked = any(isinstance(m, dict) and m.get("type") == "code" for m in node.get("marks") or [])
                dom.text(parent, text.translate(_HIDE) if marked else text)
            continue
        if kind == "hardBreak":
            dom.text(parent, "\n")
            continue
        attrs = node.get("attrs")
        attrs = attrs if isinstance(attrs, dict) else {}
        if kind in ("mention", "emoji", "inlineCard", "status", "date"):
            shown = attrs.get("text") or attrs.get("shortName") or attrs.get("url") or ""
            dom.text(parent, str(shown))
            continue
        tag = kind if isinstance(kind, str) and kind in _TAG_ID else "x-unknown"
        hints = ""
        if tag in ("extension", "inlineExtension", "bodiedExtension"):
            hints = " ".join(_ATTRIBUTE.findall(f"{attrs.get('extensionKey', '')} {attrs.get('extensionType', '')}".lower()))
            body = attrs.get("parameters")
            body = body.get("body") if isinstance(body, dict) else None
            k = dom.add(tag, parent, hints, body if isinstance(body, str) else "")
        else:
            k = dom.add(tag, parent)
        inner = node.get("content")
        if isinstance(inner, list):
            stack.extend([(k, x) for x in inner if isinstance(x, dict)][::-1])


#: Marks inside inline code are not markup: they are read as private characters and shown as themselves.
_HIDDEN = "\\$`{<~#*+=&-"
_HIDE = {ord(c): 0xE000 + i for i, c in enumerate(_HIDDEN)}
_SHOW = {0xE000 + i: c for i, c in enumerate(_HIDDEN)}


def _lines(dom: Dom, parent: int, text: str) -> None:
    """Add the lines of a running text below a node: what looks like a heading or a list item as nodes."""
    before: str | None = None
    for line in text.split("\n"):
        if before is not None and before.strip() and _UNDERLINE.match(line) and not _marked(dom, before):
            dom.add("~setext", parent, line.strip()[0] == "=" and "equals" or "", before.strip())
            before = None
            continue
        if before is not None:
            _line(dom, parent, before)
        before = line
    if before is not None:
        _line(dom, parent, before)


def _marked(dom: Dom, line: str) -> re.Match[str] | None:
    """A line's mark of a heading or an item. A number of four digits or more counts next to the one before or after it, else it is a year or an amount."""
    m = _LINE.match(line)
    if m and m["number"] and len(number := m["number"][:-1]) > 3 and number.isdigit() and dom.numbers.isdisjoint((int(number) - 1, int(number) + 1)):
        return None
    return m


def _line(dom: Dom, parent: int, line: str) -> None:
    m = _marked(dom, line)
    if m and m.lastgroup:
        tag = m.lastgroup[:-2]
        dom.add("~" + tag, parent, "", m.group(m.lastgroup))
    else:
        dom.text(parent, line + "\n")


def _running(dom: Dom, parent: int, text: str) -> None:
    """Add a running text below a node, markup in it as nodes."""
    if _ESCAPED.search(text):
        text = html.unescape(text)
    at = 0
    for m in _REGION.finditer(text):
        if m.start() > at:
            _plain(dom, parent, text[at : m.start()])
        at = m.end()
        tag = next(g for g in ("pre", "source", "fence", "macro", "listing", "environment", "script", "style", "mathml", "macromath", "double", "bracket", "paren", "dollar") if m.group(g) is not None)
        if tag == "style" or tag == "script" and "math" not in m.group(0)[:80]:
            continue
        inner = m.group(tag)
        if tag in ("pre", "source", "script", "mathml"):
            inner = html.unescape(_TAG.sub("", inner))
        elif tag in ("macro", "macromath"):
            inner = inner[inner.index("}") + 1 : inner.rindex("{")]
        elif tag in ("listing", "environment"):
            inner = inner[inner.index("}") + 1 : inner.rindex("\\end")]
        elif tag != "fence":
            inner = inner.strip("$") if tag in ("double", "dollar") else inner[2:-2]
        dom.add("~" + tag, parent, "", inner.strip("\n"))
    if at < len(text):
        _plain(dom, parent, text[at:] if at else text)


def _plain(dom: Dom, parent: int, text: str) -> None:
    if "<" in text and _KNOWN.search(text):
        first = len(dom.tags)
        read_html(dom, parent, text)
        for k in range(first, len(dom.tags)):
            if dom.tags[k] not in _LEAF_TEXT:
                own, dom.items[k] = dom.items[k], []
                for x in own:
                    _lines(dom, k, x) if isinstance(x, str) else dom.items[k].append(x)
        return
    _lines(dom, parent, text)


_RAW = frozenset(["pre", "script", "math", "codeBlock", "extension", "inlineExtension", "img", "code"])


def read(text: str | None, field: str) -> Dom | None:
    """Tree of a text; fields that end in _adf hold JSON, others HTML. None where there is nothing readable."""
    if not text:
        return None
    dom = Dom()
    if field.endswith("_adf"):
        document = load_document(text)
        if document is None:
            return None
        read_adf(dom, 0, document)
    else:
        read_html(dom, 0, text)
    dom.numbers = {int(n) for k, own in enumerate(dom.items) if dom.tags[k] not in _RAW for x in own if isinstance(x, str) for n in _NUMBERED.findall(x)}
    for k in range(len(dom.tags)):
        if dom.tags[k] in _RAW:
            continue
        own = dom.items[k]
        if any(isinstance(x, str) and _SUSPECT.search(x) for x in own):
            dom.items[k] = []
            for x in own:
                if isinstance(x, str):
                    _running(dom, k, x) if _SUSPECT.search(x) else dom.text(k, x)
                else:
                    dom.items[k].append(x)
    return dom


def features(dom: Dom) -> list[tuple[int, ...]]:
    """A tuple of small whole numbers per node."""
    n = len(dom.tags)
    size, below, children = [0] * n, [0] * n, [0] * n
    depth, raw = [0] * n, [0] * n
    order = sorted(range(1, n), key=lambda k: -k)
    for k in range(n):
        size[k] += sum(len(x) for x in dom.items[k] if isinstance(x, str))
    for k in order:
        p = dom.parents[k]
        size[p] += size[k]
        below[p] += below[k] + 1
        children[p] += 1
    same: dict[tuple[int, str], int] = {}
    for k in range(1, n):
        p = dom.parents[k]
        depth[k] = min(depth[p] + 1, 12)
        raw[k] = raw[p] or int(dom.tags[p] in _RAW)
        key = (p, dom.tags[k])
        same[key] = same.get(key, 0) + 1
    out = []
    for k in range(n):
        tag, attrs = dom.tags[k], dom.attrs[k]
        p = dom.parents[k]
        hints = 0
        if attrs:
            for i, h in enumerate(_HINTS):
                if h in attrs:
                    hints |= 1 << i
        marks = 0
        if tag[0] == "~" or tag in _RAW:
            t = dom.items[k][0] if dom.items[k] and isinstance(dom.items[k][0], str) else ""
            words = t.split()
            marks = (
                ("\\" in t) | (("^" in t or "_" in t) << 1) | ((t[:1].isdigit()) << 2) | ((len(words) > 3) << 3)
                | ((sum(len(w) > 2 and w.isalpha() for w in words) * 2 > len(words)) << 4) | ((t[-1:] in ".!?") << 5) | (("=" in t or "<" in t) << 6)
            )
        out.append((
            _TAG_ID.get(tag, 0), _TAG_ID.get(dom.tags[p], 0) if p >= 0 else 0, hints, marks, depth[k], min(children[k], 6), min(size[k].bit_length(), 10),
            min((size[k] // (below[k] + 1)).bit_length(), 9), min(children[p] if p >= 0 else 0, 8), min(same.get((p, tag), 0), 8), raw[k],
        ))
    return out


def vectors(rows: list[tuple[int, ...]]) -> np.ndarray:
    """Features of the trees: tags and flags as one column each, numbers as they are."""
    a = np.array(rows, np.int64).reshape(-1, 11)
    tag = (a[:, :1] == np.arange(len(TAGS))).astype(np.int8)
    parent = (a[:, 1:2] == np.array([_TAG_ID[t] for t in ("pre", "code", "codeBlock", "li", "listItem", "p", "paragraph", "#doc")])).astype(np.int8)
    hints = (a[:, 2:3] >> np.arange(len(_HINTS))) & 1
    marks = (a[:, 3:4] >> np.arange(7)) & 1
    return np.hstack([tag, parent, hints, marks, a[:, 4:]]).astype(np.int8)


# Words, formulas and code of which the labelled snippets are made.
_WORDS = "report server table page link field upload filter month record index value sync list draft cache ticket user note path result panel queue label check change error build test size date".split()
_SHORT = ["a b", "x", "OK", "no 2", "12 %", "3 of 4 x", "v1.2 is up", "to do", "A_b = 1", "1 2 3", "Шаги", "步骤", "C++ / C#", "is it on?", "go!", "a/b"]
_FORMULAS = [r"a^{2}+b", r"\frac{x}{y}", r"\sqrt{n+1}", r"\sum_{k=0}^{n} k", r"x_i \le y", r"e^{i\pi}", r"\alpha + \beta", r"p(x)=1", r"\int_0^1 f", r"n \log n", r"y = m x + b", r"O(n^2)"]
_CODE = ["print(x)", "if a < 3:\n    go()", "SELECT a FROM b;", "make all\n* done", "- name: x\n- run: y", "# comment\nls -l", "<li>no</li>", "\\section{no}", "var z = [1, 2];", "## none\n1. no"]
_MONEY = ["from $5 to $9 a seat", "costs $20 or $30 now", "$HOST and $PATH are set", "pay $3, not $4", "US$7 and $8 each"]
#: Labelled snippets: where they stand, the snippet, and the kind of its nodes by tag; other nodes are of no kind.
_TABLE: list[tuple[str, str, dict[str, str]]] = [
    *[("html", f"<h{i} id='s'><a name='n'></a>{{t}}</h{i}>", {f"h{i}": "heading"}) for i in range(1, 7)], *[("html", f"<h{i} class='x'>{{t}}</h{i}>", {f"h{i}": "heading"}) for i in range(1, 7)],
    ("html", "<ul class='alternate'><li>{t}</li><li>{t}<ul><li>{t}</li></ul></li></ul>", {"li": "list_item"}), ("html", "<ol style='margin:0'><li>{t}<li>{t}<li>{s}</ol>", {"li": "list_item"}), ("html", "<ul><li>{t}</li></ul>", {"li": "list_item"}),
    ("html", "<div class='code panel'><div class='codeContent'><pre class='code-java'>{c}</pre></div></div>", {"pre": "code_block"}), ("html", "<pre>{c}</pre>", {"pre": "code_block"}), ("html", "<pre><code>{c}</code></pre>", {"pre": "code_block"}), ("html", "<pre class='x'>{c}</pre>", {"pre": "code_block"}),
    ("html", "<p>{s} <code>{w}</code> {s}</p>", {}), ("html", "<p>{s}</p>", {}), ("html", "<p>{s}<br/>{s}</p>", {}), ("html", "<div><span>{s}</span></div>", {}), ("html", "<p><font color='#c00'>{s}</font></p>", {}), ("html", "<blockquote><p>{s}</p></blockquote>", {}),
    ("html", "<table><tr><td>{w}</td><td>7</td></tr><tr><th>{w}</th></tr></table>", {}), ("html", "<p>{s} <a href='u' class='external-link'>{w}</a></p>", {}), ("html", "<p>{s}<img src='/s.png' alt=''/></p>", {}), ("html", "<p><img src='/a.png' alt='{w}'/></p>", {}), ("html", "<p><b>{t}</b> <em>{w}</em></p>", {}),
    ("html", "<p>{s} <script type='math/tex'>{f}</script> {w}</p>", {"script": "formula"}), ("html", "<script type='math/tex; mode=display'>{f}</script>", {"script": "formula"}), ("html", "<span class='math display'>{f}</span>", {"span": "formula"}), ("html", "<p>{w} <span class='math inline'>{f}</span></p>", {"span": "formula"}),
    ("html", "<img class='latex' alt='{f}' src='/t.png'>", {"img": "formula"}), ("html", "<p>{w} <img class='tex' alt='{f}' src='/t.png'> {w}</p>", {"img": "formula"}), ("html", "<div class='equation'>{f}</div>", {"div": "formula"}), ("html", "<math><mi>x</mi></math>", {"math": "formula"}), ("html", "<span class='katex'>{f}</span>", {"span": "formula"}),
    ("text", "{s}", {}), ("text", "{s} {s}", {}), ("text", "{s} The bound is ${f}$ here.", {"~dollar": "formula"}), ("text", "${f}$", {"~dollar": "formula"}), ("text", "{s} \\({f}\\) {w}.", {"~paren": "formula"}), ("text", "\\[{f}\\]", {"~bracket": "formula"}), ("text", "$${f}$$", {"~double": "formula"}), ("text", "{s} {m}.", {}),
    ("text", "{{latex}}{f}{{latex}}", {"~macromath": "formula"}), ("text", "{w} {{math}}{f}{{math}}", {"~macromath": "formula"}), ("text", "\\begin{{equation}}\n{f}\n\\end{{equation}}", {"~environment": "formula"}), ("text", "\\begin{{align*}}\n{f}\n\\end{{align*}}", {"~environment": "formula"}), ("text", "<math>{f}</math>", {"~mathml": "formula"}), ("text", "<script type=\"math/tex\">{f}</script>", {"~script": "formula"}),
    ("text", "## {t}", {"~atx": "heading"}), ("text", "# {t}", {"~atx": "heading"}), ("text", "### {t} ###", {"~atx": "heading"}), ("text", "h2. {t}", {"~wiki": "heading"}), ("text", "h4. {w}", {"~wiki": "heading"}), ("text", "== {t} ==", {"~equals": "heading"}), ("text", "=== {t} ===", {"~equals": "heading"}), ("text", "{t}\n=====", {"~setext": "heading"}), ("text", "{t}\n-----", {"~setext": "heading"}),
    ("text", "\\section{{{t}}}", {"~section": "heading"}), ("text", "\\subsection*{{{t}}}", {"~section": "heading"}), ("text", "\\subsubsection{{{t}}}", {"~section": "heading"}),
    ("text", "* {t}\n* {t}\n** {t}", {"~bullet": "list_item"}), ("text", "- {t}\n- {s}", {"~bullet": "list_item"}), ("text", "+ {t}\n  - {t}\n  - {t}", {"~bullet": "list_item"}), ("text", "• {t}\n• {t}", {"~bullet": "list_item"}), ("text", "- {t}", {"~bullet": "list_item"}), ("text", "1. {t}\n2. {t}\n  1. {t}", {"~number": "list_item"}), ("text", "1) {t}\n2) {t}", {"~number": "list_item"}), ("text", "# {t}\n# {t}\n# {t}", {"~atx": "list_item"}), ("text", "# {t}\n# {t}", {"~atx": "list_item"}), ("text", "## {t}\n## {t}\n## {t}\n## {t}", {"~atx": "list_item"}),
    ("text", "{s}\n* {t}\n* {t}", {"~bullet": "list_item"}), ("text", "\\begin{{itemize}}\n\\item {t}\n\\item {t}\n\\end{{itemize}}", {"~item": "list_item"}), ("text", "\\begin{{enumerate}}\n\\item {t}\n\\end{{enumerate}}", {"~item": "list_item"}),
    ("text", "```python\n{c}\n```", {"~fence": "code_block"}), ("text", "~~~\n{c}\n~~~", {"~fence": "code_block"}), ("text", "{{code:java}}\n{c}\n{{code}}", {"~macro": "code_block"}), ("text", "{{noformat}}\n{c}\n{{noformat}}", {"~macro": "code_block"}), ("text", "\\begin{{verbatim}}\n{c}\n\\end{{verbatim}}", {"~listing": "code_block"}), ("text", "\\begin{{lstlisting}}\n{c}\n\\end{{lstlisting}}", {"~listing": "code_block"}),
    ("text", "<h3>{t}</h3>", {"h3": "heading"}), ("text", "<h2>{t}</h2>", {"h2": "heading"}), ("text", "<ul><li>{t}</li><li>{t}</li></ul>", {"li": "list_item"}), ("text", "<pre><code>{c}</code></pre>", {"~pre": "code_block"}), ("text", "<syntaxhighlight lang='x'>{c}</syntaxhighlight>", {"~source": "code_block"}), ("text", "{s} <b>{w}</b>", {}), ("text", "Range 5 < x < 9 and C# 4, a*b*c.", {}), ("text", "Path \\\\files\\share\\{w} is gone.", {}),
]
_ADF = {"heading": "heading", "listItem": "list_item", "taskItem": "list_item", "decisionItem": "list_item", "codeBlock": "code_block"}


def _examples() -> tuple[list[tuple[int, ...]], list[int]]:
    """Features and kinds of the nodes of the labelled snippets, each drawn with other words and surroundings."""
    r = random.Random(SEED)
    words = lambda n: " ".join(r.choice(_WORDS) for _ in range(n))
    rows: list[tuple[int, ...]] = []
    kinds: list[int] = []

    def fill(snippet: str) -> str:
        return re.sub(r"\{([tswfcm])\}", lambda m: {"t": lambda: r.choice(_SHORT) if r.random() < 0.15 else words(r.randint(1, 9)).capitalize(), "s": lambda: words(r.randint(4, 18)).capitalize() + ".", "w": lambda: r.choice(_WORDS), "f": lambda: r.choice(_FORMULAS), "c": lambda: r.choice(_CODE), "m": lambda: r.choice(_MONEY)}[m.group(1)](), snippet).replace("{{", "{").replace("}}", "}")

    def keep(dom: Dom, labels: dict[str, str]) -> None:
        rows.extend(features(dom))
        kinds.extend(KINDS.index(labels.get(t, "none")) for t in dom.tags)

    for _ in range(SNIPPETS):
        place, snippet, labels = r.choice(_TABLE)
        body = fill(snippet)
        if place == "html":
            around = r.choice(["{}", "{}\n", "<p>" + fill("{s}") + "</p>{}", "<div>{}</div>", "<blockquote>{}</blockquote>"])
            keep(read(around.replace("{}", body), "rendered") or Dom(), labels)
        elif r.random() < 0.5:
            keep(read("<p>" + html.escape(body, quote=False).replace("\n", r.choice(["\n", "<br/>"])) + "</p>" + r.choice(["", "<p>" + fill("{s}") + "</p>"]), "rendered") or Dom(), labels)
        else:
            dom = Dom()
            read_adf(dom, 0, {"type": "doc", "content": [{"type": "paragraph", "content": [{"type": "text", "text": body}]}] + [{"type": "paragraph", "content": [{"type": "text", "text": fill("{s}")}]}] * r.randint(0, 2)})
            for k in range(len(dom.tags)):
                own, dom.items[k] = dom.items[k], []
                for x in own:
                    _running(dom, k, x) if isinstance(x, str) else dom.items[k].append(x)
            keep(dom, labels)
    for _ in range(SNIPPETS // 2):
        text = lambda: {"type": "text", "text": fill("{s}")}
        paragraph = lambda: {"type": "paragraph", "content": [text()]}
        makers = [
            lambda: {"type": "heading", "attrs": {"level": 2}, "content": [text()]}, lambda: {"type": "heading", "content": [{"type": "text", "text": r.choice([*_SHORT, words(2)])}]}, lambda: {"type": "heading", "content": [{"type": "text", "text": words(3)}]}, lambda: {"type": "bulletList", "content": [{"type": "listItem", "content": [paragraph()]} for _ in range(r.randint(1, 4))]},
            lambda: {"type": "orderedList", "content": [{"type": "listItem", "content": [paragraph(), {"type": "bulletList", "content": [{"type": "listItem", "content": [paragraph()]}]}]}]}, lambda: {"type": "codeBlock", "content": [{"type": "text", "text": r.choice(_CODE)}]},
            lambda: {"type": "extension", "attrs": {"extensionKey": r.choice(["mathblock", "latex-formula", "math-inline", "equation"]), "parameters": {"body": r.choice(_FORMULAS)}}}, lambda: {"type": "extension", "attrs": {"extensionKey": r.choice(["toc", "chart", "jira-issues", "children"])}},
            lambda: {"type": "taskList", "content": [{"type": "taskItem", "content": [text()]}]}, lambda: {"type": "panel", "content": [paragraph()]}, lambda: {"type": "expand", "content": [paragraph()]}, lambda: {"type": "blockquote", "content": [paragraph()]}, lambda: {"type": "rule"}, lambda: {"type": "table", "content": [{"type": "tableRow", "content": [{"type": "tableCell", "content": [paragraph()]}]}]}, lambda: {"type": "x-unknown"},
        ]
        dom = Dom()
        nodes = [r.choice([paragraph, *makers])() for _ in range(r.randint(1, 5))]
        if r.random() < 0.2:
            nodes = [{"type": r.choice(["panel", "expand", "blockquote"]), "content": nodes}]
        read_adf(dom, 0, {"type": "doc", "content": nodes})
        rows.extend(features(dom))
        kinds.extend(KINDS.index("formula" if t == "extension" and any(h in a for h in ("math", "latex", "formula", "equation")) else _ADF.get(t, "none")) for t, a in zip(dom.tags, dom.attrs))
    return rows, kinds


class Labeller:
    """The trained trees; predictions are kept by feature tuple, as few tuples recur."""

    def __init__(self) -> None:
        rows, kinds = _examples()
        self.trees = Trees().fit(vectors(rows), np.array(kinds), len(KINDS))
        self.known: dict[tuple[int, ...], tuple[float, ...]] = {}

    def scores(self, rows: list[tuple[int, ...]]) -> list[tuple[float, ...]]:
        """Log probabilities of the kinds of each node."""
        new = [r for r in dict.fromkeys(rows) if r not in self.known]
        if new:
            self.known.update(zip(new, map(tuple, self.trees.log_probabilities(vectors(new)).tolist())))
        return [self.known[r] for r in rows]


@lru_cache(1)
def labeller() -> Labeller:
    """Trained once per process on the labelled snippets: a bounded set, the same whatever the data."""
    return Labeller()


def decode(dom: Dom, scores: list[tuple[float, ...]]) -> list[int]:
    """Best kinds of the nodes of a tree.

    A code block or formula allows nothing below it and a heading no heading,
    list item or code block; the labelling of highest probability under these
    rules wins.
    """
    best = [max(range(len(KINDS)), key=s.__getitem__) for s in scores]
    closed = [k for k in range(len(best)) if best[k] in (1, 3, 4)]
    if not closed:
        return best
    inside: dict[int, list[int]] = {}
    for k in range(len(best)):
        p = dom.parents[k]
        while best[k] and p >= 0:
            if best[p] in (3, 4) or best[p] == 1 and best[k] in (1, 2, 3):
                inside.setdefault(p, []).append(k)
            p = dom.parents[p]
    for p in sorted(inside, key=lambda k: k):
        rivals = [k for k in inside[p] if best[k]]
        if not best[p] or not rivals:
            continue
        if scores[p][best[p]] - scores[p][0] >= sum(scores[k][best[k]] - scores[k][0] for k in rivals) or dom.tags[p] in _RAW:
            for k in rivals:
                best[k] = 0
        else:
            best[p] = 0
    return best


def kinds(text: str | None, field: str, model: Labeller) -> tuple[Dom, list[int]] | None:
    dom = read(text, field)
    if dom is None:
        return None
    return dom, decode(dom, model.scores(features(dom)))


def render(dom: Dom, best: list[int]) -> str:
    """Clean text of a tree; headings begin with `# `, list items with `- `, code is fenced, formulas stand between `$`."""
    out: list[str] = []

    def enter(k: int) -> list[str | int]:
        """What stands for a node: texts, nodes still to enter, and what follows them."""
        kind, tag = best[k], dom.tags[k]
        if kind in (3, 4):
            own = "".join(x for x in dom.items[k] if isinstance(x, str))
            return ["\n```\n" + own.strip("\n").translate(_SHOW) + "\n```\n"] if kind == 3 else ["$" + own.strip().translate(_SHOW) + "$"]
        parts: list[str | int] = []
        if kind:
            parts.append("\n# " if kind == 1 else "\n- ")
        elif tag in _BLOCK or tag in ("paragraph", "tableRow", "panel", "expand"):
            parts.append("\n")
        elif tag in ("td", "th", "tableCell", "tableHeader"):
            parts.append(" ")
        parts += [x.translate(_SHOW) if isinstance(x, str) else x for x in dom.items[k]]
        if kind or tag in _BLOCK or tag == "paragraph":
            parts.append("\n")
        return parts

    stack: list[str | int] = [0]
    while stack:
        top = stack.pop()
        if isinstance(top, str):
            out.append(top)
        else:
            stack += reversed(enter(top))
    text = re.sub(r"[ \t\u00a0]+\n", "\n", "".join(out))
    return re.sub(r"\n{3,}", "\n\n", text).strip()


FIELDS = ("description_adf", "body_adf", "rendered_body")


def fields(tickets: DataFrame) -> DataFrame:
    """Marked-up texts of tickets: load_id, field, comment_pos (-1 for the description), text; blank ones are left out."""
    entry = lambda name, pos, text: F.struct(F.lit(name).alias("field"), pos.cast("int").alias("comment_pos"), text.alias("text"))
    described = F.array(entry(FIELDS[0], F.lit(-1), F.col("description_adf")))
    each = F.flatten(F.transform("comments", lambda c, i: F.array(entry(FIELDS[1], i, c["body_adf"]), entry(FIELDS[2], i, c["rendered_body"]))))
    every = tickets.select("load_id", F.explode(F.concat(described, F.coalesce(each, F.slice(described, 1, 0)))).alias("f")).select("load_id", "f.*")
    return every.where(F.col("text").isNotNull() & (F.col("text") != ""))


def elements(texts: DataFrame) -> DataFrame:
    """Elements to keep in each marked-up text: load_id, field, comment_pos, kind, seq (1..n within field and kind).

    Unreadable JSON holds none, JSON encoded twice counts as the document. A
    text is one row; nothing is shuffled. Repeated rows give theirs again.
    """
    schema = "load_id long, field string, comment_pos int, kind string, seq int"

    model = texts.sparkSession.sparkContext.broadcast(labeller())

    def batches(it: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
        model = model.value
        for b in it:
            at, kind, seq = [], [], []
            for i, (f, t) in enumerate(zip(b.column(1).to_pylist(), b.column(3).to_pylist())):
                got = kinds(t, f, model)
                if got is None:
                    continue
                counts = [0] * len(KINDS)
                for k in got[1]:
                    if k:
                        counts[k] += 1
                        at.append(i)
                        kind.append(KINDS[k])
                        seq.append(counts[k])
            rows = b.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), rows.column(2), pa.array(kind, pa.string()), pa.array(seq, pa.int32())], names=["load_id", "field", "comment_pos", "kind", "seq"])

    return storage.spread(texts.select(F.col("load_id").cast("long").alias("load_id"), "field", F.col("comment_pos").cast("int").alias("comment_pos"), "text")).mapInArrow(batches, schema)


def clean(texts: DataFrame) -> DataFrame:
    """Clean text of each marked-up text: load_id, field, comment_pos, text; null where JSON is unreadable."""
    schema = "load_id long, field string, comment_pos int, text string"

    model = texts.sparkSession.sparkContext.broadcast(labeller())

    def batches(it: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
        model = model.value
        for b in it:
            got = [kinds(t, f, model) for f, t in zip(b.column(1).to_pylist(), b.column(3).to_pylist())]
            shown = [render(*g).encode("utf-8", "replace").decode() if g else None for g in got]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(shown, pa.string())], names=["load_id", "field", "comment_pos", "text"])

    return storage.spread(texts.select(F.col("load_id").cast("long").alias("load_id"), "field", F.col("comment_pos").cast("int").alias("comment_pos"), "text")).mapInArrow(batches, schema)
