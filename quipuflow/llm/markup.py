"""Problem 7: HTML, Markdown, wiki text and LaTeX as clean blocks.

A page becomes a tree: elements, environments and list levels hold leaf blocks, which are regions
whose source is kept as it stands (code, formulas) and the text between block tags, line prefixes and
blank lines. Regions that give nothing (comments, scripts, heads, templates, notes) are taken out
before. The kind of each leaf is decided by a linear-chain conditional random field over the page's
leaves, decoded by Viterbi, from its tag or prefix, its ancestors, the shape of its text, and the gaps
and tags around it; then signs of markup inside the leaf are taken away.

The field is trained here on a bounded sample of pages (SAMPLE_PAGES). A leaf is labelled if its tag has one meaning in all
four languages (<h2>, \\section, == ==, <li>, <p>, fences and the like). Leaves whose sign means
different things ("##" is a heading or a nested item) are left without a label, and the field is
trained on the likelihood of the labelled ones with those summed out. Each page is learnt twice, once
with its own tags withheld, so that ancestors, shape, gaps and neighbours have to tell the kind from
evidence that isn't the label; they decide where the sign does not.

A null or blank content has no blocks; a page without markup gives its paragraphs. Repeated pages
are treated alike. Extra columns are left out.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipuflow.llm.crf import Crf
from quipuflow.session import spread

KINDS = ("heading", "paragraph", "item", "code", "formula")
#: Labelled pages on which the field is trained: those of the smallest hashes of their ids.
SAMPLE_PAGES = 400

_RAW = re.compile(
    r"""
    (?P<fence>^(?P<f>```+|~~~+)[^\n]*\n(?P<fbody>.*?)^(?P=f)[ \t]*$)
  | (?P<pre><(?P<pt>pre|syntaxhighlight|source)\b[^>]*>(?P<pbody>.*?)</(?P=pt)\s*>)
  | (?P<verb>\\begin\{(?P<vt>verbatim|lstlisting|minted)\}(?:\[[^\]\n]*\])?(?P<vbody>.*?)\\end\{(?P=vt)\})
  | (?P<eq>\\begin\{(?P<et>equation\*?|align\*?|displaymath|gather\*?)\}(?P<ebody>.*?)\\end\{(?P=et)\})
  | (?P<dd>\$\$(?P<dbody>.+?)\$\$)
  | (?P<br>\\\[(?P<bbody>.+?)\\\])
  | (?P<math><math\b[^>]*>(?P<mbody>.*?)</math\s*>)
  | (?P<gone><!--.*?(?:-->|\Z)|<(?P<gt>script|style|head|title|noscript|figure|gallery|template)\b[^>]*>.*?</(?P=gt)\s*>|^__[A-Z]+__[ \t]*$)
    """,
    re.X | re.S | re.M | re.I,
)
_LANGS = {
    "html": re.compile(r"</?(?:p|li|ul|ol|h[1-6]|div|b|i|strong|em|span|a|sup|body)\b[^>]*>|&(?:\w+|#\w+);", re.I),
    "wiki": re.compile(r"\[\[|'{2,}|\{\{|^=+[^=\n]+=+\s*$|<ref\b|\[https?://\S+ ", re.M),
    "md": re.compile(r"\]\([^)\s]+(?: \"[^\"]*\")?\)|\*\*\S|__\S[^_\n]*__|^\#{2,6}\s|\[\^\w+\]|^```|^~~~|^>\s", re.M),
    "tex": re.compile(r"\\(?:[a-zA-Z]+\*?[\[{ ]|['~`^\"][{a-zA-Z\\]|[%&#_${}])"),
}
_PUA = "\ue000"
_MARK = {"h": "\ue010", "li": "\ue011", "p": "\ue012"}


@dataclass
class Leaf:
    prefix: str
    text: str
    region: bool = False  # whether the source is kept as it stands
    gap: bool = True  # whether a blank line or a tag stands before it
    closed: bool = False  # whether signs like its prefix's end it
    path: tuple[str, ...] = ()  # its ancestors, outermost first


def languages(text: str) -> dict[str, int]:
    return {k: len(r.findall(text)) for k, r in _LANGS.items()}


def _strongest(counts: dict[str, int]) -> str:
    best = max(counts, key=lambda k: counts[k])
    return best if counts[best] else "none"


def _balanced(text: str, at: int) -> int:
    """End of the group in braces that opens at `at`, exclusive."""
    deep = 0
    for i in range(at, len(text)):
        if text[i] == "{":
            deep += 1
        elif text[i] == "}":
            deep -= 1
            if not deep:
                return i + 1
    return len(text)


def _without_commands(text: str, names: str) -> str:
    """Text without commands of these names and their arguments."""
    r = re.compile(r"\\(?:%s)\*?(?:\[[^\]]*\])*\{" % names)
    while m := r.search(text):
        text = text[: m.start()] + text[_balanced(text, m.end() - 1) :]
    return text


def _without_links(text: str) -> str:
    """Text without wiki files and categories, whose captions may hold links."""
    r = re.compile(r"\[\[\s*(?:Archivo|File|Imagen|Image|Fichier|Datei|Ficheiro|Categor[íi]a|Category|Catégorie|Kategorie|Categoria)\s*:", re.I)
    while m := r.search(text):
        deep, i = 0, m.start()
        while i < len(text):
            if text.startswith("[[", i):
                deep, i = deep + 1, i + 2
            elif text.startswith("]]", i):
                deep, i = deep - 1, i + 2
                if not deep:
                    break
            else:
                i += 1
        text = text[: m.start()] + text[i:]
    return text


_WORDS = {  # patterns that are used on all pages, compiled once
    "tex_line": re.compile(r"^[ \t]*%.*$\n?", re.M),
    "tex_rest": re.compile(r"(?<!\\)%[^\n]*"),
    "tex_head": re.compile(r"^\\(?:documentclass|usepackage|title|author|date|maketitle|tableofcontents|bibliography\w*|newcommand)\b.*$", re.M),
    "tex_env": re.compile(r"\\(begin|end)\{(itemize|enumerate|description|quote|quotation|center|figure|table)\*?\}(?:\[[^\]]*\])?"),
    "tex_item": re.compile(r"\\item\b(?:\[[^\]]*\])?"),
    "template": re.compile(r"\{\{[^{}]*\}\}"),
    "ref": re.compile(r"<ref\b[^<>]*/>|<ref\b[^<>]*>.*?</ref\s*>|<sup\b[^>]*class=[\"']?reference[^>]*>.*?</sup\s*>|</?references\b[^>]*>|</?nowiki>", re.S | re.I),
    "note": re.compile(r"^[ \t]*\[\^[^\]\s]+\]:.*$|\[\^[^\]\s]+\]|!\[[^\]]*\]\([^)]*\)", re.M),
    "tag": re.compile(r"<(/?)(h[1-6]|li|dt|dd|p|blockquote|ul|ol|dl|div|section|article|body|html|main|table|tr|td|th|hr|br)\b[^>]*>", re.I),
    "para": re.compile(r"(\n[ \t]*\n)"),
    "place": re.compile(rf"{_PUA}(\d+){_PUA}"),
    "under": re.compile(r"-{3,}|={3,}"),
    "rule": re.compile(r"[-*_=~]{3,}|\{\||\|\}"),
}
_RAW_SIGNS = re.compile(r"```|~~~|<(?:pre|syntaxhighlight|source|math|script|style|head|title|noscript|figure|gallery|template|!--)|\\begin\{|\$\$|\\\[|^__[A-Z]", re.I | re.M)
_PUSH, _POP = "\ue020", "\ue021"
_OWN = re.compile(r"[\ue000\ue010-\ue012\ue020\ue021]")
_CONTINUES = frozenset(("text", "<p>", "<li>", "<h>", "\\item", "-", "1.", ">", "* ", "+"))


def _tag(m: re.Match) -> str:
    """Block tags as marks: leaves by their tag, containers by an entry of the path."""
    close, name = m[1], m[2].lower()
    if name == "br":
        return " "
    if not close:
        if name[0] == "h" and name[1:].isdigit():
            return f"\n\n{_MARK['h']}"
        if name in ("li", "dt", "dd"):
            return f"\n\n{_MARK['li']}"
        if name == "p":
            return f"\n\n{_MARK['p']}"
    if name in ("ul", "ol", "dl", "div", "section", "article", "body", "html", "main", "table", "blockquote"):
        mark = f"\n\n{_POP if close else _PUSH}{name}\n\n"
        return mark + _MARK["p"] if name == "blockquote" and not close else mark
    return "\n\n"


def _plain_tex(text: str, page: str) -> str:
    """Text of a page with TeX signs without its preamble, comments, notes and captions."""
    if m := re.search(r"\\begin\{document\}", text):
        text = text[m.end() :]
    text = re.sub(r"\\end\{document\}.*", "", text, flags=re.S)
    if "%" in text:
        text = _WORDS["tex_line"].sub("", text)
        # a percent sign begins a comment where the text itself is LaTeX
        parts = _WORDS["para"].split(text)
        for i in range(0, len(parts), 2):
            if "%" in parts[i] and (page == "tex" or (_LANGS["tex"].search(parts[i]) and _strongest(languages(parts[i])) == "tex")):
                parts[i] = _WORDS["tex_rest"].sub("", parts[i])
        text = "".join(parts)
    text = _WORDS["tex_head"].sub("", text)
    text = _without_commands(text, "cite[pt]?|footnote|label|ref|includegraphics|caption|index")
    text = _WORDS["tex_env"].sub(lambda m: f"\n\n{_PUSH if m[1] == 'begin' else _POP}{m[2]}\n\n", text)
    return _WORDS["tex_item"].sub(lambda m: "\n\\item ", text)


def leaves(content: str) -> tuple[list[Leaf], str]:
    """Leaf blocks of a page, in order, and the page's main language."""
    regions: list[Leaf] = []
    content = _OWN.sub("", content.replace("\r\n", "\n").replace("\r", "\n"))

    def region(m: re.Match) -> str:
        if m["gone"] is not None:
            return "\n" if m["gone"].lower().startswith(("<head", "__")) else ""
        for g, tag in (("fbody", "fence"), ("pbody", "pre"), ("vbody", "verbatim"), ("ebody", "equation"), ("dbody", "$$"), ("bbody", "\\["), ("mbody", "math")):
            if m[g] is not None:
                body = m[g]
                break
        if tag == "math":
            line = content[content.rfind("\n", 0, m.start()) + 1 : m.start()]
            after = content[m.end() : (content.find("\n", m.end()) + 1 or len(content) + 1) - 1]
            aside = re.sub(r"<[^>]*>", "", line).strip(": \t") + re.sub(r"<[^>]*>", "", after).strip()
            if aside:
                return " " + body.strip() + " "
        if m["pre"] is not None:
            low = m["pt"].lower()
            nowiki = re.fullmatch(r"\s*<nowiki>(.*?)</nowiki>\s*", body, re.S)
            if nowiki:
                body = nowiki[1]
            elif low == "pre":
                body = html.unescape(re.sub(r"</?(?:code|span|b|i|strong|em|kbd|samp)\b[^>]*>", "", body))
        regions.append(Leaf(tag, body, True))
        return f"\n\n{_PUA}{len(regions) - 1}{_PUA}\n\n"

    text = _RAW.sub(region, content) if _RAW_SIGNS.search(content) else content
    counts = languages(text)
    page = _strongest(counts)
    if page == "none" and text is not content:
        page = _strongest(languages(content))
    if "\\" in text:
        text = _plain_tex(text, page) if counts["tex"] else text
    while "{{" in text:
        shorter = _WORDS["template"].sub("", text)
        if shorter == text:
            break
        text = shorter
    if "[[" in text:
        text = _without_links(text)
    if "<" in text:
        text = _WORDS["ref"].sub("", text)
    if "[" in text:
        text = _WORDS["note"].sub("", text)
    if "<" in text:
        text = _WORDS["tag"].sub(_tag, text)
    return _tree(text, regions), page


def _tree(text: str, regions: list[Leaf]) -> list[Leaf]:
    """Leaves of a text whose block tags are marks, with their ancestors."""
    out: list[Leaf] = []
    open_: Leaf | None = None
    path: list[str] = []
    gap = True
    for line in text.split("\n"):
        s = line.strip()
        if not s:
            open_, gap = None, True
            continue
        first = s[0]
        if first == _PUSH:
            path.append(s[1:])
            open_, gap = None, True
            continue
        if first == _POP:
            if s[1:] in path:
                while path.pop() != s[1:]:
                    pass
            open_, gap = None, True
            continue
        if first == _PUA and (m := _WORDS["place"].fullmatch(s)):
            leaf = regions[int(m[1])]
            leaf.gap, leaf.path = gap, tuple(path)
            out.append(leaf)
            open_, gap = None, True
            continue
        if first in "-=" and open_ is not None and open_.prefix == "text" and "\n" not in open_.text and _WORDS["under"].fullmatch(s):
            open_.prefix, open_, gap = "setext", None, False
            continue
        if first in "-*_=~{|" and _WORDS["rule"].fullmatch(s):
            open_, gap = None, True
            continue
        prefix, body = _prefix(s)
        if prefix == "text" and open_ is not None:
            open_.text += "\n" + body
            continue
        leaf = Leaf(prefix, body, False, gap, prefix[0] == "#" and s[-1] == "#", tuple(path))
        out.append(leaf)
        gap = False
        open_ = leaf if prefix in _CONTINUES else None
    return out


def _prefix(s: str) -> tuple[str, str]:
    """What a line begins with, and the rest."""
    for mark, name in ((_MARK["h"], "<h>"), (_MARK["li"], "<li>"), (_MARK["p"], "<p>")):
        if s.startswith(mark):
            return name, s[1:].strip()
    if m := re.match(r"\\(?:part|chapter|(?:sub)*section|paragraph)\*?\s*\{", s):
        end = _balanced(s, m.end() - 1)
        return "\\section", s[m.end() : end - 1] + s[end:]
    if s.startswith("\\item"):
        return "\\item", s[5:].strip()
    if m := re.fullmatch(r"(={1,6})\s*(.*?)\s*\1", s):
        return "=", m[2]
    if m := re.match(r"(#{2,6})\s*(.+?)\s*#*\s*$", s):
        return ("##" if s[len(m[1])] == " " else "##w"), m[2] if s[len(m[1])] == " " else s[len(m[1]) :]
    if m := re.match(r"#\s*(.+?)\s*$", s):
        return ("# " if s[1:2] == " " else "#"), m[1]
    if m := re.match(r"\*\*+", s):
        rest = s[m.end() :]
        if rest[:1] == " " or "**" not in rest:
            return "**", rest.strip(" *:#") if rest[:1] == " " else rest
    if s.startswith("* "):
        return "* ", s[2:].strip()
    if s.startswith("*") and not re.match(r"\*[^*\s][^*]*\*(?!\*)", s) and not s.startswith("**"):
        return "*", s[1:].strip()
    if m := re.match(r"([-+])\s+", s):
        return ("-" if m[1] == "-" else "+"), s[m.end() :]
    if m := re.match(r"\d{1,3}[.)]\s+", s):
        return "1.", s[m.end() :]
    if m := re.match(r">\s*", s):
        return ">", s[m.end() :]
    if m := re.match(r"[:;]+\s*", s):
        return ":", s[m.end() :]
    return "text", s


#: Tags that mean one kind in all four languages.
SURE = {
    "<h>": "heading", "=": "heading", "setext": "heading", "\\section": "heading", "<li>": "item", "\\item": "item", "*": "item", "* ": "item", "**": "item", "<p>": "paragraph", "text": "paragraph", ">": "paragraph",
    "fence": "code", "pre": "code", "verbatim": "code", "equation": "formula", "$$": "formula", "\\[": "formula", "math": "formula",
}
#: Prefixes of list entries that mean that where several follow one another.
LISTED = frozenset(("-", "+", "1."))


def _family(leaf: Leaf) -> str:
    return "list" if leaf.prefix in LISTED or leaf.prefix[0] == "*" else leaf.prefix[0]


def described(ls: list[Leaf], page: str) -> list[tuple]:
    """What the field may know of each leaf; equal descriptions have equal features."""
    out = []
    n = len(ls)
    for i, x in enumerate(ls):
        before, after = (ls[i - 1] if i else None), (ls[i + 1] if i + 1 < n else None)
        t = x.text.strip()
        first = t[:1]
        # lines of one sign in a row, as the levels of a list are
        run = (before is not None and not x.gap and _family(before) == _family(x)) + 2 * (after is not None and not after.gap and _family(after) == _family(x))
        out.append(
            (
                x.prefix,
                page,
                x.gap + 2 * (after is None or after.gap),
                run,
                x.closed,
                "stop" if t[-1:] in (".", "!", "?", ":", ";", "»", "…") else "open",
                min(7, len(t).bit_length()),
                "lower" if first.islower() else "upper" if first.isupper() else "digit" if first.isdigit() else "sign",
                "tex" if "\\" in t else "equal" if "=" in t else "lines" if "\n" in t else "words",
                x.path[-1] if x.path else "top",
                before.prefix if before else "edge",
                after.prefix if after else "edge",
                x.region,
            )
        )
    return out


def features(d: tuple, own: bool = True) -> list[str]:
    """Features of a described leaf; own: those of its own tag too."""
    prefix, page, gap, run, closed, end, size, start, signs, path, before, after, region = d
    rest = [
        "bias",
        f"size={size}|end={end}",
        f"size={size}|gap={gap}",
        f"start={start}|end={end}",
        f"gap={gap}|run={run}|end={end}",
        f"gap={gap}|run={run}",
        f"region={region}|signs={signs}",
        f"region={region}",
        f"in={path}",
        f"in={path}|end={end}",
        f"in={path}|run={run}",
        f"before={before}",
        f"after={after}|end={end}",
    ]
    if not own:
        return rest
    return rest + [f"own={prefix}", f"own={prefix}|page={page}", f"own={prefix}|gap={gap}|run={run}", f"own={prefix}|end={end}", f"own={prefix}|closed={closed}", f"own={prefix}|in={path}"]


def sure_kind(leaf: Leaf, d: tuple) -> str | None:
    """Label of a leaf for training, if its tag is unambiguous; None where the field has to decide."""
    if leaf.prefix in LISTED and d[3]:
        return "item"
    return SURE.get(leaf.prefix)


_ACCENTS = {"'": "\u0301", "`": "\u0300", "~": "\u0303", "^": "\u0302", '"': "\u0308", "c": "\u0327", "=": "\u0304", ".": "\u0307", "v": "\u030c"}


_SIGNS = re.compile(r"[<\[\\&'*_~`]")
_INLINE = {  # by the sign without which they change nothing
    "<": ((re.compile(r"</?[a-zA-Z][a-zA-Z0-9]*\b[^<>]*>"), ""),),
    "[": (
        (re.compile(r"\[\[(?:[^\[\]|]*\|)?([^\[\]]*)\]\]"), r"\1"),
        (re.compile(r"(?<!\!)\[([^\[\]]*)\]\((?:[^()\s]|\([^()]*\))*(?:\s+\"[^\"]*\")?\)"), r"\1"),
        (re.compile(r"\[(?:https?:)?//\S+\s+([^\]]*)\]"), r"\1"),
        (re.compile(r"\[(?:https?:)?//[^\s\]]+\]"), ""),
    ),
    "<h": ((re.compile(r"<(https?://[^>\s]+)>"), r"\1"),),
}
_EMPHASIS = (
    ("''", re.compile(r"'{2,5}"), ""),
    ("**", re.compile(r"\*\*(?=\S)(.+?)(?<=\S)\*\*", re.S), r"\1"),
    ("__", re.compile(r"(?<![\w\\])__(?=\S)(.+?)(?<=\S)__(?!\w)", re.S), r"\1"),
    ("*", re.compile(r"(?<![\w*\\])\*(?=[^\s*])(.+?)(?<=[^\s*])\*(?![\w*])", re.S), r"\1"),
    ("_", re.compile(r"(?<![\w\\])_(?=[^\s_])([^_]+?)(?<=[^\s_])_(?!\w)", re.S), r"\1"),
    ("~~", re.compile(r"~~(?=\S)(.+?)(?<=\S)~~"), r"\1"),
    ("`", re.compile(r"(`+)(.+?)\1"), r"\2"),
    ("\\", re.compile(r"\\([^A-Za-z0-9\s])"), r"\1"),
)
_ACCENT = re.compile(r"\\(['`~^\"=.])\s*(?:\{\s*(\\?[a-zA-Z])\s*\}|(\\i(?![a-zA-Z])|[a-zA-Z]))")
_CEDILLA = re.compile(r"\\(c|v)\{([a-zA-Z])\}")
_COMMAND = re.compile(r"\\(?:emph|text(?:bf|it|tt|sc|sf|rm|up|md|sl|normal)?|underline|mbox|enquote)\s*\{([^{}]*)\}")
_SWITCH = re.compile(r"\{\\(?:bf|it|em|tt|sc|sl|rm|bfseries|itshape|small|large)\b\s*([^{}]*)\}")


def visible(text: str, page: str) -> str:
    """What a reader sees of a leaf's text."""
    t = text
    if page != "tex" and not _SIGNS.search(t):
        return squeezed(t)
    for sign, steps in _INLINE.items():
        if sign in t:
            for r, by in steps:
                t = r.sub(by, t)
    if "\\" in t:
        t = _ACCENT.sub(_accent, t)
        t = _CEDILLA.sub(lambda m: unicodedata.normalize("NFC", m[2] + _ACCENTS[m[1]]), t)
        t = re.sub(r"\\href\{[^{}]*\}", "", t)
        t = re.sub(r"\\(?:url)\{([^{}]*)\}", r"\1", t)
        while True:
            shorter = _SWITCH.sub(r"\1", _COMMAND.sub(r"\1", t))
            if shorter == t:
                break
            t = shorter
        t = re.sub(r"(?<!\\)\{([^\W\d_])\}", r"\1", t)
        t = t.replace("\\\\", " ")
        t = re.sub(r"\\[,;:! ]", " ", t)
    if page == "tex":
        t = re.sub(r"(?<!\\)~", " ", t)
        t = re.sub(r"(?<!\\)\{([^{}\\]*)\}", r"\1", t)
    for sign, r, by in _EMPHASIS:
        if sign in t:
            t = r.sub(by, t)
    return squeezed(html.unescape(t) if "&" in t else t)


def _accent(m: re.Match) -> str:
    return unicodedata.normalize("NFC", (m[2] or m[3]).lstrip("\\") + _ACCENTS[m[1]])


def squeezed(t: str) -> str:
    if "\u200b" in t or "\ufeff" in t:
        t = t.replace("\u200b", " ").replace("\ufeff", " ")
    return " ".join(t.split())


def blocks(content: str | None, model: Crf) -> list[tuple[str, str]]:
    """(kind, text) of a page's blocks, in order."""
    if not content or not content.strip():
        return []
    ls, page = leaves(content)
    out = []
    for leaf, tag in zip(ls, model.decode(described(ls, page), features)):
        text = squeezed(leaf.text) if leaf.region else visible(leaf.text, page)
        if text:
            out.append((tag, text))
    return out


def train(contents: list[str], own: bool = True) -> Crf:
    """The field of some pages; own: with views that know the leaves' own tags beside those that don't."""
    seqs, tags = [], []
    for c in contents:
        if not c or not c.strip():
            continue
        ls, page = leaves(c)
        ds = described(ls, page)
        gold = [sure_kind(x, d) for x, d in zip(ls, ds)]
        seqs.append([features(d, False) for d in ds])
        tags.append(gold)
        if own:
            seqs.append([features(d) for d in ds])
            tags.append(gold)
    return Crf(KINDS).fit(seqs, tags)


def accuracy_without_tags(contents: list[str], model: Crf) -> tuple[int, int]:
    """(right, all) of the labelled leaves of pages, with their own tags withheld."""
    right = every = 0
    for c in contents:
        ls, page = leaves(c)
        ds = described(ls, page)
        for x, d, got in zip(ls, ds, model.decode(ds, lambda d: features(d, False))):
            want = sure_kind(x, d)
            every += want is not None
            right += want == got
    return right, every


def sample(pages: DataFrame, id_col: str, text_col: str, n: int) -> list[str]:
    """Contents of the n pages of smallest hash, in a fixed order; bounded by n."""
    rows = pages.where(F.length(F.trim(text_col)) > 0).select(F.col(text_col).alias("c"), F.xxhash64(F.col(id_col)).alias("h")).orderBy("h").limit(n).collect()
    return [r.c for r in rows]


def clean_blocks(pages: DataFrame, id_col: str = "page_id", text_col: str = "content", sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """(page_id, block_no from 0, kind, block_text); one row per block."""
    model = train(sample(pages, id_col, text_col, sample_pages))
    kind = pages.schema[id_col].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = [(i, n, k, t) for i, c in zip(pdf["id"], pdf["text"]) for n, (k, t) in enumerate(blocks(c, model))]
            yield pd.DataFrame(rows, columns=["id", "block_no", "kind", "block_text"])

    src = spread(pages.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")))
    return src.mapInPandas(run, f"id {kind}, block_no int, kind string, block_text string").withColumnRenamed("id", id_col)
