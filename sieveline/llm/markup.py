"""Problem 1: markup residue to clean text.

The standard-library parser streams its events over a text; each event is
booked on its line, and a line of any event holds HTML. Lines get a text-to-tag
ratio, the ratios are smoothed by a Gaussian window, and where they fall into
two clusters the lines with tags in the lower one (rows of links, empty
frames) are no content. Markdown, wiki and LaTeX marks are rewritten line by
line so that headings, lists, code and formulas keep plain marks of their own.
"""

from __future__ import annotations

import html
import html.entities
import math
import re
from html.parser import HTMLParser
from itertools import chain, islice

from pyspark.sql import DataFrame

from .common import arrow_flat_map

# Names of HTML elements.
TAGS = frozenset(
    "a abbr address article aside audio b blockquote body br button canvas caption center cite code col colgroup dd del details dfn div dl dt em "
    "embed fieldset figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main "
    "map mark meta nav noscript object ol optgroup option p param picture pre q s samp script section select small source span strike strong style "
    "sub summary sup svg table tbody td textarea tfoot th thead time title tr tt u ul var video wbr".split()
)
BLOCKS = frozenset("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol option p pre section table tbody tfoot thead title tr ul".split())
DROPPED = frozenset("script style noscript iframe head".split())

STRUCTURE = re.compile(r"<(?:img|ol|ul|li|h[1-6]|pre|code|table|t[rdh]|br)\b|</(?:ol|ul|pre|code)>", re.I)

LINK = re.compile(r"<a\b[^<>]*>.*?</a\s*>", re.I)
TAGGED = re.compile(r"<[^<>]*>")
HEADINGS = {f"h{i}": "#" * i for i in range(1, 7)}
PLACE_NAME = r"[A-Za-z][A-Za-z0-9]*(?:[_.][A-Za-z0-9]+)+|[a-z]+|[A-Z][A-Z ]+"

_MD = [
    re.compile(p)
    for p in (
        r"^ {0,3}#{1,6} +\S",
        r"!?\[[^\[\]\n]*\]\([^()\s]+(?: \"[^\"]*\")?\)",
        r"\*\*(?=\S)[^*\n]*[^\W_][^*\n]*(?<=\S)\*\*",
        r"~~(?=[^\W_])[^~\n]+(?<=[^\W_])~~",
        r"`[^`\n]+`",
        r"^ {0,3}(?:```|~~~)\w*\s*$",
        r"^ {0,3}> +\S",
        r"^ *\|(?=.*\w)[^|\n]+(?:\|[^|\n]+)+\| *$",
        r"^ *\|? *:?-{3,}:? *(?:\| *:?-{3,}:? *)+\|? *$",
        r"^ *[-*+] \[[ xX]\] ",
        r"(?<![\w*])\*(?=[^\W\d_])[^*\n]{0,80}[^\W_]\*(?![\w*])",
    )
]
_UNDER = re.compile(r"(?<!\w)__(?=\S)([^_\n]+(?:_[^_\n]+)*)(?<=\S)__(?!\w)")
_RULE = re.compile(r"^ {0,3}(?:-{3,}|={3,}|\*{3,}|_{3,}) *$")
_WIKI = [
    re.compile(p)
    for p in (
        r"\[\[(?!INSERT )(?:[^\[\]{}\n]+)\]\]",
        r"\{\{[^{}\n|]+\|[^{}\n]*\}\}",
        r"'''?(?=\S)[^'\n]+(?:'[^'\n]+)*?'''?",
        r"^ *(={2,6}) *[^=\n]+? *\1 *$",
        r"(?:^|\s)={2,6} [^=\n]+ ={2,6}(?=\s|$)",
        r"^\{\|",
        r"^\|[-}] *$",
        r"^[|!][^|\n]*(?:\|\||!!)",
        r"</?(?:ref|nowiki|gallery)\b[^<>]*>",
    )
]
_TEX_COMMAND = re.compile(r"\\(?:[a-zA-Z]+\*?(?:\[[^\]\n]*\])?\{|(?:item|begin|end|noindent|newline|maketitle|par|hline|centering)\b|\\ *$|[%&#$_]|\(.+?\\\)|\[)")
_TEX_MATH = re.compile(r"\$(?!\{)[^$\n]*(?:\\[a-zA-Z]+|[_^]\{?\w)[^$\n]*\$")
_LT = re.compile(r"[<&]")
_MD_GATE = re.compile(r"[#`*~>|]|\]\(|__|^ *-{3}|^ *={3}", re.M)
_WIKI_GATE = re.compile(r"\[\[|\{\{|''|==|\{\||^\|", re.M)


def markdown_lines(lines: list[str]) -> set[int]:
    """Indices of lines that hold Markdown."""
    out = set()
    for i, line in enumerate(lines):
        if _MD_GATE.search(line) is None:
            continue
        if any(p.search(line) for p in _MD[:8]) or any(p.search(line) for p in _MD[8:]):
            if "|" in line and "||" in line and not any(p.search(line) for p in _MD[:7]):
                continue  # a wiki table row
            out.add(i)
        elif (m := _UNDER.search(line)) and not re.fullmatch(PLACE_NAME, m[1]):
            out.add(i)
        elif _RULE.match(line) and i and lines[i - 1].strip() and len(line.strip()) == len(lines[i - 1].strip()):
            out.add(i)  # a setext heading's underline is as long as the heading
    return out


def wiki_lines(lines: list[str]) -> set[int]:
    """Indices of lines that hold wiki markup."""
    return {i for i, line in enumerate(lines) if _WIKI_GATE.search(line) and any(p.search(line) for p in _WIKI)}


def latex_lines(lines: list[str]) -> set[int]:
    """Indices of lines that hold LaTeX."""
    return {i for i, line in enumerate(lines) if ("\\" in line and _TEX_COMMAND.search(line)) or ("$" in line and _TEX_MATH.search(line))}


class Events(HTMLParser):
    """Streams a text through the parser: tags and characters booked by line, clean text gathered."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.tags: dict[int, int] = {}
        self.out: list[str] = []
        self.hidden = 0
        self.lists: list[int] = []
        self.pre = 0

    def _book(self) -> None:
        n = self.getpos()[0] - 1
        self.tags[n] = self.tags.get(n, 0) + 1

    def handle_starttag(self, tag, attrs):
        if tag not in TAGS:
            self.handle_data(self.get_starttag_text() or "")
            return
        self._book()
        if tag in DROPPED:
            self.hidden += 1
        elif tag == "br":
            self.out.append("\n")
        elif tag == "img":
            src = dict(attrs).get("src") or dict(attrs).get("data-src")
            if src:
                self.out.append(f"\n[Image: {src}]\n")
        elif tag in HEADINGS:
            self.out.append(f"\n{HEADINGS[tag]} ")
        elif tag in ("ul", "ol"):
            self.lists.append(0 if tag == "ol" else -1)
        elif tag == "li":
            if self.lists and self.lists[-1] >= 0:
                self.lists[-1] += 1
                self.out.append(f"\n{self.lists[-1]}. ")
            else:
                self.out.append("\n- ")
        elif tag == "pre":
            self.pre += 1
            self.out.append("\n```\n")
        elif tag == "code" and not self.pre:
            self.out.append("`")
        elif tag in ("td", "th"):
            self.out.append(" ")
        elif tag in BLOCKS:
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag not in TAGS:
            return
        self._book()
        if tag in DROPPED:
            self.hidden = max(0, self.hidden - 1)
        elif tag in ("ul", "ol") and self.lists:
            self.lists.pop()
        elif tag == "pre" and self.pre:
            self.pre -= 1
            self.out.append("\n```\n")
        elif tag == "code" and not self.pre:
            self.out.append("`")
        elif tag in BLOCKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)

    def handle_comment(self, data):
        self._book()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def _reference(self, ref: str, known: bool) -> None:
        if known:
            self._book()
        if not self.hidden:
            self.out.append(html.unescape(ref) if known else ref)

    def handle_entityref(self, name):
        self._reference(f"&{name};", f"{name};" in html.entities.html5)

    def handle_charref(self, name):
        self._reference(f"&#{name};", True)


BARE_LESS = re.compile(r"<(?![/!?]?[A-Za-z!?-])")
BARE_AMPERSAND = re.compile(r"&(?!#?\w+;)")


def _stand_ins(text: str) -> list[str]:
    """Two characters that no text is meant to hold, and that this one doesn't."""
    return list(islice((c for c in map(chr, chain(range(0xFDD0, 0xFDF0), range(0xE000, 0xF8FF))) if c not in text), 2))


def parse_html(text: str) -> tuple[dict[int, int], str]:
    """Events by line, and the text without its markup; entities need their semicolon.

    Escaped markup is unescaped once; streamed again it counts and goes like the plain kind.
    """
    # a bare ampersand or less-than sign is text; the parser must not take it for a start
    less, ampersand = _stand_ins(text)
    events = Events()
    events.feed(BARE_AMPERSAND.sub(ampersand, BARE_LESS.sub(less, text)))
    events.close()
    return events.tags, "".join(events.out).replace(less, "<").replace(ampersand, "&")


def smoothed(ratios: list[float], sigma: float = 1.0) -> list[float]:
    """The ratios under a Gaussian window."""
    reach = max(1, math.ceil(2 * sigma))
    weights = [(d, math.exp(-0.5 * (d / sigma) ** 2)) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(ratios)):
        near = [(w, ratios[i + d]) for d, w in weights if 0 <= i + d < len(ratios)]
        out.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
    return out


def clustered(values: list[float], apart: float = 1.5) -> float:
    """The threshold between two clusters of logarithmic ratios (two means); minus infinity where they lie less than ``apart`` from each other."""
    low, high = min(values), max(values)
    for _ in range(20):
        cut = (low + high) / 2
        below, above = [v for v in values if v < cut], [v for v in values if v >= cut]
        if not below or not above:
            break
        means = sum(below) / len(below), sum(above) / len(above)
        if means == (low, high):
            break
        low, high = means
    return (low + high) / 2 if high - low >= apart else -math.inf


def content_regions(text: str, tags: dict[int, int], sigma: float = 1.0, apart: float = 1.5, most: float = 1.0) -> list[bool]:
    """For each line, whether it lies in a content region.

    The text-to-tag ratio of a line is its characters outside tags and links
    over its tags. Smoothed ratios are clustered; lines with tags in the lower
    cluster, of less than ``most`` characters a tag, are left out: rows of
    links. Lines without tags carry no markup to judge by, and those whose tags
    give structure (lists, headings, code, tables, images) stay. A text of one
    cluster is content throughout.
    """
    lines = text.split("\n")
    ratio = [len(TAGGED.sub("", LINK.sub("", line) if i in tags else line).strip()) / max(1, tags.get(i, 0)) for i, line in enumerate(lines)]
    own = [math.log1p(r) for r in ratio]
    smooth = smoothed(own, sigma)  # of logarithms, or a long line would speak for the short ones beside it
    shown = [r for r, line in zip(own, lines) if line.strip()]
    threshold = min(clustered(shown, apart), math.log1p(most)) if shown else -math.inf
    return [not tags.get(i) or (s + own[i]) / 2 >= threshold or STRUCTURE.search(lines[i]) is not None for i, s in enumerate(smooth)]


def clean_markdown(line: str) -> str:
    line = re.sub(r"!\[([^\[\]]*)\]\(([^()\s]+)[^()]*\)", lambda m: f"[Image: {m[2]}]", line)
    line = re.sub(r"\[([^\[\]]*)\]\([^()\s]+(?: \"[^\"]*\")?\)", r"\1", line)
    line = re.sub(r"(\*\*|~~)(?=\S)(.+?)(?<=\S)\1", r"\2", line)
    line = _UNDER.sub(lambda m: m[0] if re.fullmatch(PLACE_NAME, m[1]) else m[1], line)
    line = re.sub(r"^( {0,3})> +", r"\1", line)
    if re.match(r"^ *\|? *:?-{3,}:? *(?:\| *:?-{3,}:? *)+\|? *$", line):
        return ""
    if re.match(r"^ *\|.*\| *$", line):
        line = "\t".join(c.strip() for c in line.strip().strip("|").split("|"))
    return line


def clean_wiki(line: str) -> str:
    line = re.sub(r"^ *(={2,6}) *([^=\n]+?) *\1 *$", lambda m: "#" * len(m[1]) + " " + m[2], line)
    line = re.sub(r"(?:^|(?<=\s))={2,6} ([^=\n]+?) ={2,6}(?=\s|$)", r"\1", line)
    line = re.sub(r"\[\[(?:File|Image):([^\[\]|]+)(?:\|[^\[\]]*)?\]\]", r"[Image: \1]", line)
    line = re.sub(r"\[\[Category:[^\[\]]*\]\]", "", line)
    line = re.sub(r"\[\[(?!INSERT )(?:[^\[\]|]*\|)?([^\[\]]*)\]\]", r"\1", line)
    line = re.sub(r"\{\{convert\|([^{}|]*)\|([^{}|]*)[^{}]*\}\}", r"\1 \2", line)
    line = re.sub(r"\{\{[^{}|\n]+\|[^{}]*\}\}", "", line)
    line = re.sub(r"'''(.+?)'''|''(.+?)''", lambda m: m[1] or m[2], line)
    if re.match(r"^(?:\{\|.*|\|-+ *|\|\} *)$", line):
        return ""
    if re.match(r"^[|!][^|\n]*(?:\|\||!!)", line):
        line = "\t".join(c.strip() for c in re.split(r"\|\||!!", line[1:]))
    return line


def clean_latex(line: str) -> str:
    line = re.sub(r"\\(?:sub)*section\*?\{([^{}]*)\}", lambda m: "#" * (2 + m[0].count("sub")) + " " + m[1], line)
    line = re.sub(r"\\(?:begin|end)\{[^{}]*\}(?:\[[^\]]*\])?|\\(?:noindent|newline|maketitle|par|hline|centering)\b|\\footnote\{[^{}]*\}|\\(?:label|cite|ref)\{[^{}]*\}", "", line)
    line = re.sub(r"\\includegraphics(?:\[[^\]]*\])?\{([^{}]*)\}", r"[Image: \1]", line)
    line = re.sub(r"\\item\b(?:\[[^\]]*\])? *", "- ", line)
    # formulas stay between dollar signs; a plain fraction becomes one
    line = re.sub(r"\$\\frac\{(\d+)\}\{(\d+)\}\$", r"\1/\2", line)
    line = re.sub(r"\\(?:text(?:bf|it|tt|sc|rm)|emph|underline|url)\{([^{}]*)\}", r"\1", line)
    line = re.sub(r"\\([%&#$_])", r"\1", line)
    return re.sub(r" *\\\\ *$", "", line)


def analyse(text: str) -> tuple[list[str], str]:
    """Kinds of markup present, and the clean text.

    A text without markup comes back as it is.
    """
    kinds = []
    clean = text
    if _LT.search(text):
        tags, _ = parse_html(text)
        if tags:
            kinds.append("html")
            while tags:  # escaped markup appears once unescaped; each round leaves fewer characters
                keep = content_regions(clean, tags)
                before, (_, clean) = clean, parse_html("\n".join(line for line, k in zip(clean.split("\n"), keep) if k))
                if len(clean) >= len(before):
                    break
                tags, _ = parse_html(clean)
            clean = re.sub(r"[ \t]*\n(?:[ \t]*\n)+", "\n", clean).strip("\n")
    lines = text.split("\n")
    own = clean.split("\n")
    if _MD_GATE.search(text) and markdown_lines(lines):
        kinds.append("markdown")
        under = {i for i, line in enumerate(own) if i and _RULE.match(line) and own[i - 1].strip() and len(line.strip()) == len(own[i - 1].strip())}
        fenced, out = False, []
        for i, line in enumerate(own):
            if re.match(r"^ {0,3}(?:```|~~~)", line):
                fenced = not fenced
                out.append(line)
            elif i in under:
                if out:
                    out[-1] = ("# " if line.strip()[0] == "=" else "## ") + out[-1]
            else:
                out.append(line if fenced else clean_markdown(line))
        own = out
    if _WIKI_GATE.search(text) and wiki_lines(lines):
        kinds.append("wiki")
        own = [clean_wiki(line) for line in own]
    if ("\\" in text or "$" in text) and latex_lines(lines):
        kinds.append("latex")
        own = [clean_latex(line) for line in own]
    return kinds, "\n".join(own) if kinds else text


def markup(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, kinds, clean`` of each row: kinds of markup present and the clean text.

    Null texts have no kinds and stay null; an empty text stays empty. Rows are
    independent, so keys may repeat or be null. No shuffle.
    """

    def make():
        def row(k, t):
            yield (k, [], None) if t is None else (k, *analyse(t))

        return row

    kind = df.schema[key].dataType.simpleString()
    return arrow_flat_map(df.select(key, text), make, f"`{key}` {kind}, kinds array<string>, clean string")
