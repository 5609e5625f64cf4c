"""Problem 3: page furniture against the body, by ratios over paths.

The delivered contents have lost their tree, so the root-to-leaf path of a
line is rebuilt from what a reader sees: the part of the page (before the
first heading, or below a heading), the block (list under a heading, run of
short entries, paragraph) and the leaf, which is the form of the line (title,
quantity, sentence and so on) or the role that a known wording gives it. For
each path of a page text length, punctuation and the share of words that belong
to sites rather than to texts are aggregated; the ratios of a line's path, those
of the path above it and those of its neighbours, smoothed by a Gaussian window,
are fused into one score, and lines of a path below the threshold are
furniture. A known wording is one of the features. Its weight was fitted with
the feature withheld in a fifth of the lines, so ratios also decide about wordings
that no list holds. Where tags are left, they are part of the line and dropped
before it is read.
"""

from __future__ import annotations

import html
import math
import re
from functools import lru_cache
from math import sumprod

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_flat_map
from .visual import fold

# Entries of menus and buttons, in lower case.
MENU = frozenset(
    "home|about|about us|contact|contact us|newsletter|newsletters|seasonal|faq|faqs|blog|start here|videos|video|meal plans|shop|store|courses|search|recipes|cleaning|"
    "log in|login|log out|sign in|sign up|register|my account|careers|press|advertise|advertising|terms|terms of use|terms of service|privacy|privacy policy|imprint|sitemap|"
    "site map|accessibility|cookies|cookie policy|cookie settings|menu|open menu|close menu|main menu|toggle navigation|navigation|skip to content|skip to main content|"
    "skip to recipe|jump to recipe|jump to video|print|print view|print recipe|print this page|report a problem|rss|pin|pin recipe|pin it|save|save recipe|share|tweet|email|mail|"
    "back to top|back to home|load more|show more|read more|see more|next|previous|ok|okay|got it|got it!|accept|accept all|accept all cookies|reject all|decline|allow|allow all|"
    "manage choices|manage cookies|manage preferences|settings|settings...|preferences|save and close|close|close x|x|i agree|agree|more information|continue without consent|"
    "continue with|do not sell my data|ad choices|help|support|subscribe|follow us|follow|archive|archives|categories|tags|topics|events|community|gift cards|wishlist|cart|"
    "my recipe box|all recipes|latest|popular|trending|chirper|pinwall|cancel reply|log in / register|language|(change)|feedback".split("|")
)
# Headings of sidebar lists, in lower case.
SIDEBARS = frozenset(
    "browse by topic|more from this category|related posts|related recipes|trending now|recent comments|recent posts|you might also like|you may also like|popular this week|"
    "popular posts|editor's picks|editors' picks|most read|latest posts|most popular|top recipes|see also on this site|in this category|categories|topics|recommended for you|"
    "reader favourites|reader favorites".split("|")
)
SEPARATOR = re.compile(r"\s{2,}|\t+|\s+(?:[|/•·›»>:~-]|::|-)+\s+|\s*[|•·›»]\s*")
CUES = [
    (kind, re.compile(pattern))
    for kind, pattern in (
        ("consent", r"\b(?:(?:use|uses|using|set|sets|place|places|save|store|accept|allow|our|these|of) cookies\b|cookie (?:settings|policy|consent|preferences|notice)\b|cookies (?:and similar|to (?:show|measure|improve|remember)|so that pages|for (?:statistics|tailored))|(?:set|these|which|of) trackers|small files on your device|local storage|(?:save|store) identifiers|similar tools|your privacy matters|value your privacy|need consent|without consent|continuing to browse|third parties|tailored offers|(?:accept|reject) all$)"),
        ("consent", r"^(?:allow|accept|agree|reject|decline)(?: all)? ?/ ?\w+"),
        ("legal", r"^(?:©|\(c\)|copyright\b)|\ball rights reserved\b|\bregistered (?:trade name|no\.?|trademark)\b|\breproduction in any medium\b|\bask before reposting\b|\bphotographs belong to\b|\baffiliate\b"),
        ("legal", r"\bnutrition (?:figures|values|information|facts) (?:are|is) (?:only )?(?:estimates?|estimated)\b"),
        ("advert", r"^(?:advertisement|advertising|sponsored|promoted)\b"),
        ("byline", r"^(?:last|medically|fact) ?(?:reviewed|updated|checked)\b|^written(?: and (?:photographed|tested|edited))? by\b|^(?:posted|published|updated) (?:on|by|in)\b|^as seen in\b|^photo(?:graph)?s? by\b|\btest team$"),
        ("share", r"^share(?: this| on)?\b.*:|\bshares so far\b|^pin it\b|^tell a friend\b|^tag(?:s|ged)?:|^filed under\b|^print this page\b|\bleave a star rating\b|^did you make this\?|^follow (?:along|us)\b"),
        ("rating", r"^\d(?:\.\d+)? (?:stars? )?from \d[\d,]* (?:votes?|ratings?|reviews?)|^rate this\b|^\d[\d,]* (?:comments?|replies|reviews?|ratings?)$|^view all \d[\d,]* \w+|^leave a (?:reply|comment)\b|\brequired fields are marked\b|^\d[\d,]* thoughts on\b"),
        ("signup", r"^(?:subscribe|sign up|join)\b.*(?:free|inbox|ideas|letter|newsletter|cooks|readers|every \w+day|week)|\bstraight to your inbox\b|\benter your e-?mail\b|^get our (?:weekly|free|daily)\b"),
        ("pager", r"^(?:previous|next|older|newer)(?: post| article| recipe)?s?: ?\S|(?:>>|<<|»)$|^home (?:»|›|>|/) "),
        ("footer", r"^powered by\b|^site by\b|^(?:web)?site design\b|^part of the .* (?:family|network)\b|^opening hours\b|^language:|^cart \(\d+\)$|^theme by\b|^made with (?:love|care)\b"),
        ("script", r"^(?:please )?enable (?:java ?script|scripts?) to (?:rate|print|vote|save|share|comment|leave|post|like|follow|subscribe|see (?:the )?comments|use (?:the )?(?:timer|slider|menu))\b"),
    )
]
# Words without which no cue can match; lines without any of them are spared the patterns.
CUE_WORDS = frozenset(
    "cookie cookies trackers storage files identifiers tools privacy consent browse parties offers all allow accept agree reject decline c copyright reserved registered reproduction "
    "reposting belong affiliate nutrition advertisement advertising sponsored promoted reviewed updated checked written posted published seen photo photos photograph photographs team "
    "share shares pin tell tag tags tagged filed print rating did follow votes vote ratings rate comments comment replies reviews review view leave required thoughts subscribe sign join "
    "inbox email mail letter get previous next older newer home powered site website design part opening language cart theme made enable".split()
)
WORD = re.compile(r"[a-z]+")
EDGES = " \t*_#=`>|\\\xa0"
COUNTED = re.compile(r"^[A-Za-z][\w' -]{0,30} \(\d{1,5}\)$")
TITLE = re.compile(r"^(?:[A-ZÀ-Ý][\w'’-]*)(?: (?:[A-ZÀ-Ý][\w'’-]*|and|with|of|&)){1,7}$")
TAG = re.compile(r"<[^<>]*>")
HEADING = re.compile(r"^(?:#{1,6} |=+ ?)?(ingredients|instructions|notes|steps|you will need|directions|method|nutrition facts|nutrition|pantry list|what to buy)\b[ :=]*$", re.I)
THRESHOLD = 0.0


def plain(line: str) -> str:
    """A line as a reader sees it: without tags, entities, outer marks of emphasis and look-alikes."""
    if "<" in line or "&" in line:
        line = TAG.sub("", html.unescape(html.unescape(line)))
    return line.strip(EDGES)


def brand_of(url: str | None) -> str:
    """The site's name as its host spells it; empty where there is none."""
    m = re.match(r"\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#\s]+)", url or "")
    labels = [x for x in (m[1].lower().split(".") if m else []) if x != "www"]
    return labels[0] if labels and len(labels[0]) >= 3 else ""


MENU_STARTS = frozenset(e.split()[0] for e in MENU)

# Words of sites and their furniture, first those that hardly stand elsewhere, then those that may.
SITE_WORDS = dict.fromkeys(
    "accessibility advertise advertisement advertiser advertising affiliate archives blog bookmark browse browser careers categories chat comment comments contact copyright courses "
    "disclaimer disclosure download email faq faqs facebook feedback follow forum imprint inbox instagram javascript login menu navigation newsletter newsletters "
    "notifications password pin podcast policy popular powered print privacy profile promoted rating ratings register registered related reply replies reposting reserved reviewed reviews rights rss "
    "scroll search share shares sidebar sign sitemap site sites sponsored subscribe subscriber subscription tag tagged tags terms toggle trackers trademark trending tweet twitter unsubscribe "
    "updated user username visit vote votes website youtube".split(),
    1.0,
) | dict.fromkeys(
    "accept account agree allow app article articles author community conditions consent continue credit credits cancel close collection collections edition enter events features filed friend friends gift help hide "
    "jump latest leave legal letter like link links load log manage member members more network news next offers online page pages partners photo photographed photographs photos picks post posted posts preferences previous published read "
    "reader readers recent recommended reject report reproduction required save saved see seen send settings skip stars start store story studio support team topic topics us video videos view watch weekly written".split(),
    0.5,
)
#: Words that hold sentences together; furniture has few of them.
FUNCTION_WORDS = frozenset("the of and a an to in is it that was for on with as at from or but not can if then until when out into over so my our i they them than while because which after before you your every some each few half".split())
#: Lines beyond this length tell no more by it.
LONG = 200
SENTENCE_PARTS = ".,!?;。，！？；"
ASCII_PARTS = SENTENCE_PARTS[:5]
#: Template places are nobody's words; names in them count for nothing.
PLACES = re.compile(r"[{}_]|%\w+%|\[\[|@@|^\[\w+\]$|\w\(\S|^(?:TODO|TBD|FIXME)\b")
#: A number at the beginning, marks of lists aside.
QUANTITY = re.compile(r"(?:(?:[-+•·▢☐◦‣–]+|item)\s+)*(?:\d|[¼-¾⅐-⅞])")
#: ``fit`` over the lines of 12 000 records, labelled by whether a known wording holds (four fifths of the sites), in the order of ``FEATURES``.
WEIGHTS: tuple[float, ...] = (-0.036, 0.18, 1.364, -1.057, -1.289, -0.826, -0.75, -0.423, -2.518, -0.605, -0.943, 3.491, 0.018, 1.321, 0.72, -0.275, 0.476, 0.118, -0.35, -0.565)
FEATURES = ("bias", "path length", "path punctuation", "site words", "site words of path", "site words of block", "site words near", "length near", "wording", "menu", "sidebar", "no site word", "title", "quantity", "sentence end", "top", "function words", "length", "site words of few", "cue and function words")


def _menu(low: str) -> bool:
    """One menu entry, or a row of nothing but menu entries, in lower case."""
    if low in MENU:
        return True
    if low.split(None, 1)[0].rstrip("|/:•·›»>") not in MENU_STARTS:
        return False
    parts = [p.strip() for p in SEPARATOR.split(low) if p and p.strip()]
    return len(parts) > 1 and all(p in MENU for p in parts)


def role(text: str, brand: str = "") -> str:
    """The role that the wording of one plain, non-empty line gives it; empty for none."""
    low = text.lower()
    words = WORD.findall(low)
    return _role(low, words, brand)


def _role(low: str, words: list[str], brand: str) -> str:
    if low.startswith("[image"):
        return ""
    if (words and words[0] in MENU_STARTS or low in MENU) and _menu(low):
        return "menu"
    if not CUE_WORDS.isdisjoint(words) or "©" in low or "»" in low or ">>" in low or low in SIDEBARS:
        low = " ".join(low.split())
        if low in SIDEBARS:
            return "sidebar"
        for kind, cue in CUES:
            if cue.search(low):
                return kind
    if brand and brand[:3] in low and "://" not in low and "@" not in low and (len(brand) >= 6 or brand in words) and brand in re.sub(r"[^a-z0-9]", "", low.replace("&", "and")):
        return "brand"
    return ""


class Node:
    """One line: its path and what is read of it."""

    __slots__ = ("block", "density", "function", "leaf", "length", "line", "log", "part", "punctuation", "role", "words")


def nodes(text: str, url: str | None = None) -> list[Node | None]:
    """The lines of a page as nodes; None for blank lines and images."""
    brand, part, block, out = brand_of(url), "top", "", []
    for raw in fold(text).split("\n"):
        line = plain(raw)
        if not line or line.isspace() or line.startswith("[Image"):
            out.append(None)
            continue
        n = Node()
        n.line, low = line, line.lower()
        n.words = words = WORD.findall(low)
        n.role = what = _role(low, words, brand)
        if not what and HEADING.match(line):
            part, block = HEADING.match(line)[1].lower(), "heading"
            n.leaf = "heading"
        else:
            if what == "sidebar":
                block = "sidebar"
            elif not what and COUNTED.match(line):
                n.role, block = "sidebar", "sidebar"
            elif not what and block == "sidebar" and TITLE.match(line) and line.count(" ") + line.count("-") >= 2:
                n.role = "sidebar"
            else:
                block = "paragraph" if len(line) > 80 else "short"
            n.leaf = n.role or ("quantity" if QUANTITY.match(line) else "title" if TITLE.match(line) else "sentence" if line[-1] in ".!?。" else "other")
        n.part, n.block, n.length = part, block, min(len(line), LONG)
        n.punctuation = sum(map(line.count, ASCII_PARTS if line.isascii() else SENTENCE_PARTS))
        count = len(words) or 1
        hits = [SITE_WORDS[w] for w in words if w in SITE_WORDS]
        n.density = sum(hits) / count if hits and PLACES.search(line) is None else 0.0
        n.function = len([w for w in words if w in FUNCTION_WORDS]) / count
        n.log = math.log1p(n.length)
        out.append(n)
    return out


@lru_cache(maxsize=8)
def _window(sigma: float) -> tuple[tuple[int, float], ...]:
    reach = max(1, math.ceil(2 * sigma))
    return tuple((d, math.exp(-0.5 * (d / sigma) ** 2)) for d in range(-reach, reach + 1) if d)


def features(page: list[Node | None], sigma: float = 1.0) -> list[tuple[float, ...]]:
    """The vector of each node, in the order of ``FEATURES``: ratios of its paths and neighbours, and what it shows itself."""
    shown = [n for n in page if n is not None]
    paths: dict[tuple, list[float]] = {}
    blocks: dict[tuple, list[float]] = {}
    for n in shown:
        key = (n.part, n.block, n.leaf)
        if (sums := paths.get(key)) is None:
            sums = paths[key] = [0, 0, 0, 0.0]
        sums[0] += 1
        sums[1] += n.length
        sums[2] += n.punctuation
        sums[3] += n.density
    for (part, block, _), sums in paths.items():
        above = blocks.setdefault((part, block), [0, 0.0])
        above[0] += sums[0]
        above[1] += sums[3]
    # what lines of one path share is computed once
    shared = {k: (math.log1p(v[1] / v[0]), math.log1p(v[2] / v[0]), v[3] / v[0], blocks[k[:2]][1] / blocks[k[:2]][0]) for k, v in paths.items()}
    densities, logs, last = [n.density for n in shown], [n.log for n in shown], len(shown)
    window, out = _window(sigma), []
    for i, n in enumerate(shown):
        length, punctuation, density, block = shared[n.part, n.block, n.leaf]
        weight = near = far = 0.0
        for d, w in window:
            j = i + d
            if 0 <= j < last:
                weight += w
                near += w * densities[j]
                far += w * logs[j]
        weight = weight or 1.0
        what, own = n.role, n.density
        out.append((
            1.0, length, punctuation, own, density, block, near / weight, far / weight,
            1.0 if what and what not in ("menu", "sidebar") else 0.0,  # the site's own name among them
            1.0 if what == "menu" else 0.0, 1.0 if what == "sidebar" else 0.0, 0.0 if own or what else 1.0, 1.0 if n.leaf == "title" else 0.0, 1.0 if QUANTITY.match(n.line) else 0.0,
            1.0 if n.line[-1] in ".!?。" else 0.0, 1.0 if n.part == "top" else 0.0, n.function, n.log, own if len(n.words) <= 6 else 0.0, n.function if what else 0.0,
        ))
    return out


def furniture(text: str, url: str | None = None, weights: tuple[float, ...] | None = None) -> list[int]:
    """1-based numbers of the lines whose fused score is below zero; blank lines, images and headings of the body never."""
    page = nodes(text, url)
    weights, out = weights or WEIGHTS, []
    scored = iter(features(page))
    for i, n in enumerate(page, 1):
        if n is not None and sumprod(next(scored), weights) < THRESHOLD and n.leaf != "heading":
            out.append(i)
    return out


def labelled(text: str, url: str | None = None) -> list[tuple[tuple[float, ...], bool]]:
    """What ``fit`` takes of a page: the features of each line, and whether a known wording makes it furniture; headings of the body left out."""
    page = [n for n in nodes(text, url) if n is not None]
    return [(x, bool(n.role)) for x, n in zip(features(page), page) if n.leaf != "heading"]


def fit(rows: list[tuple[tuple[float, ...], bool]], rounds: int = 500, penalty: float = 3e-3, withheld: float = 0.2, seed: int = 3) -> tuple[float, ...]:
    """Weights by logistic regression over (features, furniture or not), by Adam.

    The features that known wordings give are withheld at random for a share
    of the rows, so that ratios must carry what no list holds.
    """
    import numpy as np

    r = np.random.default_rng(seed)
    x, y = np.array([a for a, _ in rows]), np.array([0.0 if b else 1.0 for _, b in rows])
    named = [FEATURES.index(f) for f in ("wording", "menu", "sidebar", "cue and function words")]
    hidden = r.random(len(x)) < withheld
    x[np.ix_(hidden, named)] = 0.0
    w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for step in range(1, rounds + 1):
        g = x.T @ (1 / (1 + np.exp(-(x @ w))) - y) / len(x) + penalty * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return tuple(round(float(a), 3) for a in w)


def furniture_lines(df: DataFrame, key: str, text: str, url: str) -> DataFrame:
    """``key, line_no`` of every furniture line. Null and empty texts have none; no shuffle."""

    def make():
        def row(k, t, u):
            if t:
                for n in furniture(t, u):
                    yield k, n

        return row

    kind = df.schema[key].dataType.simpleString()
    return arrow_flat_map(df.select(F.col(key), F.col(text), F.col(url)), make, f"`{key}` {kind}, line_no int")


def body(text: str, url: str | None = None) -> str:
    """The text without its furniture lines, in its order."""
    drop = set(furniture(text, url))
    return "\n".join(line for i, line in enumerate(text.split("\n"), 1) if i not in drop) if drop else text


def main_content(df: DataFrame, key: str, text: str, url: str) -> DataFrame:
    """``key, clean``: each text reduced to its body; null stays null. No shuffle."""

    def make():
        def row(k, t, u):
            yield k, None if t is None else body(t, u)

        return row

    kind = df.schema[key].dataType.simpleString()
    return arrow_flat_map(df.select(F.col(key), F.col(text), F.col(url)), make, f"`{key}` {kind}, clean string")
