"""Problem 7: template residue, filler and error pages.

Lines of the same template are aligned by their frame, the words around their
slots (for a slot that is a whole line, the line before or after it). A place
that the other records of the site fill with varying words is a slot, and one
still holding a name in marks, a default or a blank is residue. A name counts
as a variable also by its form, or where the corpus shows it in several kinds
of marks. Error messages and script
notices are told by their wording, and weaker wording counts where the same
whole page, digits and names aside, stands at several urls.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boilerplate
from .common import arrow_flat_map, checkpoint, site_of
from .visual import fold

NAME = r"[A-Za-z][A-Za-z0-9]*(?:[_. ][A-Za-z0-9]+){0,3}"
#: Marks that only templates use, and marks that prose uses too.
SURE = [("{{", re.compile(r"\{\{ ?(" + NAME + r") ?\}\}")), ("${", re.compile(r"\$\{(" + NAME + r")\}")), ("@@", re.compile(r"@@(" + NAME + r")@@")), ("%%", re.compile(r"%%(" + NAME + r")%%")),
        ("insert", re.compile(r"\[+INSERT (" + NAME + r") HERE\]+")), ("<%", re.compile(r"<%=? ?(" + NAME + r") ?%>")), ("[%", re.compile(r"\[%=? ?(" + NAME + r") ?%\]")), ("#{", re.compile(r"#\{ ?(" + NAME + r") ?\}")),
        ("[[", re.compile(r"\[\[ ?([A-Za-z][A-Za-z0-9]*(?:[_.][A-Za-z0-9]+)+) ?\]\]")), ("$", re.compile(r"\$([A-Za-z]+(?:[_.][A-Za-z]+)+)\$")), ("<", re.compile(r"<((?:your|insert|enter|add|put|type) [^<>\n]{1,60})>", re.I))]
OPEN = [("[", re.compile(r"(?<!\[)\[(" + NAME + r")\](?![\](])")), ("{", re.compile(r"(?<![{$\\\w])\{(" + NAME + r")\}(?!\})")), ("%", re.compile(r"(?<![%\w])%(" + NAME + r")%(?![%\w])")),
        ("#", re.compile(r"(?<![#\w])#(" + NAME + r")#(?![#\w])")), ("__", re.compile(r"(?<![_\w])__(" + NAME + r")__(?![_\w])"))]
TODO = ("todo", re.compile(r"^(?:.{0,40}\b)?(?:TODO|TBD|FIXME): (" + NAME + r")\b"))
GOES_HERE = ("here", re.compile(r"^[\[<(]?(?:your |the )?(" + NAME + r") (?:goes|comes|will be) here[.!\])>]*$", re.I))
PUT_HERE = ("put", re.compile(r"^[\[<(]?(?:please )?(?:insert|enter|add|put|type|write|paste) (?:your |the |an? |some )?(" + NAME + r") here[.!\])>]*$|^click (?:here )?to (?:edit|add|change) (?:this |the |your |some )?(?:text|title|content|caption|heading|description|paragraph)[.!]?$", re.I))
MARK = re.compile(r"\{|@@|%|\[|#|__|TODO|TBD|FIXME|<[%yieaptYIEAPT]|\$[A-Za-z]| here[.!\])>]*$|^[Cc]lick (?:here )?to ", re.M)
VARIABLE = re.compile(r"[A-Za-z0-9]+(?:[_.][A-Za-z0-9]+)+|[A-Z]{4,}(?: [A-Z]+)*")

# Wording of error messages, of script notices, and of filler.
ERROR = re.compile(
    r"\b(?:^(?:http )?error(?: code)? \d+|\b[45]\d\d (?:forbidden|not found|bad gateway|unauthori[sz]ed|gone|error|service|gateway|internal|too many)|access (?:was |is |has been )?denied(?! to the (?!page|site|server|resource|requested))|do not have permission|not authori[sz]ed to|"
    r"bad gateway|internal server error|gateway time-?out|service (?:is )?(?:temporarily )?unavailable|temporarily unavailable|(?:due to|under|for) (?:scheduled )?maintenance|database connection|fatal error|"
    r"call to undefined|undefined (?:function|variable|index)|stack trace|http status|status code|upstream|server took too long|too many requests|request \S+ was not completed|session has expired|"
    r"please sign in again|something went wrong|went wrong on our side|(?:page|post|entry|article|document|recipe|guide|listing|content|resource|item) (?:was |could |can |is )?(?:not found|not be found|is gone|does not exist|doesn.t exist|no longer exists)|"
    r"could not be found|does not exist (?:any ?more|right now|yet|or)|(?:may have|has|have) been (?:moved|removed|deleted)|no longer available|link is (?:broken|dead)|nothing (?:was found|here\b|to see)|not available in your (?:area|country|region)|"
    r"verify (?:that )?you are (?:a )?human|are you a robot|checking your browser|slow down and reload|cannot show this|can.?not be (?:shown|displayed|loaded)|could not (?:be )?load(?:ed)?\b|page is gone|that (?:page|recipe) is gone|"
    r"(?:responded|replied|response|returned|failed) with (?:an? )?(?:code |status |error )*[45]\d\d|connection (?:has )?(?:timed out|was refused|refused|was reset|reset)|requested (?:url|address)|(?:page|post|entry|article|document|recipe|guide|listing|content|resource|item|website) (?:is |was )?(?:currently )?unavailable|"
    r"site (?:has been|is) (?:suspended|disabled)|must renew the plan|account (?:has been )?suspended|domain (?:has expired|is parked|is for sale)|bandwidth limit|quota exceeded|please (?:try again|reload|refresh))",
    re.I,
)
FOLLOW_UP = re.compile(
    r"\b(?:try (?:again|one of our other)|return to the (?:previous|home|start)|go back to|use the search box|check the spelling|if the problem persists|write to support|contact (?:the |our )?(?:administrator|webmaster|support|owner)|"
    r"we apologi[sz]e|sorry for|please try|reload|owner of this site|come back later|error reference|reference code)\b",
    re.I,
)
SCRIPT = re.compile(r"java ?script|\bscripts?\b|client-side scripting|script engine|\bnoscript\b", re.I)
SCRIPT_NEED = re.compile(r"\b(?:enable|turn(?:ed)? on|switch\b.*\bon|requires?|needs?|need to|without it|disabled|blocks?|runs on|is off|out of date|not supported|must be|must have|enabled|(?:does|do) not support|activate|allow)\b", re.I)
FILLER = re.compile(r"^(?:sample|placeholder|dummy|example|demo|filler|default)\b.{0,30}\b(?:text|caption|paragraph|content|title|heading|entry|image|publishing|layout)\b|^(?:test[ ,.!]*){3,}|\bplease ignore this\b|\breplace (?:this |me )?before publishing\b|^(?:just |this is )?(?:an? )?(?:dummy|placeholder|filler) (?:text|content|paragraph)\b|^(?:blah[ ,.]*){2,}|^(?:asdf|qwerty|foo bar)\b", re.I)
LATIN = frozenset("lorem ipsum dolor amet consectetur adipiscing elit sed eiusmod tempor incididunt labore dolore magna aliqua".split())
EVERYDAY = frozenset("the of and a to in is it you that was for on are with as at be this from or by not but all can an your if then until when about up out into them over so".split())
BLANK = re.compile(r"^[\W_]*(?:n/?a|null|none|undefined|nan|untitled|tbd|tba|todo|_{3,}|\.{4,}|-{1,2}|x{3,}(?:[ -]x{3,})*)[\W_]*$", re.I)
WORDS = re.compile(r"[^\W\d_]+")


#: What stands before an argument of a LaTeX command, which is no template place.
COMMAND = re.compile(r"\\[A-Za-z]+\*?(?:\[[^\[\]]*\])?(?:\{[^{}]*\})*$")


CODE = re.compile(r"[\\\"=;()]|\{\{|^\s*[{}]")


def slots(line: str) -> list[tuple[str, str, int, int]]:
    """``(marks, name, start, end)`` of the marked slots of a line."""
    out = []
    for marks, pattern in (*SURE, *OPEN, TODO, GOES_HERE, PUT_HERE):
        for m in pattern.finditer(line):
            if marks != "{" or not COMMAND.search(line[: m.start()]):
                # a bare word in braces is no prose; only formulas and code hold others
                sure = marks == "{" and len(m[1]) > 2 and m[1].isalpha() and CODE.search(line) is None
                out.append(("{}" if sure else marks, m[1] or "", m.start(), m.end()))
    return out


SURE_MARKS = frozenset([k for k, _ in SURE] + ["todo", "here", "put", "{}"])


def is_variable(marks: str, name: str) -> bool:
    """Whether marks and form alone show a variable."""
    return marks in SURE_MARKS or VARIABLE.fullmatch(name) is not None


SENTENCES = re.compile(r"(?<=[.!?…])\s+|\s*[|•·]\s*")
CLAUSES = re.compile(r"(?<=[,;:])\s+|\s+[–—-]\s+|\s{2,}")
#: A wording tells about so many characters around it; longer lines are judged by their parts.
REACH = 260


def wording(text: str) -> str:
    """``error``, ``script``, ``filler`` or ``follow`` by the wording of a line or sentence; empty for none of them."""
    if ERROR.search(text):
        return "error"
    if SCRIPT.search(text) and SCRIPT_NEED.search(text) and not re.search(r"\b(?:do|does) not need\b", text, re.I):
        return "script"
    if FILLER.search(text):
        return "filler"
    if FOLLOW_UP.search(text) and len(WORDS.findall(text)) <= 16:
        return "follow"
    return ""


def shared_wording(text: str) -> str:
    """``wording`` of a long line: the one of most characters, where at least half of the line's sentences have any."""
    parts = [c for x in SENTENCES.split(text) for c in ([x] if len(x) <= REACH else CLAUSES.split(x)) if c]
    told: dict[str, int] = {}
    for x in parts:
        if kind := wording(x):
            told[kind] = told.get(kind, 0) + min(len(x), REACH)
    if 2 * sum(told.values()) < sum(map(len, parts)) or not told:
        return ""
    strong = [k for k in told if k != "follow"]
    return max(strong, key=told.__getitem__) if strong else "follow"


def state(line: str) -> str:
    """``error``, ``script``, ``follow``, ``filler``, ``latin`` or ``blank`` by a line's wording; empty for none of them."""
    text = line.strip()
    words = WORDS.findall(text.lower())
    if BLANK.match(text):
        return "blank"
    if kind := wording(text) if len(text) <= REACH else shared_wording(text):
        return kind
    if len(words) >= 3 and EVERYDAY.isdisjoint(words) and not LATIN.isdisjoint(words) and len(LATIN.intersection(words)) * 12 >= len(set(words)):
        return "latin"
    return ""


# Beginnings of six and of four letters: every wording above but that of blanks and scripts holds a word that begins so.
# Ends of words are open, as the patterns leave them open.
GATE_LONG = frozenset(x[:6] for x in "respond responded replied response returned connection requested unavailable forbidden gateway unauthorized service internal access permission authorized temporarily maintenance database undefined http status upstream server request session deleted removed available verify displayed suspended disabled account domain bandwidth problem support apologize spelling reference sample placeholder filler default qwerty browser refresh cannot failed administrator".split())
GATE_SHORT = frozenset(x[:4] for x in "error found gone many perm fatal stack wrong exist moved robot reload load renew quota owner dummy demo blah asdf foo".split())
# Words that prose is full of: the wordings that need one of them say it in one of these phrases ("^" is the line's beginning).
VAGUE = {
    "test": ("^test",), "exampl": ("^example",), "return": ("return to the ",), "nothin": ("nothing was found", "nothing here", "nothing to see"), "show": ("show this", "be shown"), "link": ("link is ",), "try": ("try again", "try one of our other"),
    "please": ("please try", "please reload", "please refresh", "please sign in again", "please ignore this"), "back": ("go back to", "come back later"), "contac": ("contact the ", "contact our ", "contact admin", "contact webm", "contact support", "contact owner"),
    "replac": ("replace this", "replace me", "replace before"), "search": ("use the search box",), "sorr": ("sorry for",), "slow": ("slow down and reload",), "can": ("can not be ", "can't be ", "can’t be "),
}
VAGUE_LONG, VAGUE_SHORT = frozenset(k for k in VAGUE if len(k) == 6), frozenset(k for k in VAGUE if len(k) < 6)


def may_tell(line: str) -> bool:
    """Whether ``state`` can be other than empty; true too often, never false too often."""
    low = line.casefold()
    words = WORDS.findall(low)
    long, short = [w[:6] for w in words], [w[:4] for w in words]
    if "script" in low or not (GATE_LONG.isdisjoint(long) and GATE_SHORT.isdisjoint(short) and LATIN.isdisjoint(words)):
        return True
    vague = [*VAGUE_LONG.intersection(long), *VAGUE_SHORT.intersection(short)]
    return any(low.startswith(x[1:]) if x[0] == "^" else x in low for k in vague for x in VAGUE[k]) or BLANK.match(line.strip()) is not None


EVIDENT = frozenset(("error", "script", "filler", "latin"))


def examine(text: str, url: str | None = None) -> tuple[bool, list[tuple[str, str]], bytes | None]:
    """``(evident, slots, page)`` of a text.

    ``evident``: some section is residue by its own wording. ``slots``: its
    (marks, name); where the text isn't evident, only the corpus can tell their
    nature. ``page``: digest of the page's template where the wording of a
    whole page is weak.
    """
    text = fold(text)
    raws = text.split("\n")
    lines = [boilerplate.plain(raw) for raw in raws]
    states = [state(x) if x and may_tell(x) else "" for x in lines]
    marked = [slots(raw.strip()) if MARK.search(raw) else [] for raw in raws] if MARK.search(text) else [[] for _ in raws]
    if not any(states) and not any(marked):
        return False, [], None
    drop = set(boilerplate.furniture(text, url))
    sections: list[list[tuple[str, str]] | None] = [[]]
    evident, named = False, []
    for i, line in enumerate(lines):
        if not line and marked[i]:  # a place in angle brackets is a tag to the reader of lines
            evident = evident or any(is_variable(marks, name) for marks, name, _, _ in marked[i])
        if i + 1 in drop and (states[i] not in ("error", "script") or boilerplate.role(line) in ("script", "menu", "share")) or not line or line.startswith("[Image"):
            continue
        if boilerplate.HEADING.match(line):
            # values below the nutrition heading are no section of their own
            sections.append(None if line[:9].lower() == "nutrition" else [])
            continue
        for marks, name, _, _ in marked[i]:
            evident = evident or is_variable(marks, name)
            named.append((marks, name))
        if sections[-1] is not None:
            sections[-1].append((line, states[i]))
    weak = 0
    whole = [x for s in sections if s for x in s]
    for s in sections:
        if not s:
            continue
        kinds = [k for _, k in s]
        if "latin" in kinds:  # what stands beside Latin filler without one everyday word is filler too
            kinds = [k or ("latin" if len(w := WORDS.findall(x.lower())) >= 3 and EVERYDAY.isdisjoint(w) else "") for x, k in s]
        strong = sum(k in EVIDENT for k in kinds)
        if strong and 2 * (strong + sum(k in ("follow", "blank") for k in kinds)) >= len(s):
            evident = True
        weak += sum(bool(k) for k in kinds)
    page = None
    if not evident and weak and 2 * weak >= len(whole):
        template = "\n".join(re.sub(r"\d+", "0", x.lower()) for x, _ in whole)
        page = hashlib.blake2b(template.encode("utf-8", "surrogatepass"), digest_size=16).digest()
    return evident, named, page


# What a template holds before it is filled. "None" and "n/a" answer a question, so they fill a slot.
DEFAULT = re.compile(r"(?<![\w/])(?:null|undefined|NaN|[Uu]ntitled|TBD|TODO|[xX]{3,})(?![\w/])|(?<!\w)_{3,}(?!\w)|\.{4,}")
#: Places where a word is missing: between two blanks, and before a mark that ends something.
GAP = re.compile(r"(?<=\S )(?= \S)|(?<=\w )(?=[.,;!?](?:\s|$))")
#: Without any of these, a text has neither.
HINTS = ("  ", " .", " ,", " ;", " !", " ?", "null", "undefined", "NaN", "ntitled", "TBD", "TODO", "xxx", "xxX", "xXx", "xXX", "Xxx", "XxX", "XXx", "XXX", "___", "....")
LIST_MARK = re.compile(r"^(?:(?:[-*+•·▢☐◦‣–#>]+|\d{1,3}[.)])\s+)+")
PIECE = re.compile(r"\w+|\s+|[^\w\s]")
DIGITS = re.compile(r"\d+")
#: A whole sentence stands beside a frame, not in it; tags and entities fill nothing.
SENTENCE_END = re.compile(r"[.!?…][\"'”’)\]]*$")
TAG_OR_ENTITY = re.compile(r"<[^<>]*>|&#?\w+;")
WORDY = re.compile(r"[^\W_]")
LETTERS = re.compile(r"[^\W\d_]+")
BITS = 1 << 22


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _key(site: str, kind: str, head: str, tail: str) -> bytes:
    return hashlib.blake2b(_bytes("\0".join((site, kind, head, tail))), digest_size=16).digest()


def _form(text: str) -> str:
    return DIGITS.sub("0", text)


def _tail_crc(text: str) -> int:
    crc = 0
    for piece in reversed(PIECE.findall(text)):
        crc = zlib.crc32(_bytes(_form(piece)), crc)
    return crc


def _hint_crc(seed: int, head: str, tail: str) -> int:
    """Checksum of the first word of a frame and of its last one, as far as the holes leave them whole."""
    first, last = _bytes(head).split(None, 1), _bytes(tail).rsplit(None, 1)
    one = first[0] if len(first) == 2 or first and head[-1:] == " " else b""
    return zlib.crc32(b"%b\0%b" % (one, last[-1] if len(last) == 2 or last and tail[:1] == " " else b""), seed)


def _count(text: str) -> int:
    return len(LETTERS.findall(text))


def _lines(text: str) -> list[tuple[int, str]]:
    """Number and wording of the lines that aren't blank, without marks of lists and headings."""
    return [(i, x) for i, raw in enumerate(text.split("\n"), 1) if (x := LIST_MARK.sub("", raw.strip()))]


def _label(line: str) -> bool:
    return line.endswith(":") or boilerplate.HEADING.match(boilerplate.plain(line)) is not None


def _quoted(text: str) -> str:
    """A constant piece of a frame as a pattern of the JVM; numbers stand for any number."""
    return r"\d+".join("\\Q" + x.replace("\\E", "\\E\\\\E\\Q") + "\\E" if x else "" for x in DIGITS.split(text))


def unfilled(text: str, url: str | None, site: str) -> list[tuple[bytes, int, int, int, str, int, bool, list[str]]]:
    """``(key, hint, head, tail, inner, words, label, names)`` of the frames of a text's lines with names in open marks, defaults or blanks.

    The frame of a line is what is constant around all its holes. ``key``: its
    site and what stands before the first hole and after the last one; ``hint``,
    ``head`` and ``tail``: checksums of these; ``inner``: pattern of what stands between,
    a group for each hole; ``words``: most words that this part of an aligned
    line has, so that no more words vary than agree, except after a label;
    ``names``: what the holes hold, empty for defaults and blanks. A hole that
    is the whole line lies between the lines beside it, furniture aside.
    """
    text = fold(text)
    hints = [x for x in HINTS if x in text]
    if not (hints or MARK.search(text)):
        return []
    seed = zlib.crc32(_bytes(site))
    lines, out, drop = _lines(text), [], None
    for at, (i, line) in enumerate(lines):
        spans = [(a, b, n) for _, n, a, b in slots(line)] if MARK.search(line) else []
        if any(x in line for x in hints):
            spans += [(m.start(), m.end(), "") for m in DEFAULT.finditer(line)]
            gaps = [(m.start(), m.end(), "") for m in GAP.finditer(line)]
            spans += gaps if len(gaps) == 1 else []  # more of them are how the line is spaced
        if not spans or line.startswith("[Image"):
            continue
        drop = set(boilerplate.furniture(text, url)) if drop is None else drop
        if i in drop:
            continue
        holes: list[tuple[int, int, str]] = []
        for span in sorted(spans):
            if not holes or span[0] >= holes[-1][1]:
                holes.append(span)
        names = [n.lower() for _, _, n in holes]
        head, tail = _form(line[: holes[0][0]]), _form(line[holes[-1][1] :])
        if not head and not tail and len(holes) == 1:
            for kind, j in (("before", at - 1), ("after", at + 1)):
                if 0 <= j < len(lines) and lines[j][0] not in drop and (words := _count(lines[j][1])):
                    beside = _form(lines[j][1])
                    out.append((_key(site, kind, beside, ""), zlib.crc32(_bytes(beside), seed), -1, -1, "(?s)^(.+)$", words, kind == "before" and _label(lines[j][1]), names))
            continue
        between = [line[a[1] : b[0]] for a, b in zip(holes, holes[1:])]
        words = _count(head) + _count(tail) + 2 * sum(map(_count, between))
        if words:
            inner = "(?s)^" + "".join("(.+?)" + _quoted(x) for x in between) + "(.+)$"
            out.append((_key(site, "line", head, tail), _hint_crc(seed, head, tail), zlib.crc32(_bytes(head)), _tail_crc(tail), inner, words, not tail and head.rstrip().endswith(":"), names))
    return out


def filled(text: str, site: str, hints: bytes, heads: bytes, tails: bytes, keys: bytes, most: int) -> Iterator[tuple[bytes, str, int]]:
    """``(key, filler, words)`` of every line that may lie in one of the frames, by the bits of their hints, heads, tails and keys.

    ``most``: most words that frames with several holes allow. Bits can
    only pass too many; the keys are joined afterwards.
    """
    crc32 = zlib.crc32

    def has(bits: bytes, n: int) -> int:
        n %= BITS
        return bits[n >> 3] >> (n & 7) & 1

    def known(kind: str, head: str, tail: str) -> bytes | None:
        key = _key(site, kind, head, tail)
        return key if has(keys, int.from_bytes(key[:4], "big")) else None

    def within(line: str) -> Iterator[tuple[bytes, str, int]]:
        pieces = PIECE.findall(line)
        forms = [_form(p) for p in pieces]
        crc, starts = 0, []
        for i, piece in enumerate(pieces):
            if has(heads, crc) and not piece.isspace():
                starts.append(i)
            crc = crc32(_bytes(forms[i]), crc)
        if not starts:
            return
        crc, ends = 0, []
        for j in range(len(pieces), starts[0], -1):
            if has(tails, crc) and not pieces[j - 1].isspace():
                ends.append(j)
            crc = crc32(_bytes(forms[j - 1]), crc)
        for i in starts:
            for j in ends:
                if i < j < i + len(pieces):
                    head, tail, filler = "".join(forms[:i]), "".join(forms[j:]), "".join(pieces[i:j])
                    n, label = _count(filler), not tail and head.rstrip().endswith(":")
                    if (label or n <= max(most, _count(head) + _count(tail)) and not SENTENCE_END.search(filler)) and (key := known("line", head, tail)):
                        yield key, filler, n

    seed = crc32(_bytes(site))
    open_ = has(hints, crc32(b"\0", seed))
    lines = [x for _, x in _lines(fold(text))]
    beside = []
    got: list[tuple[bytes, str, int]] = []
    for line in lines:
        form = _bytes(_form(line))
        beside.append(has(hints, crc32(form, seed)))
        first, last = form.split(None, 1)[0], form.rsplit(None, 1)[-1]
        if open_ or has(hints, crc32(first + b"\0" + last, seed)) or has(hints, crc32(first + b"\0", seed)) or has(hints, crc32(b"\0" + last, seed)):
            got.extend(within(line))
    if any(beside):
        for at, line in enumerate(lines):
            for kind, j in (("before", at - 1), ("after", at + 1)):
                if 0 <= j < len(lines) and beside[j] and (key := known(kind, _form(lines[j]), "")):
                    got.append((key, line, _count(line)))
    for x in got:
        if WORDY.search(TAG_OR_ENTITY.sub("", x[1])) and not (MARK.search(x[1]) and slots(x[1]) or DEFAULT.search(x[1])):
            yield x


def _induced(df: DataFrame, text: str, url: str, holes: DataFrame, min_urls: int) -> DataFrame:
    """``_id`` of the rows of ``holes`` where a hole is a slot: the frame has other fillers, at ``min_urls`` urls of the site and not all the same.

    A name that is also among the fillers is a word in emphasis. Lines are
    sought by fixed bit tables of the frames, 512 KB each whatever the corpus.
    """
    key_bits = F.conv(F.substring(F.hex("_key"), 1, 8), 16, 10).cast("bigint")
    bits = holes.select(F.posexplode(F.array("_hint", "_head", "_tail", key_bits)).alias("what", "n")).where("n >= 0").select("what", (F.pmod("n", F.lit(BITS)) + 1).alias("n"))
    tables = [bytearray(BITS // 8) for _ in range(4)]
    for r in bits.groupBy("what", F.bitmap_bucket_number("n").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits")).collect():
        tables[r.what][(r.b - 1) * 4096 : r.b * 4096] = r.bits
    if not any(tables[3]):
        return holes.select("_id").limit(0)
    hints, heads, tails, keys = map(bytes, tables)
    most = holes.agg(F.max("_between")).first()[0]

    def make():
        def row(t, u, site):
            if t:
                for key, filler, n in filled(t, site, hints, heads, tails, keys, most):
                    yield key, filler, n, u

        return row

    lines = arrow_flat_map(df.select(F.col(text), F.col(url), F.coalesce(site_of(F.col(url)), F.lit("")).alias("_site")), make, "_key binary, _filler string, _n int, _u string").distinct()
    frames = holes.select("_key", "_inner", "_words", "_label", F.size("_names").alias("_holes")).distinct()
    aligned = lines.join(frames, "_key").where("(_n <= _words or _label) and _filler rlike _inner")
    fillers = aligned.select("_key", "_inner", "_u", F.explode(F.expr("transform(sequence(1, _holes), i -> struct(i AS hole, regexp_extract(_filler, _inner, i) AS word))")).alias("x")).select("_key", "_inner", "_u", F.col("x.hole").alias("_hole"), F.regexp_replace(F.lower("x.word"), r"^\W+|\W+$", "").alias("_word"))
    places = ["_key", "_inner", "_hole"]
    varying = fillers.groupBy(*places).agg(F.count_distinct("_u").alias("_m"), F.count_distinct("_word").alias("_w")).where(f"_m >= {int(min_urls)} and _w >= 2").select(*places)
    held = holes.select("_id", "_key", "_inner", F.posexplode("_names").alias("_hole", "_word")).withColumn("_hole", F.col("_hole") + 1)
    return held.join(varying, places, "left_semi").join(fillers.select(*places, "_word").distinct(), [*places, "_word"], "left_anti").select("_id")


def residue(df: DataFrame, key: str, text: str, url: str, min_urls: int = 3) -> DataFrame:
    """``key`` of every row whose text, or a section of it, is residue.

    Names in open marks, defaults and blanks are residue where aligned lines of
    the site fill their place otherwise at ``min_urls`` urls. Names are variables
    also where two kinds of marks and ``min_urls`` urls show them; pages of weak
    wording count where ``min_urls`` urls have the same template. These tables
    hold suspicious texts only, and of other texts the lines in their frames.
    Null and empty texts are never residue; rows with repeated keys count on their own.
    """
    kind = df.schema[key].dataType.simpleString()

    def make():
        def row(k, t, u, site):
            if t:
                evident, named, page = examine(t, u)
                frames = [] if evident else unfilled(t, u, site)
                if evident or named or page or frames:
                    held = [{"_key": a, "_hint": h, "_head": b, "_tail": c, "_inner": d, "_words": w, "_label": e, "_names": n, "_between": w if len(n) > 1 else 0} for a, h, b, c, d, w, e, n in frames]
                    yield k, u, evident, [f"{m}\0{n}" for m, n in dict.fromkeys(named)], page, held

        return row

    # a small table read several times; texts are examined once
    frame = "array<struct<_key:binary,_hint:bigint,_head:bigint,_tail:bigint,_inner:string,_words:int,_label:boolean,_names:array<string>,_between:int>>"
    seen = checkpoint(arrow_flat_map(df.select(F.col(key), F.col(text), F.col(url), F.coalesce(site_of(F.col(url)), F.lit("")).alias("_site")), make, f"_k {kind}, _u string, _evident boolean, _slots array<string>, _page binary, _frames {frame}"))
    doubtful = seen.where(~F.col("_evident"))
    names = seen.select("_u", F.explode("_slots").alias("_s")).select("_u", F.split("_s", "\0").getItem(0).alias("_marks"), F.split("_s", "\0").getItem(1).alias("_name"))
    variables = names.groupBy("_name").agg(F.count_distinct("_marks").alias("_m"), F.count_distinct("_u").alias("_n")).where(f"_m >= 2 and _n >= {int(min_urls)}").select("_name")
    pages = doubtful.where(F.col("_page").isNotNull()).groupBy("_page").agg(F.count_distinct("_u").alias("_n")).where(f"_n >= {int(min_urls)}").select("_page")
    ids = doubtful.withColumn("_id", F.monotonically_increasing_id())
    by_name = ids.select("_k", F.explode(F.transform("_slots", lambda x: F.split(x, "\0").getItem(1))).alias("_name"), "_id").join(variables, "_name", "left_semi").select("_k", "_id")
    by_page = ids.join(pages, "_page", "left_semi").select("_k", "_id")
    by_frame = ids.join(_induced(df, text, url, ids.select("_id", F.inline("_frames")), min_urls), "_id", "left_semi").select("_k", "_id")
    return seen.where("_evident").select(F.col("_k").alias(key)).unionByName(by_name.union(by_page).union(by_frame).distinct().select(F.col("_k").alias(key)))


def without_residue(df: DataFrame, key: str, text: str, url: str) -> DataFrame:
    """The rows of ``df`` whose key is not among the residue; keys are taken as unique, null keys stay."""
    return df.join(residue(df, key, text, url).distinct(), key, "left_anti")
