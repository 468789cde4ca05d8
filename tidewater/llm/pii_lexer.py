"""Splits text into the tokens over which the field for personal information is laid.

Numbers, addresses and mail addresses that keep one fixed shape become single tokens with a class;
everything else becomes word, mark or line-end tokens. The lexer only proposes shapes: whether a
token is personal is decided by the field, from its class, its words and its surroundings.

Text is first cut into plain runs, which costs little; a shape is tried only where a run can begin
one (a digit, an at sign, a street word), so plain prose pays for no shape.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate
from typing import NamedTuple

_BLANKS = "     "
S = rf"(?:[{_BLANKS}.\-/]| ?[-–] ?)"  # between the groups of a phone number
D = rf"(?:[{_BLANKS}.\-]| ?[-–] ?)?"  # between the groups of a document number, may be absent
G = rf"(?:[{_BLANKS}.\-]| ?[-–] ?)"  # the same, present
_L, _R = r"(?<![\w@#$€£])(?<!\d[.,\-/])", r"(?![\w@])(?![.\-/]\d)"  # a number stands by itself

# ---- fixed values: shapes of numbers in the numbering plans of the texts' countries ----------
PHONES = (
    rf"(?:\+?1{S})?(?:\(\d{{3}}\)(?: ?[-–] ?|[{_BLANKS}])?|\d{{3}}{S})\d{{3}}{S}\d{{4}}",
    rf"(?:\+44{S}(?:\(0\))?7\d{{3}}|07\d{{3}}){S}(?:\d{{6}}|\d{{3}}{S}\d{{3}})",
    rf"(?:\+44{S}(?:\(0\))?20|020){S}\d{{4}}{S}\d{{4}}",
    rf"(?:\+49{S}(?:\(0\) ?)?\d{{2,4}}|0\d{{2,4}}){S}\d{{4,6}}{S}\d{{2,4}}",
    rf"(?:(?:\+|00)33{S}(?:\(0\) ?)?\d|0\d)(?:{S}\d\d){{4}}",
    rf"(?:\+|00)34{S}(?:\d{{3}}(?:{S}\d\d){{3}}|\d{{3}}{S}\d{{3}}{S}\d{{3}}|\d{{9}})",
    r"\+\d{10,13}|00(?:33|34|44|49)\d{9,11}",
)
DOCUMENTS = (
    ("card", rf"[A-Z]{{2}}(?:{D}\d{{4}}){{3}}"),
    ("ni", rf"[A-Z]{{2}}(?:\d{{6}}|(?:{G}\d\d){{3}}{G})[A-D]"),
    ("fr15", rf"[12]{G}\d\d{G}\d\d{G}\d\d{G}\d{{3}}{G}\d{{3}}{G}\d\d|[12]\d{{14}}"),
    ("ssn", rf"\d{{3}}{G}\d\d{G}\d{{4}}|\d{{9}}"),
    ("tax11", rf"\d\d(?:{G}\d{{3}}){{3}}|\d{{11}}"),
    ("dni", r"(?:\d{8}|\d\d\.\d{3}\.\d{3})(?:[- ]?[A-Z])"),
    ("passport", r"[A-Z] ?\d{8}"),
    ("licence", r"[A-Z]{1,2}\d{3}-?\d{4}-?\d\d|[A-Z]{1,2}\d{3}-?\d{6}"),
)
# ---- fixed values: words that make a phrase a street with house number -----------------------
_EN_KIND = r"(?:Street|Road|Lane|Avenue|Boulevard|Drive|Court|Terrace|Close|Crescent|Row|Way|Place|Square|Mews|Pl\.?|(?:Blvd|Ave|St|Rd|Ln|Dr|Ct)(?:\.(?=,| (?-i:[a-z])))?)"
_DE_KIND = r"(?:stra(?:ß|ss)e|str\.|gasse|weg|allee|platz|ufer|damm|ring|markt|kamp|graben|steig)"
_FR_KIND = r"(?:rue|quai|avenue|boulevard|chemin|impasse|all[ée]e|place|passage|cours|square|av\.|bd\.?|r\.)"
_ES_KIND = r"(?:(?:Calle|Avenida|Plaza|Paseo|Camino|Ronda|Carrera)(?!\w)|C/|Avda\.|Av\.|Pza\.|P\.º)"
_CAP = r"[A-ZÀ-Ýa-zß-ÿ][\w'’\-]*"
ADDRESSES = (
    rf"\d{{1,4}}(?: ?(?:bis|ter|quater))?,? {_FR_KIND} ?(?:(?:de la |de l['’]|du |des |de |d['’]|le |la |les |l['’]|aux |au |à la ))?(?:(?:vieux|vieil|vieille|petite?s?|grande?s?|haute?s?|basse?s?|belle|sainte?) )?(?-i:[A-ZÀ-Ý])?{_CAP}(?: (?-i:[A-ZÀ-Ý])[\w'’\-]*){{0,3}}"
    r"(?:,? (?:appt\.?|appartement|app\.|bât\.?|bâtiment|esc\.?|étage) ?[\dA-Z]+(?!\w)|,? \d+(?:er|e|ème) étage)?",
    rf"(?:[^\W\d_]+{_DE_KIND}|(?:(?-i:Am|An der|Zum|Zur|Auf dem|Unter den)|Hinterm) (?:{_CAP} )?{_CAP}) \d{{1,4}}(?: ?[a-h](?!\w))?(?: ?/ ?\d{{1,3}}(?!\d))?"
    r"(?:,? (?:Hinterhaus|\d\. ?(?:OG|Stock|Etage)|EG|Whg\.? ?\d+|Wohnung \d+)(?!\w))?",
    rf"{_ES_KIND} ?(?:(?:de la|de las|de los|del|de el|de) )?{_CAP}(?: (?:de la |de los |del |de )?{_CAP}){{0,2}},? ?(?:n\.?º ?|núm\. ?|nº ?)?\d{{1,4}}(?!\d|\.?[ºª])"
    r"(?:,? (?:\d{1,2}\.?[ºª] ?(?:izq\.|dcha\.|izquierda|derecha|ctro\.|[A-H](?!\w))?|bajo(?!\w)|ático|entlo\.|pral\.|esc\. ?\w+|piso \d+|puerta \w+))?",
    rf"\d{{1,5}}(?:[ -]?(?-i:[A-Z])(?![\w'’])|-?[a-z](?![\w'’]))? (?:(?:St|Ste|N|S|E|W|Mt|Ft)\. |{_CAP} |\d+(?:st|nd|rd|th) ){{1,4}}?{_EN_KIND}(?![\w'’])"
    r"(?:,? (?:Unit|Apt\.?|Apartment|Suite|Ste\.?|Flat|Floor|Fl\.?|No\.?) ?#?\d+[A-Z]?(?!\w)|,? ?#\d+[A-Z]?(?!\w))?",
)
_AT = r"(?: ?@ ?| ?[(\[{] ?(?:at|arroba) ?[)\]}] ?| (?-i:AT) )"
_DOT = r"(?: ?[(\[{] ?(?:dot|punkt|point|punto) ?[)\]}] ?| (?-i:DOT) )"
_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?"
EMAIL = rf"[A-Za-z0-9](?:[A-Za-z0-9._%+\-]*[A-Za-z0-9_])?{_AT}{_LABEL}(?:(?:\.|{_DOT}){_LABEL})*?(?:\.|{_DOT})[A-Za-z]{{2,}}"
# ---- end of fixed values ---------------------------------------------------------------------

_NUMBER = re.compile(
    "|".join([f"(?P<doc_{n}>{_L}(?:{p}){_R})" for n, p in DOCUMENTS] + [f"(?P<phone>{_L}(?:{'|'.join(PHONES)}){_R})"] + [rf"(?P<addr_{n}>(?<![\w,/\-#])(?<!\d\.){p})" for n, p in (("fr", ADDRESSES[0]), ("en", ADDRESSES[3]))]),
    re.IGNORECASE,
)
_STREET = re.compile("|".join(rf"(?P<addr_{n}>(?<![\w,/\-#])(?<!\d\.){p})" for n, p in (("de", ADDRESSES[1]), ("es", ADDRESSES[2]))), re.IGNORECASE)
_MAIL = re.compile(rf"(?<![\w.%+\-@]){EMAIL}(?![\w\-])(?!\.[A-Za-z]{{2,}})", re.IGNORECASE)
_URL = re.compile(r"(?:https?://|www\.)[^\s<>\"]+", re.IGNORECASE)
_CODE = re.compile(r"[A-Za-z]+[\w\-]*\d[\w\-]*|\d[\d.,:/\-]*\d|\d")
_RUN = re.compile(r"[^\W\d_]+|\d\w*|\n|[^\S\n]+|[^\s\w]|_")
_LOCAL = re.compile(r"[A-Za-z0-9._%+\-]+\Z")
# ---- fixed values: what a German or Spanish street begins or ends with ------------------------
_DE_END = ("straße", "strasse", "str", "gasse", "weg", "allee", "platz", "ufer", "damm", "ring", "markt", "kamp", "graben", "steig")
_DE_BEGIN = frozenset(("am", "an", "zum", "zur", "auf", "unter", "hinterm"))
_ES_BEGIN = frozenset(("calle", "avenida", "plaza", "paseo", "camino", "ronda", "carrera", "c", "avda", "av", "pza", "p"))
# ---- end of fixed values ---------------------------------------------------------------------

TYPES = {"email": "EMAIL", "phone": "PHONE", "doc": "ID_NUMBER", "addr": "ADDRESS", "word": "NAME"}


_SEPARATES, _GLUED = _BLANKS + ".-/", "0123456789-_"


class Token(NamedTuple):
    start: int
    end: int
    kind: str
    text: str


def _mail(text: str, at: int, done: int) -> re.Match | None:
    """The mail address around an at sign (or its disguise) that begins at ``at``."""
    stop = at
    while stop > done and text[stop - 1] in " ([{":
        stop -= 1
    low = stop
    while low > done and (text[low - 1].isalnum() or text[low - 1] in "._%+-"):
        low -= 1
    local = _LOCAL.search(text, low, stop)
    begin = local.start() if local else stop
    while begin < stop and not (text[begin].isascii() and text[begin].isalnum()):
        begin += 1
    found = _MAIL.match(text, begin) if begin < stop else None
    return found if found and found.end() > at else None


# What a run of characters is: its kind as a token, and from _STREET_WORD on also what it may begin.
_BLANK, _WORD, _MARK, _LINE, _STREET_WORD, _MAIL_WORD, _URL_WORD, _SHORT, _DIGITS, _AT_SIGN, _OPENS, _JOINS = range(12)
_KINDS = ("", "word", "mark", "line", "word", "word", "word", "word", "number", "mark", "mark", "mark")
_WORDS = frozenset((_WORD, _STREET_WORD, _MAIL_WORD, _URL_WORD, _SHORT))
_SEEN: dict[str, int] = {}


def _role(run: str) -> int:
    """What a run is; cached, since texts repeat most of them."""
    head = run[0]
    if head.isalpha():
        low = run.lower()
        if low in ("at", "arroba"):
            got = _MAIL_WORD
        elif low in ("http", "https", "www"):
            got = _URL_WORD
        elif low in _ES_BEGIN or low in _DE_BEGIN or low.endswith(_DE_END):
            got = _STREET_WORD
        else:
            got = _SHORT if len(run) <= 2 else _WORD
    elif head.isdigit() and head.isdecimal():
        got = _DIGITS
    elif head == "\n":
        got = _LINE
    elif head.isspace():
        got = _BLANK
    else:
        got = _AT_SIGN if head == "@" else _OPENS if head in "+(" else _JOINS if head in "-_" else _WORD if head.isalnum() else _MARK
    if len(_SEEN) > 300_000:
        _SEEN.clear()
    _SEEN[run] = got
    return got


def _word_shape(text: str, start: int, end: int, role: int) -> re.Match | None:
    """The shape that begins with a word."""
    found = None
    if role == _STREET_WORD:
        found = _STREET.match(text, start)
    elif role == _MAIL_WORD:
        found = _mail(text, start, 0) if start and text[start - 1] in " ([{" else None
    elif role == _URL_WORD:
        found = _URL.match(text, start)
    if found is None and end - start <= 2 and end < len(text) and (text[end].isdigit() or (text[end] in _SEPARATES and text[end + 1 : end + 2].isdigit())):
        found = _NUMBER.match(text, start)
    if found is None and end < len(text) and text[end] in _GLUED and not (start and (text[start - 1].isalnum() or text[start - 1] == "_")):
        found = _CODE.match(text, start)
    return found


def _kind(found: re.Match) -> str:
    return found.lastgroup or ("url" if found.re is _URL else "code" if found.re is _CODE else "email")


def _shapes(text: str, runs: list[str], starts: list[int], roles: list[int]) -> list[tuple[int, int, str]]:
    """(begin, end, kind) of all shapes, in order; tried only where a run can begin one."""
    out: list[tuple[int, int, str]] = []
    done = 0
    for j, role in enumerate(roles):
        if role < _STREET_WORD:
            continue
        start, found, kind = starts[j], None, None
        if j and (role == _DIGITS or role == _JOINS) and roles[j - 1] == _WORD and starts[j - 1] >= done:
            # A word with something glued to it begins before this run.
            found = _word_shape(text, starts[j - 1], start, _WORD)
        if found is None:
            if start < done:
                continue
            if role == _DIGITS:
                found = _NUMBER.match(text, start)
                if found is None:
                    found, kind = _CODE.match(text, start), "number"
                    if found is None:
                        continue
            elif role == _AT_SIGN:
                found = _mail(text, start, 0)
            elif role == _OPENS:
                found = _NUMBER.match(text, start)
            elif role != _JOINS:
                found = _word_shape(text, start, start + len(runs[j]), role)
        if found is not None:
            begin, end = found.span()
            while out and out[-1][0] >= begin:  # the local part of an address may hold several runs
                out.pop()
            if out and out[-1][1] > begin:  # it begins inside another shape, which ends there
                out[-1] = (out[-1][0], begin, out[-1][2])
            out.append((begin, end, kind or _kind(found)))
            done = end
    return out


def lex_rows(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, text) of all tokens in order; a shape is one token, and no token overlaps another."""
    runs = _RUN.findall(text)
    starts = list(accumulate(map(len, runs), initial=0))[:-1]
    get = _SEEN.get
    roles = [get(r) for r in runs]
    if None in roles:
        roles = [_role(r) if x is None else x for r, x in zip(runs, roles, strict=True)]
    out: list[tuple[int, int, str, str]] = []
    at = 0

    def plain(low: int, high: int) -> None:
        out.extend([(s, s + len(r), _KINDS[x], r) for s, r, x in zip(starts[low:high], runs[low:high], roles[low:high], strict=True) if x])

    for begin, end, kind in _shapes(text, runs, starts, roles):
        first = bisect_left(starts, begin, at)
        plain(at, first)
        if out and out[-1][1] > begin:
            s, _, k, _ = out.pop()
            out.append((s, begin, k, text[s:begin]))
        out.append((begin, end, kind, text[begin:end]))
        at = bisect_left(starts, end, first)
    plain(at, len(runs))
    return out


def lex(text: str) -> list[Token]:
    return [Token(*t) for t in lex_rows(text)]
