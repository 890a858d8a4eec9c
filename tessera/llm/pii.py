"""Finds personal data in texts, also disguised, with offsets of the original text.

Base spans are what plain patterns find: e-mail addresses, IP addresses, card numbers that pass the Luhn check, and
phone numbers, leftmost and not overlapping per kind. Beside them a chain of transducers rewrites a text and keeps an
account of every edit: look-alike characters to ASCII, spelled digits to digits, letters used as digits, and ``at`` and
``dot`` in their disguises to signs. The patterns are run again on what comes out, and a span with an edit in it is
mapped back through the edits to the characters of the source. Such spans are added; base spans stay.

What the transducers ask for, so that ordinary prose is left alone: spelled digits count in runs of three or more
(``double`` and ``triple`` included); a bare `` at `` or `` dot `` counts only in what ends like a known top-level domain, while bracketed ones count
before any label of letters; letters stand for digits only where at least half of the characters are digits. An added
span does not touch a letter or digit on either side. A run of digits that fails as a card because several numbers
stand side by side is judged again number by number.

Defined cases: NULL is an empty text and has no spans. Offsets are code points, ends exclusive. Texts of any length are read
whole, and every pattern runs in time linear in the text. Rows are judged on their own, so repeated rows and equal ids do
not matter; extra columns pass through ``redact`` untouched.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fresh

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:int,end:int,added:boolean>>"
Span = tuple[int, int]
Edit = tuple[int, int, str]

# Base patterns

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Each place where a number of digits begins is tried once, so a long run of digits costs one pass.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> Iterator[Span]:
    """Found from the sign: the longest run of permitted characters to its left, up to the address before."""
    free = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            free = m.end()
            yield start, free


def ips(text: str) -> Iterator[Span]:
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def luhn(digits: str) -> bool:
    return sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0


def _is_card(candidate: str) -> bool:
    digits = candidate.replace(" ", "").replace("-", "")
    return 16 <= len(digits) <= 19 and luhn(digits)


def cards(text: str) -> Iterator[Span]:
    return (m.span() for m in _CARD.finditer(text) if _is_card(m[0]))


def phones(text: str) -> Iterator[Span]:
    return (m.span() for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15)


FINDERS: dict[str, Callable[[str], Iterator[Span]]] = dict(zip(KINDS, (emails, ips, cards, phones)))
_NUMBER = re.compile(r"(?<![0-9-])(?:[0-9]{16,19}|[0-9]{4}(?:([ -])[0-9]{4})(?:\1[0-9]{4}){2}(?:\1?[0-9]{1,3})?)(?![0-9-])")


def cards_side_by_side(text: str) -> Iterator[Span]:
    """Cards inside runs that fail as a whole: unbroken numbers, or groups of four."""
    for run in _CARD.finditer(text):
        if sum(map(str.isdigit, run[0])) > 19:
            yield from (m.span() for m in _NUMBER.finditer(text, *run.span()) if _is_card(m[0]))


# Transducers

# Letters of other scripts that look like ASCII ones.
_LOOKALIKES = dict(
    zip(
        "АВЕЅZІЈКМНОРСТХУаеорсухіјѕԁԛԝһΑΒΕΖΗΙΚΜΝΟΡΤΥΧαονρυιϲϳ",
        "ABESZIJKMHOPCTXYaeopcyxijsdqwhABEZHIKMNOPTYXaovpuicj",
        strict=True,
    )
)
_INVISIBLE = "\u00ad\u180e\u200b\u200c\u200d\u2060\ufeff"
_HYPHENS = "\u2010\u2011\u2012\u2013\u2014\u2015\u2212"
# Scripts with look-alikes, spaces and signs, enclosed, full-width and mathematical forms, and digits of any script.
_SUSPECT = re.compile(
    r"[\u00a0\u00ad\u00b2\u00b3\u00b9\u0370-\u03ff\u0400-\u052f\u180e\u2000-\u2015\u2024\u202f\u205f-\u209c\u2100-\u214f\u2212\u2460-\u24ff"
    r"\u3000-\u3002\ufe50-\ufe6f\ufeff\uff01-\uff61\U0001d400-\U0001d7ff\U0001f100-\U0001f16f]|(?![0-9])\d"
)


@lru_cache(maxsize=None)
def plain(character: str) -> str:
    """The ASCII character that one looks like, nothing for an invisible one, else itself."""
    if character in _INVISIBLE:
        return ""
    if character in _HYPHENS:
        return "-"
    if character in _LOOKALIKES:
        return _LOOKALIKES[character]
    digit = unicodedata.decimal(character, None)
    if digit is not None:
        return str(digit)
    folded = unicodedata.normalize("NFKC", character).replace("\u3002", ".").strip("()") or character
    return folded if len(folded) == 1 and folded.isascii() else character


def lookalikes(text: str) -> Iterator[Edit]:
    for m in _SUSPECT.finditer(text):
        if (new := plain(m[0])) != m[0]:
            yield (*m.span(), new)


# The digits in four languages.
_DIGITS = (
    ("zero", "oh", "null", "cero", "zéro"), ("one", "eins", "uno", "un"), ("two", "zwei", "zwo", "dos", "deux"),
    ("three", "drei", "tres", "trois"), ("four", "vier", "cuatro", "quatre"), ("five", "fünf", "fuenf", "cinco", "cinq"),
    ("six", "sechs", "seis"), ("seven", "sieben", "siete", "sept"), ("eight", "acht", "ocho", "huit"), ("nine", "neun", "nueve", "neuf"),
)
_SPELLED = {word: str(value) for value, words in enumerate(_DIGITS) for word in words}
_TIMES = {"double": 2, "triple": 3}
_DIGIT_WORD = rf"(?:(?:{'|'.join(_TIMES)})[ -])?(?:{'|'.join(sorted(_SPELLED, key=len, reverse=True))})(?![^\W_])"
_DOT_WORDS = "dot|punkt|punto|point"
_SPELLED_RUN = re.compile(
    rf"(?i)(?<![^\W_])(?:plus[ -])?{_DIGIT_WORD}(?:(?:[ ,-]|, )(?:{_DIGIT_WORD}|(?:{_DOT_WORDS}|dash|hyphen)(?![^\W_])|[0-9]++))*+"
)
_SPELLED_PART = re.compile(rf"(?i)[ ,-]*(?:(plus)|({_DOT_WORDS})|(dash|hyphen)|([0-9]+)|(?:(double|triple)[ -])?([^\W\d_]+))")
_LEAST_SPELLED = 3


def spelled_digits(text: str) -> Iterator[Edit]:
    """Runs of spelled digits, with the dots, hyphens and numbers between them, as one number each."""
    for run in _SPELLED_RUN.finditer(text):
        new, spelled, last = [], 0, 0
        end = run.start()
        for part in _SPELLED_PART.finditer(text, *run.span()):
            plus, dot, hyphen, number, times, word = part.groups()
            if word:
                new.append(_SPELLED[word.lower()] * _TIMES.get((times or "").lower(), 1))
                spelled += 1
            else:
                new.append("+" if plus else "." if dot else "-" if hyphen else number)
            if word or number:
                last, end = len(new), part.end()
        if spelled >= _LEAST_SPELLED:
            yield run.start(), end, "".join(new[:last])


_MIXED = re.compile(r"(?<![^\W_])[0-9OoIl]++(?![^\W_])")
_AS_DIGITS = str.maketrans("OoIl", "0011")


def letters_as_digits(text: str) -> Iterator[Edit]:
    for m in _MIXED.finditer(text):
        if not m[0].isdigit() and 2 * sum(map(str.isdigit, m[0])) >= len(m[0]):
            for k, c in enumerate(m[0], m.start()):
                if not c.isdigit():
                    yield k, k + 1, c.translate(_AS_DIGITS)


_ENTITY_DOT, _ENTITY_AT = r"&period;|&#46;|&#x2e;|%2e", r"&commat;|&#64;|&#x40;|%40"
_BLANK = r"[ \t]{0,3}"
_MARKED_DOT = rf"{_BLANK}(?:[\[({{<]{_BLANK}(?:{_DOT_WORDS}|\.){_BLANK}[\])}}>]|_(?:{_DOT_WORDS})_|{_ENTITY_DOT}){_BLANK}"
_BARE_DOT = rf"[ \t]{{1,3}}(?:(?:{_DOT_WORDS})|\.)[ \t]{{1,3}}"
_MARKED_AT = rf"{_BLANK}(?:[\[({{<]{_BLANK}(?:at|@|arroba|arobase|chez|klammeraffe|ät){_BLANK}[\])}}>]|_at_|{_ENTITY_AT}|@){_BLANK}"
_BARE_AT = r"[ \t]{1,3}(?:at|arroba|arobase)[ \t]{1,3}"
_SIGN = re.compile(rf"(?i)({_MARKED_AT})|{_BARE_AT}")
_TO_THE_RIGHT = re.compile(rf"(?i)[A-Za-z0-9-]++(?:(?:{_MARKED_DOT}|{_BARE_DOT}|\.)[A-Za-z0-9-]++)+")
_ANY_DOT = re.compile(rf"(?i)({_MARKED_DOT})|({_BARE_DOT})|(\.)")
_DOT_TO_THE_LEFT = re.compile(rf"(?i)(?:{_MARKED_DOT}|{_BARE_DOT})$")
_LONGEST_DOT = 24
# Top-level domains that a bare word may lead to.
_TOP_LEVEL = frozenset("com org net edu gov mil int info biz name io ai co app dev me tv us uk de at ch fr be nl es it pt pl se no dk fi cz eu ru cn jp in br mx ar au ca example test".split())
_ARTICLE = re.compile(r"(?i)(?:the|a|an|this|that|each|la|le|el|un|une)[^A-Za-z0-9-]")
_IP_DOTS = re.compile(rf"(?i)(?<=[0-9])(?:{_MARKED_DOT}|{_BARE_DOT})(?=[0-9])")


def _domain(text: str, start: int, bare_at: bool) -> list[Edit] | None:
    """The disguised dots of the domain that begins here; None if it is none."""
    m = _TO_THE_RIGHT.match(text, start)
    if not m or _ARTICLE.match(text, start):
        return None
    dots = list(_ANY_DOT.finditer(text, *m.span()))
    end = m.end()
    # Labels behind a dot that leads nowhere are dropped from the end.
    for k in range(len(dots) - 1, -1, -1):
        label = text[dots[k].end() : end]
        disguised = [d for d in dots[: k + 1] if not d[3]]
        if disguised or not bare_at:
            strict = bare_at or dots[k][2]
            if label.lower() in _TOP_LEVEL if strict else label.isalpha() and len(label) > 1:
                return [(*d.span(), ".") for d in disguised]
        end = dots[k].start()
    return None


def at_and_dot(text: str) -> Iterator[Edit]:
    """Signs and dots of disguised e-mail addresses, and dots between the numbers of IP addresses."""
    edits = {(m.start(), m.end(), ".") for m in _IP_DOTS.finditer(text)}
    for sign in _SIGN.finditer(text):
        if sign.start() == 0 or text[sign.start() - 1] not in _LOCAL:
            continue
        dots = _domain(text, sign.end(), not sign[1])
        if dots is None:
            continue
        if sign[0] != "@":
            edits.add((*sign.span(), "@"))
        edits.update(dots)
        # Disguised dots in the part before the sign.
        start = sign.start()
        while True:
            while start > 0 and text[start - 1] in _LOCAL:
                start -= 1
            before = _DOT_TO_THE_LEFT.search(text, max(0, start - _LONGEST_DOT), start)
            if not before or (before[0].strip(" \t") == ".") or before.start() == 0 or text[before.start() - 1] not in _LOCAL:
                break
            edits.add((*before.span(), "."))
            start = before.start()
    reached = 0
    for start, end, new in sorted(edits):
        if start >= reached:
            reached = end
            yield start, end, new


# What the text in lower case must hold for a transducer to have any work, in forms that are quick to look for.
_HINTS = (
    (_SUSPECT, lookalikes),
    (re.compile(rf"(?<![^\W_])(?=[a-z]){_DIGIT_WORD}(?:[ ,-]|, )(?:{_DIGIT_WORD}|{_DOT_WORDS}|dash|hyphen|[0-9])"), spelled_digits),
    (re.compile(r"[0-9][oil]|[oil][0-9]"), letters_as_digits),
    (
        re.compile(
            rf"[\[({{<_ \t](?:(?:{_DOT_WORDS})[\])}}>_ \t]|[@.][\])}} \t])|@[ \t]|{_ENTITY_DOT}|{_ENTITY_AT}"
            r"|[\[({<_][ \t]*(?:at|arroba|arobase|chez|klammeraffe|ät)[ \t]*[\])}>_]"
        ),
        at_and_dot,
    ),
)


class Tape:
    """What a transducer has written, with the way back to what it has read."""

    def __init__(self, text: str, edits: list[Edit]):
        pieces, self.starts, self.edits, at, length = [], [], [], 0, 0
        for start, end, new in edits:
            length += start - at
            pieces += [text[at:start], new]
            self.starts.append(length)
            self.edits.append((length + len(new), start, end))
            length, at = length + len(new), end
        self.text = "".join([*pieces, text[at:]])

    def back(self, start: int, end: int) -> tuple[int, int, bool]:
        """The span of the text that was read, and whether it holds an edit."""
        first, last = self._edit(start), self._edit(end - 1)
        edited = first != last or (first >= 0 and start < self.edits[first][0])
        return self._source(start, first, 0), self._source(end - 1, last, 1), edited

    def _edit(self, at: int) -> int:
        return bisect_right(self.starts, at) - 1

    def _source(self, at: int, edit: int, side: int) -> int:
        if edit < 0:
            return at + side
        upto, start, end = self.edits[edit]
        return (start, end)[side] if at < upto else end + at - upto + side


def disguised(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end of what is found after the transducers only."""
    tapes: list[Tape] = []
    current = text
    for hint, transducer in _HINTS:
        if hint.search(current if hint is _SUSPECT else current.lower()) and (edits := list(transducer(current))):
            tapes.append(Tape(current, edits))
            current = tapes[-1].text
    found = []
    for kind, finder in FINDERS.items() if tapes else ():
        spans = list(finder(current))
        if kind == "card":
            spans += cards_side_by_side(current)
        for start, end in spans:
            if kind == "email":
                while start < end and not current[start].isalnum():
                    start += 1
                if current[start] == "@" or not current[end - 1].isalnum():
                    continue
            if (start and current[start - 1].isalnum()) or current[end : end + 1].isalnum():
                continue
            edited = False
            for tape in reversed(tapes):
                start, end, here = tape.back(start, end)
                edited |= here
            if edited:
                found.append((kind, start, end))
    return found + [("card", *span) for span in cards_side_by_side(text)]


def spans(text: str | None) -> list[tuple[str, int, int, bool]]:
    """Kind, start, end and whether the transducers added it, by kind and start."""
    text = text or ""
    base = {kind: list(finder(text)) for kind, finder in FINDERS.items()}
    found = {(KINDS.index(kind), *span, False) for kind, all_ in base.items() for span in all_}
    for kind, start, end in disguised(text):
        if not any(s <= start and end <= e for s, e in base[kind]):
            found.add((KINDS.index(kind), start, end, True))
    return [(KINDS[kind], start, end, added) for kind, start, end, added in sorted(found)]


def _find(texts: pd.Series) -> pd.Series:
    return pd.Series([[dict(zip(("kind", "start", "end", "added"), s)) for s in spans(t)] for t in texts], dtype=object)


def find(text: Column) -> Column:
    """The spans of a text column, by kind in the order of ``KINDS``, then start."""
    return F.pandas_udf(_find, SPANS)(text)


def _redact(texts: pd.Series, found: pd.Series) -> pd.Series:
    result = []
    for text, all_ in zip(texts, found):
        if text is not None and all_ is not None and len(all_):
            pieces, at, reached = [], 0, 0
            for s in sorted(all_, key=lambda s: (s["start"], -s["end"])):
                if s["start"] >= reached:
                    pieces += [text[at : s["start"]], f"<{s['kind'].upper()}>"]
                reached = max(reached, s["end"])
                at = reached
            text = "".join([*pieces, text[at:]])
        result.append(text)
    return pd.Series(result, dtype=object)


def redact(docs: DataFrame, text: str = "text", found: str = "pii") -> DataFrame:
    """``docs`` with every span replaced by its kind, overlapping ones by the first, and the spans as ``found``."""
    held = fresh(found, docs)
    judged = docs.withColumn(held, find(F.col(text)))
    return judged.withColumn(text, F.pandas_udf(_redact, "string")(F.col(text), F.col(held)))
