"""Personal data with offset-preserving deobfuscation.

Base detection runs on the text as it is. Then transducers rewrite disguises into plain text, each keeping for every
output character the source characters it stands for:

* homoglyphs: full-width forms and letters of other alphabets that look like ASCII become ASCII; invisible
  characters vanish; character references and escapes of @ and . become these;
* spelled digits: five or more number words in a row ("plus four one double five ...", in four languages, figures
  between them allowed) become digits;
* at/dot: marks in brackets ("[at]", "(dot)", "{@}"), as words between spaces, or plain, in any mixture, become @ and . where a name,
  one at mark and a domain stand around them (an at mark without brackets needs a disguised dot behind it: "meet at
  example.com" is no address), and between four numbers.

The same detectors run on the rewritten text and each hit is mapped back to the source characters it covers. Hits that overlap
a base span of their kind are the same find and are not repeated; base spans always stay.

Offsets are code points of the source, end exclusive. Null counts as empty; empty texts have no spans. Repeated rows are
scanned each. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, text_or_empty

KINDS = ("email", "ip", "card", "phone")

#: The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# As IP finds them, in linear time: a match ends with a run of digits, so none starts inside one.
_IP = re.compile(r"(?<![0-9])" + IP.pattern)
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """As EMAIL finds them, but looking only around each @: a scan of plain words would try every start in each word."""
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and (c := text[start - 1]).isascii() and (c.isalnum() or c in "._%+-"):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield "email", start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def detect(text: str) -> list[Span]:
    """Base spans by kind as in KINDS, then by start."""
    found = list(_emails(text)) if "@" in text else []
    if not _DIGIT.search(text):
        return found
    if "." in text:
        found += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    return found


# --- disguises -----------------------------------------------------------------------------------

#: Letters that look like ASCII ones, and invisible characters.
LOOKALIKES = dict(zip("аеорсухіѕјԁһкмтвнАЕОРСУХІЅЈКМТВНΑΒΕΖΗΙΚΜΝΟΡΤΥΧοаνρ", "aeopcyxisjdhkmtbhAEOPCYXISJKMTBHABEZHIKMNOPTYXoavp", strict=True))
INVISIBLE = "­​‌‍⁠﻿"
GLYPHS = {ord(k): v for k, v in LOOKALIKES.items()} | {0xFF01 + i: chr(0x21 + i) for i in range(94)} | {0x3000: " "} | {ord(c): "" for c in INVISIBLE}
_ODD = re.compile("[" + "".join(re.escape(chr(c)) for c in GLYPHS) + "]")

_REFERENCE = re.compile(r"&#(?:0*64|x0*40);|&commat;|%40|&#(?:0*46|x0*2e);|&period;", re.I)

#: Number words of English, Spanish, French and German.
NUMBER_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "ten": "10", "eleven": "11", "twelve": "12", "thirteen": "13", "fourteen": "14", "fifteen": "15", "sixteen": "16", "seventeen": "17", "eighteen": "18", "nineteen": "19",
}
#: Tens, repetitions, signs, and the words for the marks.
TENS = {"twenty": "2", "thirty": "3", "forty": "4", "fifty": "5", "sixty": "6", "seventy": "7", "eighty": "8", "ninety": "9"}
TIMES = {"double": 2, "doble": 2, "triple": 3, "treble": 3}
AT_WORDS, DOT_WORDS = "at|arroba|arobase|klammeraffe", "dot|punto|point|punkt"

_COUNTED = {*NUMBER_WORDS, *TENS}
_NUMBERS = "|".join(sorted([*NUMBER_WORDS, *TENS], key=len, reverse=True))
_TOKEN = rf"(?:(?:{'|'.join(TIMES)})[\x20-])?(?:{_NUMBERS})(?![^\W\d_])"
_SPELLED = re.compile(rf"(?<![^\W_])(?:plus[\x20-])?{_TOKEN}(?:,?[\x20-](?:{_TOKEN}|[0-9]+(?![^\W_])))*", re.I)
_WORD = re.compile(r"[^\W_]+")

_BRACKETED = rf"\x20?[\[({{<]\x20?(?:({AT_WORDS}|@)|({DOT_WORDS}|\.))\x20?[\])}}>]\x20?"
_MARK = re.compile(rf"{_BRACKETED}|\x20(?:({AT_WORDS}|@)|({DOT_WORDS}|\.))\x20|(@)", re.I)
# One of these, or @, is in every text with an at mark.
_AT_SIGNS = tuple(f"{w}{gap}{end}" for w in AT_WORDS.split("|") for gap in ("", " ") for end in "])}>") + tuple(f" {w} " for w in AT_WORDS.split("|"))
_NAME, _LABEL, _LAST = re.compile(r"[A-Za-z0-9._%+-]+"), re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*"), re.compile(r"(?:.*\.)?[A-Za-z]{2,}\Z")
_DOT = rf"(?:\x20?[\[({{<]\x20?(?:{DOT_WORDS}|\.)\x20?[\])}}>]\x20?|\x20(?:{DOT_WORDS}|\.)\x20|\.)"
_NUMBERED = re.compile(rf"(?<![0-9.])[0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}}(?![0-9])", re.I)

Edit = tuple[int, int, str]


class Tape:
    """A text and, for each of its characters, the source range that it stands for."""

    def __init__(self, text: str):
        self.text, self.start, self.end = text, list(range(len(text))), list(range(1, len(text) + 1))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """edits: (start, end, new), in order, apart. Every new character stands for the edit's whole range."""
        if not edits:
            return
        text, start, end, at = [], [], [], 0
        for a, b, new in edits:
            text += [self.text[at:a], new]
            start += self.start[at:a] + [self.start[a]] * len(new)
            end += self.end[at:a] + [self.end[b - 1]] * len(new)
            at = b
        text.append(self.text[at:])
        self.text, self.start, self.end = "".join(text), start + self.start[at:], end + self.end[at:]


def plain_glyphs(text: str) -> list[Edit]:
    edits = [] if text.isascii() else [(m.start(), m.end(), GLYPHS[ord(m[0])]) for m in _ODD.finditer(text)]
    if "&" in text or "%40" in text:
        edits += [(m.start(), m.end(), "@" if m[0].lower() in ("&commat;", "%40") or re.search("64|40", m[0]) else ".") for m in _REFERENCE.finditer(text)]
        edits.sort()
    return edits


def plain_digits(text: str) -> list[Edit]:
    edits = []
    # only the first and the last word of a run can touch other marks than those removed here
    if sum(map(_COUNTED.__contains__, text.lower().replace("-", " ").replace(",", " ").split())) < 3:
        return []
    for m in _SPELLED.finditer(text):
        words = list(_WORD.finditer(text, *m.span()))
        if sum(w[0].lower() in NUMBER_WORDS or w[0].lower() in TENS for w in words) >= 5:
            edits += _figures(text, words)
    return edits


def _figures(text: str, words: list[re.Match]) -> list[Edit]:
    """Each word with the separator behind it becomes its figures; a word before its number stands with it."""
    out, start, times, sign = [], None, 1, ""
    for m, after in zip(words, [*words[1:], None], strict=True):
        word = m[0].lower()
        start = m.start() if start is None else start
        if word in TIMES or word == "plus":
            times, sign = TIMES.get(word, times), sign + "+" * (word == "plus")
            continue
        if not word.isdigit():
            unit = bool(after) and len(NUMBER_WORDS.get(after[0].lower(), "")) == 1 and after[0].lower() not in ("zero", "oh")
            figures = NUMBER_WORDS.get(word) or TENS[word] + "0" * (not unit)
            out.append((start, after.start() if after else m.end(), sign + figures * times))
        start, times, sign = None, 1, ""
    return out


def plain_marks(text: str) -> list[Edit]:
    return sorted({*_addresses(text), *_numbered(text)})


def _addresses(text: str) -> list[Edit]:
    """Marks of disguised mail addresses. Names and domains are read from each at mark outwards, up to the next mark that is no dot."""
    if "@" not in text and not any(map(text.lower().__contains__, _AT_SIGNS)):
        return []
    marks = [(m.start(), m.end(), bool(m[1] or m[3] or m[5]), "bracket" if m[1] or m[2] else "plain" if m[5] else "word") for m in _MARK.finditer(text)]
    ats = [k for k, m in enumerate(marks) if m[2]]
    by_end, by_start, out, last = {m[1]: m for m in marks if not m[2]}, {m[0]: m for m in marks if not m[2]}, [], 0
    backwards = text[::-1] if ats else ""
    for k in ats:
        start, end, _, style = marks[k]
        inside: list[tuple[int, int]] = []
        at = start
        while (m := _NAME.match(backwards, len(text) - at)) and at - len(m[0]) >= last:
            at -= len(m[0])
            if not (dot := by_end.get(at)) or dot[0] < last:
                break
            inside.append(dot[:2])
            at = dot[0]
        named = m is not None or bool(inside)
        while inside and inside[-1][0] == at:  # a dot mark needs a name on both sides
            at = inside.pop()[1]
        domain, to, dots = [], end, 0
        while m := _LABEL.match(text, to):
            domain.append(m[0])
            to = m.end()
            if not (dot := by_start.get(to)) or not _LABEL.match(text, dot[1]):
                break
            inside.append(dot[:2])
            dots, to = dots + 1, dot[1]
        joined = ".".join(domain)
        hidden = dots or inside or style == "bracket"
        if at < start and named and hidden and (dots or style != "word") and "." in joined and _LAST.match(joined):
            out += [(a, b, ".") for a, b in inside] + [(start, end, "@")]
            last = to
    return out


def _numbered(text: str) -> list[Edit]:
    out = []
    for m in _NUMBERED.finditer(text) if _DIGIT.search(text) else ():
        parts = list(re.finditer("[0-9]+", m[0]))
        for a, b in zip(parts, parts[1:], strict=False):
            if b.start() - a.end() > 1:
                out.append((m.start() + a.end(), m.start() + b.start(), "."))
    return out


def reveal(text: str, base: list[Span]) -> list[Span]:
    """Spans only found behind disguises."""
    tape = None
    for step in (plain_glyphs, plain_digits, plain_marks):
        if edits := step(tape.text if tape else text):
            tape = tape or Tape(text)
            tape.rewrite(edits)
    if not tape:
        return []
    taken = {k: sorted((a, b) for kind, a, b in base if kind == k) for k in KINDS}
    added = []
    for kind, a, b in detect(tape.text):
        start, end = tape.start[a], tape.end[b - 1]
        own = taken[kind]
        i = bisect_left(own, (end,))
        if not (i and own[i - 1][1] > start):
            added.append((kind, start, end))
    return added


def find(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), both by kind, then start."""
    base = detect(text)
    more = reveal(text, base)
    return base, sorted(base + more, key=lambda s: (KINDS.index(s[0]), s[1], s[2])) if more else base


def scan_pii(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans (arrays of kind, start, end): a row for each row of docs."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    struct = "array<struct<kind: string, start: long, end: long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = [find(t.as_py()) for t in b.column(1)]
            as_rows = lambda k: pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in x[k]] for x in both], kind)
            yield pa.RecordBatch.from_arrays([b.column(0), as_rows(0), as_rows(1)], ["doc_id", "base", "spans"])

    ship_package(docs.sparkSession)
    ready = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return ready.mapInArrow(run, f"doc_id long, base {struct}, spans {struct}")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_<kind> (base spans), base_sha256, spans, n_added: a row for each row of docs."""
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return scan_pii(docs).select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )

