"""Personal data, plain and disguised, with spans in the source text.

Plain identifiers (kinds in the order email, ip, card, phone) are the leftmost
non-overlapping matches of the kind's pattern; matches that fail its check (ip
parts at most 255; 12-19 card digits passing Luhn; 9-15 phone digits) are dropped
without a retry. All scans are linear in the text.

For disguised ones a chain of transducers rewrites the text, and carries for each output
character the source characters it stands for:

* look-alike letters of other scripts, full-width and mathematical forms and
  digits of any script become ASCII; invisible characters go;
* runs of at least ``MIN_SPELLED`` spelled digits (English, German, French,
  Spanish) become digits, "plus" before them a plus sign;
* four octets of spelled digits or numbers between spelled dots become an address;
* ``[at]``, ``(dot)`` and the like become ``@`` and ``.``, plain " at " and
  " dot " only in the form "name dot name at host dot domain", between numbers, or as "name at host.domain" if
  the host is a known mail provider or the name holds a digit, dot or the like.

The same patterns run over the result. A match that holds at least one rewritten
character is mapped back to its source span and added, unless a plain span of its kind
covers it. A wider one is added beside the plain span that it holds.

Defined cases: null and empty texts have no spans; repeated rows are each
reported; ties at one start are in kind order; an empty table gives no rows;
extra columns are ignored (``redact`` keeps them).
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame

from windshear.llm.common import map_rows, sliced

KINDS = ("email", "ip", "card", "phone")
MIN_SPELLED = 3

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters of other scripts that look like ASCII ones.
_LOOKS = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y",
    "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "ӏ": "l", "З": "3", "з": "3", "б": "6",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ɑ": "a", "ɡ": "g", "ı": "i", "․": ".", "。": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-",
}
# Characters without width.
_INVISIBLE = "­​‌‍⁠﻿"
# Spelled digits.
_SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_DIGIT = "(?:" + "|".join(sorted(_SPELLED, key=len, reverse=True)) + ")"
_GAP = r"(?:\s++[,.-]?\s*+|[,.-]\s*+)"
_RUN = re.compile(rf"(?<!\w)(?:(plus)(?:\s++-?\s*+|-\s*+))?({_DIGIT}(?:{_GAP}(?:{_DIGIT}(?!\w)|[0-9]{{1,4}}(?!\w))){{{MIN_SPELLED - 1},}})(?!\w)", re.I)
_RUN_PART = re.compile(rf"({_DIGIT})(?!\w)|([0-9])", re.I)
# Four octets of spelled digits or numbers, with spelled dots.
_OCTET = rf"(?:{_DIGIT}(?:[\s-]++{_DIGIT}){{0,2}}+|[0-9]{{1,3}}+)"
_OCTETS = re.compile(rf"(?<!\w){_OCTET}(?:\s++(?:dot|punkt|punto|point)\s++{_OCTET}){{3}}(?!\w)", re.I)
_OCTET_PART = re.compile(rf"({_DIGIT})(?!\w)|([0-9])|(\s++(?:dot|punkt|punto|point)\s++)", re.I)
_AT = re.compile(r"[\[({<]\s*+(?:at|@|arroba)\s*+[\])}>]", re.I)
_DOT = re.compile(r"[\[({<]\s*+(?:dot|\.|punkt|punto|point)\s*+[\])}>]", re.I)
# "name at host": the sign or the word after a name; the host, with real or spelled dots; a last label of letters.
_ANCHOR = re.compile(r"(?<=[A-Za-z0-9._%+-])(?:\s++at\s++|@)(?=[A-Za-z0-9-])", re.I)
_HOST = re.compile(r"[A-Za-z0-9-]++(?:(?:\s++dot\s++|\.)[A-Za-z0-9-]++)++", re.I)
_TOP = re.compile(r"[.\s][A-Za-z]{2,24}\Z")
# First labels of hosts that give mail addresses. "meet at example.com" is no address, "john at gmail.com" is.
_MAIL = frozenset("aol fastmail gmail gmx googlemail hotmail icloud live mail mailbox msn outlook posteo proton protonmail qq web yahoo yandex".split())
_ODD_NAME = re.compile(r"[A-Za-z0-9][._%+-][A-Za-z0-9]|[0-9]")
_PLAIN_DOT = re.compile(r"(?<!\s)\s++dot\s++", re.I)
_NUMBER_DOT = re.compile(r"(?<=[0-9])\s++dot\s++(?=[0-9])", re.I)
_ODD = re.compile("[" + "".join(_LOOKS) + _INVISIBLE + "！-～\U0001d400-\U0001d7ff"
                  "٠-٩۰-۹०-९①-⑳²³¹⁰-⁹₀-₉]")
_HINT = re.compile(r"(?:[\[({<]\s*+(?:at|@|arroba|dot|\.|punkt|punto|point)\s*+[\])}>])|\s(?:dot|punkt|punto|point)\s|\sat\s++[A-Za-z0-9-]++\.[A-Za-z0-9]", re.I)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the plain identifiers, sorted."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    if "." in text:
        out.extend((m.start(), 1, m.end()) for m in _IP.finditer(text)
                   if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = _digits(m.group())
            if 12 <= len(d) <= 19 and _luhn(d):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        out.extend((m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15)
    out.sort()
    return out


class Aligned:
    """A text whose character ``i`` stands for source characters ``lo[i]:hi[i]``."""

    def __init__(self, text: str):
        self.text, self.lo, self.hi = text, list(range(len(text))), list(range(1, len(text) + 1))
        self.new = [False] * len(text)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace ``text[a:b]`` by a string for ascending, disjoint ``(a, b, string)``."""
        text, lo, hi, new, at = [], [], [], [], 0
        for a, b, s in edits:
            text.append(self.text[at:a])
            lo += self.lo[at:a]
            hi += self.hi[at:a]
            new += self.new[at:a]
            text.append(s)
            lo += [self.lo[a]] * len(s)
            hi += [self.hi[b - 1]] * len(s)
            new += [True] * len(s)
            at = b
        self.text = "".join(text) + self.text[at:]
        self.lo, self.hi, self.new = lo + self.lo[at:], hi + self.hi[at:], new + self.new[at:]


def _ascii(c: str) -> str:
    if c in _INVISIBLE:
        return ""
    if c in _LOOKS:
        return _LOOKS[c]
    s = unicodedata.normalize("NFKC", c)
    if len(s) == 1 and s.isdigit():
        return str(unicodedata.digit(s))
    return s if s.isascii() else c


def _spelled(m: re.Match) -> list[tuple[int, int, str]]:
    """Each digit keeps its own word; the separators between go."""
    out = [(m.start(1), m.start(2), "+")] if m.group(1) else []
    at = m.start(2)
    for part in _RUN_PART.finditer(m.string, m.start(2), m.end(2)):
        if part.start() > at:
            out.append((at, part.start(), ""))
        if part.group(1):
            out.append((part.start(), part.end(), _SPELLED[part.group(1).lower()]))
        at = part.end()
    return out


def _octets(m: re.Match) -> list[tuple[int, int, str]]:
    """Spelled octets as digits and dots."""
    out, at = [], m.start()
    for part in _OCTET_PART.finditer(m.string, m.start(), m.end()):
        if part.start() > at:
            out.append((at, part.start(), ""))
        if part.group(1):
            out.append((part.start(), part.end(), _SPELLED[part.group(1).lower()]))
        elif part.group(3):
            out.append((part.start(), part.end(), "."))
        at = part.end()
    return out


def _widened(text: str, found, new: str) -> list[tuple[int, int, str]]:
    """Edits of bracketed words, with the white space around them."""
    out, last = [], 0
    for m in found:
        a, b = m.span()
        while a > last and text[a - 1].isspace():
            a -= 1
        while b < len(text) and text[b].isspace():
            b += 1
        out.append((a, b, new))
        last = b
    return out


def _spoken(text: str) -> list[tuple[int, int, str]]:
    """Edits of "name dot name at host dot domain": from each sign or word "at" the host is read to the right,
    the name to the left, at most to the previous host."""
    out, last = [], 0
    for m in _ANCHOR.finditer(text):
        host = _HOST.match(text, m.end()) if m.start() >= last else None
        if host is None or (m.group() != "@" and not _TOP.search(host.group())):
            continue
        edits = [(d.start(), d.end(), ".") for d in _PLAIN_DOT.finditer(text, m.end(), host.end())]
        if m.group() != "@":
            edits.insert(0, (m.start(), m.end(), "@"))
        at = m.start()
        while True:
            while at > last and text[at - 1] in _LOCAL:
                at -= 1
            gap = at
            while gap > last and text[gap - 1].isspace():
                gap -= 1
            word = gap - 3
            if gap == at or word <= last or text[word:gap].lower() != "dot" or not text[word - 1].isspace():
                break
            a = word
            while a > last and text[a - 1].isspace():
                a -= 1
            if a == last or text[a - 1] not in _LOCAL:
                break
            edits.insert(0, (a, at, "."))
            at = a
        if m.group() != "@" and " dot " not in " ".join(text[at:host.end()].lower().split()):
            if host.group().split(".")[0].lower() not in _MAIL and not _ODD_NAME.search(text[at:m.start()]):
                continue
        out += edits
        last = host.end()
    return out


def normalised(text: str) -> Aligned | None:
    """The text after all transducers; None if none of them changes it."""
    odd, run, hint = _ODD.search(text), _RUN.search(text), _HINT.search(text)
    if not (odd or run or hint):
        return None
    a = Aligned(text)
    if odd:
        a.rewrite([(m.start(), m.end(), _ascii(m.group())) for m in _ODD.finditer(a.text) if _ascii(m.group()) != m.group()])
    if hint or odd:
        a.rewrite([e for m in _OCTETS.finditer(a.text) for e in _octets(m)])
    if run or odd or hint:
        a.rewrite([e for m in _RUN.finditer(a.text) for e in _spelled(m)])
    for pattern, new in ((_AT, "@"), (_DOT, ".")):
        a.rewrite(_widened(a.text, pattern.finditer(a.text), new))
    a.rewrite(_spoken(a.text))
    a.rewrite([(m.start(), m.end(), ".") for m in _NUMBER_DOT.finditer(a.text)])
    return a


def spans(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """``(plain, added)`` spans ``(start, kind number, end)``, each sorted."""
    if not text:
        return [], []
    base = plain_spans(text)
    a = normalised(text)
    if a is None:
        return base, []
    # Plain spans of a kind don't overlap, so the last one that begins before a span is the one that may cover it.
    own = [([], []) for _ in KINDS]
    for s, kind, e in base:
        own[kind][0].append(s)
        own[kind][1].append(e)
    added = set()
    for s, kind, e in plain_spans(a.text):
        lo, hi = a.lo[s], a.hi[e - 1]
        if any(a.new[s:e]) or hi - lo != e - s:
            starts, ends = own[kind]
            at = bisect_right(starts, lo) - 1
            if at < 0 or ends[at] < hi:
                added.add((lo, kind, hi))
    return base, sorted(added)


def _joined(found) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


FOUND = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string, n_added long")


def find(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: counts over all spans, the plain spans and all
    spans as ``kind:start:end`` in code points, and the number of added ones."""
    def run(cols):
        out = {n.split()[0]: [] for n in FOUND.split(", ")}
        out["doc_id"] = cols["doc_id"]
        for t in cols["text"]:
            base, added = spans(t)
            every = sorted(base + added)
            for k, name in enumerate(KINDS):
                out[f"n_{name}"].append(sum(x[1] == k for x in every))
            out["base"].append(_joined(base))
            out["spans"].append(_joined(every))
            out["n_added"].append(len(added))
        return out

    return map_rows(docs, run, FOUND, ["doc_id", "text"])


def redacted(text: str | None) -> str | None:
    """The text with each span, overlapping ones merged, replaced by ``[KIND]``."""
    base, added = spans(text)
    if not base and not added:
        return text
    out, at, merged = [], 0, []
    for s, k, e in sorted(base + added):
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([s, k, e])
    for s, k, e in merged:
        out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = e
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; ``n_chars``, where present,
    follows the new text of the rows that change. Other columns stay."""
    names = docs.columns

    def run(batches):
        for batch in sliced(batches):
            old = batch.column("text").to_pylist()
            new = [redacted(t) for t in old]
            cols = []
            for f in batch.schema:
                if f.name == "text":
                    cols.append(pa.array(new, f.type))
                elif f.name == "n_chars":
                    had = batch.column("n_chars").to_pylist()
                    cols.append(pa.array([h if a == b else len(b) for h, a, b in zip(had, old, new)], f.type))
                else:
                    cols.append(batch.column(f.name))
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return docs.select(*names).mapInArrow(run, docs.schema)
