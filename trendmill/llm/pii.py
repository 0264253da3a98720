"""Personal data in texts, also where it is disguised, with offsets into the source.

Base identifiers are found in the text as it is. Then a chain of transducers rewrites a copy of the
text: invisible characters go, look-alike characters become ASCII, bracketed or spelled ``at`` and
``dot`` become ``@`` and ``.``, and runs of spelled digits become digits. Each output character keeps the
range of source characters it came from, so an identifier found in the rewritten text is
reported as a span of the source. Spans count code points, the end is exclusive.

All patterns have bounded repeats or run over a text once, so a very long word or run of digits
costs time in proportion to its length.
"""

import re
import unicodedata
from dataclasses import dataclass

import numpy as np
from pyspark.sql import functions as F

from trendmill.llm.shared import id_and_text, map_texts

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
# An address lies in one run of digits and dots, and never starts within a run of digits: the run's
# first digit would have matched as well.
_DOTTED = re.compile(r"[0-9][0-9.]*")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text):
    """Matches of local@domain, each found from its at sign."""
    consumed = 0
    at = text.find("@")
    while at >= 0:
        if at >= consumed:
            start = at
            while start > consumed and not _NOT_LOCAL.match(text, start - 1):
                start -= 1
            domain = _DOMAIN.match(text, at + 1) if start < at else None
            if domain:
                consumed = domain.end()
                yield start, consumed
        at = text.find("@", at + 1)


def _addresses(text):
    for run in _DOTTED.finditer(text):
        if run[0].count(".") >= 3:
            for m in _IP.finditer(text, run.start(), run.end()):
                if _is_ip(m[0]):
                    yield m.start(), m.end()


def _luhn(digits):
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _is_ip(found):
    # Leading zeros are cut off first, as int() refuses very long runs of digits.
    parts = [part.lstrip("0") or "0" for part in found.split(".")]
    return all(len(part) <= 3 and int(part) <= 255 for part in parts)


def _is_card(found):
    digits = found.replace(" ", "").replace("-", "")
    return 13 <= len(digits) <= 19 and _luhn(digits)


def _is_phone(found):
    return 9 <= sum(c.isdigit() for c in found) <= 15


def identifiers(text):
    """``(kind number, start, end)`` of the base identifiers of ``text``, by kind and start."""
    spans = [(0, s, e) for s, e in _emails(text)] + [(1, s, e) for s, e in _addresses(text)]
    for kind, pattern, valid in ((2, _CARD, _is_card), (3, _PHONE, _is_phone)):
        spans += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if valid(m[0])]
    return spans


# Look-alikes of ASCII characters that compatibility folding does not cover.
_CYRILLIC_GREEK = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j",
    "ѕ": "s", "ԁ": "d", "һ": "h", "ӏ": "l", "ɡ": "g", "ո": "n", "ѵ": "v", "ԛ": "q", "ԝ": "w",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C",
    "Т": "T", "Х": "X", "У": "Y", "І": "I", "Ј": "J", "Ѕ": "S", "З": "3",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "χ": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N",
    "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "∙": ".", "·": ".", "․": ".", "。": ".", "٫": ".", "‐": "-", "‑": "-", "‒": "-",
    "–": "-", "—": "-", "−": "-", " ": " ", " ": " ", " ": " ", " ": " ",
}
_INVISIBLE = "­​‌‍⁠﻿"
# Spelled digits of the languages covered, from nought to nine.
_SPELLED = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
_VALUE = {w: str(i) for words in _SPELLED for i, w in enumerate(words.split())} | {"oh": "0"}
_AT = r"(?:at|arroba|arobase|@)"
_DOT = r"(?:dot|punkt|point|punto|\.)"
# Fixed values of the rule for a spoken at, see _is_spoken_address.
_TLDS = frozenset("com org net edu gov info test example invalid".split())
_DETERMINERS = frozenset(
    "a an the this that these those one some any no each every which what such another my your his "
    "her its our their polka".split()
)
_SHORT_WORDS = frozenset(
    "ad ah am an as at be by do eh er go ha he hi ho if in is it me my no of oh ok on or ow so to uh "
    "um up us we ye".split()
)
_PRONOUNS = frozenset("me us you him her it them myself anyone someone everyone people staff".split())


def _folding():
    """Every character that folds to one ASCII character other than itself."""
    fold = dict(_CYRILLIC_GREEK)
    for code in [*range(0x2070, 0x20A0), *range(0x2460, 0x2500), *range(0xFF01, 0xFF5F),
                 *range(0x1D400, 0x1D800), *range(0xFE50, 0xFE70), *range(0x2776, 0x2794)]:
        char = chr(code)
        plain = unicodedata.normalize("NFKC", char)
        if len(plain) == 1 and plain.isascii() and plain != char:
            fold[char] = plain
    for code in range(0x660, 0x10000):
        value = unicodedata.decimal(chr(code), None)
        if value is not None:
            fold[chr(code)] = str(value)
    return fold


_FOLD = _folding()
_words = "|".join(sorted(_VALUE, key=len, reverse=True))
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"


@dataclass
class Mapped:
    """A rewritten text; character ``i`` stands for ``source[starts[i]:ends[i]]``."""

    text: str
    starts: np.ndarray
    ends: np.ndarray

    def rewritten(self, pattern, change):
        """Replaces every match by ``change(match)``; new characters map to the whole match."""
        parts, starts, ends, at = [], [], [], 0
        for match in pattern.finditer(self.text):
            new = change(match)
            if new == match[0]:
                continue
            s, e = match.span()
            parts += [self.text[at:s], new]
            starts += [self.starts[at:s], np.full(len(new), self.starts[s])]
            ends += [self.ends[at:s], np.full(len(new), self.ends[e - 1])]
            at = e
        if not parts:
            return self
        return Mapped(
            "".join([*parts, self.text[at:]]),
            np.concatenate([*starts, self.starts[at:]]),
            np.concatenate([*ends, self.ends[at:]]),
        )


def _spelled_run(match):
    """Digits of a run of spelled digits; spelled plus and dot are kept as signs."""
    out = []
    for word in re.findall(r"[^\W_]+|\.", match[0].lower()):
        if word in _VALUE:
            out.append(_VALUE[word])
        elif word in ("plus", "más"):
            out.append("+")
        elif word.isdigit():
            out.append(word)
        else:
            out.append(".")
    return "".join(out)


_I = re.IGNORECASE
_link = r"[\s,-]{1,3}(?:(?:dot|punkt|point|punto)[\s,-]{1,3})?"
_TWO_SPELLED = re.compile(rf"[\W_](?:{_words}){_link}(?:{_words}|[0-9])")
_DIGIT_LETTER = re.compile(r"[0-9][OolI][0-9 -]")


def _folds(text):
    """Replaces the look-alikes that ``text`` has."""
    present = _FOLD.keys() & set(text)
    return re.compile("[" + "".join(map(re.escape, sorted(present))) + "]") if present else None


def _has(*hints):
    return lambda text, low: any(h in low for h in hints)


_GAP, _SPOKEN = r"[ \t]{1,3}", r"(?:dot|punkt|point|punto)"
_LABEL = r"[A-Za-z0-9-]{1,63}"
_SPOKEN_AT = re.compile(
    rf"(?<=[A-Za-z0-9_%+-]){_GAP}(?P<at>at|arroba|arobase|@){_GAP}(?=(?P<domain>{_LABEL}"
    rf"(?:(?:{_GAP}{_SPOKEN}{_GAP}|\.){_LABEL}){{0,5}}"
    rf"(?:{_GAP}{_SPOKEN}{_GAP}|\.)(?P<ending>[A-Za-z]{{2,63}})\b))", _I
)
#: Holds wherever _SPOKEN_AT matches, and starts cheaply.
_MAYBE_AT = re.compile(rf"[ \t](?:at|arroba|arobase|@){_GAP}{_LABEL}(?:\.[a-z0-9-]|{_GAP}{_SPOKEN}{_GAP})", _I)
_DOT_WORDS = re.compile(rf"{_GAP}({_SPOKEN}){_GAP}", _I)
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")
_PARTED = re.compile(r"[A-Za-z0-9-]+[._%+][A-Za-z0-9._%+-]*[A-Za-z0-9]\Z")
_ADDRESSED = re.compile(
    r"(?<![^\W_])(?:(?:writ|wrote|send|sent|mail|e-?mail|repl|respond|forward|address)[a-z]{0,5}[ \t]+to"
    r"|mailto|e-?mail|mail|contact|schreib[a-z]{0,3}[ \t]+an|(?:from|to|b?cc)(?=:))[:\s]{1,4}\Z", _I
)


def _is_spoken_address(match):
    """Whether a spoken at stands for an at sign, by the words of the address and the one before it.

    ``arroba``, ``arobase`` and a lone ``@`` always do. ``at`` with a spoken dot does with any ending of
    two letters or more, unless a determiner follows it (``at the dot matrix``); where all spoken dots
    are ``point``, which English prose has after ``at`` too (``at boiling point water``), the ending must be
    listed or have two letters that are no English word. ``at`` with nothing but real dots mostly names
    a web site, so it does only if the local part is joined by ``. _ % +`` (``jane.doe at firma.ch``) or
    follows a word of addressing (``write to jane at firma.ch``).
    """
    if match["at"].lower() != "at":
        return True
    spoken = {d.lower() for d in _DOT_WORDS.findall(match["domain"])}
    if spoken:
        if re.match(_LABEL, match["domain"])[0].lower() in _DETERMINERS:
            return False
        ending = match["ending"].lower()
        return spoken != {"point"} or ending in _TLDS or len(ending) == 2 and ending not in _SHORT_WORDS
    local = _LOCAL.search(match.string, max(0, match.start() - 64), match.start())
    if _PARTED.match(local[0]):
        return True
    before = match.string[max(0, local.start() - 40) : local.start()]
    return local[0].lower() not in _PRONOUNS and bool(_ADDRESSED.search(before))


_spoken_dot = _has("dot", "punkt", "point", "punto")
_brackets = _has("[", "(", "{", "<")
#: The chain: a test that is cheap on clean text, a pattern, and what a match becomes.
TRANSDUCERS = (
    (
        lambda text, low: not (text.isascii() or set(_INVISIBLE).isdisjoint(set(text))),
        re.compile(f"[{_INVISIBLE}]"), lambda m: "",
    ),
    (lambda text, low: not text.isascii(), _folds, lambda m: _FOLD[m[0]]),
    (
        _brackets,
        re.compile(rf"\s{{0,3}}{_OPEN}\s{{0,3}}{_AT}\s{{0,3}}{_CLOSE}\s{{0,3}}", _I),
        lambda m: "@",
    ),
    (
        _brackets,
        re.compile(rf"\s{{0,3}}{_OPEN}\s{{0,3}}{_DOT}\s{{0,3}}{_CLOSE}\s{{0,3}}", _I),
        lambda m: ".",
    ),
    (
        lambda text, low: _TWO_SPELLED.search(" " + low),
        re.compile(
            rf"(?<![^\W_])(?:plus[\s-]{{1,3}})?(?:{_words})"
            rf"(?:{_link}(?:{_words}|[0-9]{{1,4}})(?![^\W_])){{2,}}", _I
        ),
        _spelled_run,
    ),
    (
        lambda text, low: _MAYBE_AT.search(text),
        _SPOKEN_AT, lambda m: "@" if _is_spoken_address(m) else m[0],
    ),
    (
        _spoken_dot,
        re.compile(r"(?<=[A-Za-z0-9])[ \t]{1,3}(?:dot|punkt|point|punto)[ \t]{1,3}(?=[A-Za-z0-9])", _I),
        lambda m: ".",
    ),
    (
        _has("@ ", " @", "@\t", "\t@"),
        re.compile(r"(?<=[A-Za-z0-9])[ \t]{0,2}@[ \t]{0,2}(?=[A-Za-z0-9-]{1,63}\.[A-Za-z0-9-])"),
        lambda m: "@",
    ),
    (
        lambda text, low: _DIGIT_LETTER.search(text),
        re.compile(r"(?<=[0-9])[OolI](?=[ -]?[0-9])"), lambda m: "0" if m[0] in "Oo" else "1",
    ),
)


def deobfuscated(text):
    """The rewritten text with its map back to the source, or None if nothing was disguised."""
    low, now, mapped = text.lower(), text, None
    for applies, pattern, change in TRANSDUCERS:
        if not applies(now, low):
            continue
        if not isinstance(pattern, re.Pattern):
            pattern = pattern(now)
        if pattern is None or not pattern.search(now):
            continue
        if mapped is None:
            places = np.arange(len(text))
            mapped = Mapped(text, places, places + 1)
        mapped = mapped.rewritten(pattern, change)
        now, low = mapped.text, mapped.text.lower()
    return mapped if mapped is not None and mapped.text != text else None


def spans_of(text):
    """``(kind number, start, end, is base)`` of all identifiers of a text, by kind and start.

    A disguised one is left out where a base span of its kind covers it.
    """
    base = identifiers(text)
    found = [(*span, True) for span in base]
    mapped = deobfuscated(text)
    if mapped is not None:
        seen = set()
        for kind, s, e in identifiers(mapped.text):
            start, end = int(mapped.starts[s]), int(mapped.ends[e - 1])
            covered = any(k == kind and b <= start and end <= f for k, b, f in base)
            if not covered and (kind, start, end) not in seen:
                seen.add((kind, start, end))
                found.append((kind, start, end, False))
    return sorted(found)


def masked(text, spans):
    """``text`` with each span, or run of overlapping spans, replaced by ``<KIND>``."""
    out, at, open_end = [], 0, -1
    for start, end, kind in sorted((s, e, k) for k, s, e, _ in spans):
        if start < open_end:
            open_end = max(open_end, end)
            continue
        if open_end >= 0:
            at = open_end
        out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        open_end = end
    return "".join([*out, text[max(open_end, 0):]])


_SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def _columns(texts):
    return [
        [{"kind": KINDS[k], "start": s, "end": e, "base": b} for k, s, e, b in spans_of(t)]
        for t in texts
    ]


def find_personal_data(docs):
    """``doc_id`` and ``spans`` of every row: kind, start, end and whether it is a base identifier.

    Null and empty texts have no spans. Rows with null or repeated ids each give a row.
    """
    return map_texts(id_and_text(docs), lambda: lambda t: {"spans": _columns(t)}, f"spans {_SPANS}")


def mask_personal_data(docs):
    """``docs`` with the identifiers in ``text`` replaced by their kind; null texts stay null.

    All other columns are kept as they are.
    """
    names = docs.columns
    kept = docs.select(
        *[F.col(n).alias(f"_{i}") for i, n in enumerate(names) if n != "text"],
        F.col("text").isNull().alias("_null"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    made = map_texts(
        kept, lambda: lambda t: {"_text": [masked(x, spans_of(x)) for x in t]}, "_text string"
    )
    clean = F.when(~F.col("_null"), F.col("_text")).alias("text")
    return made.select(
        *[clean if n == "text" else F.col(f"_{i}").alias(n) for i, n in enumerate(names)]
    )


def joined_spans(spans):
    """``kind:start:end`` of spans in their order, joined by commas."""
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    )
