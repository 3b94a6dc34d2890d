"""Personal data and secrets, also in disguise, with places in the original text.

Transducers rewrite a text step by step: homoglyphs and fullwidth forms to ASCII, invisible
characters to nothing, runs of spelled digits to digits, and disguised "at" and "dot" to the
signs. Each rewriting keeps its edits, so that the span of an identifier found in the result
maps back to characters of the source. Only the source's own characters are masked.

Numbers are taken for identifiers if they can be ones: cards by their check digit, or by a word for a card
before them; IBANs by theirs; social security numbers by areas and groups that are given out; telephone
numbers by "+", an area code in brackets, the form 3-3-4, a word for a telephone before them, or if they
were spelled out; addresses by their syntax. A hexadecimal number is a secret only after a word for a secret.

Null and empty texts have no findings and stay as they are. Rows with equal or null doc_id or equal
content are each searched. Texts are searched whole. An empty table gives an empty result. Other columns are
passed through by ``mask``, whatever they are called, and ignored by ``find``.
"""

from __future__ import annotations

import ipaddress
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as A

KINDS = ("SECRET", "EMAIL", "IP", "IBAN", "CARD", "SSN", "PHONE")

# Transducers


def _homoglyphs() -> dict[int, str]:
    plain = "abcdefghijklmnopqrstuvwxyz"
    out = {}
    for like, ascii_ in (
        ("авеёзкмнорстухіјѕԁһӏԛԝ", "abee3kmhopctyxijsdhlqw"),
        ("АВЕЁЗКМНОРСТУХІЈЅԌԚԜ", "ABEE3KMHOPCTYXIJSGQW"),
        ("αβεικνορτυχ", "abeiknoptux"),
        ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEZHIKMNOPTYX"),
        ("․。｡﹒·∙⋅•", "........"),
        ("﹫＠", "@@"),
        ("‐‑‒–—−﹣－", "--------"),
        ("\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000", " " * 15),
        ("ıⅼⅰℓ", "ilil"),
    ):
        out |= {ord(a): b for a, b in zip(like, ascii_, strict=True)}
    out |= {0xFF01 + i: chr(0x21 + i) for i in range(94)}  # fullwidth forms
    for start in (0x1D400, 0x1D434, 0x1D468, 0x1D5A0, 0x1D5D4, 0x1D608, 0x1D63C, 0x1D670):  # mathematical letters
        out |= {start + i: c for i, c in enumerate(plain.upper() + plain)}
    for start in (0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6):  # and digits
        out |= {start + i: str(i) for i in range(10)}
    for start in (0x0660, 0x06F0, 0x0966):
        out |= {start + i: str(i) for i in range(10)}
    out |= {0x2460 + i: str(i + 1) for i in range(9)} | {0x24D0 + i: c for i, c in enumerate(plain)} | {0x24B6 + i: c for i, c in enumerate(plain.upper())}
    out |= {0x2070: "0", 0xB9: "1", 0xB2: "2", 0xB3: "3"} | {0x2070 + i: str(i) for i in range(4, 10)} | {0x2080 + i: str(i) for i in range(10)}
    return out


HOMOGLYPHS = _homoglyphs()
_LOOKALIKE = re.compile("[" + "".join(map(re.escape, map(chr, HOMOGLYPHS))) + "]")
_INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]+")
DIGIT_WORDS = {
    w: str(d)
    for d, words in enumerate(
        (
            "zero oh null cero zéro",
            "one eins ein un une uno",
            "two zwei zwo deux dos",
            "three drei trois tres",
            "four vier quatre cuatro",
            "five fünf cinq cinco",
            "six sechs seis",
            "seven sieben sept siete",
            "eight acht huit ocho",
            "nine neun neuf nueve",
        )
    )
    for w in words.split()
}
_DIGIT = "(?:" + "|".join(sorted(DIGIT_WORDS, key=len, reverse=True)) + ")"
#: A run of three digit words or more, with one or two separators between them.
_SPELLED = re.compile(rf"(?<!\w){_DIGIT}(?:[ \t\-.,/]{{1,2}}{_DIGIT}){{2,}}(?!\w)", re.I)
_WORD = re.compile(r"\w+")
_AT = r"(?:at|ät|arobase|arroba|klammeraffe)"
_DOT = r"(?:dot|punkt|point|punto)"
_OPEN, _CLOSE = r"[(\[{<]\s{0,2}", r"\s{0,2}[)\]}>]"
_BRACKETED = re.compile(rf"\s{{0,2}}{_OPEN}(?:({_AT}|@)|({_DOT}|\.)){_CLOSE}\s{{0,2}}", re.I)
_BRACKET = re.compile(r"[(\[{<]")
_DOTS = re.compile(_DOT, re.I)
_HOST = r"[A-Za-z0-9][A-Za-z0-9\-]*"
#: name at host dot domain, written out; some dots or the at may be signs already.
#: Dots with blanks on both sides count only before the usual last names of hosts.
_LAST = r"(?:com|org|net|edu|gov|info|io|co|de|fr|es|it|nl|eu|uk|us|ch|at)(?!\w)"
_WRITTEN = re.compile(rf"(?<=[\w+\-])(\s{{1,3}}{_AT}\s{{1,3}}|\s{{0,3}}@\s{{0,3}})({_HOST})((?:(?:\s{{1,3}}{_DOT}\s{{1,3}}|\s{{0,3}}\.(?=\w)|\s{{1,2}}\.\s{{1,2}}(?={_LAST})){_HOST})+)(?!\w)", re.I)
_DOT_SIGN = re.compile(rf"\s{{1,3}}{_DOT}\s{{1,3}}|\s{{0,3}}\.\s{{0,2}}", re.I)
_NAME_DOTS = re.compile(rf"(?<=\w)\s{{1,3}}{_DOT}\s{{1,3}}(?=[\w+\-]+@)", re.I)


class Aligned:
    """A text under rewriting; spans of its present form map back to the source."""

    def __init__(self, text: str):
        self.text = text
        self.steps: list[tuple[list[int], list[int], list[int], list[int]]] = []

    def rewrite(self, edits: Iterable[tuple[int, int, str]]) -> None:
        """Replace text[a:b] by a string, for edits in order that don't overlap."""
        out, at, made = [], 0, ([], [], [], [])
        size = 0
        for a, b, new in edits:
            if a < at or self.text[a:b] == new:
                continue
            out += [self.text[at:a], new]
            size += a - at
            for xs, x in zip(made, (size, size + len(new), a, b)):
                xs.append(x)
            size += len(new)
            at = b
        if made[0]:
            self.text = "".join([*out, self.text[at:]])
            self.steps.append(made)

    def source(self, start: int, end: int) -> tuple[int, int]:
        for new_a, new_b, old_a, old_b in reversed(self.steps):
            i = bisect_right(new_a, start) - 1
            if i >= 0:
                start = old_a[i] if start < new_b[i] else old_b[i] + start - new_b[i]
            i = bisect_right(new_a, end - 1) - 1
            if i >= 0:
                end = old_b[i] if end <= new_b[i] else old_b[i] + end - new_b[i]
        return start, end


def _spelled_edits(text: str) -> Iterable[tuple[int, int, str]]:
    for m in _SPELLED.finditer(text):
        words = _WORD.findall(m[0].lower())
        if len(set(words)) > 1:  # one word again and again is no number
            yield m.start(), m.end(), "".join(DIGIT_WORDS[w] for w in words)


def _written_edits(text: str) -> Iterable[tuple[int, int, str]]:
    for m in _WRITTEN.finditer(text):
        if "@" not in m[1] and not _DOTS.search(m[3]):
            continue  # "look at example.com" names no one
        yield m.start(1), m.end(1), "@"
        for d in _DOT_SIGN.finditer(text, m.start(3), m.end(3)):
            yield d.start(), d.end(), "."


def normalise(text: str) -> Aligned:
    out = Aligned(text)
    if not text.isascii():
        if _LOOKALIKE.search(text):
            out.text = text.translate(HOMOGLYPHS)  # character by character: places stay
        out.rewrite((m.start(), m.end(), "") for m in _INVISIBLE.finditer(out.text))
    out.rewrite(_spelled_edits(out.text))
    if _BRACKET.search(out.text):
        out.rewrite((m.start(), m.end(), "@" if m[1] else ".") for m in _BRACKETED.finditer(out.text))
    if "@" in out.text or _DOTS.search(out.text):
        out.rewrite(_written_edits(out.text))
    if "@" in out.text and _DOTS.search(out.text):
        out.rewrite((m.start(), m.end(), ".") for m in _NAME_DOTS.finditer(out.text))
    return out


# Identifiers

_ANY = re.compile(r"[0-9@]")
_LOCAL = re.compile(r"[\w.%+\-]")
_DOMAIN = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9\-]{0,62})(?:\.[A-Za-z0-9][A-Za-z0-9\-]{0,62})*\.[A-Za-z]{2,24}(?![A-Za-z0-9])")
_IPV4 = re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)")
_IPV6 = re.compile(r"(?<![\w:.])(?:[0-9a-fA-F]{1,4}:|::)(?:(?:[0-9a-fA-F:]{0,30}:)?(?:\d{1,3}\.){3}\d{1,3}|[0-9a-fA-F:]{1,38})(?![\w:])")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_CARD = re.compile(r"(?<![\w.+\-])(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){2}[ \-]\d{1,7}|\d{4}[ \-]\d{6}[ \-]\d{5})(?![\w\-])")
_CARD_WORD = re.compile(r"(?i)\b(?:card|cc|visa|mastercard|amex|karte|kreditkarte|carte|tarjeta)\b[^\w\n]{0,3}(?:(?:no|nr|num|number|is|ist|est|es|n°|nº)\b[^\w\n]{0,3}){0,2}$")
_SSN = re.compile(r"(?<![\w\-])(?!000|666|9\d\d)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w\-])")
_PHONE = re.compile(r"(?<![\w.])(?:\+\d{1,3}[ .\-]{0,2})?(?:\(\d{1,4}\)[ .\-]{0,2})?\d{1,5}(?:[ .\-]{1,2}\d{2,8}){1,5}(?![\w]|\.\d)|(?<![\w.])\+\d{7,15}(?!\w)|(?<![\w.+\-])\d{7,12}(?![\w\-]|\.\d)")
_DATE = re.compile(r"\d{4}[.\-]\d{1,2}[.\-]\d{1,2}(?!\d)|\d{1,2}[.\-]\d{1,2}[.\-]\d{4}(?!\d)")
_NORTH = re.compile(r"(?:1[ .\-])?[2-9]\d\d[ .\-][2-9]\d\d[ .\-]\d{4}")
_PHONE_WORD = re.compile(r"(?i)\b(?:tele(?:phone|fon|fono|fax|phones)?|tel|téléphone|teléfono|phone|mobile?|mobil|móvil|handy|cell|fax|whatsapp|sms|call(?: me| us)?|dial|ring|anrufen|appelez|llame|llama)\b[^\w\n]{0,3}(?:(?:at|on|no|nr|number|is|ist|est|es|me|us|unter|n°|nº)\b[^\w\n]{0,3}){0,2}$")
_SECRET = re.compile(
    r"(?i:\b(?:(?:\w{1,20}[_\- ])?(?:token|api[_\- ]?key|secret|passw(?:or)?d|passphrase|pwd)|(?:access|private|auth|encryption|signing)[_\- ]?key)\b[\"']?\s{0,3}[:=]\s{0,3}[\"']?)([^\s\"']{6,})"
    r"|(?<!\w)(AKIA[0-9A-Z]{16}|gh[pousr]_\w{20,}|sk-[\w\-]{20,}|eyJ[\w\-]{8,}\.[\w\-]{8,}\.[\w\-]{8,})(?!\w)"
)
_KEYED = re.compile(r"(?i)token|api.?key|secret|passw|passphrase|pwd|(?:access|private|auth|encryption|signing).?key|AKIA|gh[pousr]_|sk-|eyJ")
#: Characters before a number in which a word for what it is may stand.
CONTEXT = 40


def _iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def luhn_ok(s: str) -> bool:
    """Whether the last digit of a number checks the others."""
    total = 0
    for i, c in enumerate(reversed([int(c) for c in s if c.isdigit()])):
        total += c if i % 2 == 0 else c * 2 - 9 * (c > 4)
    return total % 10 == 0


def _card_ok(text: str, m: re.Match) -> bool:
    digits = "".join(filter(str.isdigit, m[0]))
    if _CARD_WORD.search(text[max(0, m.start() - CONTEXT) : m.start()]):
        return True
    # Of thirteen digits only old numbers that begin with 4 are cards; times and book numbers have as many.
    return digits[0] in ("4" if len(digits) == 13 else "23456") and luhn_ok(digits) and len(set(digits)) > 1


def _phone_ok(text: str, m: re.Match, spelled: Callable[[int, int], bool]) -> bool:
    n = sum(map(str.isdigit, m[0]))
    if not 7 <= n <= 15 or _DATE.match(m[0]):
        return False
    if m[0][0] == "+" or _NORTH.fullmatch(m[0]) or (m[0][0] == "(" and n >= 9):
        return True
    return _PHONE_WORD.search(text[max(0, m.start() - CONTEXT) : m.start()]) is not None or spelled(m.start(), m.end())


def _ipv6_ok(s: str) -> bool:
    try:
        return any(map(str.isdigit, s)) and ipaddress.IPv6Address(s) is not None
    except ValueError:
        return False


def detect(text: str, spelled: Callable[[int, int], bool] = lambda a, b: False) -> list[tuple[str, int, int]]:
    """(kind, start, end) of identifiers in a normalised text; where kinds overlap the first of KINDS stays."""
    found: list[tuple[str, int, int]] = []
    some = _ANY.search(text) is not None
    if _KEYED.search(text):
        for m in _SECRET.finditer(text):
            g = 1 if m[1] else 2
            found.append(("SECRET", m.start(g), m.end(g)))
    if some:
        at = text.find("@")
        while at >= 0:
            host, name = _DOMAIN.match(text, at + 1), at
            if host and at and text[at - 1] != ".":
                while name and _LOCAL.match(text, name - 1):
                    name -= 1
                if name < at:
                    found.append(("EMAIL", name, host.end()))
            at = text.find("@", at + 1)
        found += [("IP", m.start(), m.end()) for m in _IPV4.finditer(text)]
        if ":" in text:
            found += [("IP", m.start(), m.end()) for m in _IPV6.finditer(text) if _ipv6_ok(m[0])]
        found += [("IBAN", m.start(), m.end()) for m in _IBAN.finditer(text) if _iban_ok(m[0])]
        found += [("CARD", m.start(), m.end()) for m in _CARD.finditer(text) if _card_ok(text, m)]
        found += [("SSN", m.start(), m.end()) for m in _SSN.finditer(text)]
        found += [("PHONE", m.start(), m.end()) for m in _PHONE.finditer(text) if _phone_ok(text, m, spelled)]
    if len(found) < 2:
        return found
    found.sort(key=lambda f: (KINDS.index(f[0]), f[1], -f[2]))
    kept: list[tuple[str, int, int]] = []
    starts: list[int] = []
    for f in found:
        i = bisect_left(starts, f[2])  # the one before is the last that begins before the end
        if not i or kept[i - 1][2] <= f[1]:
            kept.insert(i, f)
            starts.insert(i, f[1])
    return kept


def findings(text: str | None) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, disguised) with places in ``text``, in order."""
    if not text:
        return []
    n = normalise(text)
    same = n.text == text
    out = []

    def from_words(a: int, b: int) -> bool:
        a, b = n.source(a, b)
        return any(map(str.isalpha, text[a:b]))

    for kind, a, b in detect(n.text, from_words):
        x, y = n.source(a, b)
        out.append((kind, x, y, not same and text[x:y] != n.text[a:b]))
    return out


def redact(text: str | None) -> str | None:
    """The text with every finding replaced by its kind in brackets."""
    found = findings(text)
    if not found:
        return text
    out, at = [], 0
    for kind, a, b, _ in found:
        out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _table(words: Iterable[str]) -> np.ndarray:
    texts = pa.array(sorted(words), pa.large_string())
    return np.sort(A.Words(*A.flat(texts), A.ALNUM).hash)


def _known(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[np.minimum(np.searchsorted(table, hashes), len(table) - 1)] == hashes


_DIGIT_HASHES = _table(DIGIT_WORDS)
_DOT_HASHES = _table("dot punkt point punto".split())
_AT_HASHES = _table("at ät arobase arroba klammeraffe".split())
_BRACKETS = np.zeros(256, bool)
_BRACKETS[[ord(c) for c in "([{<"]] = True
_KEY_HASHES = _table("token tokens api apikey secret password passwd passphrase pwd key accesskey privatekey authkey encryptionkey signingkey ghp gho ghu ghs ghr sk".split())
#: How words begin that are secrets themselves.
_KEY_STARTS = (b"akia", b"eyj")
_SIGNS = np.zeros(256, bool)
_SIGNS[[*range(48, 58), 64]] = True
#: First bytes of characters other than ASCII and the letters U+00C0 to U+00FF.
_SIGNS[192:256] = True
_SIGNS[195] = False


def suspects(texts: pa.LargeStringArray) -> np.ndarray:
    """False for texts that certainly have no finding: they have neither a digit nor "@" nor a character
    that may be a lookalike, no three digit words in a row, no word for a dot, none for a secret and no bracketed one for an at."""
    buf, offs = A.flat(pc.utf8_lower(texts))
    out = np.zeros(len(texts), bool)
    sign = _SIGNS[buf]
    # U+00D7 and U+00F7 are no letters, though their bytes are taken for ones of words.
    sign[:-1] |= (buf[:-1] == 195) & ((buf[1:] == 0x97) | (buf[1:] == 0xB7))
    out[np.searchsorted(offs, np.flatnonzero(sign), side="right") - 1] = True
    w = A.Words(buf, offs, A.ALNUM)
    if len(w.start):
        hit = _known(w.hash, _DOT_HASHES) | _known(w.hash, _KEY_HASHES)
        for begin in _KEY_STARTS:
            of = w.end - w.start >= len(begin)
            for i, c in enumerate(begin):
                of[of] = buf[w.start[of] + i] == c
            hit |= of
        at = np.flatnonzero(_known(w.hash, _AT_HASHES))
        for back in (1, 2, 3):
            hit[at] |= _BRACKETS[buf[np.maximum(w.start[at] - back, 0)]]
        digit = _known(w.hash, _DIGIT_HASHES)
        hit[2:] |= digit[2:] & digit[1:-1] & digit[:-2]
        out[np.searchsorted(w.first, np.flatnonzero(hit), side="right") - 1] = True
    return out


def find(docs: DataFrame) -> DataFrame:
    """One row for each finding: (doc_id, kind, start_char, end_char, disguised); characters are code points."""

    @A.lean
    def each(batches):
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            texts = A.text_column(batch, "text")
            for a, b in A.pieces(texts):
                some = pa.array(np.flatnonzero(suspects(texts[a:b])) + a)
                for i, text in zip(batch.column(0).take(some).to_pylist(), texts.take(some).to_pylist()):
                    for f in findings(text):
                        for xs, x in zip(rows, (i, *f)):
                            xs.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.int64()), pa.array(rows[4], pa.bool_())], ["doc_id", "kind", "start_char", "end_char", "disguised"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(each, "doc_id long, kind string, start_char long, end_char long, disguised boolean")


def mask(docs: DataFrame) -> DataFrame:
    """The documents with findings masked in ``text``; n_chars, where it exists, is that of the new text."""

    @A.lean
    def each(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = A.text_column(batch, "text")
            some = np.concatenate([suspects(texts[a:b]) for a, b in A.pieces(texts)] or [np.zeros(0, bool)])
            masked = pa.array([redact(t) for t in texts.filter(pa.array(some)).to_pylist()], pa.large_string())
            new = pc.replace_with_mask(batch.column(at).cast(pa.large_string()), pa.array(some), masked)
            yield batch.set_column(at, batch.schema.field(at), new.cast(batch.schema.field(at).type))

    out = docs.mapInArrow(each, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else out
