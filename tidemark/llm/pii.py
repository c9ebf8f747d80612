"""Personal data by anchor expansion: an Aho-Corasick automaton finds at-signs, plus signs, digits, schemes, identifier cues in any case,
street types and prefixes of known keys; a local parser at each anchor expands to the boundaries and validates.

Base kinds, leftmost and non-overlapping per kind: email, ip (parts at most 255), card (13 to 19 digits, Luhn), phone (+, 9 to 15
digits). Added kinds:

* url: http, https, ftp and their host.
* secret: 16 or more letters and digits behind a cue such as ``token =``, mixed and of at least ``ENTROPY`` bits a letter; without a cue,
  values of the known forms in ``FORMS``.
* account: 6 to 20 digits, single blanks or hyphens between them, behind a cue and perhaps ``number``, ``no.``, ``#``.
* iban: behind its cue, in one piece or in groups, check digits mod 97.
* ssn: behind its cue, three, two and four digits, none of the numbers that are never given out.
* address: a street with its house number (``12 Oak Street``, ``12 rue de la Paix``, ``Calle Mayor 5``, ``Lindenstraße 7``) or a post box,
  with unit, place and postal code where they follow. Names start with capitals; a number that reads as a year counts only if a place
  with its postal code follows.

Added spans never remove base spans; kinds may overlap each other.

Null and empty texts: no spans. Repeated rows give repeated results, an empty table an empty one, other columns play no part. Offsets are
code points, ends exclusive. Each letter is looked at a bounded number of times a kind (address parsers see ``NEAR`` letters on either
side of a street type), so very long texts take linear time. Spans of one kind don't overlap.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "secret", "account", "iban", "ssn", "address")
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
LOCAL = frozenset(LOWER + UPPER + DIGITS + "._%+-")
LABEL = frozenset(LOWER + UPPER + DIGITS + "-")
DIGIT = frozenset(DIGITS)
IN_PHONE = frozenset(DIGITS + " ().-")
WORD = frozenset(LOWER + UPPER + DIGITS)
VALUE = frozenset(LOWER + UPPER + DIGITS + "_-./+=")
SCHEMES = ("http", "https", "ftp")
CUES = {
    "token": "secret", "secret": "secret", "password": "secret", "passwd": "secret", "api_key": "secret", "apikey": "secret", "api-key": "secret", "access_key": "secret",
    "account": "account", "acct": "account", "konto": "account", "cuenta": "account", "compte": "account", "iban": "iban", "ssn": "ssn", "social security": "ssn",
}
#: What may stand between a cue and its value.
BETWEEN = re.compile(r"[ \t]*(?:(?:number|num|no|nr|is)\b\.?|#)?[ \t]*[:=]?[ \t]*[\"']?", re.IGNORECASE)
#: Bits a letter of a secret behind a cue: repeated or patterned fillings have fewer.
ENTROPY = 2.5
#: Keys that are known by their form, under their prefixes.
FORMS = {
    "AKIA": re.compile(r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])"),
    "ghp_": re.compile(r"ghp_[0-9A-Za-z]{36}(?![0-9A-Za-z])"),
    "xoxb-": re.compile(r"xoxb-[0-9]+-[0-9A-Za-z-]{16,}"),
    "sk_live_": re.compile(r"sk_live_[0-9A-Za-z]{16,}"),
    "eyJ": re.compile(r"eyJ[0-9A-Za-z_-]{8,}\.eyJ[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}"),
}
IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30}")
SSN = re.compile(r"(?!000|666|9)[0-9]{3}([- ]?)(?!00)[0-9]{2}\1(?!0000)[0-9]{4}(?![0-9])")
#: Letters on either side of a street type at which address parsers look.
NEAR = 160
#: Street types by where the name and the number stand: name and number before; number before, name behind; name, then number behind; a
#: word's end with the number behind; a box with its number behind.
STREETS = {
    "street": "before", "avenue": "before", "road": "before", "lane": "before", "drive": "before", "boulevard": "before", "court": "before", "square": "before", "terrace": "before",
    "rue": "around", "calle": "behind", "avenida": "behind", "paseo": "behind", "straße": "end", "strasse": "end", "po box": "box", "p.o. box": "box",
}
NAME = r"[A-ZÀ-ÖØ-Þ][^\W\d_]*(?:['’-][^\W\d_]+)*"
NAMES = rf"{NAME}(?:[ -]{NAME}){{0,3}}"
HOUSE = r"[0-9]{1,5}[A-Za-z]?(?![0-9A-Za-z])"
LINKED = rf"(?:(?:de|del|des|du|la|las|le|les|los|el)[ ]|d['’]|l['’])*{NAME}"
HOUSE_WORD, NAME_WORD = re.compile(rf"{HOUSE}\Z"), re.compile(rf"(?:{NAME}\.?|[0-9]+(?:st|nd|rd|th))\Z")
BEHIND = {
    "around": re.compile(rf"[ ]+{LINKED}(?:[ ]{LINKED}){{0,3}}"),
    "behind": re.compile(rf"[ ]+{LINKED}(?:[ ]{LINKED}){{0,3}},?[ ]+{HOUSE}"),
    "end": re.compile(rf"[ ]+{HOUSE}"),
    "box": re.compile(r"[ ]+[0-9]{1,6}(?![0-9A-Za-z])"),
}
UNIT = re.compile(r",?[ ]+(?:(?:[Aa]pt|[Ss]te)\.?|[Aa]partment|[Ss]uite|[Uu]nit|[Ff]lat|#)[ ]?[0-9A-Za-z-]{1,8}(?![0-9A-Za-z])")
GAP = r"(?:,?[ ]+|,?[ ]*\n[ ]*)"
PLACE = re.compile(rf"{GAP}(?:{NAMES}{GAP}(?:[A-Z]{{2}}[ ]+)?(?:[0-9]{{5}}(?:-[0-9]{{4}})?|[A-Z]{{1,2}}[0-9][0-9A-Z]?[ ][0-9][A-Z]{{2}})(?![0-9A-Za-z])|[0-9]{{4,5}}[ ]+{NAMES})")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def run_end(text: str, at: int, allowed: frozenset) -> int:
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """Expands both ways from an at-sign; the local part may not reach before ``floor``."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    end = run_end(text, at + 1, LABEL)
    if start == at or end == at + 1:
        return None
    labels = 1
    while end < len(text) and text[end] == "." and (nxt := run_end(text, end + 1, LABEL)) > end + 1:
        end, labels = nxt, labels + 1
    return (start, end) if labels > 1 else None


def dotted(text: str, at: int) -> tuple[int, bool] | None:
    """End of four digit runs with dots between that start here, and whether each is at most 255."""
    good, end = True, at
    for k in range(4):
        if k:
            if end >= len(text) or text[end] != ".":
                return None
            end += 1
        nxt = run_end(text, end, DIGIT)
        if nxt == end:
            return None
        good &= nxt - end <= 3 + len(text[end:nxt]) - len(text[end:nxt].lstrip("0")) and int(text[end:nxt][-4:]) <= 255
        end = nxt
    return end, good


def digit_groups(text: str, at: int) -> int:
    """End of the digits from here, single spaces or hyphens between them allowed."""
    n = len(text)
    while True:
        at = run_end(text, at, DIGIT)
        if at + 1 < n and text[at] in " -" and text[at + 1] in DIGIT:
            at += 1
        else:
            return at


def phone(text: str, at: int) -> int | None:
    """End of the longest number that starts with this plus sign."""
    if at + 1 >= len(text) or text[at + 1] not in DIGIT:
        return None
    end = run_end(text, at + 2, IN_PHONE)
    while end > at + 2 and text[end - 1] not in DIGIT:
        end -= 1
    return end if end >= at + 4 else None


def url(text: str, at: int) -> tuple[int, int] | None:
    """Expands from ``://``: a known scheme before it, a host and the rest up to white space, quotes or angle brackets behind it."""
    start = at
    while start > 0 and text[start - 1] in WORD:
        start -= 1
    host = at + 3
    while host < len(text) and (text[host] in LABEL or text[host] in ".:@"):
        host += 1
    if text[start:at].lower() not in SCHEMES or host == at + 3:
        return None
    end = host
    while end < len(text) and not text[end].isspace() and text[end] not in "\"'<>`":
        end += 1
    while end > host and text[end - 1] in ".,;:!?)]}":
        end -= 1
    return start, end


def secret(value: str) -> bool:
    n = len(value)
    if n < 16 or not any(c in DIGIT for c in value) or not any(c in WORD and c not in DIGIT for c in value):
        return False
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values()) >= ENTROPY


def behind_cue(text: str, at: int, kind: str) -> tuple[int, int, bool]:
    """Start and end of what stands behind a cue that ends here, and whether it is a value of the cue's kind."""
    at = BETWEEN.match(text, at).end()
    if kind == "secret":
        end = run_end(text, at, VALUE)
        return at, end, secret(text[at:end])
    if kind == "account":
        end = digit_groups(text, at)
        return at, end, 6 <= sum(c in DIGIT for c in text[at:end]) <= 20
    if m := (IBAN if kind == "iban" else SSN).match(text, at):
        ends = [m.end()] if kind == "ssn" else [e for e in range(m.end(), at + 14, -1) if text[e - 1] != " " and text[e : e + 1] not in WORD]
        for end in ends:
            if kind == "ssn" or iban(text[at:end].replace(" ", "")):
                return at, end, True
    return at, at, False


def street_start(text: str, at: int, names: bool) -> int | None:
    """Start of the house number before a street type, with one to four words of a name between them, or none."""
    low = max(0, at - NEAR)
    words = [m.span() for m in re.finditer(r"\S+", text[low:at])][-5:]
    for k, (i, j) in enumerate(reversed(words)):
        word, start = text[low + i : low + j], low + i
        if HOUSE_WORD.match(word.rstrip(",")) and (k > 0) == names and (start == 0 or text[start - 1].isspace()):
            return start
        if not names or not NAME_WORD.match(word):
            return None
    return None


def address(text: str, at: int, end: int, form: str) -> tuple[int, int] | None:
    """Expands from a street type (or box) at text[at:end] to the street, its unit and its place."""
    start, limit, last = at, min(len(text), end + NEAR), end
    if form == "end":
        while start > max(0, at - NEAR) and (text[start - 1].isalpha() or text[start - 1] == "-"):
            start -= 1
        if start == at or not text[start].isupper():
            return None
    elif at and text[at - 1].isalnum():
        return None
    if last < len(text) and text[last].isalnum():
        return None
    if form in ("before", "around"):
        if at == 0 or text[at - 1] != " " or (found := street_start(text, at, form == "before")) is None:
            return None
        start = found
    if form in BEHIND:
        if form == "behind" and not text[at].isupper() or (m := BEHIND[form].match(text, last, limit)) is None:
            return None
        last = m.end()
    if m := UNIT.match(text, last, limit):
        last = m.end()
    if m := PLACE.match(text, last, limit):
        return start, m.end()
    number = re.match(r"[0-9]+", text[start:at])
    return None if number and 1500 <= int(number.group()) <= 2099 else (start, last)


def iban(value: str) -> bool:
    if not (15 <= len(value) <= 34 and value.isalnum() and value[:2].isalpha() and value[2:4].isdigit()):
        return False
    turned = value[4:].upper() + value[:4].upper()
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for x in (*DIGITS, "@", "+", "://"):
        a.add_word(x, (len(x), "digit" if x in DIGIT else x, None))
    for cue, kind in CUES.items():
        a.add_word(cue, (len(cue), kind, None))
    for word, form in STREETS.items():
        a.add_word(word, (len(word), "address", form))
    for prefix in FORMS:
        a.add_word(prefix.lower(), (len(prefix), "form", None))
    a.make_automaton()
    return a


def lowered(text: str) -> str:
    """The text in lower case, letters whose lower case is more than one letter as they are, so places stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x) == 1 else c for c in text for x in [c.lower()])


def find(anchors: ahocorasick.Automaton, text: str) -> dict[str, list[tuple[int, int]]]:
    """All spans of a text by kind, in order of their starts."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    mail_end = ip_from = card_from = phone_end = url_end = street_end = 0
    cue_end = dict.fromkeys(KINDS, 0)
    for last, (size, what, street) in anchors.iter(lowered(text)):
        at = last - size + 1
        if what == "digit":
            if at >= ip_from:
                if (found := dotted(text, at)) is None:
                    ip_from = run_end(text, at, DIGIT)
                else:
                    ip_from, good = found
                    if good:
                        out["ip"].append((at, ip_from))
            if at >= card_from:
                card_from = digit_groups(text, at)
                digits = text[at:card_from].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out["card"].append((at, card_from))
        elif what == "@":
            if at >= mail_end and (span := email(text, at, mail_end)):
                out["email"].append(span)
                mail_end = span[1]
        elif what == "+":
            if at >= phone_end and (end := phone(text, at)) is not None:
                phone_end = end
                if 9 <= sum(c in DIGIT for c in text[at:end]) <= 15:
                    out["phone"].append((at, end))
        elif what == "://":
            if at >= url_end and (span := url(text, at)):
                out["url"].append(span)
                url_end = span[1]
        elif what == "address":
            if at >= street_end and (span := address(text, at, last + 1, street)) and span[0] >= street_end:
                out["address"].append(span)
                street_end = span[1]
        elif at and text[at - 1] in WORD:
            continue
        elif what == "form":
            form = FORMS.get(text[at : last + 1])
            if form and at >= cue_end["secret"] and (m := form.match(text, at)):
                out["secret"].append(m.span())
                cue_end["secret"] = m.end()
        elif not (last + 1 < len(text) and text[last + 1] in WORD):
            # what a cue inside an earlier value would give is a part of that value, and no better
            if at >= cue_end[what]:
                start, end, good = behind_cue(text, last + 1, what)
                cue_end[what] = max(cue_end[what], end if end > start else 0)
                if good:
                    out[what].append((start, end))
    return out


def line(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k in kinds for s, e in spans[k])


def redact(text: str, spans: dict[str, list[tuple[int, int]]]) -> str:
    """The text with each span, overlapping ones joined, replaced by its kind in angle brackets."""
    out, at = [], 0
    for s, e, kind in sorted((s, -e, k) for k, found in spans.items() for s, e in found):
        e = -e
        if s >= at:
            out += [text[at:s], f"<{kind.upper()}>"]
        at = max(at, e)
    return "".join(out) + text[at:]


def per_text(make_row: Callable) -> Callable:
    def make():
        anchors = automaton()

        def f(ids, texts):
            return [ids, *(list(c) for c in zip(*(make_row(t or "", find(anchors, t or "")) for t in texts), strict=True))]

        return f

    return make


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 and spans (kind:start:end, comma-joined) of each row."""
    schema = {"doc_id": "long", "n_email": "long", "n_ip": "long", "n_card": "long", "n_phone": "long", "base_sha256": "string", "spans": "string"}

    def row(text, spans):
        return *(len(spans[k]) for k in BASE), hashlib.sha256(line(spans, BASE).encode()).hexdigest(), line(spans, KINDS)

    return common.map_rows(df, [id_col, text_col], schema, per_text(row))


def redacted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text with all spans replaced; a null text stays null."""

    def make():
        anchors = automaton()
        return lambda ids, texts: [ids, [None if t is None else redact(t, find(anchors, t)) for t in texts]]

    return common.map_rows(df, [id_col, text_col], {"doc_id": "long", "text": "string"}, make)


def without_pii(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with all spans of its texts replaced; its other columns and null texts stay."""
    common.find_package(df.sparkSession)

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        anchors = automaton()
        for texts in batches:
            yield texts.map(lambda t: None if t is None else redact(t, find(anchors, t)))

    return df.withColumn(text_col, clean(F.col(f"`{text_col}`")))
