"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, plus signs, digits,
``://`` and the cue words of identifiers and addresses. A local parser then
expands each anchor to the left and right, and checks what it found (Luhn,
modulus 97, part ranges, digit counts). Work per text is linear: an anchor inside
a span that its parser has already read is skipped.

The base kinds email, ip, card and phone equal leftmost non-overlapping matches of
their patterns, filtered afterwards. The added kinds never change them:

* ``mail``: addresses with letters beyond ASCII, or with an address literal as host
* ``login``: scheme://user:secret@host
* ``tel``: numbers of 7 to 15 digits after a telephone cue, without a plus sign
* ``iban``: after its cue, modulus 97 holds
* ``account``: 6 to 17 digits after an account cue
* ``ssn``: three, two and four digits after its cue, none of the never-issued areas
* ``street``: a house number beside a street name
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwise.llm.common import table_text
from keepwise.session import ship_package

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "mail", "login", "tel", "iban", "account", "ssn", "street")
_ORDER = {kind: i for i, kind in enumerate(KINDS)}

# fixed values: the base patterns' pieces
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_DIGITS = re.compile(r"[0-9]++")
_WIDE_DOMAIN = re.compile(r"\[[0-9]{1,3}(?:\.[0-9]{1,3}){3}\]|[^\W_](?:[\w-]*[^\W_])?(?:\.[^\W_](?:[\w-]*[^\W_])?)+")
_AUTHORITY = re.compile(r"[^\s/?#\"'<>@:]++:[^\s/?#\"'<>@]++@(?:\[[0-9A-Fa-f:.]+\]|[A-Za-z0-9.-]+)(?::[0-9]{1,5})?")
_BETWEEN = r"(?i:[ \t]*(?:numbers?|number|nummer|no\.?|nr\.?|num\.?|#|:|=|is|ist))*[ \t]*"
_AFTER = {
    "tel": re.compile(_BETWEEN + r"(?P<span>\(?[0-9][ ().0-9/-]*[0-9])"),
    "iban": re.compile(_BETWEEN + r"(?P<span>[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})"),
    "account": re.compile(_BETWEEN + r"(?P<span>[0-9](?:[ -]?[0-9]){5,16})(?![ -]?[0-9])"),
    "ssn": re.compile(_BETWEEN + r"(?P<span>([0-9]{3})([ -]?)([0-9]{2})\3([0-9]{4}))(?![0-9])"),
}
_CUES = {
    "tel": ("phone", "telephone", "tel", "tel.", "tel:", "telefon", "teléfono", "téléphone", "mobile", "fax"),
    "iban": ("iban",),
    "account": ("account", "acct", "acct.", "konto", "kontonummer", "cuenta", "compte"),
    "ssn": ("ssn", "social security"),
    "street": ("street", "avenue", "road", "lane", "boulevard", "straße", "strasse", "rue", "calle", "avenida"),
}
_BEFORE_STREET = re.compile(r"(?<![\w.,-])[0-9]{1,5}[A-Za-z]?,? (?:[A-Z][\w'-]{1,30} ){1,3}$")
_NUMBER_THEN = re.compile(r"(?<![\w.,-])[0-9]{1,5}[A-Za-z]?,? $")
_STREET_NAME = re.compile(r" (?:(?:de|du|des|la|le|del|los|las) ){0,2}[A-Z][\w'-]{1,30}(?: [A-Z][\w'-]{1,30}){0,2}")
_NAME_NUMBER = re.compile(r" (?:(?:de|del|la|los|las) ){0,2}[A-Z][\w'-]{1,30}(?: [A-Z][\w'-]{1,30}){0,2},? (?:n[º°.] ?)?[0-9]{1,5}[A-Za-z]?(?!\w)")
_GERMAN = re.compile(r" [0-9]{1,4}[a-z]?(?!\w)")


@lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for c in "0123456789":
        found.add_word(c, ("digit", 1))
    for word, kind in (("@", "at"), ("+", "plus"), ("://", "scheme")):
        found.add_word(word, (kind, len(word)))
    for kind, words in _CUES.items():
        for word in words:
            for form in {word, word.title(), word.upper()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    doubled = sum((int(c) * 2 - 9 * (c > "4")) for c in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _left(text: str, at: int, least: int, good) -> int:
    while at > least and good(text[at - 1]):
        at -= 1
    return at


def _wide_mail(text: str, at: int, least: int) -> tuple[int, int] | None:
    start = _left(text, at, least, lambda c: c in _LOCAL or (c > "\x7f" and c.isalnum()))
    while start < at and text[start] in ".-":
        start += 1
    host = _WIDE_DOMAIN.match(text, at + 1)
    if not host or start == at or (text[start:at] + host[0]).isascii() and host[0][0] != "[":
        return None
    return (start, host.end()) if host[0][0] != "[" or all(int(p) < 256 for p in host[0][1:-1].split(".")) else None


def _login(text: str, at: int) -> tuple[int, int] | None:
    start = _left(text, at, 0, lambda c: c.isascii() and (c.isalnum() or c in "+.-"))
    found = _AUTHORITY.match(text, at + 3)
    return (start, found.end()) if found and start < at and text[start].isalpha() else None


def _after_cue(kind: str, text: str, end: int) -> tuple[int, int] | None:
    found = _AFTER[kind].match(text, end)
    if not found:
        return None
    span, (start, stop) = found["span"], found.span("span")
    if kind == "tel":
        ok = 7 <= len(_digits(span)) <= 15
    elif kind == "iban":
        plain = span.replace(" ", "")
        while not (ok := len(plain) >= 15 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1) and " " in span:
            span = span[:span.rindex(" ")]                 # a following word may look like one more group
            plain, stop = span.replace(" ", ""), start + len(span)
    elif kind == "ssn":
        ok = found[2] not in ("000", "666") and found[2] < "900" and found[4] != "00" and found[5] != "0000"
    else:
        ok = True
    return (start, stop) if ok else None


def _street(text: str, start: int, end: int) -> tuple[int, int] | None:
    head, word = text[max(0, start - 110):start], text[start:end].lower()
    if word in ("rue", "calle", "avenida"):
        number = _NUMBER_THEN.search(head)
        name = _STREET_NAME.match(text, end) if number else _NAME_NUMBER.match(text, end)
        return (start - len(number[0]) if number else start, name.end()) if name else None
    if word in ("straße", "strasse"):
        number = _GERMAN.match(text, end)
        begin = _left(text, start, 0, lambda c: c.isalpha() or c == "-")
        return (begin, number.end()) if number and begin < start and text[begin].isupper() else None
    found = _BEFORE_STREET.search(head)
    return (start - len(found[0]), end) if found else None


def personal_data(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of a text's spans by start, then kind, in code points, end exclusive."""
    text = text or ""
    spans: list[tuple[str, int, int]] = []
    read = dict.fromkeys(("email", "ip", "card", "phone", "mail", "cue"), 0)    # how far each parser has read
    for last, (anchor, size) in _anchors().iter(text):
        at, end = last - size + 1, last + 1
        if anchor == "digit":
            if at >= read["card"]:
                found = _CARD.match(text, at)
                if found:
                    read["card"] = found.end()
                    digits = _digits(found[0])
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        spans.append(("card", at, found.end()))
            if at >= read["ip"]:
                found = _IP.match(text, at)
                if found and all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in found.groups()):
                    spans.append(("ip", at, found.end()))
                read["ip"] = found.end() if found else _DIGITS.match(text, at).end()
        elif anchor == "at":
            start, host = _left(text, at, read["email"], _LOCAL.__contains__), _DOMAIN.match(text, end)
            if host and start < at:
                read["email"] = host.end()
                spans.append(("email", start, host.end()))
            wide = _wide_mail(text, at, read["mail"])
            if wide:
                read["mail"] = wide[1]
                spans.append(("mail", *wide))
        elif anchor == "plus":
            found = _PHONE.match(text, at) if at >= read["phone"] else None
            if found:
                read["phone"] = found.end()
                if 9 <= len(_digits(found[0])) <= 15:
                    spans.append(("phone", at, found.end()))
        elif anchor == "scheme":
            found = _login(text, at)
            if found:
                spans.append(("login", *found))
        elif at >= read["cue"] and not text[end:end + 1].isalnum() and (anchor == "street" or not text[at - 1:at].isalnum() or at == 0):
            found = _street(text, at, end) if anchor == "street" else _after_cue(anchor, text, end)
            if found:
                read["cue"] = found[1]
                spans.append((anchor, *found))
    return sorted(spans, key=lambda s: (s[1], _ORDER[s[0]], s[2]))


def redacted(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one, of the first's kind."""
    if not spans:
        return text
    out, at, reach = [], 0, 0
    for kind, start, end in spans:
        if start >= reach:
            out += [text[at:start], f"<{kind}>"]
        reach = at = max(reach, end)
    return "".join([*out, text[at:]])


_SPAN = "struct<kind:string,start:long,end:long>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        spans, clean = [], []
        for value in batch.column(1):
            text = value.as_py()
            found = personal_data(text)
            spans.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
            clean.append(redacted(text, found) if found else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind), pa.array(clean, pa.string())], names=["doc_id", "spans", "redacted"])


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, spans (array of kind, start, end), redacted (null: nothing found).

    Whole texts are read, however long. Null and empty texts have no spans. Spans of one kind never overlap;
    spans of different kinds may. Equal starts sort by the order of ``KINDS``. A null doc_id keeps its row,
    repeated rows return separately, other columns are ignored, an empty table gives an empty table.
    """
    ship_package(docs.sparkSession)
    return table_text(docs, id_col, text_col).mapInArrow(_scan, f"doc_id long, spans array<{_SPAN}>, redacted string")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def span_digests(found: DataFrame) -> DataFrame:
    """doc_id, a count of each base kind, base_sha256, spans (all of them as text)."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
