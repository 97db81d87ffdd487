"""Personal data: regular expressions propose spans, checksums confirm them,
words nearby adjust the score.

Base kinds (``email``, ``ip``, ``card``, ``phone``): every leftmost
non-overlapping match that passes its check is reported, whatever its score.
The further spans below are reported from ``THRESHOLD`` on and where they touch no
base span: ``iban`` (mod-97), ``card`` inside a run of digits that holds more
than the card (Luhn and an issuer's number range), ``ssn`` and ``phone``
without a country code (no checksum, so only beside words that speak of one).

The patterns are scanned in time linear in the text: a run of characters that
cannot become a match is passed over once.  One row a document: null text has
no spans, a null or repeated id keeps its row, other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batches_of, id_text, released, spread

#: Order of the kinds at one start.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]
THRESHOLD = 0.5
#: Code points before and behind a span whose words count as its context.
BEFORE, BEHIND = 48, 24
NEAR = 0.3

_MAIL_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_MAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.([0-9]+)\.([0-9]+)\.([0-9]+))?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_LOCAL = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
_DIGIT = re.compile("[0-9]")
_WORD = re.compile(r"[^\W\d_]+")

# IBAN lengths by country as published in the IBAN registry.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15,
    "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19,
    "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
# Number ranges of card issuers (first digits, lengths).
ISSUERS = ((4, 4, (13, 16, 19)), (51, 55, (16,)), (2221, 2720, (16,)), (34, 34, (15,)), (37, 37, (15,)),
           (6011, 6011, (16, 19)), (644, 659, (16, 19)), (3528, 3589, (16, 19)), (36, 36, (14,)), (38, 39, (14,)),
           (300, 305, (14,)), (62, 62, (16, 19)))

#: Score of a confirmed match without context, by kind.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.35, "local": 0.35}
#: Words that speak for a kind, and words that speak for something else.
FOR = {
    "email": {"mail", "email", "contact", "correo", "courriel", "adresse"},
    "ip": {"ip", "host", "server", "address", "adresse", "login", "client"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "karte", "carte", "tarjeta", "payment"},
    "phone": {"phone", "tel", "telephone", "mobile", "cell", "call", "fax", "telefon", "telefono", "teléfono",
              "téléphone", "handy", "sms", "whatsapp"},
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta", "transfer"},
    "ssn": {"ssn", "social", "security"},
}
AGAINST = {
    "ip": {"version", "release", "section", "chapter", "v"},
    "card": {"order", "tracking", "isbn", "serial", "invoice"},
    "phone": {"isbn", "order", "serial", "invoice", "version"},
    "ssn": {"isbn", "order", "serial", "part", "model"},
}


def luhn(digits: str) -> bool:
    odd = sum(int(c) for c in digits[-1::-2])
    return (odd + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0  # of what no later match may use: the last match, or an @ that can stand in no name
    at = text.find("@")
    while at >= 0:
        tail = _MAIL_TAIL.match(text, at)
        # the part from ``end`` to this @ is looked at once
        start = end + len(text[end:at].rstrip(_MAIL_CHARS))
        if tail and start < at:
            yield start, tail.end()
            end = tail.end()
        else:
            end = at + 1
        at = text.find("@", max(end, at + 1))


def _base(text: str) -> Iterator[tuple[str, int, int]]:
    for s, e in _emails(text):
        yield "email", s, e
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        if m.group(1) is not None:
            parts = [p.lstrip("0") for p in m.group(0).split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        d = _digits(m.group(0))
        if 14 <= len(d) <= 19 and luhn(d):
            yield "card", m.start(), m.end()
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m.group(0))) <= 15:
            yield "phone", m.start(), m.end()


def _issued(digits: str) -> bool:
    return any(len(digits) in lengths and low <= int(digits[:len(str(low))]) <= high
               for low, high, lengths in ISSUERS)


def _inner_cards(text: str) -> Iterator[tuple[int, int]]:
    """Cards written as one group, or in the usual groups, within a longer run."""
    shapes = ((4, 4, 4, 4), (4, 6, 5), (4, 6, 4))
    for m in _CARD.finditer(text):
        if len(m.group(0)) < 14:
            continue
        groups = [(g.start() + m.start(), g.end() + m.start()) for g in re.finditer("[0-9]+", m.group(0))]
        i = 0
        while i < len(groups):
            for k in (1, 4, 3):
                part = groups[i:i + k]
                if len(part) < k or (k > 1 and tuple(e - s for s, e in part) not in shapes):
                    continue
                if part[-1][1] - part[0][0] > 24:
                    continue
                d = _digits(text[part[0][0]:part[-1][1]])
                if 13 <= len(d) <= 19 and _issued(d) and luhn(d):
                    yield part[0][0], part[-1][1]
                    i += k - 1
                    break
            i += 1


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in _IBAN.finditer(text):
        want = IBAN_LENGTHS.get(m.group(0)[:2])
        if not want:
            continue
        p, taken = m.start(), []
        while p < len(text) and len(taken) < want:
            c = text[p]
            if c == " " and text[p - 1] != " ":
                p += 1
                continue
            if not ("A" <= c <= "Z" or "0" <= c <= "9"):
                break
            taken.append(c)
            p += 1
        ends = p >= len(text) or not (text[p].isascii() and text[p].isalnum())
        if len(taken) == want and ends and mod97("".join(taken)):
            yield m.start(), p


def _further(text: str) -> Iterator[tuple[str, int, int, float]]:
    if not _DIGIT.search(text):
        return
    for s, e in _ibans(text):
        yield "iban", s, e, PRIOR["iban"]
    for s, e in _inner_cards(text):
        yield "card", s, e, PRIOR["card"]
    for m in _SSN.finditer(text):
        area, group, serial = m.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", m.start(), m.end(), PRIOR["ssn"]
    for m in _LOCAL.finditer(text):
        yield "phone", m.start(), m.end(), PRIOR["local"]


def _context(text: str, kind: str, start: int, end: int) -> float:
    words = {w.lower() for part in (text[max(0, start - BEFORE):start], text[end:end + BEHIND])
             for w in _WORD.findall(part)}
    return NEAR * (bool(words & FOR.get(kind, set())) - bool(words & AGAINST.get(kind, set())))


def find_spans(text: str) -> list[tuple[str, int, int, float, bool]]:
    """(kind, start, end, score, base) by start, then kind; code points, end exclusive."""
    def scored(kind, s, e, prior):
        return min(1.0, max(0.0, round(prior + _context(text, kind, s, e), 6)))

    spans = [(k, s, e, scored(k, s, e, PRIOR[k]), True) for k, s, e in _base(text)]
    more = [(k, s, e, scored(k, s, e, prior), False) for k, s, e, prior in _further(text)]
    # spans of one kind stand in order; the better ones first, then the earlier ones
    more = sorted((x for x in more if x[3] >= THRESHOLD), key=lambda x: (-x[3], x[1], KINDS.index(x[0])))
    if more:
        taken = _Taken([(s, e) for _, s, e, _, _ in spans])
        spans += [x for x in more if taken.add(x[1], x[2])]
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


class _Taken:
    """Stretches of a text by cells of 64 code points, to find overlaps."""

    def __init__(self, spans):
        self.cells: dict[int, list[tuple[int, int]]] = {}
        for s, e in spans:
            self._put(s, e)

    def _put(self, s, e):
        for c in range(s >> 6, (e - 1 >> 6) + 1):
            self.cells.setdefault(c, []).append((s, e))

    def add(self, s, e) -> bool:
        if any(a < e and s < b for c in range(s >> 6, (e - 1 >> 6) + 1) for a, b in self.cells.get(c, ())):
            return False
        self._put(s, e)
        return True


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                   ("score", pa.float64()), ("base", pa.bool_())])
_OUT = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(_SPAN)), ("masked", pa.string())])
_DDL = ("doc_id long, spans array<struct<kind string, start long, end long, score double, base boolean>>, "
        "masked string")


def _mask(text: str, spans) -> str:
    out, at = [], 0
    for kind, s, e, _, _ in spans:
        if s >= at:
            out += [text[at:s], f"<{kind}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       mask: bool = False) -> DataFrame:
    """(doc_id, spans, masked): a row per document; ``masked`` is the text with
    every span replaced by its kind (null unless asked for)."""
    @released
    def run(batches):
        def rows():
            for batch in batches:
                ids, texts = batch.column(0), batch.column(1)
                for i in range(batch.num_rows):
                    text = texts[i].as_py()
                    spans = find_spans(text)
                    yield (ids[i].as_py(),
                           [dict(zip(("kind", "start", "end", "score", "base"), x, strict=True)) for x in spans],
                           _mask(text, spans) if mask else None)
        return batches_of(rows(), _OUT)

    return spread(id_text(docs, id_col, text_col)).mapInArrow(run, _DDL)


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, and the spans as text."""
    base = F.filter("spans", lambda x: x["base"])
    line = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    count = lambda k: F.size(F.filter(base, lambda x: x["kind"] == k)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
                        F.sha2(F.concat_ws(",", F.transform(base, line)), 256).alias("base_sha256"),
                        F.concat_ws(",", F.transform("spans", line)).alias("spans"))
