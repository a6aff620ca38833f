"""Personal data by anchor expansion.

One Aho-Corasick pass finds anchors: at-signs, digit-dot-digit, plus-digit, two digits of one number, schemes and the
names of identifiers. Around each anchor a small deterministic parser walks to the ends of the candidate and validates it.
Of each kind, candidates are taken from left to right and never overlap; one that fails validation is dropped whole.

Kinds ``email``, ``ip``, ``card``, ``phone``; added by cues: ``url`` (an address with a login before its host) and
``account`` (IBAN with right check digits, nnn-nn-nnnn after a social-security cue, 6 to 18 digits after an account cue).
Cues and schemes are found in any case; up to three of the words number, num, no, nr and is may stand between a cue and its number.

Defined results: null and empty texts have no spans; offsets are code points, the end exclusive; every row is handled by
itself, so repeated rows, other columns and empty tables need nothing; work is linear in the text.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account")

DIGITS = frozenset("0123456789")
UPPER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LOWER = {ord(c): c.lower() for c in UPPER}
ALNUM = DIGITS | UPPER | frozenset("abcdefghijklmnopqrstuvwxyz")
LOCAL = ALNUM | frozenset("._%+-")
LABEL = ALNUM | frozenset("-")
PHONE = DIGITS | frozenset(" ().-")
LOGIN = ALNUM | frozenset("._~%!$&'()*+,;=:-")
HOST = ALNUM | frozenset(".-")
GAP = frozenset(" :#.=-")
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "sftp://")
CUES = {"iban": "iban", "ssn": "ssn", "social security": "ssn", "account": "account", "acct": "account"}
FILLERS = frozenset(("number", "num", "no", "nr", "is"))
IBAN_SIZES = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 "
    "GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 "
    "PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20").split()}


def _after(text: str, i: int, chars: frozenset) -> int:
    n = len(text)
    while i < n and text[i] in chars:
        i += 1
    return i


def _before(text: str, i: int, low: int, chars: frozenset) -> int:
    while i > low and text[i - 1] in chars:
        i -= 1
    return i


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _iban(text: str, i: int) -> int:
    """End of the IBAN at ``i``, or -1: at its country's length, or for other countries at the last end of a group that is right."""
    letters, ends, j = [], [], i
    while j < len(text) and len(letters) < 34 and (text[j] in DIGITS or text[j] in UPPER or text[j] == " " and text[j + 1:j + 2] in ALNUM):
        if text[j] != " ":
            letters.append(text[j])
            if len(letters) >= 15 and (j + 1 == len(text) or text[j + 1] not in ALNUM):
                ends.append((len(letters), j + 1))
        j += 1
    code = "".join(letters)
    if not (15 <= len(code) and code[:2].isalpha() and code[2:4].isdigit()):
        return -1
    size = IBAN_SIZES.get(code[:2])
    for n, end in reversed(ends):
        if size in (None, n) and int("".join(str(int(c, 36)) for c in code[4:n] + code[:4])) % 97 == 1:
            return end
    return -1


def _number(text: str, i: int) -> int:
    """Where the number of the cue that ends at ``i`` begins, or -1: separators, and words between them."""
    for _ in range(4):
        start = i
        while start < len(text) and start < i + 4 and text[start] in GAP:
            start += 1
        if start == i:
            return -1
        i = start
        while i < len(text) and i < start + 7 and text[i] in ALNUM:
            i += 1
        if text[start:i].lower() not in FILLERS:
            return start
    return -1


class Finder:
    def __init__(self):
        own = ahocorasick.Automaton()
        anchors: dict[str, list[tuple[str, int]]] = {}

        def add(word: str, kind: str) -> None:
            anchors.setdefault(word, []).append((kind, len(word)))

        add("@", "email")
        for a in sorted(DIGITS):
            add("+" + a, "phone")
            for b in sorted(DIGITS):
                add(f"{a}.{b}", "ip")
                for sep in ("", " ", "-"):
                    add(a + sep + b, "card")
        for s in SCHEMES:
            add(s, "url")
        for cue, kind in CUES.items():
            add(cue, kind)
        for word, found in anchors.items():
            own.add_word(word, found)
        own.make_automaton()
        self.anchors = own

    def find(self, text: str) -> list[tuple[str, int, int]]:
        """All spans, by kind as listed, then by start."""
        out: dict[str, list[tuple[str, int, int]]] = {k: [] for k in KINDS}
        upto = dict.fromkeys(KINDS, 0)
        low = text.lower()
        if len(low) != len(text):  # some capitals become two characters
            low = text.translate(LOWER)
        for end, found in self.anchors.iter(low):
            for kind, size in found:
                begin = end + 1 - size
                parse = getattr(self, "_" + kind)
                for span in parse(text, begin, end + 1, upto):
                    out[span[0]].append(span)
        return [s for k in KINDS for s in out[k]]

    def _email(self, text, begin, end, upto):
        start = _before(text, begin, upto["email"], LOCAL)
        if start == begin:
            return
        stop = _after(text, end, LABEL)
        if stop == end:
            return
        labels = 1
        while text[stop:stop + 1] == "." and text[stop + 1:stop + 2] in LABEL:
            stop = _after(text, stop + 1, LABEL)
            labels += 1
        if labels > 1:
            upto["email"] = stop
            yield "email", start, stop

    def _ip(self, text, begin, end, upto):
        if begin < upto["ip"]:
            return
        start = _before(text, begin, upto["ip"], DIGITS)
        parts = []
        while True:
            stop = _after(text, start, DIGITS)
            parts.append((start, stop))
            if text[stop:stop + 1] != "." or text[stop + 1:stop + 2] not in DIGITS:
                break
            start = stop + 1
        upto["ip"] = stop
        for k in range(0, len(parts) - 3, 4):
            numbers = [text[a:b].lstrip("0") for a, b in parts[k:k + 4]]
            if all(len(x) <= 3 and int(x or 0) <= 255 for x in numbers):
                yield "ip", parts[k][0], parts[k + 3][1]

    def _card(self, text, begin, end, upto):
        if begin < upto["card"]:
            return
        i, digits, n = begin + 1, [text[begin]], len(text)
        while i < n:
            if text[i] in DIGITS:
                digits.append(text[i])
                i += 1
            elif text[i] in " -" and i + 1 < n and text[i + 1] in DIGITS:
                digits.append(text[i + 1])
                i += 2
            else:
                break
        upto["card"] = i
        if 16 <= len(digits) <= 19 and luhn("".join(digits)):
            yield "card", begin, i

    def _phone(self, text, begin, end, upto):
        if begin < upto["phone"]:
            return
        stop = _after(text, end, PHONE)
        while stop > end and text[stop - 1] not in DIGITS:
            stop -= 1
        if stop < end + 2:
            return
        upto["phone"] = stop
        if 8 <= sum(c in DIGITS for c in text[begin:stop]) <= 15:
            yield "phone", begin, stop

    def _url(self, text, begin, end, upto):
        if begin < upto["url"]:
            return
        at = _after(text, end, LOGIN)
        if at == end or text[at:at + 1] != "@":
            return
        stop = _after(text, at + 1, HOST)
        if stop > at + 1:
            upto["url"] = stop
            yield "url", begin, stop

    def _identifier(self, text, begin, end, upto, kind):
        if begin < upto["account"] or begin and text[begin - 1] in ALNUM:
            return
        start = _number(text, end)
        if start < 0:
            return
        if kind == "iban":
            stop = _iban(text, start)
        else:
            stop = _after(text, start, DIGITS | {"-"} if kind == "ssn" else DIGITS)
            body = text[start:stop]
            right = [len(x) for x in body.split("-")] == [3, 2, 4] if kind == "ssn" else 6 <= len(body) <= 18
            stop = stop if right and text[stop:stop + 1] not in ALNUM else -1
        if stop > start:
            upto["account"] = stop
            yield "account", start, stop

    def _iban(self, text, begin, end, upto):
        return self._identifier(text, begin, end, upto, "iban")

    def _ssn(self, text, begin, end, upto):
        return self._identifier(text, begin, end, upto, "ssn")

    def _account(self, text, begin, end, upto):
        return self._identifier(text, begin, end, upto, "account")


_FINDER: list[Finder] = []
SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find_all(batch: pa.Array) -> pa.Array:
    if not _FINDER:
        _FINDER.append(Finder())
    find, out = _FINDER[0].find, []
    for text in batch:
        value = text.as_py()
        out.append([dict(zip(("kind", "start", "end"), s)) for s in find(value)] if value else [])
    return pa.array(out, SPANS)


def pii_spans(text: Column | str) -> Column:
    """Array of (kind, start, end) of the personal data in a text, by kind as listed, then by start."""
    return F.arrow_udf(lambda batch: find_all(batch), "array<struct<kind:string,start:int,end:int>>")(text)


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; overlapping spans are one, of the first one's kind."""
    return cut_out(text, spans, lambda s: F.concat(F.lit("<"), s.kind, F.lit(">")))


def cut_out(text: Column, spans: Column, mark) -> Column:
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    merged = F.aggregate(ordered, begin, lambda a, s: F.when(s["start"] < a["at"], F.struct(
        F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))).otherwise(F.struct(
        s["end"].alias("at"), F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), mark(s)).alias("out"))))
    whole = F.concat(merged["out"], F.substring(text, merged["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
