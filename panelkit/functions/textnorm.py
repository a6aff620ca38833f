"""Text column functions: everything runs in the JVM, Python only builds the lookup constants."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable, Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelkit.functions.scalars import col

_HANGUL_FIRST, _HANGUL_LAST = 0xAC00, 0xD7A3


def _plain(ch: str) -> str:
    """Base characters of ``ch``: its decomposition is followed down to the end, marks with a combining class are left out."""
    mapping = unicodedata.decomposition(ch).split()
    if mapping and mapping[0].startswith("<"):
        mapping = mapping[1:]  # the kind of a compatibility mapping
    if not mapping:
        return "" if unicodedata.combining(ch) else ch
    return "".join(_plain(chr(int(point, 16))) for point in mapping)


@lru_cache(maxsize=1)
def _accent_tables() -> tuple[str, str, str, tuple[tuple[str, str], ...]]:
    """(characters with a one-character plain form, those forms, characters to drop, (character, longer form))."""
    source, target, dropped, longer = [], [], [], []
    for point in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= point <= 0xDFFF or _HANGUL_FIRST <= point <= _HANGUL_LAST:
            continue
        ch = chr(point)
        plain = _plain(ch)
        if plain == ch:
            continue
        if not plain:
            dropped.append(ch)
        elif len(plain) == 1:
            source.append(ch)
            target.append(plain)
        else:
            longer.append((ch, plain))
    return "".join(source), "".join(target), "".join(dropped), tuple(longer)


@lru_cache(maxsize=1)
def _hangul_parts() -> tuple[tuple[str, ...], tuple[str, ...], tuple[str, ...]]:
    lead = tuple(chr(0x1100 + i) for i in range(19))
    vowel = tuple(chr(0x1161 + i) for i in range(21))
    tail = ("",) + tuple(chr(0x11A8 + i) for i in range(27))
    return lead, vowel, tail


def _strings(values: Iterable[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _expand_long(c: Column) -> Column:
    """Replace characters whose plain form has several letters. Costly, hence only called on rows that hold one."""
    longer = _accent_tables()[3]
    keys, values = "".join(k for k, _ in longer), _strings(v for _, v in longer)
    lead, vowel, tail = (_strings(part) for part in _hangul_parts())

    def one(ch: Column) -> Column:
        offset = F.ascii(ch) - _HANGUL_FIRST
        syllable = F.concat(
            F.element_at(lead, (F.floor(offset / 588) + 1).cast("int")),
            F.element_at(vowel, (F.floor((offset % 588) / 28) + 1).cast("int")),
            F.element_at(tail, (offset % 28 + 1).cast("int")),
        )
        position = F.instr(F.lit(keys), ch)
        return (
            F.when(F.ascii(ch).between(_HANGUL_FIRST, _HANGUL_LAST), syllable)
            .when((F.ascii(ch) > 127) & (position > 0), F.element_at(values, F.greatest(position, F.lit(1))))
            .otherwise(ch)
        )

    return F.array_join(F.transform(F.split(c, ""), one), "")


def _class(spans: Iterable[tuple[int, int]], negated: bool = False) -> str:
    return "[" + "^" * negated + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in spans) + "]"


@lru_cache(maxsize=1)
def _long_classes() -> tuple[str, str]:
    """(quick test, exact test) for characters with a longer plain form.

    The exact class has hundreds of ranges and is slow. The quick one only asks for a character outside the widest
    stretches that hold none, which ordinary text in most scripts does not have.
    """
    points = sorted({ord(k) for k, _ in _accent_tables()[3]} | {_HANGUL_FIRST})
    spans: list[list[int]] = []
    for p in points:
        if spans and p == spans[-1][1] + 1:
            spans[-1][1] = p
        else:
            spans.append([p, p])
    spans = [[a, _HANGUL_LAST if a == _HANGUL_FIRST else b] for a, b in spans]
    edges = [-1, *[e for span in spans for e in span], sys.maxunicode + 1]
    gaps = [(a + 1, b - 1) for a, b in zip(edges[::2], edges[1::2]) if b - a > 1]
    wide = [g for g in gaps if g[1] < 0x250 or g[1] - g[0] > 300 or 0x2000 <= g[0] <= 0x2030]
    return _class(wide, negated=True), _class(spans)


def strip_accents(c) -> Column:
    """Compatibility decomposition without combining marks: ``ñ`` to ``n``, ``ﬁ`` to ``fi``."""
    c = col(c)
    source, target, dropped, _ = _accent_tables()
    quick, exact = _long_classes()
    expanded = F.when(c.rlike(quick) & c.rlike(exact), _expand_long(c)).otherwise(c)
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.translate(expanded, source + dropped, target)).otherwise(c)


def normalize_text(c) -> Column:
    """Lower case, no accents, punctuation and digits to single spaces; null to the empty text."""
    return normalize_lower(F.lower(F.coalesce(col(c), F.lit(""))))


def normalize_lower(c) -> Column:
    """``normalize_text`` for text that is in lower case already."""
    return F.trim(F.regexp_replace(strip_accents(c), r"[^\p{L}\p{Nl}\p{No}_]+", " "))


def tokens(c, min_len: int = 2) -> Column:
    """Words of at least ``min_len`` word characters."""
    return F.regexp_extract_all(col(c), F.lit(rf"[\p{{L}}\p{{N}}_]{{{min_len},}}"), F.lit(0))


def kept_tokens(normalized, stopwords: Iterable[str] = (), min_len: int = 2) -> Column:
    """Words of a normalised text that are long enough and no stop words, in order."""
    words = sorted(stopwords)

    def keep(t: Column) -> Column:
        long_enough = F.length(t) >= min_len
        return long_enough & ~t.isin(words) if words else long_enough

    return F.filter(F.split(col(normalized), " "), keep)


def remove_stopwords(normalized, stopwords: Iterable[str]) -> Column:
    """Normalised text without stop words."""
    words = sorted(stopwords)
    return F.array_join(F.filter(F.split(col(normalized), " "), lambda t: ~t.isin(words)), " ")


def ngrams(words: str, n: int) -> Column:
    """Space-joined runs of ``n`` neighbouring elements of an array column, given by name."""
    if n == 1:
        return F.col(words)
    count = F.greatest(F.size(words) - (n - 1), F.lit(0))
    out = F.slice(words, 1, count)
    for k in range(2, n + 1):
        out = F.zip_with(out, F.slice(words, k, count), lambda left, right: F.concat(left, F.lit(" "), right))
    return out


def join_text(columns: Sequence, null_text: str = "") -> Column:
    """Columns joined by spaces; ``null_text='nan'`` reproduces text made from missing cells."""
    return F.concat_ws(" ", *[F.coalesce(col(c).cast("string"), F.lit(null_text)) for c in columns])


def slug(c) -> Column:
    """File-safe name: runs of other characters to ``_``, no accents, lower case."""
    joined = F.regexp_replace(col(c), r"[^\p{L}\p{N}_]+", "_")
    return F.trim(F.lower(strip_accents(joined)), F.lit("_"))
