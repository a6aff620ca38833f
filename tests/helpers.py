"""Plain-Python counterparts that tests compare the library with."""

import unicodedata


def norm(text: str) -> str:
    """Lower case, no accents, letters and underscores only, single spaces."""
    plain = [c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c)]
    return " ".join("".join(c if c == "_" or unicodedata.category(c) in ("Nl", "No") or c.isalpha() else " " for c in plain).split())
