"""Words between ASCII white space, with A-Z in lower case."""

from __future__ import annotations

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The words in UTF-8; bytes.split parts at the six characters of ``[\\x20\\x09-\\x0D]``."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
