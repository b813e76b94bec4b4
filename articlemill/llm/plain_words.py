"""Words of letters and digits: A-Z lower-cased, other ASCII characters part them, all else is kept."""

from __future__ import annotations

#: Byte to what it counts as. Bytes of characters beyond ASCII stand for themselves.
PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def plain_words(text: bytes | None) -> list[bytes]:
    """The words in order; none of a null text."""
    return text.translate(PLAIN).split() if text else []
