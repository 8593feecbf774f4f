"""Terms of texts: maximal runs of the bytes that do not separate, A to Z in lower case.

Texts are handled as UTF-8. Only ASCII separates, and the bytes of other characters are
all beyond ASCII, so runs of bytes are runs of characters.
"""

from __future__ import annotations

from collections.abc import Callable

#: What separates terms of letters and digits, as ranges of code points.
WORDS = ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
#: What separates terms of letters.
LETTERS = ((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def pattern(separators: tuple[tuple[int, int], ...]) -> str:
    """The same terms as a regular expression."""
    return "[^" + "".join(f"\\x{a:02X}-\\x{b:02X}" for a, b in separators) + "]+"


def splitter(separators: tuple[tuple[int, int], ...]) -> Callable[[bytes | None], list[bytes]]:
    """A function from a text to its terms, with repeats; a null text has none."""
    table = bytearray(range(256))
    table[ord("A") : ord("Z") + 1] = table[ord("a") : ord("z") + 1]
    for a, b in separators:
        table[a : b + 1] = b" " * (b + 1 - a)
    table = bytes(table)
    return lambda text: text.translate(table).split() if text else []
