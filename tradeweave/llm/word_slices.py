"""Words of a text by bytes, slice by slice: a very long text never becomes one list of words."""

from __future__ import annotations

from collections.abc import Callable, Iterator

SLICE = 1 << 20  # bytes


def byte_table(is_word: Callable[[int], bool], marks: bytes = b"", mark: int = 0x20) -> bytes:
    """Translation of bytes: A-Z to lower case, bytes of `marks` to `mark`, other bytes outside words to a space."""
    def to(b: int) -> int:
        if b in marks:
            return mark
        if 0x41 <= b <= 0x5A:
            return b + 32
        return b if is_word(b) else 0x20
    return bytes(map(to, range(256)))


def slices(data: bytes | None, table: bytes, keep: int, mark: bytes = b"", size: int = SLICE
           ) -> Iterator[tuple[list[bytes], int]]:
    """(words, lead): the words of a slice behind the last `keep` of the slice before, and how many those are.

    Slices end at a space after `size` bytes, so no word is cut. A byte `mark` is a word of its own. `table` has to
    leave no other white space in words than the space.
    """
    if not data:
        return
    data = data.translate(table)
    if mark:
        data = data.replace(mark, b" " + mark + b" ")
    lead: list[bytes] = []
    at = 0
    while at < len(data):
        end = len(data) if len(data) - at <= size else data.find(b" ", at + size)
        end = len(data) if end < 0 else end
        words = lead + data[at:end].split()
        if len(words) > len(lead):
            yield words, len(lead)
        lead = words[len(words) - keep:] if keep and len(words) > keep else words[:]
        at = end
