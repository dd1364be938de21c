"""Parts of files, cut so that no token is in two of them.

A range of a file reaches from the first byte that is in no token at or after
its start to the first such byte at or after its end. Ranges that lie side by
side thus share nothing and leave nothing out, whoever reads them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import BinaryIO

#: Bytes of a file after which a piece is cut at the next byte that is in no token.
PIECE_BYTES = 8 * 1024 * 1024

#: Bytes that are read at once while looking for that byte.
STEP_BYTES = 64 * 1024

# Fixed value: the bytes that tokens are made of.
_NO_TOKEN = re.compile(rb"[^0-9A-Za-z]")


def first_break(file: BinaryIO, start: int, stop: int, step: int = STEP_BYTES) -> int | None:
    """The first byte in no token in [start, stop), or None: the range lies inside one token."""
    file.seek(start)
    at = start
    while at < stop:
        more = file.read(min(step, stop - at))
        if not more:
            return None
        found = _NO_TOKEN.search(more)
        if found:
            return at + found.start()
        at += len(more)
    return None


def pieces(
    file: BinaryIO, piece_bytes: int, start: int = 0, stop: int | None = None, step: int = STEP_BYTES
) -> Iterator[bytes]:
    """The content of a range in pieces of about this size that end between tokens.

    Without ``stop`` the range goes to the end of the file, whatever that is by
    now. A token of many pieces' length makes one long piece. An empty file is
    one empty piece; a range without a byte of its own has none.
    """
    if start:
        found = first_break(file, start, start + (1 << 62) if stop is None else stop, step)
        if found is None:
            return
        start = found
    file.seek(start)
    at, held = start, bytearray()
    while stop is None or at < stop:
        goal = piece_bytes if stop is None else min(piece_bytes, stop - at)
        searched, cut = goal, None
        while cut is None:
            if len(held) > searched:
                found = _NO_TOKEN.search(held, searched)
                cut = found.start() if found else None
                searched = len(held)
                continue
            more = file.read(max(step, goal - len(held)))
            if not more:
                break
            held += more
        if cut is None:
            if held or not at:
                yield bytes(held)
            return
        yield bytes(held[:cut])
        del held[:cut]
        at += cut
