"""Texts cut at spaces into pieces that a tokenizer treats independently.

Most pieces of a corpus repeat, so what a tokenizer makes of a piece is kept in
a bounded cache of the Python worker.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

# White space in any of the definitions that tokenizers use, and the character
# that some of them write for a space. Fixed values.
_RARE_SPACE = "\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\u2581"
_SPACE = f" \n{_RARE_SPACE}"
_SAFE_SPACE = re.compile(f"(?<=[^{_SPACE}]) (?=[^{_SPACE}])")
_OTHER_SPACE = re.compile(f"[{_RARE_SPACE}]")
LONG_PIECE = 256


def has_loose_space(text: str) -> bool:
    """Some space may not stand between two other characters. Texts that have only
    spaces and line feeds are looked at closely, others are not."""
    return (
        not text
        or text[0] == " "
        or text[-1] == " "
        or "  " in text
        or " \n" in text
        or "\n " in text
        or _OTHER_SPACE.search(text) is not None
    )


class PieceCache:
    """``encode`` turns a list of pieces into as many values. ``joined`` gives,
    for every text, what ``join`` makes of the values of its pieces, in order.

    With ``tight``, only a space between two characters that are no white space
    separates pieces, and the first piece of a text, which no space precedes,
    is encoded by ``encode_first``. Otherwise every space separates.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], Sequence],
        encode_first: Callable[[list[str]], Sequence] | None = None,
        tight: bool = True,
        limit: int = 150_000,
    ):
        self._encode, self._first = encode, encode_first or encode
        self._tight, self._limit = tight, limit
        # Pieces of late, and those of the time before that; what is asked for again
        # moves on, the rest goes.
        self._values: dict[str, object] = {}
        self._earlier: dict[str, object] = {}

    def joined(self, texts: Sequence[str], join: Callable) -> list:
        if len(self._values) > self._limit:
            self._earlier, self._values = self._values, {}
        values, earlier = self._values, self._earlier
        cut, missing, heads = [], set(), {}
        known = values.get
        for text in texts:
            parts = _SAFE_SPACE.split(text) if self._tight and has_loose_space(text) else text.split(" ")
            head = None
            if self._first is not self._encode:
                head, parts = parts[0], parts[1:]
                heads[head] = None
            found = list(map(known, parts))
            if None in found:
                missing.update([p for p, v in zip(parts, found) if v is None])
                found = None
            cut.append((head, parts, found))
        again = missing.intersection(earlier)
        values.update([(p, earlier[p]) for p in again])
        order = list(missing - again)
        long = [p for p in order if len(p) > LONG_PIECE]
        values.update(zip(order, self._encode(order)))
        if self._first is not self._encode:
            names = list(heads)
            heads = dict(zip(names, self._first(names)))
        made = []
        for head, parts, found in cut:
            found = list(map(known, parts)) if found is None else found
            made.append(join(found if head is None else [heads[head], *found]))
        for piece in long:  # too large to keep
            del values[piece]
        return made
