"""Byte-level tokens of whole texts, a part at a time."""

from __future__ import annotations

import re
from base64 import b64decode
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import tiktoken

#: Characters of a text that are encoded at a time.
PART = 1 << 18
#: Spaces in a row that the library's pattern is not trusted with.
LONG_RUN = 1 << 15

#: Where a text may be cut: no token has a space after another character.
_CUT = re.compile(r"(?<=[^\s\x1c-\x1f])(?=[ \n])")
#: Characters that are spaces to the library, in a long run.
_RUN = re.compile(rf"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{{{LONG_RUN},}}")


def text_parts(text: str, size: int = PART) -> Iterator[str]:
    """A text in parts of ``size`` characters or more that encode to the same tokens."""
    at = 0
    while len(text) - at > size:
        found = _CUT.search(text, at + size)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


class ByteEncoder:
    """Encoder for a file of base64 tokens and ranks.

    Strings in ``special`` become their ids wherever they stand; with an empty
    mapping all text is plain.
    """

    def __init__(self, ranks: bytes, special: dict[str, int]):
        merges = {b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding(
            "bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens=special
        )
        self.special = tuple(special)
        names = {rank: token for token, rank in merges.items()} | {i: s.encode() for s, i in special.items()}
        self.tokens = [names.get(i, b"") for i in range(max(names) + 1)]

    def _part(self, text: str) -> Iterator[np.ndarray]:
        at = 0
        if len(text) >= LONG_RUN:
            # one token word takes all of a run but its last space, if more plain text follows
            for run in _RUN.finditer(text):
                last = run.end() == len(text) or text.startswith(self.special, run.end())
                end = run.end() - (not last)
                yield self.encoding.encode_to_numpy(text[at : run.start()], allowed_special=set(self.special), disallowed_special=())
                yield np.array(self.encoding._encode_single_piece(text[run.start() : end]), np.uint32)
                at = end
        yield self.encoding.encode_to_numpy(text[at:], allowed_special=set(self.special), disallowed_special=())

    def parts(self, text: str, size: int = PART) -> Iterator[np.ndarray]:
        """Ids of a text, part by part."""
        for part in text_parts(text, size):
            yield from self._part(part)
