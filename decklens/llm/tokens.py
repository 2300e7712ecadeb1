"""Byte-pair token ids of whole texts, with a cache over space-separated chunks.

The vocabulary is the public byte-level BPE; its rank file gives, through
``tiktoken``, the same ids as the ``tokenizers`` JSON (held against it by a
test) in a fraction of the time.  With ``special`` the strings of the JSON's
added tokens (``<|endoftext|>``) get their own ids, as the JSON gives them by
default; else they are ordinary text.

A boundary before a single space between two non-white characters always ends
a pre-token, so the ids of a text are the concatenated ids of such chunks.
Words repeat, and most chunks come from the cache; where white space runs
together the neighbouring chunks are joined first, so the ids stay exact.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np

#: Added tokens of the JSON, which the rank file does not name.
SPECIAL = {"<|endoftext|>": 50256}
_SPECIAL = re.compile("|".join(map(re.escape, SPECIAL)))
#: Chunks that a Python worker keeps, some 220 bytes each.
CACHE = 300_000


def vocabulary_path(path: str | None = None) -> str:
    if path:
        return path
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class _Chunks(dict):
    """chunk -> little-endian ids of " " + chunk; None if the chunk cannot stand alone."""

    def __init__(self, encoding):
        self.encode = encoding.encode_ordinary

    def __missing__(self, chunk: str) -> bytes | None:
        if len(self) >= CACHE:
            self.clear()
        alone = chunk and not chunk[0].isspace() and not chunk[-1].isspace()
        out = self[chunk] = np.array(self.encode(" " + chunk), dtype="<u4").tobytes() if alone else None
        return out


class Encoder:
    def __init__(self, path: str, special: bool = False):
        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.chunks = _Chunks(self.encoding)
        self.special = special

    def __call__(self, text: str | None) -> bytes:
        """Ids of ``text`` (null: none) as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if not self.special:
            return self._ordinary(text)
        out, at = [], 0
        for m in _SPECIAL.finditer(text):
            out += [self._ordinary(text[at:m.start()]), np.array([SPECIAL[m.group()]], dtype="<u4").tobytes()]
            at = m.end()
        return b"".join(out) + self._ordinary(text[at:]) if out else self._ordinary(text)

    def _ordinary(self, text: str) -> bytes:
        if not text:
            return b""
        text = text.encode("utf-8", "replace").decode() if not text.isascii() else text
        parts = text.split(" ")
        found = list(map(self.chunks.__getitem__, parts[1:]))
        first = parts[0]
        if first and not first[-1].isspace() and None not in found:
            return np.array(self.encoding.encode_ordinary(first), dtype="<u4").tobytes() + b"".join(found)
        joined, run = [], [first]
        for c in parts[1:]:
            if run[-1] and not run[-1][-1].isspace() and c and not c[0].isspace():
                joined.append(" ".join(run))
                run = [c]
            else:
                run.append(c)
        joined.append(" ".join(run))
        ids = [self.encoding.encode_ordinary(joined[0])] + [self.encoding.encode_ordinary(" " + c) for c in joined[1:]]
        return b"".join(np.array(x, dtype="<u4").tobytes() for x in ids)


@lru_cache(maxsize=2)
def encoder(path: str, special: bool = False) -> Encoder:
    return Encoder(path, special)
