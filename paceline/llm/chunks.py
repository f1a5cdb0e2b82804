"""Cached encoding of texts by space-separated chunks.

Byte-level BPE splits a text by a pattern and encodes each match alone.  No
match of the pattern holds a visible character followed by white space, so a
text may be cut in front of every space that follows a visible character.
The chunks between such cuts repeat a great deal; their ids are kept in a
bounded table per Python worker.  The table only saves time: it is emptied
when full, and the ids do not depend on it.
"""

from __future__ import annotations

import contextlib
import gc
import re
from collections.abc import Callable, Iterator

# A space after white space is no place for a cut; such texts go in one piece.
_UNSAFE = re.compile(r"\s ")


@contextlib.contextmanager
def no_cycles() -> Iterator[None]:
    """No search for reference cycles meanwhile: the encoder makes many lists
    and no cycle, and the searches cost a sixth of its time."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


class Recent(dict):
    """A bounded table: two generations of at most ``limit`` entries."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.old = limit, {}

    def fill(self, keys: set[str], make: Callable[[list[str]], list[bytes]]) -> dict[str, bytes]:
        """Values of ``keys``, made where they are not in the older table."""
        got = {k: self.old[k] for k in keys if k in self.old}
        unseen = [k for k in keys if k not in got]
        if unseen:
            got.update(zip(unseen, make(unseen)))
        if len(self) + len(got) > self.limit:
            self.old = dict(self)
            self.clear()
        if len(got) <= self.limit:
            self.update(got)
        return got


class ChunkEncoder:
    """Texts to ids, as little-endian bytes.

    ``pre_tokens`` splits a string by the pattern; ``encode_tokens`` maps a
    list of pre-tokens to a list of bytes.  ``limit`` bounds each generation
    of the two tables (an entry takes about 200 bytes).
    """

    def __init__(self, pre_tokens: Callable[[str], list[str]],
                 encode_tokens: Callable[[list[str]], list[bytes]], limit: int = 400_000):
        self.pre_tokens, self.encode_tokens = pre_tokens, encode_tokens
        self.chunks, self.tokens = Recent(limit), Recent(limit)

    def encode(self, text: str) -> bytes:
        return self.encode_batch([text])[0]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        with no_cycles():
            return self._encode_batch(texts)

    def _encode_batch(self, texts: list[str]) -> list[bytes]:
        heads: list[list[str]] = []          # pre-tokens of whole texts and of first chunks
        rests: list[list[str]] = []
        for text in texts:
            first, rest = text, []
            if not _UNSAFE.search(text):
                first, *rest = text.split(" ")
            heads.append(self.pre_tokens(first))
            rests.append(rest)
        found = [list(map(self.chunks.get, rest)) for rest in rests]
        wanted = {c for rest, parts in zip(rests, found) if None in parts
                  for c, p in zip(rest, parts) if p is None}
        new = self.chunks.fill(wanted, self._encode_chunks)
        out = []
        for head, rest, parts in zip(self._encode_lists(heads), rests, found):
            if None in parts:
                parts = [new[c] if p is None else p for c, p in zip(rest, parts)]
            out.append(head + b"".join(parts))
        return out

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """A chunk's only space is the one in front of it, so in the joined
        text every pre-token that starts with a space opens a chunk.  Empty
        chunks and those with white space at an edge would share a match with
        the joining space; they are split alone."""
        plain = [c for c in chunks if c and not c[0].isspace() and not c[-1].isspace()]
        groups: list[list[str]] = []
        for token in self.pre_tokens(" " + " ".join(plain)) if plain else ():
            if token[0] == " ":
                groups.append([token])
            else:
                groups[-1].append(token)
        if len(groups) != len(plain):
            raise RuntimeError(f"{len(plain)} chunks were split into {len(groups)} groups")
        of = dict(zip(plain, groups))
        return self._encode_lists([of[c] if c in of else self.pre_tokens(" " + c) for c in chunks])

    def _encode_lists(self, lists: list[list[str]]) -> list[bytes]:
        get = self.tokens.get
        found = [[get(t) for t in ts] for ts in lists]
        wanted = {t for ts, parts in zip(lists, found) if None in parts for t, p in zip(ts, parts) if p is None}
        new = self.tokens.fill(wanted, self.encode_tokens)
        return [b"".join(parts) if None not in parts
                else b"".join([new[t] if p is None else p for t, p in zip(ts, parts)])
                for ts, parts in zip(lists, found)]
