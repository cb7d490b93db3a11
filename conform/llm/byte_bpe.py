"""Byte-level BPE by prefixes: the last token of each prefix tells the whole encoding."""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import ahocorasick
import regex
from pyspark.sql import DataFrame

from conform.llm.arrow import map_blocks, texts

#: Entries that each of a worker's memories holds; a full one starts anew, with the same results.
#: Of pieces the full one is kept beside the new one, until that is full.
REMEMBERED = 300_000


class PrefixEncoder:
    """Encode, extend and mend pieces of text by the ranks of a vocabulary.

    The encoding of a prefix is that of a shorter prefix plus one token, and only one
    token of the vocabulary can be that last one: it must be what its own bytes
    merge to, and it must stay apart from the last token of the shorter prefix when
    their bytes are merged together. So one token for each prefix is enough to walk
    back from any end, more bytes only need their own prefixes, and an edit only
    those from its place on.
    """

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.bytes = {rank: token for token, rank in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self.pieces = regex.compile(pattern).findall
        self.endings = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.endings.add_word(token.decode("latin-1"), (rank, len(token)))
        self.endings.make_automaton()
        self._whole: dict[int, bool] = {}
        self._apart: dict[tuple[int, int], bool] = {}
        self._known: dict[str, tuple[str, int, bytes]] = {}
        self._before: dict[str, tuple[str, int, bytes]] = {}

    def merged(self, piece: bytes) -> list[int]:
        """Tokens left when the neighbours of least rank are merged again and again."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            ranked = [
                (rank, i)
                for i in range(len(parts) - 1)
                if (rank := self.ranks.get(parts[i] + parts[i + 1])) is not None
            ]
            if not ranked:
                break
            at = min(ranked)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[part] for part in parts]

    def whole(self, token: int) -> bool:
        """Whether a token's bytes merge to that token."""
        if (known := self._whole.get(token)) is None:
            known = self._whole[token] = self.merged(self.bytes[token]) == [token]
        return known

    def apart(self, left: int, right: int) -> bool:
        """Whether two tokens side by side stay as they are."""
        pair = left, right
        if (known := self._apart.get(pair)) is None:
            if len(self._apart) >= REMEMBERED:
                self._apart.clear()
            known = self._apart[pair] = self.whole(right) and self.merged(
                self.bytes[left] + self.bytes[right]
            ) == [left, right]
        return known

    def prefixes(self, piece: bytes, last: list[int] | None = None) -> list[int]:
        """The last token of each prefix; ``last`` holds those known, for a piece's start.

        An automaton of the vocabulary finds the tokens that end at each byte.
        """
        last = list(last or ())
        done, pairs = len(last), self._apart
        text = piece.decode("latin-1")
        for end, (token, size) in self.endings.iter(text, max(0, done + 1 - self.longest)):
            if end < done:
                continue
            if end > done:
                break
            before = end - size
            if before < 0:
                fits = self.whole(token)
            elif (fits := pairs.get((last[before], token))) is None:
                fits = self.apart(last[before], token)
            if fits:
                last.append(token)
                done += 1
        if done < len(piece):
            raise ValueError("a byte of the text is not in the vocabulary")
        return last

    def appended(self, piece: bytes, last: list[int], more: bytes) -> list[int]:
        """The prefixes of a longer piece; nothing that came before is looked at again."""
        return self.prefixes(piece + more, last)

    def edited(self, piece: bytes, last: list[int], start: int, end: int, new: bytes) -> list[int]:
        """The prefixes after the bytes from ``start`` to ``end`` are replaced."""
        return self.prefixes(piece[:start] + new + piece[end:], last[:start])

    def tokens(self, last: list[int]) -> list[int]:
        """The encoding, read from the end."""
        found, end = [], len(last)
        while end:
            found.append(last[end - 1])
            end -= len(self.bytes[found[-1]])
        return found[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        """A piece that is itself in the vocabulary is that token, whatever merges give."""
        if (token := self.ranks.get(piece)) is not None:
            return [token]
        return self.tokens(self.prefixes(piece))

    def encode(self, text: str) -> list[int]:
        return [i for piece in self.pieces(text) for i in self.encode_piece(piece.encode())]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def digest(self, text: str) -> tuple[int, str, str]:
        """How many tokens, and the hashes of their ids and of the bytes they decode to."""
        if len(self._known) >= REMEMBERED:
            self._before, self._known = self._known, {}
        known, pieces = self._known, self.pieces(text)
        for piece in set(pieces).difference(known):
            if (found := self._before.get(piece)) is None:
                own = self.encode_piece(piece.encode())
                found = ",".join(map(str, own)), len(own), self.decode(own)
            known[piece] = found
        encoded = list(map(known.__getitem__, pieces))
        ids, counts, decoded = zip(*encoded, strict=True) if encoded else ((), (), ())
        return (
            sum(counts),
            hashlib.sha256(",".join(ids).encode()).hexdigest(),
            hashlib.sha256(b"".join(decoded)).hexdigest(),
        )


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> PrefixEncoder:
    """One encoder for each worker and vocabulary."""
    return PrefixEncoder(path, pattern)


def document_tokens(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """Each document encoded and decoded; the digest columns of the query.

    Null and empty texts have no tokens. Every row is encoded by itself, so repeated
    rows give equal ones and an empty table an empty one; other columns are not read.
    A worker keeps the vocabulary and bounded memories of pieces and pairs of tokens.
    """

    def encoded(block):
        found = [encoder(path, pattern).digest(text) for text in texts(block)]
        return [block.column("doc_id"), *map(list, zip(*found, strict=True))]

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_blocks(documents.select("doc_id", "text"), "text", encoded, schema)
