"""Byte-level BPE encoding and decoding, exact and linear in the length of a text.

A piece of text is a match of the split pattern. Its bytes are read as Latin-1, so that an Aho-Corasick trie over the vocabulary's byte
strings works on ordinary strings. A piece of up to ``SHORT`` bytes is merged pair by pair. Encoding of a longer one walks left to right over the longest vocabulary match; a token is accepted
only if it may stand after its predecessor, i.e. if merging their joint bytes leaves exactly these two tokens. If no
prefix token fits, the predecessor is taken back and shortened, and the position is marked so that it is never tried again.
Two adjacent tokens that are each a valid encoding and are compatible form a valid encoding, so the result is that of the merge procedure.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .frame import OWN, per_text

#: Pieces of each of two generations, and pairs of tokens, that a worker remembers.
MEMO = 1 << 18
#: Bytes up to which a piece is encoded by its merges, whose time is quadratic; words hardly ever are longer.
SHORT = 32


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file: base64 of the token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class _Pieces(dict):
    """Ids of pieces met before. A full memo becomes the older generation, from which pieces that are met again return, so frequent ones stay
    and its memory is bounded."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= MEMO:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(piece)
        if ids is None:
            ids = self.encode(piece if piece.isascii() else piece.encode("utf-8", "surrogatepass").decode("latin-1"))
        self[piece] = ids
        return ids


class BytePairs:
    """Encoder and decoder of one vocabulary; ``pattern`` splits a text into pieces that are encoded separately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.split = regex.compile(pattern).findall
        self.ranks = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        missing = [b for b in range(256) if chr(b) not in self.ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes: {missing[:5]}")
        self.above = max(ranks.values()) + 1
        self.raw = {rank: token for token, rank in ranks.items()}
        self.trie = ahocorasick.Automaton()
        for token in self.ranks:
            self.trie.add_word(token, token)
        self.longest = max(map(len, self.ranks), default=1)
        self._halves: dict[str, tuple[str, str] | None] = {}
        self.fits = lru_cache(MEMO)(self._fits)
        self.pieces = _Pieces(self.encode_piece)
        self.decimal = {rank: str(rank) for rank in ranks.values()}

    def halves(self, token: str) -> tuple[str, str] | None:
        """The two tokens whose merge makes ``token``; None for a single byte and for a token that merging never makes.

        Tokens of lower rank are merged first, so these are the two that are left when the token's bytes are merged with it forbidden.
        """
        if token not in self._halves:
            parts = list(token)
            own = self.ranks[token]
            while len(parts) > 2:
                found = [(self.ranks.get(a + b, own), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
                rank, at = min(found)
                if rank >= own:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def _fits(self, left: str, right: str) -> bool:
        """Whether the merge procedure on ``left + right`` ends with exactly these two tokens.

        The tokens are taken apart along their merges, later merges first; a merge across the border that would have happened
        before either of the halves was made shows that they cannot stand side by side.
        """
        ranks = self.ranks
        limit = self.above
        while True:
            joined = ranks.get(left + right)
            if joined is not None and joined < limit:
                return False
            a, b = ranks[left], ranks[right]
            one, two = self.halves(left), self.halves(right)
            # the later-made token is opened first; of equal ones the right one, as the left one merges first
            if one is not None and (two is None or a > b):
                limit, left = a, one[1]
                # a border merge of the opened part must come strictly before the token's own merge
            elif two is not None:
                limit, right = b + 1, two[0]
            else:
                return True

    def _longest(self, piece: str, at: int) -> str:
        end = at + self.trie.longest_prefix(piece[at:at + self.longest])
        while piece[at:end] not in self.ranks:
            end -= 1
        return piece[at:end]

    def _shorter(self, token: str) -> str | None:
        end = len(token) - 1
        while end and token[:end] not in self.ranks:
            end -= 1
        return token[:end] if end else None

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece, given as Latin-1 of its bytes."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        if len(piece) <= SHORT:
            return self._merged(piece)
        chosen: list[str] = []
        dead = bytearray(len(piece) + 1)
        at, token = 0, self._longest(piece, 0)
        while True:
            while token is not None:
                end = at + len(token)
                if not dead[end] and (not chosen or self.fits(chosen[-1], token)):
                    break
                token = self._shorter(token)
            if token is None:
                # nothing may follow here: never come back to this position, and shorten the token before it
                dead[at] = 1
                token = chosen.pop()
                at -= len(token)
                token = self._shorter(token)
                continue
            chosen.append(token)
            at += len(token)
            if at == len(piece):
                return tuple(self.ranks[t] for t in chosen)
            token = self._longest(piece, at)

    def _merged(self, piece: str) -> tuple[int, ...]:
        """Ids of a short piece: of all adjacent pairs that make a token, that of the lowest rank is merged, the leftmost first."""
        rank_of, above, parts = self.ranks.get, self.above, list(piece)
        pairs = [rank_of(a + b, above) for a, b in zip(parts, parts[1:])]
        while pairs:
            rank = min(pairs)
            if rank == above:
                break
            at = pairs.index(rank)
            token = parts[at] = parts[at] + parts.pop(at + 1)
            del pairs[at]
            if at:
                pairs[at - 1] = rank_of(parts[at - 1] + token, above)
            if at < len(pairs):
                pairs[at] = rank_of(token + parts[at + 1], above)
        return tuple(map(self.ranks.__getitem__, parts))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.split(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.raw.__getitem__, ids))


class Vocabulary:
    """Ranks and pattern, sent to the executors once; every Python worker builds its automaton at the first use."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        self.shared = spark.sparkContext.broadcast((read_ranks(path), pattern))

    def encode(self, text: Column | str) -> Column:
        """array<int> of the ids of a text; null stands for an empty text."""
        shared = self.shared

        def make():
            pairs = BytePairs(*shared.value)
            return lambda texts: [pairs.encode(t or "") for t in texts]

        return per_text(make, "array<int>", pa.list_(pa.int32()))(F.col(text) if isinstance(text, str) else text)

    def decode(self, ids: Column | str) -> Column:
        """The bytes of an array of ids; null stands for no ids, an id outside the vocabulary is an error."""
        shared = self.shared

        def make():
            raw = {rank: token for token, rank in shared.value[0].items()}
            return lambda rows: [b"".join(map(raw.__getitem__, r or ())) for r in rows]

        return per_text(make, "binary", pa.binary())(F.col(ids) if isinstance(ids, str) else ids)

    def digests(self, text: Column | str) -> Column:
        """struct(n_tokens, ids_sha256, decoded_sha256): encodes and decodes in one pass without sending the ids back to the JVM."""
        shared = self.shared

        def make():
            pairs = BytePairs(*shared.value)

            def work(texts: list[str | None]) -> list[dict]:
                rows = []
                for text in texts:
                    ids = pairs.encode(text or "")
                    rows.append(dict(n_tokens=len(ids), ids_sha256=hashlib.sha256(" ".join(map(pairs.decimal.__getitem__, ids)).encode()).hexdigest(),
                                     decoded_sha256=hashlib.sha256(pairs.decode(ids)).hexdigest()))
                return rows

            return work

        schema = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
        return per_text(make, "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>", schema)(
            F.col(text) if isinstance(text, str) else text)


def tokenise(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array<int>) and ``decoded`` (binary, from the ids). Empty and null texts have no ids and empty bytes; repeated rows are
    encoded each; columns named like the results are replaced."""
    vocabulary = Vocabulary(docs.sparkSession, path, pattern)
    rest = [c for c in docs.columns if c.lower() not in ("ids", "decoded")]
    coded = docs.select(*[F.col(f"`{c}`") for c in rest], vocabulary.encode(F.col(f"`{text}`")).alias("ids"))
    return coded.withColumn("decoded", vocabulary.decode("ids"))


def token_digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every row; the hash of the ids is over their decimals joined by one space."""
    digests = Vocabulary(docs.sparkSession, path, pattern).digests(F.col(f"`{text}`"))
    return docs.select(F.col(f"`{key}`"), digests.alias(f"{OWN}r")).select(F.col(f"`{key}`"), f"{OWN}r.*")
