"""Byte-pair encoding by backtracking, and decoding by an offset table.

The encoder never merges pairs. An Aho-Corasick automaton over the vocabulary finds the longest token at each place of a
word; a token is kept only if it is compatible with the one before it, that is, if merging would leave both as they are.
When no shorter token fits either, the encoder steps back. Places from which no encoding can continue are remembered, so
each place is settled once and the work is linear in the word's length.

Defined results: a null text counts as empty and gives no ids; an added token's string in a text becomes that token, as in
the tokenizers library; repeated rows are encoded alike; texts of any length are encoded whole; an
empty table stays empty; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from functools import lru_cache

import numpy as np

#: Fixed value: the pattern by which byte-level BPE splits a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED_PIECES, CACHED_CHARS = 400_000, 48  # pieces a worker remembers, and the longest of them


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file: itself, or the next free one past 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens as bytes, their merges, the longest-match automaton, and the offset table for decoding."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.tokens = [b""] * size
        for text, i in vocab.items():
            self.tokens[i] = bytes(alphabet[c] for c in text)
        self.ids = {t: i for i, t in enumerate(self.tokens) if t}
        for text, i in self.added.items():
            self.tokens[i] = text.encode()
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}  # pair -> (rank, token)
        self.halves: dict[int, tuple[int, int]] = {}  # token -> the pair it is merged from
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.merged.setdefault((left, right), (rank, whole))
            self.halves.setdefault(whole, (left, right))
        self.rank = {t: self.merged[p][0] for t, p in self.halves.items()}
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), i))
        self.automaton.make_automaton()
        self.shorter = {i: self._shorter(t) for t, i in self.ids.items()}
        self.lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.blob = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)
        self.pairs: dict[tuple[int, int], bool] = {}

    def _shorter(self, token: bytes) -> int:
        """The next longest token that starts ``token``, or -1."""
        for n in range(len(token) - 1, 0, -1):
            if (i := self.ids.get(token[:n])) is not None:
                return i
        return -1

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens, side by side, both survive the merging of their joined bytes.

        They do not if some pair that meets at their border would be merged before the merges that make up either side.
        The check walks down the two tokens' merge trees along the border and is remembered per pair.
        """
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            known = self.pairs[key] = self._check(left, right)
        return known

    def _check(self, left: int, right: int) -> bool:
        limit = float("inf")  # rank of the merge that comes next above the present pair
        while True:
            found = self.merged.get((left, right))
            if found is not None and found[0] < limit:
                return False
            above_left, above_right = self.rank.get(left, -1), self.rank.get(right, -1)
            if above_left < 0 and above_right < 0:
                return True
            # undo the later of the two merges; merging goes from left to right, so a pair at the border comes before a
            # merge of its own rank inside the right token, and after one inside the left token
            if above_left > above_right:
                limit = above_left
                left = self.halves[left][1]
            else:
                limit = above_right + 1
                right = self.halves[right][0]

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of one word."""
        whole = self.ids.get(word)
        if whole is not None:
            return [whole]
        n = len(word)
        longest = [-1] * n
        reach = [0] * n
        for end, (length, token) in self.automaton.iter(word.decode("latin-1")):
            start = end - length + 1
            if length > reach[start]:
                reach[start], longest[start] = length, token
        open_ = bytearray(b"\x01" * (n + 1))  # places an encoding may still end at
        kept: list[int] = []
        at, token = 0, longest[0]
        tokens, shorter, compatible = self.tokens, self.shorter, self.compatible
        while True:
            last = kept[-1] if kept else -1
            while True:
                end = at + len(tokens[token])
                if open_[end] and (last < 0 or compatible(last, token)):
                    kept.append(token)
                    at = end
                    if at == n:
                        return kept
                    token = longest[at]
                    break
                if shorter[token] >= 0:
                    token = shorter[token]
                    continue
                open_[at] = 0
                token = kept.pop()
                at -= len(tokens[token])
                last = kept[-1] if kept else -1
                # the token taken back is tried again; its end is now closed, so a shorter one follows

    def decode(self, ids: np.ndarray) -> bytes:
        """The ids' bytes, copied from one blob by the tokens' offsets and lengths."""
        if not len(ids):
            return b""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        place = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths) + np.repeat(self.offsets[ids], lengths)
        return self.blob[place].tobytes()


class PieceCache(dict):
    """Ids (little-endian unsigned 32-bit, as bytes) of the pieces between lone blanks.

    A text may be cut at a blank between two other characters without changing its words, so each distinct piece is
    encoded once per worker. ``None`` marks a piece that starts or ends with white space or is empty: next to it the
    blank is not a lone one. The cache starts anew when it is full; that changes the time, not the ids.
    """

    def __init__(self, encode, lead: str):
        super().__init__()
        self.encode, self.lead = encode, lead

    def __missing__(self, piece: str):
        if not piece or piece[0].isspace() or piece[-1].isspace():
            found = None
        else:
            found = self.encode(self.lead + piece)
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = found
        return found


class TextEncoder:
    """Whole texts to ids, through caches of pieces; ``encode`` makes the ids of one piece as bytes."""

    lone_blank = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, encode):
        self.encode = encode
        self.first, self.rest = PieceCache(encode, ""), PieceCache(encode, " ")

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        pieces = text.split(" ")
        head = self.first[pieces[0]]
        if len(pieces) == 1:
            return head if head is not None else self.encode(text)
        rest = self.rest
        try:
            return head + b"".join([rest[p] for p in pieces[1:]])
        except TypeError:  # some blank is not a lone one: cut more carefully
            pieces = self.lone_blank.split(text)
            return self.encode(pieces[0]) + b"".join([found if (found := rest[p]) is not None else self.encode(" " + p) for p in pieces[1:]])


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def backtracking_encoder(path: str) -> TextEncoder:
    """The text encoder of a vocabulary file, one per worker process."""
    import regex

    known, words = vocabulary(path), regex.compile(PATTERN)
    added = re.compile("(" + "|".join(map(re.escape, sorted(known.added, key=len, reverse=True))) + ")") if known.added else None

    def encode_word(word: str) -> bytes:
        ids = known.encode_word(word.encode("utf-8", "surrogatepass"))
        return struct.pack(f"<{len(ids)}I", *ids)

    settled: dict[str, bytes] = {}

    def encode(piece: str) -> bytes:
        found = []
        for i, part in enumerate(added.split(piece) if added else [piece]):
            if i % 2:
                found.append(struct.pack("<I", known.added[part]))
                continue
            for word in words.findall(part):
                ids = settled.get(word)
                if ids is None:
                    ids = encode_word(word)
                    if len(word) <= CACHED_CHARS:
                        if len(settled) >= CACHED_PIECES:
                            settled.clear()
                        settled[word] = ids
                found.append(ids)
        return b"".join(found)

    return TextEncoder(encode)


def encode_text(path: str, text: str | None) -> np.ndarray:
    return np.frombuffer(backtracking_encoder(path)(text or ""), dtype="<u4")


def decode_ids(path: str, ids) -> str:
    """Text of the ids; bytes that are not UTF-8 become U+FFFD."""
    return vocabulary(path).decode(np.asarray(ids, dtype=np.int64)).decode("utf-8", "replace")


def encode_documents(docs, path: str, text: str = "text", ids: str = "token_ids"):
    """``docs`` with an array column of token ids."""
    from perispark.llm.common import map_columns

    def run(texts):
        return {ids: [encode_text(path, t) for t in texts]}

    return map_columns(docs, [text], f"`{ids}` array<bigint>", run)


def decode_documents(docs, path: str, ids: str = "token_ids", text: str = "decoded"):
    """``docs`` with the text of an array column of token ids (null: empty)."""
    from perispark.llm.common import map_columns

    def run(rows):
        return {text: [decode_ids(path, r or []) for r in rows]}

    return map_columns(docs, [ids], f"`{text}` string", run)


def digest_documents(docs, path: str, text: str = "text"):
    """doc_id with the number of tokens, the digest of the decimal ids, and the digest of the text decoded from them.

    Ids and decoded text stay inside one pass over a batch; only digests leave it.
    """
    from perispark.llm.common import map_columns

    def run(texts):
        counts, ids_digests, text_digests = [], [], []
        for t in texts:
            found = encode_text(path, t)
            counts.append(len(found))
            ids_digests.append(hashlib.sha256(",".join(map(str, found.tolist())).encode()).hexdigest())
            text_digests.append(hashlib.sha256(decode_ids(path, found).encode()).hexdigest())
        return {"n_tokens": counts, "ids_sha256": ids_digests, "decoded_sha256": text_digests}

    return map_columns(docs, [text], "n_tokens bigint, ids_sha256 string, decoded_sha256 string", run, keep=["doc_id"])
