"""Token ids of whole texts by a byte-level BPE vocabulary file, in numpy batches.

The vocabulary file is a parameter; its merge ranks, its added tokens and the published splitting
rule of this family are used: texts are cut at added tokens, which have one id each, and the rest
is split into contractions, then runs of letters, digits or other signs with one
leading space, then white space whose last character stays with what follows. Splitting is
done for a whole batch on code-point classes; each distinct piece is encoded once by the
library and kept in a bounded cache. Tests hold the ids against the library on whole texts.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata

import numpy as np

from .common import U64, mix64, odd_multipliers

LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
#: Pieces kept in a worker's cache; it is emptied when full (ids do not depend on it).
CACHE_PIECES = 500_000


@functools.cache
def _classes() -> np.ndarray:
    t = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        g = unicodedata.category(chr(c))[0]
        if g == "L":
            t[c] = LETTER
        elif g == "N":
            t[c] = NUMBER
    # FIXED VALUES: Unicode White_Space
    for lo, hi in ((0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
                   (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)):
        t[lo:hi + 1] = SPACE
    return t


def piece_starts(codes: np.ndarray, doc_at: np.ndarray) -> np.ndarray:
    """Start offsets of the pieces of joined texts (code points); ``doc_at``: text starts and the total."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    cls = _classes()[codes]
    first = np.zeros(n + 1, bool)
    first[doc_at] = True                       # a text starts here (or the end)
    start = first[:-1].copy()
    start[1:] |= cls[1:] != cls[:-1]           # runs of one class
    end = np.ones(n, bool)
    end[:-1] = start[1:]                       # last character of its run
    space = cls == SPACE
    tail = space & end & ~first[1:]            # last of a white-space run that something follows
    blank = tail & (codes == 0x20)
    nxt = np.flatnonzero(blank) + 1
    start[tail] = True                         # the last white space is split off ...
    start[nxt] = False                         # ... and a plain space joins what follows
    # contractions: an apostrophe that starts a run of its own, not joined to a space
    apo = np.flatnonzero((codes == 0x27) & start & end)
    apo = apo[apo + 1 < n]
    apo = apo[~first[apo + 1]]
    if len(apo):
        c1 = codes[apo + 1]
        c2 = np.where(apo + 2 < n, codes[np.minimum(apo + 2, n - 1)], 0)
        c2[first[np.minimum(apo + 2, n)]] = 0
        one = np.isin(c1, [0x73, 0x74, 0x6D, 0x64])
        two = ((c1 == 0x72) & (c2 == 0x65)) | ((c1 == 0x76) & (c2 == 0x65)) | ((c1 == 0x6C) & (c2 == 0x6C))
        for at, w in ((apo[one], 2), (apo[two], 3)):
            start[at + 1] = False
            after = at + w
            start[after[after < n]] = True
    return np.flatnonzero(start)


class Encoder:
    """``encode(texts)`` -> all ids joined (uint32) and the id offsets of the texts. ``added``: the file's
    added tokens get their ids (the library's default), else they are plain text like any other."""

    def __init__(self, vocab_path: str, added: bool = False):
        import tiktoken
        with open(vocab_path, encoding="utf-8") as f:
            file = json.load(f)
        vocab = file["model"]["vocab"]
        tokens = file.get("added_tokens") or [] if added else []
        if any(t.get(k) for t in tokens for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{vocab_path}: added tokens that match by word or take in white space are not supported")
        self.added = {t["content"]: int(t["id"]) for t in tokens}
        self.marker = re.compile("|".join(re.escape(x) for x in sorted(self.added, key=lambda x: (-len(x), x)))) if self.added else None
        byte_of = _byte_alphabet()
        ranks = {bytes(byte_of[c] for c in piece): i for piece, i in vocab.items() if all(c in byte_of for c in piece)}
        # Splitting has been done: the library gets pieces joined by NUL and merges each one whole.
        self.bpe = tiktoken.Encoding("pieces", pat_str=r"[^\x00]+|\x00", mergeable_ranks=ranks, special_tokens={})
        self.nul = ranks[b"\x00"]
        self._clear()

    def _clear(self) -> None:
        """The cache: sorted piece hashes, with the place and number of their ids in ``flat``."""
        self.hash, self.at, self.n = np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        if len(self.hash) + len(pieces) > CACHE_PIECES:
            self._clear()
        ids = np.asarray(self.bpe.encode_to_numpy("\x00".join(pieces), disallowed_special=()), np.uint32)
        cut = np.flatnonzero(ids == self.nul)
        at, end = np.concatenate(([0], cut + 1)), np.append(cut, len(ids))
        self.hash = np.concatenate([self.hash, hashes])
        self.at = np.concatenate([self.at, at + len(self.flat)])
        self.n = np.concatenate([self.n, end - at])
        self.flat = np.concatenate([self.flat, ids])
        o = np.argsort(self.hash, kind="stable")
        self.hash, self.at, self.n = self.hash[o], self.at[o], self.n[o]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.marker is None or not any(x in t for t in texts for x in self.added):
            return self._plain(texts)
        # the parts between added tokens are texts of their own; the ids of the tokens go in between
        parts, tokens, after, first = [], [], [], [0]
        for t in texts:
            at = 0
            for m in self.marker.finditer(t):
                parts.append(t[at:m.start()])
                tokens.append(self.added[m.group()])
                after.append(len(parts))  # the part behind the token
                at = m.end()
            parts.append(t[at:])
            first.append(len(parts))
        ids, off = self._plain(parts)
        first = np.array(first)
        return np.insert(ids, off[after], np.array(tokens, np.uint32)), off[first] + np.searchsorted(after, first, "left")

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = "".join(texts)
        doc_at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)), out=doc_at[1:])
        if not joined:
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = piece_starts(codes, doc_at)
        length = np.diff(starts, append=len(codes))
        value = mix64((codes + np.uint32(1)).astype(U64) * U64(0x9E3779B97F4A7C15))
        value *= odd_multipliers(int(length.max()), 31)[np.arange(len(codes)) - np.repeat(starts, length)]
        h = mix64(np.add.reduceat(value, starts) + length.astype(U64))
        h[codes[starts] == 0] = 0  # pieces with NUL, the joining sign, come below
        u, first, which = np.unique(h, return_index=True, return_inverse=True)
        spot = np.searchsorted(self.hash, u)
        new = np.append(self.hash, U64(0))[spot] != u if len(self.hash) else np.ones(len(u), bool)
        if new.any():
            pick = lambda at: [joined[a:a + n] for a, n in zip(starts[at].tolist(), length[at].tolist(), strict=True)]
            if len(self.hash) + int(new.sum()) > CACHE_PIECES:
                self._clear()
                new[:] = True
            self._learn(u[new], ["?" if "\x00" in p else p for p in pick(first[new])])
            spot = np.searchsorted(self.hash, u)
        at, n = self.at[spot][which], self.n[spot][which]
        if (codes == 0).any():
            at, n = self._with_nul(joined, starts, length, at, n)
        end = np.cumsum(n)
        src = np.arange(int(end[-1])) + np.repeat(at - (end - n), n)
        return self.flat[src], np.concatenate(([0], end))[np.searchsorted(starts, doc_at)]

    def _with_nul(self, joined: str, starts: np.ndarray, length: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces that hold NUL, merged byte by byte through the library's single-piece call."""
        at, n = at.copy(), n.copy()
        for i, (a, w) in enumerate(zip(starts.tolist(), length.tolist(), strict=True)):
            p = joined[a:a + w]
            if "\x00" in p:
                ids = np.array(self.bpe._encode_single_piece(p), np.uint32)
                at[i], n[i] = len(self.flat), len(ids)
                self.flat = np.concatenate([self.flat, ids])
        return at, n


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabulary files."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {chr(b): b for b in keep}, 0
    for b in range(256):
        if b not in keep:
            out[chr(256 + extra)] = b
            extra += 1
    return out


@functools.cache
def encoder(vocab_path: str) -> Encoder:
    """One encoder a worker process and vocabulary file."""
    return Encoder(vocab_path, added=True)


def default_vocab() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")
