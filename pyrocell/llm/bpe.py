"""Byte-pair encoding from a public vocabulary file: exact encoders that need no merge loop over a text.

A sequence of tokens is what the merges make of its letters if and only if every two neighbours are: the merges, run
on the letters of both, give back just these two. ``Vocabulary.fits`` holds that as a table filled on demand.
"""

from __future__ import annotations

import functools
import json
from array import array

import ahocorasick

from pyrocell.llm import pieces as P


def byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte: itself where it is printable in
    Latin-1, else the next one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


class Vocabulary:
    """Tokens as strings of letters; with an end-of-word suffix, a word's last letter is a letter of its own."""

    def __init__(self, path: str):
        self.path, spec = path, read_spec(path)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.byte_level = spec["normalizer"] is None
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.by_byte = byte_letters()
        self.of_byte = dict(enumerate(self.by_byte))
        #: The last letters: private-use characters, one for each byte letter.
        self.last = {c: chr(0xF0000 + ord(c)) for c in self.by_byte}
        self.id = {self.letters(t): i for t, i in model["vocab"].items()}
        self.memo: dict[tuple[str, str], bool] = {}

    @functools.cached_property
    def rank(self) -> dict[tuple[str, str], int]:
        merges = (m if isinstance(m, list) else m.split(" ") for m in read_spec(self.path)["model"]["merges"])
        return {(self.letters(a), self.letters(b)): k for k, (a, b) in enumerate(merges)}

    def letters(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix) and token != self.suffix:
            body = token[: -len(self.suffix)]
            return body[:-1] + self.last[body[-1]]
        return token

    def word(self, piece: bytes) -> str:
        """The letters of one piece."""
        s = piece.decode("latin-1").translate(self.of_byte)
        return s[:-1] + self.last[s[-1]] if self.suffix and s else s

    def merged(self, letters: str) -> list[str]:
        """What the merges make of the letters, by definition: the lowest rank first, leftmost first."""
        parts = list(letters)
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda k: self.rank.get((parts[k], parts[k + 1]), 1 << 40))
            pair = (parts[best], parts[best + 1])
            if pair not in self.rank:
                break
            out, k = [], 0
            while k < len(parts):
                if k + 1 < len(parts) and (parts[k], parts[k + 1]) == pair:
                    out.append(parts[k] + parts[k + 1])
                    k += 2
                else:
                    out.append(parts[k])
                    k += 1
            parts = out
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Whether two tokens can stand side by side. The table is a cache of bounded size."""
        key = (left, right)
        known = self.memo.get(key)
        if known is None:
            if len(self.memo) > 1_000_000:
                self.memo.clear()
            known = self.memo[key] = self.merged(left + right) == [left, right]
        return known

    def split_specials(self, text: str) -> list[str | int]:
        """The text between special tokens, and their ids: the longest wins where two begin together."""
        if not any(s in text for s in self.specials):
            return [text]
        out: list[str | int] = []
        names = sorted(self.specials, key=len, reverse=True)
        while text:
            found = [(text.find(s), -len(s), s) for s in names if s in text]
            if not found:
                out.append(text)
                break
            at, _, name = min(found)
            if at:
                out.append(text[:at])
            out.append(self.specials[name])
            text = text[at + len(name) :]
        return out


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class BacktrackingEncoder:
    """Longest token first; where it can't follow what stands before it, the longest token that begins it, else a step back.

    An Aho-Corasick automaton over the tokens gives the longest match at every start of a word in one pass; a table
    gives every token's longest proper beginning that is a token. Positions from which no way leads on are marked, so
    no position is tried twice with the same token and the time is linear in the word. A letter of a word costs ten
    bytes or so besides the word itself.
    """

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.trie = ahocorasick.Automaton()
        self.token = {i: t for t, i in vocab.id.items()}
        for token, i in vocab.id.items():
            self.trie.add_word(token, (i, len(token)))
        self.trie.make_automaton()
        beginnings = ((i, next((vocab.id[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in vocab.id), None)) for t, i in vocab.id.items())
        self.shorter = {i: x for i, x in beginnings if x is not None}

    def encode(self, piece: bytes) -> array:
        letters = self.vocab.word(piece)
        if letters in self.vocab.id:
            return array("i", [self.vocab.id[letters]])
        n = len(letters)
        longest = array("i", [-1]) * n
        for last, (i, size) in self.trie.iter(letters):
            longest[last + 1 - size] = i  # ends ascend
        token, fits, dead, ids, at = self.token, self.vocab.fits, bytearray(n + 1), array("i"), 0
        now: int | None = longest[0] if longest[0] >= 0 else None
        while at < n:
            while now is not None and (dead[at + len(token[now])] or (ids and not fits(token[ids[-1]], token[now]))):
                now = self.shorter.get(now)
            if now is not None:
                ids.append(now)
                at += len(token[now])
                now = longest[at] if at < n and longest[at] >= 0 else None
            elif ids:
                dead[at] = 1
                now = ids.pop()  # its end is dead now, so a shorter one follows
                at -= len(token[now])
            else:
                raise ValueError(f"no way to write {piece!r} in this vocabulary")
        return ids


class PieceCodes:
    """The ids of whole texts: pieces by class runs, each distinct piece encoded once, ids gathered from a pool."""

    def __init__(self, vocab: Vocabulary, encode):
        import numpy as np

        self.vocab, self.encode, self.ids = vocab, encode, P.Pool(np.int32)
        self.table = P.PieceTable(self._add)

    def _add(self, pieces, first):
        if pieces is None:
            return self.ids.clear()
        self.ids.extend([self.encode(p) for p in pieces])

    def prepared(self, texts: list[str]) -> tuple[list[str], dict[int, list]]:
        """Normalised texts; those with special tokens are cut, and put together again by ``ids_of``."""
        ready, cut = [], {}
        for i, t in enumerate(texts):
            if "<|" in t and len(parts := self.vocab.split_specials(t)) + (isinstance(parts[0], int) if parts else 0) > 1:
                cut[i] = parts
                t = ""
            ready.append(t if self.vocab.byte_level else P.normal_word(t))
        return ready, cut

    def entries(self, texts: list[str]):
        """Entry numbers of all pieces, and how many there are until each text's end."""
        found = P.Pieces(texts, self.vocab.byte_level)
        return self.table.find(found), found.until

    def ids_of(self, texts: list[str]) -> list:
        """The ids of each text, as arrays."""
        import numpy as np

        ready, cut = self.prepared(texts)
        entry, until = self.entries(ready)
        flat, stop = self.ids.gather(entry)
        ends = np.concatenate([[0], stop])[until]
        out = np.split(flat, ends[:-1]) if len(texts) else []
        for i, parts in cut.items():
            out[i] = np.concatenate([np.array([x], np.int32) if isinstance(x, int) else self.ids_of([x])[0] for x in parts])
        return out


@functools.lru_cache(maxsize=2)
def piece_codes(path: str) -> PieceCodes:
    """One for each worker and file, by the backtracking encoder."""
    vocab = vocabulary(path)
    return PieceCodes(vocab, BacktrackingEncoder(vocab).encode)
