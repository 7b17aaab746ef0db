"""BPE encoding as a streaming transducer with bounded lookahead, and decoding as an incremental state machine.

A merge list with ranks fixes the token sequence of every string. Two facts make it computable from left to right:
a sequence is the right one exactly if each neighbouring pair of its tokens, written out and encoded on its own, stays that
pair; and so every prefix has exactly one possible last token. The transducer keeps, for the last few positions, the last
token of the prefix that ends there. A token is stable, and is emitted, once the chains of last tokens from all
positions that later input can still build on run through it. ``lookahead`` follows from the merge list alone: a change at the
right end can only travel leftwards through merges of rising rank, each of which needs the left part of the one
before, so the longest such chain bounds how far behind the input the bound of a stable token can lie. Memory is constant: the window of
positions never exceeds that lookahead plus the longest token.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np


def byte_symbols() -> dict[str, int]:
    """Byte of each printable character that stands for it in byte-level vocabularies: printable Latin bytes stand for themselves,
    the others are numbered from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = {chr(b): b for b in own}
    for i, b in enumerate(b for b in range(256) if b not in set(own)):
        out[chr(256 + i)] = b
    return out


class MergeList:
    """Merges of a byte-level BPE file: tokens as bytes, ids, the rank of each merge, and what follows from them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        symbols = byte_symbols()
        self.special = {t["content"]: t["id"] for t in model.get("added_tokens") or []}
        self.bytes_of: dict[int, bytes] = {}
        self.id_of: dict[bytes, int] = {}
        to_bytes = lambda s: bytes(symbols[c] for c in s)
        for s, i in model["model"]["vocab"].items():
            self.bytes_of[i] = to_bytes(s)
            self.id_of[self.bytes_of[i]] = i
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for rank, m in enumerate(model["model"]["merges"]):
            left, right = m if isinstance(m, list) else m.split(" ")
            a, b = self.id_of[to_bytes(left)], self.id_of[to_bytes(right)]
            whole = self.id_of[to_bytes(left + right)]
            self.rank.setdefault((a, b), rank)
            self.merged[a, b] = whole
            self.parts.setdefault(whole, (a, b))
        self.single = [self.id_of[bytes([b])] for b in range(256)]
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()
        self.length = {i: len(b) for i, b in self.bytes_of.items()}
        self.made = {t: self.rank[p] for t, p in self.parts.items()}
        self.longest = max(len(b) for b in self.id_of)
        self.prefixes: dict[bytes, int] = {}  # id of every token, -1 for what only begins one
        for b, i in self.id_of.items():
            self.prefixes[b] = i
            for n in range(1, len(b)):
                self.prefixes.setdefault(b[:n], -1)
        self.lookahead = self._lookahead()

    def _lookahead(self) -> int:
        """Longest chain, in bytes, of merges of rising rank in which the right part of each ends in the left part of the one before."""
        size = {i: len(b) for i, b in self.bytes_of.items()}
        reach: dict[int, int] = {}  # longest chain so far whose last merge has this left part
        for (a, b), _ in sorted(self.rank.items(), key=lambda x: x[1]):
            best, token = 0, b
            while True:
                best = max(best, reach.get(token, 0))
                if token not in self.parts:
                    break
                token = self.parts[token][1]
            reach[a] = max(reach.get(a, 0), best + size[a] + (size[b] if not best else 0))
        return max(reach.values(), default=1)

    def encode_directly(self, text: bytes) -> list[int]:
        """Merge by rank, for short strings."""
        tokens = [self.single[b] for b in text]
        while len(tokens) > 1:
            best = min(zip(tokens, tokens[1:]), key=lambda p: self.rank.get(p, 1 << 60))
            if best not in self.rank:
                break
            out, i, whole = [], 0, self.merged[best]
            while i < len(tokens):
                if i + 1 < len(tokens) and (tokens[i], tokens[i + 1]) == best:
                    out.append(whole)
                    i += 2
                else:
                    out.append(tokens[i])
                    i += 1
            tokens = out
        return tokens


class Transducer:
    """Feed bytes, receive tokens as soon as no later byte can change them."""

    def __init__(self, merges: MergeList):
        self.m = merges
        self.pairs: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}

    def is_whole(self, token: int) -> bool:
        """Whether a token's own bytes encode to that token."""
        known = self.whole.get(token)
        if known is None:
            known = self.whole[token] = self.m.encode_directly(self.m.bytes_of[token]) == [token]
        return known

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens may stand side by side: takes apart the younger of both again and again, and asks each time whether
        the two that then meet would have merged before. Of equal merges the left one comes first."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is not None:
            return known
        rank, made, parts = self.m.rank, self.m.made, self.m.parts
        before = 1 << 60
        while True:
            if rank.get((left, right), before) < before:
                known = False
                break
            a, b = made.get(left, -1), made.get(right, -1)
            if a > b:
                before, left = a, parts[left][1]
            elif b >= 0:
                before, right = b + 1, parts[right][0]
            else:
                known = True
                break
        if len(self.pairs) >= 1 << 18:
            self.pairs.clear()
        self.pairs[key] = known
        return known

    def advance(self, text: bytes, last: list[int], start: int, before: int) -> None:
        """Set the last token of every prefix that ends with a token beginning at ``start``."""
        known, single = self.m.prefixes, start + 1
        for end in range(single, len(text) + 1):
            t = known.get(text[start:end])
            if t is None:
                return
            if t >= 0 and last[end] < 0 and (before < 0 or self.fits(before, t)) and self.is_whole(t):
                last[end] = t

    def back(self, last: list[int], at: int) -> list[int]:
        out = []
        while at:
            out.append(last[at])
            at -= self.m.length[last[at]]
        return out[::-1]

    def encode(self, text: bytes) -> list[int]:
        """All tokens of one piece; a long one goes through the stream."""
        t = self.m.prefixes.get(text, -1)
        if t >= 0 and self.is_whole(t):
            return [t]
        if len(text) > 4 * self.m.lookahead:
            return [t for tokens in self.stream([text]) for t in tokens]
        last = [-1] * (len(text) + 1)
        for start in range(len(text)):
            self.advance(text, last, start, last[start])
        return self.back(last, len(text))

    def stream(self, chunks):
        """Lists of stable tokens, as the chunks of a piece come in; the last list completes it."""
        longest, limit = self.m.longest, self.m.lookahead + self.m.longest
        text, last, start, final = b"", [-1], 0, -1  # bytes not emitted, last tokens, next start, token emitted last
        for chunk in chunks:
            for i in range(0, len(chunk), limit):
                text += chunk[i : i + limit]
                last += [-1] * (len(text) + 1 - len(last))
                while start + longest <= len(text):
                    self.advance(text, last, start, last[start] if start else final)
                    start += 1
                stable = self.settled(last, start, longest) if start else 0
                if stable:
                    tokens = self.back(last, stable)
                    final = tokens[-1]
                    text, last, start = text[stable:], [-1, *last[stable + 1 :]], start - stable
                    yield tokens
        while start < len(text):
            self.advance(text, last, start, last[start] if start else final)
            start += 1
        yield self.back(last, len(text))

    def settled(self, last: list[int], start: int, longest: int) -> int:
        """Where the chains of all positions meet at which a token can end that began before ``start``."""
        live = {p for p in range(start, min(start + longest, len(last))) if p and last[p] >= 0}
        while len(live) > 1:
            p = max(live)
            live.remove(p)
            live.add(p - self.m.length[last[p]])
        return min(live.pop() if live else 0, start)


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """The transducer of a merge file; read once by each process."""
    return Transducer(MergeList(path))


class Utf8State:
    """Incremental byte-to-text machine: holds back at most three bytes of an unfinished character. What can never become a
    character turns into U+FFFD, one for each longest part that could have begun one."""

    def __init__(self):
        self.held = b""

    def feed(self, data: bytes, final: bool = False) -> str:
        data = self.held + data
        self.held = b""
        if not final:
            for back in range(1, min(3, len(data)) + 1):
                lead = data[-back]
                if lead >= 0xC0:
                    need = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                    if back < need and self.may_begin(data[-back:]):
                        data, self.held = data[:-back], data[-back:]
                    break
                if lead < 0x80:
                    break
        return data.decode("utf-8", errors="replace")

    @staticmethod
    def may_begin(part: bytes) -> bool:
        try:
            part.decode("utf-8")
        except UnicodeDecodeError as e:
            return e.reason == "unexpected end of data"
        return False


class Decoder:
    """Bytes and text of token ids; ids may come in any number of pieces."""

    def __init__(self, merges: MergeList):
        top = max(merges.bytes_of) + 1
        parts = [merges.bytes_of.get(i, b"") for i in range(top)]
        self.size = np.array([len(p) for p in parts], dtype=np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(parts), dtype=np.uint8)

    def bytes(self, ids: np.ndarray) -> bytes:
        sizes = self.size[ids]
        done = np.cumsum(sizes) - sizes
        return self.data[np.arange(int(sizes.sum())) + np.repeat(self.begin[ids] - done, sizes)].tobytes()

    def text(self, ids: np.ndarray, step: int = 1 << 16) -> str:
        """Text of a document, ``step`` tokens at a time."""
        state, out = Utf8State(), []
        for i in range(0, len(ids), step):
            out.append(state.feed(self.bytes(ids[i : i + step])))
        return "".join([*out, state.feed(b"", final=True)])


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(transducer(path).m)
