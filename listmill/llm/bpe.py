"""Byte-level BPE by backtracking.

A vocabulary whose ids follow the order of its merges has one exact encoding of a word: the only
sequence of tokens in which each neighbouring pair is compatible, that is, in which plain merging of the
pair's bytes would give back just that pair. The encoder takes the longest token at each place (found by an
Aho-Corasick automaton), keeps it if it is compatible with the token before, else tries that token's next
shorter prefix token, and steps back over a token when none is left. Each place is left for good at most
once, so the work is linear in the word. Decoding gathers from one byte blob by an offset table.

Defined results: null text is the empty text (no tokens); special tokens inside a text are one id each, as
the tokenizers library has it; repeated rows stay; an empty table gives an empty table; extra columns of the
input are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import common

#: Fixed value: the split that byte-level vocabularies of this family are made for.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words kept with their ids in each Python worker, and the longest word so kept.
CACHE_WORDS, CACHE_CHARS = 400_000, 48


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else the next free one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(spare)) for b in range(256)]


def latin1_split() -> re.Pattern:
    """PRETOKEN with its classes spelled out for text below U+0100, which the plainer engine reads twice as fast."""
    spelt = lambda kind: "".join(re.escape(chr(i)) for i in range(256) if unicodedata.category(chr(i))[0] == kind)
    letters, numbers, spaces = spelt("L"), spelt("N"), r"\t-\r \x85\xa0"
    return re.compile(PRETOKEN.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]").replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]").replace(r"\S", f"[^{spaces}]").replace(r"\s", f"[{spaces}]"))


class Codec:
    """Tables of one vocabulary, from the text of its tokenizers JSON file."""

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        model, to_byte = spec["model"], {c: b for b, c in enumerate(byte_letters())}
        raw = lambda token: bytes(to_byte[c] for c in token)
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.tokens[i] = raw(token)
        for token, i in self.special.items():
            self.tokens[i] = token.encode()
        self.left, self.right, self.pairs = list(range(size)), list(range(size)), {}
        last = -1
        for merge in model["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            i = vocab[a + b]
            if i <= last:
                raise ValueError("ids must follow the order of the merges")
            last = i
            self.left[i], self.right[i] = vocab[a], vocab[b]
            self.pairs[vocab[a], vocab[b]] = i
        self.byte_ids = [vocab[c] for c in byte_letters()]
        self.lengths = [len(t) for t in self.tokens]
        lengths = np.array(self.lengths, np.int64)
        self.blob = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        # words of the automaton are bytes read as Latin-1
        self.automaton = ahocorasick.Automaton()
        known = {self.tokens[i]: i for i in vocab.values()}
        for token, i in known.items():
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.shorter = [-1] * size  # the longest token that is a proper prefix
        for token, i in known.items():
            for n in range(len(token) - 1, 0, -1):
                if (j := known.get(token[:n])) is not None:
                    self.shorter[i] = j
                    break
        self.compatible: dict[tuple[int, int], bool] = {}
        self.split, self.split_latin1 = regex.compile(PRETOKEN), latin1_split()
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.cache: dict[str, bytes] = {}

    def fits(self, a: int, b: int) -> bool:
        """Would merging the bytes of a and b leave just the tokens a and b? Undoes merges from the latest on and looks for one that would cross the border before."""
        if (found := self.compatible.get((a, b))) is not None:
            return found
        x, y, limit, pairs, ok = a, b, 1 << 60, self.pairs, True
        while True:
            if (crossing := pairs.get((x, y))) is not None and crossing < limit:
                ok = False
                break
            if x > y:
                limit, x = x, self.right[x]
                if x == limit:
                    limit, y = y + 1, self.left[y]
                    if y + 1 == limit:
                        break
            else:
                limit, y = y + 1, self.left[y]
                if y + 1 == limit:
                    limit, x = x, self.right[x]
                    if x == limit:
                        break
        if len(self.compatible) > 2_000_000:
            self.compatible.clear()
        self.compatible[a, b] = ok
        return ok

    def word(self, raw: bytes) -> list[int]:
        """The ids of one word, the whole of which merges may cross."""
        n = len(raw)
        longest = [self.byte_ids[b] for b in raw]
        size = [1] * n
        lengths = self.lengths
        for end, i in self.automaton.iter(raw.decode("latin-1")):
            m = lengths[i]
            if m > size[end - m + 1]:
                size[end - m + 1], longest[end - m + 1] = m, i
        out: list[int] = []
        open_at, at = bytearray(b"\1") * (n + 1), 0
        fits, shorter = self.fits, self.shorter
        token = longest[0] if n else -1
        while at < n:
            end = at + lengths[token]
            if open_at[end] and (not out or fits(out[-1], token)):
                out.append(token)
                at = end
                if at < n:
                    token = longest[at]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:  # nothing fits here
                open_at[at] = 0
                token = out.pop()
                at -= lengths[token]
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.specials is not None and any(s in text for s in self.special):
            return b"".join(self.special[x].to_bytes(4, "little") if x in self.special else self._plain(x) for x in self.specials.split(text) if x)
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        cache, out = self.cache, []
        add, get = out.append, cache.get
        try:
            text.encode("latin-1")
            split = self.split_latin1
        except UnicodeEncodeError:
            split = self.split
        for w in split.findall(text):
            found = get(w)
            if found is None:
                found = np.array(self.word(w.encode()), "<u4").tobytes()
                if len(w) <= CACHE_CHARS:
                    if len(cache) >= CACHE_WORDS:
                        cache.clear()
                    cache[w] = found
            add(found)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The bytes of the decoded text; broken UTF-8 becomes U+FFFD."""
        i = np.frombuffer(ids, "<u4")
        parts = []
        for k in range(0, len(i), 1 << 16):
            j = i[k : k + (1 << 16)].astype(np.int64)
            start, size = self.offsets[j], self.offsets[j + 1] - self.offsets[j]
            before = np.cumsum(size) - size
            parts.append(self.blob[np.repeat(start - before, size) + np.arange(int(size.sum()))].tobytes())
        return b"".join(parts).decode("utf-8", "replace").encode()


@lru_cache(maxsize=2)
def codec(vocabulary: str) -> Codec:
    return Codec(vocabulary)


def with_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids (array of int) and decoded text of every document; vocabulary: the text of the tokenizers JSON file (a few MB, whatever the corpus)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def each(batch):
        c = codec(shared.value)
        for i, text in zip(batch.column(0), batch.column(1), strict=True):
            ids = c.encode(text.as_py().decode("utf-8", "replace"))
            yield pa.record_batch({"doc_id": pa.array([i.as_py()], pa.int64()), "ids": pa.array([np.frombuffer(ids, "<u4").astype(np.int32)], pa.list_(pa.int32())), "decoded": [c.decode(ids).decode()]})

    return common.mapped(common.docs_of(docs), each, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """What op4 returns: doc_id, n_tokens, ids_sha256, decoded_sha256. The ids themselves need not leave the worker."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def each(batch):
        c, rows = codec(shared.value), []
        for text in batch.column(1):
            ids = c.encode(text.as_py().decode("utf-8", "replace"))
            rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(c.decode(ids)).hexdigest()))
        n, a, b = zip(*rows, strict=True)
        yield pa.record_batch({"doc_id": batch.column(0).cast(pa.int64()), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": a, "decoded_sha256": b})

    return common.mapped(common.docs_of(docs), each, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
