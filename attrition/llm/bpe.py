"""Words of a byte-level BPE tokenizer file with word ends, and their encoding.

Reads a ``tokenizers`` JSON file (lower-casing NFC normaliser, word pattern,
byte-level alphabet, ``</w>`` word ends).  Nothing is trained here.
"""

from __future__ import annotations

import gc
import json
import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from attrition.llm.words import give_back, split_words, utf8

#: Fixed values of the tokenizer family: white space, letters and numbers below U+0180.
_SPACE = "\t-\r \x85\xa0"
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_WORD = re.compile(f"[{_LETTER}]+|[{_NUMBER}]|'(?:s|t|re|ve|m|ll|d)|[^{_SPACE}{_LETTER}{_NUMBER}]+")
#: Text whose lower case stays below U+0180 needs no library call to be split.
_PLAIN = re.compile("[^\x00-\u012f\u0131-\u017f]")


def byte_alphabet() -> dict[int, str]:
    """Byte → character: printable bytes stand for themselves, the others for the
    characters from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in shown}
    for b in range(256):
        table.setdefault(b, chr(256 + len(table) - len(shown)))
    return table


class WordBpe:
    """Splits texts into the words that the tokenizer merges within."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.alphabet = byte_alphabet()
        self.strings = {i: t for t, i in self.vocab.items()}
        self._fits: dict[int, bool] = {}

    def pieces(self, word: str) -> list[str]:
        """Normalised pieces of a text without ASCII white space; an added token of
        the file is a piece of its own.  Characters beyond U+017F go through the
        library's own normaliser and splitter, whose pieces come in the byte
        alphabet, marked by a leading NUL (two for an added token)."""
        if word.isalpha() and word.isascii():
            return [word.lower()]
        out: list[str] = []
        for i, part in enumerate(self._added.split(word) if self._added and "<|" in word else [word]):
            if i % 2:
                out.append("\x00\x00" + part)
            elif "\x00" in part or _PLAIN.search(part):
                out.extend("\x00" + w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part)))
            else:
                out.extend(_WORD.findall(unicodedata.normalize("NFC", part).lower()))
        return out

    def spelled(self, word: str) -> str:
        """A word in the byte alphabet."""
        if word[0] == "\x00":
            return word[1:]
        if word.isascii() and word.isprintable():
            return word
        return "".join(self.alphabet[b] for b in word.encode())

    def merged(self, symbols: list[str]) -> list[str]:
        """Plain BPE: merge the best-ranked pair, leftmost first, until none is left."""
        while len(symbols) > 1:
            best = min(range(len(symbols) - 1), key=lambda i: self.ranks.get((symbols[i], symbols[i + 1]), len(self.ranks)))
            if (symbols[best], symbols[best + 1]) not in self.ranks:
                break
            symbols = [*symbols[:best], symbols[best] + symbols[best + 1], *symbols[best + 2:]]
        return symbols

    def symbols(self, token: str) -> list[str]:
        """A token's single-character symbols; the word end stays on the last one."""
        if token.endswith(self.end) and len(token) > len(self.end):
            body = token[:-len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def fits(self, left: str, right: str) -> bool:
        """Whether BPE of the two tokens' symbols gives exactly the two tokens back
        (``left`` empty: whether the token's own symbols merge into it)."""
        if not left:
            return self.merged(self.symbols(right)) == [right]
        return self.merged([*self.symbols(left), *self.symbols(right)]) == [left, right]

    def encode_trie(self, spelled: list[str]) -> dict[str, list[int]]:
        """Token ids of each distinct word.

        The words' trie is walked depth first (its order is the sorted order; the
        stack is the path from the root).  The state of a prefix is the last token
        of its encoding: the one vocabulary entry that ends the prefix and fits the
        state it leaves behind.  A prefix shared by many words gets its state once.
        """
        vocab, strings, fitting, end = self.vocab, self.strings, self._fits, self.end
        if len(fitting) > 2_000_000:
            fitting.clear()
        out: dict[str, list[int]] = {}
        state, back = [-1], [0]     # of the first i symbols: last token, where it starts
        before = ""

        for word in sorted(spelled):
            n = len(word)
            shared, most = 0, min(n - 1, len(before), len(state) - 1)
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del state[shared + 1:], back[shared + 1:]
            suffix = ""
            for i in range(shared + 1, n + 1):
                if i == n:
                    suffix = end
                j = i - 1
                while True:
                    token = vocab.get(word[j:i] + suffix)
                    if token is not None:
                        key = (state[j] << 20) + token
                        ok = fitting.get(key)
                        if ok is None:
                            ok = fitting[key] = self.fits(strings[state[j]] if j else "", strings[token])
                        if ok:
                            break
                    if not j:
                        raise ValueError(f"no token ends {word[:i]!r}")
                    j -= 1
                state.append(token)
                back.append(j)
            ids, at = [state.pop()], back.pop()
            while at:
                ids.append(state[at])
                at = back[at]
            ids.reverse()
            out[word] = ids
            before = word
        return out


@dataclass
class Vocabulary:
    """Distinct white-space words of a list of texts; word i of the texts is
    ``words[index[i]]``, text d holds ``first[d]:first[d + 1]``."""

    words: list[str]
    index: np.ndarray
    first: np.ndarray


def vocabulary(column: pa.Array) -> Vocabulary:
    """ASCII white space never lies inside a piece of the tokenizer, so a text's
    encoding is that of its words, one after the other."""
    w = split_words(column)
    _, at, index = np.unique(w.hash, return_index=True, return_inverse=True)
    data = w.data.tobytes()
    return Vocabulary([data[a:b].decode() for a, b in zip(w.start[at].tolist(), w.end[at].tolist())], index, w.first)


def spread(values: list[bytes], index: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``values[index]`` joined, and where each text's part begins."""
    size = np.fromiter(map(len, values), np.int64, len(values))
    start = np.cumsum(size) - size
    n = size[index]
    ends = np.cumsum(n)
    source = np.frombuffer(b"".join(values), np.uint8)
    kind = np.int32 if len(index) == 0 or ends[-1] < 1 << 31 and len(source) < 1 << 31 else np.int64
    place = np.repeat((start[index] - (ends - n)).astype(kind), n)
    place += np.arange(len(place), dtype=kind)
    return source[place], np.concatenate([[0], ends])[first]


class WordMemo:
    """Values of words in two generations of at most ``size`` (plus one slice's)
    words each: words still in use move to the young one, the rest is forgotten."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def values(self, words: list[str], make) -> list:
        """``make(missing words)`` gives a dict of their values.  Nothing here makes
        reference cycles, so the collector stays off meanwhile."""
        on = gc.isenabled()
        gc.disable()
        try:
            return self._values(words, make)
        finally:
            if on:
                gc.enable()

    def _values(self, words: list[str], make) -> list:
        young, missing = self.young, []
        for w in words:
            if w not in young:
                got = self.old.get(w)
                if got is None:
                    missing.append(w)
                else:
                    young[w] = got
        young.update(make(missing))
        out = [young[w] for w in words]
        if len(young) > self.size:
            self.old, self.young = young, {}
        return out


def merged(batches, text: str, size: int):
    """Arrow batches put together until their texts take about ``size`` bytes: the
    more documents share a vocabulary, the fewer words are encoded again."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += int(utf8(batch.column(text))[1][-1])
        if n >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def slices(column: pa.Array, size: int = 2 << 20):
    """``(from, number)`` of rows whose texts take about ``size`` bytes together."""
    offsets = utf8(column)[1]
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, hi - lo
        give_back()
        lo = hi


def forget(*kept: dict) -> None:
    """Drop a task's tokenizer state at its end; an idle worker holds none."""
    for one in (*kept, _loaded):
        one.clear()
    gc.collect()
    give_back()


_loaded: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """One tokenizer a process while a task needs it."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]
