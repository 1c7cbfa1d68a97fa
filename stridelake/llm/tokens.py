"""Token ids of texts with a public tokenizer file, word by word.

The tokenizer's own pre-tokenizer never joins text across ASCII white space, so
the ids of a text are those of its white-space-separated words in a row.  Each
distinct word of a slice of texts is looked up once, and goes through the
`tokenizers` library once per worker (a bounded memory of words); the ids of the
texts are then gathered by numpy, with no Python object for each word.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa

#: The vocabulary used where no path is given; a file of the tokenizers library with ids below 65,536.
DEFAULT = "word_bpe_49k.json"


def tokenizer_path(path: str | None = None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(DEFAULT)


#: What DEFAULT does to a text before its model; words of the letters a to z come through unchanged.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_LETTER_RUNS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": _LETTER_RUNS}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}

_TOKENIZERS: dict[str | None, "WordTokenizer"] = {}


def worker_tokenizer(path: str | None = None) -> "WordTokenizer":
    """The tokenizer of this Python worker: its words stay known from task to task."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def forget() -> None:
    """Drop the words that this Python worker's tokenizers know, when the encoding is over and other steps use the worker."""
    for tokenizer in _TOKENIZERS.values():
        tokenizer.forget()


class WordTokenizer:
    """Ids of whole texts.  At most 2 x ``remember`` words are kept: those of the last two generations."""

    def __init__(self, path: str | None = None, remember: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        tokenizer = Tokenizer.from_file(tokenizer_path(path))
        self._encode = self._encode_ascii = self._encode_latin = tokenizer.encode_batch_fast
        form = json.loads(tokenizer.to_str())
        if (form["normalizer"], form["pre_tokenizer"], form["post_processor"]) == (_NORMALIZER, _PRE_TOKENIZER, None):
            # Both leave words of a to z as they are: only the model has work to do on them.
            # Of the lower-case letters of Latin-1, which NFC keeps, they name the bytes.
            bare, latin = Tokenizer(tokenizer.model), Tokenizer(tokenizer.model)
            bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            latin.pre_tokenizer = pre_tokenizers.Sequence([bare.pre_tokenizer, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            self._encode_ascii, self._encode_latin = bare.encode_batch_fast, latin.encode_batch_fast
        vocabulary = tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self._ends = np.zeros(self.size, bool)  # ids that end a word
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._remember = remember
        self.forget()

    def forget(self) -> None:
        self._known: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, without special tokens; null is empty."""
        words, counts = _words(texts)
        if len(self._known) > self._remember:
            self._older, self._known = self._known, {}
        known, older = self._known, self._older
        coded = words.dictionary_encode()  # each distinct word is looked up once
        distinct = _bytes(coded.dictionary)
        found = list(map(known.get, distinct))
        gaps, missing = _gaps(found), []
        for at in gaps:
            if (ids := older.get(word := distinct[at])) is None:
                missing.append(word)
            else:
                known[word] = ids
        self._learn(missing)
        for at in gaps:
            found[at] = known[distinct[at]]
        ids, sizes = np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4
        codes = coded.indices.to_numpy()
        n = sizes[codes]
        ends = np.r_[0, np.cumsum(n)]
        places = np.repeat((np.cumsum(sizes) - sizes)[codes] - ends[:-1], n)
        places += np.arange(len(places))
        data, bounds = ids[places].tobytes(), (4 * ends[counts]).tolist()
        return [data[a:b] for a, b in zip([0, *bounds], bounds)]

    def _learn(self, words: list[bytes], together: int = 100) -> None:
        """Encode words; those of letters only are one token sequence each, so many go through in one text.

        Symbols after letters are a token sequence of their own, so such a word is two that are known or learned.
        """
        ended, single = [], []
        for word in words:
            if not word.isalpha() and (two := _ENDED.fullmatch(word)):
                ended.append((word, *two.groups()))
            else:
                single.append(word)
        for part in {part for _, *two in ended for part in two}.difference(single):
            if part not in self._known:
                if (ids := self._older.get(part)) is not None:
                    self._known[part] = ids
                else:
                    single.append(part)
        plain, latin, other, rest = [], [], [], []
        for word in single:
            if word.isalpha() and word.islower():  # of bytes: a to z
                plain.append(word)
            elif _LATIN.fullmatch(word):
                latin.append(word)
            else:
                (other if word.decode().isalpha() else rest).append(word)
        for encode, found in ((self._encode_ascii, plain), (self._encode_latin, latin), (self._encode, other)):
            rest += self._learn_together(encode, [found[a : a + together] for a in range(0, len(found), together)])
        for word, found in zip(rest, self._encode([word.decode() for word in rest], add_special_tokens=False)):
            self._known[word] = np.array(found.ids, "<u4").tobytes()
        for word, head, tail in ended:
            self._known[word] = self._known[head] + self._known[tail]

    def _learn_together(self, encode, parts: list[list[bytes]]) -> list[bytes]:
        """Encode each part as one text; the words of parts that cannot be told apart by their ends."""
        unclear = []
        for part, found in zip(parts, encode([b" ".join(p).decode() for p in parts], add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            ends = (4 * np.flatnonzero(self._ends[ids]) + 4).tolist()
            if len(ends) != len(part):
                unclear += part
                continue
            data = ids.tobytes()
            self._known.update(zip(part, [data[a:b] for a, b in zip([0, *ends], ends)]))
        return unclear


def _gaps(found: list[bytes | None]) -> list[int]:
    """Places of None."""
    out, at = [], -1
    try:
        while True:
            at = found.index(None, at + 1)
            out.append(at)
    except ValueError:
        return out


def _bytes(words: pa.Array) -> list[bytes]:
    """`to_pylist` of a binary array without nulls, without an object for each value."""
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int32, len(words) + 1, 4 * words.offset).tolist()
    held = data.to_pybytes() if data else b""
    return [held[a:b] for a, b in zip(ends, ends[1:])]


# Lower-case letters of Latin-1: a to z, U+00DF to U+00FF but the division sign.
_LATIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
# Letters, then symbols (an apostrophe may begin a token of its own with letters).
_ENDED = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([!-&(-/:-@\[-`{-~]+)")


def _members(chosen: Iterable[int]) -> bytes:
    """A table of all bytes: 1 for those chosen, else 0."""
    chosen = set(chosen)
    return bytes(b in chosen for b in range(256))


_SPACES = b" \t\n\v\f\r"
_IS_SPACE, _IS_MARK = _members(_SPACES), _members(b".,")
_A_TO_Z = np.frombuffer(_members(range(0x61, 0x7B)), bool)
# What follows the byte C3 in letters of Latin-1, and in capital ones.
_LETTER = np.frombuffer(_members({*range(0x80, 0xC0)} - {0x97, 0xB7}), bool)
_CAPITAL = np.frombuffer(_members({*range(0x80, 0x9F)} - {0x97}), bool)


def _words(texts: list[bytes | None]) -> tuple[pa.Array, np.ndarray]:
    """White-space-separated words of all texts in a row, and how many there are up to the end of each text.

    Where it changes no id, words are in lower case (of Latin-1) and parted from a closing
    point or comma.  The tokenizer composes characters before it lowers them, and special
    tokens are case-sensitive: texts with combining marks or ``<|`` are left as they are.
    """
    texts = [t or b"" for t in texts]
    as_is = np.array([b"<|" in t or b"\xcc" in t or b"\xcd" in t for t in texts], bool)
    joined = b"\n".join([*(t if left else t.lower() for t, left in zip(texts, as_is)), b""])
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)

    def changing(places: np.ndarray) -> np.ndarray:
        return places[~as_is[np.searchsorted(ends, places, side="right")]] if as_is.any() else places

    data = np.frombuffer(bytearray(joined), np.uint8)
    second = np.flatnonzero(data == 0xC3) + 1
    data[changing(second[_CAPITAL[data[second]]])] += 0x20
    space = np.frombuffer(joined.translate(_IS_SPACE), bool)
    first = ~space
    first[1:] &= space[:-1]
    marks = np.flatnonzero(np.frombuffer(joined.translate(_IS_MARK), bool))
    marks = marks[space[marks + 1]]  # the last byte is a line end
    before = data[marks - 1]
    first[changing(marks[_A_TO_Z[before] | (_LETTER[before] & (data[marks - 2] == 0xC3))])] = True
    starts, held = np.flatnonzero(first), data.tobytes().translate(None, _SPACES)
    offsets = np.empty(len(starts) + 1, np.int32)
    offsets[:-1] = starts - np.cumsum(space, dtype=np.int32)[starts]
    offsets[-1] = len(held)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(held)])
    return words, np.searchsorted(starts, ends)
