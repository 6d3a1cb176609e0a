"""Fast exact encoding with the public tokenizers.

The invented and natural vocabularies alike repeat words heavily, so a task
keeps a bounded word -> ids table and asks the tokenizers library only about
words it has not seen.  The text is cut at places where the library's own
pre-tokenizer always cuts (a single space between two non-space characters, or
any ASCII white space for the vocabulary that drops white space), hence the
ids are those of the whole text.  Texts where such a cut can't be shown to be
safe (white space next to a space) go to the library whole.
"""

from __future__ import annotations

import os

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import re  # noqa: E402
from array import array  # noqa: E402

import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
import pyarrow.compute as pc  # noqa: E402

#: Words kept per worker process (about 160 bytes each).
CACHE_WORDS = 800_000

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PUNCT = "!-&(-/:-@\\[-`{-~"  # ASCII punctuation without the apostrophe (contractions)
#: Words made of these alone are pre-tokenized here; others by the library.
_PLAIN = re.compile(f"[{_LETTERS}0-9{_PUNCT}\n]+")
_BYTE_PIECES = re.compile(f" ?[{_LETTERS}]+| ?[0-9]+| ?[{_PUNCT}]+|\n")
_WORD_PIECES = re.compile(f"[{_LETTERS}]+|[0-9]|[{_PUNCT}]+")


#: Marks a piece that follows the one before without a space.
_GLUE = "\x01"


def cut_more(texts: pa.Array, glue: str) -> pa.Array:
    """Cut before a full stop or comma after a letter, and around a line feed between
    a word and a letter: every pre-tokenizer used here cuts there too, and far fewer
    distinct words remain."""
    apart = pc.replace_substring_regex(texts, "([a-z])([.,])", rf"\1 {glue}\2")
    return pc.replace_substring_regex(apart, "([a-z.,])\n([A-Za-z])", f"\\1 {glue}\n {glue}\\2") if glue else apart


class _NoCut(Exception):
    """White space beside a cut: the text must go to the library whole."""


def byte_chars() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others
    for the code points from 256 on, in byte order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in printable}
    rest = [b for b in range(256) if b not in table]
    table.update({b: chr(256 + i) for i, b in enumerate(rest)})
    return table


_BYTE_CHARS = byte_chars()


def byte_level(piece: str) -> str:
    return piece.encode().decode("latin-1").translate(_BYTE_CHARS)


def _pack(ids) -> bytes:
    a = array("I", ids)
    return a.tobytes()


class _Words(dict):
    """word -> ids (little-endian uint32 bytes); bounded, first seen stay."""

    def __init__(self, make, limit):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, word):
        ids = self.make(word)
        if len(self) < self.limit:
            self[word] = ids
        return ids


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, index: np.ndarray,
           bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of the words ``index`` one after the other, ids of each text).

    Word w has the ids flat[starts[w]:starts[w] + sizes[w]]; bounds cut the words
    into texts.  Done in pieces that stay in the processor's cache."""
    starts, sizes = starts.astype(np.int32), sizes.astype(np.int32)
    sums = np.zeros(index.size + 1, np.int64)
    np.cumsum(sizes[index], out=sums[1:])
    out = np.empty(int(sums[-1]), np.uint32)
    step = 1 << 15
    for lo in range(0, index.size, step):
        words = index[lo:lo + step]
        lengths = sizes[words]
        before = np.cumsum(lengths, dtype=np.int32) - lengths
        a, b = int(sums[lo]), int(sums[min(lo + step, index.size)])
        at = np.repeat(starts[words] - before, lengths)
        at += np.arange(b - a, dtype=np.int32)
        np.take(flat, at, out=out[a:b], mode="clip")
    return out, np.diff(sums[bounds])


class Encoder:
    """Ids of whole texts exactly as ``tokenizers`` gives them
    (``add_special_tokens=False``), as little-endian uint32 bytes."""

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        self.path = path
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.model = self.tok.model
        self.tokenize = self.model.tokenize
        self.specials = tuple(t.content for t in self.tok.get_added_tokens_decoder().values())
        # word-end vocabularies drop white space; byte-level ones keep it
        self.drops_space = bool(self.model.end_of_word_suffix)
        self.inner = _Words(self._piece, limit)
        self.words = _Words(self._spaceless if self.drops_space else self._spaced, limit)
        self.first = _Words(lambda w: self._word(w), limit // 8)

    def _piece(self, piece: str) -> bytes:
        return _pack([t.id for t in self.tokenize(byte_level(piece))])

    def _library(self, text: str) -> bytes:
        return _pack(self.tok.encode(text, add_special_tokens=False).ids)

    def _plain(self, word: str) -> bool:
        return bool(_PLAIN.fullmatch(word)) and "<|" not in word and "\n\n" not in word

    def _spaceless(self, word: str) -> bytes:
        if word.isalpha() and word.isascii():
            return array("I", [t.id for t in self.tokenize(word.lower())]).tobytes()
        if not self._plain(word):
            return self._library(word)
        pieces = _WORD_PIECES.findall(word.lower())
        return b"".join([self._piece(p) if len(p) > 3 else self.inner[p] for p in pieces])

    def _spaced(self, word: str) -> bytes:
        if word.isalpha() and word.isascii():
            return array("I", [t.id for t in self.tokenize(_BYTE_CHARS[32] + word)]).tobytes()
        if not word or word[0].isspace() or word[-1].isspace():
            if word == _GLUE + "\n":
                return self._library("\n")
            raise _NoCut
        return self._word(word[1:] if word[0] == _GLUE else " " + word)

    def _word(self, word: str) -> bytes:
        bare = word[1:] if word[:1] == " " else word
        if not bare or not self._plain(bare) or bare[0] == "\n" or bare[-1] == "\n":
            return self._library(word)
        pieces = _BYTE_PIECES.findall(word)
        # a piece after a space is often a known word itself
        return b"".join([self.words[p[1:]] if p[0] == " " and p != word else self._piece(p) if len(p) > 3 else self.inner[p]
                         for p in pieces])

    def encode_many(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many texts: (all ids, number of ids of each text), each text's
        ids followed by ``end_id`` if given.  Null is an empty text.

        Arrow splits the texts and numbers their distinct words, so the word
        table is asked once for each distinct word and the ids are gathered."""
        texts = pc.fill_null(texts, "")
        if self.drops_space:
            lists = pc.ascii_split_whitespace(cut_more(texts, ""))
        else:
            lists = pc.split_pattern(cut_more(texts, _GLUE), " ")
        bounds = lists.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        coded = lists.flatten().dictionary_encode()
        index = coded.indices.to_numpy().copy()
        words = coded.dictionary.to_pylist()
        if self.drops_space:
            table = list(map(self.words.__getitem__, words))
        else:
            table = []
            unsafe = np.zeros(len(words), bool)
            get = self.words.__getitem__
            for i, word in enumerate(words):
                try:
                    table.append(get(word))
                except _NoCut:
                    table.append(b"")
                    unsafe[i] = True
            # a text's first word has no space before it and may start with white space
            heads = bounds[:-1]
            head_words = index[heads].tolist()
            bad = np.concatenate(([0], np.cumsum(unsafe[index])))
            whole = (bad[bounds[1:]] > bad[heads]) | pc.match_substring(texts, _GLUE).to_numpy(zero_copy_only=False)
            for i, w in enumerate(head_words):
                if whole[i]:
                    index[bounds[i]:bounds[i + 1]] = len(table)
                    table.append(b"")
                    table.append(self._library(texts[i].as_py()))
                    index[bounds[i]] = len(table) - 1
                else:
                    index[bounds[i]] = len(table)
                    table.append(self.first[words[w]])
        if end_id is not None:
            index = np.insert(index, bounds[1:], len(table))
            table.append(_pack([end_id]))
            bounds = bounds + np.arange(bounds.size)
        sizes = np.fromiter(map(len, table), np.int64, len(table)) >> 2
        return gather(np.frombuffer(b"".join(table), "<u4"), np.cumsum(sizes) - sizes, sizes, index, bounds)

    def encode(self, text: str) -> bytes:
        if self.drops_space:
            # bytes.split cuts at ASCII white space only, which the vocabulary always drops
            return b"".join(map(self.words.__getitem__, _ascii_split(text)))
        head, *rest = text.split(" ")
        if not rest:
            return self._library(text)
        if not head or head[-1].isspace():
            return self._library(text)
        try:
            return self.first[head] + b"".join(map(self.words.__getitem__, rest))
        except _NoCut:
            return self._library(text)


_SPACES = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_ASCII_WORDS = re.compile("[^\x20\x09-\x0d]+")


def _ascii_split(text: str) -> list[str]:
    """Words between ASCII white space (str.split also cuts at other spaces)."""
    return _ASCII_WORDS.findall(text) if _SPACES.search(text) else text.split()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, limit: int = CACHE_WORDS) -> Encoder:
    """One encoder per worker process and vocabulary file, of at most ``limit`` words."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, limit)
    return _ENCODERS[path]


def vocabulary(name: str) -> str:
    """Path of an installed public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)
