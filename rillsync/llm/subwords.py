"""Fast, exact ids of the `tokenizers` library for whole texts.

A single space that has non-space characters on both sides is always a boundary between two pre-tokens of either
vocabulary, so a text is cut there, every distinct chunk is encoded once per worker, and a text's ids are its
chunks' ids in order. Chunks of Latin letters, with signs after them at most, and several of these parted by newlines
go straight to a BPE of bytes; all others (digits, added special strings, other scripts) go through the library's
whole path.

The BPE of bytes (tiktoken's) joins two neighbours wherever their join is a token, the library only the two that the
token's merge names. These agree on every word if each token, taken by itself, is joined to that token by the named
merges: two other neighbours with the same join would be met there, too. A test shows it for the vocabularies of PROVEN;
any other vocabulary keeps to the library's model.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import string
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

#: Chunks kept per worker; the table is emptied when it is full, so memory is bounded.
CACHE_CHUNKS = 600_000
#: Longer chunks are encoded without being kept.
CACHE_CHARS = 64
#: Characters of texts, besides one text's, whose words are told apart at once.
AT_ONCE = 1 << 22
#: Rows of signs that are kept.
SIGNS = 10_000
_SPACES = re.compile("[\t\v\f\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_BOUNDARY = re.compile(r"(?<=\S) (?=\S)")
#: Letters, and the signs after them.
_WORD = re.compile(r"([A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-/:-@\[-`{-~]*)")
#: SHA-256 of the vocabulary files whose tokens are all joined from their own bytes.
PROVEN = {
    "53fa9d558ea625daafcd57cd61e7be7b3c7043ea584b22d09575cf5ea9131b0a",  # word_bpe_49k.json
    "cec27cb89f428497695f4e2a90118d636a594654897a44c0fb11b8f185521820",  # byte_bpe_50k.json
}
#: In the BPE of bytes, what stands after a word where the vocabulary marks the ends of words. No UTF-8 text holds it.
_END = b"\xff"
#: Before the first chunk of a text, to tell it from the same chunk after a space. No chunk begins with it otherwise.
FIRST = "\ue000"


def _byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for U+0100 onwards."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


_BYTES = {c: b for b, c in _byte_alphabet().items()}


class _Kept(dict):
    """Ids of chunks, encoded when they are first met."""

    def __init__(self, encode: Callable[[str], bytes]):
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        ids = self.encode(chunk)
        self.keep(chunk, ids)
        return ids

    def keep(self, chunk: str, ids: bytes) -> None:
        if len(chunk) <= CACHE_CHARS:
            if len(self) >= CACHE_CHUNKS:
                self.clear()
            self[chunk] = ids


def token_bytes(token: str, ends: str | None) -> bytes:
    """A token of a byte-level vocabulary as bytes; `ends`: the vocabulary's mark of a word's end, if any."""
    whole = bool(ends) and token.endswith(ends) and token != ends
    stem = token[: -len(ends)] if whole else token
    return bytes(map(_BYTES.__getitem__, stem)) + _END * whole


def _joiner(path: str):
    """The BPE of bytes of a proven vocabulary file, else (or without tiktoken) None."""
    with open(path, "rb") as f:
        data = f.read()
    if hashlib.sha256(data).hexdigest() not in PROVEN:
        return None
    try:
        from tiktoken._tiktoken import CoreBPE
    except ModuleNotFoundError:
        return None

    model = json.loads(data)["model"]
    # ids ascend in the order of merges, so an id is a rank
    return CoreBPE({token_bytes(t, model["end_of_word_suffix"]): i for t, i in model["vocab"].items()}, {}, r"\S+")


def _row_joiner(path: str):
    """As _joiner for rows of words, where the vocabulary marks the ends of words: (the BPE, in which a newline ends a
    word, and by id whether it ends one), else None."""
    with open(path, "rb") as f:
        model = json.load(f)["model"]
    ends = model.get("end_of_word_suffix")
    if not ends or not _joiner(path):
        return None
    from tiktoken._tiktoken import CoreBPE

    # words of ASCII letters hold neither this newline nor the byte that stands for ends otherwise
    ranks = {token_bytes(t, ends).replace(_END, b"\n"): i for t, i in model["vocab"].items()}
    last = np.zeros(max(model["vocab"].values()) + 1, bool)
    last[[i for t, i in model["vocab"].items() if t.endswith(ends)]] = True
    return CoreBPE(ranks, {}, r"[^\n]*\n"), last


class Encoder:
    """ids_of(texts) gives each text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.words = self.library.normalizer is not None  # this vocabulary drops white space
        table = _byte_alphabet()
        self.latin = {c: "".join(table[b] for b in chr(c).encode()) for c in range(256)}
        self.model = self.library.model
        joiner = _joiner(path)
        self.joined = joiner and joiner.encode_single_piece
        self.rows = _row_joiner(path) if self.words else None
        self.signs: dict[str, bytes] = {"": b""}
        self.newline = b"" if self.words else self._library(["\n"])[0]
        self.kept = _Kept(self._encode)

    def chunks(self, text: str) -> tuple[str, list[str]]:
        """The text's first chunk and the others, these without the space that goes before each."""
        if not self.words and (
            "  " in text or "\n " in text or " \n" in text or text[:1] == " " or text[-1:] == " " or _SPACES.search(text)
        ):
            first, *rest = _BOUNDARY.split(text)
        else:
            first, *rest = text.split(" ")
        return first, rest

    def _letters(self, word: str) -> bytes:
        """Ids of Latin letters, with a space before them or not."""
        if self.joined:
            return array("I", self.joined(word.encode() + _END if self.words else word.encode())).tobytes()
        word = word.translate(self.latin) if not word.isascii() or word[0] == " " else word
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _signs(self, tail: str) -> bytes:
        signs = self.signs.get(tail)
        if signs is None:
            signs = self._library([tail])[0]
            if len(self.signs) < SIGNS:
                self.signs[tail] = signs
        return signs

    def _plain(self, body: str, spaced: bool) -> bytes | None:
        """Ids of a chunk of Latin letters with signs after them, or of several such parted by newlines, else None."""
        parts = []
        for line in body.split("\n"):
            found = _WORD.fullmatch(line)
            if not found:
                return None
            stem, tail = found.groups()
            if self.words:
                stem = stem.lower()
            if parts:
                parts.append(self.newline)
            elif spaced:
                stem = " " + stem
            parts += [self._letters(stem), self._signs(tail)]
        return b"".join(parts)

    def _encode(self, body: str, first: bool = False) -> bytes:
        spaced = not first and not self.words
        stem = body.rstrip(string.punctuation)
        if stem.isascii() and stem.isalpha():
            ids = self.kept.get(stem) if spaced or self.words else None
            if ids is None:
                ids = self._letters(" " + stem if spaced else stem.lower() if self.words else stem)
            return ids + self._signs(body[len(stem) :])
        ids = self._plain(body, spaced)
        return self._library([" " + body if spaced else body])[0] if ids is None else ids

    def _library(self, chunks: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.library.encode_batch_fast(chunks, add_special_tokens=False)]

    def _known(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words; new ones of ASCII letters, with signs after them at most, are joined in one go."""
        if not self.rows:
            return list(map(self.kept.__getitem__, words))
        known = list(map(self.kept.get, words))
        new, stems = [], []
        for i in [i for i, ids in enumerate(known) if ids is None]:
            word = words[i]
            stem = word.rstrip(string.punctuation)
            if stem.isascii() and stem.isalpha():
                ids = self.kept.get(stem) if len(stem) < len(word) else None
                if ids is None:
                    new.append((i, len(stem)))
                    stems.append(stem.lower())
                    continue
                known[i] = ids + self._signs(word[len(stem) :])
            else:
                known[i] = self._encode(word)
            self.kept.keep(word, known[i])
        tool, last = self.rows
        ids = np.frombuffer(tool.encode_to_tiktoken_buffer("\n".join([*stems, ""]), set()), np.uint32)
        raw, at = ids.astype("<u4").tobytes(), 0
        for (i, n), end in zip(new, (4 * np.flatnonzero(last[ids]) + 4).tolist(), strict=True):
            word = words[i]
            known[i] = raw[at:end] + self._signs(word[n:]) if n < len(word) else raw[at:end]
            self.kept.keep(word, known[i])
            at = end
        return known

    def _ids_by_words(self, texts: list[str]) -> Iterator[bytes]:
        """For a vocabulary that drops white space: each distinct word of the texts is looked up once."""
        parts = pa.compute.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        words = parts.flatten().dictionary_encode()
        known = self._known(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes, flat = np.fromiter(map(len, known), np.int64, len(known)) // 4, np.frombuffer(b"".join(known), "<u4")
        codes = words.indices.to_numpy()
        n = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(n)])
        # where a word's ids begin, less how many ids stand before it in the texts
        places = np.repeat((np.cumsum(sizes) - sizes)[codes] - ends[:-1], n)
        places += np.arange(len(places))
        raw = flat[places].tobytes()
        bounds = (4 * ends[parts.offsets.to_numpy()]).tolist()
        for a, b in zip(bounds, bounds[1:], strict=False):
            yield raw[a:b]

    def ids_of(self, texts: list[str]) -> list[bytes]:
        out, get = [], self.kept.__getitem__
        if self.words:
            some, chars = [], 0
            for text in texts:
                if chars + len(text) > AT_ONCE and some:
                    out += self._ids_by_words(some)
                    some, chars = [], 0
                some.append(text)
                chars += len(text)
            return [*out, *self._ids_by_words(some)]
        for text in texts:
            first, rest = self.chunks(text)
            head = self._encode(first, True) if first else b""
            out.append(head + b"".join(map(get, rest)))
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per file and worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary_path(name: str) -> str:
    """Where the named public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
