"""Encoding whole texts with a public tokenizer, remembering the ids of pieces.

A text is cut where the tokenizer's own pre-tokenisation cuts it in any context,
so the ids of the pieces, joined, are the ids of the text.  The library encodes
each new piece once per worker; texts that cannot be cut safely, and those that hold the string of
an added token (which the library gives one id wherever it stands), are encoded whole.

Texts are cut many at a time, as bytes: Arrow finds the distinct pieces, and each of them is looked up once.
Words of plain letters, which the normaliser and pre-tokeniser leave as they are but for case, go to the
library's model without them.  Vocabularies other than the two kinds known here take the library's whole way.
"""

from __future__ import annotations

import json
import re
from unicodedata import normalize

import numpy as np
import pyarrow as pa

# white space beyond single blanks and line ends: how a run of it splits depends on what follows
_ODD = ["  ", " \n", "\n ", "\n\n", "\x00", *map(chr, [9, 11, 12, 13, 28, 29, 30, 31, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288])]
# pieces that can be encoded as parts of one text: no white space but a leading blank, no separator
_PLAIN = re.compile(r" ?[^\s\x01]+")
# ASCII marks that end a word; the pre-tokenisers part them from the letters before them
_MARKS = ".,;:!?#*$%&|<>()"
# what byte-wise cutting knows of a vocabulary: its normaliser, and how it parts words
_LOWERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_PARTS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# small letters below the combining marks; each is one in every version of Unicode since 5.0
_LETTERS = re.compile("[a-z\xdf-\xf6\xf8-\u024f]+")
# those and capital ones, after the blank that byte-level vocabularies keep before a word
_WORD = re.compile(" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]+")
# classes of bytes: 1 between words, 2 a mark, 0 others
_CLASSES = bytes(1 if c in b" \n" else 2 if chr(c) in _MARKS else 0 for c in range(256))
_COMBINING = 0xCC  # the least first byte of a character that can join the one before it
_CACHES: dict[str, "PieceEncoder"] = {}


class PieceEncoder:
    """ids of texts as little-endian arrays (2 bytes an id where the vocabulary allows).

    ``limit`` bounds the pieces remembered in a worker; when it is reached they are forgotten.
    """

    def __init__(self, path: str, limit: int = 1_500_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tok = Tokenizer.from_file(path)
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.added = [t for t in added if t]
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.limit, self.known = limit, {"": b""}
        # byte-level BPE keeps white space; the word vocabulary drops it
        self.drops_space = not self._ids(" \n")
        # a string that is one id of its own between two pieces
        self.between = " \x01 " if self.drops_space else "\n"
        self.mark = self._ids(self.between)[0]
        spec = json.loads(self.tok.to_str())
        parts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        lowers = (spec["normalizer"] or {}).get("normalizers") == _LOWERS and parts[0].get("pattern") == {"Regex": _PARTS}
        lowers = lowers and [x.get("type") for x in parts] == ["Split", "ByteLevel"] and not parts[1]["add_prefix_space"]
        plain = dict(spec["pre_tokenizer"] or {}, trim_offsets=True) == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self.by_bytes = self.drops_space and lowers or not self.drops_space and spec["normalizer"] is None and plain
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.blank = spell(" ")[0][0]
        self.spelling = {c: spell(chr(c))[0][0] for c in range(0x80, 0x250) if _WORD.fullmatch(chr(c))}

    def forget(self) -> None:
        """Forget all pieces."""
        self.known = {"": b""}

    def _ids(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def _learn_words(self, pieces: set[str]) -> set[str]:
        """Ids of new words of plain letters; the pieces that are none are left."""
        if self.drops_space:
            words = [(p, low) for p in pieces if _LETTERS.fullmatch(low := p.lower())]
        else:
            words = [(p, p) for p in pieces if _WORD.fullmatch(p)]
        tokenize, spelling = self.tok.model.tokenize, self.spelling
        for lo in range(0, len(words), 4096):
            part, ids, ends = words[lo : lo + 4096], [], []
            for _, word in part:
                spelled = word if word.isascii() else word.translate(spelling)
                ids += [t.id for t in tokenize(spelled.replace(" ", self.blank))]
                ends.append(len(ids))
            raw, size, start = np.array(ids, self.dtype).tobytes(), self.dtype.itemsize, 0
            for (p, _), end in zip(part, ends):
                self.known[p] = raw[start : end * size]
                start = end * size
        return pieces.difference([p for p, _ in words])

    def _learn(self, pieces: set[str]) -> None:
        """Ids of new pieces: a word and the marks after it apart, new words some thousands a call."""
        known, ending = self.known, []
        whole = {p for p in pieces if self._added_in(p)}
        for p in pieces - whole:
            core = p.rstrip(_MARKS)
            # as the normaliser may make it: it can end in a mark of its own, which goes with those after it
            if core != p and normalize("NFC", core.removeprefix(" ")).lower().isalpha():
                ending.append((p, core, p[len(core) :]))
        wanted = pieces.difference([p for p, _, _ in ending]).union(x for _, *two in ending for x in two if x not in known)
        plain = [p for p in wanted - whole if _PLAIN.fullmatch(p)]
        for lo in range(0, len(plain), 4096):
            part = plain[lo : lo + 4096]
            ids = np.array(self._ids(self.between.join(part)), self.dtype)
            ends = np.append(np.flatnonzero(ids == self.mark), len(ids))
            if len(ends) != len(part):  # the mark is an id of some piece, too
                continue
            raw, size, start = ids.tobytes(), ids.itemsize, 0
            for p, end in zip(part, (ends * size).tolist()):
                known[p] = raw[start:end]
                start = end + size
        for p in wanted:
            if p not in known:
                known[p] = np.array(self._ids(p), self.dtype).tobytes()
        for p, core, marks in ending:
            known[p] = known[core] + known[marks]

    def _added_in(self, text: str) -> bool:
        return any(t in text for t in self.added)

    def _cut(self, text: str) -> list[str]:
        if self._added_in(text):
            return [text]
        if self.drops_space:
            return text.replace("\n", " ").split(" ")
        if any(x in text for x in _ODD):
            return [text]
        return text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text (None: empty) as the bytes of an array of ``self.dtype``."""
        if len(self.known) > self.limit:
            self.forget()
        if self.by_bytes and texts:
            return self._encode_bytes([(t or "").encode() for t in texts])
        out = []
        for text in texts:
            pieces = self._cut(text or "")
            try:
                out.append(b"".join(map(self.known.__getitem__, pieces)))
            except KeyError:
                out.append(pieces)
        late = [i for i, x in enumerate(out) if type(x) is list]
        new = set().union(*(out[i] for i in late)).difference(self.known)
        self._learn(new)
        for i in late:
            out[i] = b"".join(map(self.known.__getitem__, out[i]))
        for p in new:
            if len(p) > 200:  # whole texts are not worth remembering
                del self.known[p]
        return out

    def _encode_bytes(self, texts: list[bytes]) -> list[bytes]:
        """``encode`` by bytes: cut at blanks and line ends (which go, or a blank stays before its word), and between a letter and the mark after it."""
        join, whole = b"\n" if self.drops_space else b"", {}
        raw = join.join(texts)
        # a vocabulary that lower-cases could see an added token where the text has none
        fold = bytes.lower if self.drops_space else bytes
        odd = [fold(x.encode()) for x in (self.added if self.drops_space else self.added + _ODD)]
        if any(x in fold(raw) for x in odd):
            found = {t for t in texts if any(x in fold(t) for x in odd)}
            found = {t: np.array(self._ids(t.decode()), self.dtype).tobytes() for t in found}
            whole = {i: found[t] for i, t in enumerate(texts) if t in found}
            texts = [b"" if i in whole else t for i, t in enumerate(texts)]
            raw = join.join(texts)
        raw = self._lowered(raw) if self.drops_space else raw
        kinds, at = np.frombuffer(raw.translate(_CLASSES), np.uint8), np.frombuffer(raw, np.uint8)
        gaps, marks = np.flatnonzero(kinds == 1), np.flatnonzero(kinds == 2)
        last, first = at[marks - 1], at[marks - 2]  # of a text's first bytes these are any others: no harm in a cut there
        sign = (first == 0xC3) & ((last == 0x97) | (last == 0xB7)) | (first == 0xC4) & (last == 0xB0)  # two signs; a letter that lower-cases to two characters
        letter = ((last | 32) >= 97) & ((last | 32) <= 122) | (first >= 0xC3) & (first <= 0xC8) & ~sign
        cuts, stops = [gaps, marks[letter & (marks > 1)]], np.cumsum([len(t) + len(join) for t in texts]) - len(join)
        if self.drops_space:
            cuts = np.sort(np.concatenate(cuts))
            is_gap = kinds[cuts] == 1
            ends = np.append(cuts - (np.cumsum(is_gap) - is_gap), len(raw) - len(gaps))
            raw = raw.translate(None, b" \n")
        else:
            cuts = ends = np.unique(np.concatenate([*cuts, gaps[at[gaps] == 10] + 1, stops]))
        pieces = pa.Array.from_buffers(pa.string(), len(ends), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(raw)])
        coded = pieces.dictionary_encode()
        own = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = set(own).difference(self.known)
        self._learn(self._learn_words(new))
        ids = pa.array(list(map(self.known.__getitem__, own)), pa.binary()).take(coded.indices)
        for p in new:
            if len(p) > 200:
                del self.known[p]
        # a text's last piece ends where the text does
        stops = np.searchsorted(cuts, stops) + 1
        _, places, data = ids.buffers()
        stops = np.append(0, np.frombuffer(places, np.int32)[stops]).tolist()
        data = memoryview(data) if data else b""
        return [whole[i] if i in whole else bytes(data[stops[i] : stops[i + 1]]) for i in range(len(texts))]

    def _lowered(self, raw: bytes) -> bytes:
        """``raw`` with A-Z lower-cased but where a combining mark may follow: composed letters can lower-case otherwise."""
        b = np.frombuffer(raw, np.uint8)
        if not len(b) or b.max() < _COMBINING:
            return raw.lower()
        upper = (b >= 65) & (b <= 90)
        upper[:-1] &= b[1:] < _COMBINING
        return (b + (upper.view(np.uint8) << 5)).tobytes()


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a vocabulary file; kept between the tasks of a worker."""
    if path not in _CACHES:
        _CACHES[path] = PieceEncoder(path)
    return _CACHES[path]


def slices(texts: list, chars: int = 1 << 20):
    """Consecutive (lo, hi) ranges of about ``chars`` characters."""
    lo = n = 0
    for i, t in enumerate(texts):
        n += len(t or "")
        if n >= chars:
            yield lo, i + 1
            lo, n = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)
