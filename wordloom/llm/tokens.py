"""Token ids of whole texts, for use inside tasks.

A byte-level vocabulary cuts a text into words, numbers, marks and white space
before it merges anything, so a text is the sequence of these pieces as far as ids
go. Texts are cut there as arrays of bytes. Most pieces of a corpus occur over and
over; each worker keeps the ids of the pieces it has met, up to a limit, and asks
the tokenizer for the others only.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa

from wordloom.llm.scratch import resident

#: Bytes of pieces and ids that a worker keeps, and what an entry costs beyond them.
KEPT_BYTES, _ENTRY_BYTES = 192 << 20, 180
#: Longest piece that is kept, in bytes; longer ones are encoded each time they occur.
KEPT_LENGTH = 64
#: Bytes of text that are looked up together before the tokenizer is asked, one for so many kept bytes.
_WINDOW, _WINDOW_SHARE = 4 << 20, 48
#: New pieces that are given to the tokenizer as one text.
_JOINED = 1024
#: Bytes whose places are found at once, and bytes around them that decide on these.
_STEP, _MARGIN = 1 << 18, 4

#: A piece that has the same ids between line ends. Characters that not all agree to be white are left out.
_REGULAR = re.compile(r" ?[^\s\u180e\u200b\ufeff]+")

# Kinds of characters. Others are visible, but may be letters, digits or marks; odd ones may be anything.
_ODD, _OTHER, _LETTER, _DIGIT, _MARK, _BLANK, _WHITE = range(7)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Kinds by byte for ASCII, and by the first two bytes of longer characters.

    Letters are those that every version of Unicode knows: of ASCII, and U+00C0 to
    U+023F, which take two bytes each, without the two signs among them.
    """
    single = np.full(256, _ODD, np.uint8)
    single[0x21:0x7F] = _MARK
    single[0x30:0x3A] = _DIGIT
    single[0x41:0x5B] = single[0x61:0x7B] = _LETTER
    single[0x20] = _BLANK
    single[[0x09, 0x0A, 0x0D]] = _WHITE
    double = np.full((256, 256), _OTHER, np.uint8)
    double[0xC3:0xC9] = _LETTER
    # Both signs, and where white or invisible characters are.
    for first, second in ((0xC3, (0x97, 0xB7)), (0xC2, (0x85, 0xA0)), (0xE1, (0x9A, 0xA0)), (0xE2, (0x80, 0x81)), (0xE3, 0x80), (0xEF, 0xBB)):
        double[first, second] = _ODD
    return single, double


_SINGLE, _DOUBLE = _tables()


def _kinds(data: np.ndarray) -> np.ndarray:
    """The kind of the character that begins at each byte; bytes inside one are of its kind or odd."""
    kinds = _SINGLE[data]
    leads = np.flatnonzero(data[:-1] >= 0xC2)
    if len(leads):
        told = _DOUBLE[data[leads], data[leads + 1]]
        kinds[leads] = told
        kinds[leads[told == _LETTER] + 1] = _LETTER
    return kinds


def _cut_before(data: np.ndarray) -> np.ndarray:
    """For each byte of UTF-8 text, whether a piece surely begins there.

    Letters, digits and marks are cut from each other, but not letters from an
    apostrophe before them. White space is cut from what is visible before it. The
    last white character before a visible one is by itself, or with that one if it
    is a blank. Nothing else is cut; each piece has the ids it has in the text.
    """
    kinds = _kinds(data)
    out = np.zeros(len(data), bool)
    if len(data) < 2:
        return out
    before, here = kinds[:-1], kinds[1:]
    white, visible, known = kinds >= _BLANK, (kinds >= _OTHER) & (kinds <= _MARK), (kinds >= _LETTER) & (kinds <= _MARK)
    found = (before != here) & known[:-1] & known[1:] & ((data[:-1] != 0x27) | (here != _LETTER))
    found |= visible[:-1] & white[1:]
    # The last of several white characters, or a blank behind anything.
    found[:-1] |= visible[2:] & ((here[:-1] == _BLANK) | (white[1:-1] & white[:-2]))
    # Behind a white character that is no blank, if there surely is a cut before it.
    found[1:] |= (before[1:] == _WHITE) & visible[2:] & (visible[:-2] | white[:-2])
    out[1:] = found
    return out


def cuts(data: np.ndarray) -> np.ndarray:
    """For each byte of UTF-8 text, whether a byte-level vocabulary surely cuts the text before it."""
    out = np.empty(len(data), bool)
    for at in range(0, len(data), _STEP):
        first = max(0, at - _MARGIN)
        out[at : at + _STEP] = _cut_before(data[first : at + _STEP + _MARGIN])[at - first :][:_STEP]
    return out


class Encoder:
    """Encodes with a vocabulary file of the tokenizers library, without special tokens.

    The strings of special tokens are ordinary text. A null text has no ids.
    """

    def __init__(self, path: str, kept_bytes: int = KEPT_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        before = self._tokenizer.pre_tokenizer
        first = json.loads(before.__getstate__()) if before is not None else {}
        self._by_word = (
            self._tokenizer.normalizer is None
            and first.get("type") == "ByteLevel"
            and first.get("use_regex", True)
            and not first.get("add_prefix_space", True)
        )
        vocabulary = self._tokenizer.get_vocab()
        size = self._tokenizer.get_vocab_size()
        #: Width of an id in the bytes this class returns.
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        # How a byte-level vocabulary writes a blank and a line end.
        self._opens, self._ends = np.zeros((2, max(vocabulary.values(), default=0) + 1), bool)
        self._opens[[number for token, number in vocabulary.items() if token.startswith("\u0120")]] = True
        self._ends[[number for token, number in vocabulary.items() if token == "\u010a"]] = True
        self._kept_bytes = kept_bytes
        self._window = max(1 << 18, min(_WINDOW, kept_bytes // _WINDOW_SHARE))
        self._words: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}
        self._held = 0

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, self.dtype).tobytes() for one in found]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of regular pieces with a blank before each, many at a time.

        They hold no other blank, so the ids that begin with one tell where they begin.
        """
        return self._encode_joined(words, " ", self._opens, 0)

    def _encode_lines(self, pieces: list[str]) -> list[bytes]:
        """The ids of regular pieces without a blank before them, with a line end before each meanwhile."""
        return self._encode_joined(pieces, "\n", self._ends, 1)

    def _encode_joined(self, pieces: list[str], before: str, begins: np.ndarray, skipped: int) -> list[bytes]:
        out: list[bytes] = []
        width = self.dtype.itemsize
        for first in range(0, len(pieces), _JOINED):
            part = pieces[first : first + _JOINED]
            (found,) = self._tokenizer.encode_batch_fast([before + before.join(part)], add_special_tokens=False)
            ids = np.array(found.ids, self.dtype)
            starts = np.flatnonzero(begins[ids])
            if len(starts) == len(part) and not starts[0]:
                packed = ids.tobytes()
                cuts = [*(starts * width).tolist(), len(packed)]
                out += [packed[at + skipped * width : end] for at, end in zip(cuts, cuts[1:])]
            else:
                out += self._encode(part if skipped else [before + piece for piece in part])
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, packed as little-endian numbers of ``dtype``."""
        texts = [text or "" for text in texts]
        if not self._by_word:
            return self._encode(texts)
        held = pa.array(texts, pa.large_string())
        bounds = np.frombuffer(held.buffers()[1], np.int64, len(texts) + 1)
        text = held.buffers()[2] or pa.py_buffer(b"")
        data = np.frombuffer(text, np.uint8, bounds[-1])
        packed, ends, at = [], [0] * len(bounds), 0
        done = written = 0
        while at < len(data):
            places, stop = self._window_of(data, bounds, at)
            ids = self._encode_pieces(text, places)
            offsets = np.frombuffer(ids.buffers()[1], np.int64, len(places))
            here = int(np.searchsorted(bounds, stop, side="right"))
            ends[done:here] = (written + offsets[np.searchsorted(places, bounds[done:here])]).tolist()
            packed.append(memoryview(ids.buffers()[2] or b"")[: offsets[-1]])
            done, written, at = here, written + int(offsets[-1]), stop
        whole = memoryview(b"".join(packed))
        return [bytes(whole[start:end]) for start, end in zip(ends, ends[1:])]

    def _window_of(self, data: np.ndarray, bounds: np.ndarray, at: int) -> tuple[np.ndarray, int]:
        """Where the pieces of a part of the texts begin, and where the last of them ends."""
        window = self._window
        while True:
            stop = min(len(data), at + window)
            before = max(0, at - _MARGIN)
            found = np.append(cuts(data[before : stop + _MARGIN])[at - before : stop - before], stop == len(data))
            inside = bounds[np.searchsorted(bounds, at, side="right") : np.searchsorted(bounds, stop, side="right")] - at
            # White space at the end of a text has nothing visible behind it, whatever comes next.
            ends = inside[inside > 1] + at
            kept = np.isin(_SINGLE[data[ends - 2]], (_LETTER, _DIGIT, _MARK))
            found[ends[(_SINGLE[data[ends - 1]] >= _BLANK) & ~kept] - at - 1] = False
            found[inside] = True
            found[0] = True
            places = np.flatnonzero(found) + at
            if len(places) > 1:
                return places, int(places[-1])
            window *= 2

    def _encode_pieces(self, text: pa.Buffer, places: np.ndarray) -> pa.Array:
        """The ids of the pieces between the places, each different one looked up once."""
        pieces = pa.Array.from_buffers(pa.large_binary(), len(places) - 1, [None, pa.py_buffer(places), text])
        told = pieces.dictionary_encode()
        distinct = told.dictionary
        offsets = np.frombuffer(distinct.buffers()[1], np.int64, len(distinct) + 1).tolist()
        data = distinct.buffers()[2].to_pybytes()
        found = self._look_up([data[at:end] for at, end in zip(offsets, offsets[1:])])
        return pa.array(found, pa.large_binary()).take(told.indices)

    def _look_up(self, words: list[bytes]) -> list[bytes]:
        """The ids of different pieces, from memory or from the tokenizer.

        Once half of the memory is full, what is kept becomes the older half and
        the older one is let go. Pieces that still occur come back from there, so
        that what is kept follows the texts. Long pieces are never kept.
        """
        found = list(map(self._words.get, words))
        gaps = [at for at, ids in enumerate(found) if ids is None]
        if not gaps:
            return found
        lost = [words[at] for at in gaps]
        met = self._recalled(lost)
        met |= self._learned([word for word in lost if word not in met])
        for at, word in zip(gaps, lost):
            found[at] = met[word]
        if max(map(len, met)) > KEPT_LENGTH:
            met = {word: ids for word, ids in met.items() if len(word) <= KEPT_LENGTH}
        self._words.update(met)
        self._held += sum(map(len, met)) + sum(map(len, met.values())) + _ENTRY_BYTES * len(met)
        if self._held > self._kept_bytes // 2:
            self._older, self._words, self._held = self._words, {}, 0
        return found

    def _learned(self, new: list[bytes]) -> dict[bytes, bytes]:
        """The ids of pieces that are not in memory."""
        texts = [word.decode() for word in new]
        regular = [(text[0] == " ") + 1 if _REGULAR.fullmatch(text) else 0 for text in texts]
        alone, ended, opened = ([text for text, kind in zip(texts, regular) if kind == one] for one in range(3))
        words = self._encode_words([text[1:] for text in opened])
        ids = iter(self._encode(alone)), iter(self._encode_lines(ended)), iter(words)
        return {word: next(ids[kind]) for word, kind in zip(new, regular)}

    def _recalled(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """What the older half of the memory holds of these pieces."""
        return {word: self._older[word] for word in words if word in self._older}


def encoder(path: str, kept_bytes: int = KEPT_BYTES) -> Encoder:
    """The encoder of a worker process."""
    return resident(("encoder", path, kept_bytes), lambda: Encoder(path, kept_bytes))
