"""Token ids of whole texts by a ``tokenizers`` file, with words looked up in arrays.

The tokenizer of the file splits at white space before anything else, so a text's ids are the ids of its words one after the
other; inside a word it takes runs of letters, single digits and runs of signs apart.  A batch of texts is one array of bytes:
segments (letter runs in lower case, digits, sign runs) are found, hashed to 64 bits and looked up without a Python object a
word, and the ids are gathered from one array.  Unknown segments are encoded many at once by the file's own merges, without its normaliser,
which leaves such segments as they are but for the lower case.  Words with an apostrophe, other letters or control
signs are segments of their own and go through the file's complete tokenizer once.  Results equal its ids for the whole text, as
long as no two segments of the corpus share a 64-bit hash while both are known.

What is known takes some 25 bytes a segment.  When it is full, segments not met since the last time go; if these are few, all go.
"""

from __future__ import annotations

import json
import re

import numpy as np
from tokenizers import Tokenizer
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import WhitespaceSplit

CACHE_WORDS = 1_500_000
PARTS_AT_ONCE = 5_000
BYTES_AT_ONCE = 1 << 20

# Control signs that are no white space: texts with them are encoded whole.
_RARE = re.compile(r"[\x00-\x08\x0e-\x1f\x7f-\x9f]")
_OTHER_SPACE = re.compile(r"(?![\t-\r ])\s")

# Bytes with which such signs begin: texts without them need no search.
_CONTROLS = bytes([*range(9), *range(14, 32), 127])
_LEADS = (b"\xc2", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")

_OTHER, _LETTER, _DIGIT, _SIGN, _SPACE = range(5)


def _byte_signs() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    signs = {b: chr(256 + i) for i, b in enumerate(others)}
    del signs[32]  # no word has a space; it separates words here
    return signs


def _kinds() -> np.ndarray:
    kind = np.full(256, _OTHER, dtype=np.uint8)
    for b in range(33, 127):
        kind[b] = _LETTER if chr(b).isalpha() else _DIGIT if chr(b).isdigit() else _SIGN
    kind[ord("'")] = _OTHER
    kind[[*range(9, 14), 32]] = _SPACE
    return kind


class _Known:
    """Sorted hashes with the place of their ids in one array."""

    def __init__(self, width):
        self.keys = np.zeros(0, dtype=np.uint64)
        self.at, self.length = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
        self.met = np.zeros(0, dtype=bool)
        self.ids = np.zeros(0, dtype=width)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of keys, and which of them are known."""
        place = np.searchsorted(self.keys, keys)
        place[place == len(self.keys)] = 0
        known = self.keys[place] == keys if len(self.keys) else np.zeros(len(keys), dtype=bool)
        return place, known

    def add(self, keys: np.ndarray, length: np.ndarray, ids: np.ndarray) -> None:
        at = len(self.ids) + np.cumsum(length) - length
        self._set(np.concatenate([self.keys, keys]), np.concatenate([self.at, at]), np.concatenate([self.length, length]),
                  np.concatenate([self.met, np.ones(len(keys), dtype=bool)]))
        self.ids = np.concatenate([self.ids, ids])

    def _set(self, keys, at, length, met) -> None:
        order = np.argsort(keys, kind="stable")
        self.keys, self.at, self.length, self.met = keys[order], at[order], length[order], met[order]

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of entries one after the other, and how many each has."""
        length = self.length[places]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.at[places] - ends + length, length) + np.arange(total)], length

    def keep_met(self, most: int) -> None:
        kept = np.flatnonzero(self.met)
        if len(kept) > most:
            kept = kept[:0]
        ids, length = self.take(kept)
        keys = self.keys[kept]
        self.__init__(self.ids.dtype)
        self.add(keys, length, ids)
        self.met[:] = False


class WordTokenizer:
    """ids(texts): little-endian unsigned 32-bit ids of each text, as bytes."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        suffix = model["end_of_word_suffix"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.plain = Tokenizer(BPE(model["vocab"], merges, cache_capacity=0, end_of_word_suffix=suffix))
        self.plain.pre_tokenizer = WhitespaceSplit()
        self.ends = np.zeros(max(model["vocab"].values()) + 1, dtype=bool)
        self.ends[[i for token, i in model["vocab"].items() if token.endswith(suffix)]] = True
        self.signs, self.kinds = _byte_signs(), _kinds()
        self.table = np.random.default_rng(17).integers(0, 2**64, (64, 256), dtype=np.uint64)
        width = np.uint16 if self.full.get_vocab_size() <= 1 << 16 else np.uint32
        # Lately learned segments are merged into the many others now and then.
        self.main, self.late = _Known(width), _Known(width)
        self.cache_words = cache_words
        self.learned = 0

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.full.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _parts(self, parts: list[str]) -> list[bytes]:
        """ids of runs of letters or signs."""
        if not parts:
            return []
        spelled = " ".join(parts).lower()
        if not spelled.isascii():
            spelled = spelled.encode().decode("latin-1").translate(self.signs)
        ids = np.asarray(self.plain.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, dtype="<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(parts):
            return [self._whole(p) for p in parts]
        raw, at = ids.tobytes(), [0, *(4 * stops).tolist()]
        return [raw[a:b] for a, b in zip(at, at[1:])]

    def _learn(self, keys: np.ndarray, words: list[str], simple: np.ndarray) -> None:
        """Adds unknown segments to the late ones."""
        self.learned += len(keys)
        ids: list[bytes] = [b""] * len(words)
        plain = np.array([w.isascii() for w in words], dtype=bool)
        for some in (np.flatnonzero(simple & plain), np.flatnonzero(simple & ~plain)):  # the first need no byte signs
            for a in range(0, len(some), PARTS_AT_ONCE):
                part = some[a:a + PARTS_AT_ONCE].tolist()
                for k, found in zip(part, self._parts([words[k] for k in part])):
                    ids[k] = found
        for k in np.flatnonzero(~simple).tolist():
            ids[k] = self._whole(words[k])
        length = np.array([len(i) // 4 for i in ids], dtype=np.int32)
        self.late.add(keys, length, np.frombuffer(b"".join(ids), dtype="<u4").astype(self.late.ids.dtype))

    def _settle(self) -> None:
        """Moves late segments to the main ones, and makes room."""
        if len(self.late.keys) < max(50_000, len(self.main.keys) // 8) and len(self.late.keys) < self.cache_words:
            return
        ids, length = self.late.take(np.arange(len(self.late.keys)))
        met = self.late.met
        self.main.add(self.late.keys, length, ids)
        self.main.met[np.searchsorted(self.main.keys, self.late.keys)] = met
        self.late = _Known(self.main.ids.dtype)
        if len(self.main.keys) > self.cache_words:
            self.main.keep_met(self.cache_words // 2)

    def _segments(self, buffer: np.ndarray):
        """Starts, stops, hashes and simplicity of the segments of some texts' bytes, which end with a space."""
        kind = self.kinds[buffer]
        low = np.where((buffer >= 65) & (buffer <= 90), buffer + 32, buffer)
        lead = np.flatnonzero(buffer[:-1] == 0xC3)
        if len(lead):  # letters of Latin-1 but for the two signs among them
            after = buffer[lead + 1]
            lead = lead[(after >= 0x80) & (after <= 0xBF) & (after != 0x97) & (after != 0xB7)]
            kind[lead] = kind[lead + 1] = _LETTER
            after = buffer[lead + 1]
            low[lead + 1] = np.where(after <= 0x9E, after + 32, after)
        text = kind != _SPACE
        first = text.copy()
        first[1:] &= ~text[:-1]
        words = np.flatnonzero(first)
        if not len(words):
            return words, words, words.astype(np.uint64), words.astype(bool)
        odd = kind == _OTHER
        odd[:-1] |= (buffer[:-1] == 60) & (buffer[1:] == 124)  # the beginning of a special token
        simple = np.add.reduceat(odd, words, dtype=np.int64) == 0
        inside = np.repeat(simple, np.diff(np.append(words, len(buffer))))
        change = np.zeros(len(buffer), dtype=bool)
        change[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        start = first.copy()
        start[words[0]:] |= change[words[0]:] & text[words[0]:] & inside
        starts = np.flatnonzero(start)
        number = np.cumsum(start) - 1
        number[:starts[0]] = 0
        at = np.arange(len(buffer)) - starts[number]
        read = buffer.copy()
        read[words[0]:] = np.where(inside, low[words[0]:], buffer[words[0]:])
        value = self.table[at & 63, read] * ((at >> 6) * 2 + 1).astype(np.uint64)
        value[~text] = 0
        hashes = np.add.reduceat(value, starts)
        length = np.add.reduceat(text, starts, dtype=np.int64)
        easy = inside[starts - words[0]]
        hashes = (hashes ^ (length * 2 + easy).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        return starts, starts + length, hashes, easy

    def _slice_ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """ids of texts that are short together."""
        joined = b" ".join(texts) + b" "
        buffer = np.frombuffer(joined, dtype=np.uint8)
        starts, stops, hashes, simple = self._segments(buffer)
        keys, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        known = self.main.find(keys)[1] | self.late.find(keys)[1]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            self._settle()
            # What is known may have changed.
            fresh = np.flatnonzero(~(self.main.find(keys)[1] | self.late.find(keys)[1]))
            at = first[fresh]
            words = [joined[a:b].decode() for a, b in zip(starts[at].tolist(), stops[at].tolist())]
            self._learn(keys[fresh], words, simple[at])
        length, ids = np.zeros(len(keys), dtype=np.int32), []
        # Both tables' ids in one array, in the order of the different segments.
        for table in (self.main, self.late):
            place, has = table.find(keys)
            table.met[place[has]] = True
            found, n = table.take(place[has])
            length[has] = n
            ids.append((has, found, n))
        offset = np.cumsum(length) - length
        whole = np.zeros(int(length.sum()), dtype=self.main.ids.dtype)
        for has, found, n in ids:
            ends = np.cumsum(n)
            whole[np.repeat(offset[has] - ends + n, n) + np.arange(len(found))] = found
        per = length[which]
        ends = np.cumsum(per)
        total = int(ends[-1]) if len(ends) else 0
        out = whole[np.repeat(offset[which] - ends + per, per) + np.arange(total)].astype("<u4")
        borders = np.cumsum([len(t) + 1 for t in texts])
        upto = np.searchsorted(starts, borders)
        cuts = np.concatenate([[0], ends])[upto]
        return np.split(out, cuts[:-1])

    def forget(self) -> None:
        """Called at the end of a task; what is known serves the worker's next one, as its size is bounded."""

    def ids(self, texts: list[str]) -> list[bytes]:
        out: list[list[bytes]] = [[] for _ in texts]
        some: list[tuple[int, bytes]] = []
        size = 0

        def flush():
            nonlocal size
            for (k, _), ids in zip(some, self._slice_ids([t for _, t in some]) if some else []):
                out[k].append(ids.tobytes())
            some.clear()
            size = 0

        for k, text in enumerate(texts):
            raw = text.encode()
            leads = not text.isascii() and any(c in raw for c in _LEADS)
            if len(raw.translate(None, _CONTROLS)) < len(raw) or leads and _RARE.search(text):
                out[k].append(self._whole(text))
                continue
            if leads and _OTHER_SPACE.search(text):
                raw = " ".join(text.split()).encode()
            while raw:
                part = raw
                if len(raw) > BYTES_AT_ONCE:  # long texts are cut at white space
                    cut = max(raw.rfind(c, 0, BYTES_AT_ONCE) for c in (b" ", b"\n"))
                    if cut <= 0:
                        cut = min([p for p in (raw.find(c, 1) for c in (b" ", b"\n")) if p > 0], default=len(raw))
                    part = raw[:cut]
                raw = raw[len(part):]
                some.append((k, part))
                size += len(part)
                if size >= BYTES_AT_ONCE:
                    flush()
        flush()
        return [b"".join(parts) for parts in out]


_LOADED: dict[str, WordTokenizer] = {}


def load(path: str) -> WordTokenizer:
    """One tokenizer a worker process and path."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]
