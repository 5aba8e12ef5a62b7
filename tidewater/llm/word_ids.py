"""Token ids of many texts with the tokenizers library, each distinct word part encoded once.

A tokenizer that drops white space and marks word ends encodes the parts its pattern cuts a text into one by one. For texts of
Latin characters the parts follow from the bytes alone: numpy finds where they begin for all texts of a slice at once, Arrow numbers the
distinct ones, and only parts that the worker hasn't met go to the library, many in one string, whose ids fall apart again at the
word-end marks. A word with any other character goes to the library whole, as do the texts of any other tokenizer.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_HELD = 400_000  # parts a worker keeps (about 80 MB)
JOINED, CALLED = 128, 256  # parts in one string, strings in one call of the library

# fixed values: the settings for which words and parts are independent, and their end mark
WORD_SETTINGS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
WORD_END = "</w>"
# the same for a string of lower-cased parts in NFC, with a blank between them
PART_SETTINGS = {
    "normalizer": None, "truncation": None, "padding": None,
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"String": " "}, "behavior": "Removed", "invert": False}, WORD_SETTINGS["pre_tokenizer"]["pretokenizers"][1]]},
}
BLANKS = b" \t\n\x0b\x0c\r"

# classes of the characters below U+0180 (all in NFC, all but the dotted capital I lower-cased in place): blanks, letters, digits, others
BLANK, LETTER, DIGIT, OTHER, ODD = range(5)


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Class by byte of an ASCII character, and by (lead byte - 0xC2, second byte - 0x80) of a two-byte one."""
    one, two = np.full(256, ODD, dtype=np.uint8), np.full((4, 64), ODD, dtype=np.uint8)
    for code in [*range(0x80), *range(0xA1, 0x130), *range(0x131, 0x180)]:
        c = chr(code)
        kind = BLANK if code < 128 and code in BLANKS else LETTER if c.isalpha() else DIGIT if c.isnumeric() else OTHER
        if code < 128:
            one[code] = kind
        else:
            two[(code >> 6) - 2, code & 63] = kind
    return one, two


ONE_BYTE, TWO_BYTES = _classes()
# a part of such characters that the tokenizer's pattern takes as one
_RANGE = {kind: "".join(f"\\x{{{c:x}}}" for c in range(0x180) if (ONE_BYTE[c] if c < 128 else TWO_BYTES[(c >> 6) - 2, c & 63] if c > 0xA0 else ODD) == kind)
          for kind in (LETTER, DIGIT, OTHER)}
LATIN_PART = rf"\A(?:'(?:[sStTmMdD]|[rR][eE]|[vV][eE]|[lL][lL])|[{_RANGE[LETTER]}]+|[{_RANGE[DIGIT]}]|[{_RANGE[OTHER]}]+)\z"


def part_starts(data: np.ndarray, text_starts: np.ndarray, specials: list[bytes]) -> np.ndarray:
    """Where parts begin in the UTF-8 bytes of texts that lie one after the other (blanks belong to the part before them). A word that holds
    an odd character or the beginning of a special token is one part."""
    size = len(data)
    kind = ONE_BYTE[data]
    lead = np.flatnonzero((data >= 0xC2) & (data <= 0xC5))
    second = np.zeros(size, dtype=bool)
    if len(lead):
        kind[lead] = kind[lead + 1] = TWO_BYTES[data[lead] - 0xC2, data[lead + 1] & 63]
        second[lead + 1] = True
    first = np.zeros(size + 4, dtype=bool)  # of a text; the end counts as one
    first[text_starts] = True
    first[size:] = True
    start = np.empty(size, dtype=bool)
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    start &= ~second
    start |= first[:size]
    for i in np.flatnonzero((data == 39) & start):  # 's 't 'm 'd 're 've 'll, where the apostrophe begins a part
        if first[i + 1]:
            continue
        tail = bytes(data[i + 1 : i + 3] | 0x20)
        n = 1 if tail[:1] in (b"s", b"t", b"m", b"d") else 2 if tail in (b"re", b"ve", b"ll") and not first[i + 2] else 0
        if n and (kind[i + 1 : i + 1 + n] == LETTER).all():
            start[i + 1] = False
            if i + 1 + n < size:
                start[i + 1 + n] = True
    odd = kind == ODD
    for s in specials:
        odd[:-1] |= (data[:-1] == s[0]) & (data[1:] == s[min(1, len(s) - 1)])
    blank = kind == BLANK
    if odd.any():
        word = np.flatnonzero(np.append(True, blank[:-1] & ~blank[1:]) | first[:size])
        whole = np.logical_or.reduceat(odd, word)
        inside = np.repeat(whole, np.diff(np.append(word, size)))
        inside[word] = False
        start &= ~inside
    return np.flatnonzero(start & (~blank | first[:size]))


class WordIds:
    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks of an executor share its cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = 2 if max(vocabulary.values(), default=0) < 1 << 16 else 4  # bytes an id takes
        told = json.loads(definition)
        model, self.specials = told["model"], [t["content"].encode() for t in told.get("added_tokens", [])]
        self.by_part = (all(told.get(k) == v for k, v in WORD_SETTINGS.items()) and model.get("end_of_word_suffix") == WORD_END and not model.get("dropout")
                        and not any(s.split() != [s] or t["lstrip"] or t["rstrip"] for s, t in zip(self.specials, told.get("added_tokens", []))))
        self.joined = Tokenizer.from_str(json.dumps(told | PART_SETTINGS)) if self.by_part else self.tokenizer
        self.is_end = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.is_end[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.parts: dict[bytes, bytes] = {}

    @property
    def kind(self) -> str:
        return f"<u{self.width}"

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, parts: list[bytes]) -> None:
        """Ids of parts, without the blanks at their ends and, for Latin ones, in lower case."""
        bare = pc.utf8_trim(pa.array(parts, pa.large_binary()).cast(pa.large_string()), BLANKS.decode())
        low = pc.utf8_lower(bare)
        latin = pc.match_substring_regex(bare, LATIN_PART)
        for s in self.specials:
            for form in (bare, low):
                latin = pc.and_(latin, pc.invert(pc.match_substring(form, s.decode())))
        names = pc.if_else(latin, low, bare).dictionary_encode()
        single = pc.unique(low.filter(latin)).to_numpy(zero_copy_only=False).tolist()
        found = {"": b""}
        strings = [" ".join(single[i : i + JOINED]) for i in range(0, len(single), JOINED)]
        called = (e for i in range(0, len(strings), CALLED) for e in self.joined.encode_batch_fast(strings[i : i + CALLED], add_special_tokens=False))
        for k, encoded in enumerate(called):
            ids, some = np.array(encoded.ids, dtype=self.kind), single[k * JOINED : (k + 1) * JOINED]
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):
                data, cuts = ids.tobytes(), (ends * self.width).tolist()
                found.update(zip(some, map(data.__getitem__, map(slice, [0, *cuts], cuts)), strict=True))
        distinct = names.dictionary.to_numpy(zero_copy_only=False).tolist()
        rest = [n for n in distinct if n not in found]
        found.update(zip(rest, self._whole(rest), strict=True))
        own = list(map(found.__getitem__, distinct))
        self.parts.update(zip(parts, map(own.__getitem__, names.indices.to_numpy().tolist()), strict=True))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (no nulls) one after the other, and how many each text has."""
        if not len(texts):
            return np.empty(0, dtype=self.kind), np.empty(0, dtype=np.int64)
        if not self.by_part:
            each = self._whole(texts.to_pylist())
            return np.frombuffer(b"".join(each), dtype=self.kind), np.array([len(e) // self.width for e in each], dtype=np.int64)
        _, offsets, data = pa.concat_arrays([texts.cast(pa.large_binary())]).buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64)[: len(texts) + 1]
        data = np.frombuffer(data or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        if not len(data):
            return np.empty(0, dtype=self.kind), np.zeros(len(texts), dtype=np.int64)
        filled = offsets[:-1][np.diff(offsets) > 0]
        starts = part_starts(data, filled, self.specials)
        bounds = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
        spots = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, bounds, pa.py_buffer(data)]).dictionary_encode()
        distinct = spots.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.parts) > MAX_HELD:
            self.parts = {}
        ids = list(map(self.parts.get, distinct))
        new = [p for p, known in zip(distinct, ids, strict=True) if known is None]
        if new:
            self._learn(new)
            ids = list(map(self.parts.__getitem__, distinct))
        flat = np.frombuffer(b"".join(ids), dtype=self.kind)
        size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // self.width
        begin = np.cumsum(size) - size
        at = spots.indices.to_numpy()
        each = size[at]
        ends = np.concatenate(([0], np.cumsum(each)))
        taken = flat[np.repeat(begin[at] - ends[:-1], each) + np.arange(ends[-1])]
        return taken, np.diff(ends[np.searchsorted(starts, offsets)])


class SharedWordIds:
    """A tokenizer definition to broadcast. A worker process keeps a broadcast's object between its tasks, and so the parts that it knows."""

    def __init__(self, definition: str):
        self.definition, self._made = definition, None

    def get(self) -> WordIds:
        if self._made is None:
            self._made = WordIds(self.definition)
        return self._made
