"""SentencePiece encoding and decoding with the tokenizers library, checked against sentencepiece itself.

The model file is a protobuf; its pieces, scores, kinds and normaliser settings are read from the wire format, and the
same tokenizer is set up: normaliser, space marker, unigram scores (or merges in score order for a BPE model) and byte
fallback. No piece of such a model holds a marker behind another character, so a text falls into words that
encode and decode by themselves; numpy finds the words of all texts of a slice, Arrow numbers the distinct ones, and a task encodes and decodes
each once, many in one string and in batches on several threads, and puts the texts together from them. Every distinct word is also encoded by sentencepiece, and
the two must agree.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import slices

MARKER = "▁"
# fixed values of the model format: piece kinds, model kinds
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
MAX_WORDS = 500_000  # distinct words a task keeps
JOINED = 128  # words in one string


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message: whole numbers for varints, bytes for everything else."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at : at + size]
        at += size


@dataclass
class SentencePieceModel:
    """What the file says. pieces: (text, score, kind) by id."""

    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze_spaces: bool = True
    escape_spaces: bool = True
    pieces: list[tuple[str, float, int]] = field(default_factory=list)

    @classmethod
    def parse(cls, data: bytes) -> SentencePieceModel:
        out = cls()
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                score = float(np.frombuffer(piece[2], dtype="<f4")[0]) if 2 in piece else 0.0
                out.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
                out.kind, out.byte_fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
            elif number == 3:
                norm = dict(_fields(value))
                out.charsmap = norm.get(2, b"")
                out.dummy_prefix, out.squeeze_spaces, out.escape_spaces = (bool(norm.get(k, 1)) for k in (3, 4, 5))
        if out.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        return out

    @property
    def splits_at_markers(self) -> bool:
        return self.dummy_prefix and self.escape_spaces and not any(MARKER in p.lstrip(MARKER) for p, _, k in self.pieces if k in (NORMAL, USER_DEFINED))

    @property
    def joins_words(self) -> bool:
        """Whether a string of several words gives the ids of each: merges never cross a marker, and each word's first piece begins with it."""
        kinds = {k for _, _, k in self.pieces}
        return self.splits_at_markers and self.kind == BPE and USER_DEFINED not in kinds and any(p == MARKER and k == NORMAL for p, _, k in self.pieces)

    def normalizer(self):
        from tokenizers import Regex, normalizers

        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.squeeze_spaces:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(MARKER if self.escape_spaces else " "))
        if self.escape_spaces:
            steps.append(normalizers.Replace(" ", MARKER))
        return normalizers.Sequence(steps)

    def tokenizer(self):
        """Encodes and decodes normalised words; the marker becomes a space again, bytes become characters."""
        from tokenizers import Tokenizer, decoders, models

        unknown = next(i for i, (_, _, k) in enumerate(self.pieces) if k == UNKNOWN)
        if self.kind == UNIGRAM:
            model = models.Unigram([(p, s) for p, s, _ in self.pieces], unk_id=unknown, byte_fallback=self.byte_fallback)
        else:
            usable = {p: i for i, (p, _, k) in enumerate(self.pieces) if k in (NORMAL, USER_DEFINED, UNUSED)}
            merges = []
            for p, i in usable.items():
                for cut in range(1, len(p)):
                    left, right = p[:cut], p[cut:]
                    if left in usable and right in usable:
                        merges.append((-self.pieces[i][1], i, usable[left], left, right))
            vocabulary = {p: i for i, (p, _, _) in enumerate(self.pieces)}
            model = models.BPE(vocab=vocabulary, merges=[m[3:] for m in sorted(merges)], unk_token=self.pieces[unknown][0], fuse_unk=True, byte_fallback=self.byte_fallback)
        out = Tokenizer(model)
        out.decoder = decoders.Sequence([decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse()])
        return out


class Codec:
    """Encodes and decodes texts through the distinct words of its task, and checks each against sentencepiece."""

    def __init__(self, data: bytes, threads: int):
        os.environ["RAYON_NUM_THREADS"], os.environ["TOKENIZERS_PARALLELISM"] = str(threads), "true"
        import sentencepiece

        self.model, self.threads = SentencePieceModel.parse(data), threads
        self.normalizer, self.tokenizer = self.model.normalizer(), self.model.tokenizer()
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.by_word, self.joins = self.model.splits_at_markers, self.model.joins_words
        self.begins = np.array([p.startswith(MARKER) for p, _, _ in self.model.pieces], dtype=bool)  # a word, in a string of several
        self._forget()

    def _forget(self) -> None:
        self.words: dict[bytes, int] = {}  # a word with spaces for its markers
        self.flat = np.empty(0, dtype=np.int32)  # ids of all words, one after the other
        self.sizes = np.empty(0, dtype=np.int64)
        self.agrees = np.empty(0, dtype=bool)
        self.decoded: dict[int, str] = {}  # of words that decode to something else

    def _single(self, words: list[bytes]) -> None:
        """Learn words one by one."""
        texts = [w.decode() for w in words]
        normal = [t.replace(" ", MARKER) for t in texts] if self.by_word else texts
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(normal, add_special_tokens=False)]
        spaced = [(w[1:] if self.model.dummy_prefix else w).replace(MARKER, " ") for w in normal]
        theirs = self.reference.encode(spaced, num_threads=self.threads)
        if MARKER in normal:  # by itself only at the end of a text; sentencepiece gives an empty text no marker
            theirs[normal.index(MARKER)] = [self.reference.piece_to_id(MARKER)]
        decoded = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        first = len(self.words)
        self.decoded |= {first + k: d for k, (d, n) in enumerate(zip(decoded, normal, strict=True)) if d != n.replace(MARKER, " ")}
        self._add(words, np.array([i for x in ids for i in x], dtype=np.int32), list(map(len, ids)), [x == y for x, y in zip(ids, theirs, strict=True)])

    def _add(self, words: list[bytes], ids: np.ndarray, sizes: list[int] | np.ndarray, agrees: list[bool]) -> None:
        self.words.update(zip(words, range(len(self.words), len(self.words) + len(words)), strict=True))
        self.flat = np.concatenate((self.flat, ids))
        self.sizes = np.concatenate((self.sizes, np.asarray(sizes, dtype=np.int64)))
        self.agrees = np.concatenate((self.agrees, np.asarray(agrees, dtype=bool)))

    def _learn(self, words: list[bytes]) -> None:
        """Learn new words, many in one string where no merge crosses a marker: its ids fall apart again before those that begin with one. A string on which the
        libraries differ, or that doesn't decode to itself, is learnt word by word."""
        plain = [w for w in words if len(w) > 1 and w[1] != 32] if self.joins else []  # one marker and more
        parts = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
        strings = [b"".join(p).decode() for p in parts]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast([t.replace(" ", MARKER) for t in strings], add_special_tokens=False)]
        theirs = self.reference.encode([t[1:] for t in strings], num_threads=self.threads)
        decoded = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        known, arrays, sizes = [], [np.empty(0, dtype=np.int32)], [np.empty(0, dtype=np.int64)]
        for part, text, own, other, back in zip(parts, strings, ids, theirs, decoded, strict=True):
            flat = np.array(own, dtype=np.int32)
            starts = np.flatnonzero(self.begins[flat])
            if own == other and back == text and len(starts) == len(part):
                known += part
                arrays.append(flat)
                sizes.append(np.diff(starts, append=len(flat)))
        self._add(known, np.concatenate(arrays), np.concatenate(sizes), [True] * len(known))
        rest = [w for w in words if w not in self.words] if len(known) < len(words) else []
        if rest:
            self._single(rest)

    def run(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str], list[bool], list[bool]]:
        """All ids one after the other and, per text: how many, the decoded text, whether that is the normalised text
        again, whether both libraries agree."""
        if len(self.words) > MAX_WORDS:
            self._forget()
        lead = 1 if self.model.dummy_prefix else 0
        normal = [self._normal(t) for t in texts]
        _, offsets, data = pa.array([t.encode() for t in normal], pa.large_binary()).buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64)[: len(texts) + 1]
        data = np.frombuffer(data or b"", dtype=np.uint8)[: offsets[-1]]
        first = np.zeros(len(data), dtype=bool)  # of a word: spaces and what follows them
        if self.by_word:
            blank = data == 32
            first[1:] = blank[1:] & ~blank[:-1]
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(first)
        bounds = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
        spots = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, bounds, pa.py_buffer(data)]).dictionary_encode()
        distinct = spots.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [w for w in distinct if w not in self.words]
        if new:
            self._learn(new)
        known = np.fromiter(map(self.words.__getitem__, distinct), dtype=np.int64, count=len(distinct))
        word = known[spots.indices.to_numpy()]
        each = self.sizes[word]
        ends = np.concatenate(([0], np.cumsum(each)))
        begin = (np.cumsum(self.sizes) - self.sizes)[word]
        ids = self.flat[np.repeat(begin - ends[:-1], each) + np.arange(ends[-1])]
        cuts = np.searchsorted(starts, offsets)
        some = lambda bad: np.diff(np.concatenate(([0], np.cumsum(bad[word])))[cuts]) > 0
        decoded = [t[lead:] if self.by_word else t.replace(MARKER, " ")[lead:] for t in normal]  # of texts all of whose words decode to themselves
        same, other = [True] * len(texts), np.zeros(len(self.words), dtype=bool)
        if self.decoded:
            other[list(self.decoded)] = True
            spoken = dict(zip(known.tolist(), distinct, strict=True))
            speak = lambda k: self.decoded[k] if k in self.decoded else spoken[k].decode().replace(MARKER, " ")
            for i in np.flatnonzero(some(other)):
                text = "".join(map(speak, word[cuts[i] : cuts[i + 1]].tolist()))[lead:]
                same[i], decoded[i] = text == decoded[i], text
        return ids, np.diff(ends[cuts]), decoded, same, (~some(~self.agrees)).tolist()

    def _normal(self, text: str) -> str:
        """The normalised text; if it falls into words, with spaces for its markers."""
        m = self.model
        if m.charsmap or m.squeeze_spaces or not (m.dummy_prefix and m.escape_spaces):
            text = self.normalizer.normalize_str(text)
        elif text:
            text = MARKER + text.replace(" ", MARKER)  # the same, without leaving Python
        return text.replace(MARKER, " ") if self.by_word else text


def sentencepiece_codec(docs: DataFrame, model_file: str, keep: list[str], text_col: str = "text", threads: int = 2) -> DataFrame:
    """The columns in ``keep`` and ``ids`` (array of int), ``n_tokens``, ``decoded``, ``round_trip`` (decoding gives the normalised
    text) and ``parity`` (tokenizers and sentencepiece agree on every word; the ids are the tokenizers library's either way).

    Whole texts; a null text is empty, an empty text has no tokens. A marker character in a text decodes as a space, in either
    library. Equal rows give equal results; an empty table an empty one; other columns are ignored. The model file is read once,
    on the driver, and sent to the tasks (about 0.5 MB)."""
    with open(model_file, "rb") as f:
        data = docs.sparkSession.sparkContext.broadcast(f.read())
    source = docs.select(F.struct(*keep).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("txt"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(data.value, threads)
        for b in slices(batches):
            flat, sizes, decoded, same, agrees = codec.run(b.column("txt").to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column("row"), lists, pa.array(sizes), pa.array(decoded, pa.string()), pa.array(same, pa.bool_()), pa.array(agrees, pa.bool_())],
                                             ["row", "ids", "n_tokens", "decoded", "round_trip", "parity"])

    kind = source.schema["row"].dataType.simpleString()
    out = source.mapInArrow(run, f"row {kind}, ids array<int>, n_tokens long, decoded string, round_trip boolean, parity boolean")
    return out.select("row.*", "ids", "n_tokens", "decoded", "round_trip", "parity")
