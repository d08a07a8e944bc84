"""Best-fit packing of tokenised documents into sequences of bounded length.

Every document becomes its token ids and an end id; documents longer than a sequence are cut into full sequences and a
rest. Pieces are packed by bounded-space online best-fit in the task that tokenised them: a fixed number of open bins,
found through a bitset keyed by free space. A piece goes to the open bin that it fills most; where none has room, a new
bin is opened, and if too many are open the fullest is closed first. Pieces arrive in windows of a fixed number, the long
ones of a window first, so that short ones fill what the long ones leave. Nothing is shuffled, and a task that is run
again gives the same sequences, since they follow from the rows' order in its split and its number.

The vocabulary's pattern never crosses white space or the border between a plain word and a full stop or comma, so ids
are looked up by such units and only units not met lately by the worker process are tokenised. That gives the ids of the whole text.

Defined results: a NULL or empty text is one piece that holds the end id alone. Repeated rows are packed once each. A
document of exactly the sequence length is one piece. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.common import key_and_text, slices, texts_of

SEQUENCE_TOKENS = 4096
END_ID = 1
OPEN_BINS = 1024
WINDOW_PIECES = 8192
CACHE_UNITS = 250_000
CACHE_PARTS = 50_000
# A plain word and the marks after it are units of their own, which makes far fewer units. Everything else goes as a whole
# from blank to blank; white space beyond ASCII stays inside a unit, where the vocabulary's own pattern sees it. İ is no plain
# letter here: its lower case ends in a combining mark, which the vocabulary takes together with a full stop or comma after it.
PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ɏ]+")
UNIT = re.compile(PLAIN.pattern + "(?=[ \n.,])|[^ \t\n\r\x0b\x0c]+")
# What the vocabulary's own pattern finds in a unit of ASCII in lower case, and the rules that make it so.
PART = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
SCHEMA = ("doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """For each letter beyond ASCII that a plain word has in lower case, the signs by which a byte-level vocabulary names its bytes."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    sign = [chr(b) if b in own else chr(next(other)) for b in range(256)]
    letters = {c for c in map(chr, range(0xC0, 0x250)) if PLAIN.fullmatch(c)}
    return {ord(c): "".join(sign[b] for b in c.encode()) for letter in letters for c in letter.lower()}


BYTE_LETTERS = _byte_letters()


def _plain_rules(vocabulary: str) -> bool:
    """Whether the vocabulary normalises and splits as `PART` does, so that its model can be asked for the ids of a plain unit's parts."""
    with open(vocabulary, encoding="utf-8") as file:
        rules = json.load(file)
    added = [token["content"] for token in rules.get("added_tokens") or []]
    return (rules.get("normalizer"), rules.get("pre_tokenizer")) == (NORMALIZER, PRE_TOKENIZER) and all("<|" in t for t in added)


class UnitIds(dict):
    """Ids of units as little-endian 32-bit integers, by unit. A unit that was not met lately is tokenised when it is looked up.

    The vocabulary's model gives the ids of plain words and of what stands between them in ASCII; the whole tokenizer, whose
    normalising and splitting takes several times as long, those of all other units.

    Memory is bounded: when the recent units are many they become the old ones, and the old ones go unless met again.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.model = self.tokenizer.model if _plain_rules(vocabulary) else None
        self.ids = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.old: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        encoded = b"".join(map(self.__getitem__, UNIT.findall(text)))
        if len(self) > CACHE_UNITS:
            self.old = dict(self)
            self.clear()
        return encoded

    def __missing__(self, unit: str) -> bytes:
        found = self.old.get(unit)
        if found is None:
            found = self._tokenised(unit)
        self[unit] = found
        return found

    def _tokenised(self, unit: str) -> bytes:
        if self.model is not None:
            if unit.isascii():
                if unit.isalpha():
                    return self._of_part(unit.lower())
                if "<|" not in unit and unit.isprintable():
                    return b"".join([self.parts.get(part) or self._kept_part(part) for part in PART.findall(unit.lower())])
            elif PLAIN.fullmatch(unit):
                return self._of_part(unit.lower().translate(BYTE_LETTERS))
        return b"".join([self.ids[i] for i in self.tokenizer.encode(unit, add_special_tokens=False).ids])

    def _of_part(self, part: str) -> bytes:
        return b"".join([self.ids[token.id] for token in self.model.tokenize(part)])

    def _kept_part(self, part: str) -> bytes:
        if len(self.parts) >= CACHE_PARTS:
            self.parts.clear()
        found = self.parts[part] = self._of_part(part)
        return found


@cache
def unit_ids(vocabulary: str) -> UnitIds:
    """The units of this worker process, which the next task finds as the last one left them."""
    return UnitIds(vocabulary)


class OpenBins:
    """Bounded-space best-fit. `place` gives a piece's bin and its offset there."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.bits, self.bins, self.open, self.opened = 0, [[] for _ in range(capacity + 1)], 0, 0

    def place(self, length: int) -> tuple[int, int]:
        room = self.bits >> length
        if room:
            free = length + (room & -room).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, number = self.capacity, self.opened
            self.opened += 1
        left = free - length
        if left:
            self.bins[left].append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.capacity - free

    def _take(self, free: int) -> int:
        number = self.bins[free].pop()
        if not self.bins[free]:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number


def _placed(window: list[tuple], bins: OpenBins, first: int) -> pa.RecordBatch:
    """The pieces of a window put into bins, the long ones first."""
    rows = []
    for row in sorted(window, key=lambda row: -row[3]):
        number, offset = bins.place(row[3])
        rows.append((*row, first + number, offset))
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    sequence_tokens: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    open_bins: int = OPEN_BINS,
) -> DataFrame:
    """One row per piece: which document and part it is, a checksum of its ids, and its place in a sequence."""
    vocabulary = vocabulary or default_vocabulary()
    end, step = end_id.to_bytes(4, "little"), 4 * sequence_tokens

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, bins = unit_ids(vocabulary), OpenBins(sequence_tokens, open_bins)
        first = TaskContext.get().partitionId() << 40
        window = []
        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                ids = units.encode(text) + end
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    window.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                if len(window) >= WINDOW_PIECES:
                    yield _placed(window, bins, first)
                    window = []
        if window:
            yield _placed(window, bins, first)

    return key_and_text(docs).mapInArrow(run, SCHEMA)
