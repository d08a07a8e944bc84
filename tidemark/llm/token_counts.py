"""Token counts by a byte-level pair vocabulary compiled to two deterministic transducers.

The first reads characters and marks where the vocabulary's pattern begins a unit: a word with the blank before it, a
number, marks, white space, a contraction. It has eight states, and its symbols are a character's class with that of
the next character, for the pattern looks one character ahead. Texts are cut into chunks of equal length wherever they
lie; every chunk's map from states to states is computed for all chunks at once, the maps are composed by a parallel
prefix scan, and a second pass from the states so found marks the beginnings.

The second reads the bytes of a unit, and its transitions carry the change of the number of tokens. Its states follow
from how merging works: the tokens of a text are those whose neighbours are all compatible, that is, no merge across
their border comes before those within them. So the last token of every prefix is determined by the last tokens of
shorter ones, and a state is the longest end of the prefix that begins some token, with the last tokens and relative
counts at the places within it. Transitions are compiled as texts need them, and all are forgotten when states are too many.
All units of a piece of text step through the table at once.

Strings of special tokens inside a text count as one token each, which is the library's default. Only vocabularies of
this kind are taken: no normaliser, the byte-level pattern, every token made by one rule.

Memory is bounded by pieces of a fixed size, however long a text is: a long one is cut where a unit begins, from where
reading starts anew. Only a single unit longer than that makes a piece grow to hold it.

Defined results: a NULL or empty text has no bytes and no tokens. Repeated rows are counted once each. A NULL doc_id
stays NULL. An empty table gives no rows. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import key_and_text, text_bytes

TOKEN_LIMIT = 1024
PIECE_BYTES = 1 << 20
CHUNK = 128
LANES = 1 << 14
STEPS = 48
STATES = 1 << 18
PAIRS = 1 << 20
HASH = 0x9E3779B1
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

# Classes of characters; letters of contractions have their own.
END, LETTER, NUMBER, OTHER, BLANK, SPACE, QUOTE, STMD, R, V, L, E, SPECIAL = range(13)
CLASSES = 13
LETTERS = {LETTER, STMD, R, V, L, E}
UNKNOWN = 255
# States of the first transducer: nothing open; in a word, number or marks; a blank that joins what follows; white space
# that goes on; a quote that may begin a contraction; one letter before a contraction's end.
START, IN_WORD, IN_NUMBER, IN_MARKS, JOINING, IN_SPACE, QUOTED, ENDING = range(8)
KINDS = 8


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _unit_step(state: int, read: int, ahead: int) -> tuple[int, int]:
    """The state after a character, and 1 if a unit begins with it."""
    if read == SPECIAL:
        return START, 1
    if read == END:
        return START, 0
    if state == ENDING:
        return START, 0
    if state == QUOTED and (read == STMD or (read, ahead) in {(R, E), (V, E), (L, L)}):
        return (START if read == STMD else ENDING), 0
    if read in (BLANK, SPACE):
        last = ahead not in (BLANK, SPACE, END, SPECIAL)
        begins = 0 if state == IN_SPACE and not last else 1
        if not last:
            return IN_SPACE, begins
        return (JOINING if read == BLANK else START), begins
    kind = IN_WORD if read in LETTERS else IN_NUMBER if read == NUMBER else IN_MARKS
    if state in (kind, JOINING) or (state == QUOTED and kind == IN_MARKS):
        return kind, 0
    if read == QUOTE and ahead in (STMD, R, V, L):
        return QUOTED, 1
    return kind, 1


def _unit_tables() -> tuple[np.ndarray, np.ndarray]:
    """Next state and beginnings by symbol and state; the second half of the symbols are those of a text's first character."""
    following = np.zeros((2, CLASSES, CLASSES, KINDS), np.uint8)
    begins = np.zeros((2, CLASSES, CLASSES, KINDS), np.uint8)
    for first in (0, 1):
        for read in range(CLASSES):
            for ahead in range(CLASSES):
                for state in range(KINDS):
                    at = (first, read, ahead, state)
                    following[at], begins[at] = _unit_step(START if first else state, read, ahead)
    return following.reshape(-1), begins.reshape(-1)


FOLLOWING, BEGINS = _unit_tables()


def chunk_starts(symbols: np.ndarray) -> np.ndarray:
    """The state in which every chunk (row) begins: the chunks' state maps, composed by a parallel prefix scan."""
    maps = np.repeat(np.arange(KINDS, dtype=np.uint8)[None, :], len(symbols), axis=0)
    scaled = symbols.astype(np.int32) * KINDS
    for at in range(symbols.shape[1]):
        maps = FOLLOWING.take(scaled[:, at, None] + maps)
    reach = 1
    while reach < len(maps):
        maps = np.concatenate([maps[:reach], np.take_along_axis(maps[reach:], maps[:-reach], axis=1)])
        reach *= 2
    return np.concatenate([[np.uint8(START)], maps[:-1, START]])


def unit_begins(symbols: np.ndarray) -> np.ndarray:
    """True at the characters with which a unit begins."""
    n = len(symbols)
    rows = np.zeros((-(-n // CHUNK), CHUNK), np.int32)
    rows.reshape(-1)[:n] = symbols
    state = chunk_starts(rows)
    columns = np.ascontiguousarray(rows.T) * KINDS
    marks = np.empty((CHUNK, len(rows)), np.uint8)
    for at in range(CHUNK):
        place = columns[at] + state
        marks[at] = BEGINS.take(place)
        state = FOLLOWING.take(place)
    return marks.T.reshape(-1)[:n].astype(bool)


def _byte_characters() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file: printable ones themselves, the rest from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """The vocabulary's merge rules, and which tokens can stand side by side."""

    def __init__(self, vocabulary: dict):
        byte_of = _byte_characters()
        as_bytes = lambda text: bytes(byte_of[c] for c in text)
        self.tokens = {bytes([b]): b for b in range(256)}
        self.parts: list[tuple[int, int] | None] = [None] * 256
        self.rules: dict[tuple[int, int], int] = {}
        for rule in vocabulary["merges"]:
            left, right = (as_bytes(part) for part in (rule.split(" ") if isinstance(rule, str) else rule))
            if left + right in self.tokens:
                raise ValueError("two rules of the vocabulary make the same token")
            pair = self.tokens[left], self.tokens[right]
            self.rules[pair] = self.tokens[left + right] = len(self.parts)
            self.parts.append(pair)
        self.beginnings = {b"": 0}
        for token in self.tokens:
            for n in range(1, len(token) + 1):
                self.beginnings.setdefault(token[:n], len(self.beginnings))
        self.texts = list(self.beginnings)
        self.next_end: dict[int, int] = {}
        self.endings: list[list[tuple[int, int]] | None] = [None] * len(self.texts)
        self.known: dict[tuple[int, int], bool] = {}

    def end_after(self, end: int, byte: int) -> int:
        """The longest end of a text that begins some token, by that of the text without its last byte."""
        found = self.next_end.get(end << 8 | byte)
        if found is None:
            text = self.texts[end] + bytes([byte])
            found = next(self.beginnings[text[i:]] for i in range(len(text) + 1) if text[i:] in self.beginnings)
            self.next_end[end << 8 | byte] = found
        return found

    def tokens_ending(self, end: int) -> list[tuple[int, int]]:
        """The tokens with which a text of this end may end, and their lengths."""
        found = self.endings[end]
        if found is None:
            text = self.texts[end]
            found = [(self.tokens[text[i:]], len(text) - i) for i in range(len(text)) if text[i:] in self.tokens]
            self.endings[end] = found
        return found

    def compatible(self, left: int, right: int) -> bool:
        """True if the two tokens' text, tokenised by itself, is these two tokens."""
        found = self.known.get((left, right))
        if found is None:
            if len(self.known) >= PAIRS:
                self.known.clear()
            found = self.known[left, right] = self._compatible(left, right)
        return found

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """What stands at that end of the token while it is being made, each with the rule that uses it up."""
        edge, used = [], len(self.parts)
        while True:
            edge.append((token, used))
            if self.parts[token] is None:
                return edge
            used, token = token, self.parts[token][side]

    def _compatible(self, left: int, right: int) -> bool:
        ends, starts = self._edge(left, 1), self._edge(right, 0)
        for a, a_used in ends:
            for b, b_used in starts:
                rule = self.rules.get((a, b))
                # Of equal rules the one further left comes first: one within the left token before one across the border.
                if rule is not None and rule < a_used and rule <= b_used:
                    return False
        return True


class Counter:
    """The second transducer. Transitions are compiled on demand into an open-addressed table keyed by state and byte."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.forget()

    def forget(self, used: np.ndarray | None = None) -> np.ndarray:
        """Drops all states but those in use, and gives these their new numbers."""
        kept = [] if used is None else [self.states[i] for i in used]
        self.states, self.numbers, self.size = [], {}, 0
        self._room(1 << 14)
        self.number((0, (-1,), (0,)))
        return np.array([self.number(state) for state in kept], np.int32)

    def _room(self, slots: int) -> None:
        self.keys = np.full(slots, -1, np.int64)
        self.following = np.zeros(slots, np.int32)
        self.change = np.zeros(slots, np.int16)
        self.mask = slots - 1

    def number(self, state: tuple) -> int:
        found = self.numbers.get(state)
        if found is None:
            found = self.numbers[state] = len(self.states)
            self.states.append(state)
        return found

    def compile(self, number: int, byte: int) -> tuple[int, int]:
        """Where a transition leads, and how it changes the number of tokens."""
        merges = self.merges
        end, last, counts = self.states[number]
        now = merges.end_after(end, byte)
        for token, length in merges.tokens_ending(now):
            before = last[-length]
            if before < 0 or merges.compatible(before, token):
                break
        else:
            raise AssertionError("every byte is a token, so some token fits")
        change = counts[-length] + 1
        # What stands at the places within the new end, which is at most one longer than the old.
        most = len(merges.texts[now])
        last = (*last[len(last) - most :], token) if most else (token,)
        counts = (*[c - change for c in counts[len(counts) - most :]], 0) if most else (0,)
        return self.number((now, last, counts)), change

    def find(self, place: np.ndarray) -> np.ndarray:
        """The slots of transitions (state * 256 + byte); those not yet known are compiled."""
        slot = (place * HASH >> 20) & self.mask
        there = self.keys.take(slot)
        rest = np.flatnonzero(there != place)
        while len(rest):
            empty = there[rest] < 0
            if empty.any():
                for new in np.unique(place[rest[empty]]).tolist():
                    self._add(new)
                return self.find(place)
            slot[rest] = (slot[rest] + 1) & self.mask
            there[rest] = self.keys.take(slot[rest])
            rest = rest[there[rest] != place[rest]]
        return slot

    def _add(self, place: int) -> None:
        if 2 * self.size >= len(self.keys):
            old = self.keys >= 0
            keys, following, change = self.keys[old], self.following[old], self.change[old]
            self._room(4 * len(self.keys))
            for k, f, c in zip(keys.tolist(), following.tolist(), change.tolist()):
                self._put(k, f, c)
        self._put(place, *self.compile(place >> 8, place & 255))
        self.size += 1

    def _put(self, place: int, following: int, change: int) -> None:
        slot = (place * HASH >> 20) & self.mask
        while self.keys[slot] >= 0:
            slot = (slot + 1) & self.mask
        self.keys[slot], self.following[slot], self.change[slot] = place, following, change

    def count(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Tokens of every unit, given as places in `data`."""
        total = np.zeros(len(start), np.int64)
        for at in range(0, len(start), LANES):
            part = slice(at, at + LANES)
            total[part] = self._count_lanes(data, start[part], length[part])
        return total

    def _count_lanes(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        order = np.argsort(-np.minimum(length, STEPS + 1), kind="stable")
        start, length = start[order], length[order]
        going = np.searchsorted(-length, -np.arange(1, STEPS + 2), side="right")
        state, total = np.zeros(len(start), np.int32), np.zeros(len(start), np.int64)
        for step in range(STEPS):
            lanes = going[step]
            if not lanes:
                break
            if len(self.states) + LANES > STATES:
                used, back = np.unique(state[:lanes], return_inverse=True)
                state[:lanes] = self.forget(used)[back]
            slot = self.find(state[:lanes].astype(np.int64) << 8 | data[start[:lanes] + step])
            total[:lanes] += self.change.take(slot)
            state[:lanes] = self.following.take(slot)
        for lane in range(going[STEPS]):
            total[lane] += self._rest(data[start[lane] + STEPS : start[lane] + length[lane]].tobytes(), int(state[lane]), state)
        result = np.empty_like(total)
        result[order] = total
        return result

    def _rest(self, rest: bytes, now: int, lanes: np.ndarray) -> int:
        """The further tokens of one long unit, byte by byte; `lanes` are states that must stay."""
        total, known = 0, {}
        for byte in rest:
            step = known.get(now << 8 | byte)
            if step is None:
                if len(self.states) >= STATES:
                    used, back = np.unique(np.append(lanes, now), return_inverse=True)
                    fresh = self.forget(used)[back]
                    lanes[:], now, known = fresh[:-1], int(fresh[-1]), {}
                step = known[now << 8 | byte] = self.compile(now, byte)
            now, total = step[0], total + step[1]
        return total


class Compiled:
    """Both transducers of a vocabulary file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        described = json.loads(Path(path).read_text(encoding="utf-8"))
        pattern = described["pre_tokenizer"] or {}
        if (described["normalizer"] is not None or described["model"].get("ignore_merges")
                or (pattern.get("type"), pattern.get("use_regex"), pattern.get("add_prefix_space")) != ("ByteLevel", True, False)):
            raise ValueError("not a plain byte-level pair vocabulary")
        added = described["added_tokens"]
        if any(token["normalized"] or token["lstrip"] or token["rstrip"] or token["single_word"] for token in added):
            raise ValueError("special tokens with conditions are not supported")
        strings = sorted((token["content"].encode() for token in added), key=len, reverse=True)
        self.longest = max(map(len, strings), default=1)
        self.special = re.compile(b"|".join(map(re.escape, strings))) if strings else None
        self.counter = Counter(Merges(described["model"]))
        self.units = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        for point in range(128):
            self._classify(point)
        for character, kind in {"'": QUOTE, " ": BLANK, "r": R, "v": V, "l": L, "e": E, **dict.fromkeys("stmd", STMD)}.items():
            self.classes[ord(character)] = kind

    def _classify(self, point: int) -> None:
        """A character's class is read off the pattern itself: what it joins."""
        character = chr(point)
        joins = lambda other: len(self.units(other + character)) == 1
        self.classes[point] = LETTER if joins("a") else NUMBER if joins("1") else OTHER if joins("!") else SPACE

    def _points(self, data: np.ndarray, lead: np.ndarray) -> np.ndarray:
        """Code points of the characters that begin at `lead`."""
        points = data[lead].astype(np.int32)
        wide = np.flatnonzero(points >= 0x80)
        if len(wide):
            at, first = lead[wide], points[wide]
            tail = [data[np.minimum(at + i, len(data) - 1)].astype(np.int32) & 0x3F for i in (1, 2, 3)]
            two, three = (first & 0x1F) << 6 | tail[0], (first & 0x0F) << 12 | tail[0] << 6 | tail[1]
            four = (first & 0x07) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2]
            points[wide] = np.where(first < 0xE0, two, np.where(first < 0xF0, three, four))
        return points

    def unit_places(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every unit of texts that lie one after the other, and which units are special tokens."""
        is_lead = (data & 0xC0) != 0x80
        specials = []
        if self.special:
            for found in self.special.finditer(data):
                text = np.searchsorted(bounds, found.start(), side="right")
                if found.end() <= bounds[text]:
                    specials.append(found.start())
                    is_lead[found.start() + 1 : found.end()] = False
        lead = np.flatnonzero(is_lead)
        points = self._points(data, lead)
        kinds = self.classes.take(points)
        if (kinds == UNKNOWN).any():
            for point in np.unique(points[kinds == UNKNOWN]).tolist():
                self._classify(point)
            kinds = self.classes.take(points)
        special = np.zeros(len(lead), bool)
        special[np.searchsorted(lead, specials)] = True
        kinds[special] = SPECIAL
        firsts = np.searchsorted(lead, np.unique(bounds[:-1][bounds[:-1] < bounds[1:]]))
        ahead = np.append(kinds[1:], np.uint8(END))
        ahead[firsts[1:] - 1] = END
        symbols = kinds.astype(np.int32) * CLASSES + ahead
        symbols[firsts] += CLASSES * CLASSES
        begins = np.flatnonzero(unit_begins(symbols))
        start = lead[begins]
        # Units lie side by side; special tokens are the only ones with bytes that are no characters here.
        return start, np.append(start[1:], len(data)), special[begins]

    def count_texts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Tokens of texts that lie one after the other."""
        totals = np.zeros(len(bounds) - 1, np.int64)
        at = 0
        while at < len(totals):
            upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + PIECE_BYTES, side="right")) - 1)
            piece = data[bounds[at] : bounds[upto]]
            if upto == at + 1 and len(piece) > PIECE_BYTES:
                totals[at] = self._count_long(piece)
            elif len(piece):
                places = bounds[at : upto + 1] - bounds[at]
                start, end, special = self.unit_places(piece, places)
                sums = np.concatenate([[0], np.cumsum(self._tokens(piece, start, end, special))])
                totals[at:upto] = np.diff(sums[np.searchsorted(start, places)])
            at = upto
        return totals

    def _tokens(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, special: np.ndarray) -> np.ndarray:
        return np.where(special, 1, self.counter.count(data, start, np.where(special, 0, end - start)))

    def _count_long(self, data: np.ndarray) -> int:
        """Tokens of a text longer than a piece: units are counted up to the last that begins well within the piece."""
        total, at, size = 0, 0, PIECE_BYTES
        while True:
            upto = min(at + size, len(data))
            while upto < len(data) and data[upto] & 0xC0 == 0x80:
                upto -= 1
            piece = data[at:upto]
            start, end, special = self.unit_places(piece, np.array([0, len(piece)]))
            if upto == len(data):
                return total + int(self._tokens(piece, start, end, special).sum())
            whole = int(np.searchsorted(start, len(piece) - self.longest - 16, side="right")) - 1
            if whole < 1:
                size *= 2
                continue
            total += int(self._tokens(piece, start[:whole], end[:whole], special[:whole]).sum())
            at, size = at + int(start[whole]), PIECE_BYTES


_COMPILED: dict[str, Compiled] = {}


def compiled(path: str) -> Compiled:
    """The transducers of a vocabulary, made once per worker."""
    if path not in _COMPILED:
        _COMPILED[path] = Compiled(path)
    return _COMPILED[path]


def count_tokens(docs: DataFrame, vocabulary: str | None = None, token_limit: int = TOKEN_LIMIT) -> DataFrame:
    """Bytes and tokens of every document, and whether it has more than `token_limit` tokens."""
    vocabulary = vocabulary or default_vocabulary()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = compiled(vocabulary)
        for batch in batches:
            if batch.num_rows:
                data, bounds = text_bytes(batch.column("text"))
                tokens = both.count_texts(data, bounds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(np.diff(bounds)), pa.array(tokens), pa.array(tokens > token_limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return key_and_text(docs).mapInArrow(run, SCHEMA)
