"""Token counts by a compiled finite-state tokenizer.

A byte-pair encoding is run as a deterministic transducer: a state is what of the pre-token so far can still change (the
longest suffix that begins some token, with the last token and relative token count at each place in it), and each
transition carries the change in the token count. A transition is compiled when texts ask for it the second time, and kept in one
table (state x byte), within a bound; the first time, the rest of the pre-token is merged by the definition, for a word
that never comes again isn't worth its states. Where pre-tokens begin, the transducer starts anew.

Texts run side by side: their bytes, whatever their lengths, are cut into chunks of ``CHUNK`` bytes, and one vector step
takes the next byte of every chunk. A chunk's state map (entering state to leaving state and counts) is constant from the
first pre-token in it on, which the first pass runs. The maps are composed in a scan: each chunk's head is run from the
state that the chunk before leaves. A chunk inside one long pre-token has no constant map; it is evaluated at the state
that its predecessor is guessed to leave, and again for every state that turns out otherwise, until all maps fit together.

Defined results: a null text counts as empty, 0 tokens. Strings of the tokenizer's added tokens inside a text count as one
token each, as the library does by default. Repeated rows are counted each, and ties don't occur. A very long text, with
white space or without, is as many chunks; nothing of it is held back. An empty table has no counts. Columns other than
doc_id and text are ignored, whatever their names. A definition with parts that aren't covered here raises.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import extended, pieces

#: Bytes that a chunk has.
CHUNK = 64
#: The table's bound, in entries of 4 bytes, and the states': past either a worker compiles anew.
MAX_ENTRIES = 32_000_000
MAX_STATES = 150_000
#: Bits of the hash by which it is noted that a transition was asked for before.
SEEN = 22
#: Character classes of the byte-level pre-tokenizer's pattern.
OTHER, LETTER, NUMBER, SPACE = range(4)
#: What the pre-tokenizer splits off behind an apostrophe.
CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")
_NO_PAIR = 1 << 60
_BYTES = [bytes([b]) for b in range(256)]


def _byte_letters() -> dict[str, int]:
    """The letters which byte-level vocabularies write for bytes: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _classes() -> np.ndarray:
    """The class of every code point."""
    out = np.zeros(0x110000, np.uint8)
    for low, high in ((0, 0xD800), (0xE000, 0x110000)):
        every = "".join(map(chr, range(low, high)))
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for m in regex.finditer(pattern, every):
                out[low + m.start() : low + m.end()] = kind
    return out


def token_starts(offsets: np.ndarray, data: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """For each byte of the texts whether a pre-token begins there.

    Runs of one class are pre-tokens. A blank right before a run of letters, numbers or others belongs to it, white space
    before that is a pre-token of its own, and a contraction is one if the apostrophe begins a pre-token.
    """
    begins = np.zeros(len(data), bool)
    if not len(data):
        return begins
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at].astype(np.uint32)
    code = lead.copy()
    wide = np.flatnonzero(lead >= 0xC0)
    if len(wide):
        more = lambda i, k: data[np.minimum(at[i] + k, len(data) - 1)].astype(np.uint32) & 0x3F
        two, three, four = wide[lead[wide] < 0xE0], wide[(lead[wide] >= 0xE0) & (lead[wide] < 0xF0)], wide[lead[wide] >= 0xF0]
        code[two] = (lead[two] & 0x1F) << 6 | more(two, 1)
        code[three] = (lead[three] & 0x0F) << 12 | more(three, 1) << 6 | more(three, 2)
        code[four] = (lead[four] & 0x07) << 18 | more(four, 1) << 12 | more(four, 2) << 6 | more(four, 3)
    kind = classes[np.minimum(code, 0x10FFFF)]
    n = len(at)
    first = np.zeros(n + 1, bool)
    first[np.searchsorted(at, offsets[:-1][offsets[:-1] < offsets[1:]])] = True
    first[n] = True
    run = np.ones(n + 1, bool)
    run[1:n] = first[1:n] | (kind[1:] != kind[:-1])
    after_blank = np.zeros(n, bool)
    after_blank[1:] = (code[:-1] == 32) & ~first[1:n]
    space = kind == SPACE
    start = run[:n] & (space | ~after_blank)
    # The last of white space that something follows: a blank goes with it, other white space stands alone.
    start[:-1] |= space[:-1] & run[1:n] & ~first[1:n]
    quote = np.flatnonzero((code == 39) & start)
    for letters in CONTRACTIONS:
        size = len(letters) + 1
        fits = quote[quote + size <= n]
        for k, letter in enumerate(letters, 1):
            fits = fits[(code[fits + k] == ord(letter)) & ~first[fits + k]]
        start[fits + 1] = False
        rest = fits[fits + size < n] + size
        start[rest] = True
    begins[at] = start
    return begins


class Transducer:
    """Lazily compiled transducer of one byte-level BPE vocabulary."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        self._check(spec)
        letter = _byte_letters()
        raw = lambda s: bytes(letter[c] for c in s)
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        pairs = [(raw(a), raw(b)) for a, b in merges]
        #: All tokens by number; 0 stands for the start of a pre-token.
        self.tokens = [b"", *dict.fromkeys([*_BYTES, *(a + b for a, b in pairs)])]
        at = {t: i for i, t in enumerate(self.tokens)}
        #: Pair of tokens (first << 20 | second) to its rank << 20 | what it merges to.
        self.pairs = {at[a] << 20 | at[b]: rank << 20 | at[a + b] for rank, (a, b) in reversed([*enumerate(pairs)])}
        #: Tokens that their own merges lead to.
        self.number = {t: i for t, i in at.items() if i and self.merge(t) == [i]}
        self.prefixes = {t[:i] for t in self.number for i in range(len(t) + 1)}
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.classes = _classes()
        self._reset()

    @staticmethod
    def _check(spec: dict) -> None:
        """Raises unless the definition is a byte-level byte-pair encoding without parts that aren't compiled here."""
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        wrong = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model.get("type") != "BPE" or wrong:
            raise ValueError(f"not a plain byte-pair encoding: {model.get('type')} {wrong}")
        if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            raise ValueError(f"not the byte-level pre-tokenizer: {before}")
        if spec.get("normalizer"):
            raise ValueError("normalizers aren't compiled")
        flagged = [t["content"] for t in spec["added_tokens"] if t.get("single_word") or t.get("lstrip") or t.get("rstrip")]
        if flagged:
            raise ValueError(f"added tokens with conditions: {flagged}")

    def _reset(self) -> None:
        self.names: dict[tuple, int] = {}
        #: State 0 is unknown: it leads to itself and emits nothing.
        self.states: list[tuple] = [()]
        #: state x column of a byte: next state << 8 | emitted + 128; -1 isn't compiled yet.
        self.column = np.full(256, -1, np.int64)
        self.table = np.full((1024, 64), -1, np.int32)
        self.table[0] = 128
        self._valid: dict[int, bool] = {}
        #: Marks of the transitions that were asked for, by a hash.
        self.seen = np.zeros(1 << SEEN, bool)
        self.start = self._name((b"", 0, 0))

    def _name(self, state: tuple) -> int:
        at = self.names.setdefault(state, len(self.states))
        if at == len(self.states):
            self.states.append(state)
            if at == len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
        return at

    def merge(self, data: bytes) -> list[int]:
        """Merges by rank, from single bytes: the definition, for short strings only."""
        parts = [b + 1 for b in data]
        get = self.pairs.get
        ranks = [get(a << 20 | b, _NO_PAIR) for a, b in pairwise(parts)]
        while ranks and (least := min(ranks)) != _NO_PAIR:
            i = ranks.index(least)
            parts[i : i + 2] = [least & 0xFFFFF]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get(parts[i] << 20 | parts[i + 1], _NO_PAIR)
            if i:
                ranks[i - 1] = get(parts[i - 1] << 20 | parts[i], _NO_PAIR)
        return parts

    def _follows(self, a: int, b: int) -> bool:
        """Whether token ``b`` can stand after ``a`` (0: first): their joint text is merged into just these."""
        key = a << 32 | b
        found = self._valid.get(key)
        if found is None:
            found = self._valid[key] = self.merge(self.tokens[a] + self.tokens[b]) == ([a, b] if a else [b])
        return found

    def _compile(self, at: int, byte: int) -> None:
        """The transition from a state on a byte.

        A state is (suffix, then for each place in it, from its start to its end: last token there, and its count less
        the count at the end); token -1 marks a place from which no token is under way, so that states which differ in
        such places only are one.
        """
        state = self.states[at]
        suffix = state[0] + _BYTES[byte]
        places = list(state[1:])
        number, prefixes = self.number, self.prefixes
        for j in range(len(suffix)):
            last = places[2 * j]
            if last >= 0:
                token = number.get(suffix[j:])
                if token is not None and self._follows(last, token):
                    emitted = places[2 * j + 1] + 1
                    places += (token, emitted)
                    break
        j = 0
        while suffix[j:] not in prefixes:
            j += 1
        suffix = suffix[j:]
        kept: list = [suffix]
        for i in range(len(suffix) + 1):
            if places[2 * (i + j)] >= 0 and suffix[i:] in prefixes:
                kept += (places[2 * (i + j)], places[2 * (i + j) + 1] - emitted)
            else:
                kept += (-1, 0)
        following = self._name(tuple(kept))
        self.table[at, self.column[byte]] = (following << 8) + emitted + 128

    def _columns(self, data: np.ndarray) -> np.ndarray:
        """The table's column of each byte."""
        new = np.unique(data[self.column[data] < 0])
        for byte in new.tolist():
            self.column[byte] = self.column.max() + 1
        while self.column.max() >= self.table.shape[1]:
            wider = np.full_like(self.table, -1)
            wider[0] = 128
            self.table = np.concatenate([self.table, wider], axis=1)
        return self.column[data]

    def step(self, state: np.ndarray, column: np.ndarray, byte: np.ndarray, rest: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Next state and emitted count of many states, each on a byte of its own.

        A transition that is asked for the second time is compiled. At the first time the lanes (their indices go to
        ``rest``) are given what the rest of their pre-tokens emits, by the definition, and go on in state 0; -1 there
        means that the pre-token is too long for that, and its transition is compiled at once.
        """
        move = self.table[state, column]
        missing = np.flatnonzero(move < 0)
        if not len(missing):
            return (move >> 8).astype(np.int64), (move & 255).astype(np.int32) - 128
        keys = state[missing] << 8 | byte[missing]
        slot = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SEEN)
        new = missing[~self.seen[slot]]
        self.seen[slot] = True
        emitted = rest(new) if len(new) else np.zeros(0, np.int32)
        new, emitted = new[emitted >= 0], emitted[emitted >= 0]
        told = np.zeros(len(state), bool)
        told[new] = True
        for key in np.unique(keys[~told[missing]]).tolist():
            self._compile(key >> 8, key & 255)
        move = np.where(told, 128, self.table[state, column])
        count = (move & 255).astype(np.int32) - 128
        count[new] = emitted
        return (move >> 8).astype(np.int64), count

    def emitted(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Tokens of each of the texts, which hold no added tokens."""
        if len(self.states) > MAX_STATES or self.table.size > MAX_ENTRIES:
            self._reset()
        n = len(data)
        if not n:
            return np.zeros(len(offsets) - 1, np.int64)
        chunks = -(-n // CHUNK)
        padded = np.zeros(chunks * CHUNK, np.uint8)
        padded[:n] = data
        starts = np.zeros(chunks * CHUNK, bool)
        starts[:n] = token_starts(offsets, data, self.classes)
        if chunks * CHUNK > n:
            starts[n] = True
        edges, raw = np.append(np.flatnonzero(starts[:n]), n), data.tobytes()
        # Row j holds byte j of every chunk.
        byte = np.ascontiguousarray(padded.reshape(chunks, CHUNK).T).astype(np.int64)
        column = self._columns(byte)
        begins = np.ascontiguousarray(starts.reshape(chunks, CHUNK).T)
        count = np.zeros((CHUNK, chunks), np.int32)
        state, sofar = np.zeros(chunks, np.int64), np.zeros(chunks, np.int32)

        def rest(j: int, at: np.ndarray, before: np.ndarray) -> np.ndarray:
            """What the pre-tokens that chunks ``at`` are in at byte j emit from there on."""
            place = at * CHUNK + j
            token = np.searchsorted(edges, place, "right") - 1
            out = np.full(len(at), -1, np.int32)
            for i, (a, b) in enumerate(zip(edges[token].tolist(), edges[np.minimum(token + 1, len(edges) - 1)].tolist(), strict=True)):
                if 0 < b - a <= CHUNK:
                    out[i] = len(self.merge(raw[a:b])) - before[i]
            # Less than nothing is rare, and can't be told from "too long": such a transition is compiled.
            return out

        for j in range(CHUNK):
            state[begins[j]], sofar[begins[j]] = self.start, 0
            state, count[j] = self.step(state, column[j], byte[j], lambda i, j=j: rest(j, i, sofar[i]))
            sofar += count[j]

        def head(at: np.ndarray, entering: np.ndarray, before: np.ndarray, into: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Runs chunks from the states they are entered in up to their first pre-token; those without one, and how they are left."""
            for j in range(CHUNK):
                on = ~begins[j, at]
                at, entering, before = at[on], entering[on], before[on]
                if not len(at):
                    break
                entering, emitted = self.step(entering, column[j, at], byte[j, at], lambda i, j=j, at=at, before=before: rest(j, at[i], before[i]))
                before = before + emitted
                if into is not None:
                    into[j, at] = emitted
            return at, entering, before

        inside = np.flatnonzero(~begins.any(axis=0))
        if len(inside):  # a first guess at what the chunks of long pre-tokens are left in
            at, left, _ = head(inside, np.full(len(inside), self.start), np.zeros(len(inside), np.int32), None)
            state[at] = left
        headed = np.flatnonzero(~begins[0])
        entered = np.full(chunks, -1, np.int64)
        while len(headed):
            entered[headed] = state[headed - 1]
            at, left, before = head(headed, entered[headed], sofar[headed - 1], count)
            state[at], sofar[at] = left, before
            moved = at[at + 1 < chunks] + 1
            headed = moved[~begins[0, moved]]
            headed = headed[entered[headed] != state[headed - 1]]
        total = np.concatenate(([0], np.cumsum(count.T.reshape(-1)[:n], dtype=np.int64)))
        return total[offsets[1:]] - total[offsets[:-1]]

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of whole texts; a null counts as empty."""
        out = np.zeros(len(texts), np.int64)
        for first, offsets, data in pieces(texts, 1 << 20, 8192):
            whole = data.tobytes()
            if self.cut is not None and any(s.encode() in whole for s in self.special):
                cut = [self.cut.split(whole[a:b].decode("utf-8", "replace")) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                parts = [p.encode() for row in cut for p in row]
                ends = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
                found = self.emitted(ends, np.frombuffer(b"".join(parts), np.uint8))
                of = np.repeat(np.arange(len(cut)), [len(row) for row in cut])
                out[first : first + len(cut)] = np.bincount(of, found, len(cut)).astype(np.int64) + [len(row) - 1 for row in cut]
            else:
                out[first : first + len(offsets) - 1] = self.emitted(offsets, data)
        return out


_transducers: dict[int, Transducer] = {}


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every text; ``tokenizer``: path, on the driver, of a tokenizers .json file.

    The definition (a fixed size) goes to the executors as a broadcast; a Python worker keeps what it has compiled.
    """
    with open(tokenizer, encoding="utf-8") as f:
        definition = f.read()
    Transducer._check(json.loads(definition))
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    key = hash(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _transducers:
            _transducers.clear()
            _transducers[key] = Transducer(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(_transducers[key].counts(batch.column("text")))], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    schema = extended(rows.drop("text").schema, n_tokens="long")
    return rows.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
