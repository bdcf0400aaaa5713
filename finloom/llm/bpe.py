"""Byte-level BPE: encoding by a lazily determinised finite-state transducer, decoding by an incremental UTF-8 state machine.

A sequence of tokens is the BPE encoding of its bytes exactly if each two neighbours are the encoding of theirs. That makes
encoding a transduction: a nondeterministic machine guesses the next token while it walks the trie of the vocabulary, and may
close it where the pair (last token, this token) is its own encoding. Subset construction runs lazily, one (state, byte) at a
time: a state is the set of guesses still alive, each with the tokens that not all of them share yet; what all share is emitted.
A guess lives for one token's bytes at most, so the lookahead is bounded by the longest token. Transitions are memoised up to a
bound and then built anew, and so are whole pieces, so a worker's memory doesn't grow with the corpus. A worker that Spark keeps for
later stages drops all of it once it has encoded nothing for IDLE_SECONDS.

Defined results: a null text encodes to an empty list like an empty one; null ids decode to no bytes; an id outside the
vocabulary, or a null inside a list, is an error; repeated rows give equal results; empty tables give none. A column that is named
as the output is replaced; others pass through.
"""

from __future__ import annotations

import base64
import gc
import marshal
import re
import threading
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from finloom.llm.common import small_batches

MAX_STATES = 250_000
MAX_PIECES = 200_000
MAX_PAIRS = 300_000
#: What a worker holds is dropped when it wasn't used for so long; tasks of one stage follow each other sooner.
IDLE_SECONDS = 5.0
#: Texts are split into pieces a part of about this many characters at a time.
PART_CHARS = 1_000_000
#: A place where a piece always ends: a letter, one space, a letter.
CUT = regex.compile(r"(?<=\p{L})(?= \p{L})")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Moves(dict):
    """state << 8 | byte -> (next state << 8, packed tokens emitted), filled in as bytes come. A state's guesses are held as bytes."""

    def __init__(self, machine: Transducer):
        self.machine, self.guesses = machine, [marshal.dumps(((-1, 0, b""),), 2)]
        self.names = {self.guesses[0]: 0}

    def __missing__(self, key: int) -> tuple[int, bytes]:
        alive, emitted = self.machine.move(marshal.loads(self.guesses[key >> 8]), key & 255)
        name = marshal.dumps(alive, 2)  # in version 2 equal guesses give equal bytes
        to = self.names.setdefault(name, len(self.guesses))
        if to == len(self.guesses):
            self.guesses.append(name)
        move = self[key] = to << 8, emitted
        return move


class Transducer:
    """Encodes one piece (what the pattern matched) after another. Tokens in hand are packed to four bytes each."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.tokens = ranks, {i: b for b, i in ranks.items()}
        self.packed = {i: pack("=i", i) for i in self.tokens}
        self.child: dict[int, int] = {}  # trie: node << 8 | byte -> node
        self.ends = [-1]  # token that ends at a node
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                node = self.child.get(key) or self._grow(key)
            self.ends[node] = rank
        self.pairs: dict[int, bool] = {}  # last << 32 | token -> whether token may follow last
        self.halves: dict[int, tuple[int, int] | None] = {}
        self._reset()

    def _grow(self, key: int) -> int:
        self.ends.append(-1)
        self.child[key] = len(self.ends) - 1
        return len(self.ends) - 1

    def _reset(self) -> None:
        # A guess is (last token, trie node, tokens held).
        self.moves = Moves(self)

    def merged(self, data: bytes, until: int = 1) -> list[int]:
        """The encoding of a few bytes by its definition: merge the lowest rank, leftmost first, until none or so many are left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > until:
            best = min(((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(1 << 60, 0))
            if best[0] == 1 << 60:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def may_follow(self, last: int, token: int) -> bool:
        """Whether token can stand after last (-1: at the start) in an encoding."""
        key = last << 32 | token
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._reachable(token) if last < 0 else self._stays_apart(last, token)
        return known

    def _parts_of(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte, and for a token that no merges reach."""
        if token not in self.halves:
            parts = self.merged(self.tokens[token], 2)
            self.halves[token] = tuple(parts) if len(parts) == 2 else None
        return self.halves[token]

    def _reachable(self, token: int) -> bool:
        return len(self.tokens[token]) == 1 or self._parts_of(token) is not None

    def _stays_apart(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both ends with both: going back from the last merge to the first, no merge across the
        border may come before the one that covers it on either side."""
        if not (self._reachable(left) and self._reachable(right)):
            return False
        ranks, tokens = self.ranks, self.tokens
        later = 1 << 60  # what is undone so far came at this rank
        equal = False  # of equal ranks the leftmost merges first, so a merge across loses to the same one on its left
        while True:
            across = ranks.get(tokens[left] + tokens[right])
            if across is not None and (across < later or equal and across == later):
                return False
            a, b = self._parts_of(left), self._parts_of(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and left > right):
                later, left, equal = left, a[1], False
            else:
                later, right, equal = right, b[0], True

    def move(self, guesses: tuple, byte: int) -> tuple[tuple, bytes]:
        """The guesses alive after a byte, and the tokens that all of them share."""
        child, ends = self.child.get, self.ends
        alive, closing = [], []
        for last, node, held in guesses:
            to = child(node << 8 | byte)
            if to is not None:
                alive.append((last, to, held))
                if ends[to] >= 0:
                    closing.append((last, ends[to], held))
        # Any bytes have one encoding, so one guess closes here: the last candidate, if none before it does.
        for last, token, held in closing[:-1]:
            if self.may_follow(last, token):
                break
        else:
            last, token, held = closing[-1]
        alive.append((token, 0, held + self.packed[token]))
        # Guesses stand in the order in which they began, so equal sets are equal tuples.
        shared = alive[0][2]
        if shared:
            for _, _, held in alive:
                while not held.startswith(shared):
                    shared = shared[:-4]
            if shared:
                n = len(shared)
                alive = [(last, node, held[n:]) for last, node, held in alive]
        return tuple(alive), shared

    def encode_piece(self, data: bytes) -> bytes:
        """The tokens of a piece, packed."""
        whole = self.ranks.get(data)
        if whole is not None:
            return self.packed[whole]
        if len(self.moves.names) > MAX_STATES:
            self._reset()
            gc.collect()
        moves, state, out = self.moves, 0, []
        for byte in data:
            state, emitted = moves[state | byte]
            if emitted:
                out.append(emitted)
        out.append(marshal.loads(moves.guesses[state >> 8])[-1][2])  # the guess that closed at the last byte
        return b"".join(out)


def latin_pattern(pattern: str) -> re.Pattern:
    """The pattern for texts below U+0100: its classes written out, so that the faster module of the standard library can run it."""
    of = {c: "".join(re.escape(chr(i)) for i in range(256) if regex.match(c, chr(i))) for c in (r"\s", r"\S", r"\p{L}", r"\p{N}")}
    out, inside, at = [], False, 0
    while at < len(pattern):
        name = next((c for c in of if pattern.startswith(c, at)), None)
        if name:
            out.append(of[name] if inside else f"[{of[name]}]")
            at += len(name)
            continue
        inside = pattern[at] == "[" or inside and pattern[at] != "]"
        out.append(pattern[at])
        at += 1
    return re.compile("".join(out))


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Pieces(dict):
    """Pieces met, with their tokens: two generations, of which what is used again moves up into the younger."""

    def __init__(self, machine: Transducer):
        self.machine, self.older = machine, {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MAX_PIECES:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(piece) or self.machine.encode_piece(piece.encode("utf-8", "surrogatepass"))
        self[piece] = ids
        return ids


class Encoder:
    def __init__(self, path: str, pattern: str):
        self.pieces = Pieces(Transducer(read_ranks(path)))
        self.pattern, self.latin = regex.compile(pattern), latin_pattern(pattern)
        # Whether pieces of this pattern do end there; if not, texts aren't split into parts.
        self.cuts = all(self.pattern.findall(a + " " + b) == self.pattern.findall(a) + self.pattern.findall(" " + b) for a in ("ab", "Ж", "日本", "don't") for b in ("cd", "ñ", "Ж", "語"))

    def _parts(self, text: str):
        at = 0
        while self.cuts and len(text) - at > PART_CHARS and (cut := CUT.search(text, at + PART_CHARS)):
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def encode(self, text: str) -> np.ndarray:
        pieces_of = (self.latin if is_latin(text) else self.pattern).findall
        return np.frombuffer(b"".join(b"".join(map(self.pieces.__getitem__, pieces_of(part))) for part in self._parts(text)), np.int32)


#: What may follow a byte of these ranges in UTF-8 (first, last, continuation bytes that must follow, range of the next one).
LEADS = [
    (0x00, 0x7F, 0, 0, 0),
    (0xC2, 0xDF, 1, 0x80, 0xBF),
    (0xE0, 0xE0, 2, 0xA0, 0xBF),
    (0xE1, 0xEC, 2, 0x80, 0xBF),
    (0xED, 0xED, 2, 0x80, 0x9F),
    (0xEE, 0xEF, 2, 0x80, 0xBF),
    (0xF0, 0xF0, 3, 0x90, 0xBF),
    (0xF1, 0xF3, 3, 0x80, 0xBF),
    (0xF4, 0xF4, 3, 0x80, 0x8F),
]
#: The states: how many bytes are to come, and the range that the next must lie in.
START = (0, 0, 0)
LEAD_STATES = {byte: (n, low, high) for first, last, n, low, high in LEADS for byte in range(first, last + 1)}


def next_state(state: tuple[int, int, int], byte: int) -> tuple[int, int, int]:
    """One step of the UTF-8 state machine; a byte that can't follow ends the sequence and is looked at anew."""
    n, low, high = state
    if n and low <= byte <= high:
        return (n - 1, 0x80, 0xBF) if n > 1 else START
    return LEAD_STATES.get(byte, START)


class Utf8Stream:
    """Text from bytes that come in any pieces: an incomplete sequence at the end waits for what follows.

    The state at the end of a piece depends on its last three bytes only, so the machine runs over these; the bytes before the
    sequence that is still open are whole characters, or wrong ones, and are decoded at once.
    """

    def __init__(self):
        self.held = b""

    def feed(self, data: bytes, last: bool = False) -> str:
        data = self.held + data
        keep = 0
        if not last:
            state, first = START, max(0, len(data) - 3)
            for at in range(first, len(data)):
                was, state = state, next_state(state, data[at])
                if state == START:
                    keep = 0
                else:
                    keep = keep + 1 if was != START and was[1] <= data[at] <= was[2] else 1
        self.held = data[len(data) - keep :] if keep else b""
        return (data[: len(data) - keep] if keep else data).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


@lru_cache(maxsize=4)
def _token_bytes(path: str) -> tuple[bytes, ...]:
    ranks = read_ranks(path)
    out = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        out[i] = token
    return tuple(out)


class _Idle:
    """Clears the caches once no batch has used them for IDLE_SECONDS. A batch that runs meanwhile has its own hold on what it uses."""

    timer: threading.Timer | None = None

    def __enter__(self) -> None:
        if self.timer:
            self.timer.cancel()

    def __exit__(self, *error) -> None:
        self.timer = threading.Timer(IDLE_SECONDS, self.forget)
        self.timer.daemon = True
        self.timer.start()

    @staticmethod
    def forget() -> None:
        _encoder.cache_clear()
        _token_bytes.cache_clear()
        gc.collect()  # the machine and its moves hold each other


_IDLE = _Idle()


def _ids(texts: pa.Array, path: str, pattern: str) -> pa.ListArray:
    coder = _encoder(path, pattern)
    gc.disable()  # hundreds of thousands of moves live long; _reset() collects those it gives up
    try:
        with _IDLE:
            found = [coder.encode(t.as_py() or "") for t in texts]
    finally:
        gc.enable()
    offsets = np.zeros(len(found) + 1, np.int32)
    np.cumsum([len(x) for x in found], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found) if found else np.zeros(0, np.int32)))


def _texts(lists: pa.Array, path: str) -> pa.Array:
    token = _token_bytes(path).__getitem__
    out = []
    with _IDLE:
        for one in lists:
            stream, parts, values = Utf8Stream(), [], one.values.to_numpy() if one.is_valid else np.zeros(0, np.int32)
            for at in range(0, len(values), 65_536):
                parts.append(stream.feed(b"".join(map(token, values[at : at + 65_536].tolist()))))
            parts.append(stream.feed(b"", last=True))
            out.append("".join(parts))
    return pa.array(out, pa.string())


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """docs with the token ids of each whole text, as the rank file at path (on every node) and the pattern give them."""
    small_batches(docs.sparkSession)

    def encoded(texts: pa.Array) -> pa.Array:
        return _ids(texts, path, pattern)

    # Called nondeterministic, as the optimizer would run it once for the ids and once more for each use of them.
    return docs.withColumn(ids, arrow_udf(encoded, "array<int>").asNondeterministic()(F.col(text)))


def decode(rows: DataFrame, path: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """rows with the text of the ids; bytes that are not UTF-8 become U+FFFD."""
    small_batches(rows.sparkSession)

    @arrow_udf("string")
    def decoded(lists: pa.Array) -> pa.Array:
        return _texts(lists, path)

    return rows.withColumn(text, decoded(F.col(ids)))


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """docs with the ids of encode() and the text that decode() makes of them, by one Python worker a task.

    With a step each, a task has two workers, and as either may take any step next, both come to hold the encoder's memory.
    """
    small_batches(docs.sparkSession)

    def there_and_back(texts: pa.Array) -> pa.Array:
        lists = _ids(texts, path, pattern)
        return pa.StructArray.from_arrays([lists, _texts(lists, path)], ["ids", "text"])

    both = arrow_udf(there_and_back, "struct<ids: array<int>, text: string>").asNondeterministic()
    rows = docs.withColumn("_bpe_both", both(F.col(text)))
    return rows.withColumns({ids: F.col("_bpe_both.ids"), decoded: F.col("_bpe_both.text")}).drop("_bpe_both")


def digests(rows: DataFrame, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded bytes."""
    return rows.select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("decoded_sha256"),
    )
