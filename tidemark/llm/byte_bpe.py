"""Byte-level BPE: a lazily determinised transducer encodes, a UTF-8 state machine decodes.

A text is cut by a pattern, and every cut piece is encoded by itself. That the merges lead to a sequence of tokens can be
seen from its neighbours: each two of them, merged from their bytes alone, stay these two. The merges thus compile into a
transducer that reads bytes and guesses tokens: a guess is (the tokens not yet written, the last one, the bytes read of
the next one). One guess a place has no open bytes, as the bytes before have one encoding. What all guesses of a state
have in common is written and forgotten, so that a state looks ahead no further than the longest token. States and edges
are made when a text first takes them and dropped when there are too many.

Nulls are texts without tokens. Empty texts have none either. Whole texts count, however long. Repeated rows, and rows of
null or equal ids, are encoded one by one. Other columns come along where they are asked for by name, so that names can't
clash. An empty table gives an empty one. Ids that the vocabulary lacks are an error.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.llm.common import in_arrow, slices

#: A vocabulary file is sent to all workers; a larger one is an error.
MOST_BYTES = 64 << 20


@dataclass(frozen=True)
class Params:
    #: a file of lines "base64 of a token's bytes, rank"
    path: str
    #: what cuts a text into the pieces that merges don't cross
    pattern: str
    #: states of the transducer, and encoded pieces, that a worker keeps
    max_states: int = 100_000
    max_pieces: int = 300_000


def load(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line.strip())}


def merged(raw: bytes, ranks: dict[bytes, int], least: int = 1) -> list[bytes]:
    """What the merges make of some bytes, down to `least` parts: the lowest rank first, the leftmost of equal ones."""
    parts = [raw[i : i + 1] for i in range(len(raw))]
    while len(parts) > least:
        best, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if best == 1 << 60:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class State(dict):
    """A state's edges: byte to (what is written, next state), looked up in C and made where they are missing."""

    __slots__ = ("guesses", "machine", "rest")

    def __init__(self, guesses: tuple, machine: Transducer):
        self.guesses, self.machine = guesses, machine
        #: what is left to write at a piece's end, once it has been asked for
        self.rest: bytes | None = None

    def __missing__(self, byte: int) -> tuple[bytes, State]:
        return self.machine.step(self, byte)


def _packed(ids: tuple[int, ...]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Transducer:
    """Bytes to ids. Only tokens that merges lead to are guessed; a piece that is a token is that token in any case.

    max_states are kept; once they are there, further ones are made for the moment only, and when far more have been made
    so than are kept, all are dropped: those that texts pass often come back first."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 40_000):
        self.ranks, self.max_states = ranks, max_states
        #: a token's two halves, those of its last merge; a byte has none
        self.halves: dict[int, tuple[int, int]] = {}
        self.pairs: dict[int, int] = {}
        #: the tree of tokens: node and byte to node; a node's token, and whether longer tokens pass it
        self.edge: dict[int, int] = {}
        self.token, self.inner = [-1], [True]
        for t, i in ranks.items():
            if len(t) > 1:
                two = self._last_two(t)
                if two is None:
                    continue
                self.halves[i] = two
                self.pairs[two[0] << 32 | two[1]] = i
            self._plant(t, i)
        self._fits: dict[int, bool] = {}
        self.start = State((((), -1, 0),), self)
        self.known: dict[tuple, State] = {}
        self.passing = 0

    def _last_two(self, token: bytes) -> tuple[int, int] | None:
        """What the token's last merge joins; None if the merges of its bytes don't lead to it."""
        two = merged(token, self.ranks, 2)  # if there are two, the token itself is their merge
        return (self.ranks[two[0]], self.ranks[two[1]]) if len(two) == 2 else None

    def _plant(self, token: bytes, i: int) -> None:
        node = 0
        for b in token:
            self.inner[node] = True
            to = self.edge.get(node << 8 | b)
            if to is None:
                to = self.edge[node << 8 | b] = len(self.token)
                self.token.append(-1)
                self.inner.append(False)
            node = to
        self.token[node] = i

    def fits(self, a: int, b: int) -> bool:
        """Whether the merges of a's and b's bytes leave a and b: going back through the merges on either side of the border,
        the latest first, no two neighbours there would have merged before the one that is undone."""
        got = self._fits.get(a << 32 | b)
        if got is not None:
            return got
        if len(self._fits) >= 5 * self.max_states:
            self._fits.clear()
        key, until, ok = a << 32 | b, 1 << 40, True
        while True:
            joined = self.pairs.get(a << 32 | b)
            if joined is not None and joined < until:
                ok = False
                break
            # on the left, the merge of a came before an equal one on the right
            if a in self.halves and (a > b or b not in self.halves):
                until, a = a, self.halves[a][1]
            elif b in self.halves:
                until, b = b + 1, self.halves[b][0]
            else:
                break
        self._fits[key] = ok
        return ok

    def step(self, s: State, byte: int) -> tuple[bytes, State]:
        guesses = []
        edge, token, inner, fits = self.edge.get, self.token, self.inner, self._fits.get
        for written, last, node in s.guesses:
            to = edge(node << 8 | byte)
            if to is not None:
                if inner[to]:
                    guesses.append((written, last, to))
                t = token[to]
                if t >= 0:
                    ok = last < 0 or fits(last << 32 | t)
                    if self.fits(last, t) if ok is None else ok:
                        guesses.append(((*written, t), t, 0))
        first = guesses[0][0]
        n = len(first)
        for written, _, _ in guesses:
            if written is not first:
                n = min(n, len(written))
                while n and written[:n] != first[:n]:
                    n -= 1
            if not n:
                break
        key = tuple((w[n:], last, node) for w, last, node in guesses) if n else tuple(guesses)
        t = self.known.get(key)
        if t is None:
            t = State(key, self)
            if len(self.known) >= self.max_states:
                self.passing += 1
                if self.passing <= 20 * self.max_states:
                    return _packed(first[:n]), t
                self.passing = 0
                self.known.clear()
                self.start.clear()
            self.known[key] = t
        s[byte] = out = (_packed(first[:n]), t)
        return out

    def encode(self, piece: bytes) -> bytes:
        """The ids of one piece, as 32-bit integers in little-endian order."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return _packed((whole,))
        out, s = [], self.start
        for byte in piece:
            written, s = s[byte]
            if written:
                out.append(written)
        if s.rest is None:
            s.rest = _packed(next(written for written, _, node in s.guesses if not node))
        out.append(s.rest)
        return b"".join(out)


class Pieces(dict):
    """Pieces by text, with their ids: looked up in C, encoded where they are missing. When there are too many, they stay
    for one more turn in which those that are asked for come back. Long ones aren't kept."""

    def __init__(self, machine: Transducer, most: int):
        super().__init__()
        self.machine, self.most = machine, most
        self.before: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        got = self.before.get(piece)
        if got is None:
            got = self.machine.encode(piece.encode("utf-8", "surrogatepass"))
        if len(piece) <= 32:
            if len(self) >= self.most:
                self.before = dict(self)
                self.clear()
            self[piece] = got
        return got


# --- UTF-8 -------------------------------------------------------------------------------------------------

#: States: 0 between characters, 1 malformed, 2 to 4 that many less one following bytes to come, 5 to 8 those whose next
#: byte has a narrower range.
ACCEPT, REJECT = 0, 1
#: Fixed values of UTF-8: (state, first byte, last byte, next state); all else is malformed.
EDGES = [
    (0, 0x00, 0x7F, 0), (0, 0xC2, 0xDF, 2), (0, 0xE0, 0xE0, 5), (0, 0xE1, 0xEC, 3), (0, 0xED, 0xED, 6), (0, 0xEE, 0xEF, 3), (0, 0xF0, 0xF0, 7), (0, 0xF1, 0xF3, 4), (0, 0xF4, 0xF4, 8),
    (2, 0x80, 0xBF, 0), (3, 0x80, 0xBF, 2), (4, 0x80, 0xBF, 3), (5, 0xA0, 0xBF, 2), (6, 0x80, 0x9F, 2), (7, 0x90, 0xBF, 3), (8, 0x80, 0x8F, 3),
]
STEP = [[REJECT] * 256 for _ in range(9)]
for _s, _a, _z, _t in EDGES:
    STEP[_s][_a : _z + 1] = [_t] * (_z + 1 - _a)
REPLACEMENT = "\ufffd".encode()


class Utf8:
    """Bytes in any portions to whole characters; a malformed stretch becomes one replacement character for each of its
    longest beginnings of a character."""

    def __init__(self):
        self.state, self.held = ACCEPT, bytearray()

    def feed(self, raw: bytes) -> bytes:
        out, held, s = bytearray(), self.held, self.state
        for b in raw:
            t = STEP[s][b]
            if t == REJECT:
                if s != ACCEPT:  # the character breaks off; this byte may begin another
                    out += REPLACEMENT
                    held.clear()
                    t = STEP[ACCEPT][b]
                if t == REJECT:
                    out += REPLACEMENT
                    s = ACCEPT
                    continue
            held.append(b)
            if t == ACCEPT:
                out += held
                held.clear()
            s = t
        self.state = s
        return bytes(out)

    def finish(self) -> bytes:
        """What an unfinished character leaves."""
        broken, self.state = self.state != ACCEPT, ACCEPT
        self.held.clear()
        return REPLACEMENT if broken else b""


class Decoder:
    """Ids in any portions to UTF-8. Between characters a token of whole ones passes as it is; only the others take the
    state machine byte by byte."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        self.whole = np.zeros(len(self.tokens), bool)
        self.has = np.zeros(len(self.tokens), bool)
        for t, i in ranks.items():
            self.tokens[i], self.has[i], self.whole[i] = t, True, Utf8().feed(t) == t
        #: all tokens' bytes in one buffer
        self.flat = np.frombuffer(b"".join(self.tokens) or b"\0", np.uint8)
        self.size = np.fromiter(map(len, self.tokens), np.int64, len(self.tokens))
        self.begin = np.cumsum(self.size) - self.size
        self.utf8 = Utf8()

    def feed(self, ids: np.ndarray) -> bytes:
        if len(ids) and (int(ids.max()) >= len(self.tokens) or not self.has[ids].all()):
            raise ValueError("an id that the vocabulary lacks")
        # every place of the bytes is its token's place in the buffer and what it is behind that token's begin
        size = self.size[ids]
        end = np.cumsum(size)
        at = np.repeat(self.begin[ids] - end + size, size)
        at += np.arange(len(at))
        raw = self.flat[at].tobytes()
        open_ = np.flatnonzero(~self.whole[ids]).tolist()
        if len(ids) and self.utf8.state != ACCEPT:
            open_ = [0, *open_]
        if not open_:
            return raw
        out, done, to = [], 0, 0
        for k in open_:
            if k < to:
                continue
            out.append(raw[done : int(end[k] - size[k])])
            to = k
            while to < len(ids):
                out.append(self.utf8.feed(self.tokens[ids[to]]))
                to += 1
                if self.utf8.state == ACCEPT:
                    break
            done = int(end[to - 1])
        out.append(raw[done:])
        return b"".join(out)

    def finish(self) -> bytes:
        return self.utf8.finish()


# --- tables ------------------------------------------------------------------------------------------------


def _sent(spark: SparkSession, path: str) -> tuple[object, str]:
    """A vocabulary file, read once and sent to all workers, and the hash under which they keep what they make of it."""
    raw = Path(path).read_bytes()
    if len(raw) > MOST_BYTES:
        raise ValueError(f"{path} has more than {MOST_BYTES} bytes")
    return spark.sparkContext.broadcast(raw), hashlib.sha256(raw).hexdigest()


_kept: dict[tuple, object] = {}


def _kept_by(key: tuple, make):
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def encode(d: DataFrame, p: Params, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of d, n_tokens, and ids: 32-bit integers in little-endian order."""
    held, name = _sent(d.sparkSession, p.path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _kept_by((name, p.max_states, p.max_pieces), lambda: Pieces(Transducer(load(held.value), p.max_states), p.max_pieces))
        cut, ids = regex.compile(p.pattern).findall, pieces.__getitem__
        for whole in batches:
            for b in slices(whole, "_text"):
                gc.disable()  # the states that a stretch makes stay; to go through them again and again frees nothing
                try:
                    out = [b"".join(map(ids, cut(t))) if t else b"" for t in b.column(b.schema.get_field_index("_text")).to_pylist()]
                finally:
                    gc.enable()
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([len(x) // 4 for x in out], pa.int64()), pa.array(out, pa.binary())], [*b.schema.names[:-1], "n_tokens", "ids"])

    made = d.select(*(f"`{c}`" for c in keep), d[f"`{text}`"].cast("string").alias("_text"))
    return in_arrow(made, run, T.StructType([*made.schema.fields[:-1], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]))


def decode(d: DataFrame, p: Params, ids: str = "ids", portion: int = 1 << 16) -> DataFrame:
    """d without its ids, with decoded: the UTF-8 bytes of the text, made of so many ids at a time. Ids that don't make
    UTF-8 leave replacement characters. Null ids are none."""
    held, name = _sent(d.sparkSession, p.path)
    rest = [c for c in d.columns if c != ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _kept_by((name,), lambda: Decoder(load(held.value)))
        for whole in batches:
            for b in slices(whole, "_ids"):
                out = []
                for x in b.column(b.schema.get_field_index("_ids")).to_pylist():
                    a = np.frombuffer(x or b"", "<u4")
                    made.utf8 = Utf8()
                    out.append(b"".join([*(made.feed(a[i : i + portion]) for i in range(0, len(a), portion)), made.finish()]))
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, pa.binary())], [*b.schema.names[:-1], "decoded"])

    made = d.select(*(f"`{c}`" for c in rest), d[f"`{ids}`"].alias("_ids"))
    return in_arrow(made, run, T.StructType([*made.schema.fields[:-1], T.StructField("decoded", T.BinaryType())]))
