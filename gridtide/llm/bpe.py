"""Byte-level BPE encoding by a lazily determinised finite-state transducer, and streaming decoding.

Encoding. Of a prefix of a piece, the BPE encoding ends in one token; cutting that token off leaves the encoding of a shorter prefix. So the
encodings of all prefixes form a tree, and the next byte adds one node: the token that ends there starts at the one earlier position whose own
last token may stand before it. Two tokens may stand together if and only if merging their bytes gives these two tokens; that makes the whole
encoding valid, pair by pair. A position is live while the bytes after it begin some token of the vocabulary. What all live positions have
in common is settled and emitted. The state is the last settled token with the bytes after it, which are fewer than those of the longest
token: the lookahead is bounded. States and their steps are made when first met and kept in a table.

Decoding. Bytes of tokens go through an incremental UTF-8 automaton, which holds back the bytes of a character that is not complete.

Tables that are kept are emptied when they reach a fixed size, so memory is bounded; what is returned does not depend on that.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.llm.common import kept, ship

#: entries of the tables, at most (of pairs and pieces, in each of two generations)
KEPT_STATES = 250_000
KEPT_PAIRS = 25_000
KEPT_PIECES = 220_000
#: characters of a piece that is kept; longer ones are rare and are encoded anew
KEPT_CHARS = 64
#: bytes between looks at the number of states; characters whose pieces are encoded at a time, or more up to a place to cut
STRIDE, SLICE = 1 << 12, 1 << 20
#: bytes of text in a batch of results; ids that are decoded at a time
BATCH_BYTES = 1 << 20
DECODE_IDS = 1 << 16
#: white space as Unicode's White_Space has it (Python's \\s also has four control characters)
SPACE = "\t-\r \x85\xa0  -     　"


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with lines of base64 bytes and rank. The file has the size of a vocabulary; it is read on the driver."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}

# the transducer


class Kept(dict):
    """What ``make`` gives for a key, kept for two generations: what is asked for again outlives the rest."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def keep(self, key, value) -> None:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self.keep(key, value)
        return value


BYTES = [bytes((i,)) for i in range(256)]


def _named(pending: bytes, token: int) -> bytes:
    return pending + token.to_bytes(4, "little", signed=True)


class Transducer:
    """Encodes pieces of bytes.

    A state holds the bytes since the last settled token and, for each position on a path of live ones, the token that ends there. The settled
    token itself is told apart only while it matters: while another token may start right after it, and some merge could join the two. That
    token and the bytes tell a state from all others. States are numbered by 256, so that a number with a byte added is the key of a step; the
    tables hold numbers and bytes, which take little room and are not followed when Python looks for garbage.
    """

    def __init__(self, ranks: dict[bytes, int], kept_states: int = KEPT_STATES):
        self.ranks, self.kept = ranks, kept_states
        self.tokens = {i: t for t, i in ranks.items()}
        self.sizes = {i: len(t) for t, i in ranks.items()}
        #: of what begins a longer token, the least rank of such tokens
        self.prefixes: dict[bytes, int] = {}
        for token, rank in ranks.items():
            for n in range(1, len(token)):
                begin = token[:n]
                if self.prefixes.get(begin, rank) >= rank:
                    self.prefixes[begin] = rank
        self.halves = Kept(self._halves, len(ranks))
        self.alone = Kept(self._alone, len(ranks))
        self.pairs = Kept(self._fits, KEPT_PAIRS)
        self.weight = Kept(self._matters, KEPT_PAIRS)
        self._reset()

    def _reset(self) -> None:
        #: by number: the bytes of a state with the token before them in four more; the tokens that end at each position, None where there is no path
        self.states: list[bytes] = []
        self.ending: list[tuple] = []
        self.numbers: dict[bytes, int] = {}
        #: by state and byte: the next state, inverted if tokens are settled; these, packed; by state: what is left at the end, packed
        self.moves: dict[int, int] = {}
        self.settled: dict[int, bytes] = {}
        self.ends: dict[int, bytes] = {}
        self.start = self._number(_named(b"", -1), (-1,))

    def _number(self, state: bytes, ending: tuple) -> int:
        number = self.numbers.get(state)
        if number is None:
            number = self.numbers[state] = len(self.states) << 8
            self.states.append(state)
            self.ending.append(ending)
        return number

    def merge(self, piece: bytes, below: int = 1 << 60) -> list[bytes]:
        """BPE by its definition: the first of the pairs of lowest rank is merged, until no rank is below a limit."""
        parts, ranks = [piece[i : i + 1] for i in range(len(piece))], self.ranks
        while len(parts) > 1:
            best, at = min((ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if best >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes a token; None of a byte."""
        parts = self.merge(self.tokens[token], token)
        return (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None

    def _alone(self, token: int) -> bool:
        """Whether merging the bytes of a token gives the token."""
        return len(self.merge(self.tokens[token])) == 1

    def _fits(self, pair: int) -> bool:
        """Whether merging the bytes of two tokens gives these two; -1 stands for a left one that does not matter.

        Goes back in time from the two tokens: while two parts touch where the tokens meet, they must not have a rank that comes before the
        merge that took one of them away. Of equal ranks the left one is first.
        """
        left, right = (pair >> 32) - 1, pair & 0xFFFFFFFF
        if not self.alone[right]:
            return False
        before, ranks, tokens, halves = 1 << 60, self.ranks, self.tokens, self.halves
        while left >= 0:
            if ranks.get(tokens[left] + tokens[right], before) < before:
                return False
            a, b = halves[left], halves[right]
            if a and (not b or left > right):
                before, left = left, a[1]
            elif b:
                before, right = right + 1, b[0]
            else:
                break
        return True

    def _matters(self, pair: int) -> bool:
        """Whether a token can fail to fit before some token that begins with a byte.

        It cannot if none of the parts that touch its end could merge with bytes from there on before it was taken away.
        """
        before, token, byte = 1 << 60, pair >> 8, BYTES[pair & 255]
        while True:
            begin = self.tokens[token] + byte
            if min(self.ranks.get(begin, before), self.prefixes.get(begin, before)) < before:
                return True
            halves = self.halves[token]
            if not halves:
                return False
            before, token = token, halves[1]

    def _step(self, state: int, byte: int) -> int:
        """Make the step of a state."""
        pending, ending = self.states[state >> 8][:-4] + BYTES[byte], [*self.ending[state >> 8], None]
        size, ranks, prefixes, sizes, opened = len(pending), self.ranks, self.prefixes, self.sizes, []
        for at in range(size):
            token = ending[at]
            if token is not None:
                after = pending[at:]
                if ending[size] is None:
                    here = ranks.get(after)
                    if here is not None and self.pairs[token + 1 << 32 | here]:
                        ending[size] = here
                if after in prefixes:
                    opened.append(at)
        if ending[size] is None:
            raise ValueError("the vocabulary lacks a byte or a merge")
        # from the live positions back to the last one that all their paths share: what is before that is settled
        heads, left, root = {size, *opened}, len(opened), size
        made = [None] * (size + 1)
        while left:
            made[root] = token = ending[root]
            if root - sizes[token] in heads:
                left -= 1
            else:
                heads.add(root - sizes[token])
            root -= 1
            while root not in heads:
                root -= 1
        pending, top = pending[root:], ending[root]
        if top >= 0 and pending and not (root in opened and self.weight[top << 8 | pending[0]]):
            top = -1
        made[root] = top
        found = self._number(_named(pending, top), tuple(made[root:]))
        if root:
            self.settled[state | byte] = self._path(ending, root)
            found = ~found
        self.moves[state | byte] = found
        return found

    def _path(self, ending: Sequence, at: int) -> bytes:
        """The tokens up to a position, packed."""
        out = array("i")
        while at:
            out.append(ending[at])
            at -= self.sizes[ending[at]]
        out.reverse()
        return out.tobytes()

    def _end(self, state: int) -> bytes:
        """The tokens of the bytes that are left."""
        ending = self.ending[state >> 8]
        found = self.ends[state] = self._path(ending, len(ending) - 1)
        return found

    def encode(self, piece: bytes) -> bytes:
        """The ids of a piece, packed, four bytes each."""
        whole = self.ranks.get(piece)
        if whole is not None:  # a piece that is a token is that token, whether merges lead there or not
            return array("i", (whole,)).tobytes()
        out, state = [], self.start
        for at in range(0, len(piece), STRIDE):
            if len(self.states) > self.kept:  # begin anew, from this state
                packed, ending = self.states[state >> 8], self.ending[state >> 8]
                self._reset()
                state = self._number(packed, ending)
            moves = self.moves
            for byte in piece[at : at + STRIDE]:
                step = state | byte
                try:
                    state = moves[step]
                except KeyError:
                    state = self._step(state, byte)
                if state < 0:
                    state = ~state
                    out.append(self.settled[step])
        left = self.ends.get(state)
        out.append(self._end(state) if left is None else left)
        return b"".join(out)


    def encode_each(self, pieces: Iterable[bytes]) -> Iterator[bytes]:
        """The ids of each piece, packed. The bytes with which it begins like the one before it are not gone through again: sorted pieces share most."""
        last, moves = b"", None
        for piece in pieces:
            if piece in self.ranks or len(piece) > STRIDE:
                yield self.encode(piece)
                continue
            if len(self.states) > self.kept:
                self._reset()
            if moves is not self.moves:  # emptied: no state from before holds
                last, moves, trail, out = b"", self.moves, [self.start], []
            same = 0
            for a, b in zip(last, piece, strict=False):
                if a != b:
                    break
                same += 1
            del trail[same + 1 :], out[same:]
            state = trail[same]
            for byte in piece[same:]:
                step = state | byte
                try:
                    state = moves[step]
                except KeyError:
                    state = self._step(state, byte)
                if state < 0:
                    state = ~state
                    out.append(self.settled[step])
                else:
                    out.append(b"")
                trail.append(state)
            left, last = self.ends.get(state), piece
            yield b"".join(out) + (self._end(state) if left is None else left)


class Encoder:
    """Texts to ids. Keeps the ids of pieces, packed; long pieces are not kept, so that what is kept is bounded in bytes, too."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = Transducer(ranks)
        self.vocabulary = Vocabulary(self.transducer.tokens)
        self.pattern = regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]"))
        # a space between two characters that are not white space always begins a piece, and what follows does not depend on what is before
        self.cut = re.compile(f" (?=[^{SPACE}])(?<=[^{SPACE}] )")
        self.pieces = Kept(None, KEPT_PIECES)

    def encode(self, text: str) -> bytes:
        """The ids, four bytes each."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text, four bytes each. Pieces are looked up, and new ones encoded in sorted order, about ``SLICE`` characters at a time."""
        out, pieces, ends, size = [[] for _ in texts], [], [], 0
        for i, text in enumerate(texts):
            at = 0
            while at < len(text):
                end = self.cut.search(text, at + SLICE - size) if len(text) - at > SLICE - size else None
                end = end.start() if end else len(text)
                pieces += self.pattern.findall(text, at, end)
                ends.append((i, len(pieces)))
                at, size = end, size + end - at
                if size >= SLICE:
                    self._encode(pieces, ends, out)
                    pieces, ends, size = [], [], 0
        self._encode(pieces, ends, out)
        return [b"".join(parts) for parts in out]

    def _encode(self, pieces: list[str], ends: list[tuple[int, int]], out: list[list[bytes]]) -> None:
        """Puts the ids of pieces to the texts that they are of."""
        if not pieces:
            return
        coded = pa.array(pieces, pa.large_string()).dictionary_encode()
        names, older = coded.dictionary.to_pylist(), self.pieces.older
        found = list(map(self.pieces.get, names))
        new = [i for i, ids in enumerate(found) if ids is None]
        for i in new:
            found[i] = older.get(names[i])
        unknown = sorted((names[i].encode(), i) for i in new if found[i] is None)
        for (_, i), ids in zip(unknown, self.transducer.encode_each(piece for piece, _ in unknown), strict=True):
            found[i] = ids
        for i in new:
            if len(names[i]) <= KEPT_CHARS:
                self.pieces.keep(names[i], found[i])
        offsets, ids = _buffers(pa.array(found, pa.large_binary()).take(coded.indices))
        start = 0
        for i, end in ends:
            out[i].append(ids[offsets[start] : offsets[end]])
            start = end


def _buffers(values: pa.LargeBinaryArray) -> tuple[np.ndarray, bytes]:
    """Offsets and all bytes of an array that Arrow has just made."""
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(values) + 1)
    return offsets, data[: offsets[-1]].to_pybytes()


# decoding


def _utf8_automaton() -> list[bytes]:
    """By state, the next state for each byte: 0 complete, 1 wrong, above: continuation bytes are due."""
    wrong, one, two, three, no_overlong3, no_surrogate, no_overlong4, no_beyond = 1, 2, 3, 4, 5, 6, 7, 8

    def ranges(*given: tuple[int, int, int]) -> bytes:
        row = bytearray([wrong]) * 256
        for low, high, state in given:
            row[low : high + 1] = bytes([state]) * (high + 1 - low)
        return bytes(row)

    start = ranges(
        (0, 0x7F, 0), (0xC2, 0xDF, one), (0xE0, 0xE0, no_overlong3), (0xE1, 0xEC, two), (0xED, 0xED, no_surrogate), (0xEE, 0xEF, two),
        (0xF0, 0xF0, no_overlong4), (0xF1, 0xF3, three), (0xF4, 0xF4, no_beyond),
    )
    return [
        start, ranges(), ranges((0x80, 0xBF, 0)), ranges((0x80, 0xBF, one)), ranges((0x80, 0xBF, two)), ranges((0xA0, 0xBF, one)),
        ranges((0x80, 0x9F, one)), ranges((0x90, 0xBF, two)), ranges((0x80, 0x8F, two)),
    ]


UTF8 = _utf8_automaton()


class Utf8Stream:
    """Bytes in, text out, in pieces of any size; what is wrong becomes U+FFFD, as in one call of ``bytes.decode(errors="replace")``."""

    def __init__(self):
        self.held = b""

    def feed(self, data: bytes) -> str:
        data = self.held + data
        whole = len(data)
        for back in range(1, min(3, whole) + 1):  # the start of a last character that may go on
            if data[-back] >= 0xC0:
                state = 0
                for byte in data[-back:]:
                    state = UTF8[state][byte]
                if state > 1:
                    whole -= back
                break
            if data[-back] < 0x80:
                break
        self.held = data[whole:]
        return data[:whole].decode("utf-8", "replace")

    def end(self) -> str:
        out, self.held = self.held.decode("utf-8", "replace"), b""
        return out


class Vocabulary:
    """Bytes of tokens by id."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens = pa.array([tokens.get(i) for i in range(max(tokens, default=-1) + 1)], pa.large_binary())

    def joined(self, ids: np.ndarray) -> bytes:
        taken = self.tokens.take(pa.array(ids))
        if taken.null_count:
            raise ValueError("an id stands for no token")
        return _buffers(taken)[1]


def decode_ids(ids: np.ndarray, vocabulary: Vocabulary) -> str:
    """The text of ids, a limited number of them at a time."""
    stream = Utf8Stream()
    return "".join(stream.feed(vocabulary.joined(ids[at : at + DECODE_IDS])) for at in range(0, len(ids), DECODE_IDS)) + stream.end()


# operators


def _mark(ranks: dict[bytes, int]) -> str:
    return hashlib.sha256(b"".join(b"%d %d %b" % (i, len(t), t) for t, i in ranks.items())).hexdigest()


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text", into: str = "ids", decoded: str | None = None
) -> DataFrame:
    """``docs`` with a column of ids (array of int) of the whole text, without special tokens, each match of ``pattern`` merged by itself.

    With ``decoded``, also a column of that name with the text that the ids decode to, as :func:`decode` gives it, in the same pass. A null text
    counts as empty, and has no ids; bytes that are not UTF-8 are read as U+FFFD. A very long text is cut where pieces end, and encoded part by part. New names must not be columns of ``docs``; the others are passed on as they are. The ranks are broadcast:
    they have the size of a vocabulary file.
    """
    names = [into] if decoded is None else [into, decoded]
    if set(names) & set(docs.columns):
        raise ValueError(f"there is a column of one of the names {names}")
    ship(docs.sparkSession)
    shared, key = docs.sparkSession.sparkContext.broadcast((ranks, pattern)), ("encode", pattern, _mark(ranks))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(key, lambda: Encoder(*shared.value))
        for batch in batches:
            for part in sliced(batch, at):
                packed = encoder.encode_all([(t.as_py() or b"").decode("utf-8", "replace") for t in part.column(at).cast(pa.binary())])
                offsets = np.cumsum([0] + [len(p) // 4 for p in packed], dtype=np.int32)
                columns = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), "<i4")))]
                if decoded is not None:
                    columns.append(pa.array([decode_ids(np.frombuffer(p, "<i4"), encoder.vocabulary) for p in packed], pa.string()))
                yield pa.record_batch([*part.columns, *columns], [*part.schema.names, *names])

    made = [T.StructField(into, T.ArrayType(T.IntegerType())), T.StructField(decoded or "", T.StringType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema, *made[: len(names)]]))


def decode(df: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with a column of the text that its ids stand for; null ids give an empty text. Bytes that are not UTF-8 become U+FFFD."""
    if into in df.columns:
        raise ValueError(f"there is a column {into}")
    ship(df.sparkSession)
    shared, key = df.sparkSession.sparkContext.broadcast(ranks), ("decode", _mark(ranks))
    at = df.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = kept(key, lambda: Vocabulary({i: t for t, i in shared.value.items()}))
        for batch in batches:
            for part in sliced(batch, at):
                rows = (x.values.to_numpy(zero_copy_only=False) if x.is_valid else [] for x in part.column(at))
                texts = pa.array([decode_ids(ids, vocabulary) for ids in rows], pa.string())
                yield pa.record_batch([*part.columns, texts], [*part.schema.names, into])

    return df.mapInArrow(run, T.StructType([*df.schema, T.StructField(into, T.StringType())]))


def sliced(batch: pa.RecordBatch, column: int, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes in a column, and a row at least."""
    values = batch.column(column)
    sizes = pc.binary_length(values) if not pa.types.is_list(values.type) else pc.multiply(pc.list_value_length(values), 4)
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, end - at)
        at = end


def digests(df: DataFrame, *more: str, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, more columns) of rows with ids and decoded text."""
    return df.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )
