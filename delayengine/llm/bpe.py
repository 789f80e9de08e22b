"""Byte-level BPE as a transducer over longest matches, and streaming decoding.

Encoding. A sequence of tokens is an encoding exactly when each two neighbours are the encoding of their
joined bytes, and a text has one encoding. So a transducer suffices whose state is the last token: it reads the
longest token that matches the bytes ahead and writes the longest of that token's prefixes that may follow. If
nothing may, the last token gives way to its next shorter prefix; a place from which no way went on is not
entered again, so the time follows the number of bytes. Transitions are made when first met. Beyond a fixed number
they are used once and not kept, and after many such all are thrown away, so memory is bounded whatever the text.

Decoding. Blocks of ids become bytes by one numpy gather; a UTF-8 state machine
carries an unfinished character from block to block.

Null texts are empty texts; empty texts have no ids; null ids decode to the empty text.
Rows are handled one by one, so repeated rows, ties and extra columns change nothing.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import itertools
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delayengine.llm.scratch import alone, holds
from delayengine.llm.words import pieces

MAX_VOCABULARY_BYTES = 64 << 20
MAX_STATES = 250_000  # some 20 MB
FEW_STATES = 80_000
MAX_PIECES = 300_000
BLOCK = 65_536
_NONE: dict = {}


def _trie(words: list[bytes], ranks: dict[bytes, int], depth: int = 0) -> tuple[dict, int]:
    """The node of the words' first ``depth`` bytes, which they share: its children by byte, and the token that ends there, or -1."""
    own = -1
    if len(words[0]) == depth:  # in order, the shortest comes first
        own, words = ranks[words[0]], words[1:]
    children = {b: _trie(list(group), ranks, depth + 1) for b, group in itertools.groupby(words, lambda w: w[depth])}
    return children or _NONE, own


def _prefixes(words: list[bytes], ranks: dict[bytes, int]) -> dict[int, int]:
    """For each token the longest shorter one that it begins with, or -1; the words are in order."""
    out, around = {}, []
    for word in words:
        while around and not word.startswith(around[-1]):
            around.pop()
        out[ranks[word]] = ranks[around[-1]] if around else -1
        around.append(word)
    return out


class Transducer:
    """Encodes one piece of text, token by token; ``ranks`` maps a token's bytes to its id, later than its two halves' ids.

    ``states``: for a last token (-1 before the first) and a matching one, the longest prefix of the latter that may
    follow the former, or -1.
    """

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks, self.max_states = ranks, max_states
        self.tokens = {v: k for k, v in ranks.items()}
        words = sorted(w for w in ranks if w)
        self.root = _trie(words, ranks)[0] if words else _NONE
        self.shorter = _prefixes(words, ranks)
        self.longest = max(map(len, words), default=0)
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.states: dict[int, int] = {}
        self.missed = 0

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte, and for a token that merges never make."""
        if token not in self.halves:
            word = self.tokens[token]
            parts = [word[i:i + 1] for i in range(len(word))]
            while len(parts) > 2:  # BPE by its definition, short of the last merge
                rank, i = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(itertools.pairwise(parts)))
                if rank == 1 << 60:
                    break
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            self.halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self.halves[token]

    def _may_follow(self, left: int, right: int) -> bool:
        """Whether the encoding of both tokens' bytes is these two tokens: no merge across the seam comes before theirs.

        The merges of both tokens are undone from the latest to the earliest. A pair of neighbours across the
        seam that is a token itself would have merged, had its turn come before the merge that was undone last.
        A token that merges never make follows nothing.
        """
        if not self._made(right):
            return False
        if left < 0:
            return True
        a, b, turn = left, right, 1 << 60
        while True:
            over = self.ranks.get(self.tokens[a] + self.tokens[b], 1 << 60)
            if over < turn:
                return False
            if a > b:
                halves = self._halves(a)
                if halves:
                    a, turn = halves[1], a
                elif (halves := self._halves(b)) and b < turn:
                    b, turn = halves[0], b + 1
                else:
                    return True
            else:
                halves = self._halves(b)
                if halves:
                    b, turn = halves[0], b + 1
                elif halves := self._halves(a):
                    a, turn = halves[1], a
                else:
                    return True

    def _made(self, token: int) -> bool:
        """Whether merges make this token, so that it can stand in an encoding."""
        return len(self.tokens[token]) == 1 or self._halves(token) is not None

    def _match(self, data: bytes, at: int) -> int:
        """The longest token that the bytes begin with at a place, or -1."""
        children, found = self.root, -1
        for byte in data[at:at + self.longest]:
            node = children.get(byte)
            if node is None:
                break
            children, token = node
            if token >= 0:
                found = token
        return found

    def _step(self, left: int, token: int) -> int:
        key = left << 32 | token
        while token >= 0 and not self._may_follow(left, token):
            token = self.shorter[token]
        if len(self.states) < self.max_states:
            self.states[key] = token
        else:  # full: the transition is used once, those met first stay
            self.missed += 1
        return token

    def encode(self, data: bytes) -> list[int]:
        if self.missed > 8 * self.max_states:  # the texts may have changed
            self.states.clear()
            self.missed = 0
        known, tokens, match = self.states.get, self.tokens, self._match
        out, left, at, end, closed = [], -1, 0, len(data), set()
        token = match(data, 0)
        while at < end:
            if token >= 0:
                found = known(left << 32 | token)
                token = self._step(left, token) if found is None else found
            if token < 0:  # no way goes on from here
                if not out:
                    raise ValueError(f"the vocabulary has no tokens for {data[:64]!r}")
                closed.add(at)
                last = out.pop()
                at -= len(tokens[last])
                left, token = out[-1] if out else -1, self.shorter[last]
                continue
            to = at + len(tokens[token])
            if to in closed:
                token = self.shorter[token]
                continue
            out.append(token)
            left, at = token, to
            token = match(data, at)
        return out


class _Met(dict):
    """Pieces met lately with their ids as int32 bytes; it encodes what it lacks.

    At half of ``MAX_PIECES`` the pieces become the old ones; of those, what is met again is kept.
    """

    def __init__(self, ranks: dict[bytes, int], max_states: int):
        super().__init__()
        self.ranks, self.transducer = ranks, Transducer(ranks, max_states)
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            data = piece.encode()
            whole = self.ranks.get(data)  # a piece that is a token stays whole, whether or not merges make it
            ids = array("i", self.transducer.encode(data) if whole is None else (whole,)).tobytes()
        if len(piece) <= 64:
            if len(self) >= MAX_PIECES // 2:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """A vocabulary with its transducer, the pieces met lately, and the way back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_states: int = MAX_STATES):
        self.find = regex.compile(pattern).findall
        self.met = _Met(ranks, max_states)
        size = max(ranks.values(), default=-1) + 1
        self.lengths = np.zeros(size, np.int64)
        for token, i in ranks.items():
            self.lengths[i] = len(token)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.zeros(int(self.lengths.sum()), np.uint8)
        for token, i in ranks.items():
            self.bytes[self.starts[i]:self.starts[i] + len(token)] = np.frombuffer(token, np.uint8)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.met.__getitem__, self.find(text))), np.int32)

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        shift = np.repeat(self.starts[ids] - (np.cumsum(lengths) - lengths), lengths)
        return self.bytes[shift + np.arange(len(shift))].tobytes()

    def decode(self, ids: np.ndarray, block: int = BLOCK) -> str:
        stream = Utf8Stream()
        parts = [stream.feed(self.decode_bytes(ids[i:i + block])) for i in range(0, len(ids), block)]
        return "".join([*parts, stream.end()])


def _transitions() -> tuple[dict[int, tuple[int, int, int]], ...]:
    """For each lead byte: bytes still to come, and the range allowed for the next one."""
    lead = {b: (1, 0x80, 0xBF) for b in range(0xC2, 0xE0)}
    lead |= {b: (2, 0xA0 if b == 0xE0 else 0x80, 0x9F if b == 0xED else 0xBF) for b in range(0xE0, 0xF0)}
    lead |= {b: (3, 0x90 if b == 0xF0 else 0x80, 0x8F if b == 0xF4 else 0xBF) for b in range(0xF0, 0xF5)}
    return (lead,)


(_LEAD,) = _transitions()


class Utf8Stream:
    """Gives the finished characters of each block of bytes; what can't be UTF-8 becomes U+FFFD."""

    def __init__(self):
        self.kept = b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """How many last bytes begin a character that further bytes can finish: the machine, run from the last lead byte."""
        for back in range(1, min(3, len(data)) + 1):
            if data[-back] in _LEAD:
                left, low, high = _LEAD[data[-back]]
                for byte in data[len(data) - back + 1:]:
                    if not low <= byte <= high:
                        return 0
                    left, low, high = left - 1, 0x80, 0xBF
                return back if left > 0 else 0
            if not 0x80 <= data[-back] <= 0xBF:
                return 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.kept + data
        cut = len(data) - self.unfinished(data)
        self.kept = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        kept, self.kept = self.kept, b""
        return kept.decode("utf-8", "replace")


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    """Lines of a base64 token and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in raw.splitlines() if line)}


@lru_cache(maxsize=2)
def _codec(digest: str, pattern: str, max_states: int, holder) -> Codec:
    alone("byte_bpe")  # what earlier operators left in the worker is not there for small objects to use
    codec = Codec(parse_ranks(holder.raw), pattern, max_states)
    gc.freeze()  # the vocabulary lives as long as the worker: its objects need not be visited again
    return codec


def _forget() -> None:
    if _codec.cache_info().currsize:
        _codec.cache_clear()
        gc.unfreeze()
        gc.collect()


holds("byte_bpe", _forget)


class _Raw:
    """A vocabulary file on its way to the cache; equal to every other, so the digest alone is the key."""

    def __init__(self, raw: bytes):
        self.raw = raw

    def __eq__(self, other) -> bool:
        return isinstance(other, _Raw)

    def __hash__(self) -> int:
        return 0


def _shared(df: DataFrame, vocabulary: str, pattern: str, max_states: int = MAX_STATES):
    """A function that gives the codec on any worker; the file's size is checked before it is broadcast."""
    with open(vocabulary, "rb") as file:
        raw = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(raw) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"a vocabulary file of over {MAX_VOCABULARY_BYTES} bytes")
    sent, digest = df.sparkSession.sparkContext.broadcast(raw), hashlib.sha256(raw).hexdigest()
    return lambda: _codec(digest, pattern, max_states, _Raw(sent.value))


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values)))


def _added(df: DataFrame, name: str, kind: str) -> StructType:
    if name in df.columns:
        raise ValueError(f"there already is a column {name}")
    return StructType([*df.schema.fields, *StructType.fromDDL(f"`{name}` {kind}").fields])


def encode(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the token ids of each text as an array in the new column ``ids``."""
    codec = _shared(docs, vocabulary, pattern)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec()
        for batch in batches:
            for piece in pieces(batch, text):
                found = _lists([own.encode(t or "") for t in piece.column(text).to_pylist()])
                yield pa.RecordBatch.from_arrays([*piece.columns, found], [*piece.schema.names, ids])

    return docs.mapInArrow(run, _added(docs, ids, "array<int>"))


def decode(coded: DataFrame, vocabulary: str, pattern: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``coded`` with the text of each array of ids in the new column ``text``. An unknown id fails."""
    codec = _shared(coded, vocabulary, pattern)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec()
        for batch in batches:
            column = batch.column(ids)
            flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(column.value_lengths().fill_null(0))
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [own.decode(flat[(ends[i - 1] if i else 0):ends[i]]) for i in range(start, start + part.num_rows)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string())], [*part.schema.names, text])

    return coded.mapInArrow(run, _added(coded, text, "string"))


def round_trip(
    docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", max_states: int = FEW_STATES
) -> DataFrame:
    """``docs`` with ``encode``'s ids and ``decode``'s text of them instead of the text, by one worker a task: each worker holds a codec.

    It keeps few states unless told otherwise, as it ends a job whose earlier stages have made their executors large.
    """
    codec = _shared(docs, vocabulary, pattern, max_states)
    rest = [c for c in docs.columns if c != text]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec()
        for batch in batches:
            for piece in pieces(batch, text):
                coded = [own.encode(t or "") for t in piece.column(text).to_pylist()]
                texts = pa.array([own.decode(x) for x in coded], pa.string())
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in rest), _lists(coded), texts], [*rest, ids, decoded])

    kept = docs.select(*[F.col(f"`{c}`") for c in rest])
    return docs.mapInArrow(run, _added(kept, ids, f"array<int>, `{decoded}` string"))


def digest_columns(ids: str = "ids", decoded: str = "decoded") -> list[Column]:
    """ids_sha256, of the decimal ids joined by commas, and decoded_sha256."""
    joined = F.array_join(F.col(ids).cast("array<string>"), ",")
    return [F.sha2(joined.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col(decoded).cast("binary"), 256).alias("decoded_sha256")]


def digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each text."""
    coded = round_trip(docs.select("doc_id", "text"), vocabulary, pattern, max_states=MAX_STATES)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), *digest_columns())
