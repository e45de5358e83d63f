"""Byte-level BPE by two tiers, and back.

1. A task marks the pre-tokens of a slice of texts with array operations on their bytes: runs of
   letters, numbers, other signs and white space, the space before a run, and the contractions.
2. First tier: a minimal perfect hash over the vocabulary gives each pre-token one slot. If the
   slot's token has the same bytes, its rank is the pre-token's only id.
3. Second tier: every other pre-token is a list of its bytes, linked to their neighbours, and a
   heap of the pairs that are tokens. The least rank, the leftmost of equals, is merged until
   no pair is left; that takes n log n steps for n bytes. What a task has merged it remembers.
4. Decoding puts the tokens' bytes one after the other.

The hash is hash-and-displace: keys fall into buckets, and the buckets, largest first, each get
the first displacement that sends their keys to free slots. It has as many slots as tokens. A
pattern other than the byte-level one above is matched by the `regex` module; the tiers are
the same. Which signs are letters, numbers or white space is asked of tiktoken's own pattern
engine, once in a process for each sign beyond ASCII that occurs.

No shuffle: a row's ids depend on the row alone, so neither a hot source nor copies matter, and
a lost task is run again. Memory: a slice of texts; one longer text is a slice of its own.

Defined cases: NULL and empty texts have no ids and decode to no bytes; repeated rows give
repeated rows; ties in the merge order are broken by place; an empty table gives an empty
table; columns of the input named as new ones are replaced. An id outside of the vocabulary,
and a vocabulary without all single bytes, are errors.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeworks.llm.byte_words import mixed, texts_of
from lodeworks.llm.common import sliced, table

# The pattern that the array operations know.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The vocabulary is broadcast; a larger file is refused.
MAX_VOCABULARY_BYTES = 64 << 20
SLICE_BYTES = 1 << 20
# Merged pre-tokens that a process remembers, and the longest of them in bytes.
MEMORY, MEMORY_BYTES = 300_000, 64
# No rank.
NONE = -1

_OTHER, _LETTER, _NUMBER, _SPACE = range(4)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_CODECS: dict[str, Codec] = {}


def _words(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray, k: int) -> np.ndarray:
    """Bytes 8k to 8k + 7 of each piece as one number, 0 beyond its end; `raw` has 8 spare bytes."""
    eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    left = np.clip(lengths - 8 * k, 0, 8)
    found = eight[np.where(left > 0, starts + 8 * k, 0)]
    keep = np.where(left >= 8, ~np.uint64(0), (np.uint64(1) << (np.minimum(left, 7) * 8).astype(np.uint64)) - np.uint64(1))
    return found & keep


def _padded(raw: np.ndarray) -> np.ndarray:
    return np.concatenate([raw, np.zeros(8, np.uint8)])


class PerfectHash:
    """A minimal perfect hash over distinct byte strings: `find` gives a piece's number, or -1."""

    def __init__(self, keys: list[bytes]) -> None:
        self.n = len(keys)
        self.lengths = np.array([len(k) for k in keys], np.int64)
        raw = _padded(np.frombuffer(b"".join(keys), np.uint8))
        starts = np.cumsum(self.lengths) - self.lengths
        depth = -(-int(self.lengths.max(initial=1)) // 8)
        self.words = np.stack([_words(raw, starts, self.lengths, k) for k in range(depth)])
        self.buckets = max(1, self.n // 4)
        for salt in range(64):
            self.salt = np.uint64(salt)
            if self._placed(self._hashed(self.words, self.lengths)):
                return
        raise ValueError("the keys are not distinct")

    def _hashed(self, words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = mixed(lengths.astype(np.uint64) * _STEP + self.salt)
        for k, word in enumerate(words):
            longer = lengths > 8 * k
            out[longer] = mixed((out[longer] ^ word[longer]) * _STEP + np.uint64(k))
        return out

    def _slots(self, hashes: np.ndarray, displaced: np.ndarray) -> np.ndarray:
        return (mixed(hashes + displaced.astype(np.uint64) * _STEP) >> np.uint64(32)) * np.uint64(self.n) >> np.uint64(32)

    def _bucket(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(32)) * np.uint64(self.buckets) >> np.uint64(32)

    def _placed(self, hashes: np.ndarray) -> bool:
        if len(np.unique(hashes)) < self.n:
            return False
        bucket = self._bucket(hashes).astype(np.int64)
        sizes = np.bincount(bucket, minlength=self.buckets)
        ordered = np.argsort(bucket, kind="stable")
        ends = np.cumsum(sizes)
        self.displacement = np.zeros(self.buckets, np.uint32)
        self.key_of_slot = np.full(self.n, -1, np.int64)
        for b in np.argsort(-sizes, kind="stable")[: np.count_nonzero(sizes)]:
            keys = ordered[ends[b] - sizes[b] : ends[b]]
            tried, many = 0, 16
            while True:
                slots = self._slots(hashes[keys][None, :], np.arange(tried, tried + many)[:, None]).astype(np.int64)
                free = (self.key_of_slot[slots] < 0).all(axis=1)
                for row in np.flatnonzero(free):
                    if len(keys) == 1 or len(np.unique(slots[row])) == len(keys):
                        self.displacement[b] = tried + row
                        self.key_of_slot[slots[row]] = keys
                        break
                else:
                    tried, many = tried + many, min(8192, many * 2)
                    continue
                break
        return True

    def find(self, raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """`raw` has 8 spare bytes at its end."""
        if not self.n or not len(starts):
            return np.full(len(starts), -1, np.int64)
        out = mixed(lengths.astype(np.uint64) * _STEP + self.salt)
        parts, at, most = [], np.arange(len(starts)), len(self.words)
        for k in range(most):
            at = at[lengths[at] > 8 * k]
            if not len(at):
                break
            word = _words(raw, starts[at], lengths[at], k)
            out[at] = mixed((out[at] ^ word) * _STEP + np.uint64(k))
            parts.append((at, word))
        key = self.key_of_slot[self._slots(out, self.displacement[self._bucket(out)])]
        same = self.lengths[key] == lengths
        for k, (at, word) in enumerate(parts):
            same[at] &= self.words[k][key[at]] == word
        return np.where(same, key, -1)


class _Signs:
    """The class of every code point that was met, from tiktoken's pattern engine."""

    def __init__(self) -> None:
        import tiktoken

        ranks = {bytes([b]): b for b in range(256)}
        for left in (b"a", b"1", b"!"):  # a sign joins the one before it if both are of one class
            for b in range(128, 256):
                ranks[left + bytes([b])] = len(ranks)
        self.toy = tiktoken.Encoding("signs", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
        self.known = np.full(0x110000, 255, np.uint8)
        self.known[:128] = _OTHER
        for low, high, kind in ((9, 13, _SPACE), (32, 32, _SPACE), (48, 57, _NUMBER), (65, 90, _LETTER), (97, 122, _LETTER)):
            self.known[low : high + 1] = kind
        self.known[0xD800:0xE000] = _OTHER

    def of(self, points: np.ndarray) -> np.ndarray:
        for point in np.unique(points[self.known[points] == 255]).tolist():
            joins = [self.toy.encode_ordinary(left + chr(point))[0] > 255 for left in "a1!"]
            self.known[point] = dict(enumerate((_LETTER, _NUMBER, _OTHER))).get(joins.index(True)) if any(joins) else _SPACE
        return self.known[points]


def _classes(raw: np.ndarray, signs: _Signs) -> tuple[np.ndarray, np.ndarray]:
    """Each byte's class, that of its sign, and which bytes begin a sign."""
    kinds = signs.known[raw & 127]
    lead = (raw & 0xC0) != 0x80
    wide = np.flatnonzero(raw >= 0xC0)
    if len(wide):
        first = raw[wide].astype(np.int64)
        more = np.where(first >= 0xF0, 3, np.where(first >= 0xE0, 2, 1))
        points = first & (0x3F >> more)
        for k in range(1, 4):
            longer = more >= k
            following = raw[np.minimum(wide[longer] + k, len(raw) - 1)] & 0x3F
            points[longer] = (points[longer] << 6) | following
        found = signs.of(np.minimum(points, 0x10FFFF))
        kinds[wide] = found
        for k in range(1, 4):
            longer = more >= k
            kinds[np.minimum(wide[longer] + k, len(raw) - 1)] = found[longer]
    return kinds, lead


def pieces(raw: np.ndarray, offsets: np.ndarray, signs: _Signs) -> np.ndarray:
    """Where the pre-tokens of BYTE_LEVEL begin, in texts that lie one after the other."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64)
    kinds, lead = _classes(raw, signs)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = edge[:n].copy()
    start[1:] |= kinds[1:] != kinds[:-1]
    # The last sign of a run of white space that something follows: a space goes with what follows,
    # any other is a piece of its own.
    ends = np.flatnonzero(start[1:] & ~edge[1:n] & (kinds[:-1] == _SPACE)) + 1
    last = ends - 1
    while True:
        inside = ~lead[last]
        if not inside.any():
            break
        last = last - inside
    start[last] = True
    start[ends[raw[last] == 32]] = False
    # Contractions: an apostrophe that begins a piece.
    quote = np.flatnonzero(start & (raw == 39))
    follows = np.concatenate([raw, np.zeros(2, np.uint8)])
    close = np.concatenate([edge, np.ones(2, bool)])
    one, two = follows[quote + 1], follows[quote + 2]
    room = ~close[quote + 1]
    short = room & np.isin(one, np.frombuffer(b"stmd", np.uint8))
    pair = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    long = room & ~close[quote + 2] & pair
    for of, size in ((short, 2), (long, 3)):
        at = quote[of]
        start[at + 1] = False
        rest = at + size
        start[rest[rest < n]] = True
    return np.flatnonzero(start)


def merged(piece: bytes, ranks: dict[bytes, int], two: list[int]) -> list[int]:
    """The ids of one pre-token, by a heap of pairs over linked bytes; `two` has the rank of each pair of bytes, or NONE."""
    n = len(piece)
    end = list(range(1, n + 1))  # a part is piece[at:end[at]]; the next part begins there
    before = list(range(-1, n))
    pair = [two[a << 8 | b] for a, b in zip(piece, piece[1:])]
    heap = [(rank, at) for at, rank in enumerate(pair) if rank != NONE]
    pair.append(NONE)
    heapify(heap)
    while heap:
        rank, at = heappop(heap)
        if pair[at] != rank:  # one of its parts was merged meanwhile
            continue
        middle = end[at]
        stop = end[at] = end[middle]
        pair[middle] = NONE
        before[stop] = at
        if stop < n:
            rank = pair[at] = ranks.get(piece[at : end[stop]], NONE)
            if rank != NONE:
                heappush(heap, (rank, at))
        else:
            pair[at] = NONE
        left = before[at]
        if left >= 0:
            rank = pair[left] = ranks.get(piece[left:stop], NONE)
            if rank != NONE:
                heappush(heap, (rank, left))
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at : end[at]]])
        at = end[at]
    return out


class Codec:
    """A ranked vocabulary, both tiers, in one process."""

    def __init__(self, tokens: list[bytes], ranks: list[int], pattern: str, tier: PerfectHash) -> None:
        self.rank_of = np.array(ranks, np.int64)
        self.ranks = dict(zip(tokens, ranks))
        self.pattern, self.tier, self.memory = pattern, tier, {}
        self.signs = _Signs()
        self.two = [self.ranks.get(bytes([a, b]), NONE) for a in range(256) for b in range(256)]
        # For decoding: all bytes in the order of the ids.
        of_id: list[bytes | None] = [None] * (max(ranks) + 1)
        for token, rank in zip(tokens, ranks):
            of_id[rank] = token
        self.present = np.array([t is not None for t in of_id])
        self.sizes = np.array([len(t or b"") for t in of_id], np.int64)
        self.places = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(t or b"" for t in of_id), np.uint8)

    def _starts(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pre-tokens."""
        if self.pattern == BYTE_LEVEL:
            starts = pieces(raw, offsets, self.signs)
            return starts, np.append(starts[1:], len(raw))
        import regex

        spans: list[tuple[int, int]] = []
        compiled, data = regex.compile(self.pattern), raw.tobytes()
        for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            text = data[low:high].decode("utf-8", "replace")
            at, place = low, 0
            for found in compiled.finditer(text):
                if found.end() > found.start():
                    at += len(text[place : found.start()].encode())
                    size = len(found.group().encode())
                    spans.append((at, at + size))
                    at, place = at + size, found.end()
        both = np.array(spans, np.int64).reshape(-1, 2)
        return both[:, 0], both[:, 1]

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the n + 1 places where texts begin in them."""
        starts, ends = self._starts(raw, offsets)
        key = self.tier.find(_padded(raw), starts, ends - starts)
        counts = np.ones(len(starts), np.int64)
        missed = np.flatnonzero(key < 0)
        found: list[bytes] = []
        data, known = raw.tobytes() if len(missed) else b"", self.memory
        for low, high in zip(starts[missed].tolist(), ends[missed].tolist()):
            piece = data[low:high]
            ids = known.get(piece)
            if ids is None:
                ids = array("I", merged(piece, self.ranks, self.two)).tobytes()
                if len(piece) <= MEMORY_BYTES:
                    if len(known) >= MEMORY:
                        known.clear()
                    known[piece] = ids
            found.append(ids)
        counts[missed] = [len(ids) // 4 for ids in found]
        first = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
        out = np.empty(int(first[-1]), np.int64)
        hit = key >= 0
        out[first[:-1][hit]] = self.rank_of[key[hit]]
        if found:
            sizes = counts[missed]
            within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            out[np.repeat(first[missed], sizes) + within] = np.frombuffer(b"".join(found), np.uint32)
        return out, first[np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes, and how many each id has."""
        if len(ids) and (int(ids.max()) >= len(self.present) or not self.present[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.places[ids] - (ends - sizes), sizes) + np.arange(total)], sizes


@dataclass(frozen=True)
class Model:
    """What tasks need: the vocabulary's lines, the pattern, and the perfect hash made of them once."""

    name: str
    lines: bytes
    pattern: str
    tier: PerfectHash

    @staticmethod
    def load(path: str, pattern: str = BYTE_LEVEL) -> Model:
        """From a file with a base64 token and its rank on each line."""
        with open(path, "rb") as file:
            lines = file.read(MAX_VOCABULARY_BYTES + 1)
        if len(lines) > MAX_VOCABULARY_BYTES:
            raise ValueError(f"{path} has more than {MAX_VOCABULARY_BYTES} bytes")
        tokens, _ = parsed(lines)
        if not {bytes([b]) for b in range(256)} <= set(tokens):
            raise ValueError(f"{path} lacks some of the 256 single bytes")
        return Model(hashlib.sha256(lines + pattern.encode()).hexdigest(), lines, pattern, PerfectHash(tokens))

    def codec(self) -> Codec:
        if self.name not in _CODECS:
            _CODECS[self.name] = Codec(*parsed(self.lines), self.pattern, self.tier)
        return _CODECS[self.name]


def parsed(lines: bytes) -> tuple[list[bytes], list[int]]:
    pairs = [line.split() for line in lines.splitlines() if line.strip()]
    return [base64.b64decode(token) for token, _ in pairs], [int(rank) for _, rank in pairs]


def _binary(data: np.ndarray, places: np.ndarray) -> pa.Array:
    """Pieces of `data` from each of `places` to the next."""
    data = np.ascontiguousarray(data)
    return pa.Array.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(data)])


def encoded(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `ids`, unsigned 32-bit numbers of lower byte first, and `n_tokens` in place of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.drop(*({"ids", "n_tokens"} - {text}))
    kept = [f for f in rows.schema if f.name != text]
    schema = T.StructType([*kept, T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value.codec()
        for batch in sliced(batches, text, SLICE_BYTES):
            ids, first = codec.encode(*texts_of(batch[text]))
            new = [_binary(ids.astype("<u4").view(np.uint8), first * 4), pa.array(np.diff(first))]
            yield pa.RecordBatch.from_arrays([*[batch[f.name] for f in kept], *new], schema.names)

    return rows.mapInArrow(scan, schema)


def decoded(rows: DataFrame, model: Model, ids: str = "ids") -> DataFrame:
    """`rows` with `decoded`, the bytes, in place of the ids."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    rows = rows.drop(*({"decoded"} - {ids}))
    kept = [f for f in rows.schema if f.name != ids]
    schema = T.StructType([*kept, T.StructField("decoded", T.BinaryType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value.codec()
        for batch in sliced(batches, ids, SLICE_BYTES):
            raw, offsets = texts_of(batch[ids])
            if (offsets % 4).any():
                raise ValueError("ids must have four bytes each")
            data, sizes = codec.decode(np.frombuffer(raw.tobytes(), "<u4").astype(np.int64))
            ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
            yield pa.RecordBatch.from_arrays(
                [*[batch[f.name] for f in kept], _binary(data, ends[offsets // 4])], schema.names
            )

    return rows.mapInArrow(scan, schema)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = Model.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    back = decoded(rows.withColumn("ids_sha256", F.sha2("ids", 256)), model)
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
