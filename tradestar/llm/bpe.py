"""Byte-level BPE by a segment tree, and back.

Each match of the split pattern is encoded on its own. Over its byte positions
stands a segment tree whose leaves hold the merge rank of the pair that begins
there (with the next live position) and whose root is the leftmost minimum. A
merge takes the root, joins the pair, and updates three leaves (the pair, its
dead right half, the pair before it), each in logarithmic time. Short matches
run through the same tree many at a time as numpy rows; a long match walks a
tree of its own.

A task meets the same words again and again. Blocks of texts are cut between
spaces, equal stretches of a block are looked up once, and a task remembers the
ids of a bounded number of distinct stretches and of the matches within them.
Ids are spelt (as bytes, as decimals) by one gather a block.

Rows: a null or empty text has no ids (and decodes to no bytes); repeated rows
are encoded alike; extra columns of any name are carried, but one named ``bpe``
is replaced.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradestar.llm.textblocks import blocks

#: Distinct stretches, and distinct matches, a task remembers, and the most bytes of one.
CACHED, CACHED_BYTES = 300_000, 64
#: Bytes of text that one block holds unless a single document is longer, and
#: the ids of such a document that are spelt at a time.
BLOCK_BYTES = 1 << 20
#: Matches of up to so many bytes run as rows of one array.
ROW_BYTES = 64
_NONE = np.int64(1) << 40


class Vocabulary:
    """Ranks (also the ids), and which pairs of ids merge to which id."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bytes_of = [b""] * (max(self.rank.values()) + 1)
        for token, i in self.rank.items():
            self.bytes_of[i] = token
        self.single = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        self.pairs = {(self.rank[t[:k]] << 32) | self.rank[t[k:]]: i for t, i in self.rank.items()
                      for k in range(1, len(t)) if t[:k] in self.rank and t[k:] in self.rank}
        self.keys = np.array(sorted(self.pairs), np.int64)
        self.ids = np.array([self.pairs[k] for k in self.keys.tolist()], np.int64)
        self.of_bytes = self.merged(self.single[:, None], self.single)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id each pair merges to, or _NONE."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ids[at], _NONE)


def encode_long(v: Vocabulary, raw: bytes) -> list[int]:
    """One match by one segment tree."""
    n = len(raw)
    width = 1 << max(1, (n - 1).bit_length())
    token = [int(v.single[b]) for b in raw]
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    none = (int(_NONE), 0)
    pair = lambda i: (v.pairs.get((token[i] << 32) | token[after[i]], none[0]), i) if after[i] < n else none
    tree = [none] * (2 * width)
    for i in range(n - 1):
        tree[width + i] = pair(i)
    for i in range(width - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])

    def put(i: int, value: tuple[int, int]) -> None:
        i += width
        tree[i] = value
        while i > 1:
            i >>= 1
            low = min(tree[2 * i], tree[2 * i + 1])
            if tree[i] == low:
                break
            tree[i] = low

    while tree[1][0] < none[0]:
        rank, i = tree[1]
        j = after[i]
        token[i], token[j], after[i] = rank, -1, after[j]
        if after[i] < n:
            before[after[i]] = i
        put(j, none)
        put(i, pair(i))
        if before[i] >= 0:
            put(before[i], pair(before[i]))
    return [t for t in token if t >= 0]


def encode_rows(v: Vocabulary, raws: list[bytes]) -> list[list[int]]:
    """Matches of at most ROW_BYTES bytes by one tree per row of an array."""
    flat, ends = _encode_rows(v, raws)
    return [flat[a:z].tolist() for a, z in zip([0, *ends[:-1]], ends, strict=True)]


def _encode_rows(v: Vocabulary, raws: list[bytes]) -> tuple[np.ndarray, list[int]]:
    width = 1 << max(1, (max(map(len, raws)) - 1).bit_length())
    count = len(raws)
    length = np.array([len(r) for r in raws])
    text = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raws), np.uint8).reshape(count, width)
    place = np.arange(width)
    token = np.where(place < length[:, None], v.single[text], -1)
    token = np.concatenate([token, np.full((count, 1), -1)], axis=1)  # behind the end: no token
    after = np.minimum(np.tile(place + 1, (count, 1)), length[:, None])
    before = np.tile(place - 1, (count, 1))
    tree = np.full((count, 2 * width), _NONE * width, np.int64)
    pairs = v.of_bytes[text[:, :-1], text[:, 1:]]
    tree[:, width:-1] = np.where(place[1:] < length[:, None], pairs, _NONE) * width + place[:-1]
    for level in range(width.bit_length() - 1, 0, -1):
        a, z = 1 << (level - 1), 1 << level
        tree[:, a:z] = np.minimum(tree[:, 2 * a:2 * z:2], tree[:, 2 * a + 1:2 * z:2])
    rows = np.arange(count)
    nodes = tree.reshape(-1)

    def put(r: np.ndarray, i: np.ndarray, value: np.ndarray) -> None:
        i, base = i + width, r * (2 * width)
        nodes[base + i] = value
        while i[0] > 1:
            beside = nodes.take(base + (i ^ 1))
            i = i >> 1
            nodes[base + i] = value = np.minimum(value, beside)

    def pair(r: np.ndarray, i: np.ndarray) -> np.ndarray:
        j = after[r, i]
        return v.merged(token[r, i], token[r, np.where(j < length[r], j, width)]) * width + i

    while True:
        rows = rows[tree[rows, 1] < _NONE]
        if not len(rows):
            break
        best = tree[rows, 1]
        i = best % width
        j = after[rows, i]
        token[rows, i], token[rows, j] = best // width, -1
        k = after[rows, j]
        after[rows, i] = k
        inner = k < length[rows]
        before[rows[inner], k[inner]] = i[inner]
        put(rows, j, np.full(len(rows), _NONE * width))
        put(rows, i, pair(rows, i))
        b = before[rows, i]
        has = b >= 0
        if has.any():
            put(rows[has], b[has], pair(rows[has], b[has]))
    live = token >= 0
    return token[live], np.cumsum(live.sum(axis=1)).tolist()


class Spelling:
    """What each id spells, and what a list of ids spells together."""

    def __init__(self, parts: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        self.size = np.fromiter(map(len, parts), np.int64, len(parts))
        self.begin = np.cumsum(self.size) - self.size

    def of_texts(self, ids: np.ndarray, at: np.ndarray) -> Iterator[list[memoryview]]:
        """For each text (its ids from ``at`` on, to the next) its spelling; that
        of a text beyond a block in parts."""
        if len(ids) <= BLOCK_BYTES:
            data, end = gather(self.data, self.begin, self.size, ids)
            view, cuts = memoryview(data), end[at].tolist()
            for a, z in zip(cuts, cuts[1:], strict=False):
                yield [view[a:z]]
        else:
            for a, z in zip(at.tolist(), at.tolist()[1:], strict=False):
                yield [memoryview(gather(self.data, self.begin, self.size, ids[k:min(k + BLOCK_BYTES, z)])[0])
                       for k in range(a, z, BLOCK_BYTES)] or [memoryview(b"")]


def gather(data: np.ndarray, begin: np.ndarray, size: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``index`` of ``data`` (from ``begin``, of ``size``) end to end, and
    where in that each begins, with the end of the last."""
    count = size[index]
    end = np.concatenate([[0], np.cumsum(count)])
    place = np.repeat(begin[index] - end[:-1], count)
    place += np.arange(len(place))
    return data[place], end


class Codec:
    """Encodes and decodes whole texts; remembers a bounded number of words."""

    OTHER_SPACE = re.compile(r"[^\S \n]")

    def __init__(self, path: str, pattern: str) -> None:
        self.v = _vocabulary(path)
        self.split = regex.compile(pattern)
        self.known: dict[bytes, bytes] = {}
        self.matches: dict[bytes, bytes] = {}
        self.tokens = Spelling(self.v.bytes_of)
        self.decimals = Spelling([b",%d" % i for i in range(len(self.v.bytes_of))])

    def _encode(self, matches: list[bytes]) -> dict[bytes, bytes]:
        """Little-endian ids of each match."""
        out, short = {}, []
        for m in matches:
            if (i := self.v.rank.get(m)) is not None:
                out[m] = pack("<i", i)
            elif len(m) > ROW_BYTES:
                out[m] = np.array(encode_long(self.v, m), "<i4").tobytes()
            else:
                short.append(m)
        short.sort(key=len)
        for k in range(0, len(short), 8192):
            part = short[k:k + 8192]
            flat, ends = _encode_rows(self.v, part)
            ids, a = flat.astype("<i4").tobytes(), 0
            for m, z in zip(part, ends, strict=True):
                out[m] = ids[4 * a:4 * z]
                a = z
        return out

    def _cuts(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Where the stretches of a block begin. A text in which space and newline
        are the only white space is cut at borders that the split pattern's
        matches never cross: a word with the one space before it is a stretch,
        so is the white space before that, and a newline just before a word.
        Other texts are one stretch."""
        white = (data == 32) | (data == 10)
        first, last = np.zeros((2, len(data)), bool)
        filled = off[:-1] < off[1:]
        first[off[:-1][filled]] = last[off[1:][filled] - 1] = True
        # the byte before is a newline, or of the other kind; the byte after is of a word
        line, turn, word = first.copy(), first.copy(), np.zeros(len(data), bool)
        line[1:] |= data[:-1] == 10
        turn[1:] |= ~white[:-1]
        word[:-1] = ~white[1:]
        start = np.where(white, turn | (word & ~last), line)
        raw = data.tobytes()
        if self.OTHER_SPACE.search(raw.decode()):
            cuts = off.tolist()
            for a, z in zip(cuts, cuts[1:], strict=False):
                if self.OTHER_SPACE.search(raw[a:z].decode()):
                    start[a + 1:z] = False
        return np.flatnonzero(start)

    def _stretches(self, stretches: list[bytes]) -> list[bytes]:
        """Little-endian ids of distinct stretches."""
        values = list(map(self.known.get, stretches))
        new = [i for i, v in enumerate(values) if v is None]
        find, inner, ends = self.split.findall, [], []
        for i in new:
            inner += find(stretches[i].decode())
            ends.append(len(inner))
        inner = list(map(str.encode, inner))
        coded = list(map(self.matches.get, inner))
        found = self._encode(list({m for m, v in zip(inner, coded, strict=True) if v is None}))
        coded = [found[m] if v is None else v for m, v in zip(inner, coded, strict=True)]
        if len(self.matches) + len(found) > CACHED:
            self.matches = {}
        self.matches.update((m, v) for m, v in found.items() if len(m) <= CACHED_BYTES)
        if len(self.known) + len(new) > CACHED:
            self.known = {}
        a = 0
        for i, z in zip(new, ends, strict=True):
            values[i] = x = coded[a] if z == a + 1 else b"".join(coded[a:z])
            if len(s := stretches[i]) <= CACHED_BYTES:
                self.known[s] = x
            a = z
        return values

    def block(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a block of texts, and where those of each text begin, with
        the end of the last."""
        start = self._cuts(data, off)
        ends = np.append(start, len(data))
        coded = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data)]
                                      ).dictionary_encode()
        values = self._stretches(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, values), np.int64, len(values)) // 4
        ids, at = gather(np.frombuffer(b"".join(values), "<i4"), np.cumsum(size) - size, size,
                         coded.indices.to_numpy())
        return ids, at[np.searchsorted(start, off)]

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        raws = [t.encode() for t in texts]
        ids, at = self.block(np.frombuffer(b"".join(raws), np.uint8), np.cumsum([0, *map(len, raws)]))
        return np.split(ids, at[1:-1]) if raws else []

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.v.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


_OUT = [("n_tokens", T.LongType(), pa.int64()), ("ids_sha256", T.StringType(), pa.string()),
        ("decoded_sha256", T.StringType(), pa.string())]
_IDS = [("ids", T.ArrayType(T.IntegerType()), pa.list_(pa.int32())), ("decoded", T.StringType(), pa.string())]


def _code(path: str, pattern: str, with_ids: bool):
    fields = _OUT + _IDS * with_ids
    out_type = pa.struct([(n, t) for n, _, t in fields])

    def run(batches):
        codec = Codec(path, pattern)
        for b in batches:
            cols: list[list] = [[] for _ in fields]
            for _, _, data, off in blocks(b.column("body"), BLOCK_BYTES):
                ids, at = codec.block(data, off)
                cols[0] += np.diff(at).tolist()
                for listed in codec.decimals.of_texts(ids, at):
                    cols[1].append(_sha256([listed[0][1:], *listed[1:]]))
                for back in codec.tokens.of_texts(ids, at):
                    cols[2].append(_sha256(back))
                    if with_ids:
                        cols[4].append(b"".join(back).decode())
                if with_ids:
                    cols[3] += np.split(ids, at[1:-1])
            arrays = [pa.array(c, t) for c, (_, _, t) in zip(cols, fields, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.StructArray.from_arrays(arrays, fields=list(out_type))], names=["row", "bpe"])
    return run


def _sha256(parts: list[memoryview]) -> str:
    digest = hashlib.sha256()
    for p in parts:
        digest.update(p)
    return digest.hexdigest()


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
           carry: list[str] | None = None, with_ids: bool = True) -> DataFrame:
    """The columns ``carry`` of ``df`` (default: all) plus ``bpe`` =
    struct(n_tokens, ids_sha256, decoded_sha256[, ids, decoded])."""
    keep = [c for c in df.columns if c != "bpe"] if carry is None else carry
    src = df.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.col(text_col).alias("body"))
    bpe = T.StructType([T.StructField(n, t) for n, t, _ in _OUT + _IDS * with_ids])
    schema = T.StructType([src.schema["row"], T.StructField("bpe", bpe)])
    return src.mapInArrow(_code(ranks_path, pattern, with_ids), schema).select("row.*", "bpe")


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """``df`` with ``decoded`` (bytes) in place of a column of that name; a null
    list decodes to no bytes."""
    keep = [c for c in df.columns if c != "decoded"]
    src = df.select(F.struct(*[F.col(c) for c in keep]).alias("row"),
                    F.col(ids_col).cast("array<int>").alias("ids"))

    def run(batches):
        table = _vocabulary(ranks_path).bytes_of
        for b in batches:
            out = [b"".join(map(table.__getitem__, x)) for x in ((i.as_py() or []) for i in b.column("ids"))]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(out, pa.binary())],
                                             names=["row", "decoded"])

    schema = T.StructType([src.schema["row"], T.StructField("decoded", T.BinaryType())])
    return src.mapInArrow(run, schema).select("row.*", "decoded")
