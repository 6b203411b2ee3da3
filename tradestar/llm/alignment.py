"""Two tokenizers of one text, aligned by bytes, with corpus counts of their links.

A (byte-level BPE, a ``tokenizers`` file) reads a space and the text; B (a
``sentencepiece`` model with byte fallback) reads the text and adds that space
itself. Where tokens of both end at one byte, a group ends. An A and a B
occurrence whose bytes overlap are linked; a pair of ids counts once for each
document that holds it linked.

The first pass aligns every document and hands on, for each task, the pairs it
met and in how many documents. The distinct pairs are dealt into shards by their
A id, and a minimal perfect hash is built for each in a task of its own: at each
level the keys that are alone in their slot stay, the others go to the next, and
the place of a pair is the number of taken slots before its own. The tasks'
counts are then laid out as dense vectors in that order and summed as a tree, a
fixed number of vectors at a time. The second pass aligns the stored ids again and
looks every link up: hash, the key that stands there (which must be the pair
itself), count.

What tasks receive is bounded: shards of ``shard_pairs`` pairs on average, and
``pass_shards`` of them at a time. A larger corpus repeats the second pass for
the next shards and adds up, which is exact.

Tokenizers of words dominate the time, so a Python worker remembers a bounded
number of stretches of text. Stretches are cut only where neither tokenizer ever
joins what stands beside: before a single space between other characters, and
around line feeds; a vocabulary for which that does not hold is refused.

Rows: a text that is null or empty, or that either tokenizer does not give back
byte for byte, has no tokens: all numbers are zero, groups and their digest are
empty strings. Repeated rows count again; texts of any length are read in parts;
an empty table gives no rows. Extra columns are carried, but one named ``align``
is replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from functools import lru_cache, reduce
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradestar.llm.packing import _byte_letters
from tradestar.llm.scratch import Scratch
from tradestar.llm.textblocks import U64, blocks, mix

#: Stretches that a worker remembers, and the longest it remembers.
CACHED, CACHED_CHARS = 250_000, 48
#: Characters of a text that are read at once.
PART = 1 << 20
#: Pairs of a shard, and shards that tasks receive at once.
SHARD_PAIRS, PASS_SHARDS = 1 << 20, 8
#: Places of a dense vector in one row, and vectors that are summed at once.
SLICE, FAN = 1 << 16, 32
#: Slots for each key at a level of the hash.
SLOTS = 2
#: Stretches that B reads at once.
FEW = 32
#: Pairs whose counts a task holds before it hands them on.
HELD = 2_000_000

_STRETCH = re.compile(r"[ \n]\s*(?=\n\S)|\n(?=\S)|(?:[ \n]\s*)?\S+(?:[^\S \n]\s*\S*)*|\s+")
#: What white space other than single spaces and one or two line feeds between
#: words looks like.
_UNEVEN = ["  ", "\n\n\n", " \n", "\n ", *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")]
_BORDER = re.compile(r"(?<=\S) (?=\S)")
#: Stretches that a line feed beside them leaves as they are.
_PLAIN = re.compile(r"[ \n]?\S(?:.*\S)?", re.DOTALL)
#: The split pattern of byte-level tokenizers (fixed value).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BAD = (b"", b"", b"")


def _parts(text: str, limit: int = PART):
    """A text in parts between which there is a space at a border."""
    a = 0
    while len(text) - a > limit:
        border = _BORDER.search(text, a + limit)
        if not border:
            break
        yield text[a:border.start()]
        a = border.end()
    yield text[a:]


def _keys(text: str) -> list:
    """The stretches of a space and ``text``, as keys: a word for itself after a
    space, with its line feed after one; any other stretch in a tuple."""
    if not (text[0].isspace() or text[-1].isspace() or any(x in text for x in _UNEVEN)):
        return text.replace("\n", " \n").split(" ")
    return [s[1:] if s[0] == " " and len(s) > 1 and not s[1].isspace() else s if s[0] == "\n" else (s,)
            for s in _STRETCH.findall(" " + text)]


def _stretch(key) -> str:
    if isinstance(key, tuple):
        return key[0]
    return key if key[0] == "\n" else " " + key


class Tokenizers:
    """Both tokenizers and the bytes of their ids.

    A's vocabulary is its merges in order, each id one higher than the last, so
    the ids are merge ranks as well: ``tiktoken`` gives the same ids from them,
    several times as fast. A file of another kind is refused.
    """

    def __init__(self, a_path: str, b_path: str) -> None:
        import tiktoken
        from sentencepiece import SentencePieceProcessor
        with open(a_path, encoding="utf-8") as f:
            a = json.load(f)
        names, split = a["model"]["vocab"], a["pre_tokenizer"]
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in a["model"]["merges"]]
        if (a["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]
                or any(names[x + y] != 256 + i for i, (x, y) in enumerate(merges))):
            raise ValueError(f"{a_path}: not a plain byte-level BPE in the order of its merges")
        byte_of = {c: b for b, c in _byte_letters().items()}
        ranks = {bytes(byte_of[c] for c in name): i for name, i in names.items() if i < 256 + len(merges)}
        self.a = tiktoken.Encoding("a", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [raw for raw, _ in sorted(ranks.items(), key=lambda x: x[1])]
        self.b = SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("\n" in p or "▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"{b_path}: pieces cross spaces or line feeds")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p)
                        else p.replace("▁", " ").encode() for p in pieces]
        self.a_len, self.b_len = (np.array(list(map(len, x))) for x in (self.a_bytes, self.b_bytes))
        self.a_type, self.b_type = (np.min_scalar_type(len(x) - 1) for x in (self.a_bytes, pieces))
        # an id as it is written within and at the end of its side of a group
        self.written = [f"{i}{end}" for x, ends in ((self.a_bytes, ",|"), (pieces, ",;"))
                        for end in ends for i in range(len(x))]

    def ids(self, *texts: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts with line feeds between them; B reads a few at a time,
        which is faster."""
        # a line feed before keeps the model from adding a space
        some = ["\n" + "\n".join(texts[i:i + FEW]) for i in range(0, len(texts), FEW)]
        b = self.b.encode(some, num_threads=1)
        return (np.array(self.a.encode_ordinary("\n".join(texts)), np.int64),
                np.fromiter(chain(b[0][2:], *(x[1:] for x in b[1:])), np.int64))

    def _is(self, a: np.ndarray, b: np.ndarray, raw: bytes) -> bool:
        return raw == b"".join(map(self.a_bytes.__getitem__, a.tolist())) == b"".join(
            map(self.b_bytes.__getitem__, b.tolist()))

    def _together(self, stretches: list[str], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of plain stretches, one after the other, from one call; None if
        the bytes do not come out right."""
        a, b = self.ids(*stretches)
        feeds = np.cumsum([len(r) + 1 for r in raw])[:-1]  # where the line feeds between them end
        kept = []
        for ids, size in ((a, self.a_len), (b, self.b_len)):
            ends = np.cumsum(size[ids])
            at = np.searchsorted(ends, feeds)
            if not len(ids) or (at >= len(ids)).any() or (ends[at] != feeds).any() or (size[ids[at]] != 1).any():
                return None
            kept.append(np.delete(ids, at))
        return (kept[0], kept[1]) if self._is(*kept, b"".join(raw)) else None

    def aligned(self, stretches: list[str]):
        """The stretches in another order, and for each (good, n_a, n_b, n_links);
        the ids and the pairs of all good ones in a row."""
        plain = [s for s in stretches if _PLAIN.fullmatch(s) and "▁" not in s]
        raw = [s.encode() for s in plain]
        done = self._together(plain, raw) if plain else (np.empty(0, np.int64),) * 2
        if done is None:
            plain, raw, done = [], [], (np.empty(0, np.int64),) * 2
        parts, good, first = [done], [True] * len(plain), set(plain)
        odd = [s for s in stretches if s not in first]
        for s in odd:
            a, b = self.ids(s)
            good.append(self._is(a, b, s.encode()))
            if good[-1]:
                parts.append((a, b))
        stretches = plain + odd
        a, b = (np.concatenate(x) for x in zip(*parts, strict=True))
        raw += [s.encode() for s in odd]
        size = np.cumsum([len(r) * g for r, g in zip(raw, good, strict=True)])
        links = Links(a, b, self.a_len, self.b_len)
        counts = (np.diff(np.searchsorted(ends, size, "right"), prepend=0)
                  for ends in (links.a_end, links.b_end, links.ends))
        return stretches, good, *counts, a, b, links.pairs


class Links:
    """The links of A's and B's ids of the same bytes, in their order. A link
    stands for the bytes between two neighbouring ends of tokens of either side,
    which lie in one token of each."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_len: np.ndarray, b_len: np.ndarray) -> None:
        self.a, self.b, self.a_end, self.b_end = a, b, np.cumsum(a_len[a]), np.cumsum(b_len[b])
        mark = np.zeros(int(self.a_end[-1]) + 1 if len(a) else 1, np.uint8)
        mark[self.a_end] = 1
        mark[self.b_end] += 2
        self.ends = np.flatnonzero(mark)
        sides = mark[self.ends]
        self.of_a, self.of_b, self.common = sides & 1 > 0, sides > 1, sides == 3
        # ends of the same side before this one: the token that the link lies in
        at_a, at_b = (np.cumsum(x) - x for x in (self.of_a, self.of_b))
        self.pairs = a[at_a].astype(np.int64) * len(b_len) + b[at_b]

    def written(self, size_a: int, size_b: int) -> np.ndarray:
        """All ids, group by group, A's before B's, as places in
        ``Tokenizers.written``."""
        group = np.cumsum(self.common) - self.common
        until_a, until_b = (np.concatenate([[0], np.cumsum(x)[self.common]]) for x in (self.of_a, self.of_b))
        out = np.empty(len(self.a) + len(self.b), np.int64)
        out[np.arange(len(self.a)) + until_b[group[self.of_a]]] = self.a + size_a * self.common[self.of_a]
        out[np.arange(len(self.b)) + until_a[group[self.of_b] + 1]] = (
            2 * size_a + self.b + size_b * self.common[self.of_b])
        return out


class PerfectHash:
    """A minimal perfect hash: ``n`` keys to places 0 to n - 1."""

    def __init__(self, sizes: list[int], bits: np.ndarray) -> None:
        self.sizes, self.bits = sizes, bits
        self.before = np.cumsum(np.bitwise_count(bits), dtype=np.int64) - np.bitwise_count(bits)

    @staticmethod
    def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = mix(np.array([level + 1], U64) * U64(0x9E3779B97F4A7C15))
        return (mix(keys.astype(U64) ^ seed) % U64(size)).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """For distinct keys."""
        sizes, taken = [], []
        while len(keys):
            size = max(64, -(-SLOTS * len(keys) // 64) * 64)
            slot = cls._slot(keys, len(sizes), size)
            alone = np.bincount(slot, minlength=size) == 1
            sizes.append(size)
            taken.append(alone)
            keys = keys[~alone[slot]]
        bits = np.concatenate(taken) if taken else np.zeros(64, bool)
        return cls(sizes, np.packbits(bits, bitorder="little").view(U64))

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; of a key that is not among the n, any or -1."""
        out, rest, start = np.full(len(keys), -1), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            slot = start + self._slot(keys[rest], level, size)
            word, bit = self.bits[slot >> 6], (slot & 63).astype(U64)
            here = (word >> bit) & U64(1) == 1
            low = word[here] & ((U64(1) << bit[here]) - U64(1))
            out[rest[here]] = self.before[slot[here] >> 6] + np.bitwise_count(low)
            rest, start = rest[~here], start + size
        return out


def _hashed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """A shard's hash, and its pairs in the order of their places."""
    pairs = table["pair"].to_numpy()
    h = PerfectHash.of(pairs)
    keys = np.empty(len(pairs), np.int64)
    keys[h.places(pairs)] = pairs
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "sizes": pa.array([h.sizes], pa.list_(pa.int64())),
                     "bits": pa.array([h.bits.tobytes()], pa.binary()), "keys": pa.array([keys.tobytes()], pa.binary())})


class Shards:
    """Hashes of some shards, and counts once they are known."""

    def __init__(self, rows: list, n_shards: int, n_b: int) -> None:
        self.n_shards, self.n_b = n_shards, n_b
        self.hash, self.keys, self.counts, self.best = {}, {}, {}, {}
        for r in rows:
            self.hash[r["shard"]] = PerfectHash(r["sizes"], np.frombuffer(r["bits"], U64))
            keys = np.frombuffer(r["keys"], np.int64)
            self.keys[r["shard"]] = keys.astype(np.min_scalar_type(keys.max()))

    def places(self, pairs: np.ndarray):
        """(shard, positions in ``pairs``, places) for each shard held here;
        pairs that are not in the table are left out."""
        of = pairs // self.n_b % self.n_shards
        for shard, h in self.hash.items():
            at = np.arange(len(pairs)) if self.n_shards == 1 else np.flatnonzero(of == shard)
            if len(at):
                place = h.places(pairs[at])
                known = (place >= 0) & (self.keys[shard][place] == pairs[at])
                yield shard, at[known], place[known]

    def filled(self, rows: list) -> Shards:
        """With the counts of dense vectors; ``best`` marks the highest of an A id."""
        for shard, keys in self.keys.items():
            counts = np.zeros(len(keys), np.int64)
            for r in rows:
                if r["shard"] == shard:
                    part = np.frombuffer(r["vector"], np.int64)
                    counts[r["slice"] * SLICE:r["slice"] * SLICE + len(part)] = part
            a = keys.astype(np.int64) // self.n_b
            most = np.zeros(int(a.max()) + 1, np.int64)
            np.maximum.at(most, a, counts)
            self.counts[shard] = counts.astype(np.min_scalar_type(counts.max()))
            self.best[shard] = counts == most[a]
        return self

    def looked_up(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each pair and whether it is its A id's highest; zero for
        pairs of shards that are not held here, and for those that only stand in
        documents without tokens."""
        count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
        for shard, at, place in self.places(pairs):
            count[at], best[at] = self.counts[shard][place], self.best[shard][place]
        return count, best


class _Worker:
    """What a Python worker remembers of one job's stretches."""

    def __init__(self, paths: tuple[str, str]) -> None:
        self.t = _tokenizers(paths)
        self.known: dict = {}

    def values(self, texts: list[list], learn) -> list[list]:
        """What ``learn`` gives for the stretches of each text, by their keys."""
        known = self.known
        new = {k for keys in texts for k in keys if k not in known}
        if len(known) + len(new) > CACHED:
            known = self.known = {}
            new = set(chain.from_iterable(texts))
        keys = list(new)
        for i in range(0, len(keys), 20_000):
            of = {_stretch(k): k for k in keys[i:i + 20_000]}
            known.update((of[s], v) for s, v in learn(list(of)))
        values = [list(map(known.__getitem__, ks)) for ks in texts]
        for k in new:
            if len(k) > CACHED_CHARS or isinstance(k, tuple) and len(k[0]) > CACHED_CHARS:
                del known[k]
        return values


@lru_cache(maxsize=1)
def _tokenizers(paths: tuple[str, str]) -> Tokenizers:
    return Tokenizers(*paths)


@lru_cache(maxsize=1)
def _worker(paths: tuple[str, str], job: str) -> _Worker:
    return _Worker(paths)


def _texts(data: np.ndarray, off: np.ndarray) -> list[str]:
    raw, cuts = data.tobytes(), off.tolist()
    return [raw[a:z].decode() for a, z in zip(cuts, cuts[1:], strict=False)]


def _summed(pairs: list[np.ndarray], docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate(pairs), return_inverse=True)
    return keys, np.bincount(at, np.concatenate(docs), minlength=len(keys)).astype(np.int64)


def _first_pass(paths: tuple[str, str], job: str):
    """Rows of documents (row, no, a, b: their ids as bytes), and a task's counts
    in rows of their own (pair, docs)."""
    fields = [("no", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("pair", pa.int64()), ("docs", pa.int64())]

    def learn(stretches: list[str]):
        t = _tokenizers(paths)
        stretches, good, n_a, n_b, n_links, a, b, pairs = t.aligned(stretches)
        sides = []
        for ids, n, kind in ((a, n_a, t.a_type), (b, n_b, t.b_type), (pairs, n_links, np.dtype(np.int64))):
            raw, cuts = ids.astype(kind).tobytes(), [0, *accumulate((kind.itemsize * n).tolist())]
            sides.append([raw[i:j] for i, j in zip(cuts, cuts[1:], strict=False)])
        return ((s, v if g else _BAD) for s, g, v in zip(stretches, good, zip(*sides, strict=True), strict=True))

    def of_document(parts: list[list[tuple]]) -> tuple[bytes, bytes, np.ndarray]:
        """Ids of a document, given by its parts, and its distinct pairs."""
        values = list(chain.from_iterable(parts))
        distinct = set(values)
        if _BAD in distinct or not values:
            return b"", b"", np.empty(0, np.int64)
        return (b"".join([v[0] for v in values]), b"".join([v[1] for v in values]),
                np.unique(np.frombuffer(b"".join([v[2] for v in distinct]), np.int64)))

    def counts(schema, pairs, docs):
        for i in range(0, len(pairs), SLICE):
            n = len(pairs[i:i + SLICE])
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, f.type) for f in schema][:4] + [pa.array(pairs[i:i + SLICE]), pa.array(docs[i:i + SLICE])],
                schema=schema)

    def run(batches):
        worker = _worker(paths, job)
        no = TaskContext.get().partitionId() << 40
        pairs, docs, held = [], [], 0
        for batch in batches:
            schema = pa.schema([batch.schema.field("row"), *fields])
            for i, j, data, off in blocks(batch.column("body"), PART):
                texts = [[_keys(p) for p in _parts(t)] if t else [] for t in _texts(data, off)]
                values = iter(worker.values([p for ps in texts for p in ps], learn))
                a, b, found = zip(*[of_document([next(values) for _ in ps]) for ps in texts], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(i, j - i), pa.array(range(no, no + j - i), pa.int64()),
                     pa.array(a, pa.binary()), pa.array(b, pa.binary()),
                     pa.nulls(j - i, pa.int64()), pa.nulls(j - i, pa.int64())], schema=schema)
                no += j - i
                keys, n = np.unique(np.concatenate(found), return_counts=True)
                pairs.append(keys)
                docs.append(n)
                held += len(keys)
                if held > HELD:
                    keys, n = _summed(pairs, docs)
                    pairs, docs, held = [keys], [n], len(keys)
                    if held > HELD // 2:
                        yield from counts(schema, keys, n)
                        pairs, docs, held = [], [], 0
        if held:
            yield from counts(schema, *_summed(pairs, docs))
    return run


def _dense(shipped):
    """A task's counts as slices of dense vectors; slices of zeros are left out."""
    def run(batches):
        shards: Shards = shipped.value
        vectors = {s: np.zeros(len(k), np.int64) for s, k in shards.keys.items()}
        for b in batches:
            docs, met = b.column("docs").to_numpy(), 0
            for shard, at, place in shards.places(b.column("pair").to_numpy()):
                np.add.at(vectors[shard], place, docs[at])
                met += len(at)
            if met < len(docs):
                raise ValueError("a counted pair is not in the table of pairs")
        part = TaskContext.get().partitionId() // FAN
        for shard, v in vectors.items():
            for i in range(0, len(v), SLICE):
                if v[i:i + SLICE].any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard], pa.int32()), pa.array([i // SLICE], pa.int32()), pa.array([part], pa.int32()),
                         pa.array([v[i:i + SLICE].tobytes()], pa.binary())], names=["shard", "slice", "part", "vector"])
    return run


def _added(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    total = None
    for v in table["vector"]:
        v = np.frombuffer(v.as_buffer(), np.int64)
        total = v.copy() if total is None else total + v
    first = table.slice(0, 1).select(["shard", "slice", "part"])
    return first.append_column("vector", pa.array([total.tobytes()], pa.binary()))


_NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def _second_pass(paths: tuple[str, str], shipped, with_groups: bool):
    """The documents' own numbers: their ids aligned again, and every link looked
    up in the shards held."""
    fields = [(n, pa.int64()) for n in _NUMBERS] + [("groups_sha256", pa.string())] + [
        ("groups", pa.string())] * with_groups

    def run(batches):
        t, shards = _tokenizers(paths), shipped.value
        for batch in batches:
            columns: list[list] = [[] for _ in range(8)]
            for i, j, raw_a, off_a in blocks(batch.column("a"), PART):
                _, _, raw_b, off_b = next(blocks(batch.column("b").slice(i, j - i), 1 << 62))
                a, b = raw_a.view(t.a_type).astype(np.int64), raw_b.view(t.b_type).astype(np.int64)
                until_a, until_b = off_a // t.a_type.itemsize, off_b // t.b_type.itemsize
                links = Links(a, b, t.a_len, t.b_len)
                until = np.searchsorted(links.ends, np.concatenate([[0], links.a_end])[until_a], "right")
                count, best = shards.looked_up(links.pairs)
                summed = lambda x: np.concatenate([[0], np.cumsum(x)])[until]  # noqa: B023, E731
                numbers = [until_a, until_b, summed(links.common), until, summed(best), summed(count)]
                for c, x in zip(columns, numbers, strict=False):
                    c += np.diff(x).tolist()
                text = list(map(t.written.__getitem__, links.written(len(t.a_len), len(t.b_len)).tolist()))
                cuts = (until_a + until_b).tolist()
                groups = ["".join(text[x:y])[:-1] for x, y in zip(cuts, cuts[1:], strict=False)]
                columns[6] += [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                columns[7] += groups if with_groups else []
            arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, fields, strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.StructArray.from_arrays(arrays, fields=[pa.field(*f) for f in fields])],
                names=["row", "align"])
    return run


def align(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", carry: list[str] | None = None,
          with_groups: bool = True, shard_pairs: int = SHARD_PAIRS, pass_shards: int = PASS_SHARDS) -> DataFrame:
    """The columns ``carry`` of ``docs`` (default: all but the text) plus
    ``align`` = struct(n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256[, groups])."""
    spark = docs.sparkSession
    work, job, paths = Scratch(spark), uuid.uuid4().hex, (a_path, b_path)
    keep = [c for c in docs.columns if c not in (text_col, "align")] if carry is None else carry
    src = docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.col(text_col).cast("string").alias("body"))
    n_b = _tokenizers(paths).b.get_piece_size()

    first = T.StructType([T.StructField("row", src.schema["row"].dataType), *[T.StructField(n, k()) for n, k in (
        ("no", T.LongType), ("a", T.BinaryType), ("b", T.BinaryType), ("pair", T.LongType), ("docs", T.LongType))]])
    met = work.stored(src.mapInArrow(_first_pass(paths, job), first), "met")
    partial, rows = met.filter("pair is not null").select("pair", "docs"), met.filter("pair is null")
    distinct = work.stored(partial.select("pair").distinct(), "distinct")
    n_shards = max(1, -(-distinct.count() // shard_pairs))
    shard = (F.expr(f"pair div {n_b}") % n_shards).cast("int").alias("shard")
    hashes = work.stored(distinct.select("pair", shard).groupBy("shard").applyInArrow(
        _hashed, "shard int, sizes array<long>, bits binary, keys binary"), "hashes")
    work.drop("distinct")
    held = partial.select("pair", "docs", shard)
    vector = "shard int, slice int, part int, vector binary"

    numbers = [*[T.StructField(n, T.LongType()) for n in _NUMBERS], T.StructField("groups_sha256", T.StringType())]
    groups = [T.StructField("groups", T.StringType())]
    results = []
    for k, at in enumerate(range(0, n_shards, pass_shards)):
        here = F.col("shard").between(at, at + pass_shards - 1)
        shards = Shards(hashes.filter(here).toArrow().to_pylist(), n_shards, n_b)
        shipped = spark.sparkContext.broadcast(shards)
        tree = held.filter(here).select("pair", "docs").mapInArrow(_dense(shipped), vector)
        for keys in (["shard", "slice", "part"], ["shard", "slice"]):
            tree = tree.groupBy(*keys).applyInArrow(_added, vector)
        counted = spark.sparkContext.broadcast(shards.filled(tree.toArrow().to_pylist()))
        shipped.destroy()
        # later passes only add to the numbers of the first
        texts = with_groups and not k
        read = rows.select("row" if n_shards <= pass_shards else F.struct(
            "no", *(["row"] if not k else [])).alias("row"), "a", "b")
        results.append(read.mapInArrow(_second_pass(paths, counted, texts), T.StructType(
            [read.schema["row"], T.StructField("align", T.StructType(numbers + groups * texts))])))
    if len(results) == 1:
        return results[0].select("row.*", "align")
    whole = results[0].select("row.no", "row.row", "align")
    rest = reduce(DataFrame.union, [r.select("row.no", "align.n_best", "align.count_sum") for r in results[1:]])
    rest = rest.groupBy("no").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return whole.join(rest, "no").select("row.*", F.col("align").withField(
        "n_best", F.col("align.n_best") + F.col("n_best")).withField(
        "count_sum", F.col("align.count_sum") + F.col("count_sum")).alias("align"))
