"""Harmonic packing of tokenised documents into sequences of fixed capacity.

A document's ids (its tokens, then one end id) are cut into pieces whose
lengths are the capacity divided by a power of two, largest first, and a last
piece shorter than ``grain``. A piece longer than capacity/(k+1) and no longer
than capacity/k belongs to class k, and a bin of class k takes exactly k
pieces. Bins of the power-of-two classes are therefore full to the last token;
only bins of the short tails leave a few tokens of padding. When a worker has
read its partition, the pieces left in its open bins are laid end to end and
cut at the capacity; what remains is cut into powers of two, which need no
padding.

Every partition packs on its own: no shuffle, no common state. A sequence's id
is its partition's number and a count, so a repeated task repeats its ids as
long as its partition holds the same rows in the same order (a table scan
does). Memory: the open bins hold fewer than k pieces of each class.

Rows: a null or empty text is the end id alone; repeated rows are packed as
often as they stand there; extra columns of any name are carried along, but
one named ``piece`` is replaced.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradestar.llm.textblocks import blocks

CAPACITY = 2048
END_ID = 1
#: Pieces are not cut shorter than this; what is left of a document then is its tail.
GRAIN = 64
#: Distinct words whose ids a task remembers, and the longest it remembers.
CACHED, CACHED_BYTES = 400_000, 64

PIECE = T.StructType([
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])


#: ASCII punctuation but the apostrophe, which may belong to the word beside it.
_MARKS = rb"!-&(-/:-@\[-`{-~"
_APART = re.compile(rb"(?<=[a-z0-9])([" + _MARKS + rb"]+)(?=[\sa-z0-9]|\Z)")
_ONLY_MARKS = re.compile("[" + _MARKS.decode() + "]+")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 bytes stand for themselves, the others follow from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b if b in own else 256 + rest.index(b)) for b in range(256)}


class WordIds:
    """Token ids by the tokenizer file, word by word.

    The tokenizer lowers the text, drops white space and merges nothing across
    it, nor across the border between a letter and punctuation; so a text's ids
    are those of its words and marks in turn. A task looks each distinct one up
    once (Zipf's law) instead of running the merges for every occurrence. Plain
    Latin words and ASCII marks need only the merges, which ``tiktoken`` runs for
    many words at once: it takes the pair of the lowest rank, and a word's end is
    a byte of its own that merges with the last letter before all else. (That is
    the same as the file's merges because each token, spelt out on its own, comes
    back as itself; a test holds that for the file.) Anything else goes through
    the whole tokenizer, and so does every text with the string of a special
    token, which stands for that token.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        special = self.tokenizer.get_added_tokens_decoder()
        self.border = max(special)
        self.border_text = special[self.border].content
        self.special = re.compile(b"|".join(re.escape(t.content.lower().encode()) for t in special.values()))
        self.known: dict[bytes, bytes] = {}
        self.letters = _byte_letters()
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ranks, ids = self._ranks(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.id_of_rank = np.array(ids, "<u4")
        self.size_of_rank = np.array([len(raw) for raw in sorted(ranks, key=ranks.get)])
        self.merges = tiktoken.Encoding("words", pat_str=r"[^\x00]*\x00", mergeable_ranks=ranks, special_tokens={})

    def _ranks(self, vocab: dict, merges: list, end: str) -> tuple[dict[bytes, int], list[int]]:
        """Ranks of bytes, of last bytes with the word's end (byte 0) and of merged
        tokens, in the order in which they merge; the id of each."""
        byte_of = {c: b for b, c in self.letters.items()}
        spelt = lambda t: bytes(byte_of[c] for c in t.removesuffix(end)) + b"\0" * t.endswith(end)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        names = [c + tail for tail in ("", end) for c in self.letters.values()] + ["".join(p) for p in pairs]
        ranks = {}
        for i, name in enumerate(names):
            ranks[spelt(name) if i >= 512 else bytes([i % 256]) + b"\0" * (i >= 256)] = i
        return ranks, [vocab[n] for n in names]

    def _merged(self, words: list[str]) -> list[bytes]:
        """Little-endian ids of words without byte 0."""
        if not words:
            return []
        raw = [w.encode() for w in words]
        ranks = np.array(self.merges.encode_ordinary("\0".join(words) + "\0"), np.int64)
        ends = np.searchsorted(np.cumsum(self.size_of_rank[ranks]), np.cumsum([len(r) + 1 for r in raw])) + 1
        ids, cuts = self.id_of_rank[ranks].tobytes(), [0, *(4 * ends).tolist()]
        return [ids[a:z] for a, z in zip(cuts, cuts[1:], strict=False)]

    def _tokenized(self, words: list[str]) -> list[bytes]:
        """Ids by the whole tokenizer, of many words by one call: a special token
        between them marks where each one's ids end."""
        out = []
        for a in range(0, len(words), 20_000):
            ids = np.array(self.tokenizer.encode(self.border_text.join(words[a:a + 20_000]),
                                                 add_special_tokens=False).ids, "<u4")
            ends = np.append(np.flatnonzero(ids == self.border), len(ids)).tolist()
            raw, begin = ids.tobytes(), 0
            for end in ends:
                out.append(raw[4 * begin:4 * end])
                begin = end + 1
        return out

    def _learn(self, new: list[bytes]) -> dict[bytes, bytes]:
        plain, words, other = [], [], []
        for w in new:
            text = w.decode()
            if text.isascii() and (text.isalpha() or _ONLY_MARKS.fullmatch(text)):
                plain.append(w)
                words.append(text)
            else:
                other.append(w)
        spelt = [w for w in other if b"\0" not in w]
        normal = self.tokenizer.normalizer.normalize_str("\0".join(w.decode() for w in spelt)).split("\0")
        for w, text in zip(spelt, normal, strict=False) if len(normal) == len(spelt) else ():
            if text.isalpha() and max(text) < "\u0250":
                plain.append(w)
                words.append(text)
        done = set(plain)
        rest = [w for w in other if w not in done]
        out = dict(zip(plain, self._merged(words), strict=True))
        out.update(zip(rest, self._tokenized([w.decode() for w in rest]), strict=True) if rest else ())
        return out

    def texts(self, raws: list[bytes]) -> list[np.ndarray]:
        whole = {k: np.array(self.tokenizer.encode(r.decode(), add_special_tokens=False).ids, "<u4")
                 for k, r in enumerate(raws) if self.special.search(r.lower())}
        split = [() if k in whole else _APART.sub(rb" \1 ", r.lower()).split() for k, r in enumerate(raws)]
        known = self.known
        new = {w for ws in split for w in ws if w not in known}
        if len(known) + len(new) > CACHED:
            known = self.known = {}
            new = {w for ws in split for w in ws}
        known.update(self._learn(list(new)))
        out = [np.frombuffer(b"".join(map(known.__getitem__, ws)), "<u4") for ws in split]
        for w in new:
            if len(w) > CACHED_BYTES:
                del known[w]
        return [whole.get(k, ids) for k, ids in enumerate(out)]


@lru_cache(maxsize=1)
def _word_ids(path: str) -> WordIds:
    """One for each Python worker, which reads the file once; the words it knows
    go with the task, as the worker lives on for tasks of other kinds."""
    return WordIds(path)


def piece_lengths(n: int, capacity: int = CAPACITY, grain: int = GRAIN) -> list[int]:
    """Lengths that a document of n ids is cut into."""
    out = [capacity] * (n // capacity)
    n %= capacity
    size = capacity // 2
    while size >= grain and size:
        if n >= size:
            out.append(size)
            n -= size
        size //= 2
    return out + [n] * (n > 0)


class Bins:
    """The open bins of one worker. ``full`` gets (owner, start, ids, sequence,
    offset) of every piece whose sequence is complete."""

    def __init__(self, capacity: int, first_id: int) -> None:
        self.capacity, self.next_id = capacity, first_id
        self.open: dict[int, list] = {}
        self.full: list = []

    def _close(self, pieces: list) -> None:
        at = 0
        for owner, start, ids in pieces:
            self.full.append((owner, start, ids, self.next_id, at))
            at += len(ids)
        self.next_id += 1

    def add(self, owner, start: int, ids: np.ndarray) -> None:
        k = self.capacity // len(ids)
        held = self.open.setdefault(k, [])
        held.append((owner, start, ids))
        if len(held) == k:
            self._close(held)
            del self.open[k]

    def finish(self) -> None:
        """Fill sequences with what the open bins hold, in turn."""
        left = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        total = sum(len(p[2]) for p in left)
        rest = total % self.capacity
        sizes = [self.capacity] * (total // self.capacity)
        sizes += [1 << b for b in reversed(range(self.capacity.bit_length())) if rest >> b & 1]
        left.reverse()
        for size in sizes:
            pieces, room = [], size
            while room:
                owner, start, ids = left.pop()
                pieces.append((owner, start, ids[:room]))
                if len(ids) > room:
                    left.append((owner, start + room, ids[room:]))
                room -= min(room, len(ids))
            self._close(pieces)


def _pack(path: str, capacity: int, end_id: int, grain: int, with_ids: bool):
    out_type = pa.struct([(f.name, pa.int64()) for f in PIECE] + [("ids", pa.list_(pa.int32()))] * with_ids)

    def batch(full: list) -> pa.RecordBatch:
        rows = pa.array([p[0][0] for p in full], full[0][0][0].type)
        cols = [[p[1] for p in full], [len(p[2]) for p in full], [zlib.crc32(p[2].tobytes()) for p in full],
                [p[0][1] for p in full], [p[3] for p in full], [p[4] for p in full]]
        arrays = [pa.array(c, pa.int64()) for c in cols]
        if with_ids:
            arrays.append(pa.array([p[2].astype(np.int32) for p in full], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(
            [rows, pa.StructArray.from_arrays(arrays, fields=list(out_type))], names=["row", "piece"])

    def run(batches):
        words = _word_ids(path)
        bins = Bins(capacity, TaskContext.get().partitionId() << 32)
        end = np.array([end_id], "<u4")
        for b in batches:
            rows = b.column("row")
            for i, _, data, off in blocks(b.column("body"), 1 << 20):
                raw, cuts = data.tobytes(), off.tolist()
                texts = [raw[a:z] for a, z in zip(cuts, cuts[1:], strict=False)]
                for k, ids in enumerate(words.texts(texts)):
                    ids = np.concatenate([ids, end])
                    owner, start = (rows[i + k], len(ids)), 0
                    for n in piece_lengths(len(ids), capacity, grain):
                        bins.add(owner, start, ids[start:start + n])
                        start += n
                if bins.full:
                    yield batch(bins.full)
                    bins.full = []
        words.known = {}
        bins.finish()
        if bins.full:
            yield batch(bins.full)
    return run


def pack(df: DataFrame, tokenizer_path: str, text_col: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID, grain: int = GRAIN, carry: list[str] | None = None,
         with_ids: bool = True) -> DataFrame:
    """The columns ``carry`` of ``df`` (default: all but the text) plus ``piece``
    = struct(start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]),
    a row for each piece of a document."""
    keep = [c for c in df.columns if c not in (text_col, "piece")] if carry is None else carry
    src = df.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.col(text_col).alias("body"))
    piece = PIECE if not with_ids else T.StructType(
        [*PIECE.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    schema = T.StructType([src.schema["row"], T.StructField("piece", piece)])
    return src.mapInArrow(_pack(tokenizer_path, capacity, end_id, grain, with_ids), schema).select("row.*", "piece")
