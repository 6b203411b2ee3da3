"""Registry archives: ZIP files of header-less ``;`` ISO-8859-1 CSV members.

Executors do all of it, in two narrow steps over tables of any size:

- ``list_members``: an archive's central directory and the head of each member
  are read by position, never the whole file; one row for each member with its
  size and the width of its first record, or one with the error of an archive
  that cannot be opened;
- ``read_members``: the members, dealt over the tasks, are inflated a block at a
  time. A block is cut into records without a Python step per line (line breaks
  within quotes stay), and the raw records leave as Arrow strings. Fields are
  split by Spark's own CSV parser (``name_fields``).

So an archive is neither held by one task nor limited by what one cell of a
table can hold; only a single member is inflated by one task, since a deflate
stream has no entry points. Files are opened through ``pyarrow.fs`` (or plainly,
for ``file:``), which must reach the store that Spark lists them from.

Blank records are dropped; an empty field is null, as in Spark's own CSV reader.
A member that breaks off gives the records before the break and one row with the
error. A record beyond MAX_RECORD bytes is such an error: it is what a quote that
never closes looks like.
"""

from __future__ import annotations

import codecs
import csv
import io
import re
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradestar.functions.names import names_by_position
from tradestar.layouts import REGISTRY_ARCHIVES, REGISTRY_LAYOUTS
from tradestar.operators.resolve import choose_member
from tradestar.session import default_parallelism

ENCODING, SEPARATOR = "ISO-8859-1", ";"
MEMBER_SCHEMA = ("path string, arquivo_zip string, membro string, posicao int, bytes long, comprimido long, "
                 "largura int, erro string")
RECORD_SCHEMA = "arquivo_zip string, membro string, n_linha long, registro string, erro string"
BINARY_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
BLOCK_BYTES, HEAD_BYTES, MAX_RECORD = 4 << 20, 1 << 16, 64 << 20
#: What a damaged or unsupported archive raises; an error of the store is none of these.
UNREADABLE = (zipfile.BadZipFile, zlib.error, EOFError, csv.Error, NotImplementedError, RuntimeError)

_QUOTE, _LF, _CR = 34, 10, 13


def _opened(path: str):
    """A file of the store, readable by position."""
    if path.startswith("file:") or "://" not in path:
        return open(re.sub("^file:/*", "/", path), "rb")
    from pyarrow import fs
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def _record_ends(data: bytes, sep: str) -> np.ndarray:
    """Where the complete records of ``data`` end; it begins with a record."""
    chars = np.frombuffer(data, np.uint8)
    breaks, quotes = np.flatnonzero(chars == _LF), np.flatnonzero(chars == _QUOTE)
    if not len(quotes):
        return breaks + 1
    # every odd quote opens a field and every even one closes it, or they are a pair
    beside = np.zeros(256, bool)
    beside[[ord(sep), _LF, _CR, _QUOTE]] = True
    opens, closes = quotes[::2], quotes[1::2]
    before, after = opens[opens > 0] - 1, closes[closes < len(data) - 1] + 1
    if beside[chars[before]].all() and beside[chars[after]].all():
        return breaks[np.searchsorted(quotes, breaks) % 2 == 0] + 1
    # quotes within plain fields: record by record
    s = re.escape(sep)
    field = rf'(?:"[^"]*+(?:""[^"]*+)*+"[^{s}\n]*+|[^"{s}\n][^{s}\n]*+|)'
    record, ends = re.compile(rf"{field}(?:{s}{field})*+\n".encode()), [0]
    while found := record.match(data, ends[-1]):
        ends.append(found.end())
    return np.array(ends[1:], np.int64)


def _records(raw, encoding: str, sep: str, block_bytes: int = BLOCK_BYTES) -> Iterator[pa.Array]:
    """Records of a member, block by block, without their line ends."""
    decoder, rest = codecs.getincrementaldecoder(encoding)(), b""
    while True:
        block = raw.read(block_bytes)
        rest += decoder.decode(block, final=not block).encode()
        ends = _record_ends(rest, sep)
        if not block and (ends[-1] if len(ends) else 0) < len(rest):
            ends = np.append(ends, len(rest))  # the last record may lack its line end
        if len(ends):
            offsets = pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32).tobytes())
            lines = pc.utf8_rtrim(pa.StringArray.from_buffers(len(ends), offsets, pa.py_buffer(rest)), "\r\n")
            yield lines.filter(pc.not_equal(lines, ""))
            rest = rest[int(ends[-1]):]
        if not block:
            return
        if len(rest) > MAX_RECORD:
            raise csv.Error(f"a record of more than {MAX_RECORD} bytes")


def _width(zf: zipfile.ZipFile, info: zipfile.ZipInfo, encoding: str, sep: str) -> int:
    """Fields of a member's first record; 0 without one."""
    with zf.open(info) as raw:
        for lines in _records(raw, encoding, sep, HEAD_BYTES):
            if len(lines):
                return len(next(csv.reader(io.StringIO(lines[0].as_py()), delimiter=sep)))
    return 0


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def list_members(archives: DataFrame, encoding: str = ENCODING, sep: str = SEPARATOR) -> DataFrame:
    """One row for each member of the archives named by ``path`` (folders and
    ``__MACOSX`` entries left out): path, archive, member, position, sizes, width
    of the first record, null; for an archive that cannot be opened, (path,
    archive, nulls, the error); for a member that cannot, its error."""
    def listed(path: str) -> Iterator[tuple]:
        try:
            with _opened(path) as raw, zipfile.ZipFile(raw) as zf:
                for position, info in enumerate(zf.infolist()):
                    if info.is_dir() or info.filename.startswith("__MACOSX"):
                        continue
                    width, error = None, None
                    try:
                        width = _width(zf, info, encoding, sep)
                    except UNREADABLE as exc:
                        error = repr(exc)
                    yield (path, _name(path), info.filename, position, info.file_size, info.compress_size, width, error)
        except UNREADABLE as exc:
            yield path, _name(path), None, None, None, None, None, repr(exc)

    types = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
    names = [c.split()[0] for c in MEMBER_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [r for path in b.column("path").to_pylist() for r in listed(path)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)

    return archives.select("path").mapInArrow(run, MEMBER_SCHEMA)


def read_members(members: DataFrame, encoding: str = ENCODING, sep: str = SEPARATOR,
                 tasks: int | None = None) -> DataFrame:
    """Every record of the listed members as (archive, member, number from 1, raw
    record, null), and (archive, member, nulls, the error) for what cannot be
    read, errors of the listing included. Members are dealt over ``tasks`` tasks
    (default: twice the session's parallelism), so those of one archive are read
    side by side."""
    def batch(zipped: str, member: str | None, first: int, lines: pa.Array, error: str | None) -> pa.RecordBatch:
        n = len(lines)
        return pa.RecordBatch.from_arrays(
            [pa.array([zipped] * n, pa.string()), pa.array([member] * n, pa.string()),
             pa.array(np.arange(first, first + n)) if error is None else pa.nulls(n, pa.int64()), lines,
             pa.array([error] * n, pa.string())], names=["arquivo_zip", "membro", "n_linha", "registro", "erro"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for m in b.to_pylist():
                error = m["erro"]
                if error is None:
                    try:
                        with _opened(m["path"]) as raw, zipfile.ZipFile(raw) as zf, \
                                zf.open(zf.infolist()[m["posicao"]]) as inflated:
                            first = 1
                            for lines in _records(inflated, encoding, sep):
                                for i in range(0, len(lines), 50_000):
                                    yield batch(m["arquivo_zip"], m["membro"], first + i, lines[i:i + 50_000], None)
                                first += len(lines)
                    except UNREADABLE as exc:
                        error = repr(exc)
                if error is not None:
                    yield batch(m["arquivo_zip"], m["membro"], 0, pa.nulls(1, pa.string()), error)

    tasks = tasks or 2 * default_parallelism(members.sparkSession)
    return members.select("path", "arquivo_zip", "membro", "posicao", "erro").repartition(tasks).mapInArrow(
        run, RECORD_SCHEMA)


def unzip_members(archives: DataFrame, encoding: str = ENCODING, sep: str = SEPARATOR) -> DataFrame:
    """``read_members`` of all members of the archives."""
    return read_members(list_members(archives, encoding, sep), encoding, sep)


def chosen_members(members: DataFrame) -> DataFrame:
    """Of each archive's listed members the one to ingest (``choose_member``);
    what could not be listed stays, with its error."""
    good = members.filter("erro is null")
    return good.join(choose_member(good), ["arquivo_zip", "membro"], "semi").select(*members.columns).union(
        members.filter("erro is not null"))


def read_archives(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """The archives below a folder: (path, length); contents are not read."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length")


def stream_archives(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Streaming variant: the binaryFile stream needs its schema spelled out.
    Only ``path`` is used later, so Spark does not read the contents either."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_SCHEMA)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def name_fields(records: DataFrame, layout: list[str], width: int, sep: str = SEPARATOR) -> DataFrame:
    """The records' fields by position: layout names, ``_c{i}`` for physical
    columns beyond the layout, fewer columns where the file is narrower."""
    names, _, _ = names_by_position(layout, width)
    schema = ", ".join(f"`{n}` string" for n in names)
    fields = F.from_csv("registro", schema, {"sep": sep, "quote": '"', "escape": '"'})
    return records.filter("erro is null").select(
        fields.alias("campos"), F.col("arquivo_zip").alias("file_source")).select("campos.*", "file_source")


def max_width(members: DataFrame) -> int:
    """Physical column count of the listed members (0: there is no record)."""
    row = members.agg(F.max("largura").alias("w")).first()
    return int(row["w"] or 0)


def with_provenance(df: DataFrame, source: str | None = None) -> DataFrame:
    """``file_source`` (archive name, or the scanned file's name) and load time."""
    src = F.lit(source) if source is not None else F.col("_metadata.file_name")
    if "file_source" in df.columns and source is None:
        return df.withColumn("ingestion_timestamp", F.current_timestamp())
    return df.withColumns({"file_source": src, "ingestion_timestamp": F.current_timestamp()})


def ingest_registry_batch(archives: DataFrame, entity: str, width: int | None = None) -> DataFrame:
    """All members of the archives of one registry entity -> named, all-string
    bronze rows."""
    members, layout = list_members(archives), REGISTRY_LAYOUTS[entity]
    width = max_width(members) if width is None else width
    return with_provenance(name_fields(read_members(members), layout, width or len(layout)))


def archive_glob(entity: str) -> str:
    return REGISTRY_ARCHIVES[entity][0]
