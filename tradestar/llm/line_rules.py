"""Quality rules, line first.

Each line of a text meets three rules; a line that fails any is removed, and a
document that loses too much of its words is rejected.

- punctuation: a line of several words must hold a sentence mark, and neither
  symbols nor exclamations may crowd its words;
- navigation: cells or crumbs between separators, or a short list of links;
- boilerplate: a phrase that sites print on every page.

Rows: a null text has no words (it is rejected, as every text under ten words
is); blank lines are neither kept nor lost words; repeated rows are judged
alike. Extra columns are carried, ``rules`` is replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradestar.llm.textblocks import U64, blocks, mix

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
SENTENCE_MARKS = ".!?…。！？।؟"
SEPARATORS = ("|", ">", "»", "›", "·", "•", "/")
BOILERPLATE = ("all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
               "use of cookies", "accept cookies", "skip to content", "skip to main", "click here", "sign up",
               "log in", "subscribe to", "share this", "read more", "back to top", "javascript is disabled",
               "enable javascript", "powered by", "lorem ipsum")
_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE)))
#: Words of a line from which it must hold a sentence mark.
UNMARKED_WORDS = 8
#: Symbols, and words that end in an exclamation, for each word of a line.
SYMBOL_SHARE, EXCLAIM_SHARE = 0.3, 0.4
#: Words from which shares are meaningful.
SHARE_WORDS = 4
#: Separators that stand alone, for each other word of a line.
SEPARATOR_SHARE = 0.3
#: A boilerplate line is no longer than this; longer ones are prose about it.
BOILERPLATE_WORDS = 25
#: Share of a document's word characters that may go.
LOSS = 0.5
WINDOW = 5


def failed_rule(line: str) -> str | None:
    """The first rule that the line fails."""
    words = line.split()
    n = len(words)
    if not n:
        return None
    alone = sum(map(words.count, SEPARATORS)) if any(s in line for s in SEPARATORS) else 0
    if alone and alone >= SEPARATOR_SHARE * max(1, n - alone):
        return "navigation"
    if n <= BOILERPLATE_WORDS and _BOILERPLATE.search(line.lower()):
        return "boilerplate"
    if n >= UNMARKED_WORDS and not any(m in line for m in SENTENCE_MARKS):
        return "punctuation"
    if n >= SHARE_WORDS:
        if sum(map(line.count, SYMBOLS)) > SYMBOL_SHARE * n:
            return "punctuation"
        if "!" in line and sum(w[-1] == "!" for w in words) > EXCLAIM_SHARE * n:
            return "punctuation"
    return None


@dataclass
class Verdict:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    base_failed: bool
    kept: bool
    lost_chars: int
    n_failed_lines: int
    clean: str


def _chars(text: str) -> int:
    return len(text) - sum(map(text.count, WHITE))


def _repeated(ids: np.ndarray) -> int:
    """Words that stand in a window of WINDOW words found twice or more."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    h = np.zeros(n, U64)
    for k in range(WINDOW):
        h = mix(h * U64(0x9E3779B97F4A7C15) + ids[k:k + n].astype(U64) + U64(1))
    _, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[inverse] > 1)
    if not len(at):
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(edge)))


def judge(text: str) -> Verdict:
    """Base counts, and the verdict of the line rules, of one whole text."""
    words = text.encode().split()  # bytes: the six ASCII spaces
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    n, chars = len(words), _chars(text)
    repeated = _repeated(ids)
    lines = text.split("\n")
    seen: set[str] = set()
    dup = failed = lost = 0
    clean = []
    for line in lines:
        size = _chars(line)
        if size:
            dup += line in seen
            seen.add(line)
            if failed_rule(line):
                failed += 1
                lost += size
                continue
        clean.append(line)
    base_failed = n < 10 or 100 * repeated > 20 * n
    return Verdict(n, chars, sum(map(text.count, SYMBOLS)), dup, repeated, base_failed,
                   not base_failed and lost <= LOSS * chars, lost, failed, "\n".join(clean))


RULES = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()), T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()), T.StructField("lost_chars", T.LongType()),
    T.StructField("n_failed_lines", T.LongType()), T.StructField("clean", T.StringType())])


def _judged(with_text: bool):
    names = [f.name for f in RULES if with_text or f.name != "clean"]
    kinds = {"LongType()": pa.int64(), "BooleanType()": pa.bool_(), "StringType()": pa.string()}

    def run(batches):
        for b in batches:
            out = []
            for _, _, data, off in blocks(b.column("body")):
                raw, cuts = data.tobytes(), off.tolist()
                out += [judge(raw[a:z].decode()) for a, z in zip(cuts, cuts[1:], strict=False)]
            arrays = [pa.array([getattr(v, n) for v in out], kinds[str(RULES[n].dataType)]) for n in names]
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.StructArray.from_arrays(arrays, names=names)], names=["row", "rules"])
    return run


def clean(df: DataFrame, text_col: str = "text", carry: list[str] | None = None,
          with_text: bool = True) -> DataFrame:
    """The columns ``carry`` of ``df`` (default: all) plus ``rules`` = struct of
    the base counts, ``kept``, ``lost_chars``, ``n_failed_lines`` and, unless
    left out, the cleaned text ``clean``."""
    keep = [c for c in df.columns if c != "rules"] if carry is None else carry
    src = df.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.col(text_col).alias("body"))
    rules = T.StructType([f for f in RULES if with_text or f.name != "clean"])
    schema = T.StructType([src.schema["row"], T.StructField("rules", rules)])
    return src.mapInArrow(_judged(with_text), schema).select("row.*", "rules")
