"""PII by bootstrapped contextual extraction, in DataFrame operations only.

Seeds are what fixed formats recognise: e-mail and IP addresses, card numbers
(13 to 19 digits that pass Luhn) and phone numbers. The words around an
occurrence are its patterns: the two words before it, and the word before with
the word behind. Identifier-like tokens (they hold a digit) that no seed covers
are candidates. Spark builds the graph of patterns and instances and scores it
in rounds: a pattern is as good as the share of its instances that are
reliable, an instance as reliable as its patterns together make it. Candidates
that high-confidence patterns agree on become spans of kind ``context``.

Matching is leftmost and non-overlapping for each kind. The expressions are
written with possessive repeats and begin where a run of their characters
begins (or where the last match ended), which finds the same matches and keeps
long runs linear.

Rows: a null or empty text has no spans; repeated rows and repeated ids get
each row's own spans (a row is known by its id and a hash of its text); a
pattern needs SEEDS different reliable values, seeds or found in earlier rounds,
so copies of one document prove nothing. Tokens of fewer than TOKEN_CHARS
characters are no candidates. The time for a text grows with its length: running
sums and contexts work on groups of matches and blocks of text.
Context words are read from CONTEXT characters on either side. Extra columns
are carried, ``pii`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradestar.llm.scratch import Scratch

#: Kinds in their order in a list of spans.
KINDS = ("email", "ip", "card", "phone", "context")
_LOCAL = "A-Za-z0-9._%+-"
FORMATS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?:(?<![0-9])|\G)[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_SIGN = "A-Za-z0-9@_+"
#: A token with a digit in it, not cut out of a longer one.
TOKEN = (rf"(?<![{_SIGN}.:/-])(?=[A-Za-z@_+.:/-]*+[0-9])[{_SIGN}-]++(?:[.:/][{_SIGN}-]++)*+")
TOKEN_CHARS = 6
CONTEXT = 80
#: Characters of a block of text (more than CONTEXT), and matches of a group.
BLOCK, GROUP = 4096, 512
#: Different reliable values a pattern needs, and the score from which it may find spans.
SEEDS, CONFIDENT, RELIABLE, ROUNDS = 3, 0.5, 0.6, 3
#: Added to a pattern's instances, so that few of them give no full score.
DOUBT = 1.0


def _pairs(text: Column, pattern: str) -> Column:
    """All matches, each with what stands between it and the match before."""
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.zip_with(F.slice(between, F.lit(1), F.size(found)), found,
                      lambda b, f: F.struct(F.length(b).alias("skip"), F.length(f).alias("n"), f.alias("value")))


_PLACES = "array<struct<start:int,end:int,value:string>>"


def _places(pairs: Column) -> Column:
    """array<struct<start, end, value>> of ``_pairs``, in code points, by running
    sums. An array grows by copying, so sums run over GROUP matches at a time and
    over the groups' totals: linear in the matches, but for their number over
    GROUP squared."""
    groups = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / GROUP).cast("int")),
                         lambda g: F.slice(pairs, g * GROUP + 1, GROUP))
    totals = F.transform(groups, lambda g: F.aggregate(g, F.lit(0), lambda acc, x: acc + x["skip"] + x["n"]))
    begins = F.aggregate(totals, F.array(F.lit(0)), lambda acc, t: F.array_append(acc, F.element_at(acc, -1) + t))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["skip"]
        end = begin + x["n"]
        return F.struct(end.alias("at"), F.array_append(acc["out"], F.struct(
            begin.alias("start"), end.alias("end"), x["value"].alias("value"))).alias("out"))

    within = F.zip_with(groups, F.slice(begins, F.lit(1), F.size(groups)), lambda g, at: F.aggregate(
        g, F.struct(at.alias("at"), F.array().cast(_PLACES).alias("out")), step)["out"])
    return F.when(F.size(pairs) > 0, F.flatten(within)).otherwise(F.array().cast(_PLACES))


def _blocks(text: Column) -> Column:
    """A text in blocks of BLOCK characters: to take a part of it, Spark has to
    count characters from the start, which must not be the whole text's."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def _by_block(spans: Column, blocks: Column) -> Column:
    """For each block the spans that it holds some character of."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.size(blocks) - 1, F.lit(0))), lambda i: F.filter(
        spans, lambda s: (F.floor(s["start"] / BLOCK) <= i) & (F.floor((s["end"] - 1) / BLOCK) >= i)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    each = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(digits, n - i + 1, F.lit(1)).cast("int")
                       * (F.lit(1) + (i + 1) % 2))
    return F.aggregate(each, F.lit(0), lambda a, v: a + v - F.when(v > 9, 9).otherwise(0)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


_SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


#: The character that every match of a kind has, or None: a digit.
_NEEDED = {"email": "@", "phone": "+"}


def _pairs_of(text: Column) -> dict[str, Column]:
    """``_pairs`` of each kind's format and of tokens. A text without the
    character that every match needs is not searched."""
    none = F.array().cast("array<struct<skip:int,n:int,value:string>>")
    digit = text.rlike("[0-9]")
    return {kind: F.when(F.contains(text, F.lit(_NEEDED[kind])) if kind in _NEEDED else digit,
                         _pairs(text, pattern)).otherwise(none)
            for kind, pattern in {**FORMATS, "token": TOKEN}.items()}


def _valid_spans(kind: str, pairs: Column) -> Column:
    """The valid spans (kind, start, end, value) of a kind's matches."""
    return F.transform(F.filter(_places(pairs), lambda s: _valid(kind, s["value"])), lambda s: F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))


def _patterns(blocks: Column, start: Column, end: Column) -> Column:
    """The lexical patterns of an occurrence (null where a word is missing)."""
    some = lambda k: F.coalesce(F.get(blocks, k), F.lit(""))
    at, to = F.floor(start / BLOCK).cast("int"), F.floor(end / BLOCK).cast("int")
    # places in the block before and the block of the start; in that of the end and the next
    here = start - F.greatest(at - 1, F.lit(0)) * BLOCK
    around = F.concat(F.when(at > 0, some(at - 1)).otherwise(""), some(at))
    left = F.split(F.lower(F.substring(around, F.greatest(F.lit(1), here - CONTEXT + 1),
                                       F.least(here, F.lit(CONTEXT)))), r"\s+")
    right = F.split(F.lower(F.substring(F.concat(some(to), some(to + 1)), end - to * BLOCK + 1, F.lit(CONTEXT))),
                    r"\s+")
    words_left = F.filter(left, lambda w: w != "")
    one, two = F.try_element_at(words_left, F.lit(-1)), F.try_element_at(words_left, F.lit(-2))
    behind = F.try_element_at(F.filter(right, lambda w: w != ""), F.lit(1))
    return F.filter(F.array(F.concat(F.lit("2 "), two, F.lit(" "), one, F.lit(" _")),
                            F.concat(F.lit("1 "), one, F.lit(" _ "), behind)), lambda p: p.isNotNull())


def _found(df: DataFrame, id_col: str, text_col: str, keep: list[str]) -> DataFrame:
    """Each row with its base spans and all occurrences with their patterns. What
    is used more than once is a column of its own, so it is computed once."""
    text = F.col("body")
    src = df.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.col(id_col).alias("id"),
                    F.xxhash64(text_col).alias("tk"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    matched = src.select("row", "id", "tk", _blocks(text).alias("blocks"),
                         *[pairs.alias(f"pairs_{k}") for k, pairs in _pairs_of(text).items()])
    based = matched.select(
        "row", "id", "tk", "blocks",
        F.concat(*[_valid_spans(k, F.col(f"pairs_{k}")) for k in FORMATS]).alias("base"),
        F.filter(_places(F.col("pairs_token")), lambda t: F.length(t["value"]) >= TOKEN_CHARS).alias("tokens"))
    placed = based.withColumn("by_block", F.when(
        (F.size("base") > 0) & (F.size("tokens") > 0), _by_block(F.col("base"), F.col("blocks"))))

    def covered(t: Column) -> Column:
        # a span that meets the token holds a character of the block of its start or of its end
        meets = lambda k: F.exists(F.get(F.col("by_block"), F.floor(k / BLOCK).cast("int")), lambda s: (
            s["start"] < t["end"]) & (t["start"] < s["end"]))
        return F.coalesce(meets(t["start"]) | meets(t["end"] - 1), F.lit(False))

    occurrence = lambda o, seed: F.struct(
        o["start"].alias("start"), o["end"].alias("end"), F.lower(o["value"]).alias("value"),
        F.lit(seed).alias("seed"), _patterns(F.col("blocks"), o["start"], o["end"]).alias("patterns"))
    free = placed.withColumn("tokens", F.filter("tokens", lambda t: ~covered(t)))
    return free.select("row", "id", "tk", "base", F.concat(
        F.transform("base", lambda s: occurrence(s, True)),
        F.transform("tokens", lambda t: occurrence(t, False))).alias("seen"))


def _scored(work: Scratch, edges: DataFrame, rounds: int) -> tuple[DataFrame, DataFrame]:
    """Scores of patterns and of instances after ``rounds`` rounds."""
    seeds = edges.filter("seed").select("value").distinct().withColumn("seeded", F.lit(1.0))
    pairs = work.stored(edges.select("pattern", "value").distinct(), "pairs")
    # a pattern of fewer different values never has enough reliable ones; no other is dropped
    enough = pairs.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= SEEDS).select("pattern")
    pairs = work.stored(pairs.join(enough, "pattern", "left_semi"), "live")
    reliable = seeds.withColumnRenamed("seeded", "r")
    for k in range(rounds):
        patterns = work.stored(
            pairs.join(reliable, "value", "left").groupBy("pattern")
            .agg((F.sum(F.coalesce("r", F.lit(0.0))) / (F.count(F.lit(1)) + DOUBT)).alias("score"),
                 F.count(F.when(F.col("r") >= RELIABLE, 1)).alias("support"))
            .filter(F.col("support") >= SEEDS).select("pattern", "score"), f"patterns{k}")
        votes = (pairs.join(patterns.filter(F.col("score") >= CONFIDENT), "pattern").groupBy("value")
                 .agg((1 - F.exp(F.sum(F.log1p(-F.col("score"))))).alias("r")))
        reliable = work.stored(votes.join(seeds, "value", "full").select(
            "value", F.coalesce("seeded", "r").alias("r")), f"instances{k}")
    return patterns, reliable


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
         carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``df`` (default: all but the text) plus ``pii`` =
    struct(tk (hash of the text), base, spans): arrays of (kind, start, end,
    value), by kind and start; ``spans`` holds the base and the found ones."""
    work = Scratch(df.sparkSession)
    keep = [c for c in df.columns if c not in (text_col, "pii")] if carry is None else carry
    found = work.stored(_found(df, id_col, text_col, keep), "found")
    seen = found.select("id", "tk", F.explode("seen").alias("o")).select(
        "id", "tk", "o.start", "o.end", "o.value", "o.seed", F.explode("o.patterns").alias("pattern"))
    patterns, reliable = _scored(work, seen, rounds)
    sure = patterns.filter(F.col("score") >= CONFIDENT).select("pattern")
    more = (seen.filter("not seed").join(sure, "pattern", "left_semi")
            .join(reliable.filter(F.col("r") >= RELIABLE).select("value"), "value", "left_semi")
            .groupBy("id", "tk").agg(F.collect_set(F.struct(
                F.lit(KINDS[-1]).alias("kind"), "start", "end", "value")).alias("more"))
            .withColumnsRenamed({"id": "more_id", "tk": "more_tk"}))
    joined = found.join(more, F.col("id").eqNullSafe(F.col("more_id")) & (F.col("tk") == F.col("more_tk")), "left")
    spans = F.concat("base", F.array_sort(F.coalesce("more", F.array().cast(_SPANS))))
    return joined.select("row.*", F.struct("tk", "base", spans.alias("spans")).alias("pii"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``df`` with every span of its texts replaced by ``[KIND]``; overlapping
    spans become the first one's. A null text stays null."""
    spans = (find(df.select(id_col, text_col), id_col, text_col, rounds)
             .filter(F.size("pii.spans") > 0)
             .groupBy(F.col(id_col).alias("span_id"), F.col("pii.tk").alias("span_tk"))
             .agg(F.first("pii.spans").alias("spans")))
    rows = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row"), F.col(id_col).alias("id"),
                     F.xxhash64(text_col).alias("tk"), F.col(text_col).alias("body"))
    joined = rows.join(spans, F.col("id").eqNullSafe(F.col("span_id")) & (F.col("tk") == F.col("span_tk")), "left")
    in_order = F.array_sort(F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    ready = joined.select("row", "body", in_order.alias("spans"), F.when(F.col("spans").isNotNull(), _blocks(
        F.col("body"))).alias("blocks"))
    ready = ready.withColumn("by_block", _by_block(F.col("spans"), F.col("blocks")))
    part = "array<string>"

    def block(text: Column, k: Column) -> Column:
        """A block's text without its spans; the label stands where a span begins
        that no earlier one covers."""
        first = k * BLOCK

        def step(acc: Column, s: Column) -> Column:
            fresh = F.concat(F.substring(text, acc["at"] - first + 1, s["start"] - acc["at"]), F.lit("["),
                             F.upper(s["kind"]), F.lit("]"))
            out = F.when(s["start"] >= acc["at"], F.array_append(acc["out"], fresh)).otherwise(acc["out"])
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

        return F.aggregate(F.get(F.col("by_block"), k), F.struct(first.alias("at"), F.array().cast(part).alias("out")),
                           step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(
                               text, acc["at"] - first + 1, F.lit(BLOCK))))

    new = F.array_join(F.transform("blocks", block), "")
    return ready.select(*[F.when(F.col("spans").isNull(), F.col("body")).otherwise(new).alias(c) if c == text_col
                          else F.col(f"row.{c}").alias(c) for c in df.columns])
