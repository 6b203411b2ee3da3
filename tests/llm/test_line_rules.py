"""Line rules: base counts against their definitions, and the verdict."""

import random
import re

from tradestar.llm.line_rules import clean, failed_rule, judge

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i:i + 5]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered),
            len(words) < 10 or 100 * len(covered) > 20 * len(words))


PROSE = "The river bends by the old mill. Boats pass there in the morning, and nobody minds.\n"


def test_base_counts_on_random_texts():
    rng = random.Random(1)
    for _ in range(400):
        text = "".join(rng.choice(["a", "b", "é ", " ", "\n", "\t", "c d", "#", "|", "\x1f", " ", "\x0b", "a b\n"])
                       for _ in range(rng.randint(0, 120)))
        v = judge(text)
        assert (v.n_words, v.word_chars, v.n_symbols, v.n_dup_lines, v.n_repeat_words, v.base_failed) == brute(text)


def test_rules():
    assert failed_rule("Home | News | Sports | Weather | Contact") == "navigation"
    assert failed_rule("Home > Shop > Shoes") == "navigation"
    assert failed_rule("All rights reserved.") == "boilerplate"
    assert failed_rule("one two three four five six seven eight nine") == "punctuation"
    assert failed_rule("On%%% the&&& way*** home### we%%% went.") == "punctuation"
    assert failed_rule("BUY!! THIS!! NOW!! OR!! NEVER!!") == "punctuation"
    for fine in ("", "  ", "Yes.", "A short heading", PROSE.strip(), "It costs 50% and/or $3, he said.",
                 "Stop! he cried, and the whole crowd stood still."):
        assert failed_rule(fine) is None


def test_verdict():
    assert judge(PROSE * 1 + "We read all of it again by lamp light.").kept
    junk = "\n".join(f"w{i} | x{i} | y{i} | z{i}" for i in range(9))
    v = judge(PROSE + junk)
    assert not v.kept and not v.base_failed and v.n_failed_lines == 9 and v.clean == PROSE.rstrip("\n")
    assert judge(PROSE * 5).base_failed and not judge("Too short.").kept


def test_table(spark):
    rows = [(1, None, "r"), (2, "", "r"), (3, PROSE + "An end.", "r"), (3, PROSE + "An end.", "r"), (4, "x " * 70000, "r")]
    df = spark.createDataFrame(rows, "doc_id long, text string, rules string")
    got = clean(df).collect()
    assert len(got) == 5 and got[0].asDict().keys() == {"doc_id", "text", "rules"}
    for r in got:
        v = r.rules
        assert (v.n_words, v.word_chars, v.n_symbols, v.n_dup_lines, v.n_repeat_words, v.base_failed) == brute(r.text)
    assert clean(df.limit(0)).collect() == []
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for r in clean(docs).collect():
        v = r.rules
        assert (v.n_words, v.word_chars, v.n_symbols, v.n_dup_lines, v.n_repeat_words, v.base_failed) == brute(r.text)
