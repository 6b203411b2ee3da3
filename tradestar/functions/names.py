"""Column-name rules. They act on schemas (a handful of strings on the
driver), never on data, and end in a single ``toDF``/``select``."""

from __future__ import annotations

import re
import unicodedata

#: Columns that may hold the reference year and the month, best first (fixed values).
YEAR_COLUMNS = ("ano", "co_ano", "CO_ANO")
MONTH_COLUMNS = ("mes", "co_mes", "CO_MES")


def plain_name(name: str) -> str:
    """One header in the lake's spelling: no accents, lower case, underscores."""
    letters = (c for c in unicodedata.normalize("NFKD", name) if unicodedata.category(c) != "Mn")
    return re.sub("[ -]", "_", "".join(letters).lower().strip())


def header_names(headers: list[str]) -> list[str]:
    """A whole header in the lake's spelling. Headers that come out alike are
    numbered from the second on (``codigo``, ``codigo_2``), so every column can
    be named afterwards; a number never takes a name that is already there."""
    wanted = [plain_name(h) for h in headers]
    taken, out = set(wanted), []
    for name in wanted:
        if name in out:
            k = 2
            while f"{name}_{k}" in taken:
                k += 1
            name = f"{name}_{k}"
            taken.add(name)
        out.append(name)
    return out


def header_clashes(headers: list[str]) -> list[tuple[str, str]]:
    """(header, numbered name) of the columns that ``header_names`` had to number."""
    return [(h, n) for h, n in zip(headers, header_names(headers), strict=True) if n != plain_name(h)]


def fallback_name(name: str) -> str:
    """Rename used when a file has no layout: lower, space -> '_', accents kept."""
    return name.lower().replace(" ", "_")


def names_by_position(layout: list[str], width: int) -> tuple[list[str], list[str], list[str]]:
    """Names of a header-less file of ``width`` columns, the layout's columns that
    the file lacks, and the names (``_c{i}``, as the reader has them) of columns
    beyond the layout."""
    missing = layout[width:]
    surplus = [f"_c{i}" for i in range(len(layout), width)]
    return layout[:width] + surplus, missing, surplus


def rename_positional_names(current: list[str], new: list[str]) -> list[str]:
    """Rename by position as far as ``new`` goes; the other columns keep theirs."""
    return [*new[:len(current)], *current[len(new):]]


def partition_columns(columns: list[str]) -> list[str]:
    """The year column and the month column that a table is partitioned by, as
    far as it has them."""
    best = (next((c for c in names if c in columns), None) for names in (YEAR_COLUMNS, MONTH_COLUMNS))
    return [c for c in best if c is not None]
