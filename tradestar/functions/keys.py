"""Column expressions for the star schema. All stay JVM-side (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES — Portuguese month names of the date dimension and its default.
# ---------------------------------------------------------------------------
MONTH_NAMES_PT = {
    1: "Janeiro", 2: "Fevereiro", 3: "Março", 4: "Abril",
    5: "Maio", 6: "Junho", 7: "Julho", 8: "Agosto",
    9: "Setembro", 10: "Outubro", 11: "Novembro", 12: "Dezembro",
}
UNKNOWN_MONTH = "Desconhecido"
UNKNOWN_STATE = "XX"                       # stands for a missing state in the fact
DEFAULT_PRODUCT_NAME = "Descrição não disponível"
DEFAULT_TRANSPORT_NAME = "Via não informada"
DEFAULT_COUNTRY_NAME = "País Desconhecido"
EXPORT = "EXPORTACAO"
IMPORT = "IMPORTACAO"
LEVEL_COUNTRY = "PAIS"
LEVEL_STATE = "UF"
HOME_COUNTRY = "Brasil"
# --------------------------------------------------------------------------- end fixed values


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def surrogate_key(code) -> Column:
    """Code -> bigint key; text that is not a number gives null (never an
    ANSI error), so the fact's row-quality gate can drop it."""
    return _c(code).try_cast("bigint")


def measure(value) -> Column:
    return _c(value).try_cast("decimal(18,2)")


def month_key(ano, mes) -> Column:
    """YYYYMM as bigint."""
    return (_c(ano) * 100 + _c(mes)).cast("bigint")


def first_of_month(ano, mes) -> Column:
    """First day of the month; null when a part is missing or out of range."""
    a, m = _c(ano), _c(mes)
    text = F.concat_ws("-", F.lpad(a.cast("string"), 4, "0"),
                       F.lpad(m.cast("string"), 2, "0"), F.lit("01"))
    return F.when(a.isNotNull() & m.isNotNull(), F.try_to_date(text, "yyyy-MM-dd"))


def quarter(mes) -> Column:
    return F.ceil(_c(mes) / 3).cast("int")


def semester(mes) -> Column:
    return F.ceil(_c(mes) / 6).cast("int")


def month_name(mes) -> Column:
    """Month name by map lookup; a missing key yields null, then the default."""
    pairs = [x for k, v in MONTH_NAMES_PT.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.create_map(*pairs)[_c(mes)], F.lit(UNKNOWN_MONTH))


def state_key(uf) -> Column:
    """Two-letter state code -> ascii(1st) * 100 + ascii(2nd) as bigint."""
    u = _c(uf)
    return (F.ascii(F.substring(u, 1, 1)) * 100 + F.ascii(F.substring(u, 2, 1))).cast("bigint")


def state_key_or_unknown(uf) -> Column:
    """State key for the fact: a null state becomes the 'XX' member (8888)."""
    return state_key(F.coalesce(_c(uf), F.lit(UNKNOWN_STATE)))


def null_if_sentinel(c, sentinels: tuple[str, ...] = ()) -> Column:
    """Treat sentinel strings written by a null fill (e.g. 'N/A') as missing."""
    col = _c(c)
    for s in sentinels:
        col = F.nullif(col, F.lit(s))
    return col
