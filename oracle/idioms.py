"""SQL snippets the expected results share."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

TODAY = "DATE '2024-02-01'"
ORIGIN = (
    "false AS source_is_deleted, CAST(NULL AS VARCHAR) AS source_raw_id,"
    " source_extracted_at, CAST(NULL AS DOUBLE) AS source_generation_id"
)


def category(x: str, default: str = "UNKNOWN") -> str:
    return f"coalesce(nullif(upper(trim({x})), ''), '{default}')"


def codes(x: str, table: Mapping[str, Iterable[str]], default: str = "'UNKNOWN'") -> str:
    arms = " ".join(
        f"WHEN upper(trim({x})) IN ({', '.join(repr(a) for a in aliases)}) THEN '{code}'"
        for code, aliases in table.items()
    )
    return f"CASE {arms} ELSE {default} END"


def key(*parts: str) -> str:
    texts = ", ".join(f"coalesce(CAST({p} AS VARCHAR), '_dbt_null_')" for p in parts)
    return f"md5(concat_ws(chr(31), {texts}))"


def day_key(x: str) -> str:
    return f"CAST(strftime({x}, '%Y%m%d') AS INTEGER)"


def money(x: str, scale: int = 2) -> str:
    return f"CAST({x} AS DECIMAL(18,{scale}))"


def money0(x: str, scale: int = 2) -> str:
    """Never missing, never negative."""
    return f"CAST(greatest(coalesce({x}, 0), 0) AS DECIMAL(18,{scale}))"


def whole0(x: str) -> str:
    return f"CAST(CAST(greatest(coalesce({x}, 0), 0) AS DECIMAL(38,0)) AS BIGINT)"


def title(x: str) -> str:
    """Each word with a capital; words end at white space or punctuation."""
    words = f"regexp_extract_all(lower({x}), '[^\\s[:punct:]]+[\\s[:punct:]]*|[\\s[:punct:]]+')"
    return f"array_to_string([upper(w[1]) || w[2:] FOR w IN {words}], '')"


def newest(source: str, ids: Iterable[str], where: str) -> str:
    trimmed = ", ".join(f"trim({i})" for i in ids)
    return (
        f"SELECT DISTINCT ON ({trimmed}) * FROM {source} WHERE {where} ORDER BY {trimmed},"
        " _airbyte_extracted_at DESC NULLS FIRST, _airbyte_generation_id DESC NULLS FIRST"
    )


def half_up_units(units: str, divisor: str, scale: int) -> str:
    """Quotient of two integers in units of ``10 ** -scale``, rounded half away from zero."""
    n, d = f"CAST({units} AS HUGEINT)", f"CAST({divisor} AS HUGEINT)"
    return f"CAST(sign({n}) * ((2 * abs({n}) * {10**scale} + {d}) // (2 * {d})) AS DOUBLE)"


def half_up(units: str, divisor: str, scale: int) -> str:
    return f"{half_up_units(units, divisor, scale)} / {10**scale}"


def mean(x: str, scale: int) -> str:
    """Mean of decimals with four more places than they have; NULL for no rows."""
    units = half_up_units(f"sum({x}) * {10**scale}", f"count({x})", 4)
    return f"CASE WHEN count({x}) > 0 THEN {units} / {10 ** (scale + 4)} END"


def percentage(part: str, total: str) -> str:
    return f"CASE WHEN {total} > 0 THEN {half_up(f'100 * {part}', total, 2)} END"
