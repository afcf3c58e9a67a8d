"""DuckDB SQL text for the scalar functions (oracle side).

Independent SQL formulations of the Column functions in
``qualis.functions.parse``; used only to build the oracle queries.
"""

from __future__ import annotations

from qualis.functions.parse import DATE_SHAPES, FLOAT_SHAPE, ISO_SHAPE, WS_CLASS


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS_CLASS}]+|[{WS_CLASS}]+\\z', '', 'g')"


def parse_date_stripped(s: str) -> str:
    """Date from an already stripped text expression."""
    parts = []
    for pat, gy, gm, gd in DATE_SHAPES:
        y = f"regexp_extract({s}, {q(pat)}, {gy})"
        m = f"lpad(regexp_extract({s}, {q(pat)}, {gm}), 2, '0')"
        d = f"lpad(trim(regexp_extract({s}, {q(pat)}, {gd})), 2, '0')"
        parts.append(f"CASE WHEN regexp_matches({s}, {q(pat)}) AND {y} <> '0000' "
                     f"THEN try_cast({y} || '-' || {m} || '-' || {d} AS DATE) END")
    return "COALESCE(" + ", ".join(parts) + ")"


def parse_date(x: str) -> str:
    return parse_date_stripped(strip(x))


def is_iso(x: str) -> str:
    return (f"(regexp_matches({x}, {q(ISO_SHAPE)}) AND substring({x}, 1, 4) <> '0000' "
            f"AND try_cast({x} AS DATE) IS NOT NULL)")


def parse_float_stripped(s: str) -> str:
    special = "(?i)^[+-]?(nan|inf|infinity)\\z"
    return (f"CASE WHEN regexp_matches({s}, {q(special)}) THEN "
            f"(CASE WHEN contains(lower({s}), 'nan') THEN 'nan'::DOUBLE "
            f"WHEN starts_with({s}, '-') THEN '-inf'::DOUBLE ELSE 'inf'::DOUBLE END) "
            f"WHEN regexp_matches({s}, {q(FLOAT_SHAPE)}) THEN try_cast(replace({s}, '_', '') AS DOUBLE) END")


FLOAT_WS_CLASS = WS_CLASS.replace("\\x{1c}-\\x{1f}", "")


def parse_float(x: str) -> str:
    return parse_float_stripped(f"regexp_replace({x}, '^[{FLOAT_WS_CLASS}]+|[{FLOAT_WS_CLASS}]+\\z', '', 'g')")


def to_number(x: str) -> str:
    """Numeric coercion: no digit separators, not-a-number is missing."""
    f = parse_float(x)
    return f"(CASE WHEN contains({x}, '_') OR isnan({f}) THEN NULL ELSE {f} END)"


def fmt_g(x: str) -> str:
    """Python format(x, 'g')."""
    sci = f"printf('%.5e', abs({x}))"
    mant = f"split_part({sci}, 'e', 1)"
    e = f"CAST(split_part({sci}, 'e', 2) AS INTEGER)"
    digits = f"replace({mant}, '.', '')"

    def joined(whole: str, frac: str) -> str:
        f = f"regexp_replace({frac}, '0+$', '')"
        return f"(CASE WHEN {f} = '' THEN {whole} ELSE {whole} || '.' || {f} END)"

    zero = "'0'"
    fixed = (f"(CASE WHEN {e} >= 0 THEN {joined(f'substring({digits}, 1, {e} + 1)', f'substring({digits}, {e} + 2)')} "
             f"ELSE {joined(zero, f'repeat({zero}, greatest(-{e} - 1, 0)) || {digits}')} END)")
    sci_txt = (f"(regexp_replace(regexp_replace({mant}, '0+$', ''), '\\.$', '') || 'e' || "
               f"(CASE WHEN {e} < 0 THEN '-' ELSE '+' END) || lpad(CAST(abs({e}) AS VARCHAR), 2, '0'))")
    body = f"(CASE WHEN {e} >= -4 AND {e} < 6 THEN {fixed} ELSE {sci_txt} END)"
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN isnan({x}) THEN 'nan' "
            f"WHEN {x} = 'inf'::DOUBLE THEN 'inf' WHEN {x} = '-inf'::DOUBLE THEN '-inf' "
            f"ELSE (CASE WHEN signbit({x}) THEN '-' ELSE '' END) || {body} END)")


def error_id(n: str) -> str:
    return f"('E' || CASE WHEN {n} < 100000 THEN lpad(CAST({n} AS VARCHAR), 5, '0') ELSE CAST({n} AS VARCHAR) END)"


def norm_key(x: str) -> str:
    return f"lower({strip(x)})"


def map_case(mapping: dict[str, str], key: str) -> str:
    if not mapping:
        return "CAST(NULL AS VARCHAR)"
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"(CASE {key} {whens} END)"


def round_cents(x: str) -> str:
    return f"(round_even(CAST({x} AS DOUBLE) * 100.0, 0) / 100.0)"
