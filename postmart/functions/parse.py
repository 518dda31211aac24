"""Parsing and type coercion of raw posting cells (whole-column expressions).

``read_list`` / ``read_dict`` / ``read_json`` read Python-literal cells such as ``"['python',
'sql']"`` on the JVM, without a Python worker:

* most cells are plain lists of single-quoted words; a strict pattern recognises those and
  Spark's JSON reader decodes them;
* other cells are cut into tokens by one pattern (strings with either quote, triple quotes and
  escapes, numbers, names, punctuation). The tokens' kinds, one letter each, must match the grammar
  of a literal, which for nesting up to ``MOST_NESTING`` levels is a regular expression; each
  token is turned into JSON (escapes decoded code point by code point), and the JSON is read.

Literals outside that grammar which the source's parser would still accept (brackets nested
deeper, numbers written otherwise than Python prints them, bytes, sets, parentheses, adjacent
strings, comments) give NULL here. ``unread_list`` / ``unread_dict`` mark exactly the cells
that might be such; ``mend_cells`` sends those rows, and only those, through Python's own
``ast.literal_eval``, and adds no Python step where there are none. ``parse_list`` /
``parse_dict`` / ``dict_json`` are the same as single column expressions: exact for every
literal, with an Arrow-batched Python step in the plan that is fed only cells not of the plain shape.
"""

from __future__ import annotations

import ast
import sys
import warnings
from collections.abc import Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import EMPTY_DICT_TOKENS, EMPTY_LIST_TOKENS

# Fixed patterns: one single-quoted item without quotes, backslashes or control
# characters, a list of such items, and a dict of such items to such lists. Possessive
# quantifiers keep matching linear on long cells.
_ITEM = r"'[^'\\\x00-\x1f]*+'"
_LIST_BODY = rf"\[(?:{_ITEM}(?:, ?{_ITEM})*+)?+\]"
LIST_FAST_PATTERN = rf"^\[(?:{_ITEM}(?:, ?{_ITEM})*+)\]\z"
DICT_FAST_PATTERN = rf"^\{{{_ITEM}: ?{_LIST_BODY}(?:, ?{_ITEM}: ?{_LIST_BODY})*+\}}\z"

STRING_LIST = T.ArrayType(T.StringType())
SKILL_MAP = T.MapType(T.StringType(), STRING_LIST)

#: Brackets within brackets that the pattern of a dict literal covers.
MOST_NESTING = 3

# Tokens of a literal. A backslash takes the next character along; a line may end inside triple quotes only.
_BODY = r"(?:[^{q}\\\n\r\x00]|\\[\s\S])*+"
_TRIPLE = r"(?:[^{q}\\\x00]|\\[\s\S]|{q}(?!{q}{q}))*+"
_STRINGS = "|".join([*("{q}{q}{q}".format(q=q) + _TRIPLE.format(q=q) + "{q}{q}{q}".format(q=q) for q in "'\""),
                     *(q + f"(?!{q}{q})" + _BODY.format(q=q) + q for q in "'\"")])
# Numbers as Python itself prints them, so that their text is also their value's text.
_NUMBERS = "(?:" + "|".join([
    r"-?[1-9][0-9]{0,300}+", "0", r"-?[1-9][0-9]{0,8}+\.(?:0|[0-9]{0,5}[1-9])", r"-?0\.(?:0|(?=[0-9]{0,3}[1-9])[0-9]{0,9}[1-9])",
]) + r")(?![0-9A-Za-z_.])"
_TOKEN = rf"[uU]?(?:{_STRINGS})|{_NUMBERS}|(?:None|True|False)\b|[\[\]{{}},:]|[ \t\n\r\f]++"
# Letters of the tokens' kinds.
_STRING, _PLAIN = "s", "n"

# The escapes of one letter.
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "a": "\a", "v": "\v", "\\": "\\", "'": "'", '"': '"', "\n": ""}
_ESCAPE = r"\\(?:[0-7]{1,3}|x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|[\s\S])|[^\\]++"

# Ship the literal-parsing UDFs by value: Python workers (on any executor) then need only
# the standard library and pandas, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _comma_list(item: str) -> str:
    return f"(?:{item}(?:,{item})*+,?+)?+"


def _value_pattern(nesting: int) -> str:
    """Kinds of a value with at most so many brackets inside one another; possessive, so linear."""
    if not nesting:
        return "[sn]"
    inner = _value_pattern(nesting - 1)
    return rf"(?:[sn]|\[{_comma_list(inner)}\]|\{{{_comma_list(f's:{inner}')}\}})"


_LIST_KINDS = rf"^\[{_comma_list('[sn]')}\]\z"
_DICT_OF_LISTS_KINDS = rf"^\{{{_comma_list(rf's:(?:[sn]|\[{_comma_list(chr(91) + 'sn]')}\])')}\}}\z"
_DICT_KINDS = rf"^\{{{_comma_list('s:' + _value_pattern(MOST_NESTING))}\}}\z"


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(name: str, value: str, body: str) -> str:
    """SQL of ``body`` with ``value`` worked out once, however often it is used."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _any_of(value: str, choices: Sequence[str]) -> str:
    return f"{value} IN ({', '.join(map(_text, choices))})"


_MARKS, _BLANKS, _QUOTES = ("[", "]", "{", "}", ",", ":"), (" ", "\t", "\n", "\r", "\f"), ("'", '"', "u", "U")


def _unescaped(body: str) -> str:
    """SQL of a string's text, escapes decoded; NULL for what is no escape or not decoded here (names, surrogates)."""
    letters = " ".join(f"WHEN mark = {_text(k)} THEN {_text(v)}" for k, v in _ESCAPES.items())
    digits = "CASE WHEN mark RLIKE '[0-7]' THEN conv(substr(p, 2), 8, 10) ELSE conv(substr(p, 3), 16, 10) END"
    character = "CASE WHEN n < 55296 OR n > 57343 AND n <= 1114111 THEN decode(unhex(lpad(hex(n), 8, '0')), 'UTF-32') END"
    escape = f"""CASE WHEN length(p) = 2 AND NOT mark RLIKE '[0-7]' THEN
                 CASE WHEN {_any_of('mark', 'xuUN')} THEN NULL {letters} ELSE p END
                 ELSE {_let('n', f'CAST({digits} AS BIGINT)', character)} END"""
    piece = f"CASE WHEN substr(p, 1, 1) <> {_text(chr(92))} THEN p ELSE {_let('mark', 'substr(p, 2, 1)', escape)} END"
    # array_join would skip a NULL piece.
    return _let("ps", f"transform(regexp_extract_all({body}, {_text(_ESCAPE)}, 0), p -> {piece})",
                "CASE WHEN NOT exists(ps, p -> p IS NULL) THEN array_join(ps, '') END")


def _string_token(token: str) -> str:
    """SQL of the text of a string token."""
    quotes = "CASE WHEN length(plain) >= 6 AND " + _any_of("substr(plain, 1, 3)", ("'''", '"""')) + " THEN 3 ELSE 1 END"
    inside = _let("q", quotes, "substr(plain, q + 1, length(plain) - 2 * q)")
    ends = f"regexp_replace({inside}, '\\r\\n?', '\\n')"  # the source's parser reads line ends so
    decoded = f"CASE WHEN contains(body, {_text(chr(92))}) THEN {_unescaped('body')} ELSE body END"
    return _let("plain", f"regexp_replace({token}, '^[uU]', '')", _let("body", ends, decoded))


def _json(cell: str, kinds: str, typed: bool) -> str:
    """SQL of the JSON text of a cell whose tokens' kinds match a pattern, else NULL.

    ``typed`` keeps numbers and truth values, else they become text as Python prints them.
    """
    first = "substr(t, 1, 1)"
    kind = f"CASE WHEN {_any_of(first, _QUOTES)} THEN '{_STRING}' WHEN {_any_of(first, _MARKS)} THEN t ELSE '{_PLAIN}' END"
    quoted = _let("v", _string_token("t"), "CASE WHEN v IS NOT NULL THEN regexp_replace(to_json(array(v)), '^\\\\[|\\\\]$', '') END")
    plain = "CASE WHEN t IN ('True', 'False') THEN lower(t) ELSE t END" if typed else "concat('\"', t, '\"')"
    last_comma = "t = ',' AND get(tokens, i + 1) IN (']', '}')"
    piece = f"""CASE WHEN {last_comma} THEN '' WHEN {_any_of(first, _MARKS)} THEN t
                WHEN {_any_of(first, _QUOTES)} THEN {quoted} WHEN t = 'None' THEN 'null' ELSE {plain} END"""
    joined = _let("pieces", f"transform(tokens, (t, i) -> {piece})",
                  "CASE WHEN NOT exists(pieces, x -> x IS NULL) THEN array_join(pieces, '') END")
    translated = f"CASE WHEN array_join(transform(tokens, t -> {kind}), '') RLIKE {_text(kinds)} THEN {joined} END"
    solid = _let("tokens", f"filter(found, t -> NOT {_any_of(first, _BLANKS)})", translated)
    whole = f"aggregate(found, 0, (n, t) -> n + length(t)) = length({cell})"
    return _let("found", f"regexp_extract_all({cell}, {_text(_TOKEN)}, 0)", f"CASE WHEN {whole} THEN {solid} END")


def _plain_json(cell: str) -> str:
    """SQL of the JSON text of a cell of the plain shape (single quotes, no backslashes inside)."""
    return f"replace(replace({cell}, '\"', {_text(chr(92) + chr(34))}), {_text(chr(39))}, '\"')"


def _name(c: str) -> str:
    if not isinstance(c, str):
        raise TypeError("name the column that holds the cells")
    return "`" + c.replace("`", "``") + "`"


def _opened(cell: str) -> str:
    """SQL of the cell without the white space that may stand in front of a literal."""
    return f"ltrim({_text(' ' + chr(9))}, {cell})"


def _item_text(x) -> str | None:
    """An item as text; half of a surrogate pair, which no text column can hold, becomes '?'."""
    if x is None:
        return None
    return (x if isinstance(x, str) else str(x)).encode("utf-8", "replace").decode()


def _literal(v: str):
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore", SyntaxWarning)
            return ast.literal_eval(v)
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
        return None


@F.pandas_udf(STRING_LIST)
def _literal_list(cells: pd.Series) -> pd.Series:
    out = []
    for v in cells:
        parsed = None if v is None else _literal(v)
        out.append([_item_text(x) for x in parsed] if isinstance(parsed, list) else None)
    return pd.Series(out, dtype=object)


@F.pandas_udf(SKILL_MAP)
def _literal_dict(cells: pd.Series) -> pd.Series:
    out = []
    for v in cells:
        parsed = None if v is None else _literal(v)
        if isinstance(parsed, dict):
            out.append({
                _item_text(k): ([_item_text(x) for x in items] if isinstance(items, list) else None)
                for k, items in parsed.items() if k is not None
            })
        else:
            out.append(None)
    return pd.Series(out, dtype=object)


def read_list(c: str) -> Column:
    """Python list literal of texts, numbers, truth values and None -> array<string>; ``c`` names a text column.

    Missing, ``''`` and exactly ``'[]'`` give NULL; anything that is not a list literal
    (tuple, dict, junk) gives NULL; ``'[ ]'`` gives an empty array. Non-text items are
    rendered as text, a ``None`` item stays a NULL element.
    """
    c = _name(c)
    return F.expr(f"""CASE WHEN {c} IS NULL OR {_any_of(c, EMPTY_LIST_TOKENS)} THEN NULL
        WHEN {c} RLIKE {_text(LIST_FAST_PATTERN)} THEN from_json({_plain_json(c)}, 'array<string>')
        WHEN startswith({_opened(c)}, '[') THEN {_let('cell', _opened(c), f"from_json({_json('cell', _LIST_KINDS, False)}, 'array<string>')")}
        END""")


def read_dict(c: str) -> Column:
    """Python dict literal from texts to such lists or single values -> map<string, array<string>>.

    Same empty rules as ``read_list`` with ``'{}'``. A key whose value is not a list is
    kept with a NULL value. A repeated key keeps its last value.
    """
    c = _name(c)
    # Values as raw text first: one that is no list becomes NULL without losing the cell.
    text = f"""CASE WHEN {c} IS NULL OR {_any_of(c, EMPTY_DICT_TOKENS)} THEN NULL
        WHEN {c} RLIKE {_text(DICT_FAST_PATTERN)} THEN {_plain_json(c)}
        WHEN startswith({_opened(c)}, '{{') THEN {_let('cell', _opened(c), _json('cell', _DICT_OF_LISTS_KINDS, False))} END"""
    value = "CASE WHEN startswith(e.value, '[') THEN from_json(e.value, 'array<string>') END"
    # Most have no repeated key, which one distinct tells; else an entry stays whose key no later one has.
    last = """CASE WHEN size(array_distinct(es.key)) = size(es) THEN es ELSE filter(es, (e, i) ->
        NOT exists(slice(es, i + 2, size(es)), f -> f.key = e.key)) END"""
    entries = f"map_entries(from_json({text}, 'map<string, string>'))"
    return F.expr(_let("es", entries, f"map_from_entries(transform({last}, e -> struct(e.key, {value})))"))


def _may_open(c: str, bracket: str) -> Column:
    """Cells in which the source's parser might find such a bracket outermost."""
    return F.col(_name(c)).rlike(rf"^[ \t\n\r\f\\]*+[\{bracket}(#]")


def unread_list(c: str) -> Column:
    """Cells that ``read_list`` leaves NULL though the source's parser might read a list in them."""
    return F.coalesce(_may_open(c, "[") & ~F.col(_name(c)).isin(EMPTY_LIST_TOKENS) & read_list(c).isNull(), F.lit(False))


def unread_dict(c: str, read: Column | None = None) -> Column:
    """Cells that ``read_dict`` (or ``read``, another reading of them) leaves NULL though there might be a dict in them."""
    read = read_dict(c) if read is None else read
    return F.coalesce(_may_open(c, "{") & ~F.col(_name(c)).isin(EMPTY_DICT_TOKENS) & read.isNull(), F.lit(False))


def _not_plain(c: str, bracket: str, pattern: str, empty: Sequence[str]) -> Column:
    """The cells of a literal that are not of the plain shape, for Python; NULL for all others."""
    cell = F.col(_name(c))
    return F.when(_may_open(c, bracket) & ~cell.rlike(pattern) & ~cell.isin(list(empty)), cell)


def parse_list(c: str) -> Column:
    """``read_list`` for every list literal: what it leaves unread is read by Python."""
    return F.coalesce(read_list(c), _literal_list(_not_plain(c, "[", LIST_FAST_PATTERN, EMPTY_LIST_TOKENS)))


def parse_dict(c: str) -> Column:
    """``read_dict`` for every dict literal: what it leaves unread is read by Python."""
    return F.coalesce(read_dict(c), _literal_dict(_not_plain(c, "{", DICT_FAST_PATTERN, EMPTY_DICT_TOKENS)))


def decode_skill_map(c: Column | str) -> Column:
    """JSON text of a skill dict -> map<string, array<string>>.

    Decoding the values as raw text first keeps a category whose value is not a list
    (its skills become NULL) instead of losing the whole cell.
    """
    raw_map = F.from_json(_c(c), T.MapType(T.StringType(), T.StringType()))
    return F.transform_values(raw_map, lambda _k, v: F.from_json(v, STRING_LIST))


def normalize_list(df: DataFrame, name: str) -> Column:
    """Array column -> itself; JSON text column -> decoded array (bad text -> NULL)."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.ArrayType):
        return F.col(name).cast(STRING_LIST)
    # Inside brackets, text after the value makes the whole malformed or a second item.
    one = F.from_json(F.concat(F.lit("["), F.col(name).cast("string"), F.lit("]")), T.ArrayType(STRING_LIST))
    return F.when(F.size(one) == 1, F.get(one, F.lit(0)))


def encode_json(c: Column | str) -> Column:
    """Map -> JSON text with its keys in order, so that equal maps have equal text; NULL stays NULL."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(_c(c)))))


def canonical_json(c: Column | str) -> Column:
    """JSON text -> the one text of its value: keys in order, numbers in shortest form (1.0 as 1), no spaces.

    Text that is not JSON gives NULL, as does one with a repeated key (unless the session sets
    ``spark.sql.variant.allowDuplicateKeys``, which keeps the last).
    """
    return F.to_json(F.try_parse_json(_c(c)))


@F.pandas_udf(T.StringType())
def _literal_json(cells: pd.Series) -> pd.Series:
    out = []
    for v in cells:
        parsed = None if v is None else _literal(v)
        out.append(_canonical(parsed) if isinstance(parsed, dict) else None)
    return pd.Series(out, dtype=object)


def _canonical(x) -> str:
    """JSON text of a literal dict: any value kept (tuples and sets as lists, numbers that JSON has not and other things as text)."""
    import json
    import math

    def plain(v):
        if isinstance(v, dict):
            return {k if isinstance(k, str) else json.dumps(k, default=str): plain(e) for k, e in v.items()}
        if isinstance(v, (list, tuple)):
            return [plain(e) for e in v]
        if isinstance(v, (set, frozenset)):
            return sorted((plain(e) for e in v), key=str)
        return str(v) if isinstance(v, float) and not math.isfinite(v) else v
    text = json.dumps(plain(x), sort_keys=True, ensure_ascii=False, separators=(",", ":"), default=str)
    return text.encode("utf-8", "replace").decode()


def read_json(c: str) -> Column:
    """Python dict literal -> canonical JSON text; every value keeps its type, a repeated key its last one.

    Empty rules as in ``read_dict``; what is no dict literal gives NULL.
    """
    cell = _name(c)
    plain = f"{cell} RLIKE {_text(DICT_FAST_PATTERN)}"
    text = f"""CASE WHEN {cell} IS NULL OR {_any_of(cell, EMPTY_DICT_TOKENS)} THEN NULL WHEN {plain} THEN {_plain_json(cell)}
        WHEN startswith({_opened(cell)}, '{{') THEN {_let('cell', _opened(cell), _json('cell', _DICT_KINDS, True))} END"""
    # The JSON reader refuses repeated keys; only such cells are read again.
    return F.coalesce(canonical_json(F.expr(text)), F.when(F.expr(plain), encode_json(read_dict(c))))


def dict_json(c: str) -> Column:
    """``read_json`` for every dict literal: what it leaves unread is read by Python."""
    return F.coalesce(read_json(c), canonical_json(_literal_json(_not_plain(c, "{", DICT_FAST_PATTERN, EMPTY_DICT_TOKENS))))


def mend_cells(df: DataFrame, lists: dict[str, str], dicts: dict[str, str]) -> DataFrame:
    """Parsed columns with the cells mended that only Python's own parser reads.

    ``lists`` and ``dicts`` map a parsed column (of ``read_list`` / ``read_json``) to a text column
    that holds the raw cell where it is unread and NULL elsewhere; the text columns go. Only
    rows with such a cell pass through Python; without any, nothing is added to the plan.
    """
    sources = [*lists.values(), *dicts.values()]
    unread = F.lit(False)
    for c in sources:
        unread = unread | F.col(c).isNotNull()
    if not df.where(unread).limit(1).count():
        return df.drop(*sources)
    mended = df.where(unread).withColumns(
        {c: F.coalesce(c, _literal_list(raw)) for c, raw in lists.items()}
        | {c: F.coalesce(c, canonical_json(_literal_json(raw))) for c, raw in dicts.items()})
    return df.where(~unread).unionByName(mended).drop(*sources)


def tri_state_bool(c: Column | str) -> Column:
    """'true' / 'false' in any case -> boolean; everything else (``1``, ``' true'``) -> NULL."""
    low = F.lower(_c(c).cast("string"))
    return F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False)).otherwise(
        F.lit(None).cast("boolean"))


def to_timestamp(c: Column | str, fmt: str | Sequence[str] | None = None) -> Column:
    """Text -> timestamp without zone; unparseable -> NULL.

    Without a format any ISO-8601 date or date-time form is accepted per cell; several
    formats are tried in turn.
    """
    c = _c(c)
    if fmt is None:
        return c.try_cast(T.TimestampNTZType())
    tried = [F.try_to_timestamp(c.cast("string"), F.lit(f)).cast(T.TimestampNTZType())
             for f in ([fmt] if isinstance(fmt, str) else fmt)]
    return F.coalesce(*tried)


# How the parts of a date and of a time of day are written. Digits stand for the
# shape of a cell: "0" for one or two, "0000" for four of them, "a" for a word.
_DATE_SHAPES = {"0000-0-0": "yyyy-M-d", "0000/0/0": "yyyy/M/d", "0000.0.0": "yyyy.M.d", "0 a 0000": "d MMM yyyy",
                "0-a-0000": "d-MMM-yyyy", "a 0, 0000": "MMM d, yyyy", "a 0 0000": "MMM d yyyy"}
_EITHER_SHAPES = {"0/0/0000": ("M/d/yyyy", "d/M/yyyy"), "0-0-0000": ("M-d-yyyy", "d-M-yyyy"), "0.0.0000": ("M.d.yyyy", "d.M.yyyy")}
_TIME_SHAPES = {"": "", " 0:0": " H:m", " 0:0:0": " H:m:s", "T0:0:0": "'T'H:m:s", "T0:0": "'T'H:m", " 0:0 a": " h:m a", " 0:0:0 a": " h:m:s a"}


def infer_format(df: DataFrame, column: str) -> str | None:
    """The one format in which a text column writes its dates, or None where no known format fits any cell.

    One pass: cells are counted by shape (digits and words replaced), so what leaves a task is a
    row per shape, with the largest first and second number of a date such as 3/4/2024. The
    shape of most cells wins. Where day and month could be either, cells that can be read in one
    way only decide by their number; without any, or with as many on either side, the month comes first.
    """
    text = F.col(_name(column))
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        text, "[A-Za-z]+\\.?", "a"), "[0-9]{4}", "Y"), "[0-9]{1,2}", "0"), "Y", "0000")
    shape = F.regexp_replace(shape, "^(0000[-/.]0[-/.]0|0[-/.]0[-/.]0000)a", "$1T")  # the T between date and time
    number = [F.regexp_extract(text, r"^([0-9]{1,2})[-/.]([0-9]{1,2})[-/.]", g).try_cast("int") for g in (1, 2)]
    known = {d + t: (f if isinstance(f, tuple) else (f, f), tf) for d, f in {**_DATE_SHAPES, **_EITHER_SHAPES}.items()
             for t, tf in _TIME_SHAPES.items()}
    votes = (df.where(F.col(_name(column)).isNotNull()).select(shape.alias("shape"), *(n.alias(f"n{i}") for i, n in enumerate(number)))
             .where(F.col("shape").isin(list(known)))
             .groupBy("shape").agg(F.count(F.lit(1)).alias("cells"), F.count_if((F.col("n0") > 12) & (F.col("n1") <= 12)).alias("days_first"),
                                   F.count_if((F.col("n1") > 12) & (F.col("n0") <= 12)).alias("months_first")).collect())
    if not votes:
        return None
    best = max(votes, key=lambda v: (v["cells"], v["shape"]))  # at most one row for each known shape
    (month_first, day_first), time = known[best["shape"]]
    # All shapes of one order of parts vote on it: with a time of day or without.
    date = next(d for d in {**_DATE_SHAPES, **_EITHER_SHAPES} if best["shape"] in {d + t for t in _TIME_SHAPES})
    alike = [v for v in votes if v["shape"] in {date + t for t in _TIME_SHAPES}]
    days, months = (sum(v[k] for v in alike) for k in ("days_first", "months_first"))
    return (day_first if days > months else month_first) + time


def to_decimal(c: Column | str, precision: int = 10, scale: int = 2) -> Column:
    """Number or numeric text -> decimal(p, s), rounding half away from zero; overflow -> NULL."""
    return _c(c).try_cast(T.DecimalType(precision, scale))


def null_tokens(df: DataFrame, cols: list[str], tokens: list[str]) -> DataFrame:
    """Turn each cell that equals one of ``tokens`` into NULL, in the given columns."""
    return df.withColumns({c: F.when(F.col(c).isin(tokens), F.lit(None).cast("string")).otherwise(F.col(c))
                           for c in cols})
