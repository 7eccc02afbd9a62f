"""Personal data under pseudonyms of the same format.

Numbers and dates that pass their checks (Luhn digit, octets, calendar, ranges) are
permuted inside their own domain by a keyed Feistel network: a number of two parts, each
round adding a keyed function of one part to the other modulo its size. So equal
values stay equal in all documents, different ones stay different, the result passes the
same check, and whoever has the key can go back. Addresses and quoted secrets are no
numbers; they get a keyed digest. All of it is Spark expressions. README lists the forms
that are known and those that are not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmix.functions.frames import compute_once
from corpusmix.functions.text import quoted
from corpusmix.llm.common import fresh

ROUNDS = 10

# Each alternative starts with a cheap test, as it is tried at every character of a text.
# Country codes of two and of three digits, the latter by their zones; those of one are 1 and 7. No code begins another.
_TWO = "2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
_THREE = "(?:2[1-689]|3[578]|42|5[09]|6[789]|8[0578]|9[679])[0-9]"
# A further digit of a number with a country code; brackets hold two digits or more, or a zero not dialled.
_NEXT = r"(?:[ .-]?\((?=0\)|\d\d)|\)[ .-]?|[ .-])?\d"
_BRACKETED = r"(?:\+\d{1,3}[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
_ABROAD = (
    r"\+(?:1[ .-]?[2-9]\d{2}[ .-]?\d{3}[ .-]?\d{4}"
    f"|7(?:{_NEXT}){{10}}|(?:{_TWO})(?:{_NEXT}){{7,13}}|{_THREE}(?:{_NEXT}){{6,12}})(?!\\d)"
)
_NATIONAL = r"(?<!\d[.-])(?:1[ .-])?[2-9]\d{2}[ .-]\d{3}[ .-]\d{4}(?![.-]?\d)"
_PHONE = rf"(?<![\d+])(?:{_BRACKETED}|{_ABROAD}|{_NATIONAL})"
_IP = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d)"
_DATE = r"(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])|(?<![\d/])\d{2}/\d{2}/\d{4}(?![\d/])"
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
_CARD = r"(?<![\d-])\d{13,19}(?![\d-])|(?<![\d-])(?<!\d )\d{4}([ -])(?:\d{4}\1\d{4}\1\d{4}(?:\1\d{3})?|\d{6}\1\d{4,5})(?![ -]?\d)"
_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]*[A-Za-z0-9]"
# A key in either case, perhaps quoted itself, then = or : and a quote, with up to eight blanks between them.
_SECRET = (
    r"(?=[0-9A-Fa-f]{32})(?<=[\"'\s])"
    r"(?<=(?i:token|secret|api[_-]?key|password)[\"']?\s{0,8}[=:]\s{0,8}[\"']\s{0,8})[0-9A-Fa-f]{32,}+(?=\s*[\"'])"
)
KINDS = ("email", "secret", "phone", "ip", "date", "ssn", "card")
# The back reference counts groups in the whole pattern, of which this is the only one.
PATTERN = f"(?=[0-9+(])(?:{'|'.join((_PHONE, _IP, _DATE, _SSN, _CARD))})|{_SECRET}|{_EMAIL}"
# What every match has, so most texts are done with after one look for a single character.
ANY = "[0-9@]|[A-Fa-f]{32}"

# A cycle of the calendar has 146,097 days, which are 189 times 773.
FIRST_DAY, LAST_DAY = "1700-01-01", "2099-12-31"
_DAYS = (189, 773)
# Without the first twelve days of each of its 4,800 months it has 88,497, which are 9 times 9,833.
_LATE_DAYS = (9, 9_833)
_MONTHS = 4_800


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``value`` computed once under ``name``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def feistel(value: str, left: str | int, right: str | int, key: str, tweak: str, invert: bool = False) -> str:
    """SQL for a keyed permutation of the whole numbers below ``left * right``, or its inverse.

    ``value``, ``left`` and ``right`` are SQL; give names or constants, as they come more than once.
    """

    def keyed(part: str) -> str:
        text = f"concat({quoted(f'{key}/{tweak}/')}, i, '/', {part})"
        return f"cast(conv(substring(sha2({text}, 256), 1, 12), 16, 10) AS bigint)"

    sign, order = ("-", f"sequence({ROUNDS - 1}, 0)") if invert else ("+", f"sequence(0, {ROUNDS - 1})")
    start = f"named_struct('a', {value} div {right}, 'b', {value} % {right})"
    even = f"named_struct('a', pmod(s.a {sign} {keyed('s.b')}, {left}), 'b', s.b)"
    odd = f"named_struct('a', s.a, 'b', pmod(s.b {sign} {keyed('s.a')}, {right}))"
    return f"aggregate({order}, {start}, (s, i) -> if(i % 2 = 0, {even}, {odd}), s -> s.a * {right} + s.b)"


def permute_digits(digits: str, key: str, tweak: str, invert: bool = False) -> str:
    """SQL for a permutation of strings of one length (2 to 18 decimal digits)."""
    body = feistel("d", "l", "r", key, tweak, invert)
    body = _let("r", "cast(concat('1', repeat('0', n div 2)) AS bigint)", f"lpad(cast({body} AS string), n, '0')")
    body = _let("l", "cast(concat('1', repeat('0', n - n div 2)) AS bigint)", body)
    body = _let("n", "length(t)", _let("d", "cast(t AS bigint)", body))
    return _let("t", digits, body)


def luhn_sum(digits: str) -> str:
    """SQL for the Luhn sum of a string of digits; ``digits`` is a name."""
    digit = f"cast(substring({digits}, -k, 1) AS int)"
    twice = f"2 * {digit} - if({digit} > 4, 9, 0)"
    return f"aggregate(sequence(1, length({digits})), 0, (sum, k) -> sum + if(k % 2 = 0, {twice}, {digit}))"


def _with_digits(shape: str, digits: str) -> str:
    """SQL for ``shape`` with its digits replaced by ``digits`` one after another; both are names."""
    char = f"substring({shape}, k, 1)"
    step = (
        f"if({char} BETWEEN '0' AND '9', "
        f"named_struct('out', concat(p.out, substring({digits}, p.used + 1, 1)), 'used', p.used + 1), "
        f"named_struct('out', concat(p.out, {char}), 'used', p.used))"
    )
    return f"aggregate(sequence(1, length({shape})), named_struct('out', '', 'used', 0), (p, k) -> {step}, p -> p.out)"


_DIGITS = "regexp_replace(v, '[^0-9]', '')"


def _day(year_first: str) -> str:
    """SQL for the day of a date, or null if there is none such or it lies outside the cycle."""
    day = f"cast(try_to_timestamp({year_first}, 'yyyy-MM-dd') AS date)"
    return _let("day", day, f"if(day BETWEEN date'{FIRST_DAY}' AND date'{LAST_DAY}', day, null)")


_DAY_FIRST = "concat_ws('-', substring(v, 7, 4), substring(v, 4, 2), substring(v, 1, 2))"
_MONTH_FIRST = "concat_ws('-', substring(v, 7, 4), substring(v, 1, 2), substring(v, 4, 2))"
_AS_DATE = _day(f"if(substring(v, 5, 1) = '-', v, {_DAY_FIRST})")
# Month/day is only read where day/month is no date, so it always has a day above 12.
_AS_LATE_DATE = f"if(substring(v, 5, 1) = '-', null, {_day(_MONTH_FIRST)})"
_PARTS = "transform(split(v, '[.-]'), x -> cast(x AS bigint))"


def _card(key: str, invert: bool) -> str:
    """First digit kept; the last one is the Luhn digit of the new number."""
    body = permute_digits("substring(g, 2, length(g) - 2)", key, "card", invert)
    check = _let("z", "concat(m, '0')", f"pmod(10 - {luhn_sum('z')}, 10)")
    whole = _let("m", f"concat(substring(g, 1, 1), {body})", _let("w", f"concat(m, {check})", _with_digits("v", "w")))
    return _let("g", _DIGITS, whole)


def _ten_digits(digits: str, key: str, invert: bool) -> str:
    """Area codes from 200 on stay such; the others are only written in brackets or abroad."""
    made = _let("z", "y - low", f"lpad(cast(low + {feistel('z', 'l', 100_000, key, 'phone', invert)} AS string), 10, '0')")
    made = _let("low", "if(y < 2000000000, 0L, 2000000000L)", _let("l", "if(low = 0, 20000L, 80000L)", made))
    return _let("y", f"cast({digits} AS bigint)", made)


def _phone(key: str, invert: bool) -> str:
    """The country code and a zero in brackets stay; the digits after the code are permuted."""
    code = f"""CASE
      WHEN NOT startswith(v, '+') OR v RLIKE '^[+][0-9]{{1,3}}[ .-]?[(][0-9]{{3}}[)][ .-]?[0-9]{{3}}[ .-]?[0-9]{{4}}$'
        THEN length(g) - 10
      WHEN g RLIKE '^[17]' THEN 1
      WHEN g RLIKE '^({_TWO})' THEN 2
      ELSE 3
    END"""
    number = f"if(length(x) = 10, {_ten_digits('x', key, invert)}, {permute_digits('x', key, 'phone', invert)})"
    whole = _let("w", f"concat(left(g, c), {number})", _with_digits("b", "w"))
    whole = _let("c", code, _let("x", "substring(g, c + 1)", whole))
    body = _let("b", "replace(v, '(0)', '(o)')", _let("g", "regexp_replace(b, '[^0-9]', '')", whole))
    return f"replace({body}, '(o)', '(0)')"


def _ip(key: str, invert: bool) -> str:
    dotted = "concat_ws('.', q div 16777216, q div 65536 % 256, q div 256 % 256, q % 256)"
    number = "aggregate(o, 0L, (sum, x) -> sum * 256 + x)"
    made = _let("y", number, _let("q", feistel("y", 65_536, 65_536, key, "ip", invert), dotted))
    return _let("o", _PARTS, made)


def _date(key: str, invert: bool) -> str:
    number = f"cast(datediff({_AS_DATE}, date'{FIRST_DAY}') AS bigint)"
    made = f"date_add(date'{FIRST_DAY}', cast({feistel('y', *_DAYS, key, 'date', invert)} AS int))"
    shape = "date_format(made, if(substring(v, 5, 1) = '-', 'yyyy-MM-dd', 'dd/MM/yyyy'))"
    usual = _let("y", number, _let("made", made, shape))
    return f"if({_AS_DATE} IS NOT NULL, {usual}, {_late_date(key, invert)})"


def _late_date(key: str, invert: bool) -> str:
    """Dates with the month first and a day above 12, by their number among such days of the cycle."""

    def month(m: str) -> str:
        return f"add_months(date'{FIRST_DAY}', {m})"

    def before(m: str) -> str:
        return f"datediff({month(m)}, date'{FIRST_DAY}') - 12 * {m}"

    months = f"cast(months_between(trunc(late, 'MM'), date'{FIRST_DAY}') AS int)"
    number = _let("m", months, f"cast({before('m')} + day(late) - 13 AS bigint)")
    # Months have 16 to 19 such days, so the month is next to where equal ones would put it.
    guess = f"cast(q * {_MONTHS} div {_LATE_DAYS[0] * _LATE_DAYS[1]} AS int)"
    found = f"element_at(filter(sequence(greatest(e - 2, 0), e + 2), m -> {before('m')} <= q), -1)"
    day = _let("m", found, f"date_add({month('m')}, cast(12 + q - ({before('m')}) AS int))")
    written = f"date_format({_let('e', guess, day)}, 'MM/dd/yyyy')"
    made = _let("y", number, _let("q", feistel("y", *_LATE_DAYS, key, "late date", invert), written))
    return _let("late", _AS_LATE_DATE, made)


def _ssn(key: str, invert: bool) -> str:
    """Areas 1 to 899 without 666, groups 1 to 99, serials 1 to 9999: no other is given out."""
    place = "(o[0] - 1 - if(o[0] > 666, 1, 0))"
    number = f"({place} * 99 + o[1] - 1) * 9999 + o[2] - 1"
    area = "q div 989901 + 1 + if(q div 989901 >= 665, 1, 0)"
    written = (
        f"concat_ws('-', lpad(cast({area} AS string), 3, '0'), "
        "lpad(cast(q div 9999 % 99 + 1 AS string), 2, '0'), lpad(cast(q % 9999 + 1 AS string), 4, '0'))"
    )
    made = _let("y", number, _let("q", feistel("y", 898 * 99, 9_999, key, "ssn", invert), written))
    return _let("o", _PARTS, made)


# The kind of a match ``v`` that passes its check, else null.
KIND = f"""CASE
  WHEN contains(v, '@') THEN 'email'
  WHEN v RLIKE '^[0-9A-Fa-f]{{32,}}$' THEN 'secret'
  WHEN v RLIKE '^([+(]|(1[ .-])?[0-9]{{3}}[ .-][0-9]{{3}}[ .-][0-9]{{4}}$)' THEN 'phone'
  WHEN contains(v, '.') THEN if(forall({_PARTS}, x -> x < 256), 'ip', null)
  WHEN v RLIKE '^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}})$'
    THEN if(coalesce({_AS_DATE}, {_AS_LATE_DATE}) IS NOT NULL, 'date', null)
  WHEN v RLIKE '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' THEN {_let(
      'o', _PARTS, "if(o[0] > 0 AND o[0] <> 666 AND o[0] < 900 AND o[1] > 0 AND o[2] > 0, 'ssn', null)")}
  ELSE {_let('g', _DIGITS, f"if(length(g) BETWEEN 13 AND 19 AND {luhn_sum('g')} % 10 = 0, 'card', null)")}
END"""


def pseudonym(key: str, invert: bool = False) -> str:
    """SQL for the pseudonym of ``v``, of kind ``kind``; with ``invert`` the value of a pseudonym."""
    digest = f"sha2(concat({quoted(f'{key}/text/')}, lower(v)), 256)"
    mail = _let("h", digest, "concat('u', substring(h, 1, 12), '@m', substring(h, 13, 6), '.example')")
    secret = _let("h", digest, "substring(repeat(h, 1 + length(v) div 64), 1, length(v))")
    secret = f"if(v <> lower(v) AND v = upper(v), upper({secret}), {secret})"
    return f"""CASE kind
      WHEN 'card' THEN {_card(key, invert)}
      WHEN 'phone' THEN {_phone(key, invert)}
      WHEN 'ip' THEN {_ip(key, invert)}
      WHEN 'date' THEN {_date(key, invert)}
      WHEN 'ssn' THEN {_ssn(key, invert)}
      WHEN 'email' THEN {'v' if invert else mail}
      WHEN 'secret' THEN {'v' if invert else secret}
      ELSE v
    END"""


def pseudonymise(docs: DataFrame, key: str, text: str = "text", counts: str | None = None) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; all other columns and rows as they were.

    Whoever has ``key`` can turn numbers and dates back, so it has no default and belongs in no code.
    ``counts`` names a column to add, or to replace: how many values of each of :data:`KINDS` were replaced.
    Null text stays null, an empty text or table empty; repeated rows get equal results. The rows do not move. Numbers in an address lose zeros in front
    of an octet. Values that fail their check stay as they are.
    """
    matches = F.regexp_extract_all(F.col(text), F.lit(PATTERN), F.lit(0))
    seen, new = fresh(docs, "_found"), fresh(docs, "_made")
    found = compute_once(docs, **{seen: F.when(F.col(text).rlike(ANY), matches)})
    replaced = _let("kind", KIND, f"named_struct('kind', kind, 'value', {pseudonym(key)})")
    made = compute_once(found, **{new: F.expr(f"if(size({seen}) > 0, transform({seen}, v -> {replaced}), null)")})
    pieces = F.zip_with(
        F.split(F.col(text), PATTERN),
        F.expr(f"transform({new}, m -> m.value)"),
        lambda gap, value: F.concat(gap, F.coalesce(value, F.lit(""))),
    )
    # The pattern was found in the text, so gaps and values alternate and hold all of it.
    rewritten = F.when(F.col(new).isNull(), F.col(text)).otherwise(F.array_join(pieces, ""))
    columns = [rewritten.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns if c != counts]
    if counts:
        each = ", ".join(f"'{k}', size(filter(kinds, k -> k <=> '{k}')) + 0L" for k in KINDS)
        kinds = f"coalesce(transform({new}, m -> m.kind), cast(array() AS array<string>))"
        columns.append(F.expr(_let("kinds", kinds, f"named_struct({each})")).alias(counts))
    return made.select(*columns)
