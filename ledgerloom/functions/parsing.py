"""Text to numbers, booleans and timestamps."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F, types as T

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Boolean texts, compared in lower case.
TRUE_TEXTS = ("true", "1")
FALSE_TEXTS = ("false", "0")

# Strftime directives and the Java pattern letters for them.
STRFTIME_TO_JAVA = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "M",
    "%d": "d",
    "%H": "H",
    "%I": "h",
    "%M": "m",
    "%S": "s",
    "%f": "SSSSSS",
    "%p": "a",
    "%b": "MMM",
    "%B": "MMMM",
    "%a": "EEE",
    "%A": "EEEE",
    "%j": "D",
    "%z": "xx",
    "%Z": "VV",
    "%%": "%",
}

# Dtype names of the declared schemas and their Spark types.
DTYPES = {
    "str": T.StringType(),
    "string": T.StringType(),
    "object": T.StringType(),
    "category": T.StringType(),
    "int": T.LongType(),
    "int64": T.LongType(),
    "int32": T.IntegerType(),
    "int16": T.ShortType(),
    "int8": T.ByteType(),
    "float": T.DoubleType(),
    "float64": T.DoubleType(),
    "float32": T.FloatType(),
    "bool": T.BooleanType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "datetime": T.TimestampType(),
    "datetime64[ns]": T.TimestampType(),
    "datetime64": T.TimestampType(),
    "timestamp": T.TimestampType(),
}


def spark_type(dtype) -> T.DataType:
    """The Spark type for a dtype name, a Python type, a DDL name or a Spark type."""
    if isinstance(dtype, T.DataType):
        return dtype
    name = dtype.__name__ if isinstance(dtype, type) else str(dtype)
    known = DTYPES.get(name.lower())
    return known if known is not None else T.DataType.fromDDL(name)


def java_pattern(strftime_format: str) -> str:
    """Translate a strftime format into a Spark datetime pattern.

    Numbers may lack their leading zero, except where one directive follows
    another without a separator and only fixed widths tell them apart.
    """
    parts = re.findall(r"%.|[^%]+|%$", strftime_format)
    unknown = [p for p in parts if p.startswith("%") and p not in STRFTIME_TO_JAVA]
    if unknown:
        raise ValueError(f"unsupported datetime directive {unknown[0]!r}")

    def is_field(i: int) -> bool:
        return 0 <= i < len(parts) and parts[i].startswith("%") and parts[i] != "%%"

    out = []
    for i, part in enumerate(parts):
        if is_field(i):
            letters = STRFTIME_TO_JAVA[part]
            if letters in ("M", "d", "H", "h", "m", "s") and (is_field(i - 1) or is_field(i + 1)):
                letters *= 2
            out.append(letters)
        else:
            literal = part.replace("%%", "%").replace("'", "''")
            out.append(f"'{literal}'" if any(ch.isalpha() or ch == "'" for ch in literal) else literal)
    return "".join(out)


def null_if_nan(c: Column, data_type: T.DataType | None = None) -> Column:
    """NaN means missing, as NULL does. Other types pass through unchanged."""
    if data_type is not None and not isinstance(data_type, (T.DoubleType, T.FloatType)):
        return c
    return F.when(~F.isnan(c), c)


# Plain decimal numbers, first those too short to overflow a double.
SHORT_NUMBER = r"^\s*[+-]?((\d{1,200}(\.\d*)?|\.\d{1,200})([eE][+-]?\d{1,2})?|(?i:inf|infinity))\s*$"
ANY_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(c: Column) -> Column:
    """Text to double; a text that is no plain decimal number, or too large, becomes null.

    The patterns keep out the suffixes and hexadecimal forms a cast to double
    would take (``12d``, ``0x1p3``).
    """
    value = c.try_cast("double")
    return F.when(c.rlike(SHORT_NUMBER), value).when(
        c.rlike(ANY_NUMBER) & (F.abs(value) < float("inf")), value
    )


def to_boolean(c: Column) -> Column:
    """``true/false/1/0`` in any case, blanks around them ignored; anything else is null."""
    text = F.lower(F.btrim(c, F.lit(WHITESPACE)))
    return F.when(text.isin(*TRUE_TEXTS), True).when(text.isin(*FALSE_TEXTS), False)


def to_timestamp(c: Column, datetime_format: str | list[str] | None = None) -> Column:
    """Text to timestamp; null where it does not parse.

    ``datetime_format`` is one strftime pattern or several to try in turn.
    Without it the text must start with an ISO date: a bare time of day would
    otherwise take today's date and differ from run to run.
    """
    if datetime_format is None:
        text = F.btrim(c, F.lit(WHITESPACE))
        dated = (F.substring(text, 5, 1) == "-") | (
            (F.length(text) == 4) & (F.translate(text, "0123456789", "") == "")
        )
        return F.when(dated, text.try_cast("timestamp"))
    patterns = [datetime_format] if isinstance(datetime_format, str) else datetime_format
    parsed = [by_pattern(c, p) for p in patterns]
    return parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)


# English weekday names; Spark reads none of them, so they are looked for beforehand.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
# Stands for a weekday in a text and in its pattern.
WEEKDAY_MARK = "\u2020"


# English month names, as Spark reads them.
MONTHS = (
    *("January", "February", "March", "April", "May", "June", "July"),
    *("August", "September", "October", "November", "December"),
)
# What a directive's text is bound to look like where it parses. More may match, nothing less.
PLAUSIBLE = {
    **dict.fromkeys(("%Y", "%y", "%H", "%I", "%M", "%S"), r"[+-]?\d+"),
    "%m": r"\+?0*(?:1[0-2]|[1-9])",
    "%d": r"\+?0*(?:[12]\d|3[01]|[1-9])",
    "%b": f"(?:{'|'.join(month[:3] for month in MONTHS)})",
    "%B": f"(?:{'|'.join(MONTHS)})",
    "%f": r"\d*",
    "%p": ".+",
    "%z": ".+",
}


def plausible(c: Column, strftime_format: str) -> Column | None:
    """A test that every text which parses passes; None where a directive has no such test.

    A text that does not parse costs an exception, some ten times what this test does.
    """
    parts = re.findall(r"%.|[^%]+", strftime_format)
    if not all(p in PLAUSIBLE if p.startswith("%") else p.isprintable() and not set(p) & set("[]{}#'") for p in parts):
        return None
    flags = "(?isu)" if re.search("[A-Za-z]", re.sub("%[YymdHMSf]", "", strftime_format)) else ""
    return c.rlike(flags + "\\A" + "".join(PLAUSIBLE.get(p) or re.escape(p) for p in parts) + "\\z")


def by_pattern(c: Column, strftime_format: str, tested: bool = True) -> Column:
    """Text to timestamp by one strftime pattern; null where it does not parse.

    Two-digit years from 69 on are those of the 1900s, weekday names must be
    there but need not fit the date, and an offset may be ``+0100``, ``+01:00``
    or ``Z``, as in Python. With ``tested`` only plausible texts are parsed; it
    makes no difference to the result, and saves nothing where all texts parse.
    """
    if tested and (test := plausible(c, strftime_format)) is not None:
        return F.when(test, by_pattern(c, strftime_format, False))
    directives = re.findall(r"%.", strftime_format)
    pattern = strftime_format
    for directive, names in (("%A", WEEKDAYS), ("%a", [day[:3] for day in WEEKDAYS])):
        if directive in directives:
            word = rf"(?i)(?<![a-z])({'|'.join(names)})(?![a-z])"
            c = F.regexp_replace(c, word, WEEKDAY_MARK)
            pattern = re.sub(r"%(.)", lambda m, d=directive: WEEKDAY_MARK if m[0] == d else m[0], pattern)
    java = java_pattern(pattern)
    forms = [java]
    if "%z" in directives:
        forms = [java.replace("xx", "XX"), java.replace("xx", "XXX")]
    parsed = [F.try_to_timestamp(c, F.lit(form)) for form in forms]
    out = parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)
    if "%y" in directives:
        out = F.when(F.year(out) >= 2069, out - F.make_ym_interval(F.lit(100))).otherwise(out)
    return out


# The patterns a column of dates is tried with when none is declared. Month-first stands before day-first.
CANDIDATE_DATES = (
    *("%Y-%m-%d", "%Y/%m/%d", "%m/%d/%Y", "%d/%m/%Y", "%m-%d-%Y", "%d-%m-%Y", "%d.%m.%Y", "%Y%m%d"),
    *("%d %b %Y", "%d %B %Y", "%b %d, %Y", "%B %d, %Y", "%d-%b-%Y", "%m/%d/%y", "%d/%m/%y", "%d.%m.%y"),
)
CANDIDATE_TIMES = ("", " %H:%M:%S", " %H:%M", "T%H:%M:%S", " %I:%M:%S %p", " %I:%M %p", "T%H:%M:%S.%f", " %H:%M:%S.%f", "T%H:%M:%S%z")
CANDIDATES = tuple(date + time for time in CANDIDATE_TIMES for date in CANDIDATE_DATES)


def raise_where_lost(parsed: Column, source: Column, what: str) -> Column:
    """Fail the job at the first value that was present and did not convert."""
    return F.when(
        parsed.isNull() & source.isNotNull(),
        F.raise_error(F.concat(F.lit(f"cannot convert to {what}: "), source.cast("string"))),
    ).otherwise(parsed)


def combine_timestamp(
    date: Column, time: Column | None = None, datetime_format: str | None = None
) -> Column:
    """Timestamp from date and time texts joined by one space, or from the date alone."""
    text = date if time is None else F.concat(date, F.lit(" "), time)
    return to_timestamp(text, datetime_format)


def to_text(c: Column, source: T.DataType) -> Column:
    """Text of any value, with numbers and booleans spelled as Python spells them."""
    if isinstance(source, T.BooleanType):
        return F.initcap(c.cast("string"))
    if isinstance(source, (T.DoubleType, T.FloatType)):
        return _number_text(null_if_nan(c))
    return c.cast("string")


def _number_text(c: Column) -> Column:
    """Spark turns to exponents at ten million and a thousandth, Python much later."""
    text, size = c.cast("string"), F.abs(c)
    # Seventeen digits and these exponents fit the decimal, so nothing is rounded.
    plain = F.rtrim(text.try_cast("decimal(38,20)").cast("string"), F.lit("0"))
    plain = F.when(F.endswith(plain, F.lit(".")), F.concat(plain, F.lit("0"))).otherwise(plain)
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    power = F.substring_index(text, "E", -1).try_cast("int")
    sign = F.when(power < 0, "e-").otherwise("e+")
    exponent = F.concat(mantissa, sign, F.lpad(F.abs(power).cast("string"), 2, "0"))
    exponent = F.when(F.abs(power) > 99, F.concat(mantissa, sign, F.abs(power).cast("string"))).otherwise(exponent)
    infinite = F.when(c > 0, "inf").otherwise("-inf")
    return (
        F.when(~F.contains(text, F.lit("E")) & ~F.contains(text, F.lit("y")), text)
        .when(size == float("inf"), infinite)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(exponent)
    )


def convert(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """Convert one column to ``target``; values that do not fit become null."""
    if source == target:
        return c
    missing_aware = null_if_nan(c, source)
    is_text = isinstance(source, (T.StringType, T.VarcharType, T.CharType))
    if isinstance(target, T.BooleanType):
        if is_text:
            return to_boolean(c)
        return missing_aware.try_cast(target)
    if is_text and isinstance(target, (T.TimestampType, T.TimestampNTZType)):
        parsed = to_timestamp(c)
        return parsed if isinstance(target, T.TimestampType) else parsed.cast(target)
    if is_text and isinstance(target, T.DateType):
        return to_timestamp(c).cast("date")
    if is_text and isinstance(target, (T.DoubleType, T.FloatType)):
        return to_number(c).cast(target)
    if is_text and isinstance(target, T.IntegralType):
        text = F.btrim(c, F.lit(WHITESPACE))
        return F.when(F.translate(text, "0123456789+-", "") == "", text.try_cast(target))
    if isinstance(target, T.StringType):
        return to_text(c, source)
    if isinstance(source, T.IntegralType) and isinstance(target, T.TimestampType):
        # Whole numbers count nanoseconds since 1970.
        return F.timestamp_micros(F.call_function("div", c, F.lit(1000)))
    return missing_aware.try_cast(target)
