"""String functions of the exports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unquote_entities(text: Column) -> Column:
    """`&quot;` back to quotes."""
    return F.replace(text, F.lit("&quot;"), F.lit('"'))


def string_literal(text: Column, tag: Column | None = None) -> Column:
    """Turtle literal, with a language tag if given; backslash, quote, newline, return and tab are escaped."""
    for raw, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    quoted = F.concat(F.lit('"'), text, F.lit('"'))
    return quoted if tag is None else F.concat(quoted, F.lit("@"), tag)


def float_text(number: Column) -> Column:
    """A number as a float prints with 12 significant digits; text that is a whole number stays as it is."""
    x = number.try_cast("double")
    text = F.format_string("%.12g", x)
    text = F.regexp_replace(text, r"(\.[0-9]*?)0+(e|$)", "$1$2")
    text = F.regexp_replace(text, r"\.(e|$)", "$1")
    text = F.when(text.rlike("[.e]"), text).otherwise(F.concat(text, F.lit(".0")))
    return F.when(number.rlike(r"^[+-]?\d+$"), number).when(x == 0, "0.0").when(x.isNotNull(), text)


def typed_literal(text: Column, kind: str) -> Column:
    return F.concat(F.lit('"'), text, F.lit(f'"^^x:{kind}'))


def float_literal(number: Column) -> Column:
    return typed_literal(float_text(number), "float")


def decimal_literal(number: Column) -> Column:
    """The number as written."""
    return typed_literal(number, "decimal")


def integer_literal(number: Column) -> Column:
    """A whole number; +42 stands for text that is none."""
    whole = F.regexp_extract(F.trim(number), r"^([+-]?\d+)$", 1).try_cast("bigint").cast("string")
    return typed_literal(F.coalesce(whole, F.lit("+42")), "int")


def quote_path(text: Column) -> Column:
    """Percent-encoding that leaves letters, digits, `_`, `.`, `-` and `/`."""
    for encoded, plain in (("+", "%20"), ("%2F", "/"), ("*", "%2A")):
        text = F.replace(F.url_encode(text) if encoded == "+" else text, F.lit(encoded), F.lit(plain))
    return text


def quote_url(text: Column) -> Column:
    """Percent-encoding of a whole address: its reserved characters stay."""
    text = quote_path(text)
    for c in ":?#[]@!$&'()*+,;=%":
        text = F.replace(text, F.lit(f"%{ord(c):02X}"), F.lit(c))
    return text


def page_name(title: Column) -> Column:
    return F.replace(title, F.lit(" "), F.lit("_"))


def guid_suffix(guid: Column) -> Column:
    """What follows the first `$`; NULL without one."""
    found = F.regexp_extract(guid, r"^[^$]*\$(.*)$", 1)
    return F.when(guid.contains("$"), found)


def local_hash(*parts: Column) -> Column:
    """Hexadecimal name part made of a value."""
    return F.lower(F.hex(F.xxhash64(*parts)))


def csv_name(name: Column) -> Column:
    return F.replace(name, F.lit(","), F.lit("<comma>"))


def yes_no(flag: Column) -> Column:
    return F.when(flag, "yes").otherwise("no")


def globe_id(globe: Column) -> Column:
    """Number of the item a globe or calendar address ends in; NULL if it does not."""
    return F.regexp_extract(globe, r"/Q(\d+)$", 1).try_cast("bigint")
