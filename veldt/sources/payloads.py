"""Columns out of stored API responses and web pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the HTML entities decoded in page text, besides numeric ones; the ampersand comes last
ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&apos;": "'",
    "&nbsp;": " ",
    "&copy;": "\u00a9",
    "&reg;": "\u00ae",
    "&trade;": "\u2122",
    "&middot;": "\u00b7",
    "&bull;": "\u2022",
    "&hellip;": "\u2026",
    "&ndash;": "\u2013",
    "&mdash;": "\u2014",
    "&lsquo;": "\u2018",
    "&rsquo;": "\u2019",
    "&ldquo;": "\u201c",
    "&rdquo;": "\u201d",
    "&laquo;": "\u00ab",
    "&raquo;": "\u00bb",
    "&euro;": "\u20ac",
    "&pound;": "\u00a3",
    "&deg;": "\u00b0",
    "&times;": "\u00d7",
    "&amp;": "&",
}

TITLE = r"(?is)<title[^>]*>(.*?)</title>"
LINK = r"(?i)<a\s(?:[^>]*?\s)?href\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
NUMERIC = r"(?s)^(x[0-9a-fA-F]{1,6}|[0-9]{1,7});?(.*)$"
HIDDEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<head\b.*?</head>|<!--.*?-->"
TAG = r"(?s)<[^>]*>"


def parse_payload(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Add the fields of a JSON column; text that does not parse gives NULLs."""
    parsed = F.from_json(column, schema)
    return df.withColumn("__payload", parsed).select(*df.columns, "__payload.*")


def numeric_references(text: Column) -> Column:
    """``&#65;`` and ``&#x41;`` as characters; what is no character stays as it is."""

    def decoded(part: Column) -> Column:
        number, rest = F.regexp_extract(part, NUMERIC, 1), F.regexp_extract(part, NUMERIC, 2)
        code = F.when(number.startswith("x"), F.conv(F.substring(number, 2, 6), 16, 10)).otherwise(number).cast("bigint")
        real = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        letter = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when((number != "") & real, F.concat(letter, rest)).otherwise(F.concat(F.lit("&#"), part))

    parts = F.split(text, "&#")
    tail = F.transform(F.slice(parts, 2, F.size(parts)), decoded)
    whole = F.concat(F.get(parts, F.lit(0)), F.array_join(tail, ""))
    return F.when(F.contains(text, F.lit("&#")), whole).otherwise(text)


def unescape(text: Column) -> Column:
    text = numeric_references(text)
    return reduce(lambda c, e: F.replace(c, F.lit(e), F.lit(ENTITIES[e])), ENTITIES, text)


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[ \t\r\n]+", " "))


def extract_html(df: DataFrame, column: str) -> DataFrame:
    """Add ``title``, ``links`` (array, document order) and visible ``text`` of whole pages."""
    page = F.col(column)
    visible = F.regexp_replace(F.regexp_replace(page, HIDDEN, " "), TAG, " ")
    return df.withColumns(
        {
            "title": squeeze(unescape(F.regexp_extract(page, TITLE, 1))),
            "links": F.transform(
                F.regexp_extract_all(page, F.lit(LINK), 1), lambda x: unescape(F.regexp_replace(x, "^[\"']|[\"']$", ""))
            ),
            "text": squeeze(unescape(visible)),
        }
    )
