"""Column functions for identifiers, timestamps, titles, serialised parameters and markup."""

from __future__ import annotations

import re
import socket

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space that is trimmed, and evidence labels of invalidated accounts.
ASCII_SPACE = " \t\n\r\x0b\x0c"
INVALID_PREFIX, INVALID_SUFFIX = "invalidated_", "_account_id_timestamp_order"

ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$"


def valid_id(c: Column) -> Column:
    """A canonical positive decimal number, of any width."""
    return F.coalesce(c.rlike(r"\A[1-9][0-9]*\z"), F.lit(False))


def id_order(c: Column) -> list[Column]:
    """Sort keys that put canonical decimal numbers in numeric order."""
    return [F.length(c), c]


def numeric_text_order(c: Column) -> list[Column]:
    """Sort keys for any text: digits by value (leading zeros aside) first, then the rest by bytes."""
    digits = c.rlike(r"\A[0-9]+\z")
    bare = F.regexp_replace(c, "^0+(?=.)", "")
    return [F.when(digits, 0).otherwise(1), F.when(digits, F.length(bare)), F.when(digits, bare), c]


def valid_timestamp(c: Column, first_year: int = 2000, last_year: int = 2099) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ`` that names a real second of the given years."""
    year = F.substring(c, 1, 4).try_cast("int")
    real = F.try_to_timestamp(F.when(c.rlike(ISO), c), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")).isNotNull()
    return F.coalesce(c.rlike(ISO) & year.between(first_year, last_year) & real, F.lit(False))


def event_timestamp(c: Column) -> Column:
    return valid_timestamp(c, 2010)


def cutoff(date: Column) -> Column:
    """``YYYYMMDD`` as the first second of that day."""
    return F.concat_ws("-", F.substring(date, 1, 4), F.substring(date, 5, 2), F.concat(F.substring(date, 7, 2), F.lit("T00:00:00Z")))


def trim_ascii(c: Column) -> Column:
    return F.btrim(c, F.lit(ASCII_SPACE))


def none_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def title_namespace(c: Column) -> Column:
    """What stands before the first colon, if it has 1 to 60 characters."""
    found = F.substring_index(c, ":", 1)
    return F.when(c.contains(":") & F.length(found).between(1, 60), found)


def title_name(c: Column) -> Column:
    """What stands after the first colon; null if nothing does."""
    return none_if_empty(c.substr(F.instr(c, ":") + 1, F.length(c)))


def serialised_userid(c: Column) -> Column:
    """The account id in parameters: bare digits, or the number of the first ``::userid`` entry; else null."""
    t = trim_ascii(c)
    after = t.substr(F.instr(t, '::userid";i:') + 12, F.length(t))
    found = F.when(t.rlike(r"\A[0-9]+\z"), t).when(t.contains('::userid";i:'), F.regexp_extract(after, r"\A([0-9]+);", 1))
    return F.when(valid_id(found), found)


def bad_userid(c: Column) -> Column:
    """Parameters that claim an account id but hold no valid one."""
    claims = c.contains("::userid") | ~c.startswith("a")
    return F.coalesce((c != "") & (c != "a:0:{}") & claims & serialised_userid(c).isNull(), F.lit(False))


def zero_userid(c: Column) -> Column:
    return F.coalesce(c == 'a:1:{s:9:"4::userid";i:0;}', F.lit(False))


def serialised_newuser(c: Column) -> Column:
    """The new name in rename parameters: the counted string of ``::newuser`` (its length is in bytes), or old plain text."""
    key = '::newuser";s:'
    rest = c.substr(F.instr(c, key) + len(key), F.length(c))
    size = F.regexp_extract(rest, r'\A([0-9]{1,9}):"', 1)
    data = F.encode(rest.substr(F.length(size) + 3, F.length(rest)), "UTF-8")
    n = size.try_cast("int")
    # The quote must stand right after the counted bytes.
    closed = data.substr(n + 1, F.lit(1)) == F.encode(F.lit('"'), "UTF-8")
    counted = F.when((size != "") & closed, F.decode(data.substr(F.lit(1), n), "UTF-8"))
    return none_if_empty(F.when(c.contains(key), counted).when(~c.startswith("a:"), c))


def stripped_evidence(c: Column) -> Column:
    """The label within an invalidated account's evidence; other labels as they are."""
    inner = F.regexp_extract(c, f"^{INVALID_PREFIX}(.+){INVALID_SUFFIX}$", 1)
    return F.coalesce(none_if_empty(inner), c)


def joined(*parts: Column, sep: str = "|") -> Column:
    """Parts joined with nulls as empty text."""
    return F.concat_ws(sep, *(F.coalesce(p, F.lit("")) for p in parts))


def site_of_dbname(c: Column) -> Column:
    """``pt_brwiki`` is the site ``pt-br``."""
    return F.translate(F.regexp_replace(c, "wiki$", ""), "_", "-")


def element_text(block: Column, tag: str) -> Column:
    """Text of the first element of this name; null if it is deleted, empty-tagged or absent. Entities stay as they are."""
    tag_end = r"(?=[\s/>])"
    first = F.regexp_extract(block, rf"(?s)<{tag}{tag_end}([^>]*)>", 1)
    text = F.regexp_extract(block, rf"(?s)<{tag}{tag_end}[^>]*>(.*?)</{tag}\s*>", 1)
    opened = block.rlike(rf"<{tag}{tag_end}")
    usable = opened & ~first.rlike("/$") & ~first.rlike(r"""\bdeleted\s*=\s*["']deleted["']""")
    return F.when(usable, text)


#: The five named entities; the ampersand is decoded last.
NAMED = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"))


def decode_numeric(text: str) -> str:
    """All entities of one text in one pass; unknown ones stay."""
    names = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&"}

    def one(m: re.Match) -> str:
        body = m[1]
        if body[0] != "#":
            return names.get(body, m[0])
        try:
            point = int(body[2:], 16) if body[1] in "xX" else int(body[1:])
        except ValueError:
            return m[0]
        return chr(point) if 0 < point < 0x110000 and not 0xD800 <= point < 0xE000 else m[0]

    return re.sub(r"&(#[xX][0-9A-Fa-f]+|#[0-9]+|[a-z]+);", one, text)


@F.pandas_udf(T.StringType())
def _decode_udf(texts: pd.Series) -> pd.Series:
    return texts.map(decode_numeric, na_action="ignore")


def decode_entities(c: Column) -> Column:
    """Named entities by built-in functions; a Python function only for texts with numeric ones."""
    plain = c
    for name, char in NAMED:
        plain = F.replace(plain, F.lit(name), F.lit(char))
    plain = F.replace(plain, F.lit("&amp;"), F.lit("&"))
    return F.when(~c.contains("&"), c).when(~c.contains("&#"), plain).otherwise(_decode_udf(c))


@F.pandas_udf(T.BooleanType())
def _is_ipv6(texts: pd.Series) -> pd.Series:
    def one(t: str) -> bool:
        try:
            socket.inet_pton(socket.AF_INET6, t)
        except (OSError, ValueError):
            return False
        return True

    return texts.map(one, na_action="ignore").astype("boolean")


def is_ip(c: Column) -> Column:
    """An IPv4 or IPv6 literal; scoped addresses are not. A Python function sees only texts with two colons."""
    octet = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    four = c.rlike(rf"\A{octet}(\.{octet}){{3}}\z")
    return F.when(c.rlike(r"\A[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*\z"), _is_ipv6(c)).otherwise(F.coalesce(four, F.lit(False)))


def yes_no(c: Column) -> Column:
    return F.when(c, "yes").otherwise("no")


def true_false(c: Column) -> Column:
    return F.when(c, "true").otherwise("false")


def needle_count(c: Column, needle: str) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", needle))), F.lit(0))
