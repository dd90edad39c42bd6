"""Column expressions over text: titles, names, leak and credential scans, pages and URLs.

Patterns avoid look-around and back-references, so that the same text works in Java and in RE2.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Boilerplate and punctuation that titles lose, endings that name an episode, lengths of affixes, keys and
# values that are secret, and the mark that stands for them.
BOILERPLATE = ("图寻geoguessr", "geoguessr")
TITLE_PUNCTUATION = r"""[\s_\-—–｜丨;；,，.。!！?？:：·~～'"“”‘’()（）\[\]【】{}<>《》#@]+"""
EPISODE = (
    r"(第[0-9一二三四五六七八九十]+[集期弹]|[（(][0-9一二三四五六七八九十]+[)）]|[上下续]$|vol\.?\s*[0-9]+|[0-9]+)$"
)
AFFIX_LENGTHS = (8, 10, 12, 14, 16, 18, 20, 24, 28, 32, 36, 40)
SECRET_KEY = r"(?i)(api[_-]?key|access[_-]?key|secret|token|password|passwd|authorization|credential)"
SECRET_VALUE = r"(sk-[A-Za-z0-9_-]{16,}|AIza[A-Za-z0-9_-]{20,}|Bearer\s+[A-Za-z0-9._-]{16,})"
REDACTED = "***REDACTED***"
# IPv4 ranges that are not routed publicly.
NOT_GLOBAL = (
    r"^(0\.|10\.|127\.|169\.254\.|192\.168\.|192\.0\.0\.|192\.0\.2\.|198\.51\.100\.|203\.0\.113\.|198\.1[89]\.|"
    r"172\.(1[6-9]|2[0-9]|3[01])\.|100\.(6[4-9]|[7-9][0-9]|1[01][0-9]|12[0-7])\.|(22[4-9]|2[3-5][0-9])\.)"
)
LOGIN_WORDS = ("login required", "please log in", "sign in to continue", "captcha", "access denied", "paywall")


def title_norm(title: Column) -> Column:
    """Without hashtags, boilerplate and punctuation; lower-cased last, so boilerplate is matched as written."""
    out = F.regexp_replace(title, r"#\S+", " ")
    for words in BOILERPLATE:
        out = F.replace(out, F.lit(words), F.lit(" "))
    return F.lower(F.regexp_replace(out, TITLE_PUNCTUATION, ""))


def author_canonical(author: Column, aliases: dict[str, str] | None = None) -> Column:
    """Trimmed, without a channel suffix, then by the alias table (as written or lower-cased)."""
    out = F.trim(author)
    out = F.regexp_replace(out, "的作品$", "")
    out = F.when(out == "Where_Are_U", out).otherwise(F.regexp_replace(out, "up$", ""))
    if not aliases:
        return out
    table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return F.coalesce(F.try_element_at(table, out), F.try_element_at(table, F.lower(out)), out)


def episode_key(title: Column) -> Column:
    return F.regexp_extract(F.replace(F.lower(title), F.lit(" "), F.lit("")), EPISODE, 1)


def numbers_in(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"\d+"), F.lit(0))


def number_conflict(left: Column, right: Column) -> Column:
    """Both name numbers and share none."""
    a, b = numbers_in(left), numbers_in(right)
    return (F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(a, b)


def duration_ok(left: Column, right: Column) -> Column:
    """Unknown durations pass; others may differ by a fifth of the longer."""
    longer = F.greatest(left, right)
    return F.coalesce((longer <= 0) | (F.abs(left - right) <= longer * 0.20), F.lit(True))


def strip_affixes(text: Column, affixes: Column) -> Column:
    """Take each affix off front and end, in order, as long as four characters stay."""

    def off(rest: Column, affix: Column) -> Column:
        size = F.char_length(affix)
        front = F.when(
            F.startswith(rest, affix) & (F.char_length(rest) - size >= 4), F.substr(rest, size + 1)
        ).otherwise(rest)
        return F.when(
            F.endswith(front, affix) & (F.char_length(front) - size >= 4),
            F.substr(front, F.lit(1), F.char_length(front) - size),
        ).otherwise(front)

    return F.aggregate(F.coalesce(affixes, F.array().cast("array<string>")), text, off)


def slug(name: Column) -> Column:
    """Lower case; runs of anything but letters and digits become one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(name)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def tokens_all_in(text: Column, query: str) -> Column:
    """Every word of the query occurs in the text, ignoring case."""
    words = query.lower().split()
    out = F.lit(True)
    for w in words:
        out = out & F.contains(F.lower(text), F.lit(w))
    return out


def any_term(text: Column, terms) -> Column:
    """Some term occurs in the text, ignoring case."""
    out = F.lit(False)
    for t in terms:
        out = out | F.contains(F.lower(text), F.lit(t.lower()))
    return out


def has_credentials(text: Column) -> Column:
    return F.coalesce(text.rlike(SECRET_VALUE), F.lit(False))


def redacted(text: Column) -> Column:
    return F.regexp_replace(text, SECRET_VALUE, REDACTED)


def redacted_fields(fields: Column) -> Column:
    """A map of strings with the values of credential keys, and credentials inside other values, written over."""
    return F.transform_values(fields, lambda k, v: F.when(k.rlike(SECRET_KEY), REDACTED).otherwise(redacted(v)))


def page_title(html: Column) -> Column:
    """Text of the first title element, white space collapsed."""
    title = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    return F.trim(F.regexp_replace(title, r"\s+", " "))


def page_text(html: Column) -> Column:
    """Visible text: scripts, styles, comments and tags removed, common entities decoded, white space collapsed."""
    out = html
    for pattern in (r"(?is)<script[^>]*>.*?</script>", r"(?is)<style[^>]*>.*?</style>", r"(?s)<!--.*?-->", r"(?s)<[^>]+>"):
        out = F.regexp_replace(out, pattern, " ")
    for entity, plain in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(plain))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def page_restriction(html: Column) -> Column:
    """login, script (next to no text but scripts) or none."""
    text = page_text(html)
    scripts = F.contains(F.lower(html), F.lit("<script"))
    return (
        F.when(any_term(text, LOGIN_WORDS), "login").when((F.char_length(text) < 200) & scripts, "script").otherwise("none")
    )


def excerpt(text: Column, size: int) -> Column:
    return F.when(F.char_length(text) > size, F.concat(F.substring(text, 1, size), F.lit("…"))).otherwise(text)


def untrusted(text: Column) -> Column:
    return F.concat(F.lit("<untrusted>\n"), text, F.lit("\n</untrusted>"))


def clean_url(url: Column) -> Column:
    """Without fragment and tracking parameters."""
    out = F.regexp_replace(url, r"#.*$", "")
    out = F.regexp_replace(out, r"([?&])(utm_[a-z]+|fbclid|gclid)=[^&]*", r"$1")
    return F.regexp_replace(F.regexp_replace(out, r"[?&]+$", ""), r"([?&])&+", r"$1")


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:@]+)", 1))


def public_http(url: Column) -> Column:
    """http or https without user info, with a named host that is not local or a public IPv4 address in plain form.

    Anything else fails: IPv6, other spellings of addresses, odd ports. Names are not looked up.
    """
    parts = r"^(?i:https?)://([^/?#\\]*)"
    host = F.regexp_replace(F.lower(F.regexp_extract(url, parts, 1)), r"(:[0-9]{1,5})?$", "")
    host = F.regexp_replace(host, r"\.$", "")
    named = host.rlike(r"^([a-z0-9_]([a-z0-9_-]*[a-z0-9_])?\.)+[a-z]([a-z0-9-]*[a-z0-9])?$") & ~host.rlike(r"(^|\.)(localhost|local|internal)$")
    address = host.rlike(r"^((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$") & ~host.rlike(NOT_GLOBAL)
    plain = ~url.rlike(r"[\\\s\x00-\x1F]")  # readers differ in where such an address ends
    return F.coalesce(url.rlike(parts) & plain & (named | address), F.lit(False))


def formula_safe(value: Column) -> Column:
    """A quote in front of what a spreadsheet would read as a formula."""
    return F.when(value.rlike(r"^[=+@\t\r\n-]"), F.concat(F.lit("'"), value)).otherwise(value)


def xml_escape(value: Column) -> Column:
    out = value
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(plain), F.lit(entity))
    return out


def timecode(seconds: Column) -> Column:
    """MM:SS, with hours in front from one hour on."""
    whole = F.floor(F.greatest(seconds, F.lit(0.0))).cast("long")
    hours, minutes, rest = F.floor(whole / 3600), F.floor(whole / 60) % 60, whole % 60
    return F.when(hours > 0, F.format_string("%02d:%02d:%02d", hours, minutes, rest)).otherwise(
        F.format_string("%02d:%02d", minutes, rest)
    )


def numbers_with_km(text: Column) -> Column:
    """Numbers of a text as doubles; those followed by km in metres."""
    found = F.regexp_extract_all(text, F.lit(r"(-?\d+(?:\.\d+)?\s*(?:km)?)"), F.lit(1))
    return F.transform(
        found,
        lambda x: F.regexp_extract(x, r"(-?\d+(?:\.\d+)?)", 1).cast("double") * F.when(F.contains(x, F.lit("km")), 1000.0).otherwise(1.0),
    )


def dms_degrees(degrees: Column, minutes: Column, seconds: Column, ref: Column) -> Column:
    value = degrees + minutes / 60.0 + seconds / 3600.0
    return F.when(F.upper(ref).isin("S", "W"), -value).otherwise(value)


def without_keys(*keys: str):
    """A function of a column of JSON texts: the texts without these keys at any depth; null where a text is no JSON."""
    forbidden = frozenset(keys)

    def stripped(value):
        open_ = [value]
        while open_:  # no recursion, however deep the text is nested
            x = open_.pop()
            if isinstance(x, dict):
                for k in forbidden.intersection(x):
                    del x[k]
                open_ += x.values()
            elif isinstance(x, list):
                open_ += x
        return value

    def one(text: str | None) -> str | None:
        try:
            return None if text is None else json.dumps(stripped(json.loads(text)), ensure_ascii=False)
        except (ValueError, RecursionError):
            return None

    @F.pandas_udf(T.StringType())
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    return clean
