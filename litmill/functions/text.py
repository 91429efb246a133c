"""Scalar functions on text. All are columns of built-in expressions, but for
those that need Unicode folding, sequence matching or an HTML parser; these run
as vectorised functions and only on the rows that need them."""

from __future__ import annotations

import html
import ipaddress
import re
import unicodedata
import urllib.parse

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litmill.functions.blocks import Blocks, matching_share

#: How DOIs and numbers are written.
DOI_PREFIX = r"^(https?://(dx\.)?doi\.org/|doi\s*:\s*)"
DOI = r"^10\.\d{4,9}/\S+$"
DOI_IN_TEXT = r"10\.\d{4,9}/[^\s\"<>]+"
#: Dashes that count as a hyphen in identities.
DASHES = "\u2010\u2011\u2012\u2013\u2014\u2212"
NUMBER = r"(?<![A-Za-z\d])[-\u2212]?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?"
ZONE = r"(Z|[+-]\d\d:\d\d)$"


def empty_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def stripped(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def normalize_doi(c: Column) -> Column:
    return empty_to_null(stripped(F.regexp_replace(F.lower(stripped(c)), DOI_PREFIX, "")))


def valid_doi(c: Column) -> Column:
    return F.coalesce(normalize_doi(c).rlike(DOI), F.lit(False))


def find_dois(c: Column) -> Column:
    """DOIs in a text without the punctuation that follows them."""
    return F.transform(F.regexp_extract_all(c, F.lit(DOI_IN_TEXT), 0), lambda x: F.regexp_replace(x, r"[.,;:)\]}]+$", ""))


def _folding(transform):
    """A column function: ``ascii`` in generated code, ``transform`` on the other rows."""

    @F.pandas_udf(T.StringType())
    def other(texts: pd.Series) -> pd.Series:
        return texts.map(transform, na_action="ignore")

    def fold(c: Column, ascii: Column) -> Column:
        plain = F.octet_length(c) == F.length(c)
        return F.when(plain, ascii).otherwise(other(F.when(~plain, c)))

    return fold


_title = _folding(lambda t: " ".join(re.sub(r"[\W_]+", " ", unicodedata.normalize("NFKC", t).casefold()).split()))
_item = _folding(lambda t: " ".join(unicodedata.normalize("NFKC", t).casefold().split()))
_words = _folding(lambda t: " ".join(t.casefold().split()))
_packed = _folding(lambda t: "".join(unicodedata.normalize("NFKC", t).split()))
_identity = _folding(lambda t: "".join(unicodedata.normalize("NFKC", t).casefold().translate({ord(d): "-" for d in DASHES}).split()))


def title_key(c: Column) -> Column:
    """Case and width folded, anything but letters and digits to single spaces."""
    return _title(c, F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", " ")))


def item_key(c: Column) -> Column:
    """Case and width folded, white space to single spaces."""
    return _item(c, F.trim(F.regexp_replace(F.lower(c), r"[\s\x1c-\x1f]+", " ")))


def folded_words(c: Column) -> Column:
    """The words of a text, case folded, each once."""
    folded = _words(c, F.trim(F.regexp_replace(F.lower(c), r"[\s\x1c-\x1f]+", " ")))
    return F.filter(F.array_distinct(F.split(folded, " ")), lambda w: w != "")


def packed_text(c: Column) -> Column:
    """Width folded, without white space."""
    return _packed(c, F.regexp_replace(c, r"[\s\x1c-\x1f]+", ""))


def identity_key(c: Column) -> Column:
    """Glyph names of digits read as digits, folded, dashes alike, no spaces."""
    for digit, name in enumerate(("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")):
        c = F.replace(c, F.lit(f"/{name}.tnum"), F.lit(str(digit)))
    return _identity(c, F.regexp_replace(F.lower(c), r"[\s\x1c-\x1f]+", ""))


@F.pandas_udf(T.DoubleType())
def similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    """Share of matching blocks of two texts; 0 where one is empty. Where one text
    holds the other that is all of the shorter one."""

    def one(a: str | None, b: str | None) -> float:
        if not a or not b:
            return 0.0
        if a in b or b in a:
            return 2 * min(len(a), len(b)) / (len(a) + len(b))
        return matching_share(a, b)

    return pd.Series([one(a, b) for a, b in zip(left, right)], dtype="float64")


#: What a page has beside text: comments and declarations, elements that no one
#: sees, tags. The name of a tag tells whether it parts what stands beside it.
NO_TEXT = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(script|style|head|template)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
TAG = re.compile(r"</?([a-z][^\s/>]*)(?:[^>\"']|\"[^\"]*\"|'[^']*')*>", re.I)
PARTING = frozenset("p div br li ul ol tr td th h1 h2 h3 h4 h5 h6 section article footer nav title".split())


@F.pandas_udf(T.StringType())
def visible_text(pages: pd.Series) -> pd.Series:
    """What a reader sees of a page: no scripts, entities decoded, blocks apart."""

    def one(page: str) -> str:
        text = TAG.sub(lambda tag: " " if tag[1].lower() in PARTING else "", NO_TEXT.sub("", page))
        return " ".join(html.unescape(text).split())

    return pages.map(one, na_action="ignore")


def unmarked(c: Column) -> Column:
    """Text without tags and entities, where it has any."""
    marked = c.rlike("[<&]")
    return F.when(marked, visible_text(F.when(marked, c))).otherwise(c)


def _tags(page: Column, names: str) -> Column:
    """Tags of a page as they are written; signs in quotes end none."""
    return F.regexp_extract_all(page, F.lit(rf"""(?is)<(?:{names})\b(?:[^>"']|"[^"]*"|'[^']*')*>"""), 0)


def _attribute(tag: Column, name: str) -> Column:
    """The value of a tag's first attribute of a name, quoted or not; empty if it
    has none. Other attributes are passed over whole, with what stands in their quotes."""
    value = r"""(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""
    other = rf"""\s+(?!{name}[\s=])[^\s=>"']+(?:\s*=\s*{value})?"""
    found = F.regexp_extract(tag, rf"(?is)^<[a-z]+(?:{other})*\s+{name}\s*=\s*({value})", 1)
    return F.regexp_replace(found, r"""(?s)^"(.*)"$|^'(.*)'$""", "$1$2")


def page_links(page: Column, base: Column, n: int = 2) -> Column:
    """The first ``n`` distinct link targets of a page, rooted ones resolved."""
    root = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    found = F.filter(F.transform(_tags(page, "a"), lambda tag: _attribute(tag, "href")), lambda x: x != "")
    return F.slice(F.array_distinct(F.transform(found, lambda x: F.when(x.startswith("/"), F.concat(root, x)).otherwise(x))), 1, n)


@F.pandas_udf(T.StringType())
def joined_link(base: pd.Series, link: pd.Series) -> pd.Series:
    """A link as seen from a page; null where that is no address."""

    def one(page: str | None, target: str | None) -> str | None:
        try:
            return urllib.parse.urljoin(page or "", html.unescape(target or ""))
        except ValueError:
            return None

    return pd.Series([one(p, t) for p, t in zip(base, link)], dtype="object")


def advertised_links(page: Column) -> Column:
    """The documents that a page's meta and link tags name, in order."""
    meta = lambda tag: F.when(F.lower(tag).startswith("<meta") & (F.lower(_attribute(tag, "name")) == "citation_pdf_url"), _attribute(tag, "content"))
    link = lambda tag: F.when(F.lower(tag).startswith("<link") & (F.lower(_attribute(tag, "type")) == "application/pdf"), _attribute(tag, "href"))
    return F.filter(F.transform(_tags(page, "meta|link"), lambda tag: F.coalesce(meta(tag), link(tag))), lambda x: x != "")


def slug(c: Column) -> Column:
    made = F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")
    return F.when(made == "", "section").otherwise(made)


def section_scope(heading: Column) -> Column:
    h = F.lower(heading)
    ladder = F.when(h.rlike(r"\b(method|methods|materials|methodology|experimental|experiment|statistical|statistic)\b"), "methods")
    for word, scope in (("result", "results"), ("discussion", "discussion"), ("conclusion", "conclusion"), ("concluding", "conclusion"), ("limitation", "discussion")):
        ladder = ladder.when(h.contains(word), scope)
    return ladder.otherwise("other")


def formula_guard(c: Column) -> Column:
    """Text that a spreadsheet would take for a formula gets a quote before it."""
    return F.when(F.ltrim(c).rlike(r"^[=+\-@]"), F.concat(F.lit("'"), c)).otherwise(c)


def content_hash(*columns: Column | str) -> Column:
    """SHA-256 of the columns as JSON; give them in order of their names."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def legacy_id(database: Column, query: Column) -> Column:
    return F.concat(F.lit("legacy_"), F.left(F.sha2(F.to_json(F.array(database, query)), 256), F.lit(12)))


def number_tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(NUMBER), 0)


def without_sign(c: Column) -> Column:
    return F.ltrim(c, F.lit("+\u2212-"))


def zoned(c: Column) -> Column:
    """Whether a text is a time with a zone."""
    return F.coalesce(c.rlike(ZONE) & F.try_to_timestamp(c).isNotNull(), F.lit(False))


def prf(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    """Precision, recall and F1. Nothing predicted: precision 1 if nothing was
    to be found, else 0; nothing to be found: recall 1."""
    p = F.when(tp + fp == 0, F.when(tp + fn == 0, 1.0).otherwise(0.0)).otherwise(tp / F.nullif(tp + fp, F.lit(0)))
    r = F.when(tp + fn == 0, 1.0).otherwise(tp / F.nullif(tp + fn, F.lit(0)))
    return p, r, F.when(p + r == 0, 0.0).otherwise(2 * p * r / F.nullif(p + r, F.lit(0.0)))


def sentence(text: Column, start: Column, end: Column) -> Column:
    """The sentence around ``[start, end)``, code points from 0."""
    left = F.substring(text, F.lit(1), start)
    before = F.length(F.regexp_extract(left, r"(?s)^(.*[.?!])[^.?!]*$", 1))
    after = F.regexp_extract(F.substring(text, end + 1, F.length(text)), r"(?s)^([^.?!]*[.?!]?)", 1)
    return F.concat(F.substring(text, before + 1, end - before), after)


def sentence_or_quote(text: Column, start: Column, end: Column, quote: Column) -> Column:
    """The sentence around a span; where the span is none, around the first place
    of its quote; where that is nowhere, the quote."""
    valid = F.coalesce((start >= 0) & (start < end) & (end <= F.length(text)), F.lit(False))
    at = F.nullif(F.instr(text, quote), F.lit(0)) - 1
    return F.when(valid, sentence(text, start, end)).when(at.isNotNull() & (quote != ""), sentence(text, at, at + F.length(quote))).otherwise(quote)


def context(text: Column, start: Column, end: Column, width: int = 180) -> Column:
    """Half of ``width`` characters before and after a span, on one line."""
    low, high = F.greatest(F.lit(0), start - width // 2), F.least(F.length(text), end + width // 2)
    return F.replace(F.substring(text, low + 1, F.greatest(F.lit(0), high - low)), F.lit("\n"), F.lit(" "))


def pointer_value(document: Column, pointer: Column) -> Column:
    """What a JSON text holds where a pointer points; null if nothing. A step of
    digits is a place in a list."""
    steps = F.transform(F.split(F.substring(pointer, 2, F.length(pointer)), "/"), lambda s: F.replace(F.replace(s, F.lit("~1"), F.lit("/")), F.lit("~0"), F.lit("~")))
    path = F.concat(F.lit("$"), F.array_join(F.transform(steps, lambda s: F.when(s.rlike("^[0-9]+$"), F.concat(F.lit("["), s, F.lit("]"))).otherwise(F.concat(F.lit("['"), s, F.lit("']")))), ""))
    return F.call_function("get_json_object", document, path)


def unique_position(text: Column, part: Column) -> Column:
    """Where a text holds a part, from 0, if it does so once."""
    at = F.instr(text, part)
    rest = F.substring(text, at + 1, F.length(text))
    return F.when((at > 0) & (F.instr(rest, part) == 0), at - 1)


@F.pandas_udf(T.ArrayType(T.StringType()))
def changed_blocks(left: pd.Series, right: pd.Series) -> pd.Series:
    """The first five changed blocks between two texts of any length, word by word."""

    def one(a: str | None, b: str | None) -> list[str]:
        x, y = (a or "").split(), (b or "").split()
        codes = Blocks(x, y).get_opcodes() if x != y else []
        return [f"{kind}: {' '.join(x[i:j])} -> {' '.join(y[k:m])}" for kind, i, j, k, m in codes if kind != "equal"][:5]

    return pd.Series([one(a, b) for a, b in zip(left, right)])


#: Query parameters of signed and of secret-bearing addresses, hosts that are not public, sources that are refused.
SIGNED = ("x-amz-security-token", "x-amz-signature", "x-amz-credential", "x-goog-signature", "x-goog-credential", "awsaccesskeyid", "signature", "sig")
SECRET_PARAMETERS = ("api_key", "apikey", "access_token", "token", "authorization")
PRIVATE_HOSTS, PRIVATE_ENDINGS = ("localhost", "metadata.google.internal"), (".local", ".internal")
REFUSED = ("sci-hub", "scihub", "libgen", "annas-archive")


@F.pandas_udf(T.BooleanType())
def _worldwide(hosts: pd.Series) -> pd.Series:
    """Whether an address in numbers is one of the public network; true for names."""

    def one(host: str) -> bool:
        try:
            return ipaddress.ip_address(host).is_global
        except ValueError:
            return ":" not in host

    return hosts.map(one, na_action="ignore")


def public_url(url: Column) -> Column:
    """The address without secret parameters and fragment, its other parameters
    encoded alike; null unless it is https, public, unsigned, of no refused
    source and without credentials."""
    part = lambda i: F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?", i)
    authority = part(2)
    user, place = F.regexp_extract(authority, "^(.*)@", 1), F.regexp_replace(authority, "^.*@", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(place, r"^(\[[^\]]*\]|[^:]*)", 1), r"[\[\]]", ""))
    worldwide = F.coalesce(_worldwide(F.when(host.rlike(r"^[0-9.]+$|:"), host)), F.lit(True))
    private = host.isin(*PRIVATE_HOSTS) | F.exists(F.array(*map(F.lit, PRIVATE_ENDINGS)), lambda e: F.endswith(host, e)) | ~worldwide
    refused = F.exists(F.array(*map(F.lit, REFUSED)), lambda r: F.contains(host, r))

    def plain(c: Column) -> Column:
        return F.coalesce(F.try_url_decode(F.regexp_replace(c, "%(?![0-9a-fA-F]{2})", "%25")), c)

    def coded(c: Column) -> Column:
        return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))

    pairs = F.transform(F.filter(F.split(part(4), "&"), lambda p: p != ""), lambda p: F.struct(plain(F.substring_index(p, "=", 1)).alias("name"), plain(F.regexp_extract(p, "^[^=]*=(.*)$", 1)).alias("value")))
    kept = F.array_join(F.transform(F.filter(pairs, lambda p: ~F.lower(p["name"]).isin(*SECRET_PARAMETERS)), lambda p: F.concat(coded(p["name"]), F.lit("="), coded(p["value"]))), "&")
    good = (F.lower(part(1)) == "https") & (host != "") & user.isin("", ":") & ~private & ~refused & ~F.exists(pairs, lambda p: F.lower(p["name"]).isin(*SIGNED))
    base = F.concat(F.lit("https://"), authority, part(3))
    return F.when(good, F.when(kept == "", base).otherwise(F.concat(base, F.lit("?"), kept)))
