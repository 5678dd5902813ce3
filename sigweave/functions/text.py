"""Text expressions. White space and word edges follow web pages' scripts: NBSP and the like are space, and
only ASCII letters, digits and `_` make a word edge."""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WS = r"[\s\x0B   -     　﻿]"

# Words that titles' tokens leave out.
STOP_WORDS = ["a", "an", "and", "for", "in", "of", "on", "the", "to", "with", "new", "news"]

# Entity patterns and their characters, in order of replacement.
ENTITIES = [
    (r"(?i)&amp;|&#038;|&#x26;", "&"),
    (r"&quot;", '"'),
    (r"&#0*39;|&apos;", "'"),
    (r"&lt;", "<"),
    (r"&gt;", ">"),
    (r"&#x27;", "'"),
    (r"&#x2F;", "/"),
    (r"&nbsp;", " "),
    (r"(?i)&#8220;|&#x201c;", "“"),
    (r"(?i)&#8221;|&#x201d;", "”"),
    (r"(?i)&#8216;|&#x2018;", "‘"),
    (r"(?i)&#8217;|&#x2019;", "’"),
    (r"(?i)&#8211;|&#x2013;", "–"),
    (r"(?i)&#8212;|&#x2014;", "—"),
]

_EDGE, _END = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"

# Fingerprints of makers and events; the first pattern found in a lower-case title names it.
# {w} marks a word edge before, {e} one after.
FINGERPRINTS = [
    ("honda", "{w}honda{e}|本田"),
    ("yamaha", "{w}yamaha{e}|雅马哈"),
    ("kawasaki", "{w}kawasaki{e}|川崎"),
    ("suzuki", "{w}suzuki{e}|铃木"),
    ("ducati", "{w}ducati{e}|杜卡迪"),
    ("bmw-moto", r"{w}bmw{e}.*moto|bmw\s*motorrad|宝马摩托"),
    ("ktm", "{w}ktm{e}"),
    ("triumph", "{w}triumph{e}|凯旋|英伦凯旋"),
    ("harley-davidson", r"harley[-\s]?davidson|哈雷"),
    ("royal-enfield", r"royal\s*enfield|皇家恩菲尔德"),
    ("aprilia", "{w}aprilia{e}"),
    ("piaggio-vespa", "{w}piaggio{e}|{w}vespa{e}|比亚乔|维斯帕"),
    ("tvs", "{w}tvs{e}"),
    ("bajaj", "{w}bajaj{e}"),
    ("cfmoto", r"{w}cfmoto{e}|春风动力|春风\s*\d"),
    ("qjmotor", r"qjmotor|钱江摩托|钱江\s*\d"),
    ("loncin", "{w}loncin{e}|隆鑫"),
    ("zongshen", "zongshen|宗申"),
    ("haojue", "haojue|豪爵"),
    ("dayang", "大长江"),
    ("modenas", "{w}modenas{e}"),
    ("motogp", "{w}motogp{e}"),
    ("worldsbk", r"{w}worldsbk{e}|world\s*superbike|世界超级摩托车"),
    ("eicma", "{w}eicma{e}"),
]


def trim_ws(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def first_filled(*cs: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs])


def strip_tags(c: Column) -> Column:
    """Feed text: tags become spaces; entities stay."""
    return trim_ws(F.regexp_replace(F.regexp_replace(c, r"<[^>]+>", " "), f"{WS}+", " "))


def strip_html(c: Column) -> Column:
    """Page text: tags and named entities in lower case become spaces."""
    bare = F.regexp_replace(F.regexp_replace(c, r"<[^>]+>", " "), r"&[a-z]+;", " ")
    return trim_ws(F.regexp_replace(bare, f"{WS}+", " "))


def decode_entities(c: Column) -> Column:
    return reduce(lambda acc, e: F.regexp_replace(acc, e[0], e[1]), ENTITIES, c)


def escape_html(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFKC")


def title_tokens(c: Column, compose: bool = True) -> Column:
    """The set of a title's tokens. compose: apply NFKC first, which needs Python; False stays in the JVM."""
    words = F.split(F.regexp_replace(F.lower(nfkc(c) if compose else c), "[^a-z0-9一-鿿]+", " "), " ")
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(STOP_WORDS)))


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def fingerprint(c: Column, compose: bool = True) -> Column:
    low = F.lower(nfkc(c) if compose else c)
    return F.coalesce(*[F.when(low.rlike(p.replace("{w}", _EDGE).replace("{e}", _END)), F.lit(name)) for name, p in FINGERPRINTS])


def short_hash(c: Column) -> Column:
    """31 h + unit over UTF-16 units in 32 bits, absolute, in hex, 8 digits at most."""
    h = F.reflect(F.lit("java.util.Objects"), F.lit("hashCode"), c).cast("long")
    return F.substring(F.lower(F.hex(F.abs(h))), 1, 8)


def slugify(c: Column) -> Column:
    plain = F.substring(F.regexp_replace(F.regexp_replace(F.lower(nfkd(c)), "[^a-z0-9一-鿿]+", "-"), "^-+|-+$", ""), 1, 90)
    return F.when(plain != "", plain).otherwise(F.concat(F.lit("item-"), F.substring(F.sha2(c, 256), 1, 12)))


@F.pandas_udf(T.StringType())
def nfkd(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFKD")


# Names of encodings that web pages use for others.
ENCODINGS = {"gb2312": "gb18030", "gb-2312": "gb18030", "gbk": "gb18030", "iso-8859-1": "cp1252", "latin1": "cp1252", "us-ascii": "cp1252"}
HEAD = 2048


def decode_body(body: Column | str, content_type: Column | str) -> Column:
    """Text of fetched bytes: by the header's charset, else that which the first HEAD bytes name, else UTF-8. Bytes
    that do not fit become U+FFFD; null stays null. UTF-8 is decoded in the JVM: Python gets nulls for such rows."""
    b, header = (F.col(c) if isinstance(c, str) else c for c in (body, content_type))
    found = lambda c, p: F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    head = F.decode(F.substring(b, 1, HEAD), "ISO-8859-1")
    name = F.lower(F.coalesce(found(header, r"(?i)charset=([\w-]+)"), found(head, r"""(?i)<meta[^>]+charset=["']?\s*([\w-]+)"""), F.lit("utf-8")))
    plain = name.isin("utf-8", "utf8")
    here = F.regexp_replace(F.make_valid_utf8(b.cast("string")), "^\ufeff", "")
    return F.when(plain, here).otherwise(_decoded(F.when(~plain, b), header))


@F.pandas_udf(T.StringType())
def _decoded(body: pd.Series, content_type: pd.Series) -> pd.Series:

    def one(b: bytes | None, header: str | None) -> str | None:
        if b is None:
            return None
        named = re.search(r"charset=([\w-]+)", header or "", re.IGNORECASE) or re.search(r"""<meta[^>]+charset=["']?\s*([\w-]+)""", bytes(b[:HEAD]).decode("latin-1"), re.IGNORECASE)
        name = named[1].lower() if named else "utf-8"
        try:
            out = bytes(b).decode(ENCODINGS.get(name, name), "replace")
        except LookupError:
            out = bytes(b).decode("utf-8", "replace")
        return out.removeprefix("\ufeff")

    return pd.Series([one(b, h) for b, h in zip(body, content_type, strict=True)], dtype=object)
