"""Plain forms of names and titles, as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _single(form: str, ascii_only: bool) -> tuple[str, str]:
    """Characters that a normalisation form turns into one (ASCII) character, and these."""
    a, b = [], []
    for block in ((0xA0, 0x250), (0x1E00, 0x1F00), (0x2000, 0x2070), (0x2100, 0x2150), (0xFF01, 0xFF5F), (0x3000, 0x3001)):
        for code in range(*block):
            c = chr(code)
            n = unicodedata.normalize(form, c)
            if ascii_only:
                n = "".join(x for x in n if ord(x) < 128)
            if len(n) == 1 and n != c:
                a.append(c)
                b.append(n)
    return "".join(a), "".join(b)


_TO_ASCII, _ASCII = _single("NFKD", True)
_TO_COMPAT, _COMPAT = _single("NFKC", False)

# Prefixes of ship names.
SHIP_PREFIXES = (
    "HMS HMAS HMCS HMNZS HMIS HMSAS HMT HMY HMHS HMRT HM HMSub USS USNS USAT USCGC USC&GS USRC USLHT USFC USAHS USSB USCG USMS CSS SMS SM SMU SMY KMS HNLMS HNoMS HNMS NMS HDMS HSwMS HSK FS ORP ARA BNS INS ITS RN KRI TCG "
    "NRP IJN UB UC RMS RMMV SS S.S MV M/V MS M/S MT M/T TS TSS SV S/V PS SY FV F/V MFV RV R/V CS LV TB ST SB SL"
).split()
_PREFIX = r"(?i)^(?:(?:" + "|".join(p.replace(".", r"\.") for p in sorted(SHIP_PREFIXES, key=lambda p: (-len(p), p))) + r")\.?\s+)+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it is looked at."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_fold(text: Column) -> Column:
    """Accents off; what has no ASCII form is dropped. Null gives ''."""
    return F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _TO_ASCII, _ASCII), r"[^\x00-\x7F]", "")


def normal(text: Column, form: str) -> Column:
    """The Unicode normal form, for which Spark has no expression. Not within lambdas. Null gives ''."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t.isascii() else unicodedata.normalize(form, t))

    return F.pandas_udf(run, T.StringType())(F.coalesce(text, F.lit("")))


def clean(text: Column) -> Column:
    """Compatibility characters that stand for one character replaced (for all, pass ``normal``), footnote marks and invisible signs out, blanks single."""
    out = F.translate(F.coalesce(text, F.lit("")), _TO_COMPAT, _COMPAT)
    out = F.regexp_replace(out, r"\[(?:\d+|[a-z]|note \d+|citation needed|nb \d+)\]", "")
    out = F.translate(out, "﻿​", "")
    return F.trim(F.regexp_replace(out, r"(?U)\s+", " "))


def norm_listed(text: Column) -> Column:
    """The form list rows are keyed by: folded, lower case, other runs as one blank."""
    return F.trim(F.regexp_replace(F.lower(ascii_fold(text)), "[^a-z0-9]+", " "))


def norm_name(text: Column) -> Column:
    """The form duplicates are found by: folded, without brackets and ship prefixes, and without a leading article."""
    out = F.regexp_replace(ascii_fold(text), r"\(.*?\)", " ")
    out = F.regexp_replace(F.regexp_replace(out, r"^\s+|\s+$", ""), _PREFIX, "")
    out = F.trim(F.lower(F.regexp_replace(out, "[^a-zA-Z0-9]+", " ")))
    return F.regexp_replace(out, "^the ", "")


def safe_name(text: Column) -> Column:
    """A text fit for a file name, 150 characters at most, ``image`` if nothing is left."""
    out = F.regexp_replace(F.regexp_replace(ascii_fold(normal(text, "NFKD")), r"[^A-Za-z0-9._-]+", "_"), "^_+|_+$", "")
    out = F.substring(out, 1, 150)
    return F.when(out == "", F.lit("image")).otherwise(out)


def url_basename(url: Column) -> Column:
    """The last part of an address's path, decoded."""
    return F.try_url_decode(F.regexp_replace(F.substring_index(F.substring_index(url, "?", 1), "/", -1), r"\+", "%2B"))


def derived_url(url: Column, article: Column, base: str = "https://wiki.example/wiki/") -> Column:
    """``url``, or where it is empty the address of ``article``."""
    have = F.coalesce(url, F.lit(""))
    return F.when((have == "") & (F.coalesce(article, F.lit("")) != ""), F.concat(F.lit(base), F.replace(article, F.lit(" "), F.lit("_")))).otherwise(have)
