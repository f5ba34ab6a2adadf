"""The few functions that no column expression can give exactly, as Arrow-batched UDFs."""

from __future__ import annotations

import re
import unicodedata
from functools import cache

import pandas as pd
import regex
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import ENCODING_FAULTS


def _unescape(raw: str | None) -> str | None:
    if raw is None:
        return None
    try:
        text = raw.encode("utf-8").decode("unicode_escape")
    except UnicodeDecodeError:
        return raw
    try:
        return text.encode("latin-1").decode("utf-8")
    except (UnicodeEncodeError, UnicodeDecodeError):
        return text.encode("utf-8", "replace").decode("utf-8")


@F.pandas_udf(T.StringType())
def unescape_python(raw: pd.Series) -> pd.Series:
    """All escapes of a Python string body, octal and named ones too, then the repair of its bytes."""
    return raw.map(_unescape, na_action="ignore")


@F.pandas_udf(T.BooleanType())
def is_nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.is_normalized("NFC", t))


@cache
def _detectors() -> list[tuple[str, regex.Pattern]]:
    """The detectors of functions.text, whose \\x{..} is written \\U here."""
    return [(kind, regex.compile(re.sub(r"\\x\{(\w+)\}", lambda m: f"\\U{m[1]:0>8}", pattern))) for kind, pattern in ENCODING_FAULTS.items()]


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("type", "match", "context")])))
def faults_with_context(text: pd.Series) -> pd.Series:
    """Each fault of a text with up to 35 characters on both sides of it, line breaks written out."""

    def one(t: str | None) -> list[dict] | None:
        if t is None:
            return None
        found = [(kind, m) for kind, pattern in _detectors() for m in pattern.finditer(t)]
        cut = lambda m: t[max(0, m.start() - 35) : m.end() + 35].replace("\r", "\\r").replace("\n", "\\n")
        return [{"type": kind, "match": m.group(), "context": cut(m)} for kind, m in found]

    return text.map(one)


def context_windows(pattern: str, width: int = 35):
    """A UDF: up to `width` characters on both sides of each match, line breaks written out."""
    found = re.compile(pattern)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def windows(text: pd.Series) -> pd.Series:
        def one(t: str | None) -> list[str] | None:
            if t is None:
                return None
            cut = (t[max(0, m.start() - width) : m.end() + width] for m in found.finditer(t))
            return [c.replace("\r", "\\r").replace("\n", "\\n") for c in cut]

        return text.map(one)

    return windows
