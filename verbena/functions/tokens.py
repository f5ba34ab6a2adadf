"""Protecting technical tokens while a text is worked on, and putting them back.

A protected text carries a numbered mark for each token; the tokens themselves stay in an
array beside it. Marks end in a sign that no number continues, so mark 1 isn't part of 10.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Style:
    """How tokens look, and what stands before and after the number of a mark."""

    pattern: str
    before: str
    after: str

    def marked(self, before: str, after: str) -> Style:
        """The same tokens under other marks, such as those that stored texts already hold."""
        return replace(self, before=before, after=after)


#: What the styles protect. Brackets of the first end on their line, the others may hold line breaks.
BRACKETS = Style(r"\[[^\]\n]*\]|\([^)\n]*\)|\{[^}\n]*\}|<[^>\n]*>", "__TOKEN_", "__")
MARKUP = Style(r"\r\n|\r|\n|\[lua\((?s:.*?)\)\]|\[[^\]]+\]|<[^>]+>|\{[^{}]+\}", "__MARK_", "__")
SNAKE = Style(r"\r\n|\r|\n|\[[^\]]+\]|<[^>]+>|\{[^{}]+\}|\([a-z_][a-z0-9_]*\)|_", "SNAKETOKEN", "END")
LAUNCHER = MARKUP.marked("MARK_", "_END")


def tokens_of(text: Column, style: Style) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"({style.pattern})"), F.lit(1)), F.array().cast("array<string>"))


def protect(text: Column, style: Style) -> Column:
    """The text with the n-th token as mark n: the pieces between tokens and the marks, joined in turn."""
    pieces = F.split(text, style.pattern, -1)
    marked = F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lit(style.before), (i - 1).cast("string"), F.lit(style.after), p)))
    return F.array_join(marked, "")


def restore(protected: Column, tokens: Column, style: Style) -> Column:
    """The tokens in place of their marks, one fold over the array."""
    numbered = F.transform(tokens, lambda t, i: F.struct(i.alias("i"), t.alias("t")))
    return F.aggregate(numbered, protected, lambda acc, x: F.replace(acc, F.concat(F.lit(style.before), x["i"].cast("string"), F.lit(style.after)), x["t"]))


def lost(protected: Column, tokens: Column, style: Style) -> Column:
    """The tokens whose mark a worked-on text no longer has."""
    numbered = F.transform(tokens, lambda t, i: F.struct(i.alias("i"), t.alias("t")))
    gone = F.filter(numbered, lambda x: ~F.contains(protected, F.concat(F.lit(style.before), x["i"].cast("string"), F.lit(style.after))))
    return F.transform(gone, lambda x: x["t"])
