"""Text that looks alike made alike: a longest-match transducer over grapheme clusters.

The mapping is computed once from the character database and tables of look-alike letters,
checked for conflicts, and compiled into one trie: full-width and styled letters, ligatures
and Roman numerals become plain ones, letters with separate accent marks become composed ones,
every other space becomes the ordinary one, characters that show nothing go, and look-alike
letters become the Latin ones. A leaf of the trie holds the output and the condition it
depends on. Look-alikes of the first kind can't be told from a Latin letter; they are mapped in
words that also hold Latin letters, and in words of such letters alone in a text with Latin
ones. Those of the second kind are only nearly the same (Greek alpha, small capitals) and are
mapped in the former words alone. A word with any other letter of another script is truly
written in it and stays. One pass goes through the clusters of a text; at each, the longest
path whose condition holds gives the output.

Signs with a look of their own (º ½ × … “ ” —), tabs and line breaks stay. Joiners and
variation selectors inside emoji belong to the emoji. Characters that stand in a run of
wrongly decoded bytes are garbled text, not look-alikes, and stay. Null gives null, an empty
text itself. The result of a result is itself. Texts are processed whole; extra columns and
repeated rows play no part. Rows without any mapped character never leave the JVM.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship

#: Letters of other scripts that can't be told from a Latin one.
ALIKE_LETTERS = {
    "АВЕЅІЈКМНОРСТУХҮӀԌԚԜѴ": "ABESIJKMHOPCTYXYIGQWV",  # Cyrillic
    "аеѕіјорсухһԁԛԝӏѵү": "aesijopcyxhdqwlvy",
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοϲϳ": "ABEZHIKMNOPTYXocj",  # Greek
    "ՕՍՏօոսհցզ": "OUSonuhgq",  # Armenian
    "ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᏃ": "ABCDEGHJKLMPRSTVWZ",  # Cherokee
    "ⲀⲂⲈⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲟⲥ": "ABEHIKMNOPCTYXoc",  # Coptic
    "ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ": "BPDTGKJCZFMNLSRVHWXYAEIOU",  # Lisu
}
#: Letters that are only nearly the same.
NEAR_LETTERS = {"αγηικνρτυχω": "aynikvptuxw", "кԍѡ": "kgw", "ɑɡɩʋ": "agiv"}
#: Signs that can't be told from an ASCII one.
SIGNS = {"‐": "-", "‑": "-", "ʹ": "'", "＾": "^"}
#: Compatibility forms that look like the plain text they stand for.
ALIKE = {"<wide>", "<narrow>", "<font>", "<noBreak>"}
#: Characters that show nothing without being format characters.
BLANK = "͏ᅟᅠ឴឵⠀ㅤﾠ"
MARKS = "̀-ͯ᪰-᫿᷀-᷿⃐-⃿︠-︯"


def _compatible(c: str) -> str | None:
    """The ASCII text that a compatibility form or a duplicate character looks like."""
    parts = unicodedata.decomposition(c).split()
    if not parts:
        return None
    plain = unicodedata.normalize("NFKC", c)
    if not plain.isascii():
        return None
    if parts[0] in ALIKE or not parts[0].startswith("<"):
        return plain
    if "ROMAN NUMERAL" in unicodedata.name(c, ""):
        return plain
    # ligatures of letters, but no digraphs with a look of their own
    return plain if parts[0] == "<compat>" and len(plain) > 1 and plain.isalpha() and unicodedata.name(c, "").startswith("LATIN SMALL LIGATURE") else None


#: Conditions of a leaf: none, a look-alike, a letter that is only nearly the same.
ALWAYS, ALIKE_LETTER, NEAR_LETTER = 0, 1, 2


def rules() -> Iterator[tuple[str, str, int]]:
    """Every character or sequence that is replaced, its replacement, and on what condition."""
    for code in range(0x80, sys.maxunicode + 1):
        c = chr(code)
        kind = unicodedata.category(c)
        if kind == "Zs":
            yield c, " ", ALWAYS
        elif kind == "Cf" or c in BLANK or 0xFE00 <= code <= 0xFE0F or 0xE0100 <= code <= 0xE01EF:
            yield c, "", ALWAYS
        elif kind not in ("Cs", "Co", "Cn") and (new := _compatible(c)) is not None and new != c:
            yield c, new, ALWAYS
        small = re.fullmatch("LATIN LETTER SMALL CAPITAL ([A-Z])", unicodedata.name(c, ""))
        if small:
            yield c, small[1].lower(), NEAR_LETTER
        # single letters with marks of their own
        pair = unicodedata.normalize("NFD", c)
        if code < 0x2000 and len(pair) > 1 and unicodedata.normalize("NFC", pair) == c and regex.match(f"^.[{MARKS}]+$", pair):
            yield pair, c, ALWAYS
    for code in [*range(1, 9), *range(14, 32), 127]:
        yield chr(code), "", ALWAYS
    for source, new in SIGNS.items():
        yield source, new, ALWAYS
    for table, condition in ((ALIKE_LETTERS, ALIKE_LETTER), (NEAR_LETTERS, NEAR_LETTER)):
        for sources, news in table.items():
            for source, new in zip(sources, news, strict=True):
                yield source, new, condition


def checked(found: Iterable[tuple[str, str, int]]) -> dict[str, tuple[str, int]]:
    """The rules as a table: none may contradict another, nor replace by what is itself replaced in any text."""
    table: dict[str, tuple[str, int]] = {}
    for source, new, condition in found:
        if table.setdefault(source, (new, condition)) != (new, condition):
            raise ValueError(f"{source!r} is mapped twice, to {table[source]!r} and {(new, condition)!r}")
    single = {k for k in table if len(k) == 1}
    for source, (new, _) in table.items():
        if single & set(new):
            raise ValueError(f"{source!r} maps to {new!r}, which is mapped again")
    return table


@cache
def mapping() -> dict[str, tuple[str, int]]:
    return checked(rules())


def _ranges(chars: set[str]) -> str:
    """The characters as the inside of a regular expression's class, for Java."""
    codes, out = sorted(map(ord, chars)), []
    start = last = codes[0]
    for code in [*codes[1:], sys.maxunicode + 2]:
        if code != last + 1:
            out.append(f"\\x{{{start:x}}}-\\x{{{last:x}}}" if last > start else f"\\x{{{start:x}}}")
            start = code
        last = code
    return "".join(out)


@cache
def suspects() -> str:
    """A pattern that any text to be changed matches."""
    singles = {k for k in mapping() if len(k) == 1}
    return f"[{_ranges(singles)}{MARKS}]"


@cache
def unusual() -> str:
    """A short pattern that any suspect matches as well: a character beyond the common ones that stay."""
    singles = {k for k in mapping() if len(k) == 1}
    common = {chr(c) for c in [9, 10, 13, *range(0x20, 0x180), *range(0x2010, 0x2028)]} - singles
    return f"[^{_ranges(common)}]"


def may_differ(text: Column) -> Column:
    """Whether a text holds a suspect. Few texts get past the first, cheap test."""
    return text.rlike(unusual()) & text.rlike(suspects())


class Transducer:
    """The compiled mapping: a trie of dictionaries, a leaf's output under the empty key."""

    #: Wrongly decoded UTF-8: a lead and its followers as common single-byte encodings show them.
    ENCODINGS = ("cp1252", "mac_roman", "cp850", "cp437", "cp1250")

    def __init__(self):
        self.root: dict = {}
        self.letters = {c: condition for c, (_, condition) in mapping().items() if condition}
        for source, leaf in mapping().items():
            node = self.root
            for c in source:
                node = node.setdefault(c, {})
            node[""] = leaf
        self.clusters = regex.compile(r"\X").findall
        # what shows nothing parts no word
        self.words = regex.compile(rf"[\p{{L}}\p{{M}}\p{{Nd}}\p{{Cf}}{BLANK}]+")
        always = "".join(c for c, (new, condition) in mapping().items() if len(c) == 1 and condition == ALWAYS and new.isalpha())
        self.latin = regex.compile(rf"[\p{{Latin}}--[\u0250-\U0010ffff]]|[{always}]", regex.V1)
        self.replaced = set(always)
        self.other = regex.compile(r"[\p{L}--[\p{Latin}--[\u0250-\U0010ffff]]]", regex.V1)
        # a digit, # or * is a picture only as a keycap
        self.pictures = regex.compile(r"[\p{Extended_Pictographic}\p{Emoji_Modifier}\p{Regional_Indicator}]|[0-9#*].*\u20e3", regex.S)
        self.runs = regex.compile(r"[^\x00-\x7f]+")
        self.bytes = [{(bytes([b]).decode(e, "ignore") or chr(b)): b for b in range(128, 256)} for e in self.ENCODINGS]
        self.marks = regex.compile(f"[{MARKS}]")

    def garbled_at(self, text: str) -> set[int]:
        """Places of characters that belong to wrongly decoded bytes."""
        out: set[int] = set()
        for m in self.runs.finditer(text):
            run = m.group()
            for table in self.bytes:
                for i in range(len(run) - 1):
                    for n in (2, 3):
                        piece = run[i : i + n]
                        if len(piece) == n and all(c in table for c in piece):
                            try:
                                c = bytes(table[c] for c in piece).decode("utf-8")
                            except UnicodeDecodeError:
                                continue
                            if len(c) == 1 and (ord(c) < 0x180 or 0x2000 <= ord(c) < 0x2700):
                                out.update(range(m.start() + i, m.start() + i + n))
        return out

    def _mapped_in(self, word: str, text_is_latin: bool) -> int:
        """The highest condition that holds in a word: 0 if it is truly written in another script."""
        kinds = {self.letters.get(c) for c in self.other.findall(word) if c not in self.replaced and c not in BLANK}
        if None in kinds:
            return 0
        return NEAR_LETTER if self.latin.search(word) else ALIKE_LETTER if text_is_latin and kinds == {ALIKE_LETTER} else 0

    def run(self, text: str) -> tuple[str, bool]:
        """The text in its one form, and whether a character was replaced."""
        out, changed, at = [], False, 0
        words, word, holds = self.words.finditer(text), None, 0
        text_is_latin: bool | None = None
        garbled: set[int] | None = None
        for cluster in self.clusters(text):
            picture = len(cluster) > 1 and self.pictures.match(cluster)
            i, n = 0, len(cluster)
            while i < n:
                node, j, best = self.root, i, None
                while j < n and cluster[j] in node:
                    node = node[cluster[j]]
                    j += 1
                    if "" in node:
                        best = (j, *node[""])
                if best and best[2]:
                    # the word that this letter stands in, and what holds in it
                    while word is None or word.end() <= at + i:
                        word = next(words)
                        holds = -1
                    if holds < 0:
                        text_is_latin = bool(self.latin.search(text)) if text_is_latin is None else text_is_latin
                        holds = self._mapped_in(word.group(), text_is_latin)
                    best = best if best[2] <= holds else None
                    if best:
                        out.append(best[1])
                        changed, i = True, best[0]
                        continue
                elif best and not (picture and best[1] == ""):
                    if garbled is None:
                        garbled = self.garbled_at(text)
                    if at + i not in garbled:
                        out.append(best[1])
                        changed, i = True, best[0]
                        continue
                elif self.marks.match(cluster[i]) and not picture:
                    changed = True  # a mark that no composed letter takes stays, after the letter
                out.append(cluster[i])
                i += 1
            at += n
        return (unicodedata.normalize("NFC", "".join(out)), True) if changed else (text, False)


@cache
def transducer() -> Transducer:
    return Transducer()


def changed_records(records: DataFrame, text_col: str, result: str = "form") -> DataFrame:
    """The records whose text isn't in its one form, with that form."""
    ship(records.sparkSession)
    kept = [c for c in records.columns if c != result]
    schema = ", ".join(f"`{c}` {records.schema[c].dataType.simpleString()}" for c in kept) + f", `{result}` string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer()
        for batch in batches:
            found = [(i, new) for i, text in enumerate(batch.column(kept.index(text_col)).to_pylist()) for new, hit in (t.run(text),) if hit]
            rows = batch.take(pa.array([i for i, _ in found], pa.int32()))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array([n for _, n in found], pa.string())], names=[*kept, result])

    return records.select(*[F.col(f"`{c}`") for c in kept]).filter(may_differ(F.col(f"`{text_col}`"))).mapInArrow(run, schema)


def one_form(records: DataFrame, text_col: str, result: str = "form") -> DataFrame:
    """All records with their text in one form: suspects go through the transducer, others straight on."""
    ship(records.sparkSession)
    kept = [c for c in records.columns if c != result]
    schema = ", ".join(f"`{c}` {records.schema[c].dataType.simpleString()}" for c in kept) + f", `{result}` string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer()
        for batch in batches:
            forms = [t.run(text)[0] for text in batch.column(kept.index(text_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(forms, pa.string())], names=[*kept, result])

    rows = records.select(*[F.col(f"`{c}`") for c in kept])
    suspect = F.coalesce(may_differ(F.col(f"`{text_col}`")), F.lit(False))
    return rows.filter(suspect).mapInArrow(run, schema).unionByName(rows.filter(~suspect).withColumn(result, F.col(f"`{text_col}`")))
