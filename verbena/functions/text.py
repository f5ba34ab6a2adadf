"""Functions of text as column expressions; all of them stay in the JVM.

White space is one class throughout: ASCII white space, no-break and other Unicode spaces,
NEL, line and paragraph separators and the byte order mark. A null text gives null, but for
the predicates, which give false.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon

WS = r"[\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]"
#: A word's border that knows ASCII letters only, in small letters.
ASCII_BORDER = r"(?:(?<![a-z0-9_])(?=[a-z0-9_])|(?<=[a-z0-9_])(?![a-z0-9_]))"
LUA = r"\[lua\((?:[^()]|\([^()]*\))*\)\]"
EM = r"\[/?em\d+\]"
TAG = r"</?[^>]+>"
BRACES = r"\{[^}]+\}"
#: What counts as a technical token.
TECHNICAL_TOKEN = r"\[lua\(.*?\)\]|\[/?em\d*\]|<[^<>]+>|\{[^{}]+\}|%[sdif]|\\n|\\r"
WORD = r"\p{L}+(?:['\u2019]\p{L}+)?"
CJK = r"[\u3400-\u4DBF\u4E00-\u9FFF\u3040-\u30FF\uAC00-\uD7AF]"


def regex(pattern: str) -> str:
    """A rule's pattern for text in small letters, which is much faster than folding case at each place.

    \\b is a border that knows ASCII letters only. Letters of the pattern become small, but for
    those of a character class by property.
    """
    small = re.sub(r"\\p\{\w+\}|\\.|.", lambda m: m.group() if len(m.group()) > 1 else m.group().lower(), pattern)
    return small.replace(r"\b", ASCII_BORDER)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often the body uses it.

    Catalyst puts an aliased expression into each of its uses; a lambda's variable it leaves alone.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def quote(literal: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()*+?^$|" else c for c in literal)


# White space and predicates


def ws_trim(text: Column) -> Column:
    return F.regexp_replace(text, f"^{WS}+|{WS}+$", "")


def is_blank(text: Column) -> Column:
    return F.coalesce(ws_trim(text) == "", F.lit(True))


def squeeze(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return ws_trim(F.regexp_replace(text, f"{WS}+", " "))


def usable(target: Column, strip_first: bool = True) -> Column:
    """Not blank and not made of number signs alone; without strip_first a blank beside them is enough."""
    tested = ws_trim(target) if strip_first else target
    return F.coalesce(~is_blank(target) & tested.rlike("[^#]"), F.lit(False))


def translatable(text: Column) -> Column:
    return F.coalesce(text.rlike("[A-Za-z]") & ~ws_trim(text).rlike(r"^[-._\s]+$"), F.lit(False))


def technical(text: Column) -> Column:
    """No word of two ASCII letters, the name of a command, or an identifier in capitals."""
    t = ws_trim(text)
    # fixed values: what a command starts with
    commands = r"(?i)^(?:GetQuest|SetQuest|SendMessage|SetFace|Variable|Actor|Conversation|Sequencer|Lua|\[lua|\{|\()"
    return F.coalesce(~t.rlike("[A-Za-z]{2}") | t.rlike(commands) | t.rlike("^[_A-Z0-9.:-]+$"), F.lit(False))


def has_cjk(text: Column) -> Column:
    return F.coalesce(text.rlike(CJK), F.lit(False))


def passes_through(text: Column) -> Column:
    return F.coalesce(ws_trim(text).isin(*lexicon.PASS_THROUGH), F.lit(False))


def importable(asset_name: Column) -> Column:
    return F.coalesce(~F.lower(asset_name).startswith("base-"), F.lit(False))


def replacement_fault(source: Column, target: Column) -> Column:
    """Why a target may not replace anything: the first reason that holds, null if none does."""
    return (
        F.when(target.isNull(), "null")
        .when(is_blank(target), "blank")
        .when(has_cjk(target), "cjk")
        .when(ws_trim(target) == ws_trim(source), "equal_to_source")
    )


# Escapes


def decode_json_string(raw: Column) -> Column:
    """What a JSON string body stands for; the body itself where it is none."""
    return F.coalesce(F.from_json(F.concat(F.lit('{"v":"'), raw, F.lit('"}')), "v string").getField("v"), raw)


def encode_json_string(text: Column) -> Column:
    body = F.to_json(F.struct(text.alias("v")))
    return F.when(text.isNotNull(), F.substr(body, F.lit(7), F.length(body) - 8))


def escape_controls(text: Column) -> Column:
    out = text
    for c, e in (("\r", "\\r"), ("\n", "\\n"), ("\t", "\\t")):
        out = F.replace(out, F.lit(c), F.lit(e))
    return out


def escape_dump(text: Column) -> Column:
    return escape_controls(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')))


def unescape(text: Column) -> Column:
    """One pass over \\n \\r \\t \\\\ \\"; other escapes and a last backslash stay."""
    parts = F.regexp_extract_all(text, F.lit(r"((?s)\\.|[^\\]+|\\)"), F.lit(1))
    known = F.create_map(*[F.lit(x) for x in ("\\n", "\n", "\\r", "\r", "\\t", "\t", "\\\\", "\\", '\\"', '"')])
    return F.array_join(F.transform(parts, lambda p: F.coalesce(F.try_element_at(known, p), p)), "")


def escape_markdown(text: Column) -> Column:
    out = F.replace(text, F.lit("|"), F.lit("\\|"))
    return F.replace(F.replace(out, F.lit("\r"), F.lit("`\\r`")), F.lit("\n"), F.lit("<br>"))


def csv_cell(text: Column) -> Column:
    """Quoted, unless empty; quotes doubled."""
    return F.when(F.coalesce(text, F.lit("")) == "", "").otherwise(F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"')))


# Encoding


def repair_latin1(text: Column) -> Column:
    """UTF-8 that was read as Latin-1, put right; any other text as it is."""
    data = F.when(text.rlike(r"^[\x{00}-\x{FF}]*$"), F.encode(text, "ISO-8859-1"))
    return F.when(F.is_valid_utf8(data.cast("string")), data.cast("string")).otherwise(text)


def repair_guarded(text: Column) -> Column:
    """repair_latin1, unless it makes more replacement characters."""
    new = repair_latin1(text)
    return F.when(F.regexp_count(new, F.lit("\ufffd")) > F.regexp_count(text, F.lit("\ufffd")), text).otherwise(new)


#: Typographic signs and the plain ones put in their place.
PUNCTUATION = {
    "\u2018": "'", "\u2019": "'", "\u201a": "'", "\u201b": "'", "\u201c": '"', "\u201d": '"', "\u201e": '"', "\u201f": '"',
    "\u2013": "-", "\u2014": "-", "\u2026": "...", "\u00a0": " ",
}


def normalize_punctuation(text: Column) -> Column:
    single = {k: v for k, v in PUNCTUATION.items() if len(v) == 1}
    out = F.translate(text, "".join(single), "".join(single.values()))
    for sign in PUNCTUATION.keys() - single.keys():
        out = F.replace(out, F.lit(sign), F.lit(PUNCTUATION[sign]))
    return out


def clean_for_dump(text: Column) -> Column:
    """Plain quotes and spaces, no byte order mark; control characters but tabs go, line breaks with them. Outer blanks stay."""
    plain = F.translate(text, "\u2018\u2019\u201c\u201d\u00a0\ufeff", "''\"\" ")
    return F.regexp_replace(plain, r"[\x00-\x08\x0A-\x1F]", "")


#: What the encoding audit looks for.
ENCODING_FAULTS = {
    "replacement_character": r"\x{FFFD}",
    "format_or_invisible": r"[\x{00AD}\x{061C}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{FEFF}]",
    "question_mark_inside_word": r"\p{L}\?+\p{L}|\?+\p{Ll}",
    "common_mojibake": r"\x{C3}[\x{80}-\x{BF}]|\x{C2}[\x{80}-\x{BF}]|\x{E2}[\x{80}-\x{BF}\x{20AC}\x{2122}\x{201A}\x{0192}\x{201E}\x{2026}\x{2020}\x{2021}\x{02C6}\x{2030}\x{0160}\x{2039}\x{0152}\x{017D}\x{2018}\x{2019}\x{201C}\x{201D}\x{2022}\x{2013}\x{2014}\x{02DC}\x{0161}\x{203A}\x{0153}\x{017E}\x{0178}]|\x{F0}\x{0178}|\x{EF}\x{BB}\x{BF}",
    "literal_unicode_escape": r"\\(?:u[0-9a-fA-F]{4}|x[0-9a-fA-F]{2})",
    "private_use": r"[\x{E000}-\x{F8FF}\x{F0000}-\x{FFFFD}\x{100000}-\x{10FFFD}]",
    "unicode_noncharacter": r"[\x{FDD0}-\x{FDEF}" + "".join(f"\\x{{{p:X}FFFE}}\\x{{{p:X}FFFF}}" if p else r"\x{FFFE}\x{FFFF}" for p in range(17)) + "]",
    "invalid_control": r"[\x{00}-\x{08}\x{0B}\x{0C}\x{0E}-\x{1F}\x{7F}-\x{9F}]",
}


def encoding_faults(text: Column) -> Column:
    """An array of (type, match) over all detectors."""

    def found(kind: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), lambda m: F.struct(F.lit(kind).alias("type"), m.alias("match")))

    return F.flatten(F.array(*[found(kind, pattern) for kind, pattern in ENCODING_FAULTS.items()]))


def lone_surrogates(raw: Column) -> Column:
    """Written-out surrogates without their other half in raw JSON text; a decoded string can't hold them."""
    high, low = r"\\u[dD][89abAB][0-9a-fA-F]{2}", r"\\u[dD][c-fC-F][0-9a-fA-F]{2}"
    alone = rf"(?<!\\)(?:\\\\)*({high}(?!{low})|(?<!{high}){low})"
    return F.coalesce(F.regexp_extract_all(raw, F.lit(alone), F.lit(1)), F.array().cast("array<string>"))


def code_points(text: Column) -> Column:
    """The code points of a text as U+XXXX, with spaces between them."""
    units = F.transform(F.split(text, ""), lambda c: F.concat(F.lit("U+"), F.lpad(F.hex(F.ascii(c)), F.greatest(F.length(F.hex(F.ascii(c))), F.lit(4)), "0")))
    return F.array_join(units, " ")


def question_excess(source: Column, target: Column) -> Column:
    """How many more question marks the target has than the source, at least 0."""
    return F.greatest(F.regexp_count(target, F.lit(r"\?")) - F.regexp_count(source, F.lit(r"\?")), F.lit(0))


# Tokens and words


def strip_technical(text: Column) -> Column:
    out = text
    for pattern in (LUA, EM, TAG, BRACES):
        out = F.regexp_replace(out, pattern, " ")
    return out


def strip_for_names(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, BRACES, " "), LUA, " ")


def technical_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"({TECHNICAL_TOKEN})"), F.lit(1)), F.array().cast("array<string>"))


def missing_tokens(source: Column, old: Column, new: Column) -> Column:
    """Tokens of source and old target that the new target doesn't contain, each once, in order."""
    expected = F.array_distinct(F.concat(technical_tokens(source), technical_tokens(old)))
    return F.filter(expected, lambda t: ~F.contains(F.coalesce(new, F.lit("")), t))


def token_signature(text: Column) -> Column:
    """Markup, tags and written-out returns in order, as one list that two sides must share."""
    classes = (r"\[(?:/?em\d+|lua\([^\]]+\))\]", r"</?[A-Za-z][^>]*>", r"\\r")
    return F.concat(*[F.coalesce(F.regexp_extract_all(text, F.lit(f"({c})"), F.lit(1)), F.array().cast("array<string>")) for c in classes])


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(strip_technical(text)), F.lit(f"({WORD})"), F.lit(1))


def lexicon_hits(text: Column, entries: list[str]) -> Column:
    return F.array_intersect(F.array_distinct(words(text)), F.array(*map(F.lit, entries)))


def has_name(text: Column, name: str, ignore_case: bool = False) -> Column:
    return F.coalesce(text.rlike(f"{'(?iu)' if ignore_case else ''}(?<!\\p{{L}}){quote(name)}(?!\\p{{L}})"), F.lit(False))


def has_displayed_name(text: Column, name: str) -> Column:
    return F.coalesce(text.rlike(f"(?<![\\p{{L}}\\p{{N}}_]){quote(name)}(?![\\p{{L}}\\p{{N}}_])"), F.lit(False))


def names_in(text: Column, names: list[str]) -> Column:
    """The names that stand in a text as words, each once: one pass over its words, not one per name."""
    runs = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(\p{L}+)"), F.lit(1)))
    single = [n for n in names if n.isalpha()]
    found = F.array_intersect(runs, F.array(*map(F.lit, single))) if single else F.array().cast("array<string>")
    others = [F.when(has_name(text, n), F.lit(n)) for n in names if not n.isalpha()]
    return F.coalesce(F.array_compact(F.concat(found, F.array(*others))) if others else found, F.array().cast("array<string>"))


def replace_word(text: Column, old: str, new: str) -> Column:
    """A word replaced in its own letter case: capitals, first capital, else small."""

    def pattern(w: str) -> str:
        return f"(?<!\\p{{L}}){w}(?!\\p{{L}})"

    out = F.regexp_replace(text, pattern(old.upper()), new.upper())
    out = F.regexp_replace(out, "(?u)" + pattern(old[0].upper() + "(?i:" + old[1:] + ")"), new[0].upper() + new[1:])
    return F.regexp_replace(out, "(?iu)" + pattern(old), new)


def flex_gender(text: Column, gender: str) -> Column:
    out = text
    for masculine, feminine in lexicon.GENDER_PAIRS:
        out = replace_word(out, masculine, feminine) if gender == "feminino" else replace_word(out, feminine, masculine)
    return out


def _markers(gender: str) -> str:
    return "|".join(pair[gender == "feminino"] for pair in lexicon.GENDER_PAIRS if pair[0] != "obrigado")


def speaks_as(text: Column, gender: str) -> Column:
    """The text's first person is marked with a gender."""
    # fixed values: the frames that show a person's gender
    copula = rf"(?iu)(?<!\p{{L}})(?:eu\s+)?(?:estou|sou|fiquei|me sinto|continuo|ficarei|estarei)\s+(?:muito\s+|bem\s+|realmente\s+|tão\s+)?(?:{_markers(gender)})(?!\p{{L}})"
    thanks = rf"(?iu)(?<!\p{{L}})obrigad{'a' if gender == 'feminino' else 'o'}(?!\p{{L}})"
    return F.coalesce(text.rlike(copula) | text.rlike(thanks), F.lit(False))


def speaks_to(text: Column, gender: str) -> Column:
    """The person addressed is marked with a gender."""
    end = "a" if gender == "feminino" else "o"
    # fixed values: the frames that show the gender of the person addressed
    you = rf"(?iu)(?<!\p{{L}})você\s+(?:está|é|ficou|parece|anda|continua)\s+(?:muito\s+|bem\s+|realmente\s+|tão\s+)?(?:{_markers(gender)})(?!\p{{L}})"
    order = rf"(?iu)(?:^|[.!?]\s+)(?:esteja|fique|seja)\s+(?:muito\s+|bem\s+)?(?:{_markers(gender)})(?!\p{{L}})"
    welcome = rf"(?iu)(?<!\p{{L}})bem-vind{end}(?!\p{{L}})"
    return F.coalesce(text.rlike(you) | text.rlike(order) | text.rlike(welcome), F.lit(False))


def guarded_forms(text: Column, gender: str) -> Column:
    """The guarded forms of a gender that stand in a text."""
    forms = F.array(*[F.lit(pair[gender == "feminino"]) for pair in lexicon.GUARDED_GENDER])
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))
    return F.coalesce(F.array_intersect(forms, runs), F.array().cast("array<string>"))


def gender_swapped(old: Column, new: Column) -> Column:
    """Why a new text swaps the speaker's gender; null if it doesn't."""
    turned = lambda a, b: (F.size(guarded_forms(old, a)) > 0) & (F.size(guarded_forms(new, b)) > 0)
    return F.when(turned("masculino", "feminino"), "masculine_became_feminine").when(turned("feminino", "masculino"), "feminine_became_masculine")


def comparable_key(text: Column, double_escapes: bool = True) -> Column:
    """Written-out no-break spaces and line breaks as the characters themselves; no-break spaces as spaces."""
    out = text
    for written, real in (("u00a0", "\u00a0"), ("r", "\r"), ("n", "\n")):
        if double_escapes:
            out = F.replace(out, F.lit("\\\\" + written), F.lit(real))
        out = F.replace(out, F.lit("\\" + written), F.lit(real))
        if written == "u00a0":
            out = F.replace(out, F.lit("\u00a0"), F.lit(" "))
    return out


def variants(text: Column) -> Column:
    """The text, with plain punctuation, repaired, and repaired with plain punctuation; each once, in this order."""
    repaired = repair_guarded(text)
    return F.array_distinct(F.array(text, normalize_punctuation(text), repaired, normalize_punctuation(repaired)))


def sentences(text: Column) -> Column:
    return F.split(text, r"(?<=[.!?])\s+")


def line_body(line: Column) -> Column:
    return F.regexp_extract(line, r"(?s)^(.*?)(\r\n|\n|\r)?\z", 1)


def line_end(line: Column) -> Column:
    return F.regexp_extract(line, r"(?s)(\r\n|\n|\r)?\z", 1)


def outer_space(text: Column) -> tuple[Column, Column, Column]:
    """White space before, the core, white space after."""
    whole = rf"(?s)^({WS}*)(.*?)({WS}*)$"
    return tuple(F.regexp_extract(text, whole, i) for i in (1, 2, 3))
