import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from verbena.functions import text as T
from verbena.functions import tokens as K
from verbena.functions.udfs import context_windows, is_nfc, unescape_python

TEXTS = ["", "a", "a\\n", 'say "hi"\n', "tab\tcr\r", "\\", "\\\\n", "\\x", "ünï\\u00e9", "😀 |", "  pad  "]


def test_escape_round_trips(values):
    assert values(lambda t: T.unescape(T.escape_dump(t)), TEXTS) == TEXTS
    assert values(lambda t: T.decode_json_string(T.encode_json_string(t)), TEXTS) == TEXTS
    assert values(T.unescape, ["\\\\n", "\\q", "end\\", "\\n\\t\\r\\\"", None]) == ["\\n", "\\q", "end\\", "\n\t\r\"", None]
    assert values(T.decode_json_string, ["a\\u00e9", "bad \\q", "\\ud83d\\ude00"]) == ["aé", "bad \\q", "😀"]


def test_escape_properties(spark):
    found = []

    @settings(max_examples=200, deadline=None)
    @given(st.text(alphabet=st.characters(exclude_categories=["Cs"], exclude_characters="\0"), max_size=30))
    def collect(t):
        found.append(t)

    collect()
    df = spark.createDataFrame([(t,) for t in found], "t string")
    t = F.col("t")
    p = K.protect(t, K.MARKUP)
    bad = df.filter((T.unescape(T.escape_dump(t)) != t) | (K.restore(p, K.tokens_of(t, K.MARKUP), K.MARKUP) != t) | (F.concat(T.line_body(t), T.line_end(t)) != t))
    assert bad.collect() == []


@pytest.mark.parametrize(
    ("text", "blank", "usable", "translatable", "technical"),
    [
        (None, True, False, False, False), ("", True, False, False, True), (" ﻿", True, False, False, True), ("###", False, False, False, True), (" # ", False, False, False, True),
        ("...", False, True, False, True), ("Hello", False, True, True, False), ("-_-", False, True, False, True), ("GetQuest(1)", False, True, True, True), ("ABC_1", False, True, True, True), ("Olá você", False, True, True, False),
    ],
)
def test_predicates(values, text, blank, usable, translatable, technical):
    assert [values(f, [text])[0] for f in (T.is_blank, T.usable, T.translatable, T.technical)] == [blank, usable, translatable, technical]


def test_usable_without_strip(values):
    assert values(lambda t: T.usable(t, strip_first=False), [" # ", "##"]) == [True, False]


def test_encoding(values):
    assert values(T.repair_latin1, ["nÃ£o", "não", "ã", "Łódź", None]) == ["não", "não", "ã", "Łódź", None]
    assert values(T.normalize_punctuation, ["“a”—‘b’… "]) == ["\"a\"-'b'... "]
    assert values(T.normalize_punctuation, ["\u201ea\u201f \u201ab\u201b\u2013"]) == ["\"a\" 'b'-"]
    assert values(T.clean_for_dump, ["a\nb\t“c”\ufeff ", " x\u00a0"]) == ["ab\t\"c\" ", " x "]
    kinds = values(lambda t: F.array_join(F.transform(T.encoding_faults(t), lambda f: f["type"]), ","), ["a�", "a​", "a?b", "nÃ£o", "\\u00e3", "", "﷐", "\u0001", "fine?"])
    assert kinds == ["replacement_character", "format_or_invisible", "question_mark_inside_word", "common_mojibake", "literal_unicode_escape", "private_use", "unicode_noncharacter", "invalid_control", ""]
    assert values(T.code_points, ["aé😀"]) == ["U+0061 U+00E9 U+1F600"]
    assert values(lambda a, b: T.question_excess(a, b), ["a?", "a?"], ["b??", "b"]) == [1, 0]
    assert values(is_nfc, ["é", "é", None]) == [True, False, None]
    assert values(unescape_python, ["n\\u00e3o", "\\x41\\101", "bad \\N{x", None]) == ["não", "AA", "bad \\N{x", None]
    assert values(context_windows("X", 2), ["aaXbb\n", "none"]) == [["aaXbb"], []]


def test_tokens(values):
    text = 'a [lua(f(x))] [em1]b[/em1] <i>c</i> {0} %s \\n'
    assert values(T.technical_tokens, [text, None]) == [["[lua(f(x))]", "[em1]", "[/em1]", "<i>", "</i>", "{0}", "%s", "\\n"], []]
    assert values(T.strip_technical, ["[lua(a(b))]x[em2]y<b>{z}"]) == [" x y  "]
    assert values(lambda a, b: T.missing_tokens(a, a, b), ["{0} {1} {0}"], ["{0}"]) == [["{1}"]]
    for style in (K.BRACKETS, K.MARKUP, K.LAUNCHER):
        many = " ".join(f"{{{i}}}" for i in range(12))
        assert values(lambda t, s=None: K.restore(K.protect(t, style), K.tokens_of(t, style), style), [many]) == [many]
    assert values(lambda t: K.protect(t, K.SNAKE), ["(snake_case) a_b"]) == ["SNAKETOKEN0END aSNAKETOKEN1ENDb"]
    mixed = "[name] a\r\n(word) (Word) <x y>{0}\n\\n [lua(f(x)]y)]"
    assert values(lambda t: K.tokens_of(t, K.MARKUP), [mixed]) == [["[name]", "\r\n", "<x y>", "{0}", "\n", "[lua(f(x)]"]]
    assert values(lambda t: K.tokens_of(t, K.LAUNCHER), [mixed]) == values(lambda t: K.tokens_of(t, K.MARKUP), [mixed])
    assert values(lambda t: K.tokens_of(t, K.SNAKE), [mixed]) == [["[name]", "\r\n", "(word)", "<x y>", "{0}", "\n", "[lua(f(x)]"]]
    assert values(lambda t: K.tokens_of(t, K.BRACKETS), ["[] (a) {\n} <b>"]) == [["[]", "(a)", "<b>"]]
    assert values(lambda t: K.protect(t, K.MARKUP.marked("__OWN_", "__")), ["a {x}"]) == ["a __OWN_0__"]
    assert values(lambda a, b: K.lost(b, K.tokens_of(a, K.MARKUP), K.MARKUP), ["{0} {1}"], ["__MARK_1__"]) == [["{0}"]]


def test_words_and_names(values):
    assert values(T.words, ["Don't [em1]Stop[/em1] já"]) == [["don't", "stop", "já"]]
    assert values(lambda t: T.has_name(t, "Roy"), ["Roy!", "Royal", "éRoy", None]) == [True, False, False, False]
    assert values(lambda t: T.has_displayed_name(t, "Roy"), ["Roy", "Roy2", "Roy_"]) == [True, False, False]
    assert values(lambda t: T.names_in(t, ["Roy", "Ana", "A B"]), ["Roy, Roy e A B", "Royal", None]) == [["Roy", "A B"], [], []]
    assert values(lambda t: T.replace_word(t, "obrigado", "obrigada"), ["Obrigado OBRIGADO obrigado obrigados"]) == ["Obrigada OBRIGADA obrigada obrigados"]
    assert values(lambda t: T.flex_gender(t, "feminino"), ["Estou cansado e pronto."]) == ["Estou cansada e pronta."]
    assert values(lambda t: T.speaks_as(t, "masculino"), ["Eu estou muito cansado", "Obrigado!", "cansado"]) == [True, True, False]
    assert values(lambda t: T.speaks_to(t, "feminino"), ["Você está pronta?", "Fique pronta", "bem-vinda", "pronta"]) == [True, True, True, False]
    assert values(lambda a, b: T.gender_swapped(a, b), ["obrigado", "perdida", "x"], ["obrigada", "perdido", "obrigada"]) == ["masculine_became_feminine", "feminine_became_masculine", None]


def test_spaces_and_keys(values):
    assert values(T.squeeze, ["  a \n b "]) == ["a b"]
    assert values(T.comparable_key, ["a\\\\u00a0b\\nc", "a b\nc"]) == ["a b\nc", "a b\nc"]
    assert values(T.variants, ["nÃ£o…", "“nÃ£o”", "itâ\x80\x99s"]) == [["nÃ£o…", "nÃ£o..."], ["“nÃ£o”", '"nÃ£o"'], ["itâ\x80\x99s", "it’s", "it's"]]
    assert values(T.sentences, ["A. B? C"]) == [["A.", "B?", "C"]]
    assert values(lambda t: F.concat_ws("|", *T.outer_space(t)), [" \na b "]) == [" \n|a b| "]
    assert values(T.csv_cell, ["", "a\"b", None]) == ["", '"a""b"', ""]
    assert values(T.escape_markdown, ["a|b\r\nc"]) == ["a\\|b`\\r`<br>c"]


def test_lone_surrogates(values):
    raw = ["\\ud83d\\ude00", "\\ud83d x", "x\\uDE00", "\\\\ud83d", "\\\\\\ud83d", "\\ud83d\\ud83d\\ude00", "plain", None]
    assert values(T.lone_surrogates, raw) == [[], ["\\ud83d"], ["\\uDE00"], [], ["\\ud83d"], ["\\ud83d"], [], []]


def test_rule_patterns_keep_classes_by_property():
    assert T.regex(r"\bI\S+\W\p{Lu}X") == T.ASCII_BORDER + r"i\S+\W\p{Lu}x"
