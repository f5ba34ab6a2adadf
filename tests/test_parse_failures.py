import re

from verbena.operators import parse_failures as pf

TABLES = ["Menu Texts", "Fair Texts"]
FIELD = r'(?:"(?:[^"]|"")*"|[^",]*)'
LINES = [
    "Menu Texts,k,Hello,1,2", '"Menu Texts","k","Hello, you","1","2"', 'Menu Texts,k,"a ""b"" c",1,2', 'Menu Texts,k,"line\nbreak",1,2', 'Menu Texts,k,"""",1,2',
    'Menu Texts,k,a "b" c,1,2', 'Menu Texts,k,"a" x,1,2', 'Menu Texts,k, "a",1,2', 'Menu Texts,k,"a,1,2', 'Menu Texts,k,a",1,2', 'Menu Texts,k,"a\\"b",1,2', '""x,k,s,1,2',
    "Menu Texts,k,s,1", "Menu Texts,k,s,1,2,3", "", None, ",,,,", "Menu Texts;k;s;1;2",
    "Menu texts,k,s,1,2", " Menu Texts,k,s,1,2", "Menu Texts,,s,1,2", 'Menu Texts,k,"",1,2', "Menu Texts,k, ,1,2", "Menu Texts,k,s,0,2", "Menu Texts,k,s,1,2147483648", "Menu Texts,k,s,1,2147483647",
    "Menu Texts,k,s,007,2", "Menu Texts,k,s,1.0,2", "Menu Texts,k,s,-1,2", "Menu Texts,k,s,1,2\n", "Menu Texts,k,s,٣,2", "Menu Texts,k,s,99999999999999999999999,2", "Menu Texts,k,s\u0001f,1,2",
    'Menu Texts,k,"' + 'x ""y"" ' * 20_000 + '",1,2', "Menu Texts,k," + "w " * 50_000 + ",1,2", "Menu Texts,k," + '"' * 9999 + ",1,2",
]


def brute(line):
    if line is None:
        return "column_count"
    fields, i, ok = [], 0, True
    while True:
        m = re.compile(r'"(?:[^"]|"")*"(?=,|\Z)|[^",]*(?=,|\Z)').match(line, i)
        if not m:
            return "bad_quoting"
        f = m.group()
        fields.append(f[1:-1].replace('""', '"') if f.startswith('"') else f)
        if m.end() == len(line):
            break
        i = m.end() + 1
    if len(fields) != 5:
        return "column_count"
    number = lambda x: re.fullmatch("[0-9]+", x) and 1 <= int(x) <= 2147483647
    ok = fields[0] in TABLES and fields[1].strip() and fields[2].strip() and number(fields[3]) and number(fields[4])
    return None if ok else "invalid_value"


def frames(spark, lines):
    raw = spark.createDataFrame([(i, x, "z", 1) for i, x in enumerate(lines)], "line_id long, raw_line string, value string, col int")
    return raw, spark.createDataFrame([(t, 1) for t in TABLES], "table_name string, path_id long")


def test_reasons_against_brute_force(spark):
    raw, tables = frames(spark, LINES)
    got = {r.line_id: r.reason for r in pf.failures(raw, tables).collect()}
    want = {i: brute(x) for i, x in enumerate(LINES) if brute(x)}
    assert got == want


def test_loaded(spark):
    raw, tables = frames(spark, LINES)
    rows = {r.line_id: r for r in pf.loaded(raw, tables).collect()}
    assert set(rows) == {i for i, x in enumerate(LINES) if brute(x) is None}
    assert rows[2].source_text == 'a "b" c' and rows[3].source_text == "line\nbreak" and rows[4].source_text == '"'
    assert rows[25].occ_count == 2147483647 and rows[26].row_no == 7 and rows[32].source_text == "s\u0001f"


def test_repeated_and_empty(spark):
    raw, tables = frames(spark, ["Menu Texts,k,s,0,2"] * 300 + ["Menu Texts,k,s,1,2"] * 100)
    assert pf.failures(raw, tables).count() == 300 and pf.loaded(raw, tables).count() == 100
    assert pf.failures(raw.limit(0), tables).count() == 0
    assert pf.failures(raw, tables.limit(0)).count() == 400
