"""Rows that fail to parse, set apart with the reason while the valid rows are loaded.

A line holds five fields `table,key,source,row,count`. The structure (quotes, number of
fields) is checked once per line by splitting at the double quote: pieces with an even index
stand outside quotes, so all rules are statements about single pieces and no regular
expression has to recurse over a long text. The castable columns are checked by value:
each distinct value of a column is cast once, the invalid ones form a dictionary with
reasons, and the dictionary is joined back. Only invalid values and the ids of bad lines
are shuffled, never the lines.

Null lines and empty lines have no five fields: `column_count`. A line repeated under
another id is reported for each id. Extra columns of the input play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from ..session import stored

#: Separator put for a comma outside quotes; MARK in the data is doubled by an escape first.
MARK = "\u0001"
FIELDS = ("table_name", "entry_key", "source_text", "row_no", "occ_count")
#: Places of the fields that are cast, value by value.
CASTABLE = (0, 3, 4)
MAX_INT = 2147483647


def _piece_is_broken(piece: Column, i: Column, last: Column) -> Column:
    """Whether an outside piece breaks the rule that quotes enclose whole fields."""
    starts, ends = piece.startswith(","), piece.endswith(",")
    return (
        (i % 2 == 0)
        & (last > 0)
        & (piece != "")
        & F.when(i == 0, ~ends).when(i == last, ~starts).otherwise(~(starts & ends))
    )


def quoting_is_broken(line: Column) -> Column:
    """True if a double quote stands anywhere but around a whole field or doubled inside one."""
    return let(F.split(line, '"', -1), _quotes_are_broken)


def _quotes_are_broken(pieces: Column) -> Column:
    last = F.size(pieces) - 1
    broken = F.transform(pieces, lambda p, i: _piece_is_broken(p, i, last))
    return (last % 2 != 0) | F.exists(broken, lambda b: b)


def fields_of(line: Column) -> Column:
    """The unquoted fields of a line whose quoting is sound."""
    return let(F.split(line, '"', -1), _fields)


def _fields(pieces: Column) -> Column:
    last = F.size(pieces) - 1

    def piece(p: Column, i: Column) -> Column:
        kept = F.replace(p, F.lit(MARK), F.lit(MARK + "e"))
        outside = F.when((p == "") & (i > 0) & (i < last), F.lit('"')).otherwise(F.replace(kept, F.lit(","), F.lit(MARK + "f")))
        return F.when(i % 2 == 0, outside).otherwise(kept)

    joined = F.array_join(F.transform(pieces, piece), "")
    return F.transform(F.split(joined, MARK + "f", -1), lambda f: F.replace(f, F.lit(MARK + "e"), F.lit(MARK)))


def is_blank(value: Column) -> Column:
    return ~value.rlike(r"[^\s\p{Z}\p{C}]")


def parse_lines(raw: DataFrame, id_col: str = "line_id", line_col: str = "raw_line") -> DataFrame:
    """line_id, structural reason (null if sound) and fields of each line."""
    lines = raw.select(F.col(id_col).alias("line_id"), F.col(line_col).alias("_line"))
    broken = F.coalesce(quoting_is_broken(F.col("_line")), F.lit(False))
    cut = lines.select(
        "line_id",
        broken.alias("_broken"),
        F.when(~broken, fields_of(F.col("_line"))).alias("fields"),
    )
    blank_text = is_blank(F.col("fields")[1]) | is_blank(F.col("fields")[2])
    return cut.select(
        "line_id",
        "fields",
        F.when(F.col("_broken"), "bad_quoting")
        .when(F.col("fields").isNull() | (F.size("fields") != len(FIELDS)), "column_count")
        .when(blank_text, "invalid_value")
        .alias("structural"),
    )


def parsed_once(raw: DataFrame, id_col: str, line_col: str, whole: bool) -> DataFrame:
    """The parsed lines, written once for the passes that follow: the castable fields, and with `whole` the texts too."""
    parsed = parse_lines(raw, id_col, line_col)
    wanted = range(len(FIELDS)) if whole else CASTABLE
    sound = F.col("structural").isNull()
    return stored(parsed.select("line_id", "structural", *[F.when(sound, F.col("fields")[i]).alias(FIELDS[i]) for i in wanted]), "parsed")


def _castable(parsed: DataFrame) -> DataFrame:
    """One row for each line and castable column: line_id, col, value."""
    pairs = F.array(*[F.struct(F.lit(FIELDS[i]).alias("col"), F.col(FIELDS[i]).alias("value")) for i in CASTABLE])
    return (
        parsed.filter(F.col("structural").isNull())
        .select("line_id", F.explode(pairs).alias("p"))
        .select("line_id", "p.col", "p.value")
    )


def invalid_values(parsed: DataFrame, scan_tables: DataFrame) -> DataFrame:
    """The dictionary: each distinct invalid value of a column with its reason, cast once."""
    distinct = _castable(parsed).select("col", "value").distinct()
    known = scan_tables.select(F.col("table_name").alias("_known")).filter(F.col("_known").isNotNull()).distinct()
    digits = F.regexp_replace(F.col("value"), "^0+", "")
    number = F.when(F.length(digits) <= 10, F.expr("try_cast(regexp_replace(value, '^0+', '') as bigint)"))
    reason = (
        F.when((F.col("col") == FIELDS[0]) & F.col("_known").isNull(), "unknown_table")
        .when(F.col("col") == FIELDS[0], None)
        .when(~F.col("value").rlike("^[0-9]+$") | F.col("value").endswith("\n"), "not_a_whole_number")
        .when(number.isNull() | (number < 1) | (number > MAX_INT), "out_of_range")
    )
    joined = distinct.join(known, (F.col("col") == FIELDS[0]) & (F.col("value") == F.col("_known")), "left")
    return joined.select("col", "value", reason.alias("detail")).filter(F.col("detail").isNotNull())


def failures(raw: DataFrame, scan_tables: DataFrame, id_col: str = "line_id", line_col: str = "raw_line") -> DataFrame:
    """line_id, reason, detail: one row for each line that can't be loaded."""
    parsed = parsed_once(raw, id_col, line_col, whole=False)
    structural = parsed.filter(F.col("structural").isNotNull()).select(
        "line_id", F.col("structural").alias("reason"), F.lit(None).cast("string").alias("detail")
    )
    bad = _castable(parsed).join(invalid_values(parsed, scan_tables), ["col", "value"])
    by_value = bad.groupBy("line_id").agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(":", "col", "detail"))), ",").alias("detail"))
    return structural.unionByName(by_value.select("line_id", F.lit("invalid_value").alias("reason"), "detail"))


def loaded(raw: DataFrame, scan_tables: DataFrame, id_col: str = "line_id", line_col: str = "raw_line") -> DataFrame:
    """The valid lines as typed rows."""
    parsed = parsed_once(raw, id_col, line_col, whole=True)
    bad = _castable(parsed).join(invalid_values(parsed, scan_tables), ["col", "value"]).select("line_id").distinct()
    return (
        parsed.filter(F.col("structural").isNull())
        .join(bad, "line_id", "left_anti")
        .select("line_id", *FIELDS[:3], *[F.expr(f"try_cast({n} as int)").alias(n) for n in FIELDS[3:]])
    )
