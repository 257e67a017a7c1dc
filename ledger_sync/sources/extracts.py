"""Landing of user and transaction extracts.

CSV files and JSON lines land as text, other sources in their own types, with lowercase names plus

* ``_file, _block, _row``: the position in file order. The id rises within one
  split, and (path, offset) orders the splits, so the triple does not depend on
  how splits are packed into tasks.
* ``reject_reason, reject_record``: set for rows that cannot be a record at all.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamReader

from ledger_sync.functions.parsing import form_of, null_if_token
from ledger_sync.schemas import BLOCK, DATE_FORM, FILE, FILE_ORDER, RECORD, REASON, ROW

FILE_FORMATS = ("csv", "json")
_RAW, _MORE = "_raw", "_more"
# A quoted field that does not end on its line.
_OPEN_QUOTE = r'(?:^|,)"(?:[^"]|"")*$'


def read_csv_extract(
    spark: SparkSession, path: str | list[str], columns: Sequence[str], multiline: bool = False
) -> DataFrame:
    """Land a CSV extract whose files have one header, in any order and letter case.

    ``multiline`` accepts line breaks inside quotes, but then a file is not split. Unlike
    ``csv_extract``, this does not look through the text first: a file with another header fails.
    """
    header = [c.lower() for c in spark.read.option("header", True).csv(path).columns]
    _require(header, columns)
    reader = spark.read.schema(_text_schema(header)).options(**_csv_options(multiline))
    return place(_flag_rows(locate(reader.csv(path)), len(header), columns))


@dataclass(frozen=True)
class Extract:
    """The files of a CSV extract, each with its own header in lowercase.

    line_breaks  quoted text goes on in another line somewhere, as only ``multiline`` can read it."""

    spark: SparkSession
    columns: tuple[str, ...]
    headers: dict[str, tuple[str, ...]]
    line_breaks: bool

    def rows(self, multiline: bool | None = None) -> DataFrame:
        """Land all files. Those with the same header are one read. Where line breaks are there but not
        to be read, a row with a quote that stays open is rejected."""
        parts = [self._read(h, sorted(paths), multiline) for h, paths in sorted(self._alike().items())]
        if not parts:
            none = self.spark.createDataFrame([], _text_schema(self.columns))
            parts = [none.select(*self.columns, *_no_place())]
        landed = parts[0]
        for part in parts[1:]:
            landed = landed.unionByName(part)
        return place(landed)

    def date_form(self, multiline: bool | None = None) -> str:
        """The form of the first date, by file name: as a rule a read of one file's first block."""
        for path in sorted(self.headers):
            dates = self._read(self.headers[path], [path], multiline, ("date",))
            row = dates.select(null_if_token(F.col("date")).alias("date")).dropna().first()
            if row is not None:
                return form_of(row["date"])
        return DATE_FORM

    def _alike(self) -> dict[tuple[str, ...], list[str]]:
        found: dict[tuple[str, ...], list[str]] = {}
        for path, header in self.headers.items():
            found.setdefault(header, []).append(path)
        return found

    def _read(
        self, header: tuple[str, ...], paths: list[str], multiline: bool | None, columns: Sequence[str] = ()
    ) -> DataFrame:
        multiline = self.line_breaks if multiline is None else multiline
        options, may_be_cut = _csv_options(multiline), self.line_breaks and not multiline
        if may_be_cut:  # with a field more than there is, Spark keeps the raw line of whole rows, too
            header, options = (*header, _MORE), options | {"enforceSchema": True}
        reader = self.spark.read.schema(_text_schema(header)).options(**options)
        return _flag_rows(locate(reader.csv(paths)), len(header), columns or self.columns, may_be_cut)


def csv_extract(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> Extract:
    """An extract whose files may each have their header in any order and letter case. Its text is
    looked through once, for the headers and for quotes that stay open."""
    found = extract_of(text_lines(spark.read, path), columns)
    if not found.headers:
        raise ValueError(f"extract has no column {', '.join(columns)}; it has no line")
    return found


def text_lines(reader: DataFrameReader | DataStreamReader, path: str | list[str]) -> DataFrame:
    """The lines of text files and where they come from, in a batch or on a stream."""
    return locate(reader.text(path)).select("value", FILE, BLOCK)


def extract_of(lines: DataFrame, columns: Sequence[str]) -> Extract:
    """What ``text_lines`` tell of their files; files without a line are left out.

    A header is the first line that names all ``columns``; if other lines come before, reading the
    file fails. One row for each file leaves the last task.
    """
    value, spark = F.col("value"), lines.sparkSession
    fields = F.split(F.lower(F.replace(value, F.lit('"'), F.lit(""))), ",")
    is_header = F.size(F.array_except(F.array(*map(F.lit, columns)), F.transform(fields, F.trim))) == 0
    # Grouped by the line as well, if it is a header: fixed-size sums, which need no sort of the lines.
    seen = place(lines.where(F.trim(value) != "")).groupBy(
        FILE, F.when(F.contains(F.lower(value), F.lit(columns[0])) & is_header, value).alias("line")
    )
    seen = seen.agg(F.max(_is_open(value)).alias("open"), F.min(BLOCK).alias(BLOCK), F.min(ROW).alias(ROW))
    first = F.min(F.when(F.col("line").isNotNull(), F.struct(BLOCK, ROW, "line")))
    files = seen.groupBy(FILE).agg(F.max("open").alias("open"), first.alias("first")).collect()
    headers = {}
    for row in files:
        header = next(csv.reader([row["first"]["line"]])) if row["first"] else []
        headers[unquote(row[FILE])] = tuple(name.strip().lower() for name in header)
        _require(headers[unquote(row[FILE])], columns, unquote(row[FILE]))
    return Extract(spark, tuple(columns), headers, any(row["open"] for row in files))


def read_json_extract(
    spark: SparkSession, path: str | list[str], columns: Sequence[str]
) -> DataFrame:
    """Land files with one JSON object a line, as an API sends them."""
    return json_rows(text_lines(spark.read, path), columns)


def json_rows(lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The records of ``text_lines`` that are JSON objects, in a batch or a micro-batch.

    Keys come in any order and letter case (of several that differ in case only, the first counts),
    and further ones are left out; a key that is not there is null. Numbers land as text, so they are
    read like those of a CSV extract. Blank lines are no records; other lines are rejected ones.
    """
    fields = F.map_entries(F.from_json("value", "map<string,string>"))
    parsed = lines.where(F.trim("value") != "").withColumn("_fields", fields)

    def value_of(name: str) -> Column:
        mine = F.filter("_fields", lambda field: F.lower(field["key"]) == name)
        return F.get(mine, F.lit(0))["value"]

    is_bad = F.col("_fields").isNull()
    return place(
        parsed.select(
            *[value_of(c).alias(c) for c in columns],
            FILE,
            BLOCK,
            F.when(is_bad, F.lit("no JSON object")).alias(REASON),
            F.when(is_bad, F.col("value")).alias(RECORD),
        )
    )


def land_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Land rows of any other source (a JDBC table, JSON of an API) that Spark can load.

    Columns keep their types; text goes the way of CSV text later on. Such rows have no file
    order; the partition and row number of the read stand in for it.
    """
    lower = df.toDF(*[c.lower() for c in df.columns])
    _require(lower.columns, columns)
    return place(
        lower.select(
            *columns,
            *_no_place(),
        )
    )


def date_form_of(landed: DataFrame) -> str:
    """The form of the first date in file order, from a pass over the date column alone."""
    if not isinstance(landed.schema["date"].dataType, T.StringType):
        return DATE_FORM
    dates = landed.select(null_if_token(F.col("date")).alias("date"), *FILE_ORDER)
    row = dates.where(F.col("date").isNotNull()).orderBy(*FILE_ORDER).first()
    return form_of(row and row["date"])


def _no_place() -> list[Column]:
    return [
        F.lit("").alias(FILE),
        F.lit(0).cast("bigint").alias(BLOCK),
        F.lit(None).cast("string").alias(REASON),
        F.lit(None).cast("string").alias(RECORD),
    ]


def locate(df: DataFrame) -> DataFrame:
    """Add the file path and the offset of the split a row comes from."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
    )


def place(df: DataFrame) -> DataFrame:
    """Complete the file position with an id that rises within each split."""
    return df.withColumn(ROW, F.monotonically_increasing_id())


def _require(header: Sequence[str], columns: Sequence[str], path: str = "extract") -> None:
    missing = [c for c in columns if c not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; it has {', '.join(header)}")
    if len(set(header)) < len(header):
        raise ValueError(f"{path} has a column twice: {', '.join(header)}")


def _text_schema(header: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in [*header, _RAW]])


def _csv_options(multiline: bool) -> dict[str, object]:
    return {
        "header": True,
        "enforceSchema": False,
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _RAW,
        "multiLine": multiline,
        "columnPruning": False,  # a row's fields are counted only if all are parsed
    }


def _flag_rows(
    df: DataFrame, width: int, columns: Sequence[str], may_be_cut: bool = False
) -> DataFrame:
    """Keep short rows, padded with null; flag rows with more fields than the header.

    Spark keeps the raw line for both, so the fields are counted there. ``may_be_cut``: the last
    field of ``width`` is not the header's; rows that a line break in quotes has cut are flagged, too.
    """
    raw = F.col(_RAW)
    too_long = F.when(_field_count(raw) > width, F.lit("too many fields"))
    if may_be_cut:
        too_long = F.when(raw.isNull() | (_field_count(raw) >= width), F.lit("too many fields"))
        too_long = F.coalesce(F.when(_is_open(raw), F.lit("a quote stays open")), too_long)
    return df.withColumn(REASON, too_long).select(
        *columns, FILE, BLOCK, REASON, F.when(F.col(REASON).isNotNull(), raw).alias(RECORD)
    )


def _is_open(line: Column) -> Column:
    """A quoted field that does not end on its line, whose quotes cannot all be pairs."""
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    return F.contains(line, F.lit('"')) & (quotes % 2 == 1) & line.rlike(_OPEN_QUOTE)


def _field_count(line: Column) -> Column:
    unquoted = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit(""))) + 1
