"""Raw log lines: parsing, splitting into start, page and display records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import blank
from millrace.schemas import LOG_LINE

_DIRTY = "_dirty"


# Stands behind the line in what is parsed; no line can hold it by accident.
_END = "8d1f6c1e-end-of-line"
_MARK = "8d1f6c1e-mark"


def parse_json(lines: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Add ``record`` (the parsed line) and ``_dirty`` (line is not a JSON object).

    The parser sees each line once, as an array of the line and a mark: whatever follows the object, or ends it early, moves
    the mark.  Both the fields and the validity are then taken from the binary value.  A field of another shape than the
    schema's reads as null, and the line stays clean; an object read as text has its names sorted.  A schema of texts and
    maps only (change records, flat feeds) is read as records in one go, and numbers in it keep their text.  ``inline`` keeps later filters and fields from copying the
    line's own expression, the parse or the reading of fields below or beside it.
    """
    if all(isinstance(f.dataType, (T.StringType, T.MapType)) for f in schema):
        return _flat_records(lines, schema, value)
    both = F.try_parse_json(F.concat(F.lit("["), F.col(value), F.lit(f',"{_END}"]')))
    rows = lines.select("*", _once(both.alias("_both")))
    record = F.try_variant_get("_both", "$[0]", schema.simpleString())
    whole = F.coalesce(F.try_variant_get("_both", "$[1]", "string") == _END, F.lit(False))
    return rows.select(*lines.columns, _once(F.when(whole, record).alias("record"))).withColumn(_DIRTY, F.col("record").isNull())


def _flat_records(lines: DataFrame, schema: T.StructType, value: str) -> DataFrame:
    """:func:`parse_json` for a schema of texts and maps, whose entries keep the order of the line (the binary value sorts names).

    One reading too, without a binary value whose fields are cast one by one: the line and a marked object are an array of two records, and nothing else is if the line is one object.
    A name that is repeated in a map makes the line dirty; of other repeated names the last one counts.
    """
    marked = F.concat(F.lit("["), F.col(value), F.lit(f',{{"{_MARK}":"{_END}"}}]'))
    options = {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    both = F.from_json(marked, T.ArrayType(T.StructType([*schema.fields, T.StructField(_MARK, T.StringType())])), options)
    rows = lines.select("*", _once(both.alias("_both")))
    line, mark = F.get("_both", F.lit(0)), F.get("_both", F.lit(1))[_MARK]
    whole = (F.size("_both") == 2) & (mark == _END)
    for f in schema:
        if isinstance(f.dataType, T.MapType):
            names = F.map_keys(line[f.name])
            whole = whole & F.coalesce(F.size(F.array_distinct(names)) == F.size(names), F.lit(True))
    record = F.struct(*[line[f.name].alias(f.name) for f in schema])
    return rows.select(*lines.columns, _once(F.when(whole & line.isNotNull(), record).alias("record"))).withColumn(_DIRTY, F.col("record").isNull())


def _once(*columns: Column) -> Column:
    """The columns behind a barrier that no expression is moved or copied through."""
    return F.inline(F.array(F.struct(*columns)))


def parse_clean(
    lines: DataFrame, schema: T.StructType = LOG_LINE, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Fields of the well-formed lines, with the columns of ``lines`` named in ``keep``."""
    rows = parse_json(lines, schema, value).where(~F.col(_DIRTY))
    return rows.select(*[F.col(f"record.{f.name}") for f in schema.fields], *keep)


def parse_dirty(lines: DataFrame, schema: T.StructType = LOG_LINE, value: str = "value") -> DataFrame:
    """The lines that are not JSON objects, unchanged."""
    return parse_json(lines, schema, value).where(_DIRTY).select(value)


def parse_logs(lines: DataFrame, value: str = "value", schema: T.StructType = LOG_LINE) -> DataFrame:
    """Well-formed log lines, with the device fields and typed times on top.

    ``schema`` may leave out page fields and displays that are not needed (:func:`only`); less is then parsed.
    """
    logs = parse_clean(lines, schema, value)
    return logs.select(
        "log_id",
        "common.*",
        F.struct(
            *[
                F.col(f"page.{n}").try_cast("long").alias(n) if n == "during_time" else F.col(f"page.{n}")
                for n in schema["page"].dataType.names
            ]
        ).alias("page"),
        "start",
        *[n for n in ("displays",) if n in schema.names],
        F.col("ts").try_cast("long").alias("ts"),
    )


def only(*page_fields: str) -> T.StructType:
    """The log line's schema with these page fields and without displays."""
    page = T.StructType([f for f in LOG_LINE["page"].dataType if f.name in page_fields])
    return T.StructType([
        T.StructField("page", page) if f.name == "page" else f for f in LOG_LINE if f.name != "displays"])


def has_start() -> Column:
    return ~blank("start")


def start_logs(logs: DataFrame) -> DataFrame:
    return logs.where(has_start()).drop("page", "displays")


def page_logs(logs: DataFrame) -> DataFrame:
    return logs.where(~has_start()).drop("start")


def display_logs(logs: DataFrame) -> DataFrame:
    """One row per display of a page record; carries the page id and no time."""
    return logs.where(~has_start()).select(
        F.col("page.page_id").alias("page_id"), F.inline("displays")
    )


def is_entry(last_page: str = "page.last_page_id") -> Column:
    """A page reached from no other page: previous page null or empty."""
    return blank(last_page)


def starts_session(last_page: str = "page.last_page_id") -> Column:
    """The visitor statistics' session test: previous page null, but not empty."""
    return F.col(last_page).isNull()


def is_keyword_search() -> Column:
    """A result page reached from the search page by a keyword."""
    return (
        (F.col("page.last_page_id") == "search")
        & (F.col("page.item_type") == "keyword")
        & F.col("page.item").isNotNull()
    )
