"""Sheet export kept as CSV text in one cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Column positions of the sheet.
POSITIONS = {"name": 0, "roster_rank": 3, "player_class": 5, "race": 119, "note": 120}
# Stand-ins, from the private use area, for what quotes protect: comma, line feed, carriage return, quote.
_PROTECTED, _QUOTE = ",\n\r", "\uf8f3"
_STAND_INS = "\uf8f0\uf8f1\uf8f2"
_BLANK = " \t\n\r"


def _unquoted(text: Column) -> Column:
    """The text without its quotes, in which the stand-ins hold what the quotes protected.

    Cut at the quotes, every second piece lies inside of some; an empty piece between two of those is
    a doubled quote. So one pass over the pieces is enough, however long the text is.
    """
    pieces = F.split(text, '"', -1)
    last = F.size(pieces) - 1

    def plain(piece: Column, at: Column) -> Column:
        doubled = (piece == "") & (at > 0) & (at < last)
        return F.when(at % 2 == 1, F.translate(piece, _PROTECTED, _STAND_INS)).when(doubled, F.lit(_QUOTE)).otherwise(piece)

    return F.array_join(F.transform(pieces, plain), "")


def _cells(line: Column) -> Column:
    back = lambda cell: F.btrim(F.translate(cell, _STAND_INS + _QUOTE, _PROTECTED + '"'), F.lit(_BLANK))
    return F.transform(F.split(line, ",", -1), back)


def parse_sheet(df: DataFrame, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of a sheet cell after its two header lines, by fixed positions, with their line number ``_line``.

    Commas and line breaks inside double quotes belong to a cell, doubled quotes are one. Cells are
    trimmed; one that a line does not reach is empty.
    """
    lines = F.split(_unquoted(F.col(text)), "\r\n|\r|\n", -1)
    titled = df.select(*keep, lines.alias("_lines")).select(
        "*", F.coalesce(F.get(_cells(F.get("_lines", F.lit(1))), F.lit(1)), F.lit("")).alias("source_refreshed_at"))
    each = titled.select(*keep, "source_refreshed_at", F.posexplode("_lines").alias("_line", "_text")).filter("_line >= 2")
    cells = each.withColumn("_cells", _cells(F.col("_text")))
    fields = [F.coalesce(F.get("_cells", F.lit(at)), F.lit("")).alias(n) for n, at in POSITIONS.items()]
    return cells.select(*keep, *fields, "source_refreshed_at", "_line")
