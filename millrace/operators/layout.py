"""Page layout from blocks (page, x0, y0, x1, y1, text) and words: reading order, columns, tables, and their renderings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BAND = 8
#: Blocks of one task, which sorts them more than once.
ROWS = 1 << 18


def reading_order(blocks: DataFrame, key: list[str]) -> DataFrame:
    """key, text: blocks by column, then from top to bottom, of blocks in one place by text; gaps become breaks."""
    b = with_columns(blocks, key)
    w = Window.partitionBy(*key).orderBy("column", "y0", "x0", "text")
    y, x = F.col("y0") - F.lag("y1").over(w), F.col("x0") - F.lag("x1").over(w)
    turn = F.col("column") != F.lag("column").over(w)
    sep = F.when(y.isNull(), "").when(turn | (y > 30), "\n\n").when(y > 10, "\n").when(x > 10, " ").otherwise("\n")
    rows = b.withColumn("sep", sep).withColumn("place", F.row_number().over(w))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("place", "sep", "text"))), lambda r: F.concat(r["sep"], r["text"]))
    return rows.groupBy(*key).agg(F.array_join(parts, "").alias("text"))


def dealt(blocks: DataFrame, key: list[str]) -> DataFrame:
    """Pages dealt over as many tasks as their number of blocks asks for. Spark's own number doesn't grow with the table, and
    it joins small parts to such of 64 MB as written, which sorted are many times that."""
    n = max(-(-blocks.count() // ROWS), blocks.sparkSession.sparkContext.defaultParallelism)
    return blocks.repartition(n, *key)


def with_columns(blocks: DataFrame, key: list[str]) -> DataFrame:
    """Adds ``column``: the page's x centres parted where a gap is over twice the mean gap and a tenth of the width."""
    c = (F.col("x0") + F.col("x1")) / 2
    w = Window.partitionBy(*key).orderBy(c, "y0", "x0", "text")
    page = Window.partitionBy(*key)
    gap = c - F.lag(c).over(w)
    b = dealt(blocks, key).withColumn("gap", gap).withColumn("mean_gap", F.avg("gap").over(page)).withColumn("width", F.max("x1").over(page) - F.min("x0").over(page))
    new = (F.col("gap") > 2 * F.col("mean_gap")) & (F.col("gap") > F.col("width") * 0.1)
    order = Window.partitionBy(*key).orderBy(c, "y0", "x0", "text").rowsBetween(Window.unboundedPreceding, 0)
    return b.withColumn("column", F.sum(F.coalesce(new, F.lit(False)).cast("int")).over(order)).drop("gap", "mean_gap", "width")


def regions(blocks: DataFrame, key: list[str], n: int = 5) -> DataFrame:
    """Mixed layouts: how many columns each of n horizontal regions has."""
    page = Window.partitionBy(*key)
    top, height = F.min("y0").over(page), F.max("y1").over(page) - F.min("y0").over(page)
    b = blocks.withColumn("region", F.least(F.lit(n - 1), F.floor((F.col("y0") - top) / F.greatest(height, F.lit(1.0)) * n)).cast("int"))
    return with_columns(b, [*key, "region"]).groupBy(*key, "region").agg((F.max("column") + 1).alias("n_columns"))


def table_rows(blocks: DataFrame, key: list[str], band: int = BAND) -> DataFrame:
    """key, row, cells: blocks in horizontal bands, cells from left to right."""
    b = blocks.withColumn("row", F.round(F.col("y0") / band).cast("long"))
    cells = F.transform(F.array_sort(F.collect_list(F.struct("x0", "text"))), lambda r: r["text"])
    return b.groupBy(*key, "row").agg(cells.alias("cells"))


def tables(blocks: DataFrame, key: list[str], band: int = BAND) -> DataFrame:
    """key, rows: two rows and two columns at least."""
    r = table_rows(blocks, key, band).where(F.size("cells") >= 2)
    t = r.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("row", "cells"))), lambda x: x["cells"]).alias("rows"))
    return t.where(F.size("rows") >= 2)


def text_table(lines: Column) -> Column:
    """Lines with separators as rows of cells: ``|``, else tabs, else commas, else two spaces."""
    cut = lambda x: F.when(x.contains("|"), F.split(F.regexp_replace(x, r"^ *\| *| *\| *$", ""), r" *\| *")).when(x.contains("\t"), F.split(x, "\t")).when(F.regexp_count(x, F.lit(",")) >= 2, F.split(x, ", *")).otherwise(F.split(x, " {2,}"))
    return F.filter(F.transform(F.filter(lines, lambda x: ~x.rlike(r"^[ |:\-]*$")), cut), lambda r: F.size(r) >= 2)


def clean_table(rows: Column) -> Column:
    """Cells trimmed and padded to the widest row; empty rows go."""
    width = F.array_max(F.transform(rows, lambda r: F.size(r)))
    filled = F.transform(rows, lambda r: F.concat(F.transform(r, lambda c: F.coalesce(F.trim(c), F.lit(""))), F.array_repeat(F.lit(""), width - F.size(r))))
    return F.filter(filled, lambda r: F.exists(r, lambda c: c != ""))


def has_header(rows: Column) -> Column:
    """The first row has fewer numbers than a third of its cells, and cells shorter than seven tenths of the others' mean, or
    wider rows follow."""
    first, rest = F.element_at(rows, 1), F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0)))
    digits = F.size(F.filter(first, lambda c: c.rlike("[0-9]"))) / F.greatest(F.size(first), F.lit(1))
    mean = lambda r: F.aggregate(r, F.lit(0), lambda a, c: a + F.length(c)) / F.greatest(F.size(r), F.lit(1))
    later = F.aggregate(rest, F.lit(0.0), lambda a, r: a + mean(r)) / F.greatest(F.size(rest), F.lit(1))
    body = F.exists(rest, lambda r: F.exists(r, lambda c: c.rlike("[0-9]")))
    return (F.size(rows) > 1) & (digits < 0.3) & (body | (mean(first) < 0.7 * later))


def valid_tables(found: Column) -> Column:
    """Tables of two rows and three columns at least, each once."""
    return F.array_distinct(F.filter(found, lambda t: (F.size(t) >= 2) & (F.array_max(F.transform(t, lambda r: F.size(r))) >= 3)))


def merged(found: Column) -> Column:
    """Successive tables of one width are one, if the second has no header."""
    cell = F.array().cast("array<array<array<string>>>")

    def add(a: Column, t: Column) -> Column:
        last = F.try_element_at(a, F.lit(-1))
        goes_on = F.coalesce((F.size(F.element_at(t, 1)) == F.size(F.try_element_at(last, F.lit(1)))) & ~has_header(t), F.lit(False))
        return F.when(goes_on, F.concat(F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))), F.array(F.concat(last, t)))).otherwise(F.concat(a, F.array(t)))

    return F.aggregate(found, cell, add)


def markdown(rows: Column) -> Column:
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(r, lambda c: F.regexp_replace(c, r"([|*_`])", r"\\$1")), " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), F.size(F.element_at(rows, 1))))
    return F.array_join(F.concat(F.array(line(F.element_at(rows, 1)), rule), F.transform(F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0))), line)), "\n")


def latex(rows: Column) -> Column:
    line = lambda r: F.concat(F.array_join(F.transform(r, lambda c: F.regexp_replace(c, r"([&%$#_])", r"\\$1")), " & "), F.lit(r" \\"))
    spec = F.repeat(F.lit("l"), F.size(F.element_at(rows, 1)))
    return F.concat(F.lit("\\begin{tabular}{"), spec, F.lit("}\n\\hline\n"), F.array_join(F.transform(rows, line), "\n"), F.lit("\n\\hline\n\\end{tabular}"))


def equation_groups(blocks: DataFrame, key: list[str], gap: float = 30.0) -> DataFrame:
    """Equation blocks parted where they are more than ``gap`` apart."""
    w = Window.partitionBy(*key).orderBy("y0", "x0")
    new = F.col("y0") - F.lag("y1").over(w) > gap
    b = blocks.withColumn("grp", F.sum(F.coalesce(new, F.lit(False)).cast("int")).over(w))
    return b.groupBy(*key, "grp").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y0", "x0", "text"))), lambda r: r["text"]), "\n").alias("text"))


def words_to_text(words: DataFrame, key: list[str], band: int = 10) -> DataFrame:
    """words: key, text, left, top. Lines by bands, words from left to right."""
    w = words.withColumn("line", F.round(F.col("top") / band).cast("long"))
    ls = w.groupBy(*key, "line").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("left", "text"))), lambda r: r["text"]), " ").alias("t"))
    return ls.groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "t"))), lambda r: r["t"]), "\n").alias("text"))


def strategy(n_blocks: Column, n_columns: Column, n_headings: Column) -> Column:
    """Which reconstruction suits a page."""
    score = n_columns * 2 + n_blocks / 50
    return F.when(n_headings >= 3, "heading_aware").when(score > 6, "adaptive").when(n_columns > 1, "block_aware").otherwise("standard")
