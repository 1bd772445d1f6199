"""CSV of a bank nobody described (S3): the files themselves say how to read them.

Lines are read as they are. Per line and separator the cells' *shapes* form a
signature (``t`` text, ``i`` digits, ``c``/``d`` amounts with a decimal comma or
point, the date forms, ...); lines are counted by file and signature in one
aggregation, and all votes are taken on those few rows:

* *separator*: the most lines with one cell count, times the share of dates in
  its best date column, times that of amounts in its best amount column;
* *encoding*: UTF-8 if every line is valid UTF-8, else Latin-1;
* *column roles*: the column with the most dates, then amounts, digits, text;
* *decimal mark*, and *day or month first*, by the rows that leave no doubt;
* *header*: a first line that has text where the column has dates, amounts, ids.

``read_any_bank_csv`` gives the same canonical rows as ``read_bank_csv``, with no
profile. A line whose cell count isn't the file's is kept as ``corrupt``; so is
every line of a file in which no separator yields both dates and amounts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvid.functions.bank import parse_amount
from corvid.functions.text import py_strip
from corvid.operators.dates import date_parts, make_date, resolve_dates
from corvid.session import stored

# The separators that are tried, the preferred one first.
SEPARATORS = (",", ";", "\t", "|")
#: Lines of a block: what is followed row by row in one window.
BLOCK_LINES = 1 << 17
_CUT = "\u0001"
_CENTS = r"\d{1,2}[)]?$"
_SIGN = r"^[(]?\s*[-−]?\s*(?:\p{Lu}{0,3}[$€£])?\s*[-−]?\s*"
#: Shapes of a cell; dates: ``Y`` says it all, ``P``/``Q``/``N`` day first, month
#: first, open, with a year; small letters the same without one.
DATE_SHAPES, AMOUNT_SHAPES = "YPQNypqn", "cd"
#: Groups of shapes that are counted per column.
COUNTED = ("c", "d", "Pp", "Qq", "Nn", "ypqn")


def read_lines(spark: SparkSession, root: str) -> DataFrame:
    """Every line below ``root`` as bytes: ``file, block, place, line``. ``place``
    grows along the part of the file a task has read; ``block`` is a piece of such
    a part, of at most ``BLOCK_LINES`` lines, and grows along the file."""
    meta = F.col("_metadata")
    place = F.monotonically_increasing_id()
    return (spark.read.option("recursiveFileLookup", "true").text(root)
            .select(meta["file_path"].alias("file"), meta["file_block_start"].alias("_start"),
                    place.alias("place"), F.col("value").alias("line"))
            .select("file", F.struct("_start", F.floor(F.col("place") / BLOCK_LINES).alias("_piece")).alias("block"),
                    "place", "line")
            .filter(F.length(F.trim("line")) > 0))


def split_cells(line: Column, sep: Column) -> Column:
    """Cells of a line; separators inside quotes are text, ``""`` there is a quote."""
    pieces = F.split(line, '"', -1)
    last = F.size(pieces) - 1
    outside = F.transform(pieces, lambda s, i: F.when(i % 2 == 1, s)
                          .when((s == "") & (i > 0) & (i < last), F.lit('"'))
                          .otherwise(F.replace(s, sep, F.lit(_CUT))))
    quoted = F.split(F.array_join(outside, ""), _CUT, -1)
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(F.replace(line, sep, F.lit(_CUT)), _CUT, -1))


# What each shape looks like, the first that fits counts.
_M, _BIG = "(0?[1-9]|1[0-2])", "(1[3-9]|2[0-9]|3[01])"      # may be a month; can't be one
_WITH_YEAR, _WITHOUT = r"[-/.]\d{4}$", "$"
SHAPES = (
    ("_", "^$"),
    ("c", _SIGN + r"\d[\d.]*," + _CENTS),
    ("Y", r"^\d{4}[-/.]\d{1,2}[-/.]\d{1,2}$|^(19|20)\d{2}(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])$"
          r"|^\d{1,2}[-/. ]\p{L}{3}[-/. ]\d{4}$"),
    ("y", r"^\d{1,2}[-/. ]\p{L}{3}$"),
    *[(letter, f"^{x}{sep}{y}{end}") for letters, sep, end in (("PQN", "[-/.]", _WITH_YEAR), ("pqn", "[-/]", _WITHOUT))
      for letter, x, y in zip(letters, (_BIG, _M, _M), (_M, _BIG, _M))],
    ("d", _SIGN + r"\d[\d,]*\." + _CENTS),
    ("i", r"^\d+$"),
)


def shape(s: Column) -> Column:
    """One letter for what a trimmed cell looks like."""
    out = None
    for letter, pattern in SHAPES:
        out = F.when(s.rlike(pattern), letter) if out is None else out.when(s.rlike(pattern), letter)
    return out.otherwise("t")


def signature(line: Column, sep: str) -> Column:
    """The shapes of a line's cells; empty where the separator doesn't occur."""
    cells = F.transform(split_cells(line, F.lit(sep)), py_strip)
    return F.when(F.contains(line, F.lit(sep)), F.array_join(F.transform(cells, shape), "")).otherwise(F.lit(""))


def _share(shapes: str) -> Column:
    hit = F.instr(F.lit(shapes), F.col("shape")) > 0
    return F.sum(F.when(hit, F.col("n")).otherwise(0)) / F.sum("n")


def infer_dialects(lines: DataFrame) -> DataFrame:
    """One row a file: ``file, sep, encoding, header`` (the line, or NULL)``,
    n_cells, pos_date, pos_amount, pos_id, pos_description`` (from 0)``,
    decimal_mark, day_first`` (NULL: not known)``, yearless`` (some dates lack the
    year)``, open_order`` (dates occur of which no row tells day from month)."""
    at = F.struct("block", "place", "line")
    sigs = F.array(*[signature(F.col("line"), s) for s in SEPARATORS])
    seen = (lines.select("file", at.alias("_at"), F.is_valid_utf8("line").alias("_utf8"), sigs.alias("_sigs"))
            .groupBy("file", "_sigs").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("_at"),
                                          F.min("_utf8").alias("_utf8")))
    whole = Window.partitionBy("file")                       # a file's signatures
    seen = (seen.withColumn("_first", F.min("_at").over(whole)).withColumn("_lines", F.sum("n").over(whole))
            .withColumn("_valid", F.min("_utf8").over(whole)))
    is_first = F.col("_at") == F.col("_first")
    # the first line may be a header: it votes only where it is alone
    votes = seen.withColumn("n", F.col("n") - (is_first & (F.col("_lines") > 1)).cast("long"))
    by_sep = votes.select("file", "n", "_lines", "_valid", F.col("_first.line").alias("_line"),
                          F.when(is_first, F.col("_sigs")).alias("_own"), F.posexplode("_sigs").alias("s", "sig"))
    by_sep = by_sep.withColumn("_head", F.max(F.get("_own", F.col("s"))).over(Window.partitionBy("file", "s")))
    width = by_sep.groupBy("file", "s", F.length("sig").alias("n_cells")).agg(F.sum("n").alias("w"))
    usual = (width.groupBy("file", "s").agg(F.max_by("n_cells", F.struct("w", "n_cells")).alias("n_cells"))
             .filter("n_cells > 1"))
    cells = (by_sep.join(usual, ["file", "s"]).filter(F.length("sig") == F.col("n_cells"))
             .select("*", F.posexplode(F.split("sig", "")).alias("pos", "shape")).filter("shape <> ''"))
    shapes = {"date": DATE_SHAPES, "amount": AMOUNT_SHAPES, "id": "i", "text": "t"}
    cols = cells.groupBy("file", "s", "n_cells", "pos").agg(
        *[_share(x).alias(name) for name, x in shapes.items()], F.sum("n").alias("w"),
        *[F.sum(F.when(F.instr(F.lit(x), F.col("shape")) > 0, F.col("n")).otherwise(0)).alias(f"_{x}")
          for x in COUNTED],
        *[F.first(c).alias(c) for c in ("_lines", "_valid", "_line", "_head")])
    per = cols.groupBy("file", "s", "n_cells").agg(
        *[F.first(c).alias(c) for c in ("_lines", "_valid", "_line", "_head")], F.max("w").alias("w"),
        F.collect_list(F.struct("pos", "date", "amount", "id", "text", *[f"_{x}" for x in COUNTED])).alias("cols"))

    def best(role: str, taken: list[str]) -> Column:
        free = F.filter("cols", lambda c: (c[role] > 0) & ~F.array_contains(F.array(*[F.coalesce(F.col(t), F.lit(-1)) for t in taken]), c["pos"])) \
            if taken else F.filter("cols", lambda c: c[role] > 0)
        ranked = F.array_sort(F.transform(free, lambda c: F.struct((-c[role]).alias("k"), c["pos"].alias("pos"))))
        return F.get(ranked, 0)["pos"]

    def of(pos: str, field: str) -> Column:
        return F.coalesce(F.get(F.filter("cols", lambda c: c["pos"] == F.col(pos)), 0)[field], F.lit(0))

    per = (per.withColumn("pos_date", best("date", [])).withColumn("pos_amount", best("amount", ["pos_date"]))
           .withColumn("pos_id", best("id", ["pos_date", "pos_amount"]))
           .withColumn("pos_description", best("text", ["pos_date", "pos_amount", "pos_id"])))
    score = F.col("w") / F.col("_lines") * of("pos_date", "date") * of("pos_amount", "amount")
    per = per.withColumn("_score", score).filter("_score > 0")
    chosen = per.groupBy("file").agg(F.max_by(F.struct("*"), F.struct(F.col("_score"), F.col("n_cells"), -F.col("s"))).alias("d")).select("d.*")

    def head_lacks(pos: str, allowed: str) -> Column:
        letter = F.substring("_head", F.col(pos) + 1, F.lit(1))
        return F.col(pos).isNull() | ((letter != "_") & (F.instr(F.lit(allowed), letter) == 0))

    is_header = (head_lacks("pos_date", DATE_SHAPES) & head_lacks("pos_amount", AMOUNT_SHAPES + "i")
                 & head_lacks("pos_id", "i") & (F.length("_head") == F.col("n_cells")))
    first, second = of("pos_date", "_Pp"), of("pos_date", "_Qq")
    return chosen.select(
        "file", F.element_at(F.array(*[F.lit(s) for s in SEPARATORS]), F.col("s") + 1).alias("sep"),
        F.when(F.col("_valid"), "UTF-8").otherwise("ISO-8859-1").alias("encoding"),
        F.when(is_header, F.col("_line")).alias("header"), "n_cells", "pos_date", "pos_amount", "pos_id", "pos_description",
        F.when(of("pos_amount", "_c") > of("pos_amount", "_d"), ",").otherwise(".").alias("decimal_mark"),
        F.when(first > second, True).when(second > first, False).alias("day_first"),
        (of("pos_date", "_ypqn") > 0).alias("yearless"),
        ((first == second) & (first + second + of("pos_date", "_Nn") > 0)).alias("open_order"))


def statement_year(file: Column) -> Column:
    """The year of the file's latest row, as its path names it: that of the last
    ``name=year`` folder, else the last four-digit year (part files have random
    names: those don't count)."""
    named = F.regexp_replace(file, "/part-[^/]*$", "/")

    def last(pattern: str) -> Column:
        return F.try_element_at(F.regexp_extract_all(named, F.lit(pattern), F.lit(1)), F.lit(-1)).try_cast("int")
    return F.coalesce(last(r"=((?:19|20)\d{2})(?=/)"), last(r"(?<!\d)((?:19|20)\d{2})(?!\d)"))


def parse_lines(lines: DataFrame, dialects: DataFrame) -> DataFrame:
    """Lines -> raw cells by role, ``corrupt`` where the line does not fit, the
    dialect's columns beside them. Headers go, every other line stays."""
    # a row a file, as the driver's own list of them: no file meets whole in one task
    j = lines.join(F.broadcast(dialects), "file", "left").filter(F.col("header").isNull() | (F.col("line") != F.col("header")))
    text = F.when(F.col("encoding") == "ISO-8859-1", F.decode(F.col("line").cast("binary"), "ISO-8859-1")).otherwise(F.col("line"))
    text = F.regexp_replace(text, "^﻿", "")
    j = j.withColumn("_text", text).withColumn("_cells", split_cells(F.col("_text"), F.col("sep")))
    fits = F.col("sep").isNotNull() & (F.size("_cells") == F.col("n_cells"))

    def cell(role: str) -> Column:
        got = F.get("_cells", F.col(f"pos_{role}"))
        return F.when(got != "", got).alias(f"{role}_raw")
    return j.select("file", "block", "place", *[cell(r) for r in ("id", "date", "description", "amount")],
                    F.when(~fits, F.col("_text")).alias("corrupt"), "decimal_mark", "day_first", "yearless", "open_order")


def read_any_bank_csv(spark: SparkSession, root: str) -> DataFrame:
    """S3 without profiles: the canonical rows of every file below ``root``.

    Files whose dates lack the year, or whose day and month stay open, are
    followed row by row (``resolve_dates``); all others are parsed where they
    are read."""
    lines = read_lines(spark, root)
    dialects = stored(infer_dialects(lines), "dialects")         # one row a file
    rows = parse_lines(lines, dialects).withColumn("_year", statement_year(F.col("file")))
    # stored: the passes over the files that are followed read cells, not lines
    rows = stored(rows, "bank-cells")
    need = F.coalesce(F.col("yearless") | F.col("open_order"), F.lit(False))
    here = (rows.filter(~need).withColumn("_parts", date_parts(F.col("date_raw")))
            .withColumn("date", make_date(F.col("_parts"), F.coalesce("day_first", F.lit(True)), F.col("_year"))))
    along = resolve_dates(rows.filter(need), year="_year")
    fits = F.col("corrupt").isNull()
    amount = F.when(F.col("decimal_mark") == ",", parse_amount(F.col("amount_raw"), ",", "."))
    amount = amount.otherwise(parse_amount(F.col("amount_raw"), ".", ","))
    cols = ["file", "id_raw", "date_raw", "description_raw", "amount_raw", "corrupt", "date", "decimal_mark", "_year"]
    both = here.select(*cols).unionByName(along.select(*cols))
    return both.select(
        F.when(fits, F.col("id_raw").try_cast("bigint")).alias("row_id"),
        F.nullif(F.regexp_extract("file", "bank=([^/]+)/", 1), F.lit("")).alias("bank"), F.col("_year").alias("year"), "file",
        "id_raw", "date_raw", "description_raw", "amount_raw", "corrupt",
        F.when(fits, F.col("date")).alias("date"), F.when(fits, amount).alias("amount"))
