"""Dates whose order or year only the file as a whole tells.

``03/04`` is the third of April or the fourth of March, of a year the cell does
not name. What a single cell leaves open, the file's other rows decide:

1. *Impossible months.* A first number above 12 is a day, and so is a second one;
   the majority of such rows fixes the file's order.
2. *Date order.* Where every number could be a month, both readings are tried:
   statements are sorted, so the right one goes up (or down) with few breaks.
3. *Roll-over.* Along a sorted file the year changes where the month and day step
   back. The file's year is that of its latest row; the others are counted from it.

Rows keep their places: a file is cut where its reader cut it (``block``), each
block is read in order by itself, and only one row a block (first and last date,
steps up and down) is compared across blocks. A file of any length is so spread
over as many tasks as it has blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.functions.bank import month_number
from corvid.functions.text import py_strip

#: Share of steps against the direction up to which a file counts as sorted.
SORTED = 0.1
#: The forms of a date cell: name, pattern. ``n``: day and month in open order.
FORMS = (
    ("ymd", r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})$"),
    ("ymd", r"^((?:19|20)\d{2})(\d{2})(\d{2})$"),
    ("ny", r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})$"),
    ("n", r"^(\d{1,2})[-/](\d{1,2})$"),
    ("dMy", r"^(\d{1,2})[-/. ](\p{L}{3})[-/. ](\d{4})$"),
    ("dM", r"^(\d{1,2})[-/. ](\p{L}{3})$"),
)


#: Blocks a task gets on average; the number of tasks grows with the rows.
BLOCKS_EACH = 4


def by_block(rows: DataFrame, file: str, block: str, blocks: int) -> DataFrame:
    """``rows`` dealt by block: what a task sorts doesn't grow with the input. A
    few blocks are left to the session's own number of partitions."""
    n = -(-blocks // BLOCKS_EACH)
    few = n <= int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows if few else rows.repartition(n, file, block)


def _none() -> Column:
    return F.lit(None).cast("int")


def date_parts(text: Column) -> Column:
    """A date cell as ``struct(a, b, year, open)``: two numbers (month first for
    the forms that say so: then ``open`` is false), the year or NULL. NULL when
    the text has none of the forms."""
    s = py_strip(text)
    out = None
    for form, pattern in FORMS:
        part = [F.regexp_extract(s, pattern, i) for i in (1, 2, 3)[:2 if len(form) < 3 and form != "ny" else 3]]
        num = [p.try_cast("int") for p in part]
        if form == "ymd":
            a, b, year, is_open = num[1], num[2], num[0], F.lit(False)
        elif form.startswith("n"):
            a, b, year, is_open = num[0], num[1], num[2] if form == "ny" else _none(), F.lit(True)
        else:
            month = month_number(part[1]).cast("int")
            a, b, year, is_open = month, num[0], num[2] if form == "dMy" else _none(), F.lit(False)
        got = F.struct(a.alias("a"), b.alias("b"), year.alias("year"), is_open.alias("open"))
        hit = s.rlike(pattern) & a.isNotNull()
        out = F.when(hit, got) if out is None else out.when(hit, got)
    return out


def order_vote(parts: Column) -> Column:
    """+1: day first for certain, -1: month first for certain, 0: open, NULL: no say."""
    a, b = parts["a"], parts["b"]
    one_month = (F.least(a, b) >= 1) & (F.least(a, b) <= 12) & (F.greatest(a, b) <= 31)
    return F.when(parts["open"] & one_month, F.when(a > 12, 1).when(b > 12, -1).otherwise(0))


def _month_day(parts: Column, day_first: Column) -> tuple[Column, Column]:
    swap = parts["open"] & day_first
    return F.when(swap, parts["b"]).otherwise(parts["a"]), F.when(swap, parts["a"]).otherwise(parts["b"])


def make_date(parts: Column, day_first: Column, year: Column) -> Column:
    """ISO text, or NULL where the calendar has no such day."""
    month, day = _month_day(parts, day_first)
    text = F.concat_ws("-", F.coalesce(parts["year"], year).cast("string"), month.cast("string"), day.cast("string"))
    known = month.isNotNull() & day.isNotNull() & F.coalesce(parts["year"], year).isNotNull()
    return F.date_format(F.when(known, F.try_to_date(text, "yyyy-M-d")), "yyyy-MM-dd")


def _key(parts: Column, day_first: bool) -> Column:
    """A number that grows with the date read one way (without a year: within its
    year); NULL where that reading is impossible."""
    month, day = _month_day(parts, F.lit(day_first))
    ok = month.between(1, 12) & day.between(1, 31)
    return F.when(ok, F.coalesce(parts["year"], F.lit(0)) * 512 + month * 32 + day)


READINGS = {"dm": True, "md": False}


def _steps(rows: DataFrame, file: str, block: str, order: str, keys: dict[str, Column], n_blocks: int = 0) -> DataFrame:
    """Per file and reading: steps up and down between neighbouring dated rows."""
    inside = Window.partitionBy(file, block).orderBy(order)
    aggs = []
    for name in keys:
        prev, key = F.col(f"_p_{name}"), F.col(f"_k_{name}")
        aggs += [F.sum((key > prev).cast("long")).alias(f"_up_{name}"), F.sum((key < prev).cast("long")).alias(f"_down_{name}"),
                 F.min_by(key, F.when(key.isNotNull(), F.col(order))).alias(f"_first_{name}"),
                 F.max_by(key, F.when(key.isNotNull(), F.col(order))).alias(f"_last_{name}")]
    keyed = by_block(rows.select(file, block, order, *[k.alias(f"_k_{n}") for n, k in keys.items()]), file, block, n_blocks)
    before = [F.last(f"_k_{n}", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_p_{n}")
              for n in keys]
    return keyed.select("*", *before).groupBy(file, block).agg(*aggs)


def _joined(blocks: DataFrame, file: str, block: str, names) -> DataFrame:
    """Add the steps from one block's last date to the next one's first."""
    across = Window.partitionBy(file).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    out = blocks.select("*", *[F.last(f"_last_{n}", ignorenulls=True).over(across).alias(f"_before_{n}") for n in names])
    for n in names:
        edge, first = F.col(f"_before_{n}"), F.col(f"_first_{n}")
        out = (out.withColumn(f"_up_{n}", F.coalesce(F.col(f"_up_{n}"), F.lit(0)) + F.coalesce((first > edge).cast("long"), F.lit(0)))
               .withColumn(f"_down_{n}", F.coalesce(F.col(f"_down_{n}"), F.lit(0)) + F.coalesce((first < edge).cast("long"), F.lit(0))))
    return out


def solve_files(rows: DataFrame, file: str = "file", block: str = "block", order: str = "place",
                parts: str = "parts", vote: str = "day_first", n_blocks: int = 0) -> DataFrame:
    """One row a file: ``file, day_first, direction`` (1 up, -1 down, 0 unsorted).

    ``vote`` is what impossible months say (NULL: nothing). An undecided file is
    read the way that breaks its order least, day first on a tie."""
    keys = {n: _key(F.col(parts), d) for n, d in READINGS.items()}
    blocks = _joined(_steps(rows, file, block, order, keys, n_blocks), file, block, READINGS)
    total = blocks.groupBy(file).agg(*[F.sum(f"_{w}_{n}").alias(f"{w}_{n}") for n in READINGS for w in ("up", "down")])
    votes = rows.groupBy(file).agg(F.first(vote, ignorenulls=True).alias("_vote"))
    breaks = {n: F.least(f"up_{n}", f"down_{n}") for n in READINGS}
    day_first = F.coalesce("_vote", breaks["dm"] <= breaks["md"])
    up, down = (F.when(F.col("day_first"), F.col(f"{w}_dm")).otherwise(F.col(f"{w}_md")) for w in ("up", "down"))
    direction = (F.when(F.least(up, down) > SORTED * (up + down), 0).when(up >= down, 1).otherwise(-1))
    return (total.join(votes, file).withColumn("day_first", day_first)
            .select(file, "day_first", direction.alias("direction")))


def resolve_dates(rows: DataFrame, file: str = "file", block: str = "block", order: str = "place",
                  text: str = "date_raw", vote: str = "day_first", year: str = "year") -> DataFrame:
    """``rows`` with ``date`` (ISO text or NULL).

    ``year`` is the year of the file's latest row; a year-less date of an
    unsorted file takes it as it is. Sorted files are followed block by block:
    the running count of roll-overs inside a block, and those of the blocks
    before it, joined by ``(file, block)``."""
    parsed = rows.withColumn("_parts", date_parts(F.col(text)))
    n_blocks = rows.select(file, block).distinct().count()
    solved = (solve_files(parsed, file, block, order, "_parts", vote, n_blocks)
              .withColumnRenamed("day_first", "_day_first").withColumnRenamed("direction", "_direction"))
    # a row a file, as the driver's own list of them: no file meets whole in one task
    t = by_block(parsed.drop(vote).join(F.broadcast(solved), file), file, block, n_blocks)
    no_year = F.struct(F.col("_parts.a").alias("a"), F.col("_parts.b").alias("b"), _none().alias("year"),
                       F.col("_parts.open").alias("open"))
    t = t.withColumn("_md", F.when(F.col("_day_first"), _key(no_year, True)).otherwise(_key(no_year, False)))
    inside = Window.partitionBy(file, block).orderBy(order)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("_prev", F.last("_md", ignorenulls=True).over(earlier))
    turn = ((F.col("_direction") == 1) & (F.col("_md") < F.col("_prev"))) | \
           ((F.col("_direction") == -1) & (F.col("_md") > F.col("_prev")))
    t = t.withColumn("_turn", F.coalesce(turn.cast("int"), F.lit(0)))
    t = t.withColumn("_inner", F.sum("_turn").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    per = t.groupBy(file, block).agg(
        F.first("_direction").alias("_dir"), F.sum("_turn").alias("_sum"),
        F.min_by("_md", F.when(F.col("_md").isNotNull(), F.col(order))).alias("_first"),
        F.max_by("_md", F.when(F.col("_md").isNotNull(), F.col(order))).alias("_last"))
    blocks = Window.partitionBy(file).orderBy(block)
    before = blocks.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_edge", F.last("_last", ignorenulls=True).over(before))
    step = ((F.col("_dir") == 1) & (F.col("_first") < F.col("_edge"))) | ((F.col("_dir") == -1) & (F.col("_first") > F.col("_edge")))
    per = per.withColumn("_step", F.coalesce(step.cast("int"), F.lit(0)))
    per = per.select(file, block, F.col("_step").alias("_open"),
                     F.coalesce(F.sum(F.col("_step") + F.col("_sum")).over(before), F.lit(0)).alias("_past"),
                     F.sum(F.col("_step") + F.col("_sum")).over(Window.partitionBy(file)).alias("_all"))
    t = t.join(per, [file, block])
    # a block's first dated row is the one that steps over its edge
    seen = F.col("_past") + F.col("_inner") + F.col("_open")
    at = F.when(F.col("_direction") == 1, F.col(year) - (F.col("_all") - seen)) \
          .when(F.col("_direction") == -1, F.col(year) - seen).otherwise(F.col(year))
    return (t.withColumn("date", make_date(F.col("_parts"), F.col("_day_first"), at.cast("int")))
            .drop("_parts", "_md", "_prev", "_turn", "_inner", "_open", "_past", "_all", "_day_first", "_direction"))
