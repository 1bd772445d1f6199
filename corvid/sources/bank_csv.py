"""Bank CSV dialects: rendering, writing and reading.

Each bank exports a different layout. A ``BankProfile`` states it; reading is
one ``spark.read.csv`` per profile (the options differ per file family) then
``unionByName`` into one canonical, all-string frame with the file it came from.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.functions.bank import (EN_MONTHS, PT_MONTHS, format_amount, normalize_date,
                                   parse_amount)

ROLES = ("id", "date", "description", "amount")


@dataclass(frozen=True)
class BankProfile:
    bank: str
    sep: str
    encoding: str
    header: bool
    columns: tuple[tuple[str, str], ...]  # (column name in file, role), in file order
    date_formats: tuple[str, ...]   # the first is the usual one
    decimal_mark: str = "."
    thousands: str | None = None
    currency_prefix: str = ""

    def names(self) -> list[str]:
        return [n for n, _ in self.columns]

    def name_of(self, role: str) -> str:
        return next(n for n, r in self.columns if r == role)


# The four export layouts.
PROFILES = (
    BankProfile("nubank", ",", "UTF-8", True,
                (("Data", "date"), ("Valor", "amount"), ("Identificador", "id"),
                 ("Descrição", "description")),
                ("yyyy-MM-dd", "dd/MM/yyyy")),
    BankProfile("itau", ";", "ISO-8859-1", True,
                (("data", "date"), ("lançamento", "description"), ("documento", "id"),
                 ("valor (R$)", "amount")),
                ("d/M/yyyy", "yyyy-MM-dd"), ",", "."),
    BankProfile("santander", "\t", "UTF-8", False,
                (("Valor", "amount"), ("Data", "date"), ("Histórico", "description"),
                 ("Docto", "id")),
                ("MM-dd", "yyyyMMdd"), ","),
    BankProfile("inter", ";", "UTF-8", True,
                (("Data Lançamento", "date"), ("Histórico", "description"),
                 ("Valor", "amount"), ("Id", "id")),
                ("dd/MMM", "dd/MMM/yyyy"), ",", ".", "R$ "),
)
BANKS = [p.bank for p in PROFILES]


def render_date(d, fmt: str):
    """A date in one of the bank's formats (year-less formats drop the year;
    month names are Portuguese, with a year English)."""
    if "MMM" in fmt:
        months = F.array(*[F.lit(m) for m in (EN_MONTHS if "y" in fmt else PT_MONTHS)])
        parts = [F.lpad(F.dayofmonth(d).cast("string"), 2, "0"), F.element_at(months, F.month(d))]
        return F.concat_ws("/", *parts, *([F.year(d).cast("string")] if "y" in fmt else []))
    return F.date_format(d, fmt)


def render_dialect(df: DataFrame, profile: BankProfile) -> DataFrame:
    """Canonical truth ``(row_id, year, date, description, amount)`` ->
    the bank's text fields ``(row_id, bank, year, id_s, date_s, alt_date_s,
    description_s, amount_s)``; ``alt_date_s`` is the bank's other date form."""
    return df.select(
        "row_id", F.lit(profile.bank).alias("bank"), "year",
        F.col("row_id").cast("string").alias("id_s"),
        render_date(F.col("date"), profile.date_formats[0]).alias("date_s"),
        render_date(F.col("date"), profile.date_formats[-1]).alias("alt_date_s"),
        F.col("description").alias("description_s"),
        format_amount(F.col("amount"), profile.decimal_mark, profile.thousands,
                      profile.currency_prefix).alias("amount_s"))


#: Separates nothing in any layout: lines are written whole.
_LINE_SEP, _NO_QUOTE = "\u0001", "\u0000"


def _cell(c, profile: BankProfile):
    """A cell as it stands in the file: quoted if it holds the separator."""
    body = F.coalesce(c, F.lit(""))
    return F.when(F.contains(body, F.lit(profile.sep)), F.concat(F.lit('"'), body, F.lit('"'))).otherwise(body)


def write_bank_files(rendered: DataFrame, root: str) -> str:
    """Write one CSV family per bank under ``root/bank=<name>/year=<yyyy>/``.

    Lines are written as they are (the noise must survive the trip): NULL is an
    empty cell, ``surplus`` rows get one cell too many. Rows are rebalanced by
    year first, so that a year is a few full files at any number of tasks.
    """
    def write(p: BankProfile) -> None:
        cells = [_cell(F.col(f"{role}_s"), p) for _, role in p.columns]
        line = F.concat_ws(p.sep, *cells, F.when(F.col("surplus"), F.lit("extra")))
        part = rendered.filter(F.col("bank") == p.bank).select(line.alias(p.sep.join(p.names())), "year")
        (part.hint("rebalance", F.col("year")).write.mode("overwrite").partitionBy("year")
         .option("sep", _LINE_SEP).option("quote", _NO_QUOTE).option("encoding", p.encoding)
         .option("header", str(p.header).lower())
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
         .csv(f"{root}/bank={p.bank}"))

    # One independent write job per layout (options differ); submit them together.
    with ThreadPoolExecutor(max_workers=len(PROFILES)) as pool:
        for f in [pool.submit(write, p) for p in PROFILES]:
            f.result()
    return root


CORRUPT = "_corrupt_record"


def profile_schema(profile: BankProfile) -> T.StructType:
    """The file's own columns, the line where it does not fit them, and the
    year from the ``year=`` folder."""
    fields = [T.StructField(name, T.StringType()) for name, _ in profile.columns]
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType()), T.StructField("year", T.IntegerType())])


def canonical_columns(profile: BankProfile) -> list:
    """File columns -> canonical columns, with the profile's parsing.

    ``corrupt`` holds a line with too many or too few cells; its cells are kept
    as read and its parsed values are NULL."""
    role = {r: F.col(f"`{n}`") for n, r in profile.columns}
    fits = F.col(CORRUPT).isNull()
    return [
        F.when(fits, role["id"].try_cast("bigint")).alias("row_id"),
        F.lit(profile.bank).alias("bank"),
        F.col("year").cast("int").alias("year"),
        F.col("_metadata.file_path").alias("file"),
        role["id"].alias("id_raw"),
        role["date"].alias("date_raw"),
        role["description"].alias("description_raw"),
        role["amount"].alias("amount_raw"),
        F.col(CORRUPT).alias("corrupt"),
        F.when(fits, parsed_date(role["date"], profile, F.col("year"))).alias("date"),
        F.when(fits, parsed_amount(role["amount"], profile)).alias("amount")]


def parsed_date(c, profile: BankProfile, year):
    return normalize_date(c, profile.date_formats, year)


def parsed_amount(c, profile: BankProfile):
    return parse_amount(c, profile.decimal_mark, profile.thousands)


def by_profile(value):
    """``value(profile)`` of the row's own bank."""
    out = None
    for p in PROFILES:
        is_bank = F.col("bank") == p.bank
        out = F.when(is_bank, value(p)) if out is None else out.when(is_bank, value(p))
    return out


def read_profile(spark: SparkSession, root: str, profile: BankProfile) -> DataFrame:
    """S3 for one family: raw text columns by role, the folder year, the file."""
    raw = (spark.read.schema(profile_schema(profile))
           .option("sep", profile.sep).option("encoding", profile.encoding)
           .option("header", str(profile.header).lower()).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT)
           .csv(f"{root}/bank={profile.bank}"))
    return raw.select(*canonical_columns(profile))


def read_bank_csv(spark: SparkSession, root: str,
                  profiles: tuple[BankProfile, ...] = PROFILES) -> DataFrame:
    """S3 + K3: every bank's files as one canonical frame (``unionByName``)."""
    out = None
    for p in profiles:
        df = read_profile(spark, root, p)
        out = df if out is None else out.unionByName(df)
    return out


def write_normalized(df: DataFrame, path: str, fmt: str = "json") -> str:
    """Save normalized rows as JSON lines, CSV (with header) or parquet."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        # keep values exactly (the CSV writer trims whitespace by default)
        (w.option("header", "true").option("ignoreLeadingWhiteSpace", "false")
         .option("ignoreTrailingWhiteSpace", "false").csv(path))
    elif fmt == "parquet":
        w.parquet(path)
    else:
        w.json(path)
    return path


NORMALIZED_SCHEMA = ("row_id bigint, date string, merchant string, description string, "
                     "amount double, category string")


def read_normalized(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    r = spark.read.schema(NORMALIZED_SCHEMA)
    if fmt == "csv":
        return r.option("header", "true").csv(path)
    if fmt == "parquet":
        return r.parquet(path)
    return r.json(path)
