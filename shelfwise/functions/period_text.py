"""Promotion periods written as text, such as '0101-0228' or '2.28-12.1', turned into dates."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.scalar import as_column

# The accepted forms, first match wins. Groups: start month, start day, end month, end day.
PERIOD_FORMS = {
    "mmdd-mmdd": r"(\d{2})(\d{2})-(\d{2})(\d{2})",
    "mdd-mdd": r"(\d)(\d{2})-(\d)(\d{2})",
    "yyyymmdd-yyyymmdd": r"\d{4}(\d{2})(\d{2})-\d{4}(\d{2})(\d{2})",
    "mm.dd-mm.dd": r"(\d{2})[./](\d{2})-(\d{2})[./](\d{2})",
    "m.dd-m.dd": r"(\d)\.(\d{2})-(\d)\.(\d{2})",
    "m.dd-mm.d": r"(\d)\.(\d{2})-(\d{2})\.(\d)",
    "mm.d-m.dd": r"(\d{2})\.(\d)-(\d)\.(\d{2})",
}


def parse_period(df: DataFrame, text: str, year: int | Column, prefix: bool = False) -> DataFrame:
    """Adds `period_form`, `start_date`, `end_date` and `period_status` for the text column.

    `year` is used for both ends in every form. `prefix=True` ignores trailing text after a match.
    Status: `ok`, `end_before_start`, `bad_date` (right form, impossible day; dates null) or
    `unknown_form`. The raw text stays in its column.
    """
    year = year if isinstance(year, Column) else F.lit(year)
    tail = "" if prefix else r"$"
    value = as_column(text)

    form = F.lit(None).cast("string")
    parts = F.lit(None).cast("array<string>")
    for name, pattern in reversed(PERIOD_FORMS.items()):
        anchored = f"^{pattern}{tail}"
        hit = value.rlike(anchored)
        groups = F.array(*[F.regexp_extract(value, anchored, i) for i in range(1, 5)])
        form = F.when(hit, F.lit(name)).otherwise(form)
        parts = F.when(hit, groups).otherwise(parts)

    def as_date(month: int, dom: int) -> Column:
        spelled = F.concat_ws(
            "-",
            F.lpad(year.cast("string"), 4, "0"),
            F.lpad(F.col("_parts")[month], 2, "0"),
            F.lpad(F.col("_parts")[dom], 2, "0"),
        )
        return F.when(F.col("_parts").isNotNull(), spelled.try_cast("date"))

    parsed = (
        df.withColumns({"period_form": form, "_parts": parts})
        .withColumns({"_start": as_date(0, 1), "_end": as_date(2, 3)})
        .withColumn("_valid", F.col("_start").isNotNull() & F.col("_end").isNotNull())
    )
    status = (
        F.when(F.col("period_form").isNull(), "unknown_form")
        .when(~F.col("_valid"), "bad_date")
        .when(F.col("_end") < F.col("_start"), "end_before_start")
        .otherwise("ok")
    )
    return parsed.withColumns(
        {
            "start_date": F.when(F.col("_valid"), F.col("_start")),
            "end_date": F.when(F.col("_valid"), F.col("_end")),
            "period_status": status,
        }
    ).drop("_parts", "_start", "_end", "_valid")


def date_in_text(text: str | Column, pattern: str = r"(\d{4}-\d{2}-\d{2})") -> Column:
    """First date found inside a text, null when there is none."""
    return F.regexp_extract(as_column(text), pattern, 1).try_cast("date")
