"""Requests as raw JSON text (F3, P9): lenient parse, typed checks, text kept beside numbers.

A line is parsed with all fields as text, so that a wrong type is an error of
its field and not of the line; a line that isn't one JSON object goes to the
corrupt-record column and from there to the rejected table, never to a failure
of the job. Everything is a column expression of the scan's stage.

Defined cases: a null or blank line is malformed; further fields are ignored; a
field that is JSON null counts as missing; an object or a list in a number's
place is not a number; ``NaN`` and infinities are not numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.operators.prep import q

CORRUPT = "_corrupt_record"
MALFORMED = "request: malformed"


def parse_json_requests(lines: DataFrame, fields: Sequence[str], line: str = "value") -> DataFrame:
    """the columns of ``lines``, each of ``fields`` as text, and the line itself in ``_corrupt_record`` where it's malformed."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields] + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(q(line), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # A list of objects, a bare value, an empty text or text after the object is no request either.
    text = F.btrim(q(line), F.lit(" \t\r\n"))
    bad = F.coalesce(~(text.startswith("{") & text.endswith("}")) | F.col(f"_request.{CORRUPT}").isNotNull() | F.col("_request").isNull(), F.lit(True))
    out = lines.withColumn("_request", parsed)
    return out.select(*[q(c) for c in lines.columns],
                      *[F.when(~bad, F.col("_request").getField(f)).alias(f) for f in fields],
                      F.when(bad, F.coalesce(q(line), F.lit(""))).alias(CORRUPT))


def number_of(c: Column) -> Column:
    """A text as a finite number, else null."""
    x = c.cast("string").try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def mixed_to_float(df: DataFrame, cols: Sequence[str], text_suffix: str = "_text") -> DataFrame:
    """Each column as a double, and beside it the text of values that are no number (null where it is one)."""
    out = df
    for c in cols:
        raw = q(c).cast("string")
        out = out.withColumn(c + text_suffix, F.when(number_of(raw).isNull(), raw)).withColumn(c, number_of(q(c)))
    return out


def json_request_errors(df: DataFrame, numeric_fields: Sequence[str], string_fields: Sequence[str] = (),
                        known: DataFrame | Callable[[], DataFrame] | None = None, known_field: str | None = None) -> DataFrame:
    """``errors`` ARRAY<STRING> of parsed requests; a malformed line has that error only.

    ``known`` is a table with the column ``known_field``, or a function that gives
    it: a function is called whenever this is, so a stream that checks each
    micro-batch sees what was registered since the one before.
    """
    checks: list[Column] = []
    for f in numeric_fields:
        num = number_of(q(f))
        checks += [F.when(q(f).isNull(), F.lit(f"{f}: missing")), F.when(q(f).isNotNull() & num.isNull(), F.lit(f"{f}: not a number")),
                   F.when(num < 0, F.lit(f"{f}: negative"))]
    checks += [F.when(q(f).isNull(), F.lit(f"{f}: missing")) for f in string_fields]
    out = df
    if known is not None and known_field:
        names = (known() if callable(known) else known).select(q(known_field).alias("_known")).distinct()
        out = out.join(names, q(known_field) == F.col("_known"), "left")
        checks.append(F.when(q(known_field).isNotNull() & F.col("_known").isNull(), F.lit(f"{known_field}: unknown")))
    errors = F.when(q(CORRUPT).isNotNull(), F.array(F.lit(MALFORMED))).otherwise(F.filter(F.array(*checks), lambda e: e.isNotNull()))
    return out.withColumn("errors", errors).drop("_known")
