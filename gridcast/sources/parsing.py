"""A4 columnar JSON, A5 HTML list extraction, A6/A7 numeric text, A8 product codes.

All built-in expressions: the parse runs inside whole-stage codegen on the
executors, one document or page per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coerce_double(c) -> Column:
    """Bad text → NULL (never an error under ANSI), NaN → NULL."""
    v = _c(c).try_cast("double")
    return F.when(F.isnan(v), None).otherwise(v)


def locale_double(c) -> Column:
    """European number text ``1.234,56`` → 1234.56 (thousands '.', decimal ',')."""
    s = F.replace(F.replace(_c(c).cast("string"), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return s.try_cast("double")


def json_arrays_to_rows(df: DataFrame, doc_col: str, variables: Sequence[str], *, root: str = "hourly",
                        time_field: str = "time", suffix: str = "_previous_day1",
                        time_format: str = "yyyy-MM-dd'T'HH:mm", source: str | None = None,
                        keep: Sequence[str] = ()) -> DataFrame:
    """A4: ``{root: {time: [...], var[suffix]: [...]}}`` → one row per array position.

    Variables may carry ``suffix`` in the document; it is stripped in the output.
    The time text is parsed with ``time_format`` into an instant (H10).
    """
    fields = [T.StructField(time_field, T.ArrayType(T.StringType()))]
    for v in variables:
        fields.append(T.StructField(v, T.ArrayType(T.DoubleType())))
        if suffix:
            fields.append(T.StructField(v + suffix, T.ArrayType(T.DoubleType())))
    schema = T.StructType([T.StructField(root, T.StructType(fields))])
    d = df.select(*keep, F.from_json(F.col(doc_col), schema).alias("_doc"))
    arrays = [F.col(f"_doc.{root}.{time_field}").alias("_t")]
    for i, v in enumerate(variables):
        a = F.col(f"_doc.{root}.{v}")
        if suffix:
            a = F.coalesce(a, F.col(f"_doc.{root}.{v}{suffix}"))
        arrays.append(a.alias(f"_v{i}"))
    rows = d.select(*keep, F.inline(F.arrays_zip(*arrays)))
    out = [*keep, F.to_timestamp("_t", time_format).alias("ts")]
    out += [F.col(f"_v{i}").alias(v) for i, v in enumerate(variables)]
    if source is not None:
        out.append(F.lit(source).alias("source"))
    return rows.select(*out)


LIST_ITEM_PATTERN = r'<li><a href="([^"]*)">([^<]*)</a></li>'


def extract_list_items(df: DataFrame, html_col: str, *, pattern: str = LIST_ITEM_PATTERN, group: int = 2,
                       prefix: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """A5: repeating elements of an HTML column → ``(keep…, pos, item)`` rows.

    ``prefix`` keeps only items starting with it (the reference keeps rows whose
    first cell starts with ``QH-``). Positions are 0-based in document order.
    """
    items = F.regexp_extract_all(F.col(html_col), F.lit(pattern), F.lit(group))
    out = df.select(*keep, F.posexplode(items).alias("pos", "item"))
    if prefix is not None:
        out = out.filter(F.startswith(F.col("item"), F.lit(prefix)))
    return out


def encode_product_code(local_ts) -> Column:
    """A8 inverse: local quarter-hour start → ``QH-YYMMDD-NN`` (NN = 01…96)."""
    t = _c(local_ts)
    nn = (F.hour(t) * 4 + F.floor(F.minute(t) / 15) + 1).cast("int")
    return F.concat(F.lit("QH-"), F.date_format(t, "yyMMdd"), F.lit("-"), F.lpad(nn.cast("string"), 2, "0"))


def decode_product_code(code, tz: str = "Europe/Sofia") -> dict[str, Column]:
    """``QH-YYMMDD-NN`` → delivery date, quarter index, local start and UTC instant."""
    c = _c(code)
    day = F.to_date(F.substring(c, 4, 6), "yyMMdd")
    nn = F.substring(c, 11, 2).try_cast("int")
    local = F.to_timestamp(day) + F.make_dt_interval(F.lit(0), F.lit(0), (nn - 1) * 15)
    return {"delivery_date": day, "quarter": nn, "local_start": local,
            "ts": F.to_utc_timestamp(local, tz)}
