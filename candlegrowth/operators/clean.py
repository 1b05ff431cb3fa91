"""Typed candles, and the rows that do not parse."""

from pyspark.sql import functions as F

from candlegrowth import schema
from candlegrowth.functions import parse


CELLS = {
    # typed column: text column, whether a row needs it
    "time_utc": ("time_text", True),
    "open_price": ("open_text", True),
    "high_price": ("high_text", False),
    "low_price": ("low_text", False),
    "close_price": ("close_text", True),
    "volume": ("volume_text", False),
}


def _parse(name, text):
    if name == "time_utc":
        return parse.parse_time(F.col(text))
    return parse.parse_decimal(F.col(text))


def _reason(name, text, required):
    bad = F.col(name).isNull()
    if not required:
        bad = bad & F.col(text).isNotNull()
    return F.when(bad, F.lit(text.removesuffix("_text")))


def parse_candles(raw):
    """Add typed columns and `reject_reason`: the names of the bad cells, empty for a good row.

    A cell is bad when it holds text that does not parse, or when time, open or close is missing.
    A line with more or fewer cells than six is bad as a whole: `cells`. One bad row never stops a
    load; it is set apart.
    """
    typed = raw.withColumns({name: _parse(name, text) for name, (text, _) in CELLS.items()})
    reasons = [_reason(name, text, required) for name, (text, required) in CELLS.items()]
    if schema.CORRUPT in raw.columns:
        reasons.append(F.when(F.col(schema.CORRUPT).isNotNull(), F.lit("cells")))
    return typed.withColumn("reject_reason", F.concat_ws(",", *reasons))


def valid_rows(parsed):
    texts = [c for c in (*schema.RAW_CANDLES.names, schema.CORRUPT) if c in parsed.columns]
    return parsed.where(F.col("reject_reason") == "").drop("reject_reason", *texts)


def reject_rows(parsed):
    return parsed.where(F.col("reject_reason") != "").drop(*CELLS)
