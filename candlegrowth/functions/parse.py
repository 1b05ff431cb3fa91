"""Text cells and file paths to typed columns. All of it stays in built-in expressions."""

from pyspark.sql import functions as F

from candlegrowth import schema

_LEAST_INFINITE = 309  # digits of the least number that no double holds; so long a text is parsed twice


def parse_decimal(text):
    """Number with a decimal comma or point, in full precision; NULL where the cell is not a plain
    finite number."""
    plain = text.rlike(r"^[+-]?[0-9]+(?:[.,][0-9]+)?$")
    number = F.replace(text, F.lit(","), F.lit(".")).try_cast("double")
    finite = (F.length(text) < _LEAST_INFINITE) | (F.abs(number) < float("inf"))
    return F.when(plain & finite, number)


def parse_time(text):
    """Time in `yyyy-MM-dd HH:mm:ss`; NULL where the cell has another form.

    The result has no time zone, so months do not depend on the session's zone.
    """
    shape = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$")
    return F.when(shape, text.try_cast("timestamp_ntz"))


def time_to_text(time):
    return time.cast("string")


def decimal_to_text(number, scale=5):
    """Number as text with a decimal comma."""
    fixed = F.round(number, scale).cast(f"decimal(18,{scale})").cast("string")
    return F.replace(fixed, F.lit("."), F.lit(","))


def is_header(line, delimiter=schema.DELIMITER):
    return line.startswith(schema.HEADER_CELL + delimiter)


def decode_path(path):
    """Undo the URL encoding of `_metadata` paths; a plus sign stands for itself there.

    Most parts of a path hold nothing encoded and are passed on as they are.
    """
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(path.contains("%"), decoded).otherwise(path)


def path_part(path, position):
    """A segment of an encoded path, decoded. Counted from the end: 1 is the file name."""
    tail = F.substring_index(path, "/", -position)
    segment = tail if position == 1 else F.substring_index(tail, "/", 1)
    return decode_path(F.nullif(segment, F.lit("")))


def name_field(path, position):
    """A field of the file name between underscores, decoded; 1 is the first."""
    field = F.split_part(F.substring_index(path, "/", -1), F.lit("_"), F.lit(position))
    return decode_path(F.nullif(field, F.lit("")))


def stock_of_name(path):
    return decode_path(F.substring_index(F.substring_index(path, "/", -1), "_", 1))


def quote_side_of_name(path):
    return name_field(path, 3)


def year_of_name(path):
    """Year in the fourth field of the file name, else the first run of four digits."""
    def four_digits(text):
        return F.regexp_extract(text, r"(\d{4})", 1).try_cast("int")

    return F.coalesce(four_digits(name_field(path, 4)), four_digits(path_part(path, 1)))


def calendar_parts(time):
    return [
        F.year(time).alias("year"),
        F.month(time).alias("month"),
        F.dayofmonth(time).alias("day"),
    ]
