"""Format-preserving pseudonyms for personal numbers and dates: DataFrame functions only.

Card numbers (Luhn), IPv4 addresses, North American phone numbers, social security numbers, dates
and the local parts of e-mail addresses are found by pattern and validated. A valid value is
permuted within the valid values of its format by a keyed Feistel network, so one value has one
pseudonym in all documents, different ones have different ones, and separators stay in place.
Numbers in a fixed range are two digits of a mixed base, each moved by a hash of the other. Longer
ones are two strings of characters, each moved within its alphabet by a hash of the other string.
"""

from pyspark.sql import functions as F

from candlegrowth.llm.common import free_names

ROUNDS = 8  # even, so that the halves end where they began
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Stand for the digits 2 to 9 where a format allows no others.
LEADING, LEADING_MARKS = "23456789", "αβγδεζηθ"
LOW, LOW_MARKS = "01", "κλ"  # area codes of this class stay in it
KINDS = ("email", "address", "date", "ssn", "phone", "card")
PATTERNS = {
    "email": r"[0-9A-Za-z](?:[0-9A-Za-z._%+-]{0,62}[0-9A-Za-z])?@[0-9A-Za-z-]+(?:\.[0-9A-Za-z-]+)+",
    "address": r"(?<!\.)(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9A-Za-z])",
    "date": r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9A-Za-z])",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    # Area codes that begin with 0 or 1 belong to no region; they are taken after +1 or in brackets.
    "phone": r"(?:(?:\+1[ .-]?)?\([0-9]{3}\) ?|\+1[ .-]?[0-9]{3}[ .-]|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9A-Za-z])",
    "card": r"[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
}
ANY = r"(?<![0-9A-Za-z])(?:" + "|".join(PATTERNS[k] for k in KINDS) + ")"

#: The Gregorian calendar repeats after 146097 = 189 * 773 days; blocks begin in 1600, 2000, ...
CYCLE, CYCLE_SPLIT = 146097, (189, 773)


def _hash(key, *parts):
    """A keyed hash below 2 ** 48."""
    text = F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(F.encode(text, "UTF-8"), 256), 1, 12), 16, 10).cast("long")


def permute_number(number, split, key, kind):
    """A keyed permutation of 0 .. split[0] * split[1] - 1."""
    a, b = (F.lit(x).cast("long") for x in split)
    number = number.cast("long")

    def turned(s, turn):
        x = F.pmod(s["x"] + _hash(key, F.lit(kind), turn, s["y"]), s["mx"])
        return F.struct(s["y"].alias("x"), x.alias("y"), s["my"].alias("mx"), s["mx"].alias("my"))

    halves = F.struct((number % a).alias("x"), F.floor(number / a).cast("long").alias("y"), a.alias("mx"), b.alias("my"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), halves, turned, lambda s: s["x"] + s["y"] * s["mx"]
    )


def _moved(c, by):
    """A character moved on within its alphabet."""
    out = c
    for alphabet in (DIGITS, LOWER, UPPER, LEADING_MARKS, LOW_MARKS):
        at = F.call_function("instr", F.lit(alphabet), c)
        to = F.pmod(at - 1 + by, F.lit(len(alphabet))) + 1
        out = F.when(at > 0, F.call_function("substr", F.lit(alphabet), to.cast("int"), F.lit(1))).otherwise(out)
    return out


def permute_text(text, key, kind):
    """A keyed permutation of the texts of the same pattern of digits, small and capital letters."""
    chars = F.split(text, "")
    n = F.size(chars)
    half = F.floor(n / 2).cast("int")

    def turned(s, turn):
        other = F.array_join(s["y"], "")
        moved = F.transform(s["x"], lambda c, i: _moved(c, _hash(key, F.lit(kind), turn, i, other)))
        return F.struct(s["y"].alias("x"), moved.alias("y"))

    halves = F.struct(
        F.slice(chars, F.lit(1), half).alias("x"), F.slice(chars, half + 1, n - half).alias("y")
    )
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), halves, turned, lambda s: F.array_join(F.concat(s["x"], s["y"]), "")
    )


def _only(text, kept="0-9"):
    return F.regexp_replace(text, f"[^{kept}]", "")


def _refilled(text, new, kept="0-9"):
    """The text with its characters of the class replaced in turn by those of `new`."""
    return F.array_join(
        F.transform(
            F.split(text, ""),
            lambda c, i: F.when(
                c.rlike(f"[{kept}]"),
                F.call_function("substr", new, F.length(_only(F.call_function("substr", text, F.lit(1), i + 1), kept)), F.lit(1)),
            ).otherwise(c),
        ),
        "",
    )


def luhn(digits):
    """The Luhn sum of a text of digits."""
    n = F.length(digits)
    parts = F.transform(
        F.split(digits, ""),
        lambda c, i: F.when((n - i) % 2 == 1, c.cast("int")).otherwise(
            (c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5)
        ).cast("int"),
    )
    return F.aggregate(parts, F.lit(0), lambda s, x: s + x)


def _card(text, key):
    digits = _only(text)
    body = permute_text(F.call_function("substr", digits, F.lit(1), F.length(digits) - 1), key, "card")
    last = F.pmod(-luhn(F.concat(body, F.lit("0"))), F.lit(10))
    valid = (luhn(digits) % 10 == 0) & ~digits.rlike("^0+$")
    return F.when(valid, _refilled(text, F.concat(body, last.cast("string")))).otherwise(text)


def _address(text, key):
    parts = F.transform(F.split(text, r"\."), lambda x: x.cast("int"))
    whole = ((parts[2] * 256 + parts[3]).cast("long") * 65536) + parts[0] * 256 + parts[1]
    new = permute_number(whole, (65536, 65536), key, "address")
    low, high = new % 65536, F.floor(new / 65536)
    valid = F.forall(parts, lambda x: x < 256) & ~text.rlike(r"(^|\.)0[0-9]")
    out = F.concat_ws(".", *[
        x.cast("int").cast("string") for x in (F.floor(low / 256), low % 256, F.floor(high / 256), high % 256)
    ])
    return F.when(valid, out).otherwise(text)


def _phone(text, key):
    country = text.startswith("+")
    digits = _only(text)
    own = F.when(country, F.call_function("substr", digits, F.lit(2))).otherwise(digits)
    part = lambda s, n: F.call_function("substr", own, F.lit(s), F.lit(n))
    lead = lambda s: F.translate(part(s, 1), LEADING + LOW, LEADING_MARKS + LOW_MARKS)
    new = permute_text(F.concat(lead(1), part(2, 2), lead(4), part(5, 6)), key, "phone")
    new = F.translate(new, LEADING_MARKS + LOW_MARKS, LEADING + LOW)
    return _refilled(text, F.when(country, F.concat(F.lit("1"), new)).otherwise(new))


def _ssn(text, key):
    area, group, serial = (F.split(text, "-")[i].cast("int") for i in range(3))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    rank = F.when(area > 666, area - 2).otherwise(area - 1).cast("long")
    new = permute_number(rank + F.lit(898).cast("long") * ((group - 1) + F.lit(99) * (serial - 1)), (898, 99 * 9999), key, "ssn")
    rank, rest = new % 898, F.floor(new / 898)
    area = F.when(rank > 664, rank + 2).otherwise(rank + 1)
    pad = lambda x, n: F.lpad(x.cast("int").cast("string"), n, "0")
    return F.when(valid, F.concat_ws("-", pad(area, 3), pad(rest % 99 + 1, 2), pad(F.floor(rest / 99) + 1, 4))).otherwise(text)


def _date(text, key):
    """ISO dates, month/day/year and day.month.year; parts of one digit ask for unpadded ones."""
    parts = F.split(text, r"[-/.]")
    iso, slash = text.contains("-"), text.contains("/")
    year = F.when(iso, parts[0]).otherwise(parts[2])
    month = F.when(iso | ~slash, parts[1]).otherwise(parts[0])
    day = F.when(iso, parts[2]).when(slash, parts[1]).otherwise(parts[0])
    known = F.call_function("try_to_date", F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), F.lit("yyyy-MM-dd"))
    begin = F.lit("2000-01-01").cast("date")
    days = F.datediff(known, begin).cast("long")
    block = F.floor(days / CYCLE)
    new = permute_number(days - block * CYCLE, CYCLE_SPLIT, key, "date") + block * CYCLE
    found = F.date_add(begin, new.cast("int"))
    short = text.rlike("^[0-9][/.]|[/.][0-9][/.]")
    shaped = F.when(iso, F.date_format(found, "yyyy-MM-dd"))
    for is_short in (True, False):
        for is_slash in (True, False):
            m, d = ("M", "d") if is_short else ("MM", "dd")
            shape = f"{m}/{d}/yyyy" if is_slash else f"{d}.{m}.yyyy"
            shaped = shaped.when((short == is_short) & (slash == is_slash), F.date_format(found, shape))
    return F.when(known.isNotNull() & (year >= "1200"), shaped).otherwise(text)


def _email(text, key):
    local = F.substring_index(text, "@", 1)
    new = permute_text(_only(local, "0-9A-Za-z"), key, "email")
    return F.concat(_refilled(local, new, "0-9A-Za-z"), F.call_function("substr", text, F.length(local) + 1))


_MAKERS = {"email": _email, "address": _address, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}


def pseudonym(text, key):
    """The pseudonym of a found value; the value itself where it is not valid."""
    out = text
    for kind in reversed(KINDS):
        out = F.when(text.rlike(f"^(?:{PATTERNS[kind]})$"), _MAKERS[kind](text, key)).otherwise(out)
    return out


def pseudonymise(documents, key, text_column="text"):
    """All columns of the documents and `_pseudonymised`, a struct of the text with pseudonyms in the
    place of valid values, and n_values, the number of valid values found.

    A NULL text stays NULL with 0 values. Overlapping candidates are taken from the left, in the
    order of KINDS. Equal values get equal pseudonyms under one key, in all rows.
    """
    text = F.col(text_column).cast("string")
    some = text.rlike(r"[0-9@]")
    none = F.array().cast("array<string>")
    hits, new = free_names(documents, 2)
    found = documents.withColumn(hits, F.when(some, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(none))
    found = found.withColumn(new, F.transform(hits, lambda x: pseudonym(x, key)))
    gaps = F.split(text, ANY, -1)
    pieces = F.transform(gaps, lambda x, i: F.concat(x, F.coalesce(F.get(F.col(new), i), F.lit(""))))
    changed = F.size(F.filter(F.zip_with(hits, new, lambda x, y: x != y), lambda x: x))
    return found.withColumn(
        "_pseudonymised",
        F.struct(
            F.when(F.size(hits) > 0, F.array_join(pieces, "")).otherwise(text).alias("text"),
            F.greatest(changed, F.lit(0)).alias("n_values"),
        ),
    ).drop(hits, new)


def op4_pseudonyms(spark, folder, key="a key for tests"):
    """All documents with pseudonyms; in use the key is a secret of the caller."""
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return pseudonymise(documents, key).select("doc_id", "_pseudonymised.text", "_pseudonymised.n_values")
