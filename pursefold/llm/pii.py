"""Personal data replaced by format-preserving pseudonyms, in DataFrame operations only.

Numbers and dates that are valid as what they look like go through a Feistel network keyed by a secret: a permutation of all
values of their format. Payment cards (Luhn) keep their number of digits and get a right check digit, telephone numbers keep
what stands before the last ten digits, addresses stay four octets, identity numbers nine digits, dates dates between 1800 and
2199. Spaces, brackets and dashes stay. Equal values give equal pseudonyms, however they are written, so they stay linked across
documents, and who has the key can take them back (`restore`). E-mail addresses, keys, tokens and passwords, which have no such
format, give way to a keyed digest, linked as well but not taken back. What isn't valid stays.

The secret is read by a subquery, from a table of one row or from a parameter, so that no plan and no event log prints it; without
one the job fails.

Null text stays null; texts without such data are unchanged. Everything is by row, so repeated rows are treated alike and
an empty table gives none. Columns of docs may have any names; its own `__text` and `__n_replaced` give way to the new ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pursefold.llm.common import shielded

ROUNDS = 10
#: The forms that are looked for, tried in this order.
FORMS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}",
    "key": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "password": r"(?<=password=)[^\s\"']+",
    "token": r"(?<=token = \")[^\s\"]+(?=\")",
    "address": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)",
    "iso_date": r"(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])",
    "other_date": r"(?<![\d./])\d{2}([./])\d{2}\1\d{4}(?!\d|[./]\d)",
    "identity": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[ .-]\d{4}(?!\d)",
    "card": r"(?<![\d])\d(?:[ -]?\d){12,18}(?!\d)",
}
ANY = "|".join(f"(?:{p})" for p in FORMS.values())


def digest(key: Column | str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *(p.cast("string") for p in parts)), 256)


def _number(hexes: Column) -> Column:
    return F.conv(F.substring(hexes, 1, 15), 16, 10).cast("long")


def feistel(key: Column | str, kind: str, a: Column, b: Column, many_a: Column, many_b: Column, restore: bool = False) -> Column:
    """A keyed permutation of pairs (a, b), 0 <= a < many_a, 0 <= b < many_b, as a struct; ROUNDS is even, so each half ends in its place."""

    def forth(s: Column, i: Column) -> Column:
        moved = F.pmod(s["a"] + _number(digest(key, F.lit(kind), s["ma"], s["mb"], i, s["b"])), s["ma"])
        return F.struct(s["b"].alias("a"), moved.alias("b"), s["mb"].alias("ma"), s["ma"].alias("mb"))

    def back(s: Column, i: Column) -> Column:
        moved = F.pmod(s["b"] - _number(digest(key, F.lit(kind), s["mb"], s["ma"], i, s["a"])), s["mb"])
        return F.struct(moved.alias("a"), s["a"].alias("b"), s["mb"].alias("ma"), s["ma"].alias("mb"))

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"), many_a.cast("long").alias("ma"), many_b.cast("long").alias("mb"))
    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(F.reverse(rounds) if restore else rounds, start, back if restore else forth)


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("long")


def permuted_digits(key: Column | str, kind: str, digits: Column, restore: bool = False) -> Column:
    """2 to 18 digits for as many."""
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")
    done = feistel(key, kind, F.substr(digits, F.lit(1), left), F.substr(digits, left + 1), _power(left), _power(n - left), restore)
    return F.concat(F.lpad(done["a"].cast("string"), left, F.lit("0")), F.lpad(done["b"].cast("string"), n - left, F.lit("0")))


def refilled(form: Column, digits: Column) -> Column:
    """The form with its digits replaced in order."""
    chars = F.filter(F.split(form, ""), lambda c: c != "")
    step = lambda s, c: F.when(c.rlike("^[0-9]$"), F.struct(F.concat(s["out"], F.substr(digits, s["k"], F.lit(1))).alias("out"), (s["k"] + 1).alias("k"))).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["k"].alias("k")))
    return F.aggregate(chars, F.struct(F.lit("").alias("out"), F.lit(1).alias("k")), step, lambda s: s["out"])


def _luhn_sum(digits: Column, twice_first: int) -> Column:
    """The sum of digits, every second one from the right doubled and, over 9, less 9; twice_first 0: the rightmost one too."""
    values = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: F.when(i % 2 == twice_first, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(values, F.lit(0), lambda s, x: s + x)


def pseudonym(found: Column, key: Column | str, restore: bool = False) -> Column:
    """For one match of the forms; null where it isn't valid."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    n = F.length(digits)
    card = F.substr(digits, F.lit(1), n - 1)
    body = permuted_digits(key, "card", card, restore)
    check = F.pmod(-_luhn_sum(body, 0), F.lit(10)).cast("string")
    head = F.substr(digits, F.lit(1), n - 10)
    phone = F.concat(head, permuted_digits(key, "phone", F.substr(digits, n - 9), restore))
    parts = F.transform(F.split(found, r"\."), lambda o: o.try_cast("int"))
    moved = feistel(key, "address", parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], F.lit(65536), F.lit(65536), restore)
    octet = lambda v, s: (F.floor(v / 256) if s else v % 256).cast("string")
    address = F.concat_ws(".", octet(moved["a"], 1), octet(moved["a"], 0), octet(moved["b"], 1), octet(moved["b"], 0))
    iso = found.rlike(r"^\d{4}-\d{2}-\d{2}$")
    dotted = F.substring(found, 3, 1) == "."  # day first with dots, month first with strokes
    piece = lambda at, size: F.substring(found, at, size)
    date = F.when(iso, found).when(dotted, F.concat_ws("-", piece(7, 4), piece(4, 2), piece(1, 2))).otherwise(F.concat_ws("-", piece(7, 4), piece(1, 2), piece(4, 2))).try_cast("date")
    # 400 years of the calendar are 146097 = 189 x 773 days.
    day = F.datediff(date, F.lit("1800-01-01").cast("date"))
    turned = feistel(key, "date", F.floor(day / 773), F.pmod(day, F.lit(773)), F.lit(189), F.lit(773), restore)
    new = F.date_add(F.lit("1800-01-01").cast("date"), (turned["a"] * 773 + turned["b"]).cast("int"))
    new = F.when(iso, F.date_format(new, "yyyy-MM-dd")).when(dotted, F.date_format(new, "dd.MM.yyyy")).otherwise(F.date_format(new, "MM/dd/yyyy"))
    secret = digest(key, F.lit("secret"), found)
    lettered = F.when(found.contains("@"), F.concat(F.lit("u"), F.substring(digest(key, F.lit("email"), F.lower(found)), 1, 12), F.lit("@example.com"))).when(
        found.rlike("^AKIA[0-9A-Z]{16}$"), F.concat(F.lit("AKIA"), F.upper(F.substring(secret, 1, 16)))
    )
    numeric = (
        F.when(found.rlike(r"^(\d{1,3}\.){3}\d{1,3}$"), F.when(~F.exists(parts, lambda o: o > 255), address))
        .when(iso | found.rlike(r"^\d{2}([./])\d{2}\1\d{4}$"), F.when((day >= 0) & (day < 146097), new))
        .when(found.rlike(r"^\d{3}-\d{2}-\d{4}$"), refilled(found, permuted_digits(key, "identity", digits, restore)))
        .when(found.rlike(r"^(\+\d{1,3}[ .-]?)?(\(\d{3}\) ?|\d{3}[.-])\d{3}[ .-]\d{4}$"), refilled(found, phone))
        .when(found.rlike(r"^\d([ -]?\d){12,18}$"), F.when(F.pmod(_luhn_sum(digits, 1), F.lit(10)) == 0, refilled(found, F.concat(body, check))))
        .otherwise(F.rpad(secret, F.length(found), secret))
    )
    out = F.coalesce(lettered, numeric)
    return F.when(lettered.isNotNull(), F.lit(None)).otherwise(numeric) if restore else out


def _with_key(docs: DataFrame, key: DataFrame | str) -> DataFrame:
    rows = docs.sparkSession.sql("SELECT * FROM VALUES (:secret) AS held(secret)", {"secret": key}) if isinstance(key, str) else key
    return docs.withColumn("__key", F.coalesce(rows.scalar().cast("string"), F.raise_error(F.lit("no key is given")).cast("string")))


def pseudonymised(docs: DataFrame, key: DataFrame | str, text: str = "text", restore: bool = False) -> DataFrame:
    """docs with new columns `__text` and `__n_replaced`. key: the secret, or a table of one row and column that holds it."""
    return shielded(docs.drop(*{"__text", "__n_replaced"} - {text}), lambda d: _pseudonymised(d, key, text, restore))


def _pseudonymised(docs: DataFrame, key: DataFrame | str, text: str, restore: bool) -> DataFrame:
    rows = _with_key(docs, key).withColumn("__found", F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    some = F.size("__found") > 0
    rows = rows.withColumn("__gaps", F.when(some, F.split(text, ANY, -1)))
    rows = rows.withColumn("__new", F.when(some, F.transform("__found", lambda m: pseudonym(m, F.col("__key"), restore))))
    ends = F.concat(F.zip_with("__new", "__found", lambda new, old: F.coalesce(new, old)), F.array(F.lit("")))
    whole = F.array_join(F.zip_with("__gaps", ends, lambda gap, end: F.concat(gap, end)), "")
    replaced = F.when(some, F.size(F.filter("__new", lambda x: x.isNotNull()))).otherwise(0)
    return rows.select(*docs.columns, F.when(some, whole).otherwise(F.col(text)).alias("__text"), replaced.alias("__n_replaced"))
