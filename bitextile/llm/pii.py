"""Format-preserving pseudonyms by keyed Feistel networks.

Found values are replaced by values of the same form: equal values get equal pseudonyms in every document, different ones
different ones, and who has the key can go back. The key is an argument without a default.

- card numbers (13 to 19 digits that pass the Luhn check; in one run, in groups of 4, of 4, 6 and 5, or with any single
  spaces or hyphens, the first of these that fits): all digits but the last are permuted, and the last is the check digit
  again; runs that fail the check, as times and serial numbers do, stay as they are and are not counted;
- North American phone numbers: their ten digits are permuted in place, however the number is written;
- social security numbers: permuted within the valid ranges; IPv4 addresses: among all addresses;
- dates 1900 to 2099, as YYYY-MM-DD, DD/MM/YYYY or MM/DD/YYYY: permuted among the days of these years, written in the same
  order, those with the day first among days over the 12th; dates that no calendar has stay;
- e-mail addresses (domain labels of up to 63 characters, 127 of them): letters and digits before the @ are permuted
  within their class.

There are two networks of ROUNDS rounds. Strings go through one on their halves: in each round the characters of one half
are shifted within their class by amounts that SHA-512 makes from the key, the kind, the round and the other half. Numbers
go through one of a mixed radix whose product is exactly the number of valid values.

One pattern finds all kinds from left to right: of values that overlap the one that begins first holds, and of those that
begin together the kind listed first. Its repetitions are bounded or possessive, so long texts neither exhaust the stack
nor are read more than a fixed number of times.

Built-in functions only. Defined results: a null text stays null; a text without such values, an empty or very long one
too, is treated like any other; repeated rows get equal results; other columns are kept, also where their names are those
used here (pseudonymize() adds n_found, or n_found_ if there is one already); an empty table gives no rows.
"""

from __future__ import annotations

import calendar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import unused
from .native import let

ROUNDS = 8
EDGE, TAIL = r"(?<![\w.+-])", r"(?![\w-]|\.\d)"
#: What is looked for, most specific first.
KINDS = {
    "email": r"(?<![A-Za-z0-9_.%+-])[A-Za-z0-9_.%+-]++@(?:[A-Za-z0-9-]{1,63}+\.){1,126}[A-Za-z]{2,63}",
    "date": EDGE + r"(?:(?:19|20)\d\d-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])/(?:0[1-9]|[12]\d|3[01])/(?:19|20)\d\d)" + TAIL,
    "ip": EDGE + r"(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)" + TAIL,
    "ssn": EDGE + r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}" + TAIL,
    "phone": r"(?<![\w.])(?:\+1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}" + TAIL,
    "card": EDGE + r"(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5}|\d(?:[ -]?\d){12,18})" + TAIL,
}
ANY = "|".join(KINDS.values())
LOWER, UPPER, DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
DAY_HALVES = (319, 229)  # their product: days from 1900-01-01 to 2099-12-31
LATE_HALVES = (323, 137)  # their product: days over the 12th of a month in these years
SSN_HALVES = (898, 99 * 9999)
IP_HALVES = (65536, 65536)


def kind_of(value: Column) -> Column:
    """The kind of a found value, read from its form; `run` for digits that are no card number."""
    forms = {"date": r"^(\d{4}-\d\d-\d\d|\d\d/\d\d/\d{4})$", "ip": r"^\d+\.\d+\.\d+\.\d+$", "ssn": r"^\d{3}-\d\d-\d{4}$", "phone": r"^(\+1[ .-]?)?(\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}$"}
    out = F.when(value.contains("@"), "email")
    for kind, form in forms.items():
        out = out.when(value.rlike(form), kind)
    passes = lambda d: F.substring(d, -1, 1).cast("int") == check_digit(F.substring(d, F.lit(1), F.length(d) - 1))
    return out.when(let(F.regexp_replace(value, r"\D", ""), passes), "card").otherwise("run")


def digest(key: str, kind: Column, i: Column, half: Column, block: Column | str = "0") -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), kind, i.cast("string"), half.cast("string"), F.lit(block) if isinstance(block, str) else block.cast("string")).cast("binary"), 512)


def number(hexed: Column, at: Column | int, width: int) -> Column:
    """The `at`-th run (from 0) of `width` hex digits as a number."""
    return F.conv(F.substring(hexed, at * width + 1, F.lit(width)) if isinstance(at, Column) else F.substring(hexed, at * width + 1, width), 16, 10).cast("long")


def shifted(s: Column, pad: Column, sign: int) -> Column:
    """Each letter and digit of s moved within its class by amounts from the digests in `pad`, 32 of them each."""

    def move(c: Column, i: Column) -> Column:
        by = number(F.get(pad, F.floor(i / 32).cast("int")), i % 32, 4)
        out = c
        for members in (LOWER, UPPER, DIGIT):
            at = F.position(c, F.lit(members))
            out = F.when(at > 0, F.substring(F.lit(members), (F.pmod(at - 1 + sign * by, F.lit(len(members))) + 1).cast("int"), F.lit(1))).otherwise(out)
        return out

    return F.array_join(F.transform(F.filter(F.split(s, ""), lambda c: c != ""), move), "")


def rounds(back: bool) -> Column:
    return F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if back else F.sequence(F.lit(0), F.lit(ROUNDS - 1))


def feistel(s: Column, key: str, kind: Column, back: bool = False) -> Column:
    """A string with its letters and digits permuted within their classes. A round shifts one half by the other and
    swaps them; ROUNDS is even, so they end in their places."""

    def shift(half: Column, by: Column, i: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor(F.length(half) / 32).cast("int"))
        return shifted(half, F.transform(blocks, lambda b: digest(key, kind, i, by, b)), -1 if back else 1)

    def step(p: Column, i: Column) -> Column:
        if back:
            return F.struct(shift(p["b"], p["a"], i).alias("a"), p["a"].alias("b"))
        return F.struct(p["b"].alias("a"), shift(p["a"], p["b"], i).alias("b"))

    half = lambda x: F.floor(F.length(x) / 2).cast("int")
    pair = let(s, lambda x: F.struct(F.substring(x, F.lit(1), half(x)).alias("a"), F.substring(x, half(x) + 1, F.length(x)).alias("b")))
    return F.aggregate(rounds(back), pair, step, lambda p: F.concat(p["a"], p["b"]))


def feistel_number(x: Column, m: Column, n: Column, key: str, kind: Column, back: bool = False) -> Column:
    """A number below m * n, permuted among these numbers."""

    def shift(half: Column, by: Column, i: Column) -> Column:
        return F.pmod(half + (-1 if back else 1) * number(digest(key, kind, i, by), 0, 8), F.when(i % 2 == 0, m).otherwise(n)).cast("long")

    def step(p: Column, i: Column) -> Column:
        if back:
            return F.struct(shift(p["b"], p["a"], i).alias("a"), p["a"].alias("b"))
        return F.struct(p["b"].alias("a"), shift(p["a"], p["b"], i).alias("b"))

    pair = let(x.cast("long"), lambda v: F.struct(F.floor(v / n).cast("long").alias("a"), F.pmod(v, n).cast("long").alias("b")))
    return F.aggregate(rounds(back), pair, step, lambda p: p["a"] * n + p["b"])


def put_back(form: Column, digits: Column) -> Column:
    """`form`, of a bounded length, with its digits replaced in order."""
    start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, c: Column) -> Column:
        is_digit = c.between("0", "9")
        return F.struct((acc["at"] + is_digit.cast("int")).alias("at"), F.concat(acc["out"], F.when(is_digit, F.substring(digits, acc["at"], F.lit(1))).otherwise(c)).alias("out"))

    return F.aggregate(F.filter(F.split(form, ""), lambda c: c != ""), start, step, lambda acc: acc["out"])


def check_digit(body: Column) -> Column:
    """The digit that makes body and it pass the Luhn check."""

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(body, F.length(body) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return acc + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(body) - 1), F.lit(0), add, lambda acc: (10 - acc % 10) % 10)


def renewed_string(value: Column, kind: Column, key: str, back: bool) -> Column:
    """The pseudonym of an e-mail address, phone number or card number."""

    def of(d: Column) -> Column:
        body = F.when(kind == "email", F.substring_index(value, "@", 1)).when(kind == "phone", F.substring(d, -10, 10)).otherwise(F.substring(d, F.lit(1), F.length(d) - 1))
        return let(body, lambda b: put(d, b))

    def put(d: Column, body: Column) -> Column:
        digits = lambda x: F.when(kind == "phone", F.concat(F.substring(d, F.lit(1), F.length(d) - 10), x)).otherwise(F.concat(x, check_digit(x).cast("string")))
        return let(feistel(body, key, kind, back), lambda x: F.when(kind == "email", F.concat(x, F.substring(value, F.length(body) + 1, F.length(value)))).otherwise(put_back(value, digits(x))))

    return let(F.regexp_replace(value, r"\D", ""), of)


def renewed_number(value: Column, kind: Column, key: str, back: bool) -> Column:
    """The pseudonym of a date, IPv4 address or social security number; impossible dates stay."""
    first, second, year = (F.substring(value, *x).cast("int") for x in ((1, 2), (4, 2), (7, 4)))
    iso = value.contains("-")
    day_first = ~iso & (first > 12)
    text = F.when(iso, value).when(day_first, F.format_string("%04d-%02d-%02d", year, second, first)).otherwise(F.format_string("%04d-%02d-%02d", year, first, second))
    day = F.when(kind == "date", F.try_to_date(text, "yyyy-MM-dd"))
    origin = F.lit("1900-01-01").cast("date")
    name = F.when((kind == "date") & day_first, "late").otherwise(kind)
    area, group, serial = (F.try_element_at(F.split(value, "-"), F.lit(k)).try_cast("long") for k in (1, 2, 3))
    quads = F.split(value, r"\.")
    place = (
        F.when(kind == "ip", F.aggregate(quads, F.lit(0).cast("long"), lambda acc, x: acc * 256 + x.try_cast("long")))
        .when(kind == "ssn", (area - 1 - (area > 666).cast("long")) * SSN_HALVES[1] + (group - 1) * 9999 + serial - 1)
        .otherwise(let(day, lambda d: F.datediff(d, origin) - F.when(day_first, 12 * ((F.year(d) - 1900) * 12 + F.month(d))).otherwise(0)))
    )
    radix = lambda k: F.when(name == "ip", IP_HALVES[k]).when(name == "ssn", SSN_HALVES[k]).when(name == "late", LATE_HALVES[k]).otherwise(DAY_HALVES[k]).cast("long")
    before = F.split(F.lit(",".join(map(str, _late_days()))), ",").cast("array<int>")  # late days before each month; folded

    def written(v: Column) -> Column:
        byte = lambda k: F.pmod(F.floor(v / 256 ** (3 - k)), F.lit(256)).cast("long").cast("string")
        a, rest = F.floor(v / SSN_HALVES[1]) + 1, F.pmod(v, F.lit(SSN_HALVES[1]))
        ssn = F.format_string("%03d-%02d-%04d", (a + (a >= 666).cast("long")).cast("long"), (F.floor(rest / 9999) + 1).cast("long"), (rest % 9999 + 1).cast("long"))
        late = F.date_add(origin, (v + 12 * F.size(F.filter(before, lambda x: x <= v))).cast("int"))
        early = F.date_add(origin, v.cast("int"))
        date = F.when(day_first, F.date_format(late, "dd/MM/yyyy")).when(iso, F.date_format(early, "yyyy-MM-dd")).otherwise(F.date_format(early, "MM/dd/yyyy"))
        return F.when(name == "ip", F.concat_ws(".", *map(byte, range(4)))).when(name == "ssn", ssn).otherwise(date)

    return let(place, lambda x: F.when(x.isNull(), value).otherwise(let(feistel_number(x, radix(0), radix(1), key, name, back), written)))


def renewed(value: Column, key: str, back: bool = False, kind: Column | None = None) -> Column:
    """The pseudonym of a found value; with `back`, the value of a pseudonym."""
    of = lambda k: F.when(k == "run", value).when(k.isin("email", "phone", "card"), renewed_string(value, k, key, back)).otherwise(renewed_number(value, k, key, back))
    return of(kind) if kind is not None else let(kind_of(value), of)


def _late_days() -> list[int]:
    """For each month from January 1900 to December 2099: days over the 12th in the months before it."""
    out = [0]
    for year in range(1900, 2100):
        for month in range(1, 13):
            out.append(out[-1] + calendar.monthrange(year, month)[1] - 12)
    return out[:-1]


def replaced(text: Column, key: str) -> Column:
    """(kinds, text): the kinds of the values found, in order, and the text with their pseudonyms."""

    def of(values: Column) -> Column:
        kinds = F.transform(values, kind_of)
        new = lambda ks: F.zip_with(values, ks, lambda v, k: renewed(v, key, kind=k))
        parts = lambda ks: F.zip_with(F.split(text, ANY, -1), new(ks), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
        done = let(kinds, lambda ks: F.struct(ks.alias("kinds"), F.array_join(parts(ks), "").alias("text")))
        return F.when(F.size(values) > 0, done).otherwise(F.struct(F.array().cast("array<string>").alias("kinds"), text.alias("text")))

    return let(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), of)


def pseudonymize(documents: DataFrame, key: str) -> DataFrame:
    """The documents with every value replaced, and n_found: how many there were of each kind, in order of KINDS."""
    made, n_found = unused(documents, "made"), unused(documents, "n_found")
    count = lambda k: F.size(F.filter(f"{made}.kinds", lambda x: x == k)).cast("long").alias(k)
    out = documents.withColumn(made, replaced(F.coalesce(F.col("text").cast("string"), F.lit("")), key)).withColumn(n_found, F.struct(*map(count, KINDS)))
    return out.withColumn("text", F.when(F.col("text").isNotNull(), F.col(f"{made}.text"))).drop(made)


def report(documents: DataFrame, key: str) -> DataFrame:
    """doc_id, counts by kind, the pseudonymous text and its digest."""
    p = pseudonymize(documents.select("doc_id", "text"), key)
    return p.select("doc_id", *(F.col(f"n_found.{k}").alias(f"n_{k}") for k in KINDS), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), "text")
