"""Format-preserving pseudonyms of private numbers, dates and addresses, by a keyed Feistel network.

A value is first validated (check digits, number ranges, calendar) and then written as symbols, each
with its own number of values: a digit has 10, a letter 26, an octet 256, a place in the calendar two
symbols of 189 and 773. A Feistel network permutes the symbols: in each round one half is shifted,
symbol by symbol, by a keyed hash of the other half. So a value becomes another valid value of the
same format, equal values become equal pseudonyms in all documents however they are spaced, and the
key undoes it. Check digits are worked out anew.

Only built-in expressions run here, and no row moves: there is no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
# Days of 400 Gregorian years, 189 * 773; the cycle of a date starts in a year 1 + 400 * n + 200.
CYCLE = (189, 773)
CYCLE_START = "1801-01-01"

# Days after the 12th of a month in that time, 9 * 9833: those that can only be read day first.
LATE_CYCLE = (9, 9833)
# Length of account numbers by country.
IBAN_SIZES = {
    15: "NO", 16: "BE", 18: "DK FO FI GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK MN", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _sized(size: int, countries: str) -> str:
    """An account number of one length, in groups of four or without spaces."""
    groups, rest = divmod(size - 4, 4)
    last = rf" ?[A-Z0-9]{{{rest}}}" if rest else ""
    return rf"(?:{countries.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{last}"


# What stands before the @ of an address: letters, marks and digits of any script, and some signs.
LOCAL = r"[\p{L}\p{M}\p{N}_.+%-]"
# Runs of letters and digits whose members become one another: their first code points and sizes. Fixed values:
# ASCII; Latin-1 and the mixed-case pairs behind it; Greek, Cyrillic, Hebrew, Arabic, Thai; kana, CJK, Hangul.
RUNS = [
    (0x30, 10), (0x41, 26), (0x61, 26), (0xC0, 23), (0xD8, 7), (0xDF, 24), (0xF8, 8), (0x100, 128), (0x391, 17), (0x3A3, 7),
    (0x3AC, 35), (0x410, 32), (0x430, 32), (0x450, 16), (0x5D0, 27), (0x621, 26), (0x641, 10), (0xE01, 46), (0x3041, 86),
    (0x30A1, 90), (0x4E00, 20992), (0xAC00, 11172),
]
# Fixed formats. Each match is one value; what stands around it must not continue it. Loops over groups without a
# bound are possessive: they do not recurse, however long a text is.
PATTERNS = {
    "email": rf"(?<!{LOCAL}){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "iban": r"(?<![A-Za-z0-9])(?:" + "|".join(_sized(*x) for x in IBAN_SIZES.items())
    + r"|[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?)(?![A-Za-z0-9])",
    "date": r"(?<![\d./-])(?:\d{4}[-/.]\d{1,2}[-/.]\d{1,2}|\d{1,2}[-/.]\d{1,2}[-/.]\d{4})(?![-/.]?\d)",
    "ip": r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?!-?\d)",
    "phone": r"(?<![\d+])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)",
    "abroad": r"(?<![\d+])\+\d{1,3}[ .-](?:\d{2,4}[ .-]?){2,5}(?<=\d)(?!\d)",
    "card": r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)",
}
# A match is a whole run of digits, so that no card is cut by what stands before it.
ANY = "|".join((PATTERNS | {"card": r"(?<!\d)\d(?:[ -]?\d){12,}+"}).values())
# A card within a longer run: no group but the last has less than three digits.
CARD_PART = r"^\d{3,}(?:[ -]\d{3,})*(?:[ -]\d{1,2})?$"
# The most pieces, separators counted, that a value within a match has.
PIECES = 37
# A text without these holds no value at all, and is not searched.
HINT = r"[0-9@]"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def numbers(text: Column) -> Column:
    """The digits of a text as numbers."""
    return F.transform(chars(F.regexp_replace(text, r"[^0-9]", "")), lambda c: c.cast("int"))


def symbol(value: Column, size) -> Column:
    return F.struct(value.cast("long").alias("v"), F.lit(size).cast("long").alias("r"))


def feistel(symbols: Column, kind: Column, key: str, back: bool = False) -> Column:
    """The permuted values of an array of (value v, number of values r); ``back`` undoes it."""
    def step(now: Column, number: Column) -> Column:
        half = F.floor(F.size(now) / 2).cast("int")
        first = number % 2 == 0
        other = F.when(first, F.slice(now, half + 1, F.size(now))).otherwise(F.slice(now, F.lit(1), half))
        name = F.concat_ws("|", F.lit(key), kind, number, F.array_join(F.transform(other, lambda x: x["v"].cast("string")), ","))

        def shifted(salt: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                digest = F.substring(F.sha2(F.concat_ws("|", salt, i), 256), 1, 14)
                by = F.conv(digest, 16, 10).cast("long") % x["r"]
                moved = F.pmod(x["v"] - by if back else x["v"] + by, x["r"])
                return F.struct(F.when((i < half) == first, moved).otherwise(x["v"]).alias("v"), x["r"].alias("r"))

            return F.transform(now, one)

        return let(name, shifted)

    order = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if back else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.transform(F.aggregate(order, symbols, step), lambda x: x["v"])


def refilled(text: Column, pattern: str, new: Column) -> Column:
    """``text`` with its characters that match ``pattern`` replaced in turn by the strings ``new``."""
    def put(state: Column, char: Column) -> Column:
        hit = char.rlike(pattern)
        return F.struct(
            F.concat(state["out"], F.when(hit, F.get(new, state["at"])).otherwise(char)).alias("out"),
            (state["at"] + hit.cast("int")).alias("at"),
        )

    return F.aggregate(chars(text), F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), put, lambda s: s["out"])


def strings(values: Column) -> Column:
    return F.transform(values, lambda v: v.cast("string"))


def luhn_sum(digits: Column) -> Column:
    """Sum of the digits with every second doubled, the last one left as it is."""
    def add(total: Column, x: Column) -> Column:
        doubled = x["d"] * 2
        return total + F.when(x["i"] % 2 == 0, x["d"]).when(doubled > 9, doubled - 9).otherwise(doubled)

    turned = F.transform(F.reverse(digits), lambda d, i: F.struct(d.cast("int").alias("d"), i.alias("i")))
    return F.aggregate(turned, F.lit(0), add)


def card(text: Column, key: str, back: bool) -> Column:
    """13 to 19 digits with a right check digit; the check digit follows from the others."""
    def new(digits: Column) -> Column:
        body = F.transform(F.slice(digits, F.lit(1), F.size(digits) - 1), lambda d: symbol(d, 10))

        def closed(moved: Column) -> Column:
            check = F.pmod(F.lit(10) - luhn_sum(F.concat(moved, F.array(F.lit(0).cast("long")))) % 10, F.lit(10))
            return refilled(text, "[0-9]", strings(F.concat(moved, F.array(check.cast("long")))))

        return F.when(luhn_sum(digits) % 10 == 0, let(feistel(body, F.lit("card"), key, back), closed))

    return let(numbers(text), new)


def iban_rest(text: Column) -> Column:
    """Remainder by 97 of an account number read as digits, letters as 10 to 35, the head moved back."""
    turned = F.concat(F.substr(text, F.lit(5)), F.substring(text, 1, 4))

    def add(rest: Column, char: Column) -> Column:
        digit = char.rlike("[0-9]")
        value = F.ascii(char)
        return F.when(digit, (rest * 10 + value - 48) % 97).otherwise((rest * 100 + value - 55) % 97)

    return F.aggregate(chars(turned), F.lit(0), add)


def iban(text: Column, key: str, back: bool) -> Column:
    """Account numbers with right check digits; country kept, letters stay letters."""
    def new(plain: Column) -> Column:
        body = F.substr(plain, F.lit(5))
        marks = F.transform(chars(body), lambda c: F.when(c.rlike("[0-9]"), symbol(F.ascii(c) - 48, 10)).otherwise(symbol(F.ascii(c) - 65, 26)))

        def written(moved: Column) -> Column:
            both = F.zip_with(marks, moved, lambda m, v: F.when(m["r"] == 10, F.char(v + 48)).otherwise(F.char(v + 65)))
            def headed(other: Column) -> Column:
                check = F.lit(98) - iban_rest(F.concat(F.substring(plain, 1, 2), F.lit("00"), other))
                whole = F.concat(F.substring(plain, 1, 2), F.lpad(check.cast("string"), 2, "0"), other)
                return refilled(text, "[A-Z0-9]", chars(whole))
            return let(F.array_join(both, ""), headed)

        return F.when(iban_rest(plain) == 1, let(feistel(marks, F.concat(F.lit("iban"), F.substring(plain, 1, 2)), key, back), written))

    return let(F.regexp_replace(text, " ", ""), new)


def ip(text: Column, key: str, back: bool) -> Column:
    """Four numbers up to 255."""
    def new(parts: Column) -> Column:
        moved = feistel(F.transform(parts, lambda p: symbol(p, 256)), F.lit("ip"), key, back)
        return F.when(F.forall(parts, lambda p: p < 256), F.array_join(strings(moved), "."))

    return let(F.transform(F.split(text, r"\."), lambda p: p.cast("int")), new)


def ssn(text: Column, key: str, back: bool) -> Column:
    """Area 001 to 899 without 666, group and serial not zero."""
    def new(p: Column) -> Column:
        area, group, serial = F.get(p, 0), F.get(p, 1), F.get(p, 2)
        marks = F.array(
            symbol(area - F.when(area > 666, 2).otherwise(1), 898), symbol(group - 1, 99), symbol(serial - 1, 9999)
        )
        good = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)

        def written(v: Column) -> Column:
            number = F.get(v, 0) + F.when(F.get(v, 0) >= 665, 2).otherwise(1)
            both = (number, 3), (F.get(v, 1) + 1, 2), (F.get(v, 2) + 1, 4)
            return F.concat_ws("-", *[F.lpad(n.cast("string"), width, "0") for n, width in both])

        return F.when(good, let(feistel(marks, F.lit("ssn"), key, back), written))

    return let(F.transform(F.split(text, "-"), lambda p: p.cast("int")), new)


def phone(text: Column, key: str, back: bool) -> Column:
    """Ten digits, area and exchange not starting with 0 or 1; a leading 1 is kept."""
    def new(digits: Column) -> Column:
        own = F.slice(digits, F.size(digits) - 9, F.lit(10))
        marks = F.transform(own, lambda d, i: F.when(i.isin(0, 3), symbol(d - 2, 8)).otherwise(symbol(d, 10)))
        good = (F.get(own, 0) > 1) & (F.get(own, 3) > 1)

        def written(moved: Column) -> Column:
            mine = F.transform(moved, lambda v, i: F.when(i.isin(0, 3), v + 2).otherwise(v))
            head = F.slice(digits, F.lit(1), F.size(digits) - 10)
            return refilled(text, "[0-9]", strings(F.concat(head.cast("array<long>"), mine)))

        return F.when(good, let(feistel(marks, F.lit("phone"), key, back), written))

    return let(numbers(text), new)


def abroad(text: Column, key: str, back: bool) -> Column:
    """A country code and 6 to 12 digits; the code is kept."""
    code = F.regexp_extract(text, r"^\+\d{1,3}", 0)
    rest = F.substr(text, F.length(code) + 1)

    def new(digits: Column) -> Column:
        moved = feistel(F.transform(digits, lambda d: symbol(d, 10)), F.concat(F.lit("abroad"), code), key, back)
        return F.when(F.size(digits).between(6, 12), F.concat(code, refilled(rest, "[0-9]", strings(moved))))

    return let(numbers(rest), new)


def date(text: Column, key: str, back: bool) -> Column:
    """A day of the calendar: year first, or day first with dots, or month first with slashes or dashes.

    With slashes or dashes, a day after the 12th may stand first; it becomes another such day.
    Another day of the same 400 years in the same layout; a number written with one digit may take
    two, so the key restores the day, and the text only if days and months have two digits.
    """
    parts = F.transform(F.split(text, "[-/.]"), lambda p: F.struct(p.cast("int").alias("n"), F.length(p).alias("w")))

    def new(p: Column) -> Column:
        year_first = F.get(p, 0)["w"] == 4
        late = ~year_first & ~text.contains(".") & (F.get(p, 0)["n"] > 12)
        day_first = text.contains(".") | late
        year = F.when(year_first, F.get(p, 0)["n"]).otherwise(F.get(p, 2)["n"])
        month = F.when(year_first | day_first, F.get(p, 1)["n"]).otherwise(F.get(p, 0)["n"])
        day = F.when(year_first, F.get(p, 2)["n"]).when(day_first, F.get(p, 0)["n"]).otherwise(F.get(p, 1)["n"])
        iso = F.concat_ws("-", *[F.lpad(x.cast("string"), w, "0") for x, w in ((year, 4), (month, 2), (day, 2))])
        good = F.try_to_date(iso, "yyyy-MM-dd")
        number = F.datediff(good, F.lit(CYCLE_START).cast("date"))
        size = CYCLE[0] * CYCLE[1]
        place, cycle = F.pmod(number, F.lit(size)), F.floor(number / size)
        marks = F.array(symbol(F.floor(place / CYCLE[1]), CYCLE[0]), symbol(place % CYCLE[1], CYCLE[1]))
        months = F.pmod((year - 1801) * 12 + month - 1, F.lit(4800))
        rank = place - 12 * (months + 1)  # among the days after the 12th
        late_marks = F.array(symbol(F.floor(rank / LATE_CYCLE[1]), LATE_CYCLE[0]), symbol(rank % LATE_CYCLE[1], LATE_CYCLE[1]))

        def late_place(number: Column) -> Column:
            """The place of a day after the 12th by its rank; its month is at most two from the average."""
            guess = F.floor(number * 4800 / (LATE_CYCLE[0] * LATE_CYCLE[1]))

            def fits(m: Column) -> Column:
                day_ = F.date_add(F.lit(CYCLE_START).cast("date"), (number + 12 * (m + 1)).cast("int"))
                return ((F.year(day_) - 1801) * 12 + F.month(day_) - 1 == m) & (F.dayofmonth(day_) > 12)

            return number + 12 * (F.get(F.filter(F.sequence(guess - 2, guess + 2), fits), 0) + 1)

        def late_written(v: Column) -> Column:
            return let(F.get(v, 0) * LATE_CYCLE[1] + F.get(v, 1), lambda number: let(late_place(number), at_place))

        def written(v: Column) -> Column:
            return at_place(F.get(v, 0) * CYCLE[1] + F.get(v, 1))

        def at_place(there: Column) -> Column:
            days = cycle * size + there
            return let(F.date_add(F.lit(CYCLE_START).cast("date"), days.cast("int")), laid_out)

        def laid_out(moved: Column) -> Column:
            y, m, d = F.year(moved), F.month(moved), F.day(moved)
            order = F.when(year_first, F.array(y, m, d)).when(day_first, F.array(d, m, y)).otherwise(F.array(m, d, y))
            fields = F.zip_with(p, order, lambda old, n: F.lpad(n.cast("string"), F.greatest(old["w"], F.length(n.cast("string"))), F.lit("0")))
            marks_between = F.array_join(chars(F.regexp_replace(text, r"[0-9]", "")), "")
            return F.concat(
                F.get(fields, 0), F.substring(marks_between, 1, 1), F.get(fields, 1),
                F.substring(marks_between, 2, 1), F.get(fields, 2),
            )

        kind = F.concat(F.lit("date"), cycle.cast("string"))
        is_date = good.isNotNull() & year.between(201, 9800)
        late_kind = F.concat(F.lit("late-date"), cycle.cast("string"))
        return F.when(is_date & late, let(feistel(late_marks, late_kind, key, back), late_written)).when(
            is_date, let(feistel(marks, kind, key, back), written)
        )

    return let(parts, new)


def run_of(code: Column) -> Column:
    """The run (first, size) a code point stands in; null if in none."""
    out = None
    for first, size in RUNS:
        here = F.struct(F.lit(first).alias("first"), F.lit(size).alias("size"))
        inside = code.between(first, first + size - 1)
        out = F.when(inside, here) if out is None else out.when(inside, here)
    return out


def email(text: Column, key: str, back: bool) -> Column:
    """Letters and digits before the @ become others of their run; the host is kept.

    Letters outside ``RUNS`` stay, the others change around them.
    """
    local, host = F.regexp_extract(text, r"^[^@]*", 0), F.regexp_extract(text, r"@.*$", 0)

    def known(c: Column) -> Column:
        return let(F.ascii(c), lambda code: F.struct(code.alias("code"), run_of(code).alias("run"), c.alias("c")))

    def written(own: Column) -> Column:
        mine = F.filter(own, lambda x: x["run"].isNotNull())
        marks = F.transform(mine, lambda x: symbol(x["code"] - x["run"]["first"], x["run"]["size"]))

        def placed(moved: Column) -> Column:
            new = F.zip_with(mine, moved, lambda x, v: F.decode(
                F.unhex(F.lpad(F.hex(x["run"]["first"] + v), 4, "0")), "UTF-16BE"))

            def put(state: Column, x: Column) -> Column:
                hit = x["run"].isNotNull()
                return F.struct(
                    F.concat(state["out"], F.when(hit, F.get(new, state["at"])).otherwise(x["c"])).alias("out"),
                    (state["at"] + hit.cast("int")).alias("at"),
                )

            return F.concat(F.aggregate(own, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), put, lambda s: s["out"]), host)

        return F.when(F.size(mine) > 0, let(feistel(marks, F.concat(F.lit("email"), F.lower(host)), key, back), placed))

    return let(F.transform(chars(local), known), written)


KINDS = {"email": email, "iban": iban, "date": date, "ip": ip, "ssn": ssn, "phone": phone, "abroad": abroad, "card": card}


def _named(kind: str, none: Column):
    return lambda new: F.when(
        new.isNotNull(), F.struct(F.lit(kind).alias("kind"), new.alias("new"))
    ).otherwise(none)


def pseudonym(value: Column, key: str, back: bool = False) -> Column:
    """(kind, new) of one value; kind is null, and new the value itself, if it is none or not valid."""
    none = F.struct(F.lit(None).cast("string").alias("kind"), value.alias("new"))
    out = none
    for kind, change in reversed(KINDS.items()):
        made = let(change(value, key, back), _named(kind, none))
        out = F.when(value.rlike(f"^(?:{PATTERNS[kind]})$"), made).otherwise(out)
    return out


def parts_of(value: Column, key: str, back: bool) -> Column:
    """Array of (kind, new) of a match that is no value as a whole: the values within it, and what is between.

    Values begin and end at spaces or dashes. From each place the longest is taken, and the search goes on behind it.
    """
    kind = "array<struct<kind:string,new:string>>"

    def searched(pieces: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            def tried(j: Column) -> Column:
                def named(part: Column) -> Column:
                    made = pseudonym(part, key, back)
                    return let(made, lambda m: F.struct(
                        m["kind"].alias("kind"), m["new"].alias("new"), j.alias("end"),
                        F.when(m["kind"] == "card", part.rlike(CARD_PART)).when(
                            m["kind"].isin("ssn", "date"),
                            (F.coalesce(F.get(pieces, i - 1), F.lit("")) != "-") & (F.coalesce(F.get(pieces, j + 1), F.lit("")) != "-"),
                        ).otherwise(m["kind"].isNotNull()).alias("good"),
                    ))

                return let(F.array_join(F.slice(pieces, i + 1, j - i + 1), ""), named)

            ends = F.sequence(F.least(i + PIECES - 1, F.size(pieces) - 1), i)
            best = F.get(F.filter(F.transform(ends, tried), lambda x: x["good"]), 0)

            def taken(b: Column) -> Column:
                piece = F.struct(b["kind"].alias("kind"), F.coalesce(b["new"], F.get(pieces, i)).alias("new"))
                return F.struct(F.concat(state["out"], F.array(piece)).alias("out"), (F.coalesce(b["end"], i) + 1).alias("next"))

            return F.when(i < state["next"], state).otherwise(let(best, taken))

        start = F.struct(F.array().cast(kind).alias("out"), F.lit(0).alias("next"))
        return F.aggregate(F.sequence(F.lit(0), F.size(pieces) - 1), start, step, lambda s: s["out"])

    return let(F.split(value, "(?<=[ -])|(?=[ -])"), searched)


def pseudonyms(match: Column, key: str, back: bool) -> Column:
    """Array of (kind, new) of a match: one if it is a value, or has no space or dash to be cut at."""
    def cut(whole: Column) -> Column:
        return F.when(whole["kind"].isNotNull() | ~match.rlike("[ -]"), F.array(whole)).otherwise(parts_of(match, key, back))

    return let(pseudonym(match, key, back), cut)


def hide_private(
    docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", back: bool = False
) -> DataFrame:
    """``id``, ``text`` with its private values replaced, and ``found``: array of (kind, new) in text order.

    Kinds are those of ``PATTERNS``. A value that fails its check stays as it is, and so do forms that are
    none of them: IPv6 addresses, ten bare digits, dates with month names, and years before 201 or after 9800. ``back`` with the
    same key restores the values. The first pattern that matches at a place decides; a match that
    fails its check is searched for shorter values that begin and end at its spaces or dashes. The key
    may not undo those: a new value can pass together with the digits behind it, as one in ten cards do.

    * Null texts stay null and empty texts empty, with nothing found; null ids and repeated rows stay.
    * Texts are searched whole. Repeated values get the same pseudonym in all rows.
    * No rows give no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    hint = F.col("text").rlike(HINT)
    matches = F.when(hint, F.regexp_extract_all(F.col("text"), F.lit(ANY), 0)).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("matches", matches)
    made = F.transform("matches", lambda m: pseudonyms(m, key, back))
    rows = rows.withColumn("made", F.when(F.size("matches") > 0, made))
    between = F.split(F.col("text"), ANY, -1)
    joined = F.array_join(F.flatten(F.zip_with(
        between, F.concat(F.col("made"), F.array(F.array().cast("array<struct<kind:string,new:string>>"))),
        lambda b, m: F.array(b, F.array_join(F.transform(m, lambda x: x["new"]), "")),
    )), "")
    text = F.when(F.size("matches") > 0, joined).otherwise(F.col("text"))
    found = F.coalesce(F.filter(F.flatten("made"), lambda m: m["kind"].isNotNull()), F.array().cast("array<struct<kind:string,new:string>>"))
    return rows.select("id", text.alias("text"), found.alias("found"))
