"""Format-preserving pseudonyms by keyed Feistel permutations, in DataFrame expressions only.

Numbers and dates that validate are replaced within their format: a card
number by another valid card number with the same separators, a date by another
date written the same way.  The permutation depends on the key, the kind and the
way of writing alone, so equal values get equal pseudonyms in every document,
different values different ones, and whoever has the key can invert it
(``undo``).  The key is a literal of the plan: whoever sees plans or event logs
sees it.

Ways to write a date have fewer dates than the calendar: a month of one digit, or
a month before a day that only then can be told.  And not all digits make a phone
number of each layout.  There the permutation is walked on until it comes to a
value of that way again, which keeps it a bijection.

A value is split in two halves; each of ROUNDS rounds adds a keyed hash of one
half to the other, modulo that half's range.  So every round is a bijection of
the format, whatever its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

ROUNDS = 10
#: Steps of a walk at most: two in nine dates at least are of any way of writing, so one in 10^43 walks would need more.
WALK = 400
#: Days from 1900-01-01 that dates are permuted within (to 2099-12-31): 17 times 4297.
DAYS = (17, 4297)
_SIDE, _END = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
#: A date is never read as part of a number before it.
_DATE = r"(?:\d{4}-\d{2}-\d{2}|\d{1,2}[./]\d{1,2}[./]\d{4})"
#: Between two digits of a phone number: a separator, a bracket, or both.
_GAP = rf"(?:[ ./-]|[ .-]?\(|\)[ .-]?)(?!{_DATE}{_END})"
#: Country codes by their own length, for numbers that nothing divides from it.
_CODE = r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}"
#: What a run of short numbers, in which cards are looked for, ends before.
_OTHER = rf"{_DATE}|\d{{3}}-\d{{2}}-\d{{4}}|\d{{3}}[ -]\d{{3}}-\d{{4}}|\d{{1,3}}\.\d{{1,3}}\.\d{{1,3}}\.\d{{1,3}}(?!\.\d)"
#: kind -> pattern; the first that fits a place is taken.
KINDS = {
    "iso_date": r"\d{4}-\d{2}-\d{2}",
    "ymd_date": r"\d{4}/\d{1,2}/\d{1,2}",
    "iban": r"[A-Z]{2}\d{2} ?[A-Z0-9]{4}(?: ?\d[0-9A-Z]{3}){1,6}(?: ?\d[0-9A-Z]{0,2})?",
    "day_date": r"\d{1,2}[./]\d{1,2}[./]\d{4}",
    "ssn": r"\d{3}-\d{2}-\d{4}",
    "phone": "|".join(
        [
            r"\+\d{1,3} \(\d{3}\) \d{3}-\d{4}",
            rf"\+1(?:(?:{_GAP})?\d){{10}}",
            rf"(?:\+[2-9]|00[1-9]\d{{0,2}}(?=[ ./(-]))(?:(?:{_GAP})?\d){{6,14}}",
            r"(?:1[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![.-]\d)",
            r"\(\d{2,5}\)[ ./-]?\d(?:[ .-]?\d){5,8}(?![.-]\d)",
            r"(?!\d{1,2}-\d{1,2}-\d{4})0[1-9](?:[ /-]\d(?:[ -]?\d){6,9}|\d[ /-]\d(?:[ -]?\d){5,8}|\d{2,3}[ /-]\d(?:[ -]?\d){4,7})(?![.-]\d)",
        ]
    ),
    "ip": r"(?<!\d\.)\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.\d)",
    "card": rf"(?=\d(?:[ -]?\d){{12}})\d++(?![A-Za-z])(?:[ -](?!(?:{_OTHER}){_END})\d++(?![A-Za-z]))*+",
}
#: A date before a time of day ends there; one in a path is none.
ANY = f"{_SIDE}(?:{KINDS['iso_date']}(?=T\\d\\d:?\\d\\d)|(?:" + "|".join([KINDS["iban"], KINDS["iso_date"], f"(?<!/){KINDS['ymd_date']}(?!/)", KINDS["day_date"], KINDS["ssn"], KINDS["ip"], f"(?<!\\+)(?:{KINDS['phone']})", KINDS["card"]]) + f"){_END})"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


class Undo(str):
    """A key by which every permutation is inverted."""


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, kind: Column) -> Column:
    """The pair (left below a, right below b), permuted."""

    def step(acc: Column, i: Column) -> Column:
        even = i % 2 == 0
        text = F.concat_ws("|", F.lit(key), kind, a.cast("string"), b.cast("string"), i.cast("string"), F.when(even, acc["r"]).otherwise(acc["l"]).cast("string"))
        mixed = F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")
        mixed = -mixed if isinstance(key, Undo) else mixed
        return F.struct(F.when(even, F.pmod(acc["l"] + mixed, a)).otherwise(acc["l"]).alias("l"), F.when(even, acc["r"]).otherwise(F.pmod(acc["r"] + mixed, b)).alias("r"))

    rounds = (ROUNDS - 1, 0) if isinstance(key, Undo) else (0, ROUNDS - 1)
    return F.aggregate(F.sequence(*map(F.lit, rounds)), F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), step)


def _digits(text: Column, key: str, kind: Column) -> Column:
    """A run of 2 to 30 digits, permuted among those of its length."""

    def halves(n: Column) -> Column:
        u = F.floor(n / 2).cast("int")
        ten = lambda k: F.pow(F.lit(10.0), k).cast("long")
        pair = feistel(F.substring(text, F.lit(1), u).cast("long"), F.substring(text, u + 1, n - u).cast("long"), ten(u), ten(n - u), key, kind)
        return _let(pair, lambda x: F.concat(F.lpad(x["l"].cast("string"), u, F.lit("0")), F.lpad(x["r"].cast("string"), n - u, F.lit("0"))))

    return _let(F.length(text), halves)


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a run of digits, the last one not doubled."""
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return acc + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)


def _fill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced in order."""
    zero = F.struct(F.lit(1).alias("i"), F.lit("").alias("out"))

    def add(acc: Column, ch: Column) -> Column:
        d = ch.rlike("[0-9]")
        return F.struct((acc["i"] + d.cast("int")).alias("i"), F.concat(acc["out"], F.when(d, F.substring(digits, acc["i"], F.lit(1))).otherwise(ch)).alias("out"))

    return F.aggregate(F.split(shape, ""), zero, add, lambda acc: acc["out"])


def _one_card(digits: Column, key: str) -> Column:
    """Another run of that length that passes Luhn."""
    body = _digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key, F.lit("card"))
    return _let(body, lambda x: F.concat(x, ((10 - _luhn(F.concat(x, F.lit("0"))) % 10) % 10).cast("string")))


def _card(token: Column, key: str) -> Column:
    """(number of cards, token with its cards replaced) of numbers with single blanks or hyphens between.

    A card is one number or several in a row that have 13 to 19 digits together
    and pass Luhn; of all ways to take such cards, the one that covers most digits.
    """
    step = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("size"))

    def cards(digits: Column, ends: Column) -> Column:
        def add(best: Column, j: Column) -> Column:
            """Most digits covered by cards up to the j-th end, and the size of the card that ends there (0: none)."""
            end = F.element_at(ends, j + 1)

            def ending(i: Column) -> Column:
                n = end - F.element_at(ends, i)
                fits = (n >= 13) & (n <= 19)
                valid = F.when(fits, _let(F.substring(digits, F.element_at(ends, i) + 1, n), lambda x: _luhn(x) % 10 == 0))
                return F.when(valid, F.struct((F.element_at(best, i)["covered"] + n).alias("covered"), n.alias("size")))

            none = F.struct(F.element_at(best, j)["covered"].alias("covered"), F.lit(0).alias("size"))
            found = F.transform(F.sequence(F.greatest(F.lit(1), j - 18), j), ending)
            return F.concat(best, F.array(F.array_max(F.concat(F.array(none), found))))

        def back(acc: Column, j: Column) -> Column:
            """From the last end to the first: the digits before acc.at are yet to be written."""
            end, size = F.element_at(ends, j + 1), F.element_at(acc["best"], j + 1)["size"]
            n = F.when(size > 0, size).otherwise(end - F.element_at(ends, j))
            part = F.substring(digits, end - n + 1, n)
            new = F.when(size > 0, _let(part, lambda x: _one_card(x, key))).otherwise(part)
            moved = F.struct((end - n).alias("at"), F.concat(new, acc["out"]).alias("out"), (acc["n"] + (size > 0).cast("int")).alias("n"), acc["best"].alias("best"))
            return F.when(acc["at"] == end, moved).otherwise(acc)

        numbers = F.sequence(F.lit(1), F.size(ends) - 1)
        best = F.aggregate(numbers, F.array(step), add)
        start = lambda b: F.struct(F.length(digits).alias("at"), F.lit("").alias("out"), F.lit(0).alias("n"), b.alias("best"))
        chosen = _let(best, lambda b: F.aggregate(F.reverse(numbers), start(b), back))
        return _let(chosen, lambda x: F.struct(x["n"].alias("n"), F.when(x["n"] > 0, _fill(token, x["out"])).alias("value")))

    sizes = F.transform(F.split(token, "[ -]"), lambda x: F.length(x))
    ends = F.aggregate(sizes, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    return _let(F.struct(F.regexp_replace(token, "[^0-9]", "").alias("digits"), ends.alias("ends")), lambda x: cards(x["digits"], x["ends"]))


def _day(y: Column, m: Column, d: Column) -> Column:
    """The date, or null if there is none or it is out of range."""
    date = F.try_to_date(F.concat_ws("-", F.lpad(y, 4, "0"), F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    return F.when((date >= F.lit("1900-01-01").cast("date")) & (date <= F.lit("2099-12-31").cast("date")), date)


def _moved(date: Column, key: str) -> Column:
    n = F.datediff(date, F.lit("1900-01-01").cast("date"))
    a, b = map(F.lit, DAYS)
    pair = feistel(F.floor(n / b), n % b, a.cast("long"), b.cast("long"), key, F.lit("date"))
    return F.when(date.isNotNull(), _let(pair, lambda x: F.date_add(F.lit("1900-01-01").cast("date"), (x["l"] * b + x["r"]).cast("int"))))


def _like(date: Column, sep: Column, day_first: Column) -> Column:
    part = lambda v, wide: F.when(wide, F.lpad(v.cast("string"), 2, "0")).otherwise(v.cast("string"))
    one, two = F.when(day_first["is"], F.day(date)).otherwise(F.month(date)), F.when(day_first["is"], F.month(date)).otherwise(F.day(date))
    return F.concat(part(one, day_first["wide1"]), sep, part(two, day_first["wide2"]), sep, F.year(date).cast("string"))


def _day_date(token: Column, key: str) -> Column:
    """Day first if that is a date, else month first. Order and padding of the fields stay, so the pseudonym is read the same way."""

    def fits(date: Column, way: Column) -> Column:
        one, two = F.when(way["is"], F.day(date)).otherwise(F.month(date)), F.when(way["is"], F.month(date)).otherwise(F.day(date))
        return (way["wide1"] | (one < 10)) & (way["wide2"] | (two < 10)) & (way["is"] | (F.day(date) > 12))

    def parts(p: Column) -> Column:
        by_day = _day(p[2], p[1], p[0])
        date = F.coalesce(by_day, _day(p[2], p[0], p[1]))
        sep = F.substring(F.regexp_replace(token, "[0-9]", ""), 1, 1)
        way = F.struct(by_day.isNotNull().alias("is"), (F.length(p[0]) == 2).alias("wide1"), (F.length(p[1]) == 2).alias("wide2"))

        def walked(x: Column) -> Column:
            steps = lambda start, n: F.aggregate(F.sequence(F.lit(1), F.lit(n)), start, lambda acc, _: F.when(fits(acc, x["way"]), acc).otherwise(_moved(acc, key)))
            # Few walks are long: the rest of the steps is looked at for those alone.
            found = _let(steps(_moved(x["date"], key), 16), lambda d: F.when(fits(d, x["way"]), d).otherwise(steps(d, WALK)))
            return F.when(x["date"].isNotNull(), _let(found, lambda d: _like(d, sep, x["way"])))

        return _let(F.struct(date.alias("date"), way.alias("way")), walked)

    return _let(F.split(token, "[./]"), parts)


def _ip(token: Column, key: str) -> Column:
    def parts(p: Column) -> Column:
        ok = F.forall(p, lambda x: (x.cast("int") <= 255) & ((F.length(x) == 1) | (F.substring(x, 1, 1) != "0")))
        pair = feistel(p[0].cast("long") * 256 + p[1].cast("long"), p[2].cast("long") * 256 + p[3].cast("long"), F.lit(65536).cast("long"), F.lit(65536).cast("long"), key, F.lit("ip"))
        return F.when(ok, _let(pair, lambda x: F.concat_ws(".", *(F.floor(v / 256).cast("string") if i else (v % 256).cast("string") for v in (x["l"], x["r"]) for i in (1, 0)))))

    return _let(F.split(token, "\\."), parts)


def _ssn(token: Column, key: str) -> Column:
    """Area 001-899 but 666, group 01-99, serial 0001-9999: each in its range, so the pseudonym validates too."""

    def parts(p: Column) -> Column:
        area, group, serial = (p[i].cast("long") for i in range(3))
        ok = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
        near = area - F.when(area > 666, 2).otherwise(1)
        pair = feistel(near * 99 + group - 1, serial - 1, F.lit(898 * 99).cast("long"), F.lit(9999).cast("long"), key, F.lit("ssn"))

        def made(x: Column) -> Column:
            a = F.floor(x["l"] / 99) + 1
            a = a + F.when(a >= 666, 1).otherwise(0)
            return F.concat_ws("-", F.lpad(a.cast("string"), 3, "0"), F.lpad((x["l"] % 99 + 1).cast("string"), 2, "0"), F.lpad((x["r"] + 1).cast("string"), 4, "0"))

        return F.when(ok, _let(pair, made))

    return _let(F.split(token, "-"), parts)


#: What is kept of a phone number: its country code, with a zero in brackets behind it, or the zero before an area.
_KEPT = (
    rf"^(?:(?:\+|00)(?:\d{{1,3}}(?=[ ./(-])|{_CODE})(?:[ .-]?\(0\))?|1(?=[ .-]?(?:\(\d{{3}}\)[ .-]?|\d{{3}}[ .-])\d{{3}}[ .-]\d{{4}}$)"
    r"|(?!(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}$)\(?0(?=[1-9]))"
)


def _walk(start: Column, step, fits) -> Column:
    """The first value that fits, from ``step(start)`` on. Few walks are long: the rest of the steps is looked at for those alone."""
    steps = lambda value, n: F.aggregate(F.sequence(F.lit(1), F.lit(n)), value, lambda acc, _: F.when(fits(acc), acc).otherwise(step(acc)))
    return _let(step(start), lambda one: F.when(fits(one), one).otherwise(_let(steps(one, 8), lambda d: F.when(fits(d), d).otherwise(steps(d, WALK)))))


def _phone(token: Column, key: str) -> Column:
    """Country code and layout kept; all other digits permuted together, among those with which the number is read the same way."""
    others = "|".join(KINDS[k] for k in ("iso_date", "day_date", "ssn", "ip"))

    def made(x: Column) -> Column:
        whole = lambda digits: F.concat(x["kept"], _fill(x["rest"], digits))
        same = lambda t: t.rlike(f"^(?:{KINDS['phone']})$") & ~t.rlike(f"^(?:{others})$") & (F.regexp_extract(t, _KEPT, 0) == x["kept"])
        digits = F.regexp_replace(x["rest"], "[^0-9]", "")
        return whole(_walk(digits, lambda d: _digits(d, key, F.lit("phone")), lambda d: _let(whole(d), same)))

    return _let(F.regexp_extract(token, _KEPT, 0), lambda kept: _let(F.struct(kept.alias("kept"), F.substring(token, F.length(kept) + 1, F.length(token)).alias("rest")), made))


def _ymd_date(token: Column, key: str) -> Column:
    """Year first; the padding of month and day stays."""

    def parts(p: Column) -> Column:
        wide = lambda i: F.length(p[i]) == 2
        fits = lambda d: (wide(1) | (F.month(d) < 10)) & (wide(2) | (F.day(d) < 10))
        text = lambda v, is_wide: F.when(is_wide, F.lpad(v.cast("string"), 2, "0")).otherwise(v.cast("string"))
        like = lambda d: F.concat_ws("/", F.lpad(F.year(d).cast("string"), 4, "0"), text(F.month(d), wide(1)), text(F.day(d), wide(2)))
        return _let(_day(p[0], p[1], p[2]), lambda date: F.when(date.isNotNull(), _let(_walk(date, lambda d: _moved(d, key), fits), like)))

    return _let(F.split(token, "/"), parts)


def _mod97(text: Column) -> Column:
    """The remainder by 97 of letters and digits, a letter counting as two digits from 10 on."""
    value = lambda ch: F.when(ch.rlike("[0-9]"), F.try_to_number(ch, F.lit("9")).cast("int")).otherwise(F.ascii(ch) - 55)
    return F.aggregate(F.split(text, ""), F.lit(0), lambda acc, ch: (acc * F.when(ch.rlike("[0-9]"), 10).otherwise(100) + value(ch)) % 97)


def _mod97_ok(token: Column) -> Column:
    plain = F.replace(token, F.lit(" "), F.lit(""))
    return _let(plain, lambda x: _mod97(F.concat(F.substring(x, F.lit(5), F.length(x)), F.substring(x, 1, 4))) == 1)


def _iban(token: Column, key: str) -> Column:
    """(number of values, token with an account number replaced): country, letters and blanks are kept, digits permuted, check digits made anew.

    What isn't one may hold a card behind its first four characters.
    """

    def made(x: Column) -> Column:
        body = F.substring(x["plain"], F.lit(5), F.length(x["plain"]))
        check = lambda b: F.lpad((98 - _mod97(F.concat(b, F.substring(x["plain"], 1, 2), F.lit("00")))).cast("string"), 2, "0")
        fresh = _let(_fill(body, _digits(F.regexp_replace(body, "[^0-9]", ""), key, F.lit("iban"))), lambda b: F.concat(F.substring(x["plain"], 1, 2), check(b), b))
        spaced = lambda new: F.aggregate(F.split(token, ""), F.struct(F.lit(1).alias("i"), F.lit("").alias("out")), lambda acc, ch: F.struct((acc["i"] + (ch != " ").cast("int")).alias("i"), F.concat(acc["out"], F.when(ch == " ", ch).otherwise(F.substring(new, acc["i"], F.lit(1)))).alias("out")), lambda acc: acc["out"])
        valid = (F.length(x["plain"]) >= 15) & (F.length(x["plain"]) <= 34) & (_mod97(F.concat(body, F.substring(x["plain"], 1, 4))) == 1)
        inside = _let(_card(x["rest"], key), lambda c: F.struct(c["n"].alias("n"), F.concat(F.substring(token, 1, 5), c["value"]).alias("value")))
        return F.when(valid, F.struct(F.lit(1).alias("n"), _let(fresh, spaced).alias("value"))).when(x["rest"].rlike(f"^(?:{KINDS['card']})$"), inside).otherwise(F.struct(F.lit(0).alias("n"), F.lit(None).cast("string").alias("value")))

    return _let(F.struct(F.replace(token, F.lit(" "), F.lit("")).alias("plain"), F.substring(token, F.lit(6), F.length(token)).alias("rest")), made)


def pseudonym(token: Column, key: str) -> Column:
    """(kind, number of values, pseudonym) of a token that ANY finds; the pseudonym is null if nothing validates."""
    is_ = lambda kind: token.rlike(f"^(?:{KINDS[kind]})$")
    iso = _let(F.split(token, "-"), lambda p: F.date_format(_moved(_day(p[0], p[1], p[2]), key), "yyyy-MM-dd"))
    made = [("iban", None), ("iso_date", iso), ("ymd_date", _ymd_date(token, key)), ("day_date", _day_date(token, key)), ("ssn", _ssn(token, key)), ("phone", _phone(token, key)), ("ip", _ip(token, key)), ("card", None)]
    made = [(name, F.struct(F.lit(1).alias("n"), x.alias("value")) if x is not None else _iban(token, key) if name == "iban" else _card(token, key)) for name, x in made]
    kind, value = F.lit(None).cast("string"), F.lit(None).cast("struct<n: int, value: string>")
    for name, column in reversed(made):
        # What looks like an account number and isn't one holds a card, if anything.
        kind = F.when(is_(name), F.when(_mod97_ok(token), "iban").otherwise("card") if name == "iban" else F.lit(name.split("_")[-1])).otherwise(kind)
        value = F.when(is_(name), column).otherwise(value)
    return _let(value, lambda x: F.struct(kind.alias("kind"), token.alias("token"), x["n"].alias("n"), x["value"].alias("value")))


def pseudonyms(docs: DataFrame, key: str, text_col: str = "text", undo: bool = False) -> DataFrame:
    """``docs`` with the text's validated numbers and dates replaced, and counts of what was replaced by kind.

    Cards (13 to 19 digits that pass Luhn), account numbers with country and
    check digits (IBAN), social security numbers, phone numbers, IPv4 addresses
    and dates from 1900 to 2099, before a time of day too.  Phone numbers have a
    country code (+ or 00; 7 to 15 digits, 11 with +1), the layout 3-3-4, an
    area in brackets or one that begins with 0; separators and brackets are
    free.  Bare runs of digits aren't phone numbers.  What doesn't validate
    stays as it is, and so does a text without any; a null text stays null and
    has counts of 0.  Added columns: n_replaced, n_card, n_ssn, n_phone, n_ip,
    n_date, n_iban; where the table has a column of such a name, the added one gets
    underscores behind its own.  Repeated rows give repeated results, an empty
    table an empty one, and ids aren't read.  With ``undo``, pseudonyms become
    the values they stand for.
    """
    key = Undo(key) if undo else key
    text = F.col(text_col)
    marked = F.when(text.rlike(ANY), F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), lambda t: pseudonym(t, key)))

    def whole(found: Column) -> Column:
        gaps = F.split(text, ANY, -1)
        values = F.concat(F.transform(found, lambda x: F.coalesce(x["value"], x["token"])), F.array(F.lit("")))
        joined = F.array_join(F.transform(F.arrays_zip(gaps.alias("g"), values.alias("v")), lambda x: F.concat(x["g"], x["v"])), "")
        kinds = F.flatten(F.transform(F.filter(found, lambda x: x["value"].isNotNull()), lambda x: F.array_repeat(x["kind"], x["n"])))
        return F.struct(joined.alias("text"), kinds.alias("kinds"))

    helper = common.free_name(docs, "pseudonyms_made")
    made = docs.withColumn(helper, F.when(text.rlike("[0-9]"), F.when(marked.isNotNull(), _let(marked, whole))))
    kinds = F.coalesce(F.col(helper)["kinds"], F.array().cast("array<string>"))
    counts = {f"n_{k}": (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long") for k in ("card", "ssn", "phone", "ip", "date", "iban")}
    added = {common.free_name(docs, name): column for name, column in ({"n_replaced": F.size(kinds).cast("long")} | counts).items()}
    return made.withColumns({text_col: F.coalesce(F.col(helper)["text"], text)} | added).drop(helper)
