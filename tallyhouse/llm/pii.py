"""Format-preserving Feistel pseudonyms, in DataFrame functions only.

Values that look like personal data and pass their check are permuted within their
format by a Feistel network under a key: a card number stays a valid card number
of its length, a date a date. The permutation depends on the key, the kind and the
bare value, not on how it is written, so equal values get equal pseudonyms in every
document, and different values different ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 10

#: A host's name has 127 labels at most, as its 253 characters allow no more.
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.){1,126}[A-Za-z]{2,}"
IBAN = r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
IPV4 = r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9])(?!\.[0-9])"
DATE = "|".join([r"[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9])", *(
    rf"[0-9]{{2}}{mark}[0-9]{{2}}{mark}[0-9]{{4}}(?![0-9])" for mark in (r"\.", "/", "-")
)])
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = r"\+?[0-9]{0,3}[\x20.-]?\([0-9]{2,4}\)[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])|\+[0-9]{1,3}(?:[\x20.-]?[0-9]{2,4}){2,5}(?![0-9])|[0-9]{3}[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
CARD = r"[0-9]{13,19}(?![0-9])|(?:[0-9]{4}[\x20-]){3}[0-9]{4}(?![0-9])|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}(?![0-9])"

#: In the order in which they are tried at a place of the text.
KINDS = {"email": EMAIL, "iban": IBAN, "ip": IPV4, "date": DATE, "ssn": SSN, "card": CARD, "phone": PHONE}
_FORMS = "|".join(f"(?:{p})" for p in KINDS.values())
_GROUPS = r"(?:[0-9]{4}[\x20-]){3}[0-9]{4}(?![0-9])"
#: Every place where a value may begin, of no length; what has its form is group 1. A
#: card number in groups may also follow four digits and a dash.
BEGIN = rf"(?:(?<![A-Za-z0-9@._%+-])|(?<=(?<![A-Za-z0-9])[0-9]{{4}}-)(?={_GROUPS}))(?=({_FORMS}))"
#: Without a digit or an at sign nothing can match.
QUICK = "[0-9@]"

#: Characters of an IBAN by country, as registered.
IBAN_CHARS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}

#: Dates from FIRST_DAY on, SIDE * SIDE days (to November 2154), are permuted among
#: themselves; others are no one's dates and stay.
FIRST_DAY = "1800-01-01"
SIDE = 360


def _digest(key: Column, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", key, *parts), 512)


def _number(digest: Column) -> Column:
    """Its first 60 bits."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel_number(value: Column, side: int, key: Column, kind: str) -> Column:
    """A permutation of 0 .. side * side - 1."""
    begin = F.struct(F.floor(value / side).cast("long").alias("left"), F.pmod(value, F.lit(side)).cast("long").alias("right"))

    def turn(at: Column, k: Column) -> Column:
        step = F.pmod(at["left"] + _number(_digest(key, F.lit(kind), k.cast("string"), at["right"].cast("string"))), F.lit(side))
        return F.struct(at["right"].alias("left"), step.cast("long").alias("right"))

    return F.aggregate(_rounds(), begin, turn, lambda at: at["left"] * side + at["right"])


def feistel_pair(left: Column, right: Column, lefts: int, rights: int, key: Column, kind: str) -> Column:
    """A permutation of the pairs (0 .. lefts - 1, 0 .. rights - 1), as a struct: the sides
    take turns in being moved on by a digest of the other."""
    begin = F.struct(left.cast("long").alias("left"), right.cast("long").alias("right"))

    def turn(at: Column, k: Column) -> Column:
        by = lambda side: _number(_digest(key, F.lit(kind), k.cast("string"), at[side].cast("string")))
        odd = F.pmod(k, F.lit(2)) == 1
        return F.struct(
            F.when(odd, F.pmod(at["left"] + by("right"), F.lit(lefts))).otherwise(at["left"]).cast("long").alias("left"),
            F.when(odd, at["right"]).otherwise(F.pmod(at["right"] + by("left"), F.lit(rights))).cast("long").alias("right"),
        )

    return F.aggregate(_rounds(), begin, turn)


def _rounds() -> Column:
    return F.sequence(F.lit(1), F.lit(ROUNDS))


def _shifted(text: Column, digest: Column) -> Column:
    """Each digit, capital and small letter moved on within its kind by a byte of
    the digest (used again from its begin for long texts); other characters stay."""

    def move(char: Column, k: Column) -> Column:
        by = F.conv(F.substring(digest, F.pmod(k, F.lit(64)) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        code = F.ascii(char)
        within = lambda first, size: F.char((first + F.pmod(code - first + by, F.lit(size))).cast("long"))
        return (
            F.when(code.between(48, 57), within(48, 10)).when(code.between(65, 90), within(65, 26))
            .when(code.between(97, 122), within(97, 26)).otherwise(char)
        )

    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return F.array_join(F.transform(chars, move), "")


def feistel_text(value: Column, key: Column, kind: str) -> Column:
    """A permutation of texts of the same length and kinds of characters."""
    half = F.floor(F.length(value) / 2).cast("int")
    begin = F.struct(
        F.substring(value, F.lit(1), half).alias("left"), F.substring(value, half + 1, F.length(value)).alias("right")
    )

    def turn(at: Column, k: Column) -> Column:
        digest = _digest(key, F.lit(kind), k.cast("string"), F.length(at["left"]).cast("string"), at["right"])
        return F.struct(at["right"].alias("left"), _shifted(at["left"], digest).alias("right"))

    return F.aggregate(_rounds(), begin, turn, lambda at: F.concat(at["left"], at["right"]))


def _filled(form: Column, fill: Column, holes: str = "[A-Za-z0-9]") -> Column:
    """The form with its letters and digits replaced, in order, by those of fill."""
    begin = F.struct(F.lit("").alias("done"), F.lit(1).alias("next"))

    def step(at: Column, char: Column) -> Column:
        hole = char.rlike(holes)
        return F.struct(
            F.concat(at["done"], F.when(hole, F.substring(fill, at["next"], F.lit(1))).otherwise(char)).alias("done"),
            (at["next"] + hole.cast("int")).alias("next"),
        )

    return F.aggregate(F.split(form, ""), begin, step, lambda at: at["done"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_sum(digits: Column, last_doubled: bool) -> Column:
    """The sum of a card number's check: every second digit, from the right, doubled."""

    def add(total: Column, at: Column) -> Column:
        twice = at["digit"] * 2
        return total + F.when(at["doubled"], F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(at["digit"])

    places = F.transform(F.split(F.reverse(digits), ""), lambda d, k: F.struct(
        F.when(d == "", 0).otherwise(d.try_cast("int")).alias("digit"),
        (F.pmod(k, F.lit(2)) == (0 if last_doubled else 1)).alias("doubled"),
    ))
    return F.aggregate(places, F.lit(0), add)


def iban_rest(text: Column) -> Column:
    """Letters and digits as one number (A is 10), modulo 97."""

    def add(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        value = F.when(code >= 65, code - 55).otherwise(code - 48)
        return F.when(char == "", rest).otherwise(F.pmod(rest * F.when(value > 9, 100).otherwise(10) + value, F.lit(97)))

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def _email(value: Column, key: Column) -> Column:
    """The name before the at sign changes; letters' case does not part equal addresses."""
    name = F.substring_index(value, "@", 1)
    host = F.lower(F.substring_index(value, "@", -1))
    return F.concat(feistel_text(F.lower(name), F.concat_ws("|", key, host), "email"), F.lit("@"), F.substring_index(value, "@", -1))


def _ip(value: Column, key: Column) -> Column:
    part = lambda k: F.get(F.split(value, r"\."), k).cast("long")
    number = ((part(0) * 256 + part(1)) * 256 + part(2)) * 256 + part(3)
    # In four steps from the permuted number, which one expression names once each.
    return F.array_join(F.transform(
        F.transform(F.array(feistel_number(number, 65536, key, "ip")), lambda n: F.array(*[
            F.pmod(F.shiftright(n, by), F.lit(256)) for by in (24, 16, 8, 0)
        ]))[0], lambda octet: octet.cast("string"),
    ), ".")


def _ip_valid(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda octet: (octet.cast("int") <= 255) & ((octet == "0") | ~octet.startswith("0")))


def _card(value: Column, key: Column) -> Column:
    digits = _digits(value)
    payload = feistel_text(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
    whole = F.transform(F.array(payload), lambda p: F.concat(
        p, F.pmod(10 - F.pmod(luhn_sum(p, True), F.lit(10)), F.lit(10)).cast("string")
    ))[0]
    return F.transform(F.array(whole), lambda w: _filled(value, w, "[0-9]"))[0]


def _card_valid(value: Column) -> Column:
    return (F.pmod(luhn_sum(_digits(value), False), F.lit(10)) == 0) & ~_digits(value).rlike("^0+$")


def _iban(value: Column, key: Column) -> Column:
    bare = F.replace(value, F.lit(" "), F.lit(""))
    country = F.substring(bare, 1, 2)
    account = feistel_text(F.substring(bare, F.lit(5), F.length(bare)), F.concat_ws("|", key, country), "iban")
    whole = F.transform(F.array(account), lambda a: F.concat(
        country, F.lpad((98 - iban_rest(F.concat(a, country, F.lit("00")))).cast("string"), 2, "0"), a
    ))[0]
    return F.transform(F.array(whole), lambda w: _filled(value, w))[0]


def _iban_valid(value: Column) -> Column:
    bare = F.replace(value, F.lit(" "), F.lit(""))
    return F.length(bare).between(15, 34) & (
        iban_rest(F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))) == 1
    )


def _iban_alone(value: Column) -> Column:
    """The IBAN that a match begins with, without the words after it: the one of its
    country's length, else the longest that passes the check, else the match."""
    words = F.split(value, " ")
    begins = F.transform(F.sequence(F.lit(1), F.size(words)), lambda k: F.array_join(F.slice(words, 1, k), " "))
    length = F.create_map(*[
        F.lit(part) for chars, countries in IBAN_CHARS.items() for country in countries.split() for part in (country, chars)
    ])
    right = lambda v: F.length(F.replace(v, F.lit(" "), F.lit(""))) == F.try_element_at(length, F.substring(v, 1, 2))
    valid = F.filter(begins, _iban_valid)
    # The valid ones are worked out once, in an array of their own.
    return F.when(value.rlike(f"^(?:{IBAN})$") & value.contains(" "), F.transform(F.array(valid), lambda v: F.coalesce(
        F.get(F.filter(v, right), F.lit(0)), F.try_element_at(v, F.lit(-1)), value
    ))[0]).otherwise(value)


def _phone(value: Column, key: Column) -> Column:
    """The last ten digits change; what stands before them, a country's number, stays."""
    digits = _digits(value)
    before = F.greatest(F.length(digits) - 10, F.lit(0))
    whole = F.concat(
        F.substring(digits, F.lit(1), before), feistel_text(F.substring(digits, before + 1, F.lit(10)), key, "phone")
    )
    return F.transform(F.array(whole), lambda w: _filled(value, w, "[0-9]"))[0]


#: Areas of social security numbers are 001 to 899 without 666, groups 01 to 99, serials
#: 0001 to 9999; others were never given out.
AREAS, NO_AREA, GROUPS, SERIALS = 898, 666, 99, 9999


def _ssn_valid(value: Column) -> Column:
    return ~value.rlike("^(?:000|666|9)|-00-|-0000$")


def _ssn(value: Column, key: Column) -> Column:
    """The numbers that may be given out are permuted among themselves."""
    area, group, serial = (F.substring(value, at, size).cast("long") for at, size in ((1, 3), (5, 2), (8, 4)))
    left = (area - 1 - (area > NO_AREA).cast("long")) * GROUPS + (group - 1)
    moved = feistel_pair(left, serial - 1, AREAS * GROUPS, SERIALS, key, "ssn")

    def shown(at: Column) -> Column:
        place = F.floor(at["left"] / GROUPS).cast("long") + 1
        parts = ((place + (place >= NO_AREA).cast("long"), 3), (F.pmod(at["left"], F.lit(GROUPS)) + 1, 2), (at["right"] + 1, 4))
        return F.concat_ws("-", *[F.lpad(part.cast("string"), size, "0") for part, size in parts])

    return F.transform(F.array(moved), shown)[0]


def _date_parts(value: Column) -> tuple[Column, Column, Column]:
    """Year, month and day; of two places that may be either, the day comes first
    unless that gives no date."""
    iso = value.rlike("^[0-9]{4}")
    at = lambda start, size: F.substring(value, start, size).try_cast("int")
    second_is_day = ~iso & (at(4, 2) > 12)
    year = F.when(iso, at(1, 4)).otherwise(at(7, 4))
    month = F.when(iso, at(6, 2)).when(second_is_day, at(1, 2)).otherwise(at(4, 2))
    day = F.when(iso, at(9, 2)).when(second_is_day, at(4, 2)).otherwise(at(1, 2))
    return year, month, day


def _day_number(value: Column) -> Column:
    """Days since FIRST_DAY; null where it is no date."""
    year, month, day = _date_parts(value)
    text = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0"))
    return F.datediff(F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date"), F.lit(FIRST_DAY).cast("date"))


def _date_valid(value: Column) -> Column:
    return F.coalesce(_day_number(value).between(0, SIDE * SIDE - 1), F.lit(False))


def _date(value: Column, key: Column) -> Column:
    """The date in the form, and the order of its parts, that it had."""
    iso = value.rlike("^[0-9]{4}")
    day_second = ~iso & (F.substring(value, 4, 2).cast("int") > 12)
    number = feistel_number(_day_number(value).cast("long"), SIDE, key, "date")
    moved = F.transform(F.array(number), lambda n: F.date_add(F.lit(FIRST_DAY).cast("date"), n.cast("int")))
    digits = F.transform(moved, lambda d: F.when(iso, F.date_format(d, "yyyyMMdd")).when(
        # A month may come first only where the day then tells it is no month.
        day_second & (F.dayofmonth(d) > 12), F.date_format(d, "MMddyyyy")
    ).otherwise(F.date_format(d, "ddMMyyyy")))[0]
    return F.transform(F.array(digits), lambda w: _filled(value, w, "[0-9]"))[0]


_TRUE: Callable[[Column], Column] = lambda value: F.lit(True)
_CHECK = {"email": _TRUE, "iban": _iban_valid, "ip": _ip_valid, "date": _date_valid, "ssn": _ssn_valid, "card": _card_valid, "phone": _TRUE}
_PERMUTE = {"email": _email, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "card": _card, "phone": _phone}


def kind_of(value: Column) -> Column:
    """The first kind whose form the whole value has and whose check it passes."""
    found = F
    for kind, pattern in KINDS.items():
        found = found.when(value.rlike(f"^(?:{pattern})$") & _CHECK[kind](value), F.lit(kind))
    return found


def pseudonym(value: Column, kind: Column, key: Column) -> Column:
    """The pseudonym of a value of a kind; without a kind the value itself."""
    out = F
    for name, permute in _PERMUTE.items():
        out = out.when(kind == name, permute(value, key))
    return out.otherwise(value)


def _reached(matches: Column) -> Column:
    """For each match how many characters from its begin on are of one before it that
    counts. A match counts if it is valid and begins in no other that counts."""
    step = lambda before, m: F.greatest(
        F.when(before > 0, before).otherwise(m["chars"]) - m["room"], F.lit(0)
    )
    begin = F.struct(F.array().cast("array<int>").alias("all"), F.lit(0).alias("now"))
    one_by_one = F.aggregate(matches, begin, lambda at, m: F.struct(
        F.concat(at["all"], F.array(at["now"])).alias("all"), step(at["now"], m).alias("now")
    ), lambda at: at["all"])
    # Hardly any text has a match that reaches into the next one.
    return F.when(F.exists(matches, lambda m: m["chars"] > m["room"]), one_by_one).otherwise(
        F.transform(matches, lambda m: F.lit(0))
    )


def pseudonymize(
    docs: DataFrame, key: str, text: str = "text", result: str = "private", counts: str = "n_private"
) -> DataFrame:
    """The documents with two more columns: the text with its personal data
    replaced, and a map from kind to the number of values replaced.

    Values are found leftmost, longest as their patterns say, not inside longer
    runs of letters and digits. One that has a form but fails its check (a card
    number's last digit, an IBAN's rest, an address's octets, a calendar's date)
    stays as it is, and values that begin inside it are found. An IBAN ends where its
    country's do, or is the longest that passes. A null text stays null, with an empty
    map; columns that have the names of the results are replaced.
    """
    secret = F.lit(key)
    source = F.col(text)
    rows = docs.drop(result, counts)
    at, parts = "pii_matches", "pii_parts"
    while at in rows.columns or parts in rows.columns:
        at, parts = at + "_", parts + "_"
    found = F.when(source.rlike(QUICK), F.regexp_extract_all(source, F.lit(BEGIN), F.lit(1)))
    # The text is cut before each place where a value may begin; a part without a
    # place comes first, an empty one where the text begins with a place.
    cut = F.split(source, BEGIN)
    listed = rows.withColumn(at, found).withColumn(parts, F.when(F.size(at) > 0, F.transform(
        F.array(cut), lambda c: F.when(F.size(c) > F.size(at), c).otherwise(F.concat(F.array(F.lit("")), c))
    )[0]))
    checked = listed.withColumn(at, F.transform(F.transform(F.col(at), _iban_alone), lambda value: F.struct(
        value.alias("value"), kind_of(value).alias("kind")
    )))
    chars = lambda m: F.when(m["kind"].isNull(), 0).otherwise(F.length(m["value"]))
    sized = checked.withColumn(at, F.zip_with(F.col(at), F.slice(parts, F.lit(2), F.size(at)), lambda m, part: F.struct(
        m["value"].alias("value"), m["kind"].alias("kind"), chars(m).alias("chars"), part.alias("part"), F.length(part).alias("room")
    )))
    chosen = sized.withColumn(at, F.zip_with(F.col(at), _reached(F.col(at)), lambda m, reached: F.struct(
        m["value"].alias("value"), F.when(reached == 0, m["kind"]).alias("kind"), m["part"].alias("part"),
        F.when(reached == 0, m["chars"]).otherwise(reached).alias("gone"),
    )))
    replaced = chosen.withColumn(at, F.transform(F.col(at), lambda m: F.struct(
        m["kind"].alias("kind"), F.concat(
            F.when(m["kind"].isNull(), "").otherwise(pseudonym(m["value"], m["kind"], secret)),
            F.substring(m["part"], m["gone"] + 1, F.length(m["part"])),
        ).alias("text"),
    )))
    whole = F.concat(F.get(F.col(parts), F.lit(0)), F.array_join(F.transform(F.col(at), lambda m: m["text"]), ""))
    kinds = F.array_compact(F.transform(F.coalesce(at, F.array().cast(replaced.schema[at].dataType)), lambda m: m["kind"]))
    tally = F.map_from_entries(F.transform(F.array_distinct(kinds), lambda kind: F.struct(
        kind.alias("key"), F.size(F.filter(kinds, lambda k: k == kind)).cast("long").alias("value")
    )))
    return replaced.select(
        *rows.columns, F.when(F.col(parts).isNotNull(), whole).otherwise(source).alias(result), tally.alias(counts)
    )
