import random
import re
from datetime import date

from brute import EDGES, documents
from pyspark.sql import functions as F

from tallyhouse.llm import pii


def luhn(number):
    digits = [int(c) for c in re.sub(r"\D", "", number)][::-1]
    return sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits)) % 10 == 0


def with_check(payload):
    return next(payload + d for d in "0123456789" if luhn(payload + d))


def private(spark, texts, key="k"):
    rows = pii.pseudonymize(documents(spark, [(n, t, "en") for n, t in enumerate(texts)]), key).collect()
    return [(r["private"], r["n_private"]) for r in sorted(rows, key=lambda r: r["doc_id"])]


CARD, OTHER = with_check("453201511283036"), with_check("37828224631000")
VALUES = {
    "card": [CARD, " ".join(CARD[k:k + 4] for k in range(0, 16, 4)), "-".join(CARD[k:k + 4] for k in range(0, 16, 4)), OTHER],
    "iban": ["DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19"], "ip": ["10.1.200.7", "255.255.255.255"],
    "date": ["1984-02-29", "29.02.1984", "02/29/1984", "2001-12-31"], "ssn": ["123-45-6789", "899-99-9999", "001-01-0001", "667-01-0001", "665-99-9999"],
    "phone": ["+1 (456) 555-2186", "(456) 555-2186", "+49 30 901820", "555 123 4567"], "email": ["jo.doe-7@mail3.example.com", "JO.doe-7@Mail3.example.com"],
}
FORMS = {
    "card": luhn, "ip": lambda v: all(int(x) <= 255 and str(int(x)) == x for x in v.split(".")), "ssn": lambda v: not re.search("^(000|666|9)|-00-|-0000$", v),
    "iban": lambda v: int("".join(str(int(c, 36)) for c in (lambda b: b[4:] + b[:4])(v.replace(" ", "")))) % 97 == 1,
    "phone": lambda v: True, "email": lambda v: v.lower().endswith("@mail3.example.com"), "date": lambda v: True,
}


def test_values_keep_their_form_and_pass_their_check(spark):
    for kind, values in VALUES.items():
        for value, (text, counts) in zip(values, private(spark, [f"say {v}, so" for v in values])):
            new = text[4:-4]
            assert counts == {kind: 1} and new != value, (kind, value, text)
            assert FORMS[kind](new), (kind, new)
            if kind != "ip":
                assert re.sub("[0-9]", "0", re.sub("[a-z]", "a", new.lower())) == re.sub("[0-9]", "0", re.sub("[a-z]", "a", value.lower()))


def test_equal_values_stay_linked_however_they_are_written(spark):
    plain = lambda text: re.sub(r"\D", "", text)
    first, spaced, dashed, _ = [plain(text) for text, _ in private(spark, VALUES["card"])]
    assert first == spaced == dashed
    iso, dotted, american, _ = [text for text, _ in private(spark, VALUES["date"])]
    year, month, day = map(int, iso.split("-"))
    assert dotted == f"{day:02}.{month:02}.{year}"
    assert american in (f"{month:02}/{day:02}/{year}", f"{day:02}/{month:02}/{year}")
    assert date(year, month, day)
    phones = [text for text, _ in private(spark, VALUES["phone"])]
    assert phones[0] == "+1 " + phones[1]
    mails = [text.lower() for text, _ in private(spark, VALUES["email"])]
    assert mails[0] == mails[1]


def test_another_key_gives_other_pseudonyms(spark):
    texts = [v for values in VALUES.values() for v in values]
    assert all(a != b for (a, _), (b, _) in zip(private(spark, texts), private(spark, texts, "other")))


def test_permutations_are_one_to_one(spark):
    three = spark.range(1000).select(
        pii.feistel_text(F.lpad(F.col("id").cast("string"), 3, "0"), F.lit("k"), "t").alias("t"),
        pii.feistel_number(F.col("id") % 900, 30, F.lit("k"), "n").alias("n"),
    ).collect()
    assert {r["t"] for r in three} == {f"{n:03}" for n in range(1000)}
    assert {r["n"] for r in three[:900]} == set(range(900))


def test_what_fails_its_check_stays(spark):
    wrong = [
        CARD[:-1] + str((int(CARD[-1]) + 1) % 10), "DE89370400440532013001", "256.1.1.1", "01.2.3.4", "2023-02-29", "31.04.2020",
        "1700-01-01", "12345", "v1.2.3", "a@b", "0000000000000000", "no numbers", "x4532015112830366x",
    ]
    assert private(spark, wrong) == [(text, {}) for text in wrong]


def test_values_beside_other_words_and_in_what_fails_its_check(spark):
    grouped = " ".join(CARD[k:k + 4] for k in range(0, 16, 4))
    cases = [
        ("", "BE68 5390 0754 7034", " BIC GKCCBEBB", "iban"), ("", "ES9121000418450200051332", " EUR 500", "iban"),
        ("to ", "AT611904300234573201", " AND", "iban"), ("", "BE68 5390 0754 7034", " 1234 ABCDEFGHI", "iban"),
        ("AB13 ", "BE68 5390 0754 7034", "", "iban"), ("order 1234 ", grouped, ".", "card"), ("AB12 ", grouped, "", "card"),
        ("no 1234-", grouped.replace(" ", "-"), "", "card"), ("\U0001f600 2023-02-29 1234 5678 ", grouped, " 1234", "card"),
    ]
    got = private(spark, [before + value + after for before, value, after, _ in cases])
    for (before, value, after, kind), (new, counts) in zip(cases, got):
        assert counts == {kind: 1} and new.startswith(before) and new.endswith(after), (value, new)
        changed = new[len(before):len(new) - len(after)]
        assert changed != value and len(changed) == len(value) and FORMS[kind](changed), (value, new)


def test_a_value_that_begins_in_another_one_is_part_of_it(spark):
    cards = [with_check(f"4111111111111{n:02}") for n in range(100)]
    first = next(c for c in cards if any(luhn(c[4:] + f"{n:04}") for n in range(10000)))
    last = next(f"{n:04}" for n in range(10000) if luhn(first[4:] + f"{n:04}"))
    grouped = " ".join(first[k:k + 4] for k in range(0, 16, 4))
    (alone, _), (both, counts) = private(spark, [grouped, f"{grouped} {last} and {CARD}"])
    assert counts == {"card": 2} and both.startswith(f"{alone} {last} and ")


def test_edges(spark):
    docs = documents(spark)
    rows = pii.pseudonymize(docs, "k")
    assert rows.columns == [*docs.columns, "private", "n_private"]
    for row in rows.collect():
        assert row["private"] == row["text"] and row["n_private"] == {}
    clash = pii.pseudonymize(docs.withColumn("private", F.lit(1)).withColumn("pii_gaps", F.lit(2)), "k")
    assert clash.count() == len(EDGES) and "pii_gaps" in clash.columns
    assert pii.pseudonymize(documents(spark, []), "k").count() == 0


def test_long_text_with_many_values(spark):
    rng = random.Random(2)
    cards = [with_check("4" + "".join(rng.choices("0123456789", k=14))) for _ in range(400)]
    (text, counts), = private(spark, ["; ".join(cards * 3)])
    new = text.split("; ")
    assert counts == {"card": 1200} and new[:400] == new[400:800] and len(set(new)) == len(set(cards))
    assert all(map(luhn, new)) and not set(new) & set(cards)


def test_numbers_never_given_out_stay(spark):
    kept = ["000-00-0000", "666-12-3456", "900-12-3456", "123-00-4567", "123-45-0000"]
    assert private(spark, kept) == [(text, {}) for text in kept]


def test_hosts_of_many_labels(spark):
    for labels in (1, 20, 25, 126):
        host = "a." * labels + "com"
        [(text, counts)] = private(spark, [f"write jo.doe@{host}."])
        assert counts == {"email": 1} and text.endswith(f"@{host}.") and "jo.doe@" not in text


def test_pairs_are_permuted(spark):
    rows = spark.range(7 * 11).select(pii.feistel_pair(F.floor(F.col("id") / 11), F.col("id") % 11, 7, 11, F.lit("k"), "x").alias("p"))
    found = {(r.p.left, r.p.right) for r in rows.collect()}
    assert found == {(a, b) for a in range(7) for b in range(11)}
    assert [(r.p.left, r.p.right) for r in rows.orderBy("p").limit(3).collect()] == [(0, 0), (0, 1), (0, 2)]
