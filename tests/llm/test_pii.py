from __future__ import annotations

import datetime
import hashlib
import re
from collections import Counter

from common import documents, rows
from pyspark.sql import functions as F

from wardmill.llm import pii

TEXTS = [
    "mail bosbt.42@mail8.example.com now, Bosbt.42@mail8.example.com", "card 4041894974608795, or 4041 8949 7460 8795; 4041-8949-7460-8795.",
    "bad card 4041894974608796", "+1 (988) 555-2485 or 988-555-2485, 188-555-2485", "ip 42.144.35.254 and 300.1.1.1 and 1.2.3.4.5",
    "born 1980-02-29, 29.02.1980, 2/29/1980, 1981-02-29, 1980/01/05", "ssn 123-45-6789 000-12-3456 666-12-3456 123-00-1234",
    "iban DE89 3704 0044 0532 0130 00 DE89370400440532013000 GB82 WEST 1234 5698 7654 32 DE00370400440532013000",
    "call +49 30 1234567", "a@b.c 1.1.1.1", "x" * 5000 + " 10.0.0.1 " + "y" * 5000,
]


def hidden(spark, texts, key="k", back=False):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for r in pii.hide_private(df, key, back=back).orderBy("id").collect()]


def test_pseudonyms_keep_their_format_and_can_be_undone(spark):
    out = hidden(spark, TEXTS)
    for old, new in zip(TEXTS, out):
        assert re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "0", re.sub(r"\d+\.\d+\.\d+\.\d+", "ip", old)))) == re.sub(
            "[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "0", re.sub(r"\d+\.\d+\.\d+\.\d+", "ip", new.text)))
        )
    again = hidden(spark, [r.text for r in out], back=True)
    assert [r.text for r in again] == TEXTS
    assert [r.text for r in hidden(spark, TEXTS, "other")] != [r.text for r in out]


def test_one_digit_dates_come_back_as_the_same_day(spark):
    out = hidden(spark, ["on 1980/1/5, 5.1.1980 and 1/5/1980"])
    assert len(out[0].found) == 3
    again = hidden(spark, [out[0].text], back=True)[0].text
    assert [tuple(map(int, re.findall(r"\d+", d))) for d in re.findall(r"[\d/.]*\d", again)] == [(1980, 1, 5), (5, 1, 1980), (1, 5, 1980)]


def luhn(number):
    digits = [int(c) for c in number][::-1]
    return sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])


def test_equal_values_stay_linked_and_valid(spark):
    out = hidden(spark, TEXTS)
    cards = [re.sub(r"\D", "", f.new) for f in out[1].found]
    assert len(set(cards)) == 1 and len(cards) == 3 and luhn(cards[0]) % 10 == 0 and cards[0] != "4041894974608795"
    assert [f.kind for f in out[2].found] == [] and out[2].text == TEXTS[2]
    phones = [re.sub(r"\D", "", f.new)[-10:] for f in out[3].found]
    assert len(phones) == 2 and len(set(phones)) == 1 and phones[0][0] > "1" and phones[0][3] > "1"
    assert [f.kind for f in out[4].found] == ["ip"] and all(int(p) < 256 for p in out[4].found[0].new.split("."))
    dates = [f.new for f in out[5].found]
    assert len(dates) == 4
    days = {datetime.date.fromisoformat(dates[0]), datetime.datetime.strptime(dates[1], "%d.%m.%Y").date(), datetime.datetime.strptime(dates[2], "%m/%d/%Y").date()}
    assert len(days) == 1
    assert [f.kind for f in out[6].found] == ["ssn"]
    ibans = [f.new.replace(" ", "") for f in out[7].found]
    assert len(ibans) == 3 and ibans[0] == ibans[1]
    for iban in ibans:
        assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def test_no_two_values_share_a_pseudonym(spark):
    numbers = [f"10.0.{i // 256}.{i % 256}" for i in range(2000)]
    df = spark.createDataFrame([(n,) for n in numbers], "v string")
    assert df.select(pii.pseudonym(F.col("v"), "k")["new"].alias("n")).distinct().count() == 2000
    days = spark.range(3000).select(F.date_add(F.lit("1999-01-01").cast("date"), F.col("id").cast("int")).cast("string").alias("v"))
    assert days.select(pii.pseudonym(F.col("v"), "k")["new"].alias("n")).distinct().count() == 3000


def test_values_before_digits_or_capitals(spark):
    texts = {
        "4111 1111 1111 1111 12/27": ["card"], "4111111111111111 123": ["card"], "BE68 5390 0754 7034 USD": ["iban"],
        "12 4111-1111-1111-1111 12": ["card"], "4111 1111 1111 1112 988-555-2485": ["phone"],
        "25/12/1980 and 31-1-1980": ["date", "date"], "4111 1111 1111 1111 5500 0000 0000 0004": ["card", "card"],
        "BE68 5390 0754 7034 JOHN@x.com": ["iban", "email"], "32/12/1980 31/02/1980": [], "4111111111111112 123": [],
    }
    for (old, kinds), new in zip(texts.items(), hidden(spark, list(texts))):
        assert [f.kind for f in new.found] == kinds, old
        assert (new.text == old) == (not kinds) and "4111111111111111" not in re.sub(r"[ -]", "", new.text)
        for card in (re.sub(r"\D", "", f.new) for f in new.found if f.kind == "card"):
            assert len(card) == 16 and luhn(card) % 10 == 0


def test_late_days_first_stay_so_and_come_back(spark):
    first = datetime.date(1801, 1, 1)
    days = [first + datetime.timedelta(n) for n in range(0, 146097, 61)]
    texts = [d.strftime("%d/%m/") + f"{d.year:04}" for d in days if d.day > 12]
    out = [r.text for r in hidden(spark, texts)]
    assert len(set(out)) == len(texts) and all(13 <= int(t[:2]) <= 31 and t != old for t, old in zip(out, texts))
    assert [r.text for r in hidden(spark, out, back=True)] == texts


def test_odd_rows(spark):
    got = Counter((r.id, r.text, len(r.found)) for r in pii.hide_private(documents(spark), "k").collect())
    assert got == Counter((r[0], r[1], 0) for r in rows())
    assert pii.hide_private(documents(spark, []), "k").collect() == []


def test_main_path_has_no_python(spark):
    plan = pii.hide_private(documents(spark), "k")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def permuted(symbols, kind, key):
    """The network in plain Python, over (value, number of values)."""
    now, half = [v for v, _ in symbols], len(symbols) // 2
    for number in range(pii.ROUNDS):
        first = number % 2 == 0
        name = "|".join([key, kind, str(number), ",".join(map(str, now[half:] if first else now[:half]))])
        for i, (_, size) in enumerate(symbols):
            if (i < half) == first:
                now[i] = (now[i] + int(hashlib.sha256(f"{name}|{i}".encode()).hexdigest()[:14], 16)) % size
    return now


def plain(kind, text, key):
    """Pseudonyms of valid values in plain Python."""
    if kind == "ip":
        return ".".join(map(str, permuted([(int(p), 256) for p in text.split(".")], "ip", key)))
    if kind == "email":
        local, host = text.split("@")
        runs = [next(((a, n) for a, n in pii.RUNS if a <= ord(c) < a + n), None) for c in local]
        new = iter(permuted([(ord(c) - r[0], r[1]) for c, r in zip(local, runs) if r], "email@" + host.lower(), key))
        return "".join(chr(r[0] + next(new)) if r else c for c, r in zip(local, runs)) + "@" + host
    if kind == "card":
        digits = permuted([(int(c), 10) for c in text[:-1]], "card", key)
        body = "".join(map(str, digits))
        return body + str(-luhn(body + "0") % 10)
    if kind == "phone":
        fixed = {0: 2, 3: 2}
        digits = [int(c) for c in text if c.isdigit()]
        moved = permuted([(d - fixed.get(i, 0), 10 - fixed.get(i, 0)) for i, d in enumerate(digits)], "phone", key)
        new = iter(str(v + fixed.get(i, 0)) for i, v in enumerate(moved))
        return re.sub(r"\d", lambda _: next(new), text)
    if kind == "iban":
        own = [(ord(c) - 48, 10) if c.isdigit() else (ord(c) - 65, 26) for c in text[4:]]
        body = "".join(chr(v + (48 if r == 10 else 65)) for v, (_, r) in zip(permuted(own, "iban" + text[:2], key), own))
        rest = int("".join(str(int(c, 36)) for c in body + text[:2] + "00")) % 97
        return text[:2] + f"{98 - rest:02}" + body
    day = (datetime.date.fromisoformat(text) - datetime.date(1801, 1, 1)).days
    cycle, place = divmod(day, 189 * 773)
    one, two = permuted([(place // 773, 189), (place % 773, 773)], f"date{cycle}", key)
    return (datetime.date(1801, 1, 1) + datetime.timedelta(cycle * 189 * 773 + one * 773 + two)).isoformat()


def test_equals_plain_python(spark):
    values = {
        "ip": ["1.2.3.4", "255.0.10.9"], "email": ["a.B-9@x.org", "João_Żółw+λ.東京@Mail.example.com", "𝔸b@x.org", "Иван1@y.ru"],
        "card": ["4111111111111111", "5500000000000004", "4222222222222"], "phone": ["988-555-2485", "(212) 555-0101"],
        "iban": ["DE89370400440532013000", "GB82WEST12345698765432"], "date": ["1980-02-29", "2024-12-31", "0201-01-01", "9800-12-31"],
    }
    given = [(kind, v) for kind, own in values.items() for v in own]
    for key in ("k", "another key"):
        for (kind, value), row in zip(given, hidden(spark, [f"x: {v}, y" for _, v in given], key)):
            assert row.text == f"x: {plain(kind, value, key)}, y" and [f.kind for f in row.found] == [kind]


def test_letters_of_any_script_are_private(spark):
    texts = ["João@x.com", "write to émile.zola@x.fr!", "東京@x.jp"]
    out = hidden(spark, texts)
    for old, new in zip(texts, out):
        before, after = (t.split("@")[0].split(" ")[-1] for t in (old, new.text))
        assert len(new.found) == 1 and all(a != b for a, b in zip(before, after) if a not in ".") or before[:2] != after[:2]
    assert [r.text for r in hidden(spark, [r.text for r in out], back=True)] == texts


def test_texts_of_very_many_parts(spark):
    """Long runs of labels, words, digits and groups end no task."""
    n = 20_000
    texts = [
        "x a@b" + ".c" * n, "a." * 1_000 + "b@c.de", "9" * n, "1.2." * n, "@" * n, "a@" * n, "a@b" * n, "+1" * n,
    ]
    found = hidden(spark, texts)
    assert [len(r.found) for r in found][:2] == [1, 1] and found[2].text == texts[2] and len(found) == len(texts)
