"""Format-preserving pseudonyms."""

import datetime as dt
import random
import re

import pytest

from fleetlens.llm import pseudonyms as P


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000, 4999])
def test_feistel_is_a_keyed_permutation(size):
    net, other = P.Feistel(b"k", "f", size), P.Feistel(b"l", "f", size)
    image = [net(x) for x in range(size)]
    assert sorted(image) == list(range(size))
    assert all(net.inverse(y) == x for x, y in enumerate(image))
    if size > 90:
        assert image != [other(x) for x in range(size)] and sum(x == y for x, y in enumerate(image)) < 10


def card(payload):
    return payload + P.luhn_digit(payload)


VALUES = {
    "card": [card("411111111111111"), "4111-1111-1111-1111", card("37828224631000"), "5500 0000 0000 0004"],
    "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"],
    "ssn": ["078-05-1120"], "date": ["2024-02-29", "31.12.1999", "12/25/2020", "2001/01/02"], "ip": ["10.0.255.1", "240.56.125.154"],
    "phone": ["+1 (974) 555-3436", "020 7946 0958", "+49 30 1234567"], "email": ["st.16@mail2.example.com", "A.b+c9@x-y.org"],
}
LEFT = ["4111111111111112", "1111111111111111", "999-00-0000", "666-12-1234", "2023-02-29", "32.01.2000", "300.1.1.1", "01.2.3.4", "1.2.3.4.5",
        "DE00370400440532013000", "version 2.0", "a@b", "2 + 2 = 4", "deadbeef0123456789deadbeef", "2019-2020"]


@pytest.mark.parametrize("kind,value", [(k, v) for k, vs in VALUES.items() for v in vs])
def test_values_keep_their_format_and_come_back(kind, value):
    names, back = P.Pseudonyms(), P.Pseudonyms(inverse=True)
    text = f"é before {value}, after"
    [(s, e, got, new)] = names.found(text)
    assert (got, text[s:e]) == (kind, value) and new != value
    if kind != "ip":
        shape = lambda x: re.sub(r"[0-9]", "9", re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", x)))
        assert kind == "iban" or shape(new) == shape(value)
    changed = names.applied(text, names.found(text))
    assert [k for _, _, k, _ in names.found(changed)] == [kind]  # still valid
    if kind != "date" or value[2] != "/":
        assert back.applied(changed, back.found(changed)) == text
    assert P.Pseudonyms(b"another key").replace(kind, value) != new


@pytest.mark.parametrize("value", LEFT)
def test_what_does_not_validate_stays(value):
    assert P.Pseudonyms().found(f"x {value} y") == []


@pytest.mark.parametrize("kind,value,before,after", [
    ("card", "4111111111111111", "", " 123"), ("card", "4111 1111 1111 1111", "", " 12/25"), ("card", "4111-1111-1111-1111", "", "-123"),
    ("card", "4111111111111111", "12 ", ""), ("card", "4111 1111 1111 1111", "", " 12/25 123"), ("card", "378282246310005", "7 ", " 1234"),
    ("iban", "ES91 2100 0418 4502 0005 1332", "", " EUR"), ("iban", "ES9121000418450200051332", "", " 1000 2000"),
    ("iban", "ES91 2100 0418 4502 0005 1332", "AB12 ", " EUROPE"), ("iban", "DE89370400440532013000", "", " EUR 4111")])
def test_values_beside_others_keep_their_link(kind, value, before, after):
    names, back = P.Pseudonyms(), P.Pseudonyms(inverse=True)
    text = f"paid {before}{value}{after}, twice {value}."
    found = names.found(text)
    new = names.replace(kind, value)
    assert [(text[s:e], k, n) for s, e, k, n in found if k == kind] == [(value, kind, new)] * 2
    changed = names.applied(text, found)
    assert changed.count(new) == 2 and back.applied(changed, back.found(changed)) == text


def test_borders_and_scan_go_on_after_the_accepted_value():
    two = "4111 1111 1111 1111 5500 0000 0000 0004"
    assert [(two[s:e], k) for s, e, k, _ in P.Pseudonyms().found(two)] == [(two[:19], "card"), (two[20:], "card")]
    assert not [v for v in P.Pseudonyms().found("4111 1111 1111 1112 123, ES00 2100 0418 4502 0005 1332 EUR") if v[2] == "iban"]


def test_dates_and_cards_are_injective():
    names = P.Pseudonyms()
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(500)]
    assert len({names.replace("date", d.isoformat()) for d in days}) == 500
    r = random.Random(1)
    cards = {card("4" + "".join(r.choices("0123456789", k=14))) for _ in range(500)}
    new = {names.replace("card", c) for c in cards}
    assert len(new) == len(cards) and all(P.luhn_digit(c[:-1]) == c[-1] for c in new)
    assert names.replace("card", "4111 1111 1111 1111").replace(" ", "") == names.replace("card", "4111111111111111")


def test_rows(spark):
    long_text = "plain words " * 20000 + "mail st.16@mail2.example.com end"
    rows = [(1, "call +1 (974) 555-3436 or +1 (974) 555-3436", 5), (2, "x +1 (974) 555-3436", 5), (3, None, 5), (4, "", 5), (None, long_text, 5), (1, "clean", 5), (1, "clean", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_email int")
    got = [(r["doc_id"], r["text"], r["n_phone"], r["n_email"], r["spans"]) for r in P.pseudonymise(df).collect()]
    by = {(i, n, m): t for i, t, n, m, _ in got}
    phone = by[2, 1, 0][2:]
    assert by[1, 2, 0] == f"call {phone} or {phone}" and phone != "+1 (974) 555-3436"
    assert by[3, 0, 0] is None and by[4, 0, 0] == "" and [g[1] for g in got].count("clean") == 2
    assert by[None, 0, 1].startswith("plain words ") and "st.16@" not in by[None, 0, 1]
    assert P.pseudonymise(df.limit(0)).count() == 0
    kept = P.protect(df)
    assert kept.columns == df.columns and sorted(str(r["text"]) for r in kept.collect()) == sorted(str(g[1]) for g in got)
