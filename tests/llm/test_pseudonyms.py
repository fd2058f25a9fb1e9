import random
from datetime import date

import pytest

from ledgerloom.llm import pseudonyms as ps
from tests.llm.edge import NASTY

KEY = b"key"
VALID = [
    ("card", "4111 1111 1111 1111"), ("card", "4425414259157784"), ("card", "378282246310005"), ("iban", "DE89 3704 0044 0532 0130 00"),
    ("iban", "GB29NWBK60161331926819"), ("ip", "42.100.237.47"), ("ip", "0.0.0.0"), ("phone", "+1 (644) 555-7859"), ("phone", "+49 30 901820"),
    ("phone", "(212) 555-0100"), ("ssn", "123-45-6789"), ("date", "2024-02-29"), ("date", "31.12.1999"), ("date", "12/25/2001"),
    ("mail", "nmftmlee.22@mail7.example.com"), ("mail", "A.b+c@x.org"),
]
INVALID = [
    "4111 1111 1111 1112", "0000000000000000", "DE88 3704 0044 0532 0130 00", "256.1.1.1", "01.2.3.4", "000-12-3456", "666-12-3456", "2023-02-29",
    "31.04.2020", "123", "12345678901234567890123", "+1 (044) 555-7859", "v1.2.3", "10-20", "nobody@", "page 7 of 12", "1850-01-01",
]


@pytest.mark.parametrize("kind,value", VALID)
def test_values_are_replaced_in_their_format_and_back(kind, value):
    work, undo = ps.Pseudonymiser(KEY), ps.Pseudonymiser(KEY, back=True)
    text = f"Before, {value}. after {value}"
    new, counts = work.replace(text)
    assert counts == {k: 2 * (k == kind) for k in ps.KINDS}
    assert value not in new and new.startswith("Before, ") and ". after " in new
    first, second = new.removeprefix("Before, ").split(". after ")
    assert first == second
    assert undo.replace(new) == (text, counts)
    assert ps.Pseudonymiser(b"other").replace(text)[0] != new


@pytest.mark.parametrize("value", INVALID)
def test_other_texts_are_left_alone(value):
    assert ps.Pseudonymiser(KEY).replace(f"see {value} there")[0] == f"see {value} there"


def test_dates_without_leading_zeros():
    work, undo = ps.Pseudonymiser(KEY), ps.Pseudonymiser(KEY, back=True)
    new = work.date("1/2/2003")
    assert new != "1/2/2003" and [int(x) for x in undo.date(new).split("/")] == [1, 2, 2003]


def test_separators_do_not_matter_and_neighbours_are_both_found():
    work = ps.Pseudonymiser(KEY)
    a, b = work.replace("4111 1111-11111111")[0], work.replace("4111111111111111")[0]
    assert a.replace(" ", "").replace("-", "") == b and a[4] == " " and a[9] == "-"
    _, counts = work.replace("call +1 (269) 555-3296 4524132264652876 12")
    assert counts["phone"] == 1 and counts["card"] == (ps.luhn("452413226465287") == 6)


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000])
def test_permutations_are_one_to_one(size):
    f = ps.Feistel(KEY)
    out = [f.permute("k", x, size) for x in range(size)]
    assert sorted(out) == list(range(size)) and [f.permute("k", y, size, back=True) for y in out] == list(range(size))


def test_replaced_values_are_valid_again():
    rng, work = random.Random(1), ps.Pseudonymiser(KEY)
    for _ in range(200):
        body = "".join(rng.choice("0123456789") for _ in range(15))
        new = work.card(body + str(ps.luhn(body)))
        assert ps.luhn(new[:-1]) == int(new[-1])
        day = date.fromordinal(rng.randint(date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()))
        assert date.fromisoformat(work.date(day.isoformat()))
    iban = work.iban("DE89370400440532013000")
    assert ps.mod97(iban[4:] + iban[:4]) == 1 and iban.startswith("DE")


def test_table(spark):
    rows = NASTY + [(i, f"{v} and {v}") for i, (_, v) in enumerate(VALID)]
    frame = spark.createDataFrame([(i, t, 3, "c") for i, t in rows], "doc_id bigint, text string, c0 int, n_card string")
    out = ps.pseudonymise(frame, KEY, prefix="count_")
    assert out.columns == [*frame.columns, *[f"count_{k}" for k in ps.KINDS]]
    got = {r.doc_id: r for r in out.collect() if r.doc_id is not None and r.doc_id < 100}
    assert all(got[i][f"count_{k}"] == 2 and v not in got[i].text for i, (k, v) in enumerate(VALID))
    assert out.filter("doc_id > 1000 and text is null").count() == 1 and out.count() == len(rows)
    back = ps.pseudonymise(out.select("doc_id", "text"), KEY, back=True).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=str) == sorted(rows, key=str)
    assert ps.pseudonymise(frame.limit(0), KEY).collect() == []
