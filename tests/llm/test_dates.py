"""Dates with the day first and dates of timestamps do not stay in clear."""

import datetime as dt
import re

import pytest

from tickloom.llm import pii

P = pii.Permutation(b"test")


def test_day_first_with_slashes():
    days = [dt.date(2020, 1, 1) + dt.timedelta(n) for n in range(800)]
    old = [d.strftime("%d/%m/%Y") for d in days if d.day > 12] + [d.strftime("%m/%d/%Y") for d in days]
    new = [pii.pseudonyms(f"on {v}.", P) for v in old]
    assert all([k for k, _, _ in spans] == ["date"] for _, spans in new)
    values = [re.search(r"\d\d/\d\d/\d{4}", t).group() for t, _ in new]
    assert len(set(values)) == len(old)
    first = sum(d.day > 12 for d in days)
    assert all(dt.datetime.strptime(v, "%d/%m/%Y").day > 12 for v in values[:first])
    assert all(dt.datetime.strptime(v, "%m/%d/%Y") for v in values[first:])


def test_dates_of_timestamps():
    new, spans = pii.pseudonyms("at 2020-01-05T10:00:30Z and on 2020-01-05", P)
    assert [k for k, _, _ in spans] == ["date", "date"] and "2020-01-05" not in new
    assert len({new[a:b] for _, a, b in spans}) == 1 and "T10:00:30Z" in new


@pytest.mark.parametrize("text", ["31/02/2020", "00/13/2020", "13/13/2020", "2020-01-05Tx", "2020-01-05x", "2020-02-30T10:00"])
def test_no_dates(text):
    assert pii.pseudonyms(text, P) == (text, [])
